import os
import re
from html import unescape

import pytest

from ledgerline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_main_text_of_the_whole_table(spark):
    """Every page of the table has one article of h1 and p."""
    html = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in QUERIES["op10_html_text"](spark, SF).collect():
        page = html[r.page_id]
        article = page[page.index("<article>"):page.index("</article>")]
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_toxicity_of_the_whole_table(spark):
    got = QUERIES["op2_toxicity"](spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]

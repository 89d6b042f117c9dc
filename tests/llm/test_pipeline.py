import os

import pytest

pytest.importorskip("public_tokenizers")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from ledgerline.llm import decontaminate, mixing, quality, simhash, tokens  # noqa: E402
from ledgerline.llm.common import stored, table  # noqa: E402
from ledgerline.llm.queries import QUERIES, tokenizer_path  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_stages_each_work_on_what_came_before(spark):
    docs = table(spark, SF, "documents")
    columns, names = docs.columns, [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_dedup", "decontamination", "source_mix", "token_output"]
    benchmark = table(spark, SF, "benchmark")
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, before, SF), f"test-{name}")
        if name != "token_output":
            assert docs.columns == columns
        ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
        if name == "quality_rules":
            assert ids(docs) == ids(quality.quality_report(before).where("kept"))
        elif name == "near_dedup":
            assert ids(docs) == ids(simhash.simhash_report(before).where("doc_id = component_id"))
            assert docs.count() == len(ids(docs))
        elif name == "decontamination":
            dirty = ids(decontaminate.contamination_report(before, benchmark).where("contaminated"))
            assert ids(before) - dirty <= ids(docs) and dirty
            assert decontaminate.contamination_report(docs, benchmark).where("contaminated").count() == 0
        elif name == "source_mix":
            report = mixing.mix_report(before)
            assert docs.count() == sum(
                r.taken // r.size for r in report.where("size > 0").select("taken", "size").collect())
        else:
            encoder = tokens.Encoder(tokens.TokenFormat(tokenizer_path()))
            import pyarrow as pa
            want = 0
            for r in before.select("text").collect():
                want += len(encoder.encode(pa.array([r.text], pa.string()))[0]) + 1
            assert docs.agg({"n_tokens": "sum"}).first()[0] == want
            assert docs.count() == before.count()


def test_stages_take_an_empty_table(spark):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, table(spark, SF, "documents").limit(0), SF).count() == 0


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))

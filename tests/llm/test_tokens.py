import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from ledgerline.llm import tokens  # noqa: E402
from ledgerline.llm.queries import token_output, tokenizer_path  # noqa: E402
from ledgerline.session import scratch_path  # noqa: E402


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def test_digest_equals_whole_text_encoding(spark, docs, rows, tokenizer):
    got = [tuple(r) for r in token_output(spark, docs).collect()]
    want, start = [], 0
    # Rows that share an id come in the order of their texts.
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = ids_of(tokenizer, r[1])
        want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    key = lambda r: r[1]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_single_document_access_and_dictionary_check(spark, docs, rows, tokenizer):
    folder = scratch_path(spark, "tokens")
    manifest = tokens.write_tokens(docs, folder, tokens.TokenFormat(tokenizer_path()))
    assert manifest.count() >= 1
    (found,) = tokens.read_document(spark, folder, 10)
    assert found.tolist() == ids_of(tokenizer, next(r[1] for r in rows if r[0] == 10))
    assert tokens.read_document(spark, folder, 999_999) == []
    twice = [r[0] for r in rows if r[0] is not None]
    again = next(i for i in twice if twice.count(i) > 1)
    assert len(tokens.read_document(spark, folder, again)) == twice.count(again)
    fs, path = tokens.open_fs(folder)
    with fs.open_output_stream(f"{path}/dictionary.zdict") as out:
        out.write(b"another")
    with pytest.raises(ValueError, match="dictionary"):
        tokens.read_document(spark, folder, 10)


def test_empty_table(spark, empty):
    out = token_output(spark, empty)
    assert out.count() == 0 and out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_encoder_cache_reset_changes_nothing(monkeypatch, tokenizer):
    import pyarrow as pa
    texts = ["alpha beta, gamma. Alpha", "été naïve; alpha!", None, "x" * 5000, "a  b\n\nc"]
    encoder = tokens.Encoder(tokens.TokenFormat(tokenizer_path()))
    monkeypatch.setattr(tokens, "CACHE_WORDS", 1)
    for part in (texts, texts[::-1]):
        ids, ends = encoder.encode(pa.array(part, pa.string()))
        for k, t in enumerate(part):
            assert ids[ends[k]:ends[k + 1]].tolist() == ids_of(tokenizer, t)[:-1]
    sliced, ends = encoder.encode(pa.array(["skip me", *texts], pa.string())[1:])
    assert len(ends) == len(texts) + 1 and sliced[:ends[1]].tolist() == ids_of(tokenizer, texts[0])[:-1]


def test_hot_id_is_divided(spark):
    """90 % of the rows have no id: no shard gets more than its share."""
    df = spark.range(0, 4000, 1, 8).selectExpr(
        "IF(id % 10 = 0, id, NULL) AS doc_id", "concat(md5(string(id)), ' words') AS text")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = tokens.write_tokens(df, scratch_path(spark, "tokens"), tokens.TokenFormat(tokenizer_path()))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    sizes = [r["n_docs"] for r in manifest.collect()]
    assert sum(sizes) == 4000 and len(sizes) == 8 and max(sizes) < 2 * 4000 / 8


def test_encoders_start_no_threads(monkeypatch):
    """Each thread of each worker would keep memory of its own."""
    import os

    from ledgerline.llm.queries import tokenizer_path

    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    tokens.Encoder(tokens.TokenFormat(tokenizer_path()))
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"


def test_driver_needs_no_encoder(spark, docs, monkeypatch):
    """The dictionary is trained in a task; the driver holds no tokenizer."""
    want = token_output(spark, docs).count()
    monkeypatch.setattr(tokens, "Encoder", None)
    assert token_output(spark, docs).count() == want


def test_dictionary_of_a_sample(spark, empty):
    rows = [(k, " ".join(f"word{(k * j) % 977}" for j in range(200))) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    fmt, sample = tokens.TokenFormat(tokenizer_path()), tokens.DictionarySample()
    trained = tokens.train_dictionary(docs, fmt, sample)
    assert isinstance(trained, bytes) and 0 < len(trained) <= sample.dictionary_bytes
    assert tokens.train_dictionary(docs, fmt, sample) == trained
    assert tokens.train_dictionary(docs.limit(2), fmt, sample) == b""
    assert tokens.train_dictionary(empty.select("doc_id", "text"), fmt, sample) == b""

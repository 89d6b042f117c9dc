import random

import pytest
from pyspark.sql import types as T

# Input columns of the documents table, then columns whose names clash with
# what the operators compute.
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("n_words", T.StringType()),
    T.StructField("kept", T.StringType()), T.StructField("fp", T.StringType()),
    T.StructField("size", T.StringType()), T.StructField("row", T.StringType()),
    T.StructField("label", T.StringType()), T.StructField("shard", T.StringType()),
    T.StructField("first", T.StringType()), T.StructField("toxic", T.StringType())])
EXTRA = ("x",) * 9


def doc(doc_id, text, source="a"):
    return (doc_id, text, "en", source, None if text is None else len(text), *EXTRA)


def prose(rng, words, vocabulary=400):
    return " ".join(f"w{int(rng.paretovariate(0.7)) % vocabulary}" for _ in range(words))


@pytest.fixture(scope="session")
def rows():
    """Edge rows and some prose: nulls, empties, white space only, a very
    long text, repeated rows, copies, ties."""
    rng = random.Random(5)
    out = [doc(1, None), doc(2, ""), doc(3, " \t\n\x0b\x0c\r "), doc(4, "one"), doc(5, "Ünïcode Wörter\x85x y"),
           doc(6, "the end\n\nthe end\n the end\n"), doc(None, "no id here at all", None),
           doc(None, None, None), doc(7, prose(rng, 30_000), "b"),
           doc(8, "same words " * 60), doc(9, "|".join("#*$%&<>" for _ in range(60))),
           doc(10, "<|endoftext|> a<|ENDOFTEXT|>b It's 12 o'clock!!! ÉCOLE Σίσυφος ΣΑΣ ﬁ é")]
    base = prose(rng, 300)
    out += [doc(20 + k, base, "c") for k in range(12)]
    out += [doc(40 + k, base.replace("w3 ", f"z{k} ", 1), "c") for k in range(12)]
    out += [doc(100 + k, prose(rng, rng.randint(1, 400)), rng.choice(["a", "b", "é", "z"])) for k in range(80)]
    return out + [out[4], out[30], out[30]]


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs")) + "/documents.parquet"
    spark.createDataFrame(rows, DOCS).repartition(5, "doc_id").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)

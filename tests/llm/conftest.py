import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

# what operators call their own columns, to be met in the input
CLASHES = ["score", "predicted", "kept", "fp", "component_id", "ids", "decoded", "mix", "dedup", "row", "id", "bucket", "words", "text2"]


def schema(*extra):
    return T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
         T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
        + [T.StructField(c, T.StringType()) for c in extra]
    )


LONG = " ".join(f"w{i % 977}" for i in range(30_000))
TEXTS = [
    "One two three four five six.\nSeven eight nine ten.", "", None, "   \n\t ", "a", "One two three four five six.\nSeven eight nine ten.",
    "Seven eight nine ten.\nAnother line of words here.", "é́ 漢字 😀   naïve — MIT License\x00x", LONG, LONG + " end", "one two three four five six.\nseven",
    "<s> </s> <|endoftext|> \r\n\r\n", "x" * 5000, "Ünïcödé wörds åre hère tö stäy ålways", "a\nb\na\nb\na\nb",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Missing, empty, long and repeated texts, missing and repeated ids, and columns with the operators' own names."""
    rows = [(i, t, "en", "hot" if i % 3 else f"s{i % 5}", len(t or "")) for i, t in enumerate(TEXTS)]
    rows += [rows[0], rows[0], (None, "no id here at all", None, None, None), (None, None, None, None, None), (3, "same id, other text", "de", "hot", 1)]
    return spark.createDataFrame([(*r, *["c"] * len(CLASHES)) for r in rows], schema(*CLASHES)).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], schema(*CLASHES))


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")

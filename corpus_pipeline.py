"""From raw documents to training tokens in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows of ``docs``;
it is written as Parquet and read again for the next. All but the last return
the columns of ``docs``, extra ones included. Empty tables pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityloom.llm.bpe import Codec
from entityloom.llm.common import stored, table
from entityloom.llm.line_dedup import without_repeated_lines
from entityloom.llm.mixing import mixed, mixing_plan
from entityloom.llm.quality import fit_quality, score_quality
from entityloom.llm.simhash_balls import near_groups, with_fingerprints


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose quality score is 0.7 or more; the model is learned from the labels of ``docs``.

    Without a label of a bad document nothing tells which ones are bad, and all
    documents stay. With labels of bad ones only, none stays.
    """
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    # the smoothed share of no label is 0.5, that of good ones is above and that of bad ones below
    if model.constant is not None and model.constant >= 0.5:
        return docs
    scored = score_quality(docs, model, tuple(docs.columns), out="__score", predicted="__predicted")
    return scored.filter("__predicted = 1").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs deleted; a document of which nothing is left goes.

    Where lines went, ``n_chars`` is that of the new text.
    """
    cleaned = without_repeated_lines(docs, out="__dedup")
    changed = F.col("__dedup.n_removed") > 0
    rest = cleaned.filter(~changed | (F.col("__dedup.n_removed") < F.col("__dedup.n_lines")))
    new = {
        "text": F.when(changed, F.col("__dedup.text")).otherwise(F.col("text")),
        "n_chars": F.when(changed, F.char_length("__dedup.text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType),
    }
    return rest.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash links (four-word shingles, four bits) stays, the one with the smallest id.

    Rows are told apart by a hash of all columns; of rows alike in all of them one stays.
    """
    rows = docs.withColumn("__row", F.xxhash64(*docs.columns))
    grouped = near_groups(with_fingerprints(rows, ("doc_id", "__row"), out="__fp"), radius=4, fp_col="__fp")
    # ids come in order before rows without an id
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row")).alias("first")
    # the group of documents without any id has no component id
    group = F.when(F.col("component_id").isNull(), F.col("__fp"))
    stay = grouped.groupBy("component_id", group.alias("__group")).agg(first).select("first.doc_id", F.col("first.__row").alias("__row"))
    stay = stored(stay).select(F.col("doc_id").alias("__id"), F.col("__row").alias("__kept"))
    met = rows.join(stay, (F.col("__row") == F.col("__kept")) & F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
    return met.dropDuplicates(["doc_id", "__row"]).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once or, in epochs of a smaller source, twice: no source is repeated more than twice."""
    return mixed(docs, mixing_plan(docs, max_repeats=2.0))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, and whether they decode to its text."""
    codec = Codec(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rows = docs.select("doc_id", "lang", "source", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("sha"), "text")
    decoded = codec.round_trip(rows, keep=("doc_id", "lang", "source", "sha"))
    return decoded.select(
        "doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
        (F.sha2(F.col("decoded").cast("binary"), 256) == F.col("sha")).alias("round_trip"),
    )


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("tokens", encode_tokens),
]

# a learned score, XXH64 fingerprints and BPE are beyond SQL; tests hold every stage against a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

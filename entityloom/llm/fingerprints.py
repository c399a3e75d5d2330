"""SimHash fingerprints and their search, in DataFrame functions only.

**Votes.** Terms are pairs of neighbouring words (and the last word alone), a
term votes once for every time it occurs, so its weight is its frequency, and
every bit of its hash votes plus or minus. A text is exploded into its terms
and 32 sums count the votes of 64 bits, two bits in one long; the sums are
taken in the task that holds the text, so no term is shuffled if the rows are
already dealt by (part of) the grouping key.

**Search.** The 64 bits are cut into ``radius + 2`` blocks. Two fingerprints
within the radius agree in at least two of them, so there is one table for
every pair of blocks, keyed by the bits of the pair; what meets in a table is
compared by Hamming distance, and counts only in the first table where it
meets. Nothing within the radius is missed.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entityloom.llm.common import stored, text_or_empty

BITS = 64
_TWO_BITS = (1 << 32) + 1
# Rows of one bucket of neighbouring ids, about; and the most buckets, which bounds what is broadcast.
BUCKET_ROWS = 256
MAX_BUCKETS = 100_000


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprints(rows: DataFrame, keys: list[str], text_col: str, out: str = "fingerprint") -> DataFrame:
    """The ``keys`` columns, ``n_terms`` and the fingerprint of every text as a long.

    Missing, empty and blank texts have no terms and fingerprint 0. Rows that
    are alike in all keys and in the text give as many alike rows; where
    ``keys`` hold the columns the rows are dealt by, nothing is shuffled.
    """
    words = F.array_remove(F.split(text_or_empty(text_col), r"[ \t\n\x0B\f\r]+"), "")
    # a text without words has one term without words, so that its row stays
    pairs = F.arrays_zip(words.alias("a"), F.slice(words, 2, F.greatest(F.size(words), F.lit(1))).alias("b"))
    terms = F.when(F.size(words) > 0, pairs).otherwise(F.array(F.struct(F.lit(None).cast("string").alias("a"), F.lit(None).cast("string").alias("b"))))
    exploded = rows.select(*keys, F.xxhash64(text_or_empty(text_col)).alias("__text"), F.posexplode(terms).alias("__at", "__term"))
    voting = exploded.select(
        *keys, "__text", "__at", F.col("__term.a").isNotNull().alias("__votes"), F.xxhash64("__term.a", "__term.b").alias("__hash")
    )
    votes = [
        f"sum(CASE WHEN __votes THEN shiftright(__hash, {k}) & {_TWO_BITS}L ELSE 0L END) AS __v{k}" for k in range(BITS // 2)
    ]
    counted = voting.groupBy(*keys, "__text").agg(
        F.expr("count_if(__votes)").alias("__n"), F.expr("count_if(__at = 0)").alias("__copies"), *[F.expr(v) for v in votes]
    )
    low = [f"CASE WHEN 2 * (__v{k} & 4294967295L) > __n THEN {1 << k}L ELSE 0L END" for k in range(32)]
    high = [f"CASE WHEN 2 * shiftright(__v{k}, 32) > __n THEN shiftleft(1L, {k + 32}) ELSE 0L END" for k in range(32)]
    # joined by "or": bits do not overlap
    print_ = F.expr(" | ".join([*low, *high]))
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__copies")))
    return (
        counted.select(*keys, (F.col("__n") / F.col("__copies")).cast("bigint").alias("n_terms"), print_.alias(out), copies.alias("__copy")).drop("__copy")
    )


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def as_hex(column: str) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def _tables(radius: int) -> list[int]:
    """Masks of the block tables."""
    blocks, n = [], radius + 2
    for i in range(n):
        low, high = BITS * i // n, BITS * (i + 1) // n
        blocks.append(((1 << (high - low)) - 1) << low)
    return [_signed(a | b) for a, b in combinations(blocks, 2)]


def count_near(prints: DataFrame, queries: DataFrame, radius: int = 3, column: str = "fingerprint") -> DataFrame:
    """For each distinct fingerprint of ``queries``: ``n_near``, the rows of ``prints`` within the radius (0 to 6).

    Alike fingerprints are searched once and count as often as they occur.
    Missing ones are left out of both sides.
    """
    masks = _tables(radius)
    keyed = F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("table", "key")
    distinct = stored(prints.select(F.col(column).alias("fp")).filter("fp IS NOT NULL").groupBy("fp").agg(F.count(F.lit(1)).alias("n")))
    asked = queries.select(F.col(column).alias("fp")).filter("fp IS NOT NULL").distinct()
    entries, probes = distinct.select("fp", "n", keyed), asked.select("fp", keyed)
    difference = entries["fp"].bitwiseXOR(probes["fp"])
    first = F.coalesce(*[F.when(difference.bitwiseAND(F.lit(m)) == 0, F.lit(t)) for t, m in enumerate(masks)])
    met = probes.join(
        entries,
        (probes["table"] == entries["table"]) & (probes["key"] == entries["key"]) & (F.bit_count(difference) <= radius) & (first == probes["table"]),
    )
    return met.groupBy(probes["fp"].alias(column)).agg(F.sum("n").alias("n_near"))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row in descending order of its id with the text of the next one (after the last: the first).

    Columns ``bucket, visiting, id, order_hash, text, next_text``. Rows of
    neighbouring ids share a bucket, and only buckets are sorted; the first
    row of the next bucket visits (``visiting``) so that the last one of its
    own finds its neighbour. Buckets are equal ranges of ids, so ids should be
    spread somewhat evenly. Rows without an id come last, in buckets by text
    hash. Equal ids are in the order of their text's hash.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), text_or_empty(text_col).alias("text"))
    n, low, high = docs.select(F.col(id_col).cast("bigint").alias("id")).agg(F.count(F.lit(1)), F.min("id"), F.max("id")).first()
    buckets = max(1, min(MAX_BUCKETS, -(-n // BUCKET_ROWS)))
    low, high = (0, 0) if low is None else (low, high)
    width = (float(high) - float(low) + 1) / buckets
    hashed = rows.withColumn("order_hash", F.xxhash64("text"))
    place = F.when(F.col("id").isNotNull(), F.floor((F.col("id").cast("double") - F.lit(float(low))) / F.lit(width))).otherwise(
        F.lit(-1).cast("bigint") - F.pmod("order_hash", F.lit(buckets))
    )
    placed = hashed.withColumn("own", place)
    # at most 2 * MAX_BUCKETS + 1 rows: one for each bucket, with its first row and the bucket before it
    tops = placed.groupBy("own").agg(F.max("id").alias("top_id"), F.min("order_hash").alias("top_hash"))
    order = Window.orderBy(F.col("own").desc())
    whole = Window.orderBy(F.col("own").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tops = tops.select("*", F.coalesce(F.lag("own").over(order), F.last("own").over(whole)).alias("visited"))
    first = F.col("id").eqNullSafe(F.col("top_id")) & (F.col("id").isNotNull() | (F.col("order_hash") == F.col("top_hash")))
    stay = F.struct(F.col("own").alias("bucket"), F.lit(False).alias("visiting"))
    visit = F.struct(F.col("visited").alias("bucket"), F.lit(True).alias("visiting"))
    dealt = placed.join(F.broadcast(tops), "own").select(
        F.explode(F.when(first, F.array(stay, visit)).otherwise(F.array(stay))).alias("at"), "id", "order_hash", "text"
    )
    down = Window.partitionBy("bucket").orderBy("visiting", F.col("id").desc_nulls_last(), "order_hash")
    return dealt.select("at.*", "id", "order_hash", "text").select("*", F.lead("text").over(down).alias("next_text"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's fingerprint, that of its edited text, and the likeness to it and to the next row.

    The edited text is the text with its last half (``floor(n_chars / 2)``
    code points) replaced by the first as many of the next row's. Every row
    gives one row; rows alike in id and text are alike in all but, where the
    next row differs, the edited text. An empty table gives an empty result;
    the next row of a single one is itself.
    """
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.expr("substring(text, 1, n_chars - floor(n_chars / 2))"), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    rows = with_next(docs, id_col, text_col).withColumn("n_chars", F.char_length("text").cast("bigint"))
    rows = rows.withColumn("edited", edited).withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    own = F.struct(F.lit(0).alias("version"), F.col("text").alias("body"))
    changed = F.struct(F.lit(1).alias("version"), F.col("edited").alias("body"))
    versions = rows.select(
        "bucket", "visiting", "id", "order_hash", "n_chars", "edited_sha256",
        F.explode(F.when(F.col("visiting"), F.array(own)).otherwise(F.array(own, changed))).alias("v"),
    ).select("bucket", "visiting", "id", "order_hash", "n_chars", "edited_sha256", "v.version", "v.body")
    keys = ["bucket", "visiting", "id", "order_hash", "n_chars", "edited_sha256"]
    printed = fingerprints(versions, [*keys, "version"], "body", "fp")
    # one row per row again: alike rows meet and part with their count
    paired = printed.groupBy(*keys).agg(
        F.max(F.when(F.col("version") == 0, F.col("fp"))).alias("fingerprint"),
        F.max(F.when(F.col("version") == 1, F.col("fp"))).alias("edited_fingerprint"),
        F.count(F.when(F.col("version") == 0, F.lit(1))).alias("copies"),
    )
    each = paired.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy"))
    down = Window.partitionBy("bucket").orderBy("visiting", F.col("id").desc_nulls_last(), "order_hash", "edited_sha256")
    near = each.withColumn("next_fingerprint", F.lead("fingerprint").over(down)).filter(~F.col("visiting"))
    return near.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )

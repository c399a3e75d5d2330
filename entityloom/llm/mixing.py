"""Mixing sources to target weights by temperature, in DataFrame functions only.

The weight of a source is its share of the words raised to an exponent between
1 (the natural mix) and 0 (all sources alike), normalised. The exponent is
found by repeated section on a grid of 2^-20: the smallest one whose weights
repeat no source more than ``max_repeats`` times, or the largest one whose
weights have the ``target_entropy``. Every step is one aggregation over one row
per source that tries 15 exponents at once.

A source's weight of the budget is realised as whole epochs and a part of one.
Documents are dealt to blocks by a hash; each epoch is a permutation of the
blocks by a hash of epoch and block, and the part takes blocks in that order
until its budget is used up. The block in which that happens is divided at a
document. So one row per source (epochs, the last block and the last document)
decides about all documents where they are: no text is moved, no source is
sorted, and a source with a third of all rows is only summed by block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entityloom.llm.common import stored, text_or_empty

GRID = 1 << 20
BLOCK_ROWS = 2048
# Plans of so many sources are broadcast (some tens of bytes each); more are joined by shuffle.
BROADCAST_SOURCES = 100_000


def _hash_of(*parts: Column) -> Column:
    """60 bits of the md5 of the parts as text, as a long."""
    joined = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(joined.cast("binary")), 1, 15), 16, 10).cast("bigint")


def word_count(column: str) -> Column:
    return F.size(F.array_remove(F.split(text_or_empty(column), r"[ \t\n\x0B\f\r]+"), "")).cast("bigint")


def _fits(sources: DataFrame, low: int, high: int, good) -> int:
    """The smallest grid exponent in ``(low, high]`` that is good; ``high`` is, and all above a good one are."""
    while high - low > 1:
        tried = sorted({low + (high - low) * i // 16 for i in range(1, 16)} - {low, high})
        exponents = F.explode(F.array(*[F.lit(t) for t in tried])).alias("step")
        rows = sources.select("share", exponents).withColumn("a", F.col("step") / F.lit(float(GRID)))
        found = rows.groupBy("step").agg(
            F.sum(F.pow("share", "a")).alias("z"),
            F.sum(F.pow("share", "a") * F.log("share")).alias("l"),
            F.max(F.pow("share", F.col("a") - 1)).alias("most"),
            F.min(F.pow("share", F.col("a") - 1)).alias("least"),
        )
        verdict = {r["step"]: good(r) for r in found.collect()}  # at most 15 rows
        low = max([low, *[t for t in tried if not verdict[t]]])
        high = min([high, *[t for t in tried if verdict[t]]])
    return high


def exponent(sources: DataFrame, max_repeats: float | None, target_entropy: float | None, budget: float | None) -> float:
    """The exponent for sources with a ``share`` above 0 each; of both limits the repetition limit comes first. Without sources 1."""
    least = 0
    if not sources.take(1):
        return 1.0
    if max_repeats is not None:

        def bounded(r) -> bool:
            repeats = r["most"] / r["least"] if budget is None else r["most"] * budget / r["z"]
            return repeats <= max_repeats * (1 + 1e-12)

        least = _fits(sources, -1, GRID, bounded)
    if target_entropy is None:
        return least / GRID
    import math

    # the first exponent with too little entropy, less one step
    over = _fits(sources, -1, GRID + 1, lambda r: math.log(r["z"]) - r["step"] / GRID * r["l"] / r["z"] < target_entropy)
    return max(least, over - 1, 0) / GRID


def mixing_plan(
    docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", max_repeats: float | None = 2.0,
    target_entropy: float | None = None, budget: int | None = None, seed: int = 17,
) -> DataFrame:
    """One stored row per source: words, weight, target and what is taken.

    ``budget`` is in words; without one it is the smallest at which no source
    loses a document. A missing source is a source. Sources without any word
    have weight 0 and are taken once.
    """
    blocks = max(1, docs.count() // BLOCK_ROWS)
    key = _hash_of(F.lit(seed), F.col(id_col))
    words = docs.select(
        F.col(source_col).cast("string").alias("source"), key.alias("key"), (key % blocks).alias("block"), word_count(text_col).alias("words")
    )
    # about one row for BLOCK_ROWS documents
    by_block = stored(words.groupBy("source", "block").agg(F.sum("words").alias("words"), F.count(F.lit(1)).alias("rows")))
    totals = stored(by_block.groupBy("source").agg(F.sum("words").alias("words"), F.sum("rows").alias("rows")))
    total = totals.agg(F.sum("words")).first()[0] or 0
    shares = totals.filter("words > 0").withColumn("share", F.col("words") / F.lit(float(total or 1)))
    alpha = exponent(shares, max_repeats, target_entropy, budget / total if budget is not None and total else None)
    power = shares.select("source", "words", "rows", "share", F.pow("share", F.lit(alpha)).alias("power"))
    z, top = power.agg(F.sum("power"), F.max("share")).first()
    weighed = power.withColumn("weight", F.col("power") / F.lit(float(z or 1)))
    if budget is None:
        exact = F.round(F.lit(float(total)) * F.lit(float(top or 1) ** (1.0 - alpha)) * F.col("power")).cast("bigint")
        target = F.greatest("words", exact)
    else:
        target = F.round(F.col("weight") * F.lit(float(budget))).cast("bigint")
    wanted = stored(
        weighed.select("source", "words", "rows", "weight", target.alias("target")).select(
            "*", F.floor(F.col("target") / F.col("words")).alias("epochs"), F.pmod("target", "words").alias("part")
        )
    )
    place = _hash_of(F.lit(seed), F.col("epochs"), F.col("block"))
    order = Window.partitionBy("source").orderBy("place", "block")
    ordered = (
        by_block.join(wanted.select(F.col("source").alias("s"), "epochs", "part"), F.col("source").eqNullSafe(F.col("s")))
        .withColumn("place", place)
        .withColumn("through", F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    )
    divided = (
        ordered.filter("through > part")
        .groupBy("source")
        .agg(F.min(F.struct("place", "block", (F.col("part") - F.col("through") + F.col("words")).alias("left"))).alias("last"))
        .select(F.col("source").alias("s"), F.col("last.place").alias("last_place"), F.col("last.block").alias("last_block"), F.col("last.left").alias("left_words"))
    )
    divided = stored(divided)
    inside = words.join(_small(divided), F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("last_block")))
    # the rows of one block for each source; alike keys stay together
    through = F.sum("words").over(Window.partitionBy("source").orderBy("key"))
    last_key = inside.withColumn("through", through).filter("through <= left_words").groupBy(F.col("source").alias("k")).agg(F.max("key").alias("last_key"))
    plan = (
        totals.select("source", "words", "rows")
        .join(wanted.select(F.col("source").alias("w"), "weight", "target", "epochs"), F.col("source").eqNullSafe(F.col("w")), "left")
        .join(divided, F.col("source").eqNullSafe(F.col("s")), "left")
        .join(last_key, F.col("source").eqNullSafe(F.col("k")), "left")
    )
    return stored(
        plan.select(
            "source", "words", "rows", F.coalesce("weight", F.lit(0.0)).alias("weight"), F.coalesce("target", F.lit(0)).cast("bigint").alias("target"),
            F.coalesce("epochs", F.lit(1)).cast("bigint").alias("epochs"), "last_place", "last_block", "last_key",
            F.lit(blocks).cast("bigint").alias("blocks"), F.lit(seed).alias("seed"), F.lit(alpha).alias("exponent"),
        )
    )


def _small(per_source: DataFrame) -> DataFrame:
    """Broadcast a table of one row per source if it is known to be small."""
    return F.broadcast(per_source) if per_source.count() <= BROADCAST_SOURCES else per_source


def with_copies(docs: DataFrame, plan: DataFrame, source_col: str = "source", id_col: str = "doc_id", out: str = "mix") -> DataFrame:
    """All columns of the documents, and a struct ``out`` with the weight of their source and how often each is taken.

    The order of the mix is that of ``(epoch, place of the block, key)``, see
    ``mixed``. Rows with one id (or none) in one source share their fate. An
    empty table gives an empty result; an input column named ``out`` is replaced.
    """
    columns = [c for c in docs.columns if c != out]
    packed = docs.select(F.struct(*columns).alias("doc"), F.col(source_col).cast("string").alias("__of"), F.col(id_col).alias("__id"))
    joined = packed.join(_small(plan), F.col("__of").eqNullSafe(F.col("source")))
    key = _hash_of(F.col("seed"), F.col("__id"))
    block = key % F.col("blocks")
    place = _hash_of(F.col("seed"), F.col("epochs"), block)
    before = (place < F.col("last_place")) | ((place == F.col("last_place")) & (block < F.col("last_block")))
    divided = (block == F.col("last_block")) & (key <= F.col("last_key"))
    more = F.when(F.coalesce(before, F.lit(False)) | F.coalesce(divided, F.lit(False)), F.lit(1)).otherwise(F.lit(0))
    mix = F.struct("weight", (F.col("epochs") + more).alias("copies"), block.alias("block"), key.alias("key"), "seed")
    return joined.select(*[F.col("doc")[c].alias(c) for c in columns], mix.alias(out))


def mixed(docs: DataFrame, plan: DataFrame, source_col: str = "source", id_col: str = "doc_id", places: bool = False) -> DataFrame:
    """Every document as often as the plan takes it, with the columns of ``docs``.

    With ``places`` also ``mix_epoch`` and ``mix_place``: sorted by epoch,
    place and id, the rows are the block permutations.
    """
    rows = with_copies(docs, plan, source_col, id_col, "__mix").filter("__mix.copies > 0")
    epochs = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__mix.copies") - 1)).alias("__epoch")
    each = rows.select(*docs.columns, "__mix", epochs)
    place = _hash_of(F.col("__mix.seed"), F.col("__epoch"), F.col("__mix.block"))
    extra = [F.col("__epoch").alias("mix_epoch"), place.alias("mix_place")] if places else []
    return each.select(*docs.columns, *extra)

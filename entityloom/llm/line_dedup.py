"""Deleting later copies of repeated line runs, in DataFrame functions only.

The documents in the order of their ids are one sequence of lines. Prefix
doubling gives every place a class for each power of two: places are in one
class of level k if the ``2^k`` lines from there on are the same, which is to
say, if their suffixes lie in one interval of the suffix array whose longest
common prefix is at least ``2^k``. A class is named by its first place, so its
name is the rank that tells equality and at once where the first copy is; the
order among classes is never needed, and so nothing is sorted. Level k + 1
joins the classes at a place and ``2^k`` lines further; places whose run occurs
once drop out, and the levels end where no run is repeated.

The longest run at a place that occurs earlier, too, has from ``2^k`` to less
than ``2^(k+1)`` lines for the largest k with an earlier copy. Its first and its
last ``2^k`` lines are runs of level k that occur earlier; where both have
``min_words`` words they cover it. For all other places (short or empty lines)
the interval is refined: ``longest_runs`` halves the range of its length, from
``2^(k-1)`` lines down to one, by the classes of those levels. So every maximal
repeated run of ``min_words`` words or more loses its later copies, whatever its
number of lines.

Lines are compared by 128 bits of hash. Only hashes are moved until the end,
where the runs to delete meet the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entityloom.llm.common import stored, text_or_empty
from entityloom.operators.ordering import number_rows

MIN_WORDS = 3
# A place is the number of the document and, in the lower bits, of the line.
_LINE_BITS = 27
# A class of so many places is hot, or one with this share of them: at most 10,000 classes are.
_HOT, _HOT_SHARE = 200_000, 10_000


def _words(line: Column) -> Column:
    return F.size(F.array_remove(F.split(line, r"[ \t\n\x0B\f\r]+"), ""))


def _meet(rows: DataFrame, classes: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` joined with their class; ``classes`` are stored, one row for each key, with their size ``n``.

    The few hot classes are broadcast to their rows; all others are joined by an exchange.
    """
    total, largest = classes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    limit = max(_HOT, total // _HOT_SHARE)
    if largest < limit:
        return rows.join(classes.drop("n"), keys)
    hot = classes.filter(F.col("n") >= limit)
    named = [c for c in classes.columns if c not in (*keys, "n")]
    marked = rows.join(F.broadcast(hot.select(*keys, F.struct(*named).alias("__hot"))), keys, "left")
    cold = marked.filter("__hot IS NULL").drop("__hot").join(classes.drop("n"), keys)
    return cold.unionByName(marked.filter("__hot IS NOT NULL").select(*rows.columns, *[F.col("__hot")[c].alias(c) for c in named]))


def _of_class(places: DataFrame, keys: list[str]) -> DataFrame:
    """``g, c, w``: each place whose keys occur again, with the first place of them."""
    classes = stored(places.groupBy(*keys).agg(F.min("g").alias("c"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    return stored(_meet(places, classes, keys).select("g", "c", "w"))


def longest_runs(levels: list[DataFrame], min_words: int) -> DataFrame | None:
    """``g, n``: the longest runs that occur earlier, for places whose runs of a power of two may not cover them.

    A row is a place ``g`` in the class ``c`` of its ``n`` lines, ``mine`` where ``n`` is
    the longest length known to occur earlier than ``g``; the others answer for them.
    """
    earlier = [x.filter("c < g") for x in levels]
    rows = None
    for k in range(1, len(levels)):
        asked = earlier[k]
        if k + 1 < len(levels):
            asked = asked.join(earlier[k + 1].select("g"), "g", "left_anti")
        # the line behind; where it has no earlier copy the run ends
        behind = earlier[0].select((F.col("g") - (1 << k)).alias("g"), F.col("w").alias("v"))
        asked = stored(asked.join(behind, "g").filter((F.col("w") < min_words) | (F.col("v") < min_words)).select("g", "c"))
        if asked.take(1):
            classes = asked.groupBy("c").agg(F.lit(True).alias("asked"))
            members = levels[k].join(classes, "c").drop("asked").join(asked.select("g", F.lit(True).alias("m")), "g", "left")
            members = members.select("g", F.lit(1 << k).cast("bigint").alias("n"), "c", "w", F.col("m").isNotNull().alias("mine"))
            rows = members if rows is None else rows.union(members)
    if rows is None:
        return None
    rows = stored(rows)
    for j in range(len(levels) - 2, -1, -1):
        # each row's next 2^j lines, where they are repeated at all
        further = levels[j].select(F.col("g").alias("h"), F.col("c").alias("y"), F.col("w").alias("v"))
        longer = rows.filter(F.col("n") >= 2 << j).withColumn("h", F.col("g") + F.col("n")).join(further, "h")
        longer = longer.select("g", "n", "c", "y", (F.col("w") + F.col("v")).alias("w"), "mine")
        found = longer.groupBy("n", "c", "y").agg(F.min("g").alias("f"), F.max(F.when(F.col("mine"), F.col("g"))).alias("last"), F.count(F.lit(1)).alias("__n"))
        # only where a place that asks has an earlier copy
        found = stored(found.filter("last > f").select("n", "c", "y", "f", "__n").withColumnsRenamed({"n": "length", "__n": "n"}))
        if not found.take(1):
            continue
        grown = _meet(longer.withColumnRenamed("n", "length"), found, ["length", "c", "y"])
        grown = stored(grown.select("g", (F.col("length") + (1 << j)).alias("n"), F.col("f").alias("c"), "w", (F.col("mine") & (F.col("f") < F.col("g"))).alias("mine")))
        moved = grown.filter("mine").select("g", F.lit(True).alias("moved"))
        stay = rows.join(moved, "g", "left").withColumn("mine", F.col("mine") & F.col("moved").isNull()).drop("moved")
        rows = stored(stay.union(grown.select(*stay.columns)))
    return rows.filter(F.col("mine") & (F.col("w") >= min_words)).select("g", "n")


def repeated_runs(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``g, n``: places of later copies and their length, for all lines ``g, a, b, w``.

    ``a`` and ``b`` identify the line, ``w`` is its number of words.
    """
    level, length = _of_class(lines, ["a", "b"]), 1
    levels, found = [], []
    while level.take(1):
        levels.append(level)
        found.append(level.filter((F.col("c") < F.col("g")) & (F.col("w") >= min_words)).select("g", F.lit(length).cast("bigint").alias("n")))
        further = level.select((F.col("g") - length).alias("g"), F.col("c").alias("y"), F.col("w").alias("v"))
        pairs = level.join(further, "g").select("g", F.col("c").alias("x"), "y", (F.col("w") + F.col("v")).alias("w"))
        level, length = _of_class(pairs, ["x", "y"]), 2 * length
    refined = longest_runs(levels, min_words)
    if refined is not None:
        found.append(refined)
    runs = lines.select("g", F.lit(1).cast("bigint").alias("n")).limit(0)
    for f in found:
        runs = runs.union(f)
    return runs


def without_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, out: str = "dedup"
) -> DataFrame:
    """All columns, and a struct ``out`` with ``text``, ``n_lines`` and ``n_removed``.

    The first copy stays: the one in the document with the smallest id (none
    comes last), and there the first. Missing and empty texts are one empty
    line, which has no words and stays unless a longer run holds it. Rows
    alike in all columns are one document and are treated alike; documents
    with one id and different contents are ordered by a hash. An empty table
    gives an empty result. ``docs`` is read twice, so it should be a table.
    """
    columns = [c for c in docs.columns if c != out]
    rows = docs.select(*columns, F.xxhash64(*columns).alias("__h1"), F.xxhash64(F.lit(1013), *columns).alias("__h2"))
    split = F.split(text_or_empty(text_col), "\n", -1)
    described = F.transform(
        split, lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(2027), x).alias("b"), _words(x).cast("bigint").alias("w"))
    )
    per_doc = rows.select(F.col(id_col).alias("id"), "__h1", "__h2", described.alias("lines")).dropDuplicates(["__h1", "__h2"])
    per_doc = stored(per_doc)
    numbers = stored(number_rows(per_doc.select("id", "__h1", "__h2"), [F.col("id").asc_nulls_last(), "__h1", "__h2"], "doc").drop("id"))
    exploded = per_doc.join(numbers, ["__h1", "__h2"]).select("doc", F.posexplode("lines").alias("line", "of"))
    place = F.shiftleft("doc", _LINE_BITS) + F.col("line")
    lines = stored(exploded.select(place.alias("g"), "of.a", "of.b", "of.w"))
    runs = repeated_runs(lines, min_words)
    # a run opens at its first place and closes behind its last; what is open is deleted
    events = runs.select("g", F.lit(1).alias("d")).union(runs.select((F.col("g") + F.col("n")).alias("g"), F.lit(-1).alias("d")))
    events = events.groupBy("g").agg(F.sum("d").alias("d")).withColumn("doc", F.shiftright("g", _LINE_BITS))
    along = Window.partitionBy("doc").orderBy("g")  # the places of one document
    stretches = (
        events.select("doc", "g", F.lead("g").over(along).alias("end"), F.sum("d").over(along.rowsBetween(Window.unboundedPreceding, 0)).alias("open"))
        .filter("open > 0")
        .withColumn("from", F.col("g").bitwiseAND(F.lit((1 << _LINE_BITS) - 1)).cast("int"))
        .withColumn("to", (F.col("from") + F.col("end") - F.col("g")).cast("int"))
    )
    gone = stretches.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("from", "to"))).alias("gone"))
    decided = stored(numbers.join(gone, "doc").select("__h1", "__h2", "gone"))
    joined = rows.join(decided, ["__h1", "__h2"], "left")
    n = F.size("__lines")
    # what lies between the stretches stays
    starts = F.concat(F.array(F.lit(0)), F.transform("gone", lambda r: r["to"]))
    stops = F.concat(F.transform("gone", lambda r: r["from"]), F.array(n))
    kept = F.flatten(F.transform(F.arrays_zip(starts.alias("s"), stops.alias("e")), lambda r: F.slice("__lines", r["s"] + 1, r["e"] - r["s"])))
    removed = F.aggregate("gone", F.lit(0), lambda total, r: total + r["to"] - r["from"])
    text = F.when(F.col("gone").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    result = F.struct(text.alias("text"), n.cast("bigint").alias("n_lines"), F.coalesce(removed, F.lit(0)).cast("bigint").alias("n_removed"))
    return joined.withColumn("__lines", split).select(*columns, result.alias(out))

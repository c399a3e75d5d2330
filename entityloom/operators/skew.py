"""Joining a table to facts about its keys when one key may hold much of the table.

A join or a window sends every row of a key to one task. Adaptive execution
splits such a task only if both join sides come straight from a shuffle and
nothing groups by the key afterwards; facts that come out of a grouping are
not such a side. So hot keys are looked for first, in one pass over the key
columns that moves no row. Their rows take a broadcast join, in place; all
others take the ordinary join. Which way a key goes does not change the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityloom.schema import is_numeric, is_text, quoted

# A key is hot from this many rows on.
HOT_ROWS = 5_000_000
# At most this many keys are followed, and fewer if their facts are wide: those
# of all hot keys fit into HOT_BYTES. A key with more than about 1.5 / HOT_KEYS
# of the rows is always found.
HOT_KEYS = 20_000
HOT_BYTES = 64 * 1024 * 1024
_TEXT_BYTES = 256


def _hash_of(keys: Sequence[str], rows: DataFrame, facts: DataFrame) -> str:
    """SQL of a hash on which equal keys of both tables agree."""
    parts = []
    for k in keys:
        a, b = rows.schema[k].dataType, facts.schema[k].dataType
        if a == b:
            parts.append(quoted(k))
        elif is_numeric(a) and is_numeric(b):
            parts.append(f"CAST({quoted(k)} AS DOUBLE)")
        else:
            raise ValueError(f"key {k} is {a.simpleString()} on one side and {b.simpleString()} on the other")
    return f"xxhash64({', '.join(parts)})"


def _present(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(quoted(k)).isNotNull() for k in keys])


def hot_hashes(df: DataFrame, hash_: str, hot_rows: int, followed: int) -> list[int]:
    """Hashes of the keys with at least ``hot_rows`` rows: a sketch per task, merged."""
    top = df.agg(F.expr(f"approx_top_k({hash_}, {followed}, {followed})").alias("top")).first()["top"]
    return [item["item"] for item in top if item["count"] >= hot_rows]


def attach_by_key(
    rows: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    measured: DataFrame | None = None,
) -> DataFrame:
    """``rows`` joined to ``facts``, which has one row per key; ``inner`` or ``left``.

    Hot keys are looked for in ``measured``, by default in ``rows``: a table
    with the same keys that is cheaper to read.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    keys = list(keys)
    added = [c for c in facts.columns if c not in keys]
    out = [F.col(quoted(c)) for c in [*rows.columns, *added]]
    known = rows.filter(_present(keys))
    hash_ = _hash_of(keys, rows, facts)
    width = 16 + sum(_TEXT_BYTES if is_text(f.dataType) else 8 for f in facts.schema)
    followed = max(100, min(HOT_KEYS, HOT_BYTES // width))
    hot = hot_hashes((rows if measured is None else measured).filter(_present(keys)), hash_, hot_rows, followed)
    if hot:
        is_hot = f"{hash_} IN ({', '.join(map(str, hot))})"
        warm = known.filter(is_hot).join(F.broadcast(facts.filter(is_hot)), keys, how).select(*out)
        cold = known.filter(f"NOT {is_hot}").join(facts.filter(f"NOT {is_hot}"), keys, how).select(*out)
        joined = warm.unionAll(cold)
    else:
        joined = known.join(facts, keys, how).select(*out)
    if how == "inner":
        return joined
    # rows without a key match nothing, and would all meet in one task of the join
    alone = rows.filter(~_present(keys)).select("*", *[F.lit(None).cast(facts.schema[c].dataType).alias(c) for c in added])
    return joined.unionAll(alone)


def expand_left(
    base: DataFrame, children: DataFrame, key: str, orphans: bool = False, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``base`` left joined to its children: one row per child, or one without any.

    With ``orphans`` children without a base row stay too (a full join). Built
    from the children's side, so that the base is looked up for the hot keys
    of the children and their rows are not shuffled; a left or full join could
    not split them.
    """
    columns = [F.col(quoted(c)) for c in [*base.columns, *[c for c in children.columns if c != key]]]
    how = "left" if orphans else "inner"
    with_child = attach_by_key(children, base, [key], how, hot_rows).select(*columns)
    alone = base.join(children.select(key).distinct(), key, "left_anti")
    return with_child.unionByName(alone, allowMissingColumns=True)

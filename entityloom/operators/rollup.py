"""Group statistics, rollups through a key hierarchy, and group facts on rows.

Every rollup is one ``groupBy`` with all its statistics, so a child table is
shuffled once and only after partial aggregation: a key that holds a third of
all rows reaches the shuffle as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityloom.operators.clean import FINITE, with_global
from entityloom.operators.encode import indicator_columns
from entityloom.operators.joins import join_with_suffixes
from entityloom.operators.skew import HOT_ROWS, attach_by_key
from entityloom.schema import is_text, numeric_columns, quoted

# The statistics of a general rollup and their name parts.
ROLLUP_STATS = ("count", "average", "min", "max", "sum")


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def with_key(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows with a complete key; grouping never makes a group of missing keys."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(quoted(k)).isNotNull() for k in _keys(keys)]))


# Statistics as SQL; the sum of an all-missing group is zero.
_STATS = {
    "count": "count({})",
    "average": "avg({})",
    "mean": "avg({})",
    "min": "min({})",
    "max": "max({})",
    "sum": "coalesce(sum(CAST({} AS DOUBLE)), double(0))",
    "std": "stddev_samp({})",
}


def _stat(name: str, column: str, output: str) -> Column:
    if name not in _STATS:
        raise ValueError(f"unknown statistic {name!r}")
    return F.expr(f"{_STATS[name].format(quoted(column))} AS {quoted(output)}")


def _size(name: str) -> Column:
    return F.expr(f"count(1) AS {quoted(name)}")


def group_stats(
    df: DataFrame,
    keys: str | Sequence[str],
    stats: dict[str, Sequence[str]],
    size: str | None = None,
    template: str = "{column}_{stat}",
) -> DataFrame:
    """``{column: statistics}`` per key in one aggregation; ``size`` names the row count.

    Minima and maxima of text would turn the whole aggregation into a sorted
    one; they get their own aggregation on the same key.
    """
    keys = _keys(keys)
    source = with_key(df, keys)
    hashed, sorted_ = [], []
    for column, names in stats.items():
        text = is_text(df.schema[column].dataType)
        for name in names:
            aggregate = _stat(name, column, template.format(column=column, stat=name))
            (sorted_ if text and name in ("min", "max") else hashed).append(aggregate)
    if size:
        hashed.insert(0, _size(size))
    if not sorted_:
        return source.groupBy(*keys).agg(*hashed)
    by_text = source.groupBy(*keys).agg(*sorted_)
    return source.groupBy(*keys).agg(*hashed).join(by_text, keys, "inner") if hashed else by_text


def group_means(df: DataFrame, keys: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Mean of every numeric column per key under its own name; text falls away."""
    keys = _keys(keys)
    chosen = columns if columns is not None else numeric_columns(df, keys)
    return with_key(df, keys).groupBy(*keys).agg(*[_stat("mean", c, c) for c in chosen])


def rollup_general(
    df: DataFrame,
    key: str,
    parent: str,
    name: str,
    columns: Sequence[str] | None = None,
    stats: Sequence[str] = ROLLUP_STATS,
    parents: DataFrame | None = None,
    functional: bool = False,
) -> DataFrame:
    """All statistics of all columns per ``key``, with each ``parent`` it occurs under.

    One row per ``(key, parent)`` and ``n_rows``, the child rows it stands for;
    columns are named ``{column}_{name}_{stat}``. Rows without a key stay, with
    missing statistics.

    - ``functional`` says that a key has one parent only; then one aggregation
      does it all. Otherwise the statistics of a key are made over all its
      parents and joined to the pairs.
    - ``parents`` holds the parent of each key when the child table does not
      carry it; the child table is reduced per key before it is joined.
    """
    chosen = list(columns) if columns is not None else numeric_columns(df, [key, parent])
    named = {f"{c}_{name}_{s}": (s, c) for c in chosen for s in stats}
    aggregates = [_stat(s, c, n) for n, (s, c) in named.items()]
    size = _size("n_rows")
    output = [quoted(key), quoted(parent), "n_rows", *[quoted(n) for n in named]]
    if parents is not None:
        # keys without a parent stay without one, rows without a key stay without statistics
        grouped = df.groupBy(key).agg(size, *aggregates)
        kept = [f"CASE WHEN {quoted(key)} IS NOT NULL THEN {quoted(n)} END AS {quoted(n)}" for n in named]
        return grouped.join(parents.select(key, parent), key, "left").select(*output[:2], "n_rows", *[F.expr(k) for k in kept])
    if functional:
        grouped = df.groupBy(key, parent).agg(size, *aggregates)
        kept = [f"CASE WHEN {quoted(key)} IS NOT NULL THEN {quoted(n)} END AS {quoted(n)}" for n in named]
        return grouped.selectExpr(*output[:3], *kept)
    pairs = df.groupBy(key, parent).agg(size)
    facts = with_key(df, key).groupBy(key).agg(*aggregates)
    # a key can only have many parents if it has many rows
    return attach_by_key(pairs, facts, [key], "left", measured=df).select(*output)


def weighted_means(df: DataFrame, key: str, weight: str, columns: Sequence[str]) -> DataFrame:
    """Mean of each column per key in which a row counts ``weight`` times.

    Missing values carry no weight.
    """
    w = f"CAST({quoted(weight)} AS DOUBLE)"

    def mean(c: str) -> Column:
        x = quoted(c)
        return F.expr(f"try_divide(sum(CAST({x} AS DOUBLE) * {w}), sum(CASE WHEN {x} IS NOT NULL THEN {w} END)) AS {x}")

    return with_key(df, key).groupBy(key).agg(*[mean(c) for c in columns])


def rollup_two_level(
    df: DataFrame,
    key: str,
    parent: str,
    name: str,
    columns: Sequence[str] | None = None,
    stats: Sequence[str] = ROLLUP_STATS[:4],
    parents: DataFrame | None = None,
    functional: bool = False,
) -> DataFrame:
    """Statistics per ``key``, then their mean per ``parent`` weighted by child rows."""
    level = rollup_general(df, key, parent, name, columns, stats, parents, functional)
    return weighted_means(level, parent, "n_rows", [c for c in level.columns if c not in (key, parent, "n_rows")])


def rollup_hierarchy(
    children: DataFrame,
    grandchildren: DataFrame,
    child_key: str,
    entity_key: str,
    suffixes: tuple[str, str] = ("", "_child"),
) -> DataFrame:
    """Grandchild means per child, left joined to the children, then means per entity."""
    means = group_means(grandchildren, child_key)
    joined = join_with_suffixes(children, means, [child_key], suffixes, "left")
    return group_means(joined, entity_key)


def aggregate_back(
    df: DataFrame,
    keys: str | Sequence[str],
    stats: dict[str, Sequence[str]],
    size: str = "group_rows",
    keep_missing: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Group statistics on every row of the group.

    Rows without a key fall away, or stay without statistics if ``keep_missing``.

    Grouped first and joined back rather than windowed: a window would sort
    all rows of a hot key in one task, this moves none of them.
    """
    keys = _keys(keys)
    facts = group_stats(df, keys, stats, size)
    if keep_missing:
        return attach_by_key(df, facts, keys, "left", hot_rows)
    return attach_by_key(df, facts, keys, "inner", hot_rows)


def feature_block(
    df: DataFrame,
    key: str,
    size: str,
    columns: Sequence[str] | None = None,
    after: str | None = None,
    only_means: Sequence[str] = (),
    shares: dict[str, Sequence[str]] | None = None,
) -> DataFrame:
    """One row per entity: row count, and for every numeric column ``X`` its
    mean ``X`` and its extremes ``X_min`` and ``X_max``.

    This is what remains of attaching group statistics to every row and
    averaging the rows again. ``after`` tells what happened to the rows between
    the two steps, which shows when values are missing or infinite:

    - ``None``: nothing.
    - ``"zero"``: missing cells became 0.
    - ``"mean"``: missing and infinite cells became the mean of their column,
      in which a group statistic counts once for each row of its group.

    With either, the mean of the filled rows (``X``) is not the filled mean of
    the rows, which then comes as ``X_mean``. Columns in ``only_means`` get
    their mean and nothing else; ``shares`` adds the share of each listed value
    of a text column. All of it is one aggregation.
    """
    chosen = list(columns) if columns is not None else numeric_columns(df, [key])
    if after not in (None, "zero", "mean"):
        raise ValueError("after must be None, 'zero' or 'mean'")
    flags = {f"{name}_mean": sql for name, sql in indicator_columns(shares or {}).items()}
    aggregates = [_size(size), *[_stat("mean", c, c) for c in only_means]]
    aggregates += [F.expr(f"avg({sql}) AS {quoted(name)}") for name, sql in flags.items()]
    out = [quoted(c) for c in (key, size, *only_means, *flags)]
    fills: dict[str, str] = {}
    n = quoted(size)
    for c in chosen:
        x = f"CAST({quoted(c)} AS DOUBLE)"
        stats = {s: quoted(f"{c}_{s}") for s in ("mean", "min", "max")}
        aggregates += [_stat(s, c, f"{c}_{s}") for s in stats]
        if after is None:
            out += [f"{stats['mean']} AS {quoted(c)}", stats["min"], stats["max"]]
        elif after == "zero":
            aggregates.append(F.expr(f"avg(coalesce({x}, double(0))) AS {quoted(c)}"))
            out += [quoted(c), *[f"coalesce({q}, 0) AS {q}" for q in stats.values()]]
        else:
            finite = f"CASE WHEN {FINITE.format(x)} THEN {x} END"
            total, known = quoted(f"__sum_{c}"), quoted(f"__n_{c}")
            aggregates += [F.expr(f"coalesce(sum({finite}), 0) AS {total}"), F.expr(f"count({finite}) AS {known}")]
            # the mean over all rows: of the cells, and of the statistics attached to them
            fills[c] = f"try_divide(sum({total}), sum({known}))"
            out.append(f"({total} + CASE WHEN {n} > {known} THEN ({n} - {known}) * __fill.{quoted(c)} ELSE 0 END) / {n} AS {quoted(c)}")
            for s, q in stats.items():
                fills[f"{c}_{s}"] = f"try_divide(sum({q} * {n}) FILTER (WHERE {FINITE.format(q)}), sum({n}) FILTER (WHERE {FINITE.format(q)}))"
                out.append(f"coalesce(CASE WHEN {FINITE.format(q)} THEN {q} END, __fill.{q}) AS {q}")
    grouped = with_key(df, key).groupBy(key).agg(*aggregates)
    if fills:
        grouped = with_global(grouped, "__fill", fills)
    return grouped.selectExpr(*out)


def reduce_to_key(
    df: DataFrame,
    key: str,
    keep_names: Sequence[str],
    carry: Sequence[str] = (),
    suffix: str = "_int_mean",
    drop: Sequence[str] = (),
) -> DataFrame:
    """Means per key, renamed with the suffix but for ``keep_names``.

    ``carry`` columns (the label, say) are not averaged: a key keeps one row
    for each of their distinct values. Where a key has one value of them, as
    with a label, this is one row per key.
    """
    if isinstance(keep_names, str):
        raise TypeError("keep_names must be a list of names, not one text")
    chosen = [c for c in numeric_columns(df, [key]) if c not in carry]
    renamed = {c: c if c in keep_names else c + suffix for c in chosen}
    source = with_key(df, key)
    if not carry:
        result = source.groupBy(key).agg(*[_stat("mean", c, n) for c, n in renamed.items()])
    else:
        # sums and counts per (key, carry) first: both results come from one small table
        sums = {c: (quoted(f"__sum_{c}"), quoted(f"__n_{c}")) for c in chosen}
        parts = source.groupBy(key, *carry).agg(
            *[F.expr(f"sum(CAST({quoted(c)} AS DOUBLE)) AS {total}") for c, (total, _) in sums.items()],
            *[F.expr(f"count({quoted(c)}) AS {known}") for c, (_, known) in sums.items()],
        )
        means = parts.groupBy(key).agg(
            *[
                F.expr(f"try_divide(sum({sums[c][0]}), sum({sums[c][1]})) AS {quoted(n)}")
                for c, n in renamed.items()
            ]
        )
        result = parts.select(key, *carry).join(means, key, "inner")
    return result.drop(*drop) if drop else result


def category_share(
    df: DataFrame,
    key: str,
    values: dict[str, Sequence[str]],
    numbers: Sequence[str] = (),
    size: str = "feature_app_count",
    missing: str = "",
) -> DataFrame:
    """Share of each category value per key, means of ``numbers``, and the row count."""
    flags = indicator_columns(values, missing=missing)
    aggregates = [_size(size), *[F.expr(f"avg({sql}) AS {quoted(n + '_mean')}") for n, sql in flags.items()]]
    aggregates += [F.expr(f"avg(coalesce({quoted(c)}, 0)) AS {quoted(c + '_mean')}") for c in numbers]
    return with_key(df, key).groupBy(key).agg(*aggregates)


def category_share_long(df: DataFrame, key: str, columns: Sequence[str], missing: str = "") -> DataFrame:
    """``key, column, value, n_rows, share``: the share of each category value per key.

    One row per value that occurs, so columns may have any number of values
    and nothing has to be fitted first. Missing text is a value of its own.
    """
    cells = [F.struct(F.lit(c).alias("column"), F.coalesce(F.col(quoted(c)), F.lit(missing)).alias("value")) for c in columns]
    long = with_key(df, key).select(key, F.explode(F.array(*cells)).alias("cell")).select(key, "cell.*")
    counted = long.groupBy(key, "column", "value").agg(F.count(F.lit(1)).alias("n_rows"))
    # every row has one value in each column: the values of one column add up to the rows of the key
    totals = with_key(df, key).groupBy(key).agg(F.count(F.lit(1)).alias("__all"))
    joined = attach_by_key(counted, totals, [key], "inner", measured=df)
    return joined.select(key, "column", "value", "n_rows", (F.col("n_rows") / F.col("__all")).alias("share"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def distinct_count(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Number of distinct non-missing values of each column."""
    return df.agg(*[F.expr(f"count(DISTINCT {quoted(c)}) AS {quoted(c)}") for c in _keys(columns)])

"""Statistics over a many-to-many join without its rows.

A ``Factor`` stands for a table: per key it holds the number of rows and, of
every measured column, count, sum, sum of squares, minimum and maximum; of every
measured pair of columns the sums over the rows in which both are present. That
is enough to tell the same of the join of two factors (``multiply``) and of the
rows of many keys together (``marginal``). Following the join tree from its
leaves, a chain in which a key has a, b and c rows costs a + b + c rows and never
a * b * c: every shuffle moves one partial row per key and map task, and a step
in which both tables repeat the key is refused.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityloom.operators.skew import attach_by_key
from entityloom.schema import quoted

ROWS = "__rows"


def _cell(kind: str, *columns: str) -> str:
    return "__".join(["", kind, *columns])


def _col(kind: str, *columns: str) -> Column:
    return F.col(quoted(_cell(kind, *columns)))


_COLUMN_SUMS = ("count", "sum", "squares")
_EXTREMES = ("min", "max")
_PAIR_SUMS = ("both", "first", "second", "product")


@dataclass(frozen=True)
class Factor:
    """One row per key. ``centres`` are constants that were taken off the columns before they were squared."""

    rows: DataFrame
    keys: tuple[str, ...]
    columns: tuple[str, ...] = ()
    pairs: tuple[tuple[str, str], ...] = ()
    centres: dict[str, float] = field(default_factory=dict)

    @property
    def sums(self) -> list[str]:
        """The cells that are added up over keys and repeated by a join."""
        names = [ROWS, *[_cell(k, c) for c in self.columns for k in _COLUMN_SUMS]]
        return names + [_cell(k, *p) for p in self.pairs for k in _PAIR_SUMS]

    @property
    def extremes(self) -> list[str]:
        return [_cell(k, c) for c in self.columns for k in _EXTREMES]


def column_centres(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """The mean of each column (0 if it has none): one row, in one pass."""
    if not columns:
        return {}
    found = df.agg(*[F.avg(F.col(quoted(c)).cast("double")).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    return {c: found[i] if found[i] is not None else 0.0 for i, c in enumerate(columns)}


def factor(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] = (),
    pairs: Sequence[tuple[str, str]] = (),
    centres: dict[str, float] | None = None,
) -> Factor:
    """The factor of a table. Rows without a key are left out, as no join finds them.

    ``pairs`` are pairs of ``columns`` of this table; those across tables are
    named when the tables meet. With ``centres`` (see ``column_centres``)
    deviations keep their digits where the mean is large beside them. An empty
    table gives no row; a column without a value in a key counts 0 there.
    """
    keys, columns = tuple(keys), tuple(columns)
    if not keys or set(keys) & set(columns) or len(set(columns)) != len(columns):
        raise ValueError("a factor needs keys and measured columns that differ")
    if any(c not in columns for p in pairs for c in p):
        raise ValueError("pairs are made of the measured columns")
    centres = {c: (centres or {}).get(c, 0.0) for c in columns}
    x = {c: F.col(quoted(c)).cast("double") - F.lit(centres[c]) for c in columns}
    out = [F.count(F.lit(1)).cast("double").alias(ROWS)]
    for c in columns:
        out += [F.count(x[c]).cast("double").alias(_cell("count", c))]
        out += [F.coalesce(F.sum(v), F.lit(0.0)).alias(_cell(k, c)) for k, v in (("sum", x[c]), ("squares", x[c] * x[c]))]
        own = F.col(quoted(c)).cast("double")
        out += [F.min(own).alias(_cell("min", c)), F.max(own).alias(_cell("max", c))]
    for a, b in pairs:
        both = x[a].isNotNull() & x[b].isNotNull()
        out.append(F.count(F.when(both, F.lit(1))).cast("double").alias(_cell("both", a, b)))
        for k, v in (("first", x[a]), ("second", x[b]), ("product", x[a] * x[b])):
            out.append(F.coalesce(F.sum(F.when(both, v)), F.lit(0.0)).alias(_cell(k, a, b)))
    present = reduce(lambda p, q: p & q, [F.col(quoted(k)).isNotNull() for k in keys])
    rows = df.filter(present).groupBy(*[F.col(quoted(k)) for k in keys]).agg(*out)
    return Factor(rows, keys, columns, tuple(tuple(p) for p in pairs), centres)


def multiply(left: Factor, right: Factor, pairs: Sequence[tuple[str, str]] = ()) -> Factor:
    """The factor of the inner join on the keys both have; ``pairs`` name a column of each side.

    The keys of one side must be the shared ones, so the result has no more
    rows than the other side; otherwise take the ``marginal`` of one side first.
    A shared key that the larger side repeats too often is handled as a hot key.
    """
    shared = [k for k in left.keys if k in right.keys]
    if not shared:
        raise ValueError("the factors share no key")
    if set(right.keys) != set(shared):
        if set(left.keys) != set(shared):
            raise ValueError("both factors have keys of their own: take the marginal of one of them first")
        return multiply(right, left, pairs)
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"both factors measure {', '.join(sorted(clash))}")
    if any((a in left.columns) == (b in left.columns) or not {a, b} <= {*left.columns, *right.columns} for a, b in pairs):
        raise ValueError("a pair names a column of each factor")
    other = right.rows.withColumnRenamed(ROWS, "__times")
    same = len(left.keys) == len(shared)
    joined = left.rows.join(other, shared) if same else attach_by_key(left.rows, other, shared)
    out = [F.col(quoted(k)) for k in left.keys]
    out += [(F.col(quoted(c)) * F.col("__times")).alias(c) for c in left.sums]
    out += [(F.col(quoted(c)) * F.col(ROWS)).alias(c) for c in right.sums if c != ROWS]
    out += [F.col(quoted(c)) for c in [*left.extremes, *right.extremes]]
    for a, b in pairs:
        for kind, (of_a, of_b) in zip(_PAIR_SUMS, [("count", "count"), ("sum", "count"), ("count", "sum"), ("sum", "sum")]):
            out.append((_col(of_a, a) * _col(of_b, b)).alias(_cell(kind, a, b)))
    return Factor(
        joined.select(*out),
        left.keys,
        left.columns + right.columns,
        left.pairs + right.pairs + tuple(tuple(p) for p in pairs),
        {**left.centres, **right.centres},
    )


def marginal(f: Factor, keys: Sequence[str]) -> Factor:
    """The factor of the same rows by fewer keys, or by none: then it has one row, also if there is nothing."""
    keys = tuple(keys)
    if not set(keys) <= set(f.keys):
        raise ValueError("a marginal has some of the factor's keys")
    out = [F.coalesce(F.sum(quoted(c)), F.lit(0.0)).alias(c) for c in f.sums]
    out += [(F.min if c.startswith("__min") else F.max)(quoted(c)).alias(c) for c in f.extremes]
    return Factor(f.rows.groupBy(*[F.col(quoted(k)) for k in keys]).agg(*out), keys, f.columns, f.pairs, f.centres)


def multiply_all(factors: Sequence[Factor], pairs: Sequence[tuple[str, str]] = ()) -> Factor:
    """The chain of factors on their keys; every pair is measured where its second table joins."""
    done, waiting = factors[0], list(pairs)
    for f in factors[1:]:
        now = [p for p in waiting if sum(c in done.columns for c in p) == 1 == sum(c in f.columns for c in p)]
        waiting = [p for p in waiting if p not in now]
        done = multiply(done, f, now)
    if waiting:
        raise ValueError(f"pairs that never meet: {waiting}")
    return done


def statistics(f: Factor) -> DataFrame:
    """Keys, ``n_rows``, and per column ``{c}_count``, ``_sum``, ``_mean``, ``_std``, ``_min``, ``_max`` of the joined rows.

    Per pair ``{a}_{b}_product_mean`` and ``{a}_{b}_covariance`` (sample). A mean
    of nothing is missing, as is a deviation or covariance of fewer than two rows.
    Counts are doubles: products of counts pass the range of a long.
    """

    def spread(n: Column, s: Column, t: Column, st: Column) -> Column:
        return F.when(n > 1, (st - s * t / F.when(n > 0, n)) / F.when(n > 1, n - 1))

    def one_value(c: str) -> Column:
        # then nothing varies, whatever rounding leaves of the sums
        low, high = _col("min", c), _col("max", c)
        return (low == high) & (F.abs(low) < F.lit(float("inf")))

    out = [F.col(quoted(k)) for k in f.keys] + [F.col(ROWS).alias("n_rows")]
    for c in f.columns:
        n, s, q, off = _col("count", c), _col("sum", c), _col("squares", c), F.lit(f.centres[c])
        mean = s / F.when(n > 0, n) + off
        deviation = F.when(one_value(c), F.lit(0.0)).otherwise(F.sqrt(F.greatest(spread(n, s, s, q), F.lit(0.0))))
        out += [n.alias(f"{c}_count"), (s + n * off).alias(f"{c}_sum"), mean.alias(f"{c}_mean")]
        # the greatest of a missing value and 0 would be 0
        out += [F.when(n > 1, deviation).alias(f"{c}_std"), _col("min", c).alias(f"{c}_min"), _col("max", c).alias(f"{c}_max")]
    for a, b in f.pairs:
        n, s, t, p = (_col(k, a, b) for k in _PAIR_SUMS)
        x, y = F.lit(f.centres[a]), F.lit(f.centres[b])
        total = p + y * s + x * t + n * x * y
        out.append((total / F.when(n > 0, n)).alias(f"{a}_{b}_product_mean"))
        nothing = F.when((n > 1) & (one_value(a) | one_value(b)), F.lit(0.0))
        out.append(nothing.otherwise(spread(n, s, t, p)).alias(f"{a}_{b}_covariance"))
    return f.rows.select(*out)

"""Exact order statistics without sorting the table or gathering a column.

Each wanted rank is bracketed by two data values. Approximate percentiles
propose values near the ranks; counting the rows below, at and between them
tells exactly where each rank lies, and that part becomes its new bracket.
This goes on until so few values are inside that they can be looked at. A pass
is two aggregations for all columns and ranks together, and a bracket keeps
about 4 / ACCURACY of its rows: 10**12 rows take three passes.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.schema import quoted, sql_literal

# Up to this many values of one bracket meet in one aggregation buffer.
GATHER_ROWS = 100_000
ACCURACY = 1_000
_MAX_PASSES = 100


@dataclass
class _Bracket:
    """The value of the rank (from 0) lies in [low, high]."""

    column: str
    rank: int
    low: object = None
    high: object = None
    below: int = 0
    inside: int = 0

    @property
    def span(self) -> tuple:
        return self.column, self.low, self.high

    def narrow_to(self, parts: list[tuple[int, object, object]]) -> None:
        """Take the part (rows, lowest, highest) of the column that holds the rank."""
        below = 0
        for rows, low, high in parts:
            if self.rank < below + rows:
                self.low, self.high, self.below, self.inside = low, high, below, rows
                return
            below += rows
        raise ValueError(f"rank {self.rank} outside the {below} values of {self.column}")


def _spans(brackets: list[_Bracket]) -> dict[tuple, list[_Bracket]]:
    """Ranks of a column share a bracket at first; what they share is looked at once."""
    out: dict[tuple, list[_Bracket]] = {}
    for b in brackets:
        out.setdefault(b.span, []).append(b)
    return out


def _within(span: tuple) -> str:
    name, low, high = span
    return f"{quoted(name)} BETWEEN {sql_literal(low)} AND {sql_literal(high)}"


def _proposals(df: DataFrame, brackets: list[_Bracket]) -> dict[str, list]:
    """Per column, values just below and just above where its open ranks should be."""
    spans = _spans(brackets)
    sketches, origins = [], []
    for i, (span, members) in enumerate(spans.items()):
        # sketches compute in doubles, which cannot tell large integers apart
        name, low, high = span
        origins.append(low if isinstance(low, int) and high - low < 2**53 else 0)
        value = f"try_subtract({quoted(name)}, {origins[i]})" if origins[i] else quoted(name)
        shares = []
        for b in members:
            shares.append(max(0.0, (b.rank - b.below) / b.inside - 2.0 / ACCURACY))
            shares.append(min(1.0, (b.rank - b.below + 1) / b.inside + 2.0 / ACCURACY))
        listed = ", ".join(map(str, sorted(set(shares))))
        sketches.append(
            F.expr(
                f"percentile_approx({value}, array({listed}), {ACCURACY}) FILTER (WHERE {_within(span)}) AS s{i}"
            )
        )
    row = df.agg(*sketches).first()
    values: dict[str, set] = {}
    for i, (name, _, _) in enumerate(spans):
        values.setdefault(name, set()).update(v + origins[i] for v in row[f"s{i}"])
    return {name: sorted(v) for name, v in values.items()}


def _parts(df: DataFrame, cuts: dict[str, list]) -> dict[str, list[tuple[int, object, object]]]:
    """(rows, lowest, highest) of the parts that the cut values divide each column into.

    A cut value is a part of its own, so a value with many rows is settled at once.
    """
    by_type: dict[str, list[str]] = {}
    for name in cuts:
        by_type.setdefault(df.schema[name].dataType.simpleString(), []).append(name)
    out: dict[str, list[tuple[int, object, object]]] = {name: [] for name in cuts}
    for names in by_type.values():
        cells = []
        for i, name in enumerate(names):
            x, steps = quoted(name), []
            for n, cut in enumerate(cuts[name]):
                steps.append(f"WHEN {x} < {sql_literal(cut)} THEN {2 * n} WHEN {x} = {sql_literal(cut)} THEN {2 * n + 1}")
            part = f"CASE {' '.join(steps)} ELSE {2 * len(cuts[name])} END" if steps else "0"
            cells.append(f"named_struct('c', {i}, 'p', {part}, 'v', {x})")
        long = df.selectExpr(f"inline(array({', '.join(cells)}))").filter("v IS NOT NULL")
        found = long.groupBy("c", "p").agg(F.expr("count(1) AS n"), F.expr("min(v) AS low"), F.expr("max(v) AS high"))
        # at most two parts per cut value
        for r in sorted(found.collect(), key=lambda r: (r["c"], r["p"])):
            out[names[r["c"]]].append((r["n"], r["low"], r["high"]))
    return out


def _gathered(df: DataFrame, brackets: list[_Bracket]) -> dict[int, object]:
    """The values at the ranks of brackets that hold few values, all of them in one row."""
    names = {span: f"span_{n}" for n, span in enumerate(_spans(brackets))}
    sorted_ = [
        F.expr(f"sort_array(collect_list({quoted(s[0])}) FILTER (WHERE {_within(s)})) AS {n}") for s, n in names.items()
    ]
    picks = [f"element_at({names[b.span]}, {b.rank - b.below + 1}) AS rank_{i}" for i, b in enumerate(brackets)]
    row = df.agg(*sorted_).selectExpr(*picks).first()
    return {id(b): row[f"rank_{i}"] for i, b in enumerate(brackets)}


def _settle(df: DataFrame, brackets: list[_Bracket], gather_rows: int) -> dict[int, object]:
    """Values at the ranks; at most ``gather_rows`` values of all brackets together are gathered in the end."""
    for _ in range(_MAX_PASSES):
        unsettled = [b for b in brackets if b.low != b.high]
        share = gather_rows // max(1, len(_spans(unsettled)))
        open_ = [b for b in unsettled if b.inside > share]
        if not open_:
            break
        parts = _parts(df, _proposals(df, open_))
        for b in open_:
            b.narrow_to(parts[b.column])
    else:
        raise RuntimeError("ranks could not be narrowed down")
    found = {id(b): b.low for b in brackets if b.low == b.high}
    rest = [b for b in brackets if b.low != b.high]
    if rest:
        found.update(_gathered(df, rest))
    return found


def order_statistics(df: DataFrame, ranks: dict[str, Sequence[int]], gather_rows: int = GATHER_ROWS) -> dict[str, list]:
    """``{column: values at the ranks}``; ranks count the non-missing values from 0."""
    whole = _parts(df, {c: [] for c in ranks})
    return _at_ranks(df, ranks, whole, gather_rows)


def _at_ranks(df: DataFrame, ranks, whole, gather_rows: int) -> dict[str, list]:
    brackets = []
    for name, listed in ranks.items():
        for rank in listed:
            b = _Bracket(name, rank)
            b.narrow_to(whole[name])
            brackets.append(b)
    found = _settle(df, brackets, gather_rows)
    out: dict[str, list] = {}
    for b in brackets:
        out.setdefault(b.column, []).append(found[id(b)])
    return out


def exact_percentiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], gather_rows: int = GATHER_ROWS
) -> dict[str, list[float | None]]:
    """Percentiles with linear interpolation between the two nearest values."""
    whole = _parts(df, {c: [] for c in columns})
    places = {c: [p * (parts[0][0] - 1) for p in probabilities] for c, parts in whole.items() if parts}
    ranks = {c: sorted({r for x in at for r in (math.floor(x), math.ceil(x))}) for c, at in places.items()}
    values = _at_ranks(df, ranks, whole, gather_rows)
    out: dict[str, list[float | None]] = {c: [None] * len(probabilities) for c in columns}
    for c, at in places.items():
        by_rank = {r: float(v) for r, v in zip(ranks[c], values[c])}
        out[c] = [
            by_rank[math.floor(x)] + (x - math.floor(x)) * (by_rank[math.ceil(x)] - by_rank[math.floor(x)]) for x in at
        ]
    return out

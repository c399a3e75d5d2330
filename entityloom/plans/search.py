"""Random search for pairwise features, gated by model importance."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.functions.registry import SEARCH_FUNCTIONS
from entityloom.operators.clean import clean
from entityloom.operators.skew import expand_left
from entityloom.operators.split import HOLD_OUT, hash_bucket, with_hold_out
from entityloom.plans.boosting import LeafParams, screened
from entityloom.plans.replay import FeatureSpec, apply_specs, prepare
from entityloom.plans.scoring import SEARCH_TREES, BoostingParams, rank_features
from entityloom.schema import quoted
from entityloom.session import stored

# Features to find, and the rank a feature must reach.
TARGET_FEATURES = 100
TOP_N = 20
# Fixed value: labelled rows a search fits its models on.
FIT_ROWS = 50_000
HELD = "__held_out"


@dataclass
class SearchResult:
    """Accepted features, the table that holds them, and all importances seen."""

    specs: list[FeatureSpec]
    table: DataFrame
    history: list[tuple[int, str, str, float, bool]] = field(default_factory=list)


def propose(
    columns: Sequence[str], n: int, rng: random.Random, prefix: str, df_name: str, seen: set[tuple] | None = None
) -> list[FeatureSpec]:
    """n random features over two different columns; combinations in ``seen`` are not drawn again."""
    seen = set() if seen is None else seen
    if len(columns) < 2:
        raise ValueError("two columns are needed to make a feature")
    room = len(columns) * (len(columns) - 1) * len(SEARCH_FUNCTIONS) - len(seen)
    out: list[FeatureSpec] = []
    while len(out) < min(n, room):
        function = rng.choice(SEARCH_FUNCTIONS)
        pair = tuple(rng.sample(list(columns), 2))
        if (function, pair) in seen:
            continue
        seen.add((function, pair))
        out.append(FeatureSpec(f"{prefix}{len(out)}", function, pair, df_name))
    return out


def top_features(importances: Mapping[str, float], n: int = TOP_N) -> list[str]:
    """The n most important features that the model used at all; the name decides among equals."""
    used = [c for c, v in importances.items() if v > 0]
    return sorted(used, key=lambda c: (-importances[c], c))[:n]


class SearchIncomplete(RuntimeError):
    """The search ended with fewer features than asked for; ``result`` holds what was found."""

    def __init__(self, result: SearchResult, reason: str):
        super().__init__(f"{len(result.specs)} features found: {reason}")
        self.result = result


def _finite(df: DataFrame, key: str, label: str) -> DataFrame:
    """Features enter the model finite and filled."""
    return clean(df, protect=[key, label], texts=(), numbers=(), text_fill=None, impute=0)


def explore(
    df: DataFrame,
    key: str,
    label: str,
    df_name: str,
    target: int = TARGET_FEATURES,
    top_n: int = TOP_N,
    per_round: int = 10,
    max_rounds: int | None = None,
    params: BoostingParams = SEARCH_TREES,
    seed: int = 0,
    prepared: bool = False,
    fit_rows: int = FIT_ROWS,
    hold_out: float = HOLD_OUT,
    judge: str = "model",
) -> SearchResult:
    """Propose, fit, keep what ranks in the top n; later features may build on kept ones.

    With ``judge="gain"`` no model is fitted: every candidate is judged alone, by
    the gain of its own best split (``boosting.screened``, one aggregation for the
    round), and kept if fewer than ``top_n`` of the round's inputs have a larger one.
    So alike candidates do not hide each other, whatever their number.

    Else a round fits one model for all of its candidates (``per_round=1`` gives
    every candidate a model of its own). It goes on until ``target`` features
    are kept; if all combinations were tried before, or ``max_rounds`` are
    over, it raises ``SearchIncomplete`` with what it has. Models are fitted on
    at most ``fit_rows`` labelled rows, chosen by hash and stored once, a
    hashed share of whose keys is held out; all features are projections of
    them, so a round writes nothing. The kept features are computed for the
    whole table at the end, in one projection.
    """
    if judge not in ("model", "gain"):
        raise ValueError("candidates are judged by model or by gain")
    rng = random.Random(seed)
    table = stored(_finite(df if prepared else prepare(df, key, label), key, label))
    labelled = table.filter(F.col(quoted(label)).isNotNull())
    sample = stored(labelled.orderBy(F.xxhash64(*[F.col(quoted(c)) for c in table.columns])).limit(fit_rows))
    result = SearchResult([], table)
    seen: set[tuple] = set()
    round_ = 0
    reason = ""
    while len(result.specs) < target:
        names = [s.name for s in result.specs]
        inputs = [c for c in table.columns if c not in (key, label)] + names
        candidates = propose(inputs, per_round, rng, f"candidate_{round_}_", df_name, seen)
        if not candidates or max_rounds is not None and round_ >= max_rounds:
            reason = "all combinations are tried" if not candidates else f"{round_} rounds are over"
            break
        tried = _finite(apply_specs(sample, [*result.specs, *candidates]), key, label)
        proposed = [c.name for c in candidates]
        if judge == "gain":
            leaves = LeafParams(min_rows=params.min_instances, positive_weight=params.positive_weight)
            found = screened(tried, [*inputs, *proposed], label, params=leaves)
            importances = {r["column"]: r["gain"] for r in found.collect()}  # one row per feature
            best = {c for c in proposed if importances[c] > 0 and sum(importances[i] > importances[c] for i in inputs) < top_n}
        else:
            flagged = with_hold_out(tried, hash_bucket([key], 1000, seed), hold_out, HELD, buckets=1000)
            ranked = rank_features(flagged, [*inputs, *proposed], label, params, HELD)
            importances = {r["column"]: r["importance"] for r in ranked.collect()}  # one row per feature
            best = set(top_features(importances, top_n))
        kept: list[FeatureSpec] = []
        for c in candidates:
            accepted = c.name in best and len(result.specs) + len(kept) < target
            name = f"f_{len(result.specs) + len(kept)}_{df_name}" if accepted else c.name
            if accepted:
                kept.append(replace(c, name=name))
            result.history.append((round_, name, c.function, importances[c.name], accepted))
        result.specs += kept
        round_ += 1
    result.table = stored(_finite(apply_specs(table, result.specs), key, label)) if result.specs else table
    if len(result.specs) < target:
        raise SearchIncomplete(result, reason)
    return result


def explore_tables(
    base: DataFrame, children: Mapping[str, DataFrame], key: str, label: str, **options
) -> dict[str, SearchResult]:
    """The search on the base table and on every child table joined to it.

    Child rows are labelled by their entity; base columns a child also has get
    the child's name.
    """
    found = {}
    for name, child in children.items():
        clash = {c: f"{c}_{name}" for c in child.columns if c in base.columns and c != key}
        joined = expand_left(base, child.withColumnsRenamed(clash), key)
        found[name] = explore(joined, key, label, name, **options)
    return found

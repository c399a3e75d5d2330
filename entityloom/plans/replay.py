"""Feature specs: lists of named functions over two columns, replayed as projections."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.functions.registry import GROUP_FUNCTIONS, PAIR_FUNCTIONS, canonical_name
from entityloom.operators.clean import fill_number
from entityloom.operators.encode import fit_codes
from entityloom.operators.joins import fold_outer
from entityloom.operators.rollup import group_stats, reduce_to_key
from entityloom.operators.skew import attach_by_key
from entityloom.schema import quoted, text_columns
from entityloom.session import stored


@dataclass(frozen=True)
class FeatureSpec:
    """One feature: ``name = function(*features)``; ``df_name`` tells the table it was found on."""

    name: str
    function: str
    features: tuple[str, ...]
    df_name: str = ""


def layers(columns: Sequence[str], specs: Iterable[FeatureSpec]) -> list[list[FeatureSpec]]:
    """The specs by depth: a layer only uses columns of the table and of earlier layers.

    Specs are read in the listed order; one that names an input which is
    neither a column nor an earlier feature is an error.
    """
    depth = {c: 0 for c in columns}
    out: list[list[FeatureSpec]] = []
    for spec in specs:
        unknown = [f for f in spec.features if f not in depth]
        if unknown:
            raise ValueError(f"feature {spec.name}: unknown input {', '.join(unknown)}")
        if spec.name in depth:
            raise ValueError(f"feature {spec.name}: the name is taken")
        canonical_name(spec.function)
        level = max(depth[f] for f in spec.features)
        depth[spec.name] = level + 1
        if level == len(out):
            out.append([])
        out[level].append(spec)
    return out


def apply_specs(df: DataFrame, specs: Iterable[FeatureSpec]) -> DataFrame:
    """The table with the features of the specs appended, one projection per layer.

    Group features of a layer are made per set of keys: one aggregation and one
    join for each, all from the table as it was before the layer. The result is
    stored before the next set of keys or layer builds on it, so that the work
    grows with the number of key sets and not with its power.
    """
    specs = list(specs)
    result, deep = df, layers(df.columns, specs)
    for number, layer in enumerate(deep):
        pairs = [s for s in layer if canonical_name(s.function) in PAIR_FUNCTIONS]
        grouped = [s for s in layer if canonical_name(s.function) in GROUP_FUNCTIONS]
        if pairs:
            result = result.select(
                "*",
                *[
                    PAIR_FUNCTIONS[canonical_name(s.function)](*[F.col(quoted(f)) for f in s.features]).alias(s.name)
                    for s in pairs
                ],
            )
        if grouped:
            result = _group_features(result, grouped)
            if number + 1 < len(deep):
                result = stored(result)
    return result.select(*df.columns, *[F.col(quoted(s.name)) for s in specs])


def _group_features(df: DataFrame, specs: Sequence[FeatureSpec]) -> DataFrame:
    by_keys: dict[tuple[str, ...], list[FeatureSpec]] = {}
    for s in specs:
        keys = s.features[:1] if canonical_name(s.function) == "group_std" else tuple(sorted(s.features))
        by_keys.setdefault(keys, []).append(s)
    result = df
    for number, (keys, of_keys) in enumerate(by_keys.items()):
        if number:
            result = stored(result)  # the join reads its rows twice, with and without a key
        values = dict.fromkeys(s.features[1] for s in of_keys if canonical_name(s.function) == "group_std")
        facts = group_stats(df, list(keys), {v: ["std"] for v in values}, "__rows", template="__{column}_{stat}")
        named = [
            F.col(quoted(f"__{s.features[1]}_std") if canonical_name(s.function) == "group_std" else "__rows").alias(s.name) for s in of_keys
        ]
        facts = facts.select(*[F.col(quoted(k)) for k in keys], *named)
        # the keys of the table before the layer are those of the result, and cheaper to look at
        result = attach_by_key(result, facts, list(keys), "left", measured=df)
    return result


def prepare(df: DataFrame, key: str, label: str | None = None) -> DataFrame:
    """Text to label codes and missing numbers to 0, so that every column can be an input."""
    protect = [c for c in (key, label) if c]
    texts = text_columns(df, protect)
    filled = fill_number(df, 0, protect)
    return fit_codes(filled, columns=texts).transform(filled) if texts else filled


def replay_block(
    child: DataFrame,
    base: DataFrame | None,
    key: str,
    specs: Sequence[FeatureSpec],
    df_name: str,
    drop: Sequence[str] = (),
    prepared: bool = False,
) -> DataFrame:
    """One row per entity with the means of the child's columns and of the replayed features.

    ``base`` columns can be inputs of features too; they hold one value per
    entity and are not repeated in the block. Output names carry ``df_name``.
    """
    if base is None:
        wide = child
    else:
        clash = {c: f"{c}_{df_name}" for c in base.columns if c in child.columns and c != key}
        wide = attach_by_key(child, base.withColumnsRenamed(clash), [key], "left", measured=child)
        wide = fill_number(wide, 0, [key])  # entities the base lacks
    ready = wide if prepared else prepare(wide, key)
    featured = apply_specs(ready, specs)
    kept = [c for c in child.columns if c != key and c not in drop] + [s.name for s in specs]
    return reduce_to_key(featured.select(key, *kept), key, keep_names=[key], suffix=f"_{df_name}_mean")


def replay_tables(
    children: dict[str, DataFrame],
    base: DataFrame | None,
    key: str,
    specs: dict[str, Sequence[FeatureSpec]],
    drop: Sequence[str] = (),
    prepared: bool = False,
    fill: float | None = 0,
) -> DataFrame:
    """Every child table replayed with its own specs, then folded into one row per entity.

    Entities of any child are in the result. Columns of ``base`` come last.
    Text is coded once per table, that of the base before it meets the
    children, and every missing number of the result is filled, also where the
    base lacks the entity.
    """
    ready = base if base is None or prepared else stored(prepare(base, key))
    blocks = [
        replay_block(df if prepared else prepare(df, key), ready, key, specs.get(name, ()), name, drop, prepared=True)
        for name, df in children.items()
    ]
    folded = fold_outer(blocks, [key])
    result = folded if ready is None else folded.join(ready, key, "left")
    return result if fill is None else fill_number(result, fill, [key])

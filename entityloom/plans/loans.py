"""The feature plans for the loan tables, a profile of the label, and training on a wide table.

``tables`` maps the names application_train, application_test, bureau,
bureau_balance, previous_application, credit_card_balance, POS_CASH_balance
and installments_payments to frames.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.functions.scalars import flag_not_equal
from entityloom.operators.clean import clean, fill_number
from entityloom.operators.columns import add_constant
from entityloom.operators.encode import drop_text, fit_codes, fit_values, one_hot
from entityloom.operators.joins import join_with_suffixes
from entityloom.operators.profile import target_profile
from entityloom.operators.rollup import category_share, feature_block, group_means, reduce_to_key, rollup_two_level
from entityloom.operators.skew import expand_left
from entityloom.operators.split import HOLD_OUT, hash_bucket, with_hold_out, with_ordered_hold_out
from entityloom.plans import featuresets as sets
from entityloom.plans.assemble import assemble, attach_blocks, averaged, split_parts, stack_parts
from entityloom.plans.replay import FeatureSpec, apply_specs, replay_tables
from entityloom.plans.scoring import SMALL_TREES, BoostingParams, auc, importance_table, log_loss, score, train_boosted
from entityloom.schema import ChildTable, EntitySchema, numeric_columns, text_columns
from entityloom.session import stored

LOANS = EntitySchema(
    key="SK_ID_CURR",
    label="TARGET",
    children=(
        ChildTable("bureau", "SK_ID_BUREAU"),
        ChildTable("bureau_balance", "SK_ID_BUREAU"),
        ChildTable("previous_application", "SK_ID_PREV"),
        ChildTable("credit_card_balance", "SK_ID_PREV"),
        ChildTable("POS_CASH_balance", "SK_ID_PREV"),
        ChildTable("installments_payments", "SK_ID_PREV"),
    ),
)
PART = "part"
# Values of a text column that may become columns, unless a plan is told another number.
MAX_VALUES = 2000
ID_PARTS = ("SK_ID_BUREAU", "SK_ID_PREV")


def _encoded(df: DataFrame, encode: str, protect: Sequence[str], max_values: int) -> DataFrame:
    """``max_values`` bounds the values of a text column that become columns; more are an error, so choose it wide enough."""
    if encode == "drop":
        return drop_text(df, protect)
    if encode == "one_hot":
        return one_hot(df, fit_values(df, protect=protect, max_values=max_values), protect)
    raise ValueError("encode must be 'one_hot' or 'drop'")


def _applications(tables: Mapping[str, DataFrame]) -> DataFrame:
    return stack_parts(tables["application_train"], tables["application_test"], PART)


def flat_features(
    tables: Mapping[str, DataFrame], encode: str = "one_hot", stage: bool = False, max_values: int = MAX_VALUES, one_row: bool = False
) -> DataFrame:
    """Ratios on every table, one block of means and extremes per child, one wide cleaned table.

    ``one_row`` averages a customer whom a part of the applications lists
    twice, the label too.
    """
    key, protect = LOANS.key, [*LOANS.protected, PART]
    base = apply_specs(clean(_applications(tables), protect), sets.APPLICATION)
    base = _encoded(base, encode, protect, max_values)

    def block(table: str, specs: Sequence[FeatureSpec], size: str, after: str | None) -> DataFrame:
        ready = apply_specs(_encoded(clean(tables[table], protect), encode, protect, max_values), specs)
        return feature_block(ready, key, size, numeric_columns(ready, protect), after)

    blocks = {
        "card": block("credit_card_balance", sets.CARD, "card_rows", "mean"),
        "pos": block("POS_CASH_balance", sets.POINT_OF_SALE, "pos_rows", "mean"),
        "prev": block("previous_application", sets.PREVIOUS, "prev_rows", None),
        "inst": block("installments_payments", sets.INSTALMENTS, "inst_rows", None),
        "bureau": _bureau_block(tables, encode, protect, max_values),
    }
    return assemble(base, blocks, key, [LOANS.label, PART], one_row=one_row, drop_parts=ID_PARTS, stage=stage)


def _bureau_block(tables: Mapping[str, DataFrame], encode: str, protect: Sequence[str], max_values: int) -> DataFrame:
    bureau = clean(tables["bureau"], protect)
    active = flag_not_equal(F.col(sets.BUREAU_STATUS), sets.BUREAU_CLOSED)
    bureau = apply_specs(bureau.withColumn("credit_active", active), sets.BUREAU)
    if encode == "one_hot":
        bureau = one_hot(bureau, fit_values(bureau, protect=protect, max_values=max_values), protect, numeric_fill=None)
    else:
        bureau = drop_text(bureau, protect, numeric_fill=None)
    monthly = _encoded(clean(tables["bureau_balance"], protect), encode, protect, max_values)
    means = group_means(monthly, "SK_ID_BUREAU")
    joined = join_with_suffixes(bureau, means, ["SK_ID_BUREAU"], ("", "_balance"), "left")
    own = numeric_columns(bureau, protect)
    added = [c for c in joined.columns if c not in bureau.columns]
    return feature_block(joined, LOANS.key, "bureau_rows", own, "zero", only_means=added)


def two_level_features(
    tables: Mapping[str, DataFrame], functional: bool = False, max_values: int = MAX_VALUES, one_row: bool = False
) -> DataFrame:
    """One-hot everywhere, statistics per loan, their row-weighted means per customer.

    ``functional`` tells that a loan belongs to one customer, which saves a
    shuffle and a join per table. ``one_row`` averages a customer whom a part
    of the applications lists twice, the label too.
    """
    key, protect = LOANS.key, [*LOANS.protected, PART]

    def coded(df: DataFrame) -> DataFrame:
        return one_hot(df, fit_values(df, protect=protect, max_values=max_values), protect)

    bureau = expand_left(tables["bureau"], tables["bureau_balance"], "SK_ID_BUREAU", orphans=True)
    sources = {
        "bureau": (bureau, "SK_ID_BUREAU"),
        "cc_installment": (tables["credit_card_balance"], "SK_ID_PREV"),
        "pos_cash": (tables["POS_CASH_balance"], "SK_ID_PREV"),
        "prev": (tables["previous_application"], "SK_ID_PREV"),
        "payments": (tables["installments_payments"], "SK_ID_PREV"),
    }
    blocks = {
        name: rollup_two_level(coded(df), loan, key, name, functional=functional) for name, (df, loan) in sources.items()
    }
    wide = attach_blocks(coded(_applications(tables)), blocks, key)
    return averaged(wide, key, [LOANS.label, PART]) if one_row else wide


def replayed_features(
    tables: Mapping[str, DataFrame], specs: Mapping[str, Sequence[FeatureSpec]], fill: float | None = 0
) -> DataFrame:
    """Stored specs replayed on every child table next to the application's columns."""
    key = LOANS.key
    base = add_constant(apply_specs(_applications(tables), sets.MANUAL), "g_column")
    label_and_part = base.select(key, LOANS.label, PART)
    bureau = expand_left(tables["bureau"], tables["bureau_balance"], "SK_ID_BUREAU", orphans=True)
    children = {
        "df_bureau": bureau,
        "df_prev": tables["previous_application"],
        "df_cc": tables["credit_card_balance"],
        "df_installment": tables["installments_payments"],
        "df_pos_cash": tables["POS_CASH_balance"],
    }
    folded = replay_tables(children, base.drop(LOANS.label, PART), key, specs, drop=ID_PARTS, fill=fill)
    return folded.join(label_and_part, key, "left")


def share_features(tables: Mapping[str, DataFrame], max_values: int = MAX_VALUES) -> DataFrame:
    """Category shares and means per customer of every table, left joined."""
    key = LOANS.key

    def reduced(df: DataFrame, by: str, drop: Sequence[str], suffix: str) -> DataFrame:
        texts = fit_values(df, protect=[*LOANS.protected, PART], max_values=max_values)
        # a missing cell is a value of its own
        values = {c: sorted({*v, ""}) for c, v in texts.items()}
        return category_share(df.drop(*drop), by, values, numeric_columns(df, LOANS.protected), f"{suffix}_rows")

    bureau = expand_left(tables["bureau"], tables["bureau_balance"], "SK_ID_BUREAU")
    per_loan = reduced(bureau, "SK_ID_BUREAU", [key], "balance")
    owners = bureau.select(key, "SK_ID_BUREAU").distinct()
    blocks = {"bureau": reduced(owners.join(per_loan, "SK_ID_BUREAU"), key, ["SK_ID_BUREAU"], "bureau")}
    for name, table in (
        ("prev", "previous_application"),
        ("cc", "credit_card_balance"),
        ("installment", "installments_payments"),
        ("pos_cash", "POS_CASH_balance"),
    ):
        blocks[name] = reduced(tables[table], key, ["SK_ID_PREV"], name)
    applications = _applications(tables)
    base = reduced(applications.drop(LOANS.label), key, [PART], "application")
    labels = applications.select(key, LOANS.label, PART)
    return attach_blocks(labels.join(base, key), blocks, key)


def searched_features(tables: Mapping[str, DataFrame], stage: bool = False) -> DataFrame:
    """Means of every child, shared label codes, hand-made and searched features, one row per customer."""
    key, label, protect = LOANS.key, LOANS.label, [*LOANS.protected, PART]
    monthly = group_means(tables["bureau_balance"], "SK_ID_BUREAU")
    children = {
        "bureau": join_with_suffixes(tables["bureau"], monthly, ["SK_ID_BUREAU"], ("", "_balance"), "left"),
        "prev": tables["previous_application"],
        "cc": tables["credit_card_balance"],
        "installment": tables["installments_payments"],
        "pos_cash": tables["POS_CASH_balance"],
    }
    blocks = {name: group_means(df, key, numeric_columns(df, LOANS.protected)) for name, df in children.items()}
    wide = attach_blocks(_applications(tables), blocks, key)
    if stage:
        wide = stored(wide)
    filled = fill_number(wide, 0, protect)
    texts = text_columns(filled, protect)
    # train and test rows are one table here, so they share their codes
    coded = fit_codes(filled, columns=texts).transform(filled) if texts else filled
    featured = apply_specs(coded, [*sets.MANUAL, *sets.SEARCHED])
    return reduce_to_key(featured, key, keep_names=[key], carry=[label, PART])


def label_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Mean and count of the label by value of every cleaned and derived application column."""
    train = clean(tables["application_train"], LOANS.protected, nonfinite=False, text_fill=None)
    return target_profile(apply_specs(train, sets.APPLICATION), LOANS.label, exclude=[LOANS.key])


def finished_parts(wide: DataFrame, fill: float) -> tuple[DataFrame, DataFrame]:
    """Train and test tables with every missing number filled, but for the label."""
    train, test = split_parts(fill_number(wide, fill, [LOANS.key, LOANS.label]), PART)
    return train, test


def train_and_score(
    wide: DataFrame,
    fill: float = -1,
    share: float = HOLD_OUT,
    params: BoostingParams = SMALL_TREES,
    seed: int = 0,
    ordered: bool = False,
    eligible: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """Scores of the test rows, importances, and metrics on the hold-out.

    ``eligible`` restricts the inputs to columns of these names.

    The hold-out is a hashed share of the customers, or with ``ordered`` those
    with the largest keys.
    """
    # training goes over the table many times
    train, test = finished_parts(stored(drop_text(wide, [PART], numeric_fill=None)), fill)
    key, label = LOANS.key, LOANS.label
    inputs = [c for c in numeric_columns(train, [key, label]) if eligible is None or c in set(eligible)]
    if ordered:
        flagged = with_ordered_hold_out(train, key, 1 - share)
    else:
        flagged = with_hold_out(train, hash_bucket([key], 100_000, seed), share, buckets=100_000)
    model = train_boosted(flagged, inputs, label, params, "is_validation")
    held = flagged.filter("is_validation")
    judged = score(model, held, inputs, key, keep=[label])
    return {
        "scores": score(model, test, inputs, key, label),
        "importances": importance_table(model, inputs, wide),
        "auc": auc(judged, "score", label),
        "logloss": log_loss(judged, "score", label),
    }

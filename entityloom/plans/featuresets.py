"""Named feature sets as data. Each entry is applied by ``plans.replay``."""

from __future__ import annotations

from entityloom.plans.replay import FeatureSpec


def _over(function: str, a: str, b: str, prefix: str = "") -> FeatureSpec:
    return FeatureSpec(f"{prefix}{a}_over_{b}", function, (a, b))


def _minus(a: str, b: str) -> FeatureSpec:
    return FeatureSpec(f"{a}_minus_{b}", "diff", (a, b))


# The features of the application table.
APPLICATION = (
    _over("ratio_ieee", "AMT_INCOME_TOTAL", "AMT_ANNUITY"),
    _over("ratio_clamped", "AMT_GOODS_PRICE", "AMT_INCOME_TOTAL"),
    _over("ratio_clamped", "AMT_CREDIT", "AMT_INCOME_TOTAL"),
    _over("ratio_clamped", "AMT_GOODS_PRICE", "AMT_CREDIT"),
    _over("ratio_clamped", "AMT_CREDIT", "AMT_ANNUITY"),
    _over("ratio_clamped", "CNT_CHILDREN", "CNT_FAM_MEMBERS"),
    _minus("DAYS_BIRTH", "DAYS_EMPLOYED"),
    _minus("DAYS_BIRTH", "DAYS_REGISTRATION"),
    _minus("DAYS_BIRTH", "DAYS_ID_PUBLISH"),
    _minus("DAYS_BIRTH", "DAYS_LAST_PHONE_CHANGE"),
    _over("ratio_clamped", "DEF_60_CNT_SOCIAL_CIRCLE", "OBS_60_CNT_SOCIAL_CIRCLE"),
    _over("ratio_clamped", "DEF_30_CNT_SOCIAL_CIRCLE", "OBS_30_CNT_SOCIAL_CIRCLE"),
)

# The features of the credit bureau table, and its closed status.
BUREAU = (
    _over("ratio_ieee", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT"),
    _over("ratio_ieee", "AMT_CREDIT_SUM_OVERDUE", "AMT_CREDIT_SUM_DEBT"),
)
BUREAU_STATUS, BUREAU_CLOSED = "CREDIT_ACTIVE", "Closed"

# The features of the card balance table.
CARD = (
    _over("ratio_ieee", "AMT_CREDIT_LIMIT_ACTUAL", "AMT_DRAWINGS_ATM_CURRENT"),
    _over("ratio_ieee", "AMT_BALANCE", "AMT_DRAWINGS_ATM_CURRENT"),
    _over("ratio_ieee", "AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL"),
    _over("ratio_ieee", "AMT_BALANCE", "AMT_DRAWINGS_CURRENT"),
    _over("ratio_ieee", "AMT_BALANCE", "AMT_DRAWINGS_POS_CURRENT"),
    _over("ratio_ieee", "AMT_BALANCE", "AMT_RECEIVABLE_PRINCIPAL"),
    _over("ratio_ieee", "AMT_DRAWINGS_CURRENT", "AMT_DRAWINGS_ATM_CURRENT"),
    _over("ratio_ieee", "AMT_DRAWINGS_POS_CURRENT", "AMT_DRAWINGS_ATM_CURRENT"),
    _over("ratio_ieee", "AMT_INST_MIN_REGULARITY", "AMT_DRAWINGS_ATM_CURRENT"),
    _over("ratio_ieee", "AMT_PAYMENT_CURRENT", "AMT_DRAWINGS_ATM_CURRENT"),
    _over("ratio_ieee", "AMT_PAYMENT_TOTAL_CURRENT", "AMT_DRAWINGS_ATM_CURRENT"),
    _over("ratio_ieee", "AMT_RECEIVABLE_PRINCIPAL", "AMT_DRAWINGS_ATM_CURRENT"),
    _over("ratio_ieee", "AMT_RECEIVABLE_PRINCIPAL", "AMT_TOTAL_RECEIVABLE"),
)

# The features of the point-of-sale balance table.
POINT_OF_SALE = (
    FeatureSpec("pos_cnt_vs_future_instalment", "diff", ("CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE")),
    _minus("SK_DPD", "SK_DPD_DEF"),
)

# The features of the previous application table.
PREVIOUS = (
    _over("ratio_ieee", "AMT_CREDIT", "AMT_ANNUITY", "prev_"),
    _over("ratio_ieee", "AMT_CREDIT", "AMT_GOODS_PRICE", "prev_"),
    _over("ratio_ieee", "AMT_ANNUITY", "AMT_GOODS_PRICE", "prev_"),
    _over("ratio_ieee", "AMT_DOWN_PAYMENT", "AMT_ANNUITY", "prev_"),
    _over("ratio_ieee", "AMT_DOWN_PAYMENT", "AMT_CREDIT", "prev_"),
    _over("ratio_ieee", "AMT_DOWN_PAYMENT", "AMT_APPLICATION", "prev_"),
)

# The features of the instalment payment table.
INSTALMENTS = (
    FeatureSpec("prev_days_to_first_payment", "diff", ("DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT")),
    FeatureSpec("prev_payment_vs_installment", "diff", ("AMT_INSTALMENT", "AMT_PAYMENT")),
)


def _numbered(first: int, function: str, pairs: list[tuple[str, str]]) -> tuple[FeatureSpec, ...]:
    return tuple(FeatureSpec(f"a{i}", function, pair) for i, pair in enumerate(pairs, first))


# The hand-made application features a1 to a19, all clamped ratios.
MANUAL = _numbered(
    1,
    "ratio_clamped",
    [
        ("AMT_INCOME_TOTAL", "AMT_ANNUITY"),
        ("AMT_INCOME_TOTAL", "AMT_CREDIT"),
        ("AMT_INCOME_TOTAL", "AMT_GOODS_PRICE"),
        ("AMT_CREDIT", "AMT_ANNUITY"),
        ("AMT_CREDIT", "AMT_INCOME_TOTAL"),
        ("AMT_CREDIT", "AMT_GOODS_PRICE"),
        ("AMT_GOODS_PRICE", "AMT_CREDIT"),
        ("AMT_GOODS_PRICE", "AMT_ANNUITY"),
        ("AMT_GOODS_PRICE", "AMT_INCOME_TOTAL"),
        ("AMT_ANNUITY", "AMT_CREDIT"),
        ("AMT_ANNUITY", "AMT_GOODS_PRICE"),
        ("AMT_ANNUITY", "AMT_INCOME_TOTAL"),
        ("REGION_POPULATION_RELATIVE", "AMT_INCOME_TOTAL"),
        ("REGION_POPULATION_RELATIVE", "AMT_ANNUITY"),
        ("REGION_POPULATION_RELATIVE", "AMT_GOODS_PRICE"),
        ("REGION_POPULATION_RELATIVE", "AMT_CREDIT"),
        ("EXT_SOURCE_1", "EXT_SOURCE_2"),
        ("EXT_SOURCE_1", "EXT_SOURCE_3"),
        ("EXT_SOURCE_2", "EXT_SOURCE_3"),
    ],
)

# The searched application features a20 to a45. They need the
# label codes of the text columns and build on a1 to a19 and on each other.
SEARCHED = tuple(
    FeatureSpec(name, function, (a, b))
    for name, function, a, b in [
        ("a20", "ratio_clamped", "FLAG_MOBIL", "a10"),
        ("a21", "ratio_clamped", "AMT_GOODS_PRICE", "ELEVATORS_AVG"),
        ("a22", "norm", "LIVINGAREA_MEDI", "OCCUPATION_TYPE"),
        ("a23", "ratio_clamped", "AMT_ANNUITY", "APARTMENTS_MEDI"),
        ("a24", "sum", "CODE_GENDER", "LIVINGAREA_MEDI"),
        ("a25", "product", "DAYS_EMPLOYED", "a6"),
        ("a26", "sum", "CODE_GENDER", "EXT_SOURCE_2"),
        ("a27", "sum", "FLAG_OWN_CAR", "YEARS_BEGINEXPLUATATION_AVG"),
        ("a28", "product", "AMT_GOODS_PRICE", "CNT_FAM_MEMBERS"),
        ("a29", "angle", "REGION_POPULATION_RELATIVE", "EXT_SOURCE_2"),
        ("a30", "sum", "LANDAREA_AVG", "NAME_FAMILY_STATUS"),
        ("a31", "angle", "a14", "a2"),
        ("a32", "sum", "DAYS_BIRTH", "YEARS_BEGINEXPLUATATION_MODE"),
        ("a33", "sum", "a4", "AMT_REQ_CREDIT_BUREAU_QRT"),
        ("a34", "angle", "EXT_SOURCE_3", "DAYS_REGISTRATION"),
        ("a35", "norm", "EXT_SOURCE_1", "LANDAREA_MEDI"),
        ("a36", "product", "a25", "a14"),
        ("a37", "sum", "a34", "AMT_REQ_CREDIT_BUREAU_QRT"),
        ("a38", "norm", "a4", "REG_CITY_NOT_WORK_CITY"),
        ("a39", "norm", "a19", "a17"),
        ("a40", "sum", "FLAG_OWN_CAR", "a2"),
        ("a41", "ratio_clamped", "DAYS_BIRTH", "OWN_CAR_AGE"),
        ("a42", "norm", "a34", "REGION_RATING_CLIENT_W_CITY"),
        ("a43", "angle", "a42", "NAME_EDUCATION_TYPE"),
        ("a44", "ratio_clamped", "EXT_SOURCE_3", "a8"),
        ("a45", "norm", "AMT_REQ_CREDIT_BUREAU_DAY", "a10"),
    ]
)

# The stored result of the feature search on the application table.
STORED = tuple(
    FeatureSpec(f"f_{i}_df_app", function, (a, b), "df_app")
    for i, (function, a, b) in enumerate(
        [
            ("ratio_guarded", "FLAG_MOBIL", "a10"),
            ("ratio_guarded", "AMT_GOODS_PRICE", "ELEVATORS_AVG"),
            ("norm", "LIVINGAREA_MEDI", "OCCUPATION_TYPE"),
            ("ratio_guarded", "AMT_ANNUITY", "APARTMENTS_MEDI"),
            ("sum", "CODE_GENDER", "LIVINGAREA_MEDI"),
            ("product", "DAYS_EMPLOYED", "a6"),
            ("sum", "CODE_GENDER", "EXT_SOURCE_2"),
            ("sum", "FLAG_OWN_CAR", "YEARS_BEGINEXPLUATATION_AVG"),
            ("product", "AMT_GOODS_PRICE", "CNT_FAM_MEMBERS"),
            ("angle", "REGION_POPULATION_RELATIVE", "EXT_SOURCE_2"),
            ("sum", "LANDAREA_AVG", "NAME_FAMILY_STATUS"),
            ("ratio_guarded", "g_column", "DAYS_LAST_PHONE_CHANGE"),
            ("angle", "a14", "a2"),
            ("sum", "DAYS_BIRTH", "YEARS_BEGINEXPLUATATION_MODE"),
            ("norm", "FLAG_DOCUMENT_15", "DAYS_EMPLOYED"),
            ("sum", "a4", "AMT_REQ_CREDIT_BUREAU_QRT"),
            ("angle", "EXT_SOURCE_3", "DAYS_REGISTRATION"),
            ("norm", "EXT_SOURCE_1", "LANDAREA_MEDI"),
            ("product", "f_5_df_app", "a14"),
            ("sum", "f_16_df_app", "AMT_REQ_CREDIT_BUREAU_QRT"),
            ("norm", "f_11_df_app", "COMMONAREA_MEDI"),
            ("norm", "a4", "REG_CITY_NOT_WORK_CITY"),
            ("norm", "a19", "a17"),
            ("sum", "FLAG_OWN_CAR", "a2"),
            ("ratio_guarded", "DAYS_BIRTH", "OWN_CAR_AGE"),
            ("angle", "f_16_df_app", "REGION_RATING_CLIENT_W_CITY"),
            ("angle", "f_25_df_app", "NAME_EDUCATION_TYPE"),
            ("ratio_guarded", "EXT_SOURCE_3", "a8"),
            ("norm", "AMT_REQ_CREDIT_BUREAU_DAY", "a10"),
            ("product", "DAYS_REGISTRATION", "ORGANIZATION_TYPE"),
        ]
    )
)

# The columns a model may be restricted to.
ELIGIBLE = (
    "EXT_SOURCE_2",
    "EXT_SOURCE_3",
    "DAYS_BIRTH",
    "DAYS_REGISTRATION",
    "DAYS_ID_PUBLISH",
    "DAYS_EMPLOYED",
    "DAYS_LAST_PHONE_CHANGE",
    "AMT_ANNUITY",
    "REGION_POPULATION_RELATIVE",
    "AMT_INCOME_TOTAL",
    "AMT_CREDIT",
    "EXT_SOURCE_1",
    "HOUR_APPR_PROCESS_START",
    "AMT_GOODS_PRICE",
    "ORGANIZATION_TYPE",
    "OCCUPATION_TYPE",
    "AMT_REQ_CREDIT_BUREAU_YEAR",
    "WEEKDAY_APPR_PROCESS_START",
    "OWN_CAR_AGE",
    "NAME_FAMILY_STATUS",
    "OBS_60_CNT_SOCIAL_CIRCLE",
    "OBS_30_CNT_SOCIAL_CIRCLE",
    "CNT_FAM_MEMBERS",
    "NAME_HOUSING_TYPE",
)

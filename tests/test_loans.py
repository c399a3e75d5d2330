"""The three plans on small loan tables, against an independent recomputation."""

import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from entityloom.plans import featuresets as sets
from entityloom.plans import loans
from entityloom.plans.replay import FeatureSpec, apply_specs, layers
from entityloom.plans.scoring import SMALL_TREES

N = 60
APPLICATION_NUMBERS = [
    "AMT_INCOME_TOTAL", "AMT_ANNUITY", "AMT_GOODS_PRICE", "AMT_CREDIT", "CNT_CHILDREN", "CNT_FAM_MEMBERS", "DAYS_BIRTH",
    "DAYS_EMPLOYED", "DAYS_REGISTRATION", "DAYS_ID_PUBLISH", "DAYS_LAST_PHONE_CHANGE", "DEF_60_CNT_SOCIAL_CIRCLE",
    "OBS_60_CNT_SOCIAL_CIRCLE", "DEF_30_CNT_SOCIAL_CIRCLE", "OBS_30_CNT_SOCIAL_CIRCLE", "REGION_POPULATION_RELATIVE",
    "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3",
]


def _frame(spark, rows, keys, numbers, texts=()):
    types = [f"{k} long" for k in keys] + [f"{n} double" for n in numbers] + [f"{t} string" for t in texts]
    return spark.createDataFrame(rows, ", ".join(types))


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(9)

    def num():
        return None if rng.random() < 0.1 else float(rng.randrange(0, 6))

    def application(ids, labelled):
        rows = []
        for k in ids:
            numbers = [num() for _ in APPLICATION_NUMBERS]
            if k % 9 == 0:
                numbers[7] = 365243.0
            text = rng.choice(["M", "F", "XNA", None])
            rows.append((k, *numbers, text, *([int(k % 4 == 0)] if labelled else [])))
        types = ", ".join(["SK_ID_CURR long", *[f"{n} double" for n in APPLICATION_NUMBERS], "CODE_GENDER string"])
        return spark.createDataFrame(rows, types + (", TARGET int" if labelled else ""))

    def history(loan_key, numbers, text, share=0.8, customers=True):
        rows = []
        for loan in range(1000, 1000 + 2 * N):
            for _ in range(rng.randrange(0, 4)):
                owner = (loan * 7) % int(N * share)
                rows.append(
                    (*((owner,) if customers else ()), loan, *[num() for _ in numbers], rng.choice(["Closed", "Active", "XNA", None]))
                )
        keys = ["SK_ID_CURR", loan_key] if customers else [loan_key]
        return _frame(spark, rows, keys, numbers, [text])

    def inputs(specs):
        return list(dict.fromkeys(f for s in specs for f in s.features))

    return {
        "application_train": application(range(0, N - 15), True),
        "application_test": application(range(N - 15, N), False),
        "bureau": history("SK_ID_BUREAU", inputs(sets.BUREAU), "CREDIT_ACTIVE"),
        "bureau_balance": history("SK_ID_BUREAU", ["MONTHS_BALANCE"], "STATUS", customers=False),
        "previous_application": history("SK_ID_PREV", inputs(sets.PREVIOUS), "NAME_CONTRACT_STATUS"),
        "credit_card_balance": history("SK_ID_PREV", inputs(sets.CARD), "NAME_CONTRACT_STATUS"),
        "POS_CASH_balance": history("SK_ID_PREV", inputs(sets.POINT_OF_SALE), "NAME_CONTRACT_STATUS"),
        "installments_payments": history("SK_ID_PREV", inputs(sets.INSTALMENTS), "NAME_NONE"),
    }


def to_pandas(df):
    pdf = pd.DataFrame([r.asDict() for r in df.collect()], columns=df.columns)
    return pdf.astype({c: float for c in df.columns if dict(df.dtypes)[c] in ("double", "int", "bigint") and c != "SK_ID_CURR"})


def filled(series):
    return series.fillna(series.mean())


@pytest.mark.parametrize("encode", ["one_hot", "drop"])
def test_flat_features(tables, encode):
    wide = loans.flat_features(tables, encode=encode, stage=encode == "drop")
    assert not [c for c in wide.columns if "SK_ID_PREV" in c or "SK_ID_BUREAU" in c]
    assert ("feature_CODE_GENDER_M" in wide.columns) == (encode == "one_hot")
    got = to_pandas(wide).set_index("SK_ID_CURR").sort_index()
    assert len(got) == N and list(got.index) == list(range(N))
    assert got["TARGET"].isna().sum() == 15

    app = pd.concat([to_pandas(tables["application_train"]), to_pandas(tables["application_test"])]).set_index("SK_ID_CURR")
    employed = filled(app["DAYS_EMPLOYED"].mask(app["DAYS_EMPLOYED"] == 365243))
    birth = filled(app["DAYS_BIRTH"])
    assert got["DAYS_BIRTH_minus_DAYS_EMPLOYED"].to_list() == pytest.approx((birth - employed).sort_index().to_list())
    income, annuity = filled(app["AMT_INCOME_TOTAL"]), filled(app["AMT_ANNUITY"])
    # 0/0 is filled with 0 by the encoder; infinity stays until the last clean
    ratio = (income / annuity).fillna(0).replace([math.inf, -math.inf], math.nan)
    assert got["AMT_INCOME_TOTAL_over_AMT_ANNUITY"].to_list() == pytest.approx(filled(ratio).sort_index().to_list())

    card = to_pandas(tables["credit_card_balance"])
    balance, drawn = filled(card["AMT_BALANCE"]), filled(card["AMT_DRAWINGS_CURRENT"])
    raw = balance / drawn
    attached = raw.groupby(card["SK_ID_CURR"]).transform("max")
    expected = {
        "AMT_BALANCE_over_AMT_DRAWINGS_CURRENT": filled(raw.replace([math.inf, -math.inf], math.nan)),
        "AMT_BALANCE_over_AMT_DRAWINGS_CURRENT_max": filled(attached.replace([math.inf, -math.inf], math.nan)),
    }
    for name, rows in expected.items():
        means = rows.groupby(card["SK_ID_CURR"]).mean().reindex(range(N))
        assert got[name].to_list() == pytest.approx(filled(means).to_list()), name
    sizes = card.groupby("SK_ID_CURR").size().reindex(range(N)).astype(float)
    assert got["card_rows"].to_list() == pytest.approx(filled(sizes).to_list())

    bureau, monthly = to_pandas(tables["bureau"]), to_pandas(tables["bureau_balance"])
    monthly["MONTHS_BALANCE"] = filled(monthly["MONTHS_BALANCE"])
    means = monthly.groupby("SK_ID_BUREAU")["MONTHS_BALANCE"].mean()
    joined = bureau.assign(m=bureau["SK_ID_BUREAU"].map(means), active=(bureau["CREDIT_ACTIVE"] != "Closed").astype(float))
    per_customer = joined.groupby("SK_ID_CURR")[["m", "active"]].mean().reindex(range(N))
    assert got["MONTHS_BALANCE"].to_list() == pytest.approx(filled(per_customer["m"]).to_list())
    assert got["credit_active"].to_list() == pytest.approx(filled(per_customer["active"]).to_list())


@pytest.mark.parametrize("functional", [False, True])
def test_two_level_features(tables, functional):
    wide = loans.two_level_features(tables, functional)
    got = to_pandas(wide).set_index("SK_ID_CURR").sort_index()
    assert len(got) == N
    assert got["feature_CODE_GENDER_nan"].sum() > 0
    prev = to_pandas(tables["previous_application"])
    prev["AMT_CREDIT"] = prev["AMT_CREDIT"].fillna(0)
    prev["open"] = (prev["NAME_CONTRACT_STATUS"] == "Active").astype(float)
    for column, name in (("AMT_CREDIT", "AMT_CREDIT"), ("open", "feature_NAME_CONTRACT_STATUS_Active")):
        for stat, how in (("average", "mean"), ("max", "max"), ("count", "count")):
            repeated = prev.groupby("SK_ID_PREV")[column].transform(how)
            expected = repeated.groupby(prev["SK_ID_CURR"]).mean().reindex(range(N))
            result = got[f"{name}_prev_{stat}"]
            assert result.dropna().to_list() == pytest.approx(expected.dropna().to_list())
            assert list(result.dropna().index) == list(expected.dropna().index)


@pytest.mark.parametrize("plan", [loans.flat_features, loans.two_level_features])
def test_customers_listed_twice_become_one_row(tables, plan):
    train = tables["application_train"]
    again = train.filter("SK_ID_CURR < 8").withColumn("AMT_CREDIT", F.lit(9.0))
    twice = {**tables, "application_train": train.unionByName(again)}
    many, once = to_pandas(plan(twice)), to_pandas(plan(twice, one_row=True))
    assert not many["SK_ID_CURR"].is_unique and once["SK_ID_CURR"].is_unique and set(once.columns) == set(many.columns)
    means = many.groupby(["SK_ID_CURR", loans.PART])["AMT_CREDIT"].mean()
    got = once.set_index(["SK_ID_CURR", loans.PART])["AMT_CREDIT"]
    assert len(got) == len(means) and ((got - means).abs().fillna(0) < 1e-9).all()


def test_replayed_features(tables):
    specs = {
        "df_cc": [
            FeatureSpec("f_0_df_cc", "mul_feature_creator", ("AMT_BALANCE", "a5"), "df_cc"),
            FeatureSpec("f_1_df_cc", "sum_feature_creator", ("f_0_df_cc", "NAME_CONTRACT_STATUS"), "df_cc"),
        ]
    }
    wide = loans.replayed_features(tables, specs)
    got = to_pandas(wide).set_index("SK_ID_CURR").sort_index()
    card = to_pandas(tables["credit_card_balance"])
    app = pd.concat([to_pandas(tables["application_train"]), to_pandas(tables["application_test"])]).set_index("SK_ID_CURR")
    a5 = (app["AMT_CREDIT"] / app["AMT_INCOME_TOTAL"].fillna(1).clip(lower=1)).fillna(0)
    codes = {v: i for i, v in enumerate(sorted(card["NAME_CONTRACT_STATUS"].fillna("").unique()))}
    f0 = card["AMT_BALANCE"].fillna(0) * card["SK_ID_CURR"].map(a5)
    f1 = f0 + card["NAME_CONTRACT_STATUS"].fillna("").map(codes)
    for name, rows in (("f_0_df_cc", f0), ("f_1_df_cc", f1)):
        expected = rows.groupby(card["SK_ID_CURR"]).mean().reindex(got.index).fillna(0)
        assert got[f"{name}_df_cc_mean"].to_list() == pytest.approx(expected.to_list())
    owners = set()
    for name in ("bureau", "previous_application", "credit_card_balance", "POS_CASH_balance", "installments_payments"):
        owners |= {r[0] for r in tables[name].select("SK_ID_CURR").distinct().collect()}
    assert {k for k in got.index if not pd.isna(k)} == owners - {None}


def test_share_features(tables):
    wide = loans.share_features(tables)
    got = to_pandas(wide).set_index("SK_ID_CURR").sort_index()
    assert list(got.index) == list(range(N)) and got["TARGET"].isna().sum() == 15
    card = to_pandas(tables["credit_card_balance"])
    card["open"] = (card["NAME_CONTRACT_STATUS"] == "Active").astype(float)
    card["none"] = card["NAME_CONTRACT_STATUS"].isna().astype(float)
    card["AMT_BALANCE"] = card["AMT_BALANCE"].fillna(0)
    by = card.groupby("SK_ID_CURR")
    for column, name in (
        ("open", "feature_NAME_CONTRACT_STATUS_Active_mean_cc"),
        ("none", "feature_NAME_CONTRACT_STATUS__mean_cc"),
        ("AMT_BALANCE", "AMT_BALANCE_mean"),
    ):
        result = got[name].dropna()
        assert result.to_list() == pytest.approx(by[column].mean().to_list()) and list(result.index) == list(by.groups)
    assert got["cc_rows"].dropna().to_list() == by.size().astype(float).to_list()


def test_searched_features(spark, tables):
    known = {f for s in (*sets.MANUAL, *sets.SEARCHED) for f in s.features}
    known -= {s.name for s in (*sets.MANUAL, *sets.SEARCHED)}
    extra = sorted(known - set(tables["application_train"].columns))
    texts = {"OCCUPATION_TYPE", "FLAG_OWN_CAR", "NAME_FAMILY_STATUS", "NAME_EDUCATION_TYPE"}

    def widened(df):
        cells = [
            F.when(F.col("SK_ID_CURR") % 3 != 0, F.concat(F.lit("v"), F.col("SK_ID_CURR") % 5)).alias(c)
            if c in texts
            else (F.col("SK_ID_CURR") % (i + 2)).cast("double").alias(c)
            for i, c in enumerate(extra)
        ]
        return df.select("*", *cells)

    parts = {n: widened(tables[n]) for n in ("application_train", "application_test")}
    wide = loans.searched_features({**tables, **parts}, stage=True)
    got = to_pandas(wide).set_index("SK_ID_CURR").sort_index()
    assert list(got.index) == list(range(N))
    app = pd.concat([to_pandas(parts["application_train"]), to_pandas(parts["application_test"])])
    app = app.set_index("SK_ID_CURR").sort_index()
    codes = {v: i for i, v in enumerate(sorted(app["OCCUPATION_TYPE"].fillna("").unique()))}
    occupation = app["OCCUPATION_TYPE"].fillna("").map(codes)
    expected = [math.hypot(a, b) for a, b in zip(app["LIVINGAREA_MEDI"], occupation)]
    assert got["a22_int_mean"].to_list() == pytest.approx(expected)
    credit, goods = app["AMT_CREDIT"].fillna(0), app["AMT_GOODS_PRICE"].fillna(0)
    a25 = app["DAYS_EMPLOYED"].fillna(0) * credit / goods.clip(lower=1)
    assert got["a25_int_mean"].to_list() == pytest.approx(a25.to_list())
    balance = to_pandas(tables["credit_card_balance"]).groupby("SK_ID_CURR")["AMT_BALANCE"].mean().reindex(range(N)).fillna(0)
    assert got["AMT_BALANCE_int_mean"].to_list() == pytest.approx(balance.to_list())


def test_label_profile(tables):
    got = {(r["column"], r["value"]): (r["target_mean"], r["target_count"]) for r in loans.label_profile(tables).collect()}
    app = to_pandas(tables["application_train"])
    app["CODE_GENDER"] = app["CODE_GENDER"].replace("XNA", "")
    for value, group in app.groupby("CODE_GENDER"):
        assert got["CODE_GENDER", value] == (pytest.approx(group["TARGET"].mean()), len(group))
    assert ("SK_ID_CURR", "1") not in got
    assert any(c == "AMT_INCOME_TOTAL_over_AMT_ANNUITY" for c, _ in got)


def test_training_on_the_wide_table(tables):
    wide = loans.flat_features(tables, encode="drop", stage=True)
    train, test = loans.finished_parts(wide, -1)
    assert train.count() == N - 15 and test.count() == 15
    assert test.filter(F.col("TARGET").isNotNull()).count() == 0
    out = loans.train_and_score(wide, share=0.3, params=SMALL_TREES.with_(max_iter=2, max_depth=2, min_instances=2))
    assert out["scores"].columns == ["SK_ID_CURR", "TARGET"] and out["scores"].count() == 15
    assert out["importances"].count() == len(wide.columns) - 3
    assert out["auc"].count() == 1 and out["logloss"].first()[0] > 0
    ordered = loans.train_and_score(
        wide, share=0.2, params=SMALL_TREES.with_(max_iter=2, max_depth=2, min_instances=2), ordered=True
    )
    counts = ordered["auc"].first()
    assert counts["positives"] + counts["negatives"] == 9


def test_feature_sets_replay_in_order():
    columns = {f for s in (*sets.MANUAL, *sets.SEARCHED, *sets.STORED) for f in s.features} - {
        s.name for s in (*sets.MANUAL, *sets.SEARCHED, *sets.STORED)
    }
    assert len(sets.APPLICATION) == 12 and len(sets.MANUAL) == 19 and len(sets.SEARCHED) == 26 and len(sets.STORED) == 30
    assert sum(map(len, layers(sorted(columns), [*sets.MANUAL, *sets.SEARCHED]))) == 45
    depth = {s.name: i for i, layer in enumerate(layers(sorted(columns), [*sets.MANUAL, *sets.STORED])) for s in layer}
    assert depth["f_26_df_app"] > depth["f_25_df_app"] > depth["f_16_df_app"]


def test_all_named_sets_run(spark):
    names = sorted(
        {f for s in (*sets.MANUAL, *sets.SEARCHED, *sets.STORED) for f in s.features}
        - {s.name for s in (*sets.MANUAL, *sets.SEARCHED, *sets.STORED)}
    )
    df = spark.range(3).selectExpr("id", *[f"double(id + {i}) AS {n}" for i, n in enumerate(names)])
    out = apply_specs(df, [*sets.MANUAL, *sets.SEARCHED, *sets.STORED])
    assert out.count() == 3 and len(out.columns) == 1 + len(names) + 75

"""Round trips through files, in a scratch folder."""

import pytest
from pyspark.sql import functions as F

from entityloom import ensure_checkpoint_dir
from entityloom.plans import featuresets as sets
from entityloom.plans.replay import FeatureSpec
from entityloom.schema import EntitySchema, sql_literal
from entityloom.session import checkpointed, stored
from entityloom.sources import metrics, sinks, specs, tables

SF = "/root/testdata/sf0.001"


def bag(df):
    return sorted(map(str, map(tuple, df.select(*sorted(df.columns)).collect())))


def test_csv_round_trip(spark, tmp_path):
    customer = spark.read.parquet(f"{SF}/customer.parquet")
    path = str(tmp_path / "customer")
    sinks.write_csv(customer, path)
    assert bag(tables.scan_csv(spark, path, schema=customer.schema)) == bag(customer)
    inferred = tables.scan_csv(spark, path)
    assert inferred.columns == customer.columns and dict(inferred.dtypes)["c_acctbal"] == "double"


def test_csv_by_name_rules(spark, tmp_path):
    path = str(tmp_path / "app.csv")
    with open(path, "w") as f:
        f.write("SK_ID_CURR,TARGET,AMT_CREDIT,CODE_GENDER,FLAG_OWN_CAR,FLAG_MOBIL,LANDAREA_AVG,YEARS_BUILD_MODE\n")
        f.write("1,0,10.5,M,Y,1,0.5,0.25\n2,,NaN,,N,0,,\n")
    df = tables.scan_csv(spark, path, rules=tables.LOAN_TYPES)
    assert [t for _, t in df.dtypes] == ["bigint", "int", "double", "string", "string", "int", "double", "double"]
    # NaN and empty cells are both missing
    assert tuple(df.filter("SK_ID_CURR = 2").first()) == (2, None, None, None, "N", 0, None, None)


def test_parquet_stage(spark, tmp_path):
    orders = tables.scan_table(spark, SF, "orders")
    assert bag(sinks.staged(orders, str(tmp_path / "stage"))) == bag(orders)
    assert set(tables.scan_tables(spark, SF, ["orders", "part"])) == {"orders", "part"}


def test_first_rows_are_stable(spark):
    orders = tables.scan_table(spark, SF, "orders").repartition(5)
    assert [r["o_orderkey"] for r in tables.scan_first(orders, "o_orderkey", 3).collect()] == [0, 1, 2]


def test_specs_round_trip(spark, tmp_path):
    for i, listed in enumerate((sets.STORED, sets.MANUAL, [])):
        path = str(tmp_path / f"specs{i}")
        specs.save_specs(spark, listed, path)
        assert specs.load_specs(spark, path) == list(listed)


def test_specs_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "exported")
    specs.export_specs(spark, sets.STORED, path)
    assert specs.import_specs(spark, path) == list(sets.STORED)


def test_specs_from_a_written_csv(spark, tmp_path):
    path = tmp_path / "features.csv"
    path.write_text(
        "df_name,features,function,name\n"
        "app,\"['b', 'f_0_app']\",sum_feature_creator,f_10_app\n"
        "app,\"['a', 'b']\",divide_feature_creator,f_0_app\n"
    )
    assert specs.import_specs(spark, str(path)) == [
        FeatureSpec("f_0_app", "divide_feature_creator", ("a", "b"), "app"),
        FeatureSpec("f_10_app", "sum_feature_creator", ("b", "f_0_app"), "app"),
    ]


def test_metric_log(spark, tmp_path):
    path = tmp_path / "log.tsv"
    path.write_text("iter\tAUC\tLogloss\n0\t0.7\t0.69\n1\t0.75\t0.68\n2\t0.75\t0.67\n")
    log = metrics.scan_metric_log(spark, str(path))
    assert log.count() == 3
    assert tuple(metrics.best_iteration(log).first()) == (1, 0.75, 0.68)


def test_stored_and_checkpointed(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    for copy in (stored(df), checkpointed(df)):
        assert bag(copy) == bag(df)
        assert "Range" not in copy._jdf.queryExecution().executedPlan().toString()


def test_checkpoint_dir_is_set_once(spark):
    ensure_checkpoint_dir(spark)
    first = spark.sparkContext.getCheckpointDir()
    ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir() == first


def test_checkpoint_dir_on_a_cluster():
    class Conf:
        def __init__(self, named):
            self.named = named

        def get(self, key, default):
            assert key == "spark.checkpoint.dir"
            return self.named or default

    class Context:
        master, set_to = "spark://host:7077", None

        def getCheckpointDir(self):
            return self.set_to

        def setCheckpointDir(self, path):
            self.set_to = path

    class Session:
        def __init__(self, named):
            self.sparkContext, self.conf = Context(), Conf(named)

    shared = Session("hdfs://shared/checkpoints")
    ensure_checkpoint_dir(shared)
    assert shared.sparkContext.set_to == "hdfs://shared/checkpoints"
    # never a machine-local folder
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session(None))


def test_literals():
    assert [sql_literal(v) for v in (None, True, 3, 2.5, "a'b")] == ["NULL", "true", "3", "double('2.5')", "'a\\'b'"]


def test_protected_columns():
    from entityloom.plans.loans import LOANS

    assert LOANS.protected == ("SK_ID_CURR", "SK_ID_BUREAU", "SK_ID_PREV", "TARGET")
    assert EntitySchema("k").protected == ("k",)


def test_time_log(spark, tmp_path):
    from entityloom.sources.metrics import scan_time_log

    path = tmp_path / "time.tsv"
    path.write_text("iter\tPassed\tRemaining\n0\t0.5\t500\n1\t1.25\t499.5\n")
    assert [tuple(r) for r in scan_time_log(spark, str(path)).orderBy("iter").collect()] == [(0, 0.5, 500.0), (1, 1.25, 499.5)]

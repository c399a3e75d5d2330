"""Stages that are picked up again, and prefixes in file order."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from entityloom.sources import tables
from entityloom.sources.stages import Stages, files_fingerprint, plan_text

SF = "/root/testdata/sf0.001"


def bag(df):
    return sorted(map(str, map(tuple, df.select(*sorted(df.columns)).collect())))


def four(spark, stages, source, fail_at=None, factor=2):
    """A pipeline of four stages; ``fail_at`` kills the run inside that stage."""

    def step(i, df):
        if i == fail_at:
            df = df.withColumn("price", F.expr("CASE WHEN price IS NOT NULL THEN raise_error('lost') ELSE price END").cast("double"))
        return stages.stage(f"s{i}", df)

    orders = spark.read.parquet(source)
    a = step(1, orders.selectExpr("o_custkey AS k", "o_totalprice AS price"))
    b = step(2, a.withColumn("price", F.col("price") + 1))
    c = step(3, b.withColumn("price", F.col("price") * factor))
    return step(4, c.groupBy("k").agg(F.max("price").alias("price")))


def test_a_killed_run_goes_on_where_it_stopped(spark, tmp_path):
    source, folder = f"{SF}/orders.parquet", str(tmp_path / "st")
    want = bag(spark.read.parquet(source).groupBy(F.col("o_custkey").alias("k")).agg(F.max((F.col("o_totalprice") + 1) * 2).alias("price")))
    killed = Stages(spark, folder)
    with pytest.raises(Exception, match="lost"):
        four(spark, killed, source, fail_at=4)
    assert killed.made == ["s1", "s2", "s3"]
    again = Stages(spark, folder)
    assert bag(four(spark, again, source)) == want
    assert again.found == ["s1", "s2", "s3"] and again.made == ["s4"]
    # another factor concerns stages 3 and 4 only
    other = Stages(spark, folder)
    assert bag(four(spark, other, source, factor=3)) != want
    assert other.found == ["s1", "s2"] and other.made == ["s3", "s4"]
    other.finish("s4")
    assert sorted(os.listdir(folder)) == ["s4"] and len([x for x in os.listdir(f"{folder}/s4") if x.endswith(".done")]) == 1


def test_data_without_a_marker_is_written_anew(spark, tmp_path):
    folder, df = str(tmp_path / "st"), spark.read.parquet(f"{SF}/nation.parquet")
    first = Stages(spark, folder)
    mark = first.fingerprint(df)
    spark.range(3).write.parquet(f"{folder}/n/{mark}")
    assert bag(first.stage("n", df)) == bag(df) and first.made == ["n"]
    second = Stages(spark, folder)
    second.stage("n", df)
    assert second.found == ["n"]
    second.finish("n")
    assert bag(Stages(spark, folder).stage("n", df)) == bag(df)


def test_fingerprints_follow_files_plans_and_versions(spark, tmp_path):
    path = str(tmp_path / "in put%20")
    spark.range(5).coalesce(1).write.parquet(path)
    stages, df = Stages(spark, str(tmp_path / "st")), spark.read.parquet(path)
    same = [stages.fingerprint(spark.read.parquet(path).filter("id > 1")) for _ in range(2)]
    assert same[0] == same[1] != stages.fingerprint(df.filter("id > 2"))
    assert plan_text(df.selectExpr("id AS a", "id AS b")) == plan_text(spark.read.parquet(path).selectExpr("id AS a", "id AS b"))
    assert stages.fingerprint(df, "a") != stages.fingerprint(df, "b")
    before = files_fingerprint(df)
    spark.range(1).write.mode("append").parquet(path)
    assert files_fingerprint(spark.read.parquet(path)) != before
    wide = df.selectExpr(*[f"id + {i} AS c{i}" for i in range(60)])
    other = df.selectExpr(*[f"id + {i if i < 59 else 99} AS c{i}" for i in range(60)])
    assert stages.fingerprint(wide) != stages.fingerprint(other)
    local = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError, match="version"):
        stages.stage("local", local)
    assert stages.stage("local", local, version="one").count() == 1
    for bad in ("", "../x", "a/b", "local"):
        with pytest.raises(ValueError):
            stages.stage(bad, df)
    with pytest.raises(ValueError):
        stages.finish("nothing")


@pytest.mark.parametrize("n", [0, 1, 7, 10, 11, 25, 30, 99])
def test_prefix_in_file_order(spark, tmp_path, n):
    folder = tmp_path / "a folder%"
    folder.mkdir()
    for i, start in enumerate((20, 0, 10)):  # file order is not the order of values
        pq.write_table(pa.table({"v": list(range(start, start + 10)), "w": [float("nan")] * 10}), folder / f"p{i}.parquet", row_group_size=3)
    pq.write_table(pa.table({"v": pa.array([], pa.int64()), "w": pa.array([], pa.float64())}), folder / "p00.parquet")
    got = tables.scan_prefix(tables.scan_parquet(spark, str(folder)), n)
    want = [*range(20, 30), *range(0, 10), *range(10, 20)][:n]
    assert sorted(r["v"] for r in got.collect()) == sorted(want)
    assert got.columns == ["v", "w"] and all(r["w"] is None for r in got.collect())
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in text and "Exchange hash" not in text
    with pytest.raises(ValueError):
        tables.scan_prefix(got, -1)


def test_prefix_reads_no_file_behind_it(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(12):
        pq.write_table(pa.table({"v": [i] * 10}), folder / f"p{i:02}.parquet")
    df = tables.scan_parquet(spark, str(folder))
    got = tables.scan_prefix(df, 25)
    assert sorted(r["v"] for r in got.collect()) == [0] * 10 + [1] * 10 + [2] * 5
    # files behind the prefix may even be broken
    (folder / "p11.parquet").write_bytes(b"no parquet")
    assert tables.scan_prefix(df, 25).count() == 25

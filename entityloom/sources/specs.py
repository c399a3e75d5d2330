"""Feature specs as tables: JSON to keep, CSV to exchange."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityloom.plans.replay import FeatureSpec

SPEC_SCHEMA = T.StructType(
    [
        T.StructField("df_name", T.StringType()),
        T.StructField("features", T.ArrayType(T.StringType())),
        T.StructField("function", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("position", T.IntegerType()),
    ]
)


def spec_table(spark: SparkSession, specs: Iterable[FeatureSpec]) -> DataFrame:
    """Specs as a table; the position keeps their order."""
    rows = [(s.df_name, list(s.features), s.function, s.name, i) for i, s in enumerate(specs)]
    return spark.createDataFrame(rows, SPEC_SCHEMA)


def specs_of(table: DataFrame) -> list[FeatureSpec]:
    """The specs of a table, in order. They describe a plan, so they are few."""
    rows = table.orderBy("position").collect()
    return [FeatureSpec(r["name"], r["function"], tuple(r["features"]), r["df_name"] or "") for r in rows]


def save_specs(spark: SparkSession, specs: Iterable[FeatureSpec], path: str) -> None:
    spec_table(spark, specs).write.mode("overwrite").json(path)


def load_specs(spark: SparkSession, path: str) -> list[FeatureSpec]:
    return specs_of(spark.read.schema(SPEC_SCHEMA).json(path))


def export_specs(spark: SparkSession, specs: Iterable[FeatureSpec], path: str) -> None:
    """CSV with the inputs as the text of a list of quoted names."""
    quoted_names = F.transform("features", lambda f: F.concat(F.lit("'"), f, F.lit("'")))
    listed = F.concat(F.lit("["), F.array_join(quoted_names, ", "), F.lit("]"))
    table = spec_table(spark, specs).orderBy("position")
    table.select("df_name", listed.alias("features"), "function", "name").coalesce(1).write.mode("overwrite").option(
        "header", True
    ).csv(path)


def import_specs(spark: SparkSession, path: str) -> list[FeatureSpec]:
    """Specs from such a CSV. Names end in a number by which rows are put in order."""
    text = T.StructType([T.StructField(n, T.StringType()) for n in ("df_name", "features", "function", "name")])
    raw = spark.read.option("header", True).schema(text).csv(path)
    features = F.from_json(F.translate("features", "'", '"'), "array<string>")
    number = F.regexp_extract("name", r"^f_(\d+)", 1).try_cast("int")
    return specs_of(raw.select("df_name", features.alias("features"), "function", "name", number.alias("position")))

"""CSV inputs and outputs of the pipeline.

Inputs are read by header name with explicit types (no inference pass over the data) and
renamed to the library's snake_case columns. Outputs are written by the
executors as part files of a directory; nothing is gathered on the driver.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FACT_SCHEMA = T.StructType([
    T.StructField("Store", T.IntegerType()), T.StructField("DayOfWeek", T.IntegerType()),
    T.StructField("Date", T.DateType()), T.StructField("Sales", T.DoubleType()),
    T.StructField("Customers", T.LongType()), T.StructField("Open", T.IntegerType()),
    T.StructField("Promo", T.IntegerType()), T.StructField("StateHoliday", T.StringType()),
    T.StructField("SchoolHoliday", T.IntegerType())])
HORIZON_SCHEMA = T.StructType([
    T.StructField("Id", T.LongType()), T.StructField("Store", T.IntegerType()),
    T.StructField("DayOfWeek", T.IntegerType()), T.StructField("Date", T.DateType()),
    T.StructField("Open", T.IntegerType()), T.StructField("Promo", T.IntegerType()),
    T.StructField("StateHoliday", T.StringType()), T.StructField("SchoolHoliday", T.IntegerType())])
STORE_SCHEMA = T.StructType([
    T.StructField("Store", T.IntegerType()), T.StructField("StoreType", T.StringType()),
    T.StructField("Assortment", T.StringType()), T.StructField("CompetitionDistance", T.DoubleType()),
    T.StructField("CompetitionOpenSinceMonth", T.IntegerType()),
    T.StructField("CompetitionOpenSinceYear", T.IntegerType()), T.StructField("Promo2", T.IntegerType()),
    T.StructField("Promo2SinceWeek", T.IntegerType()), T.StructField("Promo2SinceYear", T.IntegerType()),
    T.StructField("PromoInterval", T.StringType())])

KNOWN_TYPES = {f.name: f.dataType for s in (FACT_SCHEMA, HORIZON_SCHEMA, STORE_SCHEMA) for f in s.fields}


def snake(name: str) -> str:
    """CamelCase header -> snake_case column (Promo2SinceWeek -> promo2_since_week)."""
    s = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name)
    return s.lower()


def to_snake(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake(c) for c in df.columns])


def by_header(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """The files grouped by their first line, read in one job (one line a file reaches the driver).

    Only columns and their order count: each group is one CSV read, whatever its number of files. Empty files have no
    header and are left out."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"),
                                          F.monotonically_increasing_id().alias("line"), "value")
    first = lines.filter("at = 0").groupBy("path").agg(F.min_by("value", "line").alias("header"))
    groups = first.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("header")
    return [r["paths"] for r in groups.collect()]


def _columns(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The header's column names."""
    try:
        return spark.read.option("header", True).csv(path if isinstance(path, str) else path[0]).columns
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise FileNotFoundError(f"Missing: {path}") from e
        raise


def _read_by_header(spark: SparkSession, path: str | list[str], types: dict, required: list[str]) -> DataFrame:
    """A CSV (file, folder, or list of files with one header) whose columns are bound by header name; columns without a type are strings.

    Spark binds a given schema by position, so the schema is built in the header's order and every
    file's header is checked against it (``enforceSchema`` off); a value that does not parse fails."""
    names = _columns(spark, path)
    missing = [c for c in required if c not in names]
    if missing:
        raise ValueError(f"{path} lacks required columns: {missing}")
    schema = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in names])
    return (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
            .option("dateFormat", "yyyy-MM-dd").option("mode", "FAILFAST").csv(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A header CSV with the columns of ``schema`` in any order; other columns are left out.

    A missing input fails early as FileNotFoundError, a missing column as ValueError."""
    types = {f.name: f.dataType for f in schema.fields}
    return to_snake(_read_by_header(spark, path, types, list(types)).select(*types))


def read_raw(spark: SparkSession, data_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train facts, store dimension, horizon) from train.csv, store.csv, test.csv."""
    base = data_dir.rstrip("/")
    return (read_csv(spark, f"{base}/train.csv", FACT_SCHEMA),
            read_csv(spark, f"{base}/store.csv", STORE_SCHEMA),
            read_csv(spark, f"{base}/test.csv", HORIZON_SCHEMA))


def read_upload(spark: SparkSession, path: str | list[str], required: tuple[str, ...] = ("Date", "Store")) -> DataFrame:
    """An uploaded CSV with any column set in any order; known columns get their types."""
    return to_snake(_read_by_header(spark, path, KNOWN_TYPES, list(required)))


def _write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_submission(sub: DataFrame, path: str) -> None:
    """Id, Sales (already rounded to cents)."""
    _write_csv(sub.select(F.col("id").alias("Id"), F.col("sales").alias("Sales")), path)


def write_forecast(daily: DataFrame, path: str) -> None:
    """Date, Store, Open, Predicted_Sales."""
    _write_csv(daily.select(F.col("date").alias("Date"), F.col("store").alias("Store"),
                            F.col("open").alias("Open"), F.col("predicted_sales").alias("Predicted_Sales")), path)


def write_batch(scored: DataFrame, path: str) -> None:
    """[Id,] Date, Store, Predicted_Sales."""
    cols = ([F.col("id").alias("Id")] if "id" in scored.columns else []) + [
        F.col("date").alias("Date"), F.col("store").alias("Store"),
        F.col("predicted_sales").alias("Predicted_Sales")]
    _write_csv(scored.select(*cols), path)


def write_metrics_json(spark: SparkSession, best_model: str, metrics: dict[str, dict], path: str) -> DataFrame:
    """One JSON record: best_model, one struct per model, and ``best``."""
    names = sorted(metrics)
    keys = ["RMSE", "MAE", "MAPE", "RMSPE", "R2"]
    row = [best_model] + [tuple(float(metrics[n][k]) for k in keys) for n in names] + \
          [tuple(float(metrics[best_model][k]) for k in keys)]
    struct = "struct<" + ",".join(f"{k}:double" for k in keys) + ">"
    schema = "best_model string, " + ", ".join(f"`{n}` {struct}" for n in names) + f", best {struct}"
    df = spark.createDataFrame([tuple(row)], schema)
    df.coalesce(1).write.mode("overwrite").json(path)
    return df

"""Writing results."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _files(spark: SparkSession, path: str):
    """The file system of ``path``, and a maker of its paths."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def _rows_below(spark: SparkSession, path: str, format: str, schema: T.StructType) -> int:
    reader = spark.read.format(format).schema(schema)
    if format == "csv":
        reader = reader.options(header=True, multiLine=True, mode="PERMISSIVE")
    return reader.load(path).count()


def replace(df: DataFrame, path: str, format: str = "parquet", **options) -> str:
    """Write ``df`` beside ``path``, count what is there, and only then put it in the place of the old table.

    A write that fails or comes out short leaves the old table as it is, and
    readers find either the old or the new one, but for the moment between two
    renames. On a store without renames of folders a swap costs a copy.
    """
    spark, token = df.sparkSession, uuid.uuid4().hex[:12]
    staged, old = f"{path.rstrip('/')}.new-{token}", f"{path.rstrip('/')}.old-{token}"
    files, make = _files(spark, path)
    seen = Observation()
    try:
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(format).options(**options).save(staged)
        rows, found = seen.get["rows"], _rows_below(spark, staged, format, df.schema)
        if rows != found:
            raise RuntimeError(f"{path}: {rows} rows were written, {found} are there")
        had = files.exists(make(path))
        if had and not files.rename(make(path), make(old)):
            raise RuntimeError(f"{path} could not be set aside")
        if not files.rename(make(staged), make(path)):
            if had:
                files.rename(make(old), make(path))
            raise RuntimeError(f"{path} could not be put in place")
    finally:
        files.delete(make(staged), True)
    files.delete(make(old), True)
    return path


def save_dataframe(df: DataFrame, path: str, format: str = "parquet", mode: str = "overwrite") -> str:
    """Write ``df`` to ``path``; CSV gets a header. One file per task, never one task. Overwriting is a ``replace``."""
    options = {"header": True} if format == "csv" else {}
    if mode == "overwrite":
        return replace(df, path, format, **options)
    df.write.mode(mode).options(**options).format(format).save(path)
    return path


def save_tables(
    tables: Mapping[str, DataFrame], database: str | None = None, prefix: str = "", location: str | None = None
) -> list[str]:
    """Save every table in the catalog, replacing what is there once the new one is complete.

    ``location`` puts the files below a folder of its own instead of the warehouse.
    """
    names = []
    for name, df in tables.items():
        spark, full = df.sparkSession, f"{database}.{prefix}{name}" if database else f"{prefix}{name}"
        if location:
            place = replace(df, f"{location}/{name}")
            spark.sql(f"DROP TABLE IF EXISTS {full}")
            spark.catalog.createTable(full, path=place, source="parquet", schema=df.schema)
        else:
            fresh = f"{full}_new_{uuid.uuid4().hex[:12]}"
            seen = Observation()
            try:
                df.observe(seen, F.count(F.lit(1)).alias("rows")).write.saveAsTable(fresh)
                if spark.table(fresh).count() != seen.get["rows"]:
                    raise RuntimeError(f"{full} came out short")
                spark.sql(f"DROP TABLE IF EXISTS {full}")
                spark.sql(f"ALTER TABLE {fresh} RENAME TO {full}")
            finally:
                spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        names.append(full)
    return names


def save_jdbc(df: DataFrame, url: str, table: str, batch: int = 10_000, **options: str) -> None:
    """Write ``df`` to a database table, replacing it. Each task opens one connection."""
    (
        df.write.format("jdbc")
        .options(url=url, dbtable=table, batchsize=str(batch), **options)
        .mode("overwrite")
        .save()
    )


def report_rows(report: DataFrame, generated_at: dt.datetime | dt.date) -> DataFrame:
    """Validation results as report lines."""
    return report.select("section", "check", "passed", "detail", F.lit(generated_at.isoformat()).alias("generated_at"))


def save_report(report: DataFrame, path: str, generated_at: dt.datetime | dt.date) -> str:
    """Write a validation report as JSON lines."""
    return replace(report_rows(report, generated_at), path, "json")


def save_metrics(metrics: DataFrame, path: str) -> str:
    """Write a one-row metrics table as JSON."""
    return replace(metrics, path, "json")


def save_model(table: DataFrame, features: Sequence[str], base: float, path: str) -> str:
    """Write an ensemble's leaf table with its base score and the features in their order."""
    spark = table.sparkSession
    save_dataframe(table, f"{path}/leaves")
    rows = [(i, f, float(base)) for i, f in enumerate(features)]
    save_dataframe(spark.createDataFrame(rows, "place int, feature string, base double"), f"{path}/features")
    return path


def load_model(spark: SparkSession, path: str) -> tuple[DataFrame, list[str], float]:
    """The leaf table, the feature columns and the base score."""
    rows = spark.read.parquet(f"{path}/features").orderBy("place").collect()
    return spark.read.parquet(f"{path}/leaves"), [r["feature"] for r in rows], rows[0]["base"] if rows else 0.0


def create_views(spark: SparkSession, views: Mapping[str, DataFrame]) -> list[str]:
    """Register DataFrames as views for ad hoc SQL."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)

"""Reading the seven tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions.dates import lenient_date
from rollcall.schema import FILES, REQUIRED, SERIALS, TABLES

TRUE_WORDS = ("true", "yes", "1")
FALSE_WORDS = ("false", "no", "0")


class MissingDatasets(FileNotFoundError):
    """Required datasets that were not found; ``names`` lists them."""

    def __init__(self, names: Iterable[str]):
        self.names = list(names)
        super().__init__(f"{len(self.names)} dataset(s) not found: {', '.join(self.names)}")


def _typed(column: str, to: T.DataType):
    text = F.trim(F.col(f"`{column}`"))
    if isinstance(to, T.DateType):
        return lenient_date(text)
    if isinstance(to, T.BooleanType):
        word = F.lower(text)
        return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)
    if isinstance(to, (T.IntegerType, T.LongType)):
        # "3.0" is how a nullable integer column is often written.
        return text.try_cast("decimal(20,2)").cast(to)
    return text.try_cast(to)


def conform(df: DataFrame, name: str) -> DataFrame:
    """Columns of ``df`` in the order and types of table ``name``.

    Works by column name, so extra columns are dropped and absent ones are
    NULL; values that do not parse are NULL. An absent serial key is numbered
    in file order, as a database would on load.
    """
    have = set(df.columns)
    out = []
    for field in TABLES[name].fields:
        if field.name in have:
            source = df.schema[field.name].dataType
            text = isinstance(source, T.StringType) and not isinstance(field.dataType, T.StringType)
            value = _typed(field.name, field.dataType) if text else F.col(f"`{field.name}`").cast(field.dataType)
        elif SERIALS.get(name) == field.name:
            value = F.monotonically_increasing_id()
        else:
            value = F.lit(None).cast(field.dataType)
        out.append(value.alias(field.name))
    return df.select(*out)


def read_table(spark: SparkSession, name: str, directory: str, format: str = "csv") -> DataFrame:
    """One table from ``directory``: ``<stem>.csv`` with a header, or ``<stem>.parquet``."""
    path = f"{directory.rstrip('/')}/{FILES.get(name, name)}.{format}"
    reader = spark.read.option("header", True) if format == "csv" else spark.read
    return conform(reader.format(format).load(path), name)


def coerced(df: DataFrame, name: str) -> DataFrame:
    """Values of an untyped table that do not parse, per column: column_name, coerced.

    They become NULL on reading and pass any "not in the future" check, so it is
    worth knowing how many there are.
    """
    texts = [f for f in TABLES[name].fields if f.name in df.columns and not isinstance(f.dataType, T.StringType)]
    counted = df.agg(
        *[
            F.count_if((F.trim(F.col(f"`{f.name}`")) != "") & _typed(f.name, f.dataType).isNull()).alias(f.name)
            for f in texts
        ]
    )
    return counted.unpivot([], [f.name for f in texts], "column_name", "coerced")


def missing_datasets(
    spark: SparkSession, directory: str, names: Iterable[str] = REQUIRED, format: str = "csv"
) -> list[str]:
    """Required tables whose file or folder does not exist, on any Hadoop file system."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    missing = []
    for name in names:
        path = jvm.org.apache.hadoop.fs.Path(f"{directory.rstrip('/')}/{FILES.get(name, name)}.{format}")
        if not path.getFileSystem(conf).exists(path):
            missing.append(name)
    return missing


def load_raw(
    spark: SparkSession, directory: str, names: Iterable[str] = REQUIRED, format: str = "csv"
) -> dict[str, DataFrame]:
    """All tables at once; raises :class:`MissingDatasets` before reading any."""
    names = list(names)
    missing = missing_datasets(spark, directory, names, format)
    if missing:
        raise MissingDatasets(missing)
    return {name: read_table(spark, name, directory, format) for name in names}


def dataset_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table, one row per table."""
    parts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("dataset"), "row_count", F.lit(len(df.columns)).alias("column_count")
        )
        for name, df in tables.items()
    ]
    profile, *rest = parts
    for part in rest:
        profile = profile.unionByName(part)
    return profile

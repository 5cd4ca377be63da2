"""Readers: tables, SQL, dated feeds, lookups, text."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.errors import SnapshotMissing
from feedkit.functions.scalars import norm_nan

# Fixed value: a feed may be up to 14 days old, today included.
LOOKBACK_DAYS = 15


def without_nan(df: DataFrame) -> DataFrame:
    """NaN becomes null in all float columns, which leaves one missing marker."""
    floats = [c for c, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: norm_nan(F.col(c)) for c in floats}) if floats else df


def table_scan(spark: SparkSession, path: str, schema: T.StructType | None = None, key: str | None = None) -> DataFrame:
    """Whole parquet table, NaN read as null; ``key`` moves the identifying column to the front."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = without_nan(reader.parquet(path))
    return df.select(key, *[c for c in df.columns if c != key]) if key else df


def sql_query(spark: SparkSession, text: str, tables: Mapping[str, DataFrame], **params: Any) -> DataFrame:
    """Rows of a SELECT. Tables are written ``{name}``, values ``:name``."""
    return spark.sql(text, args=params or None, **tables)


def scalar_query(df: DataFrame) -> Any:
    """First column of the first row, on the driver; null when there is no row."""
    row = df.limit(1).first()
    return row[0] if row else None


def high_water_mark(target: DataFrame, column: str, floor: Column) -> Column:
    """Newest value already loaded, as a lazy scalar; ``floor`` when the target is empty.

    A scalar subquery is known before the feed is scanned, so the comparison reaches the file scan as a literal.
    """
    return target.agg(F.coalesce(F.max(column), floor)).scalar()


def footer_maximum(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One row with the newest value of a parquet table's column, from the statistics in the footers; null when there is no row.

    Spark takes the value from the footers for whole numbers, dates and booleans, and scans the column of other types. The two
    settings that it needs are those of a session of its own, so the given one keeps its own.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session.read.parquet(path).agg(F.max(column).alias(column))


def stored_mark(spark: SparkSession, path: str, column: str) -> Any:
    """The newest value of a parquet table's column, on the driver. Footers without a value, as of all nulls, mean a scan."""
    try:
        return footer_maximum(spark, path, column).first()[0]
    except (PySparkException, Py4JJavaError) as failed:
        # Fixed value: what Spark says of a footer without the value.
        if "No min/max found" not in str(failed):
            raise
        return spark.read.parquet(path).agg(F.max(column)).first()[0]


def feed_scan(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv", **options: Any) -> DataFrame:
    """A feed with known headers. The schema is given, never inferred, so the files are read once. NaN is read as null."""
    if fmt == "csv":
        options = {"header": True, "mode": "FAILFAST", "enforceSchema": False, **options}
    return without_nan(spark.read.schema(schema).options(**options).format(fmt).load(path))


def latest_snapshot(
    df: DataFrame, date_column: str, as_of: dt.date, lookback: int = LOOKBACK_DAYS, feed: str = "feed"
) -> DataFrame:
    """Rows of the newest day among ``as_of`` and the ``lookback - 1`` days before it.

    Both steps compare the stored column with literals, so partitions and row groups are pruned.
    """
    days = dt.timedelta(days=1)
    c = F.col(date_column)
    low, high = as_of - (lookback - 1) * days, as_of + days
    newest = df.filter((c >= F.lit(low)) & (c < F.lit(high))).agg(F.to_date(F.max(c))).first()[0]
    if newest is None:
        raise SnapshotMissing(f"no snapshot of {feed} within {lookback} days")
    return df.filter((c >= F.lit(newest)) & (c < F.lit(newest + days)))


def latest_dated(
    spark: SparkSession, pattern: str, as_of: dt.date, lookback: int = LOOKBACK_DAYS, feed: str = "feed"
) -> str:
    """The path of the newest day that exists, among ``as_of`` and the ``lookback - 1`` days before it.

    ``pattern`` is a path with the day in it as ``strftime`` writes it, such as ``team-feed-%m-%d-%Y``. At most ``lookback``
    paths are looked for; nothing is listed or read.
    """
    sc = spark.sparkContext
    for back in range(lookback):
        path = sc._jvm.org.apache.hadoop.fs.Path((as_of - dt.timedelta(days=back)).strftime(pattern))
        if path.getFileSystem(sc._jsc.hadoopConfiguration()).exists(path):
            return path.toString()
    raise SnapshotMissing(f"no snapshot of {feed} within {lookback} days")


def lookup_pairs(df: DataFrame, old: str, new: str, order: str) -> DataFrame:
    """One row per old value. Where an old value is listed more than once the last row wins."""
    return (
        df.filter(F.col(old).isNotNull())
        .groupBy(F.col(old).alias("old_name"))
        .agg(F.max_by(new, order).alias("new_name"))
    )


def known_names(df: DataFrame, name: str, period: str, periods: Iterable[Any]) -> DataFrame:
    """Distinct names seen in the given periods."""
    return df.filter(F.col(period).isin(list(periods))).select(F.col(name).alias("name")).distinct()


def listed_names(df: DataFrame, name: str) -> DataFrame:
    """Distinct names of a list, such as the names known to be missing."""
    return df.select(F.col(name).alias("name")).distinct()


def active_team_names(df: DataFrame, active: Column, columns: Sequence[str]) -> DataFrame:
    """Every spelling of every active team: the name columns stacked into one distinct list."""
    return (
        df.filter(active).select(*columns).unpivot([], list(columns), "source", "name").select("name").distinct()
    )


def name_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """Unordered pairs, smaller name first."""
    return df.select(F.least(a, b).alias("name_lo"), F.greatest(a, b).alias("name_hi")).distinct()


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, without the line end."""
    return spark.read.text(path)


def html_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: its path and its whole UTF-8 text."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("html")
    )

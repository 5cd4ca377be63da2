"""Writers. Data is appended, or written to the next free version; only ``rewrite_parts`` overwrites, and only the parts it is told."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.errors import EmptyInput, FolderMissing, RowsMoved
from feedkit.session import written

# Field names a desktop database reserves; they are bracketed in exports.
RESERVED_FIELDS = ("date", "name")


def to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns picked by name and cast to the target types, NaN written as NULL."""
    types = dict(df.dtypes)
    picked = []
    for field in schema.fields:
        c = F.col(field.name)
        if types[field.name] in ("double", "float"):
            c = F.when(~F.isnan(c), c)
        picked.append(c.cast(field.dataType).alias(field.name))
    return df.select(*picked)


def append_rows(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Add rows to a typed table. Column order in ``df`` does not matter."""
    to_schema(df, schema).write.mode("append").parquet(path)


def rewrite_parts(
    spark: SparkSession, path: str, by: str, parts: Sequence[Any], change: Callable[[DataFrame], DataFrame]
) -> None:
    """Change some parts of a table that is partitioned by ``by``; the files of all others are neither read nor written.

    The changed rows are written aside first, because Spark cannot overwrite what it reads, and then replace their parts in one
    commit. Rows of a part that is not among ``parts`` are an error, and nothing is replaced. A part that the change leaves
    without rows stays as it was. A table has one such change at a time.
    """
    rows = spark.read.parquet(path)
    chosen = F.col(by).isin(list(parts))
    changed = written(change(rows.filter(chosen)).select(*rows.columns))
    if not changed.filter(~F.coalesce(chosen, F.lit(False))).isEmpty():
        raise RowsMoved(f"the change gives rows beyond {by} in {list(parts)}")
    changed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


_COMMITS = "_commits"


def append_batch(df: DataFrame, path: str, schema: T.StructType, batch: str) -> bool:
    """Adds a batch of rows to the table of batches at ``path``, all of it or nothing, and once only.

    The rows are written into a folder of their own, which nobody reads until a small file named after the batch says so.
    That file appears by one rename that fails if it is there already. A job that is run again, or by two drivers at a time,
    so adds its batch once; rows of an attempt that was lost stay unread. Returns whether this call added the batch.
    """
    sc = df.sparkSession.sparkContext
    fs = sc._jvm.org.apache.hadoop.fs
    if not batch or "/" in batch or batch.startswith((".", "_")):
        raise ValueError(f"a batch cannot be named {batch!r}")
    commit = fs.Path(f"{path}/{_COMMITS}/{batch}")
    store = commit.getFileSystem(sc._jsc.hadoopConfiguration())
    if store.exists(commit):
        return False
    folder = f"data-{uuid.uuid4().hex}"
    to_schema(df, schema).write.parquet(f"{path}/{folder}")
    draft = fs.Path(f"{path}/{_COMMITS}/.{batch}-{folder}")
    out = store.create(draft)
    out.write(bytearray(folder.encode()))
    out.close()
    try:
        fs.FileContext.getFileContext(store.getUri(), sc._jsc.hadoopConfiguration()).rename(
            draft, commit, sc._gateway.new_array(fs.Options.Rename, 0)
        )
    except Py4JJavaError as e:
        if not store.exists(commit):
            raise
        store.delete(draft, False)
        if "AlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False
    return True


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all committed batches. The driver holds the names of their folders; no batch is an empty table."""
    sc = spark.sparkContext
    commits = sc._jvm.org.apache.hadoop.fs.Path(f"{path}/{_COMMITS}")
    store = commits.getFileSystem(sc._jsc.hadoopConfiguration())
    listed = [x.getPath() for x in store.listStatus(commits)] if store.exists(commits) else []
    folders = []
    for name in listed:
        if not name.getName().startswith("."):
            stream = store.open(name)
            folders.append(f"{path}/{bytes(stream.readAllBytes()).decode()}")
            stream.close()
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def write_observed(df: DataFrame, path: str, schema: T.StructType, accepted: Column) -> tuple[int, int]:
    """Writes the accepted rows and returns how many were accepted and how many failed, counted while they are written.

    A null condition is a failure. No second pass over the rows is made.
    """
    seen = Observation()
    ok = F.coalesce(accepted, F.lit(False))
    counted = df.observe(seen, F.count_if(ok).alias("successes"), F.count_if(~ok).alias("failures"))
    to_schema(counted.filter(ok), schema).write.parquet(path)
    return seen.get["successes"], seen.get["failures"]


def quote_reserved(df: DataFrame) -> DataFrame:
    """Reserved field names, in any case, put in brackets."""
    return df.withColumnsRenamed({c: f"[{c}]" for c in df.columns if c.lower() in RESERVED_FIELDS})


def _next_free(path: str, write) -> str:
    """Run ``write`` on the path, then on `` V1``, `` V2``, … until one is free; returns the path used."""
    version = 0
    while True:
        target = path if version == 0 else f"{path} V{version}"
        try:
            write(target)
            return target
        except AnalysisException as e:
            if e.getCondition() != "PATH_ALREADY_EXISTS":
                raise
        version += 1


def _require_parent(df: DataFrame, path: str, force_dir: bool) -> None:
    """Without ``force_dir`` the folder that will hold ``path`` has to exist already."""
    if not force_dir:
        sc = df.sparkSession.sparkContext
        parent = sc._jvm.org.apache.hadoop.fs.Path(path.rpartition("/")[0])
        if not parent.getFileSystem(sc._jsc.hadoopConfiguration()).exists(parent):
            raise FolderMissing(f"no folder {parent} to write into")


def write_version(
    df: DataFrame, path: str, columns: Sequence[str] | None = None, force_dir: bool = False
) -> str:
    """Parquet under the next free version of ``path``; returns where it was written."""
    _require_parent(df, path, force_dir)
    out = df.select(*columns) if columns else df
    return _next_free(path, lambda p: out.write.mode("errorifexists").parquet(p))


def write_version_csv(
    df: DataFrame, path: str, sep: str = ",", line_sep: str = "\n", header: bool = True, force_dir: bool = False
) -> str:
    """CSV under the next free version of ``path``."""
    _require_parent(df, path, force_dir)
    return _next_free(
        path, lambda p: df.write.mode("errorifexists").csv(p, sep=sep, lineSep=line_sep, header=header)
    )


def write_named(
    frames: Sequence[DataFrame],
    path: str,
    names: Sequence[str] | None = None,
    columns: Sequence[Sequence[str] | None] | None = None,
    force_dir: bool = False,
) -> Mapping[str, str]:
    """Several tables in one place, each in a folder of its own name (default ``Main_0``, ``Main_1``, …)."""
    if frames:
        _require_parent(frames[0], path, force_dir)
    names = names or [f"Main_{i}" for i in range(len(frames))]
    columns = columns or [None] * len(frames)
    return {
        name: write_version(df, f"{path}/{name}", cols, force_dir=True)
        for name, df, cols in zip(names, frames, columns, strict=True)
    }


def write_values(df: DataFrame, column: str, path: str) -> str:
    """One value per line; an empty input is an error."""
    out = df.select(F.col(column).cast("string").alias("value"))
    if out.isEmpty():
        raise EmptyInput("there is no value to write")
    return _next_free(path, lambda p: out.write.mode("errorifexists").text(p))

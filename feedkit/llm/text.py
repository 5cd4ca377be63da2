"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedkit.operators.columns import unused

# A word is a run of characters other than the space and the ASCII controls from tab to carriage return. On UTF-8
# bytes, ``bytes.split()`` without arguments splits at exactly these six bytes.
WORD = r"[^\x20\x09-\x0D]+"
# Documents are handed on in pieces of about this many UTF-8 bytes, whatever the size of the Arrow batches.
PIECE_BYTES = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(text: str) -> Column:
    """The text as UTF-8 bytes, null as no bytes."""
    return F.coalesce(F.col(text).cast("binary"), F.lit(b""))


def count_words(text: str) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def filtered(docs: DataFrame, added: Sequence[str], text: str, mark: Callable[[DataFrame, str], DataFrame], where: str) -> DataFrame:
    """The documents that ``where`` keeps after ``mark`` added its columns, with their own columns, whatever their names.

    ``mark`` gets the documents and the name of their text; columns that are named like added ones have other names there.
    """
    own = dict(zip(docs.columns, unused(added, *docs.columns), strict=True))
    marked = mark(docs.toDF(*own.values()), own[text]).filter(where)
    return marked.select(*[F.col(n).alias(c) for c, n in own.items()])


def pieces(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in slices of bounded bytes of a string or binary column; a longer row stands alone."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(lengths):
            if held and held + n > PIECE_BYTES:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)

"""Importance resampling towards the distribution of a target corpus.

Words are found by the pre-tokeniser of the tokenizers library: an untrained Split at a regular expression over the text
lower-cased in ASCII. It returns words with offsets, and windows over neighbouring offset pairs give runs of one and two
words, which are hashed into a fixed number of buckets by CRC-32. Two histograms, of the documents and of the target, give
each bucket a gain, the logarithm of how much likelier it is in the target. A document's weight is the mean gain of its
features; adding Gumbel noise to the weights and taking the highest scores draws without replacement in proportion to the
exponential of the weights. The noise is a hash of the id, so reruns agree.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from feedkit.llm.text import pieces, utf8
from feedkit.operators.columns import unused
from feedkit.operators.ordering import in_order
from feedkit.operators.skew import join_on
from feedkit.session import written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
SCALE = 1000
SEED = 7
MIN_WORDS = 20
PERCENT = 25
# A longer text is split in stretches of about this many bytes, cut where no word is.
STRETCH = 1 << 20
_SEPARATORS = bytes(b for b in range(128) if not (48 <= b <= 57 or 97 <= b <= 122))


class Words:
    """The pre-tokeniser; one per task, as it cannot be sent there."""

    def __init__(self):
        self.split = Split(Regex(WORD), "removed", invert=True)

    def offsets(self, data: bytes) -> list[tuple[int, int]]:
        """First byte and end of every word of lower-cased UTF-8. One character per byte makes offsets those of bytes."""
        return [at for _, at in self.split.pre_tokenize_str(data.decode("latin-1"))]

    def buckets(self, text: bytes) -> Iterator[tuple[int, np.ndarray]]:
        """Number of words and buckets of the features of each stretch of a text."""
        before = None
        for data in _stretches(text.lower()):
            at = self.offsets(data)
            one = [crc32(data[a:b]) for a, b in at]
            # A run of two words is the first word, a space and the second one, whatever stood between them.
            led = [*([] if before is None else [before]), *one][:-1]
            two = [crc32(data[a:b], crc32(b" ", c)) for (a, b), c in zip(at[len(at) - len(led) :], led, strict=True)]
            before = one[-1] if one else before
            yield len(one), np.array(one + two, np.uint32) % BUCKETS


def _stretches(data: bytes) -> Iterator[bytes]:
    """A text in stretches that end beside a separator, so that no word is cut."""
    start = 0
    while len(data) - start > STRETCH:
        end = start + STRETCH
        while end < len(data) and data[end] not in _SEPARATORS:
            end += 1
        yield data[start:end]
        start = end
    yield data[start:]


FEATURES = "id long, n_words long, buckets binary"


def features(docs: DataFrame, id_: str | None = "doc_id", text: str = "text") -> DataFrame:
    """Rows of FEATURES: the buckets of a text's features, two bytes each. A null text has none.

    Finding words costs far more than hashing and adding, so it is done once: the rows are meant to be written.
    """
    key = F.col(id_).cast("long") if id_ else F.lit(None).cast("long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in pieces(batches, "data"):
            counts, packed = [], []
            for data in batch.column("data").to_pylist():
                found = list(words.buckets(data))
                counts.append(sum(n for n, _ in found))
                packed.append(b"".join(b.astype("<u2").tobytes() for _, b in found))
            columns = [batch.column("id"), pa.array(counts, pa.int64()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in FEATURES.split(", ")])

    return docs.select(key.alias("id"), utf8(text).alias("data")).mapInArrow(run, FEATURES)


def histogram(found: DataFrame) -> DataFrame:
    """Rows (bucket, n) of rows of FEATURES: how many features fall into each bucket that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(BUCKETS, np.int64)
        for batch in pieces(batches, "buckets"):
            for data in batch.column("buckets").to_pylist():
                held += np.bincount(np.frombuffer(data, "<u2"), minlength=BUCKETS)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(held[some])], ["bucket", "n"])

    return found.select("buckets").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(found: DataFrame, target: DataFrame) -> np.ndarray:
    """The gain of every bucket, in thousandths, rounded down, from features of documents and target.

    The driver holds two numbers for each of BUCKETS buckets.
    """

    def counts(rows: DataFrame) -> list[int]:
        held = [0] * BUCKETS
        for r in histogram(rows).collect():
            held[r["bucket"]] = r["n"]
        return held

    s, t = counts(found), counts(target)
    of_s, of_t = sum(s) + BUCKETS, sum(t) + BUCKETS
    return np.array(
        [math.floor(SCALE * math.log(((b + 1) * of_s) / ((a + 1) * of_t))) for a, b in zip(s, t, strict=True)], np.int64
    )


def noise(doc_id: int | None) -> int:
    """Gumbel noise of an id in thousandths, rounded down; a null id has that of the empty string."""
    name = f"{SEED}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


MEASURES = "id long, n_words long, n_features long, weight long, score long"


def score(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """Rows of MEASURES of rows of FEATURES.

    A text without features has weight 0. Rows that repeat an id have the same noise.
    """
    shared = found.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in pieces(batches, "buckets"):
            sizes, weights, scores = [], [], []
            for doc_id, data in zip(batch.column("id").to_pylist(), batch.column("buckets").to_pylist(), strict=True):
                buckets = np.frombuffer(data, "<u2")
                weight = int(gain[buckets].sum()) // len(buckets) if len(buckets) else 0
                sizes.append(len(buckets))
                weights.append(weight)
                scores.append(weight + noise(doc_id))
            columns = [batch.column("id"), batch.column("n_words"), *(pa.array(c, pa.int64()) for c in (sizes, weights, scores))]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in MEASURES.split(", ")])

    return found.mapInArrow(run, MEASURES)


def draw(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, id_: str = "doc_id") -> DataFrame:
    """Adds ``rank`` to scored documents: 1, 2, 3... for those drawn, null for the others.

    Of the documents of at least ``min_words`` words, the given share (rounded down) with the highest scores is drawn, of
    equal scores those of smaller ids, null ids last; rows that agree in both are taken one by one. Rows are sorted by
    ranges and written, so no task sees all of them; the rows should be narrow.
    """
    able = F.col("n_words") >= min_words
    by = [able.cast("int").desc(), F.col("score").desc(), F.col(id_).asc_nulls_last()]
    placed, counts = in_order(scored, by, "rank", able)
    # One number.
    able_rows = counts.agg(F.coalesce(F.sum("marked"), F.lit(0))).first()[0]
    taken = able & (F.col("rank") <= able_rows * percent // 100)
    return placed.withColumn("rank", F.when(taken, F.col("rank")))


def importance(
    docs: DataFrame, target: DataFrame, id_: str = "doc_id", text: str = "text", target_text: str = "text"
) -> DataFrame:
    """Rows (id, n_words, n_features, weight, score, rank) of all documents; see ``score`` and ``draw``."""
    found = written(features(docs, id_, text))
    gain = gains(found, written(features(target, None, target_text)))
    return draw(written(score(found, gain).withColumnRenamed("id", id_)), id_=id_)


def resample(docs: DataFrame, target: DataFrame, id_: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """The documents that are drawn, with their own columns.

    Rows that share an id are drawn together, if one of them is; rows without an id are left out.
    """
    of, rank = unused(docs.columns, "of", "rank")
    drawn = importance(docs, target, id_, text, target_text).withColumnRenamed("rank", rank).filter(F.col(rank).isNotNull())
    ids = drawn.select(F.col(id_).cast(docs.schema[id_].dataType).alias(of)).filter(F.col(of).isNotNull()).distinct()
    return join_on(docs, ids, {id_: of}, "left_semi")

"""Quality classifier: hashed word and character n-gram vectors, averaged per document, with a softmax on top.

It is trained by stochastic gradient descent in numpy on a bounded sample of labelled documents, and scores whole texts in
Spark tasks. As the output is linear in the vectors, a trained model is one number per bucket, and the score of a word is
worked out once per task process.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.llm.text import pieces, utf8
from feedkit.operators.columns import unused

# Labelled documents the model is trained on, at most: those of the smallest hashes of their ids.
TRAIN_ROWS = 5_000
BUCKETS = 1 << 17
DIMENSIONS = 12
EPOCHS = 6
RATE = 0.3
NGRAMS = (3, 4)
CACHE_WORDS = 300_000
# Marks that stand beside the words: a word that repeats the one before it, a line that repeats an earlier one.
SAME_WORD, SAME_LINE = b"\0word", b"\0line"


def features(word: bytes) -> list[int]:
    """Buckets of a word and of its character n-grams, with its ends marked."""
    if word[0] == 0:
        return [zlib.crc32(word) % BUCKETS]
    marked = f"<{word.decode('utf-8', 'replace')}>"
    grams = [marked[i : i + n] for n in NGRAMS for i in range(len(marked) - n + 1)]
    return [zlib.crc32(g.encode()) % BUCKETS for g in [" " + marked, *grams]]


def tokens(data: bytes) -> list[bytes]:
    """Words of a text and the marks of its repeats."""
    words = data.split()
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    same = sum(map(bytes.__eq__, words, words[1:]))
    return words + [SAME_WORD] * same + [SAME_LINE] * (len(lines) - len(set(lines)))


@dataclass(frozen=True)
class Model:
    """``weights[b]`` is what bucket b adds to the log odds of label 1, before the average is taken."""

    weights: np.ndarray
    bias: float


def train(rows: list[tuple[bytes, int]], seed: int = 7) -> Model:
    """Vectors of buckets and the softmax over two labels, one document per step, with a falling rate."""
    random = np.random.default_rng(seed)
    vectors = ((random.random((BUCKETS, DIMENSIONS)) - 0.5) / DIMENSIONS).astype(np.float32)
    output, bias = np.zeros((2, DIMENSIONS), np.float32), np.zeros(2, np.float32)
    known: dict[bytes, list[int]] = {}
    docs = []
    for data, label in rows:
        counts: Counter[int] = Counter()
        for word, n in Counter(tokens(data)).items():
            if word not in known:
                known[word] = features(word)
            for b in known[word]:
                counts[b] += n
        if counts:
            at = np.fromiter(counts.keys(), np.int64, len(counts))
            share = np.fromiter(counts.values(), np.float32, len(counts))
            docs.append((at, share / share.sum(), int(label)))
    steps = EPOCHS * len(docs)
    for step in range(steps):
        if step % len(docs) == 0:
            order = random.permutation(len(docs))
        at, share, label = docs[order[step % len(docs)]]
        rate = RATE * (1 - step / steps)
        mine = vectors[at]
        mean = share @ mine
        z = output @ mean + bias
        p = np.exp(z - z.max())
        p /= p.sum()
        p[label] -= 1
        back = p @ output
        output -= rate * np.outer(p, mean)
        bias -= rate * 0.1 * p
        # The average is spread over many buckets; each takes its share of the step, as a sum would.
        vectors[at] = mine - rate * np.outer(share * len(at) ** 0.5, back)
    return Model((vectors @ (output[1] - output[0])).astype(np.float64), float(bias[1] - bias[0]))


def held_out(id_: str):
    """Rows that are never learned from: crc32 of the id as text leaves remainder 0 by 5. A null id is an empty text."""
    return F.crc32(F.coalesce(F.col(id_).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_: str = "doc_id", text: str = "text", rows: int = TRAIN_ROWS) -> Model:
    """Trains on at most ``rows`` labelled documents that are not held out.

    Of several labels of a document the largest counts; null labels and ids are left out. Without any labelled document
    every score is one half.
    """
    named = labels.select(F.col(id_).alias("_id"), F.col(label).cast("int").alias("_y")).filter("_id IS NOT NULL AND _y IS NOT NULL")
    one = named.filter(~held_out("_id")).groupBy("_id").agg(F.max("_y").alias("_y"))
    some = one.orderBy(F.xxhash64("_id"), "_id").limit(rows)
    found = docs.select(F.col(id_).alias("_d"), utf8(text).alias("_t")).join(some, F.col("_d") == F.col("_id"))
    # Bounded by ``rows``; repeated rows of an id count once.
    taken = found.groupBy("_id").agg(F.min("_t").alias("_t"), F.first("_y").alias("_y")).orderBy("_id").collect()
    return train([(bytes(r["_t"]), r["_y"]) for r in taken])


class _Words(dict):
    """Sum of the weights of a word's features and their number, as one complex number."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights.tolist()

    def __missing__(self, word: bytes) -> complex:
        at = features(word)
        value = self[word] = complex(math.fsum([self.weights[b] for b in at]), len(at))
        return value


def score(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """Adds the probability of label 1. A null or empty text has that of the bias alone.

    Repeated rows and rows without an id are scored each by itself. A column ``into`` is replaced, columns of all other
    names are kept.
    """
    kept = [c for c in docs.columns if c.lower() != into.lower()]
    (data,) = unused(kept, "data")
    rows = docs.select(*kept, utf8(text).alias(data))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words(shared.value.weights)
        for batch in pieces(batches, data):
            out = []
            for value in batch.column(data).to_pylist():
                total = sum(map(words.__getitem__, tokens(value)), 0j)
                z = (total.real / total.imag if total.imag else 0.0) + shared.value.bias
                out.append(1 / (1 + math.exp(-max(-700.0, min(700.0, z)))))
                if len(words) > CACHE_WORDS:
                    words.clear()
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(out, pa.float64())], [*kept, into])

    fields = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in rows.select(*kept).schema]
    return rows.mapInArrow(run, ", ".join([*fields, f"`{into}` double"]))

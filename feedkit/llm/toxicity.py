"""Toxic passages as segments of maximal score.

Every token has a score: the log odds that a toxic rather than a clean document holds it, with a Dirichlet prior whose
mean are the shares of the two classes, if chance cannot explain them. Beginnings of words have scores too, and a word has
the best one of its own and theirs. Words without such evidence cost a little. A scan in linear time (Ruzzo and Tompa) finds all disjoint segments of a text that
cannot be improved: its toxic passages. How often passages of a score come up in clean text is learned from labelled
documents that had no part in the token scores: passages over a threshold arrive at a rate per token and their scores fall
off exponentially, the tail of an extreme-value distribution. A document's evidence is the sum, over its passages, of how
much rarer each one is than what clean text of that length brings, and a logistic curve over its logarithm gives the probability.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.llm.classifier import held_out
from feedkit.llm.text import pieces, utf8
from feedkit.operators.columns import unused
from feedkit.session import written

# Labelled documents that are learned from, at most: those of the smallest hashes of their ids.
TRAIN_ROWS = 20_000
# Mass of the Dirichlet prior of a token, in documents, spread over the two classes as the labelled ones are.
PRIOR_DOCUMENTS = 2.0
# A token has a score if its log odds exceed so many of their standard deviations; one of them is taken off the score.
DEVIATIONS = 3.5
# It is in so many times the share of toxic documents as of clean ones, whatever the evidence: toxic documents that are longer on
# average hold every common word more often, and segments of such words would run through whole clean texts.
LEAST_RATIO = 3.0
# What a token without a score costs.
COST = 0.05
# Parts of the labelled documents: each is calibrated with the scores that the others give.
FOLDS = 5
# A token is looked at if so many toxic documents hold it.
MIN_DOCUMENTS = 3
# Beginnings of a word, in characters, that speak for it as well as the word itself.
PREFIXES = (4, 5, 6, 7)
# A beginning speaks for words of its own if so many times more toxic documents hold it than hold any one word of it.
SHARED = 1.5
# Words whose scores a task keeps.
CACHE_WORDS = 300_000
# Tokens with a score, at most: those of the highest ones.
LEXICON = 100_000
# Tokens per shingle that tells near copies among the labelled documents, which count as one.
SHINGLE = 5
# Passages and tokens of imagined clean text behind the calibration, so that no rate is zero.
PSEUDO_PASSAGES = 0.5
# Newton steps of the logistic curve, and its ridge.
STEPS, RIDGE = 50, 1e-3

# Letters A-Z become a-z; every byte that is no ASCII letter, digit or part of a longer character becomes a space.
_FOLD = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
# A longer text is split in stretches of about this many bytes.
STRETCH = 1 << 20


def stretches(data: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """The tokens of a text in lists of bounded length, with the number of tokens before each."""
    data = data.translate(_FOLD)
    start = before = 0
    while start < len(data):
        end = len(data) if len(data) - start <= STRETCH else data.find(b" ", start + STRETCH)
        end = len(data) if end < 0 else end
        found = data[start:end].split()
        yield before, found
        before, start = before + len(found), end


def tokens(data: bytes) -> Iterator[bytes]:
    for _, found in stretches(data):
        yield from found


def forms(token: bytes) -> list[bytes]:
    """The token and its beginnings, which are marked by a character that no token has."""
    text = token.decode("utf-8", "replace")
    return [token, *[text[:n].encode() + b"*" for n in PREFIXES if len(text) >= n]]


def segments(scores: Iterable[tuple[int, float]], cost: float = COST) -> list[tuple[int, int, float]]:
    """All maximal segments (first, end, score) of a sequence whose tokens score -``cost`` but for those given.

    ``scores`` are (place, positive score) in the order of their places. Each candidate keeps the sums before it and up to
    its end; one that begins higher than an earlier one began and ends higher than that ended takes it in. Candidates that
    a new lowest sum cuts off are final and left out of the search, so that every candidate is looked at a bounded number
    of times and the scan is linear in the number of scored tokens.
    """
    done: list[tuple[int, int, float]] = []
    # (first, end, sum before, sum up to the end); the sums before rise or the list is flushed.
    held: list[tuple[int, int, float, float]] = []
    # For each candidate the nearest earlier one that begins lower, or -1.
    lower: list[int] = []
    total, place = 0.0, 0
    for at, s in scores:
        left = total - cost * (at - place)
        total, place = left + s, at + 1
        first, right = at, total
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= left:
                j = lower[j]
            if j < 0:
                # Nothing held begins lower: what is held is final.
                done.extend((a, b, r - le) for a, b, le, r in held)
                held, lower = [(first, at + 1, left, right)], [-1]
                break
            if held[j][3] >= right:
                held.append((first, at + 1, left, right))
                lower.append(j)
                break
            first, left = held[j][0], held[j][2]
            del held[j:], lower[j:]
    done.extend((a, b, r - le) for a, b, le, r in held)
    return done


class Scores(dict):
    """Score of a word, 0 if nothing speaks for it; worked out once per word and task."""

    def __init__(self, lexicon: Mapping[bytes, float]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, token: bytes) -> float:
        if len(self) >= CACHE_WORDS:
            self.clear()
        get = self.lexicon.get
        value = self[token] = max([get(f, 0.0) for f in forms(token)])
        return value


def passages(data: bytes, scores: Scores) -> tuple[int, list[tuple[int, int, float]]]:
    """Number of tokens of a text and its segments."""
    scored: list[tuple[int, float]] = []
    n = 0
    for before, found in stretches(data):
        n = before + len(found)
        scored.extend((before + i, s) for i, s in enumerate(map(scores.__getitem__, found)) if s)
    return n, segments(scored)


def token_scores(counts: Mapping[bytes, tuple[int, int]], toxic: int, clean: int) -> dict[bytes, float]:
    """Scores of the tokens that are more at home in toxic documents than chance explains.

    ``counts`` are numbers of toxic and clean documents with a token. Without documents of both kinds there are none.
    """
    if not toxic or not clean:
        return {}
    found = {}
    prior = PRIOR_DOCUMENTS * toxic / (toxic + clean), PRIOR_DOCUMENTS * clean / (toxic + clean)
    most: dict[bytes, int] = {}
    for token, (t, _) in counts.items():
        if not token.endswith(b"*"):
            for form in forms(token)[1:]:
                most[form] = max(most.get(form, 0), t)
    for token, (t, c) in counts.items():
        if t < max(MIN_DOCUMENTS, SHARED * most.get(token, 0)):
            continue
        a, b = t + prior[0], c + prior[1]
        odds = math.log(a / (toxic + PRIOR_DOCUMENTS - a)) - math.log(b / (clean + PRIOR_DOCUMENTS - b))
        deviation = math.sqrt(1 / a + 1 / b)
        if odds > DEVIATIONS * deviation and a / toxic >= LEAST_RATIO * b / clean:
            found[token] = odds - deviation
    return dict(sorted(found.items(), key=lambda x: (-x[1], x[0]))[:LEXICON])


@dataclass(frozen=True)
class Tail:
    """Passages of clean text: ``rate`` per token score more than ``over``, and scores beyond fall off with ``decay``."""

    rate: float
    over: float
    decay: float

    def evidence(self, n: int, found: list[tuple[int, int, float]]) -> float:
        """Sum over passages of minus the log of how many such passages clean text of n tokens brings, where below one."""
        if not found:
            return 0.0
        expected = math.log(self.rate * max(n, 1))
        return math.fsum(max(0.0, self.decay * (s - self.over) - expected) for _, _, s in found)


@dataclass(frozen=True)
class Model:
    lexicon: dict[bytes, float]
    tail: Tail
    slope: float
    bias: float

    def probability(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, self.slope * math.log1p(evidence) + self.bias))))


def fit_tail(clean: list[tuple[int, list[tuple[int, int, float]]]]) -> Tail:
    """Rate and decay of the passages of clean texts, given as (number of tokens, passages).

    The threshold is the lower quartile of the scores; the mean excess over it is the inverse of the decay. One passage of
    mean excess 1 and PSEUDO_PASSAGES of the rate are added, so that text without passages has a tail as well.
    """
    scores = sorted(s for _, found in clean for _, _, s in found)
    over = scores[len(scores) // 4] if scores else 0.0
    beyond = [s - over for s in scores if s >= over]
    decay = (len(beyond) + 1) / (math.fsum(beyond) + 1)
    return Tail((len(beyond) + PSEUDO_PASSAGES) / (sum(n for n, _ in clean) + 1), over, decay)


def fit_curve(rows: list[tuple[float, int]]) -> tuple[float, float]:
    """Slope and bias of the logistic curve of label over log(1 + evidence), by Newton steps; the slope is positive."""
    slope, bias = 0.5, -2.0
    rows = [(math.log1p(x), y) for x, y in rows]
    for _ in range(STEPS):
        g0 = g1 = 0.0
        h00 = h11 = RIDGE
        h01 = 0.0
        for x, y in rows:
            p = 1 / (1 + math.exp(-max(-50.0, min(50.0, slope * x + bias))))
            w = p * (1 - p)
            g0, g1 = g0 + p - y, g1 + (p - y) * x
            h00, h01, h11 = h00 + w, h01 + w * x, h11 + w * x * x
        det = h00 * h11 - h01 * h01
        if det < 1e-12:
            break
        step0, step1 = (h11 * g0 - h01 * g1) / det, (h00 * g1 - h01 * g0) / det
        limit = max(1.0, abs(step0), abs(step1))
        bias, slope = bias - step0 / limit, slope - step1 / limit
        if max(abs(step0), abs(step1)) < 1e-9:
            break
    return max(slope, 1e-3), bias


def _near_key(data: bytes) -> int:
    """Smallest hash of a text's shingles: equal for copies, and for most near copies."""
    window, low = [], 1 << 64
    for token in tokens(data):
        window = [*window[1 - SHINGLE :], token] if SHINGLE > 1 else [token]
        if len(window) == SHINGLE:
            low = min(low, zlib.crc32(b" ".join(window)) << 32 | zlib.adler32(token))
    if low == 1 << 64:
        low = int.from_bytes(hashlib.sha256(b" ".join(window)).digest()[:8], "big")
    return low - (1 << 63)


def labelled(docs: DataFrame, labels: DataFrame, label: str, id_: str, text: str, rows: int) -> DataFrame:
    """Rows (fold, data, y) of at most ``rows`` labelled documents that are not held out; near copies of a label are one.

    Of several labels of a document the largest counts; null labels and ids are left out. The fold is a hash of what near
    copies share.
    """
    named = labels.select(F.col(id_).cast("long").alias("of"), F.col(label).cast("int").alias("y"))
    named = named.filter("of IS NOT NULL AND y IS NOT NULL").filter(~held_out("of")).groupBy("of").agg(F.max("y").alias("y"))
    # Bounded by ``rows``, so it may be broadcast.
    some = F.broadcast(named.orderBy(F.xxhash64("of"), "of").limit(rows))
    found = docs.select(F.col(id_).cast("long").alias("id"), utf8(text).alias("data")).join(some, F.col("id") == F.col("of"))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "data"):
            near = pa.array([_near_key(x) for x in batch.column("data").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([near, batch.column("id"), batch.column("data"), batch.column("y")], ["near", "id", "data", "y"])

    keyed = found.select("id", "data", "y").mapInArrow(keys, "near long, id long, data binary, y int")
    # Of rows that repeat an id, the smaller text.
    one = keyed.groupBy("near", "y").agg(F.min(F.struct("id", "data")).alias("d"))
    return one.select((F.pmod(F.xxhash64("near"), F.lit(FOLDS))).cast("int").alias("fold"), F.col("d.data").alias("data"), "y")


def _document_counts(rows: DataFrame) -> DataFrame:
    """Rows (fold, token, toxic, clean) of documents with a token, and a row without a token of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[tuple] = Counter()
        for batch in pieces(batches, "data"):
            columns = [batch.column(c).to_pylist() for c in ("fold", "data", "y")]
            for fold, data, y in zip(*columns, strict=True):
                held.update((fold, f, y == 1) for f in {f for t in set(tokens(data)) for f in forms(t)})
                held[fold, None, y == 1] += 1
        names = {(f, t) for f, t, _ in held}
        out = [(f, t, held[f, t, True], held[f, t, False]) for f, t in names]
        types = [pa.int32(), pa.binary(), pa.int64(), pa.int64()]
        columns = [pa.array([r[i] for r in out], k) for i, k in enumerate(types)]
        yield pa.RecordBatch.from_arrays(columns, ["fold", "token", "toxic", "clean"])

    parts = rows.mapInArrow(run, "fold int, token binary, toxic long, clean long")
    return parts.groupBy("fold", "token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", id_: str = "doc_id", text: str = "text", rows: int = TRAIN_ROWS
) -> Model:
    """Learns token scores, the tail of clean text and the curve from labelled documents.

    Passages of each fold are found with the scores that the other folds give, so that the tail and the curve see what new text
    brings. Without labelled documents of both kinds no token has a score, and every document has the probability of the
    bias alone. The driver holds the tokens of at least MIN_DOCUMENTS toxic documents, and the passages of the labelled ones.
    """
    taken = written(labelled(docs, labels, label, id_, text, rows))
    counted = written(_document_counts(taken))
    held = counted.filter("token IS NULL").collect()
    documents = {(r["fold"], k): r[k] for r in held for k in ("toxic", "clean")}
    by_fold = F.collect_list(F.struct("fold", "toxic", "clean"))
    grouped = counted.filter("token IS NOT NULL").groupBy("token").agg(F.sum("toxic").alias("n"), by_fold.alias("folds"))
    counts = {
        bytes(r["token"]): {f["fold"]: (f["toxic"], f["clean"]) for f in r["folds"]}
        for r in grouped.filter(F.col("n") >= MIN_DOCUMENTS).toLocalIterator()
    }

    def lexicon(without: int | None) -> dict[bytes, float]:
        folds = [f for f in range(FOLDS) if f != without]
        sums = {t: tuple(sum(c.get(f, (0, 0))[i] for f in folds) for i in (0, 1)) for t, c in counts.items()}
        return token_scores(sums, *[sum(documents.get((f, k), 0) for f in folds) for k in ("toxic", "clean")])

    others = taken.sparkSession.sparkContext.broadcast([lexicon(f) for f in range(FOLDS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = [Scores(x) for x in others.value]
        for batch in pieces(batches, "data"):
            columns = [batch.column(c).to_pylist() for c in ("fold", "data", "y")]
            out = []
            for fold, data, y in zip(*columns, strict=True):
                n, found = passages(data, scores[fold])
                out.append((y == 1, n, [s for _, _, s in found]))
            types = [pa.bool_(), pa.int64(), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], k) for i, k in enumerate(types)], ["y", "n", "scores"]
            )

    seen = taken.mapInArrow(run, "y boolean, n long, scores array<double>").orderBy("y", "n", "scores").collect()
    read = [(r["y"], r["n"], [(0, 0, s) for s in r["scores"]]) for r in seen]
    tail = fit_tail([(n, found) for y, n, found in read if not y])
    slope, bias = fit_curve([(tail.evidence(n, found), int(y)) for y, n, found in read])
    return Model(lexicon(None), tail, slope, bias)


PASSAGE = "array<struct<first:long,end:long,score:double,expected:double>>"
_PASSAGE = pa.list_(
    pa.struct([("first", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())])
)


def find_passages(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds ``passages`` (first token, end, score, expected number in clean text of that length) and ``score``.

    Passages are those that clean text of the length brings less than once on average, in the order of the text. ``score``
    is the probability of the label; a null or empty text has that of no evidence. Columns of these names are replaced.
    Repeated rows are scored alike.
    """
    added = ["passages", "score"]
    kept = [c for c in docs.columns if c not in added]
    (data_,) = unused(docs.columns, "data")
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], utf8(text).alias(data_))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        known = Scores(model.lexicon)
        for batch in pieces(batches, data_):
            found, scores = [], []
            for data in batch.column(data_).to_pylist():
                n, some = passages(data, known)
                rare = []
                for a, b, s in sorted(some):
                    expected = model.tail.rate * n * math.exp(-model.tail.decay * (s - model.tail.over))
                    if expected < 1:
                        rare.append({"first": a, "end": b, "score": s, "expected": expected})
                found.append(rare)
                scores.append(model.probability(model.tail.evidence(n, some)))
            columns = [*(batch.column(c) for c in kept), pa.array(found, _PASSAGE), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *added])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*[F.col(f"`{c}`") for c in kept]).schema]
    return rows.mapInArrow(run, ", ".join([*fields, f"passages {PASSAGE}, score double"]))

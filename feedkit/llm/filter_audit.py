"""Filter interaction audit by count-weighted decision diagrams.

A document fails some of a list of filters; the set it fails is a mask of bits. Masks are counted per part, which leaves at
most 2^filters rows of a part, however many documents it has. From these a part's diagram is built: one level per filter,
a node per distinct distribution of what is left to decide, edges for pass and fail that carry the weight of what goes
through them. Two neighbouring levels can be exchanged by rebuilding the nodes of these two alone. Walking through all
orders of the filters by such exchanges (plain changes, each order once), the path that passes every level says what each
filter would remove at its place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.llm.text import pieces, utf8
from feedkit.operators.skew import join_on
from feedkit.session import written

FILTERS = "ABCDE"
MIN_WORDS = 100
MIN_DISTINCT_PERCENT = 80
MAX_UPPER_PERCENT = 10
SYMBOLS = b"#$%&*|"
_NOT_UPPER = bytes(set(range(256)) - set(range(65, 91)))
_CONTINUES = bytes(range(0x80, 0xC0))

# What a weight is made of: documents, those of label quality 1, those of label toxic 1.
Weight = tuple[int, int, int]
NOTHING: Weight = (0, 0, 0)


def text_mask(data: bytes) -> int:
    """Bits of the filters A to D that a text fails. A text without words fails A alone."""
    words = data.split()
    code_points = len(data.translate(None, _CONTINUES))
    upper = len(data.translate(None, _NOT_UPPER))
    return (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words)) << 1
        | (100 * upper > MAX_UPPER_PERCENT * code_points) << 2
        | (len(data.translate(None, SYMBOLS)) < len(data)) << 3
    )


def fingerprints(docs: DataFrame, part: str, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, part, mask, digest): the failures of filters A to D, and sha256 of the text, by which equal texts meet."""
    rows = docs.select(
        F.col(id_).cast("long").alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        utf8(text).alias("data"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "data"):
            texts = batch.column("data").to_pylist()
            masks = pa.array([text_mask(t) for t in texts], pa.int32())
            digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            columns = [batch.column("id"), batch.column("part"), masks, digests]
            yield pa.RecordBatch.from_arrays(columns, ["id", "part", "mask", "digest"])

    return rows.mapInArrow(run, "id long, part string, mask int, digest binary")


def mask_counts(
    docs: DataFrame, labels: DataFrame, part: str, id_: str = "doc_id", text: str = "text", label_id: str = "doc_id"
) -> DataFrame:
    """Rows (part, mask, n, good, toxic): documents by the set of filters they fail, with E as bit 4.

    A row fails E if a smaller id has an equal text anywhere in the table; rows of the smallest id do not, however many
    they are, and a row without an id neither fails E nor makes others fail it. A null text is an empty one, a null part
    the part of the empty string. A document is good or toxic if any of its rows of labels says 1; rows without an id are
    neither.
    """
    rows = written(fingerprints(docs, part, id_, text))
    # A digest of one id makes nothing fail; those of several are few beside the documents.
    groups = rows.groupBy(F.col("digest").alias("of")).agg(F.min("id").alias("first"), F.max("id").alias("last"))
    marked = join_on(rows, groups.filter("first < last").drop("last"), {"digest": "of"})
    fails = F.coalesce(F.col("id") > F.col("first"), F.lit(False)).cast("int")
    marked = marked.select("id", "part", (F.col("mask") + 16 * fails).alias("mask"))
    named = labels.select(
        F.col(label_id).cast("long").alias("of"),
        (F.col("quality") == 1).cast("int").alias("good"),
        (F.col("toxic") == 1).cast("int").alias("toxic"),
    )
    named = named.filter("of IS NOT NULL AND (good = 1 OR toxic = 1)").groupBy("of")
    named = named.agg(F.coalesce(F.max("good"), F.lit(0)).alias("good"), F.coalesce(F.max("toxic"), F.lit(0)).alias("toxic"))
    told = join_on(marked, named, {"id": "of"})
    total = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("good", "toxic")]
    return told.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), *total)


def _sum(a: Weight, b: Weight) -> Weight:
    return a[0] + b[0], a[1] + b[1], a[2] + b[2]


@dataclass
class Diagram:
    """A decision diagram over the variables ``order`` (top to bottom) whose paths carry weights.

    A node is a number; ``children[level]`` maps it to the nodes it leads to on pass and on fail, and ``weight`` says what
    goes through it. Nodes are shared: two of one level with equal children are one. Below the last level a node is a
    weight of its own, so equal leaves are one as well.
    """

    order: list[int]
    children: list[dict[int, tuple[int, int]]] = field(default_factory=list)
    weight: list[Weight] = field(default_factory=list)
    root: int = 0
    _known: dict[tuple, int] = field(default_factory=dict)

    @classmethod
    def of(cls, counts: dict[int, Weight], variables: int) -> Diagram:
        """The diagram of the weights of masks, in the order of the bits."""
        made = cls(list(range(variables)), [{} for _ in range(variables)])

        def build(level: int, mask: int) -> int:
            if level == variables:
                return made._leaf(counts.get(mask, NOTHING))
            return made._node(level, build(level + 1, mask), build(level + 1, mask | 1 << level))

        made.root = build(0, 0)
        return made

    def _leaf(self, weight: Weight) -> int:
        return self._add((len(self.order), weight), weight)

    def _node(self, level: int, passing: int, failing: int) -> int:
        node = self._add((self.order[level], passing, failing), _sum(self.weight[passing], self.weight[failing]))
        self.children[level][node] = (passing, failing)
        return node

    def _add(self, key: tuple, weight: Weight) -> int:
        if key not in self._known:
            self._known[key] = len(self.weight)
            self.weight.append(weight)
        return self._known[key]

    def swap(self, level: int) -> None:
        """Exchanges the variables of ``level`` and the one below it. Nodes of other levels keep what they lead to."""
        upper, lower = self.children[level], self.children[level + 1]
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]
        self.children[level], self.children[level + 1] = {}, {}
        renamed = {}
        for node, (passing, failing) in upper.items():
            (pp, pf), (fp, ff) = lower[passing], lower[failing]
            renamed[node] = self._node(level, self._node(level + 1, pp, fp), self._node(level + 1, pf, ff))
        if level == 0:
            self.root = renamed[self.root]
        else:
            above = self.children[level - 1]
            # The nodes above stay what they are; only the names of what they lead to change.
            self.children[level - 1] = {n: (renamed[p], renamed[f]) for n, (p, f) in above.items()}
            self._known.update({(self.order[level - 1], *c): n for n, c in self.children[level - 1].items()})

    def steps(self) -> Iterator[tuple[int, Weight, Weight]]:
        """Along the path that passes everything: (variable, what is kept after it, what fails it there)."""
        node = self.root
        for level, variable in enumerate(self.order):
            node, failing = self.children[level][node]
            yield variable, self.weight[node], self.weight[failing]


def plain_changes(n: int) -> Iterator[int]:
    """Levels to swap with the one below them, one after another, so that every order of n comes up once."""
    if n < 2:
        return
    down = True
    for at in [*plain_changes(n - 1), None]:
        yield from range(n - 1)[::-1] if down else range(n - 1)
        if at is not None:
            # The last variable stands at the top after going up and at the bottom after going down.
            yield at + 1 if down else at
        down = not down


STEP = (
    "filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, "
    "toxic_lost long, shapley long"
)


def audit_part(counts: dict[int, Weight], filters: str = FILTERS) -> list[tuple]:
    """The rows of STEP of one part: every order of the filters and every step of it."""
    n = len(filters)
    fails = [sum(w[0] for m, w in counts.items() if m >> i & 1) for i in range(n)]
    alone = [counts.get(1 << i, NOTHING)[0] for i in range(n)]
    diagram = Diagram.of(counts, n)
    rows, total = [], [0] * n
    for swap in [None, *plain_changes(n)]:
        if swap is not None:
            diagram.swap(swap)
        name = "".join(filters[i] for i in diagram.order)
        for step, (i, kept, removed) in enumerate(diagram.steps(), 1):
            total[i] += removed[0]
            rows.append((name, step, kept[0], removed[0], fails[i] - removed[0], alone[i], removed[1], removed[2], i))
    return [(*r[:-1], total[r[-1]]) for r in rows]


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """What each filter does at each place of each order, per part of rows (part, mask, n, good, toxic).

    A task holds the masks of one part, at most 2^filters rows. Without rows there is no part and no result.
    """

    def run(key: tuple, some: pd.DataFrame) -> pd.DataFrame:
        held: dict[int, Weight] = {}
        for m, *w in zip(some["mask"], some["n"], some["good"], some["toxic"], strict=True):
            held[int(m)] = _sum(held.get(int(m), NOTHING), tuple(map(int, w)))
        names = [x.split()[0] for x in STEP.split(", ")]
        out = pd.DataFrame(audit_part(held, filters), columns=names)
        out.insert(0, "part", key[0])
        return out

    return counts.groupBy("part").applyInPandas(run, f"part string, {STEP}")


def filter_audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """The audit of the five filters over documents, per value of a column."""
    return audit(mask_counts(docs, labels, part))

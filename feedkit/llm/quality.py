"""Quality rules as a short-circuit cascade.

Base measures are taken of every document. A document that passes the base rules goes through the other rules one by one
until one rejects it. Their order comes from a sample: each rule's seconds and rejections are measured on the executors,
and rules run by rejections per second, most first. The order changes the time and never the verdict, because a document
is kept if no rule rejects it.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.llm.text import filtered, pieces, utf8
from feedkit.operators.columns import unused

# Base rules: fewer words than this, or more than this percentage of the words in repeated 3-word windows.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Documents of the sample that orders the rules. It decides on the order alone.
SAMPLE_ROWS = 2_000
SYMBOLS = b"#*$%&|<>"

# Common function words of the four languages.
STOP_WORDS = frozenset(
    (
        b"the be to of and that have with is in it for was on are as this by from "
        b"de la le les et des en un une du que qui pour dans par sur pas au est "
        b"der die das und den von zu mit sich ist ein eine nicht auf als auch im "
        b"el los las del por con para una su al lo se y es no"
    ).split()
)


class Text:
    """A document's bytes; what several rules need is worked out once."""

    def __init__(self, data: bytes):
        self.data = data

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()

    @cached_property
    def lines(self) -> list[bytes]:
        """Lines with a word."""
        return [x for x in self.data.split(b"\n") if x and not x.isspace()]

    @cached_property
    def word_chars(self) -> int:
        joined = b"".join(self.words)
        # Bytes that go on a character are not counted.
        return len(joined.translate(None, bytes(range(0x80, 0xC0))))

    @cached_property
    def symbols(self) -> int:
        return len(self.data) - len(self.data.translate(None, SYMBOLS))

    @cached_property
    def dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def repeat_words(self) -> int:
        """Words in 3-word windows that occur twice or more in the text."""
        words = self.words
        windows = list(zip(words, words[1:], words[2:], strict=False))
        if len(set(windows)) == len(windows):
            return 0
        first: dict[tuple, int] = {}
        covered = bytearray(len(words))
        for i, window in enumerate(windows):
            at = first.setdefault(window, i)
            if at != i:
                covered[i : i + 3] = covered[at : at + 3] = b"\1\1\1"
        return sum(covered)

    @property
    def base_failed(self) -> bool:
        n = len(self.words)
        return n < MIN_WORDS or 100 * self.repeat_words > MAX_REPEAT_PERCENT * n


@dataclass(frozen=True)
class Rule:
    """``rejects`` sees a document that has a word."""

    name: str
    rejects: Callable[[Text], bool]


_LETTER = re.compile(rb"[A-Za-z\x80-\xff]")
_NOT_UPPER = bytes(set(range(256)) - set(range(65, 91)))
_NOT_LOWER = bytes(set(range(256)) - set(range(97, 123)))


def many_symbols(t: Text) -> bool:
    """More than one symbol in ten words."""
    return 10 * t.symbols > len(t.words)


def odd_word_length(t: Text) -> bool:
    """Words of less than 3 or more than 10 characters on average."""
    return not 3 * len(t.words) <= t.word_chars <= 10 * len(t.words)


def repeated_lines(t: Text) -> bool:
    """More than four lines in ten are copies of earlier ones."""
    return 10 * t.dup_lines > 4 * len(t.lines)


def shouting(t: Text) -> bool:
    """More than three of ten ASCII letters are capitals."""
    upper, lower = len(t.data.translate(None, _NOT_UPPER)), len(t.data.translate(None, _NOT_LOWER))
    return 10 * upper > 3 * (upper + lower)


def few_letters(t: Text) -> bool:
    """Fewer than eight words in ten hold a letter."""
    return 10 * sum(map(bool, map(_LETTER.search, t.words))) < 8 * len(t.words)


def no_stop_words(t: Text) -> bool:
    """Fewer than two different function words."""
    return len(STOP_WORDS.intersection(w.lower() for w in t.words)) < 2


def bullets(t: Text) -> bool:
    """More than nine lines in ten begin with a bullet."""
    return 10 * sum(x.lstrip().startswith((b"-", b"*", b"\xe2\x80\xa2")) for x in t.lines) > 9 * len(t.lines)


def ellipses(t: Text) -> bool:
    """More than three lines in ten end with an ellipsis."""
    return 10 * sum(x.rstrip().endswith((b"...", b"\xe2\x80\xa6")) for x in t.lines) > 3 * len(t.lines)


def few_different_words(t: Text) -> bool:
    """Fewer than one different word in twenty."""
    return 20 * len(set(t.words)) < len(t.words)


RULES = tuple(
    Rule(f.__name__, f)
    for f in (
        few_different_words,
        no_stop_words,
        few_letters,
        shouting,
        ellipses,
        bullets,
        repeated_lines,
        odd_word_length,
        many_symbols,
    )
)


def measured(docs: DataFrame, text: str, rules: Sequence[Rule] = RULES, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Seconds and rejections of each rule on a sample of documents: rows (rule, seconds, rejected, n).

    A rule is timed on a text of its own, so what it shares with others counts in full; the words are given, as the base
    rules always need them.
    """
    total = docs.count()
    some = docs.select(utf8(text).alias("data"))
    if total > rows:
        some = some.sample(fraction=rows / total, seed=1)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seconds, rejected, n = [0.0] * len(rules), [0] * len(rules), 0
        for batch in batches:
            for data in batch.column(0).to_pylist():
                base = Text(data)
                if base.base_failed:
                    continue
                n += 1
                for i, rule in enumerate(rules):
                    own = Text(data)
                    own.words = base.words
                    began = time.perf_counter()
                    rejected[i] += rule.rejects(own)
                    seconds[i] += time.perf_counter() - began
        yield pa.RecordBatch.from_pydict(
            {"rule": [r.name for r in rules], "seconds": seconds, "rejected": rejected, "n": [n] * len(rules)}
        )

    parts = some.mapInArrow(measure, "rule string, seconds double, rejected long, n long")
    return parts.groupBy("rule").agg(*[F.sum(c).alias(c) for c in ("seconds", "rejected", "n")])


def ordered(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejections per second on a sample, most first; cheaper ones first where none rejects."""
    found = {r["rule"]: r for r in measured(docs, text, rules, rows).collect()}

    def worth(rule: Rule) -> tuple[float, float]:
        seconds = max(found[rule.name]["seconds"], 1e-9)
        return -found[rule.name]["rejected"] / seconds, seconds

    return sorted(rules, key=worth) if found else list(rules)


MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_ADDED = [x.split()[0] for x in MEASURES.split(", ")] + ["base_failed", "kept", "rejected_by"]


def judge(docs: DataFrame, rules: Sequence[Rule], text: str = "text") -> DataFrame:
    """Adds the base measures, ``base_failed``, ``kept`` and ``rejected_by`` (the first rule that rejects).

    A null text has no words and fails as too short, as an empty one does. Repeated rows and rows without an id are
    judged each by itself. Columns of these names are replaced, columns of all other names kept. Which rule comes first
    depends on the order of the rules, ``kept`` does not.
    """
    kept = [c for c in docs.columns if c.lower() not in _ADDED]
    (data,) = unused(kept, "data")
    rows = docs.select(*kept, utf8(text).alias(data))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, data):
            out: list[tuple] = []
            for value in batch.column(data).to_pylist():
                t = Text(value)
                why = "base" if t.base_failed else next((r.name for r in rules if r.rejects(t)), None)
                out.append(
                    (len(t.words), t.word_chars, t.symbols, t.dup_lines, t.repeat_words, why == "base", why is None, why)
                )
            types = [pa.int64()] * 5 + [pa.bool_(), pa.bool_(), pa.string()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *columns], [*kept, *_ADDED])

    fields = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in rows.select(*kept).schema]
    schema = ", ".join([*fields, MEASURES, "base_failed boolean, kept boolean, rejected_by string"])
    return rows.mapInArrow(run, schema)


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that no rule rejects, with their own columns, also those that have a name ``judge`` adds.

    A document without text, or with an empty one, is rejected. Of repeated rows all stay or none.
    """
    return filtered(docs, _ADDED, text, lambda d, t: judge(d, ordered(d, t), t), "kept")

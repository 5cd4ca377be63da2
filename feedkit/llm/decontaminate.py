"""Benchmark decontamination by suffix arrays of the training texts.

A task cuts its documents into shards of bounded size and sorts the suffixes of each shard, word by word. Every suffix
of every benchmark item is then searched in it by binary search, all of them side by side: with each further word the
range of a suffix narrows, until nothing is left. The last range that held something is its longest verbatim match, and
the array says where. No shuffle is needed; the items are the only thing that all tasks share. They stand in a table in the
shared folder, from which a task reads them in blocks of bounded size, one at a time.

Words outside the items' vocabulary cannot match and are borders, as the ends of documents are. Suffixes that begin with
such a word are left out of the array.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.llm.text import filtered, pieces, utf8
from feedkit.operators.columns import unused
from feedkit.session import fresh_path

# Words of a match that count as contamination. A shorter item counts as a whole.
WINDOW = 10
# Tasks hold the items in blocks of at most this many bytes; every block is searched in all documents.
BLOCK_BYTES = 32 << 20
# Pairs of a document and an item are made distinct after at most about this many.
PAIRS = 1 << 20

# Letters A-Z become a-z; every byte that is no ASCII letter, digit or part of a longer character becomes a space.
_FOLD = bytes(
    (b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def words(data: bytes) -> list[bytes]:
    """Lower-cased words: runs of ASCII letters and digits and of any characters beyond ASCII."""
    return data.translate(_FOLD).split()


class Items:
    """Benchmark items as word numbers, one after another with borders between; what tasks search for."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        found = [(i, words(t)) for i, t in items]
        found = [(i, w) for i, w in found if w]
        self.number: dict[bytes, int] = {}
        for _, item in found:
            for w in item:
                self.number.setdefault(w, len(self.number) + 1)
        self.ids = [i for i, _ in found]
        sizes = np.array([len(w) for _, w in found], np.int64)
        starts = np.cumsum(np.append(0, sizes + 1)).astype(np.int64)
        # The words of all items, 0 after each one.
        self.flat = np.zeros(starts[-1] + 1, np.int32)
        for (_, item), at in zip(found, starts, strict=False):
            self.flat[at : at + len(item)] = [self.number[w] for w in item]
        # Every suffix: its item, its place in it, and the words a match must have to count.
        self.item = np.repeat(np.arange(len(found)), sizes)
        self.place = np.arange(len(self.item)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.at = starts[self.item] + self.place
        self.need = np.minimum(window, sizes)[self.item] if len(found) else np.zeros(0, np.int64)
        self.longest = int(sizes.max()) if len(found) else 0


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of the non-zero numbers of ``text``, sorted by what follows, up to ``depth`` numbers.

    The first keys pack as many numbers as fit 62 bits; ties are then sorted by the ranks of what comes after (prefix
    doubling), until none is left or the depth is reached. The text ends in zeros.
    """
    bits = max(1, int(text.max(initial=0)).bit_length())
    packed = max(1, 62 // bits)
    places = np.flatnonzero(text)
    if not len(places):
        return places
    padded = np.append(text, np.zeros(packed, text.dtype)).astype(np.int64)
    key = np.zeros(len(places), np.int64)
    for i in range(packed):
        key = (key << bits) | padded[places + i]
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    array = places[order]
    new = np.append(True, sorted_key[1:] != sorted_key[:-1])
    rank = np.zeros(len(text) + 1, np.int64)  # 0: a border
    rank[array] = np.cumsum(new)
    done = packed
    while done < depth:
        # Rows that share their rank with a neighbour.
        tied = ~new
        tied[:-1] |= ~new[1:]
        at = np.flatnonzero(tied)
        # A tie that runs into a border stays one: both end alike.
        if not len(at):
            break
        group = rank[array[at]]
        after = rank[np.minimum(array[at] + done, len(text))]
        order = np.lexsort((after, group))
        array[at] = array[at][order]
        group, after = group[order], after[order]
        split = np.append(True, (group[1:] != group[:-1]) | (after[1:] != after[:-1]))
        if np.array_equal(split, new[at]):
            break
        new[at] = split
        rank[array] = np.maximum.accumulate(np.where(new, np.arange(1, len(array) + 1), 0))
        done *= 2
    return array


def _narrow(text: np.ndarray, array: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int, word: np.ndarray, right: bool):
    """Binary search in the ranges [low, high): where ``word`` would go among the words ``depth`` places on."""
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        middle = (low + high) // 2
        value = text[np.minimum(array[np.minimum(middle, len(array) - 1)] + depth, len(text) - 1)]
        up = open_ & ((value <= word) if right else (value < word))
        low = np.where(up, middle + 1, low)
        high = np.where(open_ & ~up, middle, high)
    return low


def search(text: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes of items that count: (suffix, words of its longest match, a place of that match, array, ranges).

    ``array[ranges[0][i] : ranges[1][i]]`` are all places at which the words that count stand.
    """
    array = suffix_array(text, items.longest)
    active = np.arange(len(items.at))
    low, high = np.zeros(len(active), np.int64), np.full(len(active), len(array), np.int64)
    length = np.zeros(len(active), np.int64)
    place = np.full(len(active), -1, np.int64)
    hit_low, hit_high = np.zeros(len(active), np.int64), np.zeros(len(active), np.int64)
    depth = 0
    while len(active) and len(array):
        word = items.flat[items.at[active] + depth]
        inside = word > 0
        active, word = active[inside], word[inside]
        a = _narrow(text, array, low[active], high[active], depth, word, right=False)
        b = _narrow(text, array, low[active], high[active], depth, word, right=True)
        found = a < b
        active, a, b = active[found], a[found], b[found]
        low[active], high[active] = a, b
        depth += 1
        length[active], place[active] = depth, array[a] if len(a) else a
        counts = active[items.need[active] == depth]
        hit_low[counts], hit_high[counts] = low[counts], high[counts]
    some = np.flatnonzero(hit_high > hit_low)
    return some, length[some], place[some], array, np.stack([hit_low[some], hit_high[some]])


def _distinct_pairs(array: np.ndarray, starts: np.ndarray, low: np.ndarray, high: np.ndarray, item: np.ndarray, n_items: int):
    """Distinct row * n_items + item of the rows with a place in [low, high) of the array, for each range and its item.

    Equal ranges, such as those of a word that is repeated in an item, are listed once, and their rows are made distinct
    before the items come to them.
    """
    order = np.lexsort((item, high, low))
    low, high, item = low[order], high[order], item[order]
    other = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    keep = np.append(True, other | (item[1:] != item[:-1]))
    begin = np.flatnonzero(np.append(True, other)[keep])
    item, low, high = item[keep], low[keep][begin], high[keep][begin]
    n_items_of = np.diff(np.append(begin, len(item)))
    # Ranges of one number of words do not overlap, so a place is listed at most once for each such number.
    reach = high - low
    places = array[_spread(low, reach)]
    n_rows = len(starts)
    met = np.unique(np.repeat(np.arange(len(low)), reach) * n_rows + np.searchsorted(starts, places, side="right") - 1)
    by, row = met // n_rows, met % n_rows
    sums = np.cumsum(n_items_of[by])
    found = np.zeros(0, np.int64)
    for part in np.split(np.arange(len(met)), np.searchsorted(sums, np.arange(PAIRS, sums[-1], PAIRS))):
        n = n_items_of[by[part]]
        found = np.unique(np.append(found, np.repeat(row[part], n) * n_items + item[_spread(begin[by[part]], n)]))
    return found


def _spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each row, ``count`` numbers of it."""
    return np.arange(count.sum()) + np.repeat(start - np.cumsum(count) + count, count)


def _shard_matches(shard: list[list[int]], items: Items) -> tuple[dict[int, tuple], list[tuple]]:
    """Of a shard of word numbers: per row with hits (which words are hit, items as numbers), and the longest matches.

    Memory is in proportion to the shard and the items, however often words repeat: hits are marks where ranges of the
    array begin and end, one set for each number of words that counts.
    """
    sizes = np.array([len(w) for w in shard], np.int64)
    starts = np.cumsum(np.append(0, sizes + 1))
    text = np.zeros(starts[-1] + 1, np.int32)
    for numbers, at in zip(shard, starts, strict=False):
        text[at : at + len(numbers)] = numbers
    suffix, length, place, array, (low, high) = search(text, items)
    if not len(suffix):
        return {}, []
    # Where the hits that begin so far end, for each word of the text.
    end = np.zeros(len(text), np.int64)
    need = items.need[suffix]
    for n in np.unique(need).tolist():
        marks = np.zeros(len(array) + 1, np.int64)
        np.add.at(marks, low[need == n], 1)
        np.add.at(marks, high[need == n], -1)
        begin = array[np.cumsum(marks[:-1]) > 0]
        end[begin] = np.maximum(end[begin], begin + n)
    hit = np.maximum.accumulate(end) > np.arange(len(text))
    pairs = _distinct_pairs(array, starts, low, high, items.item[suffix], len(items.ids))
    rows, first = np.unique(pairs // len(items.ids), return_index=True)
    found = {}
    for r, numbers in zip(rows.tolist(), np.split(pairs % len(items.ids), first[1:]), strict=True):
        found[r] = (hit[starts[r] : starts[r] + sizes[r]], numbers.tolist())
    matches = []
    for s, n, p in zip(suffix.tolist(), length.tolist(), place.tolist(), strict=True):
        r = int(np.searchsorted(starts, p, side="right")) - 1
        matches.append((r, items.ids[items.item[s]], int(items.place[s]), int(p - starts[r]), n))
    return found, matches


MATCH = "array<struct<item_id:string,item_word:int,doc_word:int,n_words:int>>"
_MATCH = pa.list_(
    pa.struct([("item_id", pa.string()), ("item_word", pa.int32()), ("doc_word", pa.int32()), ("n_words", pa.int32())])
)
_ADDED = ["n_words", "n_hit", "n_items", "items", "matches"]

# The block that stands alone in its table, so that a worker reads and numbers it once for all its shards.
_held: dict[tuple, Items] = {}


def _batches_of(folder: str) -> Iterator[pa.RecordBatch]:
    """The rows (i, t) of a Parquet folder in the order of its files."""
    store, base = fs.FileSystem.from_uri(folder)
    names = sorted(x.path for x in store.get_file_info(fs.FileSelector(base)) if x.base_name.endswith(".parquet"))
    for name in names:
        with store.open_input_file(name) as file:
            yield from pq.ParquetFile(file).iter_batches(batch_size=256, columns=["i", "t"])


def _blocks(folder: str, window: int, size: int) -> Iterator[Items]:
    """The stored items in blocks of at most ``size`` bytes, one at a time; a larger item stands alone."""
    key = (folder, window, size)
    if key in _held:
        yield _held[key]
        return
    _held.clear()
    block, held, count = [], 0, 0
    for batch in _batches_of(folder):
        for i, t in zip(batch.column("i").to_pylist(), batch.column("t").to_pylist(), strict=True):
            if block and held + len(t) > size:
                yield Items(block, window)
                block, held, count = [], 0, count + 1
            block.append((i, t))
            held += len(t)
    last = Items(block, window)
    if not count:
        _held[key] = last
    yield last


def mark_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Adds n_words, n_hit (words inside an occurrence of a window of an item), n_items, items and matches to the documents.

    ``items`` are the sorted ids (as strings) of the items of which a window occurs. ``matches`` are the longest
    verbatim matches found in a shard, one for each suffix of an item that counts: where it begins in the item and in
    the document, in words. A null or empty text has no words, and items without words have no windows. Rows of one
    item_id count as one item. Items without an id are searched as well: their hits count in n_hit, they are one item
    of n_items together and have no name in ``items``. Repeated documents each get their own result, and documents
    without an id are marked as any others. Columns of the added names are replaced, columns of all other names kept.
    """
    kept = [c for c in docs.columns if c.lower() not in _ADDED]
    (data,) = unused(kept, "data")
    rows = docs.select(*kept, utf8(text).alias(data))
    folder = fresh_path(docs.sparkSession, "items")
    benchmark.select(F.col(item).cast("string").alias("i"), utf8(item_text).alias("t")).write.parquet(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, data):
            split = [words(x) for x in batch.column(data).to_pylist()]
            hits: list[np.ndarray | None] = [None for _ in split]
            names: list[set] = [set() for _ in split]
            longest: list[list[dict]] = [[] for _ in split]
            for items in _blocks(folder, window, block_bytes):
                if not items.ids:
                    continue
                get = items.number.get
                found, matches = _shard_matches([[get(w, 0) for w in ws] for ws in split], items)
                for i, (hit, numbers) in found.items():
                    hits[i] = hit if hits[i] is None else hits[i] | hit
                    names[i].update(items.ids[x] for x in numbers)
                for i, *m in matches:
                    longest[i].append(dict(zip(("item_id", "item_word", "doc_word", "n_words"), m, strict=True)))
            columns = [
                pa.array([len(w) for w in split], pa.int64()),
                pa.array([0 if x is None else int(x.sum()) for x in hits], pa.int64()),
                pa.array([len(x) for x in names], pa.int64()),
                pa.array([sorted(x - {None}) for x in names], pa.list_(pa.string())),
                pa.array(longest, _MATCH),
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *columns], [*kept, *_ADDED])

    fields = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in rows.select(*kept).schema]
    schema = ", ".join([*fields, f"n_words long, n_hit long, n_items long, items array<string>, matches {MATCH}"])
    return rows.mapInArrow(run, schema)


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents without a window of a benchmark item, with their own columns, whatever their names.

    Documents without text or words stay. Of repeated rows all stay or none.
    """
    return filtered(docs, _ADDED, text, lambda d, t: mark_contaminated(d, benchmark, t), "n_hit = 0")

"""Language-model scores by a hierarchical Pitman-Yor model.

A text is a sequence of words and its end. The context of a word is the two words before it (a mark stands before a text)
and the language that the function words before it speak for, if any. Contexts are restaurants of words: those of two words
before share a parent that knows one of them, those of one word share the language's, and the languages share one that
serves all words; its parent spells them, symbol by symbol, from the ORDER - 1 symbols before. Every such context is a
restaurant that shares its parent, the context without its first symbol, with all contexts of that ending, down to a
uniform choice of symbols. Tables of a restaurant are customers of its parent. Seatings are sampled by Gibbs sweeps over the
dishes, each dish's customers being seated anew by the Chinese restaurant process given all other tables, and predictive
probabilities are averaged over samples.

The words' restaurants grow with the corpus and are spread over partitions. Documents are stored in chunks, as numbers of
the chunk's distinct dishes (a word in a language); a chunk asks the partitions once for each of them. Restaurants of
preceding words are dealt by the last of these, so every such restaurant is whole in one partition and its sums are exact. A
round samples them given the probabilities of the languages' dishes, and then the languages and all words given their
tables, sample by sample; ROUNDS rounds follow a first one in which every use of a word is a customer of its language.

The spelling model is bounded: with SYMBOLS = 64 (a-z, digits, frequent punctuation, sixteen halves of any other byte, the
ends of a word and of a text) and ORDER = 4 it has 64^4 probabilities, 64 MB, however large the corpus is. That bound is
why one task may fit it and every worker may hold it. Its customers come from all training texts, one for each distinct
word of every few megabytes of text: the seating of the words' restaurant that it starts from.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.llm.scratch import Scratch
from feedkit.llm.text import pieces, utf8
from feedkit.session import fresh_path

ORDER = 4
BITS = 6
SYMBOLS = 1 << BITS
WORD_END, TEXT_END = 1, 0
PUNCTUATION = b".,-'\"|!?:;"
# Function words that speak for a language. Those of several languages speak for none.
LANGUAGES = (
    b"the be to of and that have with is in it for was on are as this by from",
    b"de la le les et des en un une du que qui pour dans par sur pas au est",
    b"der die das und den von zu mit sich ist ein eine nicht auf als auch im des",
    b"el los las la de en que del por con para una un su al lo se y es no",
)
CONTEXTS = len(LANGUAGES) + 1
# Discount and strength of the spelling restaurants, by length of their context, of the restaurant that serves all words,
# and of those of the contexts.
DISCOUNT = (0.5, 0.6, 0.7, 0.75)
STRENGTH = (1.0, 1.0, 1.0, 1.0)
WORD_DISCOUNT, WORD_STRENGTH = 0.75, 10.0
CONTEXT_DISCOUNT, CONTEXT_STRENGTH = 0.5, 10.0
# Those of the restaurants of one and of two words before.
ONE_DISCOUNT, ONE_STRENGTH = 0.75, 5.0
TWO_DISCOUNT, TWO_STRENGTH = 0.85, 5.0
BURN_IN, SAMPLES, ROUNDS = 2, 3, 1
SEED = 11
# Customers that are seated one by one; later ones of a dish are seated in blocks that double.
ONE_BY_ONE = 32
# Tokens of a chunk of documents, and distinct dishes of chunks that a partition of the vocabulary answers.
CHUNK_TOKENS = 1_500_000
PARTITION_DISHES = 3_000_000
# Tokens for each partition of the restaurants of preceding words, and the number of the mark before a text.
PARTITION_TOKENS = 1_500_000
# The partitions of preceding words are sampled in so many goes, so that only what is sent to some is on disk at a time.
GOES = 3
START = 1 << 62


def _tables() -> np.ndarray:
    """First and second symbol of every byte; 255 where there is none."""
    first, second = np.full(256, 255, np.uint8), np.full(256, 255, np.uint8)
    plain = [(10, WORD_END)] + [(97 + i, 2 + i) for i in range(26)] + [(48 + i, 28 + i) for i in range(10)]
    plain += [(b, 38 + i) for i, b in enumerate(PUNCTUATION)]
    for b in range(256):
        first[b], second[b] = 48 + (b >> 4), 48 + (b & 15)
    for b, symbol in plain:
        first[b], second[b] = symbol, 255
    return np.stack([first, second], axis=1)


_SYMBOLS = _tables()


def words_of(data: bytes) -> list[bytes]:
    return data.lower().split()


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Packed runs of ORDER symbols that end at each symbol of the words and at their ends; where each word begins.

    Before a word stand zeros. The empty word is the end of a text.
    """
    flat = np.frombuffer(b"\n".join(words) + b"\n", np.uint8)
    pairs = _SYMBOLS[flat]
    # No word holds a line feed: it is where one ends.
    pairs[(flat == 10) & (np.append(10, flat[:-1]) == 10), 0] = TEXT_END
    last = np.flatnonzero((flat == 10).repeat(2).reshape(-1, 2)[pairs != 255])
    symbols = pairs[pairs != 255].astype(np.uint32)
    starts = np.append(0, last[:-1] + 1)
    key = symbols.copy()
    for back in range(1, ORDER):
        key[back:] |= symbols[:-back] << np.uint32(BITS * back)
    for place in range(ORDER - 1):
        at = starts + place
        at = at[at <= last]
        key[at] &= np.uint32((1 << BITS * (place + 1)) - 1)
    return key, starts


def held_out(id_: str, rest: int = 1) -> Column:
    """Rows that are never learned from: crc32 of the id as text leaves this remainder by 5. A null id is an empty text."""
    return F.crc32(F.coalesce(F.col(id_).cast("string"), F.lit("")).cast("binary")) % 5 == rest


def gram_counts(docs: DataFrame, text: str) -> DataFrame:
    """Rows (gram, n) of the distinct words of all pieces of text, summed within each task and then over tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**ORDER, np.int64)
        for batch in batches:
            for part in pieces([batch], "data"):
                words = set().union(*(words_of(x) for x in part.column("data").to_pylist()))
                keys, n = np.unique(grams([b"", *words])[0], return_counts=True)
                total[keys] += n
        found = np.flatnonzero(total)
        for at in range(0, len(found), 1 << 16):
            some = found[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["gram", "n"])

    parts = docs.select(utf8(text).alias("data")).mapInArrow(run, "gram int, n long")
    return parts.groupBy("gram").agg(F.sum("n").alias("n"))


def seat(c: np.ndarray, p: np.ndarray, others: np.ndarray, theta: float, d: float, random: np.random.Generator) -> np.ndarray:
    """Tables of dishes whose c > 0 customers are seated anew, by the Chinese restaurant process.

    A dish's first customer opens a table. Customer i + 1 opens one with weight (theta + d T) p against i - d t for the t
    tables there are; p is the parent's probability of the dish, T all tables of the restaurant, of which ``others`` are
    those of other dishes.
    """
    t = np.ones(len(c), np.int64)
    for i in range(1, min(ONE_BY_ONE, int(c.max(initial=1)))):
        some = np.flatnonzero(c > i)
        new = (theta + d * (others[some] + t[some])) * p[some]
        t[some] += random.random(len(some)) * (new + i - d * t[some]) < new
    low = ONE_BY_ONE
    while low < int(c.max(initial=1)):
        # Customers low + 1 to 2 low: their chances change little, so the tables they open are nearly Poisson.
        some = np.flatnonzero(c > low)
        last = np.minimum(c[some], 2 * low)
        new = (theta + d * (others[some] + t[some])) * p[some]
        old = d * t[some]
        t[some] = np.minimum(t[some] + random.poisson(new * np.log((new + last - old) / (new + low - old))), last)
        low *= 2
    return t


class Level:
    """All restaurants of one context length: customers and tables of every dish, rows by context."""

    def __init__(self, length: int, customers: np.ndarray):
        self.d, self.theta = DISCOUNT[length], STRENGTH[length]
        self.c = customers
        self.t = (customers > 0).astype(np.int32)

    def predictive(self, parent: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
        """Probability of every dish in the restaurants first to last, given that in the parent of each."""
        c, t = self.c[first:last], self.t[first:last]
        total, tables = c.sum(axis=1, keepdims=True), t.sum(axis=1, keepdims=True)
        return (np.maximum(c - self.d * t, 0.0) + (self.theta + self.d * tables) * parent) / (self.theta + total)

    def sweep(self, parent: np.ndarray, random: np.random.Generator) -> None:
        """Seats all customers anew. The parent of a context is the one without its first symbol."""
        at = np.nonzero(self.c > 1)
        p = parent[at[0] % len(parent), at[1]]
        self.t[at] = seat(self.c[at], p, self.t.sum(axis=1)[at[0]] - self.t[at], self.theta, self.d, random)


class Model:
    """Levels of the spelling model, from the empty context to the longest one."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        counts = np.zeros(SYMBOLS**ORDER, np.int64)
        counts[keys] = n
        self.levels = [Level(ORDER - 1, counts.reshape(-1, SYMBOLS))]
        for length in range(ORDER - 2, -1, -1):
            self.levels.insert(0, Level(length, self._customers(self.levels[0].t, length)))
        self.random = np.random.default_rng(SEED)

    @staticmethod
    def _customers(tables: np.ndarray, length: int) -> np.ndarray:
        """Customers of restaurants with contexts of ``length`` symbols: the tables of all their children."""
        return tables.reshape(SYMBOLS, SYMBOLS**length, SYMBOLS).sum(axis=0, dtype=np.int64)

    def predictive(self, length: int) -> np.ndarray:
        """Probabilities of all restaurants of a context length; -1 stands for the uniform choice."""
        p = np.full((1, SYMBOLS), 1 / SYMBOLS)
        for k, level in enumerate(self.levels[: length + 1]):
            # The contexts of a parent repeat under every first symbol of its children.
            p = level.predictive(p if k == 0 else np.tile(p, (SYMBOLS, 1)))
        return p

    def sweep(self) -> None:
        """One Gibbs sweep, from the longest contexts up; parents take the new tables as their customers."""
        for length in range(ORDER - 1, -1, -1):
            self.levels[length].sweep(self.predictive(length - 1), self.random)
            if length:
                above = self.levels[length - 1]
                above.c = self._customers(self.levels[length].t, length - 1)
                above.t = np.where(above.c > 0, np.clip(above.t, 1, np.maximum(above.c, 1)), 0)

    def averaged(self) -> np.ndarray:
        """log10 of the predictive probabilities of the longest contexts, averaged over samples of the seating."""
        size = SYMBOLS ** (ORDER - 2)
        total = np.zeros((SYMBOLS, size, SYMBOLS), np.float32)
        for i in range(BURN_IN + SAMPLES):
            self.sweep()
            if i >= BURN_IN:
                parent = self.predictive(ORDER - 2)
                for k in range(SYMBOLS):
                    total[k] += self.levels[-1].predictive(parent, k * size, (k + 1) * size)
        return np.log10(total.reshape(-1) / SAMPLES)


def fit(docs: DataFrame, text: str = "text") -> str:
    """Fits the model to all texts given and writes it; returns its folder. Without any text all symbols are alike.

    The counts have at most 64^4 rows, and one task turns them into the table of probabilities.
    """
    folder = fresh_path(docs.sparkSession, "pitman-yor")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column("gram").to_numpy(), b.column("n").to_numpy()) for b in batches]
        keys, n = (np.concatenate(x) if parts else np.zeros(0, np.int64) for x in (zip(*parts, strict=True) if parts else ((), ())))
        table = Model(keys, n).averaged()
        size = SYMBOLS ** (ORDER - 1)
        for i in range(SYMBOLS):
            block = table[i * size : (i + 1) * size].astype("<f4").tobytes()
            yield pa.RecordBatch.from_pydict({"part": pa.array([i], pa.int32()), "block": [block]})

    gram_counts(docs, text).repartition(1).mapInArrow(run, "part int, block binary").write.parquet(folder)
    return folder


_models: dict[str, np.ndarray] = {}


def load(folder: str) -> np.ndarray:
    """The table of a fitted model, read once per worker from the shared folder. A worker holds one model."""
    if folder not in _models:
        store, base = fs.FileSystem.from_uri(folder)
        files = [f.path for f in store.get_file_info(fs.FileSelector(base)) if f.path.endswith(".parquet")]
        rows = [r for f in files for r in pq.read_table(f, filesystem=store).to_pylist()]
        _models.clear()
        _models[folder] = np.frombuffer(b"".join(r["block"] for r in sorted(rows, key=lambda r: r["part"])), "<f4")
    return _models[folder]


def _speaks_for() -> dict[bytes, int]:
    """Number of the language that a function word speaks for, from 1 on."""
    lists = [x.split() for x in LANGUAGES]
    held = [w for x in lists for w in x]
    return {w: i + 1 for i, x in enumerate(lists) for w in x if held.count(w) == 1}


_SPEAKS_FOR = _speaks_for()


class _Numbers(dict):
    """Numbers of words in the order in which they are first asked for, and the languages they speak for."""

    def __init__(self):
        super().__init__()
        self.languages: list[int] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.languages.append(_SPEAKS_FOR.get(word, 0))
        return number


def contexts(languages: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Context of every token of texts of the given sizes: the language most words before it in its text speak for.

    The first language in the list wins a tie; 0 is the context in which none has spoken yet.
    """
    votes = np.zeros((len(languages) + 1, CONTEXTS - 1), np.int32)
    votes[1:] = np.cumsum(languages[:, None] == np.arange(1, CONTEXTS), axis=0, dtype=np.int32)
    starts = np.cumsum(sizes) - sizes
    before = votes[:-1] - np.repeat(votes[starts], sizes, axis=0)
    return np.where(before.any(axis=1), before.argmax(axis=1) + 1, 0)


STORE = (
    "chunk long, id array<long>, held array<boolean>, n_tokens array<long>, numbers binary, "
    "words binary, contexts binary, train binary, spelling binary, n_dishes long"
)


def _packed(numbers: np.ndarray, kind: str = "<u4") -> bytes:
    """Numbers by planes of their bytes, compressed, after the size of the planes."""
    size = np.dtype(kind).itemsize
    planes = np.ascontiguousarray(numbers.astype(kind).reshape(-1)).view(np.uint8).reshape(-1, size).T
    planes = np.ascontiguousarray(planes).tobytes()
    return len(planes).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(planes, asbytes=True)


def _unpacked(data: bytes, kind: str = "<u4") -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.Codec("zstd").decompress(data[8:], size, asbytes=True) if size else b"", np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


def _packed_words(hashes: np.ndarray) -> bytes:
    """Sorted hashes by their steps."""
    return _packed(np.diff(hashes.astype(np.uint64), prepend=np.uint64(0)), "<u8")


def _unpacked_words(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data, "<u8"), dtype=np.uint64)


# What the store has of each dish.
KINDS = {"words": "<u8", "contexts": "u1", "train": "<u4", "spelling": "<f4"}


def _dishes(row: dict, *names: str) -> list[np.ndarray]:
    return [_unpacked_words(row[k]) if k == "words" else _unpacked(row[k], KINDS[k]) for k in names]


def chunks(docs: DataFrame, model: str, id_: str, text: str, folder: str) -> DataFrame:
    """Stores texts in chunks: tokens as places in the chunk's distinct dishes, sorted by hash and context; written to ``folder``.

    A chunk has a folder of its own, from which the tasks that work on it fetch it. Tokens are kept as ranks of their dishes
    by use in training texts, then by place. Of a dish it keeps the word's hash, the context, how often training texts of the chunk hold it, and log10 of the
    probability of the word's spelling.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, number = load(model), TaskContext.get().partitionId() << 32
        known, ids, outs, tokens, size = _Numbers(), [], [], [], 0

        def chunk() -> pa.RecordBatch:
            sizes = np.array([len(x) for x in tokens], np.int64)
            flat = np.concatenate(tokens)
            words = list(known)
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
            keys, starts = grams(words)
            spelling = np.add.reduceat(table[keys].astype(np.float64), starts)
            order = np.argsort(hashes)
            place = np.empty(len(words), np.int64)
            place[order] = np.arange(len(words))
            spoken = contexts(np.array(known.languages, np.int8)[flat], sizes)
            dishes, places = np.unique(place[flat] * CONTEXTS + spoken, return_inverse=True)
            trained = np.bincount(places[np.repeat(~np.array(outs, bool), sizes)], minlength=len(dishes))
            word = order[dishes // CONTEXTS]
            rank = np.empty(len(dishes), np.int64)
            rank[_by_use(trained)] = np.arange(len(dishes))
            row = [number, ids, outs, sizes, _packed(rank[places]), _packed_words(hashes[word]), _packed(dishes % CONTEXTS, "u1")]
            row += [_packed(trained), _packed(spelling[word], "<f4"), len(dishes)]
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64())] + [pa.binary()] * 5 + [pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types, strict=True)], _names(STORE))

        for batch in batches:
            for part in pieces([batch], "data"):
                for i, out, data in zip(*(part.column(c).to_pylist() for c in ("id", "held", "data")), strict=True):
                    words = words_of(data)
                    words.append(b"")
                    tokens.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
                    ids.append(i), outs.append(out)
                    size += len(words)
                    if size >= CHUNK_TOKENS:
                        yield chunk()
                        number += 1
                        known, ids, outs, tokens, size = _Numbers(), [], [], [], 0
        if ids:
            yield chunk()

    rows = docs.select(F.col(id_).cast("long").alias("id"), held_out(id_).alias("held"), utf8(text).alias("data"))
    rows = rows.mapInArrow(run, STORE)
    rows.write.partitionBy("chunk").parquet(folder)
    return docs.sparkSession.read.schema(rows.schema).parquet(folder)


def _by_use(train: np.ndarray) -> np.ndarray:
    """Places of dishes, those that training texts use often first."""
    return np.argsort(-train.astype(np.int64), kind="stable")


def _stored(folder: str, chunk: int) -> dict:
    """The stored row of a chunk."""
    store, base = fs.FileSystem.from_uri(f"{folder}/chunk={chunk}")
    files = [f.path for f in store.get_file_info(fs.FileSelector(base)) if f.path.endswith(".parquet")]
    return next(r for f in files for r in pq.read_table(f, filesystem=store, partitioning=None).to_pylist())


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


# For each dish asked, sample after sample: ``own`` is c - d t in its language; ``shared`` is c - d t of its word in the
# restaurant of all words; ``uses`` says how often training texts hold the word; ``number`` is the word's own in the corpus:
# its rank by uses among those of its partition, times the partitions, plus the partition. Often used ones are small.
REPLY = "chunk long, part int, own binary, shared binary, uses binary, number binary, sums array<double>"


def seated(word: np.ndarray, context: np.ndarray, c: list[np.ndarray], p: np.ndarray, parts: int, part: int):
    """Gibbs samples of the seating of a partition's dishes (c > 0 customers each, by sample) and of their words.

    ``word`` numbers the words of the dishes, ``p`` has the spelling's probability of each word. Words are dealt evenly,
    so sums over a whole restaurant are taken as ``parts`` times the partition's own. Yields (customers and tables of the
    dishes, customers and tables of the words).
    """
    random = np.random.default_rng([SEED, part])
    t, tables = np.ones(len(word), np.int64), np.ones(len(p), np.int64)
    customers = np.bincount(word, minlength=len(p))
    for i in range(BURN_IN + SAMPLES):
        now = c[max(0, i - BURN_IN)]
        all_tables = parts * tables.sum()
        base = np.maximum(customers - WORD_DISCOUNT * tables, 0) + (WORD_STRENGTH + WORD_DISCOUNT * all_tables) * p
        base /= WORD_STRENGTH + parts * customers.sum()
        others = parts * np.bincount(context, weights=t, minlength=CONTEXTS)[context] - t
        t = seat(now, base[word], others, CONTEXT_STRENGTH, CONTEXT_DISCOUNT, random)
        customers = np.bincount(word, weights=t, minlength=len(p)).astype(np.int64)
        tables = seat(customers, p, all_tables - tables, WORD_STRENGTH, WORD_DISCOUNT, random)
        if i >= BURN_IN:
            yield now, t, customers, tables


def _answers(asked: np.ndarray, contexts_: np.ndarray, train: np.ndarray, spelling: np.ndarray, sent: list, parts: int, part: int):
    """For every dish asked, own, shared, uses and number as in REPLY; and the sums over the partition's restaurants.

    ``sent`` has the tables (ranks of words, contexts, tables by sample) of the restaurants of preceding words; where it is empty,
    every use is a customer. The sums are: different words and tokens of training texts; per sample and context its
    customers, then its tables; per sample customers and tables of the restaurant of all words.
    """
    words, first, word_at = np.unique(asked, return_index=True, return_inverse=True)
    dishes, dish_at = np.unique(word_at * CONTEXTS + contexts_, return_inverse=True)
    c = np.bincount(dish_at, weights=train, minlength=len(dishes)).astype(np.int64)
    uses = np.bincount(dishes // CONTEXTS, weights=c, minlength=len(words)).astype(np.int64)
    eaten, served = np.flatnonzero(c), np.flatnonzero(uses)
    place = np.zeros(len(words), np.int64)
    place[served] = np.arange(len(served))
    context = dishes[eaten] % CONTEXTS
    p = 10.0 ** spelling[first][served].astype(np.float64)
    by_rank = np.lexsort([words, -uses])
    rank = np.empty(len(words), np.int64)
    rank[by_rank] = np.arange(len(words))
    guests = [c[eaten]] * SAMPLES
    if sent:
        at = [np.searchsorted(dishes, by_rank[w] * CONTEXTS + k) for w, k, _ in sent]
        at, tables = np.concatenate(at), np.concatenate([t for *_, t in sent], axis=1)
        guests = [np.bincount(at, weights=t, minlength=len(dishes)).astype(np.int64)[eaten] for t in tables]
    own, shared = (np.zeros((SAMPLES, n), "<f4") for n in (len(dishes), len(words)))
    sums = np.zeros((SAMPLES, 2 * CONTEXTS + 2))
    if len(eaten):
        for i, (now, t, customers, tables) in enumerate(seated(place[dishes[eaten] // CONTEXTS], context, guests, p, parts, part)):
            own[i, eaten] = now - CONTEXT_DISCOUNT * t
            shared[i, served] = np.maximum(customers - WORD_DISCOUNT * tables, 0)
            sums[i, :CONTEXTS] = np.bincount(context, weights=now, minlength=CONTEXTS)
            sums[i, CONTEXTS:-2] = np.bincount(context, weights=t, minlength=CONTEXTS)
            sums[i, -2:] = customers.sum(), tables.sum()
    number = (rank * parts + part)[word_at]
    return own[:, dish_at], shared[:, word_at], uses[word_at], number, [float(len(served)), float(c.sum()), *sums.reshape(-1).tolist()]


def _word_bits(store: DataFrame) -> int:
    """Leading bits of a word's hash that number its partition."""
    total = store.agg(F.sum("n_dishes")).first()[0] or 0
    return max(0, int(-(-total // PARTITION_DISHES) - 1).bit_length())


def _edges(words: np.ndarray, bits: int) -> list[int]:
    """Where each partition's words begin in sorted hashes, and where the last one's end."""
    borders = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(0, np.uint64)
    return [0, *np.searchsorted(words, borders).tolist(), len(words)]


def word_counts(store: DataFrame, bits: int, sent: DataFrame | None = None) -> DataFrame:
    """Answers to every chunk's dishes, in pieces: rows of REPLY.

    Words are dealt to partitions by their leading bits, so the pieces of a chunk in the order of ``part`` follow its
    sorted dishes. A row without a chunk per partition has the sums. ``sent`` holds rows (part, words, contexts, tables).
    """
    parts = 1 << bits

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                words, *rest = _dishes(row, *KINDS)
                edges = _edges(words, bits)
                for p, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    if a < b:
                        values = [_packed_words(words[a:b]), *[_packed(x[a:b], x.dtype.str) for x in rest]]
                        one = {"part": pa.array([p], pa.int32()), "chunk": [row["chunk"]]}
                        yield pa.RecordBatch.from_pydict(one | {k: [x] for k, x in zip(KINDS, values, strict=True)})

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_part: dict[int, list[dict]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                by_part.setdefault(row["part"], []).append(row)
        for part, both in by_part.items():
            rows = sorted((r for r in both if r["chunk"] is not None), key=lambda r: r["chunk"])
            tables = [r for r in both if r["chunk"] is None]
            # The order in which tables arrive is no part of the result: they are only added up.
            tables = [(_unpacked(r["words"]), _unpacked(r["contexts"], "u1"), _unpacked(r["tables"]).reshape(SAMPLES, -1)) for r in tables]
            found = [_dishes(r, *KINDS) for r in rows]
            sizes = [len(x[0]) for x in found]
            columns = [np.concatenate(x) for x in zip(*found, strict=True)]
            del found
            own, shared, uses, number, sums = _answers(*columns, tables, parts, part)
            at = 0
            for r, n in zip(rows, sizes, strict=True):
                to = at + n
                packed = [_packed(own[:, at:to], "<f4"), _packed(shared[:, at:to], "<f4"), _packed(uses[at:to], "<u8")]
                yield _reply(r["chunk"], part, *packed, _packed(number[at:to], "<u8"), None)
                at = to
            yield _reply(None, None, None, None, None, None, sums)

    requests = store.select("chunk", *KINDS).mapInArrow(ask, "part int, chunk long, words binary, contexts binary, train binary, spelling binary")
    requests = requests.withColumn("tables", F.lit(None).cast("binary"))
    if sent is not None:
        requests = requests.unionByName(sent.select("part", "words", "contexts", "tables"), allowMissingColumns=True)
    return requests.repartition(parts, "part").mapInArrow(answer, REPLY)


def _reply(*values) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32()] + [pa.binary()] * 4 + [pa.list_(pa.float64())]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], _names(REPLY))


class Sums:
    """What the answers to words say of whole restaurants, and the probabilities that follow from it."""

    def __init__(self, replies: DataFrame):
        size = 2 + SAMPLES * (2 * CONTEXTS + 2)
        found = replies.filter("chunk IS NULL").agg(*[F.sum(F.get("sums", F.lit(i))) for i in range(size)]).first()
        self.words, self.trained, *more = (x or 0 for x in found)
        by_sample = np.array(more, np.float64).reshape(SAMPLES, -1)
        self.guests, self.tables, self.alls = by_sample[:, :CONTEXTS], by_sample[:, CONTEXTS:-2], by_sample[:, -2:]

    def probabilities(self, own: np.ndarray, shared: np.ndarray, language: np.ndarray, spelling: np.ndarray) -> np.ndarray:
        """Predictive probabilities of dishes in their languages, a row per sample."""
        total = np.empty((SAMPLES, len(spelling)))
        for i in range(SAMPLES):
            word = shared[i] + (WORD_STRENGTH + WORD_DISCOUNT * self.alls[i, 1]) * spelling
            word /= WORD_STRENGTH + self.alls[i, 0]
            total[i] = own[i] + (CONTEXT_STRENGTH + CONTEXT_DISCOUNT * self.tables[i, language]) * word
            total[i] /= CONTEXT_STRENGTH + self.guests[i, language]
        return total


class Asked:
    """The dishes of a stored chunk in the contexts of the two words before, and which of them each token is.

    ``places`` are the dishes of the tokens themselves. Of ``parts`` partitions of words, ``some`` are asked: words are dealt by
    their hashes in order, the mark to the last.
    ``pairs`` are a preceding word times ``n_dishes`` plus the chunk's dish, ``triples`` a place in them times ``base`` plus
    the word before that; both are sorted. Words are places in the chunk's sorted hashes, the mark stands at their end.
    """

    def __init__(self, row: dict, parts: int = 1, some: range = range(1)):
        words, train = _dishes(row, "words", "train")
        places, sizes = _by_use(train)[_unpacked(row["numbers"])], np.array(row["n_tokens"], np.int64)
        self.places = places
        self.new = np.append(True, words[1:] != words[:-1])
        self.hashes = words[self.new]
        self.n_dishes, self.base = len(words), len(self.hashes) + 1
        token = (np.cumsum(self.new) - 1)[places]
        starts = np.cumsum(sizes) - sizes
        one = np.append(0, token[:-1])
        one[starts] = self.base - 1
        two = np.append(0, one[:-1])
        two[starts] = self.base - 1
        learned = np.repeat(~np.array(row["held"], bool), sizes)
        self.some = some
        self.part = np.append((self.hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32), np.uint64(parts - 1)).astype(np.int64)
        if len(some) < parts:
            mine = (self.part[one] >= some.start) & (self.part[one] < some.stop)
            one, two, places, learned = one[mine], two[mine], places[mine], learned[mine]
        self.pairs, at = np.unique(one * self.n_dishes + places, return_inverse=True)
        self.triples, self.at = np.unique(at * self.base + two, return_inverse=True)
        self.train = np.bincount(self.at[learned], minlength=len(self.triples))

    def edges(self) -> list[int]:
        """Where the triples of each partition begin."""
        of = self.part[self.pairs[self.triples // self.base] // self.n_dishes]
        return np.searchsorted(of, np.arange(self.some.start, self.some.stop + 1)).tolist()


PIECE = "part int, chunk long, ones binary, pairs_of_one binary, dish_at binary, dishes binary, languages binary, p binary, triples_of_pair binary, twos binary, train binary"


def _spread(x: np.ndarray) -> np.ndarray:
    """A one-to-one map of 64-bit numbers after which near ones lie far apart."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hashes of pairs of numbers."""
    step = np.uint64(0x9E3779B97F4A7C15)
    return _spread(_spread(a.astype(np.uint64) * step + step) + b.astype(np.uint64) * step)


def _grouped(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct id is found first, and for every row the number of its id."""
    _, first, at = np.unique(ids, return_index=True, return_inverse=True)
    return first.astype(np.int32), at.astype(np.int32)


def _in_one(guests: np.ndarray, tables: np.ndarray, all_guests: np.ndarray, all_tables: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Own part and factor of the probability in the language, of dishes in restaurants of one word before."""
    total = ONE_STRENGTH + all_guests
    return np.maximum(guests - ONE_DISCOUNT * tables, 0) / total, (ONE_STRENGTH + ONE_DISCOUNT * all_tables) / total


def _in_two(c: np.ndarray, t: np.ndarray, all_c: np.ndarray, all_t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Own part and factor of the probability after one word, of dishes in restaurants of two words before."""
    total = TWO_STRENGTH + all_c
    return np.maximum(c - TWO_DISCOUNT * t, 0) / total, (TWO_STRENGTH + TWO_DISCOUNT * all_t) / total


def seats_after_words(c: np.ndarray, pair: np.ndarray, two: np.ndarray, one: np.ndarray, p: np.ndarray, random: np.random.Generator):
    """Gibbs samples of the seating of restaurants of two words before (c >= 0 customers of each dish) and of one.

    ``pair`` numbers a dish's place in those of its parent, ``two`` its restaurant; ``one`` and ``p`` are the restaurant
    and the probability in the language of each dish of the parents. Yields (t, guests, tables): tables of the dishes, and
    customers and tables of the parents' dishes.
    """
    eaten = np.flatnonzero(c)
    many, t = eaten[c[eaten] > 1], (c > 0).astype(np.int64)
    n_two, n_one = int(two.max(initial=-1)) + 1, int(one.max(initial=-1)) + 1
    guests = np.bincount(pair, weights=t, minlength=len(one)).astype(np.int64)
    tables = (guests > 0).astype(np.int64)
    for i in range(BURN_IN + SAMPLES):
        own, factor = _in_one(guests, tables, *(np.bincount(one, weights=x, minlength=n_one)[one] for x in (guests, tables)))
        others = np.bincount(two, weights=t, minlength=n_two)[two[many]] - t[many]
        at = pair[many]
        t[many] = seat(c[many], own[at] + factor[at] * p[at], others, TWO_STRENGTH, TWO_DISCOUNT, random)
        guests = np.bincount(pair, weights=t, minlength=len(one)).astype(np.int64)
        tables = np.minimum(np.maximum(tables, guests > 0), guests)
        several = np.flatnonzero(guests > 1)
        others = np.bincount(one, weights=tables, minlength=n_one)[one[several]] - tables[several]
        tables[guests == 1] = 1
        tables[several] = seat(guests[several], p[several], others, ONE_STRENGTH, ONE_DISCOUNT, random)
        if i >= BURN_IN:
            yield t.astype(np.int32), guests, tables


def seated_after_words(c: np.ndarray, pair: np.ndarray, two: np.ndarray, one: np.ndarray, p: np.ndarray, random: np.random.Generator):
    """The samples of ``seats_after_words`` as (own, factor, tables): the probability of a dish is own plus factor times that in
    the language, its tables are those of the parents' dishes."""
    all_c = np.bincount(two, weights=c)[two]
    for t, guests, tables in seats_after_words(c, pair, two, one, p, random):
        own, factor = _in_one(guests, tables, *(np.bincount(one, weights=x)[one] for x in (guests, tables)))
        mine, back = _in_two(c, t, all_c, np.bincount(two, weights=t)[two])
        yield mine + back * own[pair], back * factor[pair], tables


# Seats as small numbers, a row of each kind after the other. ``triples`` has of every triple of a chunk its customers in the
# corpus less those of the chunk and those of its restaurant; then by sample customers less tables, of itself and of its
# restaurant. ``pairs`` and ``ones`` have by sample the customers of the pairs' dishes and of the restaurants of one word, and
# what these are more than the tables. Samples are steps from the first one. Rows without a chunk have the tables that go to a partition of words.
NEAR = "chunk long, part int, triples binary, pairs binary, ones binary, words binary, contexts binary, tables binary"


def _near(chunk=None, part=None, triples=None, pairs=None, ones=None, words=None, contexts_=None, tables=None) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32()] + [pa.binary()] * 6
    row = (chunk, part, triples, pairs, ones, words, contexts_, tables)
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], _names(NEAR))


def _steps(samples: list[np.ndarray]) -> list[np.ndarray]:
    """The first sample and how far the others are from it: 2 d, or -2 d - 1 for d < 0."""
    away = [x.astype(np.int64) - samples[0] for x in samples[1:]]
    return [samples[0], *[np.where(d < 0, -2 * d - 1, 2 * d) for d in away]]


def _from_steps(steps: np.ndarray, i: int) -> np.ndarray:
    """Sample i."""
    x = steps[i].astype(np.int64)
    return x if i == 0 else steps[0] + np.where(x & 1, -((x + 1) >> 1), x >> 1)


def _restaurants(one: np.ndarray, languages: np.ndarray) -> np.ndarray:
    """For each pair the number of its restaurant, among those of its word before and its dish's language in their order."""
    key = one.astype(np.int64) * CONTEXTS + languages
    return (np.cumsum(np.bincount(key) > 0) - 1)[key]


def _after_words(rows: list[dict], part: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Rows of NEAR for all pieces of a partition."""
    rows.sort(key=lambda r: r["chunk"])
    pairs, triples, n_pairs = [[] for _ in range(5)], [[] for _ in range(4)], 0
    chunks_ = [r["chunk"] for r in rows]
    places = []

    def whole(columns: list[list[np.ndarray]]) -> Iterator[np.ndarray]:
        # One column at a time stands twice in memory.
        while columns:
            yield np.concatenate(columns.pop(0))

    rows.reverse()
    while rows:
        r = rows.pop()
        ones, words, two = (_unpacked(r[k], "<u8") for k in ("ones", "dishes", "twos"))
        at, languages, p = _unpacked(r["dish_at"]), _unpacked(r["languages"], "u1"), _unpacked(r["p"], "<f4")
        of_one = np.repeat(np.arange(len(ones)), _unpacked(r["pairs_of_one"]))
        one = ones[of_one]
        id_, restaurant = _mixed(one, _mixed(words, languages)[at]), _mixed(one, languages[at])
        pair = np.repeat(np.arange(len(at), dtype=np.int32), _unpacked(r["triples_of_pair"]))
        new = _mixed(id_[pair], two), _mixed(restaurant[pair], two), pair + np.int32(n_pairs), _unpacked(r["train"])
        for column, x in zip([*triples, *pairs], [*new, id_, restaurant, words[at], languages[at], p[at]], strict=True):
            column.append(x)
        places.append(_restaurants(of_one, languages[at]).astype(np.int32))
        n_pairs += len(at)
    sizes = [len(x) for x in triples[0]]
    del new, pair, two
    id_, restaurant, word, language, p = whole(pairs)
    first, pair_at = _grouped(id_)
    one = _grouped(restaurant[first])[1]
    word, language, p = word[first], language[first], p[first].astype(np.float64)
    id_, restaurant, pair, train = whole(triples)
    first, at = _grouped(id_)
    two, pair = _grouped(restaurant[first])[1], pair_at[pair[first]]
    del id_, restaurant
    c = np.bincount(at, weights=train, minlength=len(first)).astype(np.int64)
    del first
    dish, of = _grouped(_mixed(word, language))
    samples, sent = [], []
    for t, guests, tables in seats_after_words(c, pair, two, one, p, np.random.default_rng([SEED, 1, part])):
        in_two, in_one, of_one = (np.bincount(x, weights=n) for x, n in ((two, t), (one, guests), (one, tables)))
        samples.append([x.astype(np.int32) for x in (t, in_two, guests, guests - tables, in_one, in_one - of_one)])
        sent.append(np.bincount(of, weights=tables, minlength=len(dish)).astype(np.int64))
    in_two, begin, low = np.bincount(two, weights=c).astype(np.int64), 0, 0
    for chunk, n, place in zip(chunks_, sizes, places, strict=True):
        mine, its = at[begin : begin + n], pair_at[low : low + len(place)]
        customers, everyone = c[mine], in_two[two[mine]]
        columns = [customers - train[begin : begin + n], everyone]
        columns += _steps([customers - x[0][mine] for x in samples]) + _steps([everyone - x[1][two[mine]] for x in samples])
        whose = np.empty(int(place.max()) + 1, np.int64)
        whose[place] = one[its]
        of_pairs, of_ones = ([_steps([x[k][i] for x in samples]) for k in ks] for i, ks in ((its, (2, 3)), (whose, (4, 5))))
        yield _near(chunk, part, *[_packed(np.concatenate(x)) for x in (columns, sum(of_pairs, []), sum(of_ones, []))])
        begin, low = begin + n, low + len(place)
    word, language, sent = word[dish], language[dish], np.stack(sent)
    to = (word & np.uint64((1 << bits) - 1)).astype(np.int64)
    for k in np.unique(to):
        some = np.flatnonzero((to == k) & (sent[0] > 0))
        if len(some):
            values = [_packed(word[some] >> np.uint64(bits)), _packed(language[some], "u1"), _packed(sent[:, some])]
            yield _near(None, int(k), None, None, None, *values)


# The answers to a chunk: kinds of their numbers, and how many there are of each thing.
ANSWERS = {
    "own": ("<f4", SAMPLES),
    "shared": ("<f4", SAMPLES),
    "uses": ("<u8", 1),
    "number": ("<u8", 1),
    "triples": ("<u4", 2 + 2 * SAMPLES),
    "pairs": ("<u4", 2 * SAMPLES),
    "ones": ("<u4", 2 * SAMPLES),
}


def _together(store: DataFrame, *replies: DataFrame) -> DataFrame:
    """Pieces of the answers to a chunk in one task, by part; a row without a part after them."""
    both = store.select("chunk", F.lit(None).cast("int").alias("part"))
    for x in replies:
        parts = x.filter("chunk IS NOT NULL").select("chunk", "part", *[c for c in ANSWERS if c in x.columns])
        both = both.unionByName(parts, allowMissingColumns=True)
    return both.repartition(max(1, store.count()), "chunk").sortWithinPartitions("chunk", F.col("part").asc_nulls_last())


def _whole(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[tuple[dict, dict[str, np.ndarray]]]:
    """Every stored row with the answers to it."""
    answers: dict[str, list[np.ndarray]] = {}
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if row["part"] is None:
                found = {k: np.concatenate(x, axis=1) for k, x in answers.items()}
                answers = {}
                yield _stored(folder, row["chunk"]) | {"chunk": row["chunk"]}, found
                del found
                continue
            for k, (kind, many) in ANSWERS.items():
                if row.get(k) is not None:
                    answers.setdefault(k, []).append(_unpacked(row[k], kind).reshape(many, -1))


def _in_languages(row: dict, found: dict[str, np.ndarray], sums: Sums) -> np.ndarray:
    languages, spelling = _dishes(row, "contexts", "spelling")
    return sums.probabilities(found["own"], found["shared"], languages, 10.0 ** spelling.astype(np.float64))


def _chances(asked: Asked, languages: np.ndarray, found: dict[str, np.ndarray], p: np.ndarray) -> np.ndarray:
    """Probabilities of a chunk's triples, given those of its dishes in their languages, averaged over samples."""
    pair = asked.triples // asked.base
    dish = asked.pairs % asked.n_dishes
    place = _restaurants(asked.pairs // asked.n_dishes, languages[dish])
    triples, pairs, ones = (found.pop(k) for k in ("triples", "pairs", "ones"))
    customers, everyone, total = triples[0] + asked.train, triples[1], np.zeros(len(pair))
    for i in range(SAMPLES):
        guests, everyone_one = _from_steps(pairs[:SAMPLES], i), _from_steps(ones[:SAMPLES], i)
        tables, tables_one = guests - _from_steps(pairs[SAMPLES:], i), everyone_one - _from_steps(ones[SAMPLES:], i)
        own, factor = _in_one(guests, tables, everyone_one[place], tables_one[place])
        own += factor * p[i, dish]
        mine, back = _in_two(
            customers, customers - _from_steps(triples[2 : 2 + SAMPLES], i), everyone, everyone - _from_steps(triples[2 + SAMPLES :], i)
        )
        back *= own[pair]
        total += mine
        total += back
    return total / SAMPLES


def after_words(scratch: Scratch, store: DataFrame, folder: str, replies: DataFrame, bits: int) -> DataFrame:
    """Samples the restaurants of preceding words, given the answers to words: rows of NEAR; written."""
    sums = Sums(replies)
    tokens = store.agg(F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, n: a + n))).first()[0] or 0
    parts = max(1, -(-tokens // PARTITION_TOKENS))

    def ask(some: range, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Spelling is over; the worker needs the memory.
        _models.clear()
        for row, found in _whole(batches, folder):
            p = _in_languages(row, found, sums).mean(axis=0)
            asked, languages, number = Asked(row, parts, some), _dishes(row, "contexts")[0], found["number"][0]
            numbers = np.append(number[asked.new], np.uint64(START))
            edges = asked.edges()
            for part, a, b in zip(some, edges, edges[1:], strict=False):
                if a == b:
                    continue
                pair = asked.triples[a:b] // asked.base
                of_pair = np.bincount(pair - pair[0])
                pairs = asked.pairs[pair[0] : pair[-1] + 1]
                ones, of_one = np.unique(pairs // asked.n_dishes, return_counts=True)
                dishes, dish_at = np.unique(pairs % asked.n_dishes, return_inverse=True)
                values = [_packed(numbers[ones], "<u8"), _packed(of_one), _packed(dish_at), _packed(number[dishes], "<u8")]
                values += [_packed(languages[dishes], "u1"), _packed(p[dishes], "<f4"), _packed(of_pair)]
                values += [_packed(numbers[asked.triples[a:b] % asked.base], "<u8"), _packed(asked.train[a:b])]
                arrays = [pa.array([part], pa.int32()), pa.array([row["chunk"]], pa.int64()), *[pa.array([x], pa.binary()) for x in values]]
                yield pa.RecordBatch.from_arrays(arrays, _names(PIECE))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _models.clear()
        by_part: dict[int, list[dict]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                by_part.setdefault(row["part"], []).append(row)
        for part in sorted(by_part):
            yield from _after_words(by_part.pop(part), part, bits)

    both, found = _together(store, replies), []
    borders = [parts * i // GOES for i in range(GOES + 1)]
    for some in map(range, borders, borders[1:]):
        if some:
            pieces_ = both.mapInArrow(partial(ask, some), PIECE).repartition(len(some), "part")
            found.append(scratch.written(pieces_.mapInArrow(answer, NEAR)))
            del pieces_
            scratch.sweep()
    return reduce(DataFrame.unionByName, found)


SCORES = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """Learns from the rows that are not held out and scores all. Per row: the columns of SCORES, ``id`` under its own name.

    ``n_tokens`` counts the words and the end of the text, ``n_known`` those found in training texts, ``train_tokens`` all
    training tokens. ``base_score`` is the sum of log10((c + 0.5) / (N + 0.5 (V + 1))) over tokens, ``score`` the model's
    log10 probability of the text. A null text is an empty one, which still has its end. Rows that repeat an id are rows of
    their own. Other columns are left out.
    """
    model, folder = fit(docs.filter(~held_out(id_)), text), fresh_path(docs.sparkSession, "chunks")
    store = chunks(docs, model, id_, text, folder)
    bits = _word_bits(store)
    last = Scratch(docs.sparkSession, "words")
    # Only the restaurants of preceding words ask for numbers, and only the scores for uses.
    replies = last.written(word_counts(store, bits).drop("uses"))
    last.sweep()
    for i in range(ROUNDS):
        scratch = Scratch(docs.sparkSession, "words")
        near = after_words(scratch, store, folder, replies, bits)
        last.drop()
        replies = word_counts(store, bits, near.filter("chunk IS NULL")).drop("number" if i == ROUNDS - 1 else "uses")
        last, replies = scratch, scratch.written(replies)
        last.sweep()
    sums = Sums(replies)
    rest, trained = sums.trained + 0.5 * (sums.words + 1), int(sums.trained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, found in _whole(batches, folder):
            p, uses, sizes = _in_languages(row, found, sums), found["uses"][0], np.array(row["n_tokens"], np.int64)
            del found["own"], found["shared"]
            asked = Asked(row)
            places, chance = asked.places, _chances(asked, _dishes(row, "contexts")[0], found, p)[asked.at]
            del asked
            starts = np.cumsum(sizes) - sizes
            columns = [
                pa.array(row["id"], pa.int64()),
                pa.array(row["held"], pa.bool_()),
                pa.array(sizes),
                pa.array(np.add.reduceat((uses > 0).astype(np.int64)[places], starts)),
                pa.array(np.full(len(sizes), trained, np.int64)),
                pa.array(np.add.reduceat(np.log10((uses + 0.5) / rest)[places], starts)),
                pa.array(np.add.reduceat(np.log10(chance), starts)),
            ]
            yield pa.RecordBatch.from_arrays(columns, _names(SCORES))

    return _together(store, replies, near).mapInArrow(run, SCORES).withColumnRenamed("id", id_)

"""Token-id tables: Parquet files that can be read selectively.

A file has one row per document: ``shard``, ``doc_id``, ``shard_start`` (ids of the shard before the document),
``n_tokens`` and ``tokens`` (a list column). Shards are ranges of doc_id, so files in the order of their shards hold the
documents in ascending order. Token lists are dictionary encoded (a vocabulary of 50,000 ids needs 16 bits at most), the
other columns delta encoded. Row groups and pages have stated sizes and page indexes are written, so a reader of some
documents or of the metadata alone skips the rest of the tokens.
"""

from __future__ import annotations

import os
import re
import string
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedkit.llm.text import pieces
from feedkit.operators.skew import join_on
from feedkit.session import fresh_path

END = 0
# Ids of a row group, and bytes of a page.
ROW_GROUP_TOKENS = 4_000_000
PAGE_BYTES = 256 << 10
# Distinct pieces whose ids a Python worker remembers, once more for those of the generation before.
CACHE_PIECES = 600_000

SCHEMA = "shard int, doc_id long, shard_start long, n_tokens long, tokens array<int>"
_FILE = pa.schema(
    [("shard", pa.int32()), ("doc_id", pa.int64()), ("shard_start", pa.int64()), ("n_tokens", pa.int64()), ("tokens", pa.list_(pa.int32()))]
)

# A place between a character that is surely no white space and a space or line feed. Byte-level BPE vocabularies of
# this kind never merge across it, because their pre-tokenizer lets no token go on from text into white space.
_BORDER = re.compile(r"(?<=[^\s\x1c-\x1f\x85\xa0\u180e\u200b\ufeff])(?=[ \n])")


class _Pieces(dict):
    """Packed ids by key; what is missing is encoded when it is asked for.

    A piece is known under a key: ``word`` for a word with a space before it, ``\\nword`` for one that begins a line,
    `` word`` for the first of a text, and two spaces and the piece for pieces of texts with any other white space. A key
    that begins with a zero character is punctuation behind a letter; no text that is split this way holds one.
    """

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.bpe = tokenizer, tokenizer.model.tokenize
        vocabulary = tokenizer.get_vocab()
        self.code = "H" if max(vocabulary.values()) < 1 << 16 else "I"
        # A word of letters, with or without a space before it, is one token of the pre-tokenizer, which writes bytes as
        # characters; so are a line feed before a word, and the punctuation behind its last letter.
        written = {c: "".join(t for t, _ in tokenizer.pre_tokenizer.pre_tokenize_str(c)) for c in map(chr, range(0x250))}
        self.letters = {b: x for c, out in written.items() for b, x in zip(c.encode(), out, strict=True)}
        self.space = self.letters[32]
        self.line = self.pack([vocabulary[self.letters[10]]])
        self.older: dict[str, bytes] = {}

    def pack(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def whole(self, text: str) -> bytes:
        return self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __missing__(self, key: str) -> bytes:
        ids = self.older.get(key)
        if ids is None:
            ids = self[key] = self.encoded(key)
        else:
            self[key] = ids
        return ids

    def encoded(self, key: str) -> bytes:
        if key[:1] == " " or not key:
            return self.whole(key[2:] if key[1:2] == " " else key[1:])
        core = key.rstrip(string.punctuation)
        if len(core) < len(key):
            if core[-1:].isalpha():
                return self[core] + self["\0" + key[len(core) :]]
            if core == "\0":
                return self.pack([t.id for t in self.bpe(key[1:].translate(self.letters))])
        word = key[1:] if key[0] == "\n" else key
        if word.isalpha() and max(word) < "\u0250":
            if not word.isascii():
                word = word.encode().decode("latin-1").translate(self.letters)
            if key[0] == "\n":
                return self.line + self.pack([t.id for t in self.bpe(word)])
            return self.pack([t.id for t in self.bpe(self.space + word)])
        return self.whole(key if key[0] == "\n" else " " + key)


class PieceEncoder:
    """Encodes whole texts by their pieces between white space, and remembers the ids of pieces.

    The ids are those the tokenizer gives the whole text: a piece begins where the pre-tokenizer begins a token in any
    case. Texts that hold the string of a special token are encoded as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = _Pieces(self.tokenizer)
        self.type = "<u2" if self.known.code == "H" else "<u4"

    def keys(self, text: str) -> list[str]:
        words = text.replace("\n", " \n").split(" ")
        # Other white space and control characters are not printable; runs of spaces leave empty words.
        if "" in words or "\n" in words or not text.replace("\n", "").isprintable():
            return ["  " + p for p in _BORDER.split(text)]
        words[0] = " " + words[0]
        return words

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, without special tokens added."""
        known = self.known
        if any(s in text for s in self.special):
            return np.frombuffer(known.whole(text), self.type)
        packed = b"".join(map(known.__getitem__, self.keys(text)))
        if len(known) > CACHE_PIECES:
            known.older = dict(known)
            known.clear()
        return np.frombuffer(packed, self.type)


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder per Python worker, kept over tasks."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def write_tokens(docs: DataFrame, tokenizer: str, folder: str | None = None, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes every whole text, ends it with id END and writes the files. Returns the manifest (shard, path, n).

    A null text is an empty one and has the end id alone. Rows that share a doc_id all stay, in the order of their
    texts' hashes; a null doc_id comes first. Other columns are left out. A shard is the file that one task writes. Every
    attempt of a task writes a file of its own, and the manifest, which Spark writes, names those that count.
    """
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "tokens")
    rows = docs.select(F.col(id_).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange(F.col("doc_id"), tie).sortWithinPartitions("doc_id", tie)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, shard = encoder(tokenizer).encode, np.array([END], np.uint16), TaskContext.get().partitionId()
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        name, writer, group, size, start = f"shard-{shard:07d}-{uuid.uuid4().hex}.parquet", None, [], 0, 0
        for batch in pieces(batches, "text"):
            ids = [x for t in batch.column("text").to_pylist() for x in (encode(t), end)]
            sizes = np.array([len(x) + 1 for x in ids[::2]], np.int64)
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(ids).astype(np.int32)))
            columns = [np.full(len(sizes), shard, np.int32), batch.column("doc_id"), start + offsets[:-1], sizes, lists]
            group.append(pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_FILE))
            start, size = start + int(offsets[-1]), size + int(offsets[-1])
            if writer is None:
                out = store.open_output_stream(f"{base}/{name}", compression=None)
                writer = _writer(out)
            if size >= ROW_GROUP_TOKENS:
                writer.write_table(pa.Table.from_batches(group), row_group_size=1 << 30)
                group, size = [], 0
        if writer is not None:
            if group:
                writer.write_table(pa.Table.from_batches(group), row_group_size=1 << 30)
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "path": [f"{folder}/{name}"], "n": [start]})

    manifest = f"{folder}/_manifest"
    ordered.mapInArrow(run, "shard int, path string, n long").write.parquet(manifest)
    return spark.read.schema("shard int, path string, n long").parquet(manifest)


def _writer(stream) -> pq.ParquetWriter:
    """Dictionary-encoded tokens, delta-encoded other columns, page indexes."""
    delta = {c: "DELTA_BINARY_PACKED" for c in _FILE.names if c != "tokens"}
    return pq.ParquetWriter(
        stream,
        _FILE,
        compression="zstd",
        use_dictionary=["tokens.list.element"],
        column_encoding=delta,
        data_page_size=PAGE_BYTES,
        write_page_index=True,
    )


def read_tokens(manifest: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The rows of the files, or some columns of them; Parquet reads only those. The driver holds the files' names."""
    spark = manifest.sparkSession
    paths = [r["path"] for r in manifest.select("path").collect()]
    files = spark.read.schema(SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], SCHEMA)
    return files.select(*columns) if columns else files


def shard_offsets(manifest: DataFrame) -> DataFrame:
    """Rows (at, base): ids of all shards before each one. One row per file."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.select(F.col("shard").alias("at"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def token_digests(manifest: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("tokens")
            flat = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4")
            at = lists.offsets.to_numpy()
            crc = [zlib.crc32(flat[a:b].data) for a, b in zip(at, at[1:], strict=False)]
            kept = [batch.column(c) for c in ("shard", "doc_id", "shard_start")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())],
                ["shard", "doc_id", "shard_start", "n_tokens", "ids_crc32"],
            )

    read = read_tokens(manifest, ["shard", "doc_id", "shard_start", "tokens"])
    rows = read.mapInArrow(digest, "shard int, doc_id long, shard_start long, n_tokens long, ids_crc32 long")
    placed = join_on(rows, shard_offsets(manifest), {"shard": "at"})
    return placed.select("doc_id", (F.col("base") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32")

"""Token files against the tokenizer on whole texts, and their layout."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from feedkit.llm import tokens
from feedkit.llm.queries import QUERIES, TOKENIZER

ODD = ["", "a", " a", "a  b", "a \n b", "a\n\n b ", "it's we'll  'd", "<|endoftext|> x", "\t a", "!!\n!! ...,", "A.B., c", "é,\xa0b"]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_pieces_encode_like_whole_texts(plain, spark, sf_dir):
    random.seed(3)
    alphabet = list("ab1!'s,. \n\t\r\x00\x1c\x1f\x85\xa0᠎​　﻿é😀Я_")
    texts = ODD + ["".join(random.choices(alphabet, k=random.randint(1, 30))) for _ in range(5000)]
    texts += [r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    ours = tokens.PieceEncoder(TOKENIZER)
    for text in texts:
        assert ours.encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_a_small_memory_gives_the_same_ids(plain, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 3)
    ours = tokens.PieceEncoder(TOKENIZER)
    for text in ["one two three, four five!", "one two! six seven", "three, four"] * 2:
        assert ours.encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_query_against_brute_force(plain, spark, sf_dir):
    texts = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    want, start = [], 0
    for doc, text in texts:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = QUERIES["op1_token_output"](spark, sf_dir).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == want


def test_awkward_rows(spark, small, plain):
    docs = small.withColumnRenamed("n_chars", "tokens").repartition(3)
    manifest = tokens.write_tokens(docs, TOKENIZER)
    rows = tokens.read_tokens(manifest).orderBy("shard", "shard_start").collect()
    assert [r["doc_id"] for r in rows] == [None, 1, 2, 3, 4, 5, 6, 6, 8]
    assert [r["tokens"] for r in rows[2:4]] == [[0], [0]]
    assert rows[-1]["tokens"][:-1] == plain.encode("x" * 50_000 + " " + "long " * 20_000, add_special_tokens=False).ids
    digests = tokens.token_digests(manifest).orderBy("start").collect()
    assert [d["start"] for d in digests] == np.cumsum([0] + [len(r["tokens"]) for r in rows[:-1]]).tolist()
    empty = tokens.write_tokens(small.limit(0), TOKENIZER)
    assert tokens.token_digests(empty).count() == 0


def test_files_allow_selective_reads(spark, sf_dir):
    manifest = tokens.write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), TOKENIZER)
    path = manifest.first()["path"].removeprefix("file:")
    group = pq.ParquetFile(path).metadata.row_group(0)
    columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert "RLE_DICTIONARY" in columns["tokens.list.element"].encodings
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert all(c.has_offset_index and c.has_column_index for c in columns.values())
    plan = tokens.read_tokens(manifest, ["doc_id", "n_tokens"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,n_tokens:bigint>" in plan

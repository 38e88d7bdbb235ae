"""Token files: exact round trips, order, places and partial reads."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
import pytest
from fixtures import awkward_texts, documents, words
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from eventlens.llm import packing
from eventlens.llm import token_blocks as T
from eventlens.session import scratch_path


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 40), st.integers(0, 49_407), st.integers(0, 2**32 - 1)), min_size=1, max_size=400))
def test_blocks_round_trip(ids):
    ids = np.array(ids, np.uint32)
    packed, starts = T.pack_blocks(ids)
    assert (T.unpack_blocks(packed.tobytes(), starts)[: len(ids)] == ids).all() and len(starts) == -(-len(ids) // T.BLOCK)


def test_few_large_ids_are_patches():
    ids = np.array([5, 6, 7, 8] * 32, np.uint32)
    ids[17] = 4_000_000_000
    packed, _ = T.pack_blocks(ids)
    assert len(packed) == 6 + 16 * 2 + 5


@pytest.mark.parametrize("width", range(33))
def test_every_width(width):
    ids = np.random.default_rng(width).integers(0, 2**width, 5 * T.BLOCK + 7, dtype=np.uint64).astype(np.uint32)
    ids[:: T.BLOCK], ids[1 :: T.BLOCK] = 0, 2**width - 1
    packed, starts = T.pack_blocks(ids)
    assert (T.unpack_blocks(packed.tobytes(), starts)[: len(ids)] == ids).all()


def test_packed_bits_are_laid_out_as_said():
    ids = np.arange(1000, 1000 + T.BLOCK, dtype=np.uint32)
    packed, _ = T.pack_blocks(ids)
    bits = "".join(f"{b:08b}"[::-1] for b in packed.tobytes()[6:])
    assert packed.tobytes()[:6] == (1000).to_bytes(4, "little") + bytes([7, 0])
    assert [int(bits[7 * i : 7 * i + 7][::-1], 2) for i in range(T.BLOCK)] == list(range(T.BLOCK))


def expected(rows):
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    coded = [(i, np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [T.END_ID], "<u4")) for i, t in rows]
    out, at = [], 0
    for i, ids in coded:
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def key(r):
    return (r[0] is not None, r[0], r[1])


@pytest.mark.parametrize("file_ids", [T.FILE_IDS, 100])
def test_awkward_documents(spark, file_ids):
    rows = awkward_texts()
    path = scratch_path(spark, "tokens")
    T.write_tokens(documents(spark, rows), path, file_ids)
    got = sorted((tuple(r) for r in T.read_tokens(spark, path, "digest").selectExpr("cast(doc_id as long)", "start", "n_tokens", "ids_crc32").collect()), key=key)
    ids = {(i, n, c) for i, _, n, c in expected(rows)}
    assert {(i, n, c) for i, _, n, c in got} == ids and len(got) == len(rows)
    at = 0
    for _, start, n, _ in got:
        assert start == at
        at += n
    full = T.read_tokens(spark, path).collect()
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["n_tokens"] for r in full)
    skipped = T.read_tokens(spark, path, "skip").filter("doc_id = '17'").collect()
    assert len(skipped) == 1 and skipped[0]["ids"] is None and skipped[0]["n_tokens"] == [n for i, _, n, _ in got if i == 17][0]
    wanted = T.read_tokens(spark, path).filter("doc_id in ('17', '30')")
    assert sorted((int(r["doc_id"]), r["start"]) for r in wanted.collect()) == [(i, s) for i, s, _, _ in got if i in (17, 30)]


def test_query_on_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = sorted((tuple(r) for r in T.token_round_trip(docs).collect()), key=key)
    assert got == expected(sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()))


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id string, text string")
    assert T.token_round_trip(none).collect() == []


def test_a_span_reads_its_blocks_only(spark, monkeypatch):
    path = scratch_path(spark, "tokens")
    T.write_tokens(documents(spark, [(1, words(random.Random(2), 60_000, 5000))]), path)
    fs, root = T.filesystem(path)
    (name,) = [x.path for x in fs.get_file_info(pafs.FileSelector(root)) if x.path.endswith(".tkb")]
    with fs.open_input_file(name) as f:
        file, reads = T.OpenFile(f), []
        whole = np.concatenate(list(file.span(0, file.n_ids)))
        read = file._read
        monkeypatch.setattr(file, "_read", lambda at, size: reads.append(size) or read(at, size))
        (part,) = file.span(1000, 1300)
        assert (part == whole[1000:1300]).all() and sum(reads) < 4 * 600


def test_ids_of_any_coding_are_written(spark):
    path = scratch_path(spark, "tokens")
    rows = [("a", bytearray(np.array([7, 2**32 - 1, 0], "<u4").tobytes())), ("b", bytearray()), (None, bytearray(np.arange(1000, dtype="<u4").tobytes()))]
    T.register(spark)
    spark.createDataFrame(rows, "doc_id string, ids binary").coalesce(1).write.format("token_blocks").mode("append").save(path)
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids"]) for r in T.read_tokens(spark, path).collect()}
    assert got["a"] == (0, 3, [7, 2**32 - 1, 0]) and got["b"][:2] == (3, 0) and got[None] == (3, 1000, list(range(1000)))


@pytest.mark.parametrize("at_once", [packing._WORDS, 3])
def test_texts_coded_together(monkeypatch, at_once):
    monkeypatch.setattr(packing, "_WORDS", at_once)
    texts = [t for _, t in awkward_texts()] + [None, "", " \t\n", "\n a  b\x0b\x0cc \r", "It's WE'LL 'S 12a\"'s", "<|endoftext|> x<|startoftext|>y z", "é É e\u0301 ŒUVRE İ ß", "a\x1cb\u00a0c\u2028d", "日本 語 日本"]
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    expected = [tokenizer.encode(t or "", add_special_tokens=False).ids + [7] for t in texts]
    coder = packing.WordIds(packing.VOCABULARY)
    for given in (pa.array(texts), pa.array([t if t is None else t.encode() for t in texts], pa.binary()), pa.array(["x", *texts, "y"]).slice(1, len(texts))):
        assert [x.tolist() for x in coder.encode_all(given, 7)] == expected
    assert list(coder.encode_all(pa.array([], pa.string()), 7)) == []


def test_a_word_is_coded_once_for_many_rows(spark, monkeypatch):
    """In batches of 256 rows, words of all rows are still coded together."""
    asked = []
    coder = packing.WordIds(packing.VOCABULARY)
    distinct = coder._distinct
    monkeypatch.setattr(coder, "_distinct", lambda words: asked.extend(words.to_pylist()) or distinct(words))
    monkeypatch.setitem(packing._LOADED, packing.VOCABULARY, coder)
    rows = pa.RecordBatch.from_pydict({"doc_id": [str(i) for i in range(1000)], "text": [f"some words of row{i % 7}, again".encode() for i in range(1000)]})
    path = scratch_path(spark, "tokens")
    monkeypatch.setattr(T.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    T.BlockWriter({"path": path}).write(iter([rows.slice(i, 256) for i in range(0, 1000, 256)]))
    assert sorted(asked) == sorted(["some", "words", "of", "again", *[f"row{i}," for i in range(7)]])

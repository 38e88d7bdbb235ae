"""Token ids in files of patched frame-of-reference blocks.

A block of ``BLOCK`` ids stores its least id and, bit-packed, what each id has
above it, at the width that ``PERCENTILE`` per cent of the block's values fit;
the higher bits of the few that do not are patches (position and bits) beside
the block.  A file is

    magic
    blocks   least u32, width u8, patches u8, then 16 * width bytes of packed
             values (bit 0 first) and, a patch each, position u8 and bits u32
    index    u64 start of every block
    documents  u32 number of ids of every document
    names    u32 end of every document id's text, then the texts (UTF-8); a
             null id has no text and bit 31 of its end set
    footer   u64 places of index, documents and names, u64 numbers of ids and
             of documents, magic

all little-endian.  The last block is padded with its least id; the footer
knows how many ids are real.  Ids a..b are had by reading the blocks that hold
them and no others.

``format("token_blocks")`` is a Spark data source.  Writing: each task writes
its rows (doc_id and ids of 32 bits each, or doc_id and text, which it codes) in
the order they come, closing a file at the document that reaches ``FILE_IDS``
ids; the driver commits by a manifest that lists the files in task
order with the ids and documents before each, so files of failed or repeated
attempts are never read.  Reading: a partition per file, a document at a time;
``ids`` = ``full`` (default), ``digest`` (no ids; the CRC-32 is taken block by
block) or ``skip`` (index only).  ``doc_id`` predicates are pushed down: blocks
without wanted documents are not read.

Edge cases: null and empty texts are the end id alone; null ids come first;
rows of a repeated id are documents of their own, in order of their texts; a
document of any length is packed block by block as the file's other ids are; an
empty table gives files without documents and an empty result; other columns
are ignored.  Ids must be below 2^32.
"""

from __future__ import annotations

import json
import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from eventlens.llm.common import small_batches, text_or_empty, width
from eventlens.llm.packing import VOCABULARY, word_ids
from eventlens.llm.warc import filesystem
from eventlens.session import scratch_path

BLOCK, PERCENTILE = 128, 90
END_ID = 2
MAGIC = b"TKBLOCK1"
MANIFEST = "_manifest.json"
#: A file is closed at the document that reaches so many ids.
FILE_IDS = 16 << 20
#: Blocks packed, or read, at once.
_AT_ONCE = 4096
#: Bytes of rows that a task codes together.
_BYTES = 8 << 20
_HEAD, _FOOT = np.dtype([("least", "<u4"), ("width", "u1"), ("patches", "u1")]), struct.Struct("<QQQQQ8s")
_PATCH = np.dtype([("at", "u1"), ("bits", "<u4")])
_NULL = 1 << 31
SCHEMA = "doc_id string, start long, n_tokens long, ids_crc32 long, ids array<long>"


def _spread(at: np.ndarray, size: int) -> np.ndarray:
    """Places ``at`` to ``at + size`` of every row."""
    return at[:, None] + np.arange(size)


def pack_blocks(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of ``ids`` (unsigned 32-bit), the last one padded with its least
    id: their bytes, and where each begins."""
    whole, left = divmod(len(ids), BLOCK)
    blocks = ids[: whole * BLOCK].reshape(whole, BLOCK)
    if left:
        tail = ids[whole * BLOCK :]
        blocks = np.vstack([blocks, np.concatenate([tail, np.full(BLOCK - left, tail.min(), ids.dtype)])[None]])
    least = blocks.min(axis=1)
    above = (blocks - least[:, None]).astype(np.uint32)
    nth = -(-PERCENTILE * (BLOCK - 1) // 100)
    widths = np.frexp(np.partition(above, nth, axis=1)[:, nth].astype(np.float64))[1].astype(np.int64)
    rows, places = np.nonzero(above > ((1 << widths) - 1).astype(np.uint32)[:, None])
    patches = np.bincount(rows, minlength=len(blocks))
    starts = np.concatenate([[0], np.cumsum(_HEAD.itemsize + BLOCK // 8 * widths + _PATCH.itemsize * patches)])
    out = np.empty(starts[-1], np.uint8)
    heads = np.empty(len(blocks), _HEAD)
    heads["least"], heads["width"], heads["patches"] = least, widths, patches
    out[_spread(starts[:-1], _HEAD.itemsize)] = heads.view(np.uint8).reshape(len(blocks), -1)
    for w in np.unique(widths):
        same = np.flatnonzero(widths == w)
        low = _pack(above[same], int(w))
        out[_spread(starts[same] + _HEAD.itemsize, low.shape[1])] = low
    if len(rows):
        patch = np.empty(len(rows), _PATCH)
        patch["at"], patch["bits"] = places, above[rows, places] >> widths[rows].astype(np.uint32)
        nth_of_block = np.arange(len(rows)) - np.concatenate([[0], np.cumsum(patches)])[rows]
        at = starts[rows] + _HEAD.itemsize + BLOCK // 8 * widths[rows] + _PATCH.itemsize * nth_of_block
        out[_spread(at, _PATCH.itemsize)] = patch.view(np.uint8).reshape(len(rows), -1)
    return out, starts[:-1]


def _pack(values: np.ndarray, w: int) -> np.ndarray:
    """The low ``w`` bits of a block's values, one after another, as bytes of rows."""
    words = np.zeros((BLOCK * w // 64 + 1, len(values)), np.uint64)
    columns = (values & np.uint32((1 << w) - 1)).T.astype(np.uint64)
    for i in range(BLOCK if w else 0):
        word, bit = divmod(i * w, 64)
        words[word] |= columns[i] << np.uint64(bit)
        if bit + w > 64:
            words[word + 1] |= columns[i] >> np.uint64(64 - bit)
    return np.ascontiguousarray(words[:-1].T).astype("<u8").view(np.uint8)


def unpack_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of blocks that begin at ``starts`` of ``data``."""
    raw, starts = np.frombuffer(data, np.uint8), np.asarray(starts)
    heads = raw[_spread(starts, _HEAD.itemsize)].view(_HEAD)[:, 0]
    widths, patches = heads["width"].astype(np.int64), heads["patches"].astype(np.int64)
    ids = np.empty((len(starts), BLOCK), np.uint32)
    for w in np.unique(widths):
        same = np.flatnonzero(widths == w)
        ids[same] = _unpack(raw[_spread(starts[same] + _HEAD.itemsize, BLOCK // 8 * int(w))], int(w))
    rows = np.repeat(np.arange(len(starts)), patches)
    if len(rows):
        nth_of_block = np.arange(len(rows)) - np.concatenate([[0], np.cumsum(patches)])[rows]
        at = starts[rows] + _HEAD.itemsize + BLOCK // 8 * widths[rows] + _PATCH.itemsize * nth_of_block
        patch = raw[_spread(at, _PATCH.itemsize)].view(_PATCH)[:, 0]
        ids[rows, patch["at"]] |= patch["bits"] << widths[rows].astype(np.uint32)
    ids += heads["least"][:, None]
    return ids.ravel()


def _unpack(low: np.ndarray, w: int) -> np.ndarray:
    """Rows of values from the bytes of ``_pack``."""
    out = np.zeros((BLOCK, len(low)), np.uint32)
    words = np.ascontiguousarray(np.ascontiguousarray(low).view("<u8").T) if w else None
    for i in range(BLOCK if w else 0):
        word, bit = divmod(i * w, 64)
        value = words[word] >> np.uint64(bit)
        if bit + w > 64:
            value |= words[word + 1] << np.uint64(64 - bit)
        out[i] = value & np.uint64((1 << w) - 1)
    return out.T


class _File:
    """A file being written: blocks go out as they fill."""

    def __init__(self, fs: pafs.FileSystem, root: str, name: str):
        self.name, self.out, self.at = name, fs.open_output_stream(posixpath.join(root, name), compression=None), 0
        self.starts: list[int] = []
        self.lengths: list[int] = []
        self.names: list[bytes | None] = []
        self.held: list[np.ndarray] = []
        self.waiting, self.ids = 0, 0
        self._write(MAGIC)

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, name: str | None, ids: np.ndarray) -> None:
        self.names.append(None if name is None else name.encode())
        self.lengths.append(len(ids))
        self.held.append(ids)
        self.waiting, self.ids = self.waiting + len(ids), self.ids + len(ids)
        if self.waiting >= _AT_ONCE * BLOCK:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.empty(0, np.uint32)
        ready = len(ids) if last else len(ids) // BLOCK * BLOCK
        for at in range(0, ready, _AT_ONCE * BLOCK):
            packed, starts = pack_blocks(ids[at : min(at + _AT_ONCE * BLOCK, ready)])
            self.starts += (self.at + starts).tolist()
            self._write(packed.tobytes())
        self.held, self.waiting = [ids[ready:].copy()], len(ids) - ready

    def close(self) -> dict:
        self._flush(True)
        index = self.at
        self._write(np.array(self.starts, "<u8").tobytes())
        documents = self.at
        self._write(np.array(self.lengths, "<u4").tobytes())
        names, ends, end = self.at, [], 0
        for x in self.names:
            end += len(x or b"")
            ends.append(end | (_NULL if x is None else 0))
        self._write(np.array(ends, "<u4").tobytes() + b"".join([x for x in self.names if x]))
        self._write(_FOOT.pack(index, documents, names, self.ids, len(self.lengths), MAGIC))
        self.out.close()
        return {"file": self.name, "ids": self.ids, "documents": len(self.lengths)}


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring batches as one of ``_BYTES`` at most, unless one has more:
    the more words are coded together, the fewer of them are distinct."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.nbytes > _BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.concat_batches(held)


class Written(WriterCommitMessage):
    def __init__(self, task: int, files: list[dict]):
        self.task, self.files = task, files


class BlockWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.file_ids = options["path"], int(options.get("file_ids", FILE_IDS))
        self.vocabulary, self.end_id = options.get("vocabulary", VOCABULARY), int(options.get("end_id", END_ID))

    def _coded(self, batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        if "ids" in batch.schema.names:
            return (np.frombuffer(ids.as_py(), "<u4") for ids in batch.column("ids"))
        return word_ids(self.vocabulary).encode_all(batch.column("text"), self.end_id)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = filesystem(self.path)
        fs.create_dir(root, recursive=True)
        done, now = [], None
        for batch in _gathered(iterator):
            for name, ids in zip(batch.column("doc_id"), self._coded(batch), strict=True):
                now = now or _File(fs, root, f"part-{uuid.uuid4().hex}.tkb")
                now.add(name.as_py(), ids)
                if now.ids >= self.file_ids:
                    done, now = [*done, now.close()], None
        if now:
            done.append(now.close())
        return Written(TaskContext.get().partitionId(), done)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = filesystem(self.path)
        fs.create_dir(root, recursive=True)
        before, files = 0, []
        for f in (f for m in sorted((m for m in messages if m), key=lambda m: m.task) for f in m.files):
            files.append({**f, "ids_before": before})
            before += f["ids"]
        with fs.open_output_stream(posixpath.join(root, MANIFEST), compression=None) as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = filesystem(self.path)
        for f in (f for m in messages if m for f in m.files):
            fs.delete_file(posixpath.join(root, f["file"]))


class OpenFile:
    """A file's footer, index and documents; its ids by block."""

    def __init__(self, f: pa.NativeFile):
        self.f, size = f, f.size()
        index, documents, names, self.n_ids, self.n_documents, magic = _FOOT.unpack(self._read(size - _FOOT.size, _FOOT.size))
        if magic != MAGIC:
            raise ValueError("not a file of token blocks")
        self.starts = np.frombuffer(self._read(index, documents - index), "<u8").tolist() + [index]
        self.lengths = np.frombuffer(self._read(documents, names - documents), "<u4").astype(np.int64)
        self.firsts = np.concatenate([[0], np.cumsum(self.lengths)]).tolist()
        said = self._read(names, size - _FOOT.size - names)
        ends = np.frombuffer(said, "<u4", self.n_documents)
        texts, at = said[4 * self.n_documents :], 0
        self.names: list[str | None] = []
        for end in ends.tolist():
            to = end & ~_NULL
            self.names.append(None if end & _NULL else texts[at:to].decode())
            at = to

    def _read(self, at: int, size: int) -> bytes:
        self.f.seek(at)
        return self.f.read(size)

    def span(self, start: int, stop: int) -> Iterator[np.ndarray]:
        """Ids ``start`` to ``stop`` of the file, from the blocks that hold them."""
        at = start // BLOCK
        while at * BLOCK < stop:
            to = min(at + _AT_ONCE, -(-stop // BLOCK))
            data = self._read(self.starts[at], self.starts[to] - self.starts[at])
            ids = unpack_blocks(data, np.array(self.starts[at:to]) - self.starts[at])
            yield ids[max(start - at * BLOCK, 0) : stop - at * BLOCK]
            at = to


class Piece(InputPartition):
    def __init__(self, path: str, before: int):
        super().__init__(path)
        self.path, self.before = path, before


class BlockReader(DataSourceReader):
    def __init__(self, path: str, ids: str):
        self.path, self.ids = path, ids
        self.wanted: list[frozenset] = []

    def pushFilters(self, filters: list) -> Iterator:
        for f in filters:
            if isinstance(f, (EqualTo, In)) and tuple(f.attribute) == ("doc_id",):
                self.wanted.append(frozenset([f.value] if isinstance(f, EqualTo) else f.value))
            else:
                yield f

    def partitions(self) -> list[Piece]:
        fs, root = filesystem(self.path)
        with fs.open_input_stream(posixpath.join(root, MANIFEST), compression=None) as f:
            files = json.loads(f.read())
        return [Piece(posixpath.join(root, x["file"]), x["ids_before"]) for x in files] or [Piece("", 0)]

    def read(self, part: Piece) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        fs, _ = filesystem(self.path)
        with fs.open_input_file(part.path) as f:
            rows, held = [], 0
            for row in self._documents(OpenFile(f), part.before):
                rows.append(row)
                held += len(row[4]) if row[4] is not None else 0
                if len(rows) >= 4096 or held >= 1 << 20:
                    yield self._batch(rows)
                    rows, held = [], 0
            if rows:
                yield self._batch(rows)

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32", "ids"])

    def _documents(self, file: OpenFile, before: int) -> Iterator[tuple]:
        """Neighbouring documents share blocks, so the last blocks read are kept."""
        held, held_from, coming, fed = np.empty(0, np.uint32), 0, None, None
        for name, first, length in zip(file.names, file.firsts, file.lengths.tolist(), strict=False):
            if any(name not in w for w in self.wanted):
                continue
            crc, parts = 0, []
            at, stop = first, first + length
            while at < stop and self.ids != "skip":
                if not held_from <= at < held_from + len(held):
                    if coming is None or fed != at:
                        coming, fed = file.span(at, file.n_ids), at
                    held, held_from = next(coming), fed
                    fed += len(held)
                cut = held[at - held_from : stop - held_from]
                crc = zlib.crc32(np.ascontiguousarray(cut, "<u4"), crc)
                if self.ids == "full":
                    parts.append(cut)
                at += len(cut)
            ids = np.concatenate(parts).astype(np.int64) if parts else None
            yield name, before + first, length, None if self.ids == "skip" else crc, ids


class TokenBlocks(DataSource):
    @classmethod
    def name(cls) -> str:
        return "token_blocks"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> BlockReader:
        return BlockReader(self.options["path"], self.options.get("ids", "full"))

    def writer(self, schema: StructType, overwrite: bool) -> BlockWriter:
        return BlockWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TokenBlocks)


def write_tokens(docs: DataFrame, path: str, file_ids: int = FILE_IDS, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> None:
    """Write the ids of the whole texts, each with the end id, in ascending
    order of doc_id.  Texts are dealt by ranges of doc_id and coded where they
    are written, so ids never leave the task that packs them."""
    spark = docs.sparkSession
    register(spark)
    small_batches(spark)
    rows = docs.select("doc_id", F.encode(text_or_empty(), "UTF-8").alias("text"))
    order = [F.col("doc_id").asc(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(width(spark), *order).sortWithinPartitions(*order, "text")
    writer = dealt.select(F.col("doc_id").cast("string").alias("doc_id"), "text").write.format("token_blocks")
    writer.options(file_ids=file_ids, vocabulary=vocabulary, end_id=end_id).mode("append").save(path)


def read_tokens(spark: SparkSession, path: str, ids: str = "full") -> DataFrame:
    register(spark)
    return spark.read.format("token_blocks").option("ids", ids).load(path)


def token_round_trip(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write all documents' ids, read the files back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    write_tokens(docs, path, **options)
    kind = docs.schema["doc_id"].dataType
    back = read_tokens(spark, path, "digest")
    return back.select(F.col("doc_id").cast(kind).alias("doc_id"), "start", "n_tokens", "ids_crc32")

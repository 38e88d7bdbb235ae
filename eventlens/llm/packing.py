"""Packing tokenised documents into sequences by cutting-stock column generation.

A document of L tokens is cut into L // capacity whole sequences and one
remainder.  Piece lengths are rounded up to classes of ``GRAIN`` tokens; the
histogram of classes (bounded by capacity / GRAIN rows, whatever the corpus)
goes to the driver, where ``cutting_stock.plan`` solves the linear program
over patterns, its columns priced by a knapsack dynamic program, and rounds
the pattern counts.  The rounded plan is a short table of rank ranges; every
piece is ranked within its class in two levels (inside one of many parts, plus
the part's first rank), so no class is ever counted through in one task, and
finds its sequence by a broadcast of that bounded table.

Tokenisation is per white-space word with a bounded memory of words and of
their pieces: the vocabulary's rules never join tokens across white space, so
the ids are those of the whole text (tested).

Edge cases: null or empty texts are the end id alone; rows of a repeated
``doc_id`` are packed as documents of their own; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlens.llm.common import small_batches, text_or_empty, width
from eventlens.llm.cutting_stock import plan
from eventlens.session import materialize

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 2048
END_ID = 1
GRAIN = 8

#: Words, and pieces of words, whose ids a worker remembers.
_REMEMBERED = 400_000
_LOADED: dict = {}

#: Words of these letters only are cut here by the vocabulary's own rules
#: (fixed pattern): composed characters whose lower case is one character.
_PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017e]+")
_PLAIN_LINES = re.compile("[\n!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017e]*")
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u017e]+|[0-9]|\n|[^a-z\u00df-\u00f6\u00f8-\u017e0-9\n]+")
#: The only id of a line break, which stands between words that are coded together.
_BREAK = 0xFFFFFFFF
#: Words of a text whose ids are put together at once.
_WORDS = 1 << 18

#: The rules of the vocabularies that words may be cut for (fixed values).
RULES = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary:
    printable Latin-1 as itself, the others from U+0100 in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in shown}
    letters |= {b: chr(0x100 + i) for i, b in enumerate(x for x in range(256) if x not in letters)}
    return [letters[b] for b in range(256)]


class PieceIds(dict):
    """Lower-case piece of a word -> its ids as little-endian 32-bit integers."""

    def __init__(self, model):
        super().__init__()
        self.model, self.letters = model, _byte_letters()

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= _REMEMBERED:
            self.clear()
        if piece == "\n":
            found = [_BREAK]
        else:
            shown = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
            found = [t.id for t in self.model.tokenize(shown)]
        ids = self[piece] = array("I", found).tobytes()
        return ids


class WordIds(dict):
    """White-space word (UTF-8) -> its ids as little-endian 32-bit integers.

    A word of plain letters is cut into pieces here and each piece coded once;
    any other word goes through the whole tokenizer."""

    def __init__(self, vocabulary: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        path = vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary)
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        if any(said.get(k) != v for k, v in RULES.items()):
            raise ValueError(f"{vocabulary}: words cannot be coded one by one under its rules")
        self.tokenizer = Tokenizer.from_file(str(path))
        self.pieces = PieceIds(self.tokenizer.model)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= _REMEMBERED:
            self.clear()
        if word.isalpha():
            ids = self.pieces[word.lower().decode()]
        else:
            text = word.decode()
            if _PLAIN.fullmatch(text) and not any(s in text for s in self.special):
                ids = b"".join(map(self.pieces.__getitem__, _PIECES.findall(text.lower())))
            else:
                ids = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        self[word] = ids
        return ids

    def encode(self, text: bytes | None) -> bytes:
        return b"".join(map(self.__getitem__, (text or b"").split()))

    def encode_all(self, texts: pa.Array, end_id: int) -> Iterator[np.ndarray]:
        """The ids of every text, ``end_id`` last; what ``encode`` gives, but
        each of the texts' distinct words is coded once."""
        words = pc.ascii_split_whitespace(texts.cast(pa.large_string() if pa.types.is_large_binary(texts.type) else pa.string()).fill_null(""))
        place = words.flatten().dictionary_encode()
        at, ends = place.indices.to_numpy(), np.cumsum(pc.list_value_length(words).to_numpy()).tolist()
        ids, first, n = self._distinct(place.dictionary)
        start, end = 0, np.array([end_id], "<u4")
        for stop in ends:
            parts = []
            for i in range(start, stop, _WORDS):
                mine = at[i : min(i + _WORDS, stop)]
                to = np.cumsum(n[mine])
                parts.append(ids[np.arange(to[-1]) + np.repeat(first[mine] + n[mine] - to, n[mine])])
            yield np.concatenate([*parts, end])
            start = stop

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where in them each word's begin and how many it has."""
        text = pc.binary_join(pa.LargeListArray.from_arrays([0, len(words)], words), "\n")[0].as_py()
        held = [s for s in self.special if s in text]
        odd = []
        if held or not _PLAIN_LINES.fullmatch(text):
            lines = text.split("\n")
            odd = [i for i, w in enumerate(lines) if w and not (_PLAIN.fullmatch(w) and not any(s in w for s in held))]
            whole = [np.frombuffer(self[lines[i].encode()], "<u4") for i in odd]
            for i in odd:
                lines[i] = ""
            text = "\n".join(lines)
        coded = np.frombuffer(b"".join(map(self.pieces.__getitem__, _PIECES.findall(text.lower()))), "<u4")
        breaks = np.flatnonzero(coded == _BREAK)
        ids = coded[coded != _BREAK]
        bounds = np.concatenate([[0], breaks - np.arange(len(breaks)), [len(ids)]])
        first, n = bounds[:-1], np.diff(bounds)
        if odd:
            n[odd] = [len(x) for x in whole]
            first[odd] = len(ids) + np.cumsum(n[odd]) - n[odd]
            ids = np.concatenate([ids, *whole])
        return ids, first, n


def word_ids(vocabulary: str) -> WordIds:
    if vocabulary not in _LOADED:
        _LOADED[vocabulary] = WordIds(vocabulary)
    return _LOADED[vocabulary]


def _cutter(vocabulary: str, capacity: int, end_id: int, with_ids: bool) -> Callable:
    names = ["doc_id", "row_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_ids(vocabulary)
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            taken, rows, ids = [], [], []
            row_ids = batch.column("row_id").to_pylist()
            for i, text in enumerate(batch.column("text")):
                coded = coder.encode(text.as_py()) + end
                n = len(coded) // 4
                for start in range(0, n, capacity):
                    length = min(capacity, n - start)
                    cut = coded[4 * start : 4 * (start + length)]
                    taken.append(i)
                    rows.append((row_ids[i], start, length, zlib.crc32(cut), n))
                    if with_ids:
                        ids.append(memoryview(cut).cast("I").tolist())
            cols = [batch.column("doc_id").take(pa.array(taken, pa.int64()))]
            cols += [pa.array([r[k] for r in rows], pa.int64()) for k in range(5)]
            if with_ids:
                cols.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, names)

    return pieces


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, row_id, start, length, ids_crc32, doc_tokens[, ids]): whole
    sequences first, the remainder last."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row_id"), F.encode(text_or_empty(), "UTF-8").alias("text"))
    schema = f"doc_id {kind}, row_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    return rows.mapInArrow(_cutter(vocabulary, capacity, end_id, with_ids), schema)


def ranked(cut: DataFrame, parts: int) -> DataFrame:
    """``cut`` with the rank of each piece in its class, counted in two levels."""
    part = F.pmod(F.xxhash64("row_id"), F.lit(parts)).cast("int")
    inside = Window.partitionBy("class", "part").orderBy("row_id", "start")
    local = cut.withColumn("part", part).withColumn("inside", F.row_number().over(inside) - 1)
    before = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = cut.withColumn("part", part).groupBy("class", "part").agg(F.count(F.lit(1)).alias("n"))
    firsts = firsts.select("class", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return local.join(firsts, ["class", "part"]).withColumn("rank", F.col("first") + F.col("inside")).drop("part", "inside", "first")


def pack(cut: DataFrame, capacity: int = CAPACITY, grain: int = GRAIN) -> DataFrame:
    """``cut`` (materialised pieces) with sequence_id and offset."""
    spark = cut.sparkSession
    classed = cut.withColumn("class", F.ceil(F.col("length") / grain).cast("int"))
    histogram = {r["class"]: r["count"] for r in classed.groupBy("class").count().collect()}
    rows = plan(histogram, capacity // grain)
    table = spark.createDataFrame(rows, "class int, lo long, hi long, each long, sequence long, slot long")
    placed = ranked(classed, 4 * width(spark)).join(F.broadcast(table), ["class"]).filter((F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    nth = F.col("rank") - F.col("lo")
    placed = placed.withColumns(
        {"sequence_id": F.col("sequence") + F.floor(nth / F.col("each")), "place": F.col("slot") + F.pmod(nth, F.col("each"))}
    )
    before = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0))
    return placed.select(*cut.columns, "sequence_id", offset.alias("offset"))


def packed_documents(docs: DataFrame, with_ids: bool = False, **options) -> DataFrame:
    """Tokenise, cut and pack whole documents; one row per piece."""
    cut = materialize(pieces(docs, with_ids=with_ids, **options), "pieces")
    return pack(cut, options.get("capacity", CAPACITY))


def sequences(packed: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids, doc_starts): the pieces (with ids) joined, padded to
    the capacity except at a power of two."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"), F.transform("parts", lambda p: p["offset"]).alias("doc_starts")
    )
    n = F.size("ids")
    whole = n.bitwiseAND(n - 1) == 0
    return joined.withColumn("ids", F.when(whole, F.col("ids")).otherwise(F.concat("ids", F.array_repeat(F.lit(pad_id), F.lit(capacity) - n))))

"""Repairing the structure of conversations, at least cost.

A conversation should read: perhaps a system row, then user and assistant rows
in turn.  Rows may be blank, repeated, cut off, missing or of a wrong role.
Every row gets its first fault; ``repair_search`` then proves the cheapest
edits by depth-first branch and bound.

Rows are sorted once over the whole table (by conversation, turn, role, text)
and numbered; a conversation's rows in ``BLOCK`` consecutive numbers are a
piece, two letters a row.  A conversation of one piece is searched at once.  A
longer one, however many of the table's rows it holds, is searched piece by
piece in parallel: costs from every entry to every exit state, then, with the
cheapest way on from each exit known, the best audit from every entry, then the
entries along the way.  Between pieces only four states and sixteen numbers a
piece pass.  A row counts as a duplicate by one minimum per (conversation,
role, digest of the text), combined before the shuffle.

The last step streams each conversation's rows in order through SHA-256, which
is sequential by definition: a task holds a batch of rows and the audit, one
letter an edit, which is an output column.

Edge cases: null roles and texts are one space (so neither kept nor unblank); a
null turn comes first and counts for no gap; a null ``conv_id`` is a
conversation of its own; rows of one turn are ordered by role and text, repeated
rows stay side by side; roles go by their first letter; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlens.llm.common import WHITE, small_batches
from eventlens.llm.repair_search import FITS, START, STEP, WHOLE, matrix, repair, search
from eventlens.operators.ranking import global_rank
from eventlens.session import materialize, release

#: Rows of the sorted table that make a block.
BLOCK = 1024
ROLES = {"u": "user", "a": "assistant"}
#: Counted results, in the order of the output.
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def damage(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with faults that the row's own key
    chooses: one in twenty dropped, emptied, without its ends of sentences,
    repeated or said by the user.  Nulls are one space."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn"))) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.translate(name("text"), ".!?", "")).otherwise(name("text"))
    rows = conversations.select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(name("role")).alias("role"), text.alias("text"), fate.alias("_fate")
    )
    copies = F.when(F.col("_fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.filter("_fate <> 0").select("conv_id", "turn", "role", "text", F.explode(copies).alias("_copy")).drop("_copy")


def _initial(role: Column) -> Column:
    first = F.left(role, F.lit(1))
    return F.when(first.isin("s", "u", "a"), first).otherwise("x")


def numbered(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, rank, block and code: the row's two letters,
    the second ``b``, ``t`` or ``.`` (duplicates are not known yet)."""
    said = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = F.when(said == "", "b").when(F.right(said, F.lit(1)).isin(".", "!", "?"), ".").otherwise("t")
    space = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    sorted_rows = global_rank(rows.select("conv_id", "turn", space("role"), space("text")), [F.col(c).asc() for c in ("conv_id", "turn", "role", "text")])
    block = F.floor((F.col("rank") - 1) / BLOCK).cast("long")
    return sorted_rows.withColumns({"block": block, "code": F.concat(_initial(F.col("role")), fault)})


def pieces(rows: DataFrame) -> DataFrame:
    """conv_id, block, lo, hi (its conversation's first and last block), first
    (rank of its first row) and codes."""
    said = rows.filter(~F.endswith("code", F.lit("b")))
    firsts = said.groupBy("conv_id", "role", F.unhex(F.sha2("text", 256)).alias("digest")).agg(F.min("rank").alias("rank"))
    flagged = rows.select("rank", "conv_id", "block", "code").join(firsts.select("rank", F.lit(True).alias("first")), "rank", "left")
    again = F.col("first").isNull() & ~F.endswith("code", F.lit("b"))
    code = F.when(again, F.concat(F.left("code", F.lit(1)), F.lit("d"))).otherwise(F.col("code"))
    letters = F.array_sort(F.collect_list(F.struct("rank", code.alias("code"))))
    found = flagged.groupBy("conv_id", "block").agg(F.min("rank").alias("first"), letters.alias("letters"))
    whole = Window.partitionBy("conv_id")
    return found.select(
        "conv_id", "block", "first", F.array_join(F.transform("letters", lambda x: x["code"]), "").alias("codes"),
        F.min("block").over(whole).alias("lo"), F.max("block").over(whole).alias("hi"),
    )


_FOUND = "block long, first long, codes string, state int, cost long, audit string"


def _kind(df: DataFrame) -> str:
    return df.schema["conv_id"].dataType.simpleString()


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [repair(codes) for codes in batch.column("codes").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("conv_id", "block", "first", "codes")]
            + [pa.array([START] * len(found), pa.int32()), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.string())],
            ["conv_id", "block", "first", "codes", "state", "cost", "audit"],
        )


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends = zip(batch.column("codes").to_pylist(), batch.column("block").to_pylist(), batch.column("hi").to_pylist(), strict=True)
        costs = [matrix(codes, block == hi) for codes, block, hi in ends]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("block"), batch.column("hi"), pa.array(costs, pa.list_(pa.float64()))], ["conv_id", "block", "hi", "costs"]
        )


def _onward(group: pd.DataFrame) -> pd.DataFrame:
    """The cheapest way on from every state after each piece of a conversation."""
    group = group.sort_values("block", ascending=False)
    onward, exits = [], list(WHOLE)
    for costs in group["costs"]:
        onward.append(list(exits))
        exits = [min(costs[4 * a + b] + exits[b] for b in range(4)) for a in range(4)]
    return group[["conv_id", "block"]].assign(exits=onward)


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each piece's best (cost, audit, exit) from each of the four states."""
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("codes", "exits", "block", "hi")), strict=True)
        out = []
        for codes, exits, block, hi in rows:
            ways = [search(codes, entry, tuple(exits), block == hi) for entry in range(4)]
            out.append([{"cost": -1, "audit": "", "leave": -1} if w is None else {"cost": int(w[0]), "audit": w[1], "leave": w[2]} for w in ways])
        kind = pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string()), ("leave", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("conv_id", "block", "first", "codes")] + [pa.array(out, kind)], ["conv_id", "block", "first", "codes", "ways"]
        )


def _along(group: pd.DataFrame) -> pd.DataFrame:
    """The state in which the best repair of a conversation enters each piece."""
    group = group.sort_values("block")
    states, state = [], START
    for leaves in group["leaves"]:
        states.append(state)
        state = leaves[state]
    return group[["conv_id", "block"]].assign(state=pd.Series(states, index=group.index, dtype="int32"))


def repaired_pieces(found: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """conv_id, block, first, codes, state (on entry), cost and audit of every
    piece; and the scratch tables behind them."""
    kind = _kind(found)
    one = found.filter("lo = hi").mapInArrow(_whole, f"conv_id {kind}, {_FOUND}")
    many = materialize(found.filter("lo < hi"), "repair-long")
    onward = many.mapInArrow(_matrices, f"conv_id {kind}, block long, hi long, costs array<double>").groupBy("conv_id").applyInPandas(
        _onward, f"conv_id {kind}, block long, exits array<double>"
    )
    same = lambda a, b: F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id")) & (F.col(f"{a}.block") == F.col(f"{b}.block"))
    known = many.alias("m").join(onward.alias("o"), same("m", "o")).select("m.*", "o.exits")
    ways = materialize(
        known.mapInArrow(_entries, f"conv_id {kind}, block long, first long, codes string, ways array<struct<cost: long, audit: string, leave: int>>"), "repair-ways"
    )
    leaves = ways.select("conv_id", "block", F.col("ways.leave").alias("leaves"))
    along = leaves.groupBy("conv_id").applyInPandas(_along, f"conv_id {kind}, block long, state int")
    way = F.element_at("ways", F.col("state") + 1)
    long = ways.alias("w").join(along.alias("a"), same("w", "a")).select(
        "w.conv_id", "w.block", "w.first", "w.codes", "a.state", way["cost"].alias("cost"), way["audit"].alias("audit")
    )
    return one.unionByName(long), [many, ways]


class _Conversation:
    """What is known of a conversation while its rows go by."""

    def __init__(self, conv_id):
        self.conv_id, self.hash, self.some, self.audit = conv_id, hashlib.sha256(), False, []
        self.count = dict.fromkeys(COUNTS, 0)
        self.low = self.high = self.turn = None
        self.turns, self.before = 0, None
        self.edits: Iterator[str] = iter("")
        self.codes, self.state, self.at = "", START, 0

    def piece(self, codes: str, state: int, cost: int, audit: str) -> None:
        self.rest()
        self.edits, self.codes, self.state, self.at = iter(audit), codes, state, 0
        self.audit.append(audit)
        self.count["cost"] += cost

    def put(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) * self.some}{role}:{text}".encode())
        self.some = True

    def fitting(self, text: str) -> None:
        letter = FITS[self.state]
        self.put(ROLES[letter], text)
        self.state = STEP[self.state, letter]

    def row(self, turn: int | None, role: str, text: str) -> None:
        letter, fault = self.codes[self.at], self.codes[self.at + 1]
        self.at += 2
        for name in ("blank", "duplicate", "truncated"):
            self.count[name] += fault == name[0]
        self.count["illegal"] += self.before is not None and self.before + letter not in ("su", "ua", "au")
        self.before = letter
        if turn is not None and turn != self.turn:
            self.low, self.high, self.turn, self.turns = turn if self.low is None else self.low, turn, turn, self.turns + 1
        for edit in self.edits:
            if edit == "I":
                self.fitting("")
                continue
            if edit == "K":
                self.put(role, text)
                self.state = STEP[self.state, letter]
            elif edit == "R":
                self.fitting(text)
            return

    def rest(self) -> None:
        for _ in self.edits:
            self.fitting("")

    def result(self) -> tuple:
        self.rest()
        if self.low is not None:
            self.count["gaps"] = self.high - self.low + 1 - self.turns
        return (self.conv_id, *self.count.values(), "".join(self.audit), self.hash.hexdigest())


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, each piece ahead of its rows -> one row a conversation."""
    names = ["conv_id", *COUNTS, "audit", "repaired_sha256"]
    now, kind = None, None

    def out(done: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*done, strict=True))
        kinds = [kind, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        done = []
        for r in batch.to_pylist():
            if now is None or now.conv_id != r["conv_id"]:
                if now is not None:
                    done.append(now.result())
                now = _Conversation(r["conv_id"])
            if r["codes"] is not None:
                now.piece(r["codes"], r["state"], r["cost"], r["audit"])
            else:
                now.row(r["turn"], r["role"], r["text"])
        if done:
            yield out(done)
    if now is not None:
        yield out([now.result()])


def repair_conversations(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Per conversation of ``rows`` (and of ``ids``, conv_id, where nothing may
    be left of one): conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256."""
    small_batches(rows.sparkSession)
    placed = materialize(numbered(rows), "repair-rows")
    found = materialize(pieces(placed), "repair-pieces")
    texts = placed.select("conv_id", "rank", F.lit(1).alias("tag"), F.col("turn").cast("long").alias("turn"), "role", "text")
    solved, behind = repaired_pieces(found)
    marks = solved.select("conv_id", F.col("first").alias("rank"), F.lit(0).alias("tag"), "codes", "state", "cost", "audit")
    stream = texts.unionByName(marks, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions("conv_id", "rank", "tag")
    counts = ", ".join(f"{c} long" for c in COUNTS)
    done = stream.mapInArrow(_streamed, f"conv_id {_kind(rows)}, {counts}, audit string, repaired_sha256 string")
    every = done if ids is None else done.unionByName(ids.select("conv_id").distinct(), allowMissingColumns=True)
    none = hashlib.sha256().hexdigest()
    default = {**dict.fromkeys(COUNTS, 0), "audit": "", "repaired_sha256": none}
    result = every.groupBy("conv_id").agg(*[F.coalesce(F.max(c), F.lit(v).cast("long" if c in COUNTS else "string")).alias(c) for c, v in default.items()])
    result = materialize(result, "repair-result")
    release(placed, found, *behind)
    return result

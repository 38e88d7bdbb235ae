"""Conversation repair: the search against a plain fold over all repairs, the
query against its SQL, pieces against whole conversations."""

import hashlib
import random

import duckdb
import pytest

from eventlens.llm import conversation_repair as C
from eventlens.llm.catalog import op11_conversation_repair
from eventlens.llm.oracle import OP11
from eventlens.llm.repair_search import FITS, STEP, repair


def plain(codes):
    """Best (cost, audit) per state, row by row."""

    def put(best, state, cost, audit):
        best[state] = min(best.get(state, (1e9, "")), (cost, audit))

    def insertions(best):
        for _ in range(3):
            for state, (cost, audit) in list(best.items()):
                put(best, STEP[state, FITS[state]], cost + 3, audit + "I")

    best = {0: (0, "")}
    for role, fault in zip(codes[::2], codes[1::2], strict=True):
        insertions(best)
        then = {}
        for state, (cost, audit) in best.items():
            put(then, state, cost + 4, audit + "D")
            if fault not in "bd":
                stays = cost + 3 * (fault == "t")
                if (state, role) in STEP:
                    put(then, STEP[state, role], stays, audit + "K")
                put(then, STEP[state, FITS[state]], stays + 3, audit + "R")
        best = then
    insertions(best)
    return min(best[s] for s in (0, 3) if s in best)


@pytest.mark.parametrize("seed", range(4))
def test_search_finds_the_cheapest_and_least_audit(seed):
    rng = random.Random(seed)
    for _ in range(800):
        weights = [rng.random() for _ in "suax"]
        codes = "".join(rng.choices("suax", weights)[0] + rng.choices("bdt.", [1, 1, 3, 6])[0] for _ in range(rng.randrange(14)))
        assert repair(codes) == plain(codes), codes


def test_long_sequences_are_searched_in_proportion():
    rng = random.Random(9)
    for weights in ([1, 10, 10, 1], [1, 1, 1, 1], [0, 1, 0, 0]):
        codes = "".join(rng.choices("suax", weights)[0] + rng.choices("bdt.", [1, 1, 3, 6])[0] for _ in range(1500))
        assert repair(codes) == plain(codes)


def awkward(spark, n=60):
    rng = random.Random(5)
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, 12)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = rng.choice(["Yes.", "No!", "cut off", None, "", " \t\n", "Yes.", f"w{rng.randrange(5)}?", "é" * 50 + "."])
            rows.append((conv if conv else None, turn if rng.random() < 0.9 else None, role, text, "v"))
    rows += [(500, t // 2, "user" if t % 3 else "assistant", f"t{t}." if t % 7 else "same.", "v") for t in range(400)]
    rows += [(501, 3, "user", "Twice.", "v")] * 3 + [(502, None, None, None, "v")]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, rank string").repartition(3)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r[0]))


def by_sql(conversations):
    con = duckdb.connect()
    con.register("conversations", conversations.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    return sorted(con.execute(OP11).fetchall(), key=lambda r: (r[0] is not None, r[0]))


@pytest.mark.parametrize("block", [1024, 7, 1])
def test_pieces_give_what_whole_conversations_give(spark, monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK", block)
    conversations = awkward(spark)
    out = C.repair_conversations(C.damage(conversations), conversations.select("conv_id"))
    assert out.columns == ["conv_id", *C.COUNTS, "audit", "repaired_sha256"]
    assert rows_of(out) == by_sql(conversations)


def test_empty_table_and_conversations_dropped_whole(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.repair_conversations(C.damage(none), none.select("conv_id")).collect() == []
    assert C.repair_conversations(none, spark.createDataFrame([(4,)], "conv_id long")).collect() == [
        (4, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    ]


def test_counts_by_hand(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 4, "user", "Hi."), (1, 5, "assistant", "Hello"), (1, 6, "user", " ")]
    got = C.repair_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert tuple(got)[:8] == (1, 2, 1, 1, 1, 1, 11, "KKDKD")
    assert got["repaired_sha256"] == hashlib.sha256(b"system:Be kind.\nuser:Hi.\nassistant:Hello").hexdigest()


def test_query_is_its_sql(spark):
    got = rows_of(op11_conversation_repair(spark, "/root/testdata/sf0.01"))
    assert got == by_sql(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet"))

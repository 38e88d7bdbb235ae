"""Exact, line and near duplicates against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from fixtures import CLASH, awkward_texts, documents, words
from pyspark.sql import functions as F

from eventlens.llm.common import join_skewed
from eventlens.llm.exact_dedup import drop_duplicates, exact_groups
from eventlens.llm.graph import components
from eventlens.llm.line_dedup import LineRuns, common_lines, drop_common_lines
from eventlens.llm.near_dedup import CHUNKS, MAX_DISTANCE, _reach, _verified, drop_near, near_groups

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def rows():
    return awkward_texts()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return documents(spark, rows)


def test_exact_groups(docs, rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i))
    expected = Counter()
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (m[0], m[1], m[2] or 0))[2]
        sha = hashlib.sha256(norm.encode()).hexdigest()
        expected.update((i, keep, len(members), sha) for _, _, i in members)
    got = exact_groups(docs).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == expected
    kept = Counter(r["text_sha256"] for r in got if r["kept"])
    assert set(kept.values()) == {1} and len(kept) == len(groups)


def test_exact_drop_keeps_columns(docs, rows):
    out = drop_duplicates(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert len(got) == len({re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows})
    assert all(r[c] == f"v{r['doc_id']}" for r in got for c in CLASH)


def test_exact_many_runs(spark):
    """More than one exchange round: 40 input partitions."""
    df = spark.range(0, 4000, 1, 40).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 700).alias("text"))
    got = exact_groups(df)
    assert got.filter("kept").count() == 700
    assert got.filter("keep_id != doc_id % 700").count() == 0


@pytest.mark.parametrize("operator", [exact_groups, drop_duplicates, near_groups, drop_near, drop_common_lines])
def test_empty_table(spark, operator):
    assert operator(documents(spark, [])).count() == 0


def test_line_dedup(spark):
    shared = [f"shared {i}" for i in range(5)]
    rows = [(1, None), (2, ""), (3, "\n\n")]
    rows += [(i, f"own {i}\n  Shared {i % 5}\t\nSHARED 0\nSHARED 0\r\n\nİ k") for i in range(4, 30)]
    rows += [(30, "x\n" * 3000 + "shared 0"), (30, "shared 0"), (None, "Shared 1\nlast")]
    keys = [[line.strip(" \t\n\x0b\x0c\r").translate(LOWER) for line in (t or "").split("\n")] for _, t in rows]
    found = Counter(k for ks in keys for k in set(ks) if k)
    common = {k for k, n in found.items() if n >= 5}
    assert set(shared[:1]) <= common
    expected = Counter()
    for (i, t), ks in zip(rows, keys, strict=True):
        kept = [line for line, k in zip((t or "").split("\n"), ks, strict=True) if k not in common]
        expected[(i, len(ks), len(ks) - len(kept), "\n".join(kept))] += 1
    got = drop_common_lines(documents(spark, rows), threshold=5)
    assert Counter(tuple(r) for r in got.select("doc_id", "n_lines", "n_dropped", "text").collect()) == expected


def brute_components(rows):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                label[find(a)] = find(b)
    names = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        names[find(i)].append(doc_id)
    best = {k: min((x for x in v if x is not None), default=None) for k, v in names.items()}
    found = [(doc_id, len(sets[i]), best[find(i)]) for i, (doc_id, _) in enumerate(rows)]
    return found, len({find(i) for i in range(len(rows)) if sets[i]})


def test_near_groups(docs, rows):
    expected, n = brute_components(rows)
    got = near_groups(docs).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == Counter(expected)
    assert sum(r["kept"] for r in got if r["n_shingles"]) == n


def test_near_chain(spark):
    """A chain of edits: neighbours are similar, the ends are not; one component."""
    import random

    rng = random.Random(5)
    toks = words(rng, 200, 10_000).split()
    rows = [(0, " ".join(toks))]
    for i in range(1, 40):
        toks = list(toks)
        for j in range(3):
            toks[(i * 17 + j) % 200] = f"e{i}.{j}"
        rows.append((i, " ".join(toks)))
    df = documents(spark, rows, clash=False)
    got = {r["doc_id"]: r["component_id"] for r in near_groups(df).collect()}
    assert got == {d: c for d, _, c in brute_components(rows)[0]}
    assert drop_near(df).count() == len(set(got.values()))


def test_near_star(spark):
    """Copies that are similar to their base only: more than a block of them, the base not the smallest id."""
    import random

    rng = random.Random(6)
    base = words(rng, 150, 10_000).split()
    rows = []
    for i in range(700):
        toks = list(base)
        for j in range(1 + i % 3):
            toks[rng.randrange(150)] = f"e{i}.{j}"
        rows.append((i, " ".join(toks)))
    rows.append((700, " ".join(base)))
    got = {r["doc_id"]: r["component_id"] for r in near_groups(documents(spark, rows, clash=False)).collect()}
    assert got == {d: c for d, _, c in brute_components(rows)[0]} and len(set(got.values())) < 600


def edit_trees(seed, families=6, versions=120, length=160):
    """Families of edited copies, each made from a random earlier one, ids in random order."""
    import random

    rng = random.Random(seed)
    texts = []
    for f in range(families):
        made = [words(rng, length, 10_000).split()]
        for v in range(1, versions):
            toks = list(rng.choice(made[-12:]))
            for j in range(rng.randrange(2, 6)):
                toks[rng.randrange(length)] = f"e{f}.{v}.{j}"
            made.append(toks)
        texts += [" ".join(t) for t in made]
    rng.shuffle(texts)
    return list(enumerate(texts))


def near_misses(n, length=400, edits=18, seed=5):
    """A family at similarity 0.63: every document has words of its own in places of a template."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(length)]
    rows = []
    for d in range(n):
        words = list(base)
        for at in range(0, edits):
            words[at * (length // edits) + rng.randrange(5, length // edits - 5)] = f"d{d}x{at}"
        rows.append((d, " ".join(words)))
    return rows


def test_near_miss_families_cost_in_proportion(spark, monkeypatch):
    """Blocks and set rows grow with the family, not with its pairs; two true copies in it are found."""
    from eventlens.llm import near_dedup as N

    dealt = N._dealt
    figures = {}
    for n in (150, 600):
        rows = near_misses(n)
        rows += [(1000, rows[3][1].replace("b7 ", "")), (1001, rows[n - 1][1] + " more words at the end")]
        seen = []
        monkeypatch.setattr(N, "_dealt", lambda df, *keys, seen=seen: (seen.append(df.count()), dealt(df, *keys))[1])
        got = {r["doc_id"]: r["component_id"] for r in near_groups(documents(spark, rows)).collect()}
        assert got == {i: i for i, _ in rows} | {1000: 3, 1001: n - 1}
        figures[n] = sum(seen[1:])  # the first is of buckets' centers
    assert figures[600] < 6 * max(figures[150], 100), figures


def test_prefixes_meet():
    """Sets of the similarity share a shingle among the rarest ones, whatever their sizes."""
    from eventlens.llm.near_dedup import prefix_sizes

    rng = random.Random(2)
    for _ in range(4000):
        n, percent = rng.randint(1, 60), rng.choice([50, 75, 80, 100])
        both = rng.randint(1, n)
        one = set(range(n))
        two = set(range(n - both, n)) | {1000 + i for i in range(rng.randint(0, 40))}
        small, large = sorted((one, two), key=len)
        if 100 * len(small & large) < percent * len(small | large):
            continue
        order = {t: rng.random() for t in small | large}
        first = lambda s, k: set(sorted(s, key=order.get)[:k])
        assert first(small, prefix_sizes(len(small), percent)[0]) & first(large, prefix_sizes(len(large), percent)[1])


@pytest.mark.parametrize("seed", [1, 2, 11])
def test_near_trees(spark, seed):
    """Versions made from versions: members of several components are near one center."""
    rows = edit_trees(seed)
    got = {r["doc_id"]: r["component_id"] for r in near_groups(documents(spark, rows, clash=False)).collect()}
    assert got == {d: c for d, _, c in brute_components(rows)[0]}


def test_verified_links_every_component():
    """A visitor near two components of one block is linked with both; joined ones are not linked again."""
    import pyarrow as pa

    sets = [list(range(100)), list(range(10, 110)), list(range(200, 300)), list(range(5, 105)), list(range(5, 106))]
    rows = {"grp": [1] * 5, "block": [0] * 5, "visitor": [False] * 3 + [True] * 2, "node": [1, 2, 3, 4, 5], "comp": [1, 2, 3, 4, 5]}
    batch = pa.RecordBatch.from_pydict({**rows, "shingles": pa.array(sets, pa.list_(pa.int64()))})
    links = [(r["a"], r["b"]) for out in _verified(75)(iter([batch])) for r in out.to_pylist()]
    assert {b for a, b in links if a == 4} == {1, 2} and len([x for x in links if x[0] == 5]) == 1


def test_pigeonhole_bound():
    """At most MAX_DISTANCE errors over the chunks leave one with at most one error."""
    assert MAX_DISTANCE // CHUNKS == 1


def test_block_reach():
    """Within a block: only pairs with a member at home, of different components, in their first shared bucket;
    the other's group comes out."""
    import pyarrow as pa

    sig = np.zeros((5, 64), np.uint16)
    sig[4, ::2] = 7  # 32 symbols away from the others
    rows = {"node": [1, 2, 3, 4, 5], "comp": [1, 1, 3, 4, 5], "grp": [1, 1, 4, 4, 5], "home": [True, True, False, False, True], "sig": [s.tobytes() for s in sig]}
    assert _reach(pa.table({"key": [0] * 5, **rows})) == {(3, 1), (4, 1)}
    assert _reach(pa.table({"key": [1 << 48] * 5, **rows})) == set()


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 20), (5, 5)] + [(100, i) for i in range(101, 160)] + [(i, i + 1) for i in range(200, 260)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in (1, 2, 3)}, **{i: 7 for i in (7, 8, 9, 20)}, **{i: 100 for i in range(100, 160)}, **{i: 200 for i in range(200, 261)}}


def test_join_skewed_splits_a_hot_key(spark):
    left = spark.range(3000).select(F.when(F.col("id") < 2000, 0).otherwise(F.col("id")).alias("k"), "id")
    right = left.groupBy("k").agg(F.count(F.lit(1)).alias("w"))
    out = join_skewed(left, right, ["k"], "w")
    assert out.count() == 3000 and out.filter("k = 0 and w = 2000").count() == 2000
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()


def test_line_runs_merge_without_shuffle(spark):
    """Runs are bucketed and sorted: anti-join and merge need no exchange."""
    runs = LineRuns(spark, threshold=3)
    one, two = (runs.store(spark.range(100).select((F.col("id") * k).alias("h1"), F.col("id").cast("int").alias("h2"), F.lit(k).cast("long").alias("n"))) for k in (1, 4))
    anti = one.join(two.filter("n >= 3").select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
    for df in (anti, runs._merge([one, two])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
    runs.add(one)
    runs.add(two)
    got = {(r["h1"], r["h2"]): r["n"] for r in runs.common().collect()}
    assert got == {(4 * i, i): 4 + (i == 0) for i in range(100)}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_many_levels_of_line_runs(spark):
    """More batches than a level holds: counts add up over all levels."""
    rows = [(i, f"all\nmod {i % 7}\nown {i}") for i in range(70)]
    got = {(r["h1"]): r["n"] for r in common_lines(documents(spark, rows, clash=False), threshold=10, batches=9, fanout=3).collect()}
    assert len(got) == 8

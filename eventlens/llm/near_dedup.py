"""Near duplicates: a multi-index Hamming join over b-bit MinHash signatures.

A document's signature is 64 MinHash values cut to b = 16 bits.  Two documents
of Jaccard similarity 0.75 differ in 16 of the 64 symbols on average (standard
deviation 3.5); the signature join is exact up to a distance of 31 symbols,
4.3 deviations away.  It splits a signature into 16 chunks of 4 symbols: with
at most 31 errors, by the pigeonhole principle some chunk has at most one.
That error is enumerated: every chunk is indexed four times, each time with
another symbol left out, so any pair within the threshold meets under at least
one of 64 keys of 48 bits.

Links are confirmed on the full shingle sets, natively.  Which links are
needed depends on the answer: components, not pairs.

* Equal sets are one class; only class representatives take part.
* First, every representative is compared with the centers of its buckets (in
  a large bucket the member nearest to the bucket's commonest symbols, else
  the smallest), and the nearest center is verified.  Buckets of near copies
  collapse into components with a number of comparisons linear in their size.
* Members of buckets that still hold several components are asked for by their
  full sets: ordered by rarity, two sets of the similarity share a shingle among
  the first few of the smaller and somewhat more of the larger one.  A member
  none of whose such shingles another component has is out; a family whose
  documents differ in shingles of their own, all within the distance and none
  within the similarity, goes no further (rows in proportion to the sets).
* Then the members left are compared by signature, in blocks, within buckets
  that hold several of their components.  A large bucket is cut into blocks of ``BLOCK``
  members; members outside the bucket's commonest component visit every block,
  the others only their own.  What comes out is not pairs but, for a member
  within the distance of a member of another component, that one's group: its
  component, or that of the center it came nearest to.
* Such a member's full set is compared with the sets of all members of that
  group, again in blocks.  A group may hold members of several components;
  of the pairs that reach the similarity a block gives one for every two
  components that its pairs so far have not joined, directly or through
  others.  So no link between components is missed, and neither step's output
  grows with the square of a group (a block joins no more components than it
  has members and visitors).

Edge cases: texts without words are linked with nothing; a null ``doc_id`` is
never a component's name unless all are null; of the rows of a group exactly
one is kept, the smallest id (a repeated row counts once); empty tables give
empty results; other columns are ignored here and kept by ``drop_near``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import join_skewed, plain, small_batches, text_or_empty, width
from eventlens.llm.graph import components
from eventlens.llm.shingles import SYMBOLS, WordHashes, shingle_set, signature
from eventlens.session import materialize, release

CHUNK = 4
CHUNKS = SYMBOLS // CHUNK
#: One error per chunk is enumerated; more than this distance is not promised.
MAX_DISTANCE = 2 * CHUNKS - 1
BLOCK = 512
#: Buckets from this size have their center chosen by the commonest symbols.
LARGE = 16
#: Counters of shingles by hash, which order shingles by rarity.
SLOTS = 1 << 20
#: Representatives up to this many (about 40 bytes each) go to the text scan by broadcast.
BROADCAST_ROWS = 200_000


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        sizes, ids, sigs = [], [], []
        for text in batch.column("text"):
            s = shingle_set(text.as_py(), hashes)
            sizes.append(len(s))
            ids.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            sigs.append(signature(s).tobytes() if len(s) else None)
        cols = [batch.column(i) for i in range(3)] + [pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(sigs, pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, ["doc_id", "row_id", "text_hash", "n_shingles", "set_id", "sig"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        sets = [shingle_set(t.as_py(), hashes).view(np.int64) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])


def _matrix(column: pa.Array) -> np.ndarray:
    """Signatures as rows of symbols."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), SYMBOLS)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        chunks = _matrix(batch.column("sig")).astype(np.uint64).reshape(-1, CHUNKS, CHUNK)
        keys = np.empty((len(batch), CHUNKS, CHUNK), np.uint64)
        for left_out in range(CHUNK):
            kept = [j for j in range(CHUNK) if j != left_out]
            place = np.arange(CHUNKS, dtype=np.uint64) * np.uint64(CHUNK) + np.uint64(left_out)
            keys[:, :, left_out] = place << np.uint64(48)
            for at, j in enumerate(kept):
                keys[:, :, left_out] |= chunks[:, :, j] << np.uint64(16 * at)
        node = np.repeat(batch.column("node").to_numpy(), SYMBOLS)
        yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).astype(np.int64)), pa.array(node)], ["key", "node"])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not len(batch):
            continue
        distance = (_matrix(batch.column("sig")) != _matrix(batch.column("sig2"))).sum(axis=1)
        near = distance <= MAX_DISTANCE
        a, b = batch.column("a").to_numpy()[near], batch.column("b").to_numpy()[near]
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(distance[near].astype(np.int64))], ["a", "b", "distance"])


def _groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """Runs of rows with equal keys (rows come sorted by them)."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        values = [table.column(k).to_numpy() for k in keys]
        changes = np.zeros(max(0, len(batch) - 1), bool)
        for v in values:
            changes |= v[1:] != v[:-1]
        cuts = [0, *(np.flatnonzero(changes) + 1), len(batch)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if lo == hi:
                continue
            now = tuple(v[lo] for v in values)
            if held and now != last:
                yield pa.concat_tables(held).combine_chunks()
                held = []
            last = now
            held.append(table.slice(lo, hi - lo))
    if held:
        yield pa.concat_tables(held).combine_chunks()


def _centers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block of a bucket the member nearest to the block's commonest symbols."""
    for rows in _groups(batches, "key", "block"):
        sig = _matrix(rows.column("sig"))
        common = np.array([_commonest(sig[:, j]) for j in range(SYMBOLS)], np.uint16)
        distance = (sig != common).sum(axis=1)
        best = int(distance.argmin())
        yield pa.RecordBatch.from_arrays(
            [rows.column("key").combine_chunks().slice(best, 1), rows.column("node").combine_chunks().slice(best, 1), pa.array([int(distance[best])])],
            ["key", "node", "distance"],
        )


def _commonest(symbols: np.ndarray) -> int:
    values, counts = np.unique(symbols, return_counts=True)
    return int(values[counts.argmax()])


def _reach(rows: pa.Table) -> set[tuple[int, int]]:
    """(node, group): members of a bucket's block within the distance of a
    member of another component, with that one's group; the node is the member
    of the rarer component.  A pair counts in the first of the buckets that it
    shares only."""
    place = int(rows.column("key")[0].as_py()) >> 48
    node, comp, group, home = (rows.column(c).to_numpy() for c in ("node", "comp", "grp", "home"))
    sig = _matrix(rows.column("sig"))
    values, counts = np.unique(comp, return_counts=True)
    often = counts[np.searchsorted(values, comp)]
    found = set()
    for i in range(len(node)):
        rarer = (often > often[i]) | ((often == often[i]) & (comp > comp[i]))
        at = np.flatnonzero(rarer & (home | home[i]))
        if not len(at):
            continue
        differ = sig[at] != sig[i]
        near = differ.sum(axis=1) <= MAX_DISTANCE
        at, differ = at[near], differ[near].reshape(-1, CHUNKS, CHUNK)
        errors = differ.sum(axis=2)
        first = (errors <= 1).argmax(axis=1)
        spot = np.arange(len(at))
        left_out = np.where(errors[spot, first] == 0, 0, differ[spot, first].argmax(axis=1))
        at = at[first * CHUNK + left_out == place]
        found.update((int(node[i]), int(g)) for g in np.unique(group[at]))
    return found


def _bucket_reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _groups(batches, "key", "block"):
        found = sorted(_reach(rows))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found]), pa.array([g for _, g in found])], ["node", "grp"])


def _verified(percent: int):
    """Members of a group's block (visitor false, first) and the sets that
    visit it; per visitor the most similar member of every other component
    that reaches the similarity, unless the block's links join the two already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, members, nodes, theirs = None, [], [], []
        joined: dict[int, int] = {}

        def find(comp: int) -> int:
            while (up := joined.get(comp, comp)) != comp:
                joined[comp] = comp = joined.get(up, up)
            return comp

        held = starts = sizes = others = np.empty(0, np.int64)
        for batch in batches:
            a, b = [], []
            groups, blocks, visitors, ids, comps = (
                batch.column(c).to_numpy(zero_copy_only=False) for c in ("grp", "block", "visitor", "node", "comp")
            )
            sets = batch.column("shingles")
            for i in range(len(batch)):
                if (groups[i], blocks[i]) != last:
                    last, members, nodes, theirs, held = (groups[i], blocks[i]), [], [], [], None
                    joined.clear()
                one = sets[i].values.to_numpy().view(np.uint64)
                if not visitors[i]:
                    members.append(one)
                    nodes.append(ids[i])
                    theirs.append(comps[i])
                    continue
                if not members:
                    continue
                if held is None:
                    held = np.concatenate(members)
                    sizes = np.array([len(m) for m in members])
                    others = np.array(theirs)
                    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                at = np.minimum(np.searchsorted(one, held), len(one) - 1)
                common = np.add.reduceat((one[at] == held).astype(np.int64), starts)
                union = sizes + len(one) - common
                ok = np.flatnonzero((100 * common >= percent * union) & (others != comps[i]))
                ok = ok[np.argsort(-common[ok] / union[ok], kind="stable")]
                _, firsts = np.unique(others[ok], return_index=True)
                for best in ok[np.sort(firsts)]:
                    one_end, other_end = find(int(comps[i])), find(int(others[best]))
                    if one_end != other_end:
                        joined[one_end] = other_end
                        a.append(int(ids[i]))
                        b.append(int(nodes[best]))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def summaries(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, row_id, text_hash, n_shingles, set_id, sig."""
    small_batches(docs.sparkSession)
    text = text_or_empty()
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row_id"), F.xxhash64(text).alias("text_hash"), F.encode(text, "UTF-8").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_summaries, f"doc_id {kind}, row_id long, text_hash long, n_shingles long, set_id binary, sig binary")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the wanted representatives (node, id, text_hash)."""
    few = wanted.count() <= BROADCAST_ROWS
    wanted = wanted.select("node", F.col("id").alias("_id"), F.col("text_hash").alias("_hash"))
    text = text_or_empty()
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.encode(text, "UTF-8").alias("text"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    rows = rows.join(F.broadcast(wanted) if few else wanted, same).select("node", "text")
    return rows.mapInArrow(_sets, "node long, shingles array<bigint>").dropDuplicates(["node"])


def _sets_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles), materialised, of the nodes in ``wanted`` (node)."""
    wanted = materialize(nodes.join(wanted.distinct(), "node").select("node", "id", "text_hash"), "near-wanted")
    sets = materialize(_texts(docs, wanted), "near-sets")
    release(wanted)
    return sets


def confirmed(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))
    sets = _sets_of(docs, nodes, ends)
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.select("a", "b").hint("merge").join(one, "a").hint("merge").join(two, "b")
    common = F.size(F.array_intersect("sa", "sb"))
    links = materialize(both.filter(100 * common >= percent * (F.size("sa") + F.size("sb") - common)).select("a", "b"), "near-links")
    release(sets)
    return links


def bucket_members(nodes: DataFrame) -> DataFrame:
    """(key, node, center, n) for every key that several nodes share."""
    keys = nodes.select("node", "sig").mapInArrow(_keys, "key long, node long")
    shared = keys.groupBy("key").agg(F.min("node").alias("center"), F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    shared = materialize(shared, "near-keys")
    members = materialize(join_skewed(keys, shared, ["key"], "n"), "near-all-members")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    large = members.filter(F.col("n") >= LARGE).withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    large = _dealt(large.join(nodes.select("node", "sig"), "node").select("key", "block", "node", "sig"), "key", "block")
    central = large.mapInArrow(_centers, "key long, node long, distance long")
    central = materialize(central.groupBy("key").agg(F.min(F.struct("distance", "node")).alias("best")).select("key", "best.node"), "near-centers")
    better = shared.join(central, "key", "left").select("key", F.coalesce(central["node"], "center").alias("center"), "n")
    better = materialize(better, "near-keys")
    out = materialize(join_skewed(members.select("key", "node"), better, ["key"], "n"), "near-members")
    release(shared, members, central, better)
    return out


def _dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows with equal keys together, sorted."""
    return rows.repartition(width(rows.sparkSession), *keys[:2]).sortWithinPartitions(*keys)


def nearest_centers(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """(a, b): each node and the nearest of its buckets' centers within the distance."""
    pairs = members.filter(F.col("node") != F.col("center")).select(F.col("node").alias("a"), F.col("center").alias("b")).distinct()
    sig = nodes.select("node", "sig")
    both = pairs.join(sig.select(F.col("node").alias("a"), "sig"), "a").join(sig.select(F.col("node").alias("b"), F.col("sig").alias("sig2")), "b")
    near = both.select("a", "b", "sig", "sig2").mapInArrow(_near, "a long, b long, distance long")
    return materialize(near.groupBy("a").agg(F.min(F.struct("distance", "b")).alias("best")).select("a", F.col("best.b").alias("b")), "near-first")


def grouped(nodes: DataFrame, nearest: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, comp, grp): the component so far, and the group to be searched
    for others: the component, or for a node alone that of its nearest center."""
    center = nearest.select(F.col("a").alias("node"), F.col("b").alias("center"))
    own = labels.select("node", F.col("component").alias("own"))
    theirs = labels.select(F.col("node").alias("center"), F.col("component").alias("theirs"))
    rows = nodes.select("node").join(own, "node", "left").join(center, "node", "left").join(theirs, "center", "left")
    rows = rows.select("node", F.coalesce("own", "node").alias("comp"), F.coalesce("own", "theirs", "center", "node").alias("grp"))
    return materialize(rows, "near-grouped")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(slot, n): how many of a task's sets have a shingle of the slot."""
    total = np.zeros(SLOTS, np.int64)
    for batch in batches:
        tokens = batch.column("shingles").flatten().to_numpy().view(np.uint64)
        total += np.bincount((tokens % SLOTS).astype(np.int64), minlength=SLOTS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["slot", "n"])


def prefix_sizes(n: int, percent: int) -> tuple[int, int]:
    """How many of a set's rarest shingles are looked up by larger or equal
    sets, and how many of its own it looks up: two sets of the similarity share
    one among the former of the smaller and the latter of the larger."""
    return n + 1 - -(-2 * percent * n // (100 + percent)), n + 1 - -(-percent * n // 100)


def _prefixes(shared, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = shared.value
        for batch in batches:
            tokens, nodes, comps, offered = [], [], [], []
            rows = zip(batch.column("shingles"), batch.column("node").to_pylist(), batch.column("comp").to_pylist(), strict=True)
            for shingles, node, comp in rows:
                one = shingles.values.to_numpy().view(np.uint64)
                few, more = prefix_sizes(len(one), percent)
                first = one[np.lexsort((one, often[(one % SLOTS).astype(np.int64)]))[:more]]
                tokens.append(first.view(np.int64))
                nodes.append(np.full(more, node))
                comps.append(np.full(more, comp))
                offered.append(np.arange(more) < few)
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (tokens, nodes, comps, offered)], ["token", "node", "comp", "offered"])

    return run


def alive(sets: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """(node): nodes of ``sets`` that may reach the similarity with a node of
    another component, materialised.  The counters are a bounded broadcast."""
    counts = sets.mapInArrow(_counted, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    often = np.zeros(SLOTS, np.int64)
    often[counts.column("slot").to_numpy()] = counts.column("n").to_numpy()
    shared = sets.sparkSession.sparkContext.broadcast(often)
    rows = sets.join(groups.select("node", "comp"), "node").mapInArrow(_prefixes(shared, percent), "token long, node long, comp long, offered boolean")
    rows = materialize(rows, "near-prefixes")
    tokens = rows.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.bool_or("offered").alias("met"), F.count(F.lit(1)).alias("n"))
    tokens = materialize(tokens.filter((F.col("lo") < F.col("hi")) & F.col("met")).select("token", "n"), "near-tokens")
    out = materialize(join_skewed(rows.select("token", "node"), tokens, ["token"], "n").select("node").distinct(), "near-alive")
    release(rows, tokens)
    shared.unpersist()
    return out


def _mixed(placed: DataFrame) -> DataFrame:
    """(key, n, most): buckets that hold several components, their members and
    the commonest component; materialised."""
    parts = placed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    mixed = parts.groupBy("key").agg(
        F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n"), F.max(F.struct("n", "comp")).alias("most")
    ).filter(F.col("parts") > 1)
    return materialize(mixed.select("key", "n", F.col("most.comp").alias("most")), "near-mixed")


def other_links(docs: DataFrame, nodes: DataFrame, members: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Verified links between nodes that lie in different components so far."""
    placed = materialize(members.select("key", "node").join(groups, "node"), "near-placed")
    mixed = _mixed(placed)
    if mixed.isEmpty():
        release(placed)
        return mixed.select(F.col("key").alias("a"), F.col("most").alias("b"))
    sets = _sets_of(docs, nodes, join_skewed(placed, mixed, ["key"], "n").select("node"))
    left = alive(sets, groups, percent)
    asked = materialize(placed.join(left, "node"), "near-asked")
    release(mixed)
    mixed = _mixed(asked)
    rows = join_skewed(asked, mixed, ["key"], "n")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    home = F.pmod(F.xxhash64("node"), blocks).cast("int")
    visits = F.when(F.col("comp") == F.col("most"), F.array(home)).otherwise(F.sequence(F.lit(0), blocks - 1))
    rows = rows.select("key", "node", "comp", "grp", home.alias("home_block"), F.explode(visits).alias("block"))
    rows = rows.join(nodes.select("node", "sig"), "node")
    rows = rows.select("key", "block", "node", "comp", "grp", (F.col("block") == F.col("home_block")).alias("home"), "sig")
    reach = materialize(_dealt(rows, "key", "block").mapInArrow(_bucket_reach, "node long, grp long").distinct(), "near-reach")
    release(placed, asked, mixed)

    whole = materialize(groups.join(left, "node").join(reach.select("grp").distinct(), "grp", "left_semi"), "near-whole")
    sizes = materialize(whole.groupBy("grp").agg(F.count(F.lit(1)).alias("n")), "near-sizes")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    inside = join_skewed(whole, sizes, ["grp"], "n").select(
        "grp", F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block"), "node", "comp", F.lit(False).alias("visitor")
    )
    outside = reach.join(sizes, "grp").join(groups.select("node", "comp"), "node").select(
        "grp", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), "node", "comp", F.lit(True).alias("visitor")
    )
    both = inside.unionByName(outside).join(sets, "node").select("grp", "block", "visitor", "node", "comp", "shingles")
    links = materialize(_dealt(both, "grp", "block", "visitor").mapInArrow(_verified(percent), "a long, b long"), "near-links")
    release(reach, whole, sizes, sets, left)
    return links


def near_groups(docs: DataFrame, percent: int = 75) -> DataFrame:
    """Per document: doc_id, row_id, text_hash, n_shingles, component_id, kept."""
    rows = materialize(summaries(docs), "near-rows")
    nodes = rows.filter(F.col("set_id").isNotNull()).groupBy("set_id").agg(
        F.min(F.struct("row_id", F.col("doc_id").alias("id"), "text_hash")).alias("one"),
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id")).alias("first"),
        F.first("sig").alias("sig"),
        F.count(F.lit(1)).alias("copies"),
    )
    nodes = materialize(nodes.select("set_id", F.col("one.row_id").alias("node"), "one.id", "one.text_hash", "sig", "copies", "first"), "near-nodes")
    members = bucket_members(nodes)
    nearest = nearest_centers(nodes, members)
    links = confirmed(docs, nodes, nearest, percent)
    labels = materialize(components(links), "near-labels")
    groups = grouped(nodes, nearest, labels)
    more = other_links(docs, nodes, members, groups, percent)
    release(members, nearest, links, groups)
    if not more.isEmpty():
        stars = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
        labels = materialize(components(stars.unionByName(more)), "near-labels")
    return _named(rows, nodes, labels)


def _named(rows: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """Give every document its component's smallest id."""
    named = materialize(
        nodes.drop("sig").join(labels, "node", "left").withColumn("comp", F.coalesce("component", "node")), "near-named"
    )
    tops = materialize(named.groupBy("comp").agg(F.min("first").alias("top"), F.count(F.lit(1)).alias("n")), "near-tops")
    classes = materialize(join_skewed(named.select("set_id", "copies", "comp"), tops, ["comp"], "n").select("set_id", "copies", "top"), "near-classes")
    cols = ["doc_id", "row_id", "text_hash", "n_shingles"]
    linked = join_skewed(rows.filter(F.col("set_id").isNotNull()).select("set_id", *cols), classes, ["set_id"], "copies")
    linked = linked.select(*cols, F.col("top.doc_id").alias("component_id"), (F.col("row_id") == F.col("top.row_id")).alias("kept"))
    alone = rows.filter(F.col("set_id").isNull()).select(*cols, F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return linked.unionByName(alone)


def drop_near(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The rows of each group that share the id and text of its kept row, with all their columns."""
    decided = near_groups(docs, percent).groupBy("doc_id", "text_hash").agg(F.max("kept").alias("kept"))
    gone = decided.filter(~F.col("kept")).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    rows = plain(docs, "doc_id", "text")
    marked = rows.withColumn("_h", F.xxhash64(text_or_empty()))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_hash"))
    return marked.join(gone, same, "left_anti").select(*rows.columns).toDF(*docs.columns)

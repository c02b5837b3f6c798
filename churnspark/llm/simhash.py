"""SimHash near-dedup: a binary trie self-join of 64-bit fingerprints.

Fingerprints within ``budget`` differing bits are linked; linked documents form
groups.  The trie join walks pairs of trie nodes together from the root: a pair
of a node with itself becomes (0,0), (1,1) and (0,1); a pair of two nodes
becomes all four pairs of children; a step onto unequal bits costs one, and a
pair is pruned once its cost exceeds the budget.

Shared out over Spark: of ``budget + 1`` blocks of bits, two linked
fingerprints agree on one at least.  The word is rotated so that each block in
turn leads, which makes the block's value a trie node on whose path no error
is spent; every such node's subtree is one unit of work, and only pairs inside
it remain.  Distinct fingerprints only are walked, so copies, however many,
count once.  A subtree that is hot (over ``max_node`` fingerprints) is split
again by the blocks of its remaining bits, in the same exact way.

A task never emits pairs: it unites what it finds and returns, for each
fingerprint, the least one of its group, at most one edge per fingerprint.
Groups across units are closed by alternating large-star and small-star
rounds of joins, each written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.llm.common import bounded_batches, shuffle_partitions, written

SEED = 42
_SLICE = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash: A-Z lowered, words between \\x20 and \\x09-\\x0D, shingles with repeats, XXH64; unsigned."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z lowered, split at exactly those six
    if not words:
        return 0
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]]).tolist()
    ends = (ends - 1).tolist()
    joined, size = b" ".join(words), min(shingle, len(words))
    spans, n = list(zip(starts, ends[size - 1:])), len(words) - size + 1
    h64, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, _SLICE):
        h = np.array([h64(joined[a:b], SEED) for a, b in spans[at:at + _SLICE]], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def text_key(text_col: str) -> Column:
    """128 bits that tell texts of equal id apart; null and empty differ."""
    return F.coalesce(F.md5(F.col(text_col)), F.lit(""))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int, keyed: bool = False) -> DataFrame:
    """``doc, fp`` and, if ``keyed``, ``key``: fp is the unsigned fingerprint's bits in a long, key the text's."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64()), *b.columns[2:]],
                                             names=["doc", "fp", "key"][:b.num_columns])

    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    key = [text_key(text_col).alias("key")] if keyed else []
    return docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"), *key).mapInArrow(
        run, f"doc {kind}, fp long" + ", key string" * keyed)


def trie_pairs(keys: np.ndarray, roots: np.ndarray, budget: int, bits: int, room: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) of ``keys`` inside the same root within ``budget`` differing bits.

    ``keys``: distinct uint64, sorted within each root's range ``roots[r]:roots[r+1]``;
    their low ``bits`` bits are walked from the highest down.  The frontier of
    node pairs is kept on a stack of pieces of at most ``room`` pairs, deepest
    first, so memory stays bounded.
    """
    n = len(keys)
    if n < 2:
        return
    size = np.diff(roots)
    a = roots[:-1][size > 1]
    z = roots[1:][size > 1]
    cost = np.zeros(len(a), np.int8)
    stack = [(bits - 1, a, z, a, z, cost)]
    ones: dict[int, np.ndarray] = {}

    def upto(bit: int) -> np.ndarray:
        if bit not in ones:
            ones[bit] = np.concatenate([[0], np.cumsum((keys >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])
        return ones[bit]

    low = np.uint64((1 << bits) - 1) if bits < 64 else np.uint64(0xFFFFFFFFFFFFFFFF)
    while stack:
        bit, ua, uz, va, vz, cost = stack.pop()
        if len(ua) > room:
            half = len(ua) // 2
            stack.append((bit, ua[half:], uz[half:], va[half:], vz[half:], cost[half:]))
            stack.append((bit, ua[:half], uz[:half], va[:half], vz[:half], cost[:half]))
            continue
        # two single leaves: the rest of both paths at once
        leaf = (uz - ua == 1) & (vz - va == 1) & (ua != va)
        if leaf.any():
            i, j = ua[leaf], va[leaf]
            near = np.bitwise_count((keys[i] ^ keys[j]) & low) <= budget
            if near.any():
                yield i[near], j[near]
        go = ~leaf
        ua, uz, va, vz, cost = ua[go], uz[go], va[go], vz[go], cost[go]
        if not len(ua) or bit < 0:
            continue
        c = upto(bit)
        um, vm = uz - (c[uz] - c[ua]), vz - (c[vz] - c[va])  # where the ones begin
        same = ua == va
        other = ~same
        parts = [(ua, um, va, vm, cost), (um, uz, vm, vz, cost), (ua, um, vm, vz, cost + 1),
                 (um[other], uz[other], va[other], vm[other], cost[other] + 1)]
        ua, uz, va, vz, cost = (np.concatenate(x) for x in zip(*parts))
        go = (cost <= budget) & (uz > ua) & (vz > va) & ~((ua == va) & (uz - ua == 1))
        if go.any():
            stack.append((bit - 1, ua[go], uz[go], va[go], vz[go], cost[go]))


def least_linked(keys: np.ndarray, roots: np.ndarray, budget: int, bits: int) -> np.ndarray:
    """For each key the index of a representative of its group among the keys of its root (union-find)."""
    up = np.arange(len(keys))
    for i, j in trie_pairs(keys, roots, budget, bits):
        while True:  # unite whole batches: hook the larger root to the smaller, then shorten paths
            a, b = up[i], up[j]
            low, high = np.minimum(a, b), np.maximum(a, b)
            if (low == high).all():
                break
            np.minimum.at(up, high, low)
            while (up != up[up]).any():
                up = up[up]
    return up


def _rotations(budget: int) -> list[tuple[int, int]]:
    """(left rotation, width) of each block of bits, highest first."""
    cuts = [round(64 * k / (budget + 1)) for k in range(budget + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return x if r == 0 else (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def trie_links(fps: DataFrame, budget: int, max_node: int = 100_000) -> DataFrame:
    """``a, b`` (b < a): edges between distinct fingerprints that connect every group within ``budget`` bits.

    ``fps`` has one column ``fp``, distinct longs.
    """
    blocks = _rotations(budget)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            for k, (r, width) in enumerate(blocks):
                x = _rotl(fp, r)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(fp), k, np.int32)), pa.array((x >> np.uint64(64 - width)).view(np.int64)),
                     pa.array((x & np.uint64((1 << (64 - width)) - 1)).view(np.int64)), b.column(0)],
                    names=["k", "node", "rest", "fp"])

    units = fps.select("fp").mapInArrow(dealt, "k int, node long, rest long, fp long")
    hot = (units.groupBy("k", "node").count().where(F.col("count") > max_node)
           .select("k", "node", F.lit(True).alias("hot")))
    hot = written(hot, "simhash-hot")
    if hot.isEmpty():
        units = units.withColumn("sub", F.lit(-1)).withColumn("subnode", F.lit(0).cast("long"))
    else:
        # split exactly again: the remaining bits also agree on one of their blocks
        wide = 64 - blocks[0][1]
        cuts = [round(wide * k / (budget + 1)) for k in range(budget + 2)]
        again = F.array(*[F.struct(F.lit(k).alias("sub"), F.shiftrightunsigned("rest", lo).bitwiseAND(
            F.lit((1 << (hi - lo)) - 1)).alias("subnode")) for k, (lo, hi) in enumerate(zip(cuts, cuts[1:]))])
        once = F.array(F.struct(F.lit(-1).alias("sub"), F.lit(0).cast("long").alias("subnode")))
        units = (units.join(hot, ["k", "node"], "left")
                 .withColumn("s", F.explode(F.when(F.col("hot"), again).otherwise(once)))
                 .select("k", "node", "rest", "fp", "s.sub", "s.subnode"))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole units, gathered from the sorted partition into arrays of many units at a time."""
        held: list[pa.Table] = []
        rows = 0

        def links(t: pa.Table) -> pa.RecordBatch:
            cols = {c: t.column(c).to_numpy() for c in t.column_names}
            new = np.zeros(t.num_rows, bool)
            for c in ("k", "node", "sub", "subnode"):
                new[1:] |= cols[c][1:] != cols[c][:-1]
            roots = np.concatenate([[0], np.flatnonzero(new), [t.num_rows]])
            up = least_linked(cols["rest"].view(np.uint64), roots, budget, 64)
            i = np.flatnonzero(up != np.arange(len(up)))
            a, b = cols["fp"][i], cols["fp"][up[i]]
            return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"])

        def last_unit(t: pa.Table) -> int:
            """Where the last unit begins: it may go on in the next batch."""
            at = 0
            for c in ("k", "node", "sub", "subnode"):
                x = t.column(c).to_numpy()
                step = np.flatnonzero(x[1:] != x[:-1])
                at = max(at, int(step[-1]) + 1 if len(step) else 0)
            return at

        for b in batches:
            if not b.num_rows:
                continue
            held.append(pa.Table.from_batches([b]))
            rows += b.num_rows
            if rows >= 2 * max_node or len(held) > 64:
                t = pa.concat_tables(held)
                at = last_unit(t)
                if at:
                    yield links(t.slice(0, at))
                held = [t.slice(at)]
                rows = held[0].num_rows
        if rows:
            yield links(pa.concat_tables(held))

    key = ["k", "node", "sub", "subnode"]
    return (units.repartition(shuffle_partitions(fps.sparkSession), *key)
            .sortWithinPartitions(*key, "rest")
            .mapInArrow(walk, "a long, b long").distinct())


def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """``node, root``: the least node of each node's component, by large-star and small-star rounds.

    Every round is written to the shared folder; no link set reaches the
    driver, only each round's counts do.  A star's centre may be hot: its
    edges are only aggregated (min, pre-combined) and joined, never collected.
    """
    e = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(),
                "components")
    for _ in range(rounds):
        # large star: every neighbour above a node hangs on the least node around it
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        # small star: a node and its smaller neighbours hang on the least of them
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                 .unionByName(down.select("a", F.col("m").alias("b"))).distinct())
        after = written(small, "components")
        if after.exceptAll(e).isEmpty() and e.exceptAll(after).isEmpty():
            break
        e = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))


def rooted(own: DataFrame, budget: int) -> DataFrame:
    """``fp, least, root``: ``own`` (``fp, least``, distinct fingerprints) with the root of each fingerprint's group."""
    comp = components(trie_links(own.select("fp"), budget))
    return written(own.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")), "simhash-groups")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    budget: int = 3) -> DataFrame:
    """``id_col, fingerprint, component_id``: one row per row of ``docs``.

    ``fingerprint`` is 16 lowercase hex digits; ``component_id`` is the least
    id reachable over links of at most ``budget`` differing bits, the row's own
    included.  A null or wordless text has fingerprint zero, linked like any
    other.  Equal texts share a fingerprint and so a component; repeated rows
    stay repeated; null ids are skipped in the least (null only if all are).
    No documents give no rows.  Other columns are ignored.
    """
    fp = written(fingerprints(docs, id_col, text_col, shingle), "simhash-fps")
    grouped = rooted(fp.groupBy("fp").agg(F.min("doc").alias("least")), budget)
    best = grouped.groupBy("root").agg(F.min("least").alias("component"))
    named = grouped.join(best, "root").select("fp", "component")
    return fp.join(named, "fp").select(
        F.col("doc").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
             budget: int = 3, id_once: bool = True) -> DataFrame:
    """One row of each group of ``docs``, of the group's least id, all columns kept.

    Rows with a null id stay only if no row of their group has an id, and then one of them.
    Of different texts with the least id, that of the least digest stays.  With
    ``id_once`` an id (null is none) that is the least of several groups stays in
    one of them only; without, every group keeps its row, so ids may repeat.
    """
    fp = written(fingerprints(docs, id_col, text_col, shingle, keyed=True), "simhash-fps")
    # equal id and text: equal rows but for other columns, counted and later cut to one
    row = F.struct(F.col("doc").isNull().alias("none"), "doc", "key", "rows")
    own = (fp.groupBy("fp", "doc", "key").agg(F.count(F.lit(1)).alias("rows"))
           .groupBy("fp").agg(F.min(row).alias("least")))
    best = rooted(own, budget).groupBy("root").agg(F.min("least").alias("row")).select("row.*")
    if id_once:
        best = best.where("none").unionByName(best.where("not none").groupBy("doc").agg(
            F.min(F.struct("none", "doc", "key", "rows")).alias("row")).select("row.*"))
    stay = written(best.select(F.col("doc").alias("_near_dup_id"), F.col("key").alias("_near_dup_key"),
                               F.col("rows").alias("_near_dup_rows")), "simhash-stay")

    def rows(which: DataFrame) -> DataFrame:
        # the rows that stay grow with the corpus: merged, never broadcast, whatever the size
        return docs.join(which.hint("merge"), F.col(id_col).eqNullSafe(F.col("_near_dup_id"))
                         & (text_key(text_col) == F.col("_near_dup_key")), "left_semi")

    again = stay.where("_near_dup_rows > 1")
    if again.isEmpty():
        return rows(stay)
    cut = "_near_dup_key"
    return rows(stay.where("_near_dup_rows = 1")).unionByName(
        rows(again).withColumn(cut, text_key(text_col)).dropDuplicates([id_col, cut]).drop(cut))

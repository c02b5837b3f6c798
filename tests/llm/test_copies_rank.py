"""Exact dedup, centroid clustering and ranked search: brute force on small and messy tables."""
import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnspark.llm import centroids, exact, lexical, queries as Q

from .conftest import CLASH, SF, messy_rows


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def brute_groups(rows):
    of = defaultdict(list)
    for d, t in rows:
        of[norm(t)].append(d)
    out = Counter()
    for d, t in rows:
        ids = [x for x in of[norm(t)] if x is not None]
        out[d, min(ids, default=None), len(of[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()] += 1
    return out


def test_golomb_round_trip():
    rng = np.random.default_rng(3)
    for n, top in ((1, 5), (1, 1 << 55), (1000, 1001), (5000, 1 << 40), (3, 1 << 50)):
        v = np.unique(rng.integers(0, top, n).astype(np.uint64))
        assert (exact.ungolomb(exact.golomb(v)) == v).all()
    many = np.unique(rng.integers(0, 1 << 32, 100_000).astype(np.uint64))
    assert len(exact.golomb(many)) < 2.4 * len(many)  # 4 bytes plain


@pytest.mark.parametrize("spare", [8, -9])  # -9: short fingerprints of different texts meet all the time
def test_exact_groups(spark, messy, empty, monkeypatch, spare):
    monkeypatch.setattr(exact, "SPARE_BITS", spare)
    monkeypatch.setattr(exact, "OWNED", 16)
    if spare < 0:
        monkeypatch.setattr(exact.Ranges, "short", lambda self, fp: fp.to_numpy().view(np.uint64) & np.uint64(15))
    rows = messy_rows()
    got = exact.exact_groups(messy).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == brute_groups(rows)
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len({norm(t) for _, t in rows})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    assert exact.exact_groups(empty).collect() == []


def test_one_hash_for_different_texts(spark):
    """All in one 64-bit fingerprint: the bytes alone tell texts apart."""
    rows = [(i, f"text {i % 7}") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    old, F.xxhash64 = F.xxhash64, lambda *_: F.lit(1).cast("long")
    try:
        got = exact.exact_groups(docs).collect()
    finally:
        F.xxhash64 = old
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == brute_groups(rows)


def test_drop_copies_keeps_rows_as_they_were(spark, messy):
    out = exact.drop_copies(messy)
    assert out.columns == messy.columns
    rows = out.collect()
    assert len({norm(r.text) for r in rows}) == len(rows) == len({norm(t) for _, t in messy_rows()})
    assert all(r[c] == f"x-{c}" for r in rows for c in CLASH)
    words = spark.createDataFrame([("b", "x  y"), ("a", "x\ty"), (None, "x y"), ("c", None), ("d", "")], "doc_id string, text string")
    assert {r.doc_id for r in exact.drop_copies(words).collect()} == {"a", "c"}


def test_exchange_moves_no_text_of_lone_rows(spark):
    """The rows' table is read in place: neither what is sent nor the bits shuffle it."""
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(100)], "doc_id long, text string")
    plan = exact.exact_groups(docs)._jdf.queryExecution().executedPlan().toString()
    lone = plan.split("Union")[1].split("SortMergeJoin")[0]
    assert lone.count("Bucketed: true") >= 1 or "SelectedBucketsCount" in lone


def brute_clusters(rows, k, rounds, size):
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), np.array(v, "<i4").tobytes().hex(), v) for i, v in kept if i is not None)
    cs = [v for _, _, v in order][:k]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    near = lambda v: min((far(v, c), n) for n, c in enumerate(cs))
    for _ in range(rounds):
        own = defaultdict(list)
        for _, v in kept:
            own[near(v)[1]].append(v)
        for n, vs in own.items():
            cs[n] = [sum(x) // len(vs) for x in zip(*vs)]
    out = [(i, *near(v)[::-1]) for i, v in kept]
    per = Counter()
    for _, n, d in out:
        per[n] += d
    return Counter((i, n, d, per[n], sum(per.values()), hashlib.sha256(",".join(map(str, cs[n])).encode()).hexdigest()) for i, n, d in out)


def vectors():
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 4).astype(np.float32)]) for i in range(120)]
    rows += [(200 + i, [0.0, 0.0, 0.0, 0.0]) for i in range(40)]  # ties between equal centroids
    rows += [(300, None), (301, [1.0]), (302, []), (303, [1.0, None, 2.0, 3.0]), (304, [1.0, float("nan"), 2.0, 3.0]),
             (305, [1.0, float("inf"), 2.0, 3.0]), (5, rows[5][1]), (6, [9.0, 9.0, 9.0, 9.0]), (None, [0.5, 0.5, 0.5, 0.5])]
    return rows


@pytest.mark.parametrize("k", [1, 3, 12, 500])
def test_clusters_against_brute_force(spark, k):
    rows = vectors()
    if k > len(rows):
        rows = [r for r in rows if r[0] is not None]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3).withColumns(
        {c: F.lit(1) for c in ("vec", "v", "cluster", "distance")})
    got = centroids.cluster(table, k=k, rounds=3, size=4).collect()
    assert Counter(map(tuple, got)) == brute_clusters(rows, k, 3, 4)


def test_clusters_of_nothing_and_of_too_large_numbers(spark):
    none = spark.createDataFrame([(1, None), (2, [1.0])], "vec_id long, embedding array<double>")
    assert centroids.cluster(none, size=4).collect() == []
    assert centroids.cluster(none.where("1 = 0"), size=4).collect() == []
    with pytest.raises(Exception, match="no exact 64-bit distance"):
        centroids.cluster(spark.createDataFrame([(1, [1e30])], "vec_id long, embedding array<double>"), size=1).collect()


def test_tournament_equals_argmin():
    rng = np.random.default_rng(0)
    for _ in range(50):
        c = rng.integers(-3, 4, (9, 3))
        x = rng.integers(-4, 5, (200, 3))
        d = ((x[:, None] - c[None]) ** 2).sum(2)
        b = centroids.Bisectors(c)
        assert (b.winners(x) == d.argmin(1)).all()
        assert (b.distances(x, b.winners(x)) == d.min(1)).all()


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute_search(docs, items, top):
    bags = [(d, Counter(TERM.findall(low(t)))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n, total = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = defaultdict(Counter)
    for i, t in items:
        asked[i].update(TERM.findall(low(t)))
    out = Counter()
    for item, q in asked.items():
        found = []
        for d, b in bags:
            m = 75 + 25 * b.total() * n // total
            s = sum(c * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 12 * m))
                    for t, c in q.items() if t in b)
            if s > 0:
                found.append((-s, d is None, d if d is not None else 0, d))
        for rank, (s, _, _, d) in enumerate(sorted(found)[:top], 1):
            out[item, rank, d, -s] += 1
    return out


@pytest.mark.parametrize("small", [False, True])
def test_search_against_brute_force(spark, messy, empty, sample, monkeypatch, small):
    if small:  # many segments and blocks, several rounds of items
        monkeypatch.setattr(lexical, "SEGMENT_DOCS", 16)
        monkeypatch.setattr(lexical, "QUERY_TERMS", 40)
        monkeypatch.setattr(lexical, "_CHUNK", 50)
    rows = messy_rows()
    items = [(i, rows[i][1][:150]) for i in range(12)] + [(50, None), (51, ""), (52, "?!"), (53, "the THE x"), (None, rows[0][1]),
                                                         (3, rows[9][1][:80]), (54, "É ß 2"), (55, "never-seen-before")]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit(1) for c in ("item", "term", "rank", "doc_id")})
    for top in (1, 3, 20):
        assert Counter(map(tuple, lexical.search(messy, asked, top=top, block=4 if small else 128).collect())) == brute_search(rows, items, top)
    assert lexical.search(empty, asked).collect() == []
    assert lexical.search(messy, asked.where("1 = 0")).collect() == []
    if not small:
        import pyarrow.parquet as pq
        bench = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
        docs = [(r["doc_id"], r["text"]) for r in sample]
        assert Counter(map(tuple, Q.op13_lexical(spark, SF).collect())) == brute_search(docs, bench, 20)


def test_packed_numbers():
    rng = np.random.default_rng(1)
    v = np.concatenate([rng.integers(0, 1 << b, 50) for b in (1, 7, 8, 14, 20, 35, 50)])
    raw, size = lexical.pack(v)
    assert len(raw) == size.sum() and (lexical.unpack(raw) == v).all()


def test_blocks_are_rejected_unopened():
    """A rare term decides; of the common term's blocks only those with a candidate are decompressed."""
    n = 4096
    lengths = np.full(n, 50, np.int64)

    def postings(docs, tf, weight):
        docs, tf = np.array(docs), np.array(tf)
        first = np.arange(len(docs)) % lexical.BLOCK == 0
        raw, size = lexical.pack(np.stack([np.where(first, docs, np.diff(docs, prepend=0)), tf], 1).ravel())
        begin = np.flatnonzero(first)
        ends = np.cumsum(size)
        row = {"last": docs[np.append(begin[1:], len(docs)) - 1].astype("<i4").tobytes(), "cut": (ends - size)[2 * begin].astype("<i4").tobytes(),
               "postings": raw.tobytes(), "df": len(docs), "fronts": np.ones(len(begin), "<i4").tobytes(),
               "front": np.stack([np.maximum.reduceat(tf, begin), np.full(len(begin), 50)], 1).astype("<i8").tobytes()}
        return lexical.Postings(row, weight, lengths, n, 50 * n)

    rare = postings(range(0, 30), [1] * 30, 5000)
    common = postings(range(n), [1] * n, 10)
    seen = Counter()
    docs, scores = lexical.best([(common, 1), (rare, 1)], n, 20, seen)
    assert docs.tolist() == list(range(30)) and len(set(scores.tolist())) == 1
    assert seen["blocks"] == 32 and seen["opened"] == 1 and common.read.sum() == 1


def test_no_machine_local_names_are_left(spark, messy):
    exact.exact_groups(messy).count()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(("exact_rows", "lexical_index"))]

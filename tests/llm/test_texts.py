"""SimHash, fingerprints, substring dedup, quality, secrets: brute force on small and messy tables."""
import base64
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from churnspark.llm import multiset, quality_net, quality_rules, queries as Q, secrets, simhash, suffix

from .conftest import CLASH, SF, messy_rows

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute_simhash(text, size=3):
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    w = WORD.findall(low)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + size]), 42) for i in range(max(1, len(w) - size + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, budget=3):
    fp = [brute_simhash(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if bin(fp[i] ^ fp[j]).count("1") <= budget:
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return Counter((d, f"{fp[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows))


def test_simhash_against_brute_force(spark, messy, empty, sample):
    got = Counter(map(tuple, simhash.near_duplicates(messy).collect()))
    assert got == brute_components(messy_rows())
    rows = [(r["doc_id"], r["text"]) for r in sample]
    assert Counter(map(tuple, Q.op2_simhash(spark, SF).collect())) == brute_components(rows)
    assert simhash.near_duplicates(empty).collect() == []
    kept = simhash.keep_one(messy)
    assert kept.columns == messy.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter({c for _, _, c in got})


@pytest.mark.parametrize("budget", [0, 1, 3, 5])
def test_trie_finds_every_pair_also_in_split_nodes(spark, budget):
    rng = np.random.default_rng(budget)
    base = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    near = [base ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (k, 30), dtype=np.uint64)) for k in (1, 2, 3, 4, 5, 6)]
    keys = np.unique(np.concatenate([base, *near]))
    found = {(min(a, b), max(a, b)) for i, j in simhash.trie_pairs(keys, np.array([0, len(keys)]), budget, 64, room=64)
             for a, b in zip(i.tolist(), j.tolist())}
    want = {(i, j) for i in range(len(keys)) for j in range(i + 1, len(keys)) if int(keys[i] ^ keys[j]).bit_count() <= budget}
    assert found == want
    fps = spark.createDataFrame([(int(x),) for x in keys.view(np.int64)], "fp long")
    for most in (100_000, 2):  # 2: nearly every node is split again
        comp = {r.node: r.root for r in simhash.components(simhash.trie_links(fps, budget, max_node=most)).collect()}
        root = [comp.get(int(x), int(x)) for x in keys.view(np.int64)]
        up = list(range(len(keys)))
        for i, j in sorted(want):
            a, b = up[i], up[j]
            up = [a if u == b else u for u in up]
        assert len({(a, b) for a, b in zip(up, root)}) == len(set(up)) == len(set(root))


def test_components_of_a_long_chain(spark):
    n = 300
    order = random.Random(1).sample(range(n), n)
    edges = spark.createDataFrame(list(zip(order, order[1:])) + [(1000, 1001)], "a long, b long")
    comp = {r.node: r.root for r in simhash.components(edges).collect()}
    assert comp == {i: 0 for i in range(1, n)} | {1001: 1000}


def brute_edits(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0), reverse=True)
    out = []
    for (i, t), (_, u) in zip(order, order[1:] + order[:1]):
        t, u = t or "", u or ""
        out.append((i, len(t), hashlib.sha256((t[:len(t) - len(t) // 3] + u[:len(t) // 3]).encode()).hexdigest()))
    return Counter(out)


def test_multiset_fingerprints(spark, messy, empty, sample):
    got = Q.op7_multiset(spark, SF).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == brute_edits([(r["doc_id"], r["text"]) for r in sample])
    rows = multiset.edit_fingerprints(messy).collect()
    assert Counter((r.doc_id, r.n_chars) for r in rows) == Counter((i, len(t or "")) for i, t in messy_rows())
    unique = [r for r in messy_rows() if r[0] is not None and r[0] not in (3, 4)]
    one = spark.createDataFrame(unique, "doc_id long, text string")
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in multiset.edit_fingerprints(one).collect()) == brute_edits(unique)
    text = dict(messy_rows()[:-1])
    by = {r.doc_id: r.fingerprint for r in rows}
    assert by[200] == by[201] == by[0] and len({by[i] for i in range(40)}) == 40 and text
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert multiset.edit_fingerprints(empty).collect() == []
    lone = spark.createDataFrame([(5, "abc. def")], "doc_id long, text string")
    assert multiset.edit_fingerprints(lone).first().near_next == 1.0


def test_multiset_is_homomorphic():
    f = lambda t: multiset.to_hex(*multiset.vectors([t]))[0]
    lines = ["One. Two. Three.", "Four, five.", "", "Six. One."]
    whole = f("\n".join(lines))
    assert whole == f("\n".join(reversed(lines)))
    assert whole != f("\n".join(lines + ["x"])) == multiset.insert(whole, ["x"])
    assert multiset.delete(multiset.insert(whole, ["a", "", "b. c."]), ["b. c.", "a", ""]) == whole
    assert multiset.insert(f(""), lines) == whole


def brute_repeats(rows, least, first):
    where = {}
    order = sorted(range(len(rows)), key=lambda k: rows[k][0])
    for k in order:
        t = rows[k][1]
        for j in range(len(t) - least + 1):
            where.setdefault(t[j:j + least], []).append((k, j))
    out = []
    for k, (i, t) in enumerate(rows):
        gone = np.zeros(len(t) + 1, bool)
        for j in range(len(t) - least + 1):
            w = where[t[j:j + least]]
            if len(w) > 1 and (not first or w[0] != (k, j)):
                gone[j:j + least] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        left = bytes(np.frombuffer(t, np.uint8)[~gone[:-1]])
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("keep", ["none", "first"])
def test_substrings_against_brute_force(spark, keep):
    r = random.Random(2)
    rows = [(i, t) for i, t in messy_rows() if i not in (None, 3, 4) and len(t or "") < 3000]
    line = lambda n: "".join(r.choice("ab cde\n") for _ in range(n))
    common = line(230)
    rows += [(1000 + i, line(r.randint(0, 60)) + common + line(r.randint(0, 60))) for i in range(60)]
    rows += [(1100, "z" * 900), (1101, "z" * 400 + "y"), (1102, "q" * 200), (1103, "ab" * 150), (1104, line(199))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_repeats([(i, (t or "").encode()) for i, t in rows], 200, keep == "first")
    got = suffix.dedup_substrings(docs, keep=keep).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want
    for x in got:
        assert hashlib.sha256(x.kept).hexdigest() == x.kept_sha256 and sum(s.end - s.start for s in x.spans) == x.n_removed


@pytest.mark.parametrize("first", [False, True])
def test_hot_anchors_take_the_exact_other_way(spark, first):
    r = random.Random(3)
    line = lambda n: "".join(r.choice("abcdef") for _ in range(n))
    common = line(220)
    rows = [(i, line(r.randint(0, 90)) + common + line(r.randint(0, 90))) for i in range(50)]
    docs = spark.createDataFrame(rows, "place long, text string").withColumn("key", F.col("place"))

    def zip_up(batches):
        import pyarrow as pa
        import zstandard
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([zstandard.compress(t.as_py().encode()) for t in b.column(1)])],
                                             names=["key", "z"])

    zipped = docs.select("key", "text").mapInArrow(zip_up, "key long, z binary")
    runs = [sorted((x.key, tuple(sorted(suffix.covered([tuple(y) for y in x.runs], 200)))) for x in
                   suffix.repeated_runs(docs, zipped, 200, first, max_classes=m).collect()) for m in (2, 4096)]
    assert runs[0] == runs[1] and len(runs[0]) >= 49


def test_substrings_of_messy_rows(spark, messy, empty):
    got = suffix.dedup_substrings(messy, keep="none").collect()
    assert Counter((r.doc_id, r.n_bytes) for r in got) == Counter((i, len((t or "").encode())) for i, t in messy_rows())
    by = {(r.doc_id, r.n_bytes): r for r in got}
    # long periodic texts repeat themselves throughout; rows that repeat remove each other
    assert by[401, 60000].n_removed == 60000 and by[402, 20000].n_removed == 20000
    same = [r for r in got if r.doc_id == 3]
    assert len(same) == 3 and all(r.n_removed == (r.n_bytes if r.n_bytes >= 200 else 0) for r in same)
    assert suffix.dedup_substrings(empty).collect() == []


def test_very_long_text_is_cut_into_exact_segments():
    x = "".join(random.Random(9).choices("abcdefgh ", k=suffix._SEGMENT + 5000)).encode()
    whole = [(at, p) for at, p in suffix._segments(x, 200)]
    assert len(whole) == 2 and b"".join(p[:suffix._SEGMENT] for _, p in whole) == x
    starts = []
    for at, p in whole:
        a = np.frombuffer(p, np.uint8)
        _, s, e, _, _ = suffix.blocks(a, np.array([len(a)]), 200)
        starts += [i + at for lo, hi in zip(s, e) for i in range(lo, hi + 1)]
    assert starts == list(range(len(x) - 199))


def brute_counts(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    hit = {i + k for i in range(len(words) - 4) if grams[tuple(words[i:i + 5])] > 1 for k in range(5)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(hit), n < 10 or 100 * len(hit) > 20 * n)


def test_quality_rules(spark, messy, empty):
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = quality_rules.quality_rules(messy)
    assert Counter(tuple(r[c] for c in cols) for r in got.collect()) == Counter((i, *brute_counts(t)) for i, t in messy_rows())
    assert quality_rules.quality_rules(empty).collect() == []
    found = Q.op10_quality_rules(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    assert all(not (r.base_failed and r.kept) for r in found.collect())
    rate = {r.quality: r.k for r in found.where("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert rate[1] > 0.99 and rate[0] < 0.05


def test_em_learns_who_is_right():
    rng = np.random.default_rng(4)
    good = rng.random(20000) < 0.8
    votes = np.zeros((20000, 4), int)
    for j, (acc, speaks) in enumerate([(0.95, 0.9), (0.9, 0.7), (0.6, 0.8), (0.85, 0.3)]):
        right = rng.random(20000) < acc
        votes[:, j] = np.where(rng.random(20000) < speaks, np.where(right == good, 1, -1), 0)
    patterns, back, times = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    p, share, post = quality_rules.fit_accuracies(patterns, times.astype(float))
    assert abs(share - 0.8) < 0.05 and ((post[back] > 0.5) == good).mean() > 0.9
    assert p[0, 1, 2] > p[2, 1, 2] * 0.9


def test_quality_net(spark, messy, empty):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = quality_net.quality_net(messy, labels, max_rows=50).collect()
    assert len(out) == len(messy_rows()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert quality_net.quality_net(empty, labels).collect() == []
    assert quality_net.quality_net(messy, labels.where("1 = 0")).count() == len(messy_rows())
    scored = Q.op4_quality_net(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    held = scored.where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in held]) > 0.93
    assert np.mean([r.predicted for r in held if r.quality == 1]) > 0.97


def test_net_pools_whole_texts_in_blocks(monkeypatch):
    net = quality_net.Net.fresh(np.random.default_rng(0))
    texts = ["", "short", "a b c " * 4000, None, "Z" * 999]
    want = quality_net.scores(net, texts)
    monkeypatch.setattr(quality_net, "BLOCK", 64)
    assert np.allclose(quality_net.scores(net, texts), want, atol=1e-5)
    end = quality_net.chunks(b"x" * 17)
    assert end.shape == (2, 16) and end[1, 8] == ord("x") and end[1, 9] == 256


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute_spans(t):
    t = t or ""
    kinds = [("assign", ASSIGN, lambda m: len(m[2]) >= 6), ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
             ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)]
    return sorted((m.start(), k, m.end()) for k, (_, p, ok) in enumerate(kinds) for m in p.finditer(t) if ok(m))


TRICKY = ["token=token : abcdefgh", "PassWord: 'hunter22' token= short", "api_key==abcdef", "é token = \"" + "a1" * 20 + "\" AKIA" + "B2" * 9,
          "AKIAAKIA" + "Z" * 11 + " AKIA" + "Z" * 16, "f" * 24 + "g" + "0" * 23, "secret=" + "x" * 6 + "secret=yyyyyy", "😀😀 apikey:abc.def", ""]


def test_secrets_against_re(spark, empty, sample):
    rows = messy_rows() + [(500 + i, t) for i, t in enumerate(TRICKY)]
    rows += [(10_000 + r["doc_id"], r["text"]) for r in sample] + [(600, "end " + base64.b64encode(hashlib.sha256(b"q").digest()).decode() + " x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(c) for c in CLASH})
    found = secrets.scan_secrets(docs.drop("secret_spans")).collect()
    assert Counter((r.doc_id, tuple((s.start, s.kind, s.end) for s in r.secret_spans if s.kind < 3)) for r in found) == Counter(
        (i, tuple(brute_spans(t))) for i, t in rows)
    assert [s.kind for r in found if r.doc_id == 600 for s in r.secret_spans] == [3]
    assert not any(s.kind == 3 for r in found if (r.doc_id or 0) < 200 for s in r.secret_spans)
    assert secrets.secret_digest(empty).collect() == []
    clean = secrets.redact(docs)
    assert clean.columns == docs.columns
    text = {r.doc_id: r.text for r in clean.collect()}
    assert text[500 + 3] == 'é [SECRET]" [SECRET]' and text[600] == "end [SECRET] x" and text[1] == dict(rows)[1]
    assert text[300] is None


def test_secret_sample_counts_different_texts(spark):
    docs = spark.range(400 * 60).select((F.col("id") % 60).cast("string").alias("text"))
    digests = {hashlib.sha256(str(i).encode()).hexdigest() for i in range(60)}

    def drawn(**how):
        words = [r.word for r in secrets.labelled_samples(docs, "text", **how).where("random").collect()]
        return [w for w in words if w in digests]
    assert Counter(drawn(sample_rows=300)) == Counter(digests)
    assert len(set(drawn(sample_rows=7))) == len(drawn(sample_rows=7)) == 7
    assert 7 < len(drawn(sample_rows=7, share=0.5)) < 60 and len(drawn(sample_rows=7, share=1.0)) == 60


def test_secret_beyond_a_base_span_is_found(spark, sample):
    key = "/" + base64.b64encode(hashlib.sha256(b"k").digest()).decode().rstrip("=")
    access = "AKIA" + "Q7" * 8
    mixed = "Zk4Q" + hashlib.sha256(b"h").hexdigest()[:24] + "Xw9RtB"
    rows = [(1, f"a {access}{key} b"), (2, f"c {mixed} d"), (3, f"e {access} f")]
    docs = spark.createDataFrame(rows + [(100 + r["doc_id"], r["text"]) for r in sample], "doc_id long, text string")
    found = {r.doc_id: [(s.start, secrets.KINDS[s.kind], s.end) for s in r.secret_spans] for r in secrets.scan_secrets(docs).collect()}
    assert found[1] == [(2, "access", 22), (22, "markov", 22 + len(key))] and found[3] == [(2, "access", 22)]
    assert found[2] == [(2, "markov", 6), (6, "hex", 30), (30, "markov", 36)]
    text = {r.doc_id: r.text for r in secrets.redact(docs).collect()}
    assert text[1] == "a [SECRET][SECRET] b" and text[2] == "c [SECRET][SECRET][SECRET] d"


@pytest.mark.parametrize("id_once", [True, False])
def test_one_row_of_each_group_stays_whatever_its_id(spark, id_once):
    r = random.Random(9)
    a, b, c, d, e, f = (" ".join(str(r.random()) for _ in range(30)) for _ in range(6))
    rows = [(None, a), (None, a), (None, b), (None, b.replace(" ", "  ")), (None, c), (7, d), (None, d),  # null ids
            (8, e), (8, e), (8, f), (2, a + " "), (8, a)]  # 8: the least of two groups, and a copy in 2's
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, n int").repartition(3)
    kept = simhash.keep_one(docs, id_once=id_once)
    assert kept.columns == docs.columns
    got = [(x.doc_id, " ".join(x.text.split())) for x in kept.collect()]
    eight = [x for x in got if x[0] == 8]
    assert Counter(x for x in got if x[0] != 8) == Counter([(2, a), (None, b), (None, c), (7, d)])
    assert len(eight) == 1 and eight[0] in [(8, e), (8, f)] if id_once else Counter(eight) == Counter([(8, e), (8, f)])


def test_hot_ids_and_hot_texts_are_spread(spark):
    """A third of the rows has no id, another third repeats one row: both in many tasks, in the order as told."""
    r = random.Random(6)
    rows = [(None, f"{r.random()} a. b") for _ in range(500)] + [(7, "the same words. again")] * 500 + [(7, "another")] * 3
    rows += [(i, f"{r.random()} c") for i in range(20, 520)]
    r.shuffle(rows)

    def brute():
        def place(x):
            h = xxhash.xxh64_intdigest(x[1].encode(), 42)
            return (x[0] is None, -(x[0] or 0), h - (1 << 64) if h >> 63 else h)
        order = sorted(rows, key=place)
        return Counter((i, len(t), hashlib.sha256((t[:len(t) - len(t) // 3] + u[:len(t) // 3]).encode()).hexdigest())
                       for (i, t), (_, u) in zip(order, order[1:] + order[:1]))

    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = multiset.edit_fingerprints(docs).withColumn("part", F.spark_partition_id()).collect()
    assert Counter((x.doc_id, x.n_chars, x.edited_sha256) for x in out) == brute()
    for own in (None, 7):
        sizes = Counter(x.part for x in out if x.doc_id == own)
        assert len(sizes) >= 2 and max(sizes.values()) < 400, sizes


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 200])
def test_running_sums_and_maxima(spark, n):
    r = random.Random(n)
    v = [r.randint(-50, 50) for _ in range(n)]
    df = spark.createDataFrame([(v,)], "v array<int>")
    got = df.select(secrets.running(F.col("v"), lambda a, b: a + b, 8).alias("s"), secrets.running(F.col("v"), F.greatest, 8).alias("m")).first()
    assert got.s == np.cumsum(v).tolist() and got.m == np.maximum.accumulate(v).tolist()


def test_uncovered_pieces_against_characters(spark):
    r = random.Random(4)
    rows = []
    for i in range(60):
        at, runs = 0, []
        for _ in range(r.randint(0, 12)):
            at += r.randint(1, 9)
            runs.append((at, 3, at := at + r.randint(1, 20)))
        base = sorted((s, r.randint(0, 2), s + r.randint(1, 15)) for s in (r.randint(0, 200) for _ in range(r.randint(0, 12))))
        rows.append((i, runs, base))
    df = spark.createDataFrame(rows, f"i int, runs {secrets.SPAN}, base {secrets.SPAN}")
    got = {x.i: [(p.start, p.end) for p in x.p] for x in df.select("i", secrets._uncovered(F.col("runs"), F.col("base")).alias("p")).collect()}
    for i, runs, base in rows:
        held = {c for s, _, e in base for c in range(s, e)}
        want = []
        for s, _, e in runs:
            for c in range(s, e):
                if c not in held:
                    if want and want[-1][1] == c and c != s:
                        want[-1] = (want[-1][0], c + 1)
                    else:
                        want.append((c, c + 1))
        assert got[i] == want


def test_secrets_are_linear_in_the_spans_of_a_text(spark):
    import time
    n = 100_000
    text = "".join(f"token=aZ9{i:06d}kQ\n" for i in range(n // 2)) + "é\n" + "".join(f"secret: {i:06d}xy {i:024x}\n" for i in range(n // 4))
    docs = spark.createDataFrame([(1, text), (2, "plain")], "doc_id long, text string")
    began = time.time()
    row = {r.doc_id: r for r in secrets.secret_digest(docs).collect()}[1]
    took = time.time() - began
    assert (row.n_assign, row.n_access, row.n_hex) == (n // 2 + n // 4, 0, n // 4)
    assert row.base_sha256 == hashlib.sha256(",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in brute_spans(text)).encode()).hexdigest()
    assert took < 30, took
    began = time.time()
    clean = {r.doc_id: r.text for r in secrets.redact(docs).collect()}
    assert clean[2] == "plain" and clean[1].startswith("[SECRET]\n[SECRET]\n") and clean[1].count("[SECRET]") >= n
    assert "token=" not in clean[1] and "é\n" in clean[1] and time.time() - began < 30


def plain_logit(net, text):
    """The network in loops, double precision."""
    raw, embed = text.encode(), net.embed.astype(float)
    n = max(1, -(-max(0, len(raw) - quality_net.WIDTH) // quality_net.STRIDE) + 1)
    responses = []
    for c in range(n):
        at = c * quality_net.STRIDE
        row = [raw[i] if i < len(raw) else 256 for i in range(at, at + quality_net.WIDTH)]
        x = [v for b in row for v in embed[b]]
        responses.append([max(0.0, sum(a * w for a, w in zip(x, net.filters[:, k].astype(float))) + float(net.bias[k]))
                          for k in range(len(net.bias))])
    top = [max(r[k] for r in responses) for k in range(len(net.bias))]
    return sum(w * v for w, v in zip(net.weights.astype(float), top)) + net.offset


QUALITY = ["Plain words in a row, nothing odd here.", "### $$$ buy now !!! %%%", "", "a", "Ein Satz. Noch ein Satz, é ü.", "x" * 40 + " end"]


def test_quality_scores_against_plain_loops():
    net = quality_net.Net.fresh(np.random.default_rng(3))
    net.offset = 0.3
    got = quality_net.scores(net, QUALITY)
    assert np.allclose(got, [1 / (1 + np.exp(-plain_logit(net, t))) for t in QUALITY], atol=1e-5)


def test_quality_gradient_against_finite_differences():
    """Adam's first step moves every parameter by the rate, against the sign of its gradient."""
    labels, rate = [1, 0, 0, 1, 1, 0], 1e-3
    net = quality_net.Net.fresh(np.random.default_rng(7))
    net.offset = float(np.log((sum(labels) + 1) / (len(labels) - sum(labels) + 1)))
    moved = quality_net.fit(QUALITY, labels, epochs=1, batch=len(labels), rate=rate, seed=7)

    def loss():
        z = [plain_logit(net, t) for t in QUALITY]
        return sum(np.logaddexp(0, -v) if y else np.logaddexp(0, v) for v, y in zip(z, labels)) / len(z)

    rng, checked = np.random.default_rng(0), 0
    used = sorted(set("".join(QUALITY).encode())) + [256]
    for name in ("embed", "filters", "bias", "weights"):
        old, new = getattr(net, name), getattr(moved, name)
        places = [(used[rng.integers(len(used))], rng.integers(old.shape[1])) for _ in range(12)] if name == "embed" else [
            tuple(rng.integers(n) for n in old.shape) for _ in range(12)]
        for at in places:
            keep, ends = old[at], []
            for step in (1e-3, -1e-3):
                old[at] = keep + step
                ends.append((loss(), float(old[at])))
            old[at] = keep
            slope = (ends[0][0] - ends[1][0]) / (ends[0][1] - ends[1][1]) + (1e-4 * float(keep) if name == "weights" else 0)
            if abs(slope) > 1e-4:
                assert abs(float(new[at] - keep) + rate * np.sign(slope)) < 0.05 * rate, (name, at, slope)
                checked += 1
    assert checked >= 30

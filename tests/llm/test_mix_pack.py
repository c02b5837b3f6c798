"""Mixing, packing and the pipeline."""
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from churnspark.llm import mixing, packing, queries as Q

from .conftest import SF, messy_rows

TOKENS = Tokenizer.from_file(Q.tokenizer_file())


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=300))
def test_ranks_give_the_tokenizers_ids(text):
    assert packing.encoder(Q.tokenizer_file()).encode(text, allowed_special="all") == TOKENS.encode(text, add_special_tokens=False).ids


BLANKS = [" ", "\t", "\n", "\u3000"]


def test_long_runs_of_blanks_give_the_tokenizers_ids():
    """Beyond some 600,000 blanks the fast encoder's pattern gives up; nothing may be lost or changed there."""
    path, n = Q.tokenizer_file(), 1_200_000
    texts = [b * n for b in BLANKS[:2]] + ["a" + " " * n, "\n" * n + "word", "one" + "\t " * (n // 2) + "two  three", "é" + "\u3000" * 200_000 + "<|x"]
    short = [x + b * k + y for b in BLANKS for k in (1, 2, 49_999, 50_001) for x, y in (("a", "b"), ("", "1"), (".", ""))]
    for t in texts + short:
        assert packing.token_ids(path, t) == TOKENS.encode(t, add_special_tokens=False).ids


def test_a_text_of_blanks_is_packed(spark):
    rows = [(1, "x" + " " * 1_000_000 + "y"), (2, "\n" * 700_000), (3, "z" * 300_000), (4, "plain words")]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), Q.tokenizer_file(), 1024).collect()
    check_pack(out, rows, 1024)


def check_pack(out, rows, capacity):
    per, seq = defaultdict(list), defaultdict(list)
    for r in out:
        per[r.doc_id].append(r)
        seq[r.sequence_id].append((r.offset, r.length))
    for places in seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    want = Counter()
    for i, t in rows:
        ids = np.array([*TOKENS.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for s in range(0, len(ids), capacity):
            part = ids[s:s + capacity]
            want[i, s, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in out) == want
    assert sorted(seq) == list(range(len(seq)))
    return sum(r.length for r in out), len(seq)


def test_packing(spark, messy, empty, sample):
    check_pack(packing.pack(messy, Q.tokenizer_file(), 256).collect(), messy_rows(), 256)
    tokens, n = check_pack(Q.op3_packing(spark, SF).collect(), [(r["doc_id"], r["text"]) for r in sample], 1024)
    assert n <= 1.06 * tokens / 1024 + 1
    assert packing.pack(empty, Q.tokenizer_file()).collect() == []


def test_cutting_stock_covers_demand_and_is_near_the_bound():
    rng = np.random.default_rng(1)
    for m in (1, 5, 30):
        sizes = sorted(rng.choice(np.arange(1, 35), m, replace=False).tolist())
        need = rng.integers(0, 3000, m).tolist()
        used = packing.cutting_stock(sizes, need, 100)
        assert sum(n * p for p, n in used).tolist() == need if used else not any(need)
        assert all((p * sizes).sum() <= 100 and n > 0 for p, n in used)
        if m == 30:
            assert sum(n for _, n in used) <= 1.01 * sum(s * n for s, n in zip(sizes, need)) / 100 + 30
    assert packing.cutting_stock([], [], 100) == []


def test_best_pattern_is_optimal():
    rng = np.random.default_rng(2)
    for _ in range(20):
        sizes, worth = np.sort(rng.choice(np.arange(2, 20), 4, replace=False)), rng.random(4)
        value, counts = packing.best_pattern(packing.copy_steps(sizes, 30), worth, 30)
        best = np.zeros(31)
        for c in range(1, 31):
            best[c] = max([best[c - 1], *[best[c - s] + w for s, w in zip(sizes, worth) if s <= c]])
        assert abs(value - best[30]) < 1e-9 and abs(counts @ worth - value) < 1e-9 and counts @ sizes <= 30


def test_bins_round_up_and_stay_within(spark):
    rows = spark.range(1, 1025).select(F.col("id").alias("l"), packing.bin_of(F.col("id"), 1024).alias("b")).collect()
    assert all(r.l <= r.b <= min(1024, r.l + max(0, r.l // 32)) for r in rows) and len({r.b for r in rows}) <= 256


def test_mixing_meets_targets(spark, messy, empty):
    d = "/root/testdata/sf0.01"
    out = Q.op5_mixing(spark, d).toPandas()
    mass = np.array([(out.tokens * out.rate * out[f"p_{k}"]).sum() for k in Q.MIX_TARGETS])
    assert np.abs(mass / mass.sum() - list(Q.MIX_TARGETS.values())).max() < 0.01
    assert out.rate.between(0, 1).all() and np.allclose(out[[f"p_{k}" for k in Q.MIX_TARGETS]].sum(axis=1), 1)
    lab = spark.read.parquet(f"{d}/labels.parquet").toPandas()
    m = out.merge(lab, on="doc_id")
    assert m[(m.quality == 1) & (m.toxic == 0)].copies.mean() > 0.98 and m[m.quality == 0].copies.mean() < 0.5
    # brute force: projected gradient over all documents, without cells
    p, w = out[[f"p_{k}" for k in Q.MIX_TARGETS]].to_numpy(), out.tokens.to_numpy() / out.tokens.sum()
    goal = np.array(list(Q.MIX_TARGETS.values()))
    goal /= np.linalg.norm(goal)
    r = np.ones(len(w))
    for _ in range(20000):
        s = (w * r) @ p
        r = np.clip(r - p @ (s - (s @ goal) * goal) - 3e-4 * (r - 1), 0, 1)
    assert abs(np.average(r - out.rate, weights=w)) < 0.01 and np.average(np.abs(r - out.rate), weights=w) < 0.05

    labels = spark.createDataFrame([(i, "a" if i % 2 else "b") for i in range(30)], "doc_id long, domain string")
    got = mixing.mix_rates(messy, labels, {"a": 0.5, "b": 0.5})
    assert Counter(r.doc_id for r in got.collect()) == Counter(i for i, _ in messy_rows())
    assert mixing.mix_rates(empty, labels, {"a": 0.5, "b": 0.5}).collect() == []
    assert mixing.mix_rates(messy, labels.where("1 = 0"), {"a": 0.5, "b": 0.5}).count() == len(messy_rows())
    assert mixing.mix(messy, labels, {"a": 0.5, "b": 0.5}).columns == messy.columns


def test_mixing_meets_rare_and_scarce_targets(spark):
    def fitted(tokens, targets):
        names = list(targets)
        cells = spark.createDataFrame([(str(i), n) for i, n in enumerate(tokens)], "_cell string, tokens long")
        labelled = spark.createDataFrame([(str(i), names[i]) for i in range(len(names)) for _ in range(200_000)], "_cell string, _domain string")
        mix = mixing.fit_mix(cells, labelled, {}, targets)
        got = {r._cell: r for r in mix.cells.collect()}
        mass = np.array([sum(n * got[str(c)].rate * got[str(c)].posterior[i] for c, n in enumerate(tokens)) for i in range(len(names))])
        return mass / mass.sum(), [got[str(c)].rate for c in range(len(tokens))]

    for tokens, want in [((985_000, 5_000, 10_000), (0.994, 0.001, 0.005)), ((990_000, 10_000), (0.95, 0.05))]:
        shares, rates = fitted(tokens, dict(zip("abc", want)))
        assert np.abs(shares / want - 1).max() <= 0.01 and max(rates) == 1.0, (shares, rates)
    assert fitted((1000, 0), {"a": 0.5, "b": 0.5})[1][0] == 1.0  # nothing of b: a is not held back


def test_a_zero_target_leaves_its_domain_out(spark):
    rows = [(i, ("alpha beta " if i % 3 == 0 else "gamma delta " if i % 3 == 1 else "eta theta ") * (5 + i % 7)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, "abc"[i % 3]) for i in range(300)], "doc_id long, domain string")
    got = {r.doc_id: r for r in mixing.mix_rates(docs, labels, {"a": 0.3, "b": 0.7, "c": 0.0}).collect()}
    assert all(r.rate == 0 and r.copies == 0 for i, r in got.items() if i % 3 == 2)
    mass = np.array([sum(r.tokens * r.rate * r.posterior[k] for r in got.values()) for k in (0, 1)])
    assert np.abs(mass / mass.sum() / [0.3, 0.7] - 1).max() <= 0.01 and max(r.rate for r in got.values()) == 1.0
    only = mixing.mix_rates(docs, labels, {"a": 1, "b": 0, "c": 0}).collect()
    assert all((r.rate == 1) == (r.doc_id % 3 == 0) for r in only)
    for bad in ({"a": 0.0, "b": 0.0}, {"a": 1.0, "b": -0.5}):
        with pytest.raises(ValueError, match="target weights"):
            mixing.mix_rates(docs, labels, bad)


@pytest.mark.parametrize("sent", [100_000, 3])
def test_ten_domains_and_cells_that_are_not_broadcast(spark, monkeypatch, sent):
    monkeypatch.setattr(mixing, "SENT_CELLS", sent)
    names = [f"d{i}" for i in range(10)]
    rows = [(i, f"w{i % 10}x w{i % 10}y " * (4 + i % 5)) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, names[i % 10]) for i in range(600)], "doc_id long, domain string")
    want = dict(zip(names, [0.19, 0.01, 0.1, 0.1, 0.1, 0.1, 0.1, 0.1, 0.15, 0.05]))
    got = mixing.mix_rates(docs, labels, want)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan) == (sent > 3)
    got = got.collect()
    mass = np.array([sum(r.tokens * r.rate * r.posterior[k] for r in got) for k in range(10)])
    assert np.abs(mass / mass.sum() / list(want.values()) - 1).max() <= 0.011


def test_pipeline_against_brute_force(spark):
    from churnspark.llm import quality_net
    from .test_texts import brute_components, brute_spans
    d = SF
    docs = {r.doc_id: r for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    labels = spark.read.parquet(f"{d}/labels.parquet")
    table = spark.read.parquet(f"{d}/documents.parquet")
    net = quality_net.trained(table, labels, "doc_id", "text", "quality", 2000, 1 << 16)
    good = [i for i, s in zip(docs, quality_net.scores(net, [r.text for r in docs.values()])) if s >= 0.5]
    stage = {}
    now = table
    for name, f in corpus_pipeline.STAGES:
        now = corpus_pipeline.written(f(spark, now, d), name)
        stage[name] = now
        assert name == "packing" or now.columns == table.columns
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    assert ids(stage["quality"]) == sorted(good)
    groups = brute_components([(i, docs[i].text) for i in good])
    assert ids(stage["near_dups"]) == sorted({c for _, _, c in groups})
    for r in stage["secrets"].collect():
        text, at, out = docs[r.doc_id].text, 0, ""
        for a, _, z in brute_spans(text):
            if a >= at:
                out += text[at:a] + "[SECRET]"
            at = max(at, z)
        assert r.text == out + text[at:] and r.n_chars == len(r.text)
    rates = {r.doc_id: r.copies for r in mixing.mix_rates(stage["secrets"], corpus_pipeline.mix_domains(labels), corpus_pipeline.MIX_TARGETS).collect()}
    assert ids(stage["mixing"]) == sorted(i for i, n in rates.items() for _ in range(n))
    check_pack(stage["packing"].collect(), [(r.doc_id, r.text) for r in stage["mixing"].collect()], 1024)
    key = lambda df: Counter(map(tuple, df.select("doc_id", "start", "length", "ids_crc32").collect()))
    assert key(corpus_pipeline.run(spark, d)) == key(stage["packing"])
    none = table.where("1 = 0")
    for name, f in corpus_pipeline.STAGES:
        assert f(spark, none, d).collect() == []

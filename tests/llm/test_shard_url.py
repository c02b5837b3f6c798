"""Sharding and url filters."""
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from churnspark.llm import queries as Q
from churnspark.llm import shard as S
from churnspark.llm.urlfilter import url_filter

from .conftest import SF, messy_rows


def check_shards(rows, shards, n):
    places = defaultdict(list)
    for r in rows:
        places[r.shard].append(r.slot)
    sizes = [len(places[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == n
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_shards_of_messy_rows(messy, empty):
    for k in (1, 8, 200):
        got = S.shard(messy, k).collect()
        check_shards(got, k, len(messy_rows()))
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in messy_rows())
    assert S.shard(empty, 8).collect() == []


def test_op1_contract(spark, sample):
    df = Q.op1_shard(spark, SF)
    assert df.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    check_shards(df.collect(), 8, len(sample))


def test_hypergeometric_draws_follow_their_law(spark):
    for k, t, n in ((30, 100, 40), (1, 10, 3), (7, 7, 5), (5, 20, 20), (0, 9, 4), (500_000, 4_000_000, 1_000_000)):
        x = spark.range(3000).select(S.hypergeometric(F.lit(k), F.lit(t), F.lit(n), S.uniform(F.col("id"), t)).alias("x")).toPandas().x
        assert x.between(max(0, n + k - t), min(n, k)).all()
        mean, var = n * k / t, n * (k / t) * (1 - k / t) * (t - n) / max(t - 1, 1)
        assert abs(x.mean() - mean) <= 5 * (var / 3000) ** 0.5 + 1e-9
        assert abs(x.var() - var) <= 0.15 * var + 1e-9


def test_matrix_margins_and_spread(spark):
    sizes = [5, 0, 17, 400, 1, 33]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(sizes) if n], "part int, rows long")
    draws = []
    for seed in range(30):
        rows = {r.part: np.diff([0, *r.upto]) for r in S.communication_matrix(df, 3, seed).collect()}
        assert {p: int(v.sum()) for p, v in rows.items()} == {i: n for i, n in enumerate(sizes) if n}
        assert sum(rows.values()).tolist() == [152, 152, 152]
        draws.append(rows[3][0])
    assert np.std(draws) > 2 and abs(np.mean(draws) - 400 / 3) < 4


def brute_rule(url, rules):
    after = url.split("://", 1)[1] if url and "://" in url else None
    host, path = "", ""
    if after is not None:
        cut = min([after.find(c) for c in "/?#" if c in after], default=len(after))
        host, rest = after[:cut], after[cut:]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(len(h), len(p), h + p, v) for h, p, v in rules
            if (h == "" or host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def test_url_rules_against_brute_force(spark):
    rules = [*Q.URL_RULES, ("m.example.com", "/", "block"), ("example.com", "/en/a", "allow"), ("org", "", "block"),
             ("example.com", "/en/a/b", "block"), ("co.uk", "/x", "block")]
    hosts = ["example.com", "www.example.com", "m.example.com", "a.m.example.com", "notexample.com", "COM", "x.net", "net", "y.org", "z.co.uk", ""]
    paths = ["", "/", "/en/", "/en/abc", "/en/a/b/c", "/es/1", "/fr/2?q=/en/", "/x#/en/", "?a=/en/", "/EN/"]
    urls = [f"https://{h}{p}" for h in hosts for p in paths] + [None, "", "no-scheme/en/", "http://", "ftp://a://b/en/"]
    urls += ["https://www.example.com/en/hot"] * 300
    pages = spark.createDataFrame([(i % 90, u) for i, u in enumerate(urls)], "page_id long, url string").withColumn("key", F.lit("k"))
    got = url_filter(pages, Q.literal_rows(spark, ["host", "path", "verdict"], rules)).collect()
    want = Counter((i % 90, *brute_rule(u, rules)) for i, u in enumerate(urls))
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == want
    none = Q.literal_rows(spark, ["host", "path", "verdict"], rules)
    assert url_filter(pages.where("1 = 0"), none).collect() == []
    assert {r.verdict for r in url_filter(pages, none.where("1 = 0")).collect()} == {"allow"}

"""Registered queries of the training-data operators, with DuckDB SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.llm.centroids import cluster
from churnspark.llm.common import ASCII_UPPER, table
from churnspark.llm.exact import exact_groups
from churnspark.llm.lexical import search
from churnspark.llm.mixing import mix_rates
from churnspark.llm.multiset import edit_fingerprints
from churnspark.llm.packing import pack
from churnspark.llm.quality_net import quality_net
from churnspark.llm.quality_rules import quality_rules
from churnspark.llm.secrets import secret_digest
from churnspark.llm.shard import shard
from churnspark.llm.simhash import near_duplicates
from churnspark.llm.suffix import dedup_substrings
from churnspark.llm.urlfilter import url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# The contract's url rules.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def literal_rows(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A small constant table made by SQL expressions alone."""
    return spark.range(1).select(F.inline(F.array(*[
        F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows])))


@query("op9_url_filter", """
WITH u AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r(rhost, rpath, verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (
  SELECT row_number() OVER () AS k, u.* FROM u),
j AS (
  SELECT m.*, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY k ORDER BY length(rhost) DESC NULLS LAST, length(rpath) DESC NULLS LAST) AS n
  FROM m LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM j WHERE n = 1
""")
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"), literal_rows(spark, ["host", "path", "verdict"], URL_RULES))


@query("op4_quality_net")
def op4_quality_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_net(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_quality_rules")
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "p_good")


@query("op2_simhash")
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, budget=3)


@query("op7_multiset")
def op7_multiset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_fingerprints(table(spark, sf_dir, "documents"))


@query("op8_secrets")
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(table(spark, sf_dir, "documents"))


@query("op1_shard")
def op1_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"), shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def tokenizer_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@query("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_file(), capacity=1024)


#: Domains told by the labels, and the shares of the mix's tokens that they are to have.
MIX_TARGETS = {"plain": 0.92, "low": 0.03, "toxic": 0.05}


def label_domains(labels: DataFrame) -> DataFrame:
    return labels.select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low")
                         .otherwise("plain").alias("domain"))


@query("op5_mixing")
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_rates(table(spark, sf_dir, "documents"), label_domains(table(spark, sf_dir, "labels")), MIX_TARGETS).select(
        "doc_id", "tokens", *[F.col("posterior")[i].alias(f"p_{d}") for i, d in enumerate(MIX_TARGETS)], "rate", "copies")


@query("op6_suffix")
def op6_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents"), least=200, keep="none", texts=False).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op11_exact", r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS s FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(s) AS text_sha256
FROM t WINDOW w AS (PARTITION BY s)
""")
def op11_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def centroid_sql(k: int, rounds: int, size: int) -> str:
    """Lloyd rounds in SQL: distances of all vectors to all centroids, in doubles that hold these integers exactly."""
    finite = "len(embedding) = {0} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {0}".format(size)
    parts = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, sha256('2:' || vec_id) AS h,
      [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q FROM embeddings WHERE {finite}),
    c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS c, q FROM v ORDER BY h LIMIT {k})"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT r, min({{'d': CAST(list_inner_product(v.q, v.q) - 2 * list_inner_product(v.q, c.q)
      + list_inner_product(c.q, c.q) AS BIGINT), 'c': c}}) AS m FROM v, c{i} c GROUP BY r)""")
        if i < rounds:
            parts.append(f"""s{i} AS MATERIALIZED (SELECT c, list(f ORDER BY i) AS q FROM (SELECT m.c AS c, i, floor(sum(q[i]) / count(*)) AS f
      FROM a{i} JOIN v USING (r), range(1, {size + 1}) t(i) GROUP BY ALL) GROUP BY c),
    c{i + 1} AS MATERIALIZED (SELECT o.c, coalesce(s.q, o.q) AS q FROM c{i} o LEFT JOIN s{i} s ON s.c = o.c)""")
    return "WITH " + ",\n".join(parts) + f"""
    SELECT vec_id, CAST(m.c AS INTEGER) AS cluster, m.d AS distance, CAST(sum(m.d) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia,
      CAST(sum(m.d) OVER () AS BIGINT) AS inertia,
      sha256(array_to_string([CAST(CAST(x AS BIGINT) AS VARCHAR) FOR x IN e.q], ',')) AS centroid_sha256
    FROM a{rounds} a JOIN v USING (r) JOIN c{rounds} e ON e.c = a.m.c"""


@query("op12_centroids", centroid_sql(40, 5, 64))
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, size=64, seed="2")


TERM_SQL = (f"regexp_extract_all(translate(text, '{ASCII_UPPER}', '{ASCII_UPPER.lower()}'), "
            r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")


@query("op13_lexical", f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {TERM_SQL} AS terms FROM documents),
s AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS total FROM d WHERE len(terms) > 0),
t AS (SELECT k, unnest(terms) AS term FROM d),
p AS (SELECT k, term, count(*) AS tf FROM t GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({TERM_SQL}) AS term FROM benchmark) GROUP BY ALL),
w AS (SELECT item_id, term, times, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM q JOIN f USING (term), s),
r AS (SELECT item_id, d.doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(d.terms) * n_docs) // total)))) AS BIGINT) AS score
      FROM w JOIN p USING (term) JOIN d USING (k), s GROUP BY item_id, k, d.doc_id),
o AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM r WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= 20
""")
def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

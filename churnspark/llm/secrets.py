r"""Secret scans: base patterns, and two character Markov models compared by log-likelihood ratio.

Three base patterns find the plain cases.  The method adds runs of key-like
characters that no pattern names: a first-order Markov model of random strings
and one of ordinary identifiers, both trained from labelled samples, score the
run's characters, and a run whose mean log-likelihood ratio per step is high
enough is a secret.

Everything is DataFrame and SQL functions.  Spans come from two built-ins with
the same leftmost, non-overlapping matches: ``regexp_extract_all`` gives the
matches, ``split`` the gaps between them, and running lengths give places (in
code points).  The models are one array of ``len(ALPHABET) ** 2`` ratios.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark.llm.common import let

# The contract's base patterns, in the order in which kinds sort.
KINDS = ["assign", "access", "hex", "markov"]
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# with a greedy run, "matches that are long enough" are the matches of the pattern with that least length
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
RUN = r"[A-Za-z0-9+/_=-]+"
SPAN = "array<struct<start:int,kind:int,end:int>>"


def running(values: Column, op, chunk: int = 64) -> Column:
    """Inclusive running sums (or maxima: any associative ``op``) of a non-empty array.

    Nothing grows from step to step, as it would if one fold built the result:
    chunks are folded by themselves, then carried on by the fold of those before."""
    def fold(x: Column) -> Column:
        return F.aggregate(F.slice(x, 2, F.greatest(F.size(x) - 1, F.lit(0))), F.element_at(x, 1), lambda a, b: op(a, b))

    def each(chunks: Column) -> Column:
        def carried(ends: Column) -> Column:
            return F.flatten(F.transform(chunks, lambda x, c: let(F.get(ends, c - 1), lambda e: F.transform(x, lambda _, i: let(
                fold(F.slice(x, 1, i + 1)), lambda own: F.when(c == 0, own).otherwise(op(e, own)))))))
        return let(F.transform(chunks, fold), lambda whole: let(
            F.transform(whole, lambda _, c: fold(F.slice(whole, 1, c + 1))), carried))

    return let(values, lambda all_: let(F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / chunk).cast("int")),
                                                    lambda c: F.slice(all_, c * chunk + 1, chunk)), each))


def _places(text: Column, pattern: str, kind: str, group: int = 0, least: int = 0, keep=None) -> Column:
    """Spans of the matches whose ``group`` has at least ``least`` characters and of which ``keep(match)`` is true, in order."""
    k = KINDS.index(kind)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def spans(m: Column) -> Column:
        gaps = F.transform(F.slice(F.split(text, pattern, -1), 1, F.size(m)), F.length)
        taken = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda v: F.length(v) >= least) if group else (
            F.transform(m, keep or (lambda _: F.lit(True))))
        ends = running(F.zip_with(gaps, m, lambda g, x: g + F.length(x)), lambda a, b: a + b)
        all_ = F.zip_with(ends, m, lambda e, x: F.struct((e - F.length(x)).alias("start"), F.lit(k).alias("kind"), e.alias("end")))
        return F.filter(F.zip_with(all_, taken, lambda x, t: F.when(t, x)), lambda x: x.isNotNull()).cast(SPAN)

    return let(found, lambda m: F.when(F.size(m) > 0, spans(m)).otherwise(F.array().cast(SPAN)))


def base_spans(text: Column) -> Column:
    """All base spans, sorted by start, then kind as listed."""
    return F.array_sort(F.concat(_places(text, ASSIGN, "assign", 2, LEAST_VALUE),
                                 _places(text, ACCESS, "access"), _places(text, HEX, "hex")))


def _steps(word: Column) -> Column:
    """Numbers (from 0) of the transitions of ``word`` in the ratio array; null at other characters."""
    codes = F.transform(F.split(word, ""), lambda c: F.nullif(F.instr(F.lit(ALPHABET), c), F.lit(0)))
    return let(codes, lambda k: F.zip_with(F.slice(k, 1, F.size(k) - 1), F.slice(k, 2, F.size(k) - 1),
                                           lambda x, y: (x - 1) * len(ALPHABET) + y - 1))


def fit_markov(samples: DataFrame, smooth: float = 0.5) -> list[float]:
    """Log ratios P(next | char, random) / P(next | char, ordinary) of every transition.

    ``samples``: ``word`` (of ALPHABET's characters; others are skipped) and
    ``random`` (boolean).  Counts are additively smoothed, so unseen
    transitions stay finite and without samples every ratio is 0.  One row of
    ``len(ALPHABET) ** 2`` doubles reaches the driver.
    """
    n = len(ALPHABET)
    steps = (samples.where(F.length("word") >= 2)
             .select("random", F.explode(_steps(F.col("word"))).alias("step"))
             .where("step is not null").groupBy(F.col("step").cast("long").alias("step"))
             .agg(F.count(F.when(F.col("random"), 1)).alias("r"), F.count(F.when(~F.col("random"), 1)).alias("o")))
    cells = samples.sparkSession.range(n * n).withColumnRenamed("id", "step").join(steps, "step", "left").fillna(0)
    row = Window.partitionBy(F.floor(F.col("step") / n))
    p = [(F.col(c) + smooth) / (F.sum(c).over(row) + smooth * n) for c in ("r", "o")]
    got = cells.select("step", F.log(p[0] / p[1]).alias("ratio")).agg(
        F.array_sort(F.collect_list(F.struct("step", "ratio"))).alias("all")).first()
    return [x.ratio for x in got["all"]]


def _mean_ratio(word: Column, ratios: Column) -> Column:
    return F.aggregate(_steps(word), F.lit(0.0), lambda s, k: s + F.get(ratios, k)) / (F.length(word) - 1)


def markov_spans(text: Column, ratios: list[float], least_length: int, least_ratio: float,
                 least_variety: int = 10) -> Column:
    """Runs of at least ``least_length`` characters whose mean ratio reaches ``least_ratio``.

    A run of fewer than ``least_variety`` different characters (a ruled line)
    holds no secret; a chain says nothing on that.
    """
    pattern = RUN[:-1] + "{%d,}" % least_length
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")  # folded into one literal

    def secret(word: Column) -> Column:
        return (F.size(F.array_distinct(F.split(word, ""))) >= least_variety) & (_mean_ratio(word, table) >= least_ratio)

    return _places(text, pattern, "markov", keep=secret)


def labelled_samples(docs: DataFrame, text_col: str, sample_rows: int, share: float = 1e-3) -> DataFrame:
    """Random strings and ordinary identifiers, labelled by how they came about.

    Random: for each of the ``sample_rows`` different texts of smallest hash, or
    ``share`` of all different texts where that is more, its digest written as hex
    and in base 64, and the values that the base patterns found in it.  Ordinary: the runs of key-like characters left
    in it, as they stand and joined in pairs by ``_`` or ``-`` as identifiers are.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    # the hashes are chosen first, so that no more texts than the sample's are sorted or moved
    hashed = docs.select(text.alias("text")).withColumn("hash", F.xxhash64("text"))
    last = hashed.select("hash").distinct().orderBy("hash").limit(sample_rows).agg(F.max("hash").alias("last")).first().last
    # hashes are spread evenly, so the lowest share of their range holds that share of the different texts
    low = -(1 << 63) + int(share * (1 << 64)) - 1
    some = hashed.where(F.col("hash") <= F.greatest(F.lit(last).cast("long"), F.lit(low))).dropDuplicates(["hash"])
    digest = F.sha2(F.col("text"), 256)
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.col("text"), ASSIGN, " "), ACCESS, " "), HEX, " ")
    plain = F.filter(F.regexp_extract_all(rest, F.lit(RUN), F.lit(0)), lambda w: F.length(w) >= 4)
    drawn = F.concat(F.array(digest, F.rtrim(F.base64(F.unhex(digest))), F.upper(F.substring(F.base64(F.unhex(F.sha2(digest, 256))), 1, 40))),
                     F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)), F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)))
    pairs = let(plain, lambda p: F.transform(p, lambda w, i: F.when(
        i % 2 == 0, F.concat(w, F.when(i % 4 == 0, "_").otherwise("-"), F.coalesce(F.get(p, i + 1), F.lit("")))).otherwise(w)))
    return (some.select(F.explode(drawn).alias("word")).withColumn("random", F.lit(True))
            .unionByName(some.select(F.explode(pairs).alias("word")).withColumn("random", F.lit(False))))


def _ends(spans: Column) -> Column:
    """For each of the spans (sorted by start, not empty) the furthest end so far."""
    return running(F.transform(spans, lambda x: x["end"]), F.greatest)


def _below(points: Column, values: Column, or_equal: bool) -> Column:
    """For each of the ascending ``values`` how many of ``points`` are below it (or equal): by one sort, not by a search for each."""
    tag = 1 if or_equal else 0

    def tagged(x: Column, t: int) -> Column:
        return F.transform(x, lambda a: F.struct(a.alias("at"), F.lit(t).alias("tag")))

    p, v = tagged(points, 1 - tag), tagged(values, tag)
    place = F.filter(F.transform(F.array_sort(F.concat(p, v)), lambda x, i: F.when(x["tag"] == tag, i)), lambda x: x.isNotNull())
    return F.transform(place, lambda at, j: at - j)


def _uncovered(runs: Column, base: Column) -> Column:
    """The pieces of ``runs`` (sorted, apart from one another) that no span of ``base`` (sorted by start) covers, in order."""
    far = F.lit((1 << 31) - 1)

    def free(ends: Column) -> Column:
        """The stretches between base spans."""
        both = F.zip_with(F.concat(F.array(F.lit(0)), ends), F.concat(F.transform(base, lambda x: x["start"]), F.array(far)),
                          lambda a, b: F.struct(a.alias("start"), b.alias("end")))
        return F.filter(both, lambda x: x["start"] < x["end"])

    def pieces(gaps: Column) -> Column:
        low = _below(F.transform(gaps, lambda x: x["end"]), F.transform(runs, lambda r: r["start"]), True)
        high = _below(F.transform(gaps, lambda x: x["start"]), F.transform(runs, lambda r: r["end"]), False)
        return F.flatten(F.zip_with(runs, F.zip_with(low, high, lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda r, x: F.transform(
            F.slice(gaps, x["a"] + 1, F.greatest(x["b"] - x["a"], F.lit(0))), lambda g: F.struct(
                F.greatest(g["start"], r["start"]).alias("start"), r["kind"].alias("kind"), F.least(g["end"], r["end"]).alias("end")))))

    return F.when((F.size(base) == 0) | (F.size(runs) == 0), runs).otherwise(let(let(_ends(base), free), pieces)).cast(SPAN)


def scan_secrets(docs: DataFrame, text_col: str = "text", sample_rows: int = 300,
                 least_length: int = 20, least_ratio: float = 0.7) -> DataFrame:
    """All columns of ``docs`` plus ``secret_spans``: array of (start, kind, end), sorted.

    Places are code points, ends exclusive; ``kind`` is a number of ``KINDS``.
    Base spans always stay; of a Markov run the pieces that none of them covers
    are added, so a Markov span overlaps no base span.  A null or empty text has no span; texts are scanned whole; repeated
    rows and ties get equal spans; an empty table gives no rows.  An input
    column called ``secret_spans`` is replaced.  The models are fitted on
    ``labelled_samples`` of ``sample_rows`` different texts or more.
    """
    ratios = fit_markov(labelled_samples(docs, text_col, sample_rows))
    text = F.coalesce(F.col(text_col), F.lit(""))
    added = markov_spans(text, ratios, least_length, least_ratio)
    return docs.withColumn("secret_spans", let(base_spans(text), lambda base: let(
        added, lambda runs: F.array_sort(F.concat(base, _uncovered(runs, base))))))


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined, as the spans are sorted."""
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))))


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", **how) -> DataFrame:
    """``docs`` with every secret's characters replaced by ``mark``; texts without secrets stay as they are.

    Spans that overlap are replaced together by one mark.
    """
    found = scan_secrets(docs.withColumnRenamed("secret_spans", "_kept_spans"), text_col, **how)
    text, spans, block = F.col(text_col), F.col("secret_spans"), 4096

    def part(blocks: Column, start: Column, end: Column) -> Column:
        """Characters from start to end: from the blocks that hold them, as a place in a long text is found by walking to it."""
        first, last = (F.floor(x / block).cast("int") for x in (start, end - 1))
        return F.when(end <= start, F.lit("")).otherwise(F.array_join(F.transform(F.sequence(first, F.greatest(first, last)), lambda i: F.substring(
            F.get(blocks, i), F.greatest(start - i * block, F.lit(0)) + 1,
            F.least(end - i * block, F.lit(block)) - F.greatest(start - i * block, F.lit(0)))), ""))

    def cut(blocks: Column) -> Column:
        def kept(ends: Column) -> Column:
            before = F.concat(F.array(F.lit(0)), ends)  # the furthest end before each span, and at last of all
            marked = F.zip_with(spans, F.slice(before, 1, F.size(spans)), lambda x, at: F.when(
                x["start"] >= at, F.concat(part(blocks, at, x["start"]), F.lit(mark))).otherwise(F.lit("")))
            return F.array_join(F.concat(marked, F.array(part(blocks, F.element_at(ends, -1), F.length(text)))), "")
        return let(_ends(spans), kept)

    done = let(F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % block), F.lit(0)), cut)
    return (found.withColumn(text_col, F.when(F.size(spans) > 0, done).otherwise(text))
            .drop("secret_spans").withColumnRenamed("_kept_spans", "secret_spans").select(*docs.columns))


def kind_count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == KINDS.index(kind))).cast("long")


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda x: x["kind"] < 3)


def secret_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns of ``op8``."""
    spans = F.col("secret_spans")
    return scan_secrets(docs.select("doc_id", "text")).select(
        "doc_id", *[kind_count(spans, k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(joined(base_only(spans)), 256).alias("base_sha256"), joined(spans).alias("spans"))

"""Mixing sources to target weights: soft membership and fitted document rates.

No column says which domain a document is of; a labelled table says it for
some.  A naive Bayes classifier over a few binned features of the text, trained
on all labelled rows, predicts every document's posterior over domains.  A
document with rate r adds ``r * tokens * posterior`` to each domain's expected
tokens, and projected gradient descent on the least-squares distance to the
targets (with a weak pull of every rate towards its bound) fits rates >= 0.

Features are binned, so documents fall into *cells*; a cell's documents share
posterior and gradient, and so their rate.  One aggregation turns the corpus
into the table of cells, whose size follows the bins (a few thousand for three
domains, threefold for each more), not the corpus.  The gradient steps are jobs
over its rows.  Documents get their rates by a join with the cells, which are
broadcast up to ``SENT_CELLS`` rows only; beyond that the rows meet
them by a shuffle.  DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.llm.common import let, written

SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Upper bounds of the bins (one more bin lies beyond the last); markers: bins of each domain's marker words.
CUTS = {"symbols": [0.0, 0.05, 0.3], "upper": [0.08, 0.4], "bangs": [0.02, 0.3], "variety": [0.1, 0.25, 0.5]}
MARKER_CUTS = [0, 1]


def _bin(value: Column, cuts: list) -> Column:
    out = F.lit(len(cuts))
    for k, c in reversed(list(enumerate(cuts))):
        out = F.when(value <= c, k).otherwise(out)
    return out.cast("int")


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.lower(text), ".,!?;:\n\t\r", " " * 9), " "), "")


def with_cells(docs: DataFrame, text_col: str, markers: dict[str, list[str]]) -> DataFrame:
    """``docs`` plus ``_tokens`` (words) and ``_cell``: the text's bins, as one string."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    every = sorted({m for own in markers.values() for m in own})

    def common(a: Column, own: list[str]) -> Column:
        return F.array_intersect(a, F.array(*map(F.lit, own))) if own else F.array().cast("array<string>")

    # one look at each distinct word; only markers that occur are then told apart by domain
    counts = let(words(text), lambda w: let(F.array_distinct(w), lambda d: let(common(d, every), lambda m: F.struct(
        F.size(w).alias("n"), F.size(d).alias("distinct"),
        F.array(*[F.size(common(m, own)) for own in markers.values()]).alias("marks")))))

    def lost(chars: str) -> Column:
        return F.length(text) - F.length(F.translate(text, chars, ""))

    c = docs.withColumn("_counts", counts)
    n = F.greatest(F.col("_counts.n"), F.lit(1))
    share = {"symbols": lost(SYMBOLS) / n, "upper": lost(UPPER) / F.greatest(F.length(text), F.lit(1)),
             "bangs": lost("!") / n, "variety": F.col("_counts.distinct") / n}
    bins = [_bin(share[k], cuts) for k, cuts in CUTS.items()]
    bins += [_bin(F.col("_counts.marks")[i], MARKER_CUTS) for i in range(len(markers))]
    return (c.withColumn("_tokens", F.col("_counts.n").cast("long"))
            .withColumn("_cell", F.concat_ws(",", *[b.cast("string") for b in bins])).drop("_counts"))


def marker_words(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, domains: list[str],
                 sample_rows: int, each: int = 24) -> dict[str, list[str]]:
    """For each domain the words that tell it best from the others, from at most ``sample_rows`` labelled rows.

    The sample is the rows of smallest hash; ``each`` words a domain reach the driver.
    """
    chosen = labels.orderBy(F.xxhash64("_doc"), "_doc", "_domain").limit(sample_rows)
    sample = written(docs.select(F.col(id_col).alias("_doc"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
                     .join(F.broadcast(chosen), "_doc")
                     .select("_domain", F.array_distinct(words(F.col("_text"))).alias("_words")), "mix-sample")
    total = sample.groupBy("_domain").agg(F.count(F.lit(1)).alias("n")).collect()
    size = {r["_domain"]: r["n"] for r in total}
    everything = sum(size.values())
    seen = sample.select("_domain", F.explode("_words").alias("word")).groupBy("word").agg(
        *[F.count(F.when(F.col("_domain") == d, 1)).alias(f"d{i}") for i, d in enumerate(domains)])
    both = sum((F.col(f"d{i}") for i in range(len(domains))), F.lit(0))
    out = {}
    for i, d in enumerate(domains):
        own, n = F.col(f"d{i}"), size.get(d, 0)
        odds = F.log((own + 0.5) / (n + 1)) - F.log((both - own + 0.5) / (everything - n + 1))
        top = (seen.where((own >= 3) & (own >= 0.02 * n) & (odds >= 2)).orderBy((own * odds).desc(), "word").limit(each))
        out[d] = [r.word for r in top.collect()]
    return out


@dataclass
class Mix:
    domains: list[str]
    markers: dict[str, list[str]]
    cells: DataFrame  # _cell, posterior (array of doubles), rate


def _posteriors(cells: DataFrame, labelled: DataFrame, domains: list[str]) -> DataFrame:
    """``_cell`` with ``posterior``: naive Bayes of the bins, additively smoothed, in SQL over tables of bins."""
    k = len(domains)
    bins = F.posexplode(F.split("_cell", ","))
    counts = (labelled.groupBy("_cell", "_domain").agg(F.count(F.lit(1)).alias("n"))
              .select("_domain", "n", bins).groupBy("pos", "col", "_domain").agg(F.sum("n").alias("n")))
    of = {r["_domain"]: r["n"] for r in labelled.groupBy("_domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    whole = sum(of.values())
    likely = counts.groupBy("pos", "col").agg(F.array(*[
        F.coalesce(F.sum(F.when(F.col("_domain") == d, F.col("n"))), F.lit(0)) for d in domains]).alias("n"))
    logs = F.array(*[F.log((F.coalesce(F.col("n")[i], F.lit(0)) + 0.5) / (of.get(d, 0) + 2.0)) for i, d in enumerate(domains)])
    per = (cells.select("_cell", bins).join(F.broadcast(likely), ["pos", "col"], "left")
           .withColumn("l", logs).groupBy("_cell").agg(*[F.sum(F.col("l")[i]).alias(f"l{i}") for i in range(k)]))
    score = [F.col(f"l{i}") + F.log(F.lit(float(of.get(d, 0) + 1) / (whole + k))) for i, d in enumerate(domains)]
    top = F.greatest(*score) if k > 1 else score[0]
    raw = F.array(*[F.exp(s - top) for s in score])
    return per.select("_cell", let(raw, lambda e: F.transform(e, lambda x: x / F.aggregate(
        e, F.lit(0.0), lambda a, b: a + b))).alias("posterior"))


#: Cells up to which their table is sent to all tasks; beyond it the rows are joined by a shuffle.
SENT_CELLS = 100_000


def fit_mix(cells: DataFrame, labelled: DataFrame, markers: dict[str, list[str]], targets: dict[str, float],
            most: float = 1.0, rounds: int = 200, pull: float = 3e-4, least_pull: float = 1e-8,
            tolerance: float = 0.01, written_every: int = 8) -> Mix:
    """Rates in [0, most] by projected gradient descent on least squares.

    ``cells``: ``_cell, tokens`` (all documents; those of a cell have equal
    posteriors, so equal gradients and rates); ``labelled``: ``_cell,
    _domain``; ``targets``: the domains' weights.  The distance is that of the
    domains' expected tokens, each over its target, to their common mean, so a
    rare domain counts as much as any; the pull is towards ``most``.

    The cells stay rows of a table.  A round is one job, which sums a few numbers
    over the projected step of all cells, and one map: the distance is quadratic
    along the step, so the sums tell its best length (and the next step's
    scale, by Barzilai and Borwein).  Every ``written_every`` rounds the table is
    written.  The descent ends when every domain's share is within ``tolerance``
    of its target (relative).  Where it stands still before, the pull shrinks;
    with the least pull each cell's step is then divided by its own curvature, as
    a rare domain's is far above the others'.  Where that stands still too, it
    ends (targets that no mix can reach), as it does after ``rounds`` rounds.  The rates are then as large as their bound allows.

    A target of 0 is a domain to leave out: cells that most likely are of it get
    rate 0, and the shares are those among the other domains.  Weights must not
    be negative, and one at least positive.
    """
    domains = list(targets)
    if min(targets.values()) < 0 or not any(targets.values()):
        raise ValueError("target weights must not be negative, and not all zero")
    posts = _posteriors(cells, labelled, domains)
    whole = cells.agg(F.sum("tokens").alias("t")).first().t or 0
    use = [i for i, d in enumerate(domains) if targets[d] > 0]
    goal = [targets[domains[i]] / sum(targets.values()) for i in use]
    p, full = F.col("posterior"), F.lit(float(most))
    out = [i for i in range(len(domains)) if i not in use]
    free = ~F.array_position(p, F.array_max(p)).isin([i + 1 for i in out]) if out else F.lit(True)
    state = written(cells.join(posts, "_cell").select("_cell", p, (F.col("tokens") / max(whole, 1)).alias("w"), free.alias("free"))
                    .withColumn("rate", F.when(F.col("free"), full).otherwise(F.lit(0.0))), "mix-cells")
    w, rate = F.col("w"), F.col("rate")

    def force(sums: list[float]) -> list[float]:
        scaled = [x / g for x, g in zip(sums, goal)]
        mean = sum(scaled) / len(scaled)
        return [(x - mean) / g for x, g in zip(scaled, goal)]

    def direction(f: list[float], scale: float) -> Column:
        slope = sum((p[i] * x for i, x in zip(use[1:], f[1:])), p[use[0]] * f[0]) + pull * (rate - most)
        return F.when(F.col("free"), F.least(F.greatest(rate - scale * (slope / curve if own else slope), F.lit(0.0)), full) - rate).otherwise(F.lit(0.0))

    def summed(*terms: Column) -> list[float]:
        return [x or 0.0 for x in state.agg(*[F.sum(t).alias(f"s{i}") for i, t in enumerate(terms)]).first()]

    k = len(use)
    got = summed(*[w * rate * p[i] for i in use], *[w * p[i] * p[i] for i in use])
    sums, bent = got[:k], got[k:]
    scale = 1 / (sum(x / g ** 2 for x, g in zip(bent, goal)) or 1.0)
    still, own = 0, False
    curve = F.greatest(sum((p[i] * p[i] / g ** 2 for i, g in zip(use[1:], goal[1:])), p[use[0]] * p[use[0]] / goal[0] ** 2), F.lit(1e-12))
    for r in range(1, rounds + 1):
        if not any(sums) or max(abs(x / sum(sums) - g) / g for x, g in zip(sums, goal)) <= tolerance:
            break
        if still >= 3:
            if pull <= least_pull and own:
                break
            if pull <= least_pull:
                own, scale = True, 1.0
            pull, still = max(pull / 8, least_pull), 0
        f = force(sums)
        d = direction(f, scale)
        *gain, drag, square, size = summed(*[w * p[i] * d for i in use], w * (rate - most) * d, w * d * d, w * d * d * (curve if own else F.lit(1.0)))
        change = [b - a for a, b in zip(f, force([x + y for x, y in zip(sums, gain)]))]
        falls = sum(a * b for a, b in zip(f, gain)) + pull * drag
        bends = sum(a * b for a, b in zip(change, gain)) + pull * square
        length = min(max(-falls / bends, 0.0), 1.0) if bends > 0 else 1.0
        state = state.withColumn("rate", rate + length * d)
        if r % written_every == 0:
            state = written(state, "mix-cells")
        before = max(abs(x / sum(sums) - g) / g for x, g in zip(sums, goal))
        sums = [x + length * y for x, y in zip(sums, gain)]
        now = max(abs(x / (sum(sums) or 1.0) - g) / g for x, g in zip(sums, goal))
        still = still + 1 if now > 0.98 * before else 0
        scale = size / bends if bends > 0 and size > 0 else scale
    top = state.where("w > 0").agg(F.max("rate").alias("top")).first().top or 1e-300
    rates = written(state.select("_cell", "posterior", F.least(rate * (most / max(top, 1e-300)), full).alias("rate")), "mix-rates")
    return Mix(domains, markers, rates if rates.count() > SENT_CELLS else F.broadcast(rates))


def _fit(docs: DataFrame, labels: DataFrame, targets: dict[str, float], id_col: str, text_col: str,
         sample_rows: int) -> tuple[Mix, DataFrame]:
    known = labels.select(F.col(id_col).alias("_doc"), F.col("domain").alias("_domain")).where(F.col("_domain").isin(*targets))
    plain = docs.select(F.col(id_col), F.col(text_col))
    markers = marker_words(plain, known, id_col, text_col, list(targets), sample_rows)
    rows = written(with_cells(plain, text_col, markers).select(
        F.col(id_col).alias("_doc"), "_tokens", "_cell", F.xxhash64(F.col(id_col), F.col(text_col)).alias("_key")), "mix-rows")
    cells = written(rows.groupBy("_cell").agg(F.sum("_tokens").alias("tokens")), "mix-tokens")
    labelled = written(rows.join(known, "_doc").select("_cell", "_domain"), "mix-labelled")
    return fit_mix(cells, labelled, markers, targets), rows


def _copies(rate: Column, key: Column) -> Column:
    """The rate rounded up or down by a hash, so that its mean is kept and a re-run repeats it."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(11)), 11).cast("double") + 0.5) / float(1 << 53)
    # a rate within 1e-3 of a whole number but 0 is that number: the fit is no finer
    whole = F.when((F.abs(rate - F.round(rate)) < 1e-3) & (F.round(rate) > 0), F.round(rate)).otherwise(F.floor(rate) + F.when(u < rate - F.floor(rate), 1).otherwise(0))
    return whole.cast("int")


def mix_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float], id_col: str = "doc_id",
              text_col: str = "text", sample_rows: int = 4000) -> DataFrame:
    """``id_col, tokens, posterior, rate, copies``: one row per row of ``docs``.

    ``labels``: ``id_col, domain``; ``posterior`` follows the order of
    ``targets``.  A null or empty text has no tokens and the bins of an empty
    one.  Repeated rows get equal rates and copies; without labels every
    posterior is uniform; an empty table gives no rows.  Other columns are
    ignored.
    """
    mix, rows = _fit(docs, labels, targets, id_col, text_col, sample_rows)
    return rows.join(mix.cells, "_cell").select(
        F.col("_doc").alias(id_col), F.col("_tokens").alias("tokens"), "posterior", "rate",
        _copies(F.col("rate"), F.col("_key")).alias("copies"))


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float], id_col: str = "doc_id",
        text_col: str = "text", sample_rows: int = 4000) -> DataFrame:
    """The rows of ``docs``, each as often as its copies say, with the columns of ``docs``."""
    fitted = _fit(docs, labels, targets, id_col, text_col, sample_rows)[0]
    rated = with_cells(docs, text_col, fitted.markers).join(fitted.cells.drop("posterior"), "_cell")
    n = _copies(F.col("rate"), F.xxhash64(F.col(id_col), F.col(text_col)))
    return rated.withColumn("_copy", F.explode(F.sequence(F.lit(0), n))).where("_copy > 0").select(*docs.columns)

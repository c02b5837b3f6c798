"""Quality rules under weak supervision.

Rules look at one pass of counts per document and vote good (1), bad (-1) or
abstain (0).  No rule is trusted by decree: expectation-maximisation over the
votes of *all* documents estimates, for each rule, how often it votes either
way on good and on bad documents (its accuracies), and the share of good
documents.  The posterior probability of "good" replaces all-must-pass.

Votes of R rules have at most 3**R patterns, so the corpus collapses into a
table of pattern counts (one shuffle of that many rows at most), on which the
driver runs EM; the posteriors, one per pattern, are broadcast back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.llm.common import bounded_batches, written

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_distinct", "n_upper", "n_capital_start", "n_stops", "n_bangs", "n_marked"]
_SPACE = b" \t\n\x0b\x0c\r"
#: Every mark that prose seldom puts into a word becomes a zero byte.
_MARKED = b"!#$%&*+/<=>@[\\]^_`{|}~"
_MARKS = bytes.maketrans(_MARKED, bytes(len(_MARKED)))


def repeated_words(words: list[bytes], size: int = 5) -> int:
    """Words inside a window of ``size`` words that is found twice or more in ``words``, the first included."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    if len(seen) == len(words):
        return 0
    # exact identity of a window: extend it word by word, ranking after each step so codes stay small
    code, base = ids[:n], len(seen)
    for k in range(1, size):
        code = code * base + ids[k:n + k]
        _, code, times = np.unique(code, return_inverse=True, return_counts=True)
        if times.max() == 1:
            return 0
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(times[code] > 1)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + size, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts in the order of ``COUNTS``; a null text counts as empty."""
    raw = (text or "").encode()
    words = raw.split()  # bytes split at exactly \x20 and \x09-\x0D
    lines = [x for x in raw.split(b"\n") if x.strip()]
    packed = raw.translate(None, _SPACE)
    return (len(words), len(packed.decode()), len(raw) - len(raw.translate(None, b"#*$%&|<>")),
            len(lines) - len(set(lines)), repeated_words(words), len(lines), len(set(words)),
            sum(map(bytes.isupper, words)), sum(w[:1].isupper() for w in words),
            sum(w[-1:] == b"." for w in words), raw.count(b"!"),
            sum(b"\0" in w for w in raw.translate(_MARKS).split()))


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [text_counts(t.as_py()) for t in b.column(1)]
        cols = np.array(rows, np.int64).reshape(len(rows), len(COUNTS)).T
        yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, cols)], names=["doc", *COUNTS])


def document_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).mapInArrow(
        _count_batches, f"doc {kind}, " + ", ".join(f"{c} long" for c in COUNTS))


def _vote(bad: Column, good: Column | None = None) -> Column:
    v = F.when(bad, -1)
    return (v.when(good, 1) if good is not None else v).otherwise(0).cast("int")


def rules() -> dict[str, Column]:
    """The votes.  Shares are compared by products, so documents without words abstain or fail plainly."""
    c = {x: F.col(x) for x in COUNTS}
    n = c["n_words"]
    prose = ((n >= 10) & (c["n_marked"] <= 0.05 * n) & (c["n_upper"] <= 0.2 * n) & (c["n_distinct"] >= 0.25 * n)
             & (c["n_capital_start"] <= 0.5 * n) & ((c["n_stops"] >= 0.01 * n) | (n < 40)) & (c["n_repeat_words"] <= 0.2 * n))
    return {
        "length": _vote(n < 10),
        "symbols": _vote(c["n_symbols"] > 0.1 * n),
        "marks": _vote(c["n_marked"] > 0.2 * n, (c["n_marked"] <= 0.03 * n) & (n >= 10)),
        "shouting": _vote(c["n_upper"] > 0.5 * n),
        "bangs": _vote(c["n_bangs"] > 0.2 * n),
        "repeats": _vote(c["n_repeat_words"] > 0.2 * n),
        "lines": _vote((c["n_dup_lines"] > 0.3 * c["n_lines"]) & (c["n_lines"] >= 4)),
        "variety": _vote((c["n_distinct"] < 0.25 * n) & (n >= 20)),
        "sentences": _vote((c["n_stops"] < 0.01 * n) & (n >= 30)),
        "starts": _vote(c["n_capital_start"] > 0.6 * n),
        "prose": F.when(prose, 1).otherwise(0).cast("int"),
    }


def fit_accuracies(votes: np.ndarray, times: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, float, np.ndarray]:
    """EM of the two-class vote model over distinct vote patterns.

    Returns ``p[rule, class, vote + 1]`` (class 0 bad, 1 good), the share of
    good documents, and each pattern's posterior of good.  It starts from the
    votes themselves: a pattern with a bad vote leans bad; pseudo-counts keep
    every probability inside (0, 1).
    """
    good = np.where((votes < 0).any(1), 0.1, 0.9)
    p, share = np.full((votes.shape[1], 2, 3), 1 / 3), 0.5
    for _ in range(rounds):
        mass = np.stack([(1 - good) * times, good * times])
        share = (mass[1].sum() + 1) / (times.sum() + 2)
        for v in (-1, 0, 1):
            p[:, :, v + 1] = (mass @ (votes == v) + 0.5).T
        p /= p.sum(2, keepdims=True)
        logs = np.log(p)
        score = [sum(logs[j, k, votes[:, j] + 1] for j in range(votes.shape[1])) for k in (0, 1)]
        now = 1 / (1 + np.exp(np.clip(score[0] - score[1] + np.log((1 - share) / share), -700, 700)))
        if np.abs(now - good).max(initial=0) < 1e-9:
            break
        good = now
    return p, float(share), good


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  keep_above: float = 0.5) -> DataFrame:
    """``id_col``, the counts, one ``vote_<rule>`` per rule, ``p_good``, ``base_failed`` and ``kept``.

    One row per row of ``docs``, repeated rows included; whole texts, a null
    text counting as empty (no words: fails the base).  Equal votes get equal
    posteriors, so ties cannot arise.  An empty table gives no rows.  Other
    columns are ignored, whatever their names.
    """
    counts = written(document_counts(docs, id_col, text_col), "quality-counts")
    named = rules()
    voted = counts.withColumns({f"vote_{k}": v for k, v in named.items()})
    voted = voted.withColumn("pattern", F.concat_ws(",", *[F.col(f"vote_{k}").cast("string") for k in named]))
    # at most 3 ** len(rules) rows
    patterns = voted.groupBy("pattern").agg(F.count(F.lit(1)).alias("times")).collect()
    votes = np.array([[int(x) for x in r.pattern.split(",")] for r in patterns], int).reshape(-1, len(named))
    posterior = fit_accuracies(votes, np.array([r.times for r in patterns], float))[2]
    known = docs.sparkSession.createDataFrame(
        [(r.pattern, float(p)) for r, p in zip(patterns, posterior)], "pattern string, p_good double")
    n = F.col("n_words")
    failed = (n < 10) | (100 * F.col("n_repeat_words") > 20 * n)
    return (voted.join(F.broadcast(known), "pattern")
            .withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (F.col("p_good") >= keep_above))
            .select(F.col("doc").alias(id_col), *COUNTS, *[f"vote_{k}" for k in named], "p_good", "base_failed", "kept"))

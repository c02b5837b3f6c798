"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A text is the multiset of its paragraphs (lines).  Each paragraph hashes to a
wide vector, and a text's fingerprint is the sum of its paragraphs' vectors,
each word modulo a power of two.  So the order of paragraphs does not matter,
equal multisets have equal fingerprints, and a paragraph is inserted or deleted
by adding or subtracting its vector (``insert``, ``delete``), without the text.

The vector has two parts, both additive:

* ``WORDS`` words modulo 2**32 of the paragraph's hash, for equality;
* ``SIGNS`` words modulo 2**16: the sum of +1/-1 vectors of its sentences.
  Their inner products estimate how many sentences two texts share, so the
  fingerprints alone give a likeness between 0 and 1.
"""

from __future__ import annotations

import bisect
import collections
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.llm.common import bounded_batches, shuffle_partitions, written

WORDS, SIGNS = 16, 128
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def _sum(parts: np.ndarray, counts: np.ndarray, dtype) -> np.ndarray:
    """Sums of consecutive runs of rows; a run may be empty."""
    out = np.zeros((len(counts), parts.shape[1]), dtype)
    some = counts > 0
    if some.any():
        out[some] = np.add.reduceat(parts, np.concatenate([[0], np.cumsum(counts)[:-1]])[some], dtype=dtype)
    return out


def vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``n x WORDS`` uint32 and ``n x SIGNS`` int16.  An empty text has no paragraph: zeros."""
    wide, signs, n_par, n_sen = [], [], [], []
    blake, h128 = hashlib.blake2b, xxhash.xxh3_128_digest
    for t in texts:
        lines = t.encode().split(b"\n") if t else []
        wide += [blake(x).digest() for x in lines]
        sentences = [s for x in lines for s in x.split(b". ") if s]
        signs += map(h128, sentences)
        n_par.append(len(lines))
        n_sen.append(len(sentences))
    w = np.frombuffer(b"".join(wide), "<u4").reshape(-1, WORDS)
    ups = np.unpackbits(np.frombuffer(b"".join(signs), np.uint8).reshape(-1, SIGNS // 8), axis=1)
    n = np.array(n_sen, np.int64)
    s = 2 * _sum(ups, n, np.int64) - n[:, None]
    return _sum(w, np.array(n_par, np.int64), np.uint32), s.astype(np.uint16).view(np.int16)


def to_hex(w: np.ndarray, s: np.ndarray) -> list[str]:
    return [a.tobytes().hex() + b.tobytes().hex() for a, b in zip(w.astype("<u4"), s.astype("<i2"))]


def from_hex(fingerprints: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(bytes.fromhex("".join(fingerprints)), np.uint8).reshape(len(fingerprints), -1)
    return (np.ascontiguousarray(raw[:, :4 * WORDS]).view("<u4"), np.ascontiguousarray(raw[:, 4 * WORDS:]).view("<i2"))


def insert(fingerprint: str, paragraphs: list[str]) -> str:
    """The fingerprint once ``paragraphs`` (lines) are added."""
    w, s = from_hex([fingerprint])
    for p in paragraphs:
        dw, ds = vectors([p])
        if not p:  # an empty line inside a text: what "\n\n" (three of them) has more than "\n" (two)
            dw = vectors(["\n\n"])[0] - vectors(["\n"])[0]
        w, s = w + dw, s + ds
    return to_hex(w, s)[0]


def delete(fingerprint: str, paragraphs: list[str]) -> str:
    """The fingerprint once ``paragraphs`` (lines) are taken out."""
    w, s = from_hex([fingerprint])
    zero = to_hex(np.zeros_like(w), np.zeros_like(s))[0]
    dw, ds = from_hex([insert(zero, paragraphs)])
    return to_hex(w - dw, s - ds)[0]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Row by row, 1 for equal fingerprints, else the cosine of the sign sums, from 0 to 1."""
    x, y = a[1].astype(np.float64), b[1].astype(np.float64)
    size = np.sqrt((x * x).sum(1) * (y * y).sum(1))
    cos = np.divide((x * y).sum(1), size, out=np.zeros(len(x)), where=size > 0)
    same = (a[0] == b[0]).all(1) & (a[1] == b[1]).all(1)
    return np.where(same, 1.0, np.clip(cos, 0, 1))


def edited(text: str, following: str) -> str:
    """The last third of ``text`` replaced by as many first characters of ``following`` (or all it has)."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


def range_bounds(rows: DataFrame, parts: int) -> tuple[list[tuple[int, int, int]], set[int]]:
    """Bounds of about ``parts`` ranges of ``k`` (falling), ``g`` and ``u``, as
    sorted (~k, g, u), and the ids that are cut further, by g and u.

    A value that is several quantiles in a row fills so many ranges.  The driver
    sees the quantiles only, a few for each range."""
    def quantiles(frame: DataFrame, keys: list[str], col: str) -> dict[tuple, list[int]]:
        q = F.percentile_approx(col, [i / parts for i in range(1, parts)], max(10_000, 5 * parts)).alias("q")
        return {tuple(r[c] for c in keys): list(r.q or []) for r in frame.groupBy(*keys).agg(q).collect()}

    def cut(values: list[int], ranges: int) -> list[int]:
        """``ranges - 1`` of the quantiles, evenly spaced."""
        return [values[i * len(values) // ranges] for i in range(1, ranges)] if values else []

    if parts < 2:
        return [], set()
    ids = collections.Counter(quantiles(rows, [], "k").get((), []))
    hot = {k: n + 1 for k, n in ids.items() if n > 1}
    bounds = [(~k, _MOST, _MOST) for k in ids]
    if hot:
        texts = {k: collections.Counter(cut(q, hot[k])) for (k,), q in quantiles(rows.where(F.col("k").isin(*hot)), ["k"], "g").items()}
        bounds += [(~k, h, _MOST) for k, c in texts.items() for h in c]
        again = {(k, h): n + 1 for k, c in texts.items() for h, n in c.items() if n > 1}
        if again:
            some = rows.where(F.col("k").isin(*{k for k, _ in again}) & F.col("g").isin(*{h for _, h in again}))
            for (k, h), q in quantiles(some, ["k", "g"], "u").items():
                bounds += [(~k, h, u) for u in cut(q, again.get((k, h), 1))]
    return sorted(set(bounds)), set(hot)


_FIELDS = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def edit_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint, that of its edited text, and both likenesses.

    The next document is the one with the next smaller id (after the last: the
    first).  Documents are dealt by range of id, so the texts move once; the
    first row of each range is also sent to the range before it.  The ranges'
    bounds are approximate quantiles of the ids; any bounds give the same
    result.  An id that fills ranges by itself (null, say) is cut further by its
    texts' hashes, and a text that does so by the number of the row.

    One row per row of ``docs``: a null text is empty, rows with equal ids
    follow one another by their text's hash, null ids come last.  A lone
    document follows itself.  No documents give no rows.  Other columns are
    ignored.  ``id_col`` must be an integer.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(_LEAST))
    rows = docs.select(F.col(id_col).alias("doc"), key.alias("k"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.monotonically_increasing_id().alias("u")).withColumn("h", F.xxhash64("text"))
    rows = rows.withColumn("g", F.shiftright("h", 11))  # what quantiles, which are doubles, can tell apart
    bounds, hot = range_bounds(rows, shuffle_partitions(spark))
    if any(u != _MOST for *_, u in bounds):
        rows = written(rows, "multiset-rows")  # row numbers count: they must not change from job to job

    def places(k: list[int], h: list[int], u: list[int]) -> tuple[list[tuple], list[int]]:
        """Each row's place in the order, as far as its range depends on it, and its range."""
        at = [(~a, b, c) if a in hot else (~a, 0, 0) for a, b, c in zip(k, h, u)]
        return at, [bisect.bisect_left(bounds, x) for x in at]

    @F.pandas_udf("bucket int, k long, h long")
    def placed(k: pd.Series, h: pd.Series, u: pd.Series) -> pd.DataFrame:
        at, bucket = places(k.tolist(), h.tolist(), u.tolist())
        return pd.DataFrame({"bucket": np.array(bucket, np.int32), "k": [x[0] for x in at], "h": [x[1] for x in at]})

    if hot:
        found = rows.select(placed("k", "g", "u").alias("p"))
    else:  # the texts need not be read for it
        none = F.lit(0).cast("long")
        found = docs.select(placed(key, none, none).alias("p"))
    # one row per range: its first id, and text hash if that matters
    firsts = {r.bucket: (r.top.k, r.top.h) for r in found.select("p.*").groupBy("bucket").agg(F.min(F.struct("k", "h")).alias("top")).collect()}
    order = sorted(firsts)
    before = {b: order[i - 1] for i, b in enumerate(order)}

    @F.pandas_udf("array<struct<bucket:int,extra:int>>")
    def sent(k: pd.Series, h: pd.Series, g: pd.Series, u: pd.Series) -> pd.Series:
        at, bucket = places(k.tolist(), g.tolist(), u.tolist())
        out, seen = [], set()
        for x, b, y in zip(at, bucket, h.tolist()):
            out.append([{"bucket": b, "extra": 0}])
            if x[:2] == firsts[b] and (b, x[0], y) not in seen:  # of equal rows one will do
                seen.add((b, x[0], y))
                out[-1].append({"bucket": before[b], "extra": 1})
        return pd.Series(out)

    kind = docs.schema[id_col].dataType.simpleString()
    rows = (rows.select("doc", "k", "h", "text", F.explode(sent("k", "h", "g", "u")).alias("to"))
            .select("doc", "k", "h", "text", "to.bucket", "to.extra")
            .repartitionById(len(bounds) + 1, "bucket")
            .sortWithinPartitions("bucket", "extra", F.col("k").desc(), "h", "text").drop("h"))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list[tuple] = []
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                run = last + list(zip(part.column("bucket").to_pylist(), part.column("extra").to_pylist(),
                                      range(part.num_rows), part.column("text").to_pylist()))
                source = pa.concat_arrays([last_doc, part.column("doc")]) if last else part.column("doc")
                use = [i for i in range(len(run) - 1) if not run[i][1] and run[i][0] == run[i + 1][0]]
                if use:
                    texts = [r[3] for r in run]
                    new = [edited(texts[i], texts[i + 1]) for i in use]
                    w, s = vectors(texts)
                    ew, es = vectors(new)
                    own, nxt = np.array(use), np.array(use) + 1
                    yield pa.RecordBatch.from_arrays([
                        source.take(pa.array(use)),
                        pa.array([len(texts[i]) for i in use], pa.int64()),
                        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in new]),
                        pa.array(to_hex(w[own], s[own])), pa.array(to_hex(ew, es)),
                        pa.array(likeness((w[own], s[own]), (ew, es))),
                        pa.array(likeness((w[own], s[own]), (w[nxt], s[nxt]))),
                    ], names=["doc", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
                last, last_doc = run[-1:], part.column("doc").slice(part.num_rows - 1, 1)

    return rows.mapInArrow(pairs, f"doc {kind}, {_FIELDS}").withColumnRenamed("doc", id_col)


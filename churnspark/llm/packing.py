"""Packing: cutting-stock column generation.

Documents longer than a sequence are cut at its multiples; what is left are
pieces of 1 to ``capacity`` tokens.  Their lengths, in bins, make a histogram
(a few hundred rows, however large the corpus), and the histogram is a
cutting-stock problem: a *pattern* says how many pieces of each bin one
sequence takes.  The linear program over patterns is solved by column
generation: a knapsack by dynamic programming prices the columns with the
duals of the last basis.  Rounded down, patterns cover nearly all pieces;
first-fit decreasing makes patterns of the bounded rest.

The patterns then meet the documents by rank: a bin's pieces are ranked, and
every pattern owns an interval of ranks in each of its bins, so a piece finds
its sequence by one search in a table of the patterns' size.  The driver sees
the histogram and the patterns, never a document.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark.llm.common import bounded_batches, written

END = 0
#: The pre-tokenizer's pattern of byte-level vocabularies (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@cache
def encoder(path: str) -> tiktoken.Encoding:
    """The tokenizer of a byte-level BPE file, as ranks: same ids, a quarter of the time.

    Byte-level vocabularies write each byte as one character: printable ones
    as themselves, the others as the characters from 256 on, in order.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


#: Runs of blanks that the fast encoder's pattern is trusted with: from some 600,000 on it gives up.
SAFE_RUN = 50_000
_LONG_RUN = re.compile(r"\s{%d}" % SAFE_RUN)


@cache
def plain_encoder(path: str) -> tokenizers.Tokenizer:
    return tokenizers.Tokenizer.from_file(path)


def token_ids(path: str, text: str) -> list[int]:
    """The tokenizer's ids, without special tokens added.  A text with a very
    long run of blanks goes to ``tokenizers`` itself: slower, the same ids."""
    if len(text) > SAFE_RUN and _LONG_RUN.search(text):
        return plain_encoder(path).encode(text, add_special_tokens=False).ids
    return encoder(path).encode(text, allowed_special="all")


def pieces(docs: DataFrame, tokenizer: str, capacity: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc, start, length, ids_crc32, doc_tokens``: each text's ids and ``END``, cut at multiples of ``capacity``."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["doc", "start", "length", "ids_crc32", "doc_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for i, t in enumerate(b.column(1)):
                ids = np.array([*token_ids(tokenizer, t.as_py() or ""), END], "<u4")
                rows += [(i, at, len(part := ids[at:at + capacity]), zlib.crc32(part.tobytes()), len(ids))
                         for at in range(0, len(ids), capacity)]
            cols = np.array(rows, np.int64).reshape(-1, 5).T
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(cols[0])), *map(pa.array, cols[1:])], names=names)

    return docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def bin_of(length: Column, capacity: int) -> Column:
    """A length rounded up to its bin: exact up to 1/16 of the capacity, then steps of at most 1/64 of the length."""
    out, top, step = length, capacity // 16, 1
    while top < capacity:
        step *= 2
        out = F.when(length > top, F.least(F.ceil(length / step) * step, F.lit(capacity))).otherwise(out)
        top *= 2
    return out.cast("int")


def copy_steps(sizes: np.ndarray, capacity: int) -> list[tuple[int, int, int]]:
    """(size's number, copies, length): 1, 2, 4, ... copies of each size, whose sums give every count that fits."""
    out = []
    for i, w in enumerate(sizes.tolist()):
        most, k = capacity // w, 1
        while most > 0:
            out.append((i, min(k, most), min(k, most) * w))
            most -= k
            k *= 2
    return out


def best_pattern(steps: list[tuple[int, int, int]], worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Knapsack by dynamic programming over all capacities: the most valuable pattern and its value."""
    value = np.zeros(capacity + 1)
    better = []
    for i, k, length in steps:
        with_it = value[:-length] + k * worth[i]
        won = with_it > value[length:] + 1e-12
        better.append(won)
        np.maximum(value[length:], with_it, out=with_it)
        value[length:] = with_it
    counts, c = np.zeros(len(worth), np.int64), capacity
    for (i, k, length), won in zip(reversed(steps), reversed(better)):
        if c >= length and won[c - length]:
            counts[i] += k
            c -= length
    return float(value[capacity]), counts


def cutting_stock(sizes: list[int], demand: list[int], capacity: int, gap: float = 1e-3) -> list[tuple[np.ndarray, int]]:
    """Patterns (counts per size) and how often each is used; together they hold exactly ``demand``.

    Column generation by the revised simplex method from one-size patterns,
    until no pattern prices in or the bound (objective over the best price)
    is within ``gap``; then rounding down and first-fit decreasing.
    """
    w, b = np.array(sizes, np.int64), np.array(demand, np.float64)
    m = len(w)
    if not m:
        return []
    each, steps = capacity // w, copy_steps(w, capacity)
    basis = np.diag(each).astype(np.float64)
    inverse, x = np.diag(1 / each), b / each
    for _ in range(50 * m + 100):
        duals = inverse.sum(0)
        price, pattern = best_pattern(steps, duals, capacity)
        if price <= 1 + 1e-9 or x.sum() * (1 - 1 / price) <= gap * x.sum():
            break
        d = inverse @ pattern
        ratio = np.where(d > 1e-12, x / np.where(d > 1e-12, d, 1), np.inf)
        out = int(ratio.argmin())
        step = ratio[out]
        x = np.maximum(x - step * d, 0)
        x[out] = step
        basis[:, out] = pattern
        row = inverse[out] / d[out]
        inverse -= np.outer(d, row)
        inverse[out] = row
    used = []
    left = np.array(demand, np.int64)
    for j in range(m):
        pattern = basis[:, j].round().astype(np.int64)
        n = int(min([int(x[j] + 1e-6), *(left[pattern > 0] // pattern[pattern > 0])]))
        if n > 0:
            used.append((pattern, n))
            left -= n * pattern
    order = np.argsort(-w)
    while left.any():
        pattern, room = np.zeros(m, np.int64), capacity
        for i in order:
            pattern[i] = min(left[i], room // w[i])
            room -= pattern[i] * w[i]
        some = pattern > 0
        n = int((left[some] // pattern[some]).min())
        used.append((pattern, n))
        left -= n * pattern
    return used


def rank_in(df: DataFrame, key: str, uid: str, run_rows: int = 50_000) -> DataFrame:
    """``df`` plus ``rank`` (from 0) inside ``key``, by runs of a hash, so that a hot key is no single task's work."""
    runs = max(64, -(-df.count() // run_rows))
    d = df.withColumn("_run", F.pmod(F.xxhash64(uid), F.lit(runs)).cast("int"))
    before = Window.partitionBy(key).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    start = (d.groupBy(key, "_run").agg(F.count(F.lit(1)).alias("_n"))
             .withColumn("_from", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    inside = Window.partitionBy(key, "_run").orderBy(uid)
    return (d.withColumn("_at", F.row_number().over(inside)).join(start, [key, "_run"])
            .withColumn("rank", F.col("_from") + F.col("_at") - 1).drop("_run", "_at", "_from"))


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset``: one row per piece of a document.

    A document is its ids and then ``END``; a null or empty text is ``END``
    alone.  Pieces are cut at multiples of ``capacity`` and lie in exactly one
    sequence, gapless from offset 0; sequences hold at most ``capacity``
    tokens and are numbered from 0 without gaps.  Repeated rows are packed as
    often as they come; equal lengths are ranked by a hash of the piece's row
    number.  No documents give no pieces.  Other columns are ignored.
    """
    cut = written(pieces(docs, tokenizer, capacity, id_col, text_col)
                  .withColumn("uid", F.monotonically_increasing_id())
                  .withColumn("bin", bin_of(F.col("length"), capacity)), "pack-pieces")
    # one row per bin, at most capacity
    histogram = cut.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).orderBy("bin").collect()
    sizes = [r.bin for r in histogram]
    patterns = cutting_stock(sizes, [r.n for r in histogram], capacity)

    # intervals of ranks, all bins one after the other: (first rank, pattern's first sequence, copies a sequence, slot)
    base = np.concatenate([[0], np.cumsum([r.n for r in histogram])]).astype(np.int64)
    place = {s: int(p) for s, p in zip(sizes, base)}
    taken, sequence, table = base[:-1].copy(), 0, []
    for pattern, n in patterns:
        slot = 0
        for i in np.flatnonzero(pattern)[::-1]:
            table.append((int(taken[i]), sequence, int(pattern[i]), slot))
            taken[i] += n * pattern[i]
            slot += int(pattern[i])
        sequence += n
    owners = np.array(sorted(table), np.int64).reshape(-1, 4)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.array([place[x] for x in b.column("bin").to_pylist()], np.int64) + b.column("rank").to_numpy()
            first, seq, copies, slot = owners[np.searchsorted(owners[:, 0], at, "right") - 1].T
            nth = at - first
            cols = dict(zip(b.schema.names, b.columns)) | {
                "sequence_id": pa.array(seq + nth // copies), "slot": pa.array(slot + nth % copies)}
            yield pa.RecordBatch.from_arrays([cols[c] for c in fields], names=fields)

    ranked = rank_in(cut, "bin", "uid").select("doc", "start", "length", "ids_crc32", "doc_tokens", "bin",
                                              F.col("rank").cast("long").alias("rank"))
    fields = ["doc", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "slot"]
    kind = docs.schema[id_col].dataType.simpleString()
    dealt = ranked.mapInArrow(assign, f"doc {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
                                      "sequence_id long, slot long")
    inside = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return dealt.select(F.col("doc").alias(id_col), "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                        F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long").alias("offset"))

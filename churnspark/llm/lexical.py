"""Ranked lexical search: Block-Max MaxScore over segments of compressed postings.

The documents are indexed in *segments* (parts of the partitions that read
them).  A term's postings in a segment are cut into blocks of 128 gaps and
counts in variable-length bytes; every block also has its *front*, the pairs
(occurrences, document length) that no other pair of the block beats.  With
the corpus statistics, known only once all is indexed, the front gives the
block's highest possible score.

A query meets a segment as follows.  Its lists are taken by falling bounds.
While the bounds of the lists not yet taken could together reach the 20th best
score so far, a list is *essential* and read as a whole.  After that, a document
seen in no essential list cannot win.  For the others the bounds of just the
blocks they would be found in are added up, and who cannot reach the 20th best
score is rejected before any such block is decompressed.  Each segment returns
its best documents; these heaps are merged by item.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnspark.llm.common import bounded_batches, bucketed, written

BLOCK = 128
#: Documents and postings at which a segment closes.
SEGMENT_DOCS, SEGMENT_POSTINGS = 1 << 16, 1 << 20
#: (item, term) rows of the queries that are answered together: what is sent to every task.
QUERY_TERMS = 200_000
_CHUNK = 1 << 20
#: ASCII letters and digits stand, A-Z lowered, and so do all bytes from 0x80 on; the rest parts terms.
_PARTS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: str | None) -> Counter:
    """The text's terms (UTF-8) and how often each occurs."""
    raw = (text or "").encode().translate(_PARTS)
    found: Counter = Counter()
    at = 0
    while at < len(raw):  # long texts in pieces, cut between terms
        end = raw.find(b" ", at + _CHUNK)
        end = len(raw) if end < 0 else end
        found.update(raw[at:end].split())
        at = end
    return found


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative integers as variable-length bytes, seven bits each from the lowest, the last one below 128; and their sizes."""
    values = values.astype(np.uint64)
    size = np.ones(len(values), np.int64)
    for s in range(7, 64, 7):
        size += values >= np.uint64(1 << s)
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for i in range(int(size.max()) if len(size) else 0):
        has = size > i
        byte = (values[has] >> np.uint64(7 * i)) & np.uint64(127)
        out[ends[has] - size[has] + i] = byte.astype(np.uint8) | np.where(size[has] > i + 1, 128, 0).astype(np.uint8)
    return out, size


def unpack(raw: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(raw < 128)
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = ends - starts + 1
    out = np.zeros(len(ends), np.int64)
    for i in range(int(size.max()) if len(size) else 0):
        has = size > i
        out[has] |= (raw[starts[has] + i] & np.uint8(127)).astype(np.int64) << (7 * i)
    return out


def _binary(values: np.ndarray, per_row: np.ndarray) -> pa.Array:
    """One binary value a row, of the given numbers of consecutive ``values``."""
    offsets = np.concatenate([[0], np.cumsum(per_row)]) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(per_row), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """The index, written: a row for each (segment, term), and one without a term for each segment's documents.

    ``df`` documents hold the term.  ``last``: each block's last document,
    ``cut``: its first byte in ``postings``, ``fronts``: the size of its front,
    ``front``: those pairs.  ``ids`` and ``lengths`` are those of the segment's
    documents with a term, ``df`` then their number and ``total`` their terms.
    """
    bounded_batches(docs.sparkSession)
    kind, width = docs.schema[id_col].dataType.simpleString(), block
    names = ["segment", "term", "df", "total", "last", "cut", "fronts", "front", "postings", "ids", "lengths"]

    def segment_rows(number: int, vocabulary: dict, term: np.ndarray, doc: np.ndarray, tf: np.ndarray, lengths: np.ndarray, ids: pa.Array) -> Iterator[pa.RecordBatch]:
        nothing = pa.nulls(1, pa.binary())
        yield pa.RecordBatch.from_arrays([
            pa.array([number]), pa.nulls(1, pa.string()), pa.array([len(lengths)]), pa.array([int(lengths.sum())]),
            *[nothing] * 5, pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            pa.array([lengths.astype("<i8").tobytes()], pa.binary())], names=names)
        by = np.argsort(term, kind="stable")
        term, doc, tf = term[by], doc[by], tf[by]
        df = np.bincount(term, minlength=len(vocabulary))
        of_list = np.arange(len(term)) - np.repeat(np.cumsum(df) - df, df)
        first = of_list % width == 0
        block = np.cumsum(first) - 1
        blocks = -(-df // width)  # of each list
        begin = np.flatnonzero(first)
        end = np.append(begin[1:], len(term)) - 1
        gap = np.where(first, doc, np.diff(doc, prepend=0))
        raw, size = pack(np.stack([gap, tf], 1).ravel())
        ends = np.cumsum(size)
        cut = ends[2 * begin] - size[2 * begin]
        list_of = np.repeat(np.arange(len(df)), blocks)
        list_cut = cut[np.cumsum(blocks) - blocks]
        n = lengths[doc]
        order = np.lexsort((n, -tf, block))
        low = n[order] - (block[order] << 40)  # falls from block to block, so each begins anew
        best = low < np.concatenate([[np.iinfo(np.int64).max], np.minimum.accumulate(low)[:-1]])
        front = order[best]
        fronts = np.bincount(block[front], minlength=len(begin))
        per_list = np.add.reduceat(fronts, np.cumsum(blocks) - blocks)
        bytes_of = np.diff(np.append(list_cut, len(raw)))
        whole = pa.RecordBatch.from_arrays([
            pa.array(np.full(len(df), number)), pa.array(list(vocabulary), pa.binary()).cast(pa.string()), pa.array(df), pa.nulls(len(df), pa.int64()),
            _binary(doc[end].astype("<i4"), blocks), _binary((cut - list_cut[list_of]).astype("<i4"), blocks),
            _binary(fronts.astype("<i4"), blocks), _binary(np.stack([tf[front], n[front]], 1).ravel().astype("<i8"), 2 * per_list),
            _binary(raw, bytes_of), pa.nulls(len(df), pa.list_(ids.type)), pa.nulls(len(df), pa.binary())], names=names)
        for at in range(0, len(df), 10_000):
            yield whole.slice(at, 10_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 20
        vocabulary: dict[bytes, int] = {}
        term, tf, held, lengths, ids = array("i"), array("q"), [], [], []

        def close() -> Iterator[pa.RecordBatch]:
            counts = np.array(held, np.int64)
            return segment_rows(number, vocabulary, np.array(term, np.int64), np.repeat(np.arange(len(counts)), counts),
                                np.array(tf, np.int64), np.array(lengths, np.int64), pa.concat_arrays(ids))

        for b in batches:
            for i, text in enumerate(b.column(1)):
                found = terms(text.as_py())
                if not found:
                    continue
                term.extend(vocabulary.setdefault(t, len(vocabulary)) for t in found)
                tf.extend(found.values())
                held.append(len(found))
                lengths.append(found.total())
                ids.append(b.column(0).slice(i, 1))
                if len(ids) >= SEGMENT_DOCS or len(term) >= SEGMENT_POSTINGS:
                    yield from close()
                    number += 1
                    vocabulary, term, tf, held, lengths, ids = {}, array("i"), array("q"), [], [], []
        if ids:
            yield from close()

    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).mapInArrow(
        run, f"segment long, term string, df long, total long, last binary, cut binary, fronts binary, front binary, "
             f"postings binary, ids array<{kind}>, lengths binary")
    return bucketed(rows, "lexical_index", "segment")


def score(tf: np.ndarray, n: np.ndarray, weight: int, docs: int, total: int) -> np.ndarray:
    """What ``tf`` occurrences in a document of ``n`` terms add: rises with ``tf``, falls with ``n``."""
    m = 75 + (25 * n * docs) // total
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


class Postings:
    """One term's list in a segment: bounds at once, blocks decompressed when first needed."""

    def __init__(self, row: dict, weight: int, lengths: np.ndarray, docs: int, total: int, block: int = BLOCK):
        self.last, self.cut = np.frombuffer(row["last"], "<i4"), np.frombuffer(row["cut"], "<i4")
        self.raw, self.df = np.frombuffer(row["postings"], np.uint8), row["df"]
        self.rate = lambda tf, n: score(tf, n, weight, docs, total)
        self.lengths, self.width = lengths, block
        pairs = np.frombuffer(row["front"], "<i8").reshape(-1, 2)
        at = np.cumsum(fronts := np.frombuffer(row["fronts"], "<i4")) - fronts
        self.most = np.maximum.reduceat(self.rate(pairs[:, 0], pairs[:, 1]), at)
        self.bound = int(self.most.max())
        self.read = np.zeros(len(self.last), bool)
        self.docs = np.zeros(self.df, np.int64)
        self.adds = np.zeros(self.df, np.int64)

    def open(self, blocks: np.ndarray) -> None:
        blocks = blocks[~self.read[blocks]]
        if not len(blocks):
            return
        ends = np.append(self.cut[1:], len(self.raw))
        raw = self.raw if len(blocks) == len(self.cut) else np.concatenate([self.raw[self.cut[b]:ends[b]] for b in blocks.tolist()])
        pairs = unpack(raw).reshape(-1, 2)
        count = np.minimum(self.width, self.df - blocks * self.width)
        start = np.cumsum(count) - count
        run = np.cumsum(pairs[:, 0])
        docs = run - np.repeat(run[start] - pairs[start, 0], count)
        at = np.repeat(blocks * self.width - start, count) + np.arange(len(docs))
        self.docs[at], self.adds[at] = docs, self.rate(pairs[:, 1], self.lengths[docs])
        self.read[blocks] = True

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        self.open(np.arange(len(self.last)))
        return self.docs, self.adds

    def block_of(self, docs: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.last, docs)

    def add(self, docs: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """What this term adds to ``docs`` (ascending), which lie in ``blocks`` if anywhere; opens those."""
        self.open(np.unique(blocks))
        out = np.zeros(len(docs), np.int64)
        for b in np.unique(blocks).tolist():
            own = slice(b * self.width, min(self.df, (b + 1) * self.width))
            mine = slice(*np.searchsorted(blocks, [b, b + 1]))
            there = self.docs[own]
            place = np.searchsorted(there, docs[mine])
            out[mine] = np.where(there[place] == docs[mine], self.adds[own][place], 0)
        return out


def best(lists: list[tuple[Postings, int]], docs: int, top: int, seen: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A segment's documents whose score is not below its ``top``-th best, and the scores.  ``seen`` counts blocks, for tests."""
    lists = sorted(lists, key=lambda x: -x[0].bound * x[1])
    bounds = np.array([p.bound * c for p, c in lists], np.int64)
    rest = np.append(np.cumsum(bounds[::-1])[::-1], 0)  # of this list and those after it
    scores, threshold, i = np.zeros(docs, np.int64), 1, 0

    def nth(values: np.ndarray) -> int:
        return max(threshold, int(np.partition(values, len(values) - top)[-top])) if len(values) >= top else threshold

    while i < len(lists) and rest[i] >= threshold:  # essential
        postings, times = lists[i]
        found, adds = postings.all()
        scores[found] += times * adds
        threshold = nth(scores)
        i += 1
    left = np.flatnonzero(scores)
    left = left[scores[left] + rest[i] >= threshold]
    others = lists[i:]
    blocks, most = [], np.zeros((len(others) + 1, len(left)), np.int64)
    for j, (postings, times) in enumerate(others):
        at = postings.block_of(left)
        blocks.append(at)
        most[j] = np.append(postings.most, 0)[at] * times
    most = np.cumsum(most[::-1], 0)[::-1]  # of block j and those after it
    for j, (postings, times) in enumerate(others):
        fit = scores[left] + most[j] >= threshold
        left, most, blocks = left[fit], most[:, fit], [x[fit] for x in blocks]
        inside = blocks[j] < len(postings.last)
        if seen is not None:
            seen["blocks"] += len(postings.last)
            seen["opened"] += len(np.unique(blocks[j][inside]))
        scores[left[inside]] += times * postings.add(left[inside], blocks[j][inside])
        threshold = max(threshold, nth(scores[left]))
    left = left[scores[left] >= threshold]
    return left, scores[left]


def query_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item, term, times``, each pair once; rows of one id are one item."""
    kind = items.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [terms(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))),
                pa.array(list(chain.from_iterable(found)), pa.binary()).cast(pa.string()),
                pa.array(list(chain.from_iterable(f.values() for f in found)), pa.int64())], names=["item", "term", "times"])

    return (items.select(F.col(id_col).alias("item"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"item {kind}, term string, times long").groupBy("item", "term").agg(F.sum("times").alias("times")))


def search(docs: DataFrame, items: DataFrame, top: int = 20, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", block: int = BLOCK) -> DataFrame:
    """``item, rank, doc, score``: each item's ``top`` highest-scoring documents with a score above 0.

    Terms are runs of ASCII letters and digits (A-Z lowered) and of all
    characters beyond ASCII; a null or empty text has none.  Every row of
    ``docs`` is a document of its own, repeated ids too, and counts in the
    statistics if it has a term.  Equal scores go by ascending id, rows without
    an id last; ranks are unique.  Rows of ``items`` with one id, null included,
    are one item; items without a term, and empty tables, give no rows.  Other
    columns are ignored.  Items are answered in blocks of about 200,000
    (item, term) rows, each against the whole index; the terms of a single item
    must fit in memory.
    """
    lists = index(docs, id_col, text_col, block)
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    size = lists.where("term is null").agg(F.sum("df").alias("docs"), F.sum("total").alias("total")).first()
    n, total = size.docs or 0, size.total or 0
    asked = written(query_terms(items, item_col, item_text), "lexical-queries")
    rounds = -(-asked.count() // QUERY_TERMS) if n else 0
    out = docs.sparkSession.createDataFrame([], f"item {item_kind}, doc {kind}, score long")
    for r in range(rounds):
        out = out.unionByName(_answers(lists, asked.where(F.pmod(F.xxhash64("item"), F.lit(rounds)) == r), n, total, top, kind, item_kind, block))
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    return (out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select(F.col("item").alias(item_col), "rank", F.col("doc").alias(id_col), "score"))


def _answers(lists: DataFrame, asked: DataFrame, docs: int, total: int, top: int, kind: str, item_kind: str, block: int) -> DataFrame:
    """Each segment's best documents for a bounded block of items."""
    words = F.broadcast(asked.select("term", F.lit(True).alias("asked")).distinct())  # QUERY_TERMS rows or so
    df = {r.term: r.df for r in lists.select("term", "df").join(words, "term").groupBy("term").agg(F.sum("df").alias("df")).collect()}
    weight = {t: math.floor(1000 * math.log((2 * docs + 2) / (2 * d + 1))) for t, d in df.items()}
    queries: dict = defaultdict(list)
    for r in asked.collect():
        queries[r.item].append((r.term, r.times))

    def run(t: pa.Table) -> pa.Table:
        rows = t.select(["term", "df", "last", "cut", "fronts", "front", "postings", "lengths"]).to_pylist()
        own = next(i for i, r in enumerate(rows) if r["term"] is None)
        lengths = np.frombuffer(rows[own]["lengths"], "<i8")
        names = t["ids"][own].values
        found = {r["term"]: Postings(r, weight[r["term"]], lengths, docs, total, block)
                 for r in rows if r["term"] is not None and weight[r["term"]] > 0}
        items, places, scores = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for item, wanted in queries.items():
            hits, points = best([(found[w], c) for w, c in wanted if w in found], len(lengths), top)
            if len(hits) > top:  # ties for the last place go by id
                by = sorted(zip((-points).tolist(), [(x is None, x) for x in names.take(pa.array(hits)).to_pylist()], range(len(hits))))
                keep = np.array([i for _, _, i in by[:top]])
                hits, points = hits[keep], points[keep]
            items += [item] * len(hits)
            places.append(hits)
            scores.append(points)
        return pa.table({"item": pa.array(items, t_item), "doc": names.take(pa.array(np.concatenate(places))), "score": np.concatenate(scores)})

    t_item = _arrow(item_kind)
    return (lists.join(words, "term", "left").where("asked or term is null")
            .groupBy("segment").applyInArrow(run, f"item {item_kind}, doc {kind}, score long"))


def _arrow(kind: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string
    return to_arrow_type(_parse_datatype_string(kind))

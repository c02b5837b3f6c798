"""Exact dedup: an exchange of Golomb-coded fingerprints.

Most documents have no copy, so most texts need not move.  Rows are dealt to
*blocks*, parts of the partitions that read them.  Each block sends to the
*owners* of the fingerprint ranges its sorted distinct short fingerprints, as
gaps in a Golomb code, and gets back one bit for each: seen in another block
too, or not.  With the repeats inside the block these bits mark the suspects.
Only suspects are shuffled with their texts and compared byte by byte.

A short fingerprint has eight bits more than the row count needs, so about one
lone text in 256 is suspected in vain; the bytes then clear it.  Copies inside
a block are united before anything moves: a text that a third of all rows
share costs one fingerprint and one text for each block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.llm.common import bucketed, shuffle_partitions, written

#: Rows of a block, and fingerprints that one owner holds, at most (on average).
BLOCK_BITS, OWNED = 20, 1 << 20
#: Bits of a fingerprint beyond those that the row count needs.
SPARE_BITS = 8


def golomb(values: np.ndarray) -> bytes:
    """Sorted distinct uint64 as gaps in a Golomb code whose parameter is a power of two.

    The quotients in unary come first (a 1 ends each), then the remainders.
    """
    gaps = np.diff(values, prepend=values[:1])
    gaps[1:] -= np.uint64(1)
    gaps[0] = values[0]
    k = max(0, int(np.log2(max(1.0, 0.69 * float(gaps.mean())))))
    ends = np.cumsum((gaps >> np.uint64(k)) + np.uint64(1)).astype(np.int64)
    unary = np.zeros(int(ends[-1]), np.uint8)
    unary[ends - 1] = 1
    rest = (gaps[:, None] >> np.arange(k, dtype=np.uint64) & np.uint64(1)).astype(np.uint8)
    head = np.array([len(values), k, len(unary)], "<u4").tobytes()
    return head + np.packbits(unary).tobytes() + np.packbits(rest.ravel()).tobytes()


def ungolomb(code: bytes) -> np.ndarray:
    n, k, length = np.frombuffer(code, "<u4", 3).tolist()
    bits = np.frombuffer(code, np.uint8, offset=12)
    size = (length + 7) // 8
    ends = np.flatnonzero(np.unpackbits(bits[:size], count=length))
    gaps = (np.diff(ends, prepend=-1) - 1).astype(np.uint64) << np.uint64(k)
    rest = np.unpackbits(bits[size:], count=n * k).reshape(n, k).astype(np.uint64)
    gaps += (rest << np.arange(k, dtype=np.uint64)).sum(1, dtype=np.uint64)
    gaps[1:] += np.uint64(1)
    return np.cumsum(gaps, dtype=np.uint64)


class Ranges:
    """Short fingerprints and their owners: equal ranges of the ``bits`` leading bits."""

    def __init__(self, rows: int, partitions: int):
        self.bits = max(16, rows.bit_length() + SPARE_BITS)
        self.owners = max(1, partitions, -(-rows // OWNED))
        self.width = -(-(1 << self.bits) // self.owners)

    def short(self, fp: pa.ChunkedArray) -> np.ndarray:
        return fp.to_numpy().view(np.uint64) >> np.uint64(64 - self.bits)

    def cuts(self, distinct: np.ndarray) -> list[tuple[int, int, int]]:
        """(owner, from, to) of the runs of sorted fingerprints that each owner gets."""
        owner = distinct // np.uint64(self.width)
        at = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1, [len(owner)]])
        return [(int(owner[a]), int(a), int(z)) for a, z in zip(at[:-1], at[1:]) if z > a]


def send(blocks: DataFrame, ranges: Ranges) -> DataFrame:
    """``block, owner, code``: what each block sends.  The blocks are read where they lie."""
    def encode(t: pa.Table) -> pa.Table:
        distinct = np.unique(ranges.short(t["fp"]))
        cuts = ranges.cuts(distinct)
        return pa.table({
            "block": pa.array([t["block"][0].as_py()] * len(cuts), pa.int64()),
            "owner": pa.array([o for o, _, _ in cuts], pa.int64()),
            "code": pa.array([golomb(distinct[a:z] - np.uint64(o * ranges.width)) for o, a, z in cuts], pa.binary())})

    return blocks.select("block", "fp").groupBy("block").applyInArrow(encode, "block long, owner long, code binary")


def answer(sent: DataFrame) -> DataFrame:
    """``block, owner, bitmap``: of the fingerprints that a block sent an owner, in order, those that other blocks sent too."""
    def look(t: pa.Table) -> pa.Table:
        values = [ungolomb(c.as_py()) for c in t["code"]]
        _, place, count = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
        flags = np.split(count[place] > 1, np.cumsum([len(v) for v in values])[:-1])
        some = pa.array([i for i, f in enumerate(flags) if f.any()], pa.int64())
        return pa.table({"block": t["block"].take(some), "owner": t["owner"].take(some),
                         "bitmap": pa.array([np.packbits(flags[i]).tobytes() for i in some.to_pylist()], pa.binary())})

    return sent.groupBy("owner").applyInArrow(look, "block long, owner long, bitmap binary")


def suspects(blocks: DataFrame, bitmaps: DataFrame, ranges: Ranges) -> DataFrame:
    """``block, words``: bit ``place`` of the words tells whether the row there may have a copy.  Blocks without one are absent."""
    def apply(rows: pa.Table, maps: pa.Table) -> pa.Table:
        words = []
        if rows.num_rows:
            distinct, at, count = np.unique(ranges.short(rows["fp"]), return_inverse=True, return_counts=True)
            twice, found = count > 1, dict(zip(maps["owner"].to_pylist(), maps["bitmap"].to_pylist()))
            for owner, a, z in ranges.cuts(distinct):
                if owner in found:
                    twice[a:z] |= np.unpackbits(np.frombuffer(found[owner], np.uint8), count=z - a).astype(bool)
            if twice.any():
                place = rows["place"].to_numpy()
                flags = np.zeros((int(place.max()) // 64 + 1) * 64, np.uint8)
                flags[place[twice[at]]] = 1
                words = [(rows["block"][0].as_py(), np.packbits(flags, bitorder="little").view("<i8"))]
        return pa.table({"block": pa.array([b for b, _ in words], pa.int64()),
                         "words": pa.array([w for _, w in words], pa.list_(pa.int64()))})

    return (blocks.select("block", "place", "fp").groupBy("block").cogroup(bitmaps.groupBy("block"))
            .applyInArrow(apply, "block long, words array<long>"))


def normalised(text: Column) -> Column:
    """Each run of \\x20 and \\x09-\\x0D as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _grouped(docs: DataFrame, id_col: str, text_col: str, whole: bool) -> DataFrame:
    spark = docs.sparkSession
    row = [F.struct(*docs.columns).alias("row")] if whole else []
    keep = ["row"] if whole else []
    read = docs.select(F.col(id_col).alias("doc"), normalised(F.col(text_col)).alias("text"), *row,
                       F.monotonically_increasing_id().alias("uid"))
    blocks = bucketed(read.select(
        "uid", F.shiftright("uid", BLOCK_BITS).alias("block"), F.col("uid").bitwiseAND((1 << BLOCK_BITS) - 1).cast("int").alias("place"),
        "doc", F.xxhash64("text").alias("fp"), F.sha2("text", 256).alias("sha"), "text", *keep), "exact_rows", "block")
    ranges = Ranges(blocks.count(), shuffle_partitions(spark))
    marks = written(suspects(blocks, answer(send(blocks, ranges)), ranges), "exact-suspects")

    word = F.element_at("words", F.shiftright("place", 6) + 1)
    marked = (blocks.join(marks.hint("shuffle_hash"), "block", "left")
              .withColumn("suspect", F.coalesce(F.getbit(word, F.col("place").bitwiseAND(63)) == 1, F.lit(False))).drop("words"))
    first = F.struct(F.col("doc").isNull().alias("none"), "doc", "uid")
    in_block = (marked.where("suspect").groupBy("block", "fp", "sha", "text")
                .agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("first")))
    # the bytes decide: a group is one text, whatever its hashes; its SHA-256 names it from here on
    groups = in_block.groupBy("fp", "sha", "text").agg(
        F.sum("n").alias("size"), F.min("first").alias("first"), F.collect_set("block").alias("blocks"))
    per_block = groups.select("sha", "size", "first", F.explode("blocks").alias("block"))
    lone = marked.where("not suspect").select(
        "doc", F.col("doc").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha", *keep)
    shared = (marked.where("suspect").join(per_block, ["block", "sha"])
              .select("doc", F.col("first.doc").alias("keep_id"), F.col("size").alias("group_size"),
                      (F.col("uid") == F.col("first.uid")).alias("kept"), "sha", *keep))
    return lone.unionByName(shared)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``.

    Texts are equal if they are identical once each run of blanks (\\x20,
    \\x09-\\x0D) is one space; a null text is empty.  Of equal texts the row with
    the smallest id stays, a row without an id only if none has one; among rows
    that repeat both id and text one, whichever, stays.  ``keep_id`` is the
    staying row's id, ``group_size`` counts all rows of the group.  Texts may be
    of any length, ids of any type that has an order.  No documents give no
    rows.  Other columns are ignored.
    """
    return _grouped(docs, id_col, text_col, False).withColumnsRenamed({"doc": id_col, "sha": "text_sha256"})


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay (see ``exact_groups``), with all their columns as they were."""
    return _grouped(docs, id_col, text_col, True).where("kept").select("row.*")

"""Exact substring dedup by suffix order and longest-previous-factor arrays.

A byte is a repeat when it lies in a string of ``least`` bytes that also starts
elsewhere in the corpus.  In a suffix array, the earlier matches of a position
are found among its previous and next *smaller positions* in suffix order: the
longest previous factor LPF[i] is the longer common prefix with either.  Only
whether it reaches ``least`` matters, so suffixes are ranked by their first
``least`` bytes and ties stand in order of position: then the previous smaller
position of a tied suffix is its left neighbour, and LPF[i] >= least if and
only if that neighbour has equal rank; mirrored, later matches are found at the
right neighbour.

One suffix array cannot hold the corpus, so equal strings are first brought
together by content:

1. In every string of ``least`` bytes one *anchor*, the ``GRAM`` bytes of least
   hash, is chosen by the string alone.  Consecutive strings with the same
   anchor form a block; equal strings have anchors of equal hash.
2. Anchors that occur once are dropped (most).  Blocks that are equal as a whole
   are one class: all their strings are repeats, whatever their number, and
   one of them stands for the class from here on.
3. Classes that share an anchor but differ (edges of repeated passages) go to
   suffix arrays, many anchors to each.  An anchor with over ``max_classes``
   different blocks (a very common passage, in front of any text) is not put
   into one array: its strings are grouped by 128-bit hash instead, the same
   exact rule by a shuffle with pre-aggregation.

Texts are moved twice, compressed, joined by row key: once to cut out the
blocks of step 3, once to remove the repeats.  Nothing grows on the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.llm.common import bounded_batches, shuffle_partitions, written

GRAM = 48  # 32 + 16, made by doubling
_SEGMENT = 1 << 19
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x94D049BB133111EB], np.uint64)
_BYTE = np.random.default_rng(48).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


def gram_hashes(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes from each place on, by doubling: 2, 4, ... 32, then 32 + 16."""
    h, size = _BYTE[x], 1
    for k in range(5):
        h = h[:-size] * _ODD[k] + h[size:]
        h ^= h >> np.uint64(32)
        size *= 2
        if size == 16:
            h16 = h
    h = h[:len(x) - GRAM + 1] * _ODD[5] + h16[32:]
    h ^= h >> np.uint64(29)
    h *= _ODD[6]
    return h ^ (h >> np.uint64(32))


def blocks(x: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Blocks of a buffer of texts that end at ``ends``: text's number, first and last string start, anchor hash, block hash.

    Starts are places in the buffer; strings do not run over a text's end.
    """
    n = len(x) - least + 1
    if n <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    h = gram_hashes(x)
    place = np.arange(len(h), dtype=np.uint64)
    low = np.uint64((1 << 22) - 1)
    m, size, width = (h & ~low) | place, 1, least - GRAM + 1
    while 2 * size <= width:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    m = np.minimum(m[:n], m[width - size:width - size + n])
    anchor = (m & low).astype(np.int64)
    text = np.searchsorted(ends, np.arange(n), "right")
    inside = np.arange(n) + least <= ends[text]
    new = np.ones(n, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | ~inside[:-1]
    first = np.flatnonzero(new & inside)
    if not len(first):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    change = np.flatnonzero(new | ~inside)
    after = np.searchsorted(change, first, "right")
    last = np.where(after < len(change), change[np.minimum(after, len(change) - 1)], n) - 1
    raw = x.tobytes()
    whole = xxhash.xxh3_64_intdigest
    own = np.array([whole(raw[a:b]) for a, b in zip(first.tolist(), (last + least).tolist())], np.uint64)
    return text[first], first, last, h[anchor[first]].view(np.int64), own.view(np.int64)


def _segments(raw: bytes, least: int) -> Iterator[tuple[int, bytes]]:
    """A long text in pieces that share ``least - 1`` bytes, so that every string starts in exactly one."""
    for at in range(0, max(1, len(raw) - least + 1), _SEGMENT):
        yield at, raw[at:at + _SEGMENT + least - 1]


def find_blocks(texts: DataFrame, least: int) -> DataFrame:
    """``key, s, e, h, own`` of all blocks; ``texts``: ``key, text``."""
    names = ["key", "s", "e", "h", "own"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held: list[tuple[int, int, bytes]] = []
            size = 0

            def flush() -> pa.RecordBatch:
                x = np.frombuffer(b"".join(p for *_, p in held), np.uint8)
                ends = np.cumsum([len(p) for *_, p in held])
                text, s, e, h, own = blocks(x, ends, least)
                # from buffer places to text places
                move = np.array([at for _, at, _ in held], np.int64) - np.concatenate([[0], ends[:-1]])
                keys = np.array([k for k, *_ in held], np.int64)
                s, e = s + move[text], e + move[text]
                return pa.RecordBatch.from_arrays([pa.array(keys[text]), pa.array(s), pa.array(e), pa.array(h), pa.array(own)], names=names)

            for key, t in zip(b.column(0).to_pylist(), b.column(1)):
                for at, piece in _segments((t.as_py() or "").encode(), least):
                    if len(piece) >= least:
                        held.append((key, at, piece))
                        size += len(piece)
                    if size >= _SEGMENT:
                        yield flush()
                        held, size = [], 0
            if held:
                yield flush()

    return texts.mapInArrow(run, "key long, s long, e long, h long, own long")


def ranks(x: np.ndarray, least: int) -> np.ndarray:
    """For each place with ``least`` bytes after it, the rank of those bytes in suffix order (prefix doubling)."""
    wide = np.lib.stride_tricks.sliding_window_view(x, 8)
    rank = np.unique(np.ascontiguousarray(wide).view(">u8").ravel(), return_inverse=True)[1]
    parts, size = {8: rank}, 8
    while 2 * size <= least:
        both = rank[:-size] * (len(x) + 1) + rank[size:]
        rank = np.unique(both, return_inverse=True)[1]
        size *= 2
        parts[size] = rank
    # least as a sum of powers of two, and at last 8 bytes that may overlap
    n, done, out = len(x) - least + 1, size, rank
    out = out[:n]
    for p in sorted(parts, reverse=True)[1:]:
        while done + p <= least:
            out = np.unique(out * (len(x) + 1) + parts[p][done:done + n], return_inverse=True)[1]
            done += p
    if done < least:
        out = np.unique(out * (len(x) + 1) + parts[8][least - 8:least - 8 + n], return_inverse=True)[1]
    return out


def previous_and_next(rank: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether LPF reaches the least length at each suffix, by earlier and by later positions.

    In suffix order with ties by position, the previous smaller position of a
    suffix with an equal one before it is its left neighbour (and the next
    greater one its right neighbour); no other can share its leading bytes.
    """
    order = np.lexsort((position, rank))
    tied = rank[order][1:] == rank[order][:-1]
    earlier, later = np.zeros(len(rank), bool), np.zeros(len(rank), bool)
    earlier[order[1:]] = tied
    later[order[:-1]] = tied
    return earlier, later


def _runs(flags: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each run of flagged places within one group."""
    cut = np.ones(len(flags) + 1, bool)
    cut[1:-1] = (flags[1:] != flags[:-1]) | (group[1:] != group[:-1])
    edge = np.flatnonzero(cut)
    start, end = edge[:-1], edge[1:] - 1
    on = flags[start]
    return start[on], end[on]


_CUT = "key long, s long, h long, n long, place long, bytes binary"


def cut_out(packed: DataFrame, wanted: DataFrame, least: int) -> DataFrame:
    """The bytes of wanted blocks.  ``wanted``: ``key, s, e, h, n, place``; ``packed``: ``key, z`` (compressed text)."""
    asked = wanted.groupBy("key").agg(F.collect_list(F.struct("s", "e", "h", "n", "place")).alias("asked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for b in batches:
            for key, z, asked in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                raw, todo = unzip.decompress(z.as_py()), asked.as_py()
                yield pa.RecordBatch.from_arrays([
                    pa.array([key] * len(todo), pa.int64()), *[pa.array([w[c] for w in todo], pa.int64()) for c in ("s", "h", "n", "place")],
                    pa.array([raw[w["s"]:w["e"] + least] for w in todo], pa.binary())],
                    names=["key", "s", "h", "n", "place", "bytes"])

    # equal rows share a key and a text: one of them is enough
    return (packed.join(asked, "key").select("key", "z", "asked").mapInArrow(run, _CUT)
            .dropDuplicates(["key", "s"]))


def by_suffix_arrays(cut: DataFrame, least: int, keep_first: bool, room: int = 1 << 20) -> DataFrame:
    """``key, s, e``: runs of string starts in the classes' blocks that are repeats; whole anchors to each array."""
    def one(rows: list[tuple]) -> pa.RecordBatch:
        x = np.frombuffer(b"".join(r[5] for r in rows), np.uint8)
        size = np.array([len(r[5]) for r in rows])
        begin = np.concatenate([[0], np.cumsum(size)[:-1]])
        block = np.repeat(np.arange(len(rows)), size)[:len(x) - least + 1]
        start = np.arange(len(x) - least + 1) - begin[block]
        ok = np.flatnonzero(start + least <= size[block])
        rank = ranks(x, least)[ok]
        # order of position in the corpus: documents by their place, then the place in the text
        nth = np.empty(len(rows), np.int64)
        nth[sorted(range(len(rows)), key=lambda i: (rows[i][4], rows[i][0], rows[i][1]))] = np.arange(len(rows))
        doc = nth[block[ok]] * (len(x) + 1) + start[ok]
        earlier, later = previous_and_next(rank, doc)
        many = np.array([r[3] for r in rows]) > 1
        flag = earlier if keep_first else (earlier | later) & ~many[block[ok]]
        a, z = _runs(flag, block[ok])
        i = block[ok][a]
        keys, s = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys[i]), pa.array(s[i] + start[ok][a]), pa.array(s[i] + start[ok][z])], names=["key", "s", "e"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None
        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns]):
                if size >= room and row[2] != last:
                    yield one(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
                last = row[2]
        if held:
            yield one(held)

    return (cut.repartition(shuffle_partitions(cut.sparkSession), "h").sortWithinPartitions("h")
            .mapInArrow(run, "key long, s long, e long"))


def by_string_hash(cut: DataFrame, least: int, keep_first: bool) -> DataFrame:
    """The same for anchors with very many different blocks: every string by its 128-bit hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, s, _, n, place, raw in zip(*[c.to_pylist() for c in b.columns]):
                w = np.frombuffer(b"".join(xxhash.xxh3_128_digest(raw[i:i + least]) for i in range(len(raw) - least + 1)),
                                  "<i8").reshape(-1, 2)
                m = len(w)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(m, key)), pa.array(s + np.arange(m)), pa.array(np.full(m, n)), pa.array(np.full(m, place)),
                     pa.array(w[:, 0].copy()), pa.array(w[:, 1].copy())], names=["key", "s", "n", "place", "w0", "w1"])

    strings = cut.mapInArrow(run, "key long, s long, n long, place long, w0 long, w1 long")
    at = F.struct("place", "key", "s")
    known = strings.groupBy("w0", "w1").agg(F.sum("n").alias("all"), F.min(at).alias("first")).where("all > 1")
    hit = strings.join(known, ["w0", "w1"])
    hit = hit.where(at != F.col("first")) if keep_first else hit.where("n = 1")
    return hit.select("key", "s", F.col("s").alias("e"))


def repeated_runs(texts: DataFrame, packed: DataFrame, least: int, keep_first: bool, max_classes: int = 4096) -> DataFrame:
    """``key, runs``: for each text with repeats, the runs (first, last) of string starts.  ``texts``: ``key, place, text``."""
    found = written(find_blocks(texts.select("key", "text"), least), "suffix-blocks")
    # written, so that the join deals both sides anew and a hot anchor's blocks can be split
    shared = written(found.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "suffix-anchors")
    kept = written(found.join(shared, "h", "left_semi"), "suffix-shared")
    places = texts.select("key", "place").distinct()
    # the class's first member, by its document's place
    first = F.min(F.struct("place", "key", "s", "e"))
    classes = written(kept.join(places, "key").groupBy("h", "own").agg(F.count(F.lit(1)).alias("n"), first.alias("rep")),
                      "suffix-classes")
    mixed = classes.groupBy("h").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    edge = classes.join(mixed, "h").select("rep.key", "rep.s", "rep.e", "h", "n", "rep.place", "kinds")
    cut = written(cut_out(packed, edge.drop("kinds"), least), "suffix-cut")
    huge = written(mixed.where(F.col("kinds") > max_classes).select("h"), "suffix-huge")
    if huge.isEmpty():
        fine = by_suffix_arrays(cut, least, keep_first)
    else:
        fine = by_suffix_arrays(cut.join(huge, "h", "left_anti").select(*cut.columns), least, keep_first).unionByName(
            by_string_hash(cut.join(huge, "h", "left_semi").select(*cut.columns), least, keep_first))
    copies = kept.join(classes.where("n > 1"), ["h", "own"])
    if keep_first:
        copies = copies.where((F.col("key") != F.col("rep.key")) | (F.col("s") != F.col("rep.s")))
    every = copies.select("key", "s", "e").unionByName(fine)
    return every.groupBy("key").agg(F.collect_set(F.struct("s", "e")).alias("runs"))


def covered(runs: list[tuple[int, int]], least: int) -> list[tuple[int, int]]:
    """Maximal spans (start, end) of the bytes that the strings starting in ``runs`` cover."""
    out: list[tuple[int, int]] = []
    for a, z in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], z + least))
        else:
            out.append((a, z + least))
    return out


_RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 200,
                     keep: str = "first", texts: bool = True) -> DataFrame:
    """``id_col, n_bytes, n_removed, n_spans, kept_sha256, spans`` (and ``kept``: the bytes left, if ``texts``).

    ``keep="first"`` leaves the first occurrence of every repeated string (in
    order of id, rows of equal id by a hash) and removes the later ones;
    ``keep="none"`` removes them all.  Repeats are judged on the input.  Texts
    are whole UTF-8 byte strings, a null text is empty, matches never cross
    rows; texts under ``least`` bytes keep everything.  A repeated row repeats
    all its strings; rows that repeat both id and text are treated alike.
    Null ids stand before all others.  An empty table gives no rows.  Other
    columns are ignored.  ``least`` is at least ``GRAM`` + 1.
    """
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("place"))
    rows = rows.withColumn("key", F.xxhash64("place", "text"))

    def zip_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(
                [squeeze.compress(t.as_py().encode()) for t in b.column(2)], pa.binary())], names=["doc", "key", "z"])

    packed = rows.select("doc", "key", "text").mapInArrow(zip_up, f"doc {kind}, key long, z binary")
    runs = repeated_runs(rows.select("key", "place", "text"), packed.select("key", "z"), least, keep == "first")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for b in batches:
            out: list[tuple] = []
            for z, runs in zip(b.column(1), b.column(2)):
                raw = unzip.decompress(z.as_py())
                spans = covered([(r["s"], r["e"]) for r in runs.as_py() or []], least)
                left, at = [], 0
                for a, e in spans:
                    left.append(raw[at:a])
                    at = e
                rest = b"".join([*left, raw[at:]])
                out.append((len(raw), len(raw) - len(rest), len(spans), hashlib.sha256(rest).hexdigest(),
                            [{"start": a, "end": e} for a, e in spans], rest if texts else None))
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string()),
                 pa.array(cols[4], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 pa.array(cols[5], pa.binary())], names=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])

    done = packed.join(runs, "key", "left").select("doc", "z", "runs").mapInArrow(
        finish, f"doc {kind}, {_RESULT}, spans array<struct<start:long,end:long>>, kept binary")
    done = done.withColumnRenamed("doc", id_col)
    return done if texts else done.drop("kept")

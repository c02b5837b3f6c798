"""Sharding: a uniform shuffle with exact shard sizes by a hypergeometric communication matrix.

A uniformly random permutation of N rows, cut into S shards of fixed sizes,
sends a random number of rows from every source partition to every shard.
That matrix has a known law: its rows sum to the partitions' sizes, its columns
to the shards' sizes, and given both it is multivariate hypergeometric.  So

1. the matrix is drawn first, from the partitions' sizes alone;
2. every partition is permuted locally and dealt out by its row of the matrix;
3. the rows are exchanged, and every shard is permuted again.

The result is a uniform shuffle; no global sort, and every shard's size is
exact, not expected.

The matrix is drawn by halving the list of partitions: how many of each
shard's places fall into the left half is one hypergeometric draw per shard,
and both halves go on independently.  Draws are inversions of the exact
probabilities by their ratios from the mode outwards.  All of it is SQL
functions, and all randomness is XXH64 of row ids and seeds, so a lost
executor's tasks give the same rows again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark.llm.common import let, written

#: Source partitions (at least), and rows in each (about, beyond that).
LEAST_PARTITIONS, PARTITION_ROWS = 256, 250_000


def uniform(*what) -> Column:
    """A number in (0, 1) from a hash of columns and literals."""
    bits = F.shiftrightunsigned(F.xxhash64(*[w if isinstance(w, Column) else F.lit(w) for w in what]), 11)
    return (bits.cast("double") + 0.5) / float(1 << 53)


def hypergeometric(marked: Column, total: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` items, taken from ``total`` of which ``marked`` are marked, are marked; by inversion of ``u``.

    Probabilities relative to the mode's follow from the ratio of neighbours.
    They are summed over ten standard deviations on either side of the mode
    (beyond lies less than a double can tell from 0), and the sum is searched
    in the same order: mode, mode + 1, mode - 1, mode + 2, ...
    """
    n, k, t = drawn.cast("double"), marked.cast("double"), total.cast("double")
    lo, hi = F.greatest(F.lit(0.0), n + k - t), F.least(n, k)
    mode = F.least(F.greatest(F.floor((n + 1) * (k + 1) / (t + 2)).cast("double"), lo), hi)
    var = F.when(t > 1, n * (k / t) * (1 - k / t) * (t - n) / (t - 1)).otherwise(0.0)
    steps = (10 * F.sqrt(F.greatest(var, F.lit(0.0))) + 20).cast("int")
    c = F.struct(n.alias("n"), k.alias("k"), t.alias("t"), mode.alias("mode"), steps.alias("steps"), u.alias("u"))

    def draw(c: Column) -> Column:
        n, k, t, mode = c["n"], c["k"], c["t"], c["mode"]
        walk = F.sequence(F.lit(1), c["steps"])

        def up(x):  # p(x + 1) / p(x); 0 past the end
            return F.greatest((k - x) * (n - x), F.lit(0.0)) / ((x + 1) * F.greatest(t - k - n + x + 1, F.lit(1.0)))

        def down(x):  # p(x - 1) / p(x); 0 past the end
            return F.greatest(x * (t - k - n + x), F.lit(0.0)) / ((k - x + 1) * (n - x + 1))

        one = F.lit(1.0)
        whole = F.aggregate(
            walk, F.struct(one.alias("sum"), one.alias("a"), one.alias("b")),
            lambda s, i: let(F.struct((s["a"] * up(mode + i - 1)).alias("a"), (s["b"] * down(mode - i + 1)).alias("b")),
                             lambda w: F.struct((s["sum"] + w["a"] + w["b"]).alias("sum"), w["a"].alias("a"), w["b"].alias("b"))),
            lambda s: s["sum"])
        none = F.lit(None).cast("double")
        begin = let(c["u"] * whole, lambda left: F.struct(
            (left - 1).alias("left"), one.alias("a"), one.alias("b"), F.when(left <= 1, mode).otherwise(none).alias("x")))

        def search(s, i):
            return F.when(s["x"].isNotNull(), s).otherwise(let(
                F.struct((s["a"] * up(mode + i - 1)).alias("a"), (s["b"] * down(mode - i + 1)).alias("b")),
                lambda w: F.struct((s["left"] - w["a"] - w["b"]).alias("left"), w["a"].alias("a"), w["b"].alias("b"),
                                   F.when(s["left"] <= w["a"], mode + i).when(s["left"] <= w["a"] + w["b"], mode - i)
                                   .otherwise(none).alias("x"))))

        return F.aggregate(walk, begin, search, lambda s: F.coalesce(s["x"], mode).cast("long"))

    return let(c, draw)


def hypergeometric_vector(places: Column, drawn: Column, *seeds) -> Column:
    """How many of ``drawn`` items fall on each entry of ``places`` (array of longs): the shards one after the other."""
    begin = F.struct(drawn.alias("drawn"), F.aggregate(places, F.lit(0).cast("long"), lambda a, x: a + x).alias("total"),
                     F.array().cast("array<long>").alias("out"))
    return F.aggregate(
        places, begin,
        lambda s, k: let(hypergeometric(k, s["total"], s["drawn"], uniform(*seeds, F.size(s["out"]))),
                         lambda x: F.struct((s["drawn"] - x).alias("drawn"), (s["total"] - k).alias("total"),
                                            F.concat(s["out"], F.array(x)).alias("out"))),
        lambda s: s["out"])


def communication_matrix(sizes: DataFrame, shards: int, seed: int) -> DataFrame:
    """``part, upto``: for each source partition the running totals of its row of the matrix.

    ``sizes``: ``part`` (0, 1, ...) and ``rows``, one row per partition.  One
    row with the list of all sizes is halved level by level; the number of
    partitions follows the input at one per ``PARTITION_ROWS`` rows.
    """
    total = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x["rows"])
    tree = (sizes.agg(F.array_sort(F.collect_list(F.struct("part", F.col("rows").cast("long").alias("rows")))).alias("sizes"))
            .where(F.size("sizes") > 0)
            .withColumn("n", total)
            # counts at most one apart: the first N mod S shards have one more
            .withColumn("places", F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: (
                F.floor(F.col("n") / shards) + F.when(s < F.col("n") % shards, 1).otherwise(0)).cast("long")))
            .select("sizes", "places"))
    parts = int(sizes.count())
    level = 0
    while (1 << level) < max(parts, 1):
        half = F.greatest(F.floor(F.size("sizes") / 2).cast("int"), F.lit(1))
        many = F.size("sizes") > 1
        left = F.slice("sizes", F.lit(1), half)
        drawn = F.aggregate(left, F.lit(0).cast("long"), lambda a, x: a + x["rows"])
        name = F.element_at("sizes", 1)["part"]
        split = tree.withColumn("got", F.when(many, hypergeometric_vector(F.col("places"), drawn, seed, level, name)))
        tree = split.select(F.explode(F.when(many, F.array(
            F.struct(left.alias("sizes"), F.col("got").alias("places")),
            F.struct(F.slice("sizes", half + 1, F.size("sizes")).alias("sizes"),
                     F.zip_with("places", "got", lambda a, b: a - b).alias("places"))))
            .otherwise(F.array(F.struct("sizes", "places")))).alias("t")).select("t.sizes", "t.places")
        level += 1
        if level % 5 == 0:  # spread the open halves over the cluster
            tree = written(tree.repartition("sizes"), "shard-matrix")
    run = F.aggregate("places", F.array().cast("array<long>"), lambda s, x: F.concat(
        s, F.array(x + F.coalesce(F.try_element_at(s, F.lit(-1)), F.lit(0)))))
    return tree.select(F.element_at("sizes", 1)["part"].alias("part"), run.alias("upto"))


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", seed: int = 17,
          extra: tuple[str, ...] = ()) -> DataFrame:
    """``id_col, size, text_crc32, shard, slot`` (and ``extra`` columns): a uniform shuffle into ``shards`` shards.

    Shard sizes differ by one row at most; ``slot`` is a row's place in its
    shard, gapless from 0.  ``size`` is the text's UTF-8 bytes plus 1; a null
    text has none (size 1, checksum 0).  Rows are shuffled one by one, so
    repeated rows, equal texts and null ids are dealt like any others; with
    fewer rows than shards some stay empty; an empty table gives no rows.
    Other columns are ignored unless named in ``extra``.
    """
    base = written(docs.select(
        F.monotonically_increasing_id().alias("_uid"), F.col(id_col), *extra,
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("_size"),
        F.coalesce(F.crc32(text_col), F.lit(0)).cast("long").alias("_crc")), "shard-rows")
    rows = base.count()
    parts = max(LEAST_PARTITIONS, -(-rows // PARTITION_ROWS))
    dealt = base.withColumn("_part", F.pmod(F.xxhash64("_uid", F.lit(seed)), F.lit(parts)).cast("int"))
    sizes = written(dealt.groupBy(F.col("_part").alias("part")).agg(F.count(F.lit(1)).alias("rows")), "shard-sizes")
    matrix = written(communication_matrix(sizes, shards, seed + 1), "shard-matrix")

    local = Window.partitionBy("_part").orderBy(F.xxhash64("_uid", F.lit(seed + 2)), "_uid")
    bits = max(1, (parts - 1).bit_length())
    sent = (dealt.withColumn("_n", F.row_number().over(local))
            .join(matrix.withColumnRenamed("part", "_part"), "_part")
            .withColumn("shard", F.size(F.filter("upto", lambda c: c < F.col("_n"))))
            .withColumn("_key", F.xxhash64("_uid", F.lit(seed + 3)))
            # the leading bits of the second permutation's key cut a shard into runs that are sorted apart
            .withColumn("_run", F.shiftrightunsigned("_key", 64 - bits))
            .drop("_part", "_n", "upto"))
    sent = written(sent, "shard-sent")
    before = Window.partitionBy("shard").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = (sent.groupBy("shard", "_run").agg(F.count(F.lit(1)).alias("_c"))
            .withColumn("_from", F.coalesce(F.sum("_c").over(before), F.lit(0))).drop("_c"))
    inside = Window.partitionBy("shard", "_run").orderBy("_key", "_uid")
    return (sent.withColumn("_n", F.row_number().over(inside)).join(runs, ["shard", "_run"])
            .select(F.col(id_col), *extra, F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), "shard",
                    (F.col("_from") + F.col("_n") - 1).cast("long").alias("slot")))

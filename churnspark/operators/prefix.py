"""The three physical patterns every ranking / threshold / profile operator uses.

1. ``cumulative``: exact running sums in value order *without* an
   un-partitioned window (which would move every row into one task).  Rows are
   first collapsed to distinct values (map-side partial aggregation, so a hot
   value costs one row), each distinct value gets a bucket between quantiles of
   the values (as many as the row count asks for), running sums are taken inside
   ``(keys, bucket)`` and the per-bucket totals supply the offsets.
2. ``Grid`` + ``sweep``: the threshold sweep.  Each score is binned to the
   number of grid points at or below it, one ``groupBy(model, bin)`` pass
   builds a histogram, and suffix sums over at most a few hundred rows per
   model give the confusion counts at every threshold.  Exact; never a loop
   over thresholds, never a cross join of the big table with the grid.
3. ``long_form``: ``stack`` many columns into ``(column, value)`` so one
   ``groupBy`` profiles all columns in a single job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A bucket is meant for so many rows (one task sorts it).  A key has as many buckets as there are shuffle
#: partitions at most, within these limits: more would not run side by side, and the offsets stay one small sort.
BUCKET_ROWS, MIN_BUCKETS, MAX_BUCKETS = 250_000, 64, 4096


def _keys(keys: Sequence[str] | str | None) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner equi-join on ``keys`` in which null equals null; the keys appear once.

    No broadcast is asked for: the size of the right side follows the keys in
    the data, and the planner measures it."""
    r = right.withColumnsRenamed({k: f"_rk_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_rk_{k}")) for k in keys]
    return left.join(r, on).drop(*[f"_rk_{k}" for k in keys])


def bucketed(d: DataFrame, keys: Sequence[str], v: Column, rows: int = 0, most: int = 0) -> DataFrame:
    """Add ``_b``: each key's rows in ranges of ``v`` of about ``rows`` rows
    (``BUCKET_ROWS``), ``most`` at most (the shuffle partitions, see there).

    The ranges follow the data: one aggregate gives a key's row count and fine
    quantiles, the count says how many of them are used.  So an outlier does not
    fill a range, and a short key has one range only.  A row finds its range by
    a search in two steps (every k-th bound, then k bounds), not along all bounds."""
    partitions = int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows, most = rows or BUCKET_ROWS, most or min(MAX_BUCKETS, max(MIN_BUCKETS, partitions))
    q = d.groupBy(*keys).agg(F.percentile_approx(v, [i / most for i in range(1, most)], 20 * most).alias("_q"),
                             F.count(F.lit(1)).alias("_rows"))
    n = F.ceil(F.col("_rows") / rows)
    n = F.when(2 * n > most, F.lit(most)).otherwise(n).cast("int")  # between, every second quantile or so would be left out unevenly
    none = F.array().cast("array<double>")
    q = q.withColumn("_n", n).withColumn("_cuts", F.when(F.col("_n") > 1, F.transform(
        F.sequence(F.lit(1), F.col("_n") - 1), lambda i: F.element_at("_q", F.floor(i * most / F.col("_n")).cast("int")).cast("double")))
        .otherwise(none))
    step = F.ceil(F.sqrt(F.col("_n"))).cast("int")
    tops = F.when(F.col("_n") > step, F.transform(
        F.sequence(F.lit(1), F.floor((F.col("_n") - 1) / step).cast("int")), lambda j: F.element_at("_cuts", j * step))).otherwise(none)
    q = q.select(*keys, "_cuts", step.alias("_step"), tops.alias("_tops"))
    whole = F.size(F.filter("_tops", lambda c: c < v)) * F.col("_step")
    b = whole + F.size(F.filter(F.slice("_cuts", whole + 1, F.col("_step")), lambda c: c < v))
    return null_safe_join(d, q, keys).withColumn("_b", b).drop("_cuts", "_step", "_tops")


def cumulative(df: DataFrame, keys, order_col: str, measures: Mapping[str, Column],
               descending: bool = False, distinct: bool = True,
               buckets: int | None = None, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Running (inclusive) sums of ``measures`` in ``order_col`` order per key.

    Returns ``keys, order_col, <m>, cum_<m>``, ``prev_<m> = cum - m`` and
    ``all_<m>``, the key's total.  With ``distinct=True`` rows are first collapsed
    to one row per distinct value; with ``distinct=False`` each row keeps its
    columns, and the order column must be unique per key (e.g. a hash of the
    row key) or made so by the ``tiebreak`` columns (deterministic on retries).
    ``buckets`` asks for so many ranges, however few the rows.
    """
    keys = _keys(keys)
    # rows without an order value have no place in an order
    v = F.col(order_col).cast("double")
    df = df.where(F.col(order_col).isNotNull() & ~F.isnan(v))
    gk = keys if keys else []
    if not keys:
        df = df.withColumn("_k0", F.lit(0))
        gk = ["_k0"]
    if distinct:
        d = df.groupBy(*gk, order_col).agg(*[F.sum(c).alias(n) for n, c in measures.items()])
    else:
        d = df.withColumns(dict(measures))
    d = bucketed(d, gk, v, 1, max(2, buckets)) if buckets else bucketed(d, gk, v)
    o = [F.col(order_col).desc() if descending else F.col(order_col).asc()]
    o += [F.col(t).asc() for t in tiebreak]
    w_in = (Window.partitionBy(*gk, "_b").orderBy(*o)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    run = d.withColumns({f"_r_{n}": F.sum(n).over(w_in) for n in measures})
    tot = d.groupBy(*gk, "_b").agg(*[F.sum(n).alias(f"_t_{n}") for n in measures])
    w_key = Window.partitionBy(*gk).orderBy(F.col("_b").desc() if descending else F.col("_b").asc())
    before, whole = w_key.rowsBetween(Window.unboundedPreceding, -1), w_key.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    off = tot.select(*gk, "_b", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in measures],
                     *[F.sum(f"_t_{n}").over(whole).alias(f"all_{n}") for n in measures])
    out = null_safe_join(run, off, gk + ["_b"])
    for n in measures:
        out = (out.withColumn(f"cum_{n}", F.col(f"_o_{n}") + F.col(f"_r_{n}"))
                  .withColumn(f"prev_{n}", F.col(f"cum_{n}") - F.col(n)))
    out = out.drop("_b", *[f"_{p}_{n}" for p in "ro" for n in measures])
    if not keys:
        out = out.drop("_k0")
    return out


def exact_quantiles(df: DataFrame, keys, value_col: str, probs: Sequence[float],
                    names: Sequence[str] | None = None, buckets: int | None = None) -> DataFrame:
    """Exact linearly interpolated quantiles (the pandas / ``percentile`` rule)
    per key, computed from distributed prefix counts: no group is ever
    gathered into one task, whatever its size.  Nulls are ignored.

    Returns ``keys, n, <name_i>`` with ``n`` the non-null count.
    """
    keys = _keys(keys)
    names = list(names) if names else [f"q{int(round(p * 100))}" for p in probs]
    x = df.where(F.col(value_col).isNotNull())
    c = cumulative(x, keys, value_col, {"_n": F.lit(1)}, buckets=buckets).withColumnRenamed("all__n", "n")
    v = F.col(value_col).cast("double")
    aggs = []
    for p, nm in zip(probs, names):
        h = (F.col("n") - 1) * F.lit(float(p))
        aggs.append(F.min(F.when(F.col("cum__n") > F.floor(h), v)).alias(f"_lo_{nm}"))
        aggs.append(F.min(F.when(F.col("cum__n") > F.ceil(h), v)).alias(f"_hi_{nm}"))
        aggs.append(F.first((h - F.floor(h))).alias(f"_f_{nm}"))
    g = c.groupBy(*keys, "n").agg(*aggs)
    cols = [*keys, "n"]
    for nm in names:
        lo, hi, fr = F.col(f"_lo_{nm}"), F.col(f"_hi_{nm}"), F.col(f"_f_{nm}")
        cols.append((lo + (hi - lo) * fr).alias(nm))
    return g.select(*cols)


def median(df: DataFrame, value_col: str, keys=None) -> DataFrame:
    return exact_quantiles(df, keys, value_col, [0.5], ["median"])


class Grid:
    """A threshold grid whose points can be computed on both sides exactly.

    ``Grid.percent(5, 93)`` is ``i/100`` for i = 5..93; ``Grid.linspace`` is
    ``start + i*step`` with the last point equal to ``stop``.
    """

    def __init__(self, start: float, step: float, size: int, stop: float | None = None,
                 denom: int | None = None, lo: int | None = None):
        self.start, self.step, self.size, self.stop = start, step, size, stop
        self.denom, self.lo = denom, lo

    @classmethod
    def percent(cls, lo: int = 5, hi: int = 93) -> "Grid":
        return cls(lo / 100, 0.01, hi - lo + 1, denom=100, lo=lo)

    @classmethod
    def linspace(cls, start: float, stop: float, num: int) -> "Grid":
        return cls(start, (stop - start) / (num - 1), num, stop=stop)

    def point(self, i: Column) -> Column:
        """Grid point number ``i`` (0-based) as a double column."""
        i = i.cast("bigint")
        if self.denom:
            return (i + self.lo) / F.lit(self.denom)
        p = i.cast("double") * F.lit(self.step) + F.lit(self.start)
        return F.when(i == self.size - 1, F.lit(self.stop)).otherwise(p)

    def points(self) -> list[float]:
        if self.denom:
            return [(i + self.lo) / self.denom for i in range(self.size)]
        pts = [i * self.step + self.start for i in range(self.size)]
        pts[-1] = self.stop
        return pts

    def count_le(self, score: Column) -> Column:
        """Number of grid points <= score (0..size); exact, no float drift."""
        if self.denom:
            g = F.floor(score * self.denom).cast("bigint") - self.lo
        else:
            g = F.floor((score - F.lit(self.start)) / F.lit(self.step)).cast("bigint")
        g = F.least(F.greatest(g, F.lit(-1)), F.lit(self.size - 1))
        g = (F.when((g + 1 < self.size) & (self.point(g + 1) <= score), g + 1)
             .when((g >= 0) & (self.point(g) > score), g - 1)
             .otherwise(g))
        return (g + 1).cast("int")


def sweep(df: DataFrame, grid: Grid, keys=("model",), score: str = "score",
          label: str = "label", extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Confusion counts at every grid threshold (predicted positive iff
    score >= t), per key, from one histogram pass.

    Returns ``keys, t_idx, threshold, tp, fp, fn, tn`` plus, for each extra
    measure m (summed over *positive-label rows*), ``fn_<m>`` = the sum over
    false negatives.
    """
    keys = list(keys)
    extra = dict(extra or {})
    y = F.col(label).cast("int")
    k = grid.count_le(F.col(score))
    aggs = [F.sum(y).cast("bigint").alias("_pos"), F.sum(1 - y).cast("bigint").alias("_neg")]
    aggs += [F.sum(F.when(y == 1, c).otherwise(F.lit(0.0))).alias(f"_x_{n}") for n, c in extra.items()]
    hist = df.withColumn("_k", k).groupBy(*keys, "_k").agg(*aggs)
    # one row per (key, threshold index), built from the small histogram itself
    totals = hist.groupBy(*keys).agg(
        F.sum("_pos").alias("P"), F.sum("_neg").alias("N"),
        *[F.sum(f"_x_{n}").alias(f"X_{n}") for n in extra])
    grid_rows = totals.withColumn("t_idx", F.explode(F.sequence(F.lit(0), F.lit(grid.size - 1))))
    # histogram bin k counts for thresholds j < k: row for threshold j sums bins k > j
    w = Window.partitionBy(*keys).orderBy(F.col("t_idx").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    hb = hist.where(F.col("_k") >= 1).withColumn("t_idx", F.col("_k") - 1).drop("_k")
    j = grid_rows.join(hb, keys + ["t_idx"], "left")
    j = j.withColumns({
        "tp": F.sum(F.coalesce(F.col("_pos"), F.lit(0))).over(w),
        "fp": F.sum(F.coalesce(F.col("_neg"), F.lit(0))).over(w),
        **{f"_cx_{n}": F.sum(F.coalesce(F.col(f"_x_{n}"), F.lit(0.0))).over(w) for n in extra},
    })
    out = j.select(
        *keys, "t_idx", grid.point(F.col("t_idx")).alias("threshold"),
        F.col("tp").cast("bigint").alias("tp"), F.col("fp").cast("bigint").alias("fp"),
        (F.col("P") - F.col("tp")).cast("bigint").alias("fn"),
        (F.col("N") - F.col("fp")).cast("bigint").alias("tn"),
        *[(F.col(f"X_{n}") - F.col(f"_cx_{n}")).alias(f"fn_{n}") for n in extra])
    return out


def long_form(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (),
              value_type: str = "double", name: str = "column",
              value: str = "value") -> DataFrame:
    """``stack`` columns into ``(keep..., column, value)`` rows."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS {value_type})" for c in cols)
    return df.selectExpr(*[f"`{k}`" for k in keep],
                         f"stack({len(cols)}, {pairs}) AS (`{name}`, `{value}`)")

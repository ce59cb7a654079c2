"""Order-dependent operators that stay distributed when one group is huge.

``PERCENTILE_CONT`` and ``LAG``/``LEAD``/running max ``OVER (PARTITION BY g ORDER BY t)`` are
normally evaluated with the whole group ``g`` inside one task.  The metric tables group by
*category*, a handful of values, so one group can hold a third of all rows.  Each operator here
has one form, used at every size:

* Percentiles select by rank in three rounds over one table of value frequencies, which is made by one scan and one
  shuffle: cells by the value's logarithm, equal parts of the cell that holds the wanted rank, the values of the one part.
  A task ranks at most as many cells, parts (``2**20``) or doubles as one part can hold (about ``2**19``), whatever the
  number of rows.  Counts and moments come from the cells.
* Neighbours and running maxima cut a group into slices, given by a function of the order column
  (a minute and, where times tie on it, what comes next in the order; a block of bucket numbers), so a row's slice
  depends on the row alone and recomputation after a lost executor finds the same slices.  Windows run inside
  slices; an edge table (one row a slice) carries values across their borders.

Nothing runs while a plan is built.  The sort keys must be a total order (add a unique tie-breaker)
so results do not depend on arrival order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Cells of a doubling of the value, the parts a cell is cut into, and the cell numbers of the least size and of infinity.
OCTAVE_CELLS, PARTS = 16384, 2**20
ZERO_OFFSET, OUTER = 1075 * OCTAVE_CELLS, 2**40


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` treating NULL = NULL (SQL GROUP BY semantics), keeping one key copy."""
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])


def value_cell(value: str | Column) -> Column:
    """A BIGINT cell that doesn't fall as the DOUBLE ``value`` rises (NULL first, NaN last): by sign and logarithm.

    Logarithm, product and floor are monotone, also in floating point.  Zero, the infinities and NaN have a cell each."""
    v = F.col(value) if isinstance(value, str) else value
    size = F.floor(F.log2(F.abs(v)) * OCTAVE_CELLS).cast("bigint") + ZERO_OFFSET
    inf = F.lit(float("inf"))
    cell = (F.when(F.isnan(v), OUTER + 1).when(v == inf, OUTER).when(v == -inf, -OUTER).when(v == 0, 0)
            .when(v > 0, size).otherwise(-size)).cast("bigint")
    return F.coalesce(F.when(v.isNotNull(), cell), F.lit(-OUTER - 1).cast("bigint"))


def exact_percentiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                      probs: dict[str, float], moments: dict[str, str] | None = None) -> DataFrame:
    """Exact ``PERCENTILE_CONT`` per group without collecting a group in one task.

    Returns ``group_cols + [n] + list(probs)`` and, if asked for, ``moments``: names for ``avg``, ``max``, ``min``, ``sum``,
    ``stddev`` and ``variance`` (of a sample) of the non-NULL rows.  The rows at ranks ``floor(p(n-1))`` and ``ceil(p(n-1))`` are
    selected in three rounds over one table of value frequencies (module text), then interpolated as
    ``lo + (pos - floor(pos)) * (hi - lo)``.  NULL values are ignored, as by the SQL aggregate; a NULL group key is a group.
    """
    if not group_cols:
        return exact_percentiles(df.withColumn("_all", F.lit(1)), ["_all"], value_col, probs, moments).drop("_all")
    # The group as one struct: never NULL itself, and equal where its fields are, so joins on it need no null-safe form.
    v, c, n, cell = F.col("_v"), F.col("_c"), F.col("_n"), F.col("_cell")
    freq = (df.filter(F.col(value_col).isNotNull()).groupBy(F.struct(*group_cols).alias("_g"), F.col(value_col).cast("double").alias("_v"))
            .agg(F.count(F.lit(1)).alias("_c")).select("_g", "_v", "_c", value_cell("_v").alias("_cell")))

    # Round 1: cells of a group, and in the same pass its count and moments, each cell's about a point of its own.
    def point(k: Column) -> Column:
        size = F.pow(F.lit(2.0), (F.abs(k) - ZERO_OFFSET) / OCTAVE_CELLS)
        return F.when((k == 0) | (F.abs(k) >= OUTER), 0.0).otherwise(F.signum(k) * size)

    off = v - point(cell)
    cells = freq.groupBy("_g", "_cell").agg(F.sum("_c").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.sum(c * v).alias("_sum"),
                                            F.sum(c * off).alias("_off"), F.sum(c * off * off).alias("_off2"))
    whole, upto = Window.partitionBy("_g"), Window.partitionBy("_g").orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = cells.select("*", F.sum("_n").over(whole).alias("_all"), F.sum("_sum").over(whole).alias("_total"), (F.sum("_n").over(upto) - n).alias("_under"))
    shift = point(cell) - F.col("_total") / F.col("_all")
    squares = F.sum(F.col("_off2") + 2 * shift * F.col("_off") + n * shift * shift).over(whole)
    facts = F.struct(F.col("_all").alias("n"), F.col("_total").alias("sum"), F.min("_lo").over(whole).alias("min"), F.max("_hi").over(whole).alias("max"),
                     F.greatest(squares, F.lit(0.0)).alias("squares"))

    def position(p: float, count: Column) -> Column:
        return F.lit(float(p)) * (count - 1).cast("double")

    wanted = F.array(*[F.struct(F.lit(2 * i + up).alias("t"), edge(position(p, F.col("_all"))).cast("bigint").alias("rank"))
                       for i, p in enumerate(probs.values()) for up, edge in enumerate((F.floor, F.ceil))])
    inside = F.filter(wanted, lambda x: (F.col("_under") <= x["rank"]) & (x["rank"] < F.col("_under") + n))
    targets = ranked.select("_g", "_cell", "_lo", "_hi", "_under", facts.alias("_m"), inside.alias("_w")).select(
        "_g", "_cell", "_lo", "_hi", "_under", "_m", F.explode("_w").alias("_w")).select(
        "_g", "_cell", "_lo", "_hi", "_m", F.col("_w.t").alias("_t"), (F.col("_w.rank") - F.col("_under")).alias("_rank"))

    # Rounds 2 and 3: equal parts of the cell that holds the rank, then the values of one part.
    def held(rows: DataFrame, order: str, *more: str) -> DataFrame:
        upto = F.sum("_n").over(Window.partitionBy("_g", "_t").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - n
        return rows.select("*", upto.alias("_under")).filter((F.col("_under") <= F.col("_rank")) & (F.col("_rank") < F.col("_under") + n)).select(
            "_g", "_t", "_m", (F.col("_rank") - F.col("_under")).alias("_rank"), *more)

    width = F.col("_hi") - F.col("_lo")
    share = F.when(width > 0, F.least(F.floor((v - F.col("_lo")) / width * PARTS), F.lit(PARTS - 1))).otherwise(0).cast("bigint")
    parts = (freq.join(targets, ["_g", "_cell"]).groupBy("_g", "_t", "_rank", "_m", "_cell", share.alias("_part"))
             .agg(F.sum("_c").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")))
    targets = held(parts, "_part", "_cell", "_lo", "_hi")
    values = freq.withColumnRenamed("_c", "_n").join(targets, ["_g", "_cell"]).filter(v.between(F.col("_lo"), F.col("_hi"))).repartition("_g")
    out = held(values, "_v", "_v").groupBy("_g").agg(F.first("_m").alias("_m"), *[F.max(F.when(F.col("_t") == t, v)).alias(f"_v{t}") for t in range(2 * len(probs))])

    def between(i: int, p: float) -> Column:
        low, high, pos = F.col(f"_v{2 * i}"), F.col(f"_v{2 * i + 1}"), position(p, F.col("_m.n"))
        # Equal neighbours stay as they are, infinite ones too.
        return F.when(low == high, low).otherwise(low + (pos - F.floor(pos)) * (high - low))

    count, total = F.col("_m.n"), F.col("_m.sum")
    variance = F.when(count > 1, F.col("_m.squares") / (count - 1))
    known = {"avg": total / count, "max": F.col("_m.max"), "min": F.col("_m.min"), "sum": total, "stddev": F.sqrt(variance), "variance": variance}
    return out.select(*[F.col(f"_g.{name}").alias(name) for name in group_cols], count.alias("n"),
                      *[between(i, p).alias(name) for i, (name, p) in enumerate(probs.items())],
                      *[known[m].alias(name) for m, name in (moments or {}).items()])


def tie_slice(ts: str, *rest: Column) -> Column:
    """Slices for an order by ``ts`` and then by ``rest``: the minute, and for rows exactly on it the cells of ``rest``.

    Timestamps of a coarse grain (a day, an hour, a minute) tie many rows, which so are dealt by what comes next in the
    order; the rows between two minutes follow in one slice.  A row's slice depends on the row alone."""
    minute = F.date_trunc("minute", ts).cast("timestamp_ntz")
    tied = F.col(ts) == minute
    return F.struct(minute.alias("minute"), (~tied).alias("between"), F.when(tied, F.struct(*rest)).alias("tie"))


def neighbors(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence[str | Column], slice_by: Column,
              value_col: str, prev_name: str | None = "prev_value", next_name: str | None = "next_value") -> DataFrame:
    """``LAG(v, 1)`` and ``LEAD(v, 1) OVER (PARTITION BY p ORDER BY o)`` for hot partitions.

    ``order_cols`` (ascending) must make the order total within a partition; ``slice_by`` must not
    fall as the order rises.  Lag and lead run inside each slice; the first and last row of a slice
    take theirs from the neighbouring slice through the edge table.
    """
    pc = list(partition_cols)
    oc = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    sliced = df.withColumn("_slice", slice_by)
    w = Window.partitionBy(*pc, "_slice").orderBy(*oc)
    cols = {"_first": F.lag(F.lit(1)).over(w).isNull(), "_last": F.lead(F.lit(1)).over(w).isNull()}
    if prev_name:
        cols["_lag"] = F.lag(value_col).over(w)
    if next_name:
        cols["_lead"] = F.lead(value_col).over(w)
    okey = F.struct(*oc)
    edges = sliced.groupBy(*pc, "_slice").agg(F.min_by(F.struct(value_col), okey).alias("_fv"),
                                              F.max_by(F.struct(value_col), okey).alias("_lv"))
    ew = Window.partitionBy(*pc).orderBy("_slice")
    edges = edges.select(*pc, "_slice", F.lag("_lv").over(ew)[value_col].alias("_in_prev"),
                         F.lead("_fv").over(ew)[value_col].alias("_in_next"))
    out = null_safe_join(sliced.withColumns(cols), edges, [*pc, "_slice"])
    new = {}
    if prev_name:
        new[prev_name] = F.when(F.col("_first"), F.col("_in_prev")).otherwise(F.col("_lag"))
    if next_name:
        new[next_name] = F.when(F.col("_last"), F.col("_in_next")).otherwise(F.col("_lead"))
    return out.withColumns(new).drop("_lag", "_lead", "_first", "_last", "_in_prev", "_in_next", "_slice")


def running_max(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence[str | Column], slice_by: Column,
                value_col: str, out_col: str) -> DataFrame:
    """``MAX(v) OVER (PARTITION BY p ORDER BY o ROWS UNBOUNDED PRECEDING)`` for hot partitions.

    Slices as in :func:`neighbors`: a running max inside each, and the max of all earlier slices of
    the same partition from the edge table.
    """
    pc = list(partition_cols)
    oc = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    sliced = df.withColumn("_slice", slice_by)
    w = Window.partitionBy(*pc, "_slice").orderBy(*oc).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edges = sliced.groupBy(*pc, "_slice").agg(F.max(value_col).alias("_slice_max"))
    ew = Window.partitionBy(*pc).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.select(*pc, "_slice", F.max("_slice_max").over(ew).alias("_carry"))
    out = null_safe_join(sliced.withColumn("_inner", F.max(value_col).over(w)), edges, [*pc, "_slice"])
    return out.withColumn(out_col, F.greatest(F.col("_inner"), F.col("_carry"))).drop("_inner", "_carry", "_slice")

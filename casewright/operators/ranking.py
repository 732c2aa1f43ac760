"""Global order without a single-task window.

Rows are range-partitioned on the sort columns (a unique last column keeps ties apart, so a hot value
still splits), sorted inside partitions and numbered there. Per-partition totals give the offsets. The
numbered rows are written once, so a recomputed task can never see different boundaries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from casewright.session import cut_lineage, parallelism

_PART, _LOCAL, _OFF = "_part", "_local", "_offset"


# Rows of one range, about.
RANGE_ROWS = 1_000_000


def _ordered(df: DataFrame, order: Sequence[Column], stored: bool = False) -> DataFrame:
    # written first, unless it is a ``stored`` table, so the boundaries' sample reads a table instead of computing the rows
    # once more, and counted, so the number of ranges follows the rows
    table = df if stored else cut_lineage(df)
    n = max(parallelism(df.sparkSession), -(-table.count() // RANGE_ROWS))
    numbered = (
        table.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    numbered = numbered.select(
        "*",
        F.shiftright("_mid", 33).cast("int").alias(_PART),
        F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)).alias(_LOCAL),
    ).drop("_mid")
    return cut_lineage(numbered)


def _segment_offsets(ordered: DataFrame, groups: Sequence[str], value: Column, reverse: bool, combine) -> DataFrame:
    """Per (group, partition) offset: ``combine`` over the segments before (or after) this one.

    A group has at most one segment per range partition, so these windows stay short.
    """
    seg = ordered.groupBy(*groups, _PART).agg(value.alias("_v"))
    order = F.col(_PART).desc() if reverse else F.col(_PART).asc()
    keys = [F.col(g) for g in groups] or [F.lit(0)]
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return seg.select(*groups, _PART, combine(F.col("_v")).over(w).alias(_OFF))


def _attach(ordered: DataFrame, offsets: DataFrame, groups: Sequence[str]) -> DataFrame:
    on = [F.col(f"l.{_PART}") == F.col(f"r.{_PART}")]
    on += [F.col(f"l.{g}").eqNullSafe(F.col(f"r.{g}")) for g in groups]
    return ordered.alias("l").join(offsets.alias("r"), on, "left").select("l.*", f"r.{_OFF}")


def global_rank(
    df: DataFrame, order: Sequence[Column], out: str = "rank", groups: Sequence[str] = (), keep_segments: bool = False,
    stored: bool = False,
) -> DataFrame:
    """1-based row number over the whole frame (or per group). ``order`` must end in a unique column.

    ``stored``: the frame is read from a written table, so it is not written once more.
    """
    ordered = _ordered(df, [*[F.col(g) for g in groups], *order], stored)
    w = [F.col(g) for g in groups]
    first = F.min(_LOCAL)
    if not groups:
        offsets = _segment_offsets(ordered, groups, F.count(F.lit(1)), False, F.sum)
        ranked = _attach(ordered, offsets, groups).withColumn(
            out, F.coalesce(F.col(_OFF), F.lit(0)) + F.col(_LOCAL) + 1
        )
    else:
        seg = ordered.groupBy(*groups, _PART).agg(F.count(F.lit(1)).alias("_v"), first.alias("_first"))
        win = Window.partitionBy(*w).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
        offsets = seg.select(
            *groups, _PART, (F.coalesce(F.sum("_v").over(win), F.lit(0)) - F.col("_first")).alias(_OFF)
        )
        ranked = _attach(ordered, offsets, groups).withColumn(out, F.col(_OFF) + F.col(_LOCAL) + 1)
    ranked = ranked.drop(_OFF)
    return ranked if keep_segments else ranked.drop(_PART, _LOCAL)


_SCANS = {"sum": F.sum, "max": F.max}


def global_scan(
    df: DataFrame,
    order: Sequence[Column],
    scans: dict[str, tuple[Column, str]],
    groups: Sequence[str] = (),
    exclusive: bool = False,
    stored: bool = False,
) -> DataFrame:
    """Running ``sum`` or ``max`` over the global (or per-group) order; ``exclusive`` leaves the row itself out."""
    tmp = {f"_x{i}": v for i, (v, _) in enumerate(scans.values())}
    ordered = _ordered(df.withColumns(tmp), [*[F.col(g) for g in groups], *order], stored)
    out = ordered
    w = (
        Window.partitionBy(*groups, _PART)
        .orderBy(_LOCAL)
        .rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    )
    for i, (name, (_, kind)) in enumerate(scans.items()):
        fn = _SCANS[kind]
        offsets = _segment_offsets(ordered, groups, fn(f"_x{i}"), False, fn)
        out = _attach(out, offsets, groups)
        local = fn(f"_x{i}").over(w)
        zero = F.lit(0)
        merged = (
            F.coalesce(local, zero) + F.coalesce(F.col(_OFF), zero) if kind == "sum" else F.greatest(local, F.col(_OFF))
        )
        out = out.withColumn(name, merged).drop(_OFF)
    return out.drop(_PART, _LOCAL, *tmp)


def global_cumsum(
    df: DataFrame, order: Sequence[Column], sums: dict[str, Column], groups: Sequence[str] = (), stored: bool = False
) -> DataFrame:
    """Inclusive running sums over the global (or per-group) order."""
    return global_scan(df, order, {k: (v, "sum") for k, v in sums.items()}, groups, stored=stored)


def suffix_min(ranked: DataFrame, value: Column, out: str, groups: Sequence[str] = ()) -> DataFrame:
    """Minimum of ``value`` over this row and all later rows; input comes from ``global_rank(keep_segments=True)``."""
    valued = ranked.withColumn("_x", value)
    offsets = _segment_offsets(valued, groups, F.min("_x"), True, F.min)
    joined = _attach(valued, offsets, groups)
    w = Window.partitionBy(*groups, _PART).orderBy(F.desc(_LOCAL)).rowsBetween(Window.unboundedPreceding, 0)
    return joined.withColumn(out, F.least(F.min("_x").over(w), F.col(_OFF))).drop(
        "_x", _OFF, _PART, _LOCAL
    )


def benjamini_hochberg(
    df: DataFrame, p: str, out: str, key: Sequence[str], groups: Sequence[str] = ()
) -> DataFrame:
    """FDR q-values. n counts every row of the group, NULL p included; a NULL p keeps a NULL q."""
    df = cut_lineage(df)  # read three times: totals, ranks and rows without p
    totals = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"))
    ranked = global_rank(
        df.filter(F.col(p).isNotNull()),
        [F.col(p), *[F.col(k) for k in key]],
        "_rank",
        groups,
        keep_segments=True,
        stored=True,
    )
    if groups:
        on = [F.col(f"l.{g}").eqNullSafe(F.col(f"r.{g}")) for g in groups]
        ranked = ranked.alias("l").join(totals.alias("r"), on).select("l.*", "r._n")
    else:
        ranked = ranked.crossJoin(F.broadcast(totals))  # one row
    adjusted = F.col(p) * F.col("_n") / F.col("_rank")
    q = suffix_min(ranked, F.least(adjusted, F.lit(1.0)), out, groups).drop("_rank", "_n")
    nulls = df.filter(F.col(p).isNull()).withColumn(out, F.lit(None).cast("double"))
    return q.unionByName(nulls.select(*q.columns))


def exact_quantiles(
    df: DataFrame, value: str, probs: dict[str, float], groups: Sequence[str] = (), weight: Column | None = None
) -> DataFrame:
    """Exact linear-interpolation quantiles per group for values with unbounded distinct counts.

    Values are counted first, then placed by a global running count, so no task holds a whole group.
    """
    counted = cut_lineage(  # read by the running counts and the totals
        df.filter(F.col(value).isNotNull())
        .groupBy(*groups, value)
        .agg((F.sum(weight) if weight is not None else F.count(F.lit(1))).alias("_n"))
    )
    cum = global_cumsum(counted, [F.col(value)], {"_cum": F.col("_n")}, groups, stored=True)
    totals = counted.groupBy(*groups).agg(F.sum("_n").alias("_total"))
    if groups:
        on = [F.col(f"l.{g}").eqNullSafe(F.col(f"r.{g}")) for g in groups]
        placed = cum.alias("l").join(totals.alias("r"), on).select("l.*", "r._total")
    else:
        placed = cum.crossJoin(F.broadcast(totals))  # one row
    at = lambda k: F.min(F.when(F.col("_cum") > k, F.col(value)))
    aggs = []
    for i, p in enumerate(probs.values()):
        h = (F.col("_total") - 1) * F.lit(float(p))
        aggs += [at(F.floor(h)).alias(f"_lo{i}"), at(F.ceil(h)).alias(f"_hi{i}"), F.max(h - F.floor(h)).alias(f"_f{i}")]
    found = placed.groupBy(*groups).agg(*aggs)
    return found.select(
        *groups,
        *[
            (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).alias(name)
            for i, name in enumerate(probs)
        ],
    )

"""Greedy k:1 case-control matching, exact at any stratum size.

Cases are served in (index date, person id) order; each takes its best still-free controls by (age
distance, index distance, person id). Strata are independent.

* A stratum whose checked size fits one task is matched by the sequential greedy inside that task.
* A larger stratum goes through rounds. Every case gets its best few candidates from size-bounded chunks
  of controls (age band × time band × salt; only the best of a chunk leave the task). Cases propose to
  their first k open candidates, a control keeps its earliest case, the others are rejected and move on.
  With all controls ranking cases by one global order this ends in the sequential greedy's result. A case
  that runs out of listed candidates gets a fresh list without the controls it can no longer have. Between rounds, cases of
  neighbouring index dates settle among themselves inside tasks, in blocks of bounded size, so that a chain of rejections
  does not take a round for each link. Where the controls in reach of a block fit a task, the lists of its cases that run out are
  made anew there, of what earlier cases of the block leave, so that cases that want the same controls do not list them again
  and again. Where controls are dense, lists are sought nearby first (``_reaches``).
* Where a case below the minimum takes nobody, which cases fall short is itself settled in rounds: given the ones
  assumed so far, who hold nothing but still list what earlier cases leave them, all cases are judged again at once.
  A judgement is right as soon as those of the earlier cases that it depends on are, so cases that cannot affect each
  other are all released in one round, and a round leaves the earliest wrong one right for good.
* With reuse allowed there is no contention, so the candidate step alone is the answer.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from casewright.functions.scalars import age_at, lenient_date, lenient_double, observation_midpoint, truthy
from casewright.rules import Matching
from casewright.session import cut_lineage, cut_union

STRATUM_LIMIT = 100_000  # people of one stratum matched inside one task
CHUNK_LIMIT = 20_000  # controls, and cases, of one chunk
LIST_SLACK = 8  # candidates listed per needed control
BLOCK_CASES = 20_000  # cases that settle among themselves in one task
BLOCK_CONTROLS = 200_000  # controls in reach of a block, about, with which its task can make fresh lists

ASSIGNMENT = "case_id string, control_id string, match_rank int, age_at_case_index double"


def _order_key() -> Column:
    """Text whose order is (index date, NULL last, then person id)."""
    return F.concat_ws("|", F.coalesce(F.col("index_date").cast("string"), F.lit("9999-99-99")), "person_id")


def _stratum(df: DataFrame, columns: Sequence[str]) -> Column:
    """Exact-match columns as one key; missing matches missing."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("__MISSING__")) for c in columns if c in df.columns]
    return F.to_json(F.array(*parts)) if parts else F.lit("[]")


def match_inputs(cohort: DataFrame, rules: Matching) -> tuple[DataFrame, DataFrame]:
    """Slim case and control frames with day numbers since the epoch."""
    epoch = F.lit("1970-01-01").cast("date")
    day = lambda c: F.datediff(lenient_date(c), epoch).cast("double")
    have = set(cohort.columns)
    number = lambda c: lenient_double(c) if c in have else F.lit(None).cast("double")
    birth = day("birth_date") if "birth_date" in have else F.lit(None).cast("double")
    if rules.tier == "broad" and "broad_case" in have:
        is_case = F.coalesce(F.col("broad_case").cast("int"), F.lit(0)) == 1
    else:
        is_case = F.col("case_tier") == rules.tier
    dated = cohort.withColumn("index_date", lenient_date("index_date"))
    cases = dated.filter(is_case).select(
        _stratum(cohort, rules.same).alias("stratum"),
        F.col("person_id").cast("string").alias("case_id"),
        _order_key().alias("case_order"),
        F.datediff("index_date", epoch).cast("double").alias("index_day"),
        F.year("index_date").cast("double").alias("index_year"),
        number("age_at_index").alias("age"),
    )
    midpoint = observation_midpoint(lenient_date("obs_start_date"), lenient_date("obs_end_date"))
    anchor = F.coalesce(day("baseline_index_date"), midpoint) if "baseline_index_date" in have else midpoint
    controls = cohort.filter(truthy("eligible_control")).select(
        _stratum(cohort, rules.same).alias("stratum"),
        F.col("person_id").cast("string").alias("control_id"),
        day("obs_start_date").alias("start_day"),
        day("obs_end_date").alias("end_day"),
        anchor.alias("anchor"),
        number("year_of_birth").alias("yob"),
        birth.alias("birth_day"),
        number("age_at_index").alias("age"),
    )
    return cases, controls


def _candidates(case, c: dict[str, np.ndarray], free, window: int, tolerance: float) -> tuple[np.ndarray, ...]:
    """Indices of admissible controls with (age distance, index distance, age at the case's index date).

    ``c`` is sorted by anchor; ``free`` tells which controls of a slice are free.
    """
    if np.isnan(case.age):
        return np.empty(0, int), np.empty(0), np.empty(0), np.empty(0)
    if np.isnan(case.index_day):
        at = np.flatnonzero(free(slice(None)))
        age, distance = c["age"][at], np.full(len(at), float(window))
    else:
        low = np.searchsorted(c["anchor"], case.index_day - window - 1)
        near = slice(low, np.searchsorted(c["anchor"], case.index_day + window + 1, side="right"))
        with np.errstate(invalid="ignore"):
            ok = (
                ~(c["start_day"][near] > case.index_day)
                & ~(c["end_day"][near] < case.index_day)
                & (np.floor(np.abs(c["anchor"][near] - case.index_day)) <= window)
                & free(near)
            )
        at = low + np.flatnonzero(ok)
        distance = np.floor(np.abs(c["anchor"][at] - case.index_day))
        age = np.where(
            ~np.isnan(c["yob"][at]),
            case.index_year - c["yob"][at],
            np.where(~np.isnan(c["birth_day"][at]), (case.index_day - c["birth_day"][at]) / 365.25, c["age"][at]),
        )
    gap = np.abs(age - case.age)
    with np.errstate(invalid="ignore"):
        near = gap <= tolerance
    return at[near], gap[near], distance[near], age[near]


_NUMERIC = ("start_day", "end_day", "anchor", "yob", "birth_day", "age")


def _arrays(controls: pd.DataFrame) -> dict[str, np.ndarray]:
    controls = controls.sort_values("anchor")
    out = {name: controls[name].to_numpy(float) for name in _NUMERIC}
    out["id"] = controls["control_id"].to_numpy(str)
    return out


def _best(c: dict[str, np.ndarray], found: tuple[np.ndarray, ...], k: int) -> np.ndarray:
    at, gap, distance, _ = found
    if len(at) > 4 * k:
        # keep everything that ties with the k-th smallest age distance, then order exactly
        cut = np.partition(gap, k - 1)[k - 1]
        inside = np.flatnonzero(gap <= cut)
    else:
        inside = np.arange(len(at))
    order = np.lexsort((c["id"][at[inside]], distance[inside], gap[inside]))
    return inside[order[:k]]


def greedy_in_task(rules: Matching):
    """Sequential greedy over one stratum (cases and controls of a size-checked stratum)."""

    def match(cases: pd.DataFrame, controls: pd.DataFrame) -> pd.DataFrame:
        c = _arrays(controls)
        free = np.ones(len(controls), dtype=bool)
        rows = []
        for case in cases.sort_values("case_order").itertuples(index=False):
            found = _candidates(case, c, lambda part: free[part], rules.within.days, rules.within.years)
            if not len(found[0]):
                continue
            chosen = _best(c, found, rules.controls.wanted)
            if len(chosen) < rules.controls.least and rules.controls.whole:
                continue
            picked = found[0][chosen]
            rows += [
                (case.case_id, c["id"][i], rank, float(found[3][j]))
                for rank, (i, j) in enumerate(zip(picked, chosen, strict=True), start=1)
            ]
            if not rules.controls.reuse:
                free[picked] = False
        return pd.DataFrame(rows, columns=["case_id", "control_id", "match_rank", "age_at_case_index"])

    return match


# Large strata ------------------------------------------------------------------------------------

def _cells(cases: DataFrame, controls: DataFrame, rules: Matching) -> tuple[DataFrame, DataFrame]:
    """Copies of cases and controls keyed by (stratum, kind, age band, time band).

    ``kind`` says which age source a control uses; a case aims at each kind with its own target value.
    Controls sit in one cell per kind; a case visits the neighbouring cells its tolerance can reach.
    """
    width = max(rules.within.years, 1.0)
    span = max(rules.within.days, 1)
    # whole years lie in the middle of a band, so that a tolerance of 0 reaches one
    band = lambda c: F.floor(c / width + 0.5)
    kind = F.when(F.col("yob").isNotNull(), "yob").when(F.col("birth_day").isNotNull(), "birth").otherwise("age")
    value = F.coalesce(F.col("yob"), F.col("birth_day") / 365.25, F.col("age"))
    dated = controls.filter(F.col("anchor").isNotNull()).select(
        "*", kind.alias("kind"), band(value).alias("age_band"), F.floor(F.col("anchor") / span).alias("time_band")
    )
    undated = controls.select(
        "*", F.lit("undated").alias("kind"), band(F.col("age")).alias("age_band"),
        F.lit(0).cast("long").alias("time_band"),
    )
    controls = dated.unionByName(undated).filter(F.col("age_band").isNotNull())
    targets = F.when(
        F.col("index_day").isNotNull(),
        F.array(
            F.struct(F.lit("yob").alias("kind"), (F.col("index_year") - F.col("age")).alias("t")),
            F.struct(F.lit("birth").alias("kind"), (F.col("index_day") / 365.25 - F.col("age")).alias("t")),
            F.struct(F.lit("age").alias("kind"), F.col("age").alias("t")),
        ),
    ).otherwise(F.array(F.struct(F.lit("undated").alias("kind"), F.col("age").alias("t"))))
    slack = rules.within.years + 1e-6
    cases = cases.filter(F.col("age").isNotNull()).select("*", F.inline(targets))
    cases = cases.withColumn(
        "age_band", F.explode(F.sequence(band(F.col("t") - slack), band(F.col("t") + slack)))
    )
    first = F.floor((F.col("index_day") - span - 1) / span)
    last = F.floor((F.col("index_day") + span + 1) / span)
    bands = F.when(F.col("index_day").isNotNull(), F.sequence(first, last)).otherwise(
        F.array(F.lit(0).cast("long"))
    )
    return cases.withColumn("time_band", F.explode(bands)).drop("t"), controls


_CELL = ["stratum", "kind", "age_band", "time_band"]


def _parts(n: str, chunk: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.col(n) / chunk)).cast("int")


def _cell_sizes(case_cells: DataFrame, control_cells: DataFrame, chunk: int) -> DataFrame:
    counted = case_cells.groupBy(*_CELL).agg(F.count(F.lit(1)).alias("_nc"))
    joined = counted.join(control_cells.groupBy(*_CELL).agg(F.count(F.lit(1)).alias("_nk")), _CELL)
    sizes = joined.select(*_CELL, _parts("_nc", chunk).alias("_case_parts"), _parts("_nk", chunk).alias("_control_parts"))
    return cut_lineage(sizes.withColumn("cell", F.monotonically_increasing_id()))


def _reaches(cases: DataFrame, controls: DataFrame, rules: Matching, chunk: int) -> list[tuple[Matching, DataFrame]]:
    """Tolerances to seek within, widest first, with the sizes of their cells; narrower ones while a cell has several chunks.

    Candidates order by age distance, then index distance. So a case that finds its whole list within a tolerance, or with
    no age distance at all within fewer days, has its best ones.
    """
    days = rules.within.days
    tolerances = [rules.within, replace(rules.within, years=0), replace(rules.within, years=0, days=days // 16)]
    out: list[tuple[Matching, DataFrame]] = []
    for within in dict.fromkeys(tolerances):
        narrow = replace(rules, within=within)
        sizes = _cell_sizes(*_cells(cases, controls, narrow), chunk)
        out.append((narrow, sizes))
        if sizes.filter("_control_parts > 1").isEmpty():
            break
    return out


def top_candidates(cases: DataFrame, controls: DataFrame, rules: Matching, k: int, chunk: int = CHUNK_LIMIT, nearby: bool = True) -> DataFrame:
    """The best ``k`` admissible controls of each case as rows (pos from 1), never all pairs.

    ``controls`` may carry ``held_by``: a control held by an earlier case is not admissible. Without ``nearby``, which is for
    lists too long to be full within a narrower tolerance, lists are sought in one step.
    """
    if "held_by" not in controls.columns:
        controls = controls.withColumn("held_by", F.lit(None).cast("string"))
    if not nearby:
        return _top_within(cases, controls, rules, _cell_sizes(*_cells(cases, controls, rules), chunk), k, chunk)
    *wider, (narrow, sizes) = _reaches(cases, controls, rules, chunk)
    out, left = None, cases
    while True:
        found = _top_within(left, controls, narrow, sizes, k, chunk)
        if not wider:
            return found if out is None else out.unionByName(found)
        found = cut_lineage(found)
        full = found.filter(F.col("pos") == k).select("case_id")
        whole = found.join(full, "case_id", "left_semi")
        out = whole if out is None else out.unionByName(whole)
        left = cut_lineage(left.join(full, "case_id", "left_anti"))
        if left.isEmpty():
            return out
        narrow, _ = wider.pop()
        sizes = _cell_sizes(*_cells(left, controls, narrow), chunk)


def _best_pairs(cases: dict[str, np.ndarray], controls: dict[str, np.ndarray], k: int, window: int, tolerance: float) -> tuple[np.ndarray, ...]:
    """The best ``k`` admissible controls of each case: places in ``cases`` and ``controls``, age distance, index distance, age.

    ``controls`` are sorted by id; their ``until`` counts the cases, by place in time, that come before the holder or are it.
    """
    column = lambda name: cases[name][:, None]
    ok = column("place") < controls["until"]
    if np.isnan(cases["index_day"][0]):  # the cases of a cell have dates, or none has
        age, distance = controls["age"][None, :], np.full(ok.shape, float(window))
    else:
        day = column("index_day")
        with np.errstate(invalid="ignore"):
            distance = np.floor(np.abs(controls["anchor"] - day))
            ok &= (distance <= window) & ~(controls["start_day"] > day) & ~(controls["end_day"] < day)
        age = column("index_year") - controls["yob"]
        if np.isnan(controls["yob"]).any():
            otherwise = np.where(~np.isnan(controls["birth_day"]), (day - controls["birth_day"]) / 365.25, controls["age"])
            age = np.where(~np.isnan(controls["yob"]), age, otherwise)
    gap = np.abs(age - column("age"))
    with np.errstate(invalid="ignore"):
        ok &= gap <= tolerance
    if ok.shape[1] > k:
        # what may be among the best: a smaller age distance than the k-th, or the same and an index distance up to the k-th
        gap = np.where(ok, gap, np.inf)
        cut = np.partition(gap, k - 1, axis=1)[:, k - 1 : k]
        tied = np.where(gap < cut, -1.0, np.where((gap == cut) & ok, distance, np.inf))
        ok &= tied <= np.partition(tied, k - 1, axis=1)[:, k - 1 : k]
    case, control = np.nonzero(ok)
    gap, distance, age = gap[case, control], distance[case, control], np.broadcast_to(age, ok.shape)[case, control]
    order = np.lexsort((control, distance, gap, case))
    starts = np.searchsorted(case, np.arange(len(ok)))
    order = order[np.arange(len(case)) - starts[case] < k]
    return case[order], control[order], gap[order], distance[order], age[order]


_CHUNK = ["cell", "_a", "_b"]
_CANDIDATE = "case_id string, control_id string, gap double, distance double, age_at_case_index double"
PAIRS = 1 << 18  # pairs of a case and a control that a task holds at once, at least one case's


def _pick(k: int, window: int, tolerance: float):
    """From the rows of chunks, sorted, a chunk's controls first, the best ``k`` controls that a chunk has for each of its cases."""
    schema = pa.schema([("case_id", pa.string()), ("control_id", pa.string()), *[(c, pa.float64()) for c in ("gap", "distance", "age_at_case_index")]])

    def run(batches):
        at, held = None, []  # the chunk's controls so far
        for batch in batches:
            table = pa.Table.from_batches([batch])
            keys = [table[c].to_numpy() for c in (*_CHUNK, "side")]
            ends = np.flatnonzero(np.any([x[1:] != x[:-1] for x in keys], axis=0)) + 1
            out = []
            for lo, hi in zip([0, *ends], [*ends, len(keys[0])] if len(keys[0]) else []):
                key, rows = tuple(x[lo] for x in keys[:3]), table.slice(lo, hi - lo)
                if key != at:
                    at, held = key, []
                if keys[3][lo] == 0:
                    held.append(rows)
                    continue
                if not held:
                    continue
                controls = pa.concat_tables(held).combine_chunks()
                held = [controls]
                ids = controls["id"]
                numbers = {name: controls[name].to_numpy() for name in _NUMERIC}
                cases = {name: rows[name].to_numpy() for name in ("index_day", "index_year", "age")}
                orders = np.array(rows["case_order"].to_pylist(), dtype=str)
                some = np.sort(orders)
                cases["place"] = np.searchsorted(some, orders)
                holders = controls["held_by"]
                numbers["until"] = np.full(len(ids), len(some))
                if holders.null_count < len(ids):
                    is_held = holders.is_valid().to_numpy()
                    numbers["until"][is_held] = np.searchsorted(some, np.array(holders.drop_null().to_pylist(), dtype=str), "right")
                step = max(1, PAIRS // len(ids))
                for first in range(0, len(rows), step):
                    case, control, *found = _best_pairs({c: v[first : first + step] for c, v in cases.items()}, numbers, k, window, tolerance)
                    if len(case):
                        out.append(pa.table([rows["id"].take(pa.array(first + case)), ids.take(pa.array(control)), *map(pa.array, found)], schema=schema))
            if out:
                yield from pa.concat_tables(out).combine_chunks().to_batches()

    return run


def _top_within(cases: DataFrame, controls: DataFrame, rules: Matching, sizes: DataFrame, k: int, chunk: int) -> DataFrame:
    case_cells, control_cells = _cells(cases, controls, rules)
    salt = lambda column, n: F.pmod(F.xxhash64(column), F.col(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    # both kinds of rows go through one sorted exchange, chunk after chunk, so that a small chunk costs little
    left = case_cells.join(sizes, _CELL).select(
        "cell", salt("case_id", "_case_parts").alias("_a"), spread("_control_parts").alias("_b"), F.lit(1).alias("side"),
        F.col("case_id").alias("id"), "case_order", "index_day", "index_year", "age",
    )
    right = control_cells.join(sizes, _CELL).select(
        "cell", spread("_case_parts").alias("_a"), salt("control_id", "_control_parts").alias("_b"), F.lit(0).alias("side"),
        F.col("control_id").alias("id"), "held_by", *_NUMERIC,
    )
    rows = left.unionByName(right, allowMissingColumns=True).repartition(*_CHUNK).sortWithinPartitions(*_CHUNK, "side", "id")
    found = rows.mapInArrow(_pick(k, rules.within.days, rules.within.years), _CANDIDATE)
    # one short list per chunk, so a case's group holds at most chunks × k rows
    w = Window.partitionBy("case_id").orderBy("gap", "distance", "control_id")
    return found.withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= k)


def _blocked(cases: DataFrame) -> DataFrame:
    """Cases with a ``block`` of their stratum's neighbouring index dates; a crowded date is dealt over several."""
    days = cases.groupBy("stratum", "index_day").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("stratum").orderBy("index_day"))  # a row for each date
    ends = days.select("stratum", F.col("index_day").alias("_day"), F.floor(before / BLOCK_CASES).alias("_at"), _parts("_n", BLOCK_CASES).alias("_deal"))
    joined = cases.join(ends.withColumnRenamed("stratum", "_stratum"), (F.col("stratum") == F.col("_stratum")) & F.col("index_day").eqNullSafe(F.col("_day")))
    deal = F.pmod(F.xxhash64("case_id"), F.col("_deal"))
    block = F.when(F.col("_deal") > 1, F.concat_ws("|", "stratum", F.lit("day"), F.col("_day").cast("string"), deal.cast("string"))).otherwise(F.concat_ws("|", "stratum", F.col("_at").cast("string")))
    return joined.withColumn("block", block).drop("_stratum", "_day", "_at", "_deal")


def _settled_in_block(k: int, edges: pd.DataFrame) -> pd.DataFrame:
    """Listed candidates without those that an earlier case of the block takes; what a case takes here, it or an earlier one holds in the end."""
    edges = edges.sort_values(["case_order", "gap", "distance", "control_id"], ignore_index=True)
    keep = np.ones(len(edges), dtype=bool)
    taken: dict[str, str] = {}
    case, got = None, 0
    for i, (order, control, active) in enumerate(zip(edges["case_order"], edges["control_id"], edges["active"])):
        if order != case:
            case, got = order, 0
        if taken.get(control, case) != case:
            keep[i] = False
        elif active and got < k:
            taken[control] = case
            got += 1
    return edges[keep].drop(columns="active")


def _relisted_in_block(k: int, length: int, window: int, tolerance: float, rows: pd.DataFrame, controls: pd.DataFrame) -> pd.DataFrame:
    """As ``_settled_in_block``, and a case with a row without a control, which may have more than its list, gets a fresh list
    of what earlier cases leave when its own falls short. One without a control in the result has no more than its list."""
    asks = rows[rows["control_id"].isna()].sort_values("case_order").drop_duplicates("case_order")
    edges = rows[rows["control_id"].notna()].sort_values(["case_order", "gap", "distance", "control_id"], ignore_index=True)
    orders = edges["case_order"].to_numpy(str)
    names, starts = np.unique(orders, return_index=True)
    lists = dict(zip(names.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(orders)])))
    orders = asks["case_order"].to_numpy(str)
    places = dict(zip(orders.tolist(), range(len(orders))))
    names = np.unique(controls["control_id"].to_numpy(str))
    numbers = dict(zip(names.tolist(), range(len(names))))
    c = _arrays(controls)
    holders = controls.sort_values("anchor")["held_by"]
    c["until"] = np.where(holders.isna(), len(orders), np.searchsorted(orders, holders.fillna("").to_numpy(str), "right"))
    c["id"] = np.searchsorted(names, c["id"])  # numbers in the order of the ids
    listed, active = edges["control_id"].tolist(), edges["active"].tolist()
    taken, gone = set(), np.zeros(len(names) + 1, dtype=bool)
    keep, fresh, asked = np.ones(len(edges), dtype=bool), [], 0
    people = list(asks.itertuples(index=False))
    for order in sorted({*lists, *places}):
        lo, hi = lists.get(order, (0, 0))
        own = [i for i in range(lo, hi) if listed[i] not in taken]
        n = places.get(order)
        if len(own) < k and n is not None:
            keep[lo:hi] = False
            if asked % 256 == 0:  # nobody who follows can have these
                left = ~gone[c["id"]] & (c["until"] > n)
                c = {name: values[left] for name, values in c.items()}
            asked += 1
            found = _candidates(people[n], c, lambda part: ~gone[c["id"][part]] & (c["until"][part] > n), window, tolerance)
            best = _best(c, found, length)
            ids = c["id"][found[0][best]]
            fresh.append((np.full(len(ids), n), ids, *(column[best] for column in found[1:])))
            if len(ids) < length:
                fresh.append((np.array([n]), np.array([len(names)]), *[np.array([np.nan])] * 3))
            takes = names[ids[:k]].tolist() if people[n].active else []
        else:
            keep[lo:hi] = False
            keep[own] = True
            takes = [listed[i] for i in own[:k] if active[i]]
        taken.update(takes)
        gone[[numbers.get(x, -1) for x in takes]] = True
    of, ids, gap, distance, age = (np.concatenate(x) for x in zip(*fresh)) if fresh else (np.empty(0, int), np.empty(0, int), *[np.empty(0)] * 3)
    new = asks.iloc[of].assign(control_id=np.array([*names.tolist(), None], dtype=object)[ids], gap=gap, distance=distance, age_at_case_index=age)
    return pd.concat([edges[keep], new])[["case_id", "case_order", "stratum", "block", "control_id", "gap", "distance", "age_at_case_index"]]


def _rounds(cases: DataFrame, controls: DataFrame, rules: Matching, chunk: int) -> DataFrame:
    """Deferred acceptance over listed candidates; lists are refilled until nobody can move."""
    k = rules.controls.wanted
    list_len = k * LIST_SLACK
    cases = cut_lineage(_blocked(cases))
    controls = cut_lineage(controls)
    released = None  # cases assumed to fall short
    edge_cols = ["case_id", "case_order", "stratum", "block", "control_id", "gap", "distance", "age_at_case_index"]

    def listed(for_cases: DataFrame, held: DataFrame | None, length: int) -> DataFrame:
        pool = controls if held is None else controls.join(held, "control_id", "left")
        rows = top_candidates(for_cases, pool, rules, length, chunk, nearby=held is None)
        return rows.join(for_cases.select("case_id", "case_order", "stratum", "block"), "case_id").select(*edge_cols)

    preference = Window.partitionBy("case_id").orderBy("gap", "distance", "control_id")

    def holders(rows: DataFrame) -> DataFrame:
        """Each control with the earliest case that holds it; released cases hold nobody."""
        active = rows.withColumn("_pos", F.row_number().over(preference)).filter(F.col("_pos") <= k)
        active = active if released is None else active.join(released, "case_id", "left_anti")
        return active.groupBy("control_id").agg(F.min("case_order").alias("held_by"))

    def in_blocks(rows: DataFrame) -> DataFrame:
        active = F.lit(True)
        if released is not None:
            rows, active = rows.join(released.withColumn("_out", F.lit(True)), "case_id", "left"), F.col("_out").isNull()
        rows = rows.select(*edge_cols, active.alias("active"))
        return rows.groupBy("block").applyInPandas(partial(_settled_in_block, k), rows.drop("active").schema)

    def replaced(of_cases: DataFrame, rest: DataFrame, held: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
        """Edges and list ends with fresh lists for some cases."""
        fresh = cut_lineage(listed(of_cases, held, length))
        refilled = fresh.groupBy("case_id").agg((F.count(F.lit(1)) >= length).alias("more"))
        ends = of_cases.select("case_id").join(refilled, "case_id", "left").na.fill(False, ["more"])
        return cut_union(rest, fresh), cut_union(full.join(of_cases, "case_id", "left_anti"), ends)

    window = rules.within.days
    band = lambda day: F.floor(day / max(window, 1))
    per_band = cut_lineage(controls.groupBy(F.col("stratum").alias("_stratum"), band(F.col("anchor")).alias("_band")).agg(F.count(F.lit(1)).alias("_n")))

    def roomy(asks: DataFrame) -> DataFrame:
        """Blocks whose cases have no more controls in reach than one task can hold, with the days of that reach."""
        undated = F.count_if(F.col("index_day").isNull()) > 0
        spans = asks.groupBy("block", F.col("stratum").alias("_stratum")).agg(
            F.when(~undated, F.min("index_day") - window - 1).alias("_low"), F.when(~undated, F.max("index_day") + window + 1).alias("_high"),
            F.min("case_order").alias("_first"),
        )
        near = F.col("_low").isNull() | F.col("_band").between(band(F.col("_low")), band(F.col("_high")))
        crowded = spans.join(per_band, "_stratum").filter(near).groupBy("block").agg(F.sum("_n").alias("_n")).filter(F.col("_n") > BLOCK_CONTROLS)
        return cut_lineage(spans.join(crowded, "block", "left_anti"))

    def relisted(asks: DataFrame, blocks: DataFrame, edges: DataFrame, held: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Edges and list ends with fresh lists in some blocks for the cases that fall short, made where the block settles."""
        rows = edges.unionByName(asks, allowMissingColumns=True).join(blocks, "block", "left_semi")
        if released is None:
            rows = rows.withColumn("active", F.lit(True))
        else:
            rows = rows.join(released.withColumn("_out", F.lit(True)), "case_id", "left").withColumn("active", F.col("_out").isNull()).drop("_out")
        # a row for each block of up to BLOCK_CASES cases is broadcast
        pool = controls.join(held, "control_id", "left").join(
            F.broadcast(blocks),
            (F.col("stratum") == F.col("_stratum"))
            & (F.col("_low").isNull() | F.col("anchor").between(F.col("_low"), F.col("_high")))
            & (F.col("held_by").isNull() | (F.col("held_by") >= F.col("_first"))),
        ).select("block", "control_id", "held_by", *_NUMERIC)
        settled = partial(_relisted_in_block, k, list_len, window, rules.within.years)

        def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            return settled(left, right) if len(left) else pd.DataFrame(columns=edge_cols)

        found = cut_lineage(rows.groupBy("block").cogroup(pool.groupBy("block")).applyInPandas(run, edges.schema))
        ended = found.filter(F.col("control_id").isNull()).select("case_id", F.lit(True).alias("_ended"))
        ends = full.join(ended, "case_id", "left").select("case_id", (F.col("more") & F.col("_ended").isNull()).alias("more"))
        rest = edges.join(blocks, "block", "left_anti")
        return cut_union(rest, found.filter(F.col("control_id").isNotNull())), cut_lineage(ends)

    edges, length = cut_lineage(listed(cases, None, list_len)), list_len
    full = cut_lineage(edges.groupBy("case_id").agg((F.count(F.lit(1)) >= list_len).alias("more")))
    settled = False
    while True:
        # settle: drop every edge whose control is held by an earlier active proposer
        while True:
            edges = edges if settled else cut_lineage(in_blocks(edges))
            settled, before = False, edges.count()
            kept = edges.join(holders(edges), "control_id", "left").filter(
                F.col("held_by").isNull() | (F.col("case_order") <= F.col("held_by"))
            )
            edges = cut_lineage(kept.select(*edge_cols))
            if edges.count() == before:
                break
        counts = edges.groupBy("case_id").agg(F.count(F.lit(1)).alias("n"))
        short = (
            cases.join(full.filter("more"), "case_id", "left_semi")
            .join(counts, "case_id", "left")
            .filter(F.coalesce("n", F.lit(0)) < k)
            .drop("n")
        )
        short = cut_lineage(short)
        if not short.isEmpty():
            # in a block with a short case, others that may have more than their lists can fall short
            asks = cases.join(full.filter("more"), "case_id", "left_semi").join(short, "block", "left_semi")
            asks = cut_lineage(asks.select("case_id", "case_order", "stratum", "block", "index_day", "index_year", "age"))
            held, blocks = cut_lineage(holders(edges)), roomy(asks)
            outside = cut_lineage(short.join(blocks, "block", "left_anti"))
            settled = outside.isEmpty()
            if not settled:
                # ever fewer cases ask, each for more, so that the number of refills grows little with the density of controls
                length *= 2
                edges, full = replaced(outside, edges.join(outside, "case_id", "left_anti"), held, length)
            if settled or not blocks.isEmpty():
                edges, full = relisted(asks, blocks, edges, held)
            continue
        if not (rules.controls.whole and rules.controls.least > 1):
            break
        # judge all cases again; what lies behind the earliest changed judgement of a stratum lists anew
        judged = cases.select("case_id", "case_order", "stratum").join(counts, "case_id")
        if released is None:
            judged = judged.withColumn("was", F.lit(False))
        else:
            judged = judged.join(released.withColumn("was", F.lit(True)), "case_id", "left").na.fill(False, ["was"])
        judged = cut_lineage(judged.withColumn("fails", F.col("n") < rules.controls.least))
        cut = cut_lineage(judged.filter("fails != was").groupBy("stratum").agg(F.min("case_order").alias("cut")))
        if cut.isEmpty():
            break
        failing = judged.filter("fails").select("case_id")
        if released is not None:  # one that lists nobody has no judgement, and stays
            failing = failing.unionByName(released.join(judged, "case_id", "left_anti"))
        released = cut_lineage(failing)
        later = cut_lineage(cases.join(cut, "stratum").filter(F.col("case_order") > F.col("cut")).drop("cut"))
        settled = edges.join(later, "case_id", "left_anti")
        length = list_len
        edges, full = replaced(later, settled, holders(settled), length)
    final = edges if released is None else edges.join(released, "case_id", "left_anti")
    final = final.withColumn("match_rank", F.row_number().over(preference)).filter(F.col("match_rank") <= k)
    return final.select("case_id", "control_id", "match_rank", "age_at_case_index")


def assign_controls(
    cases: DataFrame, controls: DataFrame, rules: Matching, stratum_limit: int = STRATUM_LIMIT, chunk: int = CHUNK_LIMIT
) -> DataFrame:
    """(case_id, control_id, match_rank, age_at_case_index)."""
    if rules.controls.reuse:
        picked = top_candidates(cases, controls, rules, rules.controls.wanted, chunk)
        picked = picked.select("case_id", "control_id", F.col("pos").alias("match_rank"), "age_at_case_index")
        if rules.controls.whole and rules.controls.least > 1:
            enough = picked.groupBy("case_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= rules.controls.least)
            picked = picked.join(enough.select("case_id"), "case_id", "left_semi")
        return picked
    cases, controls = cut_lineage(cases), cut_lineage(controls)
    sizes = (
        cases.select("stratum").unionAll(controls.select("stratum")).groupBy("stratum").agg(F.count(F.lit(1)).alias("n"))
    )
    large = cut_lineage(sizes.filter(F.col("n") > stratum_limit).select("stratum"))
    small = (
        cases.join(large, "stratum", "left_anti")
        .groupBy("stratum")
        .cogroup(controls.join(large, "stratum", "left_anti").groupBy("stratum"))
        .applyInPandas(greedy_in_task(rules), ASSIGNMENT)
    )
    if large.isEmpty():
        return small
    rounds = _rounds(
        cases.join(large, "stratum", "left_semi"), controls.join(large, "stratum", "left_semi"), rules, chunk
    )
    return small.unionByName(rounds)


def match_case_controls(cohort: DataFrame, rules: Matching, **limits) -> DataFrame:
    """Matched rows keyed by (match_group_id, match_rank); controls inherit the case's index date and age."""
    cases, controls = match_inputs(cohort, rules)
    pairs = cut_lineage(assign_controls(cases, controls, rules, **limits))
    per_case = pairs.groupBy("case_id").agg(F.count(F.lit(1)).cast("int").alias("matched_control_count"))
    age = F.col("age_at_index") if "age_at_index" in cohort.columns else F.lit(None).cast("double")
    baseline = F.col("baseline_index_date") if "baseline_index_date" in cohort.columns else F.lit(None).cast("date")
    people = cohort.withColumns(
        {"person_id": F.col("person_id").cast("string"), "index_date": lenient_date("index_date"), "age_at_index": lenient_double(age)}
    )
    summary = lambda: {
        "match_group_id": F.concat(F.lit("match-"), F.col("matched_case_person_id")),
        "match_complete": F.col("matched_control_count") >= rules.controls.wanted,
    }
    case_rows = (
        people.join(per_case.withColumnRenamed("case_id", "person_id"), "person_id")
        .withColumns(
            {
                "analysis_case": F.lit(1),
                "matched_case_person_id": F.col("person_id"),
                "match_role": F.lit("case"),
                "match_rank": F.lit(0),
                "control_source_age_at_index": F.lit(None).cast("double"),
                "control_source_index_date": F.lit(None).cast("date"),
            }
        )
        .withColumns(summary())
    )
    case_dates = people.select(F.col("person_id").alias("case_id"), F.col("index_date").alias("_case_date"))
    control_rows = (
        people.join(
            pairs.join(per_case, "case_id").join(case_dates, "case_id").withColumnRenamed("control_id", "person_id"),
            "person_id",
        )
        .withColumns(
            {
                "analysis_case": F.lit(0),
                "matched_case_person_id": F.col("case_id"),
                "match_role": F.lit("control"),
                "control_source_age_at_index": F.col("age_at_index"),
                "control_source_index_date": lenient_date(baseline),
                "case_tier": F.lit("control"),
            }
        )
        .withColumns({"age_at_index": F.col("age_at_case_index"), "index_date": F.col("_case_date"), **summary()})
        .drop("case_id", "_case_date", "age_at_case_index")
    )
    return case_rows.unionByName(control_rows.select(*case_rows.columns))


def matching_qc(matched: DataFrame) -> DataFrame:
    from casewright.operators.describe import long_counts

    return long_counts(
        matched,
        {
            "matched_cases": F.count_if(F.col("analysis_case") == 1),
            "matched_controls": F.count_if(F.col("analysis_case") == 0),
            "match_groups": F.count_distinct("match_group_id"),
        },
    )

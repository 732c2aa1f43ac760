"""Matching: the in-task greedy, the rounds and a plain-Python greedy agree."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from casewright.operators import matching
from casewright.rules import Controls, Matching

SCHEMA = (
    "person_id string, case_tier string, broad_case int, eligible_control boolean, index_date date, "
    "obs_start_date date, obs_end_date date, baseline_index_date date, birth_date date, year_of_birth double, "
    "age_at_index double, is_female double"
)
DAY0 = dt.date(2020, 1, 1)


def people(seed, n=60, tight=False):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        case = i < n // 4
        index = DAY0 + dt.timedelta(days=rnd.randrange(0, 30 if tight else 900)) if case and rnd.random() > 0.05 else None
        start = DAY0 - dt.timedelta(days=rnd.randrange(0, 800))
        end = start + dt.timedelta(days=rnd.randrange(300, 2500))
        kind = rnd.random()
        yob = float(rnd.randrange(1960, 1966 if tight else 1985)) if kind < 0.7 else None
        birth = dt.date(rnd.randrange(1960, 1985), 5, rnd.randrange(1, 28)) if 0.6 < kind < 0.9 else None
        age = float(rnd.randrange(35, 60)) if rnd.random() > 0.1 else None
        if case and index and yob:
            age = float(index.year - yob)
        rows.append(
            (
                f"p{i}", "broad" if case else "control", int(case), not case, index, start, end,
                None if rnd.random() < 0.8 else DAY0, birth, yob, age, rnd.choice([0.0, 1.0, None]),
            )
        )
    return rows


def plain_greedy(rows, rules):
    """Brute force over all pairs, straight from the rule."""
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    people_ = [dict(zip(names, r)) for r in rows]
    cases = sorted((p for p in people_ if p["broad_case"]), key=lambda p: (p["index_date"] or dt.date.max, p["person_id"]))
    used, out = set(), set()
    for c in cases:
        options = []
        for k in people_:
            if not k["eligible_control"] or k["is_female"] != c["is_female"] or k["person_id"] in used:
                continue
            if c["index_date"] is None:
                distance, age = rules.within.days, k["age_at_index"]
            else:
                if k["obs_start_date"] > c["index_date"] or k["obs_end_date"] < c["index_date"]:
                    continue
                if k["baseline_index_date"]:
                    anchor = k["baseline_index_date"].toordinal()
                else:
                    anchor = (k["obs_start_date"].toordinal() + k["obs_end_date"].toordinal()) / 2
                distance = int(abs(anchor - c["index_date"].toordinal()))
                if distance > rules.within.days:
                    continue
                if k["year_of_birth"] is not None:
                    age = c["index_date"].year - k["year_of_birth"]
                elif k["birth_date"]:
                    age = (c["index_date"] - k["birth_date"]).days / 365.25
                else:
                    age = k["age_at_index"]
            if age is None or c["age_at_index"] is None or abs(age - c["age_at_index"]) > rules.within.years:
                continue
            options.append((abs(age - c["age_at_index"]), distance, k["person_id"]))
        options = sorted(options)[: rules.controls.wanted]
        if not options or (len(options) < rules.controls.least and rules.controls.whole):
            continue
        for rank, (_, _, pid) in enumerate(options, 1):
            out.add((c["person_id"], pid, rank))
            if not rules.controls.reuse:
                used.add(pid)
    return out


RULES = [
    Matching(same=("is_female",), controls=Controls(wanted=2)),
    Matching(same=("is_female",), controls=Controls(wanted=3, reuse=True)),
    Matching(same=("is_female",), controls=Controls(wanted=3, least=3, whole=True)),
]


@pytest.mark.parametrize("rules", RULES)
@pytest.mark.parametrize("seed,tight,limit", [(1, False, 10_000), (2, False, 0), (3, True, 0)])
def test_all_paths_equal_plain_greedy(spark, monkeypatch, rules, seed, tight, limit):
    monkeypatch.setattr(matching, "LIST_SLACK", 2)
    rows = people(seed, tight=tight)
    cohort = spark.createDataFrame(rows, SCHEMA)
    cases, controls = matching.match_inputs(cohort, rules)
    got = matching.assign_controls(cases, controls, rules, stratum_limit=limit, chunk=7)
    got = {(r.case_id, r.control_id, r.match_rank) for r in got.collect()}
    assert got == plain_greedy(rows, rules)


def test_cases_that_cannot_affect_each_other_are_released_together(spark, monkeypatch):
    rules = Matching(same=("is_female",), controls=Controls(wanted=2, least=2, whole=True))
    rows = []
    for i in range(45):  # every third case finds one control in its own time
        day = DAY0 + dt.timedelta(days=1500 * i)
        span = (day - dt.timedelta(days=100), day + dt.timedelta(days=100))
        rows.append((f"c{i:02}", "broad", 1, False, day, *span, None, None, None, 40.0, 1.0))
        rows += [(f"k{i:02}-{j}", "control", 0, True, None, *span, day, None, None, 40.0, 1.0) for j in range(1 if i % 3 == 0 else 3)]
    lists = []
    listed = matching.top_candidates
    monkeypatch.setattr(matching, "top_candidates", lambda *a, **b: lists.append(1) or listed(*a, **b))
    cases, controls = matching.match_inputs(spark.createDataFrame(rows, SCHEMA), rules)
    got = matching.assign_controls(cases, controls, rules, stratum_limit=0, chunk=50).collect()
    assert {(r.case_id, r.control_id, r.match_rank) for r in got} == plain_greedy(rows, rules)
    assert len({r.case_id for r in got}) == 30 and len(lists) <= 3


def test_released_controls_pass_down_a_chain(spark):
    """Each failing case sets free what the next one takes, so judgements turn more than once."""
    rules = Matching(same=("is_female",), controls=Controls(wanted=2, least=2, whole=True))
    rows = []
    for i in range(12):
        day = DAY0 + dt.timedelta(days=200 * i)
        rows.append((f"c{i:02}", "broad", 1, False, day, *[DAY0 + dt.timedelta(days=x) for x in (-9999, 9999)], None, None, None, 40.0, 1.0))
        if i % 4 != 3:
            anchor = day + dt.timedelta(days=100)
            rows.append((f"k{i:02}", "control", 0, True, None, *[DAY0 + dt.timedelta(days=x) for x in (-9999, 9999)], anchor, None, None, 40.0, 1.0))
    cases, controls = matching.match_inputs(spark.createDataFrame(rows, SCHEMA), rules)
    got = matching.assign_controls(cases, controls, rules, stratum_limit=0, chunk=50).collect()
    assert {(r.case_id, r.control_id, r.match_rank) for r in got} == plain_greedy(rows, rules)


def test_control_inherits_index_date_and_age(spark):
    rows = [
        ("c1", "broad", 1, False, dt.date(2020, 1, 1), dt.date(2018, 1, 1), dt.date(2022, 1, 1), None, None, 1980.0, 40.0, 1.0),
        ("k1", "control", 0, True, None, dt.date(2018, 1, 1), dt.date(2022, 1, 1), dt.date(2019, 12, 1), None, 1980.0, 46.0, 1.0),
    ]
    matched = matching.match_case_controls(spark.createDataFrame(rows, SCHEMA), Matching(same=("is_female",)))
    control = matched.filter("analysis_case = 0").collect()
    assert len(control) == 1
    row = control[0]
    assert (row.age_at_index, row.control_source_age_at_index, row.index_date) == (40.0, 46.0, dt.date(2020, 1, 1))
    assert (row.match_group_id, row.match_rank, row.match_complete) == ("match-c1", 1, False)
    case = matched.filter("analysis_case = 1").first()
    assert (case.match_rank, case.matched_control_count) == (0, 1)
    assert {r.metric: r.n for r in matching.matching_qc(matched).collect()} == {
        "matched_cases": 1, "matched_controls": 1, "match_groups": 1,
    }


def test_a_chain_of_rejections_settles_in_one_block():
    """Case i wants control i - 1, which an earlier case takes, then control i: one link a round before."""
    rows = [(f"c{i:03}", f"o{i:03}", "s", "b", f"k{j:03}", float(j - i), 0.0, 40.0, i != 50) for i in range(99) for j in (max(i - 1, 0), i)]
    edges = pd.DataFrame(rows, columns=["case_id", "case_order", "stratum", "block", "control_id", "gap", "distance", "age_at_case_index", "active"]).drop_duplicates()
    kept = matching._settled_in_block(1, edges.sample(frac=1, random_state=1))
    held = kept.sort_values(["case_order", "gap"]).drop_duplicates("case_id").set_index("case_id")["control_id"]
    # case 50 only looks on, so the next one takes its control 50 and nobody after it is rejected
    assert [held[f"c{i:03}"] for i in range(99)] == [f"k{i if i <= 50 else i - 1:03}" for i in range(99)]


def test_dense_controls_are_sought_nearby_first(spark):
    controls, rules = spark.range(900).selectExpr("'s' AS stratum", "concat('k', id) AS control_id", "-9000D AS start_day", "9000D AS end_day", "double(id) AS anchor", "double(1950 + id % 9) AS yob", "double(NULL) AS birth_day", "double(NULL) AS age"), Matching()
    cases = spark.range(12).selectExpr("'s' AS stratum", "concat('c', id) AS case_id", "concat('c', id) AS case_order", "double(70 * id) AS index_day", "1971D AS index_year", "double(18 + id % 5) AS age")
    assert len(matching._reaches(cases, controls, rules, 25)) == 3 and len(matching._reaches(cases, controls, rules, 900)) == 1
    one = sorted(map(tuple, matching.top_candidates(cases, controls, rules, 6, 25).collect()))
    assert one == sorted(map(tuple, matching.top_candidates(cases, controls, rules, 6, 900).collect())) and len(one) == 72


@pytest.mark.parametrize("rules,n,block_cases,block_controls", [(RULES[0], 60, 4, 10**6), (RULES[0], 60, 4, 25), (RULES[0], 60, 10**6, 0), (RULES[2], 32, 4, 10**6)])
def test_fresh_lists_in_and_outside_of_blocks_equal_plain_greedy(spark, monkeypatch, rules, n, block_cases, block_controls):
    for name, value in (("LIST_SLACK", 1), ("BLOCK_CASES", block_cases), ("BLOCK_CONTROLS", block_controls)):
        monkeypatch.setattr(matching, name, value)
    rows = people(4, n, tight=True)
    cases, controls = matching.match_inputs(spark.createDataFrame(rows, SCHEMA), rules)
    got = matching.assign_controls(cases, controls, rules, stratum_limit=0, chunk=7).collect()
    assert {(r.case_id, r.control_id, r.match_rank) for r in got} == plain_greedy(rows, rules)


def test_cases_alike_are_listed_once(spark, monkeypatch):
    """All want the same controls, so all but the first lists run out: they are made anew in the block, not by more and more lists."""
    rules = Matching(same=("is_female",), controls=Controls(wanted=1))
    span = (DAY0 - dt.timedelta(days=100), DAY0 + dt.timedelta(days=100))
    rows = [(f"c{i:03}", "broad", 1, False, DAY0, *span, None, None, None, 40.0, 1.0) for i in range(150)]
    rows += [(f"k{i:03}", "control", 0, True, None, *span, DAY0 + dt.timedelta(days=i % 7), None, 1980.0, 40.0, 1.0) for i in range(130)]
    lists = []
    listed = matching.top_candidates
    monkeypatch.setattr(matching, "top_candidates", lambda *a, **b: lists.append(1) or listed(*a, **b))
    cases, controls = matching.match_inputs(spark.createDataFrame(rows, SCHEMA), rules)
    got = matching.assign_controls(cases, controls, rules, stratum_limit=0, chunk=20).collect()
    assert {(r.case_id, r.control_id, r.match_rank) for r in got} == plain_greedy(rows, rules) and len(got) == 130
    assert len(lists) == 1

"""r² of pairs by block products against plain correlations."""

import numpy as np
import pandas as pd
import pytest

from casewright.operators import scores


def made(n_people=70, n_variants=60, seed=2):
    rng = np.random.default_rng(seed)
    variants = pd.DataFrame({
        "variant_id": [f"v{i}" for i in range(n_variants)], "chromosome": rng.choice(["1", "2"], n_variants),
        "position": rng.integers(1, 900, n_variants), "priority": rng.choice([0.1, 0.2, 0.3], n_variants), "can_lead": rng.random(n_variants) < 0.8,
    })
    x = rng.choice([0.0, 0.0, 1.0, 2.0, np.nan], (n_variants, n_people), p=[0.3, 0.3, 0.2, 0.1, 0.1])
    x[0], x[1] = 0.0, 2.0  # constant ones have no r²
    calls = [(f"v{i}", f"p{j}", None if np.isnan(x[i, j]) else float(x[i, j])) for i in range(n_variants) for j in range(n_people) if x[i, j] != 0 or j % 7 == 0]
    return variants, x, calls


def plain(variants, x, window):
    out = {}
    rows = variants.to_dict("records")
    for i, a in enumerate(rows):
        for j, b in enumerate(rows):
            if a["chromosome"] == b["chromosome"] and abs(a["position"] - b["position"]) <= window and (a["priority"], a["variant_id"]) < (b["priority"], b["variant_id"]) and a["can_lead"]:
                both = ~np.isnan(x[i]) & ~np.isnan(x[j])
                u, v = x[i][both], x[j][both]
                out[a["variant_id"], b["variant_id"]] = np.corrcoef(u, v)[0, 1] ** 2 if u.std() > 0 and v.std() > 0 else None
    return out


@pytest.mark.parametrize("window,unit_calls", [(100, 500_000), (100, 40), (0, 40), (2000, 300)])
def test_equals_plain_correlations(spark, monkeypatch, window, unit_calls):
    monkeypatch.setattr(scores, "UNIT_CALLS", unit_calls)
    variants, x, calls = made()
    got = scores.band_r2(spark.createDataFrame(variants), spark.createDataFrame(calls, "variant_id string, person_id string, n_alt double"), 70, window).collect()
    want = plain(variants, x, window)
    assert len(got) == len(want) and {(r["lead"], r["variant_id"]) for r in got} == set(want)
    for r in got:
        assert r["r2"] == (None if want[r["lead"], r["variant_id"]] is None else pytest.approx(want[r["lead"], r["variant_id"]], abs=1e-9))


def test_blocks_of_any_size_give_the_same_sums(monkeypatch):
    variants, _, calls = made()
    rank = {v: k for k, v in enumerate(variants.sort_values(["priority", "variant_id"])["variant_id"])}
    rows = pd.DataFrame(calls, columns=["variant_id", "person_id", "x"]).merge(variants[variants["chromosome"] == "1"], on="variant_id")
    rows = rows.assign(r=rows["variant_id"].map(rank), own=rows["position"] < 450)
    results = []
    for size, people in ((256, 8192), (7, 5), (1, 64)):
        monkeypatch.setattr(scores, "BLOCK_VARIANTS", size)
        monkeypatch.setattr(scores, "BLOCK_PERSONS", people)
        found = pd.concat(scores._blocks_of_pairs(rows, 300)).sort_values(["lead_r", "other_r"], ignore_index=True)
        results.append(found)
        assert not found.duplicated(["lead_r", "other_r"]).any()
    assert results[0].equals(results[1]) and results[0].equals(results[2])
    # a row for each pair, however many people share it
    assert len(results[0]) < len(rows) * 40


def test_no_row_stands_for_a_pair_and_a_person(spark):
    """The plan joins variants with variants, and calls with variants, but never calls with calls."""
    variants, _, calls = made()
    frame = scores.band_r2(spark.createDataFrame(variants), spark.createDataFrame(calls, "variant_id string, person_id string, n_alt double"), 70, 100)
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInPandas" in plan and not any("Join" in line and "person_id" in line for line in plan.splitlines())


def test_no_calls_and_no_variants(spark):
    variants, _, _ = made()
    none = spark.createDataFrame([], "variant_id string, person_id string, n_alt double")
    frame = spark.createDataFrame(variants)
    got = scores.band_r2(frame, none, 70, 100).collect()
    assert got and all(r["r2"] is None for r in got)
    assert scores.band_r2(frame.where("false"), none, 70, 100).count() == 0

import gzip
import math
import random

import pytest
from pyspark.sql import functions as F

from casewright.operators import association, genotypes, leads, metrics, samples, scores, skew
from casewright.sources import genetics, tables


def test_masks(spark):
    rows = [
        ("a", "Benign", "splice_region_variant", 0.1, 0.0001), ("b", "Benign", "splice_donor_variant", 0.1, 0.0001),
        ("c", "Benign", "splice_acceptor_variant", 0.1, 0.0001), ("d", "Pathogenic", "splice_region_variant", 0.1, 0.0001),
        ("e", "Pathogenic", "stop_gained", 0.9, 0.002),
    ]
    df = spark.createDataFrame(rows, "variant_id string, clinvar_significance string, consequence string, revel double, max_af double")
    got = {r.variant_id: r for r in genotypes.variant_masks(df, ["Pathogenic"], ["stop_gained", "splice_donor", "splice_acceptor"]).collect()}
    assert not got["a"].is_plof and not got["a"].mask_primary and got["b"].is_plof and got["c"].is_plof
    assert got["d"].mask_primary and not got["e"].mask_primary


def test_merged_intervals(spark):
    rows = [
        ("chr1", 53202000, "CPT2"), ("chr1", 53202450, "CPT2"), ("chr1", 114693436, "AMPD1"),
        ("chr19", 38451842, "RYR1"), ("chr19", 38499993, "RYR1"),
    ]
    got = genotypes.merged_intervals(spark.createDataFrame(rows, "contig string, position long, gene string"))
    assert sorted(r.interval for r in got.collect()) == [
        "chr19:38450842-38500993", "chr1:114692436-114694436", "chr1:53201000-53203450",
    ]


def test_intervals_merge_within_gap_only(spark):
    rows = [("1", 1, "a"), ("1", 53000, "b"), ("1", 200000, "c"), ("2", 500, "d")]
    got = genotypes.merged_intervals(spark.createDataFrame(rows, "contig string, position long, gene string"))
    spans = sorted((r.contig, r.start, r.end) for r in got.collect())
    # 1001 + 50000 reaches 52000 only if the next span starts by 51001
    assert spans == [("1", 1, 1001), ("1", 52000, 54000), ("1", 199000, 201000), ("2", 1, 1500)]


def test_transcript_collapse(spark):
    base = dict(contig="chr19", ref_allele="C", alt_allele="T", aa_change="", dbsnp_rsid="")
    rows = [
        {**base, "vid": "19-38451842-C-T", "position": "38451842", "gene_symbol": "RYR1", "consequence": c, "revel": r,
         "gnomad_max_af": a, "gvs_max_af": "", "gvs_all_af": b, "clinvar_classification": s}
        for c, r, a, b, s in [
            ("missense_variant", "0.91", "0.0001", "0.0004", "Pathogenic"),
            ("splice_region_variant", "", "", "", "Likely_pathogenic"),
        ]
    ]
    rows.append({**base, "vid": "", "contig": "chr2", "position": "27765084", "ref_allele": "G", "alt_allele": "A", "gene_symbol": "X",
                 "consequence": "stop_gained", "revel": "", "gnomad_max_af": "", "gvs_max_af": "", "gvs_all_af": "", "clinvar_classification": ""})
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in genotypes.ANNOTATION_COLUMNS))
    got = {r.variant_id: r for r in genotypes.collapse_transcripts(genotypes.annotation_candidates(df, ["RYR1", "X"])).collect()}
    assert set(got) == {"19-38451842-C-T", "2-27765084-G-A"}
    r = got["19-38451842-C-T"]
    assert (r.revel, r.max_af) == (0.91, 0.0004)
    assert r.clinvar_significance == "Likely_pathogenic;Pathogenic" and r.consequence == "missense_variant;splice_region_variant"
    with pytest.raises(ValueError):
        genotypes.annotation_candidates(df.drop("contig"), ["X"])


def test_call_collapse(spark):
    rows = [("1", "v", "L", 1.0, "wgs_vds"), ("1", "v", "L", 2.0, "legacy_exact"), ("2", "v", "L", 1.0, "wgs_vds")]
    got = {r.person_id: r for r in genotypes.collapse_calls(spark.createDataFrame(rows, "person_id string, variant_id string, label string, dosage double, callset string"), ["label"]).collect()}
    assert (got["1"].dosage, got["1"].callset) == (2.0, "legacy_exact,wgs_vds") and len(got) == 2


def test_filter_mask_and_alleles(spark):
    rows = spark.createDataFrame([(1, None), (1, ""), (1, "."), (1, "PASS"), (1, "LowQual")], "gt int, ft string")
    assert [r[0] for r in rows.select(genotypes.passed_call(F.col("gt"), F.col("ft"))).collect()] == [1, 1, 1, 1, None]
    calls = spark.createDataFrame([([0, 2],), ([1, 1],), (None,), ([0, None],)], "gt array<int>")
    assert [r[0] for r in calls.select(genotypes.n_alt_alleles(F.col("gt"))).collect()] == [1, 2, None, None]


def test_qc_funnel(spark):
    rows = [(True, True, True, True, True, True)] * 60
    rows += [(True, True, True, True, False, False)] * 10 + [(True, True, True, False, False, False)] * 5
    rows += [(True, True, False, False, False, False)] * 5 + [(True, False, False, False, False, False)] * 10
    rows += [(False, True, True, True, True, True)] * 10
    df = spark.createDataFrame(rows, "biallelic boolean, pass_maf boolean, pass_mac boolean, pass_call_rate boolean, pass_hwe boolean, qc_pass boolean")
    got = sorted(genotypes.qc_funnel(df).collect(), key=lambda r: r.step)
    assert [r.rows_after for r in got] == [100, 90, 80, 75, 70, 60]
    assert [r.rows_removed for r in got] == [0, 10, 10, 5, 5, 10]
    report = sorted(genotypes.qc_funnel(df, "report-only").collect(), key=lambda r: r.step)
    assert report[-1]["filter"] == "final_qc" and len(report) == 7
    assert all(r.rows_after is None for r in genotypes.qc_funnel(df, count=False).collect())


def test_association_import(spark, tmp_path):
    path = tmp_path / "x.glm.logistic"
    path.write_text(
        "#CHROM POS ID REF ALT A1 TEST OBS_CT A1_FREQ OR LOG(OR)_SE Z_STAT P L95 U95\n"
        "1 100 rs1 A G G ADD 50 0.2 1.5 0.2 2.0 0.0455 1.0 2.2\n1 100 rs1 A G G AGE 50 0.2 1.1 0.2 1.0 0.3 0.9 1.3\n"
    )
    rows = genetics.read_association_results(spark, str(path)).collect()
    assert len(rows) == 1 and rows[0].odds_ratio == 1.5 and rows[0].regression_p == 0.0455
    assert rows[0].beta == pytest.approx(0.4054651081) and rows[0].position == 100


def test_score_files_and_small_imports(spark, tmp_path):
    for label, name in (("p0_01", "a.plink_prs.p0_01.sscore"), ("p1", "a.plink_prs.p1.sscore")):
        (tmp_path / name).write_text("#FID IID SCORE1_SUM\n0 1 0.5\n0 2 0.7\n")
    got = genetics.read_score_files(spark, f"{tmp_path}/*.sscore").collect()
    assert len(got) == 4 and {r.threshold_label for r in got} == {"p0_01", "p1"}
    (tmp_path / "s.fam").write_text("0 1 0 0 1 -9\n0  2 0 0 2 -9\n")
    (tmp_path / "s.bim").write_text("chr1 rs1 0 100 A G\n2 rs2 0 200 A G\n")
    (tmp_path / "s.snplist").write_text("rs1\n\nrs2\n")
    (tmp_path / "c.clumps").write_text("#CHROM POS ID P\n1 100 rs1 0.01\n")
    assert {r.IID for r in genetics.fam_ids(spark, f"{tmp_path}/s.fam").collect()} == {"1", "2"}
    assert {r.metric: r.n for r in genetics.bim_counts(spark, f"{tmp_path}/s.bim", ["1"]).collect()} == {"total": 2, "selected": 1}
    assert genetics.count_variant_list(spark, f"{tmp_path}/s.snplist") == 2
    assert [r.variant_id for r in genetics.read_clumped_ids(spark, f"{tmp_path}/c.clumps").collect()] == ["rs1"]
    assert genetics.label_threshold("p0_01") == 0.01 and genetics.label_threshold("x") is None


def test_tables_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", None, 2.5), ("2", "x", None)], "id string, t string, v double")
    for name in ("a.parquet", "a.tsv", "a.csv", "b.tsv.gz"):
        back = tables.read_table(spark, tables.write_table(df, f"{tmp_path}/{name}"))
        assert {(r.id, r.t, None if r.v is None else float(r.v)) for r in back.collect()} == {("1", None, 2.5), ("2", "x", None)}
    with gzip.open(tmp_path / "z.tsv.bgz", "wt") as f:
        f.write("id\tt\n1\ta\n2\t\n")
    assert {(r.id, r.t) for r in tables.read_table(spark, f"{tmp_path}/z.tsv.bgz").collect()} == {("1", "a"), ("2", None)}
    for n in ("q2.csv", "q1.csv"):
        (tmp_path / n).write_text("k\n" + n + "\n")
    assert tables.read_table(spark, f"{tmp_path}/q*.csv").first().k == "q1.csv"
    with pytest.raises(ValueError):
        tables.read_table(spark, "/x/y.xlsx")
    built = []
    for _ in range(2):
        got = tables.cached_by_parameters(spark, str(tmp_path), {"a": 1}, lambda: built.append(1) or df)
    assert got.count() == 2 and len(built) == 1
    tables.write_manifest(spark, {"a": 1}, {}, {"n": 2}, f"{tmp_path}/manifest.json")
    tables.write_with_separate_header(df, f"{tmp_path}/shards")
    assert spark.read.text(f"{tmp_path}/shards/header").first().value == "id\tt\tv"
    g = spark.createDataFrame([("1", 5, "p"), ("2", 7, "q")], "chromosome string, position long, person_id string")
    assert tables.write_genotypes(g, f"{tmp_path}/g.parquet").count() == 2


def test_weight_cleaning(spark):
    rows = [("v1", "A", "0.1", "0.01"), ("v2", "", "0.1", "0.01"), ("v3", "A", "x", "0.01"), ("v4", "A", "0.1", "1.5"),
            ("v5", "A", "0.1", "0.2"), ("v5", "A", "0.2", "0.3"), ("nan", "A", "0.1", "0.01")]
    got = scores.valid_weights(spark.createDataFrame(rows, "variant_id string, effect_allele string, beta string, regression_p string"))
    assert [r.variant_id for r in got.collect()] == ["v1"]


def test_prs_metrics_perfect_auc(spark):
    table = spark.createDataFrame([(str(i), "p1", 1.0, s) for i, s in enumerate([0.1, 0.3, 0.2, 0.9])], "person_id string, threshold_label string, p_threshold double, prs_score double")
    outcome = spark.createDataFrame([("0", 0), ("1", 1), ("2", 0), ("3", 1)], "person_id string, analysis_case int")
    weights = spark.createDataFrame([("a", 0.01), ("b", 0.5)], "variant_id string, p double")
    row = scores.prs_metrics(table, outcome, weights, [1.0]).first()
    assert (row.roc_auc, row.n_participants, row.n_variants_scored) == (1.0, 4, 2)


def test_carriers_with_mixed_id_types(spark):
    people = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "person_id long, outcome int")
    exposure = spark.createDataFrame([("1", "v", 1.0), ("2", "v", 1.0)], "person_id string, variant_id string, dosage double")
    row = association.carrier_tests(exposure, people, ["variant_id"]).first()
    assert (row.case_carriers, row.control_carriers, row.n_cases, row.n_controls) == (1, 1, 1, 2)


def _sample(spark, n=160, seed=3):
    rnd = random.Random(seed)
    people = [(f"p{i:03d}", int(rnd.random() < 0.4), rnd.gauss(0, 1), float(rnd.random() < 0.5)) for i in range(n)]
    calls = [(f"p{i:03d}", f"v{v}", float(rnd.choice([1, 1, 2]))) for v in range(6) for i in range(n) if rnd.random() < 0.15 + 0.05 * v]
    calls += [(p[0], "separated", 1.0) for p in people if p[1] == 1][:5]
    return (
        spark.createDataFrame(people, "person_id string, outcome int, age double, sex double"),
        spark.createDataFrame(calls, "person_id string, variant_id string, dosage double"),
    )


def test_blocked_regression_equals_broadcast(spark, monkeypatch):
    monkeypatch.setattr(association, "BLOCK_PEOPLE", 50)
    people, calls = _sample(spark)
    pick = lambda df: {r.variant_id: r for r in df.collect()}
    one = pick(association.logistic_per_unit(calls, people, ["variant_id"], ["age", "sex", "absent"]))
    two = pick(association.logistic_per_unit(calls, people, ["variant_id"], ["age", "sex", "absent"], broadcast_limit=0))
    assert set(one) == set(two) and one["separated"].beta is None and two["separated"].beta is None
    for v in one:
        if one[v].beta is not None:
            assert two[v].beta == pytest.approx(one[v].beta, rel=1e-6) and two[v].se == pytest.approx(one[v].se, rel=1e-6)
            assert two[v].regression_p == pytest.approx(one[v].regression_p, rel=1e-5) and two[v].n_samples == 160


def test_regression_fails_to_null(spark):
    people = spark.createDataFrame([("1", 1), ("2", 1)], "person_id string, outcome int")
    calls = spark.createDataFrame([("1", "v", 1.0)], "person_id string, variant_id string, dosage double")
    row = association.logistic_per_unit(calls, people, ["variant_id"], []).first()
    assert row.beta is None and row.regression_p is None and row.n_samples == 2


def test_stable_covariates(spark):
    rows = spark.createDataFrame([("1", 1, 1.0, 0.0, 3.0), ("2", 0, 1.0, 1.0, 4.0), ("3", 0, 1.0, 0.0, 5.0)], "person_id string, outcome int, const double, flag double, age double")
    assert association.stable_covariates(rows, ["const", "flag", "age", "absent"]) == (["age"], ["const", "flag"])


@pytest.mark.parametrize("seed", [1, 2])
def test_lead_hits_equal_sequential_greedy(spark, seed):
    rnd = random.Random(seed)
    rows = [(f"v{i}", rnd.choice("12"), rnd.randrange(1, 3000), rnd.choice([None, round(rnd.random(), 2)])) for i in range(250)]
    got = leads.lead_hits(spark.createDataFrame(rows, "variant_id string, chromosome string, position long, regression_p double"), 60)
    kept = []
    for v, c, pos, p in sorted((r for r in rows if r[3] is not None), key=lambda r: (r[3], r[0])):
        if all(c != kc or abs(pos - kp) > 60 for _, kc, kp in kept):
            kept.append((v, c, pos))
    assert {r.variant_id for r in got.collect()} == {k[0] for k in kept}


def _r2(x, y, people):
    both = [(x.get(p, 0), y.get(p, 0)) for p in people if x.get(p, 0) is not None and y.get(p, 0) is not None]
    n = len(both)
    sx, sy = sum(a for a, _ in both), sum(b for _, b in both)
    sxx, syy, sxy = sum(a * a for a, _ in both), sum(b * b for _, b in both), sum(a * b for a, b in both)
    var = (n * sxx - sx * sx) * (n * syy - sy * sy)
    return None if var <= 0 else (n * sxy - sx * sy) ** 2 / var


def test_clump_and_prune_equal_sequential_greedy(spark):
    rnd = random.Random(5)
    people = [f"p{i}" for i in range(60)]
    base = [{p: rnd.choice([1, 2, None]) for p in people if rnd.random() < 0.4} for _ in range(6)]
    variants, calls = {}, {}
    for i in range(40):
        calls[f"v{i}"] = {p: g for p, g in base[i % 6].items() if rnd.random() < 0.9}
        variants[f"v{i}"] = (rnd.choice("12"), rnd.randrange(0, 30_000), round(rnd.random(), 3))
    call_df = spark.createDataFrame([(v, p, g) for v, c in calls.items() for p, g in c.items()], "variant_id string, person_id string, n_alt int")
    where = spark.createDataFrame([(v, c, pos) for v, (c, pos, _) in variants.items()], "variant_id string, chromosome string, position long")
    weights = spark.createDataFrame([(v, p) for v, (_, _, p) in variants.items()], "variant_id string, p double")
    got = scores.clump(weights, where, call_df, 60, p1=0.6, p2=0.9, r2=0.1, kb=5)
    got = {(r.lead, r.variant_id) for r in got.collect()}
    taken, expected = set(), set()
    order = sorted((p, v) for v, (_, _, p) in variants.items())
    for p, v in order:
        if p > 0.6 or v in taken:
            continue
        taken.add(v)
        expected.add((v, v))
        for q, w in order:
            same = variants[w][0] == variants[v][0] and abs(variants[w][1] - variants[v][1]) <= 5000
            if w not in taken and q <= 0.9 and same and (_r2(calls[v], calls[w], people) or 0) >= 0.1:
                taken.add(w)
                expected.add((v, w))
    assert got == expected

    stats = spark.createDataFrame([(v, p / 2) for v, (_, _, p) in variants.items()], "variant_id string, maf double")
    kept = {r.variant_id for r in scores.prune(stats, where, call_df, 60, window_variants=5, r2=0.2).collect()}
    rank = {}
    for c in "12":
        for i, v in enumerate(sorted((v for v in variants if variants[v][0] == c), key=lambda v: (variants[v][1], v)), 1):
            rank[v] = (c, i)
    gone, expected = set(), set()
    for v in sorted(variants, key=lambda v: (-variants[v][2] / 2, v)):
        if v in gone:
            continue
        expected.add(v)
        for w in variants:
            near = rank[w][0] == rank[v][0] and abs(rank[w][1] - rank[v][1]) <= 4
            if w != v and w not in expected and near and (_r2(calls[v], calls[w], people) or 0) > 0.2:
                gone.add(w)
    assert kept == expected


def test_scores_with_flip_and_missing(spark):
    calls = spark.createDataFrame([("a", "p1", 1), ("a", "p2", 2), ("b", "p1", None), ("b", "p2", 1)], "variant_id string, person_id string, n_alt int")
    weights = spark.createDataFrame([("a", 0.5, 0.01, False, 0.0), ("b", 1.0, 0.5, True, 0.2)], "variant_id string, beta double, p double, flip boolean, mean_dosage double")
    people = spark.createDataFrame([("p1",), ("p2",), ("p3",)], "person_id string")
    got = {(r.person_id, r.threshold_label): r.prs_score for r in scores.person_scores(calls, weights, people, [0.1, 1.0]).collect()}
    assert got["p1", "p0_1"] == 0.5 and got["p2", "p0_1"] == 1.0 and got["p3", "p0_1"] == 0.0
    assert got["p1", "p1"] == pytest.approx(0.5 + 2 - 0.2) and got["p2", "p1"] == pytest.approx(1.0 + 2 - 1) and got["p3", "p1"] == 2.0


def test_id_universe(spark):
    wgs = spark.createDataFrame([("1",), ("2",), ("3",)], "research_id string")
    listed = spark.createDataFrame([("2",), ("9",)], "person_id string")
    ids = lambda df: sorted(r.person_id for r in df.collect())
    assert ids(samples.id_universe(wgs, listed, "max_unrelated.tsv")) == ["2"]
    assert ids(samples.id_universe(wgs, listed, "relatedness_flagged_samples.tsv")) == ["1", "3"]
    with pytest.raises(ValueError):
        samples.id_universe(None, listed, "flagged.tsv")
    with pytest.raises(ValueError):
        samples.restrict_to_manifest(wgs, listed.limit(0))


def test_blocked_fit_equals_the_broadcast_one_near_separation(spark):
    """Rare carriers among rare cases, some separated: both paths settle on the same rows and values."""
    import random

    rnd = random.Random(12)
    people = [(f"p{i:03d}", int(i < 9), rnd.gauss(0, 1)) for i in range(240)]
    carriers = {"three_to_one": (0, 1, 2, 50), "cases_only": (3, 4), "controls_only": (60, 61, 62), "nobody": (), "even": (5, 70, 71, 72, 73, 74, 75)}
    exposures = [(u, f"p{i:03d}", 1.0) for u, who in carriers.items() for i in who]
    sample = spark.createDataFrame(people, "person_id string, outcome int, x double")
    rows = spark.createDataFrame(exposures, "unit string, person_id string, dosage double")
    panel = spark.createDataFrame([(u,) for u in carriers], "unit string")
    got = [
        {r.unit: r for r in association.logistic_per_unit(rows, sample, ["unit"], ["x"], panel=panel, broadcast_limit=limit).collect()}
        for limit in (10**9, 0)
    ]
    for unit in carriers:
        one, two = got[0][unit], got[1][unit]
        assert one.converged == two.converged == (unit in ("three_to_one", "even"))
        if one.converged:
            assert (one.beta, one.se) == pytest.approx((two.beta, two.se), abs=1e-6)
        else:
            assert one.beta is None and two.beta is None


def test_lead_hits_of_a_falling_chain(spark):
    """p falls with position over 250 windows: every chunk waits for the next one, and nothing is cut short."""
    n = 1000
    rows = [(f"v{i:04d}", "1", 100_000 * i, 0.5 - i * 1e-4) for i in range(n)]
    got = sorted(r.position for r in leads.lead_hits(spark.createDataFrame(rows, "variant_id string, chromosome string, position long, regression_p double"), 250_000).collect())
    assert got == list(range(100_000 * ((n - 1) % 3), 100_000 * n, 300_000))


def test_missing_calls_take_the_mean_of_the_people_with_a_call(spark):
    calls = spark.createDataFrame([("v", "a", 1), ("v", "b", 2), ("v", "c", None), ("w", "a", None), ("z", "x", 2)], "variant_id string, person_id string, n_alt int")
    people = spark.createDataFrame([(p,) for p in "abcde"], "person_id string")
    got = {(r.variant_id, r.person_id): r.dosage for r in genotypes.mean_imputed(calls, people).collect()}
    assert got == {("v", "a"): 1.0, ("v", "b"): 2.0, ("v", "c"): 0.75}
    assert {r.dosage for r in genotypes.mean_imputed(calls, people, decimals=1).collect()} == {1.0, 2.0, 0.8}


def test_heavy_keys_are_split_by_their_rows(spark, monkeypatch):
    monkeypatch.setattr(skew, "HEAVY_ROWS", 100)
    fact = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id")
    lookup = fact.select("k").distinct().withColumn("v", F.length("k")).filter("k <> '7'")
    for how in ("inner", "left"):
        got = skew.salted_lookup(fact, lookup, "k", "id", how)
        assert got.columns == ["k", "id", "v"] and got.count() == fact.join(lookup, "k", how).count()
        assert got.exceptAll(fact.join(lookup, "k", how)).isEmpty()


def test_block_gzip_is_read_in_ranges(spark, tmp_path):
    """Every split size gives each line once; lines cross blocks, and one block boundary falls on a line's end."""
    import zlib

    lines = [f"row {i} " + "x" * (i % 300) for i in range(2000)]
    text = "\n".join(lines).encode() + b"\n"

    def block(data: bytes) -> bytes:
        deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = deflate.compress(data) + deflate.flush()
        head = b"\x1f\x8b\x08\x04" + b"\0" * 4 + b"\0\xff" + b"\x06\0" + b"BC\x02\0" + (len(body) + 25).to_bytes(2, "little")
        return head + body + zlib.crc32(data).to_bytes(4, "little") + len(data).to_bytes(4, "little")

    cut = text.index(b"\n", 40_000) + 1
    parts = [text[:cut], *[text[i : i + 9_000] for i in range(cut, len(text), 9_000)]]
    path = tmp_path / "calls.tsv.bgz"
    path.write_bytes(b"".join(block(p) for p in parts) + block(b""))
    for split in (100, 3_000, 1 << 26):
        got = sorted(r.value for r in tables.read_bgzip_lines(spark, str(path), split).collect())
        assert got == sorted(lines)

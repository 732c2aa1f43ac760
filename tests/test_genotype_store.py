"""Stored genotypes: what a read by intervals opens, joins without an exchange, the cache's key, counts that ride on a write."""

import random

import pytest
from pyspark.sql import functions as F

from casewright.operators import genotypes
from casewright.sources import genotype_store, tables


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rng = random.Random(7)
    rows = [(rng.choice(["1", "2", "X", "07"]), rng.randrange(1, 5000), f"p{rng.randrange(40)}", rng.choice([1, 2])) for _ in range(4000)]
    df = spark.createDataFrame(rows, "chromosome string, position long, person_id string, dosage int")
    return rows, genotype_store.write_ranges(df, f"file://{tmp_path_factory.mktemp('store')}/g", bin_positions=500)


INTERVALS = [("1", 40, 60), ("1", 55, 700), ("X", 4990, 9000), ("07", 1200, 1210), ("9", 1, 10000), ("2", 30, 20)]


@pytest.mark.parametrize("few", [64, 0])
def test_intervals_read_exactly_their_rows_and_few_files(spark, stored, few):
    rows, path = stored
    asked = spark.createDataFrame(INTERVALS, "contig string, start long, end long")
    got = genotype_store.read_intervals(spark, path, asked, bin_positions=500, few=few)
    want = sorted(r for r in rows if any(c == r[0] and s <= r[1] <= e for c, s, e in INTERVALS))
    assert sorted(map(tuple, got.select("chromosome", "position", "person_id", "dosage").collect())) == want
    plan = got._jdf.queryExecution().explainString(got.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    scan = plan[plan.index("Scan parquet") :]
    filters = next(line for line in scan.splitlines() if line.startswith("PartitionFilters"))
    if few:
        assert "chromosome" in filters and "position_bin" in filters
        pushed = next(line for line in scan.splitlines() if line.startswith("PushedFilters"))
        assert "GreaterThanOrEqual(position" in pushed and "LessThanOrEqual(position" in pushed
    else:
        assert "dynamicpruning" in filters
    # the scan itself opened the files of the bins that intervals touch, and no others
    opened = _files_read(got)
    total = genotype_store.scanned_files(spark.read.parquet(path))
    touched = {(c, b) for c, s, e in INTERVALS if s <= e for b in range(s // 500, e // 500 + 1)} & {(r[0], r[1] // 500) for r in rows}
    assert opened <= 3 * len(touched) and opened < total / 2


def _files_read(df) -> int:
    """The scan's own count of files, after a run."""
    df.collect()
    df._jdf.queryExecution().executedPlan()
    plan = df._jdf.queryExecution().executedPlan()
    found, waiting = [], [plan]
    while waiting:
        node = waiting.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            waiting.append(node.executedPlan())
            continue
        if "QueryStage" in name:
            waiting.append(node.plan())
            continue
        if name.startswith("Scan parquet") and "position" in node.toString():
            found.append(node.metrics().apply("numFiles").value())
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return sum(found)


def test_no_interval_and_many_of_them(spark, stored):
    rows, path = stored
    none = spark.createDataFrame([], "contig string, start long, end long")
    assert genotype_store.read_intervals(spark, path, none, bin_positions=500).count() == 0
    assert genotype_store.read_intervals(spark, path, none, bin_positions=500, few=-1).count() == 0
    many = [("1", i, i) for i in range(0, 5000, 7)]
    got = genotype_store.read_intervals(spark, path, spark.createDataFrame(many, "contig string, start long, end long"), bin_positions=500)
    assert got.count() == sum(r[0] == "1" and r[1] % 7 == 0 for r in rows)


@pytest.mark.parametrize("few", [64, 0])
def test_long_ranges_make_few_folders(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(genotype_store, "BIN_LIMIT", 12)
    rows = [(str(1 + i % 2), 1000 * i, f"p{i}", 1) for i in range(400)]
    df = spark.createDataFrame(rows, "chromosome string, position long, person_id string, dosage int")
    path = genotype_store.write_ranges(df, f"file://{tmp_path}/g", bin_positions=1000)
    assert spark.read.parquet(path).select("position_bin").distinct().count() <= 12 + 2
    asked = [("1", 3500, 9000), ("2", 0, 1000), ("1", 8000, 8000), ("2", 396_500, 900_000), ("3", 1, 10**6)]
    got = genotype_store.read_intervals(spark, path, spark.createDataFrame(asked, "contig string, start long, end long"), bin_positions=1000, few=few)
    want = sorted(r for r in rows if any(c == r[0] and s <= r[1] <= e for c, s, e in asked))
    assert sorted(map(tuple, got.select("chromosome", "position", "person_id", "dosage").collect())) == want


def test_contigs_stay_text(spark, tmp_path):
    df = spark.createDataFrame([("07", 5, "p"), ("7", 6, "q")], "contig string, position long, person_id string")
    path = genotype_store.write_ranges(df, f"file://{tmp_path}/g", "contig")
    got = genotype_store.read_intervals(spark, path, spark.createDataFrame([("07", 1, 9)], "contig string, start long, end long"), "contig")
    assert [tuple(r) for r in got.select("contig", "position").collect()] == [("07", 5)]


def test_bucketed_tables_join_and_aggregate_without_an_exchange(spark, tmp_path):
    calls = spark.range(3000).select(F.concat(F.lit("v"), F.col("id") % 200).alias("variant_id"), F.col("id").alias("person_id"))
    sites = spark.range(200).select(F.concat(F.lit("v"), F.col("id")).alias("variant_id"), (F.col("id") % 9).alias("gene"))
    one = genotype_store.write_bucketed(calls, "variant_id", 8, f"file://{tmp_path}/calls")
    two = genotype_store.write_bucketed(sites, "variant_id", 8, f"file://{tmp_path}/sites")
    joined = one.join(two.hint("merge"), "variant_id").groupBy("variant_id", "gene").agg(F.count("*").alias("n"))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == 200 and joined.agg(F.sum("n")).first()[0] == 3000


def test_cache_misses_after_its_input_changed(spark, tmp_path):
    path, built = f"file://{tmp_path}/in", []
    spark.range(5).write.parquet(path)

    def run(parameters=("a",)):
        rows = spark.read.parquet(path)
        return tables.cached_by_parameters(spark, f"file://{tmp_path}", list(parameters), lambda: built.append(1) or rows.agg(F.count("*").alias("n")), [rows]).first()["n"]

    assert [run(), run(), len(built)] == [5, 5, 1]
    spark.range(2).write.mode("append").parquet(path)
    assert [run(), run(), len(built)] == [7, 7, 2]
    assert [run(("b",)), len(built)] == [7, 3]
    # a frame without files is told by its plan
    assert tables.fingerprint(spark.range(3)) == tables.fingerprint(spark.range(3)) != tables.fingerprint(spark.range(4))


def test_funnel_rides_on_the_write(spark):
    rows = [(True, True, True, True, True, True)] * 4 + [(True, True, True, None, False, False), (False, True, True, True, True, True), (None, False, False, False, False, False)]
    df = spark.createDataFrame(rows, "biallelic boolean, pass_maf boolean, pass_mac boolean, pass_call_rate boolean, pass_hwe boolean, qc_pass boolean")
    for mode in ("filter", "report-only"):
        stored, funnel = genotypes.stored_with_funnel(df, mode)
        assert stored.count() == 7
        assert sorted(map(tuple, funnel.collect())) == sorted(map(tuple, genotypes.qc_funnel(df, mode).collect()))
    _, skipped = genotypes.stored_with_funnel(df, count=False)
    assert [r["rows_after"] for r in skipped.collect()] == [None] * 6
    _, empty = genotypes.stored_with_funnel(df.where("false"))
    assert [r["rows_after"] for r in empty.collect()] == [0] * 6

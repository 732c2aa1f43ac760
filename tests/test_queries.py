"""Registered queries against their SQL oracles on the smallest tables; CASEWRIGHT_ALL=1 adds the slow ones."""

import os
import sys

import pytest

import __spark_entry__ as entry

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check_oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
# each takes over ten seconds, in Spark or in the oracle's Newton steps
SLOW = {
    "bootstrap_intervals", "clinical_model_cv", "clinical_model_metrics", "clinical_score_model_metrics", "heldout_model_comparison", "incident_model_metrics",
    "prior_variant_association", "matrix_gwas", "genomic_control_lambda", "gene_burden_regression", "ld_clumps", "ld_pruned_variants", "incident_table1",
}
EVERY = [n for n in entry.oracle_sql() if not n.startswith("op")]
CHOSEN = [n for n in EVERY if os.environ.get("CASEWRIGHT_ALL") or n not in SLOW]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")
@pytest.mark.parametrize("name", CHOSEN)
def test_matches_oracle(spark, name):
    problem, _ = compare(entry.queries()[name](spark, FOLDER), connect(FOLDER), entry.oracle_sql()[name])
    assert not problem


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())

"""Every registered query against its SQL, on the smallest sample."""

import pytest

import __spark_entry__ as registry
from __spark_entry__ import LLM_QUERIES, entry, oracle_sql, queries
from checks.compare import differences
from tests.conftest import SMALL


def test_every_query_has_sql():
    assert {name for name in queries() if name not in LLM_QUERIES} == oracle_sql().keys() - LLM_QUERIES.keys()


@pytest.mark.parametrize("name", [name for name in queries() if name not in LLM_QUERIES])
def test_query_matches_sql(spark, name):
    assert differences(queries()[name](spark, SMALL), SMALL, oracle_sql()[name]) == ""


def test_entry_is_the_flagship(spark):
    assert differences(entry(spark), SMALL, oracle_sql()["facility_health"]) == ""


def test_known_figures_of_the_smallest_sample(spark):
    found = {name: queries()[name](spark, SMALL) for name in ("facility_health", "index_stats", "index_bands", "merge_report")}
    health = found["facility_health"]
    assert health.count() == 117
    assert health.filter("cleanliness_index = 100").count() == 4
    assert health.filter("score_trend IS NULL").count() == 4
    assert tuple(found["index_stats"].first()) == (52.94, 73.2, 86.31, 100.0)
    assert tuple(found["index_bands"].first()) == (7, 68, 42, 56)
    assert tuple(found["merge_report"].first())[:3] == (150, 148, 2)
    assert queries()["repeat_offenders"](spark, SMALL).count() == 60
    assert queries()["fct_violation"](spark, SMALL).count() == 6000


@pytest.mark.parametrize("name", ["quality_faults", "core_audit_faults", "mart_audit_faults", "near_me_faults"])
def test_seeded_faults_are_there_to_be_found(spark, name):
    found = [r for r in queries()[name](spark, SMALL).collect() if r.check_name != "empty"]
    assert sum(r.failures > 0 for r in found) >= len(found) - 1


def test_a_query_runs_only_the_stages_it_reads(spark):
    """The audit of the health mart writes no tables; a mart's reader runs the stages up to it, each once; results are the same."""
    folder = f"{SMALL}/."  # a name of its own, so that no other test has written its marts
    place = (spark.sparkContext.applicationId, folder)
    before = registry.mart_audit_faults(spark, folder).collect()
    assert place not in registry._stores
    assert registry.index_bands(spark, folder).count() == 1
    assert registry._stores[place][1] == ["staging", "warehouse", "marts"]
    assert sorted(registry.mart_audit_faults(spark, folder).collect()) == sorted(before)
    registry.near_me_top25(spark, folder).count()
    assert registry._stores[place][1] == ["staging", "warehouse", "marts", "geo"]

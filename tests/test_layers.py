"""The written layers bronze -> silver -> gold, and C11."""

from seismerge.operators.cluster import dedupe
from seismerge.plans import pipeline as P, queries as Q

SF = "/root/testdata/sf0.001"


def test_layers_and_window_job(spark):
    facts, silver = Q._facts(spark, SF), Q._silver(spark, SF)
    n = facts.count()
    assert n > 0 and facts.select("event_uid").distinct().count() == n
    recent = P.dedupe_window(silver, "2024-01-31 00:00:00", days=7)
    assert 0 < recent.count() < n
    assert dedupe(silver, as_of="2024-02-01", scan="window").count() <= n

"""The driver contract: smoke entry, registry, oracle coverage."""

import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["province", "n_events", "avg_magnitude", "max_magnitude", "first_event",
                          "last_event"]
    assert len(rows) > 0


def test_every_query_of_the_feeds_has_an_oracle():
    assert set(E.BASE_REGISTRY) <= set(E.oracle_sql()) <= set(E.queries())
    assert len(E.BASE_REGISTRY) >= 45


def test_queries_build_on_small_data(spark):
    for name in ("harmonize", "fact_earthquakes", "upsert_raw_fill", "date_chunks"):
        assert E.queries()[name](spark, E.SMOKE_DIR).count() > 0

"""Every registered query against its DuckDB oracle (small tables)."""

import pytest

from oracle_runner import run

SF = "/root/testdata/sf0.001"


def test_every_query_matches_its_oracle(spark):
    import __spark_entry__ as entry

    from ledgerline.registry import QUERIES

    assert set(QUERIES) <= set(entry.oracle_sql())
    results = run(spark, SF, list(QUERIES), verbose=False)
    bad = {k: v for k, v in results.items() if v[0] is not True}
    assert not bad, bad


@pytest.mark.parametrize("name", ["stats_per_analyst"])
def test_entry_smoke(spark, name):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["seq", "group_name", "se_analyst", "unique_con", "count_of_ac", "avg_t_hms"]
    assert df.count() >= 0


def test_results_do_not_depend_on_session_time_zone(spark):
    """Wall-clock (TIMESTAMP_NTZ) inputs: a daylight-saving session zone changes nothing."""
    names = ["ready_to_next_outcome", "defnew_to_next_outcome", "format_hms", "wf_events_by_state", "business_seconds"]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        results = run(spark, SF, names, verbose=False)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert all(v[0] is True for v in results.values()), results


def test_outputs_are_engine_neutral(spark):
    """No DECIMAL or DATE reaches the cross-engine comparison on either side."""
    import __spark_entry__ as entry
    from oracle_runner import duck

    con = duck(SF)
    from ledgerline.registry import QUERIES

    for name, q in QUERIES.items():
        if name == "snapshot_roundtrip":
            continue
        kinds = {f.dataType.typeName() for f in q(spark, SF).schema}
        assert not kinds & {"decimal", "date"}, name
        types = {row[1] for row in con.execute(f"DESCRIBE {entry.oracle_sql()[name]}").fetchall()}
        assert not any(t.startswith("DECIMAL") or t == "DATE" for t in types), (name, types)

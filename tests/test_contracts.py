"""Source schemas are checked when a table is resolved, before any job."""

import pytest

from ledgerline.plans.snapshot import CONTRACT_PASS_THROUGH, FUNDING_PASS_THROUGH
from ledgerline.registry import Ctx
from ledgerline.sources.contracts import SOURCES, SourceSchemaError, checked, required
from ledgerline.sources.tables import TableSources

SF = "/root/testdata/sf0.001"


def _jobs(spark):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


def _sources(spark, tmp_path, schema, name="app", **more):
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / name))
    return TableSources(spark, {name: f"parquet:{tmp_path}/{name}"}, **more)


def test_the_fixture_fulfils_the_contracts_of_both_jobs(spark):
    src = Ctx(spark, SF).src
    for name in SOURCES:
        for job in ("turnaround", "snapshot"):
            assert checked(src[name], name, required(job, name)) is src[name]
    assert set(CONTRACT_PASS_THROUGH) <= set(src["ca"].columns) and set(FUNDING_PASS_THROUGH) <= set(src["funding_data"].columns)
    assert required("turnaround", "ca") == {"id", "ca_st_key", "sub_date_key", "sending_date_key", "d_key"}
    assert required("turnaround", "dealer") == {"d_key"}


@pytest.mark.parametrize(
    ("schema", "said"),
    [
        ("application_id string, ca_id bigint", "application_id: string, expected whole"),
        ("application_id bigint", "ca_id: missing"),
        ("application_id decimal(20,2), `CA ID` bigint", r"application_id: decimal\(20,2\), expected whole"),
        ("application_id bigint, `ca id` bigint, ca_id bigint", r"ca_id: 2 columns of that name \('ca id', 'ca_id'\)"),
    ],
)
def test_wrong_missing_and_double_columns_are_named(spark, tmp_path, schema, said):
    src = _sources(spark, tmp_path, schema, job="turnaround")
    before = _jobs(spark)
    with pytest.raises(SourceSchemaError, match=f"source app: .*{said}"):
        src["app"]
    assert _jobs(spark) <= before + 1  # Spark reads the files' footers, nothing of ours runs


def test_kinds_are_families_of_types(spark, tmp_path):
    src = _sources(spark, tmp_path, "`Application ID` int, ca_id decimal(18,0), more string", job="snapshot")
    assert src["app"].columns == ["application_id", "ca_id", "more"]
    log = "application_id smallint, wf_state_id tinyint, wf_state_type_name string, wf_state_name string, u_by string, u_date_time timestamp"
    assert _sources(spark, tmp_path, log, "wf_history", job="turnaround")["wf_history"].columns[0] == "application_id"


def test_further_columns_may_be_asked_for(spark, tmp_path):
    src = _sources(spark, tmp_path, "id bigint, ca_st_key int", "ca", also={"ca": ["term"]})
    with pytest.raises(SourceSchemaError, match="term: missing"):
        src["ca"]

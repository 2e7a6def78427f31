"""Summaries merged from cells, and operators run with other codes than the source system's."""

import datetime as dt
import random

from ledgerline.operators.summary import GRAIN_COLUMNS, segment_summaries, segment_summary, summary_cells
from ledgerline.params import RunParams
from ledgerline.plans import facts
from ledgerline.plans import workflow as wf

DETAILS = "track string, ca_id bigint, type_2 string, type_2_time timestamp_ntz, type_2_by string, type_1_to_type_2_duration bigint"


def _details(spark, n, seed):
    rng = random.Random(seed)
    ids = [None, -5, 0, 1, 32_767, 32_768, 32_769, 10**12, *range(50_000, 50_040)]
    rows = [
        (
            rng.choice(["ready", "def_new_doc", "x"]), rng.choice(ids), rng.choice(["Secu", "Fun", "DefPen", "AwaitingAp", "no", None]),
            rng.choice([None, dt.datetime(2024, rng.randint(1, 3), 5)]), rng.choice(["a", "b", None]), rng.choice([None, rng.randint(0, 10**6)]),
        )
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, DETAILS)


def _rows(df):
    return sorted(map(str, df.collect()))


def test_merged_grains_equal_distinct_counts(spark):
    for n, seed in ((0, 0), (40, 1), (3000, 2)):
        details = _details(spark, n, seed)
        for grain, df in segment_summaries(summary_cells(details)).items():
            want = segment_summary(details, grain)
            assert df.dtypes == want.dtypes and _rows(df) == _rows(want), (n, grain)


def test_three_grains_share_one_shuffle_of_the_details(spark, tmp_path):
    _details(spark, 200, 3).write.parquet(str(tmp_path / "d"))
    grains = segment_summaries(summary_cells(spark.read.parquet(str(tmp_path / "d"))))
    frames = [df.select("seq", "unique_con", "count_of_ac", "avg_t_hms") for df in grains.values()]
    out = frames[0].unionAll(frames[1]).unionAll(frames[2])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert p.count("FileScan") == 1 and p.count("ReusedExchange") == 2
    assert set(grains) == set(GRAIN_COLUMNS)


def test_other_state_types_classes_tracks_and_segments(spark):
    t = lambda h: dt.datetime(2024, 1, 2, h)
    history = spark.createDataFrame(
        [(1, "Other", 70, "Go", t(9), "x"), (1, "Other", 80, "Stop", t(11), "y"), (1, "Other", 1, "Go", t(12), "z"),
         (1, "AudSendingWFState", 70, "Go", t(10), "q"), (2, "Other", 80, "Stop", t(10), "w")],
        "application_id bigint, wf_state_type_name string, wf_state_id int, wf_state_name string, u_date_time timestamp_ntz, u_by string",
    )
    app = spark.createDataFrame([(1, 10), (2, 20)], "application_id bigint, ca_id bigint")
    sendings = spark.createDataFrame([(10,), (20,)], "ca_id bigint")
    params = RunParams(as_of=dt.date(2024, 2, 1), start=dt.date(2024, 1, 1), end=dt.date(2024, 2, 1))
    events = wf.wf_events(history, app, sendings, params, state_type="Other", classes={"go": (70,), "stop": (80, 81)})
    assert sorted((r["ca_id"], r["state_class"]) for r in events.collect()) == [(10, "go"), (10, "stop"), (20, "stop")]
    from ledgerline.registry import TEST_HOURS
    import dataclasses

    hours = dataclasses.replace(TEST_HOURS, first_day=dt.date(2024, 1, 1), last_day=dt.date(2024, 2, 1))
    pairs = wf.turnaround_pairs(spark, events, hours, tracks={"run": ("go", ("stop",))})
    segments = ((7, "Go to stop", "run", ("Stop",)),)
    for df in (segment_summary(pairs, "analyst", segments=segments), segment_summaries(summary_cells(pairs, segments=segments))["analyst"]):
        assert [tuple(r) for r in df.collect()] == [(7, "Go to stop", "y", 1, 1, "02:00:00")]
    ca = spark.createDataFrame([(10,), (20,)], "id bigint")
    sending = spark.createDataFrame([(10, "Primary"), (20, "Prim")], "application_no bigint, applicant_type string")
    state = lambda **k: sorted(tuple(r) for r in wf.current_wf_state(history, app, ca, sending, params, **k).collect())
    assert state() == [(10, "Go", t(10))]
    assert state(state_type="Other") == [(10, "Go", t(12))]
    assert state(state_type="Other", applicant_type="Prim") == [(20, "Stop", t(10))]


def test_income_rows_by_another_order(spark):
    app = spark.createDataFrame([(1, 10), (2, 10)], "application_id bigint, ca_id bigint")
    rows = spark.createDataFrame(
        [(1, 1, "M", 5, 9, 0), (2, 1, "W", 7, 3, 0), (2, 1, "A", None, 4, 0), (1, 1, "A", 1, 1, 1)],
        "applicationid bigint, relationtype int, ginomefre string, ginome int, antotal int, isdeleted int",
    )
    pick = lambda **k: [tuple(r)[2:4] for r in facts.annual_income_by_relation(app, rows, **k).collect()]
    assert pick() == [("A", None)]
    assert pick(lowest=False) == [("W", 7)]
    assert pick(order=("antotal",)) == [("W", 7)]
    assert pick(order=("antotal",), lowest=False) == [("M", 5)]

"""Forward pairing: hand-made edge cases and a randomized check against brute force."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.operators.pairing import pair_next_event

T0 = dt.datetime(2024, 3, 4, 10, 0, 0)
SCHEMA = "ca_id long, u_date_time timestamp_ntz, wf_state_name string, u_by string, role string"


def h(hours):
    return T0 + dt.timedelta(hours=hours)


def run(spark, rows, bucket_seconds=86_400):
    df = spark.createDataFrame(rows, SCHEMA)
    out = pair_next_event(df, bucket_seconds=bucket_seconds)
    out = out.orderBy("ca_id", "type_1_time").collect()
    return [(r.ca_id, r.type_1_time, r.type_1_by, r.type_2, r.type_2_time) for r in out]


def test_outcome_at_same_instant_is_paired(spark):
    got = run(spark, [(1, h(0), "Ready", "a", "start"), (1, h(0), "DefPen", "b", "outcome")])
    assert got == [(1, h(0), "a", "DefPen", h(0))]


def test_no_outcome_before_next_start(spark):
    rows = [(1, h(0), "Ready", "a", "start"), (1, h(1), "Ready", "a", "start"), (1, h(2), "Fun", "b", "outcome")]
    assert run(spark, rows) == [(1, h(0), "a", None, None), (1, h(1), "a", "Fun", h(2))]


def test_outcome_exactly_at_next_start_belongs_to_next(spark):
    rows = [(1, h(0), "Ready", "a", "start"), (1, h(1), "Ready", "a", "start"), (1, h(1), "Fun", "b", "outcome")]
    assert run(spark, rows) == [(1, h(0), "a", None, None), (1, h(1), "a", "Fun", h(1))]


def test_tied_starts_give_one_row_without_outcome(spark):
    rows = [(1, h(0), "Ready", "b", "start"), (1, h(0), "Ready", "a", "start"), (1, h(1), "Fun", "c", "outcome")]
    assert run(spark, rows) == [(1, h(0), "a", None, None)]


def test_start_without_outcome_kept(spark):
    assert run(spark, [(7, h(0), "Ready", None, "start")]) == [(7, h(0), None, None, None)]


def test_outcome_found_across_many_buckets(spark):
    rows = [(1, h(0), "Ready", "a", "start"), (1, h(24 * 40), "Fun", "b", "outcome")]
    assert run(spark, rows, bucket_seconds=3600) == [(1, h(0), "a", "Fun", h(24 * 40))]


def _nf(x):
    """Sort key placing None first."""
    return (x is not None, x or "")


def _rank(s, o):
    """Row order of the final ROW_NUMBER: outcome (NULL first), then the start's actor/name."""
    if o is None:
        return (0, dt.datetime.min, _nf(None), _nf(None), _nf(s[3]), s[2])
    return (1, o[0], _nf(o[1]), _nf(o[2]), _nf(s[3]), s[2])


def brute_force(rows):
    """The reference's shape: number the starts, take the next start by number, join
    outcomes in [start, next start), keep the first row per (key, start ts)."""
    best = {}
    for k in sorted({r[0] for r in rows}):
        starts = sorted([r for r in rows if r[0] == k and r[4] == "start"], key=lambda r: (r[1], _nf(r[3]), r[2]))
        outs = {(r[1], r[2], r[3]) for r in rows if r[0] == k and r[4] == "outcome"}
        for i, s in enumerate(starts):
            nxt = starts[i + 1][1] if i + 1 < len(starts) else None
            hits = [o for o in outs if o[0] >= s[1] and (nxt is None or o[0] < nxt)] or [None]
            for o in hits:
                key = (k, s[1])
                if key not in best or _rank(s, o) < _rank(*best[key]):
                    best[key] = (s, o)
    return sorted(
        [(k, t, s[3], o[1] if o else None, o[0] if o else None) for (k, t), (s, o) in best.items()],
        key=lambda r: (r[0], r[1]),
    )


event = st.tuples(
    st.integers(0, 2),
    st.integers(0, 40),
    st.sampled_from(["start", "outcome"]),
    st.sampled_from([None, "a", "b"]),
    st.sampled_from(["S1", "S2"]),
)


@settings(max_examples=25, deadline=None)
@given(st.lists(event, min_size=1, max_size=30), st.sampled_from([3600, 7 * 3600, 86_400]))
def test_matches_brute_force(spark, evs, bucket):
    rows = [(k, T0 + dt.timedelta(hours=3 * t), name if role == "start" else name + "o", by, role) for k, t, role, by, name in evs]
    if not any(r[4] == "start" for r in rows):
        return
    assert run(spark, rows, bucket_seconds=bucket) == brute_force(rows)

"""What the jobs expect of each source: its columns and their kinds, checked when a table is resolved.

Only the schema is looked at, so a wrong source raises before any job runs, and the error names the table and every
offending column at once. A kind is a family of Spark types: a key may be any whole number, an amount any number, a
time a timestamp with or without zone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql.types import ByteType, DataType, DateType, DecimalType, IntegerType, LongType, NumericType, ShortType, StringType, TimestampNTZType, TimestampType

from ledgerline.sources.ingest import plain_name


class SourceSchemaError(ValueError):
    pass


def _whole(t: DataType) -> bool:
    return isinstance(t, (ByteType, ShortType, IntegerType, LongType)) or (isinstance(t, DecimalType) and t.scale == 0)


KINDS = {
    "whole": _whole,
    "number": lambda t: isinstance(t, NumericType),
    "text": lambda t: isinstance(t, StringType),
    "date": lambda t: isinstance(t, DateType),
    "time": lambda t: isinstance(t, (TimestampNTZType, TimestampType)),
}


def _columns(**kinds: str) -> dict[str, str]:
    """Column -> kind, from the names of each kind."""
    return {name: kind for kind, names in kinds.items() for name in names.split()}


# fixed values: the columns that the plans read, by logical source
SOURCES: dict[str, dict[str, str]] = {
    "ca": _columns(whole="id ca_st_key last_decisioned_ca_st_key sub_date_key sending_date_key last_decisioned_date_key funing_date_key d_key mk_program_detail_id funing_port_key"),
    "date_dim": _columns(whole="date_key", date="full_date"),
    "dealer": _columns(whole="d_key ams_key is_test_d is_old_s", text="pro"),
    "app": _columns(whole="application_id ca_id"),
    "wf_history": _columns(whole="application_id wf_state_id", text="wf_state_type_name wf_state_name u_by", time="u_date_time"),
    "ca_status": _columns(whole="ca_st_key", text="ca_s_name"),
    "ca_sending_data_ino": _columns(whole="application_no", text="applicant_type"),
    "ams": _columns(whole="ams_key", text="ams_name"),
    "mk_program": _columns(whole="mk_program_detail_id", text="mk_program_name"),
    "funding_data": _columns(whole="application_no", text="applicant_type", number="tds_v"),
    "trans_return": _columns(whole="id is_current", text="go170"),
    "delinq_summary": _columns(whole="id d_60_day_payments d_over_60_day_payments"),
    "delinq_detail": _columns(whole="contract_number", date="i_due_date i_paid_off"),
    "s_c_log": _columns(whole="s_c_log_id id s_id", time="created_date_time"),
    "ino_decisions": _columns(whole="applicationid", text="decisiondescription analyst cdecision vin", time="subdate decisiondate"),
    "wf_history_t": _columns(whole="application_id wf_s_id", text="wf_state_name up_by", time="up_date_time"),
    "ino_c": _columns(whole="applicationid relationtype isdeleted returningcflag", text="ginomefre", number="ginome antotal"),
    "l_def": _columns(whole="id", date="def_from_date def_until_date"),
    "major_dgg": _columns(whole="id", text="ptype"),
    "bureau": _columns(whole="id prebankre"),
    "res_adj": _columns(whole="id", text="re_program", date="re_program_start_date"),
    "exposure": _columns(whole="most_recent_app"),
    "dis_report": _columns(whole="contract_id", text="current_status"),
}

#: columns of ``SOURCES`` that only one of the jobs reads
ONLY: dict[str, dict[str, str]] = {
    "turnaround": {"ca": "sending_date_key"},
    "snapshot": {
        "ca": "last_decisioned_ca_st_key last_decisioned_date_key funing_date_key mk_program_detail_id funing_port_key",
        "dealer": "ams_key is_test_d is_old_s pro",
    },
}


def required(job: str, name: str) -> set[str]:
    """The columns of the source ``name`` that ``job`` reads."""
    others = {c for j, sources in ONLY.items() if j != job for c in sources.get(name, "").split()}
    return set(SOURCES.get(name, {})) - others


def checked(df: DataFrame, name: str, needed: Iterable[str] = (), kinds: Mapping[str, str] | None = None) -> DataFrame:
    """``df`` if its columns, under their plain names, are single, of the declared kinds, and none of ``needed`` lacks."""
    kinds = SOURCES.get(name, {}) if kinds is None else kinds
    have = [(plain_name(f.name), f.name, f.dataType) for f in df.schema]
    faults = []
    for plain, n in Counter(p for p, _, _ in have).items():
        if n > 1:
            faults.append(f"{plain}: {n} columns of that name ({', '.join(repr(raw) for p, raw, _ in have if p == plain)})")
    for plain, raw, kind in have:
        if plain in kinds and not KINDS[kinds[plain]](kind):
            faults.append(f"{raw}: {kind.simpleString()}, expected {kinds[plain]}")
    faults += [f"{c}: missing" for c in sorted(set(needed) - {p for p, _, _ in have})]
    if faults:
        raise SourceSchemaError(f"source {name}: " + "; ".join(faults))
    return df

"""Target table layouts (column names in published order, with types where fixed).

Names are the snake_case forms of the reference's target columns; the
``HH:MM:SS`` columns are published as ``..._hms``.
"""

from __future__ import annotations

from pyspark.sql.types import DateType, DecimalType, IntegerType, LongType, StringType, TimestampNTZType

from ledgerline.plans.snapshot import SNAPSHOT_COLUMNS

DETAILS_TARGET = (
    ("ca_id", LongType()), ("c_s", StringType()), ("type_1", StringType()), ("type_1_time", TimestampNTZType()),
    ("type_1_by", StringType()), ("type_2", StringType()), ("type_2_time", TimestampNTZType()),
    ("type_2_by", StringType()), ("type_1_to_type_2_duration_in_seconds", LongType()),
    ("type_1_to_type_2_duration_hms", StringType()), ("fd_date", DateType()),
)

_MEASURES = (("unique_con", LongType()), ("count_of_ac", LongType()), ("avg_t_hms", StringType()))
_SEG = (("seq", IntegerType()), ("group_name", StringType()))

PER_ANALYST_TARGET = _SEG + (("se_analyst", StringType()),) + _MEASURES
PER_MONTH_TARGET = _SEG + (("sending_mt", IntegerType()),) + _MEASURES
PER_ANALYST_MONTH_TARGET = _SEG + (("se_analyst", StringType()), ("sending_mt", IntegerType())) + _MEASURES

# types of the 102 columns; every column not listed is a string
_SNAPSHOT_TYPES = {
    LongType(): "id cou_of_submits total_d_under_ams",
    DateType(): (
        "sub_date app_date fun_date l_start_date l_end_date_original first_i_due_date def_from_date def_until_date "
        "re_program_start_date l_end_date ve_delivery_date"
    ),
    IntegerType(): (
        "is_app is_fun prim_app_age have_a_co_app is_comm term fco_score r_app_score bk_score d_flag def_flag poi_waived_flag "
        "tr_year vehicle_year c_care_flag returningcflag total_an_km d_key major_dgg prev_bkr exposure_exce"
    ),
    DecimalType(18, 2): (
        "gkrp s_price boo_r l_rate d_payment net_t_in extended_war ins_before_tax ltv_r ltv_r_at_decision tds_r tds_v pti gross_in "
        "gross_in_combined amount_to_be_am_cap b_rate le_fee_rate lo_re_value cpp_re_value oem_sub_amount_before_tax oem_sub_amount "
        "fun_sub_amount msrp mo_ins_before_tax accident_health_insurance critical_illness_insurance tdsr_last_decision sec_deposit "
        "r_value_original prim_an_income co_app_an_income co_si_an_income"
    ),
    TimestampNTZType(): (
        "sub_date_time last_app_date_time fun_date_time first_decision_date_time last_decision_date_time up_date_time "
        "original_fun_pac_date_re"
    ),
}
_TYPE_OF = {name: kind for kind, names in _SNAPSHOT_TYPES.items() for name in names.split()}
SNAPSHOT_TARGET = tuple((name, _TYPE_OF.get(name, StringType())) for name, _ in SNAPSHOT_COLUMNS)

SUMMARY_TARGETS = {
    "analyst": PER_ANALYST_TARGET,
    "month": PER_MONTH_TARGET,
    "analyst_month": PER_ANALYST_MONTH_TARGET,
}

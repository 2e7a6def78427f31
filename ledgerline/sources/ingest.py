"""Source columns and codes as the plans expect them.

The source system compares codes without regard to letter case and trailing blanks, and some of its
columns have names with blanks. Both are settled once at the scan, so the plans can compare exactly
and use plain names.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.params import (
    APPROVAL_DECISIONS,
    AUTO_ANALYST,
    AUTO_DECISION,
    BOOKER_STATE,
    FINAL_DECISIONS,
    FUNDER_STATE,
    INCOME_MULTIPLIER,
    PRIMARY_APPLICANT_TYPE,
    SEGMENTS,
    SENDING_PRIMARY_TYPE,
    SENDING_STATE_TYPE,
)

#: logical source -> column -> the codes that the plans compare it with
CODES: dict[str, dict[str, Sequence[str]]] = {
    "funding_data": {"applicant_type": (PRIMARY_APPLICANT_TYPE,)},
    "ca_sending_data_ino": {"applicant_type": (SENDING_PRIMARY_TYPE,)},
    "wf_history": {
        "wf_state_type_name": (SENDING_STATE_TYPE,),
        "wf_state_name": tuple(dict.fromkeys(o for s in SEGMENTS for o in s[3])),
    },
    "wf_history_t": {"wf_state_name": (FUNDER_STATE[1], BOOKER_STATE[1])},
    "ino_decisions": {
        "analyst": (AUTO_ANALYST,),
        "cdecision": (AUTO_DECISION,),
        "decisiondescription": tuple(dict.fromkeys(FINAL_DECISIONS + APPROVAL_DECISIONS)),
    },
    "ino_c": {"ginomefre": tuple(INCOME_MULTIPLIER)},
    "major_dgg": {"ptype": ("O",)},
}


def plain_name(column: str) -> str:
    """A column name in lower case with runs of blanks and dashes as one underscore."""
    return re.sub(r"[\s-]+", "_", column.strip()).lower()


def plain_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[plain_name(c) for c in df.columns])


def normalise_codes(df: DataFrame, codes: Mapping[str, Sequence[str]]) -> DataFrame:
    """Values that equal a code but for letter case and trailing blanks become that code."""
    out = {}
    for column, values in codes.items():
        if column in df.columns:
            plain = F.lower(F.rtrim(F.col(column)))
            value = F.col(column)
            for code in values:
                value = F.when(plain == code.lower(), F.lit(code)).otherwise(value)
            out[column] = value
    return df.withColumns(out) if out else df


def ingested(df: DataFrame, source: str) -> DataFrame:
    """A source table with plain column names and normalised codes."""
    return normalise_codes(plain_names(df), CODES.get(source, {}))

"""Run parameters, business calendar settings and the fixed code sets.

Every operator takes its dates and code sets from here instead of reading the
wall clock, so a rerun (and an oracle) sees exactly the same inputs.
"""

from __future__ import annotations

import calendar
import datetime as dt
from dataclasses import dataclass, field


DAY_SECONDS = 86_400


def add_months(day: dt.date, months: int) -> dt.date:
    """Calendar month arithmetic that clamps to month end (2024-05-31 - 3 = 2024-02-29),
    the same rule as Spark's ``add_months``."""
    idx = day.year * 12 + (day.month - 1) + months
    year, month = divmod(idx, 12)
    last = calendar.monthrange(year, month + 1)[1]
    return dt.date(year, month + 1, min(day.day, last))


@dataclass(frozen=True)
class RunParams:
    """Scalar batch variables of a refresh.

    ``as_of`` replaces the current date (overdue tests); ``start``/``end`` bound the
    sending window and the workflow history lower bound.
    """

    as_of: dt.date
    start: dt.date
    end: dt.date

    @classmethod
    def trailing_months(cls, as_of: dt.date, months: int = 3) -> "RunParams":
        """``end = as_of``, ``start = as_of - months`` (the default refresh window)."""
        return cls(as_of=as_of, start=add_months(as_of, -months), end=as_of)


def _apart(rows) -> dict:
    """key -> its intervals sorted, overlapping and touching ones merged, empty ones left out."""
    out: dict = {}
    for key, start, end in sorted(rows):
        if not 0 <= start <= end <= DAY_SECONDS:
            raise ValueError(f"opening hours {start} to {end} of {key} are not within a day")
        slots = out.setdefault(key, [])
        if slots and start <= slots[-1][1]:
            slots[-1] = (slots[-1][0], max(end, slots[-1][1]))
        elif end > start:
            slots.append((start, end))
    return out


@dataclass(frozen=True)
class BusinessHours:
    """Opening hours used by ``business_seconds``.

    Days outside ``[first_day, last_day]`` are not covered: a timestamp there gets a
    NULL duration (and ``assert_calendar_covers`` reports it).
    """

    first_day: dt.date
    last_day: dt.date
    open_seconds: int = 9 * 3600
    close_seconds: int = 17 * 3600
    # Spark weekday(): Monday = 0 ... Sunday = 6
    open_weekdays: tuple[int, ...] = (0, 1, 2, 3, 4)
    # closed every year on these (month, day) pairs
    yearly_holidays: tuple[tuple[int, int], ...] = ()
    # closed on these exact dates
    holidays: tuple[dt.date, ...] = field(default_factory=tuple)
    # (weekday, open, close) in seconds of the day, several a day if need be; if given, it stands in
    # for open_seconds, close_seconds and open_weekdays. Overlapping hours count once.
    weekly: tuple[tuple[int, int, int], ...] = ()
    # (date, open, close): the hours of an exact date instead of its weekday's, holidays included
    special: tuple[tuple[dt.date, int, int], ...] = ()

    def week(self) -> dict[int, list[tuple[int, int]]]:
        """Opening intervals of each weekday, in order and apart from each other."""
        rows = self.weekly or [(d, self.open_seconds, self.close_seconds) for d in self.open_weekdays]
        return _apart(rows)

    def special_days(self) -> dict[dt.date, list[tuple[int, int]]]:
        return _apart(self.special)

    def n_days(self) -> int:
        return (self.last_day - self.first_day).days + 1


# ---------------------------------------------------------------------------
# Fixed values. These must equal the codes the source systems use.
# ---------------------------------------------------------------------------

SENDING_STATE_TYPE = "AudSendingWFState"
BOOKED_STATUS_KEY = 100

# workflow state ids per state class (pipeline E)
READY_STATE_IDS = (1,)
AWAITING_STATE_IDS = (0,)
DEF_PEN_STATE_IDS = (3,)
DEF_NEW_DOC_STATE_IDS = (4,)
FUNDED_STATE_IDS = (9, 10)

STATE_CLASSES = {
    "ready": READY_STATE_IDS,
    "awaiting": AWAITING_STATE_IDS,
    "def_pen": DEF_PEN_STATE_IDS,
    "def_new_doc": DEF_NEW_DOC_STATE_IDS,
    "funded": FUNDED_STATE_IDS,
}

# summary segments: (seq, group name, start class, outcome state names)
SEGMENTS = (
    (1, "From Ready for Re to Fun", "ready", ("Secu", "Fun")),
    (2, "From Ready for Re to Awaiting Ap", "ready", ("AwaitingAp",)),
    (3, "From Ready for Re to Def Pen", "ready", ("DefPen",)),
    (4, "From Def New D to Def Pen", "def_new_doc", ("DefPen",)),
    (5, "From Def New D to Fun", "def_new_doc", ("Secu", "Fun")),
)

# the code of the primary applicant: in the funding rows, and in the sending rows
PRIMARY_APPLICANT_TYPE = "Prim"
SENDING_PRIMARY_TYPE = "Primary"

# status log codes
SUBMIT_STATUS_IDS = (289, 290)
FUNDING_STATUS_ID = 297
PACKAGE_RECEIVED_STATUS_ID = 94

# decisions
FINAL_DECISIONS = ("App", "Con App", "D", "C P")
APPROVAL_DECISIONS = ("App", "Con App", "Doc Re", "Boo")
AUTO_ANALYST = "acp"
AUTO_DECISION = "CPP"
UNKNOWN_LABEL = "Unknown"

# income frequency multipliers; anything else (NULL too) counts as monthly
INCOME_MULTIPLIER = {"W": 52, "M": 12, "A": 1}
INCOME_DEFAULT_MULTIPLIER = 12
RELATION_TYPES = {1: "prim", 2: "co_app", 3: "co_si"}

# workflow states that name the funder / booker (state id, state name)
FUNDER_STATE = (62, "Funing")
BOOKER_STATE = (4, "Boo")

# contract flags
APPROVED_STATUS_KEYS = (14, 15)
APPROVAL_DATE_STATUS_KEYS = (4, 5)
FUNDED_STATUS_KEY = 10
CANCELLED_STATUS_KEYS = (11, 12)
DECLINED_STATUS_KEYS = (6,)
FCA_PORT_KEY = 1
NOT_APPLICABLE = "N/A"
OVERDUE_DAYS = 30

"""Reusable DataFrame operators."""

from ledgerline.operators.audit import KeyAudit
from ledgerline.operators.keys import (
    assert_unique,
    earliest_per_key,
    first_last_per_key,
    latest_per_key,
    nth_per_key,
    sequence_per_key,
)
from ledgerline.operators.pairing import pair_next_event
from ledgerline.operators.summary import segment_summaries, segment_summary, summary_cells

__all__ = [
    "assert_unique", "earliest_per_key", "first_last_per_key", "latest_per_key", "nth_per_key", "sequence_per_key",
    "pair_next_event", "KeyAudit", "segment_summaries", "segment_summary", "summary_cells",
]

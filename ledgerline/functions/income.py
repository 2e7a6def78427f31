"""Income per year from an amount and its frequency code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.params import INCOME_DEFAULT_MULTIPLIER, INCOME_MULTIPLIER


def annualised(freq: Column, amount: Column) -> Column:
    """Amount times the pay periods of its frequency (W 52, M 12, A 1, anything else 12)."""
    times = F.lit(INCOME_DEFAULT_MULTIPLIER)
    for code, multiplier in INCOME_MULTIPLIER.items():
        times = F.when(freq == code, F.lit(multiplier)).otherwise(times)
    return (amount * times).cast("decimal(18,2)")

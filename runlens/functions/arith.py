"""Arithmetic helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(num: Column | str, den: Column | str) -> Column:
    """num / den, NULL when den is 0: a plain division that stays inside
    whole-stage codegen and cannot raise DIVIDE_BY_ZERO under ANSI mode."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return num / F.nullif(den, F.lit(0))

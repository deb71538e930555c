"""Restrict a run table to a set of sessions before any shuffle.

When runs live in their own table (flat layout) and the sessions are cut by
a date range, the runs of other sessions should not reach the kernel's
shuffle. The key set is broadcast only when its size is proven: it is
counted first (a pruned, filtered scan of the session table), and only a
count at or below ``max_broadcast_keys`` is broadcast. Above the bound the
semi-join is a shuffled hash join that builds on the key side (never a
broadcast chosen from an estimate); AQE's skew handling splits a hot
session's partition on the run side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_KEYS = 2_000_000  # ~16 MB of 8-byte keys plus hash-table overhead


def restrict_to_keys(runs: DataFrame, keys: DataFrame, runs_key: str, keys_key: str | None = None,
                     max_broadcast_keys: int = DEFAULT_MAX_BROADCAST_KEYS) -> DataFrame:
    keys_key = keys_key or runs_key
    key_set = keys.select(F.col(keys_key).alias(runs_key))
    n = key_set.count()
    if n <= max_broadcast_keys:
        return runs.join(F.broadcast(key_set), runs_key, "left_semi")
    return runs.join(key_set.hint("shuffle_hash"), runs_key, "left_semi")

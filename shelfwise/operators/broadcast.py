"""Broadcast only behind a size check.

Written dimensions need no hint: Catalyst knows their file size and broadcasts
them under its own threshold, and AQE does the same for shuffled inputs. A hint
is given only where Catalyst cannot see the bound, and only if the files behind
the frame are small; otherwise the join is left to Catalyst and AQE, which still
work when the "dimension" is as large as a fact.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# bytes of parquet behind a frame; decoded columns are a few times larger
MAX_BYTES = 16 << 20


def checked_broadcast(df: DataFrame, source_bytes: int, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Broadcast ``df``, a projection or key-preserving join of a table of ``source_bytes``, if that is small."""
    return F.broadcast(df) if source_bytes <= max_bytes else df


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a frame whose size has a fixed bound by construction.

    Use only for: the region table (5 rows), the nation table (25 rows), the
    fiscal calendar (n_weeks rows), literal lookup tables and one-row scalars.
    """
    return F.broadcast(df)

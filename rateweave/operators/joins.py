"""Attaching small fitted/statistics tables to large frames.

A statistics table (one row per group: band limits, means, frequencies) has as many rows
as the group key has values, which is not known in advance.  ``attach_stats`` writes the
table once, measures it (rows and the bytes of its text), and broadcasts it only within
``broadcast_bytes``.  The large side is then joined without being shuffled, so a hot
group key costs nothing extra.  Beyond the limit it is a regular shuffle join, which AQE
splits when a key is skewed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateweave.session import cut_lineage

BROADCAST_BYTES = 64 << 20
CELL_BYTES = 16


def measured_bytes(df: DataFrame) -> int:
    """Bytes of a table: fixed cells at ``CELL_BYTES`` each and the bytes of its text."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields
             if f.dataType.typeName() in ("string", "binary")]
    row = F.lit(CELL_BYTES * (len(df.columns) + 1)).cast("long")
    for t in texts:
        row = row + t
    return int(df.agg(F.sum(row)).first()[0] or 0)


def attach_stats(df: DataFrame, stats: DataFrame, on: str | Sequence[str], how: str = "left",
                 broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join ``stats`` (one row per key) onto ``df``, broadcasting only after a size check."""
    keys = [on] if isinstance(on, str) else list(on)
    small = cut_lineage(stats)
    side = F.broadcast(small) if measured_bytes(small) <= broadcast_bytes else small
    return df.join(side, on=keys, how=how)

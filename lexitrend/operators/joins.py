"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# Broadcast bound for derived lookup tables: bytes of their rows as text, measured on the materialised side.
MAX_BROADCAST_BYTES = 32 << 20


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_bytes: int = MAX_BROADCAST_BYTES, materialised: bool = False) -> DataFrame:
    """Join ``big`` with a derived table that is small in practice.

    The small side is materialised once in the shared checkpoint folder
    (lineage cut; it is not recomputed for the measure and the join), its bytes
    are measured, and it is broadcast only up to ``max_bytes``.  Beyond the
    bound the plain join is kept: a shuffle join that AQE can split on skew.
    Low-cardinality keys such as (category, year) would otherwise send a hot
    cell's rows to one task.  ``materialised=True`` skips the checkpoint
    for a small side that is already a checkpoint or a cheap projection of one.
    """
    if not materialised:
        ensure_checkpoint_dir(small.sparkSession)
        small = small.checkpoint(eager=True)
    size = F.sum(F.octet_length(F.concat_ws(",", *[F.col(f"`{c}`").cast("string") for c in small.columns])) + 8)
    if (small.agg(size.cast("long")).first()[0] or 0) <= max_bytes:
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)

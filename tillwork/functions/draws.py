"""Reproducible pseudo-random draws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_draw(row_id: Column, stream: str, seed: int, buckets: int) -> Column:
    """Integer in [0, buckets) fixed by the row id, the stream name and the seed.

    Unlike ``rand()`` the value does not depend on how rows are partitioned, so a
    recomputed task gives the same rows.
    """
    digest = F.md5(F.concat_ws("-", row_id.cast("string"), F.lit(stream), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets

"""Left lookup joins that stay safe as either side grows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup table of at most this many rows is broadcast (some ten MB).
BROADCAST_ROWS = 200_000


def lookup_join(events: DataFrame, table: DataFrame, keys: list[str], table_rows: int,
                broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Left join to a table that is unique on ``keys`` and has ``table_rows`` rows.

    A counted, small table is broadcast: the events do not move.  A larger one
    is joined by sort and merge, every row moving once; Spark splits the events
    of a partition that a hot key makes large and reads the few table rows again
    for each part (``forceOptimizeSkewedJoin`` in ``session.SETTINGS``).
    """
    if table_rows <= broadcast_rows:
        return events.join(F.broadcast(table), keys, "left")
    return events.join(table.hint("merge"), keys, "left")

"""Detection on a stream of events.

Features, rules, chains and fusion keep no state once baseline and model are
fitted, so every micro-batch is an ordinary table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from procwarden.operators.rules import Rule
from procwarden.plans.detection import Artefacts, detect
from procwarden.session import step_tables


def write_detections(events: DataFrame, artefacts: Artefacts, path: str, checkpoint: str,
                     rules: list[Rule] | None = None, once: bool = False) -> StreamingQuery:
    """Detect on every micro-batch and write it below ``path``, one folder per batch.

    A batch that is run again replaces its own folder, so results are neither
    lost nor doubled.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        with step_tables(batch.sparkSession):  # a batch leaves no table behind but its own
            detect(batch, artefacts, rules).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = events.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()

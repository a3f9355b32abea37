"""Alert messages as a stream: parse, set bad ones aside, shape delivery bodies."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.operators import alerts
from rillmark.sinks.bronze import replace_partitions
from rillmark.streaming.batched import BATCH


def delivery_writer(
    root: str, keys_by_topic: Mapping[str, str], base_key: str = ""
) -> Callable[[DataFrame, int], None]:
    """`foreachBatch` function over messages (topic, key, value, ts_ms).

    Bodies go to `outbox`, messages that are no JSON object to `rejects`, events
    with an unknown action to `ignored`. A bad message never stops the stream,
    and a batch that is read twice replaces what it wrote the first time.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        events, rejects = alerts.parse_events(batch)
        known, ignored = alerts.split_actions(events)
        bodies = alerts.outbound(known, keys_by_topic, base_key)
        for rows, place in ((bodies, "outbox"), (rejects, "rejects"), (ignored, "ignored")):
            replace_partitions(rows.withColumn(BATCH, F.lit(batch_id)), f"{root}/{place}", (BATCH,))

    return write

"""Running streaming queries to completion (tests, backfills) and sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def run_available(df: DataFrame, name: str, checkpoint: str, mode: str = "append",
                  timeout_s: int = 600) -> tuple[DataFrame, StreamingQuery]:
    """Process everything available now into the in-memory table ``name``
    (``trigger(availableNow=True)``); returns the table and the query."""
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination(timeout_s)
    if q.exception():
        raise q.exception()
    return df.sparkSession.table(name), q


def run_foreach_batch(df: DataFrame, writer: Callable[[DataFrame, int], None], checkpoint: str,
                      mode: str = "append", timeout_s: int = 600) -> StreamingQuery:
    """Feed every micro-batch to ``writer(batch_df, batch_id)``; the
    checkpoint makes a restarted query resume after the last committed
    batch (writers are idempotent per batch id)."""
    q = (df.writeStream.foreachBatch(writer).outputMode(mode)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination(timeout_s)
    if q.exception():
        raise q.exception()
    return q


def final_watermark_ms(q: StreamingQuery) -> int | None:
    """Event-time watermark after the last micro-batch, in epoch ms."""
    from datetime import datetime, timezone
    for p in reversed(q.recentProgress):
        wm = (p.get("eventTime") or {}).get("watermark")
        if wm and wm.endswith("Z"):
            t = datetime.strptime(wm, "%Y-%m-%dT%H:%M:%S.%fZ").replace(tzinfo=timezone.utc)
            return int(t.timestamp() * 1000)
    return None

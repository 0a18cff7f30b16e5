"""How a stream runs: drain what is there (``availableNow``, the default: the call
returns when the source is drained) or keep running on a processing-time trigger (the
call returns at once; the query runs on, see ``spark.streams.active``)."""

from __future__ import annotations

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def start(writer: DataStreamWriter, trigger: dict | None = None) -> StreamingQuery:
    """``trigger``: None -> ``availableNow`` and wait; else e.g.
    ``{"processingTime": "1 minute"}`` and return the running query."""
    if trigger is None:
        q = writer.trigger(availableNow=True).start()
        q.awaitTermination()
        return q
    return writer.trigger(**trigger).start()

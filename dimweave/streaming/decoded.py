"""Loads from message text: each micro-batch is decoded by its entity's schema, dead letters go
to a folder of their own, and the rest is loaded.

Messages are (``value`` text, ``seq``, ``ts``), for example ``sources.streams.topic_messages``.
Several kinds of messages (two topics) are one query with one checkpoint, so a micro-batch loads
what all of them brought.  Dead letters are written under the batch's id: a batch that is run
again writes the same files.
"""

from __future__ import annotations

import functools
import posixpath
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimweave.sources.messages import decode, message_text
from dimweave.streaming.triggers import start

KIND = "entity"


@dataclass(frozen=True)
class Entity:
    """One kind of message: its schema, the fields it must have, fields read as another type than
    the schema's, and ``events``, which makes the loader's rows of the decoded ones (these hold
    ``seq`` and ``ts`` besides the schema's fields)."""

    name: str
    schema: T.StructType
    events: Callable[[DataFrame], DataFrame]
    required: Sequence[str] = ()
    typed: Mapping[str, str] = field(default_factory=dict)


def run_messages(streams: Sequence[tuple[Entity, DataFrame]], load: Callable[[DataFrame, int], None], root: str, *,
                 trigger: dict | None = None) -> str:
    """Decode every stream by its entity and hand each batch's events to ``load``, a
    ``foreachBatch`` body.  Returns the dead letters' folder (entity, seq, ts, raw_value, reason)."""
    folder = posixpath.join(root, "dead")

    def handler(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read once for the dead letters and once or more by the load
        good, dead = [], []
        for e, _ in streams:
            own = batch.filter(F.col(KIND) == e.name)
            g, d = decode(own, message_text(own), e.schema, required=e.required, keep=["seq", "ts"], typed=e.typed)
            good.append(e.events(g))
            dead.append(d.select(F.lit(e.name).alias(KIND), "*"))
        functools.reduce(DataFrame.unionByName, dead).write.mode("overwrite").parquet(posixpath.join(folder, f"batch={batch_id}"))
        load(functools.reduce(DataFrame.unionByName, good), batch_id)
        batch.unpersist()

    tagged = [m.select(F.lit(e.name).alias(KIND), "value", "seq", "ts") for e, m in streams]
    stream = functools.reduce(DataFrame.unionByName, tagged)
    start(stream.writeStream.foreachBatch(handler).option("checkpointLocation", posixpath.join(root, "checkpoint")), trigger)
    return folder

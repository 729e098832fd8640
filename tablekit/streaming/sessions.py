"""Session summaries on a stream (A22): watermark + session_window."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import duration_micros, duration_sql, epoch_micros, ntz_from_micros


def _combined(events: DataFrame, gap: int) -> DataFrame:
    """Rows (user, lo, hi, n) for runs of events, before any shuffle.  ``events``
    holds the user and epoch micro-seconds ``at``.

    Events of a user in one slice of ``gap`` width are never more than ``gap``
    apart, so they are of one session whatever else arrives: each Arrow batch
    sends one row for them, and a user with a third of the stream a few rows a
    task.  The latest event of a batch stays by itself, as the start of its row:
    the watermark, the largest start seen, is the one of the single events."""
    schema = T.StructType([events.schema.fields[0], *[T.StructField(c, T.LongType()) for c in ("lo", "hi", "n")]])

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_arrays(batch.columns, names=["user", "at"])
            rows = rows.filter(pc.is_valid(rows["at"]))
            if not rows.num_rows:
                continue
            at = rows["at"]
            # whole division rounds towards zero, which joins two slices at zero: shift times before it
            slot = pc.divide(pc.if_else(pc.less(at, 0), pc.subtract(at, gap - 1), at), gap)
            latest = pc.equal(at, pc.max(at)).cast(pa.int8())
            out = (rows.append_column("slot", slot).append_column("latest", latest)
                   .group_by(["user", "slot", "latest"]).aggregate([("at", "min"), ("at", "max"), ("at", "count")])
                   .select(["user", "at_min", "at_max", "at_count"]).rename_columns(schema.names).combine_chunks())
            yield from out.to_batches()

    return events.mapInArrow(combine, schema)


def _to_ntz(c):
    return ntz_from_micros(F.expr(c))


def session_summary_stream(stream: DataFrame, user: str, ts: str, gap="30 minutes",
                           watermark="10 minutes") -> DataFrame:
    """One row per closed session: user, start, end (last event + gap) and
    event count.  In append mode a session is emitted once the watermark
    passes its end, so open sessions are not emitted; events older than the
    watermark are dropped (an event that arrives in one Arrow batch with events
    of its session that are not is kept with them).  State is bounded by the
    watermark.  Tasks combine their events into session parts (``_combined``)
    and only parts are shuffled, so a hot user is a few rows a task."""
    # withWatermark needs TIMESTAMP; NTZ wall clock is mapped to the instant
    # with the same epoch micro-seconds, which keeps durations exact in any
    # session time zone.
    g = duration_micros(gap)
    parts = _combined(stream.select(F.col(user), epoch_micros(stream, ts).alias("at")), g)
    parts = parts.withColumn("_tk_et", F.timestamp_micros("lo")).withWatermark("_tk_et", duration_sql(watermark))
    reach = F.concat((F.col("hi") - F.col("lo") + g).cast("string"), F.lit(" microseconds"))
    agg = (parts.groupBy(F.col(user), F.session_window("_tk_et", reach).alias("_tk_s"))
           .agg(F.sum("n").alias("event_count")))
    return agg.select(user,
                      _to_ntz("unix_micros(_tk_s.start)").alias("session_start"),
                      _to_ntz("unix_micros(_tk_s.end)").alias("session_end"),
                      "event_count")

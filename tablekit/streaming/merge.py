"""Insert-only merge of a stream into a table directory (A23)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators._util import as_list, null_safe_on
from ..operators.dedup import dedup_keep_first
from ..sources.files import path_exists
from ..sources.key_index import ROWS_PER_FILE, KeyIndex, spread_by_key


def merge_insert_new_stream(stream: DataFrame, target_path: str, keys: str | Sequence[str],
                            order_by: Sequence[str | Column] | str, checkpoint: str | None = None,
                            trigger_available_now: bool = True, rows_per_file: int = ROWS_PER_FILE,
                            on_batch: Callable[[dict], None] | None = None):
    """Each micro-batch inserts the rows whose key is absent from the target,
    the first of a key by ``order_by`` (then by all columns).  The anti join
    against the target makes the insert exact, however late a row is and
    whether or not a batch is replayed, so no watermark drops rows; NULL keys
    count as equal and are inserted once.

    A key index beside the target (``sources.key_index``) names the files that
    may hold a key of the batch; the anti join reads the keys of those alone.
    New rows are written by stretches of the keys' hash, about
    ``rows_per_file`` a file, so that random keys meet few files too.
    ``on_batch`` gets a dict a batch: epoch, keys, files (of the target before
    the batch) and files_read.  Returns the started ``StreamingQuery``."""
    keys = as_list(keys)
    spark = stream.sparkSession
    order = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)

    def insert_batch(batch: DataFrame, epoch: int) -> None:
        index = KeyIndex(spark, target_path, keys, batch.schema)
        b = dedup_keep_first(batch, keys, [*order, *batch.columns]).persist()
        try:
            k = F.col(keys[0])
            n, lo, hi, nulls = b.agg(F.count(F.lit(1)), F.min(k), F.max(k), F.count_if(k.isNull())).first()
            new, files, total = b, [], 0
            if path_exists(spark, target_path):
                if not n:
                    return
                files, total = index.may_hold(b)
            if files:
                there = index.read(files).select(*keys)
                if not isinstance(batch.schema[keys[0]].dataType, T.TimestampType):   # prunes row groups
                    near = F.lit(False) if lo is None else k.between(F.lit(lo), F.lit(hi))
                    there = there.filter(near | k.isNull() if nulls else near)
                renamed, cond = null_safe_on(b, there, keys)
                new = b.join(renamed, cond, "left_anti")
            spread_by_key(new, keys, n, rows_per_file).write.mode("append").parquet(target_path)
            index.refresh()
            if on_batch:
                on_batch({"epoch": epoch, "keys": n, "files": total, "files_read": len(files)})
        finally:
            b.unpersist()

    w = stream.writeStream.foreachBatch(insert_batch)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if trigger_available_now:
        w = w.trigger(availableNow=True)
    return w.start()

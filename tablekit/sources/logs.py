"""Multi-line text logs to one row per entry (I09).

Lines are numbered per file without a single-task window: inside each file
block (bounded by ``maxPartitionBytes``) a running count of entry starts is
taken, and the starts of earlier blocks of the same file are added from a
small per-block table.  Entries are then assembled per (file, block, entry)
on the same partitioning; a group is one log entry, plus the lines that
continue it in the next block.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from .files import path_exists, publish, remove_path
from .tables import partition_folder, read_layout

# fixed value: a line that opens a log entry ("YYYY-MM-DD HH:MM:SS,mmm ")
ENTRY_START = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3} "
ERROR_LEVELS = ("ERROR", "CRITICAL")  # fixed values: levels that carry a stack trace

AUDIT_COLUMNS = ["Env", "Log_Date", "Level", "Logger", "Message", "Run_ID", "Notebook_Path",
                 "Ingestion_UTC_TS", "Raw_Line", "Spark_APP_ID", "Job_Type", "Exception_Message",
                 "Stack_Trace", "Error_Code"]


def log_entries(lines: DataFrame, pattern: str = ENTRY_START) -> DataFrame:
    """``lines`` has columns line, file, block, seq (seq increasing within a
    block).  Returns file, entry_key, lines (array in file order).

    After the numbering window the rows are hash-partitioned by (file,
    block); grouping by (file, block, entry) reuses that partitioning, so
    the lines are shuffled once.  Only the lines at the top of a block that
    continue an entry begun in an earlier block are grouped apart and joined
    to their entry (one row per entry; normally a handful of lines)."""
    starts = lines.withColumn("_tk_start", F.col("line").rlike(pattern).cast("int"))
    in_block = Window.partitionBy("file", "block").orderBy("seq") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = starts.withColumn("_tk_local", F.sum("_tk_start").over(in_block))
    per_block = local.groupBy("file", "block").agg(F.sum("_tk_start").alias("_tk_n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = per_block.select(
        "file", "block",
        F.coalesce(F.sum("_tk_n").over(earlier), F.lit(0)).alias("_tk_off"),
        # the block whose last entry continues into this one
        F.last(F.when(F.col("_tk_n") > 0, F.col("block")), ignorenulls=True).over(earlier).alias("_tk_from"))
    numbered = (local.join(blocks, ["file", "block"])
                     .withColumn("_tk_entry", F.col("_tk_off") + F.col("_tk_local")))
    orphan = F.col("_tk_entry") == 0                     # before the file's first entry
    carried = (F.col("_tk_local") == 0) & ~orphan          # continues an earlier block's entry
    key = F.when(orphan, F.concat(F.lit("o"), F.col("block").cast("string"), F.lit(":"),
                                  F.col("seq").cast("string"))) \
           .otherwise(F.col("_tk_entry").cast("string"))
    keyed = numbered.withColumn("entry_key", key)
    main = (keyed.filter(~carried)
                 .groupBy("file", "block", "entry_key")
                 .agg(F.array_sort(F.collect_list(F.struct("seq", "line"))).alias("_tk_l")))
    # at most one carried entry per source block: its last one
    cont = (keyed.filter(carried)
                 .groupBy("file", F.col("_tk_from").alias("block"))
                 .agg(F.first("entry_key").alias("_tk_ckey"),
                      F.array_sort(F.collect_list(F.struct("block", "seq", "line"))).alias("_tk_c")))
    joined = main.join(cont, ["file", "block"], "left")
    tail = F.when(F.col("_tk_ckey") == F.col("entry_key"), F.transform("_tk_c", lambda s: s["line"]))
    lines_out = F.concat(F.transform("_tk_l", lambda s: s["line"]),
                         F.coalesce(tail, F.array().cast("array<string>")))
    return joined.select("file", "entry_key", lines_out.alias("lines"))


def default_parser(lines: Column) -> dict[str, Column]:
    """First line split in 5 by blank: date, time, level, logger, message;
    fewer parts: only the message (the whole line).  ERROR/CRITICAL entries
    with more lines carry the message as exception and the rest as trace."""
    first = F.element_at(lines, 1)
    parts = F.split(F.regexp_replace(first, r"^\s+|\s+$", ""), " ", 5)
    full = F.size(parts) >= 5
    level = F.when(full, F.element_at(parts, 3))
    message = F.when(full, F.element_at(parts, 5)).otherwise(first)
    is_err = F.upper(level).isin(*ERROR_LEVELS) & (F.size(lines) > 1)
    return {
        "Log_Date": F.when(full, F.concat_ws(" ", F.element_at(parts, 1), F.element_at(parts, 2))),
        "Level": level, "Logger": F.when(full, F.element_at(parts, 4)), "Message": message,
        "Exception_Message": F.when(is_err, message),
        "Stack_Trace": F.when(is_err, F.array_join(F.slice(lines, 2, F.size(lines) - 1), "\n"))}


PARSED = ["Log_Date", "Level", "Logger", "Message", "Exception_Message", "Stack_Trace"]
FAILURE = "parse_error"  # a parser's extra column: the reason why an entry cannot be parsed, else NULL


def parse_entries(entries: DataFrame, parser: Callable[[Column], dict[str, Column]] | None = None) -> DataFrame:
    """The entries' fields as ``parser`` gives them: a function from the
    column of an entry's lines to columns named as in ``PARSED`` (a missing one is
    NULL).  Where its ``parse_error`` column is not NULL the entry becomes a row of
    level PARSE_ERROR with the reason as message and nothing else."""
    given = (parser or default_parser)(F.col("lines"))
    unknown = set(given) - {*PARSED, FAILURE}
    if unknown:
        raise ValueError(f"a parser gives {PARSED} and {FAILURE}, not {sorted(unknown)}")
    why = given.get(FAILURE, F.lit(None)).cast("string")
    failed = {"Level": F.lit("PARSE_ERROR"), "Message": F.concat(F.lit("PARSE_FAIL: "), why)}
    null = F.lit(None).cast("string")
    fields = [F.when(why.isNotNull(), failed.get(c, null)).otherwise(given.get(c, null).cast("string")).alias(c) for c in PARSED]
    return entries.select("file", "entry_key", *fields, F.array_join("lines", "\n").alias("Raw_Line"))


def parse_log(spark: SparkSession, path: str, run_id: str, env: str = "",
              notebook: str = "", pattern: str = ENTRY_START,
              parser: Callable[[Column], dict[str, Column]] | None = None) -> DataFrame:
    """Text log files -> one audit row per entry (14 string columns), parsed by
    ``parser`` (see ``parse_entries``)."""
    raw = spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"))
    parsed = parse_entries(log_entries(raw, pattern), parser)
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat()
    return parsed.select(
        F.lit(env).alias("Env"), "Log_Date", "Level", "Logger", "Message",
        F.lit(run_id).alias("Run_ID"), F.lit(notebook).alias("Notebook_Path"),
        F.lit(now).alias("Ingestion_UTC_TS"), "Raw_Line",
        F.lit(spark.sparkContext.applicationId).alias("Spark_APP_ID"),
        F.lit("notebook").alias("Job_Type"), "Exception_Message", "Stack_Trace",
        F.lit(None).cast("string").alias("Error_Code"))


def persist_log(spark: SparkSession, path: str, target: str, run_id: str, env: str = "", notebook: str = "",
                pattern: str = ENTRY_START, parser: Callable[[Column], dict[str, Column]] | None = None) -> DataFrame:
    """Append a run's audit rows to the table at ``target``, one folder a run.

    The append is keyed by the run: its folder is written under another name
    and renamed when complete, so a run that was lost half-way leaves no rows,
    and a repeated one adds nothing (status EXISTS).  Returns a one-row report:
    run_id, status (OK, NO_DATA or EXISTS), records appended."""
    if not run_id:
        raise ValueError("a run needs an id")
    folder = f"{target.rstrip('/')}/{partition_folder(spark, {'Run_ID': run_id})}"
    status, records = "EXISTS", 0
    if not path_exists(spark, folder):
        staging = f"{target.rstrip('/')}/_{uuid.uuid4().hex}"   # readers skip names with an underscore
        seen = Observation("tk_log")
        rows = parse_log(spark, path, run_id, env, notebook, pattern, parser).observe(seen, F.count(F.lit(1)).alias("records"))
        rows.drop("Run_ID").write.parquet(staging)
        records = int(seen.get["records"])
        status = "OK" if records else "NO_DATA"
        if records:
            publish(spark, staging, folder)
        else:
            remove_path(spark, staging)
    return spark.createDataFrame([(run_id, status, records)], "run_id string, status string, records long")


def read_audit(spark: SparkSession, target: str) -> DataFrame:
    """All audit rows of ``target``, run ids as text."""
    return read_layout(spark, target).select(*AUDIT_COLUMNS)

"""Incremental drop-folder ingest (L1) with a late-correction policy (L2).

A Structured Streaming file source watches the folder; every micro-batch is
merged into the table with the store's upsert (idempotent: replaying a batch
after a failure gives the same table).  The checkpoint location replaces the
reference's nightly 60-session re-scan: files already merged are not read
again.

The result does not depend on how files are cut into batches.  Files count in
the order of their modification times.  A key that several files hold gets, column
by column, the last value that is not NULL, in one batch as over several; two
different values of one key and column from files of one time are refused with an
error.  The late policy judges a row by the newest date of its own file and all
earlier ones, a high-water mark that the stream keeps in its state store.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.operators.joins import asof_join
from panelforge.sources.tables import Table


def latest_per_key(batch: DataFrame, ids: Sequence[str], order_col: str = "_mtime") -> DataFrame:
    """One row a key: in each column the last value by ``order_col`` that is not NULL.
    Different values of one key, column and time raise."""
    ids = list(ids)
    values = [c for c in batch.columns if c not in (*ids, order_col)]
    if not values:
        return batch.select(*ids).distinct()
    at_once = batch.groupBy(*ids, order_col).agg(*[F.min(c).alias(f"_lo_{c}") for c in values], *[F.max(c).alias(f"_hi_{c}") for c in values])
    conflict = F.raise_error(F.lit(f"conflicting rows of one key ({', '.join(ids)}) arrived at one time"))
    one = {c: F.when(F.col(f"_lo_{c}").eqNullSafe(F.col(f"_hi_{c}")), F.col(f"_hi_{c}")).otherwise(conflict.cast(batch.schema[c].dataType)) for c in values}
    each = at_once.select(*ids, order_col, *[e.alias(c) for c, e in one.items()])
    last = each.groupBy(*ids).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order_col))).alias(c) for c in values])
    return last.select(*[c for c in batch.columns if c != order_col])


def oldest_accepted(calendar: DataFrame, n_sessions: int) -> DataFrame:
    """(date, oldest): for each session the first of the ``n_sessions`` that end there
    (the calendar's first where it has no so many).  One row per trading day."""
    days = calendar.select("date").distinct()
    w = Window.orderBy("date")
    first = F.first("date").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return days.select("date", F.coalesce(F.lag("date", n_sessions - 1).over(w), first).alias("oldest"))


def with_oldest(marks: DataFrame, calendar: DataFrame, n_sessions: int) -> DataFrame:
    """``marks`` with the oldest date that is accepted up to their date ``mark``, which
    is the mark itself before the first session."""
    sessions = oldest_accepted(calendar, n_sessions).select(F.lit(0).alias("_k"), F.col("date").alias("_session"), F.col("oldest").alias("_oldest"))
    found = asof_join(marks.withColumn("_k", F.lit(0)), sessions, "mark", "_session", "_k")
    return found.select(*marks.columns, F.coalesce("_oldest", "mark").alias("oldest"))


def accept_recent(batch: DataFrame, calendar: DataFrame, n_sessions: int, date_col: str = "date") -> DataFrame:
    """L2 for one batch: keep records dated within the last ``n_sessions`` sessions up to
    the batch's newest date; older corrections are refused."""
    newest = batch.agg(F.max(date_col).alias("mark")).filter(F.col("mark").isNotNull())
    bound = with_oldest(newest, calendar, n_sessions).first()
    return batch if bound is None else batch.filter(F.col(date_col) >= F.lit(bound["oldest"]))


def _newest_by_file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: (path, mtime, newest) of the files that it read."""
    found: dict[tuple, object] = {}
    for b in batches:
        if b.num_rows:
            each = pa.Table.from_batches([b]).group_by(["path", "mtime"]).aggregate([("day", "max")])
            for path, mtime, day in zip(each["path"].to_pylist(), each["mtime"].to_pylist(), each["day_max"].to_pylist(), strict=True):
                known = found.get((path, mtime))
                found[path, mtime] = day if known is None else known if day is None else max(known, day)
    keys = list(found)
    yield pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.timestamp("us", "UTC")), pc.cast(pa.array([found[k] for k in keys], pa.date32()), pa.date32())],
        ["path", "mtime", "newest"])


def _marked(key: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """Files in order of arrival with the high-water mark after each; it stays in the state."""
    files = pd.concat(list(parts)).groupby(["mtime", "path"], as_index=False)["newest"].max().sort_values(["mtime", "path"])
    mark = state.get[0] if state.exists else None
    marks = []
    for day in files["newest"]:
        if not pd.isna(day) and (mark is None or day > mark):
            mark = day
        marks.append(mark)
    if mark is not None:
        state.update((mark,))
    yield files.assign(mark=marks)[["path", "mark"]]


def arrivals(files: DataFrame, date_col: str = "date") -> DataFrame:
    """(path, mark) of the files of a stream: the newest date of the file and all before
    it.  Each task sends a row a file, so the one state's input is the files, not rows."""
    meta = F.col("_metadata")
    rows = files.select(F.col(date_col).cast("date").alias("day"), meta.file_path.alias("path"), meta.file_modification_time.alias("mtime"))
    each = rows.mapInArrow(_newest_by_file, "path string, mtime timestamp, newest date")
    return each.withColumn("k", F.lit(0)).groupBy("k").applyInPandasWithState(_marked, "path string, mark date", "mark date", "append", "NoTimeout")


def ingest_folder(spark: SparkSession, folder: str, schema: T.StructType, table: Table, checkpoint: str,
                  max_files_per_trigger: int = 1, calendar: DataFrame | None = None,
                  max_age_sessions: int | None = None) -> None:
    """Merge every parquet file dropped in ``folder`` into ``table`` and stop
    when the backlog is done (``availableNow``).

    With a ``calendar`` and ``max_age_sessions`` a row older than so many sessions
    up to the high-water mark of its file is refused.  The stream then carries the
    files with their marks (it reads the dates only), and a batch reads its files:
    their list is bounded by ``max_files_per_trigger``."""
    date_col = table.spec.date_col
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(folder)
    mtime = F.col("_metadata.file_modification_time").alias("_mtime")

    def merge(batch: DataFrame, epoch: int) -> None:
        table.upsert(latest_per_key(batch, table.spec.ids))

    def merge_recent(batch: DataFrame, epoch: int) -> None:
        files = [(r["path"], r["mark"]) for r in batch.collect()]
        if not files:
            return
        marks = with_oldest(spark.createDataFrame(files, "path string, mark date"), calendar, max_age_sessions)
        rows = spark.read.schema(schema).parquet(*[unquote(path) for path, _ in files])
        rows = rows.select("*", mtime, F.col("_metadata.file_path").alias("path")).join(F.broadcast(marks.select("path", "oldest")), "path")
        recent = rows.filter(F.col(date_col) >= F.col("oldest")).drop("path", "oldest")
        table.upsert(latest_per_key(recent, table.spec.ids))

    late = calendar is not None and max_age_sessions is not None
    out = arrivals(stream, date_col) if late else stream.select("*", mtime)
    q = (out.writeStream.outputMode("append").foreachBatch(merge_recent if late else merge).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()

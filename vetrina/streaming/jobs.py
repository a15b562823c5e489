"""Structured Streaming forms of the polling operators. Each takes and gives a streaming (or batch) DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vetrina.operators.folds import SIZE, fold, merged_runs, pieces, runs_of
from vetrina.sources.sinks import cleared
from vetrina.sources.tables import StoredTable


def velocity(rows: DataFrame) -> DataFrame:
    """First and last views of every item, all-time: for update or complete mode, no watermark."""
    return rows.groupBy("item_id").agg(F.count("*").alias("n"), F.min("parsed_at").alias("first_at"), F.max("parsed_at").alias("last_at"),
                                       F.min_by("price", "parsed_at").alias("first_value"), F.max_by("price", "parsed_at").alias("last_value"))


def status_counts(rows: DataFrame, at: str, status: str, width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Counts of each status in windows of event time."""
    return rows.withWatermark(at, late).groupBy(F.window(at, width), status).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), status, "n")


def first_seen(rows: DataFrame, key: str, at: str, horizon: str) -> DataFrame:
    """The first row of a key within a horizon."""
    return rows.withWatermark(at, horizon).dropDuplicatesWithinWatermark([key])


class _Silence(StatefulProcessor):
    """Keeps the last heartbeat of an entity; a timer on event time emits it when nothing followed."""

    def __init__(self, seconds: int) -> None:
        self.ms = seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        at = max(int(x["ts"].astype("datetime64[us]").astype("int64").max()) // 1000 for x in rows)
        if self.last.exists():
            at = max(at, self.last.get()[0])
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
        self.last.update((at,))
        self.handle.registerTimer(at + self.ms)
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        at = self.last.get()[0]
        self.last.clear()
        yield pd.DataFrame({"id": [key[0]], "silent_since": pd.to_datetime([at], unit="ms")})


def silence_alert(rows: DataFrame, seconds: int, late: str = "1 minute") -> DataFrame:
    """(id, silent_since) once nothing has been heard from an entity for so long; rows have id (long) and ts."""
    return rows.withWatermark("ts", late).groupBy("id").transformWithStateInPandas(
        _Silence(seconds), "id long, silent_since timestamp", "Append", "EventTime")


def _summaries(rows: DataFrame, size: int = SIZE) -> DataFrame:
    """(id, part, size, lead, trail, longest): the runs of failures of each piece of an id's rows, of so many rows at most."""
    found, _ = pieces(rows.select("id", "ts", "seq", F.coalesce("failed", F.lit(False)).alias("failed")), "id", ["ts", "seq"], runs_of, size)
    return found.select("id", F.col("_b").alias("part"), "s.*")


#: Batches after which the states of all ids are written anew, so that few folders are read for them.
COMPACT = 16


def consecutive_errors(rows: DataFrame, path: str, limit: int = 3) -> DataFrame:
    """Drives a stream of (id, ts, seq, failed) over all there is: (id, run, blocked) of every id. Rows of a later batch count as later.

    A batch's runs are summed up in pieces and merged (folds.py), and joined to the runs that the batches before left. The rows of
    the ids that changed are committed under the batch's number, so a batch that is run again changes nothing.
    """
    table = StoredTable(rows.sparkSession, f"{path}/states")

    def write(part: DataFrame, batch: int) -> None:
        failed = part.select("id", "ts", "seq", F.coalesce("failed", F.lit(False)).alias("failed"))

        def after(now: DataFrame | None) -> DataFrame:
            new = fold(failed, "id", ["ts", "seq"], runs_of, merged_runs)
            old = new.select("id").limit(0).withColumns({"run": F.lit(0).cast("long"), "blocked": F.lit(False)}) if now is None else latest(now, ["id"])
            old = old.select(F.col("id").alias("_id"), "run", "blocked")
            run, was = F.coalesce("run", F.lit(0)), F.coalesce("blocked", F.lit(False))
            s = F.col("s")
            changed = new.join(old, F.col("id").eqNullSafe(F.col("_id")), "left").select(
                "id", F.when(s["trail"] == s["size"], run + s["size"]).otherwise(s["trail"]).alias("run"),
                (was | (run + s["lead"] >= limit) | (s["longest"] >= limit)).alias("blocked"), F.lit(batch).cast("long").alias("batch"))
            if now is None or batch % COMPACT:
                return changed
            return latest(now.unionByName(changed), ["id"]).withColumn("batch", F.lit(batch).cast("long"))

        with cleared(rows.sparkSession):
            table.commit(after, keep=bool(batch % COMPACT), label=str(batch))

    _drive(rows, path, "append", write)
    return latest(table.read(), ["id"])


def run_once(df: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Drives a streaming frame over all there is and gives the rows, in a table under path. A batch's rows carry its number, ``batch``.

    A batch is committed under its number, so one that is run again after a lost driver is not written twice.
    """
    table = StoredTable(df.sparkSession, f"{path}/rows")
    _drive(df, path, mode, lambda part, batch: table.append(part.withColumn("batch", F.lit(batch).cast("long")), label=str(batch)))
    return table.read()


def _drive(df: DataFrame, path: str, mode: str, write: Callable[[DataFrame, int], object]) -> None:
    spark = df.sparkSession
    store = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(store, None)
    spark.conf.set(store, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")  # keeps state off the heap; timers need it
    try:
        df.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).foreachBatch(lambda part, batch: write(part, batch) and None).start().awaitTermination()
    finally:
        spark.conf.unset(store) if before is None else spark.conf.set(store, before)


def latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The last batch's row of each key of an update-mode table."""
    rest = [c for c in rows.columns if c not in keys and c != "batch"]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("x")).select(*keys, "x.*")

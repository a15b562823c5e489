"""States, tasks and leases as tables: each operator gives the new snapshot or the rows in question."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vetrina.operators.folds import fold, merged_runs, merged_updates, runs_of, update, updates_of

#: Legal transitions of a key, the rollback and the reset of an expired one among them; final states.
EDGES = (("NEW", "CATALOG_PARSING"), ("CATALOG_PARSING", "CATALOG_PARSED"), ("CATALOG_PARSED", "VALIDATING"), ("VALIDATING", "VALIDATED"),
         ("VALIDATED", "OBJECT_PARSING"), ("VALIDATING", "REJECTED_BY_MIN_COUNT"), ("VALIDATING", "CATALOG_PARSED"), ("CATALOG_PARSING", "NEW"))
FINAL = ("OBJECT_PARSING", "REJECTED_BY_MIN_COUNT")


#: Requests of a piece of guarded_updates().
UPDATES = 128


def transition_audit(events: DataFrame, edges: tuple = EDGES, final: tuple = FINAL) -> DataFrame:
    """(id, ts, source, target, verdict) of each change of state in (id, ts, seq, state) events."""
    w = Window.partitionBy("id").orderBy("ts", "seq")
    moves = events.select("id", "ts", F.lag("state").over(w).alias("source"), F.col("state").alias("target")).where("source is not null and source <> target")
    legal = events.sparkSession.createDataFrame(list(edges), "source string, target string").withColumn("ok", F.lit(True))
    return moves.join(F.broadcast(legal), ["source", "target"], "left").select(
        "id", "ts", "source", "target", F.when(F.col("ok"), "legal").when(F.col("source").isin(*final), "from_final").otherwise("illegal").alias("verdict"))


def latest_state(events: DataFrame) -> DataFrame:
    return events.groupBy("id").agg(F.max_by("state", F.struct("ts", "seq")).alias("state"))


def guarded_updates(snapshot: DataFrame, requests: DataFrame, order: tuple[str, ...] = ()) -> DataFrame:
    """(id, value, applied, skipped): the snapshot (id, value) after all requests (id, expected, new, and order), and their counts.

    The requests for an id come one after the other in the order given, each guarded by the state that the one before left: it
    is applied if the state is the one expected. A null equals no state, and a request may set one. Requests that tie come by
    expected and new. Requests are folded in pieces (folds.py), which have an entry for each state that is expected, so a
    key may have any number of requests.
    """
    asked = requests.select("id", "expected", "new", *order)
    moves = fold(asked, "id", list(order), updates_of, merged_updates, UPDATES).select(F.col("id").alias("_id"), F.col("s").alias("_moves"))
    n = asked.groupBy(F.col("id").alias("_rid")).agg(F.count("*").alias("_n"))
    rows = snapshot.join(moves, F.col("id").eqNullSafe(F.col("_id")), "left").join(n, F.col("id").eqNullSafe(F.col("_rid")), "left").withColumn("_after", update(F.col("value"), F.col("_moves")))
    return rows.select("id", F.col("_after.v").alias("value"), F.col("_after.n").alias("applied"), (F.coalesce("_n", F.lit(0)) - F.col("_after.n")).alias("skipped"))


def guarded_update(snapshot: DataFrame, requests: DataFrame, order: tuple[str, ...] = ()) -> DataFrame:
    """(id, value, applied): as guarded_updates(); whether any request was applied, null without a request."""
    some = F.col("applied") + F.col("skipped") > 0
    return guarded_updates(snapshot, requests, order).select("id", "value", F.when(some, F.col("applied") > 0).alias("applied"))


def update_counts(after: DataFrame) -> DataFrame:
    """One row: requests of guarded_update() that were applied, and those skipped as the state was another."""
    return after.agg(F.count_if("applied").alias("applied"), F.count_if(~F.col("applied")).alias("skipped"))


def oldest_pending(tasks: DataFrame, parents: DataFrame, n: int) -> DataFrame:
    return tasks.where("status = 'pending'").join(parents, "key", "left_semi").orderBy("heartbeat_at", "task_id").limit(n)


def expired(tasks: DataFrame, as_of: str, seconds: int) -> DataFrame:
    return tasks.where((F.col("status") == "processing") & (F.col("heartbeat_at") < F.lit(as_of).cast("timestamp_ntz") - F.expr(f"interval {seconds} seconds")))


def orphaned(parents: DataFrame, tasks: DataFrame) -> DataFrame:
    """Parents in progress that have a pending task."""
    return parents.join(tasks.where("status = 'pending'"), "key", "left_semi")


def cascade_delete(keys: DataFrame, tables: dict[str, tuple[DataFrame, str]]) -> dict[str, DataFrame]:
    """What remains of each dependent table."""
    return {name: df.join(keys.select(F.col("key").alias(col)), col, "left_anti") for name, (df, col) in tables.items()}


def reset_keys(keys: DataFrame, wanted: DataFrame, state: str = "NEW") -> DataFrame:
    """(key, state) of all keys: wanted ones are reset, or inserted."""
    w = wanted.select("key").distinct()
    return keys.join(w, "key", "left_anti").select("key", "state").unionByName(w.withColumn("state", F.lit(state)))


def rollback(keys: DataFrame, verdicts: DataFrame, wanted: DataFrame, source: str, target: str) -> tuple[DataFrame, DataFrame]:
    """(keys, verdicts) after wanted keys in the source state went back to the target and lost their verdicts."""
    back = keys.where(F.col("state") == source).join(wanted, "key", "left_semi").select("key", F.lit(True).alias("b"))
    moved = keys.join(back, "key", "left").select("key", F.when(F.col("b"), target).otherwise(F.col("state")).alias("state"))
    return moved, verdicts.join(back, "key", "left_anti")


def consecutive_errors(events: DataFrame, limit: int = 3) -> DataFrame:
    """(id, run, blocked) of (id, ts, seq, failed) events: the present run of failures, and whether any run reached the limit.

    Runs are summed up in pieces and merged (folds.py); an event that neither failed nor succeeded counts as none.
    """
    rows = events.select("id", "ts", "seq", "failed")
    return fold(rows, "id", ["ts", "seq"], runs_of, merged_runs).select("id", F.col("s.trail").alias("run"), (F.col("s.longest") >= limit).alias("blocked"))


def retry_counter(events: DataFrame) -> DataFrame:
    return events.groupBy("id").agg(F.count_if("failed").alias("retries"))


def latest_progress(events: DataFrame) -> DataFrame:
    """(task_id, page, heartbeat_at): the last checkpoint and heartbeat of each task's log."""
    return events.groupBy("task_id").agg(F.max_by("page", F.struct("ts", "seq")).alias("page"), F.max("ts").alias("heartbeat_at"))


def task_seed(keys: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """A pending task for each NEW key; with existing tasks, only for keys that have none."""
    new = keys.where("state = 'NEW'").select("key")
    if existing is not None:
        new = new.join(existing, "key", "left_anti")
    return new.select("key", F.lit("pending").alias("status"), F.lit(1).alias("checkpoint"), F.lit(0).alias("retry_count"))

"""Job state as data: claims, outcomes, repair, progress. States: NULL, -1 to 4 (functions.residues.STATES).

Parquet has no row updates, so each operator returns the rows as they are afterwards, or the events to append;
``latest`` folds an event log into the current state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def id_range(portion: tuple[float, float], total: int) -> tuple[int, int]:
    """[first, after) of dense ids from 1 for a share of the list; clamped to it."""
    low, high = (min(max(p, 0.0), 1.0) for p in portion)
    first, after = int(total * low) + 1, int(total * high) + 1
    return min(first, total + 1), max(min(after, total + 1), min(first, total + 1))


def claimable(jobs: DataFrame, null_too: bool) -> DataFrame:
    free = F.col("status").isin(-1, 2)
    return jobs.where((free | F.col("status").isNull() if null_too else free) & F.col("claimed_at").isNull())


def claim(jobs: DataFrame, n: int, job_id: str, at: float, null_too: bool = False) -> DataFrame:
    """The n first claimable rows as RUNNING (from null or NOOPT) or RETRYING (from PENDING), with owner and time."""
    took = claimable(jobs, null_too).orderBy("id").limit(n)
    status = F.when(F.coalesce("status", F.lit(-1)) == -1, 1).otherwise(F.col("status") + 1)
    return took.withColumn("status", status.cast("int")).withColumn("job_id", F.lit(job_id)).withColumn("claimed_at", F.lit(at))


def succeeded(jobs: DataFrame) -> DataFrame:
    return jobs.withColumn("status", F.lit(0)).withColumn("job_id", F.lit(None).cast("string")).withColumn("claimed_at", F.lit(None).cast("double"))


def failed(jobs: DataFrame) -> DataFrame:
    """RUNNING becomes PENDING, RETRYING becomes FAILED: two attempts."""
    return jobs.withColumn("status", F.least(F.col("status") + 1, F.lit(4))).withColumn("job_id", F.lit(None).cast("string")).withColumn("claimed_at", F.lit(None).cast("double"))


def repair(jobs: DataFrame, alive: DataFrame) -> DataFrame:
    """Rows whose owner is not alive: RETRYING goes back to PENDING, RUNNING to NOOPT."""
    lost = jobs.where("status IN (1, 3)").join(alive.select("job_id"), "job_id", "left_anti")
    back = F.when(F.col("status") == 3, 2).otherwise(-1)
    return lost.select(*[back.cast("int").alias(c) if c == "status" else F.lit(None).cast(t).alias(c) if c in ("job_id", "claimed_at") else F.col(c) for c, t in jobs.dtypes])


def workable(jobs: DataFrame) -> DataFrame:
    """Rows neither done nor given up; a null state counts as workable."""
    return jobs.where(F.col("status").isNull() | ~F.col("status").isin(0, 4))


def is_complete(jobs: DataFrame) -> bool:
    return workable(jobs).isEmpty()


def scheduler_state(column: str = "state"):
    """The first word of a scheduler's state, without the sign that marks it as cut."""
    return F.regexp_replace(F.element_at(F.split(F.trim(F.col(column)), " "), 1), r"\+$", "")


def submitted_id(output: str = "output"):
    """The job number in a scheduler's answer: its last word, if that is digits, else null."""
    last = F.element_at(F.split(F.regexp_replace(F.col(output), r"\s+$", ""), r"\s+"), -1)
    return F.when(last.rlike("^[0-9]+$"), last)


def sync_states(runs: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows of runs (job_id, status) whose scheduler state (job_id, state) differs from the known one, with the new one."""
    return runs.join(seen.select("job_id", scheduler_state().alias("_s")), "job_id").where(~F.col("status").eqNullSafe(F.col("_s"))).withColumn("status", F.col("_s")).drop("_s")


#: Scheduler states of runs that may still work, and of those that ended well.
ALIVE, WELL = ("PENDING", "RUNNING", "CONFIGURING", "COMPLETING", "SUSPENDED"), ("COMPLETED",)


def sync_tasks(tasks: DataFrame, runs: DataFrame, seen: DataFrame) -> DataFrame:
    """The tasks to write back after a look at the scheduler: those that a run owned which has just ended badly and which
    are not done, as after a failure."""
    bad = sync_states(runs, seen).where(~F.col("status").isin(*ALIVE, *WELL)).select("job_id").distinct()
    owned = tasks.where("status IN (1, 3)").join(bad, "job_id", "left_semi")
    return failed(owned).select(*tasks.columns)


def done(jobs: DataFrame) -> DataFrame:
    return jobs.where("status = 0")


def counts(jobs: DataFrame) -> DataFrame:
    """One row (n, max_id, n_done); the largest id of an empty table is 0."""
    return jobs.agg(F.count("*").alias("n"), F.coalesce(F.max("id"), F.lit(0)).cast("long").alias("max_id"), F.count_if(F.col("status") == 0).alias("n_done"))


def with_lengths(pairs: DataFrame, alignments: DataFrame) -> DataFrame:
    """pairs (pid1, pid2) with length1, length2 and length, their sum, from alignments (pid, length); null where unknown."""
    side = lambda k: alignments.select(F.col("pid").alias(f"pid{k}"), F.col("length").alias(f"length{k}"))
    both = pairs.join(side(1), "pid1", "left").join(side(2), "pid2", "left")
    return both.withColumn("length", F.col("length1") + F.col("length2"))


def ensure_columns(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """rows with the missing ones of the named columns (name to type) added as nulls."""
    return rows.select("*", *[F.lit(None).cast(t).alias(c) for c, t in columns.items() if c not in rows.columns])


def runs_to_submit(active: int, maximum: int, left: int) -> int:
    """How many runs to submit anew: up to the maximum, none without work."""
    return max(0, min(maximum - active, left))


def cron_lines(table: str, command: str, schedule: str | None) -> str:
    """A cron table in which the command stands once, with that schedule, or not at all if it is None."""
    lines = [x for x in table.splitlines() if x.strip() and not x.endswith(f" {command}")]
    return "".join(f"{x}\n" for x in lines + ([f"{schedule} {command}"] if schedule else []))


def priorities(pairs: DataFrame) -> DataFrame:
    """pairs (id) with a priority that falls with the id, so that earlier pairs end first."""
    return pairs.withColumn("priority", -F.col("id"))


def insert_absent(have: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows whose key is not there yet, one per key."""
    return new.dropDuplicates([key]).join(have.select(key), key, "left_anti")


def broken_references(rows: DataFrame, column: str, parents: DataFrame, key: str) -> DataFrame:
    return rows.where(F.col(column).isNotNull()).join(parents.select(F.col(key).alias(column)), column, "left_anti")


def latest(events: DataFrame, key: str, seq: str) -> DataFrame:
    """The last event per key; max_by pre-aggregates, so a busy key is no hot task."""
    names = [c for c in events.columns if c != key]
    return events.groupBy(key).agg(F.max_by(F.struct(*names), seq).alias("_e")).select(key, "_e.*")


def stalled(ticks: DataFrame, patience: int = 5) -> DataFrame:
    """(stage, tick, stall_ticks, gave_up) for progress rows (stage, tick, done_count): ticks in a row without growth."""
    by = Window.partitionBy("stage").orderBy("tick")
    grown = ticks.withColumn("_up", F.coalesce(F.col("done_count") > F.lag("done_count").over(by), F.lit(True)).cast("int"))
    run = grown.withColumn("_g", F.sum("_up").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    out = run.withColumn("stall_ticks", F.row_number().over(Window.partitionBy("stage", "_g").orderBy("tick")) - 1)
    return out.select("stage", "tick", "stall_ticks", (F.col("stall_ticks") >= patience).alias("gave_up"))


def all_failed(jobs: DataFrame, last: int) -> DataFrame:
    """One row (gave_up): the last jobs by number all failed."""
    recent = jobs.orderBy(F.col("job_id").try_cast("bigint").desc()).limit(last)
    return recent.agg(F.coalesce(F.bool_and(F.col("status") == "FAILED"), F.lit(False)).alias("gave_up"))

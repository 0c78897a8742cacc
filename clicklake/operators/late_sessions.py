"""Sessions kept up to date over windows of events, also when events come after their window.

The store holds fragments of events (per user, cell and page) and sessions. A run takes a window's events. Only users
it has events of are looked at, and of those only what the events can change: sessions that end more than a gap before
a user's first new event stand, the later ones are made anew from the fragments, and numbered on from those that stand.
Nothing is rewritten: new rows are appended with a mark (user, number) that says from which session on the older rows
no longer hold. Reading applies the marks in one sorted pass per user.

Late and timely events are the same here: after any number of windows the sessions are those of all events at once.
A run that is repeated replaces itself, but only the last run can be.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from clicklake.operators.joins import null_safe_join
from clicklake.operators.sessions import session_fragments, sessions_from_fragments
from clicklake.sources.files import settled
from clicklake.sources.runs import begin, read_runs

LAST = "last_ts"


def absorb(spark: SparkSession, store: str, events: DataFrame, run: str, user: str, ts: str, page: str, gap: timedelta) -> None:
    """Take the events of one window into the store."""
    attempt = begin(spark, store, run, only_last=True)
    fresh = settled(session_fragments(events, user, ts, page, gap).withColumn("day", F.to_date("first_ts")))
    touched = fresh.groupBy(user).agg(F.min("first_ts").alias("since"))
    known = current(spark, store, user, besides=run)
    if known is not None:
        # Per touched user the number of sessions that stand, and where what is made anew begins.
        stands = F.col(LAST) + F.lit(gap) < F.col("since")
        own = null_safe_join(touched, known, [user], "left")
        bounds = own.groupBy(user).agg(
            F.coalesce(F.max(F.when(stands, F.col("session_no"))) + 1, F.lit(0)).alias("from_no"),
            F.least(F.min("since"), F.min(F.when(~stands, F.col("session_min")))).alias("since"),
        )
    else:
        bounds = touched.withColumn("from_no", F.lit(0).cast("long"))
    bounds = settled(bounds)
    parts = fresh
    stored = read_runs(spark, store, "fragments", besides=run)
    first = bounds.agg(F.to_date(F.min("since"))).first()[0]
    if stored is not None and first is not None:
        # Days before the first one that changes are not read.
        again = null_safe_join(stored.where(F.col("day") >= F.lit(first)), bounds.select(user, "since"), [user])
        parts = parts.unionByName(again.where(F.col("first_ts") >= F.col("since")).select(fresh.columns))
    rebuilt = sessions_from_fragments(parts, user, page, gap, last=LAST)
    numbered = null_safe_join(rebuilt, bounds.select(user, "from_no"), [user]).withColumn("session_no", F.col("session_no") + F.col("from_no"))
    seq = F.lit(attempt.seq).cast("long")
    attempt.write(fresh, "fragments", ("day",))
    attempt.write(numbered.drop("from_no").withColumn("seq", seq), "sessions")
    attempt.write(bounds.select(user, "from_no").withColumn("seq", seq), "marks")
    attempt.commit(spark)


def current(spark: SparkSession, store: str, user: str, besides: str | None = None) -> DataFrame | None:
    """(user, session_no, session_min, session_max, last_ts) as of all runs; None before the first one."""
    rows, marks = (read_runs(spark, store, table, besides=besides) for table in ("sessions", "marks"))
    if rows is None or marks is None:
        return None
    both = rows.withColumn("_mark", F.lit(False)).unionByName(marks.withColumn("_mark", F.lit(True)), allowMissingColumns=True)
    later = Window.partitionBy(user).orderBy(F.desc("seq"), "_mark").rowsBetween(Window.unboundedPreceding, 0)
    held = both.withColumn("_until", F.min("from_no").over(later))
    return held.where(~F.col("_mark") & (F.col("_until").isNull() | (F.col("session_no") < F.col("_until")))).drop(
        "_mark", "_until", "from_no", "seq"
    )

"""Incremental fetch: a versioned log of rows per key, what a round admits to it, and the gate on stale keys.

A round looks at each key once: what the log holds (row count, last day), what
the source offers, and so whether nothing, only later rows or a whole new
history is taken.  A whole history voids what the log held of the key; rows
are only ever appended, and a round that admits nothing changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.tables import keep_last

#: Status errors, the file-level repair mark and the number of stale keys that a run may leave out.
INSUFFICIENT, MISSING_BAR, FETCH_FAILED, SCHEMA_MISMATCH = "insufficient_bars", "missing_bar_for_run_date", "fetch_failed", "schema_mismatch_missing_ohlcv:"
STALE_ALLOWED = 9


class StaleDataError(ValueError):
    """More keys are stale than a run may leave out."""


def status(n: Column, last: Column, required: int, run_date: str | None) -> Column:
    """ok, insufficient (too few rows) or stale (nothing of the run date); without a run date nothing is stale."""
    stale = F.lit(False) if run_date is None else last.isNull() | (last < F.lit(run_date).cast("date"))
    return F.when(n < required, "insufficient").when(stale, "stale").otherwise("ok")


def status_error(state: Column) -> Column:
    return F.when(state == "insufficient", INSUFFICIENT).when(state == "stale", MISSING_BAR)


def in_force(log: DataFrame, key: str, day: str) -> DataFrame:
    """Rows of a log that count: none before the key's last whole history, and the last version of each day.

    ``log`` has ``version`` and ``full`` (whether the version is a whole
    history of the key) beside the data.
    """
    base = log.where("full").groupBy(key).agg(F.max("version").alias("_base"))
    rows = log.join(base, key, "left").where("_base is null or version >= _base").drop("_base", "full")
    return keep_last(rows, [key, day], "version").select(*[c for c in log.columns if c not in ("version", "full")])


def absent(columns: list[str], prefix: str = "") -> Column:
    """Names of the columns without any value, joined by commas; null if there are none."""
    names = F.array_compact(F.array(*[F.when(F.col(f"{prefix}{c}") == 0, F.lit(c)) for c in columns]))
    return F.nullif(F.array_join(names, ","), F.lit(""))


def fetch_plan(held: DataFrame, offered: DataFrame, keys: DataFrame, key: str, day: str, required: int, run_date: str | None, needed: list[str]) -> DataFrame:
    """One row per key of ``keys``: what it holds, what is offered, and the action.

    ``none``: enough rows, up to the run date.  ``later``: only rows after the
    last one held.  ``whole``: too few rows, a needed column without values, or
    nothing later to be had.  ``failed``: a whole history, and none offered.
    """
    have = held.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.max(day).alias("last"), *[F.count(c).alias(f"has_{c}") for c in needed])
    marks = keys.select(key).distinct().join(have.select(key, "n", "last", absent(needed, "has_").alias("lacks")), key, "left")
    new = offered.join(marks.select(key, "last"), key)
    later = F.coalesce(F.col(day) > F.col("last"), F.lit(False))
    got = new.groupBy(key).agg(F.count(F.lit(1)).alias("n_all"), F.count_if(later).alias("n_later"), F.max(day).alias("newest"), *[F.count(c).alias(f"got_{c}") for c in needed])
    plan = marks.join(got, key, "left").na.fill(0, ["n_all", "n_later"])
    short = F.col("n").isNull() | (F.col("n") < required) | F.col("lacks").isNotNull()
    behind = F.lit(False) if run_date is None else F.col("last") < F.lit(run_date).cast("date")
    whole = F.when(F.col("n_all") > 0, "whole").otherwise("failed")
    action = F.when(short, whole).when(behind, F.when(F.col("n_later") > 0, "later").otherwise(whole)).otherwise("none")
    return plan.select(key, "n", "last", "lacks", "n_all", "n_later", "newest", F.when(F.col("n_all") > 0, absent(needed, "got_")).alias("lacks_after"), action.alias("action"))


def manifest(plan: DataFrame, key: str, required: int, run_date: str | None) -> DataFrame:
    """Rows held, status, error and newly fetched rows of each key after the round."""
    action = F.col("action")
    n = F.when(action == "whole", F.col("n_all")).when(action == "failed", 0).otherwise(F.col("n") + F.when(action == "later", F.col("n_later")).otherwise(0))
    last = F.when(action == "none", F.col("last")).otherwise(F.col("newest"))
    state = F.when(action == "failed", "failed").otherwise(status(n, last, required, run_date))
    mended = F.when(action == "whole", F.concat(F.lit(SCHEMA_MISMATCH), F.coalesce("lacks_after", "lacks")))
    error = F.when(action == "failed", FETCH_FAILED).when(state == "ok", mended).otherwise(status_error(state))
    fresh = F.when(action == "whole", F.col("n_all")).when(action == "later", F.col("n_later")).otherwise(0)
    return plan.select(key, F.lit(required).alias("requested_days"), n.cast("long").alias("fetched_bars"), state.alias("status"), error.alias("error"), fresh.cast("long").alias("newly_fetched_days"))


def fetch_round(log: DataFrame, source: DataFrame, keys: DataFrame, key: str, day: str, order: str, required: int, run_date: str | None, needed: list[str], version: int) -> tuple[DataFrame, DataFrame]:
    """Rows to append to ``log`` as ``version``, and the manifest after it.

    ``source`` may repeat days (the last by ``order`` counts) and bring late
    rows (before the last day held), which only a whole history takes; rows
    after the run date are not offered yet.
    """
    offered = source if run_date is None else source.where(F.col(day) <= F.lit(run_date).cast("date"))
    offered = keep_last(offered, [key, day], order).drop(order)
    plan = fetch_plan(in_force(log, key, day), offered, keys, key, day, required, run_date, needed)
    chosen = plan.where(F.col("action").isin("whole", "later")).select(key, "last", "action")
    taken = offered.join(chosen, key).where((F.col("action") == "whole") | (F.col(day) > F.col("last")))
    rows = taken.select(*[F.col(c) if c not in ("version", "full") else {"version": F.lit(version), "full": F.col("action") == "whole"}[c].alias(c) for c in log.columns])
    return rows, manifest(plan, key, required, run_date)


def stale_exclusions(manifest: DataFrame, key: str, run_date: str, allowed: int = STALE_ALLOWED) -> DataFrame:
    """Stale keys that the run of ``run_date`` leaves out; an error if there are more than ``allowed``."""
    stale = manifest.where(F.col("status") == "stale").select(key)
    some = [str(r[0]) for r in stale.limit(allowed + 1).collect()]
    if len(some) > allowed:
        raise StaleDataError(f"more than {allowed} keys have nothing of {run_date}, among them {sorted(some)[:10]}")
    return stale.select(F.lit(run_date).cast("date").alias("run_date"), F.trim(F.col(key).cast("string")).alias(key)).where(F.length(key) > 0)


def without_stale(rows: DataFrame, exclusions: DataFrame, key: str, run_date: str) -> DataFrame:
    """Rows whose key the exclusions of this very run date do not name; those of another run date do not count."""
    names = exclusions.where(F.col("run_date") == F.lit(run_date).cast("date")).select(F.col(key).alias("_out")).distinct()
    return rows.join(names, F.trim(F.col(key).cast("string")) == F.col("_out"), "left_anti")

"""Operational queries: run views, stale work, retention, queue eligibility, sweeps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def runs_by_day(runs: DataFrame) -> DataFrame:
    return runs.groupBy("workflow", "run_date", "status").agg(F.count(F.lit(1)).alias("run_count"), F.min("started_at").alias("first_started_at"), F.max("finished_at").alias("last_finished_at"))


def success_rates(runs: DataFrame, now: str, days: int = 30) -> DataFrame:
    """Per workflow counts by outcome in the last days and the success share of ended runs (null without any)."""
    recent = runs.where(F.col("started_at") >= F.lit(now).cast("timestamp") - F.make_dt_interval(F.lit(days)))
    ended = F.col("status").isin("success", "failed", "cancelled")
    agg = recent.groupBy("workflow").agg(
        F.count_if(F.col("status") == "success").alias("n_success"),
        F.count_if(F.col("status") == "failed").alias("n_failed"),
        F.count_if(F.col("status") == "cancelled").alias("n_cancelled"),
        F.count_if(ended).alias("n_terminal"),
        F.count_if(F.col("status").isin("pending", "running")).alias("n_open"),
    )
    return agg.withColumn("success_rate", F.round(F.col("n_success") / F.nullif("n_terminal", F.lit(0)), 4))


def stale_running(runs: DataFrame, workflows: list[str], before: str) -> DataFrame:
    return runs.where((F.col("status") == "running") & F.col("workflow").isin(*workflows) & (F.col("started_at") < F.lit(before).cast("timestamp")))


def claimable(outbox: DataFrame, now: str, limit: int) -> DataFrame:
    """Queue rows free to claim: pending or with an expired claim, attempts left, retry time come; oldest first."""
    t = F.lit(now).cast("timestamp")
    free = (F.col("status") == "pending") | ((F.col("status") == "claimed") & (F.col("visible_at") < t))
    return outbox.where(free & (F.col("attempts") < F.col("budget")) & (F.col("retry_at").isNull() | (F.col("retry_at") <= t))).orderBy("created_at", "id").limit(limit)


def retention(df: DataFrame, column: str, cutoff: Column) -> DataFrame:
    return df.where(F.col(column) >= cutoff)


def sweep_plan(objects: DataFrame) -> DataFrame:
    """Per generation: only orphans, orphans among others, or none."""
    orphan = F.col("status") == "orphan"
    agg = objects.groupBy("generation").agg(F.bool_and(orphan).alias("a"), F.bool_or(orphan).alias("o"))
    return agg.select("generation", F.when(F.col("a"), "orphan_only").when(F.col("o"), "mixed").otherwise("no_orphan").alias("plan"))


def history_quality(units: DataFrame, group: str, status: str = "status") -> DataFrame:
    """blocked beats partial beats full."""
    blocked, done = F.col(status) == "blocked", F.col(status).isin("committed", "noop")
    agg = units.groupBy(group).agg(F.bool_or(blocked).alias("b"), F.bool_or(done).alias("d"), F.bool_and(done).alias("f"))
    return agg.select(group, F.when(F.col("b") & F.col("d"), "partial_backfill").when(F.col("b"), "blocked_backfill").when(F.col("f"), "full").otherwise("partial").alias("quality"))


def pair_pointers(pointers: DataFrame, left: str, right: str) -> DataFrame:
    """Both benchmarks' newest pointer per date side by side, and whether the pair is complete."""
    agg = pointers.groupBy("date").agg(*[F.max_by("key", F.when(F.col("bench") == b, F.col("committed_at"))).alias(b) for b in (left, right)])
    return agg.withColumn("complete", F.col(left).isNotNull() & F.col(right).isNotNull())


def merge_aliases(existing: DataFrame, found: DataFrame) -> DataFrame:
    """Action per candidate alias: skip keys that are known or already added, review low confidence, add the rest.

    Candidates of a key are taken by confidence, then seen count, then alias
    (lower case): its first candidate above low is added and the other such
    ones skipped; a low one comes after them, so it is skipped where one was
    added, else reviewed, and never occupies the key.  The first is found by a
    pre-aggregated minimum and joined back, not by a window over the key.
    """
    known = existing.select("code", "dedup_key").distinct().withColumn("_known", F.lit(True))
    rank = F.when(F.col("confidence") == "high", 2).when(F.col("confidence") == "medium", 1).otherwise(0)
    rows = found.withColumn("_order", F.struct((-rank).alias("r"), (-F.col("seen_count")).alias("s"), F.lower("alias").alias("a"), F.col("ordinal").alias("o")))
    first = rows.where(F.col("confidence") != "low").groupBy("code", "dedup_key").agg(F.min("_order").alias("_first"))
    rows = rows.join(known, ["code", "dedup_key"], "left").join(first, ["code", "dedup_key"], "left")
    add = F.coalesce(F.col("_first") == F.col("_order"), F.lit(False))
    action = F.when(F.col("_known"), "skip").when(add, "add").when(F.col("_first").isNotNull(), "skip").otherwise("review")
    return rows.withColumn("action", action).drop("_known", "_order", "_first")


def stale_generations(generations: DataFrame, before: str) -> DataFrame:
    """Pending generations without a heartbeat since ``before``."""
    t = F.lit(before).cast("timestamp")
    return generations.where((F.col("status") == "pending") & (F.col("heartbeat_at").isNull() | (F.col("heartbeat_at") < t)))


def high_water(progress: DataFrame, key: str, last: str, day: str) -> DataFrame:
    """Per key the mark after a commit of ``day``: never back, and from the day before where there was none."""
    return progress.groupBy(key).agg(F.greatest(F.coalesce(F.max(last), F.date_sub(F.max(day), 1)), F.max(day)).alias("mark"))


def without_leases(work: DataFrame, leases: DataFrame, key: str, owners: list[str], now: str) -> DataFrame:
    """Work whose key no active lease of the given owner kinds holds."""
    held = leases.where(F.col("owner").isin(*owners) & (F.col("expires_at") > F.lit(now).cast("timestamp"))).select(key).distinct()
    return work.join(held, key, "left_anti")


def resolve_unique(objects: DataFrame, by: list[str], value: str) -> DataFrame:
    """The one value of each key; an ambiguous key resolves to null."""
    agg = objects.groupBy(*by).agg(F.count_distinct(value).alias("n"), F.min(value).alias("v"))
    return agg.select(*by, F.when(F.col("n") == 1, F.col("v")).alias(value))


def covering_runs(runs: DataFrame, day_start: str, skew_minutes: int) -> DataFrame:
    """Newest run per workflow that started from the skew before the day's start to its end."""
    start = F.lit(day_start).cast("timestamp")
    inside = (F.col("started_at") >= start - F.make_dt_interval(mins=F.lit(skew_minutes))) & (F.col("started_at") < start + F.make_dt_interval(F.lit(1)))
    return runs.where(inside).groupBy("workflow").agg(F.max_by("id", F.struct("started_at", "id")).alias("id"))


def first_source(candidates: DataFrame, key: str, source: str, order: list[str], newest: str) -> DataFrame:
    """Per key the newest candidate of the first source that has any."""
    place = F.array_position(F.array(*[F.lit(o) for o in order]), F.col(source)).cast("int")
    rows = candidates.withColumn("_p", place).where("_p > 0")
    cols = [c for c in candidates.columns if c != key]
    return rows.groupBy(key).agg(F.min_by(F.struct(*cols), F.struct("_p", (-F.col(newest)).alias("n"))).alias("_r")).select(key, "_r.*")


def dictionary_state(previous: DataFrame, found: DataFrame, keys: list[str], today: str) -> DataFrame:
    """Upserts seen counts: first seen stays, last seen and counts follow the new findings."""
    new = found.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set("source")).alias("new_sources"))
    rows = previous.join(new, keys, "full_outer")
    return rows.select(
        *keys,
        F.coalesce("first_seen", F.lit(today).cast("date")).alias("first_seen"),
        F.when(F.col("n").isNotNull(), F.lit(today).cast("date")).otherwise(F.col("last_seen")).alias("last_seen"),
        (F.coalesce("seen_count", F.lit(0)) + F.coalesce("n", F.lit(0))).alias("seen_count"),
        F.array_sort(F.array_union(F.coalesce("sources", F.array().cast("array<string>")), F.coalesce("new_sources", F.array().cast("array<string>")))).alias("sources"),
    )


def allowed_keys(rows: DataFrame, key: str, ref: str, allowed: list[str]) -> DataFrame:
    """Keys whose reference is allowed; an empty list allows all. Blank keys go."""
    kept = rows.where(F.length(F.coalesce(F.col(key), F.lit(""))) > 0)
    return (kept.where(F.coalesce(F.col(ref), F.lit("")).isin(allowed)) if allowed else kept).select(key)


def union_favourites(lists: DataFrame, key: str, codes: str) -> DataFrame:
    """All codes of all lists of an owner, once, in order; built from distinct codes, so a repeated code moves once a task."""
    each = lists.select(key, F.explode(codes).alias("_c")).where("_c is not null").distinct()
    return each.groupBy(key).agg(F.array_sort(F.collect_list("_c")).alias(codes))


def favourites(lists: DataFrame, key: str, codes: str, cap: int) -> DataFrame:
    """Per owner the distinct codes in first-seen order, at most ``cap`` of them (the cap is the list's own limit)."""
    return lists.select(key, F.slice(F.array_distinct(codes), 1, cap).alias(codes))

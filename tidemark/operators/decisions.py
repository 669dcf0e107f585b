"""Decision tables: rules with wildcards, of which the most specific that fits decides."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most rules of a table: they are broadcast, and their number is checked.
MOST_RULES = 100_000
ANY = "*"


class UncoveredError(ValueError):
    """An input that no rule fits."""


def rule_table(spark: SparkSession, inputs: list[str], outcome: str, rules: list[tuple]) -> DataFrame:
    """Rules as a table: one text per input (``*``: any), the outcome, and ``rule`` (their order)."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MOST_RULES}")
    return spark.createDataFrame([(*map(str, r), i) for i, r in enumerate(rules)], ", ".join(f"{c} string" for c in [*inputs, outcome]) + ", rule int")


def decide(rows: DataFrame, rules: DataFrame, inputs: list[str], outcome: str, strict: bool = True) -> DataFrame:
    """``rows`` with the outcome and ``rule`` of the most specific rule that fits; of equally specific ones the first.

    Rules that bind the same inputs are one equi-join, so there is a hash join
    for each pattern of wildcards and never a comparison of every row with
    every rule.  Inputs compare as trimmed lower-case texts; a null input fits
    wildcards only.  ``strict``: a row that no rule fits is an error when it
    is reached; else its outcome is null.
    """
    clash = {outcome, "rule"} & set(rows.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are there already")
    found = [r.asDict() for r in rules.limit(MOST_RULES + 1).collect()]
    if len(found) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    masks: dict[tuple[str, ...], dict[tuple, tuple]] = {}
    for r in sorted(found, key=lambda r: r["rule"]):
        bound = tuple(c for c in inputs if r[c] != ANY)
        masks.setdefault(bound, {}).setdefault(tuple(r[c].strip().lower() for c in bound), (r[outcome], r["rule"]))
    spark, out = rows.sparkSession, rows.withColumns({f"_in_{c}": F.lower(F.trim(F.col(c).cast("string"))) for c in inputs})
    for i, (bound, table) in enumerate(masks.items()):
        if not bound:
            value, number = next(iter(table.values()))
            out = out.withColumn(f"_hit{i}", F.struct(F.lit(0).alias("s"), F.lit(-number).alias("r"), F.lit(value).alias("o")))
            continue
        names = [f"_in_{c}" for c in bound]
        side = spark.createDataFrame([(*k, len(bound), -n, v) for k, (v, n) in table.items()], ", ".join(f"`{n}` string" for n in names) + ", s int, r int, o string")
        side = side.select(*names, F.struct("s", "r", "o").alias(f"_hit{i}"))
        out = out.join(F.broadcast(side), names, "left")
    hits = [F.col(f"_hit{i}") for i in range(len(masks))]
    best = F.array_max(F.array_compact(F.array(*hits))) if hits else F.lit(None).cast("struct<s:int,r:int,o:string>")
    out = out.withColumn("_best", best)
    value = F.col("_best.o")
    if strict:
        said = F.concat(F.lit("no rule fits "), *[x for c in inputs for x in (F.lit(f" {c}="), F.coalesce(f"_in_{c}", F.lit("null")))])
        value = F.when(F.col("_best").isNull(), F.raise_error(said).cast("string")).otherwise(value)
    return out.select(*[F.col(c) for c in rows.columns], value.alias(outcome), (-F.col("_best.r")).alias("rule"))


# Stages and modes of a staged roll-out, as rules over (stage, mode[, artifact, status]).

STAGES = ("off", "4.5a", "4.5b", "4.5c")
MODES = ("normal", "backfill", "replay", "reconcile", "series_seed", "series_repair")
PREFLIGHT = [
    ("off", "*", "skip0"), ("4.5a", "replay", "skip0"), ("4.5b", "replay", "skip0"), ("4.5c", "replay", "skip0"),
    ("4.5a", "series_seed", "exit2"), ("4.5b", "series_seed", "exit2"), ("4.5a", "series_repair", "exit2"), ("4.5b", "series_repair", "exit2"),
    ("4.5a", "reconcile", "exit2"), ("4.5b", "reconcile", "exit2"), ("*", "*", "continue"),
]
#: (stage, mode, whether a version is named, whether one is active) -> how the version is found.
RESOLUTION = [
    ("off", "*", "*", "*", "skip0"), ("*", "replay", "*", "*", "no_resolve_replay"), ("off", "replay", "*", "*", "skip0"),
    *[(s, m, "true", "*", "use_uuid") for s in STAGES[1:] for m in MODES if m != "replay"],
    ("*", "backfill", "false", "*", "flag_required"), ("off", "backfill", "false", "*", "skip0"),
    ("4.5a", "normal", "false", "*", "flag_required"), ("4.5b", "normal", "false", "*", "flag_required"),
    *[("4.5c", m, "false", a, r) for m in ("normal", "series_seed", "series_repair") for a, r in (("true", "resolve_active"), ("false", "exit2"))],
    *[(s, m, "false", "*", "exit2") for s in ("4.5a", "4.5b") for m in ("series_seed", "series_repair", "reconcile")],
    ("4.5c", "reconcile", "false", "*", "flag_must_match_active"),
]
#: (stage, mode, artifact, status of the version) -> whether it may be written; "shadow" and "active" only where the pointer agrees.
WRITES = [
    ("*", "*", "*", "*", "false"),
    *[("4.5c", m, a, "active", "true") for m in ("series_seed", "series_repair") for a in ("series", "generation_index")],
    *[(s, "backfill", a, "shadow", "true") for s in STAGES[1:] for a in ("snapshot", "generation_index")],
    *[(s, "backfill", "series", "shadow", "true") for s in ("4.5b", "4.5c")],
    *[("4.5c", "reconcile", a, "active", "true") for a in ("latest", "snapshot", "series", "generation_index")],
    *[("4.5a", "normal", a, "shadow", "true") for a in ("snapshot", "generation_index")],
    *[("4.5b", "normal", a, "shadow", "true") for a in ("snapshot", "series", "generation_index")],
    ("4.5c", "normal", "*", "active", "true"),
]
#: (stage, mode, whether the trade date is the latest one) -> which objects a generation has.
PROFILES = [
    ("*", "series_seed", "*", "series_only"), ("*", "series_repair", "*", "series_only"),
    ("*", "reconcile", "true", "snapshot_series_latest"), ("*", "reconcile", "false", "snapshot_series"),
    ("*", "backfill", "*", "snapshot_series"), ("4.5a", "backfill", "*", "snapshot_only"),
    *[(s, m, "*", p) for s, p in (("4.5a", "snapshot_only"), ("4.5b", "snapshot_series"), ("4.5c", "snapshot_series_latest")) for m in ("normal", "replay")],
]

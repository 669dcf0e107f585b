"""A catalogue of constraints, compiled to one pass over a table for all checks and one grouped pass for all keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """Every row must not make ``condition`` (SQL) false; null passes, as in SQL."""

    name: str
    condition: str


@dataclass(frozen=True)
class Unique:
    """Rows that meet ``where`` (SQL) have different ``keys``; a key with a null is different from every other."""

    name: str
    keys: tuple[str, ...]
    where: str = "true"


@dataclass(frozen=True)
class Reference:
    """``columns``, unless one is null, occur as ``target`` columns of another table."""

    name: str
    columns: tuple[str, ...]
    target: DataFrame
    target_columns: tuple[str, ...]


def fails(check: Check) -> Column:
    return ~F.coalesce(F.expr(check.condition).cast("boolean"), F.lit(True))


def broken_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """``rule, n_rows`` of the checks that rows fail: one aggregate over one scan, whatever their number."""
    counts = df.agg(*[F.count_if(fails(c)).alias(f"_{i}") for i, c in enumerate(checks)])
    pairs = F.explode(F.array(*[F.struct(F.lit(c.name).alias("rule"), F.col(f"_{i}").alias("n_rows")) for i, c in enumerate(checks)]))
    return counts.select(pairs.alias("r")).select("r.*").where("n_rows > 0")


def broken_keys(df: DataFrame, rules: list[Unique]) -> DataFrame:
    """``rule, n_rows, n_keys`` of repeated keys: each row gives an entry per rule it falls under, and one grouped pass counts them all."""
    entries = []
    for r in rules:
        whole = F.expr(r.where).cast("boolean")
        for k in r.keys:
            whole = whole & F.col(k).isNotNull()
        parts = [F.concat(F.length(F.col(k).cast("string")).cast("string"), F.lit(":"), F.col(k).cast("string")) for k in r.keys]
        entries.append(F.when(whole, F.struct(F.lit(r.name).alias("rule"), F.concat(*parts).alias("key"))))
    keyed = df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")
    twice = keyed.groupBy("rule", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return twice.groupBy("rule").agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"))


def broken_references(df: DataFrame, rules: list[Reference]) -> DataFrame | None:
    """``rule, n_rows, n_keys`` of keys without a target: keys are counted first, so a hot key joins once."""
    out = None
    for r in rules:
        names = [f"_{i}" for i in range(len(r.columns))]
        have = df.select(*[F.col(c).alias(n) for c, n in zip(r.columns, names)]).where(" and ".join(f"{n} is not null" for n in names)).groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
        lost = have.join(r.target.select(*[F.col(c).alias(n) for c, n in zip(r.target_columns, names)]).distinct(), names, "left_anti")
        one = lost.agg(F.lit(r.name).alias("rule"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_keys")).where("n_rows > 0")
        out = one if out is None else out.unionByName(one)
    return out


def violations(df: DataFrame, catalogue: list) -> DataFrame:
    """One row per violated rule: ``rule, kind, n_rows`` and, for keys, ``n_keys``. An empty result: the table holds to its catalogue."""
    checks, keys, refs = ([r for r in catalogue if isinstance(r, t)] for t in (Check, Unique, Reference))
    parts = []
    if checks:
        parts.append(broken_checks(df, checks).select("rule", F.lit("check").alias("kind"), "n_rows", F.lit(None).cast("long").alias("n_keys")))
    if keys:
        parts.append(broken_keys(df, keys).select("rule", F.lit("unique").alias("kind"), "n_rows", "n_keys"))
    if refs:
        parts.append(broken_references(df, refs).select("rule", F.lit("reference").alias("kind"), "n_rows", "n_keys"))
    if not parts:
        raise ValueError("an empty catalogue")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def broken_rules(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Rows that fail a check, with the names of all that they fail in ``broken``."""
    named = F.array_compact(F.array(*[F.when(fails(c), F.lit(c.name)) for c in checks]))
    return df.withColumn("broken", named).where(F.size("broken") > 0)


def observed(df: DataFrame, checks: list[Check], name: str = "checks") -> tuple[DataFrame, Observation]:
    """``df`` and counts of failing rows by check, taken while ``df`` is written: no pass of their own."""
    seen = Observation(name)
    return df.observe(seen, *[F.count_if(fails(c)).alias(c.name) for c in checks]), seen

"""Metric sets: a catalogue of typed metrics, compiled to one checked projection, and its fingerprint."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import metric_code, nfc
from tidemark.operators.derived import classify_int
from tidemark.operators.rules import exact_decimal

TYPES = {"float": "double", "int": "bigint", "bool": "boolean", "string": "string"}
#: Most metrics of a set: it is a list on the driver.
MOST_MEMBERS = 10_000


class CatalogueError(ValueError):
    """A table that does not hold to its catalogue, or a catalogue that is none."""


@dataclass(frozen=True)
class Metric:
    key: str
    kind: str


def members(catalogue: DataFrame | list[dict]) -> list[Metric]:
    """The metrics of a set in order: of ``metric_key, value_type`` and, in a table, ``position``; each key once, each type known."""
    if isinstance(catalogue, DataFrame):
        rows = [r.asDict() for r in catalogue.select("metric_key", "value_type", "position").orderBy("position", "metric_key").limit(MOST_MEMBERS + 1).collect()]
    else:
        rows = list(catalogue)
    if len(rows) > MOST_MEMBERS:
        raise CatalogueError(f"more than {MOST_MEMBERS} metrics")
    out = [Metric(str(r["metric_key"]), str(r["value_type"])) for r in rows]
    twice = sorted({m.key for m in out if sum(x.key == m.key for x in out) > 1})
    odd = sorted({m.kind for m in out} - TYPES.keys())
    if twice or odd:
        raise CatalogueError(f"metrics named twice {twice}, types unknown {odd}")
    return out


def canonical_json(payload: dict) -> str:
    """Compact JSON with sorted keys; NaN and infinities are errors."""
    return json.dumps(payload, ensure_ascii=False, separators=(",", ":"), sort_keys=True, allow_nan=False)


def set_fingerprint(family: str, definitions: list[dict]) -> str:
    """SHA-256 of a set: its family and its members' definitions, in order."""
    return hashlib.sha256(canonical_json({"set_family": family, "members": definitions}).encode()).hexdigest()


def typed(c: Column, have: str, kind: str) -> tuple[Column, Column, Column]:
    """Value in the metric's type, whether it is missing, and whether it is a number that is not finite.

    Floats are the nearest to their canonical text of ten places, so that what
    is stored and what is digested are one number; strings are NFC.
    """
    if kind == "float":
        x = c.try_cast("double") if have == "string" else c.cast("double")
        off = F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(False))
        return exact_decimal(F.when(~off, x)).cast("double"), x.isNull(), off
    if kind == "int":
        return classify_int(c, have)
    value = nfc(c.cast("string")) if kind == "string" else c.try_cast("boolean") if have == "string" else c.cast("boolean")
    return value, value.isNull(), F.lit(False)


def snapshot(df: DataFrame, catalogue: DataFrame | list[dict], code: str = "code") -> DataFrame:
    """``instrument_code``, the set's metrics in catalogue order with its types, and ``_flags`` that name what is missing or not finite, in that order.

    A column of the set that the table lacks is an error, and so is a missing
    code column; other columns do not count.  One projection, whatever the
    number of metrics.
    """
    metrics = members(catalogue)
    lacking = [m.key for m in metrics if m.key not in df.columns]
    if code not in df.columns or lacking:
        raise CatalogueError(f"columns missing: {[code] if code not in df.columns else []}{lacking}")
    kinds = dict(df.dtypes)
    parts = {m.key: typed(F.col(m.key), kinds[m.key], m.kind) for m in metrics}
    named = lambda i: F.array_compact(F.array(*[F.when(parts[m.key][i], F.lit(m.key)) for m in metrics]).cast("array<string>"))
    flags = F.struct(named(1).alias("missing_metrics"), named(2).alias("non_finite_metrics"))
    return df.select(metric_code(F.col(code).cast("string")).alias("instrument_code"), *[parts[m.key][0].cast(TYPES[m.kind]).alias(m.key) for m in metrics], flags.alias("_flags"))


def snapshot_json(rows: DataFrame, catalogue: DataFrame | list[dict]) -> DataFrame:
    """``instrument_code, values_json``: each instrument's metrics as an object in catalogue order, nulls written."""
    keys = [m.key for m in members(catalogue)]
    return rows.select("instrument_code", F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias("values_json"))

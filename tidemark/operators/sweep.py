"""Orphan sweep: objects that no live row names, in pages with a continuation mark, so that runs of bounded work reach every key."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Page:
    """Keys to delete in this run, in key order, and the mark to go on from (None: the end is reached)."""

    plan: DataFrame
    mark: str | None


def orphans(objects: DataFrame, live: DataFrame, key: str, older_than: str | None = None, age: str = "created_at") -> DataFrame:
    """Objects whose key no live row names and that are older than a cutoff; null keys are no objects."""
    rows = objects.where(F.col(key).isNotNull())
    if older_than is not None:
        rows = rows.where(F.col(age) < F.lit(older_than).cast("timestamp"))
    return rows.join(live.select(key).distinct(), key, "left_anti")


def next_page(candidates: DataFrame, key: str, after: str | None, limit: int) -> Page:
    """The ``limit`` least keys after the mark: a top-n of each task and one of those, never a sort of all.

    The cap bounds a run; the mark is the last key planned, so the runs of a
    sweep are disjoint and together they plan every key.
    """
    rest = candidates if after is None else candidates.where(F.col(key) > after)
    plan = rest.select(key).distinct().orderBy(key).limit(limit)
    top = plan.agg(F.max(key).alias("m"), F.count(F.lit(1)).alias("n")).first()
    return Page(plan, top["m"] if top["n"] == limit else None)


def sweep(candidates: DataFrame, key: str, limit: int, runs: int, after: str | None = None) -> tuple[list[Page], str | None]:
    """Up to ``runs`` pages, and the mark that the next sweep goes on from (None: it begins anew)."""
    pages: list[Page] = []
    while len(pages) < runs:
        page = next_page(candidates, key, after, limit)
        pages.append(page)
        after = page.mark
        if after is None:
            break
    return pages, after

"""Folds of each key's rows in order, where a step depends on what the steps before it left."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fold_in_order(rows: DataFrame, key: str, order: list[str], start: Callable[[], object], step: Callable[[object, dict], Iterable[tuple]], end: Callable[[object], Iterable[tuple]] | None, schema: str) -> DataFrame:
    """Rows that ``step`` gives for each row and ``end`` after each key's last; the key comes first in ``schema``.

    One exchange by key and a sort that spills; a worker then streams through
    its partition and holds one key's state, never its rows, however many a
    key has.  A null key is a key of its own.
    """
    names = [f.split()[0] for f in schema.split(", ")]
    dealt = rows.repartition(F.col(key)).sortWithinPartitions(key, *order)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state, begun = None, None, False
        for batch in batches:
            out = []
            for row in batch.astype(object).where(batch.notna(), None).to_dict("records"):
                if not begun or row[key] != at:
                    if begun and end:
                        out += [(at, *r) for r in end(state)]
                    at, state, begun = row[key], start(), True
                out += [(at, *r) for r in step(state, row)]
            yield pd.DataFrame(out, columns=names)
        if begun and end:
            yield pd.DataFrame([(at, *r) for r in end(state)], columns=names)

    return dealt.mapInPandas(run, schema)

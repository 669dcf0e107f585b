"""Table rows out of HTML pages, by a Python table function over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame


class Rows(HTMLParser):
    """Cells of every table row, or items of lists when ``tag`` says so."""

    def __init__(self, row: str = "tr", cells: tuple[str, ...] = ("td", "th")):
        super().__init__()
        self.row, self.cells = row, cells
        self.rows: list[list[str]] = []
        self.open = False

    def handle_starttag(self, tag, attrs):
        if tag == self.row:
            self.rows.append([])
        if tag in self.cells and (self.rows or self.row == self.cells[0]):
            self.rows[-1].append("")
            self.open = True

    def handle_endtag(self, tag):
        if tag in self.cells:
            self.open = False

    def handle_data(self, data):
        if self.open and self.rows and self.rows[-1]:
            self.rows[-1][-1] += data


def table_rows(pages: DataFrame, key: str, html: str, row: str = "tr", cells: tuple[str, ...] = ("td", "th")) -> DataFrame:
    """``key, row, cells``: one row per table row of each page; pages without tables give none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = {"key": [], "row": [], "cells": []}
            for k, h in zip(pdf[key], pdf[html]):
                p = Rows(row, cells)
                p.feed(h if isinstance(h, str) else "")
                for i, r in enumerate(x for x in p.rows if x):
                    out["key"].append(k)
                    out["row"].append(i)
                    out["cells"].append([c.strip() for c in r])
            yield pd.DataFrame(out)

    kind = dict(pages.dtypes)[key]
    return pages.select(key, html).mapInPandas(run, f"key {kind}, row int, cells array<string>").withColumnRenamed("key", key)

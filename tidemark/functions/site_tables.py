"""Tables of listing, news and disclosure pages: a table function that lays out their cells, and typed fields from them."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CELLS = "array<struct<text:string,href:string,header:boolean>>"
#: Most columns or rows that one cell may span: what a page claims beyond that is an error in it.
MOST_SPAN = 1000
#: A batch of table rows is given on at so many cells or characters.
BATCH_CELLS, BATCH_CHARS = 30_000, 4_000_000
#: A tag without doubt: named attributes, quoted or plain, and no element whose content is no markup.
PLAIN_TAG = r"""/?(?!(?:script|style|textarea|title|xmp|iframe|noembed|noframes|noscript|plaintext)\b)[a-z][a-z0-9]*(?:(?:[ \t\r\n]+[a-z][-a-z0-9_:]*(?:=(?:"[^"<>]*"|'[^'<>]*'|[-a-z0-9_.:%#]+))?)*[ \t\r\n]*|/)>"""
TAG = re.compile(rf"<(/?)([a-z][a-z0-9]*)({PLAIN_TAG.split('[a-z][a-z0-9]*', 1)[1][:-1]})>", re.IGNORECASE | re.ASCII)
ATTRIBUTE = re.compile(r"""([a-z][-a-z0-9_:]*)(?:=(?:"([^"]*)"|'([^']*)'|([-a-z0-9_.:%#]+)))?""", re.IGNORECASE | re.ASCII)
#: What the standard parser must judge: any other ``<``, and attributes or a slash in an end tag.
OTHER = re.compile(rf"<(?!{PLAIN_TAG})|</[a-z][a-z0-9]*[^a-z0-9>]", re.IGNORECASE | re.ASCII)
# Places of the sites, for links without one.
NEWS_SITE, DISCLOSURE_SITE, DISCLOSURE_LISTS = "https://kabutan.jp", "https://www.release.tdnet.info", "https://www.release.tdnet.info/inbs"


class Cell:
    __slots__ = ("text", "href", "header", "cols", "rows")

    def __init__(self, header: bool, attrs: dict) -> None:
        self.text, self.href, self.header = [], None, header
        self.cols, self.rows = (span(attrs.get("colspan")), span(attrs.get("rowspan"))) if attrs else (1, 1)


class Tables(HTMLParser):
    """All tables of a page; a nested table is a table of its own, and its text is not its outer cell's.

    ``found`` takes each row once nothing can be added to it; only the open
    row of each open table is held.
    """

    def __init__(self, found) -> None:
        super().__init__(convert_charrefs=True)
        self.found, self.count, self.stack, self.cell = found, 0, [], None

    def handle_starttag(self, tag, attrs):
        top = self.stack[-1] if self.stack else None
        if tag == "table":
            self.stack.append({"parent": None if top is None else top["number"], "number": self.count, "row": None, "place": 0, "below": {}, "cell": None})
            self.count += 1
            self.cell = None
        elif top is None:
            return
        elif tag == "tr":
            self.end_row(top)
            top["row"], top["cell"], self.cell = [], None, None
        elif tag == "td" or tag == "th":
            if top["row"] is None:
                top["row"] = []
            self.cell = top["cell"] = Cell(tag == "th", dict(attrs))
            top["row"].append(self.cell)
        elif tag == "a" and self.cell is not None and self.cell.href is None:
            self.cell.href = dict(attrs).get("href")

    def handle_endtag(self, tag):
        if not self.stack:
            return
        if tag == "table":
            self.end_row(self.stack.pop())
            self.cell = self.stack[-1]["cell"] if self.stack else None
        elif tag == "td" or tag == "th" or tag == "tr":
            self.stack[-1]["cell"] = self.cell = None

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.text.append(data)

    def end_row(self, table: dict) -> None:
        if table["row"] is None:
            return
        for c in table["row"]:
            c.text = " ".join(" ".join(c.text).split())
        line, table["below"] = laid_out(table["row"], table["below"])
        self.found(table["number"], table["parent"], table["place"], line)
        table["row"], table["place"] = None, table["place"] + 1

    def close(self) -> None:
        super().close()
        while self.stack:
            self.end_row(self.stack.pop())
        self.cell = None

    def read(self, page: str) -> Iterator[None]:
        """Takes a whole page, with a stop after every thousand tags; a page of plain tags is cut by one expression, any other by the standard parser."""
        if OTHER.search(page):
            self.feed(page)
        else:
            at = 0
            for n, m in enumerate(TAG.finditer(page), 1):
                i, end = m.span()
                if self.cell is not None and at < i:
                    text = page[at:i]
                    self.cell.text.append(unescape(text) if "&" in text else text)
                at = end
                close, tag, rest = m.groups()
                tag = tag.lower()
                if tag in USED:
                    if close:
                        self.handle_endtag(tag)
                    else:
                        self.handle_starttag(tag, attributes(rest) if rest else ())
                        if rest == "/":
                            self.handle_endtag(tag)
                if n % 1000 == 0:
                    yield
            if self.cell is not None and at < len(page):
                self.handle_data(unescape(page[at:]))
        self.close()
        yield


USED = frozenset(("table", "tr", "td", "th", "a"))


def attributes(text: str) -> list[tuple[str, str | None]]:
    """Names and values in a plain tag, as the standard parser gives them."""
    out = []
    for m in ATTRIBUTE.finditer(text):
        value = m[m.lastindex] if m.lastindex > 1 else None
        out.append((m[1].lower(), unescape(value) if value and "&" in value else value))
    return out


def span(value: str | None) -> int:
    """Cells covered; what is no number from 1 to ``MOST_SPAN`` counts as 1."""
    return int(value) if value and value.strip().isascii() and value.strip().isdigit() and 1 <= int(value) <= MOST_SPAN else 1


def laid_out(row: list[Cell], below: dict[int, tuple[int, Cell]]) -> tuple[list[Cell], dict[int, tuple[int, Cell]]]:
    """A table row with every cell in each place that it spans, and what is still covered below it (column: rows, cell); rows that a span adds below the last one do not count."""
    if not below and all(c.cols == 1 == c.rows for c in row):
        return row, below
    line, later, column = [], {}, 0
    cells = iter(row)
    while True:
        if column in below:
            left, cell = below.pop(column)
            line.append(cell)
            if left > 1:
                later[column] = (left - 1, cell)
            column += 1
            continue
        cell = next(cells, None)
        if cell is None:
            break
        for _ in range(cell.cols):
            line.append(cell)
            if cell.rows > 1:
                later[column] = (cell.rows - 1, cell)
            below.pop(column, None)
            column += 1
    for c in sorted(below):  # covered places to the right of a short row
        left, cell = below[c]
        line.append(cell)
        if left > 1:
            later[c] = (left - 1, cell)
    return line, later


class Batches:
    """Table rows of the pages of one batch, as Arrow batches of bounded size."""

    def __init__(self, keys: pa.Array) -> None:
        self.keys, self.ready, self.page = keys, [], 0
        self.start()

    def start(self) -> None:
        self.places, self.ends, self.text, self.href, self.header, self.chars = [], [0], [], [], [], 0

    def add(self, table: int, parent: int | None, row: int, line: list[Cell]) -> None:
        self.places.append((self.page, table, parent, row))
        for c in line:
            self.text.append(c.text)
            self.href.append(c.href)
            self.header.append(c.header)
            self.chars += len(c.text) + len(c.href or "")
        self.ends.append(len(self.text))
        if len(self.text) + len(self.places) >= BATCH_CELLS or self.chars >= BATCH_CHARS:
            self.flush()

    def flush(self) -> None:
        if not self.places:
            return
        page, *numbers = (pa.array(x, pa.int32()) for x in zip(*self.places))
        cells = pa.StructArray.from_arrays([pa.array(self.text, pa.string()), pa.array(self.href, pa.string()), pa.array(self.header, pa.bool_())], ["text", "href", "header"])
        cells = pa.ListArray.from_arrays(pa.array(self.ends, pa.int32()), cells)
        self.ready.append(pa.RecordBatch.from_arrays([self.keys.take(page), *numbers, cells], ["key", "table", "parent", "row", "cells"]))
        self.start()

    def taken(self) -> list[pa.RecordBatch]:
        out, self.ready = self.ready, []
        return out


def page_tables(pages: DataFrame, key: str, html: str) -> DataFrame:
    """``key, table, parent, row, cells`` of every table row of each page, in any order; no page, no rows.

    A task holds a batch of pages (by Spark's limits), one page as a text and
    a bounded batch of rows; of a page that needs the standard parser, its
    rows in Arrow form.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = Batches(batch.column(0))
            for i, text in enumerate(batch.column(1)):
                out.page, page = i, text.as_py()
                for _ in Tables(out.add).read(page if isinstance(page, str) else ""):
                    yield from out.taken()
            out.flush()
            yield from out.taken()

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(F.col(key).alias("key"), F.col(html).alias("html")).mapInArrow(run, f"key {kind}, table int, parent int, row int, cells {CELLS}").withColumnRenamed("key", key)


def cell(i: int) -> Column:
    return F.get("cells", F.lit(i))


def cell_text(i: int) -> Column:
    return F.coalesce(cell(i)["text"], F.lit(""))


def news_time(text: Column) -> Column:
    """``yy/mm/dd hh:mm`` of this century, else null."""
    form = r"^(\d{2})/(\d{2})/(\d{2})\s+(\d{2}):(\d{2})$"
    part = lambda i: F.regexp_extract(F.trim(text), form, i)
    return F.when(F.trim(text).rlike(form), F.try_to_timestamp(F.concat(F.lit("20"), part(1), F.lit("-"), part(2), F.lit("-"), part(3), F.lit(" "), part(4), F.lit(":"), part(5), F.lit(":00"))))


def slash_date(text: Column) -> Column:
    """``y/m/d`` or ``y-m-d`` with or without leading zeros, else null."""
    parts = F.split(F.replace(F.trim(text), F.lit("-"), F.lit("/")), "/")
    whole = F.trim(text).rlike(r"^\s*\d{1,4}\s*[/-]\s*\d{1,2}\s*[/-]\s*\d{1,2}\s*$")
    n = lambda i, w: F.lpad(F.trim(F.get(parts, F.lit(i))), w, "0")
    return F.when(whole, F.try_to_date(F.concat_ws("-", n(0, 4), n(1, 2), n(2, 2))))


def linked(href: Column, site: str, base: str | None = None) -> Column:
    """A link with its place: site-relative ones get the site, page-relative ones the base (where there is one)."""
    out = F.when(href.startswith("/"), F.concat(F.lit(site), href))
    return out.otherwise(href) if base is None else out.when(href.startswith("http"), href).otherwise(F.concat(F.lit(base + "/"), F.regexp_replace(href, "^[./]+", "")))


def data_cells() -> Column:
    """Whether the row has cells that are no headings."""
    return F.exists("cells", lambda c: ~c["header"])


def news_rows(rows: DataFrame, code: str) -> DataFrame:
    """Typed news of ``page_tables`` rows: time, category, title and link; rows without one of time, link and title go."""
    cells = F.filter("cells", lambda c: ~c["header"])
    typed = rows.withColumn("cells", cells).where(F.size("cells") >= 2)
    three = F.size("cells") >= 3
    first_link = F.get(F.filter("cells", lambda c: c["href"].isNotNull()), F.lit(0))
    link = F.when(three, cell(2)).otherwise(first_link)
    out = typed.select(code, "table", "row", news_time(cell_text(0)).alias("published_at"), F.when(three, cell_text(1)).otherwise("").alias("source_category"), link["text"].alias("title"), linked(link["href"], NEWS_SITE).alias("url"))
    return out.where("published_at is not null and url is not null and title <> ''")


def disclosure_rows(rows: DataFrame, key: str, day: Column) -> DataFrame:
    """Typed disclosures: time of the list's day, code, title, link and flags; rows without a code, time or title go."""
    typed = rows.withColumn("cells", F.filter("cells", lambda c: ~c["header"])).where(F.size("cells") >= 4)
    raw, size = F.upper(cell_text(1)), F.size("cells")
    clock = r"^\s*(\d{1,2}):(\d{1,2})\s*$"
    hour, minute = (F.regexp_extract(cell_text(0), clock, i).try_cast("int") for i in (1, 2))
    at = F.when((hour < 24) & (minute < 60), F.to_timestamp(day) + F.make_dt_interval(F.lit(0), hour, minute))
    code = F.when((F.length(raw) == 5) & raw.endswith("0"), F.substring(raw, 1, 4)).otherwise(raw)
    out = typed.where(raw.rlike("^[0-9A-Z]{4,5}$")).select(
        key, "table", "row", code.alias("code"), at.alias("published_at"), cell_text(3).alias("title"), linked(cell(3)["href"], DISCLOSURE_SITE, DISCLOSURE_LISTS).alias("url"),
        F.when(size >= 5, cell_text(4) != "").alias("has_xbrl"), F.when(size >= 6, cell_text(5)).otherwise("").alias("listing_exchange"), F.when(size >= 7, cell_text(6) != "").alias("has_update_history"),
    )
    return out.where("published_at is not null and url is not null and title <> ''")


def until_empty(found: DataFrame, list_key: str, page: str, most_pages: int) -> DataFrame:
    """Rows of each list's pages up to its first page (from 1) that gave none; later pages do not count, whatever they hold.

    Decided on one row per page that gave any; the rows themselves only meet
    the number of the last page that counts.
    """
    pages = found.where(F.col(page).between(1, most_pages)).groupBy(list_key, page).agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy(list_key).orderBy(page))
    last = pages.withColumn("_k", place).where(F.col("_k") == F.col(page)).groupBy(list_key).agg(F.max(page).alias("_last"))
    return found.join(last, list_key).where(F.col(page).between(1, F.col("_last"))).drop("_last")


def delisted_rows(rows: DataFrame) -> DataFrame:
    """``code, day`` of a delisting table (day, name, code, ...): rows without a date are headings, codes are padded to four."""
    code = F.trim(cell_text(2))
    padded = F.when(code.rlike("^[0-9]{1,3}$"), F.lpad(code, 4, "0")).otherwise(code)
    return rows.where(F.size("cells") >= 3).select(padded.alias("code"), slash_date(cell_text(0)).alias("day")).where("day is not null and code <> ''")


def delisted_codes(rows: DataFrame, run_date: str, months: int = 2) -> DataFrame:
    """Distinct codes delisted from the first of the month ``months`` before the run date to the run date."""
    run = F.lit(run_date).cast("date")
    return delisted_rows(rows).where(F.col("day").between(F.trunc(F.add_months(run, -months), "month"), run)).select("code").distinct()

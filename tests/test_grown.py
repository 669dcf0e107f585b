"""Steps whose memory or time grew with the tables: page tables, Unicode forms, lists read twice."""

import os
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark import plans
from tidemark.functions import site_tables, text

SF = "/root/testdata/sf0.001"


def test_a_long_page_gives_bounded_batches():
    """Rows leave while the page is read, and no batch grows with it."""
    page = "<table>" + "<tr><td>a</td><td>b &amp; c</td><td><a href='/x'>d</a></td></tr>" * 40_000 + "</table>"
    out = site_tables.Batches(pa.array([7]))
    got, stops = [], 0
    for _ in site_tables.Tables(out.add).read(page):
        got += out.taken()
        stops += bool(got)
    out.flush()
    got += out.taken()
    assert sum(b.num_rows for b in got) == 40_000 and stops > 100
    assert max(b.num_rows for b in got) <= site_tables.BATCH_CELLS and len(got) >= 4
    assert got[-1].column(4)[-1].as_py() == [{"text": t, "href": h, "header": False} for t, h in (("a", None), ("b & c", None), ("d", "/x"))]


ODD = [
    "<table><tr><td>a<!-- <td> -->b<td x='>'>c", "<table><tr><td>1 < 2<td><script>a<b</script>c", "<table><tr><td title='<b>'>x</td x><td =3>y", "<table><tr><td>a &am<b>p; b", "<table><tr><td/>a<td>b<br/>c<a href=x/>d",
    "<table><tr><td><a href>x</a><a href='/y?a=1&amp;b'>z", "<TABLE><TR><TD ROWSPAN='2' colspan=2>a<td>b</tr><tr><td>c<table><tr><th>in</table>d", "<table><td>no row<tr><td rowspan=x>e</table></table><td>out", "<table><tr><td>a<title>t</title>b", "x<table><tr><td>é　ä &lt; end",
]


@pytest.mark.parametrize("page", ODD)
def test_plain_pages_are_read_as_the_standard_parser_reads_them(page):
    def rows(take):
        out = []
        parser = site_tables.Tables(lambda *r: out.append((*r[:3], [(c.text, c.href, c.header) for c in r[3]])))
        take(parser)
        return out

    def fed(parser):
        parser.feed(page)
        parser.close()

    assert rows(lambda p: list(p.read(page))) == rows(fed)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
def test_disclosures_are_parsed_once(spark):
    plan = plans.queries()["disclosure_pages"](spark, SF)._jdf.queryExecution().toString()
    assert "MapIn" not in plan


def test_only_wide_texts_go_to_python(spark):
    values = ["", "plain", None, "é", "é", "ｱ", "が", "a" * 10 + "́", "\x7f"]
    df = spark.createDataFrame([(v,) for v in values], "t string").select("t", text.nfc(F.col("t")).alias("c"), text.nfkc(F.col("t")).alias("k"))
    assert "octet_length" in df._jdf.queryExecution().toString()
    for r in df.collect():
        assert (r["c"], r["k"]) == ((None, None) if r["t"] is None else tuple(unicodedata.normalize(f, r["t"]) for f in ("NFC", "NFKC")))

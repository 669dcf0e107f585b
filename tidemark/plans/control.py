"""Queries of the control plane: fetch rounds, resumable batches, life cycles, queues, constraints, decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import site_tables
from tidemark.operators import constraints, decisions, events, incremental, lifecycle, ops, queue, sweep, universe
from tidemark.operators.constraints import Check, Reference, Unique
from tidemark.sources import ledger, objects, tables
from tidemark.sources.shared import work_dir, written
from tidemark.sources.tables import table
from tidemark.streaming import events as streaming

FETCH_DAY, REQUIRED = "1998-06-01", 12


def monthly(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as bars: a series per nation and segment, a session per month; ``extra`` is void for one nation."""
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    rows = o.join(c, F.col("o_custkey") == F.col("c_custkey"))
    code = F.concat_ws("-", "c_nationkey", "c_mktsegment")
    bars = rows.groupBy(code.alias("code"), F.to_date(F.date_trunc("month", "o_orderdate")).alias("day")).agg(F.max("o_totalprice").alias("close"), F.min("c_nationkey").alias("n"))
    return bars.select("code", "day", "close", F.when(F.col("n") != 3, F.col("close")).alias("extra"), "n")


def fetched(spark, sf):
    """Log before a round, what the source offers (late and repeated rows too), and the keys asked for."""
    bars = monthly(spark, sf)
    log = bars.where("day < '1997-06-01' or n % 5 = 1").where("n % 7 <> 2 or day < '1992-06-01'").select("code", "day", "close", "extra", F.lit(0).alias("version"), F.lit(True).alias("full"))
    late = bars.where("day >= '1997-01-01' and n % 6 <> 4")
    first = late.select("code", "day", (F.col("close") + 1).alias("close"), (F.col("close") + 1).alias("extra"), F.lit(1).alias("ord"))
    again = late.where("month(day) % 2 = 0").select("code", "day", (F.col("close") + 2).alias("close"), (F.col("close") + 2).alias("extra"), F.lit(2).alias("ord"))
    return log, first.unionByName(again), bars.select("code").distinct()


def fetch(spark, sf, log=None, version=1):
    held, source, keys = fetched(spark, sf)
    held = held if log is None else log
    return held, incremental.fetch_round(held, source, keys, "code", "day", "ord", REQUIRED, FETCH_DAY, ["close", "extra"], version)


def q_fetch_manifest(spark, sf):
    """What a fetch round did for each series."""
    return fetch(spark, sf)[1][1]


def q_fetch_rows(spark, sf):
    """Rows in force after a fetch round."""
    held, (rows, _) = fetch(spark, sf)
    return incremental.in_force(held.unionByName(rows), "code", "day")


def q_fetch_again(spark, sf):
    """Rows in force and newly fetched ones after a second round over the same source: the same rows, and nothing new where nothing is stale."""
    held, (rows, _) = fetch(spark, sf)
    log = written(held.unionByName(rows), "fetch-log")
    _, (more, manifest) = fetch(spark, sf, log, 2)
    kept = incremental.in_force(log.unionByName(more), "code", "day").groupBy("code").agg(F.count(F.lit(1)).alias("n"), F.max("day").alias("last"))
    return manifest.join(kept, "code", "left").select("code", "status", "newly_fetched_days", "n", "last")


def q_stale_exclusions(spark, sf):
    """Rows of the last session but one of the series that the run does not leave out as stale."""
    held, (rows, manifest) = fetch(spark, sf)
    out = incremental.stale_exclusions(manifest, "code", FETCH_DAY, allowed=125)
    now = incremental.in_force(held.unionByName(rows), "code", "day").where("day = '1998-05-01'")
    return incremental.without_stale(now, out, "code", FETCH_DAY).select("code", "day", "close")


def totals_by_customer(rows: DataFrame) -> DataFrame:
    return rows.groupBy("_chunk", "o_custkey").agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def resumed(spark, sf) -> tuple[str, str]:
    """A run over all customers that breaks after its first wave and is taken up again."""
    path, rows = work_dir(spark, "batches"), table(spark, sf, "orders").select("o_custkey", "o_totalprice")
    name = ledger.run_fingerprint(rows, "o_custkey", "totals", FETCH_DAY)
    chunk = F.pmod("o_custkey", F.lit(60)).cast("long")
    open_ = ledger.run_chunks(rows, "o_custkey", chunk, totals_by_customer, path, name, wave_chunks=25, waves=1)
    while open_:
        open_ = ledger.run_chunks(rows, "o_custkey", chunk, totals_by_customer, path, name, wave_chunks=25)
    return path, name


def q_resumed_batches(spark, sf):
    path, name = resumed(spark, sf)
    return ledger.finished_rows(spark, path, name)


def q_batch_ledger(spark, sf):
    """Ledger of the resumed run, and in which wave a chunk was done."""
    path, name = resumed(spark, sf)
    rows = ledger.ledger(spark, path).where(F.col("fingerprint") == name)
    waves = rows.groupBy("wave").agg(F.min("chunk").alias("first_of_wave"))
    return rows.join(waves, "wave").select("chunk", "n_keys", "n_rows", "first_of_wave")


def version_steps(spark, sf) -> DataFrame:
    """Orders as steps on three versions behind a pointer per customer group."""
    o = table(spark, sf, "orders")
    kind = F.substring("o_orderpriority", 1, 1).cast("int")
    own, other = F.concat(F.lit("v"), F.pmod("o_orderkey", F.lit(3))), F.concat(F.lit("v"), F.pmod(F.floor(F.col("o_orderkey") / 3), F.lit(3)))
    move = F.element_at(F.array(*[F.array(F.lit(a), F.lit(b)) for a, b in (("draft", "shadow"), ("shadow", "draft"), ("draft", "retired"), ("shadow", "retired"), ("active", "retired"), ("draft", "shadow"))]), (F.pmod("o_custkey", F.lit(6)) + 1).cast("int"))
    return o.select(
        F.pmod("o_custkey", F.lit(211)).alias("pointer"),
        F.col("o_orderdate").alias("at"),
        F.col("o_orderkey").alias("seq"),
        F.element_at(F.array(F.lit("insert"), F.lit("member"), F.lit("move"), F.lit("move"), F.lit("activate")), kind).alias("op"),
        own.alias("version"),
        F.when(kind == 5, F.when(F.col("o_orderstatus") != "F", other)).when(kind > 2, move[0]).alias("before"),
        F.when(kind == 1, F.when(F.col("o_orderstatus") == "P", "shadow").otherwise("draft")).when(kind.between(3, 4), move[1]).alias("after"),
    )


def q_lifecycle_steps(spark, sf):
    return lifecycle.replay(version_steps(spark, sf), "pointer", ["at", "seq"])


def q_active_versions(spark, sf):
    steps = lifecycle.replay(version_steps(spark, sf).withColumn("seq", F.unix_seconds(F.col("at").cast("timestamp")) * 100_000_000 + F.col("seq")), "pointer", ["seq"])
    return lifecycle.active_versions(steps, "pointer")


def queue_calls(spark, sf) -> DataFrame:
    """Orders as calls on queue entries, ten days of orders an hour or so of calls."""
    o = table(spark, sf, "orders")
    kind = F.substring("o_orderpriority", 1, 1).cast("int")
    return o.select(
        F.pmod("o_custkey", F.lit(97)).alias("entry"), F.col("o_orderkey").alias("seq"), (F.unix_date(F.to_date("o_orderdate")) * 200).cast("long").alias("at"),
        F.element_at(F.array(F.lit("claim"), F.lit("heartbeat"), F.lit("dispatch"), F.lit("fail"), F.lit("finish")), F.when((kind == 5) & (F.col("o_orderkey") % 4 > 0), 1).otherwise(kind)).alias("op"),
        (F.col("o_orderkey") % 5 + 1).cast("long").alias("token"), (F.col("o_orderkey") % 100 * 90).cast("long").alias("seconds"),
    )


def q_queue_life(spark, sf):
    """Every call and reclaim of the queue, replayed in batch up to its last call."""
    calls = queue_calls(spark, sf)
    return queue.replay(calls, "entry", calls.agg(F.max("at")).first()[0])


def q_queue_life_stream(spark, sf):
    """The same by a stream with keyed state and timers."""
    from tidemark.streaming import queue as life

    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", life.STORE)
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    path = work_dir(spark, "queue-life")
    calls = written(queue_calls(spark, sf).withColumn("ts", F.timestamp_seconds("at")), "queue-calls")
    arriving = session.readStream.schema(calls.schema).parquet(calls.inputFiles()[0].rsplit("/", 1)[0])
    streaming.drain(life.queue_life(arriving, "entry", "ts"), streaming.append_sink(f"{path}/out"), path)
    return spark.read.parquet(f"{path}/out").drop("b")


def q_constraints(spark, sf):
    """Violated rules of a catalogue over orders, and how many rows and keys violate each."""
    o = table(spark, sf, "orders")
    catalogue = [
        Check("status_known", "o_orderstatus in ('F', 'O')"), Check("price_positive", "o_totalprice > 0"), Check("price_bounded", "o_totalprice < 300000"),
        Check("done_is_old", "o_orderstatus <> 'F' or o_orderdate < timestamp '1996-01-01'"), Check("null_passes", "nullif(o_orderstatus, 'P') <> 'P'"),
        Unique("order_once", ("o_orderkey",)), Unique("one_open_a_customer", ("o_custkey",), "o_orderstatus = 'O'"), Unique("urgent_once_a_day", ("o_orderdate", "o_orderpriority"), "o_orderpriority = '1-URGENT'"),
        Unique("nulls_differ", ("o_custkey", "nullif_status"), "true"),
        Reference("known_customer", ("o_custkey",), table(spark, sf, "customer"), ("c_custkey",)), Reference("even_customer", ("o_custkey",), table(spark, sf, "customer").where("c_custkey % 2 = 0"), ("c_custkey",)),
    ]
    return constraints.violations(o.withColumn("nullif_status", F.expr("nullif(o_orderstatus, 'O')")), catalogue)


def q_broken_rules(spark, sf):
    checks = [Check("balance", "c_acctbal >= 0"), Check("segment", "c_mktsegment <> 'BUILDING'"), Check("nation", "c_nationkey < 20")]
    return constraints.broken_rules(table(spark, sf, "customer"), checks).select("c_custkey", F.array_join("broken", ",").alias("broken"))


def rollout(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders")
    pick = lambda values, n: F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(F.floor(F.col("o_orderkey") / n), F.lit(len(values))) + 1).cast("int"))
    return o.select("o_orderkey", pick(decisions.STAGES, 1).alias("stage"), pick(decisions.MODES, 4).alias("mode"), pick(("snapshot", "series", "generation_index", "latest"), 24).alias("artifact"), pick(("shadow", "active", "draft"), 96).alias("status"), pick((True, False), 7).alias("named"), pick((False, True), 11).alias("active"))


def q_rollout_decisions(spark, sf):
    """Decision tables over every order's stage, mode and artifact: most specific rule, wildcards, an uncovered case."""
    rows = rollout(spark, sf)
    for name, rules, inputs in (("preflight", decisions.PREFLIGHT, ["stage", "mode"]), ("resolution", decisions.RESOLUTION, ["stage", "mode", "named", "active"]), ("writable", decisions.WRITES, ["stage", "mode", "artifact", "status"]), ("profile", decisions.PROFILES, ["stage", "mode", "active"])):
        rows = decisions.decide(rows, decisions.rule_table(spark, inputs, name, rules), inputs, name, strict=name != "profile").drop("rule")
    return rows


def page_of(rows: DataFrame, group: list[str], cells: str, order: str, head: str = "") -> DataFrame:
    """Orders as pages: one table row per order, in order."""
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, F.expr(cells).alias("html")))), lambda x: x["html"]), "\n")
    return rows.groupBy(*group).agg(F.concat(F.lit(f"<html><body><p>x</p><table>{head}"), lines, F.lit("</table></body></html>")).alias("html"))


def q_news_pages(spark, sf):
    """News of pages made of orders, one page a customer: headings, nested tables, rows without time or link."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.date_format("o_orderdate", "yy/MM/dd").alias("d"), "o_orderpriority", F.col("o_orderstatus").alias("st"))
    cells = """concat('<tr><td>', if(o_orderkey % 7 = 0, 'soon', concat(d, ' 09:30')), '</td><td>', o_orderpriority, '<table><tr><td>25/01/01 00:00</td><td>nested</td></tr></table></td><td>',
      if(o_orderkey % 5 = 0, 'no link', concat('<a href="', if(st = 'F', '/n/', 'https://y.jp/'), o_orderkey, '"> A &amp; B <b>', o_orderkey, '</b></a>')), '</td></tr>')"""
    pages = page_of(o, ["o_custkey"], cells, "o_orderkey", "<tr><th>time</th><th>kind</th><th>title</th></tr>")
    found = site_tables.news_rows(site_tables.page_tables(pages, "o_custkey", "html"), "o_custkey")
    return found.select("o_custkey", "published_at", "source_category", "title", "url")


def q_disclosure_pages(spark, sf):
    """Disclosures of a month's lists, up to each list's first page that gave none; codes and flags typed, spans laid out.

    A page comes in parts of a million order keys each: there are more of them, not longer ones, as orders grow.
    """
    o = table(spark, sf, "orders").select(F.to_date(F.date_trunc("month", "o_orderdate")).alias("day"), (F.col("o_custkey") % 6 + 1).cast("int").alias("page"), "o_orderkey", "o_custkey", "o_orderstatus", F.floor(F.col("o_orderkey") / 1_000_000).alias("part"))
    cells = """concat('<tr><td', if(o_orderkey % 11 = 0, ' rowspan="1"', ''), '>', o_orderkey % 24, ':', lpad(o_orderkey % 60, 2, '0'), '</td><td>',
      if((month(day) + page) % 5 = 0, '-', concat(lpad(o_custkey % 10000, 4, '0'), if(o_custkey % 2 = 0, '0', 'a'))), '</td><td>name</td><td><a href="', if(o_orderkey % 3 = 0, '/d/', './'), o_orderkey, '">t', o_orderkey, '</a></td>',
      if(o_orderkey % 4 = 0, '', concat('<td>', if(o_orderstatus = 'F', 'XBRL', ''), '</td><td>', o_orderstatus, '</td>')), '</tr>')"""
    pages = page_of(o, ["day", "page", "part"], cells, "o_orderkey", "<tr><td>1</td><td>9999</td><td colspan=2>two places, no link</td></tr>")
    rows = site_tables.page_tables(pages.withColumn("k", F.struct("day", "page")), "k", "html")
    found = site_tables.disclosure_rows(rows, "k", F.col("k.day")).select("k.day", "k.page", "code", "published_at", "title", "url", "has_xbrl", "listing_exchange")
    return site_tables.until_empty(written(found, "disclosures"), "day", "page", 5)  # read twice, parsed once


def q_delisted_pages(spark, sf):
    """Codes of delisting tables in both date forms that fall into the look-back; a table has the orders of 4,096 keys."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    cells = """concat('<tr><td>', date_format(o_orderdate, if(o_orderkey % 2 = 0, 'yyyy/M/d', 'yyyy-MM-dd')), '</td><td>n</td><td> ', o_custkey, ' </td><td>', 'm</td></tr>')"""
    pages = page_of(o.withColumn("part", F.floor(F.col("o_orderkey") / 4096)), ["part"], cells, "o_orderkey", "<tr><td>day</td><td>name</td><td>code</td></tr>")
    return site_tables.delisted_codes(site_tables.page_tables(pages, "part", "html"), "1997-03-15", 2)


def stored_series(spark, sf) -> str:
    """Bars as one object per instrument and year, written under a commit; the folder."""
    folder = f"{work_dir(spark, 'series')}/objects"
    bars = tables.bars(spark, sf).withColumn("year", F.year("date"))
    objects.write_objects(objects.series_objects(bars, "code", "date", ["close", "volume"], "series", "year"), folder)
    return folder


def q_series_objects(spark, sf):
    """What the objects hold when read back, and whether the manifest finds no fault with them."""
    folder = stored_series(spark, sf)
    faults = objects.manifest_faults(objects.scan_objects(spark, folder), objects.read_manifest(spark, folder)).count()
    back = spark.read.schema("instrument_code string, year int, dates array<string>, metrics struct<close:array<double>,volume:array<double>>").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json.gz").json(folder)
    total = lambda c: F.round(F.aggregate(f"metrics.{c}", F.lit(0.0), lambda a, x: a + x), 2).alias(c)
    return back.select("instrument_code", "year", F.size("dates").cast("long").alias("n"), F.element_at("dates", -1).alias("last"), total("close"), total("volume"), F.lit(faults).alias("faults"))


def q_manifest_faults(spark, sf):
    """Faults between stored objects and a manifest in which years are missing, renamed, repeated or changed."""
    folder = stored_series(spark, sf)
    year = F.regexp_extract("key", "year=([0-9]+)", 1).cast("int")
    m = objects.read_manifest(spark, folder)
    edited = m.where(year != 1994).withColumns({"key": F.when(year == 1995, F.concat("key", F.lit(".old"))).otherwise(F.col("key")), "size_bytes": F.col("size_bytes") + F.when(year == 1996, 1).otherwise(0), "sha256": F.when(year == 1997, F.upper("sha256")).otherwise(F.col("sha256"))})
    return objects.manifest_faults(objects.scan_objects(spark, folder), edited.unionByName(edited.where(year == 1993)))


def q_orphan_sweep(spark, sf):
    """Keys of old orders whose customer is not live, in the pages of bounded runs, until the sweep's end."""
    o = table(spark, sf, "orders").select(F.concat(F.lit("k-"), "o_custkey").alias("key"), F.col("o_orderdate").alias("created_at"))
    live = table(spark, sf, "customer").where("c_acctbal > 0").select(F.concat(F.lit("k-"), "c_custkey").alias("key"))
    found = written(sweep.orphans(o, live, "key", "1997-01-01 00:00:00").select("key").distinct(), "sweep")
    n, after, pages = found.count(), None, []
    while not pages or after is not None:
        more, after = sweep.sweep(found, "key", -(-max(n, 1) // 4), 2, after)
        pages += more
    out = None
    for i, p in enumerate(pages):
        some = p.plan.withColumn("page", F.lit(i))
        out = some if out is None else out.unionByName(some)
    return out


def q_event_cutoff(spark, sf):
    """Events up to the afternoon cutoff of a day, by the wall clock of times with and without a zone, without two categories."""
    e = table(spark, sf, "events")
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.col("event_id") % 3 == 0, "+09:00").when(F.col("event_id") % 3 == 1, "Z").otherwise(""))
    rows = e.select("event_id", F.when(F.col("event_id") % 10 > 0, text).otherwise("soon").alias("at"), F.concat(F.lit(" "), "event_type").alias("kind"))
    return events.without_categories(rows.where(events.within_cutoff(F.col("at"), "2024-01-20", "15:30")), "kind", ["click", " ", "view"]).select("event_id")


def q_named_codes(spark, sf):
    """Customers' codes with names of a list in which codes are padded, repeated or missing."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("code"), F.col("c_custkey").alias("k"))
    p = table(spark, sf, "customer").where("c_custkey % 3 > 0")
    code = F.lpad(F.col("c_custkey").cast("string"), 6, "0")
    names = p.select(F.when(F.col("c_custkey") < 1000, F.substring(code, 3, 4)).otherwise(F.concat("c_custkey", F.lit(".0"))).alias("code"), "c_name", "c_mktsegment")
    both = names.select("code", F.col("c_name").alias("name"), F.lit(1).alias("ordinal")).unionByName(names.select("code", F.concat("c_mktsegment", F.lit(" ")).alias("name"), F.lit(2).alias("ordinal")))
    return universe.with_names(c, both).select("k", "name")


def q_previous_release(spark, sf):
    rows = table(spark, sf, "orders").where("month(o_orderdate) <> 4").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.to_date("o_orderdate").alias("day"), F.col("o_orderkey").alias("run_id"))
    return universe.previous_release(rows, "month", ["day", "run_id"])


def q_allowed_keys(spark, sf):
    o = table(spark, sf, "orders").select(F.when(F.col("o_orderkey") % 9 > 0, F.col("o_orderkey").cast("string")).otherwise("").alias("cache_key"), F.nullif("o_orderpriority", F.lit("5-LOW")).alias("source_ref"))
    return ops.allowed_keys(o, "cache_key", "source_ref", ["1-URGENT", "2-HIGH"])


def q_favourites_union(spark, sf):
    lists = table(spark, sf, "orders").select("o_custkey", F.array("o_orderpriority", "o_orderstatus", F.lit(None).cast("string")).alias("codes"))
    return ops.union_favourites(lists, "o_custkey", "codes").withColumn("codes", F.array_join("codes", ","))


def control_queries() -> dict:
    return {k[2:]: f for k, f in globals().items() if k.startswith("q_")}

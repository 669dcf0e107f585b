"""The engine's queries over the driver's tables, one per operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import html, text
from tidemark.operators import calendar, candles, catalogue, derived, events, grid, indicators, ops, rules, universe
from tidemark.sources import tables
from tidemark.sources.tables import table
from tidemark.streaming import events as streaming

RUN_DATE = "1998-06-01"
R6 = lambda c: F.round(F.col(c), 6).alias(c)
TYPES = [("~", "ECON", "economy"), ("~", "STAND", "standard"), ("=", "PROMO", "promo"), ("~", "SMALL", "small"), ("=", "LARGE", "large")]


def day(c: str):
    return F.to_date(c)


def axis_of(spark, sf):
    return calendar.union_axis(tables.bars(spark, sf), tables.benches(spark, sf))


def q_bars(spark: SparkSession, sf: str) -> DataFrame:
    return tables.bars(spark, sf)


def q_benches(spark, sf):
    return tables.benches(spark, sf)


def q_union_axis(spark, sf):
    return axis_of(spark, sf).groupBy("code", "bench").agg(F.count(F.lit(1)).alias("n"), F.count("stock_close").alias("n_stock"), F.count("bench_close").alias("n_bench"), F.max("pos").alias("last_pos"))


def q_asof_close(spark, sf):
    return calendar.with_asof(axis_of(spark, sf)).select("code", "bench", "date", F.col("s").alias("stock_asof"), F.col("b").alias("bench_asof"))


def q_relative_strength(spark, sf):
    rs = indicators.relative_strength(calendar.with_asof(axis_of(spark, sf))).select("code", "bench", "date", *[f"rs{t}" for t in indicators.RS_WINDOWS])
    last = calendar.at_run_date(rs, RUN_DATE, ["code", "bench"])
    return last.select("code", "bench", "date", *[R6(f"rs{t}") for t in indicators.RS_WINDOWS])


def q_rs_series(spark, sf):
    rs = indicators.relative_strength(calendar.with_asof(axis_of(spark, sf)), (31,))
    return rs.select("code", "bench", "date", R6("rs31"))


def q_rs_acceleration(spark, sf):
    last = indicators.acceleration_at(indicators.relative_strength(calendar.with_asof(axis_of(spark, sf)), (31, 252)), RUN_DATE)
    return last.select("code", "bench", R6("rs_acceleration"), R6("rs_acceleration_zscore"))


def q_beta_adjusted_rs(spark, sf):
    return indicators.beta_adjusted(calendar.with_asof(axis_of(spark, sf)), RUN_DATE).select("code", "bench", R6("beta"), R6("beta_adjusted_rs"))


def q_information_ratio(spark, sf):
    return indicators.information_ratio(axis_of(spark, sf), RUN_DATE).select("code", "bench", R6("information_ratio"))


def q_sma75_rs(spark, sf):
    sma = indicators.sma_relative_strength(axis_of(spark, sf))
    return calendar.at_run_date(sma, RUN_DATE, ["code", "bench"]).select("code", "bench", R6("rs_sma75"))


def q_turnover(spark, sf):
    m = indicators.turnover_metrics(tables.bars(spark, sf))
    last = calendar.at_run_date(m, RUN_DATE, ["code"])
    return last.select("code", "date", R6("turnover_yen"), R6("z_turnover_60"), R6("turnover_ma_ratio_60"), R6("price_change_pct"), F.col("n_bars_used").cast("long").alias("n_bars_used"))


def q_perfect_order(spark, sf):
    b = tables.bars(spark, sf)
    return indicators.perfect_order_days(b, "1998-05-29")


def q_indicator_grid(spark, sf):
    """Flagship: turnover and relative strength per instrument at the run date, in one sorted grid."""
    b, ref = tables.bars(spark, sf), tables.benches(spark, sf)
    # Only what the grid shows goes through the windows and to the run date's row.
    rs = indicators.relative_strength(calendar.with_asof(calendar.union_axis(b, ref))).select("code", "bench", "date", *[f"rs{t}" for t in indicators.RS_WINDOWS])
    last = calendar.at_run_date(rs, RUN_DATE, ["code", "bench"]).withColumn("rs_acceleration", F.col("rs31") - F.col("rs252"))
    wide = last.groupBy("code").agg(*[F.round(F.max(F.when(F.col("bench") == n, F.col(c))), 6).alias(f"{c}_{n}") for n in ("topix", "nikkei") for c in ("rs31", "rs63", "rs126", "rs252", "rs_acceleration")])
    z = indicators.turnover_metrics(b).select("code", "date", "z_turnover_60", "turnover_ma_ratio_60", "price_change_pct")
    z = calendar.at_run_date(z, RUN_DATE, ["code"]).select("code", R6("z_turnover_60"), R6("turnover_ma_ratio_60"), R6("price_change_pct"))
    # A sort samples its input first, and so runs its last stage twice: the few rows are exchanged before it, not the windows run again.
    return grid.sort_null_last(z.join(wide, "code").repartition("code"), "z_turnover_60", True, "code")


def q_null_ratio(spark, sf):
    rs = indicators.relative_strength(calendar.with_asof(axis_of(spark, sf)))
    return indicators.null_ratio(rs, [f"rs{t}" for t in indicators.RS_WINDOWS]).select("n_rows", "n_null", R6("null_ratio"))


def q_candle_features(spark, sf):
    f = candles.features(tables.bars(spark, sf), frame=True)
    return f.select("code", "date", "tr", "direction", R6("br"), R6("ur"), R6("dr"), R6("gap"), R6("close_pos"), "hit_high", "hit_low")


def q_true_range_textbook(spark, sf):
    return candles.features(tables.bars(spark, sf), textbook=True).select("code", "date", "tr", R6("gap"))


def q_range_rank(spark, sf):
    return candles.range_rank(candles.features(tables.bars(spark, sf), frame=True)).select("code", "date", R6("gap_atr"), R6("q_sr"))


def q_smoothed_range(spark, sf):
    return candles.smoothed_range(candles.features(tables.bars(spark, sf))).select("code", R6("atr"))


def q_limit_lookup(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", candles.limit_range(F.col("o_totalprice")).alias("limit_range"))


def q_candle_labels(spark, sf):
    rows = candles.range_rank(candles.features(tables.bars(spark, sf)))
    return candles.labels(rows).select("code", "date", "candle_labels")


def q_candle_labels_textbook(spark, sf):
    """Labels over gaps to the previous close: suspected actions and dominant gaps occur here."""
    rows = candles.range_rank(candles.features(tables.bars(spark, sf), textbook=True))
    return candles.labels(rows).select("code", "date", "candle_labels", candles.price_text(F.col("candle_labels")).alias("price_text"))


def q_gap_swap(spark, sf):
    rows = candles.labels(candles.range_rank(candles.features(tables.bars(spark, sf))))
    return rows.select("code", "date", candles.swap_gap_tokens(F.col("candle_labels")).alias("swapped"))


def q_universe_class(spark, sf):
    p = table(spark, sf, "part").withColumn("cls", universe.classify_market(F.col("p_type"), TYPES))
    return p.groupBy("cls").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("p_brand").alias("brands"))


def q_duplicate_keys(spark, sf):
    return universe.duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_trailing_median(spark, sf):
    return universe.trailing_median(table(spark, sf, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], "o_totalprice", 5)


def q_segment(spark, sf):
    o = table(spark, sf, "orders")
    stat = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("st"))
    med = universe.trailing_median(o, "o_custkey", ["o_orderdate", "o_orderkey"], "o_totalprice", 5)
    c = table(spark, sf, "customer").select("c_custkey").join(stat, F.col("c_custkey") == F.col("o_custkey"), "left").drop("o_custkey").join(med, F.col("c_custkey") == F.col("o_custkey"), "left")
    status = F.when(F.col("st").isNull(), "missing").when(F.col("st") == "O", "ok").when(F.col("st") == "F", "stale").otherwise("failed")
    return c.select("c_custkey", universe.segment(status, F.coalesce("n", F.lit(0)), F.col("median_value"), 8, 150000.0).alias("segment"))


def q_segment_counts(spark, sf):
    return q_segment(spark, sf).groupBy("segment").agg(F.count(F.lit(1)).alias("n"))


def releases(spark, sf):
    return table(spark, sf, "orders").select(day("o_orderdate").alias("snapshot_date"), F.col("o_orderkey").alias("run_id"), F.col("o_custkey").alias("ordinal_key"), F.col("o_orderkey").alias("ordinal"))


def q_pick_as_of(spark, sf):
    return universe.pick_as_of(releases(spark, sf), "1996-02-29").select("snapshot_date", "run_id", "picked")


def q_pick_fallback(spark, sf):
    return universe.pick_as_of(releases(spark, sf), "1970-01-01").select("snapshot_date", "run_id", "picked")


def q_winners(spark, sf):
    rows = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), day("o_orderdate").alias("snapshot_date"), F.col("o_orderkey").alias("run_id"))
    return universe.winners(rows, "month", ["snapshot_date", "run_id"]).select("month", "run_id", "is_winner", "winner")


def month_customers(spark, sf, month):
    return table(spark, sf, "orders").where(F.date_format("o_orderdate", "yyyy-MM") == month).select("o_custkey")


def q_core_delta(spark, sf):
    return universe.set_delta(month_customers(spark, sf, "1997-03"), month_customers(spark, sf, "1997-02"), "o_custkey")


def q_delisted_patch(spark, sf):
    gone = table(spark, sf, "orders").where(day("o_orderdate").between(F.lit("1997-01-01").cast("date"), F.lit("1997-03-15").cast("date"))).select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf, "customer").join(gone, "c_custkey", "left_anti").select("c_custkey", "c_mktsegment")


def q_semi_members(spark, sf):
    big = table(spark, sf, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf, "customer").join(big, "c_custkey", "left_semi").select("c_custkey")


def q_latest_per_key(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return grid.latest_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


def q_last_line_wins(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_type", "value", "event_id")
    return tables.keep_last(e, ["user_id", "event_type"], "event_id").select("user_id", "event_type", "value")


def scored(spark, sf, mode="v1"):
    """Events as candidates: the user is the code, types stand for material, values for polarity."""
    e = table(spark, sf, "events")
    kinds = F.when(F.col("event_type") == "purchase", "earnings").when(F.col("event_type") == "signup", "monthly").when(F.col("event_type") == "click", "market_news").otherwise("other")
    rows = e.select(
        F.col("user_id").alias("code"), F.col("event_id").alias("ordinal"), F.col("ts").alias("published_at"), kinds.alias("event_type"),
        F.when(F.col("event_id") % 3 == 0, "tdnet").when(F.col("event_id") % 3 == 1, "kabutan").otherwise("other").alias("source"),
        F.when(F.col("value") > 50, "positive").otherwise("negative").alias("event_polarity"), F.lit(1.0).alias("price_change_pct"),
        F.when(F.col("event_id") % 2 == 0, "company").otherwise("sector").alias("issuer_specificity"), F.lit("new").alias("novelty_level"),
        F.when(F.col("event_id") % 5 == 0, "開示").when(F.col("event_id") % 5 == 1, "市況").otherwise("材料").alias("source_category"),
        F.lit(0.5).alias("confidence_base"),
    )
    if mode == "v2":
        k = F.col("ordinal")
        pdf = F.when(k % 4 == 0, "https://x.jp/disclosures/pdf/").when(k % 4 == 1, "https://x.jp/stock/news?").otherwise("https://x.jp/")
        rows = rows.withColumns({
            "url": F.concat(pdf, k.cast("string")), "has_xbrl": k % 6 == 0, "has_update_history": k % 7 == 0, "originality": F.when(k % 10 == 3, "Primary").when(k % 10 == 4, "recap"),
            "title": F.concat(F.lit("ｿﾆｰ・Ｇ（Ｕ"), (F.col("code") % 7).cast("string"), F.lit("）、新製品")), "name_aliases": F.when(F.col("code") % 3 < 2, F.array(F.lit("－"), F.concat(F.lit("ソニーＧ u"), (F.col("code") % 5).cast("string")))),
        })
    day_after = e.agg(F.to_date(F.max("ts")).alias("d")).first()["d"]
    return events.rank_candidates(rows, str(day_after), mode)


def q_event_scores(spark, sf):
    return scored(spark, sf).select(F.col("code").alias("user_id"), F.col("ordinal").alias("event_id"), "cause_score", F.col("rank").cast("long").alias("rank"))


def q_event_scores_v2(spark, sf):
    """Second mode over titles, links, structure flags and aliases that vary; names meet in compatibility form."""
    got = scored(spark, sf, "v2").select(F.col("code").alias("user_id"), F.col("ordinal").alias("event_id"), "cause_score", F.col("rank").cast("long").alias("rank"), "score_name", "score_channel", "score_structure", "score_material", "score_novelty")
    return got


def q_cause_type(spark, sf):
    spikes = table(spark, sf, "customer").select(F.col("c_custkey").alias("code"))
    return events.summarise(spikes, scored(spark, sf)).select("code", "cause_type", "cause_score")


def q_enriched(spark, sf):
    """Customers as instruments: summaries and candidates meet them by code, with blank titles, a fallback and missing summaries."""
    k = F.col("ordinal")
    ranked = scored(spark, sf).withColumns({"title": F.when(k % 4 > 0, F.concat(F.lit(" event "), k)), "url": F.concat(F.lit("/e/"), k), "code": F.concat(F.lit(" c"), F.col("code"), F.lit(" "))})
    spikes = table(spark, sf, "customer").where("c_custkey % 5 > 0").select(F.concat(F.lit(" c"), "c_custkey", F.lit(" ")).alias("code"), "c_custkey")
    base = events.summarise(spikes, ranked).select(F.lower("code").alias("code"), "cause_type", F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("top "), "c_custkey")).alias("top_title"), F.lit(1).alias("ordinal"))
    older = spikes.select("code", F.lit("A").alias("cause_type"), F.lit("old").alias("top_title"), F.lit(0).alias("ordinal"))
    out = events.enrich(table(spark, sf, "customer").select(F.concat(F.lit("C"), "c_custkey").alias("code")), base.unionByName(older), ranked, 2)
    return out


def q_event_dedup(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_type", day("ts").alias("d"), "event_id", "value")
    got = events.dedup_with_preference(e, ["user_id", "event_type", "d"], F.col("event_id") % 7 == 0, "value", "event_id")
    return got.select("user_id", "event_type", "d", "event_id")


def q_event_window(spark, sf):
    e = table(spark, sf, "events")
    return e.where(F.col("ts") <= F.lit("2024-01-20 15:00:00").cast("timestamp")).groupBy(day("ts").alias("d")).agg(F.count(F.lit(1)).alias("n"))


def q_title_type(spark, sf):
    rules = [(("idiot", "moron"), "insult"), (("the ", "and "), "english"), (("der ", "und "), "german"), (("que",), "romance")]
    return table(spark, sf, "documents").select("doc_id", events.title_type(F.col("text"), rules).alias("tag"))


def q_selection(spark, sf):
    rules = [{"type": "z_turnover_gt", "column": "c_acctbal", "value": 9000.0}, {"type": "candle_labels_contains_any", "column": "c_mktsegment", "values": ["auto"]}, {"type": "z_turnover_lt", "column": "no_such_column", "value": 0.0}]
    c = table(spark, sf, "customer")
    return c.where(events.selection(rules, c.columns)).select("c_custkey")


def q_grid_filters(spark, sf):
    c = table(spark, sf, "customer")
    return grid.apply_filters(c, [("c_acctbal", "between", 5000.0, 1000.0), ("c_mktsegment", "contains", "b"), ("c_name", "notnull")]).select("c_custkey", "c_acctbal")


def q_grid_sort(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"))
    return grid.sort_null_last(c, "balance", False, "c_custkey")


def q_preview(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.round("c_acctbal", -2).alias("balance"))
    return grid.preview(c, "balance", 20)


def q_top_per_key(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return grid.top_per_key(o, "o_custkey", [F.desc("o_totalprice"), F.asc("o_orderkey")], 2)


def q_all_negative(spark, sf):
    return q_indicator_grid(spark, sf).where(grid.all_negative(["rs31_topix", "rs63_topix"])).select("code")


def q_benchmark_switch(spark, sf):
    return grid.switch_benchmark(q_indicator_grid(spark, sf).select("code", "rs31_topix", "rs31_nikkei"), "topix", "nikkei")


def q_codes(spark, sf):
    c = F.col("s_suppkey").cast("string")
    padded = F.concat(F.lit(" "), c, F.when(F.col("s_suppkey") % 2 == 0, F.lit("0")).otherwise(F.lit("a")), F.lit(" "))
    return table(spark, sf, "supplier").select("s_suppkey", text.universe_code(F.concat(c, F.lit(".0"))).alias("universe_code"), text.metric_code(c).alias("metric_code"), text.alias_code(padded).alias("alias_code"), text.filing_code(padded).alias("filing_code"), text.joined_code(padded).alias("joined_code"))


def q_half_width(spark, sf):
    return table(spark, sf, "part").select("p_partkey", text.half_width(F.concat(F.lit("Ａ１　"), F.col("p_name"))).alias("name"), text.ticker(F.col("p_partkey").cast("string")).alias("ticker"))


def q_nfc(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.length(text.nfc(F.col("text"))).cast("long").alias("n"))


def q_months(spark, sf):
    o = table(spark, sf, "orders").groupBy("o_custkey").agg(F.min(day("o_orderdate")).alias("a"), F.max(day("o_orderdate")).alias("b"))
    return o.select("o_custkey", F.size(text.month_keys(F.col("a"), F.col("b"))).cast("long").alias("n_months"), text.month_ago_first(F.col("b")).alias("cutoff"))


def q_chunks(spark, sf):
    o = table(spark, sf, "orders").groupBy("o_custkey").agg(F.min(day("o_orderdate")).alias("a"), F.max(day("o_orderdate")).alias("b"))
    return tables.chunk_bounds(o, "a", "b").select("o_custkey", F.to_date("chunk_start").alias("chunk_start"), F.to_date("chunk_end").alias("chunk_end"))


def q_snapshot_flags(spark, sf):
    g = q_indicator_grid(spark, sf)
    s = derived.snapshot_flags(g, ["z_turnover_60", "rs31_topix", "rs252_nikkei"])
    return s.select("code", F.array_join("_flags.missing_metrics", ",").alias("missing"), F.array_join("_flags.non_finite_metrics", ",").alias("non_finite"))


def q_key_digest(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", F.col("o_orderkey").cast("string").alias("k"))
    return derived.digest_of_keys(o, "o_custkey", "k")


def q_decimal_text(spark, sf):
    return table(spark, sf, "part").select("p_partkey", derived.decimal_text(F.col("p_retailprice")).alias("price"))


def q_series_arrays(spark, sf):
    b = tables.bars(spark, sf)
    s = derived.series_arrays(b, ["code"], "date", ["close"])
    return s.select("code", F.array_join(F.transform("dates", lambda d: d.cast("string")), ",").alias("dates"), F.size("close").cast("long").alias("n"), F.aggregate("close", F.lit(0.0), lambda a, x: a + x, lambda a: F.round(a, 2)).alias("total"))


def q_series_merge(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", day("o_orderdate").alias("d"), "o_totalprice").groupBy("o_custkey", "d").agg(F.max("o_totalprice").alias("v"))
    old, new = o.where("d < '1996-01-01'"), o.where("d >= '1995-06-01'").withColumn("v", -F.col("v"))
    return derived.merge_series(old, new, ["o_custkey", "d"]).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("v") < 0).alias("n_new"))


def q_series_seed(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", day("o_orderdate").alias("d"), "o_totalprice").groupBy("o_custkey", "d").agg(F.max("o_totalprice").alias("v"))
    old, new = o.where("d < '1996-01-01'"), o.where("d >= '1995-06-01'").withColumn("v", -F.col("v"))
    return derived.merge_series(old, new, ["o_custkey", "d"], overwrite=False).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("v") < 0).alias("n_new"))


def q_upsert_latest(spark, sf):
    o = table(spark, sf, "orders")
    part = lambda c: o.where(c).groupBy("o_custkey").agg(F.max(day("o_orderdate")).alias("d"), F.max("o_orderkey").alias("v"))
    return derived.upsert_latest(part("o_orderkey % 2 = 0"), part("o_orderkey % 2 = 1"), ["o_custkey"], "d")


def q_supersede(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("object_key"), F.year("o_orderdate").alias("generation"), F.when(F.col("o_orderstatus") == "F", "committed").otherwise("pending").alias("status"))
    return derived.supersede(o, 1996).groupBy("generation", "status").agg(F.count(F.lit(1)).alias("n"))


def q_zip_arrays(spark, sf):
    o = table(spark, sf, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_totalprice"))).alias("s"))
    two = o.select("o_custkey", F.transform("s", lambda x: x["o_orderkey"]).alias("k"), F.transform("s", lambda x: x["o_totalprice"]).alias("v"))
    return derived.zip_arrays(two, ["k", "v"]).select("o_custkey", F.col("n").cast("long").alias("n"), "k", "v")


def q_axis_series(spark, sf):
    b = tables.bars(spark, sf)
    axis = tables.sessions(tables.benches(spark, sf), RUN_DATE, 60)
    got = calendar.align_to_axis(axis, b, ["code"], "close")
    return got.select("code", F.size("close").cast("long").alias("n"), F.size(F.filter("close", lambda x: x.isNull())).cast("long").alias("n_missing"), F.get("close", F.lit(59)).alias("last_close"))


def runs(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("workflow"), day("o_orderdate").alias("run_date"), F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "failed").otherwise("running").alias("status"), F.col("o_orderdate").cast("timestamp").alias("started_at"), F.col("o_orderdate").cast("timestamp").alias("finished_at"), F.col("o_custkey").alias("generation")
    )


def q_runs_by_day(spark, sf):
    return ops.runs_by_day(runs(spark, sf)).select("workflow", "run_date", "status", "run_count")


def q_success_rates(spark, sf):
    return ops.success_rates(runs(spark, sf), "1996-06-01 00:00:00")


def q_stale_running(spark, sf):
    return ops.stale_running(runs(spark, sf), ["1-URGENT", "2-HIGH"], "1996-01-01 00:00:00").select("id")


def q_claimable(spark, sf):
    q = runs(spark, sf).select("id", F.when(F.col("status") == "running", "pending").otherwise("claimed").alias("status"), F.col("started_at").alias("visible_at"), (F.col("id") % 4).alias("attempts"), F.lit(3).alias("budget"), F.lit(None).cast("timestamp").alias("retry_at"), F.col("started_at").alias("created_at"))
    return ops.claimable(q, "1996-01-01 00:00:00", 50).select("id")


def q_retention(spark, sf):
    o = table(spark, sf, "orders").withColumn("d", day("o_orderdate"))
    kept = ops.retention(o, "d", F.add_months(F.lit(RUN_DATE).cast("date"), -12))
    return kept.groupBy(F.date_format("d", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"))


def q_sweep_plan(spark, sf):
    o = runs(spark, sf).withColumn("status", F.when(F.col("status") == "success", "orphan").otherwise("committed"))
    return ops.sweep_plan(o)


def q_history_quality(spark, sf):
    u = runs(spark, sf).withColumn("status", F.when(F.col("status") == "success", "committed").when(F.col("id") % 11 == 0, "blocked").otherwise("open"))
    return ops.history_quality(u, "generation")


def q_pair_pointers(spark, sf):
    p = table(spark, sf, "orders").select(day("o_orderdate").alias("date"), F.when(F.col("o_orderstatus") == "F", "topix").otherwise("nikkei").alias("bench"), F.col("o_orderkey").alias("key"), F.struct("o_orderdate", "o_orderkey").alias("committed_at"))
    return ops.pair_pointers(p, "topix", "nikkei")


def q_merge_aliases(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("code"), F.substring("o_orderpriority", 3, 20).alias("dedup_key"), F.col("o_orderkey").alias("ordinal"), F.col("o_orderpriority").alias("alias"), (F.col("o_orderkey") % 5).alias("seen_count"), F.when(F.col("o_orderkey") % 3 == 0, "low").when(F.col("o_orderkey") % 3 == 1, "medium").otherwise("high").alias("confidence"), "o_orderstatus")
    old = o.where("o_orderstatus = 'P'").select("code", "dedup_key")
    new = o.where("o_orderstatus <> 'P'").drop("o_orderstatus")
    return ops.merge_aliases(old, new).select("code", "ordinal", "action")


def q_stale_generations(spark, sf):
    g = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "committed").otherwise("pending").alias("status"), F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderdate").cast("timestamp")).alias("heartbeat_at"))
    return ops.stale_generations(g, "1996-06-01 00:00:00").select("o_orderkey")


def q_high_water(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", F.when(F.col("o_orderstatus") == "F", day("o_orderdate")).alias("last"), F.lit("1996-06-01").cast("date").alias("day"))
    return ops.high_water(o, "o_custkey", "last", "day")


def q_favourite_filter(spark, sf):
    lists = table(spark, sf, "orders").select(F.col("o_custkey").alias("code"), F.col("o_orderpriority").alias("list_id"))
    c = table(spark, sf, "customer").select("c_custkey")
    return grid.favourite_filter(c, lists, "c_custkey", ["1-URGENT"], True)


def q_code_contains(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("code"))
    return grid.apply_filters(s, [("code", "contains", "１"), ("code", "contains", " ")])


def q_projected_rows(spark, sf):
    k = F.col("c_custkey")
    c = table(spark, sf, "customer").select(
        k.cast("string").alias("code"), F.when(k % 2 == 0, "1998-06-01").when(k % 7 == 0, "").otherwise("1998-05-29").alias("date"), F.lit("1998-06-01").alias("trade_date"),
        F.when(k % 3 == 0, "n/a").otherwise((F.col("c_acctbal") / 7).cast("string")).alias("rs31_topix"), F.lit(" ").alias("z"), F.when(k % 11 > 0, F.col("c_name")).alias("name"),
        F.concat(F.lit(" "), "c_mktsegment").alias("sector"), F.when(k % 4 > 1, F.concat(F.lit("t"), k)).alias("t1"), F.lit("/u").alias("u1"), F.when(k % 5 == 0, " s ").alias("t2"), F.lit("").alias("u2"),
    )
    got = derived.project_rows(c, "topix", ["rs31"], ["z"], "1998-06-01", ["sector"], [("t1", "u1"), ("t2", "u2")])
    return got.withColumn("event_news_bundle", F.array_join(F.transform("event_news_bundle", lambda x: F.concat(x["title"], F.lit("|"), F.coalesce(x["url"], F.lit("-")))), ","))


def q_int_metric(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_partkey") % 5 == 0, F.lit(float("inf"))).when(F.col("p_partkey") % 2 == 0, F.floor("p_retailprice").cast("double")).otherwise(F.col("p_partkey") + 0.5).alias("x"))
    value, missing, odd = derived.classify_int(F.col("x"), "double")
    return p.select("p_partkey", value.alias("value"), missing.alias("missing"), odd.alias("non_finite"))


def q_seed_outcome(spark, sf):
    o = table(spark, sf, "orders").withColumn("d", day("o_orderdate"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return derived.seed_outcome(c, o, "o_custkey", "d", "1996-03-01")


def q_same_keys(spark, sf):
    return derived.same_keys(table(spark, sf, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf, "orders").select(F.col("o_custkey").alias("k")), "k")


def q_staged_rows(spark, sf):
    o = table(spark, sf, "orders").groupBy("o_orderpriority", F.year("o_orderdate").alias("batch")).agg(F.to_json(F.array_sort(F.collect_list(F.struct(F.col("o_orderkey").alias("ord"), F.col("o_custkey").alias("code"), F.col("o_totalprice").alias("price"))))).alias("payload"))
    return derived.staged_rows(o.withColumn("ordinal", F.col("batch") * 10 + F.substring("o_orderpriority", 1, 1).cast("int")), "payload", "ord:bigint,code:bigint,price:double", ["code"], "ordinal").select("code", "ord")


def q_collect_candidates(spark, sf):
    p = table(spark, sf, "part").select((F.col("p_size") % 7).cast("long").alias("code"), F.concat(F.col("p_brand"), F.when(F.col("p_partkey") % 2 == 0, " ").otherwise("&amp;"), F.col("p_size").cast("string")).alias("alias"), F.when(F.col("p_partkey") % 3 == 0, "tdnet").otherwise("kabutan").alias("source"), F.lit(1).cast("long").alias("n"), F.col("p_partkey").alias("ordinal"))
    known = spark.createDataFrame([(1, "brand#111")], "code long, dedup_key string")
    state = spark.createDataFrame([(1, "brand#111", 5)], "code long, dedup_key string, seen_count long")
    return rules.collect_candidates(p, known, state).select("code", "dedup_key", F.array_join("sources", ",").alias("sources"), "seen_count", "confidence", "reason")


def q_close_rs75(spark, sf):
    rs = indicators.relative_strength(calendar.with_asof(axis_of(spark, sf)), (75,))
    return calendar.at_run_date(rs, RUN_DATE, ["code", "bench"]).select("code", "bench", R6("rs75"))


def q_lookback_eligible(spark, sf):
    return indicators.lookback_eligible(axis_of(spark, sf), "1995-06-30")


def q_require_session(spark, sf):
    return calendar.require_session(tables.benches(spark, sf), RUN_DATE)


def q_axis_metrics(spark, sf):
    """Relative strength of every window on each of the last 60 sessions, in one pass."""
    ref = tables.benches(spark, sf)
    rs = indicators.relative_strength(calendar.with_asof(axis_of(spark, sf)))
    return calendar.trailing_axis(rs, tables.sessions(ref, RUN_DATE, 60)).select("code", "bench", "date", *[R6(f"rs{t}") for t in indicators.RS_WINDOWS])


def q_axis_day_metrics(spark, sf):
    """Turnover score, four relative strengths, acceleration, its score and averaged strength on each of the last 60 sessions, for both benchmarks."""
    b, ref = tables.bars(spark, sf), tables.benches(spark, sf)
    got = indicators.axis_day_metrics(b, ref, tables.sessions(ref.where("bench = 'topix'"), RUN_DATE, 60))
    return got.select("code", "date", *[R6(c) for c in got.columns if c not in ("code", "date")])


CATALOGUE = [{"metric_key": k, "value_type": t} for k, t in (("size", "int"), ("share", "float"), ("odd", "bool"), ("label", "string"), ("raw", "float"))]


def q_catalogue_snapshot(spark, sf):
    """Parts as a snapshot of a metric set: typed values, flags in catalogue order, and the set's fingerprint."""
    k = F.col("p_partkey")
    p = table(spark, sf, "part").select(
        k.cast("string").alias("code"), F.when(k % 7 > 0, F.col("p_size").cast("double")).alias("size"), F.when(k % 5 > 0, (k % 64) / 16).when(k % 2 == 0, F.lit(float("inf"))).alias("share"),
        (k % 2 == 1).alias("odd"), F.when(k % 3 > 0, F.concat("p_brand", F.lit("e\u0301"))).alias("label"), F.when(k % 4 == 0, "x").otherwise((k / 8).cast("string")).alias("raw"), F.lit(1).alias("other"),
    )
    got = catalogue.snapshot(p, CATALOGUE)
    js = catalogue.snapshot_json(got, CATALOGUE)
    out = got.join(js, "instrument_code")
    flags = lambda f: F.array_join(F.col(f"_flags.{f}"), ",").alias(f)
    return out.select("instrument_code", "size", "share", "odd", "label", "raw", flags("missing_metrics"), flags("non_finite_metrics"), F.length("values_json").cast("long").alias("n"), F.lit(catalogue.set_fingerprint("parts", CATALOGUE)).alias("fingerprint"))


def q_patched_key(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("universe-patched-"), "o_orderpriority", F.lit("-"), F.date_format("o_orderdate", "yyyy-MM-dd")).alias("key"))
    tag, date = text.patched_key(F.col("key"))
    rows = o.select("o_orderkey", "key", tag.alias("tag"), date.alias("d")).where((F.col("tag") == "2-HIGH") & F.col("d").between(F.lit("1996-03-01").cast("date"), F.lit("1996-03-20").cast("date")))
    return rows.agg(F.max(F.struct("d", "key")).alias("r")).select("r.d", "r.key")


def q_html_items(spark, sf):
    rows = html.table_rows(table(spark, sf, "pages"), "page_id", "html", row="nav", cells=("li",))
    return rows.select("page_id", F.size("cells").cast("long").alias("n"))


def q_json_props(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))
    return e.groupBy("k").agg(F.count(F.lit(1)).alias("n"))


def q_issuer_counts(spark, sf):
    o = table(spark, sf, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return grid.top_per_key(o, "o_custkey", [F.desc("n"), F.asc("o_orderpriority")], 2)


def q_status_counts(spark, sf):
    s = text.bar_status(F.col("n"), F.lit(8), F.col("last"), F.lit("1996-01-01").cast("date"))
    o = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.max(day("o_orderdate")).alias("last"))
    return o.select(s.alias("status")).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def q_price_text(spark, sf):
    rows = candles.labels(candles.range_rank(candles.features(tables.bars(spark, sf))))
    return rows.select("code", "date", candles.price_text(F.col("candle_labels")).alias("price_text"))


def q_links(spark, sf):
    return rules.with_links(table(spark, sf, "nation").select(F.col("n_name").alias("code")))


def q_prompt_block(spark, sf):
    """The whole JSON of every part: missing and blank fields are null, numbers come from their columns."""
    k = F.col("p_partkey")
    g = table(spark, sf, "part").select(
        F.concat(F.lit(" "), k.cast("string")).alias("code"), F.when(k % 3 > 0, F.lit("1998-06-01")).alias("date"), F.when(k % 4 > 0, F.col("p_name")).otherwise(" ").alias("name"),
        (k * 1000).cast("double").alias("turnover_yen"), F.when(k % 2 == 0, (k % 16) / 4).alias("z_turnover_60"), ((k % 8) / 8).alias("turnover_ma_ratio_20"), ((k % 64) / 16).alias("price_change_pct"),
    )
    return g.select(F.trim("code").cast("long").alias("p_partkey"), rules.prompt_block(g).alias("block"))


def q_history_eligibility(spark, sf):
    n = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return n.select("o_custkey", rules.history_eligibility(F.col("n"), 10, F.col("o_custkey")).alias("eligibility"))


def q_backfill_outcome(spark, sf):
    m = table(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count_distinct("o_custkey").alias("added"), F.count_distinct(day("o_orderdate")).alias("dates"))
    out = rules.backfill_outcome(F.col("month"), F.lit("1996-01"), F.col("dates") > 5, F.col("added") % 60, F.col("dates"), 50, 900)
    return m.select("month", out.alias("o")).select("month", "o.outcome", "o.reason")


def q_terminal_status(spark, sf):
    o = table(spark, sf, "orders")
    job = lambda k: F.when(F.col("o_orderkey") % k == 0, "failure").otherwise("success")
    got = rules.terminal_status(F.col("o_orderstatus") != "P", [job(5)], [job(7)], F.col("o_orderkey") % 11 != 0)
    return o.select(got.alias("status")).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def q_coverage_gate(spark, sf):
    rs = indicators.relative_strength(calendar.with_asof(axis_of(spark, sf)), (31,)).withColumn("ok", F.col("pos") >= 25)
    return rules.coverage_gate(rs, "rs31", "ok").select("n_eligible", R6("rate"), "allowed")


def q_alias_rules(spark, sf):
    p = table(spark, sf, "part").withColumn("alias", F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("東証P "), "p_name")).when(F.col("p_partkey") % 3 == 1, F.concat("p_name", F.lit(" quote"))).otherwise(F.substring("p_brand", 1, 4))).withColumn("plain", rules.plain_alias(F.col("alias")))
    return p.select("p_partkey", rules.alias_key(F.col("plain")).alias("k"), rules.strip_market_prefix(F.col("plain")).alias("stripped"), rules.alias_confidence(F.lit(1), F.col("plain"), F.lit(False)).alias("confidence"))


def q_logical_digest(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_name").alias("code"), F.col("n_regionkey").cast("long").alias("region"), (F.col("n_nationkey") / 4).alias("share"))
    return rules.logical_digest(rules.digest_rows(n, "code", {"share": "float", "region": "int"}), "2026-01-01", "SET")


def q_reconcile(spark, sf):
    """Order totals recomputed from their lines against the stored ones: which differ beyond the tolerance, or are on one side only."""
    price = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(price).alias("total"))
    return indicators.reconcile(table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("total")), lines, ["o_orderkey"], "total", 0.5).select("o_orderkey", "state")


def q_missing_guard(spark, sf):
    rs = indicators.relative_strength(calendar.with_asof(axis_of(spark, sf)))
    return indicators.missing_guard(rs, [f"rs{t}" for t in indicators.RS_WINDOWS], 4, 1, 0.01).select("n_rows", "n_null", R6("ratio"), "too_many")


def q_missing_shares(spark, sf):
    """Share of missing values of each metric over all bars, and which are missing in more than half."""
    rs = indicators.relative_strength(calendar.with_asof(axis_of(spark, sf)))
    return indicators.missing_shares(rs, [f"rs{t}" for t in indicators.RS_WINDOWS], 0.2)


def q_share_classes(spark, sf):
    p = table(spark, sf, "part").select(F.concat(F.col("p_partkey").cast("string"), F.when(F.col("p_size") % 2 == 0, "0A").otherwise("")).alias("code"))
    return universe.drop_share_classes(p)


def q_title_novelty(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.concat(F.when(F.col("event_id") % 3 == 0, "（訂正）").when(F.col("event_id") % 3 == 1, "開示事項の経過 ").otherwise(""), "event_type").alias("title"))
    return e.select("event_id", events.title_novelty(F.col("title")).alias("novelty"))


def q_update_anomalies(spark, sf):
    """Limits that a month's dictionary update breaks, as if orders were added aliases."""
    o = table(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"), F.avg(F.when(F.col("o_orderstatus") != "P", 1.0).otherwise(0.0)).alias("ok"), F.avg(F.when(F.col("o_orderpriority") < "3", 1.0).otherwise(0.0)).alias("low"))
    return o.select("month", F.array_join(rules.anomalies(F.col("n"), F.col("ok"), F.col("low")), ",").alias("broken"))


def q_stream_windows(spark, sf):
    """Events a day and type by a stream with windows."""
    path = streaming.work_dir(spark, "windows")
    counts = streaming.windowed_counts(arriving(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "event_type")
    return streaming.drained_latest(counts, ["start", "event_type"], path, complete=True).select(F.to_date("start").alias("d"), "event_type", "n")


def q_events_daily(spark, sf):
    e = table(spark, sf, "events")
    return e.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total")).select(F.to_date("w.start").alias("d"), "event_type", "n", "total")


def q_lease_filter(spark, sf):
    o = runs(spark, sf)
    leases = o.select(F.col("generation").alias("code"), F.when(F.col("workflow") == "1-URGENT", "daily").otherwise("other").alias("owner"), F.col("started_at").alias("expires_at"))
    work = table(spark, sf, "customer").select(F.col("c_custkey").alias("code"))
    return ops.without_leases(work, leases, "code", ["daily"], "2000-01-01 00:00:00")


def q_resolve_unique(spark, sf):
    return ops.resolve_unique(table(spark, sf, "part"), ["p_brand", "p_size"], "p_type")


def q_covering_runs(spark, sf):
    return ops.covering_runs(runs(spark, sf), "1996-03-01 00:00:00", 3 * 24 * 60)


def q_first_source(spark, sf):
    c = runs(spark, sf).select("generation", "workflow", "id")
    return ops.first_source(c, "generation", "workflow", ["2-HIGH", "1-URGENT", "5-LOW"], "id")


def q_dictionary_state(spark, sf):
    o = table(spark, sf, "orders").withColumn("d", day("o_orderdate"))
    old = o.where("d < '1996-01-01'").groupBy("o_custkey").agg(F.min("d").alias("first_seen"), F.max("d").alias("last_seen"), F.count(F.lit(1)).alias("seen_count"), F.array_sort(F.collect_set("o_orderpriority")).alias("sources"))
    new = o.where("d >= '1996-01-01'").select("o_custkey", F.col("o_orderpriority").alias("source"))
    return ops.dictionary_state(old, new, ["o_custkey"], "1997-01-01").withColumn("sources", F.array_join("sources", ","))


def q_favourites(spark, sf):
    lists = table(spark, sf, "orders").groupBy("o_custkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderpriority"))), lambda x: x["o_orderpriority"]).alias("codes"))
    return ops.favourites(lists, "o_custkey", "codes", 3).withColumn("codes", F.array_join("codes", ","))


def q_available_dates(spark, sf):
    o = table(spark, sf, "orders").select(day("o_orderdate").alias("d"))
    return o.where("d < '1995-06-01'").union(o.where("d >= '1995-05-01'")).distinct().orderBy(F.desc("d"))


def arriving(spark, sf, name):
    """A table as a stream of files."""
    return spark.readStream.schema(table(spark, sf, name).schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf)


def q_stream_first_seen(spark, sf):
    """The first event of each user and type by time: a running minimum, each change of which replaces the row before it."""
    path = streaming.work_dir(spark, "first-seen")
    firsts = streaming.first_events(arriving(spark, sf, "events").select("user_id", "event_type", "ts", "event_id", "value"), ["user_id", "event_type"], ["ts", "event_id"])
    return streaming.drained_latest(firsts, ["user_id", "event_type"], path).select("user_id", "event_type", "event_id", "value")


def q_stream_latest(spark, sf):
    """Latest event per user, kept by idempotent upserts of a stream."""
    path = streaming.work_dir(spark, "latest")
    rows = arriving(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    streaming.drain(rows, streaming.upsert_sink(f"{path}/out", ["user_id"], ["ts", "event_id"]), path)
    versions = spark.read.parquet(f"{path}/out")
    return versions.where(F.col("v") == versions.agg(F.max("v").alias("m")).first()["m"]).select("user_id", "event_id", "event_type")


def all_queries() -> dict:
    return {k[2:]: f for k, f in globals().items() if k.startswith("q_")}

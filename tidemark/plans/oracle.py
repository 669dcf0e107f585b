"""DuckDB SQL that gives the same rows as the engine's queries."""

from __future__ import annotations

RUN = "DATE '1998-06-01'"
BARS = """bars AS (SELECT n_name AS code, CAST(l_shipdate AS DATE) AS date,
 first(l_extendedprice ORDER BY l_orderkey, l_linenumber, l_extendedprice) AS open, max(l_extendedprice) AS high, min(l_extendedprice) AS low,
 last(l_extendedprice ORDER BY l_orderkey, l_linenumber, l_extendedprice) AS close, sum(l_quantity) AS volume
 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2)"""
BENCH = """bench AS (SELECT 'topix' AS bench, CAST(l_shipdate AS DATE) AS date, last(l_extendedprice ORDER BY l_orderkey, l_linenumber, l_extendedprice) AS close FROM lineitem GROUP BY 2
 UNION ALL SELECT 'nikkei', CAST(l_shipdate AS DATE), last(l_extendedprice ORDER BY l_orderkey, l_linenumber, l_extendedprice) FROM lineitem WHERE l_returnflag = 'R' GROUP BY 2)"""
AXIS = f"""{BARS}, {BENCH}, names AS (SELECT DISTINCT bench FROM bench), codes AS (SELECT DISTINCT code FROM bars),
 sb AS (SELECT code, bench, date, close AS stock_close FROM bars, names), bb AS (SELECT code, bench, date, close AS bench_close FROM codes, bench),
 axis AS (SELECT code, bench, date, stock_close, bench_close, row_number() OVER (PARTITION BY code, bench ORDER BY date) AS pos FROM sb FULL JOIN bb USING (code, bench, date))"""
W = "PARTITION BY code, bench ORDER BY date"
ASOF = f"""{AXIS}, asof_ AS (SELECT *, last_value(stock_close IGNORE NULLS) OVER ({W} ROWS UNBOUNDED PRECEDING) AS s, last_value(bench_close IGNORE NULLS) OVER ({W} ROWS UNBOUNDED PRECEDING) AS b FROM axis)"""


def ret(c: str, t: int) -> str:
    return f"({c} / nullif(lag({c}, {t}) OVER ({W}), 0) - 1)"


def rs(*ts: int) -> str:
    return ", ".join(f"{ret('s', t)} - {ret('b', t)} AS rs{t}" for t in ts)


def at_run(src: str, keys: str) -> str:
    return f"(SELECT * FROM {src} WHERE date <= {RUN} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY date DESC) = 1)"


def r6(*cs: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in cs)


TURN = f"""{BARS}, t0 AS (SELECT *, ln(1 + close * volume) AS x, close * volume AS v FROM bars), turn AS (SELECT code, date, v AS turnover_yen,
 row_number() OVER w AS k, count(x) OVER l AS c, avg(x) OVER l AS m, stddev_samp(x) OVER l AS sd, avg(v) OVER l AS mv, x, v, close / nullif(lag(close) OVER w, 0) AS q
 FROM t0 WINDOW w AS (PARTITION BY code ORDER BY date), l AS (PARTITION BY code ORDER BY date ROWS 59 PRECEDING)),
 turn2 AS (SELECT code, date, turnover_yen, CASE WHEN k > 60 AND c >= 42 AND x IS NOT NULL AND sd > 0 THEN (x - m) / sd END AS z_turnover_60,
 CASE WHEN k > 60 AND c >= 42 AND x IS NOT NULL AND mv > 0 THEN v / mv END AS turnover_ma_ratio_60, (q - 1) * 100 AS price_change_pct, k AS n_bars_used FROM turn)"""


def grid() -> str:
    both = ", ".join(f"round(max(CASE WHEN bench = '{n}' THEN {c} END), 6) AS {c}_{n}" for n in ("topix", "nikkei") for c in ("rs31", "rs63", "rs126", "rs252", "rs_acceleration"))
    return f"""WITH {TURN}, {ASOF.split(',', 0)[0][len(BARS) + 2:]}, rs AS (SELECT code, bench, date, {rs(31, 63, 126, 252)} FROM asof_),
 rl AS (SELECT *, rs31 - rs252 AS rs_acceleration FROM {at_run('rs', 'code, bench')}), wide AS (SELECT code, {both} FROM rl GROUP BY code),
 grid AS (SELECT code, {r6('z_turnover_60', 'turnover_ma_ratio_60', 'price_change_pct')}, wide.* EXCLUDE (code) FROM {at_run('turn2', 'code')} JOIN wide USING (code))"""


def sliced(first: int, last: int) -> str:
    return f"""{ASOF}, anchor AS (SELECT code, bench, max(pos) AS p FROM axis WHERE date <= {RUN} GROUP BY 1, 2),
 cut AS (SELECT axis.*, p FROM axis JOIN anchor USING (code, bench) WHERE pos BETWEEN p - {first} AND p - {last}),
 fil AS (SELECT *, last_value(stock_close IGNORE NULLS) OVER ({W} ROWS UNBOUNDED PRECEDING) AS fs, last_value(bench_close IGNORE NULLS) OVER ({W} ROWS UNBOUNDED PRECEDING) AS fb FROM cut),
 r0 AS (SELECT code, bench, fs / nullif(lag(fs) OVER ({W}), 0) - 1 AS rs, fb / nullif(lag(fb) OVER ({W}), 0) - 1 AS rb FROM fil), r AS (SELECT * FROM r0 WHERE rs IS NOT NULL AND rb IS NOT NULL)"""


def candle(textbook: bool = False, frame: bool = False) -> str:
    """Bars with range shares, the smoothed range before each bar (span 14: a closed form of its recursion), and the 252-row rank."""
    x = "prev_close" if textbook else "CASE WHEN lead(k) OVER (PARTITION BY code ORDER BY date) IS NOT NULL THEN close END" if frame else "CAST(NULL AS DOUBLE)"
    return f"""{BARS}, c0 AS (SELECT *, lag(close) OVER w AS prev_close, lag(high) OVER w AS prev_high, lag(low) OVER w AS prev_low, row_number() OVER w AS k FROM bars WINDOW w AS (PARTITION BY code ORDER BY date)),
 c1 AS (SELECT *, {x} AS x FROM c0), c2 AS (SELECT *, greatest(high - low, abs(high - x), abs(low - x)) AS tr FROM c1),
 c2a AS (SELECT *, pow(13.0::DOUBLE / 15, k - 1) * sum(CASE WHEN k = 1 THEN tr ELSE 2.0::DOUBLE / 15 * tr * pow(15.0::DOUBLE / 13, k - 1) END) OVER (PARTITION BY code ORDER BY date) AS e14 FROM c2),
 c3 AS (SELECT *, CAST(sign(close - open) AS INT) AS direction, abs(close - open) / nullif(tr, 0) AS br, (high - greatest(open, close)) / nullif(tr, 0) AS ur, (least(open, close) - low) / nullif(tr, 0) AS dr,
 open - x AS gap, CASE WHEN high > low THEN (close - low) / (high - low) END AS close_pos, CAST(close = high AS INT) AS hit_high, CAST(close = low AS INT) AS hit_low, lag(e14) OVER (PARTITION BY code ORDER BY date) AS atr FROM c2a),
 c3a AS (SELECT *, tr / nullif(atr, 0) AS sr, abs(gap) / nullif(atr, 0) AS gap_atr FROM c3),
 c4 AS (SELECT *, list(sr) FILTER (sr IS NOT NULL) OVER (PARTITION BY code ORDER BY date ROWS 251 PRECEDING) AS seen FROM c3a),
 c5 AS (SELECT *, CASE WHEN sr IS NOT NULL AND len(seen) >= 20 THEN (len(list_filter(seen, lambda v: v < sr)) + (len(list_filter(seen, lambda v: v = sr)) + 1) / 2.0) / len(seen) END AS q_sr FROM c4)"""


def limit_case(c: str) -> str:
    """Daily limit of a previous close, as the exchange's steps (below this price: this limit)."""
    steps = "100 30, 200 50, 500 80, 700 100, 1000 150, 1500 300, 2000 400, 3000 500, 5000 700, 7000 1000, 10000 1500, 15000 3000, 20000 4000, 30000 5000, 50000 7000, 70000 10000, 100000 15000, 150000 30000, 200000 40000, 300000 50000, 500000 70000, 700000 100000, 1000000 150000, 1500000 300000, 2000000 400000, 3000000 500000, 5000000 700000, 7000000 1000000, 10000000 1500000, 15000000 3000000, 20000000 4000000, 30000000 5000000, 50000000 7000000"
    return "CASE " + " ".join("WHEN {} < {} THEN {}".format(c, *step.split()) for step in steps.split(", ")) + f" WHEN {c} IS NOT NULL THEN 10000000 END"


def label_rows(textbook: bool = False) -> str:
    return f"""{candle(textbook)}, l0 AS (SELECT *, CAST({limit_case('prev_close')} AS DOUBLE) AS lim FROM c5), l1 AS (SELECT *, prev_close + lim AS hi, prev_close - lim AS lo FROM l0),
 l2 AS (SELECT *, CASE WHEN high <= lo AND open <= lo AND close <= lo AND low <= lo THEN 'LIMIT_LOW_FULL_STUCK' WHEN high >= hi AND open >= hi AND close >= hi AND low >= hi THEN 'LIMIT_HIGH_FULL_STUCK'
 WHEN low <= lo AND open <= lo AND close > lo THEN 'LIMIT_LOW_OPEN_ONLY' WHEN high >= hi AND open >= hi AND close < hi THEN 'LIMIT_HIGH_OPEN_ONLY' WHEN low <= lo AND close <= lo THEN 'LIMIT_LOW_TOUCH_STUCK'
 WHEN high >= hi AND close >= hi THEN 'LIMIT_HIGH_TOUCH_STUCK' WHEN low <= lo THEN 'LIMIT_LOW_TOUCH' WHEN high >= hi THEN 'LIMIT_HIGH_TOUCH' END AS limit_label FROM l1),
 lab AS (SELECT code, date, CASE WHEN k < 2 THEN '' ELSE concat_ws(',', limit_label, CASE WHEN tr = 0 AND limit_label IS NULL THEN 'INVALID_TR0' END,
 CASE WHEN gap_atr >= 5 OR (gap_atr IS NOT NULL AND open - gap <> 0 AND abs(gap / (open - gap)) >= 0.30) THEN 'ACTION_SUSPECT' END, CASE WHEN gap_atr >= 1.0 AND tr > 0 AND abs(gap) / tr >= 0.6 THEN 'GAP_DOMINANT' END,
 CASE WHEN q_sr >= 0.95 THEN 'RANGE_VERY_LARGE' WHEN q_sr >= 0.85 THEN 'RANGE_LARGE' WHEN q_sr < 0.15 THEN 'RANGE_VERY_SMALL' WHEN q_sr < 0.40 THEN 'RANGE_SMALL' END,
 CASE WHEN br IS NULL THEN NULL WHEN br <= 0.10 THEN 'DOJI' WHEN br >= 0.70 THEN CASE WHEN greatest(ur, dr) <= 0.15 THEN 'BODY_MARUBOZU_LIKE' END WHEN br >= 0.55 THEN 'BODY_LONG' WHEN br <= 0.25 THEN 'BODY_SMALL' ELSE 'BODY_MIDDLE' END,
 CASE WHEN ur >= 0.45 AND dr >= 0.45 THEN 'WICK_BOTH_LONG' WHEN ur >= 0.25 AND dr >= 0.25 THEN 'WICK_BOTH_PRESENT' WHEN ur >= 0.45 THEN 'WICK_UPPER_LONG' WHEN dr >= 0.45 THEN 'WICK_LOWER_LONG' WHEN ur >= 0.25 THEN 'WICK_UPPER_PRESENT' WHEN dr >= 0.25 THEN 'WICK_LOWER_PRESENT' END,
 CASE WHEN coalesce(br > 0.10, true) THEN CASE WHEN direction > 0 THEN 'DIR_BULL' WHEN direction < 0 THEN 'DIR_BEAR' END END,
 CASE WHEN prev_high < low THEN 'GAP_UP' WHEN prev_low > high THEN 'GAP_DOWN' END) END AS candle_labels FROM l2)"""


#: Text of the labels ``p``: a limit or an anomaly alone, else window, size, wick, body and direction in a row.
PRICE_TEXT = """CASE WHEN list_contains(p, 'LIMIT_HIGH_TOUCH') THEN 'S高タッチ疑い' WHEN list_contains(p, 'LIMIT_LOW_TOUCH') THEN 'S安タッチ疑い' WHEN list_contains(p, 'LIMIT_HIGH_TOUCH_STUCK') THEN 'S高タッチ後張付き疑い'
 WHEN list_contains(p, 'LIMIT_LOW_TOUCH_STUCK') THEN 'S安タッチ後張付き疑い' WHEN list_contains(p, 'LIMIT_HIGH_OPEN_ONLY') THEN 'S高寄天疑い' WHEN list_contains(p, 'LIMIT_LOW_OPEN_ONLY') THEN 'S安寄底疑い'
 WHEN list_contains(p, 'LIMIT_HIGH_FULL_STUCK') THEN 'S高完全張り付き疑い' WHEN list_contains(p, 'LIMIT_LOW_FULL_STUCK') THEN 'S安完全張り付き疑い' WHEN list_contains(p, 'INVALID_TR0') THEN 'レンジ0' WHEN list_contains(p, 'ACTION_SUSPECT') THEN '構造要因疑い'
 ELSE concat(CASE WHEN list_contains(p, 'GAP_DOMINANT') THEN 'ギャップ主導' END, CASE WHEN list_contains(p, 'GAP_UP') THEN '上窓＋' WHEN list_contains(p, 'GAP_DOWN') THEN '下窓＋' END,
 CASE WHEN list_contains(p, 'RANGE_VERY_LARGE') THEN '<極大>' WHEN list_contains(p, 'RANGE_LARGE') THEN '<大>' WHEN list_contains(p, 'RANGE_SMALL') THEN '<小>' WHEN list_contains(p, 'RANGE_VERY_SMALL') THEN '<極小>' END,
 CASE WHEN list_contains(p, 'WICK_BOTH_LONG') THEN '長上下ヒゲ' WHEN list_contains(p, 'WICK_BOTH_PRESENT') THEN '上下ヒゲ' WHEN list_contains(p, 'WICK_UPPER_LONG') THEN '長上ヒゲ' WHEN list_contains(p, 'WICK_LOWER_LONG') THEN '長下ヒゲ' WHEN list_contains(p, 'WICK_UPPER_PRESENT') THEN '上ヒゲ' WHEN list_contains(p, 'WICK_LOWER_PRESENT') THEN '下ヒゲ' END,
 CASE WHEN list_contains(p, 'DOJI') THEN '十字線' WHEN list_contains(p, 'BODY_MARUBOZU_LIKE') THEN '丸坊主' WHEN list_contains(p, 'BODY_LONG') THEN '長' WHEN list_contains(p, 'BODY_SMALL') THEN '短' WHEN list_contains(p, 'BODY_MIDDLE') THEN '中' END,
 CASE WHEN list_contains(p, 'DOJI') THEN '' WHEN list_contains(p, 'DIR_BULL') THEN '陽線' WHEN list_contains(p, 'DIR_BEAR') THEN '陰線' END) END"""


def event_scores(mode: str) -> str:
    if mode == "v1":
        w = {"time": 0.24, "specificity": 0.20, "material": 0.20, "source": 0.12, "novelty": 0.12, "alignment": 0.08, "confidence": 0.04}
    else:
        w = {"time": 0.22, "source": 0.16, "specificity2": 0.10, "channel": 0.16, "category": 0.12, "structure": 0.06, "name": 0.16, "confidence": 0.02}
    cat = "CASE cat WHEN '開示' THEN 1.0 WHEN '業績' THEN 0.85 WHEN '材料' THEN 0.8 WHEN '市況' THEN 0.4 WHEN 'テク' THEN 0.25 WHEN '注目' THEN 0.0 WHEN '特集' THEN 0.0 ELSE 0.5 END"
    parts = {
        "time": "CASE WHEN days < 0 THEN 0.0 WHEN days = 0 THEN 1.0 WHEN days = 1 THEN 0.9 WHEN days <= 5 THEN 0.6 WHEN days <= 20 THEN 0.35 ELSE 0.1 END",
        "specificity": "CASE WHEN event_id % 2 = 0 THEN 1.0 ELSE 0.55 END",
        "material": "CASE event_type WHEN 'purchase' THEN 0.95 WHEN 'signup' THEN 0.65 WHEN 'click' THEN 0.25 ELSE 0.45 END",
        "source": "CASE event_id % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 0.72 ELSE 0.55 END",
        "novelty": "1.0",
        "alignment": "CASE WHEN value > 50 THEN 1.0 ELSE 0.1 END",
        "confidence": "0.5",
        "specificity2": "CASE WHEN event_id % 3 = 0 THEN 1.0 WHEN event_id % 3 = 1 AND event_id % 4 = 0 THEN 0.85 WHEN cat IN ('開示', '材料') THEN 0.68 ELSE 0.25 END",
        "channel": "(CASE WHEN event_id % 3 = 0 THEN CASE WHEN event_id % 6 = 0 THEN 1.0 ELSE 0.9 END WHEN event_id % 3 = 1 AND event_id % 4 = 0 THEN 0.78 WHEN event_id % 3 = 1 AND event_id % 4 = 1 THEN 0.5 ELSE 0.4 END - CASE WHEN cat = '市況' THEN 0.2 ELSE 0.0 END)",
        "category": cat,
        "structure": "least(1.0, 0.5 + CASE WHEN event_id % 3 = 0 THEN 0.15 ELSE 0.0 END + CASE WHEN event_id % 4 = 0 THEN 0.1 ELSE 0.0 END + CASE WHEN event_id % 6 = 0 THEN 0.2 ELSE 0.0 END - CASE WHEN event_id % 7 = 0 THEN 0.2 ELSE 0.0 END)",
        "name": "CASE WHEN user_id % 3 < 2 AND user_id % 5 = user_id % 7 THEN 1.0 ELSE 0.0 END",
    }
    if mode == "v2":
        parts["source"] = f"greatest(0.0, least(1.0, {parts['source']} + CASE event_id % 10 WHEN 3 THEN 0.1 WHEN 4 THEN -0.15 ELSE 0.0 END))"
    total = " + ".join(f"CAST({parts[k]} AS DOUBLE) * CAST({x} AS DOUBLE)" for k, x in w.items())
    return f"""e0 AS (SELECT *, CAST((SELECT max(ts) FROM events) AS DATE) - CAST(ts AS DATE) AS days, CASE event_id % 5 WHEN 0 THEN '開示' WHEN 1 THEN '市況' ELSE '材料' END AS cat FROM events),
 e1 AS (SELECT user_id, event_id, round({total}, 6) AS cause_score, CAST({parts['specificity']} AS DOUBLE) AS spec, CAST({parts['material']} AS DOUBLE) AS mat,
 round(CAST({parts['name']} AS DOUBLE), 6) AS score_name, round(CAST({parts['channel']} AS DOUBLE), 6) AS score_channel, round(CAST({parts['structure']} AS DOUBLE), 6) AS score_structure, round(CAST({parts['category']} AS DOUBLE), 6) AS score_category FROM e0),
 ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY cause_score DESC, event_id) AS rank FROM e1)"""


CAUSE = f"""WITH {event_scores('v1')}, top AS (SELECT * FROM ranked WHERE rank = 1),
 cause AS (SELECT c_custkey AS code, CASE WHEN cause_score IS NULL OR cause_score < 0.55 THEN 'C' WHEN spec >= 0.8 AND mat >= 0.6 THEN 'A' ELSE 'B' END AS cause_type, coalesce(cause_score, 0.0) AS cause_score FROM customer LEFT JOIN top ON user_id = c_custkey)"""
MEDIAN = "med AS (SELECT o_custkey, CASE WHEN count(*) >= 5 THEN median(o_totalprice) END AS median_value FROM (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) <= 5) GROUP BY 1)"
SEGMENT = f"""WITH {MEDIAN}, stat AS (SELECT o_custkey, count(*) AS n, last(o_orderstatus ORDER BY o_orderdate, o_orderkey) AS st FROM orders GROUP BY 1),
 s AS (SELECT c_custkey, coalesce(n, 0) AS n, median_value AS m, CASE WHEN st IS NULL THEN 'missing' WHEN st = 'O' THEN 'ok' WHEN st = 'F' THEN 'stale' ELSE 'failed' END AS status FROM customer LEFT JOIN stat ON c_custkey = stat.o_custkey LEFT JOIN med ON c_custkey = med.o_custkey),
 seg AS (SELECT c_custkey, CASE WHEN status IN ('failed', 'missing') THEN 'ipo' WHEN NOT (status = 'stale' AND n >= 8) AND (status <> 'ok' OR n < 8) THEN 'ipo' WHEN m IS NULL OR m < 150000 THEN 'illiquid' ELSE 'core' END AS segment FROM s)"""
DAYS = "SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, max(o_totalprice) AS v FROM orders GROUP BY 1, 2"
STATUS = "CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failed' ELSE 'running' END"


ALIAS = "CASE p_partkey % 3 WHEN 0 THEN '東証P ' || p_name WHEN 1 THEN p_name || ' quote' ELSE left(p_brand, 4) END"


def axis_days() -> str:
    """All metrics of the last 60 sessions, each from its own rows or axis."""
    names = ("topix", "nikkei")
    cols = ("rs31", "rs63", "rs126", "rs252", "rs_acceleration", "rs_acceleration_zscore")
    wide = ", ".join(f"round(max(CASE WHEN bench = '{n}' THEN {c} END), 6) AS {c}_{n}" for n in names for c in cols)
    sma = ", ".join(f"round(max(CASE WHEN bench = '{n}' THEN sma END), 6) AS rs_sma75_{n}" for n in names)
    over = "(PARTITION BY code, bench ORDER BY date ROWS 59 PRECEDING)"
    avg = lambda key: f"CASE WHEN count(close) OVER (PARTITION BY {key} ORDER BY date ROWS 74 PRECEDING) = 75 THEN avg(close) OVER (PARTITION BY {key} ORDER BY date ROWS 74 PRECEDING) END"
    return f"""WITH {TURN}, {ASOF[len(BARS) + 2:]},
 r1 AS (SELECT code, bench, date, stock_close, {rs(31, 63, 126, 252)} FROM asof_), r2 AS (SELECT *, rs31 - rs252 AS rs_acceleration FROM r1),
 r3 AS (SELECT *, CASE WHEN count(rs_acceleration) OVER {over} >= 42 AND stddev_samp(rs_acceleration) OVER {over} > 0 THEN (last_value(rs_acceleration IGNORE NULLS) OVER {over} - avg(rs_acceleration) OVER {over}) / stddev_samp(rs_acceleration) OVER {over} END AS rs_acceleration_zscore FROM r2),
 wide AS (SELECT code, date, {wide} FROM r3 GROUP BY code, date),
 ms AS (SELECT * FROM (SELECT code, date, {avg('code')} AS close FROM bars) WHERE close IS NOT NULL), mb AS (SELECT * FROM (SELECT bench, date, {avg('bench')} AS close FROM bench) WHERE close IS NOT NULL),
 ma AS (SELECT code, bench, date, a.close AS x, b.close AS y FROM (SELECT code, bench, date, ms.close FROM ms, (SELECT DISTINCT bench FROM mb)) a FULL JOIN (SELECT code, bench, date, mb.close FROM mb, (SELECT DISTINCT code FROM ms)) b USING (code, bench, date)),
 mf AS (SELECT code, bench, date, last_value(x IGNORE NULLS) OVER ({W} ROWS UNBOUNDED PRECEDING) AS s, last_value(y IGNORE NULLS) OVER ({W} ROWS UNBOUNDED PRECEDING) AS b FROM ma),
 mr AS (SELECT code, bench, date, {ret('s', 31)} - {ret('b', 31)} AS sma FROM mf), msma AS (SELECT code, date, {sma} FROM mr GROUP BY code, date),
 days AS (SELECT DISTINCT date FROM bench WHERE bench = 'topix' AND date <= {RUN} ORDER BY date DESC LIMIT 60), every AS (SELECT code, date FROM (SELECT DISTINCT code FROM bars), days)
 SELECT every.code, every.date, round(turn2.z_turnover_60, 6) AS z_turnover_60, {", ".join(f"CASE WHEN turn2.code IS NOT NULL THEN {c}_{n} END AS {c}_{n}" for n in names for c in (*cols, "rs_sma75"))}
 FROM every LEFT JOIN turn2 USING (code, date) LEFT JOIN wide USING (code, date) LEFT JOIN msma USING (code, date)"""


def all_sql() -> dict[str, str]:
    return {
        "bars": f"WITH {BARS} SELECT * FROM bars",
        "benches": f"WITH {BENCH} SELECT * FROM bench",
        "union_axis": f"WITH {AXIS} SELECT code, bench, count(*) AS n, count(stock_close) AS n_stock, count(bench_close) AS n_bench, CAST(max(pos) AS INT) AS last_pos FROM axis GROUP BY 1, 2",
        "asof_close": f"WITH {ASOF} SELECT code, bench, date, s AS stock_asof, b AS bench_asof FROM asof_",
        "relative_strength": f"WITH {ASOF}, rs AS (SELECT code, bench, date, {rs(31, 63, 126, 252)} FROM asof_) SELECT code, bench, date, {r6('rs31', 'rs63', 'rs126', 'rs252')} FROM {at_run('rs', 'code, bench')}",
        "rs_series": f"WITH {ASOF}, rs AS (SELECT code, bench, date, {rs(31)} FROM asof_) SELECT code, bench, date, {r6('rs31')} FROM rs",
        "rs_acceleration": f"WITH {ASOF}, rs AS (SELECT code, bench, date, {rs(31, 252)} FROM asof_), a AS (SELECT code, bench, date, rs31 - rs252 AS rs_acceleration FROM rs), z AS (SELECT code, bench, date, rs_acceleration, CASE WHEN count(rs_acceleration) OVER l >= 42 AND stddev_samp(rs_acceleration) OVER l > 0 THEN (last_value(rs_acceleration IGNORE NULLS) OVER l - avg(rs_acceleration) OVER l) / stddev_samp(rs_acceleration) OVER l END AS rs_acceleration_zscore FROM a WINDOW l AS ({W} ROWS 59 PRECEDING)) SELECT code, bench, {r6('rs_acceleration', 'rs_acceleration_zscore')} FROM {at_run('z', 'code, bench')}",
        "beta_adjusted_rs": f"WITH {sliced(377, 252)}, beta AS (SELECT code, bench, CASE WHEN count(*) >= 88 AND var_pop(rb) > 0 THEN covar_pop(rs, rb) / var_pop(rb) END AS beta FROM r GROUP BY 1, 2), tot AS (SELECT code, bench, pos, {ret('s', 252)} AS r_s, {ret('b', 252)} AS r_b FROM asof_) SELECT code, bench, round(beta, 6) AS beta, round(r_s - beta * r_b, 6) AS beta_adjusted_rs FROM tot JOIN anchor USING (code, bench) LEFT JOIN beta USING (code, bench) WHERE pos = p",
        "information_ratio": f"WITH {sliced(62, 0)} SELECT code, bench, round(CASE WHEN count(*) >= 44 AND stddev_samp(rs - rb) > 0 THEN avg(rs - rb) / stddev_samp(rs - rb) END, 6) AS information_ratio FROM r GROUP BY 1, 2",
        "sma75_rs": f"WITH {AXIS}, m AS (SELECT code, bench, date, CASE WHEN count(stock_close) OVER l = 75 THEN avg(stock_close) OVER l END AS ss, CASE WHEN count(bench_close) OVER l = 75 THEN avg(bench_close) OVER l END AS sb FROM axis WINDOW l AS ({W} ROWS 74 PRECEDING)), m2 AS (SELECT code, bench, date, last_value(ss IGNORE NULLS) OVER ({W} ROWS UNBOUNDED PRECEDING) AS s, last_value(sb IGNORE NULLS) OVER ({W} ROWS UNBOUNDED PRECEDING) AS b FROM m WHERE ss IS NOT NULL OR sb IS NOT NULL), m3 AS (SELECT code, bench, date, {ret('s', 31)} - {ret('b', 31)} AS rs_sma75 FROM m2) SELECT code, bench, round(rs_sma75, 6) AS rs_sma75 FROM {at_run('m3', 'code, bench')}",
        "turnover": f"WITH {TURN} SELECT code, date, {r6('turnover_yen', 'z_turnover_60', 'turnover_ma_ratio_60', 'price_change_pct')}, n_bars_used FROM {at_run('turn2', 'code')}",
        "perfect_order": f"WITH {BARS}, p AS (SELECT code, date, row_number() OVER w AS k, " + ", ".join(f"CASE WHEN count(close) OVER (PARTITION BY code ORDER BY date ROWS {n - 1} PRECEDING) = {n} THEN round(avg(close) OVER (PARTITION BY code ORDER BY date ROWS {n - 1} PRECEDING), 9) END AS a{n}" for n in (25, 75, 200)) + " FROM bars WHERE date <= DATE '1998-05-29' WINDOW w AS (PARTITION BY code ORDER BY date)) SELECT code, CASE WHEN max(k) >= 220 AND max(date) = DATE '1998-05-29' THEN CAST(max(k) - coalesce(max(k) FILTER (NOT coalesce(a25 > a75 AND a75 > a200, false)), 0) AS INT) END AS perfect_order_days FROM p GROUP BY 1",
        "indicator_grid": f"{grid()} SELECT * FROM grid",
        "all_negative": f"{grid()} SELECT code FROM grid WHERE rs31_topix < 0 AND rs63_topix < 0",
        "benchmark_switch": f"{grid()} SELECT code, rs31_nikkei FROM grid",
        "snapshot_flags": f"{grid()} SELECT code, concat_ws(',', CASE WHEN z_turnover_60 IS NULL THEN 'z_turnover_60' END, CASE WHEN rs31_topix IS NULL THEN 'rs31_topix' END, CASE WHEN rs252_nikkei IS NULL THEN 'rs252_nikkei' END) AS missing, '' AS non_finite FROM grid",
        "null_ratio": f"WITH {ASOF}, rs AS (SELECT {rs(31, 63, 126, 252)} FROM asof_), n AS (SELECT count(*) AS n_rows, 4 * count(*) - count(rs31) - count(rs63) - count(rs126) - count(rs252) AS n_null FROM rs) SELECT n_rows, n_null, round(n_null / (4.0 * n_rows), 6) AS null_ratio FROM n",
        "candle_features": f"WITH {candle(frame=True)} SELECT code, date, tr, direction, {r6('br', 'ur', 'dr', 'gap', 'close_pos')}, hit_high, hit_low FROM c5",
        "true_range_textbook": f"WITH {candle(True)} SELECT code, date, tr, {r6('gap')} FROM c5",
        "range_rank": f"WITH {candle(frame=True)} SELECT code, date, {r6('gap_atr', 'q_sr')} FROM c5",
        "smoothed_range": f"WITH {candle()} SELECT code, round(atr, 6) AS atr FROM c5 QUALIFY row_number() OVER (PARTITION BY code ORDER BY date DESC) = 1",
        "limit_lookup": f"SELECT o_orderkey, CAST({limit_case('o_totalprice')} AS DOUBLE) AS limit_range FROM orders",
        "candle_labels": f"WITH {label_rows()} SELECT * FROM lab",
        "candle_labels_textbook": f"WITH {label_rows(True)}, t AS (SELECT *, string_split(candle_labels, ',') AS p FROM lab) SELECT code, date, candle_labels, {PRICE_TEXT} AS price_text FROM t",
        "gap_swap": f"WITH {label_rows()} SELECT code, date, replace(replace(replace(candle_labels, 'GAP_UP', 'GAP_X'), 'GAP_DOWN', 'GAP_UP'), 'GAP_X', 'GAP_DOWN') AS swapped FROM lab",
        "universe_class": "SELECT CASE WHEN contains(p_type, 'ECON') THEN 'economy' WHEN contains(p_type, 'STAND') THEN 'standard' WHEN p_type = 'PROMO' THEN 'promo' WHEN contains(p_type, 'SMALL') THEN 'small' WHEN p_type = 'LARGE' THEN 'large' ELSE 'unknown' END AS cls, count(*) AS n, count(DISTINCT p_brand) AS brands FROM part GROUP BY 1",
        "duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
        "trailing_median": f"WITH {MEDIAN} SELECT * FROM med",
        "segment": f"{SEGMENT} SELECT * FROM seg",
        "segment_counts": f"{SEGMENT} SELECT segment, count(*) AS n FROM seg GROUP BY 1",
        "pick_as_of": "SELECT CAST(o_orderdate AS DATE) AS snapshot_date, o_orderkey AS run_id, 'as_of' AS picked FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '1996-02-29' ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1",
        "pick_fallback": "SELECT CAST(o_orderdate AS DATE) AS snapshot_date, o_orderkey AS run_id, 'fallback_latest' AS picked FROM orders ORDER BY o_orderkey LIMIT 1",
        "winners": "SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderkey AS run_id, o_orderkey = last(o_orderkey) OVER w AS is_winner, last(o_orderkey) OVER w AS winner FROM orders WINDOW w AS (PARTITION BY strftime(o_orderdate, '%Y-%m') ORDER BY CAST(o_orderdate AS DATE), o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)",
        "core_delta": "WITH a AS (SELECT DISTINCT o_custkey FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1997-03'), b AS (SELECT DISTINCT o_custkey FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1997-02') SELECT *, 'added' AS change FROM (FROM a EXCEPT FROM b) UNION ALL SELECT *, 'removed' FROM (FROM b EXCEPT FROM a)",
        "delisted_patch": "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-03-15')",
        "semi_members": "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)",
        "latest_per_key": "SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1",
        "last_line_wins": "SELECT user_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1",
        "event_scores": f"WITH {event_scores('v1')} SELECT user_id, event_id, cause_score, rank FROM ranked",
        "event_scores_v2": f"WITH {event_scores('v2')} SELECT user_id, event_id, cause_score, rank, score_name, score_channel, score_structure, score_channel AS score_material, score_category AS score_novelty FROM ranked",
        "cause_type": f"{CAUSE} SELECT * FROM cause",
        "enriched": f"""{CAUSE}, said AS (SELECT code, cause_type, CASE WHEN code % 2 = 0 THEN 'top ' || code ELSE '' END AS top FROM cause WHERE code % 5 > 0),
 got AS (SELECT c_custkey, cause_type, top, r1.event_id AS e1, r1.cause_score AS s1, r2.event_id AS e2, r2.cause_score AS s2, r1.event_id % 4 = 0 AND top = '' AS lost FROM customer LEFT JOIN said ON said.code = c_custkey LEFT JOIN ranked r1 ON r1.user_id = c_custkey AND r1.rank = 1 LEFT JOIN ranked r2 ON r2.user_id = c_custkey AND r2.rank = 2),
 flag AS (SELECT *, cause_type IS NOT NULL AND cause_type <> 'C' AS ok FROM got)
 SELECT 'C' || c_custkey AS code, CASE WHEN cause_type IS NULL THEN '' WHEN ok AND lost THEN 'C' ELSE cause_type END AS event_cause_type,
 CASE WHEN cause_type IS NULL THEN '' WHEN NOT ok OR lost THEN '材料不明・需給起因疑い' WHEN e1 IS NULL OR e1 % 4 = 0 THEN top ELSE 'event ' || e1 END AS event_news_1_title, CASE WHEN ok AND e1 IS NOT NULL AND NOT lost THEN '/e/' || e1 ELSE '' END AS event_news_1_url,
 CASE WHEN ok AND e1 IS NOT NULL THEN CASE e1 % 3 WHEN 0 THEN 'tdnet' WHEN 1 THEN 'kabutan' ELSE 'other' END ELSE '' END AS event_news_1_source, CASE WHEN ok THEN s1 END AS event_news_1_score,
 CASE WHEN ok AND e2 % 4 > 0 THEN 'event ' || e2 ELSE '' END AS event_news_2_title, CASE WHEN ok AND e2 IS NOT NULL THEN '/e/' || e2 ELSE '' END AS event_news_2_url,
 CASE WHEN ok AND e2 IS NOT NULL THEN CASE e2 % 3 WHEN 0 THEN 'tdnet' WHEN 1 THEN 'kabutan' ELSE 'other' END ELSE '' END AS event_news_2_source, CASE WHEN ok THEN s2 END AS event_news_2_score FROM flag""",
        "event_dedup": "SELECT user_id, event_type, CAST(ts AS DATE) AS d, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY (event_id % 7 = 0) DESC, value DESC, event_id) = 1",
        "event_window": "SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events WHERE ts <= TIMESTAMP '2024-01-20 15:00:00' GROUP BY 1",
        "title_type": "SELECT doc_id, CASE WHEN contains(t, 'idiot') OR contains(t, 'moron') THEN 'insult' WHEN contains(t, 'the ') OR contains(t, 'and ') THEN 'english' WHEN contains(t, 'der ') OR contains(t, 'und ') THEN 'german' WHEN contains(t, 'que') THEN 'romance' ELSE 'other' END AS tag FROM (SELECT doc_id, lower(text) AS t FROM documents)",
        "selection": "SELECT c_custkey FROM customer WHERE c_acctbal > 9000 OR starts_with(c_mktsegment, 'AUTO')",
        "grid_filters": "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal BETWEEN 1000 AND 5000 AND contains(lower(c_mktsegment), 'b') AND c_name IS NOT NULL",
        "grid_sort": "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS balance FROM customer",
        "preview": "SELECT c_custkey, round(c_acctbal, -2) AS balance FROM customer QUALIFY rank() OVER (ORDER BY round(c_acctbal, -2) DESC) <= 20",
        "top_per_key": "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 2",
        "codes": "WITH s AS (SELECT s_suppkey, CAST(s_suppkey AS VARCHAR) AS c, upper(CAST(s_suppkey AS VARCHAR) || CASE WHEN s_suppkey % 2 = 0 THEN '0' ELSE 'a' END) AS p, CAST(s_suppkey AS VARCHAR) || CASE WHEN s_suppkey % 2 = 0 THEN '0' ELSE 'a' END AS q FROM supplier) SELECT s_suppkey, CASE WHEN length(c) < 4 THEN lpad(c, 4, '0') ELSE c END AS universe_code, CASE WHEN length(c) < 4 THEN lpad(c, 4, '0') ELSE c END AS metric_code, CASE WHEN regexp_full_match(p, '[0-9A-Z]{4,5}') THEN CASE WHEN length(p) = 5 AND ends_with(p, '0') THEN left(p, 4) ELSE p END END AS alias_code, CASE WHEN length(q) = 5 AND ends_with(q, '0') THEN left(q, 4) ELSE q END AS filing_code, p AS joined_code FROM s",
        "half_width": "SELECT p_partkey, 'A1 ' || p_name AS name, p_partkey || '.T' AS ticker FROM part",
        "nfc": "SELECT doc_id, length(nfc_normalize(text)) AS n FROM documents",
        "months": "WITH o AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders GROUP BY 1) SELECT o_custkey, datediff('month', a, b) + 1 AS n_months, CAST(date_trunc('month', b - INTERVAL 2 MONTH) AS DATE) AS cutoff FROM o",
        "chunks": "WITH o AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders GROUP BY 1), c AS (SELECT o_custkey, b, a + CAST(i * 399 AS INT) AS s FROM o, range(0, 20) t(i) WHERE a + CAST(i * 399 AS INT) <= b) SELECT o_custkey, s AS chunk_start, least(s + 399, b) AS chunk_end FROM c",
        "key_digest": "SELECT o_custkey, sha256(string_agg(k, chr(10) ORDER BY k)) AS digest, count(*) AS n_keys FROM (SELECT DISTINCT o_custkey, CAST(o_orderkey AS VARCHAR) AS k FROM orders) GROUP BY 1",
        "decimal_text": "SELECT p_partkey, regexp_replace(regexp_replace(CAST(CAST(p_retailprice AS DECIMAL(28, 10)) AS VARCHAR), '0+$', ''), '\\.$', '') AS price FROM part",
        "series_arrays": f"WITH {BARS} SELECT code, string_agg(CAST(date AS VARCHAR), ',' ORDER BY date) AS dates, count(*) AS n, round(sum(close), 2) AS total FROM bars GROUP BY 1",
        "series_merge": f"WITH o AS ({DAYS}), m AS (SELECT o_custkey, CASE WHEN d >= DATE '1995-06-01' THEN -v ELSE v END AS v FROM o) SELECT o_custkey, count(*) AS n, count(*) FILTER (v < 0) AS n_new FROM m GROUP BY 1",
        "series_seed": f"WITH o AS ({DAYS}), m AS (SELECT o_custkey, CASE WHEN d >= DATE '1996-01-01' THEN -v ELSE v END AS v FROM o) SELECT o_custkey, count(*) AS n, count(*) FILTER (v < 0) AS n_new FROM m GROUP BY 1",
        "upsert_latest": "WITH a AS (SELECT o_custkey, CAST(max(o_orderdate) AS DATE) AS d, max(o_orderkey) AS v, o_orderkey % 2 AS i FROM orders GROUP BY 1, 4) SELECT o_custkey, d, v FROM a QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY d DESC, i DESC) = 1",
        "supersede": "WITH o AS (SELECT o_custkey AS k, year(o_orderdate) AS generation, CASE WHEN o_orderstatus = 'F' THEN 'committed' ELSE 'pending' END AS st FROM orders), f AS (SELECT DISTINCT k FROM o WHERE generation = 1996) SELECT CAST(generation AS INT) AS generation, CASE WHEN generation = 1996 THEN 'committed' WHEN st = 'committed' AND k IN (SELECT k FROM f) THEN 'superseded' ELSE st END AS status, count(*) AS n FROM o GROUP BY 1, 2",
        "zip_arrays": "SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey, o_totalprice) - 1 AS n, o_orderkey AS k, o_totalprice AS v FROM orders",
        "axis_series": f"WITH {BARS}, {BENCH}, ax AS (SELECT DISTINCT date FROM bench WHERE date <= {RUN} ORDER BY date DESC LIMIT 60), g AS (SELECT code, ax.date, close FROM (SELECT DISTINCT code FROM bars) CROSS JOIN ax LEFT JOIN bars USING (code, date)) SELECT code, count(*) AS n, count(*) - count(close) AS n_missing, first(close ORDER BY date DESC) AS last_close FROM g GROUP BY 1",
        "runs_by_day": f"SELECT o_orderpriority AS workflow, CAST(o_orderdate AS DATE) AS run_date, {STATUS} AS status, count(*) AS run_count FROM orders GROUP BY 1, 2, 3",
        "success_rates": "SELECT o_orderpriority AS workflow, count(*) FILTER (o_orderstatus = 'F') AS n_success, count(*) FILTER (o_orderstatus = 'O') AS n_failed, CAST(0 AS BIGINT) AS n_cancelled, count(*) FILTER (o_orderstatus IN ('F', 'O')) AS n_terminal, count(*) FILTER (o_orderstatus = 'P') AS n_open, round(count(*) FILTER (o_orderstatus = 'F') / nullif(count(*) FILTER (o_orderstatus IN ('F', 'O')), 0), 4) AS success_rate FROM orders WHERE o_orderdate >= TIMESTAMP '1996-06-01' - INTERVAL 30 DAY GROUP BY 1",
        "stale_running": "SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderdate < TIMESTAMP '1996-01-01'",
        "claimable": "SELECT o_orderkey AS id FROM orders WHERE (o_orderstatus = 'P' OR o_orderdate < TIMESTAMP '1996-01-01') AND o_orderkey % 4 < 3 ORDER BY o_orderdate, o_orderkey LIMIT 50",
        "retention": f"SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders WHERE CAST(o_orderdate AS DATE) >= {RUN} - INTERVAL 12 MONTH GROUP BY 1",
        "sweep_plan": "SELECT o_custkey AS generation, CASE WHEN bool_and(o_orderstatus = 'F') THEN 'orphan_only' WHEN bool_or(o_orderstatus = 'F') THEN 'mixed' ELSE 'no_orphan' END AS plan FROM orders GROUP BY 1",
        "history_quality": "WITH u AS (SELECT o_custkey AS generation, CASE WHEN o_orderstatus = 'F' THEN 'c' WHEN o_orderkey % 11 = 0 THEN 'b' ELSE 'o' END AS s FROM orders) SELECT generation, CASE WHEN bool_or(s = 'b') AND bool_or(s = 'c') THEN 'partial_backfill' WHEN bool_or(s = 'b') THEN 'blocked_backfill' WHEN bool_and(s = 'c') THEN 'full' ELSE 'partial' END AS quality FROM u GROUP BY 1",
        "pair_pointers": "SELECT CAST(o_orderdate AS DATE) AS date, last(o_orderkey ORDER BY o_orderdate, o_orderkey) FILTER (o_orderstatus = 'F') AS topix, last(o_orderkey ORDER BY o_orderdate, o_orderkey) FILTER (o_orderstatus <> 'F') AS nikkei, count(*) FILTER (o_orderstatus = 'F') > 0 AND count(*) FILTER (o_orderstatus <> 'F') > 0 AS complete FROM orders GROUP BY 1",
        "merge_aliases": "WITH o AS (SELECT o_custkey AS code, substr(o_orderpriority, 3, 20) AS k, o_orderkey AS ordinal, o_orderpriority AS alias, o_orderkey % 5 AS seen, o_orderkey % 3 AS conf, o_orderstatus AS st FROM orders), x AS (SELECT DISTINCT code, k FROM o WHERE st = 'P'), n AS (SELECT *, row_number() OVER (PARTITION BY code, k ORDER BY conf DESC, seen DESC, lower(alias), ordinal) AS i, max(conf) OVER (PARTITION BY code, k) AS best FROM o WHERE st <> 'P') SELECT n.code, ordinal, CASE WHEN x.code IS NOT NULL THEN 'skip' WHEN conf = 0 THEN CASE WHEN best > 0 THEN 'skip' ELSE 'review' END WHEN i = 1 THEN 'add' ELSE 'skip' END AS action FROM n LEFT JOIN x ON x.code = n.code AND x.k = n.k",
        "stale_generations": "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F' AND (o_orderkey % 4 = 0 OR o_orderdate < TIMESTAMP '1996-06-01')",
        "high_water": "SELECT o_custkey, greatest(coalesce(max(CAST(o_orderdate AS DATE)) FILTER (o_orderstatus = 'F'), DATE '1996-05-31'), DATE '1996-06-01') AS mark FROM orders GROUP BY 1",
        "favourite_filter": "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) OR c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')",
        "code_contains": "SELECT CAST(s_suppkey AS VARCHAR) AS code FROM supplier WHERE contains(CAST(s_suppkey AS VARCHAR), '1')",
        "projected_rows": "SELECT CASE WHEN c_custkey < 1000 THEN lpad(CAST(c_custkey AS VARCHAR), 4, '0') ELSE CAST(c_custkey AS VARCHAR) END AS code, CASE WHEN c_custkey % 11 > 0 THEN c_name ELSE '' END AS name, CASE WHEN c_custkey % 3 <> 0 THEN round(c_acctbal / 7, 6) END AS rs31, CAST(NULL AS DOUBLE) AS z, CASE WHEN c_custkey % 2 = 0 OR c_custkey % 7 = 0 THEN ' ' || c_mktsegment END AS sector, CASE WHEN c_custkey % 2 = 0 OR c_custkey % 7 = 0 THEN nullif(concat_ws(',', CASE WHEN c_custkey % 4 > 1 THEN 't' || c_custkey || '|/u' END, CASE WHEN c_custkey % 5 = 0 THEN 's|-' END), '') END AS event_news_bundle FROM customer",
        "int_metric": "SELECT p_partkey, CASE WHEN p_partkey % 5 <> 0 AND p_partkey % 2 = 0 THEN CAST(floor(p_retailprice) AS BIGINT) END AS value, p_partkey % 5 <> 0 AND p_partkey % 2 = 1 AS missing, p_partkey % 5 = 0 AS non_finite FROM part",
        "seed_outcome": "SELECT c_custkey AS o_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1996-03-01') THEN 'resolved_noop' ELSE 'write' END AS outcome FROM customer",
        "same_keys": "SELECT c_custkey AS k, 'left' AS only_in FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) UNION ALL SELECT DISTINCT o_custkey, 'right' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)",
        "staged_rows": "SELECT o_custkey AS code, last(o_orderkey ORDER BY year(o_orderdate) * 10 + CAST(left(o_orderpriority, 1) AS INT), o_orderkey) AS ord FROM orders GROUP BY 1",
        "collect_candidates": "WITH a AS (SELECT p_size % 7 AS code, lower(p_brand) || p_size AS k, CASE WHEN p_partkey % 3 = 0 THEN 'tdnet' ELSE 'kabutan' END AS src FROM part), g AS (SELECT code, k, string_agg(DISTINCT src, ',' ORDER BY src) AS sources, count(*) AS n FROM a GROUP BY 1, 2) SELECT CAST(code AS BIGINT) AS code, k AS dedup_key, sources, n + CASE WHEN code = 1 AND k = 'brand#111' THEN 5 ELSE 0 END AS seen_count, CASE WHEN (code = 1 AND k = 'brand#111') OR contains(sources, ',') THEN 'high' ELSE 'medium' END AS confidence, CASE WHEN code = 1 AND k = 'brand#111' THEN 'exists_in_base' ELSE 'new_candidate' END AS reason FROM g",
        "close_rs75": f"WITH {ASOF}, rs AS (SELECT code, bench, date, {rs(75)} FROM asof_) SELECT code, bench, {r6('rs75')} FROM {at_run('rs', 'code, bench')}",
        "lookback_eligible": f"WITH {AXIS} SELECT code, bench, count(stock_close) FILTER (date <= DATE '1995-06-30') >= 105 AND count(bench_close) FILTER (date <= DATE '1995-06-30') >= 105 AS eligible FROM axis GROUP BY 1, 2",
        "require_session": f"WITH {BENCH} SELECT bench, bool_or(date = {RUN}) AS has_bar FROM bench GROUP BY 1",
        "axis_metrics": f"WITH {ASOF}, ax AS (SELECT DISTINCT date FROM bench WHERE date <= {RUN} ORDER BY date DESC LIMIT 60), rs AS (SELECT code, bench, date, {rs(31, 63, 126, 252)} FROM asof_) SELECT code, bench, date, {r6('rs31', 'rs63', 'rs126', 'rs252')} FROM rs WHERE date IN (SELECT date FROM ax)",
        "patched_key": "SELECT CAST(max(o_orderdate) AS DATE) AS d, 'universe-patched-2-HIGH-' || strftime(max(o_orderdate), '%Y-%m-%d') AS key FROM orders WHERE o_orderpriority = '2-HIGH' AND CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1996-03-20'",
        "price_text": f"WITH {label_rows()}, t AS (SELECT *, string_split(candle_labels, ',') AS p FROM lab) SELECT code, date, {PRICE_TEXT} AS price_text FROM t",
        "links": "SELECT n_name AS code, 'https://kabutan.jp/stock/?code=' || n_name AS link_kabutan, 'https://kabutan.jp/stock/chart?code=' || n_name AS link_kabutan_chart, 'https://kabutan.jp/stock/news?code=' || n_name AS link_kabutan_news, 'https://minkabu.jp/stock/' || n_name AS link_minkabu, 'https://www.buffett-code.com/company/' || n_name AS link_buffett, 'https://finance.yahoo.co.jp/quote/' || n_name || '.T' AS link_yahoo FROM nation",
        "history_eligibility": "SELECT o_custkey, CASE WHEN o_custkey < 10 THEN 'expected_short_history' WHEN count(*) >= 10 THEN 'eligible' ELSE 'insufficient' END AS eligibility FROM orders GROUP BY 1",
        "backfill_outcome": "WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(DISTINCT o_custkey) % 60 AS a, count(DISTINCT CAST(o_orderdate AS DATE)) AS d FROM orders GROUP BY 1) SELECT month, CASE WHEN month < '1996-01' THEN 'grandfather' WHEN d <= 5 THEN 'blocked' WHEN a = 0 THEN 'noop' WHEN a > 50 OR d = 0 OR a * d > 900 THEN 'blocked' ELSE 'runnable' END AS outcome, CASE WHEN month < '1996-01' THEN 'before_feature_start' WHEN d <= 5 THEN 'missing_previous_core' WHEN a = 0 THEN NULL WHEN a > 50 THEN 'added_codes_over_limit' WHEN d = 0 THEN 'coverage_empty' WHEN a * d > 900 THEN 'work_units_over_limit' END AS reason FROM m",
        "terminal_status": "SELECT CASE WHEN o_orderstatus = 'P' THEN 'success' WHEN o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN 'failed' ELSE 'success' END AS status, count(*) AS n FROM orders GROUP BY 1",
        "coverage_gate": f"WITH {ASOF}, rs AS (SELECT pos, {rs(31)} FROM asof_), g AS (SELECT count(*) AS n_eligible, avg(CASE WHEN rs31 IS NOT NULL THEN 1.0 ELSE 0.0 END) AS rate FROM rs WHERE pos >= 25) SELECT n_eligible, round(coalesce(rate, 0), 6) AS rate, n_eligible > 0 AND rate >= 0.98 AS allowed FROM g",
        "alias_rules": f"WITH a AS (SELECT p_partkey, {ALIAS} AS alias FROM part), b AS (SELECT *, regexp_replace(lower(trim(alias)), '[\\s・･\\-‐－_／/&＆,，.。]+', '', 'g') AS k FROM a) SELECT p_partkey, k, CASE WHEN starts_with(alias, '東証P ') THEN trim(substr(alias, 5)) ELSE alias END AS stripped, CASE WHEN length(k) <= 1 OR contains(lower(alias), 'quote') OR regexp_full_match(alias, '[A-Za-z]{{1,5}}') THEN 'low' ELSE 'medium' END AS confidence FROM b",
        "logical_digest": """WITH r AS (SELECT n_name AS code, '{"instrument_code":"' || n_name || '","values":[{"metric_key":"share","type":"float","value":"' || regexp_replace(regexp_replace(CAST(CAST(n_nationkey / 4.0 AS DECIMAL(18, 4)) AS VARCHAR), '0+$', ''), '\\.$', '') || '"},{"metric_key":"region","type":"int","value":' || n_regionkey || '}],"flags":{"missing_metrics":[],"non_finite_metrics":[],"po_indeterminate":false}}' AS j FROM nation) SELECT sha256('{"schema_version":1,"trade_date":"2026-01-01","metric_set_version_id":"set","rows":[' || string_agg(j, ',' ORDER BY code) || ']}') AS digest FROM r""",
        "reconcile": "WITH t AS (SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS t FROM lineitem GROUP BY 1) SELECT coalesce(o_orderkey, l_orderkey) AS o_orderkey, CASE WHEN l_orderkey IS NULL THEN 'missing' WHEN o_orderkey IS NULL THEN 'extra' ELSE 'differs' END AS state FROM orders FULL JOIN t ON o_orderkey = l_orderkey WHERE l_orderkey IS NULL OR o_orderkey IS NULL OR abs(o_totalprice - t) > 0.5",
        "events_daily": "SELECT CAST(ts AS DATE) AS d, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2",
        "html_items": "SELECT * FROM (SELECT page_id, len(regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<li>')) AS n FROM pages) WHERE n > 0",
        "stream_first_seen": "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1",
        "stream_latest": "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
        "lease_filter": "SELECT c_custkey AS code FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderdate > TIMESTAMP '2000-01-01')",
        "resolve_unique": "SELECT p_brand, p_size, CASE WHEN count(DISTINCT p_type) = 1 THEN min(p_type) END AS p_type FROM part GROUP BY 1, 2",
        "covering_runs": "SELECT o_orderpriority AS workflow, last(o_orderkey ORDER BY o_orderdate, o_orderkey) AS id FROM orders WHERE o_orderdate >= TIMESTAMP '1996-02-27' AND o_orderdate < TIMESTAMP '1996-03-02' GROUP BY 1",
        "first_source": "SELECT o_custkey AS generation, o_orderpriority AS workflow, o_orderkey AS id FROM orders WHERE o_orderpriority IN ('2-HIGH', '1-URGENT', '5-LOW') QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderpriority WHEN '2-HIGH' THEN 1 WHEN '1-URGENT' THEN 2 ELSE 3 END, o_orderkey DESC) = 1",
        "dictionary_state": "SELECT o_custkey, CAST(coalesce(min(o_orderdate) FILTER (o_orderdate < DATE '1996-01-01'), DATE '1997-01-01') AS DATE) AS first_seen, CAST(CASE WHEN count(*) FILTER (o_orderdate >= DATE '1996-01-01') > 0 THEN DATE '1997-01-01' ELSE max(o_orderdate) END AS DATE) AS last_seen, count(*) AS seen_count, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS sources FROM orders GROUP BY 1",
        "favourites": "WITH f AS (SELECT o_custkey, o_orderpriority, min(o_orderkey) AS k FROM orders GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY min(o_orderkey)) <= 3) SELECT o_custkey, string_agg(o_orderpriority, ',' ORDER BY k) AS codes FROM f GROUP BY 1",
        "available_dates": "SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders ORDER BY d DESC",
        "json_props": "SELECT json_extract_string(props, '$.k') AS k, count(*) AS n FROM events GROUP BY 1",
        "issuer_counts": "SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) <= 2",
        "status_counts": "WITH o AS (SELECT o_custkey, count(*) AS n, CAST(max(o_orderdate) AS DATE) AS l FROM orders GROUP BY 1) SELECT CASE WHEN n < 8 THEN 'insufficient' WHEN l < DATE '1996-01-01' THEN 'stale' ELSE 'ok' END AS status, count(*) AS n FROM o GROUP BY 1",
        "prompt_block": """SELECT p_partkey, '{"銘柄の基本情報":{"観測日":' || CASE WHEN p_partkey % 3 > 0 THEN '"1998-06-01"' ELSE 'null' END || ',"銘柄コード":"' || p_partkey || '","銘柄名":' || CASE WHEN p_partkey % 4 > 0 THEN '"' || p_name || '"' ELSE 'null' END
 || '},"当日の売買代金・値動きの指標":{"当日の売買代金（概算）":' || p_partkey * 1000 || ',"売買代金の異常度（過去60営業日基準のZスコア）":' || CASE WHEN p_partkey % 2 = 0 THEN CAST((p_partkey % 16) / 4 AS VARCHAR) ELSE 'null' END
 || ',"売買代金の平常比（過去60営業日平均に対して何倍か）":' || CAST((p_partkey % 8) / 8 AS VARCHAR) || ',"当日騰落率（前営業日終値比）":' || CAST((p_partkey % 64) / 16 AS VARCHAR) || ',"当日のローソク足形状":null}}' AS block FROM part""",
        "axis_day_metrics": axis_days(),
        "catalogue_snapshot": """WITH p AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 7 > 0 THEN CAST(p_size AS BIGINT) END AS size, CASE WHEN p_partkey % 5 > 0 THEN (p_partkey % 64) / 16 END AS share, p_partkey % 2 = 1 AS odd,
 CASE WHEN p_partkey % 3 > 0 THEN p_brand || 'é' END AS label, CASE WHEN p_partkey % 4 > 0 THEN p_partkey / 8 END AS raw FROM part)
SELECT CASE WHEN k < 1000 THEN lpad(CAST(k AS VARCHAR), 4, '0') ELSE CAST(k AS VARCHAR) END AS instrument_code, size, share, odd, label, raw,
 concat_ws(',', CASE WHEN size IS NULL THEN 'size' END, CASE WHEN share IS NULL AND k % 2 = 1 THEN 'share' END, CASE WHEN label IS NULL THEN 'label' END, CASE WHEN raw IS NULL THEN 'raw' END) AS missing_metrics,
 CASE WHEN share IS NULL AND k % 2 = 0 THEN 'share' ELSE '' END AS non_finite_metrics,
 length('{"size":,"share":,"odd":,"label":,"raw":}' || coalesce(CAST(size AS VARCHAR), 'null') || coalesce(CAST(share AS VARCHAR), 'null') || CAST(odd AS VARCHAR) || coalesce('"' || label || '"', 'null') || coalesce(CAST(raw AS VARCHAR), 'null')) AS n,
 sha256('{"members":[{"metric_key":"size","value_type":"int"},{"metric_key":"share","value_type":"float"},{"metric_key":"odd","value_type":"bool"},{"metric_key":"label","value_type":"string"},{"metric_key":"raw","value_type":"float"}],"set_family":"parts"}') AS fingerprint FROM p""",
        "missing_guard": f"WITH {ASOF}, rs AS (SELECT {rs(31, 63, 126, 252)} FROM asof_), m AS (SELECT count(*) AS n_rows, 4 * count(*) - count(rs31) - count(rs63) - count(rs126) - count(rs252) AS n_null FROM rs) SELECT *, round(n_null / (11 * n_rows), 6) AS ratio, n_null / (11 * n_rows) > 0.01 AS too_many FROM m",
        "missing_shares": f"WITH {ASOF}, rs AS (SELECT {rs(31, 63, 126, 252)} FROM asof_), m AS (" + " UNION ALL ".join(f"SELECT 'rs{t}' AS metric, count(*) AS n_rows, count(*) - count(rs{t}) AS n_missing FROM rs" for t in (31, 63, 126, 252)) + ") SELECT *, round(n_missing / n_rows, 6) AS share, n_missing / n_rows > 0.2 AS too_many FROM m",
        "share_classes": "SELECT * FROM (SELECT p_partkey || CASE WHEN p_size % 2 = 0 THEN '0A' ELSE '' END AS code FROM part) WHERE length(replace(code, 'A', '')) < 5",
        "title_novelty": "SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'followup' ELSE 'new' END AS novelty FROM events",
        "update_anomalies": "SELECT strftime(o_orderdate, '%Y-%m') AS month, concat_ws(',', CASE WHEN count(*) > 400 THEN 'added_aliases' END, CASE WHEN avg(CASE WHEN o_orderstatus <> 'P' THEN 1.0 ELSE 0.0 END) < 0.85 THEN 'media_success_rate' END, CASE WHEN avg(CASE WHEN o_orderpriority < '3' THEN 1.0 ELSE 0.0 END) > 0.35 THEN 'low_ratio' END) AS broken FROM orders GROUP BY 1",
        "stream_windows": "SELECT CAST(ts AS DATE) AS d, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    }

"""DuckDB SQL of the control plane's queries, from their definitions."""

from __future__ import annotations

RUN = "DATE '1998-06-01'"

FETCH = f"""
bars AS (SELECT c_nationkey || '-' || c_mktsegment AS code, CAST(date_trunc('month', o_orderdate) AS DATE) AS day, max(o_totalprice) AS close, min(c_nationkey) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
log AS (SELECT code, day, close, CASE WHEN n <> 3 THEN close END AS extra FROM bars WHERE (day < DATE '1997-06-01' OR n % 5 = 1) AND (n % 7 <> 2 OR day < DATE '1992-06-01')),
offer AS (SELECT code, day, close + CASE WHEN month(day) % 2 = 0 THEN 2 ELSE 1 END AS close FROM bars WHERE day >= DATE '1997-01-01' AND n % 6 <> 4 AND day <= {RUN}),
have AS (SELECT code, count(*) AS n, max(day) AS last, count(extra) AS n_extra FROM log GROUP BY code),
off AS (SELECT offer.code, count(*) AS n_all, count(*) FILTER (have.last IS NOT NULL AND offer.day > have.last) AS n_later, max(offer.day) AS newest FROM offer LEFT JOIN have USING (code) GROUP BY 1),
plan AS (SELECT k.code, have.n, have.last, have.n_extra = 0 AS lacks, coalesce(off.n_all, 0) AS n_all, coalesce(off.n_later, 0) AS n_later, off.newest,
  CASE WHEN have.n IS NULL OR have.n < 12 OR have.n_extra = 0 THEN CASE WHEN off.n_all > 0 THEN 'whole' ELSE 'failed' END
    WHEN have.last < {RUN} THEN CASE WHEN off.n_later > 0 THEN 'later' WHEN off.n_all > 0 THEN 'whole' ELSE 'failed' END ELSE 'none' END AS action
  FROM (SELECT DISTINCT code FROM bars) AS k LEFT JOIN have USING (code) LEFT JOIN off USING (code)),
after AS (SELECT *, CASE action WHEN 'whole' THEN n_all WHEN 'failed' THEN 0 WHEN 'later' THEN n + n_later ELSE n END AS held, CASE WHEN action = 'none' THEN last ELSE newest END AS top FROM plan),
man AS (SELECT *, CASE WHEN action = 'failed' THEN 'failed' WHEN held < 12 THEN 'insufficient' WHEN top < {RUN} THEN 'stale' ELSE 'ok' END AS status FROM after),
force AS (SELECT log.code, log.day, log.close, log.extra FROM log JOIN plan USING (code) WHERE action <> 'whole'
  UNION ALL SELECT offer.code, offer.day, offer.close, offer.close FROM offer JOIN plan USING (code) WHERE action = 'whole' OR (action = 'later' AND offer.day > plan.last))"""

MANIFEST = f"""WITH {FETCH}
SELECT code, 12 AS requested_days, CAST(held AS BIGINT) AS fetched_bars, status,
  CASE status WHEN 'failed' THEN 'fetch_failed' WHEN 'insufficient' THEN 'insufficient_bars' WHEN 'stale' THEN 'missing_bar_for_run_date' ELSE CASE WHEN action = 'whole' AND lacks THEN 'schema_mismatch_missing_ohlcv:extra' END END AS error,
  CAST(CASE action WHEN 'whole' THEN n_all WHEN 'later' THEN n_later ELSE 0 END AS BIGINT) AS newly_fetched_days
FROM man"""

#: After the first round a series has what is in force; one that is still short, stale or void is fetched anew.
AGAIN = f"""WITH {FETCH},
now AS (SELECT code, count(*) AS n, max(day) AS last, count(extra) AS x FROM force GROUP BY code)
SELECT k.code,
  CASE WHEN now.n >= 12 AND now.x > 0 AND now.last >= {RUN} THEN 'ok' WHEN coalesce(off.n_all, 0) = 0 THEN 'failed' WHEN off.n_all < 12 THEN 'insufficient' WHEN off.newest < {RUN} THEN 'stale' ELSE 'ok' END AS status,
  CAST(CASE WHEN now.n >= 12 AND now.x > 0 AND now.last >= {RUN} THEN 0 ELSE coalesce(off.n_all, 0) END AS BIGINT) AS newly_fetched_days,
  CASE WHEN now.n >= 12 AND now.x > 0 AND now.last >= {RUN} OR coalesce(off.n_all, 0) = 0 THEN now.n ELSE off.n_all END AS n,
  CASE WHEN now.n >= 12 AND now.x > 0 AND now.last >= {RUN} OR coalesce(off.n_all, 0) = 0 THEN now.last ELSE off.newest END AS last
FROM (SELECT DISTINCT code FROM bars) AS k LEFT JOIN now USING (code) LEFT JOIN off USING (code)"""

STALE = f"""WITH {FETCH}
SELECT force.code, force.day, force.close FROM force JOIN man USING (code) WHERE force.day = DATE '1998-05-01' AND man.status <> 'stale'"""

STEPS = """
steps AS (SELECT o_custkey % 211 AS pointer, o_orderkey AS seq, row_number() OVER (PARTITION BY o_custkey % 211 ORDER BY o_orderdate, o_orderkey) AS i,
  CAST(o_orderkey % 3 AS INT) + 1 AS v, CAST((o_orderkey // 3) % 3 AS INT) + 1 AS w, CAST(left(o_orderpriority, 1) AS INT) AS kind, o_orderstatus AS st,
  ['draft', 'shadow', 'draft', 'shadow', 'active', 'draft'][o_custkey % 6 + 1] AS src, ['shadow', 'draft', 'retired', 'retired', 'retired', 'shadow'][o_custkey % 6 + 1] AS dst FROM orders)"""

LIFE = f"""WITH RECURSIVE {STEPS},
run AS (
  SELECT pointer, CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS seq, 0 AS kind, 0 AS v, CAST(NULL AS VARCHAR) AS reason, [CAST(NULL AS VARCHAR), NULL, NULL] AS s, CAST(NULL AS INT) AS cur
  FROM (SELECT DISTINCT pointer FROM steps)
  UNION ALL
  SELECT pointer, i, seq, kind, v, reason,
    CASE WHEN reason IS NOT NULL OR kind = 2 THEN s
      ELSE list_transform(s, lambda x, n: CASE WHEN n = v THEN CASE WHEN kind = 1 THEN 'draft' WHEN kind < 5 THEN dst ELSE 'active' END WHEN kind = 5 AND x = 'active' THEN 'retired' ELSE x END) END,
    CASE WHEN reason IS NULL AND kind = 5 THEN v ELSE cur END
  FROM (SELECT steps.*, run.s, run.cur,
      CASE kind_ WHEN 1 THEN CASE WHEN steps.st = 'P' THEN 'insert_must_be_draft' WHEN run.s[steps.v] IS NOT NULL THEN 'exists' END
        WHEN 2 THEN CASE WHEN run.s[steps.v] IS NULL THEN 'unknown_version' WHEN run.s[steps.v] <> 'draft' THEN 'members_need_draft' END
        WHEN 5 THEN CASE WHEN run.cur IS DISTINCT FROM CASE WHEN steps.st <> 'F' THEN steps.w END THEN 'pointer_conflict' WHEN run.cur = steps.v THEN NULL
          WHEN run.s[steps.v] IS NULL OR run.s[steps.v] NOT IN ('shadow', 'retired') THEN 'not_activatable' END
        ELSE CASE WHEN steps.src = 'active' THEN 'move_not_allowed' WHEN run.s[steps.v] IS DISTINCT FROM steps.src THEN 'move_denied' END END AS reason
    FROM run JOIN (SELECT *, kind AS kind_ FROM steps) AS steps ON steps.pointer = run.pointer AND steps.i = run.i + 1) AS t)"""

STEP_ROWS = f"""{LIFE}
SELECT pointer, seq, CASE kind WHEN 1 THEN 'insert' WHEN 2 THEN 'member' WHEN 5 THEN 'activate' ELSE 'move' END AS op, 'v' || (v - 1) AS version, reason IS NULL AS accepted, reason, s[v] AS status,
  CASE WHEN cur IS NOT NULL THEN 'v' || (cur - 1) END AS active FROM run WHERE i > 0"""

ACTIVE = f"""{LIFE}
SELECT pointer, max_by(CASE WHEN cur IS NOT NULL THEN 'v' || (cur - 1) ELSE '' END, i) AS a, count(*) FILTER (reason IS NULL) AS n_accepted, count(*) FILTER (reason IS NOT NULL) AS n_rejected FROM run WHERE i > 0 GROUP BY pointer"""

QUEUE = """WITH RECURSIVE calls AS (
  SELECT o_custkey % 97 AS entry, o_orderkey AS seq, 200 * date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS "at", o_orderkey % 5 + 1 AS tok,
    greatest(60, least(7200, o_orderkey % 100 * 90)) AS vis, greatest(60, o_orderkey % 100 * 90) AS ret,
    CASE WHEN left(o_orderpriority, 1) = '5' AND o_orderkey % 4 > 0 THEN 1 ELSE CAST(left(o_orderpriority, 1) AS INT) END AS kind FROM orders),
c AS (SELECT *, row_number() OVER (PARTITION BY entry ORDER BY "at", seq) AS i FROM calls),
run AS (
  SELECT entry, CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS seq, CAST(NULL AS BIGINT) AS "at", 0 AS kind, CAST(NULL AS VARCHAR) AS reason, 'pending' AS st, CAST(0 AS BIGINT) AS token, 0 AS tries,
    CAST(NULL AS BIGINT) AS vis, CAST(NULL AS BIGINT) AS retry, CAST(NULL AS BIGINT) AS freed FROM (SELECT DISTINCT entry FROM c)
  UNION ALL
  SELECT entry, i, seq, "at", kind, reason,
    CASE WHEN reason IS NOT NULL THEN st0 ELSE CASE kind WHEN 1 THEN 'claimed' WHEN 2 THEN st0 WHEN 3 THEN 'dispatched' WHEN 4 THEN 'failed' ELSE 'done' END END,
    token + CASE WHEN reason IS NULL AND kind = 1 THEN 1 ELSE 0 END, tries + CASE WHEN reason IS NULL AND kind = 1 THEN 1 ELSE 0 END,
    CASE WHEN reason IS NOT NULL OR kind = 3 THEN vis0 WHEN kind <= 2 THEN "at" + nvis END,
    CASE WHEN reason IS NOT NULL THEN retry WHEN kind = 4 THEN "at" + nret WHEN kind = 1 THEN NULL ELSE retry END, freed
  FROM (SELECT *, CASE WHEN kind = 1 THEN CASE WHEN NOT (st0 = 'pending' OR (st0 = 'failed' AND tries < 3 AND retry <= "at")) THEN 'not_eligible' END
      WHEN tok <> token THEN 'fencing_mismatch' WHEN kind <> 4 AND st0 NOT IN ('claimed', 'dispatched') THEN 'bad_status' END AS reason
    FROM (SELECT c.entry, c.i, c.seq, c."at", c.kind, c.tok, c.vis AS nvis, c.ret AS nret, run.token, run.tries, run.retry,
        CASE WHEN run.st IN ('claimed', 'dispatched') AND run.vis <= c."at" THEN run.vis END AS freed,
        CASE WHEN run.st IN ('claimed', 'dispatched') AND run.vis <= c."at" THEN 'pending' ELSE run.st END AS st0,
        CASE WHEN run.st IN ('claimed', 'dispatched') AND run.vis <= c."at" THEN NULL ELSE run.vis END AS vis0
      FROM run JOIN c ON c.entry = run.entry AND c.i = run.i + 1) AS a) AS b),
last AS (SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY entry ORDER BY i DESC) = 1)
SELECT entry, seq, "at", ['claim', 'heartbeat', 'dispatch', 'fail', 'finish'][kind] AS op, reason IS NULL AS accepted, reason, st AS status, token, CAST(tries AS INT) AS attempts FROM run WHERE i > 0
UNION ALL SELECT b.entry, NULL, b.freed, 'reclaim', true, NULL, 'pending', a.token, CAST(a.tries AS INT) FROM run b JOIN run a ON a.entry = b.entry AND a.i = b.i - 1 WHERE b.freed IS NOT NULL
UNION ALL SELECT entry, NULL, vis, 'reclaim', true, NULL, 'pending', token, CAST(tries AS INT) FROM last WHERE st IN ('claimed', 'dispatched') AND vis <= (SELECT max("at") FROM calls)"""

CONSTRAINTS = """WITH o AS (SELECT * FROM orders),
checks AS (
  SELECT 'status_known' AS rule, count(*) AS n FROM o WHERE o_orderstatus NOT IN ('F', 'O') UNION ALL SELECT 'price_positive', count(*) FROM o WHERE o_totalprice <= 0
  UNION ALL SELECT 'price_bounded', count(*) FROM o WHERE o_totalprice >= 300000 UNION ALL SELECT 'done_is_old', count(*) FROM o WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1996-01-01'),
keys AS (
  SELECT 'order_once' AS rule, CAST(o_orderkey AS VARCHAR) AS k FROM o UNION ALL SELECT 'one_open_a_customer', CAST(o_custkey AS VARCHAR) FROM o WHERE o_orderstatus = 'O'
  UNION ALL SELECT 'urgent_once_a_day', CAST(o_orderdate AS VARCHAR) FROM o WHERE o_orderpriority = '1-URGENT' UNION ALL SELECT 'nulls_differ', o_custkey || '/' || o_orderstatus FROM o WHERE o_orderstatus <> 'O'),
twice AS (SELECT rule, k, count(*) AS n FROM keys GROUP BY 1, 2 HAVING count(*) > 1),
refs AS (SELECT 'known_customer' AS rule, o_custkey AS k FROM o WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT 'even_customer', o_custkey FROM o WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0))
SELECT rule, 'check' AS kind, CAST(n AS BIGINT) AS n_rows, CAST(NULL AS BIGINT) AS n_keys FROM checks WHERE n > 0
UNION ALL SELECT rule, 'unique', CAST(sum(n) AS BIGINT), count(*) FROM twice GROUP BY rule
UNION ALL SELECT rule, 'reference', count(*), count(DISTINCT k) FROM refs GROUP BY rule"""

BROKEN = """SELECT c_custkey, concat_ws(',', CASE WHEN c_acctbal < 0 THEN 'balance' END, CASE WHEN c_mktsegment = 'BUILDING' THEN 'segment' END, CASE WHEN c_nationkey >= 20 THEN 'nation' END) AS broken
FROM customer WHERE c_acctbal < 0 OR c_mktsegment = 'BUILDING' OR c_nationkey >= 20"""

ROLLOUT = """WITH o AS (SELECT o_orderkey, ['off', '4.5a', '4.5b', '4.5c'][o_orderkey % 4 + 1] AS stage, ['normal', 'backfill', 'replay', 'reconcile', 'series_seed', 'series_repair'][(o_orderkey // 4) % 6 + 1] AS mode,
  ['snapshot', 'series', 'generation_index', 'latest'][(o_orderkey // 24) % 4 + 1] AS artifact, ['shadow', 'active', 'draft'][(o_orderkey // 96) % 3 + 1] AS status, (o_orderkey // 7) % 2 = 0 AS named, (o_orderkey // 11) % 2 = 1 AS active FROM orders)
SELECT *,
  CASE WHEN stage = 'off' OR mode = 'replay' THEN 'skip0' WHEN starts_with(mode, 'series') THEN CASE WHEN stage = '4.5c' THEN 'continue' ELSE 'exit2' END WHEN mode = 'reconcile' AND stage <> '4.5c' THEN 'exit2' ELSE 'continue' END AS preflight,
  CASE WHEN stage = 'off' THEN 'skip0' WHEN mode = 'replay' THEN 'no_resolve_replay' WHEN named THEN 'use_uuid' WHEN mode = 'backfill' OR (mode = 'normal' AND stage <> '4.5c') THEN 'flag_required'
    WHEN stage <> '4.5c' THEN 'exit2' WHEN mode = 'reconcile' THEN 'flag_must_match_active' WHEN active THEN 'resolve_active' ELSE 'exit2' END AS resolution,
  CASE WHEN stage = 'off' OR mode = 'replay' THEN 'false' WHEN starts_with(mode, 'series') THEN CAST(stage = '4.5c' AND status = 'active' AND artifact IN ('series', 'generation_index') AS VARCHAR)
    WHEN mode = 'backfill' THEN CAST(status = 'shadow' AND artifact <> 'latest' AND (artifact <> 'series' OR stage <> '4.5a') AS VARCHAR)
    WHEN mode = 'reconcile' THEN CAST(stage = '4.5c' AND status = 'active' AS VARCHAR)
    WHEN stage = '4.5c' THEN CAST(status = 'active' AS VARCHAR) ELSE CAST(status = 'shadow' AND artifact <> 'latest' AND (artifact <> 'series' OR stage = '4.5b') AS VARCHAR) END AS writable,
  CASE WHEN starts_with(mode, 'series') THEN 'series_only' WHEN mode = 'reconcile' THEN CASE WHEN active THEN 'snapshot_series_latest' ELSE 'snapshot_series' END
    WHEN stage = '4.5a' THEN 'snapshot_only' WHEN mode = 'backfill' OR stage = '4.5b' THEN 'snapshot_series' WHEN stage = '4.5c' THEN 'snapshot_series_latest' END AS profile
FROM o"""


NEWS = """SELECT o_custkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 570 MINUTE AS published_at, o_orderpriority AS source_category, 'A & B ' || o_orderkey AS title,
  CASE WHEN o_orderstatus = 'F' THEN 'https://kabutan.jp/n/' ELSE 'https://y.jp/' END || o_orderkey AS url
FROM orders WHERE o_orderkey % 7 > 0 AND o_orderkey % 5 > 0 AND o_orderdate >= DATE '2000-01-01'
UNION ALL SELECT o_custkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 100 YEAR + INTERVAL 570 MINUTE, o_orderpriority, 'A & B ' || o_orderkey,
  CASE WHEN o_orderstatus = 'F' THEN 'https://kabutan.jp/n/' ELSE 'https://y.jp/' END || o_orderkey FROM orders WHERE o_orderkey % 7 > 0 AND o_orderkey % 5 > 0 AND o_orderdate < DATE '2000-01-01'"""

DISCLOSED = """WITH d AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS day, CAST(o_custkey % 6 + 1 AS INT) AS page, o_orderkey, o_custkey, o_orderstatus FROM orders),
r AS (SELECT day, page, lpad(CAST(o_custkey % 10000 AS VARCHAR), 4, '0') || CASE WHEN o_custkey % 2 = 0 THEN '' ELSE 'A' END AS code,
  CAST(day AS TIMESTAMP) + to_hours(o_orderkey % 24) + to_minutes(o_orderkey % 60) AS published_at, 't' || o_orderkey AS title,
  'https://www.release.tdnet.info/' || CASE WHEN o_orderkey % 3 = 0 THEN 'd/' ELSE 'inbs/' END || o_orderkey AS url,
  CASE WHEN o_orderkey % 4 > 0 THEN o_orderstatus = 'F' END AS has_xbrl, CASE WHEN o_orderkey % 4 > 0 THEN o_orderstatus ELSE '' END AS listing_exchange FROM d WHERE (month(day) + page) % 5 <> 0 AND page <= 5),
p AS (SELECT DISTINCT day, page FROM r), k AS (SELECT day, page, row_number() OVER (PARTITION BY day ORDER BY page) AS i FROM p),
l AS (SELECT day, max(page) AS top FROM k WHERE i = page GROUP BY day)
SELECT r.* FROM r JOIN l USING (day) WHERE page <= top"""

SERIES = """WITH bars AS (SELECT n_name AS code, CAST(l_shipdate AS DATE) AS date, last(l_extendedprice ORDER BY l_orderkey, l_linenumber, l_extendedprice) AS close, sum(l_quantity) AS volume
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2)"""

SWEEP = """WITH k AS (SELECT DISTINCT 'k-' || o_custkey AS key FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)),
n AS (SELECT ceil(count(*) / 4.0) AS n FROM k)
SELECT key, CAST(floor((row_number() OVER (ORDER BY key) - 1) / n) AS INT) AS page FROM k, n"""


def control_sql() -> dict[str, str]:
    return {
        "fetch_manifest": MANIFEST,
        "fetch_rows": f"WITH {FETCH} SELECT * FROM force",
        "fetch_again": AGAIN,
        "stale_exclusions": STALE,
        "resumed_batches": "SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1",
        "batch_ledger": "SELECT o_custkey % 60 AS chunk, count(DISTINCT o_custkey) AS n_keys, count(*) AS n_rows, (o_custkey % 60) // 25 * 25 AS first_of_wave FROM orders GROUP BY 1, 4",
        "lifecycle_steps": STEP_ROWS,
        "active_versions": f"SELECT pointer, nullif(a, '') AS active, n_accepted, n_rejected FROM ({ACTIVE})",
        "queue_life": QUEUE,
        "queue_life_stream": QUEUE,
        "constraints": CONSTRAINTS,
        "broken_rules": BROKEN,
        "rollout_decisions": ROLLOUT,
        "news_pages": NEWS,
        "disclosure_pages": DISCLOSED,
        "delisted_pages": "SELECT DISTINCT CASE WHEN o_custkey < 1000 THEN lpad(CAST(o_custkey AS VARCHAR), 4, '0') ELSE CAST(o_custkey AS VARCHAR) END AS code FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-03-15'",
        "series_objects": f"{SERIES} SELECT code AS instrument_code, year(date) AS year, count(*) AS n, CAST(max(date) AS VARCHAR) AS last, round(sum(close), 2) AS close, round(sum(volume), 2) AS volume, 0 AS faults FROM bars GROUP BY 1, 2",
        "manifest_faults": f"""{SERIES}, o AS (SELECT DISTINCT 'series/year=' || year(date) || '/code=' || regexp_replace(code, '[^0-9A-Za-z_.-]', '_', 'g') || '.json.gz' AS key, year(date) AS y FROM bars)
SELECT key, CASE y WHEN 1993 THEN 'repeated' WHEN 1994 THEN 'extra' WHEN 1995 THEN 'extra' ELSE 'changed' END AS fault FROM o WHERE y BETWEEN 1993 AND 1996 UNION ALL SELECT key || '.old', 'missing' FROM o WHERE y = 1995""",
        "orphan_sweep": SWEEP,
        "event_cutoff": "SELECT event_id FROM events WHERE date_trunc('second', ts) <= TIMESTAMP '2024-01-20 15:30:00' AND event_id % 10 > 0 AND event_type NOT IN ('click', 'view')",
        "named_codes": "SELECT c_custkey AS k, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment ELSE '' END AS name FROM customer",
        "previous_release": """WITH b AS (SELECT date_trunc('month', o_orderdate) AS m, last(o_orderkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS k FROM orders WHERE month(o_orderdate) <> 4 GROUP BY 1)
SELECT strftime(b.m, '%Y-%m') AS month, p.k AS previous FROM b LEFT JOIN b p ON p.m + INTERVAL 1 MONTH = b.m""",
        "allowed_keys": "SELECT CAST(o_orderkey AS VARCHAR) AS cache_key FROM orders WHERE o_orderkey % 9 > 0 AND o_orderpriority IN ('1-URGENT', '2-HIGH')",
        "favourites_union": "SELECT o_custkey, string_agg(c, ',' ORDER BY c) AS codes FROM (SELECT o_custkey, o_orderpriority AS c FROM orders UNION SELECT o_custkey, o_orderstatus FROM orders) GROUP BY 1",
    }

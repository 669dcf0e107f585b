"""Decision rules, links, prompt blocks and digests of rows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tidemark.functions.text import nfc

# Link templates by column.
LINKS = {
    "link_kabutan": "https://kabutan.jp/stock/?code=%s",
    "link_kabutan_chart": "https://kabutan.jp/stock/chart?code=%s",
    "link_kabutan_news": "https://kabutan.jp/stock/news?code=%s",
    "link_minkabu": "https://minkabu.jp/stock/%s",
    "link_buffett": "https://www.buffett-code.com/company/%s",
    "link_yahoo": "https://finance.yahoo.co.jp/quote/%s.T",
}
# Words that mark an alias as noise.
NOISE_WORDS = ["最新ニュース", "ニュース", "株価", "reuters", "stock price", "latest news", "quote", "提出会社", "上場会社", "日本経済新聞", "日経"]


def with_links(df: DataFrame, code: str = "code") -> DataFrame:
    return df.withColumns({k: F.format_string(t, F.col(code)) for k, t in LINKS.items()})


def best_column(columns: list[str], prefix: str, wanted: str) -> str | None:
    """``wanted`` where it exists, else the last name with the prefix in string order."""
    found = sorted(c for c in columns if c.startswith(prefix))
    return wanted if wanted in columns else found[-1] if found else None


def prompt_block(df: DataFrame) -> Column:
    """One-line JSON of an instrument's observations; missing values are null."""
    have = set(df.columns)
    col = lambda c, t="double": F.col(c).cast(t) if c in have else F.lit(None).cast(t)
    text = lambda c: F.nullif(F.trim(col(c, "string")), F.lit(""))
    z, ratio = best_column(df.columns, "z_turnover_", "z_turnover_60"), best_column(df.columns, "turnover_ma_ratio_", "turnover_ma_ratio_60")
    block = F.struct(
        F.struct(text("date").alias("観測日"), text("code").alias("銘柄コード"), text("name").alias("銘柄名")).alias("銘柄の基本情報"),
        F.struct(
            F.round(col("turnover_yen")).cast("long").alias("当日の売買代金（概算）"),
            (col(z) if z else col("-")).alias("売買代金の異常度（過去60営業日基準のZスコア）"),
            (col(ratio) if ratio else col("-")).alias("売買代金の平常比（過去60営業日平均に対して何倍か）"),
            F.round(col("price_change_pct"), 4).alias("当日騰落率（前営業日終値比）"),
            text("price_text").alias("当日のローソク足形状"),
        ).alias("当日の売買代金・値動きの指標"),
    )
    return F.to_json(block, {"ignoreNullFields": "false"})


def history_eligibility(n_bars: Column, required: int, listing_age: Column | None = None) -> Column:
    short = F.lit(False) if listing_age is None else F.coalesce(listing_age < required, F.lit(False))
    return F.when(short, "expected_short_history").when(n_bars >= required, "eligible").otherwise("insufficient")


def backfill_outcome(month: Column, start: Column, has_previous: Column, n_added: Column, n_dates: Column, max_codes: int = 50, max_work: int = 4000) -> Column:
    """Struct (outcome, reason) of a monthly commit: grandfather, blocked, noop or runnable, in that order of checks."""
    cases = [
        (month < start, "grandfather", "before_feature_start"),
        (~has_previous, "blocked", "missing_previous_core"),
        (n_added == 0, "noop", None),
        (n_added > max_codes, "blocked", "added_codes_over_limit"),
        (n_dates == 0, "blocked", "coverage_empty"),
        (n_added * n_dates > max_work, "blocked", "work_units_over_limit"),
    ]
    out = None
    for test, outcome, reason in cases:
        row = F.struct(F.lit(outcome).alias("outcome"), F.lit(reason).cast("string").alias("reason"))
        out = F.when(test, row) if out is None else out.when(test, row)
    return out.otherwise(F.struct(F.lit("runnable").alias("outcome"), F.lit(None).cast("string").alias("reason")))


def terminal_status(is_open: Column, strict: list[Column], optional: list[Column], published_ok: Column) -> Column:
    """success on closed days; failed when a strict job did not succeed, an optional one failed, or publishing did."""
    bad = F.lit(False)
    for s in strict:
        bad = bad | (F.coalesce(s, F.lit("")) != "success")
    for s in optional:
        bad = bad | F.coalesce(s.isin("failure", "cancelled", "timed_out"), F.lit(False))
    return F.when(~is_open, "success").when(bad | ~published_ok, "failed").otherwise("success")


def coverage_gate(df: DataFrame, value: str, eligible: str, least: float = 0.98) -> DataFrame:
    """Whether enough eligible rows have a value; no eligible row means no."""
    rate = F.avg(F.when(F.col(eligible), F.col(value).isNotNull().cast("double")))
    return df.agg(F.count_if(eligible).alias("n_eligible"), F.coalesce(rate, F.lit(0.0)).alias("rate")).withColumn("allowed", (F.col("n_eligible") > 0) & (F.col("rate") >= least))


def plain_alias(alias: Column) -> Column:
    """Entities resolved, compatibility forms unified (NFKC), trimmed, runs of white space as one space."""
    import html
    import re
    import unicodedata

    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: re.sub(r"\s+", " ", unicodedata.normalize("NFKC", html.unescape(x)).strip()), na_action="ignore")

    return pandas_udf(run, "string")(alias)


# Signs that an alias key loses, and prefixes of markets.
KEY_DROPS = r"[\s・･\-‐－_／/&＆,，.。]+"
MARKET_PREFIXES = (r"^G-\s*", r"^(?:東証|名証|札証|福証)[A-Z0-9]*\s*", r"(?i)^TOKYO\s+PRO\s+Market\s*")


def alias_key(plain: Column) -> Column:
    """Key of a ``plain_alias``."""
    return F.regexp_replace(F.lower(plain), KEY_DROPS, "")


def valid_alias(plain: Column) -> Column:
    """Plain aliases long enough, short enough and free of noise words."""
    noise = F.lit(False)
    for w in NOISE_WORDS:
        noise = noise | F.contains(F.lower(plain), F.lit(w))
    return (F.length(plain) > 0) & (F.length(alias_key(plain)) > 1) & (F.length(plain) <= 80) & ~plain.rlike("^[A-Za-z]{1,2}$") & ~noise


def alias_confidence(n_sources: Column, plain: Column, in_base: Column) -> Column:
    short = plain.rlike("^[A-Za-z]{3,5}$")
    return F.when(in_base | (n_sources >= 2), "high").when(~valid_alias(plain) | short, "low").otherwise("medium")


def strip_market_prefix(plain: Column) -> Column:
    for prefix in MARKET_PREFIXES:
        plain = F.regexp_replace(plain, prefix, "")
    return F.trim(plain)


def collect_candidates(found: DataFrame, known: DataFrame, state: DataFrame) -> DataFrame:
    """One candidate per (code, key) of observations ``code, alias, source, n, ordinal``: first alias, sources united, counts summed.

    ``known`` (code, dedup_key) marks aliases the base has; ``state`` (code,
    dedup_key, seen_count) adds the counts of earlier runs; confidence follows
    from all sources.
    """
    rows = found.withColumn("alias", plain_alias(F.col("alias")))
    rows = rows.withColumn("dedup_key", alias_key(F.col("alias"))).where(F.length("dedup_key") > 0)
    agg = rows.groupBy("code", "dedup_key").agg(F.min_by("alias", "ordinal").alias("alias"), F.array_sort(F.collect_set("source")).alias("sources"), F.sum("n").alias("n"), F.min("ordinal").alias("ordinal"))
    base = known.select("code", "dedup_key").distinct().withColumn("_base", F.lit(True))
    before = state.groupBy("code", "dedup_key").agg(F.max("seen_count").alias("_before"))
    out = agg.join(base, ["code", "dedup_key"], "left").join(before, ["code", "dedup_key"], "left")
    in_base = F.coalesce("_base", F.lit(False))
    reason = F.when(~valid_alias(F.col("alias")), "invalid_alias").when(in_base, "exists_in_base").otherwise("new_candidate")
    return out.select("code", "dedup_key", "alias", "sources", (F.col("n") + F.coalesce("_before", F.lit(0))).alias("seen_count"), alias_confidence(F.size("sources"), F.col("alias"), in_base).alias("confidence"), reason.alias("reason"), "ordinal")


def anomalies(added: Column, media_rate: Column, low_ratio: Column) -> Column:
    """Names of the limits that a dictionary update breaks."""
    # The three limits.
    tests = [(added > 400, "added_aliases"), (media_rate < 0.85, "media_success_rate"), (low_ratio > 0.35, "low_ratio")]
    return F.array_compact(F.array(*[F.when(t, F.lit(n)) for t, n in tests]))


def exact_decimal(c: Column) -> Column:
    """Canonical decimal text of the exact binary value: ten places, half-even, no trailing zeros; null unless finite."""
    from decimal import ROUND_HALF_EVEN, Context, Decimal

    context = Context(prec=400, rounding=ROUND_HALF_EVEN)

    def text(x: float) -> str | None:
        if x is None or x != x or abs(x) == float("inf"):
            return None
        s = format(Decimal(x).quantize(Decimal("0.0000000001"), context=context), "f").rstrip("0").rstrip(".")
        return "0" if s in ("-0", "") else s

    def run(s: pd.Series) -> pd.Series:
        return pd.Series([text(x) for x in s], dtype=object)

    return pandas_udf(run, "string")(c.cast("double"))


def json_text(c: Column) -> Column:
    """A text as a JSON string; control characters without a short form are written with small hex digits."""
    quoted = F.regexp_extract(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", 1)
    for digit in "ABCDEF":
        quoted = F.regexp_replace(quoted, rf"(?<!\\)((?:\\\\)*\\u00[01]){digit}", f"$1{digit.lower()}")
    return quoted


def digest_rows(df: DataFrame, code: str, metrics: dict[str, str]) -> DataFrame:
    """``code, row``: each instrument's tagged values and flags as compact JSON (types: float, int, bool, string)."""
    off = lambda c: F.isnan(c) | (F.abs(c) == float("inf"))
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    atoms, missing, odd = [], [], []
    for m, kind in metrics.items():
        c = F.col(m)
        if kind == "float":
            odd.append(F.when(off(c), F.lit(f'"{m}"')))
            value = quoted(exact_decimal(F.when(~off(c), c)))
        elif kind == "string":
            value = F.when(c.isNotNull(), json_text(nfc(c.cast("string"))))
        else:
            value = c.cast("string")
        missing.append(F.when(c.isNull(), F.lit(f'"{m}"')))
        atoms.append(F.concat(F.lit(f'{{"metric_key":"{m}","type":"{kind}","value":'), F.coalesce(value, F.lit("null")), F.lit("}")))
    names = lambda xs: F.concat(F.lit("["), F.array_join(F.array_compact(F.array(*xs)) if xs else F.array().cast("array<string>"), ","), F.lit("]"))
    row = F.concat(F.lit('{"instrument_code":'), json_text(F.col(code).cast("string")), F.lit(',"values":['), F.concat_ws(",", *atoms), F.lit('],"flags":{"missing_metrics":'), names(missing), F.lit(',"non_finite_metrics":'), names(odd), F.lit(',"po_indeterminate":false}}'))
    return df.select(F.col(code).alias("code"), row.alias("row"))


def logical_digest(rows: DataFrame, trade_date: str, set_id: str) -> DataFrame:
    """SHA-256 of a snapshot's canonical payload: rows by code, one snapshot (a universe of instruments) per digest."""
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("code", "row"))), lambda x: x["row"]), ",")
    head = f'{{"schema_version":1,"trade_date":"{trade_date}","metric_set_version_id":"{set_id.strip().lower()}","rows":['
    return rows.agg(F.sha2(F.concat(F.lit(head), body, F.lit("]}")), 256).alias("digest"))


def json_fingerprint(definition: dict) -> str:
    """SHA-256 of a catalogue entry as compact JSON with sorted keys (driver side: a catalogue has tens of entries)."""
    import hashlib
    import json

    return hashlib.sha256(json.dumps(definition, ensure_ascii=False, separators=(",", ":"), sort_keys=True, allow_nan=False).encode()).hexdigest()

"""Event classification, de-duplication, scoring, ranking and enrichment."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field
from datetime import date, datetime, time
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.window import Window

# Title keywords and event types, first match wins.
TITLE_TYPES = [
    (("業績予想の修正", "上方修正", "通期連結業績予想の修正"), "earnings_revision_up"),
    (("決算短信",), "earnings"),
    (("自己株式の取得", "自己株式取得", "自社株買い"), "share_buyback"),
    (("自己株式の消却",), "share_cancellation"),
    (("公開買付け", "tob"), "tob"),
    (("株式の取得（子会社化）", "子会社化"), "mna"),
    (("提携",), "partnership"),
    (("月次", "売上高速報", "kpi"), "monthly"),
    (("増配", "配当予想の修正"), "dividend_revision"),
    (("訂正", "開示事項の経過"), "followup"),
    (("レーティング",), "analyst_rating"),
    (("本日の【", "話題株", "市況"), "market_news"),
]
# Score of each field value.
SPECIFICITY = {"company": 1.0, "issuer": 1.0, "high": 0.9, "sector": 0.55, "medium": 0.55, "theme": 0.45, "market": 0.2, "macro": 0.2, "low": 0.2}
NOVELTY = {"new": 1.0, "high": 0.9, "followup": 0.6, "medium": 0.6, "known": 0.35, "low": 0.35}
MATERIAL = {0.95: ["earnings_revision_up", "earnings", "share_buyback", "tob", "mna", "partnership", "large_order", "guidance_raise"], 0.65: ["monthly", "new_product", "analyst_rating", "theme", "sector_news"], 0.25: ["market_news", "ranking", "price_commentary", "supply_demand_commentary"]}
CATEGORY = {"開示": 1.0, "業績": 0.85, "材料": 0.8, "市況": 0.4, "テク": 0.25, "注目": 0.0, "特集": 0.0}
NO_CAUSE_TITLE = "材料不明・需給起因疑い"


@dataclass(frozen=True)
class Weights:
    """Score weights of the two modes (fixed values)."""

    v1: dict[str, float] = field(default_factory=lambda: {"time": 0.24, "specificity": 0.20, "material": 0.20, "source": 0.12, "novelty": 0.12, "alignment": 0.08, "confidence": 0.04})
    v2: dict[str, float] = field(default_factory=lambda: {"time": 0.22, "source": 0.16, "specificity2": 0.10, "channel": 0.16, "category": 0.12, "structure": 0.06, "name": 0.16, "confidence": 0.02, "alignment": 0.0})


def lookup(c: Column, values: dict[str, float], default: Column) -> Column:
    out = None
    for v in sorted(set(values.values()), reverse=True):
        hit = c.isin(*[k for k, x in values.items() if x == v])
        out = F.when(hit, F.lit(v)) if out is None else out.when(hit, F.lit(v))
    return out.otherwise(default)


def contains_any(c: Column, words: tuple[str, ...] | list[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words])


def title_type(title: Column, rules=None) -> Column:
    t, out = F.lower(title), None
    for words, tag in rules or TITLE_TYPES:
        out = F.when(contains_any(t, words), tag) if out is None else out.when(contains_any(t, words), tag)
    return out.otherwise("other")


def title_novelty(title: Column) -> Column:
    t = F.lower(title)
    return F.when(t.contains("訂正"), "low").when(t.contains("経過"), "followup").otherwise("new")


# Signs that names and titles lose before they meet.
MATCH_DROPS = " \u3000・-－ｰ&＆()（）:："


def match_form(value: str | None) -> str:
    """Compatibility form (NFKC), upper case, without ``MATCH_DROPS``."""
    text = unicodedata.normalize("NFKC", value or "").upper()
    return text.translate({ord(c): None for c in MATCH_DROPS})


def name_match(title: Column, aliases: Column) -> Column:
    """1.0 where the title holds one of the aliases, both in ``match_form``, else 0.0."""

    def run(titles: pd.Series, names: pd.Series) -> pd.Series:
        held: dict = {}
        form = lambda x: held[x] if x in held else held.setdefault(x, match_form(x))
        return pd.Series([float(any(form(a) and form(a) in match_form(t) for a in (() if n is None else n))) for t, n in zip(titles, names)], dtype="float64")

    return pandas_udf(run, "double")(title, aliases)


def clamp(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


def scores(run_date: str) -> dict[str, Column]:
    """All partial scores of an event row (string fields lower-cased here)."""
    low = lambda c: F.lower(F.trim(F.coalesce(F.col(c), F.lit(""))))
    day = F.to_date("published_at")
    days = F.datediff(F.lit(run_date).cast("date"), day)
    time = F.when(day.isNull(), 0.1).when(days < 0, 0.0).when(days == 0, 1.0).when(days == 1, 0.9).when(days <= 5, 0.6).when(days <= 20, 0.35).otherwise(0.1)
    src, url, cat, org = low("source"), low("url"), F.trim(F.coalesce("source_category", F.lit(""))), low("originality")
    material = None
    for v, names in MATERIAL.items():
        material = F.when(low("event_type").isin(*names), v) if material is None else material.when(low("event_type").isin(*names), v)
    base = F.when(src == "tdnet", 1.0).when(src == "kabutan", 0.72).otherwise(0.55)
    source = clamp(base + F.when(org.isin("primary", "original"), 0.1).when(org.isin("recap", "commentary"), -0.15).otherwise(0.0))
    pol, move = low("event_polarity"), F.col("price_change_pct")
    up, down = pol.isin("positive", "pos", "up"), pol.isin("negative", "neg", "down")
    align = F.when(move.isNull(), 0.5).when(up, F.when(move >= 0, 1.0).otherwise(0.1)).when(down, F.when(move <= 0, 1.0).otherwise(0.1)).otherwise(0.5)
    pdf = url.contains("/disclosures/pdf/")
    xbrl, hist = F.coalesce("has_xbrl", F.lit(False)), F.coalesce("has_update_history", F.lit(False))
    spec2 = F.when(src == "tdnet", 1.0).when((src == "kabutan") & pdf, 0.85).when(cat.isin("開示", "業績", "材料"), 0.68).when(cat.isin("テク", "市況", "注目", "特集"), 0.25).otherwise(0.45)
    channel = F.when(src == "tdnet", F.lit(0.9) + F.when(xbrl, 0.1).otherwise(0.0)).when((src == "kabutan") & pdf, 0.78).when((src == "kabutan") & url.contains("/stock/news"), 0.5).otherwise(0.4)
    channel = clamp(channel - F.when(cat.isin("テク", "市況"), 0.2).otherwise(0.0) - F.when(cat.isin("注目", "特集"), 0.15).otherwise(0.0))
    structure = clamp(F.lit(0.5) + F.when(src == "tdnet", 0.15).otherwise(0.0) + F.when(pdf, 0.1).otherwise(0.0) + F.when(xbrl, 0.2).otherwise(0.0) - F.when(hist, 0.2).otherwise(0.0))
    name = name_match(F.col("title"), F.col("name_aliases"))
    return {
        "time": time,
        "specificity": lookup(low("issuer_specificity"), SPECIFICITY, lookup(low("event_scope"), SPECIFICITY, F.lit(0.4))),
        "material": material.otherwise(0.45),
        "source": source,
        "novelty": lookup(low("novelty_level"), NOVELTY, F.lit(0.5)),
        "alignment": align,
        "confidence": clamp(F.col("confidence_base")),
        "specificity2": spec2,
        "channel": channel,
        "category": lookup(cat, CATEGORY, F.lit(0.5)),
        "structure": structure,
        "name": name,
    }


#: Columns a scored event needs; absent ones are null.
SCORED = {"source": "string", "url": "string", "source_category": "string", "originality": "string", "event_type": "string", "event_polarity": "string", "issuer_specificity": "string", "event_scope": "string", "novelty_level": "string", "published_at": "timestamp", "confidence_base": "double", "price_change_pct": "double", "has_xbrl": "boolean", "has_update_history": "boolean", "name_aliases": "array<string>", "title": "string"}


def rank_candidates(events: DataFrame, run_date: str, mode: str = "v1", weights: Weights | None = None, ordinal: str = "ordinal") -> DataFrame:
    """Scores every event and ranks it within its code: score descending, then arrival order."""
    rows = events.withColumns({c: F.lit(None).cast(t) for c, t in SCORED.items() if c not in events.columns})
    parts = scores(run_date)
    w = getattr(weights or Weights(), mode)
    if "name_aliases" not in events.columns:
        parts["name"] = F.lit(0.0)
    total = reduce(lambda a, b: a + b, [parts[k] * F.lit(x) for k, x in w.items()])
    if mode == "v2":  # the columns of the first mode carry their successors
        parts |= {"specificity": parts["specificity2"], "material": parts["channel"], "novelty": parts["category"]}
    rows = rows.withColumns({f"score_{k}": F.round(v, 6) for k, v in parts.items()})
    rows = rows.withColumn("cause_score", F.round(total, 6))
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("code").orderBy(F.desc("cause_score"), F.asc(ordinal))))


def cause_type(mode: str = "v1", threshold: float = 0.55, a_threshold: float = 0.72) -> Column:
    """A, B or C from a code's best candidate row (null score: no candidates)."""
    if mode == "v2":
        strong = (F.col("cause_score") >= a_threshold) & (F.col("score_channel") >= 0.75) & (F.col("score_category") >= 0.70)
    else:
        strong = (F.col("score_specificity") >= 0.8) & (F.col("score_material") >= 0.6)
    return F.when(F.col("cause_score").isNull() | (F.col("cause_score") < threshold), "C").when(strong, "A").otherwise("B")


def summarise(spikes: DataFrame, ranked: DataFrame, mode: str = "v1", threshold: float = 0.55) -> DataFrame:
    """One row per spike: its best candidate's score and the cause class; no candidate is cause C with score 0."""
    top = ranked.where("rank = 1").select("code", "cause_score", "score_channel", "score_category", "score_specificity", "score_material")
    return spikes.join(top, "code", "left").select(*spikes.columns, cause_type(mode, threshold).alias("cause_type"), F.coalesce("cause_score", F.lit(0.0)).alias("cause_score"))


def joined_code(c: str) -> Column:
    return F.upper(F.trim(F.col(c).cast("string")))


def enrich(indicators: DataFrame, summaries: DataFrame, candidates: DataFrame, n: int = 3) -> DataFrame:
    """Indicators with cause class and the ``n`` best candidates' title, url, source and score in slots 1..n.

    ``summaries``: code, cause_type, top_title, ordinal (the last summary of a
    code counts); ``candidates``: code, title, url, source, rank, cause_score,
    ordinal, taken by rank, then higher score (missing ones last), then place.
    Codes meet trimmed and in upper case.  Instruments without a summary stay
    blank.  Cause C has the one title that says so.  A first candidate without
    a title takes the summary's; without that too, the cause becomes C.  Where
    there is no candidate, the summary's title stands alone.

    Candidates are cut to ``n`` a code by a ranking that each task limits
    first: a hot code sends ``n`` rows a task.
    """
    text = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))
    order = [F.asc_nulls_last("rank"), F.desc_nulls_last("cause_score"), F.asc("ordinal")]
    ranked = candidates.select(joined_code("code").alias("_code"), "rank", "cause_score", "ordinal", text("title").alias("title"), text("url").alias("url"), text("source").alias("source"))
    top = ranked.withColumn("_k", F.row_number().over(Window.partitionBy("_code").orderBy(*order))).where(F.col("_k") <= n)
    slots = top.groupBy("_code").agg(F.array_sort(F.collect_list(F.struct("_k", "title", "url", "source", F.col("cause_score").alias("score")))).alias("_c"))
    said = summaries.groupBy(joined_code("code").alias("_code")).agg(F.max_by(F.struct(F.upper(text("cause_type")).alias("cause"), text("top_title").alias("top")), "ordinal").alias("_s"))
    rows = indicators.withColumn("_code", joined_code("code")).join(said, "_code", "left").join(slots, "_code", "left")
    known = F.col("_s").isNotNull() & (F.length("_code") > 0)
    cause = F.coalesce(F.nullif(F.col("_s.cause"), F.lit("")), F.lit("C"))
    fallback, first = F.col("_s.top"), F.get("_c", F.lit(0))
    has = F.coalesce(F.size("_c"), F.lit(0)) > 0
    untitled = has & (first["title"] == "")
    lost = untitled & (fallback == "")
    title = F.when(cause == "C", NO_CAUSE_TITLE).when(lost, NO_CAUSE_TITLE).when(untitled, fallback).when(has, first["title"]).otherwise(fallback)
    added = {"event_cause_type": F.when(~known, "").when(lost, "C").otherwise(cause)}
    for i in range(1, n + 1):
        slot, there = F.get("_c", F.lit(i - 1)), known & (cause != "C") & (F.coalesce(F.size("_c"), F.lit(0)) >= i)
        url = F.when(there & ~(lost if i == 1 else F.lit(False)), slot["url"]).otherwise("")
        added |= {
            f"event_news_{i}_title": F.when(known, title).otherwise("") if i == 1 else F.when(there, slot["title"]).otherwise(""),
            f"event_news_{i}_url": url,
            f"event_news_{i}_source": F.when(there, slot["source"]).otherwise(""),
            f"event_news_{i}_score": F.when(there, slot["score"]),
        }
    return rows.select(*[F.col(c) for c in indicators.columns], *[v.alias(k) for k, v in added.items()])


def dedup_with_preference(events: DataFrame, keys: list[str], preferred: Column, confidence: str, ordinal: str) -> DataFrame:
    """One row per identity: preferred source first, then higher confidence, then earlier arrival."""
    cols = [c for c in events.columns if c not in keys]
    best = F.max_by(F.struct(*cols), F.struct(preferred.cast("int").alias("p"), F.col(confidence).alias("c"), (-F.col(ordinal)).alias("o")))
    return events.groupBy(*keys).agg(best.alias("_r")).select(*keys, "_r.*")


def within_days(ts: str, start: str, end: str) -> Column:
    return F.to_date(ts).between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def cutoff_time(run_date: str, cutoff: str | None) -> datetime | None:
    """``HH:MM`` on the run date; anything else is an error, nothing is no cutoff."""
    if cutoff is None:
        return None
    found = re.fullmatch(r"\s*(\d{1,2}):(\d{1,2})\s*", cutoff)
    if not found or int(found[1]) > 23 or int(found[2]) > 59:
        raise ValueError(f"a cutoff is HH:MM, not {cutoff!r}")
    return datetime.combine(date.fromisoformat(run_date), time(int(found[1]), int(found[2])))


def within_cutoff(published: Column, run_date: str, cutoff: str | None) -> Column:
    """Whether an ISO time is not after the cutoff, by its wall clock: a zone does not count. No time that can be read: no; no cutoff: yes."""
    at = cutoff_time(run_date, cutoff)
    if at is None:
        return F.lit(True)
    wall = F.regexp_replace(F.trim(published.cast("string")), r"(Z|[+-]\d{2}:?\d{2})$", "")
    return F.coalesce(wall.try_cast("timestamp_ntz") <= F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz"), F.lit(False))


def without_categories(events: DataFrame, column: str, excluded: list[str]) -> DataFrame:
    """Events whose trimmed category is none of the excluded ones; those without a category stay."""
    names = [x.strip() for x in excluded if x.strip()]
    return events.where(~F.coalesce(F.trim(column).isin(names), F.lit(False))) if names else events


def starts_with(word: str):
    return lambda x: F.trim(x).startswith(word.upper())


def selection(rules: list[dict], columns: list[str]) -> Column:
    """Any-of selection rules; a missing column or an unreadable value never selects, no rules select nothing."""
    preds = []
    for r in rules:
        kind = str(r.get("type", "")).strip().lower()
        c = str(r.get("column", "")).strip()
        if kind == "candle_labels_contains_any":
            c = c or "candle_labels"
            wanted = [t for t in (str(v).strip().upper() for v in r.get("values") or []) if t]
            if c in columns:
                parts = F.split(F.upper(F.coalesce(F.col(c), F.lit(""))), ",")
                preds += [F.exists(parts, starts_with(t)) for t in wanted]
        elif kind in ("z_turnover_gt", "z_turnover_lt") and c in columns and number(r.get("value")) is not None:
            x, least = F.col(c).try_cast("double"), F.lit(number(r["value"]))
            preds.append(F.coalesce(x > least if kind == "z_turnover_gt" else x < least, F.lit(False)) & ~F.coalesce(F.isnan(x), F.lit(False)))
    return reduce(lambda a, b: a | b, preds, F.lit(False))


def number(value: object) -> float | None:
    """A rule's threshold; None if it is missing, no number or NaN."""
    try:
        x = float(value)  # type: ignore[arg-type]
    except (TypeError, ValueError):
        return None
    return None if x != x else x


def selection_rules(given: dict | None, column: str = "z_turnover_60", threshold: float = 3.5) -> list[dict]:
    """The any-of rules of a configuration; without any, turnover above the threshold."""
    some = given.get("any_of") if isinstance(given, dict) else None
    return list(some) if some else [{"type": "z_turnover_gt", "column": column, "value": float(threshold)}]

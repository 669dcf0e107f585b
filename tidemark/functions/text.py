"""Code normalisers, text keys, links and calendar helpers as columns; Unicode forms through Arrow."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

#: Texts of a batch that are Python strings at a time.
AT_ONCE = 64


def normalised(form: str, c: Column) -> Column:
    """A Unicode form of a text; ASCII is every form of itself and stays in the JVM."""

    def run(texts: pa.Array) -> pa.Array:
        out = []
        for i in range(0, len(texts), AT_ONCE):
            piece = texts[i : i + AT_ONCE]
            if piece.null_count < len(piece):
                piece = pa.array([x if x is None or unicodedata.is_normalized(form, x) else unicodedata.normalize(form, x) for x in piece.to_pylist()], piece.type)
            out.append(piece)
        return pa.concat_arrays(out) if out else texts

    wide = F.when(F.octet_length(c) > F.char_length(c), c)
    return F.coalesce(arrow_udf(run, "string")(wide), c)


def nfc(c: Column) -> Column:
    return normalised("NFC", c)


def nfkc(c: Column) -> Column:
    return normalised("NFKC", c)


def universe_code(c: Column) -> Column:
    """``1234.0`` is 1234; all-digit codes are padded to four places."""
    t = F.regexp_replace(F.trim(c.cast("string")), r"\.0$", "")
    return F.when(t.rlike("^[0-9]{1,3}$"), F.lpad(t, 4, "0")).otherwise(t)


def metric_code(c: Column) -> Column:
    """Trimmed; numeric codes shorter than four places are padded."""
    t = F.trim(c)
    return F.when(t.rlike("^[0-9]{1,3}$"), F.lpad(t, 4, "0")).otherwise(t)


def alias_code(c: Column) -> Column:
    """Upper-case 4 or 5 characters; a five-character code loses a trailing zero; others are null."""
    t = F.upper(F.trim(c))
    ok = t.rlike("^[0-9A-Z]{4,5}$")
    return F.when(ok, F.when((F.length(t) == 5) & t.endswith("0"), F.substring(t, 1, 4)).otherwise(t))


def filing_code(c: Column) -> Column:
    t = F.trim(c)
    return F.when((F.length(t) == 5) & t.endswith("0"), F.substring(t, 1, 4)).otherwise(t)


def delisted_code(c: Column) -> Column:
    t = F.trim(c)
    return F.when(t.rlike("^[0-9]+$") & (F.length(t) < 4), F.lpad(t, 4, "0")).otherwise(t)


def joined_code(c: Column) -> Column:
    return F.upper(F.trim(c))


def half_width(c: Column) -> Column:
    """Full-width ASCII letters, digits and signs to their half-width forms, and the wide space."""
    wide = "".join(chr(x) for x in range(0xFF01, 0xFF5F)) + "　"
    return F.translate(c, wide, "".join(chr(x - 0xFEE0) for x in range(0xFF01, 0xFF5F)) + " ")


def dedup_key(c: Column) -> Column:
    """Lower-cased without spaces and punctuation."""
    return F.regexp_replace(F.lower(half_width(c)), r"[\s\p{Punct}・ー－]", "")


def ticker(code: Column) -> Column:
    return F.concat(code, F.lit(".T"))


def month_ago_first(run_date: Column, months: int = 2) -> Column:
    """First day of the month some months back."""
    return F.trunc(F.add_months(run_date, -months), "month")


def month_keys(start: Column, end: Column) -> Column:
    """``yyyyMM`` of each month touched."""
    return F.transform(F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.make_ym_interval(F.lit(0), F.lit(1))), lambda d: F.date_format(d, "yyyyMM"))


def trading_days_to_calendar(n: Column) -> Column:
    return F.floor(n * 366 / 245).cast("int") + 90


def release_tag(c: Column) -> tuple[Column, Column]:
    """Date and run id of ``...-YYYYMMDD-rN`` tags."""
    return F.try_to_date(F.nullif(F.regexp_extract(c, r"(\d{8})", 1), F.lit("")), "yyyyMMdd"), F.regexp_extract(c, r"-r(\d+)$", 1).try_cast("long")


def bar_status(fetched: Column, wanted: Column, last: Column, run_date: Column) -> Column:
    """insufficient, stale or ok; without a run date nothing is stale."""
    return F.when(fetched < wanted, "insufficient").when(run_date.isNotNull() & (last.isNull() | (last < run_date)), "stale").otherwise("ok")


def patched_key(c: Column) -> tuple[Column, Column]:
    """Monthly tag and patch date of ``universe-patched-TAG-YYYY-MM-DD``; nulls where it is none."""
    tag = F.regexp_extract(c, r"^universe-patched-(.+?)-*-(\d{4}-\d{2}-\d{2})$", 1)
    date = F.try_to_date(F.nullif(F.regexp_extract(c, r"^universe-patched-(.+?)-*-(\d{4}-\d{2}-\d{2})$", 2), F.lit("")), "yyyy-MM-dd")
    return F.when(date.isNotNull(), F.nullif(tag, F.lit(""))), date

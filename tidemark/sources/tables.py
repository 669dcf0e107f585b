"""Sources: explicit schemas, file readers and market proxies over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BARS = T.StructType([T.StructField("date", T.StringType()), *[T.StructField(c, T.DoubleType()) for c in ("open", "high", "low", "close", "volume")]])
EVENTS = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("code", "source", "published_at", "title", "raw_text_short", "event_type", "event_polarity", "issuer_specificity", "novelty_level", "expected_impact_horizon", "event_scope", "originality", "url", "source_category", "listing_exchange")]
    + [T.StructField("confidence_base", T.DoubleType()), T.StructField("has_xbrl", T.BooleanType()), T.StructField("has_update_history", T.BooleanType())]
)
MANIFEST = T.StructType(
    [T.StructField("code", T.StringType()), T.StructField("symbol", T.StringType()), T.StructField("requested_days", T.IntegerType()), T.StructField("fetched_bars", T.IntegerType()), T.StructField("status", T.StringType()), T.StructField("error", T.StringType()), T.StructField("fetched_at", T.StringType()), T.StructField("newly_fetched_days", T.IntegerType())]
)
#: Values of an event field that is missing or blank.
EVENT_DEFAULTS = {"source": "unknown", "event_type": "other", "event_polarity": "neutral", "issuer_specificity": "medium", "novelty_level": "medium"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing numbers are NULL throughout the engine, never NaN."""
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])


def session_date(c: Column, zone: str = "Asia/Tokyo") -> Column:
    """Trading-session day of an ISO timestamp; a plain date is that day."""
    text = F.trim(c)
    return F.when(F.length(text) <= 10, F.try_to_date(text)).otherwise(F.to_date(F.from_utc_timestamp(F.try_to_timestamp(text), zone)))


def line_order() -> Column:
    """Order of the lines of text files: by file name, then place in the file, whatever the splits of the scan."""
    return F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("n"))


def read_bars(spark: SparkSession, path: str) -> DataFrame:
    """OHLCV CSV files, one per instrument (the file name is the code); the last row of a date wins."""
    raw = spark.read.schema(BARS).option("header", True).option("enforceSchema", True).csv(path).withColumn("_f", F.col("_metadata.file_name")).withColumn("_o", line_order())
    rows = raw.select(F.regexp_extract("_f", r"^(.*)\.csv", 1).alias("code"), session_date(F.col("date")).alias("date"), "open", "high", "low", "close", "volume", "_o")
    return nan_to_null(keep_last(rows.where("date is not null"), ["code", "date"], "_o").drop("_o"))


def keep_last(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Last row of each key by ``order``; one pre-aggregated maximum, no window."""
    cols = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.col(order)).alias("_r")).select(*keys, "_r.*")


def keep_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    cols = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*cols), F.col(order)).alias("_r")).select(*keys, "_r.*")


def read_manifest(spark: SparkSession, path: str, prefer: str = "symbol") -> DataFrame:
    """Fetch manifest JSONL: corrupt lines are skipped, the last line of a key wins."""
    raw = spark.read.schema(T.StructType([*MANIFEST.fields, T.StructField("_corrupt", T.StringType())])).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    other = "code" if prefer == "symbol" else "symbol"
    rows = raw.withColumn("_o", line_order()).where("_corrupt is null").drop("_corrupt").withColumn("key", F.coalesce(prefer, other))
    return keep_last(rows.where("key is not null"), ["key"], "_o").drop("_o")


def event_defaults(df: DataFrame) -> DataFrame:
    """Lower-cased event fields with defaults; no confidence, or 0, means 0.5; rows without a code go."""
    clean = {c: F.coalesce(F.nullif(F.trim(F.lower(c)), F.lit("")), F.lit(d)) for c, d in EVENT_DEFAULTS.items()}
    clean["confidence_base"] = F.coalesce(F.nullif("confidence_base", F.lit(0.0)), F.lit(0.5))
    return df.withColumns(clean).where(F.length(F.trim("code")) > 0)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return event_defaults(spark.read.schema(EVENTS).option("mode", "DROPMALFORMED").json(path))


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    """Code list CSV; codes stay strings, blanks go."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(F.trim("code").alias("code"), *[F.col(c) for c in raw.columns if c == "name"]).where(F.length("code") > 0)


def latest_run(df: DataFrame, column: str = "run_date", up_to: str | None = None) -> DataFrame:
    """Rows of the newest run not after ``up_to``; the maximum is a scalar subplan, not a sort."""
    rows = df if up_to is None else df.where(F.col(column) <= F.lit(up_to).cast("date"))
    top = rows.agg(F.max(column).alias("_top"))
    return rows.join(F.broadcast(top), F.col(column) == F.col("_top")).drop("_top")


# Market proxies over the driver's star schema.

def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per nation: first, largest, least and last price of a day's lines, and their quantity."""
    line = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", F.to_date("l_shipdate").alias("date"))
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("code"))
    rows = line.join(supplier, line["l_suppkey"] == supplier["s_suppkey"]).join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
    seq = F.struct("l_orderkey", "l_linenumber", "l_extendedprice")
    return rows.groupBy("code", "date").agg(
        F.min_by("l_extendedprice", seq).alias("open"),
        F.max("l_extendedprice").alias("high"),
        F.min("l_extendedprice").alias("low"),
        F.max_by("l_extendedprice", seq).alias("close"),
        F.sum("l_quantity").alias("volume"),
    )


def benches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two benchmark series: the last line of each day over all lines, and over returned ones."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag", F.to_date("l_shipdate").alias("date"))
    marked = line.withColumn("bench", F.explode(F.when(F.col("l_returnflag") == "R", F.array(F.lit("topix"), F.lit("nikkei"))).otherwise(F.array(F.lit("topix")))))
    return marked.groupBy("bench", "date").agg(F.max_by("l_extendedprice", F.struct("l_orderkey", "l_linenumber", "l_extendedprice")).alias("close"))


def sessions(axis: DataFrame, as_of: str, n: int) -> DataFrame:
    """Last ``n`` distinct session dates not after ``as_of`` (a calendar: bounded by its days)."""
    days = axis.select("date").where(F.col("date") <= F.lit(as_of).cast("date")).distinct()
    return days.orderBy(F.desc("date")).limit(n)


def chunk_bounds(df: DataFrame, start: str, end: str, days: int = 400, overlap: int = 1) -> DataFrame:
    """Fetch windows of ``days`` calendar days that overlap by ``overlap``, one row per chunk."""
    step = F.make_interval(days=F.lit(days - overlap))
    starts = F.sequence(F.col(start), F.col(end), step)
    return df.withColumn("chunk_start", F.explode(starts)).withColumn("chunk_end", F.least(F.date_add("chunk_start", days - 1), F.col(end)))



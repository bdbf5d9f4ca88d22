"""Normalising raw payloads and data quality: P1-P7, Q1-Q11."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PAYLOAD = "time string, open string, high string, low string, close string, volume string"


def number(c: Column | str) -> Column:
    """Bad text, NaN and infinities become null."""
    x = (F.col(c) if isinstance(c, str) else c).try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def usable(c: Column | str) -> Column:
    """A finite price above zero; NaN sorts above all numbers, so it is excluded by name."""
    x = F.col(c) if isinstance(c, str) else c
    return F.coalesce((x > 0) & ~F.isnan(x) & (x < float("inf")), F.lit(False))


def json_safe(df: DataFrame) -> DataFrame:
    """Dates and times as ISO text, numbers that are not finite as null."""
    safe = []
    for c, kind in df.dtypes:
        if kind in ("double", "float"):
            safe.append(F.when(~F.isnan(c) & (F.abs(F.col(c)) < float("inf")), F.col(c)).alias(c))
        elif kind == "date":
            safe.append(F.date_format(c, "yyyy-MM-dd").alias(c))
        elif kind.startswith("timestamp"):
            safe.append(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss").alias(c))
        else:
            safe.append(F.col(c))
    return df.select(*safe)


def raw_records(rows: DataFrame, symbol: str, day: str, fetched_at: str, bar_type: str = "1D") -> DataFrame:
    """Rows as they are kept raw: symbol, date and the whole row as JSON, with one ``fetched_at`` for a run; rows without a date that can be read are left out."""
    fine = json_safe(rows)
    parsed = F.to_date(F.try_to_timestamp(F.substring(F.col(day).cast("string"), 1, 10), F.lit("yyyy-MM-dd")))
    out = fine.select(F.col(symbol).alias("symbol"), F.lit(bar_type).alias("bar_type"), parsed.alias("bar_date"), F.to_json(F.struct(*(c for c in fine.columns if c != symbol))).alias("payload"))
    return out.where("bar_date is not null").withColumn("fetched_at", F.lit(fetched_at).cast("timestamp"))


def trimmed(rows: DataFrame, start: str, end: str) -> DataFrame:
    """By symbol, rows before, inside and after a window."""
    first, last = F.to_date(F.lit(start)), F.to_date(F.lit(end))
    return rows.groupBy("ticker").agg(
        F.count_if(F.col("bar_date") < first).alias("n_leading"), F.count_if(F.col("bar_date").between(first, last)).alias("n_inside"), F.count_if(F.col("bar_date") > last).alias("n_trailing")
    )


def normalise_index(raw: DataFrame, source: str) -> DataFrame:
    """Index rows from payloads: as bars, but no ``is_adjusted`` (P5)."""
    return normalise(raw, source).drop("is_adjusted").withColumnRenamed("ticker", "index_symbol")


def normalise(raw: DataFrame, source: str) -> DataFrame:
    """Typed bars from payload rows with ``dropped``: ``no_date``, ``no_close`` or null."""
    p = F.from_json("payload", PAYLOAD, {"mode": "FAILFAST"})
    rows = raw.withColumn("p", p).select(
        F.col("symbol").alias("ticker"),
        F.to_date(F.try_to_timestamp("p.time", F.lit("yyyy-MM-dd"))).alias("bar_date"),
        F.lit(source).alias("source"),
        *(number(F.col(f"p.{c}")).alias(c) for c in ("open", "high", "low", "close", "volume")),
        F.lit(True).alias("is_adjusted"),
        "fetched_at",
        "position",
    )
    return rows.withColumn("dropped", F.when(F.col("bar_date").isNull(), "no_date").when(F.col("close").isNull(), "no_close"))


def with_reason(rows: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """``reason``: the first check that a row fails - sanity, duplicates, window - or null (Q1-Q3, Q5)."""
    low_price = F.lit(False)
    for c in ("open", "high", "low", "close"):
        low_price = low_price | F.coalesce(F.col(c) <= 0, F.lit(False))
    sanity = low_price | F.coalesce(F.col("volume") < 0, F.lit(False)) | F.coalesce(F.col("high") < F.col("low"), F.lit(False))
    seen = F.row_number().over(W.partitionBy(*keys).orderBy("position", F.xxhash64(*[c for c in rows.columns if c not in keys])))
    outside = ~F.col("bar_date").between(F.to_date(F.lit(start)), F.to_date(F.lit(end)))
    return rows.withColumn("reason", F.when(sanity, "sanity").when(seen > 1, "duplicates").when(outside, "window"))


def ingest_report(rows: DataFrame) -> DataFrame:
    """One row by symbol: fetched, dropped, quarantined, written, first and last bar, status (Q7)."""
    kept = F.col("dropped").isNull() & F.col("reason").isNull()
    out = rows.groupBy("ticker").agg(
        F.count("*").alias("fetched"),
        F.count_if(F.col("dropped").isNull()).alias("normalised"),
        F.count_if(F.col("reason") == "window").alias("trimmed"),
        F.count_if(F.col("dropped") == "no_date").alias("no_date"),
        F.count_if(F.col("dropped") == "no_close").alias("no_close"),
        F.count_if(F.col("dropped").isNull() & F.col("reason").isNotNull()).alias("quarantined"),
        F.count_if(kept).alias("written"),
        F.min(F.when(kept, F.col("bar_date"))).alias("first_bar"),
        F.max(F.when(kept, F.col("bar_date"))).alias("last_bar"),
    )
    return out.withColumn("status", F.when(F.col("written") == 0, "empty").when(F.col("written") < F.col("fetched"), "degraded").otherwise("ok"))


def null_report(rows: DataFrame) -> DataFrame:
    """How many values are missing, which is no fault (Q1)."""
    return rows.agg(*(F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in ("open", "high", "low", "volume")))


def check_report(rows: DataFrame, scope: str, most: int = 20) -> DataFrame:
    """Rows (scope, check, passed, severity, n_bad, details): the first ``most`` offenders by key as JSON (Q6).

    Tasks keep their own first offenders by hash part before those of a check meet, so no list is longer than a few hundred.
    """
    checks = ("sanity", "duplicates", "window")
    bad = rows.where("reason is not null").select(F.col("reason").alias("check"), "ticker", "bar_date")
    counted = bad.groupBy("check").agg(F.count("*").alias("n_bad"))
    distinct = bad.distinct().withColumn("part", F.pmod(F.xxhash64("ticker", "bar_date"), F.lit(16)))
    first = lambda *by: F.row_number().over(W.partitionBy("check", *by).orderBy("ticker", "bar_date"))
    some = distinct.withColumn("k", first("part")).where(F.col("k") <= most).withColumn("k", first()).where(F.col("k") <= most)
    listed = some.groupBy("check").agg(F.to_json(F.array_sort(F.collect_list(F.struct("ticker", "bar_date")))).alias("details"))
    every = rows.sparkSession.range(len(checks)).select(F.element_at(F.array(*map(F.lit, checks)), (F.col("id") + 1).cast("int")).alias("check"))
    out = every.join(counted, "check", "left").join(listed, "check", "left")
    return out.select(F.lit(scope).alias("scope"), "check", F.col("n_bad").isNull().alias("passed"), F.lit("error").alias("severity"), F.coalesce("n_bad", F.lit(0)).alias("n_bad"), F.coalesce("details", F.lit("[]")).alias("details"))


def coverage(bars: DataFrame, sessions: DataFrame, least: float = 0.5) -> DataFrame:
    """Rows over expected sessions by ticker; a warning only; no sessions at all count as covered (Q4)."""
    n = sessions.select("bar_date").distinct().agg(F.count("*").alias("n_expected"))
    out = bars.groupBy("ticker").agg(F.countDistinct("bar_date").alias("n_rows")).join(F.broadcast(n))
    ratio = F.when(F.col("n_expected") == 0, 1.0).otherwise(F.col("n_rows") / F.col("n_expected"))
    return out.withColumn("ratio", ratio).withColumn("passed", F.col("ratio") >= least)


def run_status(report: DataFrame, has_index: bool = True, least: float = 0.5) -> DataFrame:
    """aborted, failed, degraded or ok from the share of symbols written (Q8)."""
    n, good = F.count("*"), F.count_if(F.col("written") > 0)
    share = F.try_divide(good, n)
    status = F.when(n == 0, "aborted").when(~F.lit(has_index) | (share < least), "failed").when(F.count_if(F.col("status") != "ok") > 0, "degraded").otherwise("ok")
    return report.agg(n.alias("n_symbols"), good.alias("n_good"), status.alias("status"))


def validate_listing(rows: DataFrame, exchanges: list[str]) -> DataFrame:
    """All or nothing (Q11): any bad row refuses the batch; equal duplicates collapse to the least name."""
    name = F.regexp_replace(F.trim("name"), r"\s+", " ")
    rows = rows.select(F.upper(F.trim("ticker")).alias("ticker"), F.upper(F.trim("exchange")).alias("exchange"), name.alias("name"))
    bad = rows.agg(
        F.count_if(~F.coalesce(F.col("ticker").rlike("^[A-Z0-9#]{3,12}$"), F.lit(False))).alias("ticker"),
        F.count_if(~F.coalesce(F.col("exchange").isin(exchanges), F.lit(False))).alias("exchange"),
        F.count_if(F.coalesce(F.col("name"), F.lit("")) == "").alias("name"),
    ).first().asDict()
    out = rows.groupBy("ticker").agg(F.min_by("name", F.struct(F.lower("name"), "name")).alias("name"), F.min("exchange").alias("exchange"), F.countDistinct("exchange").alias("n"), F.countDistinct(F.lower("name")).alias("names"))
    bad["conflict"] = out.where("n > 1 or names > 1").count()
    if any(bad.values()):
        raise ValueError(f"listing refused: {bad}")
    return out.select("ticker", "name", "exchange")

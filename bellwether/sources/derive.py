"""Bars, index bars and dimensions derived from transaction tables."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import discard, materialize

SOURCE = "lineitem"
ORDER = ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
#: Up to so many keys, the places of their first and last rows are broadcast, whatever the input.
FEW = 200_000
#: Over so many parts, more than a broadcast should hold, trades meet theirs by hash.
MANY = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trades(spark: SparkSession, sf_dir: str, unit: str = "week") -> DataFrame:
    """One row by line item: ticker (brand), session (start of the ``unit``), price and quantity."""
    return _priced(_lines(spark, sf_dir), _by_hash(_parts(spark, sf_dir))).withColumn("bar_date", _session(unit))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*ORDER, "l_returnflag")


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ticker of each part."""
    return table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("ticker"))


def _by_hash(part: DataFrame) -> DataFrame:
    """Parts to meet all trades. A join by order would put every trade of a task's share in order; by hash a task holds its share of the parts, and trades pass by."""
    return part.hint("shuffle_hash") if part.count() > MANY else part


def _priced(lines: DataFrame, part: DataFrame) -> DataFrame:
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select("ticker", (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), *ORDER, "l_returnflag")


def _session(unit: str) -> Column:
    return F.to_date(F.date_trunc(unit, "l_shipdate"))


def _known() -> Column:
    return F.when(F.col("l_returnflag") == "N", F.col("l_quantity"))


def _totals(ticks: DataFrame, keys: list[str], price: str, volume: Column, lead: str, *more: Column) -> DataFrame:
    """By ``keys``: extremes, volume, ``more``, and the first and last value of ``lead``, null after all others as in SQL.

    All of these are of fixed width, so Spark adds them up by hash as the rows come; a first or last price by a struct would sort every row.
    """
    last = F.when(F.count(lead) == F.count("*"), F.max(lead))
    return ticks.groupBy(*keys).agg(F.min(lead).alias("first_at"), last.alias("last_at"), F.max(price).alias("high"), F.min(price).alias("low"), F.sum(volume).alias("volume"), *more)


def _near(rows: DataFrame, totals: DataFrame, keys: list[str], lead: str) -> DataFrame:
    """The rows whose ``lead`` is the first or last one of their ``keys``; those of few places are looked up where they are, without a shuffle."""
    places = totals.select(*(F.col(c).alias(f"{c}__") for c in keys), F.explode(F.array("first_at", "last_at")).alias(f"{lead}__"))
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"{c}__")) for c in [*keys, lead]))
    return rows.join(F.broadcast(places) if totals.count() <= FEW else places, same, "left_semi")


def _with_ends(totals: DataFrame, near: DataFrame, keys: list[str], price: str, order: tuple[str, ...]) -> DataFrame:
    """The totals with first and last price by a total order of the row, null after all others; ``near`` has the rows at both ends, whatever else."""
    at = F.struct(*(x for k, c in enumerate(order) for x in (F.col(c).isNull().alias(f"n{k}"), F.col(c))))
    ends = near.groupBy(*(F.col(c).alias(f"{c}__") for c in keys)).agg(F.min_by(price, at).alias("open"), F.max_by(price, at).alias("close"))
    both = totals.join(ends, reduce(and_, (F.col(c).eqNullSafe(F.col(f"{c}__")) for c in keys)))
    return both.drop(*(f"{c}__" for c in keys), "first_at", "last_at")


def ohlcv(ticks: DataFrame, keys: list[str], price: str, volume: Column, order: tuple[str, ...]) -> DataFrame:
    """Bars by ``keys``: first and last price by a total order of the row, extremes, and volume (A10).

    Two passes: totals by hash, then the order of those rows only that have the first or last value of the leading column.
    """
    totals = materialize(_totals(ticks, keys, price, volume, order[0]))
    return _with_ends(totals, _near(ticks, totals, keys, order[0]), keys, price, order).select(*keys, "open", "high", "low", "close", "volume")


def days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars by ticker and ship date, with traded value and quantity: bars and index bars of every longer session are made of these few rows.

    As ``ohlcv``; the rows of first and last orders are picked before they meet their parts. They are few, so it is left to Spark which side to hold:
    small partitions of parts are put together, and by hash a task would hold many of them.
    """
    lines, part, keys = _lines(spark, sf_dir), _parts(spark, sf_dir), ["ticker", "l_shipdate"]
    more = (F.sum("l_extendedprice").alias("value"), F.sum("l_quantity").alias("quantity"))
    totals = materialize(_totals(_priced(lines, _by_hash(part)), keys, "price", _known(), ORDER[1], *more))
    near = _priced(_near(lines, totals, ["l_shipdate"], ORDER[1]), part)
    out = materialize(_with_ends(totals, near, keys, "price", ORDER[1:]))
    discard(totals)
    return out


def bars_of(days: DataFrame, unit: str = "week") -> DataFrame:
    """``(ticker, bar_date, source, open, high, low, close, volume)``; volume is null when unknown."""
    at = F.struct("l_shipdate")  # never null, as a row without a date is
    out = days.groupBy("ticker", _session(unit).alias("bar_date")).agg(
        F.min_by("open", at).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", at).alias("close"), F.sum("volume").alias("volume")
    )
    return out.select("ticker", "bar_date", F.lit(SOURCE).alias("source"), "open", "high", "low", "close", "volume")


def bars(spark: SparkSession, sf_dir: str, unit: str = "week") -> DataFrame:
    return bars_of(days(spark, sf_dir), unit)


def _index(rows: DataFrame, value: str, quantity: str) -> DataFrame:
    out = rows.groupBy("bar_date").agg((F.sum(value) / F.sum(quantity)).alias("close"))
    return out.select(F.lit("ALL").alias("index_symbol"), "bar_date", F.lit(SOURCE).alias("source"), "close")


def index_of(days: DataFrame, unit: str = "week") -> DataFrame:
    """The market level by session: total value over total quantity."""
    return _index(days.withColumn("bar_date", _session(unit)), "value", "quantity")


def index_bars(spark: SparkSession, sf_dir: str, unit: str = "week") -> DataFrame:
    """As ``index_of``, in one pass over the trades."""
    return _index(trades(spark, sf_dir, unit), "l_extendedprice", "l_quantity")


def stocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(ticker, sector, industry)``; a null sector means not known."""
    number = F.regexp_extract("ticker", r"(\d+)", 1).cast("int")
    return (
        table(spark, sf_dir, "part")
        .select(F.col("p_brand").alias("ticker"))
        .distinct()
        .select("ticker", F.when(number % 6 != 0, F.concat(F.lit("sector "), (number % 5).cast("string"))).alias("sector"), F.concat(F.lit("industry "), (number % 17).cast("string")).alias("industry"))
    )


def raw_bars(priced: DataFrame) -> DataFrame:
    """Payload rows as a vendor sends them, with faults planted by arithmetic on the date and ticker."""
    n = F.abs(F.datediff("bar_date", F.lit("1995-01-02"))) + F.regexp_extract("ticker", r"(\d+)", 1).cast("int")
    close = F.when(n % 97 == 0, F.lit("NaN")).when(n % 101 == 0, F.lit("0")).otherwise(F.col("close").cast("string"))
    day = F.when(n % 89 == 0, F.lit("no date")).otherwise(F.col("bar_date").cast("string"))
    swap = n % 103 == 0
    payload = F.to_json(
        F.struct(
            day.alias("time"),
            F.col("open").cast("string").alias("open"),
            F.when(swap, F.col("low") - 1).otherwise(F.col("high")).cast("string").alias("high"),
            F.col("low").cast("string").alias("low"),
            close.alias("close"),
            F.col("volume").cast("string").alias("volume"),
        )
    )
    rows = priced.select(F.col("ticker").alias("symbol"), payload.alias("payload"), F.lit("2002-01-01 00:00:00").cast("timestamp").alias("fetched_at"), n.alias("n"))
    return rows.withColumn("position", F.lit(0)).union(rows.where("n % 83 = 0").withColumn("position", F.lit(1))).drop("n")

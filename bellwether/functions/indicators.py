"""Technical indicators by ticker and session: W1-W12 as window columns, R1-R5 as recursions, R7 together.

A window with a missing value has no value: Spark's aggregates skip nulls, so ``full`` asks for n of n.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

KEY = ("ticker", "source")

def by():  # noqa: ANN201
    """Each series in order of session."""
    return W.partitionBy(*KEY).orderBy("bar_date")
YEAR = 252


def rows(n: int):  # noqa: ANN201
    return by().rowsBetween(-(n - 1), 0)


def full(n: int, value: Column, of: Column) -> Column:
    return F.when(F.count(of).over(rows(n)) == n, value)


def sma(x: Column, n: int) -> Column:
    return full(n, F.avg(x).over(rows(n)), x)


def rolling_max(x: Column, n: int) -> Column:
    return full(n, F.max(x).over(rows(n)), x)


def rolling_min(x: Column, n: int) -> Column:
    return full(n, F.min(x).over(rows(n)), x)


def trailing_return(close: Column, n: int) -> Column:
    base = F.lag(close, n).over(by())
    return F.when(base > 0, close / base - 1)


def realised_vol(x: Column, n: int) -> Column:
    """Sample deviation of log returns, annualised."""
    return full(n, F.stddev_samp(x).over(rows(n)) * math.sqrt(YEAR), x)


def stochastic_k(high: Column, low: Column, close: Column, n: int = 14) -> Column:
    top, bottom = rolling_max(high, n), rolling_min(low, n)
    return F.when(top == bottom, F.lit(50.0)).otherwise(100 * F.try_divide(close - bottom, top - bottom))


def true_range(high: Column, low: Column, close: Column) -> Column:
    """Undefined on the first row and where any part is unknown (``greatest`` would skip it)."""
    before = F.lag(close).over(by())
    parts = (high - low, F.abs(high - before), F.abs(low - before))
    return F.when(parts[0].isNotNull() & parts[1].isNotNull() & parts[2].isNotNull(), F.greatest(*parts))


def year_to_date(bars: DataFrame) -> DataFrame:
    """``ret_ytd``: over the last close before January 1; null in a ticker's first year."""
    # the last bar of the last earlier year with bars, whichever year it is
    before = W.partitionBy(*KEY).orderBy("y").rangeBetween(W.unboundedPreceding, -1)
    out = bars.withColumn("y", F.year("bar_date")).withColumn("base", F.max_by("close", "bar_date").over(before))
    return out.withColumn("ret_ytd", F.when(F.col("base") > 0, F.col("close") / F.col("base") - 1)).drop("y", "base")


def windowed(bars: DataFrame) -> DataFrame:
    """All bounded-window indicators; one shuffle by (ticker, source), one sort, several window passes."""
    c, h, lo, v = (F.col(x) for x in ("close", "high", "low", "volume"))
    out = year_to_date(bars)
    out = out.withColumns({"log_ret": F.log(F.when(F.lag(c).over(by()) > 0, c / F.lag(c).over(by()))), "stoch_k_14": stochastic_k(h, lo, c), "true_range": true_range(h, lo, c), "prev": F.lag(c).over(by())})
    signed = F.signum(c - F.col("prev")) * v
    run = by().rowsBetween(W.unboundedPreceding, 0)
    unknown = F.sum(F.when(F.col("prev").isNotNull() & signed.isNull(), 1).otherwise(0)).over(run)
    out = out.withColumns(
        {
            "sma_20": sma(c, 20),
            "sma_50": sma(c, 50),
            "sma_200": sma(c, 200),
            "volume_sma_20": sma(v, 20),
            "high_252d": rolling_max(c, YEAR),
            "low_252d": rolling_min(c, YEAR),
            "stoch_d_14": sma(F.col("stoch_k_14"), 3),
            "bb_sd": full(20, F.stddev_pop(c).over(rows(20)), c),
            "obv": F.when(F.col("prev").isNotNull() & (unknown == 0), F.sum(signed).over(run)),
            "realized_vol_20d": realised_vol(F.col("log_ret"), 20),
            "realized_vol_60d": realised_vol(F.col("log_ret"), 60),
            "turnover_value": c * v,
            **{f"ret_{n}d": trailing_return(c, n) for n in (1, 5, 20, 60, 252)},
        }
    )
    out = out.withColumns({"bb_upper_20": F.col("sma_20") + 2 * F.col("bb_sd"), "bb_lower_20": F.col("sma_20") - 2 * F.col("bb_sd"), "dist_from_sma_200_pct": F.try_divide(c, F.col("sma_200")) - 1, "drawdown_from_252d_high": F.try_divide(c, F.col("high_252d")) - 1})
    out = out.withColumn("bb_width_20", F.when(F.col("sma_20") > 0, (F.col("bb_upper_20") - F.col("bb_lower_20")) / F.col("sma_20")))
    return out.withColumnRenamed("sma_20", "bb_mid_20").withColumn("sma_20", F.col("bb_mid_20")).drop("prev", "log_ret", "bb_sd")


def ema(x: np.ndarray, n: int, alpha: float | None = None) -> np.ndarray:
    """Seeded with the mean of the first n known values in a row; a gap starts again after it."""
    out = np.full(len(x), np.nan)
    known = np.flatnonzero(np.isfinite(x))
    if len(known) < n:
        return out
    first = known[0]
    tail = pd.Series(np.concatenate(([x[first : first + n].mean()], x[first + n :])))
    out[first + n - 1 :] = tail.ewm(alpha=alpha or 2 / (n + 1), adjust=False).mean().to_numpy()
    return out


def wilder(x: np.ndarray, n: int) -> np.ndarray:
    return ema(x, n, 1 / n)


def rsi(close: np.ndarray, n: int = 14) -> np.ndarray:
    """No losses give exactly 100, a flat series too."""
    change = np.diff(close, prepend=np.nan)
    gain = wilder(np.where(np.isnan(change), np.nan, np.maximum(change, 0)), n)
    loss = wilder(np.where(np.isnan(change), np.nan, np.maximum(-change, 0)), n)
    with np.errstate(divide="ignore", invalid="ignore"):
        out = 100 - 100 / (1 + gain / loss)
    return np.where(np.isnan(gain), np.nan, np.where(loss == 0, 100.0, out))


RECURSIVE = ("ema_12", "ema_26", "macd", "macd_signal", "macd_hist", "rsi_14", "atr_14")


def _recursive_columns(pdf: pd.DataFrame) -> dict[str, np.ndarray]:
    """R1-R5 of one series in order of session."""
    c = pdf["close"].to_numpy(dtype=float)
    out = {"ema_12": ema(c, 12), "ema_26": ema(c, 26)}
    out["macd"] = out["ema_12"] - out["ema_26"]
    out["macd_signal"] = ema(out["macd"], 9)
    out["macd_hist"] = out["macd"] - out["macd_signal"]
    out["rsi_14"] = rsi(c)
    out["atr_14"] = wilder(pdf["true_range"].to_numpy(dtype=float), 14)
    return out


def recursive(rows_: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """R1-R5 by one grouped pass over each series of ``rows_(ticker, source, bar_date, close, true_range)``; ``carried`` columns come along."""

    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bar_date")
        return pdf[["ticker", "source", "bar_date", *carried]].assign(**_recursive_columns(pdf))

    kinds = dict(rows_.dtypes)
    schema = ", ".join(["ticker string, source string, bar_date date", *(f"{c} {kinds[c]}" for c in carried), *(f"{c} double" for c in RECURSIVE)])
    return rows_.select(*KEY, "bar_date", *dict.fromkeys(("close", "true_range", *carried))).groupBy(*KEY).applyInPandas(kernel, schema)


def long_ema(rows_: DataFrame, n: int, block: int = 4096, column: str = "close", alpha: float | None = None) -> DataFrame:
    """EMA (or with another ``alpha``) of the known values of series too long for one task: fold blocks, carry over block rows, replay blocks.

    y = a*y + b composes: a block is the pair (decay, sum), and only one row by block is ordered by series.
    """
    a = 1 - (alpha or 2 / (n + 1))
    numbered = rows_.where(F.col(column).isNotNull()).withColumn("rn", F.row_number().over(by())).withColumn("block", F.floor((F.col("rn") - 1 - n) / block))
    seed = numbered.where(f"rn <= {n}").groupBy(*KEY).agg(F.avg(column).alias("seed"), F.count("*").alias("n0"))
    tail = numbered.where(f"rn > {n}")
    folded = tail.groupBy(*KEY, "block").agg(F.sort_array(F.collect_list(F.struct("rn", "bar_date", F.col(column).alias("x")))).alias("v"))
    step = lambda s, q: s * a + q["x"] * (1 - a)
    sums = folded.select(*KEY, "block", F.size("v").alias("m"), F.aggregate("v", F.lit(0.0), step).alias("b"))
    carried = sums.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("block", "m", "b"))).alias("bs")).join(seed, list(KEY))
    start = carried.select(*KEY, F.explode(F.aggregate("bs", F.struct(F.col("seed").alias("y"), F.array().cast("array<struct<block:bigint,y:double>>").alias("out")), lambda s, q: F.struct((s["y"] * F.pow(F.lit(a), q["m"]) + q["b"]).alias("y"), F.concat(s["out"], F.array(F.struct(q["block"].alias("block"), s["y"].alias("y")))).alias("out")))["out"]).alias("o"))
    replay = folded.join(start.select(*KEY, F.col("o.block").alias("block"), F.col("o.y").alias("y0")), [*KEY, "block"])
    out = F.aggregate("v", F.struct(F.col("y0").alias("y"), F.array().cast("array<struct<bar_date:date,ema:double>>").alias("out")), lambda s, q: F.struct(step(s["y"], q).alias("y"), F.concat(s["out"], F.array(F.struct(q["bar_date"].alias("bar_date"), step(s["y"], q).alias("ema")))).alias("out")))["out"]
    first = numbered.where(f"rn = {n}").join(seed, list(KEY)).select(*KEY, "bar_date", F.col("seed").alias("ema"))
    return replay.select(*KEY, F.explode(out).alias("o")).select(*KEY, "o.bar_date", "o.ema").union(first)


def long_atr(bars: DataFrame, n: int = 14, block: int = 4096) -> DataFrame:
    """Wilder's mean of the true range of long series, as ``ema``."""
    ranges = bars.withColumn("true_range", true_range(F.col("high"), F.col("low"), F.col("close")))
    return long_ema(ranges.select(*KEY, "bar_date", "true_range"), n, block, "true_range", 1 / n)


def long_rsi(bars: DataFrame, n: int = 14, block: int = 4096) -> DataFrame:
    """RSI of long series from Wilder's means of gains and losses, as ``rsi``."""
    change = F.col("close") - F.lag("close").over(by())
    moves = bars.select(*KEY, "bar_date", F.greatest(change, F.lit(0.0) * change).alias("up"), F.greatest(-change, F.lit(0.0) * change).alias("down"))
    gain, loss = (long_ema(moves.select(*KEY, "bar_date", c), n, block, c, 1 / n).withColumnRenamed("ema", c) for c in ("up", "down"))
    value = F.when(F.col("down") == 0, F.lit(100.0)).otherwise(100 - 100 / (1 + F.try_divide("up", "down")))
    return gain.join(loss, [*KEY, "bar_date"]).select(*KEY, "bar_date", value.alias("rsi"))


def long_macd(bars: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9, block: int = 4096) -> DataFrame:
    """``macd, macd_signal, macd_hist`` of long series: the signal is a scan over the difference of two scans."""
    closes = bars.select(*KEY, "bar_date", "close")
    one, two = (long_ema(closes, n, block).withColumnRenamed("ema", name) for n, name in ((fast, "fast"), (slow, "slow")))
    both = one.join(two, [*KEY, "bar_date"]).select(*KEY, "bar_date", (F.col("fast") - F.col("slow")).alias("macd"))
    line = long_ema(both, signal, block, "macd").withColumnRenamed("ema", "macd_signal")
    return both.join(line, [*KEY, "bar_date"], "left").withColumn("macd_hist", F.col("macd") - F.col("macd_signal"))


def long_obv(bars: DataFrame, block: int = 4096) -> DataFrame:
    """On-balance volume of long series: sums within blocks of rows, and what the blocks before add up to; null from the first unknown step on."""
    before = F.lag("close").over(by())
    step = F.signum(F.col("close") - before) * F.col("volume")
    rows = bars.select(*KEY, "bar_date", before.isNotNull().alias("begun"), step.alias("step"), F.floor((F.row_number().over(by()) - 1) / block).alias("block"))
    rows = rows.withColumn("unknown", F.when(F.col("begun") & F.col("step").isNull(), 1).otherwise(0))
    inside = W.partitionBy(*KEY, "block").orderBy("bar_date").rowsBetween(W.unboundedPreceding, 0)
    earlier = W.partitionBy(*KEY).orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    totals = rows.groupBy(*KEY, "block").agg(F.sum("step").alias("total"), F.sum("unknown").alias("lost"))
    carried = totals.select(*KEY, "block", F.coalesce(F.sum("total").over(earlier), F.lit(0.0)).alias("carry"), F.coalesce(F.sum("lost").over(earlier), F.lit(0)).alias("lost"))
    at = rows.withColumns({"part": F.coalesce(F.sum("step").over(inside), F.lit(0.0)), "here": F.sum("unknown").over(inside)}).join(carried, [*KEY, "block"])
    known = F.col("begun") & (F.col("here") + F.col("lost") == 0)
    return at.select(*KEY, "bar_date", F.when(known, F.col("carry") + F.col("part")).alias("obv"))


#: The output columns, in their fixed order.
COLUMNS = (
    "sma_20", "sma_50", "sma_200", "ema_12", "ema_26", "macd", "macd_signal", "macd_hist", "rsi_14", "stoch_k_14", "stoch_d_14", "atr_14", "bb_mid_20", "bb_upper_20", "bb_lower_20", "bb_width_20",
    "realized_vol_20d", "realized_vol_60d", "obv", "volume_sma_20", "turnover_value", "ret_1d", "ret_5d", "ret_20d", "ret_60d", "ret_252d", "ret_ytd", "dist_from_sma_200_pct", "high_252d", "low_252d", "drawdown_from_252d_high",
)

#: First row, counted from 0, on which a column has a value; the year to date depends on the calendar.
WARM_UP = {
    "sma_20": 19, "sma_50": 49, "sma_200": 199, "ema_12": 11, "ema_26": 25, "macd": 25, "macd_signal": 33, "macd_hist": 33, "rsi_14": 14, "stoch_k_14": 13, "stoch_d_14": 15, "atr_14": 14,
    "bb_mid_20": 19, "bb_upper_20": 19, "bb_lower_20": 19, "bb_width_20": 19, "obv": 1, "volume_sma_20": 19, "realized_vol_20d": 20, "realized_vol_60d": 60, "high_252d": 251, "low_252d": 251, "dist_from_sma_200_pct": 199,
    "drawdown_from_252d_high": 251, "turnover_value": 0, "ret_1d": 1, "ret_5d": 5, "ret_20d": 20, "ret_60d": 60, "ret_252d": 252,
}


def indicators(bars: DataFrame) -> DataFrame:
    """One row by session, warm-up included, with the 31 columns; NaN and infinities become null once, here.

    The bars are read and dealt out by series once: windows, then one grouped pass for the recursions that carries the others along.
    """
    out = recursive(windowed(bars), tuple(c for c in COLUMNS if c not in RECURSIVE))
    clean = [F.when(~F.isnan(c) & (F.abs(F.col(c)) < float("inf")), F.col(c)).alias(c) for c in COLUMNS]
    return out.select(*KEY, "bar_date", *clean)


def warm_up_audit(ind: DataFrame) -> DataFrame:
    """Of each column, the first row with a value by ticker against the contract (Q9)."""
    numbered = ind.withColumn("rn", F.row_number().over(by()) - 1)
    firsts = numbered.groupBy(*KEY).agg(*(F.min(F.when(F.col(c).isNotNull(), F.col("rn"))).alias(c) for c in WARM_UP))
    names = ", ".join(f"'{c}', {c}, {n}" for c, n in WARM_UP.items())
    long = firsts.select(*KEY, F.expr(f"stack({len(WARM_UP)}, {names}) as (column, first_row, expected)"))
    return long.groupBy("column").agg(F.min("first_row").alias("first_row"), F.max("expected").alias("expected"), F.count_if(F.col("first_row") < F.col("expected")).alias("n_early"))


def null_counts(ind: DataFrame) -> DataFrame:
    return ind.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in COLUMNS))

"""Board questions over bars, indicators and a run: A1-A10, J1-J14, K1-K9, B1-B12."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.moments import trailing_moments

HORIZONS = {"1d": "ret_1d", "5d": "ret_5d", "1m": "ret_20d", "3m": "ret_60d", "1y": "ret_252d"}
RANGES = {"1m": 20, "3m": 60, "6m": 126, "1y": 252}
RATIOS = ("ret_1d", "ret_5d", "ret_20d", "ret_60d", "ret_252d", "ret_ytd", "realized_vol_20d", "realized_vol_60d", "drawdown_from_252d_high", "dist_from_sma_200_pct", "bb_width_20")


def latest_session(bars: DataFrame) -> DataFrame:
    """The last date of the bars (not of the indicators), one row (A1)."""
    return bars.agg(F.max("bar_date").alias("session_date"))


def latest(df: DataFrame) -> DataFrame:
    """The newest row of each ticker (K1)."""
    newest = F.row_number().over(W.partitionBy("ticker").orderBy(F.desc("bar_date"), "source"))
    return df.withColumn("__n", newest).where("__n = 1").drop("__n")


def overview(bars: DataFrame, ind: DataFrame, index: DataFrame) -> DataFrame:
    """One row always: counts, turnover and breadth of the session, and the index with its simple return."""
    day = latest_session(bars)
    rows = ind.join(F.broadcast(day), ind["bar_date"] == day["session_date"])
    r = F.col("ret_1d")
    facts = rows.agg(
        F.count("*").alias("n_tickers"), F.count(r).alias("n_with_return"), F.coalesce(F.sum("turnover_value"), F.lit(0.0)).alias("turnover"),
        F.count_if(r > 0).alias("advancers"), F.count_if(r < 0).alias("decliners"), F.count_if(r == 0).alias("unchanged"),
    )
    volume = bars.join(F.broadcast(day), bars["bar_date"] == day["session_date"]).agg(F.coalesce(F.sum("volume"), F.lit(0.0)).alias("volume"))
    level = index_history(index).join(F.broadcast(day), F.col("bar_date") == F.col("session_date")).agg(F.max("close").alias("index_close"), F.max("simple_return").alias("index_return"))
    return day.join(F.broadcast(facts)).join(F.broadcast(volume)).join(F.broadcast(level))


def sectors(bars: DataFrame, ind: DataFrame, stocks: DataFrame) -> DataFrame:
    """By sector on the latest session; an unknown sector is a group, labelled at output only."""
    day = latest_session(bars)
    rows = ind.join(F.broadcast(day), ind["bar_date"] == day["session_date"]).join(F.broadcast(stocks), "ticker", "left")
    rows = rows.join(bars.select("ticker", "bar_date", "source", "volume"), ["ticker", "bar_date", "source"], "left")
    return rows.groupBy("sector").agg(F.count("*").alias("n"), F.count("ret_1d").alias("n_with_return"), F.avg("ret_1d").alias("mean_return"), F.coalesce(F.sum("turnover_value"), F.lit(0.0)).alias("turnover"), F.coalesce(F.sum("volume"), F.lit(0.0)).alias("volume")).withColumn("label", F.coalesce("sector", F.lit("other")))


def movers_base(bars: DataFrame, ind: DataFrame, stocks: DataFrame) -> DataFrame:
    """Latest indicators, dimension, the bar of the same day, and whether the row is stale."""
    day = latest_session(bars)
    out = latest(ind).join(F.broadcast(stocks), "ticker", "left").join(bars.select("ticker", "bar_date", "source", "close", "volume"), ["ticker", "bar_date", "source"], "left")
    return out.join(F.broadcast(day)).withColumn("stale", F.col("bar_date") < F.col("session_date"))


def movers(base: DataFrame, horizon: str = "1d", direction: str = "up", limit: int = 10) -> DataFrame:
    """The largest moves over a horizon; ties by ticker (K2)."""
    if not 1 <= limit <= 100:
        raise ValueError("limit is 1 to 100")
    c = F.col(HORIZONS[horizon])
    order = c.desc_nulls_last() if direction == "up" else c.asc_nulls_last()
    return base.where(c.isNotNull()).orderBy(order, "ticker").limit(limit)


def liquidity(base: DataFrame, limit: int = 10) -> DataFrame:
    return base.orderBy(F.col("turnover_value").desc_nulls_last(), "ticker").limit(limit)


def index_history(index: DataFrame) -> DataFrame:
    """Every close with its simple return; the first has none (B7). One index is one small series."""
    prev = F.lag("close").over(W.partitionBy("index_symbol", "source").orderBy("bar_date"))
    return index.withColumn("simple_return", F.when(prev > 0, F.col("close") / prev - 1))


def index_range(history: DataFrame, span: str = "1y") -> DataFrame:
    """The last sessions of a span in ascending order; ``ytd`` from January 1 of the latest year; ``all`` (K4-K6)."""
    if span == "all":
        return history.orderBy("bar_date")
    if span == "ytd":
        day = history.agg(F.trunc(F.max("bar_date"), "year").alias("from_date"))
        return history.join(F.broadcast(day), F.col("bar_date") >= F.col("from_date")).drop("from_date").orderBy("bar_date")
    return history.orderBy(F.desc("bar_date")).limit(RANGES[span]).orderBy("bar_date")


def range_summary(history: DataFrame) -> DataFrame:
    """First, last, change, high and low of a range."""
    out = history.agg(F.min_by("close", "bar_date").alias("first"), F.max_by("close", "bar_date").alias("last"), F.max("close").alias("high"), F.min("close").alias("low"))
    return out.withColumn("change", F.col("last") - F.col("first")).withColumn("range_return", F.try_divide("last", "first") - 1)


def rounded(df: DataFrame) -> DataFrame:
    """Output form: ratios 6 digits, other numbers 2, half to even; volume whole (P10)."""
    kinds = dict(df.dtypes)
    return df.select(*(F.bround(c, 6 if c in RATIOS else 2).alias(c) if kinds[c] == "double" and c != "volume" else F.col(c).cast("long").alias(c) if c == "volume" else F.col(c) for c in df.columns))


def iso(df: DataFrame) -> DataFrame:
    """Dates as ISO text (P10)."""
    return df.select(*(F.date_format(c, "yyyy-MM-dd").alias(c) if kind == "date" else F.col(c) for c, kind in df.dtypes))


def in_millions(thousands: Column) -> Column:
    return thousands / 1000


def in_billions(thousands: Column) -> Column:
    return thousands / 1_000_000


def ticker_history(bars: DataFrame, ind: DataFrame, ticker: str, start: str | None = None, end: str | None = None, stocks: DataFrame | None = None) -> DataFrame:
    """Bars with indicators of one ticker, ascending: the last 252, or up to 2000 of a range.

    A ticker that is not registered in ``stocks`` (without it: has no bars) is a ``KeyError``; a registered one without bars has no rows (B10).
    """
    if not (bars if stocks is None else stocks).where(F.col("ticker") == ticker).limit(1).count():
        raise KeyError(ticker)
    from ..sources.store import between

    rows = between(bars.where(F.col("ticker") == ticker), start, end).orderBy(F.desc("bar_date")).limit(252 if start is None and end is None else 2000)
    return rows.join(ind, ["ticker", "bar_date", "source"], "left").orderBy("bar_date")


def ticker_detail(bars: DataFrame, ind: DataFrame, stocks: DataFrame, assigned: DataFrame) -> DataFrame:
    """Assignment, latest bar and indicators of every ticker."""
    return movers_base(bars, ind, stocks).join(assigned, "ticker", "left")


def anchors(steps: DataFrame, groups: DataFrame, stocks: DataFrame, n: DataFrame) -> DataFrame:
    """All steps of the run in order; those beyond the published ones have no group."""
    from ..operators.model import adjusted_coverage

    g = groups.withColumnRenamed("anchor", "ticker").drop("f")
    out = steps.join(F.broadcast(g), "ticker", "left").join(F.broadcast(stocks), "ticker", "left").join(F.broadcast(n))
    return out.withColumn("adjusted", adjusted_coverage(F.col("f").cast("double"), F.col("step"), F.col("n_universe"))).orderBy("step")


def group_detail(assigned: DataFrame, base: DataFrame) -> DataFrame:
    """Members by coverage, best first, with their latest moves if any."""
    return assigned.join(base.select("ticker", "sector", "close", "ret_1d", "ret_20d", "turnover_value"), "ticker", "left").orderBy("anchor", F.desc("c"), "ticker")


def composition(assigned: DataFrame, stocks: DataFrame) -> DataFrame:
    """Counts by sector of each group as a map (A4)."""
    counts = assigned.join(F.broadcast(stocks), "ticker", "left").groupBy("anchor", F.coalesce("sector", F.lit("other")).alias("sector")).count()
    return counts.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("k"), "sector", "count"))).alias("v")).select("anchor", F.array_join(F.transform("v", lambda x: F.concat_ws(":", x["sector"], x["count"].cast("string"))), ",").alias("composition"))


def serving_run(sessions: DataFrame, runs: DataFrame, warm_up: int = 0) -> DataFrame:
    """Of each session, the run that served it: the last one effective by then, after ``warm_up`` sessions."""
    numbered = sessions.withColumn("seq", F.row_number().over(W.orderBy("bar_date")))
    begins = runs.join(numbered, F.col("bar_date") >= F.col("effective"), "inner").groupBy("run_id", "effective").agg(F.min("seq").alias("from_seq"))
    marked = numbered.select("seq", "bar_date", F.lit(None).cast("string").alias("run_id")).union(begins.select(F.col("from_seq") + warm_up, F.lit(None).cast("date"), "run_id"))
    last = F.last("run_id", ignorenulls=True).over(W.orderBy("seq", F.col("bar_date").asc_nulls_first()).rowsBetween(W.unboundedPreceding, 0))
    return marked.withColumn("run_id", last).where("bar_date is not null").select("bar_date", "run_id")


def rolling_rho2(e: DataFrame, anchors_: DataFrame, n: int = 120) -> DataFrame:
    """Squared correlation of each ticker with each anchor over trailing sessions."""
    a = e.select(F.col("ticker").alias("anchor"), "bar_date", F.col("e").alias("ea")).join(F.broadcast(anchors_.select(F.col("ticker").alias("anchor"))), "anchor", "left_semi")
    both = e.join(a, "bar_date")
    both = trailing_moments(both, ["ticker", "anchor"], "e", "ea", n).where("m is not null")
    c, va, vb = F.col("m.c"), F.col("m.vx"), F.col("m.vy")
    return both.select("ticker", "anchor", "bar_date", F.least(F.lit(1.0), F.coalesce(F.try_divide(c * c, va * vb), F.lit(0.0))).alias("rho2"))


def beta_drift(panel: DataFrame, params: DataFrame, n: int = 120) -> DataFrame:
    """Rolling beta less the frozen one."""
    rolled = trailing_moments(panel, ["ticker"], "x", "f", n).withColumn("rolling", F.try_divide("m.c", "m.vy"))
    return rolled.where("rolling is not null").join(F.broadcast(params.select("ticker", "beta")), "ticker").select("ticker", "bar_date", (F.col("rolling") - F.col("beta")).alias("drift"))


def coverage_drift(rolling: DataFrame, assigned: DataFrame, tau: float) -> DataFrame:
    """By session: tickers whose best anchor now is another one, and those under tau (T5)."""
    best = rolling.groupBy("ticker", "bar_date").agg(F.max("rho2").alias("c"), F.min_by("anchor", F.struct(-F.col("rho2"), "anchor")).alias("now"))
    both = best.join(F.broadcast(assigned.select("ticker", "anchor")), "ticker")
    return both.groupBy("bar_date").agg(F.count_if(F.col("now") != F.col("anchor")).alias("n_challenged"), F.count_if(F.col("c") < tau).alias("n_under"), F.avg("c").alias("mean_c"))

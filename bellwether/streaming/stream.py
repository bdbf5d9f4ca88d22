"""Streaming forms: T1-T4 and T6. Each takes a streaming frame; ``run_once`` drives one to its end."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.clean import normalise, with_reason
from ..sources.merge import merge
from ..sources.scratch import temporary


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """A file stream of events (a folder or a pattern); event time as a timestamp, which watermarks need."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def run_once(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Process all that is there, to Parquet in the shared folder, and give it back as a batch frame."""
    spark = stream.sparkSession
    base = temporary(spark, "stream")
    q = stream.writeStream.format("parquet").outputMode(mode).option("path", f"{base}/out").option("checkpointLocation", f"{base}/log").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def distinct_events(stream: DataFrame, keys: list[str], late: str = "1 day") -> DataFrame:
    """The first event of each key within the watermark."""
    return stream.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def event_bars(stream: DataFrame, key: str = "event_type", span: str = "1 day", late: str = "1 day") -> DataFrame:
    """Open, high, low, close and volume by key and tumbling window; later events drop."""
    at = F.struct("ts", "event_id")
    bars = stream.withWatermark("ts", late).groupBy(F.window("ts", span), key).agg(
        F.min_by("value", at).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", at).alias("close"), F.sum("value").alias("volume"), F.count("*").alias("n")
    )
    return bars.select(key, F.to_date("window.start").alias("bar_date"), "open", "high", "low", "close", "volume", "n")


def joined_bars(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Bars of the events of both, whichever came first."""
    ends = {"open": F.min_by("open", "open_at"), "close": F.max_by("close", "close_at"), "open_at": F.min("open_at"), "close_at": F.max("close_at")}
    made = ends | {"high": F.max("high"), "low": F.min("low"), "volume": F.sum("volume"), "n": F.sum("n")}
    return a.unionByName(b).groupBy(*keys).agg(*(made[c].alias(c) for c in a.columns if c not in keys)).select(*a.columns)


def event_bars_into(stream: DataFrame, base: str, key: str = "event_type", span: str = "1 day"):  # noqa: ANN201
    """A query that keeps bars by key and tumbling window in a table of ``sources.merge``, by month: every event counts, however late.

    A batch's events make bars of their own, which are joined to those of their windows: first and last prices carry the time and number of their
    event. So nothing is held between batches, no window stays open or is given up, a batch rewrites the months it has events of, and one that comes again changes nothing.
    """
    keys = [key, "bar_date"]

    def step(batch: DataFrame, n: int) -> None:
        at = F.struct("ts", "event_id")
        bars = batch.groupBy(F.window("ts", span), key).agg(
            F.min_by("value", at).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", at).alias("close"), F.sum("value").alias("volume"), F.count("*").alias("n"),
            F.min(at).alias("open_at"), F.max(at).alias("close_at"),
        )
        bars = bars.withColumn("bar_date", F.col("window.start")).drop("window")
        merge(base, bars, keys, F.date_format("bar_date", "yyyy-MM"), number=n, how=lambda old, new: joined_bars(old, new, keys))

    return stream.writeStream.foreachBatch(step)


def quarantine_into(stream: DataFrame, source: str, start: str, end: str, keys: list[str], good: str, bad: str):  # noqa: ANN201
    """A query that normalises raw rows, splits them and upserts the good ones, batch by batch.

    ``good`` is a table of ``sources.merge``, by year: a batch writes the years it has rows of, whatever the table's size. A batch that comes again changes nothing.
    """

    def step(batch: DataFrame, n: int) -> None:
        rows = with_reason(normalise(batch, source).where("dropped is null"), keys, start, end)
        new = rows.where("reason is null").drop("reason", "dropped", "position", "fetched_at")
        merge(good, new, keys, F.year("bar_date"), number=n)
        rows.where("reason is not null").write.mode("overwrite").parquet(f"{bad}/{n}")

    return stream.writeStream.foreachBatch(step)


def frozen_residuals(returns: DataFrame, params: DataFrame) -> DataFrame:
    """Residuals of new sessions with the run's alpha and beta, and their z; no state, no refit (T4)."""
    out = returns.join(F.broadcast(params.select("ticker", "alpha", "beta", "sigma")), "ticker")
    e = F.col("x") - F.col("alpha") - F.col("beta") * F.col("f")
    return out.select("ticker", "bar_date", e.alias("e"), F.try_divide(e, F.col("sigma")).alias("z"))


class Ema(StatefulProcessor):
    """Running EMA by key, seeded with the mean of the first ``n`` values (T6). The rows of a batch are put in order of
    date whatever chunks they come in; a batch must not hold dates before those of an earlier one, else it is an error."""

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("ema", "seen int, value double, last date")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        seen, value, last = self.state.get() if self.state.exists() else (0, 0.0, None)
        ordered = pd.concat(list(rows))[["bar_date", "close"]].sort_values("bar_date")
        if last is not None and len(ordered) and ordered["bar_date"].iloc[0] <= last:
            raise ValueError(f"{key[0]}: a date up to {last} came again")
        out = []
        for day, x in ordered.itertuples(index=False):
            seen += 1
            value = value + x / self.n if seen <= self.n else value + (x - value) * 2 / (self.n + 1)
            out.append((key[0], day, value if seen >= self.n else None))
            last = day
        self.state.update((seen, value, last))
        yield pd.DataFrame(out, columns=["ticker", "bar_date", "ema"])

    def close(self) -> None:
        pass


def streaming_ema(stream: DataFrame, n: int = 12) -> DataFrame:
    return stream.groupBy("ticker").transformWithStateInPandas(Ema(n), "ticker string, bar_date date, ema double", "Append", "None")


class Running(StatefulProcessor):
    """Recursive indicators by key, with their state kept between batches (T6): EMA, MACD with its signal, RSI, ATR and on-balance volume.

    Each mean is (values seen, value): the mean of the first ``n`` values, then an exponential one, as ``functions.indicators.ema``. On-balance volume is unknown for good from the
    first step whose volume is unknown. Order and repeated dates as ``Ema``.
    """

    #: Name, length and weight of the newest value.
    MEANS = (("fast", 12, 2 / 13), ("slow", 26, 2 / 27), ("signal", 9, 2 / 10), ("gain", 14, 1 / 14), ("loss", 14, 1 / 14), ("range", 14, 1 / 14))
    SCHEMA = "ticker string, bar_date date, ema_12 double, ema_26 double, macd double, macd_signal double, rsi_14 double, atr_14 double, obv double"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("running", "seen array<int>, value array<double>, last date, close double, obv double, unknown boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        found = self.state.get() if self.state.exists() else ([0] * len(self.MEANS), [0.0] * len(self.MEANS), None, None, 0.0, False)
        seen, value, (last, before, obv, unknown) = list(found[0]), list(found[1]), found[2:]
        ordered = pd.concat(list(rows))[["bar_date", "high", "low", "close", "volume"]].sort_values("bar_date")
        if last is not None and len(ordered) and ordered["bar_date"].iloc[0] <= last:
            raise ValueError(f"{key[0]}: a date up to {last} came again")

        def push(m: int, x: float) -> float | None:
            _, n, weight = self.MEANS[m]
            seen[m] = min(seen[m] + 1, n + 1)
            value[m] = value[m] + x / n if seen[m] <= n else value[m] + (x - value[m]) * weight
            return value[m] if seen[m] >= n else None

        out = []
        for day, high, low, close, volume in ordered.itertuples(index=False):
            fast, slow = push(0, close), push(1, close)
            macd = fast - slow if slow is not None else None
            signal = push(2, macd) if macd is not None else None
            gain = loss = span = shown = None
            if before is not None:
                gain, loss = push(3, max(close - before, 0.0)), push(4, max(before - close, 0.0))
                span = push(5, max(high - low, abs(high - before), abs(low - before)))
                unknown = unknown or pd.isna(volume)
                if not unknown:
                    shown = obv = obv + float(volume) * ((close > before) - (close < before))
            rsi = None if gain is None else 100.0 if loss == 0 else 100 - 100 / (1 + gain / loss)
            out.append((key[0], day, fast, slow, macd, signal, rsi, span, shown))
            last, before = day, float(close)
        self.state.update((seen, value, last, before, obv, bool(unknown)))
        yield pd.DataFrame(out, columns=["ticker", "bar_date", "ema_12", "ema_26", "macd", "macd_signal", "rsi_14", "atr_14", "obv"])

    def close(self) -> None:
        pass


def streaming_indicators(stream: DataFrame) -> DataFrame:
    """``Running.SCHEMA`` for each row of ``stream(ticker, bar_date, high, low, close, volume)``."""
    return stream.groupBy("ticker").transformWithStateInPandas(Running(), Running.SCHEMA, "Append", "None")


def run_complete(stream: DataFrame) -> DataFrame:
    """Process all that is there and give back the last full result, windows that are still open included."""
    spark = stream.sparkSession
    base = temporary(spark, "stream")
    last: list[int] = []

    def step(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/{n}")
        last[:] = [n]

    stream.writeStream.outputMode("complete").option("checkpointLocation", f"{base}/log").foreachBatch(step).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/{last[0]}") if last else spark.createDataFrame([], stream.schema)

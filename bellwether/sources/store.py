"""Typed scans and sinks over Parquet, JSON lines, CSV and text; upserts, mirrors and marks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAR = T.StructType(
    [T.StructField("ticker", T.StringType()), T.StructField("bar_date", T.DateType()), T.StructField("source", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in ("open", "high", "low", "close", "volume")]
    + [T.StructField("is_adjusted", T.BooleanType()), T.StructField("ingested_at", T.TimestampType()), T.StructField("updated_at", T.TimestampType())]
)
SECTOR = T.StructType([T.StructField(c, T.StringType()) for c in ("ticker", "sector", "industry", "label_source")])
KEYS = {"bars": ["ticker", "bar_date", "source"], "index_bars": ["index_symbol", "bar_date", "source"], "returns": ["ticker", "bar_date", "source"], "indicators": ["ticker", "bar_date", "source"]}
KEEP = {"bars": ("ingested_at",), "index_bars": ("ingested_at",)}


def scan(spark: SparkSession, path: str, schema: T.StructType, source: str, keys: list[str] | None = None, start: str | None = None, end: str | None = None, key: str = "ticker") -> DataFrame:
    """Rows of one source, of the given keys and inclusive dates; filters reach the Parquet scan."""
    df = spark.read.schema(schema).parquet(path).where(F.col("source") == source)
    if keys is not None:
        df = df.where(F.col(key).isin(keys))
    return between(df, start, end)


def between(df: DataFrame, start: str | None, end: str | None, column: str = "bar_date") -> DataFrame:
    """Either bound may be absent; a start after the end is an error."""
    if start and end and start > end:
        raise ValueError(f"{start} is after {end}")
    df = df if start is None else df.where(F.col(column) >= F.to_date(F.lit(start)))
    return df if end is None else df.where(F.col(column) <= F.to_date(F.lit(end)))


def daily_bars(df: DataFrame) -> DataFrame:
    """The columns that models read of bars (S2); only these reach the scan."""
    return df.select("ticker", "bar_date", "close", "volume")


def of_tickers(df: DataFrame, tickers: DataFrame, key: str = "ticker") -> DataFrame:
    """Rows of the given tickers, however many, by a semi join (S3)."""
    return df.join(tickers.select(key).distinct(), key, "left_semi")


def write_bars(df: DataFrame, path: str) -> None:
    """Partitioned by year, clustered by ticker inside a file; a year is spread over tasks by ticker; only the years written are replaced."""
    out = df.withColumn("year", F.year("bar_date")).repartitionByRange("year", "ticker").sortWithinPartitions("year", "ticker", "bar_date")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)


def write_raw(df: DataFrame, path: str) -> None:
    df.sortWithinPartitions("symbol").write.mode("overwrite").option("compression", "gzip").json(path)


def scan_raw(spark: SparkSession, path: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """Raw payload rows fetched in a span; a line that cannot be read is an error."""
    rows = spark.read.schema("symbol string, payload string, fetched_at timestamp, position int").option("mode", "FAILFAST").json(path)
    rows = rows if since is None else rows.where(F.col("fetched_at") >= F.lit(since).cast("timestamp"))
    return rows if until is None else rows.where(F.col("fetched_at") <= F.lit(until).cast("timestamp"))


def scan_sectors(spark: SparkSession, path: str) -> DataFrame:
    """The dimension file; none gives an empty frame."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], SECTOR)
    return spark.read.schema(SECTOR).option("header", True).csv(path)


def write_sectors(df: DataFrame, path: str) -> None:
    df.orderBy("ticker").coalesce(1).write.mode("overwrite").option("header", True).csv(path)


TICKER = "^[A-Z0-9]+$"


def parse_universe(text: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tickers of whole universe files (a column ``value``, one small file a row): comments cut, upper-cased, distinct, sorted; and ``(line, value)`` of what is refused."""
    lines = text.select(F.posexplode(F.split("value", "\r?\n")).alias("line", "value")).withColumn("line", F.col("line") + 1)
    said = lines.select("line", "value", F.upper(F.trim(F.split("value", "#", 2)[0])).alias("ticker")).where("ticker <> ''")
    good = F.col("ticker").rlike(TICKER)
    return said.where(good).select("ticker").distinct().orderBy("ticker"), said.where(~good).select("line", "value").orderBy("line")


def universe(spark: SparkSession, tickers: list[str] | None = None, path: str | None = None) -> DataFrame:
    """An explicit list first, else the file; neither, or a bad line, is an error."""
    if tickers is not None:
        text = spark.createDataFrame([("\n".join(tickers),)], "value string")
    elif path is not None:
        text = spark.read.text(path, wholetext=True)
    else:
        raise ValueError("name tickers or a universe file")
    good, bad = parse_universe(text)
    refused = bad.limit(10).collect()
    if refused:
        raise ValueError("refused: " + "; ".join(f"line {r['line']}: {r['value']!r}" for r in refused))
    return good


def with_sector(stocks: DataFrame, mapping: DataFrame) -> DataFrame:
    """``sector`` from the ``mapping(industry, sector)``; an unknown industry has none and the label ``missing``."""
    out = stocks.drop("sector").join(F.broadcast(mapping.select("industry", "sector")), "industry", "left")
    return out.withColumn("label_source", F.when(F.col("sector").isNull(), "missing").otherwise("industry"))


def upsert(existing: DataFrame, batch: DataFrame, keys: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """The newer row of each key wins; ``keep`` columns stay as first written. Repeating a batch changes nothing."""
    order = [c for c in ("updated_at",) if c in batch.columns]
    rest = [c for c in existing.columns if c not in keys]
    # of a batch's rows for one key the last by time, then by content, so input order never matters
    latest = batch.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order, F.xxhash64(*rest))).alias("new"))
    old = existing.select(*keys, F.struct(*rest).alias("old"))
    both = old.join(latest, keys, "full_outer")
    pick = [F.coalesce(F.col(f"old.{c}"), F.col(f"new.{c}")) if c in keep else F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")) for c in rest]
    return both.select(*keys, *(p.alias(c) for p, c in zip(pick, rest, strict=True))).select(*existing.columns)


def fill_upsert(existing: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """A null never takes back a known value; of a batch's rows for one key the largest known value counts, column by column."""
    rest = [c for c in existing.columns if c not in keys]
    new = batch.groupBy(*keys).agg(*(F.max(c).alias(c) for c in rest))
    both = existing.alias("o").join(new.alias("n"), keys, "full_outer")
    return both.select(*keys, *(F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c) for c in rest)).select(*existing.columns)


def insert_absent(existing: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new keys; of several for one key the smallest by content, so input order never matters."""
    rest = [c for c in existing.columns if c not in keys]
    one = batch.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("new")).select(*keys, "new.*")
    return existing.unionByName(one.join(existing.select(*keys), keys, "left_anti"))


def replace_slice(existing: DataFrame, rows: DataFrame, version: str) -> DataFrame:
    """All rows of the versions in ``rows`` are replaced."""
    return existing.join(rows.select(version).distinct(), version, "left_anti").unionByName(rows)


def mirror(source: DataFrame, target: DataFrame, requested: DataFrame, keys: list[str], key: str = "ticker") -> tuple[DataFrame, DataFrame]:
    """The target with the requested keys' full history copied over, and a report by key with rows read (0: empty)."""
    moved = source.join(requested.select(key).distinct(), key, "left_semi").select(*target.columns)
    report = requested.select(key).distinct().join(moved.groupBy(key).count(), key, "left").select(key, F.coalesce("count", F.lit(0)).alias("n_rows"))
    return upsert(target, moved, keys), report


def high_water_marks(df: DataFrame, requested: DataFrame, key: str = "ticker") -> DataFrame:
    """The last date of every requested key, null if there is none."""
    return requested.select(key).distinct().join(df.groupBy(key).agg(F.max("bar_date").alias("last_date")), key, "left")


def load_run(tables: dict[str, DataFrame], run: dict[str, DataFrame], stocks: DataFrame) -> dict[str, DataFrame]:
    """Append a run's tables. Unknown tickers are refused; the same id and hash is a no-op, another hash an error."""
    unknown = run["universe"].join(stocks, "ticker", "left_anti").limit(5).collect()
    if unknown:
        raise ValueError(f"tickers not registered: {[r['ticker'] for r in unknown]}")
    head = run["runs"].first()
    known = tables["runs"].where(F.col("run_id") == head["run_id"]).first()
    if known is not None:
        if known["content_hash"] != head["content_hash"]:
            raise ValueError(f"run {head['run_id']} is loaded with other content")
        return tables
    return {k: tables[k].unionByName(run[k].withColumn("is_active", F.lit(False)) if k == "runs" else run[k]) for k in tables}


def activate(runs: DataFrame, run_id: str) -> DataFrame:
    """One active run for a measure; distance-correlation runs are never active."""
    row = runs.where(F.col("run_id") == run_id).first()
    if row is None or row["measure"].startswith("dcor"):
        raise ValueError(f"{run_id} cannot be active")
    return runs.withColumn("is_active", F.when(F.col("measure") == row["measure"], F.col("run_id") == run_id).otherwise(F.col("is_active")))


def compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one table that the other lacks, by side."""
    return a.exceptAll(b.select(*a.columns)).withColumn("side", F.lit("left")).unionByName(b.select(*a.columns).exceptAll(a).withColumn("side", F.lit("right")))


def run_listing(runs: DataFrame) -> DataFrame:
    """All runs in order of scope, measure and id."""
    return runs.select("scope_label", "measure", "run_id", "is_active").distinct().orderBy("scope_label", "measure", "run_id")

"""Bars against their SQL on odd rows, and what their derivation reads and sorts."""

import datetime
import random

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from bellwether.plans import queries
from bellwether.sources import derive, stored


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    """Few order keys, many on one day; null keys, brands, dates, prices and flags, rows without a part, equal rows."""
    draw, path = random.Random(3), tmp_path_factory.mktemp("odd")
    maybe = lambda x, p=0.12: None if draw.random() < p else x
    rows = []
    for _ in range(3000):
        day = datetime.datetime(1997, 1, 1) + datetime.timedelta(draw.randrange(100), hours=draw.choice((0, 0, 7)))
        rows.append((maybe(draw.randrange(6)), maybe(draw.randrange(40), 0.02), maybe(draw.randrange(3)), maybe(draw.randrange(3)), maybe(float(draw.randrange(1, 4))), maybe(float(draw.randrange(1, 9))), maybe(draw.choice("NRA")), maybe(day, 0.02)))
    rows += rows[:200]
    names = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.string(), pa.timestamp("us"))
    pq.write_table(pa.table({n: pa.array(x, k) for n, k, x in zip(names, kinds, zip(*rows), strict=True)}), path / "lineitem.parquet")
    pq.write_table(pa.table({"p_partkey": pa.array(range(35), pa.int64()), "p_brand": pa.array([None if k == 7 else f"Brand#{k % 4}" for k in range(35)])}), path / "part.parquet")
    return path


def sql(path, text):
    with duckdb.connect() as c:
        c.execute("SET threads TO 1")
        for t in ("lineitem", "part"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}/{t}.parquet')")
        return sorted(c.execute(text).fetchall(), key=str)


@pytest.mark.parametrize("unit", ["week", "month", "quarter"])
def test_bars_and_index_equal_their_sql(spark, odd, unit):
    text = queries.with_(queries.LINE, queries.BARS, unit=unit)
    want = sql(odd, text + "SELECT ticker, bar_date, open, high, low, close, volume FROM bars")
    level = sql(odd, text + "SELECT bar_date, round(close, 6) FROM idx")
    columns = "ticker", "bar_date", "open", "high", "low", "close", "volume"
    assert len(want) > 5 and any(x[0] is None for x in want) and any(x[1] is None for x in want)
    for b in (derive.bars(spark, str(odd), unit), queries._bars(spark, str(odd), unit)):
        assert sorted(map(tuple, b.select(*columns).collect()), key=str) == want
    for i in (derive.index_bars(spark, str(odd), unit), queries._index(spark, str(odd), unit)):
        assert sorted(((x["bar_date"], round(x["close"], 6)) for x in i.collect()), key=str) == level
    stored.forget(spark, str(odd))


def test_places_without_broadcast_give_the_same(spark, odd, monkeypatch):
    want = sorted(map(tuple, derive.bars(spark, str(odd)).collect()), key=str)
    monkeypatch.setattr(derive, "FEW", 0)
    assert sorted(map(tuple, derive.bars(spark, str(odd)).collect()), key=str) == want


def test_trades_are_read_for_one_table_whatever_the_units(spark, odd, monkeypatch):
    """A run over weeks and quarters asks for four tables: the trades are read for one, of which all are made."""
    read, table = [], derive.table
    monkeypatch.setattr(derive, "table", lambda s, d, name: read.append(name) or table(s, d, name))
    for unit in ("week", "quarter"):
        queries._bars(spark, str(odd), unit).count()
        queries._index(spark, str(odd), unit).count()
    stored.forget(spark, str(odd))
    assert read.count("lineitem") == 1


def plans(monkeypatch, spark, job):
    """The plans of all that is written on the way, and of the result."""
    seen, write = [], derive.materialize
    said = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(derive, "materialize", lambda df: seen.append(said(df)) or write(df))
    last = said(job())
    return [*seen, last]


def test_only_rows_at_both_ends_are_sorted(spark, odd, monkeypatch):
    """A first or last price by a struct sorts what it is given: all rows of a task's share of the input, before."""
    made = plans(monkeypatch, spark, lambda: derive.bars(spark, str(odd)))
    over = [p for p in made if "lineitem.parquet" in p]
    assert len(over) == 2 and all("LeftSemi" in p for p in over if "SortAggregate" in p) and any("SortAggregate" not in p for p in over)


def test_trades_of_many_parts_are_not_sorted_to_meet_them(spark, odd, monkeypatch):
    """Beyond a broadcast, Spark's own choice is a join that sorts each task's share of the trades, before."""
    want = sorted(map(tuple, derive.bars(spark, str(odd)).collect()), key=str)
    monkeypatch.setattr(derive, "MANY", 10, raising=False)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        made = plans(monkeypatch, spark, lambda: derive.bars(spark, str(odd)))
        level = derive.index_bars(spark, str(odd))._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, derive.bars(spark, str(odd)).collect()), key=str) == want
    finally:
        spark.conf.set(key, before)
    totals = [p for p in made if "lineitem.parquet" in p and "SortAggregate" not in p]
    assert len(totals) == 1 and all("ShuffledHashJoin" in p and "SortMergeJoin" not in p for p in [*totals, level])


def test_parts_of_the_few_rows_at_both_ends_are_not_held(spark, odd, monkeypatch):
    """The hint for all trades made tasks of the second join hold parts, several partitions put together, before."""
    monkeypatch.setattr(derive, "MANY", 10)
    made = plans(monkeypatch, spark, lambda: derive.bars(spark, str(odd)))
    near = [p for p in made if "lineitem.parquet" in p and "SortAggregate" in p]
    assert len(near) == 1 and "ShuffledHashJoin" not in near[0]

"""Closed forms, fixtures and mutations for the market operators."""

import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from bellwether.functions import indicators as ind
from bellwether.operators import clean, model
from bellwether.plans import board, validate
from bellwether.plans.narrative import RULES, narrative
from bellwether.sources import store

SF = "/root/testdata/sf0.001"
DAY = datetime.date(2020, 1, 1)


def series(spark, closes, ticker="A", spread=1.0):
    rows = [(ticker, DAY + datetime.timedelta(k), "s", float(c), float(c) + spread, float(c) - spread, float(c), 10.0) for k, c in enumerate(closes)]
    return spark.createDataFrame(rows, "ticker string, bar_date date, source string, open double, high double, low double, close double, volume double")


def block_p(spark, sizes=(4, 4, 4), inside=0.7, across=0.05):
    kind = [b for b, n in enumerate(sizes) for _ in range(n)]
    rows = [(f"T{i:02d}", f"T{j:02d}", 1.0 if i == j else inside if kind[i] == kind[j] else across) for i in range(len(kind)) for j in range(len(kind))]
    return spark.createDataFrame(rows, "i string, j string, p double").withColumn("p", F.col("p").cast(model.P_TYPE))


def test_ramp_and_constant_series(spark):
    out = ind.indicators(series(spark, range(1, 41))).orderBy("bar_date").collect()
    assert out[18]["sma_20"] is None and out[19]["sma_20"] == pytest.approx(10.5)
    assert out[13]["rsi_14"] is None and out[14]["rsi_14"] == 100
    assert out[14]["atr_14"] == pytest.approx(2.0)
    assert out[0]["obv"] is None and out[39]["obv"] == pytest.approx(390)
    flat = ind.indicators(series(spark, [5] * 40, spread=0.0)).orderBy("bar_date").collect()
    assert flat[20]["stoch_k_14"] == 50 and flat[20]["rsi_14"] == 100 and flat[39]["realized_vol_20d"] == 0


def test_ema_seed_and_long_form(spark):
    x = np.random.default_rng(3).normal(100, 5, 300)
    want = np.full(300, np.nan)
    want[11] = x[:12].mean()
    for k in range(12, 300):
        want[k] = want[k - 1] + (x[k] - want[k - 1]) * 2 / 13
    assert np.allclose(ind.ema(x, 12)[11:], want[11:])
    got = {r["bar_date"]: r["ema"] for r in ind.long_ema(series(spark, x), 12, block=17).collect()}
    assert all(got[DAY + datetime.timedelta(k)] == pytest.approx(want[k]) for k in range(11, 300))


def test_unknown_volume_spoils_later_balance(spark):
    b = series(spark, [1, 2, 3, 4]).withColumn("volume", F.when(F.col("close") != 3, F.col("volume")))
    assert [r["obv"] for r in ind.windowed(b).orderBy("bar_date").collect()] == [None, 10.0, None, None]


def test_warm_up_contract(spark):
    x = 100 + np.cumsum(np.random.default_rng(1).normal(0, 1, 300))
    audit = ind.warm_up_audit(ind.indicators(series(spark, x))).collect()
    assert all(r["first_row"] == r["expected"] for r in audit)


def test_year_to_date_rebases(spark):
    rows = [("A", datetime.date(2019, 12, 30), "s", 10.0), ("A", datetime.date(2019, 12, 31), "s", 20.0), ("A", datetime.date(2020, 1, 2), "s", 30.0)]
    out = ind.year_to_date(spark.createDataFrame(rows, "ticker string, bar_date date, source string, close double")).orderBy("bar_date").collect()
    assert [r["ret_ytd"] for r in out] == [None, None, 0.5]


def test_returns_skip_unusable_closes(spark):
    b = series(spark, [10, 0, float("nan"), 11]).withColumn("volume", F.lit(0.0))
    (r,) = model.returns(b).collect()
    assert r["x"] == pytest.approx(math.log(1.1)) and r["at_limit"] and r["zero_volume"]


def test_quarantine_gives_first_reason(spark):
    rows = [("A", "2020-01-01", 1.0, 2.0, 1.0, 1.5, 1.0, 0), ("A", "2020-01-01", 1.0, 2.0, 1.0, 1.5, 1.0, 1), ("A", "2020-01-02", 1.0, 0.5, 1.0, 1.5, 1.0, 0), ("A", "2030-01-02", 1.0, None, 1.0, 1.5, None, 0)]
    df = spark.createDataFrame(rows, "ticker string, d string, open double, high double, low double, close double, volume double, position int").withColumn("bar_date", F.to_date("d"))
    out = clean.with_reason(df, ["ticker", "bar_date"], "2020-01-01", "2020-12-31").orderBy("bar_date", "position").collect()
    assert [r["reason"] for r in out] == [None, "duplicates", "sanity", "window"]


def test_normalise_bad_payloads(spark):
    raw = spark.createDataFrame([("A", '{"time":"2020-01-01","close":"NaN"}', 0), ("A", '{"time":"x","close":"1"}', 0), ("A", '{"time":"2020-01-01","close":"1"}', 0)], "symbol string, payload string, position int").withColumn("fetched_at", F.current_timestamp())
    assert sorted(str(r["dropped"]) for r in clean.normalise(raw, "s").collect()) == ["None", "no_close", "no_date"]


def test_upsert_twice_is_once(spark):
    old = spark.createDataFrame([("A", 1, 1.0, "first"), ("B", 1, 2.0, "first")], "k string, d int, v double, at string")
    new = spark.createDataFrame([("B", 1, 3.0, "second"), ("C", 1, None, "second")], "k string, d int, v double, at string")
    once = store.upsert(old, new, ["k", "d"], keep=("at",))
    twice = store.upsert(once, new, ["k", "d"], keep=("at",))
    assert not once.exceptAll(twice).count() and {tuple(r) for r in once.collect()} == {("A", 1, 1.0, "first"), ("B", 1, 3.0, "first"), ("C", 1, None, "second")}


def test_stores_round_trip(spark, tmp_path):
    b = series(spark, [1, 2, 3]).withColumns({"is_adjusted": F.lit(True), "ingested_at": F.current_timestamp(), "updated_at": F.current_timestamp()})
    store.write_bars(b, f"{tmp_path}/bars")
    got = store.scan(spark, f"{tmp_path}/bars", store.BAR, "s", ["A"], "2020-01-02")
    assert got.count() == 2 and store.scan(spark, f"{tmp_path}/bars", store.BAR, "other").count() == 0
    assert store.scan_sectors(spark, f"{tmp_path}/none.csv").count() == 0
    good, bad = store.parse_universe(spark.createDataFrame([("a1 # x",), ("#",), ("b-",), ("A1",)], "value string"))
    assert [r[0] for r in good.collect()] == ["A1"] and bad.count() == 1
    with pytest.raises(ValueError):
        store.between(b, "2021-01-01", "2020-01-01")


def test_factor_recovery_and_constant_factor(spark):
    rng = np.random.default_rng(5)
    f = rng.normal(0, 0.01, 250)
    rows = [(f"T{k}", DAY + datetime.timedelta(t), float(b * f[t] + rng.normal(0, 0.001)), float(f[t])) for k, b in enumerate((0.5, 1.0, 1.5)) for t in range(250)]
    panel = spark.createDataFrame(rows, "ticker string, bar_date date, x double, f double")
    assert [r["beta"] for r in model.fit(panel).orderBy("ticker").collect()] == pytest.approx([0.5, 1.0, 1.5], abs=0.03)
    flat = model.fit(panel.withColumn("f", F.lit(0.0))).collect()
    assert all(r["beta"] == 0 and r["r2"] == 0 for r in flat)


def test_distance_correlation_matches_definition(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3, 30))
    e = spark.createDataFrame([(f"T{k}", DAY + datetime.timedelta(t), float(x[k, t])) for k in range(3) for t in range(30)], "ticker string, bar_date date, e double")

    def centre(v):
        d = np.abs(v[:, None] - v)
        return d - d.mean(0) - d.mean(1)[:, None] + d.mean()

    a = [centre(v) for v in x]
    got = {(r["i"], r["j"]): float(r["p"]) for r in model.dcor2(e, block=7, tile=2).collect()}
    for i in range(3):
        for j in range(3):
            want = (a[i] * a[j]).sum() / math.sqrt((a[i] ** 2).sum() * (a[j] ** 2).sum())
            assert got[f"T{i}", f"T{j}"] == pytest.approx(want, abs=1e-9)


def test_greedy_on_blocks_equals_exact(spark):
    p = block_p(spark)
    steps = model.greedy(p, 3).collect()
    assert [r["ticker"] for r in steps] == ["T00", "T04", "T08"]
    assert float(steps[-1]["f"]) == pytest.approx(3 * (1 + 3 * 0.7))
    assert model.exact_cover(p, 3).first()["f"] == steps[-1]["f"]
    assert model.groups(model.assign(p, model.greedy(p, 3))).count() == 3


def random_p(spark, seed, n=9):
    rng = np.random.default_rng(seed)
    m = rng.random((n, n)).round(6)
    m = np.maximum(m, m.T)
    np.fill_diagonal(m, 1)
    rows = [(f"T{i}", f"T{j}", float(m[i, j])) for i in range(n) for j in range(n)]
    return m, spark.createDataFrame(rows, "i string, j string, p double").withColumn("p", F.col("p").cast(model.P_TYPE))


def greedy_brute(m, k):
    chosen, c = [], np.zeros(len(m))
    for _ in range(k):
        gain = np.maximum(0, m - c[:, None]).sum(axis=0)
        gain[chosen] = -1
        chosen.append(int(np.argmax(gain.round(9))))
        c = np.maximum(c, m[:, chosen[-1]])
    return chosen, c


def test_runs_compared(spark):
    m, p = random_p(spark, 1)
    m2, p2 = random_p(spark, 2)
    (a, _), (b, cb) = greedy_brute(m, 3), greedy_brute(m2, 3)
    got = model.cross_year(p2, model.greedy(p, 3), model.greedy(p2, 3)).first()
    assert got["stale"] == pytest.approx(m2[:, a].max(axis=1).mean()) and got["direct"] == pytest.approx(cb.mean())
    assert got["ratio"] == pytest.approx(got["stale"] / got["direct"])
    got = model.compare_measures(p, p2, p2, 3).first()
    assert got["jaccard"] == pytest.approx(len(set(a) & set(b)) / len(set(a) | set(b)))
    assert got["mean_u"] == pytest.approx(m2[np.triu_indices(9, 1)].mean()) and got["mean_f_b"] == pytest.approx(cb.mean())


def test_zero_diagonal_and_flags(spark):
    m, p = random_p(spark, 3)
    zero = m.copy()
    np.fill_diagonal(zero, 0)
    a, b = greedy_brute(m, 4)[0], greedy_brute(zero, 4)[0]
    got = model.zero_diagonal(p, 4).orderBy("step").collect()
    assert [(r["ticker"], r["ticker_zero"]) for r in got] == [(f"T{x}", f"T{y}") for x, y in zip(a, b)]
    first = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), 4)
    assert [r["diverged"] for r in got] == [k >= first for k in range(4)]
    masked = p.where("i < j and i <> 'T0'").select("i", "j", F.lit(5).cast("long").alias("t"), F.col("p").cast("double").alias("p"))
    again = m.copy()
    again[0, 1:] = again[1:, 0] = 0
    (x, cx), (y, cy) = greedy_brute(m, 3), greedy_brute(again, 3)
    got = model.flag_sensitivity(p, masked, 3).first()
    assert got["before"] == pytest.approx((cx.sum() - 3) / 6) and got["after"] == pytest.approx((cy.sum() - 3) / 6) and got["min_t"] == 5
    assert got["jaccard"] == pytest.approx(len(set(x) & set(y)) / len(set(x) | set(y)))


def test_cross_year_without_common_anchors(spark):
    m, p = random_p(spark, 4)
    gone = spark.createDataFrame([("ZZ",)], "ticker string")
    got = model.cross_year(p, gone, model.greedy(p, 2)).first()
    assert got["stale"] == 0 and got["ratio"] == 0


def run_tables(spark):
    p = block_p(spark, (3, 3))
    params = spark.createDataFrame([(f"T{k:02d}", 0.0, 1.0, 0.1, 0.5) for k in range(6)], "ticker string, alpha double, beta double, sigma double, r2 double")
    steps = model.greedy(p, 4)
    assigned = model.assign(p, steps, 2)
    content = validate.fingerprint({"params": params, "steps": steps})
    head = content.select("*", F.lit(1).alias("version"), F.lit(6).alias("n"), F.lit(10).alias("t"), F.lit(0.6).alias("q"), F.lit(2).alias("k"), F.lit(4).alias("k_max"), F.to_date(F.lit("2020-01-02")).alias("window_start"), F.to_date(F.lit("2020-02-01")).alias("window_end"), F.to_date(F.lit("2020-01-01")).alias("prior_close_date"))
    universe = params.select("ticker", F.substring("ticker", 2, 2).cast("int").alias("position"))
    return {"run": head, "universe": universe, "params": params, "steps": steps, "assigned": assigned, "groups": model.groups(assigned), "p": p, "content": content}


BREAK = {
    "V01 version": ("run", lambda d: d.withColumn("version", F.lit(9))),
    "V03 id": ("run", lambda d: d.withColumn("run_id", F.lit("x"))),
    "V04 positions": ("universe", lambda d: d.withColumn("position", F.col("position") + 1)),
    "V05 dimensions": ("run", lambda d: d.withColumn("q", F.lit(0.1))),
    "V06 window": ("run", lambda d: d.withColumn("prior_close_date", F.col("window_start"))),
    "V07 k": ("run", lambda d: d.withColumn("k", F.lit(5))),
    "V08 params": ("params", lambda d: d.withColumn("sigma", F.lit(0.0))),
    "V09 coverage": ("assigned", lambda d: d.withColumn("c", F.lit(0.1).cast(model.P_TYPE))),
    "V10 steps": ("steps", lambda d: d.withColumn("step", F.col("step") * 2)),
    "V11 gains": ("steps", lambda d: d.withColumn("gain", F.col("step").cast("decimal(38,18)"))),
    "V12 totals": ("steps", lambda d: d.withColumn("f", F.col("f") + 1)),
    "V13 matrix": ("p", lambda d: d.withColumn("p", F.when(F.col("i") < F.col("j"), F.col("p") / 2).otherwise(F.col("p")).cast(model.P_TYPE))),
    "V14 groups": ("groups", lambda d: d.withColumn("size", F.col("size") + 1)),
}


def test_validation_passes_and_each_check_fires(spark):
    good = run_tables(spark)
    assert all(r["passed"] for r in validate.validate(**good).collect())
    for name, (table, change) in BREAK.items():
        broken = {r["check"] for r in validate.validate(**(good | {table: change(good[table])})).collect() if not r["passed"]}
        assert name in broken, name


def test_narrative_always_has_thirteen(spark):
    cols = sorted({i for _, inputs, _ in RULES for i in inputs})
    df = spark.createDataFrame([("A", *[1.0] * len(cols)), ("B", *[None] * len(cols))], "ticker string, " + ", ".join(f"{c} double" for c in cols))
    out = {r["ticker"]: (r["n_statements"], r["n_skipped"]) for r in narrative(df).collect()}
    assert out == {"A": (13, 0), "B": (0, 13)}


def test_movers_nulls_and_ties(spark):
    df = spark.createDataFrame([("B", 0.1), ("A", 0.1), ("C", None)], "ticker string, ret_1d double")
    assert [r["ticker"] for r in board.movers(df).collect()] == ["A", "B"]
    with pytest.raises(ValueError):
        board.movers(df, limit=101)


def test_stream_equals_batch(spark):
    from bellwether.streaming import stream

    got = stream.run_once(stream.event_bars(stream.read_events(spark, f"{SF}/events.parquet*"), late="60 days"), "append")
    batch = spark.read.parquet(f"{SF}/events.parquet")
    s = stream.run_once(stream.distinct_events(stream.read_events(spark, f"{SF}/events.parquet*"), ["event_id"], "60 days").select("event_id"))
    assert s.count() == batch.select("event_id").distinct().count()
    assert got.where("n < 1").count() == 0


def test_every_market_query_gives_rows(spark):
    from bellwether.plans.queries import QUERIES, SQL

    assert set(SQL) <= set(QUERIES) and len(QUERIES) > 60
    for name in ("returns", "market_overview", "assignment"):
        assert QUERIES[name](spark, SF).columns

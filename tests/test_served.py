"""Gates, storage, studies and streams against plain forms."""

import datetime
import shutil
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from bellwether.operators import clean, model
from bellwether.plans import board, serving, validate
from bellwether.plans.narrative import RULES, narrative
from bellwether.sources import merge, runs, scratch, store, stored
from bellwether.streaming import stream

ROOT = Path(__file__).resolve().parent.parent
DAY = datetime.date(2020, 1, 1)


def panel_of(spark, x, f=None):
    """Rows of the columns of ``x`` (sessions x tickers)."""
    f = np.zeros(len(x)) if f is None else f
    rows = [(f"T{j:02d}", DAY + datetime.timedelta(i), float(x[i, j]), float(f[i])) for i in range(x.shape[0]) for j in range(x.shape[1])]
    return spark.createDataFrame(rows, "ticker string, bar_date date, x double, f double")


def test_alignment_gates(spark):
    rng = np.random.default_rng(1)
    panel = panel_of(spark, rng.normal(size=(20, 4)), rng.normal(size=20))
    model.assert_rectangular(panel)
    for broken in (panel.where("ticker <> 'T01' OR day(bar_date) <> 5"), panel.union(panel.limit(1)), panel.withColumn("x", F.when(F.day("bar_date") == 3, float("nan")).otherwise(F.col("x"))), panel.withColumn("f", F.lit(None).cast("double"))):
        with pytest.raises(ValueError):
            model.assert_rectangular(broken)
    index = panel.select("bar_date", "f").distinct().withColumn("close", F.lit(1.0)).withColumn("index_symbol", F.lit("I"))
    asked = spark.createDataFrame([(f"T{k:02d}",) for k in range(6)], "ticker string")
    rets = panel.drop("f").where("ticker <> 'T02' OR day(bar_date) <> 9")
    kept, report, summary = model.window_alignment(rets, index, index, asked, "2020-01-03", "2020-01-18")
    row = summary.first()
    assert (row["t"], row["n"], row["n_no_overlap"], row["n_incomplete"], row["n_index_sessions"], row["n_dropped_sessions"]) == (16, 3, 2, 1, 16, 0)
    assert row["prior_close_date"] == datetime.date(2020, 1, 2) and row["q"] == round(3 / 16, 4) and {r["ticker"] for r in kept.select("ticker").distinct().collect()} == {"T00", "T01", "T03"}
    model.assert_ready(summary)
    model.assert_full_coverage(report, asked.where("ticker in ('T00', 'T01')"))
    with pytest.raises(ValueError, match="T02"):
        model.assert_full_coverage(report, asked)
    with pytest.raises(ValueError):
        model.assert_ready(model.window_alignment(rets, index, index, asked, "2020-01-01", "2020-01-18")[2])  # nothing before the first day
    with pytest.raises(ValueError):
        model.assert_ready(model.window_alignment(rets, index, index, asked.limit(0), "2020-01-03", "2020-01-18")[2])


def test_content_check_fires(spark):
    params = spark.createDataFrame([("A", 1.0)], "ticker string, beta double")
    a, b = validate.fingerprint({"params": params}), validate.fingerprint({"params": params.withColumn("beta", F.lit(2.0))})
    assert a.first()["content_hash"] == validate.fingerprint({"params": params.repartition(3)}).first()["content_hash"] != b.first()["content_hash"]


def test_universe_files(spark, tmp_path):
    path = tmp_path / "universe.txt"
    path.write_text("# head\nbbb # note\n\n aaa\r\nBBB\n")
    assert [r["ticker"] for r in store.universe(spark, path=str(path)).collect()] == ["AAA", "BBB"]
    assert [r["ticker"] for r in store.universe(spark, ["x", "Y"], str(path)).collect()] == ["X", "Y"]
    path.write_text("aaa\n\nb-b\nc c # x\n")
    with pytest.raises(ValueError, match="line 3: 'b-b'; line 4"):
        store.universe(spark, path=str(path))
    with pytest.raises(ValueError):
        store.universe(spark)


def test_repeated_keys_of_a_batch(spark):
    old = spark.createDataFrame([("A", "x", None), ("B", None, "y")], "k string, u string, v string")
    new = spark.createDataFrame([("A", None, "p"), ("A", "z", None), ("C", None, None), ("C", "q", None)], old.schema)
    assert sorted(map(tuple, store.fill_upsert(old, new, ["k"]).collect())) == [("A", "z", "p"), ("B", None, "y"), ("C", "q", None)]
    assert sorted(map(tuple, store.insert_absent(old, new.repartition(3), ["k"]).collect())) == [("A", "x", None), ("B", None, "y"), ("C", None, None)]


def test_run_load_is_guarded(spark):
    head = spark.createDataFrame([("r1", "week", "rho2", "h1")], "run_id string, scope_label string, measure string, content_hash string")
    run = {"runs": head, "universe": spark.createDataFrame([("A",)], "ticker string")}
    tables = {"runs": head.limit(0).withColumn("is_active", F.lit(False)), "universe": run["universe"].limit(0)}
    stocks = spark.createDataFrame([("A",)], "ticker string")
    loaded = store.load_run(tables, run, stocks)
    assert loaded["runs"].first()["is_active"] is False and store.load_run(loaded, run, stocks)["universe"].count() == 1
    with pytest.raises(ValueError, match="other content"):
        store.load_run(loaded, run | {"runs": head.withColumn("content_hash", F.lit("h2"))}, stocks)
    with pytest.raises(ValueError, match="not registered"):
        store.load_run(tables, run, stocks.limit(0))
    served = store.activate(loaded["runs"].union(loaded["runs"].withColumn("run_id", F.lit("r2"))), "r2")
    assert [r["run_id"] for r in serving.active(served).collect()] == ["r2"]
    with pytest.raises(ValueError):
        store.activate(served.withColumn("measure", F.lit("dcor2")), "r2")


def test_raw_records(spark):
    rows = spark.createDataFrame([("A", "2020-02-30", 1.0), ("A", "2020-02-28 10:00", float("nan")), ("B", None, 2.0), ("B", "2020-01-05", float("inf"))], "s string, time string, close double")
    got = sorted((r["symbol"], str(r["bar_date"]), r["payload"]) for r in clean.raw_records(rows, "s", "time", "2021-01-01").collect())
    assert got == [("A", "2020-02-28", '{"time":"2020-02-28 10:00"}'), ("B", "2020-01-05", '{"time":"2020-01-05"}')]


def test_narrative_has_its_values(spark):
    cols = sorted({i for _, inputs, _ in RULES for i in inputs})
    values = dict.fromkeys(cols, 10.0) | {"close": 12.5, "sma_20": 11.25, "sma_50": 11.0, "sma_200": 10.5, "rsi_14": 71.5, "macd_hist": -0.25, "ret_1d": -0.012346, "drawdown_from_252d_high": -0.05, "volume": 1200.0}
    row = spark.createDataFrame([("A", *(values[c] for c in cols))], "ticker string, " + ", ".join(f"{c} double" for c in cols))
    said = narrative(row).first()["statements"].split("; ")
    assert said[0] == "price_sma_20: price above its 20-session mean: 12.50 against 11.25" and said[3] == "order: means in rising order: 11.25, 11.00, 10.50"
    assert said[4] == "rsi: overbought: 71.50" and said[5] == "macd: MACD below its signal by 0.25" and said[7] == "volume: volume above its mean: 1200 against 10.00"
    assert said[8] == "drawdown: 5.0000 % below its 252-session high" and said[9] == "ret_1d: down 1.2346 % over 1 session"


def test_null_of_the_threshold(spark):
    x = np.random.default_rng(5).normal(size=(40, 6))
    e = panel_of(spark, x).select("ticker", "bar_date", F.col("x").alias("e"))
    got = model.permutation_null(e, 2, 30, seed=3).first()
    pooled = []
    for i in range(30):
        rng = np.random.default_rng([3, i])
        y = np.stack([rng.permutation(x[:, j]) for j in range(6)])
        p = np.corrcoef(y) ** 2
        cover, chosen = np.zeros(6), []
        for _ in range(2):
            gains = [sum(max(0, p[a, b] - cover[a]) for a in range(6)) if b not in chosen else -1 for b in range(6)]
            chosen.append(int(np.argmax(gains)))
            cover = np.maximum(cover, p[:, chosen[-1]])
        pooled += [cover[a] for a in range(6) if a not in chosen]
    assert got["n"] == len(pooled) == 120
    assert [got[k] for k in ("p50", "p95", "p99")] == pytest.approx(list(np.percentile(pooled, [50, 95, 99])))


@pytest.mark.parametrize("shape", [(50, 7), (5, 8)])
def test_spectrum_equals_eigenvalues(spark, shape):
    x = np.random.default_rng(8).normal(size=shape)
    x[:, 1] = x[:, 0] + 0.1 * x[:, 1]
    got = model.spectrum(panel_of(spark, x)).orderBy("rank").collect()
    want = np.sort(np.linalg.eigvalsh(np.corrcoef(x.T)))[::-1]
    assert [r["eigenvalue"] for r in got] == pytest.approx(list(want), abs=1e-6)
    assert [r["above"] for r in got] == list(want > (1 + np.sqrt(shape[1] / shape[0])) ** 2)


def test_ema_takes_chunks_in_any_order():
    import pandas as pd

    class State:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    x = np.random.default_rng(2).normal(50, 2, 40)
    days = [DAY + datetime.timedelta(k) for k in range(40)]
    table = pd.DataFrame({"bar_date": days, "close": x})
    ema = stream.Ema(5)
    ema.state = State()
    interleaved = [table.iloc[list(range(0, 30, 2))], table.iloc[list(range(1, 30, 2))]]
    first = pd.concat(ema.handleInputRows(("A",), iter(interleaved), None))
    rest = pd.concat(ema.handleInputRows(("A",), iter([table.iloc[35:], table.iloc[30:35]]), None))
    want, seed = {}, x[:5].mean()
    for k in range(4, 40):
        seed = seed if k == 4 else seed + (x[k] - seed) * 2 / 6
        want[days[k]] = seed
    got = {d: v for part in (first, rest) for d, v in part[["bar_date", "ema"]].itertuples(index=False) if v is not None and not np.isnan(v)}
    assert got == pytest.approx(want)
    with pytest.raises(ValueError, match="came again"):
        list(ema.handleInputRows(("A",), iter([table.iloc[10:11]]), None))


def test_a_lost_table_of_a_stream_is_an_error(spark, tmp_path):
    raw = spark.createDataFrame([("A", '{"time":"2020-01-0%d","close":"1"}' % k, datetime.datetime(2020, 2, 1), 0) for k in range(1, 5)], "symbol string, payload string, fetched_at timestamp, position int")
    raw.repartition(4).write.parquet(f"{tmp_path}/raw")
    found = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/raw")
    go = lambda good: stream.quarantine_into(found, "s", "2020-01-02", "2020-01-31", store.KEYS["bars"], good, f"{tmp_path}/bad").option("checkpointLocation", f"{tmp_path}/log").trigger(availableNow=True).start()
    one = go(f"{tmp_path}/good")
    one.awaitTermination()
    last = one.lastProgress["batchId"]
    assert merge.read(spark, f"{tmp_path}/good").count() == 3 and last > 0
    raw.withColumn("symbol", F.lit("B")).write.mode("append").parquet(f"{tmp_path}/raw")
    with pytest.raises(Exception, match="no version of a table"):
        go(f"{tmp_path}/elsewhere").awaitTermination()


def test_stored_tables_are_read_again_and_forgotten(spark):
    made = []

    def build():
        made.append(1)
        return spark.range(5)

    assert stored.stored(spark, "/some/folder", "t", build).count() == stored.stored(spark, "/some/folder", "t", build).count() == 5 and len(made) == 1
    stored.forget(spark, "/some/folder")
    assert stored.stored(spark, "/some/folder", "t", build).count() == 5 and len(made) == 2
    df = scratch.materialize(spark.range(3))
    scratch.discard(df, None)
    assert not Path(df.written.removeprefix("file://")).exists()


def test_unknown_ticker_is_an_error_and_an_empty_one_is_not(spark):
    kind = "ticker string, bar_date date, source string, close double"
    bars = spark.createDataFrame([("A", DAY, "s", 1.0)], kind)
    with pytest.raises(KeyError):
        board.ticker_history(bars, bars.drop("close"), "B")
    assert board.ticker_history(bars, bars.drop("close"), "A", "2021-01-01", "2021-12-31").count() == 0
    assert spark.range(1).select(board.in_millions(F.lit(2500.0)).alias("x")).first()["x"] == 2.5


@pytest.mark.parametrize("state", ["gone", "broken", "misspelt"])
def test_market_queries_work_without_the_corpus_package(tmp_path, state):
    for name in ("__spark_entry__.py", "corpus_pipeline.py", "bellwether"):
        (shutil.copytree if (ROOT / name).is_dir() else shutil.copy)(ROOT / name, tmp_path / name)
    shutil.rmtree(tmp_path / "bellwether/llm")
    if state == "gone":
        (tmp_path / "corpus_pipeline.py").unlink()
    else:
        (tmp_path / "bellwether/llm").mkdir()
        (tmp_path / "bellwether/llm/__init__.py").write_text("")
        (tmp_path / "bellwether/llm/queries.py").write_text("import a_module_that_is_not_there\n" if state == "broken" else "def (:\n")
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()) > 90, [q for q in e.queries() if q.startswith('op') or q == 'pipeline'], set(e.oracle_sql()) <= set(e.queries()))"], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert said.stdout.split("\n")[-2] == "True [] True"


def test_stored_tables_follow_their_inputs(spark, tmp_path):
    made = []

    def build():
        made.append(1)
        return spark.range(len(made))

    ask = lambda: stored.stored(spark, str(tmp_path), "t", build).count()
    spark.range(3).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert [ask(), ask()] == [1, 1]
    spark.range(4).write.mode("overwrite").parquet(f"{tmp_path}/lineitem.parquet")
    assert [ask(), ask()] == [2, 2] and len(made) == 2
    stored.forget(spark, str(tmp_path))


def days(spark, rows):
    return spark.createDataFrame([(t, DAY.replace(year=y) + datetime.timedelta(k), v) for t, y, k, v in rows], "ticker string, bar_date date, close double")


def folders(base):
    return sorted(p.name + "/" + q.name for p in (base / "data").iterdir() for q in p.iterdir() if q.is_dir())


def test_a_batch_rewrites_its_partitions_only(spark, tmp_path):
    base = tmp_path / "t"
    go = lambda rows, **more: merge.merge(str(base), days(spark, rows), ["ticker", "bar_date"], F.year("bar_date"), **more)
    read = lambda **more: sorted((r["ticker"], r["bar_date"].year, r["close"]) for r in merge.read(spark, str(base), **more).collect())
    with pytest.raises(FileNotFoundError):
        read()
    assert go([("A", 2018, 1, 1.0), ("A", 2019, 1, 2.0), ("B", 2019, 1, 3.0), ("A", 2020, 1, 4.0)]) == 0
    before = merge.manifest(spark, str(base))["parts"]
    assert go([("A", 2019, 1, 5.0), ("C", 2021, 1, 6.0)]) == 1
    after = merge.manifest(spark, str(base))["parts"]
    assert {k for k in after if after[k] != before.get(k)} == {"2019", "2021"}
    assert read() == [("A", 2018, 1.0), ("A", 2019, 5.0), ("A", 2020, 4.0), ("B", 2019, 3.0), ("C", 2021, 6.0)]
    assert read(version=0)[1] == ("A", 2019, 2.0) and read(parts={"2021"}) == [("C", 2021, 6.0)]
    assert go([]) == 1
    merge.vacuum(spark, str(base))
    assert len(folders(base)) == 4 and len(read()) == 5 and merge.versions(spark, str(base)) == [1]


def test_a_batch_that_fails_or_comes_again_changes_nothing(spark, tmp_path):
    base = str(tmp_path / "t")
    go = lambda rows, n: merge.merge(base, days(spark, rows), ["ticker", "bar_date"], F.year("bar_date"), number=n)
    with pytest.raises(FileNotFoundError):
        go([("A", 2018, 1, 1.0)], 3)
    assert go([("A", 2018, 1, 1.0)], 0) == 0 and go([("A", 2018, 1, 9.0)], 0) == 0 and go([], 1) == 1
    bad = days(spark, [("A", 2018, 1, 2.0)]).withColumn("close", F.raise_error(F.lit("broken on the way")).cast("double"))
    with pytest.raises(Exception, match="broken on the way"):
        merge.merge(base, bad, ["ticker", "bar_date"], F.year("bar_date"), number=2)
    assert [r["close"] for r in merge.read(spark, base).collect()] == [1.0] and merge.versions(spark, base) == [0, 1]
    assert go([("A", 2018, 1, 2.0)], 2) == 2 and merge.read(spark, base).first()["close"] == 2.0


def test_runs_are_compared_by_field(spark):
    a = {"params": spark.createDataFrame([("A", 1.0, [1.0]), ("B", 2.0, None), ("C", None, None)], "ticker string, beta double, v array<double>"), "steps": spark.createDataFrame([(1, "A")], "step int, ticker string")}
    b = {"params": spark.createDataFrame([("A", 1.0 + 1e-12, [1.0]), ("B", 2.5, [2.0]), ("D", 1.0, None)], "ticker string, beta double, v array<double>"), "steps": spark.createDataFrame([(1, "A")], "step long, ticker string").select(F.col("step").cast("int").alias("step"), F.col("ticker").cast("binary").alias("ticker"))}
    told = lambda tol: {(r["table"], r["field"]): tuple(r)[2:] for r in runs.by_field(runs.difference(a, b, tolerance=tol)).collect()}
    assert told(0.0) == {("params", "*"): (2, 0, 1, 1), ("params", "beta"): (0, 2, 1, 1), ("params", "v"): (1, 1, 1, 1), ("steps", "*"): (1, 0, 0, 0), ("steps", "ticker"): (0, 1, 0, 0)}
    assert told(1e-9)["params", "beta"] == (1, 1, 1, 1)
    one = [r for r in runs.difference(a, b).collect() if r["key"] == '{"ticker":"B"}' and r["field"] == "beta"]
    assert [(r["left"], r["right"], r["verdict"]) for r in one] == [("2.0", "2.5", "differs")]


@pytest.mark.parametrize("n", [2, 5, 40, 200])
def test_trailing_moments(spark, n):
    from bellwether.functions.moments import trailing_moments

    rng = np.random.default_rng(n)
    x, y = rng.normal(size=(2, 130)) + 1e6
    x[:60] = 7.0  # constant at first
    rows = spark.createDataFrame([(k, DAY + datetime.timedelta(t), float(x[t]), float(y[t])) for t in range(130) for k in ("A", "B")], "ticker string, bar_date date, x double, y double")
    got = trailing_moments(rows, ["ticker"], "x", "y", n).where("ticker = 'B'").orderBy("bar_date").collect()
    for t, r in enumerate(got):
        if t < n - 1:
            assert r["m"] is None
            continue
        u, v = x[t - n + 1 : t + 1], y[t - n + 1 : t + 1]
        assert r["m"]["k"] == n and r["m"]["mx"] == pytest.approx(u.mean())
        assert [r["m"]["vx"], r["m"]["vy"], r["m"]["c"]] == pytest.approx([u.var(), v.var(), np.cov(u, v, bias=True)[0, 1]], rel=1e-6, abs=1e-9)


def test_running_indicators_over_batches_of_any_size(spark):
    from bellwether.functions import indicators as ind

    class State:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    import pandas as pd

    rng = np.random.default_rng(6)
    n = 90
    close = 50 + np.cumsum(rng.normal(size=n)).round(3)
    close[20:24] = close[20]
    table = pd.DataFrame({"bar_date": [DAY + datetime.timedelta(k) for k in range(n)], "high": close + rng.uniform(0, 2, n), "low": close - rng.uniform(0, 2, n), "close": close, "volume": rng.integers(1, 9, n) * 100.0})
    table.loc[70, "volume"] = np.nan
    running, got = stream.Running(), []
    running.state = State()
    for part in (table[0:1], table[1:10], table[10:40].sample(frac=1, random_state=1), table[40:41], table[41:]):
        for out in running.handleInputRows(("A",), iter([part.iloc[: len(part) // 2], part.iloc[len(part) // 2 :]]), None):
            got += [tuple(None if x is None or (isinstance(x, float) and np.isnan(x)) else x for x in row) for row in out.itertuples(index=False)]
    bars = spark.createDataFrame([("A", "s", r.bar_date, r.close, float(r.high), float(r.low), r.close, None if np.isnan(r.volume) else float(r.volume)) for r in table.itertuples()], "ticker string, source string, bar_date date, open double, high double, low double, close double, volume double")
    names = ("ema_12", "ema_26", "macd", "macd_signal", "rsi_14", "atr_14", "obv")
    want = ind.indicators(bars).select("ticker", "bar_date", *names).orderBy("bar_date").collect()
    for mine, theirs in zip(got, want, strict=True):
        assert mine[:2] == tuple(theirs)[:2]
        for x, y in zip(mine[2:], tuple(theirs)[2:], strict=True):
            assert (x is None) == (y is None) and (x is None or x == pytest.approx(y))
    assert got[69][-1] is not None and got[-1][-1] is None
    with pytest.raises(ValueError, match="came again"):
        list(running.handleInputRows(("A",), iter([table.iloc[10:11]]), None))
    for block in (7, 1000):
        obv = {r["bar_date"]: r["obv"] for r in ind.long_obv(bars, block).collect()}
        macd = {r["bar_date"]: (r["macd"], r["macd_signal"]) for r in ind.long_macd(bars, block=block).collect()}
        for r in want:
            assert obv[r["bar_date"]] == (None if r["obv"] is None else pytest.approx(r["obv"]))
            assert (r["bar_date"] in macd) == (r["macd"] is not None)
            if r["macd_signal"] is not None:
                assert macd[r["bar_date"]] == pytest.approx((r["macd"], r["macd_signal"]))


def test_late_events_count_and_batches_come_again(spark, tmp_path):
    t0 = datetime.datetime(2020, 1, 1)
    events = [(k, t0 + datetime.timedelta(hours=(k * 7919) % 2000), "a" if k % 3 else "b", float(k % 17)) for k in range(300)]
    kind = "event_id long, ts timestamp, event_type string, value double"
    spark.createDataFrame(events, kind).repartition(5, "event_id").write.parquet(f"{tmp_path}/in")
    go = lambda log: stream.event_bars_into(spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in"), f"{tmp_path}/bars").option("checkpointLocation", f"{tmp_path}/{log}").trigger(availableNow=True).start().awaitTermination()
    go("log")
    want = {}
    for k, ts, kind_, v in sorted(events, key=lambda e: (e[1], e[0])):
        want.setdefault((kind_, ts.date()), []).append(v)
    want = {key: (v[0], max(v), min(v), v[-1], sum(v), len(v)) for key, v in want.items()}
    read = lambda: {(r["event_type"], r["bar_date"].date()): tuple(r[c] for c in ("open", "high", "low", "close", "volume", "n")) for r in merge.read(spark, f"{tmp_path}/bars").collect()}
    assert read() == want
    go("another log")  # the same batches again, as after a lost checkpoint
    assert read() == want


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_lazy_greedy_takes_the_same_steps(spark, seed):
    from decimal import Decimal

    rng = np.random.default_rng(seed)
    n = 45
    p = rng.uniform(size=(n, n)).round(1 if seed == 1 else 9)  # many ties at first
    np.fill_diagonal(p, 0 if seed == 3 else 1)
    cells = {(i, j): Decimal(repr(float(p[i, j]))) for i in range(n) for j in range(n)}
    table = spark.createDataFrame([(f"T{i:02d}", f"T{j:02d}", v) for (i, j), v in cells.items()], "i string, j string, p decimal(20,18)")
    cover, left, want, total = [Decimal(0)] * n, set(range(n)), [], 0
    for step in range(1, 8):
        gains = {j: sum(max(Decimal(0), cells[i, j] - cover[i]) for i in range(n)) for j in left}
        best = min(left, key=lambda j: (-gains[j], j))
        total += gains[best]
        want.append((step, f"T{best:02d}", gains[best], total))
        left.discard(best)
        cover = [max(cover[i], cells[i, best]) for i in range(n)]
    assert [tuple(r) for r in model.greedy(table, 7).orderBy("step").collect()] == want


def test_unknown_and_empty_tickers(spark):
    kind = "ticker string, bar_date date, source string, close double"
    bars, st = spark.createDataFrame([("A", DAY, "s", 1.0)], kind), spark.createDataFrame([("A",), ("B",)], "ticker string")
    assert board.ticker_history(bars, bars.drop("close"), "B", stocks=st).count() == 0
    assert board.ticker_history(bars, bars.drop("close"), "A", stocks=st).count() == 1
    with pytest.raises(KeyError):
        board.ticker_history(bars, bars.drop("close"), "C", stocks=st)


def test_scratch_goes_with_the_application(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
import __spark_entry__ as e
s = SparkSession.builder.master("local[2]").config("spark.checkpoint.dir", "file://{tmp_path}/shared").config("spark.ui.enabled", "false").config("spark.sql.warehouse.dir", "{tmp_path}/wh").getOrCreate()
q = e.queries()
n = q["raw_round_trip"](s, "/root/testdata/sf0.001").count() + q["quarantine_stream"](s, "/root/testdata/sf0.001").count()
import os
print(n > 0, len(os.listdir("{tmp_path}/shared")) > 3)
"""
    said = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    assert said.stdout.split("\n")[-2] == "True True"
    # Spark makes a folder of its own there
    assert [p.name for p in (tmp_path / "shared").iterdir() if any(p.iterdir())] == []

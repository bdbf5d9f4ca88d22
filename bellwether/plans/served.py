"""Registered queries over served runs, storage, alignment, studies and streams, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, model
from ..sources import derive, merge, runs, store
from ..sources.scratch import materialize, temporary
from ..streaming import stream
from . import board, serving, validate
from .queries import _MEANS, BARS, BOARD, FAULTS, FIT, FULL, GREEDY, LINE, MODEL, PAIRS, PANEL, RECURSE, RETS, STOCKS, WINDOWED, _bars, _base, _ind, _index, _resid, _run, _sim_sql, _steps_sql, _years, query, r, with_

TAU = 0.1


# ---- the active run ----------------------------------------------------------------------------


def _runs(s: SparkSession, d: str) -> DataFrame:
    """Two runs, over weekly and over quarterly sessions; the weekly one is active."""
    rows = [model.run_row(_run(s, d, unit), _index(s, d, unit), f"run-{unit}", unit, "rho2", 3, 3, TAU) for unit in ("week", "quarter")]
    return store.activate(rows[0].unionByName(rows[1]).withColumn("is_active", F.lit(False)), "run-week")


def _params(s: SparkSession, d: str) -> DataFrame:
    return serving.ticker_params(_run(s, d), "run-week", TAU).unionByName(serving.ticker_params(_run(s, d, "quarter"), "run-quarter", TAU))


@query(
    "active_run",
    with_(*FULL)
    + """, w AS (SELECT min(bar_date) AS window_start, max(bar_date) AS window_end, count(DISTINCT bar_date) AS n_sessions, count(DISTINCT ticker) AS n_tickers FROM panel)
SELECT 'run-week' AS run_id, 'week' AS scope_label, 'rho2' AS measure, window_start, window_end, (SELECT max(bar_date) FROM idx WHERE close > 0 AND bar_date < window_start AND bar_date >= window_start - INTERVAL 45 DAY) AS prior_close_date,
  n_sessions, n_tickers, round(n_tickers / n_sessions, 4) AS q, 3 AS k, 3 AS k_max, round((SELECT CAST(sum(c) AS DOUBLE) FROM assigned), 6) AS coverage_f, round((SELECT CAST(sum(c) AS DOUBLE) FROM assigned) / n_tickers, 6) AS coverage_fbar,
  (SELECT count(*) FROM assigned WHERE c < 0.1) AS n_under_tau, true AS is_active, (SELECT max(bar_date) FROM bars) AS session_date FROM w""",
)
def _(s, d):
    return r(serving.active_run(_runs(s, d), _bars(s, d)).drop("tau"))


_PLACED = ", placed AS (SELECT a.ticker, row_number() OVER (ORDER BY a.ticker) - 1 AS position, anchor, c, alpha, beta, sigma, r2 FROM assigned a JOIN fitted USING (ticker))"


@query(
    "active_assignment",
    with_(*FULL) + _PLACED + """ SELECT 'run-week' AS run_id, CAST(position AS INT) AS position, p.ticker, sector, industry, anchor AS anchor_ticker, round(CAST(c AS DOUBLE), 8) AS coverage_c, p.ticker IN (SELECT ticker FROM steps) AS is_anchor, c < 0.1 AS under_tau,
  round(alpha, 8) AS alpha_hat, round(beta, 8) AS beta_hat, round(sigma, 8) AS sigma_hat, round(r2, 8) AS r2 FROM placed p LEFT JOIN stocks USING (ticker)""",
)
def _(s, d):
    return r(serving.active_assignment(_runs(s, d), _params(s, d), derive.stocks(s, d)), 8)


@query(
    "active_groups",
    with_(*FULL)
    + """, k AS (SELECT anchor, coalesce(sector, 'other') AS sector, count(*) AS n FROM assigned LEFT JOIN stocks USING (ticker) GROUP BY 1, 2), comp AS (SELECT anchor, string_agg(sector || ':' || n, ',' ORDER BY n DESC, sector) AS composition FROM k GROUP BY 1)
SELECT 'run-week' AS run_id, anchor AS anchor_ticker, count(*) AS size, round(CAST(sum(c) AS DOUBLE), 6) AS f_j, round(avg(CAST(c AS DOUBLE)), 6) AS rho2_mean, round(CAST(min(c) AS DOUBLE), 6) AS rho2_min, any_value(composition) AS sector_composition FROM assigned JOIN comp USING (anchor) GROUP BY 2""",
)
def _(s, d):
    st = derive.stocks(s, d)
    groups = serving.group_table(_run(s, d), st, "run-week").unionByName(serving.group_table(_run(s, d, "quarter"), st, "run-quarter"))
    return r(serving.active_groups(_runs(s, d), groups))


@query(
    "universe_moves",
    with_(*BOARD, *FULL[2:3], PANEL, FIT, PAIRS, GREEDY) + _PLACED + " SELECT CAST(position AS INT) AS position, p.ticker, sector, n.bar_date, round(n.close, 6) AS close, round(ret_1d, 6) AS ret_1d FROM placed p LEFT JOIN newest n USING (ticker) LEFT JOIN stocks USING (ticker)",
)
def _(s, d):
    return r(serving.universe_with_moves(serving.ticker_params(_run(s, d), "run-week", TAU), _base(s, d)).select("position", "ticker", "sector", "bar_date", "close", "ret_1d"))


_TWO = """, best2 AS (SELECT i AS ticker, j AS anchor, p AS c, row_number() OVER (PARTITION BY i ORDER BY p DESC, j) AS n FROM sim18 WHERE j IN (SELECT ticker FROM steps WHERE step <= 2)),
g AS (SELECT anchor AS ticker, count(*) AS size, round(CAST(sum(c) AS DOUBLE), 6) AS group_f FROM best2 WHERE n = 1 GROUP BY 1), s2 AS (SELECT step, ticker, sum(gain) OVER (ORDER BY step) AS f FROM steps)
"""


@query("anchor_steps_published", with_(*FULL) + _TWO + "SELECT step, ticker, size, sector, round((CAST(f AS DOUBLE) - step) / ((SELECT count(*) FROM fitted) - step), 6) AS adjusted FROM s2 LEFT JOIN g USING (ticker) LEFT JOIN stocks USING (ticker)")
def _(s, d):
    """Three steps of which two are published: the third has no group."""
    run = serving.published(_run(s, d), 2)
    n = run["params"].agg(F.count("*").alias("n_universe"))
    return r(board.anchors(run["steps"], run["groups"], derive.stocks(s, d), n).select("step", "ticker", "size", "sector", "adjusted"))


# ---- storage -----------------------------------------------------------------------------------


@query(
    "fill_upsert",
    with_(STOCKS)
    + r""", numbered AS (SELECT *, CAST(regexp_extract(ticker, '(\d+)', 1) AS INT) AS n FROM stocks), old AS (SELECT ticker, sector, CASE WHEN n % 2 = 0 THEN industry END AS industry FROM numbered WHERE n % 7 <> 0),
new AS (SELECT ticker, CASE WHEN n % 3 = 0 THEN 'new ' || n END AS sector, CASE WHEN n % 3 <> 0 THEN 'other ' || n END AS industry FROM numbered)
SELECT ticker, coalesce(new.sector, old.sector) AS sector, coalesce(new.industry, old.industry) AS industry FROM old FULL JOIN new USING (ticker)""",
)
def _(s, d):
    st = derive.stocks(s, d).withColumn("n", F.regexp_extract("ticker", r"(\d+)", 1).cast("int"))
    old = st.where("n % 7 <> 0").select("ticker", "sector", F.when(F.col("n") % 2 == 0, F.col("industry")).alias("industry"))
    new = st.select("ticker", F.when(F.col("n") % 3 == 0, F.concat(F.lit("new "), "n")).alias("sector"), F.when(F.col("n") % 3 != 0, F.concat(F.lit("other "), "n")).alias("industry"))
    # each key comes twice, once without anything new
    twice = new.unionByName(new.select("ticker", F.lit(None).cast("string").alias("sector"), F.lit(None).cast("string").alias("industry")))
    return store.fill_upsert(old, twice, ["ticker"])


@query(
    "insert_absent",
    with_(LINE, BARS) + ", old AS (SELECT ticker, bar_date, close FROM bars WHERE bar_date < DATE '1998-01-01'), new AS (SELECT ticker, bar_date, close + 1 AS close FROM bars WHERE bar_date >= DATE '1997-01-01') SELECT ticker, bar_date, round(coalesce(o.close, n.close), 6) AS close FROM old o FULL JOIN new n USING (ticker, bar_date)",
)
def _(s, d):
    b = _bars(s, d).select("ticker", "bar_date", "close")
    new = b.where("bar_date >= date'1997-01-01'").withColumn("close", F.col("close") + 1)
    return r(store.insert_absent(b.where("bar_date < date'1998-01-01'"), new.unionByName(new.withColumn("close", F.col("close") + 1)), ["ticker", "bar_date"]))


@query("replace_slice", with_(LINE, BARS) + "SELECT ticker, CAST(year(bar_date) AS INT) AS version, CAST(count(*) AS BIGINT) AS n, round(sum(CASE WHEN year(bar_date) = 1997 THEN 2 * close ELSE close END), 4) AS total FROM bars WHERE year(bar_date) <> 1997 OR bar_date < DATE '1997-07-01' GROUP BY 1, 2")
def _(s, d):
    b = _bars(s, d).select("ticker", "bar_date", "close", F.year("bar_date").alias("version"))
    new = b.where("version = 1997 AND bar_date < date'1997-07-01'").withColumn("close", 2 * F.col("close"))
    return r(store.replace_slice(b, new, "version").groupBy("ticker", "version").agg(F.count("*").alias("n"), F.sum("close").alias("total")), 4)


def _loaded(s: SparkSession, d: str) -> dict[str, DataFrame]:
    """Both runs loaded into empty tables, the first one twice, and one of them active."""
    st, tables = derive.stocks(s, d), None
    for unit in ("week", "quarter", "week"):
        head = model.run_row(_run(s, d, unit), _index(s, d, unit), f"run-{unit}", unit, "rho2", 3, 3, TAU).withColumn("content_hash", F.sha2(F.concat_ws(",", "run_id", "n_sessions", "n_tickers"), 256))
        params = serving.ticker_params(_run(s, d, unit), f"run-{unit}", TAU)
        run = {"runs": head, "universe": params.select("run_id", "ticker"), "params": params}
        if tables is None:
            tables = {k: v.limit(0) for k, v in run.items()}
            tables["runs"] = tables["runs"].withColumn("is_active", F.lit(False))
        tables = store.load_run(tables, run, st)
    return tables | {"runs": store.activate(tables["runs"], "run-week")}


def _count_sql(unit: str) -> str:
    return f"SELECT '{unit}' AS scope_label, 'rho2' AS measure, 'run-{unit}' AS run_id, {str(unit == 'week').lower()} AS is_active, (SELECT count(*) FROM ({with_(*MODEL, unit=unit)} SELECT ticker FROM fitted)) AS n_params"


@query("run_listing", _count_sql("week") + " UNION ALL " + _count_sql("quarter"))
def _(s, d):
    tables = _loaded(s, d)
    return store.run_listing(tables["runs"]).join(tables["params"].groupBy("run_id").agg(F.count("*").alias("n_params")), "run_id")


@query("run_compare", with_(*MODEL, "pair AS (SELECT ticker, round(beta, 6) AS beta, sector FROM fitted JOIN stocks USING (ticker))") + "SELECT ticker, beta, 'left' AS side FROM pair WHERE sector IS NULL UNION ALL SELECT ticker, beta + 1, 'right' FROM pair WHERE sector IS NULL")
def _(s, d):
    a = r(_run(s, d)["params"].select("ticker", "beta"))
    unknown = derive.stocks(s, d).where("sector is null").select("ticker", F.lit(1).alias("u"))
    b = a.join(F.broadcast(unknown), "ticker", "left").select("ticker", (F.col("beta") + F.coalesce("u", F.lit(0))).alias("beta"))
    return r(store.compare(a, b))


def _stored_run(s: SparkSession, d: str) -> dict[str, DataFrame]:
    """The weekly run, written with its row and read back."""
    run, path = _run(s, d), temporary(s, "run")
    tables = {k: run[k] for k in ("params", "steps", "assigned", "groups", "p")}
    tables["universe"] = run["params"].select("ticker").withColumn("position", F.row_number().over(board.W.orderBy("ticker")) - 1)
    head = model.run_row(run, _index(s, d), "", "week", "rho2", 3, 3, TAU).drop("run_id").join(F.broadcast(validate.fingerprint(tables)))
    runs.write_run(tables, head.withColumn("version", F.lit(validate.VERSION)), path)
    return runs.read_run(s, path)


def _validated(run: dict[str, DataFrame]) -> DataFrame:
    """The 14 checks of a stored run; its content is hashed again from its tables."""
    content = validate.fingerprint({k: v for k, v in run.items() if k != "run"})
    head = run["run"].withColumn("n", F.col("n_tickers")).withColumn("t", F.col("n_sessions")).withColumn("q", F.col("n") / F.col("t"))
    return validate.validate(head, run["universe"], run["params"], run["steps"], run["assigned"], run["groups"], run["p"], content)


@query("run_validation", "SELECT run, name AS \"check\", run = 'as stored' OR name NOT IN ('V02 content', 'V08 params') AS passed FROM (SELECT unnest(['V01 version', 'V02 content', 'V03 id', 'V04 positions', 'V05 dimensions', 'V06 window', 'V07 k', 'V08 params', 'V09 coverage', 'V10 steps', 'V11 gains', 'V12 totals', 'V13 matrix', 'V14 groups']) AS name), (SELECT unnest(['as stored', 'changed']) AS run)")
def _(s, d):
    """All 14 checks over a run read back from storage, and over the same with one parameter changed after it was written (Q12)."""
    run = _stored_run(s, d)
    first = run["params"].agg(F.min("ticker").alias("ticker"))
    changed = run["params"].join(F.broadcast(first.withColumn("hit", F.lit(True))), "ticker", "left").withColumn("sigma", F.when(F.col("hit"), -F.col("sigma")).otherwise(F.col("sigma"))).drop("hit")
    out = _validated(run).withColumn("run", F.lit("as stored")).union(_validated(run | {"params": changed}).withColumn("run", F.lit("changed")))
    return out.select("run", "check", "passed")


@query(
    "run_field_compare",
    with_(*MODEL, "size AS (SELECT count(*) AS n, count(*) FILTER (sector IS NULL) AS u, least(3, count(*)) AS k FROM fitted JOIN stocks USING (ticker))")
    + """SELECT "table", field, CASE "table" WHEN 'p' THEN n * n WHEN 'steps' THEN k WHEN 'groups' THEN k ELSE n END - d - l AS n_equal, d AS n_differs, l AS n_left, 0 AS n_right FROM (
  SELECT "table", field, n, k, CASE WHEN field = 'beta' THEN u WHEN "table" = 'p' AND field = 'p' THEN n ELSE 0 END AS d, CASE "table" WHEN 'steps' THEN 1 ELSE 0 END AS l
  FROM size, (SELECT 'params' AS "table", unnest(['*', 't', 'alpha', 'beta', 'sigma', 'r2']) AS field UNION ALL SELECT 'steps', unnest(['*', 'ticker', 'gain', 'f']) UNION ALL SELECT 'assigned', unnest(['*', 'anchor', 'c'])
    UNION ALL SELECT 'groups', unnest(['*', 'size', 'f', 'mean_c', 'min_c', 'share']) UNION ALL SELECT 'p', unnest(['*', 'p']) UNION ALL SELECT 'universe', unnest(['*', 'position'])))""",
)
def _(s, d):
    """A stored run against one with planted changes, counted by field: betas of tickers without sector, the diagonal in its 18th decimal, a step that is missing."""
    run = _stored_run(s, d)
    unknown = derive.stocks(s, d).where("sector is null").select("ticker", F.lit(1.0).alias("u"))
    beta = (F.col("beta") + F.coalesce("u", F.lit(0.0))).alias("beta")
    other = run | {
        "params": run["params"].join(F.broadcast(unknown), "ticker", "left").select(*(beta if c == "beta" else c for c in run["params"].columns)),
        "p": run["p"].withColumn("p", F.when(F.col("i") == F.col("j"), F.col("p") - F.lit("0.000000000000000001").cast(model.P_TYPE)).otherwise(F.col("p")).cast(model.P_TYPE)),
        "steps": run["steps"].where("step < 3"),
    }
    return runs.by_field(runs.difference(run, other))


@query("anchor_columns", with_(*FULL) + "SELECT i, j, round(CAST(p AS DOUBLE), 8) AS p FROM sim18 WHERE j IN (SELECT ticker FROM steps)")
def _(s, d):
    run = _run(s, d)
    return r(model.anchor_columns(run["p"], run["steps"]), 8).select("i", "j", "p")


@query("bars_round_trip", with_(LINE, BARS) + "SELECT ticker, bar_date, round(close, 6) AS close, volume FROM bars WHERE year(bar_date) IN (1996, 1997) AND ticker IN (SELECT ticker FROM bars WHERE ticker LIKE '%1')")
def _(s, d):
    """Bars written by year, one year written again, and two years of some tickers read back."""
    path = temporary(s, "bars")
    b = _bars(s, d).select("ticker", "bar_date", "source", "open", "high", "low", "close", "volume")
    full = b.select("*", F.lit(True).alias("is_adjusted"), F.lit("2002-01-01").cast("timestamp").alias("ingested_at"), F.lit("2002-01-01").cast("timestamp").alias("updated_at"))
    store.write_bars(full, path)
    store.write_bars(full.where("year(bar_date) = 1997"), path)
    some = store.of_tickers(store.scan(s, path, store.BAR, derive.SOURCE, start="1996-01-01", end="1997-12-31"), b.where("ticker LIKE '%1'").select("ticker").distinct())
    return r(store.daily_bars(some))


@query("raw_round_trip", with_(LINE, BARS) + "SELECT ticker AS symbol, bar_date, round(close, 6) AS close, CAST(volume AS DOUBLE) AS volume FROM bars WHERE ticker LIKE '%1'")
def _(s, d):
    """Raw records with one fetch time, written as JSON lines, read back by their span and taken apart again."""
    path = temporary(s, "raw")
    rows = _bars(s, d).where("ticker LIKE '%1'").select("ticker", F.col("bar_date").alias("time"), "open", "high", "low", "close", "volume")
    raw = clean.raw_records(rows, "ticker", "time", "2002-01-01 00:00:00")
    late = raw.withColumn("fetched_at", F.lit("2003-01-01").cast("timestamp"))
    store.write_raw(raw.unionByName(late).select("symbol", "payload", "fetched_at", F.lit(0).alias("position")), path)
    back = clean.normalise(store.scan_raw(s, path, since="2001-12-31", until="2002-12-31"), derive.SOURCE)
    return r(back.select(F.col("ticker").alias("symbol"), "bar_date", "close", "volume"))


# ---- universe, cleaning, builds ----------------------------------------------------------------


@query(
    "universe_lines",
    with_(STOCKS)
    + r""", said AS (SELECT row_number() OVER (ORDER BY ticker) AS line, ticker, CAST(regexp_extract(ticker, '(\d+)', 1) AS INT) AS n FROM stocks),
texts AS (SELECT line, CASE WHEN n % 4 = 0 THEN 'bad-' || n WHEN n % 4 = 1 THEN ' brand' || n || '  # note' WHEN n % 4 = 2 THEN '# only a note' ELSE 'BRAND' || n END AS value, n FROM said)
SELECT CAST(NULL AS INT) AS line, 'BRAND' || n AS value, true AS accepted FROM texts WHERE n % 4 IN (1, 3) UNION ALL SELECT CAST(line AS INT), value, false FROM texts WHERE n % 4 = 0""",
)
def _(s, d):
    n = F.regexp_extract("ticker", r"(\d+)", 1).cast("int")
    value = F.when(n % 4 == 0, F.concat(F.lit("bad-"), n)).when(n % 4 == 1, F.concat(F.lit(" brand"), n, F.lit("  # note"))).when(n % 4 == 2, F.lit("# only a note")).otherwise(F.concat(F.lit("BRAND"), n))
    text = derive.stocks(s, d).select(F.struct("ticker", value.alias("value")).alias("x")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["value"]), "\n").alias("value"))
    good, bad = store.parse_universe(text)
    return good.select(F.lit(None).cast("int").alias("line"), F.col("ticker").alias("value"), F.lit(True).alias("accepted")).unionByName(bad.withColumn("accepted", F.lit(False)))


@query("industry_sectors", with_(STOCKS) + "SELECT ticker, industry, CASE WHEN i < 12 THEN 'sector ' || (i % 5) END AS sector, CASE WHEN i < 12 THEN 'industry' ELSE 'missing' END AS label_source FROM (SELECT *, CAST(split_part(industry, ' ', 2) AS INT) AS i FROM stocks)")
def _(s, d):
    st = derive.stocks(s, d)
    i = F.split("industry", " ")[1].cast("int")
    mapping = st.select("industry").distinct().where(i < 12).select("industry", F.concat(F.lit("sector "), (i % 5).cast("string")).alias("sector"))
    return store.with_sector(st, mapping)


@query("window_trim", with_(LINE, BARS, FAULTS) + "SELECT ticker, count(*) FILTER (bar_date < DATE '1996-01-01') AS n_leading, count(*) FILTER (bar_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31') AS n_inside, count(*) FILTER (bar_date > DATE '2000-12-31') AS n_trailing FROM judged WHERE dropped IS NULL GROUP BY 1")
def _(s, d):
    return clean.trimmed(clean.normalise(derive.raw_bars(_bars(s, d)), derive.SOURCE).where("dropped is null"), "1996-01-01", "2000-12-31")


@query("index_normalised", with_(LINE, BARS) + "SELECT 'ALL' AS index_symbol, bar_date, round(close, 6) AS close FROM idx")
def _(s, d):
    index = _index(s, d).select("index_symbol", F.col("bar_date").alias("time"), F.lit(None).cast("double").alias("open"), F.lit(None).cast("double").alias("high"), F.lit(None).cast("double").alias("low"), "close", F.lit(float("nan")).alias("volume"))
    raw = clean.raw_records(index, "index_symbol", "time", "2002-01-01 00:00:00").withColumn("position", F.lit(0))
    out = clean.normalise_index(raw, derive.SOURCE)
    return r(out.where("volume is null and dropped is null").select("index_symbol", "bar_date", "close"))


@query("run_status", with_(LINE, BARS, FAULTS) + ", w AS (SELECT ticker, count(*) FILTER (reason IS NULL) AS written, (SELECT count(*) FROM judged j WHERE j.ticker = q.ticker) AS fetched FROM reasoned q GROUP BY 1) SELECT count(*) AS n_symbols, count(*) FILTER (written > 0) AS n_good, CASE WHEN count(*) FILTER (written > 0) / count(*) < 0.5 THEN 'failed' WHEN count(*) FILTER (written < fetched) > 0 THEN 'degraded' ELSE 'ok' END AS status FROM w")
def _(s, d):
    rows = clean.normalise(derive.raw_bars(_bars(s, d)), derive.SOURCE)
    good = clean.with_reason(rows.where("dropped is null"), store.KEYS["bars"], "1996-01-01", "2000-12-31")
    return clean.run_status(clean.ingest_report(good.unionByName(rows.where("dropped is not null").withColumn("reason", F.lit(None).cast("string")))))


@query("return_flags", with_(LINE, BARS, RETS) + "SELECT count(*) AS n_rows, count(*) FILTER (at_limit) AS n_at_limit, count(*) FILTER (zero_volume) AS n_zero_volume FROM rets")
def _(s, d):
    """Flag totals of a build."""
    return model.returns(_bars(s, d)).agg(F.count("*").alias("n_rows"), F.count_if("at_limit").alias("n_at_limit"), F.count_if("zero_volume").alias("n_zero_volume"))


@query("build_totals", with_(LINE, BARS, RETS, STOCKS) + ", have AS (SELECT s.ticker, count(r.ticker) AS n FROM stocks s LEFT JOIN rets r ON r.ticker = s.ticker AND sector IS NOT NULL GROUP BY 1) SELECT count(*) AS attempted, count(*) FILTER (n > 0) AS succeeded, count(*) FILTER (n = 0) AS failed, CAST(sum(n) AS BIGINT) AS n_rows FROM have")
def _(s, d):
    """Of all tickers asked for, how many have rows, and how many rows."""
    st = derive.stocks(s, d)
    made = store.of_tickers(model.returns(_bars(s, d)), st.where("sector is not null"))
    have = st.select("ticker").distinct().join(made.groupBy("ticker").count(), "ticker", "left").select(F.coalesce("count", F.lit(0)).alias("n"))
    return have.agg(F.count("*").alias("attempted"), F.count_if(F.col("n") > 0).alias("succeeded"), F.count_if(F.col("n") == 0).alias("failed"), F.sum("n").alias("n_rows"))


@query("trading_days", with_(LINE, BARS) + ", days AS (SELECT CAST(unnest(range(DATE '1996-01-01', DATE '1997-01-01', INTERVAL 1 DAY)) AS DATE) AS bar_date) SELECT d.bar_date, coalesce(i.bar_date IS NOT NULL OR NULL, isodow(d.bar_date) < 6) AS is_trading FROM days d LEFT JOIN idx i ON i.bar_date = d.bar_date")
def _(s, d):
    """Every day of a year: sessions of the index are trading days, all others by weekday."""
    days = s.range(366).select(F.date_add(F.lit("1996-01-01").cast("date"), F.col("id").cast("int")).alias("bar_date"))
    return model.with_trading_flag(days, model.trading_calendar(_index(s, d)).withColumn("is_trading", F.lit(True)))


@query("listing", with_(STOCKS) + "SELECT upper(replace(ticker, '#', '')) AS ticker, 'EX' || (CAST(split_part(industry, ' ', 2) AS INT) % 3) AS exchange, 'name of ' || ticker AS name FROM stocks")
def _(s, d):
    """Registered names: every one twice, with spaces and other cases (Q11)."""
    st = derive.stocks(s, d).select(F.regexp_replace("ticker", "#", "").alias("ticker"), F.concat(F.lit("ex"), (F.split("industry", " ")[1].cast("int") % 3).cast("string")).alias("exchange"), F.concat(F.lit("name of "), "ticker").alias("name"))
    other = st.select(F.concat(F.lit(" "), F.lower("ticker")).alias("ticker"), F.concat("exchange", F.lit(" ")).alias("exchange"), F.regexp_replace("name", " ", "  ").alias("name"))
    return clean.validate_listing(st.unionByName(other), ["EX0", "EX1", "EX2"])


# ---- alignment and studies ---------------------------------------------------------------------

_WINDOW = "WHERE bar_date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'"


@query(
    "alignment_summary",
    with_(LINE, BARS, RETS, STOCKS)
    + f""", ix AS (SELECT * FROM idxret {_WINDOW}), m AS (SELECT r.ticker, r.bar_date FROM rets r JOIN ix USING (bar_date) JOIN stocks USING (ticker)),
have AS (SELECT s.ticker, count(DISTINCT m.bar_date) AS n FROM stocks s LEFT JOIN m USING (ticker) GROUP BY 1), kept AS (SELECT m.* FROM m JOIN have USING (ticker) WHERE n = (SELECT count(*) FROM ix))
SELECT count(DISTINCT bar_date) AS t, count(DISTINCT ticker) AS n, min(bar_date) AS first_session, max(bar_date) AS last_session, (SELECT max(bar_date) FROM idx WHERE bar_date < DATE '1997-01-01' AND bar_date >= DATE '1996-11-17') AS prior_close_date,
  (SELECT count(*) FROM ix) AS n_index_sessions, (SELECT count(*) FROM have WHERE n = 0) AS n_no_overlap, (SELECT count(*) FROM have WHERE n > 0 AND n < (SELECT count(*) FROM ix)) AS n_incomplete,
  round(count(DISTINCT ticker) / count(DISTINCT bar_date), 4) AS q, (SELECT count(*) FROM ix) - count(DISTINCT bar_date) AS n_dropped_sessions FROM kept""",
)
def _(s, d):
    rets, index = model.returns(_bars(s, d)), model.index_returns(_index(s, d))
    return model.window_alignment(rets, index, _index(s, d), derive.stocks(s, d), "1997-01-01", "1998-12-31")[2]


@query("missing_sessions", with_(LINE, BARS, RETS, STOCKS) + "SELECT i.bar_date, count(*) AS n_missing FROM idxret i CROSS JOIN stocks s LEFT JOIN rets r ON r.ticker = s.ticker AND r.bar_date = i.bar_date WHERE r.ticker IS NULL GROUP BY 1")
def _(s, d):
    return model.missing_sessions(model.returns(_bars(s, d)), model.index_returns(_index(s, d)), derive.stocks(s, d))


@query("selection_taus", with_(*FULL) + "SELECT tau, count(*) AS n, count(*) FILTER (c < tau) AS n_under, round(CAST(sum(c) AS DOUBLE), 6) AS f FROM assigned, (SELECT unnest([0.005::DOUBLE, 0.02::DOUBLE, 0.1::DOUBLE]) AS tau) GROUP BY 1")
def _(s, d):
    return r(model.selection(_run(s, d)["p"], 3, [0.005, 0.02, 0.1]))


_COVER_BEFORE = ", own AS (SELECT 1 AS step, 0.0::DOUBLE AS c UNION ALL SELECT 2, CAST(c AS DOUBLE) FROM c1 WHERE i = (SELECT j FROM g2) UNION ALL SELECT 3, CAST(c AS DOUBLE) FROM c2 WHERE i = (SELECT j FROM g3))"


@query("gain_floor", with_(*FULL) + _COVER_BEFORE + " SELECT step, ticker, round(CAST(gain AS DOUBLE), 6) AS gain, round(1 - c, 6) AS own, round(CAST(gain AS DOUBLE) - (1 - c), 6) AS rest FROM steps JOIN own USING (step)")
def _(s, d):
    run = _run(s, d)
    return r(model.gain_floor(run["p"], run["steps"]))


@query(
    "swap_shares",
    with_(*FULL)
    + """, o AS (SELECT DISTINCT ticker AS out FROM steps), held AS (SELECT out, i, max(p) AS h FROM o, sim18 WHERE j IN (SELECT ticker FROM steps) AND j <> out GROUP BY 1, 2),
sw AS (SELECT out, j, CAST(sum(greatest(h, p)) AS DOUBLE) AS g FROM held JOIN sim18 USING (i) WHERE j NOT IN (SELECT ticker FROM steps) GROUP BY 1, 2), t AS (SELECT (SELECT CAST(sum(gain) AS DOUBLE) FROM steps) AS f, (SELECT count(*) FROM fitted) AS n)
SELECT count(*) AS n_swaps, round(avg(CASE WHEN g / f >= 0.99 THEN 1.0 ELSE 0.0 END), 6) AS within_1, round(avg(CASE WHEN g / f >= 0.98 THEN 1.0 ELSE 0.0 END), 6) AS within_2,
  round(avg(CASE WHEN (g - 3) / (f - 3) >= 0.99 THEN 1.0 ELSE 0.0 END), 6) AS adjusted_1, round(avg(CASE WHEN (g - 3) / (f - 3) >= 0.98 THEN 1.0 ELSE 0.0 END), 6) AS adjusted_2 FROM sw, t""",
)
def _(s, d):
    run = _run(s, d)
    total = run["steps"].agg(F.max("f").alias("f"), F.max("step").alias("k")).join(F.broadcast(run["params"].agg(F.count("*").alias("n"))))
    return r(model.swap_shares(model.swaps(run["p"], run["steps"]), total))


@query(
    "concentration_industry",
    with_(*FULL)
    + """, lab AS (SELECT a.*, industry FROM assigned a LEFT JOIN stocks USING (ticker)), ch AS (SELECT sum(n * n) / (sum(n) * sum(n)) AS chance FROM (SELECT count(*) AS n FROM lab GROUP BY industry)),
e AS (SELECT anchor, industry, count(*) AS k FROM lab GROUP BY 1, 2), g AS (SELECT anchor, sum(k) AS n, max(k) AS top, sum(k * k) AS sq FROM e GROUP BY 1)
SELECT anchor, CAST(n AS BIGINT) AS n, round(top / n, 6) AS top_share, round(sq / (n * n), 6) AS hhi, round(1 / n + (n - 1) / n * chance, 6) AS hhi_expected FROM g, ch""",
)
def _(s, d):
    return r(model.concentration(_run(s, d)["assigned"], derive.stocks(s, d), "industry"))


_LAST = (1999, 2000, 2001)


@query(
    "forward_test",
    "WITH "
    + ", ".join(f"s{y} AS MATERIALIZED {_sim_sql(y)}, a{y} AS MATERIALIZED {_steps_sql(f's{y}', 2)}" for y in _LAST)
    + " SELECT year_t, year_t1, round(stale / direct, 6) AS ratio, year_t1 = 2001 AS is_forward_test FROM ("
    + " UNION ALL ".join(f"SELECT {y} AS year_t, {y + 1} AS year_t1, {_MEANS.format(sim=f's{y + 1}', steps=f'a{y}')} AS stale, {_MEANS.format(sim=f's{y + 1}', steps=f'a{y + 1}')} AS direct" for y in _LAST[:-1])
    + ")",
)
def _(s, d):
    """The last two pairs of years; the last one of all is the forward test."""
    b, i, st = _bars(s, d), _index(s, d), derive.stocks(s, d)
    years = _years(i)[-3:]
    runs = {y: model.train(b.where(F.year("bar_date") == y), i.where(F.year("bar_date") == y), st, 2, 2, TAU) for y in years}
    out = None
    for y, to in zip(years, years[1:], strict=False):
        one = model.cross_year(runs[to]["p"], runs[y]["steps"], runs[to]["steps"]).select(F.lit(y).alias("year_t"), F.lit(to).alias("year_t1"), "ratio", F.lit(to == years[-1]).alias("is_forward_test"))
        out = one if out is None else out.union(one)
    return r(out)


@query("fit_identities", with_(*FULL) + "SELECT (SELECT max(abs(m)) FROM (SELECT avg(e) AS m FROM resid GROUP BY ticker)) < 1e-9 AND abs((SELECT CAST(sum(c) AS DOUBLE) FROM assigned) - (SELECT CAST(sum(gain) AS DOUBLE) FROM steps)) < 1e-9 AS passed, round((SELECT CAST(sum(c) AS DOUBLE) FROM assigned), 8) AS f_parts")
def _(s, d):
    from .validate import fit_identities

    run = _run(s, d)
    return r(fit_identities(_resid(s, d), run["assigned"], run["steps"], 3).select("passed", "f_parts"), 8)


# ---- streams -----------------------------------------------------------------------------------


def _folder(s: SparkSession, rows: DataFrame, parts: int = 3) -> str:
    """The rows as a few files for a stream to find."""
    return materialize(rows.repartition(parts)).written


@query("quarantine_stream", with_(LINE, BARS, FAULTS) + "SELECT ticker, bar_date, round(close, 6) AS close, volume FROM reasoned WHERE reason IS NULL")
def _(s, d):
    """Raw payloads arrive as a stream of files; good rows are upserted batch by batch."""
    raw = derive.raw_bars(_bars(s, d))
    path, base = _folder(s, raw), temporary(s, "ingest")
    found = s.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(path)
    started = stream.quarantine_into(found, derive.SOURCE, "1996-01-01", "2000-12-31", store.KEYS["bars"], f"{base}/good", f"{base}/bad").option("checkpointLocation", f"{base}/log").trigger(availableNow=True).start()
    started.awaitTermination()
    return r(merge.read(s, f"{base}/good").select("ticker", "bar_date", "close", "volume"))


@query("repeated_events_stream", "SELECT event_id, user_id, round(value, 6) AS value FROM events")
def _(s, d):
    """Every third event comes again, every fifth twice more; each is given out once."""
    e = derive.table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    again = e.unionByName(e.where("event_id % 3 = 0")).unionByName(e.where("event_id % 5 = 0")).unionByName(e.where("event_id % 5 = 0"))
    found = s.readStream.schema(again.schema).parquet(_folder(s, again))
    return r(stream.run_once(stream.distinct_events(found, ["event_id"], "60 days").select("event_id", "user_id", "value")))


@query(
    "event_bars_complete",
    """SELECT event_type, CAST(ts AS DATE) AS bar_date, round(first(value ORDER BY ts, event_id), 4) AS open, round(max(value), 4) AS high, round(min(value), 4) AS low,
  round(last(value ORDER BY ts, event_id), 4) AS close, round(sum(value), 4) AS volume, count(*) AS n FROM events GROUP BY 1, 2""",
)
def _(s, d):
    """All windows, those still open included."""
    return r(stream.run_complete(stream.event_bars(stream.read_events(s, f"{d}/events.parquet*"))), 4)


@query("frozen_residuals_stream", with_(*MODEL) + "SELECT ticker, bar_date, round(e, 8) AS e, round(e / sigma, 6) AS z FROM resid JOIN fitted USING (ticker)")
def _(s, d):
    """Returns arrive as a stream and meet the parameters of a run (T4)."""
    run = _run(s, d)
    found = s.readStream.schema(run["panel"].schema).parquet(_folder(s, run["panel"]))
    out = stream.run_once(stream.frozen_residuals(found, run["params"]))
    return out.select("ticker", "bar_date", F.round("e", 8).alias("e"), F.round("z", 6).alias("z"))


@query("ema_stream", with_(LINE, BARS, WINDOWED, RECURSE) + "SELECT ticker, bar_date, round(ema_12, 6) AS ema FROM ind WHERE ema_12 IS NOT NULL")
def _(s, d):
    """EMA with its state kept by ticker: two batches, the earlier years first."""
    b = _bars(s, d).select("ticker", "bar_date", "close")
    folder = temporary(s, "ema")
    b.where("bar_date < date'1998-01-01'").coalesce(1).write.parquet(f"{folder}/part=1")
    b.where("bar_date >= date'1998-01-01'").coalesce(1).write.parquet(f"{folder}/part=2")
    found = s.readStream.schema(b.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/part=*")
    return _with_state(s, lambda: r(stream.run_once(stream.streaming_ema(found, 12)).where("ema is not null")))


def _with_state(s: SparkSession, job):  # noqa: ANN001, ANN202
    """Run a job whose kind of state asks for a store of its own; the session's setting comes back."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = s.conf.get(key)
    s.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        return job()
    finally:
        s.conf.set(key, before)


@query("indicator_stream", with_(LINE, BARS, WINDOWED, RECURSE) + "SELECT ticker, bar_date, " + ", ".join(f"round({c}, {4 if c == 'obv' else 6}) AS {c}" for c in ("ema_12", "ema_26", "macd", "macd_signal", "rsi_14", "atr_14", "obv")) + " FROM ind")
def _(s, d):
    """All recursive indicators with their state kept by ticker: a batch a year, in order."""
    b = _bars(s, d).select("ticker", "bar_date", "high", "low", "close", "volume")
    folder = temporary(s, "running")
    for year in _years(_index(s, d)):
        b.where(F.year("bar_date") == year).coalesce(1).write.parquet(f"{folder}/part={year}")
    found = s.readStream.schema(b.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/part=*")
    out = _with_state(s, lambda: stream.run_once(stream.streaming_indicators(found)))
    return out.select("ticker", "bar_date", *(F.round(c, 4 if c == "obv" else 6).alias(c) for c in out.columns[2:]))


@query(
    "event_bars_late",
    """SELECT event_type, CAST(ts AS DATE) AS bar_date, round(first(value ORDER BY ts, event_id), 4) AS open, round(max(value), 4) AS high, round(min(value), 4) AS low,
  round(last(value ORDER BY ts, event_id), 4) AS close, round(sum(value), 4) AS volume, count(*) AS n FROM events GROUP BY 1, 2""",
)
def _(s, d):
    """Events in no order, weeks late: every one counts, and nothing is held between batches."""
    e = derive.table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    found = s.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(_folder(s, e.repartition(4, "event_id"), 4))
    base = temporary(s, "bars")
    stream.event_bars_into(found, f"{base}/bars").option("checkpointLocation", f"{base}/log").trigger(availableNow=True).start().awaitTermination()
    bars = merge.read(s, f"{base}/bars")
    return bars.select("event_type", F.to_date("bar_date").alias("bar_date"), *(F.round(c, 4).alias(c) for c in ("open", "high", "low", "close", "volume")), "n")


# ---- files, ranges ------------------------------------------------------------------------------


@query("sectors_round_trip", with_(STOCKS) + "SELECT ticker, sector, industry, CASE WHEN sector IS NULL THEN 'missing' ELSE 'industry' END AS label_source FROM stocks")
def _(s, d):
    """The dimension written to its file and read again."""
    path = temporary(s, "sectors")
    st = derive.stocks(s, d)
    label = F.when(F.col("sector").isNull(), "missing").otherwise("industry").alias("label_source")
    store.write_sectors(st.select("ticker", "sector", "industry", label), path)
    return store.scan_sectors(s, path)


@query("universe_file", with_(STOCKS) + r"SELECT 'BRAND' || regexp_extract(ticker, '(\d+)', 1) AS ticker FROM stocks WHERE CAST(regexp_extract(ticker, '(\d+)', 1) AS INT) % 2 = 1")
def _(s, d):
    """A universe read from its file: comments, lower case, repeated lines."""
    n = F.regexp_extract("ticker", r"(\d+)", 1)
    line = F.when(n.cast("int") % 2 == 1, F.concat(F.lit(" brand"), n, F.lit("  # note\nBRAND"), n)).otherwise(F.concat(F.lit("# brand"), n))
    path = temporary(s, "universe")
    derive.stocks(s, d).select(line.alias("value")).coalesce(1).write.text(path)
    return store.universe(s, path=path)


_RANGES = (("1996-03-01", "1998-12-31"), ("1999-01-01", None), (None, "1996-06-30"), (None, None), ("2030-01-01", None))


@query(
    "ticker_history_ranges",
    with_(LINE, BARS)
    + "SELECT asked, count(*) AS n, min(bar_date) AS first_day, max(bar_date) AS last_day, round(sum(close), 4) AS total FROM ("
    + " UNION ALL ".join(
        f"(SELECT {k} AS asked, bar_date, close FROM bars WHERE ticker = 'Brand#11'{'' if a is None else f" AND bar_date >= DATE '{a}'"}{'' if b is None else f" AND bar_date <= DATE '{b}'"} ORDER BY bar_date DESC LIMIT {252 if a is b is None else 2000})"
        for k, (a, b) in enumerate(_RANGES)
    )
    + ") GROUP BY 1",
)
def _(s, d):
    """History of a registered ticker by range: both bounds, either, none (then the last 252), and one without bars."""
    bars, ind_, st, out = _bars(s, d), _ind(s, d).drop("close"), derive.stocks(s, d), None
    for k, (a, b) in enumerate(_RANGES):
        rows = board.ticker_history(bars, ind_, "Brand#11", a, b, stocks=st).select(F.lit(k).alias("asked"), "bar_date", "close")
        out = rows if out is None else out.union(rows)
    return r(out.groupBy("asked").agg(F.count("*").alias("n"), F.min("bar_date").alias("first_day"), F.max("bar_date").alias("last_day"), F.sum("close").alias("total")), 4)

"""Registered queries over the market tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import indicators as ind
from ..operators import clean, model
from ..sources import derive, store
from ..sources.stored import stored
from ..streaming import stream
from . import board
from .narrative import RULES, narrative

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

LINE = """line AS (
  SELECT p_brand AS ticker, CAST(date_trunc('{unit}', l_shipdate) AS DATE) AS bar_date, l_extendedprice / l_quantity AS price, lineitem.*
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""
_ORDER = ", ".join(derive.ORDER)
BARS = f"""bars AS (
  SELECT ticker, bar_date, 'lineitem' AS source, first(price ORDER BY {_ORDER}) AS open, max(price) AS high, min(price) AS low,
         last(price ORDER BY {_ORDER}) AS close, sum(l_quantity) FILTER (l_returnflag = 'N') AS volume
  FROM line GROUP BY 1, 2
), idx AS (
  SELECT bar_date, sum(l_extendedprice) / sum(l_quantity) AS close FROM line GROUP BY 1
)"""
RETS = """rets AS (
  SELECT *, ln(close / prev_close) AS x, abs(close / prev_close - 1) >= 0.07 - 0.003 AS at_limit, coalesce(volume = 0, false) AS zero_volume
  FROM (SELECT *, lag(close) OVER (PARTITION BY ticker ORDER BY bar_date) AS prev_close FROM bars WHERE close > 0) WHERE prev_close IS NOT NULL
), idxret AS (
  SELECT bar_date, ln(close / prev) AS f, close AS index_close FROM (SELECT *, lag(close) OVER (ORDER BY bar_date) AS prev FROM idx WHERE close > 0) WHERE prev IS NOT NULL
)"""
STOCKS = r"""stocks AS (
  SELECT ticker, CASE WHEN n % 6 <> 0 THEN 'sector ' || (n % 5) END AS sector, 'industry ' || (n % 17) AS industry
  FROM (SELECT DISTINCT p_brand AS ticker, CAST(regexp_extract(p_brand, '(\d+)', 1) AS INT) AS n FROM part)
)"""
PANEL = """matched AS (
  SELECT r.ticker, r.bar_date, x, f FROM rets r JOIN idxret USING (bar_date)
), report AS (
  SELECT s.ticker, count(DISTINCT m.bar_date) AS n, (SELECT count(DISTINCT bar_date) FROM idxret) AS n_sessions
  FROM stocks s LEFT JOIN matched m USING (ticker) GROUP BY 1
), panel AS (
  SELECT m.* FROM matched m JOIN report r USING (ticker) WHERE n = n_sessions
)"""
FIT = """moments AS (
  SELECT ticker, count(*) AS t, avg(x) AS mx, avg(f) AS mf, covar_pop(x, f) AS cxf, var_pop(f) AS vf, var_pop(x) AS vx FROM panel GROUP BY 1
), fitted AS (
  SELECT ticker, t, mx - cxf / vf * mf AS alpha, cxf / vf AS beta, sqrt(greatest(0, vx - cxf / vf * cxf) * t / (t - 2)) AS sigma, least(1, greatest(0, cxf / vf * cxf / vx)) AS r2 FROM moments
), resid AS (
  SELECT p.ticker, bar_date, x - alpha - beta * f AS e FROM panel p JOIN fitted USING (ticker)
)"""
PAIRS = """centred AS (
  SELECT ticker, bar_date, (e - avg(e) OVER w) / sqrt(var_pop(e) OVER w * count(*) OVER w) AS z FROM resid WINDOW w AS (PARTITION BY ticker)
), sim AS (
  SELECT a.ticker AS i, b.ticker AS j, CASE WHEN a.ticker = b.ticker THEN 1.0 ELSE least(1, pow(sum(a.z * b.z), 2)) END AS p
  FROM centred a JOIN centred b USING (bar_date) GROUP BY 1, 2
)"""


def with_(*parts: str, unit: str = "week") -> str:
    return "WITH RECURSIVE " + ",\n".join(p.replace("{unit}", unit) for p in parts) + "\n"


def query(name: str, sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def r(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles and decimals to a fixed number of digits, for comparing."""
    return df.select(*(F.round(F.col(c).cast("double"), digits).alias(c) if k == "double" or k.startswith("decimal") else F.col(c) for c, k in df.dtypes))


# ---- stored tables: written once in a session, read by all questions below ---------------------


def _days(s: SparkSession, d: str) -> DataFrame:
    """What bars and index of every unit are made of, so that a session reads the trades for it once."""
    return stored(s, d, "days", lambda: derive.days(s, d))


def _bars(s: SparkSession, d: str, unit: str = "week") -> DataFrame:
    return stored(s, d, f"bars {unit}", lambda: derive.bars_of(_days(s, d), unit))


def _index(s: SparkSession, d: str, unit: str = "week") -> DataFrame:
    return stored(s, d, f"index {unit}", lambda: derive.index_of(_days(s, d), unit))


def _ind(s: SparkSession, d: str) -> DataFrame:
    return stored(s, d, "indicators", lambda: ind.indicators(_bars(s, d)))


# ---- bars, cleaning, storage -------------------------------------------------------------------


@query("bars_weekly", with_(LINE, BARS) + "SELECT ticker, bar_date, source, round(open, 9) AS open, round(high, 9) AS high, round(low, 9) AS low, round(close, 9) AS close, volume FROM bars")
def _(s, d):
    b = derive.bars(s, d)
    return b.select("ticker", "bar_date", "source", *(F.round(c, 9).alias(c) for c in ("open", "high", "low", "close")), "volume")


@query("bars_monthly", with_(LINE, BARS, unit="month") + "SELECT ticker, bar_date, round(close, 9) AS close, volume FROM bars")
def _(s, d):
    return derive.bars(s, d, "month").select("ticker", "bar_date", F.round("close", 9).alias("close"), "volume")


@query("index_bars_weekly", with_(LINE, BARS) + "SELECT 'ALL' AS index_symbol, bar_date, 'lineitem' AS source, round(close, 6) AS close FROM idx")
def _(s, d):
    return r(derive.index_bars(s, d))


@query("stocks", with_(STOCKS) + "SELECT * FROM stocks")
def _(s, d):
    return derive.stocks(s, d)


FAULTS = r"""faulty AS (
  SELECT *, date_diff('day', DATE '1995-01-02', bar_date) AS off FROM bars
), numbered AS (
  SELECT *, abs(off) + CAST(regexp_extract(ticker, '(\d+)', 1) AS INT) AS n FROM faulty
), typed AS (
  SELECT ticker, CASE WHEN n % 89 <> 0 THEN bar_date END AS bar_date, source, open, CASE WHEN n % 103 = 0 THEN low - 1 ELSE high END AS high, low,
         CASE WHEN n % 97 = 0 THEN NULL WHEN n % 101 = 0 THEN 0 ELSE close END AS close, volume, 0 AS position, n
  FROM numbered
), twice AS (
  SELECT * FROM typed UNION ALL SELECT * REPLACE (1 AS position) FROM typed WHERE n % 83 = 0
), judged AS (
  SELECT *, CASE WHEN bar_date IS NULL THEN 'no_date' WHEN close IS NULL THEN 'no_close' END AS dropped FROM twice
), reasoned AS (
  SELECT *, CASE WHEN open <= 0 OR high <= 0 OR low <= 0 OR close <= 0 OR volume < 0 OR high < low THEN 'sanity' WHEN position > 0 THEN 'duplicates'
    WHEN bar_date NOT BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' THEN 'window' END AS reason
  FROM judged WHERE dropped IS NULL
)"""
WINDOW = ("1996-01-01", "2000-12-31")


def _reasoned(s: SparkSession, d: str) -> DataFrame:
    rows = clean.normalise(derive.raw_bars(derive.bars(s, d)), derive.SOURCE).where("dropped is null")
    return clean.with_reason(rows, store.KEYS["bars"], *WINDOW)


@query("normalise_drops", with_(LINE, BARS, FAULTS) + "SELECT ticker, coalesce(dropped, 'kept') AS outcome, count(*) AS n FROM judged GROUP BY 1, 2")
def _(s, d):
    rows = clean.normalise(derive.raw_bars(_bars(s, d)), derive.SOURCE)
    return rows.groupBy("ticker", F.coalesce("dropped", F.lit("kept")).alias("outcome")).agg(F.count("*").alias("n"))


@query("quarantine", with_(LINE, BARS, FAULTS) + "SELECT ticker, bar_date, position, round(close, 6) AS close, coalesce(reason, 'kept') AS reason FROM reasoned")
def _(s, d):
    return _reasoned(s, d).select("ticker", "bar_date", "position", F.round("close", 6).alias("close"), F.coalesce("reason", F.lit("kept")).alias("reason"))


@query(
    "quality_report",
    with_(LINE, BARS, FAULTS)
    + """, offenders AS (
  SELECT *, row_number() OVER (PARTITION BY reason ORDER BY ticker, bar_date) AS k FROM (SELECT DISTINCT reason, ticker, bar_date FROM reasoned WHERE reason IS NOT NULL)
), listed AS (
  SELECT reason, '[' || string_agg('{"ticker":"' || ticker || '","bar_date":"' || bar_date || '"}', ',' ORDER BY k) || ']' AS details FROM offenders WHERE k <= 20 GROUP BY 1
), blanks AS (
  SELECT count(*) FILTER (open IS NULL) AS n_open, count(*) FILTER (high IS NULL) AS n_high, count(*) FILTER (low IS NULL) AS n_low, count(*) FILTER (volume IS NULL) AS n_volume FROM reasoned
)
SELECT 'bars' AS scope, c."check", 'error' AS severity, (SELECT count(*) FROM reasoned WHERE reason = c."check") AS n_bad, details IS NULL AS passed, coalesce(details, '[]') AS details, n_open, n_high, n_low, n_volume
FROM (VALUES ('sanity'), ('duplicates'), ('window')) c("check") LEFT JOIN listed ON reason = c."check", blanks""",
)
def _(s, d):
    rows = _reasoned(s, d)
    return clean.check_report(rows, "bars").join(F.broadcast(clean.null_report(rows)))


@query(
    "ingest_report",
    with_(LINE, BARS, FAULTS)
    + """, all_rows AS (
  SELECT j.ticker, j.bar_date, j.dropped, r.reason FROM judged j LEFT JOIN reasoned r ON j.ticker = r.ticker AND j.bar_date = r.bar_date AND j.position = r.position AND j.dropped IS NULL
), summed AS (
  SELECT ticker, count(*) AS fetched, count(*) FILTER (dropped IS NULL) AS normalised, count(*) FILTER (dropped IS NULL AND reason = 'window') AS trimmed, count(*) FILTER (dropped = 'no_date') AS no_date, count(*) FILTER (dropped = 'no_close') AS no_close,
         count(*) FILTER (dropped IS NULL AND reason IS NOT NULL) AS quarantined, count(*) FILTER (dropped IS NULL AND reason IS NULL) AS written,
         min(bar_date) FILTER (dropped IS NULL AND reason IS NULL) AS first_bar, max(bar_date) FILTER (dropped IS NULL AND reason IS NULL) AS last_bar
  FROM all_rows GROUP BY 1
) SELECT *, CASE WHEN written = 0 THEN 'empty' WHEN written < fetched THEN 'degraded' ELSE 'ok' END AS status FROM summed""",
)
def _(s, d):
    rows = clean.normalise(derive.raw_bars(_bars(s, d)), derive.SOURCE)
    good = clean.with_reason(rows.where("dropped is null"), store.KEYS["bars"], *WINDOW)
    return clean.ingest_report(good.unionByName(rows.where("dropped is not null").withColumn("reason", F.lit(None).cast("string"))))


@query("coverage_check", with_(LINE, BARS) + "SELECT ticker, count(DISTINCT bar_date) AS n_rows, (SELECT count(*) FROM idx) AS n_expected, round(count(DISTINCT bar_date) / (SELECT count(*) FROM idx), 6) AS ratio, count(DISTINCT bar_date) / (SELECT count(*) FROM idx) >= 0.5 AS passed FROM bars GROUP BY 1")
def _(s, d):
    return r(clean.coverage(_bars(s, d), _index(s, d)))


@query("high_water_marks", with_(LINE, BARS, STOCKS) + "SELECT s.ticker, max(bar_date) AS last_date FROM stocks s LEFT JOIN bars b ON b.ticker = s.ticker AND bar_date < DATE '1998-01-01' AND sector IS NOT NULL GROUP BY 1")
def _(s, d):
    st = derive.stocks(s, d)
    known = _bars(s, d).join(F.broadcast(st.where("sector is not null").select("ticker")), "ticker", "left_semi").where("bar_date < date'1998-01-01'")
    return store.high_water_marks(known, st)


@query(
    "upsert",
    with_(LINE, BARS)
    + ", old AS (SELECT ticker, bar_date, close, 1 AS ingested FROM bars WHERE bar_date < DATE '2000-01-01'), new AS (SELECT ticker, bar_date, close + 1 AS close, 2 AS ingested FROM bars WHERE bar_date >= DATE '1999-01-01') SELECT ticker, bar_date, round(coalesce(n.close, o.close), 6) AS close, coalesce(o.ingested, n.ingested) AS ingested FROM old o FULL JOIN new n USING (ticker, bar_date)",
)
def _(s, d):
    b = _bars(s, d)
    old = b.where("bar_date < date'2000-01-01'").select("ticker", "bar_date", "close", F.lit(1).alias("ingested"))
    new = b.where("bar_date >= date'1999-01-01'").select("ticker", "bar_date", (F.col("close") + 1).alias("close"), F.lit(2).alias("ingested"))
    return r(store.upsert(old, new, ["ticker", "bar_date"], keep=("ingested",)))


@query("mirror_report", with_(LINE, BARS, STOCKS) + "SELECT s.ticker, count(b.ticker) AS n_rows FROM stocks s LEFT JOIN bars b ON b.ticker = s.ticker AND s.sector IS NOT NULL GROUP BY 1")
def _(s, d):
    st, b = derive.stocks(s, d), _bars(s, d)
    known = b.join(F.broadcast(st.where("sector is not null").select("ticker")), "ticker", "left_semi")
    return store.mirror(known, b.limit(0), st, store.KEYS["bars"])[1]


# ---- returns and model -------------------------------------------------------------------------


@query("returns", with_(LINE, BARS, RETS) + "SELECT ticker, bar_date, round(x, 8) AS x, at_limit, zero_volume FROM rets")
def _(s, d):
    return r(model.returns(_bars(s, d)).select("ticker", "bar_date", "x", "at_limit", "zero_volume"), 8)


@query("index_returns", with_(LINE, BARS, RETS) + "SELECT bar_date, round(f, 8) AS f FROM idxret")
def _(s, d):
    return r(model.index_returns(_index(s, d)).select("bar_date", "f"), 8)


def _panel(s: SparkSession, d: str, unit: str = "week") -> tuple[DataFrame, DataFrame]:
    return model.align(model.returns(_bars(s, d, unit)), model.index_returns(_index(s, d, unit)), derive.stocks(s, d))


@query(
    "alignment_report",
    with_(LINE, BARS, RETS, STOCKS, PANEL) + "SELECT ticker, n, n_sessions, round(n / n_sessions, 4) AS coverage, CASE WHEN n = 0 THEN 'no_overlap' WHEN n < n_sessions THEN 'incomplete' END AS dropped FROM report",
)
def _(s, d):
    return _panel(s, d)[1]


MODEL = (LINE, BARS, RETS, STOCKS, PANEL, FIT)


@query("factor_fit", with_(*MODEL) + "SELECT ticker, t, round(alpha, 8) AS alpha, round(beta, 6) AS beta, round(sigma, 8) AS sigma, round(r2, 8) AS r2 FROM fitted")
def _(s, d):
    f = model.fit(_panel(s, d)[0])
    return f.select("ticker", "t", F.round("alpha", 8).alias("alpha"), F.round("beta", 6).alias("beta"), F.round("sigma", 8).alias("sigma"), F.round("r2", 8).alias("r2"))


def _resid(s: SparkSession, d: str) -> DataFrame:
    panel = _panel(s, d)[0]
    return model.residuals(panel, model.fit(panel))


@query("residuals", with_(*MODEL) + "SELECT ticker, bar_date, round(e, 8) AS e FROM resid")
def _(s, d):
    return r(_resid(s, d), 8)


@query("similarity_rho2", with_(*MODEL, PAIRS) + "SELECT i, j, round(p, 8) AS p FROM sim")
def _(s, d):
    return r(model.rho2(_resid(s, d)), 8)


DCOR = """far AS (
  SELECT a.ticker, a.bar_date AS s, b.bar_date AS t, abs(a.e - b.e) AS d FROM resid a JOIN resid b USING (ticker)
), centred2 AS (
  SELECT *, d - avg(d) OVER (PARTITION BY ticker, s) - avg(d) OVER (PARTITION BY ticker, t) + avg(d) OVER (PARTITION BY ticker) AS c FROM far
), gram AS (
  SELECT a.ticker AS i, b.ticker AS j, sum(a.c * b.c) AS g FROM centred2 a JOIN centred2 b USING (s, t) GROUP BY 1, 2
)"""


@query(
    "similarity_dcor2",
    with_(*MODEL, DCOR, unit="quarter") + "SELECT x.i, x.j, round(CASE WHEN x.i = x.j THEN 1 ELSE least(1, greatest(0, x.g / sqrt(a.g * b.g))) END, 6) AS p FROM gram x JOIN gram a ON a.i = x.i AND a.j = x.i JOIN gram b ON b.i = x.j AND b.j = x.j",
)
def _(s, d):
    panel = _panel(s, d, "quarter")[0]
    return r(model.dcor2(model.residuals(panel, model.fit(panel)), block=8))


@query(
    "similarity_dcor2_weekly",
    with_(*MODEL, DCOR) + "SELECT x.i, x.j, round(CASE WHEN x.i = x.j THEN 1 ELSE least(1, greatest(0, x.g / sqrt(a.g * b.g))) END, 6) AS p FROM gram x JOIN gram a ON a.i = x.i AND a.j = x.i JOIN gram b ON b.i = x.j AND b.j = x.j",
)
def _(s, d):
    """Over the sessions that the other similarities take."""
    return r(model.dcor2(_resid(s, d)))


DCOR_U = DCOR.replace(
    "SELECT *, d - avg(d) OVER (PARTITION BY ticker, s) - avg(d) OVER (PARTITION BY ticker, t) + avg(d) OVER (PARTITION BY ticker) AS c FROM far",
    "SELECT *, CASE WHEN s = t THEN 0 ELSE d - sum(d) OVER (PARTITION BY ticker, s) / (n - 2) - sum(d) OVER (PARTITION BY ticker, t) / (n - 2) + sum(d) OVER (PARTITION BY ticker) / ((n - 1) * (n - 2)) END AS c FROM far, (SELECT count(DISTINCT bar_date) AS n FROM resid)",
)


@query(
    "similarity_dcor2_u",
    with_(*MODEL, DCOR_U, unit="quarter") + "SELECT x.i, x.j, round(CASE WHEN x.i = x.j THEN 1 ELSE x.g / sqrt(a.g * b.g) END, 6) AS p FROM gram x JOIN gram a ON a.i = x.i AND a.j = x.i JOIN gram b ON b.i = x.j AND b.j = x.j",
)
def _(s, d):
    panel = _panel(s, d, "quarter")[0]
    return r(model.dcor2(model.residuals(panel, model.fit(panel)), unbiased=True, block=8))


GREEDY = """sim18 AS (SELECT i, j, CAST(p AS DECIMAL(20,18)) AS p FROM sim),
g1 AS (SELECT j, sum(p) AS gain FROM sim18 GROUP BY j ORDER BY gain DESC, j LIMIT 1),
c1 AS (SELECT i, p AS c FROM sim18 WHERE j = (SELECT j FROM g1)),
g2 AS (SELECT j, sum(greatest(0, p - c)) AS gain FROM sim18 JOIN c1 USING (i) WHERE j NOT IN (SELECT j FROM g1) GROUP BY j ORDER BY gain DESC, j LIMIT 1),
c2 AS (SELECT i, greatest(c, p) AS c FROM c1 JOIN sim18 USING (i) WHERE j = (SELECT j FROM g2)),
g3 AS (SELECT j, sum(greatest(0, p - c)) AS gain FROM sim18 JOIN c2 USING (i) WHERE j NOT IN (SELECT j FROM g1 UNION SELECT j FROM g2) GROUP BY j ORDER BY gain DESC, j LIMIT 1),
steps AS (SELECT 1 AS step, j AS ticker, gain FROM g1 UNION ALL SELECT 2, j, gain FROM g2 UNION ALL SELECT 3, j, gain FROM g3),
best AS (SELECT i AS ticker, j AS anchor, p AS c, row_number() OVER (PARTITION BY i ORDER BY p DESC, j) AS n FROM sim18 WHERE j IN (SELECT ticker FROM steps)),
assigned AS (SELECT ticker, anchor, c FROM best WHERE n = 1)"""
FULL = (*MODEL, PAIRS, GREEDY)


def _run(s: SparkSession, d: str, unit: str = "week", k: int = 3, k_max: int = 3) -> dict[str, DataFrame]:
    """A run as its stored tables; trained once in a session."""
    made: dict[str, DataFrame] = {}

    def part(name: str) -> DataFrame:
        if not made:
            made.update(_train(s, d, unit, k, k_max))
        return made[name]

    return {name: stored(s, d, f"run {unit} {k} {k_max} {name}", lambda name=name: part(name)) for name in ("panel", "report", "params", "p", "steps", "assigned", "groups", "under")}


def _train(s: SparkSession, d: str, unit: str, k: int, k_max: int) -> dict[str, DataFrame]:
    return model.train(_bars(s, d, unit), _index(s, d, unit), derive.stocks(s, d), k, k_max, 0.1)


@query("greedy_steps", with_(*FULL) + "SELECT step, ticker, round(CAST(gain AS DOUBLE), 8) AS gain, round(CAST(sum(gain) OVER (ORDER BY step) AS DOUBLE), 8) AS f FROM steps")
def _(s, d):
    """Trained anew."""
    return r(_train(s, d, "week", 3, 3)["steps"], 8)


@query("assignment", with_(*FULL) + "SELECT ticker, anchor, round(CAST(c AS DOUBLE), 8) AS c FROM assigned")
def assignment(s, d, unit="week"):
    return r(_run(s, d, unit)["assigned"], 8).select("ticker", "anchor", "c")


@query("group_stats", with_(*FULL) + "SELECT anchor, count(*) AS size, round(CAST(sum(c) AS DOUBLE), 6) AS f, round(avg(CAST(c AS DOUBLE)), 6) AS mean_c, round(CAST(min(c) AS DOUBLE), 6) AS min_c, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM assigned GROUP BY 1")
def _(s, d):
    return r(_run(s, d)["groups"])


@query("under_threshold", with_(*FULL) + "SELECT tau, ticker, round(CAST(c AS DOUBLE), 8) AS c FROM assigned, (SELECT unnest([0.005::DOUBLE, 0.01::DOUBLE, 0.1::DOUBLE]) AS tau) WHERE c < tau")
def _(s, d):
    return r(model.under(_run(s, d)["assigned"], [0.005, 0.01, 0.1]), 8)


def _cover_sql(k: int) -> str:
    """All subsets of k tickers."""
    rows = " ".join(f"JOIN sim18 x{m} ON x{m}.i = x1.i AND x{m - 1}.j < x{m}.j" for m in range(2, k + 1))
    names, best = ", ".join(f"x{m}.j AS j{m}" for m in range(1, k + 1)), f"sum(greatest({', '.join(f'x{m}.p' for m in range(1, k + 1))}))"
    keys = ", ".join(map(str, range(1, k + 1)))
    return f"SELECT {names}, round(CAST({best} AS DOUBLE), 8) AS f FROM sim18 x1 {rows} GROUP BY {keys} ORDER BY {best} DESC, {keys} LIMIT 1"


for _k in (2, 3, 4, 5):

    @query(f"exact_cover_{_k}", with_(*MODEL, PAIRS, "sim18 AS (SELECT i, j, CAST(p AS DECIMAL(20,18)) AS p FROM sim)") + _cover_sql(_k))
    def _(s, d, k=_k):
        return r(model.exact_cover(model.rho2(_resid(s, d)), k), 8)


@query("anchor_steps", with_(*FULL) + ", g AS (SELECT anchor AS ticker, count(*) AS size FROM assigned GROUP BY 1), s2 AS (SELECT step, ticker, sum(gain) OVER (ORDER BY step) AS f FROM steps) SELECT step, ticker, size, sector, round((CAST(f AS DOUBLE) - step) / ((SELECT count(*) FROM fitted) - step), 6) AS adjusted FROM s2 LEFT JOIN g USING (ticker) LEFT JOIN stocks USING (ticker)")
def _(s, d):
    run = _run(s, d)
    n = run["params"].agg(F.count("*").alias("n_universe"))
    return r(board.anchors(run["steps"], run["groups"], derive.stocks(s, d), n).select("step", "ticker", "size", "sector", "adjusted"))


@query("group_composition", with_(*FULL) + ", k AS (SELECT anchor, coalesce(sector, 'other') AS sector, count(*) AS n FROM assigned LEFT JOIN stocks USING (ticker) GROUP BY 1, 2) SELECT anchor, string_agg(sector || ':' || n, ',' ORDER BY n DESC, sector) AS composition FROM k GROUP BY 1")
def _(s, d):
    return board.composition(_run(s, d)["assigned"], derive.stocks(s, d))


@query("concentration", with_(*FULL) + """, lab AS (SELECT a.*, sector FROM assigned a LEFT JOIN stocks USING (ticker)), ch AS (SELECT sum(n * n) / (sum(n) * sum(n)) AS chance FROM (SELECT count(*) AS n FROM lab GROUP BY sector)),
e AS (SELECT anchor, sector, count(*) AS k FROM lab GROUP BY 1, 2), g AS (SELECT anchor, sum(k) AS n, max(k) AS top, sum(k * k) AS sq FROM e GROUP BY 1)
SELECT anchor, CAST(n AS BIGINT) AS n, round(top / n, 6) AS top_share, round(sq / (n * n), 6) AS hhi, round(1 / n + (n - 1) / n * chance, 6) AS hhi_expected FROM g, ch""")
def _(s, d):
    return r(model.concentration(_run(s, d)["assigned"], derive.stocks(s, d)))


@query("tightness", with_(*FULL) + "SELECT anchor, count(*) AS n_members, round(avg(CAST(c AS DOUBLE)), 6) AS mean_p FROM assigned WHERE ticker <> anchor GROUP BY 1")
def _(s, d):
    run = _run(s, d)
    return r(model.tightness(run["p"], run["assigned"]))


@query("swaps", with_(*FULL) + """, o AS (SELECT DISTINCT ticker AS out FROM steps), n AS (SELECT DISTINCT j AS "into" FROM sim18 WHERE j NOT IN (SELECT ticker FROM steps)),
held AS (SELECT out, i, max(p) AS h FROM o, sim18 WHERE j IN (SELECT ticker FROM steps) AND j <> out GROUP BY 1, 2)
SELECT out, "into", round(CAST(sum(greatest(h, p)) AS DOUBLE), 8) AS f FROM held JOIN sim18 USING (i) JOIN n ON n."into" = j GROUP BY 1, 2""")
def _(s, d):
    run = _run(s, d)
    return r(model.swaps(run["p"], run["steps"]), 8)


@query("noise_floor", with_(*MODEL) + "SELECT n, t, round(pow(sqrt(2 * ln(2 * n * (n - 1) / 2)) / sqrt(t - 1), 2), 8) AS noise FROM (SELECT count(*) AS n, max(t) AS t FROM fitted)")
def _(s, d):
    f = model.fit(_panel(s, d)[0]).agg(F.count("*").alias("n"), F.max("t").alias("t"))
    return r(f.withColumn("noise", model.noise_floor(F.col("n"), F.col("t"))), 8)


@query("leave_one_out_fit", with_(LINE, BARS, RETS, STOCKS, PANEL, "loo AS (SELECT ticker, bar_date, x, (count(*) OVER w * avg(x) OVER w - x) / (count(*) OVER w - 1) AS f FROM panel WINDOW w AS (PARTITION BY bar_date))") + "SELECT ticker, round(covar_pop(x, f) / var_pop(f), 6) AS beta FROM loo GROUP BY 1")
def _(s, d):
    return r(model.fit(model.equal_weight_factor(_panel(s, d)[0], True)).select("ticker", "beta"))


@query("masked_rho2", with_(*MODEL) + """, ok AS (SELECT e.* FROM resid e JOIN rets r USING (ticker, bar_date) WHERE NOT at_limit)
SELECT i, j, count(*) AS t, round(least(1, coalesce(pow(covar_pop(a, b), 2) / nullif(var_pop(a) * var_pop(b), 0), 0)), 6) AS p FROM (SELECT x.ticker AS i, y.ticker AS j, x.e AS a, y.e AS b FROM ok x JOIN ok y USING (bar_date) WHERE x.ticker < y.ticker) GROUP BY 1, 2 HAVING count(*) >= 3""")
def _(s, d):
    flags = model.returns(_bars(s, d)).select("ticker", "bar_date", F.col("at_limit").alias("flagged"))
    return r(model.masked_rho2(_resid(s, d), flags))


@query("full_coverage_universe", with_(LINE, BARS, RETS) + """, need AS (SELECT year(bar_date) AS y, count(DISTINCT bar_date) AS need FROM idxret GROUP BY 1), have AS (SELECT ticker, year(bar_date) AS y, count(DISTINCT bar_date) AS have FROM rets JOIN idxret USING (bar_date) GROUP BY 1, 2)
SELECT t.ticker, coalesce(string_agg(CASE WHEN coalesce(have, 0) < need THEN CAST(n.y AS VARCHAR) END, ',' ORDER BY n.y), '') AS failing_years, count(*) FILTER (coalesce(have, 0) < need) = 0 AS complete
FROM (SELECT DISTINCT ticker FROM rets) t CROSS JOIN need n LEFT JOIN have h ON h.ticker = t.ticker AND h.y = n.y GROUP BY 1""")
def _(s, d):
    out = model.full_coverage_universe(model.returns(_bars(s, d)), model.index_returns(_index(s, d)))
    return out.withColumn("failing_years", F.array_join(F.col("failing_years").cast("array<string>"), ","))


@query("universe_version", with_(STOCKS) + "SELECT 'u' || substr(sha256(string_agg(ticker, chr(10) ORDER BY ticker)), 1, 8) AS version FROM stocks")
def _(s, d):
    return model.universe_version(derive.stocks(s, d))


@query("trading_calendar", with_(LINE, BARS) + "SELECT bar_date, CAST(row_number() OVER (ORDER BY bar_date) - 1 AS INT) AS session_seq FROM idx")
def _(s, d):
    return model.trading_calendar(_index(s, d))


@query("permutation_null")
def _(s, d):
    return r(model.permutation_null(_resid(s, d), 3, 1000))


@query("permutation_null_dcor2")
def _(s, d):
    return r(model.permutation_null(_resid(s, d), 3, 1000, measure="dcor2"))


@query("spectrum")
def _(s, d):
    return r(model.spectrum(_panel(s, d)[0]))


@query("spectra")
def _(s, d):
    """Of the returns and of the residuals, what stands above the edge."""
    panel = _panel(s, d)[0]
    return r(model.spectra({"x": (panel, "x"), "e": (model.residuals(panel, model.fit(panel)), "e")}))


# ---- comparisons of runs ----

_MEANS = "(SELECT sum(c) / (SELECT count(DISTINCT i) FROM {sim}) FROM (SELECT i, CAST(max(p) AS DOUBLE) AS c FROM {sim} WHERE j IN (SELECT ticker FROM {steps}) GROUP BY i))"


def _sim_sql(year: int) -> str:
    """Similarity over the weekly bars of one year."""
    line = LINE.replace("ON l_partkey = p_partkey", f"ON l_partkey = p_partkey WHERE year(date_trunc('week', l_shipdate)) = {year}")
    return "(" + with_(line, *MODEL[1:], PAIRS) + "SELECT i, j, CAST(p AS DECIMAL(20,18)) AS p FROM sim)"


def _steps_sql(sim: str, k: int = 3) -> str:
    """Greedy steps on the CTE ``sim``."""
    return "(WITH " + GREEDY.replace("FROM sim)", f"FROM {sim})", 1) + f" SELECT step, ticker, gain FROM steps WHERE step <= {k})"


def _anchor_frequency(b: DataFrame, i: DataFrame, st: DataFrame, years: Sequence[int]) -> DataFrame:
    out = None
    for year in years:
        inside = F.year("bar_date") == year
        steps = model.train(b.where(inside), i.where(inside), st, 2, 2, 0.1)["steps"].select(F.lit(year).alias("year"), "ticker")
        out = steps if out is None else out.union(steps)
    return model.anchor_frequency(out)


def _cross_years(b: DataFrame, i: DataFrame, st: DataFrame, years: Sequence[int]) -> DataFrame:
    """Each of ``years`` against the one before it in the list."""
    runs = {y: model.train(b.where(F.year("bar_date") == y), i.where(F.year("bar_date") == y), st, 2, 2, 0.1) for y in years}
    out = None
    for y, to in zip(years, years[1:], strict=False):
        one = model.cross_year(runs[to]["p"], runs[y]["steps"], runs[to]["steps"]).select(F.lit(y).alias("from_year"), F.lit(to).alias("to_year"), "stale", "direct", "ratio")
        out = one if out is None else out.union(one)
    return out


_CALENDAR = (1996, 1997, 1998, 1999, 2000)


@query(
    "anchor_frequency",
    "WITH "
    + ", ".join(f"s{y} AS MATERIALIZED {_sim_sql(y)}, a{y} AS MATERIALIZED {_steps_sql(f's{y}', 2)}" for y in _CALENDAR)
    + ", picks AS ("
    + " UNION ALL ".join(f"SELECT {y} AS year, ticker FROM a{y}" for y in _CALENDAR)
    + ") SELECT ticker, count(*) AS n_selected, string_agg(CAST(year AS VARCHAR), ',' ORDER BY year) AS years, (SELECT count(DISTINCT year) FROM picks) AS n_years, round(count(*) / (SELECT count(DISTINCT year) FROM picks), 6) AS share FROM picks GROUP BY 1",
)
def _(s, d):
    """Anchors of each calendar year of weekly bars, and how often each ticker is one."""
    b, i, st = _bars(s, d), _index(s, d), derive.stocks(s, d)
    return r(_anchor_frequency(b, i, st, _CALENDAR).withColumn("years", F.array_join(F.col("years").cast("array<string>"), ",")))


_YEARS = (1997, 1998, 1999)


@query(
    "cross_year",
    "WITH "
    + ", ".join(f"s{y} AS MATERIALIZED {_sim_sql(y)}, a{y} AS MATERIALIZED {_steps_sql(f's{y}', 2)}" for y in _YEARS)
    + " SELECT from_year, to_year, round(stale, 6) AS stale, round(direct, 6) AS direct, round(stale / direct, 6) AS ratio FROM ("
    + " UNION ALL ".join(f"SELECT {y} AS from_year, {y + 1} AS to_year, {_MEANS.format(sim=f's{y + 1}', steps=f'a{y}')} AS stale, {_MEANS.format(sim=f's{y + 1}', steps=f'a{y + 1}')} AS direct" for y in _YEARS[:-1])
    + ")",
)
def _(s, d):
    return r(_cross_years(_bars(s, d), _index(s, d), derive.stocks(s, d), _YEARS))


def _years(index: DataFrame) -> list[int]:
    """All calendar years of the index: one row by year."""
    return sorted(x["year"] for x in index.select(F.year("bar_date").alias("year")).distinct().collect())


#: The model of each calendar year by itself, whichever years there are: everything is kept apart by ``y``.
YEARLY = """yrets AS (
  SELECT ticker, year(bar_date) AS y, bar_date, ln(close / prev) AS x FROM (SELECT *, lag(close) OVER (PARTITION BY ticker, year(bar_date) ORDER BY bar_date) AS prev FROM bars WHERE close > 0) WHERE prev IS NOT NULL
), yidx AS (
  SELECT year(bar_date) AS y, bar_date, ln(close / prev) AS f FROM (SELECT *, lag(close) OVER (PARTITION BY year(bar_date) ORDER BY bar_date) AS prev FROM idx WHERE close > 0) WHERE prev IS NOT NULL
), ymatched AS (
  SELECT ticker, y, bar_date, x, f FROM yrets JOIN yidx USING (y, bar_date)
), ypanel AS (
  SELECT ticker, y, bar_date, x, f FROM ymatched JOIN (SELECT y, ticker, count(DISTINCT bar_date) AS n FROM ymatched GROUP BY 1, 2) USING (y, ticker) JOIN (SELECT y, count(DISTINCT bar_date) AS need FROM yidx GROUP BY 1) USING (y) WHERE n = need
), yfit AS (
  SELECT y, ticker, avg(x) - covar_pop(x, f) / var_pop(f) * avg(f) AS alpha, covar_pop(x, f) / var_pop(f) AS beta FROM ypanel GROUP BY 1, 2
), ycentred AS (
  SELECT y, ticker, bar_date, (e - avg(e) OVER w) / sqrt(var_pop(e) OVER w * count(*) OVER w) AS z FROM (SELECT y, ticker, bar_date, x - alpha - beta * f AS e FROM ypanel JOIN yfit USING (y, ticker)) WINDOW w AS (PARTITION BY y, ticker)
), ysim AS (
  SELECT a.y, a.ticker AS i, b.ticker AS j, CAST(CASE WHEN a.ticker = b.ticker THEN 1.0 ELSE least(1, pow(sum(a.z * b.z), 2)) END AS DECIMAL(20,18)) AS p FROM ycentred a JOIN ycentred b USING (y, bar_date) GROUP BY 1, 2, 3
), yg1 AS (
  SELECT y, j FROM (SELECT y, j, row_number() OVER (PARTITION BY y ORDER BY sum(p) DESC, j) AS n FROM ysim GROUP BY 1, 2) WHERE n = 1
), yc1 AS (
  SELECT y, i, p AS c FROM ysim JOIN yg1 USING (y, j)
), yg2 AS (
  SELECT y, j FROM (SELECT y, s.j, row_number() OVER (PARTITION BY y ORDER BY sum(greatest(0, p - c)) DESC, s.j) AS n FROM ysim s JOIN yc1 USING (y, i) JOIN yg1 g USING (y) WHERE s.j <> g.j GROUP BY 1, 2) WHERE n = 1
), ysteps AS (
  SELECT y, j AS ticker FROM yg1 UNION ALL SELECT y, j FROM yg2
)"""


@query(
    "anchor_frequency_all",
    with_(LINE, BARS, YEARLY)
    + "SELECT ticker, count(*) AS n_selected, string_agg(CAST(y AS VARCHAR), ',' ORDER BY y) AS years, (SELECT count(DISTINCT y) FROM ysteps) AS n_years, round(count(*) / (SELECT count(DISTINCT y) FROM ysteps), 6) AS share FROM ysteps GROUP BY 1",
)
def _(s, d):
    """``anchor_frequency`` over every year of the data."""
    b, i, st = _bars(s, d), _index(s, d), derive.stocks(s, d)
    return r(_anchor_frequency(b, i, st, _years(i)).withColumn("years", F.array_join(F.col("years").cast("array<string>"), ",")))


@query(
    "cross_year_all",
    with_(
        LINE,
        BARS,
        YEARLY,
        """pairs AS (SELECT from_year, to_year FROM (SELECT y AS from_year, lead(y) OVER (ORDER BY y) AS to_year FROM (SELECT DISTINCT year(bar_date) AS y FROM idx)) WHERE to_year IS NOT NULL
), held AS (
  SELECT from_year, to_year, chosen, i, CAST(max(p) AS DOUBLE) AS c FROM pairs, (SELECT unnest(['stale', 'direct']) AS chosen)
    JOIN ysteps a ON a.y = CASE chosen WHEN 'stale' THEN from_year ELSE to_year END JOIN ysim s ON s.y = to_year AND s.j = a.ticker GROUP BY 1, 2, 3, 4
), means AS (
  SELECT from_year, to_year, coalesce(sum(c) FILTER (chosen = 'stale'), 0) / any_value(n) AS stale, coalesce(sum(c) FILTER (chosen = 'direct'), 0) / any_value(n) AS direct
  FROM held JOIN (SELECT y, count(DISTINCT i) AS n FROM ysim GROUP BY 1) k ON k.y = to_year GROUP BY 1, 2
)""",
    )
    + "SELECT CAST(from_year AS INT) AS from_year, CAST(to_year AS INT) AS to_year, round(stale, 6) AS stale, round(direct, 6) AS direct, round(stale / direct, 6) AS ratio FROM means",
)
def _(s, d):
    """``cross_year`` over every pair of consecutive years of the data."""
    b, i, st = _bars(s, d), _index(s, d), derive.stocks(s, d)
    return r(_cross_years(b, i, st, _years(i)))


def _measure_sql(unit: str) -> str:
    v = "SELECT x.i, x.j, CAST(CASE WHEN x.i = x.j THEN 1 ELSE least(1, greatest(0, x.g / sqrt(a.g * b.g))) END AS DECIMAL(20,18)) AS p FROM gram x JOIN gram a ON a.i = x.i AND a.j = x.i JOIN gram b ON b.i = x.j AND b.j = x.j"
    u = "SELECT avg(x.g / sqrt(a.g * b.g)) AS mean_u FROM gram x JOIN gram a ON a.i = x.i AND a.j = x.i JOIN gram b ON b.i = x.j AND b.j = x.j WHERE x.i < x.j"
    cover = "(SELECT i, max(p) AS c FROM {sim} WHERE j IN (SELECT ticker FROM {steps}) GROUP BY i)"
    rank = "rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2"
    return (
        f"WITH sa AS MATERIALIZED ({with_(*MODEL, PAIRS, unit=unit)} SELECT i, j, CAST(p AS DECIMAL(20,18)) AS p FROM sim), sb AS MATERIALIZED ({with_(*MODEL, DCOR, unit=unit)} {v}), su AS ({with_(*MODEL, DCOR_U, unit=unit)} {u}), "
        f"ta AS MATERIALIZED {_steps_sql('sa')}, tb AS MATERIALIZED {_steps_sql('sb')}, "
        f"rk AS (SELECT {rank.format(c='x.c')} AS ra, {rank.format(c='y.c')} AS rb FROM {cover.format(sim='sa', steps='ta')} x JOIN {cover.format(sim='sb', steps='tb')} y USING (i)) "
        "SELECT round((SELECT count(*) FROM ta JOIN tb USING (ticker)) / (SELECT count(*) FROM (SELECT ticker FROM ta UNION SELECT ticker FROM tb)), 6) AS jaccard, "
        f"round({_MEANS.format(sim='sa', steps='ta')}, 6) AS mean_f_a, round({_MEANS.format(sim='sb', steps='tb')}, 6) AS mean_f_b, "
        "(SELECT round(corr(ra, rb), 6) FROM rk) AS spearman, (SELECT round(mean_u, 6) FROM su) AS mean_u"
    )


@query("measure_comparison", _measure_sql("quarter"))
def _(s, d):
    panel = _panel(s, d, "quarter")[0]
    e = model.residuals(panel, model.fit(panel))
    return r(model.compare_measures(model.rho2(e), model.dcor2(e, block=8), model.dcor2(e, unbiased=True, block=8), 3))


@query("measure_comparison_weekly", _measure_sql("week"))
def _(s, d):
    """Over the sessions that the model's other queries take."""
    e = _resid(s, d)
    return r(model.compare_measures(model.rho2(e), model.dcor2(e), model.dcor2(e, unbiased=True), 3))


@query(
    "zero_diagonal",
    with_(*MODEL, PAIRS, "sz AS (SELECT i, j, CASE WHEN i = j THEN 0 ELSE p END AS p FROM sim)")
    + f""", ta AS MATERIALIZED {_steps_sql("sim")}, tz AS MATERIALIZED {_steps_sql("sz")},
curves AS (SELECT a.step, a.ticker, z.ticker AS ticker_zero, sum(a.gain) OVER (ORDER BY a.step) AS f, sum(z.gain) OVER (ORDER BY a.step) AS f_zero FROM ta a JOIN tz z USING (step))
SELECT step, ticker, ticker_zero, round(CAST(f AS DOUBLE), 8) AS f, round(CAST(f_zero AS DOUBLE), 8) AS f_zero, coalesce(step >= (SELECT min(step) FROM curves WHERE ticker <> ticker_zero), false) AS diverged FROM curves""",
)
def _(s, d):
    return r(model.zero_diagonal(model.rho2(_resid(s, d)), 3), 8).drop("gain", "gain_zero")


@query(
    "flag_sensitivity",
    with_(*MODEL, PAIRS)
    + f""", ok AS (SELECT e.* FROM resid e JOIN rets r USING (ticker, bar_date) WHERE NOT abs(close / prev_close - 1) >= 0.5 - 0.003),
mp AS (SELECT i, j, count(*) AS t, least(1, coalesce(pow(covar_pop(a, b), 2) / nullif(var_pop(a) * var_pop(b), 0), 0)) AS p FROM (SELECT x.ticker AS i, y.ticker AS j, x.e AS a, y.e AS b FROM ok x JOIN ok y USING (bar_date) WHERE x.ticker <> y.ticker) GROUP BY 1, 2 HAVING count(*) >= 3),
sm AS (SELECT s.i, s.j, CASE WHEN s.i = s.j THEN 1 ELSE coalesce(m.p, 0) END AS p FROM sim s LEFT JOIN mp m ON m.i = s.i AND m.j = s.j),
ta AS MATERIALIZED {_steps_sql("sim")}, tb AS MATERIALIZED {_steps_sql("sm")}, n AS (SELECT count(*) AS n FROM fitted)
SELECT round((SELECT count(*) FROM ta JOIN tb USING (ticker)) / (SELECT count(*) FROM (SELECT ticker FROM ta UNION SELECT ticker FROM tb)), 6) AS jaccard,
round((SELECT CAST(sum(gain) AS DOUBLE) - 3 FROM ta) / (n - 3), 6) AS before, round((SELECT CAST(sum(gain) AS DOUBLE) - 3 FROM tb) / (n - 3), 6) AS after, (SELECT min(t) FROM mp) AS min_t FROM n""",
)
def _(s, d):
    flags = model.returns(_bars(s, d), band=0.5).select("ticker", "bar_date", F.col("at_limit").alias("flagged"))
    e = _resid(s, d)
    return r(model.flag_sensitivity(model.rho2(e), model.masked_rho2(e, flags), 3))


# ---- indicators --------------------------------------------------------------------------------

_W = "(PARTITION BY ticker ORDER BY bar_date ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"


def _full(n: int, value: str, of: str = "close") -> str:
    w = _W.replace("{n}", str(n - 1))
    return f"CASE WHEN count({of}) OVER {w} = {n} THEN {value.replace('@', 'OVER ' + w)} END"


WINDOWED = f"""pre AS (
  SELECT *, lag(close) OVER o AS prev, ln(close / lag(close) OVER o) AS lr FROM bars WINDOW o AS (PARTITION BY ticker ORDER BY bar_date)
), w1 AS (
  SELECT *, {_full(20, 'avg(close) @')} AS sma_20, {_full(50, 'avg(close) @')} AS sma_50, {_full(200, 'avg(close) @')} AS sma_200, {_full(20, 'avg(volume) @', 'volume')} AS volume_sma_20,
    {_full(252, 'max(close) @')} AS high_252d, {_full(252, 'min(close) @')} AS low_252d, {_full(20, 'stddev_pop(close) @')} AS sd,
    {_full(20, 'stddev_samp(lr) @', 'lr')} * sqrt(252) AS realized_vol_20d, {_full(60, 'stddev_samp(lr) @', 'lr')} * sqrt(252) AS realized_vol_60d,
    {_full(14, 'max(high) @', 'high')} AS hh, {_full(14, 'min(low) @', 'low')} AS ll,
    CASE WHEN prev IS NOT NULL THEN greatest(high - low, abs(high - prev), abs(low - prev)) END AS true_range, close * volume AS turnover_value,
    {', '.join(f'close / lag(close, {n}) OVER (PARTITION BY ticker ORDER BY bar_date) - 1 AS ret_{n}d' for n in (1, 5, 20, 60, 252))},
    CASE WHEN prev IS NOT NULL AND sum(CASE WHEN prev IS NOT NULL AND volume IS NULL THEN 1 ELSE 0 END) OVER r = 0 THEN sum(sign(close - prev) * volume) OVER r END AS obv
  FROM pre WINDOW r AS (PARTITION BY ticker ORDER BY bar_date ROWS UNBOUNDED PRECEDING)
), w2 AS (
  SELECT *, CASE WHEN hh = ll THEN 50 ELSE 100 * (close - ll) / (hh - ll) END AS stoch_k_14, sma_20 AS bb_mid_20, sma_20 + 2 * sd AS bb_upper_20, sma_20 - 2 * sd AS bb_lower_20, 4 * sd / sma_20 AS bb_width_20,
    close / sma_200 - 1 AS dist_from_sma_200_pct, close / high_252d - 1 AS drawdown_from_252d_high FROM w1
), ye AS (
  SELECT ticker, year(bar_date) AS y, max_by(close, bar_date) AS last_close FROM bars GROUP BY 1, 2
), yb AS (
  SELECT ticker, y, lag(last_close) OVER (PARTITION BY ticker ORDER BY y) AS base FROM ye
), win AS (
  SELECT w2.*, {_full(3, 'avg(stoch_k_14) @', 'stoch_k_14')} AS stoch_d_14, close / base - 1 AS ret_ytd FROM w2 LEFT JOIN yb ON yb.ticker = w2.ticker AND yb.y = year(bar_date)
)""".replace("OVER (PARTITION BY ticker ORDER BY bar_date ROWS BETWEEN 2 PRECEDING", "OVER (PARTITION BY w2.ticker ORDER BY bar_date ROWS BETWEEN 2 PRECEDING")
RECURSE = """num AS (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY bar_date) AS rn, greatest(close - prev, 0) AS up, greatest(prev - close, 0) AS down FROM win
), seeds AS (
  SELECT ticker, avg(close) FILTER (rn <= 12) AS e12, avg(close) FILTER (rn <= 26) AS e26, avg(up) FILTER (rn BETWEEN 2 AND 15) AS gain, avg(down) FILTER (rn BETWEEN 2 AND 15) AS loss, avg(true_range) FILTER (rn BETWEEN 2 AND 15) AS tr FROM num GROUP BY 1
), rec(ticker, rn, ema_12, ema_26, gain, loss, atr) AS (
  SELECT ticker, 1::BIGINT, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE FROM seeds
  UNION ALL
  SELECT n.ticker, n.rn, CASE WHEN n.rn = 12 THEN s.e12 WHEN n.rn > 12 THEN p.ema_12 + (n.close - p.ema_12) * 2 / 13 END,
    CASE WHEN n.rn = 26 THEN s.e26 WHEN n.rn > 26 THEN p.ema_26 + (n.close - p.ema_26) * 2 / 27 END,
    CASE WHEN n.rn = 15 THEN s.gain WHEN n.rn > 15 THEN (p.gain * 13 + n.up) / 14 END, CASE WHEN n.rn = 15 THEN s.loss WHEN n.rn > 15 THEN (p.loss * 13 + n.down) / 14 END,
    CASE WHEN n.rn = 15 THEN s.tr WHEN n.rn > 15 THEN (p.atr * 13 + n.true_range) / 14 END
  FROM rec p JOIN num n ON n.ticker = p.ticker AND n.rn = p.rn + 1 JOIN seeds s ON s.ticker = p.ticker
), msig(ticker, rn, sig) AS (
  SELECT ticker, 34::BIGINT, avg(ema_12 - ema_26) FILTER (rn BETWEEN 26 AND 34) FROM rec GROUP BY 1 HAVING max(rn) >= 34
  UNION ALL
  SELECT r.ticker, r.rn, p.sig + (r.ema_12 - r.ema_26 - p.sig) * 2 / 10 FROM msig p JOIN rec r ON r.ticker = p.ticker AND r.rn = p.rn + 1
), ind AS (
  SELECT num.*, ema_12, ema_26, ema_12 - ema_26 AS macd, sig AS macd_signal, ema_12 - ema_26 - sig AS macd_hist,
    CASE WHEN gain IS NULL THEN NULL WHEN loss = 0 THEN 100 ELSE 100 - 100 / (1 + gain / loss) END AS rsi_14, atr AS atr_14
  FROM num JOIN rec USING (ticker, rn) LEFT JOIN msig USING (ticker, rn)
)"""
#: obv and turnover are sums of large numbers: fewer digits
_DIGITS = {c: 4 if c in ("obv", "volume_sma_20") else 8 if c == "turnover_value" else 6 for c in ind.COLUMNS}


@query("indicators", with_(LINE, BARS, WINDOWED, RECURSE) + "SELECT ticker, source, bar_date, " + ", ".join(f"round({c}, {n}) AS {c}" for c, n in _DIGITS.items()) + " FROM ind")
def _(s, d):
    """Computed anew from the stored bars."""
    return ind.indicators(_bars(s, d)).select("ticker", "source", "bar_date", *(F.round(c, n).alias(c) for c, n in _DIGITS.items()))


@query("indicator_nulls", with_(LINE, BARS, WINDOWED, RECURSE) + "SELECT " + ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}" for c in ind.COLUMNS) + " FROM ind")
def _(s, d):
    return ind.null_counts(_ind(s, d))


_FIRSTS = ", firsts AS (SELECT ticker, source, " + ", ".join(f"min(rn - 1) FILTER ({c} IS NOT NULL) AS {c}" for c in ind.WARM_UP) + " FROM ind GROUP BY 1, 2) "


@query(
    "warm_up_audit",
    with_(LINE, BARS, WINDOWED, RECURSE)
    + _FIRSTS
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST(min({c}) AS INT) AS first_row, {n} AS expected, count(*) FILTER ({c} < {n}) AS n_early FROM firsts" for c, n in ind.WARM_UP.items()),
)
def _(s, d):
    return ind.warm_up_audit(_ind(s, d))


@query("long_series_ema", with_(LINE, BARS, WINDOWED, RECURSE) + "SELECT ticker, source, bar_date, round(ema_12, 6) AS ema FROM ind WHERE ema_12 IS NOT NULL")
def _(s, d):
    return r(ind.long_ema(_bars(s, d).select("ticker", "source", "bar_date", "close"), 12, block=50))


@query("long_series_atr", with_(LINE, BARS, WINDOWED, RECURSE) + "SELECT ticker, source, bar_date, round(atr_14, 6) AS atr FROM ind WHERE atr_14 IS NOT NULL")
def _(s, d):
    return r(ind.long_atr(_bars(s, d), block=50).withColumnRenamed("ema", "atr"))


@query("long_series_rsi", with_(LINE, BARS, WINDOWED, RECURSE) + "SELECT ticker, source, bar_date, round(rsi_14, 6) AS rsi FROM ind WHERE rsi_14 IS NOT NULL")
def _(s, d):
    return r(ind.long_rsi(_bars(s, d), block=50))


@query("long_series_macd", with_(LINE, BARS, WINDOWED, RECURSE) + "SELECT ticker, source, bar_date, round(macd, 6) AS macd, round(macd_signal, 6) AS macd_signal, round(macd_hist, 6) AS macd_hist FROM ind WHERE macd IS NOT NULL")
def _(s, d):
    return r(ind.long_macd(_bars(s, d), block=50))


@query("long_series_obv", with_(LINE, BARS, WINDOWED, RECURSE) + "SELECT ticker, source, bar_date, round(obv, 4) AS obv FROM ind")
def _(s, d):
    return r(ind.long_obv(_bars(s, d), block=50), 4)


# ---- board -------------------------------------------------------------------------------------

NEWEST = "newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY bar_date DESC) AS nn FROM ind) WHERE nn = 1), day AS (SELECT max(bar_date) AS session_date FROM bars)"
BOARD = (LINE, BARS, STOCKS, WINDOWED, RECURSE, NEWEST)


@query("market_overview", with_(*BOARD) + """, h AS (SELECT bar_date, close, close / lag(close) OVER (ORDER BY bar_date) - 1 AS sr FROM idx)
SELECT session_date, count(i.ticker) AS n_tickers, count(ret_1d) AS n_with_return, round(coalesce(sum(turnover_value), 0), 4) AS turnover, count(*) FILTER (ret_1d > 0) AS advancers, count(*) FILTER (ret_1d < 0) AS decliners,
  count(*) FILTER (ret_1d = 0) AS unchanged, coalesce(sum(volume), 0) AS volume, round(max(h.close), 6) AS index_close, round(max(sr), 6) AS index_return FROM day LEFT JOIN ind i ON i.bar_date = session_date LEFT JOIN h ON h.bar_date = session_date GROUP BY 1""")
def _(s, d):
    o = board.overview(_bars(s, d), _ind(s, d), _index(s, d))
    return o.withColumns({"turnover": F.round("turnover", 4), "index_close": F.round("index_close", 6), "index_return": F.round("index_return", 6)})


@query("market_sectors", with_(*BOARD) + "SELECT sector, coalesce(sector, 'other') AS label, count(*) AS n, count(ret_1d) AS n_with_return, round(avg(ret_1d), 6) AS mean_return, round(coalesce(sum(turnover_value), 0), 4) AS turnover, coalesce(sum(volume), 0) AS volume FROM ind JOIN day ON bar_date = session_date LEFT JOIN stocks USING (ticker) GROUP BY 1")
def _(s, d):
    o = board.sectors(_bars(s, d), _ind(s, d), derive.stocks(s, d))
    return o.withColumns({"mean_return": F.round("mean_return", 6), "turnover": F.round("turnover", 4)})


def _base(s: SparkSession, d: str) -> DataFrame:
    return board.movers_base(_bars(s, d), _ind(s, d), derive.stocks(s, d))


for _h, _col in board.HORIZONS.items():

    @query(f"movers_up_{_h}", with_(*BOARD) + f"SELECT n.ticker, sector, round({_col}, 6) AS move, round(close, 6) AS close, n.bar_date < session_date AS stale FROM newest n LEFT JOIN stocks USING (ticker), day WHERE {_col} IS NOT NULL ORDER BY {_col} DESC, n.ticker LIMIT 10")
    def _(s, d, h=_h, c=_col):
        return r(board.movers(_base(s, d), h).select("ticker", "sector", F.col(c).alias("move"), "close", "stale"))


@query("movers_down_1m", with_(*BOARD) + "SELECT ticker, round(ret_20d, 6) AS move FROM newest WHERE ret_20d IS NOT NULL ORDER BY ret_20d, ticker LIMIT 5")
def _(s, d):
    return r(board.movers(_base(s, d), "1m", "down", 5).select("ticker", F.col("ret_20d").alias("move")))


@query("liquidity", with_(*BOARD) + "SELECT ticker, round(turnover_value, 4) AS turnover_value FROM newest ORDER BY newest.turnover_value DESC NULLS LAST, ticker LIMIT 10")
def _(s, d):
    return board.liquidity(_base(s, d)).select("ticker", F.round("turnover_value", 4).alias("turnover_value"))


@query("ticker_output", with_(*BOARD) + "SELECT ticker, strftime(bar_date, '%Y-%m-%d') AS bar_date, round_even(close, 2) AS close, round_even(ret_1d, 6) AS ret_1d, round_even(rsi_14, 2) AS rsi_14, CAST(volume AS BIGINT) AS volume, round(turnover_value / 1000, 6) AS millions, round(turnover_value / 1000000, 6) AS billions FROM newest")
def _(s, d):
    """The newest row of each ticker as it is given out; turnover counted in thousands."""
    base = _base(s, d)
    units = base.select("ticker", F.round(board.in_millions(F.col("turnover_value")), 6).alias("millions"), F.round(board.in_billions(F.col("turnover_value")), 6).alias("billions"))
    return board.iso(board.rounded(base.select("ticker", "bar_date", "close", "ret_1d", "rsi_14", "volume"))).join(units, "ticker")


HIST = "hist AS (SELECT bar_date, close, close / lag(close) OVER (ORDER BY bar_date) - 1 AS simple_return FROM idx)"


def _history(s: SparkSession, d: str) -> DataFrame:
    return board.index_history(_index(s, d)).select("bar_date", "close", "simple_return")


@query("index_history", with_(LINE, BARS, HIST) + "SELECT bar_date, round(close, 6) AS close, round(simple_return, 6) AS simple_return FROM hist")
def _(s, d):
    return r(_history(s, d))


@query("index_range_3m", with_(LINE, BARS, HIST) + "SELECT bar_date, round(close, 6) AS close FROM hist ORDER BY bar_date DESC LIMIT 60")
def _(s, d):
    return r(board.index_range(_history(s, d), "3m").select("bar_date", "close"))


for _span in ("1m", "6m", "1y"):

    @query(f"index_range_{_span}", with_(LINE, BARS, HIST) + f"SELECT bar_date, round(close, 6) AS close FROM hist ORDER BY bar_date DESC LIMIT {board.RANGES[_span]}")
    def _(s, d, span=_span):
        return r(board.index_range(_history(s, d), span).select("bar_date", "close"))


@query("index_range_all", with_(LINE, BARS, HIST) + "SELECT bar_date, round(close, 6) AS close FROM hist")
def _(s, d):
    return r(board.index_range(_history(s, d), "all").select("bar_date", "close"))


@query("index_range_ytd", with_(LINE, BARS, HIST) + "SELECT bar_date, round(close, 6) AS close FROM hist WHERE bar_date >= date_trunc('year', (SELECT max(bar_date) FROM hist))")
def _(s, d):
    return r(board.index_range(_history(s, d), "ytd").select("bar_date", "close"))


@query("range_summary", with_(LINE, BARS) + "SELECT round(min_by(close, bar_date), 6) AS first, round(max_by(close, bar_date), 6) AS last, round(max(close), 6) AS high, round(min(close), 6) AS low, round(max_by(close, bar_date) - min_by(close, bar_date), 6) AS change, round(max_by(close, bar_date) / min_by(close, bar_date) - 1, 6) AS range_return FROM idx")
def _(s, d):
    return r(board.range_summary(_history(s, d)))


@query("ticker_detail", with_(*BOARD, *FULL[2:3], PANEL, FIT, PAIRS, GREEDY) + "SELECT n.ticker, sector, n.bar_date, round(close, 6) AS close, round(rsi_14, 6) AS rsi_14, anchor, round(CAST(c AS DOUBLE), 8) AS c FROM newest n LEFT JOIN stocks USING (ticker) LEFT JOIN assigned USING (ticker)")
def _(s, d):
    out = board.ticker_detail(_bars(s, d), _ind(s, d), derive.stocks(s, d), _run(s, d)["assigned"])
    return out.select("ticker", "sector", "bar_date", F.round("close", 6).alias("close"), F.round("rsi_14", 6).alias("rsi_14"), "anchor", F.round(F.col("c").cast("double"), 8).alias("c"))


@query("group_detail", with_(*BOARD, *FULL[2:3], PANEL, FIT, PAIRS, GREEDY) + "SELECT a.ticker, anchor, round(CAST(c AS DOUBLE), 8) AS c, sector, round(ret_20d, 6) AS ret_20d FROM assigned a LEFT JOIN newest n USING (ticker) LEFT JOIN stocks USING (ticker)")
def _(s, d):
    out = board.group_detail(_run(s, d)["assigned"], _base(s, d))
    return out.select("ticker", "anchor", F.round(F.col("c").cast("double"), 8).alias("c"), "sector", F.round("ret_20d", 6).alias("ret_20d"))


@query("ticker_history", with_(*BOARD) + "SELECT bar_date, round(close, 6) AS close, round(sma_20, 6) AS sma_20 FROM ind WHERE ticker = 'Brand#11' ORDER BY bar_date DESC LIMIT 252")
def _(s, d):
    return r(board.ticker_history(_bars(s, d), _ind(s, d).drop("close"), "Brand#11").select("bar_date", "close", "sma_20"))


_RULE_INPUTS = sorted({i for _, inputs, _ in RULES for i in inputs})


@query("narrative", with_(*BOARD) + "SELECT ticker, " + " + ".join("CASE WHEN " + " AND ".join(f"{i} IS NOT NULL" for i in inputs) + " THEN 1 ELSE 0 END" for _, inputs, _ in RULES) + " AS n_statements, 13 AS n_total FROM newest")
def _(s, d):
    out = narrative(board.rounded(_base(s, d)))
    return out.select("ticker", "n_statements", (F.col("n_statements") + F.col("n_skipped")).alias("n_total"))


def _narrative_sql() -> str:
    """The statements over the rounded newest rows."""
    ratios = set(board.RATIOS)
    inputs = ", ".join(f"CAST({c} AS BIGINT) AS volume" if c == "volume" else f"round_even({c}, {6 if c in ratios else 2}) AS {c}" for c in _RULE_INPUTS)
    known = {code: " AND ".join(f"{i} IS NOT NULL" for i in inputs_) for code, inputs_, _ in RULES}
    said = ", ".join(f"CASE WHEN {known[code]} THEN concat('{code}: ', {text}) END" for code, _, text in RULES)
    left = ", ".join(f"CASE WHEN NOT ({known[code]}) THEN concat('{code}: ', concat_ws('+', " + ", ".join(f"CASE WHEN {i} IS NULL THEN '{i}' END" for i in inputs_) + ")) END" for code, inputs_, _ in RULES)
    n = " + ".join(f"CASE WHEN {known[code]} THEN 1 ELSE 0 END" for code, *_ in RULES)
    return with_(*BOARD) + f", rounded AS (SELECT ticker, {inputs} FROM newest) SELECT ticker, concat_ws('; ', {said}) AS statements, concat_ws('; ', {left}) AS skipped, {n} AS n_statements, 13 - ({n}) AS n_skipped FROM rounded"


@query("narrative_text", _narrative_sql())
def _(s, d):
    return narrative(board.rounded(_base(s, d)))


ROLLING = """, pr AS (SELECT a.ticker, b.ticker AS anchor, bar_date, a.e AS ea, b.e AS eb FROM resid a JOIN resid b USING (bar_date) WHERE b.ticker IN (SELECT ticker FROM steps)),
ro AS (SELECT ticker, anchor, bar_date, count(*) OVER w AS k, covar_pop(ea, eb) OVER w AS c, var_pop(ea) OVER w AS va, var_pop(eb) OVER w AS vb FROM pr WINDOW w AS (PARTITION BY ticker, anchor ORDER BY bar_date ROWS BETWEEN 119 PRECEDING AND CURRENT ROW)),
rolled AS (SELECT ticker, anchor, bar_date, least(1, c * c / (va * vb)) AS rho2 FROM ro WHERE k = 120)
"""


@query("rolling_rho2", with_(*FULL) + ROLLING + "SELECT ticker, anchor, bar_date, round(rho2, 6) AS rho2 FROM rolled")
def _(s, d):
    run = _run(s, d)
    return r(board.rolling_rho2(model.residuals(run["panel"], run["params"]), run["steps"]))


@query("beta_drift", with_(*MODEL) + ", ro AS (SELECT ticker, bar_date, count(*) OVER w AS k, covar_pop(x, f) OVER w / var_pop(f) OVER w AS b FROM panel WINDOW w AS (PARTITION BY ticker ORDER BY bar_date ROWS BETWEEN 119 PRECEDING AND CURRENT ROW)) SELECT ticker, bar_date, round(b - beta, 6) AS drift FROM ro JOIN fitted USING (ticker) WHERE k = 120")
def _(s, d):
    panel = _panel(s, d)[0]
    return r(board.beta_drift(panel, model.fit(panel)))


@query(
    "coverage_drift",
    with_(*FULL)
    + ROLLING
    + """, best_now AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker, bar_date ORDER BY rho2 DESC, anchor) AS nn FROM rolled) WHERE nn = 1)
SELECT b.bar_date, count(*) FILTER (b.anchor <> a.anchor) AS n_challenged, count(*) FILTER (rho2 < 0.1) AS n_under, round(avg(rho2), 6) AS mean_c FROM best_now b JOIN assigned a USING (ticker) GROUP BY 1""",
)
def _(s, d):
    run = _run(s, d)
    rolling = board.rolling_rho2(model.residuals(run["panel"], run["params"]), run["steps"])
    return r(board.coverage_drift(rolling, run["assigned"], 0.1))


@query("serving_run", with_(LINE, BARS) + """, runs AS (SELECT 'run-' || y AS run_id, make_date(y, 1, 1) AS effective FROM (SELECT DISTINCT CAST(year(bar_date) AS INT) AS y FROM idx)), nb AS (SELECT bar_date, row_number() OVER (ORDER BY bar_date) AS seq FROM idx),
b AS (SELECT run_id, min(seq) + 4 AS s0 FROM runs JOIN nb ON bar_date >= effective GROUP BY 1) SELECT bar_date, (SELECT max_by(run_id, s0) FROM b WHERE s0 <= seq) AS run_id FROM nb""")
def _(s, d):
    i = _index(s, d)
    runs = i.select(F.year("bar_date").alias("y")).distinct().select(F.concat(F.lit("run-"), "y").alias("run_id"), F.make_date("y", F.lit(1), F.lit(1)).alias("effective"))
    return board.serving_run(i.select("bar_date"), runs, 4)


# ---- streams -----------------------------------------------------------------------------------


@query("event_bars_batch", "SELECT event_type, CAST(ts AS DATE) AS bar_date, round(first(value ORDER BY ts, event_id), 6) AS open, round(last(value ORDER BY ts, event_id), 6) AS close, round(sum(value), 4) AS volume, count(*) AS n FROM events GROUP BY 1, 2")
def _(s, d):
    e = derive.table(s, d, "events")
    b = derive.ohlcv(e.withColumn("bar_date", F.to_date("ts")), ["event_type", "bar_date"], "value", F.col("value"), ("ts", "event_id"))
    n = e.groupBy("event_type", F.to_date("ts").alias("bar_date")).agg(F.count("*").alias("n"))
    return b.join(n, ["event_type", "bar_date"]).select("event_type", "bar_date", F.round("open", 6).alias("open"), F.round("close", 6).alias("close"), F.round("volume", 4).alias("volume"), "n")


@query(
    "event_bars_stream",
    # a window is given out once the watermark, a day behind the newest event, has passed its end
    """SELECT event_type, CAST(ts AS DATE) AS bar_date, round(first(value ORDER BY ts, event_id), 4) AS open, round(max(value), 4) AS high, round(min(value), 4) AS low,
  round(last(value ORDER BY ts, event_id), 4) AS close, round(sum(value), 4) AS volume, count(*) AS n
FROM events WHERE CAST(ts AS DATE) + INTERVAL 2 DAY <= (SELECT max(ts) FROM events) GROUP BY 1, 2""",
)
def _(s, d):
    return r(stream.run_once(stream.event_bars(stream.read_events(s, f"{d}/events.parquet*"))), 4)


@query("distinct_events_stream", "SELECT event_id, user_id, round(value, 6) AS value FROM events")
def _(s, d):
    return r(stream.run_once(stream.distinct_events(stream.read_events(s, f"{d}/events.parquet*"), ["event_id"], "60 days").select("event_id", "user_id", "value")))


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which representative stands for each ticker, over quarterly sessions."""
    return assignment(spark, sf_dir, "quarter")

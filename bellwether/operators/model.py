"""Returns, aligned panel, one-factor fit, residual similarity and greedy selection.

Everything stays long: (ticker, bar_date, value) and (i, j, p). Similarities are decimals, so gains add
up the same in any order and ties go to the smaller ticker.
"""

from __future__ import annotations

from decimal import Decimal, localcontext

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.scratch import discard, materialize
from . import gram
from .clean import usable
from .cover import exact_cover  # noqa: F401
from .gram import permutation_null, spectra, spectrum  # noqa: F401  (named here before they had a module)

P_TYPE = "decimal(20,18)"


def returns(bars: DataFrame, band: float = 0.07, tolerance: float = 0.003, key: str = "ticker") -> DataFrame:
    """Log returns between usable closes, with flags that exclude nothing."""
    w = W.partitionBy(key, "source").orderBy("bar_date")
    rows = bars.where(usable("close")).withColumn("prev_close", F.lag("close").over(w)).where("prev_close is not null")
    rows = rows.withColumn("x", F.log(F.col("close") / F.col("prev_close"))).withColumn("at_limit", F.abs(F.col("close") / F.col("prev_close") - 1) >= band - tolerance)
    return rows.withColumn("zero_volume", F.coalesce(F.col("volume") == 0, F.lit(False))) if "volume" in bars.columns else rows


def index_returns(index: DataFrame) -> DataFrame:
    """The factor by session (M2). One index is one small series."""
    return returns(index.where(usable("close")), key="index_symbol").select("bar_date", F.col("x").alias("f"), F.col("close").alias("index_close"))


def align(rets: DataFrame, index: DataFrame, universe: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The panel of tickers with a return on every index session, and a row by requested ticker with why not (M3)."""
    joined = rets.join(F.broadcast(universe.select("ticker")), "ticker").join(index.select("bar_date", "f"), "bar_date")
    sessions = index.agg(F.countDistinct("bar_date").alias("n_sessions"))
    have = joined.groupBy("ticker").agg(F.countDistinct("bar_date").alias("n"))
    report = universe.select("ticker").distinct().join(have, "ticker", "left").join(F.broadcast(sessions)).select(
        "ticker", F.coalesce("n", F.lit(0)).alias("n"), "n_sessions", F.round(F.try_divide(F.coalesce("n", F.lit(0)), F.col("n_sessions")), 4).alias("coverage"),
        F.when(F.coalesce("n", F.lit(0)) == 0, "no_overlap").when(F.col("n") < F.col("n_sessions"), "incomplete").alias("dropped"),
    )
    panel = joined.join(report.where("dropped is null").select("ticker"), "ticker", "left_semi").select("ticker", "bar_date", "x", "f")
    return panel, report


def window_alignment(rets: DataFrame, index: DataFrame, index_bars: DataFrame, universe: DataFrame, start: str, end: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Panel, report by ticker and one summary row of a study window (M3): sessions T, tickers N, q, first and last session, prior close, losses.

    The prior close is the last index session within 45 days before the first day (J12).
    """
    inside = F.col("bar_date").between(F.to_date(F.lit(start)), F.to_date(F.lit(end)))
    panel, report = align(rets.where(inside), index.where(inside), universe)
    day = F.to_date(F.lit(start))
    prior = index_bars.where(usable("close") & (F.col("bar_date") < day) & (F.col("bar_date") >= F.date_sub(day, 45))).agg(F.max("bar_date").alias("prior_close_date"))
    sessions = index.where(inside).agg(F.countDistinct("bar_date").alias("n_index_sessions"))
    lost = report.agg(F.count_if(F.col("dropped") == "no_overlap").alias("n_no_overlap"), F.count_if(F.col("dropped") == "incomplete").alias("n_incomplete"))
    size = panel.agg(F.countDistinct("bar_date").alias("t"), F.countDistinct("ticker").alias("n"), F.min("bar_date").alias("first_session"), F.max("bar_date").alias("last_session"))
    summary = size.join(F.broadcast(prior)).join(F.broadcast(sessions)).join(F.broadcast(lost))
    q = F.when(F.col("t") > 0, F.round(F.col("n") / F.col("t"), 4)).otherwise(0.0)
    return panel, report, summary.withColumn("q", q).withColumn("n_dropped_sessions", F.when(F.col("n") > 0, F.col("n_index_sessions") - F.col("t")).otherwise(F.col("n_index_sessions")))


def missing_sessions(rets: DataFrame, index: DataFrame, universe: DataFrame) -> DataFrame:
    """Index sessions on which some requested ticker has no return, with how many."""
    grid = index.select("bar_date").distinct().join(F.broadcast(universe.select("ticker").distinct()))
    return grid.join(rets.select("ticker", "bar_date"), ["ticker", "bar_date"], "left_anti").groupBy("bar_date").agg(F.count("*").alias("n_missing"))


def assert_ready(summary: DataFrame) -> None:
    """No run without tickers, sessions or a prior close (M4)."""
    row = summary.first()
    for name, what in (("n", "tickers"), ("t", "sessions"), ("prior_close_date", "session before the window")):
        if not row[name]:
            raise ValueError(f"the window has no {what}")


def assert_full_coverage(report: DataFrame, frozen: DataFrame) -> None:
    """Every ticker of a frozen universe has to be kept (M4)."""
    lost = [r["ticker"] for r in report.where("dropped is not null").join(frozen.select("ticker"), "ticker", "left_semi").orderBy("ticker").limit(20).collect()]
    if lost:
        raise ValueError(f"dropped although the universe is frozen: {lost}")


def assert_rectangular(panel: DataFrame) -> None:
    """One finite return by ticker and session, and no cell missing (M4)."""
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf"))
    n, cells, tickers, sessions, bad = panel.agg(
        F.count("*"), F.countDistinct("ticker", "bar_date"), F.countDistinct("ticker"), F.countDistinct("bar_date"), F.count_if(~(finite("x") & finite("f")))
    ).first()
    if bad or n != cells or n != tickers * sessions:
        raise ValueError(f"{bad} values are not finite, {n} rows fill {cells} of {tickers * sessions} cells")


def fit(panel: DataFrame) -> DataFrame:
    """Alpha, beta, sigma (T-2 degrees of freedom) and R2 by ticker; a constant factor gives beta 0 (M5)."""
    m = panel.groupBy("ticker").agg(
        F.count("*").alias("t"), F.avg("x").alias("mx"), F.avg("f").alias("mf"), F.covar_pop("x", "f").alias("cxf"), F.var_pop("f").alias("vf"), F.var_pop("x").alias("vx")
    )
    m = m.withColumn("beta", F.coalesce(F.try_divide("cxf", "vf"), F.lit(0.0)))
    m = m.withColumn("ss", F.greatest(F.lit(0.0), F.col("vx") - F.col("beta") * F.col("cxf")) * F.col("t"))
    r2 = F.when((F.col("vf") > 0) & (F.col("vx") > 0), F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.try_divide(F.col("beta") * F.col("cxf"), F.col("vx"))))).otherwise(0.0)
    return m.where("t >= 3").select("ticker", "t", (F.col("mx") - F.col("beta") * F.col("mf")).alias("alpha"), "beta", F.sqrt(F.try_divide("ss", F.col("t") - 2)).alias("sigma"), r2.alias("r2"))


def residuals(panel: DataFrame, fitted: DataFrame) -> DataFrame:
    return panel.join(F.broadcast(fitted.select("ticker", "alpha", "beta")), "ticker").select("ticker", "bar_date", (F.col("x") - F.col("alpha") - F.col("beta") * F.col("f")).alias("e"))


def _mirror(p: DataFrame) -> DataFrame:
    p = p.withColumn("p", F.col("p").cast(P_TYPE))
    return p.union(p.where("i < j").select(F.col("j").alias("i"), F.col("i").alias("j"), "p"))


def rho2(e: DataFrame) -> DataFrame:
    """Squared residual correlations ``(i, j, p)``: symmetric, clipped, diagonal 1, constant columns 0 elsewhere (M7); by products of tiles."""
    mean = e.groupBy("ticker").agg(F.avg("e").alias("m"), F.sqrt(F.var_pop("e") * F.count("e")).alias("norm"))
    z = e.join(F.broadcast(mean), "ticker").select("ticker", "bar_date", F.coalesce(F.try_divide(F.col("e") - F.col("m"), F.when(F.col("norm") > 1e-15, F.col("norm"))), F.lit(0.0)).alias("z"))
    p = gram.pair_sums(gram.series(z, "z"), gram.products, ["s"]).select("i", "j", F.when(F.col("i") == F.col("j"), 1.0).otherwise(F.least(F.lit(1.0), F.col("s") * F.col("s"))).alias("p"))
    return _mirror(p)


def dcor2(e: DataFrame, unbiased: bool = False, block: int = 64, tile: int = 64) -> DataFrame:
    """Squared distance correlations ``(i, j, p)``, V-statistics, or U-statistics for diagnosis (M8, M9).

    Row means of each ticker's distance matrix come from sorted prefix sums in windows. Inner products are added up over
    blocks of rows s and pairs of tiles of tickers: a task holds ``2 * tile`` x ``block`` x T distances and the series of two tiles,
    whatever the number of tickers.
    """
    w = W.partitionBy("ticker").orderBy("e", "bar_date")
    every = W.partitionBy("ticker")
    r = F.row_number().over(w)
    rows = e.withColumn("s", F.dense_rank().over(W.partitionBy("ticker").orderBy("bar_date")) - 1).withColumn("r", r).withColumn("below", F.sum("e").over(w.rowsBetween(W.unboundedPreceding, 0))).withColumn("total", F.sum("e").over(every)).withColumn("t", F.count("*").over(every))
    rows = rows.withColumn("d", F.col("e") * (2 * F.col("r") - F.col("t")) - 2 * F.col("below") + F.col("total"))
    rows = rows.withColumn("all_d", F.sum("d").over(every))
    series = rows.groupBy("ticker").agg(F.sort_array(F.collect_list(F.struct("s", "e", "d"))).alias("v"), F.first("t").alias("t"), F.first("all_d").alias("all_d"))
    # tickers in order, one row each, dealt to tiles
    tiles = e.select("ticker").distinct().withColumn("mine", F.floor((F.row_number().over(W.orderBy("ticker")) - 1) / tile))
    blocks = rows.agg(F.coalesce(F.floor(F.max("s") / block), F.lit(0)).alias("top_part")).join(F.broadcast(tiles.agg(F.coalesce(F.max("mine"), F.lit(0)).alias("top_tile"))))
    work = series.join(F.broadcast(tiles), "ticker").join(F.broadcast(blocks)).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("top_tile")))).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("top_part"))))
    work = work.select(F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), "part", "mine", "ticker", "v", "t", "all_d")

    def gram(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ticker")
        t = int(pdf["t"].iloc[0])
        lo = int(pdf["part"].iloc[0]) * block
        flat = []
        for v, total in zip(pdf["v"], pdf["all_d"], strict=True):
            x, d = np.array([q["e"] for q in v]), np.array([q["d"] for q in v])
            far = np.abs(x[lo : lo + block, None] - x[None, :])
            if unbiased:
                far = far - d[lo : lo + block, None] / (t - 2) - d[None, :] / (t - 2) + total / ((t - 1) * (t - 2))
                far[np.arange(len(far)), lo + np.arange(len(far))] = 0
            else:
                far = far - d[lo : lo + block, None] / t - d[None, :] / t + total / (t * t)
            flat.append(far.ravel())
        m, names, mine = np.stack(flat), pdf["ticker"].to_numpy(), pdf["mine"].to_numpy()
        first, second = mine == pdf["a"].iloc[0], mine == pdf["b"].iloc[0]
        g = m[first] @ m[second].T
        i, j = np.triu_indices(len(g)) if pdf["a"].iloc[0] == pdf["b"].iloc[0] else (x.ravel() for x in np.indices(g.shape))
        return pd.DataFrame({"i": names[first][i], "j": names[second][j], "s": g[i, j]})

    g = work.groupBy("a", "b", "part").applyInPandas(gram, "i string, j string, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    own = g.where("i = j").select(F.col("i").alias("k"), F.col("s").alias("own"))
    both = g.join(F.broadcast(own.toDF("i", "own_i")), "i").join(F.broadcast(own.toDF("j", "own_j")), "j")
    ratio = F.coalesce(F.try_divide("s", F.sqrt(F.col("own_i") * F.col("own_j"))), F.lit(0.0))
    ratio = ratio if unbiased else F.least(F.lit(1.0), F.greatest(F.lit(0.0), ratio))
    return _mirror(both.select("i", "j", F.when(F.col("i") == F.col("j"), 1.0).otherwise(ratio).alias("p")))


MEASURES = {"rho2": rho2, "dcor2": dcor2}


def similarity(e: DataFrame, measure: str) -> DataFrame:
    if measure not in MEASURES:
        raise ValueError(f"no such measure: {measure}")
    return MEASURES[measure](e)


def coverage(p: DataFrame, chosen: DataFrame) -> DataFrame:
    """F(S): the best similarity to any chosen ticker, added up (G1). ``chosen(ticker)``."""
    best = p.join(F.broadcast(chosen.select(F.col("ticker").alias("j"))), "j").groupBy("i").agg(F.max("p").alias("c"))
    return best.agg(F.coalesce(F.sum(F.col("c").cast("decimal(38,18)")), F.lit(0).cast("decimal(38,18)")).alias("f"))


LAZY = 16  # candidates that are looked at again at once


def greedy(p: DataFrame, k: int) -> DataFrame:
    """``(step, ticker, gain, f)`` of k rounds: the largest gain, the smaller ticker on ties.

    Lazy: what a ticker added in an earlier round it adds at most now, so only those whose old gain could still win are computed again, the
    most promising first, from their own columns of p (written once in the order of columns, so that a filter on them skips the rest). One number by ticker, the gains and the
    coverage so far, is kept between rounds; the coverage goes to the tasks as a broadcast of as many rows.
    """
    spark = p.sparkSession
    p = materialize(p.select("i", "j", "p").repartitionByRange("j").sortWithinPartitions("j"))
    zero = F.lit(0).cast("decimal(38,18)")
    bounds = {r["j"]: r["gain"] for r in p.groupBy("j").agg(F.sum(F.greatest(zero, F.col("p").cast("decimal(38,18)"))).alias("gain")).collect()}
    cover: dict[str, Decimal] = {}
    picks: list[tuple[int, str, Decimal, Decimal]] = []
    total = Decimal(0)
    with localcontext() as exact:
        exact.prec = 60
        for step in range(1, min(k, len(bounds)) + 1):
            # the gains of the first round are exact
            order = sorted(bounds, key=lambda j: (-bounds[j], j))
            best = order[0] if not cover else None
            seen: set[str] = set()
            while cover:
                ahead = [j for j in order if j not in seen and (best is None or (-bounds[j], j) < (-bounds[best], best))][:LAZY]
                if not ahead:
                    break
                held = F.broadcast(spark.createDataFrame(list(cover.items()), "i string, c decimal(20,18)"))
                rows = p.where(F.col("j").isin(ahead)).join(held, "i").groupBy("j").agg(F.sum(F.greatest(zero, (F.col("p") - F.col("c")).cast("decimal(38,18)"))).alias("gain"))
                bounds |= {r["j"]: r["gain"] for r in rows.collect()}
                seen |= set(ahead)
                best = min(seen, key=lambda j: (-bounds[j], j))
            gain = bounds.pop(best)
            total += gain
            picks.append((step, best, gain, total))
            if step < k:
                column = {r["i"]: r["p"] for r in p.where(F.col("j") == best).select("i", "p").collect()}
                cover = {i: max(x, cover.get(i, Decimal(0)), Decimal(0)) for i, x in column.items()}
    discard(p)
    return spark.createDataFrame(picks, "step int, ticker string, gain decimal(38,18), f decimal(38,18)")


def assign(p: DataFrame, steps: DataFrame, k: int | None = None) -> DataFrame:
    """``(ticker, anchor, c)``: the most similar chosen ticker, the smaller on ties."""
    chosen = (steps if k is None else steps.where(F.col("step") <= k)).select(F.col("ticker").alias("j"))
    s = p.join(F.broadcast(chosen), "j")
    best = s.groupBy("i").agg(F.max("p").alias("c"), F.min_by("j", F.struct(-F.col("p"), "j")).alias("anchor"))
    return best.select(F.col("i").alias("ticker"), "anchor", "c")


def under(assigned: DataFrame, taus: list[float]) -> DataFrame:
    """Tickers below each threshold, after the fact."""
    return assigned.withColumn("tau", F.explode(F.array(*map(F.lit, taus)))).where(F.col("c") < F.col("tau")).select("tau", "ticker", "c")


def groups(assigned: DataFrame) -> DataFrame:
    """Size, coverage, mean and least similarity of each anchor's group, and its share of all."""
    g = assigned.groupBy("anchor").agg(F.count("*").alias("size"), F.sum(F.col("c").cast("decimal(38,18)")).alias("f"), F.avg(F.col("c").cast("double")).alias("mean_c"), F.min("c").alias("min_c"))
    total = assigned.agg(F.count("*").alias("n"))
    return g.join(F.broadcast(total)).withColumn("share", F.col("size") / F.col("n")).drop("n")


def adjusted_coverage(f: Column, k: Column, n: Column) -> Column:
    """(F-k)/(N-k); null where N <= k or an input is missing."""
    return F.when(n > k, (f - k) / (n - k))


def train(bars: DataFrame, index: DataFrame, universe: DataFrame, k: int, k_max: int, tau: float, measure: str = "rho2") -> dict[str, DataFrame]:
    """A run: params, similarity, steps to k_max, assignment on the first k, groups, those under tau."""
    panel, report = align(returns(bars), index_returns(index), universe)
    panel = materialize(panel)
    params = fit(panel)
    p = materialize(similarity(residuals(panel, params), measure))
    steps = greedy(p, k_max)
    assigned = assign(p, steps, k)
    return {"panel": panel, "report": report, "params": params, "p": p, "steps": steps, "assigned": assigned, "groups": groups(assigned), "under": under(assigned, [tau])}


def selection(p: DataFrame, k: int, taus: list[float]) -> DataFrame:
    """Greedy, assignment and how many fall under each threshold."""
    assigned = assign(p, greedy(p, k))
    each = assigned.withColumn("tau", F.explode(F.array(*map(F.lit, taus))))
    return each.groupBy("tau").agg(F.count("*").alias("n"), F.count_if(F.col("c") < F.col("tau")).alias("n_under"), F.sum(F.col("c").cast("decimal(38,18)")).alias("f"))


def run_row(run: dict[str, DataFrame], index_bars: DataFrame, run_id: str, scope_label: str, measure: str, k: int, k_max: int, tau: float) -> DataFrame:
    """The row of a run with its scalars."""
    size = run["panel"].agg(F.countDistinct("bar_date").alias("n_sessions"), F.countDistinct("ticker").alias("n_tickers"), F.min("bar_date").alias("window_start"), F.max("bar_date").alias("window_end"))
    cover = run["assigned"].agg(F.sum(F.col("c").cast("decimal(38,18)")).cast("double").alias("coverage_f"), F.count_if(F.col("c") < tau).alias("n_under_tau"))
    closes = index_bars.where(usable("close")).select(F.col("bar_date").alias("d"))
    prior = size.join(F.broadcast(closes), (F.col("d") < F.col("window_start")) & (F.col("d") >= F.date_sub("window_start", 45)), "left").agg(F.max("d").alias("prior_close_date"))
    out = size.join(F.broadcast(cover)).join(F.broadcast(prior))
    return out.select(
        F.lit(run_id).alias("run_id"), F.lit(scope_label).alias("scope_label"), F.lit(measure).alias("measure"), "window_start", "window_end", "prior_close_date", "n_sessions", "n_tickers",
        F.round(F.col("n_tickers") / F.col("n_sessions"), 4).alias("q"), F.lit(k).alias("k"), F.lit(k_max).alias("k_max"), F.lit(tau).alias("tau"), "coverage_f", (F.col("coverage_f") / F.col("n_tickers")).alias("coverage_fbar"), "n_under_tau",
    )


def anchor_columns(p: DataFrame, steps: DataFrame) -> DataFrame:
    """The columns of the similarity that belong to chosen tickers, N x k rows."""
    return p.join(F.broadcast(steps.select(F.col("ticker").alias("j"))), "j", "left_semi")


def gain_floor(p: DataFrame, steps: DataFrame) -> DataFrame:
    """Each step's gain as what the ticker adds for itself, 1 less its coverage before, and the rest."""
    s = steps.select("step", "ticker", F.col("gain").cast("double").alias("gain"))
    earlier = s.select(F.col("step").alias("before"), F.col("ticker").alias("j"))
    pairs = s.join(F.broadcast(earlier), F.col("before") < F.col("step")).join(p, (F.col("i") == F.col("ticker")) & (p["j"] == earlier["j"]))
    held = pairs.groupBy("step").agg(F.max(F.col("p").cast("double")).alias("c"))
    out = s.join(held, "step", "left").withColumn("own", 1 - F.coalesce("c", F.lit(0.0)))
    return out.select("step", "ticker", "gain", "own", (F.col("gain") - F.col("own")).alias("rest"))


def swap_shares(swapped: DataFrame, total: DataFrame) -> DataFrame:
    """How many exchanges stay within 1 and 2 per cent of the coverage, plain and adjusted (G12). ``total(f, k, n)``."""
    rows = swapped.select(F.col("f").cast("double").alias("g")).join(F.broadcast(total.select(F.col("f").cast("double").alias("f"), "k", "n")))
    plain, adjusted = F.col("g") / F.col("f"), adjusted_coverage(F.col("g"), F.col("k"), F.col("n")) / adjusted_coverage(F.col("f"), F.col("k"), F.col("n"))
    share = lambda x, least: F.avg(F.when(x >= least, 1.0).otherwise(0.0))
    return rows.agg(F.count("*").alias("n_swaps"), share(plain, 0.99).alias("within_1"), share(plain, 0.98).alias("within_2"), share(adjusted, 0.99).alias("adjusted_1"), share(adjusted, 0.98).alias("adjusted_2"))


def noise_floor(n: Column, t: Column) -> Column:
    """The largest squared correlation to expect of noise."""
    pairs = n * (n - 1) / 2
    return F.pow(F.sqrt(2 * F.log(2 * pairs)) / F.sqrt(t - 1), 2)


def equal_weight_factor(panel: DataFrame, leave_one_out: bool = False) -> DataFrame:
    """The panel with the mean return of the session, or that of all others, as its factor."""
    w = W.partitionBy("bar_date")
    n, mean = F.count("*").over(w), F.avg("x").over(w)
    return panel.withColumn("f", F.try_divide(n * mean - F.col("x"), n - 1) if leave_one_out else mean)


def masked_rho2(e: DataFrame, flags: DataFrame) -> DataFrame:
    """Pairs over sessions on which neither side is flagged, with the count of each, 3 at least."""
    ok = e.join(flags, ["ticker", "bar_date"], "left").where(~F.coalesce(F.col("flagged"), F.lit(False)))
    mean = ok.groupBy("ticker").agg(F.avg("e").alias("m"))  # moments about a value near the mean do not cancel
    near = ok.join(F.broadcast(mean), "ticker").select("ticker", "bar_date", (F.col("e") - F.col("m")).alias("e"))
    m = gram.pair_sums(gram.series(near, "e"), gram.masked_products, ["t", "sx", "sy", "xx", "yy", "xy"]).where("i < j and t >= 3")
    over = lambda c: F.col(c) / F.col("t")
    cov, vx, vy = over("xy") - over("sx") * over("sy"), over("xx") - over("sx") * over("sx"), over("yy") - over("sy") * over("sy")
    flat = (vx <= 1e-14 * over("xx")) | (vy <= 1e-14 * over("yy"))  # a constant side, but for rounding
    p = F.when(flat, 0.0).otherwise(F.coalesce(F.least(F.lit(1.0), F.try_divide(cov * cov, vx * vy)), F.lit(0.0)))
    return m.select("i", "j", F.round("t").cast("long").alias("t"), p.alias("p"))


def full_coverage_universe(rets: DataFrame, index: DataFrame) -> DataFrame:
    """By ticker, whether it has a return on every session of every year, and the years it fails."""
    need = index.groupBy(F.year("bar_date").alias("year")).agg(F.countDistinct("bar_date").alias("need"))
    grid = rets.select("ticker").distinct().join(F.broadcast(need))
    have = rets.join(index.select("bar_date"), "bar_date", "left_semi").groupBy("ticker", F.year("bar_date").alias("year")).agg(F.countDistinct("bar_date").alias("have"))
    failed = F.when(F.coalesce("have", F.lit(0)) < F.col("need"), F.col("year"))
    return grid.join(have, ["ticker", "year"], "left").groupBy("ticker").agg(F.array_sort(F.collect_set(failed)).alias("failing_years")).withColumn("complete", F.size("failing_years") == 0)


def universe_version(tickers: DataFrame) -> DataFrame:
    """``u`` and 8 digits of the SHA-256 of the sorted set."""
    return tickers.agg(F.concat(F.lit("u"), F.substring(F.sha2(F.array_join(F.sort_array(F.collect_set("ticker")), "\n"), 256), 1, 8)).alias("version"))


def trading_calendar(index: DataFrame) -> DataFrame:
    """Sessions numbered from 0; a session is a date on which the index closed."""
    return index.where(usable("close")).select("bar_date").distinct().withColumn("session_seq", F.row_number().over(W.orderBy("bar_date")) - 1)


def with_trading_flag(days: DataFrame, calendar: DataFrame) -> DataFrame:
    """From the calendar's row if there is one, else Monday to Friday."""
    return days.join(calendar.select("bar_date", "is_trading"), "bar_date", "left").withColumn("is_trading", F.coalesce("is_trading", F.weekday("bar_date") < 5))


def swaps(p: DataFrame, steps: DataFrame) -> DataFrame:
    """``(out, into, f)``: coverage after each exchange of one chosen ticker, from best and second best."""
    chosen = steps.select(F.col("ticker").alias("j"))
    ranked = p.join(F.broadcast(chosen), "j").withColumn("r", F.row_number().over(W.partitionBy("i").orderBy(F.desc("p"), "j")))
    two = ranked.where("r <= 2").groupBy("i").agg(F.max(F.when(F.col("r") == 1, F.col("j"))).alias("b1"), F.max(F.when(F.col("r") == 1, F.col("p"))).alias("p1"), F.coalesce(F.max(F.when(F.col("r") == 2, F.col("p"))), F.lit(0).cast(P_TYPE)).alias("p2"))
    others = p.join(F.broadcast(chosen), "j", "left_anti").select("i", F.col("j").alias("into"), F.col("p").alias("q"))
    each = others.join(two, "i").join(F.broadcast(chosen.withColumnRenamed("j", "out")))
    held = F.when(F.col("b1") == F.col("out"), F.col("p2")).otherwise(F.col("p1"))
    return each.groupBy("out", "into").agg(F.sum(F.greatest("q", held).cast("decimal(38,18)")).alias("f"))


def anchor_frequency(runs: DataFrame) -> DataFrame:
    """``runs(year, ticker)``: years in which a ticker was chosen."""
    years = runs.agg(F.countDistinct("year").alias("n_years"))
    return runs.groupBy("ticker").agg(F.countDistinct("year").alias("n_selected"), F.array_sort(F.collect_set("year")).alias("years")).join(F.broadcast(years)).withColumn("share", F.col("n_selected") / F.col("n_years"))


def jaccard(a: DataFrame, b: DataFrame) -> DataFrame:
    """Of two sets of tickers (U4)."""
    both = a.select("ticker", F.lit(1).alias("a")).join(b.select("ticker", F.lit(1).alias("b")), "ticker", "full_outer")
    return both.agg(F.try_divide(F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()), F.count("*")).alias("jaccard"))


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rank correlation with average ties, for one value by ticker."""
    def rank(c: str) -> Column:
        return F.rank().over(W.orderBy(c)) + (F.count("*").over(W.partitionBy(c)) - 1) / 2

    r = df.select(rank(a).alias("ra"), rank(b).alias("rb"))
    return r.agg(F.try_divide(F.covar_pop("ra", "rb"), F.sqrt(F.var_pop("ra") * F.var_pop("rb"))).alias("spearman"))


def mean_coverage(p: DataFrame, chosen: DataFrame, excluded: bool = False) -> DataFrame:
    """Coverage by ticker of ``p``, with the number of tickers and of anchors among them; ``excluded`` leaves out the anchors' own."""
    mine = chosen.select(F.col("ticker").alias("j")).distinct()
    best = p.join(F.broadcast(mine), "j").groupBy("i").agg(F.max("p").alias("c"), F.max(F.when(F.col("i") == F.col("j"), 1).otherwise(0)).alias("own"))
    n = p.agg(F.countDistinct("i").alias("n"))
    total = best.agg(F.coalesce(F.sum(F.col("c").cast("decimal(38,18)")).cast("double"), F.lit(0.0)).alias("f"), F.coalesce(F.sum("own"), F.lit(0)).alias("k"))
    share = adjusted_coverage(F.col("f"), F.col("k"), F.col("n")) if excluded else F.try_divide("f", "n")
    return total.join(F.broadcast(n)).select("n", "k", share.alias("mean_f"))


def cross_year(p_next: DataFrame, old_steps: DataFrame, new_steps: DataFrame) -> DataFrame:
    """``(stale, direct, ratio)``: last window's anchors on the next window's similarity, against its own.

    Anchors that are not in the next window's universe cover nothing.
    """
    p_next = materialize(p_next)
    stale = mean_coverage(p_next, old_steps).select(F.col("mean_f").alias("stale"))
    direct = mean_coverage(p_next, new_steps).select(F.col("mean_f").alias("direct"))
    return stale.join(F.broadcast(direct)).withColumn("ratio", F.try_divide("stale", "direct"))


def compare_measures(p_a: DataFrame, p_b: DataFrame, unbiased: DataFrame, k: int) -> DataFrame:
    """Two measures on one window: overlap of their anchors, mean coverages, rank correlation of coverage, mean U-statistic."""
    p_a, p_b = materialize(p_a), materialize(p_b)
    a, b = greedy(p_a, k), greedy(p_b, k)
    c = assign(p_a, a).select("ticker", F.col("c").alias("ca")).join(assign(p_b, b).select("ticker", F.col("c").alias("cb")), "ticker")
    u = unbiased.where("i < j").agg(F.avg(F.col("p").cast("double")).alias("mean_u"))
    means = mean_coverage(p_a, a).select(F.col("mean_f").alias("mean_f_a")).join(F.broadcast(mean_coverage(p_b, b).select(F.col("mean_f").alias("mean_f_b"))))
    return jaccard(a, b).join(F.broadcast(means)).join(F.broadcast(spearman(c, "ca", "cb"))).join(F.broadcast(u))


def zero_diagonal(p: DataFrame, k: int) -> DataFrame:
    """Greedy on P and on P with a zero diagonal, step by step; ``diverged`` from the first step that differs on."""
    p = materialize(p)
    zero = p.withColumn("p", F.when(F.col("i") == F.col("j"), F.lit(0).cast(P_TYPE)).otherwise(F.col("p")))
    a, b = greedy(p, k), greedy(zero, k)
    both = a.join(b.select("step", F.col("ticker").alias("ticker_zero"), F.col("gain").alias("gain_zero"), F.col("f").alias("f_zero")), "step")
    first = both.agg(F.min(F.when(F.col("ticker") != F.col("ticker_zero"), F.col("step"))).alias("first"))
    return both.join(F.broadcast(first)).withColumn("diverged", F.coalesce(F.col("step") >= F.col("first"), F.lit(False))).drop("first")


def flag_sensitivity(p: DataFrame, masked: DataFrame, k: int) -> DataFrame:
    """Selection on all sessions against unflagged ones: overlap, coverage without anchors' own, least pair length.

    Pairs with too few unflagged sessions count as 0.
    """
    p, masked = materialize(p), materialize(masked)
    both = masked.select("i", "j", F.col("p").alias("q")).union(masked.select("j", "i", "p"))
    again = materialize(p.join(both, ["i", "j"], "left").select("i", "j", F.when(F.col("i") == F.col("j"), 1.0).otherwise(F.coalesce("q", F.lit(0.0))).cast(P_TYPE).alias("p")))
    a, b = greedy(p, k), greedy(again, k)
    before, after = mean_coverage(p, a, True).select(F.col("mean_f").alias("before")), mean_coverage(again, b, True).select(F.col("mean_f").alias("after"))
    return jaccard(a, b).join(F.broadcast(before)).join(F.broadcast(after)).join(F.broadcast(masked.agg(F.min("t").alias("min_t"))))


def concentration(assigned: DataFrame, stocks: DataFrame, label: str = "sector") -> DataFrame:
    """By group: dominant share of a label (sector or industry), sum of squared shares, and what chance would give."""
    labelled = assigned.join(F.broadcast(stocks.select("ticker", F.col(label).alias("sector"))), "ticker", "left")
    base = labelled.groupBy("sector").count().agg(F.sum(F.pow(F.col("count"), 2)).alias("sq"), F.sum("count").alias("n")).select((F.col("sq") / (F.col("n") * F.col("n"))).alias("chance"))
    each = labelled.groupBy("anchor", "sector").count()
    g = each.groupBy("anchor").agg(F.sum("count").alias("n"), F.max("count").alias("top"), F.sum(F.pow(F.col("count"), 2)).alias("sq"))
    return g.join(F.broadcast(base)).select("anchor", "n", (F.col("top") / F.col("n")).alias("top_share"), (F.col("sq") / (F.col("n") * F.col("n"))).alias("hhi"), (1 / F.col("n") + (F.col("n") - 1) / F.col("n") * F.col("chance")).alias("hhi_expected"))


def tightness(p: DataFrame, assigned: DataFrame) -> DataFrame:
    """Mean similarity of members other than the anchor to it."""
    rows = assigned.where("ticker <> anchor").join(p, (F.col("ticker") == F.col("i")) & (F.col("anchor") == F.col("j")))
    return rows.groupBy("anchor").agg(F.count("*").alias("n_members"), F.avg(F.col("p").cast("double")).alias("mean_p"))

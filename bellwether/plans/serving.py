"""What is served of the active run: B1-B3, J7, J13, P8."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import model
from . import board


def active(runs: DataFrame) -> DataFrame:
    """The one run that is served, if any."""
    return runs.where("is_active")


def active_run(runs: DataFrame, bars: DataFrame) -> DataFrame:
    """The active run next to the latest session: two views of one row each."""
    return active(runs).join(F.broadcast(board.latest_session(bars)))


def ticker_params(run: dict[str, DataFrame], run_id: str, tau: float) -> DataFrame:
    """A run's row by ticker: position, anchor, coverage, flags and fitted parameters."""
    place = F.row_number().over(W.orderBy("ticker")) - 1
    chosen = run["steps"].select(F.col("ticker").alias("anchor_ticker")).distinct().withColumn("is_anchor", F.lit(True))
    rows = run["assigned"].join(run["params"], "ticker").withColumn("position", place)
    rows = rows.join(F.broadcast(chosen), F.col("ticker") == chosen["anchor_ticker"], "left").drop("anchor_ticker")
    return rows.select(
        F.lit(run_id).alias("run_id"), "position", "ticker", F.col("anchor").alias("anchor_ticker"), F.col("c").alias("coverage_c"), F.coalesce("is_anchor", F.lit(False)).alias("is_anchor"),
        (F.col("c") < tau).alias("under_tau"), F.col("alpha").alias("alpha_hat"), F.col("beta").alias("beta_hat"), F.col("sigma").alias("sigma_hat"), "r2",
    )


def active_assignment(runs: DataFrame, params: DataFrame, stocks: DataFrame) -> DataFrame:
    """Every ticker of the active run with its anchor and parameters; the dimension comes along for display (B2)."""
    return params.join(F.broadcast(active(runs).select("run_id")), "run_id").join(F.broadcast(stocks), "ticker", "left")


def active_groups(runs: DataFrame, groups: DataFrame) -> DataFrame:
    """The groups of the active run."""
    return groups.join(F.broadcast(active(runs).select("run_id")), "run_id")


def universe_with_moves(params: DataFrame, base: DataFrame) -> DataFrame:
    """The universe in the order of its positions, each ticker with its latest move if it has one."""
    return params.join(base.select("ticker", "bar_date", "close", "ret_1d", "sector"), "ticker", "left").orderBy("position")


def group_table(run: dict[str, DataFrame], stocks: DataFrame, run_id: str) -> DataFrame:
    """A run's groups with their figures and composition by sector."""
    return run["groups"].join(board.composition(run["assigned"], stocks), "anchor", "left").select(
        F.lit(run_id).alias("run_id"), F.col("anchor").alias("anchor_ticker"), "size", F.col("f").alias("f_j"), F.col("mean_c").alias("rho2_mean"), F.col("min_c").alias("rho2_min"), F.col("composition").alias("sector_composition")
    )


def published(run: dict[str, DataFrame], k: int) -> dict[str, DataFrame]:
    """A run cut to its first ``k`` steps: the others stay in the table of steps, but no ticker is assigned to them."""
    assigned = model.assign(run["p"], run["steps"], k)
    return run | {"assigned": assigned, "groups": model.groups(assigned)}

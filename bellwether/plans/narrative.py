"""Thirteen fixed statements on a ticker's latest rounded values.

Each statement is one SQL expression; numbers are shown as they are rounded: prices and oscillators with two digits, moves in per cent with four.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _shown(name: str) -> str:
    return f"CAST(CAST({name} AS DECIMAL(28,2)) AS STRING)"


def _percent(name: str) -> str:
    return f"CAST(CAST(abs({name}) * 100 AS DECIMAL(28,4)) AS STRING)"


def _case(*branches: tuple[str, str], otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {when} THEN {text}" for when, text in branches) + f" ELSE {otherwise} END"


def _versus(name: str, label: str) -> str:
    values = f"{_shown('close')}, ' against ', {_shown(name)})"
    return _case((f"close > {name}", f"concat('price above {label}: ', {values}"), (f"close < {name}", f"concat('price below {label}: ', {values}"), otherwise=f"concat('price at {label}: ', {_shown(name)})")


def _move(name: str, label: str) -> str:
    return _case((f"{name} > 0", f"concat('up ', {_percent(name)}, ' % over {label}')"), (f"{name} < 0", f"concat('down ', {_percent(name)}, ' % over {label}')"), otherwise=f"'unchanged over {label}'")


_MEANS = f"concat({_shown('sma_20')}, ', ', {_shown('sma_50')}, ', ', {_shown('sma_200')})"

#: code, inputs, statement; the thresholds are fixed values
RULES: tuple[tuple[str, tuple[str, ...], str], ...] = (
    ("price_sma_20", ("close", "sma_20"), _versus("sma_20", "its 20-session mean")),
    ("price_sma_50", ("close", "sma_50"), _versus("sma_50", "its 50-session mean")),
    ("price_sma_200", ("close", "sma_200"), _versus("sma_200", "its 200-session mean")),
    (
        "order",
        ("sma_20", "sma_50", "sma_200"),
        _case(
            ("sma_20 > sma_50 AND sma_50 > sma_200", f"concat('means in rising order: ', {_MEANS})"), ("sma_20 < sma_50 AND sma_50 < sma_200", f"concat('means in falling order: ', {_MEANS})"), otherwise=f"concat('means in mixed order: ', {_MEANS})"
        ),
    ),
    ("rsi", ("rsi_14",), f"concat({_case(('rsi_14 >= 70', repr('overbought: ')), ('rsi_14 <= 30', repr('oversold: ')), ('rsi_14 >= 50', repr('momentum positive: ')), otherwise=repr('momentum negative: '))}, {_shown('rsi_14')})"),
    ("macd", ("macd_hist",), f"concat({_case(('macd_hist > 0', repr('MACD above its signal by ')), ('macd_hist < 0', repr('MACD below its signal by ')), otherwise=repr('MACD at its signal: '))}, {_shown('abs(macd_hist)')})"),
    (
        "bands",
        ("close", "bb_upper_20", "bb_lower_20", "bb_mid_20"),
        _case(
            ("close >= bb_upper_20", f"concat('at or above the upper band: ', {_shown('bb_upper_20')})"),
            ("close <= bb_lower_20", f"concat('at or below the lower band: ', {_shown('bb_lower_20')})"),
            ("close >= bb_mid_20", f"concat('in the upper half of the bands: ', {_shown('bb_mid_20')}, ' to ', {_shown('bb_upper_20')})"),
            otherwise=f"concat('in the lower half of the bands: ', {_shown('bb_lower_20')}, ' to ', {_shown('bb_mid_20')})",
        ),
    ),
    (
        "volume",
        ("volume", "volume_sma_20"),
        f"concat({_case(('volume > volume_sma_20', repr('volume above its mean: ')), ('volume < volume_sma_20', repr('volume below its mean: ')), otherwise=repr('volume at its mean: '))}, CAST(CAST(volume AS BIGINT) AS STRING), ' against ', {_shown('volume_sma_20')})",
    ),
    ("drawdown", ("drawdown_from_252d_high",), _case(("drawdown_from_252d_high >= -0.0001", "'at its 252-session high'"), otherwise=f"concat({_percent('drawdown_from_252d_high')}, ' % below its 252-session high')")),
    ("ret_1d", ("ret_1d",), _move("ret_1d", "1 session")),
    ("ret_20d", ("ret_20d",), _move("ret_20d", "20 sessions")),
    ("ret_60d", ("ret_60d",), _move("ret_60d", "60 sessions")),
    ("ret_ytd", ("ret_ytd",), _move("ret_ytd", "the year so far")),
)


def narrative(rows: DataFrame) -> DataFrame:
    """``statements`` and ``skipped`` (with the missing inputs) of each row; together always 13. Round first."""
    said: list[Column] = []
    left: list[Column] = []
    for code, inputs, text in RULES:
        missing = F.filter(F.array(*(F.when(F.col(i).isNull(), F.lit(i)) for i in inputs)), lambda x: x.isNotNull())
        known = F.size(missing) == 0
        said.append(F.when(known, F.concat(F.lit(f"{code}: "), F.expr(text))))
        left.append(F.when(~known, F.concat(F.lit(f"{code}: "), F.array_join(missing, "+"))))
    some = lambda cols: F.filter(F.array(*cols), lambda x: x.isNotNull())
    return rows.select("ticker", F.array_join(some(said), "; ").alias("statements"), F.array_join(some(left), "; ").alias("skipped"), F.size(some(said)).alias("n_statements"), F.size(some(left)).alias("n_skipped"))

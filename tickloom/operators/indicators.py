"""Technical indicators by name, all computed over one block layout of the bars."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.series import BLOCK_ROWS, DAILY, Blocks, Series, add_level, blocks, smooth, trailing_sums

DEFAULT_PACK = ("macd", "rsi_14", "close_20_sma", "close_50_sma", "ema_20")


@dataclass
class Plan:
    """What one indicator adds: earlier rows it needs, inputs, exponential means, and final columns."""

    history: int
    inputs: Callable[[Blocks], dict[str, Column]] = lambda b: {}
    sums: dict[str, tuple[Column, int]] = field(default_factory=dict)
    counted: bool = False
    means: dict[str, tuple[Column, float, int]] = field(default_factory=dict)
    between: Callable[[Blocks], dict[str, Column]] = lambda b: {}
    later_means: dict[str, tuple[Column, float, int]] = field(default_factory=dict)
    ratios: list[tuple[str, ...]] = field(default_factory=list)  # means of which only the ratios are used
    outputs: Callable[[Blocks], dict[str, Column]] = lambda b: {}


def span_alpha(span: int) -> float:
    return 2.0 / (span + 1.0)


def full_window(b: Blocks, rows: int, value: Column, of: str = "close") -> Column:
    """`value` only where the trailing window holds `rows` values."""
    return F.when(F.count(of).over(b.trailing(rows)) >= rows, value)


def sma(rows: int, name: str, of: str = "close") -> Plan:
    total = F.col(f"_sum_{of}_{rows}")
    mean = F.when((F.col("_rn") >= rows - 1) & ~F.isnan(total), total / rows)
    return Plan(rows, sums={of: (F.col(of), rows)}, outputs=lambda b: {name: mean})


def ema(span: int, name: str, of: str = "close") -> Plan:
    alpha = span_alpha(span)
    return Plan(1, means={name: (F.col(of), alpha, span)})


def _changes(b: Blocks) -> dict[str, Column]:
    return {"_prev_close": F.lag("close").over(b.window)}


def rsi(rows: int, name: str) -> Plan:
    alpha = 1.0 / rows
    diff = F.coalesce(F.col("close") - F.col("_prev_close"), F.lit(0.0))
    gain = F.when(diff > 0, diff).otherwise(F.lit(0.0))
    loss = F.when(diff < 0, -diff).otherwise(F.lit(0.0))
    g, d = f"_gain_{rows}", f"_loss_{rows}"

    def outputs(b: Blocks) -> dict[str, Column]:
        value = F.when(F.col(d) == 0, F.lit(100.0)).otherwise(
            100.0 - 100.0 / (1.0 + F.col(g) / F.nullif(F.col(d), F.lit(0.0)))
        )
        return {name: F.when(F.col(g).isNotNull(), value)}

    return Plan(
        1,
        inputs=_changes,
        means={g: (gain, alpha, rows), d: (loss, alpha, rows)},
        ratios=[(g, d)],
        outputs=outputs,
    )


def macd(fast: int = 12, slow: int = 26, signal: int = 9) -> Plan:
    a_fast, a_slow, a_signal = span_alpha(fast), span_alpha(slow), span_alpha(signal)
    need = max(fast, slow)
    return Plan(
        1,
        means={
            "_macd_fast": (F.col("close"), a_fast, need),
            "_macd_slow": (F.col("close"), a_slow, need),
        },
        between=lambda b: {"macd": F.col("_macd_fast") - F.col("_macd_slow")},
        later_means={"macd_signal": (F.col("macd"), a_signal, signal)},
        outputs=lambda b: {"macd_diff": F.col("macd") - F.col("macd_signal")},
    )


def cci(rows: int, name: str) -> Plan:
    tp = f"_tp_{rows}"

    def between(b: Blocks) -> dict[str, Column]:
        t = b.trailing(rows)
        return {
            f"{tp}_mean": full_window(b, rows, F.avg("_tp").over(t)),
            f"{tp}_list": F.collect_list("_tp").over(t),
        }

    def outputs(b: Blocks) -> dict[str, Column]:
        mean = F.col(f"{tp}_mean")
        deviation = F.aggregate(f"{tp}_list", F.lit(0.0), lambda a, v: a + F.abs(v - mean)) / rows
        return {name: F.try_divide(F.col("_tp") - mean, 0.015 * deviation)}

    return Plan(
        rows,
        inputs=lambda b: {"_tp": (F.col("high") + F.col("low") + F.col("close")) / 3.0},
        between=between,
        outputs=outputs,
    )


def dx(rows: int, name: str) -> Plan:
    alpha = 1.0 / rows

    def inputs(b: Blocks) -> dict[str, Column]:
        return {
            "_prev_close": F.lag("close").over(b.window),
            "_prev_high": F.lag("high").over(b.window),
            "_prev_low": F.lag("low").over(b.window),
        }

    up = F.col("high") - F.col("_prev_high")
    down = F.col("_prev_low") - F.col("low")
    plus = F.when((up > down) & (up > 0), up).otherwise(F.lit(0.0))
    minus = F.when((down > up) & (down > 0), down).otherwise(F.lit(0.0))
    true_range = F.greatest(
        F.col("high") - F.col("low"),
        F.abs(F.col("high") - F.col("_prev_close")),
        F.abs(F.col("low") - F.col("_prev_close")),
    )
    p, m, t = f"_dmp_{rows}", f"_dmm_{rows}", f"_tr_{rows}"

    def outputs(b: Blocks) -> dict[str, Column]:
        # The range divides both directions alike, so it only decides whether there is a value.
        apart = F.try_divide(100.0 * F.abs(F.col(p) - F.col(m)), F.col(p) + F.col(m))
        return {name: F.when(F.col(t) != 0, apart)}

    return Plan(
        1,
        inputs=inputs,
        means={p: (plus, alpha, rows), m: (minus, alpha, rows), t: (true_range, alpha, rows)},
        ratios=[(p, m), (t,)],
        outputs=outputs,
    )


def bollinger(rows: int = 20, width: float = 2.0) -> Plan:
    def between(b: Blocks) -> dict[str, Column]:
        t = b.trailing(rows)
        return {
            "boll_mid": full_window(b, rows, F.avg("close").over(t)),
            "_boll_sd": full_window(b, rows, F.stddev_pop("close").over(t)),
        }

    def outputs(b: Blocks) -> dict[str, Column]:
        return {
            "boll_upper": F.col("boll_mid") + width * F.col("_boll_sd"),
            "boll_lower": F.col("boll_mid") - width * F.col("_boll_sd"),
        }

    return Plan(rows, between=between, outputs=outputs)


def daily_return(of: str = "close", name: str = "daily_return") -> Plan:
    return Plan(1, outputs=lambda b: {name: F.try_divide(F.col(of), F.lag(of).over(b.window)) - 1.0})


def lag_feature(column: str, rows: int) -> Plan:
    return Plan(rows, outputs=lambda b: {f"{column}_lag{rows}": F.lag(column, rows).over(b.window)})


def rolling_mean_feature(column: str, rows: int) -> Plan:
    """Mean of the last rows there are, at most `rows`."""
    tag = f"known_{column}"
    mean = F.try_divide(f"_sum_{tag}_{rows}", f"_cnt_{tag}_{rows}")
    return Plan(
        rows, sums={tag: (F.col(column), rows)}, counted=True, outputs=lambda b: {f"{column}_ma{rows}": mean}
    )


_NAMES: list[tuple[str, Callable[[re.Match], Plan]]] = [
    (r"macd", lambda m: macd()),
    (r"rsi", lambda m: rsi(14, "rsi")),
    (r"rsi_(\d+)", lambda m: rsi(int(m[1]), m[0])),
    (r"sma_(\d+)", lambda m: sma(int(m[1]), m[0])),
    (r"close_(\d+)_sma", lambda m: sma(int(m[1]), m[0])),
    (r"ema_(\d+)", lambda m: ema(int(m[1]), m[0])),
    (r"close_(\d+)_ema", lambda m: ema(int(m[1]), m[0])),
    (r"cci_(\d+)", lambda m: cci(int(m[1]), m[0])),
    (r"dx_(\d+)", lambda m: dx(int(m[1]), m[0])),
    (r"boll", lambda m: bollinger()),
    (r"daily_return", lambda m: daily_return()),
    (r"(\w+)_lag(\d+)", lambda m: lag_feature(m[1], int(m[2]))),
    (r"(\w+)_ma(\d+)", lambda m: rolling_mean_feature(m[1], int(m[2]))),
]


def resolve(name: str) -> Plan:
    for pattern, make in _NAMES:
        match = re.fullmatch(pattern, name)
        if match:
            return make(match)
    raise ValueError(f"unknown indicator {name!r}")


def apply_plans(bars: DataFrame, plans: Iterable[Plan], series: Series = DAILY, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Run indicator plans level by level, so that every level is one window pass over the same layout."""
    plans = list(plans)
    b = blocks(bars, series, max(p.history for p in plans), block_rows)
    for level in ("inputs", "sums", "means", "between", "later_means", "outputs"):
        if level == "sums":
            for counted in (False, True):
                asked = [(n, x, rows) for p in plans if p.counted == counted for n, (x, rows) in p.sums.items()]
                if asked:
                    lengths = {n: {rows for m, _, rows in asked if m == n} for n, _, _ in asked}
                    trailing_sums(b, {n: x for n, x, _ in asked}, lengths, counted=counted)
        elif level in ("means", "later_means"):
            merged = {k: v for p in plans for k, v in getattr(p, level).items()}
            if merged:
                smooth(b, merged, {g: None for p in plans for g in p.ratios if set(g) <= merged.keys()})
        else:
            add_level(b, {k: v for p in plans for k, v in getattr(p, level)(b).items()})
    return b.finish()


def indicator_pack(
    bars: DataFrame, names: Iterable[str] = DEFAULT_PACK, series: Series = DAILY, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Bars with the named indicators; a name gives its own column, `macd` three and `boll` three."""
    return apply_plans(bars, [resolve(n) for n in names], series, block_rows)


def technical_indicators(
    bars: DataFrame,
    sma_windows: Iterable[int] = (20, 50),
    ema_windows: Iterable[int] = (20, 50),
    rsi_window: int = 14,
    macd_fast: int = 12,
    macd_slow: int = 26,
    macd_signal: int = 9,
    series: Series = DAILY,
) -> DataFrame:
    """The standard set: moving averages, RSI and MACD; `vix` and `turbulence` are added as NULL if absent."""
    if "close" not in bars.columns:
        raise ValueError("bars need a close column")
    plans = [sma(n, f"sma_{n}") for n in sma_windows] + [ema(n, f"ema_{n}") for n in ema_windows]
    plans += [rsi(rsi_window, "rsi"), macd(macd_fast, macd_slow, macd_signal)]
    out = apply_plans(bars, plans, series)
    return out.withColumns(
        {c: F.lit(None).cast("double") for c in ("vix", "turbulence") if c not in bars.columns}
    )


def lookback_tensor(bars: DataFrame, columns: Iterable[str], rows: int, series: Series = DAILY) -> DataFrame:
    """The last `rows` feature rows as a nested array, oldest first; NULL until there are that many."""
    columns = list(columns)
    b = blocks(bars, series, rows)
    point = F.array(*[F.col(c).cast("double") for c in columns])
    past = F.collect_list(point).over(b.trailing(rows))
    add_level(b, {"lookback": F.when(F.col("_rn") >= rows - 1, past)})
    return b.finish().select(*series.key, series.order, "lookback")

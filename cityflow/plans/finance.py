"""FX rate and market proxies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import HEADER_RULES, midpoint, sanitise_name
from ..operators.series import daily_change, densify
from ..operators.widen import widen


def fx_daily(bronze: DataFrame, start, end, date: str = "Date") -> DataFrame:
    """Date, Exchange_Rate = (High + Low) / 2, every day of the window, filled
    forward then backward, ordered by date."""
    rates = bronze.select(F.to_date(F.col(date)).alias("Date"),
                          midpoint("High", "Low").alias("Exchange_Rate"))
    dense = densify(rates, "Date", [], start, end, fill=("forward", "backward"))
    return dense.orderBy("Date")


def sanitised_ticker(col: str = "ticker"):
    c = F.col(col)
    for old, new in HEADER_RULES:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def market_daily(quotes: DataFrame, start, end, vix: str = "Vol_VIX", spy: str = "SPY", xli: str = "XLI") -> DataFrame:
    """Long quotes (Date, ticker, Close) -> Date, vol_vix, spy_daily_change,
    xli_daily_change. Filled calendar first, so closed days change by 0 and
    the next open day carries the move. A ticker without quotes has a null
    level and changes of 0."""
    wanted = [vix, spy, xli]
    q = quotes.select(F.to_date("Date").alias("Date"), sanitised_ticker("ticker").alias("ticker"), "Close")
    keys = quotes.sparkSession.createDataFrame([(t,) for t in wanted], "ticker string")
    dense = densify(q.where(F.col("ticker").isin(wanted)), "Date", ["ticker"], start, end, keys=keys)
    wide = widen(daily_change(dense, "Close", "Date", by=["ticker"], out="change"), "Date", "ticker", ["Close", "change"], wanted, name=str)
    level, moves = f"Close_{vix}", {"spy_daily_change": f"change_{spy}", "xli_daily_change": f"change_{xli}"}
    return wide.select("Date", F.col(level).alias("vol_vix"), *[F.col(c).alias(o) for o, c in moves.items()]).orderBy("Date")


def quote_table(quotes: DataFrame, values) -> DataFrame:
    """Wide quotes: Date + one Close column per sanitised ticker."""
    q = quotes.select("Date", sanitised_ticker("ticker").alias("ticker"), "Close")
    wide = widen(q, "Date", "ticker", ["Close"], [sanitise_name(v) for v in values], name=str)
    return wide.withColumnsRenamed({c: c[len("Close_"):] for c in wide.columns if c.startswith("Close_")})

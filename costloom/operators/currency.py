"""Currency conversion, current and dated.

Rates are units of a currency per unit of company currency; a currency without
a rate counts 1. Reduced rates are written once per use and serve both legs of a
conversion: one row per currency (current) or per currency and month a rate
covers (dated). The planner sees their true size and chooses the join by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import exchange
from ..session import written


def current_rates(rates: DataFrame, as_of: str | None = None) -> DataFrame:
    """Latest rate of each currency, on or before ``as_of`` when given."""
    if as_of is not None:
        rates = rates.filter(F.col("date") <= F.lit(as_of).cast("date"))
    return rates.groupBy("currency").agg(F.max_by("rate", "date").alias("rate"))


def with_current_rate(df: DataFrame, rates: DataFrame, currency: str, out: str, as_of: str | None = None) -> DataFrame:
    """``rates`` may also be the result of ``current_rates``, written by the caller."""
    reduced = rates if "date" not in rates.columns else written(current_rates(rates, as_of))
    return _rated(df, reduced, currency, out)


def _rated(df: DataFrame, latest: DataFrame, currency: str, out: str) -> DataFrame:
    return df.join(latest.select(F.col("currency").alias(currency), F.col("rate").alias(out)), currency, "left")


def _month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def rate_months(rates: DataFrame) -> DataFrame:
    """Rates as [since, until) intervals under every month they cover, written once."""
    daily = rates.groupBy("currency", "date").agg(F.max("rate").alias("rate"))
    # Few rows per currency by construction: one per day at most.
    intervals = daily.selectExpr("currency", "date AS since", "lead(date) OVER (PARTITION BY currency ORDER BY date) AS until", "rate")
    last = daily.agg(F.max(_month(F.col("date")))).scalar()
    months = F.sequence(_month(F.col("since")), F.coalesce(_month(F.col("until")), last))
    return written(intervals.select("currency", F.explode(months).alias("month"), "since", "until", "rate", last.alias("last_month")))


def fx_asof(df: DataFrame, rates: DataFrame, currency: str, date_col: str, out: str = "rate") -> DataFrame:
    """As-of join: latest rate on or before ``date_col``, NULL before the first.

    The join is on (currency, month), so a row meets only the few rates of its
    own month. Later dates use the last month.
    """
    return _dated(df, rate_months(rates), currency, date_col, out)


def _dated(df: DataFrame, months: DataFrame, currency: str, date_col: str, out: str) -> DataFrame:
    side = months.select(*[F.col(c).alias(f"__fx_{c}") for c in ("currency", "month", "since", "until")], F.col("rate").alias(out))
    last = months.agg(F.max("last_month")).first()[0]
    left = df.withColumn("__fx_day", F.col(date_col).cast("date"))
    bucket = _month(F.col("__fx_day"))
    match = (
        (F.col(currency) == F.col("__fx_currency"))
        & ((bucket if last is None else F.least(bucket, F.lit(last))) == F.col("__fx_month"))
        & (F.col("__fx_since") <= F.col("__fx_day"))
        & (F.col("__fx_until").isNull() | (F.col("__fx_day") < F.col("__fx_until")))
    )
    return left.join(side, match, "left").drop("__fx_day", *[f"__fx_{c}" for c in ("currency", "month", "since", "until")])


def convert(
    df: DataFrame,
    rates: DataFrame,
    amount: str,
    from_currency: str,
    to_currency: str | None,
    out: str,
    date_col: str | None = None,
    as_of: str | None = None,
    decimals: int | None = None,
) -> DataFrame:
    """Amount in another currency; ``to_currency`` None means company currency.

    With ``date_col``, ``rates`` may also be the result of ``rate_months``.
    """
    one = F.lit(1.0)
    if date_col is None:
        side = written(current_rates(rates, as_of))
    else:
        side = rates if "last_month" in rates.columns else rate_months(rates)

    def leg(rows: DataFrame, currency: str, name: str) -> DataFrame:
        return _rated(rows, side, currency, name) if date_col is None else _dated(rows, side, currency, date_col, name)

    step = leg(df, from_currency, "__rate_from")
    if to_currency is not None:
        step = leg(step, to_currency, "__rate_to")
    target = F.col("__rate_to") if to_currency is not None else one
    return step.withColumn(out, exchange(F.col(amount), F.col("__rate_from"), target, decimals)).drop(
        "__rate_from", "__rate_to"
    )


def convert_from_company(
    df: DataFrame, rates: DataFrame, amount: str, to_currency: str, out: str, date_col: str | None = None, as_of: str | None = None
) -> DataFrame:
    """Company-currency amount in the currency named by ``to_currency``."""
    if date_col is None:
        step = with_current_rate(df, rates, to_currency, "__rate_to", as_of)
    else:
        step = fx_asof(df, rates, to_currency, date_col, "__rate_to")
    return step.withColumn(out, exchange(F.col(amount), F.lit(1.0), F.col("__rate_to"))).drop("__rate_to")

"""Row-level expressions. All are built-in functions and stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import schemas as S


def epoch_seconds(timestamp: str | Column) -> Column:
    """Whole seconds since the epoch, rounded down."""
    return F.unix_timestamp(timestamp)


def guarded_ratio(value: Column, base: Column) -> Column:
    """``value / base``, NULL where the base is 0 or NULL."""
    return value.cast("double") / F.nullif(base.cast("double"), F.lit(0.0))


def age_days(now_seconds: Column, since_seconds: Column) -> Column:
    """Fractional days between two epoch-second columns."""
    return (now_seconds - since_seconds) / F.lit(float(S.DAY))


def below_flag(value: Column, limit: float) -> Column:
    """1 below the limit, 0 otherwise, also for NULL."""
    return F.when(value < limit, 1).otherwise(0)


def unseen_flag(seen: Column, value: Column) -> Column:
    """0 if ``value`` is in the array ``seen``, otherwise 1, also for NULL."""
    return F.when(F.array_contains(seen, value), 0).otherwise(1)


def sample_stddev(n: Column, total: Column, total_of_squares: Column) -> Column:
    """Sample standard deviation from exact decimal sums; NULL below two values.

    The numerator ``n * sum(x^2) - sum(x)^2`` is formed in decimals, so running sums do not cancel.
    Where it would not fit 38 digits the same formula is evaluated in doubles.
    """
    exact = F.try_subtract(F.try_multiply(n, total_of_squares), F.try_multiply(total, total))
    count, s, q = n.cast("double"), total.cast("double"), total_of_squares.cast("double")
    spread = F.coalesce(exact.cast("double"), count * q - s * s)
    return F.when(n > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (count * (count - 1.0))))


def local_amount(rate: Column, usd: Column) -> Column:
    """Amount in local currency, rounded half up to cents."""
    return F.round(rate * usd, 2).cast(S.MONEY)


def country_currency(country: Column) -> Column:
    """Currency of a country, NULL for countries without one on the list."""
    table = F.create_map(*[F.lit(x) for pair in S.COUNTRY_CURRENCY.items() for x in pair])
    return F.try_element_at(table, country)


def spending_band(usd: Column) -> Column:
    """The band with the largest lower limit not above the amount; NULL below the first."""
    bands = sorted(S.SPENDING_BANDS.items(), key=lambda b: float(b[1]), reverse=True)
    chain = None
    for name, low in bands:
        reached = usd >= F.lit(low).cast(S.MONEY)
        chain = F.when(reached, name) if chain is None else chain.when(reached, name)
    return chain


def high_amount_status(usd: Column, provider: Column, method: Column) -> Column:
    """Approval of top-band amounts: only cards of a renowned provider. NULL below that band."""
    top = F.lit(S.SPENDING_BANDS["High Level Spending"]).cast(S.MONEY)
    trusted = (provider == S.RENOWNED) & method.isin(*S.CARD_METHODS)
    return F.when(usd >= top, F.when(trusted, S.APPROVED).otherwise(S.DECLINED))

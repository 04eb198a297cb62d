"""Exact sums of prices.

Prices are doubles, but sums of doubles depend on the order of rows, and with it on how
Spark splits the work. Summing decimals and turning to double for the last division
gives the same bits on every run.

A price has up to ten digits before the point and eight after it, further ones are
rounded; a size has up to twelve. ``validate`` turns down what lies outside. The bound on
sizes follows from the sums that are made of them: a frame, window or bucket adds sizes in
64 bits, which holds nine million rows of the largest size; a ticker's running total is a
decimal of 38 digits; products with prices have 30 digits before the point, which holds
10^8 rows of the largest price and size; squares of sizes are summed over the rows of a
z-score only. Quotients are of doubles, so a mean can differ from the exact one in its
last digit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Prices from the first up to, but not including, the second; sizes below the third.
MIN_PRICE, MAX_PRICE, MAX_SIZE = 1e-8, 1e10, 10**12


def exact(value: Column | str) -> Column:
    """A double as a decimal with eight places, fit for summing."""
    c = F.col(value) if isinstance(value, str) else value
    return c.cast("decimal(18,8)").cast("decimal(38,8)")


def notional(price: str = "price", size: str = "size") -> Column:
    """price * size as a summable decimal."""
    return (F.col(price).cast("decimal(18,8)") * F.col(size).cast("decimal(18,0)")).cast("decimal(38,8)")


def ratio(total: Column, weight: Column) -> Column:
    """total / weight in double, 0.0 where the weight is zero or missing."""
    return F.when(weight > 0, total.cast("double") / weight.cast("double")).otherwise(F.lit(0.0))

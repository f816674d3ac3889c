"""Rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def steady_round(value: Column, digits: int) -> Column:
    """Round a mean so that the order of summation cannot decide an exact tie.

    Doubles added in another order differ in their last bits: a mean of 53.175 may come out
    as 53.17499999999999. Nine decimals remove that noise before the tie is rounded up.
    """
    return F.round(F.round(value, 9), digits)

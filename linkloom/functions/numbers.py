"""Numbers as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(x: Column, digits: int = 6) -> Column:
    """x to so many decimals as the SQL rounds: the double product with 10^digits, halves away from zero.

    F.round goes by the shortest decimal that stands for x, and takes the other side where a product lies a hair below a half.
    """
    unit = float(10**digits)
    return F.round(x * F.lit(unit)) / F.lit(unit)

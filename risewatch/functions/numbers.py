"""Rounding."""

from pyspark.sql import Column
from pyspark.sql import functions as F

NOISE_DECIMALS = 9


def round_stable(value: Column | str, decimals: int) -> Column:
    """Round half up, taking differences beyond the ninth decimal for noise.

    A mean that is a tie on paper may lie a bit below it in binary, depending on
    the order of additions; rounding to nine decimals first restores the tie.
    """
    return F.round(F.round(value, NOISE_DECIMALS), decimals)

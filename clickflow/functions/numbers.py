"""Rounding."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: str, total: str) -> Column:
    """``part / total`` rounded half-up to two decimals in integer arithmetic.

    Both are SQL text of integer values. A zero total gives 0.0.
    """
    return F.expr(
        f"if(({total}) = 0, 0D, double((200 * ({part}) + ({total})) div (2 * ({total}))) / 100)"
    )


def _power_of_two(exponent: Column) -> Column:
    """``2^exponent`` as an exact decimal for 0 <= exponent <= 120."""
    one = F.lit(1).cast("bigint")
    low = F.call_function("shiftleft", one, F.least(exponent, F.lit(60)))
    high = F.call_function("shiftleft", one, F.greatest(exponent - 60, F.lit(0)))
    return low.cast("decimal(19,0)") * high.cast("decimal(19,0)")


def format_double(col: Column, scale: int) -> Column:
    """Round half-up on the exact binary value; NaN and infinity raise.

    A double is ``m / 2^s`` for integers m and s, so rounding at 10^-scale is an
    integer division of ``m * 10^scale`` by ``2^s``.
    """
    if not 0 <= scale <= 18:
        raise ValueError("scale must be between 0 and 18")
    size = F.abs(col)
    error = F.raise_error(F.lit("cannot round NaN or infinity")).cast("double")
    size = F.when(F.isnan(size) | (size == float("inf")), error).otherwise(size)
    # Above: the step between doubles is wider than 10^-scale. Below: always rounds to 0.
    above = size >= float(2**53) / 10**scale
    below = size < 2.0**-63
    shift = F.when(~above & ~below, (53 - F.floor(F.log2(size))).cast("int"))
    mantissa = (size * F.pow(F.lit(2.0), shift)).cast("bigint").cast("decimal(18,0)")
    power = _power_of_two(shift)
    scaled = mantissa * F.lit(10**scale).cast("decimal(19,0)")
    units = F.call_function("div", scaled * 2 + power, power * 2)
    rounded = F.when(above, size).when(below, F.lit(0.0)).otherwise(units.cast("double") / 10**scale)
    return F.when(col < 0, -rounded).otherwise(rounded)

"""Numbers as text, exactly as the record formats print them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def plain_number(value: Column) -> Column:
    """Shortest form of a double without a trailing ``.0``: ``1``, ``0.8``, ``0.0001``, ``1e-7``.

    Null prints as ``null``.
    """
    text = value.cast("string")
    whole = (value == F.rint(value)) & (F.abs(value) < F.lit(1e21))  # all digits up to there
    tiny = (F.abs(value) < F.lit(1e-6)) & (value != 0)
    scientific = F.contains(text, F.lit("E"))
    spelled = F.regexp_replace(value.cast("decimal(38,20)").cast("string"), r"\.?0+\z", "")
    exponent = F.regexp_replace(F.regexp_replace(text, r"\.0E", "E"), "E-", "e-")
    return (
        F.when(value.isNull(), "null")
        .when(F.isnan(value), "NaN")
        .when(whole, value.cast("decimal(38,0)").cast("string"))
        .when(tiny, exponent)
        .when(scientific & (F.abs(value) < F.lit(1e15)), spelled)
        .otherwise(text)
    )


def fixed(value: Column, digits: int, ties: str = "even") -> Column:
    """``value`` with ``digits`` decimals, rounded on its exact binary value.

    Spark's own ``format_string('%.2f')`` rounds the shortest decimal form, so 1.005 prints as 1.01 although the
    double is below the midpoint. Here the distance to the midpoint is computed without error: ``5**digits * value``
    is split in a rounded product and its exact remainder (Dekker 1971), and all other factors are powers of two.
    Exact ties go to the even digit or up (``ties="up"``).
    """
    factor, scale = 5.0 ** digits, 2.0 ** digits
    size = F.abs(value)
    product = size * F.lit(factor)
    spread = size * F.lit(134217729.0)
    high = spread - (spread - size)
    remainder = (F.lit(factor) * high - product) + F.lit(factor) * (size - high)
    below = F.floor(product * F.lit(scale))
    midpoint = (below.cast("double") * 2 + 1) / F.lit(2.0 * scale)
    over = (product - midpoint) + remainder
    up = (over > 0) | ((over == 0) & (F.lit(ties == "up") | (below % 2 == 1)))
    units = below + up.cast("bigint")
    base = 10 ** digits
    text = F.concat(
        F.when((value < 0), "-").otherwise(""),
        F.floor(units / F.lit(base)).cast("string"), F.lit("."),
        F.lpad((units % base).cast("string"), digits, "0"),
    )
    # Beyond 2**53 units there are no fractional digits left to round.
    return F.when(product * F.lit(scale) < F.lit(2.0 ** 52), text).otherwise(
        F.format_string(f"%.{digits}f", value)
    )

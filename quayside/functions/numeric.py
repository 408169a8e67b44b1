"""Rounding and other numeric expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(value: Column, scale: int, precision: int = 18) -> Column:
    """Round a decimal to `scale` places, ties to the even neighbour."""
    return F.bround(value, scale).cast(f"decimal({precision},{scale})")


def half_even_from_double(value: Column, scale: int, precision: int = 20) -> Column:
    """Round a double from its shortest decimal text, so the result does not depend on how the
    binary value would expand. Good for absolute values below 1e13."""
    exact = value.cast("string").cast("decimal(38,25)")
    return half_even(exact, scale, precision)


def is_finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))


def uniform_noise(text: Column) -> Column:
    """A value in [-1, 1) from the first eight bytes of the text's SHA-256, read big-endian."""
    head = F.conv(F.substring(F.sha2(text, 256), 1, 16), 16, 10)
    return head.cast("decimal(20,0)").cast("double") / F.lit(float(2**63)) - F.lit(1.0)


def backoff_seconds(attempts: Column, base: float = 5.0, cap: float = 900.0) -> Column:
    """Exponential backoff: `base` after the first failure, doubling, never above `cap`."""
    return F.least(F.lit(cap), F.lit(base) * F.pow(F.lit(2.0), F.greatest(F.lit(0), attempts - 1)))

"""Column expressions shared by the operators. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 13 hex digits are 52 bits, the most that a DOUBLE holds exactly. Fewer would make
# the draw too coarse for clusters of billions of points and a small sample.
DRAW_DIGITS = 13


def truncate_rating(rating: Column) -> Column:
    """Whole part of a rating, toward zero. Text such as '5.0' goes through DOUBLE."""
    return rating.cast("double").cast("bigint")


def squared_distance(a: Column, b: Column) -> Column:
    """Sum of squared coordinate differences (no square root)."""
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(squares, F.lit(0.0), lambda total, x: total + x)


def hash_key(seed: int | Column, *parts: Column) -> Column:
    """Hex digest of the parts and the seed, the same wherever the row is computed."""
    seed = seed if isinstance(seed, Column) else F.lit(seed)
    texts = [part.cast("string") for part in (*parts, seed)]
    return F.md5(F.concat_ws(":", *texts).cast("binary"))


def unit_draw(seed: int | Column, *parts: Column) -> Column:
    """Uniform number in [0, 1) that depends only on the parts and the seed.

    Unlike rand(), a retried task draws the same number, and so does a run with
    another number of partitions.
    """
    digits = F.substring(hash_key(seed, *parts), 1, DRAW_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(16**DRAW_DIGITS))


def require(condition: Column, message: Column | str) -> Column:
    """Filter condition that fails the job, with the message, where it does not hold."""
    message = message if isinstance(message, Column) else F.lit(message)
    return F.when(condition, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))

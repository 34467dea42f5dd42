"""Seeded draws from row ids.

A draw depends on seed, purpose and id only - not on partitioning, task order or retries - so a
lost executor recomputes the same rows. Different purposes give independent draws.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from evenkeel.config import SEED

ORDER_KEY_DIGITS = 15
ORDER_KEY_SPACE = 1 << (4 * ORDER_KEY_DIGITS)
DRAW_SPACE = 1 << 32


def _digest(purpose: str, row_id: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:{purpose}:"), row_id.cast("string")))


def _hex_to_long(hex_digits: Column) -> Column:
    # Never null, or every filter on the value would first compute it once more to test for null.
    return F.coalesce(F.conv(hex_digits, 16, 10).cast("bigint"), F.lit(0).cast("bigint"))


def order_key(purpose: str, row_id: Column, seed: int = SEED) -> Column:
    """60-bit shuffle key: rows sorted by it (then by id) are in seeded random order."""
    return _hex_to_long(F.substring(_digest(purpose, row_id, seed), 1, ORDER_KEY_DIGITS))


def name_key(name: Column, seed: int = SEED) -> Column:
    """60-bit key that puts names in seeded random order."""
    return _hex_to_long(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name)), 1, ORDER_KEY_DIGITS))


def draw(purpose: str, row_id: Column, number: int = 0, seed: int = SEED) -> Column:
    """Uniform integer in [0, 2**32). Four numbered draws share one digest."""
    digest = _digest(f"{purpose}{number // 4}", row_id, seed)
    return _hex_to_long(F.substring(digest, 8 * (number % 4) + 1, 8))


def chance(uniform: Column, probability: float) -> Column:
    """True with the given probability."""
    return uniform < int(probability * DRAW_SPACE)


def pick(uniform: Column, values: list[str]) -> Column:
    """One of ``values``, uniformly."""
    index = F.shiftright(uniform * len(values), 32).cast("int")
    return F.get(F.array(*[F.lit(v) for v in values]), index)

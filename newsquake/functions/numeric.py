"""Null-safe arithmetic, exact decimal text and hash draws."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = 134217729.0  # 2**27 + 1, splits a double into two halves
_DRAW_MAX = 4294967295.0


def present(c: Column) -> Column:
    """The value, with 0 read as missing."""
    return F.nullif(c, F.lit(0.0))


def ratio(num: Column, den: Column) -> Column:
    """num / den, null when den is missing or 0 (ANSI division would raise)."""
    return F.try_divide(num, den)


def clamp(c: Column, low: float, high: float) -> Column:
    """Bounds that keep null as null; least/greatest alone would skip it."""
    return F.when(c.isNotNull(), F.greatest(F.least(c, F.lit(high)), F.lit(low)))


def _halves(value: float) -> tuple[float, float]:
    t = value * _SPLIT
    high = t - (t - value)
    return high, value - high


def scaled_half_even(x: Column, digits: int) -> Column:
    """abs(x) * 10**digits as an integer, rounded half to even on the exact binary value.

    Java's formatter rounds the shortest decimal half up; this keeps the product's rounding
    error so that 0.35 gives 3 and 0.25 gives 2 at one digit.
    """
    a = F.abs(x)
    if digits == 0:
        return F.rint(a).cast("long")
    m = 10.0**digits
    m_high, m_low = _halves(m)
    p = a * m
    t = a * _SPLIT
    a_high = t - (t - a)
    a_low = a - a_high
    error = ((a_high * m_high - p) + a_high * m_low + a_low * m_high) + a_low * m_low
    n = F.floor(p)
    excess = (p - n - 0.5) + error
    up = (excess > 0) | ((excess == 0) & (n % 2 == 1))
    return n + F.when(up, 1).otherwise(0)


def fixed_text(x: Column, digits: int) -> Column:
    """x with a fixed number of decimals; null stays null."""
    n = scaled_half_even(x, digits)
    scale = 10**digits
    body = n.cast("string") if digits == 0 else F.concat(
        F.floor(n / F.lit(scale)).cast("string"),
        F.lit("."),
        F.lpad((n % scale).cast("string"), digits, "0"),
    )
    sign = F.when(x < 0, "-").otherwise("")
    return F.concat(sign, body)


def draw_bits(*parts: Column | str) -> Column:
    """First 32 bits of SHA-256 over the parts joined by ':', as a long."""
    cols = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    digest = F.sha2(F.concat_ws(":", *cols), 256)
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def draw(*parts: Column | str) -> Column:
    """A stable number in [0, 1] for a key and a salt, the same on every run and partitioning."""
    return draw_bits(*parts) / F.lit(_DRAW_MAX)


def draw_index(n: int | Column, *parts: Column | str) -> Column:
    """A stable index in [0, n)."""
    size = F.lit(n) if isinstance(n, int) else n
    return F.pmod(draw_bits(*parts), size).cast("int")


def pick(values, index: Column) -> Column:
    """Element of a literal list by 0-based index."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index + 1)


def weighted_choice(weights: dict[str, float], roll: Column) -> Column:
    """The first key whose cumulative weight exceeds the roll; the last key takes the rest."""
    keys = list(weights)
    total, edges = 0.0, []
    for key in keys[:-1]:
        total += weights[key]
        edges.append((key, total))
    chain = reduce(
        lambda acc, kv: F.when(roll < kv[1], kv[0]) if acc is None else acc.when(roll < kv[1], kv[0]), edges, None
    )
    return chain.otherwise(keys[-1])


def fill(template: Column, **values: Column) -> Column:
    """Replace each {name} of a template column."""
    out = template
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), value)
    return out

"""Reproducible random draws computed from a row's key.

A draw depends only on (seed, name, key), never on partitioning or row order, so a retried task
or another cluster size produces the same rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(key: Column, seed: int, name: str) -> Column:
    """32 hex digits, enough for four independent draws."""
    return F.md5(F.concat(F.lit(f"{seed}:{name}:"), key.cast("string")))


def uniform(hex_digits: Column, part: int) -> Column:
    """Draw number `part` (0 to 3) of a digest, in the open interval (0, 1)."""
    word = F.conv(F.substring(hex_digits, 1 + 8 * part, 8), 16, 10).cast("double")
    return (word + 0.5) / 4294967296.0


def below(u: Column, n: int) -> Column:
    """Integer in [0, n)."""
    return F.floor(u * n).cast("int")


def pick(u: Column, values: Sequence) -> Column:
    """One of a short list of values, evenly."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), below(u, len(values)) + 1)


def pick_weighted(u: Column, weights: Sequence[int]) -> Column:
    """Index drawn in proportion to its whole-number weight; a zero weight is never drawn."""
    x, reached, chosen = below(u, sum(weights)), 0, None
    for index, weight in enumerate(weights):
        if weight:
            reached += weight
            within = x < reached
            chosen = F.when(within, index) if chosen is None else chosen.when(within, index)
    return chosen


def gauss_pair(u1: Column, u2: Column) -> tuple[Column, Column]:
    """Two independent standard normal draws from two uniform ones (Box-Muller)."""
    radius = F.sqrt(-2.0 * F.ln(u1))
    angle = u2 * (2.0 * math.pi)
    return radius * F.cos(angle), radius * F.sin(angle)


def padded(number: Column, width: int) -> Column:
    """Decimal text with leading zeros; longer numbers keep all their digits."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def pseudonym(user: Column, salt: str) -> Column:
    """First 16 hex digits of the salted SHA-256 of a user id."""
    return F.substring(F.sha2(F.concat(F.lit(f"{salt}:"), user.cast("string")), 256), 1, 16)

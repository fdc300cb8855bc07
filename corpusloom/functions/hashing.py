"""Random choices as pure functions of a seed and row keys.

Every draw is an md5 digest, so it is the same whatever the partitioning, the executor count or
a task retry, and any SQL engine can replay it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(seed: object, *keys: Column) -> Column:
    """32 hex digits for ``seed`` and the row's keys."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys]))


DRAW_DIGITS = 15
DRAWS = 16**DRAW_DIGITS


def draw(seed: object, *keys: Column) -> Column:
    """An integer in [0, ``DRAWS``), the first 60 bits of the digest: wide enough for any row number."""
    return F.conv(F.substring(digest(seed, *keys), 1, DRAW_DIGITS), 16, 10).cast("bigint")


def draw_of(seed: str, *keys: object) -> int:
    """The same number for plain values."""
    text = "|".join([seed, *[str(k) for k in keys]])
    return int(hashlib.md5(text.encode()).hexdigest()[:DRAW_DIGITS], 16)


def uniform(seed: object, *keys: Column) -> Column:
    """A double in [0, 1)."""
    return draw(seed, *keys) / F.lit(float(DRAWS))


def pick(n: Column | int, seed: object, *keys: Column) -> Column:
    """An integer in [0, n)."""
    bound = F.lit(n) if isinstance(n, int) else n
    return F.pmod(draw(seed, *keys), bound.cast("bigint"))

"""Joins whose strategy depends on a measured size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows times bytes a row up to which a build side is broadcast.
BROADCAST_BYTES = 48 * 1024 * 1024


def sized_semi_join(left: DataFrame, keys: DataFrame, on: Sequence[str], row_bytes: int = 64, salts: int = 8, how: str = "left_semi") -> DataFrame:
    """``left`` rows whose ``on`` columns occur in ``keys`` (or don't, with ``left_anti``).

    ``keys`` is counted first. Up to ``BROADCAST_BYTES`` it is broadcast, so a hot
    key of ``left`` is never shuffled. Beyond, both sides shuffle with a salt taken
    from all columns of ``left``, which spreads a hot key over ``salts`` partitions.
    Null keys match nothing. ``keys`` should be a stored table: it is read twice.
    """
    keys = keys.select(*on)
    if keys.count() * row_bytes <= BROADCAST_BYTES:
        return left.join(F.broadcast(keys), list(on), how)
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int"))
    wide = keys.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(wide, [*on, "_salt"], how).drop("_salt")

"""Join helpers for hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_SALT_BUCKETS = 16


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], spread_by: Column,
                buckets: int = DEFAULT_SALT_BUCKETS, how: str = "inner") -> DataFrame:
    """Equi-join where one key of ``big`` may hold a large share of its rows.

    ``big`` rows get a salt from ``spread_by`` (e.g. a document id), ``small``
    (one row per key) is replicated once per salt value, and the join runs on
    (keys, salt): a hot key is split over ``buckets`` tasks instead of one.
    The replicated side grows by ``buckets`` x, so ``small`` should be the
    side with unique keys.
    """
    salt = F.pmod(F.xxhash64(spread_by), F.lit(buckets)).cast("int")
    b = big.withColumn("_salt", salt)
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return b.join(s, [*keys, "_salt"], how).drop("_salt")

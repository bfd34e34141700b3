"""Joining many rows to one row per key when a few keys own much of the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_SALT = 1_000_000
MOST_HOT_KEYS = 100_000
MOST_COMMON_KEYS = 200_000


def join_per_key(
    rows: DataFrame,
    per_key: DataFrame,
    key: str,
    weight: str,
    spread: str,
    rows_per_salt: int = ROWS_PER_SALT,
    most_hot_keys: int = MOST_HOT_KEYS,
) -> DataFrame:
    """Inner join of ``rows`` to ``per_key`` on ``key``, with the heavy keys salted.

    ``per_key`` holds one row per key, and in ``weight`` the number of ``rows`` of it.
    A key of more than ``rows_per_salt`` rows, or of more than the ``most_hot_keys``-th part of
    all rows where that is more, is cut by a hash of ``spread`` into parts of about that size.
    By counting, no more than ``most_hot_keys`` keys can be so heavy: that bounds the broadcast,
    and none of them is left out. The other keys are not copied.

    The hint keeps Spark from broadcasting ``rows``, whose size it underestimates after an
    explode. A merge join spills where a hash table over a large vocabulary would not.
    """
    total = per_key.agg(F.sum(weight)).scalar()
    size = F.greatest(F.lit(rows_per_salt), F.ceil(F.coalesce(total, F.lit(0)) / most_hot_keys))
    hot = (
        per_key.select(key, weight)
        .withColumn("_size", size)
        .where(F.col(weight) > F.col("_size"))
        .select(key, F.ceil(F.col(weight) / F.col("_size")).cast("int").alias("_salts"))
    )
    salts = F.coalesce("_salts", F.lit(1))
    salted_rows = rows.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64(spread), salts), F.lit(0)).cast("int")
    )
    salted_keys = per_key.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), salts - 1))
    )
    salted_keys = salted_keys.drop("_salts").hint("merge")
    return salted_rows.drop("_salts").join(salted_keys, [key, "_salt"]).drop("_salt")


def join_common_apart(
    rows: DataFrame,
    per_key: DataFrame,
    key: str,
    weight: str,
    spread: str,
    most_common_keys: int = MOST_COMMON_KEYS,
) -> DataFrame:
    """As ``join_per_key``, for ``rows`` that cost little to read twice: those of common keys stay where they are.

    A key is common if it has more than a ``most_common_keys``-th part of all rows, so that there are fewer than this
    number of them to broadcast. The rows of all other keys are joined by ``join_per_key``.
    """
    total = per_key.agg(F.sum(weight)).scalar()
    is_common = F.col(weight) > F.ceil(F.coalesce(total, F.lit(0)) / most_common_keys)
    common, others = per_key.where(is_common), per_key.where(~is_common)
    met = rows.join(F.broadcast(common), key)
    rest = rows.join(F.broadcast(common.select(key)), key, "left_anti")
    return met.unionByName(join_per_key(rest, others, key, weight, spread))

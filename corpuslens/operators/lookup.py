"""Join of many rows with a table of their keys, safe against frequent keys."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COMMON_KEYS = 200_000
KEY_BYTES = 64


def join_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    on: str,
    frequency: str,
    key_bytes: Column,
    common_keys: int = COMMON_KEYS,
) -> DataFrame:
    """Inner join of ``rows`` with ``lookup``, which has one row per key.

    ``frequency`` is the number of rows a key has. A key is common if it holds at
    least 1/``common_keys`` of all rows, or, where it is longer than ``KEY_BYTES``, as
    many times that as it is longer. Shares add up to one, so however large the data,
    there are at most ``common_keys`` such keys, of ``common_keys`` x ``KEY_BYTES``
    bytes together: they are broadcast, and their rows, which are most rows for the
    words of a language, are not shuffled. The other rows are, and no key is frequent
    among them.

    Keys are looked up and sorted by a hash, which is one number, and compared where it is equal.
    """
    share = lookup.agg(F.sum(frequency) / F.lit(float(common_keys))).scalar()
    least = share * F.greatest(F.lit(1.0), key_bytes / F.lit(float(KEY_BYTES)))
    common = lookup.filter(F.col(frequency) >= least)
    rare = lookup.filter(F.col(frequency) < least)
    hashed = rows.withColumn("_hash", F.xxhash64(on))
    columns = [F.col(f"`{c}`") for c in (on, *[c for c in rows.columns if c != on], *[c for c in lookup.columns if c != on])]
    # Two comparisons, since an equality would make the key itself a join key again.
    same = (F.col("_hash") == F.col("_hash_of_key")) & (F.col(on) >= F.col("_key")) & (F.col(on) <= F.col("_key"))

    def keyed(part: DataFrame) -> DataFrame:
        return part.withColumn("_hash_of_key", F.xxhash64(on)).withColumnRenamed(on, "_key")

    by_broadcast = hashed.join(F.broadcast(keyed(common)), same)
    others = hashed.join(F.broadcast(keyed(common.select(on))), same, "left_anti")
    by_shuffle = others.join(keyed(rare), same)
    return by_broadcast.select(columns).unionByName(by_shuffle.select(columns))

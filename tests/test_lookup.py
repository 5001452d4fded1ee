import pytest
from pyspark.sql import functions as F

from corpuslens.operators.lookup import join_lookup


@pytest.mark.parametrize("common_keys", [1, 2, 5, 1000])
@pytest.mark.parametrize("key_bytes", [1, 200])
def test_every_row_is_joined_once_whatever_is_broadcast(spark, common_keys, key_bytes):
    # key 0 has a third of the rows, keys 1 to 20 share the others
    rows = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20 + 1).alias("key"), "id"
    )
    lookup = rows.groupBy("key").agg(F.count("*").alias("n"))
    joined = join_lookup(rows, lookup, "key", "n", F.lit(key_bytes), common_keys)
    expected = rows.join(lookup, "key").select("key", "id", "n")
    assert sorted(joined.select("key", "id", "n").collect()) == sorted(expected.collect())


def test_frequent_keys_are_not_shuffled(spark):
    rows = spark.range(300).withColumn("key", F.col("id") % 3)
    lookup = rows.groupBy("key").agg(F.count("*").alias("n"))
    plan = join_lookup(rows, lookup, "key", "n", F.lit(8), 2)._jdf.queryExecution().toString()
    assert "Union" in plan and "BroadcastHashJoin" in plan


def test_keys_meet_by_a_hash_and_are_compared(spark, monkeypatch):
    """Equal hashes of different keys join nothing, and null keys neither."""
    rows = spark.createDataFrame([(f"w{i % 9}" if i % 10 else None, i) for i in range(90)], "key string, id int")
    lookup = rows.filter("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("n"))
    expected = sorted(rows.join(lookup, "key").select("key", "id", "n").collect())
    plan = join_lookup(rows, lookup, "key", "n", F.lit(8), 4)._jdf.queryExecution().optimizedPlan().toString()
    assert "_hash" in plan
    hashed = F.hash
    monkeypatch.setattr(F, "xxhash64", lambda *of: hashed(*of).cast("bigint") % 2)
    found = join_lookup(rows, lookup, "key", "n", F.lit(8), 4)
    assert found.columns == ["key", "id", "n"]
    assert sorted(found.collect()) == expected

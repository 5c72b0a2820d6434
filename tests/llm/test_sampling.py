from pyspark.sql import functions as F

from loadcast.llm.sampling import hashed_sample


def test_size_is_near_the_wanted_one_and_reruns_agree(spark):
    rows = spark.range(20_000).withColumn("text", F.concat(F.lit("t"), "id"))
    one = hashed_sample(rows, 2000, "id", "text")
    again = hashed_sample(rows.repartition(7), 2000, "id", "text")
    ids = {r["id"] for r in one.collect()}
    assert 1700 < len(ids) < 2300 and ids == {r["id"] for r in again.collect()}


def test_small_tables_are_taken_whole(spark):
    assert hashed_sample(spark.range(10), 10, "id").count() == 10
    assert hashed_sample(spark.range(0), 10, "id").count() == 0

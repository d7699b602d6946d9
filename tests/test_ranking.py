"""Ranking with large groups split over tasks equals the plain window."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from shopscope.operators.ranking import row_number_by


def test_row_number_by_matches_window_on_a_written_large_group(spark, tmp_path):
    """A group of 200,000 rows, in two input orders, written out and compared with the plain window."""
    n = 200_000
    base = spark.range(n).select(
        F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.lit("hot")).alias("g"),
        F.when(F.col("id") % 17 == 0, None).otherwise(F.pmod(F.xxhash64("id"), F.lit(300))).alias("d"),
        F.col("id").alias("tie"),
    )
    window = Window.partitionBy("g").orderBy(F.col("d").asc_nulls_first(), F.col("tie").asc_nulls_first())
    slow = base.withColumn("want", F.row_number().over(window)).select("tie", "want")
    for i, df in enumerate((base, base.repartition(7, F.xxhash64("tie", F.lit(5))))):
        path = f"{tmp_path}/ranked{i}"
        row_number_by(df, "g", ["d", "tie"], "rn").write.parquet(path)
        found = spark.read.parquet(path)
        assert found.count() == n
        assert found.join(slow, "tie").where("rn <> want").count() == 0


def test_row_number_by_small_groups(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 1), (None, 4), (None, None)], "g string, d int")
    got = {(r.g, r.d): r.rn for r in row_number_by(df, "g", ["d"], "rn").collect()}
    assert got == {("a", 1): 1, ("a", 2): 2, ("b", 1): 1, (None, None): 1, (None, 4): 2}


def test_top_membership_of_a_customer_with_most_memberships(spark):
    """One customer holds most memberships; ties in all keys but the end date are settled by it."""
    from datetime import datetime

    from shopscope.operators import loyalty as L

    accounts = spark.createDataFrame(
        [(1, 10, "LOYALTY", "A"), (2, 20, "LOYALTY", "A")],
        "customer_id int, loyalty_customer_id int, loyalty_code string, status_ind string",
    )
    start = datetime(2001, 1, 1)
    members = [(10, start, datetime(2001, 2 + i % 9, 1), "WEB") for i in range(5000)] + [(20, start, None, None)]
    member = spark.createDataFrame(members, "loyalty_customer_id int, date_from timestamp_ntz, date_to timestamp_ntz, insert_user string")
    crm = spark.createDataFrame([(1, None, None, "m", None)], "customer_id int, birth_date timestamp_ntz, billing_post_code string, gender string, email_address string")
    store = spark.createDataFrame([(2, "S1")], "customer_id int, store_sign_up string")
    dim = spark.createDataFrame([("S1", "Retail")], "store_code string, store_type string")
    place = spark.createDataFrame([("S1", "3000")], "location_code string, postcode string")
    args = (accounts, member, crm, store, dim, place, datetime(2001, 6, 30))
    top = {r.customer_id: r for r in L.perks_snapshot(*args).collect()}
    assert len(top) == 2 and str(top[1].date_to_f) == "2001-02-01" and top[2].store_sign_up == "S1"
    ranks = [r.uq_cust_rank for r in L.loyalty_base(*args).filter("customer_id = 1").collect()]
    assert sorted(ranks) == list(range(1, 5001))


def test_hot_key_left_join_equals_plain_left_join(spark):
    from collections import Counter

    from shopscope.operators.joins import hot_key_left_join

    left = spark.createDataFrame(
        [(i, "hot" if i % 2 == 0 else f"k{i % 7}") for i in range(400)] + [(1000, None), (1001, "none")],
        "id long, key string",
    )
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("k3", 4), (None, 5)], "key string, v int")
    salted = hot_key_left_join(left, right, "key", F.col("id"), max_key_rows=50, buckets=8)
    plain = left.join(right, "key", "left")
    assert Counter(map(tuple, salted.select("id", "key", "v").collect())) == Counter(
        map(tuple, plain.select("id", "key", "v").collect())
    )

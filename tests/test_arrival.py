"""Stretches of rows in arrival order: any place, ties, nulls, and what is dealt whole for them."""

import pytest
from pyspark.sql import functions as F

from strata.operators import arrival as A

ARRIVAL = ["arrival_ts", "arrival_a"]


def _rows(spark, n=400):
    """Arrivals with nulls, ties and exact copies, not in order."""
    return (spark.range(n).select(
        F.when(F.col("id") % 7 != 0, F.timestamp_seconds(F.col("id") % 50)).cast("timestamp_ntz").alias("arrival_ts"),
        F.when(F.col("id") % 5 != 0, F.col("id") % 3).alias("arrival_a"),
        F.concat(F.lit("v"), F.col("id") % 11).alias("value")).repartition(4).persist())


def _key(r):
    return (r.arrival_ts is not None, str(r.arrival_ts), r.arrival_a is not None, r.arrival_a or 0, r.value)


@pytest.mark.parametrize("skip,take", [(0, 400), (0, 1), (399, 1), (0, 37), (37, 363), (120, 9), (64, 200), (10, 0), (390, 10)])
def test_a_stretch_is_the_sorted_rows_from_place_to_place(spark, skip, take):
    df = _rows(spark)
    want = sorted(map(_key, df.collect()))[skip:skip + take]
    found = A.ranges(df, ARRIVAL)
    assert sum(n for *_, n in found) == 400 and len(found) > 1
    some, kept = A.between(df, ARRIVAL, ["value"], found, skip, take)
    assert sorted(map(_key, some.collect())) == want
    # of all ranges only those that the stretch begins and ends in are dealt whole
    assert len(kept) <= 2 and sum(k.count() for k in kept) <= sum(sorted(n for *_, n in found)[-2:])


def test_rows_that_arrive_at_once(spark):
    df = spark.range(30).select(F.lit(None).cast("timestamp_ntz").alias("arrival_ts"), F.lit(1).alias("arrival_a"),
                                F.concat(F.lit("v"), F.lpad(F.col("id") % 10, 2, "0")).alias("value"))
    some, _ = A.between(df, ARRIVAL, ["value"], A.ranges(df, ARRIVAL), 4, 7)
    assert sorted(r.value for r in some.collect()) == ["v01"] * 2 + ["v02"] * 3 + ["v03"] * 2

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from corvane.operators.lookup import attach, hot_threshold


@pytest.mark.parametrize(("max_hot", "min_hot_rows"), [(100_000, 200_000), (10, 0), (1000, 0), (3, 50)])
def test_attach_is_an_inner_join(spark, max_hot, min_hot_rows):
    random.seed(1)
    keys = ["a"] * 300 + ["b"] * 60 + [f"k{random.randrange(80)}" for _ in range(300)] + ["no facts"]
    left = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key string, i int")
    facts = left.where("key <> 'no facts'").groupBy("key").agg(F.count("*").alias("held"), F.max("i").alias("last"))
    found = attach(left, facts, "key", "held", max_hot=max_hot, min_hot_rows=min_hot_rows)
    assert found.columns == ["key", "i", "held", "last"]
    assert rows(found) == rows(left.join(facts, "key"))


def test_fewer_keys_are_hot_than_may_be(spark):
    random.seed(2)
    for _ in range(5):
        weights = [int(random.paretovariate(0.7)) for _ in range(random.randrange(1, 200))] + [1] * random.randrange(50)
        frame = spark.createDataFrame([(w,) for w in weights], "held long")
        for max_hot in (1, 7, 40):
            limit = frame.agg(hot_threshold(F.sum("held"), max_hot, 0)).first()[0]
            assert sum(w > limit for w in weights) < max_hot

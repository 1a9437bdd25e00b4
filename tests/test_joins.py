import pytest
from pyspark.sql import functions as F

from revtide.operators.joins import lookup_join


@pytest.mark.parametrize("how", ["left", "inner", "left_anti"])
def test_the_plan_is_left_to_spark_and_nothing_runs_early(spark, how):
    facts = spark.range(500).select(
        "id", F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 50).alias("k")
    )
    lookup = spark.range(0, 50, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    joined = lookup_join(facts, lookup.filter(F.raise_error(F.lit("ran")).isNull()), ["k"], how)
    assert "v" in joined.columns or how == "left_anti"
    whole = {r.id: r for r in lookup_join(facts, lookup, ["k"], how).collect()}
    assert len(whole) == {"left": 500, "inner": 84, "left_anti": 416}[how]
    if how != "left_anti":
        assert all(r.v == (r.k * 10 if r.k % 2 == 0 else None) for r in whole.values())

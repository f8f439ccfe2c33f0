"""First rows of keys, found where the rows are dealt by their order."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.operators.dedup import keep_first, keep_first_dealt
from marquee.plans.build import build_lexical
from marquee.sources.storage import joins_where_dealt


def test_equals_keep_first_and_shuffles_whole_rows_once(spark):
    rows = spark.range(500).select(
        (F.col("id") * 7919 % 503).alias("row_ord"),
        F.when(F.col("id") % 41 != 0, (F.col("id") % 60).cast("string")).alias("movie_id"),
        F.concat(F.lit("text "), F.col("id")).alias("plot"),
    )
    place = F.call_function("shiftright", F.col("row_ord"), F.lit(3))
    with joins_where_dealt(spark):
        dealt = keep_first_dealt(rows, ["movie_id"], "row_ord", place, 5)
        assert dealt.columns == rows.columns
        plan = dealt._jdf.queryExecution().executedPlan().toString()
        found = sorted(map(tuple, dealt.withColumn("task", F.spark_partition_id()).select("row_ord", "plot", "task").collect()))
    # Whole rows by place, keys by movie_id, first rows by place.
    assert plan.count("Exchange hashpartitioning") == 3
    first = keep_first(rows, ["movie_id"], "row_ord").select("row_ord", "plot")
    assert [r[:2] for r in found] == sorted(map(tuple, first.collect()))
    tasks: dict = {}
    for order, _, task in found:
        assert tasks.setdefault(order >> 3, task) == task


def test_build_leaves_the_setting_as_it_was(spark, tmp_path):
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    columns = ("movie_name", "year", "rating", "votes", "runtime", "certificate", "cast", "director", "genre", "plot", "meta_score", "gross", "movie_url")
    raw = spark.range(3).select(F.col("id").alias("row_ord"), F.lit("tt1").alias("movie_id"), *[F.lit("5").alias(c) for c in columns])
    build_lexical(spark, raw, str(tmp_path / "site"))
    assert spark.conf.get(key) == before

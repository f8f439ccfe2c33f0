"""Headline timings; prints one JSON line.

Every figure ends in an action that computes all rows (the no-op writer) or in
the tables a build writes. Builds are timed on their own; the searches use what
they wrote, as a search service would. Everything runs twice in one session:
``queries`` holds the second run, ``first_run`` the first one, which also pays
for starting and compiling.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators.batch import batch_top_k
from marquee.operators.clauses import Bool, Fuzzy, Phrase, Range, Term
from marquee.operators.dense import blocked_top_k, inner_product_top_k
from marquee.plans.build import build_dense, build_lexical
from marquee.plans.search import dense_batch_search, lexical_search, top_rated
from marquee.sources.index_tables import open_index
from marquee.sources.dense_index import open_dense
from marquee.functions.vectors import HashedEncoder
from workload.catalog import raw_catalog, table
from workload.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# As wide as the vectors of a usual text model.
ENCODER = HashedEncoder(dim=768)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-checkpoint-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    first, _ = run_all(spark)
    times, rates = run_all(spark)
    print(
        json.dumps(
            {
                "metric": "total_wall_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rates": rates,
                "first_run": first,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


def run_all(spark: SparkSession) -> tuple[dict[str, float], dict[str, float]]:
    out = tempfile.mkdtemp(prefix="bench-site-")
    raw = raw_catalog(spark, SF_DIR)
    times: dict[str, float] = {}
    rates: dict[str, float] = {}

    def timed(name, run):
        started = time.perf_counter()
        result = run()
        times[name] = round(time.perf_counter() - started, 3)
        return result

    report = timed("lexical_build", lambda: build_lexical(spark, raw, out))
    rates["lexical_docs_per_sec"] = round(report["docs"] / times["lexical_build"], 1)
    report = timed("dense_build", lambda: build_dense(spark, raw, out, ENCODER))
    rates["dense_docs_per_sec"] = round(report["docs"] / times["dense_build"], 1)

    index = open_index(spark, f"{out}/lexical")
    vectors, catalog = open_dense(spark, f"{out}/dense")
    queries = table(spark, SF_DIR, "benchmark").select(F.col("item_id").alias("qid"), "text")
    hundred = queries.orderBy("qid").limit(100)
    given = table(spark, SF_DIR, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    given_queries = given.withColumnRenamed("doc_id", "qid")

    searches = {
        "lexical_single": lambda: lexical_search(index, "comedy director the"),
        "lexical_common_word": lambda: lexical_search(index, "the"),
        "lexical_bool": lambda: lexical_search(
            index,
            Bool(must=[Term("drama", "genre"), Range("rating", 8, None)], should=[Phrase("of the", "plot")]),
        ),
        "lexical_fuzzy": lambda: lexical_search(index, Fuzzy("comdey")),
        "top_rated": lambda: top_rated(index),
        "lexical_batch_100": lambda: batch_top_k(index, hundred),
        "lexical_batch_all": lambda: batch_top_k(index, queries),
        "dense_single": lambda: inner_product_top_k(given, given_queries.orderBy("qid").limit(1)),
        "dense_batch_100": lambda: inner_product_top_k(given, given_queries.orderBy("qid").limit(100)),
        "dense_batch_all": lambda: inner_product_top_k(given, given_queries),
        "text_to_vector_batch": lambda: dense_batch_search(vectors, catalog, queries, ENCODER),
        # Every stored vector as a query against all of them: many blocks on both sides.
        "dense_all_pairs": lambda: blocked_top_k(vectors, vectors.withColumnRenamed("doc_id", "qid"), 5),
    }
    for name, run in searches.items():
        timed(name, lambda: drain(run()))
    for name in (
        "clean_catalog", "dedup_full_row", "row_ids", "snippet", "pad_truncate_mask",
        "masked_mean_pool", "first_link_extract", "attach_image_url",
    ):
        timed(name, lambda: drain(QUERIES[name](spark, SF_DIR)))
    return times, rates


if __name__ == "__main__":
    main()

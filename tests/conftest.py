import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from marquee.operators.cleaning import clean_catalog
from marquee.operators.postings import analyze
from marquee.sources.index_tables import open_index, write_index


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


RAW_COLUMNS = (
    "row_ord", "movie_id", "movie_name", "year", "rating", "votes", "runtime", "certificate",
    "cast", "director", "genre", "plot", "meta_score", "gross", "movie_url",
)
RAW_DDL = "row_ord long, " + ", ".join(f"`{c}` string" for c in RAW_COLUMNS[1:])


def raw_row(row_ord, **values):
    filled = {c: "" for c in RAW_COLUMNS[1:]}
    filled.update({"movie_id": f"tt{row_ord}", "movie_name": f"Film {row_ord}"}, **values)
    return (row_ord, *(filled[c] for c in RAW_COLUMNS[1:]))


@pytest.fixture(scope="session")
def make_raw(spark):
    def make(*rows):
        return spark.createDataFrame([raw_row(i, **r) for i, r in enumerate(rows)], RAW_DDL)

    return make


@pytest.fixture(scope="session")
def make_index(spark, make_raw, tmp_path_factory):
    def make(*rows, **settings):
        path = str(tmp_path_factory.mktemp("index"))
        write_index(analyze(clean_catalog(make_raw(*rows))), path)
        return open_index(spark, path, **settings)

    return make

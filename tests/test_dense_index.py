"""Dense index with parts and snapshots: build, append, refusal, failure."""

import pytest
from pyspark.sql import functions as F

from marquee.functions.vectors import HashedEncoder
from marquee.plans import build as B
from marquee.plans.build import append_dense, build_dense
from marquee.plans.search import SearchSite, search
from marquee.sources import dense_index
from marquee.sources.catalog import read_catalog_csv
from test_sources import FILMS, write_csv

ENCODER = HashedEncoder(32)


@pytest.fixture
def raw(spark, tmp_path):
    write_csv(tmp_path / "films.csv", FILMS)
    return read_catalog_csv(spark, str(tmp_path / "films.csv"))


def test_append_adds_vectors_and_catalog_rows(spark, raw, tmp_path):
    out = str(tmp_path / "site")
    build_dense(spark, raw, out, ENCODER)
    more = raw.withColumn("row_ord", F.col("row_ord") + 100).withColumn("movie_id", F.concat(F.lit("new"), "movie_id"))
    report = append_dense(spark, more, out, ENCODER)
    assert report["docs"] == 4
    snapshot, parts = dense_index.latest(spark, f"{out}/dense")
    assert snapshot == 2 and len(parts) == 2
    vectors, catalog = SearchSite(spark, out, ENCODER).dense()
    assert sorted(r["doc_id"] for r in vectors.collect()) == sorted(r["doc_id"] for r in catalog.collect())
    assert vectors.count() == 8
    hits = search(SearchSite(spark, out, ENCODER), "A short description is as follows: stars and stars", "bert", 8).collect()
    assert len(hits) == 8
    assert sum(h["movie_id"].startswith("new") for h in hits) == 4  # appended records are fetched with their fields


def test_append_refuses_ids_the_index_holds(spark, raw, tmp_path):
    out = str(tmp_path / "site")
    build_dense(spark, raw, out, ENCODER)
    with pytest.raises(ValueError):
        append_dense(spark, raw, out, ENCODER)
    assert dense_index.latest(spark, f"{out}/dense")[0] == 1


def test_failed_append_and_rebuild_leave_the_index(spark, raw, tmp_path, monkeypatch):
    out = str(tmp_path / "site")
    build_dense(spark, raw, out, ENCODER)
    monkeypatch.setattr(B, "write_vectors", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        append_dense(spark, raw.withColumn("row_ord", F.col("row_ord") + 100), out, ENCODER)
    with pytest.raises(ZeroDivisionError):
        build_dense(spark, raw.limit(1), out, ENCODER)
    vectors, catalog = SearchSite(spark, out, ENCODER).dense()
    assert vectors.count() == catalog.count() == 4


def test_rebuild_is_one_part(spark, raw, tmp_path):
    out = str(tmp_path / "site")
    build_dense(spark, raw, out, ENCODER)
    append_dense(spark, raw.withColumn("row_ord", F.col("row_ord") + 100), out, ENCODER)
    build_dense(spark, raw, out, ENCODER)
    snapshot, parts = dense_index.latest(spark, f"{out}/dense")
    assert snapshot == 3 and len(parts) == 1 and SearchSite(spark, out).dense()[0].count() == 4


def test_no_index(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        dense_index.open_dense(spark, str(tmp_path / "none"))

import csv
import json

import pytest
from pyspark.sql import functions as F

from marquee.functions.markup import extract_attribute, first_attribute
from marquee.functions.urls import PAGE_BASE, segment_from_end, with_prefix
from marquee.functions.vectors import HashedEncoder
from marquee.operators.clauses import Range, Term
from marquee.operators.topk import HIT_FIELDS, fetch, fetch_known, result_cards, top_k
from marquee.operators.matching import match
from marquee.plans.build import build
from marquee.plans.search import SearchSite, dense_batch_search, lexical_batch_search, search
from marquee.sources import index_tables
from marquee.sources.catalog import CATALOG_COLUMNS, read_catalog_csv
from marquee.sources.hits_json import TEXT_RECORD, hits_from_json, hits_to_json
from marquee.sources.storage import _bytes, partition_size
from marquee.sources.vectors import append_vectors, read_vectors, write_vectors


def write_csv(path, rows):
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.DictWriter(out, CATALOG_COLUMNS)
        writer.writeheader()
        for row in rows:
            writer.writerow({c: row.get(c, "") for c in CATALOG_COLUMNS})


FILMS = [
    {"movie_id": "tt1", "movie_name": 'He said "go"', "plot": "line one\nline two, with a comma", "rating": "8.5",
     "genre": "Drama", "year": "1999", "votes": "1,234", "runtime": "90 min"},
    {"movie_id": "tt2", "movie_name": "Space", "plot": "stars and stars", "rating": "7", "genre": "Short,Comedy"},
    {"movie_id": "tt1", "movie_name": "Later copy", "rating": "1"},
    {"movie_id": "tt2", "movie_name": "Space", "plot": "stars and stars", "rating": "7", "genre": "Short,Comedy"},
    {"movie_id": "tt3", "movie_name": " padded ", "rating": "9.9", "year": "2001.0"},
]


def test_csv_scan_keeps_text_and_order(spark, tmp_path):
    write_csv(tmp_path / "a.csv", FILMS[:3])
    write_csv(tmp_path / "b.csv", FILMS[3:])
    rows = read_catalog_csv(spark, str(tmp_path)).orderBy("row_ord").collect()
    assert [r["movie_name"] for r in rows] == [f["movie_name"] for f in FILMS]
    assert rows[0]["plot"] == FILMS[0]["plot"] and rows[1]["cast"] == "" and rows[1]["year"] == ""
    assert len({r["row_ord"] for r in rows}) == 5


def test_csv_columns_go_by_name(spark, tmp_path):
    columns = ["extra", *reversed(CATALOG_COLUMNS)]
    row = {**{c: c for c in columns}, "plot": "NA", "cast": ""}
    with open(tmp_path / "a.csv", "w", newline="") as out:
        writer = csv.DictWriter(out, columns)
        writer.writeheader()
        writer.writerow(row)
    got = read_catalog_csv(spark, str(tmp_path / "a.csv")).first().asDict()
    assert got.pop("row_ord") == 0 and got == row
    (tmp_path / "b.csv").write_text("movie_id,plot\n1,2\n")
    with pytest.raises(ValueError, match="missing"):
        read_catalog_csv(spark, str(tmp_path / "b.csv"))


def test_csv_scan_in_splits(spark, tmp_path):
    rows = [{"movie_id": f"tt{i}", "movie_name": f"Film {i}", "plot": "x" * (i % 50)} for i in range(3000)]
    write_csv(tmp_path / "a.csv", rows[:1000])
    write_csv(tmp_path / "b.csv", rows[1000:])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = read_catalog_csv(spark, str(tmp_path), multi_line=False)
        assert df.rdd.getNumPartitions() > 4
        got = [(r["row_ord"], r["movie_id"]) for r in df.orderBy("row_ord").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [(i, f"tt{i}") for i in range(3000)]


@pytest.fixture(scope="module")
def site(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("films")
    write_csv(folder / "sample.csv", FILMS)
    out = str(tmp_path_factory.mktemp("site"))
    encoder = HashedEncoder(32)
    reports = build(spark, str(folder / "sample.csv"), out, encoder=encoder)
    return SearchSite(spark, out, encoder), reports


def test_build_reports(site):
    _, reports = site
    assert reports["lexical"]["docs"] == 3 and reports["dense"]["docs"] == 4
    assert reports["lexical"]["seconds"] > 0


def test_build_one_kind_or_refuse(spark, site, tmp_path):
    with pytest.raises(ValueError):
        build(spark, "x", str(tmp_path), which={"other"})


def test_lexical_search_end_to_end(site):
    place, _ = site
    (hit,) = search(place, "comma", "lexical", 5).collect()
    assert (hit["rank"], hit["movie_id"], hit["votes"], hit["runtime"]) == (1, "tt1", 1234, 90)
    assert [r["movie_id"] for r in search(place, Range("rating", 8.0, None), "anything", 5).collect()] == ["tt1", "tt3"]
    assert [r["name"] for r in search(place, "short", "", 5).collect()] == ["Space"]


def test_dense_search_end_to_end(site):
    place, _ = site
    hits = search(place, "A short description is as follows: stars and stars", "bert", 10).collect()
    assert len(hits) == 4 and [h["rank"] for h in hits] == [1, 2, 3, 4]
    assert hits[0]["name"] == "Space" and isinstance(hits[0]["score"], str) and hits[0]["year"] == ""
    assert float(hits[0]["score"]) >= float(hits[1]["score"])
    with pytest.raises(ValueError):
        search(place, Term("x"), "bert")


def test_batches_end_to_end(spark, site):
    place, _ = site
    queries = spark.createDataFrame([(1, "comma"), (2, "stars space"), (3, "absent")], "qid long, text string")
    got = {(r["qid"], r["rank"]): r["movie_id"] for r in lexical_batch_search(place.lexical(), queries, 2).collect()}
    assert got == {(1, 1): "tt1", (2, 1): "tt2"}
    dense = dense_batch_search(*place.dense(), queries, place.encoder, 2)
    assert sorted((r["qid"], r["rank"]) for r in dense.collect()) == [(q, k) for q in (1, 2, 3) for k in (1, 2)]


def test_rebuild_replaces(spark, site, tmp_path):
    write_csv(tmp_path / "one.csv", FILMS[:1])
    out = str(tmp_path / "site")
    for source in (FILMS, FILMS[:1]):
        write_csv(tmp_path / "one.csv", source)
        build(spark, str(tmp_path / "one.csv"), out, which={"lexical"})
    assert SearchSite(spark, out).lexical().docs.count() == 1


def test_failed_rebuild_leaves_the_index(spark, tmp_path, monkeypatch):
    write_csv(tmp_path / "films.csv", FILMS)
    out = str(tmp_path / "site")
    build(spark, str(tmp_path / "films.csv"), out, which={"lexical"})
    monkeypatch.setattr(index_tables.P, "term_stats", lambda postings: 1 / 0)
    write_csv(tmp_path / "films.csv", FILMS[:1])
    with pytest.raises(ZeroDivisionError):
        build(spark, str(tmp_path / "films.csv"), out, which={"lexical"})
    index = SearchSite(spark, out).lexical()
    assert index.docs.count() == index.points.count() == 3


def test_hits_json(site):
    place, _ = site
    index = place.lexical()
    hits = fetch(top_k(match(index, Range("rating", None, None)), 5), index.stored)
    text = hits_to_json(hits).first()["hits"]
    records = json.loads(text)
    assert [list(r) for r in records] == [list(HIT_FIELDS)] * 3 and records[0]["score"] == 1.0
    as_text = json.loads(hits_to_json(hits, stringify=True).first()["hits"])
    assert as_text[0]["year"] == "1999" and as_text[0]["score"] == "1.0"
    back = hits_from_json(hits_to_json(hits)).orderBy("rank").collect()
    assert [tuple(r) for r in back] == [
        tuple(r) for r in hits.select("rank", *HIT_FIELDS).orderBy("rank").collect()
    ]
    typed = hits_from_json(hits_to_json(hits, stringify=True), record=TEXT_RECORD)
    assert typed.filter("rank = 1").first()["rating"] == "8.5"


def test_result_cards(site):
    place, _ = site
    index = place.lexical()
    card = result_cards(fetch(top_k(match(index, Term("1999", "year")), 1), index.stored)).first()
    assert card["title_url"] == "https://imdb.com/title/tt1" and card["rating"] == 8.5


def test_lookups_prune_folders_and_row_groups(site):
    index = site[0].lexical()
    plan = match(index, Term("stars", "plot"))._jdf.queryExecution().executedPlan().toString()
    assert "field" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert "term" in plan.split("PushedFilters:")[1].split("]")[0]


def test_hits_name_their_folders(spark, site):
    index = site[0].lexical()
    hits = top_k(match(index, Term("stars", "plot")), 5)
    for found in (fetch(hits, index.stored), fetch_known(hits, index.stored)):
        assert [r["name"] for r in found.collect()] == ["Space"]
        plan = found._jdf.queryExecution().executedPlan().toString()
        filters = [part.split("]")[0] for part in plan.split("PartitionFilters:")[1:]]
        assert any("doc_bucket" in f and " 0" in f for f in filters), filters
    nothing = top_k(match(index, Term("absent")), 5)
    assert fetch(nothing, index.stored).count() == fetch_known(nothing, index.stored).count() == 0


def test_vectors_append(spark, tmp_path):
    rows = spark.createDataFrame([(1, [1.0])], "doc_id long, embedding array<float>")
    path = str(tmp_path / "v")
    write_vectors(rows, path)
    append_vectors(rows.withColumn("doc_id", F.lit(2).cast("long")), path)
    assert sorted(r["doc_id"] for r in read_vectors(spark, path).collect()) == [1, 2]
    write_vectors(rows, path)
    assert read_vectors(spark, path).count() == 1


def test_partition_size_is_put_back(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    with partition_size(spark, 0):
        assert _bytes(spark.conf.get(key)) == 1 << 20
    assert spark.conf.get(key) == before
    with partition_size(spark, 1 << 60):
        assert spark.conf.get(key) == before
    assert [_bytes(s) for s in ("64MB", "1g", "512", "67108864b")] == [64 << 20, 1 << 30, 512, 67108864]


PAGE = """<html><body><a class="x" href="/no">n</a>
<a class="lockup focusable" href="/title/tt1/mediaviewer/rm7/?a=1&amp;b=2">y</a>
<img data-image-id="rm7-curr" src="http://i/7.jpg"/><img data-image-id="rm8-curr" src="http://i/8.jpg">
<script>var t = '<a class="late" href="/script">';</script></body></html>"""


def test_first_attribute():
    assert first_attribute(PAGE, "a", "class", "lockup focusable", "href") == "/title/tt1/mediaviewer/rm7/?a=1&b=2"
    assert first_attribute(PAGE, "a", "class", "focusable", "href").startswith("/title/")
    assert first_attribute(PAGE, "a", "class", "focusable lockup", "href") is None
    assert first_attribute(PAGE, "a", "class", "late", "href") is None
    assert first_attribute(PAGE, "a", "href", None, "href") == "/no"
    assert first_attribute(PAGE, "img", "data-image-id", "rm8-curr", "src") == "http://i/8.jpg"
    assert first_attribute("<p>", "a", "href", None, "href") is None
    assert first_attribute(None, "a", "href", None, "href") is None


def test_image_lookup_over_pages(spark):
    """Link from one page, image id from the link, image from the other page."""
    pages = spark.createDataFrame([(1, PAGE), (2, "<p>none</p>"), (3, None)], "id int, html string")
    link = with_prefix(PAGE_BASE, extract_attribute(F.col("html"), "a", "class", "lockup focusable", "href"))
    linked = pages.withColumn("link", link).withColumn("image_id", segment_from_end(F.col("link")))
    image = extract_attribute(F.col("html"), "img", "data-image-id", F.col("image_id"), "src")
    got = {r["id"]: (r["image_id"], r["src"]) for r in linked.withColumn("src", image).collect()}
    assert got == {1: ("rm7-curr", "http://i/7.jpg"), 2: (None, None), 3: (None, None)}


@pytest.mark.parametrize("multi_line", [True, False])
def test_csv_record_with_a_field_too_many_is_an_error(spark, tmp_path, multi_line):
    write_csv(tmp_path / "a.csv", FILMS[:2])
    with open(tmp_path / "a.csv", "a") as out:
        out.write(",".join(["x"] * len(CATALOG_COLUMNS)) + ",surplus\n")
    with pytest.raises(Exception, match="more fields"):
        read_catalog_csv(spark, str(tmp_path / "a.csv"), multi_line=multi_line).collect()

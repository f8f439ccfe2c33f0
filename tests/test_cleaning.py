import pytest
from pyspark.sql import functions as F

from marquee.functions.scoring import byte4_length
from marquee.functions.text import (
    attention_mask,
    genre_without_short,
    pad_or_truncate,
    strip_trailing_chars,
    tokenize,
    whole_number,
)
from marquee.functions.urls import segment_from_end
from marquee.operators.cleaning import clean_catalog, with_all_fields
from marquee.operators.dedup import (
    attach_column,
    distinct_rows,
    keep_first,
    patch_ids,
    with_row_positions,
)
from marquee.operators.snippet import snippet


def values(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("t"))).collect()]


def test_trailing_characters_are_a_set(spark):
    texts = ["1,234 min", "27 min", "0", "min", "90 nim", " 5 min ", ""]
    assert values(spark, texts, lambda c: strip_trailing_chars(c, " min")) == [t.rstrip(" min") for t in texts]


def test_whole_number_lenient_and_strict(spark):
    assert values(spark, ["2023.0", "2023"], whole_number) == [2023, 2023]
    assert values(spark, ["2023"], lambda c: whole_number(c, strict=True)) == [2023]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, ["2023.0"], lambda c: whole_number(c, strict=True))


def test_genre_items(spark):
    texts = ["Short,Comedy,Drama", "Comedy,Short", "Drama", "Short", "Comedy,Short,War", ""]
    assert values(spark, texts, genre_without_short) == ["Comedy,Drama", "Comedy", "Drama", "", "Comedy,War", ""]


def test_tokenize_word_breaks(spark):
    cases = {
        "Don't stop": ["don't", "stop"],
        "dogs' 3.14 1,000 a.b": ["dogs", "3.14", "1,000", "a.b"],
        "snake_case _x_ ___ end.": ["snake_case", "_x_", "end"],
        "sci-fi/50%": ["sci", "fi", "50"],
        "Élan ÜBER": ["élan", "über"],
        "日本 ひと カタカナ 한국": ["日", "本", "ひ", "と", "カタカナ", "한국"],
        "user@mail.example.com 2x": ["user", "mail.example.com", "2x"],
        "": [],
    }
    assert values(spark, list(cases), tokenize) == list(cases.values())
    assert values(spark, [None], tokenize) == [[]]


def test_tokenize_very_long_runs(spark):
    texts = ["a" * 50_000, "a1" * 30_000, "a." * 30_000 + "a", "_" * 40_000, "1," * 20_000 + "1"]
    assert [len(t) for t in values(spark, texts, tokenize)] == [1, 1, 1, 0, 1]


def test_pad_and_mask(spark):
    df = spark.sql("select split(t, ' ') as t from values ('a b c'), ('a b c d e'), ('a') v(t)")
    rows = df.select(pad_or_truncate(F.col("t"), 4, "-").alias("p"), attention_mask(F.col("t"), 4).alias("m"))
    got = {("".join(r["p"]), tuple(r["m"])) for r in rows.collect()}
    assert got == {("abc-", (1, 1, 1, 0)), ("abcd", (1, 1, 1, 1)), ("a---", (1, 0, 0, 0))}


def test_byte4_lengths(spark):
    df = spark.range(0, 5000).select(F.col("id").cast("int").alias("n"))
    kept = {r["n"]: r["k"] for r in df.select("n", byte4_length(F.col("n")).alias("k")).collect()}
    assert all(kept[n] == n for n in range(41))
    assert (kept[41], kept[57], kept[1000]) == (40, 56, 984)
    for n in range(41, 5000):
        over = n - 24
        step = 1 << (over.bit_length() - 4)
        assert kept[n] == 24 + over // step * step


def test_clean_catalog(spark, make_raw):
    raw = make_raw(
        {"year": "2023.0", "rating": "6.8", "votes": "1,896", "runtime": "1,027 min", "cast": "A,B", "plot": "P"},
        {},
    )
    first, second = clean_catalog(raw).orderBy("row_ord").collect()
    assert (first["year"], first["votes"], first["runtime"], first["plot"]) == (2023, 1896, 1027, "P")
    assert (second["year"], second["votes"], second["runtime"], second["rating"]) == (0, 0, 0, 0.0)
    assert [second[c] for c in ("cast", "director", "genre", "plot", "certificate")] == ["Unknown"] * 5
    assert not {"meta_score", "gross", "movie_name"} & set(clean_catalog(raw).columns)
    bodies = [r[0] for r in with_all_fields(clean_catalog(raw)).orderBy("row_ord").select("all_fields").collect()]
    assert bodies == ["Film 0 A,B Unknown Unknown Unknown 2023 P", "Film 1 Unknown Unknown Unknown Unknown 0 Unknown"]


def test_keep_first_by_order_with_a_hot_key(spark):
    rows = spark.range(10_000).select(
        (F.lit(9_999) - F.col("id")).alias("ord"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"),
    )
    kept = keep_first(rows, ["key"], "ord")
    assert kept.count() == 1 + rows.filter("key <> 'hot'").count()
    assert kept.filter("key = 'hot'").first()["ord"] == 0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_distinct_rows_keep_lowest_order(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b")], "o long, t string")
    assert {tuple(r) for r in distinct_rows(df, "o").collect()} == {(1, "a"), (2, "b")}
    assert distinct_rows(df.select("t")).count() == 2


@pytest.mark.parametrize("order", ["id * 7 + id % 3", "xxhash64(id)", "id * 1000000000000 - 7"])
def test_row_positions_of_dense_and_sparse_ids(spark, order):
    df = spark.range(0, 5000).selectExpr(f"{order} as o")
    got = with_row_positions(df, "o").orderBy("o").collect()
    assert [r["doc_pos"] for r in got] == list(range(5000))


def test_snippet_sentences(spark, make_raw):
    raw = make_raw(
        {"genre": "Short,Comedy", "cast": "X", "director": "Y", "year": "1999.0", "plot": "It ends"},
        {"genre": "Short"},
        {},
    )
    assert [r[0] for r in raw.orderBy("row_ord").select(snippet()).collect()] == [
        "The short film is titled Film 0.It stars X.It was directed by Y.It is of the genre(s) Comedy."
        "It was released on 1999.A short description is as follows: It ends",
        "The short film is titled Film 1.It is of the genre(s) .",
        "The film is titled Film 2.",
    ]


def test_patch_and_attach(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "movie_id string, n int")
    fixes = spark.createDataFrame([("b", "c")], "movie_id string, new_id string")
    assert {tuple(r) for r in patch_ids(rows, fixes).collect()} == {("a", 1), ("c", 2)}
    images = spark.createDataFrame([("a", "u")], "movie_id string, image_url string")
    got = {r["movie_id"]: r["image_url"] for r in attach_column(rows, images, "movie_id", "image_url").collect()}
    assert got == {"a": "u", "b": None}


def test_url_segment(spark):
    texts = ["https://h/title/tt1/mediaviewer/rm42/", "https://h/x", "plain"]
    assert values(spark, texts, segment_from_end) == ["rm42-curr", "h-curr", None]

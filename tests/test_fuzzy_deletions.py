"""Fuzzy candidates by deletion keys against the edit-distance test over the whole vocabulary."""

import pytest
from pyspark.sql import functions as F

from marquee.operators import postings as P
from marquee.operators.clauses import Fuzzy
from marquee.operators.matching import Matcher, edit_distance
from marquee.plans.build import build_lexical
from marquee.sources.index_tables import open_index
from workload.catalog import lexical_index, raw_catalog

SF = "/root/testdata/sf0.01"


def test_deletion_keys(spark):
    df = spark.createDataFrame([("abc",), ("a",), ("",)], "term string")
    got = {r["term"]: sorted(r["keys"]) for r in df.select("term", P.deletion_keys(F.col("term")).alias("keys")).collect()}
    assert got == {"abc": sorted(["abc", "bc", "ac", "ab", "a", "b", "c"]), "a": ["", "a"], "": [""]}


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("fuzzy-site"))
    build_lexical(spark, raw_catalog(spark, SF), out, fuzzy_keys=True)
    return open_index(spark, f"{out}/lexical")


def test_without_the_table_the_vocabulary_is_tested(spark):
    index = lexical_index(spark, SF)
    assert index.deletions is None
    found = Matcher(index, Fuzzy("then", "plot"))._fuzzy_candidates("then", "plot", 2)
    assert found.count() == index.terms.filter(F.col("field") == "plot").count()


@pytest.mark.parametrize("text, field, edits", [("then", "plot", 2), ("thsi", "plot", 2), ("comdey", "all_fields", 2), ("dram", "genre", 1), ("a", "plot", 2), ("teh", "plot", 1), ("zzzzzz", "plot", 2)])
def test_candidates_hold_every_near_term(spark, index, text, field, edits):
    shorter = F.least(F.length("term"), F.lit(len(text)))
    allowed = F.least(F.lit(edits), F.greatest(shorter - 1, F.lit(0)))
    near = lambda terms: sorted(r["term"] for r in terms.filter(edit_distance(F.col("term"), text, edits) <= allowed).select("term").collect())
    every = index.terms.filter(F.col("field") == field)
    found = Matcher(index, Fuzzy(text, field, edits))._fuzzy_candidates(text, field, edits)
    assert near(found) == near(every)
    assert found.count() < every.count() or every.count() == 0


def test_long_text_scans_the_vocabulary(spark, index):
    text = "x" * (P.MAX_DELETION_LEN - 1)
    found = Matcher(index, Fuzzy(text, "plot"))._fuzzy_candidates(text, "plot", 2)
    assert found.count() == index.terms.filter(F.col("field") == "plot").count()

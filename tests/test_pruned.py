"""Top k of text queries by range bounds against plain scoring of all postings."""

import pytest

from marquee.operators.clauses import Term
from marquee.operators.matching import match
from marquee.operators.pruned import candidate_ranges, pruned_top_k
from marquee.operators.topk import top_k
from workload.catalog import lexical_index

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def index(spark):
    return lexical_index(spark, SF)


def rows(df):
    return [tuple(r) for r in df.select("rank", "doc_id", "score").orderBy("rank").collect()]


@pytest.mark.parametrize(
    "clause, k",
    [
        (Term("the"), 5), (Term("the"), 1), (Term("the comedy"), 10), (Term("comedy director the"), 5),
        (Term("the the of"), 7), (Term("drama", "genre"), 50), (Term("actor", "cast"), 3), (Term("zzzz unknown"), 5),
        (Term("the"), 2000),
    ],
)
def test_equals_plain_scoring(spark, index, clause, k):
    assert rows(pruned_top_k(index, clause, k)) == rows(top_k(match(index, clause), k))


def test_equal_under_other_scoring(spark, index):
    other = index.with_scoring(k1=0.5, b=0.9, norms="byte4")
    assert rows(pruned_top_k(other, Term("the of"), 5, 4)) == rows(top_k(match(other, Term("the of")), 5, 4))


def test_common_word_reads_few_ranges(spark, index):
    _, _, chosen, total = candidate_ranges(index, Term("the"), 5)
    assert total >= 8 and chosen <= total // 2


def test_numbers_fall_back(spark, index):
    assert rows(pruned_top_k(index, Term("1984", "year"), 5)) == rows(top_k(match(index, Term("1984", "year")), 5))

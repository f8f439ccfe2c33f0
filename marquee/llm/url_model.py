"""URL filter: explicit rules first, a character model ratio for the rest.

Two Markov models over characters of host and path, one for accepted and one for
rejected URLs, use contexts of up to two characters, each order smoothed by the
one below it (Witten-Bell). A URL's score is the mean log-likelihood difference
per character; it is blocked below a threshold that is calibrated on a held-out
fold of accepted URLs.

The alphabet folds characters into 32 codes, so a model is one array of 32^3
numbers whatever the size of the corpus: it is looked up inside the expression,
without a join. Everything is built-in functions.

Defined cases: a null URL, or one without ``://``, has empty host and path, fits
no rule and is allowed (nothing speaks against it); ties and repeated rows are
scored alike; without accepted or without rejected URLs to learn from, the
method allows all.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.sources.storage import scratch_path, write_table

ALPHABET = "abcdefghijklmnopqrstuvwxyz0./-"  # codes 1 to 30; 0 is the start, 31 all else
CODES = 32
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"

#: Hosts whose names hold one of these words are the rejected examples.
REJECTED_TERMS = ("spam", "pills", "casino", "viagra", "porn", "xxx", "malware", "phish", "warez")
HELD_OUT_FOLDS = 10
HELD_OUT_QUANTILE = 0.01


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    UrlRule(BLOCK, "net", "/"),
    UrlRule(ALLOW, "example.net", "/en/"),
    UrlRule(BLOCK, "example.com", "/de/"),
    UrlRule(ALLOW, "org", "/fr/"),
)


def with_host_path(rows: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``."""
    at = F.locate("://", F.col(url))
    rest = F.when(at > 0, F.col(url).substr(at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract("_rest", r"^[^/?#]*", 0)
    path = F.regexp_extract(F.col("_rest").substr(F.length(host) + 1, F.length("_rest")), r"^[^?#]*", 0)
    return (
        rows.withColumn("_rest", F.coalesce(rest, F.lit("")))
        .withColumns({"host": F.translate(host, UPPER, LOWER), "path": path})
        .drop("_rest")
    )


def rule_of(rules=RULES) -> Column:
    """The longest rule that fits, as a struct of its text and verdict, or null."""
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        best = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(best)
    return best


def codes() -> Column:
    """Code of each character of host and path; digits are one character."""
    text = F.translate(F.lower(F.concat("host", "path")), "123456789", "000000000")
    letters = F.filter(F.split(text, ""), lambda c: c != "")
    return F.transform(
        letters, lambda c: F.coalesce(F.nullif(F.position(c, F.lit(ALPHABET)), F.lit(0)), F.lit(CODES - 1))
    )


def trigrams() -> Column:
    """For each character the index of it with the two characters before, from
    ``code``; shifted copies are added as wholes, which reads each code once."""
    shifted = lambda by: F.slice(F.concat(F.array(*[F.lit(0)] * by), "code"), F.lit(1), F.size("code"))
    pairs = F.zip_with(shifted(1), "code", lambda b, c: b * CODES + c)
    return F.zip_with(shifted(2), pairs, lambda a, bc: a * CODES * CODES + bc)


def train(labelled: DataFrame) -> str | None:
    """The model of rows (``grams``, ``rejected``): the log ratio of each
    trigram as a JSON array, or None if a class is missing.

    Only the counts of at most 2 * 32^3 trigrams leave the executors, combined
    per task before they are shuffled.
    """
    spark = labelled.sparkSession
    counts = (
        # explode_outer: for explode, Spark adds a filter that computes the codes twice.
        labelled.select("rejected", F.explode_outer("grams").alias("gram"))
        .where("gram is not null")
        .groupBy("gram")
        .agg(*[F.sum((F.col("rejected") == bad).cast("long")).alias(name) for name, bad in (("n_a", False), ("n_r", True))])
    )
    counts = write_table(counts, scratch_path(spark, "trigrams"))
    table = spark.range(CODES**3).select(F.col("id").cast("int").alias("gram")).join(F.broadcast(counts), "gram", "left").na.fill(0)
    table = table.withColumns(
        {"c": F.col("gram") % CODES, "bc": F.col("gram") % CODES**2, "b": F.floor((F.col("gram") % CODES**2) / CODES), "ab": F.floor(F.col("gram") / CODES)}
    )
    for k in ("a", "r"):
        table = _smoothed(table, f"n_{k}", f"p_{k}")
    row = table.agg(
        F.sum("n_a").alias("n_a"),
        F.sum("n_r").alias("n_r"),
        F.transform(
            F.array_sort(F.collect_list(F.struct("gram", F.round(F.log(F.col("p_a") / F.col("p_r")), 5).alias("v")))),
            lambda x: x["v"],
        ).alias("ratio"),
    ).first()
    return json.dumps(row["ratio"]) if row["n_a"] and row["n_r"] else None


def _smoothed(table: DataFrame, n: str, p: str) -> DataFrame:
    """Adds the probability of each character given the two before it."""
    one = table.groupBy("c").agg(F.sum(n).alias("n1"))
    everything = Window.partitionBy()  # 32 rows
    one = one.withColumns({"t": F.sum("n1").over(everything), "d": F.greatest(F.sum((F.col("n1") > 0).cast("int")).over(everything), F.lit(1))})
    one = one.select("c", ((F.col("n1") + F.col("d") / CODES) / (F.col("t") + F.col("d"))).alias("p1"))
    two = table.groupBy("b", "c").agg(F.sum(n).alias("n2"))
    two_of = two.groupBy("b").agg(F.sum("n2").alias("t"), F.sum((F.col("n2") > 0).cast("int")).alias("d"))
    two = two.join(two_of, "b").join(one, "c")
    two = two.select("b", "c", F.when(F.col("t") > 0, (F.col("n2") + F.col("d") * F.col("p1")) / (F.col("t") + F.col("d"))).otherwise(F.col("p1")).alias("p2"))
    three_of = table.groupBy("ab").agg(F.sum(n).alias("t"), F.sum((F.col(n) > 0).cast("int")).alias("d"))
    joined = table.join(three_of, "ab").join(two, ["b", "c"])
    value = F.when(F.col("t") > 0, (F.col(n) + F.col("d") * F.col("p2")) / (F.col("t") + F.col("d"))).otherwise(F.col("p2"))
    return joined.withColumn(p, value).drop("t", "d", "p2")


def score(model: str) -> Column:
    """Mean log-likelihood difference per character; null for an empty URL."""
    ratio = F.from_json(F.lit(model), "array<double>")
    total = F.aggregate("grams", F.lit(0.0), lambda s, g: s + F.get(ratio, g))
    return F.when(F.size("grams") > 0, F.round(total / F.size("grams"), 6))


def rejected_example(terms=REJECTED_TERMS) -> Column:
    return F.col("host").rlike("|".join(terms))


def judge_urls(pages: DataFrame, rules=RULES, terms=REJECTED_TERMS, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """``keep``, host, path, rule, verdict, score and threshold of each row."""
    parsed = with_host_path(pages.select(*keep, F.col("url").alias("_url")), "_url").drop("_url")
    coded = parsed.withColumns({"code": codes()}).withColumn("grams", trigrams()).drop("code")
    fold = F.pmod(F.xxhash64("host", "path"), F.lit(HELD_OUT_FOLDS))
    labelled = coded.where(F.col("host") != "").select("grams", fold.alias("fold"), rejected_example(terms).alias("rejected"))
    model = train(labelled.where("fold > 0"))
    threshold = None
    if model is not None:
        held_out = labelled.where("fold = 0 and not rejected").select(score(model).alias("s"))
        threshold = held_out.agg(F.percentile_approx("s", HELD_OUT_QUANTILE, 10_000)).first()[0]
        threshold = min(0.0, threshold if threshold is not None else 0.0)
    scored = coded.withColumn("fit", rule_of(rules)).withColumn("score", score(model) if model else F.lit(None).cast("double"))
    by_model = F.when(F.col("score") < F.lit(threshold).cast("double"), BLOCK).otherwise(ALLOW)
    return scored.select(
        *keep, "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", by_model).alias("verdict"),
        "score", F.lit(threshold).cast("double").alias("threshold"),
    )

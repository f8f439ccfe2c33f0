"""The pipeline, stage by stage, against brute force on a small folder of tables."""

import math
import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

import __spark_entry__ as entry_points
import corpus_pipeline
from marquee.llm import kneser_ney, tokens
from samples import sentence
from test_duplicates import brute_classes, brute_spans
from test_rules_and_classifier import exact_perplexity, measures

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, corpus, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(8)
    junk = [(900 + i, " ".join("".join(rng.choice("qxzjkvw") for _ in range(7)) for _ in range(80))) for i in range(4)]
    rows = [(i, t, "en" if (i or 0) % 2 else "fr", "s", len(t or "")) for i, t in (*corpus, *junk, *((1000 + k, sentence(rng, 80)) for k in range(30)))]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(0, 20)] + [(900, 0, 0), (1001, 1, 0), (1002, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = [[tuple(r) for r in docs.collect()]]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        seen.append([tuple(r) for r in docs.collect()])
        if i < 4:
            assert [f.simpleString() for f in docs.schema] == [f.strip().replace(" ", ":").replace("long", "bigint") for f in SCHEMA.split(",")]
    raw, ruled, judged, distinct, trimmed, packed = seen
    known = {r[1] for r in ruled}

    def clean(text):
        m = measures(text)
        if m[5] is None:  # too long for brute force
            return text in known
        return not (
            m[0] < 50 or 100 * m[5] > 50 * m[0] or 10 * m[2] > m[0] or 100 * m[4] > 45 * m[3] or m[1] < 2 * m[0] or m[1] > 15 * m[0]
        )

    assert sorted(map(str, ruled)) == sorted(str(r) for r in raw if clean(r[1]))
    labels = {r["doc_id"] for r in spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1 and toxic = 0").collect()}
    trusted = [r for r in ruled if r[0] in labels]
    perplexity = exact_perplexity([r[1] for r in trusted])
    values = {r[1]: perplexity(r[1]) if r[1] else None for r in ruled}

    def limit_of(rows):
        ranked = sorted(values[r[1]] for r in rows if values[r[1]] is not None)
        return ranked[max(math.ceil(kneser_ney.QUANTILE * len(ranked)) - 1, 0)] * kneser_ney.MARGIN

    general = limit_of(trusted)
    limits = {lang: limit_of([r for r in trusted if (r[2] or "") == lang]) for lang in {r[2] or "" for r in trusted}}
    assert sorted(map(str, judged)) == sorted(str(r) for r in ruled if r[1] and values[r[1]] <= limits.get(r[2] or "", general))
    assert not any(r[0] and 900 <= r[0] < 904 for r in judged)
    classes = brute_classes([r[:2] for r in judged])
    assert len(distinct) == len({c if c[0] is not None else (r[0], r[1]) for c, r in zip(classes, judged)})
    assert {r[0] for r in distinct} == {c[0] for c in classes}
    assert set(distinct) <= set(judged)
    spans = brute_spans([r[1].encode() for r in distinct], corpus_pipeline.REPEATED)
    assert sum(n for _, n, _, _ in spans) > 0
    left = {r[0]: r for r in trimmed}
    for r, (size, removed, _, _) in zip(distinct, spans):
        assert left[r[0]][2:4] == r[2:4] and left[r[0]][4] == len(left[r[0]][1])
        assert len(left[r[0]][1].encode()) == size - removed
        assert removed or left[r[0]] == r
    plain = tokens.load(tokens.tokenizer_path("byte_bpe_50k.json"))
    lengths = {r[0]: len(plain.encode(r[1], add_special_tokens=False).ids) + 1 for r in trimmed}
    total = dict.fromkeys(lengths, 0)
    for r in packed:
        total[r[0]] += r[3]
    assert total == lengths


def test_run_and_registration(spark, folder):
    names = [n for n in entry_points.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry_points.queries()
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    rows = corpus_pipeline.run(spark, folder)
    assert rows.count() > 0 and int(np.sum([r["length"] for r in rows.collect()])) > 0

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from marquee.llm import prefix_trie


def brute(rows):
    """Conversations rebuilt, every prefix a node, subtrees by walking the trie."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn, role or "", text or ""))
    for c in own:
        own[c] = [(r, t) for _, r, t in sorted(own[c], key=lambda x: (x[0] is not None, x[0] if x[0] is not None else 0, x[1], x[2]))]
    convs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        b = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        convs[c] = own.get(b, [])[:h] + turns[h:]
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    children = {p: 0 for p in nodes}
    for p in nodes:
        if p:
            children[p[:-1]] += 1
    out = []
    for p, members in nodes.items():
        sub = [q for q in nodes if q[: len(p)] == p]
        ends = ",".join(str(c) for c in sorted(c for c in members if len(convs[c]) == len(p)))
        out.append((
            min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), children[p],
            sum(children[q] == 0 for q in sub), sum((len(nodes[q]) - 1) * len(q[-1][1]) for q in sub if q),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def make_rows():
    rng = random.Random(3)
    texts = ["hello", "hi there", "how are you", "", None, "é日本", "long " * 2000]
    rows = []
    for c in list(range(0, 12)) + list(range(100, 108)) + [205, 230, 1000]:
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(texts)))
    rows += [(3, None, "user", "first of all"), (4, 2, "user", "tie a"), (4, 2, "user", "tie a"), (4, 2, "assistant", "tie b")]
    rows += [(None, 0, "user", "no conversation"), (7, 0, "user", "hello"), (-5, 0, "user", "x"), (-5, 1, "assistant", "y")]
    rows += [(300 + i, 0, "user", "same first turn") for i in range(30)]
    return rows


def result(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {"depth": F.lit("clash"), "c": F.lit(1.5), "k1": F.lit("x"), "n_convs": F.lit(None)}
    )
    return sorted((tuple(r) for r in prefix_trie.trie_report(df.repartition(3)).collect()), key=str)


def test_equals_brute_force(spark):
    rows = make_rows()
    assert result(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert result(spark, []) == []


def test_turnless_and_only_nulls(spark):
    rows = [(101, 0, None, None), (105, 0, "user", "a")]
    assert result(spark, rows) == brute(rows)

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from marquee.llm import id_files, packing, prefix_bpe, tokens
from marquee.llm.elias_fano import EliasFano, encode

BYTE, WORD = (tokens.tokenizer_path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = [
    "", " ", "  \n\n x", "a<|endoftext|>b", "<|startoftext|>hi<|endoftext|>", "a" * 3000, "I'm we'll  it's  b c   d", "日本語 ①②½ é̂ 🎉👩‍👩‍👧",
    "\x00\x01\x1c x\x85y", "     " * 100 + "x", "z" * 5000, "Don't! ''s 's' 'S", "_a__b_ 12a3 ½1", "ŉ İ ǅ ß ſ K Å", "x   y  　z", "\r\n\t\v\f ",
]


def odd_texts():
    rng = random.Random(1)
    return ODD + ["".join(rng.choice("ab \n'st.é½İ日́ \t<|>\x1c012") for _ in range(60)) for _ in range(150)]


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


@pytest.mark.parametrize("path, spaces", [(BYTE, True), (WORD, False)])
def test_pieces_give_the_ids_of_whole_texts(path, spaces, monkeypatch):
    plain, texts = tokens.load(path), odd_texts()
    expected = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    own = tokens.PieceEncoder(path, spaces)
    assert [ids(x) for x in own.encode(texts)] == expected
    monkeypatch.setattr(tokens, "MAX_PIECES", 3)  # a full cache changes nothing
    assert [ids(x) for t in texts for x in own.encode([t])] == expected


def test_a_word_is_cut_once_and_a_piece_encoded_once_in_either_case(monkeypatch):
    plain, own = tokens.load(WORD), tokens.PieceEncoder(WORD, False)
    rng, cut, encoded = random.Random(4), [], []
    pieces, joined = own.pieces, own._add_joined
    own.pieces = lambda text: cut.extend(text.split()) or pieces(text)
    own._add_joined = lambda some, *rest: encoded.extend(some) or joined(some, *rest)
    words = ["Word,", "word,", "WORD", "Éte,", "éte,", "H\u0331", "h\u0331", "x\u00a0y"]
    texts = [" ".join(rng.choices(words[:-1], k=200)) for _ in range(50)]
    expected = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids(x) for t in texts for x in own.encode([t, ""])[:1]] == expected
    assert sorted(encoded) == sorted(["word", ",", "éte", "H\u0331", "h\u0331"])
    assert len(cut) <= len(words)
    own.forget()
    mixed = [" ".join(rng.choices([*words, "<|endoftext|>", "<|ENDOFTEXT|>"], k=rng.randint(1, 9))) for _ in range(50)]
    expected = [plain.encode(t, add_special_tokens=False).ids for t in mixed]
    assert [ids(x) for x in own.encode(mixed)] == expected
    monkeypatch.setattr(tokens, "MAX_WORDS", 3)  # a full table changes nothing
    assert [ids(x) for t in mixed for x in own.encode([t])] == expected


def test_plain_characters_in_either_case():
    plain, own = tokens.load(WORD), tokens.PieceEncoder(WORD, False)
    rng = random.Random(5)
    letters = [c for c in tokens.FOLDED if c.isalpha()]
    texts = [*tokens.FOLDED, tokens.FOLDED, "x".join(tokens.FOLDED), " ".join(tokens.FOLDED), *("".join(rng.choices(letters, k=rng.randint(2, 12))) for _ in range(3000))]
    assert own.folds
    assert [ids(x) for x in own.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_prefix_programming_gives_the_ids_and_the_text():
    plain, own = tokens.load(BYTE), prefix_bpe.PrefixBpe(BYTE)
    for t in odd_texts():
        found = own.encode(t)
        assert ids(found) == plain.encode(t, add_special_tokens=False).ids
        assert own.decode(found) == plain.decode(ids(found), skip_special_tokens=False)
    some = plain.encode("日本 🎉", add_special_tokens=False).ids
    for i in range(len(some)):  # ids that are no whole characters
        assert own.decode(np.array(some[i:], "<u4").tobytes()) == plain.decode(some[i:], skip_special_tokens=False)


def test_automaton_lists_all_tokens_that_end_somewhere():
    rng = random.Random(2)
    words = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 5))) for _ in range(40)})
    automaton = prefix_bpe.SuffixAutomaton(words)
    for word in words:
        state = automaton._walk(word)
        found = {i for s in [state] for _, i in automaton.tokens[s]}
        while state > 0:
            state = automaton.up[state]
            found |= {i for _, i in automaton.tokens[state]} if state > 0 else set()
        assert {i for i in found if len(words[i]) <= len(word)} == {i for i, w in enumerate(words) if word.endswith(w)}


def test_encode_query(docs, corpus, no_docs):
    plain = tokens.load(BYTE)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    expected = []
    for doc_id, text in corpus:
        found = plain.encode(text or "", add_special_tokens=False).ids
        back = plain.decode(found, skip_special_tokens=False)
        expected.append((str(doc_id), len(found), sha(np.array(found, "<u4").tobytes()), sha(back.encode())))
    got = [(str(r[0]), *r[1:]) for r in prefix_bpe.encode_decode(docs).collect()]
    assert sorted(got) == sorted(expected)
    assert prefix_bpe.encode_decode(no_docs).isEmpty()
    assert prefix_bpe.encoded(docs).where("doc_id = 503").first()["ids"] == plain.encode("Of.", add_special_tokens=False).ids


def test_pieces_and_sequences(docs, corpus, no_docs):
    plain = tokens.load(BYTE)
    packed = packing.pack_documents(docs, with_ids=True).cache()
    rows = packed.collect()
    expected = []
    for doc_id, text in corpus:
        found = [*plain.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(found) % 2048 or 2048
        bounds = [0, *range(first, len(found) + 1, 2048)]
        for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
            expected.append((str(doc_id), piece, a, b - a, zlib.crc32(np.array(found[a:b], "<u4").tobytes()), found[a:b]))
    assert sorted((str(r[0]), *r[1:6]) for r in packed.select("doc_id", "piece", "start", "length", "ids_crc32", "ids").collect()) == sorted(expected)
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(places) <= 1.1 * sum(r["length"] for r in rows) / 2048 + 1
    whole = {r["sequence_id"]: len(r["ids"]) for r in packing.sequences(packed).collect()}
    assert whole == {s: sum(n for _, n in parts) for s, parts in places.items()}
    assert packing.pack_documents(no_docs).isEmpty()


def test_many_shards_are_packed_again(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_PIECES", 50)
    rng = random.Random(3)
    lengths = [rng.choice((2048, rng.randint(1, 2047), rng.randint(1, 300))) for _ in range(1000)]
    pieces = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id long, length long")
    places = defaultdict(list)
    for r in packing.assign_sequences(pieces).collect():
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sum(map(len, places.values())) == 1000
    for parts in places.values():
        assert [o for o, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= 2048
    assert len(places) <= 1.03 * sum(lengths) / 2048 + 1


def test_sum_of_squares_choice():
    # Pieces of 6, 5, 5 and 4 in sequences of 10 fill two; the last one starts a third.
    bins, offsets, fill = packing.sum_of_squares(np.array([5, 6, 4, 5, 3]), 10)
    assert sorted(fill.tolist()) == [3, 10, 10] and bins[0] == bins[3] and bins[1] == bins[2] and offsets[2] == 6


@pytest.mark.parametrize("n, top", [(0, 1), (1, 1), (1, 10**18), (1000, 5), (5000, 10**6), (3000, 2**63)])
def test_elias_fano(n, top):
    values = np.sort(np.random.default_rng(0).integers(0, top, n).astype(np.uint64))
    data = encode(values)
    read = EliasFano(b"xx" + data, 2)
    assert (read.all() == values).all() and read.end == len(data) + 2
    assert all(read[i] == int(values[i]) for i in range(0, n, 7))
    with pytest.raises(IndexError):
        read[n]
    if n >= 1000 and top == 10**6:
        assert 8 * len(data) < n * (np.log2(top / n) + 4)


@pytest.mark.parametrize("file_docs", [1 << 16, 7])
def test_files_round_trip(docs, corpus, no_docs, spark, monkeypatch, tmp_path, file_docs):
    monkeypatch.setattr(id_files, "FILE_DOCS", file_docs)
    plain = tokens.load(WORD)
    found = [(i, [*plain.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in corpus]
    folder = f"file://{tmp_path}/ids"
    manifest = id_files.write_ids(docs, folder)
    rows = id_files.read_ids(spark, folder, with_ids=True).orderBy("start").collect()
    assert manifest.agg({"n_docs": "sum"}).first()[0] == len(corpus)
    assert [r["doc_id"] for r in rows] == sorted((i for i, _ in found), key=lambda i: (i is not None, i or 0))
    assert sorted((str(r["doc_id"]), r["ids"]) for r in rows) == sorted((str(i), x) for i, x in found)
    start = 0
    for r in rows:
        assert r["start"] == start and r["n_tokens"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        start += r["n_tokens"]
    one = manifest.where("n_docs > 0").first()
    file = id_files.IdFile((tmp_path / "ids" / one["file"]).read_bytes())
    for i, doc_id in enumerate(file.all_doc_ids()):
        assert file.document(i)[0] == doc_id
    assert id_files.round_trip(no_docs).isEmpty()


def test_extreme_ids(spark):
    rows = spark.createDataFrame([(-(2**63), "a"), (2**63 - 1, "b"), (0, "c")], "doc_id long, text string")
    assert [r["doc_id"] for r in id_files.round_trip(rows).orderBy("start").collect()] == [-(2**63), 0, 2**63 - 1]


def test_a_worker_that_goes_on_to_other_work_empties_its_caches():
    from marquee.llm import order_minhash, shipping

    shipping.go_on_to("encoding")
    encoder = tokens.encoder(tokens.tokenizer_path("byte_bpe_50k.json"), spaces=True)
    before = encoder.encode(["some words, and more words"])
    order_minhash.k_mers("some words and more words")
    shipping.go_on_to("encoding")
    assert encoder.cache and order_minhash._hashes
    shipping.go_on_to("other work")
    assert not encoder.cache and not order_minhash._hashes
    assert encoder.encode(["some words, and more words"]) == before


def test_map_batches_says_what_work_a_worker_does(spark):
    from marquee.llm import shipping

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(shipping._work * batch.num_rows)], names=["work"])

    found = {r["work"] for r in shipping.map_batches(spark.range(8), run, "work string").collect()}
    assert len(found) == 1 and found.pop().endswith("run")

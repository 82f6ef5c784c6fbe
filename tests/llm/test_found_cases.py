"""Cases in which operators once lost or mixed up rows."""

import numpy as np
import public_tokenizers
import pytest

from brute import jaccard_components, removed_lines, sentence
from tierwell.llm import line_dedup, textscan, tokens, va_file
from tierwell.llm.jaccard_join import link_components
from tierwell.llm.line_dedup import dedup_lines
from tierwell.llm.suffix_array import dedup_substrings
from tierwell.llm.suffix_tree import dedup_words


def thue_morse(n, a="a", b="b"):
    word = a
    swap = str.maketrans(a + b, b + a)
    while len(word) < n:
        word += word.translate(swap)
    return word


@pytest.mark.parametrize("n", [256, 512, 1024, 2048, 4096])
def test_patterned_words_have_hashes_of_their_own(n):
    x, y = thue_morse(n), thue_morse(n, "b", "a")
    for i, j in ((x, y), (x + "c", y + "c"), ("zz" + x, "zz" + y)):
        buffer = np.frombuffer(f"{i} {j} {i}".encode(), dtype=np.uint8)
        _, _, hashes, _ = textscan.words(buffer, np.array([0, len(buffer)]))
        assert hashes[0] == hashes[2] != hashes[1]
    values = textscan.mixed(np.arange(2, dtype=np.uint64))[np.frombuffer((x + y).encode(), dtype=np.uint8) - 97]
    first, second = textscan.value_digests(values, np.array([0, n]), np.array([n, 2 * n]))
    assert first != second


def test_digests_know_place_and_length():
    buffer = np.frombuffer(b"abcdefgh" + b"abcdefgh\0" + b"12345678abcdefgh" + b"abcdefgh12345678", dtype=np.uint8)
    starts, ends = np.array([0, 8, 17, 33]), np.array([8, 17, 33, 49])
    assert len(set(textscan.byte_digests(buffer, starts, ends).tolist())) == 4


def test_long_words_are_not_taken_for_each_other(spark, docs):
    rest = " ".join(f"word{i}" for i in range(12))
    rows = [(1, f"{thue_morse(1024)} {rest}"), (2, f"{thue_morse(1024, 'b', 'a')} {rest}")]
    assert [r["n_removed"] for r in dedup_words(docs(rows)).orderBy("doc_id").collect()] == [0, 0]
    rows = [(1, f"{thue_morse(2048)} x y z"), (2, f"{thue_morse(2048, 'b', 'a')} x y z")]
    assert [r["component_id"] for r in link_components(docs(rows), 4, 85).orderBy("doc_id").collect()] == [1, 2]


@pytest.mark.parametrize("parts", [1, 4])
def test_rows_that_share_id_and_text_are_not_earlier_than_themselves(docs, parts):
    rng = np.random.default_rng(1)
    t, u = sentence(rng, 80), sentence(rng, 80)
    rows = [(1, t), (1, t), (2, t + " " + u), (3, u), (3, u), (4, u[:150] + t[:150])]
    got = sorted((r["doc_id"], r["n_removed"], r["kept"].decode()) for r in dedup_substrings(docs(rows).repartition(parts)).collect())
    assert got[:2] == [(1, 0, t), (1, 0, t)]
    assert got[2][:2] == (2, len(t)) or got[2][1] >= len(t)
    assert [g[1:] for g in got[3:5]] == [(len(u), ""), (len(u), "")]
    assert got[5][1] == 300


def test_two_texts_of_one_id_that_share_a_passage_at_the_same_place(docs):
    rng = np.random.default_rng(2)
    t = sentence(rng, 60)
    got = {r["kept"].decode(): r["n_removed"] for r in dedup_substrings(docs([(1, t + " one"), (1, t + " other ending")])).collect()}
    assert got == {t + " one": 0, t + " other ending": 0}


def test_a_document_of_many_near_equal_lines(spark, docs):
    base = "the quick brown fox jumps over the lazy dog and runs away from it"
    lines = [f"{base} number {i}" for i in range(16_000)]
    row = dedup_lines(docs([(1, "\n".join(lines))])).first()
    assert (row["n_lines"], row["n_removed"], row["text"]) == (16_000, 15_999, lines[0])


def test_lines_of_one_origin_that_do_not_match_are_not_compared_by_all_pairs(docs, monkeypatch):
    rng = np.random.default_rng(6)
    base, texts = [f"w{i}" for i in range(100)], {}
    for doc in range(200):
        words = list(base)
        for place in rng.choice(100, 2 + doc % 2, replace=False):
            words[place] = f"d{doc}x{place}"
        texts[doc] = " ".join(words)
    keep, pairs = line_dedup.stored, []

    def counted(df, name):
        rows = keep(df, name)
        if name == "pairs":
            pairs.append(rows.count())
        return rows

    monkeypatch.setattr(line_dedup, "stored", counted)
    got = {(r["doc_id"], r["line"]) for r in line_dedup.removed_lines(docs(list(texts.items()))).collect()}
    assert got == removed_lines(texts, 5, 80)
    assert len(pairs) == 2 and sum(pairs) < 20 * len(texts)


def test_short_lines_count_as_their_words(docs):
    rows = [(1, "All rights reserved.\nx"), (2, "All  rights reserved.\n\n \ny"), (3, "all rights reserved.\nx\n日本")]
    got = {r["doc_id"]: r["text"] for r in dedup_lines(docs(rows)).collect()}
    assert got == {1: "All rights reserved.\nx", 2: "\n \ny", 3: "all rights reserved.\n日本"}
    assert removed_lines(dict(rows), 5, 80) == {(2, 0), (3, 1)}


def test_vectors_of_any_finite_size(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=6) * scale).tolist()) for i, scale in enumerate([1, 1, 1e3, 1e5, 1e6, 1, 70_000, 1e-3, 2e6, 1] * 30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: [int(np.floor(1024 * x)) for x in v] for i, v in rows}
    want = []
    for q in (i for i in whole if i % 100 == 0):
        scores = sorted(((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q))[:10]
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)]
    got = va_file.top_k(df, "vec_id % 100 = 0", 10, 1024).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(tuple(r) for r in got) == want


def test_components_of_similar_texts_by_brute_force(docs):
    rng = np.random.default_rng(4)
    base = sentence(rng, 60)
    rows = [(1, base), (2, base + " tail"), (3, base.replace("alpha", "x")), (4, sentence(rng, 50)), (5, ""), (6, None)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in link_components(docs(rows), 4, 85).collect()}
    assert got == jaccard_components(dict(rows), 4, 85)


def test_frequent_words_stay_in_the_cache_while_rare_ones_pass(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 10)
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        encoder = tokens.Encoder(file.read())
    model, asked = encoder.model, []

    class Watched:
        def tokenize(self, piece):
            asked.append(piece)
            return model.tokenize(piece)

    encoder.model = Watched()
    rare = ["x" + chr(97 + i // 26) + chr(97 + i % 26) for i in range(200)]
    text = "\n".join(f"Often {word}, İé" for word in rare)
    ids = encoder.encode(text)
    assert ids == np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
    assert asked.count("often") == asked.count(",") == 1 and len(asked) == 202
    encoder.forget()
    assert not (encoder.words or encoder.words.old or encoder.pieces or encoder.pieces.old)

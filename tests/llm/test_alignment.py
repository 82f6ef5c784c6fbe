"""Alignment of two tokenizers against whole encodings and a plain merge of byte ranges."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tierwell.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "\n x", "x \n\n y  z ", "  lead", "trail  ", " a\tb   c  d\x1c e", "<|endoftext|> <s> <unk> <0x41>", "日本語 テスト\n中文", "it's I'll x'd 'tis",
    "\r\n a\r\n\r\nb", "\n", "\n\n", " ", "  ", "a\n b", "1234 56,7.8 ;\r\n{ }\r\n", "é́ ﬁ ① Ⅷ", "\x00 x\x00y", "emoji 😀😀 👨‍👩‍👧 x", "a▁b",
    "▁", "the of", "x" * 500 + " y", "word\nnext\nline", "a b 　 c",
]


@pytest.fixture(scope="module")
def plain():
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    return a, b


@pytest.fixture(scope="module")
def ours():
    with open(A, encoding="utf-8") as a, open(B, "rb") as b:
        return alignment.Tokenizers(a.read(), b.read())


def parts_of(t, text):
    found = [w for part in t.parts(text) for w in part]
    return ([i for w in found for i in t.a_ids[t.a_ends[w] : t.a_ends[w + 1]]],
            [i for w in found for i in t.b_ids[t.b_ends[w] : t.b_ends[w + 1]]])


def test_parts_give_the_ids_of_whole_texts(plain, ours):
    rng = random.Random(5)
    signs = ["a", "b ", "  ", "\n", " \n", "\t", "é", "'s", "1", "日", "-", "\r", " ", "the ", " of", "\x1c", " "]
    texts = ODD + ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 30))) for _ in range(500)]
    for text in texts:
        want = plain[0].encode(" " + text, add_special_tokens=False).ids, plain[1].encode(text)
        assert parts_of(ours, text) == (([], []) if "▁" in text else want), repr(text)


def brute(texts, plain):
    a, b = plain
    back = alignment._unprintable()
    aligned = []
    for text in texts:
        ids_a, ids_b = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        bytes_a = [bytes(back[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            aligned.append(None)
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        starts_a, starts_b = [0, *ends_a[:-1]], [0, *ends_b[:-1]]
        groups, links, last = [], [], 0
        for end in sorted(set(ends_a) & set(ends_b)):
            in_a = [i for i, e in enumerate(ends_a) if last < e <= end]
            in_b = [j for j, e in enumerate(ends_b) if last < e <= end]
            groups.append(",".join(str(ids_a[i]) for i in in_a) + "|" + ",".join(str(ids_b[j]) for j in in_b))
            links += [(ids_a[i], ids_b[j]) for i in in_a for j in in_b if starts_a[i] < ends_b[j] and starts_b[j] < ends_a[i]]
            last = end
        aligned.append((len(ids_a), len(ids_b), groups, links))
    counts = collections.Counter(link for found in aligned if found for link in found[3])
    most = collections.defaultdict(int)
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    return [(0, 0, 0, 0, 0, 0, "") if not found else (
        found[0], found[1], len(found[2]), len(found[3]), sum(counts[x] == most[x[1]] for x in found[3]),
        sum(counts[x] for x in found[3]), hashlib.sha256(";".join(found[2]).encode()).hexdigest()) for found in aligned]


def result(df):
    return sorted((tuple(r) for r in alignment.align_tokenizers(df, A, B).collect()), key=repr)


def test_against_brute_force(docs, plain, spark):
    rng = random.Random(11)
    words = ["alpha", "the", "of", "Straße", "naïve", "12,5", "日本", "x-ray", "unquestionably", "\n", "  ", "é"]
    texts = [None, "", *ODD, *[" ".join(rng.choice(words) for _ in range(rng.randrange(60))) for _ in range(60)]]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "the of"), (3, "the of"), (None, "alpha the")]
    want = sorted(((i, *found) for (i, _), found in zip(rows, brute([t for _, t in rows], plain))), key=repr)
    assert result(docs(rows).repartition(3)) == want


def test_small_blocks_and_long_texts_cut_in_parts_change_nothing(docs, plain, monkeypatch, ours):
    rng = random.Random(2)
    text = " ".join(rng.choice(["alpha", "beta", "Straße", "\nnew", "x  y"]) for _ in range(4000))
    want = parts_of(ours, text)
    monkeypatch.setattr(alignment, "PART", 500)
    assert parts_of(ours, text) == want and len(ours.parts(text)) > 10
    block = alignment.Block(ours)
    monkeypatch.setattr(alignment, "TOKENS", 300)
    block.add(1, text)
    rows = block.rows().to_pylist()
    (n_a, n_b, groups, links, *_, sha), = brute([text], plain)
    assert [rows[0][k] for k in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")] == [n_a, n_b, groups, links, sha]


def test_sums_of_windows_that_agree_are_compared_by_ids(ours, monkeypatch, plain):
    monkeypatch.setattr(alignment, "_sums", lambda rows: np.zeros(len(rows), dtype=np.uint64))
    text = "one\ntwo three\nfour five\nsix one\ntwo x"
    block = alignment.Block(ours)
    block.add(1, text)
    assert block.rows().to_pylist()[0]["groups_sha256"] == brute([text], plain)[0][-1]


def test_empty_table(docs):
    assert result(docs([])) == []
    assert result(docs([(1, None), (2, "")])) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]

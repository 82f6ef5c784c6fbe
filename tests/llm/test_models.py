"""Quality model, language ID, mixing, packing, search and embedding dedup against plain versions."""

import collections
import math
import os
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tierwell.llm import collision_dedup, language_id, mixing, packing, quality_model, va_file
from tierwell.llm.tokens import Encoder

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
RNG = np.random.default_rng(11)
ENGLISH = "the of and to in that was with for this from they have were which their would there".split()
GERMAN = "der die und das nicht eine ist auch werden über für schön größer müssen würde können zwischen".split()


def prose(words, n):
    return " ".join(np.array(words)[RNG.integers(0, len(words), n)]) + "."


# Quality model ---------------------------------------------------------------------------------------------------


def plain_kneser_ney(texts):
    """p(sign | three before) of an interpolated modified Kneser-Ney model, recursively and from sets."""
    order, signs = quality_model.ORDER, quality_model.SIGNS
    grams = collections.Counter()
    for text in texts:
        line = [0] * (order - 1) + [int(quality_model._FOLD[b]) for b in text.encode()]
        grams.update(tuple(line[i : i + order]) for i in range(len(line) - order + 1))
    counts = {order: dict(grams)}
    for n in range(order - 1, 0, -1):
        counts[n] = dict(collections.Counter(g[1:] for g in counts[n + 1]))
    tables = {}
    for n, table in counts.items():
        of = collections.Counter(table.values())
        y = of[1] / (of[1] + 2 * of[2]) if of[1] + of[2] else 0.5
        cut = [min(max(i - (i + 1) * y * of[i + 1] / of[i], 0.05), i - 0.05) if of[i] and of[i + 1] else 0.5 for i in (1, 2, 3)]
        total, gamma = collections.Counter(), collections.Counter()
        for gram, c in table.items():
            total[gram[:-1]] += c
            gamma[gram[:-1]] += cut[min(c, 3) - 1]
        tables[n] = table, cut, total, gamma

    def p(gram):
        if not gram:
            return 1 / signs
        table, cut, total, gamma = tables[len(gram)]
        if gram[:-1] not in total:
            return p(gram[1:])
        c, ctx = table.get(gram, 0), gram[:-1]
        return (c - cut[min(c, 3) - 1] if c else 0) / total[ctx] + gamma[ctx] / total[ctx] * p(gram[1:])

    def perplexity(text):
        line = [0] * (order - 1) + [int(quality_model._FOLD[b]) for b in text.encode()]
        return math.exp(-sum(math.log(p(tuple(line[i : i + order]))) for i in range(len(line) - order + 1)) / (len(line) - order + 1))

    return perplexity


def test_perplexity_is_that_of_a_plain_model(spark, docs):
    texts = {i: prose(ENGLISH, 20) for i in range(30)} | {30: "#### $$$$ %%%%", 31: "Über ÄÖ", 32: "x", 33: None, 34: ""}
    labels = spark.createDataFrame(
        [(i, 1, 0) for i in range(20)] + [(20, 0, 0), (21, 1, 1), (5, 1, None), (30, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int"
    )
    plain = plain_kneser_ney([texts[i] for i in range(20)])
    rows = {r.doc_id: r for r in quality_model.classify(docs([(i, t, "en") for i, t in texts.items()]), labels).collect()}
    assert set(rows) == set(texts)
    for i, text in texts.items():
        if text:
            assert rows[i].perplexity == pytest.approx(plain(text), rel=1e-4)
    assert rows[33].perplexity is None and not rows[33].kept and not rows[34].kept and not rows[30].kept
    assert sum(rows[i].kept for i in range(20)) >= 19


def test_junk_is_rejected_and_prose_kept(spark, docs):
    texts = [(i, prose(ENGLISH, 60), "en") for i in range(150)] + [(i, prose(GERMAN, 60), "de") for i in range(150, 300)]
    junk = [(i, " ".join(f"{w}###" for w in prose(ENGLISH, 30).upper().split()), "en") for i in range(300, 320)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 300, 2)], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r.kept for r in quality_model.classify(docs(texts + junk), labels, enough=10).collect()}
    held_out = [rows[i] for i in range(1, 300, 2)]
    assert np.mean(held_out) > 0.95 and not any(rows[i] for i in range(300, 320))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test data")
def test_good_documents_without_a_label_are_kept_in_every_language(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "labels"))
    good = labels.groupBy("doc_id").agg(F.min(((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int")).alias("good"))
    known = labels.where(F.xxhash64("doc_id", F.lit("half")) % 2 == 0)
    judged = quality_model.classify(docs, known).join(good, "doc_id").join(known.select("doc_id").distinct(), "doc_id", "left_anti")
    kept = {(r.language, r.good): (r.kept, r.n) for r in judged.groupBy("language", "good").agg(
        F.avg(F.col("kept").cast("int")).alias("kept"), F.count("*").alias("n")).collect()}
    print(kept)
    assert all(share >= 0.9 for (_, is_good), (share, _) in kept.items() if is_good)
    assert any(is_good for _, is_good in kept)


@pytest.mark.parametrize("count", [1, 2, 3])
def test_a_few_trusted_documents_still_give_a_threshold(spark, docs, count):
    texts = [(i, prose(ENGLISH, 60), "en") for i in range(6)] + [(9, None, "en"), (10, "words of another tongue", None)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(count)], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in quality_model.classify(docs(texts), labels).collect()}
    assert len(rows) == 8 and not rows[9].kept
    assert all(math.isfinite(r.threshold) and r.threshold > 1 for r in rows.values())


def test_quality_without_labels_or_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.kept for r in quality_model.classify(docs([(1, "some text", "en")]), none).collect()] == [True]
    assert quality_model.classify(docs([(1, "x", "en")]).limit(0), none).collect() == []


# Language ID -----------------------------------------------------------------------------------------------------


def test_languages_are_found_on_held_out_rows(docs):
    rows = [(i, prose(ENGLISH, 30), "en", "a") for i in range(60)] + [(i, prose(GERMAN, 30), "de", "b") for i in range(60, 120)]
    wrong = [(i, prose(GERMAN, 30), "en", "a") for i in range(120, 124)]
    odd = [(130, None, "en", "a"), (131, "", "en", "a"), (132, "12 34 !!", "en", "a"), (133, "Привет мир как дела сегодня хорошо", None, None), (134, prose(GERMAN, 9), None, None)]
    df = language_id.from_documents(docs(rows + wrong + odd))
    found = {r.doc_id: r for r in language_id.identify(df, "doc_id", languages=("en", "de")).collect()}
    assert len(found) == 129
    assert all(found[i].language == "en" and found[i].kept for i in range(60))
    assert all(found[i].language == "de" for i in [*range(60, 124), 134])
    assert not any(found[i].kept for i in (130, 131, 132, 133))
    assert language_id.identify(df.limit(0), "doc_id").collect() == []


def test_evidence_decides_where_text_does_not(docs):
    rows = [(i, prose(ENGLISH, 30), "en", "a") for i in range(60)] + [(i, prose(GERMAN, 30), "de", "b") for i in range(60, 120)]
    both = [(200, "qq qq", "en", "a"), (201, "qq qq", "de", "b")]
    found = {r.doc_id: r.language for r in language_id.identify(language_id.from_documents(docs(rows + both)), "doc_id", languages=("en", "de")).collect()}
    assert (found[200], found[201]) == ("en", "de")


def test_pages_give_text_language_and_address(spark):
    html = '<!DOCTYPE html><html class="x" lang="de-AT"><script>var x="<p>"</script><p>eins &amp; zwei</p><!-- no --></html>'
    pages = spark.createDataFrame([(1, "https://www.shop.example.at:80/x?y", html), (2, None, None)], "page_id long, url string, html string")
    row, other = language_id.from_pages(pages).orderBy("page_id").collect()
    assert (row.declared, row.host, row.domain, row.suffix) == ("de", "www.shop.example.at", "example.at", "at")
    assert row.text.split() == ["eins", "zwei"] and other.text is None
    assert len(language_id.identify(language_id.from_pages(pages), "page_id").collect()) == 2


# Mixing ----------------------------------------------------------------------------------------------------------


def plain_split(budget, children):
    """{name: (weight, capacity)} -> tokens, by filling up the fullest first."""
    given, rest = {}, {n: wc for n, wc in children.items() if wc[0] > 0}
    while rest:
        total = sum(w for w, _ in rest.values())
        full = [n for n, (w, c) in rest.items() if c * total <= budget * w]
        if not full:
            return given | {n: budget * w // total for n, (w, _) in rest.items()}
        for n in full:
            given[n] = rest.pop(n)[1]
        budget -= sum(given[n] for n in full)
    return given


def test_split_gives_shortages_to_siblings(spark):
    children = {"a": (5, 10), "b": (3, 1000), "c": (2, 50), "d": (0, 99), "e": (1, 0)}
    for budget in (0, 1, 7, 100, 400, 1060, 5000):
        df = spark.createDataFrame([(0, n, w, c, c, budget) for n, (w, c) in children.items()], "_root int, name string, _weight long, _capacity long, _tokens long, _budget long")
        assert {r.name: r._budget for r in mixing.split(df, ["_root"], "name").collect()} == plain_split(budget, children)


def test_mixture_reaches_its_weights(docs):
    rows = [(i, prose(ENGLISH, int(RNG.integers(1, 40))), ["en", "de", None][i % 3], f"src{i % 5}" if i % 7 else None) for i in range(400)]
    rows += [(500, None, "en", "src1"), (501, "", "en", "src1"), (502, "same", "en", "src1"), (502, "same", "en", "src1")]
    df = docs(rows)
    out = mixing.mix(df, max_epochs=3, share=1.2).collect()
    words = collections.Counter()
    for r in rows:
        leaf = ("other" if not r[3] else f"domain{int(r[3][3:]) % 4}", r[2] or "", r[3] or "")
        words[leaf] += len((r[1] or "").split())
    plan, tokens = {}, int(sum(words.values()) * 1.2)

    def fill(budget, depth, prefix):
        if depth == 3:
            plan[prefix] = budget
            return
        names = {leaf[depth] for leaf in words if leaf[:depth] == prefix}
        table = [mixing.DOMAIN_WEIGHTS, mixing.LANGUAGE_WEIGHTS, {}][depth]
        children = {n: (table.get(n, 1), 3 * sum(v for k, v in words.items() if k[: depth + 1] == (*prefix, n))) for n in names}
        for n, given in plain_split(budget, children).items():
            fill(given, depth + 1, (*prefix, n))

    fill(tokens, 0, ())
    got, copies = collections.Counter(), collections.Counter()
    for r in out:
        got[r._domain, r._lang, r._source] += r._tokens
        copies[r._domain, r._lang, r._source, r.doc_id] += 1
    longest = max(len((r[1] or "").split()) for r in rows)
    for leaf, target in plan.items():
        assert target - longest < got[leaf] <= target
        times = [copies[(*leaf, r[0])] for r in rows if r[1] and r[0] < 500 and (r[2] or "", r[3] or "") == leaf[1:]]
        assert max(times) - min(times) <= 1 and max(times) <= 3
    assert sorted(map(str, out)) == sorted(map(str, mixing.mix(df.repartition(3), max_epochs=3, share=1.2).collect()))
    assert mixing.mix(df.limit(0)).collect() == []


# Packing ---------------------------------------------------------------------------------------------------------


def test_encoder_equals_the_tokenizer():
    definition = open(TOKENIZER, encoding="utf-8").read()
    whole, own = Tokenizer.from_str(definition), Encoder(definition)
    odd = ["", "  x ", "İstanbul ſ K Å é é ΣΑΣ ß ﬁ", "a'sb'll 12 ½ <|endoftext|> x<|startoftext|>y", "日本語 テスト", "a b c\x1cd\x85e", "naïve\tcafé\r\nx", "ǅ ǆ Ŀ ŉ"]
    odd += ["".join(RNG.choice(list("aAéñÿĿſ ½²1_-,.*#'st ́​"), 30)) for _ in range(500)]
    for text in odd:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_cutting_stock_holds_every_piece_once():
    rng = np.random.default_rng(4)
    for sizes, demand in ((np.array([1]), np.array([7.0])), (np.arange(1, 33), np.floor(rng.random(32) * 300 + 1)), (np.array([3, 17, 32]), np.array([1.0, 2.0, 5.0]))):
        plan = packing.cutting_stock(sizes, demand, 32)
        assert (sum(times * uses for times, uses in plan) == demand).all() and all(uses @ sizes <= 32 for _, uses in plan)
        least = (sizes @ demand) / 32
        assert sum(times for times, _ in plan) <= least * 1.1 + len(sizes) or sizes.min() > 16 or len(sizes) == 3


def test_packing_places_every_id_once(docs):
    texts = {i: prose(ENGLISH, int(RNG.integers(0, 900))) for i in range(120)} | {200: None, 201: "", 202: prose(GERMAN, 6000)}
    rows = packing.pack(docs([*texts.items(), (0, texts[0])]), TOKENIZER, capacity=256, step=4).collect()
    whole = Tokenizer.from_file(TOKENIZER)
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for doc, found in by_doc.items():
        ids = whole.encode(texts[doc] or "", add_special_tokens=False).ids + [1]
        copies = 2 if doc == 0 else 1
        starts = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in found)
        assert [s[0] for s in starts[::copies]] == list(range(0, len(ids), 256)) and len(starts) == copies * -(-len(ids) // 256)
        for start, length, crc, tokens in starts:
            assert (tokens, length) == (len(ids), len(ids[start : start + 256]))
            assert crc == zlib.crc32(np.array(ids[start : start + 256], "<u4").tobytes())
    for found in by_sequence.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 256
    assert sum(r.length for r in rows) / (256 * len(by_sequence)) > 0.95
    assert packing.pack(docs([(1, "x")]).limit(0), TOKENIZER).collect() == []


# Vectors ---------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vectors(spark):
    base = RNG.standard_normal((300, 16))
    base[100:160] = base[0] + 0.02 * RNG.standard_normal((60, 16))
    base[160:165] = base[1]
    rows = [(i, [float(x) for x in np.float32(v)], int(i % 2) if i < 100 else 0) for i, v in enumerate(base)]
    rows += [(400, None, 0), (401, [], 0), (402, [0.0] * 16, 0), (403, [float("nan")] * 16, 0), (404, [None] * 16, 0), (405, [1.0] * 16, None)]
    rows += [(406, [1.0, 2.0], 0), (500, [1.0, 2.0], 0), (600, [0.5] * 3, 0), (5, rows[5][1], 1)]
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, rank string, n long").cache()


def test_exact_top_k(vectors, monkeypatch):
    monkeypatch.setattr(va_file, "BLOCK", 50)
    known = {r.vec_id: np.floor(1024 * np.array(r.embedding, dtype=float)).astype(int) for r in vectors.collect()
             if r.embedding and all(x is not None and math.isfinite(x) for x in r.embedding)}
    expected = set()
    for q, v in known.items():
        if q % 100 == 0:
            scores = sorted((-int(v @ w), i) for i, w in known.items() if i != q and len(w) == len(v))
            expected |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:10])}
    assert set(map(tuple, va_file.top_k(vectors, "vec_id % 100 = 0").collect())) == expected
    assert va_file.top_k(vectors.limit(0), "vec_id % 100 = 0").collect() == []


def test_near_vectors(vectors):
    unit, label = {}, {}
    for r in vectors.collect():
        v = np.array([np.nan if x is None else x for x in r.embedding or []], dtype=float)
        if r.label is not None and len(v) and np.isfinite(v).all() and v.any():
            unit[r.vec_id], label[r.vec_id] = v / np.linalg.norm(v), r.label
    links = [(a, b) for a in unit for b in unit if a < b and label[a] == label[b] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.98]
    ids = {r.vec_id for r in vectors.collect()}
    component = brute.smallest_reachable(ids, links)
    for block in (1024, 16):
        rows = {r.vec_id: r for r in collision_dedup.near_duplicates(vectors, block=block).collect()}
        assert set(rows) == ids
        found = sum(r.n_links for r in rows.values()) / 2
        assert found <= len(links) and found >= 0.99 * len(links)
        assert all(rows[i].component_id == component[i] and rows[i].kept == (component[i] == i) for i in ids)
    assert collision_dedup.near_duplicates(vectors.limit(0)).collect() == []


def test_count_is_calibrated():
    count = collision_dedup.calibrated_count(32, 0.9995)
    rng, d = np.random.default_rng(8), 64
    x = rng.standard_normal((2000, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.standard_normal((2000, d))
    side -= (side * x).sum(axis=1, keepdims=True) * x
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    y = 0.98 * x + math.sqrt(1 - 0.98**2) * side
    to = collision_dedup.directions(d, 32)
    met = (np.abs(x @ to - y @ to) <= 2 * collision_dedup.distance(0.98)).sum(axis=1) >= count
    assert met.mean() >= 0.99

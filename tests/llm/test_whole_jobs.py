"""Cases in which an operator once did less than its whole job."""

import brute
import numpy as np

from tierwell.llm import line_dedup, pipeline, quality_model

RNG = np.random.default_rng(31)
RUSSIAN = "привет мир как дела сегодня хорошо погода город вечер книга улица человек время работа большой дорога".split()


def test_text_of_another_script_is_judged_by_its_letters(spark, docs):
    letters = sorted(set("".join(RUSSIAN)))
    prose = [" ".join(RNG.choice(RUSSIAN, 40)) for _ in range(60)]
    junk = [" ".join("".join(RNG.choice(letters, len(w))) for w in RNG.choice(RUSSIAN, 40)) for _ in range(10)]
    rows = [(i, t, "ru") for i, t in enumerate(prose + junk)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in quality_model.classify(docs(rows), labels, enough=10).collect()}
    assert np.mean([found[i].kept for i in range(40, 60)]) > 0.8
    assert not any(found[i].kept for i in range(60, 70))
    assert min(found[i].perplexity for i in range(60, 70)) > 2 * max(found[i].perplexity for i in range(40, 60))


def test_capitals_and_digits_are_units_of_their_own(spark, docs):
    rows = [(i, " ".join(RNG.choice(["Alpha 1", "Beta 2"], 30)), "en") for i in range(30)] + [(30, "Qxzwv 7 " * 30, "en"), (31, "Alpha 9 " * 30, "en")]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r.perplexity for r in quality_model.classify(docs(rows), labels, enough=10).collect()}
    assert found[31] > 1.5 * max(found[i] for i in range(30))


def test_scoring_grows_with_the_corpus(docs):
    few, many = (docs([(i, " ".join(f"{x:x}" for x in RNG.integers(0, 1 << 40, 40)), "en") for i in range(n)]) for n in (20, 200))
    sizes = [
        sum(len(quality_model._unpack_grams(r.grams)) for r in quality_model.gram_counts(x.select("doc_id", "text")).collect()) for x in (few, many)
    ]
    assert sizes[1] > 5 * sizes[0]


def test_lines_that_share_the_short_key_of_their_shingle_stay(docs):
    lines = ["one two three four w629779", "one two three four w705888"]  # alike in the upper 41 bits of the hash
    rows = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup_lines(docs(list(enumerate(lines)))).collect()}
    assert rows == {i: (x, 0) for i, x in enumerate(lines)}


def removed_with_short_lines(texts, k, percent):
    earlier, gone = [], set()
    for doc in sorted(x for x in texts if texts[x] is not None):
        for i, line in enumerate(texts[doc].split("\n")):
            tokens = brute.shingles(line, k)
            if tokens and any(100 * len(tokens & x) >= percent * len(tokens | x) for x in earlier):
                gone.add((doc, i))
            if tokens:
                earlier.append(tokens)
    return gone


def test_repeated_lines_of_few_words_go(spark, docs):
    long = "one two three four five six seven"
    texts = {
        0: f"All rights reserved.\n{long}\nAnd ornd.", 1: f"All rights reserved.\n\n  \nAnd  ornd.\nornd. And\n{long}", 2: "你好世界再见\nAll rights",
        3: "你好世界再见\n\n \nall rights reserved.\none two three four\none two three four five", 4: "one two three four five", 5: "one two three four", 6: None, 7: "",
    }
    gone = removed_with_short_lines(texts, 5, 80)
    assert len(gone) == 6 and (3, 0) in gone
    rows = {r.doc_id: r.text for r in pipeline.drop_repeated_lines(spark, docs(list(texts.items())), "").collect()}
    for doc, text in texts.items():
        assert rows[doc] == (None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if (doc, i) not in gone))


def test_language_verdict_is_the_rows_own(spark, docs):
    text = "the weather of the city was good and they would have been there with their books"
    rows = [(i, f"{text} {i}", "en", "a") for i in range(30)] + [(3, None, "en", "a"), (4, "", "en", "a"), (5, "12 34 !!", None, None)]
    kept = pipeline.drop_unknown_languages(spark, docs(rows, extra=False), "").collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(i, f"{text} {i}") for i in range(30)]


def test_rows_that_repeat_id_and_text_become_one(spark, docs):
    a, b = (brute.sentence(RNG, 30) for _ in range(2))
    rows = [(1, a, "en", "y"), (1, a, "en", "x"), (1, a, "en", "x"), (2, a, "en", "x"), (3, b, "de", "x"), (4, None), (4, None), (5, "one"), (5, "two")]
    kept = pipeline.drop_near_copies(spark, docs(rows, extra=False), "").collect()
    assert sorted((r.doc_id, r.text or "", r.source or "") for r in kept) == [(1, a, "x"), (3, b, "x"), (4, "", ""), (5, "one", ""), (5, "two", "")]

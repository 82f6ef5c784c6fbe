"""Language ID against a plain version, languages taken from what rows declare, and text of none of them."""

import collections
import math

import numpy as np
import pytest

from tierwell.llm import language_id

RNG = np.random.default_rng(77)
WORDS = {
    "en": "the of and to in that was with for this from they have were which their would there".split(),
    "es": "el la de que y en un ser se no haber por con su para como estar tener le lo todo pero más hacer".split(),
    "it": "il di che è la per un sono mi ho si lo ha le ti con cosa come io ma questo qui hai sei del bene più gli della nella".split(),
    "zh-cn": "你好 世界 再见 中国 北京 我们 他们 今天 天气 很好".split(),
}


def prose(lang, n):
    return " ".join(np.array(WORDS[lang])[RNG.integers(0, len(WORDS[lang]), n)]) + "."


def sign(byte):
    if 97 <= byte < 123 or 65 <= byte < 91:
        return byte % 32
    if 0x80 <= byte < 0xC0:
        return 28 + (byte - 0x80) % 32
    if 0xC0 <= byte < 0xE0:
        return 27
    return 60 + byte % 4 if byte >= 0xE0 else 0


def plain(rows):
    """id -> (language, confidence) of rows (id, text, declared, host, domain, suffix), straight from the definition."""
    declares = collections.Counter(r[2] for r in rows if r[2] not in ("", "und"))
    languages = sorted(x for x, n in declares.items() if n >= 5 + sum(declares.values()) / 2000)
    every, cells = [*languages, "und"], 64**3
    grams, counts = {}, {x: collections.Counter() for x in languages}
    for r in rows:
        s = [sign(b) for b in (r[1] or "").encode()]
        grams[r[0]] = [t for t in zip(s, s[1:], s[2:]) if any(t)]
        if r[2] in counts:
            counts[r[2]].update(grams[r[0]])
    total = {x: sum(c.values()) + 0.1 * cells for x, c in counts.items()}
    whole = collections.Counter()
    for c in counts.values():
        whole.update(c)
    blank = 0.1 * len(languages)
    roots = sum(math.sqrt(n + blank) for n in whole.values()) + (cells - len(whole)) * math.sqrt(blank)

    def likelihood(x, found):
        if x == "und":
            return sum(math.log(0.5 / cells + 0.5 * math.sqrt(whole[t] + blank) / roots) for t in found) / 3
        return sum(math.log((counts[x][t] + 0.1) / total[x]) for t in found) / 3

    ll = {r[0]: {x: likelihood(x, grams[r[0]]) for x in every} for r in rows}
    said = {i: max(every, key=lambda x: (l[x], x)) if grams[i] else "und" for i, l in ll.items()}
    votes = collections.Counter(said.values())
    keys = {"h": lambda r: r[5:2:-1], "d": lambda r: r[5:3:-1], "s": lambda r: r[5], "c": lambda r: r[2]}
    sums = {p: collections.Counter((key(r), said[r[0]]) for r in rows) for p, key in keys.items()}
    sizes = {p: collections.Counter(key(r) for r in rows) for p, key in keys.items()}
    out = {}
    for r in rows:
        score = {}
        for x in every:
            own = said[r[0]] == x
            prior = (votes[x] + 1) / (len(rows) + len(every))
            for p in "sdh":
                prior = (sums[p][keys[p](r), x] - own + 20 * prior) / (sizes[p][keys[p](r)] - 1 + 20)
            declared = (sums["c"][r[2], x] - own + 20 * (0.9 if r[2] == x else 0.1 / len(every))) / (votes[x] - own + 20)
            ends = (sums["s"][r[5], x] - own + 2) / (votes[x] - own + 20)
            score[x] = sum(math.log(max(v, 1e-12)) for v in (prior, declared, ends)) + ll[r[0]][x]
        best = max(every, key=lambda x: (score[x], x))
        out[r[0]] = (best if grams[r[0]] else "und", 1 / sum(math.exp(v - score[best]) for v in score.values()))
    return out


@pytest.fixture(scope="module")
def rows():
    out = []
    for i in range(160):
        lang = ("en", "en", "es", "it", "zh-cn")[i % 5]
        host = f"www{i % 3}.{lang}.example"
        out.append((i, prose(lang, 1 + i % 7), "en" if i % 11 == 0 else lang, host, f"{lang}.example", "org" if i % 4 else lang))
    out += [(200, None, "en", "h", "d", "s"), (201, "", "", "", "", ""), (202, "12 - !!", "it", "h", "d", "it"), (203, "qq qq", "es", "x", "y", "es")]
    return out + [(204, "xkq zzvw qqjx wvkz", "", "x", "y", "z"), (205, "il la", "zz", "x", "y", "z"), (206, "word", "und", "x", "y", "z")]


def test_verdicts_are_those_of_the_plain_version(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, declared string, host string, domain string, suffix string")
    found = {r.doc_id: r for r in language_id.identify(df, "doc_id").collect()}
    expected = plain(rows)
    assert set(found) == set(expected)
    for i, (language, confidence) in expected.items():
        assert found[i].language == language and found[i].confidence == pytest.approx(confidence, abs=1e-4), i


def test_languages_come_from_what_rows_declare(spark, docs):
    rows = [(i, prose(x, 25), x, f"s{i % 3}") for i, x in enumerate(["en"] * 60 + ["es"] * 40 + ["it"] * 30 + ["zh-cn"] * 20)]
    rows += [(900, prose("en", 20), "xx", "s0"), (901, prose("it", 20), None, "s0")]
    df = language_id.from_documents(docs(rows))
    assert language_id.declared_languages(df.fillna("", ["declared"])) == ("en", "es", "it", "zh-cn")
    found = {r.doc_id: r for r in language_id.identify(df, "doc_id").collect()}
    assert all(found[i].language == x and found[i].kept for i, _, x, _ in rows[:-2])
    assert (found[900].language, found[901].language) == ("en", "it")


def test_text_of_no_declared_language_is_rejected(spark, docs):
    rows = [(i, prose("en", 25), "en", "a") for i in range(60)]
    noise = " ".join("".join(x) for x in RNG.choice(list("bcdfgjkpqvwxz"), (60, 6)))
    odd = [(100, prose("zh-cn", 20), None, "a"), (101, noise, None, "a")]
    found = {r.doc_id: r for r in language_id.identify(language_id.from_documents(docs(rows + odd)), "doc_id").collect()}
    assert all(found[i].kept for i in range(60)) and not found[100].kept and not found[101].kept
    none = language_id.identify(language_id.from_documents(docs([(1, "some text", None, None)])), "doc_id").collect()
    assert [(r.language, r.kept) for r in none] == [("und", False)]

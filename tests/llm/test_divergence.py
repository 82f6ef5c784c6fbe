"""Source divergence against a dense computation with Python's integers."""

import collections
import random
import re

import numpy as np

from tierwell.llm import divergence

TERMS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, min_docs=3, top=200):
    rows = [(text or "", lang or "", source or "") for _, text, lang, source in rows]
    docs, counts = collections.Counter(), collections.defaultdict(collections.Counter)
    for text, lang, source in rows:
        found = [lower(t) for t in TERMS.findall(text)]
        counts[lang, source].update(found)
        docs.update((lang, t) for t in set(found))
    out = []
    for lang in {lang for _, lang, _ in rows}:
        kept = [t for (of, t), n in docs.items() if of == lang and n >= min_docs]
        groups = {s: counts[l, s] for l, s in counts if l == lang}
        whole = sum(groups.values(), collections.Counter())

        def share(count):
            total = sum(count[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (count[t] + 1) // total for t in kept}

        p = {s: share(count) for s, count in groups.items()}
        q = share(whole)
        for s, count in groups.items():
            pair = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in groups if o != s]
            term = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if count[t] and p[s][t] > q[t]]
            for part, found, least in (("pair", pair, None), ("term", term, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(found[:least], 1)]
    return sorted(out)


def result(df, **how):
    return sorted(tuple(r) for r in divergence.audit(df, **how).select("lang", "source", "part", "item", "value", "rank").collect())


def corpus(seed, n, langs, sources):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdé日Z" for b in ("x", "yy", "Zz", "ß")]
    return [(i, " ".join(rng.choice(words[: 5 + 3 * (i % 8)]) + rng.choice(["", "1", "-"]) for _ in range(rng.randrange(40))),
             rng.choice(langs), rng.choice(sources)) for i in range(n)]


def test_against_brute_force(docs):
    rows = corpus(1, 150, ["en", "de", None], ["a", "b", "c", None, "É"]) + [
        (1, "again again again", "en", "a"), (1, "again", "en", "a"), (2, None, "xx", "s1"), (3, "", "xx", "s2"), (4, "rare", "yy", None),
        (None, "again", "en", "b"),
    ]
    assert result(docs(rows)) == brute(rows)


def test_shards_and_blocks_of_sources(docs, monkeypatch):
    monkeypatch.setattr(divergence, "SHARD_ENTRIES", 7)
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", 2)
    rows = corpus(2, 200, ["en", "fr"], [f"s{i}" for i in range(7)])
    assert result(docs(rows), top=3) == brute(rows, top=3)


def test_a_hot_source_and_one_very_long_text(docs):
    rows = corpus(3, 60, ["en"], ["a", "b"]) + [(1000 + i, "hot words here", "en", "hot") for i in range(300)] + [
        (5000, "long " * 300_000 + "tail", "en", "c")]
    assert result(docs(rows)) == brute(rows)


def test_empty_table(docs):
    assert result(docs([])) == []


def test_shares_stay_exact_for_large_counts():
    counts = np.array([0, 1, 10**12, 8 * 10**15 - 1], dtype=np.int64)
    weight = 8 * 10**15
    assert divergence.share(counts, weight).tolist() == [1 + 10**9 * (int(c) + 1) // weight for c in counts]


def test_galloping_finds_the_places_of_binary_search():
    rng = np.random.default_rng(4)
    for _ in range(300):
        long = np.unique(rng.integers(0, 2000, rng.integers(0, 900)))
        short = np.unique(rng.integers(0, 2000, rng.integers(0, 400)))
        assert divergence.gallop(short, long).tolist() == np.searchsorted(long, short).tolist()

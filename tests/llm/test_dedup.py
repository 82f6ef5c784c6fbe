"""Jaccard join, line dedup, suffix arrays and suffix trees against plain versions, and their edge cases."""

import math

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tierwell.llm import jaccard_join, line_dedup, suffix_array, suffix_tree
from tierwell.llm.common import stored

RNG = np.random.default_rng(5)


def corpus():
    """Exact copies, near copies, shared passages, repeated and odd texts."""
    texts, passage = {}, brute.sentence(RNG, 60)
    for i in range(40):
        texts[i] = brute.sentence(RNG, int(RNG.integers(3, 120)))
    base = brute.sentence(RNG, 90).split()
    for i in range(40, 70):  # near copies
        words = list(base)
        for j in RNG.integers(0, len(words), int(RNG.integers(0, 4))):
            words[j] = f"new{RNG.integers(0, 10)}"
        texts[i] = " ".join(words)
    for i in range(70, 90):  # one passage in different texts
        texts[i] = brute.sentence(RNG, 30) + " " + passage + "\n" + brute.sentence(RNG, 20)
    for i in range(90, 96):
        texts[i] = texts[3]
    line = brute.sentence(RNG, 12)
    for i in range(96, 104):
        texts[i] = brute.sentence(RNG, 20) + "\n" + line + (" again" if i % 2 else "") + "\n" + brute.sentence(RNG, 20)
    short = brute.sentence(RNG, 16, 10)
    for i in range(104, 112):  # light sets
        texts[i] = " ".join(short.split()[: 16 - i % 3])
    texts |= {
        112: None, 113: "", 114: " \n\t ", 115: "word", 116: "word", 117: "WORD", 118: "ab " * 400, 119: "ab " * 401,
        120: "é" * 150, 121: "x" + "é" * 150, 122: "\x00" * 130, 123: "\x00" * 101 + "é", 124: "a b c\x1cd e\x0bf g\rh",
        125: brute.sentence(RNG, 4000), 126: "long " * 3000,
    }
    return texts


TEXTS = corpus()
EMPTY = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def frame(docs):
    return docs([(i, t) for i, t in TEXTS.items()]).repartition(5).cache()


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80)])
def test_jaccard_join(frame, k, percent):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link_components(frame, k, percent).collect()}
    assert found == brute.jaccard_components(TEXTS, k, percent)


def test_light_and_heavy_sets_find_the_same(frame, monkeypatch):
    for light in (0, 20):
        monkeypatch.setattr(jaccard_join, "boundary", lambda *a, x=light: x)
        found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link_components(frame, 4, 85).collect()}
        assert found == brute.jaccard_components(TEXTS, 4, 85)


def test_boundary_follows_cost():
    sizes = np.zeros(25, dtype=int)
    sizes[5:15] = 100
    rare, common = np.ones(1 << 20), np.zeros(1 << 20)
    common[:10] = 1e6
    assert jaccard_join.boundary(sizes, rare, 85) <= jaccard_join.boundary(sizes, common, 85)


@pytest.mark.parametrize(("k", "percent"), [(5, 80), (2, 60)])
def test_line_dedup(frame, k, percent):
    gone = brute.removed_lines(TEXTS, k, percent)
    rows = {r.doc_id: r for r in line_dedup.dedup_lines(frame, k, percent).collect()}
    for doc, text in TEXTS.items():
        lines = [] if text is None else text.split("\n")
        kept = None if text is None else "\n".join(x for i, x in enumerate(lines) if (doc, i) not in gone)
        assert (rows[doc].text, rows[doc].n_lines) == (kept, len(lines))
        assert rows[doc].n_removed == sum(d == doc for d, _ in gone)
    assert rows[0].component_id == 1 and rows[0]["rank"] == "y"


@pytest.mark.parametrize("limits", [{}, {"shard": 700, "crowd": 3}])
def test_suffix_arrays(frame, limits):
    rows = suffix_array.dedup_substrings(frame, length=100, **limits).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows} == brute.removed_bytes(TEXTS, 100)


@pytest.mark.parametrize("limits", [{}, {"group": 3, "crowd": 2, "held": 300}])
def test_suffix_trees(frame, limits):
    rows = suffix_tree.dedup_words(frame, length=13, **limits).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, bytes(r.kept)) for r in rows} == brute.removed_words(TEXTS, 13)


def test_suffix_array_is_sorted_and_prefixes_are_right():
    rng = np.random.default_rng(2)
    for n, letters in ((1, 2), (2, 1), (40, 1), (300, 2), (3000, 3)):
        data = rng.integers(0, letters, n).astype(np.uint8)
        raw, order = data.tobytes(), suffix_array.suffix_array(data)
        assert order.tolist() == sorted(range(n), key=lambda i: raw[i:])
        shared = suffix_array.common_prefixes(data, order, 100)
        for j in range(1, n):
            a, b = raw[order[j - 1] :], raw[order[j] :]
            same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert shared[j] == min(same, 100)


def test_internal_nodes():
    words = sorted(["aab", "aab", "aac", "abc", "b"])
    shared = np.array([0] + [next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), 3) for a, b in zip(words, words[1:])])
    assert sorted(suffix_tree.internal_nodes(shared)) == [(1, 0, 4), (2, 0, 3), (3, 0, 2)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], EMPTY)
    for result in (
        jaccard_join.link_components(none), line_dedup.dedup_lines(none), suffix_array.dedup_substrings(none), suffix_tree.dedup_words(none),
    ):
        assert result.collect() == []


def test_null_and_repeated_ids(docs):
    text = brute.sentence(np.random.default_rng(1), 40)
    df = docs([(None, text), (1, text), (1, text), (2, text)])
    assert {(r.doc_id, r.component_id) for r in jaccard_join.link_components(df).collect()} == {(1, 1), (2, 1)}
    for result in (suffix_array.dedup_substrings(df), suffix_tree.dedup_words(df)):
        assert sorted(r.doc_id for r in result.collect()) == [1, 1, 2]
    rows = line_dedup.dedup_lines(df).where("doc_id = 2").collect()
    assert [(r.text, r.n_removed) for r in rows] == [("", 1)]


def test_one_very_common_shingle_does_not_make_sets_enumerate_thousands_of_keys():
    sizes = np.full(jaccard_join.LIGHT_LIMIT + 1, 1000)
    sketch = np.ones(jaccard_join.SKETCH)
    sketch[7] = 1e9
    x = jaccard_join.boundary(sizes, sketch, 85)
    keys = [sum(math.comb(n, c) for _, c in jaccard_join.subset_keys(n, 85, x)) for n in range(1, x + 1)]
    entries = [jaccard_join.prefix_length(n, 85) for n in range(1, x + 1)]
    assert x >= 6 and sum(keys) <= jaccard_join.MEETINGS * sum(entries)


def test_hits_count_every_shingle_in_its_cell(spark):
    rows = [("a b c d e f g",), ("a  b c d e",), ("x y",), ("a b c d e f g a b c d e",)]
    lines = spark.createDataFrame(rows, "words string")
    one_by_one = lines.select(F.explode(line_dedup._shingles(F.col("words"), 5)).alias("t")).groupBy(
        F.col("t").bitwiseAND(line_dedup.CELLS - 1).alias("cell")
    ).count()
    hits = line_dedup._hits(lines, 5)
    assert sorted(tuple(r) for r in hits.where("value > 0").collect()) == sorted(tuple(r) for r in one_by_one.collect())
    # Shingles are made by compiled code: the one lambda left hashes words.
    assert hits._jdf.queryExecution().analyzed().toString().count("lambdafunction") == 1


def test_token_sets_are_shuffled_once_for_both_sides(spark, docs, monkeypatch):
    plans = []

    def kept(df, name):
        plans.append((name, df))
        return stored(df, name)

    monkeypatch.setattr(line_dedup, "stored", kept)
    line = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen"
    given = docs([(1, line), (2, line + " end"), (3, "something else entirely in this one line")])
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert [tuple(r) for r in line_dedup.removed_lines(given).collect()] == [(2, 0)]
        (matched,) = [df for name, df in plans if name == "matched"]
        matched.collect()
        assert "tokens" not in [name for name, _ in plans]
        assert "ReusedExchange" in matched._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)

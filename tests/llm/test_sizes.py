"""What is moved for larger inputs."""

import brute
import numpy as np
import pytest

from tierwell.llm import repeats, suffix_array, suffix_tree, va_file


@pytest.mark.parametrize("words", [False, True])
def test_a_crowded_passage_is_not_moved_window_by_window(docs, words):
    rng = np.random.default_rng(7)
    passage = brute.sentence(rng, 20)
    texts = {i: f"{brute.sentence(rng, 15)} {passage} {brute.sentence(rng, 15)}" for i in range(60)}
    frame = docs(list(texts.items())).repartition(4)
    length, gram = (13, 7) if words else (100, 32)
    spec, seen = repeats.Windows(length, gram, words, not words), []

    def resolve(segments):
        seen.append(segments.count())
        return segments.selectExpr("doc_id", "0L AS start", "0L AS end").limit(0)

    repeats.repeated_spans(spec, repeats.texts_of(frame), resolve, 5)
    assert seen[0] <= 60  # two crowded segments a text hold 7 and about 69 windows each
    if words:
        found = {r.doc_id: (r.n_words, r.n_removed, bytes(r.kept)) for r in suffix_tree.dedup_words(frame, crowd=5).collect()}
        assert found == brute.removed_words(texts, 13)
    else:
        found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_array.dedup_substrings(frame, crowd=5).collect()}
        assert found == brute.removed_bytes(texts, 100)


def test_queries_are_not_broadcast_to_their_meetings(spark, monkeypatch):
    rng = np.random.default_rng(11)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((420, 8)))] + [(500 + i, v.tolist()) for i, v in enumerate(rng.standard_normal((30, 3)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    keep, plans = va_file.stored, {}

    def planned(frame, name):
        plans[name] = frame._jdf.queryExecution().executedPlan().toString()
        return keep(frame, name)

    monkeypatch.setattr(va_file, "stored", planned)
    monkeypatch.setattr(va_file, "BLOCK", 16)
    monkeypatch.setattr(va_file, "QUERY_BLOCK", 2)
    got = va_file.top_k(df, "vec_id % 20 = 0", 10, 1024).select("query_id", "rank", "vec_id", "score").collect()
    whole = {i: [int(np.floor(1024 * x)) for x in v] for i, v in rows}
    want = []
    for q in (i for i in whole if i % 20 == 0):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:10], 1)]
    assert sorted(tuple(r) for r in got) == want
    # What a meeting repeats is larger than its plan's estimate: neither scan may send it through the driver.
    assert all("Broadcast" not in plans[name] for name in ("thresholds", "candidates"))


@pytest.mark.parametrize("sizes", [(1, 1), (13, 3), (151, 25), (753, 121), (4400, 705)])
def test_meetings_cover_all_blocks_and_stay_small(sizes):
    tile, group = va_file.tiling(*sizes, 64)
    assert 1 <= tile <= va_file.TILE and 1 <= group <= va_file.GROUP
    assert -(-sizes[0] // tile) * -(-sizes[1] // group) <= 2 * va_file.MEETINGS

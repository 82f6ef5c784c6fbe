"""Collision counting over sorted projections: the kernel against a plain count, copies, and cells by size."""

import numpy as np
import pytest

from tierwell.llm import collision_dedup as c

RNG = np.random.default_rng(31)


def units(n, d=16):
    v = RNG.standard_normal((n, d))
    return v / np.linalg.norm(v, axis=1, keepdims=True)


@pytest.mark.parametrize("n, m, least", [(1, 1, 26), (63, 65, 26), (200, 64, 20), (130, 300, 32), (70, 70, 1), (300, 129, 26)])
def test_counted_collisions_are_those_of_a_plain_count(n, m, least):
    a, b = units(n), units(m)
    b[: min(n, m) // 2] = a[: min(n, m) // 2] + 0.03 * RNG.standard_normal((min(n, m) // 2, 16))
    a[n // 2 :] = a[0]  # ties
    to, width = c.directions(16, 32), 2 * c.distance(0.98)
    x, y = a @ to, b @ to
    plain = (np.abs(x[:, None, :] - y[None, :, :]) <= width).sum(axis=2) >= least
    found = np.zeros((n, m), dtype=int)
    np.add.at(found, c.collisions(x, y, width, least), 1)
    assert (found == plain).all()


def test_a_group_of_copies_is_one_vector_to_compare(spark):
    one, near, far = units(1, 32)[0], None, units(50, 32)
    near = one + 0.005 * RNG.standard_normal((30, 32))
    rows = [(i, [float(v) for v in np.float32(one)], "a") for i in range(30_000)]
    rows += [(100_000 + i, [float(v) for v in np.float32(v)], "a") for i, v in enumerate(near)]
    rows += [(200_000 + i, [float(v) for v in np.float32(v)], "a") for i, v in enumerate(far)]
    rows += [(300_000, rows[0][1], "b")]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string").repartition(4)
    found = {r.vec_id: r for r in c.near_duplicates(vectors, block=64).collect()}
    assert len(found) == len(rows)
    assert all(found[i].n_links == 30_029 and found[i].component_id == 0 for i in [*range(0, 30_000, 997), *range(100_000, 100_030)])
    assert all(found[i].n_links == 0 and found[i].kept for i in [*range(200_000, 200_050), 300_000])


def test_pairs_are_found_in_many_dealing_projections(spark):
    """Blocks of four vectors make the label deal by four projections; near pairs lie across cell borders."""
    base = units(600, 24)
    rows = [(i, [float(v) for v in u], 1) for i, u in enumerate(base)]
    for i, u in enumerate(base[:300]):
        w = u + 0.19 * units(1, 24)[0]
        rows.append((1000 + i, [float(v) for v in w], 1))
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in rows}
    ids = sorted(unit)
    close = np.stack([unit[i] for i in ids])
    links = ((close @ close.T) >= 0.98).sum(axis=1) - 1
    found = {r.vec_id: r for r in c.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), block=4).collect()}
    assert links.sum() > 400
    assert sum(found[i].n_links for i in ids) >= 0.99 * links.sum()
    assert all(found[i].n_links <= n for i, n in zip(ids, links))

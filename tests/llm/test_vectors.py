"""Nearest vectors against comparing each query with all rows."""

import math

import numpy as np
import pytest

from tonearm.llm import vectors as V

SCHEMA = "vec_id long, embedding array<float>, label int, v string, cid string, y string, cell string, bound string"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, 0, *["x"] * 5) for i, e in rows], SCHEMA)


def plain(rows, k=20, every=20):
    good = {
        (i, tuple(np.float32(x).item() for x in e)) for i, e in rows
        if i is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)
    }
    out = {}
    for q in good:
        if q[0] % every == 0:
            scored = [(-sum(a * b for a, b in zip(q[1], c[1])), c[0]) for c in good if c != q]
            out[q] = sorted(scored)[:k]
    return out


def recall(rows, found, k=20):
    """Share of each query's true neighbours that were found, ties on the last place allowed."""
    by, hits, asked = {}, 0, 0
    for r in found:
        by.setdefault(r["query_id"], []).append(r)
    for (query, _), best in plain(rows, k).items():
        mine = sorted(by.get(query, []), key=lambda r: r["rank"])
        assert len(mine) == len(best) and [r["rank"] for r in mine] == list(range(1, len(best) + 1))
        assert [(r["score"], -r["vec_id"]) for r in mine] == sorted(((r["score"], -r["vec_id"]) for r in mine), reverse=True)
        bar = -best[-1][0] if best else 0
        hits += sum(r["score"] >= bar - 1e-9 for r in mine)
        asked += len(best)
    return hits / asked


def clusters(n, width, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width)) * 2
    return [(i, (centres[i % 12] + rng.normal(size=width)).tolist()) for i in range(n)]


def test_stop_rule_points():
    assert V.chi_square_point(0.95, 8) == pytest.approx(15.507, abs=1e-3)
    assert V.chi_square_cdf(V.chi_square_point(0.9, 16), 16) == pytest.approx(0.9)


@pytest.mark.parametrize("piece_rows", [60, 8192])
def test_recall_and_scores(spark, piece_rows):
    rows = clusters(1500, 24)
    found = V.nearest_vectors(frame(spark, rows), piece_rows=piece_rows).collect()
    assert recall(rows, found) >= 0.9
    of = dict(rows)
    for r in found[:200]:
        exact = float(np.dot(np.float32(of[r["query_id"]]).astype(float), np.float32(of[r["vec_id"]]).astype(float)))
        assert r["score"] == pytest.approx(exact, rel=1e-12, abs=1e-12)


def test_search_stops_before_the_end():
    rng = np.random.default_rng(1)
    x = np.concatenate([c + rng.normal(size=(200, 16)) * 0.05 for c in rng.normal(size=(20, 16))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    projection = V.Projection(16, float((x * x).sum(1).max()))
    g = projection.matrix()
    tree = V.Tree(np.arange(len(x)), np.ones(len(x), np.int64), x, projection.of_rows(x, g))
    leaves = V.box_distances(projection.of_queries(x[:1], g), tree.low, tree.high)[0]
    seen = []
    real = tree.x

    class Counted:
        def __getitem__(self, rows):
            seen.append(len(rows))
            return real[rows]

    tree.x = Counted()
    tree.nearest(x[0], leaves, 20, projection.square, V.chi_square_point(0.95, 8), math.inf)
    assert sum(seen) < len(x) / 2


def test_many_copies_of_one_vector(spark):
    rows = clusters(300, 8) + [(1000 + i, [1.0] * 8) for i in range(400)]
    found = V.nearest_vectors(frame(spark, rows), piece_rows=50).collect()
    assert recall(rows, found) >= 0.9
    mine = [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == 1000 and r["score"] == 8.0]
    assert mine == list(range(1001, 1001 + len(mine)))


def test_awkward_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (20, None), (40, []), (60, [0.0, 0.0]), (80, [nan, 1.0]), (100, [1.0, None]), (120, [inf, 1.0])]
    rows += [(None, [1.0, 1.0]), (5, [3.0]), (6, [1.0, 2.0, 5.0]), (0, [2.0, 2.0]), (10**15, [-1.0, 0.0])]
    got = {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in V.nearest_vectors(frame(spark, rows)).collect()}
    want = set()
    for (query, _), best in plain(rows).items():
        want |= {(query, rank + 1, i, -s) for rank, (s, i) in enumerate(best)}
    assert got == want


def test_empty_tables(spark):
    assert V.nearest_vectors(frame(spark, [])).collect() == []
    assert V.nearest_vectors(frame(spark, [(20, None), (40, [0.0])])).collect() == []
    assert V.nearest_vectors(frame(spark, [(20, [1.0])])).collect() == []

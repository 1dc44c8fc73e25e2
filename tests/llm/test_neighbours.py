"""Probing order and recall against brute force, copies, ties, odd rows."""

from __future__ import annotations

from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerproof.llm import neighbours

from ..conftest import SF_SMALL


def brute(rows, query, best=20):
    """(id, score) of the nearest rows but the query's own, by position."""
    q = np.array(rows[query][1], float)
    out = []
    for k, (i, v) in enumerate(rows):
        if k != query and v is not None and len(v) == len(q) and all(c is not None and np.isfinite(c) for c in v) and any(v):
            out.append((i, float(np.array(v, float) @ q)))
    return sorted(out, key=lambda x: (-round(x[1], 12), x[0] is None, x[0] or 0))[:best]


def test_perturbations_come_in_order_and_once():
    inside = np.array([0.1, 0.7, 0.45, 0.95])
    got = neighbours.perturbations(inside, 10**6)
    every = [[(i, w) for i, w in enumerate(ws) if w] for ws in product((0, -1, 1), repeat=4)]

    def cost(s):
        return sum(inside[i] ** 2 if w < 0 else (1 - inside[i]) ** 2 for i, w in s)

    assert sorted(map(sorted, got)) == sorted(map(sorted, every))
    costs = [cost(s) for s in got]
    assert costs == pytest.approx(sorted(costs)) and got[0] == []


@pytest.mark.parametrize("room", [1 << 20, 1])
def test_all_probes_give_the_exact_answer(spark, room, monkeypatch):
    monkeypatch.setattr(neighbours, "GROUP_FLOATS", room)
    rng = np.random.default_rng(4)
    rows = [(k, rng.normal(size=6).tolist()) for k in range(300)] + [(1000 + k, [0.5] * 6) for k in range(45)]
    rows += [(2000, None), (2020, [0.0] * 6), (2040, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2060, [float("nan")] + [1.0] * 5),
             (2080, [float("inf")] + [1.0] * 5), (None, [0.4] * 6), (20, [3.0] * 6), (3000, [1.0, 2.0]), (3001, [2.0, 1.0]),
             (3002, []), (40, rows[40][1])]
    vectors = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, class int")
    got = {}
    found = neighbours.search(vectors, F.col("id") % 20 == 0, projections=4, probes=81, tables=2)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    for r in found.collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    asked = [k for k, (i, v) in enumerate(rows) if i is not None and i % 20 == 0 and i not in (2000, 2020, 2040, 2060, 2080)]
    assert set(got) == {rows[k][0] for k in asked}
    for k in asked:
        i = rows[k][0]
        if sum(rows[x][0] == i for x in asked) > 1:
            continue  # a repeated id has the answers of each of its rows
        answer = sorted(got[i])
        want = brute(rows, k)
        assert [a[0] for a in answer] == list(range(1, len(want) + 1))
        assert [a[1] for a in answer] == [w[0] for w in want]
        assert [a[2] for a in answer] == pytest.approx([w[1] for w in want])
    assert len(got[40]) == 40 and len(got[3000]) == 1


def test_recall_on_the_table(spark):
    vectors = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    got = {}
    for r in neighbours.digest(vectors).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for k, (i, _) in enumerate(rows):
        if i % 20 == 0:
            want = {x for x, _ in brute(rows, k)}
            hits, total = hits + len(want & got[i]), total + len(want)
    assert hits / total >= 0.9
    assert neighbours.digest(vectors.limit(0)).count() == 0


def found_by(spark, rows, **how):
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.search(vectors, F.col("id") % 20 == 0, **how).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    return got


@pytest.mark.parametrize("odd", ["one long", "lognormal"])
def test_recall_on_mixed_norms(spark, odd, monkeypatch):
    monkeypatch.setattr(neighbours, "WHOLE", 64)
    rng = np.random.default_rng(7)
    x = rng.normal(size=(4000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x *= np.where(np.arange(4000) == 1, 100.0, 1.0)[:, None] if odd == "one long" else rng.lognormal(size=(4000, 1))
    got = found_by(spark, [(k, v.tolist()) for k, v in enumerate(x)])
    hits = total = 0
    for k in range(0, 4000, 20):
        scores = x @ x[k]
        scores[k] = -np.inf
        hits, total = hits + len(set(np.argsort(-scores)[:20].tolist()) & got.get(k, set())), total + 20
    assert hits / total >= 0.998 and min(map(len, got.values())) == 20


def test_short_queries_are_filled_up_exactly(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(400, 24))
    got = found_by(spark, [(k, v.tolist()) for k, v in enumerate(x)] + [(1000, [1.0, 2.0]), (1001, [2.0, 1.0])],
                   projections=30, probes=1, tables=1)
    for k in range(0, 400, 20):
        scores = x @ x[k]
        scores[k] = -np.inf
        assert got[k] == set(np.argsort(-scores)[:20].tolist())
    assert got[1000] == {1001}


def test_ranges_begin_at_the_largest_norm_left():
    of, bands = neighbours.ranges([(-1, 500, -1e-9), (0, 499, 1e-9), (106, 1, 6.64), (-7, 3, -0.4), (-9, 2, -0.55)])
    assert bands == [(1, 6.64), (1002, 1e-9), (2, -0.55)]
    assert of == {106: 0, 0: 1, -1: 1, -7: 1, -9: 2}
    assert np.isfinite([neighbours.log_norm(np.array(v)) for v in ([1e308, 1e308], [5e-324, 0.0])]).all()

import numpy as np
import pytest

from brute import union_find
from conftest import SF01
from tokenloom.llm import embedding_dedup
from tokenloom.llm.common import table
from tokenloom.llm.embedding_dedup import embedding_classes


def brute(rows):
    ok = {}
    for n, (_, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None for x in v) and np.isfinite(v).all() and np.any(v):
            ok.setdefault((label, len(v)), []).append((n, np.array(v, float) / np.abs(v).max()))
    links, count = [], [0] * len(rows)
    for group in ok.values():
        m = np.array([x / np.linalg.norm(x) for _, x in group])
        near = m @ m.T >= 0.98
        np.fill_diagonal(near, False)
        for a, b in np.argwhere(near):
            count[group[a][0]] += 1
            links.append((group[a][0], group[b][0]))
    comp = union_find(range(len(rows)), links)
    big = 1 << 62
    least = {}
    for n, c in comp.items():
        least[c] = min(least.get(c, big), rows[n][0] if rows[n][0] is not None else big)
    at = [None if least[comp[n]] == big else least[comp[n]] for n in range(len(rows))]
    return sorted(repr((r[0], count[n], at[n], r[0] == at[n])) for n, r in enumerate(rows))


def run(spark, rows, kind="array<double>"):
    d = spark.createDataFrame(rows, f"vec_id long, embedding {kind}, label int").repartition(3)
    return sorted(repr(tuple(r)) for r in embedding_classes(spark, d).collect())


@pytest.mark.parametrize("block,dims", [(16, 5), (7, 2), (64, 12)])
def test_matches_brute_force(spark, monkeypatch, block, dims):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rng = np.random.default_rng(block)
    centre = rng.normal(size=(6, dims))
    rows = [(i, (centre[i % 6] + rng.normal(size=dims) * 0.15).tolist(), None if i % 50 == 0 else i % 2) for i in range(500)]
    copies = [(600 + i, rows[1][1], 1) for i in range(30)]
    odd = [(900, None, 1), (901, [0.0] * dims, 1), (902, [1.0, None], 1), (903, [float("nan")] * dims, 1), (904, [1.0], 1), (905, [2.0], 1),
           (906, [], 1), (907, [float("inf")] * dims, 1), (908, [1e300] * dims, 1), (909, [1e-300] * dims, 1), (None, rows[3][1], 1),
           (None, [-1.0], 1), (3, rows[3][1], 1)]
    assert run(spark, rows + copies + odd) == brute(rows + copies + odd)


def test_whole_table_and_empty(spark):
    d = table(spark, SF01, "embeddings")
    assert sorted(repr(tuple(r)) for r in embedding_classes(spark, d).collect()) == brute([(r["vec_id"], r["embedding"], r["label"]) for r in d.collect()])
    assert embedding_classes(spark, d.limit(0)).collect() == []

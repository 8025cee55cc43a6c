import random
from collections import defaultdict

from tokenloom.llm.mixing import apply_mix, mix, targets


def brute_targets(sizes):
    """Deal, stop at twice the size, deal the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    out, left = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values())
    while left > 1e-9:
        still = [s for s in names if out[s] < 2 * sizes[s] - 1e-9]
        if not still:
            break
        share, total = left, sum(weight[s] for s in still)
        for s in still:
            add = min(share * weight[s] / total, 2 * sizes[s] - out[s])
            out[s] += add
            left -= add
    return out


def test_targets(spark):
    rng = random.Random(5)
    for _ in range(3):
        sizes = {f"s{i}": rng.choice([0, 3, 10, 500, 9000]) for i in range(9)} | {None: 40}
        d = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in targets(d).collect()}
        want = brute_targets(sizes)
        assert all(abs(got[s] - want[s]) < 1e-6 * (1 + want[s]) for s in sizes)


def rows(n=300):
    rng = random.Random(1)
    return [(i if i % 50 else None, None if i % 17 == 0 else " ".join(["w"] * rng.randrange(0, 30)),
             None if i % 11 == 0 else f"s{min(4, rng.randrange(9))}", i) for i in range(n)]


def test_mix_meets_targets(spark):
    d = spark.createDataFrame(rows(), "doc_id long, text string, source string, key long")
    out = mix(spark, d).collect()
    assert len(out) == 300
    taken, goal = defaultdict(int), {}
    for r in out:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        goal[r["source"]] = r["target"]
    assert {s: int(g) for s, g in goal.items()} == dict(taken)
    again = mix(spark, d.repartition(7)).collect()
    assert sorted(map(repr, out)) == sorted(map(repr, again))


def test_apply_mix_has_the_words(spark):
    d = spark.createDataFrame(rows(), "doc_id long, text string, source string, part long")
    words = lambda t: len((t or "").split())
    got, want = defaultdict(int), defaultdict(int)
    mixed = apply_mix(spark, d)
    assert mixed.columns == d.columns
    for r in mixed.collect():
        got[r["source"]] += words(r["text"])
    for r in mix(spark, d).collect():
        want[r["source"]] += r["taken"]
    assert got == want


def test_empty(spark):
    d = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mix(spark, d).collect() == [] and apply_mix(spark, d).collect() == []
    d = spark.createDataFrame([(1, None, None), (1, None, None)], "doc_id long, text string, source string")
    assert [r["taken"] for r in mix(spark, d).collect()] == [0, 0] and apply_mix(spark, d).collect() == []

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF01
from tokenloom.llm import packing
from tokenloom.llm.common import table
from tokenloom.llm.packing import Slots, encoder, pack, solve

VOCAB, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def exact():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(VOCAB)
    return lambda x: t.encode(x, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_same_ids_as_the_tokenizer(exact, text):
    assert list(encoder(VOCAB, RANKS)(text)) == exact(text)


def test_ids_of_odd_texts(exact):
    for t in ["", " ", "a<|endoftext|>b", "<|endoftext|>", "it's  we'll\n\n x", "\u00a0é\u2028ȿ\u0378", "x" * 3000, "\x85\x1c \t"]:
        assert list(encoder(VOCAB, RANKS)(t)) == exact(t)


def valid(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in by.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= capacity
    return len(by)


def test_pack_round_trip(spark, exact, monkeypatch):
    monkeypatch.setattr(packing, "PART_ROWS", 7)
    rng = random.Random(0)
    rows = [(i, " ".join(rng.choice(["tok", "pack", "é", "zebra"]) for _ in range(rng.randrange(0, 90)))) for i in range(80)]
    rows += [(200, None), (201, ""), (None, "no id"), (5, rows[5][1]), (202, "w " * 64)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = pack(spark, d, capacity=64).collect()
    n = valid(out, 64)
    want = []
    for i, t in rows:
        ids = np.array([*exact(t or ""), 0], "<u4")
        first = min(len(ids), len(ids) % 64 or 64)
        cuts = [0, *range(first, len(ids) + 1, 64)]
        want += [(i, k, a, z - a, zlib.crc32(ids[a:z].tobytes())) for k, (a, z) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)[:5]) for r in out)
    assert n <= 1.02 * sum(w[3] for w in want) / 64 + 1
    assert pack(spark, d.limit(0)).collect() == []


def test_few_sequences(spark):
    out = pack(spark, table(spark, SF01, "documents").select("doc_id", "text")).collect()
    assert valid(out, 2048) <= -(-sum(r["length"] for r in out) // 2048) * 1.005 + 1


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(0, 40), max_size=12))
def test_solver_holds_everything_once(histogram):
    plan, placed = solve(histogram, 32)
    assert placed <= sum(histogram.values())
    total = {}
    for combo, times in plan:
        assert times > 0 and sum(x * a for x, a in combo.items()) <= 32
        for x, a in combo.items():
            total[x] = total.get(x, 0) + a * times
    assert total == {x: n for x, n in histogram.items() if n}
    slots = Slots(plan)
    places = set()
    for x, n in total.items():
        seq, off = slots.find(np.full(n, x), np.arange(n))
        places |= {(int(s), int(o) + j) for s, o in zip(seq, off) for j in range(x)}
    assert len(places) == sum(x * n for x, n in total.items())
    assert all(0 <= s < slots.sequences and 0 <= o < 32 for s, o in places)


def lognormal(n):
    rng, out = np.random.default_rng(0), {}
    for x in np.clip(rng.lognormal(6, 1, n).astype(int), 1, 20000).tolist():
        first = min(x, x % 2048 or 2048)
        out[first] = out.get(first, 0) + 1
        if x > first:
            out[2048] = out.get(2048, 0) + (x - first) // 2048
    return out


@pytest.mark.parametrize("name", [SF01, "/root/testdata/sf0.1", "lognormal", "three of each"])
def test_the_program_places_nearly_all(spark, name):
    if name == "lognormal":
        h = lognormal(300_000)
    elif name == "three of each":
        h = {x: 3 for x in range(1, 2049)}
    else:
        p = packing.pieces(table(spark, name, "documents"))
        h = {r["length"]: r["count"] for r in p.groupBy("length").count().collect()}
    plan, placed = solve(h)
    below = sum(h.values()) - h.get(2048, 0)
    assert placed - h.get(2048, 0) >= 0.95 * below
    tokens = sum(x * n for x, n in h.items())
    assert sum(times for _, times in plan) <= -(-tokens // 2048) * 1.005 + 1


def test_columns_are_the_dearest():
    rng = random.Random(4)
    for _ in range(20):
        lengths = np.array(sorted(rng.sample(range(1, 20), 4)))
        left, price = np.array([rng.randrange(1, 4) for _ in lengths]), np.array([rng.random() for _ in lengths])
        for k, combo in enumerate(packing._columns(lengths, price, left, 20)):
            beside = {j: a - (j == k) for j, a in combo.items()}
            assert combo[k] >= 1 and sum(lengths[j] * a for j, a in combo.items()) <= 20
            best = max(sum(price[j] * a for j, a in enumerate(c)) for c in itertools.product(*(range(n + 1) for n in left))
                       if sum(lengths[j] * a for j, a in enumerate(c)) <= 20 - lengths[k])
            assert abs(sum(price[j] * a for j, a in beside.items()) - best) < 1e-9

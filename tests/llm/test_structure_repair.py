"""Repairs against every possible edit of short conversations, and against a left-to-right pass over long ones."""

import hashlib
import itertools
import random
import re

import numpy as np

from tokenloom.llm.structure_repair import parse, repair, repair_damaged, repaired_turns

SCHEMA = "conv_id long, turn long, role string, text string"


def exhaustive(rows):
    """rows: (initial, must be deleted, cut short). The least (cost, audit) over all edits, insertions of up to two turns."""
    gaps = ["", "u", "a", "ua", "au"]
    edits = []
    for i, must, cut in rows:
        e = [("", 3, "D")]
        if not must:
            e += [(i, cut, "K"), ("u", 2 + cut, "R"), ("a", 2 + cut, "R")]
        edits.append(e)
    best = None
    for chosen in itertools.product(*edits):
        for gap in itertools.product(gaps, repeat=len(rows) + 1):
            made = gap[0] + "".join(e[0] + g for e, g in zip(chosen, gap[1:]))
            if re.fullmatch("(s?(ua)+)?", made):
                now = (sum(e[1] for e in chosen) + 2 * sum(map(len, gap)),
                       "I" * len(gap[0]) + "".join(e[2] + "I" * len(g) for e, g in zip(chosen, gap[1:])))
                best = min(best or now, now)
    return best


def forward(rows):
    """The same for any length, one row at a time."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}

    def insert(at):
        for _ in range(3):
            for (p, role), q in step.items():
                if role != "s" and p in at:
                    new = (at[p][0] + 2, at[p][1] + "I")
                    at[q] = min(at.get(q, new), new)
        return at

    at = {0: (0, "")}
    for i, must, cut in rows:
        insert(at)
        nxt = {}
        for p, (c, a) in at.items():
            offers = [(p, c + 3, "D")]
            for role in "sua":
                if (p, role) in step and not must:
                    if i == role:
                        offers.append((step[p, role], c + cut, "K"))
                    if role != "s":
                        offers.append((step[p, role], c + 2 + cut, "R"))
            for q, cost, e in offers:
                nxt[q] = min(nxt.get(q, (cost, a + e)), (cost, a + e))
        at = nxt
    insert(at)
    return min(at[q] for q in (0, 3) if q in at)


def test_parse_against_all_edits():
    for n in (1, 2, 3):
        cases = list(itertools.product([("s", 0, 0), ("u", 0, 0), ("a", 0, 1), ("u", 1, 0), ("x", 0, 1), ("s", 0, 1)], repeat=n))
        cases = cases if n < 3 else random.Random(1).sample(cases, 25)
        arr = lambda k, t: np.array([[r[k] for r in c] for c in cases], t)
        cost, audit = parse(arr(0, str), arr(1, bool), arr(2, int))
        for j, c in enumerate(cases):
            got = min((int(cost[j, 0, q]), audit[j, 0, q].decode()) for q in (0, 3))
            assert got == exhaustive(c) == forward(c), c


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def expected(rows):
    """rows: (turn, role, text) of one conversation, in order."""
    told = [(r or "", t or "") if r is not None and t is not None else (" " if r is None else r, " " if t is None else t) for _, r, t in rows]
    bad = faults(told)
    cost, audit = forward([(r[:1], b in ("blank", "duplicate"), int(b == "truncated")) for (r, _), b in zip(told, bad)])
    kept, at, system = [], 0, (len(audit) - audit.count("D")) % 2
    for e in audit:
        row = ("", "") if e == "I" else told[at]
        at += e != "I"
        if e != "D":
            kept.append((row[0] if e == "K" else "user" if (len(kept) - system) % 2 == 0 else "assistant", row[1]))
    turns = {t for t, _, _ in rows if t is not None}
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(told, told[1:]))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(bad.count(x) for x in ("blank", "duplicate", "truncated")), illegal,
            cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()), kept


def test_whole_conversations(spark):
    rng = random.Random(5)
    rows = {}
    for conv, n in [(None, 5), (1, 1), (2, 2), (3, 11), (4, 12), (5, 13), (6, 40), (7, 950), *((i, rng.randrange(1, 9)) for i in range(20, 60))]:
        made = [(None if rng.random() < .1 else k * 2 if rng.random() < .2 else k, rng.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool"]),
                 rng.choice(["", " \n", None, "é.", "Hm? \t", "no end", "a!", f"own {k}.", f"own {k}", f"x{k}?"])) for k in range(n)]
        rows[conv] = sorted(made, key=lambda r: (r[0] is not None, r[0] or 0, " " if r[1] is None else r[1], " " if r[2] is None else r[2]))
    rows[8] = [(0, "user", "word " * 40000 + "."), (1, "assistant", "b" * 200000)]
    flat = [(c, *r, 1, "z", 3) for c, rs in rows.items() for r in rs]
    rng.shuffle(flat)
    df = spark.createDataFrame(flat, SCHEMA + ", pos int, block string, fault int")
    got = {r["conv_id"]: tuple(r)[1:] for r in repair(spark, df).collect()}
    assert got == {c: expected(rs)[0] for c, rs in rows.items()}
    turns = {}
    for r in sorted(repaired_turns(spark, df).collect(), key=lambda r: (r["block"], r["place"])):
        turns.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert turns == {c: k for c, k in ((c, expected(rs)[1]) for c, rs in rows.items()) if k}


def test_empty_and_dropped(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair(spark, empty).collect() == [] and repair_damaged(spark, empty).collect() == []
    import zlib
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:1".encode()) % 20 == 0)
    r = repair_damaged(spark, spark.createDataFrame([(gone, 1, "user", "hi.")], SCHEMA)).collect()
    assert [tuple(x) for x in r] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]

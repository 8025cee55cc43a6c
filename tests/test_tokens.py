"""Golden values for the token-sequence functions (T1-T14, L2-L4, O13, U1 bytes)."""

import pyarrow as pa
from pyspark.sql import functions as F

from tokenloom.functions import text as X
from tokenloom.functions import tokens as T
from tokenloom.functions.text import normalize_text
from tokenloom.layout import STAGE1, STAGE2


def one(spark, df_cols, expr):
    return spark.createDataFrame([df_cols[0]], df_cols[1]).select(expr.alias("x")).first().x


def test_stage1_input_and_target(spark):
    # text [2050,2051,2561], bands [1,2] / [3,4], batch width 9
    row = ([2050, 2051, 2561], [[1, 2], [3, 4]])
    schema = "t array<int>, c array<array<int>>"
    inp = one(spark, (row, schema), T.stage1_input("t", "c", 9))
    tgt = one(spark, (row, schema), T.stage1_target("t", "c", 9))
    assert inp == [2050, 2051, 2561, 1, 1027, 2, 1028, 2048, 2048]
    assert tgt == [-1, -1, 1, 1027, 2, 1028, 2048, -1, -1]
    # the bounded (L2) form equals the full form cut afterwards, for every cut
    for L in range(1, 12):
        assert one(spark, (row, schema), T.stage1_input("t", "c", 9, max_len=L)) == inp[:L]
        assert one(spark, (row, schema), T.stage1_target("t", "c", 9, max_len=L)) == tgt[:L]


def test_deinterleave_by_value(spark):
    toks = [5, 1030, 7, 2048, 2050, 1500, 3, 2561, -1]
    df = spark.createDataFrame([(toks,)], "t array<int>")
    text, codes = T.deinterleave("t", 1024)
    r = df.select(text.alias("text"), codes.alias("codes")).first()
    assert r.text == [2050]
    assert r.codes == [[5, 7], [6, 476]]


def test_deinterleave_inverts_interleave(spark):
    df = spark.createDataFrame([([2050, 2051, 2561], [[1, 2, 3], [4, 5, 6]])], "t array<int>, c array<array<int>>")
    flat = F.concat("t", T.interleave("c"), F.array(F.lit(2048)))
    text, codes = T.deinterleave(flat, 1024)
    r = df.select(text.alias("text"), codes.alias("codes")).first()
    assert r.text == [2050, 2051] and r.codes == [[1, 2, 3], [4, 5, 6]]


def test_untilt_cuts_to_shortest(spark):
    rows = [[1030, 1031, 1, 2, 3, 1024], [4, 5, 1024], [7, 8, 9, 1024]]
    df = spark.createDataFrame([(rows,)], "r array<array<int>>")
    text, codes = T.untilt("r", 1024)
    r = df.select(text.alias("text"), codes.alias("codes")).first()
    assert r.text == [1030]
    assert r.codes == [[1, 2], [4, 5], [7, 8]]


def test_stage2_input_pads_and_cuts(spark):
    df = spark.createDataFrame([([1100, 1101], [[1, 2], [3, 4]])], "t array<int>, c array<array<int>>")
    r = df.select(T.stage2_input("t", "c", 8).alias("x"), T.stage2_input("t", "c", 3).alias("y")).first()
    assert r.x == [[1100, 1101, 1, 2, 1024, 1024, 1024, 1024], [1024, 1024, 3, 4, 1024, 1024, 1024, 1024]]
    assert r.y == [[1100, 1101, 1], [1024, 1024, 3]]


def test_fill_codebooks_and_stack(spark):
    df = spark.createDataFrame([([[1, 2], [3, 4]],)], "c array<array<int>>")
    r = df.select(T.fill_codebooks("c", 4).alias("x")).first()
    assert r.x == [[1, 2], [3, 4], [0, 0], [0, 0]]


def test_marker_mask_crop_take_until(spark):
    df = spark.createDataFrame([([1, 2, 9, 3, 9],)], "t array<int>")
    r = df.select(T.mask_after_marker("t", 9).alias("m"), T.crop_context("t", 2).alias("c"),
                  T.take_until("t", 9).alias("u"), T.mask_after_marker("t", 7).alias("none")).first()
    assert r.m == [False, False, True, True, True]
    assert r.c == [3, 9] and r.u == [1, 2, 9] and r.none == [False] * 5


def test_overlay_with_full_mask_is_original(spark):
    df = spark.createDataFrame([([1, 2, 3], [7, 8, 9], 3)], "p array<int>, o array<int>, n int")
    r = df.select(T.overlay("p", "o", T.prefix_mask("n", F.lit(3))).alias("x"),
                  T.overlay("p", "o", T.prefix_mask("n", F.lit(3)) if False else T.prefix_mask(F.lit(1), F.lit(3))).alias("y")).first()
    assert r.x == [7, 8, 9]
    assert r.y == [7, 2, 3]


def test_byte_tokens_roundtrip_and_offset(spark):
    df = spark.createDataFrame([("hé",)], "s string")
    r = df.select(T.byte_tokens("s").alias("t"), T.byte_decode(T.byte_tokens("s")).alias("d"),
                  T.shift_ids(T.byte_tokens("s"), -STAGE1.text_offset).alias("raw")).first()
    assert r.raw == [104, 195, 169, 256]
    assert r.t == [x + 2049 for x in [104, 195, 169, 256]]
    assert r.d == "hé"
    assert STAGE1.eot == 2561 and STAGE2.eot == 1537


def test_prompt_rows_and_null_pad(spark):
    df = spark.createDataFrame([([5, 6],)], "t array<int>")
    r = df.select(T.pad_rows(T.prompt_rows("t", 2), F.lit(4), 0).alias("x"),
                  T.null_pad_tokens(F.array(F.lit(1), F.lit(-1))).alias("n")).first()
    assert r.x == [[5, 6, 0, 0], [1024, 1024, 0, 0]]
    assert r.n == [1, None]


def test_bpe_special_token_is_an_error_row_and_matches_bytes(spark):
    from tokenloom.operators.models import EOT_STRING, SPECIAL_TOKEN_ERROR, bpe_decode, bpe_encode

    df = spark.createDataFrame([("hé llo",), (f"a {EOT_STRING} b",), (None,)], "text string")
    out = bpe_encode(df, "text").orderBy("text").collect()
    by = {r.text: r for r in out}
    assert by["hé llo"].tokens == [x + 2049 for x in list("hé llo".encode()) + [256]]
    assert by[f"a {EOT_STRING} b"].tokens is None and by[f"a {EOT_STRING} b"].error == SPECIAL_TOKEN_ERROR
    assert by[None].error == "null text"
    dec = bpe_decode(bpe_encode(df, "text").filter("error is null"), "tokens").first()
    assert dec.decoded == "hé llo" + EOT_STRING


def test_prompt_rows_prefix_equals_encoded_text(spark):
    df = spark.createDataFrame([([5, 6, 7],), ([9],)], "t array<int>")
    rows = df.select("t", T.pad_rows(T.prompt_rows("t", 3), F.lit(4), 0).alias("x")).collect()
    for r in rows:
        assert r.x[0][: len(r.t)] == r.t
        assert all(set(row[: len(r.t)]) == {1024} for row in r.x[1:])
        assert all(len(row) == 4 for row in r.x)


def test_utf8_bytes_all_planes(spark):
    cases = ["", "a", "\x00\x7f", "é€", "a😀b", "\U0010FFFF", "日本語テキスト"]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    got = [r.b for r in df.select(T.utf8_bytes("s").alias("b")).collect()]
    assert got == [list(c.encode("utf-8")) for c in cases]


def test_overlay_and_masks_work_on_batches(spark):
    """Arrays go through Arrow or are runs: no lambda is called per token; nulls and rows of unequal length as before."""
    rows = [(1, [1, 2, 3], [7, None, 9], [True, True, False], 2, 3), (2, [1, 2, 3], [7], [None, True], 5, 3), (3, None, [1], [True], None, 2)]
    d = spark.createDataFrame(rows, "i int, p array<int>, o array<int>, m array<boolean>, n int, w int")
    out = d.select("i", T.overlay("p", "o", "m").alias("x"), T.prefix_mask("n", "w").alias("k"))
    assert [tuple(r) for r in out.orderBy("i").collect()] == [
        (1, [7, None, 3], [True, True, False]), (2, [1, None, 3], [True, True, True]), (3, None, [None, None])]
    assert "lambda" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_byte_tokens_work_on_batches(spark):
    d = spark.createDataFrame([(1, "aé"), (2, ""), (3, None), (4, "b")], "i int, t string").coalesce(1)
    out = d.select("i", T.byte_tokens("t").alias("x"))
    assert [r["x"] for r in out.orderBy("i").collect()] == [[2049 + b for b in (97, 195, 169, 256)], [2305], None, [2049 + 98, 2305]]
    assert "lambda" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_tokens_of_normalised_text_need_one_python_step(spark):
    """A step more is a worker more in every task, each with batches of its own."""
    d = spark.createDataFrame([(1, "a\u2019 b"), (2, None), (3, "")], "i int, t string").coalesce(1)
    out = d.select("i", T.byte_tokens(normalize_text("t")).alias("x"))
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython [") == 1
    assert [r["x"] for r in out.orderBy("i").collect()] == [[2049 + b for b in (*b"a' b", 256)], None, [2305]]


def test_byte_tokens_of_broken_utf8(spark):
    d = spark.sql("SELECT cast(X'61FF62' AS string) AS t, 65 AS n")
    r = d.select(T.byte_tokens("t").alias("x"), T.byte_tokens("n").alias("y")).first()
    assert r.x == [2049 + b for b in (97, 0xEF, 0xBF, 0xBD, 98, 256)] and r.y == [2049 + b for b in (*b"65", 256)]


def test_overlay_and_normalisation_work_in_pieces(spark, monkeypatch):
    """However large an Arrow batch is, what is made of it at once is bounded."""
    monkeypatch.setattr(T, "IDS_AT_ONCE", 10)
    seen, one = [], T._overlaid_rows
    monkeypatch.setattr(T, "_overlaid_rows", lambda rows: seen.append(len(rows[0])) or one(rows))
    pred = [[i] * (6 if i % 3 else 2) for i in range(9)]
    orig, mask = [[-1] * 6] * 9, [[True] + [False] * 5] * 9
    f = T._overlaid.func
    got = f(pa.array(pred, pa.list_(pa.int32())), pa.array(orig, pa.list_(pa.int32())), pa.array(mask, pa.list_(pa.bool_())))
    assert got.to_pylist() == [[-1, *p[1:], *[None] * (6 - len(p))] for p in pred] and seen == [1] * 9
    empty = pa.array([], pa.list_(pa.int32()))
    assert len(f(empty, empty, pa.array([], pa.list_(pa.bool_())))) == 0
    monkeypatch.setattr(X, "BYTES_AT_ONCE", 4)
    texts = [*X._normalized.func(iter([pa.array(["a  b", None, "*c", "\u2122", "", "long enough"])]))]
    assert [x for t in texts for x in t.to_pylist()] == ["a b", None, "c", "\u2122", "", "long enough"] and len(texts) > 2


def test_overlays_start_few_workers(spark):
    """The last stage of the query has two Python steps, not five."""
    import __spark_entry__ as E
    from conftest import SF001

    plan = E.queries()["overlays"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Join [pos#")[0].count("ArrowEvalPython [") == 2


def test_tokens_of_several_texts(spark, monkeypatch):
    rows = [(1, ["a\u2019 b", None, ""]), (2, None), (3, []), (4, ["  c*d"]), (5, ["x" * 50, "\u2122"])]
    d = spark.createDataFrame(rows, "i int, t array<string>").coalesce(1)
    out = d.select("i", T.byte_tokens_of_all(X.normalize_texts("t")).alias("x"), F.transform("t", lambda t: t).alias("t"))
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython [") == 1
    one = d.select("i", F.posexplode("t").alias("k", "s")).select("i", "k", T.byte_tokens(normalize_text("s")).alias("x"))
    want = {(r["i"], r["k"]): r["x"] for r in one.collect()}
    got = {r["i"]: r["x"] for r in out.collect()}
    assert {(i, k): x for i, v in got.items() for k, x in enumerate(v or [])} == want and got[2] is None and got[3] == []
    b = pa.array([t for _, t in rows], pa.list_(pa.string())).slice(1)
    assert [r for part, _, _ in X.text_lists(b, 4) for r in part.to_pylist()] == [t for _, t in rows[1:]]
    monkeypatch.setattr(T, "IDS_AT_ONCE", 4)
    assert len([*T._tokens_of_all(5).func(iter([b]))]) > 1

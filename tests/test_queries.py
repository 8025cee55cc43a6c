"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001

sys_tables = ("region nation customer supplier part orders lineitem events documents embeddings pages "
              "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in sys_tables:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def _canon(v):
    if isinstance(v, (list, tuple)):
        return tuple(_canon(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(sorted((k, _canon(x)) for k, x in v.asDict().items()))
    return v


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    cols = df.columns
    got = sorted((tuple(_canon(r[c]) for c in sorted(cols)) for r in df.collect()), key=repr)
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == sorted(cols)
    idx = {c: i for i, c in enumerate(dcols)}
    exp = sorted((tuple(_canon(r[idx[c]]) for c in sorted(cols)) for r in cur.fetchall()), key=repr)
    assert got == exp


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["batch_id", "row", "pos", "key", "text", "embedding", "codes", "input", "target"]


def test_rows_only_queries_run(spark):
    for name in sorted(set(E.queries()) - set(E.oracle_sql())):
        assert E.queries()[name](spark, SF001).count() >= 0


POSITIONED = ["training_batches", "fixed_batches", "positions_by_length", "shuffled_batches", "length_sorted_batches",
              "merged_rank_lists", "prompt_batches", "batch_shapes", "collate_full", "restored_order", "batch_token_len",
              "length_guard", "prefix_masks", "overlays"]


@pytest.mark.parametrize("name", POSITIONED)
def test_position_queries_with_many_ranges(spark, con, name, monkeypatch):
    from tokenloom.operators import position

    monkeypatch.setattr(position, "ROWS_PER_RANGE", 37)
    test_query_matches_oracle(spark, con, name)


@pytest.mark.parametrize("name", POSITIONED)
def test_position_queries_have_no_single_task_window(spark, name):
    plan = E.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    windows = plan.split("Window ")[1:]
    assert not any("SinglePartition" in w.split("Exchange", 2)[1] for w in windows if w.count("Exchange"))

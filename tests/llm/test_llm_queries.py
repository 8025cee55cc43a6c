"""The registered queries: oracle SQL where there is one, and the pipeline against plain Python."""

import duckdb
import pytest

import __spark_entry__ as E
import brute
import corpus_pipeline
from conftest import SF001
from tokenloom.llm import queries
from tokenloom.llm.common import stage, table


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    cur = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(map(repr, map(tuple, df.select(*cols).collect()))) == sorted(map(repr, cur.fetchall()))


def test_every_operator_is_registered():
    names = set(E.queries())
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_rows(spark, name):
    df = queries.QUERIES[name](spark, SF001)
    whole = "embeddings" if name.startswith("op10") else "documents"
    assert df.count() >= table(spark, SF001, whole).count()


def test_pipeline_stages(spark):
    docs = table(spark, SF001, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "jaccard_join", "mix_sources", "best_fit_packing"]
    rows = lambda d: sorted((r["doc_id"], r["text"]) for r in d.select("doc_id", "text").collect())
    after = []
    for name, step in corpus_pipeline.STAGES:
        docs = stage(spark, step(spark, docs, SF001), "test")
        after.append(docs)
        if name != "best_fit_packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert docs.where("n_chars <> length(text)").count() == 0
    source = rows(table(spark, SF001, "documents"))
    assert rows(after[0]) == [r for r in source if any(c.isalpha() for c in r[1] or "")]
    assert rows(after[1]) == sorted((i, t) for i, _, _, t in brute.line_dedup(rows(after[0])))
    classes = brute.jaccard(rows(after[1]), 5, 80, 100)
    assert rows(after[2]) == [r for r in rows(after[1]) if classes[r[0]][1] == r[0]]
    before, mixed = dict(rows(after[2])), rows(after[3])
    for i, text in mixed:
        assert before[i] == text or " ".join(before[i].split()).startswith(text)
    size = lambda rs: sum(len(brute.words(t)) for _, t in rs)
    assert abs(size(mixed) - 1.5 * size(rows(after[2]))) < 30
    lengths = [r["length"] for r in after[4].collect()]
    assert len({r["doc_id"] for r in after[4].collect()}) == len({i for i, _ in mixed})
    assert after[4].select("sequence_id").distinct().count() <= -(-sum(lengths) // 2048) * 1.01 + 1

import __spark_entry__ as E
from tokenloom.plans.catalog import QUERIES, load_all
from tokenloom.plans.coverage import COVERAGE


def test_every_covered_query_is_registered():
    load_all()
    qs = set(QUERIES)
    assert qs <= set(E.queries())
    named = {q for _, names in COVERAGE.values() for q in names}
    assert named <= qs, named - qs
    assert qs <= named, qs - named


def test_every_survey_id_is_covered():
    ids = [f"S{i}" for i in range(1, 10)] + [f"P{i}" for i in range(1, 19)] + [f"J{i}" for i in range(1, 8)] \
        + [f"A{i}" for i in range(1, 13)] + [f"O{i}" for i in range(1, 14)] + [f"L{i}" for i in range(1, 6)] \
        + [f"G{i}" for i in range(1, 4)] + [f"T{i}" for i in range(1, 23)] + [f"U{i}" for i in range(1, 7)] \
        + [f"R{i}" for i in range(1, 4)]
    assert sorted(ids) == sorted(COVERAGE)


def test_sql_queries_stand_for_the_tokeniser():
    assert COVERAGE["U1"][1][:2] == ["text_tokens", "text_roundtrip"]

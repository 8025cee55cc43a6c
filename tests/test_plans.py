"""Plan-shape regression guards (static plans, AQE off)."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF001


def _plan(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return E.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("name", ["softmax_arrays", "top_k_arrays", "top_p_arrays", "drawn_arrays", "sampled_arrays",
                                  "guided_arrays", "top_p_b_arrays", "sampled_arrays_a", "sampled_arrays_b",
                                  "scaled_logits", "artifact_paths", "parse_requests", "segment_windows",
                                  "gathered_embeddings", "interleaved_codes", "padded_lengths"])
def test_projection_queries_do_not_shuffle(spark, name):
    assert "Exchange" not in _plan(spark, name)


def test_long_softmax_shuffles_once_by_group(spark):
    plan = _plan(spark, "softmax_scores")
    assert len(re.findall(r"Exchange hashpartitioning\(grp", plan)) == 1
    assert plan.count("Exchange") == 1


def test_flagship_shape(spark):
    plan = _plan(spark, "training_batches")
    # one exchange feeds all four batch-maximum windows
    assert len(re.findall(r"Exchange hashpartitioning\(batch_id", plan)) == 1
    # the text is shuffled by key before tokenising: the exchange below the tokeniser
    # repartitions raw scan columns
    assert re.search(r"Exchange hashpartitioning\(key#\d+, \d+\), REPARTITION_BY_COL", plan)
    # narrow stage reads no text: some scans of documents carry only doc_id and source
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in plan


def test_first_wins_aggregates_narrow_rows(spark):
    plan = _plan(spark, "first_turns")
    assert "partial_min(turn" in plan and "LeftSemi" in plan and "Window" not in plan and "SortAggregate" not in plan


@pytest.mark.parametrize("name", ["normalize_text", "text_tokens", "stage2_inputs", "untilted", "deinterleaved"])
def test_text_queries_do_not_reshuffle_rows(spark, name):
    assert "RoundRobin" not in _plan(spark, name)


@pytest.mark.parametrize("name", ["utterance_embeddings", "speaker_embeddings"])
def test_vector_means_do_not_explode(spark, name):
    assert "Generate" not in _plan(spark, name)

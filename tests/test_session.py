"""Submitter's settings, shared folder, store safety, model cache."""

import os
import subprocess
import sys
from types import SimpleNamespace

import pytest
from pyspark.sql import types as T

from conftest import ROOT
from tokenloom.operators.models import map_model
from tokenloom.session import checkpoint_dir
from tokenloom.sources import files as FS


def test_submitted_settings_survive():
    code = ("from tokenloom.session import get_spark; s = get_spark('local[1]', **{'spark.sql.session.timeZone': 'CET'});"
            "print([s.conf.get(k) for k in ('spark.sql.shuffle.partitions', 'spark.sql.session.timeZone', 'spark.ui.enabled')])")
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--conf spark.sql.shuffle.partitions=333 pyspark-shell", "PYTHONPATH": str(ROOT)}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120, cwd=ROOT)
    assert "['333', 'CET', 'false']" in out.stdout, out.stderr[-500:]


def test_cluster_without_shared_folder_is_an_error():
    conf = SimpleNamespace(get=lambda k, d=None: d)
    sc = SimpleNamespace(getConf=lambda: conf, getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(SimpleNamespace(conf=conf, sparkContext=sc))


def test_corrupt_store_is_not_a_first_write(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "key string, v int")
    FS.write_artifact(rows, str(tmp_path), "kind")
    (tmp_path / "kind" / "run=bad").mkdir()
    (tmp_path / "kind" / "run=bad" / "part-00000.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        FS.write_artifact(rows, str(tmp_path), "kind")


def test_first_row_by_position_is_stored(spark, tmp_path):
    rows = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z")], "key string, pos long, v string")
    FS.write_artifact(rows, str(tmp_path), "kind")
    FS.write_artifact(rows, str(tmp_path), "kind")
    assert sorted((r["key"], r["v"]) for r in FS.read_artifact(spark, str(tmp_path), "kind").collect()) == [("a", "y"), ("b", "z")]


def test_models_load_once_per_worker(spark, tmp_path):
    folder = str(tmp_path)

    def loader():
        import tempfile

        tempfile.mkstemp(prefix=f"load-{os.getpid()}-", dir=folder)
        return 2

    df = spark.range(0, 64, 1, 8)
    out = map_model(df, loader, lambda m, pdf: [m * x for x in pdf["id"]], "v", T.LongType(), name="twice")
    assert out.where("v = 2 * id").count() == 64
    loads = [f.split("-")[1] for f in os.listdir(folder)]
    assert len(loads) == len(set(loads)) <= 4  # one per worker process, not one per task

"""Where scratch tables go."""

from __future__ import annotations

import os
import subprocess
import sys
from types import SimpleNamespace

import pytest

from tallyloom.session import materialize, scratch_path


def stub(conf, master, checkpoint=None):
    settings = dict(conf)
    return SimpleNamespace(
        conf=SimpleNamespace(get=settings.get, set=settings.__setitem__),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint),
    )


def test_cluster_names_the_folder():
    shared = stub({"spark.checkpoint.dir": "hdfs:///shared/"}, "yarn")
    assert scratch_path(shared, "x").startswith("hdfs:///shared/x-")
    assert scratch_path(shared, "x") != scratch_path(shared, "x")
    assert scratch_path(stub({}, "yarn", "hdfs:///ck"), "x").startswith("hdfs:///ck/x-")


def test_a_cluster_without_a_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(stub({}, "spark://host:7077"), "x")


def test_written_tables_keep_rows_and_schema(spark):
    rows = spark.range(100).selectExpr("id", "CASE WHEN id % 2 = 0 THEN id END AS even")
    written = materialize(rows, "rows")
    assert written.dtypes == rows.dtypes and written.exceptAll(rows).isEmpty() and written.count() == 100


def test_a_plain_local_session_has_scratch(tmp_path):
    """Without any Spark defaults a local session writes below a folder of its own, which goes with it."""
    code = (
        "from tallyloom.session import local_session, materialize, scratch_path\n"
        "spark = local_session(1)\n"
        "assert spark.conf.get('spark.checkpoint.dir', None) is None\n"
        "assert materialize(spark.range(3), 'rows').count() == 3\n"
        "print('ROOT', scratch_path(spark, 'x').rpartition('/')[0].removeprefix('file:'))\n"
    )
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "TMPDIR": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=180)
    assert done.returncode == 0, done.stderr
    root = done.stdout.rpartition("ROOT ")[2].strip()
    assert root.startswith(str(tmp_path)) and not os.path.exists(root)

"""Scratch tables: where they live and when they go."""

import os
import subprocess
import sys
import time

import pytest

from airmart import session
from airmart.session import materialize, scratch_path, scratch_root, scratch_scope


def test_cluster_folder_is_used_when_named(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    root = scratch_root(spark)
    assert root == named.rstrip("/") if named else os.path.isdir(root)
    assert scratch_path(spark, "x").startswith(f"{root}/airmart/x-")


def test_cluster_without_a_shared_folder_is_an_error(spark):
    class Remote:
        conf = type("C", (), {"get": staticmethod(lambda key, default=None: default)})
        sparkContext = type("X", (), {"master": "yarn"})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Remote)


def test_materialize_and_scope(spark):
    with scratch_scope(spark):
        df = materialize(spark.range(5), "scoped")
        folder = os.path.dirname(df.inputFiles()[0].removeprefix("file://"))
        assert df.count() == 5 and os.path.isdir(folder)
    assert not os.path.exists(os.path.dirname(folder)) and session._scope.get() is None


def test_scratch_goes_with_the_driver(tmp_path):
    code = (
        "from airmart.session import build_session, materialize\n"
        f"s = build_session(master='local[1]', **{{'spark.checkpoint.dir': '{tmp_path}',"
        " 'spark.ui.enabled': 'false'})\n"
        "materialize(s.range(3))\n"
        "import os; print(len(os.listdir(os.path.join(s.conf.get('spark.checkpoint.dir'), 'airmart'))))\n"
        "s.stop()\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=180)
    assert done.stdout.split()[-1] == "1", done.stderr
    left = tmp_path / "airmart"
    for _ in range(50):  # the JVM ends a moment after Python
        if not left.exists() or not os.listdir(left):
            break
        time.sleep(0.2)
    assert not left.exists() or not os.listdir(left)

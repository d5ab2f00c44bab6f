"""The command line lists, prints SQL and writes results."""

import subprocess
import sys
import tempfile

import pytest

from tests.conftest import ROOT


def _cli(*args):
    return subprocess.run([sys.executable, "-m", "fathom", *args], cwd=ROOT, capture_output=True, text=True, timeout=600)


def test_list_and_sql():
    out = _cli("list")
    assert out.returncode == 0 and "e46_either_key_left" in out.stdout
    sql = _cli("sql", "e46_either_key_left")
    assert sql.returncode == 0 and "LEFT JOIN classes" in sql.stdout


@pytest.mark.parametrize("fmt", ["parquet"])
def test_run_writes_result(spark, fmt):
    target = tempfile.mkdtemp(prefix="fathom-cli-") + "/out"
    res = _cli("run", "e13_avg_join", "--data", "/root/testdata/sf0.001", "--out", target, "--format", fmt, "--master", "local[2]")
    assert res.returncode == 0, res.stderr[-2000:]
    assert spark.read.parquet(target).columns == ["avg_speed"]

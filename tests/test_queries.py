"""Every registered query against its SQL on the smallest tables."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from sitegauge.catalog.all_queries import ORACLES, QUERIES
from tests.oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_is_checked():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, QUERIES[name], ORACLES[name], SF_DIR) is None


def test_queries_without_the_training_data_folder(tmp_path):
    """The folder with the operators for training data can be deleted, with or without the pipeline's file."""
    here = Path(__file__).resolve().parents[1]
    shutil.copytree(here / "sitegauge", tmp_path / "sitegauge", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(here / "__spark_entry__.py", tmp_path)
    (tmp_path / "corpus_pipeline.py").write_text("import sitegauge.llm.packing\n")
    code = "from __spark_entry__ import oracle_sql, queries; print(len(queries()), len(oracle_sql()))"
    for _ in range(2):
        out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
        assert out.stdout.split() == [str(len(QUERIES)), str(len(ORACLES))], out.stderr
        (tmp_path / "corpus_pipeline.py").unlink(missing_ok=True)


def test_entry(spark):
    assert entry(spark).count() > 0

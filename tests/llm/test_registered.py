"""The queries with SQL against it, and that nothing else needs this subpackage."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from checks.compare import compare, connect
from tillstar.llm import registered

FOLDER = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", registered.ORACLES)
def test_same_rows(spark, name):
    verdict, _ = compare(spark, connect(FOLDER), name, FOLDER)
    assert verdict.startswith("ok"), verdict


def test_all_are_registered():
    assert [n for n in registered.QUERIES if n != "pipeline"] == sorted((n for n in registered.QUERIES if n != "pipeline"), key=lambda n: int(n[2:].split("_")[0]))
    assert {n.split("_")[0] for n in registered.QUERIES} == {"pipeline", *(f"op{k}" for k in range(1, 14))}
    assert registered.QUERIES.keys() <= entry_points.queries().keys()


def test_the_rest_imports_without_it(tmp_path):
    for part in ("__spark_entry__.py", "checks"):
        (tmp_path / part).symlink_to(ROOT / part)
    package = tmp_path / "tillstar"
    package.mkdir()
    for part in (ROOT / "tillstar").iterdir():
        if part.name not in ("llm", "__pycache__"):
            (package / part.name).symlink_to(part)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') or n == 'pipeline' for n in q); assert e.oracle_sql().keys() <= q.keys()"
    # resolve() would lead the links back to the repository
    copy = (ROOT / "__spark_entry__.py").read_text().replace("Path(__file__).resolve()", "Path(__file__).absolute()")
    (tmp_path / "__spark_entry__.py").unlink()
    (tmp_path / "__spark_entry__.py").write_text(copy)
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr

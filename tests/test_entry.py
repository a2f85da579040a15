import os
import shutil
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LISTED = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q); print(len(q), sum(n.startswith('op') or n == 'pipeline' for n in q))"


@pytest.mark.parametrize("removed", [(), ("savora/llm",), ("corpus_pipeline.py",), ("savora/llm", "corpus_pipeline.py")])
def test_entry_without_the_training_data_package(tmp_path, removed):
    """The other queries are registered whatever is missing of the optional package and its pipeline."""
    kept = [n for n in ("__spark_entry__.py", "corpus_pipeline.py", "savora", "catalog") if os.path.exists(f"{REPO}/{n}")]
    for name in kept:
        skipped = shutil.ignore_patterns("__pycache__", *(os.path.basename(r) for r in removed if r.startswith(name)))
        if os.path.isdir(f"{REPO}/{name}"):
            shutil.copytree(f"{REPO}/{name}", tmp_path / name, ignore=skipped)
        elif name not in removed:
            shutil.copy(f"{REPO}/{name}", tmp_path / name)
    done = subprocess.run([sys.executable, "-c", LISTED], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    n, training = map(int, done.stdout.split())
    assert n - training > 150
    if "savora/llm" in removed:
        assert training == 0

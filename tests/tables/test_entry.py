import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import __spark_entry__ as entry
from gridloom.session import local_session
names, sql = set(entry.queries()), set(entry.oracle_sql())
assert sql <= names
assert not any(n == "pipeline" or n.startswith("op") for n in names), names
assert entry.entry(local_session("bare", 2)).count() > 0
print(len(names))
"""


@pytest.mark.parametrize("pipeline_stays", [True, False])
def test_loads_without_the_training_data_folders(tmp_path, pipeline_stays):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm"))
    if not pipeline_stays:
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    env = os.environ | {"PYTHONPATH": str(copy), "PYTHONDONTWRITEBYTECODE": "1"}
    got = subprocess.run([sys.executable, "-c", SCRIPT], cwd=copy, env=env, capture_output=True, text=True, timeout=300)
    assert got.returncode == 0, got.stderr[-2000:]
    assert int(got.stdout.split()[-1]) > 100

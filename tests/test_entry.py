"""The entry module where the corpus folders are gone."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SCRIPT = """
import __spark_entry__ as entry
names = entry.queries()
assert not [n for n in names if n.startswith("op") or n == "pipeline"], names
assert len(names) >= 285 and entry.FLAGSHIP in names and set(entry.oracle_sql()) <= set(names)
"""


@pytest.mark.parametrize("keep", [(), ("corpus_pipeline.py",), ("depotflow/llm/__pycache__", "corpus_pipeline.py")])
def test_core_without_the_corpus_folders(tmp_path, keep):
    left_out = {"llm", ".git", "__pycache__", "corpus_pipeline.py"}
    shutil.copytree(ROOT, tmp_path / "repo", ignore=lambda _, names: left_out & set(names))
    for name in keep:
        target = tmp_path / "repo" / name
        if name.endswith(".py"):
            target.write_text("from depotflow.llm import mixing\n\n\ndef run(spark, folder):\n    return mixing\n")
        else:
            target.mkdir(parents=True)
    ran = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path / "repo", capture_output=True, text=True)
    assert ran.returncode == 0, ran.stderr

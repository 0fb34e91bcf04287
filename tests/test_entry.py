"""The contract without the subpackage for training data, which may be left out."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest
from conftest import ROOT

CODE = "import __spark_entry__ as c; print(len(c.queries()), len(c.LLM_QUERIES), 'medallion_gold' in c.queries())"


@pytest.mark.parametrize("left_out", [["smelter/llm"], ["smelter/llm", "corpus_pipeline.py"], ["smelter/llm/__init__.py", "smelter/llm/queries.py"]])
def test_entry_without_training_data(tmp_path, left_out):
    gone = {os.path.join(ROOT, path) for path in left_out}

    def ignore(folder, names):
        return {n for n in names if os.path.join(folder, n) in gone or n in (".git", "__pycache__", "tests")}

    copy = shutil.copytree(ROOT, tmp_path / "copy", ignore=ignore)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    found = subprocess.run([sys.executable, "-c", CODE], cwd=copy, env=env, capture_output=True, text=True, check=True).stdout.split()
    assert int(found[0]) > 90 and found[1:] == ["0", "True"]

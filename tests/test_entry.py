"""The library stands alone: the folder of the training-data operators may be missing."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PARTS = [os.path.join("dossier", "llm"), os.path.join("tests", "llm"), "corpus_pipeline.py"]


@pytest.mark.parametrize("without", [PARTS, PARTS[:2], PARTS[2:]])
def test_imports_without_training_data_operators(tmp_path, without):
    skip = {os.path.join(ROOT, part) for part in without}
    shutil.copytree(ROOT, tmp_path / "copy", ignore=lambda folder, names: [
        n for n in names if n.startswith(".") or n == "__pycache__" or os.path.join(folder, n) in skip])
    seen = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), sorted(set(e.oracle_sql()) - set(e.queries())), "
         "any(n.startswith('op') or n == 'pipeline' for n in e.queries()))"],
        cwd=tmp_path / "copy", capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert seen.returncode == 0, seen.stderr
    number, missing, others = seen.stdout.split()
    assert int(number) >= 66 and missing == "[]" and others == "False"

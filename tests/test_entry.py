"""The entry without the optional packages."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _names(folder, tmp_path) -> list[str]:
    code = "import __spark_entry__ as e; print(*e.queries()); assert set(e.oracle_sql()) <= set(e.queries())"
    out = subprocess.run([sys.executable, "-c", code], cwd=folder, env={**os.environ, "PYTHONPATH": str(folder)}, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr[-2000:]
    return out.stdout.split()


def _copy(tmp_path, *left_out):
    def skip(folder, names):
        here = os.path.relpath(folder, ROOT)
        return [n for n in names if n in (".git", "__pycache__") or os.path.normpath(os.path.join(here, n)) in left_out]

    shutil.copytree(ROOT, tmp_path / "copy", ignore=skip)
    return tmp_path / "copy"


def test_entry_without_the_training_data_package(tmp_path):
    names = _names(_copy(tmp_path, "offerlens/llm", "tests/llm"), tmp_path)
    assert "final_order" in names and len(names) > 100 and not any(n.startswith("op") and n[2].isdigit() or n == "pipeline" for n in names)


def test_entry_without_package_and_pipeline(tmp_path):
    names = _names(_copy(tmp_path, "offerlens/llm", "tests/llm", "corpus_pipeline.py"), tmp_path)
    assert "final_order" in names and "pipeline" not in names

"""The driver contract with and without the optional parts."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("also", [(), ("corpus_pipeline.py",)])
def test_queries_load_without_the_corpus_folders(tmp_path, also):
    for part in ("quartergrid", "checks", "__spark_entry__.py", "corpus_pipeline.py"):
        if part in also or not (ROOT / part).exists():
            continue
        if (ROOT / part).is_dir():
            shutil.copytree(ROOT / part, tmp_path / part, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(ROOT / part, tmp_path / part)
    show = "import __spark_entry__ as e; print(len(e.queries()), set(e.oracle_sql()) == set(e.queries()))"
    out = subprocess.run([sys.executable, "-c", show], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert out.stdout.split() == ["49", "True"]


def test_without_an_empty_package_left_behind(tmp_path):
    """Deleted folders may leave caches, which look like a package."""
    for part in ("quartergrid", "checks"):
        shutil.copytree(ROOT / part, tmp_path / part, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (tmp_path / "quartergrid/llm/__pycache__").mkdir(parents=True)
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()))"],
                         cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.stdout.strip() == "49", out.stderr

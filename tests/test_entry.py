"""The entry without the training-data subpackage and its pipeline."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_entry_without_llm(tmp_path):
    for name in ("tickloom", "__spark_entry__.py"):
        source = ROOT / name
        shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__")) if source.is_dir() else shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert q and set(o) <= set(q) and not [n for n in q if n.startswith('op') or n == 'pipeline'], q"
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, timeout=120).returncode == 0


def test_nothing_else_imports_llm():
    for path in (ROOT / "tickloom").rglob("*.py"):
        if "llm" not in path.parts:
            assert "tickloom.llm" not in path.read_text(), path

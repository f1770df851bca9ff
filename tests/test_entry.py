import json
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SHOW = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


def registered(folder):
    out = subprocess.run([sys.executable, "-c", SHOW], cwd=folder, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    return json.loads(out.stdout.splitlines()[-1])


def copy(folder, *without):
    left_out = shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", *without)
    shutil.copytree(ROOT, folder, ignore=left_out)
    return folder


def test_every_sql_has_a_query():
    names, sql = registered(ROOT)
    assert set(sql) <= set(names) and len(names) > 80


@pytest.mark.parametrize("without", [("llm", "corpus_pipeline.py"), ("llm",)])
def test_entry_without_the_text_operators(tmp_path, without):
    names, sql = registered(copy(tmp_path / "repo", *without))
    own, own_sql = registered(ROOT)
    ours = {n for n in own if n != "pipeline" and not n.startswith("op")}
    assert set(names) == ours and set(sql) == set(own_sql) & ours and {"training_table", "held_breaches"} <= ours


def test_nothing_else_imports_the_text_operators():
    files = [p for p in ROOT.rglob("*.py") if "llm" not in p.relative_to(ROOT).parts and p.name not in ("corpus_pipeline.py", "__spark_entry__.py", "test_entry.py")]
    assert len(files) > 20 and not [p for p in files if "foresight.llm" in p.read_text() or "corpus_pipeline" in p.read_text()]

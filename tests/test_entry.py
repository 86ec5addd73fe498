"""The entry imports with and without the part that may be taken away, and hides no other error."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), *[q for q in e.queries() if q[:2] == 'op' or q == 'pipeline'])"


def copy_of(folder, *without):
    for name in ("millrace", "__spark_entry__.py", "corpus_pipeline.py"):
        source = os.path.join(ROOT, name)
        if not os.path.exists(source):
            continue
        if os.path.isdir(source):
            shutil.copytree(source, folder / name, ignore=lambda d, names: [n for n in names if n in without or n == "__pycache__"])
        elif name not in without:
            shutil.copy(source, folder / name)


def show(folder):
    env = {**os.environ, "PYTHONPATH": str(folder)}
    return subprocess.run([sys.executable, "-c", SHOW], cwd=folder, env=env, capture_output=True, text=True)


@pytest.mark.parametrize("without", [["llm"], ["llm", "corpus_pipeline.py"]])
def test_imports_without_the_optional_part(tmp_path, without):
    copy_of(tmp_path, *without)
    got = show(tmp_path)
    assert got.returncode == 0, got.stderr
    count, sql, *optional = got.stdout.split()
    assert int(count) > 70 and int(sql) > 60 and optional == []


def test_other_missing_modules_are_reported(tmp_path):
    copy_of(tmp_path, "texts.py")
    if (tmp_path / "millrace" / "llm").exists():
        got = show(tmp_path)
        assert got.returncode != 0 and "millrace.llm.texts" in got.stderr

"""The library without its optional training-data subpackage: it still imports and registers its own queries."""

import os
import shutil
import subprocess
import sys

from conftest import ROOT

CODE = """
import __spark_entry__ as e
names = e.queries()
assert "merge_flags" in names and set(names) == set(e.oracle_sql()), sorted(set(names) ^ set(e.oracle_sql()))
assert not [n for n in names if n.startswith("op") or n == "pipeline"]
print(len(names))
"""


def test_library_imports_without_the_subpackage(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(os.path.join(ROOT, "quillspark"), copy / "quillspark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), copy)
    done = subprocess.run([sys.executable, "-c", CODE], cwd=copy, env={**os.environ, "PYTHONPATH": str(copy)},
                          capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_nothing_else_imports_the_subpackage():
    for folder, _, names in os.walk(os.path.join(ROOT, "quillspark")):
        if os.path.basename(folder) == "llm":
            continue
        for name in names:
            if name.endswith(".py"):
                with open(os.path.join(folder, name)) as f:
                    assert "quillspark.llm" not in f.read(), name

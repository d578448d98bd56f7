"""The driver contract holds with and without the training-data subpackage."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
HIDE = """
import sys
class Hide:
    def find_spec(self, name, path=None, target=None):
        if name in {hidden!r}:
            raise ModuleNotFoundError(name=name)
sys.meta_path.insert(0, Hide())
"""
SAY = "import __spark_entry__ as e; print(len(e.queries()), sum(q.startswith('op') or q == 'pipeline' for q in e.queries()), set(e.oracle_sql()) <= set(e.queries()))"


def _run(code):
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)


def test_queries_without_the_subpackage():
    out = _run(HIDE.format(hidden=["pricewh.llm", "corpus_pipeline"]) + SAY)
    assert out.stdout.split() == ["44", "0", "True"], out.stderr


def test_a_broken_import_inside_the_subpackage_is_not_hidden():
    if not os.path.isdir(os.path.join(ROOT, "pricewh", "llm")):
        return
    out = _run(HIDE.format(hidden=["pricewh.session"]) + SAY)
    assert out.returncode != 0 and "ModuleNotFoundError" in out.stderr

"""The entry imports and lists its queries without the corpus subpackage."""

import os
import subprocess
import sys

from conftest import ROOT

CODE = """
import sys

class Hide:
    def find_spec(self, name, path=None, target=None):
        if name in ("sparkwright.llm", "corpus_pipeline"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

sys.meta_path.insert(0, Hide())
import __spark_entry__ as e
assert e.llm is None and e.corpus_pipeline is None
names = e.queries()
assert len(names) > 60 and not any(n.startswith("op") and n[2].isdigit() for n in names)
assert "pipeline" not in names and set(e.oracle_sql()) <= set(names)
"""


def test_entry_without_the_corpus_subpackage():
    subprocess.run([sys.executable, "-c", CODE], cwd=ROOT, check=True,
                   env={**os.environ, "PYTHONPATH": ROOT})

"""The library does not depend on the corpus operators, and the entry works without them."""

import os
import re
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def sources():
    for folder, _, names in os.walk(os.path.join(ROOT, "partloom")):
        for n in names:
            if n.endswith(".py"):
                yield os.path.join(folder, n)


def test_nothing_else_imports_the_corpus_operators():
    for path in sources():
        if f"{os.sep}llm{os.sep}" not in path:
            with open(path) as f:
                assert not re.search(r"partloom\.llm|corpus_pipeline", f.read()), path


def test_no_local_checkpoints_and_no_rdds():
    for path in sources():
        with open(path) as f:
            text = f.read()
        assert "localCheckpoint" not in text.replace("localCheckpoint is not", ""), path
        assert ".rdd" not in text, path


def test_entry_without_the_corpus_operators():
    code = "import sys; sys.modules['partloom.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert len(q) > 100 and set(o) <= set(q) and not any(k.startswith('op') or k == 'pipeline' for k in q)"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=60)


def test_every_query_has_a_name_of_its_own_and_a_builder():
    from partloom import registry

    assert all(callable(f) for f in registry.queries().values())
    assert set(registry.oracle_sql()) <= set(registry.queries())

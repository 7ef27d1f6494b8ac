import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from bitloom.plans import materialize

ROOT = Path(__file__).resolve().parent.parent


def test_registry_needs_no_session():
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert len(q) >= len(o) > 40 and set(o) <= set(q); print('read')"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=False)
    assert done.stdout.strip() == "read", done.stderr


def test_no_machine_local_checkpoints_on_a_cluster(monkeypatch):
    class Unset:
        @staticmethod
        def isDefined():
            return False

    class Context:
        master = "spark://host:7077"
        _jsc = type("J", (), {"sc": staticmethod(lambda: type("S", (), {"getCheckpointDir": staticmethod(lambda: Unset)}))})

    session = type("Session", (), {"sparkContext": Context, "conf": {}})
    with pytest.raises(RuntimeError):
        materialize.ensure_checkpoint_dir(session)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_sql_has_a_query_each():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_without_llm():
    from bitloom import catalog

    assert not any(k.startswith("p1_") for k in catalog.queries())

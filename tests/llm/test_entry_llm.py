"""The subpackage's queries are registered, with SQL only for known names, and
the rest works without the subpackage."""

import importlib.util
import os
import re
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def entry(name):
    spec = importlib.util.spec_from_file_location(name, os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_one_query_per_operator_and_the_pipeline():
    names = list(entry("entry_a").queries())
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in names


class Missing:
    def find_spec(self, name, path=None, target=None):
        if name.startswith(("partqc.llm", "corpus_pipeline")):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)


def test_rest_works_without_the_subpackage(monkeypatch):
    for name in [m for m in sys.modules if m.startswith(("partqc.llm", "corpus_pipeline"))]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(sys, "meta_path", [Missing(), *sys.meta_path])
    mod = entry("entry_b")
    assert len(mod.queries()) >= 49 and not any(n.startswith("op") or n == "pipeline" for n in mod.queries())


def test_other_import_errors_are_not_hidden(monkeypatch):
    for name in [m for m in sys.modules if m.startswith(("partqc.llm", "corpus_pipeline"))]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "pyarrow", None)
    with pytest.raises(ImportError):
        entry("entry_c")

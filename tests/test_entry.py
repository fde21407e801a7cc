"""The driver's smoke check: entry() on sf0.001 gives the 2x2 confusion
matrix of the hold-out part."""

from __spark_entry__ import entry


def test_entry_confusion_matrix(spark):
    df = entry(spark)
    assert df.columns == ["actual", "predicted", "count"]
    rows = df.collect()
    assert sorted((r["actual"], r["predicted"]) for r in rows) == [(0, 0), (0, 1), (1, 0), (1, 1)]
    # Hold-out part of the balanced table: 20 % of 2 x minority rows, rounded up.
    assert sum(r["count"] for r in rows) > 0


def test_entry_module_loads_by_path():
    import importlib.util
    import os
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("entry_by_path", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    assert set(mod.oracle_sql()) <= set(mod.queries())
    assert len(mod.queries()) - len(mod._LLM_QUERIES) >= 49

"""The entry without the text queries, and without a library that they need."""

import importlib
import sys

import pytest


@pytest.mark.parametrize("absent", ["xxhash", "gustline.llm", "corpus_pipeline"])
def test_core_queries_stay(monkeypatch, absent):
    import __spark_entry__ as entry

    core = set(importlib.import_module("gustline.workload.queries").QUERIES)
    for name in list(sys.modules):
        if name == absent or name.startswith(absent + ".") or name.startswith("gustline.llm") or name == "corpus_pipeline":
            monkeypatch.delitem(sys.modules, name)
    # A module that is None in this table cannot be imported.
    monkeypatch.setitem(sys.modules, absent, None)
    with pytest.warns(UserWarning) if absent == "xxhash" else monkeypatch.context():
        found = set(entry.queries())
        assert core <= found and set(entry.oracle_sql()) <= found
    if absent != "corpus_pipeline":
        assert found == core

"""The optional part may be absent; what it needs may not."""

import importlib
import sys

import pytest


class Missing:
    def __init__(self, name):
        self.name = name

    def find_spec(self, name, path=None, target=None):
        if name == self.name:
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)


def without(monkeypatch, name):
    for m in list(sys.modules):
        if m.split(".")[0] in ("corpus_pipeline", "__spark_entry__") or m.startswith("wardline.llm") or m == name:
            monkeypatch.delitem(sys.modules, m)
    monkeypatch.setattr(sys, "meta_path", [Missing(name), *sys.meta_path])
    return importlib.import_module("__spark_entry__")


@pytest.mark.parametrize("name", ["corpus_pipeline", "wardline.llm", "wardline.llm.queries"])
def test_absent_part(monkeypatch, name):
    assert "pipeline" not in without(monkeypatch, name).queries()

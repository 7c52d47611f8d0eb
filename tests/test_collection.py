"""The test folders can be collected together."""

from collections import Counter
from pathlib import Path


def test_module_names_are_unique():
    names = Counter(p.stem for p in Path(__file__).parent.rglob("*.py"))
    assert [n for n, k in names.items() if k > 1 and n not in ("conftest", "__init__")] == []


def test_nothing_is_imported_from_a_conftest():
    sources = {p.name: p.read_text() for p in Path(__file__).parent.rglob("*.py")}
    word = "conf" + "test"
    assert [n for n, text in sources.items() if f"from {word} import" in text or f"import {word}" in text] == []

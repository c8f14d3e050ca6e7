"""A library that the operators need may not be missing without a word."""

import pytest

from tests.test_entry_guard import without


@pytest.mark.parametrize("name", ["xxhash", "public_tokenizers"])
def test_missing_library_is_told(monkeypatch, name):
    with pytest.raises(ModuleNotFoundError, match=name):
        without(monkeypatch, name)

"""Token ids of whole texts by a public byte-level tokenizer, each distinct word encoded once.

A text is cut at blanks, where the tokenizer starts a new piece anyway, and the pieces' ids are
kept by piece, packed as little-endian numbers, so that the ids of a text are one join of bytes.
Plain words go to the tokenizer's merge model, all other pieces to the whole tokenizer. A text that holds the string
of an added token, such as ``<|endoftext|>``, goes whole to the tokenizer, which gives that token's single id.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
from tokenizers import Tokenizer

#: Pieces kept, in each of two generations.
_LIMIT = 600_000
#: Letters that normalisation leaves alone or lower-cases one by one.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(rf"( ?)([{_LETTERS}]*)([!-&(-/:-@\[-`{{-~]*)")
_SPACES = re.compile(r"\s")


def _shown_bytes() -> list[str]:
    """How byte-level vocabularies write the 256 bytes: printable ones as they are, others from U+0100 on."""
    shown, hidden = [], 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            shown.append(chr(b))
        else:
            shown.append(chr(256 + hidden))
            hidden += 1
    return shown


class Ids(dict):
    """Packed ids by piece. ``lowers``: the tokenizer lower-cases and drops blanks (a word vocabulary)."""

    def __init__(self, path: str, lowers: bool, dtype: str):
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content for t in added]
        # such a token is looked for after lower-casing, so in any case of its letters
        self.folded = [t.content.lower() for t in added if t.normalized and lowers]
        self.model, self.lowers, self.dtype = self.tokenizer.model, lowers, np.dtype(dtype)
        self.code = {2: "H", 4: "I"}[self.dtype.itemsize]
        self.marks: dict[str, bytes] = {}
        self.old: dict[str, bytes | None] = {}
        self.shown = {b: s for b, s in enumerate(_shown_bytes())}

    def _whole(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _merged(self, part: str) -> bytes:
        """One piece of the vocabulary's splitting, as the merge model has it."""
        if part.isascii():
            shown = part.replace(" ", "Ġ")
        else:
            shown = "".join(map(self.shown.__getitem__, part.encode()))
        return array(self.code, [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _marks(self, rest: str) -> bytes:
        value = self.marks.get(rest)
        if value is None:
            if len(self.marks) >= _LIMIT // 10:
                self.marks.clear()
            value = self.marks[rest] = self._merged(rest)
        return value

    def _encoded(self, piece: str) -> bytes:
        m = _PLAIN.fullmatch(piece)
        if not m:
            return self._whole(piece)
        blank, word, rest = m.groups()
        if not word:
            return self._marks(blank + rest)
        if self.lowers:
            low = word.lower()
            if rest or low != word:  # the word alone may be known already
                return self[low] + (self._marks(rest) if rest else b"")
        elif rest and blank:
            return self[word] + self._marks(rest)
        return self._merged(blank + word) + (self._marks(rest) if rest else b"")

    def __missing__(self, piece: str) -> bytes | None:
        if len(self) >= _LIMIT:  # what is still in use comes back from the older generation
            self.old = self.copy()
            self.clear()
        if piece in self.old:
            value = self.old.pop(piece)
        elif piece.isascii() and piece.isalpha():  # most words
            low = piece.lower()
            if not self.lowers:
                value = self._merged(" " + piece)
            else:
                value = self[low] if low != piece else self._merged(low)
        elif piece.isascii() and piece[:-1].isalpha() and piece[-1] in ".,":
            value = self[piece[:-1]] + self._marks(piece[-1])
        else:
            value = self._piece(piece)
        self[piece] = value
        return value

    def _piece(self, piece: str) -> bytes | None:
        if self.lowers:
            return self._encoded(piece) if piece else b""
        # A piece follows a blank, or begins with the line break that it stands for. Where blanks
        # meet blanks the tokenizer looks across pieces: None, and the text is encoded whole.
        if piece[:1] == "\n":
            rest = piece[1:]
            if not rest or _SPACES.search(rest):
                return None
            return self._whole("\n") + self._encoded(rest)
        if not piece or _SPACES.search(piece):
            return None
        return self._encoded(" " + piece)

    def text(self, text: str) -> bytes:
        """Packed ids of a whole text."""
        if any(t in text for t in self.added) or (self.folded and any(t in text.lower() for t in self.folded)):
            return self._whole(text)
        if self.lowers:
            return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))
        pieces = text.replace("\n", " \n").split(" ")
        first = pieces[0]
        if not first or _SPACES.search(first):
            return self._whole(text)
        try:
            return self._encoded(first) + b"".join(map(self.__getitem__, pieces[1:]))
        except TypeError:
            return self._whole(text)


    def forget(self) -> None:
        """Let go of all pieces; a task that ends so leaves nothing to the tasks of other jobs in its worker."""
        self.clear()
        for kept in (self.old, self.marks):
            kept.clear()


_LOADED: dict[tuple, Ids] = {}


def ids_of(path: str, lowers: bool, dtype: str) -> Ids:
    """The worker's own packer for a vocabulary file."""
    key = (path, lowers, dtype)
    if key not in _LOADED:
        _LOADED[key] = Ids(path, lowers, dtype)
    return _LOADED[key]

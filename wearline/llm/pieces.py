"""Tokens of whole texts from a bounded memory of their pieces.

A byte-level pre-tokenizer always begins a new token at a single space or line feed that stands between
two other characters, so the tokens of a text are those of its pieces, cut before each space and line
feed. Three or more white-space characters in a row, or two at the end, are one token that a cut would
divide; a text with such a run, or with a NUL (the cutting mark), is taken whole, as one piece.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


class Growing:
    """An array that grows by doubling."""

    def __init__(self, dtype):
        self.data, self.size = np.zeros(1 << 16, dtype), 0

    def extend(self, values: np.ndarray) -> None:
        need = self.size + len(values)
        if need > len(self.data):
            self.data = np.concatenate([self.data[: self.size], np.zeros(2 * need - self.size, self.data.dtype)])
        self.data[self.size : need] = values
        self.size = need

    def held(self) -> np.ndarray:
        return self.data[: self.size]


class Ragged:
    """Rows of different length in one pool."""

    def __init__(self, dtype):
        self.sizes, self.starts, self.pool = Growing(np.int64), Growing(np.int64), Growing(dtype)

    def extend(self, sizes: np.ndarray, values: np.ndarray) -> None:
        self.starts.extend(self.pool.size + np.cumsum(sizes) - sizes)
        self.sizes.extend(sizes)
        self.pool.extend(values)

    def rows(self, at: np.ndarray) -> np.ndarray:
        """The values of the rows `at`, one after the other."""
        sizes = self.sizes.data[at]
        ends = np.cumsum(sizes)
        return self.pool.data[np.repeat(self.starts.data[at] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]


class _Numbers(dict):
    """Piece -> number; a new piece gets the next number and is noted."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.fresh.append(piece)
        return number


class PieceMemory:
    """Numbers the pieces of texts; `learn` is called with each new one's text, in order of numbers.

    `forget` is called when more than `limit` pieces, or pieces of more than `limit_chars` characters,
    are known; all are then learned anew. `double` also takes texts whole that have two spaces in a row.
    """

    def __init__(self, learn: Callable[[list[str]], None], forget: Callable[[], None], limit: int, double: bool = False, limit_chars: int = 1 << 26):
        self.learn, self.forget, self.limit, self.double, self.limit_chars = learn, forget, limit, double, limit_chars
        self._clear()

    def _clear(self) -> None:
        self.number, self.chars = _Numbers(), 0
        self.ends_blank, self.joins = Growing(bool), Growing(bool)  # joins: blank, or begins with two blanks
        self.forget()

    def _catch_up(self) -> None:
        fresh, self.number.fresh = self.number.fresh, []
        if fresh:
            self.chars += sum(map(len, fresh))
            self.ends_blank.extend(np.array([p[-1:].isspace() for p in fresh]))
            self.joins.extend(np.array([p[:2].isspace() for p in fresh]))
            self.learn(fresh)

    def numbers(self, texts: list[str], whole: Callable[[str], bool] | None = None) -> list[np.ndarray]:
        """Piece numbers of each text; `whole` names further texts to take whole."""
        if len(self.number) > self.limit or self.chars > self.limit_chars:
            self._clear()
        look, found = self.number.__getitem__, []
        for text in texts:
            if "\0" in text or self.double and "  " in text or whole and whole(text):
                pieces = [text]
            else:
                pieces = text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
            found.append(np.fromiter(map(look, pieces), np.int64, len(pieces)))
        self._catch_up()
        for n, at in enumerate(found):
            if len(at) > 1 and (self.ends_blank.data[at[:-1]] & self.joins.data[at[1:]]).any():
                found[n] = np.array([look(texts[n])])
        self._catch_up()
        return found

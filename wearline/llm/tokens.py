"""Token ids of texts, with a bounded memory of the pieces between white space.

The tokenizer never merges across white space, so the ids of a text are those of its pieces in a
row. Most pieces are Latin letters with marks behind them: their ids are those of the lower-case letters
and those of the marks. Arrow tells a batch's pieces apart, lowers them and cuts off the marks, so that
Python sees each distinct unit (letters, marks, or another piece as it stands) once a batch. Units seen
before are looked up; the new ones of a batch are encoded together in one call. The model alone encodes
letters, each word ending in a token with the end-of-word suffix. All others go through the whole
tokenizer and are told apart by their offsets. A text that holds a control character which Python takes
for white space and the tokenizer doesn't, or the start of a special token, is encoded as a whole.

When the memory is full, the units that most batches had stay, at most half of it.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

MEMORY = 400_000
_WHOLE = r"<\||[\x1c-\x1f]"
# Marks that are neither letters, digits nor apostrophes; Latin letters that each have one lower-case letter, without combining marks.
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
_LETTERS = "^[A-Za-zÀ-ÖØ-öø-ÿ]+[" + re.escape(_MARKS) + "]*$"
_PLAIN = re.compile("[a-zß-öø-ÿ]+")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in kept]
    return {b: chr(256 + n) for n, b in enumerate(moved)}


class _Places(dict):
    """Unit -> number; a new unit gets the next number and is noted."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, unit: str) -> int:
        number = self[unit] = len(self)
        self.fresh.append(unit)
        return number


class _Growing:
    """An array that grows by doubling."""

    def __init__(self, dtype):
        self.data, self.size = np.zeros(1 << 16, dtype), 0

    def extend(self, values: np.ndarray) -> None:
        if self.size + len(values) > len(self.data):
            self.data = np.concatenate([self.data[: self.size], np.zeros(self.size + 2 * len(values), self.data.dtype)])
        self.data[self.size : self.size + len(values)] = values
        self.size += len(values)


def gather(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs of the pool, one after the other."""
    ends = np.cumsum(sizes, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(pool)) < 1 << 31 else np.int64
    return pool[np.repeat((starts - ends + sizes).astype(kind), sizes) + np.arange(total, dtype=kind)]


def tails(whole: pa.StringArray, heads: pa.StringArray) -> pa.StringArray:
    """What follows the heads in the strings that begin with them."""
    ends, kept = (np.frombuffer(a.buffers()[1], np.int32)[a.offset : a.offset + len(a) + 1] for a in (whole, heads))
    sizes = np.diff(ends) - np.diff(kept)
    offsets = np.append(0, np.cumsum(sizes))
    at = np.repeat(ends[1:] - offsets[1:], sizes) + np.arange(offsets[-1])
    data = np.frombuffer(whole.buffers()[2] or b"", np.uint8)[at]
    return pa.StringArray.from_buffers(len(whole), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))


def _units(pieces: pa.StringArray, words: bool) -> tuple[pa.StringArray, pa.StringArray]:
    """The pieces as lower-case letters and their marks; any other piece as it stands and an empty string."""
    if not words:
        return pieces, pa.array([""] * len(pieces), pa.string())
    plain = pc.match_substring_regex(pieces, _LETTERS)
    low = pc.if_else(plain, pc.utf8_lower(pieces), pieces)
    heads = pc.if_else(plain, pc.ascii_rtrim(low, _MARKS), pieces)
    return heads, tails(low, heads)


class Ids:
    def __init__(self, path: str, memory: int = MEMORY):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.width = np.dtype(np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32)
        self.memory = memory
        self.letters = _byte_letters()
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.words = Tokenizer(self.tokenizer.model) if suffix else None
        if suffix:
            self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            self.closes = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.closes[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        self._remember([], np.zeros(0, np.int64), np.zeros(0, self.width))

    def _remember(self, units: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        """These units and no others, with their ids one after the other."""
        self.place = _Places()
        self.place.update(zip(units, range(len(units))))
        self.starts, self.sizes, self.pool = _Growing(np.int32), _Growing(np.int32), _Growing(self.width)
        self.hits = _Growing(np.int32)  # batches that had the unit
        self.starts.extend(np.cumsum(sizes) - sizes)
        self.sizes.extend(sizes)
        self.pool.extend(ids)
        self.hits.extend(np.zeros(len(units), np.int32))

    def _forget(self) -> None:
        """Keep the units of most batches, at most half of the memory."""
        hits = self.hits.data[: self.hits.size]
        least = 2
        while np.count_nonzero(hits >= least) > self.memory // 2:
            least += 1
        kept = np.flatnonzero(hits >= least)
        units = [u for u, keep in zip(self.place, hits >= least) if keep]
        self._remember(units, self.sizes.data[kept], self._rows(kept))

    def _rows(self, at: np.ndarray) -> np.ndarray:
        """The ids of the units `at`, one after the other."""
        sizes = self.sizes.data[at]
        return gather(self.pool.data, self.starts.data[at], sizes)

    def _word_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for words of plain letters."""
        text = " ".join(words)
        if not text.isascii():
            text = " ".join(w if w.isascii() else w.encode().decode("latin-1").translate(self.letters) for w in words)
        ids = np.array(self.words.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.width)
        return ids, np.diff(np.flatnonzero(self.closes[ids]), prepend=-1)

    def _other_ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        encoded = self.tokenizer.encode(" ".join(pieces), add_special_tokens=False)
        begins = np.array([o[0] for o in encoded.offsets], np.int64)
        ends = np.cumsum([len(p) + 1 for p in pieces]) - 1
        return np.array(encoded.ids, self.width), np.diff(np.append(0, np.searchsorted(begins, ends, "left")))

    def _learn(self) -> None:
        """Encode the noted units."""
        first = self.sizes.size
        units, self.place.fresh = self.place.fresh, []
        fresh = np.zeros(len(units), np.int32)
        for held in (self.starts, self.sizes, self.hits):
            held.extend(fresh)
        plain = np.fromiter(map(bool, map(_PLAIN.fullmatch, units)), bool, len(units)) if self.words else fresh > 0
        other = ~plain & np.fromiter(map(bool, units), bool, len(units))
        for at, make in ((np.flatnonzero(plain), self._word_ids), (np.flatnonzero(other), self._other_ids)):
            if len(at):
                ids, sizes = make([units[n] for n in at.tolist()])
                self.starts.data[first + at], self.sizes.data[first + at] = self.pool.size + np.cumsum(sizes) - sizes, sizes
                self.pool.extend(ids)

    def encode(self, texts: list[str | None] | pa.Array) -> list[np.ndarray]:
        """The ids of each text, null as empty."""
        if not len(texts):
            return []
        if len(self.place) > self.memory:
            self._forget()
        texts = pc.fill_null(texts.cast(pa.string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        whole = np.flatnonzero(pc.match_substring_regex(texts, _WHOLE).to_numpy(zero_copy_only=False)).tolist()
        apart = {n: np.array(self.tokenizer.encode(texts[n].as_py(), add_special_tokens=False).ids, self.width) for n in whole}
        if apart:
            texts = pc.if_else(pa.array(np.isin(np.arange(len(texts)), whole)), "", texts)
        # Those at a text's ends can be empty.
        split = pc.utf8_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        units = pa.concat_arrays(_units(coded.dictionary, self.words is not None)).dictionary_encode()
        known = np.fromiter(map(self.place.__getitem__, units.dictionary.to_numpy(zero_copy_only=False)), np.int32, len(units.dictionary))
        if self.place.fresh:
            self._learn()
        self.hits.data[known] += 1
        parts = known[units.indices.to_numpy()].reshape(2, -1).T  # of each distinct piece
        pool, sizes = self._rows(parts.ravel()), self.sizes.data[parts].sum(1)
        starts, at = np.cumsum(sizes) - sizes, coded.indices.to_numpy()
        own = sizes[at]
        upto = np.append(0, np.cumsum(own))
        ends = upto[np.cumsum(pc.list_value_length(split).to_numpy())]
        return [apart.get(n, ids) for n, ids in enumerate(np.split(gather(pool, starts[at], own), ends[:-1]))]


@lru_cache(maxsize=2)
def shared_ids(path: str) -> Ids:
    """One per Python worker and vocabulary."""
    return Ids(path)

"""Token ids of a byte-level BPE vocabulary, piece by piece.

A piece is a line feed, a head and trailing ASCII marks, where these are there; a mark after a letter
or digit always begins a new token. Each such unit is encoded once: units of letters with at most one
space before them are single words to the pre-tokenizer, so the model alone encodes many of them in one
call; all others go through the whole tokenizer. Both calls are to the tokenizers library.

`ByteIds` cuts a batch of texts before each space and line feed (see `pieces` for why, and for the texts that
are taken whole). Arrow tells the pieces apart and takes those of letters and marks to units, so that Python
sees each distinct unit, and each distinct piece of another kind, once a batch.
"""

from __future__ import annotations

import os
import re
import string
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

from wearline.llm.pieces import Ragged
from wearline.llm.tokens import gather, tails

MEMORY = 500_000  # units
_SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_WHOLE = rf"[{_SPACE}][ \n]([{_SPACE}]|\z)"


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    moved = (b for b in range(256) if b not in kept)
    return {b: chr(b) for b in kept} | {b: chr(256 + n) for n, b in enumerate(moved)}


class UnitIds:
    """Ids of pieces from those of their units."""

    def __init__(self, path: str, plain_specials: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.letters = byte_letters()
        vocab = self.tokenizer.get_vocab()
        self.lengths = np.zeros(max(vocab.values()) + 1, np.int64)
        self.lengths[list(vocab.values())] = [len(t) for t in vocab]
        self.specials = [] if plain_specials else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        self.unit: dict[str, int] = {}
        self.ids = Ragged(np.int32)

    def special(self, text: str) -> bool:
        """Whether the text holds a special token's string, which the tokenizer takes out before it cuts."""
        for s in self.specials:
            if s in text:
                return True
        return False

    def _units(self, piece: str) -> list[str]:
        if self.special(piece):
            return [piece]
        units = []
        if piece[:1] == "\n" and piece[1:2].isalnum():
            units.append("\n")
            piece = piece[1:]
        head = piece.rstrip(string.punctuation)
        if head and len(head) < len(piece) and head[-1].isalnum():
            return [*units, head, piece[len(head) :]]
        return [*units, piece]

    def _learn_units(self, fresh: list[str]) -> None:
        plain, other = [], []
        for u in fresh:
            (plain if (u[1:] if u[:1] == " " else u).isalpha() else other).append(u)
        if plain:
            blank = self.letters[32]
            words = [u.replace(" ", blank) if u.isascii() else u.encode().decode("latin-1").translate(self.letters) for u in plain]
            line = " ".join(words)
            ids = np.array(self.words.encode_batch_fast([line], add_special_tokens=False)[0].ids, np.int32)
            ends = np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))) + 1
            self._add(plain, np.diff(ends, prepend=0), ids)
        if other:
            found = [e.ids for e in self.tokenizer.encode_batch_fast(other, add_special_tokens=False)]
            self._add(other, np.array([len(i) for i in found]), np.array([i for ids in found for i in ids], np.int32))

    def _add(self, units: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        first = len(self.unit)
        self.unit.update(zip(units, range(first, first + len(units))))
        self.ids.extend(sizes, ids)

    def of(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each piece, and the ids one after the other."""
        units = [self._units(p) for p in pieces]
        flat = [u for us in units for u in us]
        fresh = [u for u in dict.fromkeys(flat) if u not in self.unit]
        if fresh:
            self._learn_units(fresh)
        at = np.fromiter(map(self.unit.__getitem__, flat), np.int64, len(flat))
        per_unit = np.concatenate([[0], np.cumsum(self.ids.sizes.data[at])])
        ends = np.cumsum([len(us) for us in units], dtype=np.int64)
        return np.diff(per_unit[ends], prepend=0), self.ids.rows(at)


class ByteIds:
    """Ids of whole texts; special tokens' strings become special tokens, as the tokenizer has it."""

    def __init__(self, path: str, memory: int = MEMORY):
        self.units = UnitIds(path)
        self.limit = memory
        self.whole = "|".join([_WHOLE, *(re.escape(s) for s in self.units.specials)])

    def _numbers(self, units: list[str]) -> np.ndarray:
        known = list(map(self.units.unit.get, units))
        if None in known:
            self.units._learn_units(list(dict.fromkeys(u for u, n in zip(units, known) if n is None)))
            known = [self.units.unit[u] if n is None else n for u, n in zip(units, known)]
        return np.array(known, np.int64)

    def _piece_ids(self, pieces: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A pool of ids, and where in it each piece's ids start and how many they are."""
        # A piece has no second space or line feed.
        simple = pc.utf8_is_alpha(pc.ascii_rtrim(pc.ascii_ltrim(pieces, " \n"), string.punctuation))
        words, others = pieces.filter(simple), pieces.filter(pc.invert(simple))
        bodies = pc.ascii_ltrim(words, "\n")
        heads = pc.ascii_rtrim(bodies, string.punctuation)
        units = pa.concat_arrays([heads, tails(bodies, heads)]).dictionary_encode()
        numbers = self._numbers(["\n", "", *units.dictionary.to_pylist()]) if len(words) else np.zeros(2, np.int64)
        feed, empty = numbers[:2]
        parts = np.empty((len(words), 3), np.int64)
        parts[:, 0] = np.where(pc.starts_with(words, "\n").to_numpy(zero_copy_only=False), feed, empty)
        parts[:, 1:] = numbers[2:][units.indices.to_numpy()].reshape(2, -1).T
        sizes, at = np.empty(len(pieces), np.int64), simple.to_numpy(zero_copy_only=False)
        sizes[at] = self.units.ids.sizes.data[parts].sum(1) if len(words) else 0
        pool = self.units.ids.rows(parts.ravel())
        own, other = self.units.of(others.to_pylist())
        sizes[~at] = own
        starts = np.empty(len(pieces), np.int64)
        starts[at] = np.cumsum(sizes[at]) - sizes[at]
        starts[~at] = len(pool) + np.cumsum(own) - own
        return np.concatenate([pool, other]), starts, sizes

    def encode(self, texts: list[str | None] | pa.Array) -> list[np.ndarray]:
        """The ids of each text, null as empty."""
        if not len(texts):
            return []
        if len(self.units.unit) > self.limit:
            self.units.forget()
        texts = pc.fill_null(texts.cast(pa.string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        whole = pc.match_substring_regex(texts, self.whole)
        apart = {}
        if at := np.flatnonzero(whole.to_numpy(zero_copy_only=False)).tolist():
            found = self.units.tokenizer.encode_batch_fast(texts.filter(whole).to_pylist(), add_special_tokens=False)
            apart = {n: np.array(e.ids, np.int32) for n, e in zip(at, found)}
            texts = pc.if_else(whole, "", texts)
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        ends, data = ends - ends[0], (texts.buffers()[2] or pa.py_buffer(b""))[ends[0] : ends[-1]]
        shown = np.frombuffer(data, np.uint8)
        opens = (shown == 32) | (shown == 10)
        opens[ends[:-1][ends[:-1] < ends[1:]]] = True
        offsets = np.append(np.flatnonzero(opens), len(shown)).astype(np.int32)
        coded = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), data).dictionary_encode()
        pool, starts, sizes = self._piece_ids(coded.dictionary)
        at = coded.indices.to_numpy()
        own = sizes[at]
        upto = np.append(0, np.cumsum(own))
        cuts = upto[np.searchsorted(offsets[:-1], ends[1:-1])]
        return [apart.get(n, ids) for n, ids in enumerate(np.split(gather(pool, starts[at], own), cuts))]


@lru_cache(maxsize=2)
def shared_ids(path: str) -> ByteIds:
    """One per Python worker and vocabulary."""
    return ByteIds(path)

"""Adaptive context-mixing range coder for blocks of token ids, many blocks at a time.

Each block starts with an empty model and is coded alone. For the next id three orders speak:

* order 2 names the id that last followed the two ids before it, order 1 the one that last followed the
  id before it, each with a confidence of 0 (nothing seen) to 3;
* order 0 gives every id of the block its share of the occurrences so far; the counts are taken anew at
  the steps of `renewals`, so that between them a look-up finds an id by its place;
* an id the block has not shown yet is coded plainly.

The mixing weights are the shares of the coder's range that the four outcomes get. They are adaptive and
kept apart for each combination of the two confidences and of whether both orders name the same id. An
id takes the first outcome that has it. The range coder works with 64 bits and whole 32-bit words.

All blocks of a call advance together, one id per step, as lanes of numpy arrays; a step costs a fixed
number of array operations, so a call should hold some hundred blocks. Blocks may differ in length by
one and have less than 2 ** 21 ids. Encoder and decoder keep the same model; only integers are used.
"""

from __future__ import annotations

import numpy as np

TABLE_BITS = 12
RATE = 5
CONTEXTS = 32
# Ends of the four outcomes' shares, of 65,536: three fields of 16 bits in one integer, the last end is implied.
EVEN = sum((k + 1) * 16_384 << 16 * k for k in range(3))
LEAST = 128  # no share falls below about half of this
FIELD = 0xFFFF
MASKED = sum((FIELD >> RATE) << 16 * k for k in range(3))
MASK = (1 << TABLE_BITS) - 1
ONE = np.uint32(1)
WORD = np.uint64(32)
LOW = np.uint64(0xFFFFFFFF)
FIELD21, ONCE21, TWICE21 = np.uint64((1 << 21) - 1), np.uint64(21), np.uint64(42)
RENEW = np.uint64(1 << 32)
SIXTEEN = np.uint64(16)


def renewals(length: int) -> list[int]:
    """Steps at which the order-0 counts are taken anew: after 128 ids and whenever the block has grown by half."""
    steps, at = [], 128
    while at < length:
        steps.append(at)
        at += at // 2
    return steps


class _Model:
    """Order-1 and order-2 predictions and mixing weights of all lanes.

    A prediction is stored as id * 4 + confidence.
    """

    def __init__(self, lanes: int):
        # Both orders' tables are one array, order 1 of all lanes first, so that one operation serves both.
        self.base = np.arange(2 * lanes, dtype=np.int64) << TABLE_BITS
        self.rows = np.arange(lanes, dtype=np.int64) * CONTEXTS
        self.table = np.zeros(2 * lanes << TABLE_BITS, np.uint32)
        self.ends = np.full(lanes * CONTEXTS, EVEN, np.int64)
        # What an outcome adds to the three ends, which first lose their share of 2 ** -RATE.
        self.pull = np.array(
            [sum((((1 << 16) - (3 - k) * LEAST if o <= k else (k + 1) * LEAST) >> RATE) << 16 * k for k in range(3)) for o in range(4)], np.int64
        )
        self.before = self.before2 = np.zeros(lanes, np.int64)
        self._room(lanes)

    def _room(self, n: int) -> None:
        self.n, self.slots, self.doubled = n, np.empty(2 * n, np.int64), np.empty(2 * n, np.uint32)

    def narrow(self, n: int) -> None:
        """Keep the first n lanes."""
        self.base = np.concatenate([self.base[:n], self.base[self.n : self.n + n]])
        self.rows, self.before, self.before2 = self.rows[:n], self.before[:n], self.before2[:n]
        self._room(n)

    def predict(self) -> None:
        n, slots = self.n, self.slots
        np.right_shift(self.before, 20, out=slots[:n])
        np.right_shift(self.before + self.before2 * 5, 19, out=slots[n:])
        slots &= MASK
        slots += self.base
        self.e = self.table.take(slots)
        p, c = self.e >> 2, self.e & 3
        self.p1, self.p2 = p[:n], p[n:]
        at = (c[n:] << 2) + c[:n]
        at += at
        at += self.p1 == self.p2
        self.at = at + self.rows
        self.end = self.ends.take(self.at)

    def compare(self, ids: np.ndarray) -> np.ndarray:
        """For order 1, then order 2: the confidence of a prediction that is right, else a number above 3."""
        self.doubled[: self.n] = self.doubled[self.n :] = ids << 2
        self.right = self.e ^ self.doubled
        return self.right

    def share(self, outcome: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower end and width of each lane's outcome."""
        shift = outcome << 4
        start = (self.end << 16 >> shift) & FIELD
        return start, ((self.end >> shift) - start) & FIELD

    def update(self, ids: np.ndarray, outcome: np.ndarray) -> None:
        """After `compare` with the same ids."""
        end = self.end - (self.end >> RATE & MASKED)
        end += self.pull.take(outcome)
        self.ends[self.at] = end
        # A right prediction gains confidence up to 3; a wrong one loses some, at confidence 0 or 1 the id replaces it.
        # The entry is id * 4 ^ right, so `right` alone, with the confidence in its two low bits, tells what becomes of it.
        right, less = self.right, self.right - ONE
        new = right >> ONE
        new &= ONE
        new *= less
        np.maximum(new, ONE, out=new)
        new += less < 3
        new += right == 2
        new ^= self.doubled
        self.table[self.slots] = new
        self.before2, self.before = self.before, ids.astype(np.int64) * 0x9E3779B1


def _turned(rows: np.ndarray, kind) -> np.ndarray:
    """The transposed array, copied in strips that fit the cache."""
    out = np.empty(rows.shape[::-1], kind)
    for at in range(0, len(rows), 64):
        out[:, at : at + 64] = rows[at : at + 64].T
    return out


def encode(blocks: list[np.ndarray], id_bits: int) -> list[bytes]:
    """Coded bytes of each block. Lengths fall by at most one, longer blocks first."""
    lanes, length = len(blocks), max(map(len, blocks), default=0)
    if not length:
        return [b"" for _ in blocks]
    short = min(map(len, blocks))
    full = sum(len(b) == length for b in blocks)
    rows = np.zeros((lanes, length), np.uint16 if id_bits <= 16 else np.uint32)
    for lane, b in enumerate(blocks):
        rows[lane, : len(b)] = b
    # Ranks of the ids inside their block: order 0 looks them up by rank.
    order = np.argsort(rows, axis=1, kind="stable")
    ranked = np.take_along_axis(rows, order, axis=1)
    new = np.ones((lanes, length), bool)
    np.not_equal(ranked[:, 1:], ranked[:, :-1], out=new[:, 1:])
    number = np.cumsum(new.ravel(), dtype=np.int32) - 1
    ranks = np.empty((lanes, length), np.int32)
    np.put_along_axis(ranks, order, number.reshape(lanes, length), axis=1)
    opens = number[::length].copy()
    distinct = int(number[-1]) + 1
    ids, ranks = _turned(rows, np.uint32), _turned(ranks, np.int32)
    del rows, order, ranked, new, number
    # Of each rank, the occurrences so far and, 32 bits higher, those of smaller ids of the block.
    counts, shares = np.zeros(distinct, np.int64), np.zeros(distinct, np.uint64)

    model = _Model(lanes)
    low, size = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
    words = np.zeros((lanes, length + 4), np.uint64)
    flat = words.ravel()
    place = np.arange(lanes, dtype=np.int64) * (length + 4)  # in `flat`
    seen, renew, mass = 0, set(renewals(length)), np.uint64(0)
    for step in range(length):
        if step in renew:
            counts += np.bincount(ranks[seen:step].ravel(), minlength=distinct)
            below = np.cumsum(counts) - counts
            below -= np.repeat(below[opens], np.diff(np.append(opens, distinct)))
            shares = (below << 32 | counts).view(np.uint64)
            seen, mass = step, np.uint64(step)
        if step == short and full < lanes:
            _close(words, place, low, full)
            model.narrow(full)
            low, size, place = low[:full], size[:full], place[:full]
        n = len(low)
        x, rank = ids[step, :n], ranks[step, :n]
        model.predict()
        known = shares.take(rank)
        hits = model.compare(x) - 1 < 3  # 0, no confidence, is no hit
        outcome = (known & LOW == 0) + np.int64(2)
        np.copyto(outcome, 1, where=hits[:n])
        np.copyto(outcome, 0, where=hits[n:])
        start, width = model.share(outcome)
        start, width = start.view(np.uint64), width.view(np.uint64)
        unit = size >> SIXTEEN
        add, size = unit * start, unit * width
        two = np.flatnonzero(outcome == 2)
        if len(two):
            part = size.take(two) // mass
            share = known.take(two)
            add[two] += part * (share >> WORD)
            size[two] = part * (share & LOW)
        three = np.flatnonzero(outcome == 3)
        if len(three):
            part = size.take(three) >> np.uint64(id_bits)
            add[three] += part * x.take(three)
            size[three] = part
        moved = low + add
        over = np.flatnonzero(moved < low)
        if len(over):
            flat[place.take(over) - 1] += np.uint64(1)
        low = moved
        small = np.flatnonzero(size < RENEW)
        if len(small):
            moved, at = low.take(small), place.take(small)
            flat[at] = moved >> WORD
            place[small] = at + 1
            low[small] = moved << WORD
            size[small] = size.take(small) << WORD
        model.update(x, outcome)
    del model, ids, ranks, counts, shares
    ends = _close(words, place, low, 0)
    done = [int(e) for e in ends]
    # Lanes that were closed before the last step have their end written beside their words.
    done += [int(words[lane, -1]) for lane in range(len(done), lanes)]
    words[:, -1] = 0
    while True:
        over = words >> WORD
        if not over.any():
            break
        words &= np.uint64(0xFFFFFFFF)
        words[:, :-1] += over[:, 1:]
    plain = words.astype("<u4")
    return [plain[lane, : done[lane]].tobytes() for lane in range(lanes)]


def _close(words: np.ndarray, place: np.ndarray, low: np.ndarray, first: int) -> np.ndarray:
    """Write out `low` of the lanes from `first` on; returns their number of words, also kept in the last column."""
    lanes = np.arange(first, len(low))
    at = place[first:] - lanes * words.shape[1]
    words[lanes, at] = low[first:] >> WORD
    words[lanes, at + 1] = low[first:] & np.uint64(0xFFFFFFFF)
    words[lanes, -1] = at + 2
    return at + 2


def decode(coded: list[bytes], lengths: list[int], id_bits: int) -> list[np.ndarray]:
    """The ids of each block; lengths fall by at most one."""
    lanes, length = len(coded), max(lengths, default=0)
    if not length:
        return [np.zeros(0, np.uint32) for _ in coded]
    short = min(lengths)
    full = sum(n == length for n in lengths)
    starts = np.cumsum([0, *(len(c) // 4 + 2 for c in coded)])
    words = np.zeros(int(starts[-1]), np.uint64)
    for lane, c in enumerate(coded):
        words[starts[lane] : starts[lane] + len(c) // 4] = np.frombuffer(c, "<u4")
    place = starts[:-1].astype(np.int64)
    code = words[place] << WORD | words[place + 1]
    place += 2
    size = np.full(lanes, 2**64 - 1, np.uint64)
    found = np.zeros((length, lanes), np.uint16 if id_bits <= 16 else np.uint32)
    model = _Model(lanes)
    renew, mass = set(renewals(length)), 0
    shares = np.zeros(0, np.uint64)
    id_mask = np.uint64((1 << id_bits) - 1)
    for step in range(length):
        if step in renew:
            shares = _order0(found[:step])
            mass = step
        if step == short and full < lanes:
            model.narrow(full)
            code, size, place = code[:full], size[:full], place[:full]
        n = len(code)
        model.predict()
        unit = size >> SIXTEEN
        at = (code // unit).view(np.int64)
        end = model.end
        outcome = (at >= (end & FIELD)).astype(np.int64)
        outcome += at >= (end >> 16 & FIELD)
        outcome += at >= (end >> 32)
        start, width = model.share(outcome)
        code -= unit * start.view(np.uint64)
        size = unit * width.view(np.uint64)
        x = np.where(outcome == 0, model.p2, model.p1)
        two = np.flatnonzero(outcome == 2)
        if len(two):
            part, rest = size.take(two) // np.uint64(mass), code.take(two)
            spot = np.minimum(rest // part, np.uint64(mass - 1)).astype(np.int64) + two * mass
            share = shares.take(spot)
            x[two] = share & FIELD21
            code[two] = rest - part * (share >> TWICE21)
            size[two] = part * (share >> ONCE21 & FIELD21)
        three = np.flatnonzero(outcome == 3)
        if len(three):
            part, rest = size.take(three) >> np.uint64(id_bits), code.take(three)
            plain = np.minimum(rest // part, id_mask)
            x[three] = plain
            code[three] = rest - part * plain
            size[three] = part
        small = np.flatnonzero(size < RENEW)
        if len(small):
            at = place.take(small)
            code[small] = code.take(small) << WORD | words.take(np.minimum(at, len(words) - 1))
            size[small] = size.take(small) << WORD
            place[small] = at + 1
        found[step, :n] = x
        model.compare(x)
        model.update(x, outcome)
    found = _turned(found, np.uint32)
    return [found[lane, :n] for lane, n in enumerate(lengths)]


def _order0(seen: np.ndarray) -> np.ndarray:
    """For each lane the ids seen, sorted; above each, in steps of 21 bits, the number of equal ids and the first one's place."""
    mass = len(seen)
    lanes = seen.shape[1]
    flat = _turned(seen, seen.dtype)
    flat.sort(axis=1, kind="stable")
    flat = flat.ravel()
    new = np.empty(len(flat), bool)
    new[0] = True
    np.not_equal(flat[1:], flat[:-1], out=new[1:])
    new[::mass] = True
    opens = np.flatnonzero(new)
    number = np.diff(np.append(opens, lanes * mass))
    return np.repeat((opens % mass << 42 | number << 21 | flat[opens]).view(np.uint64), number)

"""Token counts that follow edits without encoding a text anew.

A text is cut into pre-tokens by the tokenizer's pattern, and each pre-token's number of tokens does
not depend on its neighbours. A document keeps a segment tree over its pre-tokens: leaves hold the
lengths and token counts of LEAF or so pre-tokens, inner nodes the sums of both. An edit (start,
remove, insert; code points of the text as edited so far) walks down to its place by the sums of
lengths, cuts only the touched region again and updates the sums on the way up. The region begins
CONTEXT code points before the edit, since the pattern looks ahead by two, at a boundary of
pre-tokens; it ends where the new cut meets an old boundary behind the edit, as the pattern never
looks back.

`build` gives the trees as columns, `apply_edits` takes edits in an array column. Trees are binary
columns, so that they can be written and edited again later.

Defined cases: a null text is an empty text without pre-tokens; a null or empty array of edits
changes nothing; a start beyond the text is its end, a negative one its beginning; removal stops at
the end of the text; a null insertion is empty; repeated rows are counted each. Other columns pass
through; those named like an output column are replaced.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wearline.llm.text import slices

LEAF = 64
CONTEXT = 3
MEMORY = 400_000
TREE = "tree_lengths binary, tree_counts binary"


class Counter:
    """Pre-tokens of a text and their token counts, remembered up to a bound."""

    def __init__(self, ranks_path: str, pattern: str, memory: int = MEMORY):
        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern, self.memory, self.known = regex.compile(pattern), memory, {}

    def pieces(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def count(self, pieces: list[str]) -> list[int]:
        known = self.known
        out = []
        for p in pieces:
            n = known.get(p)
            if n is None:
                if len(known) >= self.memory:
                    known.clear()
                n = len(self.encoding.encode_ordinary(p))
                if len(p) <= 64:
                    known[p] = n
            out.append(n)
        return out


@lru_cache(maxsize=2)
def shared_counter(ranks_path: str, pattern: str) -> Counter:
    """One per Python worker and vocabulary."""
    return Counter(ranks_path, pattern)


class Tree:
    """Segment tree: level 0 has one (length, count) sum per leaf, each level above sums pairs."""

    def __init__(self, lengths: np.ndarray, counts: np.ndarray):
        cuts = range(0, max(len(lengths), 1), LEAF)
        self.leaves = [(lengths[a : a + LEAF], counts[a : a + LEAF]) for a in cuts]
        self._sum_up()

    def _sum_up(self) -> None:
        self.levels = [np.array([(x.sum(), c.sum()) for x, c in self.leaves], np.int64)]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            if len(below) % 2:
                below = np.append(below, [[0, 0]], 0)
            self.levels.append(below[0::2] + below[1::2])

    @property
    def length(self) -> int:
        return int(self.levels[-1][0, 0])

    @property
    def count(self) -> int:
        return int(self.levels[-1][0, 1])

    def find(self, position: int) -> tuple[int, int]:
        """The leaf that holds a position (the last one for the end) and the leaf's start."""
        node, start = 0, 0
        for level in reversed(self.levels[:-1]):
            node *= 2
            left = int(level[node, 0])
            if position >= start + left and node + 1 < len(level):
                node, start = node + 1, start + left
        return node, start

    def replace(self, first: int, last: int, lengths: np.ndarray, counts: np.ndarray) -> None:
        """Put new pre-tokens in the place of the leaves first .. last."""
        self.leaves[first] = (lengths, counts)
        for n in range(first + 1, last + 1):
            self.leaves[n] = (lengths[:0], counts[:0])
        if len(lengths) > 4 * LEAF * (last - first + 1):  # a long insertion: lay out new leaves
            self.__init__(*(np.concatenate(x) for x in zip(*self.leaves)))
            return
        for n in range(first, last + 1):
            self.levels[0][n] = self.leaves[n][0].sum(), self.leaves[n][1].sum()
        for level, above in zip(self.levels, self.levels[1:]):
            first, last = first // 2, last // 2
            for n in range(first, last + 1):
                above[n] = level[2 * n : 2 * n + 2].sum(0)


def edit(tree: Tree, text: str, start: int, remove: int, insert: str, counter: Counter) -> tuple[str, int]:
    """The edited text and the code points that were encoded again; the tree is updated."""
    start = min(max(start, 0), len(text))
    remove = min(max(remove, 0), len(text) - start)
    new = text[:start] + insert + text[start + remove :]
    # Leaves from the one that holds the context on; the cut begins at a boundary inside it.
    first, at = tree.find(max(start - CONTEXT, 0))
    lengths, counts = tree.leaves[first]
    ends = at + np.cumsum(lengths)
    keep = int(np.searchsorted(ends, start - CONTEXT, "right"))
    begin = int(ends[keep - 1]) if keep else at
    head = lengths[:keep], counts[:keep]
    # Cut forward until a new boundary is an old one behind the edit.
    shift = len(insert) - remove
    last, after = first, at + int(lengths.sum())
    old = ends
    fresh, place = [], begin
    tail = (lengths[:0], counts[:0])
    for match in counter.pattern.finditer(new, begin):
        if place >= start + len(insert) and place > begin:
            origin = place - shift
            while origin > after and last + 1 < len(tree.leaves):
                last += 1
                more = tree.leaves[last][0]
                old = after + np.cumsum(more)
                after += int(more.sum())
            n = int(np.searchsorted(old, origin))
            if origin >= start + remove and (n < len(old) and old[n] == origin):
                tail = tree.leaves[last][0][n + 1 :], tree.leaves[last][1][n + 1 :]
                break
        fresh.append(match.group())
        place = match.end()
    else:
        last = len(tree.leaves) - 1
    added = np.array([len(p) for p in fresh], np.int64), np.array(counter.count(fresh), np.int64)
    tree.replace(first, last, *(np.concatenate(x) for x in zip(head, added, tail)))
    return new, place - begin


def _tree_of(lengths: bytes, counts: bytes) -> Tree:
    return Tree(np.frombuffer(lengths, np.uint32).astype(np.int64), np.frombuffer(counts, np.uint32).astype(np.int64))


def build(docs: DataFrame, text: str = "text", ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """`docs` with tokens and its tree's leaves (tree_lengths, tree_counts)."""
    ranks_path, pattern = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN
    docs = docs.drop("tokens", "tree_lengths", "tree_counts")

    def run(batches):
        counter = shared_counter(ranks_path, pattern)
        for batch in slices(batches, 256):
            tokens, lengths, counts = [], [], []
            for value in batch.column(batch.schema.get_field_index(text)).to_pylist():
                pieces = counter.pieces(value or "")
                n = np.array(counter.count(pieces), np.uint32)
                tokens.append(int(n.sum()))
                lengths.append(np.array(list(map(len, pieces)), np.uint32).tobytes())
                counts.append(n.tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(tokens, pa.int64()), pa.array(lengths, pa.binary()), pa.array(counts, pa.binary())],
                [*batch.schema.names, "tokens", "tree_lengths", "tree_counts"],
            )

    schema = StructType(list(docs.schema.fields)).add("tokens", "long").add("tree_lengths", "binary").add("tree_counts", "binary")
    return docs.mapInArrow(run, schema)


def apply_edits(trees: DataFrame, edits: str = "edits", text: str = "text", ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """`trees` after its edits: text, tokens and tree are new; encoded_again counts the code points cut anew."""
    ranks_path, pattern = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN
    trees = trees.drop("encoded_again")
    changed = {text: pa.string(), "tokens": pa.int64(), "tree_lengths": pa.binary(), "tree_counts": pa.binary()}

    def run(batches):
        counter = shared_counter(ranks_path, pattern)
        for batch in slices(batches, 256):
            at = {n: i for i, n in enumerate(batch.schema.names)}
            new = {n: [] for n in (*changed, "encoded_again")}
            rows = zip(*(batch.column(at[n]).to_pylist() for n in (text, "tree_lengths", "tree_counts", edits)))
            for value, lengths, counts, steps in rows:
                tree, again = _tree_of(lengths, counts), 0
                for step in steps or []:
                    value, n = edit(tree, value or "", step["start"] or 0, step["remove"] or 0, step["insert"] or "", counter)
                    again += n
                leaves = [np.concatenate(x).astype(np.uint32).tobytes() for x in zip(*tree.leaves)]
                for name, x in zip(new, (value, tree.count, *leaves, again)):
                    new[name].append(x)
            columns = [pa.array(new[n], changed[n]) if n in changed else c for n, c in zip(batch.schema.names, batch.columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(new["encoded_again"], pa.int64())], [*batch.schema.names, "encoded_again"])

    return trees.mapInArrow(run, StructType(list(trees.schema.fields)).add("encoded_again", "long"))


def derived_edits(text: str = "text", key: str = "doc_id", count: int = 4) -> F.Column:
    """Edits taken from the row itself: some of its own text is put in other places, some removed."""
    place = lambda k: F.pmod(F.xxhash64(F.col(key), F.lit(k)), F.length(text) + 1).cast("long")
    steps = [
        F.struct(
            place(3 * k).alias("start"),
            F.pmod(F.xxhash64(F.col(key), F.lit(3 * k + 1)), F.lit(24)).cast("long").alias("remove"),
            F.substring(F.col(text), place(3 * k + 2).cast("int"), F.lit(17)).alias("insert"),
        )
        for k in range(count)
    ]
    return F.array(*steps)

"""Packing of documents into token windows by lexical retrieval.

Documents are tokenised once into a written table. The corpus-wide document frequencies give the
weights of BM25; the index itself is sharded by content. A document goes where its leading term
goes: of its terms, the rarest that enough documents share (`ranks`), wherever it stands in the input. Terms are gathered into shards of about
SHARD_TOKENS tokens; a term with more tokens is dealt out by the documents' second term, and a pair
of terms with more by a hash of the row (`Routes`). A corpus of up to SHARD_TOKENS tokens is one
shard. Within a shard, each seed document fills a window: whole windows of a long seed come first,
then the index returns the unused documents by falling BM25 score for the seed's terms, and they are
placed one after the other; the one that crosses the end is cut and its rest stays unused. The
tokens left when a shard's documents run out are emitted in windows of power-of-two lengths, so
there is no padding at all. Neither routes nor order depend on files, splits or tasks.

Routing is a weak approximation: a neighbour whose leading terms differ from the seed's can be in another
shard, and then is not found. Over several shards that is the usual case, about as often as with random
dealing. A part that still holds twice a shard's tokens is cut in order of arrival.

BM25's idf ln((N - n + 0.5) / (n + 0.5)) is not positive for a term in half of all documents; such
terms weigh nothing and have no postings.

Defined cases: a null text is empty; an empty document is its end id alone; a shard's documents are
ordered by a hash of their ids, then by key; ties in score go to the earlier document of the shard; repeated rows are documents of their own; an empty table gives no
pieces. Other columns are not used.
"""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.llm.text import mix, portions, slices
from wearline.llm.tokens import shared_ids
from wearline.session import stage

WINDOW = 2048
END = 1
K1, B = 1.2, 0.75
SHARD_TOKENS = 1 << 21
COMPANY = 16  # documents that share a term, for it to count fully as a leading term
TASKS = 20_000


def tokenised(docs: DataFrame, text: str, key: str, vocabulary: str) -> DataFrame:
    """Written table of (__id, ids): little-endian ids with the end id; and rows of (counts): document frequencies.

    counts holds, for each id, the documents that have it, then the number of documents and of tokens.
    """
    rows = docs.select(F.col(key).alias("__id"), F.col(text).alias("__text"))
    kind = docs.schema[key].dataType.simpleString()

    def encode(batches):
        ids = shared_ids(vocabulary)
        size = ids.tokenizer.get_vocab_size()
        counts, met = np.zeros(size + 2, np.int64), np.zeros(size, bool)
        id_type = None
        for batch in portions(batches, "__text"):
            id_type = batch.column("__id").type
            found = [np.append(x, ids.width.type(END)) for x in ids.encode(batch.column("__text"))]
            for x in found:
                met[x] = True
                counts[np.flatnonzero(met)] += 1
                met[x] = False
                counts[size + 1] += len(x)
            counts[size] += len(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("__id"), pa.array([x.tobytes() for x in found], pa.binary()), pa.nulls(len(found), pa.binary())],
                ["__id", "ids", "counts"],
            )
        if id_type is not None:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, id_type), pa.nulls(1, pa.binary()), pa.array([counts.tobytes()], pa.binary())], ["__id", "ids", "counts"])

    return stage(rows.mapInArrow(encode, f"__id {kind}, ids binary, counts binary"), "tokens")


def corpus_counts(table: DataFrame, size: int) -> np.ndarray:
    """Sum of the counts of all tasks: one number per id, documents, tokens."""

    def expand(batches):
        for batch in batches:
            for value in batch.column(0).to_pylist():
                counts = np.frombuffer(value, np.int64)
                used = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["id", "n"])

    summed = table.where("counts is not null").select("counts").mapInArrow(expand, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(size + 2, np.int64)
    for row in summed.collect():  # at most the vocabulary
        counts[row["id"]] = row["n"]
    return counts


def ranks(counts: np.ndarray, size: int) -> np.ndarray:
    """For each term its claim to lead a document: its idf, less where few documents share it, 0 for one document's own."""
    found, total = counts[:size].astype(float), int(counts[size])
    idf = np.log((total - found + 0.5) / (found + 0.5))
    return np.maximum(idf, 0) * np.minimum(np.log(np.maximum(found, 1)) / np.log(COMPANY), 1)


def leading(documents: list[np.ndarray], place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each document's two best (lowest) places of terms; the size of the vocabulary where there is none. No document is empty."""
    size = np.array([len(d) for d in documents])
    starts = np.cumsum(size) - size
    places = place[np.concatenate(documents)]
    first = np.minimum.reduceat(places, starts)
    places[places == np.repeat(first, size)] = len(place) - 1
    return first, np.minimum.reduceat(places, starts)


class Routes:
    """Shard of a document by its leading terms, from the tokens of each first term and of the largest pairs."""

    def __init__(self, tokens: np.ndarray, pairs: dict[tuple[int, int], int], shard_tokens: int):
        # Pairs above a shard have shards of their own and do not count for their first term.
        self.pairs, self.count = {}, 0
        rest = tokens.copy()
        for (a, b), n in sorted(pairs.items()):
            self.pairs[a, b] = (self.count, -(-n // shard_tokens))
            self.count += -(-n // shard_tokens)
            rest[a] -= n
        self.first, self.parts = np.zeros(len(tokens), np.int64), np.ones(len(tokens), np.int64)
        held = shard_tokens
        for a in np.flatnonzero(rest):
            if rest[a] > shard_tokens:
                self.parts[a] = -(-rest[a] // shard_tokens)
                self.first[a] = self.count
                self.count += int(self.parts[a])
                held = shard_tokens
                continue
            if held + rest[a] > shard_tokens:
                held = 0
                self.count += 1
            self.first[a] = self.count - 1
            held += int(rest[a])

    def shard(self, a: int, b: int, row: int) -> int:
        if (a, b) in self.pairs:
            first, parts = self.pairs[a, b]
            return first + row % parts
        return int(self.first[a]) + int(mix(np.array([b + 1], np.uint64))[0]) % int(self.parts[a])


def routed(table: DataFrame, counts: np.ndarray, size: int, kind: str, shard_tokens: int) -> tuple[DataFrame, int]:
    """(shard, __id, ids), dealt out by shard and in a shard's order; and the number of shards."""
    # A term's place among all terms; terms that one document has, or that weigh nothing, have the last.
    rank = ranks(counts, size)
    order = np.argsort(-rank, kind="stable")
    place = np.full(size + 1, size, np.int64)
    place[order] = np.where(rank[order] > 0, np.arange(size), size)
    rows = table.where("ids is not null").select("__id", "ids")
    width = np.dtype(np.uint16 if size <= 1 << 16 else np.uint32)

    def lead(batches):
        for batch in slices(batches, 256):
            documents = [np.frombuffer(x.as_buffer(), width) for x in batch.column(0)]
            if documents:
                yield pa.RecordBatch.from_arrays([*map(pa.array, leading(documents, place)), pa.array([len(d) for d in documents], pa.int64())], ["a", "b", "n"])

    pairs = stage(rows.select("ids").mapInArrow(lead, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n")), "pairs")
    tokens = np.zeros(size + 1, np.int64)
    for row in pairs.groupBy("a").agg(F.sum("n").alias("n")).collect():  # at most the vocabulary
        tokens[row["a"]] = row["n"]
    large = {(r["a"], r["b"]): r["n"] for r in pairs.where(F.col("n") > shard_tokens).collect()}  # at most one for each shard
    routes = Routes(tokens, large, shard_tokens)

    def deal(batches):
        for batch in slices(batches, 256):
            documents = [np.frombuffer(x.as_buffer(), width) for x in batch.column("ids")]
            if not documents:
                continue
            shards = [routes.shard(*x) for x in zip(*(at.tolist() for at in leading(documents, place)), batch.column("row").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int64()), *batch.columns], ["shard", "content", "row", "__id", "ids"])

    hashed = rows.select(F.xxhash64("ids").alias("content"), F.xxhash64("ids", "__id").alias("row"), "__id", "ids")
    dealt = hashed.mapInArrow(deal, f"shard long, content long, row long, __id {kind}, ids binary")
    tasks = max(1, min(routes.count, TASKS))
    dealt = dealt.repartitionById(tasks, (F.col("shard") % tasks).cast("int")).sortWithinPartitions("shard", "content", "__id")
    return dealt.select("shard", "__id", "ids"), routes.count


class Shard:
    """Inverted index of some documents with BM25 weights."""

    def __init__(self, documents: list[np.ndarray], idf: np.ndarray, mean: float):
        terms, weights = [], []
        for ids in documents:
            term, frequency = np.unique(ids, return_counts=True)
            keep = idf[term] > 0
            term, frequency = term[keep].astype(np.int64), frequency[keep]
            terms.append(term)
            weights.append(idf[term] * frequency * (K1 + 1) / (frequency + K1 * (1 - B + B * len(ids) / mean)))
        self.terms = terms
        self.left = len(terms)
        flat = np.concatenate(terms)
        order = np.argsort(flat, kind="stable")
        self.documents = np.repeat(np.arange(len(terms)), [len(t) for t in terms])[order]
        self.weights = np.concatenate(weights)[order]
        self.starts = np.searchsorted(flat[order], np.arange(len(idf) + 1))

    def keep(self, unused: np.ndarray) -> None:
        """Drop the postings of all other documents, when these are few."""
        if len(unused) > 0.8 * self.left:
            return
        self.left = len(unused)
        wanted = np.zeros(len(self.terms), bool)
        wanted[unused] = True
        kept = wanted[self.documents]
        self.starts = np.append(0, np.cumsum(kept))[self.starts]
        self.documents, self.weights = self.documents[kept], self.weights[kept]

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document that is kept for the seed's terms."""
        low, high = self.starts[self.terms[seed]], self.starts[self.terms[seed] + 1]
        size = high - low
        at = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return np.bincount(self.documents[at], self.weights[at], minlength=len(self.terms))


def fill_windows(documents: list[np.ndarray], idf: np.ndarray, mean: float, window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length); every token is in one piece."""
    index = None
    done = np.zeros(len(documents), np.int64)
    size = np.array([len(d) for d in documents])
    sequences = []
    for seed in range(len(documents)):
        while size[seed] - done[seed] >= window:
            sequences.append([(seed, int(done[seed]), window)])
            done[seed] += window
        if done[seed] == size[seed]:
            continue
        pieces = [(seed, int(done[seed]), int(size[seed] - done[seed]))]
        space = window - pieces[0][2]
        done[seed] = size[seed]
        unused = np.flatnonzero(done < size)
        if len(unused):
            index = index or Shard(documents, idf, mean)
            index.keep(unused)
            for neighbour in _falling(unused, index.scores(seed)[unused]):
                take = int(min(space, size[neighbour] - done[neighbour]))
                pieces.append((int(neighbour), int(done[neighbour]), take))
                done[neighbour] += take
                space -= take
                if not space:
                    break
        sequences += [pieces] if not space else _powers(pieces)
    return sequences


def _falling(documents: np.ndarray, scores: np.ndarray, first: int = 64):
    """Documents by falling score, equal ones in their order; as few are sorted as the caller takes."""
    bound = np.inf
    while bound > -np.inf:
        last, bound = bound, np.partition(scores, len(scores) - first)[len(scores) - first] if first < len(scores) else -np.inf
        at = np.flatnonzero((scores >= bound) & (scores < last))
        yield from documents[at[np.argsort(-scores[at], kind="stable")]]
        first *= 8


def _powers(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The same pieces in sequences of power-of-two lengths, longest first."""
    rest = sum(p[2] for p in pieces)
    out, queue = [], list(reversed(pieces))
    while rest:
        space = 1 << (rest.bit_length() - 1)
        rest -= space
        out.append([])
        while space:
            document, start, length = queue.pop()
            take = min(space, length)
            out[-1].append((document, start, take))
            if take < length:
                queue.append((document, start + take, length - take))
            space -= take
    return out


def pack(docs: DataFrame, text: str = "text", key: str = "doc_id", vocabulary: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """(key, start, length, ids, doc_tokens, sequence_id, offset): one row per piece; ids as little-endian unsigned 32-bit."""
    vocabulary = vocabulary or public_tokenizers.path("word_bpe_49k.json")
    ids = shared_ids(vocabulary)
    size, width = ids.tokenizer.get_vocab_size(), ids.width
    table = tokenised(docs, text, key, vocabulary)
    counts = corpus_counts(table, size)
    total, tokens = int(counts[size]), int(counts[size + 1])
    idf = np.log((total - counts[:size] + 0.5) / (counts[:size] + 0.5)).astype(np.float32)
    mean = tokens / max(total, 1)
    kind = docs.schema[key].dataType.simpleString()
    names = [key, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def emit(keys, documents, id_type, first):
        columns = [[] for _ in names]
        for number, pieces in enumerate(fill_windows(documents, idf, mean)):
            offset = 0
            for document, start, length in pieces:
                ids = documents[document][start : start + length].astype("<u4").tobytes()
                for column, value in zip(columns, (keys[document], start, length, ids, len(documents[document]), first + number, offset)):
                    column.append(value)
                offset += length
        types = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names), number + 1

    def fill(batches):
        shard, first, keys, documents, held, id_type = None, 0, [], [], 0, None
        for batch in slices(batches, 256):
            id_type = batch.column("__id").type
            for number, k, value in zip(batch.column("shard").to_pylist(), batch.column("__id").to_pylist(), batch.column("ids")):
                # The second terms of a hot term can deal unevenly; such a shard is taken in parts.
                if documents and (number != shard or held >= 2 * shard_tokens):
                    out, used = emit(keys, documents, id_type, first)
                    yield out
                    first += used
                    keys, documents, held = [], [], 0
                if number != shard:
                    shard, first = number, number << 40
                documents.append(np.frombuffer(value.as_buffer(), width))
                keys.append(k)
                held += len(documents[-1])
        if documents:
            yield emit(keys, documents, id_type, first)[0]

    dealt, _ = routed(table, counts, size, kind, shard_tokens)
    return dealt.mapInArrow(
        fill, f"`{key}` {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )

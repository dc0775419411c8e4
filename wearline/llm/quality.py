"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is a position of the chain and is good (1) or bad (0). Potentials are sums of
weights of binned line features of the line itself and of its two neighbours, plus transition
weights. Lines of a training document carry its label. The document's score is the mean of the
forward-backward marginals of "good", weighted by line length, passed through a fitted logistic
curve, so that 0.7 means a probability.

Training uses a bounded sample: the `sample` labelled documents with the smallest hash of their id,
never one whose crc32(id as text) mod 4 is 2. Only text enters a score.

Defined cases: a null or empty text is one empty line; texts of one line have no neighbours (bin 0);
several labels of a document: the smallest counts, null labels are left out; without any label, or
with labels of one class, every score is that class's share smoothed by one (0.5 without labels);
repeated rows are scored alike. Other columns pass through; those named like an output are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wearline.llm.text import mix

SAMPLE = 12_000
BINS = 8
THRESHOLD = 0.7
OUTPUT = ["held_out", "score", "predicted"]
BATCH_CHARS = 1 << 18

_SYMBOLS = b"*#$%&@^~<>\\/=_+[]{}"
_MARKS = b".,;:?'\"()-"
_POWERS = np.multiply.accumulate(np.append(np.uint64(1), np.full(63, 0x9E3779B97F4A7C15, np.uint64)))
FEATURES = [
    "log_length", "letters", "upper", "digits", "symbols", "exclamations", "bars", "marks", "spaces",
    "word_length", "repeated", "seen", "closed", "log_text", "log_lines",
]


def _member(values: bytes) -> np.ndarray:
    table = np.zeros(256, np.int32)
    table[list(values)] = 1
    return table


_UPPER = _member(bytes(range(65, 91)))
_LETTER = _member(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
_TABLES = [_LETTER, _UPPER, _member(b"0123456789"), _member(_SYMBOLS), _member(b"!"), _member(b"|"), _member(_MARKS), _member(b" \t")]
_CLOSING = _member(b".!?:\"")


def _over(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features per line, line lengths in bytes, lines per text)."""
    texts = [t or "" for t in texts]
    lines = np.array([t.count("\n") + 1 for t in texts])
    b = np.frombuffer("\n".join(texts).encode("utf-8", "surrogatepass"), np.uint8)
    ends = np.append(np.flatnonzero(b == 10), len(b))
    starts = np.append(0, ends[:-1] + 1)
    length = ends - starts
    of_line = lambda per_byte: (c := np.append(0, np.cumsum(per_byte)))[ends] - c[starts]
    letters, upper, *others = (of_line(table[b]) for table in _TABLES)
    doc = np.repeat(np.arange(len(texts)), lines)

    # Words: bytes between white space, hashed by position in the word.
    white = b <= 32
    first = np.flatnonzero(~white & np.append(True, white[:-1])) if len(b) else np.zeros(0, np.int64)
    last = np.flatnonzero(~white & np.append(white[1:], True)) if len(b) else first
    size = last - first + 1
    at = np.arange(size.sum()) - np.repeat(np.append(0, np.cumsum(size)[:-1]), size) if len(size) else np.zeros(0, np.int64)
    sums = np.append(np.uint64(0), np.cumsum((b[~white].astype(np.uint64) + np.uint64(1)) * _POWERS[np.minimum(at, 63)]))
    until = np.cumsum(size)
    word = mix(sums[until] - sums[until - size]) if len(size) else np.zeros(0, np.uint64)
    line_of_word = np.searchsorted(ends, first, "left") if len(first) else first
    doc_of_word = doc[line_of_word]
    same_doc = np.append(False, doc_of_word[1:] == doc_of_word[:-1])[: len(word)]
    repeated = same_doc & np.append(False, word[1:] == word[:-1])[: len(word)]
    key = mix(word + doc_of_word.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    seen = np.ones(len(word), bool)
    seen[np.unique(key, return_index=True)[1]] = False
    per_line = lambda x: np.bincount(line_of_word, x, minlength=len(ends))
    n_words = per_line(None)

    closed = np.where(length > 0, _CLOSING[b[np.maximum(ends - 1, 0)]] if len(b) else 0, 0)
    text_length = np.bincount(doc, length, minlength=len(texts))
    features = np.stack(
        [
            np.log2(1 + length), _over(letters, length), _over(upper, letters), *(_over(x, length) for x in others),
            _over(per_line(size), n_words), _over(per_line(repeated), n_words), _over(per_line(seen), n_words), closed,
            np.log2(1 + text_length)[doc], np.log2(lines)[doc],
        ],
        1,
    )
    return features.astype(np.float32), length, lines


def active(features: np.ndarray, lines: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Indices of the active weights of each line: its own bins and those of its neighbours."""
    n, k = features.shape
    bins = np.stack([np.searchsorted(edges[j], features[:, j], "right") for j in range(k)], 1) + 1
    width = edges.shape[1] + 2
    stop = np.cumsum(lines)
    begin = stop - lines
    before, after = np.zeros_like(bins), np.zeros_like(bins)
    before[1:], after[:-1] = bins[:-1], bins[1:]
    before[begin], after[stop - 1] = 0, 0
    columns = np.arange(k) * width
    return np.concatenate([bins + columns, before + columns + k * width, after + columns + 2 * k * width], 1)


def _padded(lines: np.ndarray):
    """Texts by falling line count, and for each place the rows of the texts that reach it."""
    order = np.argsort(-lines, kind="stable")
    begin = (np.cumsum(lines) - lines)[order]
    reach = np.searchsorted(-lines[order], -np.arange(lines.max() if len(lines) else 0), "left")
    return order, begin, reach


def marginals(unary: np.ndarray, transition: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward in log space: P(good) per line, expected transitions, log Z per text."""
    order, begin, reach = _padded(lines)
    forward, backward = np.empty_like(unary), np.empty_like(unary)
    for t, n in enumerate(reach):
        row = begin[:n] + t
        forward[row] = unary[row]
        if t:
            before = forward[row - 1]
            forward[row] += np.logaddexp(before[:, :1] + transition[0], before[:, 1:] + transition[1])
    pairs = np.zeros((2, 2))
    log_z = np.empty(len(lines))
    log_z[order] = np.logaddexp(*forward[begin + lines[order] - 1].T)
    by_rank = log_z[order]
    for t in range(len(reach) - 1, -1, -1):
        n = reach[t]
        m = reach[t + 1] if t + 1 < len(reach) else 0
        row = begin[:n] + t
        backward[row] = 0.0
        if m:
            nxt = row[:m] + 1
            ahead = unary[nxt] + backward[nxt]
            backward[row[:m]] = np.logaddexp(transition[:, 0] + ahead[:, :1], transition[:, 1] + ahead[:, 1:])
            joint = forward[row[:m]][:, :, None] + transition + ahead[:, None, :] - by_rank[:m, None, None]
            pairs += np.exp(joint).sum(0)
    good = np.exp(np.clip(forward[:, 1] + backward[:, 1] - np.repeat(log_z, lines), -60, 0))
    return good, pairs, log_z


def _scores(good: np.ndarray, length: np.ndarray, lines: np.ndarray) -> np.ndarray:
    doc = np.repeat(np.arange(len(lines)), lines)
    weight = length + 1.0
    return np.bincount(doc, good * weight, minlength=len(lines)) / np.bincount(doc, weight, minlength=len(lines))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-9, 1 - 1e-9)
    return np.log(p / (1 - p))


def fit(features: np.ndarray, length: np.ndarray, lines: np.ndarray, labels: np.ndarray, steps: int = 120, rate: float = 0.05, ridge: float = 2e-4) -> dict:
    """Weights by gradient steps (Adam) on the conditional likelihood of a document's line labels."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    if len(np.unique(labels)) < 2:
        return {"constant": float(share)}
    edges = np.quantile(features, np.arange(1, BINS) / BINS, axis=0).T.copy()
    index = active(features, lines, edges)
    size = 3 * features.shape[1] * (edges.shape[1] + 2)
    # Weights favour "good"; "bad" has potential 0. A document counts once, whatever its length.
    theta, bias, transition = np.zeros(size), np.zeros(1), np.zeros((2, 2))
    parts = [theta, bias, transition]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parts]
    gold = np.repeat(labels, lines).astype(float)
    gold_pairs = np.diag([(lines - 1)[labels == 0].sum(), (lines - 1)[labels == 1].sum()]).astype(float)
    n = len(lines)
    for step in range(1, steps + 1):
        unary = np.zeros((len(gold), 2))
        unary[:, 1] = theta[index].sum(1) + bias
        good, pairs, _ = marginals(unary, transition, lines)
        off = (good - gold) / n
        gradients = [
            np.bincount(index.ravel(), np.repeat(off, index.shape[1]), minlength=size) + ridge * theta,
            np.array([off.sum()]),
            (pairs - gold_pairs) / n + ridge * transition,
        ]
        for p, g, (m, v) in zip(parts, gradients, moments):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    unary = np.zeros((len(gold), 2))
    unary[:, 1] = theta[index].sum(1) + bias
    raw = _logit(_scores(marginals(unary, transition, lines)[0], length, lines))
    slope, shift = 1.0, 0.0
    for _ in range(50):  # Newton steps of the logistic curve over raw scores
        p = 1 / (1 + np.exp(-(slope * raw + shift)))
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - labels) * raw).sum() + 1e-3 * slope, (p - labels).sum()])
        h = np.array([[(w * raw * raw).sum() + 1e-3, (w * raw).sum()], [(w * raw).sum(), w.sum() + 1e-9]])
        slope, shift = np.array([slope, shift]) - np.linalg.solve(h, g)
    return {"edges": edges, "theta": theta, "bias": float(bias[0]), "transition": transition, "slope": slope, "shift": shift}


def score_texts(model: dict, texts: list[str | None]) -> np.ndarray:
    if "constant" in model or not texts:
        return np.full(len(texts), model.get("constant", 0.5))
    features, length, lines = line_features(texts)
    unary = np.zeros((len(length), 2))
    unary[:, 1] = model["theta"][active(features, lines, model["edges"])].sum(1) + model["bias"]
    good, _, _ = marginals(unary, model["transition"], lines)
    return 1 / (1 + np.exp(-np.clip(model["slope"] * _logit(_scores(good, length, lines)) + model["shift"], -50, 50)))


def _by_size(texts: list[str | None]):
    """Runs of texts of about BATCH_CHARS in all."""
    run, chars = [], 0
    for text in texts:
        run.append(text)
        chars += len(text or "")
        if chars >= BATCH_CHARS:
            yield run
            run, chars = [], 0
    if run:
        yield run


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality", sample: int = SAMPLE) -> dict:
    """A model from at most `sample` labelled documents outside the held-out fold."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key)))
    chosen = known.groupBy(F.col(key).alias("__id")).agg(F.min(label).alias("__label")).orderBy(F.xxhash64("__id"), "__id").limit(sample)
    rows = docs.join(F.broadcast(chosen), F.col(key) == F.col("__id")).select("__id", "__label", F.col(text).alias("__text"))

    def extract(batches):
        for batch in batches:
            marks = batch.column("__label").to_pylist()
            at = 0
            for run in _by_size(batch.column("__text").to_pylist()):
                features, length, lines = line_features(run)
                stop = np.cumsum(lines)
                blocks = [features[e - n : e].tobytes() for e, n in zip(stop, lines)]
                sizes = [length[e - n : e].astype(np.int64).tobytes() for e, n in zip(stop, lines)]
                ids = batch.column("__id").slice(at, len(run))
                yield pa.RecordBatch.from_arrays([ids, pa.array(marks[at : at + len(run)], pa.int32()), pa.array(blocks, pa.binary()), pa.array(sizes, pa.binary())], ["__id", "label", "features", "lengths"])
                at += len(run)

    kind = docs.schema[key].dataType.simpleString()
    got = rows.withColumn("__label", F.col("__label").cast("int")).mapInArrow(extract, f"__id {kind}, label int, features binary, lengths binary").toArrow()
    got = got.sort_by("__id")
    if not got.num_rows:
        return {"constant": 0.5}
    features = np.frombuffer(b"".join(got["features"].to_pylist()), np.float32).reshape(-1, len(FEATURES))
    each = [np.frombuffer(x, np.int64) for x in got["lengths"].to_pylist()]
    return fit(features, np.concatenate(each), np.array([len(x) for x in each]), np.array(got["label"].to_pylist()))


def score(docs: DataFrame, model: dict, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with held_out, score and predicted."""
    docs = docs.drop(*OUTPUT)

    def apply(batches):
        for batch in batches:
            values = [score_texts(model, run) for run in _by_size(batch.column(batch.schema.get_field_index(text)).to_pylist())]
            scores = pa.array(np.concatenate(values) if values else np.zeros(0))
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, "score"])

    schema = StructType(list(docs.schema.fields)).add("score", "double")
    return docs.mapInArrow(apply, schema).select(
        *docs.columns, held_out(F.col(key)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )

"""Quality rules: a linear-chain conditional random field labels lines, their share decides.

Each line with a word is content or boilerplate. The field has weights for features of a
line and for pairs of neighbouring labels; Viterbi decoding gives the best sequence. It
is trained on a bounded sample of labelled documents whose lines take the label of their
document at first and, for rejected documents, the field's own labels afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.frames import labelled_sample, map_arrow, map_texts, slices

# The base rules.
SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\v\f\r"
LEAST_WORDS, MOST_REPEATED = 50, 50

#: Labelled documents that are read for training, at most.
SAMPLE_DOCS = 2_000
#: Lines of one training sequence; longer documents give several.
TRAIN_LINES = 128
STEPS = 100

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_CLASSES = 8  # lower case and other letters, upper case, digit, symbol, space, stop, exclamation, other mark
_CLASS = np.full(129, 7, np.uint8)
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[128] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[[ord(c) for c in SYMBOLS]] = 3
_CLASS[[ord(c) for c in _SPACES]] = 4
_CLASS[[ord(c) for c in ".?,;:"]] = 5
_CLASS[ord("!")] = 6
FEATURES = ("one", "words", "width", "upper", "digit", "symbol", "stop", "exclaim", "other", "repeated", "again", "closed")


class Field(NamedTuple):
    """Weights of the features, of label pairs (before, after), and the least content share."""

    weights: np.ndarray
    pairs: np.ndarray
    least: float


class Lines(NamedTuple):
    """The worded lines of some texts: features, words and place of each, and each text's number."""

    features: np.ndarray
    words: np.ndarray
    places: np.ndarray
    counts: np.ndarray


def _repeat_words(words: list[bytes]) -> int:
    """Words inside windows of three that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) >= 1 << 20:  # keep the product within 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(number) + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = np.diff(windows[order]) == 0
    again = np.zeros(n - 2, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= again
    return int(covered.sum())


def measure(texts: list[str]) -> tuple[dict[str, list[int]], Lines]:
    """The base counts of each text, and its worded lines."""
    base: dict[str, list[int]] = {name: [] for name in BASE}
    counts, shape, places, worded = [], [], [], []
    for text in texts:
        lines = text.encode("utf-8", "surrogatepass").split(b"\n")
        seen: set[bytes] = set()
        words: list[bytes] = []
        dups = own = 0
        for place, line in enumerate(lines):
            parts = line.split()
            worded.append(bool(parts))
            if not parts:
                continue
            again = line in seen
            dups += again
            seen.add(line)
            own += 1
            places.append(place)
            shape.append((len(parts), len(set(parts)), again, parts[-1][-1:] in b".!?"))
            words += parts
        counts.append(own)
        base["n_words"].append(len(words))
        base["word_chars"].append(len(text) - sum(map(text.count, _SPACES)))
        base["n_symbols"].append(sum(map(text.count, SYMBOLS)))
        base["n_dup_lines"].append(dups)
        base["n_repeat_words"].append(_repeat_words(words))
    shapes = np.array(shape, np.float32).reshape(-1, 4)
    codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    line_of = np.cumsum(codes == 10) - (codes == 10)
    kinds = _CLASS[np.minimum(codes, 128)]
    table = np.bincount(line_of * _CLASSES + kinds, minlength=len(worded) * _CLASSES)
    table = table[: len(worded) * _CLASSES].reshape(-1, _CLASSES)[np.array(worded, bool)].astype(np.float32)
    inked = np.maximum(table.sum(1) - table[:, 4], 1)
    n_words = np.maximum(shapes[:, 0], 1)
    letters = np.maximum(table[:, 0] + table[:, 1], 1)
    features = np.stack(
        [
            np.ones(len(shapes), np.float32),
            np.log1p(shapes[:, 0]) / 4,
            np.minimum(inked / n_words / 10, 3),
            table[:, 1] / letters,
            table[:, 2] / inked,
            np.minimum(table[:, 3] / n_words, 3),
            table[:, 5] / n_words,
            table[:, 6] / n_words,
            np.minimum(table[:, 7] / n_words, 3),
            1 - shapes[:, 1] / n_words,
            shapes[:, 2],
            shapes[:, 3],
        ],
        1,
    )
    return base, Lines(features, shapes[:, 0], np.array(places, np.int32), np.array(counts, np.int64))


def _by_length(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the sequences, longest first, and how many are longer than each step."""
    starts = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] > 0]
    longest = int(counts.max(initial=0))
    running = len(order) - np.searchsorted(np.sort(counts[order]), np.arange(longest), "right")
    return starts[order], order, running


def viterbi(lines: Lines, field: Field) -> np.ndarray:
    """True for each line on the best path's content side; all texts step together."""
    scores = lines.features @ field.weights.T
    starts, order, running = _by_length(lines.counts)
    back = np.zeros((len(scores), 2), np.int8)
    label = np.zeros(len(scores), np.int8)
    best = scores[starts].copy()
    lengths = lines.counts[order]
    for t in range(1, len(running)):
        n = running[t]
        rows = starts[:n] + t
        ways = best[:n, :, None] + field.pairs[None]
        back[rows] = ways.argmax(1)
        best[:n] = ways.max(1) + scores[rows]
    label[starts + lengths - 1] = best.argmax(1)
    for t in range(len(running) - 1, 0, -1):
        rows = starts[: running[t]] + t
        label[rows - 1] = back[rows, label[rows]]
    return label == 1


def _gradient(lines: Lines, truth: np.ndarray, weights: np.ndarray, pairs: np.ndarray):
    """Of the mean log likelihood, by the forward-backward recursion over all sequences."""
    scores = lines.features @ weights.T
    starts, order, running = _by_length(lines.counts)
    lengths = lines.counts[order]
    ahead, behind = scores.copy(), np.zeros_like(scores)
    for t in range(1, len(running)):
        rows = starts[: running[t]] + t
        ways = ahead[rows - 1][:, :, None] + pairs[None]
        ahead[rows] += np.logaddexp(ways[:, 0], ways[:, 1])
    for t in range(len(running) - 1, 0, -1):
        rows = starts[: running[t]] + t
        ways = pairs[None] + (scores[rows] + behind[rows])[:, None, :]
        behind[rows - 1] = np.logaddexp(ways[:, :, 0], ways[:, :, 1])
    total = np.zeros(len(scores))
    ends = ahead[starts + lengths - 1]
    norm = np.logaddexp(ends[:, 0], ends[:, 1])
    slot = np.repeat(np.arange(len(lines.counts)), lines.counts)
    by_text = np.zeros(len(lines.counts))
    by_text[order] = norm
    total = by_text[slot]
    share = np.exp(ahead + behind - total[:, None])
    real = np.eye(2)[truth]
    grad_weights = (real - share).T @ lines.features
    inside = np.ones(len(scores), bool)
    inside[(np.cumsum(lines.counts) - lines.counts)[lines.counts > 0]] = False
    after = np.flatnonzero(inside)
    joint = np.exp(
        ahead[after - 1][:, :, None] + pairs[None] + (scores[after] + behind[after])[:, None, :] - total[after][:, None, None]
    )
    seen = np.zeros((2, 2))
    np.add.at(seen, (truth[after - 1], truth[after]), 1)
    n = max(len(scores), 1)
    return grad_weights / n, (seen - joint.sum(0)) / n


def fit(lines: Lines, truth: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Weights by Adam steps up the likelihood, slightly shrunk."""
    weights, pairs = np.zeros((2, lines.features.shape[1])), np.zeros((2, 2))
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (weights, pairs)]
    for step in range(1, steps + 1):
        for x, grad, m in zip((weights, pairs), _gradient(lines, truth, weights, pairs), moments, strict=True):
            grad = grad - 1e-4 * x
            m[0] += 0.1 * (grad - m[0])
            m[1] += 0.01 * (grad**2 - m[1])
            x += 0.2 * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-8)
    return weights, pairs


def shares(lines: Lines, content: np.ndarray) -> np.ndarray:
    """Share of each text's words that stand in content lines; 0 for a text without words."""
    slot = np.repeat(np.arange(len(lines.counts)), lines.counts)
    words = np.bincount(slot, lines.words, len(lines.counts))
    kept = np.bincount(slot, lines.words * content, len(lines.counts))
    return np.divide(kept, words, out=np.zeros_like(kept, float), where=words > 0)


def train(texts: list[str], good: list[bool]) -> Field:
    """The field and the least share from labelled documents.

    Without documents of both labels nothing can be told apart: every line is content.
    The least share is the one that loses the fewest labels, good ones counting ten times;
    of equal ones the smallest.
    """
    good_of = np.array(good, bool)
    _, lines = measure(texts)
    if not len(lines.words) or good_of.all() or not good_of.any():
        weights = np.zeros((2, len(FEATURES)))
        weights[1, 0] = 1
        return Field(weights, np.zeros((2, 2)), 0.0)
    line_good = np.repeat(good_of, lines.counts)
    parts = [[TRAIN_LINES] * (n // TRAIN_LINES) + [n % TRAIN_LINES] * bool(n % TRAIN_LINES) for n in lines.counts]
    cut = lines._replace(counts=np.array([p for own in parts for p in own], np.int64))
    truth = line_good.astype(np.int64)
    for _ in range(2):
        weights, pairs = fit(cut, truth)
        field = Field(weights, pairs, 0.0)
        own = viterbi(lines, field._replace(pairs=np.zeros((2, 2))))
        truth = np.where(line_good, 1, own).astype(np.int64)
    weights, pairs = fit(cut, truth)
    share = shares(lines, viterbi(lines, Field(weights, pairs, 0.0)))
    tried = np.round(np.arange(0.05, 0.96, 0.05), 2)
    lost = [10 * np.mean(share[good_of] < t) + np.mean(share[~good_of] >= t) for t in tried]
    return Field(weights, pairs, float(tried[int(np.argmin(lost))]))


def judge(texts: list[str], field: Field) -> dict[str, list]:
    base, lines = measure(texts)
    content = viterbi(lines, field)
    share = shares(lines, content)
    failed = [
        n < LEAST_WORDS or 100 * r > MOST_REPEATED * n
        for n, r in zip(base["n_words"], base["n_repeat_words"], strict=True)
    ]
    ends = np.cumsum(lines.counts)[:-1]
    places = [p[c].tolist() for p, c in zip(np.split(lines.places, ends), np.split(content, ends), strict=True)]
    kept = [not f and bool(s >= field.least) for f, s in zip(failed, share, strict=True)]
    return base | {
        "base_failed": failed,
        "content_lines": places,
        "content_share": share.tolist(),
        "kept": kept,
    }


COLUMNS = (
    ", ".join(f"{name} long" for name in BASE)
    + ", base_failed boolean, content_lines array<int>, content_share double, kept boolean"
)


def judge_quality(df: DataFrame, field: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, the base counts and verdict, the places of content lines among all lines
    (from 0), the share of words in them, and whether the document is kept.

    A null or empty text has no words and fails. Each row is judged alone, so repeated
    rows are judged alike; other columns are not read.
    """

    def make():
        return lambda keys, texts: {key: keys} | judge(texts, field)

    return map_texts(df, key, text, COLUMNS, make)


def keep_good(df: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """The rows of ``df`` that are kept, all columns as they are."""
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            kept = [k for begin, end in slices(texts) for k in judge(texts[begin:end], field)["kept"]]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return map_arrow(df, run, df.schema)


def train_from(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Field:
    """The field from at most ``SAMPLE_DOCS`` of the documents in ``labels`` (quality 0 or 1)."""
    known = labels.where("quality is not null").groupBy(labels[key]).agg({"quality": "min"}).toDF(key, "quality")
    sample = labelled_sample(docs, known, key, SAMPLE_DOCS).select(key, docs[text].cast("string").alias("_text"))
    rows = sample.join(known, key).orderBy(key, "_text").collect()
    return train([r["_text"] or "" for r in rows], [r["quality"] == 1 for r in rows])

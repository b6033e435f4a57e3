"""Secrets by fixed patterns and by two character Markov models.

The models, of random strings and of ordinary identifiers, give each run of token
characters a log-likelihood ratio. They are trained from labelled strings: values that
the patterns find and seeded random ones against the other identifiers of a bounded
sample of labelled documents.
"""

from __future__ import annotations

import random
import re
import string
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import labelled_sample, map_arrow, map_texts, slices

# What the patterns ask for.
KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
LEAST_ASSIGN, LEAST_HEX = 6, 24
_HINTS = ("password", "passwd", "secret", "token", "api_key", "apikey")

#: Characters of what the models judge; anything else ends a run.
TOKEN_CHARS = string.ascii_letters + string.digits + "+/_=-"
#: Shortest run that the models judge.
LEAST_RANDOM = 20
#: Labelled documents that are read for training, at most, and generated strings of each sort.
SAMPLE_DOCS, GENERATED = 4_000, 500
#: Strings of either label that are trained on, at most.
SAMPLE_STRINGS = 20_000

_CODE = np.zeros(129, np.int64)
for _n, _c in enumerate(TOKEN_CHARS, 1):
    _CODE[ord(_c)] = _n
_HEX = np.zeros(129, bool)
_HEX[[ord(c) for c in "0123456789abcdef"]] = True
SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


class Model(NamedTuple):
    """Log-likelihood ratios of letter pairs (row 0: the start), and the least mean."""

    ratio: np.ndarray
    least: float


def _pairs(strings: list[str]) -> np.ndarray:
    """Smoothed log probabilities of each character after each other one."""
    n = len(TOKEN_CHARS) + 1
    counts = np.full((n, n), 0.1)
    for text in strings:
        codes = _CODE[np.frombuffer(text.encode("ascii"), np.uint8)]
        np.add.at(counts, (np.concatenate(([0], codes[:-1])), codes), 1)
    return np.log(counts / counts.sum(1, keepdims=True))


def train(secrets: list[str], ordinary: list[str], seed: int = 7) -> Model:
    """Both models from labelled strings of token characters.

    Random strings are added to the secrets, so a sample without secrets will do; where
    there is nothing ordinary, ordinary strings count as uniform. The least mean ratio lies
    half way between the means of both sides, each judged by its own strings.
    """
    rng = random.Random(seed)
    made = [
        "".join(rng.choices(letters, k=rng.randint(LEAST_RANDOM, 44)))
        for letters in ("0123456789abcdef", string.ascii_uppercase + "234567", TOKEN_CHARS[:62], TOKEN_CHARS[:64])
        for _ in range(GENERATED)
    ]
    secrets = [s for s in secrets if s] + made
    ratio = _pairs(secrets) - _pairs(ordinary)
    mean = [np.mean(scores(ratio, side)) if side else 0.0 for side in (secrets, ordinary)]
    return Model(ratio, float(max(0.3, sum(mean) / 2)))


def scores(ratio: np.ndarray, strings: list[str]) -> list[float]:
    codes = [_CODE[np.frombuffer(s.encode("ascii"), np.uint8)] for s in strings]
    return [float(ratio[np.concatenate(([0], c[:-1])), c].mean()) for c in codes]


def _runs(mask: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of at least ``least`` true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    long = ends - starts >= least
    return starts[long], ends[long]


def find(texts: list[str], model: Model | None) -> list[list[tuple[str, int, int, float | None]]]:
    """Spans of each text by start, then kind; without a model those of the patterns."""
    found: list[list] = [[] for _ in texts]
    # a line feed ends every pattern, so texts can be searched together
    whole = "\n".join(texts)
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    codes = np.minimum(np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32), 128)

    def put(kind: int, start: int, end: int, score: float | None = None) -> None:
        at = int(np.searchsorted(begins, start, "right")) - 1
        found[at].append((start - int(begins[at]), kind, end - int(begins[at]), score))

    for begin, text in zip(begins.tolist(), texts, strict=False):
        low = text.lower()
        if any(hint in low for hint in _HINTS):
            for hit in _ASSIGN.finditer(text):
                if len(hit.group(2)) >= LEAST_ASSIGN:
                    put(0, begin + hit.start(), begin + hit.end())
    for hit in _ACCESS.finditer(whole):
        put(1, *hit.span())
    for start, end in zip(*_runs(_HEX[codes], LEAST_HEX), strict=True):
        put(2, int(start), int(end))
    if model is not None:
        letters = _CODE[codes]
        starts, ends = _runs(letters > 0, LEAST_RANDOM)
        if len(starts):
            before = np.concatenate(([0], letters[:-1]))
            before[starts] = 0
            total = np.concatenate(([0.0], np.cumsum(model.ratio[before, letters])))
            means = (total[ends] - total[starts]) / (ends - starts)
            for start, end, mean in zip(starts.tolist(), ends.tolist(), means.tolist(), strict=True):
                if mean > model.least:
                    put(3, start, end, round(mean, 6))
    result = []
    for spans in found:
        base = sorted(s for s in spans if s[1] < 3)
        extra = [s for s in spans if s[1] == 3 and not any(s[0] < b[2] and b[0] < s[2] for b in base)]
        result.append([(KINDS[k], s, e, x) for s, k, e, x in sorted(base + extra, key=lambda s: s[:2])])
    return result


def find_secrets(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``spans`` (kind, start, end in code points, end exclusive, mean ratio).

    Spans of a kind do not overlap and come by start, then kind; a run that the models
    find is left out where a pattern has it already. A null or empty text has no spans;
    each row is judged alone, so repeated keys give a row each. Other columns are not read.
    """

    def make():
        def work(keys: list, texts: list[str]) -> dict[str, list]:
            names = ("kind", "start", "end", "score")
            return {key: keys, "spans": [[dict(zip(names, s)) for s in own] for own in find(texts, model)]}

        return work

    return map_texts(df, key, text, f"spans {SPANS}", make)


def mask_secrets(
    df: DataFrame, model: Model, text: str = "text", length: str | None = "n_chars", mask: str = "[secret]"
) -> DataFrame:
    """``df`` with every span of ``text`` replaced by ``mask`` and ``length`` brought up to date.

    Rows, columns and their order stay; rows without a span are handed on as they are,
    null texts too.
    """
    schema = df.schema
    at = df.columns.index(text)
    size_at = df.columns.index(length) if length in df.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            sizes = batch.column(size_at).to_pylist() if size_at is not None else []
            changed = False
            for begin, end in slices([t or "" for t in texts]):
                part = [t or "" for t in texts[begin:end]]
                for i, spans in enumerate(find(part, model), begin):
                    if spans:
                        texts[i] = masked(texts[i], spans, mask)
                        changed = True
                        if sizes:
                            sizes[i] = len(texts[i])
            if changed:
                batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
                if sizes:
                    kind = batch.schema.field(size_at)
                    batch = batch.set_column(size_at, kind, pa.array(sizes, kind.type))
            yield batch

    return map_arrow(df, run, schema)


def masked(text: str, spans: list[tuple], mask: str) -> str:
    """Overlapping and touching spans share one mask."""
    parts, done, last = [], 0, -1
    for _, start, end, _ in sorted(spans, key=lambda s: s[1]):
        if start > last:
            parts += [text[done:start], mask]
        done = last = max(last, end)
    return "".join(parts) + text[done:]


def train_from(docs: DataFrame, labelled: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """Models from at most ``SAMPLE_DOCS`` of the documents named in ``labelled``.

    The sample takes the smallest hashes of the key, so it does not depend on row order.
    No label or no document leaves the seeded random strings against uniform ones.
    """
    rows = labelled_sample(docs, labelled, key, SAMPLE_DOCS).select(key, docs[text].cast("string"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for begin, end in slices(texts):
                yes, no = labelled_strings(texts[begin:end])
                yield pa.RecordBatch.from_pydict(
                    {"value": yes + no, "secret": [True] * len(yes) + [False] * len(no)},
                    schema=pa.schema([("value", pa.string()), ("secret", pa.bool_())]),
                )

    picked = map_arrow(rows, pick, "value string, secret boolean")
    # of each side the strings with the smallest hashes, a bounded number
    order = Window.partitionBy("secret").orderBy(F.xxhash64("value"), "value")
    few = picked.distinct().withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= SAMPLE_STRINGS)
    sides: dict[bool, list[str]] = {True: [], False: []}
    for row in few.orderBy("secret", "_n").collect():
        sides[row.secret].append(row.value)
    return train(sides[True], sides[False])


def labelled_strings(texts: list[str]) -> tuple[list[str], list[str]]:
    """Token runs inside what the patterns find, and all others of 4 characters or more."""
    yes, no = [], []
    run = re.compile(r"[A-Za-z0-9+/_=-]{4,}")
    for text, spans in zip(texts, find(texts, None), strict=True):
        at = 0
        for _, start, end, _ in spans:
            no += run.findall(text[at:start]) if start > at else []
            values = run.findall(text[max(at, start) : end])
            yes += [v for v in values if len(v) >= 16]
            at = max(at, end)
        no += run.findall(text[at:])
    return yes, no

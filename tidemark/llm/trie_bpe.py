"""BPE encoding and decoding over a trie of distinct words.

The encoding of a prefix is fixed by its last token and the state one token further
back, so each trie node holds one token. Words are visited in sorted order, which is a
depth-first walk of their trie: the states of a prefix shared with the previous word
stay on the stack and are not computed again.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from functools import lru_cache
from itertools import islice

import regex
from pyspark.sql import DataFrame

from tidemark.llm.frames import map_texts

#: Chunks between white space whose encodings a Python worker keeps from slice to slice.
KEPT_CHUNKS = 400_000
#: Entries of each memo of the walk; a full one starts afresh.
MEMO = 400_000
#: White space to Python that tokenizer files take for symbols.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_SPACE = regex.compile(r"\s+")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, others from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """What a tokenizer file says: a BPE model with word ends over byte letters."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        if model["type"] != "BPE" or not model.get("end_of_word_suffix"):
            raise ValueError("not a BPE file with word ends")
        self.end = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        size = max(vocab.values()) + 1
        self.names = {i: t for t, i in vocab.items()}
        self.made = [-1] * size  # rank of the merge that makes a token
        self.first, self.second = list(range(size)), list(range(size))
        self.rank: dict[int, int] = {}
        for n, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            i, j = vocab[a], vocab[b]
            self.rank[i << 32 | j] = n
            whole = vocab[a + b]
            self.made[whole], self.first[whole], self.second[whole] = n, i, j
        whole_words = {t for t in vocab if t.endswith(self.end) and t != self.end}
        self.inner = {t: i for t, i in vocab.items() if t not in whole_words}
        self.final = {t[: -len(self.end)]: vocab[t] for t in whole_words}
        self.openings = {t[:n] for t in (*self.inner, *self.final) for n in range(len(t) + 1)}
        self.steps: dict[tuple[str, str], tuple] = {}
        self.seams: dict[int, bool] = {}
        self.letters = _byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))))
        steps = spec["pre_tokenizer"]["pretokenizers"]
        self.word = regex.compile(next(s for s in steps if s["type"] == "Split")["pattern"]["Regex"])

    def fits(self, a: int, b: int) -> bool:
        """Whether ``a`` and ``b`` stay apart when their joined letters are encoded.

        Undoes merges from the last one back. A merge across the seam would win if it
        ranks before the merge that was just undone; between equal ranks the left one is
        applied first.
        """
        made, rank = self.made, self.rank
        limit = 1 << 60
        while True:
            across = rank.get(a << 32 | b)
            if across is not None and across < limit:
                return False
            if made[a] > made[b]:
                limit, a = made[a], self.second[a]
            elif made[b] >= 0:
                limit, b = made[b] + 1, self.first[b]
            else:
                return True

    def step(self, state: str, letter: str) -> tuple:
        """The longest end of ``state`` + ``letter`` that opens a token, and the (length,
        token) that end there, longest first: inside a word, and at its end."""
        ends = state + letter
        while ends not in self.openings:
            ends = ends[1:]
        every = [ends[i:] for i in range(len(ends))]
        made = (
            ends,
            [(len(t), self.inner[t]) for t in every if t in self.inner],
            [(len(t), self.final[t]) for t in every if t in self.final],
        )
        if len(self.steps) >= MEMO:
            self.steps.clear()
        self.steps[state, letter] = made
        return made

    def encode(self, words: list[str]) -> list[list[int]]:
        """Token ids of each word, in the order given; ``words`` are distinct."""
        letters = self.letters
        spelled = [w if w.isascii() and w.isprintable() else "".join([letters[b] for b in w.encode()]) for w in words]
        order = sorted(range(len(words)), key=spelled.__getitem__)
        found: list[list[int]] = [[]] * len(words)
        steps, seams, step, fits = self.steps, self.seams, self.step, self.fits
        # on the path to the current node: its last token, how long that is, and what may open
        tokens, lengths, states = [-1], [0], [""]
        before = ""
        for at in order:
            word = spelled[at]
            n = len(word)
            same, most = 0, min(n, len(tokens)) - 1
            while same < most and word[same] == before[same]:
                same += 1
            del tokens[same + 1 :], lengths[same + 1 :], states[same + 1 :]
            state = states[same]
            for i in range(same + 1, n + 1):
                letter = word[i - 1]
                state, inner, final = steps.get((state, letter)) or step(state, letter)
                for size, token in inner if i < n else final:
                    if size == i:
                        break
                    seam = tokens[i - size] << 32 | token
                    fit = seams.get(seam)
                    if fit is None:
                        if len(seams) >= MEMO:
                            seams.clear()
                        fit = seams[seam] = fits(tokens[i - size], token)
                    if fit:
                        break
                else:
                    raise ValueError(f"no token ends at {i} of {word!r}")
                if i < n:
                    tokens.append(token)
                    lengths.append(size)
                    states.append(state)
            ids, i = [token], n - size
            while i:
                ids.append(tokens[i])
                i -= lengths[i]
            found[at] = ids[::-1]
            before = word
        return found

    def chunks(self, text: str) -> list:
        """What stands between white space in ``text``, lower-cased; a special token is an id."""
        if not self.special or not self.split.search(text):
            return self._plain(text)
        found, begin = [], 0
        for hit in self.split.finditer(text):
            found += self._plain(text[begin : hit.start()])
            found.append(self.special[hit.group()])
            begin = hit.end()
        return found + self._plain(text[begin:])

    def _plain(self, text: str) -> list[str]:
        if text.isascii():
            return text.lower().split() if not _SEPARATORS.search(text) else _SPACE.split(text.lower())
        # letter by letter, as the file's normaliser does: no final form of sigma
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return text.split() if not _SEPARATORS.search(text) else _SPACE.split(text)


class Coder:
    """Encodes texts slice by slice and keeps the encodings of a bounded number of chunks."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        # special tokens by their id, other chunks by their letters
        self.special = {i: t for t, i in vocab.special.items()}
        self.ids: dict[str | int, bytes] = {i: array("I", [i]).tobytes() for i in self.special}
        self.shown: dict[str | int, str] = dict(self.special)

    def learn(self, chunks: set[str]) -> None:
        new = [c for c in chunks if c not in self.ids]
        if len(self.ids) + len(new) > KEPT_CHUNKS:
            # keep what this slice needs, and of the rest the earliest, most common ones
            kept = {*self.special, *(c for c in chunks if c in self.ids), *islice(self.ids, KEPT_CHUNKS // 4)}
            self.ids = {c: self.ids[c] for c in self.ids if c in kept}
            self.shown = {c: self.shown[c] for c in self.ids}
        parts = [self.vocab.word.findall(c) for c in new]
        words = list({w for p in parts for w in p})
        names = self.vocab.names
        known = dict(zip(words, self.vocab.encode(words), strict=True))
        for chunk, part in zip(new, parts, strict=True):
            ids = [i for w in part for i in known[w]]
            self.ids[chunk] = array("I", ids).tobytes()
            self.shown[chunk] = " ".join([names[i] for i in ids])

    def code(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        split = [self.vocab.chunks(t) for t in texts]
        self.learn(set().union(*split))
        ids, shown = self.ids, self.shown
        return (
            [b"".join([ids[c] for c in part]) for part in split],
            [" ".join([shown[c] for c in part if ids[c]]) for part in split],
        )


@lru_cache(maxsize=1)
def coder(text: str) -> Coder:
    """Outlives a task where Python workers are used again, until they turn to another operator."""
    return Coder(Vocabulary(text))


def encode_decode(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_tokens``, ``ids`` and ``decoded`` of every row.

    ``tokenizer`` is the content of a tokenizer file (its size bounds what is broadcast).
    ``ids`` holds little-endian unsigned 32-bit integers; ``decoded`` joins the names of
    the tokens by blanks, as a tokenizer without a decoder does. Special tokens in a text
    are found before it is normalised. A null or empty text has no tokens. Repeated keys
    give a row each; other columns are not read.
    """
    shared = df.sparkSession.sparkContext.broadcast(tokenizer)

    def make():
        own = coder(shared.value)

        def work(keys: list, texts: list[str]) -> dict[str, list]:
            ids, shown = own.code(texts)
            return {key: keys, "n_tokens": [len(x) // 4 for x in ids], "ids": ids, "decoded": shown}

        return work

    return map_texts(df, key, text, "n_tokens long, ids binary, decoded string", make, cached=coder)

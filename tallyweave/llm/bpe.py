"""BPE encoding by backtracking over longest token matches, and decoding by an offset table.

An Aho-Corasick automaton over the reversed tokens reads a word once from its end: its state after a place is the
longest piece of a token that starts there, failure links lead to shorter ones, and each state knows the longest token
among them. That gives the longest token at every place of the word in linear time. A token may follow another only if
merging by rank would leave that border alone; whether it would is decided by unfolding both tokens' merges, and
remembered in a pair-compatibility table. Where no token fits, the last one is given up for its next shorter prefix;
positions found to lead nowhere are never tried again, so a word takes time linear in its length. Each distinct word is
encoded once per worker, up to a bounded number of words kept.

Null text counts as empty and has no tokens. Very long texts are encoded whole. Repeated rows give repeated results; an
empty table gives an empty one. Columns besides those named stay out of the result; a kept column with the name of a
wanted one gives way to it. Ties do not occur: there is one encoding. The only texts encoded otherwise than by the tokenizers library are
those with letters that came after Unicode 15.1, which libraries of different age class or lower differently.
"""

from __future__ import annotations

import functools
import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tallyweave.llm.textkernel import with_text

#: Words and pairs kept per worker, some 40 MB each; beyond it the tables start afresh.
KEPT_WORDS = 200_000
_END = "</w>"


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies use for each byte: printable Latin-1 stands for itself, the rest follow 255."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b if b in kept else next(spare)) for b in range(256)]


class Vocabulary:
    """Tokens, merges and their tables, as a tokenizer file describes them."""

    def __init__(self, spec: dict):
        model = spec["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("end_of_word_suffix") != _END:
            raise ValueError("a BPE model with word ends is needed")
        self.names = dict(model["vocab"])
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = 1 + max([*self.names.values(), *self.specials.values()])
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        #: Rank of each token: base symbols first, then merges in order.
        self.rank = {i: -1 for i in self.names.values()}
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for rank, (left, right) in enumerate(pairs):
            a, b, c = self.names[left], self.names[right], self.names[left + right]
            self.joined.setdefault((a, b), c)
            self.halves.setdefault(c, (a, b))
            if self.rank[c] < 0:
                self.rank[c] = rank
        self.letters = byte_letters()
        texts = {i: self._units(name) for name, i in self.names.items()}
        self.length = {i: len(u) for i, u in texts.items()}
        # only tokens that some text is merged to take part
        spelled = {tuple(units): i for i, units in texts.items() if self._by_rank(units) == [i]}
        self._build_automaton(spelled)
        self.shorter = {i: next((spelled[p] for k in range(len(u) - 1, 0, -1) if (p := tuple(u[:k])) in spelled), -1) for i, u in texts.items()}
        self._fits: dict[int, bool] = {}
        blobs = [b""] * self.size
        for name, i in [*self.names.items(), *self.specials.items()]:
            blobs[i] = name.encode() + b" "
        #: Decoding: the bytes of all tokens with a space after each, and where each starts.
        self.bytes = np.frombuffer(b"".join(blobs), dtype=np.uint8)
        self.offsets = np.zeros(self.size + 1, dtype=np.int64)
        np.cumsum([len(b) for b in blobs], out=self.offsets[1:])

    @staticmethod
    def _units(name: str) -> list[str]:
        """Base symbols: letters, the last with its word end if it has one."""
        if name.endswith(_END) and len(name) > len(_END):
            body = name[: -len(_END)]
            return [*body[:-1], body[-1] + _END]
        return list(name)

    def _by_rank(self, units: list[str]) -> list[int]:
        """Merging by rank, pair after pair: what the other encoder must equal."""
        ids = [self.names[u] for u in units]
        while len(ids) > 1:
            best = min(((self.rank[self.joined[p]], k) for k, p in enumerate(zip(ids, ids[1:])) if p in self.joined), default=None)
            if best is None:
                break
            k = best[1]
            ids[k : k + 2] = [self.joined[ids[k], ids[k + 1]]]
        return ids

    def _build_automaton(self, spelled: dict[tuple[str, ...], int]) -> None:
        """Transitions from (state, unit number), failure links and each state's longest token, of the reversed tokens."""
        self.unit = {u: k for k, u in enumerate(sorted({u for units in spelled for u in units}))}
        wide = self.wide = len(self.unit)
        self.goto: dict[int, int] = {}
        self.found: list[int] = [-1]
        depths: list[list[tuple[int, int, int]]] = []
        for units, token in spelled.items():
            state = 0
            for depth, u in enumerate(reversed(units)):
                step = state * wide + self.unit[u]
                to = self.goto.get(step)
                if to is None:
                    to = self.goto[step] = len(self.found)
                    self.found.append(-1)
                    if depth == len(depths):
                        depths.append([])
                    depths[depth].append((state, self.unit[u], to))
                state = to
            self.found[state] = token
        self.fail = [0] * len(self.found)
        for level in depths:  # shallow states first: a failure link leads to a shallower one
            for state, u, to in level:
                if state:
                    back = self.fail[state]
                    while back and back * wide + u not in self.goto:
                        back = self.fail[back]
                    self.fail[to] = self.goto.get(back * wide + u, 0)
                if self.found[to] < 0:
                    self.found[to] = self.found[self.fail[to]]

    def longest(self, letters: list[str]) -> list[int]:
        """The longest token that starts at each place, -1 for none; one pass from the end."""
        goto, fail, wide, unit = self.goto, self.fail, self.wide, self.unit
        out, state = [-1] * len(letters), 0
        for at in range(len(letters) - 1, -1, -1):
            u = unit.get(letters[at], -1)
            if u < 0:
                state = 0
                continue
            to = goto.get(state * wide + u)
            while to is None and state:
                state = fail[state]
                to = goto.get(state * wide + u)
            state = to or 0
            out[at] = self.found[state]
        return out

    def fits(self, left: int, right: int) -> bool:
        """Whether merging by rank keeps the border between these neighbours."""
        pair = left * self.size + right
        known = self._fits.get(pair)
        if known is None:
            if len(self._fits) > KEPT_WORDS:
                self._fits.clear()
            known = self._fits[pair] = self._keeps_border(left, right)
        return known

    def _keeps_border(self, left: int, right: int) -> bool:
        rank, limit = self.rank, 1 << 60
        while True:
            over = self.joined.get((left, right))
            if over is not None and rank[over] < limit:
                return False
            # undo the later of the two last merges: until it happened, its inner half stood at the border
            if rank[left] > rank[right]:
                limit = rank[left]
                left = self.halves[left][1]
            elif right in self.halves:
                limit = rank[right] + 1  # equal ranks merge from the left, so the border pair would come first
                right = self.halves[right][0]
            else:
                return True

    def encode_word(self, word: str) -> list[int]:
        """Token ids of one pre-token."""
        letters = [self.letters[b] for b in word.encode("utf-8", "surrogatepass")]
        letters[-1] += _END
        n = len(letters)
        alive = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        longest = self.longest(letters)
        at, token = 0, longest[0]
        while at < n:
            while token >= 0:
                end = at + self.length[token]
                if alive[end] and (not out or self.fits(out[-1], token)):
                    out.append(token)
                    at, token = end, longest[end] if end < n else -1
                    break
                token = self.shorter[token]
            else:
                alive[at] = 0
                if not out:
                    raise ValueError(f"no encoding of {word!r}")
                last = out.pop()
                at -= self.length[last]
                token = self.shorter[last]
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the tokens' own texts with a space between two, as a tokenizer without a decoder gives."""
        if not len(ids):
            return b""
        begins, lengths = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        ends = np.cumsum(lengths)
        where = np.repeat(begins - (ends - lengths), lengths)
        where += np.arange(ends[-1])
        return self.bytes[where].tobytes()[:-1]


class Encoder:
    """Whole texts to ids: special tokens, normalising, splitting into pre-tokens, then words."""

    def __init__(self, spec: dict):
        self.vocabulary = Vocabulary(spec)
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self._words = regex.compile(split).findall
        self._special = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.vocabulary.specials, key=len, reverse=True)) + ")")
        self._known = _Known(self.vocabulary)

    @staticmethod
    def normalised(text: str) -> str:
        """NFC and lower case letter by letter (no special case for a final sigma); white space parts words either way."""
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def packed(self, text: str) -> bytes:
        """Ids as little-endian int32."""
        if "<|" not in text:
            return b"".join(map(self._known.__getitem__, self._words(self.normalised(text))))
        out = []
        for part in self._special.split(text):
            special = self.vocabulary.specials.get(part)
            if special is not None:
                out.append(np.int32(special).tobytes())
            elif part:
                out += map(self._known.__getitem__, self._words(self.normalised(part)))
        return b"".join(out)

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.packed(text or ""), dtype="<i4")

    def decode(self, ids: np.ndarray) -> bytes:
        return self.vocabulary.decode(ids)


class _Known(dict):
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> bytes:
        if len(self) > KEPT_WORDS:
            self.clear()
        ids = np.array(self.vocabulary.encode_word(word), dtype="<i4").tobytes()
        if len(word) <= 64:
            self[word] = ids
        return ids


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file that every machine has under the same path; made once per worker."""
    with open(path, encoding="utf-8") as file:
        return Encoder(json.load(file))


@functools.lru_cache(maxsize=2)
def _id_strings(path: str) -> np.ndarray:
    """Offset table for ids as decimal text with a space after each."""
    blobs = [str(i).encode() + b" " for i in range(encoder(path).vocabulary.size)]
    offsets = np.zeros(len(blobs) + 1, dtype=np.int64)
    np.cumsum([len(b) for b in blobs], out=offsets[1:])
    return np.frombuffer(b"".join(blobs), dtype=np.uint8), offsets


def decimal_text(ids: np.ndarray, path: str) -> bytes:
    """The ids in decimal, joined by single spaces."""
    if not len(ids):
        return b""
    blob, offsets = _id_strings(path)
    lengths = offsets[ids + 1] - offsets[ids]
    ends = np.cumsum(lengths)
    where = np.repeat(offsets[ids] - (ends - lengths), lengths)
    where += np.arange(ends[-1])
    return blob[where].tobytes()[:-1]


def encode(docs: DataFrame, path: str, keep: list[str], text: str = "text", want: tuple[str, ...] = ("n_tokens", "ids")) -> DataFrame:
    """Columns `keep` and what is wanted of: n_tokens long, ids array<int>, ids_sha256, decoded_sha256, decoded string.

    One pass over the text without a shuffle. Names in `want` replace kept columns of the same name.
    """
    kinds = {"n_tokens": ("long", pa.int64()), "ids": ("array<int>", pa.list_(pa.int32())), "ids_sha256": ("string", pa.string()), "decoded_sha256": ("string", pa.string()), "decoded": ("string", pa.string())}
    source, schema = with_text(docs, keep, text, {w: kinds[w][0] for w in want})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                out: dict[str, list] = {w: [] for w in want}
                for scalar in batch.column(batch.num_columns - 1):
                    ids = enc.encode(scalar.as_py())
                    for w in want:
                        if w == "n_tokens":
                            out[w].append(len(ids))
                        elif w == "ids":
                            out[w].append(ids)
                        elif w == "ids_sha256":
                            out[w].append(hashlib.sha256(decimal_text(ids, path)).hexdigest())
                        elif w == "decoded_sha256":
                            out[w].append(hashlib.sha256(enc.decode(ids)).hexdigest())
                        else:
                            out[w].append(enc.decode(ids).decode())
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(pa.array(out[w], type=kinds[w][1]) for w in want)], names=[*batch.schema.names[:-1], *want])

    return source.mapInArrow(run, schema)

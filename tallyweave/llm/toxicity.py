"""Toxicity of a text from a lexicon that also catches misspelled terms, weighed by context.

Lexicon: words and word beginnings (PREFIX_LEAST to PREFIX_MOST letters, written `abc*`) that occur far more often in
labelled toxic texts than in clean ones; a beginning must be that of several words. The words of a beginning's family stand beside it. The lexicon is kept as a trie. A Levenshtein automaton of each
text word is intersected with the trie: the automaton's state is, for each number of edits within the bound, the set of
places in the word reached with so many, and a branch is left as soon as all sets are empty. Longer words may differ by
more edits; look-alike characters (@ for a, 0 for o) are read as letters first. A beginning is found misspelled too: the
automaton may then stop before the word's end.

Which terms are looked for misspelled is learned: of the clean texts' words, if no terms themselves, those within a term's
edits are its neighbours. A term with more than NEIGHBOURS of them cannot be told from other words when misspelled, and one
that clean texts use themselves (PLAIN_SHARE) is weak evidence already; such terms are found as they stand only. The
neighbours of all others are exempt forms.

Score: every hit counts its term's log-odds, less for each edit. Its context window then says how much of that holds:
hits inside quotation marks, or near a reporting or defining word, count as quotation; other hits in the window add to
each other. A logistic curve over the summed abuse and quotation, fitted to the labels, gives the score.

Lexicon and curve are learned from at most FIT_ROWS labelled rows, those with the least hash of their id: a bounded
number of ids can be sent to the texts, which then need no shuffle. Scoring reads whole texts. Terms, neighbours and
exempt forms have no bound but that sample.

Null or empty text scores as a text without hits; so does a text of one long word that no term is near. Null labels are
left out. Without labels of both classes the lexicon is empty and every text scores alike: near 1 if all labels are 1, near
0 otherwise. Repeated rows give repeated scores. Of equally near terms the
heaviest counts, then the last by code points. An empty table gives an empty result. A kept column named score gives way.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.textkernel import Tokens, chunked, with_text
from tallyweave.session import cut

#: Bound of the labelled rows to learn from.
FIT_ROWS = 20_000
PREFIX_LEAST, PREFIX_MOST, WORD_LEAST = 3, 10, 3
#: A term needs this many occurrences in toxic texts, this many for each toxic text (near copies of a few toxic texts make
#: evidence of all their words otherwise), and this many times the rate of clean ones. A text counts for at most TEXT_MOST.
LEAST_TOXIC, LEAST_RATE, LEAST_RATIO, TEXT_MOST = 8, 0.02, 9.0, 5
#: A beginning needs this many words in toxic texts, none with more than this share of its occurrences.
PREFIX_WORDS, PREFIX_TOP = 4, 0.6
#: Neighbours in clean texts, and share of clean texts with the term itself, beyond which it is not looked for misspelled.
NEIGHBOURS, PLAIN_SHARE = 8, 1e-4
WINDOW = 6
#: Of a quoted hit's weight this much stays abuse.
QUOTED_SHARE = 0.15
#: Weight kept for each edit.
EDIT_KEEPS = 0.8
KEPT_WORDS = 400_000

# Look-alike characters and the letters they stand for.
LOOKALIKES = {"@": "a", "4": "a", "3": "e", "1": "i", "!": "i", "0": "o", "$": "s", "5": "s", "7": "t"}
# Words that report or define what others said, in the four languages of the tables.
REPORTING = (
    "said says saying called calls quote quoted quotes quoting word words term terms slur insult insults meaning means defined definition reported "
    "dit appelle mot mots terme insulte cite citation signifie "
    "sagte sagt nannte nennt wort begriff zitat zitiert beleidigung bedeutet "
    "dijo dice llama palabra palabras insulto cita citado significa"
).split()
# Quotation marks; a straight one opens and closes.
OPENING, CLOSING, STRAIGHT = "“„«‘", "”“»’", '"'


def edits_allowed(length: int) -> int:
    """How far a word of this length may be from a term."""
    return 0 if length < 5 else 1 if length < 9 else 2


@functools.lru_cache(maxsize=KEPT_WORDS)
def normal_form(token: str) -> str:
    """The letters of a token: lower case, outer punctuation off, look-alikes read as letters, other marks dropped."""
    low = unicodedata.normalize("NFC", token.lower())
    begin, end = 0, len(low)
    while begin < end and not low[begin].isalnum() and low[begin] not in "@$":
        begin += 1
    while end > begin and not low[end - 1].isalnum():
        end -= 1
    core = low[begin:end]
    if core.isalpha():
        return core
    if not any(ch.isalpha() for ch in core):
        return ""
    return "".join(ch if ch.isalpha() else LOOKALIKES.get(ch, "") for ch in core)


class Trie:
    """Lexicon terms; a term that ends in * stands for all words that begin with it. `exact` terms match without edits."""

    def __init__(self, terms: dict[str, float], exact: frozenset[str] = frozenset()):
        self.weights, self.exact = terms, exact
        self._parts: dict = {}
        self.children: list[dict[str, int]] = [{}]
        self.whole: list[str | None] = [None]
        self.prefix: list[str | None] = [None]
        #: Whether a term that may be misspelled lies at a node or below: other branches are none of the automaton's.
        self.fuzzy = [False]
        for term in sorted(terms):
            node, stem = 0, term.removesuffix("*")
            # a word may be longer than the term by its edits, and longer words may differ more
            loose = term not in exact and (edits_allowed(len(stem)) if term.endswith("*") else edits_allowed(len(stem) + 2)) > 0
            self.fuzzy[0] |= loose
            for ch in stem:
                if ch not in self.children[node]:
                    self.children[node][ch] = len(self.children)
                    self.children.append({})
                    self.whole.append(None)
                    self.prefix.append(None)
                    self.fuzzy.append(False)
                node = self.children[node][ch]
                self.fuzzy[node] |= loose
            (self.prefix if term.endswith("*") else self.whole)[node] = term

    def _may_be_near(self, word: str) -> bool:
        """Whether the word has, unchanged, one of the parts of a term, of which edits can change all but one: a look at
        the letters that spares most words the automaton and leaves none out that it would find."""
        # beyond the longest term only beginnings can match: all longer words are alike
        n = min(len(word), self._longest())
        if n not in self._parts:
            parts = set()
            for term in self.weights:
                stem, start = term.removesuffix("*"), term.endswith("*")
                m, edits = len(stem), edits_allowed(n)
                if start:
                    edits = min(edits, edits_allowed(m))
                if term not in self.exact and edits and (n >= m - edits if start else abs(m - n) <= edits):
                    cuts = [m * k // (edits + 1) for k in range(edits + 2)]
                    parts |= {stem[i:j] for i, j in zip(cuts, cuts[1:])}
            self._parts[n] = re.compile("|".join(map(re.escape, sorted(parts)))).search if parts else None
        look = self._parts[n]
        return look is not None and look(word) is not None

    def _longest(self) -> int:
        if -1 not in self._parts:
            self._parts[-1] = 3 + max([len(t) for t in self.weights], default=0)
        return self._parts[-1]

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_parts": {}}

    def nearest(self, word: str) -> tuple[str, int] | None:
        """The term with the fewest edits from the word, of those the heaviest, or None within the bound. A beginning is as
        far away as it is from the nearest beginning of the word; its own length bounds its edits too."""
        best: tuple | None = None
        node = 0
        for ch in word:
            node = self.children[node].get(ch, -1)
            if node < 0:
                break
            if self.prefix[node] is not None:
                best = max(best or (-99, -1.0, ""), (0, self.weights[self.prefix[node]], self.prefix[node]))
        if node >= 0 and self.whole[node] is not None:
            best = max(best or (-99, -1.0, ""), (0, self.weights[self.whole[node]], self.whole[node]))
        if best or not self._may_be_near(word):
            return (best[2], 0) if best else None
        for found in self.near(word):
            best = max(best or (-99, -1.0, ""), found)
        return (best[2], -best[0]) if best else None

    def near(self, word: str) -> Iterator[tuple[int, float, str]]:
        """(-edits, weight, term) of all terms within the word's edits, by the automaton."""
        # no term is longer than the word and its edits, so the rest of a very long word cannot matter
        n = min(len(word), self._longest())
        bound = edits_allowed(len(word))
        places: dict[str, int] = {}
        for i, ch in enumerate(word[:n]):
            places[ch] = places.get(ch, 0) | 1 << i
        # the automaton's state: for each number of edits the set of places in the word, as bits, reached with so many
        stack = [(0, [(2 << e) - 1 for e in range(bound + 1)])]
        done, full = (1 << n if n == len(word) else 0), (2 << n) - 1
        while stack:
            node, reached = stack.pop()
            term = self.whole[node]
            if term is not None and term not in self.exact:
                edits = next((e for e in range(bound + 1) if reached[e] & done), None)
                if edits is not None:
                    yield -edits, self.weights[term], term
            term = self.prefix[node]
            if term is not None and term not in self.exact:
                edits = next((e for e in range(min(bound, edits_allowed(len(term) - 1)) + 1) if reached[e]), None)
                if edits is not None:
                    yield -edits, self.weights[term], term
            for ch, to in self.children[node].items():
                if not self.fuzzy[to]:
                    continue
                same = places.get(ch, 0)
                new = [(reached[0] & same) << 1]
                for e in range(1, bound + 1):
                    # the same letter, another one, one more in the term, one more in the word
                    new.append(((reached[e] & same) << 1 | reached[e - 1] << 1 | reached[e - 1] | new[e - 1] << 1) & full)
                if new[bound]:
                    stack.append((to, new))


class Model:
    """Lexicon, exempt forms and the logistic curve."""

    def __init__(self, terms: dict[str, float], exempt: set[str], curve: tuple[float, float, float], exact: frozenset[str] = frozenset()):
        self.trie, self.exempt, self.curve = Trie(terms, exact), exempt, curve
        self._known: dict[int, tuple[float, bool]] = {}

    def __getstate__(self) -> dict:
        return {"trie": self.trie, "exempt": self.exempt, "curve": self.curve, "_known": {}}

    def weigh(self, token: str) -> tuple[float, bool]:
        """(weight of the term near the token or 0, whether it is a reporting word)."""
        word = normal_form(token)
        if not word:
            return 0.0, False
        found = self.trie.nearest(word)
        if found and found[1] and word in self.exempt:
            found = None
        return (self.trie.weights[found[0]] * EDIT_KEEPS ** found[1] if found else 0.0), word in _REPORTING

    def sums(self, texts: list[str]) -> list[tuple[float, float]]:
        """(abuse, quotation) of each text of a chunk."""
        tokens = Tokens(texts)
        if not len(tokens.hashes):
            return [(0.0, 0.0)] * len(texts)
        found, first, where = np.unique(tokens.hashes, return_index=True, return_inverse=True)
        if len(self._known) + len(found) > KEPT_WORDS:
            self._known.clear()
        weights, reports = np.zeros(len(found)), np.zeros(len(found), dtype=bool)
        for k, h in enumerate(found.tolist()):
            known = self._known.get(h)
            if known is None:
                known = self._known[h] = self.weigh(tokens.token(int(first[k])))
            weights[k], reports[k] = known
        weights, reports = weights[where], reports[where]
        out = []
        hits = np.flatnonzero(weights)
        for i in range(len(texts)):
            a, b = tokens.firsts[i], tokens.firsts[i + 1]
            own = hits[np.searchsorted(hits, a) : np.searchsorted(hits, b)]
            out.append(self._in_context(texts[i], tokens, weights, reports, own, a, b) if len(own) else (0.0, 0.0))
        return out

    def _in_context(self, text: str, tokens: Tokens, weights: np.ndarray, reports: np.ndarray, own: np.ndarray, a: int, b: int) -> tuple[float, float]:
        quoted = _quoted_spans(text)
        begin = tokens.starts[np.searchsorted(tokens.starts, tokens.begins[a], side="right") - 1]
        abuse = quotation = 0.0
        for k in own:
            low, high = max(a, k - WINDOW), min(b, k + WINDOW + 1)
            near = weights[low:high].sum() - weights[k]
            at = tokens.begins[k] - begin
            end = tokens.ends[k] - begin
            inside = any(s < end and at < e for s, e in quoted)
            w = weights[k] + 0.5 * near
            if inside or reports[low:high].any():
                quotation += w * (1 - QUOTED_SHARE)
                abuse += w * QUOTED_SHARE
            else:
                abuse += w
        return abuse, quotation

    def curve_score(self, sums: tuple[float, float]) -> float:
        shift, on_abuse, on_quotation = self.curve
        x = shift + on_abuse * math.log1p(sums[0]) + on_quotation * math.log1p(sums[1])
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


_REPORTING = frozenset(REPORTING)


def _quoted_spans(text: str) -> list[tuple[int, int]]:
    """Spans between quotation marks on one line."""
    out, opened, mark = [], -1, ""
    for at, ch in enumerate(text):
        if ch == "\n":
            opened = -1
        elif opened >= 0 and (ch == STRAIGHT == mark or mark != STRAIGHT and ch in CLOSING):
            out.append((opened, at + 1))
            opened = -1
        elif opened < 0 and (ch == STRAIGHT or ch in OPENING):
            opened, mark = at, ch
    return out


def _words(text: str) -> Counter:
    found: Counter = Counter()
    for token, n in Counter((text or "").split()).items():
        word = normal_form(token)
        if len(word) >= WORD_LEAST:
            found[word] += n
    return Counter({w: min(n, TEXT_MOST) for w, n in found.items()})


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "toxic", text: str = "text", fit_rows: int = FIT_ROWS) -> Model:
    """Lexicon and curve from the labelled rows."""
    marked = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("__key"), F.col(label).cast("int").alias("__label"))
    chosen = cut(marked.orderBy(F.xxhash64("__key"), "__key", "__label").limit(fit_rows))
    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")).join(F.broadcast(chosen), "__key").select("__key", "__label", "__text")
    sizes = {r["__label"]: r["n"] for r in chosen.groupBy("__label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Model({}, set(), (4.0 if toxic else -30.0, 0.0, 0.0))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for y, t in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                seen[y].update(_words(t))
            if len(seen[0]) + len(seen[1]) > KEPT_WORDS:
                yield from _counted(seen)
                seen = (Counter(), Counter())
        yield from _counted(seen)

    words = rows.mapInArrow(count, "word string, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    words = cut(words)
    each = words.select(F.explode(_starts()).alias("start"), "toxic", "clean")
    starts = each.groupBy("start").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.count_if(F.col("toxic") > 0).alias("words"), F.max("toxic").alias("top"))
    starts = starts.where((F.col("words") >= PREFIX_WORDS) & (F.col("top") <= PREFIX_TOP * F.col("toxic"))).select(F.concat("start", F.lit("*")).alias("term"), "toxic", "clean")
    ratio = (F.col("toxic") / F.lit(toxic)) / ((F.col("clean") + 0.5) / F.lit(clean))
    terms = words.select(F.col("word").alias("term"), "toxic", "clean").union(starts).where(F.col("toxic") >= max(LEAST_TOXIC, LEAST_RATE * toxic)).withColumn("ratio", ratio).where(F.col("ratio") >= LEAST_RATIO)
    # the rate bounds their number: a text of n words has part in n * TEXT_MOST / LEAST_RATE of all terms at most
    picked = _pick([(r["term"], r["toxic"], r["ratio"]) for r in terms.orderBy("term").collect()])
    picked = _with_families(picked, words.where((F.col("toxic") > 0) & (ratio >= LEAST_RATIO)))
    used = words.select(F.col("word").alias("term"), "clean").union(each.groupBy(F.concat("start", F.lit("*")).alias("term")).agg(F.sum("clean").alias("clean")))
    asked = docs.sparkSession.createDataFrame([(t,) for t in sorted(picked)], "term string")
    plain_terms = frozenset(r["term"] for r in used.where(F.col("clean") > PLAIN_SHARE * clean).join(F.broadcast(asked), "term", "left_semi").collect())
    shared_trie = docs.sparkSession.sparkContext.broadcast(Trie(picked, plain_terms))

    # words that clean texts use near a term: words of their own, no misspellings
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = shared_trie.value
        for batch in batches:
            found = [(term, word) for word in batch.column(0).to_pylist() if trie._may_be_near(word) for edits, _, term in trie.near(word) if edits]
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in found], pa.string()), pa.array([w for _, w in found], pa.string())], names=["term", "word"])

    plain = words.where((F.col("clean") > 0) & (ratio < LEAST_RATIO)).select("word")
    neighbours = cut(plain.mapInArrow(near, "term string, word string").distinct())
    crowded = frozenset(r["term"] for r in neighbours.groupBy("term").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > NEIGHBOURS).collect())
    # words of a beginning that is itself found misspelled need no look of their own
    loose = {t[:-1] for t in picked if t.endswith("*") and t not in crowded and t not in plain_terms and edits_allowed(len(t) - 1)}
    covered = frozenset(t for t in picked if not t.endswith("*") and any(t[:k] in loose for k in range(PREFIX_LEAST, len(t) + 1)))
    # few words for each term that is left
    exempt = {r["word"] for r in neighbours.where(~F.col("term").isin(*crowded) if crowded else F.lit(True)).select("word").distinct().collect()}
    model = Model(picked, exempt, (0.0, 0.0, 0.0), crowded | plain_terms | covered)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, found in chunked(batch.column(2).to_pylist()):
                part = batch.slice(at, len(found))
                sums = shared.value.sums(found)
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array([x for x, _ in sums], pa.float64()), pa.array([x for _, x in sums], pa.float64())], names=["label", "abuse", "quotation"])

    # equal points come as one with their number: a row for each kind of sum, however often ids repeat
    points = rows.mapInArrow(summed, "label int, abuse double, quotation double").groupBy("label", "abuse", "quotation").agg(F.count(F.lit(1)).alias("n")).collect()
    model.curve = _fit_curve(sorted((r["label"], r["abuse"], r["quotation"], r["n"]) for r in points))
    return model


def _counted(seen: tuple[Counter, Counter]) -> Iterator[pa.RecordBatch]:
    every = list(seen[0].keys() | seen[1].keys())
    yield pa.RecordBatch.from_arrays([pa.array(every, pa.string()), pa.array([seen[1][w] for w in every], pa.int64()), pa.array([seen[0][w] for w in every], pa.int64())], names=["word", "toxic", "clean"])


def _starts() -> Column:
    return F.expr(f"transform(sequence({PREFIX_LEAST}, greatest({PREFIX_LEAST}, least({PREFIX_MOST}, length(word)))), k -> substring(word, 1, k))")


def _pick(rows: list[tuple[str, int, float]]) -> dict[str, float]:
    """Terms with their log-odds. Of nested beginnings the longest counts that keeps nearly all the texts of the shortest;
    words with a chosen beginning come with its family."""
    starts = {t[:-1]: (n, r) for t, n, r in rows if t.endswith("*")}
    below: dict[str, list[str]] = {}
    for start in sorted(starts, key=len):
        top = next((start[:k] for k in range(PREFIX_LEAST, len(start)) if start[:k] in starts), start)
        below.setdefault(top, []).append(start)
    picked: dict[str, float] = {}
    for top, nested in below.items():
        longest = top
        for other in nested:
            if other.startswith(longest) and starts[other][0] >= 0.9 * starts[top][0]:
                longest = other
        picked[longest + "*"] = math.log(starts[longest][1])
    whole = [(t, r) for t, _, r in rows if not t.endswith("*") and not any(t[:k] + "*" in picked for k in range(PREFIX_LEAST, len(t) + 1))]
    return picked | {t: math.log(r) for t, r in whole}


def _with_families(picked: dict[str, float], words: DataFrame) -> dict[str, float]:
    """The terms and, with the weight of their beginning, the whole words (word, toxic) of chosen beginnings."""
    starts = sorted(t[:-1] for t in picked if t.endswith("*"))
    if not starts:
        return picked
    firsts = words.sparkSession.createDataFrame([(s,) for s in starts], "start string")
    rows = words.select("word", F.explode(_starts()).alias("start")).join(F.broadcast(firsts), "start").orderBy("word", F.desc(F.length("start"))).collect()
    out = dict(picked)
    for r in rows:
        out.setdefault(r["word"], picked[r["start"] + "*"])
    return out


def _fit_curve(points: list[tuple]) -> tuple[float, float, float]:
    """Shift and slopes of a logistic curve over log sums; slopes have a prior that keeps them above 0 without evidence."""
    x = np.array([[1.0, math.log1p(a), math.log1p(q)] for _, a, q, _ in points])
    y, n = (np.array([p[k] for p in points], dtype=float) for k in (0, 3))
    prior = np.array([math.log(((n * y).sum() + 1) / ((n * (1 - y)).sum() + 1)), 2.0, 0.0])
    tight = np.array([1e-3, 0.05, 0.5])
    beta = prior.copy()
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + np.diag(tight)
        step = np.linalg.solve(hessian, x.T @ (n * (y - p)) - tight * (beta - prior))
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(b) for b in beta)


def scored(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """Columns `keep` and score. One pass without a shuffle; lexicon and exempt forms are bounded."""
    source, schema = with_text(docs, keep, text, {"score": "double"})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at, texts in chunked(batch.column(batch.num_columns - 1).to_pylist()):
                part = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array([model.curve_score(s) for s in model.sums(texts)], pa.float64())], names=[*batch.schema.names[:-1], "score"])

    return source.mapInArrow(run, schema)

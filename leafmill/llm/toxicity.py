"""Toxicity by a support vector machine over a gapped-subsequence string kernel.

Two strings are alike in this kernel when they share character subsequences of three or four letters, gaps of up to two
characters between letters (one in fours) costing a factor each; so an insult with characters put in or left out stays
near the plain one. The kernel is approximated by Nystroem landmarks, and a linear machine is trained on the landmark
features. Since the machine is linear in subsequence counts, landmarks and weights fold into one table with a weight
per subsequence, and a string is scored by summing table entries: no landmark is compared at scoring time.

A text is cut into sentences and each sentence into strings: every run of one to RUN words, and the whole sentence. A
blank is one character like the edge of a string, so that a subsequence may skip it as a gap. Sums over all strings of a
sentence come from running totals over its characters.

Training follows the multiple-instance scheme: a labelled document is a bag of such strings; a toxic bag has at least one
toxic string, a clean bag none. Strings stand for toxic documents when they are much likelier there than in clean ones,
so a few wrong labels do not take a string out; they are chosen again after each fit. A document's score is the
logistic of its highest string.
"""

from __future__ import annotations

import math
import pickle
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leafmill.llm import words

CLASSES = 32
PIECE, STRIDE = 24, 12
# Most words of a string, besides whole sentences.
RUN = 4
_DECAY = 0.8
# Offsets of the letters of a subsequence from its first one.
_THREES = [(a, a + b) for a in (1, 2, 3) for b in (1, 2, 3)]
_FOURS = [(a, a + b, a + b + c) for a in (1, 2) for b in (1, 2) for c in (1, 2)]
_SHAPES = [*_THREES, *_FOURS]
# Subsequences of ASCII have places of their own; those with other letters share 2^20 places by a hash.
_PLAIN = CLASSES**3 + CLASSES**4
_HASHED = 20
_TABLE = _PLAIN + (1 << _HASHED)
# A run of single characters ("i d i o t"), whatever blanks stand between, is one string more.
_SPACED = re.compile(r"(?<![^\x20\x09-\x0D])(?:[^\x20\x09-\x0D][\x20\x09-\x0D]++){2,}[^\x20\x09-\x0D](?![^\x20\x09-\x0D])")
_BATCH_BYTES = 2 << 20
_STRETCH = 1 << 16

# Class of a code point: a to z, other ASCII, the edge of a string or a blank; other letters have numbers of their own.
_EDGE = 27
_WIDE = 1 << 30
_CLASS = np.full(1 << 16, 26, np.int64)
_CLASS[128:] = _WIDE + (words.mix(np.arange(128, 1 << 16).astype(np.uint64)) >> np.uint64(26)).astype(np.int64)
_CLASS[ord("a") : ord("z") + 1] = _CLASS[ord("A") : ord("Z") + 1] = np.arange(26)
_CLASS[0x20] = _EDGE
# Punctuation, ASCII symbols and invisible characters belong to no string.
_SOLID = np.array([unicodedata.category(chr(c))[0] in "LNM" or (c >= 128 and unicodedata.category(chr(c))[0] == "S") for c in range(1 << 16)])
_BLANK = np.array([c == 0x20 or 9 <= c <= 13 or unicodedata.category(chr(c))[0] == "Z" for c in range(1 << 16)])
_STOP = np.zeros(1 << 16, bool)
_STOP[[ord(c) for c in ".!?\u2026\u3002\uff01\uff1f"]] = True
# Ratio of the shares of toxic and clean documents from which on a string speaks for toxic ones.
_TELLING = math.log(4.0)


def _classes(points: np.ndarray) -> np.ndarray:
    """Class of each code point."""
    out = _CLASS[np.minimum(points, 0xFFFF)]
    high = points > 0xFFFF
    if high.any():
        out[high] = _WIDE + (words.mix(points[high].astype(np.uint64)) >> np.uint64(26)).astype(np.int64)
    return out


def _codes(strings: np.ndarray) -> Iterator[tuple[np.ndarray, float, int]]:
    """Table places of every subsequence of equally long strings (classes, a string a row), what a place is worth, and the
    offset of its last letter.
    """
    n, any_wide = strings.shape[1], bool((strings >= _WIDE).any())
    for shape in _SHAPES:
        if n > shape[-1]:
            m = n - shape[-1]
            code = strings[:, :m]
            for step in shape:
                code = code * CLASSES + strings[:, step : step + m]
            wide = np.flatnonzero(code >= _WIDE) if any_wide else ()
            if len(shape) == 3:
                code += CLASSES**3
            if any_wide:
                flat = code.reshape(-1)
                hashed = words.mix(flat[wide].astype(np.uint64)) >> np.uint64(64 - _HASHED)
                flat[wide] = _PLAIN + hashed.astype(np.int64)
            yield code, _DECAY ** (shape[-1] - len(shape)), shape[-1]


def _framed(kinds: np.ndarray) -> np.ndarray:
    """The matrix of classes with an edge before and after each string."""
    edge = np.full((len(kinds), 1), _EDGE)
    return np.hstack([edge, kinds, edge])


def _norms(n: np.ndarray) -> np.ndarray:
    """Length of the feature vector of strings of n characters and their edges, their subsequences taken as distinct."""
    n = np.asarray(n, float) + 2
    total = sum(np.maximum(0, n - s[-1]) * _DECAY ** (2 * (s[-1] - len(s))) for s in _SHAPES)
    return np.where(total > 0, np.sqrt(total), 1.0)


_NORMS = _norms(np.arange(256))


@dataclass
class Strings:
    """The strings of a batch of texts, in blocks of one kind (runs of 1, 2, ... RUN words, then whole sentences).

    points holds the code points of all words, each after a blank, and a last blank; string i lies from the blank lo[i]
    to the blank hi[i] and belongs to text owner[i]. Parts of very long words have no blanks at their cuts and come last.
    """

    points: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    owner: np.ndarray
    kind: np.ndarray

    @staticmethod
    def of(texts: list[str | None]) -> Strings:
        folded = []
        for text in texts:
            text = (text or "").lower()
            joined = ["".join(x.split()) for x in _SPACED.findall(text)]
            folded.append("\n\n".join([text, *joined]) + "\n\n")
        sizes = np.array([len(x) for x in folded], np.int64)
        raw = np.frombuffer("".join(folded).encode("utf-32-le", "surrogatepass"), np.int32)
        low = np.minimum(raw, 0xFFFF)
        solid, blank = _SOLID[low] | (raw > 0xFFFF), _BLANK[low]
        # A word is what stands between blanks, without its punctuation; words of nothing else are none.
        begins = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
        ends = np.flatnonzero(~blank & np.concatenate([blank[1:], [True]])) + 1
        filled = np.concatenate([np.zeros(1, np.int32), np.cumsum(solid, dtype=np.int32)])
        letters = filled[ends] - filled[begins]
        # A sentence ends with a stop before a blank, unless after a single letter, and at an empty line.
        lines = np.concatenate([np.zeros(1, np.int32), np.cumsum(raw == 10, dtype=np.int32)])
        following = np.append(begins[1:], len(raw))
        stops = np.concatenate([np.zeros(1, np.int32), np.cumsum(_STOP[low], dtype=np.int32)])
        tail = np.maximum(ends - 3, begins)
        # Quotes and brackets may follow the stop.
        last = np.where(solid[ends - 1], 0, stops[ends] - stops[tail]) if len(ends) else np.zeros(0, np.int64)
        after = ((last > 0) & (letters != 1)) | (lines[following] - lines[ends] >= 2)
        sentence = np.cumsum(np.concatenate([[0], after[:-1]])) if len(after) else np.zeros(0, np.int64)
        have = letters > 0
        begins, letters, sentence = begins[have], letters[have], sentence[have]
        text = np.searchsorted(np.cumsum(sizes), begins, "right")
        edge = np.concatenate([[0], np.cumsum(letters + 1)])
        points = np.full(int(edge[-1]) + 1, 0x20, np.int32)
        inner = np.ones(len(points), bool)
        inner[edge] = False
        points[inner] = raw[solid & ~blank]
        words_of = np.arange(len(begins))
        _, first, count = np.unique(sentence, return_index=True, return_counts=True)
        end_of = np.repeat(first + count, count)
        lo, hi, owner, kind = [], [], [], []
        for k in range(1, RUN + 1):
            i = words_of[words_of + k <= end_of]
            lo, hi, owner, kind = [*lo, edge[i]], [*hi, edge[i + k]], [*owner, text[i]], [*kind, np.full(len(i), k)]
        long = first[count > RUN]
        lo, hi, owner = [*lo, edge[long]], [*hi, edge[end_of[long]]], [*owner, text[long]]
        kind.append(np.full(len(long), RUN + 1))
        wide = np.flatnonzero(letters > PIECE)
        begin, end, of = pieces(points, edge[wide], edge[wide + 1] + 1)
        lo, hi, owner, kind = [*lo, begin], [*hi, end - 1], [*owner, text[wide][of]], [*kind, np.zeros(len(begin), np.int64)]
        return Strings(points, *(np.concatenate(x).astype(t) for x, t in ((lo, np.int32), (hi, np.int32), (owner, np.int32), (kind, np.int8))))

    def values(self, table: np.ndarray, bias: float) -> np.ndarray:
        """Value of the machine for each string: differences of running totals of what begins at each character.

        Totals are kept per offset of the last letter, so that what reaches beyond a string is left out.
        """
        n, reach = len(self.points), max(s[-1] for s in _SHAPES)
        # Sums of what begins before a place, and of what also ends before it.
        before, within, carry = np.zeros(n + 1), np.zeros(n + 1), np.zeros(reach + 1)
        # Strings too short for the widest subsequences are summed apart.
        few = np.flatnonzero(self.hi - self.lo < reach)
        few = few[np.argsort(self.lo[few], kind="stable")]
        few_lo = self.lo[few]
        brief = np.zeros(len(few))
        for at in range(0, n, _STRETCH):
            part = _classes(self.points[at : at + _STRETCH + 2 * reach])[None, :]
            m = min(n - at, _STRETCH)
            totals = np.zeros((reach + 1, part.shape[1] + 1))
            for code, worth, last in _codes(part):
                totals[last, 1 : 1 + code.shape[1]] += worth * table[code[0]]
            np.cumsum(totals, axis=1, out=totals)
            before[at + 1 : at + 1 + m] = before[at] + totals[2:, 1 : 1 + m].sum(axis=0)
            for last in range(2, reach + 1):
                end = min(at + m + last, n + 1)
                within[at + last : end] += carry[last] + totals[last, 1 : 1 + end - at - last]
                carry[last] += totals[last, m]
            some = slice(*np.searchsorted(few_lo, (at, at + m)))
            lo, hi = few_lo[some] - at, self.hi[few[some]] - at
            for last in range(2, reach + 1):
                brief[some] += totals[last, np.maximum(hi - last + 1, lo)] - totals[last, lo]
        out = within[self.hi] - before[self.lo]
        out[few] = brief
        size = self.hi - self.lo - 1
        norm = _NORMS[np.minimum(size, len(_NORMS) - 1)]
        large = np.flatnonzero(size >= len(_NORMS))
        norm[large] = _norms(size[large])
        return bias + out / norm

    def text(self, i: int) -> bytes:
        """String i, blanks between its words."""
        points = self.points[self.lo[i] + 1 : self.hi[i]].astype(np.uint32)
        return points.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")

    def hashes(self, seed: int = 0) -> np.ndarray:
        """Equal strings have equal hashes."""
        out = np.zeros(len(self.lo), np.uint64)
        for k in range(RUN + 2):
            at = np.flatnonzero(self.kind == k)
            if len(at):
                out[at] = words.span_hashes(self.points, self.lo[at] + 1, self.hi[at], seed, plus=1)
        return out


def pieces(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of at most PIECE places over the given spans, overlapping in long ones, and the span of each."""
    sizes = ends - starts
    count = np.maximum(1, -(-(sizes - PIECE) // STRIDE) + 1)
    owner = np.repeat(np.arange(len(starts)), count)
    nth = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    begin = np.minimum(starts[owner] + nth * STRIDE, np.maximum(ends[owner] - PIECE, starts[owner]))
    return begin, np.minimum(begin + PIECE, ends[owner]), owner


def _by_size(strings: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices of equally long strings, at most 4,096 at once, and the framed matrix of their classes."""
    texts = [s.decode("utf-8", "surrogatepass") for s in strings]
    sizes = np.array([len(t) for t in texts], np.int64)
    for n in np.unique(sizes):
        same = np.flatnonzero(sizes == n)
        for at in np.split(same, range(4096, len(same), 4096)):
            raw = "".join(texts[i] for i in at).encode("utf-32-le", "surrogatepass")
            yield at, _framed(_classes(np.frombuffer(raw, np.uint32).astype(np.int64)).reshape(len(at), n))


def _features(strings: list[bytes]) -> list[dict[int, float]]:
    """Normalized subsequence features of each string, sparse."""
    out: list[dict[int, float]] = [{} for _ in strings]
    for at, matrix in _by_size(strings):
        norm = float(_norms(matrix.shape[1] - 2))
        for code, worth, _ in _codes(matrix):
            for i, row in zip(at.tolist(), code.tolist(), strict=True):
                for c in row:
                    out[i][c] = out[i].get(c, 0.0) + worth / norm
    return out


class _Landmarks:
    """Kernel values against fixed strings, by a table from subsequence places to their values in each landmark."""

    def __init__(self, marks: list[bytes]):
        self.features = _features(marks)
        places = sorted({c for x in self.features for c in x})
        self.index = np.full(_TABLE, -1, np.int32)
        self.index[places] = np.arange(len(places))
        self.values = np.zeros((len(places), len(marks)), np.float32)
        for j, x in enumerate(self.features):
            self.values[self.index[list(x)], j] = list(x.values())

    def kernel(self, strings: list[bytes]) -> np.ndarray:
        out = np.zeros((len(strings), self.values.shape[1]), np.float32)
        for at, matrix in _by_size(strings):
            norm = float(_norms(matrix.shape[1] - 2))
            for code, worth, _ in _codes(matrix):
                for column in self.index[code].T:
                    some = np.flatnonzero(column >= 0)
                    out[at[some]] += np.float32(worth / norm) * self.values[column[some]]
        return out

    def fold(self, alpha: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and weights of the sum of landmarks weighted by alpha."""
        places = np.flatnonzero(self.index >= 0)
        # In parts, for the driver's memory.
        parts = [self.values[i : i + 4096].astype(float) @ alpha for i in range(0, len(places), 4096)]
        return places, np.concatenate(parts) if parts else np.zeros(0)


def _values(strings: list[bytes], table: np.ndarray, bias: float) -> np.ndarray:
    out = np.full(len(strings), bias)
    for at, matrix in _by_size(strings):
        for code, worth, _ in _codes(matrix):
            out[at] += worth * table[code].sum(axis=1) / float(_norms(matrix.shape[1] - 2))
    return out


def _linear_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float) -> tuple[np.ndarray, float]:
    """Squared-hinge machine by Newton steps on the rows inside the margin."""
    x1 = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w = np.zeros(x1.shape[1])
    ridge = np.eye(x1.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(60):
        active = y * (x1 @ w.astype(np.float32)) < 1
        xa, ca = x1[active].astype(float), c * weight[active]
        new = np.linalg.solve(ridge + 2 * (xa.T * ca) @ xa, 2 * (xa.T * ca) @ y[active])
        step = 1.0 if np.linalg.norm(new - w) < 1 else 0.7
        if np.linalg.norm(new - w) < 1e-6:
            break
        w = w + step * (new - w)
    return w[:-1], float(w[-1])


def _support(which: np.ndarray, owner: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Documents that have each of n strings, near copies counted about once: by distinct least hashes of their strings."""
    out = np.full(n, len(which), np.int64)
    docs = int(owner.max()) + 1 if len(owner) else 0
    for seed in (1, 2):
        mark = np.full(docs, np.iinfo(np.uint64).max, np.uint64)
        np.minimum.at(mark, owner, words.mix(hashes + np.uint64(seed)))
        mark = np.unique(mark, return_inverse=True)[1]
        pairs = np.unique(which * np.int64(max(docs, 1)) + mark[owner])
        out = np.minimum(out, np.bincount(pairs // max(docs, 1), minlength=n))
    return out


def _surprising(toxic: np.ndarray, clean: np.ndarray, share: float) -> np.ndarray:
    """Whether each string lies in so many more toxic than clean documents that chance would yield less than half a such one.

    share is the part of the documents that is toxic.
    """
    total = toxic + clean
    often = np.bincount(total)
    tails, found = {}, np.flatnonzero(often)
    for n in found.tolist():
        t = np.arange(n + 1)
        logs = np.array([math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in range(n + 1)])
        chance = np.exp(logs + t * math.log(share) + (n - t) * math.log1p(-share))
        tails[n] = np.cumsum(chance[::-1])[::-1]
    for k in range(1, 200):
        bound = 0.5**k
        if sum(often[n] * max(x[x <= bound], default=0.0) for n, x in tails.items()) < 0.5:
            break
    tail = np.ones(len(total))
    for n in found.tolist():
        at = np.flatnonzero(total == n)
        tail[at] = tails[n][toxic[at]]
    return (tail <= bound) & (toxic >= 3)


def _variants(s: bytes) -> Iterator[bytes]:
    """The string with a foreign character or a blank put in, or a foreign one in place of an inner one."""
    s = s.decode("utf-8", "surrogatepass")
    for i in range(1, len(s)):
        yield (s[:i] + "0" + s[i:]).encode("utf-8", "surrogatepass")
        yield (s[:i] + " " + s[i:]).encode("utf-8", "surrogatepass")
        if i < len(s) - 1 and len(s) > 4:
            yield (s[:i] + "0" + s[i + 1 :]).encode("utf-8", "surrogatepass")


@dataclass
class Model:
    """Weight per subsequence (as places and values), bias, and the logistic that turns a document's maximum to a score."""

    places: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    values: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -1.0
    slope: float = 4.0
    offset: float = 0.0

    def score(self, top: np.ndarray) -> np.ndarray:
        """Score of documents by their maxima."""
        return 1 / (1 + np.exp(-(self.slope * np.clip(top, -5, 5) + self.offset)))

    def table(self) -> np.ndarray:
        out = np.zeros(_TABLE, np.float32)
        out[self.places] = self.values
        return out


def _strong(bags: Strings, which: np.ndarray, first: np.ndarray, telling: np.ndarray) -> np.ndarray:
    """Telling strings that hold no shorter telling one; as indices of distinct strings."""
    out: list[np.ndarray] = []
    begins = np.zeros((0, 2), np.int64)
    for k in range(1, RUN + 2):
        mine = np.flatnonzero(telling & (bags.kind[first] == k))
        lo, hi = bags.lo[first[mine]], bags.hi[first[mine]]
        held = np.zeros(len(mine), bool)
        if len(begins):
            # Least end among shorter ones that begin at lo or later.
            least = np.minimum.accumulate(begins[::-1, 1])[::-1]
            at = np.searchsorted(begins[:, 0], lo)
            held = np.append(least, np.iinfo(np.int64).max)[at] <= hi
        new = mine[~held]
        out.append(new)
        marked = np.zeros(len(telling), bool)
        marked[new] = True
        at = np.flatnonzero((bags.kind == k) & marked[which])
        begins = np.concatenate([begins, np.stack([bags.lo[at], bags.hi[at]], axis=1)])
        begins = begins[np.argsort(begins[:, 0], kind="stable")]
    return np.concatenate(out)


def train(toxic: list[str], clean: list[str], landmarks: int = 320, rounds: int = 6, c: float = 30.0) -> Model:
    """Fit on toxic and clean texts; without one of the kinds, a model under which nothing is toxic.

    Landmarks are the strings that most set toxic documents apart, half as many clean strings near them, and the rest
    drawn from clean strings by a hash.
    """
    if not toxic or not clean:
        return Model()
    bags = Strings.of([*toxic, *clean])
    bad = bags.owner < len(toxic)
    hashes = bags.hashes()
    names, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    n_names = len(names)
    if not n_names:
        return Model()
    which = which.astype(np.int32)
    seen, plain = (_support(which[x], bags.owner[x], hashes[x], n_names) for x in (bad, ~bad))
    del hashes, names
    whole = (bags.kind[first] > 0) & (bags.hi[first] - bags.lo[first] > 3)
    # Smoothed log odds: one quotation or wrong label among the clean documents does not take a string out.
    odds = np.log((seen + 0.5) / (len(toxic) + 1)) - np.log((plain + 0.5) / (len(clean) + 1))
    favoured = whole & (odds >= _TELLING)
    strong = _strong(bags, which, first, favoured & _surprising(seen, plain, len(toxic) / (len(toxic) + len(clean))))
    if not len(strong):
        return Model()
    strong = strong[np.argsort(-seen[strong], kind="stable")]
    told = np.zeros(n_names, bool)
    told[strong] = True
    # A clean-labelled document with such a string contradicts its label and gives no negatives.
    doubtful = np.zeros(len(toxic) + len(clean), bool)
    doubtful[bags.owner[told[which]]] = True
    trusted = ~bad & ~doubtful[bags.owner]
    counter = np.zeros(n_names, bool)
    counter[which[trusted]] = True
    counter &= whole & ~favoured
    text = {int(i): bags.text(first[i]) for i in strong}
    # Names are in order of their hashes: their first ones are a sample. Words most of all, fewer of the longer strings.
    kinds = bags.kind[first]
    pool = np.concatenate([np.flatnonzero(counter & (kinds == k))[:m] for k, m in ((1, 12_000), *((k, 2000) for k in range(2, RUN + 1)), (RUN + 1, 300))])
    text |= {int(i): bags.text(first[i]) for i in pool}
    marks = [text[int(i)] for i in strong[: landmarks // 2]]
    near = _Landmarks(marks).kernel([text[int(i)] for i in pool]).max(axis=1)
    nearest = pool[np.argsort(-near, kind="stable")]
    marks = marks + [text[int(i)] for i in nearest[: landmarks // 4]]
    marks = list(dict.fromkeys(marks + [text[int(i)] for i in pool[: landmarks - len(marks)]]))
    base = _Landmarks(marks)
    values, vectors = np.linalg.eigh(base.kernel(marks).astype(float))
    good = values > 1e-5 * values.max()
    root = (vectors[:, good] / np.sqrt(values[good])).astype(np.float32)
    known: dict[bytes, np.ndarray] = {}

    def rows(strings: list[bytes]) -> np.ndarray:
        new = [s for s in dict.fromkeys(strings) if s not in known]
        known.update(zip(new, base.kernel(new) @ root, strict=True))
        return np.stack([known[s] for s in strings])

    own = {text[int(i)] for i in strong}
    bent = sorted({v for s in own if len(s) <= PIECE for v in _variants(s)} - own)
    # The first guess of each toxic bag's string is its most telling one; a bag without any waits for the machine.
    chosen = np.full(len(toxic), -1, np.int64)
    rank = np.full(n_names, len(strong), np.int64)
    rank[strong] = np.arange(len(strong))
    at = np.flatnonzero(bad & told[which])
    at = at[np.argsort(-rank[which[at]], kind="stable")]
    chosen[bags.owner[at]] = which[at]
    inside = np.flatnonzero(bad & favoured[which])
    outside = np.flatnonzero(trusted & counter[which])
    words_first = np.flatnonzero(kinds[pool] == 1)
    negatives = dict.fromkeys([*pool[words_first[:2500]].tolist(), *pool[kinds[pool] > 1][::8].tolist(), *nearest[:2000].tolist()])
    model = Model()
    for _ in range(rounds):
        picked, times = np.unique(np.concatenate([chosen[chosen >= 0], strong]), return_counts=True)
        times = np.maximum(np.where(told[picked], times - 1, times), np.where(told[picked], seen[picked], 0))
        no = np.array(list(negatives))
        for i in [*picked.tolist(), *no.tolist()]:
            if i not in text:
                text[i] = bags.text(first[i])
        x = rows([*(text[i] for i in picked.tolist()), *bent, *(text[i] for i in no.tolist())])
        y = np.concatenate([np.ones(len(picked) + len(bent)), -np.ones(len(no))])
        weight = np.concatenate([np.sqrt(times), np.full(len(bent), 0.3), np.sqrt(np.maximum(plain[no], 1))])
        w, b = _linear_svm(x, y, weight, c)
        model = Model(*base.fold(root.astype(float) @ w), b)
        value = bags.values(model.table(), b)
        # Clean strings that the machine finds toxic join the negatives; bags choose anew among what it finds toxic.
        wrong = outside[np.argsort(-value[outside], kind="stable")]
        wrong = wrong[value[wrong] > -1]
        negatives |= dict.fromkeys(list(dict.fromkeys(which[wrong[:20_000]].tolist()))[:1500])
        best = inside[np.argsort(value[inside], kind="stable")]
        best = best[value[best] > 0]
        chosen[bags.owner[best]] = which[best]
    tops = np.full(len(toxic) + len(clean), model.bias)
    np.maximum.at(tops, bags.owner, bags.values(model.table(), model.bias))
    tops = [tops[: len(toxic)], tops[len(toxic) :]]
    target = np.concatenate([np.ones(len(toxic)), np.zeros(len(clean))])
    model.slope, _ = _logistic(np.concatenate(tops), target)
    model.offset = -model.slope * max(0.0, _border(*tops))
    return model


def _border(toxic: np.ndarray, clean: np.ndarray, cost: float = 5.0) -> float:
    """The border of least loss between maxima of toxic and clean documents: the middle of the widest such gap.

    Every document on the wrong side costs the same however far it lies, so wrong labels do not draw the border to them;
    the share of clean documents that are lost counts cost times.
    """
    at = np.unique(np.concatenate([toxic, clean]))
    low, high = at[:-1], at[1:]
    if not len(low):
        return float(at[0])
    missed = np.searchsorted(np.sort(toxic), low, "right") / len(toxic)
    lost = 1 - np.searchsorted(np.sort(clean), low, "right") / len(clean)
    loss = missed + cost * lost
    best = np.flatnonzero(loss <= loss.min() + 1e-9)
    widest = best[np.argmax((high - low)[best])]
    return float((low[widest] + high[widest]) / 2)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> tuple[float, float]:
    """Slope and offset of the score; both labels weigh the same."""
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    design = np.stack([np.clip(x, -5, 5), np.ones(len(x))], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ w))
        grad = design.T @ (weight * (p - y)) + ridge * 0.01 * w
        hess = (design.T * (weight * p * (1 - p))) @ design + ridge * 0.01 * np.eye(2)
        w -= np.linalg.solve(hess, grad)
    return max(float(w[0]), 0.1), float(w[1])


def document_maximum(texts: pa.Array, table: np.ndarray, bias: float) -> np.ndarray:
    """Highest value of the machine over the strings of each whole text; texts without strings have the bias."""
    best = np.full(len(texts), bias)
    found = Strings.of(texts.to_pylist())
    np.maximum.at(best, found.owner, found.values(table, bias))
    return best


def held_out(doc_id: str = "doc_id", fold: int = 5):
    """Rows that no model learns from: crc32 of the id as text leaves remainder 0. A null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % fold == 0, F.lit(True))


def fit(
    docs: DataFrame, labels: DataFrame, most_toxic: int = 600, most_clean: int = 1200, most_chars: int = 4_000_000, fold: int = 5
) -> Model:
    """Train on labelled rows outside the held-out fold: at most that many of each label, in order of a hash of the id,
    and of each label only as long as its texts add up to at most most_chars characters (longer texts are passed over).

    The sample is trained in one executor task; only the trained model comes back to the driver.
    """
    known = labels.where(~held_out("doc_id", fold) & F.col("toxic").isNotNull()).select("doc_id", "toxic").distinct()
    parts = [
        known.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for t, n in ((1, most_toxic), (0, most_clean))
    ]
    # At most most_toxic + most_clean rows.
    sample = F.broadcast(parts[0].unionByName(parts[1]))
    rows = docs.where("text is not null").select("doc_id", "text").join(sample, "doc_id")
    running = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id", "text").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_chars", F.sum(F.length("text")).over(running)).where(F.col("_chars") <= most_chars)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chunks = list(frames)
        frame = pd.concat(chunks) if chunks else pd.DataFrame(columns=["doc_id", "text", "toxic"])
        frame = frame.sort_values(["doc_id", "text"]) if len(frame) else frame
        model = train(frame.text[frame.toxic == 1].tolist(), frame.text[frame.toxic == 0].tolist())
        yield pd.DataFrame({"model": [pickle.dumps(model)]})

    trained = rows.select("doc_id", "text", "toxic").repartition(1).mapInPandas(run, "model binary").collect()  # one model
    return pickle.loads(trained[0].model) if trained else train([], [])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of docs with score (0 to 1) and predicted (1 from 0.5 on) of every whole text; they replace columns of
    these names.

    Empty, null and blank texts get the score of a text without any subsequence. An empty table gives no rows.
    """
    columns = [c for c in docs.columns if c not in ("score", "predicted")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for batch in words.gathered(batches, _BATCH_BYTES):
            top = document_maximum(batch.column("text"), table, model.bias)
            value = model.score(top)
            extra = [pa.array(value), pa.array((value >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *extra], [*columns, "score", "predicted"])

    schema = docs.select(*columns).schema.add("score", "double").add("predicted", "integer")
    return docs.select(*columns).mapInArrow(run, schema)


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, all columns, that are not predicted toxic; each row is judged by its own text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for batch in words.gathered(batches, _BATCH_BYTES):
            top = document_maximum(batch.column("text"), table, model.bias)
            yield batch.filter(pa.array(model.score(top) < 0.5))

    return docs.mapInArrow(run, docs.schema)

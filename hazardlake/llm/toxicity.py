"""Toxicity by a subsequence string kernel, a support vector machine and Nyström landmarks.

Words are compared by the letter sequences of length three and four that they
share, gaps allowed, each skipped letter weighing ``DECAY``; so an insult with
inserted characters, dots or an ending it never had in training still resembles
its landmark. A word begins and ends with a border letter, so that a stem at the
border differs from the same letters inside. Letters lose case; an accent is a
letter after its own, which gaps may skip; letters that do not go back to a to z are
hashed to ``OTHERS`` codes; punctuation inside a word is dropped, and letters that
stand alone in a row are one word.

Landmarks are words of the training documents. A word's Nyström features are its
kernel values to them, whitened by their own kernel matrix, and a linear SVM
separates witnesses of toxicity from other words. Labels are of documents, so
training takes turns: a toxic document's witnesses are its words that clean
documents hardly have, or that hold runs of letters that clean documents hardly
have, and its most suspicious word so far; the most suspicious words of clean
documents are counterexamples. What is telling is decided by a likelihood ratio over
documents, so that a word of a language with few documents counts as soon as
chance cannot explain it; the language itself is never looked at. All this
stays linear in the weighted subsequences, so the trained model folds into one
weight per subsequence and scores a word without visiting the landmarks.

A document's score is a logistic function of its two most suspicious words and of
the numbers of suspicious and of all different words, fitted on training documents that the SVM did
not see, weighted back to the classes' true shares. Of training documents that are
copies of each other, one of each label is used.

Training reads whole texts of about ``sample_toxic`` toxic and ``sample_clean``
clean labelled documents, chosen by a hash of the id.

Defined results: a null or letterless text has no words and gets the score of
the least suspicious text; with labels of one class only, the score is that
class's share; documents with several labels count by their largest.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlake.llm.words import ALNUM, LOWER, NOT_BLANK, Words, mixed, slice_hashes, slices, window_hashes, windows

DECAY = 0.6
#: Letters that may be skipped inside a subsequence.
SKIPS = 2
LANDMARKS = 224
COMMON_LANDMARKS = 64
SAMPLE_TOXIC = 2500
SAMPLE_CLEAN = 4000
ROUNDS = 4
#: Lengths of the runs of letters (borders count) that may be telling; whole words may be as well.
RUNS = (4, 5, 6)
#: A telling word or run stands in no fewer toxic documents, has at least such log-odds, and chance explains it
#: less often than once in e to the ``EVIDENCE``.
SUPPORT = 4
WITNESS_ODDS = 1.5
EVIDENCE = 12.0
WITNESSES = 6
COUNTERS = 4
#: Hashes that look for copies among the training documents.
COPY_HASHES = 4
#: Longer words are cut into overlapping pieces of so many letters.
WORD = 24
#: Letters two pieces of a word share, one less than the longest subsequence spans.
OVERLAP = 5
#: Codes: 26 letters, accents, other letters, the border.
ACCENTS = 5
OTHERS = 8
BORDER = 26 + ACCENTS + OTHERS
LETTERS = BORDER + 1
#: Words compared at once; bounds memory.
WORDS_AT_ONCE = 20_000
#: The lowest word score that is told apart.
FLOOR = -1.5
#: From this score on a word is counted as suspicious.
SUSPICIOUS = 0.3
#: Documents of fewer different words are treated as if they had so many.
FEW = 32
#: Features of a document.
FEATURES = 4

PATTERNS = [gaps for n in (3, 4) for gaps in product(range(SKIPS + 1), repeat=n - 1) if sum(gaps) <= SKIPS]

# Characters that stand for letters.
_STAND_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a"}


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letter code of a byte; letter and accent of a character of two bytes by its code point. -1 is dropped."""
    plain = np.full(256, -1, dtype=np.int64)
    for i in range(26):
        plain[65 + i] = plain[97 + i] = i
    for c, letter in _STAND_FOR.items():
        plain[ord(c)] = ord(letter) - 97
    letter, accent = np.full(0x800, -1, dtype=np.int64), np.full(0x800, -1, dtype=np.int64)
    for point in range(0x80, 0x800):
        parts = unicodedata.normalize("NFKD", chr(point).lower())
        if "a" <= parts[0] <= "z":
            letter[point] = ord(parts[0]) - 97
            if len(parts) > 1:
                accent[point] = 26 + ord(parts[1]) % ACCENTS
        elif unicodedata.combining(chr(point)):
            letter[point] = 26 + point % ACCENTS
        elif parts[0].isalpha():
            letter[point] = 26 + ACCENTS + ord(parts[0]) * 40503 % 65536 * OTHERS // 65536
    return plain, letter, accent


_PLAIN, _LETTER, _ACCENT = _tables()


def _codes(data: np.ndarray) -> np.ndarray:
    """Letter code of each byte of UTF-8 text; a character's code stands at its first byte, its accent's at its second."""
    code = _PLAIN[data]
    if len(data) and data.max() >= 0x80:
        byte = np.append(data, np.zeros(2, dtype=data.dtype)).astype(np.int64)
        two = np.flatnonzero((data >= 0xC2) & (data < 0xE0))
        point = (byte[two] & 31) << 6 | byte[two + 1] & 63
        code[two] = _LETTER[point]
        code[np.minimum(two + 1, len(data) - 1)] = _ACCENT[point]
        more = np.flatnonzero(data >= 0xE0)
        mix = (byte[more] << 12 | (byte[more + 1] & 63) << 6 | byte[more + 2] & 63) * 40503 % 65536
        punctuation = (byte[more] == 0xE2) & (byte[more + 1] <= 0x81)  # general punctuation
        code[more] = np.where(punctuation, -1, 26 + ACCENTS + mix * OTHERS // 65536)
    return code


def spans(size: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Indexes ``start[i]`` to ``start[i] + size[i]``, one after another."""
    return np.arange(int(size.sum())) + np.repeat(start - np.cumsum(size) + size, size)


class Tokens:
    """Words of texts as letter codes between borders: ``code``, ``start``, ``end``; ``first[r]`` words stand before row ``r``."""

    def __init__(self, texts: pa.Array):
        w = Words(texts, NOT_BLANK)
        code = _codes(w.data)
        keep = code >= 0
        before = np.concatenate([[0], np.cumsum(keep)])
        letters = np.concatenate([[0], np.cumsum(keep & ((code < 26) | (code >= 26 + ACCENTS)))])
        some = letters[w.end] > letters[w.start]
        start, end, row = before[w.start[some]], before[w.end[some]], w.row[some]
        single = (letters[w.end] - letters[w.start])[some] == 1
        joins = np.zeros(len(start), dtype=bool)
        joins[1:] = single[1:] & single[:-1] & (row[1:] == row[:-1])
        heads = np.flatnonzero(~joins)
        start, row = start[heads], row[heads]
        end = end[np.append(heads[1:], len(end)) - 1] if len(heads) else end[:0]
        code = code[keep]
        size = end - start + 2
        stop = np.cumsum(size)
        self.code = np.full(int(size.sum()), BORDER, dtype=np.int64)
        self.code[spans(size - 2, stop - size + 1)] = code[spans(size - 2, start)]
        step = WORD - OVERLAP
        parts = np.maximum(1, -(-(size - OVERLAP) // step))
        which = spans(parts, np.zeros(len(parts), dtype=np.int64))
        self.start = np.repeat(stop - size, parts) + which * step
        self.end = np.minimum(self.start + WORD, np.repeat(stop, parts))
        row = np.repeat(row, parts)
        self.row = row
        self.first = np.searchsorted(row, np.arange(len(w.first)))

    def hashes(self) -> np.ndarray:
        return slice_hashes((self.code + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), self.start, self.end, 11)

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of one of each different word, and each word's number among them."""
        _, at, number = np.unique(self.hashes(), return_index=True, return_inverse=True)
        return self.start[at], self.end[at], number


def subsequences(code: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float, int]]:
    """For each pattern of gaps: (word, subsequence, weight, length) of every place it fits."""
    word = np.repeat(np.arange(len(start)), end - start)
    size = end - start
    at = np.arange(len(word)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)
    room = np.repeat(end, size) - at
    for gaps in PATTERNS:
        steps = np.cumsum([0, *(g + 1 for g in gaps)])
        fits = room > steps[-1]
        place, value = at[fits], 0
        for s in steps:
            value = value * LETTERS + code[place + s]
        yield word[fits], value, DECAY ** sum(gaps), len(steps)


def norms(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Length of a word's vector of weighted subsequences (at least 1), by its number of letters."""
    size = np.arange(WORD + 1)
    total = np.zeros(WORD + 1)
    for gaps in PATTERNS:
        total += np.maximum(0, size - sum(g + 1 for g in gaps)) * DECAY ** (2 * sum(gaps))
    return np.sqrt(np.maximum(total, 1.0))[end - start]


@dataclass
class Weights:
    """A linear function of a word's weighted subsequences of length 3 and 4."""

    three: np.ndarray
    four: np.ndarray
    bias: float = 0.0

    @classmethod
    def zero(cls) -> Weights:
        return cls(np.zeros(LETTERS**3, dtype=np.float32), np.zeros(LETTERS**4, dtype=np.float32))

    def add(self, code: np.ndarray, scale: float) -> None:
        """Add a word's vector, times ``scale`` over its norm."""
        start, end = np.array([0]), np.array([len(code)])
        scale = scale / float(norms(start, end)[0])
        for _, value, weight, n in subsequences(code, start, end):
            np.add.at(self.three if n == 3 else self.four, value, weight * scale)

    def score(self, code: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        total = np.zeros(len(start))
        for i in range(0, len(start), WORDS_AT_ONCE):
            some = slice(i, min(i + WORDS_AT_ONCE, len(start)))
            for word, value, weight, n in subsequences(code, start[some], end[some]):
                total[some] += weight * np.bincount(word, (self.three if n == 3 else self.four)[value], some.stop - i)
        return total / norms(start, end) + self.bias


class Vocabulary:
    """Distinct words of the sampled documents, as letter codes, and which document has which."""

    def __init__(self, texts: list[str | None]):
        codes, names, docs = [], [], []
        batch = pa.record_batch({"text": pa.array(texts, pa.large_string()), "row": pa.array(np.arange(len(texts)))})
        for part in slices(batch, "text"):
            t = Tokens(part.column("text"))
            names.append(t.hashes())
            docs.append(part.column("row").to_numpy()[t.row])
            _, at = np.unique(names[-1], return_index=True)
            size = t.end[at] - t.start[at]
            codes.append((names[-1][at], size, t.code[np.repeat(t.start[at] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))].astype(np.int8)))
        every = np.concatenate([np.zeros(0, dtype=np.uint64), *[c[0] for c in codes]])
        sizes = np.concatenate([np.zeros(0, dtype=np.int64), *[c[1] for c in codes]])
        known, at = np.unique(every, return_index=True)
        ends = np.cumsum(sizes)
        self.code = np.concatenate([np.zeros(0, dtype=np.int8), *[c[2] for c in codes]]).astype(np.int32)
        self.start, self.end = (ends - sizes)[at], ends[at]
        number = np.searchsorted(known, np.concatenate([np.zeros(0, dtype=np.uint64), *names]))
        pairs = np.unique(np.concatenate([np.zeros(0, dtype=np.int64), *docs]) * (len(known) + 1) + number)
        self.doc, self.word = pairs // (len(known) + 1), pairs % (len(known) + 1)

    def letters(self, word: int) -> np.ndarray:
        return self.code[self.start[word] : self.end[word]]

    def best_per_document(self, score: np.ndarray, docs: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` highest scored words of each of ``docs``."""
        mine = np.isin(self.doc, docs)
        doc, word = self.doc[mine], self.word[mine]
        order = np.lexsort((word, -score[word], doc))
        doc, word = doc[order], word[order]
        first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else doc
        rank = np.arange(len(doc)) - np.repeat(first, np.diff(np.append(first, len(doc))))
        return word[rank < n]


@dataclass
class Telling:
    """Runs and whole words that toxic documents have and clean ones hardly: their log-odds and which words hold them."""

    odds: np.ndarray
    toxic: np.ndarray
    #: Pairs of a word and a run it holds.
    word: np.ndarray
    run: np.ndarray

    def by_word(self, n: int) -> np.ndarray:
        """Each of ``n`` words' highest log-odds."""
        out = np.zeros(n)
        np.maximum.at(out, self.word, self.odds[self.run])
        return out


def _documents(v: Vocabulary, docs: np.ndarray, at: np.ndarray, run: np.ndarray, n: int) -> np.ndarray:
    """How many of ``docs`` have each of ``n`` runs; word ``w`` holds ``run[at[w] : at[w + 1]]``."""
    out = np.zeros(n, dtype=np.int32)
    for d in docs:
        words = v.word[np.searchsorted(v.doc, d) : np.searchsorted(v.doc, d, "right")]
        out[np.unique(run[spans(at[words + 1] - at[words], at[words])])] += 1
    return out


def _telling(v: Vocabulary, toxic: np.ndarray) -> Telling:
    """The telling runs of each length, one length at a time, and the telling words."""
    size = v.end - v.start
    values = (v.code.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    bad, good = np.flatnonzero(toxic), np.flatnonzero(~toxic)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
    before = 0
    for length in (*RUNS, None):
        if length is None:
            word = np.arange(len(size), dtype=np.int32)
            _, run = np.unique(word, return_inverse=True)
        else:
            room = np.maximum(size - length + 1, 0)
            word = np.repeat(np.arange(len(size), dtype=np.int32), room)
            place = spans(room, v.start)
            _, run = np.unique(slice_hashes(values, place, place + length, 13), return_inverse=True)
        n = int(run.max()) + 1 if len(run) else 0
        t = _documents(v, bad, np.searchsorted(word, np.arange(len(size) + 1)), run, n)
        new = np.cumsum(t >= SUPPORT) - 1  # only these are looked for in clean documents
        some = (t >= SUPPORT)[run]
        word, run, t = word[some], new[run[some]], t[t >= SUPPORT]
        c = _documents(v, good, np.searchsorted(word, np.arange(len(size) + 1)), run, len(t))
        odds = np.log((t + 0.5) / (len(bad) + 1)) - np.log((c + 1) / (len(good) + 1))
        share, both = len(bad) / max(1, len(toxic)), t + c
        # log-likelihood ratio of its documents' share of toxic ones against that of all
        evidence = t * np.log(t / both / share) + c * np.log(np.maximum(c, 1e-9) / both / (1 - share))
        yes = (odds >= WITNESS_ODDS) & (evidence >= EVIDENCE)
        new = np.cumsum(yes) - 1
        some = yes[run]
        found.append((odds[yes], t[yes], word[some], new[run[some]] + before))
        before += int(yes.sum())
    return Telling(*(np.concatenate(x) for x in zip(*found)))


def _landmarks(v: Vocabulary, telling: Telling) -> tuple[list[int], np.ndarray]:
    """Words that hold telling runs, until all runs stand in some landmark and then in several, and the most frequent words."""
    frequency = np.bincount(v.word, minlength=len(v.start))
    order = np.lexsort((-frequency[telling.word], telling.run))
    at = np.searchsorted(telling.run[order], np.arange(len(telling.odds) + 1))
    by_word = np.argsort(telling.word, kind="stable")
    held = np.searchsorted(telling.word[by_word], np.arange(len(v.start) + 1))
    best = np.argsort(-telling.odds * np.log1p(telling.toxic), kind="stable")
    met = np.zeros(len(best), dtype=np.int64)
    chosen: list[int] = []
    for most in range(4):
        for run in best.tolist():
            if met[run] > most or len(chosen) >= LANDMARKS:
                continue
            word = next((w for w in telling.word[order[at[run] : at[run + 1]]].tolist() if w not in chosen), None)
            if word is not None:
                chosen.append(word)
                met[telling.run[by_word[held[word] : held[word + 1]]]] += 1
    common = [int(w) for w in np.argsort(-frequency, kind="stable") if v.end[w] - v.start[w] >= 5 and int(w) not in chosen]
    spread = common[:: max(1, len(common) // COMMON_LANDMARKS)][: COMMON_LANDMARKS // 2]
    return list(dict.fromkeys([*chosen, *common[: COMMON_LANDMARKS // 2], *spread])), frequency


class Nystroem:
    def __init__(self, landmarks: list[np.ndarray]):
        self.landmarks = landmarks
        ends = np.cumsum([len(c) for c in landmarks])
        start, code = np.append(0, ends[:-1]), np.concatenate(landmarks)
        found = [(w, v + (n - 3) * LETTERS**3, weight) for w, v, weight, n in subsequences(code, start, ends)]
        used = np.unique(np.concatenate([v for _, v, _ in found]))
        # row 0 is for subsequences that no landmark has
        self.row = np.zeros(LETTERS**3 + LETTERS**4, dtype=np.int32)
        self.row[used] = np.arange(1, len(used) + 1)
        self.table = np.zeros((len(used) + 1, len(landmarks)), dtype=np.float32)
        for w, v, weight in found:
            np.add.at(self.table, (self.row[v], w), weight)
        self.table /= norms(start, ends)
        kernel = self.kernel(code, start, ends)
        values, vectors = np.linalg.eigh((kernel + kernel.T) / 2)
        inverse = np.where(values > 1e-4, 1 / np.sqrt(np.maximum(values, 1e-4)), 0)
        self.whiten = vectors * inverse @ vectors.T

    def kernel(self, code: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Normalised kernel of each word to each landmark."""
        out = np.zeros((len(start), len(self.landmarks)))
        step = WORDS_AT_ONCE // 10
        for i in range(0, len(start), step):
            for word, value, weight, n in subsequences(code, start[i : i + step], end[i : i + step]):
                row = self.row[value + (n - 3) * LETTERS**3]
                word, row = word[row > 0], row[row > 0]
                at = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else word
                if len(at):
                    out[i + word[at]] += weight * np.add.reduceat(self.table[row], at, axis=0)
        return out / norms(start, end)[:, None]

    def features(self, v: Vocabulary, words: np.ndarray) -> np.ndarray:
        return self.kernel(v.code, v.start[words], v.end[words]) @ self.whiten

    def fold(self, weight: np.ndarray, bias: float) -> Weights:
        out = Weights.zero()
        out.bias = bias
        for code, scale in zip(self.landmarks, self.whiten @ weight):
            out.add(code, float(scale))
        return out


def svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-4, steps: int = 30) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss and balanced classes, by Newton steps on the active rows."""
    x = np.column_stack([x, np.ones(len(x))])
    share = weight * np.where(y > 0, 0.5 / max(1e-9, weight[y > 0].sum()), 0.5 / max(1e-9, weight[y < 0].sum()))
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[-1, -1] = 1e-6
    for _ in range(steps):
        active = y * (x @ w) < 1
        a = x[active] * share[active, None]
        new = np.linalg.solve(a.T @ x[active] + penalty, a.T @ y[active])
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w[:-1], float(w[-1])


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Coefficients of a weighted logistic regression; the last is the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    weight = weight / weight.sum()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + ridge * np.append(w[:-1], 0)
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    weights: Weights | None
    calibration: np.ndarray

    def document_features(self, texts: pa.Array) -> np.ndarray:
        """Per text, the highest score of a word and of another word, and logarithms of the numbers of suspicious and of all words."""
        out = np.zeros((len(texts), FEATURES))
        out[:, :2], out[:, 3] = FLOOR, np.log(FEW)
        if self.weights is None:
            return out
        t = Tokens(texts)
        if not len(t.start):
            return out
        start, end, number = t.distinct()
        known = np.maximum(self.weights.score(t.code, start, end), FLOOR)
        # one of each word of a row, the highest score first
        pair = np.unique(t.row * len(known) + number)
        row, score = pair // len(known), known[pair % len(known)]
        order = np.lexsort((-score, row))
        score = score[order]
        rows, first, size = np.unique(row, return_index=True, return_counts=True)
        out[rows, 0] = score[first]
        out[rows[size > 1], 1] = score[first[size > 1] + 1]
        out[rows, 2] = np.log1p(np.add.reduceat((score > SUSPICIOUS).astype(float), first))
        out[rows, 3] = np.log(np.maximum(size, FEW))
        return out

    def score(self, texts: pa.Array) -> np.ndarray:
        x = self.document_features(texts)
        return 1 / (1 + np.exp(-np.clip(x @ self.calibration[:-1] + self.calibration[-1], -30, 30)))


def without_copies(texts: list[str | None], toxic: np.ndarray) -> np.ndarray:
    """Indexes of one document of each label among documents whose sets of five words resemble each other.

    Documents that share the least hash of a run of five words, by any of ``COPY_HASHES`` hashes, hang together. Copies
    of a toxic document would otherwise make all its words telling.
    """
    n = len(texts)
    least = np.zeros((n, COPY_HASHES), dtype=np.uint64)
    batch = pa.record_batch({"text": pa.array(texts, pa.large_string()), "row": pa.array(np.arange(n))})
    for part in slices(batch, "text"):
        w = Words(part.column("text"), ALNUM, LOWER)
        words, row = w.hashes(), part.column("row").to_numpy()
        begin = windows(w.first, 5)
        few = np.flatnonzero((w.counts() > 0) & (w.counts() < 5))  # these are one run each
        begin, size = np.append(begin, w.first[few]), np.append(np.full(len(begin), 5), w.counts()[few])
        order = np.argsort(begin, kind="stable")
        begin, size = begin[order], size[order]
        if len(begin):
            here, first = np.unique(w.row[begin], return_index=True)
            found = window_hashes(words, begin, size)
            for k in range(COPY_HASHES):
                least[row[here], k] = np.minimum.reduceat(mixed(found + np.uint64(k)), first)
    group = np.arange(n)
    while True:
        before = group.copy()
        for k in range(COPY_HASHES):
            _, same = np.unique(least[:, k], return_inverse=True)
            low = np.full(n, n)
            np.minimum.at(low, same, group)
            group = low[same]
        if (group == before).all():
            break
    _, first = np.unique(group * 2 + toxic, return_index=True)
    return np.sort(first)


def train(texts: list[str | None], toxic: np.ndarray, true_share: float) -> Model:
    """A model from whole texts and their labels, of copies only one."""
    some = without_copies(texts, toxic)
    texts, toxic = [texts[i] for i in some], toxic[some]
    n = len(texts)
    if not n or toxic.all() or not toxic.any():
        share = min(max(true_share, 1e-6), 1 - 1e-6)
        return Model(None, np.append(np.zeros(FEATURES), np.log(share / (1 - share))))
    fits = np.arange(n) % 4 != 3  # the rest calibrates
    if not toxic[fits].any() or toxic[fits].all():
        fits[:] = True
    inner = np.flatnonzero(fits)
    v = Vocabulary([texts[i] for i in inner])
    label = toxic[inner]
    telling = _telling(v, label)
    suspicion = telling.by_word(len(v.start))
    marks, frequency = _landmarks(v, telling)
    space = Nystroem([v.letters(w) for w in marks])
    bad, good = np.flatnonzero(label), np.flatnonzero(~label)
    common = np.argsort(-frequency, kind="stable")[:500]
    known = v.best_per_document(suspicion, bad, WITNESSES)
    known = known[suspicion[known] >= WITNESS_ODDS]
    weights = None
    for _ in range(ROUNDS):
        witness = np.concatenate([known, v.best_per_document(suspicion, bad, 1)])
        counter = np.concatenate([v.best_per_document(suspicion, good, COUNTERS), common])
        # each word once a side, so that the insults of a rare language weigh nearly as much as those of a common one
        (witness, often), (counter, seen) = (np.unique(x, return_counts=True) for x in (witness, counter))
        y = np.concatenate([np.ones(len(witness)), -np.ones(len(counter))])
        used, back = np.unique(np.concatenate([witness, counter]), return_inverse=True)
        weights = space.fold(*svm(space.features(v, used)[back], y, np.log1p(np.concatenate([often, seen]))))
        suspicion = weights.score(v.code, v.start, v.end)
    model = Model(weights, np.zeros(FEATURES + 1))
    rest = np.flatnonzero(~fits) if (~fits).any() else inner
    x = model.document_features(pa.array([texts[i] for i in rest], pa.large_string()))
    y = toxic[rest].astype(float)
    share = max(y.mean(), 1e-6)
    weight = np.where(y > 0, true_share / share, (1 - true_share) / max(1 - share, 1e-6))
    model.calibration = logistic(x, y, weight)
    return model


def _part(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary"))


def sample(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic", toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN
) -> tuple[list[str | None], np.ndarray, float]:
    """Whole texts and labels of about so many labelled documents of each class, and the true share of toxic ones."""
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("_key")).agg((F.max(label) > 0).alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = {True: toxic / max(1, sizes.get(True, 0)), False: clean / max(1, sizes.get(False, 0))}
    dice = F.pmod(F.xxhash64("_key"), F.lit(1 << 30)) / float(1 << 30)
    chosen = known.filter(dice < F.when(F.col("toxic"), share[True]).otherwise(share[False]))
    # about toxic + clean pairs of an id and a flag
    rows = docs.join(F.broadcast(chosen), F.col(key) == F.col("_key")).select("_key", "toxic", F.col(text).alias("text")).collect()
    rows.sort(key=lambda r: (zlib.crc32(str(r["_key"]).encode()), str(r["_key"]), r["text"] or ""))
    true_share = sizes.get(True, 0) / max(1, sum(sizes.values()))
    return [r["text"] for r in rows], np.array([r["toxic"] for r in rows], dtype=bool), true_share


def score(docs: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(shared.value.score(part.column("text")))], names=["key", "score"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(rate, f"key {rows.schema['key'].dataType.simpleString()}, score double").withColumnRenamed("key", key)


def train_and_score(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """``key, held_out, score, predicted``: a model from the labels outside the held-out fifth, applied to all documents."""
    learn = labels.filter(_part(F.col(key)) % 5 != 0)
    model = train(*sample(docs, learn, key=key, text=text, label=label))
    return score(docs, model, key=key, text=text).select(
        key,
        F.coalesce(_part(F.col(key)) % 5 == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )

"""Toxic documents: a support vector machine on a subsequence string kernel with Nystroem landmarks, over the windows of sentences.

A sentence ends at . ! ? or a line's end. Its windows are its words, the pairs of neighbouring words read as one, and both
without accents, so an insult may be cut by a space. The kernel counts common subsequences, whose gaps cost a decay, so it may
hold inserted characters; it is scaled to 1 for equal texts and taken, for each landmark, of the best beginning of a window, up to
twice as long as the landmark, that starts with the same character. A sentence scores as its best window, a document as its best sentence. Labels are of documents:
every sentence of a clean document is clean, and of a toxic one those that hold what tells toxic documents from others.
"""

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.llm.textnp import LOWER, PUNCT, SPACE, pieces, span_hashes, spans, utf8

#: Labelled documents that are trained on (the bound of the training sample).
SAMPLE = 3000
#: Length of the subsequences, decay for each character that one spans, bytes of a window that are compared at once.
ORDER, DECAY, LONG = 3, 0.8, 24
#: Power of the scaled kernel (a kernel too), which sets what is spelt alike apart from what is merely similar.
POWER = 3
#: A beginning of a window is compared with a landmark if it has this share of its different characters; the kernel counts as 0 otherwise.
LETTERS = 0.75
#: Where the threshold lies between what clean training documents score at most (but for a thousandth of them) and 1, the margin of toxic sentences.
THRESHOLD = 0.15
#: Kernel value with a toxic landmark from which windows of clean documents are landmarks too, the most frequent first, as many as toxic ones.
HARD = 0.3
#: Weight of a document's window on the wrong side of the margin.
COST = 10.0
#: Kernel value from which clean documents' neighbouring words, or words without accents, spell a landmark.
SPELT = 0.5
#: Log-likelihood ratio from which a word or its beginning is held to tell toxic documents, and bytes of such a beginning.
SURE, STEM = 24.0, (4, 12)
#: Toxic documents for each clean one that have such a word, more than this.
RATE = 15

_ENDS = np.zeros(256, bool)
_ENDS[[10, 13, 33, 46, 63]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_SPOKEN = np.arange(256, dtype=np.uint8)
_SPOKEN[[ord(c) for c in "013457@"]] = [ord(c) for c in "oieasta"]
#: The plain letter of the second byte of U+00C0 to U+00FF.
_PLAIN = np.arange(256, dtype=np.uint8)
for _from, _to in zip(range(0x80, 0xC0), "aaaaaaaceeeeiiiidnooooo*ouuuuytsaaaaaaaceeeeiiiidnooooo/ouuuuyty"):
    _PLAIN[_from] = ord(_to)


@dataclass
class Windows:
    """Windows of texts: bytes, each window's start and end in them, its row, and its sentence's number (over all rows)."""

    low: np.ndarray
    s: np.ndarray
    e: np.ndarray
    row: np.ndarray
    sentence: np.ndarray
    mask: np.ndarray
    kind: np.ndarray  # 0 a word, 1 two words, 2 without accents


def masks(low: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """The characters of each of the spans, which follow each other without a gap, as bits (some characters share one)."""
    if not len(s):
        return np.zeros(0, np.uint64)
    return np.bitwise_or.reduceat(np.uint64(1) << (low & 63).astype(np.uint64), s)


def windows(data: np.ndarray, offs: np.ndarray) -> Windows:
    """White space separates words; ASCII punctuation is dropped, digits beside letters are read as the letters they look like,
    and single characters that follow each other are one word, so "i.d.i" and "1 d i" are "idi"."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return Windows(data, z, z, z, z, np.zeros(0, np.uint64), z)
    letter = _LETTER[data]
    beside = np.zeros(n, bool)
    beside[1:] = letter[:-1]
    beside[:-1] |= letter[1:]
    data = np.where(beside, _SPOKEN[data], data)
    row = np.repeat(np.arange(len(offs) - 1, dtype=np.int32), np.diff(offs))
    # a sentence's end counts where white space or the text's end follows, so that dots within a word are no ends
    after = np.ones(n, bool)
    after[:-1] = SPACE[data[1:]] | (row[1:] != row[:-1])
    sentence = np.cumsum(_ENDS[data] & (after | (data == 10)))
    keep = SPACE[data] | ~PUNCT[data]
    low, row, sentence = LOWER[data[keep]], row[keep], sentence[keep]
    at = np.concatenate(([0], np.cumsum(keep)))[offs]
    s, e, _ = spans(low, at, SPACE)
    if not len(s):
        return Windows(low, s, s, s, s, np.zeros(0, np.uint64), s)
    row, sentence = row[s].astype(np.int64), sentence[s]
    solid = ~SPACE[low]
    place = np.concatenate(([0], np.cumsum(solid)))
    low, s, e = low[solid], place[s], place[e]
    single = e - s == 1
    joins = np.flatnonzero(single[1:] & single[:-1] & (row[1:] == row[:-1])) + 1
    first = np.ones(len(s), bool)
    first[joins] = False
    begin = np.flatnonzero(first)
    s, e, row, sentence = s[begin], np.append(s[begin[1:]], e[-1]), row[begin], sentence[begin]
    sentence = sentence + row  # rows are sentences of their own
    # two neighbours of a sentence
    pair = np.flatnonzero((row[1:] == row[:-1]) & (sentence[1:] == sentence[:-1]) & (e[1:] - s[:-1] <= LONG))
    mask = masks(low, s, e)
    # words with accents once more without
    lead = (low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] < 0xC0)
    lead = np.append(lead, False)
    plain = low.copy()
    plain[1:][lead[:-1]] = _PLAIN[low[1:][lead[:-1]]]
    place = np.concatenate(([0], np.cumsum(~lead)))
    plain, ps, pe = plain[~lead], place[s], place[e]
    other = np.flatnonzero(pe - ps < e - s)
    base = len(low)
    pm = masks(plain, ps, pe)
    return Windows(np.concatenate([low, plain]), np.concatenate([s, s[pair], ps[other] + base]), np.concatenate([e, e[pair + 1], pe[other] + base]),
                   np.concatenate([row, row[pair], row[other]]), np.concatenate([sentence, sentence[pair], sentence[other]]), np.concatenate([mask, mask[pair] | mask[pair + 1], pm[other]]), np.repeat([0, 1, 2], [len(s), len(pair), len(other)]))


def table(items: list[bytes], fill: int, width: int = 1) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(x) for x in items], np.int64)
    out = np.full((len(items), max(int(size.max(initial=0)), width)), fill, np.uint8)
    for i, x in enumerate(items):
        out[i, : len(x)] = np.frombuffer(x, np.uint8)
    return out, size


def string_kernel(text: np.ndarray, size: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Of each pair of rows of bytes: the sum over common subsequences of ORDER bytes of DECAY to the power of the bytes both span.

    Texts are filled up by 0 behind their size, marks by 255; the dynamic program runs over all pairs at once.
    """
    n, width = marks.shape
    order = np.argsort(-size, kind="stable")
    text, size, marks = text[order], size[order], np.ascontiguousarray(marks[order].T)
    decay = np.float32(DECAY)
    step = np.arange(width)
    # what place j' of the mark adds to the places from j on
    spread = np.where(step[:, None] >= step, decay ** (step[:, None] - step), 0).astype(np.float32) * (decay * decay)
    out = np.zeros(n, np.float32)
    inner = [np.ones((width + 1, n), np.float32)] + [np.zeros((width + 1, n), np.float32) for _ in range(ORDER - 1)]
    for x in range(int(size.max(initial=0))):
        k = int(np.searchsorted(-size, -x, "left"))  # texts longer than x
        same = (marks[:, :k] == text[:k, x]).astype(np.float32)
        out[:k] += (decay * decay) * (same * inner[ORDER - 1][:-1, :k]).sum(0)
        for i in range(ORDER - 1, 0, -1):
            inner[i][:, :k] *= decay
            inner[i][1:, :k] += spread @ (same * inner[i - 1][:-1, :k])
    back = np.empty_like(out)
    back[order] = out
    return back


class Kernel:
    """Scores of windows; each different window is computed once, until MOST are known."""

    MOST = 1_000_000

    def __init__(self, marks: list[bytes], weights: np.ndarray | None = None, bias: float = 0.0, allow: np.ndarray | None = None):
        self.weights, self.bias, self.allow = weights, np.float32(bias), allow
        self.marks, self.length = table(marks, 255)
        self.self_ = np.maximum(string_kernel(np.where(self.marks == 255, 0, self.marks), self.length, self.marks), 1e-30)
        own = np.zeros(len(marks), np.uint64)
        for i, x in enumerate(marks):
            own[i] = np.bitwise_or.reduce(np.uint64(1) << (np.frombuffer(x, np.uint8) & 63).astype(np.uint64))
        self.mask, self.least = own, np.ceil(LETTERS * np.bitwise_count(own)).astype(np.uint8)
        self.known: dict[int, float] = {}

    def like(self, w: Windows) -> np.ndarray:
        """The windows that start as some landmark does and have enough of its characters."""
        out = np.zeros(len(w.s), bool)
        first = w.low[w.s]
        for c in np.unique(self.marks[:, 0]):
            own = np.flatnonzero(first == c)
            mask, hit = w.mask[own], np.zeros(len(own), bool)
            for j in np.flatnonzero(self.marks[:, 0] == c):
                hit |= np.bitwise_count(mask & self.mask[j]) >= self.least[j]
            out[own] = hit
        return np.flatnonzero(out)

    def rows(self, low: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """The highest scaled kernel of the beginnings of each window with each landmark. Beginnings have at most LONG bytes."""
        size = np.minimum(e - s, LONG)
        wide = np.arange(LONG)
        text = np.where(wide < size[:, None], low[np.minimum(s[:, None] + wide, max(len(low) - 1, 0))], 0).astype(np.uint8)
        # the characters of each beginning
        mask = np.bitwise_or.accumulate(np.where(text > 0, np.uint64(1) << (text & 63).astype(np.uint64), np.uint64(0)), axis=1)
        out = np.zeros((len(text), len(self.marks)), np.float32)
        own = {}
        for j, m in enumerate(self.length.tolist()):
            row = np.flatnonzero((text[:, 0] == self.marks[j, 0]) & (np.bitwise_count(mask[:, -1] & self.mask[j]) >= self.least[j]))
            for most in sorted({m, m + 2, min(2 * m - 1, LONG)}):
                z = np.minimum(most, size[row])
                ok = (z >= ORDER) & ((z == most) | (most == m)) & (np.bitwise_count(mask[row, z - 1] & self.mask[j]) >= self.least[j])
                for i in np.array_split(row[ok], -(-int(ok.sum()) // 16384) or 1):
                    n = np.minimum(most, size[i])
                    t = np.where(np.arange(most) < n[:, None], text[i, :most], 0)
                    k = string_kernel(t, n, np.broadcast_to(self.marks[j, :m], (len(t), m)))
                    if most not in own:
                        own[most] = np.full(len(text), np.nan, np.float32)
                    new = np.isnan(own[most][i])
                    own[most][i[new]] = string_kernel(t[new], n[new], np.where(t[new] == 0, 255, t[new]))
                    k /= np.sqrt(np.maximum(own[most][i], 1e-30) * self.self_[j])
                    out[i, j] = np.maximum(out[i, j], k**POWER)
        return out

    def scores(self, w: Windows) -> np.ndarray:
        """Score of each window; a window unlike all landmarks has the bias."""
        out = np.full(len(w.s), self.bias, np.float32)
        i = self.like(w)
        if not len(i):
            return out
        h, first, index = np.unique(names(w)[i], return_index=True, return_inverse=True)
        if len(self.known) > self.MOST:
            self.known = {}
        value = np.array([self.known.get(x, np.nan) for x in h.tolist()], np.float32)
        new = np.flatnonzero(np.isnan(value))
        if len(new):
            j = i[first[new]]
            got = (self.rows(w.low, w.s[j], w.e[j]) * self.allow[w.kind[j]]) @ self.weights + self.bias
            value[new] = got
            self.known.update(zip(h[new].tolist(), got.tolist()))
        out[i] = value[index]
        return out


def names(w: Windows) -> np.ndarray:
    """A hash of each window and its kind."""
    return span_hashes(w.low, w.s, w.e) + w.kind.astype(np.uint64)


@dataclass
class Model:
    """Score of a window: weights times its kernel values with the landmarks, plus bias; a sentence is toxic if a window of it is above 0.

    `allow` says by kind of window which landmarks count: one that two neighbouring words of clean documents spell counts for words alone.
    """

    marks: list[bytes]
    weights: np.ndarray
    bias: float
    allow: np.ndarray


def svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Weights of a linear soft-margin machine with squared loss (the last for a constant feature), by Newton's method on its primal."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    w = np.zeros(x.shape[1])

    def loss(w: np.ndarray) -> float:
        return w @ w / 2 + (cost * np.maximum(0, 1 - y * (x @ w)) ** 2).sum()

    for _ in range(rounds):
        short = 1 - y * (x @ w)
        own = short > 0
        xo, co = x[own], cost[own]
        slope = w - 2 * xo.T @ (co * y[own] * short[own])
        step = np.linalg.solve(np.eye(len(w)) + 2 * ((xo * co[:, None].astype(xo.dtype)).T @ xo).astype(np.float64), slope)
        rate, now = 1.0, loss(w)
        while rate > 1e-6 and loss(w - rate * step) > now:
            rate /= 2
        w = w - rate * step
        if np.abs(slope).max() < 1e-6 * max(1.0, now):
            break
    return w


def likelihood(bad: np.ndarray, good: np.ndarray, a: float, b: float) -> np.ndarray:
    """Signed log-likelihood ratio of a word's share among a toxic documents against that among b others."""
    every, part = bad + good, a / (a + b)
    term = lambda n, expected: n * np.log(np.maximum(n, 1e-9) / np.maximum(expected, 1e-9))
    z = term(bad, every * part) + term(good, every * (1 - part)) + term(a - bad, (a + b - every) * part + 1e-9) + term(b - good, (a + b - every) * (1 - part) + 1e-9)
    return 2 * z * np.sign(bad / a - good / b)


@dataclass
class Seen:
    """Different windows of some texts: bytes, start and end of each, its kind; and the pairs of a window and a text that has it."""

    low: np.ndarray
    s: np.ndarray
    e: np.ndarray
    kind: np.ndarray
    window: np.ndarray
    doc: np.ndarray


def seen(texts: list[str], pick) -> Seen:
    """The windows that pick() chooses of each block of about a megabyte of texts, so that only different ones are held at once."""
    known: dict[int, int] = {}
    raw, kinds, window, doc, at = [], [], [], [], 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size < 1 << 20):
            size += len(texts[to])
            to += 1
        w = windows(*utf8(pa.array(texts[at:to], pa.string())))
        i = pick(w)
        h, first, index = np.unique(names(w)[i], return_index=True, return_inverse=True)
        own = np.zeros(len(h), np.int64)
        for n, (x, j) in enumerate(zip(h.tolist(), i[first].tolist())):
            if x not in known:
                known[x] = len(raw)
                raw.append(w.low[w.s[j] : w.e[j]].tobytes())
                kinds.append(w.kind[j])
            own[n] = known[x]
        pair = np.unique(own[index] * (to - at) + w.row[i])
        window.append((pair // (to - at)).astype(np.int32))
        doc.append((pair % (to - at) + at).astype(np.int32))
        at = to
    ends = np.cumsum([0] + [len(x) for x in raw])
    return Seen(np.frombuffer(b"".join(raw), np.uint8), ends[:-1], ends[1:], np.array(kinds, np.int64), np.concatenate(window or [[]]).astype(np.int64), np.concatenate(doc or [[]]).astype(np.int64))


def telling(w: Seen, toxic: np.ndarray) -> list[bytes]:
    """Words and beginnings of words that tell toxic documents: the sure ones among all toxic documents, then, one after another, the
    surest among the toxic documents that have none of those before.

    Sure is a log-likelihood ratio of at least SURE where more than RATE times as many toxic as clean documents have the word;
    there is no other limit to their number. Near copies count once. A beginning stands for the longer ones.
    """
    if not len(w.s):
        return []
    # near copies of a document share their long words, mostly also the two with the smallest hashes: one of them counts (one hash
    # alone could be that of an insult, which other documents have too)
    h = span_hashes(w.low, w.s, w.e)
    long = np.flatnonzero((w.e - w.s)[w.window] >= 9)
    long = long[np.lexsort((h[w.window[long]], w.doc[long]))]
    nth = np.arange(len(long)) - np.searchsorted(w.doc[long], w.doc[long])
    name = np.zeros(len(toxic), np.uint64)
    pick = long[nth < 2]
    np.add.at(name, w.doc[pick], h[w.window[pick]])
    once = np.bincount(w.doc[pick], minlength=len(toxic)) < 2
    once[np.unique(name, return_index=True)[1]] = True
    count = once[w.doc]
    window, doc = w.window[count], w.doc[count]
    open_ = (toxic > 0) & once
    b = float((once & (toxic == 0)).sum())
    found: list[tuple[np.ndarray, ...]] = []
    base = 0
    for size in [*range(STEM[0], STEM[1] + 1), 0]:
        length = w.e - w.s
        own = np.flatnonzero((length > STEM[1]) & (length <= LONG) if not size else length >= size)
        end = w.e[own] if not size else w.s[own] + size
        whole = (end == w.e[own]) | (w.low[np.minimum(end, len(w.low) - 1)] & 0xC0 != 0x80)  # no character is cut
        own, end = own[whole], end[whole]
        x, first, index = np.unique(span_hashes(w.low, w.s[own], end), return_index=True, return_inverse=True)
        of = np.full(len(w.s), -1, np.int64)
        of[own] = index
        stem = of[window]
        pair = np.unique(stem[stem >= 0] * len(toxic) + doc[stem >= 0])
        stem, text = pair // len(toxic), pair % len(toxic)
        bad = np.bincount(stem, toxic[text] > 0, len(x))
        good = np.bincount(stem, toxic[text] == 0, len(x))
        keep = np.flatnonzero((bad >= 3) & (bad > RATE * good))
        new = np.full(len(x), -1, np.int64)
        new[keep] = base + np.arange(len(keep))
        hit = (new[stem] >= 0) & (toxic[text] > 0)
        found.append((x[keep], good[keep], w.s[own][first[keep]], end[first[keep]], new[stem[hit]], text[hit]))
        base += len(keep)
    h, good, s, e = (np.concatenate([x[i] for x in found]) for i in range(4))
    stem, doc = (np.concatenate([x[i] for x in found]) for i in (4, 5))
    name = lambda i: w.low[s[i] : e[i]].tobytes()
    size, out = e - s, []

    def surest(bad: np.ndarray, a: float) -> tuple[np.ndarray, np.ndarray]:
        """Stems that are sure, the surest first; of equal ones the longest, which all forms share."""
        cand = np.flatnonzero((bad >= 3) & (bad > RATE * good))
        z = likelihood(bad[cand], good[cand], a, b)
        cand, z = cand[z >= SURE], z[z >= SURE]
        order = np.lexsort((h[cand], -size[cand], -np.round(z, 6)))
        return cand[order], z[order]

    def whole(i: int, cand: np.ndarray, z: np.ndarray) -> bytes:
        """The longest stem that begins so and is nearly as sure: the word itself rather than what it shares with its misspellings."""
        x, least = name(i), 0.6 * z[cand == i][0]
        return max((y for y in (name(c) for c in cand[z >= least]) if y.startswith(x)), key=len)

    cand, z = surest(np.bincount(stem, minlength=len(h)), float(open_.sum()))
    for i in cand:
        if not any(m in name(i) or m.startswith(name(i)) for m in out):
            out.append(whole(i, cand, z))
    known = np.array([i for i in range(len(h)) if any(name(i).startswith(m) for m in out)], np.int64)
    open_[doc[np.isin(stem, known)]] = False
    while open_.any():
        cand, z = surest(np.bincount(stem, open_[doc], len(h)), float(open_.sum()))
        if not len(cand):
            break
        out.append(whole(cand[0], cand, z))
        open_[doc[stem == cand[0]]] = False
    return list(dict.fromkeys(out))


def disguises(mark: bytes) -> list[bytes]:
    """A landmark with one or two other letters put in, and with one between all of its characters."""
    out = [mark]
    for i in range(1, len(mark)):
        out += [mark[:i] + c + mark[i:] for c in (b"x", b"q")]
        out += [mark[:i] + b"x" + mark[i:j] + b"q" + mark[j:] for j in range(i + 1, len(mark))]
    return out + [b"x".join(mark[i : i + 1] for i in range(len(mark)))]


def fit(texts: list[str], toxic: np.ndarray) -> Model:
    """A model from labelled documents; one that finds nothing if a class is missing or nothing tells them apart.

    Landmarks are what telling() finds, and as many windows of clean documents that are most like them. Windows of toxic documents that hold a landmark, and disguised landmarks, are the toxic
    examples, all windows of clean documents the others.
    """
    toxic = np.asarray(toxic, np.int64)
    none = Model([], np.zeros(0, np.float32), -1.0, np.ones((3, 0), bool))
    if not toxic.any() or toxic.all():
        return none
    marks = telling(seen(texts, lambda w: np.flatnonzero((w.kind == 0) & (w.e - w.s >= STEM[0]))), toxic)
    if not marks:
        return none

    def compared(kernel: Kernel) -> tuple[Seen, np.ndarray, np.ndarray, np.ndarray]:
        """The windows that are like some landmark, their rows, and how many toxic and clean documents have each."""
        w = seen(texts, kernel.like)
        hit = toxic[w.doc] > 0
        return w, kernel.rows(w.low, w.s, w.e), np.bincount(w.window, hit, len(w.s)), np.bincount(w.window, ~hit, len(w.s))

    kernel = Kernel(marks)
    w, rows, bad, good = compared(kernel)
    allow = np.ones((3, len(marks)), bool)
    for i in (1, 2):
        allow[i] = rows[(good > 0) & (w.kind == i)].max(0, initial=0) < SPELT
    close = (rows * allow[w.kind]).max(1, initial=0)
    hard = np.flatnonzero((good > 0) & (close >= HARD) & (bad <= RATE * good))
    hard = hard[np.lexsort((hard, -close[hard] * good[hard]))][: len(marks)]
    toxics = len(marks)
    hard = [w.low[w.s[i] : min(w.e[i], w.s[i] + LONG)].tobytes() for i in hard]
    marks = marks + [x for x in dict.fromkeys(hard) if x not in marks]
    kernel = Kernel(marks)
    w, rows, bad, good = compared(kernel)
    clean = good > 0
    allow = np.hstack([allow, np.ones((3, len(marks) - toxics), bool)])
    rows *= allow[w.kind]
    width = max(len(x) for x in marks)
    gram = np.stack([string_kernel(np.repeat(table([x], 0, width)[0], len(marks), 0), np.full(len(marks), len(x)), kernel.marks) for x in marks])
    gram = (gram / np.sqrt(kernel.self_[:, None] * kernel.self_)) ** POWER
    value, vector = np.linalg.eigh((gram + gram.T).astype(np.float64) / 2)
    whiten = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-2))) @ vector.T
    witness = (rows[:, :toxics].max(1, initial=0) >= 0.999) & (bad > RATE * good)
    clean &= ~witness
    made, size = table([x for m in marks[:toxics] for x in disguises(m)], 0, LONG)
    at = np.arange(len(made)) * made.shape[1]
    forms = kernel.rows(made.ravel(), at, at + np.minimum(size, LONG))
    x = np.concatenate([rows[witness], forms, rows[clean], np.zeros((1, len(marks)), np.float32)])
    y = np.concatenate([np.ones(witness.sum() + len(forms)), -np.ones(clean.sum() + 1)])
    # a window counts as often as documents have it
    cost = COST * np.concatenate([bad[witness], np.ones(len(forms)), good[clean], [1.0]])
    v = svm((x @ whiten).astype(np.float32), y, cost)
    weights, bias = (whiten @ v[:-1]).astype(np.float32), float(v[-1])
    # the threshold lies above what all but a thousandth of the clean documents reach, but not above half of what nearly all toxic ones that are found reach
    score = np.full(len(toxic), bias)
    np.maximum.at(score, w.doc, (rows @ weights + bias)[w.window])
    best = np.sort(score[toxic == 0])
    most = float(best[-1 - len(best) // 1000]) if len(best) else 0.0
    found = score[(toxic > 0) & (score > 1)]
    limit = max(1.0, float(np.quantile(found, 0.05)) / 2) if len(found) else 1.0
    return Model(marks, weights, bias - min(most + THRESHOLD * max(1 - most, 0.2), limit), allow)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """fit() on at most ``sample`` labelled documents, those first by md5 of the key. Rows without key, label or text don't count."""
    known = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).where("k is not null and y is not null").groupBy("k").agg(F.max("y").alias("y"))
    first = known.withColumn("m", F.md5(F.col("k").cast("string"))).orderBy("m", "k").limit(sample).select("k", "y")
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).where("t is not null").join(F.broadcast(first), "k").orderBy("k", "t").toLocalIterator()
    # copies of a text count once, as toxic if one of them is
    known = {}
    for r in rows:
        known[r["t"]] = max(r["y"], known.get(r["t"], 0))
    texts, toxic = list(known), [y > 0 for y in known.values()]
    return fit(texts, np.array(toxic, np.int64))


def toxic_documents(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of each document whose highest-scored sentence is above 0.

    Whole texts are scored. Null and empty texts are not toxic; rows that repeat each give a row; a null key stays.
    """
    marks, weights, bias, allow = model.marks, model.weights, model.bias, model.allow

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = Kernel(marks, weights, bias, allow) if marks else None
        for batch in batches:
            for part in pieces(batch, text, 1 << 20):
                score = np.full(part.num_rows, -np.inf)
                w = windows(*utf8(part.column(1)))
                if kernel and len(w.s):
                    np.maximum.at(score, w.row, kernel.scores(w))
                hit = np.flatnonzero(score > 0)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(hit)), pa.array(score[hit])], ["key", "score"])

    return docs.select(key, text).mapInArrow(run, f"key {docs.schema[key].dataType.simpleString()}, score double").withColumnRenamed("key", key)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return toxic_documents(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


register_pickle_by_value(sys.modules[__name__])

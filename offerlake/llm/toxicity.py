"""Toxicity by a subsequence string-kernel support vector machine with Nystroem landmarks.

Kernel.  Two words are compared by their common subsequences of three letters, each
occurrence weighted by ``DECAY`` per letter it skips (at most ``SPAN`` letters wide), scaled
by word length and cubed.  Cubing leaves a word with foreign letters in it too little of that, so
a word (of one piece) that holds a marked landmark, with at most two foreign letters in a row
and fewer foreign letters than its own, is read as that landmark at ``GAP`` per foreign letter,
unless it is at least as frequent in clean training documents.  Words are cut at white space with punctuation dropped
("id-iot", "i.d.i.o.t"), accents and common digit substitutions folded, and runs of three or
more single letters joined ("i d i o t"); words longer than ``PIECE`` letters are read in
overlapping pieces and count by their best piece.  A sentence (at most ``SENTENCE`` words) is
the sum of its words in kernel space.

Model.  Landmark words are those that set toxic and clean training documents apart most,
plus frequent background words.  Nystroem features ``K_mm^-1/2 k_m(sentence)`` feed a linear
squared-hinge SVM.  A labelled document is a bag of sentences: clean documents label all
theirs, a toxic one is represented by its most toxic sentence, chosen anew in each round,
and by those that hold a marked word; toxic labels whose best sentence looks clean are set aside as noise.  A document scores by
its most toxic sentence, calibrated to a probability.

The model is fitted on a bounded sample (``max_labelled`` rows, hash order; texts up to
``max_text_bytes``) and broadcast (a few hundred KB); scoring reads every whole text once,
without a shuffle, and evaluates the kernel once per distinct word of a chunk.

Defined cases: NULL and empty texts score as a document without words; without labels of
both kinds, or words that tell them apart, everything scores 0; several labels of an id count as toxic if one is; repeated
rows score alike; an empty table gives an empty result; other columns are ignored
(:func:`drop_toxic` keeps them).
"""

from __future__ import annotations

import pickle
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlake.llm.common import id_remainder, map_batches, pick, prepare
from offerlake.llm.textnp import _power, mix

PIECE = 32
SENTENCE = 6
SPAN = 6
DECAY = 0.5
POWER = 3
CHUNK_CHARS = 1 << 19
#: Characters at once in training, which runs in one task.
FIT_CHARS = 1 << 18
LETTERS = 64
CACHE_PIECES = 1 << 21
GAP = 0.985  # per letter inserted into a marked word
SHORT = 5  # a marked word of fewer letters may hold one inserted letter only
NEAR = 0.9  # kernel value from which a word counts as the landmark itself
_START = 63  # marks the beginning of a word
MAX_LABELLED = 4000
MAX_TEXT_BYTES = 32 << 10
_SPACE = 255
#: Digits read as the letters they stand in for.
DIGIT_LETTERS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t"}


@lru_cache(1)
def _classes() -> np.ndarray:
    """Letter class per code point: 1-26 a-z, 27-62 other letters and digits, 255 white
    space, 0 dropped."""
    out = np.zeros(0x20000, np.uint8)
    for cp in range(len(out)):
        ch = chr(cp)
        if ch.isspace():
            out[cp] = _SPACE
        elif ch in DIGIT_LETTERS:
            out[cp] = ord(DIGIT_LETTERS[ch]) - 96
        elif "a" <= ch <= "z":
            out[cp] = ord(ch) - 96
        elif ch.isalnum():
            # Accented letters keep classes of their own; styled forms fold to plain ones.
            plain = unicodedata.normalize("NFKC", ch).lower()[0]
            out[cp] = ord(plain) - 96 if "a" <= plain <= "z" else 27 + cp % 36
    return out


class Pieces:
    """Words of some texts as letter classes: pieces (``start``, ``size``, ``hash``) with
    their word, words with their window, windows with their text."""

    def __init__(self, texts: list[str]):
        raw = ("\n".join(texts) + "\n").lower() if texts else ""
        # Lower-casing may change lengths, so rows are found by the joining line feeds only
        # if no text holds one; otherwise they are measured.
        sizes = np.array([len(t.lower()) + 1 for t in texts], np.int64)
        codes = np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), np.uint32)
        begin = np.append(0, np.cumsum(sizes))
        table = _classes()
        kind = np.where(codes < len(table), table[np.minimum(codes, len(table) - 1)], 0).astype(np.uint8)
        space = kind == _SPACE
        stop = (codes == 10)
        end_mark = (codes == 46) | (codes == 33) | (codes == 63)
        stop[:-1] |= end_mark[:-1] & space[1:]
        at = np.flatnonzero(kind)
        letter = kind[at] != _SPACE
        first = letter.copy()
        first[1:] &= ~letter[:-1]
        self.letters = kind[at][letter]
        origin = at[letter]
        start = np.flatnonzero(first[letter])
        size = np.diff(np.append(start, len(self.letters)))
        text = np.searchsorted(begin, origin[start], "right") - 1
        # Join runs of three or more single letters inside one text.
        single = size == 1
        chained = single[1:] & single[:-1] & (text[1:] == text[:-1]) if len(start) else np.zeros(0, bool)
        run = np.concatenate([[False], chained, [False]])
        if chained.any():
            edge = np.flatnonzero(run[1:] != run[:-1])
            for a, b in zip(edge[::2], edge[1::2]):
                if b - a < 2:
                    run[a + 1:b + 1] = False
            keep = ~run[:-1]
            start, text = start[keep], text[keep]
            size = np.diff(np.append(start, len(self.letters)))
        sentence = np.cumsum(stop)[origin[start]]
        new = np.ones(len(start), bool)
        new[1:] = (sentence[1:] != sentence[:-1]) | (text[1:] != text[:-1])
        rank = np.arange(len(start)) - np.flatnonzero(new)[np.cumsum(new) - 1] if len(start) else np.zeros(0, np.int64)
        new |= rank % SENTENCE == 0
        self.word_window = np.cumsum(new) - 1
        self.window_text = text[new]
        self.letters = np.insert(self.letters, start, _START)
        start, size = start + np.arange(len(start)), size + 1
        n = np.maximum(-(-(size - PIECE) // (PIECE // 2)), 0) + 1
        self.word = np.repeat(np.arange(len(start)), n)
        nth = np.arange(len(self.word)) - np.repeat(np.cumsum(n) - n, n)
        self.start = start[self.word] + nth * (PIECE // 2)
        self.size = np.minimum(size[self.word] - nth * (PIECE // 2), PIECE)
        power, inverse = _power(len(self.letters) + 1)
        total = np.append(np.uint64(0), np.cumsum(mix(self.letters.astype(np.uint64), 31) * power[:-1], dtype=np.uint64))
        self.hash = mix((total[self.start + self.size] - total[self.start]) * inverse[self.start])

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """Index of one piece per distinct string, and each piece's place in that list."""
        _, at, back = np.unique(self.hash, return_index=True, return_inverse=True)
        return at, back

    def spell(self, i: int) -> tuple[int, ...]:
        return tuple(self.letters[self.start[i]:self.start[i] + self.size[i]].tolist())


@lru_cache(PIECE + 1)
def _triples(n: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Positions and weights of the subsequences of a word of ``n`` letters, and its scale."""
    at = [c for c in combinations(range(n), 3) if c[2] - c[0] < SPAN]
    weight = np.array([DECAY ** (c[2] - c[0] - 2) for c in at])
    return np.array(at, np.int64).reshape(-1, 3), weight, 1.0 / np.sqrt(max((weight ** 2).sum(), 1e-9))


@dataclass
class Landmarks:
    """Landmark words as a sparse table: subsequence -> (landmark, weight)."""
    first: np.ndarray
    owner: np.ndarray
    weight: np.ndarray
    n: int
    marked: list[tuple[int, ...]] = field(default_factory=list)  # the first landmarks, which may be disguised
    own: np.ndarray | None = None  # kernel of each marked landmark with each landmark
    clean: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # hashes of words that hold one but are clean

    @staticmethod
    def of(spelled: list[tuple[int, ...]]) -> Landmarks:
        rows: dict[tuple[int, int], float] = {}
        for i, letters in enumerate(spelled):
            at, weight, scale = _triples(len(letters))
            for (a, b, c), w in zip(at.tolist(), weight):
                key = ((letters[a] * LETTERS + letters[b]) * LETTERS + letters[c], i)
                rows[key] = rows.get(key, 0.0) + w * scale
        keys = sorted(rows)
        ids = np.array([k[0] for k in keys], np.int64)
        return Landmarks(np.searchsorted(ids, np.arange(LETTERS ** 3 + 1)), np.array([k[1] for k in keys], np.int64),
                         np.array([rows[k] for k in keys]), len(spelled))

    def similar(self, letters: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Kernel of each word (a slice of ``letters``) with each landmark."""
        out = np.zeros((len(start), self.n), np.float32)
        for n in range(3, PIECE + 1):
            which = np.flatnonzero(size == n)
            at, weight, scale = _triples(n)
            for a in range(0, len(which), 4_000):
                w = which[a:a + 4_000]
                m = letters[start[w][:, None] + np.arange(n)].astype(np.int64)
                ids = (m[:, at[:, 0]] * LETTERS + m[:, at[:, 1]]) * LETTERS + m[:, at[:, 2]]
                count = self.first[ids + 1] - self.first[ids]
                row, col = np.nonzero(count)
                k, ids = count[row, col], ids[row, col]
                entry = np.repeat(self.first[ids] - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))
                cell = np.repeat(row, k) * self.n + self.owner[entry]
                out[w] = (scale * np.bincount(cell, np.repeat(weight[col], k) * self.weight[entry],
                                              minlength=len(w) * self.n).reshape(len(w), self.n)) ** POWER
        return out

    def disguised(self, letters: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each word, the marked landmark that it holds with the fewest inserted letters
        (-1: none, or the landmark itself), and their number."""
        which, least = np.full(len(start), -1), np.full(len(start), PIECE)
        for a in range(0, len(start), 20_000):
            s, n = start[a:a + 20_000], size[a:a + 20_000]
            m = letters[np.minimum(s[:, None] + np.arange(PIECE), len(letters) - 1)]
            m = np.where((np.arange(PIECE) < n[:, None]) & (m[:, :1] == _START), m, 0)
            # Bit p of places[c]: letter c stands at place p (place 0 is the start mark).
            places = {c: (m == c) @ (1 << np.arange(PIECE)) for c in {c for w in self.marked for c in w[1:]}}
            for i, word in enumerate(self.marked):
                most = len(word) - 2 if len(word) > SHORT else 1
                extra = n - len(word)
                at = np.flatnonzero((extra > 0) & (extra <= most) & (extra < least[a:a + 20_000]) & (places[word[1]] & 14 > 0))
                reach = places[word[1]][at] & 14
                for c in word[2:]:
                    reach = (reach << 1 | reach << 2 | reach << 3) & places[c][at]
                at = at[(reach >> np.maximum(n[at] - 3, 0)) > 0]  # at most two letters follow
                which[a + at], least[a + at] = i, extra[at]
        return which, least

    def read(self, p: Pieces, at: np.ndarray) -> np.ndarray:
        """Kernel of some pieces with each landmark; disguised marked words count as these."""
        out = self.similar(p.letters, p.start[at], p.size[at])
        if self.marked:
            which, inserted = self.disguised(p.letters, p.start[at], p.size[at])
            hit = np.flatnonzero((which >= 0) & ~np.isin(p.hash[at], self.clean))
            out[hit] = self.own[which[hit]] * (GAP ** inserted[hit])[:, None]
        return out


@dataclass
class Model:
    landmarks: Landmarks
    alpha: np.ndarray
    bias: float
    slope: float
    offset: float
    known: np.ndarray | None = None  # hashes of pieces already judged by this process, sorted
    worth: np.ndarray | None = None  # and their values; at most CACHE_PIECES of them

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": None, "worth": None}

    def values(self, p: Pieces) -> np.ndarray:
        """Margin contribution of each piece; the kernel is evaluated once per string."""
        at, back = p.distinct()
        keys, out = p.hash[at], np.zeros(len(at), np.float32)
        if self.known is None or len(self.known) > CACHE_PIECES:
            self.known, self.worth = np.zeros(0, np.uint64), np.zeros(0, np.float32)
        place = np.searchsorted(self.known, keys)
        hit = np.zeros(len(keys), bool)
        if len(self.known):
            hit = self.known[np.minimum(place, len(self.known) - 1)] == keys
            out[hit] = self.worth[place[hit]]
        new = np.flatnonzero(~hit)
        out[new] = self.landmarks.read(p, at[new]) @ self.alpha
        self.known = np.insert(self.known, place[new], keys[new])
        self.worth = np.insert(self.worth, place[new], out[new])
        return out[back]

    def margins(self, texts: list[str]) -> np.ndarray:
        """Margin of the most toxic sentence of each text."""
        p = Pieces(texts)
        out = np.full(len(texts), self.bias)
        if len(p.start):
            per_word = np.maximum.reduceat(self.values(p), np.flatnonzero(np.diff(p.word, prepend=-1)))
            per_window = np.bincount(p.word_window, per_word) + self.bias
            best = np.full(len(texts), -np.inf)
            np.maximum.at(best, p.window_text, per_window)
            out = np.where(np.isfinite(best), best, self.bias)
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * self.margins(texts) + self.offset, -40, 40)))


def _squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Weights (bias last) of a linear squared-hinge SVM, by Newton steps on the active set."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, reg = np.zeros(x.shape[1]), np.eye(x.shape[1]) * ridge
    reg[-1, -1] = 1e-6
    for _ in range(30):
        active = y * (x @ w) < 1
        xa = x[active] * weight[active, None]
        new = np.linalg.solve(reg + xa.T @ x[active], xa.T @ y[active])
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w


def _calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic curve through margins and labels (smoothed targets, Newton steps)."""
    pos, neg = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([np.clip(margin, -3, 3), np.ones(len(margin))], 1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (p - target) + 1e-3 * w)
        w -= np.clip(step, -2, 2)
    return max(float(w[0]), 0.0), float(w[1])


def _marks(piece: np.ndarray, doc: np.ndarray, y: np.ndarray, pos: np.ndarray, neg: np.ndarray, n: int) -> np.ndarray:
    """Words that set toxic documents apart, picked one by one so that documents already
    covered weigh less: every kind of insult gets its landmarks."""
    a, b = pos / (y > 0).sum(), neg / (y < 0).sum()
    purity = np.where(pos >= 3, (a - b) / np.maximum(a + b, 1e-12), 0.0)
    purity[purity < 0.8] = 0.0
    use = (y[doc] > 0) & (purity[piece] > 0)
    piece, doc = piece[use], doc[use]
    weight, out = np.ones(len(y)), []
    for _ in range(n):
        gain = np.bincount(piece, weight[doc], minlength=len(pos)) * purity
        gain[out] = 0.0
        best = int(gain.argmax()) if len(gain) else 0
        if not len(gain) or gain[best] <= 0:
            break
        out.append(best)
        weight[doc[piece == best]] *= 0.8
    return np.array(out, np.int64)


def _text_chunks(texts: list[str], limit: int = FIT_CHARS) -> Iterator[tuple[int, int]]:
    start = 0
    while start < len(texts):
        stop, size = start, 0
        while stop < len(texts) and (stop == start or size + len(texts[stop]) <= limit):
            size += len(texts[stop])
            stop += 1
        yield start, stop
        start = stop


def _choose_landmarks(texts: list[str], y: np.ndarray, n_marks: int, n_background: int) -> tuple[list[tuple], int, np.ndarray]:
    """Spelled landmark words, the marked ones first, how many are marked, and the (sorted)
    hashes of words that are at least as frequent in clean documents."""
    hashes, docs = [], []
    for a, b in _text_chunks(texts):
        p = Pieces(texts[a:b])
        at, back = p.distinct()
        pair = np.unique(back.astype(np.int64) * (b - a) + p.window_text[p.word_window[p.word]])
        which, doc = at[pair // (b - a)], pair % (b - a)
        long = p.size[which] > 3  # with the start mark: words of three letters or more
        hashes.append(p.hash[which[long]])
        docs.append(doc[long] + a)
    keys, piece = np.unique(np.concatenate(hashes), return_inverse=True)
    doc = np.concatenate(docs)
    pos = np.bincount(piece[y[doc] > 0], minlength=len(keys))
    neg = np.bincount(piece[y[doc] < 0], minlength=len(keys))
    marks = _marks(piece, doc, y, pos, neg, n_marks)
    common = np.argsort(-(pos + neg), kind="stable")
    wanted = keys[np.concatenate([marks, common[~np.isin(common, marks)][:n_background]])]
    spelled: dict[int, tuple] = {}
    for a, b in _text_chunks(texts):
        if len(spelled) == len(wanted):
            break
        p = Pieces(texts[a:b])
        for i in np.flatnonzero(np.isin(p.hash, wanted)):
            spelled.setdefault(int(p.hash[i]), p.spell(i))
    return [spelled[int(h)] for h in wanted], len(marks), keys[neg * (y > 0).sum() >= pos * (y < 0).sum()]


def _clean_lookalikes(texts: list[str], landmarks: Landmarks, plain: np.ndarray) -> np.ndarray:
    """Hashes of the words among ``plain`` that hold a marked landmark with letters inserted."""
    out = [np.zeros(0, np.uint64)]
    for a, b in _text_chunks(texts):
        p = Pieces(texts[a:b])
        at, _ = p.distinct()
        at = at[np.isin(p.hash[at], plain)]
        which, _ = landmarks.disguised(p.letters, p.start[at], p.size[at])
        out.append(p.hash[at[which >= 0]])
    return np.unique(np.concatenate(out))


def _sentences(texts: list[str], landmarks: Landmarks, n_marks: int, per_bag: int) -> tuple[np.ndarray, ...]:
    """Kernel rows of the ``per_bag`` sentences of each text nearest to a marked landmark
    (the others are easy), with their text and that nearness."""
    bags, rows, nears = [], [], []
    for a, b in _text_chunks(texts):
        p = Pieces(texts[a:b])
        if not len(p.start):
            continue
        at, back = p.distinct()
        alone = np.bincount(p.word)[p.word] == 1  # words of several pieces are left out of training
        out = np.zeros((len(p.window_text), landmarks.n), np.float32)
        order = np.argsort(back, kind="stable")
        first = np.searchsorted(back[order], np.arange(len(at) + 1))
        for lo in range(0, len(at), 20_000):
            hi = min(lo + 20_000, len(at))
            k = landmarks.read(p, at[lo:hi])
            use = order[first[lo]:first[hi]]
            use = use[alone[use]]
            some = k[back[use] - lo].any(axis=1)
            np.add.at(out, p.word_window[p.word[use[some]]], k[back[use[some]] - lo])
        near = out[:, :max(n_marks, 1)].max(axis=1)
        order = np.lexsort((-near, p.window_text))
        bag = p.window_text[order]
        order = order[np.arange(len(bag)) - np.searchsorted(bag, bag) < per_bag]
        bags.append(p.window_text[order] + a)
        rows.append(out[order])
        nears.append(near[order])
    return np.concatenate(bags), np.concatenate(rows), np.concatenate(nears)


def train(texts: list[str], toxic: list[int], n_marks: int = 128, n_background: int = 24, rounds: int = 6,
          per_bag: int = 8, ridge: float = 1.0) -> Model | None:
    """Fit on labelled documents; None unless both labels occur and words tell them apart."""
    y = np.where(np.array(toxic) > 0, 1, -1)
    if not len(y) or y.min() == y.max():
        return None
    spelled, n_marks, plain = _choose_landmarks(texts, y, n_marks, n_background)
    if not n_marks:
        return None
    landmarks = Landmarks.of(spelled)
    km = _kernel_of(landmarks, spelled)
    landmarks.marked, landmarks.own = spelled[:n_marks], km[:n_marks].astype(np.float32)
    landmarks.clean = _clean_lookalikes(texts, landmarks, plain)
    value, vector = np.linalg.eigh((km + km.T) / 2 + 1e-6 * np.eye(len(km)))
    root = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-6))) @ vector.T
    bag, rows, near = _sentences(texts, landmarks, n_marks, per_bag)
    x = rows.astype(np.float64) @ root
    score, w = near.astype(np.float64), None
    usable = np.ones(len(y), bool)
    for r in range(rounds):
        top = np.lexsort((-score, bag))
        witness = top[np.append(True, bag[top][1:] != bag[top][:-1])]
        witness = witness[(y[bag[witness]] > 0) & usable[bag[witness]]]
        # Sentences of toxic documents that hold a marked word stand for their words too.
        witness = np.union1d(witness, np.flatnonzero((y[bag] > 0) & (near >= NEAR)))
        rest = np.flatnonzero(y[bag] < 0)
        if not len(witness):
            return None
        use = np.concatenate([witness, rest])
        label = np.append(np.ones(len(witness)), -np.ones(len(rest)))
        balance = np.where(label > 0, max(1.0, 0.1 * len(rest) / len(witness)), 1.0)
        w = _squared_hinge(x[use], label, balance, ridge)
        score = x @ w[:-1] + w[-1]
        if r >= 1:
            best = np.full(len(y), -np.inf)
            np.maximum.at(best, bag, score)
            noisy = (y > 0) & (best < -0.25)
            if noisy.sum() < 0.9 * (y > 0).sum():
                usable = ~noisy
    model = Model(landmarks, (root @ w[:-1]).astype(np.float32), float(w[-1]), 1.0, 0.0)
    margin = np.concatenate([model.margins(texts[a:b]) for a, b in _text_chunks(texts)])
    model.slope, model.offset = _calibrate(margin, y)
    return model


def _kernel_of(landmarks: Landmarks, spelled: list[tuple[int, ...]]) -> np.ndarray:
    letters = np.array([c for s in spelled for c in s], np.uint8)
    size = np.array([len(s) for s in spelled], np.int64)
    return landmarks.similar(letters, np.cumsum(size) - size, size).astype(np.float64)


def score_texts(model: Model | None, texts: list[str | None]) -> np.ndarray:
    if model is None:
        return np.zeros(len(texts))
    whole = [t or "" for t in texts]
    parts = [model.scores(whole[a:b]) for a, b in _text_chunks(whole, CHUNK_CHARS)]
    return np.concatenate(parts) if parts else np.zeros(0)


def fit(docs: DataFrame, labels: DataFrame, spark: SparkSession, use: Column, max_labelled: int = MAX_LABELLED,
        max_text_bytes: int = MAX_TEXT_BYTES) -> Model | None:
    """Train on at most ``max_labelled`` labelled documents for whose id ``use`` holds: those
    first in hash order, with texts of at most ``max_text_bytes``."""
    marks = pick(labels, doc_id="bigint", toxic="int").where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(use)
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id") \
        .limit(max_labelled)
    rows = pick(docs, doc_id="bigint", text="string").where(F.octet_length("text") <= max_text_bytes)
    sample = rows.join(F.broadcast(marks), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text") \
        .limit(max_labelled).select("text", "toxic")
    fitted = map_batches(sample.coalesce(1), _trainer, "model binary").first()
    return pickle.loads(fitted["model"]) if fitted else None  # an empty sample has no task


def _trainer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bounded sample is fitted in one task: only the model itself reaches the driver."""
    texts, toxic = [], []
    for batch in batches:
        texts += batch.column("text").to_pylist()
        toxic += batch.column("toxic").to_pylist()
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(texts, toxic))], pa.binary())], ["model"])


def _scorer(model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = score_texts(model.value, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score, pa.float64())],
                                             ["doc_id", "score"])
    return run


def _keeper(model, at: int, threshold: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = score_texts(model.value, batch.column(at).cast(pa.string()).to_pylist())
            yield batch.filter(pa.array(score < threshold, pa.bool_()))
    return run


def toxicity(docs: DataFrame, labels: DataFrame, spark: SparkSession, threshold: float = 0.7,
             max_labelled: int = MAX_LABELLED) -> DataFrame:
    """doc_id, held_out, score, predicted; rows whose crc32(doc_id) mod 3 is 1 are held out
    of training."""
    prepare(spark)
    held = F.coalesce(id_remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    model = spark.sparkContext.broadcast(fit(docs, labels, spark, ~held, max_labelled))
    scored = map_batches(pick(docs, doc_id="bigint", text="string"), _scorer(model), "doc_id bigint, score double")
    return scored.select("doc_id", held.alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, spark: SparkSession, threshold: float = 0.7,
               max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``docs`` without the documents predicted toxic (same folds as :func:`toxicity`)."""
    prepare(spark)
    held = F.coalesce(id_remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    model = spark.sparkContext.broadcast(fit(docs, labels, spark, ~held, max_labelled))
    return map_batches(docs, _keeper(model, docs.columns.index("text"), threshold), docs.schema)

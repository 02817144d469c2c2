"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of learned lexicon entries (words, word
beginnings, word endings) that stand out in toxic labelled texts, second person
near such words, capitals, punctuation, repeated letters and obfuscated
spellings (letters replaced by digits or marks, letters set apart). A missing or
empty text has all features zero and is scored like any other.

Everything is learned from a bounded sample, at most ``SAMPLE_ROWS`` labelled
ids chosen by their hash. Half of it gives the lexicon, of the other half
two thirds train the trees and one third calibrates them; then the lexicon is
learned again from the whole sample. Without both kinds of labels every score
is the share of toxic rows (0 without rows).
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliar.llm._jobs import narrow

SAMPLE_ROWS = 12_000
THRESHOLD = 0.3
MIN_TEXTS = 3
MIN_ODDS = 8.0
BEGINNINGS = (4, 5, 6)
ENDINGS = (4, 5)
# Second person pronouns of the languages served.
SECOND_PERSON = frozenset("you your yours yourself u ur tu te ti vous votre vos toi du dich dir dein deine ihr euch usted ustedes vosotros su sus".split())
_UNMASK = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": None, "-": None, "_": None, ".": None, "'": None})
_EDGE = " \t\n\r\x0b\x0c.,;:!?\"'()[]{}<>|/\\*#$%&-_~`"
_APART = re.compile(r"(?:(?<=\s)|^)(?:\w[\s.\-_*]){2,}\w(?=\s|$)")
_LONG_RUN = re.compile(r"(\w)\1{2,}")
FEATURES = 15


@dataclass
class Lexicon:
    words: frozenset
    beginnings: frozenset
    endings: frozenset


def _tokens(text: str) -> list[str]:
    return [t for t in (x.strip(_EDGE) for x in text.lower().split()) if t]


def learn_lexicon(texts: list[str], toxic: np.ndarray) -> Lexicon:
    """Entries in at least MIN_TEXTS toxic texts whose odds of a toxic text are MIN_ODDS times the usual ones."""
    usual = toxic.sum() / max(len(toxic) - toxic.sum(), 1)

    def pick(parts) -> frozenset:
        counts = (Counter(), Counter())
        for text, label in zip(texts, toxic):
            counts[int(label)].update(parts(text))
        return frozenset(w for w, k in counts[1].items() if k >= MIN_TEXTS and (k + 0.1) / (counts[0][w] + 0.5) >= MIN_ODDS * usual)

    tokens = [set(_tokens(t)) for t in texts]
    texts = tokens
    return Lexicon(
        pick(lambda ws: ws),
        pick(lambda ws: {w[:k] for w in ws for k in BEGINNINGS if len(w) > k}),
        pick(lambda ws: {w[-k:] for w in ws for k in ENDINGS if len(w) > k}),
    )


class Featurizer:
    """Features of one text after another; what a word matches is remembered for words seen lately."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.memory: dict[str, tuple] = {}

    def _kind(self, raw: str) -> tuple:
        """(word, beginning, ending, unmasked, person, capitals, length) of a token as it stands."""
        lex = self.lexicon
        w = raw.lower().strip(_EDGE)
        word = w in lex.words
        begin = sum(len(w) > k and w[:k] in lex.beginnings for k in BEGINNINGS)
        end = sum(len(w) > k and w[-k:] in lex.endings for k in ENDINGS)
        clear = raw.lower().translate(_UNMASK).strip(_EDGE)
        masked = clear != w and clear in lex.words
        kind = (int(word), begin, end, int(masked), int(w in SECOND_PERSON), int(len(w) > 2 and raw.isupper()))
        if len(self.memory) > 400_000:
            self.memory.clear()
        self.memory[raw] = kind
        return kind

    def __call__(self, text: str | None) -> list[float]:
        text = text or ""
        get = self.memory.get
        kinds = [get(t) or self._kind(t) for t in text.split()]
        n = len(kinds)
        if not n:
            return [0.0] * FEATURES
        hits = [i for i, k in enumerate(kinds) if k[0] or k[3]]
        people = [i for i, k in enumerate(kinds) if k[4]]
        near = sum(any(abs(i - j) <= 5 for j in people) for i in hits) if people and hits else 0
        apart = sum(re.sub(r"\W", "", m.group()).lower() in self.lexicon.words for m in _APART.finditer(text)) if self.lexicon.words else 0
        words, begins, ends, masked = (sum(k[i] for k in kinds) for i in range(4))
        strong = sum(k[1] > 1 and k[2] > 0 for k in kinds)
        return [
            words / n, np.log1p(words), begins / n, np.log1p(begins), ends / n, np.log1p(strong), strong / n,
            masked / n, float(apart), near / n, len(people) / n, sum(k[5] for k in kinds) / n,
            (text.count("!") + text.count("?")) / n, len(_LONG_RUN.findall(text)) / n, np.log1p(n),
        ]


@dataclass
class Trees:
    base: float
    trees: list
    x: np.ndarray  # calibration: raw scores
    y: np.ndarray  # and the shares they stand for

    def raw(self, f: np.ndarray) -> np.ndarray:
        out = np.full(len(f), self.base)
        for feature, cut, left, right, value in self.trees:
            node = np.zeros(len(f), dtype=np.int64)
            for _ in range(8):
                inner = feature[node] >= 0
                if not inner.any():
                    break
                go = f[np.arange(len(f)), np.maximum(feature[node], 0)] <= cut[node]
                node = np.where(inner, np.where(go, left[node], right[node]), node)
            out += value[node]
        return out

    def score(self, f: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(f), self.x, self.y), 0.0, 1.0) if len(self.x) else np.full(len(f), self.base)


def _tree(f, grad, hess, depth, min_rows, bins):
    feature, cut, left, right, value = [], [], [], [], []

    def node(rows, level):
        me = len(feature)
        for a, v in ((feature, -1), (cut, 0.0), (left, 0), (right, 0), (value, 0.0)):
            a.append(v)
        g, h = grad[rows].sum(), hess[rows].sum()
        value[me] = 0.1 * g / (h + 1.0)
        if level == depth or len(rows) < 2 * min_rows:
            return me
        best = (1e-6, None, None)
        for j in range(f.shape[1]):
            edges = bins[j]
            if not len(edges):
                continue
            at = np.searchsorted(edges, f[rows, j], side="left")  # bin b holds values <= edges[b]
            gs, hs = np.bincount(at, grad[rows], len(edges) + 1).cumsum()[:-1], np.bincount(at, hess[rows], len(edges) + 1).cumsum()[:-1]
            ns = np.bincount(at, minlength=len(edges) + 1).cumsum()[:-1]
            gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
            gain[(ns < min_rows) | (len(rows) - ns < min_rows)] = 0
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], j, edges[k])
        if best[1] is None:
            return me
        feature[me], cut[me] = best[1], best[2]
        go = f[rows, best[1]] <= best[2]
        left[me] = node(rows[go], level + 1)
        right[me] = node(rows[~go], level + 1)
        return me

    node(np.arange(len(f)), 0)
    return np.array(feature), np.array(cut), np.array(left), np.array(right), np.array(value)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: non-decreasing means of y along x."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # [sum, weight, lowest x, highest x]
    for v, t in zip(x[order], y[order]):
        pools.append([t, 1.0, v, v])
        while len(pools) > 1 and (pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1] or pools[-2][3] == pools[-1][2]):
            s, w, _, high = pools.pop()
            pools[-1][0] += s
            pools[-1][1] += w
            pools[-1][3] = high
    xs = [e for p in pools for e in (p[2], p[3])]
    # One row of doubt in each pool keeps a pool of few rows from claiming certainty.
    ys = [(p[0] + 0.5 * y.mean()) / (p[1] + 0.5) for p in pools for _ in (0, 1)]
    return np.array(xs), np.maximum.accumulate(np.array(ys))


def boost(f: np.ndarray, y: np.ndarray, fc: np.ndarray, yc: np.ndarray, rounds: int = 60, depth: int = 3) -> Trees:
    """Trees fitted to (f, y) by Newton steps on the logistic loss, calibrated on (fc, yc)."""
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    model = Trees(float(np.log(share / (1 - share))), [], np.array([]), np.array([]))
    bins = [np.unique(np.quantile(f[:, j], np.linspace(0, 1, 33)[:-1])) if len(f) else np.array([]) for j in range(f.shape[1])]
    # Densities are zero in most texts: add quantiles of the positive values.
    bins = [np.unique(np.concatenate([b, np.quantile(f[f[:, j] > 0, j], np.linspace(0, 1, 17)[:-1])])) if (f[:, j] > 0).any() else b for j, b in enumerate(bins)]
    raw = np.full(len(f), model.base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        model.trees.append(_tree(f, y - p, p * (1 - p), depth, max(3, len(f) // 500), bins))
        raw = raw + Trees(0.0, model.trees[-1:], model.x, model.y).raw(f)
    model.x, model.y = isotonic(model.raw(fc), yc) if len(fc) else isotonic(raw, y)
    return model


def fit(labelled: DataFrame) -> tuple[Lexicon, Trees]:
    """Learn from a bounded table (id, text, toxic)."""
    sample = labelled.where("toxic is not null").select(F.xxhash64("id").alias("o"), "id", "text", "toxic").collect()
    sample.sort(key=lambda r: (r.o, r.id, r.text or ""))
    texts, toxic = [r.text or "" for r in sample], np.array([r.toxic for r in sample], dtype=np.float64)
    nothing = Lexicon(frozenset(), frozenset(), frozenset())
    if len(toxic) < 8 or not 0 < toxic.sum() < len(toxic):
        return nothing, Trees(float(toxic.mean()) if len(toxic) else 0.0, [], np.array([]), np.array([]))
    half = np.arange(len(texts)) % 2 == 0
    first = learn_lexicon([t for t, h in zip(texts, half) if h], toxic[half])
    features = np.array([Featurizer(first)(t) for t, h in zip(texts, half) if not h])
    labels = toxic[~half]
    held = np.arange(len(labels)) % 3 == 2
    return learn_lexicon(texts, toxic), boost(features[~held], labels[~held], features[held], labels[held])


def _score(lexicon: Lexicon, model: Trees):
    def run(batches):
        features = Featurizer(lexicon)
        for batch in batches:
            f = np.array([features(t) for t in batch.column(1).to_pylist()], dtype=np.float64).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(f))], names=["doc_id", "score"])

    return run


def score(docs: DataFrame, lexicon: Lexicon, model: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: (doc_id, score)."""
    texts = narrow(docs, id=id_col, text=text_col)
    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(_score(lexicon, model), f"doc_id {kind}, score double")

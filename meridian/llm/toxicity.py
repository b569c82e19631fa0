"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear SVM.

Words are compared by the gap-weighted subsequence kernel (Lodhi et al.,
"Text classification using string kernels", 2002) on three characters within
``SPAN``, normalised by length: common subsequences count whether or not
characters stand between them, less the more they are spread. An insult with
inserted characters therefore stays near the insult; a power of the kernel
sets such words apart from accidental likes. Letters that are spaced out
("i d i o t") are put together first.

A sentence's similarity to a landmark word is that of its nearest word; the
similarities to all landmarks, whitened by the landmarks' own kernel matrix,
are its Nyström features. A linear SVM on these is trained on sentences of
labelled documents: every sentence of a clean document is negative, and of a
toxic document those that the SVM itself finds worst (multiple-instance
training). A document scores by its ``WORST`` worst sentences, turned into a
probability by a logistic fit on the training documents.

The model is fitted on the driver from a bounded sample of labelled rows
(``MAX_TOXIC`` and ``MAX_CLEAN`` documents, the first by a hash of the id).
Every whole text is scored; a task compares each of its distinct words with
the landmarks once.

Defined results: null and empty texts score as a sentence without words;
without labels of both classes every score is 0; repeated rows score alike;
source, language and labels are never used for a score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meridian.llm.common import WIDE_ROWS, batch_rows, ship, staged, tidy

MAX_TOXIC = 800         # training documents of each class at most
MAX_CLEAN = 1_600
LANDMARKS = 64
PLAIN = 8               # of these: frequent words
CANDIDATES = 160
WITNESSES = 2           # sentences of a toxic document that it is trained on
WORST = 3               # sentences that decide on a document
SPAN = 6                # characters that it may span
DECAY = 0.8             # its weight for each of these
POWER = 3               # of the kernel: only near words count
START = "^"             # stands before every word
THRESHOLD = 0.7
CACHE_WORDS = 200_000   # words whose similarities a task keeps
CHUNK_WORDS = 1 << 16
MAX_PLACES = 1 << 22    # of a table of three characters each; beyond it they are searched

_EDGES = " .,;:!?\"'()[]{}<>|#*%$&-_/\\«»“”‘’…¡¿"
_SPACED = re.compile(r"(?<!\w)\w(?:[\s.\-_*]{1,2}\w){2,}(?!\w)")
_GAPS = re.compile(r"[\s.\-_*]+")
_END = (".", "!", "?")
# Digits and signs written for letters
_FOR_LETTERS = str.maketrans("01345@$|", "oieasasi")


def word_of(raw: str) -> str:
    """The word that a raw token stands for: without punctuation around it, and
    with inserted signs left out of it."""
    word = raw.strip(_EDGES)
    if word.isalpha():
        return word
    letters = "".join(c for c in word.translate(_FOR_LETTERS) if c.isalpha())
    return letters if 2 * len(letters) > len(word) else word


def _spans(length: int) -> list[tuple[int, int, int, float]]:
    """Places of the subsequences of a word, with their weights."""
    return [(i, j, k, DECAY ** (k - i + 1)) for i in range(length - 2)
            for j in range(i + 1, min(i + SPAN - 1, length - 1)) for k in range(j + 1, min(i + SPAN, length))]


def _norm(length: int) -> float:
    return max(1e-9, sum(w * w for *_, w in _spans(length))) ** 0.5


class Landmarks:
    """The landmarks' subsequences: sorted codes, and their weights per landmark."""

    def __init__(self, words: list[str]):
        self.words = words
        weight: dict[tuple[int, int, int], np.ndarray] = {}
        for m, word in enumerate(words):
            c = [ord(x) for x in START + word]
            for i, j, k, w in _spans(len(c)):
                row = weight.setdefault((c[i], c[j], c[k]), np.zeros(len(words), np.float32))
                row[m] += w / _norm(len(c))
        keys = np.array([(x << 42) | (y << 21) | z for x, y, z in weight], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.weights = np.array(list(weight.values()), np.float32).reshape(-1, len(words))[order]
        # the characters' numbers from 1, 0 for others, and the place of each three, -1 for none
        letters = np.unique([self.keys >> 42, self.keys >> 21 & 0x1FFFFF, self.keys & 0x1FFFFF])
        self.letter = np.zeros(int(letters.max(initial=0)) + 2, np.int32)     # the last: of all characters beyond
        self.letter[letters] = np.arange(1, len(letters) + 1)
        self.base = len(letters) + 1
        self.place = np.zeros(0, np.int32)
        if self.base ** 3 <= MAX_PLACES:
            self.place = np.full(self.base ** 3, -1, np.int32)
            self.place[self._number(self.keys >> 42, self.keys >> 21 & 0x1FFFFF, self.keys & 0x1FFFFF)] = np.arange(len(self.keys))

    def _number(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        return (self.letter[a] * self.base + self.letter[b]) * self.base + self.letter[c]

    def similarities(self, words: list[str]) -> np.ndarray:
        """Normalised kernel values, one row per word and one column per landmark."""
        out = np.zeros((len(words), len(self.words)), np.float32)
        by_len: dict[int, list[int]] = {}
        for n, w in enumerate(words):
            by_len.setdefault(len(w) + len(START), []).append(n)
        for length, rows in by_len.items():
            if length < 3 or not len(self.keys):
                continue
            step = max(1, 20_000_000 // (length * 64))
            norm = np.float32(_norm(length))
            for at in range(0, len(rows), step):
                part = rows[at:at + step]
                text = "".join(START + words[n] for n in part)
                code = np.frombuffer(text.encode("utf-32-le"), np.int32).reshape(-1, length)
                got = np.zeros((len(part), len(self.words)), np.float32)
                letter = np.ascontiguousarray(self.letter[np.minimum(code, len(self.letter) - 1)].T)
                for i, j, k, w in _spans(length):
                    if len(self.place):
                        place = self.place[(letter[i] * self.base + letter[j]) * self.base + letter[k]]
                        here = np.flatnonzero(place >= 0)
                        place = place[here]
                    else:
                        here = np.flatnonzero((letter[i] > 0) & (letter[j] > 0) & (letter[k] > 0))
                        c = code[here].astype(np.int64)
                        key = (c[:, i] << 42) | (c[:, j] << 21) | c[:, k]
                        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                        hit = self.keys[place] == key
                        here, place = here[hit], place[hit]
                    if len(here):
                        got[here] += np.float32(w) / norm * self.weights[place]
                out[part] = got ** POWER
        return out


def tokens(text: str) -> list[list[str]]:
    """Raw words of each sentence; spaced-out letters are put together."""
    text = text.lower()
    if _SPACED.search(text):
        text = _SPACED.sub(lambda m: _GAPS.sub("", m.group()), text)
    out = []
    for line in text.split("\n"):
        sentence: list[str] = []
        for raw in line.split():
            sentence.append(raw)
            if raw.endswith(_END):
                out.append(sentence)
                sentence = []
        if sentence:
            out.append(sentence)
    return out


@dataclass
class Model:
    marks: Landmarks
    weights: np.ndarray     # on the similarities
    bias: float
    logit: np.ndarray       # on a document's worst sentences, and a constant

    def probability(self, worst: np.ndarray) -> np.ndarray:
        z = np.clip(worst @ self.logit[:-1] + self.logit[-1], -40, 40)
        return 1.0 / (1.0 + np.exp(-z))

    def sentences(self, sims: np.ndarray) -> np.ndarray:
        return sims @ self.weights + np.float32(self.bias)


def worst_sentences(values: np.ndarray, doc_of: np.ndarray, docs: int, floor: float) -> np.ndarray:
    """The ``WORST`` greatest values of each document; ``floor`` where it has
    fewer sentences."""
    out = np.full((docs, WORST), min(floor, -1.0))
    order = np.lexsort((-values, doc_of))
    owner = doc_of[order]
    starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else owner
    place = np.arange(len(owner)) - np.repeat(starts, np.diff(np.r_[starts, len(owner)]))
    top = place < WORST
    out[owner[top], place[top]] = values[order][top]
    return out


class _Numbers(dict):
    """Numbers of raw words; two that stand for one word have its number."""

    def __init__(self):
        super().__init__()
        self.row: dict[str, int] = {}
        self.new: list[str] = []

    def __missing__(self, raw: str) -> int:
        word = word_of(raw)
        k = self.row.get(word)
        if k is None:
            k = self.row[word] = len(self.row)
            self.new.append(word)
        self[raw] = k
        return k


class _Features:
    """The similarities of words, each word once, however it is written."""

    def __init__(self, marks: Landmarks):
        self.marks, self.number = marks, _Numbers()
        self.table = np.zeros((0, len(marks.words)), np.float32)

    def update(self) -> None:
        if self.number.new:
            got = self.marks.similarities(self.number.new)
            self.table = np.concatenate([self.table, got]) if len(self.table) else got
            self.number.new = []

    def of_groups(self, words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The greatest similarities among the words of each group (a sentence
        or document); ``lengths`` are not zero."""
        out = np.zeros((len(lengths), self.table.shape[1]), np.float32)
        ends = np.cumsum(lengths)
        first = 0
        while first < len(lengths):  # runs of whole groups of about CHUNK_WORDS words
            begin = ends[first] - lengths[first]
            last = max(first + 1, int(np.searchsorted(ends, begin + CHUNK_WORDS, side="right")))
            starts = ends[first:last] - lengths[first:last] - begin
            out[first:last] = np.maximum.reduceat(self.table[words[begin:ends[last - 1]]], starts, axis=0)
            first = last
        return out


def _choose(docs: list[set[str]], toxic: np.ndarray) -> list[str]:
    """Landmarks: the words whose likes tell toxic from clean documents best,
    none much like an earlier one, and a few frequent words."""
    count: dict[str, list[int]] = {}
    for doc, y in zip(docs, toxic):
        for w in doc:
            count.setdefault(w, [0, 0])[int(y)] += 1
    n_pos, n_neg = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    odds = {w: (p + 0.5) / (n_pos + 1) / ((q + 0.5) / (n_neg + 1)) for w, (q, p) in count.items()}
    ranked = sorted((w for w, (_, p) in count.items() if p >= 2 and len(w) >= 3 and odds[w] >= 3),
                    key=lambda w: (-count[w][1], w))[:CANDIDATES]
    plain = [w for w in sorted(count, key=lambda w: (-sum(count[w]), w)) if len(w) >= 3][:PLAIN]
    if not ranked:
        return plain
    feats = _Features(Landmarks(ranked))
    words = np.array([feats.number[w] for d in docs for w in (d or {""})])
    feats.update()
    x = feats.of_groups(words, np.array([max(1, len(d)) for d in docs]))
    # how far the classes lie apart, for each candidate
    gap = x[toxic].mean(axis=0) - x[~toxic].mean(axis=0)
    apart = gap / np.sqrt(x[toxic].var(axis=0) * 0.5 + x[~toxic].var(axis=0) * 0.5 + 1e-4) * np.sqrt(
        np.array([count[w][1] for w in ranked]))
    near = feats.marks.similarities(ranked)
    chosen: list[int] = []
    for k in np.argsort(-apart, kind="stable"):
        if apart[k] > 0 and len(chosen) < LANDMARKS - PLAIN and (not chosen or near[k, chosen].max() < 0.5):
            chosen.append(int(k))
    return [ranked[k] for k in chosen] + [w for w in plain if w not in {ranked[k] for k in chosen}]


def _svm(x: np.ndarray, y: np.ndarray, ridge: float = 1e-4, rounds: int = 150) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss, both classes with equal weight, by
    accelerated gradient steps."""
    z = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64, copy=False)
    del x
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    reach = 2 * float(np.linalg.eigvalsh((z * weight[:, None]).T @ z)[-1]) + ridge
    w = v = np.zeros(z.shape[1])
    momentum = 1.0
    for _ in range(rounds):
        slack = np.maximum(0, 1 - y * (z @ v))
        grad = -2 * z.T @ (weight * y * slack) + ridge * np.r_[v[:-1], 0]
        new = v - grad / reach
        nxt = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        v = new + (momentum - 1) / nxt * (new - w)
        w, momentum = new, nxt
    return w[:-1], float(w[-1])


def _logistic(x: np.ndarray, toxic: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights and a constant, by Newton steps with smoothed targets (Platt, 1999)."""
    n_pos, n_neg = toxic.sum(), (~toxic).sum()
    target = np.where(toxic, (n_pos + 1) / (n_pos + 2), 1 / (n_neg + 2))
    z = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64)
    w = np.zeros(z.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        h = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(h, z.T @ (p - target) + ridge * np.r_[w[:-1], 0])
        w -= np.clip(step, -2, 2)
    return w


def fit_texts(texts: list[str], toxic: np.ndarray) -> Model | None:
    """The model from labelled texts; None without both classes."""
    toxic = np.asarray(toxic, bool)
    if not toxic.any() or toxic.all():
        return None
    held: dict[str, str] = {}       # each raw word once
    docs = [[[held.setdefault(raw, raw) for raw in s] for s in tokens(t)] for t in texts]
    word = {raw: word_of(raw) for raw in held}
    chosen = _choose([{word[raw] for s in d for raw in s} for d in docs], toxic)
    del held, word
    if not chosen:
        return None
    marks = Landmarks(chosen)
    feats = _Features(marks)
    doc_of = np.array([d for d, doc in enumerate(docs) for _ in doc])
    lengths = np.array([len(s) for doc in docs for s in doc])
    words = np.array([feats.number[raw] for doc in docs for s in doc for raw in s])
    feats.update()
    sims = feats.of_groups(words, lengths)
    own = marks.similarities(chosen).astype(np.float64)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    good = values > 1e-2 * values[-1]
    whiten = vectors[:, good] / np.sqrt(values[good])
    x = sims @ whiten
    level = sims[:, :max(1, len(chosen) - PLAIN)].max(axis=1)
    del sims, feats, words
    negative = ~toxic[doc_of]
    weights, bias = np.zeros(x.shape[1]), 0.0
    for _ in range(4):
        # positive: of each toxic document its worst sentences
        rank = np.full(len(level), len(level))
        order = np.lexsort((-level, doc_of))
        starts = np.flatnonzero(np.r_[True, doc_of[order][1:] != doc_of[order][:-1]])
        rank[order] = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
        positive = ~negative & (rank < WITNESSES)
        use = negative | positive
        weights, bias = _svm(x[use], np.where(positive[use], 1.0, -1.0))
        level = x @ weights + bias
    worst = worst_sentences(level, doc_of, len(docs), bias)
    return Model(marks, (whiten @ weights).astype(np.float32), bias, _logistic(worst, toxic))


def training_rows(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC,
                  max_clean: int = MAX_CLEAN) -> DataFrame:
    """``text``, ``toxic`` of the training sample: never rows held out."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    open_ = known.where(~held_out("doc_id")).withColumn("h", F.xxhash64("doc_id"))
    picked = (open_.where(F.col("toxic") == 1).orderBy("h", "doc_id").limit(max_toxic)
              .unionByName(open_.where(F.col("toxic") == 0).orderBy("h", "doc_id").limit(max_clean)))
    return docs.join(F.broadcast(picked.select("doc_id", "toxic")), "doc_id").select("doc_id", "text", "toxic")


def held_out(doc_id: str):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, **bounds) -> Model | None:
    rows = (training_rows(docs, labels, **bounds).select(F.col("text"), F.col("toxic").cast("int").alias("toxic"), "doc_id")
            .toArrow())
    pairs = sorted(set(zip(rows.column("doc_id").to_pylist(), (t or "" for t in rows.column("text").to_pylist()),
                           rows.column("toxic").to_pylist())))
    return fit_texts([t for _, t, _ in pairs], np.array([y == 1 for _, _, y in pairs], bool))


def _score_batches(model: Model):
    def run(batches):
        feats = _Features(model.marks)
        for batch in batches:
            doc_of: list[int] = []
            lengths: list[int] = []
            words: list[int] = []
            best = np.full((batch.num_rows, WORST), min(model.bias, -1.0))

            def flush():
                nonlocal feats, doc_of, lengths, words
                if lengths:
                    feats.update()
                    values = model.sentences(feats.of_groups(np.array(words), np.array(lengths)))
                    owner = np.array(doc_of)
                    got = worst_sentences(values, owner, batch.num_rows, model.bias)
                    best[:] = -np.sort(-np.hstack([best, got]), axis=1)[:, :WORST]
                doc_of, lengths, words = [], [], []
                if len(feats.number) > CACHE_WORDS:
                    feats = _Features(model.marks)

            for d, text in enumerate(batch.column("_text")):
                for s in tokens(text.as_py() or ""):
                    doc_of.append(d)
                    lengths.append(len(s))
                    words.extend(map(feats.number.__getitem__, s))
                if len(words) > 8 * CHUNK_WORDS:
                    flush()
            flush()
            keep = [n for n in batch.schema.names if n != "_text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), pa.array(model.probability(best))],
                                             names=[*keep, "score"])
    return run


def score(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: ``_id``, ``score``, ``predicted``."""
    src = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text"))
    if model is None:
        out = src.select("_id", F.lit(0.0).alias("score"))
    else:
        schema = T.StructType([src.schema["_id"], T.StructField("score", T.DoubleType())])
        out = src.mapInArrow(tidy(_score_batches(model)), schema)
    return out.select("_id", "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold."""
    model = fit(docs, labels)
    if model is None:
        return docs
    src = docs.withColumn("_text", F.col("text").cast("string"))
    scored = src.mapInArrow(tidy(_score_batches(model)), T.StructType(
        [*docs.schema.fields, T.StructField("score", T.DoubleType())]))
    with batch_rows(docs.sparkSession, WIDE_ROWS):
        return staged(scored.where(F.col("score") < threshold).select(*docs.columns), "clean")


ship(__name__)

"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into passages of up to ``PASSAGE`` words. Their TF-IDF
matrix, with document frequencies counted over all documents, is factorised
by a distributed randomised SVD; every passage is a point in the latent space.
A document is read in overlapping regions, twice as long as the window of the
passages they are compared with; each is projected into the same space, and
its product with a passage there is the weight of the passage that it holds.
Words that the passage doesn't have add nothing, so it doesn't matter what
stands around a copy. A candidate is a leak when the longest common
subsequence of words of passage and region covers enough of the passage, or
somewhat less of it (a paraphrase) if it covers the item's answer, its last
sentence, in full measure.

No leak is lost before the subsequence is computed: a passage of n words that
needs m in order shares m words with the region. So the region holds at least
the weight of the m lightest words, and ``hits`` of the passage's
``n - m + hits`` rarest words. Regions that hold fewer aren't projected.

Passages are factorised in blocks of ``BLOCK`` so that the rank never falls
behind the number of passages; a benchmark over ``MAX_ITEMS`` items is checked
in rounds of that many. Both only bound what a task holds.

Defined results: null and empty documents and items match nothing; an item
with fewer than ``SHORT`` words must appear word for word; repeated rows
and items give the same result each; other columns are kept or not used.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meridian.llm.common import WIDE_ROWS, batch_rows, ship, staged, tidy, utf8

PASSAGE = 64          # words of a passage at most
SIZES = (4, 8, 16, 32, 64)  # window lengths; a passage is sought in the next longer
SLACK = 2e-3          # of a region's weight, for rounding and lost directions of the latent space
COPY = 0.8            # share of a passage in the longest common subsequence
PARAPHRASE = 0.6      # the same, if the answer is there
ANSWER = 0.8          # share of the answer in it
SHORT = 8
HITS_PCT = 35         # of the words needed, sought among the rarest; any share loses nothing
STRETCH = 16_384      # words searched at once, of one document or several
PIECES = 256          # documents searched at once
BLOCK = 256
RANK = 256
OVERSAMPLE = 16
MAX_ITEMS = 10_000
CHUNK = 1024          # terms whose sums travel together
SEED = 7
WORD_CACHE = 400_000
OTHER, NO_WORD = -1, -2  # numbers of raw words outside the vocabulary
_EDGES = b" .,;:!?\"'()[]{}<>|#*%$&-_/\\"
_STOPS = (b".", b"!", b"?")


def words_of(text: bytes) -> list[bytes]:
    return [w for w in (x.strip(_EDGES) for x in text.lower().split()) if w]


def answer_of(text: bytes) -> list[bytes]:
    """The words of the last sentence with three words or more."""
    sentences, now = [], []
    for line in text.lower().split(b"\n"):
        for raw in line.split():
            now.append(raw)
            if raw.endswith(_STOPS):
                sentences.append(now)
                now = []
        if now:
            sentences.append(now)
            now = []
    sentences = [[w for w in (x.strip(_EDGES) for x in s) if w] for s in sentences]
    return next((s for s in reversed(sentences) if len(s) >= 3), [])


def common_subsequence(a: list, b: list) -> int:
    """The length of the longest common subsequence (bit-parallel)."""
    masks: dict = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        if m := masks.get(x):
            hit = row & m
            row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


@dataclass
class Passage:
    item: int
    words: list[bytes]
    answer: list[bytes]


@dataclass
class Block:
    """Passages with their terms, latent basis and latent points."""
    passages: list[Passage]
    idf: np.ndarray                 # of each term
    basis: np.ndarray               # terms x rank
    points: np.ndarray              # passages x rank, of unit length in the whole space
    size: np.ndarray                # of each passage: its window length,
    floor: np.ndarray               # the weight a region must hold,
    hits: np.ndarray                # and how many of its rarest words
    most: np.ndarray                # of each term: its greatest count in a passage,
    start: np.ndarray               # and the passages that have it among their rarest words,
    length: np.ndarray              # ``length`` of ``members`` from ``start``
    members: np.ndarray


def words_needed(p: Passage) -> int:
    """The least common subsequence that can make the passage a leak."""
    n = len(p.words)
    if n < SHORT:
        return n
    least = PARAPHRASE if p.answer else COPY
    return next(k for k in range(n + 1) if k / n >= least)


def passages_of(items: list[tuple[int, bytes]]) -> list[Passage]:
    out = []
    for item, text in items:
        words = words_of(text)
        answer = answer_of(text)
        for at in range(0, max(1, len(words) - PASSAGE // 2), PASSAGE // 2):
            if part := words[at:at + PASSAGE]:
                out.append(Passage(item, part, answer))
    return out


class _Numbers(dict):
    """The place in ``vocabulary`` of the word that each raw word stands for:
    ``OTHER`` if it has no such word, ``NO_WORD`` for punctuation alone."""

    def __init__(self, vocabulary: dict[bytes, int]):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, raw: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        word = raw.strip(_EDGES)
        k = self[raw] = self.vocabulary.get(word, OTHER) if word else NO_WORD
        return k


def _term_counts(terms: dict[bytes, int]):
    """Documents with each term, summed over a task; term -1 counts documents."""
    def run(batches):
        count, n, number = np.zeros(len(terms) - NO_WORD, np.int64), 0, _Numbers(terms).__getitem__
        for batch in batches:
            seen: list[int] = []
            for text in batch.column("_utf8").to_pylist():
                seen.extend({*map(number, text.lower().split())})
            count += np.bincount(np.array(seen, np.int64) - NO_WORD, minlength=len(count))
            n += batch.num_rows
        count = count[-NO_WORD:]
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[at, -1].astype(np.int64)), pa.array(np.r_[count[at], n].astype(np.int64))],
                                         names=["term", "docs"])
    return run


def document_frequencies(src: DataFrame, terms: dict[bytes, int]) -> tuple[np.ndarray, int]:
    """Over all documents; one row per term reaches the driver."""
    with batch_rows(src.sparkSession, WIDE_ROWS):
        got = (src.mapInArrow(tidy(_term_counts(terms)), "term long, docs long").groupBy("term")
               .agg(F.sum("docs").alias("docs")).toArrow())
    at, docs = got.column("term").to_numpy(), got.column("docs").to_numpy()
    out = np.zeros(len(terms), np.int64)
    out[at[at >= 0]] = docs[at >= 0]
    return out, int(docs[at < 0].sum())


def _gram_chunks(m: np.ndarray):
    """Sums of row x (row . m) over a task's sparse rows, in chunks of terms."""
    def run(batches):
        out = np.zeros_like(m)
        for batch in batches:
            for ids, weights in zip(batch.column("ids").to_pylist(), batch.column("weights").to_pylist()):
                w = np.array(weights)
                out[ids] += w[:, None] * (w @ m[ids])[None, :]
        chunks = range(0, len(m), CHUNK)
        yield pa.RecordBatch.from_arrays([pa.array([*chunks], pa.int64()), pa.array([out[c:c + CHUNK].tobytes() for c in chunks], pa.binary())],
                                         names=["chunk", "sums"])
    return run


def _add_chunks(key, table):
    total = sum(np.frombuffer(x, np.float64) for x in table.column("sums").to_pylist())
    return pa.table({"chunk": [key[0].as_py()], "sums": [total.tobytes()]})


def randomised_svd(rows: DataFrame, terms: int, rank: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors (terms x rank) and singular values of the matrix
    whose sparse rows are ``ids``, ``weights`` (Halko, Martinsson and Tropp,
    2011). The rows stay distributed: each round sums A'A M over them; only
    matrices of ``terms`` x ``rank`` reach the driver."""
    width = min(terms, rank + OVERSAMPLE)
    m = np.linalg.qr(np.random.default_rng(seed).standard_normal((terms, width)))[0]
    for _ in range(2):
        got = (rows.mapInArrow(_gram_chunks(m), "chunk long, sums binary").groupBy("chunk")
               .applyInArrow(_add_chunks, "chunk long, sums binary").toArrow().sort_by("chunk"))
        z = np.concatenate([np.frombuffer(x, np.float64).reshape(-1, width) for x in got.column("sums").to_pylist()])
        values, vectors = np.linalg.eigh((m.T @ z + z.T @ m) / 2)  # within the span of m
        last, m = m, np.linalg.qr(z)[0]
    order = np.argsort(-values)[:rank]
    keep = order[values[order] > 1e-9 * max(values.max(), 1e-30)]
    return last @ vectors[:, keep], np.sqrt(values[keep])


def build_blocks(src: DataFrame, items: list[tuple[int, bytes]]) -> tuple[list[Block], dict[bytes, list[tuple[int, int]]]]:
    """Blocks of the items' passages; where each word is (block, term)."""
    spark = src.sparkSession
    passages = sorted(passages_of(items), key=lambda p: (p.item, p.words))
    vocabulary = {w: i for i, w in enumerate(sorted({w for p in passages for w in p.words}))}
    docs, n = document_frequencies(src, vocabulary)
    idf_all = np.log((n + 1) / (docs + 1)) + 0.05
    blocks, where = [], {}
    for at in range(0, len(passages), BLOCK):
        part = passages[at:at + BLOCK]
        terms = {w: i for i, w in enumerate(sorted({w for p in part for w in p.words}))}
        idf = np.array([idf_all[vocabulary[w]] for w in terms])
        sparse, floor, hits = [], [], []
        most = np.zeros(len(terms), np.int64)
        rarest: list[list[int]] = [[] for _ in terms]
        for k, p in enumerate(part):
            own = np.array([terms[w] for w in p.words])
            ids, tf = np.unique(own, return_counts=True)
            weight = tf * idf[ids]
            weight /= np.linalg.norm(weight)
            sparse.append((ids.tolist(), weight.tolist()))
            most[ids] = np.maximum(most[ids], tf)
            need = words_needed(p)
            floor.append(np.sort(np.repeat(weight * idf[ids], tf))[:need].sum())
            hits.append(-(-need * HITS_PCT // 100))
            for i in set(own[np.argsort(-idf[own], kind="stable")][:len(own) - need + hits[-1]].tolist()):
                rarest[i].append(k)
        rows = spark.createDataFrame(sparse, "ids array<int>, weights array<double>")
        basis, _ = randomised_svd(rows, len(terms), min(RANK, len(part)))
        points = np.array([np.array(w) @ basis[i] for i, w in sparse])
        size = np.array([next((s for s in SIZES if len(p.words) <= s), SIZES[-1]) for p in part])
        length = np.array([*map(len, rarest), 0])  # the last: of a word that no passage has
        blocks.append(Block(part, idf.astype(np.float32), basis.astype(np.float32), points.astype(np.float32), size,
                            np.array(floor), np.array(hits), most, np.cumsum(length) - length, length,
                            np.array([k for x in rarest for k in x], np.int64)))
        for w, i in terms.items():
            where.setdefault(w, []).append((at // BLOCK, i))
    return blocks, where


def _is_leak(p: Passage, region: list[bytes]) -> float:
    """The passage's share in the longest common subsequence, 0 if it isn't a leak."""
    n = len(p.words)
    if n < SHORT:
        return float(any(region[i:i + n] == p.words for i in range(len(region) - n + 1)))
    share = common_subsequence(p.words, region) / n
    if share >= COPY:
        return share
    if share >= PARAPHRASE and p.answer and common_subsequence(p.answer, region) >= ANSWER * len(p.answer):
        return share
    return 0.0


class _Pieces:
    """Documents, or stretches of long ones, searched together."""

    def __init__(self):
        self.numbers: list[np.ndarray] = []
        self.rows: list[int] = []
        self.held = 0

    def add(self, row: int, numbers: np.ndarray):
        """Takes a document's words; True whenever enough are held to search."""
        # the stretches overlap by the longest region, and start where regions do
        for at in range(0, len(numbers), STRETCH):
            self.numbers.append(numbers[at:at + STRETCH + 2 * SIZES[-1]])
            self.rows.append(row)
            self.held += len(self.numbers[-1])
            if self.held >= STRETCH or len(self.rows) >= PIECES:
                yield True

    def search(self, words: list[bytes], terms: np.ndarray, blocks: list[Block], out: list[dict[int, float]]) -> None:
        """Adds to ``out`` (item -> share, by row) and lets the pieces go."""
        if self.rows:
            numbers, length = np.concatenate(self.numbers), np.array([*map(len, self.numbers)])
            own = terms[numbers]
            for k, block in enumerate(blocks):
                find_leaks(numbers, length, [out[r] for r in self.rows], words, own[:, k], block)
        self.__init__()


def find_leaks(numbers: np.ndarray, length: np.ndarray, out: list[dict[int, float]], vocabulary: list[bytes],
               terms: np.ndarray, block: Block) -> None:
    """Adds item -> share, of the items found, to each piece's ``out``. The
    pieces' words stand one after the other, ``length`` of each: ``numbers``,
    their places in ``vocabulary``, and ``terms``, the block's or -1."""
    piece_start, passages = np.cumsum(length) - length, len(block.passages)
    # every word with the passages that have it among their rarest words
    times = block.length[terms]
    some = np.flatnonzero(times)
    times = times[some]
    at = np.repeat(some, times)
    passage = block.members[np.repeat(block.start[terms[some]] - (np.cumsum(times) - times), times) + np.arange(len(at))]
    piece = np.repeat(np.arange(len(length)), length)[at]
    pair = piece * passages + passage
    enough = np.bincount(pair, minlength=len(length) * passages).reshape(-1, passages) >= block.hits
    keep = enough.ravel()[pair]
    at, pair = at[keep] - piece_start[piece[keep]], (np.cumsum(enough) - 1)[pair[keep]]
    if not len(at):
        return
    # hits by half a window, a row of them for each pair of piece and passage left; a region is four halves:
    # the window, and half of it on either side
    piece, passage = np.nonzero(enough)
    half, n = block.size[passage] // 2, length[piece]
    windows = np.maximum(1, -(-(n - half) // half))
    ends = np.cumsum(windows + 3)
    first = ends - windows - 3
    grid = np.bincount(first[pair] + at // half[pair] + 1, minlength=ends[-1])
    least = np.repeat(block.hits[passage], windows + 3)
    for k in (1, 2, 3):  # these would reach into the next row
        least[ends - k] = np.iinfo(least.dtype).max
    found = np.flatnonzero(grid[:-3] + grid[1:-2] + grid[2:-1] + grid[3:] >= least[:-3])
    if not len(found):
        return
    pair = np.searchsorted(first, found, side="right") - 1
    piece, near, half, n, k = piece[pair], passage[pair], half[pair], n[pair], found - first[pair]
    a, b = piece_start[piece] + np.maximum(0, (k - 1) * half), piece_start[piece] + np.minimum(n, (k + 3) * half)
    order = np.lexsort((b, a))
    a, b, piece, near = a[order], b[order], piece[order], near[order]
    new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    a, b, piece = a[new], b[new], piece[new]
    # the regions' terms, and how often each is there
    size = b - a
    term = terms[np.repeat(a - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
    held_by = np.repeat(np.arange(len(a)), size)[term >= 0]
    held, tf = np.unique(held_by * len(block.idf) + term[term >= 0], return_counts=True)
    own = held % len(block.idf)
    weight = (np.minimum(tf, block.most[own]) * block.idf[own]).astype(np.float32)
    cut = np.searchsorted(held, np.arange(len(a) + 1) * len(block.idf))
    for r, (i, j, s, e) in enumerate(zip(cut.tolist(), cut[1:].tolist(), new.tolist(), [*new[1:].tolist(), len(near)])):
        w, which = weight[i:j], near[s:e]
        point = w @ block.basis[own[i:j]]
        which = which[block.points[which] @ point >= block.floor[which] - SLACK * np.sqrt(w @ w)].tolist()
        if which:
            mine, region = out[piece[r]], [vocabulary[x] for x in numbers[a[r]:b[r]].tolist()]
            for i in which:
                p = block.passages[i]
                if mine.get(p.item, 0.0) < 1.0:
                    share = _is_leak(p, region)
                    if share:
                        mine[p.item] = max(share, mine.get(p.item, 0.0))


def _search(blocks: list[Block], where: dict[bytes, list[tuple[int, int]]]):
    def run(batches):
        terms = np.full((len(where) - NO_WORD, len(blocks)), -1, np.int32)  # the last rows: words of no passage
        for i, at in enumerate(where.values()):
            for b, t in at:
                terms[i, b] = t
        words = [*where] + [b""] * -NO_WORD  # no passage has an empty word
        number = _Numbers({w: i for i, w in enumerate(where)}).__getitem__
        for batch in batches:
            found: list[dict[int, float]] = [{} for _ in range(batch.num_rows)]
            pieces = _Pieces()
            for row, text in enumerate(batch.column("_utf8").to_pylist()):
                numbers = np.array([*map(number, text.lower().split())], np.int64)
                for _ in pieces.add(row, numbers[numbers > NO_WORD]):
                    pieces.search(words, terms, blocks, found)
            pieces.search(words, terms, blocks, found)
            keep = [n for n in batch.schema.names if n != "_utf8"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), pa.array([sorted(f) for f in found], pa.list_(pa.int64())),
                                              pa.array([max(f.values(), default=0.0) for f in found], pa.float64())],
                                             names=[*keep, "_items", "_share"])
    return run


def _checked(docs: DataFrame, benchmark: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``_items`` (leaked items, sorted) and ``_share``."""
    src = docs.withColumn("_utf8", utf8(text))
    bench = benchmark.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), utf8("text").alias("t"))
    rounds = max(1, -(-bench.count() // MAX_ITEMS))
    out = docs.withColumns({"_items": F.array().cast("array<bigint>"), "_share": F.lit(0.0)})
    for r in range(rounds):
        items = sorted({(x["item_id"], bytes(x["t"])) for x in
                        bench.where(F.pmod(F.xxhash64("item_id"), F.lit(rounds)) == r).toLocalIterator()})
        blocks, where = build_blocks(src.select("_utf8"), items)
        if not blocks:
            continue
        schema = T.StructType([*docs.schema.fields, T.StructField("_items", T.ArrayType(T.LongType())), T.StructField("_share", T.DoubleType())])
        if rounds == 1:
            return src.mapInArrow(tidy(_search(blocks, where)), schema)
        step = out.withColumnsRenamed({"_items": "_i", "_share": "_s"}).withColumn("_utf8", utf8(text))
        wide = T.StructType([*[f for f in step.schema.fields if f.name != "_utf8"], *schema.fields[-2:]])
        out = step.mapInArrow(tidy(_search(blocks, where)), wide).select(
            *docs.columns, F.array_sort(F.array_union("_i", "_items")).alias("_items"), F.greatest("_s", "_share").alias("_share"))
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``_id``, ``item_ids`` (leaked items, sorted),
    ``share`` (the greatest share of a passage found) and ``leaked``."""
    slim = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_t"))
    return _checked(slim, benchmark, "_t").select("_id", F.col("_items").alias("item_ids"), F.col("_share").alias("share"),
                                                  (F.size("_items") > 0).alias("leaked"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    with batch_rows(docs.sparkSession, WIDE_ROWS):
        return staged(_checked(docs, benchmark, text).where(F.size("_items") == 0).select(*docs.columns), "unleaked")


ship(__name__)

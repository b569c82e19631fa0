"""Spelling variant grouping by a frequency-vector trie.

Words of a corpus are counted, and each is described by how often letters of
each of 15 groups occur in it. One inserted, deleted or replaced letter adds at
most one to one of the counts and takes at most one from another. A trie holds
the words by their counts, one group a level; a search for the near words of a
word goes down depth first with a budget of one surplus and one deficit, and
compares the words of the leaves that it reaches.

The trie is cut in two. Its top, the nodes with more than ``CELL`` words below
them, is small (by arithmetic at most ``MAX_OPEN`` nodes a level) and goes to all
tasks; what hangs below, cells of at most ``CELL`` words, is spread over the
cluster. Every word is sent to the cells that its budget reaches in the top, and
a task builds the lower trie of one cell at a time and searches it for all words
sent there, in blocks of vectors. Leaves above the bound, words with the same
counts, are cut into several cells. The order of the words is that of shuffled,
sorted rows, so no cell's visitors are held in memory.

A count of 15 stands for 15 and more, so a vector fits one long; that can only
add words to compare.

Defined cases: null and empty texts have no words; a null id counts as the empty
text in ``<id>:<run>``. Repeated rows count each time. Ties for the form go to
the smallest word in code-point order. A table without rows or without frequent
words gives no rows. Very long texts and words are taken whole; broken UTF-8
ends a word. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import batch_rows, ship, staged, utf8

MIN_LENGTH = 6
MIN_COUNT = 5
TIMES = 5               # a form occurs at least so many times as often as its variant
TYPO_MODULUS = 199

# Letter groups, one a level of the trie; the last holds all letters beyond z.
GROUPS = ("e", "a", "i", "n", "r", "s", "t", "o", "l", "ud", "cg", "mp", "hbk", "fvwjqxyz",
          "".join(map(chr, range(0xC0, 0x100))))
LEVELS = len(GROUPS)
CAP = 15                # largest count that a vector tells apart
CELL = 8_000            # words of a cell
MAX_OPEN = 10_000       # nodes a level above that size; a larger vocabulary gets larger cells
HELD = 500_000          # distinct words that a task counts before it gives them away
HELD_CHARS = 64 << 20
PAIRS = 500_000         # leaf words compared at once

_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % MIN_LENGTH)


def _count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of ``MIN_LENGTH`` letters with their counts in a part of the texts,
    the planted slips included."""
    counts: Counter[str] = Counter()
    chars = 0

    def given() -> Iterator[pa.RecordBatch]:
        words = list(counts)
        for i in range(0, len(words), 50_000):
            part = words[i:i + 50_000]
            yield pa.record_batch([pa.array(part, pa.string()), pa.array([counts[w] for w in part], pa.int64())],
                                  ["word", "n"])

    for batch in batches:
        for doc, text in zip(batch.column("id").to_pylist(), batch.column("text")):
            # bytes.lower() lowers A-Z only
            runs = Counter(_RUN.findall(text.as_py().lower().decode("utf-8", "replace")))
            start = zlib.crc32(f"{doc}:".encode())
            for run, n in runs.items():
                h = zlib.crc32(run.encode(), start)
                if h % TYPO_MODULUS == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1:]
                    if len(run) < MIN_LENGTH:
                        continue
                counts[run] += n
            chars += sum(map(len, runs))
            if len(counts) > HELD or chars > HELD_CHARS and sum(map(len, counts)) > HELD_CHARS:
                yield from given()
                counts.clear()
            if chars > HELD_CHARS:
                chars = 0
    yield from given()


def vocabulary(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)``: words of at least ``MIN_LENGTH`` letters that occur at
    least ``min_count`` times in the texts."""
    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), utf8("text").alias("text"))
    return (texts.mapInArrow(_count_runs, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


def _vector(word: Column) -> Column:
    """Counts of the letter groups as one long, four bits each, the first level highest."""
    total = F.lit(0).cast("long")
    for level, letters in enumerate(GROUPS):
        count = F.length(word) - F.length(F.translate(word, letters, ""))
        total = total + F.shiftleft(F.least(count, F.lit(CAP)).cast("long"), _shift(level))
    return total


def _shift(level: int) -> int:
    return 4 * (LEVELS - 1 - level)


class _Trie:
    """Children of nodes by count, a level at a time: ``table[level][node,
    count]`` is a node of the next level, -1 where there is none."""

    def __init__(self, first: int, tables: list[np.ndarray]) -> None:
        self.first, self.tables = first, tables

    def search(self, vectors: np.ndarray, up: np.ndarray, down: np.ndarray, ends: dict[int, np.ndarray]):
        """Depth first, a block of vectors at a time: yields ``(level, node,
        who, vector, up, down)`` arrays of searches that reached an end.
        ``ends[level]`` is true for nodes where the search ends."""
        everyone = np.arange(len(vectors))
        for u in (0, 1):
            for d in (0, 1):
                who = everyone[(up == u) & (down == d)]
                stack = [(self.first, np.zeros(len(who), np.int32), who, vectors[who], u, d)]
                while stack:
                    level, node, who, v, u2, d2 = stack.pop()
                    if level in ends:
                        stop = ends[level][node]
                        if stop.any():
                            yield level, node[stop], who[stop], v[stop], u2, d2
                            go = ~stop
                            node, who, v = node[go], who[go], v[go]
                    at = level - self.first
                    if not len(who) or at == len(self.tables):
                        continue
                    shift = _shift(level)
                    count = (v >> shift) & 15
                    for delta in (0, 1, -1):
                        if delta == 1 and not u2 or delta == -1 and not d2:
                            continue
                        spent = count + delta
                        child = np.where((spent >= 0) & (spent <= CAP), self.tables[at][node, spent & 15], -1)
                        ok = child >= 0
                        if ok.any():
                            stack.append((level + 1, child[ok], who[ok], v[ok] + (delta << shift),
                                          u2 - (delta == 1), d2 - (delta == -1)))


def _lower_trie(first: int, vectors: np.ndarray) -> _Trie:
    """The trie of sorted distinct vectors below a cell at level ``first``; its
    nodes at the last level are numbered as the vectors."""
    tables, node = [], np.zeros(len(vectors), np.int64)
    for level in range(first, LEVELS):
        count = (vectors >> _shift(level)) & 15
        key, child = np.unique(node * 16 + count, return_inverse=True)
        table = np.full((int(node[-1]) + 1, 16), -1, np.int32)
        table[key // 16, key % 16] = np.arange(len(key))
        tables.append(table)
        node = child
    return _Trie(first, tables)


class _Top:
    """The open nodes of the trie and their children, as one trie whose
    ends are the cells."""

    def __init__(self, children: list[list[tuple[int, int, bool]]]) -> None:
        # children[d]: (prefix of d + 1 counts, words, is open) of the open nodes at depth d
        self.keys = [np.zeros(1, np.int64)]
        self.ends = {0: np.array([not children])}
        self.parts = {}
        tables = []
        for depth, rows in enumerate(children):
            rows = sorted(rows)
            key = np.array([r[0] for r in rows], np.int64)
            parent = np.searchsorted(self.keys[-1], key >> 4)
            table = np.full((len(self.keys[-1]), 16), -1, np.int32)
            table[parent, key & 15] = np.arange(len(key))
            tables.append(table)
            self.keys.append(key)
            self.ends[depth + 1] = np.array([not r[2] for r in rows])
        self.trie = _Trie(0, tables)


VISIT = "depth int, cell long, part int, kind int, word string, n long, vector long, up int, down int"
_VISIT_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
_VISIT_NAMES = [x.split()[0] for x in VISIT.split(", ")]


def _sender(top: _Top):
    """Rows of a cell (kind 0) and of the words that visit it (kind 1)."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = batch.column("word"), batch.column("n").to_numpy()
            vectors = batch.column("vector").to_numpy()
            crc = None
            ones = np.ones(len(n), np.int32)
            for home in (True, False):
                budget = ones * (0 if home else 1)
                for depth, node, who, v, up, down in top.trie.search(vectors, budget, budget, top.ends):
                    key = top.keys[depth][node]
                    if depth == LEVELS and top.parts:
                        # a leaf above the bound: its words are dealt out, its visitors see each part
                        if crc is None:
                            crc = np.fromiter((zlib.crc32(w.encode()) for w in words.to_pylist()), np.int64, len(n))
                        parts = np.array([top.parts.get(int(k), 1) for k in key], np.int64)
                        if home:
                            part = crc[who] % parts
                        else:
                            part = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
                            key, who, v = np.repeat(key, parts), np.repeat(who, parts), np.repeat(v, parts)
                    else:
                        part = np.zeros(len(who), np.int64)
                    k = len(who)
                    yield pa.record_batch(
                        [pa.array(np.full(k, depth), pa.int32()), pa.array(key, pa.int64()), pa.array(part, pa.int32()),
                         pa.array(np.full(k, 0 if home else 1), pa.int32()), words.take(pa.array(who)),
                         pa.array(n[who], pa.int64()), pa.array(v, pa.int64()),
                         pa.array(np.full(k, up), pa.int32()), pa.array(np.full(k, down), pa.int32())], _VISIT_NAMES)
    return send


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point turns a into b."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i, n = 0, len(a)
    while i < n and a[i] == b[i]:
        i += 1
    if len(a) < len(b):
        return a[i:] == b[i + 1:]
    return i < n and a[i + 1:] == b[i + 1:]


class _Cell:
    """The lower trie of a cell's words, and the search in it."""

    def __init__(self, depth: int, rows: list[tuple[str, int, int]]) -> None:
        rows.sort(key=lambda r: (r[2], -r[1], r[0]))
        self.words = np.array([r[0] for r in rows], object)
        self.n = np.array([r[1] for r in rows], np.int64)
        self.rank = np.argsort(np.argsort(self.words))
        vectors = np.array([r[2] for r in rows], np.int64)
        leaf, self.start = np.unique(vectors, return_index=True)
        self.stop = np.r_[self.start[1:], len(rows)]
        self.trie = _lower_trie(depth, leaf)
        self.ends = {LEVELS: np.ones(len(leaf), bool)}

    def near(self, words: np.ndarray, vectors: np.ndarray, up: np.ndarray, down: np.ndarray):
        """``(who, count, row)``: of each visitor with near words here, their
        count and the best of them (largest n, then smallest word)."""
        found_who, found_row = [], []
        for _, leaf, who, _, _, _ in self.trie.search(vectors, up, down, self.ends):
            sizes = self.stop[leaf] - self.start[leaf]
            ends = np.cumsum(sizes)
            first = 0
            while first < len(leaf):
                # leaves with so many words at once
                last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + PAIRS, "right")))
                s, w = sizes[first:last], who[first:last]
                rows = np.repeat(self.start[leaf[first:last]], s) + np.arange(s.sum()) - np.repeat(np.cumsum(s) - s, s)
                w = np.repeat(w, s)
                hit = np.fromiter(map(one_edit, words[w], self.words[rows]), bool, len(w))
                found_who.append(w[hit])
                found_row.append(rows[hit])
                first = last
        if not found_who:
            return [np.zeros(0, np.int64)] * 3
        who, row = np.concatenate(found_who), np.concatenate(found_row)
        order = np.lexsort((self.rank[row], -self.n[row], who))
        who, row = who[order], row[order]
        at = np.flatnonzero(np.r_[True, who[1:] != who[:-1]]) if len(who) else np.zeros(0, np.int64)
        return who[at], np.diff(np.r_[at, len(who)]), row[at]


NEAR = "word string, n_near long, best_n long, best string"


def _search_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by cell, its words before its visitors."""
    at, rows, cell = None, [], None
    for batch in batches:
        depth, key, part, kind = (batch.column(i).to_numpy() for i in range(4))
        edges = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (depth[1:] != depth[:-1]) | (part[1:] != part[:-1])
                                     | (kind[1:] != kind[:-1]), True])
        for i, j in zip(edges[:-1], edges[1:]):
            if i == j:
                continue
            here = (depth[i], key[i], part[i])
            if here != at:
                at, rows, cell = here, [], None
            words = np.array(batch.column(4).slice(i, j - i).to_pylist(), object)
            n, vectors, up, down = (batch.column(c).slice(i, j - i).to_numpy() for c in (5, 6, 7, 8))
            if kind[i] == 0:
                rows.extend(zip(words, n.tolist(), vectors.tolist()))
                continue
            if cell is None:
                if not rows:
                    continue        # a part without words
                cell, rows = _Cell(int(depth[i]), rows), []
            who, count, row = cell.near(words, vectors, up, down)
            yield pa.record_batch([pa.array(words[who], pa.string()), pa.array(count, pa.int64()),
                                   pa.array(cell.n[row], pa.int64()), pa.array(cell.words[row], pa.string())],
                                  ["word", "n_near", "best_n", "best"])


def _open_nodes(vectors: DataFrame, total: int, cell: int) -> _Top:
    """The top of the trie, read off counts of words a level at a time."""
    spark, children, opened = vectors.sparkSession, [], [0] if total > cell else []
    parts = {}
    while opened and len(children) < LEVELS:
        depth = len(children)
        prefix = F.shiftright("vector", 4 * (LEVELS - depth))
        # at most ``total / cell`` nodes
        below = vectors.join(F.broadcast(spark.createDataFrame([(k,) for k in opened], "node long")),
                             prefix == F.col("node"), "left_semi")
        rows = below.groupBy(F.shiftright("vector", _shift(depth)).alias("k")).count().collect()
        last = depth + 1 == LEVELS
        children.append([(r["k"], r["count"], r["count"] > cell and not last) for r in rows])
        if last:
            parts = {r["k"]: -(-r["count"] // cell) for r in rows if r["count"] > cell}
        opened = [k for k, _, is_open in children[-1] if is_open]
    top = _Top(children)
    top.parts = parts
    return top


def near_words(vocab: DataFrame) -> DataFrame:
    """``(word, n_near, best_n, best)`` of the words of ``vocab(word, n)`` that
    have near words among them: how many, and the one with the largest n (then
    the smallest)."""
    vectors = vocab.select("word", "n", _vector(F.col("word")).alias("vector"))
    total = vocab.count()
    cell = max(CELL, -(-total // MAX_OPEN))
    top = _open_nodes(vectors, total, cell)
    n_parts = max(1, total // 10_000)
    sent = (vectors.mapInArrow(_sender(top), VISIT)
            .repartition(n_parts, "depth", "cell", "part").sortWithinPartitions("depth", "cell", "part", "kind"))
    return (sent.mapInArrow(_search_cells, NEAR).groupBy("word")
            .agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("b"))
            .select("word", "n_near", (-F.col("b.m")).alias("best_n"), "b.best"))


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``(word, form)``: forms followed to the last one, by
    pointer doubling; counts grow along forms, so there is no cycle."""
    now = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        nxt = staged(now.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                              F.col("further").isNotNull().alias("moved")), "roots")
        if not nxt.where("moved").limit(1).count():
            return nxt.drop("moved")
        now = nxt.drop("moved")


def variants(docs: DataFrame, min_count: int = MIN_COUNT, times: int = TIMES) -> DataFrame:
    """One row per frequent word: ``(word, form, root, n, n_near, form_n)``."""
    spark = docs.sparkSession
    with batch_rows(spark, 1000):
        vocab = staged(vocabulary(docs, min_count), "vocabulary")
    near = staged(near_words(vocab), "near")
    is_form = F.col("best_n") >= times * F.col("n")
    known = vocab.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"))
    known = staged(known, "forms")
    roots = _roots(known.where(F.col("form").isNotNull()))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


ORACLE = f"""
WITH RECURSIVE bits AS (
  SELECT i, 0 AS k, i AS v FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
tab AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
runs AS (
  SELECT id, run, count(*) AS c FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= {MIN_LENGTH} GROUP BY ALL),
hashed AS (
  SELECT run, c, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(
      string_split(id || ':' || run, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195, unicode(x)::BIGINT - 64] END))),
    lambda acc, b: xor(acc >> 8, t[(xor(acc, b) & 255) + 1]))) AS h
  FROM runs, tab),
results AS (
  SELECT CASE WHEN h % {TYPO_MODULUS} = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
    ELSE run END AS word, c FROM hashed),
w AS (
  SELECT word, sum(c)::BIGINT AS n FROM results WHERE length(word) >= {MIN_LENGTH}
  GROUP BY word HAVING sum(c) >= {MIN_COUNT}),
dels AS (
  SELECT word, n, i, substr(word, 1, i::INT - 1) || substr(word, i::INT + 1) AS d
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS m FROM dels a JOIN dels b ON a.i = b.i AND a.d = b.d AND a.word <> b.word
  UNION SELECT d.word, w.word, w.n FROM dels d JOIN w ON w.word = d.d
  UNION SELECT w.word, d.word, d.n FROM dels d JOIN w ON w.word = d.d),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, other) AS other, max(m) AS m FROM near GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN m >= {TIMES} * w.n THEN other END AS form,
    CASE WHEN m >= {TIMES} * w.n THEN m END AS form_n
  FROM w LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS at, form AS nxt FROM forms
  UNION ALL SELECT k.word, k.nxt, f.form FROM walk k JOIN forms f ON f.word = k.nxt)
SELECT f.word, f.form, k.at AS root, f.n, f.n_near, f.form_n FROM forms f JOIN walk k ON k.word = f.word AND k.nxt IS NULL
"""

ship(__name__)

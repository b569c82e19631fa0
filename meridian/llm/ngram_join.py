"""N-gram Jaccard join by T-occurrence search with divided lists (DivideSkip).

A document's set is its distinct word shingles. Two sets x, y reach the
similarity t only if their overlap reaches T = ceil(t (|x| + |y|) / (1 + t)),
and at least ceil(t |x|). The inverted lists of x are divided: its rarest
``|x| - ceil(t |x|) + 1`` shingles have the short lists, which are merged; a
partner must occur in one of them. The other, long lists are never merged: a
candidate is probed in them, as a binary search of x's shingles in the
candidate's sorted set, and stays if T is reached.

At scale:

* Equal sets are one node, so copies are never paired.
* Shingles that recur within a scan task are counted and the most frequent
  (a bounded number) go last in every document. Any order gives the same
  links; this one keeps common passages out of the short lists.
* Short lists with the same members are merged into one.
* A list is merged inside a task, or in tiles of at most ``TILE`` members that
  meet two at a time. Members carry an odd sketch of their set: the bits in
  which two of them differ are at most as many as their sets' elements that are
  not common, so a pair whose sketches differ too much is no link.
* Only components are returned, so a task gives a spanning forest of the pairs
  that the sketches leave, not all of them. Their whole sets, written once, are
  probed. Tiles that held back pairs are merged again with the components found
  so far, at last without holding back any, so no link is lost.

Defined results: null and blank texts have the empty set and are linked with
nothing; with fewer words than a shingle, the whole sequence is one; repeated
rows and copies share a component; the component's id is its smallest
document id (null only if all its ids are null); other columns are not used.
Words and shingles are compared by 64-bit hashes. Very long texts are read in
pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import batch_rows, ship, staged, tidy, utf8, without
from meridian.operators.graph import star_edges_to_labels

COUNT_CHUNK = 4_000_000    # shingles counted at once in a task
FREQUENT_IN_CHUNK = 2      # documents of a chunk that make a shingle frequent
MAX_FREQUENT = 1_000_000   # frequent shingles that have a rank of their own
PIECE = 1 << 21            # bytes of texts that are cut into words at once
TILE = 4_096               # members of a list that meet in one task
FEW = 8                    # members of a list whose pairs are all given
SOME = 256                 # members of a list whose pairs are compared at once
HELD_BACK = 2              # rounds of spanning forests before all pairs left are tested
SKETCH_BITS = (64, 4_096)  # least and most

_MIX = np.uint64(0x9E3779B97F4A7C15)
_FINAL = np.uint64(0xD6E8FEB86659FD93)
_BASE = 0x9FB21C651E98DF25
_BYTES = np.random.default_rng(1_729).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BYTES[65:91] = _BYTES[97:123]                                     # A-Z read as a-z
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_powers: dict[int, np.ndarray] = {}


def _power(n: int) -> np.ndarray:
    """The powers 0 to n of the base, modulo 2^64."""
    if len(_powers.get(0, ())) <= n:
        steps = np.full(n + 1, _BASE, np.uint64)
        steps[0] = 1
        _powers[0] = np.multiply.accumulate(steps)
    return _powers[0]


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _FINAL
    return h ^ (h >> np.uint64(29))


def _hash_words(u: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in joined texts that begin at ``starts``, and each
    text's first word. A word's hash is a polynomial of its bytes, taken as a
    difference of prefix sums."""
    n = len(u)
    edge = np.zeros(n + 1, bool)
    edge[starts] = True
    space = _SPACE[u]
    begin = np.flatnonzero(~space & (np.r_[True, space[:-1]] | edge[:n]))
    end = np.flatnonzero(~space & (np.r_[space[1:], True] | edge[1:])) + 1
    power = _power(max(n, PIECE))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[u] * power[:n], out=sums[1:])
    # only the first word of a piece can reach beyond PIECE
    h = (sums[end] - sums[begin]) * power[PIECE - begin]
    return _finish(h + (end - begin).astype(np.uint64) * _MIX), np.searchsorted(begin, starts)


def _pieces(text: np.ndarray) -> Iterator[np.ndarray]:
    """A long text cut at white space; a longer word stays whole."""
    start = 0
    while len(text) - start > PIECE:
        cut = np.flatnonzero(_SPACE[text[start + 1:start + PIECE]]) + 1
        if not len(cut):
            more = np.flatnonzero(_SPACE[text[start + PIECE:]])
            cut = [PIECE + more[0]] if len(more) else [len(text) - start]
        yield text[start:start + int(cut[-1])]
        start += int(cut[-1])
    yield text[start:]


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes, signed 64-bit, of each of a column
    of texts (bytes)."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + PIECE, "right")) - 1)
        j = min(j, len(texts))
        part = data[offsets[i]:offsets[j]]
        if len(part) > PIECE:
            h = np.concatenate([_hash_words(x, np.zeros(1, np.int64))[0] for x in _pieces(part)])
            first = np.array([0, len(h)])
        else:
            h, first = _hash_words(part, offsets[i:j] - offsets[i])
            first = np.r_[first, len(h)]
        s = h[:max(len(h) - words + 1, 0)].copy()
        for k in range(1, words):
            s = s * _MIX + h[k:k + len(s)]
        s = _finish(s).view(np.int64)
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= words:
                yield np.unique(s[a:b - words + 1])
            elif b > a:
                yield np.array([xxhash.xxh3_64_intdigest(h[a:b].tobytes(), seed=int(b - a))], np.uint64).view(np.int64)
            else:
                yield np.zeros(0, np.int64)
        i = j


def required(size: int, pct: int) -> int:
    """The least overlap of a set of this size with any set it links with."""
    return -(-size * pct // 100)


def _key(s: np.ndarray) -> int:
    """The node that stands for all documents with this set."""
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def _describe(words: int, pct: int):
    """Rows (document id, text hash, set size, set key, sketch), and rows (null,
    null, count, shingle, null) marked ``frequent``."""
    def run(batches):
        seen = set()
        pending, size, id_type = [], 0, None

        def frequent():
            hashes, counts = np.unique(np.concatenate(pending), return_counts=True)
            top = counts >= FREQUENT_IN_CHUNK
            return pa.RecordBatch.from_arrays(
                [pa.nulls(int(top.sum()), id_type), pa.nulls(int(top.sum()), pa.int64()), pa.array(counts[top].astype(np.int64)),
                 pa.array(hashes[top]), pa.array(np.ones(int(top.sum()), bool)), pa.nulls(int(top.sum()), pa.binary())],
                names=["_id", "text_hash", "n", "key", "frequent", "sketch"])

        for batch in batches:
            id_type = batch.column("_id").type
            sizes, keys, sketches = [], [], []
            for s in shingle_sets(batch.column("_utf8"), words):
                key = _key(s)
                sizes.append(len(s))
                keys.append(key)
                sketches.append(odd_sketch(s, pct))
                if key not in seen:
                    seen.add(key)
                    pending.append(s)
                    size += len(s)
                if size >= COUNT_CHUNK:
                    yield frequent()
                    pending, size = [], 0
                    seen.clear()
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()),
                 pa.array(np.zeros(len(keys), bool)), pa.array(sketches, pa.binary())],
                names=["_id", "text_hash", "n", "key", "frequent", "sketch"])
        if pending:
            yield frequent()
    return run


def _short_lists(words: int, pct: int, frequent: np.ndarray, rank: np.ndarray):
    """The entries (shingle, node) of the short lists."""
    def run(batches):
        for batch in batches:
            out, nodes, seen = [], [], set()
            for s in shingle_sets(batch.column("_utf8"), words):
                key = _key(s)
                if not len(s) or key in seen:
                    continue
                seen.add(key)
                p = len(s) - required(len(s), pct) + 1
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
                    common = frequent[at] == s
                    rare = s[~common]
                    if len(rare) < p:
                        rest = s[common]
                        rare = np.concatenate([rare, rest[np.argsort(rank[at[common]], kind="stable")]])
                    s_short = rare[:p]
                else:
                    s_short = s[:p]
                out.append(s_short)
                nodes.append(key)
            k = np.array([len(x) for x in out], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(out) if out else np.zeros(0, np.int64)),
                 pa.array(np.repeat(np.array(nodes, np.int64), k))], names=["shingle", "node"])
    return run


def odd_sketch(s: np.ndarray, pct: int = 90) -> bytes:
    """One bit a hash class: whether the set has an odd number of elements
    there. Wider where links may differ in more elements: half a bit an element
    or more at 90 percent, two or more at 80."""
    bits = min(max(SKETCH_BITS[0], 1 << (max(0, len(s) - 1) * (100 - pct)**2 // 200).bit_length()), SKETCH_BITS[1])
    odd = np.bincount((s.view(np.uint64) >> np.uint64(24)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _whole_sets(words: int):
    """(node, sorted set as bytes) of every packed text."""
    def run(batches):
        for batch in batches:
            rows, held, seen = [], 0, set()
            texts = pa.array([zlib.decompress(x.as_py()) for x in batch.column("packed")], pa.binary())
            for s in shingle_sets(texts, words):
                key = _key(s)
                if not len(s) or key in seen:
                    continue
                seen.add(key)
                rows.append((key, s.tobytes()))
                held += len(s)
                if held > 1_000_000:
                    yield _set_rows(rows)
                    rows, held = [], 0
            if rows:
                yield _set_rows(rows)
    return run


def _set_rows(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.binary()))],
                                      names=["node", "members"])


def _packed(batches):
    """Texts packed before they are shuffled."""
    for batch in batches:
        packed = pa.array([zlib.compress(x.as_py(), 1) for x in batch.column("_utf8")], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], packed], names=[*batch.schema.names[:-1], "packed"])


def _probe(pct: int):
    """Of pairs (a, b, set_a, set_b), those whose overlap reaches T."""
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = np.frombuffer(x.as_py(), np.int64), np.frombuffer(y.as_py(), np.int64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                keep.append(100 * both >= pct * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


class _Members:
    """Rows of tiles, with sketches that can be compared at the lower of two widths."""

    def __init__(self, node: np.ndarray, n: np.ndarray, label: np.ndarray, tile: np.ndarray, sketch: list[bytes], pct: int) -> None:
        self.node, self.n, self.label, self.tile, self.sketch, self.pct = node, n, label, tile, sketch, pct
        self.width = np.array([len(x) for x in sketch], np.int64)
        self.at: dict[int, np.ndarray] = {}

    def _folded(self, width: int) -> np.ndarray:
        """The sketches of at least this width, folded to it."""
        if width not in self.at:
            out = np.zeros((len(self.node), width), np.uint8)
            for own in np.unique(self.width[self.width >= width]):
                rows = np.flatnonzero(self.width == own)
                m = np.frombuffer(b"".join([self.sketch[r] for r in rows]), np.uint8).reshape(len(rows), own)
                while m.shape[1] > width:
                    half = m.shape[1] // 2
                    m = m[:, :half] ^ m[:, half:]
                out[rows] = m
            self.at[width] = out.view(np.uint64)
        return self.at[width]

    def distance(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """At most the number of elements that the two sets don't share; one
        more than any set has where sizes alone exclude a link."""
        out = np.full(len(i), np.iinfo(np.int64).max // 1000, np.int64)
        a, b = self.n[i], self.n[j]
        near = np.minimum(a, b) * 100 >= np.maximum(a, b) * self.pct
        width = np.minimum(self.width[i], self.width[j])
        for w in np.unique(width[near]):
            at = np.flatnonzero(near & (width == w))
            m = self._folded(int(w))
            for k in range(0, len(at), 100_000):
                part = at[k:k + 100_000]
                out[part] = np.bitwise_count(m[i[part]] ^ m[j[part]]).sum(1, dtype=np.int64)
        return out

    def left(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which pairs the sketches leave, and the distances."""
        d = self.distance(i, j)
        return d * (100 + self.pct) <= (self.n[i] + self.n[j]) * (100 - self.pct), d


def _all_left(m: _Members, block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs left of many blocks (rows in order of their block), and their
    distances."""
    found, step = [], 1
    while step < len(block):
        i = np.flatnonzero(block[:-step] == block[step:])
        if not len(i):
            break
        i = i[m.label[i] != m.label[i + step]]
        ok, d = m.left(i, i + step)
        found.append((i[ok], i[ok] + step, d[ok]))
        step += 1
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


def _some(label: np.ndarray, i: np.ndarray, j: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Which of a block's pairs make a spanning forest, the nearest first."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    keep = np.zeros(len(i), bool)
    for at in np.argsort(d, kind="stable"):
        a, b = find(label[i[at]]), find(label[j[at]])
        if a != b:
            parent[a] = b
            keep[at] = True
    return keep


def _forest(m: _Members, whole: bool, hold: bool) -> tuple[list, bool]:
    """Pairs of one block that join all components that its pairs left by the
    sketches join, each the nearest of two components at its time, and whether
    others were held back. ``whole``: all rows meet, else those of different
    tiles. Without ``hold``, all pairs left across components are given."""
    label, pairs, held = m.label.copy(), [], False
    for at in range(1, len(label)):
        met = m.label[:at] != m.label[at]
        before = np.flatnonzero(met if whole else met & (m.tile[:at] != m.tile[at]))
        if not len(before):
            continue
        ok, d = m.left(before, np.full(len(before), at))
        before, d = before[ok], d[ok]
        if hold and len(before):
            across = label[before] != label[at]
            n, before, d = len(before), before[across], d[across]
            order = np.lexsort((d, label[before]))
            of = label[before][order]
            before = before[order[np.r_[True, of[1:] != of[:-1]]]] if len(order) else before
            held |= len(before) < n
            label[np.isin(label, label[before])] = label[at]
        pairs.extend((b, at) for b in before.tolist())
    return pairs, held


BLOCK = ["list", "lo", "hi"]


def _merge_blocks(pct: int, hold: bool):
    """Rows come in order of their block (two tiles of a list, or one with
    itself): the pairs (a, b) to probe, and a row without a pair for a block that held back some."""
    def solve(key, node, n, label, tile, sketch):
        edges = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1), True])
        sizes, whole = np.diff(edges), key[edges[:-1], 1] == key[edges[:-1], 2]
        many = (sizes > SOME) | ~whole
        block = np.repeat(np.arange(len(sizes)), sizes)

        def members(rows):
            return _Members(node[rows], n[rows], label[rows], tile[rows], [sketch[r] for r in rows], pct)

        out, held = [np.zeros((0, 2), np.int64)], []
        rows = np.flatnonzero(~many[block])
        i, j, d = _all_left(members(rows), block[rows])
        i, j = rows[i], rows[j]
        if hold:
            keep = np.ones(len(i), bool)
            of = block[i]
            order = np.argsort(of, kind="stable")
            cuts = np.flatnonzero(np.r_[True, of[order][1:] != of[order][:-1], True]) if len(of) else [0]
            for a, b in zip(cuts[:-1], cuts[1:]):
                mine = order[a:b]
                if sizes[of[mine[0]]] > FEW:
                    keep[mine] = _some(label, i[mine], j[mine], d[mine])
                    if not keep[mine].all():
                        held.append(edges[of[mine[0]]])
            i, j = i[keep], j[keep]
        out.append(np.column_stack([i, j]))
        for b in np.flatnonzero(many):
            rows = np.arange(edges[b], edges[b + 1])
            pairs, back = _forest(members(rows), bool(whole[b]), hold)
            if pairs:
                out.append(np.array(pairs, np.int64) + edges[b])
            if back:
                held.append(edges[b])
        pairs = np.concatenate(out)
        a, b, none = node[pairs[:, 0]], node[pairs[:, 1]], np.zeros(len(held), np.int64)
        keys = np.concatenate([key[pairs[:, 0]], key[np.array(held, np.int64)]])
        return pa.RecordBatch.from_arrays(
            [pa.array(keys[:, c]) for c in range(3)]
            + [pa.array(np.r_[np.minimum(a, b), none]), pa.array(np.r_[np.maximum(a, b), none]),
               pa.array(np.r_[np.zeros(len(a), bool), np.ones(len(held), bool)])], names=[*BLOCK, "a", "b", "held"])

    def run(batches):
        kept = None
        for batch in batches:
            now = pa.Table.from_batches([batch] if kept is None else [*kept.to_batches(), batch])
            key = np.column_stack([now.column(c).to_numpy() for c in BLOCK])
            last = int(np.flatnonzero((key != key[-1]).any(1))[-1]) + 1 if (key != key[-1]).any() else 0
            kept = now.slice(last)
            if last:
                yield solve(key[:last], *columns(now.slice(0, last)))
        if kept is not None and kept.num_rows:
            yield solve(np.column_stack([kept.column(c).to_numpy() for c in BLOCK]), *columns(kept))

    def columns(t):
        return [t.column(c).to_numpy() for c in ("node", "n", "label", "tile")] + [t.column("sketch").to_pylist()]
    return run


def _merged(entries: DataFrame) -> DataFrame:
    """The short lists that several nodes share, lists with the same members
    merged: ``list``, ``node``, ``k`` (members)."""
    shared = (entries.groupBy("shingle").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
              .where(F.col("lo") != F.col("hi")).select("shingle"))
    # nodes that several tasks have seen come once more from each of them
    lists = staged(entries.join(shared, "shingle", "left_semi").distinct(), "lists")
    members = lists.groupBy("shingle").agg(F.count(F.lit(1)).alias("k"), F.bit_xor(F.xxhash64("node")).alias("x"),
                                           F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    # one of the shingles stands for all lists with the same members
    one = members.groupBy("k", "x", "y").agg(F.min("shingle").alias("shingle"))
    return lists.join(one.select("shingle", "k"), "shingle").select(F.col("shingle").alias("list"), "node", "k")


def _blocks(lists: DataFrame, sketches: DataFrame) -> DataFrame:
    """A row for each block that a member of a list is in: of one tile, or of
    two tiles of a list that has several."""
    tiles = F.ceil(F.col("k") / TILE)
    mine = F.pmod(F.xxhash64("node"), tiles)
    return (lists.join(sketches, "node").withColumn("tile", mine)
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1)))
            .select("list", F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi"), "tile",
                    "node", "n", "sketch"))


def _pairs(blocks: DataFrame, labels: DataFrame | None, pct: int, hold: bool) -> DataFrame:
    """The written output of ``_merge_blocks``."""
    if labels is None:
        now = blocks.withColumn("label", F.col("node"))
    else:
        now = (blocks.join(labels.withColumnRenamed("root", "label"), "node", "left")
               .withColumn("label", F.coalesce("label", "node")))
    return staged(now.repartition(*BLOCK).sortWithinPartitions(*BLOCK, "n")
                  .mapInArrow(tidy(_merge_blocks(pct, hold)), "list long, lo long, hi long, a long, b long, held boolean"), "pairs")


def _sets(src: DataFrame, rows: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """The whole sets of ``nodes``, written once; each from one row that has it."""
    of_row = [F.xxhash64("_id").alias("id_hash"), "text_hash"]
    one = (rows.join(nodes, "node", "left_semi").select("node", *of_row)
           .groupBy("node").agg(F.min(F.struct("text_hash", "id_hash")).alias("row")).select("row.*").distinct())
    with batch_rows(src.sparkSession, 500):
        packed = src.select(*of_row, "_utf8").mapInArrow(tidy(_packed), "id_hash long, text_hash long, packed binary")
        return staged(packed.join(one, ["text_hash", "id_hash"], "left_semi").select("packed")
                      .mapInArrow(tidy(_whole_sets(words)), "node long, members binary"), "sets")


def _links(pairs: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """The pairs (a, b) that are links, by their whole sets."""
    pairs = pairs.where(~F.col("held")).select("a", "b").distinct()
    a = sets.select(F.col("node").alias("a"), F.col("members").alias("set_a"))
    b = sets.select(F.col("node").alias("b"), F.col("members").alias("set_b"))
    with batch_rows(pairs.sparkSession, 400):
        return staged(pairs.join(b, "b").join(a, "a").select("a", "b", "set_a", "set_b")
                      .mapInArrow(tidy(_probe(pct)), "a long, b long").distinct(), "links")


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3,
               pct: int = 90) -> DataFrame:
    """Per row of ``docs``: ``_id``, ``n_shingles`` and ``component_id``, the
    smallest id that links of similarity ``pct`` percent or more reach."""
    return _joined(docs, doc_id, text, words, pct).select("_id", "n_shingles", "component_id")


def _joined(docs: DataFrame, doc_id: str, text: str, words: int, pct: int) -> DataFrame:
    """``components`` with ``text_hash`` and ``first``: whether the row has the
    text and id that stand for its component, those of the smallest id (null
    only if all are) and, of the texts that have it, the smallest key and hash."""
    src = docs.select(F.col(doc_id).alias("_id"), F.xxhash64(utf8(text)).alias("text_hash"), utf8(text).alias("_utf8"))
    spark = docs.sparkSession
    with batch_rows(spark, 1000):
        described = staged(src.mapInArrow(tidy(_describe(words, pct)), src.select("_id").schema.add("text_hash", "long").add("n", "long").add("key", "long")
                                          .add("frequent", "boolean").add("sketch", "binary")), "sets")
    rows = described.where(~F.col("frequent")).select("_id", "text_hash", F.col("n").alias("n_shingles"), F.col("key").alias("node"))
    top = (described.where("frequent").groupBy("key").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "key").limit(MAX_FREQUENT).toArrow())
    hashes, counts = top.column("key").to_numpy(), top.column("n").to_numpy()
    by_hash = np.argsort(hashes)
    rank = np.empty(len(hashes), np.int32)
    rank[np.lexsort((hashes, counts))] = np.arange(len(hashes), dtype=np.int32)
    with batch_rows(spark, 1000):
        entries = staged(src.mapInArrow(tidy(_short_lists(words, pct, hashes[by_hash].astype(np.int64), rank[by_hash])),
                                        "shingle long, node long"), "entries")
    lists = staged(_merged(entries), "lists")
    sketches = (described.where(~F.col("frequent")).groupBy(F.col("key").alias("node"))
                .agg(F.first("n").alias("n"), F.first("sketch").alias("sketch")))       # equal in all rows of a node
    blocks = staged(_blocks(lists, sketches), "blocks")

    links, labels, sets = None, None, None
    for turn in range(HELD_BACK + 1):
        pairs = _pairs(blocks, labels, pct, hold=turn < HELD_BACK)
        blocks = staged(blocks.join(pairs.where("held").select(*BLOCK).distinct(), BLOCK, "left_semi"), "blocks")
        if sets is None:
            met = pairs.where(~F.col("held"))
            needed = met.select(F.col("a").alias("node")).unionByName(met.select(F.col("b").alias("node"))).unionByName(blocks.select("node"))
            sets = _sets(src, rows, needed.distinct(), words)
        more = _links(pairs, sets, pct)
        links = more if links is None else links.unionByName(more)
        labels = star_edges_to_labels(links)
        if blocks.isEmpty():
            break
    nulls_last = F.col("_id").isNull().alias("none")
    classes = rows.where(F.col("n_shingles") > 0).groupBy("node").agg(F.min(F.struct(nulls_last, "_id", "node", "text_hash")).alias("least"))
    rooted = staged(classes.join(labels, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "least"), "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("best"))
    found = rooted.join(least, "root").select("node", "best")
    first = (F.col("node") == F.col("best.node")) & F.col("_id").eqNullSafe(F.col("best._id")) & (F.col("text_hash") == F.col("best.text_hash"))
    full = F.col("n_shingles") > 0
    return rows.join(found, "node", "left").select(
        "_id", "text_hash", "n_shingles", F.when(full, F.col("best._id")).otherwise(F.col("_id")).alias("component_id"),
        F.when(full, first).otherwise(True).alias("first"))


def keep_first(docs: DataFrame, words: int = 5, pct: int = 80) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the
    document with the smallest id stays, and one of its repeated rows. A
    verdict holds for an id and its text; rows without words all stay."""
    found = staged(_joined(docs, "doc_id", "text", words, pct), "components")
    full = found.where(F.col("n_shingles") > 0).select("_id", F.col("text_hash").alias("_hash"), "first")
    of_row = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64(utf8("text")) == F.col("_hash"))
    kept = without(docs, full.where(~F.col("first")).drop("first").distinct(), of_row)
    repeated = full.where("first").groupBy("_id", "_hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).drop("n")
    repeated = staged(repeated, "repeated")
    if repeated.isEmpty():
        return kept
    one = kept.join(repeated, of_row, "left_semi").dropDuplicates(["doc_id", "text"])
    return without(kept, repeated, of_row).unionByName(one)


ship(__name__)

ORACLE = r"""
WITH RECURSIVE
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i+2], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT x, y FROM o JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 90 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM n UNION SELECT reach.doc_id, e.y FROM reach JOIN e ON reach.other = e.x)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.component_id, w.doc_id) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id
LEFT JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c ON c.doc_id = w.doc_id
"""

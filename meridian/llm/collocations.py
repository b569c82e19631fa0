"""Phrase collocation mining by stripes.

A prefix keys an associative counter of the words that follow it, its stripe.
Three kinds of stripe, merged elementwise, give every number of the report:

* the stripe of the empty prefix: how often each word occurs, and their sum n;
* the stripe of a pair of words: its sum is the count of the pair (a phrase may
  end there, so it counts ends as well), its elements are the counts of the
  phrases of three words, its largest element that is a candidate itself decides
  whether the pair is only a part of a longer phrase.

Tasks count whole texts into stripes, a bounded number of words at a time, and
pack the stripes by a hash bucket of their prefix, so that words are shuffled
once a packet and not once an element. The number of buckets follows the number
of words. The pairs of very frequent words (``SHARE``; at most that many such
words, by arithmetic) have their stripe cut by the next word into segments that
lie in different buckets: no bucket gets a hot prefix whole. Sums of segments
are added up by an aggregate.

Counts are over all texts; products are exact (integers of 38 digits).

Defined cases: a null text counts as empty, a null language is ``und``. Repeated
rows count each time. Equal scores are ordered by count, then phrase. A table
without rows, or without a phrase that occurs often enough, gives no rows. Words
are sequences of bytes, so broken UTF-8 passes through. Very long texts and
words are read in chunks of about a megabyte. Other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.llm.common import batch_rows, ship, staged, utf8

MIN_COUNT = 10
TOP = 2000
COVERED_PCT = 50            # a phrase goes when a longer one with this share of its count holds it
NO_LANG = "und"

CHUNK = 1 << 20             # bytes of a text that are cut into words at once
FLUSH = 2_000_000           # words that a task counts before it gives its stripes away
MAX_WORDS = 1 << 20         # distinct words that a task keeps
BUCKET_WORDS = 1_500_000    # words of the corpus for each hash bucket
SHARE = 1_000               # words above 1/SHARE of all are cut into segments

END = 0                     # the number of the mark that ends a piece
_MARK = b"."
_BREAK = re.compile(rb"[ .]")
_TABLE = bytes(0x20 if i == 0x09 else 0x2E if i in b".,;:!?\n\x0b\x0c\r" else i + 32 if 65 <= i <= 90 else i
               for i in range(256))


class _Numbers(dict):
    """Numbers of words, in the order in which they turn up."""

    def __init__(self) -> None:
        super().__init__({_MARK: END})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _chunks(data: bytes) -> Iterator[list[bytes]]:
    """The words and end marks of a text, a bounded number at a time."""
    data, start = data.translate(_TABLE), 0
    while start < len(data):
        cut = _BREAK.search(data, start + CHUNK) if len(data) - start > CHUNK else None
        end = cut.start() if cut else len(data)
        yield data[start:end].replace(b".", b" . ").split()
        start = end


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Numbers, dict[str, np.ndarray], bool]]:
    """The numbers of words in order, by language, with an end mark after each
    text; whole texts, given away after about ``FLUSH`` words. The last part
    says whether the numbers start anew after it."""
    words, parts, held = _Numbers(), {}, 0
    mark = np.zeros(1, np.int32)
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            mine = parts.setdefault(lang, [])
            for chunk in _chunks(text.as_py()):
                mine.append(np.fromiter(map(words.__getitem__, chunk), np.int32, len(chunk)))
                held += len(chunk)
            mine.append(mark)
            full = len(words) > MAX_WORDS
            if full or held > FLUSH:
                yield words, {k: np.concatenate(v) for k, v in parts.items()}, full
                words, parts, held = _Numbers() if full else words, {}, 0
    yield words, {k: np.concatenate(v) for k, v in parts.items()}, True


def _crc(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stripe of the empty prefix, by language."""
    sums: dict[str, np.ndarray] = {}
    for words, seq, last in _numbered(batches):
        for lang, ids in seq.items():
            got, before = np.bincount(ids, minlength=len(words)), sums.get(lang)
            if before is not None:
                got[:len(before)] += before
            sums[lang] = got
        if last:
            names = np.array(list(words), dtype=object)
            for lang, got in sums.items():
                got[END] = 0
                at = np.flatnonzero(got)
                for i in range(0, len(at), 100_000):
                    part = at[i:i + 100_000]
                    yield pa.record_batch([pa.array([lang] * len(part), pa.string()),
                                           pa.array(names[part], pa.binary()), pa.array(got[part], pa.int64())],
                                          ["lang", "word", "f"])
            sums = {}


def _planes(x: np.ndarray) -> bytes:
    """32-bit numbers by their bytes' places, which compresses well."""
    return np.ascontiguousarray(x, np.int32).view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers_of(data: memoryview, at: int, n: int) -> tuple[np.ndarray, int]:
    raw = np.frombuffer(data, np.uint8, 4 * n, at).reshape(4, n).T
    return np.ascontiguousarray(raw).view(np.int32).reshape(n), at + 4 * n


PACKET = "lang string, bucket int, n_prefixes int, n_elements int, size int, stripes binary"
_PACKET_NAMES = ["lang", "bucket", "n_prefixes", "n_elements", "size", "stripes"]
_PACKET_TYPES = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]


def _pack(names: np.ndarray, a, b, c, count) -> tuple[int, int, int, bytes]:
    """The stripes of some prefixes as bytes: words, prefixes, their lengths,
    the next words and counts. Elements come ordered by prefix."""
    used = np.unique(np.concatenate((a, b, c)))
    starts = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    text = b" ".join(names[used])
    own = [np.searchsorted(used, x) for x in (a[starts], b[starts], c)]
    raw = b"".join([_planes(np.array([len(text)])), text, _planes(own[0]), _planes(own[1]),
                    _planes(np.diff(np.r_[starts, len(a)])), _planes(own[2]), _planes(count)])
    return len(starts), len(a), len(raw), pa.Codec("zstd").compress(raw, asbytes=True)


def _unpack(n_prefixes: int, n_elements: int, size: int, stripes: bytes):
    """(words, prefix words a and b, next words, counts) of one packet, an element each."""
    raw = memoryview(pa.Codec("zstd").decompress(stripes, decompressed_size=size, asbytes=True))
    (length,), at = _numbers_of(raw, 0, 1)
    words, at = bytes(raw[at:at + length]).split(b" "), at + int(length)
    a, at = _numbers_of(raw, at, n_prefixes)
    b, at = _numbers_of(raw, at, n_prefixes)
    lengths, at = _numbers_of(raw, at, n_prefixes)
    c, at = _numbers_of(raw, at, n_elements)
    count, at = _numbers_of(raw, at, n_elements)
    return words, np.repeat(a, lengths), np.repeat(b, lengths), c, count.astype(np.int64)


def _count_triples(ids: np.ndarray, start: int, v: int) -> tuple[np.ndarray, ...]:
    """Pairs with the word (or end) after them, distinct and in order, that
    begin at ``FLUSH`` places of a sequence: (a, b, c, count). So few places
    hold at most two million words, so three numbers fit 63 bits."""
    part = ids[start:start + FLUSH + 2].astype(np.int64)
    present = np.flatnonzero(np.bincount(part, minlength=v))
    if present[0] != END:
        present = np.r_[END, present]
    place = np.zeros(v, np.int64)
    place[present] = np.arange(len(present))
    part, n = place[part], len(present)
    a = part[:FLUSH]
    b = np.r_[part[1:], END][:len(a)]
    c = np.r_[part[2:], END, END][:len(a)]
    at = np.flatnonzero((a != END) & (b != END))
    key, count = np.unique((a[at] * n + b[at]) * n + c[at], return_counts=True)
    return present[key // n // n], present[key // n % n], present[key % n], count


def _stripe_maker(n_buckets: int, hot: dict[tuple[str, bytes], int]):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc, names = np.zeros(0, np.uint64), np.zeros(0, object)
        for words, seq, last in _numbered(batches):
            fresh = list(words)[len(names):]
            crc, names = np.r_[crc, _crc(fresh)], np.r_[names, np.array(fresh, object)]
            for lang, ids in seq.items():
                cut = np.ones(len(words), np.uint64)
                for (of, word), segments in hot.items():
                    if of == lang and word in words:
                        cut[words[word]] = segments
                salt = np.uint64(zlib.crc32(lang.encode()) * 0x9E3779B1)
                for start in range(0, len(ids), FLUSH):
                    a, b, c, count = _count_triples(ids, start, len(words))
                    h = _mix((crc[a] << np.uint64(32)) ^ crc[b] ^ salt)
                    segments = np.minimum(cut[a], cut[b])
                    h = np.where(segments > 1, _mix(h + np.uint64(1) + crc[c] % segments), h)
                    bucket = (h % np.uint64(n_buckets)).astype(np.int64)
                    order = np.argsort(bucket, kind="stable")
                    bucket = bucket[order]
                    edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(a) else np.zeros(1, np.int64)
                    for i, j in zip(edges[:-1], edges[1:]):
                        o = order[i:j]
                        row = (lang, int(bucket[i]), *_pack(names, a[o], b[o], c[o], count[o]))
                        yield pa.record_batch([pa.array([x], t) for x, t in zip(row, _PACKET_TYPES)], _PACKET_NAMES)
            if last:
                crc, names = np.zeros(0, np.uint64), np.zeros(0, object)
    return make


def _sums(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and each value summed over them."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[starts], *(np.add.reduceat(v[order], starts) for v in values)


COUNTED = "lang string, w1 binary, w2 binary, w3 binary, a long, longest long"


def _merger(min_count: int, hot: dict[tuple[str, bytes], int]):
    def merge(table: pa.Table) -> pa.Table:
        """All packets of one bucket and language, merged elementwise: its
        phrases of three words, and its pairs with the largest element of
        their stripe. A pair whose stripe lies in segments gives its part."""
        lang = table.column("lang")[0].as_py()
        words, parts = _Numbers(), []
        for i in range(table.num_rows):
            names, a, b, c, count = _unpack(*(table.column(k)[i].as_py() for k in
                                              ("n_prefixes", "n_elements", "size", "stripes")))
            own = np.fromiter(map(words.__getitem__, names), np.int64, len(names))
            parts.append((own[a], own[b], own[c], count))
        a, b, c, count = (np.concatenate(x) for x in zip(*parts))
        parts, v = None, len(words)
        pairs, prefix = np.unique(a * v + b, return_inverse=True)
        key, count = _sums(prefix * np.int64(v) + c, count)
        prefix, c = key // v, key % v
        starts = np.searchsorted(prefix, np.arange(len(pairs)))
        total = np.add.reduceat(count, starts)
        longest = np.maximum.reduceat(np.where((c == END) | (count < min_count), 0, count), starts)
        a, b = pairs // v, pairs % v
        mine = {words[w] for k, w in hot if k == lang and w in words}
        cut = np.zeros(v, bool)
        cut[list(mine)] = True
        keep = np.flatnonzero((total >= min_count) | (cut[a] & cut[b]))
        long = np.flatnonzero((count >= min_count) & (c != END))
        names = np.array(list(words), object)
        w1, w2 = (names[np.r_[x[keep], x[prefix[long]]]] for x in (a, b))
        return pa.table([pa.array([lang] * len(w1), pa.string()), pa.array(w1, pa.binary()), pa.array(w2, pa.binary()),
                         pa.array([None] * len(keep) + list(names[c[long]]), pa.binary()),
                         pa.array(np.r_[total[keep], count[long]], pa.int64()),
                         pa.array(np.r_[longest[keep], np.zeros(len(long), np.int64)], pa.int64())],
                        ["lang", "w1", "w2", "w3", "a", "longest"])
    return merge


def count_phrases(docs: DataFrame, min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written tables: ``(lang, word, f)`` of all words, ``(lang, w1, w2, a,
    longest)`` and ``(lang, w1, w2, w3, a)`` of the phrases of two and three
    words that occur at least ``min_count`` times. Words are bytes."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang"), F.lit(NO_LANG)).alias("lang"), utf8("text").alias("text"))
    with batch_rows(spark, 256):
        words = staged(texts.mapInArrow(_count_words, "lang string, word binary, f long")
                       .groupBy("lang", "word").agg(F.sum("f").alias("f")), "words")
        n = words.agg(F.coalesce(F.sum("f"), F.lit(0))).collect()[0][0]
        # at most SHARE words can have more than 1/SHARE of all
        hot = {(r["lang"], bytes(r["word"])): -(-r["f"] * SHARE // n)
               for r in words.where(F.col("f") > n // SHARE + 1).collect()} if n > BUCKET_WORDS else {}
        packets = texts.mapInArrow(_stripe_maker(n // BUCKET_WORDS + 1, hot), PACKET)
        counted = staged(packets.groupBy("lang", "bucket").applyInArrow(_merger(min_count, hot), COUNTED), "phrases")
    pairs = (counted.where(F.col("w3").isNull()).groupBy("lang", "w1", "w2")
             .agg(F.sum("a").alias("a"), F.max("longest").alias("longest")).where(F.col("a") >= min_count))
    return words, pairs, counted.where(F.col("w3").isNotNull()).drop("longest")


# Counts fit 14 digits, their products 37: the cuts with their whole scores.
SCORED = """transform(cuts, (x, k) -> struct(
    (cast(a as decimal(14, 0)) * cast(a as decimal(14, 0)) * cast(1000000 as decimal(7, 0)))
    div (cast(x.l as decimal(14, 0)) * cast(x.r as decimal(14, 0))) as score, k, x.l, x.r))"""


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP,
                 covered_pct: int = COVERED_PCT) -> DataFrame:
    """The ``top`` collocations of each language: ``(lang, rank, phrase, a, l,
    r, n, score)``. A phrase of two or three words is scored by its weakest cut
    into a first part and a rest that occur l and r times; it goes when a longer
    one that holds it has ``covered_pct`` percent of its count."""
    words, pairs, triples = count_phrases(docs, min_count)
    pairs = staged(pairs, "pairs")
    n = words.groupBy("lang").agg(F.sum("f").alias("n"))
    often = words.where(F.col("f") >= min_count)

    def count_of(word: str, name: str) -> DataFrame:
        return often.select("lang", F.col("word").alias(word), F.col("f").alias(name))

    def phrase(*parts: str) -> Column:
        return F.concat_ws(" ", *[F.col(p).cast("string") for p in parts])

    # parts of a phrase occur at least as often as it does, so no join loses a row
    ends = triples.groupBy("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2")).agg(F.max("a").alias("ending"))
    covered = 100 * F.greatest(F.col("longest"), F.coalesce("ending", F.lit(0))) >= covered_pct * F.col("a")
    two = (pairs.join(ends, ["lang", "w1", "w2"], "left").where(~covered)
           .join(count_of("w1", "l"), ["lang", "w1"]).join(count_of("w2", "r"), ["lang", "w2"])
           .select("lang", phrase("w1", "w2").alias("phrase"), "a", F.array(F.struct("l", "r")).alias("cuts")))
    three = (triples
             .join(pairs.select("lang", "w1", "w2", F.col("a").alias("l2")), ["lang", "w1", "w2"])
             .join(pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("r1")),
                   ["lang", "w2", "w3"])
             .join(count_of("w1", "l1"), ["lang", "w1"]).join(count_of("w3", "r2"), ["lang", "w3"])
             .select("lang", phrase("w1", "w2", "w3").alias("phrase"), "a",
                     F.array(F.struct(F.col("l1").alias("l"), F.col("r1").alias("r")),
                             F.struct(F.col("l2").alias("l"), F.col("r2").alias("r"))).alias("cuts")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return (two.unionByName(three).withColumn("cut", F.array_min(F.expr(SCORED)))
            .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
            .withColumn("rank", rank).where(F.col("rank") <= top).join(n, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = f"""
WITH pieces AS (
  SELECT coalesce(lang, '{NO_LANG}') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
f AS (
  SELECT lang, k, p, count(*) AS f FROM (
    SELECT lang, 1 AS k, unnest(ws) AS p FROM w
    UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM w
    UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) FROM w)
  GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, p, f AS a, string_split(p, ' ') AS ws FROM f WHERE k > 1 AND f >= {MIN_COUNT}),
cover AS (
  SELECT lang, p, max(a) AS most FROM (
    SELECT lang, a, unnest([ws[1] || ' ' || ws[2], ws[2] || ' ' || ws[3]]) AS p FROM cand WHERE k = 3) GROUP BY ALL),
kept AS (
  SELECT c.* FROM cand c LEFT JOIN cover USING (lang, p) WHERE c.k = 3 OR most IS NULL OR 100 * most < {COVERED_PCT} * a),
cuts AS (
  SELECT lang, p, a, ws, unnest(range(1, k)) AS cut FROM kept),
scores AS (
  SELECT c.lang, c.p, c.a, cut, l.f AS l, r.f AS r,
    (1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f) AS score
  FROM cuts c
  JOIN f l ON l.lang = c.lang AND l.p = array_to_string(ws[1:cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.p = array_to_string(ws[cut + 1:], ' ')),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank FROM lowest)
SELECT lang, rank::INTEGER AS rank, p AS phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
  score::BIGINT AS score
FROM ranked JOIN n USING (lang) WHERE rank <= {TOP}
"""

ship(__name__)

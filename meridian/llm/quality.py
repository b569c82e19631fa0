"""Quality rules by cross-document line frequency.

Each text is measured once. Its lines are normalised (A-Z lower-cased, digits
as 0, runs of white space as one space) and hashed; per host, the distinct
texts that carry a line are counted. Lines above the host's limit count as
boilerplate and are removed from the text. A document is rejected when its base
measures fail, or when too little of it is left without its boilerplate.

Defined results: a null or blank text has no words and fails the base rules; a
null host is a host of its own; exact copies count as one document for the
line counts, so copying a page does not make its lines boilerplate; repeated
rows get the same verdict each; texts that share an id, or have none, are judged
each on its own; other columns are kept as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meridian.llm.common import MAX_BROADCAST_KEYS, WIDE_ROWS, batch_rows, ship, staged, tidy, utf8, without

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 10            # fewer words fail
MAX_REPEAT_PCT = 20       # more words (percent) in repeated 5-word windows fail
MIN_LINE_DOCS = 10        # a line in at most so many documents of a host is never boilerplate
MAX_LINE_PCT = 5          # of a small host, nor is one in at most so many percent of them
MAX_LINE_DOCS = 100       # a line in more documents of a host is boilerplate whatever their share
MIN_LEFT_PCT = 25         # a document keeps at least so many percent of its words
SALTS = 16

_DIGITS = bytes.maketrans(b"123456789", b"000000000")

MEASURES = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()), T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()),
    T.StructField("line_hash", T.ArrayType(T.LongType())),
    T.StructField("line_words", T.ArrayType(T.LongType())),
])


def repeated_words(words: list[bytes], window: int = 5) -> int:
    """Words inside ``window``-word windows that occur twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    base = len(number)
    key, room = ids[:n].copy(), base
    for k in range(1, window):
        if room > (1 << 62) // base:  # renumber the prefixes; keys stay exact
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
            room = n
        key = key * base + ids[k:k + n]
        room *= base
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    hit = np.zeros(n, dtype=np.int64)
    hit[order[1:][same]] = 1
    hit[order[:-1][same]] = 1
    edges[:n] += hit
    edges[window:] -= hit
    return int((np.cumsum(edges[:-1]) > 0).sum())


def line_key(words: list[bytes]) -> int:
    """The hash of the normalised line of these words."""
    return xxhash.xxh3_64_intdigest(b" ".join(words).lower().translate(_DIGITS)) - (1 << 63)


def without_lines(text: str, hashes: list[int]) -> str:
    """The text without the lines of these hashes; all others stay as they are."""
    gone = set(hashes)
    return b"\n".join(x for x in text.encode().split(b"\n") if not ((w := x.split()) and line_key(w) in gone)).decode()


def measure(text: bytes) -> tuple:
    lines = [x for x in text.split(b"\n") if x.strip()]
    split = [x.split() for x in lines]
    words = [w for x in split for w in x]
    joined = b"".join(words)
    symbols = len(joined) - len(joined.translate(None, SYMBOLS))
    hashes: dict[int, int] = {}
    for x in split:
        key = line_key(x)
        hashes[key] = hashes.get(key, 0) + len(x)
    return (len(words), len(joined.decode("utf-8")), symbols, len(lines) - len(set(lines)),
            repeated_words(words), list(hashes), list(hashes.values()))


def _measure_batches(batches):
    types = [pa.int64()] * 5 + [pa.list_(pa.int64())] * 2
    for batch in batches:
        rows = [measure(x) for x in batch.column("_utf8").to_pylist()]
        cols = list(zip(*rows)) if rows else [()] * 7
        new = [pa.array(c, t) for c, t in zip(cols, types)]
        keep = [n for n in batch.schema.names if n != "_utf8"]
        yield pa.RecordBatch.from_arrays([batch.column(n) for n in keep] + new,
                                         names=[*keep, *MEASURES.names])


def _host(host: str) -> Column:
    return F.coalesce(F.col(host).cast("string"), F.lit(""))


def measures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
             host: str = "source") -> DataFrame:
    """One row per document: ``_id``, ``_host``, ``text_hash``, the base
    measures, and the hash and word count of each distinct normalised line."""
    src = docs.select(F.col(doc_id).alias("_id"),
                      _host(host).alias("_host"), F.xxhash64(utf8(text)).alias("text_hash"),
                      utf8(text).alias("_utf8"))
    schema = T.StructType([f for f in src.schema.fields if f.name != "_utf8"] + MEASURES.fields)
    return src.mapInArrow(tidy(_measure_batches), schema)


def line_quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
                 min_line_docs: int = MIN_LINE_DOCS, max_line_pct: int = MAX_LINE_PCT,
                 min_left_pct: int = MIN_LEFT_PCT, max_line_docs: int = MAX_LINE_DOCS) -> DataFrame:
    """Per row of ``docs``: ``_id``, ``_host``, ``text_hash``, measures,
    ``removed_words`` (words of boilerplate lines), ``base_failed``, ``kept``.
    ``max_line_docs``: a line in more documents of a host is boilerplate
    whatever their share, so the limit does not grow with the host."""
    return _judged(docs, doc_id, text, host, min_line_docs, max_line_pct, min_left_pct, max_line_docs).drop("removed_lines")


def _judged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
            min_line_docs: int = MIN_LINE_DOCS, max_line_pct: int = MAX_LINE_PCT,
            min_left_pct: int = MIN_LEFT_PCT, max_line_docs: int = MAX_LINE_DOCS) -> DataFrame:
    """``line_quality`` with ``removed_lines``, the hashes of the boilerplate lines."""
    with batch_rows(docs.sparkSession, WIDE_ROWS):
        m = staged(measures(docs, doc_id, text, host), "quality")
    hosts = m.groupBy("_host").agg(F.count_distinct("text_hash").alias("host_docs"))
    lines = m.select("_id", "_host", "text_hash", F.inline(F.arrays_zip(F.col("line_hash").alias("line"), F.col("line_words").alias("w"))))
    counts = (lines.select("_host", "line", "text_hash").distinct()
              .groupBy("_host", "line").agg(F.count(F.lit(1)).alias("docs"))
              .where(F.col("docs") > min_line_docs))
    # a boilerplate line is in more than min_line_docs documents of its host, so
    # this side is small; its rows are repeated for each salt of the hot side
    above = (F.col("docs") * 100 > F.col("host_docs") * max_line_pct) | (F.col("docs") > max_line_docs)
    common = (counts.join(hosts, "_host")
              .where(above)
              .select("_host", "line", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    salted = lines.withColumn("salt", F.pmod(F.hash("_id", "text_hash"), F.lit(SALTS)))
    removed = (salted.join(common, ["_host", "line", "salt"])
               .select("_id", "_host", "text_hash", "line", "w")
               .distinct()  # repeated rows of a document
               .groupBy("_id", "_host", "text_hash").agg(F.sum("w").alias("removed"), F.collect_list("line").alias("removed_lines")))
    r = removed.select(F.col("_id").alias("r_id"), F.col("_host").alias("r_host"),
                       F.col("text_hash").alias("r_hash"), "removed", "removed_lines")
    out = m.drop("line_hash", "line_words").join(
        r, F.col("_id").eqNullSafe(F.col("r_id")) & (F.col("_host") == F.col("r_host"))
        & (F.col("text_hash") == F.col("r_hash")), "left")
    gone = F.coalesce("removed", F.lit(0))
    failed = ((F.col("n_words") < MIN_WORDS)
              | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PCT))
    left = F.col("n_words") - gone
    depleted = (left < MIN_WORDS) | (left * 100 < F.col("n_words") * min_left_pct)
    return out.select("_id", "_host", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", gone.alias("removed_words"), failed.alias("base_failed"),
                      (~failed & ~depleted).alias("kept"), "removed_lines")


@F.arrow_udf(T.StringType())
def _without_lines(texts: pa.Array, hashes: pa.Array) -> pa.Array:
    return pa.array([None if t is None else without_lines(t, h) for t, h in zip(texts.to_pylist(), hashes.to_pylist())], pa.string())


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose text is kept (by id, host and text), with
    their columns: ``text`` without its boilerplate lines, and ``n_chars``, if
    there, of what is left of a text that lost some."""
    verdict = _judged(docs, **options).select("_id", "_host", F.col("text_hash").alias("_hash"), "kept", "removed_lines").distinct()
    verdict = staged(verdict.where(~F.col("kept") | F.col("removed_lines").isNotNull()), "verdicts")
    of_row = F.col("doc_id").eqNullSafe(F.col("_id")) & (_host("source") == F.col("_host")) & (F.xxhash64(utf8("text")) == F.col("_hash"))
    good = without(docs, verdict.where(~F.col("kept")).drop("kept", "removed_lines"), of_row)
    cut = verdict.where("kept").select("_id", "_host", "_hash", F.col("removed_lines").alias("_lines"))
    if cut.isEmpty():
        return good
    small = cut.agg(F.sum(F.size("_lines") + 4)).collect()[0][0] <= MAX_BROADCAST_KEYS
    met = good.join(F.broadcast(cut) if small else cut, of_row, "left")
    # a text that loses nothing isn't sent to Python
    met = met.withColumn("_left", _without_lines(F.when(F.col("_lines").isNotNull(), F.col("text")), "_lines"))
    out = {"text": F.coalesce("_left", "text")}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(F.col("_left").isNotNull(), F.length("_left")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return met.select(*[out[c].alias(c) if c in out else F.col(c) for c in docs.columns])


ship(__name__)

ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, host, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (
  SELECT doc_id, t, i, array_to_string(ws[i:i+4], chr(31)) AS g
  FROM (SELECT doc_id, t, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
rep AS (
  SELECT doc_id, t, count(DISTINCT p) AS n FROM (
    SELECT doc_id, t, unnest(range(i, i + 5)) AS p
    FROM (SELECT doc_id, t, i, count(*) OVER (PARTITION BY doc_id, t, g) AS c FROM win) WHERE c > 1)
  GROUP BY ALL),
line AS (
  SELECT doc_id, host, t, norm, sum(n) AS n FROM (
    SELECT doc_id, host, t, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n,
           regexp_replace(translate(array_to_string(regexp_extract_all(l, '[^\x20\x09-\x0D]+'), ' '),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[1-9]', '0', 'g') AS norm
    FROM (SELECT doc_id, host, t, unnest(ls) AS l FROM w)) GROUP BY ALL),
hosts AS (SELECT host, count(DISTINCT t) AS host_docs FROM d GROUP BY host),
common AS (
  SELECT host, norm FROM (SELECT host, norm, count(DISTINCT t) AS docs FROM line GROUP BY ALL) JOIN hosts USING (host)
  WHERE docs > 10 AND (docs * 100 > host_docs * 5 OR docs > 100)),
gone AS (SELECT doc_id, host, t, sum(n) AS removed FROM line JOIN common USING (host, norm) GROUP BY ALL),
m AS (
  SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         len(regexp_extract_all(w.t, '[#*$%&|<>]')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
         coalesce(removed, 0) AS removed_words
  FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id AND rep.t = w.t
         LEFT JOIN gone ON gone.doc_id = w.doc_id AND gone.t = w.t AND gone.host = w.host),
b AS (SELECT *, n_words < 10 OR n_repeat_words * 100 > n_words * 20 AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       removed_words::BIGINT AS removed_words, base_failed,
       NOT base_failed AND n_words - removed_words >= 10
         AND (n_words - removed_words) * 100 >= n_words * 25 AS kept
FROM b
"""

"""Collocations against a brute-force count, and odd inputs."""
import random
import re
from collections import Counter

import pytest

from meridian.llm import collocations as C

SEP, WORD = re.compile("[.,;:!?\x0a-\x0d]"), re.compile("[^\x20\x09]+")


def brute(rows, min_count, top, covered=50):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in SEP.split((text or "").translate({i: i + 32 for i in range(65, 91)})):
            ws = WORD.findall(piece)
            n[lang] += len(ws)
            for k in (1, 2, 3):
                f.update((lang, *ws[i:i + k]) for i in range(len(ws) - k + 1))
    cand = {k: a for k, a in f.items() if len(k) > 2 and a >= min_count}
    out = []
    for k, a in cand.items():
        lang, ws = k[0], k[1:]
        if any(c[0] == lang and len(c) > len(k) and 100 * b >= covered * a
               and any(c[i:i + len(ws)] == ws for i in range(1, len(c))) for c, b in cand.items()):
            continue
        score, _, left, right = min(
            (1_000_000 * a * a // (f[(lang, *ws[:i])] * f[(lang, *ws[i:])]), i, f[(lang, *ws[:i])], f[(lang, *ws[i:])])
            for i in range(1, len(ws)))
        out.append((lang, " ".join(ws), a, left, right, n[lang], score))
    best = []
    for lang in n:
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        best += [(r[0], i, *r[1:]) for i, r in enumerate(mine, 1)]
    return sorted(best)


def run(spark, rows, **kw):
    docs = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "1 as word", "'x' as bucket", "2L as f")
    got = C.collocations(docs, **kw)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in got.collect())


def corpus(seed, n=150):
    rnd = random.Random(seed)
    words = ["a", "b", "Cc", "dé", "É", "x1", "\x85q", "zz"]
    texts = [(rnd.choice(["en", "de", None, ""]),
              "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "\t ", ". ", ",", "\n"]) for _ in range(rnd.randrange(60))))
             for _ in range(n)]
    return texts + [("en", None), ("en", ""), (None, " . , \n"), ("fr", "only one text here")] + texts[:20]


@pytest.mark.parametrize("seed", [1, 2])
def test_collocations_equal_brute_force(spark, seed):
    rows = corpus(seed)
    for kw in ({"min_count": 3, "top": 40}, {"min_count": 8, "top": 2000}):
        assert run(spark, rows, **kw) == brute(rows, kw["min_count"], kw["top"])


def test_cut_stripes_and_many_parts(spark, monkeypatch):
    """Hot pairs in segments, several buckets, small parts and chunks."""
    for name, value in {"BUCKET_WORDS": 200, "FLUSH": 90, "MAX_WORDS": 20, "CHUNK": 40, "SHARE": 30}.items():
        monkeypatch.setattr(C, name, value)
    rows = corpus(3) + [("en", "a b " + w) for w in "cdefghij" * 20]     # a hot pair with many extensions
    assert run(spark, rows, min_count=3) == brute(rows, 3, 2000)


def test_products_beyond_64_bits(spark):
    words = spark.createDataFrame([("en", "x", 4_000_000_000_000, 5_000_000_000_000, 7_000_000_000_000)],
                                  "lang string, phrase string, a long, l long, r long")
    got = words.selectExpr("array(struct(l, r)) as cuts", "a").selectExpr(C.SCORED).first()[0]
    assert got[0].score == 1_000_000 * 4_000_000_000_000**2 // (5_000_000_000_000 * 7_000_000_000_000)


def test_no_rows_and_long_texts(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, None), ("en", "")]) == []
    long_word, long_text = "w" * 3_000_000, "one two, " * 400_000
    got = run(spark, [("en", long_text), ("en", f"{long_word} {long_word}")])
    assert got == [("en", 1, "one two", 400_000, 400_000, 400_000, 800_002, 1_000_000)]

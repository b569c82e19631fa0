"""Spelling variants against brute force over all pairs, and odd inputs."""
import random
import re
import zlib
from collections import Counter

import pytest

from meridian.llm import spelling as S

COLS = ["word", "form", "root", "n", "n_near", "form_n"]


def distance_is_one(a, b):
    """By the full table of edit distances."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1] == 1


def brute(rows, min_count=5, times=5):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({i: i + 32 for i in range(65, 91)})
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    vocab = {w: n for w, n in counts.items() if len(w) >= 6 and n >= min_count}
    near = {w: [v for v in vocab if abs(len(v) - len(w)) < 2 and distance_is_one(w, v)] for w in vocab}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-vocab[v], v), default=None)
        if best is not None and vocab[best] >= times * vocab[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w
    return sorted((w, form.get(w), root(w), n, len(near[w]), vocab[form[w]] if w in form else None)
                  for w, n in vocab.items())


def run(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as word", "1 as n", "2 as part")
    got = S.variants(docs)
    assert got.columns == COLS
    return sorted(tuple(r) for r in got.collect())


def corpus(seed):
    rnd = random.Random(seed)
    alphabet = "aeinrstéÉüb"
    words = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(5, 10))) for _ in range(60)]
    for w in list(words):
        for _ in range(3):
            i, c = rnd.randrange(len(w)), rnd.choice(alphabet)
            words.append(rnd.choice([w[:i] + w[i + 1:], w[:i] + c + w[i:], w[:i] + c + w[i + 1:], w[::-1]]))
    weights = [rnd.choice([1, 3, 10, 60, 300]) for _ in words]
    rows = []
    for doc in range(250):
        ws = rnd.choices(words, weights, k=60)
        rows.append((doc, "".join(w.upper() if rnd.random() < .1 else w for w in ws for w in (w, rnd.choice(" ,1\n")))))
    return rows + [(7, None), (8, ""), (9, "1 2 ; ..."), (None, "banane " * 30), (None, "bananen " * 6)] + rows[:5]


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_equal_brute_force(spark, seed):
    rows = corpus(seed)
    got = run(spark, rows)
    assert got == brute(rows) and sum(r[1] is not None for r in got) > 10


def test_deep_top_and_cut_leaves(spark, monkeypatch):
    """Cells of three words: a top of many levels, and leaves dealt out."""
    for name, value in {"CELL": 3, "PAIRS": 4, "HELD": 50}.items():
        monkeypatch.setattr(S, name, value)
    rows = corpus(3) + [(1000 + i, " ".join("".join(random.Random(j).sample("stainre", 7)) for j in range(12)))
                        for i in range(6)]
    assert run(spark, rows) == brute(rows)


def test_no_rows_and_long_words(spark):
    assert run(spark, []) == [] and run(spark, [(1, None), (2, "few words only here")]) == []
    a, b = "ab" * 600_000, "ab" * 600_000 + "c"
    got = run(spark, [(i, f"{a} {b}") for i in range(10, 15)] + [(9, b + " " + a + " " + "abcdef " * 5)])
    assert [(len(r[0]), r[3], r[4]) for r in got] == [(1_200_000, 6, 1), (1_200_001, 6, 1), (6, 5, 0)]


def test_forms_are_followed_to_the_last(spark):
    chain = ["abcdef", "abcdefg", "abcdefgh", "abcdefghi"]
    rows = [(1, " ".join(w for i, w in enumerate(chain) for _ in range(6 * 5**i)))]
    got = {r[0]: r[1:] for r in run(spark, rows)}
    want = {r[0]: r[1:] for r in brute(rows)}
    assert got == want and len({r[1] for r in got.values()}) == 1

"""Quality rules, n-gram join, toxicity, decontamination, BPE: brute force,
round trips and defined results for odd inputs."""
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from meridian.llm import bpe, common, decontaminate, ngram_join, quality, token_file, toxicity

WORDS = [a + b for a in "ka lo mi ru se ta vo ne pi du".split() for b in "ran sto lem nik bor tas vel gim".split()]
ODD = [None, "", "   \n\t ", "one", "one two", "one two three", "É\u00a0x\u3000y", "a\x1cb", "<|endoftext|> end", "x" * 5000]


def prose(rnd, n):
    return " ".join(rnd.choice(WORDS) for _ in range(n))


# ------------------------------------------------------------------ quality
def brute_repeat(words):
    seen = {}
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i:i + 5]), []).append(i)
    hit = {p for at in seen.values() if len(at) > 1 for i in at for p in range(i, i + 5)}
    return len(hit)


def test_repeated_words_match_brute_force():
    rnd = random.Random(1)
    for size in (2, 3, 40):
        for n in (0, 4, 5, 6, 30, 200):
            words = [f"w{rnd.randrange(size)}".encode() for _ in range(n)]
            assert quality.repeated_words(words) == brute_repeat(words)
    many = [str(i).encode() for i in range(9000)]  # more distinct words than five fit into one key
    assert quality.repeated_words(many + many[:7]) == 14


def test_quality_counts_documents_per_host(spark, make_docs):
    rnd = random.Random(2)
    common = prose(rnd, 30)
    texts = [common + "\n" + prose(rnd, 40) for _ in range(30)]
    texts += [common.upper() for _ in range(2)]            # nothing but the common line; copies
    texts += ["short"] + ODD
    docs = make_docs(texts)
    got = {r._id: r for r in quality.line_quality(docs, min_line_docs=5).collect()}
    assert len(got) == len(texts)
    assert all(got[i].removed_words == 30 and got[i].kept for i in range(30))
    assert not got[30].kept and not got[30].base_failed and got[31].removed_words == 30
    assert got[32].base_failed and not got[32].kept
    other = {r._id: r for r in quality.line_quality(docs, min_line_docs=31).collect()}
    assert other[30].kept and other[0].removed_words == 0  # copies count as one document
    kept = quality.keep_good(docs, min_line_docs=5)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(range(30))


def test_quality_removes_the_lines_above_the_limit(spark, make_docs):
    rnd = random.Random(31)
    common = prose(rnd, 12)
    own = [prose(rnd, 30) for _ in range(20)]
    texts = [f"  {common.upper()}\n\n{x} \n{common}  \n" for x in own[:12]]  # in other letters and spaces, twice
    texts += [f"{x}\n" for x in own[12:]] + [common + "\né " + own[0], None]
    kept = quality.keep_good(make_docs(texts), min_line_docs=5)
    got = {r.doc_id: r for r in kept.collect()}
    assert set(got) == set(range(21)) and kept.columns == make_docs(["x"]).columns
    assert kept.schema == make_docs(["x"]).schema
    assert all(got[i].text == f"\n{own[i]} \n" for i in range(12))
    assert all(got[i].text == texts[i] for i in range(12, 20)) and got[20].text == "é " + own[0]
    assert all(r.n_chars == len(r.text) for r in got.values())
    removed = {r._id: r.removed_words for r in quality.line_quality(make_docs(texts), min_line_docs=5).collect()}
    assert all(len((texts[i] or "").split()) - len(got[i].text.split()) == removed[i] for i in got)


def test_quality_limit_does_not_grow_with_the_host(spark, make_docs):
    import corpus_pipeline
    rnd = random.Random(51)
    common, rarer = prose(rnd, 12), prose(rnd, 12)
    texts = [f"{prose(rnd, 20)} {i}" for i in range(3000)]
    lines = [f"{common}\n{x}" if i < 101 else f"{rarer}\n{x}" if i < 201 else x for i, x in enumerate(texts)]
    docs = make_docs(lines)
    got = {r.doc_id: r.text for r in corpus_pipeline.quality_rules(spark, docs, "").collect()}
    assert all(got[i] == texts[i] for i in range(101))       # in 101 documents, 3.4 percent
    assert all(got[i] == lines[i] for i in range(101, 3000) if i in got) and len(got) > 2900
    assert quality.line_quality(docs).where("removed_words > 0").count() == 101          # one rule, in the query as well
    assert quality.line_quality(docs, max_line_docs=99).where("removed_words > 0").count() == 201
    share = quality.line_quality(docs, max_line_docs=10**9).where("removed_words > 0")
    assert share.count() == 0


def test_quality_repeated_rows_and_empty_table(spark, make_docs):
    text = prose(random.Random(3), 50)
    docs = make_docs([text, text, None], ids=[7, 7, None])
    rows = quality.line_quality(docs).collect()
    assert len(rows) == 3 and sorted(str(r._id) for r in rows) == ["7", "7", "None"]
    assert quality.keep_good(docs).count() == 2
    assert quality.line_quality(docs.limit(0)).count() == 0


# ------------------------------------------------------------------ n-gram join
def brute_components(texts, words, pct):
    sets = []
    for t in texts:
        w = "".join(c.lower() if c.isascii() else c for c in t or "")
        w = [x for x in __import__("re").findall(r"[^\x20\x09-\x0D]+", w)]
        sets.append({tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set()))
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= pct * (len(a) + len(sets[j]) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [len(s) for s in sets], [find(i) for i in range(len(texts))]


def near_copies(rnd):
    texts = []
    for _ in range(25):
        base = prose(rnd, rnd.choice([3, 12, 60, 120])).split()
        texts.append(" ".join(base))
        for _ in range(rnd.randrange(5)):
            copy = list(base)
            for _ in range(rnd.randrange(4)):
                copy[rnd.randrange(len(copy))] = rnd.choice(WORDS)
            texts.append(" ".join(copy) if rnd.random() < 0.8 else " ".join(copy).upper())
    rnd.shuffle(texts)
    return texts + ODD + ODD


@pytest.mark.parametrize("words,pct", [(3, 90), (5, 80)])
def test_components_match_brute_force(spark, make_docs, words, pct):
    texts = near_copies(random.Random(words))
    sizes, roots = brute_components(texts, words, pct)
    got = {r._id: (r.n_shingles, r.component_id) for r in ngram_join.components(make_docs(texts), words=words, pct=pct).collect()}
    assert got == {i: (sizes[i], roots[i]) for i in range(len(texts))}


def large_group(rnd, members, edits):
    """Copies of one text with so many changed words each: similarities lie about the bound."""
    base = [f"w{i}" for i in range(200)]
    out = []
    for _ in range(members):
        copy = list(base)
        for _ in range(rnd.choice(edits)):
            copy[rnd.randrange(len(copy))] = f"x{rnd.randrange(40)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("sizes", [{"TILE": 7, "FEW": 2, "SOME": 4}, {"TILE": 10_000, "FEW": 3, "SOME": 10_000},
                                   {"FEW": 1, "SOME": 1, "HELD_BACK": 1, "SKETCH_BITS": (64, 64)}, {}])
def test_forests_of_tiles_lose_no_link(spark, make_docs, monkeypatch, sizes):
    """A large group about the similarity among other texts, in tiles of any size."""
    for name, value in sizes.items():
        monkeypatch.setattr(ngram_join, name, value)
    rnd = random.Random(11)
    texts = near_copies(rnd) + large_group(rnd, 60, [3, 4, 5]) + large_group(rnd, 30, [0, 1, 7])
    _, roots = brute_components(texts, 3, 90)
    got = {r._id: r.component_id for r in ngram_join.components(make_docs(texts)).collect()}
    assert got == dict(enumerate(roots)) and len(set(roots)) > 20


def test_shingles_of_joined_and_very_long_texts():
    """Equal words give equal hashes wherever they stand: texts joined in
    pieces, long texts cut, words longer than a piece."""
    long_word = "z" * (3 << 20)
    texts = ["a b c d", "", "A  b\tC\nd", " x", "a b", "éa b c d", "a b c d" * 3, None, ("q r s t u " * 300_000) + " end",
             f" {long_word} p {long_word} p q", "q r s t u q"]
    column = pa.array([(t or "").encode() for t in texts], pa.binary())
    sets = [set(s.tolist()) for s in ngram_join.shingle_sets(column, 3)]
    whole = [{tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))} if w else set()
             for w in ([x.decode() for x in (t or "").encode().lower().split()] for t in texts)]
    assert [len(s) for s in sets] == [len(s) for s in whole]
    for a in range(len(texts)):
        for b in range(len(texts)):
            assert len(sets[a] & sets[b]) == len(whole[a] & whole[b]), (a, b)
    part = [set(s.tolist()) for s in ngram_join.shingle_sets(column.slice(4, 5), 3)]
    assert part == sets[4:9]


def test_sketches_never_exclude_a_link():
    rnd = random.Random(3)
    for _ in range(300):
        n = rnd.choice([1, 3, 40, 300, 9000])
        x = {rnd.getrandbits(63) for _ in range(n)}
        y = set(rnd.sample(sorted(x), max(1, int(n * rnd.uniform(.8, 1))))) | {rnd.getrandbits(63) for _ in range(rnd.randrange(1 + n // 8))}
        sets = [np.array(sorted(s), np.int64) for s in (x, y)]
        m = ngram_join._Members(np.arange(2), np.array([len(x), len(y)]), np.arange(2), np.zeros(2, int),
                                [ngram_join.odd_sketch(s, 80) for s in sets], 80)
        ok, d = m.left(np.array([0]), np.array([1]))
        if 100 * len(x & y) >= 80 * len(x | y):
            assert ok[0] and d[0] <= len(x ^ y)


def test_join_of_repeated_null_and_no_rows(spark, make_docs):
    text = prose(random.Random(5), 30)
    docs = make_docs([text, text, text + " more", None, None], ids=[5, 5, 9, None, 3])
    got = sorted((str(r._id), r.component_id) for r in ngram_join.components(docs).collect())
    assert got == [("3", 3), ("5", 5), ("5", 5), ("9", 5), ("None", None)]
    kept = ngram_join.keep_first(docs)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["3", "5", "None"]
    assert ngram_join.components(docs.limit(0)).count() == 0


def test_verdicts_reach_only_their_own_text(spark, make_docs):
    rnd = random.Random(41)
    a, b, c, d, e, f = (prose(rnd, 40) for _ in range(6))
    texts = [a, b, c, c, d, d + " more", e, e + " more", f, f, "", "", f.upper()]
    ids = [None, None, 7, 7, 8, 9, None, 9, 4, 5, 6, 6, 4]
    kept = ngram_join.keep_first(make_docs(texts, ids=ids))
    left = sorted((str(r.doc_id), r.text) for r in kept.collect())
    # 9 goes as a near copy of 8, but not the other text that has the id 9
    four = [x for x in left if x[0] == "4"]
    assert len(four) == 1 and four[0][1].lower() == f
    assert [x for x in left if x[0] != "4"] == sorted([("None", a), ("None", b), ("7", c), ("8", d), ("9", e + " more"), ("6", ""), ("6", "")])
    # the same rows stay when another row is not repeated
    rows = [i for i in range(len(texts)) if i != 3]
    fewer = ngram_join.keep_first(make_docs([texts[i] for i in rows], ids=[ids[i] for i in rows]))
    assert sorted((str(r.doc_id), r.text) for r in fewer.collect()) == left
    nulls = ngram_join.keep_first(make_docs([a, a + " more", b, b], ids=[None] * 4))
    assert sorted(r.text in (b,) for r in nulls.collect()) == [False, True]
    good = quality.keep_good(make_docs([a, "bad", b, "bad"], ids=[None, None, 3, 3]))
    assert sorted(r.text for r in good.collect()) == sorted([a, b])


# ------------------------------------------------------------------ toxicity
def toxic_corpus(rnd, n):
    bad = ["grumbloid", "snotface", "zerkhead"]
    texts, labels = [], []
    for i in range(n):
        sentences = [prose(rnd, rnd.randrange(5, 15)) + "." for _ in range(rnd.randrange(3, 9))]
        y = i % 4 == 0
        for _ in range(2 * y):
            k = rnd.randrange(len(sentences))
            w = sentences[k].split()
            w.insert(rnd.randrange(len(w)), rnd.choice(bad))
            sentences[k] = " ".join(w)
        texts.append(" ".join(sentences))
        labels.append(y)
    return texts, np.array(labels)


def test_toxicity_on_held_out_texts_and_gapped_words(spark, make_docs):
    rnd = random.Random(4)
    texts, y = toxic_corpus(rnd, 320)
    model = toxicity.fit_texts(texts, y)
    new, truth = toxic_corpus(rnd, 120)
    odd = ["you grum-bl-oid here. such a s n o t f a c e too.", "Grumbl0id and z.e.r.k.h.e.a.d. grumbloid again."]
    docs = make_docs(new + odd + ODD)
    got = {r._id: r for r in toxicity.score(docs, model).collect()}
    right = sum((got[i].predicted == 1) == bool(truth[i]) for i in range(120))
    assert right >= 114
    assert got[120].score > 0.7 and got[121].score > 0.7
    assert all(got[122 + k].predicted == 0 and 0 <= got[122 + k].score <= 1 for k in range(len(ODD)))


def test_toxicity_learns_from_open_rows_only(spark, make_docs):
    texts, y = toxic_corpus(random.Random(6), 160)
    docs = make_docs(texts + [None])
    labels = spark.createDataFrame([(i, 1, int(v)) for i, v in enumerate(y)] + [(None, 1, 1), (3, 0, None)], "doc_id long, quality int, toxic int")
    rows = toxicity.training_rows(docs, labels).collect()
    assert rows and all(zlib.crc32(str(r.doc_id).encode()) % 3 != 1 for r in rows)
    assert toxicity.training_rows(docs, labels, max_toxic=5, max_clean=7).count() == 12
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns
    left = {r.doc_id for r in kept.collect()}
    assert 160 in left and sum(i in left for i in range(160) if not y[i]) >= 114 and sum(i in left for i in range(160) if y[i]) <= 6
    none = toxicity.score(docs, toxicity.fit(docs, labels.where("toxic = 0")))
    assert {(r.score, r.predicted) for r in none.collect()} == {(0.0, 0)}


def test_subsequence_kernel_is_that_of_all_subsequences():
    def brute(a, b):
        def spans(w):
            out = {}
            w = toxicity.START + w
            for i in range(len(w)):
                for j in range(i + 1, len(w)):
                    for k in range(j + 1, len(w)):
                        if k - i < toxicity.SPAN:
                            out[w[i] + w[j] + w[k]] = out.get(w[i] + w[j] + w[k], 0) + toxicity.DECAY ** (k - i + 1)
            return out
        x, y = spans(a), spans(b)
        return sum(v * y.get(k, 0) for k, v in x.items()) / toxicity._norm(len(a) + 1) / toxicity._norm(len(b) + 1)
    marks, words = ["idiot", "aaab", "clown"], ["idixot", "aab", "", "clowns", "zzz", "aaaaaab"]
    got = toxicity.Landmarks(marks).similarities(words)
    exp = np.array([[brute(w, m) ** toxicity.POWER for m in marks] for w in words])
    assert np.allclose(got, exp, atol=1e-5)


# ------------------------------------------------------------------ memory of the pipeline's stages
def test_whole_texts_are_sent_in_small_batches(spark, make_docs, monkeypatch):
    rows = spark.sparkContext.accumulator(0)   # the largest batch of a task, summed over tasks and runs

    def watched(name, module):
        real = getattr(module, name)

        def make(*a):
            run = real(*a)

            def counted(batches):
                most = [0]

                def look():
                    for b in batches:
                        most[0] = max(most[0], b.num_rows)
                        yield b
                yield from run(look())
                rows.add(max(0, most[0] - common.WIDE_ROWS))
            return counted
        monkeypatch.setattr(module, name, make)

    watched("_search", decontaminate)
    watched("_term_counts", decontaminate)
    bench = spark.createDataFrame([(1, " ".join(WORDS[:20]))], "item_id long, text string")
    docs = make_docs(["some plain words"] * 9000 + [" ".join(WORDS[:20])]).coalesce(1)
    assert decontaminate.drop_leaks(docs, bench).count() == 9000
    assert rows.value == 0


def test_a_task_gives_its_memory_back(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(len(calls)))
    assert list(common.tidy(lambda batches: (x + 1 for x in batches))(iter([1, 2]))) == [2, 3]
    assert len(calls) == 2
    monkeypatch.undo()
    common.give_back()


# ------------------------------------------------------------------ decontamination
def test_decontamination_finds_copies_and_paraphrases(spark, make_docs):
    rnd = random.Random(8)
    items = [". ".join(" ".join(f"{rnd.choice(WORDS)}{rnd.randrange(50)}" for _ in range(n)) for n in (9, 8, 7)) + "." for _ in range(30)]
    items += ["tiny item", None, ""]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")

    def around(x):
        return prose(rnd, 70) + " " + x + " " + prose(rnd, 90)

    def paraphrase(x):
        w = x.split()
        for k in rnd.sample(range(len(w) - 8), 4):
            w[k] = rnd.choice(WORDS)
        w.insert(3, "indeed")
        return " ".join(w)

    texts = [around(items[i]) for i in range(10)] + [around(paraphrase(items[i])) for i in range(10, 20)]
    texts += [prose(rnd, 150) for _ in range(20)] + [around(" ".join(items[3].split()[:8]))] + ["a tiny item here", "a tiny other item"] + ODD
    got = {r._id: r for r in decontaminate.leaks(make_docs(texts), bench).collect()}
    assert len(got) == len(texts)
    assert all(got[i].item_ids == [i] for i in range(20))
    assert not any(got[i].leaked for i in range(20, 41))
    assert got[41].item_ids == [30] and not any(got[i].leaked for i in range(42, len(texts)))
    clean = decontaminate.drop_leaks(make_docs(texts), bench)
    assert clean.columns == make_docs(["x"]).columns and clean.count() == len(texts) - 21
    assert decontaminate.leaks(make_docs(texts), bench.limit(0)).where("leaked").count() == 0
    assert decontaminate.leaks(make_docs(["x"]).limit(0), bench).count() == 0


def test_decontamination_in_rounds_and_blocks(spark, make_docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "MAX_ITEMS", 4)
    monkeypatch.setattr(decontaminate, "BLOCK", 2)
    rnd = random.Random(9)
    items = [" ".join(f"{rnd.choice(WORDS)}{rnd.randrange(50)}" for _ in range(20)) for _ in range(11)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [prose(rnd, 20) + " " + items[i] + " " + items[(i + 1) % 11] for i in range(11)] + [prose(rnd, 60)]
    got = {r._id: r.item_ids for r in decontaminate.leaks(make_docs(texts), bench).collect()}
    assert got == {i: sorted([i, (i + 1) % 11]) for i in range(11)} | {11: []}


def brute_leaks(text, passages):
    """Every region of every passage's window length by the subsequence alone."""
    words, found = decontaminate.words_of(text.encode()), {}
    for p in passages:
        size = next((s for s in decontaminate.SIZES if len(p.words) <= s), decontaminate.SIZES[-1])
        for at in range(0, max(1, len(words) - size // 2), size // 2):
            share = decontaminate._is_leak(p, words[max(0, at - size // 2):min(at + size, len(words)) + size // 2])
            if share:
                found[p.item] = max(share, found.get(p.item, 0.0))
    return found


@pytest.mark.parametrize("scale", [1, 1_000_000])
def test_decontamination_recall_is_that_of_the_subsequence(spark, make_docs, monkeypatch, scale):
    # the larger the corpus, the heavier the words that no item has
    real = decontaminate.document_frequencies
    monkeypatch.setattr(decontaminate, "document_frequencies", lambda *a: (real(*a)[0], real(*a)[1] * scale))
    monkeypatch.setattr(decontaminate, "BLOCK", 16)
    monkeypatch.setattr(decontaminate, "STRETCH", 128, raising=False)
    rnd = random.Random(21)
    items = []
    for n in [6, 9, 9, 17, 17, 33, 33, 33, 50, 64, 65, 90] * 2:  # just over a window, mostly
        w = [rnd.choice(WORDS) if rnd.random() < 0.6 else f"{rnd.choice(WORDS)}{rnd.randrange(40)}" for _ in range(n)]
        items.append(" ".join(w[:-4]) + ". " + " ".join(w[-4:]) + ".")
    texts = []
    for x in items * 2:
        w = x.split()
        for k in rnd.sample(range(len(w)), rnd.choice([0, 0, len(w) // 6, len(w) // 3])):
            w[k] = f"zz{rnd.randrange(99)}"
        if rnd.random() < 0.4:
            for _ in range(len(w) // 4):
                w.insert(rnd.randrange(len(w)), f"yy{rnd.randrange(99)}")
        around = [f"xx{rnd.randrange(999)}" if rnd.random() < 0.7 else rnd.choice(WORDS) for _ in range(rnd.randrange(300))]
        cut = rnd.randrange(len(around) + 1)
        texts.append(" ".join(around[:cut] + w + around[cut:]))
    passages = decontaminate.passages_of([(i, x.encode()) for i, x in enumerate(items)])
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {r._id: (r.item_ids, r.share) for r in decontaminate.leaks(make_docs(texts), bench).collect()}
    exp = [brute_leaks(x, passages) for x in texts]
    assert got == {i: (sorted(e), max(e.values(), default=0.0)) for i, e in enumerate(exp)}
    assert 24 <= sum(map(bool, exp)) < len(texts)


def test_documents_are_searched_together_and_found_alone(spark, monkeypatch):
    rnd = random.Random(23)
    items = [" ".join(f"{rnd.choice(WORDS)}{rnd.randrange(50)}" for _ in range(n)) for n in (5, 12, 30, 60, 80)]
    texts = [prose(rnd, rnd.randrange(40)) + " - " + items[i % 5] + " " + prose(rnd, rnd.randrange(60)) if i % 3 else prose(rnd, 30 * (i % 2))
             for i in range(300)]
    raw = [t.encode() for t in texts]
    src = spark.createDataFrame(pa.table({"_utf8": pa.array(raw, pa.binary())}))
    blocks, where = decontaminate.build_blocks(src, [(i, x.encode()) for i, x in enumerate(items)])
    calls, real = [], decontaminate.find_leaks
    monkeypatch.setattr(decontaminate, "find_leaks", lambda *a: calls.append(1) or real(*a))

    def found():
        calls.clear()
        batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(raw, pa.binary())], names=["_id", "_utf8"])
        return [x for b in decontaminate._search(blocks, where)(iter([batch])) for x in zip(*(b.column(c).to_pylist() for c in b.schema.names))]

    together = found()
    assert len(calls) <= 4  # as many as the words need, not one a document
    monkeypatch.setattr(decontaminate, "PIECES", 1)
    assert found() == together
    assert [x[1] for x in together] == [[i % 5] if i % 3 else [] for i in range(300)]


def test_common_subsequence_matches_brute_force():
    rnd = random.Random(3)
    for _ in range(60):
        a, b = ([rnd.randrange(4) for _ in range(rnd.randrange(12))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, z in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == z else max(best[i][j + 1], best[i + 1][j])
        assert decontaminate.common_subsequence(a, b) == best[-1][-1]


def test_randomised_svd_matches_numpy(spark):
    rng = np.random.default_rng(1)
    a = rng.standard_normal((12, 30)) * (rng.random((12, 30)) < 0.4)
    rows = spark.createDataFrame([(np.flatnonzero(r).tolist(), r[r != 0].tolist()) for r in a], "ids array<int>, weights array<double>")
    basis, values = decontaminate.randomised_svd(rows, 30, 12)
    exp = np.linalg.svd(a, compute_uv=False)
    assert np.allclose(values, exp[:len(values)], rtol=1e-6) and np.allclose(np.linalg.norm(a @ basis), np.linalg.norm(a))


# ------------------------------------------------------------------ BPE
def test_bpe_equals_library(spark, make_docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    rnd = random.Random(10)
    bits = [" ", "  ", "\n", "\t", "a", "bc", "'s", "É", "1", "22", ".", "\u00a0", "\u3000", "<|endoftext|>", "😀", "\x85", "\x1c"]
    texts = ODD + ["".join(rnd.choices(bits, k=rnd.randrange(30))) for _ in range(300)] + [prose(rnd, 3000)] * 2
    docs = make_docs(texts + [texts[-1]], ids=[*range(len(texts)), len(texts) - 1])
    got = {r._id: r for r in bpe.encode(docs, path, block_bytes=4000).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = tok.encode(t or "", add_special_tokens=False).ids
        assert bytes(got[i].ids) == np.array(ids, "<u4").tobytes()
        assert got[i].decoded == tok.decode(ids, skip_special_tokens=False)
    rows = bpe.digests(bpe.encode(docs, path)).collect()
    assert len(rows) == len(texts) + 1
    one = next(r for r in rows if r.doc_id == 5)
    ids = np.array(tok.encode(texts[5], add_special_tokens=False).ids, "<u4")
    assert (one.n_tokens, one.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
    assert bpe.encode(docs.limit(0), path).count() == 0


# ------------------------------------------------------------------ token files
def test_coder_round_trip_and_independent_blocks():
    rng = np.random.default_rng(2)
    streams = [rng.integers(0, 49408, 5000), np.zeros(5000, int), np.tile([5, 6, 7, 49407], 1250), rng.zipf(1.3, 5000) % 49000, np.array([7])]
    for s in streams:
        blocks = [s[i:i + token_file.BLOCK].astype(np.int32) for i in range(0, len(s), token_file.BLOCK)]
        share, payloads = token_file.encode_blocks(blocks)
        out = token_file.decode_blocks(share, payloads, [len(b) for b in blocks])
        assert np.array_equal(out, s)
        alone = token_file.decode_blocks(share, payloads[-1:], [len(blocks[-1])])
        assert np.array_equal(alone, blocks[-1])
    assert len(token_file.encode_blocks([np.tile([5, 6, 7], 600).astype(np.int32)])[1][0]) < 200


def test_token_file_index_equals_library(spark, make_docs, tmp_path, monkeypatch):
    monkeypatch.setattr(token_file, "LANES", 2)  # a long document spans rows
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    rnd = random.Random(12)
    texts = ODD + [prose(rnd, rnd.randrange(80)) for _ in range(60)] + [prose(rnd, 9000), "Ünï <|endoftext|>x İ"]
    ids = list(range(len(texts)))
    rnd.shuffle(ids)
    token_file.write(make_docs(texts, ids=ids), str(tmp_path / "t"), path)
    got = {r.doc_id: r for r in token_file.read_index(spark, str(tmp_path / "t")).collect()}
    start = 0
    for i, t in sorted(zip(ids, texts)):
        own = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(own), zlib.crc32(own.tobytes()))
        start += len(own)


def test_token_file_of_no_rows_and_damage(spark, make_docs, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    token_file.write(make_docs(["x"]).limit(0), str(tmp_path / "e"), path)
    assert token_file.read_index(spark, str(tmp_path / "e")).count() == 0
    token_file.write(make_docs(["some words here", "and there"]), str(tmp_path / "d"), path)
    bad = spark.read.parquet(str(tmp_path / "d")).selectExpr("* except (checks)", "transform(checks, c -> c + 1) as checks")
    bad.write.parquet(str(tmp_path / "b"))
    with pytest.raises(Exception, match="damaged"):
        token_file.read_index(spark, str(tmp_path / "b")).count()


def test_words_are_cut_into_pieces_as_the_library_cuts():
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        words = token_file._WordIds(f.read())
    rnd = random.Random(4)
    bits = ["don't", "DON'T", "'S", "'", "l'\u00c9t\u00e9", "\u00bfQu\u00e9?", "\u00dfX\u00ff", "\u00d7", "\u00aa", "\u00b2", "\u00b5", "E\u0301", "H\u0331", "\u0130", "\u1e9e", "_", "a_b", "7", "42,5",
            "!!!", "<|endoftext|>", "<|ENDOFTEXT|>", "\u00a0", "\u0085", "\x1c", "\u2028", "\u6f22\u5b57", "\U0001f600", "\x00", "</w>", " ", " ", "\n", "\t", "\x0b"]
    texts = [*bits, "", " ", *("".join(rnd.choices(bits, k=rnd.randrange(1, 12))) for _ in range(3000)), prose(rnd, 300)]
    for part in (texts, texts[::-1], [t for t in texts if token_file._COMMON(t or " ")]):
        size, flat = words.ids(pa.array([t.encode() for t in part], pa.binary()), 2)
        for t, got in zip(part, np.split(flat, np.cumsum(size)[:-1])):
            assert got.tolist() == [*tok.encode(t, add_special_tokens=False).ids, 2], t


def test_pieces_are_encoded_once(monkeypatch):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        words = token_file._WordIds(f.read())
    seen = []
    encode = words.pieces.encode
    monkeypatch.setattr(words.pieces, "encode", lambda p: seen.extend(p.to_pylist()) or encode(p))
    monkeypatch.setattr(words, "encode_lines", lambda w: pytest.fail(f"whole lines: {w[:5]}"))
    for text in (b"Word word, WORD! (word) \xc3\x89t\xc3\xa9", b"word.word word's \xc3\xa9t\xc3\xa9?"):
        words.ids(pa.array([text], pa.binary()), 2)
    assert sorted(seen) == sorted(["word", ",", "!", "(", ")", "\u00e9t\u00e9", ".", "'s", "?"])


def test_coder_has_one_event_an_id():
    rng = np.random.default_rng(5)
    events = []
    put = token_file._Encoder.put
    blocks = [rng.integers(0, 40, 300).astype(np.int32) for _ in range(5)] + [np.array([3], np.int32)]
    with pytest.MonkeyPatch.context() as m:
        m.setattr(token_file._Encoder, "put", lambda self, a, b: events.append(len(a)) or put(self, a, b))
        share, payloads = token_file.encode_blocks(blocks)
    missed = sum(int(np.frombuffer(p, "<u2", 2)[1]) for p in payloads)
    assert sum(events) == sum(map(len, blocks)) + missed
    assert np.array_equal(token_file.decode_blocks(share, payloads, [len(b) for b in blocks]), np.concatenate(blocks))


def test_batches_are_cut_and_joined_by_bytes(monkeypatch):
    monkeypatch.setattr(token_file, "STRETCH", 10)
    texts = [b"", b"12345", b"123456", b"", b"x" * 25, b"1", b"2", b"123456789", b""]
    batches = [pa.record_batch([pa.array(range(a, b)), pa.array(texts[a:b], pa.binary())], names=["_id", "_utf8"]) for a, b in ((0, 2), (2, 2), (2, 7), (7, 9))]
    got = [b.column("_id").to_pylist() for b in token_file._stretches(batches)]
    assert [i for g in got for i in g] == list(range(9))
    assert all(len(g) == 1 or sum(len(texts[i]) for i in g) <= 10 for g in got) and len(got) == 5


def test_similarities_by_table_and_by_search_are_equal(monkeypatch):
    import numpy as np

    from meridian.llm import toxicity
    words = ["hateful", "häßlich", "idiot", "ab", "", "x", "idiotic", "hate\U0001F600ful", "zzzzz"]
    by_table = toxicity.Landmarks(["hateful", "idiot", "häßlich"])
    got = by_table.similarities(words)
    monkeypatch.setattr(toxicity, "MAX_PLACES", 1)
    by_search = toxicity.Landmarks(["hateful", "idiot", "häßlich"])
    assert len(by_table.place) and not len(by_search.place)
    assert np.array_equal(got, by_search.similarities(words))
    assert got[0, 0] > 0.99 and got[6, 1] > got[0, 1] and not got[3:6].any() and not got[8].any()
    assert not toxicity.Landmarks(["a"]).similarities(["word"]).any()
    feats = toxicity._Features(by_table)
    assert [feats.number[w] for w in ("idiot,", "idiot", "1d1ot", "word")] == [0, 0, 0, 1]
    feats.update()
    assert feats.table.shape == (2, 3)          # a word written in three ways has one row


def test_bpe_blocks_are_small_and_the_pieces_read_once(monkeypatch):
    import public_tokenizers

    from meridian.llm import bpe
    import numpy as np
    import pyarrow as pa
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = f.read()
    assert bpe.BLOCK_BYTES <= 8 << 20
    reads, real = [], bpe.id_to_piece
    monkeypatch.setattr(bpe, "id_to_piece", lambda s: reads.append(1) or real(s))
    join = bpe._join_back(spec, pa.int64(), True)
    a = next(i for i, p in enumerate(real(spec)) if p == b"a")
    for _ in range(3):
        left = pa.table({"ids": [[1]], "words": [[2]], "numbers": [bpe._pack(np.array([0, 0]))]})
        right = pa.table({"steps": [bpe._pack(np.array([0]))], "sizes": [bpe._pack(np.array([1]))], "ids": [bpe._pack(np.array([a]))]})
        assert join(left, right).column("decoded").to_pylist() == ["aa"]
    assert len(reads) == 1

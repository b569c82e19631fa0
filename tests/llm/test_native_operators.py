"""Sharding, URL filter, tool calls, HTML text, and the pipeline."""
import json
import os
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from llm_helpers import SF
from meridian.llm import html_text, sharding, toolcalls, urlfilter


# ------------------------------------------------------------------ sharding
@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (4, 2), (2, 1)])
def test_hilbert_curve_visits_neighbours(spark, dims, bits):
    cells = spark.range(1 << dims * bits).select(*[
        F.expr(f"cast(shiftright(id, {bits * i}) & {(1 << bits) - 1} as int)").alias(f"x{i}") for i in range(dims)])
    rows = cells.select("*", sharding.hilbert_index([F.col(f"x{i}") for i in range(dims)], bits).alias("h")).orderBy("h").collect()
    assert [r.h for r in rows] == list(range(1 << dims * bits))
    assert all(sum(abs(a[i] - b[i]) for i in range(dims)) == 1 for a, b in zip(rows, rows[1:]))


def test_shards_law_slots_and_odd_rows(spark, make_docs):
    texts = [None, "", "é", "same", "same"] + [f"text {i} " * (i % 9) for i in range(70)]
    ids = [None, 1, 2, 9, 9] + list(range(10, 80))
    docs = make_docs(texts, ids=ids).withColumn("source", F.when(F.col("doc_id") % 3 == 0, "a"))
    rows = sharding.hilbert_shards(docs).collect()
    count = Counter(r.shard for r in rows)
    assert set(count) == set(range(16)) and max(count.values()) - min(count.values()) <= 1 and len(rows) == 75
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append((r.slot, r.curve))
    assert all([s for s, _ in sorted(v)] == list(range(len(v))) and [c for _, c in sorted(v)] == sorted(c for _, c in v) for v in slots.values())
    exp = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in zip(ids, texts))
    assert Counter((r._id, r.size, r.text_crc32) for r in rows) == exp
    few = sharding.hilbert_shards(docs.limit(3)).collect()
    assert len({r.shard for r in few}) == 3 and {r.slot for r in few} == {0}
    assert sharding.hilbert_shards(docs.limit(0)).count() == 0


def test_written_shards_keep_whole_rows(spark, make_docs, tmp_path):
    docs = make_docs([f"t{i}" for i in range(40)])
    sharding.write_shards(docs, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert {tuple(r) for r in back.select(*docs.columns).collect()} == {tuple(r) for r in docs.collect()}
    assert sorted(os.listdir(tmp_path / "s"))[-1].startswith("shard=")


# ------------------------------------------------------------------ url filter
PAGES = "page_id long, url string, html string, host string"


def test_rules_hosts_and_paths(spark):
    urls = ["http://A.Example.NET/en/x?q#f", "https://example.net/de/", "http://x.example.com/de/1", "http://x.example.com/en", "ftp://u.org/fr/",
            "http://u.org/fr", "http://u.net", "http://net/", "http://notexample.net/en/", "no scheme", None, "http://", "http://h?x://y/", "s://h/p#?"]
    pages = spark.createDataFrame([(i, u, None, "z") for i, u in enumerate(urls)], PAGES)
    got = {r._id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(pages).collect()}
    assert got[0] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[1] == ("example.net", "/de/", "net/", "block")
    assert got[2][2:] == ("example.com/de/", "block") and got[3][:3] == ("x.example.com", "/en", None)
    assert got[4][2:] == ("org/fr/", "allow") and got[5][2] is None
    assert got[6] == ("u.net", "", None, "allow") and got[7][2:] == ("net/", "block")
    assert got[8][2:] == ("net/", "block")
    assert got[9] == got[10] == ("", "", None, "allow") and got[11][:2] == ("", "")
    assert got[12] == ("h", "", None, "allow") and got[13] == ("h", "/p", None, "allow")
    assert urlfilter.judge(pages.limit(0)).count() == 0


def test_trust_and_distrust_follow_links(spark):
    def a(*hosts):
        return "".join(f'<a href="https://{h}/p">x</a>' for h in hosts)
    rows = [(0, "http://bad.net/x", a("bad.net"), None), (1, "http://farm.com/a", a("bad.net"), None), (2, "http://far.com/a", a("farm.com"), None),
            (3, "http://good.org/fr/x", a("child.com"), None), (4, "http://child.com/z", a("good.org"), None), (6, "http://farm.com/fr", "", None),
            (5, "http://alone.com/", "<p>no links</p>", None), (5, "http://alone.com/", "<p>no links</p>", None)]
    got = [(r._id, r.verdict) for r in urlfilter.judge(spark.createDataFrame(rows, PAGES)).collect()]
    assert sorted(got) == [(0, "block"), (1, "block"), (2, "block"), (3, "allow"), (4, "allow"), (5, "allow"), (5, "allow"), (6, "block")]


# ------------------------------------------------------------------ tool calls
CALLS = "conv_id long, call_id string, position long, name string, arguments string, depends_on array<string>"
RESULTS = "conv_id long, call_id string, position long, content string"
SCHEMAS = {"add": {"a": ("integer", True), "b": ("number", True), "note": ("string", False)}, "list": {"items": ("array", True)}}


def test_links_orders_validates_and_serialises(spark):
    calls = spark.createDataFrame([
        (1, "a", 0, "add", '{"b": 2.5, "a": 1}', None), (1, "b", 1, "add", '{"a": 1, "b": 2, "note": "é\\"x"}', ["a"]),
        (1, "c", 2, "add", '{"a": "1", "b": 2}', ["a", "b"]), (1, "d", 3, "add", '{"a": 1, "b": 2, "z": 0}', []),
        (1, "e", 4, "sub", "{}", []), (1, "f", 5, "add", '{"a": 1, "b": 2}', ["nope"]), (1, "g", 6, "list", '{"items": [2, 1]}', []),
        (1, "h", 7, "list", "not json", []), (1, "i", 8, "list", None, None), (1, "a", 9, "add", "{}", []), (1, None, 9, "add", "{}", [])], CALLS)
    results = spark.createDataFrame([(1, "a", 1, "3.5"), (1, "b", 2, "x"), (1, "b", 3, "y"), (1, "q", 4, "lost"), (1, "a", 1, "3.5")], RESULTS)
    got = {r.call_id: r for r in toolcalls.link(calls, results, SCHEMAS).collect()}
    assert {k: r.status for k, r in got.items()} == {
        "a": "ok", "b": "several_results", "c": "invalid_arguments", "d": "invalid_arguments", "e": "unknown_tool",
        "f": "missing_dependency", "g": "no_result", "h": "invalid_arguments", "i": "invalid_arguments", "q": "orphan_result"}
    assert got["a"].canonical == '{"arguments":{"a":1,"b":2.5},"call":"a","depends_on":[],"name":"add","result":"3.5"}'
    assert json.loads(got["b"].canonical)["result"] == "x" and got["b"].order_key > got["a"].order_key
    assert got["h"].canonical.startswith('{"arguments":null,')


def test_topological_order_with_forward_edges_and_cycles(spark):
    rows = [(1, "x", 0, "list", "{}", ["y"]), (1, "y", 1, "list", "{}", ["z"]), (1, "z", 2, "list", "{}", []),
            (2, "p", 0, "list", "{}", ["q"]), (2, "q", 1, "list", "{}", ["p"]), (2, "r", 2, "list", "{}", ["q"]), (2, "s", 3, "list", "{}", []),
            (3, "k", 5, "list", "{}", [])]
    got = {r.call_id: r for r in toolcalls.link(spark.createDataFrame(rows, CALLS), spark.createDataFrame([], RESULTS), SCHEMAS).collect()}
    assert got["z"].order_key < got["y"].order_key < got["x"].order_key
    assert {k for k, r in got.items() if r.status == "cycle"} == {"p", "q", "r"} and got["k"].order_key == 5
    assert toolcalls.link(spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS), SCHEMAS).count() == 0


def test_conversations_keep_their_own_calls(spark):
    rows = [(c, i, p, "list", '{"items": []}', d) for c in (1, 2, None) for i, p, d in (("call_1", 0, []), ("call_2", 1, ["call_1"]))]
    rows += [(3, "a", 0, "list", '{"items": []}', ["b"]), (3, "b", 1, "list", '{"items": []}', []), (None, "x", 2, "list", "{}", ["y"]), (None, "y", 3, "list", "{}", ["x"]),
             (4, "z", 0, "list", '{"items": []}', ["call_1"]), (1, "call_1", 7, "list", '{"items": [7]}', []), (1, "call_1", 7, "list", '{"items": [7]}', []),
             (1, None, 8, "list", '{"items": []}', []), (None, None, 9, "list", '{"items": []}', [])]
    calls = spark.createDataFrame(rows, CALLS)
    results = spark.createDataFrame([(c, "call_1", 1, f"of {c}") for c in (1, 2, None, 4)] + [(2, "call_2", 2, "two")], RESULTS)
    got = toolcalls.link(calls, results, SCHEMAS).collect()
    by = {(r.conv_id, r.call_id): r for r in got}
    assert len(got) == len(by) == 12
    for c in (1, 2, None):
        assert by[c, "call_1"].status == "ok" and json.loads(by[c, "call_1"].canonical)["result"] == f"of {c}"
        assert by[c, "call_1"].order_key < by[c, "call_2"].order_key
    assert by[2, "call_2"].status == "ok" and by[1, "call_2"].status == by[None, "call_2"].status == "no_result"
    assert by[4, "call_1"].status == "orphan_result" and by[4, "z"].status == "missing_dependency"
    assert by[3, "b"].order_key < by[3, "a"].order_key and by[None, "x"].status == by[None, "y"].status == "cycle"
    refused = toolcalls.refused_calls(calls)
    assert refused.columns == toolcalls.link(calls, results, SCHEMAS).columns
    assert sorted((str(r.conv_id), str(r.call_id), r.order_key, r.status) for r in refused.collect()) == [
        ("1", "None", 8, "no_identifier"), ("1", "call_1", 7, "repeated_call"), ("None", "None", 9, "no_identifier")]


def test_every_turn_has_a_row(spark, tmp_path):
    from meridian.llm.catalog import op10_tool_calls
    rows = [(1, 0, "user", "a"), (1, 0, "user", "b"), (1, 1, "assistant", "c"), (None, 0, "user", "d"), (None, 0, "system", "e"), (2, None, "user", "f"),
            (2, 0, "tool", "g"), (2, 1, "assistant", "h"), (2, 2, None, "i"), (2, 3, "user", "j")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = Counter((r.status, json.loads(r.canonical)["result"]) for r in op10_tool_calls(spark, str(tmp_path)).collect())
    assert got == {("ok", "c"): 1, ("repeated_call", None): 1, ("no_identifier", None): 3, ("unknown_tool", "h"): 1, ("unknown_tool", None): 1, ("no_result", None): 1}


# ------------------------------------------------------------------ HTML
def test_html_main_text_and_odd_pages(spark):
    page = ("<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><a href='/'>Home</a></nav>"
            "<div class='cookie-notice'><p>We use cookies.</p></div><article><h1>Head &amp; line</h1><p>One\n two&nbsp;three<script>var x='</p>'</script>"
            "<p><b>Bold<br>text<p>Caf&eacute; &#x41;<div class='ad'>Buy now.</div><aside>More to read.</aside><ul><li>First<li>Second</ul>"
            "<form>Sign up <input></form><section id='comments'><article><p>Nice page. I agree.</p></article></section></article>"
            "<div class='sidebar'><p>Popular things.</p></div><footer>&copy; us. All rights.</footer></body></html>")
    deep = "<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>"
    rows = [(0, "u", page, 1), (1, None, None, 1), (2, "u", "", 1), (3, "u", "<<<>&&& </p></b>", 1), (4, "u", deep, 1), (0, "u", page, 1),
            (5, "u", "<article><p>" + "long " * 50_000 + "</p></article>", 1)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    by = {r._id: r for r in got}
    assert len(got) == 7
    assert by[0].text == "Head & line\nOne two three\nBold text\nCafé A\nFirst\nSecond" and by[0].n_chars == len(by[0].text)
    assert by[1].text == by[2].text == "" and by[1].n_chars == 0 and by[4].text == "deep"
    assert by[5].n_chars == 50_000 * 5 - 1
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_html_labelled_pages_are_learned():
    model = html_text.Model(html_text.labelled_pages())
    wrong = total = 0
    for html in html_text.labelled_pages():
        page = html_text.Page(html)
        y = [0]
        for i in range(1, len(page.parent)):
            y.append(y[page.parent[i]] if page.label[i] is None else int(page.label[i]))
        for i, p in enumerate(model.marginals(page)):
            if page.tag[i] == "#run":
                total += 1
                wrong += (p > 0.5) != y[i]
    assert wrong <= 0.01 * total


def test_marginals_match_enumeration():
    import itertools
    model = html_text.Model(html_text.labelled_pages())
    page = html_text.Page("<body><div><p>One.</p></div><aside>Two</aside><article>Three</article></body>")
    n = len(page.parent)
    weight = [0.0] * n
    total = 0.0
    for y in itertools.product((0, 1), repeat=n - 1):
        y = (0, *y)
        w = 1.0
        for i in range(1, n):
            w *= model.potential(page.features(i))[2 * y[page.parent[i]] + y[i]]
        total += w
        for i in range(n):
            weight[i] += w * y[i]
    assert model.marginals(page) == pytest.approx([w / total for w in weight], rel=1e-6, abs=1e-9)


# ------------------------------------------------------------------ queries and pipeline
@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")
def test_queries_match_oracle(spark):
    import sys
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
    from check_oracle import compare
    from meridian.llm.catalog import ORACLE
    assert all(v == "OK" for v in compare(spark, SF, list(ORACLE), verbose=False).values())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")
def test_pipeline_stages(spark):
    import corpus_pipeline
    from meridian.llm.common import load, staged
    docs = load(spark, SF, "documents")
    before, columns = docs.count(), docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, SF), "t")
        assert docs.columns == columns and 0.7 * before < docs.count() <= before, name
        before = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    rows = last.collect()
    assert len(rows) == before and {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}
    whole = {tuple(r) for r in corpus_pipeline.run(spark, SF).collect()}
    assert whole == {tuple(r) for r in rows}

import os
import random
import sys
import tracemalloc
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parent.parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools"), str(Path(__file__).parent)]

import brute  # noqa: E402
from verify import compare, tables  # noqa: E402

from occspark.llm import ann, bpe, html, licenses, linededup, lmscore, packing, quality, queries, simhash, tokencounts, transducer  # noqa: E402
from occspark.plans.components import connected_components  # noqa: E402


def triples(df):
    return [(r["doc_id"], r["text"], r["source"]) for r in df.select("doc_id", "text", "source").collect()]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    tables(con, sf_dir)
    assert compare(queries.QUERIES[name](spark, sf_dir).toPandas(), con.sql(queries.ORACLE_SQL[name]).df()) == ""


# 1 ----------------------------------------------------------------------------------------------------


def test_quality_against_brute_force(spark, sf_dir, odd_docs):
    for df in (odd_docs, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        rows = triples(df)
        want = Counter((d, *(m[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), b, k) for (d, _, _), (m, b, k) in zip(rows, brute.quality(rows), strict=True))
        got = quality.apply_quality_rules(df).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
        assert Counter(map(tuple, got.collect())) == want


def test_quality_edges(spark, odd_docs, no_docs):
    got = {r["doc_id"]: r for r in quality.apply_quality_rules(odd_docs).collect()}
    assert got[0]["base_failed"] and got[7]["base_failed"] and got[3]["kept"] and not got[100]["kept"]
    assert quality.apply_quality_rules(no_docs).count() == 0
    clean = spark.createDataFrame([(1, " ".join(f"word{i}" for i in range(60)), "bad")] + [(i, "x", "bad") for i in range(2, 200)], "doc_id long, text string, source string")
    kept = quality.apply_quality_rules(clean).filter("kept").collect()
    assert [r["doc_id"] for r in kept] == [1] and kept[0]["host_rejected"]  # a clean document of a rejected host stays


def test_hosts_are_rejected_by_their_excess_over_the_prior(spark):
    """One host of 30 fails a rule far oftener than the others, yet on less than half of its pages; a small one does so by chance."""
    rng = random.Random(2)
    clean = lambda: " ".join(f"word{rng.randint(0, 9999)}" for _ in range(60))
    odd = lambda: " ".join(f"word{rng.randint(0, 9999)} ##" for _ in range(40))
    rows = [(h, odd() if i % 20 == 0 or h == 7 and i % 3 == 0 else clean()) for h in range(30) for i in range(60)]
    rows += [(99, odd()), (99, clean()), (99, clean())]
    docs = spark.createDataFrame([(i, t, f"h{h}") for i, (h, t) in enumerate(rows)], "doc_id long, text string, source string")
    got = quality.apply_quality_rules(docs, with_excess=True).collect()
    assert {r["source"] for r in got if r["host_rejected"]} == {"h7"}
    assert all(r["kept"] == (r["source"] != "h7" or not r["fails_symbols"]) for r in got)
    excess = {r["source"]: r["host_excess"] for r in got}
    assert excess["h7"] > 0.2 > excess["h99"] > 0 and quality.host_verdicts(quality.quality_measures(docs), "source").count() == 31
    want = brute.quality([(r["doc_id"], r["text"], r["source"]) for r in docs.collect()])
    assert sorted((r["doc_id"], r["kept"]) for r in got) == [(i, k) for i, (_, _, k) in enumerate(want)]


# 2 ----------------------------------------------------------------------------------------------------


def test_licences(spark, no_docs):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    rows = [(1, "text. Released under the MIT License. More"), (2, mit), (3, "Licensed under CC BY-NC 4.0.\nLICENSED under the Apache License, Version 2.0!\nLicensed under CC BY-NC 4.0."), (4, None), (5, ""), (6, "The license is fine."), (7, "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("licenses", F.lit(0))
    got = {r["doc_id"]: (r["licenses"], r["unmatched_ids"], len(r["sentence_ids"])) for r in licenses.scan_licenses(df).collect()}
    assert got == {1: (["MIT"], [], 1), 2: (["MIT"], [], 2), 3: (["CC-BY-NC-4.0", "Apache-2.0"], [], 3), 4: ([], [], 0), 5: ([], [], 0), 6: ([], [], 0), 7: ([], ["mit_notice"], 1)}
    assert licenses.scan_licenses(no_docs).count() == 0


def test_wrapped_licences(spark):
    import textwrap

    mit = [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    ]
    gpl = [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ]
    wrapped = lambda parts, mark, end: f"{mark.rstrip()}{end}".join(f"{end}".join(mark + x for x in [*textwrap.wrap(p, 74), ""]) for p in parts)
    rows = [(k, f"MIT License\nCopyright (c) 2020 A\n{wrapped(mit, mark, end)}", "MIT") for k, (mark, end) in enumerate((("", "\n"), (" * ", "\n"), ("# ", "\r\n")))]
    rows += [(10, "Permission is hereby granted, free\n\nof charge", None), (11, "Released under\nthe MIT License", "MIT"), (12, "a word\nAll rights reserved\nLicensed under CC BY 4.0\nmore", "CC-BY-4.0")]
    rows += [(20, wrapped(gpl, "// ", "\n"), "GPL-3.0-or-later")]
    got = {r["doc_id"]: (r["licenses"], r["sentence_ids"]) for r in licenses.scan_licenses(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")).collect()}
    assert {d: x for d, (x, _) in got.items()} == {d: [x] if x else [] for d, _, x in rows}
    assert all(got[d][1] == ["mit_grant", "mit_notice", "mit_as_is", "mit_liability"] for d in range(3)) and got[12][1] == ["reserved", "cc_by4_ref"]
    assert got[20][1] == ["gpl3_plus_grant", "gpl_no_warranty", "gpl_see"]


def test_every_known_sentence_has_a_cue_and_every_rule_known_sentences(spark):
    assert all(any(c in s for c in licenses.CUES) for s in licenses.SENTENCES)
    assert {i for _, seq in licenses.RULES for i in seq} <= set(licenses.SENTENCES.values())
    df = spark.createDataFrame([(s.capitalize() + ".",) for s in licenses.SENTENCES], "text string")
    assert licenses.scan_licenses(df).filter("size(sentence_ids) <> 1").count() == 0


def test_licence_sentences_within_sentences_and_of_ones_own(spark):
    rows = [
        (1, "This project is licensed under the MIT License."),
        (2, "# SPDX-License-Identifier: Apache-2.0\nimport x"),
        (3, "The code, unless noted, is released under the GNU Lesser General\n# Public License, version 2.1, and docs are available under CC BY-SA 4.0!"),
        (4, "word " * 200_000 + "Distributed under the Boost Software License, Version 1.0."),
        (5, "unlicensed under the mit licenses"),
        (6, None),
    ]
    df = spark.createDataFrame(rows + rows[:1], "doc_id long, text string").withColumn("sentence_ids", F.lit("clash"))
    got = sorted((r["doc_id"], tuple(r["licenses"])) for r in licenses.scan_licenses(df).collect())
    assert got == [(1, ("MIT",)), (1, ("MIT",)), (2, ("Apache-2.0",)), (3, ("LGPL-2.1-only", "CC-BY-SA-4.0")), (4, ("BSL-1.0",)), (5, ()), (6, ())]
    own = {licenses.normalised("Only for lunar use."): "moon", licenses.normalised("No warranty, none at all."): "none"}
    name = "L-" + "x" * 300
    said = spark.createDataFrame([(1, "Strictly only for lunar use. No warranty, none\n * at all."), (2, "nothing")], "doc_id long, text string")
    got = {r["doc_id"]: (r["licenses"], r["unmatched_ids"]) for r in licenses.scan_licenses(said, own, [(name, ["moon"])]).collect()}
    assert got == {1: ([name], ["none"]), 2: ([], [])}
    assert licenses.scan_licenses(said, {}, []).filter("size(sentence_ids) > 0").count() == 0


def test_licences_against_brute_force(spark, no_docs):
    rng = random.Random(4)
    known = sorted(licenses.SENTENCES)
    texts = []
    for _ in range(150):
        parts = [rng.choice(known).capitalize() if rng.random() < 0.6 else "some other words" for _ in range(rng.randint(0, 6))]
        texts.append("".join(p.replace(" ", rng.choice([" ", "\n", "\n// ", ", "]), rng.randint(0, 3)) + rng.choice([". ", "!\n", ".\n\n# "]) for p in parts))
    got = [(r["sentence_ids"], r["licenses"], r["unmatched_ids"]) for r in licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert got == [brute.licences(t, licenses.SENTENCES, licenses.RULES) for t in texts] and licenses.scan_licenses(no_docs).count() == 0


# 3 ----------------------------------------------------------------------------------------------------


def _page(title, *paragraphs, menu="Home", extra=""):
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return f'<html><head><title>{title}</title></head><body><nav><a href="/">{menu}</a></nav><div class="cookie-banner">We use cookies</div><article><h1>{title}</h1>{body}{extra}</article><aside>Other</aside><footer>&copy; x</footer></body></html>'


def test_extraction(spark):
    pages = [(i, f"https://a.example/{i}", _page(f"T{i}", f"Body {i} one &amp; <b>bo</b>ld.", "same text everywhere", extra='<p class="share">Share this</p><section id="comments"><p>First!</p></section>')) for i in range(5)]
    pages += [(10, "https://single.example/x", _page("Solo", "Only page &lt;here&gt;", "a<br>b")), (11, None, None), (12, "bad url", ""), (13, "https://a.example/13", "<p>loose <i>te</i>xt<script>x='<p>no</p>'</script><!-- no --><p>more")]
    pages += [(1, "https://a.example/1", pages[1][2])]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {r["page_id"]: r for r in html.extract_main_text(df).collect()}
    for i in range(5):
        assert got[i]["text"] == f"T{i} Body {i} one & bold. same text everywhere"
    assert got[10]["text"] == "Solo Only page <here> a b"
    assert got[11]["text"] == got[12]["text"] == "" and got[11]["n_chars"] == 0
    assert got[13]["text"] == "loose text more"
    assert html.extract_main_text(df).count() == 10
    assert html.extract_main_text(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [3, 8, 10, 12, 40])
def test_hosts_of_any_size_keep_paragraphs_and_lose_the_templates_own_places(spark, n):
    extra = '<div class="also"><a href="/">Read our other stories</a></div>'
    df = spark.createDataFrame([(i, f"https://a.example/{i}", _page(f"T{i}", f"Body {i}", "A paragraph that all share", extra=extra)) for i in range(n)], "page_id long, url string, html string")
    assert {r["text"] for r in html.extract_main_text(df).collect()} == {f"T{i} Body {i} A paragraph that all share" for i in range(n)}
    alike = df.withColumn("html", F.lit(_page("T", "One article", '<b class="x">copied</b>')))  # nothing tells a template from content
    assert {r["text"] for r in html.extract_main_text(alike).collect()} == {"T One article copied"}


def test_repeated_rows_and_pages_without_ids_count_once(spark):
    shared = '<div class="s"><p>A shared paragraph</p></div>'
    rows = [(i, f"https://a.example/{i}", _page(f"T{i}", f"Body {i}", extra=shared if i else "")) for i in range(12)]
    nameless = [(None, None, _page(f"N{i}", f"Text {i}", extra=shared)) for i in range(4)]
    schema = "page_id long, url string, html string"
    once = spark.createDataFrame(rows + nameless, schema)
    often = spark.createDataFrame(rows + rows[:1] * 7 + rows[3:5] * 2 + nameless + nameless[:1], schema)
    templates = [sorted((tuple(r["texts"]), r["host"] or "", r["main"]) for r in html.deduce_templates(df).collect()) for df in (once, often)]
    assert templates[0] == templates[1]
    want = Counter(r["text"] for r in html.extract_main_text(once).collect())
    got = Counter(r["text"] for r in html.extract_main_text(often).collect())
    assert got.keys() == want.keys() and got["T0 Body 0"] == 8 and got["N0 Text 0"] == 2


def test_words_do_not_outrank_an_article(spark):
    cases = {
        '<article><div class="share-price">Shares rose</div></article>': "Shares rose",
        '<article><h1>T</h1><div class="banner"><p>All the text</p></div></article>': "T All the text",
        '<article class="social-science"><p>Text</p></article>': "Text",
        '<article><p>Text</p><div class="ad">Buy</div><div class="comments-list"><p>First!</p></div></article>': "Text",
        "<article><p>ab<script>x</script>cd e<style>p{}</style>f<!-- c -->g</p><noscript>on</noscript></article>": "abcd efg",
        '<article><h1>T</h1><div id="comments">Only comments</div></article>': "T",
        "<p>no article</p><div class='sidebar'>side</div>": "no article",
    }
    df = spark.createDataFrame([(i, f"https://h{i}.example/", f"<html><body>{h}</body></html>") for i, h in enumerate(cases)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html.extract_main_text(df).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())


def test_deep_and_broken_pages(spark):
    n = 30_000
    pages = ["<div>" * n + "<p>deep</p>" + "</div>" * n, "<b>" * n + "<p>x</p>" * 50, "<article><p>kept" + "</section>" * n + " too</article>", "<ul>" + "<li>a<p>b" * n, "<" * n, "<div " + "class=" * n]
    df = spark.createDataFrame([(i, "http://a.example/", h) for i, h in enumerate(pages)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html.extract_main_text(df).collect()}
    assert got[0] == "deep" and got[1] == " ".join(["x"] * 50) and got[2] == "kept too" and got[3].split() == ["a", "b"] * n and got[5] == ""


def test_deduction_against_brute_force(spark):
    rng = random.Random(12)
    rows = []
    for h in range(12):
        places = rng.sample(["p", 'p class="n"', 'div class="a"', 'section id="b"', "li", 'span class="c"'], 4)
        said = [rng.choice("uvw") for _ in places]
        for i in range(rng.randint(1, 9)):
            parts = [f"<{x}>{t if rng.random() < 0.75 else rng.randint(0, 99)}</{x.split()[0]}>" for x, t in zip(places, said, strict=True) if rng.random() < 0.9]
            tag = rng.choice(["article", "article", "div"]) if h % 2 else "article"
            rows.append((len(rows), f"http://h{h}.example/{i}", f"<html><body><nav>{i % 2}</nav><{tag}><h1>t{i}</h1>{''.join(parts * rng.choice([1, 1, 2]))}</{tag}><div class='f'>foot</div></body></html>"))
    rows += rng.choices(rows, k=10)
    got = {r["host"]: (r["main"], set(r["texts"])) for r in html.deduce_templates(spark.createDataFrame(rows, "page_id long, url string, html string")).collect() if r["host"] is not None}
    want = brute.templates(set(rows), html.page_texts, html.CONTAINERS)
    hashed = {h: (m, {html._hash(f"{p}\n{t}") for p, t in texts}) for h, (m, texts) in want.items()}
    assert got == hashed and any(texts for _, texts in want.values()) and len({m for m, _ in want.values()}) > 1


def test_odd_pages_leave_the_template_on(spark):
    notice = '<p class="note">Read our other stories</p>'
    rows = [(i, f"https://a.example/{i}", _page(f"T{i}", f"Body {i}", extra=notice if i else "")) for i in range(30)]
    rows += [(100, "https://a.example/100", None), (101, "https://a.example/101", ""), (102, "https://a.example/102", "<div>Not found</div>"), (103, "https://a.example/103", "<html><body><p>Error 103</p></body></html>")]
    twice = '<html><body><article><p class="n">Share</p><p>Body {i}</p><p class="n">Share</p></article></body></html>'
    rows += [(200 + i, f"https://b.example/{i}", twice.replace("{i}", str(i))) for i in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html.extract_main_text(df).collect()}
    want = {i: f"T{i} Body {i}" for i in range(30)} | {100: "", 101: "", 102: "Not found", 103: "Error 103"} | {200 + i: f"Body {i}" for i in range(12)}
    assert got == want


def test_text_outside_the_largest_container_stays(spark):
    def page(h, i):
        body = f"long text {i} " * 30
        if h == "div":
            return f'<html><body><div class="post"><h1>T{i}</h1><p>lead {i}</p><div class="body"><p>{body}</p></div><p>end {i}</p></div></body></html>', f"T{i} lead {i} {body}end {i}"
        if h == "table":
            return f"<html><body><p>intro {i}</p><table><tr><td>{body}</td></tr></table></body></html>", f"intro {i} {body.strip()}"
        return f"<html><body><h1>T{i}</h1><article><p>{body}</p></article><section><p>notes {i}</p></section></body></html>", f"T{i} {body}notes {i}"

    rows = [(n * 100 + i, f"https://{h}.example/{i}", *page(h, i)) for n, h in enumerate(("div", "table", "article")) for i in range(5)]
    df = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html.extract_main_text(df).collect()}
    assert got == {r[0]: r[3] for r in rows}
    one = df.filter("url like '%/1'")  # hosts of one page: the template of all hosts
    assert {r["page_id"]: r["text"] for r in html.extract_main_text(one).collect()} == {r[0]: r[3] for r in rows if r[0] % 100 == 1}


def test_extraction_of_test_pages(spark, sf_dir):
    import re
    from html import unescape

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html.extract_main_text(pages).collect()}
    for r in pages.collect():
        a = re.search("<article>(.*?)(</article>|$)", r["html"], re.S)[1]
        a = re.sub("<[^>]*>", "\n", re.sub("</?b>", "", a))
        assert got[r["page_id"]] == " ".join(x for x in (" ".join(unescape(y).split()) for y in a.split("\n")) if x)


# 4 ----------------------------------------------------------------------------------------------------


def test_near_duplicates_against_brute_force(spark, sf_dir, odd_docs):
    for df in (odd_docs, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        rows = [(r["doc_id"], brute.fingerprint(r["text"])) for r in df.collect()]
        want = Counter((d, f"{f:016x}", c) for (d, f), c in zip(rows, brute.components(rows), strict=True))
        assert Counter(map(tuple, simhash.simhash_components(df).collect())) == want


@pytest.mark.parametrize("group", [4096, 4, 1])
def test_links_connect_what_three_bits_connect(spark, group):
    rng = random.Random(group)
    base = [rng.getrandbits(64) for _ in range(12)]
    points = set(base)
    for _ in range(400):
        x = rng.choice(sorted(points)) if rng.random() < 0.4 else rng.choice(base)
        for _ in range(rng.randint(1, 4)):
            x ^= 1 << rng.randrange(64)
        points.add(x)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(p),) for p in points], "fp long")
    roots = {r["node"]: r["root"] for r in connected_components(simhash.fingerprint_links(df, group), "a", "b").collect()}
    got, want = {}, {}
    for p, c in zip(sorted(points), brute.components([(p, p) for p in sorted(points)]), strict=True):
        got.setdefault(roots.get(signed(p), signed(p)), set()).add(p)
        want.setdefault(c, set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_near_duplicates_edges(spark, odd_docs, no_docs):
    assert simhash.simhash_components(no_docs).count() == 0
    kept = [r["doc_id"] for r in simhash.drop_near_duplicates(odd_docs).collect()]
    assert 3 in kept and 4 not in kept and 0 in kept and 1 not in kept and 2 not in kept and None in kept and kept.count(8) >= 1


def test_long_chain_of_components(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7), (None, 3)], "a long, b long")
    got = {r["node"]: r["root"] for r in connected_components(df, "a", "b").collect()}
    assert got == {i: 0 for i in range(201)} | {500: 500, 501: 500}


# 5 ----------------------------------------------------------------------------------------------------


def test_rollup(spark, tmp_path):
    d = "source string, lang string, tokenizer_version string, sign int, n_tokens long"
    rollup = tokencounts.TokenRollup(spark, f"file://{tmp_path}/rollup")
    assert rollup.totals().count() == 0
    one = spark.createDataFrame([("a", "en", "v", 1, 10), ("a", "en", "v", 1, 5), (None, "en", "v", 1, 3), ("b", None, "v", 1, None)], d)
    two = spark.createDataFrame([("a", "en", "v", -1, 5), ("a", "en", "v", 1, 7), (None, "en", "v", -1, 3)], d)
    rollup.commit("1", one)
    rollup.commit("2", two)
    want = {("a", "en", "v", 2, 17), ("b", None, "v", 1, 0)}
    assert {tuple(r) for r in rollup.totals().collect()} == want
    rollup.commit("2", two)
    rollup.commit("1", one)
    rollup.commit("3", one.limit(0))
    assert {tuple(r) for r in rollup.totals().collect()} == want and rollup.batches() == ["1", "2", "3"]
    rollup.compact("0")
    assert {tuple(r) for r in rollup.totals().collect()} == want and rollup.batches() == ["0"]


@pytest.mark.parametrize("step", ["_write", "_publish", "_clean"])
@pytest.mark.parametrize("late", [False, True])
def test_rollup_after_a_failure_at_any_step(spark, tmp_path, step, late):
    """Each step fails, before or after its work is done, in a commit and in a compaction, and the call is repeated by a new writer."""
    d = "source string, lang string, tokenizer_version string, sign int, n_tokens long"
    batches = {str(k): spark.createDataFrame([("a", "en", "v", 1, 10 * k), ("b", "en", "v", 1, k)], d) for k in (1, 2, 3)}
    path = f"file://{tmp_path}/rollup"
    totals = lambda: {r["source"]: (r["n_docs"], r["n_tokens"]) for r in tokencounts.TokenRollup(spark, path).totals().collect()}

    def failing():
        rollup = tokencounts.TokenRollup(spark, path)
        work = getattr(rollup, step)

        def broken(*a):
            if late:
                work(*a)
            raise OSError("lost")

        setattr(rollup, step, broken)
        return rollup

    tokencounts.TokenRollup(spark, path).commit("1", batches["1"])
    published = step == "_clean" or step == "_publish" and late
    for call, before, after in (
        (lambda r: r.commit("2", batches["2"]), {"a": (1, 10), "b": (1, 1)}, {"a": (2, 30), "b": (2, 3)}),
        (lambda r: r.commit("3", batches["3"]), {"a": (2, 30), "b": (2, 3)}, {"a": (3, 60), "b": (3, 6)}),
        (lambda r: r.compact("all"), {"a": (3, 60), "b": (3, 6)}, {"a": (3, 60), "b": (3, 6)}),
    ):
        with pytest.raises(OSError):
            call(failing())
        assert totals() == (after if published else before)
        call(tokencounts.TokenRollup(spark, path))
        call(tokencounts.TokenRollup(spark, path))
        assert totals() == after
    rollup = tokencounts.TokenRollup(spark, path)
    rollup.commit("2", batches["2"])  # folded already
    rollup.commit("4", batches["1"])
    assert rollup.batches() == ["4", "all"] and totals() == {"a": (4, 70), "b": (4, 7)}
    assert len(list((tmp_path / "rollup/data").iterdir())) == 2 and len(list((tmp_path / "rollup/manifests").glob("[0-9]*"))) == 1


def test_token_counts_query_against_brute_force(spark, sf_dir):
    ids_of, first = bpe.encoder(), {}
    want = Counter()
    for r in sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").collect(), key=lambda r: r["doc_id"]):
        if r["text"] not in first:
            first[r["text"]] = r["doc_id"]
            key = (r["source"], r["lang"], bpe.VOCABULARY)
            want[key + ("docs",)] += 1
            want[key + ("tokens",)] += len(ids_of(r["text"].strip(" \t\n\r")))
    got = Counter()
    for r in queries.op5_token_counts(spark, sf_dir).collect():
        got[(r["source"], r["lang"], r["tokenizer_version"], "docs")] = r["n_docs"]
        got[(r["source"], r["lang"], r["tokenizer_version"], "tokens")] = r["n_tokens"]
    assert got == want


def test_token_counts_edges(odd_docs, no_docs):
    got = {r["doc_id"]: r["n_tokens"] for r in tokencounts.token_counts(odd_docs).collect()}
    assert got[0] == got[1] == 0 and got[6] > 30_000
    assert tokencounts.token_counts(no_docs).count() == 0


def test_ids_are_those_of_the_tokenizers_file():
    from tokenizers import Tokenizer

    slow, fast = Tokenizer.from_file(bpe.default_path("byte_bpe_50k.json")), bpe.encoder()
    rng = random.Random(2)
    parts = ["the", " ", "  ", "\n", "\t", "é", "ß", "'s", "12", "漢", "а", " ", " ", "!", "…", "<|endoftext|>", "\U0001f600", "x", "É", "²", "́", "​", "\r\n", "don't", "१", "Ⅷ"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert fast(text) == slow.encode(text, add_special_tokens=False).ids


# 6 ----------------------------------------------------------------------------------------------------


def test_packing(spark, odd_docs, no_docs, sf_dir):
    for df, size in ((odd_docs, 2048), (odd_docs, 64), (spark.read.parquet(f"{sf_dir}/documents.parquet"), 2048)):
        got = packing.pack_documents(df, size=size).collect()
        rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
        assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == brute.pieces(rows, bpe.encoder(), size)
        by = {}
        for r in got:
            by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for placed in by.values():
            at = 0
            for offset, n in sorted(placed):
                assert offset == at
                at += n
            assert at <= size
        total = sum(r["length"] for r in got)
        assert len(by) <= 1.02 * -(-total // size) + 1
    assert packing.pack_documents(no_docs).count() == 0


def test_bins_take_the_fullest_combination():
    assert packing._fullest([0, 0, 0, 1, 0, 1, 0, 1], 10) == {7: 1, 3: 1}
    assert packing._fullest([0] * 11, 10) == {}
    rng = random.Random(5)
    for _ in range(200):
        counts = [0] + [rng.choice([0, 0, 0, 1, 2]) for _ in range(14)]
        room = rng.randint(1, 30)
        sums = {0}
        for n, c in enumerate(counts):
            for _ in range(c):
                sums |= {s + n for s in sums if s + n <= room}
        chosen = packing._fullest(counts, room)
        assert sum(n * k for n, k in chosen.items()) == max(sums) and all(k <= counts[n] for n, k in chosen.items())
    plan = packing.plan_bins({2048: 3, 1000: 5, 48: 5, 1: 7})
    assert sum(t for t, _ in plan) == 6 and Counter(n for t, c in plan for n, k in c.items() for _ in range(t * k)) == {2048: 3, 1000: 5, 48: 5, 1: 7}


# 7 ----------------------------------------------------------------------------------------------------


def test_scores(spark, odd_docs, no_docs):
    got = {r["doc_id"]: r for r in lmscore.score_documents(odd_docs).collect()}
    assert got[0]["n_tokens"] == 0 and got[0]["pseudo_log_likelihood"] == 0.0 and got[0]["mean_log_probability"] is None
    assert got[3]["pseudo_log_likelihood"] == got[4]["pseudo_log_likelihood"] < 0
    assert got[7]["mean_log_probability"] > got[3]["mean_log_probability"]
    assert lmscore.score_documents(no_docs).count() == 0


def _tokens(texts):
    ids_of = bpe.encoder()
    return [ids_of(t) if t and brute.WORD.search(t) else [] for t in texts]


def test_held_out_text_is_better_than_its_unigrams(spark, sf_dir):
    docs, p, v = spark.read.parquet(f"{sf_dir}/documents.parquet"), lmscore.LmParameters(), bpe.vocabulary_size()
    held, seen = (lmscore.token_chunks(docs.filter(c).select("doc_id", "text"), p) for c in ("doc_id % 5 = 0", "doc_id % 5 <> 0"))
    totals = lmscore.token_totals(seen, v)
    want = Counter(i for r in _tokens(r["text"] for r in docs.filter("doc_id % 5 <> 0").collect()) for i in r)
    assert {i: totals[i] for i in np.flatnonzero(totals)} == want
    mean = {}
    for name, model in (("network", lmscore.fit_network(seen, v, p)), ("unigram", lmscore.unigram_network(totals, p))):
        logs = np.concatenate([model.log_probabilities(c.stream, c.at) for b in held.toArrow().to_batches() for c in lmscore._chunks(b, p.window, v)])
        mean[name] = logs.mean()
    shares = (totals + 1) / (totals + 1).sum()
    ids = [i for r in _tokens(r["text"] for r in docs.filter("doc_id % 5 = 0").collect()) for i in r]
    assert np.isclose(mean["unigram"], np.log(shares[ids]).mean(), rtol=1e-3)  # training starts from the counts
    assert mean["network"] > mean["unigram"] + 0.1


def test_the_network_predicts_the_whole_vocabulary():
    rng, p = np.random.default_rng(1), lmscore.LmParameters(window=2, width=5, batch=64)
    v = 300
    stream = np.r_[[v] * 2, rng.integers(0, v, 400), [v + 1] * 2].astype(np.int32)
    model = lmscore.unigram_network(np.bincount(stream[2:-2], minlength=v), p)
    model.train(stream, np.arange(2, 402), p, 0.2, np.full_like(model.theta, 1e-8), np.zeros(len(model.theta)))
    for at in (2, 3, 150, 401):
        every = np.tile(stream[at - 2 : at + 3], (v, 1))
        every[:, 2] = np.arange(v)
        logs = model.log_probabilities(every.reshape(-1), np.arange(v) * 5 + 2)
        assert np.isclose(np.exp(logs).sum(), 1, atol=1e-4)
        assert np.isclose(logs[stream[at]], _log_probability(model, stream[at - 2 : at], stream[at + 1 : at + 3], stream[at]), rtol=1e-4)


def test_like_places_score_alike_wherever_they_stand():
    rng, p, v = np.random.default_rng(2), lmscore.LmParameters(), 3000
    stream = np.r_[[v] * 3, rng.integers(0, v, 9000), [v + 1] * 3].astype(np.int32)
    model, at = lmscore.unigram_network(np.bincount(stream[3:-3], minlength=v), p), np.arange(3, 9003)
    model.train(stream, at, p, 0.2, np.full_like(model.theta, 1e-8), np.zeros(len(model.theta)))
    whole = model.log_probabilities(stream, at)
    for _ in range(400):
        i = int(rng.integers(0, 8900))
        j = i + int(rng.integers(1, 100))
        assert (model.log_probabilities(stream, at[i:j]) == whole[i:j]).all()


def _log_probability(model, left, right, token):
    """One masked token by hand: the layer, then the way down the tree."""
    embeddings, nodes, weights, bias = (x.astype(float) for x in model.parts())
    h = np.tanh(np.concatenate([embeddings[t] for t in [*left, *right]]) @ weights + bias)
    h[-1] = 1
    tree, total = model.tree, 0.0
    for k in range(tree.starts[token], tree.starts[token] + tree.depth[token]):
        total -= np.log1p(np.exp(-tree.sides[k] * (h @ nodes[tree.nodes[k]])))
    return total


def test_scores_are_of_tokens_and_counts_of_runs_grow(spark):
    rng = random.Random(3)
    said = [f"w{k}" for k in range(600)]
    pairs = [(said[k], said[k + 1]) for k in range(200, 600, 2)]
    rows = [(i, " ".join(x for _ in range(40) for x in (rng.choice(said[:150]), *rng.choice(pairs)))) for i in range(120)]
    order = " ".join(x for a, b in pairs[:60] for x in (a, b)).split()
    shuffled = rng.sample(order, len(order))
    rows += [(1000, " ".join(order)), (1001, " ".join(shuffled)), (1002, " ".join(f"q{k}" for k in range(120))), (1003, None), (1004, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    p = lmscore.LmParameters(chunk_tokens=2_000, rounds=2)
    chunks = lmscore.token_chunks(df, p)
    assert chunks.count() > 8
    model = lmscore.fit_network(chunks, bpe.vocabulary_size(), p)
    got = {r["doc_id"]: r for r in lmscore.score_documents(df, p=p, network=model).collect()}
    # Brute force over the same network: counts of all runs, whatever the chunk.
    k, start = p.window, model.vocabulary
    docs = {d: [start] * k + ids + [start + 1] * k for (d, _), ids in zip(rows, _tokens(t for _, t in rows), strict=True)}
    spans = {d: w[k - 2 : 2 - k] if len(w) > 2 * k else [] for d, w in docs.items()}
    two = Counter(x for w in spans.values() for x in zip(w, w[1:]))
    three = Counter(x for w in spans.values() for x in zip(w, w[1:], w[2:]))
    want = Counter()
    for d, w in docs.items():
        for i in range(k, len(w) - k):
            prior = p.prior * np.exp(_log_probability(model, w[i - k : i], w[i + 1 : i + 1 + k], w[i]))
            left = (three[tuple(w[i - 2 : i + 1])] - 1 + prior) / (two[tuple(w[i - 2 : i])] - 1 + p.prior)
            want[d] += np.log((left + (three[tuple(w[i : i + 3])] - 1 + prior) / (two[tuple(w[i + 1 : i + 3])] - 1 + p.prior)) / 2)
    assert all(np.isclose(got[d]["pseudo_log_likelihood"], want[d], rtol=1e-4) and got[d]["n_tokens"] == len(docs[d]) - 2 * k for d in docs)
    assert got[1000]["mean_log_probability"] > got[1001]["mean_log_probability"] + 0.3  # the same words in another order
    assert got[1001]["mean_log_probability"] > got[1002]["mean_log_probability"] + 0.3  # words that stand nowhere else
    assert got[1003]["n_tokens"] == got[1004]["n_tokens"] == 0 and got[1003]["pseudo_log_likelihood"] == 0.0


def test_scores_of_tables_without_tokens(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, ""), (3, "\n\t")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_tokens"], r["pseudo_log_likelihood"], r["mean_log_probability"]) for r in lmscore.score_documents(df).collect())
    assert got == [(1, 0, 0.0, None), (1, 0, 0.0, None), (2, 0, 0.0, None), (3, 0, 0.0, None)]
    one = lmscore.score_documents(spark.createDataFrame([(1, "x")], "doc_id long, text string")).first()
    assert one["n_tokens"] == 1 and one["pseudo_log_likelihood"] < 0


def test_a_text_that_stands_twice_scores_apart(spark):
    rng = random.Random(8)
    said = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("lm", "rn", "st", "nt")]
    texts = [" ".join(rng.choice(said) for _ in range(80)) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts + texts[:10])), "doc_id long, text string")
    got = {r["doc_id"]: r["mean_log_probability"] for r in lmscore.score_documents(df).collect()}
    assert min(got[i] for i in (*range(10), *range(60, 70))) > max(got[i] for i in range(10, 60))
    text_ids = spark.createDataFrame([("a", texts[0]), (None, texts[0]), ("a", None)], "doc_id string, text string").withColumn("n_tokens", F.lit("clash"))
    assert Counter((r["doc_id"], r["n_tokens"] > 0) for r in lmscore.score_documents(text_ids).collect()) == {("a", True): 1, (None, True): 1, ("a", False): 1}


# 8 ----------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def machine():
    return transducer.transducer()


def test_encoding_is_that_of_the_library(machine, spark, sf_dir):
    from sentencepiece import SentencePieceProcessor

    lib = SentencePieceProcessor(model_file=bpe.default_path(transducer.MODEL))
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rng = random.Random(9)
    parts = [" ", "a", "e", "\n", "\t", "é", "漢", "字", "the", "▁", "ing", "<0x41>", "<s>", "\U0001f600", "0", "1", "..", "\r", "ﬁ", "́", "http://", "\\n", "==", "  ", "        ", "\x00"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    texts += [" " * k + "the" for k in range(60)] + ["a" * 3000, "", " "]
    for text in texts:
        ids = machine.encode(text)
        assert ids.tolist() == lib.encode(text)
        assert machine.decode(ids) == text.replace("▁", " ")


def test_long_runs_of_marks(machine):
    from sentencepiece import SentencePieceProcessor

    lib = SentencePieceProcessor(model_file=bpe.default_path(transducer.MODEL))
    for pair in (",;", "|,", "|."):
        assert not {pair, pair[::-1]} & machine.pairs
        text = "the " + "word" + pair * 2500 + " end"
        assert machine.encode(text).tolist() == lib.encode(text)


def _all_paths(machine, text):
    """The tropical shortest distance over the whole lattice of (place, last piece), and how many paths have finite weight."""
    states = [{} for _ in range(len(text) + 1)]
    states[0][""] = (0.0, 1)
    for i in range(len(text)):
        for piece in machine.leaving(text, i):
            into = [x for before, x in states[i].items() if not before or machine.agrees(before, piece)]
            if into:
                states[i + len(piece)][piece] = (min(w for w, _ in into) + machine.weight(piece), sum(n for _, n in into))
    return min(w for w, _ in states[-1].values()), sum(n for _, n in states[-1].values())


def test_one_path_alone_has_finite_weight_and_it_is_found(machine, spark, sf_dir):
    words = {w for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40).collect() for w in machine.words(r["text"].replace(" ", machine.blank))}
    rng = random.Random(3)
    words |= {"".join(rng.choice("aeinrst▁éß漢") for _ in range(rng.randint(1, 9))) for _ in range(2000)}
    for w in words:
        weight, n = _all_paths(machine, w)
        found, path = machine.shortest_path(w)
        assert n == 1 and np.isclose(found, weight) and "".join(path) == w


def test_models_of_other_kinds_are_refused(tmp_path):
    with open(bpe.default_path(transducer.MODEL), "rb") as f:
        data = f.read()
    kept, at = {n: v for n, v in transducer._fields(data) if n in (transducer._TRAINER, transducer._NORMALISER)}, str(tmp_path / "m.model")
    varint = lambda n: bytes([n & 127 | 128, n >> 7]) if n > 127 else bytes([n])
    message = lambda number, body: varint(number << 3 | 2) + varint(len(body)) + body
    pieces = b"".join(message(1, v) for n, v in transducer._fields(data) if n == 1)
    trainer, rules = ({k: v for k, v in transducer._fields(kept[n]) if isinstance(v, int)} for n in (transducer._TRAINER, transducer._NORMALISER))
    body = lambda x: b"".join(varint(k << 3) + varint(v) for k, v in x.items() if 0 <= v < 1 << 14)

    def compiled(trainer, rules):
        with open(at, "wb") as f:
            f.write(pieces + message(2, body(trainer)) + message(3, body(rules)))
        return transducer.PieceTransducer(at)

    assert compiled(trainer, rules).encode("a word").tolist() == transducer.transducer().encode("a word").tolist()
    for bad in ({transducer._MODEL_TYPE: 1}, {transducer._BYTE_FALLBACK: 0}):
        with pytest.raises(ValueError):
            compiled(trainer | bad, rules)
    with pytest.raises(ValueError):
        compiled(trainer, rules | {transducer._ONE_BLANK: 1})
    bare = compiled(trainer, rules | {transducer._MARK_FIRST: 0})
    assert bare.decode(bare.encode("two words")) == "two words" and bare.encode("two").tolist() != transducer.transducer().encode("two").tolist()


def test_memory_of_stretches_is_bounded_by_their_characters():
    small, rng = transducer.PieceTransducer(bpe.default_path(transducer.MODEL), 5_000), random.Random(1)
    for _ in range(300):
        text = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 200))) for _ in range(5))
        assert small.encode(text).tolist() == transducer.transducer().encode(text).tolist()
    assert max(sum(map(len, x)) for x in (small.stretches.young, small.stretches.old)) <= 5_000
    assert max(sum(len(a) + len(b) for a, b in x) for x in (small.agree.young, small.agree.old)) <= 5_000


def test_ids_of_any_type_and_columns_named_like_ours(spark, odd_docs):
    named = odd_docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id")).withColumns({c: F.lit(f"own {c}") for c in ("__key", "__w", "__l", "__kept", "__keys", "__salt", "__gone", "_id")})
    ours = [c for c in named.columns if c.startswith("_")]
    for out in (quality.apply_quality_rules(named), linededup.drop_boilerplate_lines(named), simhash.drop_near_duplicates(named), licenses.scan_licenses(named)):
        assert all(r[c] == f"own {c}" for r in out.select(*ours).limit(5).collect() for c in ours)
    n = named.count()
    assert packing.pack_documents(named).select("doc_id").distinct().count() == named.select("doc_id").distinct().count()
    prints = {r["doc_id"]: r["component_id"] for r in simhash.simhash_components(named).collect()}
    assert prints["d4"] == "d3" and transducer.piece_digest(named).count() == n and lmscore.score_documents(named).count() == n


def test_pieces_of_tables(spark, odd_docs, no_docs, machine):
    ids = transducer.encode_pieces(odd_docs.select("doc_id", "text", "piece_ids"))
    back = {r["doc_id"]: r for r in transducer.decode_pieces(ids).collect()}
    assert back[0]["piece_ids"] is None and back[0]["decoded"] is None and back[1]["piece_ids"] == [] and back[1]["decoded"] == ""
    assert all(r["decoded"] == r["text"] for r in back.values())
    digest = {r["doc_id"]: r for r in transducer.piece_digest(odd_docs).collect()}
    assert digest[0]["round_trip"] is None and digest[10]["n_byte_pieces"] > 0 and all(r["round_trip"] for d, r in digest.items() if d != 0)
    assert transducer.piece_digest(no_docs).count() == 0


# 9 ----------------------------------------------------------------------------------------------------


def _nearest(rows, k=20):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=float)
    out = {}
    for q, v in rows:
        if q % 20 == 0:
            s = x @ np.array(v, dtype=float)
            order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:k]
            out[q] = [(int(ids[i]), float(s[i])) for i in order]
    return out


def test_neighbours_edges(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.integers(-3, 4, 6).astype(float).tolist()) for i in range(90)]
    rows = [(i, v) for i, v in rows if any(v)]
    rows += [(1000 + i, [1.0, 2.0, 0.0, -1.0, 0.5, 0.25]) for i in range(60)]  # copies, queries among them
    bad = [(500, None), (501, [0.0] * 6), (502, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (520, [float("nan")] + [1.0] * 5), (540, [float("inf")] + [1.0] * 5), (None, [1.0] * 6), (503, [1.0]), (504, [])]
    schema = "vec_id long, embedding array<double>"
    df = spark.createDataFrame(rows + bad + rows[:3], schema).withColumn("score", F.lit("clash"))
    got = {}
    for r in ann.nearest_neighbours(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = _nearest(rows)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]] and np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=0, atol=1e-12)
    few = ann.nearest_neighbours(spark.createDataFrame(rows[:4], schema), F.col("vec_id") % 20 == 0).collect()
    assert len(few) == 3
    assert ann.nearest_neighbours(spark.createDataFrame([], schema), F.col("vec_id") % 20 == 0).count() == 0


def test_neighbours_of_rows_that_repeat_and_of_a_crowd(spark):
    """One row a thousand times, one vector under a thousand ids, and clusters: shards are split and queries stream past in blocks."""
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 4, (6, 8))
    rows = [(i, (centres[i % 6] + rng.normal(0, 0.3, 8)).tolist()) for i in range(900)]
    rows += [(2000 + i, centres[0].tolist()) for i in range(1000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").unionByName(spark.createDataFrame(rows[40:41] * 1000, "vec_id long, embedding array<double>"))
    p = ann.AnnParameters(shard_rows=50, query_rows=7, recall=0.99)
    got = {}
    for r in ann.nearest_neighbours(df, F.col("vec_id") % 20 == 0, p=p).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    want = _nearest(rows)
    assert got.keys() == want.keys() and all(len(set(v)) == 20 for v in got.values())
    hits = sum(len(set(got[q]) & {i for i, _ in v}) for q, v in want.items())
    assert hits / sum(map(len, want.values())) >= 0.95


def test_little_is_read_where_vectors_cluster(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(0, 4, (40, 16))[np.arange(4000) % 40] + rng.normal(0, 0.2, (4000, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, v array<double>")
    p = ann.AnnParameters()
    model = ann.fit(x, len(x), p)
    index = spark.createDataFrame([(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, model.cells(x.astype(np.float32)), strict=True))], "rep_id long, v array<double>, cell long")
    held = np.bincount(model.cells(x.astype(np.float32)), minlength=len(model.centroids))
    queries = df.filter("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    needed = ann.shares_needed(index, queries, queries.count(), model, held, p)
    assert len(needed) == 20 * 200 and np.quantile(needed, p.recall) < 0.15


@pytest.mark.parametrize("p", [ann.AnnParameters(), ann.AnnParameters(least_rows=100, shard_rows=150, query_rows=10)])
def test_recall(spark, p):
    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in e.collect()]
    want, got = _nearest(rows), {}
    for r in ann.nearest_neighbours(e, F.col("vec_id") % 20 == 0, p=p).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = sum(len(got[q] & {i for i, _ in v}) for q, v in want.items())
    assert hits / sum(map(len, want.values())) >= 0.9 and all(len(v) == 20 for v in got.values())


# 10 ---------------------------------------------------------------------------------------------------


def test_line_dedup_against_brute_force(odd_docs, no_docs, spark, sf_dir):
    for df in (odd_docs, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        rows = triples(df)
        want = Counter(zip((d for d, _, _ in rows), brute.line_dedup(rows), strict=True))
        assert Counter((r["doc_id"], r["text"]) for r in linededup.drop_boilerplate_lines(df).collect()) == want
    got = {r["doc_id"]: r for r in linededup.drop_boilerplate_lines(odd_docs).collect()}
    assert got[0]["text"] is None and got[0]["n_lines"] == 0 and not got[20]["text"].startswith("menu") and got[8]["text"].startswith("One LINE\nmenu")
    assert linededup.drop_boilerplate_lines(no_docs).count() == 0


def test_joins_with_and_without_broadcast_agree(spark):
    from occspark.plans.shared import lookup_join

    left = spark.createDataFrame([(i, "hot" if i % 3 else None) for i in range(200)] + [(900, "other")], "id long, host string")
    right = spark.createDataFrame([("hot", 1), (None, 2)], "host string, v int")
    a, b = (sorted(map(tuple, lookup_join(left, right, "host", F.col("id"), limit).collect())) for limit in (100, 0))
    assert a == b and len(a) == 201


# Pipeline ---------------------------------------------------------------------------------------------


def test_pipeline_against_brute_force(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = triples(docs)
    kept = [r for r, (_, _, k) in zip(rows, brute.quality(rows), strict=True) if k]
    texts = [(d, t) for (d, _, _), t in zip(kept, brute.line_dedup(kept), strict=True)]
    prints = [(d, brute.fingerprint(t)) for d, t in texts]
    left = [(d, t) for (d, t), c in zip(texts, brute.components(prints), strict=True) if c == d]
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == brute.pieces(left, bpe.encoder())


def test_pipeline_stages_keep_the_columns(spark, odd_docs, no_docs, sf_dir):
    import corpus_pipeline

    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf_dir)
            assert out.dtypes == docs.dtypes
            docs = out
        corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count()
    assert corpus_pipeline.ORACLE_SQL is None


def test_nothing_else_imports_the_subpackage():
    package = ROOT / "occspark"
    for p in package.rglob("*.py"):
        if "llm" not in p.relative_to(package).parts:
            assert "llm" not in p.read_text(), p
    assert os.path.exists(ROOT / "__spark_entry__.py")


def test_every_place_is_trained_on_once():
    p = lmscore.LmParameters()
    for n in (0, 1, 3, 1000):
        at = np.arange(n) * 2 + 5
        trained = np.concatenate([lmscore._places(at, nth, p) for nth in range(p.rounds)])
        assert sorted(trained) == list(at)


def _plain_steps(model, stream, at, p, rate, squares, touched):
    """Steps of training by rows, node by node of every place."""
    v, tree = model.vocabulary, model.tree
    embeddings, nodes, weights, bias = model.parts()
    layer = np.arange(2 * v + 1, len(model.theta))
    for i in range(0, len(at), p.batch):
        some = at[i : i + p.batch]
        around = stream[some[:, None] + np.array([*range(-p.window, 0), *range(1, p.window + 1)])]
        x = embeddings[around].reshape(len(some), -1)
        h = np.tanh(x @ weights + bias)
        h[:, -1] = 1
        depth = tree.depth[stream[some]]
        first, row = np.cumsum(depth) - depth, np.repeat(np.arange(len(some)), depth)
        step = np.arange(len(row)) + np.repeat(tree.starts[stream[some]] - first, depth)
        node, side = tree.nodes[step], tree.sides[step]
        g = (side / (1 + np.exp(np.minimum(np.einsum("nd,nd->n", h[row], nodes[node]) * side, 30))))[:, None]
        back = np.add.reduceat(g * nodes[node], first, axis=0)
        back[:, -1] = 0
        back *= 1 - h * h
        grad, times = np.zeros_like(model.theta), np.zeros(len(model.theta))
        for at_, up in ((v + 2 + node, g * h[row]), (around.reshape(-1), (back @ weights.T).reshape(-1, p.width))):
            at_flat = (at_[:, None] * p.width + np.arange(p.width)).reshape(-1)
            np.add.at(grad.reshape(-1), at_flat, up.reshape(-1))
            times += np.bincount(at_, minlength=len(times))
        grad[layer] = np.concatenate([x.T @ back, back.sum(axis=0, keepdims=True)])
        times[layer] += len(some)
        squares += grad * grad
        model.theta += np.float32(rate) * grad / (np.sqrt(squares) + np.float32(1e-6))
        touched += times


@pytest.mark.parametrize("window, width, batch, stride, v", [(3, 16, 512, 4, 3000), (3, 16, 512, 1, 40), (2, 5, 300, 2, 700), (1, 4, 64, 7, 2), (2, 6, 100, 3, 70_000)])
def test_steps_of_training_are_those_by_rows(window, width, batch, stride, v):
    rng, p = np.random.default_rng(4), lmscore.LmParameters(window=window, width=width, batch=batch)
    docs = np.array_split(np.minimum(rng.zipf(1.3, 3000) - 1, v - 1), 7)
    stream = np.concatenate([np.r_[[v] * window, d, [v + 1] * window] for d in docs]).astype(np.int32)
    at, done = np.flatnonzero(stream < v)[::stride], []
    for steps in (_plain_steps, lmscore.Network.train):
        model = lmscore.unigram_network(np.bincount(stream[stream < v], minlength=v), p)
        touched = np.zeros(len(model.theta))
        steps(model, stream, at, p, 0.2, np.full_like(model.theta, 1e-8), touched)
        done.append((model.theta, touched))
    assert (done[0][1] == done[1][1]).all()
    assert np.abs(done[0][0] - done[1][0]).max() < 5e-3


def test_a_step_of_training_makes_no_rows_for_all_nodes_of_all_places():
    """Such rows took most of a step's time; without them it fits in the memory that four such tables would take."""
    rng, p, v = np.random.default_rng(6), lmscore.LmParameters(), 3000
    stream = np.r_[[v] * 3, np.minimum(rng.zipf(1.3, 4 * p.batch) - 1, v - 1), [v + 1] * 3].astype(np.int32)
    at = np.arange(3, 3 + 4 * p.batch, 4)
    model = lmscore.unigram_network(np.bincount(stream[3:-3], minlength=v), p)
    squares, touched = np.full_like(model.theta, 1e-8), np.zeros(len(model.theta))
    tracemalloc.start()
    model.train(stream, at, p, 0.2, squares, touched)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    rows = int(model.tree.depth[stream[at]].sum()) * p.width * 4
    assert peak < 4 * rows

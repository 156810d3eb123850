"""Cases in which an operator or a stage once did less than the whole job."""

import base64
import hashlib
import os
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import DOCUMENTS
from traitflow.llm import common as C
from traitflow.llm import op3_licenses, op4_jaccard, op5_html, op8_secrets


# -- pipeline

def test_pipeline_near_copies(spark):
    """Near copies of a five-word similarity of 0.81 to 0.86 do not stay in the mix; the op4 query keeps its contract."""
    words = [f"w{i}" for i in range(200)]
    block = words[:90] + [f"b{i}" for i in range(10)] + words[100:]                   # one block of 5 % replaced
    hundred = [f"v{i}" for i in range(100)]
    scattered = ["x" if i in (30, 70) else w for i, w in enumerate(hundred)]
    apart = [f"u{i}" for i in range(200)]
    texts = [words, words + [f"a{i}" for i in range(30)], block, hundred, scattered, apart, apart[:100] + [f"t{i}" for i in range(100)]]
    rows = spark.createDataFrame([(i, " ".join(t), *([None] * 10)) for i, t in enumerate(texts)], DOCUMENTS)
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, rows, "").collect()) == [0, 3, 5, 6]
    assert {4, 1} <= {r.doc_id for r in op4_jaccard.one_of_each(rows).collect()}


# -- op5

def test_reprinted_article_stays(spark):
    """12 pages of one host print the same article; others of the host have their own. The notice in all of them goes by the host's counts alone."""
    notice = "<div class=box><p>This long line stands in each article of the site, longer than any paragraph of it.</p><p>Second line.</p></div>"
    forms = {"bare": "<h1>Title of it</h1><p>First of %s.</p><p>Second one, and this is its own sentence of %s.</p>" + notice,
             "parts": "<section><p>First of %s.</p><p>a</p></section><section><p>Third of a text.</p><p>The sentence is %s.</p></section><section><p>e</p><p>f</p></section>" + notice,
             "wrapped": "<div><div><h1>Title</h1><p>First of %s.</p><p>Second of %s.</p><p>Third</p></div></div>" + notice}
    rows, want = [], {}
    for k, form in enumerate(forms.values()):
        for i in range(30):
            own = "the reprint" if i < 12 else f"page {i}"
            rows.append((100 * k + i, f"http://h{k}.example/{i}", f"<div>nav</div><{'main' if k else 'article'}>{form.replace('%s', own)}</{'main' if k else 'article'}>"))
            want[100 * k + i] = form.replace("%s", own).replace(notice, "")
    got = {r.page_id: r.text for r in op5_html.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, html in want.items():
        assert got[i].split("\n\n") == re.findall(r"<(?:p|h1)>(.*?)</", html), i


# -- op8

def test_values_of_padded_keys(spark):
    one, two = "dGhpcyBpcyBhIGtleSBvZiAxMjM0Mw==", "dGhpcyBpcyBhIGtleSBvZiAxMjM0NTY3ODkwMTz="
    words = {w: k for k in (one, two) for w in (k, f'"{k}"', f"'{k}',", f"{k}.", f"password={k}", f'"api_key":"{k}"', f"token='{k}';", f"key:={k}")}
    words |= {"password=hunter22": "hunter22", "https://host.example/a1": "https://host.example/a1", 'secret="ab=cdefg"': "ab=cdefg", "AUTH==abcdef1": "abcdef1"}
    got = spark.createDataFrame([(w,) for w in words], "word string").select("word", op8_secrets.value_of(F.col("word")).alias("v")).collect()
    assert {r.word: r.v for r in got} == words


def test_padded_keys_are_masked(spark):
    keys = [base64.b64encode(hashlib.sha256(str(i).encode()).digest()[:n]).decode() for i in range(40) for n in (16, 20, 32)]
    assert all(k.endswith("=") for k in keys)
    forms = ['words here password = %s more', 'words here api_key = "%s" more', "words here token=%s more", "words here secret: '%s' more"]
    rows = [(i, forms[i % 4] % k, *([None] * 10)) for i, k in enumerate(keys)] + [(500 + i, f"see {k} here", *([None] * 10)) for i, k in enumerate(keys)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    found = {(r.key.id, r.value) for r in op8_secrets.judged(docs.select("doc_id", "text"), C.row_key()).collect()}
    assert {(i, k) for i, k in enumerate(keys)} <= found and {(500 + i, k) for i, k in enumerate(keys) if re.search("[0-9]", k)} <= found
    texts = {r.doc_id: r.text for r in op8_secrets.redacted(docs).collect()}
    assert sum(texts[i] == forms[i % 4] % "[SECRET]" for i in range(len(keys))) >= 0.97 * len(keys)


@pytest.mark.parametrize("attrs, kept", [
    ('class="overflow-hidden"', True), ('style="overflow:hidden"', True), ("class='hidden-print'", True), ('aria-hidden="false"', True), ("data-hidden=1", True), ('title="a hidden place"', True),
    ('data-class="ad"', True), ("hidden", False), ('id=x hidden=""', False), ('HIDDEN="hidden"', False), ('hidden="until-found"', True), ('aria-hidden="true"', False), ("aria-hidden=true", False),
    ('style="display: none"', False), ('style="visibility:hidden"', False), ("", True)])
def test_hidden_elements(attrs, kept):
    want = "a\n\nb" if kept else ""
    for page in ("<article %s><p>a</p><p>b</p></article>", "<div %s><article><p>a</p><p>b</p></article></div>", "<div %s><p>a</p><p>b</p></div>"):
        assert op5_html.main_text(page % attrs, set()) == want


@pytest.mark.parametrize("name", ["promo", "post sponsored", "tag-sharing", "category-comments", "notice"])
def test_names_do_not_remove_the_article(name):
    for tag in ("article", "main"):
        assert op5_html.main_text(f'<div>x</div><{tag} class="{name}"><p>a</p><div class="{name}"><p>b</p></div></{tag}>', set()) == "a"


# -- op3

def test_licences_without_cue_words(spark, docs):
    lines = {"Distributed under LGPL-2.1-or-later": "LGPL", "Released under AGPL-3.0-only.": "AGPL-3.0", "Released under Apache-2.0.": "Apache-2.0", "Code under MIT": "MIT", "Released under MPLv2": "MPL-2.0"}
    wrapped = ["This program is free software: you can redistribute it and/or modify", "it under the terms of the GNU General Public License as published by", "the Free Software Foundation, either", "version 3 of the License, or",
               "(at your option) any later version."]
    rows = [(i, "some words\n\n" + t + "\nmore words", *([None] * 10)) for i, t in enumerate(lines)] + [(50, "a b c\n \n\nsome words\n \n" + "\n".join(wrapped) + "\n\nmore words", *([None] * 10))]
    got = op3_licenses.scanned(docs.unionByName(spark.createDataFrame(rows, DOCUMENTS).repartition(2))).collect()
    found = {(r.doc_id, r.line, r.family) for r in got if r.confirmed}
    assert {(i, 2, f) for i, f in enumerate(lines.values())} <= found
    assert any(r.doc_id == 50 and r.family == "GPL-3.0" and r.confirmed and 5 <= r.line <= 9 for r in got)


def test_licence_headings_and_hard_negatives(spark, docs):
    found = {"MIT License": "MIT", "License: MIT": "MIT", "Apache-2.0": "Apache-2.0", "GPLv3": "GPL-3.0", "# GNU GPL v2 License": "GPL-2.0", "SPDX-License-Identifier: BSD-2-Clause": "BSD"}
    other = ["All rights reserved to the king under the treaty.", "He lost the license to drive the general's car.", "Permission to land was granted without delay."]
    rows = [(i, "some words\n\n" + t + "\nmore words", *([None] * 10)) for i, t in enumerate([*found, *other])]
    got = {(r.doc_id, r.family) for r in op3_licenses.scanned(docs.unionByName(spark.createDataFrame(rows, DOCUMENTS).repartition(2))).collect() if r.confirmed and r.doc_id is not None and r.doc_id < len(rows) and r.line == 2}
    assert got >= set(enumerate(found.values())) and not {d for d, _ in got} & set(range(len(found), len(rows)))


def test_licence_bound_is_exact(spark, docs):
    """On whole tables the scan that rules paragraphs out by arithmetic finds what the full scan finds."""
    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet") if os.path.isdir("/root/testdata/sf0.001") else docs
    classifiers = []

    class Kept(op3_licenses.Classifier):
        def __init__(self, rows):
            super().__init__(rows)
            classifiers.append(self)

    for table in (real, docs):
        both = []
        for exact in (True, False):
            rows = op3_licenses.scanned(table, exact).select("doc_id", "line", "family", F.round("probability", 9), F.round("similarity", 9), "confirmed", "paragraph").collect()
            both.append(sorted(map(str, rows)))
        assert both[0] == both[1] and (both[0] or table is docs)
    classifier = Kept(op3_licenses.training(docs))
    marked, voc = classifier.marking(), classifier.counts.vocabulary
    assert marked and len(marked) < 400 and all({op3_licenses.part(w) for w in g.split(" ")} & set(marked) for g in voc)
    bare = classifier.guessed(spark.createDataFrame([([],), (["the", "of the", "nothing"],)], "grams array<string>")).collect()
    assert all(r.guess == "unknown" for r in bare)


def test_licence_blocks(spark):
    rows = [(1, "a\nb\n \n\nc\n\nd\r\ne 1\x01\n", *([None] * 10)), (2, "\n\n", *([None] * 10)), (3, None, *([None] * 10)), (4, "x", *([None] * 10))]
    got = {(r.doc_id, r.line, r.last, r.paragraph) for r in op3_licenses.paragraphs(spark.createDataFrame(rows, DOCUMENTS)).collect()}
    assert got == {(1, 0, 0, "a"), (1, 1, 1, "b"), (1, 4, 4, "c"), (1, 6, 6, "d\r"), (1, 7, 7, "e 1\x01"), (1, 0, 1, "a\nb"), (1, 6, 7, "d\r\ne 1\x01"), (4, 0, 0, "x")}

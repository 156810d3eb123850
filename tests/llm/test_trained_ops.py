"""Trained operators by held-out accuracy, HTML by example, the pipeline by its stages."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import DOCUMENTS
from traitflow.llm import common as C
from traitflow.llm import op3_licenses, op5_html, op8_secrets, op9_quality

SMALL = "/root/testdata/sf0.001"


# -- op3

def test_licences(spark, docs):
    lines = {"Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC", "All rights reserved.": "proprietary",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "the license plate of the car was new": "unknown", "she had permission to go": "unknown"}
    rows = [(i, "some words\n" + t + "\nmore words", *([None] * 10)) for i, t in enumerate(lines)]
    both = docs.unionByName(spark.createDataFrame(rows, DOCUMENTS)).withColumn("family", F.lit("clash")).withColumn("grams", F.lit(1))
    got = op3_licenses.scanned(both).collect()
    assert {(r.doc_id, r.line, r.paragraph, r.family) for r in got} == {(i, 1, t, f) for i, (t, f) in enumerate(lines.items())}
    assert all(r.confirmed == (r.family != "unknown") for r in got)


def test_no_licences(none):
    assert op3_licenses.scanned(none).collect() == []


# -- op5

PAGE = """<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body><div class="site-header">Logo</div><ul id=menu><li>a<li>b</ul><div class=content>
<h1>T &amp; U</h1><p>One<br>two <b>three</b> &eacute;&#8212;<p>Four<ul><li>x<li>y</ul><div class="cookie-notice">c</div><!-- c --><section id="comments"><p>hi</section></div>
<form><input><p>q</form><script>if (a<b) "</p>"</script><div>Shared box %s</div><footer>f</footer>"""


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain &lt; text", "plain < text"), ("<p>a<p>b", "a\n\nb"), ("<article><p>a</p></article><p>out</p>", "a"), ("<p>x</b></i></div>y", "x y".replace(" ", "")),
    ("<main><header><h1>H</h1></header><article><p>a</p><table><tr><td>1<td>2<tr><td>3</table><div>x<p>y</div>z</article><aside>s</aside></main>", "a\n\n1\n\n2\n\n3\n\nx\n\ny\n\nz"),
    ('<div class="layout-sidebar"><article class="comments-open"><h2 class="section-header">H</h2><p>a</p><p class="ad">x</p></article></div>', "H\n\na"),
    ('<article><p>a</p><section class="comments"><article class="comment">hi</article></section></article>', "a"),
    ('<div class="content has-sidebar"><p>a</p><div class="sidebar">s</div></div><div class="site-footer">f</div>', "a"),
    ("<p>cut <b>off</p><p>end<a href=\"x", "cut off\n\nend"), ("<p>&amp;amp; &nosuch; &#x41;</p>", "&amp; &nosuch; A"), ("<p>" + "w " * 50000 + "</p>", ("w " * 50000).strip())])
def test_main_text(page, text):
    assert op5_html.main_text(page, set()) == text


def test_site_templates(spark):
    rows = [(i, f"http://Host.example/{i}", "<div>Site line</div>" + PAGE % "" + f"<p>own text {i}</p>") for i in range(12)]
    rows += [(50 + i, f"http://other.example/{i}", "<div>Site line</div><p>t</p>") for i in range(3)] + [(90, None, "<p>n</p>"), (91, "odd", None), (None, None, None), (0, rows[0][1], rows[0][2])]
    pages = spark.createDataFrame([(*r, "h", "k") for r in rows], "page_id long, url string, html string, host string, key string")
    got = {r.page_id: r for r in op5_html.extracted(pages).collect()}
    assert op5_html.extracted(pages).count() == len(rows)
    for i in range(12):      # blocks that every page of the host has are its template, the page's own text is not
        assert got[i].text == f"own text {i}" and got[i].n_chars == len(got[i].text)
    assert got[51].text == "Site line\n\nt" and got[90].text == "n" and got[91].text == "" and got[None].text == ""
    assert op5_html.extracted(pages.limit(0)).collect() == []


def test_articles_of_the_test_pages(spark):
    import html
    pages = C.table(spark, SMALL, "pages")
    got = {r.page_id: r.text for r in op5_html.extracted(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert got[r.page_id] == "\n\n".join(b for b in blocks if b)


# -- op8

def test_secrets(spark, docs, none):
    key, card = "8ef5f278dec875d2b96fdf291615913d21aee5ca", "4913615156729033"
    rows = [(900, f"words here token = \"{key}\" and {card} more", None, None, 5, *["x"] * 7), (901, f"token*** = \"{key}\"### {card}", None, None, 1, *["x"] * 7), (902, "no keys here", None, None, 12, *["x"] * 7)]
    both = docs.unionByName(spark.createDataFrame(rows, DOCUMENTS))
    got = op8_secrets.judged(both.select("doc_id", "text"), C.row_key()).collect()
    assert {(r.key.id, r.value) for r in got if r.is_secret} == {(900, key), (901, key)}
    clean = op8_secrets.redacted(both)
    assert clean.schema == both.schema
    texts = {r.doc_id: r for r in clean.collect()}
    assert texts[900].text == f"words here token = \"[SECRET]\" and {card} more" and texts[900].n_chars == len(texts[900].text)
    assert texts[902].text == "no keys here" and texts[100].text is None and clean.count() == both.count()
    assert op8_secrets.redacted(none).collect() == []


def test_forest_held_out(spark):
    rows = op8_secrets.found(op8_secrets.labelled_findings(spark), F.col("id"), "label").withColumn("covered", F.lit(0.0))
    learn, check = rows.filter("key % 3 <> 0"), rows.filter("key % 3 = 0")
    model = op8_secrets.forest(learn)
    built, names = op8_secrets.features(check)
    from pyspark.ml.feature import VectorAssembler
    out = model.transform(VectorAssembler(inputCols=names, outputCol="x").transform(built))
    assert out.agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0] > 0.97


def test_secrets_plans_stay_small_on_the_driver(spark, monkeypatch):
    # parts that many texts use are planned once each (in one expression the plan had 20,131 characters) ...
    plan = op8_secrets.labelled_findings(spark)._jdf.queryExecution().executedPlan().toString()
    assert len(plan) < 10_000 and all(plan.count(c + "#") > 1 for c in ("p_key", "p_name", "p_hash"))
    # ... and the forest's jobs read written vectors
    seen = []
    fit = op8_secrets.RandomForestClassifier.fit
    monkeypatch.setattr(op8_secrets.RandomForestClassifier, "fit", lambda self, data: seen.append(data) or fit(self, data))
    made = [("password = hunter%02d" % i, "hunter%02d" % i, i % 2) for i in range(20)]
    rows = spark.createDataFrame(made, "word string, value string, label int").withColumns({"one": F.lit("="), "two": F.lit("password"), "next": F.lit("more"), "covered": F.lit(0.0)})
    op8_secrets.forest(rows)
    assert seen[0].inputFiles() and seen[0].rdd.getNumPartitions() == 1 and seen[0].count() == 20


# -- op9

def test_quality(spark):
    docs, labels = C.table(spark, "/root/testdata/sf0.01", "documents"), C.table(spark, "/root/testdata/sf0.01", "labels")
    rows = C.written(op9_quality.measured(docs), "test")
    model = op9_quality.fitted(rows, labels, F.col("rest") != 1)
    out = op9_quality.scored(rows, model).join(labels, "doc_id").filter("rest = 1")
    assert out.agg(F.avg(((F.col("score") >= 0.5).cast("int") == F.col("quality")).cast("int"))).first()[0] > 0.95
    again = op9_quality.fitted(rows.repartition(5), labels, F.col("rest") != 1)
    assert again.intercept == model.intercept and all((a == b).all() for a, b in zip(again.main, model.main))


def test_quality_odd_rows(docs, none):
    rows = op9_quality.measured(docs)
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("quality"))
    got = op9_quality.scored(rows, op9_quality.fitted(rows, labels, F.lit(True))).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    one = op9_quality.fitted(rows, labels.limit(0), F.lit(True))
    assert {r.score for r in op9_quality.scored(rows, one).collect()} == {0.5}
    assert op9_quality.scored(op9_quality.measured(none), one).collect() == []


# -- pipeline

def test_pipeline(spark):
    docs = C.table(spark, SMALL, "documents")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = C.written(stage(spark, before, SMALL), f"test-{name}")
        assert after.schema == before.schema
        if name == "quality_rules":
            good = C.table(spark, SMALL, "labels").filter("quality = 1")
            words = F.size(C.words(F.col("text")))
            clean = before.filter(words >= 50).join(good, "doc_id", "left_semi")
            assert clean.join(after, "doc_id", "left_anti").count() <= 0.02 * clean.count()
        if name == "secrets":
            assert after.count() == before.count()
            assert after.filter(F.col("text").rlike("token = \"[0-9a-f]{40}")).count() == 0
        before = after
    out = corpus_pipeline.run(spark, SMALL)
    assert out.count() == before.count()
    assert abs(out.agg(F.sum("taken")).first()[0] / out.agg(F.sum("size")).first()[0] - 1.5) < 0.05


def test_pipeline_on_odd_rows(spark, docs, none, tmp_path):
    docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic")).write.parquet(f"{tmp_path}/labels.parquet")
    docs.limit(3).select(F.col("doc_id").alias("item_id"), "text").write.parquet(f"{tmp_path}/benchmark.parquet")
    for start in (docs, none):
        rows = start
        for _, stage in corpus_pipeline.STAGES:
            rows = C.written(stage(spark, rows, str(tmp_path)), "test")
        assert rows.count() <= start.count()

"""HTML extraction, co-training, the pipeline and the registered queries."""

import html
import random
import re
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from cadenza.llm import cotrain, html_extract
from cadenza.llm.common import table
from cadenza.session import ensure_checkpoint_dir
from tests.conftest import SF
from tests.llm.helpers import clash, edge_rows, frame, rows_of
from tools.oracle_check import TABLES, digest


def article(page):
    """The article's blocks, as the given pages mark them."""
    inner = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", inner)
    texts = (" ".join(html.unescape(re.sub(r"<[^>]*(>|$)", lambda m: " " if m[0].startswith("<br") else "", p)).split()) for p in parts)
    return "\n".join(t for t in texts if t)


def test_given_pages(spark):
    pages = table(spark, SF, "pages")
    want = {r.page_id: article(r.html) for r in pages.collect()}
    got = html_extract.page_report(clash(pages)).collect()
    assert sum(want[r.page_id] == r.text for r in got) >= 0.98 * len(want) and all(r.n_chars == len(r.text) for r in got)


def test_held_out_templates():
    """Trained on made pages, the field labels other made pages."""
    feats, labels = html_extract.training_pages([], 250, seed=1)
    numbers, w, tr = html_extract.fit(feats, labels)
    rng, right = random.Random(7), 0
    texts = [" ".join(f"word{rng.randint(0, 999)}" for _ in range(rng.randint(5, 50))) for _ in range(50)]
    for _ in range(100):
        page, main = html_extract._laid_out(rng, texts)
        got = html_extract.extract_text(page, (numbers, w.tolist(), tr.tolist())).split("\n")
        right += got == [t for t, _ in html_extract.blocks(page) if t in main]
    assert right >= 85


# Pages written by hand for the test, in the manner of common site builders; {m} are main paragraphs, {f} other sentences.
LAYOUTS = [
    """<!doctype html><html lang=en><head><title>{f}</title><link rel=x></head><body class="home page"><a class="skip" href="#c">Skip to content</a>
    <header class="site-header"><div class="site-branding"><p class="site-title"><a href=/>The Site</a></p></div>
    <nav id="site-navigation"><ul><li><a href=/a>About</a></li><li><a href=/b>Contact</a></li></ul></nav></header>
    <main id="primary"><article class="post type-post"><header class="entry-header"><h1 class="entry-title">{m}</h1></header>
    <div class="entry-content"><p>{m}</p><p>{m}</p><h2>{m}</h2><p>{m}</p></div></article></main>
    <aside class="widget-area"><section class="widget"><h2>Recent posts</h2><ul><li><a href=/x>{f}</a></li></ul></section></aside>
    <footer class="site-footer"><p>&copy; 2021 The Site. Proudly made.</p></footer></body></html>""",
    """<html><body><div id="cookie-banner"><p>We use cookies to improve the site. {f}</p><button>Accept</button></div>
    <div class="container"><div class="row"><div class="col-8 article-text"><h1>{m}</h1><p>{m}</p><blockquote>{m}</blockquote><p>{m}</p></div>
    <div class="col-4 sidebar-right"><h4>Most read</h4><ol><li><a href=1>{f}</a></li><li><a href=2>{f}</a></li></ol></div></div></div>
    <div class="comments-area"><h3>2 comments</h3><div class="comment-body"><p>{f}</p></div><div class="comment-body"><p>{f}</p></div></div>
    <div class="footer-widgets"><p>All rights reserved.</p></div></body></html>""",
    """<html><body><table width="100%"><tr><td class="nav" width=150><a href=1>Home</a><br><a href=2>News</a><br><a href=3>Links</a></td>
    <td class="content"><h2>{m}</h2><p>{m}</p><p>{m}</p></td></tr><tr><td colspan=2 class="copyright">Copyright 2003 by us</td></tr></table></body></html>""",
    """<html><body><nav class="navbar"><a href=/>Brand</a><form class="search"><input name=q><button>Go</button></form></nav>
    <main><h1>{m}</h1><p>{m}</p><ul><li>{m}</li><li>{m}</li></ul><p>{m}</p>
    <aside class="related"><h3>You may also like</h3><p><a href=1>{f}</a></p></aside><p>{m}</p></main>
    <section class="newsletter-signup"><h3>Get our letter</h3><p>{f}</p><form><input type=email><button>Subscribe</button></form></section>
    <footer><ul><li><a href=/p>Privacy</a></li><li><a href=/t>Terms</a></li></ul></footer></body></html>""",
    """<html><body><div id="wrapper"><div id="top-menu"><ul><li><a href=1>One</a></li><li><a href=2>Two</a></li></ul></div>
    <div class="ad-slot"><p>{f}</p></div><div id="main-content"><p class="lead">{m}</p><p>{m}</p><p>{m}</p><p>{m}</p></div>
    <div class="social-share"><a href=f>Share</a> <a href=t>Tweet</a></div><div class="disclaimer notice"><p>{f}</p></div></div></body></html>""",
    """<html><body><div role="banner"><p>{f}</p></div><div role="navigation"><ul><li><a href=/1>Guide</a></li><li><a href=/2>Index</a></li></ul></div>
    <div role="main"><section><h1>{m}</h1><p>{m}</p></section><section><h2>{m}</h2><p>{m}</p><pre>{m}</pre></section></div>
    <div role="contentinfo"><p>Built on Monday. {f}</p></div></body></html>""",
    """<html><body><ul class="breadcrumb"><li><a href=/>Home</a></li><li><a href=/c>Category</a></li></ul>
    <article itemscope><h1>{m}</h1><figure><img src=x><figcaption>{m}</figcaption></figure><p>{m}</p><p>{m}</p>
    <div class="advertisement"><p>{f}</p></div><p>{m}</p><footer class="author-box"><p>{f}</p></footer></article>
    <section id="comments"><article class="comment"><p>{f}</p></article><article class="comment"><p>{f}</p></article>
    <form class="comment-form"><label>Your comment</label><textarea></textarea></form></section></body></html>""",
    """<html><body><div class="header"><h3><a href=/>Forum</a></h3></div><div class="post-body"><p>{m}</p><p>{m}</p></div>
    <div class="sponsored-box">{f}</div><div class="pagination"><a href=1>1</a> <a href=2>2</a> <a href=3>Next</a></div>
    <div id="login-form"><form><label>User name</label><input><label>Password</label><input><button>Log in</button></form></div></body></html>""",
]


def _page(layout, rng):
    def text(k):
        return " ".join("".join(rng.choice("aeinorstlmdk") for _ in range(rng.randint(2, 9))) for _ in range(k)) + "."

    main = []

    def slot(m):
        k = rng.randint(5, 60) if m[0] == "{m}" else rng.randint(4, 30)
        out = text(k)
        if m[0] == "{m}":
            main.append(out)
        return out

    return re.sub(r"\{[mf]\}", slot, layout), main


def test_layouts_written_apart_from_the_training_ones(spark):
    model = html_extract.train(table(spark, SF.replace("sf0.001", "sf0.01"), "pages").select("page_id", "html"))
    model = (model[0], model[1].tolist(), model[2].tolist())
    rng, right, wrong, blocks_seen, off = random.Random(5), 0, Counter(), 0, 0
    for i, layout in enumerate(LAYOUTS * 25):
        page, main = _page(layout, rng)
        got = html_extract.extract_text(page, model).split("\n")
        right += got == main
        off += len(set(got) ^ set(main))
        blocks_seen += len(html_extract.blocks(page))
        if got != main:
            wrong[i % len(LAYOUTS)] += 1
    assert right >= 0.95 * 25 * len(LAYOUTS), (right, wrong)
    assert off <= 0.02 * blocks_seen


def test_long_pages_are_learned_whole():
    """What only stands after the first chain of a page is learned too."""
    bl = html_extract.blocks("<article>" + "<p>Some words of the text.</p>" * 200 + "</article>" + "<div class=tags><p>Some words of tags.</p></div>" * 100)
    labels = [1] * 200 + [0] * 100
    numbers, w, tr = html_extract.fit([[f for _, f in bl]] * 4, [labels] * 4)
    page = "<article><p>Some words of the text.</p></article><div class=tags><p>Some words of tags.</p></div>"
    assert "is side" in numbers and html_extract.extract_text(page, (numbers, w.tolist(), tr.tolist())) == "Some words of the text."


def test_blocks():
    page = ("<head><title>no</title></head><body><!-- no --><script>no('<p>')</script><p>One &amp; two<br>three<p>four<b>five</b>"
            "<ul><li>a<li><a href=x>b</a></ul><style>p{}</style>&#169; &am <div>tail")
    assert [t for t, _ in html_extract.blocks(page)] == ["One & two three", "fourfive", "a", "b", "© &am", "tail"]
    assert html_extract.blocks(None) == html_extract.blocks("") == html_extract.blocks("<p>  </p>") == []
    assert [t for t, _ in html_extract.blocks("plain < text")] == ["plain < text"]


@pytest.mark.parametrize(("page", "want"), [
    ("<html><head><title>T</title><meta name=x><h1>Head line</h1><p>one", ["Head line", "one"]),
    ("<head><title>T</title><style>s{}</style>plain<p>two", ["plain", "two"]),
    ("<head><title>T</title><noscript><img src=x></noscript></head><body><p>three", ["three"]),
    ("<head><title>T<meta name=x></head><body><p>four", ["four"]),
    *[(f"<div><p>a</p><{t} width=1>no</div><p>b</p><div><{t}>no</{t}>c</div>", ["a", "b", "c"])
      for t in ("svg", "object", "video", "audio", "canvas", "noscript", "template", "iframe")],
    *[(f"<body><p>a</p><{t}><p>b</p><{t}>no</{t}><p>c</p></body>", ["a", "b", "c"]) for t in ("svg", "video", "canvas", "noscript")],
    ("<p>a<object><p>no</p><object>no</object>no</object>b</p>", ["ab"]),
    ("<p>a<svg><foreignObject><div>no</div></foreignObject></svg>b</p>", ["ab"]),
    ("<p>if <math><mi>x</mi><mo>=</mo><mn>1</mn></math> then</p>", ["if x=1 then"]),
    ("<p title=it's>first text. It's a day</p><p title='a>b' id=\"c>d\">next</p>", ["first text. It's a day", "next"]),
    ("<p id=x?q=\"a>one</p><p id = \"b>\">two</p>", ["one", "two"]),
    ("<script>if (a<b && c) {}</script><p>text", ["text"]), ("<p>a<script>var x = '</div><p>no'", ["a"]),
])
def test_nothing_but_raw_content_is_dropped(page, want):
    assert [t for t, _ in html_extract.blocks(page)] == want


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    for _ in range(30):
        e, tr = rng.normal(size=(6, 2)), rng.normal(size=(2, 2))
        paths = [[(i >> k) & 1 for k in range(6)] for i in range(64)]
        value = [sum(e[k][p[k]] for k in range(6)) + sum(tr[a][b] for a, b in zip(p, p[1:], strict=False)) for p in paths]
        assert html_extract.viterbi([tuple(x) for x in e], tr.tolist()) == paths[int(np.argmax(value))]


def test_page_edges(spark):
    rows = [(1, None, None), (2, "u", ""), (2, "u", ""), (None, "u", "<article><p>Text of a page.</p></article>"), (4, "u", "<nav>a</nav>"),
            (5, "u", "<article>" + "<p>Many words in a very long page, again.</p>" * 5000 + "</article>")]
    schema = "page_id long, url string, html string"
    got = {r.page_id: r for r in html_extract.page_report(frame(spark, rows, schema)).collect()}
    assert got[1].text == got[2].text == "" and got[1].n_chars == 0 and got[None].text == "Text of a page."
    assert got[5].text.count("\n") == 4999
    assert html_extract.page_report(frame(spark, [], schema)).count() == 0


def test_page_wide_wrappers_give_no_roles():
    words = " ".join(f"word{i}" for i in range(30)) + "."
    post = "".join(f"<p>{words} {i}.</p>" for i in range(4))
    said = "<div class=\"comments\"><article class=\"comment\"><p>Nice one, thanks.</p></article></div>"
    pages = ['<html class="has-menu"><body class="single-post no-sidebar comments-open">%s</body></html>',
             "<html><body><form>%s</form></body></html>", '<body><div class="no-sidebar comments-open">%s</div></body>',
             '<body><main><section class="with-sidebar">%s</section></main></body>']
    feats, labels = html_extract.training_pages([], 250, seed=1)
    numbers, w, tr = html_extract.fit(feats, labels)
    for page in pages:
        bl = html_extract.blocks(page % (f"<article>{post}</article>" + said))
        assert html_extract.weak_labels(bl) == [1] * 4 + [0]
        text = html_extract.extract_text(page % (f"<article>{post}</article>" + said), (numbers, w.tolist(), tr.tolist()))
        assert text.split("\n")[:4] == [t for t, _ in bl[:4]]


def test_cotraining_held_out(spark):
    sf = SF.replace("sf0.001", "sf0.01")
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    got = {r.target: r for r in cotrain.held_out_report(docs, labels).collect()}
    assert got["quality"].n_right >= 0.95 * got["quality"].n > 0
    assert got["quality"].n < 0.2 * labels.count()
    rows = cotrain.quality_report(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)


def test_toxic_documents_held_out(spark):
    sf = SF.replace("sf0.001", "sf0.1")
    got = {r.target: r for r in cotrain.held_out_report(table(spark, sf, "documents"), table(spark, sf, "labels")).collect()}
    assert got["quality"].n_right >= 0.97 * got["quality"].n and got["toxic"].n_right >= 0.95 * got["toxic"].n
    assert got["toxic"].n_found >= 0.75 * got["toxic"].n_positive and got["toxic"].n_false <= 0.02 * got["toxic"].n


def test_report_fold_has_no_say(spark):
    """Labels of the report fold can be anything: the scores stay."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    wrong = labels.withColumn("quality", F.when(cotrain.fold_of("doc_id") == "report", 1 - F.col("quality")).otherwise(F.col("quality")))
    assert rows_of(cotrain.quality_report(docs, labels)) == rows_of(cotrain.quality_report(docs, wrong))


def test_long_documents_are_learned_from(spark):
    """A word that only occurs far inside very long documents decides."""
    filler = " ".join(f"w{i}" for i in range(6000))
    docs = [(i, filler + (" sludge" if i % 2 else " clear") + f" t{i}", "en", "a", 40_000) for i in range(160)]
    got = cotrain.held_out_report(frame(spark, docs), frame(spark, [(i, 1 - i % 2, 0) for i in range(160)], "doc_id long, quality int, toxic int"))
    row = got.where("target = 'quality'").first()
    assert row.n_right == row.n > 5


def test_cotraining_edges(spark):
    df = clash(frame(spark, edge_rows()))
    labels = frame(spark, [(6, 1, 0), (6, 0, 1), (None, 1, 1), (99, 1, 0)], "doc_id long, quality int, toxic int")
    got = cotrain.quality_report(df, labels)
    assert got.count() == len(edge_rows()) and all(r.kept for r in got.collect())
    assert cotrain.quality_report(df.limit(0), labels).count() == 0
    assert cotrain.quality_report(df, labels.limit(0)).count() == len(edge_rows())


def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
            out = spark.createDataFrame(out.collect(), out.schema)
            assert 0 < out.count()
        docs = out
    assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_pipeline_edges(spark):
    for df in (clash(frame(spark, edge_rows())), frame(spark, [])):
        docs = df
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF)
            if i < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == df.columns
            docs = spark.createDataFrame(out.collect(), out.schema)


def test_pipeline_leaves_one_stage_table(spark):
    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:")) / "cadenza-llm" / spark.sparkContext.applicationId
    before = set(folder.glob("*"))
    rows = rows_of(corpus_pipeline.run(spark, SF))
    new = {p.name for p in set(folder.glob("*")) - before}
    (stages,) = [n for n in new if n.startswith("pipeline-")]
    assert [p.name for p in (folder / stages).iterdir()] == [str(len(corpus_pipeline.STAGES) - 2)]
    again = set(folder.glob("*"))
    assert rows_of(corpus_pipeline.run(spark, SF)) == rows and rows
    assert len(set(folder.glob("*")) - again) == len(new)  # a run leaves as much as the one before


@pytest.mark.parametrize("name", ["op1_decontaminate", "op3_quality_rules", "op4_url_filter", "op7_minhash_dedup"])
def test_sql_twins(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    assert digest(df.columns, [tuple(r) for r in df.collect()])[:3] == digest([x[0] for x in res.description], res.fetchall())[:3]


def test_all_queries_are_registered():
    names = set(E.queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names

"""BPE, mixing, HTML extraction and the pipeline against plain versions."""

import hashlib
import html as htmllib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from firesight.llm import bpe, html, mixing, toxicity
from tests.llm.conftest import SMALL, words
from tests.llm.oracle import duck, same
from tests.llm.test_groups import plain_fingerprint, union
from tests.llm.test_scans import base_spans

PATH = bpe.default_tokenizer()


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_bpe_query_on_small_tables(spark, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = bpe.op2_bpe(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_on_odd_rows(spark, odd_docs, no_docs, tokenizer):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abc éß日́ '\x1c\x85\xa0\t\n<|endoftext|>") for _ in range(20000)), "I'll've " * 3000,
             "word " * 3000 + "<|endoftext|>tail", "日本語テキスト" * 4000, "x\0y" * 2000, " ".join("ab" * 900 for _ in range(40))]
    more = spark.createDataFrame([(None, t) for t in texts] * 2, "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text", "fingerprint").unionByName(more, allowMissingColumns=True).repartition(4)
    want = sorted((str(r.doc_id), tokenizer.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect())
    got = bpe.encode_documents(docs, PATH).collect()
    assert sorted((str(r.doc_id), r.ids) for r in got) == want
    assert all(r.decoded == tokenizer.decode(r.ids, skip_special_tokens=False) for r in got)
    assert bpe.encode_documents(no_docs, PATH).collect() == []


def test_chunks_are_content_defined_and_shared():
    rng = random.Random(2)
    shared = words(rng, 4000, 5000).encode()
    a, b = words(rng, 300).encode() + shared, words(rng, 700).encode() + shared
    def pieces(t):
        ends = bpe.cuts(t)
        assert b"".join(t[s:e] for s, e in zip([0, *ends], ends)) == t
        return {t[s:e] for s, e in zip([0, *ends], ends)}
    common = pieces(a) & pieces(b)
    assert sum(map(len, common)) > 0.8 * len(shared)
    assert bpe.cuts(b"") == [] and max(np.diff([0, *bpe.cuts(b"a" * 100000)])) <= bpe.MOST


def test_repairs_cover_every_split_word():
    w = bpe.words_of(PATH)
    rng = random.Random(3)
    for text in (words(rng, 3000).encode(), b"x" * 30000, "é".encode() * 9000, b"ab " * 4000):
        chunks, repairs = bpe.plan(text, w)
        assert all(a[1] <= b[0] for a, b in zip(repairs, repairs[1:]))
        for _, cut in chunks[:-1]:
            inside = text[cut - 1:cut + 1].split() == [text[cut - 1:cut + 1]]
            assert not inside or any(a < cut < b for a, b, _ in repairs)


def test_a_wrong_join_is_an_error():
    with pytest.raises(ValueError):
        bpe.assemble(np.array([0, 0, 0, 2], "<u4").tobytes() + b"zz" + b"\0" * 4, {0: b"aabb"}, 2)


def skewed_docs(spark, n=500):
    rng = random.Random(5)
    rows = [(i, words(rng, rng.randrange(1, 40)), "en", "big" if i % 3 == 0 else f"s{rng.randrange(12)}", 1) for i in range(n)]
    rows += [(n + i, words(rng, 5), "en", None, 1) for i in range(3)] + [(n + 9, "", "en", "empty", 0), (None, "a b", "en", "s1", 1)]
    rows += [rows[1]] * 3
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


def test_mixing_equals_its_sql(spark, odd_docs, no_docs, monkeypatch):
    names, rows = duck(mixing.ORACLE, SMALL)
    same(mixing.op8_mixing(spark, SMALL), names, rows)
    for docs in (skewed_docs(spark), odd_docs, no_docs):
        monkeypatch.setattr(mixing, "table", lambda *a, d=docs: d)
        names, rows = duck(mixing.ORACLE, documents=docs.select("doc_id", "text", "source").toArrow())
        # equal keys may stand in either order: rows that repeat are compared without their place
        mine = mixing.op8_mixing(None, None)
        assert sorted(mine.columns) == sorted(names)
        at = [names.index(c) for c in ("source", "pass", "block", "n_tokens", "start")]
        got = sorted(map(repr, (tuple(r) for r in mine.select("source", "pass", "block", "n_tokens", "start").collect())))
        assert got == sorted(repr(tuple(r[i] for i in at)) for r in rows)


def test_mixing_meets_entropy_limit_and_budget(spark):
    docs = skewed_docs(spark)
    rows = mixing.document_rows(docs, "doc_id", "text", "source", 42)
    sources = mixing.source_tokens(rows)
    total = sources.agg({"tokens": "sum"}).first()[0]
    n = sources.count()
    alpha = mixing.temperature(sources, total, total, 0.97, None)
    w = [r.weight for r in mixing.weights(sources, total, alpha).collect()]
    assert 0 < alpha < 1 and abs(-sum(x * np.log(x) for x in w) / np.log(n) - 0.97) < 1e-4
    limited = mixing.temperature(sources, total, total, 0.97, 1.2)
    assert max(r.weight * total / r.tokens for r in mixing.weights(sources, total, limited).collect()) <= 1.2 + 1e-5
    for budget in (total // 3, total, 2 * total):
        drawn = mixing.mix(docs, budget=budget, max_repeats=None).collect()
        part = {r.source: int(r.weight * budget + 1e-9) for r in mixing.weights(sources, total, mixing.temperature(
            sources, total, budget, 0.97, None)).collect()}
        for s, b in part.items():
            mine = sorted((r.start, r.n_tokens) for r in drawn if r.source == s)
            assert all(x + k <= b for x, k in mine)
            spans = [(x, x + k) for x, k in mine if k]
            assert all(a[1] <= c[0] for a, c in zip(spans, spans[1:]))  # one stream, nothing twice in a place
            assert sum(k for _, k in mine) > b - 40  # up to the longest document


def test_mixing_passes_have_orders_of_their_own(spark):
    docs = skewed_docs(spark)
    drawn = mixing.mix(docs, budget=200000, max_repeats=None, entropy=0.9).filter("source = 's2'").collect()
    orders = {}
    for r in sorted(drawn, key=lambda r: r.start):
        orders.setdefault(r["pass"], []).append(r.key)
    full = [o for p, o in orders.items() if p < max(orders)]
    assert len(full) > 1 and all(sorted(o) == sorted(full[0]) for o in full)


def test_cover_keeps_every_document(spark, odd_docs):
    docs = skewed_docs(spark)
    out = mixing.mixed_documents(docs, entropy=0.9, cover=True)
    assert out.columns == docs.columns
    have = {(r.doc_id, r.text) for r in docs.filter("source is null or source <> 'empty'").collect()}
    assert {(r.doc_id, r.text) for r in out.collect()} == have
    assert mixing.mixed_documents(odd_docs, cover=True).columns == odd_docs.columns


def test_mixed_rows_come_as_often_as_drawn(spark):
    """Equal ids and texts in several sources, equal rows, and rows that differ in other columns only."""
    from collections import Counter
    rows = [(1, "same text of both", "A", 0), (1, "same text of both", "B", 0), (None, None, "A", 1), (2, "x y z", None, 1)]
    rows += [(7, "copied row here", "B", i % 2) for i in range(5)]
    rows += [(100 + i, f"w{i} more words in the large source", "A", i) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, extra int").repartition(3)
    options = {"budget": 500, "entropy": 0.99, "max_repeats": None}
    want = Counter((r.doc_id, r.source) for r in mixing.mix(docs, **options).collect())
    out = mixing.mixed_documents(docs, **options).collect()
    assert Counter((r.doc_id, r.source) for r in out) == want and want[7, "B"] % 5
    copies = Counter((r.doc_id, r.extra) for r in out if r.doc_id == 7)
    assert abs(copies[7, 0] / 3 - copies[7, 1] / 2) <= 1


def test_cover_keeps_the_repetition_limit(spark):
    """A source of 2,000 documents beside sources of one: no document comes more than four times."""
    from collections import Counter
    rows = [(i, f"w{i} and five words more here", "large", None) for i in range(2000)]
    rows += [(5000 + i, "a few words", f"small{i}", None) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, extra int")
    times = Counter(r.doc_id for r in mixing.mixed_documents(docs, entropy=0.9, cover=True).collect())
    assert len(times) == len(rows) and max(times.values()) <= 4 and times[5000] > 1
    assert sum(times.values()) < 2100


def test_repeated_substrings_against_brute_force():
    rng = random.Random(6)
    for _ in range(30):
        pages = [[rng.randrange(4) for _ in range(rng.randrange(30))] for _ in range(rng.randrange(1, 6))]
        depth = rng.choice([1, 2, 3, 5, 8])
        where = {}
        for i, p in enumerate(pages):
            for j in range(len(p) - depth + 1):
                where.setdefault(tuple(p[j:j + depth]), set()).add(i)
        want = []
        for p in pages:
            gone = [False] * len(p)
            for j in range(len(p) - depth + 1):
                if len(where[tuple(p[j:j + depth])]) > 1:
                    gone[j:j + depth] = [True] * depth
            want += gone
        flat = np.array([t for p in pages for t in p], dtype=np.int64)
        page = np.repeat(np.arange(len(pages)), [len(p) for p in pages])
        assert html.repeated(flat, page, depth).tolist() == want


def test_html_on_small_tables(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    rows = html.op9_html(spark, SMALL).collect()
    assert {r.page_id for r in rows} == set(pages) and len(rows) == len(pages)
    for r in rows:
        inner = re.search("<article>(.*)</article>", pages[r.page_id].html, re.S)[1]
        plain = " ".join(htmllib.unescape(re.sub("</?(p|h1|br)>", "\n", inner).replace("<b>", "")).split())
        assert r.text == plain and r.n_chars == len(plain) and r.url == pages[r.page_id].url


def test_html_rules_and_unique_runs():
    furniture = "<div class=top>Home page of the big site with all of our news today</div>"
    texts = html.main_texts([
        f"<html><body>{furniture}<div>Unique one text</div></body></html>",
        f"{furniture}<div>Other in<i>line</i> &amp; more</div><div id='comments'>no</div><p class='notice'>no<p>tail",
        "<p>a<b>b</b>c<br>d <script>if(a<b)\"</p>\"</script>e", "", "<nav>x", "text < 5 & <a href='x>y'>link</a>",
        "<article><header><h1>T</h1></header>x<aside>no</aside><form>no</form></article><div>outside</div>",
        "<main role=main class='content related'>kept <!-- no --> too</main><footer>no"])
    assert texts == ["Unique one text", "Other inline & more tail", "abc d e", "", "", "text < 5 & link", "T x", "kept too"]


def test_html_on_odd_rows(spark):
    rows = [(1, "http://a/x", None), (2, None, "<p>hi"), (None, "odd", "<p>yo"), (3, "http://a/y", ""), (3, "http://a/y", ""),
            (4, "http://b/" + "z" * 300, "<p>" + "long " * 50000), (5, "http://a/q", "<" * 5000), (6, "http://a/q", "<a b='" * 3000)]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], "page_id long, url string, html string, text string, _host int")
    got = html.extract(df).collect()
    assert sorted((str(r.page_id), str(r.url)) for r in got) == sorted((str(r[0]), str(r[1])) for r in rows)
    assert {r.page_id: r.text for r in got}[2] == "hi"
    assert html.extract(df.limit(0)).collect() == []


def test_pipeline_against_plain_versions(spark, tokenizer):
    """Each stage on the small tables, held against a plain version of what it must do with its own input."""
    from firesight.llm.common import table, written
    docs, seen = table(spark, SMALL, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = written(stage(spark, docs, SMALL), f"test-{name}")
        seen[name] = before, docs.collect()
        if name != "bpe":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]

    before, after = seen["toxicity"]
    table_docs = table(spark, SMALL, "documents")
    model = toxicity.fit(table_docs, table(spark, SMALL, "labels"))
    known = toxicity.Known(model.terms)
    want = {d.doc_id for d in before if model.score(known.count((d.text or "").encode()))[0] < toxicity.THRESHOLD}
    assert {d.doc_id for d in after} == want

    before, after = seen["simhash"]
    fps = {d.doc_id: plain_fingerprint(d.text) for d in before}
    root = union(fps, [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2])
    assert sorted(d.doc_id for d in after) == sorted(set(root.values()))

    before, after = seen["secrets"]
    text = {d.doc_id: d.text for d in after}
    assert set(text) == {d.doc_id for d in before}
    for d in before:
        if base_spans(d.text):
            assert "[secret]" in text[d.doc_id] and not base_spans(text[d.doc_id])
        else:
            assert text[d.doc_id] == d.text
    assert all(d.n_chars == len(d.text) for d in after)

    before, after = seen["mixing"]
    assert {(d.doc_id, d.text) for d in after} == {(d.doc_id, d.text) for d in before}

    before, after = seen["bpe"]
    ids = {d.doc_id: tokenizer.encode(d.text or "", add_special_tokens=False).ids for d in before}
    assert sorted(d.doc_id for d in after) == sorted(d.doc_id for d in before)
    assert all(d.ids == ids[d.doc_id] and d.n_tokens == len(d.ids) for d in after)

    whole = corpus_pipeline.run(spark, SMALL)
    assert sorted((r.doc_id, r.ids_sha256) for r in whole.collect()) == sorted((r.doc_id, r.ids_sha256) for r in after)


def host_rows(spark, pages):
    rows = [(i, "http://a/" + str(i), p) for i, p in enumerate(pages)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def test_html_repeats_over_a_large_host(spark):
    """A banner on 5 of 200 pages without article or main goes from all of them, as from a small host."""
    rng = random.Random(9)
    banner = " ".join(words(rng, 12).split())
    own = [words(rng, 30, 100000) for _ in range(200)]
    pages = [f"<div>{banner}</div><div>{t}</div>" if i % 40 == 0 else f"<div>{t}</div>" for i, t in enumerate(own)]
    got = {r.page_id: r.text for r in html.extract(host_rows(spark, pages)).collect()}
    assert got == dict(enumerate(own))
    assert [got[i] for i in range(200)] == html.main_texts(pages)


def test_html_blocks_beside_an_article(spark):
    rng = random.Random(10)
    body, banner, card = words(rng, 40, 100000), words(rng, 12, 100000), "Read our other story"
    teaser = f"<div>{body}</div><article>{card}</article><div>{banner}</div><div>short</div>"
    other = f"<div>{words(rng, 40, 100000)}</div><div>{banner}</div>"
    pages = [teaser, other, f"<div class='page has-sidebar'><article>{body} one</article></div>", f"<form><main>{body} two</main></form>",
             f"<aside><article>{body}</article></aside>", f"<article>x<div class=comments><article>no</article></div></article>"]
    got = {r.page_id: r.text for r in html.extract(host_rows(spark, pages[:2])).collect()}
    assert got[0] == f"{body} {card}" and banner not in got[1]
    assert html.main_texts(pages[2:]) == [f"{body} one", f"{body} two", "", "x"]


def test_html_articles_that_are_furniture():
    body = "<article><p>The text of the page</p></article>"
    comment = "<article class='comment'>First!</article>"
    pages = {f"{body}<section class='comments'>{comment}</section>": "The text of the page",
             f"{body}<section class='comments'><article>A much longer reader comment than the page's own text</article></section>":
             "The text of the page",
             f"<article>Own text{comment}<article class='ad'>Buy</article> goes on</article>": "Own text goes on",
             f"{body}<div class='related'><article>Another page</article></div>": "The text of the page",
             f"{body}<div class='right-sidebar'><article>Card</article></div><article class='advert'>Buy</article>": "The text of the page",
             "<main><div class='social policy'>About social policy</div><div class='share'>Tweet</div></main>": "About social policy",
             "<div class='content related'><article>Only text</article></div>": "Only text",
             "<div class='has-sidebar'><article>One post</article><article>Two posts</article></div>": "One post Two posts",
             "<p>foo<img src=x>bar</p>": "foobar"}
    assert html.main_texts(list(pages)) == list(pages.values())


def plain_text(page):
    """An extractor of its own kind: a tree by the standard parser, then the text of its article without furniture."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.path, self.blocks = [], []

        def handle_starttag(self, tag, attrs):
            if tag not in ("br", "img", "hr", "meta", "link", "input"):
                self.path.append((tag, " ".join(v or "" for k, v in attrs if k in ("class", "id", "role"))))
            if tag not in ("b", "i", "a", "em", "strong", "span", "img"):
                self.blocks.append("")

        def handle_endtag(self, tag):
            while self.path and any(t == tag for t, _ in self.path) and self.path.pop()[0] != tag:
                pass
            if tag not in ("b", "i", "a", "em", "strong", "span"):
                self.blocks.append("")

        def handle_data(self, data):
            tags = [t for t, _ in self.path]
            bad = {"nav", "footer", "aside", "form", "script", "style", "button", "template", "noscript", "title"} & set(tags)
            about = " ".join(c for _, c in self.path).lower().split()
            named = {"comment", "comments", "ad", "advert", "related", "share", "newsletter", "cookie", "notice"} & set(about)
            if "article" in tags and not bad and not named:
                if not self.blocks:
                    self.blocks.append("")
                self.blocks[-1] += data

    reader = Reader()
    reader.feed(page or "")
    return " ".join(t for b in reader.blocks for t in [" ".join(b.split())] if t)


def test_html_equals_an_extractor_of_another_kind(spark):
    rows = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    got = {r.page_id: r.text for r in html.op9_html(spark, SMALL).collect()}
    assert len(rows) > 20 and got == {r.page_id: plain_text(r.html) for r in rows}


def test_html_copies_keep_their_text(spark):
    rng = random.Random(11)
    text, footer = words(rng, 400, 100000), words(rng, 10, 100000)
    near = " ".join([*text.split()[:-1], "edited"])
    pages = [f"<div>{t}</div><div>{footer}</div>" for t in (text, text, near, *(words(rng, 60, 100000) for _ in range(80)))]
    got = {r.page_id: r.text for r in html.extract(host_rows(spark, pages)).collect()}
    assert got[0] == got[1] == text and got[2] == near
    assert not any(footer in t for t in got.values())
    assert [got[i] for i in range(len(pages))] == html.main_texts(pages)


def test_every_oracle_is_sql_text():
    from firesight.llm import queries
    assert all(isinstance(sql, str) for sql in queries.oracle_sql().values())
    assert set(queries.oracle_sql()) <= set(queries.queries())


def test_mix_stage_keeps_documents_of_a_wordless_source(spark):
    rows = [(i, words(random.Random(i), 9), "en", f"s{i % 2}", 1) for i in range(20)]
    rows += [(100, "", "en", "empty", 0), (101, None, "en", "empty", 0), (101, None, "en", "empty", 0), (102, " \n", "en", None, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.mix_sources(spark, docs, None)
    assert out.columns == docs.columns
    got = sorted((r.doc_id, r.text) for r in out.collect() if r.doc_id >= 100 and r.text is not None)
    assert got == [(100, ""), (102, " \n")] and out.filter("doc_id = 101").count() == 2
    assert {r.doc_id for r in out.collect()} == {r[0] for r in rows}


def test_pipeline_stages_on_odd_and_empty_tables(spark, odd_docs):
    """Every stage keeps the columns, clashing ones included, and decides nulls, empty, repeated and long rows as stated."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumns({"fingerprint": F.lit("x"), "_key": F.lit(1).cast("long")})
    rows = docs.unionByName(odd_docs)
    columns = rows.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, rows, SMALL).persist()
        none = stage(spark, rows.limit(0), SMALL)
        assert none.collect() == [] and none.columns == out.columns, name
        got = out.collect()
        if name != "bpe":
            assert out.columns == columns, name
        if name in ("toxicity", "simhash"):
            assert 0 < len(got) <= rows.count() and len(set(got)) <= len(set(rows.collect()))
            assert set(got) <= set(rows.collect())
        if name == "simhash":  # texts without words are one group; of an id's equal rows one stays
            assert sum(not (r.text or "").strip(" \t\n") for r in got) == 1
        if name == "secrets":
            assert len(got) == rows.count() and sum(r.text is None for r in got) == sum(r.text is None for r in rows.collect())
        if name == "mixing":
            assert {(r.doc_id, r.text) for r in got} == {(r.doc_id, r.text) for r in rows.collect()}
        if name == "bpe":
            assert len(got) == rows.count()
        out.unpersist()

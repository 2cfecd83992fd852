"""Vectors, conversations, pages, the registered queries and the pipeline."""

import os
import time
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from checks.compare import expected_rows
from daybook.llm import chat, html, pivots
from daybook.llm.oracle import ORACLE_SQL
from daybook.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="shared tables absent")


def test_neighbours_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    matrix = rng.normal(size=(1500, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(matrix)]
    odd = [(9001, None), (9002, [0.0] * 16), (9003, [float("nan")] * 16), (None, [1.0] * 16), (9005, []), (9006, [None] * 16), (9007, [float("inf")])]
    # Other numbers of dimensions, one of them large enough for pivots of its own.
    odd += [(9200, [1.0]), (9201, [3.0]), (9300, [2.5, 1.0])]
    other = [(20_000 + i, v.tolist()) for i, v in enumerate(rng.normal(size=(400, 5)))]
    twin = [(1600, matrix[0].tolist()), (1601, matrix[0].tolist()), rows[5]]
    frame = spark.createDataFrame(rows + odd + twin + other, "vec_id long, embedding array<double>")
    frame = frame.withColumn("ids", F.lit("clash")).withColumn("dim", F.lit(1)).withColumn("block", F.lit(None))
    monkeypatch.setattr(pivots, "BLOCK_ROWS", 600)
    monkeypatch.setattr(pivots, "QUERY_ROWS", 7)
    monkeypatch.setattr(pivots, "MIN_RERANKED", 150)
    found = pivots.nearest_neighbours(frame, frame.where("vec_id % 100 = 0"))
    real = {i: np.array(v) for i, v in rows + twin + other + [x for x in odd if 9200 <= (x[0] or 0) <= 9300]}
    expected = []
    for q in [i for i in real if i % 100 == 0]:
        order = sorted((float(np.sqrt(((real[q] - v) ** 2).sum())), i) for i, v in real.items() if i != q and len(v) == len(real[q]))[:10]
        expected += [(q, i, s, n + 1) for n, (s, i) in enumerate(order)]
    exact = spark.createDataFrame(expected, "query_id long, vec_id long, score double, rank int")
    assert pivots.recall(found, exact) >= 0.9
    # What is found has exact scores and is in order; reranking all finds all.
    whole = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in pivots.nearest_neighbours(frame, frame.where("vec_id % 100 = 0"), reranked=1.0).collect())
    assert whole == sorted((q, n, i, round(s, 9)) for q, i, s, n in expected)
    by_query = {}
    for r in found.orderBy("query_id", "rank").collect():
        assert r.vec_id in real and abs(r.score - np.sqrt(((real[r.query_id] - real[r.vec_id]) ** 2).sum())) < 1e-9
        by_query.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert all(x == sorted(x) for x in by_query.values())
    first = found.where("query_id = 0").orderBy("rank").limit(2).collect()
    assert [(r.rank, r.vec_id, r.score) for r in first] == [(1, 1600, 0.0), (2, 1601, 0.0)]
    assert found.count() == len(expected) == 16 * 10 + 1 + 4 * 10
    assert pivots.nearest_neighbours(frame.limit(0), frame.limit(0)).count() == 0
    few = frame.where("vec_id in (0, 1, 2)")
    assert pivots.nearest_neighbours(few, few).count() == 6


def test_neighbours_among_copies(spark, monkeypatch):
    rng = np.random.default_rng(4)
    matrix = rng.normal(size=(600, 16))
    copy = matrix[0].tolist()
    rows = [(i, v.tolist()) for i, v in enumerate(matrix)] + [(10_000 - i, copy) for i in range(400)]
    rows += [(i, matrix[i].tolist()) for i in range(40, 50) for _ in range(8)] + [(45, copy), (46, matrix[47].tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    monkeypatch.setattr(pivots, "MIN_RERANKED", 60)
    monkeypatch.setattr(pivots, "BLOCK_ROWS", 300)
    asked = frame.where("vec_id in (0, 9700, 9990, 45)")
    found = {}
    for r in pivots.nearest_neighbours(frame, asked).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    same = sorted({i for i, v in rows if v == copy})
    assert set(found) == {0, 9700, 9990, 45}
    for q in found:
        first = [i for i in same if i != q][:10]
        assert sorted(found[q]) == [(n + 1, i, 0.0) for n, i in enumerate(first)]
    around = frame.where("vec_id between 40 and 44")
    near = pivots.nearest_neighbours(frame, around, reranked=1.0).groupBy("query_id").agg(F.countDistinct("vec_id").alias("n")).collect()
    assert [r.n for r in near] == [10] * 5
    assert pivots.closest(np.array([3, 1, 2, 2, 2, 9]), 2).tolist() == [1, 2, 3, 4]


ODD = [
    "", None, "<|im_end|>", "<|im_start|>user\nx<|im_end|>\n", "<\\|im_end|>", "<\\\\|", "a<", "|im_end|>\n", "<|im_end|", "\n\n", "<|n|>",
    "<|im_end|>\n<|im_start|>assistant\nno", "\\n", "😀<|x", "<<|im_end|>>",
]


def test_chat_reads_back(spark):
    roles = ["user", "assistant", None, "a\nb", "<|im_start|>", "<|n|>", "x\\", "<\n|"]
    rows = [(c, t, roles[(c + t) % len(roles)], ODD[(3 * c + t) % len(ODD)]) for c in range(12) for t in range(6)]
    rows += [(None, 0, "user", "a"), (50, None, "assistant", "b"), (50, 1, "assistant", "c"), (50, 1, "assistant", "c")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    done = chat.formatted(frame).select("*", chat.turns_of(F.col("formatted")).alias("back"), chat.trained_texts(F.col("formatted"), F.col("mask")).alias("loss"))
    for r in done.collect():
        source = sorted(((t is not None, t, role or "", x or "") for c, t, role, x in rows if c == r.conv_id), key=lambda x: (x[0], x[1] or 0, x[2:]))
        assert [(t.role, t.text) for t in r.back] == [x[2:] for x in source]
        assert r.loss == [x[3] for x in source if x[2] == "assistant"] and r.n_turns == len(source)
    assert chat.formatted(frame.limit(0)).count() == 0


def test_long_conversations_read_back(spark):
    rows = [(1, n, "assistant" if n % 2 else "user", ODD[n % len(ODD)]) for n in range(1500)] + [(2, 0, "user", "<|im_end|>\n" * 20_000), (2, 1, "assistant", "é" * 200_000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for r in chat.formatted(frame).select("*", chat.turns_of(F.col("formatted")).alias("back"), chat.trained_texts(F.col("formatted"), F.col("mask")).alias("loss")).collect():
        source = [(role, x or "") for c, _, role, x in rows if c == r.conv_id]
        assert [(t.role, t.text) for t in r.back] == source and r.loss == [x for role, x in source if role == "assistant"]


def page(body):
    return f"<html><head><title>t</title><style>p{{}}</style></head><body>{body}</body></html>"


def extracted(spark, rows):
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("near", F.lit(1))
    return [(r.page_id, r.text, r.n_chars) for r in html.main_texts(frame).collect()]


def test_pages(spark):
    menu, note = "<div>Home of all</div><div>Shared line</div>", "<div>Bottom line</div>"
    rows = [
        (1, "http://a.org/x/1", page("<nav>n</nav><article><h1>T &amp; U</h1><p>one\n two<br>three<p>four<script>var a='</p>'</script></article><footer>f</footer>")),
        (2, "http://a.org/y/1", page(f"{menu}<p>Own first text</p>{note}")), (3, "http://a.org/y/12", page(f"{menu}<p>Own second</p>{note}")),
        (4, "http://b.org/", page(f"{menu}<p>Only page</p>")), (5, None, None), (6, "nonsense", ""), (None, "http://c.org/q", "<p>cut <b>off &lt"),
        (7, "http://a.org/x/1", page("<article><p>one\n two</p><div class='comments'>c</div><form>q</form><!-- <p>no</p> --></article>")),
        (8, "http://a.org/y/2/z", page(f"{menu}<p>Own third text</p>{note}")),
    ]
    found = {i: (t, n) for i, t, n in extracted(spark, rows)}
    assert {i: t for i, (t, _) in found.items()} == {
        1: "T & U\n\none two three\n\nfour", 2: "Own first text", 3: "Own second", 4: "Home of all\n\nShared line\n\nOnly page", 5: "", 6: "", None: "cut off <", 7: "one two",
        8: "Own third text",
    }
    assert found[1][1] == len(found[1][0])
    assert extracted(spark, []) == []


def test_copies_without_an_article_keep_their_text(spark):
    menu = "<div>Home</div><div>Contact us</div>"
    story = "".join(f"<p>Paragraph {i} of the story that many pages tell.</p>" for i in range(6))
    other = [page(f"{menu}<p>Quite another text of its own, number {x}, and longer than any line.</p>") for x in "abc"]
    rows = [(1, "http://a.org/s/1", page(menu + story)), (1, "http://a.org/s/1", page(menu + story)), (2, "http://m.a.org/s/1", page(menu + story))]
    rows += [(3, "http://a.org/s/1/print", page(f"{menu}<h1>Print</h1>{story}")), (4, "http://a.org/s/1b", page(f"{menu}{story}<p>More.</p>"))]
    alone = dict((i, t) for i, t, _ in extracted(spark, rows))
    whole = "\n\n".join(f"Paragraph {i} of the story that many pages tell." for i in range(6))
    # Copies alone say nothing of what is furniture: nothing goes.
    assert alone == {1: f"Home\n\nContact us\n\n{whole}", 2: f"Home\n\nContact us\n\n{whole}", 3: f"Home\n\nContact us\n\nPrint\n\n{whole}", 4: f"Home\n\nContact us\n\n{whole}\n\nMore."}
    found = extracted(spark, rows + [(10 + n, f"http://a.org/t/{n}", x) for n, x in enumerate(other)])
    texts = dict((i, t) for i, t, _ in found)
    assert len(found) == 8 and texts[1] == whole and texts[3] == f"Print\n\n{whole}" and texts[4] == f"{whole}\n\nMore."
    assert texts[2] == alone[2] and texts[11] == "Quite another text of its own, number b, and longer than any line."


def test_pages_with_an_article_are_differenced_too(spark):
    about = [f"What page {x} alone tells, longer than any line that stands around it on the pages of this host." for x in "abcd"]
    around = "<div>A line of the host that stands on all of its pages.</div>" * 2
    rows = [(n, f"http://a.org/n/{n}", page(f"<h1>The host</h1>{around}<article><p>{x}</p></article><div>Seen {n} times</div>")) for n, x in enumerate(about)]
    # Less than half of all text stands in the article, but nearly all of what is left.
    assert main_of(rows[0][2]) is None
    # Lines of articles stay, whatever other pages share of them.
    told = "<h2>Summary</h2><p>A passage that all pages of this host tell alike.</p>"
    rows += [(10 + n, f"http://b.org/n/{n}", page(f"<h1>The host</h1><article>{told}<p>{x}</p></article>")) for n, x in enumerate(about)]
    found = {i: t for i, t, _ in extracted(spark, [*rows, rows[0]])}
    assert [found[n] for n in range(4)] == about
    assert [found[10 + n] for n in range(4)] == [f"Summary\n\nA passage that all pages of this host tell alike.\n\n{x}" for x in about]


def main_of(text):
    return html.main_blocks(html.blocks(text))


def test_the_article_is_where_the_text_is():
    texts = lambda body: [b.text for b in html.blocks(page(body))]
    main = lambda body: html.main_blocks(html.blocks(page(body)))
    story = "<p>A story in a plain element, longer than what is around it.</p>"
    assert main(f"<div><h1>Head</h1>{story}</div><article>Read next</article>") is None
    assert main(f"<h1>Head</h1><article>{story}</article><p>loose</p>") == ["Head", "A story in a plain element, longer than what is around it."]
    assert main(f"<h1>Site</h1><article><h1>Head</h1>{story}</article>")[0] == "Head"
    names = ["article-header", "social-policy", "notice-period", "search-theory", "headerless", "adsorption", "commentary", "shared"]
    assert texts("<article>" + "".join(f"<div class='x {n}'>{n}</div>" for n in names) + "</article>") == names
    names = ["site-header", "cookie-banner", "ad", "AD-slot", "sidebar left", "relatedPosts", "comment-list", "article-comments", "x share", "site_footer_2"]
    assert texts(f"<article>{story}" + "".join(f"<div class='{n}'>{n}</div>" for n in names) + "</article>") == texts(story)
    assert texts(f"<form id=aspnet><div class=menu>m</div>{story}<form>q</form></form>")[0].startswith("A story")
    assert texts(f"<div class=share>{story}</div>") == texts(story) and texts(f"<div class=widget><h1>t</h1></div>{story}")[0] == "t"
    assert texts(f"<article>{story}<section id=comments>{story * 9}<article class=comment>{story}</article></section></article>") == texts(story)
    assert texts(f"<div class=ad>{story}</div><article>short</article>") == ["short"] and len(texts(f"<form><article>{story}</article></form>")) == 1
    assert texts("<div>a<span class=ad>b<span>c</span>d</span>e</div>") == ["ae"]


def test_hostile_pages_take_time_in_proportion():
    n = 30_000
    pages = ["<div>" + "<b>x</i>" * n + "<i>" + "</b>" * n, "<i><div>" + "<b>x</i>" * n, '<a "' * n, "<a " * n, "<div class=ad>" * n + "x", "<p class='" * n, "<!-" * n, "<script>" * n]
    started = time.process_time()
    for x in pages:
        html.blocks(x)
    assert html.common_lines([1] * n + [2] + [3, 4] * 100, [5] + [1] * n + [4, 3, 3] * 100)[: n - 9] == list(range(n - 9))
    html.common_lines(list(range(5)) * 4000, list(range(4, -1, -1)) * 4000)
    assert time.process_time() - started < 30


class PlainText(HTMLParser):
    """What stands in <article>, a paragraph per block element: a plain version for well-formed pages."""

    def __init__(self):
        super().__init__()
        self.out, self.depth, self.skip = [""], 0, 0

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        self.skip += tag in ("script", "style")
        self.out += [""] if tag in ("p", "h1", "article", "div") else []
        self.out[-1] += " " if tag == "br" else ""

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        self.skip -= tag in ("script", "style")
        self.out += [""] if tag in ("p", "h1", "article", "div") else []

    def handle_data(self, data):
        self.out[-1] += data if self.depth and not self.skip else ""


@tables
def test_pages_equal_a_plain_extractor(spark):
    found = {r.page_id: r.text for r in QUERIES["op8_html"](spark, SF_DIR).collect()}
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    assert len(found) == len(pages)
    for r in pages:
        plain = PlainText()
        plain.feed(r.html or "")
        assert found[r.page_id] == "\n\n".join(" ".join(x.split()) for x in plain.out if x.split())


def test_common_lines_is_longest():
    rng = np.random.default_rng(1)
    for _ in range(200):
        x, y = (rng.integers(0, 5, rng.integers(0, 14)).tolist() for _ in range(2))
        best = np.zeros((len(x) + 1, len(y) + 1), int)
        for i, a in enumerate(x):
            for j, b in enumerate(y):
                best[i + 1, j + 1] = best[i, j] + 1 if a == b else max(best[i, j + 1], best[i + 1, j])
        found = html.common_lines(x, y)
        rest = iter(y)
        assert len(found) == best[-1, -1] and all(x[i] in rest for i in found)


@tables
@pytest.mark.parametrize("name", ORACLE_SQL)
def test_queries_equal_their_sql(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    types, rows = expected_rows(SF_DIR, ORACLE_SQL[name])
    assert set(types) == set(df.columns)
    assert sorted(map(repr, map(tuple, df.select(list(types)).collect()))) == sorted(map(repr, rows))


@tables
def test_pipeline_keeps_columns_and_clean_documents(spark):
    assert set(QUERIES) <= set(__spark_entry__.queries())
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF_DIR)
        assert after.dtypes == docs.dtypes, name
        assert after.count() >= 0.5 * before, name
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0, name
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "word", None, None, 4)], docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, SF_DIR).count() <= 4, name

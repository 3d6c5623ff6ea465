import numpy as np
from llm_helpers import collect, make_docs  # noqa: F401
from mentionscope.llm import cover_tree, html_text, stages


def brute(rows, cosine=0.9):
    n = len(rows)
    good = []
    for _, v in rows:
        a = None if not v or any(c is None for c in v) else np.array(v, float)
        good.append(a if a is not None and np.isfinite(a).all() and (a != 0).any() else None)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    links = [0] * n
    for i in range(n):
        for j in range(n):
            a, b = good[i], good[j]
            if i != j and a is not None and b is not None and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine:
                links[i] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, links[i], least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(rows))


def test_cover_tree_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(25, 8))
    rows = [(i, [float(x) for x in centres[i % 25] + rng.normal(size=8) * (0.05, 0.35, 0.8)[i % 3]]) for i in range(400)]
    rows += [(400 + i, rows[3][1]) for i in range(20)] + [(500, None), (501, []), (502, [0.0] * 8), (503, [None] + [1.0] * 7),
             (504, [float("nan")] * 8), (505, [float("inf")] + [1.0] * 7), (506, [1.0, 2.0]), (507, [2.0, 4.0]), (508, [3.0 * x for x in rows[0][1]])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    for block in (8192, 40):
        monkeypatch.setattr(cover_tree, "BLOCK", block)
        got = collect(cover_tree.near_duplicates(df.selectExpr("*", "1 AS rep", "2 AS v")), "vec_id", "n_links", "component_id", "kept")
        assert sorted(got) == brute(rows)
    assert cover_tree.near_duplicates(df.where("false")).count() == 0


def test_vectors_of_very_many_lengths(spark):
    """100 lengths of three vectors, two of which link."""
    rows = [(3 * n + j, [1.0] * (n - 1) + [-30.0 if j == 2 else 1.0 + j / 9]) for n in range(2, 102) for j in range(3)]
    got = cover_tree.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3))
    assert sorted(collect(got, "vec_id", "n_links", "component_id", "kept")) == brute(rows)


def test_dual_traversal_prunes_and_keeps_pairs():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(30, 6))[rng.integers(0, 30, 300)] + rng.normal(size=(300, 6)) * 0.1
    x /= np.linalg.norm(x, axis=1)[:, None]
    tree = cover_tree.Tree(x, *cover_tree.build(x))
    found = {(int(i), int(c)) for part, cols, links in cover_tree.linked_pairs(tree, tree, rows=16) for i, row in zip(part, links) for c in cols[row]}
    assert found == {(i, j) for i, j in zip(*np.nonzero(x @ x.T >= 0.9))}


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head><body class="page">
<header><a href="/">Home</a> Site name</header><nav><ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li></ul></nav>
<div class="cookie-notice">We use cookies to make this long notice look like a paragraph of text, really we do.</div><!-- ad > -->
<article><h1>A title&amp;more</h1><p>First <b>bo</b>ld  paragraph&nbsp;with <a href="x">a link</a>.<p>Second &lt;one&gt;<br>line
</p><ul><li>item one</li><li>item two</li></ul><form><label>Name</label><input></form><div class="ad">Buy now, this is the best offer of all.</div>
<section id="comments"><p>I am a reader and I have quite a long comment to make here.</p></section></article>
<aside>Side words that go on and on for a while to look real.</aside><footer>&copy; 2020 Someone</footer></body>"""


def test_main_text(spark):
    want = "A title&more First bold paragraph with a link. Second <one> line item one item two"
    assert html_text.main_text(PAGE) == want
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (None, "u", "<p>"), (4, "u", "<article><p>" + "w " * 50000 + "</article>"), (1, "u", PAGE)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text")).collect()
    by = {r["page_id"]: r for r in got}
    assert len(got) == 6 and by[1]["text"] == want and by[1]["n_chars"] == len(want) and by[2]["text"] == "" and by[None]["text"] == ""
    assert by[4]["text"].count("w") == 50000
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


ARTICLE = "<h1>A title</h1><p>First paragraph of the text that is long enough.</p><p>A second one, with <a href='x'>a link</a> in it.</p>"
ARTICLE_TEXT = "A title First paragraph of the text that is long enough. A second one, with a link in it."
AROUND = "<nav><a href='/'>Home</a> <a href='/b'>B</a></nav>{}<aside class='sidebar'><p>Side words that go on for a while.</p></aside><footer>The end</footer>"


def test_wrappers_that_say_furniture():
    """One furniture word on an element around the article loses nothing of it, and
    real furniture inside or beside stays out."""
    comments = "<section id='comments'><h2>Comments</h2><div class='comment-body'><p>I am a reader with a comment to make.</p></div></section>"
    ad = "<div class='ad'>Buy now, this is the best offer of all.</div>"
    for page in (
        AROUND.format(f"<article>{ARTICLE}{ad}</article>"),
        AROUND.format(f"<div class='layout has-sidebar'><article>{ARTICLE}{ad}</article>{comments}</div>"),
        AROUND.format(f"<article class='post no-comments'>{ARTICLE}{ad}</article>"),
        AROUND.format(f"<main class='with-sidebar'><div class='side-by-side'><article class='post has-comments'>{ARTICLE}</article></div>{comments}</main>"),
        AROUND.format(f"<form id='search-form'><div class='post no-comments'>{ARTICLE}</div>{comments}</form>"),
        "<div id='page' class='header-fixed'>" + AROUND.format(f"<article>{ARTICLE}</article>{comments}") + "</div>",
        "<div id='page' class='header-fixed'>" + AROUND.format(f"<div class='content'>{ARTICLE}{ad}</div>") + "</div>",
    ):
        assert html_text.main_text(page) == ARTICLE_TEXT, page
    plain = "".join(f"<p>{'word ' * 30}{i}.</p>" for i in range(6))
    assert html_text.main_text(f"<div id='page' class='header-fixed'>{plain}<div class='ad'>{'buy ' * 20}</div></div>").split() == [
        w for i in range(6) for w in ["word"] * 30 + [f"{i}."]]
    long = f"<section class='comments'>{'<p>' + 'reply ' * 40 + '</p>'}{'<p>' + 'answer ' * 160 + '</p>'}<p>{"see " * 90}<a href='x'>{"there " * 60}</a></p></section>"
    assert html_text.main_text(f"<article>{ARTICLE}</article>{long}") == ARTICLE_TEXT
    assert html_text.main_text(f"<article hidden>{ARTICLE}</article>") == ""
    deep = "".join(f"<div class='content sidebar'>w{i} " for i in range(3000))
    assert len(html_text.main_text(f"<article>{deep}").split()) >= 1


def test_whole_pages_table(spark):
    import html
    import re
    from mentionscope.llm.catalog import op8_main_text
    sf = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in op8_main_text(spark, sf).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        assert r["text"] == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", article)).split())


def test_stages_take_effect_and_pass_edges(spark, make_docs, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    item = spark.read.parquet(f"{sf}/benchmark.parquet").first()["text"]
    odd = make_docs([(None, None, None, None), (9001, ""), (9002, "call +1 (017) 555-7713 or 4417744280351547"), (9003, "x " + item + " y"),
                     (9004, "junk### %%%& &&&* " * 30), (9004, "junk### %%%& &&&* " * 30)])
    docs = docs.unionByName(odd.select(*docs.columns))
    before = docs.count()
    for k, (name, stage) in enumerate(stages.STAGES):
        out = stage(spark, docs, sf)
        if k < 4:
            assert out.columns == docs.columns
        path = f"{tmp_path}/{k}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    ids = {r["doc_id"] for r in docs.collect()}
    texts = [r["text"] for r in docs.collect() if r["text"]]
    assert 9004 not in ids and 9003 not in ids and not any("4417744280351547" in t or "555-7713" in t for t in texts)
    assert docs.select("doc_id").distinct().count() < before
    for _, stage in stages.STAGES:
        assert stage(spark, make_docs([]), sf).count() == 0


def test_quotes_open_only_behind_an_equals_sign():
    from mentionscope.llm.html_text import blocks
    text = lambda page: " ".join(t for t, _ in blocks(page))
    assert text("<p title=don't>One fine day.</p><p>It's two.</p>") == "One fine day. It's two."
    assert text('<p class="x"">Hello there.</p><p>More "quoted" text.</p>') == 'Hello there. More "quoted" text.'
    assert text("<a href='x>y' title=\"1 > 0\">Link</a> <b data=a\"b>bold</b>") == "Link bold"
    assert text('<p class = "a" id=b/>x</p><br/>y<img alt="no > end">z') == "x yz" or text('<p class = "a" id=b/>x</p><br/>y<img alt="no > end">z') == "x y z"
    assert text("<p =x y==z ='q'>odd</p>") == "odd"
    assert text('<p class="never closed>text one</p><p>text two</p>').endswith("text two")
    assert text("<p>kept</p><p class='x") == "kept" and text("<p>kept <!-- gone <b>x</b>") == "kept"
    assert text("a < b and c > d") == "a < b and c > d"


def test_unclosed_tags_take_linear_time():
    import time
    from mentionscope.llm.html_text import blocks

    def seconds(page):
        t = time.perf_counter()
        blocks(page)
        return time.perf_counter() - t
    for page in ("<p " * 200_000, "<p a='" * 100_000, '<p x="1" ' * 100_000 + ">", "<" * 300_000, "<a b=" * 100_000):
        assert seconds(page) < 5

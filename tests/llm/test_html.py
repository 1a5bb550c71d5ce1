import random

import pytest

from leafline.llm.html_extract import align, blocks, extract_main_text, induce_templates, parse, with_host

from .conftest import prose

PAGES = "page_id long, url string, html string, host string, ref string, texts string, _id string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "x", "x", "x") for i, u, h in rows], PAGES)


def text_of(page):
    return " ".join(t for _, t in blocks(parse(page)))


@pytest.mark.parametrize("page, want", [
    ("", ""),
    ("just text &amp; more", "just text & more"),
    ("<article><h1>T</h1><p>a <b>b</b>c<br>d<p>e</article>", "T a bc d e"),
    ("<body><nav>menu</nav><article><p>x&#233;&nbsp;y</p><aside>no</aside></article><footer>f</footer>", "xé y"),
    ("<article><p>one<p>two<div class='ad-box'>buy</div><form>f<input></form><p>three", "one two three"),
    ("<article><p>a</p><section id=comments><article><p>reader</p></article></section></article>", "a"),
    ("<article><p>a &lt;b&gt; &am", "a <b> &am"),
    ("<article><p>cut off</p><p class=", "cut off"),
    ("<article><p>1 < 2 and 3 > 2</p></article>", "1 < 2 and 3 > 2"),
    ("<article><script>var t='</p>';</script><style>p{}</style><p>ok</p><!-- <p>no</p> --></article>", "ok"),
    ("<div class='with-sidebar'><article><p>in</p></article></div><div class=sidebar>out</div>", "in"),
    ("<main><p>m</p><div role=navigation>n</div></main><p>after</p>", "m"),
    ("<body><header>h</header><p>plain</p><div class='cookie-notice'>c</div></body>", "plain"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a b c d"),
    ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", "deep"),
    ("<article><textarea>t</textarea><p title='a>b'>q</p></article>", "q"),
])
def test_blocks(page, want):
    assert text_of(page) == want


def naive_stm(a, b):
    if a.label != b.label:
        return 0
    p, q = ([k for k in x.kids if not isinstance(k, str)] for x in (a, b))
    t = [[0] * (len(q) + 1) for _ in range(len(p) + 1)]
    for i in range(1, len(p) + 1):
        for j in range(1, len(q) + 1):
            t[i][j] = max(t[i - 1][j], t[i][j - 1], t[i - 1][j - 1] + naive_stm(p[i - 1], q[j - 1]))
    return 1 + t[-1][-1]


def tree(rng, depth=0):
    tags = ["div", "section", "span", "b"]
    kids, last = [], None
    for _ in range(rng.randint(0, 3) if depth < 3 else 0):
        tag = rng.choice([t for t in tags if t != last])  # no runs: the plain algorithm
        last = tag
        kids.append(f"<{tag}>{tree(rng, depth + 1)}</{tag}>")
    return "".join(kids)


@pytest.mark.parametrize("seed", range(25))
def test_alignment_matches_as_many_nodes_as_simple_tree_matching(seed):
    rng = random.Random(seed)
    a, b = parse(tree(rng)), parse(tree(rng))
    pairs = align(a, b)
    assert all(x.label == y.label for x, y in pairs)
    assert len({id(x) for x, _ in pairs}) == len(pairs) == len({id(y) for _, y in pairs})
    assert len(pairs) == naive_stm(a, b)


def site(n, host="h.org"):
    return [
        (i, f"http://{host}/{i}", f"<body><div><p>Brand line</p></div><article><h1>{prose(i, 4)}</h1><p>Share this story</p>"
         f"<p>{prose(i + 900, 30)}</p></article><p>Bottom line {host}</p></body>")
        for i in range(n)
    ]


def test_constant_nodes_become_template(spark):
    rows = site(30) + [(100, "http://h.org/copy", site(30)[3][2])] + [(200 + i, f"http://small.org/{i}", site(3)[i][2]) for i in range(3)]
    got = {r["_id"]: r["text"] for r in extract_main_text(pages(spark, rows)).collect()}
    for i in range(30):
        assert got[i] == prose(i, 4) + " " + prose(i + 900, 30)
    assert got[100] == got[3]
    assert "Share this story" in got[201]  # too few pages to tell


def test_copies_are_no_template(spark):
    page = "<article><h1>Same</h1><p>text everywhere</p></article>"
    rows = [(i, f"http://c.org/{i}", page) for i in range(40)] + [(50 + i, f"http://c.org/x{i}", site(9)[i][2]) for i in range(9)]
    got = {r["_id"]: r["text"] for r in extract_main_text(pages(spark, rows)).collect()}
    assert all(got[i] == "Same text everywhere" for i in range(40))


def test_odd_rows(spark):
    rows = [(None, "http://a.org", "<p>x</p>"), (1, None, None), (2, "no url", ""), (3, "http://a.org", "<<<>>>"),
            (4, "http://a.org", "<p>r</p>"), (4, "http://a.org", "<p>r</p>"), (5, "http://long.org", "<article>" + "<p>w</p>" * 40_000)]
    got = sorted((str(r["_id"]), len(r["text"])) for r in extract_main_text(pages(spark, rows)).collect())
    assert got == sorted([("None", 1), ("1", 0), ("2", 0), ("3", len("<<<>>>")), ("4", 1), ("4", 1), ("5", 79_999)])
    empty = spark.createDataFrame([], PAGES)
    assert extract_main_text(empty).count() == 0
    assert induce_templates(with_host(empty, "page_id", "url", "html")).count() == 0


@pytest.mark.parametrize("page, want", [
    ("<div>" * 100 + "<article><p>far in</p></article>" + "</div>" * 100 + "<p>after</p>", "far in"),
    ("<body>" + "<div>" * 5000 + "<main><p>far in</p></main>", "far in"),
    ("<article>" + "<div>" * 100 + "<nav><p>menu</p></nav><form>f</form><div class=ad>buy</div>text" + "</div>" * 100 + "<p>end</p></article>", "text end"),
    ("<article>" + "<div>" * 100 + "a<nav>n</nav></section></article>out", "a"),
])
def test_any_depth(page, want):
    assert text_of(page) == want


def test_deep_pages_align():
    def page(kind, text):
        return "<div>" * 2000 + f"<p>x</p>{kind}<section><b>y</b></section><ul><li>{text}</ul>" + "</div>" * 2000

    a, b = parse("<i></i>" + page("<h2>t</h2>", "one")), parse(page("", "two"))
    pairs = align(a, b)
    assert len(pairs) == 1 + 2000 + 5 and all(x.label == y.label for x, y in pairs)


def test_long_lists_align_whole(monkeypatch):
    def page(front, n=150):
        return "<p>a</p><b>x</b>" * front + "".join(f"<{t}>t</{t}>" for t in ["h2", "p", "h3", "ul"] * (n // 4))

    a, b = parse(page(0)), parse(page(90))
    assert len(align(a, b)) == naive_leaves(a, b)
    monkeypatch.setattr("leafline.llm.html_extract.TABLE_CELLS", 64)  # split tables give as much
    assert len(align(a, b)) == naive_leaves(a, b)


def naive_leaves(a, b):
    """The plain table where the root's children are leaves without neighbours of one label."""
    p, q = ([k.label for k in x.kids] for x in (a, b))
    row = [0] * (len(q) + 1)
    for x in p:
        new = [0]
        for j, y in enumerate(q):
            new.append(max(row[j + 1], new[j], row[j] + (x == y)))
        row = new
    return 1 + row[-1]


@pytest.mark.parametrize("seed", range(8))
def test_split_tables_match_as_many_nodes(seed, monkeypatch):
    monkeypatch.setattr("leafline.llm.html_extract.TABLE_CELLS", 1)
    rng = random.Random(100 + seed)
    a, b = parse(tree(rng)), parse(tree(rng))
    assert len(align(a, b)) == naive_stm(a, b)


def listing(i, host="h.org"):
    items = "".join(f"<div class=item><p>{prose(i * 50 + j, 12)}</p></div>" for j in range(4))
    return (1000 + i, f"http://{host}/list/{i}", f"<body><section class=list><h2>All our stories</h2>{items}<p>More every day</p></section></body>")


def test_each_layout_has_a_reference(spark):
    rows = site(40) + [listing(i) for i in range(40)]
    got = {r["_id"]: r["text"] for r in extract_main_text(pages(spark, rows)).collect()}
    assert all(got[i] == prose(i, 4) + " " + prose(i + 900, 30) for i in range(40))
    assert all(got[1000 + i] == " ".join(prose(i * 50 + j, 12) for j in range(4)) for i in range(40))


@pytest.mark.parametrize("odd", [
    ["<html><body><h1>Error 500</h1></body></html>"], ["   "], ["", None, "<br>"],
    [f"<div class=e{chr(97 + k)}><p>failed</p></div>" for k in range(11)],
])
def test_odd_pages_are_no_reference(spark, odd):
    rows = site(40) + [(500 + k, f"http://h.org/odd{k}", page) for k, page in enumerate(odd)]
    got = {r["_id"]: r["text"] for r in extract_main_text(pages(spark, rows)).collect()}
    assert all(got[i] == prose(i, 4) + " " + prose(i + 900, 30) for i in range(40))


def test_rare_layouts_go_with_the_main_one(spark):
    rows = [(i, u, h.replace("<div>", f"<div class=v{chr(97 + i % 6)}>")) for i, u, h in site(24)]
    got = {r["_id"]: r["text"] for r in extract_main_text(pages(spark, rows)).collect()}
    assert all("Share this story" not in got[i] for i in range(24))

"""Wrappers: parsing, alignment, main text of made pages."""

import pytest

from foliant.llm.wrappers import align, content_path, expression, extract, main_texts, parse, template_texts, wrapper, wrappers


def page(n, body, title="News", extra=""):
    return (f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var t='</p>';</script></head><body>"
            f"<nav><ul><li><a href='/a'>A</a></li><li>B</li></ul></nav><!-- c --><div class='ad'>Buy {n}</div>{extra}{body}"
            f"<section id='comments'><p>Nice {n}!</p></section><footer>&copy; x</footer></body></html>")


def article(*parts):
    return "<article><h1>Head</h1>" + "".join(f"<p>{p}</p>" for p in parts) + "</article>"


@pytest.mark.parametrize(("html", "text"), [
    (None, ""), ("", ""), ("plain & simple", "plain & simple"), ("<p>a &amp; b&nbsp;&nbsp;c</p>", "a & b c"),
    ("<p>a<b>b</b> c<br>d<p>e", "ab c\nd\ne"), ("<div>a<div>b</div>c</div>", "a\nb\nc"), ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
    ("<p title='a > b'>x</p>", "x"), ("<script>x</p>", ""), ("<p>a<!-- b", "a"), ("<ul><li>a<li>b</ul>", "a\nb"), ("<p>x</p><p", "x"),
    (page(1, article("one", "two")), "Head\none\ntwo"), ("<body class='has-sidebar'><p>x</p></body>", "x"), ("<p> \n </p>", ""),
    ("<div class='page-sidebar'><article><p>in</p></article></div><aside>out</aside>", "in"), ("<td>a<td>b", "a\nb"),
])
def test_single_pages(html, text):
    assert extract(html, None) == text


def test_alignment_makes_slots_options_and_repeats():
    a = wrapper(parse("<div><h1>Same</h1><p>one</p></div>"))
    b = wrapper(parse("<div><h1>Same</h1><hr><p>two</p><p>three</p></div>"))
    both = align(a, b)
    told = expression(both)
    assert "(<hr></hr>)?" in told and "(<p>#</p>)+" in told and told.count('"') == 2
    assert align(a, align(b, a))[1] == 3


def test_rules_come_from_all_pages_of_a_host(spark):
    # No article element: the main text is the container whose slots vary.
    shop = [f"<body><div class='x'><p>Shop name</p></div><div class='y'><h2>Always here</h2><p>{'text %d ' % i * 9}</p></div></body>" for i in range(6)]
    rows = [(i, f"http://shop.org/{i}", h, "x") for i, h in enumerate(shop)]
    rows += [(10, "http://one.org/", page(1, article("a b c")), "x"), (11, None, None, "x"), (12, "nonsense", "", "x"), (10, "http://one.org/", page(1, article("a b c")), "x")]
    rows += [(20 + i, "https://U@CoPies.org:80/x", page(1, article("same text on all copies")), "x") for i in range(8)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(3)
    got = {r.page_id: r for r in main_texts(df).collect()}
    assert got[3].text == ("text 3 " * 9).strip() and got[3].n_chars == len(got[3].text)
    assert got[10].text == "Head\na b c" and got[11].text == got[12].text == "" and got[11].n_chars == 0
    assert got[25].text == "Head\nsame text on all copies"
    assert main_texts(df).count() == len(rows)
    hosts = {r.host for r in wrappers(df).collect()}
    assert hosts == {"shop.org", "one.org", "copies.org"}
    assert main_texts(df.limit(0)).count() == 0


def test_whole_pages_are_read():
    body = article(*[f"paragraph {i}" for i in range(5000)])
    assert extract(page(1, body), None).count("\n") == 5000
    assert content_path(wrapper(parse(page(1, body)))) == ["html", "body", "article"]


def by_rule(pages):
    """The texts of the pages of one host."""
    both = wrapper(parse(pages[0]))
    for p in pages[1:]:
        both = align(both, wrapper(parse(p)))
    rule = {"path": content_path(both), "fixed": template_texts(both, 4)}
    return [extract(p, rule) for p in pages]


def test_no_slot_is_left_behind():
    story = lambda i: " ".join(f"w{i}x{k}" for k in range(60))
    pages = [f"<body><p>Shop</p><h1>Title {i}</h1><p class='lead'>lead {i}</p><div class='story'><p>{story(i)}</p></div></body>" for i in range(6)]
    assert by_rule(pages) == [f"Title {i}\nlead {i}\n{story(i)}" for i in range(6)]
    table = lambda i: f"<table><tr><td>side {i}</td><td><div><h2>Head {i}</h2><div>{story(i)}</div></div></td></tr></table>"
    assert by_rule([table(i) for i in range(6)]) == [f"side {i}\nHead {i}\n{story(i)}" for i in range(6)]
    mixed = [f"<body><div class='a'>{story(i)}</div></body>" for i in range(9)] + [f"<body><div class='a'>one {i}</div><div class='b'>two {i}</div></body>" for i in range(2)]
    assert by_rule(mixed) == [story(i) for i in range(9)] + [f"one {i}\ntwo {i}" for i in range(2)]


@pytest.mark.parametrize(("html", "text"), [
    ("<article class='post has-sidebar'><p>x</p></article>", "x"), ("<article class='category-social'>x</article><aside>y</aside>", "x"),
    ("<div class='content no-sidebar'><p>x</p></div><div class='sidebar'>y</div>", "x"), ("<article class='social'>x</article>", "x"),
    ("<div class='postWithComments'>x</div><div id='navMenu'>y</div><div class='ad-banner-2'>z</div>", "x"),
    ("<div class='widget'><p>a</p></div><footer>b</footer>", "a\nb"), ("<form><p>x</p></form>", "x"),
    # Quotes that follow no equals sign; headers and forms of the main text.
    ("<p data-x=it's>First words. I don't know.</p><p>Second</p>", "First words. I don't know.\nSecond"), ("<p title=\"5\" tall\">x</p>y", "x\ny"),
    ("<article><header><h1>Title</h1></header><p>Body</p></article><header>Site</header>", "Title\nBody"),
    ("<form id=aspnet><div><p>Body text here</p></div></form><p>tail</p>", "Body text here\ntail"),
    ("<form><nav>Menu</nav><article><p>In</p></article><button>Go</button></form>", "In"), ("<form><label>Find</label></form><p>A text that is longer</p>", "A text that is longer"),
    # Parts of names, beside an article and on pages without one.
    ("<div class='site-header'>s</div><article>x</article><div id='left-sidebar'>l</div><ul class='main-nav'><li>m</ul>", "x"),
    ("<article>x<div class='ad-slot'>Buy</div></article><ol class='comment-list'><li>First! I say more than the article does.</ol>", "x"),
    ("<div class='cookie-bar'>ok</div><div class='story'><p>Words of the story.</p></div><div class='user-comments'>no</div>", "Words of the story."),
    ("<div class='news-related'><p>All that the page has to say</p></div>", "All that the page has to say"),
])
def test_names_are_whole_classes(html, text):
    assert extract(html, None) == text
    assert extract(html, {"path": [], "fixed": []}) == text


def test_copies_in_many_tasks_and_equal_texts_of_articles(spark):
    copy = "<body><h1>Only once</h1><p>first</p><p>second</p><p>third</p><h2>End</h2></body>"
    rows = [(i, "http://copies.org/", copy) for i in range(8)]
    rows += [(10 + i, "http://news.org/", f"<body><p>Site</p><article><h2>Summary</h2><p>{'text %d ' % i * 9}</p></article></body>") for i in range(8)]
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 16), "page_id long, url string, html string")
    got = {r.page_id: r.text for r in main_texts(df).collect()}
    assert {got[i] for i in range(8)} == {"Only once\nfirst\nsecond\nthird\nEnd"}
    assert all(got[10 + i] == "Summary\n" + ("text %d " % i * 9).strip() for i in range(8))


def deep(levels, tag, inner):
    return f"<{tag}>" * levels + inner + f"</{tag}>" * levels


@pytest.mark.parametrize("tag", ["div", "b", "span", "ul", "table", "article"])
def test_any_depth(tag):
    assert extract(deep(100_000, tag, "<p>one</p>two<br>three"), None) == "one\ntwo\nthree"
    assert extract(deep(100_000, tag, "<p>a <i>b</i></p><nav>menu</nav><p>c"), None) == "a b\nc"
    assert extract("<p>x</p>" + f"<{tag}>" * 100_000 + "y" + "</div></span>" * 1000 + "z", None).replace("\n", "") == "xyz"


def test_deep_pages_among_others(spark):
    rows = [(i, "http://deep.org/", f"<body>{deep(5000 * (i % 2), 'div', f'<p>text {i} of the page</p>')}</body>") for i in range(8)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    assert {r.page_id: r.text for r in main_texts(df).collect()} == {i: f"text {i} of the page" for i in range(8)}
    assert wrappers(df).count() == 1

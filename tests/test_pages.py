import json

import pytest
from pyspark.sql import functions as F

from foliant.operators import pages as p


def extract(spark, htmls, **options):
    df = spark.createDataFrame([(n, h) for n, h in enumerate(htmls)], "n int, html string")
    return [row for row in p.extract_books(df, **options).orderBy("n").collect()]


def state_page(nodes, body="", broken=False):
    text = json.dumps({"props": {"pageProps": {"apolloState": nodes}}}, ensure_ascii=False)
    text = text[:-3] if broken else text
    return f'<html><head><title>T</title><script id="__NEXT_DATA__" type="application/json">{text}</script></head><body>{body}</body></html>'


def reviews(n, missing=()):
    edges = [{"node": {"__ref": f"Review:{i}"}} for i in range(n)]
    nodes = {
        f"Review:{i}": {
            "text": f"<b>T{i}</b> &amp; &eacute;\n", "rating": i % 6, "createdAt": (i + 1) * 86_400_000,
            "creator": {"__ref": "User:1" if i % 2 else "User:none"}, "likeCount": None if i == 3 else i,
        }
        for i in range(n) if i not in missing
    }
    return {"ROOT_QUERY": {"x": 1, 'getReviews({"a":1})': {"edges": edges}}, **nodes, "User:1": {"name": "Ann", "webUrl": "/u/1"}}


BOOK = {
    "Work:9": {"stats": {"averageRating": 4.25, "ratingsCount": 10, "textReviewsCount": 3}},
    "Book:1": {
        "title": "State &amp; title", "description": "<p>Long &quot;x&quot; &hellip;</p> ",
        "details": {"language": {"name": "English"}},
        "bookGenres": [{"genre": {"name": "A"}}, {"genre": {"name": ""}}, {"genre": {}}, {}, 3, {"genre": {"name": "B"}}],
    },
    "Book:2": {"title": "second"},
    "S1": {"__typename": "SocialSignal", "name": "TO_READ", "count": 5},
    "S2": {"__typename": "SocialSignal", "name": "CURRENTLY_READING", "count": 7},
    "S3": {"__typename": "SocialSignal", "name": "TO_READ", "count": 6},
    "S4": {"__typename": "Other", "name": "TO_READ", "count": 99},
}


def test_full_state(spark):
    row = extract(spark, [state_page({**BOOK, **reviews(12, missing=(1,))})])[0]
    assert (row.Title, row.Desc, row.Genre) == ("State &amp; title", 'Long "x" …', ["A", "B"])
    assert (row.Point, row.Language, row.RatingsCount, row.ReviewsCount) == (4.25, "English", 10, 3)
    assert (row.CurrentlyReadingCount, row.WantToReadCount) == (7, 6)
    # Cut to ten edges first, then the unresolved one is dropped.
    assert [r.Rating for r in row.Review] == [i % 6 for i in range(10) if i != 1]
    first, third = row.Review[0], row.Review[2]
    assert first.asDict() == {
        "Author": "Anonymous", "AuthorUrl": None, "Rating": 0, "Likes": 0, "Date": "1970-01-02", "Spoiler": False,
        "Text": "T0 & é",
    }
    assert (third.Author, third.AuthorUrl, third.Likes) == ("Ann", "/u/1", None)


def test_pre_stripped_description_comes_first(spark):
    node = {"Book:1": {"title": "t", "description": "<i>raw</i>", 'description({"stripped":true})': "clean &amp;"}}
    assert extract(spark, [state_page(node)])[0].Desc == "clean &amp;"


MARKUP = """
<!-- <h1 data-testid="bookTitle">comment</h1> --><script>var a = '<h1 data-testid="bookTitle">script</h1>'</script>
<meta property="og:title" content="Social"><h1>Other</h1><h1 class="t" data-testid="bookTitle"> Tagged <b>&amp;</b> title </h1>
<div data-testid="description"><div>Intro<div>deep</div><span class="x Formatted">Text <div>in</div> <span>nested</span> &copy;</span></div>after</div><div>no</div>
<a href="/genres/a">A</a><a class="b" href='x/genres/b?c'> B <i>!</i></a><a href="/genres/a2">A</a><a href="/genres/">...more</a><a href="/genre/z">Z</a><a href="/genres/m">More</a>
<div class="RatingStatistics__ratingX">1.0</div><div class="RatingStatistics__rating">n/a</div><span itemprop="ratingValue"> 3.75 </span>
<span data-testid="ratingsCount">1,234<!-- x --> ratings</span><div data-testid="toReadSignal"><p>5 of <b>67</b></p></div>
"""


@pytest.mark.parametrize("html", [MARKUP, state_page(BOOK, MARKUP, broken=True)], ids=["plain", "broken state"])
def test_markup_fallbacks(spark, html):
    row = extract(spark, [html])[0]
    assert (row.Title, row.Desc) == ("Tagged & title", "Text in nested ©")
    assert row.Genre == ["A", "B !"]
    assert (row.Point, row.RatingsCount, row.ReviewsCount) == (3.75, 1234, 0)
    assert (row.CurrentlyReadingCount, row.WantToReadCount, row.Language, row.Review) == (0, 567, None, [])


TITLES = [
    ('<meta property="og:title" content="Social &lt;1&gt;"><h1>H</h1>', "Social <1>"),
    ("<meta property='og:title' content='It&#39;s'><h1>H</h1>", "It's"),
    ('<meta property="og:title"><h1>H</h1>', None),
    ("<title>P</title><H1>H</H1>", "H"),
    ("<title> P </title>", "P"),
    ('<h1 data-testid="bookTitle"> </h1><h1>H</h1>', None),
    ("nothing", None),
    ("", None),
]


def test_title_order(spark):
    assert [r.Title for r in extract(spark, [t[0] for t in TITLES])] == [t[1] for t in TITLES]


DESCRIPTIONS = [
    ('<div data-testid="description">a <div>b</div> c</div> d', "a b c"),
    ('<div data-testid="description"> </div><meta name="description" content=" m ">', "m"),
    ('<meta property="og:description" content="og">', "og"),
    ('<meta name="description"><meta property="og:description" content="og">', None),
    ('<div data-testid="description">open <div>never closed', "open never closed"),
    ('<div data-testid="description"><div class="Formatted">x<div>y</div></div>z</div>', "xy"),
]


def test_description_order(spark):
    assert [r.Desc for r in extract(spark, [d[0] for d in DESCRIPTIONS])] == [d[1] for d in DESCRIPTIONS]


def test_state_fills_what_it_has_and_markup_the_rest(spark):
    nodes = {"Book:1": {"title": "", "bookGenres": []}, "Work:1": {"stats": {"averageRating": 0, "ratingsCount": None}}}
    row = extract(spark, [state_page(nodes, MARKUP)])[0]
    assert (row.Title, row.Genre, row.Point, row.RatingsCount) == ("Tagged & title", ["A", "B !"], 3.75, 1234)


def test_parameters(spark):
    html = '<a href="/shelf/1">S</a>' + state_page(reviews(5))
    row = extract(spark, [html], genre_href="/shelf/", n_reviews=2)[0]
    assert row.Genre == ["S"] and len(row.Review) == 2


def test_null_and_empty_state(spark):
    pages = [None, state_page({}), '<script id="__NEXT_DATA__">{"props":{}}</script>', '<script id="__NEXT_DATA__"></script>']
    for row in extract(spark, pages):
        assert row.Review == [] and row.Genre == [] and row.Point == 0.0


def test_filters_stay_above_extraction(spark):
    df = spark.createDataFrame([(1, MARKUP)], "n int, html string")
    plan = p.extract_books(df).where(F.col("Point") > 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate inline")
    assert plan.count("from_json(StructField(props") == 1


def test_fields_only_build_what_they_need(spark):
    pages = spark.createDataFrame([("1", "<h1 title='a > b'>Title</h1><div data-testid=toReadSignal>7 want</div>")], "isbn string, html string")
    title = p.extract_books(pages, fields=["Title"])
    assert title.columns == ["isbn", "Title"] and title.head().Title == "Title"
    plan = title._jdf.queryExecution().toString()
    assert "getReviews" not in plan and "toReadSignal" not in plan
    counts = p.extract_books(pages, fields=["WantToReadCount"])
    assert counts.head().WantToReadCount == 7 and "Python" not in counts._jdf.queryExecution().toString()


def test_quotes_that_open_no_value(spark):
    cases = {
        "<h1 data-testid=bookTitle data-x=it's>Right</h1><p>don't</p>": "Right",
        '<h1 data-testid="bookTitle" title="5" tall">Right</h1>': "Right",
        "<h1 \" data-testid='bookTitle'>Right</h1><p>\"</p>": "Right",
        "<h1 title='a > b' data-testid=bookTitle>Right</h1>": "Right",
        "<h1 data-testid='bookTitle' x='unended>Right</h1>": "Right",
        "<h1>Right</h1><script>'</script><h1 data-testid=bookTitle": "Right",
        "<title>Right</title><!-- <h1>no</h1>": "Right",
    }
    df = spark.createDataFrame(list(cases.items()), "html string, want string")
    for row in p.extract_books(df.withColumn("page", F.col("html")), fields=["Title"]).collect():
        assert row.Title == row.want, row.page


def test_unended_tags_take_linear_time(spark):
    import time

    pages = ["<h1>T</h1>" + part * 50_001 for part in ('<a x="/genres/ ', "<a href='/genres/", "<a ", "<div data-testid=description ", "<script>", "<!--", '<meta content="', "</a")]
    df = spark.createDataFrame([(p,) for p in pages], "html string")
    start = time.time()
    assert {r.Title for r in p.extract_books(df, fields=["Title", "Genre", "Desc"]).collect()} == {"T"}
    # A quadratic search takes hours.
    assert time.time() - start < 60

"""Extraction of book records from crawled pages.

The embedded page state comes first, the markup is the fallback, field by field.
All of it is a chain of projections: one page is one row, references between the
nodes of a page are resolved inside that row, and nothing is shuffled. The only
Python step is one Arrow batch that decodes rare entities.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from foliant.functions.jsons import first_key, json_parse, json_path, json_path_or
from foliant.functions.text import (
    blank_to_null, drop_tags, epoch_ms_to_date, html_unescape_all, parse_count, strip, try_float,
)
from foliant.operators.pinning import pinned
from foliant.schemas import REVIEW

# Where a page keeps its state, and the names used inside it.
STATE_ID = "__NEXT_DATA__"
STATE_SCHEMA = "props struct<pageProps:struct<apolloState:map<string,string>>>"
STRIPPED_DESCRIPTION = """$['description({"stripped":true})']"""
SIGNAL_TYPE = "SocialSignal"
CURRENTLY_READING = "CURRENTLY_READING"
WANT_TO_READ = "TO_READ"
MAX_REVIEWS = 10
GENRE_HREF = "/genres/"
NOT_A_GENRE = ["", "...more", "More"]

EMPTY_TEXTS = "array<string>"
RECORD = [
    "Title", "Desc", "Genre", "Review", "Point", "Language", "RatingsCount", "ReviewsCount",
    "CurrentlyReadingCount", "WantToReadCount",
]


# --- markup --------------------------------------------------------------------


# The rest of a start tag. A quote that follows an equals sign opens a value, which may hold a closing
# bracket; any other quote is a character like others. Possessive, so that no page makes the pattern go back.
QUOTED = r"""=\s*+(?:"[^"]*+"|'[^']*+')?+"""
REST = rf"(?:[^>=]++|{QUOTED})*+"


def without_scripts(html: Column) -> Column:
    """Drop comments, whole scripts and styles, so that no tag is found there, and a tag that never ends.

    Every tag is taken whole, so that a page is gone through once whatever it holds; without
    unended tags no later pattern reads to the end of the page for each of them.
    """
    hidden = r"<!--.*?(?:-->|\z)|<(script|style|template)\b.*?(?:</\1\s*>|\z)"
    return F.regexp_replace(html, rf"(?is){hidden}|(<[a-z/!?]{REST}>)|<[a-z/!?]{REST}\z", "$2")


def attribute(name: str, value: str) -> str:
    """An attribute with this whole name whose value matches; quoted or not."""
    return rf"""{name}\s*=\s*(?:"(?-i:{value})"|'(?-i:{value})'|(?-i:{value})(?=[\s/>]))"""


def class_token(token: str) -> str:
    one = rf"(?:{{0}}*\s)?{token}(?:\s{{0}}*)?"
    double, single = one.format('[^"]'), one.format("[^']")
    return rf"""class\s*=\s*(?:"(?-i:{double})"|'(?-i:{single})'|(?-i:{token})(?=[\s/>]))"""


def start_tag(tag: str, having: str = "") -> str:
    """Pattern of a whole start tag, of one with an attribute that matches ``having``."""
    if not having:
        return rf"<{tag}(?=[\s/>]){REST}>"
    before = rf"(?:[^>=\s]++|{QUOTED}|\s(?!{having}))*+"
    return rf"<{tag}(?=[\s/>]){before}\s{having}{REST}>"


STATE_SCRIPT = rf"(?is){start_tag('script', attribute('id', STATE_ID))}(.*?)</script\s*>"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def from_element(html: Column, tag: str, having: str = "", word: str = "") -> Column:
    """Markup from the first ``tag`` whose start tag matches ``having``, to the end; else NULL.

    ``word`` is a text every match holds: a plain search for it spares most pages
    the pattern.
    """
    found = F.regexp_substr(html, F.lit(rf"(?is){start_tag(tag, having)}.*"))
    return F.when(F.contains(html, F.lit(word)), found) if word else found


def close_element(markup: Column) -> Column:
    """The element that ``markup`` starts with, nested ones of its kind included.

    The markup is cut at end tags and pieces are taken until start and end tags are
    balanced; an element never closed runs to the end.
    """

    def close(tag: Column) -> Column:
        starts = F.concat(F.lit("(?i)<"), tag, F.lit(r"\b"))

        def take(acc: Column, piece: Column) -> Column:
            depth = acc["open"] + F.regexp_count(piece, starts) - 1
            more = F.struct(depth.alias("open"), (acc["n"] + 1).alias("n"))
            return F.when((acc["n"] > 0) & (acc["open"] == 0), acc).otherwise(more)

        def cut(pieces: Column) -> Column:
            none = F.struct(F.lit(0).alias("open"), F.lit(0).alias("n"))
            n = F.aggregate(pieces, none, take, lambda acc: acc["n"])
            end = F.concat(F.lit("</"), tag, F.lit(">"))
            return F.call_function("array_join", F.slice(pieces, F.lit(1), n), end)

        return bind(F.split(markup, F.concat(F.lit("(?i)</"), tag, F.lit(r"\s*>"))), cut)

    return bind(F.regexp_extract(markup, r"^<(\w+)", 1), close)


def element(html: Column, tag: str, having: str = "", word: str = "") -> Column:
    """First ``tag`` element whose start tag matches ``having``, as markup; else NULL."""
    return close_element(from_element(html, tag, having, word))


def flat_element(html: Column, tag: str, having: str = "") -> Column:
    """``element`` for kinds that cannot be nested: it ends at the next end tag."""
    return F.regexp_substr(html, F.lit(rf"(?is){start_tag(tag, having)}.*?(?:</{tag}\s*>|\z)"))


def meta_content(html: Column, having: str) -> Column:
    """``content`` of the first matching ``<meta>``: '' if it has none, NULL without such a tag."""
    tag = F.regexp_substr(html, F.lit(rf"(?is){start_tag('meta', having)}"))
    # Up to the attribute that is called content, not one whose name ends so.
    before = rf"(?is)^<meta(?:[^>=\s]++|{QUOTED}|\s(?!content\s*=))*+\scontent\s*=\s*"
    double = F.regexp_extract(tag, before + '"([^"]*)"', 1)
    single = F.regexp_extract(tag, before + "'([^']*)'", 1)
    bare = F.regexp_extract(tag, before + r"""([^\s"'>]+)""", 1)
    return F.coalesce(blank_to_null(double), blank_to_null(single), bare)


def markup_text(fragment: Column) -> Column:
    """Text of a fragment, entities still encoded."""
    return F.regexp_replace(fragment, rf"(?s)</?[a-zA-Z!?]{REST}>", "")


def title_markup(html: Column) -> Column:
    """Title by markup: tagged heading, social title, any heading, page title."""
    return F.coalesce(
        markup_text(flat_element(html, "h1", attribute("data-testid", "bookTitle"))),
        meta_content(html, attribute("property", "og:title")),
        markup_text(flat_element(html, "h1")),
        markup_text(flat_element(html, "title")),
    )


def description_markup(html: Column) -> Column:
    """Text of the description block, of its formatted part where there is one."""
    block = element(html, "div", attribute("data-testid", "description"), "description")
    part = lambda block: element(block, r"\w+", class_token("Formatted"), "Formatted")
    return bind(block, lambda block: markup_text(F.coalesce(part(block), block)))


def description_meta(html: Column) -> Column:
    return F.coalesce(
        meta_content(html, attribute("name", "description")),
        meta_content(html, attribute("property", "og:description")),
    )


def link_markup(html: Column, href_contains: str = GENRE_HREF) -> Column:
    """Texts of all links whose target contains ``href_contains``, entities still encoded."""
    target = rf"""href\s*=\s*(?:"(?-i:[^"]*\Q{href_contains}\E[^"]*)"|'(?-i:[^']*\Q{href_contains}\E[^']*)'|(?-i:[^\s"'>]*\Q{href_contains}\E[^\s"'>]*))"""
    # Up to the next link's start or end. All other tags are taken whole: nothing begins within one.
    text = r"([^<]*+(?:<(?!/?a[\s/>])[^<]*+)*+)"
    link = rf"(?is){start_tag('a', target)}{text}|<[a-z/!?]{REST}>"
    texts = F.filter(F.regexp_extract_all(html, F.lit(link), F.lit(1)), lambda t: t != "")
    found = F.transform(texts, markup_text)
    return F.when(F.contains(html, F.lit(href_contains)), found).otherwise(F.array().cast("array<string>"))


def distinct_texts(texts: Column) -> Column:
    """Stripped, without the "more" links, distinct in order."""
    clean = F.transform(texts, strip)
    return F.array_distinct(F.filter(clean, lambda t: ~t.isin(NOT_A_GENRE)))


def link_texts(html: Column, href_contains: str = GENRE_HREF) -> Column:
    return distinct_texts(html_unescape_all(link_markup(html, href_contains)))


def rating_markup(html: Column) -> Column:
    """Rating by markup; a text that is no number lets the next element count."""
    block = "RatingStatistics__rating"
    return F.coalesce(
        try_float(markup_text(element(html, "div", class_token(block), block))),
        try_float(markup_text(element(html, "span", attribute("itemprop", "ratingValue"), "ratingValue"))),
    )


def count_markup(html: Column, tag: str, testid: str) -> Column:
    """Digits of the first ``tag`` element with this test id; 0 if there is none."""
    return parse_count(markup_text(element(html, tag, attribute("data-testid", testid), testid)))


# --- embedded state --------------------------------------------------------------


def embedded_state(html: Column | str) -> Column:
    """State graph of a page as ``MAP<node key, node JSON>`` in document order; NULL if broken."""
    script = blank_to_null(F.regexp_extract(html, STATE_SCRIPT, 1))
    return F.from_json(script, STATE_SCHEMA)["props"]["pageProps"]["apolloState"]


def node(state: Column | str, key: Column) -> Column:
    """A node of the state as VARIANT."""
    return json_parse(F.try_element_at(state, key))


def social_signal(state: Column | str, name: str) -> Column:
    """Count of the last signal node of this name; 0 if there is none."""
    signals = F.filter(
        F.map_values(state),
        lambda text: F.contains(text, F.lit(SIGNAL_TYPE))
        & (F.get_json_object(text, "$.__typename") == SIGNAL_TYPE)
        & (F.get_json_object(text, "$.name") == name),
    )
    count = F.get_json_object(F.try_element_at(signals, F.lit(-1)), "$.count").try_cast("bigint")
    return F.coalesce(count, F.lit(0).cast("bigint"))


def resolve_reviews(pages: DataFrame, n: int = MAX_REVIEWS) -> DataFrame:
    """Add ``_reviews``: review edges -> review nodes -> their creators.

    The edges are cut to the first ``n`` before unresolved ones are dropped. A
    creator that cannot be resolved leaves the author anonymous. Texts are raw.
    """
    root = F.from_json(F.try_element_at("_state", F.lit("ROOT_QUERY")), "map<string,string>")
    pages = pages.withColumn("_root", root)
    edges = json_path(
        json_parse(F.try_element_at("_root", first_key("_root", "getReviews"))),
        "$.edges",
        "array<struct<node:struct<__ref:string>>>",
    )
    found = F.filter(
        F.transform(
            F.slice(edges, 1, n), lambda e: json_parse(F.try_element_at("_state", e["node"]["__ref"]))
        ),
        lambda review: review.isNotNull(),
    )
    pages = pages.withColumn("_nodes", found)
    paired = F.transform(
        "_nodes",
        lambda review: F.struct(
            review.alias("review"),
            node("_state", json_path(review, "$.creator.__ref", "string")).alias("author"),
        ),
    )
    pages = pages.withColumn("_nodes", paired)
    reviews = F.transform(
        "_nodes",
        lambda pair: F.struct(
            F.when(pair["author"].isNull(), F.lit("Anonymous"))
            .otherwise(json_path_or(pair["author"], "$.name", "string", "Anonymous"))
            .alias("Author"),
            json_path(pair["author"], "$.webUrl", "string").alias("AuthorUrl"),
            json_path(pair["review"], "$.rating", "int").alias("Rating"),
            json_path_or(pair["review"], "$.likeCount", "bigint", 0).alias("Likes"),
            epoch_ms_to_date(json_path(pair["review"], "$.createdAt", "bigint")).alias("Date"),
            json_path_or(pair["review"], "$.spoilerStatus", "boolean", False).alias("Spoiler"),
            F.coalesce(json_path(pair["review"], "$.text", "string"), F.lit("")).alias("Text"),
        ),
    )
    reviews = F.coalesce(reviews, F.array().cast(f"array<{REVIEW}>"))
    return pages.withColumn("_reviews", reviews).drop("_root", "_nodes")


def state_fields(
    pages: DataFrame, html: str = "html", n_reviews: int = MAX_REVIEWS, with_reviews: bool = True
) -> DataFrame:
    """Add the fields the embedded state gives, as columns with a leading '_'."""
    pages = pages.withColumn("_state", embedded_state(html))
    pages = pages.withColumns(
        {
            "_book": node("_state", first_key("_state", "Book:")),
            "_work": node("_state", first_key("_state", "Work:")),
        }
    )
    genres = F.transform(
        json_path("_book", "$.bookGenres", "array<struct<genre:struct<name:string>>>"),
        lambda g: g["genre"]["name"],
    )
    zero = F.lit(0).cast("bigint")
    pages = pages.withColumns(
        {
            "_title": json_path("_book", "$.title", "string"),
            "_desc": blank_to_null(json_path("_book", STRIPPED_DESCRIPTION, "string")),
            "_raw_desc": blank_to_null(json_path("_book", "$.description", "string")),
            "_language": json_path("_book", "$.details.language.name", "string"),
            "_genres": F.filter(genres, lambda g: blank_to_null(g).isNotNull()),
            "_point": json_path("_work", "$.stats.averageRating", "double"),
            "_ratings": json_path("_work", "$.stats.ratingsCount", "bigint"),
            "_text_reviews": json_path("_work", "$.stats.textReviewsCount", "bigint"),
            "_reading": F.coalesce(social_signal("_state", CURRENTLY_READING), zero),
            "_wanted": F.coalesce(social_signal("_state", WANT_TO_READ), zero),
        }
    )
    if with_reviews:
        pages = resolve_reviews(pages, n_reviews)
    return pages.drop("_state", "_book", "_work")


def extract_books(
    pages: DataFrame,
    html: str = "html",
    genre_href: str = GENRE_HREF,
    n_reviews: int = MAX_REVIEWS,
    fields: Sequence[str] = tuple(RECORD),
) -> DataFrame:
    """Add ``fields`` of a book record to each page; ``html`` itself is dropped.

    Only what the fields need is built: without ``Review`` no reviews are resolved, and
    without texts to decode no row goes through Python.
    """
    unknown = set(fields) - set(RECORD)
    if unknown:
        raise ValueError(f"no such fields: {sorted(unknown)}")
    wanted = set(fields)
    keep = [F.col(c) for c in pages.columns if c != html]
    known = state_fields(pages, html, n_reviews, "Review" in wanted)
    no_title = blank_to_null("_title").isNull()
    no_genres = F.coalesce(F.size("_genres") == 0, F.lit(True))
    no_desc = F.col("_desc").isNull() & F.col("_raw_desc").isNull()
    falsy = lambda c: F.coalesce(F.col(c) == 0, F.lit(True))
    gaps = {
        "Title": no_title, "Desc": no_desc, "Genre": no_genres, "Point": falsy("_point"), "RatingsCount": falsy("_ratings"),
        "ReviewsCount": falsy("_text_reviews"), "CurrentlyReadingCount": falsy("_reading"), "WantToReadCount": falsy("_wanted"),
    }
    incomplete = reduce(or_, [gap for name, gap in gaps.items() if name in wanted], F.lit(False))
    # Pages whose state is complete never have their markup looked at.
    known = known.withColumn("_dom", F.when(incomplete, without_scripts(F.col(html))))
    dom, none = F.col("_dom"), F.array().cast(EMPTY_TEXTS)
    links = F.coalesce(F.when(no_genres, link_markup(dom, genre_href)), none) if "Genre" in wanted else none
    # Texts whose entities are decoded together: title, three descriptions, links, reviews.
    parts = [F.lit(None).cast("string")] * 4
    if "Title" in wanted:
        parts[0] = F.when(no_title, title_markup(dom))
    if "Desc" in wanted:
        parts[1] = F.when(F.col("_desc").isNull(), drop_tags("_raw_desc"))
        parts[2] = F.when(no_desc, description_markup(dom))
        parts[3] = F.when(no_desc, description_meta(dom))
    texts = [F.array(*parts), links]
    if "Review" in wanted:
        texts.append(F.transform("_reviews", lambda r: drop_tags(r["Text"])))
    counts = {
        "RatingsCount": ("_ratings", "span", "ratingsCount"), "ReviewsCount": ("_text_reviews", "span", "reviewsCount"),
        "CurrentlyReadingCount": ("_reading", "div", "currentlyReadingSignal"), "WantToReadCount": ("_wanted", "div", "toReadSignal"),
    }
    found = {c: F.when(falsy(c), count_markup(dom, tag, testid)).otherwise(F.col(c)) for name, (c, tag, testid) in counts.items() if name in wanted}
    if "Point" in wanted:
        found["_dom_point"] = F.when(falsy("_point"), rating_markup(dom))
    decoded = wanted & {"Title", "Desc", "Genre", "Review"}
    if decoded:
        found |= {"_raw": F.concat(*texts), "_n_links": F.size(links)}
    known = known.withColumns(found).drop("_dom", html) if found else known.drop("_dom", html)
    if decoded:
        known = known.withColumn("_plain", F.transform(html_unescape_all("_raw"), strip))
    plain = lambda i: blank_to_null(F.get("_plain", F.lit(i)))

    def genres() -> Column:
        by_link = F.coalesce(distinct_texts(F.slice("_plain", F.lit(5), F.col("_n_links"))), none)
        return F.when(no_genres, by_link).otherwise(F.col("_genres"))

    def reviews() -> Column:
        own = F.slice("_plain", F.col("_n_links") + 5, F.size("_reviews"))
        return F.zip_with("_reviews", own, lambda r, t: r.withField("Text", t))

    values: dict[str, Callable[[], Column]] = {
        "Title": lambda: F.coalesce(blank_to_null("_title"), plain(0)),
        "Desc": lambda: F.coalesce("_desc", plain(1), plain(2), plain(3)),
        "Genre": genres,
        "Review": reviews,
        "Point": lambda: F.coalesce(F.nullif("_point", F.lit(0.0)), F.col("_dom_point"), F.lit(0.0)),
        "Language": lambda: F.col("_language"),
    } | {name: (lambda c=c: F.col(c)) for name, (c, _, _) in counts.items()}
    return pinned(known.select(*keep, *[values[name]().alias(name) for name in RECORD if name in wanted]))

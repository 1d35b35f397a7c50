"""Text, number and date functions with the coercion rules of the catalog."""

from __future__ import annotations

from collections.abc import Iterable
from functools import cache

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# The characters a Unicode-aware strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

FLOAT_TEXT = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)$"
INT_TEXT = r"^[+-]?\d+(_\d+)*$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.btrim(col(c), F.lit(WHITESPACE))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def falsy_coalesce(*cols: Column | str, default: str | None = None) -> Column:
    """First value that is neither NULL nor empty, else ``default``."""
    tail = [] if default is None else [F.lit(default)]
    return F.coalesce(*[blank_to_null(c) for c in cols], *tail)


def title_key(c: Column | str) -> Column:
    """Key under which two titles count as the same book; NULL for no title."""
    return blank_to_null(F.lower(strip(c)))


def digits_only(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"\P{Nd}", "")


def parse_count(c: Column | str) -> Column:
    """``'1,234 ratings'`` -> 1234; no digits -> 0."""
    return F.coalesce(digits_only(c).try_cast("bigint"), F.lit(0).cast("bigint"))


def try_float(c: Column | str) -> Column:
    """Text -> double, NULL if it is no number (NaN stays NaN).

    The cast decides, except where it takes more (``1d``, ``0x1p3``) or less
    (``1_000``) than a decimal number: such texts are checked by pattern.
    """
    text = strip(c)
    odd = contains_any(text, ["_", "x", "X"]) | F.right(text, F.lit(1)).isin("d", "D", "f", "F")
    joined = F.regexp_replace(text, r"(?<=\d)_(?=\d)", "")
    return F.when(odd, F.when(joined.rlike(FLOAT_TEXT), joined.try_cast("double"))).otherwise(
        text.try_cast("double")
    )


def try_int(c: Column | str) -> Column:
    """Text -> bigint, NULL if it is no whole number."""
    text = strip(c)
    joined = F.when(text.rlike(INT_TEXT), F.replace(text, F.lit("_"), F.lit("")))
    return F.when(F.contains(text, F.lit("_")), joined.try_cast("bigint")).otherwise(text.try_cast("bigint"))


def nan_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(float("nan")))


def contains_any(text: Column, terms: Iterable[str]) -> Column:
    """True if any term is a substring; ``text`` should be a plain column."""
    found = F.lit(False)
    for term in terms:
        found = found | F.contains(text, F.lit(term))
    return found


def startswith_any(text: Column, prefixes: Iterable[str]) -> Column:
    found = F.lit(False)
    for prefix in prefixes:
        found = found | F.startswith(text, F.lit(prefix))
    return found


def epoch_ms_to_date(ms: Column | str) -> Column:
    """Epoch milliseconds -> ``yyyy-MM-dd`` in UTC, whatever the session's zone; 0 and NULL -> NULL.

    Years beyond 9999 have more digits and, unlike Spark's own text of them, no plus sign.
    """
    value = F.nullif(col(ms), F.lit(0))
    day = ((value - F.pmod(value, F.lit(86_400_000))) / 86_400_000).cast("int")
    return F.ltrim(F.date_add(F.lit("1970-01-01").cast("date"), day).cast("string"), F.lit("+"))


def excerpt(c: Column | str, size: int) -> Column:
    text = strip(F.replace(col(c), F.lit("\n"), F.lit(" ")))
    cut = F.concat(F.substring(text, 1, size), F.lit("..."))
    return F.when(F.length(text) > size, cut).otherwise(text)


def thousands(c: Column | str) -> Column:
    return F.format_number(col(c), 0)


def pub_date_label(year: Column, month: Column, day: Column) -> Column:
    """``y-m-d`` with the parts that are not known left out."""
    label = F.concat_ws("-", *[falsy_coalesce(p, default="N/A") for p in (year, month, day)])
    label = F.replace(label, F.lit("-N/A-N/A"), F.lit(""))
    return F.replace(label, F.lit("-N/A"), F.lit(""))


# --- markup ------------------------------------------------------------------

# The entities handled without leaving the JVM. The ampersand comes
# last so that '&amp;lt;' is decoded once.
COMMON_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


def drop_tags(c: Column | str) -> Column:
    """Remove ``<...>`` runs that stay on one line ('.' stops only at a line feed)."""
    return F.regexp_replace(col(c), "(?d)<.*?>", "")


def unescape_common(c: Column | str) -> Column:
    """Decode the common entities only; exact if the text holds no other '&'."""
    text = col(c)
    for entity, char in COMMON_ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


# The two UDFs are built inside functions so that they travel to the executors by
# value: no package has to be installed there.
@cache
def _unescape_udf():
    import html

    def unescape(texts: pd.Series) -> pd.Series:
        return texts.map(html.unescape, na_action="ignore")

    return F.pandas_udf(unescape, T.StringType())


@cache
def _unescape_all_udf():
    import html

    def unescape_all(lists: pd.Series) -> pd.Series:
        def one(items):
            if items is None:
                return None
            return [t if t is None else html.unescape(t) for t in items]

        return lists.map(one)

    return F.pandas_udf(unescape_all, T.ArrayType(T.StringType()))


_OTHER_ENTITY = r"&(?!(?:lt|gt|quot|#39|amp);)"


def html_unescape(c: Column | str) -> Column:
    """Decode all named and numeric entities.

    Spark has no entity table, so rows holding anything but the common entities
    go through an Arrow batch; all others cross as NULL and are decoded in the JVM.
    """
    text = col(c)
    rare = F.when(text.rlike(_OTHER_ENTITY), text)
    return F.coalesce(_unescape_udf()(rare), unescape_common(text))


def html_unescape_all(c: Column | str) -> Column:
    """``html_unescape`` for every element of an array, in one Arrow round trip."""
    texts = col(c)
    rare = F.when(F.exists(texts, lambda t: F.coalesce(t.rlike(_OTHER_ENTITY), F.lit(False))), texts)
    return F.coalesce(_unescape_all_udf()(rare), F.transform(texts, unescape_common))


def clean_html(c: Column | str) -> Column:
    """Tags out, entities decoded, stripped; NULL -> ''."""
    return F.coalesce(strip(html_unescape(drop_tags(c))), F.lit(""))

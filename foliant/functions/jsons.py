"""JSON helpers on VARIANT and MAP columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from foliant.functions.text import col


def json_parse(c: Column | str, lenient: bool = False) -> Column:
    """Text -> VARIANT, NULL if malformed; ``lenient`` allows raw control characters."""
    if lenient:
        return F.from_json(col(c), "variant", {"allowUnquotedControlChars": "true"})
    return F.try_parse_json(col(c))


def one_json(c: Column | str, lenient: bool = False) -> Column:
    """Whether nothing follows the JSON value a text starts with.

    Parsers stop at the end of the first value. Only texts in which a closing brace is
    followed by something else than the structure allows are looked at twice.
    """
    text = col(c)
    suspect = text.rlike(r"\}\s*[^\s,\]\}]|\}\s*,[^\[\{]*\{")
    plain = F.regexp_replace(text, r"[\x00-\x1f]", " ") if lenient else text
    alone = F.json_array_length(F.concat(F.lit("["), plain, F.lit("]"))) == 1
    return F.when(suspect, F.coalesce(alone, F.lit(False))).otherwise(True)


def json_path(v: Column | str, path: str, type_: str) -> Column:
    """Typed value below ``path`` of a VARIANT; NULL if absent or of another type."""
    return F.try_variant_get(col(v), path, type_)


def json_path_or(v: Column | str, path: str, type_: str, default: object) -> Column:
    """``default`` only where the key is missing; an explicit null stays NULL."""
    explicit_null = F.is_variant_null(F.try_variant_get(col(v), path, "variant"))
    return F.when(~explicit_null, F.coalesce(json_path(v, path, type_), F.lit(default)))


def has_key(v: Column | str, key: str) -> Column:
    return F.try_variant_get(col(v), f"$.{key}", "variant").isNotNull()


def first_key(m: Column | str, prefix: str) -> Column:
    """First key, in document order, that starts with ``prefix``."""
    keys = F.filter(F.map_keys(col(m)), lambda k: F.startswith(k, F.lit(prefix)))
    return F.get(keys, F.lit(0))


def to_json_text(c: Column | str) -> Column:
    """Nested value -> JSON text; NULL fields are written out."""
    return F.to_json(col(c), {"ignoreNullFields": "false"})

"""Sources. Readers are lazy scans; ``auto`` and checkpoints look at the kind of each file first, arrays read by splits at their starts.

Readers of record files return ``(plain, scraped, pos)``, see ``_raw``.
``pos`` is ``STRUCT<file, block, row>`` and orders records as in the source: files
by name, splits by offset, and within one split the row counter only grows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from foliant.functions.jsons import has_key, json_parse, json_path, one_json
from foliant.functions.text import strip
from foliant.sources.arrays import array_elements
from foliant.schemas import DISPOSITIONS, RAW_PLAIN, RAW_SCRAPED, SCRAPED_FIELDS, ddl

# Record separator of an array written with an indent of two blanks.
INDENTED_SEPARATOR = "\n  },\n"
# What surrounds a record on a line of its own. No part matches the empty text, after
# which the next part would not be tried at the same place.
ROW_FRAME = r"^\s*\[\s*|^\s+|\s*[,\]]\s*$|\s+$"


def file_pos() -> list[Column]:
    path, start = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    return [path.alias("file"), start.alias("block")]


def source_pos() -> Column:
    return F.struct("file", "block", F.monotonically_increasing_id().alias("row")).alias("pos")


def _raw(rows: DataFrame, plain: Column, scraped: Column, keep_malformed: bool = False) -> DataFrame:
    """The fields of both record schemas, ``(plain, scraped, pos)``.

    ``scraped`` is NULL for records without a ``Title`` key. The row counter stands
    in the same projection: it keeps later filters from being pushed below it, which
    would parse every record once more for each of them.
    """
    raw = rows.select(plain.alias("plain"), scraped.alias("scraped"), source_pos())
    return raw if keep_malformed else raw.where(F.col("plain").isNotNull())


def raw_from_text(lines: DataFrame, text: Column, lenient: bool = False, keep_malformed: bool = False) -> DataFrame:
    """JSON texts -> raw records; texts that are no JSON object give none.

    Texts are read straight into the plain schema. Only those that do not fit it (a
    list with an entry of another kind) or that name a ``Title`` are parsed as
    VARIANT, which takes them field by field. Quotes must be double, and nothing may
    follow the object. With ``keep_malformed`` such texts are rows whose ``plain`` is NULL;
    blank ones never are.
    """
    options = {"columnNameOfCorruptRecord": "_misfit", "allowSingleQuotes": "false"}
    if lenient:
        options["allowUnquotedControlChars"] = "true"
    texts = lines.select(strip(text).alias("text"), *file_pos()).where(F.length("text") > 0)
    is_object = F.startswith("text", F.lit("{")) & F.endswith("text", F.lit("}")) & one_json("text", lenient)
    parsed = F.when(is_object, F.from_json("text", RAW_PLAIN, options))
    rows = texts.select("text", parsed.alias("parsed"), "file", "block")
    misfit = F.col("parsed._misfit").isNotNull()
    # A text that does not fit the schema may be malformed: then it gives no map either.
    whole = {k: x for k, x in options.items() if k != "columnNameOfCorruptRecord"}
    sound = ~misfit | F.when(misfit, F.from_json("text", "map<string,string>", whole)).isNotNull()
    has_title = F.contains("text", F.lit('"Title"'))
    # One projection per step: each is used more than once by the next.
    rows = rows.select("*", misfit.alias("misfit"), (F.col("parsed").isNotNull() & sound).alias("sound"))
    v = F.when(F.col("sound") & (F.col("misfit") | has_title), json_parse("text", lenient))
    rows = rows.select("*", v.alias("v"), has_title.alias("has_title"))
    # Unless the session allows them, VARIANT refuses repeated keys. Structs keep the last one.
    again = F.when(F.col("sound") & F.col("has_title") & F.col("v").isNull(), F.from_json("text", RAW_SCRAPED, whole))
    scraped = F.coalesce(F.when(has_key("v", "Title"), json_path("v", "$", RAW_SCRAPED)), F.when(again["Title"].isNotNull(), again))
    fitted = F.coalesce(F.when(F.col("misfit"), json_path("v", "$", RAW_PLAIN)), F.col("parsed"))
    plain = F.when(F.col("sound"), fitted)
    return _raw(rows, plain, scraped, keep_malformed)


def read_edition_dump(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated dump -> ``json``: the fifth field, embedded tabs kept."""
    return edition_json(spark.read.text(path))


def edition_json(lines: DataFrame, column: str = "value") -> DataFrame:
    """``json`` of lines with at least five fields.

    Same as the fifth element of a split with limit 5, but only the four short
    leading fields are looked at and the long one is never decoded.
    """
    line = F.col(column)
    head = F.substring_index(line, "\t", 4)
    rest = F.substring(line, F.length(head) + 2, F.lit(2**31 - 1))
    return lines.where(F.octet_length(head) < F.octet_length(line)).select(rest.alias("json"))


def read_books_jsonl(spark: SparkSession, path: str | list[str], keep_malformed: bool = False) -> DataFrame:
    """JSON Lines; blank lines are skipped, malformed ones too unless asked for."""
    return raw_from_text(spark.read.text(path), F.col("value"), keep_malformed=keep_malformed)


def read_books_json_array(
    spark: SparkSession, path: str | list[str], layout: str = "rows", keep_malformed: bool = False
) -> DataFrame:
    """One JSON array of records.

    ``rows``: one record per line, as an appending writer leaves it; splittable.
    ``indented``: pretty-printed with an indent of two and no raw line feed inside a
    text; splittable by its separator.
    ``split``: any layout, splittable anywhere and without a limit of size, at the price of
    two more passes over the bytes (see ``arrays``). Elements are cut by structure, so one that
    cannot be parsed does not end the file.
    ``whole``: any layout, each file cut into its records by one task in one pass, for many
    small files; a file beyond the two gigabytes of one text is an error.
    """
    if layout == "rows":
        record = F.regexp_replace("value", ROW_FRAME, "")
        return raw_from_text(spark.read.text(path), record, True, keep_malformed)
    if layout == "indented":
        chunks = spark.read.option("lineSep", INDENTED_SEPARATOR).text(path)
        body = F.regexp_replace("value", r"^\s*\[\s*|\s*\}\s*\]\s*$", "")
        record = F.when(F.length(strip(body)) > 0, F.concat(body, F.lit("\n}"))).otherwise("")
        return raw_from_text(chunks, record, True, keep_malformed)
    if layout == "split":
        return raw_from_record_texts(array_elements(spark, path), keep_malformed)
    if layout == "whole":
        # One file per row; the records stay texts, so that no value has to hold them all.
        files = spark.read.text(path, wholetext=True).select("value", *file_pos())
        texts = files.mapInPandas(_array_records(), "value string, file string, block long")
        return raw_from_record_texts(texts, keep_malformed)
    raise ValueError(f"unknown array layout: {layout}")


def raw_from_record_texts(texts: DataFrame, keep_malformed: bool = False) -> DataFrame:
    """``raw_from_text`` for ``value, file, block`` rows that carry their place themselves."""
    meta = F.struct(F.col("file").alias("file_path"), F.col("block").alias("file_block_start")).alias("_metadata")
    return raw_from_text(texts.select("value", meta), F.col("value"), True, keep_malformed)


def _array_records():
    """Cut the text of an array into the texts of its elements, in batches.

    Built inside a function, so that it travels to the executors by value. What cannot
    be read ends the file and is given as one row, which counts as malformed.
    """

    def cut(frames):
        import json
        import re

        import pandas as pd

        decode, gap = json.JSONDecoder(strict=False).raw_decode, re.compile(r"[\s,]*")

        def elements(text):
            at = gap.match(text).end()
            if not text.startswith("[", at):
                if text[at:].strip():
                    yield text[at:]
                return
            at = gap.match(text, at + 1).end()
            while at < len(text) and text[at] != "]":
                try:
                    end = decode(text, at)[1]
                except ValueError:
                    yield text[at : at + 1000]
                    return
                yield text[at:end]
                at = gap.match(text, end).end()

        for frame in frames:
            for text, file, block in zip(frame["value"], frame["file"], frame["block"]):
                batch = []
                for record in elements(text):
                    batch.append(record)
                    if len(batch) == 5000:
                        yield pd.DataFrame({"value": batch, "file": file, "block": block})
                        batch = []
                if batch:
                    yield pd.DataFrame({"value": batch, "file": file, "block": block})

    return cut


def detect_books_formats(spark: SparkSession, path: str | list[str]) -> dict[str, list[str]]:
    """The files of each kind: ``jsonl``, ``rows`` or ``whole`` (an array of another layout).

    A file that starts with a bracket is an array; it has ``rows`` if every line is a record of its
    own. The texts are read once for the first line of each file, and arrays once more, as lines and
    without parsing more than what stands on one; name the format where that is known.
    """
    first = F.min_by(F.startswith("line", F.lit("[")), F.struct("block", "row"))
    lines = _lines(spark, path).withColumn("row", F.monotonically_increasing_id())
    is_array = {f["file"]: f["array"] for f in lines.groupBy("file").agg(first.alias("array")).collect()}
    arrays = sorted(f for f, array in is_array.items() if array)
    rows = _have_rows(_lines(spark, arrays)) if arrays else set()
    found: dict[str, list[str]] = {}
    for file, array in sorted(is_array.items()):
        kind = "jsonl" if not array else "rows" if file in rows else "whole"
        found.setdefault(kind, []).append(file)
    return found


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines that are not blank, stripped, with their place."""
    return spark.read.text(path).select(strip("value").alias("line"), *file_pos()).where(F.length("line") > 0)


def _have_rows(lines: DataFrame) -> set[str]:
    """The files of which every line is a record of its own, or only part of the frame."""
    body = F.regexp_replace("line", ROW_FRAME, "")
    record = F.startswith(body, F.lit("{")) & F.endswith(body, F.lit("}")) & one_json(body, lenient=True)
    opens = F.startswith("line", F.lit("{")) | F.startswith("line", F.lit("["))
    # Other lines, which most lines of other layouts are, need no look at their end.
    own = F.when(opens, (F.length(body) == 0) | record).otherwise(F.col("line").isin("]", ","))
    files = lines.select("file", own.alias("own")).groupBy("file").agg(F.bool_and("own").alias("rows"))
    return {f["file"] for f in files.where("rows").collect()}


def read_books(spark: SparkSession, path: str, format: str = "auto", keep_malformed: bool = False) -> DataFrame:
    """Records of either file kind; ``format`` is ``auto``, ``jsonl`` or an array layout.

    ``auto`` decides for each file of ``path`` on its own, and reads arrays without a record
    per line as ``split``.
    """
    if format == "jsonl":
        return read_books_jsonl(spark, path, keep_malformed)
    if format != "auto":
        return read_books_json_array(spark, path, format, keep_malformed)
    kinds = detect_books_formats(spark, path)
    parts = [
        read_books_jsonl(spark, files, keep_malformed) if kind == "jsonl"
        else read_books_json_array(spark, files, "split" if kind == "whole" else kind, keep_malformed)
        for kind, files in kinds.items()
    ]
    if not parts:
        return read_books_jsonl(spark, path, keep_malformed)
    return reduce(DataFrame.unionByName, parts)


def read_isbn_list(spark: SparkSession, path: str) -> DataFrame:
    """One ISBN per line, stripped, blanks dropped, repeats kept."""
    isbn = strip("value").alias("isbn")
    return spark.read.text(path).select(isbn).where(F.length("isbn") > 0)


def read_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """Checkpoint objects -> ``(isbn, disposition, pos)``.

    Reads one object spread over lines as well as one object per line (how
    ``write_checkpoint`` splits large sets). Missing keys give no rows, an
    unreadable object gives none either. ``pos`` orders the entries of a list.
    """
    lists = ", ".join(f"{d}_isbns array<string>" for d in DISPOSITIONS)
    # Objects on lines of their own are read line by line; in files that hold other
    # lines, the whole text is one object.
    line = strip("value")
    alone = F.startswith(line, F.lit("{")) & F.endswith(line, F.lit("}"))
    lines = spark.read.text(path).select(line.alias("text"), alone.alias("alone"), *file_pos()).where(F.length("text") > 0)
    kinds = lines.groupBy("file").agg(F.bool_and("alone").alias("alone")).collect()
    parts = []
    for one_per_line in (True, False):
        files = [k["file"] for k in kinds if k["alone"] == one_per_line]
        if files:
            objects = spark.read.schema(lists).option("multiLine", not one_per_line).json(files)
            parts.append(objects.select("*", *file_pos()))
    objects = reduce(DataFrame.unionByName, parts) if parts else spark.read.schema(lists).json(path).select("*", *file_pos())
    entries = F.concat(*[_entries(d) for d in DISPOSITIONS])
    rows = objects.select("file", "block", entries.alias("entries")).select(source_pos(), F.inline("entries"))
    return rows.select("isbn", "disposition", F.struct("pos.*", "at").alias("pos"))


def _entries(disposition: str) -> Column:
    """The list of one disposition as ``(isbn, disposition, at)`` structs."""
    listed = F.transform(
        f"{disposition}_isbns",
        lambda isbn, at: F.struct(
            isbn.alias("isbn"), F.lit(disposition).alias("disposition"), at.alias("at")
        ),
    )
    return F.coalesce(listed, F.array().cast("array<struct<isbn:string,disposition:string,at:int>>"))


# Well-formed sequences of bytes, two hexadecimal digits each.
_CONTINUED = "[89AB][0-9A-F]"
_SEQUENCE = "|".join([
    "[0-7][0-9A-F]", f"(?:C[2-9A-F]|D[0-9A-F]){_CONTINUED}", f"E0[AB][0-9A-F]{_CONTINUED}", f"E[1-9ABCEF]{_CONTINUED}{_CONTINUED}",
    f"ED[89][0-9A-F]{_CONTINUED}", f"F0[9AB][0-9A-F]{_CONTINUED}{_CONTINUED}", f"F[1-3]{_CONTINUED}{_CONTINUED}{_CONTINUED}", f"F48[0-9A-F]{_CONTINUED}{_CONTINUED}",
])


def decodable(text: Column) -> Column:
    """``text`` without the bytes that are not UTF-8; a replacement character of its own stays."""
    sound = F.unhex(F.regexp_replace(F.hex(text.cast("binary")), f"({_SEQUENCE})|..", "$1")).cast("string")
    return F.when(F.is_valid_utf8(text), text).otherwise(sound)


def read_crawl_log(spark: SparkSession, path: str) -> DataFrame:
    """Log lines as ``value``; bytes that are not UTF-8 are left out."""
    return spark.read.text(path).select(decodable(F.col("value")).alias("value"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages ``(isbn, url, page_title, html)`` as Parquet."""
    return spark.read.parquet(path)


def read_scraped_books(spark: SparkSession, path: str) -> DataFrame:
    """Scraped books from JSON Lines with their declared types."""
    return spark.read.schema(ddl(SCRAPED_FIELDS)).json(path)


def read_scraped_csv(spark: SparkSession, path: str) -> DataFrame:
    """The CSV twin of the scraped books, JSON columns parsed back."""
    nested = {"Genre", "Review"}
    schema = ddl({k: "string" if k in nested else t for k, t in SCRAPED_FIELDS.items()})
    rows = (
        spark.read.schema(schema)
        .options(header=True, multiLine=True, quote='"', escape='"')
        .csv(path)
    )
    return rows.select(
        *[
            F.from_json(k, SCRAPED_FIELDS[k]).alias(k) if k in nested else F.col(k)
            for k in SCRAPED_FIELDS
        ]
    )


def load_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The catalog table; a missing path is an error."""
    return spark.read.parquet(path)

"""Text of HTML fragments, in built-in functions."""

from __future__ import annotations

import re
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

REFERENCE = "&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
TABLE_TAG = r"(?i)</?table\b[^>]*>"


def element(tag: str, css_class: str | None = None) -> str:
    """Pattern for the inner HTML of an element, optionally of one exact class."""
    return rf"(?is)<{tag}\b{_attributes(css_class)}>(.*?)</{tag}\s*>"


def _attributes(css_class: str | None) -> str:
    if css_class is None:
        return r"[^>]*"
    values = [rf'"{css_class}"', rf"'{css_class}'"]
    if " " not in css_class:
        values.append(rf"{css_class}(?=[\s>/])")
    return rf"[^>]*\bclass\s*=\s*(?:{'|'.join(values)})[^>]*"


def table_blocks(html: Column, css_class: str | None = None) -> Column:
    """Inner HTML of the tables of a class, in page order, tables inside them brought down to their text.

    The tags of tables are met in order and counted up and down, so tables may
    lie in each other as deep as they do. A table that is not closed ends with
    the page; an end without a start is passed over.
    """
    tags = F.regexp_extract_all(html, F.lit(TABLE_TAG), F.lit(0))
    behind = F.slice(F.split(html, TABLE_TAG, -1), F.lit(2), F.greatest(F.size(tags), F.lit(0)))
    parts = F.zip_with(tags, behind, lambda tag, text: F.struct(tag.alias("tag"), text.alias("text")))
    wanted = rf"(?is)^<table\b{_attributes(css_class)}>"

    def state(depth: Column, done: Column, open_: Column) -> Column:
        return F.struct(depth.cast("int").alias("depth"), done.alias("done"), open_.alias("open"))

    def met(now: Column, part: Column) -> Column:
        inside, starts = now["depth"] > 0, ~part["tag"].startswith("</")
        step = F.when(starts, 1).otherwise(-1)
        depth = F.when(inside, now["depth"] + step).when(starts & part["tag"].rlike(wanted), 1).otherwise(0)
        text = F.when(depth == 1, part["text"]).otherwise(F.regexp_replace(part["text"], "<[^>]*>", " "))
        ended = inside & (depth == 0)
        return state(
            depth,
            F.when(ended, F.array_append(now["done"], now["open"])).otherwise(now["done"]),
            F.when(depth == 0, F.lit("")).when(inside, F.concat(now["open"], F.lit(" "), text)).otherwise(text),
        )

    def left(now: Column) -> Column:
        return F.when(now["depth"] > 0, F.array_append(now["done"], now["open"])).otherwise(now["done"])

    none = F.array().cast("array<string>")
    found = F.aggregate(parts, state(F.lit(0), none, F.lit("")), met, left)
    return F.when(F.contains(F.lower(html), F.lit("<table")), found).otherwise(none)


def table_part(tag: str) -> str:
    """Pattern for the inner HTML of a row or cell, which ends where the next begins if it is not closed."""
    parts = "tr|tbody|thead|tfoot" if tag == "tr" else "td|th|tr|tbody|thead|tfoot"
    return rf"(?is)<{tag}\b[^>]*>(.*?)(?=</?(?:{parts})\b|\z)"


def replaced(text: Column, pattern: str, by, hint: str) -> Column:
    """Every match of a pattern replaced by a function of it; texts without ``hint`` are left alone."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    filled = F.array_append(F.transform(found, by), F.lit(""))
    whole = F.array_join(F.flatten(F.zip_with(pieces, filled, lambda a, b: F.array(a, b))), "")
    return F.when(F.contains(F.lower(text), F.lit(hint)), whole).otherwise(text)


def character(reference: Column) -> Column:
    """The character of a reference by number or name; an unknown name stays as it is."""
    name = F.substring(reference, F.lit(2), F.length(reference) - 2)
    number = (
        F.when(F.lower(name).startswith("#x"), F.conv(F.substring(name, F.lit(3), F.length(name)), 16, 10))
        .when(name.startswith("#"), F.substring(name, F.lit(2), F.length(name)))
        .cast("long")
    )
    valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    code = F.when(valid, number).otherwise(0xFFFD)
    by_number = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    names = {n: chr(c) for n, c in name2codepoint.items()} | {"apos": "'"}
    by_name = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[name]
    return F.when(name.startswith("#"), by_number).otherwise(F.coalesce(by_name, reference))


def visible_text(html: Column) -> Column:
    """Text of a fragment: tags dropped, references decoded once, ends stripped."""
    text = F.regexp_replace(html, r"(?s)<!--.*?-->|<[^>]*>", "")
    return F.regexp_replace(replaced(text, REFERENCE, character, "&"), r"^[\s\u00a0]+|[\s\u00a0]+$", "")


def unescaped(path: Column) -> Column:
    """Part of a path with its percent signs decoded; one that is not encoded stays as it is."""
    kept = F.replace(path, F.lit("+"), F.lit("%2B"))
    return F.coalesce(F.try_url_decode(kept), path)


def folder_value(path: Column, name: str) -> Column:
    """Value of the folder ``name=value`` in a file's path, null without one."""
    value = F.regexp_extract(path, f"/{re.escape(name)}=([^/]*)/", 1)
    known = (value != "") & (value != "__HIVE_DEFAULT_PARTITION__")
    # Encoded twice: as the name of a folder, then as part of an address.
    return F.when(known, unescaped(unescaped(value)))

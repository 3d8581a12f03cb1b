"""Text normalising, citations, labels and slugs."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .decoded import SPACE, Decoded, let, required, strip

# Dash variants seen in ruling numbers, and box-drawing borders.
DASHES = r"\-\u2010-\u2015"
BORDERS = " \u2502\u250c\u2514\u2510\u2518\u2500"
# Places where a text breaks into lines, besides the line feed.
OTHER_BREAKS = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
# Term names as published, with their stored form.
TERMS = {"short-term": "short_term", "mid-term": "mid_term", "long-term": "long_term"}


def collapse(text: Column) -> Column:
    """Runs of white space, no-break space included, become one space."""
    return F.btrim(F.regexp_replace(text, f"{SPACE}+", " "))


def text_lines(text: Column) -> Column:
    """Array of non-empty lines without borders, white space collapsed.

    Rare characters are replaced one by one, which is a plain byte search, so that the
    text can be cut at line feeds without a pattern.
    """
    broken = F.replace(F.replace(text, F.lit("\u0002"), F.lit("-")), F.lit("\u00a0"), F.lit(" "))
    for mark in OTHER_BREAKS:
        broken = F.replace(broken, F.lit(mark), F.lit("\n"))
    return F.filter(
        F.transform(F.split(broken, "\n"), lambda line: collapse(F.btrim(line, F.lit(BORDERS)))),
        lambda line: line != "",
    )


def revision_flag(text: Column) -> Decoded:
    trimmed = strip(text)
    return Decoded(F.when(trimmed.isin("Y", "N"), trimmed), trimmed != "")


def identifier(text: Column) -> Decoded:
    trimmed = strip(text)
    return Decoded(F.when(trimmed.rlike("^[A-Za-z0-9_.-]{1,32}$"), trimmed), trimmed != "")


def ruling_citation(text: Column) -> Column:
    """First ``Rev. Rul. YYYY-N`` in a text, leading zeros of N removed."""
    shape = rf"(?i)Rev\. Rul\. ([0-9]{{4}}|[0-9]{{2}})[{DASHES}]([0-9]{{1,3}})"
    return let(
        F.regexp_substr(text, F.lit(shape)),
        lambda found: F.concat(
            F.lit("Rev. Rul. "), F.regexp_extract(found, shape, 1), F.lit("-"),
            F.regexp_extract(found, shape, 2).try_cast("int").cast("string"),
        ),
    )


def ruling_label(text: Column) -> Decoded:
    """A whole cell that is a ruling number; a missing full stop is put back."""
    shape = r"^Rev\. Rul\.? ([0-9]{4}|[0-9]{2})-[0-9]{1,3}$"
    return required(F.when(text.rlike(shape), F.regexp_replace(text, r"^Rev\. Rul ", "Rev. Rul. ")))


def procedure_citation(text: Column) -> Column:
    """First ``Rev. Proc. YYYY-N`` in a text."""
    return F.regexp_substr(text, F.lit(r"Rev\. Proc\. [0-9]{4}-[0-9]{1,3}"))


def rate_label(text: Column) -> Column:
    """``AFR``, ``110% AFR``, ``110$ AFR``, ``adjusted AFR`` to stored names."""
    label = F.lower(collapse(text))
    multiple = F.regexp_extract(label, "^(.*)[%$] afr$", 1)
    return (
        F.when(label == "afr", F.lit("afr"))
        .when(label == "adjusted afr", F.lit("adjusted_afr"))
        .when(multiple != "", F.concat(F.lit("afr_"), multiple))
    )


def term_label(text: Column) -> Column:
    key = F.translate(F.lower(text), "\u2011\u2010", "--")
    result = F.lit(None).cast("string")
    for name, stored in TERMS.items():
        result = F.when(key == name, F.lit(stored)).otherwise(result)
    return result


def slug(text: Column) -> Column:
    """Lower case, other characters to ``-``; null when nothing is left."""
    value = F.regexp_replace(
        F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", ""
    )
    return F.when(value != "", value)


def subject_slug(subjects: Column) -> Column:
    ordered = F.array_join(F.array_sort(subjects), ",")
    return (
        F.when(ordered == "afr,section-7520-rates", F.lit("afr-7520"))
        .when(ordered == "section-7520-rates", F.lit("7520"))
        .otherwise(F.lit("afr"))
    )


def period_slug(periods: Column) -> Column:
    ordered = F.array_sort(periods)
    return F.when(F.size(periods) == 1, F.element_at(ordered, 1)).otherwise(
        F.concat(F.element_at(ordered, 1), F.lit("_to_"), F.element_at(ordered, -1))
    )


def archive_name(periods: Column, subjects: Column, title: Column, url: Column) -> Column:
    """File name under which a source document is kept."""
    file_name = F.regexp_extract(F.try_url_decode(F.regexp_replace(
        F.regexp_replace(url, r"[?#].*$", ""), r"\+", "%2B")), r"([^/]+)$", 1)
    stem = F.when(F.lower(file_name).endswith(".pdf"), F.regexp_replace(file_name, r"\.[^.]*$", ""))
    parts = [period_slug(periods), subject_slug(subjects), slug(title), slug(stem)]
    return F.concat(parts[0], F.lit("_"), parts[1], F.lit("_"), parts[2], F.lit("_"), parts[3], F.lit(".pdf"))


def subject_title(subject: Column) -> Column:
    return F.when(subject == "section-7520-rates", F.lit("Section 7520")).otherwise(F.lit("AFR"))


def unescape(text: Column) -> Column:
    """HTML character references, each replaced once, left to right, as HTML 5 resolves them in text.

    Named ones need their semicolon only where HTML 5 asks for it; of names that run into text the longest counts.
    """
    closed = F.from_json(F.lit(json.dumps({n: v for n, v in html5.items() if n.endswith(";")})), "map<string,string>")
    bare = {n: v for n, v in html5.items() if not n.endswith(";")}
    open_names = F.from_json(F.lit(json.dumps(bare)), "map<string,string>")
    any_bare = "^&(" + "|".join(sorted(bare, key=lambda n: (-len(n), n))) + ")"
    # References to these control codes mean the characters of the Windows code page.
    windows = F.array(*[F.lit(bytes([i]).decode("cp1252", "ignore") or chr(i)) for i in range(128, 160)])

    def number(digits: Column, base: int, width: int) -> Column:
        short = F.ltrim(digits, F.lit("0"))
        value = F.conv(F.when(short == "", F.lit("0")).otherwise(short), base, 10).try_cast("int")
        return F.when(digits != "", F.when(F.length(short) <= width, value).otherwise(F.lit(0x110000)))

    def character(code: Column) -> Column:
        no_text = (
            code.between(1, 8) | (code == 11) | code.between(14, 31) | (code == 127)
            | code.between(0xFDD0, 0xFDEF) | (F.pmod(code, F.lit(0x10000)) >= 0xFFFE)
        )
        return (
            F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), F.lit("\ufffd"))
            .when(code.between(128, 159), F.get(windows, code - 128))
            .when(no_text, F.lit(""))
            .otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        )

    def one(piece: Column) -> Column:
        numeric = F.regexp_extract(piece, "^&#(?:[0-9]+|[xX][0-9a-fA-F]+);?", 0)
        code = F.coalesce(
            number(F.regexp_extract(numeric, "^&#([0-9]+)", 1), 10, 7), number(F.regexp_extract(numeric, "^&#[xX]([0-9a-fA-F]+)", 1), 16, 6))
        name = F.regexp_extract(piece, r"^&([^\t\n\f <&#;]{1,32};)", 1)
        known = F.try_element_at(closed, name)
        prefix = F.regexp_extract(piece, any_bare, 1)
        return (
            F.when(numeric != "", F.concat(character(code), F.substr(piece, F.length(numeric) + 1)))
            .when(known.isNotNull(), F.concat(known, F.substr(piece, F.length(name) + 2)))
            .when(prefix != "", F.concat(F.try_element_at(open_names, prefix), F.substr(piece, F.length(prefix) + 2)))
            .otherwise(piece)
        )

    pieces = F.split(text, "(?=&)")
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(pieces, one), "")).otherwise(text)

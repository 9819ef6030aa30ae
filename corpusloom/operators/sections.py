"""Sections of a text by heading lines, as expressions over the array of its lines: no shuffle, no Python."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions import text as T

Headings = tuple[tuple[str, tuple[str, ...]], ...]


def _any_of(patterns: Iterable[str]) -> str:
    """One pattern that matches where any does, at the start of a line only; the outer anchor lets the
    engine give up at once everywhere else, which matters on long lines."""
    return "^(?:" + "|".join(f"(?:{p})" for p in patterns) + ")"


def _names(line: Column, headings: Headings) -> Column:
    """All section names whose patterns the stripped line fits, in the order of the table."""
    found = [F.when(line.rlike(_any_of(patterns)), F.lit(name)) for name, patterns in headings]
    return F.array_compact(F.array(*found))


def heading_candidates(text: Column, headings: Headings = K.SECTION_HEADINGS) -> Column:
    """``array<struct<line,name,size>>`` of all lines of at most 100 characters that fit a heading."""

    none = F.array().cast("array<struct<line:int,name:string,size:int>>")

    def of_line(raw: Column, i: Column) -> Column:
        def named(line: Column) -> Column:
            return F.transform(_names(line, headings), lambda n: F.struct(i.alias("line"), n.alias("name"), F.length(line).alias("size")))

        return let(T.strip(raw), lambda line: F.when((line != "") & (F.length(line) <= 100), named(line)).otherwise(none))

    return F.flatten(F.transform(F.split(text, "\n", -1), of_line))


def kept_headings(candidates: Column) -> Column:
    """One heading a line, and one of the same name within two lines; the shorter line counts."""
    kind = "array<struct<line:int,name:string,size:int>>"

    def step(kept: Column, x: Column) -> Column:
        last = F.try_element_at(kept, F.lit(-1))
        same = (last["line"] == x["line"]) | ((last["name"] == x["name"]) & (x["line"] - last["line"] <= 2))
        shorter = F.concat(F.slice(kept, 1, F.size(kept) - 1), F.array(x))
        return F.when(F.coalesce(same, F.lit(False)), F.when(x["size"] < last["size"], shorter).otherwise(kept)).otherwise(F.concat(kept, F.array(x)))

    return F.aggregate(candidates.cast(kind), F.array().cast(kind), step)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once: a lambda's variable is not expanded where it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def split_sections(text: Column, headings: Headings = K.SECTION_HEADINGS) -> Column:
    """Map of section name to text; texts of one name are joined by a blank line.

    Without any heading the map holds ``full_text``; an empty or null text gives an empty map.
    """

    def bodies(lines: Column, kept: Column) -> Column:
        def body(x: Column, i: Column) -> Column:
            end = F.coalesce(F.get(kept, i + 1)["line"], F.size(lines))
            part = F.slice(lines, x["line"] + 2, F.greatest(end - x["line"] - 1, F.lit(0)))
            return F.struct(x["name"].alias("name"), T.strip(F.array_join(part, "\n")).alias("text"))

        return F.transform(kept, body)

    def by_name(parts: Column) -> Column:
        names = F.array_distinct(F.transform(parts, lambda p: p["name"]))
        return F.transform(names, lambda n: F.struct(n.alias("k"), F.array_join(F.transform(F.filter(parts, lambda p: p["name"] == n), lambda p: p["text"]), "\n\n").alias("v")))

    entries = let(kept_headings(heading_candidates(text, headings)), lambda kept: let(let(F.split(text, "\n", -1), lambda lines: bodies(lines, kept)), by_name))
    whole = F.array(F.struct(F.lit("full_text").alias("k"), text.alias("v")))
    found = let(entries, lambda e: F.when(F.size(e) > 0, e).otherwise(whole))
    none = F.array().cast("array<struct<k:string,v:string>>")
    return F.map_from_entries(F.when(T.text_or_empty(text) == "", none).otherwise(found))


def abstract_by_heading(text: Column, headings: Headings = K.SECTION_HEADINGS) -> Column:
    """Text from the line behind the first ``abstract`` line to the next other heading; null without one."""
    any_other = _any_of(p for name, patterns in headings if name != "abstract" for p in patterns)

    def part(lines: Column, start: Column) -> Column:
        rest = F.slice(lines, start + 1, F.size(lines))
        stops = F.transform(rest, lambda x: T.strip(x).rlike(any_other))
        end = let(F.array_position(stops, True), lambda i: F.when(i > 0, i - 1).otherwise(F.size(rest)))
        return T.strip(F.array_join(F.slice(rest, 1, end.cast("int")), "\n"))

    def search(lines: Column) -> Column:
        first = F.array_position(F.transform(lines, lambda x: T.strip(x).rlike(r"(?i)^\s*abstract\s*$")), True).cast("int")
        return let(first, lambda start: F.when(start > 0, part(lines, start)))

    return let(F.split(text, "\n", -1), search)


def keyword_windows(text: Column, keyword: str, around: int = 3) -> Column:
    """The lines around every line that holds ``keyword`` (any case), as an array of texts."""

    def windows(lines: Column) -> Column:
        hits = F.filter(F.transform(lines, lambda x, i: F.when(F.lower(x).contains(keyword.lower()), i)), lambda i: i.isNotNull())

        def window(i: Column) -> Column:
            low = F.greatest(i - around, F.lit(0))
            return F.array_join(F.slice(lines, low + 1, i + around + 1 - low), "\n")

        return F.transform(hits, window)

    return let(F.split(text, "\n", -1), windows)


def union_sections(first: Column, second: Column) -> Column:
    """Map union in which ``first`` wins."""
    rest = F.map_filter(second, lambda k, _: ~F.array_contains(F.map_keys(first), k))
    return F.map_concat(first, rest)


def clean_method(text: Column) -> Column:
    """A method section without e-mail front matter, table captions (and their continuation) and table rows."""
    from corpusloom.functions.quality import is_table_line

    t = T.text_or_empty(text)
    mail = F.regexp_extract(F.left(t, F.lit(800)), r"(?si)^(.*?(?:\{[^{}]{0,300}\}\s*)?@[A-Za-z0-9.-]+\.[A-Za-z]{2,})", 1)
    rest = F.substr(t, F.length(mail) + 1)
    lines = F.filter(F.transform(F.split(rest, r"\r\n|[\n\r\x0B\f\x1C-\x1E\x85\u2028\u2029]"), T.clean_space), lambda x: x != "")
    marked = F.transform(lines, lambda x: F.struct(x.alias("x"), x.rlike(r"(?i)^(?:table|tab\.)\s+[A-Z]?\d+\b").alias("caption"), is_table_line(x).alias("table"), ((F.length(x) < 180) & ~x.rlike(r"[.!?]\s*$")).alias("loose")))

    def step(acc: Column, m: Column) -> Column:
        skip = acc["skip"]
        # A table row goes without ending a caption; a finished line ends it and stays.
        stays = ~m["caption"] & ~m["table"] & ~(skip & m["loose"])
        after = F.when(m["caption"], True).when(m["table"], skip).otherwise(skip & m["loose"])
        return F.struct(after.alias("skip"), F.when(stays, F.concat(acc["kept"], F.array(m["x"]))).otherwise(acc["kept"]).alias("kept"))

    start = F.struct(F.lit(False).alias("skip"), F.array().cast("array<string>").alias("kept"))
    kept = F.aggregate(marked, start, step, lambda acc: acc["kept"])
    return F.regexp_replace(T.clean_space(F.array_join(kept, " ")), r"(?:\s*\[equation\]\s*){2,}", " [equation] ")


def title_of_blocks(blocks: Column, page_text: Column) -> Column:
    """A title from a first page: the first of three text blocks that is no e-mail or list of names."""
    texts = F.transform(F.filter(blocks, lambda b: b["type"] == "text"), lambda b: T.strip(T.text_or_empty(b["text"])))

    def good(x: Column) -> Column:
        commas = F.length(x) - F.length(F.replace(x, F.lit(","), F.lit("")))
        return (x != "") & ~x.contains("@") & (F.length(x) > 10) & (F.length(x) < 400) & (commas < 0.05 * F.length(x))

    of_lines = F.filter(F.slice(F.transform(F.split(T.strip(page_text), "\n", -1), T.strip), 1, 5), lambda x: (F.length(x) > 10) & (F.length(x) < 300))
    return F.when(F.size(texts) > 0, F.coalesce(F.get(F.filter(F.slice(texts, 1, 3), good), F.lit(0)), F.get(texts, F.lit(0)))).otherwise(F.get(of_lines, F.lit(0)))

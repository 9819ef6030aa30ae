"""Quality predicates and error lists as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom import constants as K

from .text import clean_abstract, plain_key, text_or_empty, title_key


def count_of(c: Column, pattern: str) -> Column:
    return F.regexp_count(text_or_empty(c), F.lit(pattern))


def is_complete(cleaned: Column) -> Column:
    """A cleaned abstract of 80 characters or more that does not break off."""
    return (F.length(text_or_empty(cleaned)) >= 80) & ~text_or_empty(cleaned).rlike(r"(?:…|\.\.\.)$")


def abstract_is_complete(c: Column) -> Column:
    return is_complete(clean_abstract(c))


def title_is_usable(title: Column, has_authors_or_year: Column) -> Column:
    """Long enough for a lookup by title alone, the more so without authors and year."""
    key = title_key(title)
    words = F.when(key == "", 0).otherwise(F.size(F.split(key, " ")))
    return words.between(3, 40) & (F.length(key) >= 15) & (F.coalesce(has_authors_or_year, F.lit(False)) | ((words >= 5) & (F.length(key) >= 25)))


def _many_numbers(c: Column, least: int, floor: int) -> Column:
    numbers = count_of(c, K.NUMBER)
    return (numbers >= least) & (numbers >= F.greatest(F.lit(floor), F.floor(count_of(c, K.LATIN_WORD) / 3)))


def is_table_line(c: Column) -> Column:
    return _many_numbers(c, 8, 4) | (count_of(c, K.METRIC) >= 5)


def has_numeric_start(c: Column) -> Column:
    head = F.left(text_or_empty(c), F.lit(1200))
    numbers = count_of(head, K.NUMBER)
    return (numbers >= 20) & (numbers >= count_of(head, K.LATIN_WORD) * 0.25)


def method_errors(c: Column) -> Column:
    """Messages for a method section, in a fixed order."""
    c = text_or_empty(c)
    tests = (
        (F.length(c) > 40000, "method is implausibly long"),
        (c.contains("\0"), "method contains binary/OCR artifacts"),
        (c.rlike(r"(?i)\btable\s+[A-Z]?\d+\b"), "method contains table/result content"),
        (c.rlike(K.FIGURE_CAPTION), "method contains figure-caption content"),
        (c.rlike(K.FRONT_MATTER), "method contains publication front matter"),
        (has_numeric_start(c), "method starts with a numeric result matrix"),
    )
    return F.array_compact(F.array(*[F.when(test, F.lit(message)) for test, message in tests]))


def summary_is_noisy(c: Column) -> Column:
    c = text_or_empty(c)
    found = c.contains("\0") | _many_numbers(c, 10, 5)
    for pattern in (r"(?i)\btable\s+[A-Z]?\d+\s*[:.]", K.FIGURE_CAPTION, K.IO_LISTING, K.RIGHTS, K.TABLE_DEBRIS):
        found = found | c.rlike(pattern)
    return found


def reference_is_noisy(title: Column, summary: Column) -> Column:
    return summary_is_noisy(summary) | text_or_empty(title).rlike("(?i)frobnicat|lorem ipsum|placeholder")


def failure_category(errors: Column) -> Column:
    """Quality or missing source, by the markers in an array of messages."""
    message = F.lower(F.array_join(errors, " "))
    found = F.lit(False)
    for marker in K.QUALITY_MARKERS:
        found = found | message.contains(marker)
    return F.when(found, "quality_validation").otherwise("source_unavailable")


def venue_tier(venue: Column, doi: Column) -> Column:
    """3 for a listed venue, 2 for another formal one, 1 with a DOI, else 0."""
    key = plain_key(venue)
    padded = F.concat(F.lit(" "), key, F.lit(" "))
    listed = F.lit(False)
    for name in K.TOP_VENUES:
        bare = " ".join("".join(ch if ch.isascii() and ch.isalnum() else " " for ch in name.lower()).split())
        listed = listed | padded.contains(f" {bare} ")
    return F.when(listed, 3).when(~key.isin("", "unknown", "arxiv preprint"), 2).when(text_or_empty(doi) != "", 1).otherwise(0)


def document_errors(title: Column, abstract: Column, introduction: Column, field: Column, venue: Column, method: Column, references: Column, min_references: int = 1) -> Column:
    """Messages of the output gate in a fixed order; ``references`` is an array of
    ``struct<id,title,summary,citation_contexts:array<struct<source_section,context_before,citation_sentence,context_after>>>``."""
    n = F.coalesce(F.size(references), F.lit(0))

    def broken_context(x: Column) -> Column:
        empty = (text_or_empty(x["source_section"]) == "") | (text_or_empty(x["citation_sentence"]) == "")
        return empty | x["context_before"].isNull() | x["context_after"].isNull()

    def broken(r: Column) -> Column:
        empty = (text_or_empty(r["id"]) == "") | (text_or_empty(r["title"]) == "") | (text_or_empty(r["summary"]) == "")
        contexts = r["citation_contexts"]
        # Summaries are cleaned abstracts already, so no entity is left to open here.
        return empty | ~is_complete(r["summary"]) | contexts.isNull() | (F.size(contexts) < 1) | F.exists(contexts, broken_context)

    few = F.concat(F.lit("too few cited-paper abstracts resolved ("), n.cast("string"), F.lit(f" < {min_references})"))
    about = (
        F.when(n == 0, F.lit("no cited-paper abstracts resolved"))
        .when(n < min_references, few)
        .when(F.exists(references, broken), F.lit("one or more references lack a complete abstract or citation context"))
    )
    tests = (
        (F.length(text_or_empty(title)) < 5, "title is empty or too short"),
        (F.length(text_or_empty(abstract)) < 100, "abstract is empty or too short"),
        (F.length(text_or_empty(introduction)) < 100, "introduction is empty or too short"),
        (text_or_empty(field) == "", "field is empty"),
        (text_or_empty(venue) == "", "venue is empty"),
    )
    plain = F.array_compact(F.array(*[F.when(test, F.lit(message)) for test, message in tests]))
    of_method = F.when(text_or_empty(method) == "", F.array().cast("array<string>")).otherwise(method_errors(method))
    return F.concat(plain, of_method, F.array_compact(F.array(about)))

"""Fenced blocks of a markdown draft, read in the row that holds the draft.

A draft is cut at its fence lines into n fences and n + 1 segments, so that everything the rules ask
("words before the first code", "dashes outside code") becomes arithmetic on two short arrays. No line
is exploded and nothing is shuffled. Three readings of the same fences exist and all are needed:

* toggle: every fence line flips inside/outside (metrics, dashes, rhythm);
* tagged: a fence opens only if it carries a tag, and any fence closes it (code blocks);
* visual: only an exact ```visual line opens (visual specs).
"""
from pyspark.sql import Column, functions as F

from lectern.functions.text import ANY_SPACE, SPACE, strip, total, word_count

FENCE_LINE = rf"(?dm)^[{SPACE}]*```[^\n]*"
_CLOSE = rf"(?:\n[{SPACE}]*(```[^\n]*)|\z)"
TAGGED_BLOCK = rf"(?dms)^[{SPACE}]*```([^\n]*[^{ANY_SPACE}][^\n]*)$(?:\n(.*?))??{_CLOSE}"
VISUAL_BLOCK = rf"(?dms)^[{SPACE}]*```visual[{SPACE}]*$(?:\n(.*?))??{_CLOSE}"


def segments(md: Column) -> Column:
    return F.split(md, FENCE_LINE, -1)


def fences(md: Column) -> Column:
    return F.transform(F.regexp_extract_all(md, F.lit(FENCE_LINE), F.lit(0)), strip)


def label(fence: Column) -> Column:
    return strip(F.substring(fence, 4, 1 << 30))


def fence_labels(fence_array: Column) -> Column:
    return F.transform(fence_array, label)


def _inner(segment: Column) -> Column:
    """The lines of a segment without the line feed that ends the fence line before it."""
    return F.regexp_replace(segment, r"\A\n", "")


def prose(segs: Column) -> Column:
    """The lines outside fences, in order, as one text."""
    outside = F.transform(segs, lambda s, i: F.when(i % 2 == 0, F.when(i == 0, s).otherwise(_inner(s))))
    return F.array_join(F.filter(outside, lambda s: s.isNotNull()), "")


def visible(segs: Column, labels: Column) -> Column:
    """Segments a reader sees as text: prose, and `visual` fences in any letter case."""
    return F.filter(
        F.transform(segs, lambda s, i: F.when((i % 2 == 0) | (F.lower(F.get(labels, i - 1)) == "visual"), s)),
        lambda s: s.isNotNull())


def fenced(segs: Column, labels: Column, wanted) -> Column:
    """The text of all fences whose lower-case label is in `wanted`."""
    body = F.transform(
        segs, lambda s, i: F.when((i % 2 == 1) & F.lower(F.get(labels, i - 1)).isin(wanted), _inner(s)))
    return F.array_join(F.filter(body, lambda s: s.isNotNull()), "")


def line_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit("\n"))


def blocks(md: Column, pattern: str) -> Column:
    """array<struct<info, body, close>> of the blocks a pattern finds, in order."""
    with_info = pattern == TAGGED_BLOCK
    first = 1 if with_info else 0
    info = F.regexp_extract_all(md, F.lit(pattern), F.lit(1)) if with_info else None
    body = F.regexp_extract_all(md, F.lit(pattern), F.lit(first + 1))
    close = F.regexp_extract_all(md, F.lit(pattern), F.lit(first + 2))
    if with_info:
        return F.transform(F.arrays_zip(info.alias("info"), body.alias("body"), close.alias("close")),
                           lambda b: F.struct(F.lower(strip(b["info"])).alias("info"),
                                              b["body"].alias("body"), strip(b["close"]).alias("close")))
    return F.transform(F.arrays_zip(body.alias("body"), close.alias("close")),
                       lambda b: F.struct(F.lit("visual").alias("info"),
                                          b["body"].alias("body"), strip(b["close"]).alias("close")))


# ---- visual specs --------------------------------------------------------------------------

def _field_entries(body: Column) -> Column:
    """array<struct<name, value>>: a field line and the lines that continue it, joined by one space."""
    chunks = F.slice(F.split(F.concat(F.lit("\n"), body), r"\n(?=[a-z_]+:)", -1), 2, 1 << 30)

    def entry(chunk: Column) -> Column:
        lines = F.transform(F.split(F.regexp_replace(chunk, r"\A[a-z_]+:", ""), "\n", -1), strip)
        texts = F.transform(lines, lambda v, i: F.when(i == 0, strip(F.regexp_replace(v, r"\A\|+", ""))).otherwise(v))
        return F.struct(F.regexp_extract(chunk, r"\A([a-z_]+):", 1).alias("name"),
                        F.array_join(F.filter(texts, lambda v: v != ""), " ").alias("value"))

    return F.transform(chunks, entry)


def visual_fields(body: Column, names) -> Column:
    """struct of the wanted fields; the last mention of a field wins, a missing field is empty."""
    entries = _field_entries(body)

    def value(name):
        hits = F.filter(entries, lambda e: e["name"] == name)
        return F.coalesce(F.try_element_at(hits, F.lit(-1))["value"], F.lit(""))

    return F.struct(*[value(n).alias(n) for n in names])


__all__ = ["segments", "fences", "label", "fence_labels", "prose", "visible", "fenced", "line_count", "blocks",
           "visual_fields", "TAGGED_BLOCK", "VISUAL_BLOCK", "FENCE_LINE", "total", "word_count"]

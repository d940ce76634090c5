"""Counting and replacing dashes in drafts."""
from pyspark.sql import Column, functions as F

from lectern.functions import fences as fn
from lectern.functions.text import strip, total

DASH = "[—–]| -- "

# Fixed values: (pattern, replacement) in order, for one line of prose without its indent.
PROSE_STEPS = [
    (r" ?[—–] ?", ", "),
    (r" -- ", ", "),
    (r"\A,\s*", ""),
    (r" +,", ","),
    (r",\s*,", ", "),
    (r",\s*([.;:!?])", "$1"),
]


def count_in(segs: Column, labels: Column) -> Column:
    """Dashes a reader sees: outside code fences, `visual` fences included."""
    return total(F.transform(fn.visible(segs, labels), lambda s: F.regexp_count(s, F.lit(DASH)).cast("bigint")))


def count(md: Column) -> Column:
    return count_in(fn.segments(md), fn.fence_labels(fn.fences(md)))


def _prose_line(line: Column) -> Column:
    indent = F.regexp_extract(line, r"\A( *)", 1)
    text = F.substring(line, F.length(indent) + 1, F.length(line))
    for pattern, replacement in PROSE_STEPS:
        text = F.regexp_replace(text, pattern, replacement)
    return F.concat(indent, text)


def rewrite(md: Column) -> Column:
    """Dashes to commas in prose and `visual` fences, to ' - ' in other fences; fence lines stay."""
    segs = fn.segments(md)
    raw_fences = F.regexp_extract_all(md, F.lit(fn.FENCE_LINE), F.lit(0))
    labels = F.transform(raw_fences, lambda f: F.lower(fn.label(strip(f))))

    def segment(s: Column, i: Column) -> Column:
        as_prose = F.array_join(F.transform(F.split(s, "\n", -1), _prose_line), "\n")
        as_code = F.regexp_replace(s, r" ?[—–] ?", " - ")
        return F.when((i % 2 == 0) | (F.get(labels, i - 1) == "visual"), as_prose).otherwise(as_code)

    clean = F.transform(segs, segment)
    return F.array_join(F.transform(clean, lambda s, i: F.concat(s, F.coalesce(F.get(raw_fences, i), F.lit("")))), "")

"""Column helpers for text. "Space" is the full Unicode set, not only U+0020 that `trim` takes."""
from pyspark.sql import Column, functions as F

# Every space character but the line feed, as the body of a regex class.
SPACE = r"\t\x0b\f\r\x1c-\x1f \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
ANY_SPACE = SPACE + r"\n"
# The complement, spelled out with the commonest range first: one comparison settles most characters.
NOT_SPACE = (r"\x21-\x84\x00-\x08\x0e-\x1b\x86-\x9f\xa1-\u167f\u1681-\u1fff\u200b-\u2027\u202a-\u202e\u2030-\u205e"
             r"\u2060-\u2fff\u3001-\x{10ffff}")
SPACE_CHARS = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b))) + "\u2028\u2029\u202f\u205f\u3000"

KEBAB = r"^[a-z0-9][a-z0-9-]*\n?\z"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACE_CHARS))


def is_blank(c: Column) -> Column:
    """True for null, empty and space-only text."""
    return F.coalesce(strip(c), F.lit("")) == ""


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(rf"[{NOT_SPACE}]+"))


def slug(c: Column) -> Column:
    """Path-safe id: lower case, anything else a dash, outer dashes cut, never empty."""
    safe = F.btrim(F.regexp_replace(F.lower(c.cast("string")), "[^a-z0-9-]", "-"), F.lit("-"))
    return F.coalesce(F.nullif(safe, F.lit("")), F.lit("x"))


def module_slug(c: Column) -> Column:
    return slug(F.regexp_replace(c, "^module-", ""))


def visual_slug(c: Column) -> Column:
    """Like `slug`, but letters and digits of any script stay and dash runs collapse."""
    safe = F.btrim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", "-"), F.lit("-"))
    return F.coalesce(F.nullif(safe, F.lit("")), F.lit("x"))


def stem_prefix(mod_idx: Column, order: Column) -> Column:
    return F.format_string("m%02d-l%d-", F.coalesce(mod_idx.cast("int"), F.lit(99)), order.cast("bigint"))


def stem(mod_idx: Column, order: Column, lesson_id: Column) -> Column:
    """File stem of a lesson's draft, assets and facts."""
    return F.concat(stem_prefix(mod_idx, order), slug(lesson_id))


def quiz_stem(mod_idx: Column, order: Column, lesson_id: Column) -> Column:
    """The quiz file stem keeps the id as it is."""
    return F.concat(stem_prefix(mod_idx, order), lesson_id)


def version_key(c: Column) -> Column:
    """'4.10' -> [4, 10]: arrays of numbers compare the way versions do."""
    digits = F.slice(F.regexp_extract_all(c, F.lit(r"\d+"), F.lit(0)), 1, 4)
    return F.transform(digits, lambda d: d.try_cast("bigint"))


def literal_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def present(items: Column) -> Column:
    return F.filter(items, lambda x: x.isNotNull())


def total(items: Column) -> Column:
    return F.aggregate(items, F.lit(0).cast("bigint"), lambda acc, x: acc + x)


# Texts inside a document may be of any length, and keys may repeat (the last one counts).
JSON_OPTIONS = {"maxStringLen": "2147483647", "maxNestingDepth": "100000", "maxNumLen": "2147483647", "allowSingleQuotes": "false"}


def is_json(c: Column) -> Column:
    """Exactly one JSON value. The parser alone would accept text after a value, so the value must be
    well-formed as the only element of an array and as the only member of an object. Each is read once, and no value is copied: `v` is not in the schema."""
    def parses(*parts: Column) -> Column:
        return F.from_json(F.concat(*parts), "broken STRING", {**JSON_OPTIONS, "columnNameOfCorruptRecord": "broken"})["broken"].isNull()
    return c.isNotNull() & parses(F.lit('{"v":['), c, F.lit("]}")) & parses(F.lit('{"v":'), c, F.lit("}"))


def whole_struct(c: Column, fields: str) -> Column:
    """An object's text as a struct of `fields` (DDL); null for a text that is_json rejects or that is no object.

    One reading checks and parses: between two marks that the text cannot hold (its own digest), there must be exactly one element. Only a text
    in which that reading finds any error, as a field of another type is, is checked by is_json and read on its own."""
    schema = f"v ARRAY<STRUCT<{fields}, _mark: STRING>>, broken STRING"

    def read(digest: Column) -> Column:
        mark = F.concat(F.lit('{"_mark":"'), digest, F.lit('"}'))
        between = F.concat(F.lit('{"v":['), mark, F.lit(","), c, F.lit(","), mark, F.lit("]}"))
        return F.struct(digest.alias("digest"), F.from_json(between, schema, {**JSON_OPTIONS, "columnNameOfCorruptRecord": "broken"}).alias("r"))

    def settled(x: Column) -> Column:
        v = x["r"]["v"]
        marked = [F.coalesce(F.get(v, F.lit(at))["_mark"] == x["digest"], F.lit(False)) for at in (0, 2)]
        clean = x["r"]["broken"].isNull() & (F.size(v) == 3) & marked[0] & marked[1] & F.get(v, F.lit(1)).isNotNull()
        return F.when(clean, F.get(v, F.lit(1)).dropFields("_mark")).when(is_json(c) & c.rlike(r"\A\s*\{"), F.from_json(c, fields, JSON_OPTIONS))
    return F.get(F.transform(F.transform(F.array(F.md5(c)), read), settled), F.lit(0))

"""Extraction of code and documentation structures: Columns of arrays of structs, and their descriptions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .content import count_matches, line_count, trim
from .regex import engine


def _all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(engine(pattern)), F.lit(group))


def functions(code: Column) -> Column:
    """array<struct<doc, signature>> of functions after a block comment (which starts at the earliest that leads there)."""

    def one(m: Column) -> Column:
        end = F.locate("*/", m) + 1
        after = trim(F.substr(m, end + 1, F.length(m)))
        brace = F.locate("{", after)
        head = F.when(brace > 1, F.substr(after, F.lit(1), brace - 1)).otherwise(after)
        return F.struct(trim(F.substr(m, F.lit(1), end)).alias("doc"), F.concat(trim(head), F.lit(" { ... }")).alias("signature"))

    return F.transform(_all(code, fixed.FUNCTION), one)


def _property(line: Column) -> Column:
    p = engine(fixed.PROPERTY)
    return F.concat(F.regexp_extract(line, p, 1), F.regexp_extract(line, p, 2), F.lit(": "), F.regexp_extract(line, p, 3))


def properties(body: Column) -> Column:
    """``name: type`` of the members of a type's body that are simple ones."""
    lines = F.filter(F.transform(F.split(trim(body), "[;,\n]"), trim), lambda x: x != "")
    plain = F.filter(lines, lambda x: ~x.startswith("//") & ~x.startswith("/*") & ~x.startswith("[") & x.rlike(engine(fixed.PROPERTY)))
    return F.transform(plain, _property)


def describe_type(name: Column, definition: Column, extends: Column, props: Column) -> Column:
    n = F.size(props)
    kind = F.when(definition.startswith("export interface") | definition.startswith("interface"), "interface").otherwise("type alias")
    much = F.when(n == 0, F.lit("no properties")).otherwise(F.concat(n.cast("string"), F.when(n == 1, " property").otherwise(" properties")))
    return F.concat(
        F.lit("The `"), name, F.lit("` "), kind, F.lit(" defines "), much, F.lit("."),
        F.when((n > 0) & (n <= 8), F.concat(F.lit(" Properties: "), F.array_join(props, ", "), F.lit("."))).otherwise(""),
        F.when(extends != "", F.concat(F.lit(" The `"), name, F.lit("` extends `"), extends, F.lit("`."))).otherwise(""),
    )


def types(code: Column) -> Column:
    """array<struct<name, definition, description>> of types and interfaces with a body."""
    pattern = engine(fixed.TYPE)
    shaped = F.transform(
        _all(code, fixed.TYPE),
        # the groups are taken from the match, which is short, and not from the text again
        lambda m: F.struct(trim(m).alias("definition"), *[F.regexp_extract(m, pattern, g).alias(n) for g, n in ((1, "name"), (2, "extends"), (3, "body"))]),
    )

    def one(m: Column) -> Column:
        told = describe_type(m["name"], m["definition"], trim(m["extends"]), properties(m["body"]))
        return F.struct(m["name"].alias("name"), m["definition"].alias("definition"), told.alias("description"))

    return F.transform(shaped, one)


def error_contexts(code: Column) -> Column:
    """array<struct<message, context>> of suppressed type errors, contexts of 21 to 1999 characters."""
    parts = F.arrays_zip(_all(code, fixed.TS_ERROR, 1), _all(code, fixed.TS_ERROR, 2))
    shaped = F.transform(parts, lambda m: F.struct(F.when(m["0"] == "", fixed.DEFAULT_ERROR).otherwise(trim(m["0"])).alias("message"), trim(m["1"]).alias("context")))
    return F.filter(shaped, lambda m: (F.length(m["context"]) > 20) & (F.length(m["context"]) < 2000))


def test_blocks(code: Column) -> Column:
    return F.transform(F.filter(_all(code, fixed.TEST_BLOCK), lambda m: F.length(m) < 3000), trim)


def error_patterns(code: Column) -> Column:
    return F.transform(F.filter(_all(code, fixed.ERROR_PATTERN), lambda m: F.length(m) < 2000), trim)


def test_title(block: Column) -> Column:
    p = engine(fixed.TEST_TITLE)
    return F.when(block.rlike(p), trim(F.regexp_extract(block, p, 1))).otherwise(fixed.DEFAULT_TITLE)


def doc_summary(text: Column) -> Column:
    """The first heading, else a first sentence of 21 to 299 characters, else the first line over 10, else a constant."""
    head, para = engine(fixed.HEADING), engine(fixed.PARAGRAPH)
    sentence = trim(F.regexp_replace(F.regexp_extract(text, para, 0), "\n", " "))
    line = F.filter(F.transform(F.split(text, "\n"), trim), lambda x: F.length(x) > 10)
    return (
        F.when(text.rlike(head), F.concat(F.lit(fixed.HEADING_TEXT[0]), trim(F.regexp_extract(text, head, 1)), F.lit(fixed.HEADING_TEXT[1])))
        .when((F.length(sentence) > 20) & (F.length(sentence) < 300), F.concat(F.lit("Summary: "), sentence))
        .when(F.size(line) > 0, F.concat(F.lit("This document describes: "), F.get(line, F.lit(0))))
        .otherwise(fixed.NO_SUMMARY)
    )


def describe_error(message: Column, context: Column) -> Column:
    low = F.lower(message)
    first = F.coalesce(F.get(F.filter(F.transform(F.split(context, "\n"), trim), lambda x: x != ""), F.lit(0)), F.lit(""))

    def case(text: tuple[str, str, str, str]) -> Column:
        start, left, right, end = text
        return F.concat(F.lit(start), F.when(first != "", F.concat(F.lit(left), first, F.lit(right))).otherwise(""), F.lit(end))

    kind = (
        F.when(low.contains("assignable") | message.rlike(engine("(?i)type .* not assignable")), case(fixed.ERROR_ASSIGN))
        .when(low.contains("property") & low.contains("not exist") | low.contains("has no"), case(fixed.ERROR_PROPERTY))
        .when(low.contains("possibly 'undefined'") | low.contains("possibly undefined"), case(fixed.ERROR_UNDEFINED))
        .otherwise(fixed.ERROR_GENERAL)
    )
    return F.concat(F.lit(fixed.ERROR_START[0]), message, F.lit(fixed.ERROR_START[1]), kind)


def describe_handling(pattern: Column) -> Column:
    thrown, caught = engine(fixed.THROWN), engine(fixed.CAUGHT)
    var, kind, error = F.regexp_extract(pattern, caught, 1), F.regexp_extract(pattern, caught, 2), F.regexp_extract(pattern, thrown, 1)
    a, b, c = fixed.TRY_TYPED
    who = (
        F.when(kind != "", F.concat(F.lit(a), kind, F.lit(b), var, F.lit(c)))
        .when(var != "", F.concat(F.lit(fixed.TRY_ALL[0]), var, F.lit(fixed.TRY_ALL[1])))
        .otherwise(fixed.TRY_BARE)
    )
    tried = F.when(pattern.contains("try") & pattern.contains("catch"), F.concat(F.lit(fixed.TRY_START), who, F.lit(fixed.TRY_END))).otherwise("")
    what = F.when(error != "", F.concat(F.lit(fixed.THROW_TYPED[0]), error, F.lit(fixed.THROW_TYPED[1]))).otherwise(fixed.THROW_BARE)
    threw = F.when(pattern.contains("throw"), F.concat(what, F.lit(fixed.THROW_END))).otherwise("")
    both = F.concat(tried, threw)
    return F.when(both == "", fixed.NO_HANDLING).otherwise(both)


def code_counts(code: Column) -> dict[str, Column]:
    return {n: count_matches(code, p) for n, p in (("import", fixed.IMPORTS), ("export", fixed.EXPORTS), ("function", fixed.FUNCTIONS), ("class", fixed.CLASSES))}


def describe_file(code: Column, ext: Column) -> Column:
    counts = code_counts(code)
    told = [F.when(n > 0, F.concat(n.cast("string"), F.lit(f" {what}"), F.when(n != 1, "es" if what == "class" else "s").otherwise(""))) for what, n in counts.items()]
    some = F.concat_ws(", ", *told)
    return F.concat(
        F.lit("This "), F.when(ext.isin(".ts", ".tsx"), "TypeScript").otherwise("JavaScript"), F.lit(" file ("), line_count(code).cast("string"), F.lit(" lines) "),
        F.when(some != "", F.concat(F.lit("contains "), some, F.lit("."))).otherwise(fixed.NO_COUNTS),
    )

"""Predicates, measures and rewrites of file contents, as Column expressions."""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixed
from .regex import TRIM, engine

#: Secrets: our own choice of public shapes (which shapes to look for is not given anywhere), each with plain texts of
#: which one occurs wherever the shape does.
SECRET_SHAPES = [
    (r"AKIA[0-9A-Z]{16}", ["AKIA"]),
    (r"gh[pousr]_[A-Za-z0-9]{36,}", ["ghp_", "gho_", "ghu_", "ghs_", "ghr_"]),
    (r"xox[abprs]-[A-Za-z0-9-]{10,}", ["xox"]),
    (r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----", ["-----BEGIN "]),
    (r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}", ["eyJ"]),
    (r"""(?i:api_?key|secret|token|passw(?:or)?d)["']?[ \t]*[:=][ \t]*["'][A-Za-z0-9/+_=.-]{16,}["']""", ['"', "'"]),
]
SECRET = "|".join(shape for shape, _ in SECRET_SHAPES)
REDACTED = "[REDACTED]"


def license_of_text(text: Column) -> Column:
    """The first licence of which at least two keywords occur, else null."""
    low = F.lower(text)
    out: Column | None = None
    for name, words in fixed.LICENSE_KEYWORDS:
        hits = sum((low.contains(w).cast("int") for w in words), F.lit(0))
        out = F.when(hits >= 2, name) if out is None else out.when(hits >= 2, name)
    return out


def has_secret(text: Column) -> Column:
    """Does the text match a shape?  Plain searches come first, so few texts meet a pattern."""
    hits = [reduce(or_, (text.contains(h) for h in hints)) & text.rlike(shape) for shape, hints in SECRET_SHAPES]
    return reduce(or_, hits)


def redact_secrets(text: Column) -> Column:
    """Lines with a secret become a mark."""
    return F.when(has_secret(text), F.regexp_replace(text, rf"(?m)^[^\n]*(?:{SECRET})[^\n]*$", r"\[REDACTED\]")).otherwise(text)


def entropy_of(text: str | None) -> float | None:
    if not text:
        return None if text is None else 0.0
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


@F.pandas_udf(T.DoubleType())
def entropy(token: pd.Series) -> pd.Series:
    """Shannon entropy of a token in bits a character: no built-in expression has it.  Optional, for odd tokens."""
    return token.map(entropy_of)


def high_entropy_tokens(text: Column, least_length: int = 32) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"[A-Za-z0-9/+_=-]{{{least_length},}}"), F.lit(0))


def is_binary(content: Column) -> Column:
    """Does the first 8192 bytes hold a NUL, or are over 30 % of them control bytes?  Empty is text."""
    head = F.decode(F.substring(content, 1, 8192), "ISO-8859-1")
    odd = F.length(F.regexp_replace(head, r"[^\x00-\x08\x0B\x0C\x0E-\x1F]", ""))
    return F.coalesce((F.instr(head, "\0") > 0) | (odd > F.length(head) * 0.3), F.lit(False))


def trim(text: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(text, TRIM, "")


def is_blank(text: Column) -> Column:
    return trim(text) == ""


def line_count(text: Column) -> Column:
    return F.size(F.split(text, "\n", -1))


def truncated(text: Column, most: int, mark: str) -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit(mark))).otherwise(text)


def count_matches(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(engine(pattern)))


def date_part(stamp: Column) -> Column:
    return F.split(stamp, "T")[0]


def format_size(n: Column) -> Column:
    """1.23 GB, 4.5 MB, 6 KB, 7 B; the limits are exclusive."""
    return (
        F.when(n > 1 << 30, F.format_string("%.2f GB", n / float(1 << 30)))
        .when(n > 1 << 20, F.format_string("%.1f MB", n / float(1 << 20)))
        .when(n > 1 << 10, F.format_string("%.0f KB", n / float(1 << 10)))
        .otherwise(F.format_string("%d B", n))
    )


def format_count(n: Column) -> Column:
    return F.format_number(n, 0)


def percent(part: Column, whole: Column) -> Column:
    """100 part / whole as a raw double; null for an empty whole."""
    return F.try_divide(part * 100.0, whole.cast("double"))


def clean_doc(comment: Column) -> Column:
    """The text of a block comment without its fences and leading stars."""
    bare = F.regexp_replace(comment, r"^/\*\*|\*/\z", "")
    return trim(F.regexp_replace(bare, engine(r"(?m)^\s*\*\s?"), ""))



"""Predicates and names of paths, as Column expressions over a slash-separated path."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .regex import glob


def _any(values: list[str]) -> str:
    return "|".join(re.escape(x) for x in values)


def slashes(path: Column) -> Column:
    return F.translate(path, "\\", "/")


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extname(path: Column) -> Column:
    """The lower-cased extension with its dot; empty if there is none or the only dot leads the name."""
    return F.lower(F.regexp_extract(basename(path), r"(?s)^.+(\.[^.]*)$", 1))


def path_excluded(path: Column, patterns: list[str]) -> Column:
    """Does the path, or a part of it, match one of the globs?  One pattern over all globs."""
    forms = []
    for p in patterns:
        forms += [glob(p, base=True), glob("**/" + p), glob("**/" + p + "/**")]
    return path.rlike("|".join(f"(?:{x})" for x in forms)) if forms else F.lit(False)


def extension_allowed(path: Column, blocked: list[str]) -> Column:
    return ~extname(path).isin(blocked) if blocked else F.lit(True)


def language_extension_allowed(path: Column, languages: list[str] | None, compat: bool = False) -> Column:
    """Is the extension's language among the allowed ones?  Unknown extensions pass, and all without a list.

    C++ and C# mean cpp and csharp; with compat they are taken literally and match no extension.
    """
    if not languages:
        return F.lit(True)
    wanted = {x.lower() for x in languages}
    wanted |= set() if compat else {fixed.LANGUAGE_ALIASES.get(x, x) for x in wanted}
    denied = [e for e, lang in fixed.EXTENSION_LANGUAGE.items() if lang not in wanted]
    return ~extname(path).isin(denied)


def size_allowed(size: Column, max_kb: int) -> Column:
    return size <= max_kb * 1024


def _name_hit(path: Column, pattern: str) -> Column:
    name = basename(path)
    return name.endswith(pattern[1:]) if pattern.startswith("*.") else name == pattern


def _in_dir(path: Column, name: str) -> Column:
    return (path == name) | path.startswith(name + "/") | path.contains(f"/{name}/")


def remove_reason(path: Column, debug: bool = False) -> Column:
    """Why the filter stage removes a path, null if it stays: directories, then names, then (not in debug) tests."""
    path = slashes(path)
    out: Column | None = None
    for test, reason in [
        *((_in_dir(path, d), f"path: {d}") for d in fixed.REMOVED_DIRS),
        *((_name_hit(path, n), f"{'pattern' if n.startswith('*.') else 'file'}: {n}") for n in fixed.REMOVED_NAMES),
        *((_in_dir(path, d), f"excluded path: {d}") for d in ([] if debug else fixed.TEST_DIRS)),
    ]:
        out = F.when(test, reason) if out is None else out.when(test, reason)
    return out


def removed(path: Column, debug: bool = False) -> Column:
    """remove_reason is not null, as two patterns."""
    path = slashes(path)
    dirs = fixed.REMOVED_DIRS + ([] if debug else fixed.TEST_DIRS)
    stars = [x[1:] for x in fixed.REMOVED_NAMES if x.startswith("*.")]
    plain = [x for x in fixed.REMOVED_NAMES if not x.startswith("*.")]
    return path.rlike(f"(?:^|/)(?:{_any(dirs)})/") | path.isin(dirs) | path.rlike(f"(?:{_any(stars)})$|(?:^|/)(?:{_any(plain)})$")


def pruned(path: Column, debug: bool = False) -> Column:
    """Is an ancestor directory below the first level removed as such?  path starts with the repository's directory."""
    path = slashes(path)
    dirs = fixed.REMOVED_DIRS + ([] if debug else fixed.TEST_DIRS)
    stars = [x[1:] for x in fixed.REMOVED_NAMES if x.startswith("*.")]
    plain = [x for x in fixed.REMOVED_NAMES if not x.startswith("*.")]
    return path.rlike(f"/(?:{_any(dirs)})/[^/]+/") | path.rlike(f"(?:{_any(stars)})/|/(?:{_any(plain)})/")


def kept_extension(path: Column) -> Column:
    return extname(path).isin(fixed.KEPT_EXTENSIONS)


def doc_extension(path: Column) -> Column:
    return extname(path).isin(fixed.DOC_EXTENSIONS)


def generated_path(path: Column) -> Column:
    path = slashes(path)
    return path.rlike(f"(?:^|/)(?:{_any(fixed.GENERATED_DIRS)})/") | path.rlike(f"(?:{_any(fixed.GENERATED_ENDINGS)})$")


def test_path(path: Column) -> Column:
    return slashes(path).rlike(_any(fixed.TEST_PARTS))


def doc_path(path: Column) -> Column:
    return slashes(path).rlike(_any(fixed.DOC_PARTS))


def code_test_path(path: Column) -> Column:
    path = slashes(path)
    return path.rlike(_any(fixed.CODE_TEST_PARTS)) | path.rlike(f"(?:{_any(fixed.CODE_TEST_ENDINGS)})$")


def category(path: Column) -> Column:
    """generated, source, test, docs, config or other."""
    ext = extname(path)
    return (
        F.when(generated_path(path), "generated")
        .when(ext.isin(fixed.CODE_EXTENSIONS), F.when(test_path(path), "test").otherwise("source"))
        .when(ext.isin(fixed.PROSE_EXTENSIONS), F.when(doc_path(path), "docs").when(test_path(path), "test").otherwise("source"))
        .when(ext.isin(fixed.CONFIG_EXTENSIONS), "config")
        .when(ext.isin(fixed.STYLE_EXTENSIONS), "source")
        .otherwise("other")
    )


def language_group(ext: Column) -> Column:
    out = None
    for name, own in fixed.LANGUAGE_GROUPS.items():
        out = F.when(ext.isin(own), name) if out is None else out.when(ext.isin(own), name)
    return out.otherwise("Other")


def decode_repo(directory: Column) -> Column:
    """owner__repo as owner/repo: the first double underscore."""
    return F.regexp_replace(directory, r"(?s)^(.*?)__", "$1/")


def encode_repo(full_name: Column) -> Column:
    return F.regexp_replace(full_name, r"(?s)^([^/]*)/", "$1__")

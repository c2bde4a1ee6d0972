"""Patterns with JavaScript's white space and dot, written for Java (Spark) or RE2 (DuckDB)."""

from __future__ import annotations

import re

_JAVA = r"\t-\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"


def engine(pattern: str) -> str:
    """Replace ``\\s`` and ``.``; both engines read the outcome alike."""
    out, inside, i = [], False, 0
    pattern = pattern.replace(r"[\s\S]", "\0")
    while i < len(pattern):
        two = pattern[i : i + 2]
        if two == r"\s":
            out.append(_JAVA if inside else f"[{_JAVA}]")
            i += 2
            continue
        if two[0] == "\\":
            out.append(two)
            i += 2
            continue
        c = pattern[i]
        if c == "." and not inside:
            c = r"[^\n\r\x{2028}\x{2029}]"
        elif c == "\0":
            c = r"(?s:.)"
        elif c == "[" and not inside:
            inside = True
        elif c == "]" and inside:
            inside = False
        out.append(c)
        i += 1
    return "".join(out)


SPACE = engine(r"\s")
TRIM = f"^{SPACE}+|{SPACE}+$".replace("$", r"\z")


def glob(pattern: str, base: bool = False) -> str:
    """A path glob as an anchored pattern: ``* ** ? [] {}``, extended forms ``@ ? * + !`` with ``(a|b)``, a leading ``!``
    for all that does not match; ``#`` begins a comment, which matches nothing.  Dot files match.  With base a pattern without a slash is for a path's last part."""
    if pattern[:1] == "#":
        return r"[^\s\S]"
    body = pattern.lstrip("!") if not pattern.startswith("!(") else pattern
    form = ("(?:.*/)?" if base and "/" not in body else "") + _segments(body)
    return rf"^(?!{form}$)[\s\S]*$" if (len(pattern) - len(body)) % 2 else f"^{form}$"


def _segments(pattern: str) -> str:
    parts, out = pattern.split("/"), ""
    for k, part in enumerate(parts):
        last = k == len(parts) - 1
        if part == "**":
            out += "(?:[^/]+(?:/[^/]+)*)?" if last else "(?:[^/]+/)*"
        else:
            out += _segment(part) + ("" if last else "/")
    return out


def _segment(part: str) -> str:
    out, i, depth = "", 0, 0
    while i < len(part):
        c = part[i]
        end = _closing(part, i + 1) if c in "@?*+!" and part[i + 1 : i + 2] == "(" else -1
        if end > 0:
            inner = "|".join(_segment(x) for x in _alternatives(part[i + 2 : end]))
            if c == "!":  # what is not one of them before the rest of the part
                rest = _segment(part[end + 1 :])
                return f"{out}(?!(?:{inner}){rest}(?:/|$))[^/]*?{rest}"
            out += f"(?:{inner})" + ("" if c == "@" else c)
            i = end
        elif c == "*":
            out += "[^/]+" if part == "*" else "[^/]*"
            while part[i + 1 : i + 2] == "*":
                i += 1
        elif c == "?":
            out += "[^/]"
        elif c == "[" and "]" in part[i + 1 :]:
            end = part.index("]", i + 2) if part[i + 1] == "]" else part.index("]", i + 1)
            body = part[i + 1 : end]
            out += "[" + ("^" + body[1:] if body[:1] in "!^" else body).replace("\\", "\\\\") + "]"
            i = end
        elif c == "{" and "}" in part[i:] and "," in part[i : part.index("}", i)]:
            out, depth = out + "(?:", depth + 1
        elif c == "}" and depth:
            out, depth = out + ")", depth - 1
        elif c == "," and depth:
            out += "|"
        else:
            out += re.escape(c)
        i += 1
    return out


def _closing(part: str, at: int) -> int:
    """The place of the bracket that closes the one at ``at``, -1 without one."""
    depth = 0
    for k in range(at, len(part)):
        depth += {"(": 1, ")": -1}.get(part[k], 0)
        if depth == 0:
            return k
    return -1


def _alternatives(inner: str) -> list[str]:
    out, depth = [""], 0
    for c in inner:
        depth += {"(": 1, ")": -1}.get(c, 0)
        if c == "|" and not depth:
            out.append("")
        else:
            out[-1] += c
    return out

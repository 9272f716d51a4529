"""Matching on analysed text, as native column expressions.

A token is a maximal run of letters and digits of the lower-cased text. Matching
asks for a run with no letter or digit on either side, which is the same as
splitting into tokens and comparing them, without building an array per row.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token alphabet.
TOKEN_CHAR = r"[\p{L}\p{N}]"
NON_TOKEN_RUN = r"[^\p{L}\p{N}]+"

_START = rf"(?<!{TOKEN_CHAR})"
_END = rf"(?!{TOKEN_CHAR})"


def tokens(text: Column) -> Column:
    """All tokens of ``text`` in order, lower-cased."""
    return F.filter(F.split(F.lower(text), NON_TOKEN_RUN), lambda t: t != "")


def normalized(value: Column) -> Column:
    """A keyword with case and outer blanks removed."""
    return F.lower(F.trim(value))


def matches_normalized(value: Column, wanted: str) -> Column:
    return normalized(value) == normalized(F.lit(wanted))


def _is_token_char(ch: str) -> bool:
    return unicodedata.category(ch)[0] in "LN"


def query_tokens(query: str) -> list[str]:
    words = "".join(ch if _is_token_char(ch) else " " for ch in query.lower()).split(" ")
    return list(dict.fromkeys(w for w in words if w))


def matches_any_token(text: Column, query: str) -> Column:
    """True where any token of ``query`` is a token of ``text``."""
    words = query_tokens(query)
    if not words:
        return F.lit(False)
    low = F.lower(text)
    present = F.lit(False)
    for word in words:
        present = present | F.contains(low, F.lit(word))
    # The substring test is cheap and rejects most rows before the pattern runs.
    return present & low.rlike("|".join(_starting_with(word) + _END for word in words))


def _starting_with(letters: str) -> str:
    """A pattern for ``letters`` at the start of a token; letters first is what the matcher finds fastest."""
    return f"{letters}(?<!{TOKEN_CHAR}{letters})"


def parse_wildcard(pattern: str) -> list[tuple[str, bool]]:
    """(character, is_wildcard) pairs; a backslash makes the next character literal."""
    parts = []
    chars = iter(pattern)
    for ch in chars:
        if ch == "\\":
            parts.append((next(chars, "\\"), False))
        else:
            parts.append((ch, ch in "*?"))
    return parts


def matches_wildcard(text: Column, pattern: str) -> Column:
    """True where some token matches ``pattern``: ``*`` any run, ``?`` one character.

    A pattern without an unescaped wildcard is ordinary analysed text.
    """
    parts = parse_wildcard(pattern.lower())
    if not any(wild for _, wild in parts):
        return matches_any_token(text, "".join(ch for ch, _ in parts))
    if any(not wild and not _is_token_char(ch) for ch, wild in parts):
        return F.lit(False)  # no token holds such a character
    low = F.lower(text)
    runs = "".join("\0" if wild else ch for ch, wild in parts).split("\0")
    core = list(parts)
    # A token goes on as far as it can, so an outer star only means that the end is open.
    while core and core[0] == ("*", True):
        core.pop(0)
    while core and core[-1] == ("*", True):
        core.pop()
    open_start, open_end = parts[0] == ("*", True), parts[-1] == ("*", True)
    if not core:
        return low.rlike(TOKEN_CHAR)
    body = "".join({"*": f"{TOKEN_CHAR}*", "?": TOKEN_CHAR}[ch] if wild else ch for ch, wild in core)
    if open_start:
        start = ""
    elif runs[0]:
        start, body = _starting_with(runs[0]), body[len(runs[0]):]
    else:
        start = _START
    matched = low.rlike(f"{start}{body}{'' if open_end else _END}")
    longest = max(runs, key=len)
    return F.contains(low, F.lit(longest)) & matched if longest else matched

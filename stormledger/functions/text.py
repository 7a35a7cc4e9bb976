"""Text cleaning as Column expressions."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable, Iterable
from functools import cache, reduce
from operator import or_

from pyspark.sql import Column, functions as F

from stormledger.functions.columns import let
from stormledger.functions.matching import quote

# white space as a Unicode-aware scripting language sees it
WS = r"[\s\x1c-\x1f]"
NOT_WS = r"[^\s\x1c-\x1f]"

# Patterns of the cleaning stages
# patterns begin with a class of characters where they can: most places of a text fail at once
URL_PATTERN = rf"(?U)[hw](?:(?<=h)ttps?://{NOT_WS}+|(?<=w)ww\.{NOT_WS}+)"
# an opening that nothing closes is matched too, and put back: else every "<" would scan on from there
TAG_PATTERN = r"(<[^>\n]*+)(?!>)|<[^>\n]*+>"
ENTITY_PATTERN = r"(?U)&\w+;"
SEPARATOR_PATTERN = r"[-=*_][-=*_]{2,}+"
# possessive: a group repeated greedily would take one stack frame per repetition
DOT_RUN_PATTERN = rf"(?U)\.(?:{WS}*+\.){{2,}}+{WS}*+"
# every run of white space but a single space
WS_RUN_PATTERN = rf"(?U){WS}(?:{WS}++|(?<! ))"
NON_ASCII_PATTERN = r"[^\x00-\x7F]"
NON_ASCII_RUN_PATTERN = rf"{NON_ASCII_PATTERN}++"
BOILERPLATE = ("shared a post", "see more", "commented", "replied")
BOILERPLATE_PATTERN = "(?i)[scr](?:(?<=s)(?:hared a post|ee more)|(?<=c)ommented|(?<=r)eplied)"
PLACEHOLDER_PATTERN = rf"(?iU)\A{WS}*(?:nan|none)?{WS}*\z"
ONLY_NUMBERS_PATTERN = r"\A[0-9:/.\-\s\x1c-\x1f]{6,}\z"
MIN_CLEAN_CHARS = 90


@cache
def _folded_characters() -> tuple[str, str, dict[str, str]]:
    """Characters that fold to one other or to none, what they fold to, and those that fold to several."""
    one, none, many = {}, [], {}
    for char in map(chr, (*range(0x80, 0xD800), *range(0xE000, sys.maxunicode + 1))):
        folded = "".join([c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)])
        if not folded:
            none.append(char)
        elif len(folded) > 1:
            many[char] = folded
        elif folded != char:
            one[char] = folded
    return "".join([*one, *none]), "".join(one.values()), many


def _ranges(chars: Iterable[str]) -> str:
    """Character class of sorted characters."""
    runs: list[list[int]] = []
    for code in map(ord, chars):
        if runs and code == runs[-1][1] + 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "[" + "".join(rf"\x{{{first:x}}}-\x{{{last:x}}}" for first, last in runs) + "]"


def _where(col: Column, test: Callable[[Column], Column], change: Callable[[Column], Column]) -> Column:
    """``change`` of the texts that pass ``test``, a cheap one that every text to be changed passes."""
    return let(col, lambda text: F.when(test(text), change(text)).otherwise(text))


def _holds(*parts: str) -> Callable[[Column], Column]:
    """Texts with any of the parts."""
    return lambda text: reduce(or_, [F.contains(text, F.lit(p)) for p in parts])


def _beyond_ascii(text: Column) -> Column:
    """Texts that have more bytes than characters, or bytes that are no characters."""
    return (F.octet_length(text) > F.char_length(text)) | ~F.is_valid_utf8(text)


def fold_unicode(col: Column) -> Column:
    """Compatibility-decompose and drop combining marks.

    Spark has no normalisation function, but each character folds by itself, as the order of
    marks no longer matters once they are gone. So texts stay in the JVM: whole rows that wait for
    a Python worker's batch would go to disk. Only the runs of characters beyond ASCII are
    looked up, all runs of a text as lines of one; no character folds to a line's end.
    """
    single, to, many = _folded_characters()
    pattern, listed = _ranges(many), F.split(F.lit("\n".join(many.values())), "\n")

    def spelled(text: Column) -> Column:
        left = F.filter(F.array_distinct(F.regexp_extract_all(text, F.lit(NON_ASCII_PATTERN), F.lit(0))), lambda c: c.rlike(pattern))
        return F.aggregate(left, text, lambda out, c: F.replace(out, c, F.get(listed, F.instr(F.lit("".join(many)), c) - 1)))

    def folded(text: Column) -> Column:
        runs = F.array_join(F.regexp_extract_all(text, F.lit(NON_ASCII_RUN_PATTERN), F.lit(0)), "\n")
        # the text between the runs has one part more than there are runs
        return F.array_join(F.zip_with(
            F.split(text, NON_ASCII_RUN_PATTERN), F.split(let(F.translate(runs, single, to), spelled), "\n"),
            lambda plain, run: F.concat(plain, F.coalesce(run, F.lit(""))),
        ), "")

    return _where(col, _beyond_ascii, folded)


def blank_placeholders(col: Column) -> Column:
    return F.coalesce(F.regexp_replace(col, PLACEHOLDER_PATTERN, ""), F.lit(""))


def strip_urls(col: Column) -> Column:
    return _where(col, _holds("http", "www."), lambda text: F.regexp_replace(text, URL_PATTERN, ""))


def strip_tags(col: Column) -> Column:
    return _where(col, _holds(">"), lambda text: F.regexp_replace(text, TAG_PATTERN, "$1"))


def strip_entities(col: Column) -> Column:
    return _where(col, _holds("&"), lambda text: F.regexp_replace(text, ENTITY_PATTERN, ""))


def blank_separators(col: Column) -> Column:
    return _where(col, _holds(*"-=*_"), lambda text: F.regexp_replace(text, SEPARATOR_PATTERN, " "))


def blank_dot_runs(col: Column) -> Column:
    return _where(col, _holds("."), lambda text: F.regexp_replace(text, DOT_RUN_PATTERN, " "))


def drop_non_ascii(col: Column) -> Column:
    return _where(col, _beyond_ascii, lambda text: F.regexp_replace(text, NON_ASCII_RUN_PATTERN, ""))


def collapse_ws(col: Column) -> Column:
    """White-space runs become one space, none at the ends."""
    return F.trim(F.regexp_replace(col, WS_RUN_PATTERN, " "))


def strip_ends(col: Column) -> Column:
    return F.regexp_replace(col, rf"(?U)\A{WS}+|{WS}+\z", "")


def collapse_lower(col: Column) -> Column:
    return F.lower(collapse_ws(col))


def strip_boilerplate(col: Column) -> Column:
    held = lambda text: let(F.lower(text), _holds(*BOILERPLATE))
    return _where(col, held, lambda text: F.regexp_replace(text, BOILERPLATE_PATTERN, ""))


# The gates replace a whole rejected text, so they read their input once; a
# conditional would repeat the chain of stages in every branch.
def quality_gate(col: Column, min_len: int = MIN_CLEAN_CHARS) -> Column:
    """Too short, or nothing but dots and spaces, becomes ``""``."""
    return F.regexp_replace(col, rf"(?s)\A(?:.{{0,{max(min_len - 1, 0)}}}|[. ]+)\z", "")


def numeric_gate(col: Column) -> Column:
    return F.regexp_replace(col, ONLY_NUMBERS_PATTERN, "")


def clean_text(col: Column, min_len: int = MIN_CLEAN_CHARS) -> Column:
    """All cleaning stages in order; rejected texts become ``""``."""
    stages = (
        blank_placeholders, fold_unicode, strip_urls, strip_tags, strip_entities,
        blank_separators, blank_dot_runs, drop_non_ascii, collapse_lower, strip_boilerplate,
    )
    cleaned = reduce(lambda c, stage: stage(c), stages, col)
    return numeric_gate(quality_gate(cleaned, min_len))


def norm(col: Column) -> Column:
    """Lower case, one space between words."""
    return collapse_ws(F.lower(col))


def is_blank(col: Column) -> Column:
    return col.isNull() | col.rlike(rf"(?U)\A{WS}*\z")


def words(col: Column) -> Column:
    """Array of white-space separated words, without empty ones."""
    return F.filter(F.split(col, rf"(?U){WS}+"), lambda w: w != "")


def page_handle(url: Column, hosts: tuple[str, ...]) -> Column:
    """``#tag`` of a hashtag URL, else the raw page handle, else null.

    The host is not anchored, so any host ending in one of ``hosts`` counts.
    """
    host = "(?:" + "|".join(quote(h) for h in hosts) + ")"
    part = r"([^/?#\s\x1c-\x1f]+)"
    tag = F.regexp_extract(url, rf"(?U){host}/hashtag/{part}", 1)
    page = F.regexp_extract(url, rf"(?U){host}/(?!hashtag|watch|reel){part}", 1)
    bare = F.regexp_replace(F.lower(page), r"\A[.@/]+|[.@/]+\z", "")
    return (
        F.when(tag != "", F.concat(F.lit("#"), F.lower(tag)))
        .when(page != "", bare)
    )

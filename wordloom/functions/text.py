"""Scalar text functions as plain ``Column -> Column`` builders.

Everything here compiles to built-in Spark expressions (regexp, translate,
transform, ...) so it stays inside whole-stage codegen; no Python UDF.

Unicode folding: Spark has no NFD normaliser, so the fold tables are derived
once, at import, from :mod:`unicodedata` by a rule (decompose, drop marks) and
applied with ``translate``.
"""

from __future__ import annotations

import functools
import unicodedata
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (  # noqa: F401  (re-exported fixed values)
    ARTICLE_MARKER, EN_DASH, EXAMPLES_PER_WORD, FILENAME_FORBIDDEN, HEBREW_BLOCK, HEBREW_LETTERS, LRM, NO_RESULTS_TEXT,
)

# Python's str.isspace() set, written as a regex class that Java and RE2 both
# read the same way (Spark's trim only removes spaces).
WS_CLASS = (r"[\t\n\x0B\x0C\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
# Python str.splitlines() boundaries.
LINE_BREAK = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]"


def _marks_removed(s: str, by_category: bool) -> str:
    if by_category:
        return "".join(c for c in s if not unicodedata.category(c).startswith("M"))
    return "".join(c for c in s if not unicodedata.combining(c))


@functools.lru_cache(maxsize=None)
def fold_table(letters_only: bool, by_category: bool,
               keep_lo: int = 0, keep_hi: int = 0x10FFFF) -> tuple[str, str]:
    """(from, to) strings for ``translate``: every code point whose canonical
    decomposition, marks dropped, is one *other* character inside
    ``[keep_lo, keep_hi]``. Built from the Unicode database by rule."""
    src, dst = [], []
    for cp in range(0x00C0, 0x30000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        c = chr(cp)
        if letters_only and not unicodedata.category(c).startswith("L"):
            continue
        d = unicodedata.normalize("NFD", c)
        if d == c:
            continue
        base = _marks_removed(d, by_category)
        if len(base) == 1 and base != c and keep_lo <= ord(base) <= keep_hi:
            src.append(c)
            dst.append(base)
    return "".join(src), "".join(dst)


@dataclass(frozen=True)
class ScriptProfile:
    """Script-specific patterns. The reference works on Hebrew; the driver
    tables hold Latin-script prose, so both profiles share every operator."""

    name: str
    token: str            # Java regex of one token (a run of one character class)
    separator: str        # regex of a run of non-token characters
    letter_drop: str      # regex of chars removed by fold (after translate)
    clean_drop: str       # regex of chars removed by clean_word
    has_script: str       # regex: text contains the script
    letter: str           # regex of one letter of the script
    fold_map: tuple[str, str]
    clean_map: tuple[str, str]


def _combining_class_in(lo: int, hi: int) -> str:
    """Regex class of code points in [lo, hi] with a non-zero combining class."""
    cps = [cp for cp in range(lo, hi + 1) if unicodedata.combining(chr(cp))]
    # collapse into ranges
    parts, start, prev = [], None, None
    for cp in cps:
        if start is None:
            start = prev = cp
        elif cp == prev + 1:
            prev = cp
        else:
            parts.append((start, prev))
            start = prev = cp
    if start is not None:
        parts.append((start, prev))
    body = "".join(f"\\x{{{a:X}}}" if a == b else f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in parts)
    return f"[{body}]"


@functools.lru_cache(maxsize=None)
def hebrew() -> ScriptProfile:
    heb_map = fold_table(False, False, 0x0590, 0x05FF)
    block, letters = "-".join(HEBREW_BLOCK), "-".join(HEBREW_LETTERS)
    return ScriptProfile(
        name="hebrew",
        token=f"[{block}]+",
        separator=f"[^{block}]+",
        letter_drop=f"[^{letters}]",
        clean_drop=f"[^{block}]|" + _combining_class_in(0x0590, 0x05FF),
        has_script=f"[{block}]",
        letter=f"[{block}]",
        fold_map=heb_map,
        clean_map=heb_map,
    )


@functools.lru_cache(maxsize=None)
def latin() -> ScriptProfile:
    m = fold_table(True, True)
    return ScriptProfile(
        name="latin",
        token=r"\p{L}+",
        separator=r"\P{L}+",
        letter_drop=r"\P{L}",
        clean_drop=r"\P{L}",
        has_script=r"[^\x00-\x7F]",
        letter=r"\p{L}",
        fold_map=m,
        clean_map=m,
    )


def profile(name: str | ScriptProfile) -> ScriptProfile:
    if isinstance(name, ScriptProfile):
        return name
    return {"hebrew": hebrew, "latin": latin}[name]()


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------------------
# Tokenise and fold
# ---------------------------------------------------------------------------
def tokens(text, prof="hebrew") -> Column:
    """All maximal runs of the script's token class (array<string>).
    Computed as a split on runs of the complement class with empty pieces
    dropped — the same tokens as ``regexp_extract_all(token)``, ~30% cheaper."""
    return F.filter(F.split(_c(text), profile(prof).separator), lambda t: t != F.lit(""))


def fold(word, prof="hebrew") -> Column:
    """T1 strip_niqqud: canonical decomposition, marks dropped, only base
    letters kept. Empty string when nothing is left (not NULL)."""
    p = profile(prof)
    src, dst = p.fold_map
    return F.regexp_replace(F.translate(_c(word), src, dst), p.letter_drop, "")


def clean_word(word, prof="hebrew") -> Column:
    """T2 clean_word: like fold but keeps the whole script block (maqaf,
    geresh, ...); empty → NULL."""
    p = profile(prof)
    src, dst = p.clean_map
    return F.nullif(F.regexp_replace(F.translate(_c(word), src, dst), p.clean_drop, ""), F.lit(""))


def has_script(text, prof="hebrew") -> Column:
    """F1 contains-script predicate (NULL text → false)."""
    return F.coalesce(_c(text).rlike(profile(prof).has_script), F.lit(False))


# ---------------------------------------------------------------------------
# Cleaning helpers
# ---------------------------------------------------------------------------
# The same set as literal characters, for ``btrim`` (no regex engine).
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
            + "\u2028\u2029\u202f\u205f\u3000")


def strip(x) -> Column:
    """T11 Python ``str.strip()``: remove leading/trailing Unicode whitespace
    (``btrim`` with the whitespace set: a character scan, not a regex)."""
    return F.btrim(_c(x), F.lit(WS_CHARS))


def split_lines(x) -> Column:
    """T9 Python ``splitlines`` (a trailing empty piece may remain; callers
    drop empty lines as the reference does)."""
    return F.split(_c(x), LINE_BREAK)


def remove_brackets(x, multiline: bool = True) -> Column:
    """T5 drop ``[...]`` (lazily); across lines when ``multiline``."""
    c = _c(x)
    pat = r"(?s)\[.*?\]" if multiline else r"\[[^\n]*?\]"
    return F.when(F.instr(c, "[") > 0, F.regexp_replace(c, pat, "")).otherwise(c)


def remove_lrm(x) -> Column:
    """T6a remove U+200E."""
    return F.translate(_c(x), LRM, "")


def remove_bidi_embedding(x) -> Column:
    """T6b remove U+202A-202E."""
    return F.regexp_replace(_c(x), r"[\x{202A}-\x{202E}]", "")


def collapse_blank_lines(x) -> Column:
    """T7 blank-line runs → one empty line, then strip."""
    return strip(F.regexp_replace(_c(x), r"\n" + WS_CLASS + r"*\n", "\n\n"))


# T8 pattern: Python's \w / \s are Unicode-aware, Java's and RE2's are not, so
# the classes are spelled out: \w = letters, numbers, '_' (marks excluded).
_WS_BODY = WS_CLASS[1:-1]
TRAILING_ARTIST = (WS_CLASS + r"*[-–]" + WS_CLASS + r"*[\p{L}\p{N}_" + _WS_BODY
                   + r"'״&]+$")


def strip_trailing_artist(line) -> Column:
    """T8 remove a trailing `` - Artist`` (applied to every line; the regex
    only runs on lines holding a hyphen or en dash)."""
    c = _c(line)
    has_dash = (F.instr(c, "-") > 0) | (F.instr(c, EN_DASH) > 0)
    return F.when(has_dash, F.regexp_replace(c, TRAILING_ARTIST, "")).otherwise(c)


def strip_em(x) -> Column:
    """T10 ``clean``: remove <em> tags, strip, empty → NULL."""
    return F.nullif(strip(F.regexp_replace(_c(x), "</?em>", "")), F.lit(""))


def join_pieces(arr) -> Column:
    """T12 join_transcription: concatenate stripped pieces."""
    return strip(F.array_join(F.transform(_c(arr), lambda v: strip(v)), ""))


def normalize_dash(x) -> Column:
    """T13 en dash → hyphen, then strip."""
    return strip(F.translate(_c(x), EN_DASH, "-"))


def join_nonempty(arr, sep: str = " ") -> Column:
    """T14 join stripped, non-empty parts with ``sep``."""
    stripped = F.transform(_c(arr), lambda v: strip(v))
    return F.array_join(F.filter(stripped, lambda v: v != F.lit("")), sep)


def sanitize_filename(x) -> Column:
    """T15 remove characters not allowed in file names."""
    return F.translate(_c(x), FILENAME_FORBIDDEN, "")


def absolute_url(base: str, href) -> Column:
    """T16 prefix a site-relative href; '' when there is none."""
    h = _c(href)
    return F.when(h.isNull() | (h == ""), F.lit("")).otherwise(F.concat(F.lit(base), h))


def date_cut(ts_text) -> Column:
    """T17 ISO timestamp text → DATE of its first 10 characters."""
    return F.to_date(F.substring(_c(ts_text), 1, 10))


def int_or_one(x) -> Column:
    """T18 span attribute → int, default 1."""
    return F.coalesce(_c(x).try_cast("int"), F.lit(1))


def text_before(x, marker: str) -> Column:
    """T19 text before the first occurrence of ``marker`` (whole text if absent)."""
    return F.substring_index(_c(x), marker, 1)


def first_nonempty(arr) -> Column:
    """TakeFirst: first element that is neither NULL nor ''."""
    return F.get(F.filter(_c(arr), lambda v: v.isNotNull() & (v != F.lit(""))), 0)


def field_pipeline(arr, steps, reducer=first_nonempty) -> Column:
    """§2.12 MapCompose + reducer: map every value through ``steps`` (Column
    functions), drop NULLs, reduce (default: first non-empty)."""
    out = _c(arr)
    for step in steps:
        out = F.transform(out, step)
    out = F.filter(out, lambda v: v.isNotNull())
    return reducer(out)


def default(x, value: str = "") -> Column:
    """T21 ``dict.get(k, default)``."""
    return F.coalesce(_c(x), F.lit(value))


def html_escape(x) -> Column:
    """Escape ``& < > "`` for embedding text in generated HTML."""
    c = _c(x)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c

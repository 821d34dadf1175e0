"""Scalar functions (T1-T21) against plain-Python statements of the rules."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from wordloom.functions import text as T


HEBREW_CASES = [   # word, folded, cleaned
    ('חֶבְרָה', 'חברה', 'חברה'),
    ('חֲבֵרָה', 'חברה', 'חברה'),
    ('חִבְּרָה', 'חברה', 'חברה'),
    ('חַבְרַת־', 'חברת', 'חברת־'),
    ('צַהַ״ל', 'צהל', 'צה״ל'),
    ('צה״ל', 'צהל', 'צה״ל'),
    ('שָׁלוֹם', 'שלום', 'שלום'),
    ('יִשְׂרָאֵל', 'ישראל', 'ישראל'),
    ('שׁשׂוֹ', 'ששו', 'ששו'),
    ('יִײַﬠ', 'י', 'יײ'),
    ('a-b', '', None),
    ('׳גֶּשֶׁר׳', 'גשר', '׳גשר׳'),
    ('׀׃׆', '', '׀׃׆'),
    ('', '', None),
    ('abc', '', None),
    ('שלום ', 'שלום', 'שלום'),
    ('וַיֹּאמֶר֙', 'ויאמר', 'ויאמר'),
    ('ﭏ', '', None),
    ('מִלָּה־מִלָּה', 'מלהמלה', 'מלה־מלה'),
]


def test_fold_and_clean_of_hebrew_words(spark):
    df = spark.createDataFrame([(w,) for w, _, _ in HEBREW_CASES], "w string")
    got = {r.w: (r.f, r.c) for r in df.select("w", T.fold("w").alias("f"), T.clean_word("w").alias("c")).collect()}
    assert got == {w: (f, c) for w, f, c in HEBREW_CASES}


def test_hebrew_fold_table_is_complete():
    """Every code point whose decomposition (marks dropped) yields a Hebrew
    character is in the translate table, with the same single result."""
    src, dst = T.hebrew().fold_map
    table = dict(zip(src, dst))
    for cp in range(0x110000):
        if 0xD800 <= cp <= 0xDFFF or 0x0590 <= cp <= 0x05FF:
            continue
        c = chr(cp)
        base = "".join(x for x in unicodedata.normalize("NFD", c) if not unicodedata.combining(x))
        if any(0x0590 <= ord(x) <= 0x05FF for x in base):
            assert table.get(c) == base, hex(cp)


def test_latin_fold_equals_nfd_on_sample(spark):
    words = ["Ça", "été", "Ærø", "naïve", "Ångström", "ŉ", "straße", "Ǆ", "ḯ", "Ωμέγα"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = {r.w: r.f for r in df.select("w", T.fold("w", "latin").alias("f")).collect()}
    for w in words:
        exp = "".join(c for c in unicodedata.normalize("NFD", w) if not unicodedata.category(c).startswith("M"))
        exp = "".join(c for c in exp if unicodedata.category(c).startswith("L"))
        assert got[w] == exp, w


def test_tokens_keep_marks_and_split_on_ascii(spark):
    df = spark.createDataFrame([("חֶבְרָה, צה״ל ו-צה\"ל שָׁלוֹם־לך",)], "t string")
    toks = df.select(T.tokens("t").alias("x")).first().x
    assert toks == ["חֶבְרָה", "צה״ל", "ו", "צה", "ל", "שָׁלוֹם־לך"]


@pytest.mark.parametrize("value,expected", [
    ("  שלום  ", "שלום"), (" x\t\n", "x"), ("　a b ", "a b"), ("", ""),
])
def test_strip_is_python_strip(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(T.strip("v").alias("s")).first().s == expected == value.strip()


def test_item_processors(spark):
    df = spark.createDataFrame([(["  sha", "lom  "], "noun – verb", ["שלום", "ignored"], ["", "x"])],
                               "parts array<string>, pos string, heb array<string>, e array<string>")
    r = df.select(T.join_pieces("parts").alias("j"), T.normalize_dash("pos").alias("d"),
                  T.first_nonempty("heb").alias("f"), T.first_nonempty("e").alias("g")).first()
    assert (r.j, r.d, r.f, r.g) == ("shalom", "noun - verb", "שלום", "x")


def test_split_lines_matches_splitlines(spark):
    s = "a\r\nb\rc\nd\x0be\x1cf g\n"
    got = spark.createDataFrame([(s,)], "s string").select(T.split_lines("s").alias("l")).first().l
    assert [x for x in got if x] == [x for x in s.splitlines() if x]


def test_trailing_artist_and_brackets(spark):
    cases = ["שיר יפה - אמן", "line – Artist Name", "word-word", "plain line.", "מִלָּה - שִׁיר"]
    df = spark.createDataFrame([(c,) for c in cases], "l string")
    got = [r.x for r in df.select(T.strip_trailing_artist("l").alias("x")).collect()]
    assert got == ["שיר יפה", "line", "word", "plain line.", "מִלָּה - שִׁיר"]
    b = spark.createDataFrame([("a [x\ny] b [c]",)], "t string")
    r = b.select(T.remove_brackets("t", True).alias("m"), T.remove_brackets("t", False).alias("s")).first()
    assert r.m == "a  b "
    assert r.s == "a [x\ny] b "


def test_misc_scalars(spark):
    df = spark.createDataFrame([("<em>שלום</em>  ", 'a/b:c*?"d', "2024-03-23T10:00:00Z", "x", "3")],
                               "em string, fn string, ts string, bad string, ok string")
    r = df.select(T.strip_em("em").alias("e"), T.sanitize_filename("fn").alias("f"),
                  T.date_cut("ts").cast("string").alias("d"), T.int_or_one("bad").alias("b"),
                  T.int_or_one("ok").alias("o"), T.text_before(F.lit("ab XY cd"), "XY").alias("t")).first()
    assert (r.e, r.f, r.d, r.b, r.o, r.t) == ("שלום", "abcd", "2024-03-23", 1, 3, "ab ")
    assert spark.createDataFrame([("  ",)], "x string").select(T.strip_em("x").alias("e")).first().e is None


def test_has_script(spark):
    df = spark.createDataFrame([("Hello", "ערוץ"), ("שלום", "x"), ("Hi", None)], "title string, channel string")
    got = [r.k for r in df.select((T.has_script("title") | T.has_script("channel")).alias("k")).collect()]
    assert got == [True, True, False]


def test_construct_mark_strip_is_dead_code(spark):
    """T4: stripping a trailing maqaf after folding changes nothing (fold
    already removed it)."""
    df = spark.createDataFrame([("חַבְרַת־",), ("א-",)], "w string")
    got = [r.f for r in df.select(T.fold("w").alias("f")).collect()]
    assert got == ["חברת", "א"] and all(not g.endswith("־") and not g.endswith("-") for g in got)

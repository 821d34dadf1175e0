"""Column-side assembly of extracted HTML pieces.

``sources.markup.extract`` returns raw text nodes; the item processors (strip,
join, take-first, defaults) are applied here. Functions named ``*_items`` take
pieces from any table, not only from pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.columns import bound
from ..sources import markup as H

from ..constants import DICT_BASE
from ..constants import LEXICON_BASE as ARTICLE_BASE


def dictionary_rows(pages: DataFrame, base_url: str = DICT_BASE) -> DataFrame:
    """X1 + item processors: one ``dict_entry`` row per listing table row,
    ordinal = (page url order, row position). Fields emptied by TakeFirst
    are NULL (absent in the reference item)."""
    return dictionary_items(H.extract(pages, "dict_rows", keep=("url",)), base_url)


def dictionary_items(r: DataFrame, base_url: str = DICT_BASE) -> DataFrame:
    """X1 item processors over pieces (``url, item`` and the node arrays of a listing row). The transcription is
    joined, not taken first: blank nodes give ''."""
    trans_nodes = F.col("transcription_nodes")
    trans = F.when(F.size(trans_nodes) > 0, F.array_join(F.filter(
        F.transform(trans_nodes, lambda v: T.strip(v)), lambda v: v != ""), "")).otherwise(F.lit("-"))
    roots = F.col("root_nodes")
    root = F.when(F.size(roots) > 0, T.join_nonempty(roots, " - ")).otherwise(F.lit("-"))
    pos_text = T.join_nonempty(F.col("pos_nodes"), " ")
    pos = F.when(pos_text != "", pos_text).otherwise(F.lit("-"))
    href = F.col("href")
    return r.select(
        "url", F.col("item").cast("long").alias("row"),
        T.first_nonempty(F.transform("hebrew_parts", lambda v: T.strip(v))).alias("hebrew"),
        T.strip(trans).alias("transcription"),
        T.first_nonempty(F.array(T.strip(root))).alias("root"),
        T.first_nonempty(F.array(T.normalize_dash(T.strip(pos)))).alias("part_of_speech"),
        T.first_nonempty(F.transform("meaning_parts", lambda v: T.strip(v))).alias("meaning"),
        T.first_nonempty(F.col("audio")).alias("audio_url"),
        T.first_nonempty(F.array(T.absolute_url(base_url, href))).alias("word_url"))


def word_tables(pages: DataFrame) -> DataFrame:
    """X2 + X3: ``url, tables`` per word page."""
    return H.extract(pages, "tables", keep=("url",)).select("url", "tables")


def build_dictionary(listing_pages: DataFrame, word_pages: DataFrame, base_url: str = DICT_BASE) -> DataFrame:
    """C15 (X1, X2, J8): listing rows with their inflection tables; rows
    without URL or fetched page vanish (inner join)."""
    rows = dictionary_rows(listing_pages, base_url).where(F.col("word_url").isNotNull())
    tables = word_tables(word_pages).withColumnRenamed("url", "word_url")
    return rows.join(tables, "word_url", "inner")


def next_page(active_href: Column, links: Column, max_pages: int | None = None,
              crawled: Column | None = None) -> Column:
    """The link to page N+1 (N = number after the last '=' of the
    active link), or NULL. With ``max_pages``, no link once that many pages
    were ``crawled`` (off by default)."""
    cur = F.element_at(F.split(active_href, "="), -1).try_cast("int")
    want = F.concat(F.lit("?page="), (cur + 1).cast("string"))
    nxt = F.get(F.filter(links, lambda h: F.instr(h, want) > 0), 0)
    ok = F.lit(True) if crawled is None or max_pages is None else crawled < max_pages
    return F.when(ok & cur.isNotNull(), nxt)


def lexicon_items(pages: DataFrame) -> DataFrame:
    """One item per card (``category``, ``letter``, ``page`` kept) of
    the pages before the end of their listing (F7)."""
    r = H.extract(pages, "lexicon", keep=("url", "category", "letter", "page"))
    end = _listing_end(r)
    before = (r.join(end, ["category", "letter"], "left")
              .where(F.col("end_page").isNull() | (F.col("page") < F.col("end_page"))))
    return card_items(before.select("url", "category", "letter", "page", F.posexplode("cards").alias("card_pos", "c")))


def card_items(cards: DataFrame) -> DataFrame:
    """X4 item processors over cards ``c`` (hebrew, audio_url, text_parts, more_parts)."""
    return (cards.select("url", "category", "letter", "page", "card_pos",
                    T.strip(F.col("c.hebrew")).alias("hebrew"), F.coalesce("c.audio_url", F.lit("")).alias("audio_url"),
                    T.join_nonempty(F.col("c.text_parts"), " ").alias("text"),
                    T.join_nonempty(F.col("c.more_parts"), " ").alias("more_info")))


def listing_extent(pages: DataFrame) -> DataFrame:
    """Per (category, letter) the pages crawled before the first page
    that says "no results" or has no cards; cards per page."""
    r = H.extract(pages, "lexicon", keep=("url", "category", "letter", "page"))
    per_page = r.select("category", "letter", "page", F.size("cards").alias("n_cards"))
    return (per_page.join(_listing_end(r), ["category", "letter"], "left")
            .where(F.col("end_page").isNull() | (F.col("page") < F.col("end_page")))
            .select("category", "letter", "page", "n_cards"))


def _listing_end(r: DataFrame) -> DataFrame:
    """Per listing its first page without results (no row for a listing without one)."""
    return (r.where(F.col("no_results") | (F.size("cards") == 0))
            .groupBy("category", "letter").agg(F.min("page").alias("end_page")))


def text_until_marker(paragraphs: Column, marker: str = T.ARTICLE_MARKER) -> Column:
    """W8 row-local: paragraph texts (pieces stripped, space-joined) up to the
    first paragraph containing ``marker``; of that one only the part before
    the marker; empties skipped; joined with spaces."""
    def until(texts: Column, idx: Column) -> Column:
        before = F.slice(texts, 1, F.when(idx > 0, idx - 1).otherwise(F.size(texts)))
        cut = F.when(idx > 0, F.array(T.strip(T.text_before(F.get(texts, idx - 1), marker)))).otherwise(F.array())
        return F.array_join(F.filter(F.concat(before, cut), lambda t: t != ""), " ")
    # the texts and the marker's place are worked out once
    return bound(F.transform(paragraphs, lambda p: T.join_nonempty(p, " ")), lambda texts: bound(
        F.array_position(F.transform(texts, lambda t: F.instr(t, marker) > 0), True).cast("int"), lambda idx: until(texts, idx)))


def articles(pages: DataFrame, marker: str = T.ARTICLE_MARKER) -> DataFrame:
    """C16 / X5 + W8 + T14: ArticleItem per article page."""
    r = H.extract(pages, "article", keep=("url",))
    return r.select("url", "title", "category", "audio_urls",
                    text_until_marker(F.col("paragraphs"), marker).alias("text"),
                    F.transform("explanations", lambda p: T.join_nonempty(p, " ")).alias("word_explanations"))


def article_urls(pages: DataFrame, base_url: str = ARTICLE_BASE) -> DataFrame:
    """Absolute article URLs of listing pages (non-empty hrefs)."""
    r = H.extract(pages, "article_links", keep=("url",))
    return (r.select("url", "n_cards", F.posexplode("hrefs").alias("pos", "href"))
            .where(F.col("href") != "").select("url", "pos", F.concat(F.lit(base_url), "href").alias("article_url")))


def lyrics(pages: DataFrame) -> DataFrame:
    """X7 + C11: cleaned lyric text per page."""
    from .songs import clean_lyrics
    r = H.extract(pages, "lyrics", keep=("url",))
    return r.select("url", clean_lyrics(F.col("parts")).alias("lyrics"))


def chart_texts(pages: DataFrame) -> DataFrame:
    """Chart cell texts (pieces stripped, joined without separator)."""
    r = H.extract(pages, "chart", keep=("url",))
    return r.select("url", "pos", F.array_join(F.filter(F.transform("pieces", lambda v: T.strip(v)),
                                                      lambda v: v != ""), "").alias("text"))


def example_pairs(pages: DataFrame, keep=("url", "word")) -> DataFrame:
    """X9 + T10 + F6: cleaned example pairs, both sides non-empty."""
    r = H.extract(pages, "examples", keep=keep)
    return (r.select(*keep, "pos", T.strip_em(F.col("src")).alias("src"), T.strip_em(F.col("trg")).alias("trg"))
            .where(F.col("src").isNotNull() & F.col("trg").isNotNull()))


def song_lyrics(pages: DataFrame, songs: DataFrame) -> DataFrame:
    """J9 + C11: lyric pages joined (inner) to the songs that point at them by
    URL, carrying artist and title; returns the K6 file name and body."""
    from .songs import lyric_files
    ly = lyrics(pages)
    return lyric_files(songs.select("url", "artist", "title").join(ly, "url", "inner"))

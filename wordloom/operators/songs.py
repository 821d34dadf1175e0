"""Song corpus: C10 line cleanup + shuffle, C11 lyric cleanup, C12 chart
split, C13 first-hit resolution with a stop after N found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .ordering import keep_first


def song_lines(songs: DataFrame, song_col: str = "song", text_col: str = "text") -> DataFrame:
    """C10 core (S3, T5, T6, T9, T11, T8, W7): per song file, drop U+200E and
    every ``[...]`` (across lines), split into lines, strip, drop a trailing
    `` - Artist`` from every line, strip again, drop empty lines and keep the
    first occurrence of each line within the song. Output ``song, pos, line``.
    Row-local up to the dedupe, which is a partial aggregate on (song, line)."""
    body = T.remove_brackets(T.remove_lrm(F.col(text_col)), multiline=True)
    raw = (songs.select(F.col(song_col).alias("song"), F.posexplode(T.split_lines(body)).alias("pos", "raw"))
           .withColumn("pos", F.col("pos").cast("long")))
    s1 = T.strip(F.col("raw"))
    lines = (raw.where(s1 != "")
             .select("song", "pos", T.strip(T.strip_trailing_artist(s1)).alias("line"))
             .where(F.col("line") != ""))
    return keep_first(lines, ["song", "line"], ["pos"])


def shuffled(lines: DataFrame, seed: int = 0, col: str = "line") -> DataFrame:
    """O2/K2 random permutation without a global sort: rows go to partitions by
    the range of a seeded hash of the whole row, and are sorted by it within
    each; reading partitions in order yields the permutation. The hash spreads
    evenly, so its ranges need no sampling. It is a pure function of the row
    (not of its position), so the order is the same over any partitioning and a
    retried task after a lost executor gives the same rows again. Pass
    identifying columns (song, position) along so equal lines differ."""
    key = F.xxhash64(F.lit(seed), *[F.col(c) for c in lines.columns])
    n = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.least(F.floor((F.col("_k") / F.lit(2.0 ** 64) + 0.5) * n), F.lit(n - 1)).cast("int")
    return (lines.select(col, key.alias("_k")).repartitionById(n, place)
            .sortWithinPartitions("_k").select(col))


def clean_lyrics(parts: Column) -> Column:
    """C11 (X7 + T5, T6, T7): direct text pieces joined with newlines, then
    one-line brackets removed, bidi embeddings removed, blank-line runs
    collapsed, stripped."""
    joined = F.array_join(parts, "\n")
    return T.collapse_blank_lines(T.remove_bidi_embedding(T.remove_brackets(joined, multiline=False)))


def lyric_files(lyrics: DataFrame) -> DataFrame:
    """C11 file body and sanitised file name (K6): ``title - artist\\n\\nlyrics``
    stored as ``<artist> - <title>.txt``."""
    return lyrics.select(
        "artist", "title", file_name(F.col("artist"), F.col("title")).alias("file_name"),
        F.concat(F.col("title"), F.lit(" - "), F.col("artist"), F.lit("\n\n"), F.col("lyrics")).alias("body"))


def file_name(artist: Column, title: Column) -> Column:
    """T15 ``<artist> - <title>.txt`` without characters that file names may not have."""
    return F.concat(T.sanitize_filename(artist), F.lit(" - "), T.sanitize_filename(title), F.lit(".txt"))


def split_pattern(prof="hebrew") -> str:
    """F2 ``artist - title``: lazy artist, title holding a script letter."""
    ws = T.WS_CLASS
    return rf"(?d)^(.*?){ws}*-{ws}*(.*{T.profile(prof).letter}.*)$"


def select_songs(texts: DataFrame, text_col: str = "text", prof="hebrew") -> DataFrame:
    """C12 (F2): chart row texts that split into artist and title."""
    pat = split_pattern(prof)
    t = F.col(text_col)
    return (texts.where(t.rlike(pat))
            .withColumn("artist", F.regexp_extract(t, pat, 1))
            .withColumn("title", F.regexp_extract(t, pat, 2)))


def search_query(title, artist) -> Column:
    """T20 search text ``title artist``."""
    return F.concat(F.coalesce(title, F.lit("None")), F.lit(" "), F.coalesce(artist, F.lit("None")))


def resolve_first_hit(songs: DataFrame, hits: DataFrame, errors: DataFrame | None = None,
                      cap: int | None = None, base_url: str = "") -> tuple[DataFrame, DataFrame]:
    """C13 (W10, A10, W6).

    ``songs``: ``ord`` plus song columns, in input order; ``hits``: ``ord,
    hit_pos, path`` (search results); ``errors``: ``ord`` of failed calls and,
    where known, ``error`` ('ERROR' for an HTTP status, 'EXCEPTION' otherwise).
    Each song takes its first hit (FOUND) or none (NOT FOUND or its error).
    With ``cap`` (an API budget, off by default) processing stops at the
    ``cap``-th found song (O5): songs after it are never evaluated. The stop point is a bounded top-``cap`` over found ordinals,
    evaluated once as a scalar subquery (no global window, no cross join).
    Returns ``(found, tally)``."""
    first = hits.groupBy("ord").agg(F.min(F.struct("hit_pos", "path")).alias("_h"))
    s = songs.join(first, "ord", "left")
    if errors is not None:
        kind = F.col("error") if "error" in errors.columns else F.lit("ERROR")
        s = s.join(errors.select("ord", kind.alias("_err")).groupBy("ord").agg(F.min("_err").alias("_err")), "ord", "left")
    else:
        s = s.withColumn("_err", F.lit(None).cast("string"))
    outcome = (F.when(F.col("_err").isNotNull(), F.col("_err"))
               .when(F.col("_h").isNotNull(), F.lit("FOUND")).otherwise(F.lit("NOT FOUND")))
    s = s.withColumn("outcome", outcome)
    evaluated = s
    if cap is not None:
        found_ords = s.where(F.col("outcome") == "FOUND").select("ord").orderBy("ord").limit(cap)
        stop = found_ords.agg(F.when(F.count("*") >= cap, F.max("ord")).alias("stop")).scalar()
        evaluated = s.where(stop.isNull() | (F.col("ord") <= stop))
    found = (evaluated.where(F.col("outcome") == "FOUND")
             .withColumn("url", F.concat(F.lit(base_url), F.col("_h.path")))
             .withColumn("first_hit", F.col("_h.hit_pos"))
             .drop("_h", "_err", "outcome"))
    tally = evaluated.groupBy("outcome").agg(F.count("*").alias("n"))
    return found, tally

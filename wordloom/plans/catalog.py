"""Query catalog: every SURVEY §2 operator as a plan over the driver tables.

Each entry is ``name -> (spark, sf_dir) -> DataFrame`` plus, where the
semantics are SQL-expressible, an equivalent DuckDB SQL string over the same
tables (the correctness oracle). Column names and types agree on both sides:
counts are BIGINT, flags BOOLEAN.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import assemble as A
from ..operators import frequency, lexicon, pages, sentences, songs
from ..operators.ordering import keep_first, top_k
from ..sources import markup
from ..sources.tables import table, text_lines_of
from . import corpus as C

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# ---------------------------------------------------------------------------
# Shared SQL fragments (DuckDB). Same regexes as the Spark side.
# ---------------------------------------------------------------------------
TOK = r"regexp_extract_all({x}, '\p{{L}}+')"
LB = T.LINE_BREAK
WS = T.WS_CLASS


def tok(x: str) -> str:
    return TOK.format(x=x)


def sql_quote(s: str) -> str:
    """Body of a SQL string literal."""
    return s.replace("'", "''")


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


SQL_WORD_SOURCES = f"""
WITH t AS (
  SELECT u.w AS word, 1 AS songs, 0 AS news, 0 AS youtube FROM documents, unnest({tok('text')}) AS u(w)
  UNION ALL SELECT u.w, 0, 1, 0 FROM benchmark, unnest({tok('text')}) AS u(w)
  UNION ALL SELECT u.w, 0, 0, 1 FROM conversations, unnest({tok('text')}) AS u(w))
SELECT word, sum(songs)::BIGINT AS songs, sum(news)::BIGINT AS news,
       sum(youtube)::BIGINT AS youtube, count(*)::BIGINT AS total
FROM t GROUP BY word
"""

SQL_FOLDED = f"""
WITH ws AS ({SQL_WORD_SOURCES})
SELECT strip_accents(word) AS word, sum(songs)::BIGINT AS songs, sum(news)::BIGINT AS news,
       sum(youtube)::BIGINT AS youtube, sum(total)::BIGINT AS total
FROM ws WHERE strip_accents(word) <> '' GROUP BY 1
"""


def vocab_words(table_name: str) -> str:
    return f"SELECT strip_accents(u.w) AS word FROM {table_name}, unnest({tok('text')}) AS u(w)"


SQL_COMMON = f"{vocab_words('documents')} INTERSECT {vocab_words('conversations')}"

SQL_FORMS = f"""
SELECT DISTINCT strip_accents(u.w) AS bare, item_id::BIGINT AS entry_id
FROM benchmark, unnest({tok('text')}) AS u(w)
"""

# Lines of conversations (priority 0) and documents (priority 1) keyed by the
# folded first token; ordinal (a, b, c) = (conv_id, turn, pos) / (doc_id, 0, pos).
SQL_LINES = f"""
SELECT 0 AS prio, 'reverso' AS source, conv_id::BIGINT AS a, turn::BIGINT AS b, (u.i - 1)::BIGINT AS c,
       u.line AS sentence, role AS translation
FROM conversations, unnest(string_split_regex(text, '{LB}')) WITH ORDINALITY AS u(line, i)
UNION ALL
SELECT 1, 'tatoeba', doc_id::BIGINT, 0::BIGINT, (u.i - 1)::BIGINT, u.line, lang
FROM documents, unnest(string_split_regex(text, '{LB}')) WITH ORDINALITY AS u(line, i)
"""

SQL_SENTENCE_ROWS = f"""
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY bare, skey ORDER BY prio, a, b, c) AS rn
  FROM (SELECT *, strip_accents(regexp_extract(sentence, '\\p{{L}}+', 0)) AS bare,
               {sql_strip('sentence')} AS skey FROM ({SQL_LINES}))
  WHERE bare <> '') WHERE rn = 1
"""


# ---------------------------------------------------------------------------
# Frequencies and vocabularies
# ---------------------------------------------------------------------------
@register("word_sources", SQL_WORD_SOURCES)
def q_word_sources(spark, sf):
    """Raw-token counts per source."""
    return C.word_sources(spark, sf)


@register("folded_sources", SQL_FOLDED)
def q_folded_sources(spark, sf):
    """A3: counts re-aggregated by folded key."""
    return frequency.folded_sources(C.word_sources(spark, sf), C.PROFILE)


def _tokens_of(spark, sf, name) -> DataFrame:
    return table(spark, sf, name).select(
        F.explode(T.tokens(F.col("text"), C.PROFILE)).alias("word"))


def common(spark, sf) -> DataFrame:
    return lexicon.common_words(_tokens_of(spark, sf, "documents"),
                                _tokens_of(spark, sf, "conversations").withColumnRenamed("word", "form"),
                                C.PROFILE)


@register("common_words", SQL_COMMON)
def q_common_words(spark, sf):
    """Folded vocabulary of documents ∩ conversations, sorted."""
    return common(spark, sf)


@register("missing_words", f"{vocab_words('benchmark')} EXCEPT {vocab_words('conversations')}")
def q_missing_words(spark, sf):
    """Benchmark vocabulary without a match in conversations."""
    def vocab(name):  # distinct raw spellings first (map-side), then clean, then distinct
        return (_tokens_of(spark, sf, name).distinct()
                .select(T.clean_word(F.col("word"), C.PROFILE).alias("word")).where("word IS NOT NULL").distinct())
    return vocab("benchmark").join(vocab("conversations"), "word", "left_anti")


@register("form_index", SQL_FORMS)
def q_form_index(spark, sf):
    """Distinct folded forms per dictionary entry."""
    return lexicon.form_index(C.dictionary(spark, sf), C.PROFILE).select(
        "bare", F.col("ord").alias("entry_id"))


@register("all_forms", f"""
SELECT item_id::BIGINT AS ord, (u.i - 1)::BIGINT AS pos, u.w AS form
FROM benchmark, unnest(list_prepend(coalesce({tok('text')}[1], ''), {tok('text')})) WITH ORDINALITY AS u(w, i)
""")
def q_all_forms(spark, sf):
    """Every form string of every entry, depth-first, duplicates kept."""
    return lexicon.all_forms(C.dictionary(spark, sf))


SQL_WORD_MEANINGS = f"""
WITH w AS (SELECT DISTINCT strip_accents(u.w) AS word FROM conversations, unnest({tok('text')}) AS u(w)),
fi AS ({SQL_FORMS}),
m AS (SELECT w.word, fi.entry_id FROM w LEFT JOIN fi ON fi.bare = w.word),
c AS (SELECT word, count(entry_id)::BIGINT AS n FROM m GROUP BY word)
SELECT m.word, m.entry_id, c.n AS n_meanings, c.n > 1 AS multiple_meanings
FROM m JOIN c USING (word)
"""


@register("word_meanings", SQL_WORD_MEANINGS)
def q_word_meanings(spark, sf):
    """Each conversation word with every dictionary entry having a
    form that folds to it (long form), plus the meaning count."""
    words = (_tokens_of(spark, sf, "conversations")
             .select(T.fold(F.col("word"), C.PROFILE).alias("bare")).distinct())
    pairs = A.meaning_pairs(words, C.dictionary(spark, sf), C.PROFILE)
    counts = pairs.groupBy("bare").agg(F.count("*").alias("n"))
    out = words.join(pairs, "bare", "left").join(counts, "bare", "left")
    n = F.coalesce(F.col("n"), F.lit(0)).cast("long")
    return out.select(F.col("bare").alias("word"), F.col("ord").alias("entry_id"),
                      n.alias("n_meanings"), (n > 1).alias("multiple_meanings"))


def vocab_flat(spark, sf) -> DataFrame:
    # one tokenising pass feeds words and counts; raw spellings are counted
    # first (map-side partial), so cleaning runs once per distinct spelling
    ws = C.word_sources(spark, sf)
    words = (lexicon.common_with_sources(ws, "songs", "youtube", C.PROFILE)
             .withColumnRenamed("word", "word_ord"))
    sents = sentences.sentence_rows(C.sentence_providers(spark, sf), C.PROFILE)
    return A.assemble_flat(words, C.dictionary(spark, sf), sents, None, C.PROFILE)


SQL_VOCAB = f"""
WITH cw AS ({SQL_COMMON}),
fi AS ({SQL_FORMS}),
m AS (SELECT bare, count(*)::BIGINT AS n_meanings, min(entry_id)::BIGINT AS first_meaning
      FROM fi WHERE bare IN (SELECT word FROM cw) GROUP BY bare),
sr AS (SELECT *, row_number() OVER (PARTITION BY bare ORDER BY prio, a, b, c) AS r2 FROM ({SQL_SENTENCE_ROWS})),
s AS (SELECT bare, count(*)::BIGINT AS n_sentences, max(CASE WHEN r2 = 1 THEN sentence END) AS first_sentence
      FROM sr GROUP BY bare),
fs AS ({SQL_FOLDED})
SELECT cw.word AS word, coalesce(m.n_meanings, 0) > 1 AS multiple_meanings,
       coalesce(m.n_meanings, 0)::BIGINT AS n_meanings, m.first_meaning,
       coalesce(s.n_sentences, 0)::BIGINT AS n_sentences, s.first_sentence,
       fs.songs, fs.news, fs.youtube, fs.total
FROM cw LEFT JOIN m ON m.bare = cw.word LEFT JOIN s ON s.bare = cw.word LEFT JOIN fs ON fs.word = cw.word
"""


@register("vocab", SQL_VOCAB)
def q_vocab(spark, sf):
    """C8 flagship: common words with meanings, sentences and source counts."""
    return vocab_flat(spark, sf).drop("word_ord")


@register("dataset_build", f"""
WITH d AS ({vocab_words('documents')}), y AS ({vocab_words('conversations')}),
cw AS ((SELECT word FROM d UNION SELECT word FROM y) INTERSECT {vocab_words('benchmark')}),
fi AS ({SQL_FORMS}),
m AS (SELECT bare, count(*)::BIGINT AS n, string_agg('item/' || entry_id, '|' ORDER BY entry_id) AS urls FROM fi GROUP BY bare),
s AS (SELECT bare, count(*)::BIGINT AS n, string_agg(source || ':' || a || ':' || sentence, '|' ORDER BY prio, a, b, c) AS list
      FROM (SELECT *, row_number() OVER (PARTITION BY bare ORDER BY prio, a, b, c) AS r2 FROM ({SQL_SENTENCE_ROWS})) WHERE r2 <= 3 GROUP BY bare),
c AS (SELECT word, count(*)::BIGINT AS total FROM d GROUP BY word)
SELECT cw.word, m.n > 1 AS multiple_meanings, m.n AS n_meanings, m.urls AS meanings, coalesce(s.n, 0)::BIGINT AS n_sentences,
       coalesce(s.list, '') AS sentences, c.total AS total
FROM cw JOIN m ON m.bare = cw.word LEFT JOIN s ON s.bare = cw.word LEFT JOIN c ON c.word = cw.word
""")
def q_dataset_build(spark, sf):
    """The nested record of every corpus word that is a
    dictionary form. Counts come from one corpus only, so words of the other
    have none (J3). Sentences are cut to three per word, as both providers do."""
    dic = C.dictionary(spark, sf)
    # one pass over each corpus gives the words and their counts
    spoken = frequency.folded_sources(frequency.word_sources({"songs": C.documents(spark, sf), "youtube": C.conversations(spark, sf)}, C.PROFILE), C.PROFILE)
    sung = F.when(F.col("songs") > 0, F.struct("songs", F.lit(0).cast("long").alias("news"), F.lit(0).cast("long").alias("youtube"), F.col("songs").alias("total")))
    words = (spoken.join(lexicon.form_index(dic, C.PROFILE).select(F.col("bare").alias("word")), "word", "left_semi")
             .select(F.col("word").alias("word_ord"), A.extract_word("word").alias("word"), sung.alias("sources")).select("word_ord", F.col("word").alias("bare"), "sources"))
    rows = top_k(sentences.sentence_rows(C.sentence_providers(spark, sf), C.PROFILE), ["bare"], ["prio", "ord"], T.EXAMPLES_PER_WORD)
    rows = rows.withColumn("sentence", F.concat_ws(":", "source", F.col("ord.a").cast("string"), "sentence")).drop("rank")
    v = A.assemble(words, dic, rows, None, C.PROFILE, payload=("word_url",))
    return v.select("word", "multiple_meanings", F.size("meanings").cast("long").alias("n_meanings"),
                    F.array_join(F.transform("meanings", lambda x: x["word_url"]), "|").alias("meanings"), F.size("sentences").cast("long").alias("n_sentences"),
                    F.array_join(F.transform("sentences", lambda x: x["sentence"]), "|").alias("sentences"), F.col("sources.total").cast("long").alias("total"))


@register("vocab_summary", f"""
WITH v AS ({SQL_VOCAB})
SELECT count(*)::BIGINT AS total_entries, count(*) FILTER (WHERE multiple_meanings)::BIGINT AS multiple_meanings,
       count(*) FILTER (WHERE n_sentences > 0)::BIGINT AS with_sentences,
       count(*) FILTER (WHERE n_meanings = 0)::BIGINT AS not_found
FROM v
""")
def q_vocab_summary(spark, sf):
    """KPI counts over the vocabulary."""
    return A.summary(vocab_flat(spark, sf))


@register("not_found_sample", f"""
WITH v AS ({SQL_VOCAB})
SELECT word FROM v WHERE n_meanings = 0 ORDER BY word LIMIT 20
""")
def q_not_found_sample(spark, sf):
    """First 20 words (list order) without a meaning."""
    return A.not_found_sample(vocab_flat(spark, sf), 20).select("word")


# ---------------------------------------------------------------------------
# Sentences
# ---------------------------------------------------------------------------
@register("sentence_lookup", f"""
SELECT bare AS word, source, a AS src_id, b AS src_turn, c AS src_pos, sentence
FROM ({SQL_SENTENCE_ROWS})
""")
def q_sentence_lookup(spark, sf):
    """Two providers' lines per folded key, deduplicated by
    stripped text, first provider wins."""
    s = sentences.sentence_rows(C.sentence_providers(spark, sf), C.PROFILE)
    return s.select(F.col("bare").alias("word"), "source", F.col("ord.a").alias("src_id"),
                    F.col("ord.b").alias("src_turn"), F.col("ord.c").alias("src_pos"), "sentence")


def _keyed_doc_lines(spark, sf) -> DataFrame:
    """Document lines keyed by the folded first token (empty keys dropped)."""
    return (C.document_lines(spark, sf)
            .withColumn("word", T.fold(C.first_token(F.col("line")), C.PROFILE))
            .where(F.col("word") != ""))


SQL_DOC_LINES = f"""
SELECT strip_accents(regexp_extract(u.line, '\\p{{L}}+', 0)) AS word, doc_id::BIGINT AS doc_id,
       (u.i - 1)::BIGINT AS pos, u.line AS line, lang
FROM documents, unnest(string_split_regex(text, '{LB}')) WITH ORDINALITY AS u(line, i)
"""


@register("sentences_top3", f"""
SELECT word, doc_id, pos, line, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY word ORDER BY doc_id, pos)::BIGINT AS rank
  FROM ({SQL_DOC_LINES}) WHERE word <> '') WHERE rank <= 3
""")
def q_sentences_top3(spark, sf):
    """The first three result lines per folded key."""
    r = top_k(_keyed_doc_lines(spark, sf), ["word"], ["doc_id", "pos"], T.EXAMPLES_PER_WORD)
    return r.select("word", "doc_id", "pos", "line", F.col("rank").cast("long"))


@register("first_use", f"""
SELECT line, doc_id, pos FROM (
  SELECT {sql_strip('line')} AS line, doc_id, pos,
         row_number() OVER (PARTITION BY {sql_strip('line')} ORDER BY doc_id, pos) AS r
  FROM ({SQL_DOC_LINES})) WHERE r = 1 AND line <> ''
""")
def q_first_use(spark, sf):
    """Each distinct (stripped) line with the first document using it."""
    lines = (C.document_lines(spark, sf).select(T.strip(F.col("line")).alias("line"), "doc_id", "pos")
             .where(F.col("line") != ""))
    return keep_first(lines, ["line"], ["doc_id", "pos"]).select("line", "doc_id", "pos")


# C5 on driver tables: required words = folded benchmark vocabulary; the
# "search results" of a word = document lines whose folded first token is the
# word, in (doc_id, pos) order; translation = the rest of the line.
REST_OF_LINE = r"^[^\p{L}]*\p{L}+"

SQL_COVERAGE_CTES = f"""
words AS (SELECT DISTINCT strip_accents(u.w) AS word FROM benchmark, unnest({tok('text')}) AS u(w)),
lines AS (SELECT word, doc_id, pos, line AS sentence,
                 {sql_strip(f"regexp_replace(line, '{REST_OF_LINE}', '')")} AS translation
          FROM ({SQL_DOC_LINES})),
cand AS (SELECT * FROM (
           SELECT l.*, row_number() OVER (PARTITION BY l.word ORDER BY doc_id, pos) AS rk
           FROM lines l WHERE l.word IN (SELECT word FROM words)) WHERE rk <= 3),
valid AS (SELECT * FROM cand WHERE sentence <> '' AND translation <> ''),
kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sentence ORDER BY word, doc_id, pos) AS r
                        FROM valid) WHERE r = 1),
missing AS (SELECT w.word, CASE WHEN w.word IN (SELECT word FROM cand) THEN 'no_valid_translation'
                                ELSE 'no_sentence' END AS reason
            FROM words w WHERE w.word NOT IN (SELECT word FROM kept))
"""


def _coverage(spark, sf):
    words = (_tokens_of(spark, sf, "benchmark").select(T.fold(F.col("word"), C.PROFILE).alias("word"))
             .distinct().withColumn("word_ord", F.col("word")))
    # top-3 per key first (partial WindowGroupLimit before the exchange), so a
    # key starting a third of all lines is cut to 3 rows per map task before
    # it meets the word list.
    top = top_k(_keyed_doc_lines(spark, sf), ["word"], ["doc_id", "pos"], T.EXAMPLES_PER_WORD)
    cand = top.join(words.select("word"), "word", "left_semi").select(
        "word", F.struct("doc_id", "pos").alias("pos"), F.col("line").alias("sentence"),
        T.strip(F.regexp_replace(F.col("line"), REST_OF_LINE, "")).alias("translation"))
    return sentences.keep_candidates(words, cand)


@register("sentence_candidates", f"""
WITH {SQL_COVERAGE_CTES}
SELECT word, doc_id, pos, sentence, translation FROM kept
""")
def q_sentence_candidates(spark, sf):
    """First three results per word, valid pairs only, each
    sentence used by the first word only."""
    kept, _ = _coverage(spark, sf)
    return kept.select("word", F.col("pos.doc_id").alias("doc_id"), F.col("pos.pos").alias("pos"),
                       "sentence", "translation")


@register("coverage", f"WITH {SQL_COVERAGE_CTES} SELECT word, reason FROM missing")
def q_coverage(spark, sf):
    """Required words without a sentence, with the reason."""
    _, missing = _coverage(spark, sf)
    return missing.select("word", "reason")


def _sql_em(x: str) -> str:
    return f"nullif({sql_strip(f"regexp_replace({x}, '</?em>', '', 'g')")}, '')"


@register("sentences_fill", f"""
WITH {SQL_COVERAGE_CTES},
conv AS (SELECT strip_accents(regexp_extract(u.line, '\\p{{L}}+', 0)) AS word, role,
                conv_id::BIGINT AS a, turn::BIGINT AS b, (u.i - 1)::BIGINT AS c, u.line AS line
         FROM conversations, unnest(string_split_regex(text, '{LB}')) WITH ORDINALITY AS u(line, i)),
prior AS (SELECT word, {_sql_em('line')} AS sentence FROM conv WHERE role = 'user'),
todo AS (SELECT DISTINCT word FROM missing WHERE word NOT IN (SELECT word FROM prior)),
fcand AS (SELECT word, 0 AS tier, a, b, c, {_sql_em('line')} AS sentence, {_sql_em('role')} AS translation
         FROM conv WHERE role = 'assistant'
         UNION ALL
         SELECT word, 1, doc_id, 0, pos, {_sql_em('line')}, {_sql_em('lang')} FROM ({SQL_DOC_LINES})),
c2 AS (SELECT * FROM fcand WHERE sentence IS NOT NULL AND translation IS NOT NULL
         AND word IN (SELECT word FROM todo)
         AND NOT EXISTS (SELECT 1 FROM prior p WHERE p.word = fcand.word AND p.sentence = fcand.sentence)),
d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY word, sentence ORDER BY tier, a, b, c) AS r
                     FROM c2) WHERE r = 1)
SELECT word, tier::BIGINT AS tier, rank, sentence, translation FROM (
  SELECT *, row_number() OVER (PARTITION BY word ORDER BY tier, a, b, c)::BIGINT AS rank FROM d)
WHERE rank <= 3
""")
def q_sentences_fill(spark, sf):
    """Words still missing get up to three sentences, API tier
    (assistant turns) first, HTML tier (documents) topping up; words already
    in the prior output (user turns) are skipped."""
    _, missing = _coverage(spark, sf)
    return filled(spark, sf, missing)


def filled(spark, sf, missing: DataFrame) -> DataFrame:
    """Sentences of the ``missing`` words: assistant turns, then documents; user turns are the prior output."""
    conv = C.conversation_lines(spark, sf).select(
        T.fold(C.first_token(F.col("line")), C.PROFILE).alias("word"), "role",
        F.struct(F.col("conv_id").alias("a"), F.col("turn").alias("b"), F.col("pos").alias("c")).alias("pos"),
        "line")
    api = conv.where(F.col("role") == "assistant").select(
        "word", "pos", F.col("line").alias("s_text"), F.col("role").alias("t_text"))
    prior = conv.where(F.col("role") == "user").select(
        "word", T.strip_em(F.col("line")).alias("sentence"), F.col("role").alias("translation"))
    html = C.document_lines(spark, sf).select(
        T.fold(C.first_token(F.col("line")), C.PROFILE).alias("word"),
        F.struct(F.col("doc_id").alias("a"), F.lit(0).cast("long").alias("b"), F.col("pos").alias("c")).alias("pos"),
        F.col("line").alias("src"), F.col("lang").alias("trg"))
    out = sentences.fill_sentences(missing, api, html, prior)
    return out.select("word", F.col("tier").cast("long"), F.col("rank").cast("long"), "sentence", "translation")


# ---------------------------------------------------------------------------
# Song corpus on documents (one document = one song file)
# ---------------------------------------------------------------------------
def sql_song_lines() -> str:
    body = r"regexp_replace(replace(text, chr(8206), ''), '(?s)\[.*?\]', '', 'g')"
    return f"""
SELECT doc_id::BIGINT AS doc_id, line, min(pos)::BIGINT AS pos FROM (
  SELECT doc_id, (u.i - 1) AS pos,
         {sql_strip(f"regexp_replace({sql_strip('u.line')}, '{sql_quote(T.TRAILING_ARTIST)}', '')")} AS line
  FROM documents, unnest(string_split_regex({body}, '{LB}')) WITH ORDINALITY AS u(line, i)
  WHERE {sql_strip('u.line')} <> '')
WHERE line <> '' GROUP BY doc_id, line
"""


def _song_lines(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return songs.song_lines(docs.withColumnRenamed("doc_id", "song"))


@register("line_dedupe", sql_song_lines())
def q_line_dedupe(spark, sf):
    """Cleaned lines, first occurrence per document."""
    return _song_lines(spark, sf).select(F.col("song").alias("doc_id"), "line", "pos")


@register("shuffled_lines", f"SELECT line FROM ({sql_song_lines()})")
def q_shuffled_lines(spark, sf):
    """O2 K2: the combined song corpus in random order (same multiset)."""
    return songs.shuffled(_song_lines(spark, sf), seed=42)


@register("split_title", f"""
WITH t AS (SELECT s_suppkey::BIGINT AS s_suppkey, s_name || ' - ' || n_name AS text
           FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT s_suppkey, artist, title, title || ' ' || artist AS query,
       regexp_replace(artist, '[\\\\/*?:"<>|]', '', 'g') || ' - ' ||
       regexp_replace(title, '[\\\\/*?:"<>|]', '', 'g') || '.txt' AS file_name
FROM (SELECT s_suppkey, regexp_extract(text, '{{PAT}}', 1) AS artist, regexp_extract(text, '{{PAT}}', 2) AS title
      FROM t WHERE regexp_matches(text, '{{PAT}}'))
""".replace("{PAT}", rf"^(.*?){WS}*-{WS}*(.*\p{{L}}.*)$"))
def q_split_title(spark, sf):
    """``artist - title`` split of chart rows."""
    sup = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nat = table(spark, sf, "nation").select("n_nationkey", "n_name")
    t = sup.join(nat, sup.s_nationkey == nat.n_nationkey).select(
        "s_suppkey", F.concat("s_name", F.lit(" - "), "n_name").alias("text"))
    s = songs.select_songs(t, "text", C.PROFILE)
    return s.select("s_suppkey", "artist", "title", songs.search_query(F.col("title"), F.col("artist")).alias("query"),
                    songs.file_name(F.col("artist"), F.col("title")).alias("file_name"))


@register("script_filter", """
SELECT doc_id::BIGINT AS doc_id, lang FROM documents
WHERE regexp_matches(text, '[^\\x00-\\x7F]') OR regexp_matches(source, '[^\\x00-\\x7F]')
""")
def q_script_filter(spark, sf):
    """rows whose title or channel contains a script character."""
    d = table(spark, sf, "documents").select("doc_id", "lang", "text", "source")
    return d.where(T.has_script(F.col("text"), C.PROFILE) | T.has_script(F.col("source"), C.PROFILE)).select(
        "doc_id", "lang")


SQL_RESOLVE_CTES = """
hits AS (SELECT o_custkey AS ord, min(o_orderkey) AS first_hit FROM orders WHERE o_orderstatus = 'O' GROUP BY 1),
anyo AS (SELECT DISTINCT o_custkey AS ord FROM orders),
ev AS (SELECT c.c_custkey AS ord, c.c_name, h.first_hit,
              CASE WHEN a.ord IS NULL THEN CASE WHEN c.c_acctbal < 0 THEN 'EXCEPTION' ELSE 'ERROR' END
                   WHEN h.first_hit IS NOT NULL THEN 'FOUND' ELSE 'NOT FOUND' END AS outcome
       FROM customer c LEFT JOIN hits h ON h.ord = c.c_custkey LEFT JOIN anyo a ON a.ord = c.c_custkey)
"""


def _resolve(spark, sf):
    cust = table(spark, sf, "customer").select(F.col("c_custkey").alias("ord"), "c_name", "c_acctbal")
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    hits = orders.where(F.col("o_orderstatus") == "O").select(
        F.col("o_custkey").alias("ord"), F.col("o_orderkey").alias("hit_pos"),
        F.concat(F.lit("/orders/"), F.col("o_orderkey").cast("string")).alias("path"))
    failed = (cust.join(orders.select(F.col("o_custkey").alias("ord")), "ord", "left_anti")
              .select("ord", F.when(F.col("c_acctbal") < 0, "EXCEPTION").otherwise("ERROR").alias("error")))
    return songs.resolve_first_hit(cust.select("ord", "c_name"), hits, failed)


@register("resolve_first_hit", f"""
WITH {SQL_RESOLVE_CTES}
SELECT ord::BIGINT AS c_custkey, c_name, first_hit::BIGINT AS first_order FROM ev WHERE outcome = 'FOUND'
""")
def q_resolve_first_hit(spark, sf):
    """First search hit per song (no budget: W6 is an option of the operator)."""
    found, _ = _resolve(spark, sf)
    return found.select(F.col("ord").cast("long").alias("c_custkey"), "c_name",
                        F.col("first_hit").cast("long").alias("first_order"))


@register("outcome_tally", f"""
WITH {SQL_RESOLVE_CTES}
SELECT outcome, count(*)::BIGINT AS n FROM ev GROUP BY outcome
""")
def q_outcome_tally(spark, sf):
    """A10: outcome counts over all songs, HTTP errors and exceptions apart."""
    _, tally = _resolve(spark, sf)
    return tally


# ---------------------------------------------------------------------------
# Pages (HTML extraction job)
# ---------------------------------------------------------------------------
def _pages(spark, sf):
    return markup.extract(table(spark, sf, "pages").select("page_id", "url", "html"), "page", keep=("page_id", "url"))


def sql_unescape(x: str) -> str:
    for ref, c in (("&quot;", '"'), ("&#39;", "''"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", "\u00a0")):
        x = f"replace({x}, '{ref}', '{c}')"
    return f"regexp_replace({x}, '&amp;?', '&', 'g')"


@register("page_titles", f"""
SELECT page_id::BIGINT AS page_id, {sql_unescape("regexp_extract(html, '<title>(.*?)</title>', 1)")} AS title FROM pages
""")
def q_page_titles(spark, sf):
    """Page title text (character references decoded)."""
    return _pages(spark, sf).select("page_id", "title")


@register("page_links", """
SELECT page_id::BIGINT AS page_id, (u.i - 1)::BIGINT AS pos, replace(u.href, '&amp;', '&') AS href
FROM pages, unnest(regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1), 'href="([^"]*)"', 1))
     WITH ORDINALITY AS u(href, i)
""")
def q_page_links(spark, sf):
    """Navigation link targets in page order."""
    return (_pages(spark, sf).select("page_id", F.posexplode("nav_links").alias("pos", "href"))
            .select("page_id", F.col("pos").cast("long"), "href"))


PARAGRAPH_MARKER = "tion"


@register("page_paragraphs", f"""
WITH a AS (SELECT page_id::BIGINT AS page_id, regexp_extract(html, '(?s)<article[^>]*>(.*?)</article>', 1) AS art FROM pages),
p AS (SELECT page_id, u.i AS i, split_part(u.x, '</p>', 1) AS x
      FROM a, unnest(string_split_regex(art, '<p[^>]*>')[2:]) WITH ORDINALITY AS u(x, i)),
t AS (SELECT page_id, i, array_to_string(list_filter(list_transform(string_split_regex(x, '<[^>]*>'),
             lambda v: {sql_strip(sql_unescape('v'))}), lambda v: v <> ''), ' ') AS t FROM p),
f AS (SELECT page_id, min(i) FILTER (WHERE position('{PARAGRAPH_MARKER}' IN t) > 0) AS fi FROM t GROUP BY page_id),
k AS (SELECT t.page_id, t.i, CASE WHEN t.i = f.fi THEN {sql_strip(f"split_part(t.t, '{PARAGRAPH_MARKER}', 1)")} ELSE t.t END AS t
      FROM t JOIN f USING (page_id) WHERE f.fi IS NULL OR t.i <= f.fi)
SELECT a.page_id, coalesce(string_agg(k.t, ' ' ORDER BY k.i) FILTER (WHERE k.t <> ''), '') AS text
FROM a LEFT JOIN k USING (page_id) GROUP BY a.page_id
""")
def q_page_paragraphs(spark, sf):
    """Article text up to the first paragraph holding a marker."""
    return _pages(spark, sf).select("page_id", pages.text_until_marker(F.col("paragraphs"), PARAGRAPH_MARKER).alias("text"))


SITE = r"^[a-z]+://([^/?#]+)"
PAGE_NO = r"([0-9]+)(\?|#|$)"


@register("next_page", f"""
WITH p AS (SELECT page_id::BIGINT AS page_id, regexp_extract(url, '{SITE}', 1) AS site,
                  TRY_CAST(nullif(regexp_extract(url, '{PAGE_NO}', 1), '') AS BIGINT) AS page_no FROM pages),
k AS (SELECT DISTINCT site, page_no FROM p WHERE page_no IS NOT NULL)
SELECT p.page_id, p.site, p.page_no, k.page_no AS next_page
FROM p LEFT JOIN k ON k.site = p.site AND k.page_no = p.page_no + 1
""")
def q_next_page(spark, sf):
    """Next page = page + 1 when the site has it. An
    equi-join on (site, page + 1): no per-site window, so a site holding a
    third of all pages still spreads over many tasks."""
    p = table(spark, sf, "pages").select(
        F.col("page_id").cast("long"), F.regexp_extract("url", SITE, 1).alias("site"),
        F.nullif(F.regexp_extract("url", PAGE_NO, 1), F.lit("")).try_cast("long").alias("page_no"))
    k = p.where(F.col("page_no").isNotNull()).select(F.col("site").alias("k_site"),
                                                    F.col("page_no").alias("k_no")).distinct()
    j = p.join(k, (F.col("k_site") == F.col("site")) & (F.col("k_no") == F.col("page_no") + 1), "left")
    return j.select("page_id", "site", "page_no", F.col("k_no").alias("next_page"))


# ---------------------------------------------------------------------------
# Seeds, nesting, merges, state
# ---------------------------------------------------------------------------
from ..constants import LEXICON_BASE as SEED_BASE  # noqa: E402
from ..constants import LISTING_LETTERS as HEBREW_LETTERS_22  # noqa: E402


@register("seed_urls", f"""
SELECT r_name AS category, l.letter, (l.i - 1)::BIGINT AS letter_pos,
       '{SEED_BASE}/' || r_name || '/?page=1&letter=' || url_encode(l.letter) AS url
FROM region, unnest([{", ".join(f"'{c}'" for c in HEBREW_LETTERS_22)}]) WITH ORDINALITY AS l(letter, i)
""")
def q_seed_urls(spark, sf):
    """One listing seed per category (region) and letter; the fixed
    letter list is exploded per row (no cross join)."""
    letters = F.array(*[F.lit(c) for c in HEBREW_LETTERS_22])
    r = table(spark, sf, "region").select("r_name", F.posexplode(letters).alias("letter_pos", "letter"))
    return r.select(F.col("r_name").alias("category"), "letter", F.col("letter_pos").cast("long"),
                    F.concat(F.lit(SEED_BASE + "/"), "r_name", F.lit("/?page=1&letter="),
                             F.url_encode("letter")).alias("url"))


@register("listing_end", """
WITH b AS (SELECT min(ts::DATE) AS first_day FROM events),
d AS (SELECT user_id, (date_diff('day', b.first_day, ts::DATE) + 1)::BIGINT AS day, count(*) AS n FROM events, b WHERE ts IS NOT NULL GROUP BY 1, 2),
s AS (SELECT user_id, min(day) AS s FROM d GROUP BY 1),
r AS (SELECT d.user_id, d.day - s.s + 1 AS page, n, row_number() OVER (PARTITION BY d.user_id ORDER BY d.day) AS rn FROM d JOIN s USING (user_id))
SELECT user_id::BIGINT AS user_id, count(*)::BIGINT AS pages, sum(n)::BIGINT AS cards FROM r WHERE page = rn GROUP BY 1
""")
def q_listing_end(spark, sf):
    """Events per user and day as listing pages (cards per page). A
    user's listing starts on the user's first day and ends before the first
    empty one: exactly the pages whose number is their rank. The window covers
    at most one row per day of one user."""
    ev = table(spark, sf, "events").select("user_id", F.to_date("ts").alias("day")).where("day is not null")
    d = ev.groupBy("user_id", "day").agg(F.count("*").alias("n"))
    of = Window.partitionBy("user_id").orderBy("day")
    first = F.min("day").over(of)
    r = d.select("user_id", "n", (F.datediff("day", first) + 1).alias("page"), F.row_number().over(of).alias("rn"))
    return (r.where("page = rn").groupBy(F.col("user_id").cast("long").alias("user_id"))
            .agg(F.count("*").alias("pages"), F.sum("n").cast("long").alias("cards")))


def _nested_orders(spark, sf):
    """Orders as dictionary-like documents: one table per order, one row per
    return flag (label), one cell per line item (form = part key). One
    aggregation on the order key; rows are built with array functions inside
    the group, which is bounded by the lines of one order."""
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_returnflag", "l_linenumber", "l_partkey", "l_linestatus", "l_quantity")
    lines = (li.groupBy("l_orderkey")
             .agg(F.array_sort(F.collect_list(F.struct(
                 "l_returnflag", "l_linenumber", F.col("l_partkey").alias("_pk"),
                 F.col("l_partkey").cast("string").alias("hebrew"),
                 F.col("l_linestatus").alias("transcription"),
                 F.col("l_quantity").cast("long").cast("string").alias("meaning")))).alias("c")))
    flags = F.array_distinct(F.transform("c", lambda x: x["l_returnflag"]))
    rows = F.transform(flags, lambda f: F.struct(
        F.array(f).alias("labels"),
        F.transform(F.filter("c", lambda x: x["l_returnflag"] == f),
                    lambda x: x.dropFields("l_returnflag", "l_linenumber", "_pk")).alias("cells")))
    tables = lines.select("l_orderkey", F.array(F.struct(rows.alias("rows"))).alias("tables"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return o.join(tables, o.o_orderkey == tables.l_orderkey, "left").select(
        F.col("o_orderkey").alias("ord"), F.col("o_orderstatus").alias("hebrew"), "tables")


ORACLE_TABLE_FLATTEN = """
SELECT o_orderkey::BIGINT AS ord, 0::BIGINT AS pos, o_orderstatus AS form FROM orders
UNION ALL
SELECT l_orderkey::BIGINT, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag, l_linenumber, l_partkey)::BIGINT,
       l_partkey::VARCHAR
FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)
"""


@register("table_flatten", ORACLE_TABLE_FLATTEN)
def q_table_flatten(spark, sf):
    """Nested tables/rows/cells built per order (bounded by its lines),
    then every form harvested depth-first."""
    from ..operators.lexicon import all_forms
    return all_forms(_nested_orders(spark, sf))


@register("json_harvest", ORACLE_TABLE_FLATTEN)
def q_json_harvest(spark, sf):
    """P4 (unknown schema): the nested order documents as JSON text, every
    ``hebrew`` string harvested depth-first; equals the known-schema walk."""
    docs = _nested_orders(spark, sf).select("ord", F.to_json(F.struct("hebrew", "tables")).alias("doc"))
    return lexicon.harvest_key(docs, "doc", "hebrew", ("ord",))


@register("attach_tables", """
SELECT o.o_orderkey::BIGINT AS o_orderkey, count(DISTINCT l.l_returnflag)::BIGINT AS n_rows,
       count(*)::BIGINT AS n_cells, sum(l.l_quantity::BIGINT)::BIGINT AS sum_qty
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY 1
""")
def q_attach_tables(spark, sf):
    """Entries joined (inner) to their parsed tables; entries without a
    table vanish."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("word_url"))
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity")
    t = li.groupBy("l_orderkey").agg(
        F.count_distinct("l_returnflag").alias("n_rows"), F.count("*").alias("n_cells"),
        F.sum(F.col("l_quantity").cast("long")).alias("sum_qty"))
    from ..operators.lexicon import attach_tables
    pages = t.select(F.col("l_orderkey").cast("string").alias("url"), F.struct("n_rows", "n_cells", "sum_qty").alias("tables"))
    j = attach_tables(o.withColumn("word_url", F.col("word_url")), pages)
    return j.select(F.col("word_url").cast("long").alias("o_orderkey"),
                    F.col("tables.n_rows").cast("long").alias("n_rows"),
                    F.col("tables.n_cells").cast("long").alias("n_cells"),
                    F.col("tables.sum_qty").cast("long").alias("sum_qty"))


@register("json_extract", """
SELECT event_id::BIGINT AS event_id, TRY_CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
""")
def q_json_extract(spark, sf):
    """Typed field of a JSON payload (parsed once, variant path)."""
    ev = table(spark, sf, "events").select("event_id", "props")
    return ev.select(F.col("event_id").cast("long"),
                     F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))


@register("upsert_merge", """
WITH u AS (SELECT user_id AS key, arg_max(event_type, event_id) AS flag, arg_max(value, event_id) AS data FROM events GROUP BY 1),
t AS (SELECT doc_id AS key, quality::VARCHAR AS flag, toxic::DOUBLE AS data FROM labels)
SELECT coalesce(t.key, u.key)::BIGINT AS key, coalesce(t.flag, u.flag) AS flag, CASE WHEN u.key IS NULL THEN t.data ELSE u.data END AS data,
       CASE WHEN t.key IS NULL THEN 'insert' WHEN u.key IS NULL THEN 'keep' ELSE 'update' END AS action
FROM t FULL OUTER JOIN u ON u.key = t.key
""")
def q_upsert_merge(spark, sf):
    """Keyed upsert of all labels with all events, the last one per
    user. Users without a label are inserted, users with one get the new data
    and keep their flag, labels without a user are kept."""
    from ..sinks.merge import upsert
    target = table(spark, sf, "labels").select(F.col("doc_id").alias("key"), F.col("quality").cast("string").alias("flag"), F.col("toxic").cast("double").alias("data"))
    upd = table(spark, sf, "events").select(F.col("user_id").alias("key"), F.col("event_type").alias("flag"), F.col("value").alias("data"), "event_id")
    return upsert(target, upd, "key", replace=["data"], order="event_id").withColumn("key", F.col("key").cast("long"))


@register("seen_state", """
SELECT user_id::BIGINT AS user_id, min(ts::DATE) AS first_seen, max(ts::DATE) AS last_seen,
       arg_max(value, ts) AS last_value, count(*)::BIGINT AS n_events
FROM events GROUP BY 1
""")
def q_seen_state(spark, sf):
    """Tracked entity state — first/last seen day, latest value."""
    from ..streaming.incremental import entity_state
    ev = table(spark, sf, "events").select("user_id", "ts", "value")
    return entity_state(ev, "user_id", "ts", "value").withColumn("user_id", F.col("user_id").cast("long"))


@register("field_pipeline", f"""
SELECT p_partkey::BIGINT AS p_partkey,
       {sql_strip('p_name')} AS name,
       {sql_strip("replace(p_type, '–', '-')")} AS type_norm,
       array_to_string(list_filter(list_transform(string_split(p_type, ' '), lambda x: {sql_strip('x')}), lambda x: x <> ''), ' ') AS type_words,
       coalesce(nullif(p_brand, ''), p_name) AS brand,
       coalesce(TRY_CAST(p_size::VARCHAR AS INTEGER), 1) AS size,
       {sql_strip(f"array_to_string(list_transform(string_split(p_name, ' '), lambda x: {sql_strip('x')}), '')")} AS name_joined
FROM part
""")
def q_field_pipeline(spark, sf):
    """§2.12 T11 T12 T13 T14 T18 T21: per-field processors and take-first."""
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size")
    return p.select(
        F.col("p_partkey").cast("long"), T.strip(F.col("p_name")).alias("name"),
        T.normalize_dash(F.col("p_type")).alias("type_norm"),
        T.join_nonempty(F.split("p_type", " "), " ").alias("type_words"),
        T.field_pipeline(F.array(F.nullif("p_brand", F.lit("")), F.col("p_name")), []).alias("brand"),
        T.int_or_one(F.col("p_size").cast("string")).alias("size"),
        T.join_pieces(F.split("p_name", " ")).alias("name_joined"))


# ---------------------------------------------------------------------------
# Streaming / incremental (file streams landed under spark.checkpoint.dir)
# ---------------------------------------------------------------------------
@register("comment_dedupe", """
SELECT DISTINCT event_id::BIGINT AS event_id, user_id::BIGINT AS user_id, event_type FROM events
""")
def q_comment_dedupe(spark, sf):
    """Two runs on one checkpoint. The first delivery holds the
    purchases; the second, after a restart, the whole table, and only ids the
    state does not know yet are appended."""
    from ..session import run_folder
    from ..streaming.incremental import dedupe_stream
    run = run_folder(spark, "comment_dedupe")
    ev = table(spark, sf, "events").select(F.col("event_id").cast("long"), F.col("user_id").cast("long"), "event_type")
    out = None
    for delivery in (ev.where("event_type = 'purchase'"), ev):
        delivery.write.mode("append").parquet(f"{run}/landing")
        out = dedupe_stream(spark, f"{run}/landing", ev.schema, ["event_id"], f"{run}/sink", f"{run}/ckpt")
    return out


@register("seen_state_stream", """
SELECT user_id::BIGINT AS user_id, min(ts::DATE) AS first_seen, max(ts::DATE) AS last_seen,
       arg_max(value, ts) AS last_value, count(*)::BIGINT AS n_events
FROM events GROUP BY 1
""")
def q_seen_state_stream(spark, sf):
    """Two deliveries, the second after a restart on the same
    checkpoint, folded into keyed streaming state; each batch writes only the
    entities it changed."""
    from ..session import run_folder
    from ..streaming.incremental import state_upsert_stream
    run = run_folder(spark, "seen_state")
    ev = table(spark, sf, "events").select(F.col("user_id").cast("long"), "ts", "value")
    first_half = F.coalesce(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"), F.lit(False))
    st = None
    for delivery in (ev.where(first_half), ev.where(~first_half)):
        delivery.write.mode("append").parquet(f"{run}/landing")
        st = state_upsert_stream(spark, f"{run}/landing", ev.schema, "user_id", "ts", "value", f"{run}/state", f"{run}/ckpt")
    return st.select("user_id", "first_seen", "last_seen", "last_value", F.col("n_events").cast("long"))


@register("state_load", """
SELECT user_id::BIGINT AS user_id, min(event_id)::BIGINT AS ord,
       arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value
FROM events GROUP BY 1
""")
def q_state_load(spark, sf):
    """Loading keyed state keeps the last row per key (file order) at the
    position of the key's first row."""
    from ..streaming.incremental import load_state
    ev = table(spark, sf, "events").select(F.col("user_id").cast("long"), F.col("event_id").cast("long").alias("ord"),
                                           "event_type", "value")
    return load_state(ev, "user_id", "ord")


# ---------------------------------------------------------------------------
# Item processors and listings over table columns: the pieces that extraction
# would give come straight from the tables
# ---------------------------------------------------------------------------
ROWS_PER_PAGE = 15  # listing rows per dictionary page (as on the real site)
SQL_PART_PAGE = f"(p_partkey // {ROWS_PER_PAGE} + 1)"


def _position(keys: list[str], *order: str) -> F.Column:
    """0-based position within a group whose size is bounded by its key (a page, an order)."""
    return (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).cast("long")


def _listing_urls(page) -> F.Column:
    return F.concat(F.lit("https://www.pealim.com/dict/?page="), page.cast("string"))


@register("dict_listing", f"""
SELECT 'https://www.pealim.com/dict/?page=' || {SQL_PART_PAGE} AS url,
       (row_number() OVER (PARTITION BY {SQL_PART_PAGE} ORDER BY p_partkey) - 1)::BIGINT AS row,
       split_part(p_name, ' ', 1) AS hebrew, split_part(p_name, ' ', 2) AS transcription, p_brand AS root,
       p_type || ' - ' || split_part(p_name, ' ', 2) AS part_of_speech, p_name AS meaning,
       '/audio/' || p_partkey || '.mp3' AS audio_url,
       'https://www.pealim.com/dict/' || p_partkey || '-' || split_part(p_name, ' ', 1) || '/' AS word_url
FROM part
""")
def q_dict_listing(spark, sf):
    """Item processors of listing rows (15 rows per page)."""
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    w1, w2 = (F.split_part("p_name", F.lit(" "), F.lit(k)) for k in (1, 2))
    key = F.col("p_partkey").cast("string")
    page = F.floor(F.col("p_partkey") / ROWS_PER_PAGE).cast("long") + 1
    pieces = p.withColumn("page", page).select(
        _listing_urls(F.col("page")).alias("url"), _position(["page"], "p_partkey").alias("item"),
        F.array(w1, F.lit("")).alias("hebrew_parts"), F.array(F.substring(w2, 1, 2), F.expr("substring(split_part(p_name, ' ', 2), 3)")).alias("transcription_nodes"),
        F.array("p_brand").alias("root_nodes"), F.array(F.concat("p_type", F.lit(" –")), F.lit(" "), w2).alias("pos_nodes"),
        F.array(F.concat(F.lit(" "), "p_name", F.lit(" "))).alias("meaning_parts"),
        F.array(F.concat(F.lit("/audio/"), key, F.lit(".mp3"))).alias("audio"), F.concat(F.lit("/dict/"), key, F.lit("-"), w1, F.lit("/")).alias("href"))
    return pages.dictionary_items(pieces)


@register("listing_next", f"""
WITH p AS (SELECT DISTINCT {SQL_PART_PAGE} AS page FROM part), m AS (SELECT max(page) AS mx FROM p)
SELECT 'https://www.pealim.com/dict/?page=' || page AS url,
       CASE WHEN page < mx THEN '/dict/?page=' || (page + 1) END AS next_href
FROM p, m
""")
def q_listing_next(spark, sf):
    """The next-page link of each listing page, from its active link and its links."""
    p = table(spark, sf, "part").select((F.floor(F.col("p_partkey") / ROWS_PER_PAGE).cast("long") + 1).alias("page")).distinct()
    last = p.agg(F.max("page")).scalar()
    link = lambda n: F.concat(F.lit("/dict/?page="), n.cast("string"))
    here, after = link(F.col("page")), link(F.col("page") + 1)
    return p.select(_listing_urls(F.col("page")).alias("url"),
                    F.when(F.col("page") < last, pages.next_page(here, F.array(here, after))).alias("next_href"))


@register("conj_tables", """
SELECT l_orderkey::BIGINT AS ord,
       (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) - 1)::BIGINT
         AS row,
       l_returnflag AS label, l_partkey::VARCHAR AS hebrew, l_linestatus AS transcription,
       l_quantity::BIGINT::VARCHAR AS meaning
FROM lineitem
""")
def q_conj_tables(spark, sf):
    """One cell per line item; the chaser's form wins over the pointed one."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus")
    text = lambda c: F.col(c).cast("long").cast("string")
    return li.select(
        F.col("l_orderkey").cast("long").alias("ord"), _position(["l_orderkey"], "l_linenumber", "l_partkey", "l_suppkey", "l_quantity").alias("row"),
        F.col("l_returnflag").alias("label"), markup.cell_form(F.concat(F.lit("~"), text("l_partkey")), text("l_suppkey")).alias("hebrew"),
        F.col("l_linestatus").alias("transcription"), text("l_quantity").alias("meaning"))


ARTICLE_MARKER_LATIN = "tion"  # marker token for rendered articles (Latin prose)


@register("articles", f"""
WITH l AS (SELECT doc_id, u.i AS i, {sql_strip('u.line')} AS t
           FROM documents, unnest(string_split_regex(text, '{LB}')) WITH ORDINALITY AS u(line, i)),
f AS (SELECT doc_id, min(i) FILTER (WHERE position('{ARTICLE_MARKER_LATIN}' IN t) > 0) AS fi FROM l GROUP BY doc_id),
parts AS (SELECT l.doc_id, l.i,
                 CASE WHEN l.i = f.fi THEN {sql_strip(f"split_part(l.t, '{ARTICLE_MARKER_LATIN}', 1)")} ELSE l.t END AS t
          FROM l JOIN f USING (doc_id) WHERE f.fi IS NULL OR l.i <= f.fi),
txt AS (SELECT doc_id, coalesce(string_agg(t, ' ' ORDER BY i) FILTER (WHERE t <> ''), '') AS text
        FROM parts GROUP BY doc_id)
SELECT d.doc_id::BIGINT AS doc_id, d.source AS title, d.lang AS category, '/a/' || d.doc_id || '.mp3' AS audio_urls,
       txt.text, d.source || ': ' || d.lang AS word_explanations
FROM documents d JOIN txt USING (doc_id)
""")
def q_articles(spark, sf):
    """Articles of paragraphs (one per line); body text up to
    the first paragraph holding the marker (row-local array logic, no window)."""
    d = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    paragraphs = F.transform(T.split_lines(F.col("text")), lambda x: F.array(x))
    return d.select(F.col("doc_id").cast("long"), T.strip(F.col("source")).alias("title"), T.strip(F.col("lang")).alias("category"),
                    F.concat(F.lit("/a/"), F.col("doc_id").cast("string"), F.lit(".mp3")).alias("audio_urls"),
                    pages.text_until_marker(paragraphs, ARTICLE_MARKER_LATIN).alias("text"),
                    T.join_nonempty(F.array(F.concat("source", F.lit(": ")), F.col("lang")), " ").alias("word_explanations"))


@register("lexicon_cards", """
SELECT 'u' || user_id || '/' || (date_diff('day', DATE '2024-01-01', ts::DATE) + 1) || '/' || (event_id // 20) AS url,
       'events' AS category, user_id::VARCHAR AS letter,
       (date_diff('day', DATE '2024-01-01', ts::DATE) + 1)::INTEGER AS page,
       (row_number() OVER (PARTITION BY user_id, ts::DATE, event_id // 20 ORDER BY event_id) - 1)::BIGINT AS card_pos,
       event_type AS hebrew, '/a/' || event_id || '.mp3' AS audio_url,
       props || ' ' || event_type AS text, event_id::VARCHAR AS more_info
FROM events
""")
def q_lexicon_cards(spark, sf):
    """Card item processors; a page holds one id block of a user's events of a day."""
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type", "props")
    day = (F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) + 1).cast("int")
    ev = ev.withColumns({"page": day, "block": F.floor(F.col("event_id") / CARDS_PER_PAGE).cast("long")})
    number = lambda c: F.col(c).cast("string")
    cards = ev.select(
        F.concat(F.lit("u"), number("user_id"), F.lit("/"), number("page"), F.lit("/"), number("block")).alias("url"), F.lit("events").alias("category"),
        number("user_id").alias("letter"), "page", _position(["user_id", "page", "block"], "event_id").alias("card_pos"),
        F.struct(F.concat(F.lit(" "), "event_type", F.lit(" ")).alias("hebrew"), F.concat(F.lit("/a/"), number("event_id"), F.lit(".mp3")).alias("audio_url"),
                 F.array(F.col("props"), F.lit(" "), F.col("event_type")).alias("text_parts"), F.array(number("event_id")).alias("more_parts")).alias("c"))
    return pages.card_items(cards)


CARDS_PER_PAGE = 20


@register("example_pairs", f"""
SELECT conv_id || '/' || (turn // 50) AS url, conv_id::BIGINT AS conv_id,
       (row_number() OVER (PARTITION BY conv_id, turn // 50 ORDER BY turn) - 1)::BIGINT AS pos,
       {_sql_em('text')} AS src, {_sql_em('role')} AS trg
FROM conversations
QUALIFY src IS NOT NULL AND trg IS NOT NULL
""")
def q_example_pairs(spark, sf):
    """An example per turn (source: the whole turn, target: its
    role), pairs with an empty side dropped, numbered within blocks of 50 turns."""
    cv = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").withColumn("block", F.floor(F.col("turn") / 50).cast("long"))
    em = F.concat(F.lit("<em>"), "role", F.lit("</em>"))
    return (cv.select(F.concat(F.col("conv_id").cast("string"), F.lit("/"), F.col("block").cast("string")).alias("url"), F.col("conv_id").cast("long"),
                      _position(["conv_id", "block"], "turn").alias("pos"), T.strip_em(F.col("text")).alias("src"), T.strip_em(em).alias("trg"))
            .where("src is not null and trg is not null"))


@register("lexicon_stats", f"""
SELECT (SELECT count(*) FROM benchmark)::BIGINT AS dict_entries,
       (SELECT count(DISTINCT strip_accents(u.w)) FROM benchmark, unnest({tok('text')}) AS u(w))::BIGINT AS unique_forms
""")
def q_lexicon_stats(spark, sf):
    """Dictionary cardinality and number of distinct indexed forms."""
    return lexicon.cardinalities(C.dictionary(spark, sf), C.PROFILE)


@register("chart_songs", f"""
SELECT n_regionkey::VARCHAR AS url, s_suppkey::BIGINT AS s_suppkey, regexp_extract(t, '{{PAT}}', 1) AS artist, regexp_extract(t, '{{PAT}}', 2) AS title
FROM (SELECT n_regionkey, s_suppkey, s_name || '-' || n_name AS t
      FROM supplier JOIN nation ON s_nationkey = n_nationkey)
WHERE regexp_matches(t, '{{PAT}}')
""".replace("{PAT}", rf"^(.*?){WS}*-{WS}*(.*\p{{L}}.*)$"))
def q_chart_songs(spark, sf):
    """Chart cells (text pieces joined without separator) split into artist and title."""
    sup = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nat = table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    t = sup.join(nat, sup.s_nationkey == nat.n_nationkey).select(
        F.col("n_regionkey").cast("string").alias("url"), F.col("s_suppkey").cast("long").alias("s_suppkey"),
        T.join_pieces(F.array("s_name", F.lit(" - "), "n_name")).alias("text"))
    return songs.select_songs(t, "text", C.PROFILE).select("url", "s_suppkey", "artist", "title")


@register("song_lyrics", f"""
WITH j AS (SELECT doc_id, lang, source,
                  array_to_string(list_filter(string_split_regex(text, '{LB}'), lambda x: x <> ''), chr(10)) AS t
           FROM documents)
SELECT lang || ' - ' || regexp_replace(source, '[\\\\/*?:"<>|]', '', 'g') || '.txt' AS file_name,
       source || ' - ' || lang || chr(10) || chr(10) ||
       {sql_strip(f"regexp_replace(regexp_replace(t, '\\\\[[^\\n]*?\\\\]', '', 'g'), '\\n{WS}*\\n', chr(10) || chr(10), 'g')")} AS body
FROM j
""")
def q_song_lyrics(spark, sf):
    """Lyrics of text pieces (one per line) joined
    (inner) to the songs that point at them, cleaned, with file name and body."""
    url = F.concat(F.lit("https://lyrics.test/"), F.col("doc_id").cast("string")).alias("url")
    d = table(spark, sf, "documents")
    parts = F.filter(T.split_lines(F.col("text")), lambda x: x != "")
    found = d.select(url, songs.clean_lyrics(parts).alias("lyrics"))
    listed = d.select(url, F.col("lang").alias("artist"), F.col("source").alias("title"))
    return songs.lyric_files(listed.join(found, "url")).select("file_name", "body")


@register("article_links", f"""
SELECT '/articles/?page=' || (doc_id // 20) AS url, pos::BIGINT AS pos,
       '{SEED_BASE}/articles/' || doc_id AS article_url
FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY doc_id // 20 ORDER BY doc_id) - 1 AS pos FROM documents)
WHERE lang = 'en'
""")
def q_article_links(spark, sf):
    """Absolute article URLs from listing cards. Cards get a link only for English documents here, so that cards
    without one occur; they are dropped."""
    d = table(spark, sf, "documents").select("doc_id", "lang").withColumn("block", F.floor(F.col("doc_id") / CARDS_PER_PAGE).cast("long"))
    href = F.when(F.col("lang") == "en", F.concat(F.lit("/articles/"), F.col("doc_id").cast("string")))
    cards = d.select(F.concat(F.lit("/articles/?page="), F.col("block").cast("string")).alias("url"), _position(["block"], "doc_id").alias("pos"),
                     T.absolute_url(SEED_BASE, href).alias("article_url"))
    return cards.where("article_url != ''")


# ---------------------------------------------------------------------------
# Cleaning rules on rows that hold every case: the same projection of whole
# columns on both sides
# ---------------------------------------------------------------------------
@register("line_rules", f"""
WITH l AS (SELECT doc_id, (u.i - 1) AS pos, u.line, lang, source
           FROM documents, unnest(string_split_regex(text, '{LB}')) WITH ORDINALITY AS u(line, i))
SELECT doc_id::BIGINT AS doc_id, pos::BIGINT AS pos,
       regexp_replace('[' || lang || '] ' || line, '(?s)\\[.*?\\]', '', 'g') AS no_brackets,
       replace(line || chr(8206), chr(8206), '') AS no_lrm,
       regexp_replace(chr(8234) || line || chr(8236), '[\\x{{202A}}-\\x{{202E}}]', '', 'g') AS no_bidi,
       regexp_replace(line || ' - ' || source, '{sql_quote(T.TRAILING_ARTIST)}', '') AS no_artist,
       {_sql_em("'  <em>' || line || '</em> '")} AS no_em,
       {sql_strip("'  ' || line || chr(12288)")} AS stripped,
       {sql_strip(f"regexp_replace(line || chr(10) || '  ' || chr(10) || lang, '\n{WS}*\n', chr(10) || chr(10), 'g')")} AS one_blank
FROM l
""")
def q_line_rules(spark, sf):
    """Every line with a bracket, marks, a trailing artist, tags, blanks and a blank line."""
    x = text_lines_of(table(spark, sf, "documents").select("doc_id", "lang", "source", "text"), ["doc_id", "lang", "source"])
    line, lang = F.col("line"), F.col("lang")
    return x.select(
        F.col("doc_id").cast("long"), "pos",
        T.remove_brackets(F.concat(F.lit("["), lang, F.lit("] "), line), multiline=True).alias("no_brackets"),
        T.remove_lrm(F.concat(line, F.lit("\u200e"))).alias("no_lrm"),
        T.remove_bidi_embedding(F.concat(F.lit("\u202a"), line, F.lit("\u202c"))).alias("no_bidi"),
        T.strip_trailing_artist(F.concat(line, F.lit(" - "), "source")).alias("no_artist"),
        T.strip_em(F.concat(F.lit("  <em>"), line, F.lit("</em> "))).alias("no_em"),
        T.strip(F.concat(F.lit("  "), line, F.lit("\u3000"))).alias("stripped"),
        T.collapse_blank_lines(F.concat(line, F.lit("\n  \n"), lang)).alias("one_blank"))


@register("field_rules", f"""
WITH p AS (SELECT p_partkey, p_name, p_type, p_brand, p_size, replace(p_type, ' ', ' – ') AS dashed,
                  '  ' || replace(p_name, ' ', '   ') || ' ' AS spaced, p_name || '/' || p_brand || '?*:"<>|.' AS path,
                  CASE WHEN p_size > 25 THEN 'x' || p_size ELSE p_size::VARCHAR END AS span, nullif(p_brand, 'Brand#1') AS brand,
                  CASE WHEN p_size > 40 THEN NULL ELSE p_brand END AS maybe
           FROM part)
SELECT p_partkey::BIGINT AS p_partkey, {sql_strip("replace(dashed, '–', '-')")} AS no_dash,
       array_to_string(list_filter(list_transform(string_split(spaced, ' '), lambda x: {sql_strip('x')}), lambda x: x <> ''), '+') AS joined,
       translate(path, '\\/*?:"<>|', '') AS file_name, coalesce(TRY_CAST(span AS INTEGER), 1) AS span,
       coalesce(maybe, 'none') AS defaulted, coalesce(nullif(maybe, ''), {sql_strip('upper(spaced)')}) AS first_upper
FROM p
""")
def q_field_rules(spark, sf):
    """T13 T14 T15 T18 T21 and the mapped take-first (§2.12) on fields that hold each case."""
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size")
    spaced = F.concat(F.lit("  "), F.replace("p_name", F.lit(" "), F.lit("   ")), F.lit(" "))
    size = F.col("p_size").cast("string")
    maybe = F.when(F.col("p_size") > 40, None).otherwise(F.col("p_brand"))
    return p.select(
        F.col("p_partkey").cast("long"), T.normalize_dash(F.replace("p_type", F.lit(" "), F.lit(" – "))).alias("no_dash"),
        T.join_nonempty(F.split(spaced, " "), "+").alias("joined"),
        T.sanitize_filename(F.concat("p_name", F.lit("/"), "p_brand", F.lit('?*:"<>|.'))).alias("file_name"),
        T.int_or_one(F.when(F.col("p_size") > 25, F.concat(F.lit("x"), size)).otherwise(size)).alias("span"),
        T.default(maybe, "none").alias("defaulted"),
        F.coalesce(maybe, T.field_pipeline(F.array(F.lit(""), spaced), [F.upper, T.strip])).alias("first_upper"))


# ---------------------------------------------------------------------------
# Hebrew profile on real rows: whole texts projected letter by letter onto the
# Hebrew block (letters, three points, maqaf), the same on both sides
# ---------------------------------------------------------------------------
LATIN = "abcdefghijklmnopqrstuvwxyz"
PROJECTED = "אבגד\u05b8הוז\u05b4חטיכל\u05b9מנסעפ\u05beצקרשת"
SQL_HEB = f"translate(lower(text), '{LATIN}', '{PROJECTED}')"
SQL_HEB_TOK = f"regexp_extract_all({SQL_HEB}, '[\u0590-\u05ff]+')"
SQL_HEB_FOLD = "regexp_replace(word, '[^א-ת]', '', 'g')"
SQL_HEB_CLEAN = "nullif(regexp_replace(word, '[\u05b4\u05b8\u05b9]', '', 'g'), '')"
SQL_HEB_SOURCES = SQL_WORD_SOURCES.replace(tok("text"), SQL_HEB_TOK)


def _hebrew(df: DataFrame) -> DataFrame:
    return df.withColumn("text", F.translate(F.lower("text"), LATIN, PROJECTED))


def _hebrew_sources(spark, sf) -> DataFrame:
    return frequency.word_sources({k: _hebrew(v) for k, v in C.corpora(spark, sf).items()}, "hebrew")


@register("hebrew_word_sources", SQL_HEB_SOURCES)
def q_hebrew_word_sources(spark, sf):
    """Counts per source of tokens of the Hebrew block."""
    return _hebrew_sources(spark, sf)


@register("hebrew_folded_sources", f"""
WITH ws AS ({SQL_HEB_SOURCES})
SELECT {SQL_HEB_FOLD} AS word, sum(songs)::BIGINT AS songs, sum(news)::BIGINT AS news, sum(youtube)::BIGINT AS youtube, sum(total)::BIGINT AS total
FROM ws WHERE {SQL_HEB_FOLD} <> '' GROUP BY 1
""")
def q_hebrew_folded_sources(spark, sf):
    """Counts by the key without points and maqaf."""
    return frequency.folded_sources(_hebrew_sources(spark, sf), "hebrew")


@register("hebrew_common_words", f"""
WITH ws AS ({SQL_HEB_SOURCES}), c AS (SELECT {SQL_HEB_CLEAN} AS word, sum(songs) AS l, sum(youtube) AS r FROM ws GROUP BY 1)
SELECT word, {SQL_HEB_FOLD} AS bare FROM c WHERE word IS NOT NULL AND l > 0 AND r > 0
""")
def q_hebrew_common_words(spark, sf):
    """Cleaned words of both corpora. Cleaning keeps the maqaf and folding drops it, so words that
    differ only there are two rows with one key."""
    both = lexicon.common_from_sources(_hebrew_sources(spark, sf), "songs", "youtube", "hebrew")
    return both.select("word", T.fold(F.col("word"), "hebrew").alias("bare"))


TITLE_LETTERS = ("ñß", "אב")


@register("hebrew_titles", """
SELECT doc_id::BIGINT AS doc_id, coalesce(regexp_matches(translate(text, 'ñß', 'אב'), '[\u0590-\u05ff]'), false) OR coalesce(regexp_matches(translate(source, '7', 'ג'), '[\u0590-\u05ff]'), false) AS has_script
FROM documents
""")
def q_hebrew_titles(spark, sf):
    """F1 on the Hebrew block: has the whole text or the source a character of it, with rare letters projected onto it."""
    d = table(spark, sf, "documents").select("doc_id", "text", "source")
    found = T.has_script(F.translate("text", *TITLE_LETTERS), "hebrew") | T.has_script(F.translate("source", "7", "ג"), "hebrew")
    return d.select(F.col("doc_id").cast("long"), found.alias("has_script"))


from . import cases, daily  # noqa: E402,F401  (they register their queries here)

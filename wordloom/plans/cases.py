"""Queries in which an operator's own case occurs and changes the result: mixed elements, guarded payloads, resumed fills,
shared identities, failing calls, lost songs, permutations, arrays and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import assemble as A
from ..operators import lexicon, sentences, songs
from ..session import run_folder
from ..sinks import committed
from ..sources import json_arrays
from ..sources.tables import payload_items, table
from . import corpus as C
from .catalog import LB, ORACLE, SQL_COVERAGE_CTES, SQL_FORMS, WS, _song_lines, _tokens_of, filled, register, sql_song_lines, sql_strip, vocab_words


# --- sources ------------------------------------------------------------------------
@register("json_array_scan", "SELECT doc_id::BIGINT AS doc_id, lang, md5(text) AS text_md5, true AS in_order FROM documents")
def q_json_array_scan(spark, sf):
    """All documents as JSON arrays, an array a partition, read back by byte ranges with their positions."""
    at = run_folder(spark, "arrays")
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("long"), "lang", "text")
    json_arrays.write(docs.repartitionByRange("doc_id"), at, ["doc_id"])
    got = json_arrays.records(spark, at, "doc_id long, lang string, text string")
    first = got.groupBy("file").agg(F.min("doc_id").alias("_first"))   # a row per array
    place = got.join(first, "file").withColumn("_before", F.lag("doc_id").over(_in_file()))
    in_order = F.when(F.col("ord") == 0, F.col("doc_id") == F.col("_first")).otherwise(F.col("_before") <= F.col("doc_id"))
    return place.select("doc_id", "lang", F.md5("text").alias("text_md5"), in_order.alias("in_order"))


def _in_file():
    from pyspark.sql import Window
    return Window.partitionBy("file").orderBy("ord")   # an array, the size of a partition


SQL_ELEMENT = "CASE p_size % 6 WHEN 4 THEN 'None' WHEN 5 THEN p_size::VARCHAR WHEN 2 THEN p_brand ELSE p_name END"


@register("mixed_elements", f"SELECT p_partkey::BIGINT AS p_partkey, {sql_strip(SQL_ELEMENT)} AS word FROM part")
def q_mixed_elements(spark, sf):
    """Elements that are strings, or objects whose first present key of word, hebrew and text counts, with its value a string, a null or a number."""
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    name, brand = F.to_json(F.array("p_name")), F.to_json(F.array("p_brand"))
    inner = lambda x: F.substring(x, 2, 1 << 20)  # noqa: E731  ("["x"]" without its first bracket)
    text = lambda x: F.regexp_replace(inner(x), r"\]$", "")
    kinds = {0: F.concat(F.lit("  "), "p_name", F.lit(" ")), 1: F.concat(F.lit('{"text": "x", "word": '), text(name), F.lit("}")), 2: F.concat(F.lit(' {"text": "x", "hebrew": '), text(brand), F.lit("}")),
             3: F.concat(F.lit('{"other": {"word": "y"}, "text": '), text(name), F.lit("}")), 4: F.concat(F.lit('{"word": null, "hebrew": '), text(name), F.lit("}")), 5: F.concat(F.lit('{"hebrew": '), F.col("p_size").cast("string"), F.lit("}"))}
    raw = F.coalesce(*[F.when(F.col("p_size") % 6 == k, v) for k, v in kinds.items()])
    return p.select(F.col("p_partkey").cast("long"), raw.alias("raw")).select("p_partkey", A.extract_word("raw").alias("word"))


RESULTS = "results array<struct<text:string, translations:array<array<struct<text:string>>>>>"


@register("guarded_payloads", f"""
SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, (u.i - 1)::BIGINT AS pos, u.line AS sentence, CASE WHEN (turn + u.i - 1) % 5 = 0 THEN role END AS translation
FROM conversations, unnest(string_split_regex(text, '{LB}')) WITH ORDINALITY AS u(line, i) WHERE turn <> 0
""")
def q_guarded_payloads(spark, sf):
    """Search responses as JSON text, one per turn. The first turn's has no list; translations are there, an empty
    group, an empty list, absent, or a group whose first text is null."""
    conv = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    one = lambda x: F.struct(x.alias("text"))
    none, group = F.lit(None).cast("string"), "array<array<struct<text:string>>>"

    def translations(k):
        return (F.when(k == 0, F.array(F.array(one(F.col("role"))))).when(k == 1, F.array(F.array().cast("array<struct<text:string>>"))).when(k == 2, F.array().cast(group))
                .when(k == 4, F.array(F.array(one(none), one(F.lit("second"))))))
    results = F.transform(T.split_lines(F.col("text")), lambda line, i: F.struct(line.alias("text"), translations((F.col("turn") + i) % 5).alias("translations")))
    body = F.when(F.col("turn") == 0, F.lit('{"other": []}')).otherwise(F.to_json(F.struct(results.alias("results"))))
    items = payload_items(conv.select("conv_id", "turn", body.alias("body")), RESULTS, "results", ["conv_id", "turn"])
    return items.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("item_pos").alias("pos"), F.col("item.text").alias("sentence"), sentences.translation_of(F.col("item.translations")).alias("translation"))


# --- sentences and meanings ------------------------------------------------------------
@register("resumed_fill", ORACLE["sentences_fill"].replace(SQL_COVERAGE_CTES, f"missing AS ({vocab_words('benchmark')})"))
def q_resumed_fill(spark, sf):
    """Every dictionary word, and rows without a word; those of the prior output are skipped, the others get
    up to three sentences of two tiers."""
    words = _tokens_of(spark, sf, "benchmark").select(T.fold(F.col("word"), C.PROFILE).alias("word"))
    absent = table(spark, sf, "benchmark").select(F.lit(None).cast("string").alias("word"))
    return filled(spark, sf, words.unionAll(absent))


@register("shared_meanings", f"WITH fi AS ({SQL_FORMS}) SELECT bare AS word, min(entry_id)::BIGINT AS entry_id, (entry_id // 3)::BIGINT AS page FROM fi GROUP BY bare, entry_id // 3")
def q_shared_meanings(spark, sf):
    """Three entries share a URL; a word keeps the first entry of each URL."""
    dic = C.dictionary(spark, sf).withColumn("word_url", F.concat(F.lit("page/"), F.floor(F.col("ord") / 3).cast("string")))
    return A.meaning_pairs(None, dic, C.PROFILE).select(F.col("bare").alias("word"), F.col("ord").alias("entry_id"), F.floor(F.col("ord") / 3).cast("long").alias("page"))


@register("harvest_traps", """
SELECT item_id::BIGINT AS ord, (p.i)::BIGINT AS pos, CASE p.i WHEN 0 THEN trim(text, ' ' || chr(9) || chr(10) || chr(13)) ELSE '' END AS form FROM benchmark, range(2) AS p(i)
""")
def q_harvest_traps(spark, sf):
    """JSON whose strings hold quoted keys, keys with other values, and nested lists: only strings stored under the key count."""
    b = table(spark, sf, "benchmark").select(F.col("item_id").cast("long").alias("ord"), "text")
    trap = F.concat(F.lit('say "hebrew": "no" and \\'), "text")
    doc = F.to_json(F.struct(trap.alias("a"), F.array(trap).alias("b"), F.struct(F.array(F.struct(F.lit(7).alias("hebrew"), F.struct(F.col("text").alias("hebrew")).alias("c"))).alias("hebrew")).alias("d"), F.lit("").alias("hebrew")))
    return lexicon.harvest_key(b.select("ord", doc.alias("doc")), "doc", "hebrew", ("ord",))


# --- songs --------------------------------------------------------------------------------
MARKS = ("#%$", "[]‪")
SQL_MARKED = f"translate(text, '{MARKS[0]}', '[]' || chr(8234))"


@register("song_pages", f"""
WITH p AS (SELECT doc_id, array_to_string(list_filter(string_split_regex({SQL_MARKED}, '{LB}'), lambda x: x <> ''), chr(10)) AS t FROM documents)
SELECT c_name || ' - ' || c_mktsegment || '.txt' AS file_name, c_mktsegment || ' - ' || c_name || chr(10) || chr(10) ||
       {sql_strip(f"regexp_replace(replace(regexp_replace(t, '\\[[^\\n]*?\\]', '', 'g'), chr(8234), ''), '\\n{WS}*\\n', chr(10) || chr(10), 'g')")} AS body
FROM p JOIN customer ON c_custkey = doc_id
""")
def q_song_pages(spark, sf):
    """Lyric pages of all documents, rare signs projected onto brackets and direction marks, joined to
    the songs of all customers; pages without a song and songs without a page vanish."""
    url = lambda c: F.concat(F.lit("https://lyrics.test/"), F.col(c).cast("string")).alias("url")
    parts = F.filter(T.split_lines(F.translate("text", *MARKS)), lambda x: x != "")
    found = table(spark, sf, "documents").select(url("doc_id"), songs.clean_lyrics(parts).alias("lyrics"))
    listed = table(spark, sf, "customer").select(url("c_custkey"), F.col("c_name").alias("artist"), F.col("c_mktsegment").alias("title"))
    return songs.lyric_files(listed.join(found, "url")).select("file_name", "body")


@register("failing_calls", """
WITH o AS (SELECT o_custkey AS ord, bool_or(o_orderstatus = 'P') AS failed, bool_or(o_orderstatus = 'O' AND o_orderpriority LIKE '1%') AS hit FROM orders GROUP BY 1)
SELECT CASE WHEN failed THEN CASE WHEN c_acctbal < 0 THEN 'EXCEPTION' ELSE 'ERROR' END WHEN hit THEN 'FOUND' ELSE 'NOT FOUND' END AS outcome, count(*)::BIGINT AS n
FROM customer LEFT JOIN o ON ord = c_custkey GROUP BY 1
""")
def q_failing_calls(spark, sf):
    """Outcomes of all songs with both kinds of failing calls; a song with a hit and a failed call counts as failed."""
    cust = table(spark, sf, "customer").select(F.col("c_custkey").alias("ord"), "c_name", "c_acctbal")
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("ord"), "o_orderkey", "o_orderstatus", "o_orderpriority")
    hits = orders.where((F.col("o_orderstatus") == "O") & F.col("o_orderpriority").startswith("1")).select("ord", F.col("o_orderkey").alias("hit_pos"), F.lit("/x").alias("path"))
    failed = orders.where(F.col("o_orderstatus") == "P").select("ord").join(cust, "ord").select("ord", F.when(F.col("c_acctbal") < 0, "EXCEPTION").otherwise("ERROR").alias("error"))
    return songs.resolve_first_hit(cust.select("ord", "c_name"), hits, failed)[1]


@register("permutation_evidence", f"""
WITH l AS ({sql_song_lines()})
SELECT (SELECT count(*) FROM l)::BIGINT AS n, (SELECT count(*) FROM l)::BIGINT AS n_distinct, true AS unrelated_to_input, true AS unrelated_to_other_seed, true AS same_again
""")
def q_permutation_evidence(spark, sf):
    """O2 K2: the shuffled lines hold every line once, their order has next to no correlation with the input's nor with
    that of another seed, and the same seed gives the same order again over another partitioning of the input."""
    at = run_folder(spark, "permutation")
    # the lines are made once; each permutation moves them whole, and what is kept and joined of it is a line's song, position and hash
    _song_lines(spark, sf).select(F.struct("song", "pos", "line").alias("line")).write.parquet(f"{at}/lines")
    lines = spark.read.parquet(f"{at}/lines")

    def placed(seed, df, name):
        brief = F.struct("line.song", "line.pos", F.xxhash64("line.line").alias("hash")).alias("line")
        songs.shuffled(df, seed).select(brief, F.monotonically_increasing_id().alias(name)).write.parquet(f"{at}/{name}")
        return spark.read.parquet(f"{at}/{name}")
    a, b, c = placed(1, lines, "a"), placed(2, lines, "b"), placed(1, lines.repartition("line"), "c")
    both = a.join(b, "line").join(c, "line")
    # a row per line and place, where the join left them: a distinct count beside the other sums would shuffle them all once more
    found = both.groupBy("line", "a").agg(F.count("*").alias("k"), F.min("b").alias("b"), F.bool_and(F.col("a") == F.col("c")).alias("again"))
    ordinal = F.col("line.song").cast("double") * 1e6 + F.col("line.pos")
    small = lambda x, y: F.coalesce(F.abs(F.corr(x, y)) < 0.1, F.lit(False))
    return found.agg(F.coalesce(F.sum("k"), F.lit(0)).alias("n"), F.count("*").alias("n_distinct"), small(F.col("a").cast("double"), ordinal).alias("unrelated_to_input"),
                     small(F.col("a").cast("double"), F.col("b").cast("double")).alias("unrelated_to_other_seed"), F.bool_and("again").alias("same_again"))


# --- sinks ------------------------------------------------------------------------------------
@register("committed_sinks", """
SELECT 'lines' AS sink, count(*)::BIGINT AS n, sum(length(text))::BIGINT AS chars, true AS as_expected FROM documents
UNION ALL SELECT 'kept after a failed write', count(*), 0, true FROM labels
UNION ALL SELECT 'batches', count(*), sum(length(text))::BIGINT, true FROM conversations
UNION ALL SELECT 'files', count(*), (sum(length(url)) + count(*))::BIGINT, true FROM pages
""")
def q_committed_sinks(spark, sf):
    """Documents as ordered JSON lines after a write that fails in one task, turns as batches of a
    hundred, a file per page; each read back from what its manifest names."""
    at = run_folder(spark, "sinks")
    whole = F.to_json(F.struct("*")).alias("value")
    committed.write(table(spark, sf, "labels").select(whole), f"{at}/lines")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    last = docs.agg(F.max("doc_id")).first()[0]
    try:
        committed.write(docs.select(F.when(F.col("doc_id") == last, F.raise_error(F.lit("a task is lost"))).otherwise(F.col("text")).cast("string").alias("value")), f"{at}/lines")
    except Exception as e:  # noqa: BLE001 - the failure is part of the query
        if "a task is lost" not in str(e):
            raise
    kept = committed.read(spark, f"{at}/lines").agg(F.count("*").alias("n")).first()[0]
    committed.write(docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id").select(whole), f"{at}/lines")
    read = committed.read(spark, f"{at}/lines").select("part", "pos", F.from_json("value", "doc_id long, text string").alias("r"))
    per_part = read.groupBy("part").agg(F.count("*").alias("n"), F.sum(F.length("r.text")).alias("chars"), F.min("r.doc_id").alias("low"), F.max("r.doc_id").alias("high"), F.min_by("r.doc_id", "pos").alias("first"), F.max_by("r.doc_id", "pos").alias("last"))
    later = per_part.select((F.col("part") - 1).alias("part"), F.col("low").alias("next"))
    ordered = F.bool_and((F.col("low") == F.col("first")) & (F.col("high") == F.col("last")) & (F.col("next").isNull() | (F.col("next") >= F.col("high"))))
    out = per_part.join(later, "part", "left").agg(F.lit("lines").alias("sink"), F.sum("n").alias("n"), F.sum("chars").alias("chars"), ordered.alias("as_expected"))
    out = out.unionAll(spark.range(1).select(F.lit("kept after a failed write"), F.lit(kept).cast("long"), F.lit(0).cast("long"), F.lit(True)))

    committed.write(table(spark, sf, "conversations").select(whole), f"{at}/batches", "batches")
    batches = committed.read(spark, f"{at}/batches").select("part", "pos", F.from_json("value", "array<struct<text:string>>").alias("b"))
    small = batches.where(F.size("b") < 100).groupBy("part").agg(F.count("*").alias("rest"))   # at most the last of a part
    sums = batches.select("part", F.size("b").alias("k"), F.aggregate("b", F.lit(0).cast("long"), lambda acc, x: acc + F.coalesce(F.length(x["text"]), F.lit(0))).alias("c"))
    fits = F.bool_and((F.col("k") <= 100) & (F.coalesce("rest", F.lit(0)) <= 1))
    out = out.unionAll(sums.join(small, "part", "left").agg(F.lit("batches"), F.sum("k").cast("long"), F.sum("c"), fits))

    pages = table(spark, sf, "pages").select(F.concat(F.lit("page "), F.col("page_id").cast("string"), F.lit(".txt")).alias("file_name"), F.concat(F.lit("\n"), "url").alias("body"))
    committed.write(pages, f"{at}/files", "files")
    files = committed.read(spark, f"{at}/files")
    return out.unionAll(files.agg(F.lit("files"), F.count("*"), F.sum(F.length("body")).cast("long"), F.bool_and(F.col("file_name").rlike("^page [0-9]+[.]txt$"))))


# --- markup of the given pages ---------------------------------------------------------------------
def _sql_text(tag: str, css: str = "") -> str:
    from .catalog import sql_unescape
    body = f"regexp_replace(regexp_extract(html, '(?s)<{tag}{css}>(.*?)</{tag}>', 1), '<[^>]*>', '', 'g')"
    return sql_unescape(f"replace(replace({body}, '&copy;', '©'), '&middot;', '·')")


@register("page_elements", f"""
SELECT page_id::BIGINT AS page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) AS page_lang, {sql_strip(_sql_text('h1'))} AS heading, {_sql_text('footer')} AS footer,
       {_sql_text('div', ' class="ad"')} AS ad,
       array_to_string(regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), 'href="([^"]*)"', 1), '|') AS hrefs,
       len(regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<li>'))::BIGINT AS n_items
FROM pages
""")
def q_page_elements(spark, sf):
    """Elements cut by balance, class tokens, attributes and every character reference, on the given pages."""
    from ..sources import markup as M
    p = table(spark, sf, "pages").select("page_id", F.regexp_replace("html", M._NO_MARKUP, "").alias("html"))
    html = F.col("html")
    p = p.withColumns({"_html": F.get(M._open_tags(html, "html"), 0), "_h1": M.inner(html, "h1"), "_footer": M.inner(html, "footer"), "_ad": M.inner(html, "div", M.has_class("ad")), "_nav": M.inner(html, "nav", None, True)})
    p = p.withColumn("_li", M._below(F.col("_nav"), lambda n: M.inner(n, "li")))
    p = p.withColumn("_href", M._below(F.col("_li"), M._hrefs))
    text = lambda c: F.coalesce(F.array_join(M.texts(F.get(c, 0)), ""), F.lit(""))
    return p.select(F.col("page_id").cast("long"), M.attribute(F.col("_html"), "lang").alias("page_lang"), T.strip(text("_h1")).alias("heading"), text("_footer").alias("footer"), text("_ad").alias("ad"),
                    F.array_join(M._unescaped(F.col("_href")), "|").alias("hrefs"), F.size("_li").cast("long").alias("n_items"))


@register("cell_priority", f"""
SELECT p_partkey::BIGINT AS p_partkey, CASE p_size % 4 WHEN 0 THEN {sql_strip("replace('~ ' || p_brand, '~', '')")} WHEN 1 THEN {sql_strip('p_name')} WHEN 2 THEN {sql_strip('p_name')} ELSE '' END AS form FROM part
""")
def q_cell_priority(spark, sf):
    """Cells with a chaser, an empty one, none, and one that is empty without its mark."""
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    kind = F.col("p_size") % 4
    chaser = F.when(kind == 0, F.concat(F.lit("~ "), "p_brand")).when(kind == 1, F.lit("")).when(kind == 3, F.lit(" ~ "))
    from ..sources.markup import cell_form
    return p.select(F.col("p_partkey").cast("long"), cell_form(chaser, F.col("p_name")).alias("form"))


@register("file_round_trips", f"""
SELECT 'line' AS source, u.line AS value, count(*)::BIGINT AS n FROM benchmark, unnest(string_split_regex(text, '{LB}')) AS u(line) GROUP BY 2
UNION ALL SELECT 'csv', c_name || ',' || c_mktsegment, count(*) FROM customer GROUP BY 2
UNION ALL SELECT 'table', coalesce(s_name, '') || '//-/' || s_suppkey, count(*) FROM supplier GROUP BY 2
UNION ALL SELECT 'prior', r_name, count(*) FROM region GROUP BY 2
""")
def q_file_round_trips(spark, sf):
    """Text lines, a spreadsheet export, the word table's defaults and a prior output that may be absent,
    each written and read back."""
    from ..sinks import writers
    from ..sources import tables as S
    at = run_folder(spark, "files")
    lines = table(spark, sf, "benchmark").select(F.explode(T.split_lines(F.col("text"))).alias("line"))
    writers.write_lines(lines, f"{at}/lines")
    out = S.text_lines(spark, f"{at}/lines").select(F.lit("line").alias("source"), "value")
    writers.write_csv(table(spark, sf, "customer").select("c_name", "c_mktsegment"), f"{at}/csv")
    assert not writers.write_csv(table(spark, sf, "customer").select("c_name").where("false"), f"{at}/none")
    out = out.unionAll(spark.read.option("header", True).csv(f"{at}/csv").select(F.lit("csv"), F.concat_ws(",", "c_name", "c_mktsegment")))
    words = writers.sql_defaults(table(spark, sf, "supplier").select(F.col("s_name").alias("hebrew"), F.lit(None).cast("string").alias("root"), F.col("s_suppkey").cast("string").alias("word_url")))
    out = out.unionAll(words.select(F.lit("table"), F.concat_ws("/", "hebrew", "transcription", "root", "word_url")))
    region = table(spark, sf, "region").select("r_name")
    prior = S.optional(spark, f"{at}/prior", region.schema)   # absent on the first run
    prior.unionAll(region).write.parquet(f"{at}/prior")
    again = S.optional(spark, f"{at}/prior", region.schema)
    return out.unionAll(again.select(F.lit("prior"), "r_name")).groupBy("source", "value").agg(F.count("*").alias("n"))

"""Pieces of web pages as Column expressions over the raw html.

Each page kind has fixed element and class names (fixed values below, next to
the fields they give). An extractor is a tree of Column functions, so
extraction stays inside the scan stage: no Python, no shuffle, and Catalyst
prunes pieces nobody uses. Item processors (strip, join, defaults) are applied
by ``operators.pages``.

Elements are cut by balance: the html is split at the tags of a name, a running
sum over +1 (open) and -1 (close) is the depth at each, and an element reaches
to the first tag where the depth falls below its own. Classes are matched as
tokens of the attribute, attributes may stand in either quotes or none, tag and
attribute names in either case, and comments, scripts and styles are no markup.
An element that is never closed reaches to the end of its parent.
"""

from __future__ import annotations

from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import NO_RESULTS_TEXT
from ..functions import text as T
from ..functions.columns import bound, depths

_SPAN = "struct<text:string,colspan:int,rowspan:int>"
_CELL_TYPE = "struct<hebrew:string,transcription:string,meaning:string>"
TABLE_TYPE = f"struct<headers:array<array<{_SPAN}>>,rows:array<struct<labels:array<string>,cells:array<{_CELL_TYPE}>>>>"
# a tag with quoted attributes; the second form for a quote that is never closed
_TAG = r"""</?[a-zA-Z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>|</?[a-zA-Z][^>]*+>"""
_NO_MARKUP = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1\s*>|\z)|<[!?][^>]*>"
# elements without content
_CLOSED = r"""(?:["'\s]|^<[a-zA-Z][a-zA-Z0-9-]*)/>$"""   # an unquoted value may end with a slash
_VOID = rf"(?i)^<(?:area|base|br|col|embed|hr|img|input|link|meta|param|source|track|wbr)[\s/>]|{_CLOSED}"


# --- character references -----------------------------------------------------
_BARE = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))  # names that need no semicolon
_REFERENCE = r"&(?:#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[a-zA-Z][a-zA-Z0-9]*+;|" + "|".join(f"(?:{n})" for n in _BARE) + ")"
# code points that a numeric reference may not name: the C1 controls mean their Windows-1252 characters
_C1 = {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}


def _named() -> Column:
    """Names to characters; a constant, folded when a plan is made."""
    return F.str_to_map(F.lit("\x01".join(f"{n}\x02{c}" for n, c in sorted(html5.items()))), F.lit("\x01"), F.lit("\x02"))


def _code_point(cp: Column) -> Column:
    """The character of a numeric reference; the replacement character for none, nothing for controls and noncharacters."""
    char = F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32")
    c1 = F.element_at(F.map_from_arrays(F.array(*map(F.lit, _C1)), F.array(*map(F.lit, _C1.values()))), cp)
    nothing = cp.between(1, 8) | (cp == 11) | cp.between(14, 31) | (cp == 127) | cp.between(0xFDD0, 0xFDEF) | (cp.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    return F.when((cp == 0) | cp.between(0xD800, 0xDFFF) | (cp > 0x10FFFF), "\ufffd").when(cp == 13, "\r").when(cp.between(128, 159), c1) \
        .when(nothing, "").otherwise(char)


def _reference(ref: Column) -> Column:
    number = lambda base, digits: F.coalesce(F.least(F.conv(F.substring(digits, 1, 12), base, 10).cast("long"), F.lit(0x110000)), F.lit(0))
    digits = F.regexp_replace(ref, r"^&#[xX]?0*|;$", "")
    # a known name that needs no semicolon, followed by other letters
    name = F.regexp_extract(ref, "^&(" + "|".join(_BARE) + ")", 1)
    return F.when(ref.rlike("^&#[xX]"), _code_point(number(16, digits))).when(ref.startswith("&#"), _code_point(number(10, digits))) \
        .otherwise(F.coalesce(F.element_at(_named(), F.substring(ref, 2, 1 << 20)), F.concat(F.element_at(_named(), F.nullif(name, F.lit(""))), F.substr(ref, F.length(name) + 2)), ref))


def unescape(x: Column) -> Column:
    """Character references of HTML: named ones with and without semicolon, decimal and hexadecimal ones."""
    whole = bound(F.regexp_extract_all(x, F.lit(_REFERENCE), F.lit(0)), lambda refs: F.array_join(
        F.transform(F.split(x, _REFERENCE, -1), lambda gap, i: F.when(i == 0, gap).otherwise(F.concat(_reference(F.get(refs, i - 1)), gap))), ""))
    return F.when(x.contains("&"), whole).otherwise(x)


def _unescaped(values: Column) -> Column:
    return F.transform(values, unescape)


# --- elements ---------------------------------------------------------------------
def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of an open tag as it is written, NULL where it has none."""
    pattern = rf"""(?is)^<[a-z][^\s/>]*+(?:[\s/]++(?!{name}[\s=>/])[^\s"'>/=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?+)*+[\s/]++{name}\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++)"""
    raw = F.nullif(F.regexp_extract(tag, pattern, 1), F.lit(""))
    return F.regexp_replace(raw, r"""(?s)^["'](.*)["']$""", "$1")


def has_class(*names: str) -> Callable[[Column], Column]:
    """Condition on an open tag: its class list holds all the names."""
    return lambda tag: _all_of([F.array_contains(F.split(F.coalesce(attribute(tag, "class"), F.lit("")), r"\s+", -1), n) for n in names])


def has(name: str, value: str) -> Callable[[Column], Column]:
    return lambda tag: F.coalesce(attribute(tag, name) == value, F.lit(False))


def _all_of(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def _opening(piece: Column) -> Column:
    return F.regexp_extract(piece, f"^(?:{_TAG})", 0)


def elements(fragment: Column, tag: str, match: Callable[[Column], Column] | None = None, outermost: bool = False) -> Column:
    """The elements of a name (or ``a|b``) in a fragment: array<struct<tag, inner>>, in page order.

    ``outermost`` drops elements inside another one that matches: what lies
    below a chain of selectors is then found once.
    """
    def over(pieces: Column) -> Column:
        kind = lambda p: F.when(p.startswith("</"), -1).when(p.rlike(rf"(?i)^<(?:{tag})[\s/>]") & ~_opening(p).rlike(_CLOSED), 1).otherwise(0)
        return bound(depths(F.transform(pieces, kind)), lambda depth: cut(pieces, depth))

    def cut(pieces: Column, depth: Column) -> Column:
        # before piece i the depth is depth[i], after it depth[i + 1]
        at = F.filter(F.sequence(F.lit(0), F.size(pieces) - 1), lambda i: (F.get(depth, i + 1) > F.get(depth, i)) & (match(_opening(F.get(pieces, i))) if match else F.lit(True)))
        below = lambda i: F.array_position(F.transform(F.slice(depth, i + 3, F.size(pieces)), lambda d: d <= F.get(depth, i)), True).cast("int")
        found = F.transform(at, lambda i: F.struct(i.alias("i"), F.coalesce(F.nullif(below(i), F.lit(0)) - 1, F.size(pieces)).alias("n")))
        if outermost:
            start = F.struct(F.lit(0).alias("stop"), F.array().cast("array<struct<i:int,n:int>>").alias("kept"))
            found = F.aggregate(found, start, lambda acc, x: F.when(x["i"] < acc["stop"], acc).otherwise(
                F.struct((x["i"] + 1 + x["n"]).alias("stop"), F.concat(acc["kept"], F.array(x)).alias("kept"))), lambda acc: acc["kept"])
        return F.transform(found, lambda x: F.struct(_opening(F.get(pieces, x["i"])).alias("tag"), F.concat(
            F.regexp_replace(F.get(pieces, x["i"]), f"^(?:{_TAG})", ""), F.array_join(F.slice(pieces, x["i"] + 2, x["n"]), "")).alias("inner")))
    # a fragment without the name is not looked into
    return F.when(fragment.rlike(rf"(?i)<(?:{tag})[\s/>]"), bound(F.split(fragment, rf"(?i)(?=</?(?:{tag})[\s/>])", -1), over)) \
        .otherwise(F.array().cast("array<struct<tag:string,inner:string>>"))


def inner(fragment: Column, tag: str, match: Callable[[Column], Column] | None = None, outermost: bool = False) -> Column:
    """Contents of ``elements``."""
    return F.transform(elements(fragment, tag, match, outermost), lambda e: e["inner"])


def _first(contents: Column) -> Column:
    """First content, NULL where there is none."""
    return F.get(contents, 0)


def _below(contents: Column, then: Callable[[Column], Column]) -> Column:
    """What ``then`` finds in each content, one after the other."""
    return F.flatten(F.transform(contents, then))


# --- text nodes --------------------------------------------------------------------
def _raw_texts(fragment: Column) -> Column:
    return F.filter(F.split(fragment, _TAG, -1), lambda v: v != "")


def texts(fragment: Column) -> Column:
    """Text nodes of a fragment in document order (empty ones dropped)."""
    return _unescaped(_raw_texts(fragment))


def _nodes(fragment: Column, wanted: Callable[[Column], Column]) -> Column:
    """Text nodes, as they are written, whose depth in the fragment's elements is ``wanted``."""
    delta = F.transform(F.regexp_extract_all(fragment, F.lit(f"({_TAG})"), F.lit(1)), lambda t: F.when(t.startswith("</"), -1).when(t.rlike(_VOID), 0).otherwise(1))
    placed = bound(depths(delta), lambda depth: F.transform(F.split(fragment, _TAG, -1), lambda v, i: F.when((v != "") & wanted(F.get(depth, i)), v)))
    return F.filter(placed, lambda v: v.isNotNull())


def _own(fragment: Column) -> Column:
    return _nodes(fragment, lambda depth: depth <= 0)


def _inside(fragment: Column) -> Column:
    return _nodes(fragment, lambda depth: depth > 0)


def own_texts(fragment: Column) -> Column:
    """Text nodes outside the fragment's child elements."""
    return _unescaped(_own(fragment))


def inner_texts(fragment: Column) -> Column:
    """Text nodes inside the fragment's child elements."""
    return _unescaped(_inside(fragment))


# --- page kinds ----------------------------------------------------------------------
def _dict_row(tr: Column) -> dict[str, Column]:
    roots = F.filter(_below(inner(tr, "td"), lambda td: elements(td, "a")), lambda a: F.coalesce(attribute(a["tag"], "href"), F.lit("")).contains("num-radicals"))
    words = F.filter(elements(tr, "a"), lambda a: F.size(elements(a["inner"], "span", has_class("menukad"))) > 0)
    return {
        "hebrew_parts": _below(inner(tr, "span", has_class("menukad")), _own),
        "transcription_nodes": _below(inner(tr, "span", has_class("dict-transcription"), True), _raw_texts),
        "root_nodes": _below(_inner_of(roots), _own),
        "pos_nodes": F.coalesce(_raw_texts(F.get(inner(tr, "td", None, True), 2)), F.array().cast("array<string>")),
        "meaning_parts": _below(inner(tr, "td", has_class("dict-meaning")), _own),
        "audio": _values(elements(tr, "span", has_class("audio-play")), "data-audio"),
        "href": _values(words, "href"),
    }


def cell_form(chaser: Column, menukad: Column) -> Column:
    """The chaser's form without ``~`` where there is one, else the pointed form; both stripped."""
    return F.when(F.coalesce(chaser, F.lit("")) != "", T.strip(F.replace(chaser, F.lit("~"), F.lit("")))).otherwise(T.strip(F.coalesce(menukad, F.lit(""))))


def _cell(td: Column) -> Column:
    node = lambda css: F.get(_below(inner(td, "span", has_class(css)), _own), 0)
    part = lambda css: F.array_join(_below(inner(td, "div", has_class(css), True), _inside), "")
    return F.struct(node("chaser").alias("chaser"), node("menukad").alias("menukad"), part("transcription").alias("transcription"), part("meaning").alias("meaning"))


def _read_cell(c: Column) -> Column:
    """A cell of written text nodes with its references decoded."""
    return F.struct(cell_form(unescape(c["chaser"]), unescape(c["menukad"])).alias("hebrew"), T.strip(unescape(c["transcription"])).alias("transcription"), T.strip(unescape(c["meaning"])).alias("meaning"))


def _header(th: Column) -> Column:
    span = lambda name: T.int_or_one(attribute(th["tag"], name))
    return F.struct(T.strip(unescape(F.coalesce(F.get(_raw_texts(th["inner"]), 0), F.lit("")))).alias("text"), span("colspan").alias("colspan"), span("rowspan").alias("rowspan"))


def _labels(tr: Column) -> Column:
    found = F.filter(F.transform(inner(tr, "th"), lambda th: F.get(_raw_texts(th), 0)), lambda v: v.isNotNull())
    return F.transform(found, lambda v: T.strip(unescape(v)))


def _tables(pages: DataFrame) -> DataFrame:
    """Tables of every page, cut level by level; what belongs together is told by position (t, r)."""
    part = lambda tag: _numbered("_t", lambda t: _below(inner(t, tag, None, True), lambda body: inner(body, "tr")))
    df = pages.withColumn("_t", inner(F.col("_html"), "table", has_class("conjugation-table")))
    df = df.withColumns({"_head": part("thead"), "_row": part("tbody")})
    df = df.withColumns({"_head": F.transform("_head", lambda x: F.struct(x["of"].alias("t"), elements(x["v"], "th").alias("th"))),
                         "_row": F.transform("_row", lambda x: F.struct(x["of"].alias("t"), x["v"].alias("tr"), inner(x["v"], "td").alias("td")))})
    df = df.withColumns({"_head": F.transform("_head", lambda x: F.struct(x["t"].alias("t"), F.transform(x["th"], _header).alias("cells"))),
                         "_row": F.transform("_row", lambda x: F.struct(x["t"].alias("t"), _labels(x["tr"]).alias("labels"), F.transform(x["td"], _cell).alias("cells")))})
    df = df.withColumn("_row", F.transform("_row", lambda x: F.struct(x["t"].alias("t"), F.when(F.size(x["labels"]) > 0, x["labels"]).alias("labels"), F.transform(x["cells"], _read_cell).alias("cells"))))
    headers = lambda t: F.transform(F.filter("_head", lambda x: (x["t"] == t) & (F.size(x["cells"]) > 0)), lambda x: x["cells"])
    rows = lambda t: F.transform(F.filter("_row", lambda x: x["t"] == t), lambda x: x.dropFields("t"))
    return df.withColumn("tables", F.transform("_t", lambda _, t: F.struct(headers(t).alias("headers"), rows(t).alias("rows"))))


def _numbered(values: str, find: Callable[[Column], Column]) -> Column:
    """array<struct<of, v>>: what ``find`` finds in each value, with the value's position."""
    return F.flatten(F.transform(values, lambda x, i: F.transform(find(x), lambda v: F.struct(i.alias("of"), v.alias("v")))))


def _inner_of(found: Column) -> Column:
    return F.transform(found, lambda e: e["inner"])


def _values(found: Column, name: str) -> Column:
    """Values of an attribute of elements that have it."""
    return F.filter(F.transform(found, lambda e: attribute(e["tag"], name)), lambda v: v.isNotNull())


def _open_tags(fragment: Column, tag: str) -> Column:
    return F.regexp_extract_all(fragment, F.lit(rf"""(?i)(<{tag}(?=[\s/>])(?:[^>"']++|"[^"]*+"|'[^']*+')*+>)"""), F.lit(1))


def _of_tags(tags: Column, name: str) -> Column:
    return F.filter(F.transform(tags, lambda t: attribute(t, name)), lambda v: v.isNotNull())


def _sources(fragment: Column) -> Column:
    """Audio addresses."""
    return _of_tags(_below(inner(fragment, "audio"), lambda a: _open_tags(a, "source")), "src")


def _hrefs(fragment: Column) -> Column:
    return _of_tags(_open_tags(fragment, "a"), "href")


def _card(li: Column) -> Column:
    definition = _below(inner(li, "div", has_class("definition"), True), lambda d: inner(d, "div", has_class("text"), True))
    return F.struct(
        F.coalesce(F.get(_below(inner(li, "h3", has_class("termName")), _own), 0), F.lit("")).alias("hebrew"),
        F.coalesce(_first(_sources(li)), F.lit("")).alias("audio_url"),
        _below(definition, _inside).alias("text_parts"),
        _below(inner(li, "div", has_class("moreText"), True), _inside).alias("more_parts"))


def _read_card(c: Column) -> Column:
    return F.struct(unescape(c["hebrew"]).alias("hebrew"), unescape(c["audio_url"]).alias("audio_url"), _unescaped(c["text_parts"]).alias("text_parts"), _unescaped(c["more_parts"]).alias("more_parts"))


_BOX = "div|section|article|main|li|span|p"   # elements that a bare class selector is looked for in


def _side(example: Column, name: str) -> Column:
    """Written text of the first ``text`` element below a side of an example, NULL where there is none."""
    return F.array_join(_raw_texts(_first(_below(inner(example, _BOX, has_class(name), True), lambda x: inner(x, _BOX, has_class("text"))))), "")


def _paragraphs(fragment: Column) -> Column:
    """Text nodes per paragraph; one that is not closed ends where the next begins."""
    pieces = F.split(fragment, r"<p\b[^>]*>", -1)
    return F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), lambda p: texts(F.substring_index(p, "</p>", 1)))


def _all(x: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(x, F.lit("(?s)" + pattern), F.lit(group))


def _elements(tag: str) -> str:
    """Pattern of the content of an element that never holds one of its own name."""
    return rf"<{tag}\b[^>]*>(.*?)</{tag}>"


def _chain(pages: DataFrame, name: str, *selectors: tuple) -> DataFrame:
    """``pages`` with a column of the contents below a chain of selectors (tag, condition), found step by step."""
    df = pages.withColumn(name, F.array("_html"))
    for k, (tag, match) in enumerate(selectors, 1):
        df = df.withColumn(name, _below(F.col(name), lambda x: inner(x, tag, match, k < len(selectors))))  # noqa: B023 - used at once
    return df


def _page(pages: DataFrame, kind: str) -> tuple[DataFrame, list[str]]:
    """``pages`` with the kind's columns, and their names."""
    html = F.col("_html")
    if kind == "tables":
        return _tables(pages), ["tables"]
    if kind == "lexicon":
        df = _chain(pages, "_box", ("div", has_class("contentByLetterContainer")), ("div", None))
        df = _chain(df, "_card", ("ul", has_class("contentByLetter")), ("li", has_class("introBlock")))
        df = df.withColumns({"_card": F.transform("_card", _card), "no_results": F.exists("_box", lambda b: F.array_join(_raw_texts(b), "").contains(NO_RESULTS_TEXT))})
        return df.withColumn("cards", F.transform("_card", _read_card)), ["no_results", "cards"]
    if kind == "article":
        df = _chain(pages, "_content", (_BOX, has_class("content")), ("ul", None))   # explanations
        df = df.withColumns({"_li": _below(F.col("_content"), lambda u: inner(u, "li")), "_body": inner(html, _BOX, has_class("content"), True),
                             "_value": _below(inner(html, _BOX, has_class("itemDetails"), True), lambda d: inner(d, _BOX, has_class("value"))), "_h1": inner(html, "h1"), "_audio": _sources(html)})
        first = lambda x: T.strip(unescape(F.coalesce(F.get(_below(F.col(x), _own), 0), F.lit(""))))
        df = df.withColumns({"title": first("_h1"), "category": first("_value"), "audio_urls": _unescaped(F.col("_audio")), "paragraphs": _below(F.col("_body"), _paragraphs), "explanations": F.transform("_li", texts)})
        return df, ["title", "category", "audio_urls", "paragraphs", "explanations"]
    if kind == "article_links":
        df = _chain(pages, "_card", (_BOX, has_class("catalogItemContainer")))
        df = df.withColumn("hrefs", F.transform("_card", lambda c: F.coalesce(_first(_below(inner(c, "h2", has_class("insideTitle")), _hrefs)), F.lit(""))))
        return df.withColumns({"n_cards": F.size("_card"), "hrefs": _unescaped(F.col("hrefs"))}), ["n_cards", "hrefs"]
    if kind == "lyrics":
        df = _chain(pages, "_song", ("div", has("data-lyrics-container", "true"))).withColumn("parts", _below(F.col("_song"), _own))
        return df.withColumn("parts", _unescaped(F.col("parts"))), ["parts"]
    if kind == "pagination":
        df = pages.withColumn("_box", _first(inner(html, "ul", has_class("pagination"))))
        df = df.withColumns({"active_href": _first(_below(inner(F.col("_box"), "li", has_class("active")), _hrefs)), "links": F.coalesce(_hrefs(F.col("_box")), F.array().cast("array<string>"))})
        return df.withColumns({"active_href": unescape(F.col("active_href")), "links": _unescaped(F.col("links"))}), ["active_href", "links"]
    if kind == "page":
        one = lambda tag: F.get(_all(html, _elements(tag)), 0)
        df = pages.withColumns({"title": F.array_join(texts(one("title")), ""), "nav_links": _unescaped(_all(F.coalesce(one("nav"), F.lit("")), r'<a\b[^>]*href="([^"]*)"')),
                                "paragraphs": F.coalesce(_paragraphs(one("article")), F.array())})
        return df, ["title", "nav_links", "paragraphs"]
    raise ValueError(f"unknown page kind {kind!r}")


def _records(pages: DataFrame, kind: str, keep: tuple[str, ...]) -> DataFrame:
    """A row per record: ``keep``, the record's position ``item`` and its columns."""
    if kind == "dict_rows":
        df = _chain(pages, "_tr", ("table", has_class("dict-table-t")), ("tbody", None), ("tr", None)).select(*keep, F.posexplode("_tr").alias("item", "_tr"))
        df = df.select(*keep, "item", *[v.alias(k) for k, v in _dict_row(F.col("_tr")).items()])
        lists = [c for c in df.columns if c.endswith(("_parts", "_nodes"))]
        return df.select(*keep, "item", *[_unescaped(F.col(c)).alias(c) for c in lists], _unescaped(F.col("audio")).alias("audio"), unescape(_first(F.col("href"))).alias("href"))
    if kind == "chart":
        df = _chain(pages, "_cell", ("td", has_class("text", "mp")), ("div", None)).select(*keep, F.posexplode("_cell").alias("item", "_cell"))
        return df.select(*keep, "item", F.col("item").alias("pos"), texts(F.col("_cell")).alias("pieces"))
    df = _chain(pages, "_example", (_BOX, has("id", "examples-content")), (_BOX, has_class("example"))).select(*keep, F.posexplode("_example").alias("item", "_example"))
    df = df.select(*keep, "item", F.col("item").alias("pos"), _side(F.col("_example"), "src").alias("src"), _side(F.col("_example"), "trg").alias("trg")).where("src is not null and trg is not null")
    return df.select(*keep, "item", "pos", unescape(F.col("src")).alias("src"), unescape(F.col("trg")).alias("trg"))


def extract(pages: DataFrame, kind: str, html_col: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """Pieces of every page: one row per record, with ``keep`` and the record's position ``item``."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    if kind != "page":   # pages of the web sites: without comments, scripts and styles
        html = F.regexp_replace(html, _NO_MARKUP, "")
    pages = pages.select(*keep, html.alias("_html"))
    if kind in ("dict_rows", "chart", "examples"):
        return _records(pages, kind, keep)
    df, names = _page(pages, kind)
    return df.select(*keep, F.lit(0).alias("item"), *names)

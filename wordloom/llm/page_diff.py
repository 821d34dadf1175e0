"""Main text of web pages by nearest-URL page differencing.

Pages are cut into text lines (blocks). Within each host, the distinct URL paths
are sorted, and every path is paired with its neighbour of the longest common
prefix. A page's lines are aligned with its mate's by a longest common
subsequence, and shared lines are deleted: what two pages of a site have in
common is furniture.

Markup says more where it is explicit. Lines in elements that are furniture by
name (nav, footer, form, ...), role or class (ad, comments, ...) go whether
shared or not. Articles of one site quote the same passages, so a line inside
``article`` or ``main`` goes only if both references of the page (see below)
share it and it is shorter than ``PASSAGE``, or, where there is one reference,
if that one shares it and it is shorter than ``PROSE``. On pages with such
elements a line outside them stays if it is not shared and at least ``PROSE``
long: text beside a teaser.

The same article under another URL is no mate. Paths whose pages have equal
lines outside furniture are one class, and mates are taken from other classes.
A copy with small changes is known by what it does not share with a second
reference, the next nearest class: if the mate has nearly all of that remainder
(``COPY``), the page is differenced against the second reference instead. A page
that has no line of its own is kept whole.

Line hashes of one page per class, not texts, travel to the mates; the pages are
shuffled once. The neighbour search sorts (host, path) keys by range, so a host
with a third of all pages is spread over many tasks.

Defined results: null and empty html give an empty text. A page without URL, or
whose host has no other class, has no mate. Pages that share a path share a mate;
repeated rows give repeated results. Further columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm import common, kernel

COPY = 0.05            # a copy has short changes only, and at most this share of the characters of its remainder
PROSE = 60             # characters from which a line is taken to be prose
PASSAGE = 200          # characters from which a line inside an article is a quotation though both references share it
MATCHES = 2_000_000    # beyond so many equal line pairs, sequences are halved before they are aligned; either way is exact
OFTEN = 64             # lines found more often keep their row of bits

RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "object", "xmp"}
FURNITURE = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "label", "head"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar"}
MAIN = {"article", "main"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "s", "samp", "small", "span",
          "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img"}
OPTIONAL = {"p", "li", "option", "dt", "dd", "tr", "td", "th", "thead", "tbody"}   # closed by their like; open ones matter only as furniture
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
NAMES = re.compile(r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|banner|breadcrumbs?|comments?|comment-list|cookies?|consent|disqus|footer|header|masthead|menu|modal|nav|navbar|navigation|"
                   r"newsletter|notices?|pager|pagination|popup|promo|promoted|related|replies|respond|share|sharing|sidebar|social|sponsor(?:ed)?|subscribe|toolbar|widget)(?:$|[\s_-])", re.I)
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?|<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:[^<>"']++|"[^"]*+"|'[^']*+')*+[^<>]*+)>""", re.S)
ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
SPACE = re.compile(r"\s+")
_tokens = {}


def _furniture(tag: str, attributes: str, inside_main: bool) -> bool:
    if tag in FURNITURE or (tag == "header" and not inside_main):
        return True
    if not attributes or tag in ("html", "body") or tag in MAIN and not NAMES.search(attributes):
        return False
    for k, v in ATTRIBUTE.findall(attributes):
        v = v.strip("\"'").lower()
        if k.lower() == "role" and v in ROLES or k.lower() in ("class", "id") and NAMES.search(v):
            return True
    return False


def lines(page: str | None) -> list[tuple[str, int]]:
    """(line, zone) in page order; zone 0: furniture by markup, 1: elsewhere, 2: inside article or main."""
    out: list[tuple[str, int]] = []
    stack: list[tuple[str, int]] = []   # open elements that are not inline, with the zone inside them
    parts: list[str] = []
    zone, at = 1, 0
    if not page:
        return out

    def flush() -> None:
        if parts:
            line = SPACE.sub(" ", entities.unescape("".join(parts))).strip()
            if line:
                out.append((line, zone))
            parts.clear()

    while at < len(page):
        m = TAG.search(page, at)
        if not m:
            parts.append(page[at:])
            break
        parts.append(page[at: m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                parts.append(entities.escape(m[0][9:].removesuffix("]]>")))
            continue
        if tag in INLINE:
            continue
        if m[1]:
            flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    zone = stack[-1][1] if stack else 1
                    break
            continue
        flush()
        if tag in RAW and not m[3].endswith("/"):
            end = _close(tag).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID and not m[3].endswith("/"):
            if tag in OPTIONAL and stack and stack[-1][0] == tag:   # it ends its like
                stack.pop()
                zone = stack[-1][1] if stack else 1
            if zone and _furniture(tag, m[3], zone == 2):
                zone = 0
                stack.append((tag, zone))
            elif tag not in OPTIONAL:
                if zone and (tag in MAIN or 'role="main"' in m[3]):
                    zone = 2
                stack.append((tag, zone))
    flush()
    return out


def _close(tag: str) -> re.Pattern:
    if tag not in _tokens:
        _tokens[tag] = re.compile(rf"</{tag}\b[^>]*>?", re.I)
    return _tokens[tag]


def line_hashes(found: list[tuple[str, int]]) -> np.ndarray:
    """64-bit hash of every line."""
    out = np.zeros(len(found), np.uint64)
    separators = np.zeros(256, bool)
    for first, last, data, offsets in kernel.chunks([x for x, _ in found]):
        h, _, _ = kernel.words(data, offsets, separators)
        out[first:last] = h
    return out.view(np.int64)


def shared(a: list[int], b: list[int]) -> set[int]:
    """Indexes of ``a`` on a longest common subsequence with ``b``."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    out = set(range(head)) | set(range(len(a) - tail, len(a)))
    x, y = a[head: len(a) - tail], b[head: len(b) - tail]
    in_y, in_x = set(y), set(x)
    at = [i for i, v in enumerate(x) if v in in_y]
    out.update(head + at[i] for i in _longest([x[i] for i in at], [v for v in y if v in in_x]))
    return out


def _longest(x: list[int], y: list[int]) -> list[int]:
    """Indexes of ``x`` on a longest common subsequence with ``y``: by equal pairs, or halved while these are many (Hirschberg)."""
    counts = Counter(y)
    if len(x) < 2 or sum(counts[v] for v in x) <= MATCHES:
        return _by_pairs(x, y)
    half = len(x) // 2
    before, after = _prefix_lengths(x[:half], y), _prefix_lengths(x[half:][::-1], y[::-1])
    cut = int(np.argmax(before + after[::-1]))
    return _longest(x[:half], y[:cut]) + [half + i for i in _longest(x[half:], y[cut:])]


def _prefix_lengths(x: list[int], y: list[int]) -> np.ndarray:
    """Length of a longest common subsequence of ``x`` with every prefix of ``y``, a row of bits at a time."""
    places: dict[int, list[int]] = {}
    for j, v in enumerate(y):
        places.setdefault(v, []).append(j)

    def mask(js: list[int]) -> int:
        marks = np.zeros(8 * ((len(y) + 7) // 8), np.uint8)
        marks[js] = 1
        return int.from_bytes(np.packbits(marks, bitorder="little").tobytes(), "little")

    masks = {v: mask(js) for v, js in places.items() if len(js) > OFTEN}   # those of rare lines are made when met, so memory stays near linear
    full = (1 << len(y)) - 1
    row = full
    for v in x:
        if v not in places:
            continue
        hit = row & (masks[v] if v in masks else mask(places[v]))
        row = ((row + hit) | (row - hit)) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes((len(y) + 7) // 8, "little"), np.uint8), bitorder="little")[: len(y)]
    return np.concatenate([[0], np.cumsum(bits == 0)])


def _by_pairs(x: list[int], y: list[int]) -> list[int]:
    where: dict[int, list[int]] = {}
    for j, v in enumerate(y):
        where.setdefault(v, []).append(j)
    ends: list[int] = []       # smallest end in y of a common subsequence of each length
    links: list[tuple | None] = []
    for i, v in enumerate(x):
        for j in reversed(where.get(v, ())):
            k = bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            elif j < ends[k]:
                ends[k], links[k] = j, link
    out = []
    link = links[-1] if links else None
    while link:
        out.append(link[0])
        link = link[1]
    return out[::-1]


def signature(found: list[tuple[str, int]], hashes: list[int]) -> int | None:
    """Hash of the lines outside furniture, or of all where there are no others."""
    body = [h for h, (_, z) in zip(hashes, found, strict=True) if z] or hashes
    return int.from_bytes(blake2b(np.array(body, np.int64).tobytes(), digest_size=8).digest(), "little", signed=True) if body else None


def main_text(page: str | None, mate: list[int] | None, second: list[int] | None = None) -> tuple[str, int]:
    """(main text, lines shared with the mate); ``second``: lines of the second reference."""
    found = lines(page)
    hashes = line_hashes(found).tolist() if mate or second else []
    common_lines = shared(hashes, mate) if mate else set()
    others = shared(hashes, second) if second else set()
    outside = {i for i, (_, z) in enumerate(found) if z}
    dropped = common_lines
    remainder = outside - others
    changed = remainder - common_lines
    size = lambda some: sum(len(found[i][0]) for i in some)
    if outside <= common_lines and not (second and remainder):
        dropped = set()     # no line of its own
    elif second and remainder and all(len(found[i][0]) < PROSE for i in changed) and size(changed) <= COPY * size(remainder):
        dropped = others    # the mate is a copy
    marked = any(z == 2 for _, z in found)
    notices = {i for i in dropped & common_lines & others if len(found[i][0]) < PASSAGE} if second else {i for i in dropped if len(found[i][0]) < PROSE}
    kept = [x for i, (x, z) in enumerate(found) if (z == 2 and i not in notices) or (z == 1 and i not in dropped and (not marked or len(x) >= PROSE))]
    return " ".join(kept), len(common_lines)


# --- jobs ---------------------------------------------------------------------
def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))


def path_of(url: Column) -> Column:
    """The path without query, fragment, page suffix and last slash."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.regexp_replace(path, r"(?:/|/index)?(?:\.html?|\.php)?/?$", "")


HASHES = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("sig", pa.int64()), ("hashes", pa.list_(pa.int64()))])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in common.slices(batches, 128):
        found = [lines(x) for x in b.column(3).to_pylist()]
        hashes = [line_hashes(x).tolist() for x in found]
        yield common.batch(HASHES, b.column(0), b.column(1), b.column(2), [signature(x, h) for x, h in zip(found, hashes, strict=True)], pa.array(hashes, pa.list_(pa.int64())))


TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()), ("n_shared", pa.int64())])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in common.slices(batches, 128):
        rows = [main_text(*x) for x in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True)]
        yield common.batch(TEXTS, b.column(0), b.column(1), [t.encode("utf-8", "replace").decode() for t, _ in rows], [len(t) for t, _ in rows], [n for _, n in rows])


def _common_prefix(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two strings."""
    least = F.least(F.length(a), F.length(b))
    return F.coalesce(F.array_min(F.filter(F.sequence(F.lit(1), F.greatest(least, F.lit(1))), lambda i: F.substr(a, i, F.lit(1)) != F.substr(b, i, F.lit(1)))) - 1, least)


def mates(classes: DataFrame, folder: str) -> DataFrame:
    """(host, sig, mate_id, second_id): for every class (host, path, id, sig) the page of the nearest other path of its host, and of the next nearest."""
    ordered = common.written(classes.repartitionByRange("host", "path").sortWithinPartitions("host", "path").withColumn("part", F.spark_partition_id()), f"{folder}/keys")
    key = F.struct("host", "path", "id")
    around = {"before": F.lag(key), "before_2": F.lag(key, 2), "after": F.lead(key), "after_2": F.lead(key, 2)}
    # neighbours over the edge of a range: from the first and last two keys of every range
    ends = ordered.groupBy("part").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    inner = (ordered.join(F.broadcast(ends), "part").groupBy("part")
             .agg(F.min(F.when(key > F.col("low"), key)).alias("low_2"), F.max(F.when(key < F.col("high"), key)).alias("high_2")))
    edges = (ends.join(inner, "part").select("part", F.explode(F.array_distinct(F.array("low", "low_2", "high_2", "high"))).alias("k")).where("k is not null").select("part", "k.*"))
    by_key = Window.orderBy("host", "path")   # four rows per range
    edges = edges.select("host", "path", *[x.over(by_key).alias(f"edge_{c}") for c, x in around.items()])
    inside = Window.partitionBy("part").orderBy("host", "path")
    near = (ordered.withColumns({c: x.over(inside) for c, x in around.items()})
            .join(F.broadcast(edges), ["host", "path"], "left")   # bounded: four rows per shuffle partition
            .withColumns({c: F.coalesce(c, f"edge_{c}") for c in around}))
    near = near.withColumns({c: F.when(F.col(f"{c}.host") == F.col("host"), F.col(c)) for c in around})
    near = near.withColumns({f"{c}_x": F.when(F.col(c).isNotNull(), _common_prefix(F.col("path"), F.col(f"{c}.path"))) for c in around})
    first = F.col("before_x").isNotNull() & (F.col("after_x").isNull() | (F.col("before_x") >= F.col("after_x")))
    nearer = lambda a, b: F.when(F.col(f"{b}_x").isNull() | (F.col(f"{a}_x") >= F.col(f"{b}_x")), F.col(f"{a}.id")).otherwise(F.col(f"{b}.id"))
    return near.select("host", "sig", F.when(first, F.col("before.id")).otherwise(F.col("after.id")).alias("mate_id"),
                       F.when(first, F.coalesce(nearer("after", "before_2"), F.col("before_2.id"))).otherwise(F.coalesce(nearer("before", "after_2"), F.col("after_2.id"))).alias("second_id"))


def main_texts(pages: DataFrame, folder: str) -> DataFrame:
    """(page_id, url, text, n_chars, n_shared) of every row of ``pages`` (page_id, url, html)."""
    whole = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    addressed = whole.withColumns({"host": F.coalesce(host_of(F.col("url")), F.lit("")), "path": F.coalesce(path_of(F.col("url")), F.lit(""))})
    hashes = common.written(addressed.where("host != '' and page_id is not null").select("page_id", "host", "path", "html")
                            .mapInArrow(_hashed, "page_id long, host string, path string, sig long, hashes array<long>"), f"{folder}/hashes")
    paths = hashes.where("sig is not null").groupBy("host", "path").agg(F.min(F.struct("page_id", "sig")).alias("p")).select("host", "path", "p.page_id", "p.sig")
    classes = paths.groupBy("host", "sig").agg(F.min(F.struct("path", "page_id")).alias("c")).select("host", "c.path", F.col("c.page_id").alias("id"), "sig")
    near = mates(classes, folder).where("mate_id is not null")
    pairs = common.written(paths.join(near, ["host", "sig"]).select("host", "path", "mate_id", "second_id"), f"{folder}/mates")
    # one row per page id: repeated ids would repeat the mate
    of = hashes.groupBy("page_id").agg(F.min("hashes").alias("of"))
    beside = (pairs.join(of.select(F.col("page_id").alias("mate_id"), F.col("of").alias("mate")), "mate_id")
              .join(of.select(F.col("page_id").alias("second_id"), F.col("of").alias("second")), "second_id", "left").select("host", "path", "mate", "second"))
    return (addressed.join(beside, ["host", "path"], "left").select("page_id", "url", "html", "mate", "second")
            .mapInArrow(_texts, "page_id long, url string, text string, n_chars long, n_shared long"))

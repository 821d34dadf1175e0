"""Page differencing on hand-made pages, and the pipeline against its parts."""

import random

import corpus_pipeline
import pytest

from wordloom.llm import common, page_diff, pii, queries, stages, tiling

SF = "/root/testdata/sf0.001"


def folder(spark):
    return common.run_folder(spark, "test")


MARKED = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">menu</a></li></ul></nav><!-- <p>gone</p> --><div class="ad top">buy</div><header>site</header>
<main><article><header><h1>Title &amp; more&am</h1></header><p><b>One<br><p>Two  three\n four &lt;b&gt; &#233;&nbsp;x</p><div class="share">tweet</div>
<form><p>mail</p></form><p class="ad">advert</p><p>Five <i>si</i>x</p><aside>side</aside><section id="comments"><article class="comment">nice</article></section></article></main>
<div role="contentinfo">imprint</div><footer>&copy; x</footer></body></html>"""


def test_markup_rules():
    text, _ = page_diff.main_text(MARKED, None)
    assert text == "Title & more&am One Two three four <b> é x Five six"


@pytest.mark.parametrize("page", [None, "", "<", "<p", "a<b", "<script>x", "<!--x", "<p>&#xD800;", "<div class='ad'>x", "x" * 100_000, "<" * 3000, "<a b='" * 2000])
def test_broken_pages_do_not_fail(page):
    text, _ = page_diff.main_text(page, [1, 2])
    assert isinstance(text, str)


def brute_lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_shared_lines_are_a_longest_common_subsequence():
    r = random.Random(1)
    for _ in range(300):
        a, b = (r.choices(range(6), k=r.randint(0, 12)) for _ in range(2))
        found = sorted(page_diff.shared(a, b))
        assert len(found) == brute_lcs(a, b)
        rest = iter(b)
        assert all(any(y == a[i] for y in rest) for i in found)


def test_alignment_is_exact_for_many_equal_lines():
    r = random.Random(2)
    assert len(page_diff.shared([7] + [1] * 1500 + [8, 2] * 20, [9] + [1] * 1500 + [2, 8] * 20)) == 1500 + 39
    # an extra occurrence early in one page shifts every later one
    a, b = [3] + [1, 2] * 1200 + [4], [5, 1] + [1, 2] * 1200 + [6]
    assert len(a) ** 2 // 2 > page_diff.MATCHES and len(page_diff.shared(a, b)) == 2400
    a, b = r.choices(range(3), k=2700), r.choices(range(3), k=2600)
    found, row = sorted(page_diff.shared(a, b)), [0] * (len(b) + 1)
    for x in a:
        corner = 0
        for j, y in enumerate(b):
            corner, row[j + 1] = row[j + 1], corner + 1 if x == y else max(row[j + 1], row[j])
    rest = iter(b)
    assert len(found) == row[-1] and all(any(y == a[i] for y in rest) for i in found)


def plain(*lines):
    return "<html><body>" + "".join(f"<p>{x}</p>" for x in lines) + "</body></html>"


def test_differencing_deletes_shared_lines_of_the_nearest_page(spark):
    rows = [
        (1, "http://h/news/10", plain("Home", "Article one", "text one", "Contact")), (2, "http://h/news/11.html", plain("Home", "Article two", "text two", "Contact")),
        (3, "http://h/shop/1", plain("Shop", "Thing", "Contact")), (4, "http://h/shop/2/", plain("Shop", "Other", "Contact")), (5, "http://other/news/10", plain("Home", "alone")),
        (6, "http://c/a/1", plain("same", "whole", "article")), (7, "http://c/a/2?x=1", plain("same", "whole", "article")), (8, None, plain("Home", "no url")), (None, "http://h/news/10", plain("Home", "no id", "x")),
        (9, "http://h/news/10#top", plain("Home", "variant", "y", "z")), (10, "nonsense", None), (11, "", ""), (11, "", ""),
    ]
    df = spark.createDataFrame([(*x, "k") for x in rows], "page_id long, url string, html string, host string")
    got = [(x.page_id, x.text, x.n_chars) for x in page_diff.main_texts(df, folder(spark)).collect()]
    text = {i: t for i, t, _ in got}
    assert len(got) == len(rows) and all(n == len(t) for _, t, n in got)
    assert text[1] == "Article one text one" and text[2] == "Article two text two" and text[3] == "Thing" and text[4] == "Other"
    assert text[5] == "Home alone" and text[6] == text[7] == "same whole article" and text[8] == "Home no url"
    assert text[None] == "no id x" and text[9] == "variant y z" and text[10] == text[11] == ""
    assert page_diff.main_texts(df.where("false"), folder(spark)).collect() == []


def test_short_pages_of_long_templates_are_differenced_and_copies_are_not_mates(spark):
    site = ["logo", "link a", "link b", "link c", "copyright"]
    words = "the body of the article under two addresses, told at some length and in more than one line " * 3
    rows = [(1, "http://t/a/1", plain(*site, "one body")), (2, "http://t/a/2", plain(*site, "another body")), (3, "http://t/b/3", plain(*site, "third")),
            # copies: equal under three paths, and one with a counter
            (4, "http://u/x/1", plain(*site, "Headline", words)), (5, "http://u/x/1/print", plain(*site, "Headline", words)), (6, "http://u/x/1/send", plain(*site, "Headline", words)),
            (7, "http://u/y/2", plain(*site, "News", words + "new", "seen 3")), (8, "http://u/y/2/print", plain(*site, "News", words + "new", "seen 4")), (9, "http://u/z", plain(*site, "last"))]
    got = {x.page_id: x.text for x in page_diff.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string"), folder(spark)).collect()}
    assert [got[i] for i in (1, 2, 3, 9)] == ["one body", "another body", "third", "last"]
    assert got[4] == got[5] == got[6] == f"Headline {words.strip()}"
    assert got[7] == f"News {words}new seen 3" and got[8] == f"News {words}new seen 4"


def test_alignment_decides_on_marked_pages_too(spark):
    notice, quoted = "Sign up for our letter and read every story a day before all the others do", "a passage that one other article quotes as well"
    prose = "main text {} that stands beside a teaser article and is long enough to be told from a link or a caption"
    page = lambda k, *more: f"<html><body><p>Site</p><article><h1>Title {k}</h1><p>{notice}</p><p>text {k}</p>{''.join(f'<p>{x}</p>' for x in more)}</article><p>{prose.format(k)}</p><p>by {k}</p><p>Legal</p></body></html>"
    law = "a long law that all articles quote " * 8
    rows = [(1, "http://h/a/1", page("one", quoted, law)), (2, "http://h/a/2", page("two", quoted, law)), (3, "http://h/b/3", page("three", law))]
    rows += [(4, "http://two/1", page("four", "Share", law)), (5, "http://two/2", page("five", "Share", law)), (6, "http://lone/1", page("six"))]
    got = {x.page_id: x.text for x in page_diff.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string"), folder(spark)).collect()}
    law = law.strip()
    assert got[1] == f"Title one text one {quoted} {law} {prose.format('one')}" and got[2] == f"Title two text two {quoted} {law} {prose.format('two')}"
    assert got[3] == f"Title three text three {law} {prose.format('three')}"
    assert got[4] == f"Title four {notice} text four {law} {prose.format('four')}"   # one reference: a long shared line may be a quotation
    assert got[6] == f"Title six {notice} text six {prose.format('six')}"


def test_mates_do_not_depend_on_ranges(spark):
    rows = [(f"h{k % 3}", f"/{'abcd'[k % 4]}/{k * 37 % 101}", k, k) for k in range(90)]
    df = spark.createDataFrame(rows, "host string, path string, id long, sig long")
    found = []
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    for n in ("1", "7", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(sorted(tuple(x) for x in page_diff.mates(df, folder(spark)).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found[0] == found[1] == found[2] and len(found[0]) == 90 and all(x[2] is not None and x[3] not in (None, x[2], x[1]) for x in found[0])


def test_op10_gives_the_articles_of_the_table(spark):
    rows = {x.page_id: x for x in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for x in queries.op10_page_differencing(spark, SF).collect():
        page = rows[x.page_id].html
        article = page[page.index("<article>"): page.index("</article>")]
        import html
        import re
        words = html.unescape(re.sub(r"</?(?:article|h1|p|br)\b[^>]*>", " ", article).replace("<b>", "").replace("</b>", "")).split()
        assert x.text.split() == words and x.n_chars == len(x.text)


# --- pipeline -------------------------------------------------------------------
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_keep_rows_and_columns_of_odd_documents(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    r = random.Random(5)
    long = " ".join(f"w{r.randrange(500)}" for _ in range(200))
    rows = [(None, "plain words of no id", "en", "s", 4), (1, None, None, None, None), (2, "", "en", "s", 0), (3, long, "en", "s", 9), (4, long, "en", "s", 9), (5, long + " tail", "de", "s", 9),
            (6, f"before {item} after", "en", "s", 9), (7, "mail me at a.b@example.com now", "en", "s", 9), (8, "you idiot scum moron trash loser pathetic clown", "en", "s", 9)]
    docs = spark.createDataFrame(rows, COLUMNS)
    encoded = {x.doc_id: list(x.ids) for x in stages.encoded(spark, docs, SF).collect()}
    assert encoded.keys() == {x[0] for x in rows} and encoded[1] == encoded[2] == [] and encoded[3] == encoded[4] != []
    for stage in (stages.toxic, stages.near_duplicates, stages.decontaminated, stages.without_personal_data, stages.encoded):
        assert stage(spark, docs.where("false"), SF).collect() == []
    near = stages.near_duplicates(spark, docs, SF)
    assert near.columns == docs.columns and {x.doc_id for x in near.collect()} == {None, 1, 2, 3, 6, 7, 8}
    clean = {x.doc_id for x in stages.decontaminated(spark, docs, SF).collect()}
    assert clean == {x[0] for x in rows} - {6}
    kept = {x.doc_id: x for x in stages.without_personal_data(spark, docs, SF).collect()}
    assert len(kept) == len(rows) and kept[7].text == "mail me at <email> now" and kept[7].n_chars == len(kept[7].text) and kept[1].text is None and kept[3].n_chars == 9
    polite = {x.doc_id for x in stages.toxic(spark, docs, "/root/testdata/sf0.1").collect()}
    assert polite == {x[0] for x in rows} - {8}


def test_pii_stage_annotates_once_and_keeps_clashing_columns(spark, monkeypatch):
    rows = [(1, "mail me at a.b@example.com now", "en", "s", 30, "b", "c", "d", "e", "f"), (2, None, "en", "s", None, None, "c", "d", "e", "f")]
    docs = spark.createDataFrame(rows, COLUMNS + ", base string, cands string, spans string, row string, _t string")
    plans, real = [], common.written
    monkeypatch.setattr(common, "written", lambda df, at: (plans.append(df), real(df, at))[1])
    out = stages.without_personal_data(spark, docs, SF)
    assert sum(x._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") for x in [*plans, out]) <= 5
    assert out.columns == docs.columns and sorted(map(tuple, out.collect())) == [(1, "mail me at <email> now", "en", "s", 22, "b", "c", "d", "e", "f"), rows[1]]


def test_pipeline_equals_its_operators(spark):
    """run() against the operators' own results put together by plain Python."""
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "n-gram Jaccard join", "benchmark decontamination", "PII", "SentencePiece encoding and decoding"]
    got = {x.doc_id: list(x.ids) for x in corpus_pipeline.run(spark, SF).collect()}
    docs = {x.doc_id: x.text for x in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    toxic = {x.doc_id for x in queries.op4_toxicity(spark, SF).where("predicted = 1").collect()}
    left = {i: t for i, t in docs.items() if i not in toxic}

    def shingles(t):
        w = t.lower().split()
        return {tuple(w[k: k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())

    sets, parent = {i: shingles(t) for i, t in left.items()}, {i: i for i in left}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    left = {i: t for i, t in left.items() if root(i) == i}
    leaks = {x.doc_id for x in tiling.contamination(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet"), folder(spark)).where("contaminated").collect()}
    assert set(got) == set(left) - leaks
    import public_tokenizers
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.PIECE_FILE))
    for i, ids in got.items():
        clean = library.decode(ids)
        assert not pii.BASE.keys() & set() and "@mail" not in clean and library.encode(clean) == ids

"""Quality counts, personal data spans and quotation linking against brute force; no Python in their plans."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from wordloom.llm import common, pii, quality, queries, quotes

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def folder(spark):
    return common.run_folder(spark, "test")


# --- quality ------------------------------------------------------------------
def brute_counts(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = {}
    for i in range(len(w) - 2):
        windows.setdefault(tuple(w[i: i + 3]), []).append(i)
    covered = {p + j for at in windows.values() if len(at) > 1 for p in at for j in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def odd_texts():
    r = random.Random(2)
    texts = [None, "", " \n\t ", "a", "a b", "a b c", "a b c a b c", "x x x x", "é # $ <b> |", "one\n two\none\none \n\n", "\x1c \x85", "👍 👍 👍 👍", "a " * 5000]
    return texts + [" ".join(r.choices("ab\nc", k=r.randint(1, 40))) for _ in range(60)] + [" ".join(r.choices(["the", "of", "#x", "Y\n"], k=80)) for _ in range(20)]


def test_base_counts_equal_brute_force(spark):
    texts = odd_texts() + [x.text for x in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    df = spark.createDataFrame([(k, t, ["en", None, "xx", "de"][k % 4], k) for k, t in enumerate(texts)], "doc_id long, text string, lang string, n_words int")
    got = {x.doc_id: x for x in quality.verdicts(df, folder(spark)).collect()}
    for k, t in enumerate(texts):
        x, b = got[k], brute_counts(t)
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == b, repr(t)[:100]
        assert x.base_failed == (b[0] < 50 or 100 * b[4] > 50 * b[0]) and x.kept in (True, False) and not (x.base_failed and x.kept)


def test_divergence_is_the_jensen_shannon_distance(spark):
    df = spark.createDataFrame([(3, 1, 0), (0, 0, 0), (0, 0, 5)], "a long, b long, c long")
    reference = F.array(F.lit(0.75), F.lit(0.25), F.lit(0.0))
    got = [x[0] for x in df.select(quality._divergence(F.array("a", "b", "c"), reference)).collect()]
    assert got[0] == pytest.approx(0, abs=1e-7) and got[1] is None and got[2] == pytest.approx(1)


def test_quality_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert quality.verdicts(df, folder(spark)).collect() == []


def test_languages_without_word_lists_are_judged_by_their_own_reference(spark):
    r = random.Random(8)
    russian, greek, english = "абвгдежзиклмнопрстуфхыья", "αβγδεζηθικλμνοπρστυφχψω", "abcdefghiklmnoprstuwy"
    text = lambda letters, n: " ".join("".join(r.choices(letters, k=r.randint(3, 8))) + r.choice(["", "", "", ","]) for _ in range(n))
    rows = [(k, text(english, 90), "en") for k in range(20)] + [(100 + k, text(russian, 90), "ru") for k in range(40)]
    rows += [(200, text("#$%<|>&*@~^{}[]", 70), "ru"), (300, text(greek, 90), "el"), (301, text(russian, 90), None), (302, text(english, 90), "ru")]
    got = {x.doc_id: x for x in quality.verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string"), folder(spark)).collect()}
    assert not any(x.base_failed for x in got.values())
    assert all(got[100 + k].kept and got[100 + k].class_distance < quality.CLASS_LIMIT for k in range(40)) and got[302].kept and all(got[k].kept for k in range(20))
    assert not got[200].kept and got[300].kept and got[300].class_distance is None and got[301].kept


def test_quality_keeps_good_documents_and_drops_junk(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.op6_distribution_divergence(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed").select("kept", "quality").collect()
    good = [x.kept for x in rows if x.quality == 1]
    junk = [x.kept for x in rows if x.quality == 0]
    assert sum(good) / len(good) > 0.97 and sum(junk) / len(junk) < 0.35


# --- personal data --------------------------------------------------------------
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(s):
    d = [int(c) for c in reversed(s)]
    return sum(d[0::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])


def brute_base(text):
    out = []
    for k, (kind, p) in enumerate(PATTERNS.items()):
        for m in re.finditer(p, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m.group().split(".")),
                  "card": 14 <= len(digits) <= 19 and luhn(digits) % 10 == 0, "phone": 10 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), k, m.end(), kind))
    return sorted(out)


def personal_texts():
    r = random.Random(6)
    atoms = ["a@b.c", "x.y+z@mail-1.example.com", "@", ".", "..", "_d@e.f", "1.2.3.4", "256.1.1.1", "001.02.3.4", "5.6.7.8.9.10", "4316522678525456", "4316 5226 7852 5456", "4316-5226-7852-5457",
             "+1 (743) 555-3824", "+49", "+1.2.3.4.5.6.7.8.9.0", "-", " ", "  ", "é", "👍", "\n", "7", "0", "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\"", "12345678", "ssn 123-45-6789", "+", "("]
    texts = ["".join(r.choices(atoms, k=r.randint(1, 25))) for _ in range(400)]
    return texts + [None, "", "1" * 20_000, "1 " * 20_000, "a" * 50_000, "1.1.1.1 " * 1500, "a@b.c " * 1000, "+1" * 5000]


def test_base_spans_equal_brute_force(spark):
    texts = personal_texts() + [x.text for x in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, base string")
    got = {x.doc_id: x for x in pii.personal_data(df, folder(spark)).collect()}
    assert len(got) == len(texts)
    for k, t in enumerate(texts):
        x, base = got[k], brute_base(t)
        assert [x.n_email, x.n_ip, x.n_card, x.n_phone] == [sum(b[3] == kind for b in base) for kind in PATTERNS], repr(t)[:200]
        joined = ",".join(f"{b[3]}:{b[0]}:{b[2]}" for b in base)
        assert x.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(x.spans.split(","))
        starts = [int(s.split(":")[1]) for s in x.spans.split(",") if s]
        assert starts == sorted(starts) and len(starts) == len(base) + x.n_added


def test_weak_supervision_adds_secrets_and_not_plain_tokens(spark):
    r = random.Random(1)
    rows = []
    for i in range(60):
        hexed = "".join(r.choices("0123456789", k=3) + r.choices("abcdef", k=5)) * 5
        rows += [(i * 4, f'a token = "{hexed}" b'), (i * 4 + 1, f"see page {r.randint(10**7, 10**8)} of it"), (i * 4 + 2, f"the {'abcdefgh' * 3} word"), (i * 4 + 3, f"my ssn {r.randint(100, 999)}-45-{r.randint(1000, 9999)} ok")]
    rows.append((240, "twice 4316522678525456 4316522678525456 here"))
    got = {x.doc_id: x.spans for x in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string"), folder(spark)).collect()}
    assert {got[i * 4].split(":")[0] for i in range(60)} == {"secret"} and {got[i * 4 + j] for i in range(60) for j in (1, 2)} == {""}, got
    assert got[240] == "number:6:22,number:23:39"
    assert all(got[i * 4 + 3].startswith("number:") for i in range(60))


def test_tokens_of_any_length_are_candidates(spark):
    r = random.Random(3)
    rows = [(k, f'a token = "{"".join(r.choices("0123456789abcdef", k=40))}" b') for k in range(60)]
    rows += [(100 + k, f"see {'abcdefgh' * 3} word") for k in range(60)]
    sizes = {200: 513, 201: 100_000}
    rows += [(i, f'a token = "{"".join(r.choice("0123456789") + r.choice("abcdef") for _ in range(n))[:n]}" b') for i, n in sizes.items()]
    rows += [(300, "+a" * 50_000), (301, "a" * 100_000 + "=")]
    got = {x.doc_id: x.spans for x in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string"), folder(spark)).collect()}
    assert all(f"secret:11:{11 + n}" in got[i].split(",") for i, n in sizes.items())


def test_reliabilities_find_the_good_labeler():
    base = dict.fromkeys(pii.FLAGS, False)
    rows = [base | {"shape_hex": True, "near_secret": True, "assigned": True, "k": 90}, base | {"shape_word": True, "near_other": True, "in_path": True, "k": 90},
            base | {"shape_hex": True, "near_other": True, "k": 5}, base | {"k": 20}]
    p, rates = pii.reliabilities(rows)
    assert p[0] > 0.95 and p[1] < 0.05 and all(yes >= 0.5 >= no for yes, no in rates)


def test_redaction_leaves_no_span(spark):
    texts = ["x a@b.co y 1.2.3.4", "+1 (743) 555-3824 é 4316522678525456 4316522678525456", "none", "", "a@b.c"]
    df = pii.annotated(spark.createDataFrame([(t,) for t in texts], "text string"))
    got = [x[0] for x in df.select(pii.redacted(F.col("text"), F.col("base"))).collect()]
    assert got[0] == "x <email> y <ip>" and got[1].startswith("<phone> é ") and got[2:] == ["none", "", "<email>"]


# --- quotes ---------------------------------------------------------------------
MAIL = [
    (1, 0, "a", "Hello all\nHow  are you?"), (1, 1, "b", "> hello   ALL\nFine\nThanks"), (1, 2, "c", "other matter\n"),
    (1, 3, "d", ">> Hello all\n> Fine\n> Thanks\ngood"), (1, 4, "e", "> other matter\nyes"), (1, 5, "f", "> nobody said this\n>\n> \n"),
    (2, 0, "a", "> Hello all\nfrom elsewhere"), (2, 1, "b", "Hello all"), (2, 1, "b", "twin"), (3, 0, "a", None), (None, 1, "x", "> Fine"), (4, None, "x", "Fine"), (5, 0, "x", "> later"), (5, 1, "y", "later"),
]


def test_reply_order_links_quotes(spark):
    df = spark.createDataFrame([(*x, "z") for x in MAIL], "conv_id long, turn long, role string, text string, level string")
    rows = quotes.reply_order(df, folder(spark)).collect()
    assert len(rows) == len(MAIL)
    got = {(x.conv_id, x.turn, x.role, x.text): x for x in rows}
    one = [x for x in rows if x.conv_id == 1]
    assert [x.turn for x in one] == [0, 1, 3, 2, 4, 5]
    by = {x.turn: x for x in one}
    assert [by[t].parent_turn for t in range(6)] == [None, 0, None, 1, 2, None]
    assert [by[t].root_turn for t in range(6)] == [0, 0, 2, 0, 2, 5]
    assert by[3].levels == 2 and by[3].n_quoted == 3 and by[3].n_linked == 3 and by[3].text == "good"
    assert by[5].text == "" and by[5].n_quoted == 1 and by[5].n_linked == 0
    assert got[2, 0, "a", "from elsewhere"].from_conv == 1 and got[5, 0, "x", ""].parent_turn is None


def test_reply_order_equals_the_sql(spark):
    """Random nested quoting against the DuckDB statement of the query."""
    import duckdb
    import pandas as pd
    r = random.Random(12)
    pool = [f"line {k}" for k in range(6)] + ["Mixed  CASE", "é x"]
    rows = [(c, t, "a", "\n".join("> " * r.choice([0, 0, 0, 1, 1, 2, 3]) + r.choice(pool) for _ in range(r.randint(0, 4)))) for c in range(6) for t in range(9)]
    rows += [(x[0], x[1], x[2], x[3]) for x in MAIL if x[0] and x[1] is not None and x[0] != 2]
    rows = [(c + 10 * (k >= 54), t, a, x) for k, (c, t, a, x) in enumerate(rows)]
    got = quotes.reply_order(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), folder(spark))
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]))
    cur = con.execute(queries.ORACLE["op2_quotation_linking"])
    names = [d[0] for d in cur.description]
    key = lambda x: tuple(str(v) for v in x)
    assert sorted(map(key, got.select(*names).collect())) == sorted(map(key, cur.fetchall()))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle_parity(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("conversations", "pages", "documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF)
    cur = con.execute(queries.ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(got.columns)
    key = lambda x: tuple(str(v) for v in x)
    assert sorted(map(key, got.select(*names).collect())) == sorted(map(key, cur.fetchall()))


def test_quotes_of_empty_table_and_long_chain(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert quotes.reply_order(df, folder(spark)).collect() == []
    chain = spark.createDataFrame([(1, k, "a", f"> line {k - 1}\nline {k}") for k in range(40)], "conv_id long, turn long, role string, text string")
    rows = quotes.reply_order(chain, folder(spark)).collect()
    assert {x.root_turn for x in rows} == {0} and [x.turn for x in rows] == list(range(40))


@pytest.mark.parametrize("name", ["op2_quotation_linking", "op6_distribution_divergence", "op7_weak_supervision_pii"])
def test_native_plans_have_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|MapIn", plan)


def test_added_spans_find_the_secrets_of_the_table(spark):
    """Hexadecimal keys and passwords of the documents, found here by a pattern of their own, against the spans of the method."""
    sf = "/root/testdata/sf0.01"
    docs = {x.doc_id: x.text or "" for x in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    spans = {x.doc_id: [s.split(":") for s in x.spans.split(",") if s] for x in queries.op7_weak_supervision_pii(spark, sf).collect()}
    planted = found = 0
    for i, text in docs.items():
        for m in re.finditer(r"(?:(?<=password=)|(?<=\"))[0-9a-f]{16,}(?![0-9A-Za-z])", text):
            if re.search("[a-f]", m.group()) and re.search("[0-9]", m.group()):
                planted += 1
                found += any(k == "secret" and int(a) <= m.start() and m.end() <= int(b) for k, a, b in spans[i])
    assert planted >= 10 and found >= 0.9 * planted


# --- verdict of the divergence rules, worked out again ---------------------------
def brute_histograms(text, lang):
    text = text or ""
    rest = re.sub("[a-z0-9]+", "", text)
    other = "".join(chr(c) for c in range(0x80) if c not in range(9, 14) and c != 32 and not chr(c).isalnum() and chr(c) not in ".,;:!?#*$%&|<>")
    removed = [sum(c in of for c in rest) for of in (" \t\n\x0b\x0c\r", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ".,;:!?", "#*$%&|<>", other)]
    lower = len(text) - len(rest)
    classes = [lower, *removed, len(text) - lower - sum(removed)]
    words = quality.COMMON_WORDS.get(lang)
    if words is None:
        return classes, None
    import regex
    seen = regex.findall(r"(?<![^\x20\x09-\x0D])(?:" + "|".join(words) + r")(?![\p{L}\p{N}])", text.lower())
    n_words = len([w for w in re.split(r"[\x20\x09-\x0D]+", text) if w])
    commons = [seen.count(w) for w in words]
    return classes, [*commons, max(n_words - sum(commons), 0)]


def distance(counts, reference):
    from math import log2, sqrt
    total = sum(counts)
    if not total:
        return None
    p = [c / total for c in counts]
    m = [(a + b) / 2 for a, b in zip(p, reference)]
    return sqrt(max(sum(a * log2(a / c) if a > 0 else 0 for a, c in zip(p, m)) + sum(b * log2(b / c) if b > 0 else 0 for b, c in zip(reference, m)), 0) / 2)


def test_kept_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = {x.doc_id: x for x in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {x.doc_id: x for x in queries.op6_distribution_divergence(spark, sf).collect()}
    hist = {i: brute_histograms(d.text, d.lang) for i, d in docs.items()}
    counts = {i: brute_counts(d.text) for i, d in docs.items()}
    failed = {i: c[0] < 50 or 100 * c[4] > 50 * c[0] for i, c in counts.items()}
    near, by_class, own = [i for i in docs if not failed[i]], {}, {}
    for _ in range(quality.ROUNDS):
        refs = {}
        for lang in quality.COMMON_WORDS:
            sums = [[sum(v) for v in zip(*(hist[i][k] for i in near if docs[i].lang == lang))] for k in (0, 1)]
            refs[lang] = [[c / sum(s) for c in s] for s in sums]
        by_class = {i: min((d for c, _ in refs.values() if (d := distance(hist[i][0], c)) is not None), default=None) for i in docs}
        own = {i: distance(hist[i][1], refs[docs[i].lang][1]) for i in docs}
        near = [i for i in docs if not failed[i] and by_class[i] is not None and by_class[i] <= quality.CLASS_LIMIT]
    for i, x in got.items():
        far = (by_class[i] or 0) > quality.CLASS_LIMIT or (counts[i][0] >= quality.WORD_GUARD and (own[i] or 0) > quality.WORD_LIMIT)
        assert (x.base_failed, x.kept) == (failed[i], not failed[i] and not far), i
        assert x.class_distance == pytest.approx(by_class[i], abs=1e-9) and x.word_distance == pytest.approx(own[i], abs=1e-9)
    assert 0 < sum(x.kept for x in got.values()) < sum(not f for f in failed.values())


def test_quotes_of_the_whole_table_when_turns_quote_each_other(spark):
    """Every turn of the table quotes the first line of the turn before it and, two levels deep, of the one before that."""
    import duckdb
    import pandas as pd
    from pyspark.sql import Window
    w = Window.partitionBy("conv_id").orderBy("turn")
    line = lambda k: F.split(F.lag("text", k).over(w), "\n")[0]
    quote = lambda mark, k: F.coalesce(F.concat(F.lit(mark), line(k), F.lit("\n")), F.lit(""))
    df = spark.read.parquet(f"{SF}/conversations.parquet").withColumn("text", F.concat(quote("> ", 1), quote("> >  ", 2), "text"))
    rows = [tuple(x) for x in df.select("conv_id", "turn", "role", "text").collect()]
    got = quotes.reply_order(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), folder(spark))
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]))
    cur = con.execute(queries.ORACLE["op2_quotation_linking"])
    names = [d[0] for d in cur.description]
    key = lambda x: tuple(str(v) for v in x)
    found = got.select(*names).collect()
    assert sorted(map(key, found)) == sorted(map(key, cur.fetchall()))
    later = [x for x in found if x.turn > 0]
    assert sum(x.parent_turn is not None for x in later) > 0.9 * len(later) and max(x.levels for x in later) == 2 and all(">" != x.text[:1] for x in later)

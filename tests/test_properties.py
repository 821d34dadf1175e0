"""Property checks (generated Hebrew text): fold is idempotent, folded totals
equal raw totals, assembly keeps one row per listed word."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wordloom.functions import text as T
from wordloom.operators import assemble as A
from wordloom.operators import frequency

# letters, niqqud, maqaf, geresh/gershayim, presentation forms, spaces, punctuation
ALPHABET = st.sampled_from(list("אבגדהוזחטיכלמנסעפצקרשת") + ["ְ", "ָ", "ּ", "ׁ", "־", "׳", "״", chr(0xFB2A), chr(0xFB1D), chr(0x200E), " ", ",", "-"])
TEXTS = st.lists(st.text(ALPHABET, min_size=0, max_size=40), min_size=1, max_size=12)


@settings(max_examples=8, deadline=None)
@given(TEXTS)
def test_fold_idempotent_and_totals_preserved(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    once = df.select(T.fold("text").alias("f"))
    twice = once.select(T.fold("f").alias("g"), "f")
    assert all(r.f == r.g for r in twice.collect())
    ws = frequency.word_sources({"songs": df, "youtube": df}, "hebrew")
    folded = frequency.folded_sources(ws, "hebrew")
    raw = ws.where(T.fold("word") != "").agg(F.sum("total").alias("t")).first().t
    fsum = folded.agg(F.sum("total").alias("t")).first().t
    assert raw == fsum


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(ALPHABET, min_size=1, max_size=8), min_size=1, max_size=10))
def test_assembly_row_per_word(spark, words):
    w = spark.createDataFrame([(i, x) for i, x in enumerate(words)], "word_ord long, word string")
    dic = spark.createDataFrame([(0, "אב", "u/0", None)], "ord long, hebrew string, word_url string, tables array<string>")
    dic = dic.select("ord", "hebrew", "word_url")
    sents = spark.createDataFrame([], "bare string, prio int, ord long, sentence string, translation string, source string")
    srcs = spark.createDataFrame([], "word string, songs long, news long, youtube long, total long")
    out = A.assemble(A.word_list(w, "hebrew"), dic, sents, srcs, "hebrew")
    assert out.count() == len(words)

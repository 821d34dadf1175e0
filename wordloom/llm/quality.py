"""Quality rules by distribution divergence, in DataFrame functions only.

Per document: a histogram of character classes and one of its language's most
common words (function words, a fixed list per language, and all other words).
Per language the reference is the sum of these histograms over all documents of
the corpus that pass the base rules, summed once more without those far from
the first sum. A document is dropped when the Jensen-Shannon distance of its
character classes to the nearest language's reference, or of its words to its
own language's, exceeds a limit; the word histogram counts only from
``WORD_GUARD`` words on, for short texts say little about frequencies, and only
for documents of a known language. A language without a list of words has a
reference of character classes if its documents have ``REFERENCE_GUARD``
characters; its documents are compared with that one and those of the known
languages. Where there is none, or no language is given, the classes decide
nothing and ``class_distance`` is null.

The base rules (word, symbol, line and repetition counts) are exact counts per
text; see ``counted``. All of it is row-wise, plus grouped sums with a row per
language.

Defined results: null, empty and blank texts have zero counts and fail the base
rules. Repeated rows are judged alike. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm import common

SPACE = r"[\x20\x09-\x0D]+"
MIN_WORDS = 50
WORD_GUARD = 100
CLASS_LIMIT = 0.14
WORD_LIMIT = 0.35
REFERENCE_GUARD = 10_000   # characters from which documents of a language without a list of words make a reference
ROUNDS = 2              # references are summed again over the documents near the first ones

# The most common function words of each language.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "a", "that", "for", "it", "with", "was"],
    "de": ["der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "nicht"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "por"],
}
# classes counted on the text without its runs of a-z and 0-9, which are class "lower" (digits are no sign of junk: numbers and keys stand in good texts)
CLASSES = {"space": SPACE, "upper": "[A-Z]+", "stop": "[.,;:!?]+", "symbol": r"[#*$%&|<>]+",
           "other_ascii": r"[\x00-\x08\x0E-\x1F\x21-\x7F&&[^A-Za-z0-9.,;:!?#*$%&|<>]]+"}


def _removed(text: Column, pattern: str) -> Column:
    """Code points that matches of ``pattern`` take up."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def counted(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with base counts (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) and the arrays
    ``classes`` and ``commons`` (a count per class, per common word of ``lang``'s list)."""
    keep = [c for c in df.columns if c != text]
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    df = df.select(*keep, t.alias("_t"))
    # the text without runs of lower-case letters and digits is several times shorter; the other classes are counted there
    df = df.withColumn("_rest", F.regexp_replace("_t", "[a-z0-9]+", ""))
    df = df.withColumns({f"_{k}": _removed(F.col("_rest"), p).cast("long") for k, p in CLASSES.items()})
    df = df.withColumns({
        "word_chars": (F.length("_t") - F.col("_space")).cast("long"),
        "n_symbols": F.col("_symbol"),
        "_lower": (F.length("_t") - F.length("_rest")).cast("long"),
        "_lines": F.filter(F.split("_t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        "_w": F.when(F.length("_t") > F.col("_space"), F.split(F.btrim(F.col("_t"), F.lit(" \t\n\x0b\x0c\r")), SPACE, -1)).otherwise(F.array().cast("array<string>")),
    })
    seen = F.lit(None).cast("array<string>")
    low = F.lower("_t")
    for lang, words in COMMON_WORDS.items():
        seen = F.when(F.col("lang") == lang, F.regexp_extract_all(low, F.lit(r"(?<![^\x20\x09-\x0D])(?:" + "|".join(words) + r")(?![\p{L}\p{N}])"), F.lit(0))).otherwise(seen)
    df = df.withColumns({
        "n_words": F.size("_w").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_other": (F.length("_t") - F.col("_lower") - sum((F.col(f"_{k}") for k in CLASSES), F.lit(0))).cast("long"),
        "_seen": seen,
        "_grams": F.when(F.size("_w") >= 3, F.transform(F.sequence(F.lit(0), F.size("_w") - 3), lambda i: F.xxhash64(
            F.get(F.col("_w"), i), F.get(F.col("_w"), i + 1), F.get(F.col("_w"), i + 2)))).otherwise(F.array().cast("array<bigint>")),
    })
    # windows found twice or more: neighbours in hash order
    placed = F.sort_array(F.transform("_grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_p", F.when(F.size(F.array_distinct("_grams")) < F.size("_grams"), placed))
    p = F.col("_p")
    same = lambda x, k: F.coalesce(F.get(p, k)["h"] == x["h"], F.lit(False))
    df = df.withColumn("_at", F.sort_array(F.transform(F.filter(p, lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["i"])))
    at = F.col("_at")
    covered = F.aggregate(F.transform(at, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - x, F.lit(3)))), F.lit(0), lambda a, b: a + b)
    count = lambda words, k: F.lit(0) if k >= len(words) else F.size("_seen") - F.size(F.array_remove("_seen", words[k]))
    commons = F.lit(None).cast("array<bigint>")
    for lang, words in COMMON_WORDS.items():
        commons = F.when(F.col("lang") == lang, F.array(*[count(words, k).cast("long") for k in range(len(words))])).otherwise(commons)
    return df.select(*[c for c in keep if c not in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "classes", "commons")],
                     "n_words", "word_chars", "n_symbols", "n_dup_lines", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
                     F.array("_lower", *[f"_{k}" for k in CLASSES], "_other").alias("classes"), commons.alias("commons"))


def _divergence(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (root, base 2) between an array of counts and a reference distribution."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, c: a + c)

    def term(c: Column, q: Column) -> Column:
        p = c / total
        m = (p + q) / 2
        return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)

    whole = F.aggregate(F.zip_with(counts, reference, term), F.lit(0.0), lambda a, x: a + x)
    return F.when(total > 0, F.sqrt(F.greatest(whole / 2, F.lit(0.0))))


def _word_counts() -> Column:
    """Counts of the common words and of all others."""
    return F.concat("commons", F.array(F.greatest(F.col("n_words") - F.aggregate("commons", F.lit(0).cast("long"), lambda a, c: a + c), F.lit(0))))


def references(counts: DataFrame) -> dict[str, tuple[list[float], list[float]]]:
    """Per known language the class and word distribution of its documents in ``counts``."""
    n_classes, n_words = len(CLASSES) + 2, max(map(len, COMMON_WORDS.values())) + 1
    both = counts.where(F.col("lang").isin(list(COMMON_WORDS))).withColumn("words", _word_counts())
    sums = both.groupBy("lang").agg(*[F.sum(F.col("classes")[k]).alias(f"c{k}") for k in range(n_classes)], *[F.sum(F.col("words")[k]).alias(f"w{k}") for k in range(n_words)])
    out = {}
    for r in sums.collect():   # a row per known language
        classes, words = ([r[f"{x}{k}"] or 0 for k in range(n)] for x, n in (("c", n_classes), ("w", n_words)))
        if sum(classes) and sum(words):
            out[r["lang"]] = ([c / sum(classes) for c in classes], [w / sum(words) for w in words])
    return out


def other_references(counts: DataFrame) -> DataFrame:
    """(lang, reference): the class distribution of every other language that has documents enough in ``counts``."""
    sums = (counts.where(F.col("lang").isNotNull() & ~F.col("lang").isin(list(COMMON_WORDS))).groupBy("lang")
            .agg(F.array(*[F.sum(F.col("classes")[k]) for k in range(len(CLASSES) + 2)]).alias("c")))
    total = F.aggregate("c", F.lit(0).cast("long"), lambda a, c: a + c)
    return sums.where(total >= REFERENCE_GUARD).select("lang", F.transform("c", lambda c: c / total).alias("reference"))


def distances(refs: dict[str, tuple[list[float], list[float]]]) -> tuple[Column, Column]:
    """(class distance to the nearest language's reference, word distance to the row's own language's); ``reference``: that of another language than the known ones."""
    floats = lambda x: F.array(*map(F.lit, x))
    own_class = F.when(F.col("reference").isNotNull(), _divergence(F.col("classes"), F.col("reference")))
    if not refs:
        return own_class, F.lit(None).cast("double")
    by_class = F.array_min(F.transform(F.array(*[floats(c) for c, _ in refs.values()]), lambda ref: _divergence(F.col("classes"), ref)))
    by_class = F.when(F.col("lang").isin(list(COMMON_WORDS)), by_class).when(F.col("reference").isNotNull(), F.least(by_class, own_class))
    own = F.lit(None).cast("array<double>")
    for lang, (_, w) in refs.items():
        own = F.when(F.col("lang") == lang, floats(w)).otherwise(own)
    return by_class, _divergence(_word_counts(), own)


def verdicts(docs: DataFrame, folder: str, class_limit: float = CLASS_LIMIT, word_limit: float = WORD_LIMIT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang): the base counts, base_failed, kept and both distances."""
    counts = common.written(counted(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")), f"{folder}/counts")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    near = counts.where(~failed)
    for k in range(ROUNDS):
        by_class, by_word = distances(references(near))
        judged = counts.join(common.written(other_references(near), f"{folder}/languages-{k}"), "lang", "left")
        near = judged.where(~failed & (by_class <= class_limit)).drop("reference")
    far = F.coalesce(F.col("class_distance") > class_limit, F.lit(False)) | ((F.col("n_words") >= WORD_GUARD) & F.coalesce(F.col("word_distance") > word_limit, F.lit(False)))
    return (judged.withColumns({"class_distance": by_class, "word_distance": by_word})
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ~far).alias("kept"),
                    "class_distance", "word_distance"))

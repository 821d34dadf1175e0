"""Personal data by weak supervision, in DataFrame functions only.

Base spans come from four fixed patterns (email, ip, card, phone). Beyond them,
wide candidate spans (long mixed tokens, long numbers) are judged without any
labels: regex, gazetteer and context labelers vote 1 (personal or secret), 0
(not) or abstain; expectation-maximisation over the counts of vote patterns
estimates how reliable each labeler is; and a logistic span classifier is
trained on the resulting probabilities, over features that exist where all
labelers abstain. Candidates it accepts are added unless they lie within a base
span.

Vote patterns and features are flags, so all that training needs is one grouped
count with a fixed number of possible rows (``2 ** len(FLAGS)`` at most),
whatever the number of documents. Patterns are written so that Java's matcher
runs in linear time and without recursion on very long runs.

Offsets are code points, end exclusive; they are prefix sums over the pieces
between matches and the matches. Defined results: null and empty texts have no
spans. Repeated rows are judged alike; without candidates nothing is added.
Further columns are kept by ``annotated`` unless they have a name it adds.
"""

from __future__ import annotations

from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm import common

# --- base patterns: kind -> (cheap test, pattern) -------------------------------
BASE = {
    "email": ("@", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (r"[0-9][\x20-]?[0-9]", r"[0-9](?:[\x20-]?[0-9])++"),
    "phone": (r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]"),
}
KINDS = [*BASE, "secret", "number"]
# long tokens and numbers of 7 to 19 digits that stand alone
CANDIDATE = r"(?<![A-Za-z0-9_])(?:[A-Za-z0-9_+/=-]{16,}+|[0-9]{7,15}+|[0-9](?:[\x20./-]?[0-9]){6,18}+)(?![A-Za-z0-9_])"
BEFORE, BLOCK = 28, 64
PRIOR = 0.2             # share of candidates taken to be personal before any vote

# Words of the gazetteer and context labelers.
SECRET_WORDS = ["token", "secret", "password", "passwd", "pwd", "apikey", "api_key", "api-key", "key", "auth", "bearer", "credential", "passwort", "contraseña", "clave"]
PERSON_WORDS = ["ssn", "social security", "passport", "iban", "account", "card", "phone", "tel", "call", "mobile", "fax", "licence", "license", "konto", "telefon", "teléfono", "compte", "carte"]
OTHER_WORDS = ["isbn", "issn", "doi", "page", "pages", "vol", "version", "commit", "sha", "md5", "checksum", "order", "invoice", "item", "sku", "price", "http", "www", "href", "src", "build"]
# labelers: flag that votes 1, flag that votes 0, P(1 | personal) and P(1 | not) before any data
LABELERS = [("shape_hex", "shape_word", 0.9, 0.1), ("near_secret", "near_other", 0.8, 0.2), ("near_person", "near_other", 0.8, 0.2),
            ("assigned", "in_path", 0.7, 0.3), ("number_sep", "number_round", 0.6, 0.4), ("luhn", "number_round", 0.95, 0.1)]
STRENGTH = 10           # votes that the prior reliabilities are worth
FEATURES = ["shape_hex", "mixed", "digits", "long", "near_secret", "near_person", "near_other", "assigned", "in_path", "quoted", "number_sep", "shape_word", "luhn"]
FLAGS = sorted({f for labeler in LABELERS for f in labeler[:2]} | set(FEATURES))

SPAN = "struct<start:int,ord:int,stop:int,kind:string>"


def _prefix_sums(a: Column) -> Column:
    """Sum of the elements up to and with each, in blocks so that the work stays near linear."""
    n = F.size(a)
    add = lambda part: F.aggregate(part, F.lit(0), lambda x, y: x + y)
    block = F.lit(BLOCK)
    heads = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")), lambda b: F.struct((b * block).alias("at"), add(F.slice(a, F.lit(1), b * block)).alias("sum")))
    return F.when(n > 0, F.flatten(F.transform(heads, lambda h: F.transform(
        F.sequence(F.lit(1), F.least(block, n - h["at"])), lambda j: h["sum"] + add(F.slice(a, h["at"] + 1, j)))))).otherwise(F.array().cast("array<int>"))


def _empty(kind: str) -> Column:
    return F.array().cast(kind)


def _found(df: DataFrame, text: Column, name: str, test: Column, pattern: str) -> DataFrame:
    """Adds arrays ``{name}_m`` (matches) and ``{name}_at`` (their code point starts)."""
    whole = F.concat(F.lit("(?s)"), F.lit(pattern))
    df = df.withColumns({
        f"{name}_m": F.when(test, F.regexp_extract_all(text, whole, F.lit(0))).otherwise(_empty("array<string>")),
    }).withColumns({
        f"{name}_g": F.when(F.size(f"{name}_m") > 0, F.split(text, "(?s)" + pattern, -1)).otherwise(_empty("array<string>")),
    })
    m, g = F.col(f"{name}_m"), F.col(f"{name}_g")
    steps = F.transform(m, lambda _, i: F.length(g[i]) + F.when(i > 0, F.length(m[i - 1])).otherwise(0))
    return df.withColumn(f"{name}_step", steps).withColumn(f"{name}_at", _prefix_sums(F.col(f"{name}_step"))).drop(f"{name}_g", f"{name}_step")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: acc + _luhn_digit(F.substr(digits, n - i + 1, F.lit(1)).cast("int"), i))
    return total % 10 == 0


def _luhn_digit(d: Column, i: Column) -> Column:
    return F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3) & \
            F.forall(F.split(m, r"\."), lambda p: F.coalesce(F.right(p, F.lit(3)).try_cast("int"), F.lit(0)) <= 255)
    if kind == "card":
        digits = F.regexp_replace(m, r"[\x20-]", "")
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(F.regexp_replace(m, "[^0-9]", "")).between(10, 15)
    return F.lit(True)


def _span(kind: str, start: Column, m: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), F.lit(KINDS.index(kind)).alias("ord"), (start + F.length(m)).cast("int").alias("stop"), F.lit(kind).alias("kind"))


def _checked(kind: str, found: Column) -> Column:
    """Spans of the matches that pass their kind's check."""
    return F.transform(F.filter(found, lambda x: _valid(kind, x["m"])), lambda x: _span(kind, x["at"], x["m"]))


def _any_word(text: Column, words: list[str]) -> Column:
    return text.rlike(r"(?i)(?<![\p{L}])(?:" + "|".join(w.replace("-", r"\-") for w in words) + r")(?![\p{L}])")


def _flags(m: Column, before: Column, after: Column) -> dict[str, Column]:
    """Flags of a candidate from its text and the text around it."""
    digits, letters = m.rlike("[0-9]"), m.rlike("[A-Za-z]")
    return {
        "shape_hex": m.rlike(r"^(?:[0-9a-f]{24,}+|[0-9A-F]{24,}+)$") & letters & digits,
        "shape_word": ~digits,
        "mixed": digits & m.rlike("[A-Z]") & m.rlike("[a-z]"),
        "digits": ~letters,
        "long": F.length(m) >= 32,
        "near_secret": _any_word(before, SECRET_WORDS),
        "near_person": _any_word(before, PERSON_WORDS),
        "near_other": _any_word(before, OTHER_WORDS),
        "assigned": before.rlike("[:=]\\s*[\"']?$"),
        "in_path": before.rlike(r"[/.?&#]$") | after.rlike(r"^[/.]\w"),
        "quoted": before.rlike("[\"'`]$"),
        "number_sep": ~letters & m.rlike(r"[0-9][\x20./-][0-9]"),
        "luhn": F.when(~letters & F.length(F.regexp_replace(m, "[^0-9]", "")).between(14, 19), _luhn(F.regexp_replace(m, "[^0-9]", ""))).otherwise(False),
        "number_round": ~letters & m.rlike(r"0000$|^(?:19|20)[0-9]{6}$"),
    }


def annotated(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``base`` (sorted base spans) and ``cands`` (other candidates with their flags)."""
    keep = [c for c in df.columns if c not in ("base", "cands")]
    df = df.select(*keep).withColumn("_t", F.coalesce(F.col(text).cast("string"), F.lit("")))
    t = F.col("_t")
    spans = []
    for kind, (test, pattern) in BASE.items():
        df = _found(df, t, f"_{kind}", t.contains(test) if kind == "email" else t.rlike(test), pattern)
        m, at = F.col(f"_{kind}_m"), F.col(f"_{kind}_at")
        # the checks see one match at a time, with its start
        spans.append(_checked(kind, F.arrays_zip(m.alias("m"), at.alias("at"))))
    df = df.withColumn("base", F.sort_array(F.concat(*spans)))
    df = _found(df, t, "_cand", t.rlike(r"[A-Za-z0-9_+/=-]{16}|[0-9](?:[\x20./-]?[0-9]){6}"), CANDIDATE)
    zipped = F.transform(F.arrays_zip(F.col("_cand_m").alias("m"), F.col("_cand_at").alias("at")), lambda x: F.struct(
        x["m"].alias("m"), x["at"].cast("int").alias("start"), (x["at"] + F.length(x["m"])).cast("int").alias("stop"),
        F.substr(t, F.greatest(x["at"] - BEFORE, F.lit(0)) + 1, F.least(x["at"], F.lit(BEFORE))).alias("before"),
        F.substr(t, x["at"] + F.length(x["m"]) + 1, F.lit(2)).alias("after")))
    df = df.withColumn("_z", zipped)
    free = F.filter(F.col("_z"), lambda x: ~F.exists(F.col("base"), lambda s: (s["start"] <= x["start"]) & (x["stop"] <= s["stop"])))
    cands = F.transform(free, lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"), *[v.alias(k) for k, v in _flags(x["m"], x["before"], x["after"]).items()]))
    return df.withColumn("cands", cands).select(*keep, "base", "cands")


# --- labelers, expectation-maximisation, classifier -------------------------------
def _vote(row: dict, labeler: tuple) -> int | None:
    return 1 if row[labeler[0]] else 0 if row[labeler[1]] else None


def reliabilities(rows: list[dict], prior: float = PRIOR, rounds: int = 30) -> tuple[list[float], list[list[float]]]:
    """(P(personal) per row, per labeler [P(1 | personal), P(1 | not)]) from vote patterns with counts ``k``.

    The prior is given: candidates on which all labelers abstain say nothing about it.
    """
    votes = [[_vote(r, p) for p in LABELERS] for r in rows]
    # start: the share of votes for 1, drawn to the prior where all abstain
    given = [[v for v in vs if v is not None] for vs in votes]
    p = [(prior + sum(v)) / (1 + len(v)) for v in given]
    rates = [[yes, no] for *_, yes, no in LABELERS]
    for _ in range(rounds):
        for j, (*_, yes, no) in enumerate(LABELERS):
            sums = [[yes * STRENGTH, STRENGTH], [no * STRENGTH, STRENGTH]]   # [votes for 1, votes] among personal and others
            for q, r, vs in zip(p, rows, votes, strict=True):
                if vs[j] is not None:
                    for of, share in zip(sums, (q, 1 - q), strict=True):
                        of[0] += share * r["k"] * vs[j]
                        of[1] += share * r["k"]
            # a labeler is better than chance
            rates[j] = [min(0.99, max(0.5, sums[0][0] / sums[0][1])), min(0.5, max(0.01, sums[1][0] / sums[1][1]))]
        p = []
        for vs in votes:
            z = log(prior / (1 - prior))
            for (yes, no), v in zip(rates, vs, strict=True):
                if v is not None:
                    z += log(yes / no) if v else log((1 - yes) / (1 - no))
            p.append(1 / (1 + exp(-max(-30.0, min(30.0, z)))))
    return p, rates


def span_classifier(rows: list[dict], p: list[float], steps: int = 2000) -> tuple[float, dict[str, float]]:
    """(bias, weight per feature) of a logistic regression on the estimated probabilities.

    A pattern weighs as the logarithm of its count, so that rare ones are learned too.
    """
    w, bias = dict.fromkeys(FEATURES, 0.0), 0.0
    weights = [log(1 + r["k"]) for r in rows]
    total = sum(weights) or 1
    for _ in range(steps):
        g, g0 = dict.fromkeys(FEATURES, 0.0), 0.0
        for r, q, k in zip(rows, p, weights, strict=True):
            z = bias + sum(w[f] for f in FEATURES if r[f])
            e = (1 / (1 + exp(-max(-30.0, min(30.0, z)))) - q) * k / total
            g0 += e
            for f in FEATURES:
                if r[f]:
                    g[f] += e
        bias -= 2.0 * g0
        for f in FEATURES:
            w[f] -= 2.0 * (g[f] + 0.001 * w[f])
    return bias, w


def trained(annotations: DataFrame) -> tuple[float, dict[str, float]]:
    """Classifier weights from the candidates of ``annotated`` rows."""
    counts = annotations.select(F.explode("cands").alias("c")).select("c.*").groupBy(*FLAGS).agg(F.count("*").alias("k"))
    rows = [r.asDict() for r in counts.collect()]   # a row per combination of flags
    if not rows:
        return -30.0, dict.fromkeys(FEATURES, 0.0)
    rows.sort(key=lambda r: tuple(r[f] for f in FLAGS))
    p, _ = reliabilities(rows)
    return span_classifier(rows, p)


def all_spans(model: tuple[float, dict[str, float]]) -> Column:
    """Sorted base and accepted spans of an annotated row."""
    bias, w = model
    weight = lambda c: sum((F.when(c[f], F.lit(w[f])).otherwise(0.0) for f in FEATURES), F.lit(bias))
    kind = lambda c: F.when(c["digits"], F.lit("number")).otherwise(F.lit("secret"))
    ordinal = lambda c: F.when(c["digits"], F.lit(KINDS.index("number"))).otherwise(F.lit(KINDS.index("secret")))
    added = F.transform(F.filter(F.col("cands"), lambda c: weight(c) > 0), lambda c: F.struct(c["start"].alias("start"), ordinal(c).alias("ord"), c["stop"].alias("stop"), kind(c).alias("kind")))
    return F.sort_array(F.concat(F.col("base"), added))


def written_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in angle brackets; overlapping spans are one."""
    start = F.struct(F.lit(0).alias("pos"), _empty("array<string>").alias("parts"))
    done = F.aggregate(spans, start, lambda acc, s: F.when(s["start"] >= acc["pos"], F.struct(
        s["stop"].alias("pos"), F.concat(acc["parts"], F.array(F.substr(text, acc["pos"] + 1, s["start"] - acc["pos"]), F.concat(F.lit("<"), s["kind"], F.lit(">")))).alias("parts"))
    ).otherwise(F.struct(F.greatest(acc["pos"], s["stop"]).alias("pos"), acc["parts"].alias("parts"))),
        lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substr(text, acc["pos"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def personal_data(docs: DataFrame, folder: str) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) of every row of ``docs`` (doc_id, text)."""
    notes = common.written(annotated(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).drop("text"), folder)
    spans = all_spans(trained(notes))
    count = lambda kind: F.size(F.filter(F.col("base"), lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return notes.withColumn("s", spans).select(
        "doc_id", *map(count, BASE), F.sha2(written_spans(F.col("base")), 256).alias("base_sha256"),
        written_spans(F.col("s")).alias("spans"), (F.size("s") - F.size("base")).cast("long").alias("n_added"))

"""Personal data by weak supervision.

Base spans come from patterns with checks.  Further candidates are the other words with a
digit and the gazetteer's names.  Labelers vote on each candidate: patterns (secrets, long
numbers), a gazetteer of names, cue words before it, and shapes that speak against.  Which
votes occur together is counted; expectation-maximisation over these counts estimates each
labeler's reliability and each pattern's posterior.  A naive Bayes classifier over the
candidate's own features is trained on the posteriors and decides on the span.  The counts
are histograms of bounded size, everything else is DataFrame expressions on one text pass.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskline.llm.common import WS_CLASS, staged, text_or_empty

# Base patterns.  Possessive repeats and the anchor "end of the last match, or no such
# character before" give the same leftmost matches without rescanning a long run.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
EXTRA_KINDS = ("secret", "number", "name")

# A small gazetteer of given names, and cue words by kind.
NAMES = (
    "Alice Anna Antonio Carlos Carmen Charles Claire David Elena Elizabeth Emily Emma Fritz George Hans Heinrich "
    "Isabel James Jean Jennifer Johann John Jose Juan Julia Karl Klaus Laura Linda Louis Lucia Luis Manuel Maria "
    "Marie Mary Michael Miguel Nicole Patricia Paul Pedro Peter Pierre Richard Robert Sarah Sophie Susan Thomas William Wolfgang"
).split()
CUES = {
    "secret": r"(?i)\b(?:token|secret|password|passwd|pwd|api[_ -]?key|key|bearer|credential)s?\b[^\n]{0,6}$",
    "number": r"(?i)\b(?:account|iban|passport|ssn|social security|id|licence no|phone|tel|call|mobile|fax|konto|cuenta|compte)\b[^\n]{0,6}$",
    "name": r"(?i)\b(?:mr|mrs|ms|dr|herr|frau|señor|señora|monsieur|madame|name is|named|dear)\b[^\n]{0,4}$",
}
#: Characters before a candidate in which a cue counts.
CUE_CHARS = 32
CANDIDATE = rf"(?:\G|(?<![^{WS_CLASS}]))(?:[^{WS_CLASS}0-9]*+[0-9][^{WS_CLASS}]*+|(?:{'|'.join(NAMES)})(?![^{WS_CLASS},.;:!?]))"
EM_ROUNDS = 30
PRIOR = 0.1
#: Reliability that every labeler starts with, and its weight in pseudo-counts.
START, START_WEIGHT = 0.85, 10.0
ACCEPT = 0.5


def spans(text: Column, pattern: str, may: Column) -> Column:
    """array<struct(start, end, s)> of the leftmost non-overlapping matches, in code points.

    ``may`` is a cheap test that is true wherever the pattern matches."""
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, s: F.struct(F.length(g).alias("gap"), s.alias("s"), F.substring(g, -CUE_CHARS, CUE_CHARS).alias("pre")))
    kind = "array<struct<start:int,end:int,s:string,pre:string>>"
    summed = F.aggregate(
        steps,
        F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + F.length(x["s"])).alias("at"),
            F.concat(acc["out"], F.array(F.struct((acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + F.length(x["s"])).alias("end"), x["s"].alias("s"), x["pre"].alias("pre")))).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    return F.when(may, summed).otherwise(F.array().cast(kind))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]+", "")


def luhn(digits: Column) -> Column:
    """Whether the check sum of a string of digits holds."""
    each = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(F.element_at(F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), d.cast("int") + 1)),
    )
    return F.aggregate(each, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def _valid_ip(s: Column) -> Column:
    part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
    return F.forall(F.split(s, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.coalesce(F.try_to_number(F.substring(part(p), 1, 3), F.lit("999")).cast("int"), F.lit(999)) <= 255))


def _found(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, base spans by kind, and candidates outside them, without the text."""
    text = F.col("_text")
    digit = text.rlike("[0-9]")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("_text"))
    n = lambda s: F.length(_digits(s))
    rows = (
        rows.withColumn("email", spans(text, EMAIL, F.contains(text, F.lit("@"))))
        .withColumn("ip", F.filter(spans(text, IP, digit), lambda x: _valid_ip(x["s"])))
        .withColumn("card", F.filter(spans(text, CARD, digit), lambda x: n(x["s"]).between(12, 19) & luhn(_digits(x["s"]))))
        .withColumn("phone", F.filter(spans(text, PHONE, F.contains(text, F.lit("+"))), lambda x: n(x["s"]).between(9, 15)))
        .withColumn("more", spans(text, CANDIDATE, digit | text.rlike(rf"\b(?:{'|'.join(NAMES)})\b")))
    )
    slim = lambda c: F.transform(c, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    rows = rows.select("doc_id", *[slim(F.col(k)).alias(k) for k in KINDS], "more")
    base = rows.withColumn("base", F.concat(*KINDS))
    free = F.filter("more", lambda m: ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    return base.select("doc_id", *KINDS, F.transform(free, _described).alias("more"))


def _described(m: Column) -> Column:
    """A candidate's place, labelers' votes and the classifier's features."""
    core = F.regexp_replace(m["s"], r"^[\"'(\[{<]+|[\"')\]}>,.;:!?]+$", "")
    lead = F.length(m["s"]) - F.length(F.regexp_replace(m["s"], r"^[\"'(\[{<]+", ""))
    digits, size = F.length(_digits(core)), F.length(core)
    name = core.rlike(rf"^(?:{'|'.join(NAMES)})$")
    secret = core.rlike(r"^(?=[A-Za-z0-9_+/=-]*[0-9])(?=[A-Za-z0-9_+/=-]*[A-Za-z])[A-Za-z0-9_+/=-]{20,}$")
    number = core.rlike(r"^[0-9][0-9 .()/-]*$")
    shape = F.when(secret, "secret").when(name, "name").when(number, "number").otherwise("other")
    cue = F.coalesce(*[F.when((shape == k) & m["pre"].rlike(c), F.lit(1)) for k, c in CUES.items()], F.lit(0))
    votes = F.concat_ws(
        "",
        F.when(secret, "+").otherwise("0"),  # secret's shape
        F.when(number & digits.between(9, 11), "+").otherwise("0"),  # a number's shape
        F.when(name, "+").otherwise("0"),  # gazetteer
        F.when(cue == 1, "+").otherwise("-"),  # context
        F.when(~(secret | name | number), "-").when(number & ~digits.between(6, 11), "-").otherwise("0"),  # no known shape, plain figures, failed check sums
    )
    return F.struct(
        (m["start"] + lead).alias("start"), (m["start"] + lead + size).alias("end"), votes.alias("votes"),
        shape.alias("shape"), F.least(F.floor(size / 8), F.lit(6)).cast("int").alias("length"), cue.alias("cue"),
        F.when(digits == size, "all").when(digits * 2 >= size, "most").otherwise("few").alias("digits"),
    )


FEATURES = ("shape", "length", "cue", "digits")


def expectation_maximisation(patterns: dict[str, float], rounds: int = EM_ROUNDS) -> tuple[dict[str, float], list[float]]:
    """Posterior of each vote pattern and reliability of each labeler, for two classes.

    A labeler votes '+' or '-', or abstains ('0'), and is right with one probability."""
    k = max((len(p) for p in patterns), default=0)
    right, prior, post = [START] * k, PRIOR, {}
    for _ in range(rounds):
        for p in patterns:
            yes = no = 0.0
            for v, r in zip(p, right):
                if v != "0":
                    yes += math.log(r if v == "+" else 1 - r)
                    no += math.log(1 - r if v == "+" else r)
            odds = math.log(prior / (1 - prior)) + yes - no
            post[p] = 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))
        total = sum(patterns.values())
        prior = min(0.5, max(0.01, (sum(n * post[p] for p, n in patterns.items()) + PRIOR) / (total + 1)))
        for j in range(k):
            hit, all_ = START * START_WEIGHT, START_WEIGHT
            for p, n in patterns.items():
                if p[j] != "0":
                    hit += n * (post[p] if p[j] == "+" else 1 - post[p])
                    all_ += n
            right[j] = min(0.99, max(0.5, hit / all_))
    return post, right


def train(found: DataFrame) -> tuple[float, dict[tuple[str, str], float]]:
    """Prior log-odds and log-odds of each feature value, from posteriors of vote patterns."""
    seen = found.select(F.explode("more").alias("m")).groupBy("m.votes", *[f"m.{f}" for f in FEATURES]).agg(F.count("*").alias("n")).collect()
    patterns: dict[str, float] = {}
    for r in seen:  # at most patterns x feature values, a bounded histogram
        patterns[r["votes"]] = patterns.get(r["votes"], 0.0) + r["n"]
    post, _ = expectation_maximisation(patterns)
    yes, no = 1.0, 1.0
    by: dict[tuple[str, str], list[float]] = {}
    for r in seen:
        p = post[r["votes"]]
        yes += r["n"] * p
        no += r["n"] * (1 - p)
        for f in FEATURES:
            pair = by.setdefault((f, str(r[f])), [0.5, 0.5])
            pair[0] += r["n"] * p
            pair[1] += r["n"] * (1 - p)
    return math.log(yes / no), {k: math.log((a / yes) / (b / no)) for k, (a, b) in by.items()}


def _accepted(model, m: Column) -> Column:
    prior, weight = model
    score = F.lit(prior)
    for f in FEATURES:
        part = F.lit(0.0)
        for (name, value), w in sorted(weight.items()):
            if name == f:
                part = F.when(m[f].cast("string") == value, F.lit(w)).otherwise(part)
        score = score + part
    return (score >= math.log(ACCEPT / (1 - ACCEPT))) & (m["shape"] != "other")


def private_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Null texts are empty: no spans, the digest of an empty string.  Offsets are code points,
    ends exclusive.  Spans are ordered by start, then kind.  Added kinds are secret, number
    and name; they never overlap base spans.  Repeated rows get equal spans; other columns
    are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = staged(_found(rows, "doc_id", "text"), "found")
    model = train(found)
    order = {k: i for i, k in enumerate((*KINDS, *EXTRA_KINDS))}
    names = F.array(*[F.lit(k) for k in order])

    def placed(col, number):
        return F.transform(col, lambda x: F.struct(x["start"].alias("start"), number(x).cast("int").alias("kind"), x["end"].alias("end")))

    def joined(col):
        return F.array_join(F.transform(F.array_sort(col), lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")

    base = F.concat(*[placed(F.col(k), lambda x, k=k: F.lit(order[k])) for k in KINDS])
    extra_kind = lambda x: F.coalesce(*[F.when(x["shape"] == k, F.lit(order[k])) for k in EXTRA_KINDS], F.lit(len(order) - 1))
    extra = placed(F.filter("more", lambda m: _accepted(model, m)), extra_kind)
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.concat(base, extra)).alias("spans"),
    )

"""Personal data by weak supervision, in DataFrame functions only.

1. Base spans: e-mail, IP, card and phone patterns with their checks. The patterns are possessive
   and anchored at the start of a run, so texts of any length cost linear time.
2. Candidates: words with a digit or an at sign. Labelers vote on each: yes, no or no opinion.
   They are regular expressions, gazetteers and the word before.
3. Expectation-maximisation over the counts of vote patterns (at most 3 to the number of labelers,
   counted by Spark over all candidates) estimates how reliable each labeler is and how likely
   each pattern is personal data.
4. A naive Bayes span classifier is trained on these likelihoods: Spark sums them by feature of
   span and context (a fixed number of features). Candidates it accepts, where no base span lies,
   are added with kind ``other``; base spans always stay.

Defined cases: null text is empty; repeated rows each get their result; rows without doc_id are
handled like others; without candidates nothing is added; equal starts are ordered by kind; an
empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.frames import bound, running, stored

# The base patterns. ``\G`` lets a match begin inside a run where the last one ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "other")
# A word of six characters or more that holds a digit or an at sign.
CANDIDATE = r"(?<![^\x20\x09-\x0D])(?=[^\x20\x09-\x0D0-9@]*+[0-9@])[^\x20\x09-\x0D]{6,}+"
PUNCTUATION = "\"'`.,;:!?()[]{}<>"

# Gazetteers.
CREDENTIAL_PREFIXES = ("AKIA", "ASIA", "AIza", "ghp_", "gho_", "glpat-", "sk-", "pk_", "xoxb-", "xoxp-", "eyJ")
CUES = (
    "account", "address", "call", "card", "contact", "email", "fax", "iban", "id", "ip", "key", "login", "mail", "mobile", "passport",
    "password", "phone", "pin", "secret", "ssn", "tel", "telephone", "token", "user", "username",
)
BENIGN_CUES = ("chapter", "copyright", "figure", "license", "licensed", "page", "section", "step", "table", "under", "version", "volume")

NO, NONE, YES = "n", "0", "y"


def _none() -> Column:
    return F.array().cast("array<struct<begin:int,rank:int,end:int>>")


def matches(text: Column, pattern: str, use: Callable[[Column], Column]) -> Column:
    """An expression over the matches of a pattern, leftmost and non-overlapping: ``begin, hit`` and
    ``before``, the end of the text between a match and the one before it.

    Matches alternate with the pieces between them, so the running sum of lengths gives places.
    """

    def placed(pieces: Column) -> Column:
        starts = running(F.transform(pieces, lambda x: x["gap"] + F.coalesce(F.char_length(x["hit"]), F.lit(0))), lambda a, b: a + b, F.lit(0))
        joined = F.zip_with(pieces, starts, lambda x, at: F.struct((at + x["gap"]).alias("begin"), x["hit"].alias("hit"), x["before"].alias("before")))
        return use(F.filter(joined, lambda x: x["hit"].isNotNull()))

    pieces = F.zip_with(
        F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda p, h: F.struct(F.char_length(p).alias("gap"), h.alias("hit"), F.right(p, F.lit(40)).alias("before")),
    )
    return bound(pieces, placed)


def found(text: Column, pattern: str, rank: int, valid: Callable[[Column], Column]) -> Column:
    """The spans of a pattern, those that fail the check left out."""
    span = lambda x: F.struct(x["begin"].alias("begin"), F.lit(rank).alias("rank"), (x["begin"] + F.char_length(x["hit"])).alias("end"))
    return matches(text, pattern, lambda hits: F.transform(F.filter(hits, lambda x: valid(x["hit"])), span))


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def is_ip(x: Column) -> Column:
    part = lambda p: F.ltrim(p, F.lit("0"))
    return F.forall(F.split(x, r"\."), lambda p: (F.char_length(part(p)) <= 3) & (F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255))


def is_card(x: Column) -> Column:
    d = digits(x)
    n = F.char_length(d)
    at = lambda i: F.substring(d, n - i, F.lit(1)).try_cast("int")
    value = lambda i: F.when(i % 2 == 0, at(i)).otherwise(2 * at(i) - F.when(at(i) > 4, 9).otherwise(0))
    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda s, i: s + value(i))
    return F.when(n.between(12, 19), total % 10 == 0).otherwise(F.lit(False))


def is_phone(x: Column) -> Column:
    return F.char_length(digits(x)).between(9, 15)


def base_spans(text: Column) -> Column:
    """All base spans of a text, by start, then kind. Patterns run only where they can match."""
    some = [
        (F.contains(text, F.lit("@")), EMAIL, lambda x: F.lit(True)), (text.rlike(r"[0-9]\.[0-9]"), IP, is_ip),
        (text.rlike(r"[0-9][\x20-]?[0-9]"), CARD, is_card), (F.contains(text, F.lit("+")), PHONE, is_phone),
    ]
    each = [F.when(can, found(text, pattern, rank, valid)).otherwise(_none()) for rank, (can, pattern, valid) in enumerate(some)]
    return F.array_sort(F.concat(*each))


def check_digits(word: Column) -> Column:
    """Whether a bare card number or address in dots passes its check; other words have none."""
    card, ip = word.rlike("^[0-9]{12,}$"), word.rlike(r"^[0-9]+(?:\.[0-9]+){3}$")
    return F.when(card, F.when(is_card(word), "passed").otherwise("failed")).when(ip, F.when(is_ip(word), "passed").otherwise("failed")).otherwise("none")


def labelers(word: Column, before: Column) -> list[Column]:
    """A vote of each labeler on a word and the word before it."""
    n_digits = F.char_length(digits(word))

    def votes(yes: Column, no: Column | None = None) -> Column:
        vote = F.when(yes, YES)
        return (vote if no is None else vote.when(no, NO)).otherwise(NONE)

    shape = word.rlike(r"^(?:[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+|\+[0-9][0-9().-]{8,20})$") | (check_digits(word) == "passed")
    secret = word.rlike(r"(?i)^(?:pass(?:word|wd)?|pwd|token|secret|api[_-]?key)[=:]\S{6,}$") | word.rlike(r"^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9_+/=-]{16,}$")
    listed = F.lit(False)
    for prefix in CREDENTIAL_PREFIXES:
        listed = listed | F.startswith(word, F.lit(prefix))
    plain = word.rlike(r"^(?:v?[0-9]{1,6}(?:[.,][0-9]{1,4}){0,2}%?|[0-9]{1,4}[-/][0-9]{1,2}[-/][0-9]{1,4}|[A-Za-z]{1,3}[0-9]{1,3})$")
    return [
        votes(shape), votes(secret), votes(listed), votes(F.lit(False), plain | (check_digits(word) == "failed")),
        votes(before.isin(*CUES), before.isin(*BENIGN_CUES)), votes((n_digits >= 9) & (check_digits(word) != "failed"), (n_digits <= 2) & (F.char_length(word) < 12) & ~F.contains(word, F.lit("@"))),
    ]


def features(word: Column, before: Column) -> Column:
    """Names of the features of a span: a fixed number of them."""
    count = lambda pattern: F.least(F.char_length(word) - F.char_length(F.regexp_replace(word, pattern, "")), F.lit(12))
    parts = {
        "length": F.least(F.char_length(word), F.lit(40)), "digits": count("[0-9]"), "upper": count("[A-Z]"), "lower": count("[a-z]"), "at": count("@"), "equals": count("[=:]"),
        "dots": count(r"\."), "dashes": count("[-_]"), "letters beyond": F.least(count("[^ -~]"), F.lit(1)), "check": check_digits(word), "before": F.pmod(F.xxhash64(before), F.lit(64)),
    }
    return F.array(*(F.concat(F.lit(f"{name} "), value.cast("string")) for name, value in parts.items()))


def candidates(text: Column) -> Column:
    """Candidate words with their place, votes and features."""
    kind = "array<struct<begin:int,end:int,votes:string,features:array<string>>>"

    def entry(x: Column) -> Column:
        lead = F.char_length(x["hit"]) - F.char_length(F.ltrim(x["hit"], F.lit(PUNCTUATION)))
        before = F.lower(F.regexp_extract(x["before"], r"(\p{L}+)[^\p{L}]*$", 1))
        return F.struct((x["begin"] + lead).alias("begin"), F.btrim(x["hit"], F.lit(PUNCTUATION)).alias("word"), before.alias("before"))

    def judged(x: Column) -> Column:
        word, before = x["word"], x["before"]
        return F.struct(
            x["begin"].alias("begin"), (x["begin"] + F.char_length(word)).alias("end"), F.concat(*labelers(word, before)).alias("votes"), features(word, before).alias("features")
        )

    long_enough = lambda hits: F.filter(F.transform(hits, entry), lambda x: F.char_length(x["word"]) >= 6)
    some = matches(text, CANDIDATE, lambda hits: F.transform(long_enough(hits), judged))
    return F.when(text.rlike("[0-9@]"), some).otherwise(F.array().cast(kind))


def clear_of(base: Column, spans: Column) -> Column:
    """The numbers of the spans that overlap none of the base spans.

    All are put in order of their begin. A span is met by a base span that begins no later if the
    greatest end so far lies beyond its begin, by one that begins later if the next begin lies
    before its end.
    """
    ends = F.transform(base, lambda b: F.struct(b["begin"].alias("begin"), F.lit(0).alias("side"), b["end"].alias("end"), F.lit(-1).alias("number")))
    own = F.transform(spans, lambda c, i: F.struct(c["begin"].alias("begin"), F.lit(1).alias("side"), c["end"].alias("end"), i.alias("number")))
    last = (1 << 31) - 1

    def swept(events: Column) -> Column:
        reach = running(F.transform(events, lambda e: F.when(e["side"] == 0, e["end"]).otherwise(0)), lambda a, b: F.greatest(a, b), F.lit(0))
        back = F.transform(F.reverse(events), lambda e: F.when(e["side"] == 0, e["begin"]).otherwise(last))
        following = F.reverse(running(back, lambda a, b: F.least(a, b), F.lit(last)))
        both = F.zip_with(reach, following, lambda r, n: F.struct(r.alias("reach"), n.alias("next")))
        clear = F.zip_with(events, both, lambda e, x: F.when((e["side"] == 1) & (x["reach"] <= e["begin"]) & (x["next"] >= e["end"]), e["number"]))
        return F.filter(clear, lambda n: n.isNotNull())

    return bound(F.array_sort(F.concat(ends, own)), swept)


def reliabilities(counts: dict[str, int], rounds: int = 60) -> dict[str, float]:
    """The likelihood of personal data for each vote pattern, by expectation-maximisation.

    Labelers are independent given the truth. Each has one reliability, the chance that a vote of
    its is right; having no opinion tells nothing. Eight votes in ten are taken to be right before
    any is seen, as if from ten votes, and either truth to be as likely.
    """
    if not counts:
        return {}
    n = len(next(iter(counts)))
    right = [0.8] * n
    posterior: dict[str, float] = {}
    for _ in range(rounds):
        weight = [math.log(r / (1 - r)) for r in right]
        for p in counts:
            odds = sum(w * ((v == YES) - (v == NO)) for w, v in zip(weight, p, strict=True))
            posterior[p] = 1 / (1 + math.exp(-min(max(odds, -30), 30)))
        for j in range(n):
            agreed = sum(c * (posterior[p] if p[j] == YES else 1 - posterior[p]) for p, c in counts.items() if p[j] != NONE)
            voted = sum(c for p, c in counts.items() if p[j] != NONE)
            right[j] = (agreed + 8) / (voted + 10)
    return posterior


def looked_up(table: dict[str, float], key: Column, other: float) -> Column:
    if not table:
        return F.lit(other)
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), key), F.lit(other))


def train(spans: DataFrame) -> tuple[float, dict[str, float]]:
    """Prior log-odds and log-odds of each feature, from frames of ``votes, features``."""
    counts = {r["votes"]: r["n"] for r in spans.groupBy("votes").agg(F.count("*").alias("n")).collect()}  # at most 3**6 rows
    likely = reliabilities(counts)
    soft = spans.withColumn("p", looked_up(likely, F.col("votes"), 0.0))
    sums = soft.select("p", F.explode("features").alias("feature")).groupBy("feature").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()  # a fixed number of features
    positive = sum(c * likely[p] for p, c in counts.items())
    negative = sum(counts.values()) - positive
    weights = {r["feature"]: math.log((r["yes"] + 0.5) / (positive + 1)) - math.log((r["no"] + 0.5) / (negative + 1)) for r in sums}
    return math.log((positive + 1) / (negative + 1)), dict(sorted(weights.items()))


def detect(docs: DataFrame) -> DataFrame:
    """``doc_id, base, spans``: arrays of ``begin, rank, end`` by begin, then kind."""
    text = F.coalesce("text", F.lit(""))
    rows = stored(docs.select("doc_id", base_spans(text).alias("base"), candidates(text).alias("candidates")), "pii-candidates")
    prior, weights = train(rows.select(F.explode("candidates").alias("c")).select("c.votes", "c.features"))

    def accepted(c: Column) -> Column:
        return F.aggregate(c["features"], F.lit(prior), lambda s, f: s + looked_up(weights, f, 0.0)) > 0

    clear = F.transform(clear_of(F.col("base"), F.col("candidates")), lambda n: F.get("candidates", n))
    other = F.transform(F.filter(clear, accepted), lambda c: F.struct(c["begin"].alias("begin"), F.lit(len(KINDS) - 1).alias("rank"), c["end"].alias("end")))
    return rows.select("doc_id", "base", F.array_sort(F.concat("base", other)).alias("spans"))


def named(spans: str) -> Column:
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["begin"].cast("string"), s["end"].cast("string"))), ",")


def of_kind(rank: int) -> Callable[[Column], Column]:
    return lambda s: s["rank"] == rank


def report(docs: DataFrame) -> DataFrame:
    n = [F.size(F.filter("base", of_kind(r))).cast("long").alias(f"n_{k}") for r, k in enumerate(KINDS[:4])]
    return detect(docs).select("doc_id", *n, F.sha2(named("base"), 256).alias("base_sha256"), named("spans").alias("spans"))

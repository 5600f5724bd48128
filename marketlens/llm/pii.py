"""Personal data: patterns, and a span classifier trained by weak supervision.

Everything runs as DataFrame functions. Four kinds have a fixed pattern and are always
reported: email, ip, card, phone. Other long tokens and numbers are candidates. Labelers look
at a candidate's shape (patterns), at lists of known prefixes (gazetteers) and at the words
before it (context) and vote for, against or not at all. Expectation-maximisation over the
counts of vote patterns estimates how reliable each labeler is and how likely each pattern is
personal data; a logistic model of the candidate's features is trained on these likelihoods
and decides about each candidate. Patterns and features take few values by construction, so
only small count tables reach the driver.

No pattern backtracks over a long run or recurses: a start is only tried where a run begins
(or where the last match ended), repeats are possessive and of single characters. For that,
signs that may only stand between digits or labels are first replaced, one for one, by a
control character.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "secret", "number")  # the first four are always reported
BASE = KINDS[:4]
EM_STEPS, FIT_STEPS = 50, 300
CONTEXT = 24  # characters before a candidate that context labelers see
_MARK = "\x1a"

_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+\x1a-])|\G)[A-Za-z0-9._%+\x1a-]++@(?=[A-Za-z0-9-]++\.)[A-Za-z0-9.-]++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9][0-9\x1a]++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9])(?=[A-Za-z]*+[0-9])[A-Za-z0-9]{16,}+",
    "number": r"(?<![A-Za-z0-9+])[0-9][0-9\x1a]{7,}+(?![A-Za-z0-9])",
}
# Gazetteers: prefixes of access keys, first digits of card issuers, and words of the context.
KEY_PREFIXES = ("AKIA", "ASIA", "ghp", "gho", "glpat", "sk", "pk", "xox", "AIza", "ya29", "eyJ")
ISSUERS = ("34", "37", "4", "51", "52", "53", "54", "55", "6011", "65")
CUES = ("token", "secret", "password", "passwd", "apikey", "api key", "key", "card", "account", "iban", "phone", "tel", "mobile", "call", "ssn")
COUNTER_CUES = ("version", "isbn", "page", "chapter", "figure", "vol", "sha1", "md5", "commit", "digest", "checksum")


def _prepared(kind: str) -> Column:
    """The text that a kind's pattern is run on, character by character as long as the text."""
    text = F.translate(F.col("text"), _MARK, " ") if kind in ("email", "card", "number") else F.col("text")
    if kind == "email":  # a dot that no label follows can't be in a domain
        return F.regexp_replace(text, r"\.(?![A-Za-z0-9-])", _MARK)
    if kind in ("card", "number"):  # single separators between digits
        return F.regexp_replace(text, "(?<=[0-9])[ -](?=[0-9])" if kind == "card" else "(?<=[0-9])[ .-](?=[0-9])", _MARK)
    return text


def _may_have(kind: str) -> Column:
    """A cheap test that every text with a match passes."""
    return F.col("text").contains({"email": "@", "phone": "+"}[kind]) if kind in ("email", "phone") else F.col("text").rlike("[0-9]")


def running_sums(values: Column, block: int = 128) -> Column:
    """Sums of the first 1, 2, ... values, in blocks so that the cost grows with the length."""
    blocks = F.when(F.size(values) > 0, F.sequence(F.lit(0), F.floor((F.size(values) - 1) / block).cast("int"))).otherwise(F.array().cast("array<int>"))

    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0).cast("long"), lambda x, y: x + y)

    totals = F.transform(blocks, lambda b: total(F.slice(values, b * block + 1, F.lit(block))))
    return F.flatten(F.transform(blocks, lambda b: F.transform(
        F.sequence(F.lit(1), F.least(F.lit(block), F.size(values) - b * block)),
        lambda i: total(F.slice(totals, F.lit(1), b)) + total(F.slice(values, b * block + 1, i)))))


def _with_matches(rows: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Add ``spans``: for each match its start, kind rank, end, kind, text and the text before."""
    none = F.array().cast("array<string>")
    rows = rows.withColumns({f"p_{k}": F.when(_may_have(k), _prepared(k)) for k in kinds})
    rows = rows.withColumns({c: e for k in kinds for c, e in (
        (f"m_{k}", F.when(F.col(f"p_{k}").isNotNull(), F.regexp_extract_all(f"p_{k}", F.lit(PATTERNS[k]), F.lit(0))).otherwise(none)),
        (f"b_{k}", F.when(F.col(f"p_{k}").isNotNull(), F.split(f"p_{k}", PATTERNS[k], -1)).otherwise(none)))})

    def steps(k: str) -> Column:
        """From each match's start back to that of the match before."""
        return F.transform(f"m_{k}", lambda m, i: (
            F.length(F.get(f"b_{k}", i)) + F.when(i > 0, F.length(F.get(f"m_{k}", i - 1))).otherwise(0)).cast("long"))

    def made(k: str) -> Column:
        return F.transform(f"m_{k}", lambda m, i: F.struct(
            F.get(f"s_{k}", i).alias("start"), F.lit(KINDS.index(k)).alias("rank"), (F.get(f"s_{k}", i) + F.length(m)).alias("end"),
            F.lit(k).alias("kind"), m.alias("match"), F.right(F.get(f"b_{k}", i), F.lit(CONTEXT)).alias("before")))

    rows = rows.withColumns({f"l_{k}": steps(k) for k in kinds})
    rows = rows.withColumns({f"s_{k}": running_sums(F.col(f"l_{k}")) for k in kinds})
    return rows.withColumn("spans", F.filter(F.concat(*map(made, kinds)), _holds)).drop(*(f"{x}_{k}" for x in "pmbls" for k in kinds))


def _digits(span: Column) -> Column:
    return F.regexp_replace(span["match"], "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits, each second one from the right doubled, sum to a multiple of 10."""
    turned = F.reverse(digits)
    def add(total: Column, i: Column) -> Column:
        digit = F.substring(turned, i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, digit).otherwise(digit * 2 - F.when(digit > 4, 9).otherwise(0))
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _holds(span: Column) -> Column:
    """Checks of a match beyond its pattern; one that fails is dropped."""
    n = F.length(_digits(span))
    return (
        F.when(span["kind"] == "ip", span["match"].rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))
        .when(span["kind"] == "card", F.when(n.between(12, 19), _luhn(_digits(span))).otherwise(False))
        .when(span["kind"] == "phone", n.between(9, 15))
        .when(span["kind"] == "number", n.between(9, 19))
        .otherwise(True))


def _candidates_alone(spans: Column) -> Column:
    """Candidates that touch no reported span and no candidate of an earlier kind."""
    return F.filter(spans, lambda c: (c["rank"] >= len(BASE)) & ~F.exists(
        spans, lambda s: (s["rank"] < c["rank"]) & (s["start"] < c["end"]) & (c["start"] < s["end"])))


def _listed(words: tuple[str, ...]) -> str:
    return "(?:" + "|".join(words) + ")"


def _vote(yes: Column, no: Column | None = None) -> Column:
    vote = F.when(yes, "+")
    return (vote if no is None else vote.when(no, "-")).otherwise("0")


def votes(c: Column) -> Column:
    """The labelers' votes for one candidate, one sign each: +, - or 0."""
    match, before, n = c["match"], F.lower(c["before"]), F.length(_digits(c))
    secret, size = c["kind"] == "secret", F.length(c["match"])
    return F.concat(
        # patterns
        _vote(F.when(secret, match.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$") & size.isin(32, 40, 64)).otherwise(n.isin(10, 11, 16)), ~secret & n.isin(13, 14)),
        _vote(F.when(secret, (n >= size * 0.2) & (n <= size * 0.8)).otherwise(match.rlike(_MARK)), secret & (n <= 2)),
        # gazetteers
        _vote(F.when(secret, match.rlike(f"^{_listed(KEY_PREFIXES)}")).otherwise((n >= 15) & match.rlike(f"^{_listed(ISSUERS)}"))),
        # context
        _vote(before.rlike(f"{_listed(CUES)}[^a-z]*$"), before.rlike(f"{_listed(COUNTER_CUES)}[^a-z]*$")),
        _vote(before.rlike("[=:] ?[\"']?$")),
    )


FEATURES = ("secret", "hex", "wide", "mixed", "cue", "counter_cue", "assigned", "separated")


def features(c: Column) -> Column:
    """Yes-or-no features of one candidate as a string of 0 and 1, in the order of FEATURES."""
    before, n, size = F.lower(c["before"]), F.length(_digits(c)), F.length(c["match"])
    flags = (
        c["kind"] == "secret", c["match"].rlike("^[0-9a-f]+$"), size >= 24, (n >= size * 0.2) & (n <= size * 0.8),
        before.rlike(_listed(CUES)), before.rlike(_listed(COUNTER_CUES)), before.rlike("[=:] ?[\"']?$"), c["match"].rlike(_MARK))
    return F.concat(*(F.when(f, "1").otherwise("0") for f in flags))


def reliabilities(counts: dict[str, int]) -> tuple[dict[str, float], list[dict[str, tuple[float, float]]]]:
    """Likelihood of each vote pattern, and each labeler's vote rates for (not PII, PII).

    Two-class expectation-maximisation, started from the majority of the votes.
    """
    likely = {p: (1 + p.count("+")) / (2 + p.count("+") + p.count("-")) for p in counts}
    rates: list[dict[str, tuple[float, float]]] = []
    for _ in range(EM_STEPS):
        weight = [sum(n * (1 - likely[p]) for p, n in counts.items()), sum(n * likely[p] for p, n in counts.items())]
        rates = []
        for k in range(len(next(iter(counts), ""))):
            seen = {v: [1.0, 1.0] for v in "+-0"}
            for p, n in counts.items():
                seen[p[k]][0] += n * (1 - likely[p])
                seen[p[k]][1] += n * likely[p]
            rates.append({v: (a / (weight[0] + 3), b / (weight[1] + 3)) for v, (a, b) in seen.items()})
        prior = (weight[1] + 1) / (sum(weight) + 2)
        for p in counts:
            odds = math.log(prior / (1 - prior)) + sum(math.log(r[v][1] / r[v][0]) for r, v in zip(rates, p, strict=True))
            likely[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return likely, rates


def span_weights(rows: list[tuple[str, float, int]]) -> list[float]:
    """Logistic weights (last: the bias) from (features, likelihood, count)."""
    weights = [0.0] * (len(FEATURES) + 1)
    total = sum(n for *_, n in rows)
    for _ in range(FIT_STEPS if total else 0):
        slope = [1e-3 * w for w in weights]
        for flags, likely, n in rows:
            x = [int(f) for f in flags] + [1]
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(weights, x, strict=True))))))
            for k, v in enumerate(x):
                slope[k] += v * n * (p - likely) / total
        weights = [w - 2.0 * s for w, s in zip(weights, slope, strict=True)]
    return weights


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text") -> list[float]:
    """Weights of the span classifier, learned from all candidates of all texts.

    The two count tables have at most 3**5 vote patterns times 2**8 feature strings.
    """
    found = _with_matches(_rows(docs, key, text), KINDS).select(F.explode(_candidates_alone(F.col("spans"))).alias("c"))
    table = found.select(votes(F.col("c")).alias("votes"), features(F.col("c")).alias("features")).groupBy("votes", "features").count().collect()
    counts: dict[str, int] = {}
    for r in table:
        counts[r.votes] = counts.get(r.votes, 0) + r["count"]
    likely, _ = reliabilities(counts)
    return span_weights([(r.features, likely[r.votes], r["count"]) for r in sorted(table)])


def find(docs: DataFrame, weights: list[float], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans) of every row: spans by start, then kind, as (start, rank, end, kind).

    Offsets are code points, end exclusive. Reported kinds always stay; a candidate is added if
    the classifier's probability is over one half. One row for each input row, repeated and null
    keys included; a null or empty text has no spans. Other columns are not read.
    """
    rows = _with_matches(_rows(docs, key, text), KINDS)
    rows = rows.withColumn("added", F.transform(_candidates_alone(F.col("spans")), lambda c: F.struct(c.alias("c"), features(c).alias("f"))))

    def odds(f: Column) -> Column:
        return reduce(Column.__add__, (F.substring(f, k + 1, 1).cast("int") * w for k, w in enumerate(weights[:-1])), F.lit(weights[-1]))

    added = F.transform(F.filter("added", lambda a: odds(a["f"]) > 0), lambda a: a["c"])
    kept = F.array_sort(F.concat(F.filter("spans", lambda s: s["rank"] < len(BASE)), added))
    return rows.select(F.col("key").alias(key), F.transform(kept, lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"])).alias("spans"))


def spelled(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

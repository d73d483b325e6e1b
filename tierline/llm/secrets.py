"""Secret scans: three base patterns, and character Markov models for what they miss.

A first-order Markov model of random strings and one of ordinary identifiers are trained from labelled
strings; a candidate token is a secret where the log-likelihood ratio of the two, by character and in
total, is high enough. Everything is column expressions: spans by pattern, weights in one literal of
fixed size (ALPHABET squared), scores by a fold over a token's characters.

Null text counts as empty; an empty text has no spans; equal texts have equal spans; an empty table
gives an empty one. Without labelled strings the models keep their priors. Texts and tokens may be as
long as a row can hold.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.exprs import let, spans_of, whole, words_of

# The base patterns, as the contract states them. For access and hex the least length is
# part of the pattern, which finds the same spans as taking whole runs and dropping the short ones.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
LEAST_VALUE = 12
KINDS = ("assign", "access", "hex", "markov")

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
FIRST, LAST = 33, 126  # visible ASCII; all else is one class
ALPHABET = LAST - FIRST + 2
RANDOM_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SAMPLE_DOCS = 2000
LEAST_RATIO = 0.75  # nats per transition
LEAST_TOTAL = 15.0  # nats


def base_spans(text: Column) -> Column:
    """array<struct(start, kind, end)> of the base patterns, unordered."""

    def kind(spans: Column, name: str) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"], F.lit(KINDS.index(name)).alias("kind"), s["end"]))

    assign = F.filter(spans_of(text, ASSIGN, [2]), lambda s: F.length(s["g2"]) >= LEAST_VALUE)
    return F.concat(
        kind(assign, "assign"), kind(spans_of(text, ACCESS, []), "access"), kind(spans_of(text, HEX, []), "hex")
    )


def labelled_strings(docs: DataFrame, key: str = "doc_id", text: str = "text", most: int = SAMPLE_DOCS) -> DataFrame:
    """(string, secret) from about ``most`` documents chosen by a hash of their key.

    Values the base patterns find are labelled secret, words of other documents without any digit
    ordinary. ``most`` bounds what the models are fitted on, not what they are applied to.
    """
    rows = docs.count()
    part = 1_000_000 if rows <= most else max(1, most * 1_000_000 // rows)
    chosen = docs.filter(F.pmod(F.xxhash64(F.lit(5), key), F.lit(1_000_000)) < part).select(whole(F.col(text)).alias("t"))
    secrets = F.concat(
        F.filter(F.regexp_extract_all("t", F.lit(ASSIGN), 2), lambda v: F.length(v) >= LEAST_VALUE),
        F.regexp_extract_all("t", F.lit(ACCESS), 0),
        F.regexp_extract_all("t", F.lit(HEX), 0),
    )
    ordinary = F.filter(words_of(F.col("t")), lambda w: ~w.rlike(r"[0-9]"))
    return chosen.select(F.explode(secrets).alias("string"), F.lit(1).alias("secret")).unionByName(
        chosen.select(F.explode(ordinary).alias("string"), F.lit(0).alias("secret"))
    )


def _class(char: Column) -> Column:
    code = F.ascii(char)
    return F.when((code >= FIRST) & (code <= LAST), code - FIRST + 1).otherwise(0)


def train(strings: DataFrame) -> list[float]:
    """Log-likelihood ratios by pair of character classes, row by row.

    Counts come back to the driver as at most 2 * ALPHABET^2 rows. The prior of random strings is
    uniform over RANDOM_CHARS, that of identifiers over all classes.
    """
    chars = strings.select("secret", F.split(F.col("string"), "").alias("c")).filter(F.size("c") > 1)
    pairs = chars.select(
        "secret",
        F.explode(F.transform(F.sequence(F.lit(0), F.size("c") - 2), lambda i: _class(F.get("c", i)) * ALPHABET + _class(F.get("c", i + 1)))).alias("pair"),
    )
    counts = [[0.0] * (ALPHABET * ALPHABET) for _ in range(2)]
    for row in pairs.groupBy("secret", "pair").count().collect():
        counts[row["secret"]][row["pair"]] += row["count"]
    random = {ord(c) - FIRST + 1 for c in RANDOM_CHARS}
    ratios = []
    for a in range(ALPHABET):
        of = slice(a * ALPHABET, (a + 1) * ALPHABET)
        secret_total, plain_total = sum(counts[1][of]), sum(counts[0][of])
        for b in range(ALPHABET):
            prior = 1.0 if b in random else 0.01
            secret = (counts[1][a * ALPHABET + b] + prior) / (secret_total + len(random) + 0.01 * (ALPHABET - len(random)))
            plain = (counts[0][a * ALPHABET + b] + 0.5) / (plain_total + 0.5 * ALPHABET)
            ratios.append(round(math.log(secret / plain), 4))
    return ratios


def ratio(token: Column, weights: Column) -> Column:
    """The log-likelihood ratio of a token of two characters or more, in nats."""

    def over(classes: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.size(classes) - 1),
            F.lit(0.0),
            lambda acc, i: acc + F.get(weights, F.get(classes, i - 1) * ALPHABET + F.get(classes, i)),
        )

    return let(F.transform(F.split(token, ""), _class), over)


def scan(docs: DataFrame, weights: list[float] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans) for each row: array<struct(start, kind, end)> by start, then kind as in KINDS.

    ``weights`` come from ``train``; by default they are trained from strings ``docs`` itself labels.
    """
    return docs.select(key, spans(F.col(text), train(labelled_strings(docs, key, text)) if weights is None else weights).alias("spans"))


def spans(text: Column, weights: list[float]) -> Column:
    table = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<double>")

    def added(t: Column, base: Column) -> Column:
        def random(s: Column) -> Column:
            return let(ratio(s["g0"], table), lambda r: (r >= LEAST_TOTAL) & (r >= LEAST_RATIO * (F.length(s["g0"]) - 1)))

        def free(s: Column) -> Column:
            return ~F.exists(base, lambda b: (b["start"] < s["end"]) & (b["end"] > s["start"]))

        found = F.filter(F.filter(spans_of(t, CANDIDATE, []), random), free)
        return F.transform(found, lambda s: F.struct(s["start"], F.lit(KINDS.index("markov")).alias("kind"), s["end"]))

    return let(whole(text), lambda t: let(base_spans(t), lambda base: F.sort_array(F.concat(base, added(t, base)))))


def digest(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """kind:start:end of each span, comma-joined, in the order they come."""
    names = F.array(*[F.lit(k) for k in KINDS])
    chosen = F.filter(spans, lambda s: s["kind"].isin([KINDS.index(k) for k in kinds]))
    return F.array_join(
        F.transform(chosen, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")


def redact(docs: DataFrame, weights: list[float] | None = None, key: str = "doc_id", text: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span, overlapping ones as one, replaced by ``mask``; other texts unchanged."""
    weights = train(labelled_strings(docs, key, text)) if weights is None else weights

    def merge(acc: Column, s: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        own = F.struct(s["start"].alias("start"), s["end"].alias("end"))
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when((F.size(acc) > 0) & (s["start"] <= last["end"]), F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(joined))).otherwise(
            F.concat(acc, F.array(own))
        )

    def masked(t: Column, found: Column) -> Column:
        merged = F.aggregate(found, F.array().cast("array<struct<start:int,end:int>>"), merge)

        def cut(m: Column) -> Column:
            parts = F.transform(m, lambda s, i: F.concat(
                F.substring(t, F.coalesce(F.get(m, i - 1)["end"], F.lit(0)) + 1, s["start"] - F.coalesce(F.get(m, i - 1)["end"], F.lit(0))), F.lit(mask)
            ))
            end = F.try_element_at(m, F.lit(-1))["end"]
            return F.concat(F.array_join(parts, ""), F.substring(t, end + 1, F.length(t)))

        return let(merged, cut)

    body = F.col(text)
    found = let(spans(body, weights), lambda s: F.when(F.size(s) == 0, body).otherwise(masked(body, s)))
    return docs.withColumn(text, found)

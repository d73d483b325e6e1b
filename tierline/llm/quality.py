"""Quality rules: a threshold table compiled into one projection.

Every measure is a column expression over a text; a rule is a row (measure, low, high) of a table, and
the verdict is the conjunction of all rows. There are no user functions and no shuffle.

Null text counts as empty. An empty text has no words, fails the base rule and is not kept; ratios
over nothing are 0. Equal texts get equal verdicts, an empty table gives an empty one, and a text may
be as long as a row can hold: all work is at most n log n in its words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.exprs import SPACES, WORD, let, whole, words_of

# Frequent function words of the four languages of the corpus.
STOP_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "on", "with", "as", "was", "are", "this", "be", "by"],
    "fr": ["le", "la", "les", "de", "des", "du", "et", "un", "une", "est", "en", "que", "qui", "pour", "dans", "par", "sur", "pas"],
    "de": ["der", "die", "das", "und", "ist", "ein", "eine", "nicht", "den", "dem", "von", "zu", "mit", "auf", "sich", "im", "des"],
    "es": ["el", "la", "los", "las", "de", "que", "y", "en", "un", "una", "es", "por", "con", "para", "del", "se", "lo", "su"],
}
SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """``low <= measure <= high``; None leaves a side open."""

    measure: str
    low: float | None = None
    high: float | None = None


#: Kept documents meet all of these. The bounds lie well outside what ordinary prose reaches.
RULES = (
    Rule("n_words", low=50),
    Rule("repeat_word_ratio", high=0.5),
    Rule("mean_word_length", low=2.0, high=15.0),
    Rule("symbol_ratio", high=0.1),
    Rule("stop_word_ratio", low=0.02),
    Rule("dup_line_ratio", high=0.5),
)


def _repeat_words(words: Column) -> Column:
    """How many words lie in a three-word window that is found twice or more.

    Windows are sorted by a hash with their place in its low bits, so that equal windows meet in one
    sort of plain integers. Only windows whose hash repeats are then compared by their words.
    """
    n = F.size(words)

    def window(i: Column) -> list[Column]:
        return [F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)]

    def places(bits: Column) -> Column:
        codes = F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.call_function("shiftleft", F.xxhash64(*window(i)), bits).bitwiseOR(i.cast("bigint")),
        )
        low = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1

        def repeated(v: Column) -> Column:
            def as_before(i: Column) -> Column:
                return F.call_function("shiftrightunsigned", F.get(v, i).bitwiseXOR(F.get(v, i - 1)), bits) == 0

            later = F.when(n > 3, F.filter(F.sequence(F.lit(1), n - 3), as_before)).otherwise(F.array().cast("array<int>"))
            return let(later, lambda at: F.array_distinct(F.concat(
                F.transform(at, lambda i: F.get(v, i).bitwiseAND(low).cast("int")),
                F.transform(at, lambda i: F.get(v, i - 1).bitwiseAND(low).cast("int")),
            )))

        return let(F.sort_array(codes), repeated)

    def exact(at: Column) -> Column:
        keyed = F.transform(at, lambda i: F.struct(F.struct(*window(i)).alias("w"), i.alias("i")))

        def same(v: Column) -> Column:
            def as_neighbour(x: Column, i: Column) -> Column:
                before, after = F.get(v, i - 1)["w"], F.get(v, i + 1)["w"]
                return F.coalesce(x["w"] == before, F.lit(False)) | F.coalesce(x["w"] == after, F.lit(False))

            return F.sort_array(F.transform(F.filter(v, as_neighbour), lambda x: x["i"]))

        return let(F.sort_array(keyed), same)

    def covered(at: Column) -> Column:
        fresh = F.transform(at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - x, F.lit(3))))
        return F.aggregate(fresh, F.lit(0).cast("bigint"), lambda acc, x: acc + x)

    bits = F.length(F.bin(n.cast("bigint")))
    found = let(bits, places)
    counted = let(found, lambda at: F.when(F.size(at) == 0, F.lit(0).cast("bigint")).otherwise(let(exact(at), covered)))
    return F.when(n < 3, F.lit(0).cast("bigint")).otherwise(counted)


def measures(text: Column) -> Column:
    """All measures of a text as one struct; see ``RULES`` for those with a threshold."""
    every = sorted({word for words in STOP_WORDS.values() for word in words})

    def of(text: Column, words: Column) -> Column:
        lines = F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(SPACES)) != "")
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
            (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
            let(lines, lambda x: F.struct(
                F.size(x).cast("bigint").alias("all"), (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("dup")
            )).alias("lines"),
            _repeat_words(words).alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(every))).cast("bigint").alias("n_stop_words"),
        )

    def share(part: Column, of: Column) -> Column:
        return F.coalesce(part / F.nullif(of, F.lit(0)), F.lit(0.0))

    def ratios(m: Column) -> Column:
        return F.struct(
            *[m[name].alias(name) for name in ("n_words", "word_chars", "n_symbols")],
            m["lines"]["dup"].alias("n_dup_lines"),
            m["n_repeat_words"].alias("n_repeat_words"),
            share(m["word_chars"], m["n_words"]).alias("mean_word_length"),
            share(m["n_symbols"], m["n_words"]).alias("symbol_ratio"),
            share(m["n_stop_words"], m["n_words"]).alias("stop_word_ratio"),
            share(m["lines"]["dup"], m["lines"]["all"]).alias("dup_line_ratio"),
            share(m["n_repeat_words"], m["n_words"]).alias("repeat_word_ratio"),
        )

    return let(whole(text), lambda t: let(let(words_of(t), lambda w: of(t, w)), ratios))


def verdict(m: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The threshold table as one boolean over the struct of ``measures``."""
    kept = F.lit(True)
    for rule in rules:
        if rule.low is not None:
            kept = kept & (m[rule.measure] >= rule.low)
        if rule.high is not None:
            kept = kept & (m[rule.measure] <= rule.high)
    return kept


def base_failed(m: Column) -> Column:
    """Fewer than 50 words, or more than half of them in repeated windows (in integers, so exact)."""
    return (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its key, every measure, ``base_failed`` and ``kept``."""
    measured = docs.select(F.col(key), measures(F.col(text)).alias("m"))
    kept = ~base_failed(F.col("m")) & verdict(F.col("m"), rules)
    return measured.select(key, "m.*", base_failed(F.col("m")).alias("base_failed"), kept.alias("kept"))


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, unchanged."""

    def kept(m: Column) -> Column:
        return ~base_failed(m) & verdict(m, rules)

    return docs.filter(let(measures(F.col(text)), kept))


def _limits(rules: tuple[Rule, ...]) -> str:
    bounds = [(r.measure, op, b) for r in rules for op, b in ((">=", r.low), ("<=", r.high)) if b is not None]
    return " AND ".join(f"{measure} {op} CAST({bound} AS DOUBLE)" for measure, op, bound in bounds)


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """DuckDB SQL for ``judged`` over the table documents."""
    stop = ", ".join(f"'{word}'" for word in sorted({word for words in STOP_WORDS.values() for word in words}))
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '{WORD}') AS words
  FROM documents
), placed AS (
  SELECT r, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM d
), windows AS (
  SELECT r, i, w AS a, lead(w) OVER x AS b, lead(w, 2) OVER x AS c FROM placed WINDOW x AS (PARTITION BY r ORDER BY i)
), counted AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM windows WHERE c IS NOT NULL
), repeats AS (
  SELECT r, count(DISTINCT i + k) AS n FROM counted, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY r
), basics AS (
  SELECT d.r, doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '{SYMBOLS}')) AS BIGINT) AS n_symbols,
    [line for line in string_split(t, chr(10)) if regexp_matches(line, '{WORD}')] AS lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    len([w for w in words if lower(w) IN ({stop})]) AS n_stop_words
  FROM d LEFT JOIN repeats ON d.r = repeats.r
), measured AS (
  SELECT doc_id, n_words, word_chars, n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    n_repeat_words,
    coalesce(word_chars / nullif(n_words, 0), 0.0::DOUBLE) AS mean_word_length,
    coalesce(n_symbols / nullif(n_words, 0), 0.0::DOUBLE) AS symbol_ratio,
    coalesce(n_stop_words / nullif(n_words, 0), 0.0::DOUBLE) AS stop_word_ratio,
    coalesce((len(lines) - len(list_distinct(lines))) / nullif(len(lines), 0), 0.0::DOUBLE) AS dup_line_ratio,
    coalesce(n_repeat_words / nullif(n_words, 0), 0.0::DOUBLE) AS repeat_word_ratio,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM basics
)
SELECT *, NOT base_failed AND {_limits(rules)} AS kept FROM measured
"""

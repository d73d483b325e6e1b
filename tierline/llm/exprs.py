"""Column expressions that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"  # what separates words: \x20 and \x09-\x0D
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    A lambda that mentions an outer expression evaluates it again for every element once Catalyst
    merges projections; a lambda variable is computed once whatever the optimizer does.
    """
    return F.transform(F.array(value), body)[0]


def whole(text: Column) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(text, F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text that is not null, in order; an empty array where there is none."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP, -1))


def word_count(text: Column) -> Column:
    return F.size(words_of(whole(text))).cast("bigint")


def running_sums(items: Column) -> Column:
    """Running sums of an int array that is not empty, in steps of about the square root of its size.

    Appending to an array copies it, so sums are built for short blocks and then shifted.
    """

    def append(acc: Column, n: Column) -> Column:
        return F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + n))

    def sums(of: Column) -> Column:
        return F.aggregate(of, F.array().cast("array<int>"), append)

    def blocks(width: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(items) - 1, width)
        return F.transform(starts, lambda at: sums(F.slice(items, at + 1, width)))

    def shifted(inner: Column) -> Column:
        before = sums(F.transform(inner, lambda x: F.try_element_at(x, F.lit(-1))))
        return let(before, lambda totals: F.flatten(F.transform(
            inner, lambda x, i: F.transform(x, lambda e: e + F.coalesce(F.get(totals, i - 1), F.lit(0)))
        )))

    return let(F.ceil(F.sqrt(F.size(items))).cast("int"), lambda width: let(blocks(width), shifted))


def spans_of(text: Column, pattern: str, groups: list[int]) -> Column:
    """Leftmost non-overlapping matches as an array of (start, end, g<i>...), ascending.

    Offsets count code points, end exclusive. What lies between the matches comes from splitting by
    the same pattern, so each start is the sum of the lengths before it.
    """

    def placed(found: Column, between: Column) -> Column:
        lengths = F.transform(found, lambda m, i: F.length(F.get(between, i)) + F.length(m))
        return let(let(lengths, running_sums), lambda e: F.transform(found, lambda m, i: F.struct(
            (F.get(e, i) - F.length(m)).alias("start"), F.get(e, i).alias("end"), m.alias("g0"), i.alias("nth")
        )))

    regex = F.lit(pattern)
    spans = let(
        F.regexp_extract_all(text, regex, 0),
        lambda found: F.when(
            F.size(found) > 0, let(F.split(text, pattern, -1), lambda between: placed(found, between))
        ).otherwise(F.array().cast("array<struct<start:int,end:int,g0:string,nth:int>>")),
    )
    if not groups:
        return F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["g0"]))
    captured = F.array(*[F.regexp_extract_all(text, regex, g) for g in groups])
    return let(captured, lambda c: F.transform(spans, lambda s: F.struct(
        s["start"], s["end"], s["g0"], *[F.get(c[k], s["nth"]).alias(f"g{g}") for k, g in enumerate(groups)]
    )))

"""Places of a pattern's matches in a text, in native functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MARK, _OTHER = "\x01", "\x02"


def with_marks(text: Column, pattern: str, before: str = "", match: str = "$0") -> Column:
    """The text cut at its matches: every second part, from the second on, is a match.

    ``before`` and ``match`` name the groups of what stands in front of a match proper and of itself, where the pattern
    takes in more. A match can be empty then.

    Matches are fenced by a control character that none of the patterns matches; one in the text is set to its
    neighbour beforehand, which moves no place.
    """
    fenced = F.regexp_replace(F.translate(text, _MARK, _OTHER), pattern, f"{before}{_MARK}{match}{_MARK}")
    return F.split(fenced, _MARK)


def spans_of(parts: Column, around: int = 0) -> Column:
    """``start``, ``end`` (code points, end exclusive) and ``match`` of each match in the parts; with ``around``, also
    that many characters ``before`` and ``after`` it, as far as the next matches."""
    fields = "start:bigint,end:bigint,match:string" + (",before:string,after:string" if around else "")
    empty = F.array().cast(f"array<struct<{fields}>>")

    def step(state: Column, at: Column) -> Column:
        gap, match = F.get(parts, 2 * at), F.get(parts, 2 * at + 1)
        start = state["place"] + F.char_length(gap)
        end = start + F.char_length(match)
        found = [start.alias("start"), end.alias("end"), match.alias("match")]
        if around:
            after = F.get(parts, 2 * at + 2)
            found += [F.right(gap, F.lit(around)).alias("before"), F.left(after, F.lit(around)).alias("after")]
        return F.struct(end.alias("place"), F.concat(state["found"], F.array(F.struct(*found))).alias("found"))

    start = F.struct(F.lit(0).cast("bigint").alias("place"), empty.alias("found"))
    matches = F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / 2).cast("int") - 1)
    some = F.aggregate(matches, start, step, lambda state: state["found"])
    return F.when(F.size(parts) > 1, some).otherwise(empty)

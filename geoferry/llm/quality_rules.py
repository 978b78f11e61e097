"""Quality rules as a short-circuit cascade, in native functions.

A rule is a condition under which a document is rejected. Rules are asked in the order of rejections per cost, both
measured on a sample, and the first one that holds ends the row's cascade: what later rules need is not computed.
The order changes the time taken and never the verdict. The word list, which nearly all rules need, is made once for
each row, outside of the rules, and stays one value however Spark moves filters about.

Null and empty texts have no words and fail ``too_short``. Repeated rows are judged one by one; further columns stay.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoferry.llm.common import SPACES

#: Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

#: Production parameters: more of these than a share of the words (or lines, or letters) means junk.
MOST_SYMBOLS_PER_WORD = 0.2
MOST_MARKS_PER_WORD = 0.5
MOST_DUPLICATE_LINES = 0.6
MOST_CHARS_PER_WORD = 60

#: The sample that costs and selectivities are measured on, and how often it is gone over; texts beyond the length are
#: left out of it alone.
SAMPLE_ROWS, SAMPLE_LENGTH, REPEATS = 200, 20_000, 10


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda word: word != "")


def occurrences(text: Column, characters: str) -> Column:
    rest = reduce(lambda left, one: F.replace(left, F.lit(one), F.lit("")), characters, text)
    return (F.char_length(text) - F.char_length(rest)).cast("long")


def repeated_words(words: Column) -> Column:
    """How many words stand in a window of three that is found twice or more in the array.

    Windows are sorted by hash, each with its place packed into the low part of the value, so that equal windows
    become neighbours; neighbours are compared word by word. The work is that of one sort per document.
    """
    n = F.size(words).cast("long")
    window = lambda at: F.struct(*[F.get(words, at + shift) for shift in range(3)])
    hashed = F.transform(words, lambda word, at: F.xxhash64(word, F.get(words, at + 1), F.get(words, at + 2)))
    halved = F.transform(F.slice(hashed, 1, F.size(words) - 2), lambda h, at: F.shiftright(h, 1) - F.pmod(F.shiftright(h, 1), n) + at)
    ordered = F.sort_array(halved)
    place = lambda value: F.pmod(value, n).cast("int")

    def among(values: Column) -> Column:
        def same(value: Column, other: Column) -> Column:
            close = F.coalesce(value - F.pmod(value, n) == other - F.pmod(other, n), F.lit(False))
            return F.when(close, window(place(value)) == window(place(other))).otherwise(False)

        return F.filter(values, lambda value, at: same(value, F.get(values, at + 1)) | same(value, F.get(values, at - 1)))

    def covered(places: Column) -> Column:
        gaps = F.transform(places, lambda p, at: F.least(F.lit(3), F.coalesce(F.get(places, at + 1) - p, F.lit(3))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)

    found = bind(ordered, lambda values: bind(F.sort_array(F.transform(among(values), place)), covered))
    return F.when(n < 3, F.lit(0).cast("long")).otherwise(found)


def bind(value: Column, body) -> Column:
    """``body`` of a value that is computed once, though the body names it several times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def duplicate_lines(text: Column) -> tuple[Column, Column]:
    """The lines that hold a word, and how many of them equal an earlier one."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.trim(line, F.lit(SPACES)) != "")
    return F.size(lines).cast("long"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


#: Rules on a text and its words: name, and when it rejects.
Rules = Callable[[Column, Column], Mapping[str, Column]]


def default_rules(text: Column, words: Column) -> dict[str, Column]:
    """Name of each rule and when it rejects; the conditions read nothing but the text and its words."""
    n_words = F.size(words).cast("long")
    n_lines, n_repeated_lines = duplicate_lines(text)
    return {
        "too_short": n_words < LEAST_WORDS,
        "symbols": occurrences(text, SYMBOLS) > MOST_SYMBOLS_PER_WORD * n_words,
        "marks": occurrences(text, "!?") > MOST_MARKS_PER_WORD * n_words,
        "endless_words": word_chars(words) > MOST_CHARS_PER_WORD * n_words,
        "duplicate_lines": (n_lines >= 5) & (n_repeated_lines > MOST_DUPLICATE_LINES * n_lines),
        "repeated_words": 100 * repeated_words(words) > MOST_REPEATED_PERCENT * n_words,
    }


def word_chars(words: Column) -> Column:
    return F.char_length(F.array_join(words, "")).cast("long")


def measured_order(docs: DataFrame, rules: Rules = default_rules, text: str = "text") -> list[str]:
    """Names of the rules, the one with most rejections per second first.

    A rule's time is that of a job over the sample with it, less that of the same job without any; each is taken as the
    least of three runs over the sample ``REPEATS`` times, so that starting the job doesn't count.
    """
    spark = docs.sparkSession
    some = docs.select(F.col(f"`{text}`").cast("string").alias("text")).where(F.char_length("text") <= SAMPLE_LENGTH)
    sample = [row.text for row in some.sample(0.1, 7).take(SAMPLE_ROWS)] or [""]
    # Rows and not literals: Spark keeps the text of each plan, and with it all that stands in one.
    frame = spark.createDataFrame([(one,) for one in sample], "text string").coalesce(1)
    many = frame.select(F.explode(F.array_repeat("text", REPEATS)).alias("text"))
    names = list(rules(F.col("text"), F.col("text")))

    def seconds(name: str | None) -> tuple[int, float]:
        rejects = bind(words_of(F.col("text")), lambda words: F.lit(False) if name is None else rules(F.col("text"), words)[name])
        times = []
        for _ in range(3):  # the first one also compiles
            began = time.perf_counter()
            rejected = many.agg(F.count_if(rejects)).first()[0]
            times.append(time.perf_counter() - began)
        return rejected, min(times)

    _, idle = seconds(None)
    worth = {}
    for name in names:
        rejected, took = seconds(name)
        worth[name] = (rejected / REPEATS + 0.5) / len(sample) / max(took - idle, 1e-4)
    return sorted(names, key=lambda name: (-worth[name], name))


def cascade(rules: Mapping[str, Column], order: list[str]) -> Column:
    """The first rule in this order that rejects the row, or null. Later branches are not evaluated."""
    first, *rest = order
    found = F.when(rules[first], F.lit(first))
    for name in rest:
        found = found.when(rules[name], F.lit(name))
    return found


def quality_filter(docs: DataFrame, text: str = "text", rules: Rules = default_rules) -> DataFrame:
    """The documents that no rule rejects, with all their columns."""
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    order = measured_order(docs, rules, text)
    return docs.where(bind(words_of(whole), lambda words: cascade(rules(whole, words), order)).isNull())


def quality_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document the counts of the contract, whether the base rules fail, and the verdict of the cascade.

    The contract's counts are asked for in any case, so the rules on them cost nothing more; the cascade goes on to what
    is not counted yet, the marks, only for documents that all other rules let pass.
    """
    texts = docs.select(F.col(f"`{key}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    order = measured_order(texts)
    counted_first = [name for name in order if name != "marks"] + ["marks"]
    n_lines, n_dup = duplicate_lines(F.col("text"))

    def counts(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            word_chars(words).alias("word_chars"),
            occurrences(F.col("text"), SYMBOLS).alias("n_symbols"),
            n_dup.alias("n_dup_lines"),
            repeated_words(words).alias("n_repeat_words"),
            n_lines.alias("n_lines"),
        )

    def judged(c: Column) -> Column:
        n = c["n_words"]
        rules = {
            "too_short": n < LEAST_WORDS,
            "symbols": c["n_symbols"] > MOST_SYMBOLS_PER_WORD * n,
            "marks": occurrences(F.col("text"), "!?") > MOST_MARKS_PER_WORD * n,
            "endless_words": c["word_chars"] > MOST_CHARS_PER_WORD * n,
            "duplicate_lines": (c["n_lines"] >= 5) & (c["n_dup_lines"] > MOST_DUPLICATE_LINES * c["n_lines"]),
            "repeated_words": 100 * c["n_repeat_words"] > MOST_REPEATED_PERCENT * n,
        }
        base = [c[name].alias(name) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
        failed = (rules["too_short"] | rules["repeated_words"]).alias("base_failed")
        return F.struct(*base, failed, cascade(rules, counted_first).isNull().alias("kept"))

    report = bind(words_of(F.col("text")), lambda words: bind(counts(words), judged))
    return texts.select("doc_id", report.alias("__report")).select("doc_id", "__report.*")

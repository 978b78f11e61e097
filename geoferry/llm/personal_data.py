"""Personal data by weak supervision, in native functions.

Base spans come from fixed rules and always stay. Looser patterns propose further spans. Labelers vote on every
candidate, for (1), against (-1) or not at all (0): the format, a check of the value, a gazetteer, the words before it,
and the characters next to it. Expectation-maximisation estimates how far each labeler is to be trusted from how often
each pattern of votes occurs; what share of the looser candidates is personal data is estimated for itself. The
posteriors then train a logistic classifier of spans, which sees no votes but the span and its neighbours: its length, its
kinds of characters, groups and separators, the words before it and the characters at its ends. So it goes on where
labelers are silent. A further span stays if the classifier says so and it meets no base span. Only the counts of vote
patterns, at most 8 * 3^5 rows, and the classifier's weights reach the driver; it is trained on at most ``SAMPLE``
candidates of each sort, drawn by a hash.

Null texts are empty. Rows are judged one by one, so repeated rows and further columns don't matter.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoferry.llm.common import Scratch, ascii_lower, staged, texts_of
from geoferry.llm.spans import spans_of, with_marks

KINDS = ("email", "ip", "card", "phone")
#: Fixed values of the contract, written so that no text takes more than linear time: a run of a class is never
#: entered in its middle, and never given back.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Further candidates: spelled-out mail addresses, long addresses of the newer protocol, and phone numbers without a plus.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(][aA][tT][\])] ?[A-Za-z0-9-]++(?: ?[\[(][dD][oO][tT][\])] ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9-]|[.][0-9])",
}
SPANS = "array<struct<start:bigint,kind:int,end:bigint,base:boolean,votes:int,features:array<double>>>"
#: Candidates of a kind and sort that the classifier is trained on at most.
SAMPLE = 5_000
LABELERS = ("format", "check", "gazetteer", "context", "edges")
#: How votes against, none and for are believed to fall on personal data and on the rest, as counts of candidates. The
#: words around a span speak both ways, and without a belief in them nothing would tell two equal groups of candidates
#: apart: theirs weighs as much as a fiftieth of all candidates. The others name conditions that most candidates meet.
_CONDITION = ((0.5, 4.0, 4.5), (1.0, 4.0, 4.0))
BELIEFS = {"format": _CONDITION, "check": _CONDITION, "gazetteer": _CONDITION, "context": ((0.3, 4.7, 4.0), (6.0, 3.0, 0.3)), "edges": _CONDITION}

#: Gazetteers: domains and numbers that are in use, and those that stand in for others; words around personal data.
KNOWN = {
    "email": r"\.(?:com|org|net|edu|gov|io|co|de|fr|es|uk|eu|info)$",
    "ip": r"^(?:10|172|192|[1-9][0-9]?|1[0-9]{2}|2[01][0-9]|22[0-3])\.",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6)",
    "phone": r"^\+?\(?(?:1|7|20|3[0-9]|4[0-9]|5[0-9]|6[0-9]|8[0-9]|9[0-9]|[2-9][0-9]{2})",
}
STAND_IN = {"email": r"^(?:noreply|example|test)@", "ip": r"^(?:0|127|255)\.", "card": r"^([0-9])\1+$|^0", "phone": r"(?:0000000|1234567)"}
FOR = {"email": r"mail|contact|schreib|courriel|correo", "ip": r"\bip\b|host|server|address|adresse", "card": r"card|visa|credit|karte|carte|tarjeta", "phone": r"tel|phone|call|fax|mobil|anruf"}
AGAINST = r"version|isbn|issn|order|invoice|serial|page|section|figure|table|\bid\b|\bno\.?\s*$"


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def written_out(kind: str, match: Column) -> Column:
    """The value that a match stands for: digits, or an address with its signs in place of words."""
    if kind == "email":
        return F.regexp_replace(F.regexp_replace(match, r" ?[\[(][aA][tT][\])] ?", "@"), r" ?[\[(][dD][oO][tT][\])] ?", ".")
    return match if kind == "ip" else digits(match)


def valid(kind: str, match: Column) -> Column:
    """The check of a base match; those that fail are dropped."""
    if kind == "ip":
        return match.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.|$)){4}$")
    if kind == "card":
        n = F.char_length(digits(match))
        return F.when(n.between(12, 19), F.call_function("luhn_check", digits(match))).otherwise(False)
    if kind == "phone":
        return F.char_length(digits(match)).between(9, 15)
    return F.lit(True)


def votes(kind: str, base: bool, span: Column) -> list[Column]:
    """What each labeler says of a candidate."""
    match, before = span["match"], ascii_lower(span["before"])
    value = written_out(kind, match)
    vote = lambda yes, no: F.when(no, -1).when(yes, 1).otherwise(0)
    sound = valid(kind, match) if base or kind == "phone" else F.lit(True)
    edge = r"[A-Za-z0-9@_]"
    return [
        F.lit(1 if base else 0),
        F.when(sound, F.lit(1 if base else 0)).otherwise(-1),
        vote(value.rlike(KNOWN[kind]), value.rlike(STAND_IN[kind])),
        vote(before.rlike(FOR[kind]), before.rlike(AGAINST)),
        F.when(span["before"].rlike(edge + "$") | span["after"].rlike("^" + edge), -1).otherwise(1),
    ]


FEATURES = ["length", "digits", "capitals", "separators", "groups", "brackets", "distinct", "for", "against", "word_before", "label_before", "letter_after", "digit_beside", "known", "stand_in"]


def features(kind: str, span: Column) -> list[Column]:
    """What the classifier sees of a candidate: numbers between 0 and 1."""
    match, before, after = span["match"], ascii_lower(span["before"]), span["after"]
    size = F.char_length(match)
    share = lambda pattern: 1 - F.char_length(F.regexp_replace(match, pattern, "")) / size
    flag = lambda condition: F.when(condition, 1.0).otherwise(0.0)
    value = written_out(kind, match)
    return [
        F.least(F.lit(1.0), size / 40),
        share("[0-9]"),
        share("[A-Z]"),
        share(r"[^A-Za-z0-9]"),
        F.least(F.lit(1.0), F.size(F.split(match, r"[^A-Za-z0-9]+")) / 8),
        flag(match.rlike(r"[\[(]")),
        F.size(F.array_distinct(F.split(match, ""))) / size,
        flag(before.rlike(FOR[kind])),
        flag(before.rlike(AGAINST)),
        flag(before.rlike(r"[a-z]+\s*$")),
        flag(before.rlike(r"[:=]\s*$")),
        flag(after.rlike(r"^\s*[A-Za-z]")),
        flag(before.rlike("[0-9]$") | after.rlike("^[0-9]")),
        flag(value.rlike(KNOWN[kind])),
        flag(value.rlike(STAND_IN[kind])),
    ]


def candidates(text: Column, kind: str, base: bool) -> Column:
    """Spans of one kind with their features and their votes, the latter an integer of five base-3 digits."""
    found = spans_of(with_marks(text, (BASE if base else LOOSE)[kind]), around=24)
    if base:
        found = F.filter(found, lambda span: valid(kind, span["match"]))

    def voted(span: Column) -> Column:
        pattern = F.lit(0)
        for vote in votes(kind, base, span):
            pattern = pattern * 3 + vote + 1
        return F.struct(
            span["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), span["end"].alias("end"),
            F.lit(base).alias("base"), pattern.cast("int").alias("votes"), F.array(*[value.cast("double") for value in features(kind, span)]).alias("features"),
        )

    return F.transform(found, voted)


Pattern = tuple[int, bool, int]


def reliabilities(counts: Mapping[Pattern, int], rounds: int = 50) -> dict[Pattern, float]:
    """The posterior that a candidate is personal data, for each (kind, base, votes); expectation-maximisation.

    Labelers are independent given the truth; each has chances of its own for its three votes, next to what is believed
    beforehand (``BELIEFS``). The share of personal data is one of base candidates and another of the rest.
    """
    keys = sorted(counts)
    weight = np.array([counts[key] for key in keys], float)
    said = np.array([[votes // 3**place % 3 for place in range(len(LABELERS) - 1, -1, -1)] for _, _, votes in keys])
    base = np.array([key[1] for key in keys])
    # It starts from what most labelers say, and from who has fewer votes than others of the sort.
    total = (said - 1).sum(axis=1).astype(float)
    usual = np.zeros(len(keys))
    for sort in (True, False):
        usual[base == sort] = np.average(total[base == sort], weights=weight[base == sort]) if (base == sort).any() else 0
    posterior = 1 / (1 + np.exp(-(total + 2 * (total - usual))))
    for _ in range(rounds):
        log_odds = np.zeros(len(keys))
        for sort in (True, False):
            some = base == sort
            if some.any():
                share = ((posterior * weight)[some].sum() + 1) / (weight[some].sum() + 2)
                log_odds[some] = np.log(share / (1 - share))
        for labeler in range(len(LABELERS)):
            for truth, chance in ((1, posterior), (-1, 1 - posterior)):
                belief = np.array(BELIEFS[LABELERS[labeler]][truth < 0]) * (1 + weight.sum() / 50 if LABELERS[labeler] == "context" else 1)
                seen = np.bincount(said[:, labeler], weight * chance, 3) + belief
                log_odds += truth * np.log(seen / seen.sum())[said[:, labeler]]
        posterior = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
    return dict(zip(keys, posterior.tolist()))


def _inputs(span: Column) -> list[Column]:
    kinds = [F.when(span["kind"] == at, 1.0).otherwise(0.0) for at in range(len(KINDS))]
    return [*kinds, *[F.get(span["features"], F.lit(at)) for at in range(len(FEATURES))]]


def span_classifier(spans: DataFrame, posterior: Mapping[Pattern, float]) -> list[float]:
    """Weights of a logistic model of spans, the last one without a feature; each candidate counts for both classes, as far
    as its posterior goes."""
    sort = F.struct(F.col("span.kind").alias("kind"), F.col("span.base").alias("base"), F.col("span.votes").alias("votes"))
    chances = spans.sparkSession.createDataFrame([(*key, chance) for key, chance in posterior.items()], "kind int, base boolean, votes int, chance double")
    sizes = spans.groupBy("span.kind", "span.base").count()
    judged = spans.withColumn("sort", sort).select("span", "sort.*").join(chances, ["kind", "base", "votes"]).join(sizes, ["kind", "base"])
    draw = F.pmod(F.xxhash64("span.start", "span.end", "span.features"), F.lit(1_000_000)) / 1_000_000
    some = judged.where(draw < SAMPLE / F.col("count"))
    classes = F.explode(F.array(F.struct(F.lit(1.0).alias("label"), F.col("chance").alias("weight")), F.struct(F.lit(0.0).alias("label"), (1 - F.col("chance")).alias("weight"))))
    rows = some.select(array_to_vector(F.array(*_inputs(F.col("span")))).alias("features"), classes.alias("class"))
    rows = rows.select("features", F.col("class.label").alias("label"), F.greatest(F.col("class.weight"), F.lit(1e-3)).alias("weight"))
    model = LogisticRegression(weightCol="weight", regParam=1e-3, standardization=False, maxIter=100).fit(rows)
    return [*model.coefficients.toArray().tolist(), float(model.intercept)]


def score_of(span: Column, weights: list[float]) -> Column:
    total = F.lit(weights[-1])
    for weight, value in zip(weights, _inputs(span)):
        total = total + value * weight
    return 1 / (1 + F.exp(-total))


def personal_data(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per row: doc_id and ``found``, all spans (start, kind, end, base, votes) that stay, in order."""
    texts = texts_of(docs)
    # A row without the character that a pattern needs is not scanned for it.
    has = {"email": F.contains("text", F.lit("@")), "phone": F.contains("text", F.lit("+"))}
    number = F.col("text").rlike("[0-9]")
    none = F.array().cast(SPANS)
    columns = {f"base_{kind}": F.when(has.get(kind, number), candidates(F.col("text"), kind, True)).otherwise(none) for kind in KINDS}
    hints = {"email": F.col("text").rlike(r"[\[(][aA][tT][\])]"), "ip": F.col("text").rlike(r"(?::[0-9A-Fa-f]{1,4}){7}"), "phone": number}
    columns |= {f"loose_{kind}": F.when(hints[kind], candidates(F.col("text"), kind, False)).otherwise(none) for kind in LOOSE}
    scratch = Scratch()
    rows = scratch.stage(texts.select("doc_id", *[column.cast(SPANS).alias(name) for name, column in columns.items()]), "candidates")
    every = rows.select("doc_id", F.concat(*[F.col(f"base_{kind}") for kind in KINDS]).alias("base"), F.concat(*[F.col(f"loose_{kind}") for kind in LOOSE]).alias("loose"))
    apart = F.filter("loose", lambda span: ~F.exists("base", lambda other: (other["start"] < span["end"]) & (span["start"] < other["end"])))
    every = every.select("doc_id", "base", apart.alias("loose"))
    spans = scratch.stage(every.select(F.explode(F.concat("base", "loose")).alias("span")), "spans")
    patterns = spans.groupBy("span.kind", "span.base", "span.votes").count().collect()
    counts = {(row["kind"], row["base"], row["votes"]): row["count"] for row in patterns}
    # Without a loose candidate there is nothing to judge.
    weights = span_classifier(spans, reliabilities(counts)) if any(not base for _, base, _ in counts) else None
    added = F.slice("loose", 1, 0) if weights is None else F.filter("loose", lambda span: score_of(span, weights) >= threshold)
    plain = lambda spans: F.array_sort(F.transform(spans, lambda span: span.dropFields("features")))
    result = staged(every.select("doc_id", plain(F.col("base")).alias("base"), plain(F.concat(F.col("base"), added)).alias("found")), "personal-data")
    scratch.drop(docs.sparkSession)
    return result


def _of_kind(kind: int):
    return lambda span: span["kind"] == kind


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(F.transform(spans, lambda span: F.concat_ws(":", F.get(names, span["kind"]), span["start"], span["end"])), ",")


def personal_data_report(docs: DataFrame) -> DataFrame:
    found = personal_data(docs)
    counts = [F.size(F.filter("base", _of_kind(at))).cast("long").alias(f"n_{kind}") for at, kind in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("found")).alias("spans"))

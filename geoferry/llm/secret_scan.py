"""Secrets in texts, in native functions: a random forest takes the false positives out of a wide scan.

Candidates are values assigned to a telling name and passwords in URLs, of any length and alphabet, behind names, white
space and user names of any length, and runs of 16 and more letters, digits and ``+/_=-`` that hold a digit. Each is
described by how it was found, its length, how often its characters change between kinds, the share of it that common
words cover, its digits and distinct characters, where the text came from (``path``) and the words beside it. The forest
is trained from labelled findings (candidates with ``label`` 1 for a secret and 0 for a false positive); a bounded sample
of them is enough. It judges every candidate but those in the format of a well-known issuer, which are secrets.

``rule_findings`` gives labels where nobody has written any: formats of issuers, and values assigned to
a telling name, are secrets; numbers, dates, repeated characters and stand-ins are not. The forest sees none of these
formats, only the features.

Null and empty texts have no candidates. Rows are scanned one by one, so a repeated row repeats its findings.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoferry.llm.common import Scratch, ascii_lower, staged
from geoferry.llm.quality_rules import bind
from geoferry.llm.spans import spans_of, with_marks

#: A run is entered at its beginning and never given back, so the scan is linear.
RUN = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{16,}+"
AROUND = 32
#: Formats of issuers, names that secrets are assigned to, and stand-ins.
ISSUED = r"^(?:AKIA[0-9A-Z]{16}$|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-|sk_live_|AIza|eyJ[A-Za-z0-9_-]{10})"
NAMES = r"(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|auth|bearer|credential)"
#: Only texts that hold one of these are searched for names and URLs.
HINTS = ["token", "secret", "passw", "pwd", "key", "auth", "bearer", "credential", "://"]
#: A word with a telling name in it and a sign of assignment, matched forwards: the word is entered at its beginning and
#: left at its end, once. Then the value: in quotes, or up to white space.
_ASSIGNED = rf"(?<![A-Za-z0-9_-])(?>[A-Za-z0-9_-]*?(?i:{NAMES})[A-Za-z0-9_-]*+)[\"']?\s*+(?:=>|=|:)\s*+"
VALUE = (
    rf"({_ASSIGNED}\")([^\"\r\n]++)(?=\")|({_ASSIGNED}')([^'\r\n]++)(?=')"
    rf"|({_ASSIGNED}[\"']?)(?![=:>])([^\s\"'&]*[^\s\"'&,;.)\]}}])"
)
IN_URL = r"(://[^\s/:@]*+:)([^\s/@\"']++)(?=@)"
#: What prose has after a telling name and a colon: words. No rule knows them.
WORDS = r"^[A-Za-z]+(?:[ ,.;:]+[A-Za-z]+)+[.!?]?$"
TELLING = r"token|secret|passw|pwd|key|auth|bearer|credential|private"
STAND_IN = r"^[0-9=-]+$|^(.)\1+$|example|sample|dummy|placeholder|changeme|your[_-]|x{6,}|1234567890|^[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}$"
#: Common beginnings and endings of words in the languages at hand, and words of code; what they cover is prose.
PROSE = r"the|and|ing|tion|ment|able|that|with|from|this|here|for|are|not|you|der|die|und|ein|sch|ung|heit|keit|lich|les|des|que|eux|elle|pour|ci[oó]n|ado|mente|http|www|com|html|page|index|user|name|file|data|test"
PARTS_OF_PATH = r"test|example|sample|doc|mock|fixture"
FEATURES = ["named", "in_url", "length", "transitions", "covered", "digits", "distinct", "hex", "mixed_case", "telling", "assigned", "quoted", "prose_beside", "doubtful_path"]
SAMPLE, TREES, DEPTH = 20_000, 20, 6


def _left(text: Column, pattern: str) -> Column:
    """Share of the characters that a pattern matches."""
    return 1 - F.char_length(F.regexp_replace(text, pattern, "")) / F.char_length(text)


def _found(text: Column) -> Column:
    """The spans of all candidates of a text, each with its kind: named, url or run. A run that holds one of the others, or
    lies in one, is none."""

    def of(spans: Column, kind: str) -> Column:
        return F.transform(spans, lambda span: span.withField("kind", F.lit(kind)))

    lowered = ascii_lower(text)
    hinted = reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(hint)) for hint in HINTS])
    runs = of(spans_of(with_marks(text, RUN), AROUND), "run")
    named = of(spans_of(with_marks(text, VALUE, "$1$3$5", "$2$4$6"), AROUND), "named")
    urls = of(spans_of(with_marks(text, IN_URL, "$1", "$2"), AROUND), "url")

    def apart(spans: Column, others: Column) -> Column:
        meets = lambda span: F.exists(others, lambda other: (other["start"] < span["end"]) & (span["start"] < other["end"]))
        return F.filter(spans, lambda span: ~meets(span))

    sure = bind(urls, lambda url: F.concat(url, apart(named, url)))
    return F.when(hinted, bind(sure, lambda known: F.concat(known, apart(runs, known)))).otherwise(runs)


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """A row for each candidate: doc_id, start, end, match, before, after, kind and the features."""
    source = F.coalesce(F.col(f"`{path}`").cast("string"), F.lit("")) if path else F.lit("")
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    found = docs.select(F.col(f"`{key}`").alias("doc_id"), source.alias("path"), F.explode(_found(whole)).alias("span"))
    match, before, after = F.col("match"), ascii_lower(F.col("before")), F.col("after")
    shapes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(match, "[a-z]+", "a"), "[A-Z]+", "b"), "[0-9]+", "0"), r"[+/_=-]+", "-")
    # A kind may be written down several times in a row only once, so the length of the shape counts the changes.
    return found.select("doc_id", "path", "span.*").select(
        "doc_id", "start", "end", "match", "before", "after", "kind",
        (F.col("kind") == "named").cast("double").alias("named"),
        (F.col("kind") == "url").cast("double").alias("in_url"),
        F.char_length(match).cast("double").alias("length"),
        (F.char_length(shapes) / F.char_length(match)).alias("transitions"),
        _left(ascii_lower(match), PROSE).alias("covered"),
        _left(match, "[0-9]").alias("digits"),
        (F.size(F.array_distinct(F.split(match, ""))) / F.char_length(match)).alias("distinct"),
        match.rlike("^[0-9a-fA-F]+$").cast("double").alias("hex"),
        (match.rlike("[a-z]") & match.rlike("[A-Z]")).cast("double").alias("mixed_case"),
        before.rlike(TELLING).cast("double").alias("telling"),
        before.rlike(r"(?:=|:)\s*[\"']?$").cast("double").alias("assigned"),
        (before.rlike("[\"']$") & after.rlike("^[\"']")).cast("double").alias("quoted"),
        (before.rlike(r"[a-z]{2,} $") & after.rlike(r"^ [A-Za-z]{2,}")).cast("double").alias("prose_beside"),
        ascii_lower(F.col("path")).rlike(PARTS_OF_PATH).cast("double").alias("doubtful_path"),
    )


def rule_label() -> Column:
    """1 for what a rule takes for a secret, 0 for what it takes for none, null for the rest."""
    match, before, kind = F.col("match"), ascii_lower(F.col("before")), F.col("kind")
    doubtful = ascii_lower(match).rlike(STAND_IN)
    prose = match.rlike(WORDS) | match.rlike("^[A-Za-z]+$") & before.rlike(r":\s+$")
    assigned = (kind == "url") | (kind == "named") & ~prose
    return F.when(doubtful, 0).when(match.rlike(ISSUED) | assigned, 1).when(F.col("covered") > 0.6, 0)


def rule_findings(found: DataFrame) -> DataFrame:
    """The candidates that a rule knows, with their label."""
    return found.withColumn("label", rule_label()).where(F.col("label").isNotNull())


def train(findings: DataFrame) -> RandomForestClassificationModel | None:
    """A forest from labelled findings, or none where one of the classes is missing.

    Of more than ``SAMPLE`` findings of a class a sample is taken, by a hash of the finding, the same each time.
    """
    scratch = Scratch()
    try:
        return _fitted(scratch.stage(findings.select("label", F.xxhash64("doc_id", "start", "match").alias("draw"), *FEATURES), "findings"))
    finally:
        scratch.drop(findings.sparkSession)


def _fitted(findings: DataFrame) -> RandomForestClassificationModel | None:
    sizes = {row["label"]: row["count"] for row in findings.groupBy("label").count().collect()}
    if set(sizes) != {0, 1}:
        return None
    share = F.when(F.col("label") == 1, min(1.0, SAMPLE / sizes[1])).otherwise(min(1.0, SAMPLE / sizes[0]))
    some = findings.where(F.pmod("draw", F.lit(1_000_000)) < share * 1_000_000)
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(some).select("features", F.col("label").cast("double"))
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=4, cacheNodeIds=False).fit(vectors)


def secrets(docs: DataFrame, findings: DataFrame | None = None, path: str | None = None, threshold: float = 0.5) -> DataFrame:
    """Every candidate with its score and verdict: doc_id, start, end, match_sha256, score, secret.

    The forest, trained from ``findings`` (or from what the rules say), judges all candidates; those in an issuer's format
    are secrets. The value itself is given as a digest only. Without a forest, for lack of one of the labels, the rules
    decide those they know. The result is a written table.
    """
    scratch = Scratch()
    found = scratch.stage(candidates(docs, path=path), "secret-candidates")
    model = train(rule_findings(found) if findings is None else findings)
    if model is None:
        scored = rule_findings(found).withColumn("score", F.col("label").cast("double"))
    else:
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)
        sure = F.when(F.col("match").rlike(ISSUED), 1.0)
        scored = model.transform(vectors).withColumn("score", F.coalesce(sure, vector_to_array("probability")[1]))
    result = scored.select("doc_id", "start", "end", F.sha2("match", 256).alias("match_sha256"), "score", (F.col("score") >= threshold).alias("secret"))
    result = staged(result, "secrets")
    scratch.drop(docs.sparkSession)
    return result

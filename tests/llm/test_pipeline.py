"""The pipeline's stages against plain Python, and on edge rows."""

import re
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from geoferry.llm import pieces, quality_rules
from geoferry.llm.common import staged

SPACES = " \t\n\x0b\x0c\r"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_quality(docs):
    def good(text):
        words = WORD.findall(text)
        n = len(words)
        windows = [tuple(words[at : at + 3]) for at in range(n - 2)]
        times = Counter(windows)
        repeated = {at + k for at, window in enumerate(windows) if times[window] > 1 for k in range(3)}
        lines = [line for line in text.split("\n") if line.strip(SPACES)]
        count = lambda characters: sum(text.count(c) for c in characters)
        return not (
            n < 50 or 100 * len(repeated) > 50 * n
            or count(quality_rules.SYMBOLS) > quality_rules.MOST_SYMBOLS_PER_WORD * n or count("!?") > quality_rules.MOST_MARKS_PER_WORD * n
            or sum(map(len, words)) > quality_rules.MOST_CHARS_PER_WORD * n
            or len(lines) >= 5 and len(lines) - len(set(lines)) > quality_rules.MOST_DUPLICATE_LINES * len(lines)
        )

    return {key: text for key, text in docs.items() if good(text or "")}


def plain_lines(docs):
    key_of = lambda line: line.strip(SPACES).translate(LOW)
    holders = defaultdict(set)
    for doc, text in docs.items():
        for line in text.split("\n"):
            if len(key_of(line)) >= 40:
                holders[key_of(line)].add(doc)
    goes = {key: max(found) for key, found in holders.items() if len(found) >= 5}
    return {doc: "\n".join(line for line in text.split("\n") if goes.get(key_of(line), doc) == doc) for doc, text in docs.items()}


def plain_near(docs):
    sets = {}
    for doc, text in docs.items():
        words = WORD.findall(text.translate(LOW))
        sets[doc] = {tuple(words[at : at + 5]) for at in range(max(1, len(words) - 4))} if words else set()
    holders = defaultdict(list)
    parent = {doc: doc for doc in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for doc in sorted(docs):
        for other, common in Counter(other for shingle in sets[doc] for other in holders[shingle]).items():
            if 100 * common >= 75 * (len(sets[doc]) + len(sets[other]) - common):
                a, b = find(doc), find(other)
                parent[max(a, b)] = min(a, b)
        for shingle in sets[doc]:
            holders[shingle].append(doc)
    return {doc: text for doc, text in docs.items() if find(doc) == doc}


def plain_benchmark(docs, items):
    windows = set()
    for text in items:
        words = ITEM_WORD.findall((text or "").translate(LOW))
        windows |= {tuple(words[at : at + 10]) for at in range(max(1, len(words) - 9))} if words else set()
    sizes = {len(window) for window in windows}

    def clean(text):
        words = ITEM_WORD.findall(text.translate(LOW))
        return not any(tuple(words[at : at + n]) in windows for n in sizes for at in range(len(words) - n + 1))

    return {doc: text for doc, text in docs.items() if clean(text)}


def test_stages_equal_plain_python(spark):
    import sentencepiece

    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = [row.text for row in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    plain = [plain_quality, plain_lines, plain_near, lambda docs: plain_benchmark(docs, items)]
    docs, expected = documents, {row.doc_id: row.text for row in documents.collect()}
    for (name, stage), same in zip(corpus_pipeline.STAGES, plain):
        before = len(expected)
        docs, expected = staged(stage(spark, docs, SF_DIR), "test-stage"), same(expected)
        assert docs.columns == documents.columns
        assert {row.doc_id: row.text for row in docs.collect()} == expected, name
        assert name == "lines" or 0 < len(expected) < before
        assert docs.where(F.col("n_chars") != F.char_length("text")).isEmpty()
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    library = sentencepiece.SentencePieceProcessor(model_proto=pieces.model_bytes())
    assert {row.doc_id: list(row.ids) for row in rows} == {doc: library.encode(text) for doc, text in expected.items()}


LONG = " ".join(f"word{n} then{n}" for n in range(80))
EDGES = [(1, None), (2, ""), (3, " \n "), (4, LONG), (4, LONG), (5, LONG + " end"), (None, LONG), (None, "other " + LONG[::-1]), (6, "x" * 100_000), (7, "a b c\n" * 500)]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_edge_rows_and_empty_tables(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = spark.createDataFrame(EDGES, "doc_id long, text string").withColumns(
        {"n_chars": F.coalesce(F.char_length("text"), F.lit(0)).cast("long"), "words": F.lit("clash"), "component_id": F.lit(1), "__n_hit": F.lit(2), "holder": F.lit(3)}
    )
    rows = stage(spark, docs, SF_DIR).collect()
    assert stage(spark, docs.limit(0), SF_DIR).count() == 0
    kept = Counter(row.doc_id for row in rows)
    expected = {
        "quality": {4: 2, 5: 1, None: 2},
        "lines": {1: 1, 2: 1, 3: 1, 4: 2, 5: 1, 6: 1, 7: 1, None: 2},
        "near": {1: 1, 2: 1, 3: 1, 4: 1, 6: 1, 7: 1, None: 1},
        "benchmark": {1: 1, 2: 1, 3: 1, 4: 2, 5: 1, 6: 1, 7: 1, None: 2},
        "encode": {1: 1, 2: 1, 3: 1, 4: 2, 5: 1, 6: 1, 7: 1, None: 2},
    }
    assert dict(kept) == expected[name]
    if name != "encode":
        assert set(rows[0].asDict()) == set(docs.columns)

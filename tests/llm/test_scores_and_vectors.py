"""Language-model scores, whitening and clusters against plain versions, and on edge rows."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from geoferry.llm import clusters, context_trees, whitening
from geoferry.llm.queries import QUERIES

SPACES = " \t\n\x0b\x0c\r"
EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "One  two\nTWO "), (4, "One  two\nTWO "), (5, "É ß 漢字\x00 two"), (None, "one two"), (None, None), (6, "x" * 300_000), (7, "ab " * 200_000)]


# Language-model scores


def words_of(text):
    for space in SPACES:
        text = text.replace(space, " ")
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return [word for word in lowered.split(" ") if word]


class PlainTrees:
    """Block probabilities of binary context trees by their definition, one dictionary of counts."""

    def __init__(self, depth):
        self.depth = depth
        self.counts = defaultdict(lambda: [0, 0])
        self.children = defaultdict(set)

    def decisions(self, words):
        text = " ".join(words).encode() + b"\n"
        past = b"\n" * self.depth + text
        for at, byte in enumerate(text):
            before = past[at : at + self.depth][::-1]
            node = 1
            for bit in range(7, -1, -1):
                one = byte >> bit & 1
                yield before, node, one
                node = 2 * node + one

    def learn(self, words):
        for before, node, one in self.decisions(words):
            for depth in range(self.depth + 1):
                self.counts[before[:depth], node][one] += 1
                if depth:
                    self.children[before[: depth - 1], node].add(before[:depth])

    def estimate(self, context, node, more=None):
        zeros, ones = self.counts.get((context, node), (0, 0))
        zeros, ones = zeros + (more == 0), ones + (more == 1)
        return math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(zeros + ones + 1)

    def block(self, context, node, path=None, more=None, known={}):  # noqa: B006
        """Logarithm of the weighted probability, with one more decision along a path of contexts."""
        on_path = path is not None and path.startswith(context)
        if not on_path and (context, node) in known:
            return known[context, node]
        estimate = self.estimate(context, node, more if on_path else None)
        if len(context) == self.depth:
            total = estimate
        else:
            children = set(self.children.get((context, node), ()))
            if on_path:
                children.add(path[: len(context) + 1])
            product = sum(self.block(child, node, path, more, known) for child in children)
            total = np.logaddexp(estimate, product) - math.log(2)
        if not on_path:
            known[context, node] = total
        return total

    def score(self, words, known):
        return sum(self.block(b"", node, before, one, known) - self.block(b"", node, known=known) for before, node, one in self.decisions(words)) / math.log(10)


def plain_scores(rows, depth):
    trees, counts = PlainTrees(depth), Counter()
    for key, text in rows:
        if key is None or zlib.crc32(str(key).encode()) % 5 != 1:
            trees.learn(words_of(text or ""))
            counts.update([*words_of(text or ""), None])
    n, v, known, out = sum(counts.values()), len(counts), {}, []
    for key, text in rows:
        words = words_of(text or "")
        base = sum(math.log10((counts[word] + 0.5) / (n + 0.5 * (v + 1))) for word in [*words, None])
        held = key is not None and zlib.crc32(str(key).encode()) % 5 == 1
        out.append((key, held, len(words) + 1, sum(counts[word] > 0 for word in [*words, None]), n, base, trees.score(words, known)))
    return out


def in_order(rows):
    return sorted(rows, key=lambda row: (row[0] is None, row[0] or 0, row[2], row[6]))


def same(found, expected):
    assert len(found) == len(expected)
    for a, b in zip(in_order(found), in_order(expected)):
        assert tuple(a[:5]) == tuple(b[:5])
        assert a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-9)
        assert a[6] == pytest.approx(b[6], rel=1e-7, abs=1e-6)


TEXTS = [
    "The cat sat on the mat.  The CAT ran", "a cat\nsat", "on the\tmat the cat sat", None, "", "É ß 漢字 the\x00cat", "zzz the cat",
    "the mat sat on the cat and the cat ran to the mat " * 3, "ran ran ran", " the  end ", "the", "mat",
]


@pytest.mark.parametrize("bucket_bytes, fan", [(1 << 20, 512), (60, 2)])
def test_scores_equal_block_probabilities(spark, monkeypatch, bucket_bytes, fan):
    monkeypatch.setattr(context_trees, "FAN", fan)
    rows = [(key if key % 11 else None, text) for key, text in enumerate(TEXTS * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = context_trees.language_scores(docs, bucket_bytes=bucket_bytes).collect()
    same([tuple(row) for row in found], plain_scores(rows, context_trees.DEPTH))


def test_scores_of_edge_rows(spark):
    docs = spark.createDataFrame(EDGES, "doc_id long, text string").withColumns({"score": F.lit("clash"), "held": F.lit(1), "holder": F.lit(2)})
    found = context_trees.language_scores(docs).collect()
    assert len(found) == len(EDGES) and all(row.score < 0 and math.isfinite(row.score) for row in found)
    ends = [row for row in found if row.n_tokens == 1]
    assert {row.doc_id for row in ends} == {1, 2, 3, None, 6} - {6} and len({row.score for row in ends}) == 1
    assert context_trees.language_scores(docs.limit(0)).count() == 0


def test_scores_without_training_texts(spark):
    key = next(n for n in range(100) if zlib.crc32(str(n).encode()) % 5 == 1)
    [row] = context_trees.language_scores(spark.createDataFrame([(str(key), "ab")], "doc_id string, text string")).collect()
    assert (row.doc_id, row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (str(key), 2, 0, 0, 0.0)
    assert row.score == pytest.approx(-24 * math.log10(2))


def test_held_out_texts_are_shorter_than_by_the_base(spark):
    rows = QUERIES["op11_context_trees"](spark, SF_DIR.replace("0.01", "0.1")).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert rows[0] > rows[1]


# Vectors

VECTORS = [
    (1, None), (2, []), (3, [1.0, None, 2.0]), (4, [1.0, float("nan"), 2.0]), (5, [1.0, float("inf"), 2.0]), (6, [1.0, 2.0]),
    (7, [0.5, 1.0, -1.0]), (8, [0.25, 0.0, 4.0]), (8, [0.25, 0.0, 4.0]), (None, [0.125, 3.0, 0.0]), (9, [2.0, -1.5, 0.7]), (10, [2.0, 0.3, 0.1]),
]


def plain_whitening(rows, wanted=16):
    kept = [(key, np.array([math.floor(64 * c) + 1_000_000 for c in v], object)) for key, v in rows]
    fit = list({tuple(x): x for _, x in kept}.values())
    n, sums = len(fit), sum(fit)
    z = np.array([[float(value) for value in (n * x - sums)] for x in fit]) / n
    values, vectors = np.linalg.eigh(z.T @ z / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for key, x in kept:
        far = n * x - sums
        for at in range(min(wanted, len(values))):
            if values[at] > values[0] * 1e-13:
                out.append((key, at + 1, n, int((far**2).sum()), float((far / n).astype(float) @ vectors[:, at]) / math.sqrt(values[at]), values[at] / values.sum()))
    return out


def check_whitening(found, expected):
    assert len(found) == len(expected) > 0
    order = lambda row: (row[0] is None, row[0] or 0, row[1])
    signs = {}
    for a, b in zip(sorted(found, key=order), sorted(expected, key=order)):
        assert tuple(a[:4]) == tuple(b[:4])
        if abs(b[4]) > 1e-6:
            signs.setdefault(a[1], set()).add(a[4] * b[4] > 0)
        assert abs(a[4]) == pytest.approx(abs(b[4]), rel=1e-6, abs=1e-8)
        assert a[5] == pytest.approx(b[5], rel=1e-9)
        assert 0 <= a[6] < 1e-9
    assert all(len(seen) == 1 for seen in signs.values())


def test_whitening_equals_plain_version(spark):
    rows = [(row.vec_id, row.embedding) for row in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    check_whitening(QUERIES["op12_whitening"](spark, SF_DIR).collect(), plain_whitening(rows))


def test_whitening_of_edge_rows(spark):
    rows = spark.createDataFrame(VECTORS, "vec_id long, embedding array<double>").withColumns({"n": F.lit("clash"), "x": F.lit(1), "component": F.lit(2)})
    check_whitening(whitening.whitened(rows).collect(), plain_whitening(VECTORS[6:]))
    assert whitening.whitened(rows.limit(0)).count() == 0
    assert whitening.whitened(rows.where("vec_id = 8")).count() == 0
    few = whitening.whitened(rows.where("vec_id in (7, 8)"))  # two distinct vectors have one direction
    assert few.count() == 3


def test_deviation_beyond_a_long_is_null(spark):
    rows = spark.range(2000).select(F.col("id").alias("vec_id"), F.array(F.col("id") * 100.0, F.col("id") % 7 * 1.0).alias("v"))
    plain = plain_whitening([(row.vec_id, row.v) for row in rows.collect()])
    found = whitening.whitened(rows, vector="v").collect()
    check_whitening(found, [(*row[:3], row[3] if row[3] < 1 << 63 else None, *row[4:]) for row in plain])
    assert 0 < sum(row.deviation is None for row in found) < len(found)


def test_entries_far_apart(spark):
    data = [(n, [1e13 * n, float(n % 3), 1e12 * (n % 2)]) for n in range(9)]
    check_whitening(whitening.whitened(spark.createDataFrame(data, "vec_id long, v array<double>"), vector="v", components=2).collect(),
                    [(*row[:3], row[3] if row[3] < 1 << 63 else None, *row[4:]) for row in plain_whitening(data, 2)])


@pytest.mark.parametrize("spectrum", [
    [9.0, 9.0, 9.0, 1.0, 1.0, 0.5, 0.25, 0.0], [1e6, 1.0, 1.0 + 1e-7, 1e-6, 1e-9, 3.0, 2.0, 2.0], list(range(1, 41)), [5.0] * 12, [1.0] + [0.0] * 30,
    [1 + 1e-3 * k for k in range(60)],
])
def test_pairs_equal_dense_ones(spectrum):
    rng = np.random.default_rng(5)
    turn, _ = np.linalg.qr(rng.standard_normal((len(spectrum), len(spectrum))))
    matrix = (turn * spectrum) @ turn.T
    values, vectors = whitening.largest_pairs(matrix, 16)
    expected = np.linalg.eigvalsh((matrix + matrix.T) / 2)[::-1][:16]
    np.testing.assert_allclose(values, expected, atol=1e-13 * max(spectrum) * len(spectrum))
    np.testing.assert_allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-10)
    np.testing.assert_allclose(matrix @ vectors, vectors * values, atol=1e-12 * max(spectrum) * len(spectrum))


def test_inertia_counts():
    matrix = np.diag([3.0, 2.0, 2.0, -1.0]) + 0.0
    turn, _ = np.linalg.qr(np.random.default_rng(1).standard_normal((4, 4)))
    inertia = whitening.Inertia(turn @ matrix @ turn.T)
    assert [inertia.above(shift) for shift in (-2, 0, 1.9, 2.1, 4)] == [4, 3, 3, 1, 0]


def plain_clusters(rows, dimensions, k=8, rounds=10):
    kept = [(key, [math.floor(1024 * c) for c in v]) for key, v in rows]
    first = sorted((hashlib.sha256(f"3:{'' if key is None else key}".encode()).hexdigest(), q) for key, q in kept)[:k]
    centers = [q for _, q in first]
    nearest = lambda q: min((sum((a - b) ** 2 for a, b in zip(q, center)), c) for c, center in enumerate(centers))
    for _ in range(rounds):
        members = defaultdict(list)
        for _, q in kept:
            members[nearest(q)[1]].append(q)
        centers = [[sum(column) // len(members[c]) for column in zip(*members[c])] if members[c] else center for c, center in enumerate(centers)]
    found = [(key, *nearest(q)) for key, q in kept]
    total = Counter()
    for _, distance, cluster in found:
        total[cluster] += distance
    marks = [hashlib.sha256(",".join(map(str, center)).encode()).hexdigest() for center in centers]
    return [(key, cluster, distance, total[cluster], sum(total.values()), marks[cluster]) for key, distance, cluster in found]


def test_clusters_of_edge_rows(spark):
    rows = spark.createDataFrame(VECTORS, "vec_id long, embedding array<double>").withColumns({"q": F.lit("clash"), "cluster": F.lit(1), "ids": F.lit(2)})
    order = lambda row: (row[0] is None, row[0] or 0)
    for k in (2, 8):
        found = clusters.clusters(rows, dimensions=3, n_centroids=k).collect()
        assert sorted(map(tuple, found), key=order) == sorted(plain_clusters(VECTORS[6:], 3, k), key=order)
    assert clusters.clusters(rows, dimensions=3).where("false").count() == 0
    assert clusters.clusters(rows.limit(0)).count() == 0


def test_clusters_in_small_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(n, [float(x) for x in np.round(rng.normal(size=4) * 3 + 5 * (n % 5), 2)]) for n in range(300)] + [(n, [1.0, 1.0, 1.0, 1.0]) for n in range(300, 450)]
    monkeypatch.setattr(clusters, "BLOCK", 7)
    found = clusters.clusters(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), dimensions=4).collect()
    assert sorted(map(tuple, found)) == sorted(plain_clusters(rows, 4))


def test_components_that_do_not_fit_raise(spark):
    rows = spark.createDataFrame([(1, [1e9, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond"):
        clusters.clusters(rows, dimensions=2).collect()


def test_tails_come_in_small_batches(spark, monkeypatch):
    """What a row asks of comes with it, so a batch of many rows would hold the tails' grams many times."""
    most, pick = 1 << 14, context_trees.pick

    def watched(batches):
        def looked_at():
            for batch in batches:
                assert batch.num_rows == 1 or batch.nbytes <= 4 * most
                yield batch

        return pick(looked_at())

    monkeypatch.setattr(context_trees, "BATCH_BYTES", most)
    monkeypatch.setattr(context_trees, "pick", watched)
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    chance = random.Random(23)
    docs = spark.createDataFrame([(n, " ".join(f"{chance.randrange(10**9)}" for _ in range(200))) for n in range(60)], "doc_id long, text string")
    found = context_trees.language_scores(docs, bucket_bytes=4_000)
    assert found.count() == 60 and spark.conf.get(setting) == before

"""Near-duplicate documents, found with SetSketch registers.

A document is the set of its 5-word shingles. For each register a sketch keeps the smallest of exponential hash values,
on a scale of powers of ``BASE``, cut to 16 bits: registers of two sets merge by their maximum, and are equal about as
often as the sets are similar. Steps, each a written table in the shared folder:

1. One pass over the texts gives every row its set's 128-bit hash and registers. Rows with one hash are a class.
2. Bands of six registers deal the classes into buckets. In each bucket, everyone is paired with the smallest. Bands are
   so long that texts with a passage in common, which are no copies, seldom meet in a bucket: at a similarity of 0.3 one
   pair in 22 does.
3. Pairs whose similarity, estimated by maximum likelihood from the joint registers, could reach the threshold are
   confirmed on the full sets; links are joined to components.
4. In the buckets that still hold more than one component, all members of different components are compared, in blocks
   of bounded size: a bucket of n members is dealt to n/BLOCK block pairs, so no task sees it whole, and only pairs that
   could reach the threshold by their registers leave a block. They are confirmed as before.

So copies are not expanded into pairs, members of one component are not compared again, and no bucket is capped.

Rows that share a doc_id are one document. Null and empty texts have no shingles and are linked with nothing. A row with
a null doc_id takes the component of its copies, and is null and not kept if it has none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoferry.llm.common import Scratch, id_filter, maybe_among, shuffled_join, staged, texts_of
from geoferry.llm.words import WordHasher, mixed, text_arrays

#: Fixed values of the contract.
SHINGLE, PERCENT = 5, 75
SPACE_BYTES = {32, 9, 10, 11, 12, 13}

#: Registers, how many make a band, and bands; the registers beyond them only sharpen the estimate. Sets at the threshold
#: share no band once in 280,000. Then the base and rate of the sketch.
REGISTERS, ROWS, BANDS = 512, 6, 64
BASE, RATE, LARGEST = 1.001, 20.0, (1 << 16) - 1
#: Standard deviations below the threshold at which an estimate is still confirmed on the sets.
SLACK = 4.5
#: Members of a block of a bucket, and pairs of one leader that a task confirms at a time.
BLOCK, LED = 1024, 512

_SEEDS = np.random.default_rng(8).integers(1, 1 << 63, (REGISTERS, 1), dtype=np.uint64) | np.uint64(1)
_PLACES = np.random.default_rng(9).integers(1, 1 << 63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_SALTS = np.random.default_rng(10).integers(1, 1 << 63, BANDS, dtype=np.uint64)
_LEAST = PERCENT / 100 - SLACK * np.sqrt(PERCENT / 100 * (1 - PERCENT / 100) / REGISTERS)


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """For each text the sorted hashes of its distinct shingles."""
    hasher = WordHasher(set(range(256)) - SPACE_BYTES)
    for data, starts in text_arrays(column):
        breaks = np.array(starts, np.int64)
        found = [(first, mixed(hashes)) for first, _, hashes in hasher.slices(data, breaks)]
        first, words = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
        edges = np.searchsorted(first, breaks)
        n = max(0, len(words) - SHINGLE + 1)
        windows = np.zeros(n, np.uint64)
        for place, factor in enumerate(_PLACES):
            windows += words[place : place + n] * factor
        windows = mixed(windows)
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if high - low >= SHINGLE:
                yield np.unique(windows[low : high - SHINGLE + 1])
            elif high > low:
                yield mixed((words[low:high] * _PLACES[: high - low]).sum(dtype=np.uint64, keepdims=True) + np.uint64(high - low))
            else:
                yield words[:0]


def registers_of(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a set. Registers of a union are the larger of both sets' registers."""
    top = np.zeros(REGISTERS, np.uint64)
    for at in range(0, len(hashes), 256):
        np.maximum(top, (hashes[at : at + 256] * _SEEDS).max(axis=1), out=top)
    with np.errstate(divide="ignore"):
        least = -np.log((top.astype(np.float64) + 1) / 2.0**64) / RATE
        value = np.floor(1 - np.log(np.maximum(least, 1e-300)) / np.log(BASE))
    return np.clip(value + LARGEST // 2, 0, LARGEST).astype("<u2")


def band_keys(registers: np.ndarray) -> np.ndarray:
    """The buckets of sketches, a column for each band: a hash of its registers."""
    banded = registers[:, : BANDS * ROWS].reshape(len(registers), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(_SALTS, banded.shape[:2])
    for place in range(ROWS):
        keys = keys * np.uint64(0x9E3779B97F4A7C15) + banded[:, :, place]
    return mixed(keys).view(np.int64)


def estimated(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum likelihood of the similarity, from how many registers are larger, smaller and equal; rows are pairs."""
    more, less = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    grid = np.minimum(np.arange(0.02, 1.0001, 0.02)[None, :], np.minimum(u / v, v / u) - 1e-9)
    chance = lambda x: -np.log1p(-np.maximum(x, 1e-12) * (BASE - 1) / BASE) / np.log(BASE)
    p, q = chance(u - v * grid), chance(v - u * grid)
    likelihood = more * np.log(p) + less * np.log(q) + (REGISTERS - more - less) * np.log(np.maximum(1 - p - q, 1e-12))
    return np.take_along_axis(grid, likelihood.argmax(axis=1)[:, None], 1)[:, 0]


def could_link(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    sizes = 100 * np.minimum(n_a, n_b) >= PERCENT * np.maximum(n_a, n_b)
    found = np.zeros(len(a), bool)
    some = np.flatnonzero(sizes)
    for at in range(0, len(some), 8192):
        rows = some[at : at + 8192]
        found[rows] = estimated(a[rows], b[rows], n_a[rows], n_b[rows]) >= _LEAST
    return found


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, REGISTERS)


def sketches(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, set hash (s0, s1), registers, and the columns behind the text."""
    others = docs.columns[2:]

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, hashes, registers = [], [], []
            for found in shingle_sets(batch.column(1)):
                sizes.append(len(found))
                digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                hashes.append(np.frombuffer(digest, np.int64))
                registers.append(registers_of(found).tobytes() if len(found) else None)
            both = np.array(hashes, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(registers, pa.binary()), *batch.columns[2:]],
                names=["doc_id", "n_shingles", "s0", "s1", "registers", *others],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(sketch, ", ".join([f"doc_id {kind}, n_shingles long, s0 long, s1 long, registers binary", *[f"`{name}` {docs.schema[name].dataType.simpleString()}" for name in others]]))


def bands(classes: DataFrame) -> DataFrame:
    """The buckets of each class: one key for each band."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = band_keys(_matrix(batch.column(1)))
            ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids)], names=["bucket", "cid"])

    return classes.select("cid", "registers").mapInArrow(deal, "bucket long, cid long")


def sketches_among(classes: DataFrame, ids: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """cid, n_shingles and registers of the classes that may be among ``ids``, a written table with a column ``cid``.

    Registers are the bulk of what is shuffled, so those of classes that are in no pair or open bucket stay where they are.
    """
    known = classes.select("cid", "n_shingles", "registers")
    return maybe_among(known, "cid", id_filter(ids, "cid", scratch)).where("__maybe").drop("__maybe")


def likely(pairs: DataFrame, classes: DataFrame, scratch: Scratch | None = None, ids: DataFrame | None = None) -> DataFrame:
    """The pairs (a, b) whose registers allow a link. ``pairs`` is a written table, or else ``ids`` is one that has all that
    are in pairs as ``cid``."""
    known = sketches_among(classes, pairs.select(F.col("a").alias("cid")).union(pairs.select("b")) if ids is None else ids, scratch)
    mine = known.withColumnsRenamed({"cid": "a", "n_shingles": "n_a", "registers": "r_a"})
    theirs = known.withColumnsRenamed({"cid": "b", "n_shingles": "n_b", "registers": "r_b"})
    both = shuffled_join(shuffled_join(pairs, mine, ["a"]), theirs, ["b"])
    near = both.where(100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b, n_a, n_b, r_a, r_b = batch.columns
                fine = could_link(_matrix(r_a), _matrix(r_b), n_a.to_numpy(), n_b.to_numpy())
                yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(fine))

    return near.select("a", "b", "n_a", "n_b", "r_a", "r_b").mapInArrow(keep, "a long, b long")


def confirmed(pairs: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The pairs that are links on their full sets. ``pairs`` is a written table."""
    needed = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b"))
    # Few texts are needed: only those that may be are shuffled.
    some = maybe_among(docs, "doc_id", id_filter(needed, "doc_id")).where("__maybe").drop("__maybe")
    texts = shuffled_join(some, needed.distinct(), ["doc_id"], "left_semi", always=True)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x.tobytes() for x in shingle_sets(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(found, pa.binary())], names=["cid", "shingles"])

    sets = scratch.stage(texts.select("doc_id", "text").mapInArrow(collect, "cid long, shingles binary"), "sets")
    # The first of a pair leads many: its set is sent once for so many of them, ahead of theirs.
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / LED).alias("n_parts"))
    led = scratch.stage(shuffled_join(pairs, sizes, ["a"]).select("a", "b", F.pmod(F.xxhash64("b"), F.col("n_parts")).alias("part")), "led")
    theirs = shuffled_join(led, sets.withColumnsRenamed({"cid": "b"}), ["b"], always=True).select("a", "part", "b", "shingles")
    leaders = shuffled_join(led.select("a", "part").distinct(), sets.withColumnsRenamed({"cid": "a"}), ["a"], always=True)
    both = theirs.unionByName(leaders.withColumn("b", F.lit(None).cast("long")))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, leads = None, []  # rows that share an id may have different sets
        for batch in batches:
            kept = []
            for a, part, b, found in zip(*(batch.column(place).to_pylist() for place in range(3)), batch.column(3)):
                shingles = np.frombuffer(found.as_buffer(), np.uint64)
                if b is None:
                    if leader != (a, part):
                        leader, leads = (a, part), []
                    leads.append(shingles.copy())
                    continue
                for mine in leads:
                    common = len(mine) + len(shingles) - len(np.unique(np.concatenate((mine, shingles))))
                    if 100 * common >= PERCENT * (len(mine) + len(shingles) - common):
                        kept.append((a, b))
                        break
            columns = list(zip(*kept)) or [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(list(column), pa.int64()) for column in columns], names=["a", "b"])

    dealt = both.select("a", "part", "b", "shingles").repartition("a", "part").sortWithinPartitions("a", "part", F.asc_nulls_first("b"))
    return dealt.mapInArrow(check, "a long, b long")


def shared_buckets(dealt: DataFrame) -> DataFrame:
    """(bucket, cid, leader): the members of buckets that have several, with the least of them.

    Rows are brought together by bucket and gone through in order; of a bucket no more than its leader is held.
    """

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # the last row's bucket, its leader, and whether the leader's own row is out
        for batch in batches:
            if not batch.num_rows:
                continue
            bucket, cid = (column.to_numpy() for column in batch.columns)
            if before is not None:
                bucket, cid = np.append(before[0], bucket), np.append(before[1], cid)
            begins = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            sizes = np.diff(np.append(begins, len(bucket)))
            leader = np.repeat(cid[begins], sizes)
            several = np.repeat(sizes > 1, sizes)
            if before is not None and before[2]:
                several[0] = False
            yield pa.RecordBatch.from_arrays([pa.array(x[several]) for x in (bucket, cid, leader)], names=["bucket", "cid", "leader"])
            goes_on = before is not None and before[2] and len(begins) == 1
            before = bucket[-1:], leader[-1:], bool(sizes[-1] > 1) or goes_on

    together = dealt.repartition("bucket").sortWithinPartitions("bucket", "cid")
    return together.mapInArrow(share, "bucket long, cid long, leader long")


def star_pairs(shared: DataFrame) -> DataFrame:
    """Everyone in a bucket with the least of it. A group's buckets mostly agree on it, so its pairs are few."""
    return shared.where("cid != leader").select(F.col("leader").alias("a"), F.col("cid").alias("b")).distinct()


def components(links: DataFrame, scratch: Scratch, start: DataFrame | None = None) -> DataFrame:
    """(cid, component): the least id that links lead to, for every linked id. ``start``: components known before.

    Ids take the least label of their neighbours, then their label's label, until nothing changes. The result is a table
    of ``scratch``; those on the way are dropped.
    """
    spark, edge_scratch, before = links.sparkSession, Scratch(), Scratch()
    edges = links.select("a", "b")
    if start is not None:
        edges = edges.union(start.where("cid != component").select("component", "cid"))
    there, back = F.struct(F.col("a").alias("cid"), F.col("b").alias("other")), F.struct(F.col("b").alias("cid"), F.col("a").alias("other"))
    edges = edge_scratch.stage(edges.select(F.inline(F.array(there, back))), "edges")
    labels = before.stage(edges.groupBy("cid").agg(F.least(F.col("cid"), F.min("other")).alias("component")), "labels")
    while True:
        of_others = labels.select(F.col("cid").alias("other"), F.col("component").alias("theirs"))
        heard = shuffled_join(edges, of_others, ["other"]).select("cid", F.lit(None).cast("long").alias("component"), "theirs")
        both = heard.unionByName(labels.withColumn("theirs", F.col("component")))
        taken = both.groupBy("cid").agg(F.max("component").alias("before"), F.min("theirs").alias("label"))
        above = labels.select(F.col("cid").alias("label"), F.col("component").alias("beyond"))
        after = Scratch()
        moved = after.stage(
            shuffled_join(taken, above, ["label"]).select("cid", "before", F.least("label", "beyond").alias("component")), "labels"
        )
        before.drop(spark)
        labels, before = moved.select("cid", "component"), after
        if moved.where("before != component").isEmpty():
            edge_scratch.drop(spark)
            scratch.paths += before.paths
            return labels


def cross_pairs(shared: DataFrame, classes: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs of different components in one bucket whose registers allow a link, each from their first common band."""
    known = shuffled_join(shared.drop("leader"), labels, ["cid"], "left")
    members = known.select("bucket", "cid", F.coalesce("component", "cid").alias("component"))
    mixed_buckets = (
        members.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"))
        .where("low != high").select("bucket", F.ceil(F.col("size") / BLOCK).alias("n_blocks"))
    )
    some = scratch.stage(shuffled_join(members, mixed_buckets, ["bucket"]), "open-buckets")
    mine = F.pmod(F.xxhash64("cid"), F.col("n_blocks"))
    spread = some.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))
    rows = shuffled_join(spread, sketches_among(classes, some.select("cid")), ["cid"]).select(
        "bucket", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
        "mine", "cid", "component", "n_shingles", "registers",
    )
    grouped = rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
            mine, ids, components_, sizes = (group.column(name).to_numpy() for name in ("mine", "cid", "component", "n_shingles"))
            registers = _matrix(group.column("registers").combine_chunks())
            bucket = np.int64(group.column("bucket")[0].as_py())
            keys = band_keys(registers)
            band = int(np.argmax(keys[0] == bucket))
            for row in range(len(ids)):
                others = np.flatnonzero((components_ != components_[row]) & ((mine > mine[row]) if i != j else (np.arange(len(ids)) > row)))
                others = others[~(keys[others, :band] == keys[row, :band]).any(axis=1)]
                if not len(others):
                    continue
                near = others[could_link(np.broadcast_to(registers[row], (len(others), REGISTERS)), registers[others], np.full(len(others), sizes[row]), sizes[others])]
                if len(near):
                    a, b = np.minimum(ids[row], ids[near]), np.maximum(ids[row], ids[near])
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return grouped.mapInArrow(compare, "a long, b long").distinct()


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Neighbouring rows with one (bucket, i, j), over the bounds of batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy() for k in range(3)], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
        for low, high in zip(cuts[:-1], cuts[1:]):
            key = tuple(keys[low])
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(low, high - low))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _labelled(texts: DataFrame, result: Scratch) -> DataFrame:
    """Per row: doc_id, n_shingles, set hash (s0, s1), component_id, and the columns behind the text; a table of ``result``."""
    spark, scratch, early = texts.sparkSession, Scratch(), Scratch()
    rows = scratch.stage(sketches(texts), "sketches")
    classes = scratch.stage(
        rows.where("n_shingles > 0 and doc_id is not null").groupBy("s0", "s1")
        .agg(F.min("doc_id").alias("cid"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers")),
        "classes",
    )
    shared = scratch.stage(shared_buckets(bands(classes)), "buckets")
    sure = texts.where("doc_id is not null")
    first = early.stage(likely(star_pairs(shared), classes, ids=shared), "pairs")
    labels = components(confirmed(first, sure, early), scratch)
    early.drop(spark)
    second = early.stage(cross_pairs(shared, classes, labels, early), "pairs")
    if not second.isEmpty():
        labels = components(confirmed(second, sure, early), scratch, labels)
    early.drop(spark)
    named = shuffled_join(classes.select("s0", "s1", "cid"), labels, ["cid"], "left")
    named = named.select("s0", "s1", F.coalesce("component", "cid").alias("component_id"))
    found = shuffled_join(rows.drop("registers"), named, ["s0", "s1"], "left")
    found = result.stage(found.withColumn("component_id", F.coalesce("component_id", "doc_id")), "labelled")
    scratch.drop(spark)
    return found


def with_components(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id and kept."""
    texts = texts_of(docs)
    kind = texts.schema["doc_id"].dataType
    found = _labelled(texts.withColumn("doc_id", F.col("doc_id").cast("long")), Scratch())
    return found.select(F.col("doc_id").cast(kind).alias("doc_id"), "n_shingles", F.col("component_id").cast(kind).alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents with the least doc_id of their component; all columns stay.

    Of rows with one id and one set of shingles, one stays, and of rows with a null id whose set no document with an id
    has. Different sets under one id stay, but for those that copy another document.
    """
    names = [F.col(f"`{name}`") for name in docs.columns]
    hashed = F.xxhash64(*[F.col(f"`{x.name}`") for x in docs.schema.fields if "map<" not in x.dataType.simpleString()])
    scratch = Scratch()
    numbered = staged(docs.withColumns({"__draw": hashed, "__row": F.monotonically_increasing_id()}), "numbered")
    texts = numbered.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), "__draw", "__row")
    own = _labelled(texts, scratch).where("component_id is null or doc_id = component_id")
    kept = own.groupBy("component_id", "s0", "s1").agg(F.min(F.struct("__draw", "__row")).alias("first")).select(F.col("first.__row").alias("__row"))
    kept = scratch.stage(kept, "kept")
    # Most rows stay, and those that surely do are not shuffled.
    goes = staged(shuffled_join(numbered.select("__row"), kept, ["__row"], "left_anti", always=True), "dropped")
    asked = maybe_among(numbered, "__row", id_filter(goes, "__row", Scratch()))
    left = shuffled_join(asked.where("__maybe"), goes, ["__row"], "left_anti", always=True)
    scratch.drop(docs.sparkSession)
    return asked.where(~F.col("__maybe")).unionByName(left).select(*names)

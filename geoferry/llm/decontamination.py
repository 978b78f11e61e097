"""Benchmark decontamination: one Aho-Corasick automaton over the words of all benchmark items.

Words are the runs of characters other than ASCII punctuation, white space and controls, with A-Z in lower case. A
window is ten consecutive words of an item (a shorter item with a word is one window). A document word inside any
occurrence of a window is hit.

The automaton's letters are word numbers. A word that no item has leads every state back to the root, so a text is
hashed word by word in numpy, only runs of known words walk the automaton, and each match is compared with the
item's words before it counts. Places are mapped back to code points of the original text.

The items travel to the executors whole if they hold at most ``BLOCK_BYTES``, and otherwise in blocks of that size, one
scan of the texts for each: nothing is left out. Null texts have no words; rows without an item_id are no items; rows
that share an item_id are one item with all their windows. Repeated documents are judged row by row.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from geoferry.llm.common import Scratch, ascii_lower, staged, texts_of
from geoferry.llm.words import WordHasher, text_arrays

#: Fixed values of the contract.
WINDOW = 10

#: Items up to so many bytes are held by one automaton. A byte of items takes 60 to 80 bytes of a worker, as measured on
#: 2 and 5 MB of items without a word window in common: a block takes about 300 MB.
BLOCK_BYTES = 4 << 20

#: The bytes of words: digits, letters and everything beyond ASCII.
LETTERS = [*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]

_FIRST = re.compile(r"[A-Z]+")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def found_fields(item_id: T.DataType) -> list[T.StructField]:
    """What is found in a text; items have ids of any type."""
    kinds = {"__n_words": T.LongType(), "__n_hit": T.LongType(), "__items": T.ArrayType(item_id), "__spans": _SPANS}
    return [T.StructField(name, kind) for name, kind in kinds.items()]


def words_of(text: str) -> list[str]:
    """The words of a text, for the items and for tests."""
    return _WORD.findall(_FIRST.sub(lambda found: found[0].lower(), text))


class Windows:
    """The windows of some items, as an automaton over word numbers.

    The automaton's values are window numbers. Where a window's words stand, and which items have it, is in arrays of
    numbers: the words of all items one after the other, and for each window the places of its items in a second one.
    """

    def __init__(self, items: list[tuple[object, str]], window: int = WINDOW) -> None:
        import ahocorasick

        self.hasher = WordHasher(LETTERS)
        self.ids = [item_id for item_id, _ in items]
        numbers: dict[str, int] = {}
        words, places, of_window, of_item = array("i"), array("q"), array("q"), array("i")
        self.shortest = 0
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for item, (_, text) in enumerate(items):
            begin = len(words)
            words.extend(numbers.setdefault(word, len(numbers) + 1) for word in words_of(text))
            size = min(window, len(words) - begin)
            for at in range(begin, len(words) - size + 1 if size else begin):
                key = tuple(words[at : at + size])
                number = self.automaton.get(key, -1)
                if number < 0:
                    number = len(places) // 2
                    self.automaton.add_word(key, number)
                    places.extend((at, size))
                of_window.append(number)
                of_item.append(item)
            if size:
                self.shortest = min(size, self.shortest or size)
        self.automaton.make_automaton()
        self.words = [w.encode() for w in numbers]
        self.stream, self.places = np.array(words, np.int32), np.array(places, np.int64).reshape(-1, 2)
        order = np.lexsort((of_item, of_window))
        self.items = np.array(of_item, np.int32)[order]
        self.items_from = np.searchsorted(np.array(of_window, np.int64)[order], np.arange(len(self.places) + 1))
        hashes = np.zeros(0, np.uint64)
        if self.words:
            joined = np.frombuffer(b" ".join(self.words), np.uint8)
            hashes = self.hasher(joined, np.zeros(0, np.int64))[2]
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.numbers = hashes[order], (order + 1).astype(np.int32)
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.hashes & np.uint64(0xFFFF)).astype(np.int64)] = True

    def known(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, 0 for words of no item."""
        numbers = np.zeros(len(hashes), np.int32)
        if len(self.hashes):
            some = np.flatnonzero(self.maybe[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.hashes, hashes[some]), len(self.hashes) - 1)
            right = self.hashes[at] == hashes[some]
            numbers[some[right]] = self.numbers[at[right]]
        return numbers

    def matches(self, numbers: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """First word, word behind the last, and the number of the window of each occurrence."""
        if not self.shortest:
            return
        inside = np.concatenate(([False], numbers > 0, [False]))
        turns = np.flatnonzero(inside[1:] != inside[:-1])
        for begin, end in zip(turns[::2].tolist(), turns[1::2].tolist()):
            if end - begin >= self.shortest:
                for last, window in self.automaton.iter(tuple(numbers[begin:end].tolist())):
                    yield begin + last + 1 - int(self.places[window, 1]), begin + last + 1, window

    def of_texts(self, data: np.ndarray, starts: list[int]) -> Iterator[tuple[int, int, list, list[dict]]]:
        """For each text (``starts`` has one place more than there are texts): words, hit words, items, spans."""
        breaks = np.array(starts, np.int64)
        found = [(first, last, self.known(hashes)) for first, last, hashes in self.hasher.slices(data, breaks)]
        first, last, number = (np.concatenate(x) for x in zip(*found)) if found else [np.zeros(0, np.int64)] * 3
        edges = np.searchsorted(first, breaks)
        for row in range(len(starts) - 1):
            lo, hi = int(edges[row]), int(edges[row + 1])
            hit, items = None, set()
            for begin, end, window in self.matches(number[lo:hi]):
                place = self.places[window, 0]
                if all(self.words[self.stream[place + k] - 1] == data[first[lo + begin + k] : last[lo + begin + k]].tobytes().lower() for k in range(end - begin)):
                    hit = np.zeros(hi - lo + 1, np.int32) if hit is None else hit
                    hit[begin] += 1
                    hit[end] -= 1
                    items.update(self.items[self.items_from[window] : self.items_from[window + 1]].tolist())
            if hit is None:
                yield hi - lo, 0, [], []
                continue
            inside = np.concatenate(([False], np.cumsum(hit[:-1]) > 0, [False]))
            turns = np.flatnonzero(inside[1:] != inside[:-1])
            text = data[starts[row] : starts[row + 1]]
            points = np.concatenate(([0], np.cumsum((text & 0xC0) != 0x80)))
            spans = [
                {"start": int(points[first[lo + a] - starts[row]]), "end": int(points[last[lo + b - 1] - starts[row]])}
                for a, b in zip(turns[::2], turns[1::2])
            ]
            yield hi - lo, int(inside.sum()), sorted({self.ids[item] for item in items}), spans


_MADE: dict[str, Windows] = {}


def _windows(items: list[tuple[object, str]], window: int) -> Windows:
    """Made once in each Python worker."""
    key = hashlib.sha256(repr((window, items)).encode()).hexdigest()
    if key not in _MADE:
        _MADE.clear()
        _MADE[key] = Windows(items, window)
    return _MADE[key]


def _scan(docs: DataFrame, text: str, items: list[tuple[object, str]], window: int, kind: T.DataType) -> DataFrame:
    """The rows of ``docs`` with what one block of items finds in them."""
    shared = docs.sparkSession.sparkContext.broadcast(items)
    place = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, *found_fields(kind)])
    kinds = [pa.int64(), pa.int64(), pa.list_(to_arrow_type(kind)), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _windows(shared.value, window)
        for batch in batches:
            rows = []
            for data, starts in text_arrays(batch.column(place)):
                rows.extend(windows.of_texts(data, starts))
            columns = list(zip(*rows)) or [[], [], [], []]
            added = [pa.array(list(column), kind) for column, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[field.name for field in schema])

    return docs.mapInArrow(scan, schema)


def item_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[object, str]]]:
    """The items in blocks of a bounded number of bytes, in a fixed order."""
    items = texts_of(benchmark, "item_id").where("item_id is not null").withColumn("size", F.octet_length("text") + 16)
    total = items.agg(F.sum("size")).first()[0] or 0
    n_blocks = -(-total // block_bytes) or 1
    if n_blocks == 1:
        yield sorted((row.item_id, row.text) for row in items.select("item_id", "text").collect())
        return
    dealt = staged(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(2 * n_blocks))), "items")
    for block in range(2 * n_blocks):
        yield sorted((row.item_id, row.text) for row in dealt.where(F.col("block") == block).select("item_id", "text").collect())


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``__n_words``, ``__n_hit``, ``__items`` (sorted ids) and ``__spans`` (hit code points) for each row."""
    found, kind, earlier = None, benchmark.schema["item_id"].dataType, Scratch()
    for items in item_blocks(benchmark, block_bytes):
        if found is None:
            found = _scan(docs, text, items, window, kind)
            continue
        after = Scratch()
        before = after.stage(found.withColumnsRenamed({"__items": "__items_a", "__spans": "__spans_a", "__n_words": "__n_a", "__n_hit": "__hit_a"}), "scanned")
        earlier.drop(docs.sparkSession)
        earlier = after
        both = _scan(before, text, items, window, kind)
        found = _merged(both, docs.columns, text)
    return found


def _merged(both: DataFrame, columns: list[str], text: str) -> DataFrame:
    """Two blocks' finds as one: spans are united, and hit words counted again inside them."""
    spans = F.array_sort(F.concat("__spans_a", "__spans"))
    united = F.aggregate(
        spans,
        F.array().cast(_SPANS),
        lambda done, span: F.when(
            (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["end"] >= span["start"]),
            F.concat(
                F.slice(done, F.lit(1), F.size(done) - 1),
                F.array(F.struct(F.get(done, F.size(done) - 1)["start"].alias("start"), F.greatest(F.get(done, F.size(done) - 1)["end"], span["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(done, F.array(span))),
    )
    inside = F.transform(F.col("__spans"), lambda span: F.substring(F.col(f"`{text}`").cast("string"), (span["start"] + 1).cast("int"), (span["end"] - span["start"]).cast("int")))
    counted = F.aggregate(F.transform(inside, lambda part: F.regexp_count(ascii_lower(part), F.lit(_WORD.pattern))), F.lit(0).cast("long"), lambda a, b: a + b)
    return (
        both.withColumn("__spans", united)
        .withColumn("__n_hit", counted)
        .withColumn("__items", F.array_sort(F.array_union("__items_a", "__items")))
        .select(*[f"`{name}`" for name in columns], *[field.name for field in found_fields(T.LongType())])
    )


def decontamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = decontaminated(texts_of(docs), benchmark)
    ids = F.array_join(F.array_sort(F.transform("__items", lambda item: item.cast("string"))), ",")
    return found.select(
        "doc_id",
        F.col("__n_words").alias("n_words"),
        F.col("__n_hit").alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        (F.col("__n_hit") > 0).alias("contaminated"),
    )


def _numbered(docs: DataFrame, text: str) -> tuple[DataFrame, str]:
    """The frame with columns named by their place, which can't clash with what is found, and the text's name in it."""
    names = [f"c{place}" for place in range(len(docs.columns))]
    return docs.toDF(*names), names[docs.columns.index(text)]


def without_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents with the hit passages cut out of their texts; all columns stay, and so do all rows."""
    numbered, place = _numbered(docs, text)
    found = decontaminated(numbered, benchmark, place)
    whole = F.col(place).cast("string")
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform("__spans", lambda span: span["end"]))
    gaps = F.zip_with(ends, F.transform("__spans", lambda span: span["start"]), lambda end, start: F.when(start.isNull(), F.substring(whole, (end + 1).cast("int"), F.lit(2147483647))).otherwise(F.substring(whole, (end + 1).cast("int"), (start - end).cast("int"))))
    cut = F.when(F.size("__spans") > 0, F.array_join(gaps, "")).otherwise(whole)
    return found.select(*[(cut if own == place else F.col(own)).alias(name) for own, name in zip(numbered.columns, docs.columns)])


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents without a hit word, with all their columns."""
    numbered, place = _numbered(docs, text)
    found = decontaminated(numbered, benchmark, place).where("__n_hit = 0")
    return found.select(*[F.col(own).alias(name) for own, name in zip(numbered.columns, docs.columns)])

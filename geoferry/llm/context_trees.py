"""Language-model scores of texts by context-tree weighting.

A text is the sequence of its lower-cased words, one space between two of them, and one end mark: the tokens that the
unigram base counts, as bytes. Each byte is eight binary decisions; the tree of a decision (one for each beginning of a
byte, ``node`` 1 to 255) branches by the bytes before it, the last one first, down to ``DEPTH``. Every context has a
Krichevsky-Trofimov estimate of its decisions and weighs it half and half against the product of its children; the
probability of a byte is what the weighted trees, fitted to all training texts, give to one more such byte in its
context. All depths take part; a context that training never saw gives even odds. Nothing is pruned or capped.

The statistics grow with the corpus and are never in one place:

1. Documents are dealt to buckets of ``BUCKET_BYTES`` by a hash. A bucket counts its distinct (context, byte) grams and
   words; the grams of one *tail*, the three bytes before, make a row.
2. Rows of a tail are merged, at most ``FAN`` at a time, until one holds the tail's counts over the corpus.
3. Trees are weighed from the leaves up: each tail by itself, then the tails that share their last byte, then the root,
   which gets 256 rows of at most 255 numbers.
4. Weights go back down the same way. A tail has then the probability of each of its grams, which is joined to the
   rows that asked for it, back along the merges, and each bucket adds up its documents.

Word counts for the base go the same ways, a part of their hashes in place of the tail; words are told apart by 64-bit
hashes. Texts are shuffled twice; all else are distinct grams and words of buckets.

Null and empty texts are the end mark alone. A null doc_id is not held out, so its text is learned from; each row is
scored by itself, repeated ones too, and counts once for each time it stands in the table. An empty table gives an
empty result; without training texts every decision has even odds and the base score is 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoferry.llm.common import SPACES, Scratch, in_batches, shuffled_join, staged, texts_of
from geoferry.llm.words import WordHasher, mixed, text_arrays

#: Bytes of a context, and of its beginning that rows are dealt by.
DEPTH, TAIL = 5, 3
#: Text that a task counts at a time, rows of a tail that a task merges, and bytes whose windows are sorted at a time.
BUCKET_BYTES, FAN, SLICE = 16 << 20, 512, 1 << 19
#: Bytes that a task gets at a time; a row that asked comes with all that its tail has.
BATCH_BYTES = 4 << 20
#: Parts beyond the tails hold words, by so many bits of their hash.
WORDS_FROM, WORD_BITS = 1 << (8 * TAIL), 12

END, GAP = 10, 32
_ROW = "holder long, part int, ids binary, counts binary"
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.isin(np.arange(256), list(SPACES.encode()))
#: The end mark's number among the words; no word hashes to it but by chance.
_END_WORD = np.uint64(0x9E3779B97F4A7C15)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 1, F.lit(False))


# Texts as grams and words


def _u64(value: int) -> np.uint64:
    return np.uint64(value)


def laid_out(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts as the model reads them, each behind ``DEPTH`` end marks that are its first context; where each begins."""
    word = ~_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[starts] = True
    keep = word.copy()
    keep[:-1] |= word[1:] & ~first[1:-1]  # a space stays if the next byte is a word's, in the same text
    # ... but for those before the first word.
    words_so_far = np.concatenate(([0], np.cumsum(word, dtype=np.int64)))
    leading = np.searchsorted(words_so_far, words_so_far[starts[:-1]] + 1) - 1  # each text's first byte of a word
    before = leading - 1
    keep[before[(before >= starts[:-1]) & (leading < starts[1:])]] = False
    kept = np.concatenate(([0], np.cumsum(keep, dtype=np.int64)))
    n = np.diff(kept[starts])
    begins = np.concatenate(([0], np.cumsum(n + DEPTH + 1)))
    out = np.full(begins[-1], END, np.uint8)
    inside = np.ones(len(out), bool)
    for place in range(DEPTH):
        inside[begins[:-1] + place] = False
    inside[begins[1:] - 1] = False
    out[inside] = np.where(word, _LOWER[data], np.uint8(GAP))[keep]
    return out, begins


def windows(text: np.ndarray, begins: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grams and the number of the text they stand in, slice by slice. The last byte before is the highest one."""
    pad = np.zeros(len(text), bool)
    for place in range(DEPTH):
        pad[begins[:-1] + place] = True
    for low in range(DEPTH, len(text), SLICE):  # the first bytes are no grams
        high = min(len(text), low + SLICE)
        grams = text[low:high].astype(np.uint64)
        for back in range(1, DEPTH + 1):
            grams |= text[low - back : high - back].astype(np.uint64) << _u64(8 * (DEPTH + 1 - back))
        first, last = np.searchsorted(begins, [low, high - 1], "right") - 1
        ends = np.minimum(begins[first + 1 : last + 2], high)
        of = np.repeat(np.arange(first, last + 1), np.diff(np.concatenate(([low], ends))))
        real = ~pad[low:high]
        yield grams[real], of[real]


class Lookup:
    """Values by 64-bit ids, in a table of open addresses that many ids are looked up in at once."""

    NONE = np.uint64((1 << 64) - 1)
    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, ids: np.ndarray, values: np.ndarray) -> None:
        bits = max(4, (3 * len(ids)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.ids, self.values = np.full(1 << bits, self.NONE), np.zeros(1 << bits)
        slots = self._slots(ids)
        while len(ids):
            free = self.ids[slots] == self.NONE
            self.ids[slots[free]] = ids[free]  # of several for one place the last one has it
            placed = self.ids[slots] == ids
            self.values[slots[placed]] = values[placed]
            ids, values, slots = ids[~placed], values[~placed], (slots[~placed] + 1) & self.last

    def _slots(self, ids: np.ndarray) -> np.ndarray:
        return ((ids * self.FACTOR) >> self.shift).astype(np.int64)

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        slots = self._slots(ids)
        found = self.values[slots]
        left = np.flatnonzero(self.ids[slots] != ids)
        slots = slots[left]
        while len(left):
            slots = (slots + 1) & self.last
            there = self.ids[slots]
            if (there == self.NONE).any():
                raise KeyError("an id has no value")
            right = there == ids[left]
            found[left[right]] = self.values[slots[right]]
            left, slots = left[~right], slots[~right]
        return found


def tokens(data: np.ndarray, starts: np.ndarray, hasher: WordHasher) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the words and the number of the text they stand in, and last each text's end mark."""
    for first, _, hashes in hasher.slices(data, starts):
        yield mixed(hashes), np.searchsorted(starts, first, "right") - 1
    yield np.full(len(starts) - 1, _END_WORD), np.arange(len(starts) - 1)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    new = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
    return keys[new], np.add.reduceat(counts, new) if len(new) else counts[:0]


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    new = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
    return keys[new], np.diff(np.append(new, len(keys)))


class Tally:
    """Distinct numbers of many slices with how often training texts hold them, zero included."""

    def __init__(self) -> None:
        self.found: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, learned: np.ndarray) -> None:
        known, times = distinct(keys[learned])
        other, _ = distinct(keys[~learned])
        self.found += [(known, times), (other, np.zeros(len(other), np.int64))]
        self.size += len(known) + len(other)
        if self.size > 4 * SLICE:  # and the sums are what is left of it
            self.found = [self.sums()]
            self.size = 0

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.found:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return summed(*(np.concatenate(x) for x in zip(*self.found)))


def _blobs(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The values between cuts as binary."""
    offsets = (cuts * values.itemsize).astype(np.int64)
    data = pa.py_buffer(np.ascontiguousarray(values).tobytes())
    return pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(offsets.tobytes()), data]).cast(pa.binary())


def _cuts(parts: np.ndarray) -> np.ndarray:
    return np.concatenate((np.flatnonzero(np.concatenate((np.ones(min(1, len(parts)), bool), parts[1:] != parts[:-1]))), [len(parts)])).astype(np.int64)


def part_of_grams(grams: np.ndarray) -> np.ndarray:
    return (grams >> _u64(8 * (DEPTH + 1 - TAIL))).astype(np.int32)


def part_of_words(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> _u64(64 - WORD_BITS)).astype(np.int32) + WORDS_FROM


def _rows(holder: int, keys: np.ndarray, parts: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    cuts = _cuts(parts)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(cuts) - 1, holder, np.int64)), pa.array(parts[cuts[:-1]]), _blobs(keys, cuts), _blobs(counts.astype("<i8"), cuts)],
        names=["holder", "part", "ids", "counts"],
    )


def _texts(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, slice]]:
    """Bytes of the texts, where each begins and the last ends, and which rows they are."""
    at = 0
    for chunk in table.column("text").chunks:
        for data, starts in text_arrays(chunk, 1 << 20):
            n = len(starts) - 1
            yield data, np.array(starts, np.int64), slice(at, at + n)
            at += n


def count_bucket(key: tuple, table: pa.Table) -> pa.Table:
    """The distinct grams and words of a bucket's texts, a row for each part."""
    hasher = WordHasher(np.flatnonzero(~_SPACE).tolist())
    learned = ~table.column("held").to_numpy().astype(bool)
    grams, words = Tally(), Tally()
    for data, starts, rows in _texts(table):
        some = learned[rows]
        for found, of in windows(*laid_out(data, starts)):
            grams.add(found, some[of])
        for found, of in tokens(data, starts, hasher):
            words.add(found, some[of])
    found = []
    for tally, part_of in ((grams, part_of_grams), (words, part_of_words)):
        keys, counts = tally.sums()
        found.append(_rows(key[0].as_py(), keys, part_of(keys), counts))
    return pa.Table.from_batches(found)


def _flat(column: pa.Array | pa.ChunkedArray, kind: str) -> np.ndarray:
    """The numbers in all rows of a binary column, one after the other."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    found = [np.zeros(0, kind)]
    for chunk in chunks:
        if len(chunk):
            chunk = chunk.cast(pa.large_binary())
            _, offsets, data = chunk.buffers()
            ends = np.frombuffer(offsets, np.int64)[chunk.offset : chunk.offset + len(chunk) + 1]
            found.append(np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]].copy().view(kind))
    return np.concatenate(found)


def _sizes(column: pa.Array, width: int = 8) -> np.ndarray:
    return pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64) // width


def _by_part(batch: pa.RecordBatch, name: str = "part") -> pa.RecordBatch:
    return batch.sort_by(name) if batch.num_rows > 1 else batch


def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a part, which are neighbours, as one."""

    def merged(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        holders, parts = (rows.column(name).to_numpy() for name in ("holder", "part"))
        for holder in np.unique(holders).tolist():
            for kind, part_of in ((parts < WORDS_FROM, part_of_grams), (parts >= WORDS_FROM, part_of_words)):
                some = rows.filter(pa.array(kind & (holders == holder)))
                if some.num_rows:
                    keys, counts = summed(_flat(some.column("ids"), "<u8"), _flat(some.column("counts"), "<i8"))
                    yield _rows(holder, keys, part_of(keys), counts)

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        holders, parts = (rows.column(name).to_numpy() for name in ("holder", "part"))
        whole = int(np.argmax((holders == holders[-1]) & (parts == parts[-1])))  # the last part may go on
        yield from merged(rows.slice(0, whole))
        held = rows.slice(whole)
    if held is not None:
        yield from merged(held)


# Trees


def log_gamma(values: np.ndarray) -> np.ndarray:
    distinct_, place = np.unique(values, return_inverse=True)
    return np.array([math.lgamma(x) for x in distinct_.tolist()])[place]


def kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov estimate of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - math.log(math.pi) - log_gamma(zeros + ones + 1.0)


class Level:
    """The contexts of one depth: entries (context, byte) with counts, and for each bit their nodes.

    A key is the context followed by the byte; a node's, in bit j, the context followed by the first j bits.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys, self.counts = keys, counts
        self.nodes, self.zeros, self.ones, self.of = [], [], [], []
        for bit in range(8):
            node = keys >> _u64(8 - bit)
            cuts = _cuts(node)[:-1]
            is_one = ((keys >> _u64(7 - bit)) & _u64(1)).astype(np.int64)
            every = np.add.reduceat(counts, cuts) if len(cuts) else counts[:0]
            ones = np.add.reduceat(counts * is_one, cuts) if len(cuts) else counts[:0]
            self.nodes.append(node[cuts])
            self.ones.append(ones)
            self.zeros.append(every - ones)
            self.of.append(np.repeat(np.arange(len(cuts)), np.diff(np.append(cuts, len(keys)))))

    def above(self) -> Level:
        """The contexts that are one byte shorter."""
        return Level(*summed(_parent(self.keys, 8), self.counts))

    def estimates(self) -> list[np.ndarray]:
        return [kt(zeros, ones) for zeros, ones in zip(self.zeros, self.ones)]

    def chances(self, bit: int) -> np.ndarray:
        """Of a one, by the estimate of each node."""
        return (self.ones[bit] + 0.5) / (self.zeros[bit] + self.ones[bit] + 1.0)


def _parent(keys: np.ndarray, bits: int) -> np.ndarray:
    """The same beginning of a byte in the context without its first byte: the farthest one back is the lowest."""
    return ((keys >> _u64(8 + bits)) << _u64(bits)) | (keys & _u64((1 << bits) - 1))


def weigh(level: Level, below: list[np.ndarray], children: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Logarithms of the weighted probabilities of a level's nodes, and the weight of each node's own estimate.

    ``children``: keys of the nodes one depth down, ``below`` their logarithms.
    """
    weighted, own = [], []
    for bit, estimate in enumerate(level.estimates()):
        place = np.searchsorted(level.nodes[bit], _parent(children[bit], bit))
        product = np.bincount(place, below[bit], len(estimate)) if len(place) else np.zeros(len(estimate))
        total = np.logaddexp(estimate, product) - math.log(2)
        weighted.append(total)
        own.append(np.exp(np.minimum(0.0, estimate - math.log(2) - total)))
    return weighted, own


def descend(level: Level, own: list[np.ndarray], rest: list[np.ndarray], ones: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """What the depths down to a level give to a one at each node, and what is left to the deeper ones.

    ``rest`` and ``ones`` are those of each node's parent.
    """
    given = [one + left * weight * level.chances(bit) for bit, (weight, left, one) in enumerate(zip(own, rest, ones))]
    return [left * (1 - weight) for weight, left in zip(own, rest)], given


def climb(bottom: Level, below: list[np.ndarray] | None, steps: int) -> tuple[list[Level], list[list[np.ndarray]], list[np.ndarray]]:
    """Levels from the bottom up, the weights of their nodes' own estimates, and the top's logarithms.

    ``below``: logarithms of the bottom level itself where deeper ones are done; without it, it is the deepest.
    """
    levels = [bottom]
    weights = [[np.ones(len(node)) for node in bottom.nodes]]
    logs = bottom.estimates() if below is None else below
    for _ in range(steps):
        up = levels[-1].above()
        logs, own = weigh(up, logs, levels[-1].nodes)
        levels.append(up)
        weights.append(own)
    return levels, weights, logs


def _inherited(parent: Level, level: Level, values: list[np.ndarray]) -> list[np.ndarray]:
    return [some[np.searchsorted(parent.nodes[bit], _parent(level.nodes[bit], bit))] for bit, some in enumerate(values)]


def log_chances(bottom: Level, ones: list[np.ndarray]) -> np.ndarray:
    """Base-10 logarithm of each entry's probability; nothing is left to deeper contexts."""
    total = np.zeros(len(bottom.keys))
    for bit in range(8):
        is_one = ((bottom.keys >> _u64(7 - bit)) & _u64(1)).astype(bool)
        one = ones[bit][bottom.of[bit]]
        total += np.log10(np.where(is_one, one, 1 - one))
    return total


# Of a context that all its entries share, rows hold the bytes that follow it, in order, with their counts, and numbers
# of its nodes: first those of bit 0, then of bit 1, and so on. Which nodes there are follows from the bytes.

_SHORT = "tail int, bytes binary, counts binary, logs binary"


def _contexts(level: Level) -> tuple[np.ndarray, np.ndarray]:
    """The contexts of a level, and where each one's entries begin and the last one's end."""
    cuts = _cuts(level.keys >> _u64(8))
    return (level.keys[cuts[:-1]] >> _u64(8)).astype(np.int64), cuts


def _places(level: Level) -> tuple[list[np.ndarray], np.ndarray]:
    """Where the nodes of each bit stand if numbers are put together context by context; where each context begins."""
    contexts, _ = _contexts(level)
    of = [np.searchsorted(contexts, (node >> _u64(bit)).astype(np.int64)) for bit, node in enumerate(level.nodes)]
    sizes = np.stack([np.bincount(some, minlength=len(contexts)) for some in of], axis=1)
    begins = np.concatenate(([0], np.cumsum(sizes.ravel())))
    places = []
    for bit, some in enumerate(of):
        first = np.concatenate(([0], np.cumsum(sizes[:, bit])))[:-1]
        places.append(begins[:-1].reshape(sizes.shape)[some, bit] + np.arange(len(some)) - first[some])
    return places, np.append(begins[:-1].reshape(sizes.shape)[:, 0], begins[-1])


def _together(level: Level, values: list[np.ndarray]) -> pa.Array:
    """Numbers of nodes as binary, a row for each context."""
    places, cuts = _places(level)
    flat = np.zeros(cuts[-1])
    for place, some in zip(places, values):
        flat[place] = some
    return _blobs(flat, cuts)


def _apart(level: Level, column: pa.Array) -> list[np.ndarray]:
    """The same numbers bit by bit."""
    flat = _flat(column, "<f8")
    return [flat[place] for place in _places(level)[0]]


def _shortened(level: Level, logs: list[np.ndarray]) -> pa.RecordBatch:
    contexts, cuts = _contexts(level)
    return pa.RecordBatch.from_arrays(
        [pa.array(contexts.astype(np.int32)), _blobs((level.keys & _u64(255)).astype(np.uint8), cuts), _blobs(level.counts.astype("<i8"), cuts), _together(level, logs)],
        names=["tail", "bytes", "counts", "logs"],
    )


def _level_of(batch: pa.RecordBatch) -> Level:
    return Level(_flat(batch.column("ids"), "<u8"), _flat(batch.column("counts"), "<i8"))


def tails_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each tail's bytes, counts and weighted probabilities, from its grams."""
    for batch in batches:
        if batch.num_rows:
            levels, _, logs = climb(_level_of(_by_part(batch)), None, DEPTH - TAIL)
            yield _shortened(levels[-1], logs)


def _joined(table: pa.Table) -> tuple[Level, list[np.ndarray]]:
    """The rows of many contexts of one depth as a level, with its logarithms."""
    table = table.sort_by("tail").combine_chunks()
    tails = np.repeat(table.column("tail").to_numpy().astype(np.uint64), _sizes(table.column("bytes"), 1))
    level = Level((tails << _u64(8)) | _flat(table.column("bytes"), "u1").astype(np.uint64), _flat(table.column("counts"), "<i8"))
    return level, _apart(level, table.column("logs"))


def middle_up(key: tuple, table: pa.Table) -> pa.Table:
    """The contexts of one byte, from the tails that end with it."""
    levels, _, logs = climb(*_joined(table), TAIL - 1)
    return pa.Table.from_batches([_shortened(levels[-1], logs)])


def root(table: pa.Table) -> tuple[Level, list[np.ndarray], list[np.ndarray]]:
    """The empty context, what it leaves to the deeper ones and gives to a one at each node."""
    levels, weights, _ = climb(*_joined(table), 1)
    top = levels[-1]
    nothing = [np.zeros(len(node)) for node in top.nodes]
    return top, *descend(top, weights[-1], [x + 1 for x in nothing], nothing)


_STATE = "tail int, rest binary, ones binary"


def middle_down(top: Level, rest_: list[np.ndarray], ones_: list[np.ndarray]):
    """For each tail what the contexts above it leave and give, from the root's."""

    def down(key: tuple, table: pa.Table) -> pa.Table:
        levels, weights, _ = climb(*_joined(table), TAIL - 1)
        above, rest, ones = top, rest_, ones_
        for level, own in zip(levels[:0:-1], weights[:0:-1]):
            rest, ones = descend(level, own, _inherited(above, level, rest), _inherited(above, level, ones))
            above = level
        bottom = levels[0]
        rest, ones = (_together(bottom, _inherited(above, bottom, x)) for x in (rest, ones))
        return pa.table({"tail": _contexts(bottom)[0].astype(np.int32), "rest": rest, "ones": ones})

    return down


_ANSWER = "part int, ids binary, answers binary"


def tails_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The logarithm of the probability of each gram."""
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = _by_part(batch)
        levels, weights, _ = climb(_level_of(batch), None, DEPTH - TAIL)
        rest, ones = (_apart(levels[-1], batch.column(name)) for name in ("rest", "ones"))
        above = None
        for level, own in zip(levels[::-1], weights[::-1]):
            if above is not None:
                rest, ones = _inherited(above, level, rest), _inherited(above, level, ones)
            rest, ones = descend(level, own, rest, ones)
            above = level
        cuts = np.concatenate(([0], np.cumsum(_sizes(batch.column("ids")))))
        yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("ids"), _blobs(log_chances(above, ones), cuts)], names=["part", "ids", "answers"])


def _as_answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words as the numbers that are asked for."""
    for batch in batches:
        cuts = np.concatenate(([0], np.cumsum(_sizes(batch.column("ids")))))
        yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("ids"), _blobs(_flat(batch.column("counts"), "<i8").astype("<f8"), cuts)], names=["part", "ids", "answers"])


def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The answers to the ids that a row asked for."""
    for batch in batches:
        found = []
        for asked, ids, answers in zip(*(batch.column(name) for name in ("asked", "ids", "answers"))):
            place = np.searchsorted(np.frombuffer(ids.as_buffer(), "<u8"), np.frombuffer(asked.as_buffer(), "<u8"))
            found.append(np.frombuffer(answers.as_buffer(), "<f8")[place].tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("holder"), batch.column("part"), batch.column("asked"), pa.array(found, pa.binary())], names=["holder", "part", "ids", "answers"])


# Scores


def score_bucket(n_words: int, n_distinct: int, kind: pa.DataType):
    """The scores of a bucket's documents, from the answers to its grams and words."""
    least = math.log10(n_words + 0.5 * (n_distinct + 1))

    def score(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        answers = answers.sort_by("part")
        grams = int(np.searchsorted(answers.column("part").to_numpy(), WORDS_FROM))
        kinds = answers.slice(0, grams), answers.slice(grams)
        of_gram, of_word = (Lookup(_flat(some.column("ids"), "<u8"), _flat(some.column("answers"), "<f8")) for some in kinds)
        hasher = WordHasher(np.flatnonzero(~_SPACE).tolist())
        n, known = (np.zeros(table.num_rows, np.int64) for _ in range(2))
        base, model = (np.zeros(table.num_rows) for _ in range(2))
        for data, starts, rows in _texts(table):
            size = rows.stop - rows.start
            for grams, of in windows(*laid_out(data, starts)):
                model[rows] += np.bincount(of, of_gram(grams), size)
            for words, of in tokens(data, starts, hasher):
                count = of_word(words)
                n[rows] += np.bincount(of, minlength=size)
                known[rows] += np.bincount(of[count > 0], minlength=size)
                base[rows] += np.bincount(of, np.log10(count + 0.5) - least, size)
        return pa.table(
            {"doc_id": table.column("doc_id").cast(kind), "held_out": table.column("held"), "n_tokens": n, "n_known": known,
             "train_tokens": np.full(table.num_rows, n_words), "base_score": base, "score": model}
        )

    return score


def _merged(rows: DataFrame) -> DataFrame:
    dealt = rows.withColumn("holder", F.floor(F.col("holder") / FAN)).repartition("holder", "part")
    return dealt.sortWithinPartitions("holder", "part").mapInArrow(merge, _ROW)


def language_scores(docs: DataFrame, key: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    Learned from the rows whose crc32(doc_id as text) mod 5 is not 1. ``score`` is the model's base-10 logarithm of the
    text's probability, ``base_score`` that of a unigram model with half a count added to each word.
    """
    with in_batches(docs.sparkSession, BATCH_BYTES):
        return _scores(docs, key, text, bucket_bytes)


def _scores(docs: DataFrame, key: str, text: str, bucket_bytes: int) -> DataFrame:
    spark, scratch = docs.sparkSession, Scratch()
    texts = texts_of(docs, key, text).withColumnsRenamed({key: "doc_id", text: "text"})
    kind = texts.schema["doc_id"].dataType.simpleString()
    n_bytes = texts.agg(F.sum(F.octet_length("text").cast("long") + 1)).first()[0] or 1
    n_holders = math.ceil(n_bytes / bucket_bytes)
    dealt = texts.select("doc_id", "text", held_out(F.col("doc_id")).alias("held"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_holders)).alias("holder"))

    layers = [scratch.stage(dealt.groupBy("holder").applyInArrow(count_bucket, _ROW), "counted")]
    while n_holders > 1:
        layers.append(scratch.stage(_merged(layers[-1]), "merged"))
        n_holders = math.ceil(n_holders / FAN)
    whole = layers[-1]
    grams, words = whole.where(F.col("part") < WORDS_FROM), whole.where(F.col("part") >= WORDS_FROM)

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = _flat(batch.column(0), "<i8")
            yield pa.RecordBatch.from_arrays([pa.array([counts.sum()]), pa.array([np.count_nonzero(counts)])], names=["n", "v"])

    n_words, n_distinct = words.select("counts").mapInArrow(sizes, "n long, v long").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()

    up = scratch.stage(grams.select("part", "ids", "counts").mapInArrow(tails_up, _SHORT), "tails")
    last_byte = F.shiftright("tail", 8 * (TAIL - 1))
    middle = up.groupBy(last_byte.alias("last_byte"))
    short = middle.applyInArrow(middle_up, _SHORT).toArrow()  # 256 rows at most
    answered = words.select("part", "ids", "counts").mapInArrow(_as_answers, _ANSWER)
    if short.num_rows:
        states = middle.applyInArrow(middle_down(*root(short)), _STATE).withColumnRenamed("tail", "part")
        both = shuffled_join(grams.select("part", "ids", "counts"), states, ["part"])
        answered = answered.union(both.select("part", "ids", "counts", "rest", "ones").mapInArrow(tails_down, _ANSWER))
    answered = scratch.stage(answered.withColumn("holder", F.lit(0).cast("long")).select("holder", "part", "ids", "answers"), "answers")
    for asking in layers[-2::-1]:
        asked = asking.select(F.col("holder").alias("own"), F.floor(F.col("holder") / FAN).alias("holder"), "part", F.col("ids").alias("asked"))
        both = shuffled_join(asked, answered, ["holder", "part"]).select(F.col("own").alias("holder"), "part", "asked", "ids", "answers")
        answered = both.mapInArrow(pick, f"holder long, {_ANSWER}")
        if asking is not layers[0]:
            answered = scratch.stage(answered, "answers")

    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    arrow_kind = spark.createDataFrame([], f"doc_id {kind}").toArrow().schema.field(0).type
    scored = dealt.groupBy("holder").cogroup(answered.groupBy("holder")).applyInArrow(score_bucket(n_words, n_distinct, arrow_kind), schema)
    result = staged(scored, "scored")
    scratch.drop(spark)
    return result


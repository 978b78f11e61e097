"""SentencePiece encoding and decoding for merge-type models, by backtracking.

A text is encoded exactly if every two neighbouring tokens are what merging would leave of them: the encoder takes the
longest match at each place (from an Aho-Corasick scan, or down a tree of the pieces), goes to a shorter one where the neighbours don't agree, and
steps back, marking the place as failed in a bitfield, where none is left. Whether two tokens agree is found by merging
their characters again, and remembered.

The proof needs distinct scores. Runs of the space symbol, which share one score in common models, are merged by the
queue itself; no piece holds a space symbol behind another character, so texts fall apart before each such run.

The texts of a batch are encoded together: each different part once, and the short parts, which are nearly all, by the
same backtracking in step with each other, as arrays that hold the state of every part. What short parts gave is kept.

Null texts are empty texts and have no tokens. Rows are encoded one by one, so repeated rows and further columns stay.
"""

from __future__ import annotations

import heapq
import math
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed values of the model format: the space symbol and the kinds of pieces.
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6

#: Parts of at most so many characters are remembered and encoded in step, and so many of them remembered in a worker;
#: parts that go in step at a time, and under which number each goes on alone.
PART_LENGTH, PARTS, BESIDE, FEW = 32, 100_000, 1 << 15, 24
#: Pairs whose agreement is remembered: by parts alone, and by parts in step, as a power of two.
PAIRS, PAIR_BITS = 50_000, 19
#: Places for the nodes of the tree of pieces, as a power of two.
CHILD_BITS = 20
#: Parts the texts of a batch; a text that holds it is cut by itself.
CUT = "\0"
#: Tokens from this number on stand for single characters that no piece has.
FOREIGN = 1 << 20
#: A long part is scanned for matches in blocks of so many characters.
SCAN = 4096

ADDED = T.StructType([T.StructField("__ids", T.ArrayType(T.IntegerType())), T.StructField("__decoded", T.StringType())])


def model_bytes(path: str | None = None) -> bytes:
    """The model file, read on the driver; the executors need not have it."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as file:
        return file.read()


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The fields of a serialised message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            at, shift = at + 1, shift + 7
            if data[at - 1] < 128:
                return value

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(tag & 7) or number()
        yield tag >> 3, data[at : at + size]
        at += size


class Pieces:
    """Encoder and decoder of one model."""

    def __init__(self, model: bytes) -> None:
        import ahocorasick

        self.pieces: list[tuple[str, float, int]] = []
        trainer, normalizer = {}, {}
        for field, value in _fields(model):
            if field == 1:
                parts = dict(_fields(value))
                self.pieces.append((parts[1].decode(), struct.unpack("<f", parts.get(2, b"\0\0\0\0"))[0], parts.get(3, NORMAL)))
            elif field in (2, 3):
                (trainer if field == 2 else normalizer).update(_fields(value))
        kinds = {kind for _, _, kind in self.pieces}
        if trainer.get(3) != 2 or not trainer.get(35) or trainer.get(24) or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only merge-type models with byte fallback and plain pieces are supported")
        if normalizer.get(2) or not normalizer.get(3, 1) or normalizer.get(4, 1) or not normalizer.get(5, 1):
            raise ValueError("only models that keep the text as it is, after a leading space, are supported")
        normal = [(piece, score) for piece, score, kind in self.pieces if kind == NORMAL]
        self.score = dict(normal)
        if any(SPACE in piece.lstrip(SPACE) for piece in self.score):
            raise ValueError("a piece holds a space symbol behind another character")
        if any(len(piece) > 1 + len(piece.lstrip(SPACE)) > 1 for piece in self.score):
            raise ValueError("a piece holds two space symbols before another character")
        plain = {piece: score for piece, score in normal if len(piece) == 1 or piece.strip(SPACE)}
        longer = [score for piece, score in plain.items() if len(piece) > 1]
        if len(set(longer)) < len(longer):
            raise ValueError("pieces share a score, so neighbouring tokens don't decide an encoding")
        self.plain = {piece: score for piece, score in plain.items() if len(piece) > 1}
        numbers = list(range(len(self.pieces)))
        self.id_of = {piece: number for number, (piece, _, kind) in zip(numbers, self.pieces) if kind == NORMAL}
        self.byte_id = {int(piece[3:5], 16): number for number, (piece, _, kind) in enumerate(self.pieces) if kind == BYTE}
        self.longest = max(map(len, self.plain), default=1)
        # A piece that merging its own characters doesn't give is never a token.
        self.matcher = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self.token_id: dict[str, int] = {}
        self.made_of: dict[str, tuple[str, ...]] = {}
        for piece, number in self.id_of.items():
            parts: list[str] = []
            if len(piece) == 1 or piece in self.plain and self.merged(piece, self.plain, parts) == [piece]:
                self.matcher.add_word(piece, number)
                self.token_id[piece] = number
                self.made_of[piece] = tuple(parts)
        self.matcher.make_automaton()
        # If every piece has a lower score than its parts, what happens at the seam of two tokens decides on them.
        self.in_order = all(self.plain[piece] < self.plain.get(part, 0) for piece, parts in self.made_of.items() for part in parts)
        self.shorter = [-1] * len(self.pieces)
        for piece, number in self.token_id.items():
            if len(piece) > 1:
                found = (self.token_id.get(piece[:size]) for size in range(len(piece) - 1, 0, -1))
                self.shorter[number] = next((x for x in found if x is not None), FOREIGN + ord(piece[0]))
        self.rims: dict[tuple[str, int], list[tuple[str, float]]] = {}
        self.length_of = [len(piece) for piece, _, _ in self.pieces]
        self.surface = [piece.replace(SPACE, " ") for piece, _, _ in self.pieces]
        self.byte_of = {number: value for value, number in self.byte_id.items()}
        self.first_plain = 1 + max((number for number, (_, _, kind) in enumerate(self.pieces) if kind != NORMAL), default=-1)
        self.silent = {number for number, (_, _, kind) in enumerate(self.pieces) if kind == CONTROL}
        self.agreed: dict[int, bool] = {}
        self.pair_keys, self.pair_agrees = np.full(1 << PAIR_BITS, -1), np.zeros(1 << PAIR_BITS, bool)
        self.lengths, self.next_shorter = np.ones(FOREIGN + 0x110000, np.int16), np.full(FOREIGN + 0x110000, -1, np.int32)
        self.lengths[: len(self.pieces)], self.next_shorter[: len(self.pieces)] = self.length_of, self.shorter
        self.steps = self.token_id and not any(CUT in piece for piece in self.token_id)
        self._grow()
        # What ids stand for in bytes, and again for the first id of a text, whose leading space goes.
        bytes_of = [bytes([self.byte_of[number]]) if number in self.byte_of else surface.encode() for number, surface in enumerate(self.surface)]
        self.bytes_of = pa.array([*bytes_of, *[x.removeprefix(b" ") for x in bytes_of]], pa.binary())
        self.forget()

    @staticmethod
    def merged(text: str, score: dict[str, float], last: list[str] | None = None) -> list[str]:
        """What is left of the characters when the best neighbours are merged, the leftmost among equals.

        ``last`` gets the two parts of the last merge.
        """
        symbols: list[str] = list(text)
        after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        queue: list[tuple[float, int, int]] = []

        def offer(left: int, right: int) -> None:
            if 0 <= left and right < len(symbols) and (both := symbols[left] + symbols[right]) in score:
                heapq.heappush(queue, (-score[both], left, len(both)))

        for place in range(len(symbols) - 1):
            offer(place, place + 1)
        while queue:
            _, left, length = heapq.heappop(queue)
            right = after[left]
            if not symbols[left] or right >= len(symbols) or len(symbols[left]) + len(symbols[right]) != length:
                continue  # one of them was merged meanwhile
            if last is not None:
                last[:] = symbols[left], symbols[right]
            symbols[left] += symbols[right]
            symbols[right] = ""
            after[left] = after[right]
            if after[right] < len(symbols):
                before[after[right]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [symbol for symbol in symbols if symbol]

    def rim(self, token: str, side: int) -> list[tuple[str, float]]:
        """The symbols that stood at one end of a token while it was merged, with the score that made each."""
        known = self.rims.get((token, side))
        if known is None:
            parts = self.made_of.get(token)
            known = [*self.rim(parts[side], side), (token, self.plain[token])] if parts else [(token, 0.0)]
            self.rims[token, side] = known
        return known

    def _merge_seam(self, left: str, right: str) -> bool:
        """Merge two tokens' characters again as far as it concerns the seam: whether nothing crosses it."""
        a, b, i, j = self.rim(left, 1), self.rim(right, 0), 0, 0
        while True:
            next_a = a[i + 1][1] if i + 1 < len(a) else -math.inf
            next_b = b[j + 1][1] if j + 1 < len(b) else -math.inf
            across = self.plain.get(a[i][0] + b[j][0], -math.inf)
            if across > next_a and across >= next_b:  # of equals, the leftmost goes first
                return False
            if next_a == next_b == -math.inf:
                return True
            if next_a >= next_b:
                i += 1
            else:
                j += 1

    def agree(self, left: int, right: int) -> bool:
        """Whether merging the characters of two neighbouring tokens leaves these two."""
        key = left << 22 | right
        known = self.agreed.get(key)
        if known is None:
            if len(self.agreed) >= PAIRS:
                self.agreed.clear()
            a, b = [self.pieces[number][0] if number < FOREIGN else chr(number - FOREIGN) for number in (left, right)]
            known = self.agreed[key] = self._merge_seam(a, b) if self.in_order else self.merged(a + b, self.plain) == [a, b]
        return known

    def longest_matches(self, text: str) -> list[int]:
        """The longest token that starts at each place; a character of no piece is a token of its own."""
        found = [-1] * len(text)
        length_of = self.length_of
        for end, number in self.matcher.iter(text):  # of tokens with one start, the longer ends later
            found[end + 1 - length_of[number]] = number
        return [FOREIGN + ord(text[place]) if number < 0 else number for place, number in enumerate(found)] if -1 in found else found

    def _matches(self, text: str):
        """``longest_matches`` of a place, from blocks, so that memory doesn't follow the length of the text."""
        blocks: dict[int, list[int]] = {}

        def at(place: int) -> int:
            number = place // SCAN
            if number not in blocks:
                if len(blocks) > 2:
                    blocks.pop(min(blocks) if number > min(blocks) else max(blocks))
                begin = number * SCAN
                blocks[number] = self.longest_matches(text[begin : begin + SCAN + self.longest])[:SCAN]
            return blocks[number][place % SCAN]

        return at

    def tokens(self, text: str) -> list[int]:
        """Tokens of a part in which no two space symbols meet."""
        longest = self.longest_matches(text).__getitem__ if len(text) <= SCAN else self._matches(text)
        length_of, agreed, shorter = self.length_of, self.agreed, self.shorter
        failed = bytearray((len(text) >> 3) + 1)  # a bit for each place from which all attempts have failed
        tokens: list[int] = []
        place, token, end_of_text = 0, longest(0), len(text)
        while True:
            length = length_of[token] if token < FOREIGN else 1
            end = place + length
            if not failed[end >> 3] >> (end & 7) & 1 and (not tokens or agreed.get(tokens[-1] << 22 | token) or self.agree(tokens[-1], token)):
                tokens.append(token)
                if end == end_of_text:
                    return tokens
                place, token = end, longest(end)
                continue
            token = shorter[token] if token < FOREIGN else -1
            if token < 0:
                failed[place >> 3] |= 1 << (place & 7)
                token = tokens.pop()  # its end has failed now, so a shorter one comes next
                place -= length_of[token] if token < FOREIGN else 1

    def ids_of_part(self, part: str) -> tuple[int, ...]:
        """The ids of one part: a run of space symbols, then other characters."""
        rest = part.lstrip(SPACE)
        n_spaces = len(part) - len(rest)
        tokens = self.tokens(SPACE + rest if n_spaces else rest) if rest else []
        if rest and n_spaces:
            own = tokens[0] == self.id_of[SPACE]
            tokens, n_spaces = tokens[1:] if own else tokens, n_spaces - (not own)
        if n_spaces:
            tokens = [*[self.id_of[token] for token in self.merged(SPACE * n_spaces, self.score)], *tokens]
        if max(tokens) < FOREIGN:
            return tuple(tokens)
        return tuple(number for token in tokens for number in ([token] if token < FOREIGN else [self.byte_id[x] for x in chr(token - FOREIGN).encode()]))

    def forget(self) -> None:
        """No part is remembered any more: their places in one array of ids, its bounds, and the ids."""
        self.known: dict[str, int] = {"": 0}
        self.bounds, self.known_ids = np.zeros(2, np.int64), np.zeros(0, np.int32)

    def _agree_all(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``agree`` for many pairs; the last ones that fell on a place of the table are remembered."""
        keys = left << 22 | right
        places = self._place(keys, PAIR_BITS)
        agrees = self.pair_agrees[places]
        new = np.flatnonzero(self.pair_keys[places] != keys)
        if len(new):
            pairs, which = np.unique(keys[new], return_inverse=True)
            found = np.array([self.agree(pair >> 22, pair & ((1 << 22) - 1)) for pair in pairs.tolist()])
            agrees[new] = found[which]
            at = self._place(pairs, PAIR_BITS)
            _, first = np.unique(at, return_index=True)
            self.pair_keys[at[first]], self.pair_agrees[at[first]] = pairs[first], found[first]
        return agrees

    def _grow(self) -> None:
        """The pieces as a tree: the child of a node by character in a table, in which each has one place, or in order."""
        first = {"": 0}
        for piece in self.token_id:
            for size in range(1, len(piece) + 1):
                if piece[:size] not in first:
                    first[piece[:size]] = len(first)
        keys = np.array([first[piece[:-1]] << 21 | ord(piece[-1]) for piece in first if piece], np.int64)
        order = np.argsort(keys)
        self.child_keys, self.children = keys[order], (order + 1).astype(np.int32)
        self.child_places = np.full(1 << CHILD_BITS, -1, np.int32)
        self.child_places[self._place(self.child_keys, CHILD_BITS)] = np.arange(len(keys))
        self.token_at = np.array([self.token_id.get(piece, -1) for piece in first], np.int32)

    @staticmethod
    def _place(keys: np.ndarray, bits: int) -> np.ndarray:
        return (keys * 0x9E3779B97F4A7C1 >> 20) & ((1 << bits) - 1)

    def _longest_of_all(self, text: str) -> np.ndarray:
        """``longest_matches`` as an array: from every place, the tree is gone down together."""
        letters = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
        found = FOREIGN + letters
        place, node = np.arange(len(letters)), np.zeros(len(letters), np.int64)
        for depth in range(self.longest + 1):
            keys = node << 21 | letters[place + depth]
            at = self.child_places[self._place(keys, CHILD_BITS)]
            there = self.child_keys[at] == keys
            # Another's key may be in the place of this one.
            other = np.flatnonzero(~there & (at >= 0))
            if len(other):
                again = np.minimum(np.searchsorted(self.child_keys, keys[other]), len(self.child_keys) - 1)
                at[other], there[other] = again, self.child_keys[again] == keys[other]
            place, node = place[there], self.children[at[there]].astype(np.int64)
            tokens = self.token_at[node]
            ends = tokens >= 0
            found[place[ends]] = tokens[ends]
            inside = place + depth + 1 < len(letters)
            place, node = place[inside], node[inside]
            if not len(place):
                break
        return found

    def _tokens_in_step(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``tokens`` of short parts, all at once: one after the other, and how many each has; none for the last few parts."""
        longest = self._longest_of_all(CUT.join(parts) + CUT)
        sizes = np.array([len(part) for part in parts])
        begin = np.cumsum(np.append(0, sizes[:-1] + 1))
        stack, n_tokens = np.zeros(len(longest), np.int64), np.zeros(len(parts), np.int64)
        failed = np.zeros(len(longest), bool)
        # Of each part that is not done: where it begins and ends, where its stack ends, and the token tried at a place.
        row, first, last, top, place = np.arange(len(parts)), begin, begin + sizes, begin.copy(), begin.copy()
        token = longest[place]
        while len(row) > FEW:
            end = place + self.lengths[token]
            fits = ~failed[end]
            behind = np.flatnonzero(fits & (top > first))
            fits[behind] = self._agree_all(stack[top[behind] - 1], token[behind])
            stack[top[fits]] = token[fits]
            top += fits
            done = fits & (end == last)
            n_tokens[row[done]] = (top - first)[done]
            place[fits] = end[fits]
            back = np.flatnonzero(~fits)
            shorter = self.next_shorter[token[back]]
            token[back] = shorter
            back = back[shorter < 0]
            failed[place[back]] = True
            top[back] -= 1
            token[back] = stack[top[back]]
            place[back] -= self.lengths[token[back]]
            on = fits & ~done
            token[on] = longest[place[on]]
            if done.any():
                row, first, last, top, place, token = (x[~done] for x in (row, first, last, top, place, token))
        before = np.cumsum(n_tokens) - n_tokens
        return stack[np.arange(n_tokens.sum()) + np.repeat(begin - before, n_tokens)], n_tokens

    def _with_bytes(self, tokens: np.ndarray, n_tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids for tokens: characters of no piece are replaced by their bytes."""
        foreign = tokens >= FOREIGN
        if not foreign.any():
            return tokens, n_tokens
        letters, which = np.unique(tokens[foreign], return_inverse=True)
        of_letter = [[self.byte_id[x] for x in chr(letter - FOREIGN).encode()] for letter in letters.tolist()]
        times = np.ones(len(tokens), np.int64)
        times[foreign] = np.array([len(x) for x in of_letter])[which]
        ends = np.cumsum(times)
        ids = np.repeat(tokens, times)
        inside = np.repeat(foreign, times)
        within = np.arange(len(ids)) - np.repeat(ends - times, times)
        table = np.array([[*x, 0, 0, 0, 0][:4] for x in of_letter])
        ids[inside] = table[np.repeat(which, times[foreign]), within[inside]]
        bounds = np.append(0, ends)[np.append(0, np.cumsum(n_tokens))]
        return ids, np.diff(bounds)

    def ids_of_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of many parts one after the other, how many each has, and the order in which the parts come."""
        # In step go short parts of one space symbol at most and other characters.
        alike = [self.steps and 1 < len(part) <= PART_LENGTH and part[1] != SPACE and CUT not in part for part in parts]
        alone, short = [place for place, one in enumerate(alike) if not one], [place for place, one in enumerate(alike) if one]
        ids, sizes, order = [], [], []
        for at in range(0, len(short), BESIDE):
            some = np.array(short[at : at + BESIDE])
            tokens, n_tokens = self._tokens_in_step([parts[place] for place in some.tolist()])
            found, n_found = self._with_bytes(tokens, n_tokens)
            ids.append(found)
            sizes.append(n_found[n_found > 0])
            order.append(some[n_found > 0])
            alone += some[n_found == 0].tolist()
        found = [self.ids_of_part(parts[place]) for place in alone]
        ids.append(np.array([number for one in found for number in one], np.int64))
        sizes.append(np.array([len(one) for one in found], np.int64))
        order.append(np.array(alone, np.int64))
        return np.concatenate(ids), np.concatenate(sizes), np.concatenate(order)

    _CUT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def split(self, text: str) -> list[str]:
        """The parts of a text behind its leading space; parts never share a token."""
        marked = SPACE + text.replace(" ", SPACE)
        if SPACE + SPACE in marked or marked[-1] == SPACE:
            return self._CUT.findall(marked)
        return marked.replace(SPACE, "\0" + SPACE).split("\0")[1:] if "\0" not in text else self._CUT.findall(marked)

    def encode(self, text: str) -> list[int]:
        return [number for part in self.split(text) for number in self.ids_of_part(part)] if text else []

    def decode(self, ids, first: bool = True) -> str:
        """The text of some ids; at the beginning of a text the leading space goes."""
        if not first and min(ids, default=0) >= self.first_plain:
            return "".join([self.surface[number] for number in ids])
        done: list[str] = []
        held = bytearray()
        for number in ids:
            if number in self.byte_of:
                held.append(self.byte_of[number])
                continue
            if held:
                done.append(_text_of_bytes(held))
                held = bytearray()
            if number in self.silent:
                continue
            if self.pieces[number][2] == UNKNOWN:
                done.append(" ⁇ ")
                first = False
                continue
            surface = self.surface[number]
            if first and not any(done):
                surface, first = surface.removeprefix(" "), not surface.startswith(" ")
            done.append(surface)
        if held:
            done.append(_text_of_bytes(held))
        return "".join(done)

    def cut(self, texts: pa.Array) -> pa.ListArray:
        """``split`` for texts without the mark, as a column; empty parts among them stand for nothing."""
        import pyarrow.compute as pc

        marked = pc.binary_join_element_wise(pa.scalar(""), pc.replace_substring(texts, " ", SPACE), SPACE)
        if pc.any(pc.match_substring(marked, SPACE + SPACE)).as_py():
            marked = pc.replace_substring_regex(marked, f"({SPACE}+)", CUT + r"\1")
        else:
            marked = pc.replace_substring(marked, SPACE, CUT + SPACE)
        return pc.split_pattern(pc.if_else(pc.equal(texts, ""), "", marked), CUT)

    def encode_all(self, texts: pa.Array) -> pa.ListArray:
        """The ids of each text of a column without nulls."""
        import pyarrow.compute as pc

        odd = pc.match_substring(texts, CUT)
        if pc.any(odd).as_py():
            plain = self.cut(pc.if_else(odd, "", texts)).to_pylist()
            cut = pa.array([self.split(text) if is_odd else parts for text, is_odd, parts in zip(texts.to_pylist(), odd.to_pylist(), plain)], pa.list_(pa.string()))
        else:
            cut = self.cut(texts)
        words = cut.flatten().dictionary_encode()
        parts = words.dictionary.to_pylist()
        number = np.array([self.known.get(part, -1) for part in parts], np.int64)
        new = np.flatnonzero(number < 0)
        found, n_found, order = self.ids_of_parts([parts[place] for place in new.tolist()])
        number[new[order]] = np.arange(len(new)) + len(self.bounds) - 1
        ids = np.concatenate([self.known_ids, found.astype(np.int32)])
        bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(n_found)])
        # Each part's ids, one after the other, from where they are in the array.
        each = number[words.indices.to_numpy()]
        sizes = np.diff(bounds)[each]
        ends = np.append(0, np.cumsum(sizes))
        flat = ids[np.arange(ends[-1]) + np.repeat(bounds[:-1][each] - ends[:-1], sizes)]
        if len(self.known) + len(new) > PARTS or len(ids) > 8 * PARTS:
            self.forget()
        else:
            self.known_ids, self.bounds = ids, bounds
            self.known.update((parts[place], at) for place, at in zip(new.tolist(), number[new].tolist()) if len(parts[place]) <= PART_LENGTH)
        offsets = cut.offsets.to_numpy()
        return pa.ListArray.from_arrays(pa.array(ends[offsets - offsets[0]].astype(np.int32)), pa.array(flat))

    def decode_all(self, ids: pa.ListArray) -> pa.Array:
        """The text of each list of ids that encoding gave."""
        import pyarrow.compute as pc

        offsets, numbers = ids.offsets.to_numpy(), ids.values.to_numpy().copy()
        numbers[offsets[:-1][np.diff(offsets) > 0]] += len(self.pieces)
        pieces = pa.ListArray.from_arrays(ids.offsets, self.bytes_of.take(pa.array(numbers)))
        return pc.binary_join(pieces, b"").cast(pa.string())

    def both(self, text: str) -> tuple[np.ndarray, str]:
        """Ids of a text and the text decoded from them."""
        ids = self.encode_all(pa.array([text], pa.string()))
        return ids.values.to_numpy(), self.decode_all(ids)[0].as_py()


def _text_of_bytes(held: bytearray) -> str:
    """Bytes as UTF-8, with one replacement character for each byte that is not."""
    try:
        return held.decode()
    except UnicodeDecodeError:
        done, at = [], 0
        while at < len(held):
            for size in (1, 2, 3, 4):
                try:
                    done.append(bytes(held[at : at + size]).decode())
                    at += size
                    break
                except UnicodeDecodeError:
                    continue
            else:
                done.append("�")
                at += 1
        return "".join(done)


_MADE: dict[int, Pieces] = {}


def pieces_of(model: bytes) -> Pieces:
    """Made once in each Python worker."""
    key = hash(model)
    if key not in _MADE:
        _MADE.clear()
        _MADE[key] = Pieces(model)
    return _MADE[key]


def tokenized(docs: DataFrame, model: bytes, text: str = "text") -> DataFrame:
    """``docs`` with ``__ids`` (array of token ids) and ``__decoded`` (the text that the ids give)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, *ADDED.fields])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        coder = pieces_of(shared.value)
        for batch in batches:
            for one in _small(batch, place):
                ids = coder.encode_all(pc.fill_null(one.column(place), ""))
                yield pa.RecordBatch.from_arrays([*one.columns, ids, coder.decode_all(ids)], names=[field.name for field in schema])

    return docs.mapInArrow(encode, schema)


def _small(batch: pa.RecordBatch, place: int, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` bytes of text, or one row."""
    import pyarrow.compute as pc

    first, held = 0, 0
    for row, length in enumerate(pc.fill_null(pc.binary_length(batch.column(place)), 0).to_pylist()):
        if held and held + length > most:
            yield batch.slice(first, row - first)
            first, held = row, 0
        held += length
    yield batch.slice(first)


def encoded_report(docs: DataFrame, model: bytes | None = None) -> DataFrame:
    """Per document the number of tokens, and the digests of the ids and of the decoded text."""
    texts = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    done = tokenized(texts, model or model_bytes())
    return done.select(
        "doc_id",
        F.size("__ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("__ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("__decoded", 256).alias("decoded_sha256"),
    )

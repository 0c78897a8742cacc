"""SentencePiece encoding and decoding by suffix-array matching.

The distinct chunks of a batch are laid out as one text. Its suffixes are sorted by as many characters as the longest
piece has, and every piece of the vocabulary is looked up by binary search: the range it finds holds all its
occurrences. Occurrences are edges (position, length, piece), sorted by position. Relaxing them follows the model's
kind, byte-pair merges: from single characters on, each chunk repeatedly takes the best-scored edge that joins two
neighbouring symbols, the leftmost one on ties, until no edge does. Characters without a piece become bytes.

Chunks are words with the spaces before them. They can be encoded on their own because no piece goes on past a word;
where a vocabulary has such pieces, a whole text is one chunk.

Null texts encode to null and decode to null, empty ones to no ids. Decoding undoes encoding, but the sign that stands
for a space cannot be told from a space, as in the original.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from clicklake.llm.common import fresh

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Fixed value: what stands for a space in pieces.
SPACE = "▁"
#: Characters of distinct chunks that are indexed at a time.
INDEXED = 250_000
#: Bytes of chunks and their ids that a task remembers for sure; up to twice as many are kept.
REMEMBERED = 16_000_000
#: What a remembered chunk takes besides its characters and ids: two objects and a place in the table.
ENTRY = 240
#: Longer chunks are not remembered.
LONGEST_REMEMBERED = 128
#: Bytes of texts (or ids) that a worker turns into lists at a time; a single text may be longer.
AT_A_TIME = 8_000_000
#: Longer chunks are relaxed one by one, by a heap.
LONG = 48
#: Edges out of a position are told apart by their length, below this.
SPAN = 64


@dataclass(frozen=True)
class Vocabulary:
    """Pieces that match text, with ids and scores, and the ids of single bytes."""

    pieces: list[str]
    ids: list[int]
    scores: list[float]
    byte_ids: list[int]
    unknown: int

    @staticmethod
    def read(path: str = MODEL) -> Vocabulary:
        """From a model file, on the driver; workers get the lists."""
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        plain = [
            i for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        return Vocabulary(
            [model.id_to_piece(i) for i in plain], plain, [model.get_score(i) for i in plain],
            byte_ids if model.is_byte(byte_ids[0]) else [], model.unk_id(),
        )


class Matcher:
    """Occurrences of all pieces in a text, by its suffix array."""

    def __init__(self, pieces: list[str]):
        self.longest = max(map(len, pieces), default=1)
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        self.codes = np.full((len(pieces), self.longest), -1, np.int64)
        for i, p in enumerate(pieces):
            self.codes[i, : len(p)] = [ord(c) for c in p]

    def suffixes(self, codes: np.ndarray) -> np.ndarray:
        """Positions by the next ``longest`` characters, of which several at a time make one number to sort by."""
        alphabet, dense = np.unique(codes, return_inverse=True)
        bits = int(len(alphabet)).bit_length()
        each = 62 // bits
        n = len(codes)
        padded = np.concatenate([dense.astype(np.int64) + 1, np.zeros(self.longest + each, np.int64)])

        def key(positions: np.ndarray, at: int) -> np.ndarray:
            out = np.zeros(len(positions), np.int64)
            for k in range(at, at + each):
                out <<= bits
                if k < self.longest:
                    out |= padded[np.minimum(positions + k, n)]
            return out

        whole = key(np.arange(n), 0)
        order = np.argsort(whole)
        tied = whole[order]
        group = np.cumsum(np.concatenate([[0], tied[1:] != tied[:-1]]))
        for at in range(each, self.longest, each):
            size = np.bincount(group)
            open_ = np.flatnonzero(size[group] > 1)  # only what is still equal is looked at further
            if not len(open_):
                break
            follow = key(order[open_], at)
            inner = np.lexsort((follow, group[open_]))
            order[open_] = order[open_][inner]
            follow = follow[inner]
            step = np.zeros(n, bool)
            step[1:] = group[1:] != group[:-1]
            later = np.flatnonzero(np.diff(follow) != 0) + 1
            step[open_[later]] = True
            group = np.cumsum(step)
        return order

    def edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys (position * SPAN + length), sorted, and the piece of each."""
        order = self.suffixes(codes)
        padded = np.concatenate([codes, np.full(self.longest, -2, np.int64)])
        low = np.zeros(len(self.lengths), np.int64)
        high = np.full(len(self.lengths), len(codes), np.int64)
        for depth in range(self.longest):
            on = np.flatnonzero((self.lengths > depth) & (low < high))
            want = self.codes[on, depth]
            low[on], high[on] = (
                self._bound(padded, order, depth, low[on], high[on], want, after) for after in (False, True)
            )
        counts = np.maximum(high - low, 0)
        piece = np.repeat(np.arange(len(counts)), counts)
        within = np.arange(len(piece)) - np.repeat(np.cumsum(counts) - counts, counts)
        keys = order[np.repeat(low, counts) + within] * SPAN + self.lengths[piece]
        pieces = int(len(counts)).bit_length()
        both = np.sort(keys << pieces | piece)
        return both >> pieces, both & ((1 << pieces) - 1)

    @staticmethod
    def _bound(text, order, depth, low, high, want, after):
        low, high = low.copy(), high.copy()
        while (open_ := low < high).any():
            middle = (low + high) >> 1
            found = text[order[np.minimum(middle, len(order) - 1)] + depth]
            right = open_ & ((found <= want) if after else (found < want))
            low = np.where(right, middle + 1, low)
            high = np.where(open_ & ~right, middle, high)
        return low


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.ids = np.array(vocabulary.ids, np.int64)
        # One number object per id, that all remembered chunks share; the last one says that there is no piece.
        self.shared = np.array([*range(max(vocabulary.ids, default=0) + 1), -1], object)
        self.scores = np.array(vocabulary.scores, np.float64)
        self.matcher = Matcher(vocabulary.pieces)
        if self.matcher.longest >= SPAN:
            raise ValueError("pieces are too long")
        self.byte_ids, self.unknown = vocabulary.byte_ids, vocabulary.unknown
        one_word = not any(SPACE in p.lstrip(SPACE) for p in vocabulary.pieces)
        self.chunk = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+" if one_word else ".+", re.DOTALL)
        # Two generations: what the older one holds moves to the newer when it is used, and the rest is forgotten.
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.held = 0

    def encode(self, texts: list[str]) -> list[list[int]]:
        out, start = [], 0
        while start < len(texts):
            chunked, new, size = [], {}, 0
            while start < len(texts) and size < INDEXED:
                text = texts[start]
                chunks = self.chunk.findall(SPACE + text.replace(" ", SPACE)) if text else []
                for c in set(chunks).difference(self.known):
                    if c in self.older:
                        ids = self.known[c] = self.older[c]
                        self.held += ENTRY + 2 * len(c) + 8 * len(ids)
                    elif c not in new:
                        new[c] = None
                        size += len(c)
                chunked.append(chunks)
                start += 1
            if new:
                self.known.update(zip(new, self.encode_chunks(list(new))))
            of = self.known.__getitem__
            out += [list(chain.from_iterable(map(of, chunks))) for chunks in chunked]
            held = self.held
            for c in new:
                if len(c) > LONGEST_REMEMBERED or held > REMEMBERED:
                    del self.known[c]
                else:
                    held += ENTRY + 2 * len(c) + 8 * len(self.known[c])
            self.held = held
            if self.held > REMEMBERED:
                self.known, self.older, self.held = {}, self.known, 0
        return out

    def encode_chunks(self, chunks: list[str]) -> list[tuple[int, ...]]:
        """The ids of chunks, each a text of its own."""
        lengths = np.array([len(c) for c in chunks], np.int64)
        codes = np.frombuffer("\0".join(chunks).encode("utf-32-le"), np.uint32).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        codes[starts[1:] - 1] = 0x110000  # no character, so no piece reaches over it
        keys, pieces = self.matcher.edges(codes)
        keys = np.append(keys, np.iinfo(np.int64).max)  # so that a search never leaves the table
        pieces = np.append(pieces, 0)
        begin, end = self._relax(keys, pieces, starts, lengths)
        at = np.searchsorted(keys, begin * SPAN + np.minimum(end - begin, SPAN - 1))
        has = keys[at] == begin * SPAN + (end - begin)
        ids = np.where(has, self.ids[pieces[at]], -1)
        owner = np.searchsorted(starts, begin, side="right") - 1
        cuts = np.searchsorted(owner, np.arange(len(chunks) + 1)).tolist()
        flat = self.shared[ids].tolist()
        out = [tuple(flat[a:b]) for a, b in zip(cuts, cuts[1:])]
        for i in set(owner[~has].tolist()):
            symbols = enumerate(out[i], cuts[i])
            out[i] = tuple(x for j, v in symbols for x in ([v] if v >= 0 else self._fallback(codes[begin[j]])))
        return out

    def _fallback(self, code) -> list[int]:
        return [self.byte_ids[b] for b in chr(code).encode()] if self.byte_ids else [self.unknown]

    def _relax(self, keys, pieces, starts, lengths) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of the final symbols, by position."""
        done_begin, done_end = [], []
        for i in np.flatnonzero(lengths > LONG):
            b, e = self._relax_long(keys, pieces, int(starts[i]), int(lengths[i]))
            done_begin.append(b)
            done_end.append(e)
        short = np.flatnonzero((lengths <= LONG) & (lengths > 0))
        owner = np.repeat(short, lengths[short])
        first = np.cumsum(lengths[short]) - lengths[short]
        begin = starts[owner] + np.arange(len(owner)) - np.repeat(first, lengths[short])
        end = begin + 1
        while len(begin):
            pair = np.flatnonzero(owner[1:] == owner[:-1])  # symbol i and the next one
            want = begin[pair] * SPAN + np.minimum(end[pair + 1] - begin[pair], SPAN - 1)
            at = np.searchsorted(keys, want)
            there = keys[at] == want
            pair, score = pair[there], self.scores[pieces[at[there]]]
            if len(pair):  # per chunk the best score, of those the leftmost
                group = np.flatnonzero(np.diff(owner[pair], prepend=-1))
                best = np.maximum.reduceat(score, group)
                pair = pair[score == np.repeat(best, np.diff(group, append=len(pair)))]
                pair = pair[np.flatnonzero(np.diff(owner[pair], prepend=-1))]
            end[pair] = end[pair + 1]
            stay = np.ones(len(begin), bool)
            stay[pair + 1] = False
            # Chunks without a merge are final.
            going = np.zeros(len(starts), bool)
            going[owner[pair]] = True
            final = ~going[owner]
            done_begin.append(begin[final])
            done_end.append(end[final])
            stay &= ~final
            begin, end, owner = begin[stay], end[stay], owner[stay]
        begin = np.concatenate(done_begin) if done_begin else np.zeros(0, np.int64)
        end = np.concatenate(done_end) if done_end else np.zeros(0, np.int64)
        order = np.argsort(begin, kind="stable")
        return begin[order], end[order]

    def _relax_long(self, keys, pieces, start: int, length: int):
        """The same for one chunk of any length: neighbours in a list, candidates in a heap."""
        a, b = np.searchsorted(keys, [start * SPAN, (start + length) * SPAN])
        score = dict(zip(keys[a:b].tolist(), self.scores[pieces[a:b]].tolist()))
        end = list(range(1, length + 1))
        before = list(range(-1, length - 1))
        alive = [True] * length
        heap: list[tuple[float, int, int, int]] = []

        def propose(left: int, right: int) -> None:
            if left >= 0 and right < length and end[right] - left < SPAN:
                s = score.get((start + left) * SPAN + end[right] - left)
                if s is not None:
                    heapq.heappush(heap, (-s, left, right, end[right]))

        for i in range(length - 1):
            propose(i, i + 1)
        while heap:
            _, left, right, stop = heapq.heappop(heap)
            if not (alive[left] and right < length and alive[right] and end[left] == right and end[right] == stop):
                continue
            alive[right] = False
            end[left] = stop
            if stop < length:
                before[stop] = left
            propose(before[left], left)
            propose(left, stop)
        begin = np.array([i for i in range(length) if alive[i]], np.int64)
        return begin + start, np.array([end[i] for i in begin.tolist()], np.int64) + start


class _Bytes(dict):
    def __missing__(self, _: int) -> bytes:
        return b""


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        self.bytes = _Bytes(zip(vocabulary.ids, (p.encode() for p in vocabulary.pieces)))
        self.bytes.update({i: bytes([b]) for b, i in enumerate(vocabulary.byte_ids)})

    def decode(self, ids: list[int]) -> str:
        """Ids that are no piece decode to nothing, bytes that are no character to the replacement character."""
        text = b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text

    def decode_all(self, rows: list[list[int]]) -> list[str]:
        return [*map(self.decode, rows)]


def encode(docs: DataFrame, text: str = "text", to: str = "token_ids", model: str = MODEL) -> DataFrame:
    """All columns plus the ids of a text."""
    return _mapped(docs, text, {to: IDS}, model, lambda v: _listed(Encoder(v).encode))


def decode(docs: DataFrame, ids: str = "token_ids", to: str = "decoded", model: str = MODEL) -> DataFrame:
    """All columns plus the text that ids stand for."""
    return _mapped(docs, ids, {to: TEXT}, model, lambda v: _listed(Decoder(v).decode_all))


def encode_and_decode(
    docs: DataFrame, text: str = "text", to: str = "token_ids", back: str = "decoded", model: str = MODEL
) -> DataFrame:
    """All columns plus the ids of a text and the text they stand for, by one worker where two calls take two."""
    def make(v):
        encoder, decoder = Encoder(v), Decoder(v)

        def both(texts):
            ids = encoder.encode(texts)
            return [ids, decoder.decode_all(ids)]
        return both
    return _mapped(docs, text, {to: IDS, back: TEXT}, model, make)


IDS, TEXT = (ArrayType(IntegerType()), pa.list_(pa.int32())), (StringType(), pa.string())


def _listed(one):
    return lambda values: [one(values)]


def _parts(batch: pa.RecordBatch, place: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``AT_A_TIME`` bytes of the column."""
    column = batch.column(place)
    sizes = pc.binary_length(column) if pa.types.is_string(column.type) else pc.multiply(pc.list_value_length(column), 4)
    upto = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = [0, *(np.flatnonzero(np.diff(upto // AT_A_TIME)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            yield batch.slice(a, b - a)


def _mapped(docs: DataFrame, column: str, to: dict[str, tuple], model: str, make) -> DataFrame:
    # The vocabulary has a fixed size.
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.read(model))
    for name in to:
        if fresh(docs, name) != name:
            raise ValueError(f"column {name} exists already")
    place, kinds = docs.columns.index(column), [arrow for _, arrow in to.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make(shared.value)
        for batch in batches:
            for part in _parts(batch, place):
                values = part.column(place).to_pylist()
                results = [iter(r) for r in work([v for v in values if v is not None])]
                arrays = [pa.array([None if v is None else next(r) for v in values], k) for r, k in zip(results, kinds)]
                yield pa.RecordBatch.from_arrays([*part.columns, *arrays], names=[*part.schema.names, *to])

    schema = StructType([*docs.schema.fields, *(StructField(name, kind) for name, (kind, _) in to.items())])
    return docs.mapInArrow(run, schema)

"""Toxicity by a convolutional text classifier.

A word's embedding is the sum of hashed embeddings of the word and its beginnings. Filters over one, two and three
words are followed by the maximum over the whole text and one dense layer. Embeddings start from the log odds of their
words, counted over all texts that are learnt from.

All labelled texts that are not held out are learnt from, whole. A hash of the id deals three quarters of them to shards
of about ``SHARD`` texts. In each epoch every shard trains the network of the epoch before in a task of its own, and the
shards' parameters are averaged, slice by slice, by their numbers of texts. Both kinds of labels weigh the same. The last
quarter calibrates thresholds by the language that a text's own function words show, and scores are shifted so that each
language's threshold becomes ``THRESHOLD``. What comes to the driver are parameters and counts of score ranges.

A score depends on the text alone. Null and empty texts score like a text of unknown words. Without labels of both
kinds nothing can be learnt, and every score is 0. Repeated ids keep one row each.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, count, groupby, islice, repeat
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from clicklake.llm.common import filled, fresh
from clicklake.sources.files import Scratch

#: Texts that a task learns from between two averages, about.
SHARD = 3000
#: Words of a text that filters pass over at a time while learning.
STRETCH = 20_000
#: Slices that parameters and counts are summed in.
SLICES = 64
#: Score ranges for each unit of a logit, and where they end.
RANGES, FARTHEST = 200, 50
THRESHOLD = 0.3
BUCKETS, DIM, FILTERS, WIDTHS = 1 << 15, 8, 8, (1, 2, 3)
EPOCHS, BATCH, RATE = 4, 32, 0.01
BEGINNINGS = (3, 4, 5, 6)
#: Words that a worker remembers the projections of.
REMEMBERED = 200_000
WORD = re.compile(r"[^\W\d_]+")

# Frequent function words, by language.
FUNCTION_WORDS = {
    "en": "the of and to is that for with this was are from",
    "de": "der die und das ist nicht mit den von ein eine für",
    "fr": "le les et des est une pour dans que qui sur avec",
    "es": "el los y del una por con para las es como más",
}
_VOTES = {w: i for i, ws in enumerate(FUNCTION_WORDS.values()) for w in ws.split()}
OFFSETS = [(w, k) for w in WIDTHS for k in range(w)]


# Latin-1 with spaces for all that no word has, and CRC32's steps from byte to byte.
_LETTERS = bytes(c if WORD.match(chr(c)) else 32 for c in range(256))
_STEPS = np.array([zlib.crc32(bytes([c]), 0xFFFFFFFF) ^ 0xFFFFFFFF for c in range(256)], np.uint32)


def tokens(text: str | None) -> list[str]:
    lower = (text or "").lower()
    try:
        return lower.encode("latin-1").translate(_LETTERS).decode("latin-1").split()
    except UnicodeEncodeError:
        return WORD.findall(lower)


def buckets(word: str) -> list[int]:
    """The word's own bucket and those of its beginnings (0 is no bucket)."""
    parts = [f"={word}"] + [word[:n] for n in BEGINNINGS if len(word) >= n]
    return [1 + zlib.crc32(p.encode()) % (BUCKETS - 1) for p in parts]


def bucket_rows(words: list[str]) -> np.ndarray:
    """The buckets of each word in a row, with 0 for beginnings that it is too short for."""
    rows = np.zeros((len(words), 1 + len(BEGINNINGS)), np.int64)
    encoded = "\n".join(words).encode().split(b"\n")
    rows[:, 0] = 1 + np.fromiter(map(zlib.crc32, encoded, repeat(zlib.crc32(b"="))), np.int64, len(words)) % (BUCKETS - 1)
    sizes, most = np.fromiter(map(len, words), np.int64, len(words)), max(BEGINNINGS)
    codes = np.array(words, f"U{most}").view(np.uint32).reshape(-1, most)
    crc = np.full(len(words), 0xFFFFFFFF, np.uint32)
    for n in range(1, most + 1):
        crc = _STEPS[(crc ^ codes[:, n - 1]) & 255] ^ (crc >> 8)
        if n in BEGINNINGS:
            rows[:, 1 + BEGINNINGS.index(n)] = np.where(sizes >= n, 1 + (~crc).astype(np.int64) % (BUCKETS - 1), 0)
    for i in np.flatnonzero((codes > 127).any(1)):  # letters of several bytes
        own = buckets(words[i])
        rows[i, : len(own)] = own
    return rows


class Network:
    def __init__(self, seed: int = 1):
        r = np.random.default_rng(seed)
        self.p = {
            "embedding": r.normal(0, 0.05, (BUCKETS, DIM)),
            "filters": r.normal(0, 0.3, (len(OFFSETS), DIM, FILTERS)),
            "bias": np.zeros((len(WIDTHS), FILTERS)),
            "dense": r.normal(0, 0.3, len(WIDTHS) * FILTERS),
            "out": np.zeros(1),
        }
        self.p["embedding"][0] = 0
        self.shift: dict[int, float] = {}
    
    def pooled(self, across: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Maxima per text and filter, and where they are. ``across`` has one block of rows per offset, a column a word.

        Texts lie between ``starts`` and ``ends``, with as many empty rows behind each as the widest filter needs.
        """
        best, where, block = [], [], 0
        for width in WIDTHS:
            n = across.shape[1] - max(WIDTHS) + 1
            total = sum(across[(block + k) * FILTERS : (block + k + 1) * FILTERS, k : k + n] for k in range(width))
            block += width
            for a, b in zip(starts, ends):
                i = total[:, a : max(b, a + 1)].argmax(1) + a
                where.append(i)
                best.append(total[np.arange(FILTERS), i])
        shape = (len(WIDTHS), len(starts), FILTERS)
        return np.array(best).reshape(shape), np.array(where).reshape(shape)

    def logits(self, best: np.ndarray):
        active = best + self.p["bias"][:, None]
        hidden = np.maximum(active, 0).transpose(1, 0, 2).reshape(best.shape[1], -1)
        return hidden @ self.p["dense"] + self.p["out"], hidden, active > 0

    def words(self, rows: np.ndarray) -> np.ndarray:
        return sum(self.p["embedding"][column] for column in np.moveaxis(rows, -1, 0))

    def strongest(self, texts: list[np.ndarray]):
        """Maxima per filter and text, and where they are, over stretches of a text; texts end in empty rows."""
        flat = self.p["filters"].transpose(1, 0, 2).reshape(DIM, -1).T.astype(np.float32)
        embedding, best, where = self.p["embedding"].astype(np.float32), [], []
        for rows in texts:
            size, found = len(rows) - max(WIDTHS), []
            for start in range(0, size, STRETCH):
                part = rows[start : start + STRETCH + max(WIDTHS)]
                words = sum(embedding[column] for column in part.T)
                x, at = self.pooled(flat @ words.T, [0], [len(part) - max(WIDTHS)])
                found.append((x[:, 0], at[:, 0] + start))
            x, at = (np.array(v) for v in zip(*found))
            top = x.argmax(0)[None]
            best.append(np.take_along_axis(x, top, 0)[0].astype(float))
            where.append(np.take_along_axis(at, top, 0)[0])
        return np.stack(best, 1), np.stack(where, 1)

    def step(self, texts: list[np.ndarray], y: np.ndarray, weight: np.ndarray, state: dict, t: int) -> None:
        """One step of Adam on the log loss. Gradients reach only the words that won a maximum."""
        p, pad = self.p, np.zeros((max(WIDTHS), texts[0].shape[1]), np.int32)
        texts = [np.concatenate([text, pad]) for text in texts]
        best, where = self.strongest(texts)
        logit, hidden, on = self.logits(best)
        error = (1 / (1 + np.exp(-np.clip(logit, -500, 500))) - y) * weight / len(y)
        grad = {k: np.zeros_like(v) for k, v in p.items() if k != "embedding"}
        grad["dense"], grad["out"] = hidden.T @ error, error.sum(keepdims=True)
        back = (error[:, None] * p["dense"]).reshape(len(y), len(WIDTHS), FILTERS).transpose(1, 0, 2) * on
        grad["bias"] = back.sum(1)
        touched, values = [], []
        for o, (width, k) in enumerate(OFFSETS):
            w = WIDTHS.index(width)
            won = np.stack([text[at + k] for text, at in zip(texts, where[w])])
            grad["filters"][o] = np.einsum("tfd,tf->df", self.words(won), back[w])
            touched.append(won.reshape(-1, pad.shape[1]))
            values.append((back[w][:, :, None] * p["filters"][o].T[None]).reshape(-1, DIM))
        ids, inverse = np.unique(np.concatenate(touched), return_inverse=True)
        spread = np.repeat(np.concatenate(values), pad.shape[1], 0)
        g = np.stack([np.bincount(inverse.ravel(), own, len(ids)) for own in spread.T], 1)
        for k, d, place in [(k, v, slice(None)) for k, v in grad.items()] + [("embedding", g, ids)]:
            m, v = state.setdefault(k, (np.zeros_like(p[k]), np.zeros_like(p[k])))
            m[place] = 0.9 * m[place] + 0.1 * d
            v[place] = 0.999 * v[place] + 0.001 * d * d
            p[k][place] -= RATE * (m[place] / (1 - 0.9**t)) / (np.sqrt(v[place] / (1 - 0.999**t)) + 1e-8)
        p["embedding"][0] = 0

    def start(self, seen: np.ndarray) -> None:
        """Where words start: log odds of their buckets, in the first place of the embedding and of the first filter."""
        seen = seen + 1.0
        odds = np.log(seen[1] / seen[1, 0]) - np.log(seen[0] / seen[0, 0])
        self.p["embedding"][:, 0] = np.clip(odds, -3, 3) / (1 + len(BEGINNINGS))
        self.p["embedding"][0] = 0
        self.p["filters"][0, 0, 0], self.p["dense"][0] = 1.0, 1.0

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.p.values()])

    def filled(self, flat: np.ndarray) -> Network:
        """A network with these parameters."""
        other, at = Network(), 0
        for name, value in other.p.items():
            other.p[name] = flat[at : at + value.size].reshape(value.shape).copy()
            at += value.size
        return other

    def calibrate(self, ranges: list) -> None:
        """Per language the threshold of the best F1, of rows (language, low, high, toxic, clean) of score ranges."""
        def best(own: list) -> float:
            found = false = 0
            hits, top = sum(r["toxic"] for r in own), (-1.0, 0.0)
            order = sorted(own, key=lambda r: -r["low"])
            for r, after in zip(order, [*order[1:], order[-1]]):
                found, false = found + r["toxic"], false + r["clean"]
                border = (r["low"] + (after["high"] if after is not r else r["low"])) / 2
                top = max(top, (2 * found / (found + false + hits), border), key=lambda x: x[0])
            return top[1]
        everywhere: dict[int, dict] = {}
        for r in ranges:
            e = everywhere.setdefault(r["range"], {"low": r["low"], "high": r["high"], "toxic": 0, "clean": 0})
            e.update(low=min(e["low"], r["low"]), high=max(e["high"], r["high"]), toxic=e["toxic"] + r["toxic"], clean=e["clean"] + r["clean"])
        general = best(list(everywhere.values()))
        for code in range(len(FUNCTION_WORDS) + 1):
            own = [r for r in ranges if r["language"] == code]
            toxic, clean = sum(r["toxic"] for r in own), sum(r["clean"] for r in own)
            self.shift[code] = best(own) if toxic + clean >= 40 and toxic >= 20 and clean else general


class Reader:
    """Buckets of the words of texts; remembers those of each word."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.known = numbered()
        self.table = np.zeros((1024, 1 + len(BEGINNINGS)), np.int32)

    def rows(self, text: str | None) -> np.ndarray:
        """One row a word; one row of nothing for an empty text."""
        return self.each([text])[0]

    def each(self, texts: list[str | None]) -> list[np.ndarray]:
        """The rows of each of some texts."""
        part = [tokens(text) for text in texts]
        if len(self.known) > REMEMBERED:
            self.clear()
        ends = np.cumsum([len(words) for words in part])
        at, new = places(self.known, chain.from_iterable(part), int(ends[-1]))
        if new:
            start = len(self.known) - len(new) + 1
            self.table = roomy(self.table, start + len(new))
            self.table[start : start + len(new)] = bucket_rows(new)
        return [self.table[own if len(own) else [0]] for own in np.split(at, ends[:-1])]


def numbered() -> defaultdict[str, int]:
    """Words by numbers from 1, given as they come."""
    return defaultdict(count(1).__next__)


def places(known: defaultdict[str, int], words: Iterable[str], size: int) -> tuple[np.ndarray, list[str]]:
    """The numbers of so many words, and those that are new, in the order of their numbers."""
    before = len(known)
    at = np.fromiter(map(known.__getitem__, words), np.int64, size)
    return at, list(islice(reversed(known), len(known) - before))[::-1]


def roomy(table: np.ndarray, rows: int) -> np.ndarray:
    """The table, longer if it has fewer rows."""
    while rows > len(table):
        table = np.concatenate([table, np.zeros_like(table)])
    return table


class Scorer:
    """Scores texts; remembers what filters make of each word."""

    def __init__(self, network: Network):
        self.network = network
        self.flat = network.p["filters"].transpose(1, 0, 2).reshape(DIM, -1).astype(np.float32)
        self.embedding = network.p["embedding"].astype(np.float32)
        self.clear()

    def clear(self) -> None:
        self.known = numbered()
        votes = len(FUNCTION_WORDS)
        self.table = np.zeros((1024, self.flat.shape[1] + votes), np.float32)

    def learn(self, new: list[str]) -> None:
        """Fill in the words that were numbered last."""
        start = len(self.known) - len(new) + 1  # row 0 is no word
        self.table = roomy(self.table, start + len(new))
        self.table[start : start + len(new), : self.flat.shape[1]] = self.embedding[bucket_rows(new)].sum(1) @ self.flat
        for i, w in enumerate(new):
            if w in _VOTES:
                self.table[start + i, self.flat.shape[1] + _VOTES[w]] = 1

    def raw(self, texts: list[str | None], most: int = 60_000) -> tuple[np.ndarray, np.ndarray]:
        """Logits and languages, some tens of thousands of words at a time."""
        logits, languages, i = [], [], 0
        while i < len(texts):
            part, size = [], 0
            while i < len(texts) and (size < most or not part):
                part.append(tokens(texts[i]))
                size += len(part[-1])
                i += 1
            if len(self.known) > REMEMBERED:
                self.clear()
            a, b = self._part(part, size)
            logits.append(a)
            languages.append(b)
        return np.concatenate(logits or [np.zeros(0)]), np.concatenate(languages or [np.zeros(0, int)])

    def _part(self, part: list[list[str]], size: int) -> tuple[np.ndarray, np.ndarray]:
        width, pad = self.flat.shape[1], max(WIDTHS)
        at, new = places(self.known, chain.from_iterable(part), size)
        if new:
            self.learn(new)
        sizes = np.fromiter(map(len, part), np.int64, len(part))
        text = np.arange(len(part))
        ends = np.cumsum(sizes) + pad * text
        starts = ends - sizes
        rows = np.zeros(size + pad * len(part), np.int64)
        rows[np.arange(size) + np.repeat(pad * text, sizes)] = at
        projected = self.table[rows]
        best, _ = self.network.pooled(np.ascontiguousarray(projected[:, :width].T), starts, ends)
        votes = np.array([projected[a:b, width:].sum(0) for a, b in zip(starts, ends)])
        language = np.where(votes.max(1) > 0, votes.argmax(1), len(FUNCTION_WORDS))
        return self.network.logits(best)[0], language

    def scores(self, texts: list[str | None]) -> np.ndarray:
        logit, language = self.raw(texts)
        shift = np.array([self.network.shift[c] for c in range(len(FUNCTION_WORDS) + 1)])
        at = np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(logit - shift[language] + at, -30, 30)))


def held_out(key: Column) -> Column:
    """Whether a row's label is kept from training."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4)) == 2


def trained(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Network | None:
    """A network from the labelled documents that are not held out; None without labels of both kinds."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~F.coalesce(held_out(F.col(key)), F.lit(False)))
    known = known.groupBy(F.col(key).alias("key")).agg((F.max(label) > 0).cast("int").alias("label"))
    wanted = docs.select(F.col(key).alias("key"), filled(F.col(text)).alias("text")).join(known, "key")
    checked = F.pmod(F.xxhash64("key", F.lit(7)), F.lit(4)) == 0
    scratch = Scratch(docs.sparkSession)
    one = scratch.settled(wanted.groupBy("key", "label").agg(F.min("text").alias("text")).withColumn("checked", checked))
    counts = {(r["checked"], r["label"]): r["count"] for r in one.groupBy("checked", "label").count().collect()}
    if len(counts) < 4:
        scratch.drop(one)
        return None
    size = counts[False, 0] + counts[False, 1]
    weight = np.array([size / (2 * counts[False, 0]), size / (2 * counts[False, 1])])
    # Rows of a shard come together and in the order of a hash, so that a rerun learns the same.
    shards = math.ceil(size / SHARD)
    dealt = one.where(~F.col("checked")).withColumn("shard", F.pmod(F.xxhash64("key", F.lit(5)), F.lit(shards)).cast("int"))
    dealt = dealt.repartitionByRange(shards, "shard").sortWithinPartitions("shard", F.xxhash64("key", F.lit(11)), "key")
    dealt = dealt.select("shard", "text", "label").persist(StorageLevel.DISK_ONLY)
    network = Network()
    network.start(_summed(dealt, _counted, 2 * BUCKETS).reshape(2, BUCKETS))
    for _ in range(EPOCHS):
        shared = docs.sparkSession.sparkContext.broadcast(network)
        total = _summed(dealt, lambda rows: _learnt(rows, shared.value, weight), len(network.flat()) + 1)
        network = network.filled(total[:-1] / total[-1])
        shared.unpersist()
    dealt.unpersist()
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            logit, language = scorer.raw(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(logit), pa.array(language, pa.int32()), batch.column(1)], names=["logit", "language", "label"])

    judgements = one.where("checked").select("text", "label").mapInArrow(judged, "logit double, language int, label int")
    place = F.floor(F.greatest(F.least("logit", F.lit(FARTHEST)), F.lit(-FARTHEST)) * RANGES).cast("int")
    network.calibrate(judgements.groupBy("language", place.alias("range")).agg(
        F.min("logit").alias("low"), F.max("logit").alias("high"), F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"),
    ).collect())
    scratch.drop(one)
    return network


def _counted(rows: Iterator[tuple[str, int]]) -> np.ndarray:
    """Texts of each kind that have a bucket."""
    seen, reader = np.zeros((2, BUCKETS)), Reader()
    while part := list(islice(rows, BATCH)):
        for own, (_, label) in zip(reader.each([text for text, _ in part]), part):
            there = np.zeros(BUCKETS, bool)
            there[own], there[0] = True, True
            seen[label] += there
    return seen.ravel()


def _learnt(rows: Iterator[tuple[str, int]], network: Network, weight: np.ndarray) -> np.ndarray:
    """The parameters that a shard makes of the network's, times its number of texts, and that number."""
    own, reader, state, t, n = network.filled(network.flat()), Reader(), {}, 0, 0
    while part := list(islice(rows, BATCH)):
        t, n = t + 1, n + len(part)
        labels = np.array([label for _, label in part])
        own.step(reader.each([text for text, _ in part]), labels.astype(float), weight[labels], state, t)
    return np.append(own.flat() * n, float(n))


def _summed(dealt: DataFrame, work: Callable[[Iterator[tuple[str, int]]], np.ndarray], size: int) -> np.ndarray:
    """Sum over all shards of the numbers that ``work`` makes of a shard; slices of them are summed in tasks of their own."""
    cuts = [size * i // SLICES for i in range(SLICES + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (batch.slice(i, BATCH) for batch in batches for i in range(0, batch.num_rows, BATCH))
        rows = (row for part in parts for row in zip(*[c.to_pylist() for c in part.columns]))
        for shard, own in groupby(rows, key=itemgetter(0)):
            numbers = work((text, label) for _, text, label in own)
            slices = [numbers[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard] * SLICES, pa.int32()), "slice": pa.array(range(SLICES), pa.int32()), "numbers": pa.array(slices, pa.binary())})

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for numbers in batch.column(2).to_pylist():
                part = np.frombuffer(numbers)
                total = part if total is None else total + part
        yield pa.RecordBatch.from_pydict({"slice": pa.array([key[0].as_py()], pa.int32()), "numbers": pa.array([total.tobytes()], pa.binary())})

    parts = dealt.mapInArrow(run, "shard int, slice int, numbers binary")
    found = parts.groupBy("slice").applyInArrow(add, "slice int, numbers binary").collect()
    return np.concatenate([np.frombuffer(r["numbers"]) for r in sorted(found, key=itemgetter(0))])


def scored(docs: DataFrame, network: Network | None, text: str = "text", to: str = "score") -> DataFrame:
    """All columns plus the score of the text."""
    if network is None:
        return docs.withColumn(to, F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(network)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for batch in batches:
            scorer = scorer or Scorer(shared.value)
            result = pa.array(scorer.scores(batch.column(place).to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, result], names=[*batch.schema.names, to])

    return docs.mapInArrow(run, docs.withColumn(to, F.lit(0.0)).schema)


def keep(docs: DataFrame, network: Network | None, text: str = "text") -> DataFrame:
    """The rows that are not predicted toxic, with their own columns."""
    to = fresh(docs, "__toxicity")
    return scored(docs, network, text, to).where(F.col(to) < THRESHOLD).drop(to)

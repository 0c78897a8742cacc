"""Words of documents that lie in windows which a document with a smaller id has as well.

Level-wise doubling. What is asked is which windows of ``window`` words start in an earlier document too. At each level
every window that is still open is stood for by a shorter one inside it, of the level's length: the one of the least
hash, its anchor. Equal windows have equal anchors. Neighbouring open windows with one anchor form a run, and a run is
one row. Then, by anchor:

* a run that an earlier document has word for word is settled, all its windows are repeated;
* a run of an anchor that occurs with these words only is settled too, none of its windows is repeated;
* of an anchor that occurs with other words around it, it is open where the common part ends, so the windows of such
  runs, of the earliest document that has each, go on to twice the length.

At the full length a window is its own anchor, so nothing can stay open. A window goes on only while its anchor is
repeated, and the earliest document that has a window is never settled before the others, so no repeat is lost.

Before rows are shuffled, each task compares the runs of some hundred documents among themselves and sends on only those
of the earliest one: a passage that a third of all documents share costs one row per such chunk, not per document.
Runs are compared by two 64-bit hashes of independent kinds, over 64-bit hashes of words.

Null texts have no words. Rows with a null id are kept whole and are no earlier document to others; rows of one id are
not earlier than each other, whatever their texts are, and equal rows get equal results. Texts with fewer words than a
window stay as they are. Other columns are carried along. Words are parted by ASCII space and are otherwise compared
as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from clicklake.llm.common import fresh
from clicklake.sources.files import settled

WINDOW, FIRST = 13, 7
#: Words whose runs are compared before anything is sent on; a single longer text is looked at whole.
CHUNK_WORDS = 500_000
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)

_RUNS = "anchor long, run long, id long, tag long, lo int, n int, settled boolean"
_RUN_KINDS = pa.schema([
    ("anchor", pa.int64()), ("run", pa.int64()), ("id", pa.int64()), ("tag", pa.int64()), ("lo", pa.int32()), ("n", pa.int32()),
    ("settled", pa.bool_()),
])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def rolled(hashes: np.ndarray, length: int, base: int) -> np.ndarray:
    """A hash of each ``length`` neighbours, put together from halves."""
    if len(hashes) < length:
        return np.zeros(0, np.uint64)
    if length == 1:
        return hashes
    half = length // 2
    own = rolled(hashes, half, base)
    out = own[:-half] * np.uint64(pow(base, half, 1 << 64)) + own[half:]
    return out[:-1] * np.uint64(base) + hashes[length - 1 :] if length % 2 else out


def least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def runs(texts: list[list[bytes]], open_: list[list[tuple[int, int]] | None], length: int, window: int):
    """(anchor, run, text number, first window, windows) of the open windows; None means that all are."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    total = int(sizes.sum())
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for t in texts for w in t), np.uint64, total)
    whole = rolled(_mixed(hashes + np.uint64(1)), window, _BASES[1])
    anchors = least(_mixed(rolled(hashes, length, _BASES[0])), window - length + 1) if len(whole) else whole
    # Where windows may start: by +1 and -1 at the bounds of what is open.
    steps = np.zeros(total + 1, np.int64)
    for start, size, own in zip(starts.tolist(), sizes.tolist(), open_):
        for lo, n in [(0, size - window + 1)] if own is None else own:
            if n > 0:
                steps[start + lo] += 1
                steps[start + lo + n] -= 1
    at = np.flatnonzero(np.cumsum(steps)[: len(whole)] > 0)
    if not len(at):
        empty = np.zeros(0, np.int64)
        return empty.view(np.uint64), empty.view(np.uint64), empty, empty, empty
    owner = np.searchsorted(starts, at, side="right") - 1
    own_anchor = anchors[at]
    begins = np.ones(len(at), bool)
    begins[1:] = (np.diff(at) != 1) | (own_anchor[1:] != own_anchor[:-1]) | (np.diff(owner) != 0)
    first = np.flatnonzero(begins)
    within = np.arange(len(at)) - np.repeat(first, np.diff(first, append=len(at)))
    first = np.flatnonzero(within % (window - length + 1) == 0)  # so the first and the last window tell all words
    n = np.diff(first, append=len(at))
    lo = at[first]
    run = _mixed(_mixed(whole[lo]) + whole[lo + n - 1] * np.uint64(_BASES[0]) + n.astype(np.uint64))
    return own_anchor[first], run, owner[first], lo - starts[owner[first]], n


def _earliest(anchor, run, ids) -> np.ndarray:
    """Of each row, whether no other row of its anchor and run has a smaller id."""
    order = np.lexsort((ids, run, anchor))
    new = np.ones(len(order), bool)
    new[1:] = (anchor[order][1:] != anchor[order][:-1]) | (run[order][1:] != run[order][:-1])
    smallest = ids[order][np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    out = np.empty(len(order), bool)
    out[order] = ids[order] == smallest
    return out


def _joined(owner, lo, n):
    """Runs of one text that follow each other, as one."""
    begins = np.ones(len(lo), bool)
    begins[1:] = (owner[1:] != owner[:-1]) | (lo[1:] != lo[:-1] + n[:-1])
    first = np.flatnonzero(begins)
    return owner[first], lo[first], np.add.reduceat(n, first) if len(first) else n


def indexed(rows: DataFrame, length: int, window: int, id_: str, tag: str, text: str, open_: str | None = None) -> DataFrame:
    """Runs of documents: those to compare, and those that a chunk has settled as repeated.

    ``open_`` names the spans of windows to look at, of no window where it is null.
    """
    places = [rows.columns.index(c) for c in (id_, tag, text, *([open_] if open_ else []))]

    def of_chunk(ids, tags, texts, open_) -> Iterator[pa.RecordBatch]:
        anchor, run, owner, lo, n = runs(texts, open_, length, window)
        ids, tags = np.array(ids, np.int64), np.array(tags, np.int64)
        early = _earliest(anchor, run, ids[owner])
        done, done_lo, done_n = _joined(owner[~early], lo[~early], n[~early])
        spread = _mixed(tags[done].view(np.uint64) + done_lo.astype(np.uint64))  # goes along, compared with nothing
        columns = (
            np.concatenate([anchor[early], spread]).view(np.int64),
            np.concatenate([run[early].view(np.int64), np.zeros(len(done), np.int64)]),
            ids[np.concatenate([owner[early], done])], tags[np.concatenate([owner[early], done])],
            np.concatenate([lo[early], done_lo]), np.concatenate([n[early], done_n]),
            np.arange(int(early.sum()) + len(done)) >= early.sum(),
        )
        arrays = [pa.array(c, k.type) if k.name not in ("lo", "n") else pa.array(c.astype(np.int32)) for c, k in zip(columns, _RUN_KINDS)]
        whole = pa.RecordBatch.from_arrays(arrays, schema=_RUN_KINDS)
        for i in range(0, whole.num_rows, 50_000):
            yield whole.slice(i, 50_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, ...] = ([], [], [], [])
        size = 0
        for batch in batches:
            for i in range(0, batch.num_rows, 100):
                part = batch.slice(i, 100)
                for own, mark, value, *spans in zip(*[part.column(p).to_pylist() for p in places]):
                    if own is None or value is None or (spans and spans[0] is None):
                        continue
                    words = value.encode().split()
                    if len(words) < window:
                        continue
                    for column, x in zip(held, (own, mark, words, [(o["lo"], o["n"]) for o in spans[0]] if spans else None)):
                        column.append(x)
                    size += len(words)
                if size >= CHUNK_WORDS:
                    yield from of_chunk(*held)
                    held, size = ([], [], [], []), 0
        if size:
            yield from of_chunk(*held)

    return rows.mapInArrow(run, _RUNS)


def decided(indexed_runs: DataFrame) -> DataFrame:
    """(id, tag, lo, n, repeated) of the runs that are repeated or go on; the others are settled and left out."""
    open_ = ~F.col("settled")
    same, alike = Window.partitionBy("anchor", "run"), Window.partitionBy("anchor")
    # Dealt by anchor at once: that and one sort serve both windows.
    seen = indexed_runs.repartition("anchor").withColumn("earliest", F.min(F.when(open_, F.col("id"))).over(same)).withColumns({
        "low": F.min(F.when(open_, F.col("run"))).over(alike), "high": F.max(F.when(open_, F.col("run"))).over(alike),
    })
    repeated = F.col("settled") | (F.col("id") > F.col("earliest"))
    return seen.where(repeated | (F.col("low") < F.col("high"))).select("id", "tag", "lo", "n", repeated.alias("repeated"))


def told_apart(docs: DataFrame, key: str, text: str) -> Column:
    """What differs between rows of one id: a hash of the text, or, where all ids differ, nothing."""
    repeated = docs.groupBy(F.col(key).cast("long").alias("id")).count().where("count > 1 AND id IS NOT NULL")
    return F.lit(0).cast("long") if repeated.isEmpty() else F.xxhash64(text)


def repeated_windows(docs: DataFrame, id_: str, tag: str, text: str, window: int = WINDOW, first: int = FIRST) -> DataFrame:
    """(id, tag, spans) of the documents that have repeated windows: spans (lo, n) of window starts, unordered.

    ``tag`` tells rows of one id apart. The last level is left to the query that asks for it: both join all columns of
    the documents by id, so that one shuffle of them serves both.
    """
    gathered = lambda df, to: df.groupBy("id", "tag").agg(F.collect_set(F.struct("lo", "n")).alias(to))
    length = min(first, window)
    index, found = indexed(docs.select(id_, tag, text), length, window, id_, tag, text), []
    while True:
        last = length == window
        runs_ = decided(index) if last else settled(decided(index))
        found.append(runs_.where("repeated").drop("repeated"))
        if last:
            break
        waiting = runs_.where("NOT repeated").drop("repeated")
        if waiting.isEmpty():
            break
        open_ = fresh(docs, "__open")
        again = docs.join(gathered(waiting, open_).withColumnsRenamed({"id": id_, "tag": tag}), [id_, tag], "left")
        length = min(2 * length, window)
        index = indexed(again.select(*docs.columns, open_), length, window, id_, tag, text, open_)
    return gathered(reduce(DataFrame.union, found), "spans")


def cut(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, first: int = FIRST,
    to: str = "kept_text", n_words: str = "n_words", n_removed: str = "n_removed",
) -> DataFrame:
    """All columns plus the text without repeated words, joined by single spaces, and the numbers of words and of removed ones."""
    for name in (to, n_words, n_removed):
        if fresh(docs, name) != name:
            raise ValueError(f"column {name} exists already")
    id_, tag, spans, apart = fresh(docs, "__id"), fresh(docs, "__tag"), fresh(docs, "__spans"), told_apart(docs, key, text)
    left = docs.withColumns({id_: F.col(key).cast("long"), tag: apart})
    known = repeated_windows(left, id_, tag, text, window, first).toDF(id_, tag, spans)
    both = left.join(known, [id_, tag], "left").select(*docs.columns, spans)
    place = docs.columns.index(text)

    def kept(value: str | None, spans_) -> tuple[str, int, int]:
        words = (value or "").encode().split()
        if not spans_:
            return b" ".join(words).decode(), len(words), 0
        steps = np.zeros(len(words) + 1, np.int64)
        for s in spans_:
            steps[s["lo"]] += 1
            steps[s["lo"] + s["n"] + window - 1] -= 1
        stay = np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()
        return b" ".join([words[i] for i in stay]).decode(), len(words), len(words) - len(stay)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                rows = [kept(*row) for row in zip(part.column(place).to_pylist(), part.column(len(part.columns) - 1).to_pylist())]
                arrays = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *arrays], names=[*part.schema.names[:-1], to, n_words, n_removed])

    added = [StructField(to, StringType()), StructField(n_words, LongType()), StructField(n_removed, LongType())]
    return both.mapInArrow(run, StructType([*docs.schema.fields, *added]))

"""Which terms set the sources of a language apart, and how far apart any two of its sources are.

In-mapper stripes: every task folds whole documents into hash stripes, term -> (documents, source -> occurrences), and
spills them as rows once they hold ``SPILL_CELLS`` cells. The spilled stripes meet by (language, term) in sorted order,
so that merging holds one term at a time and a term costs one row per spill, however frequent it is. Merged stripes of
terms in too few documents go. The others are dealt into buckets of about ``BUCKET_CELLS`` cells; each bucket meets the
totals of its language's groups and turns its stripes into divergences: a row of sums to all other groups for each
group, and its own best terms. Sums are added up and best terms ranked afterwards.

All arithmetic is on integers: a group's share of a term is ``p = 1 + floor(10**9 * (count + 1) / (N + V))`` with N its
occurrences and V the terms of its language, and a divergence ``floor((p - q)**2 / q)``. It is exact below 9e15
occurrences of a language.

Null texts, languages and sources are read as ''. Rows are not told apart by id: repeated rows count each time. A group
without terms is compared like any other; where a language has no terms, all its pairs have the value 0. No documents
give no rows. Other columns are ignored. Equal values are ranked by item, in the order of UTF-8 bytes.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from clicklake.llm.common import filled
from clicklake.sources.files import settled

MIN_DOCS, TOP, SCALE = 3, 200, 1_000_000_000
#: Cells (term, source) that a task folds before it spills them, and texts it looks at between.
SPILL_CELLS, AT_A_TIME = 400_000, 200
#: Cells that one task turns into divergences at a time, and numbers in its tables.
BUCKET_CELLS, TABLE = 400_000, 1_000_000
#: ASCII letters, lower-cased, and all bytes of other characters; everything else parts terms.
_TERMS = bytes(b if chr(b).isalpha() or b >= 128 else 32 for b in range(256)).lower()

STRIPE = "lang string, term string, docs long, sources array<string>, counts array<long>"
_STRIPE = pa.schema([
    ("lang", pa.string()), ("term", pa.string()), ("docs", pa.int64()),
    ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())),
])
_PART = pa.schema([
    ("lang", pa.string()), ("source", pa.string()), ("part", pa.string()),
    ("items", pa.list_(pa.string())), ("values", pa.list_(pa.int64())),
])


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and of characters beyond ASCII, in UTF-8; only A to Z are lower-cased."""
    return text.translate(_TERMS).split()


class Stripes:
    """term -> (documents, source -> occurrences) of each language, a table for each of the numbers."""

    def __init__(self) -> None:
        self.docs: dict[str, Counter] = defaultdict(Counter)
        self.counts: dict[tuple[str, str], Counter] = defaultdict(Counter)

    def fold(self, lang: str, source: str, text: bytes) -> None:
        own = terms(text)
        self.counts[lang, source].update(own)
        self.docs[lang].update(set(own))

    def cells(self) -> int:
        return sum(map(len, self.counts.values()))

    def spill(self) -> Iterator[pa.RecordBatch]:
        for lang, docs in self.docs.items():
            sources = {term: [] for term in docs}
            counts = {term: [] for term in docs}
            for (of, source), own in self.counts.items():
                if of == lang:
                    for term, n in own.items():
                        sources[term].append(source)
                        counts[term].append(n)
            names = list(docs)
            for i in range(0, len(names), 20_000):
                part = names[i : i + 20_000]
                columns = [[lang] * len(part), [t.decode() for t in part], [docs[t] for t in part], [sources[t] for t in part], [counts[t] for t in part]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _STRIPE)], schema=_STRIPE)
        self.__init__()


def stripes(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """The stripes that tasks spill: a term has one row per spill."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Stripes()
        for batch in batches:
            for i in range(0, batch.num_rows, AT_A_TIME):
                for row in zip(*[c.to_pylist() for c in batch.slice(i, AT_A_TIME).columns]):
                    held.fold(*row)
                if held.cells() >= SPILL_CELLS:
                    yield from held.spill()
        yield from held.spill()

    rows = docs.select(filled(F.col(lang)).alias("lang"), filled(F.col(source)).alias("source"), filled(F.col(text)).cast("binary").alias("text"))
    return rows.mapInArrow(run, STRIPE)


def _changes(column: pa.Array) -> np.ndarray:
    return pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)


def _added(rows: pa.RecordBatch) -> pa.RecordBatch:
    """One stripe per language and term of rows that are sorted by them."""
    starts = np.ones(rows.num_rows, bool)
    starts[1:] = _changes(rows["lang"]) | _changes(rows["term"])
    first = np.flatnonzero(starts)
    owner = (np.cumsum(starts) - 1)[pc.list_parent_indices(rows["sources"]).to_numpy()]
    names = pc.list_flatten(rows["sources"]).dictionary_encode()
    cell = owner * max(1, len(names.dictionary)) + names.indices.to_numpy()
    order = np.argsort(cell, kind="stable")
    cell, counts = cell[order], pc.list_flatten(rows["counts"]).to_numpy()[order]
    begins = np.ones(len(cell), bool)
    begins[1:] = cell[1:] != cell[:-1]
    at = np.flatnonzero(begins)
    ends = np.concatenate([[0], np.cumsum(np.bincount(cell[at] // max(1, len(names.dictionary)), minlength=len(first)))]).astype(np.int32)
    lists = lambda values: pa.ListArray.from_arrays(pa.array(ends), values)
    return pa.RecordBatch.from_arrays([
        rows["lang"].take(pa.array(first)), rows["term"].take(pa.array(first)), pa.array(np.add.reduceat(rows["docs"].to_numpy(), first)),
        lists(names.dictionary.take(pa.array(cell[at] % max(1, len(names.dictionary))))), lists(pa.array(np.add.reduceat(counts, at))),
    ], schema=_STRIPE)


def merged(spilled: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """One stripe per language and term that has enough documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the stripe that may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(batch.columns, _STRIPE)], schema=_STRIPE)
            whole = batch if last is None else pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
            whole = _added(whole)
            last = whole.slice(whole.num_rows - 1)
            yield whole.slice(0, whole.num_rows - 1).filter(pc.greater_equal(whole["docs"][:-1], min_docs))
        if last is not None:
            yield last.filter(pc.greater_equal(last["docs"], min_docs))

    return spilled.repartition("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(run, STRIPE)


def shares(counts: np.ndarray, whole: np.ndarray | int) -> np.ndarray:
    """``1 + floor(SCALE * (counts + 1) / whole)`` without a product that leaves 64 bits."""
    left, out = counts + 1, 0
    for _ in range(3):
        left = left * 1000
        out, left = out * 1000 + left // whole, left % whole
    return out + 1


def _emitted(key, own: pa.Table, groups: pa.Table, top: int) -> pa.Table:
    """Divergences of one bucket's terms: sums to the other groups of the language, and the best terms of each group."""
    if not own.num_rows:
        return _PART.empty_table()
    lang, names = key[0].as_py(), groups["source"].to_pylist()
    n, n_terms = groups["n"].to_numpy().astype(np.int64), groups["n_terms"][0].as_py()
    place = {s: i for i, s in enumerate(names)}
    spelled, stripes_ = own["term"].to_pylist(), list(zip(own["sources"].to_pylist(), own["counts"].to_pylist()))
    sums = np.zeros((len(names), len(names)), np.int64)
    best: list[list[tuple[int, bytes]]] = [[] for _ in names]
    step = max(1, TABLE // len(names))
    for start in range(0, len(spelled), step):
        part = stripes_[start : start + step]
        counts = np.zeros((len(names), len(part)), np.int64)
        for j, (sources, values) in enumerate(part):
            counts[[place[s] for s in sources], j] = values
        p = shares(counts, (n + n_terms)[:, None])
        for i in range(len(names)):
            sums[i] += ((p[i] - p) ** 2 // p).sum(1)
        q = shares(counts.sum(0), int(n.sum()) + n_terms)
        for i in range(len(names)):
            on = np.flatnonzero((counts[i] > 0) & (p[i] > q))
            value = (p[i, on] - q[on]) ** 2 // q[on]
            if len(on) > top:  # all that are as good as the last one, so that ties are settled below
                enough = value >= np.partition(value, -top)[-top]
                on, value = on[enough], value[enough]
            best[i] += [(-v, spelled[start + j].encode()) for v, j in zip(value.tolist(), on.tolist())]
            best[i] = sorted(best[i])[:top]
    rows = []
    for i, name in enumerate(names):
        others = [j for j in range(len(names)) if j != i]
        rows.append((lang, name, "pair", [names[j] for j in others], sums[i, others].tolist()))
        rows.append((lang, name, "term", [t.decode() for _, t in best[i]], [-v for v, _ in best[i]]))
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PART)], schema=_PART)


def divergences(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS, top: int = TOP
) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` to each other source, part ``term`` the best ``top`` terms."""
    kept = settled(merged(stripes(docs, lang, source, text), min_docs))
    cells = kept.agg(F.coalesce(F.sum(F.size("sources")), F.lit(0))).first()[0]
    buckets = 1 + cells // BUCKET_CELLS
    occurring = docs.select(filled(F.col(lang)).alias("lang"), filled(F.col(source)).alias("source")).distinct()
    each = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("c"))
    totals = each.groupBy("lang", F.col("c.sources").alias("source")).agg(F.sum("c.counts").alias("n"))
    sizes = kept.groupBy("lang").agg(F.count("*").alias("n_terms"))
    groups = settled(
        occurring.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").na.fill(0, ["n", "n_terms"])
    )
    bucket = F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int")
    dealt = kept.withColumn("bucket", bucket).groupBy("lang", "bucket")
    known = groups.where("n_terms > 0").withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)).cast("array<int>")))

    def run(key, own: pa.Table, totals: pa.Table) -> pa.Table:
        return _emitted(key, own, totals, top)

    parts = dealt.cogroup(known.groupBy("lang", "bucket")).applyInArrow(
        run, "lang string, source string, part string, items array<string>, values array<long>"
    )
    spread = parts.select("lang", "source", "part", F.explode(F.arrays_zip("items", "values")).alias("c"))
    added = spread.groupBy("lang", "source", "part", F.col("c.items").alias("item")).agg(F.sum("c.values").alias("value"))
    # Languages without terms have no stripes that could say so.
    bare = groups.where("n_terms = 0").select("lang", "source")
    nothing = bare.join(bare.withColumnRenamed("source", "item"), "lang").where("source <> item").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("long").alias("value")
    )
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = added.union(nothing).withColumn("rank", F.row_number().over(order))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= top))

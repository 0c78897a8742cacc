"""Exact Jaccard self-join of documents on word shingles, and the groups that its links form.

Universe partitioning: sizes of sets fall into bands, and a band cuts the universe of tokens into segments by a hash.
Two sets of sizes r <= s with a similarity of at least 3/4 differ in at most ``(r + s) / 7`` tokens, so of any so many
segments plus one, at least one is equal in both. Every set is indexed with the signatures of all segments of its own
band. As the larger set of a pair it probes its own band and the one below, with only as many segments as that bound
asks for: the cheapest ones by how frequent their rarest token is. In bands of small sets, where that leaves little
choice, signatures of segments less one token are indexed as well; a probe may then count a segment twice, by also
probing with its own one-deletion neighbours, instead of using a costlier segment. All candidates are verified exactly.

Only groups are asked for, so not every pair of a signature's documents is looked at: each document is first compared
with the smallest id of its signature, and then only documents whose groups still differ are compared. Of the latter,
pairs are skipped whose sketches differ in more bits than the bound allows tokens: a bit tells whether an odd number of
a set's tokens hash to it, so that each token in just one of two sets changes one bit at most. Documents with equal sets
are one class. No step loses a link that would change a group.

How frequent tokens are is estimated from about ``SAMPLE`` documents; that and salting steer costs, never results.
Rows with a null id are returned and linked with nothing; equal ids are one node. Null texts are empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from clicklake.llm.common import fresh
from clicklake.sources.files import Scratch, settled

SHINGLE = 5
SAMPLE = 8192
#: A token estimated in this many documents or more makes its segments costly.
FREQUENT = 48
#: Rows of one signature that one task should get; more are salted.
GROUP_ROWS = 4096
#: Sets up to this size also have one-deletion signatures.
SMALL = 160
#: Slots of the filter that spares documents without candidates a shuffle, per candidate and at most; these are broadcast.
SLOTS_EACH, MOST_SLOTS = 8, 1 << 21
#: So many documents are skipped because others have their sets, by a broadcast list of their ids. Where there are more,
#: classes of equal sets are skipped that are larger than ``LARGE_CLASS`` and than 1/10,000 of all rows. Both steer costs only.
SKIPPED, LARGE_CLASS = 1_000_000, 64
#: Bits of a sketch, a power of two. Sets of more than about twice as many tokens gain nothing from it.
SKETCH_BITS = 1024

INDEX, INDEX_LESS, PROBE, PROBE_LESS = 1, 2, 4, 8
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles. ASCII letters are folded, ASCII space parts words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    n = len(words) - width + 1
    total = hashes[:n] + np.uint64(width)
    for k in range(1, width):
        total = total * _ODD + hashes[k : k + n]
    return np.unique(mixed(total))


def sketch(own: np.ndarray) -> np.ndarray:
    """Parities of how many tokens hash to each bit, in 64-bit words."""
    at = mixed(own + np.uint64(7)) % np.uint64(SKETCH_BITS)
    odd = np.bincount(at.astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 75 * (len(a) + len(b) - both) and both > 0


def _bands(largest: int = 1 << 40) -> np.ndarray:
    """The largest size of each band; the smallest sets that can be similar without being equal have three tokens."""
    out, low = [], 3
    while low < largest:
        out.append(low * 4 // 3)
        low = out[-1] + 1
    return np.array(out)


BANDS = _bands()


class Signer:
    """Signatures of one set after the other."""

    def __init__(self, tokens: np.ndarray, estimates: np.ndarray):
        order = np.argsort(tokens)
        self.tokens, self.estimates = tokens[order], estimates[order]

    def frequency(self, own: np.ndarray) -> np.ndarray:
        if not len(self.tokens):
            return np.zeros(len(own))
        at = np.minimum(np.searchsorted(self.tokens, own), len(self.tokens) - 1)
        return np.where(self.tokens[at] == own, self.estimates[at], 0.0)

    def signatures(self, own: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Parts of (signature, role, number of salts)."""
        s = len(own)
        if s < 3:
            return []
        band, out = int(np.searchsorted(BANDS, s)), []
        spread = mixed(own + np.uint64(1))
        # In this order the segments of any band follow each other.
        order = np.argsort(spread)
        spread, frequency = spread[order], self.frequency(own)[order]
        values = mixed(spread)
        for k in range(band, -1, -1):
            if 4 * BANDS[k] < 3 * s:
                break
            out += self._in_band(k, k == band, s, spread, values, frequency)
        return out

    @staticmethod
    def _in_band(k: int, own_band: bool, s: int, spread: np.ndarray, values: np.ndarray, frequency: np.ndarray):
        high = int(BANDS[k])
        m, small = high * 2 // 5 + 2, high <= SMALL
        needed = (s + min(high, s)) // 7 + 1
        segment = ((spread >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        counts = np.bincount(segment, minlength=m)
        full = np.flatnonzero(counts)
        starts = (np.cumsum(counts) - counts)[full]
        sums = np.zeros(m, np.uint64)
        sums[full] = np.add.reduceat(values, starts)
        base = _bases(k, m)
        # What a segment costs: how often its rarest token occurs; an empty one matches any other.
        cost = np.full(m, np.inf)
        cost[full] = np.minimum.reduceat(frequency, starts)
        chosen, raised = _allocated(cost, counts, np.bincount(segment[frequency == 0], minlength=m), needed, small)
        role = np.where(chosen, PROBE, 0) | (INDEX if own_band else 0)
        take = role > 0
        salts = _salts(cost)
        out = [(mixed(base[take] ^ sums[take]), role[take], salts[take])]
        if small:
            there = segment
            less = np.where(raised[there], PROBE_LESS, 0) | (INDEX_LESS if own_band else 0)
            on = less > 0
            left = sums[there] - values
            out.append((mixed(base[there[on]] ^ left[on]), less[on], _salts_less(frequency, there, starts, counts[full])[on]))
        return out


@lru_cache(maxsize=64)
def _bases(k: int, m: int) -> np.ndarray:
    """A number for each segment of a band."""
    return mixed(np.uint64(k << 40) + np.arange(m, dtype=np.uint64))


def _salts(cost: np.ndarray) -> np.ndarray:
    """Into how many parts the rows of a signature are dealt: all that have it must say the same."""
    return np.where(np.isinf(cost), 1, np.maximum(1, cost / GROUP_ROWS)).astype(np.int64)


def _salts_less(frequency: np.ndarray, segment: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The salts of segments less each one of their tokens, as a set of just the other tokens has them."""
    if not len(frequency) or frequency.max() < 2 * GROUP_ROWS:
        return np.ones(len(segment), np.int64)
    least = np.repeat(np.minimum.reduceat(frequency, starts), counts)
    is_least = frequency == least
    alone = is_least & (np.repeat(np.add.reduceat(is_least.astype(np.int64), starts), counts) == 1)
    second = np.repeat(np.minimum.reduceat(np.where(is_least, np.inf, frequency), starts), counts)
    return _salts(np.where(alone, second, least))


def _allocated(cost, counts, rare, needed: int, small: bool) -> tuple[np.ndarray, np.ndarray]:
    """Which segments to probe with, and which of them count twice, so that the counts reach ``needed``."""
    m = len(cost)
    chosen, raised = np.zeros(m, bool), np.zeros(m, bool)
    order = np.argsort(cost, kind="stable")
    cheap = int((cost < FREQUENT).sum())
    chosen[order[: min(needed, cheap)]] = True
    missing = needed - int(chosen.sum())
    if missing > 0 and small:
        # Two rare tokens: one is left whatever is deleted.
        twice = np.flatnonzero(chosen & (rare >= 2))[:missing]
        raised[twice] = True
        missing -= len(twice)
    if missing > 0:
        more = order[cheap : cheap + missing]
        chosen[more] = True
    return chosen, raised


# -- steps -------------------------------------------------------------------


def _mapped(rows: DataFrame, schema: str, names: list[str], kinds: list, make, at_a_time: int = 500) -> DataFrame:
    """``make`` turns lists of column values into arrays of the result; some hundred rows at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, at_a_time):
                part = batch.slice(i, at_a_time)
                arrays = make(*[c.to_pylist() for c in part.columns])
                yield pa.RecordBatch.from_arrays([pa.array(a, k) for a, k in zip(arrays, kinds)], names=names)

    return rows.mapInArrow(run, schema)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def digests(docs: DataFrame) -> DataFrame:
    """(id, n, set_key, bits) from (id, text): the size of the set, a hash of it and its sketch."""
    def make(ids, texts):
        sets = [shingles(t) for t in texts]
        keys = [xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) for s in sets]
        return ids, [len(s) for s in sets], keys, [sketch(s) for s in sets]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    return _mapped(docs, "id long, n long, set_key long, bits array<long>", ["id", "n", "set_key", "bits"], kinds, make)


def _frequent(docs: DataFrame, classes: DataFrame, n_classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent tokens and in how many classes they may be, from a sample of classes."""
    share = min(1.0, SAMPLE / max(n_classes, 1))
    spot = F.pmod(F.xxhash64("set_key"), F.lit(1 << 30)) / float(1 << 30)
    picked = classes.where(spot < share).select(F.col("rep").alias("id"))  # about SAMPLE rows
    def make(_, texts):
        sets = [shingles(t) for t in texts]
        return [_signed(np.concatenate(sets)) if sets else np.zeros(0, np.int64)]
    tokens = _mapped(docs.join(F.broadcast(picked), "id"), "token long", ["token"], [pa.int64()], make)
    counted = tokens.groupBy("token").count().where(F.col("count") >= max(2, FREQUENT * share))
    rows = counted.orderBy(F.desc("count"), "token").limit(200_000).collect()
    return (
        np.array([r["token"] for r in rows], np.int64).view(np.uint64), np.array([r["count"] / share for r in rows], np.float64)
    )


def _signature_rows(docs: DataFrame, frequent, large: dict[int, int]) -> DataFrame:
    """(signature, salt, id, n, info) of all documents but the further members of large classes.

    The info is 16 times the number of salts, which is one for all rows of a signature, plus the role.
    """
    shared = docs.sparkSession.sparkContext.broadcast((*frequent, large))

    def make(ids, texts):
        tokens, estimates, large = shared.value
        signer = Signer(tokens, estimates)
        out = [[np.zeros(0, np.int64)] for _ in range(5)]
        for i, text in zip(ids, texts):
            own = shingles(text)
            if i is None or large.get(xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63), i) != i:
                continue
            mine = int(mixed(np.array([i & (1 << 63) - 1], np.uint64))[0] >> np.uint64(20))
            for signature, role, salts in signer.signatures(own):
                n = len(signature)
                parts = (_signed(signature), mine % salts, np.full(n, i), np.full(n, len(own)), salts << 4 | role)
                for column, values in zip(out, parts):
                    column.append(values)
        return [np.concatenate(column) for column in out]

    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32()]
    return _mapped(docs, "signature long, salt int, id long, n int, info int", ["signature", "salt", "id", "n", "info"], kinds, make)


def _shared(rows: DataFrame) -> DataFrame:
    """(signature, id, n, role, hub, again) of the signatures that may belong to several documents, at least one of which probes.

    The hub is a signature's smallest id, with its size; ``again`` says that two other ids may have the signature.
    """
    one = Window.partitionBy("signature", "salt")
    # Plain columns as arguments: others would be worked out, and sent, before the shuffle.
    marked = rows.withColumns({
        "hub": F.min("id").over(one), "hub_n": F.min_by("n", "id").over(one), "most": F.max("id").over(one),
        "infos": F.bit_or("info").over(one), "count": F.count("*").over(one),
    })
    # Salted groups hold part of a signature's rows, so that nothing can be said yet, also of those with salt 0.
    whole, any_probes = F.col("infos") < 32, F.col("infos").bitwiseAND(PROBE | PROBE_LESS) > 0
    return marked.where(~whole | ((F.col("hub") < F.col("most")) & any_probes)).select(
        "signature", "id", "n", F.col("info").bitwiseAND(15).alias("role"),
        F.when(whole, F.struct(F.col("hub").alias("id"), F.col("hub_n").alias("n"))).alias("hub"), (~whole | (F.col("count") > 2)).alias("again"),
    )


def verified(pairs: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Those of the pairs (a, b) whose texts are similar."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    wanted = SLOTS_EACH * pairs.count()
    slots = min(MOST_SLOTS, 1 << max(10, int(wanted).bit_length()))
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(slots))
    used = scratch.settled(ids.select(slot("id").alias("slot")).distinct())
    texts = docs.withColumn("slot", slot("id")).join(F.broadcast(used), "slot", "left_semi").select("id", "text")
    left, right = texts.toDF("a", "text_a"), texts.toDF("b", "text_b")
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")

    def make(a, b, texts_a, texts_b):
        sets: dict[int, np.ndarray] = {}
        def of(i, text):
            if i not in sets:
                sets[i] = shingles(text)
            return sets[i]
        keep = [k for k in range(len(a)) if similar(of((0, a[k], texts_a[k]), texts_a[k]), of((1, b[k], texts_b[k]), texts_b[k]))]
        return [a[k] for k in keep], [b[k] for k in keep]

    found = _mapped(both, "a long, b long", ["a", "b"], [pa.int64()] * 2, make, at_a_time=200)
    found = scratch.settled(found.distinct())
    scratch.drop(used)
    return found


def roots(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(id, root): the smallest id reachable, for all ids of the edges (a, b) but the roots themselves.

    Stars alternate: each node's larger neighbours, then its smaller ones, move to its smallest neighbour, until every
    edge leads from a node to its root. A round shuffles edges, never groups, and the rounds before it go.
    """
    scratch = scratch or Scratch(edges.sparkSession)
    now = scratch.settled(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct())
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return now.toDF("id", "root")
        before, last = state, now
        both = now.union(now.select("v", "u")).toDF("u", "v")
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(lowest, "u")
        small = moved.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = scratch.settled(small.union(lowest.select("u", F.col("m").alias("v"))).where("u > v").distinct())
        scratch.drop(last)


def labels(edges: DataFrame, copies: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, root) of all ids that are not roots, by edges between documents and copies (rep, id) of the same set.

    Copies are a star already: edges are drawn between representatives, and copies take the root of theirs at the end.
    """
    of = lambda c: copies.select(F.col("id").alias(c), F.col("rep").alias(f"rep_{c}"))
    drawn = edges.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        F.coalesce("rep_a", "a").alias("a"), F.coalesce("rep_b", "b").alias("b")
    )
    found = roots(drawn, scratch)
    own = copies.join(found.toDF("rep", "root"), "rep", "left").select("id", F.coalesce("root", "rep").alias("root"))
    return scratch.settled(found.union(own))


def _fits(a: str, b: str):
    """Whether one indexes what the other probes, with sizes that allow a link."""
    has = lambda c, bits: F.col(f"{c}.role").bitwiseAND(bits) > 0
    meets = lambda x, y: (has(x, INDEX) & has(y, PROBE | PROBE_LESS)) | (has(x, INDEX_LESS) & has(y, PROBE))
    sizes = 4 * F.least(F.col(f"{a}.n"), F.col(f"{b}.n")) >= 3 * F.greatest(F.col(f"{a}.n"), F.col(f"{b}.n"))
    return (meets(a, b) | meets(b, a)) & sizes


def _sketches_fit(a: str, b: str):
    """Whether two sets may differ in as few tokens as a link allows."""
    words_ = [F.bit_count(F.col(f"{a}.bits")[i].bitwiseXOR(F.col(f"{b}.bits")[i])) for i in range(SKETCH_BITS // 64)]
    return 7 * reduce(add, words_) <= F.col(f"{a}.n") + F.col(f"{b}.n")


def _sketched(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sketches allow a link, of (a, a_n, b, b_n)."""
    # Where an id comes with several texts of one size, its rows get the sketches of all.
    side = lambda c: known.select(F.col("id").alias(c), F.col("n").alias(f"{c}_n"), F.struct("n", "bits").alias(c + "_"))
    met = pairs.join(side("a"), ["a", "a_n"]).join(side("b"), ["b", "b_n"])
    return met.where(_sketches_fit("a_", "b_")).select("a", "b").distinct()


def grouped(docs: DataFrame, key: str = "doc_id", text: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """(key, n_shingles, component_id) of every row. The tables it reads are those left in ``scratch``."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    scratch = scratch or Scratch(docs.sparkSession)
    known = scratch.settled(digests(rows))
    found = _linked(rows, known, scratch)
    return known.drop("bits").join(found, "id", "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("root", "id").alias("component_id")
    )


def _linked(docs: DataFrame, known: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, root) of the documents (id, text) that are linked with a smaller id; ``known`` are the documents' digests."""
    classes = scratch.settled(
        known.where("n > 0 AND id IS NOT NULL").groupBy("set_key", "n").agg(F.min("id").alias("rep"), F.count("*").alias("count"))
    )
    n_classes, n_rows = classes.agg(F.count("*"), F.coalesce(F.sum("count"), F.lit(0))).first()
    several = classes.where("count > 1").select("set_key", "n", "rep")
    members = known.drop("bits").join(several, ["set_key", "n"]).where("id <> rep").select("rep", "id").distinct()
    # An id with several texts may be in several classes: its memberships are edges like others.
    sets = known.where("n > 0 AND id IS NOT NULL").groupBy("id").agg(F.min("set_key").alias("low"), F.max("set_key").alias("high"))
    many = scratch.settled(sets.where("low < high").select("id"))
    copies = scratch.settled(members.join(many, "id", "left_anti"))
    joined = members.join(many, "id", "left_semi").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    # One document of each class is signed, as far as the list of the others is short; else one of each large class.
    large, signed = {}, docs
    if n_rows - n_classes <= SKIPPED:
        signed = docs.join(F.broadcast(copies.select("id")), "id", "left_anti")
    else:
        limit = max(LARGE_CLASS, n_rows // 10_000)  # so there are at most 10,000 of them
        large = {r["set_key"]: r["rep"] for r in classes.where(F.col("count") > limit).collect()}
    rows = scratch.settled(_shared(_signature_rows(signed.select("id", "text"), _frequent(docs, classes, n_classes), large)))
    salted = rows.where("hub IS NULL").drop("hub")
    hubs = salted.groupBy("signature").agg(F.min(F.struct("id", "n")).alias("hub"))
    rows_ = rows.where("hub IS NOT NULL").unionByName(salted.join(hubs, "signature"))
    # First round: everyone with the smallest id of a signature.
    others = rows_.where(F.col("id") != F.col("hub.id"))
    near = others.where(4 * F.least(F.col("n"), F.col("hub.n")) >= 3 * F.greatest(F.col("n"), F.col("hub.n")))
    pairs = scratch.settled(
        near.select(F.col("hub.id").alias("a"), F.col("hub.n").alias("a_n"), F.col("id").alias("b"), F.col("n").alias("b_n")).distinct()
    )
    tried = pairs.select("a", "b").distinct()
    likely = scratch.settled(_sketched(pairs, known))
    first = verified(likely, docs, scratch).union(joined)
    # Second round: those whose groups still differ, among the rest of each signature.
    group = labels(first, copies, scratch)
    placed = others.where("again").select("signature", "id", "n", "role").join(group, "id", "left").withColumn("root", F.coalesce("root", "id"))
    placed = scratch.settled(placed)
    mixed_ = placed.groupBy("signature").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    open_ = placed.join(mixed_.select("signature"), "signature", "left_semi")
    open_ = scratch.settled(open_.join(known.select("id", "n", "bits"), ["id", "n"]))
    a, b = open_.alias("a"), open_.alias("b")
    crossing = a.join(b, F.col("a.signature") == F.col("b.signature")).where(
        (F.col("a.id") < F.col("b.id")) & (F.col("a.root") != F.col("b.root")) & _fits("a", "b") & _sketches_fit("a", "b")
    )
    more = crossing.select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
    more = scratch.settled(more)
    scratch.drop(rows, placed, open_, pairs)
    found = labels(first.union(verified(more, docs, scratch)), copies, scratch)
    # ``known`` and what is found are read by whoever asks; everything else has had its last reader.
    scratch.drop(*[t for t, _ in scratch.kept if t is not known and t is not found])
    return found


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group, with its own columns: of the smallest id, and of its rows the one of the least text.

    Rows without an id get one made of a hash of the row, above ids as they commonly are, and are grouped like others.
    """
    node, columns = fresh(docs, "__node"), [F.col(c) for c in docs.columns]
    content = F.xxhash64(*columns)
    made = content.bitwiseAND((1 << 62) - 1) + F.lit(1 << 62)
    rows = docs.withColumn(node, F.coalesce(F.col(key).cast("long"), made))
    scratch = Scratch(docs.sparkSession)
    groups = settled(grouped(rows, node, text, scratch))
    scratch.drop(*[t for t, _ in scratch.kept])
    gone = groups.where(F.col("component_id") != F.col(node)).select(node).distinct()
    repeated = settled(groups.groupBy(node).count().where("count > 1").select(node))
    left = rows.join(gone, node, "left_anti")
    # Only ids with several rows need an aggregate over texts.
    several = left.join(repeated, node, "left_semi").groupBy(node).agg(
        F.min_by(F.struct(*columns), F.struct(F.coalesce(F.col(text), F.lit("")), content)).alias("row")
    )
    return left.join(repeated, node, "left_anti").select(*columns).union(several.select("row.*"))

"""Names that clash, missing and repeated ids, very long urls, and writers that give the same bytes anywhere."""

from __future__ import annotations

import os
import sys
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clicklake.llm import chat_format, mixing, quality_rules, sentence_pieces, sharding, toxicity, url_filters, warc

DOCS = "doc_id long, text string, source string"


def test_pieces_remember_bytes_not_chunks(monkeypatch):
    vocabulary = sentence_pieces.Vocabulary.read()
    encoder = sentence_pieces.Encoder(vocabulary)
    r = np.random.default_rng(1)
    unspaced = ["".join(map(chr, r.integers(0x4E00, 0x9FFF, 3000))) for _ in range(60)]
    first = encoder.encode(unspaced)
    assert not encoder.known and encoder.encode(unspaced[:3]) == first[:3]
    monkeypatch.setattr(sentence_pieces, "REMEMBERED", 100_000)
    encoder.encode([" ".join("".join(map(chr, r.integers(0x4E00, 0x9FFF, 20))) for _ in range(3000)) for _ in range(4)])
    kept = {**encoder.known, **encoder.older}
    used = sum(sys.getsizeof(c) + sys.getsizeof(ids) for c, ids in kept.items())
    # Equal ids are the same object, so they take nothing more.
    assert len({id(x) for ids in kept.values() for x in ids}) == len({x for ids in kept.values() for x in ids})
    assert kept and used < 2 * 110_000


def test_shards_hold_all_rows_and_columns(spark, tmp_path):
    rows = [(1, "same", "s"), (1, "same", "t"), (None, "x", "s"), (None, "x", "s"), (None, None, "s"), (2, "", None)] + [
        (10 + i, f"t{i} " * (i % 9), "u") for i in range(40)
    ]
    frame = spark.createDataFrame(rows, DOCS).withColumns({"shard": F.lit("own"), "slot": F.lit(7), "id": F.lit(1), "k": F.lit(2)})
    shard, slot = sharding.write_shards(frame, str(tmp_path / "s"), 3)
    assert (shard, slot) == ("_shard", "_slot")
    read = spark.read.parquet(str(tmp_path / "s"))
    assert Counter(map(tuple, read.select(frame.columns).collect())) == Counter(map(tuple, frame.collect()))
    slots = {}
    for r in read.collect():
        slots.setdefault(r[shard], []).append(r[slot])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and len(slots) <= 3


def test_sharding_against_plain_python(spark, monkeypatch):
    """Sizes, checksums, shards and slots, given the same splitters."""
    rows = [(i, "copy " * 9 if i % 5 == 0 else f"text {i} " * (i % 17), "s") for i in range(400)] + [(None, None, "s"), (None, "ü", "s")]
    records = sharding.records(spark.createDataFrame(rows, DOCS))
    by_key = {(r.id, r.size, r.crc): r.k for r in records.collect()}
    for i, text, _ in rows:
        data = (text or "").encode()
        assert (i, len(data) + 8, zlib.crc32(data)) in by_key
    n_shards = 5
    got = sorted((r.shard, r.slot, by_key[r.id, r.size, r.crc], -1 if r.id is None else r.id, r.size) for r in sharding.assign(records, n_shards).collect())
    # Over all shards, slots follow the order of (key, id) and a shard's share follows from the bytes before its rows' middle.
    assert [g[2:4] for g in got] == sorted(g[2:4] for g in got)
    total, before, groups = sum(g[4] for g in got), 0, {}
    for g in got:
        groups.setdefault(g[2], []).append(g)
    for k, group in groups.items():
        size = sum(g[4] for g in group)
        if size * n_shards * sharding.WHOLE_GROUP <= total:
            assert {g[0] for g in group} == {min(n_shards - 1, n_shards * (2 * before + size) // (2 * total))}
        else:
            at = before
            for g in group:
                assert g[0] == min(n_shards - 1, n_shards * (2 * at + g[4]) // (2 * total))
                at += g[4]
        before += size


def test_mixing_with_clashing_names_and_missing_ids(spark, monkeypatch):
    rows = [(None, f"a {i}", "hot") for i in range(50)] + [(7, f"b {i}", "hot") for i in range(50)] + [(i, "c", "x") for i in range(20)]
    frame = spark.createDataFrame(rows, DOCS).withColumns({
        "size": F.length("text").cast("long"), "mix_target": F.lit("own"), "__s": F.lit(1), "__rank": F.lit(2), "Mix_Copies": F.lit(3),
    })
    with pytest.raises(ValueError, match="exists already"):
        mixing.mix(frame, "size")
    names = mixing.names_for(frame)
    out = {}
    for block in (1_000_000, 8):
        monkeypatch.setattr(mixing, "BLOCK_ROWS", block)
        mixed = mixing.mix(frame, "size", names=names)
        assert mixed.columns == [*frame.columns, *names] and mixed.count() == len(rows)
        taken = mixed.groupBy("source").agg(F.sum(F.col("size") * F.col(names[2])).alias("taken"), F.first(names[1]).alias("target"))
        for r in taken.collect():
            assert abs(r.taken - r.target) <= 12
        assert mixing.emitted(mixed, names).columns == frame.columns
        out[block] = mixed.where("doc_id IS NULL").select(F.countDistinct(names[2])).first()[0]
    assert mixing.mix(frame.limit(0), "size", names=names).count() == 0


def test_a_very_long_url_costs_no_rounds(spark):
    pages = [(i, f"http://b.com/{'spam' if i % 2 else 'fine'}/{'x' * (i % 7)}") for i in range(120)]
    trap = [(900, "http://b.com/" + "/".join("ab"[k % 2] for k in range(2000))), (901, "http://b.com" + "/" * 1000), (900, "http://b.com/spam/q/r/s/t")]
    frame = spark.createDataFrame([(i, u + f"/{i}") for i, u in pages] + trap, "page_id long, url string")
    known = spark.createDataFrame([(i, bool(i % 2)) for i, _ in pages], "number long, bad boolean")
    began = time.time()
    got = url_filters.judge(frame, known, []).collect()
    assert time.time() - began < 60 and len(got) == 123
    assert Counter(r.verdict for r in got if r.page_id < 900) == {"block": 60, "allow": 60}
    assert Counter(r.verdict for r in got if r.page_id == 900)["allow"] >= 1


def test_chat_says_where_order_breaks_and_reads_loss_from_the_text(spark):
    rows = [(1, 0, "user", "a<b"), (1, 1, "assistant", "yes [x]"), (1, 2, "assistant", "no"), (1, 3, "user", "c"), (2, 0, "assistant", "z"),
            (3, 0, "system", "s"), (3, 1, "user", "q"), (3, 2, "assistant", "é漢"), (None, 0, "user", "n"), (None, 1, "user", "m"), (4, 0, "user", None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"segments": F.lit(1), "turns": F.lit(2)})
    got = {r.conv_id: r for r in chat_format.formatted(frame).withColumn("loss", chat_format.loss_text(F.col("formatted"), F.col("loss_spans"))).collect()}
    assert {c: (r.valid, r.first_bad) for c, r in got.items()} == {1: (False, 2), 2: (False, 0), 3: (True, None), None: (False, 1), 4: (True, None)}
    assert [s.state for s in got[1].segments][::3] == ["user", "assistant", "invalid", "invalid"]
    assert {c: r.loss for c, r in got.items()} == {1: "yes [x]no", 2: "z", 3: "é漢", None: "", 4: ""}
    for r in got.values():
        whole = "".join(s.text for s in r.segments)
        assert whole == r.formatted and [whole[s.start : s.start + s.length] for s in r.loss_spans] == [s.text for s in r.segments if s.loss]
    assert chat_format.formatted(frame.limit(0)).count() == 0


def test_archives_are_the_same_however_rows_are_dealt(spark, tmp_path):
    pages = spark.range(50_000).select(
        F.when(F.col("id") % 1000 > 0, F.col("id")).alias("page_id"), F.concat(F.lit("http://h/"), F.col("id").cast("string")).alias("url"),
        F.repeat(F.sha2(F.col("id").cast("string"), 256), (F.col("id") % 3).cast("int")).alias("html"),
    )
    manifests = []
    for n, (parts, jobs) in enumerate(((3, 0), (11, 3))):
        for k in range(jobs):  # other work in between
            spark.range(1000 + k).repartitionByRange(5, "id").count()
        rows = warc.records(pages.repartition(parts))
        made = warc.write(rows, f"file://{tmp_path}/w{n}", ranges=4)
        manifests.append(sorted(map(tuple, made.collect())))
    assert manifests[0] == manifests[1] and len(manifests[0]) == 4
    counts = [m[1] for m in manifests[0]]
    assert sum(counts) == 50_000 and max(counts) < 2 * min(counts)


def test_archives_of_no_and_of_repeated_pages(spark, tmp_path):
    frame = spark.createDataFrame([(5, "u", "x" * 200), (5, "u", "x" * 200), (5, "v", "y" * 3_000_000), (None, None, None)], "page_id long, url string, html string")
    got = warc.archived(frame).collect()
    assert Counter((r.id, r.payload_bytes, r.record_type) for r in got) == {(5, 200, "response"): 2, (5, 3_000_000, "response"): 1, (None, 0, "response"): 1}
    assert warc.archived(frame.limit(0)).count() == 0


def test_toxicity_learns_from_one_text_per_key(spark):
    bad, good = "vile awful slur", "calm kind note"
    rows = [(i, f"{bad if i % 2 else good} number {i} of many words", "s") for i in range(200)] * 2 + [(1, "other text of the same key", "s")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    network = toxicity.trained(spark.createDataFrame(rows, DOCS), labels)
    again = toxicity.trained(spark.createDataFrame(rows[:200] + [rows[-1]], DOCS).repartition(7), labels)
    texts = [bad, good, "", bad + " " + good]
    assert np.allclose(toxicity.Scorer(network).scores(texts), toxicity.Scorer(again).scores(texts))
    scores = toxicity.Scorer(network).scores(texts)
    assert scores[0] > 0.5 > scores[1]
    assert toxicity.trained(spark.createDataFrame(rows, DOCS).limit(0), labels) is None


def test_toxicity_learns_from_all_labelled_texts(spark, monkeypatch):
    """More than the 3,000 texts of a kind that were once drawn; whole sums over several shards."""
    seen, start = [], toxicity.Network.start
    monkeypatch.setattr(toxicity.Network, "start", lambda self, counts: (seen.append(counts), start(self, counts)))
    monkeypatch.setattr(toxicity, "EPOCHS", 1)
    rows = [(i, "foul words" if i % 40 == 0 else f"kind w{i % 7}", "s") for i in range(9000)]
    labels = spark.createDataFrame([(i, 0, int(i % 40 == 0)) for i in range(9000)], "doc_id long, quality int, toxic int")
    network = toxicity.trained(spark.createDataFrame(rows, DOCS), labels)
    learnt = labels.where(~toxicity.held_out(F.col("doc_id"))).where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4)) != 0)
    clean, toxic = (learnt.where(f"toxic = {k}").count() for k in (0, 1))
    (counts,) = seen
    assert clean > 4000 and counts[:, 0].tolist() == [clean, toxic]
    assert counts[:, toxicity.buckets("foul")[0]].tolist() == [0, toxic]
    scores = toxicity.Scorer(network).scores(["foul words", "kind w3"])
    assert scores[0] > toxicity.THRESHOLD > scores[1]


def test_toxicity_learns_from_long_texts_in_stretches(monkeypatch):
    """Maxima of a text do not depend on where it is cut."""
    network, reader = toxicity.Network(3), toxicity.Reader()
    pad = np.zeros((max(toxicity.WIDTHS), 1 + len(toxicity.BEGINNINGS)), np.int32)
    texts = [np.concatenate([reader.rows(t), pad]) for t in ("", "one", " ".join(f"w{i * i % 89}x" for i in range(500)))]
    whole = network.strongest(texts)
    monkeypatch.setattr(toxicity, "STRETCH", 7)
    cut = network.strongest(texts)
    assert np.allclose(whole[0], cut[0]) and (whole[1] == cut[1]).all()


def test_rules_and_training_leave_no_copies_of_texts(spark):
    """Folders of a stage that stay fill the disk while later stages run."""
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    kept = lambda: {f for f in os.listdir(folder) if f.startswith("clicklake-") and os.listdir(f"{folder}/{f}")}
    before = kept()
    rows = [(i, f"{'vile slur' if i % 2 else 'kind note'} " + " ".join(f"w{i}x{k}" for k in range(60 if i % 3 else 9)), "s") for i in range(120)]
    frame, labels = spark.createDataFrame(rows + [(None, None, None)], DOCS), spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, toxic int")
    accepted = quality_rules.keep(frame)
    assert accepted.columns == frame.columns and {r.doc_id for r in accepted.collect()} == {i for i in range(120) if i % 3}
    # Every text is measured once: windows are hashed in one place of the plan.
    assert accepted._jdf.queryExecution().optimizedPlan().toString().count("xxhash64") == 1
    assert toxicity.trained(frame, labels) is not None and toxicity.trained(frame, labels.where("toxic = 1")) is None
    assert kept() == before


def test_toxicity_finds_words_and_buckets_without_a_call_for_each(monkeypatch):
    """Whole texts and lists of words at a time, with the words and buckets of the plain way."""
    every = "".join(f"a{chr(c)}B" for c in range(0x600)) + " ÀÉß ß²x µm Straße_noch 12ab34 İi \u2028x 漢字 ﬁn"
    texts = [None, "", " ", every[: every.index(chr(0x100))], every, "the slur " * 9, "don't re-do x1y"]
    assert [toxicity.tokens(t) for t in texts] == [toxicity.WORD.findall((t or "").lower()) for t in texts]
    words = sorted({w for t in texts for w in toxicity.tokens(t)} | {"abcdefgh"[:n] for n in range(1, 9)} | {"abcdefü", "übcdefgh"})
    plain = [toxicity.buckets(w) for w in words]
    assert [[b for b in row if b] for row in toxicity.bucket_rows(words).tolist()] == plain
    reader = toxicity.Reader()
    for text, rows in zip(texts, reader.each(texts)):
        assert [[b for b in row if b] for row in rows.tolist()] == ([toxicity.buckets(w) for w in toxicity.tokens(text)] or [[]])
    calls = []
    monkeypatch.setattr(toxicity, "buckets", lambda w: calls.append(w) or [])
    toxicity.Reader().rows("only plain words here")
    network = toxicity.Network()
    network.shift = dict.fromkeys(range(5), 0.0)
    toxicity.Scorer(network).scores(["only plain words here"])
    assert not calls

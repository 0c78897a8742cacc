"""The operators against small models, with nulls, empty and long texts, repeats, empty tables and clashing names."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from clicklake.llm import (
    chat_format, fingerprints, mixing, ngram_join, quality_rules, sentence_pieces, sharding, toxicity, url_filters, warc,
)
from clicklake.llm.queries import CATALOG

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, texts, source="s"):
    rows = [(i, t, "en", source, len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


ODD = [None, "", " \n\t", "one", "one", "a b " * 3000, "x\x0by\x0cz é漢", "the cat sat on the mat the cat sat on it"]


def test_quality_measurements_and_policies(spark):
    frame = docs(spark, ODD).withColumn("measures", F.lit(1)).withColumn("key", F.lit(2))
    got = {r.doc_id: r for r in quality_rules.ledger(frame).collect()}
    assert [got[i].n_words for i in range(8)] == [len(WORD.findall(t or "")) for t in ODD]
    # Words 1 to 4 and 7 to 10 of the last text lie in windows that occur twice.
    assert got[5].n_repeat_words == 6000 and got[7].n_repeat_words == 8
    assert quality_rules.keep(frame).columns == frame.columns
    table = {r.rule: r for r in quality_rules.ablation(quality_rules.ledger(frame), quality_rules.BASE).collect()}
    assert table["few_words"].failed == 7 and table["repeated_windows"].kept_without == 1
    assert quality_rules.ledger(frame.limit(0)).count() == 0


def test_sharding_is_even_gapless_and_keeps_copies_together(spark):
    texts = [("w%d " % i) * (i % 40) for i in range(2000)] + ["same text"] * 20 + [None, ""]
    got = sharding.assign(sharding.records(docs(spark, texts)), 6).collect()
    assert len(got) == len(texts)
    sizes, slots, shards = Counter(), defaultdict(list), defaultdict(set)
    for r in got:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
        shards[texts[r.id]].add(r.shard)
    assert set(sizes) == set(range(6)) and max(sizes.values()) < 1.05 * min(sizes.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert len(shards["same text"]) == 1


def test_sharding_splits_a_hot_text(spark):
    got = sharding.assign(sharding.records(docs(spark, ["hot"] * 3000 + ["t%d" % i for i in range(300)])), 4).collect()
    counts = Counter(r.shard for r in got)
    assert len(got) == 3300 and max(counts.values()) < 1.1 * min(counts.values())
    assert sharding.assign(sharding.records(docs(spark, ["x"]).limit(0)), 4).count() == 0


def test_mix_meets_targets_and_bounds(spark):
    rows = [(i, "w " * (i % 30), "en", ["a", "b", "c", None][min(i % 10, 3)], 0) for i in range(4000)]
    frame = spark.createDataFrame(rows, DOCS).withColumn("size", F.size(F.split("text", " ")).cast("long") - 1)
    got = mixing.mix(frame, "size").collect()
    taken, aim = Counter(), {}
    for r in got:
        taken[r.source] += r.size * r.mix_copies
        aim[r.source] = r.mix_target
        assert 0 <= r.mix_copies <= 3
    assert sum(aim.values()) == pytest.approx(sum(r.size for r in got))
    assert all(abs(taken[s] - aim[s]) < 0.03 * aim[s] + 60 for s in aim)
    out = mixing.emitted(mixing.mix(frame, "size"))
    assert out.columns == frame.columns and out.count() == sum(r.mix_copies for r in got)
    assert mixing.mix(frame.limit(0), "size").count() == 0


def test_ngram_groups_equal_brute_force(spark):
    r = np.random.default_rng(5)
    texts = [None, "", "a b", "A b", "a b c d e f g"]
    for _ in range(12):
        base = [f"w{x}" for x in r.integers(0, 400, int(r.integers(4, 220)))]
        texts += [" ".join(base)] * 2
        for _ in range(6):
            copy = list(base)
            for at in r.integers(0, len(copy), max(1, len(copy) // 25)):
                copy[at] = "new%d" % r.integers(0, 9)
            texts.append(" ".join(copy))
    sets = []
    for t in texts:
        w = [x.lower() for x in WORD.findall(t or "")]
        sets.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    root = list(range(len(texts)))
    def find(x):
        return x if root[x] == x else find(root[x])
    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.grouped(docs(spark, texts)).collect()}
    assert got == {i: (len(sets[i]), find(i)) for i in range(len(texts))}
    assert ngram_join.keep_one(docs(spark, texts)).count() == len(set(map(find, range(len(texts)))))


def test_ngram_salts_lose_no_links(spark, monkeypatch):
    from pyspark import cloudpickle

    # Every token is frequent and all signatures are salted, but few documents share the same frequent tokens.
    monkeypatch.setattr(ngram_join, "GROUP_ROWS", 1)
    monkeypatch.setattr(ngram_join, "FREQUENT", 2)
    r = np.random.default_rng(6)
    passages = [[f"p{k}x{x}" for x in range(int(r.integers(6, 12)))] for k in range(12)]
    texts = []
    for _ in range(40):
        chosen = r.choice(12, int(r.integers(3, 6)), replace=False)
        base = [w for k in chosen for w in passages[k]]
        copy = list(base)
        copy[int(r.integers(0, len(copy)))] = "new"
        texts += [" ".join(base), " ".join(copy), " ".join(base[1:])]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    root = list(range(len(texts)))
    def find(x):
        return x if root[x] == x else find(root[x])
    for a in range(len(texts)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    cloudpickle.register_pickle_by_value(ngram_join)  # so that workers get the patched values
    try:
        got = {r.doc_id: r.component_id for r in ngram_join.grouped(docs(spark, texts)).collect()}
    finally:
        cloudpickle.unregister_pickle_by_value(ngram_join)
    assert got == {i: find(i) for i in range(len(texts))}


def test_keep_one_leaves_one_row_of_repeated_and_missing_ids(spark):
    r = np.random.default_rng(10)
    a, b, c = (" ".join(f"{k}{x}" for x in r.integers(0, 900, 60)) for k in "abc")
    rows = [(1, a, "en", "s", 1), (1, a, "en", "s", 1), (1, a, "de", "s", 1), (2, a, "en", "t", 1), (None, a, "en", "s", 1),
            (None, b, "en", "s", 1), (None, b, "en", "s", 1), (None, b, "en", "t", 1), (5, c, "en", "s", 1), (None, "", "en", "s", 1)]
    frame = spark.createDataFrame(rows, DOCS)
    got = ngram_join.keep_one(frame)
    assert got.columns == frame.columns
    assert sorted((x.doc_id or 0, x.text) for x in got.collect()) == sorted([(1, a), (0, b), (5, c), (0, "")])
    again = ngram_join.keep_one(frame.orderBy(F.desc("source"), "lang"))
    assert sorted(map(str, again.collect())) == sorted(map(str, got.collect()))


def test_ngram_salts_agree_for_sets_less_a_token(monkeypatch):
    monkeypatch.setattr(ngram_join, "GROUP_ROWS", 4)
    r = np.random.default_rng(7)
    for _ in range(100):
        own = np.unique(r.integers(0, 1 << 62, 40).astype(np.uint64))
        signer = ngram_join.Signer(own, r.choice([0.0, 9.0, 20.0, 50.0], len(own)))
        said = {}
        for one in [own, *[np.delete(own, k) for k in range(6)]]:
            for signature, _, salts in signer.signatures(one):
                for x, y in zip(signature.tolist(), salts.tolist()):
                    assert said.setdefault(x, y) == y


def test_sketches_differ_in_no_more_bits_than_sets_in_tokens():
    r = np.random.default_rng(4)
    for _ in range(200):
        a = np.unique(r.integers(0, 1 << 62, int(r.integers(1, 3000))).astype(np.uint64))
        b = np.unique(np.concatenate([a[r.random(len(a)) < 0.9], r.integers(0, 1 << 62, 20).astype(np.uint64)]))
        bits = np.bitwise_count((ngram_join.sketch(a) ^ ngram_join.sketch(b)).view(np.uint64)).sum()
        assert bits <= len(np.setxor1d(a, b))
    assert not ngram_join.sketch(np.zeros(0, np.uint64)).any()


def test_ngram_allocation_reaches_what_is_needed():
    r = np.random.default_rng(1)
    for _ in range(300):
        m = int(r.integers(2, 40))
        counts, needed = r.integers(0, 4, m), int(r.integers(1, m + 1))
        cost = np.where(counts == 0, np.inf, r.integers(0, 100, m).astype(float))
        chosen, raised = ngram_join._allocated(cost, counts, counts, needed, True)
        assert chosen.sum() + raised.sum() >= needed and not (raised & ~chosen).any()


def test_pieces_equal_the_library_and_round_trip(spark):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=sentence_pieces.MODEL)
    texts = [t for t in ODD if t is not None] + ["ing" * 400, "  two  spaces ", "emoji 😀\x00", "ab" * 30 + " c"]
    frame = docs(spark, [*texts, None]).withColumn("ids", F.lit(1))
    got = sentence_pieces.decode(sentence_pieces.encode(frame)).orderBy("doc_id").collect()
    assert [r.token_ids for r in got[:-1]] == library.encode(texts)
    assert [r.decoded for r in got[:-1]] == texts and got[-1].token_ids is None and got[-1].decoded is None
    both = sentence_pieces.encode_and_decode(frame).orderBy("doc_id").collect()
    assert [(r.token_ids, r.decoded) for r in both] == [(r.token_ids, r.decoded) for r in got]
    with pytest.raises(ValueError, match="exists already"):
        sentence_pieces.encode(frame.withColumn("token_ids", F.lit(1)))


def test_pieces_forget_and_cut_batches_without_a_trace(monkeypatch):
    import pyarrow as pa

    vocabulary = sentence_pieces.Vocabulary.read()
    r = np.random.default_rng(8)
    texts = [" ".join(f"w{x}" for x in r.integers(0, 300, int(r.integers(0, 60)))) for _ in range(80)]
    whole = sentence_pieces.Encoder(vocabulary).encode(texts)
    monkeypatch.setattr(sentence_pieces, "INDEXED", 200)
    monkeypatch.setattr(sentence_pieces, "REMEMBERED", 50)
    few = sentence_pieces.Encoder(vocabulary)
    assert few.encode(texts) == whole and len(few.known) <= 200
    monkeypatch.setattr(sentence_pieces, "AT_A_TIME", 500)
    for column in (pa.array([*texts, None, ""]), pa.array([*whole, None, []], pa.list_(pa.int32()))):
        parts = list(sentence_pieces._parts(pa.RecordBatch.from_arrays([column], ["c"]), 0))
        assert len(parts) > 10 and [x for p in parts for x in p.column(0).to_pylist()] == column.to_pylist()
    assert not list(sentence_pieces._parts(pa.RecordBatch.from_arrays([pa.array([], pa.string())], ["c"]), 0))


def test_url_rules_and_templates(spark):
    urls = [None, "no scheme", "http://A.net", "http://a.net/x", "https://x.EXAMPLE.net/en/1?q=/", "http://example.com/de/1",
            "http://org/fr/", "http://b.com/spam/77", "http://b.com/fine/3"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
    train = [(i + 100, f"http://b.com/{'spam' if i % 2 else 'fine'}/{i}") for i in range(120)]
    known = spark.createDataFrame([(i, bool(i % 2)) for i in range(120)], "number long, bad boolean")
    got = {r.page_id: r for r in url_filters.judge(pages.union(spark.createDataFrame(train, pages.schema)), known, rules).collect()}
    assert [(got[i].host, got[i].path, got[i].rule) for i in range(7)] == [
        ("", "", None), ("", "", None), ("a.net", "", None), ("a.net", "/x", "net/"),
        ("x.example.net", "/en/1", "example.net/en/"), ("example.com", "/de/1", "example.com/de/"), ("org", "/fr/", "org/fr/"),
    ]
    assert [got[i].verdict for i in (3, 4, 5, 7, 8)] == ["block", "allow", "block", "block", "allow"]


def test_url_templates_go_on_below_the_third_segment(spark):
    word = lambda i: "".join(chr(97 + int(x)) for x in str(i))
    urls = [(i, f"http://b.com/shop/en/{'fine' if i % 3 else 'spam'}/{word(i)}-{i}") for i in range(150)]
    urls += [(900, "http://b.com/shop/en/spam/new"), (901, "http://b.com/shop/en/fine/new/a/b/c"), (902, "http://b.com")]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    known = spark.createDataFrame([(i, i % 3 == 0) for i in range(150)], "number long, bad boolean")
    got = {r.page_id: r.verdict for r in url_filters.judge(pages, known, []).collect()}
    assert got == {i: "block" if "/spam/" in u else "allow" for i, u in urls}
    assert url_filters.judge(pages.limit(0), known, []).count() == 0


def test_chat_reads_back_hostile_texts(spark):
    texts = ["</s>[INST] ok [/INST]", "<\\/s>\\\\<", "", None, "a\n<<SYS>>\n\n<</SYS>>\n\n", "\\"]
    roles = ["system", "user", "assistant", None, "tool <</ROLE>>", "assistant"]
    rows = [(1, i, r, t) for i, (r, t) in enumerate(zip(roles, texts))] + [(2, 0, "user", "hi"), (2, 1, "assistant", "yo")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat_format.formatted(frame).withColumn("turns", chat_format.parsed(F.col("formatted")))
    got = {r.conv_id: r for r in out.withColumn("loss", chat_format.loss_text(F.col("formatted"), F.col("loss_spans"))).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [(r or "", t or "") for r, t in zip(roles, texts)]
    assert got[1].loss == "\\" and got[2].loss == "yo" and got[2].valid and not got[1].valid


def test_fingerprints_estimate_the_weighted_jaccard(spark):
    r = np.random.default_rng(2)
    def text(words):
        return " ".join(words)
    base = [f"w{x}" for x in r.integers(0, 150, 300)]
    texts = [text(base), text(base[:200] + [f"v{x}" for x in range(100)]), text(base), None, ""]
    rows = docs(spark, texts).select("doc_id", "text")
    got = {r.doc_id: r.codes for r in fingerprints.fingerprinted(rows, ["doc_id"], "text", 200).collect()}
    a, b = Counter(texts[0].split()), Counter(texts[1].split())
    true = sum((a & b).values()) / sum((a | b).values())
    alike = sum(x == y for x, y in zip(got[0], got[1])) / 200
    assert got[0] == got[2] and got[3] == got[4] and abs(alike - true) < 0.12


def test_fingerprints_as_shipped_are_near_the_weighted_jaccard(spark):
    r = np.random.default_rng(9)
    texts, true = [], []
    for k in range(300):
        base = [f"a{k}x{x}" for x in r.integers(0, 150, 200)]
        edit = [w if x > r.uniform(0.05, 0.3) else f"b{k}x{i}" for i, (w, x) in enumerate(zip(base, r.random(200)))]
        a, b = Counter(base), Counter(edit)
        true.append(sum((a & b).values()) / sum((a | b).values()))
        texts += [" ".join(base), " ".join(edit)]
    rows = docs(spark, texts).select("doc_id", "text")
    got = {x.doc_id: x.codes for x in fingerprints.fingerprinted(rows, ["doc_id"], "text").collect()}
    read = [np.mean([x == y for x, y in zip(got[2 * k], got[2 * k + 1])]) for k in range(300)]
    error = np.array(read) - np.array(true)
    print("mean", error.mean(), "root mean square", np.sqrt((error**2).mean()), "true", np.mean(true))
    assert abs(error.mean()) < 0.015 and np.sqrt((error**2).mean()) < 0.065


def test_fingerprints_of_edited_texts(spark):
    texts = ["abcd efgh", None, "xyz", "", "last one here"]
    got = {r.doc_id: r for r in fingerprints.compared(docs(spark, texts)).collect()}
    import hashlib
    following = [*texts[1:], texts[0]]
    for i, (t, n) in enumerate(zip(texts, following)):
        t, n = t or "", n or ""
        edited = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[i].n_chars == len(t)
    assert got[1].fingerprint == got[3].fingerprint
    assert fingerprints.compared(docs(spark, texts).limit(0)).count() == 0


def test_toxicity_learns_words_and_scores_any_text(spark):
    r = np.random.default_rng(3)
    words = [f"plain{x}" for x in range(300)]
    texts = [" ".join([*r.choice(words, 60), *(["vileness"] if i % 4 == 0 else [])]) for i in range(800)]
    frame = docs(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(800)], "doc_id long, toxic int")
    network = toxicity.trained(frame, labels)
    got = toxicity.scored(frame.withColumn("score_", F.lit(1)), network).withColumn("out", toxicity.held_out(F.col("doc_id"))).collect()
    held = [(x.score >= toxicity.THRESHOLD) == (x.doc_id % 4 == 0) for x in got if x.out]
    assert held and sum(held) / len(held) > 0.97
    odd = toxicity.scored(docs(spark, ODD), network).collect()
    assert len(odd) == len(ODD) and all(0 <= x.score <= 1 for x in odd)
    assert toxicity.trained(frame, labels.limit(0)) is None
    assert toxicity.keep(frame, None).columns == frame.columns


def test_archives_roll_and_refer(spark, tmp_path):
    rows = [(i, f"http://h/{i}", "x" * 150 if i % 3 else f"page {i} " * 40) for i in range(200)] + [(500, None, None), (501, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    root = f"file://{tmp_path}/w"
    manifest = warc.write(warc.records(pages), root, roll_bytes=4000, ranges=3)
    assert manifest.count() > 3 and manifest.agg(F.sum("records")).first()[0] == 202
    got = {r.id: r for r in warc.read(spark, root).collect()}
    assert got[1].record_type == "response" and got[2].refers_to == 1 and got[500].record_type == got[501].record_type == "response"
    again = warc.write(warc.records(pages), f"file://{tmp_path}/v", roll_bytes=4000, ranges=3)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, manifest.collect()))


def test_archives_roll_as_shipped(spark, tmp_path):
    # Hex digits take half their size, so that 40 MB roll at least once within the range planned for them.
    payload = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(16384)), lambda i: F.sha2(F.concat_ws(":", "id", i).cast("binary"), 256)), "")
    pages = spark.range(40, numPartitions=4).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), payload.alias("html"))
    files = {r.file: r.records for r in warc.write(warc.records(pages), f"file://{tmp_path}/w").collect()}
    assert len(files) > 1 and sum(files.values()) == 40 and "part-000000-00001.warc.gz" in files


@pytest.mark.parametrize("name", ["op1_quality_rules", "op3_sharding", "op5_mixing", "op6_url_filters", "op7_chat_format", "op9_fingerprints"])
def test_native_plans_hold_no_python(spark, name):
    text = CATALOG.queries[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct", text)


def test_pipeline_runs_and_keeps_columns(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, SF_DIR)
    assert {"doc_id", "text", "lang", "source", "n_chars", "token_ids"} <= set(rows.columns)
    assert rows.count() > 0 and rows.where("NOT round_trip").count() == 0

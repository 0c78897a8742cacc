"""Each stage of the pipeline against plain Python (or the mixing query's SQL) on planted documents."""

from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from clicklake.llm import sentence_pieces, toxicity
from clicklake.llm.queries import CATALOG

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def accepted(text: str | None) -> bool:
    """The policy in plain Python."""
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {p for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    n, chars, symbols, double = len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines))
    return not (
        n < 50 or 100 * len(repeated) > 50 * n or 100 * symbols > 40 * n or (double >= 3 and 100 * double > 60 * len(lines))
        or 10 * chars < 15 * n or chars > 30 * n
    )


def score(network: toxicity.Network, text: str | None) -> float:
    """One text through the network, word by word."""
    words, p = toxicity.tokens(text), network.p
    rows = [p["embedding"][toxicity.buckets(w)].sum(0) for w in words] + [np.zeros(toxicity.DIM)] * max(toxicity.WIDTHS)
    hidden, block = [], 0
    for number, width in enumerate(toxicity.WIDTHS):
        values = [sum(rows[i + k] @ p["filters"][block + k] for k in range(width)) for i in range(max(len(words), 1))]
        hidden.append(np.maximum(np.max(values, axis=0) + p["bias"][number], 0))
        block += width
    votes = [sum(w in f.split() for w in words) for f in toxicity.FUNCTION_WORDS.values()]
    language = votes.index(max(votes)) if max(votes) else len(votes)
    logit = np.concatenate(hidden) @ p["dense"] + p["out"][0] - network.shift[language]
    return 1 / (1 + np.exp(-(logit + np.log(toxicity.THRESHOLD / (1 - toxicity.THRESHOLD)))))


def leaders(texts: dict[int, str]) -> set[int]:
    """The smallest id of each group of similar texts."""
    sets = {}
    for i, text in texts.items():
        words = text.lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    root = {i: i for i in texts}

    def find(x):
        return x if root[x] == x else find(root[x])
    for a in texts:
        for b in texts:
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and sets[a] & sets[b]:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {find(i) for i in texts}


@pytest.fixture(scope="module")
def planted(tmp_path_factory):
    rng = random.Random(12)
    words = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "ter") for b in ("sun", "ver", "lin", "do") for c in ("a", "e", "on", "is", "ur")]
    clean = lambda n: [rng.choice(words) + rng.choice(["", "", "."]) for _ in range(n)]
    rows, labels = [], []
    for i in range(260):
        own = clean(rng.randint(55, 110))
        if i % 4 == 0:
            for _ in range(9):
                own.insert(rng.randrange(len(own)), rng.choice(["vilefoo", "nastybar", "slurbaz"]))
        rows.append((i, " ".join(own)))
        labels.append((i, 1, int(i % 4 == 0)))
    base = [t for i, t in rows if i % 4]
    for k in range(30):
        copy = base[k].split()
        copy[rng.randrange(len(copy))] = "changed"
        rows += [(300 + 2 * k, base[k]), (301 + 2 * k, " ".join(copy))]
    rows += [(400 + k, " ".join(clean(20))) for k in range(10)] + [(420 + k, "same three words " * 30) for k in range(3)]
    rows += [(430, None), (431, ""), (432, "# $ % " * 60), (433, ("one line\n" * 40))]
    sources = ["big", "big", "big", "mid", None, "small"]
    rows = [(i, t, "en", sources[i % 6], len(t or "")) for i, t in rows]
    rng.shuffle(rows)
    folder = tmp_path_factory.mktemp("planted")
    return rows, labels, str(folder)


def test_every_stage_keeps_what_it_should(spark, planted):
    rows, labels, folder = planted
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.createDataFrame(rows, DOCS)
    names, given = [n for n, _ in corpus_pipeline.STAGES], docs.columns
    assert names == ["quality_rules", "toxicity", "ngram_join", "mixing", "sentence_pieces"]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, folder)
        out.write.parquet(f"{folder}/{name}")
        out = spark.read.parquet(f"{folder}/{name}")
        got = Counter(r.doc_id for r in out.collect())
        if name == "quality_rules":
            want = Counter(i for i, r in before.items() if accepted(r.text))
            assert 290 < len(want) < len(before)
        elif name == "toxicity":
            network = toxicity.trained(docs, spark.read.parquet(f"{folder}/labels.parquet"))
            scores = {i: score(network, r.text) for i, r in before.items()}
            assert all(abs(s - toxicity.THRESHOLD) > 1e-4 for s in scores.values())
            want = Counter(i for i, s in scores.items() if s < toxicity.THRESHOLD)
            assert not any(i % 4 == 0 for i in want if i < 260)
        elif name == "ngram_join":
            want = Counter(leaders({i: r.text for i, r in before.items()}))
            assert len(want) < len(before) - 40
        elif name == "mixing":
            con = duckdb.connect()
            con.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/ngram_join/*.parquet'")
            taken = con.sql(f"SELECT doc_id, taken // greatest(size, 1) FROM ({CATALOG.oracles['op5_mixing']})").fetchall()
            want = Counter({i: n for i, n in taken if n})
            assert max(want.values()) > 1
        else:
            from sentencepiece import SentencePieceProcessor

            model = SentencePieceProcessor(model_file=sentence_pieces.MODEL)
            want = got
            assert all(r.token_ids == model.encode(r.text) and r.round_trip for r in out.collect())
        assert got == want, name
        assert all(before[r.doc_id].text == r.text and before[r.doc_id].source == r.source for r in out.collect())
        if name != "sentence_pieces":
            assert out.columns == given
        docs = out


def test_scores_are_those_of_a_plain_forward_pass(spark, planted):
    rows, labels, _ = planted
    docs, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    network = toxicity.trained(docs, known)
    odd = [None, "", "...", "der die und das", "le les vilefoo", "x " * 3000 + "slurbaz", "Ünï çödé"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(odd)] + [(100 + r[0], r[1]) for r in rows[:60]], "doc_id long, text string")
    for r in toxicity.scored(frame, network).collect():
        assert abs(r.score - score(network, r.text)) < 1e-4, r.text


def test_stages_of_no_documents(spark, planted, tmp_path):
    rows, labels, _ = planted
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0


def test_stages_with_odd_rows_and_clashing_names(spark, planted, tmp_path):
    rows, labels, _ = planted
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    some = rows[:80] + [(None, rows[0][1], None, None, None)] * 2 + [rows[1]] * 2
    docs = spark.createDataFrame(some, DOCS).selectExpr("*", "1 AS mix_target", "2 AS token_ids", "3 AS __node", "4 AS __copy", "5 AS round_trip", "6 AS id")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns[: len(columns)] == columns
    assert docs.columns[len(columns) :] == ["_token_ids", "_round_trip"] and docs.count() > 0

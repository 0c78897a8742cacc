"""Source divergence, conversation repair and substring dedup against brute force, on odd and on random rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from clicklake.llm import conversation_repair as repair, source_divergence as divergence, substring_dedup as dedup

# -- source divergence ---------------------------------------------------------

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def divergences(rows, min_docs=3, top=200):
    """(lang, source, part, item) -> (value, rank), term by term."""
    docs = [(l or "", s or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))) for l, s, t in rows]
    out = {}
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        kept = [t for t, n in Counter(t for _, _, ts in own for t in set(ts)).items() if n >= min_docs]
        sources = {s: Counter(t for _, o, ts in own if o == s for t in ts) for s in {d[1] for d in own}}
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c[k] for k in kept) + len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in sources.items()}, share(Counter(t for _, _, ts in own for t in ts))
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = {o: sum(f(p[s][t], p[o][t]) for t in kept) for o in sources if o != s}
            terms = {t: f(p[s][t], q[t]) for t in kept if sources[s][t] and p[s][t] > q[t]}
            for part, values, most in (("pair", pairs, None), ("term", terms, top)):
                best = sorted(values.items(), key=lambda x: (-x[1], x[0].encode()))[:most]
                out |= {(lang, s, part, item): (v, i + 1) for i, (item, v) in enumerate(best)}
    return out


def documents(spark, rows, extra=False):
    schema = "lang string, source string, text string" + ", n int, value long, bucket int" * extra
    return spark.createDataFrame([(*r, 1, 2, 3) if extra else r for r in rows], schema)


def found(df):
    rows = df.collect()
    out = {(r["lang"], r.source, r.part, r["item"]): (r.value, r["rank"]) for r in rows}
    assert len(out) == len(rows)
    return out


ODD = [None, "", " \n", "A1b-É_x", "Été ÉTÉ été", "the cat", "漢字 the", "a " * 5000]


def test_divergence_as_counted_by_hand(spark):
    rng = random.Random(4)
    words = ["w%s" % chr(97 + i) for i in range(20)] + ["É", "é", "Zz"]
    rows = [(rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None]), " ".join(rng.choices(words, k=rng.randint(0, 30)))) for _ in range(150)]
    rows += [("en", "a", t) for t in ODD] + [("xx", s, t) for s, t in (("p", None), ("q", "once"), ("r", "-"))]
    got = found(divergence.divergences(documents(spark, rows, extra=True)))
    assert got == divergences(rows)
    assert got["xx", "p", "pair", "q"] == (0, 1) and not any(k[0] == "xx" and k[2] == "term" for k in got)


def test_divergence_spills_and_buckets(spark, monkeypatch):
    for name, value in (("SPILL_CELLS", 7), ("AT_A_TIME", 3), ("BUCKET_CELLS", 20), ("TABLE", 8)):
        monkeypatch.setattr(divergence, name, value)
    rng = random.Random(5)
    # A hot source and a language with many terms of equal value, of which only some are reported.
    rows = [("en", "hot" if i % 3 else f"s{i % 7}", " ".join("t%s" % "abcdefghij"[rng.randrange(10)] * rng.randint(1, 3) for _ in range(6))) for i in range(90)]
    rows += [("en", f"s{i % 2}", " ".join("u" + chr(97 + k // 26) + chr(97 + k % 26) for k in range(60))) for i in range(6)]
    assert found(divergence.divergences(documents(spark, rows), top=5)) == divergences(rows, top=5)


def test_divergence_of_no_documents(spark):
    assert divergence.divergences(documents(spark, [("en", "a", "x")]).limit(0)).count() == 0


def test_shares_are_exact_beyond_64_bits():
    counts = [0, 1, 10**9, 10**15, 7 * 10**15]
    whole = 8 * 10**15 + 3
    assert divergence.shares(np.array(counts), whole).tolist() == [1 + 10**9 * (c + 1) // whole for c in counts]


# -- conversation repair ---------------------------------------------------------


def mended(rows):
    """Least (cost, audit) over all edits, row after row, for rows (role, text, fault), and the repaired lines."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    table = {"": (0, "", ())}

    def put(out, state, value):
        if state is not None and (state not in out or value[:2] < out[state][:2]):
            out[state] = value

    def inserted(table):
        for _ in range(4):
            for state, (cost, audit, lines) in list(table.items()):
                for role in ("user", "assistant"):
                    put(table, step.get((state, role[0])), (cost + 2, audit + "I", (*lines, role + ":")))
        return table

    for role, text, fault in rows:
        out = {}
        for state, (cost, audit, lines) in inserted(table).items():
            put(out, state, (cost + 3, audit + "D", lines))
            if fault not in (1, 2):
                more = fault == 3
                put(out, step.get((state, role[:1])), (cost + more, audit + "K", (*lines, f"{role}:{text}")))
                for other in ("user", "assistant"):
                    put(out, step.get((state, other[0])), (cost + 2 + more, audit + "R", (*lines, f"{other}:{text}")))
        table = out
    return min((v for s, v in inserted(table).items() if s in ("", "a")), key=lambda v: v[:2])


def repaired(rows):
    """What the operator should say of undamaged rows (conv, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        kept = []
        for _, turn, role, text in [r for r in rows if r[0] == conv]:
            role, text = " " if role is None else role, " " if text is None else text
            kind = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            kept += [(turn is not None, turn or 0, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
        kept.sort(key=lambda r: (r[0], r[1], r[2].encode(), r[3].encode()))
        seen, faults, lines = set(), [], []
        for _, _, role, text in kept:
            bare = text.strip(" \t\n\x0b\x0c\r")
            faults.append(1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0)
            seen.add((role, text))
            lines.append((role, text, faults[-1]))
        turns = {r[1] for r in kept if r[0]}
        initials = [r[0][:1] for r in lines]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, text = mended(lines)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count(1), faults.count(2), faults.count(3), illegal,
            cost, audit, hashlib.sha256("\n".join(text).encode()).hexdigest(),
        )
    return out


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, True) for r in rows], "conv_id long, turn long, role string, text string, fault int, there boolean")


def test_repair_as_found_by_trying_all_edits(spark):
    rng = random.Random(6)
    roles = ["user", "assistant", "system", "tool", "", None, "s", "assistant"]
    texts = ["Fine.", "What?", "cut off", "", " \t", None, "Fine.", "no end\n", "é!\r\n", "Mid. way"]
    rows = [
        (conv, rng.choice([None, *range(9)]) if conv % 3 else turn, rng.choice(roles), rng.choice(texts))
        for conv in range(120) for turn in range(rng.randint(1, 9))
    ]
    rows += [(None, i, "user", "a.") for i in range(4)]
    frame = repair.damaged(conversations(spark, rows))
    got = {r[0]: tuple(r)[1:] for r in repair.repaired(frame).collect()}
    assert got == repaired(rows)


def test_repair_goes_on_across_sections(spark, monkeypatch):
    rng = random.Random(7)
    rows = [(1, i, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["a.", "b", "c! %d" % i, ""])) for i in range(200)]
    want = repaired(rows)
    assert {r[0]: tuple(r)[1:] for r in repair.repaired(repair.damaged(conversations(spark, rows))).collect()} == want
    for size in (1, 2, 7):
        monkeypatch.setattr(repair, "SECTION", size)
        conversation = repair.Conversation()
        for turn, role, text, fault, _ in sections(rows):
            conversation.add(turn, role, text, fault)
        assert conversation.result() == want[1]


def sections(rows):
    """The damaged rows with faults, in plain Python."""
    kept, seen = [], set()
    for conv, turn, role, text in rows:
        kind = crc32(f"{conv}:{turn}".encode()) % 20
        text, role = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text, "user" if kind == 4 else role
        for _ in range({0: 0, 3: 2}.get(kind, 1)):
            bare = text.strip()
            yield turn, role, text, 1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0, kept
            seen.add((role, text))


def test_repair_of_few_and_of_no_rows(spark):
    gone = next(i for i in range(1000) if crc32(f"{i}:0".encode()) % 20 == 0)
    nothing = hashlib.sha256(b"").hexdigest()
    (row,) = repair.repaired(repair.damaged(conversations(spark, [(gone, 0, "user", "x.")]))).collect()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", nothing)
    assert repair.repaired(repair.damaged(conversations(spark, [(gone, 0, "user", "x.")]).limit(0))).count() == 0


# -- substring dedup -------------------------------------------------------------


def without_repeats(rows, window):
    """Per row: words left and the number of words, by comparing all windows."""
    words = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, ws in words:
        if i is not None:
            for k in range(len(ws) - window + 1):
                g = tuple(ws[k : k + window])
                first[g] = min(first.get(g, i), i)
    out = []
    for i, ws in words:
        gone = set()
        for k in range(len(ws) - window + 1):
            if i is not None and first[tuple(ws[k : k + window])] < i:
                gone |= set(range(k, k + window))
        out.append((i, b" ".join(w for k, w in enumerate(ws) if k not in gone).decode(), len(ws), len(gone)))
    return Counter(out)


def rows_of(df):
    return Counter((r.doc_id, r.kept_text, r.n_words, r.n_removed) for r in df.collect())


def edited(rng, n):
    """Texts that share passages, some with small edits, some periodic."""
    passages = [[f"p{k}w{i}" for i in range(rng.randint(20, 60))] for k in range(6)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 4)):
            own = list(rng.choice(passages))
            if rng.random() < 0.6:
                own[rng.randrange(len(own))] = rng.choice(["x", "y", "p0w3"])
            words += own[rng.randrange(5) :] + [f"u{rng.randrange(50)}" for _ in range(rng.randint(0, 9))]
        rows.append((i, " ".join(words)))
    rows += [(n + i, rng.choice(["a ", "a b ", "a b c "]) * rng.randint(3, 60)) for i in range(12)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("chunk, window, first", [(500_000, 13, 7), (60, 13, 7), (200, 13, 2), (150, 30, 4), (100, 5, 9)])
def test_repeated_windows_as_found_by_comparing_all(spark, monkeypatch, chunk, window, first):
    monkeypatch.setattr(dedup, "CHUNK_WORDS", chunk)
    rows = edited(random.Random(chunk), 60)
    rows += [(None, rows[0][1]), (None, rows[0][1]), (3, rows[5][1]), (3, rows[5][1]), (900, None), (901, ""), (902, " \t "), (903, "é\x0bé")]
    frame = spark.createDataFrame([(*r, 1, 2, "t") for r in rows], "doc_id long, text string, id int, tag int, spans string")
    done = dedup.cut(frame, window=window, first=first)
    assert done.columns == [*frame.columns, "kept_text", "n_words", "n_removed"]
    assert rows_of(done) == without_repeats(rows, window)


def test_dedup_catches_copies_and_leaves_others_alone(spark):
    rng = random.Random(9)
    text = lambda n: " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))
    whole, clean = text(300), [(100 + i, text(80)) for i in range(20)]
    rows = [(i, whole) for i in range(1, 40)] + clean
    got = {r.doc_id: r for r in dedup.cut(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].n_removed == 0 and all(got[i].n_removed == 300 and got[i].kept_text == "" for i in range(2, 40))
    assert all(got[i].n_removed == 0 and got[i].kept_text == t for i, t in clean)


def test_dedup_of_no_rows_and_of_taken_names(spark):
    frame = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert dedup.cut(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        dedup.cut(frame.withColumnRenamed("text", "Kept_Text"), text="Kept_Text")


def test_rolled_and_least():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 63, 40).astype(np.uint64)
    for length in range(1, 20):
        want = [sum(int(v) * 5 ** (length - 1 - k) for k, v in enumerate(values[i : i + length])) % (1 << 64) for i in range(41 - length)]
        assert dedup.rolled(values, length, 5).tolist() == want
        assert dedup.least(values, length).tolist() == [min(values[i : i + length]) for i in range(41 - length)]

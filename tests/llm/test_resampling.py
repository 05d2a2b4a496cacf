"""Importance resampling, conversation repair and personal data, against plain Python."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from lettermill.llm import char_tagger, conversations, importance, personal_data
from lettermill.llm.catalog import QUERIES
from .conftest import LINE, edge_rows, story

RUN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def low(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute_scores(rows, targets, how: importance.Resampling):
    def features(text):
        w = RUN.findall(low(text or ""))
        return len(w), [
            zlib.crc32(" ".join(w[i : i + n]).encode()) % how.buckets for n in range(1, how.order + 1) for i in range(len(w) - n + 1)
        ]

    own = [features(t) for _, t in rows]
    s = Counter(b for _, f in own for b in f)
    t = Counter(b for x in targets for b in features(x)[1])
    n_s, n_t, n = sum(s.values()), sum(t.values()), how.buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n_s + n) / ((s[b] + 1) * (n_t + n))))
    out = []
    for (i, text), (words, f) in zip(rows, own, strict=True):
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"{how.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, words, text])
    may = sorted((r for r in out if r[4] >= how.min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = {}
    for rank, r in enumerate(may[: len(may) * how.percent // 100], 1):
        drawn[id(r)] = rank
    return sorted(str((*r[:4], drawn.get(id(r)))) for r in out)


@pytest.mark.parametrize("order, hot", [(1, 1000), (3, 1000), (2, 3)])
def test_importance(spark, edge, nothing, order, hot, monkeypatch):
    monkeypatch.setattr(importance, "HOT_LINES", hot)  # with few, more lines take the shuffled way
    how = importance.Resampling(order=order, buckets=500, percent=40)
    rows = [(r[0], r[1]) for r in edge_rows()] + [(500 + i, f"{LINE}\n{LINE}\nzwei Wörter\n\n und \nÄ {story(i, 3)}") for i in range(30)]
    docs = edge.select("doc_id", "text", "row").unionByName(
        spark.createDataFrame(rows[len(edge_rows()) :], "doc_id long, text string").withColumn("row", F.lit("r"))
    )
    targets = [LINE, None, "", story(10, 60) + "\n" + LINE, "Zwei\nWörter"]
    target = spark.createDataFrame([(i, t) for i, t in enumerate(targets)], "item_id long, text string")
    out = importance.importance_scores(docs, target, how)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    want = brute_scores(rows, targets, how)
    assert sorted(str(tuple(r)) for r in out.collect()) == want
    if order == 1:
        drawn = importance.resample(docs, target, how)
        assert drawn.columns == docs.columns and drawn.count() >= 1
        assert importance.importance_scores(nothing, target, how).count() == 0
        none = importance.importance_scores(docs, target.limit(0), how)
        assert sorted(str(tuple(r)) for r in none.collect()) == brute_scores(rows, [], how)


def brute_repair(rows) -> tuple:
    """The contract in plain Python: rows (turn, role, text) of one conversation after damage, in order."""
    blank = duplicate = truncated = illegal = 0
    signs, seen = [], set()
    for _, role, text in rows:
        core = text.strip(" \t\n\x0b\x0c\r")
        if not core:
            blank, sign = blank + 1, "x"
        elif (role, text) in seen:
            duplicate, sign = duplicate + 1, "x"
        elif core[-1] not in ".!?":
            truncated, sign = truncated + 1, "t"
        else:
            sign = ""
        seen.add((role, text))
        signs.append(sign)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))  # noqa: B905
    after = {("", "s"): "S", ("", "u"): "A", ("S", "u"): "A", ("U", "u"): "A", ("A", "a"): "U"}

    @lru_cache(maxsize=None)
    def best(i, state, added):
        """(cost, audit, kept roles) of all that follows."""
        found = [(0, "", ())] if i == len(rows) and state in ("", "U") else []

        def take(cost, edit, rest, own=()):
            if rest:
                found.append((cost + rest[0], edit + rest[1], own + rest[2]))

        if added < 3:
            for c, role in (("u", "user"), ("a", "assistant")):
                if (state, c) in after:
                    take(2, "I", best(i, after[state, c], added + 1), ((role, ""),))
        if i < len(rows):
            _, role, text = rows[i]
            take(3, "D", best(i + 1, state, 0))
            if signs[i] != "x":
                more = signs[i] == "t"
                if (state, role[:1]) in after:
                    take(more, "K", best(i + 1, after[state, role[:1]], 0), ((role, text),))
                for c, other in (("u", "user"), ("a", "assistant")):
                    if (state, c) in after and role[:1] != c:
                        take(2 + more, "R", best(i + 1, after[state, c], 0), ((other, text),))
        return min(found, key=lambda f: f[:2]) if found else None

    cost, audit, turns = best(0, "", 0)
    numbers = {t for t, _, _ in rows if t is not None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    text = "\n".join(f"{r}:{t}" for r, t in turns)
    return gaps, blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()


def conversation_rows(n: int, longest: int) -> list[tuple]:
    rng = np.random.default_rng(n)
    rows = []
    for c in [None, *range(n)]:
        for _ in range(int(rng.integers(0, longest))):
            turn = None if rng.random() < 0.05 else int(rng.integers(0, longest + 3))
            role = [None, "system", "user", "assistant", "user", "assistant", "tool", ""][int(rng.integers(0, 8))]
            text = [None, "", " \t\n", "ja", "ja.", "Nein! ", "wer? ich", "é 😀", f"{rng.integers(0, 99)}."][int(rng.integers(0, 9))]
            rows.append((c, turn, role, text))
    return rows


def brute_conversations(rows, hurt: bool) -> list[str]:
    groups = defaultdict(list)
    for c, turn, role, text in rows:
        own = groups[c]
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20 if hurt else 9
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2].encode())
    return sorted(str((c, *brute_repair(sorted(own, key=key)))) for c, own in groups.items())


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("block", [32, 3])
def test_conversations(spark, block, monkeypatch):
    rows = conversation_rows(120, 9) + [(900, i, "user", f"{i}.") for i in range(70)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("present", F.lit("x")).withColumn("fault", F.lit(1))
    conversations.best_way.cache_clear()
    # blocks are cut in the driver's module only; the workers' blocks are tested through plain calls below
    got = sorted(str(tuple(r)) for r in conversations.audit_conversations(docs).collect())
    assert got == brute_conversations(rows, False)
    monkeypatch.setattr(conversations, "BLOCK", block)
    rng = np.random.default_rng(8)
    for n in [*range(12), 40, 90]:
        for _ in range(12):
            own = []
            for i in range(n):
                role = ["system", "user", "assistant", "tool"][int(rng.choice(4, p=[0.1, 0.4, 0.4, 0.1]))]
                own.append((i, role, ["x.", f"{i}.", f"{i}", ""][int(rng.choice(4, p=[0.2, 0.5, 0.2, 0.1]))]))
            turns = []
            c = conversations.Conversation(lambda e, r, t: turns.append(f"{r}:{t}"))  # noqa: B023
            seen = set()
            for turn, role, text in own:
                fault = "blank" if not text else "duplicate" if (role, text) in seen else "" if text[-1] == "." else "truncated"
                seen.add((role, text))
                c.add(turn, role, text, fault)
            c.end()
            digest = hashlib.sha256("\n".join(turns).encode()).hexdigest()
            assert (c.gaps, *c.count.values(), c.illegal, c.cost, "".join(c.audit), digest) == brute_repair(own)


def test_conversation_query_and_turns(spark, tmp_path):
    rows = conversation_rows(200, 8)
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    out = QUERIES["op12_conversation_repair"](spark, str(tmp_path))
    assert sorted(str(tuple(r)) for r in out.collect()) == brute_conversations(rows, True)
    empty = spark.createDataFrame([], SCHEMA)
    assert conversations.audit_conversations(empty).count() == 0
    turns = conversations.repair_conversations(spark.createDataFrame(rows, SCHEMA)).collect()
    texts = defaultdict(list)
    for r in sorted(turns, key=lambda r: r.place):
        texts[r.conv_id].append(f"{r.role}:{r.text}")
    for r in conversations.audit_conversations(spark.createDataFrame(rows, SCHEMA)).collect():
        assert hashlib.sha256("\n".join(texts[r.conv_id]).encode()).hexdigest() == r.repaired_sha256


def test_alignment_stays_in_its_band():
    assert conversations.align("ua", "ua", 0) == (0, "KK")
    assert conversations.align("uu", "ua", 1) is None
    assert conversations.align("uu", "ua", 2) == (2, "KR")
    assert conversations.best_way("sx", 0, 2) == (7, "IRD", "ua")
    assert conversations.best_way("", 0, 2)[0] == 4 and conversations.best_way("u", 2, 0) is None


LUHN = lambda d: sum(sum(divmod(int(x) * (1 + i % 2), 10)) for i, x in enumerate(reversed(d))) % 10 == 0
PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(re.sub("[^0-9]", "", m)) <= 19 and LUHN(re.sub("[^0-9]", "", m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
]


def brute_base(text: str) -> list[tuple]:
    return [(k, m.start(), m.end()) for k, p, fits in PATTERNS for m in re.finditer(p, text) if fits(m[0])]


def test_base_spans_are_the_patterns():
    rng = np.random.default_rng(3)
    parts = ["a", "a.b", "@", "@@", ".", "..", "-", "+", "1", "12", "255.", "256", "4111111111111111", " ", "4111 1111 1111 1111", "+49 (30) 123-4567", "é", "😀", "x@y.z", "00"]
    for _ in range(4000):
        text = "".join(parts[i] for i in rng.integers(0, len(parts), rng.integers(0, 14)))
        assert [(personal_data.PATTERNS[k], a, b) for k, a, b in personal_data.base_spans(text)] == brute_base(text)
    for text in ("a" * 200_000, "1" * 200_000 + ".", "1." * 100_000, "a@" * 100_000, "+1" + "-" * 200_000):  # no square of the length
        personal_data.base_spans(text)


def labelled_texts(n: int, seed: int, changed: bool = False) -> list[str]:
    rng = np.random.default_rng(seed)
    digits = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    out = []
    for i in range(n):
        d = "4" + digits(14)
        card = next(d + str(c) for c in range(10) if LUHN(d + str(c)))
        name, host = f"{story(i, 1)}.{digits(2)}", f"mail{digits(1)}.example.com"
        tel = f"1 ({digits(3)}) {digits(3)}-{digits(4)}"
        forms = [f"{name}@{host}", ".".join(str(x) for x in rng.integers(0, 256, 4)), card, "+" + tel]
        if changed:
            forms = [f"{name}(at){host}", None, "/".join(card[j : j + 4] for j in range(0, 16, 4)), tel]
        form = forms[i % 4] or f"{i % 40 + 1}."
        out.append(f"{story(seed + 2 * i, 12)} {form} {story(seed + 2 * i + 1, 9)}. {i % 30 + 1}. {story(i, 4)}")
    return out


def test_personal_data(spark, edge, nothing, tmp_path):
    learnt = labelled_texts(1200, 1)
    docs = spark.createDataFrame(list(enumerate(learnt)), "doc_id long, text string")
    weights = personal_data.fit(docs, sample=200, steps=250)
    # held out: spans of known form, found by the tagger alone
    texts = labelled_texts(200, 5000)
    got = personal_data.field_spans(weights, texts)
    want = [[(personal_data.PATTERNS.index(k), a, b) for k, a, b in brute_base(t)] for t in texts]
    hits = sum(len(set(g) & set(w)) for g, w in zip(got, want, strict=True))
    assert hits >= 0.95 * sum(map(len, want)) and hits >= 0.95 * sum(map(len, got))
    # forms that no pattern knows
    new = labelled_texts(200, 9000, changed=True)
    added = personal_data.field_spans(weights, new)
    assert not any(brute_base(t) for t in new)
    assert sum(bool(a) for i, a in enumerate(added) if i % 4 != 1) >= 0.8 * 150
    assert sum(bool(a) for i, a in enumerate(added) if i % 4 == 1) <= 2
    # the operator and its query, with rows of every kind
    rows = [(r[0], r[1]) for r in edge_rows()] + [(1000 + i, t) for i, t in enumerate(texts + new)]
    rows += [(5000, "12345 " * 3000 + "end 4111 1111 1111 1111"), (5001, "1.2.3.4.5 a@b.c+1-2345-67890")]
    mixed = spark.createDataFrame([(i, t, 1, "z") for i, t in rows], "doc_id long, text string, spans int, kind string")
    out = personal_data.find_personal_data(mixed, weights).collect()
    assert sorted(str((r.doc_id, [tuple(s) for s in r.spans if not s[0].startswith("field_")])) for r in out) == sorted(
        str((i, brute_base(t or ""))) for i, t in rows
    )
    mixed.write.parquet(str(tmp_path / "documents.parquet"))
    table = QUERIES["op13_personal_data"](spark, str(tmp_path)).collect()
    assert len(table) == len(rows)
    for r in table:
        spans = [s for s in r.spans.split(",") if s]
        base = [s for s in spans if not s.startswith("field_")]
        assert hashlib.sha256(",".join(base).encode()).hexdigest() == r.base_sha256
        assert Counter(s.split(":")[0] for s in base) == +Counter({k: r[f"n_{k}"] for k, _, _ in PATTERNS})
    assert sum("field_" in r.spans for r in table) >= 0.7 * 150
    assert personal_data.find_personal_data(nothing).count() == 0


def test_every_window_is_read(spark):
    rng = np.random.default_rng(5)
    w = char_tagger.Weights.new(4, 12, 24, rng)
    w.out_bias[0] += 0.5
    w = w.lightened()
    ids = rng.integers(0, char_tagger.SYMBOLS, (40, 90)).astype(np.uint8)
    emit = char_tagger.emissions(w, ids)
    reader = char_tagger.Reader(w)
    for some in (ids, ids[:7], ids[::-1]):  # room is used again
        assert np.allclose(reader.scores(some), char_tagger.emissions(w, some), atol=1e-5)
    for gain in (0.0, 0.3, 0.6, 2.0):  # what the bound lets through holds all that is not outside throughout
        some = emit + np.eye(9, dtype=np.float32)[0] * np.float32(gain)
        assert not char_tagger.decode(w, some)[:, ~char_tagger.undecided(w, some)].any()
    assert not char_tagger.undecided(w, emit + np.eye(9, dtype=np.float32)[0] * np.float32(50)).any()
    # windows cover each text, alone and across blocks
    texts = ["", "ab", "x" * 300, "".join(map(chr, rng.integers(32, 300, 250_000)))]
    seen = {}
    for places, rows in personal_data._blocks(texts):
        assert len(places) == len(rows) <= personal_data._AT_ONCE
        for (i, no), row in zip(places, rows, strict=True):
            assert no == seen.get(i, (-1, 0))[0] + 1
            a = no * (personal_data.LONG - personal_data.SHARED)
            own = char_tagger.symbols(texts[i][a : a + personal_data.LONG])
            assert (row[: len(own)] == own).all() and (row[len(own) :] == char_tagger.PAD).all()
            seen[i] = no, a + personal_data.LONG
    assert [seen.get(i, (0, 0))[1] >= len(t) for i, t in enumerate(texts)] == [True] * 4
    # an address without a digit, an @ or an (at), anywhere in a text of any length
    learnt = labelled_texts(1200, 1)
    weights = personal_data.fit(spark.createDataFrame(list(enumerate(learnt)), "doc_id long, text string"), sample=200)
    plain = "das der ein und ist " * 30
    new = [f"{plain[: 7 * i]}wort.{'abcdefgh'[i % 8] * 3} at mail.example.com {plain}" for i in range(60)]
    assert not any(personal_data.stretches(t) for t in new)
    found = personal_data.field_spans(weights, new)
    assert sum(any(t[a:b].endswith("mail.example.com") for k, a, b in f if k == 0) for t, f in zip(new, found, strict=True)) >= 30
    assert found == [personal_data.field_spans(weights, [t])[0] for t in new]  # however texts share blocks


def test_tagger_gradients_and_reconciliation():
    rng = np.random.default_rng(0)
    w = char_tagger.Weights.new(2, 3, 4, rng)
    ids = rng.integers(0, char_tagger.SYMBOLS, (3, 7)).astype(np.uint8)
    tags = np.array([[0, 1, 2, 2, 0, 3, 4]] * 3).T
    loss = lambda: char_tagger.crf_gradients(w, char_tagger.emissions(w, ids), tags)[0]
    keep: list = []
    _, (a, b, c) = char_tagger.crf_gradients(w, char_tagger.emissions(w, ids, keep), tags)
    for own, grad in zip(w.arrays(), [*char_tagger._learn_back(w, keep, a), b, c], strict=True):
        for _ in range(8):
            i = tuple(rng.integers(0, s) for s in own.shape)
            before = own[i]
            own[i] = before + 1e-5
            more = loss()
            own[i] = before - 1e-5
            less = loss()
            own[i] = before
            assert abs((more - less) / 2e-5 - grad[i]) < 1e-6
    # windows that disagree on their overlap are decoded together
    emit = np.zeros((64, 2, 5))
    emit[:, :, 0] = 1
    emit[40, 0, 1], emit[8, 1, 1] = 9.0, 1.1  # the first window is sure of a span, the second is not
    alone = char_tagger.decode(w, emit)
    w.move[:], w.first[:] = 0, 0
    alone = char_tagger.decode(w, emit)
    assert alone[40, 0] == 1
    emit[8, 1, 1] = -9.0
    alone = char_tagger.decode(w, emit)
    whole = personal_data.reconciled(w, emit, alone)
    assert len(whole) == 96 and whole[40] in (0, 1) and not whole[:40].any()


def test_open_windows_are_decoded_together(monkeypatch):
    rng = np.random.default_rng(11)
    w = char_tagger.Weights.new(4, 12, 24, rng).lightened()
    w.out_bias[0] += 0.7
    texts = ["".join(map(chr, rng.integers(32, 127, n))) for n in (9000, 40, 70_000, 300, 60_000)]
    alone = [personal_data.field_spans(w, [t])[0] for t in texts]
    times: list[tuple[int, int]] = []
    decode = char_tagger.decode
    monkeypatch.setattr(personal_data, "decode", lambda w, emit: times.append(emit.shape[:2]) or decode(w, emit))
    assert personal_data.field_spans(w, texts) == alone
    windows = sum(len(personal_data.long_windows(t)) for t in texts)
    assert windows > 2 * personal_data._AT_ONCE and sum(n for time, n in times if time == personal_data.LONG) > 100
    # all open windows at once, and the stretches that disagree by their size
    assert len(times) <= len({time for time, _ in times}) + 1  # the last stretch ends with the last text
    monkeypatch.setattr(personal_data, "_WAIT", 5)  # stretches reach from one decoding into the next
    assert personal_data.field_spans(w, texts) == alone

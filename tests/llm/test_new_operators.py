"""Quality, periodic runs and conversation repair against brute force or held-out labels."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow.dataset as ds
import pytest

from hangar.llm import ann, licenses, quality, registry, repair, runs
from tests.llm.conftest import EDGE

SF = "/root/testdata/sf0.001"


def load(name, sf=SF):
    return ds.dataset(f"{sf}/{name}.parquet").to_table().to_pandas()


# ---- 11 quality ---------------------------------------------------------------------

def test_machine_equals_all_pairs():
    draw = np.random.default_rng(3)
    model = quality.Model(0.2, draw.normal(size=quality.SIZE), draw.normal(size=(quality.SIZE, quality.RANK)))
    found = [quality.features(t, ["9"]) for t in ("a b c a", "", "Und Und Und!\nx %%% y")]
    for (at, x), got in zip(found, quality.predict(model, found)):
        value = model.bias + sum(model.weights[i] * v for i, v in zip(at, x))
        value += sum(model.vectors[at[i]] @ model.vectors[at[j]] * x[i] * x[j]
                     for i in range(len(at)) for j in range(i))
        assert got == pytest.approx(1 / (1 + np.exp(-value)), abs=1e-6)


def test_gradient_steps_learn_an_interaction():
    # neither word tells the label, the pair does
    texts = [("a b", 1), ("a", 0), ("b", 0), ("c", 1)] * 200
    rows = [(np.array(at[:-len(quality.STATISTICS)]), np.array(x[:-len(quality.STATISTICS)]), float(y))
            for t, y in texts for at, x in [quality.features(t, [])]]
    draw = np.random.default_rng(1)
    model = quality.Model(0.0, np.zeros(quality.SIZE), draw.normal(0, 0.05, (quality.SIZE, quality.RANK)))
    for _ in range(30):
        model = quality.train(model, rows)
    got = quality.predict(model, [(a.tolist(), x.tolist()) for a, x, _ in rows[:4]])
    assert (got.round() == [1, 0, 0, 1]).all()


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = registry.QUERIES["op11_quality_fm"](spark, sf).toPandas().set_index("doc_id")
    labels = load("labels", sf).groupby("doc_id").quality.max()
    docs = load("documents", sf)
    assert sorted(got.index) == sorted(docs.doc_id)
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.index]).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()
    held = got.join(labels, how="inner")[lambda r: r.held_out]
    assert held.predicted[held.quality == 1].mean() > 0.98
    assert held.predicted[held.quality == 0].mean() < 0.05
    again = registry.QUERIES["op11_quality_fm"](spark, sf).toPandas().set_index("doc_id")
    assert (again.score - got.score).abs().max() < 1e-6


def test_quality_repeated_ids_and_missing_metadata(spark):
    docs = spark.createDataFrame(
        [(i % 40, f"good words number {i % 40} here") for i in range(400)]
        + [(100 + i, f"%%% ### {i}") for i in range(40)] + [(None, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(40)]
                                   + [(3, 0), (None, 1), (5, None)], "doc_id long, quality int")
    assert quality.training_rows(docs.select("doc_id", *quality.with_meta(docs, ("n_chars",))), labels).count() <= 80
    model = quality.learn(docs, labels)
    rows = {r.text: r.quality_score for r in quality.score(docs, model).collect()}
    assert rows["good words number 7 here"] > 0.7 > rows["%%% ### 7"]
    assert quality.learn(docs, labels.where("quality = 1")).constant == 1.0
    assert quality.learn(docs, labels.limit(0)).constant == 0.5


# ---- 4 nearest neighbours: recall where the share, not the least number, decides ----------

@pytest.mark.parametrize("structured", [False, True])
def test_ann_recall_of_large_blocks(structured):
    draw = np.random.default_rng(9)
    x = draw.standard_normal((3 * ann.BLOCK, 64))
    if structured:
        x = x[draw.integers(0, 900, len(x))] + 0.6 * x
    parts, need, hit = np.array_split(np.arange(len(x)), 3), int(ann.ENOUGH * ann.BLOCK), 0
    assert need > 1.5 * ann.LEAST
    queries = np.arange(0, len(x), 191)
    longest = float(np.sqrt((x * x).sum(1).max()))
    found = [[] for _ in queries]
    for part in parts:
        index = ann.Index(x[part], longest)
        for begin in range(0, len(queries), ann.TOGETHER):
            asked = queries[begin:begin + ann.TOGETHER]
            for k, at in enumerate(index.search(x[asked], need)):
                assert need <= len(at)
                found[begin + k].append(part[at])
    for q, at in zip(queries, found):
        s = x @ x[q]
        s[q] = -np.inf
        hit += len(set(np.argsort(-s)[:20]) & set(np.concatenate(at)))
    assert hit >= 0.9 * 20 * len(queries)


def test_ann_windows_hold_all_copies():
    x = np.random.default_rng(2).standard_normal((3000, 8))
    x[1000:2500] = x[1000]
    index = ann.Index(x, float(np.sqrt((x * x).sum(1).max())))
    assert set(range(1000, 2500)) <= set(index.search(x[1000:1001], 400)[0].tolist())


# ---- 10 licenses: rules, priority and containment by plain loops -----------------------------

def brute_detections(text):
    """(start, order, end, label, level) of the kept detections of a text."""
    norm = " ".join(w for w in re.split(licenses.SEPARATORS, text or "") if w)
    norm = norm.translate({c: c + 32 for c in range(65, 91)})
    hits = []
    for order, r in enumerate(licenses.RULES):
        for m in re.finditer(f"(?<![^ ])(?:{r.pattern})(?![^ ])", norm) if r.keyword in norm else ():
            first = norm[:m.start()].count(" ")
            hits.append((first, order, first + m.group().count(" ") + 1, r.label, r.level))
    kept = []
    for h in hits:
        rank = lambda x: (x[0], -x[2], -x[4], x[1])
        inside = any(o is not h and o[0] <= h[0] and h[2] <= o[2] and o[4] >= h[4] and rank(o) < rank(h) for o in hits)
        if not inside:
            kept.append(h)
    return sorted(kept, key=lambda h: (h[0], -h[2], -h[4], h[1]))


def test_license_rules_equal_plain_loops(spark):
    parts = ["mit license", "licensed under the apache license version 2 0", "Apache License", "GNU", "General Public License",
             "v3 or later", "SPDX-License-Identifier:", "Apache-2.0", "BSD 3-Clause", "the", "mitigate", "mit",
             "released under the terms of the", "lesser general public license v2.1", "all rights reserved", "public domain",
             "released into the public domain", "license", "CC BY-SA 4.0", "creative commons attribution", "Open RAIL-M", "."]
    draw = random.Random(4)
    texts = [" ".join(draw.choices(parts, k=draw.randint(1, 14))) for _ in range(300)] + [None, ""]
    texts += list(load("documents").text)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [tuple(h) for h in r.detections] for r in licenses.scan(rows).collect()}
    assert sum(map(bool, got.values())) > 250
    for i, text in enumerate(texts):
        # the scan reads a text only if a keyword starts a word of it
        assert got[i] == brute_detections(text), text


# ---- 12 periodic runs -----------------------------------------------------------------

def brute_runs(w, least=12):
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(least, 2 * q) and i > s:
                out.append((s, i + q - s, q))
            i = max(i, s + 1) if i > s else s + 1
    first = {}
    for s, length, q in out:
        first.setdefault((s, length), q)
    return sorted((s, length, q) for (s, length), q in first.items())


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_equal_brute_force(least):
    draw = random.Random(least)
    for _ in range(400):
        texts = []
        for _ in range(draw.randint(1, 4)):
            n, k = draw.randint(0, 70), draw.choice([1, 2, 2, 3, 6])
            w = [f"w{draw.randrange(k)}" for _ in range(n)]
            if n and draw.random() < 0.5:
                a, p = draw.randrange(n), draw.randint(1, 9)
                w = w[:a] + [w[min(n - 1, a + i % p)] for i in range(n - a)]
            texts.append(w)
        assert runs.runs_of_texts(texts, least) == [
            sorted(brute_runs(w, least), key=lambda r: (r[0], r[2])) for w in texts]


def test_runs_of_long_periodic_texts_stay_fast():
    began = time.time()
    same = ["x"] * 200_000
    fib = ["a", "b"]
    while len(fib) < 50_000:
        fib = fib + fib[:len(fib) * 34 // 55]
    found = runs.runs_of_texts([same, ["a", "b", "c"] * 60_000, fib])
    assert found[0] == [(0, 200_000, 1)] and found[1] == [(0, 180_000, 3)] and found[2]
    assert time.time() - began < 120


def expected_runs(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = sorted(brute_runs(words), key=lambda r: (r[0], r[2])) if n < 3000 else None
    return words, found


@pytest.mark.parametrize("edge", [False, True])
def test_op12(spark, edge_dir, edge):
    folder = edge_dir if edge else SF
    docs = [(r[0], r[1]) for r in EDGE] if edge else list(load("documents")[["doc_id", "text"]].itertuples(index=False))
    got = sorted(map(tuple, registry.QUERIES["op12_periodic_runs"](spark, folder).collect()), key=str)
    want, seen = [], Counter()
    for doc_id, text in docs:
        words, found = expected_runs(doc_id, text)
        if found is None:
            continue
        gone = {i for s, length, q in found for i in range(s + q, s + length)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        row = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
        want.append((doc_id, len(found), *row, hashlib.sha256(lines.encode()).hexdigest(),
                     hashlib.sha256(kept.encode()).hexdigest()))
        seen[len(found) > 0] += 1
    assert len(got) == len(docs) and not Counter(want) - Counter(got)
    assert edge or seen[True] > 5


# ---- 13 conversation repair --------------------------------------------------------------

def cheapest(codes):
    """All prefixes by (cost, audit), best first."""
    heap, done = [(0, "", 0, 0)], set()
    while heap:
        cost, audit, row, state = heapq.heappop(heap)
        if (row, state) in done:
            continue
        done.add((row, state))
        if row == len(codes) and state in (0, 3):
            return repair.Repair(cost, audit)
        turn = {0: 2, 1: 2, 2: 3, 3: 2}[state]
        heapq.heappush(heap, (cost + 2, audit + "I", row, turn))
        if row < len(codes):
            initial, fault = "sua-"[codes[row] // 4], codes[row] % 4
            heapq.heappush(heap, (cost + 3, audit + "D", row + 1, state))
            if fault > 1:
                heapq.heappush(heap, (cost + 2 + (fault == 2), audit + "R", row + 1, turn))
                kept = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}.get((state, initial))
                if kept:
                    heapq.heappush(heap, (cost + (fault == 2), audit + "K", row + 1, kept))


def test_search_equals_shortest_path():
    draw = random.Random(5)
    for _ in range(4000):
        codes = bytes(draw.choices(range(16), k=draw.randint(1, 9)))
        assert repair.search(codes) == cheapest(codes), list(codes)
    for n in (40, 200):
        codes = bytes(draw.choices([3, 7, 7, 11, 11, 6, 10, 4, 15], k=n))
        assert repair.search(codes) == cheapest(codes)


def test_search_of_a_long_conversation_is_linear():
    draw, times = random.Random(6), []
    for n in (20_000, 80_000):
        codes = bytes(draw.choices(range(16), k=n))
        began = time.time()
        assert len(repair.search(codes).audit) >= n
        times.append(time.time() - began)
    assert times[1] < 12 * times[0] + 1


def expected_repair(rows):
    """op13's row (without conv_id) of a conversation's rows (conv_id, turn, role, text)."""
    after = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            after += [(turn, "user" if kind == 4 else role, text)] * (1 + (kind == 3))
    if not after:
        return (0,) * 6 + ("", hashlib.sha256(b"").hexdigest())
    after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = [t for t, _, _ in after if t is not None]
    codes, seen, faults = [], set(), Counter()
    for _, role, text in after:
        last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        fault = 0 if not last else 1 if (role, text) in seen else 2 if last not in ".!?" else 3
        seen.add((role, text))
        faults[fault] += 1
        codes.append(4 * ("sua-".index(role[:1]) if role[:1] in tuple("sua") else 3) + fault)
    found = cheapest(bytes(codes))
    out, state, row = [], "", 0
    for e in found.audit:
        turn = "assistant" if state == "u" else "user"
        if e == "I":
            out.append((turn, ""))
        else:
            if e != "D":
                out.append((after[row][1] if e == "K" else turn, after[row][2]))
            row += 1
        state = out[-1][0][:1] if out else ""
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(after, after[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, faults[0], faults[1], faults[2], illegal, found.cost, found.audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def test_op13(spark, tmp_path):
    draw = random.Random(8)
    rows = [tuple(r) for r in load("conversations")[["conv_id", "turn", "role", "text"]].itertuples(index=False)]
    texts = ["Yes.", "No", "", " \n", "Ä!", "what?  ", None, "a\nb.", "…"]
    for conv in [None, *range(10_000, 10_120)]:
        for t in range(draw.randint(1, 12)):
            turn = draw.choice([t, t, t, 3, None])
            rows.append((conv, turn, draw.choice(["user", "assistant", "assistant", "system", "tool", "", None]),
                         draw.choice(texts)))
    rows += [(77_777, t, "user" if t % 2 == 0 else "assistant", f"t{t}.") for t in range(2_500)]
    spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, place string"
                          ).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r[0]: tuple(r)[1:] for r in registry.QUERIES["op13_conversation_repair"](spark, str(tmp_path)).collect()}
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    assert set(got) == set(by)
    for conv, own in by.items():
        assert got[conv] == expected_repair(own), conv

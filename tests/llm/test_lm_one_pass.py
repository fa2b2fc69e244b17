"""LM scoring (operator 9): one pass over the texts, however many waves the filter has."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from hangar.llm import lm
from hangar.llm.common import staged

KIND = "doc_id long, held_out boolean, text string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    words = [f"w{int(rng.paretovariate(0.6)) % 5000}" for _ in range(9000)]
    texts = [" ".join(words[i:i + rng.randrange(60)]) for i in range(0, 9000, 60)]
    texts += [*texts[:5], "", " \n", None, "Only Once", "w1 w1 w1"]
    return [(i, i % 7 == 0, t or "") for i, t in enumerate(texts)] + [
        (3, False, texts[3]), (None, True, "no id"), (None, False, "no id")]


def key(r):
    return (r[0] is None, r[0] or 0, r[1], *r[2:])


@pytest.fixture(scope="module")
def trained(spark, rows):
    return lm.train_model(spark.createDataFrame(rows, KIND).where("NOT held_out"))


def plain(rows, model, total):
    """The same scores, text by text, from the filters and exact counts of the model."""
    parts = {r.segment: r for r in model.collect()}
    count = {w % 2**64: n for r in parts.values() for w, n in zip(r.words, r.counts)}

    def probed(grams):
        seg = lm.segment_of(grams, total["segments"])
        return np.array([lm.probe(np.frombuffer(parts[s].bits, np.uint8), grams[i:i + 1])[0]
                         if s in parts else 0 for i, s in enumerate(seg.tolist())])

    out = []
    for i, held, text in rows:
        toks = lm.tokens(text)
        n = np.array([count.get(w, 0) for w in toks.tolist()])
        base = sum(math.log10((x + lm.ALPHA) / (total["tokens"] + lm.ALPHA * (total["distinct"] + 1)))
                   for x in n.tolist())
        w, p = lm.spread(probed(toks)), lm.spread(probed(lm.pairs(toks)))
        score = 0.0
        for k in range(len(toks)):
            before = w[k - 1]  # the end stands before the first word
            fits = (w[k] + lm.ALPHA) / (total["mass"] + lm.ALPHA * (total["distinct"] + 1))
            if before > 0:
                fits = lm.MIX * p[k] / max(before, p[k], 1.0) + (1 - lm.MIX) * fits
            score += math.log10(fits)
        out.append((i, held, len(toks), int((n > 0).sum()), total["tokens"], base, score))
    return out


@pytest.mark.parametrize("head,wave,flush", [(lm.HEAD, lm.WAVE_BYTES, lm.FLUSH), (20, 1, 40), (0, 1, 1)])
def test_scores_of_chunks_and_waves(spark, rows, trained, monkeypatch, head, wave, flush):
    monkeypatch.setattr(lm, "FLUSH", flush)  # texts in many chunks
    model, total = trained
    got = sorted((tuple(r) for r in lm.score(spark.createDataFrame(rows, KIND), model, total, head, wave)
                  .collect()), key=key)
    want = sorted(plain(rows, model, total), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9, atol=0)


def test_passes_do_not_grow_with_the_waves(spark, rows, trained, monkeypatch):
    model, total = trained
    names = []
    monkeypatch.setattr(lm, "staged", lambda df, name: names.append(name) or staged(df, name))
    docs, passes = spark.createDataFrame(rows, KIND), []
    for wave in (lm.WAVE_BYTES, 1):
        names.clear()
        lm.score(docs, model, total, 20, wave).count()
        passes.append(list(names))
    assert len(lm.waves(model, 1)) >= 8 and passes[0] == passes[1] and len(passes[0]) < 8


def test_no_empty_rows_for_segments(spark):
    train = spark.createDataFrame([("ab cd",)], "text string")
    found = lm.count_grams(train, 1000).collect()
    assert 0 < len(found) <= 6 and all(r.w or r.p for r in found)


def test_no_training_rows(spark):
    none = spark.createDataFrame([], KIND)
    model, total = lm.train_model(none)
    assert lm.score(none, model, total).count() == 0
    r = lm.score(spark.createDataFrame([(1, True, "a b")], KIND), model, total).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)


def test_shuffles_go_and_the_setting_stays(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    assert lm.settled(spark.range(100).groupBy("id").count(), "lm_test").count() == 100
    assert spark.conf.get(key, None) == before

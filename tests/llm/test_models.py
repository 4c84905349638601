"""Quality filters, packing, license scan and language model."""

import random
import re
from collections import Counter
from itertools import combinations
from math import log

import numpy as np
import pyarrow as pa
import pytest

from lumenfold.llm import gru, license_scan, packing, quality
from lumenfold.llm import words as W
from lumenfold.llm.license_rules import RULES

GOOD = "the quick brown fox jumps over lazy dogs while seven wizards quietly mix potions beneath old stone bridges".split()
BAD = "idiot scum trash junk spam".split()


def labelled(n=200, seed=0):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(GOOD) for _ in range(rng.randrange(10, 60))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                w[rng.randrange(len(w))] = rng.choice(BAD)
        docs.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def frames(spark, docs, labels):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_ratio_against_brute_force(spark):
    docs, labels = labelled(80)
    d, lab = frames(spark, docs, labels)
    for limit in (0, 1 << 20):  # the join that shuffles and the one that broadcasts
        got = {r["doc_id"]: (r["score"], r["keep"]) for r in quality.importance_scores(d, lab, broadcast_ids=limit).collect()}
        grams = {}
        for i, t in docs:
            own, w = [], t.split()
            for x in w:
                own += [x] + [(k, x[:k]) for k in (4, 5) if len(x) > k]
            grams[i] = own + list(zip(w, w[1:]))
        added = lambda g: 300 if isinstance(g, tuple) and isinstance(g[0], str) else 3
        corpus = Counter(g for own in grams.values() for g in own)
        target = Counter(g for i, _, toxic in labels if not toxic for g in grams[i])
        scale = sum(target.values()) / sum(corpus.values())
        for i, own in grams.items():
            want = sum(log(target[g] + added(g)) - log(corpus[g] * scale + added(g)) for g in own) / len(own)
            assert got[i][0] == pytest.approx(want, abs=2e-6) and got[i][1] == (got[i][0] >= quality.RATIO_THRESHOLD)


def test_classifier_on_held_out_documents(spark):
    docs, labels = labelled(400)
    d, lab = frames(spark, docs, labels[:200])
    model = quality.fit_classifier(d, lab)
    got = {r["doc_id"]: r["keep"] for r in quality.classify(d, model).collect()}
    right = sum(got[i] == (not toxic) for i, _, toxic in labels[200:])
    assert right / 200 >= 0.97
    kept = {r["doc_id"] for r in quality.keep_good(d, model).collect()}
    assert kept == {i for i, k in got.items() if k}


def test_classifier_against_plain_python(spark):
    """Sets, ratios, scaling, dual coordinate descent and margins, all done again with dicts and floats."""
    docs, labels = labelled(60, seed=4)
    extra = [(100, "the the quick!! fox"), (101, "é idiot"), (102, None), (103, " \n "), (None, "quick fox"), (5, docs[5][1])]
    d, lab = frames(spark, [*docs, *extra], labels[:40])
    buckets, mask = 1 << 12, (1 << 12) - 1
    mix = lambda parts, salt: int(W.combine([np.array([x], np.uint64) for x in parts], salt)[0])

    def grams(text):
        toks = re.findall(r"[a-zA-Z0-9é]+|[^a-zA-Z0-9é\s]+", text or "")
        h = [W.hash_one(t.encode()) for t in toks]
        return sorted({x & mask for x in h} | {mix(x, 2) & mask for x in zip(h, h[1:])} | {mix([W.hash_one(t.encode()[:k])], k) & mask for t in toks for k in (4, 5) if len(t.encode()) > k})

    known = [(grams(t), 1 if not labels[i][2] else -1) for i, t in docs[:40]]
    count = {y: Counter(b for g, z in known if z == y for b in g) for y in (1, -1)}
    scale = sum(count[-1].values()) / sum(count[1].values())
    ratio = {b: log(count[1][b] * scale + 5) - log(count[-1][b] + 5) for b in range(buckets)}
    x = [{b: ratio[b] / max(sum(ratio[k] ** 2 for k in g) ** 0.5, 1e-12) for b in g} for g, _ in known]
    w, bias, alpha = Counter(), 0.0, [0.0] * 40
    cost = {y: 3.0 * 40 / (2 * sum(z == y for _, z in known)) for y in (1, -1)}
    rng = np.random.default_rng(3)
    for _ in range(12):
        for i in rng.permutation(40):
            y = known[i][1]
            gradient = y * (sum(w[b] * v for b, v in x[i].items()) + bias) - 1
            new = min(max(alpha[i] - gradient / (sum(v * v for v in x[i].values()) + 1), 0.0), cost[y])
            for b, v in x[i].items():
                w[b] += (new - alpha[i]) * y * v
            bias += (new - alpha[i]) * y
            alpha[i] = new
    got = quality.classify(d, quality.fit_classifier(d, lab, buckets=buckets)).collect()
    texts = [*docs, *extra]
    assert len(got) == len(texts)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    for i, t in texts:
        g = grams(t)
        for r in by[i]:
            if not g:
                assert r["score"] is None and not r["keep"]
                continue
            norm = sum(ratio[b] ** 2 for b in g) ** 0.5
            want = sum(w[b] * ratio[b] for b in g) / max(norm, 1e-12) + bias
            assert r["score"] == pytest.approx(want, abs=1e-4) and r["keep"] == (r["score"] >= 0.1)


def test_labels_of_one_kind_keep_everything(spark):
    docs, labels = labelled(40)
    d, lab = frames(spark, [*docs, (50, " \n"), (51, ""), (52, None)], labels)
    for known in (lab.limit(0), lab.where("toxic = 0"), lab.where("toxic = 1"), lab.withColumn("doc_id", lab["doc_id"] + 1000)):
        model = quality.fit_classifier(d, known)
        assert {r["doc_id"] for r in quality.classify(d, model).where("keep").collect()} == set(range(40))
        assert {r["doc_id"] for r in quality.keep_good(d, model).collect()} == set(range(40))


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(0)
    x = (rng.random((60, 12)) < 0.4).astype(float)
    y = np.where(x[:, 0] + x[:, 1] > x[:, 2] + 0.5, 1.0, -1.0)
    w, b = quality.dual_coordinate_descent([np.flatnonzero(r).astype(np.int32) for r in x], np.ones(12), y, cost=1.0, epochs=300)
    z = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    c = len(y) / (2 * np.where(y > 0, (y > 0).sum(), (y < 0).sum()))
    loss = lambda w, b: 0.5 * (w @ w + b * b) + (c * np.maximum(0, 1 - y * (z @ w + b))).sum()
    best = loss(w, b)
    assert all(best <= loss(w + rng.normal(size=12) * s, b + rng.normal() * s) + 1e-6 for s in (0.3, 0.1, 0.01) for _ in range(50))


def test_a_sample_bounds_the_fit(spark):
    docs, labels = labelled(300)
    d, lab = frames(spark, docs, labels)
    model = quality.fit_classifier(d, lab, max_labelled=120)
    got = {r["doc_id"]: r["keep"] for r in quality.classify(d, model).collect()}
    assert sum(got[i] == (not toxic) for i, _, toxic in labels) / 300 >= 0.9


def test_nnls_solves_and_patterns_fill():
    rng = np.random.default_rng(1)
    a, x = rng.random((12, 7)), np.maximum(rng.normal(size=7), 0)
    assert np.allclose(packing.nnls(a, a @ x), x, atol=1e-6)
    b = rng.normal(size=12)
    x = packing.nnls(a, b)
    best = min(np.linalg.lstsq(a[:, at], b)[1].sum() for n in range(1, 8) for at in map(list, combinations(range(7), n)) if (np.linalg.lstsq(a[:, at], b)[0] >= 0).all())
    assert ((a @ x - b) ** 2).sum() == pytest.approx(best)
    gradient = a.T @ (b - a @ x)
    assert (x >= 0).all() and (gradient <= 1e-6).all() and np.allclose(gradient[x > 0], 0, atol=1e-6)
    found = packing.patterns(12)
    assert len(found) == len(set(found)) and all(sum(p) == 12 and list(p) == sorted(p, reverse=True) for p in found)
    assert len(found) == 1 + 6 + sum(1 for i in range(1, 12) for j in range(1, i + 1) for k in range(1, j + 1) if i + j + k == 12)


@pytest.mark.parametrize("seed", range(4))
def test_a_plan_holds_the_histogram(seed):
    rng = np.random.default_rng(seed)
    h = np.concatenate([[0], rng.integers(0, 50, 32) * (rng.random(32) < 0.7)])
    steps = packing.plan(h, 32)
    held = Counter()
    for p, n in steps:
        assert sum(p) <= 32 and n > 0
        for b in p:
            held[b] += n
    assert all(held[b] == h[b] for b in range(33))
    assert sum(n for _, n in steps) <= 1.05 * sum(n for _, n in packing.best_fit(h, 32)) + 2


def fewest(items, bins):
    """Least number of packs of ``bins`` for some lengths, by trying all ways."""
    best = len(items)

    def put(k, room):
        nonlocal best
        if len(room) >= best:
            return
        if k == len(items):
            best = len(room)
            return
        for r in sorted({r for r in room if r >= items[k]}):
            left = list(room)
            left.remove(r)
            put(k + 1, [*left, r - items[k]])
        put(k + 1, [*room, bins - items[k]])

    put(0, [])
    return best


def test_plans_are_near_the_optimum():
    rng = np.random.default_rng(6)
    more = 0
    for _ in range(60):
        items = sorted(rng.integers(1, 13, rng.integers(1, 12)).tolist(), reverse=True)
        used = sum(n for _, n in packing.plan(np.bincount(items, minlength=13), 12))
        least = fewest(items, 12)
        assert least <= used <= least + 1
        more += used - least
    assert more <= 3


def test_packs_do_not_depend_on_partitions(spark):
    rng = random.Random(12)
    rows = [(i, "w " * rng.randrange(1, 200)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one, other = ([tuple(map(str, r)) for r in packing.pack_documents(docs.repartition(n), seq_len=64, width=4).collect()] for n in (1, 7))
    assert sorted(one) == sorted(other)


def test_packing_places_every_token_once(spark):
    rng = random.Random(2)
    sizes = [0, 1, 63, 64, 65, 128, 129, 1000] + [rng.randrange(1, 90) for _ in range(300)]
    docs = spark.createDataFrame([(i, "w " * n) for i, n in enumerate(sizes)], "doc_id long, text string").repartition(5)
    packs = packing.pack_documents(docs, seq_len=64, width=4).collect()
    seen = Counter()
    for p in packs:
        assert p["used"] == sum(p["lengths"]) <= 64
        assert sum(-(-n // 4) for n in p["lengths"]) <= 16
        for d, s, n in zip(p["doc_ids"], p["starts"], p["lengths"]):
            seen.update((d, k) for k in range(s, s + n))
    assert set(seen.values()) == {1} and len(seen) == sum(sizes)
    assert len({p["pack_id"] for p in packs}) == len(packs) <= 1.1 * sum(-(-n // 4) for n in sizes) / 16 + 2


SAMPLES = [
    "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
    "SPDX-License-Identifier: GPL-2.0-or-later", "Permission is hereby granted, free of charge, to any person obtaining a copy of this",
    "released under the 3-clause BSD license, see https://opensource.org/licenses/BSD-3-Clause", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International",
    "This work is licensed under CC BY-NC-SA 4.0. All rights reserved.", "Copyright (c) 2001, 2004-2006 by nobody", "mit license MIT LICENSE Mit Licence", "dual-licensed under MIT and Apache License 2.0",
]


def test_license_rules_are_sound():
    assert len(RULES) >= 400 and len({r.rule_id for r in RULES}) == len(RULES) and all(r.keyword == r.keyword.lower() for r in RULES)


def test_license_scan_is_that_of_all_rules():
    rng = random.Random(3)
    texts = SAMPLES + ["filler " * rng.randrange(5) + " ".join(rng.sample(SAMPLES, 3)) + " tail" for _ in range(40)]
    patterns, _ = license_scan._compiled()
    for t in texts:
        short, begin, move = license_scan.squeezed(t)
        real = [k + max(m for b, m in zip(begin, move) if b <= k) for k in range(len(short))]
        found = [(real[m.start()], real[m.end() - 1] + 1, i) for i, p in enumerate(patterns) for m in p.finditer(short)]
        kept = []
        for d in sorted(found, key=lambda d: (-RULES[d[2]].priority, d[0] - d[1], d[2], d[0])):
            if not any(k[0] <= d[0] and d[1] <= k[1] for k in kept):
                kept.append(d)
        assert license_scan.scan(t) == sorted(kept)
    said = {RULES[i].license for _, _, i in license_scan.scan(SAMPLES[0])}
    assert said == {"Apache-2.0"}
    assert [RULES[i].rule_id for _, _, i in license_scan.scan(SAMPLES[1])] == ["spdx:GPL-2.0-or-later"]


WRAPPED = {
    "BSD-3-Clause": "/*\n * Neither the name of the copyright holder nor the names of its\n * contributors may be used to endorse or promote products\n * derived from this software\n */",
    "GPL-2.0-or-later": "# under the terms of the GNU General Public License as published by the Free\n# Software Foundation; either version 2 of the License, or\n# (at your option) any later version.",
    "GPL-Unspecified": "the GNU   General\n\tPublic  License",
    "Apache-2.0": "// Licensed under the Apache\n// License, Version 2.0",
    "MIT": "Permission is hereby granted, free of\ncharge, to any person obtaining a\r\ncopy",
}


@pytest.mark.parametrize("name", WRAPPED)
def test_wrapped_headers_are_found(name):
    text = WRAPPED[name]
    found = license_scan.scan(text)
    assert name in {license_scan.license_of(k, text[s:e]) for s, e, k in found}
    assert all(0 <= s < e <= len(text) and not text[s].isspace() and not text[e - 1].isspace() for s, e, _ in found)


@pytest.mark.parametrize("said,want", [("MIT OR Apache-2.0", "MIT OR Apache-2.0"), ("(MIT AND\n BSD-3-Clause)", "(MIT AND BSD-3-Clause)"), ("GPL-2.0+", "GPL-2.0+"), ("GPL-2.0-only WITH Classpath-exception-2.0", "GPL-2.0-only WITH Classpath-exception-2.0"), ("MIT", "MIT"), ("LicenseRef-own", "LicenseRef-own")])
def test_spdx_expressions_are_read_whole(said, want):
    text = f"x\n// SPDX-License-Identifier: {said}\nint main()"
    ((s, e, k),) = license_scan.scan(text)
    assert license_scan.license_of(k, text[s:e]) == want and text[s:e].endswith(said)


def test_many_detections_resolve_quickly():
    rng = random.Random(8)
    found = [(s := rng.randrange(400), s + rng.randrange(1, 60), rng.randrange(len(RULES))) for _ in range(700)]
    kept = []
    for d in sorted(set(found), key=lambda d: (-RULES[d[2]].priority, d[0] - d[1], d[2], d[0])):
        if not any(k[0] <= d[0] and d[1] <= k[1] for k in kept):
            kept.append(d)
    assert license_scan.resolve(found) == sorted(kept)
    text = "mit license, " * 100_000
    assert len(license_scan.scan(text)) == 100_000


def small_model(seed=0):
    rng = np.random.default_rng(seed)
    hashes = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    v = gru.Vocabulary(hashes, np.arange(90, 60, -1), np.full(gru.RARE, 5), 4)
    p = {k: a.astype(np.float64) for k, a in gru.initial(v.size, v.classes, 6, seed).items()}
    return p, v, rng


def slow_score(p, v, tokens):
    """Log-likelihood of one document, a token and a plain softmax at a time."""
    h, total, last = np.zeros(6), 0.0, v.begin
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    for t in tokens:
        x, g = p["e"][last] @ p["wx"] + p["b"], h @ p["wh"]
        z, r = sigmoid(x[:6] + g[:6]), sigmoid(x[6:12] + g[6:12])
        c = np.tanh(x[12:] + r * g[12:])
        h = z * h + (1 - z) * c
        logits = h @ p["wc"] + p["bc"]
        cls = v.class_of[t]
        total += logits[cls] - np.log(np.exp(logits).sum())
        lo, hi = v.cut[cls], v.cut[cls + 1]
        logits = p["wo"][lo:hi] @ h + p["bo"][lo:hi]
        total += logits[t - lo] - np.log(np.exp(logits).sum())
        last = t
    return total


def test_scores_are_those_of_single_steps(monkeypatch):
    p, v, rng = small_model()
    p = {k: a.astype(np.float32) for k, a in p.items()}
    sizes = np.array([0, 1, 5, 200, 33, 64, 0, 7])
    tokens = rng.integers(0, v.size, sizes.sum()).astype(np.int16)
    bound = np.concatenate([[0], np.cumsum(sizes)])
    want = [slow_score(p, v, tokens[a:b]) for a, b in zip(bound, bound[1:])]
    for most in (1, 3, 512):
        monkeypatch.setattr(gru.windows, "__defaults__", (most,))
        assert np.allclose(gru.score(p, v, tokens, sizes), want, rtol=1e-4)
    assert np.exp([slow_score(p, v, [t]) for t in range(v.size)]).sum() == pytest.approx(1.0)


def test_gradients_are_right():
    p, v, rng = small_model(1)
    sizes = np.array([9, 4, 12])
    tokens = rng.integers(0, v.size, sizes.sum()).astype(np.int16)
    (window,) = list(gru.windows(tokens, sizes, v.begin))
    x, target, first, _, real = window
    some = np.flatnonzero(real.reshape(-1))

    def run(p, grad=None):
        run = gru.forward(p, p["e"] @ p["wx"] + p["b"], x, first, np.zeros((6, x.shape[1])))
        log_p, d = gru.output(p, v, run[0].transpose(0, 2, 1).reshape(-1, 6)[some], target.reshape(-1)[some], grad)
        if grad is not None:
            dh = np.zeros((x.size, 6))
            dh[some] = d
            gru.backward(p, x, first, run, dh.reshape(*x.shape, 6).transpose(0, 2, 1), grad)
        return -log_p.astype(np.float64).sum()

    grad = {k: np.zeros_like(a) for k, a in p.items()}
    run(p, grad)
    for k, a in p.items():
        flat = a.reshape(-1)
        for i in rng.choice(a.size, min(6, a.size), replace=False):
            old = flat[i]
            flat[i] = old + 1e-2
            up = run(p)
            flat[i] = old - 1e-2
            down = run(p)
            flat[i] = old
            assert grad[k].reshape(-1)[i] == pytest.approx((up - down) / 2e-2, abs=2e-2, rel=5e-2), k


def test_language_model_learns_a_chain(spark):
    """Most of what lies between the plain frequencies and the chain's own entropy is learned."""
    rng = random.Random(5)
    rows = []
    for i in range(2100):
        w, s = [], rng.randrange(len(GOOD))
        for _ in range(120):
            w.append(GOOD[s])
            s = (s + 1) % len(GOOD) if rng.random() < 0.9 else rng.randrange(len(GOOD))
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    model = gru.fit(docs.where("doc_id < 2000"), words=64, classes=4, rounds=2, lanes=16, step=512)
    got = gru.score_documents(docs, model).where("doc_id >= 2000").collect()
    assert len(got) == 100 and all(r["n_tokens"] == 120 for r in got)
    n = len(GOOD)
    entropy = -(0.9 + 0.1 / n) * log(0.9 + 0.1 / n) - 0.1 * (n - 1) / n * log(0.1 / n)
    assert np.mean([r["per_token"] for r in got]) > -log(n) + 0.8 * (log(n) - entropy)


def test_training_carries_the_state_through_long_documents():
    """Without steps, the trainer's loss is that of whole documents, whatever the lanes and batches."""
    p, v, rng = small_model(2)
    p = {k: a.astype(np.float32) for k, a in p.items()}
    sizes = np.array([5000, 3, 0, 70, 2500, 33, 64, 1, 400])
    tokens = rng.integers(0, v.size, sizes.sum()).astype(np.int16)
    bound = np.concatenate([[0], np.cumsum(sizes)])
    want = -sum(slow_score(p, v, tokens[a:b]) for a, b in zip(bound, bound[1:]))
    for most, cut in ((1, [9]), (2, [9]), (3, [2, 7]), (8, [4, 3, 2]), (512, [1] * 9)):
        trainer = gru.Trainer({k: a.copy() for k, a in p.items()}, v, lanes=most, rate=0.0)
        at = 0
        for n in cut:
            trainer.feed(tokens[bound[at] : bound[at + n]], sizes[at : at + n])
            at += n
        trainer.finish()
        assert trainer.tokens == sizes.sum() and trainer.loss == pytest.approx(want, rel=1e-4)


@pytest.mark.parametrize("step", [1, 100])
def test_training_is_that_of_one_lane(step):
    """Against a plain loop: one document after the other, windows of a lane, Adam by its definition."""
    p, v, rng = small_model(3)
    sizes = np.array([2100, 40, 7])
    tokens = rng.integers(0, v.size, sizes.sum()).astype(np.int16)
    trainer = gru.Trainer({k: a.copy() for k, a in p.items()}, v, lanes=1, step=step)
    trainer.feed(tokens, sizes)
    got = trainer.finish()

    stream = [(v.begin if i == 0 else tokens[lo + i - 1], tokens[lo + i], i == 0) for lo, n in ((0, 2100), (2100, 40), (2140, 7)) for i in range(n)]
    state, seen, t = np.zeros(6), 0, 0
    grad, m, s = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(3))
    for lo in range(0, len(stream), gru.WINDOW):
        part, h, kept = stream[lo : lo + gru.WINDOW], state, []
        for x, y, first in part:  # forward, a token at a time
            h = h * (not first)
            a, g = p["e"][x] @ p["wx"] + p["b"], h @ p["wh"]
            z, r = 1 / (1 + np.exp(-a[:6] - g[:6])), 1 / (1 + np.exp(-a[6:12] - g[6:12]))
            c = np.tanh(a[12:] + r * g[12:])
            after = z * h + (1 - z) * c
            kept.append((x, y, first, h, z, r, c, g[12:], after))
            h = after
        state, dh = h, np.zeros(6)
        for x, y, first, before, z, r, c, gn, after in reversed(kept):
            k = v.class_of[y]
            lo_, hi = v.cut[k], v.cut[k + 1]
            for w, b, rows, hit in ((p["wc"].T, p["bc"], "c", k), (p["wo"][lo_:hi], p["bo"][lo_:hi], "o", y - lo_)):
                q = np.exp(w @ after + b)
                q /= q.sum()
                q[hit] -= 1
                dh = dh + q @ w
                if rows == "c":
                    grad["wc"] += np.outer(after, q)
                    grad["bc"] += q
                else:
                    grad["wo"][lo_:hi] += np.outer(q, after)
                    grad["bo"][lo_:hi] += q
            da = dh * (1 - z) * (1 - c * c)
            d = np.concatenate([dh * (before - c) * z * (1 - z), da * gn * r * (1 - r), da])
            dg = np.concatenate([d[:12], da * r])
            grad["wh"] += np.outer(before, dg)
            grad["wx"] += np.outer(p["e"][x], d)
            grad["b"] += d
            grad["e"][x] += p["wx"] @ d
            dh = (dh * z + p["wh"] @ dg) * (not first)
        seen += len(part)
        if seen >= step or lo + gru.WINDOW >= len(stream):
            t += 1
            for k in p:
                g = grad[k] / seen
                m[k], s[k] = 0.9 * m[k] + 0.1 * g, 0.98 * s[k] + 0.02 * g * g
                p[k] = p[k] - 0.01 * min(1, seen / 1024) * np.sqrt(1 - 0.98**t) / (1 - 0.9**t) * m[k] / (np.sqrt(s[k]) + 1e-6)
                grad[k][...] = 0
            seen = 0
    for k in p:
        assert np.allclose(got[k], p[k], rtol=1e-5, atol=1e-6), k


def test_every_rare_word_has_its_own_likelihood(spark):
    rows = [(i, " ".join(GOOD) + f" rare{i} rare{i % 7}x") for i in range(60)] + [(90, None), (91, ""), (None, "the quick rare3x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    p, v, counts = gru.fit(docs, words=8, classes=2, rounds=1)
    words = Counter(w for _, t in rows for w in (t or "").split())
    tokens = sum(words.values())
    assert len(v.sorted) == max(8, sum(n >= 0.5 * tokens**0.5 for n in words.values())) > 8
    same = [" ".join(GOOD[:3]) + " " + w for w in (*words, "unknown")]
    got = gru.score_documents(spark.createDataFrame(list(enumerate(same)), "doc_id long, text string").repartition(2), (p, v, counts)).collect()
    hashes = {w: gru._hashed(pa.array([w]))[0] for w in (*words, "unknown")}
    rare = [w for w, h in hashes.items() if v.is_rare[v.ids(h)[0]]]
    total = Counter()
    for w in rare:
        total[int(hashes[w][0] % np.uint64(gru.RARE))] += words[w]
    assert len(rare) > 50
    for r in got:
        text = same[r["doc_id"]]
        h, sizes = gru._hashed(pa.array([text]))
        want = gru.score(p, v, v.ids(h), sizes)[0]
        if (w := text.split()[-1]) in rare:
            want += log(max(1, words[w]) / (total[int(hashes[w][0] % np.uint64(gru.RARE))] + 1))
        assert r["log_likelihood"] == pytest.approx(want, rel=1e-4) and r["per_token"] == pytest.approx(r["log_likelihood"] / 4)
    got = {r["doc_id"]: r for r in gru.score_documents(docs, (p, v, counts)).collect()}
    assert len(got) == 63 and got[90]["log_likelihood"] is None and got[91]["log_likelihood"] == 0 and got[91]["per_token"] is None


def test_averages_go_up_in_levels(spark, monkeypatch):
    monkeypatch.setattr(gru, "FAN", 3)
    rows = [(b, k, float(k + 1), np.full(4, k, np.float32).tobytes()) for b in range(2) for k in range(11)]
    got = gru._average(spark.createDataFrame(rows, "block int, part int, w double, x binary"), 11).collect()
    want = sum((k + 1) * k for k in range(11)) / 66
    assert sorted(r["block"] for r in got) == [0, 1] and all(np.allclose(np.frombuffer(r["x"], np.float32), want) for r in got)


def test_hashed_and_coded_agree():
    texts = pa.array(["a b c", None, "", "b , b"])
    h, sizes = gru._hashed(texts)
    v = gru.Vocabulary(np.unique(h), np.ones(len(np.unique(h)), np.int64), np.full(gru.RARE, 1), 2)
    ids, other = gru._coded(texts, v)
    assert sizes.tolist() == other.tolist() == [3, 0, 0, 3] and (ids == v.ids(h)).all()

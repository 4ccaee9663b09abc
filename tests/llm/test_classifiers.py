import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import ODD

from orderlens.llm import pu, quality, toxicity

BAD = ["vilewort", "grossling", "foulmoot"]


def held(i, parts, at):
    return zlib.crc32(str(i).encode()) % parts == at


def test_risk_is_corrected_by_the_prior():
    rnd = np.random.default_rng(1)
    # feature 0 marks positives, 1 negatives, 2 both
    row = lambda good: np.array([0, 2] if good else [1, 2])
    positive = [row(True) for _ in range(200)]
    unlabelled = [row(x) for x in rnd.random(600) < 0.4]
    w, b = pu.fit(positive, unlabelled, 3, 0.4)
    z = pu.sigmoid(pu.Sets([row(True), row(False)]).margin(w, b))
    assert z[0] > 0.5 > z[1]
    # taken as plain negatives, most unlabelled rows outvote the positives where the prior is tiny
    w, b = pu.fit(positive, unlabelled, 3, 0.01)
    assert pu.sigmoid(pu.Sets([row(True)]).margin(w, b))[0] < z[0]


def test_rising_weights_stay_at_or_above_zero():
    w, _ = pu.fit([np.array([0])] * 20, [np.array([1])] * 50 + [np.array([0])] * 10, 2, 0.2, rising=True)
    assert w[0] > 0 and w[1] == 0


@pytest.mark.parametrize("prior, edge", [(0.0, 0.0), (1.0, 1.0)])
def test_degenerate_priors(prior, edge):
    _, b = pu.fit([np.array([0])], [np.array([0])], 1, prior)
    assert abs(pu.sigmoid(np.array([b]))[0] - edge) < 1e-9


def corpus(n, seed):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdefghijklmnoprstu") for _ in range(rnd.randint(2, 9))) for _ in range(800)]
    docs, labels = [], []
    for i in range(n):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(60, 250))]
        toxic, poor = rnd.random() < 0.15, rnd.random() < 0.2
        if toxic:
            for _ in range(rnd.randint(2, 4)):
                words[rnd.randrange(len(words))] = rnd.choice(BAD)
        if poor:
            words = [w for w in words[: len(words) // 8] for _ in range(8)] if rnd.random() < 0.5 else [f"{w}$$#" for w in words]
        text = " ".join(words).capitalize() + "."
        docs.append((i, text))
        if rnd.random() < 0.6:
            labels.append((i, 0 if poor else 1, int(toxic)))
    return docs, labels


@pytest.mark.parametrize("module, column, parts, at", [(toxicity, 2, 5, 0), (quality, 1, 3, 1)])
def test_held_out_accuracy_and_folds(spark, module, column, parts, at):
    docs, labels = corpus(1500, 7)
    d = spark.createDataFrame([(i, t, 9.0) for i, t in docs], "doc_id long, text string, score double")
    as_frame = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    model = module.train(d, as_frame(labels))
    got = {r.doc_id: r for r in module.score(d, model).collect()}
    assert len(got) == len(docs) and all(r.held_out == held(i, parts, at) and r.predicted == (r.score >= 0.5) for i, r in got.items())
    test = [(got[x[0]].predicted, x[column]) for x in labels if held(x[0], parts, at)]
    assert len(test) > 100 and sum(a == b for a, b in test) / len(test) > 0.95
    # labels of the held-out fold are never learnt from
    turned = [(x[0], 1 - x[1], 1 - x[2]) if held(x[0], parts, at) else x for x in labels]
    again = {r.doc_id: r.score for r in module.score(d, module.train(d, as_frame(turned))).collect()}
    assert all(abs(again[i] - r.score) < 1e-9 for i, r in got.items())


@pytest.mark.parametrize("module", [toxicity, quality])
def test_odd_rows_missing_labels_and_empty_tables(spark, odd_docs, no_docs, module):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(1, 1, 1), (1, 0, 0), (None, 1, 1), (2, None, None), (99, 1, 1), (5, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, odd):
        model = module.train(odd_docs, labels)
        rows = module.score(odd_docs, model).collect()
        assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in ODD)
        assert all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
        assert module.score(no_docs, model).collect() == []
    assert all(r.predicted == 0 for r in module.score(odd_docs, module.train(odd_docs, none)).collect())
    module.train(no_docs, odd)


def plain_fit(positive, unlabelled, size, prior, steps, rate, sparsity, ridge, beta, gamma, rising):
    """The risk and its steps by loops over documents and their features."""
    import math
    sig = lambda z: 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))
    w, b = [0.0] * size, math.log(prior / (1 - prior))
    m, v, mb, vb = [0.0] * size, [0.0] * size, 0.0, 0.0
    risks = []
    for t in range(1, steps + 1):
        zp = [sig(sum(w[f] for f in x) + b) for x in positive]
        zu = [sig(sum(w[f] for f in x) + b) for x in unlabelled]
        as_negative = lambda zs: sum(-math.log(1 - z + 1e-12) for z in zs) / len(zs)
        rest = as_negative(zu) - prior * as_negative(zp)
        risks.append(prior * sum(-math.log(z + 1e-12) for z in zp) / len(zp) + max(0.0, rest))
        g, gb = [0.0] * size, 0.0
        for rows, zs, up in ((positive, zp, prior), (unlabelled, zu, None)):
            for x, z in zip(rows, zs):
                if rest >= -beta:  # pi R_P(+1) + R_U(-1) - pi R_P(-1)
                    each = prior * ((z - 1) - z) / len(rows) if up else z / len(rows)
                else:  # back from below zero
                    each = gamma * (prior * z / len(rows) if up else -z / len(rows))
                for f in x:
                    g[f] += each
                gb += each
        for f in range(size):
            sign = (w[f] > 0) - (w[f] < 0) + (1 if w[f] == 0 and rising else 0)
            g[f] += ridge * w[f] + sparsity * sign
            m[f], v[f] = 0.9 * m[f] + 0.1 * g[f], 0.999 * v[f] + 0.001 * g[f] ** 2
            w[f] -= rate * (m[f] / (1 - 0.9 ** t)) / (math.sqrt(v[f] / (1 - 0.999 ** t)) + 1e-8)
            if rising:
                w[f] = max(0.0, w[f])
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb ** 2
        b -= rate * (mb / (1 - 0.9 ** t)) / (math.sqrt(vb / (1 - 0.999 ** t)) + 1e-8)
    return w, b, risks


@pytest.mark.parametrize("options", [
    dict(rate=0.1, sparsity=1.5e-4, ridge=0.0, beta=0.0, gamma=1.0, rising=True),
    dict(rate=0.05, sparsity=0.0, ridge=1e-4, beta=0.0, gamma=0.1, rising=False)])
@pytest.mark.parametrize("prior", [0.05, 0.4, 0.9])
def test_fit_by_plain_loops(options, prior):
    rnd = random.Random(int(prior * 100))
    row = lambda marks: np.array(sorted({rnd.choice(marks), *rnd.sample(range(4, 12), 3)}))
    positive = [row([0, 1]) for _ in range(25)]
    unlabelled = [row([0, 1]) if rnd.random() < prior else row([2, 3]) for _ in range(60)]
    w, b = pu.fit(positive, unlabelled, 12, prior, steps=60, **options)
    plain_w, plain_b, risks = plain_fit([x.tolist() for x in positive], [x.tolist() for x in unlabelled], 12, prior, 60, **options)
    assert np.allclose(w, plain_w, atol=1e-7) and abs(b - plain_b) < 1e-7
    assert risks[-1] < risks[0]


def test_scores_by_definition(spark):
    """The scores of a table, from the models' weights by plain loops over each whole text."""
    import math
    import re
    docs, labels = corpus(600, 11)
    docs += [(9000 + k, t) for k, (_, t) in enumerate(ODD)] + [(9990, "word " * 40000 + BAD[0])]
    frame, marks = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    sig = lambda z: 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))
    model = toxicity.train(frame, marks)
    edge = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())

    def toxic(text):
        z = model.bias
        for word in {w.strip(edge) for w in (text or "").lower().split()} - {""}:
            keys = ["=" + word] + ["^" + word[:k] for k in (4, 5, 6) if len(word) >= k]
            hashed = {zlib.crc32(k.encode("utf-8", "replace")) >> 12 for k in keys}
            z += sum(model.weights.get(f, 0.0) for f in hashed)
        return z

    # a word may come with several outer marks; the model counts each such form once
    simple = {i: t for i, t in docs if len({w.strip(edge) for w in (t or "").lower().split()} - {""}) == len({w for w in (t or "").lower().split() if w.strip(edge)})}
    got = {r["doc_id"]: r["score"] for r in toxicity.score(frame, model).collect()}
    for i, t in simple.items():
        assert got[i] == pytest.approx(sig(toxic(t)), abs=1e-9)
    assert len(simple) > 300 and got[9990] > got[9001]
    shape = quality.train(frame, marks)

    def good(text):
        z = shape.b
        for k, x in enumerate(quality.measures(text)):
            place = sum(e <= x for e in shape.edges[k])
            z += shape.w[k * (len(quality.CUTS) + 1) + place]
        return z

    got = {r["doc_id"]: r["score"] for r in quality.score(frame, shape).collect()}
    for i, t in docs:
        assert got[i] == pytest.approx(sig(good(t)), abs=1e-9)
    words = lambda t: [w for w in re.split("[ \t\n\x0b\x0c\r]+", t) if w]
    for _, t in docs[:50]:
        m, own = quality.measures(t), words(t)
        low = [w.lower() for w in own]
        assert m[0] == pytest.approx(math.log(len(own))) and m[2] == pytest.approx(len(set(low)) / len(own))
        assert m[3] == pytest.approx(sum(a == b for a, b in zip(low, low[1:])) / max(1, len(own) - 1))
        assert m[10] == pytest.approx(sum(w[0].isupper() for w in own) / len(own))


def test_bounds_are_parameters(spark):
    docs, labels = corpus(600, 12)
    frame, marks = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert len(toxicity.train(frame, marks, most_features=2).weights) <= 2
    assert len(toxicity.train(frame, marks, least_positives=10**6).weights) == 0
    assert len(toxicity.train(frame, marks).weights) > 2

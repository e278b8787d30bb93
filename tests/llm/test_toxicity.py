import os
import random
import zlib

import numpy as np
import pytest

from biomeframe.llm import queries, toxicity
from tests.llm.helpers import AWKWARD, docs_frame, prose

DIR = "/root/testdata/sf0.01"


def random_model(seed):
    rng = np.random.default_rng(seed)
    weights = rng.normal(scale=0.3, size=((1 << toxicity.BITS) + 1, 1 + toxicity.FACTORS)).astype(np.float32)
    weights[-1] = 0
    return toxicity.Model(-0.4, weights)


def words_of(text):
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def bucket(term, kind):
    """The hash of a term by Python's integers: its letters are the digits of a number to an odd base."""
    mask = (1 << 64) - 1
    h = sum(ord(c) * pow(toxicity._BASE, k, 1 << 64) for k, c in enumerate(term)) & mask
    h = (h ^ (h >> 31) ^ (kind * 0x5851F42D4C957F2D & mask)) * 0xD6E8FEB86659FD93 & mask
    return h >> (64 - toxicity.BITS)


def plain_logit(model, text):
    """The definition, pair by pair."""
    words = words_of(text)
    if not words:
        return model.bias
    chunks = []
    for at in range(0, len(words), toxicity.STEP):
        terms = set()
        for w in words[at : at + toxicity.STEP]:
            terms.add(bucket(w, 0))
            terms |= {bucket(w[:n], k + 1) for k, n in enumerate(toxicity.BEGINNINGS) if len(w) >= n}
        chunks.append(sorted(terms))
    windows = [a + b for a, b in zip(chunks, chunks[1:])] or chunks
    out = []
    for terms in windows:
        rows = model.weights[terms].astype(float)
        pairs = sum(rows[i, 1:] @ rows[:i, 1:].sum(axis=0) for i in range(1, len(rows)))
        out.append(model.bias + rows[:, 0].sum() + pairs)
    return np.log(np.mean(np.exp(np.array(out) - max(out)))) + max(out)


TEXTS = [
    prose(1, 20), prose(2, 64), prose(3, 65), prose(4, 200), "", None, "... !", "Ünï ß42", "same " * 90, "a" * 5000,
    " ".join(prose(k, 50) for k in range(9)),
]


@pytest.mark.parametrize("block", [400, 1500, 1 << 17])
def test_logits_are_the_definition(monkeypatch, block):
    toxicity._powers.cache_clear()
    monkeypatch.setattr(toxicity, "_BLOCK", block)
    model = random_model(1)
    texts = [t for t in TEXTS if block > 5000 or t is None or len(t) < 5000]
    want = [plain_logit(model, t or "") for t in texts]
    assert np.allclose(toxicity.logits(model, texts), want, rtol=1e-4, atol=1e-3)
    toxicity._powers.cache_clear()


def test_gradient():
    """Against differences of the loss."""
    model, texts = random_model(2), [TEXTS[k] for k in (0, 2, 3, 7)]
    model.weights *= 0.2
    model = toxicity.Model(model.bias, model.weights.astype(np.float64))
    labels, importance = np.array([1.0, 0.0, 1.0, 0.0]), np.array([2.0, 1.0, 2.0, 1.0])
    terms, owners, chunks = (np.concatenate(x) for x in zip(*toxicity._blocks(iter(texts))))

    def loss(bias, weights):
        z = toxicity.loss_gradient(bias, weights, terms, owners, chunks, labels, importance)[0]
        return float((importance * (np.logaddexp(0, z) - labels * z)).sum())

    _, slope, used, rows = toxicity.loss_gradient(model.bias, model.weights, terms, owners, chunks, labels, importance)
    step = 1e-5
    assert abs((loss(model.bias + step, model.weights) - loss(model.bias - step, model.weights)) / 2 / step - slope) < 1e-4
    rng = np.random.default_rng(0)
    for k in rng.choice(len(used), 12, replace=False):
        for f in range(1 + toxicity.FACTORS):
            up, down = model.weights.copy(), model.weights.copy()
            up[used[k], f] += step
            down[used[k], f] -= step
            want = (loss(model.bias, up) - loss(model.bias, down)) / 2 / step
            assert abs(want - rows[k, f]) < 1e-4 * max(1, abs(want))


def test_pairs_tell_what_single_terms_do_not(spark):
    """Toxic only where an insult meets the name of a group."""
    rng = random.Random(3)
    docs, labels = [], []
    for k in range(600):
        insult, group = rng.choice(["zork", "blarg"]), rng.choice(["martians", "robots"])
        both = rng.choice([(insult, group), (insult, group), (insult, "garden"), ("table", group)])
        words = prose(k, 12).split() + list(both)
        rng.shuffle(words)
        docs.append((k, " ".join(words)))
        labels.append((k, int(both == (insult, group))))
    frame = docs_frame(spark, docs)
    marks = spark.createDataFrame(labels + [(None, 1), (9999, 1), (5, None)], "doc_id bigint, toxic int")
    model = toxicity.train(frame, marks.filter("doc_id < 500 OR doc_id IS NULL OR doc_id > 9000"))
    got = {r.doc_id: r for r in toxicity.score(frame, model).collect()}
    right = [got[k].predicted == y for k, y in labels if k >= 500]
    assert sum(right) >= 0.9 * len(right)


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(9)] + [(5, 1, 1), (None, 0, 1)],
                                   "doc_id bigint, toxic int, label string")
    docs = docs_frame(spark, AWKWARD)
    model = toxicity.train(docs, labels)
    rows = toxicity.score(docs, model).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted((k is None, k or 0) for k, _ in AWKWARD)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert toxicity.score(docs_frame(spark, []), model).count() == 0
    nothing = toxicity.train(docs_frame(spark, []), labels.limit(0))
    assert {r.score for r in toxicity.score(docs.filter("doc_id < 4"), nothing).collect()} and nothing.bias == 0.0
    assert toxicity.train(docs, labels.limit(0)).bias == 0.0


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")
def test_held_out_rows(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    got = queries.op11_toxicity(spark, DIR).collect()
    assert len(got) == spark.read.parquet(f"{DIR}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    tests = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    assert sum(y == p for y, p in tests) >= 0.9 * len(tests)

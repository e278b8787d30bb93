import hashlib
import random

import numpy as np
import pytest

from biomeframe.llm import periodic
from tests.llm.helpers import AWKWARD, docs_frame, prose


def stretches(w):
    """Runs by comparing each word with that q places on, for every q."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((i, n, q) for (i, n), q in found.items()), key=lambda r: (r[0], r[2]))


def rhythm(rng, most=60):
    out = []
    while len(out) < rng.randint(0, most):
        unit = [rng.randint(0, rng.choice([1, 2, 5])) for _ in range(rng.randint(1, 6))]
        out += unit * rng.randint(1, 9) + unit[: rng.randint(0, len(unit))] + [7] * rng.randint(0, 2)
    return out


def test_against_brute_force():
    rng = random.Random(5)
    for _ in range(400):
        texts = [rhythm(rng) for _ in range(rng.randint(1, 4))]
        got = periodic.find_runs([np.array(t, dtype=np.int64) for t in texts])
        assert got == [stretches(t) for t in texts]


def test_long_texts_take_time_in_proportion():
    assert periodic.find_runs([np.zeros(100_000, dtype=np.int64)]) == [[(0, 100_000, 1)]]
    assert periodic.find_runs([np.tile([1, 2, 3], 30_000)]) == [[(0, 90_000, 3)]]
    a, b = [1], [1, 0]
    while len(b) < 20_000:  # a Fibonacci word has squares everywhere and no fourth power
        a, b = b, b + a
    assert periodic.find_runs([np.array(b)]) == [[]]


@pytest.mark.parametrize("block", [1, 64, 1 << 18])
def test_rows(spark, monkeypatch, block):
    monkeypatch.setattr(periodic, "BLOCK_WORDS", block)
    rng = random.Random(6)
    texts = [" ".join(map(str, rhythm(rng))) for _ in range(60)]
    texts += ["a b " * 4, "a " * 5, "a\t" * 6, "\x0bÄ  ß\n" * 9 + "Ä", prose(1, 40) * 5]
    docs = list(enumerate(texts, 100)) + AWKWARD + [(5, "x " * 9)]
    got = periodic.periodic_runs(docs_frame(spark, docs)).collect()
    want = []
    for doc_id, text in docs:
        w = (text or "").split()
        runs = stretches(w)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        want.append((doc_id, len(w), runs, " ".join(x for i, x in enumerate(w) if i not in gone)))
    key = repr
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=key) == sorted(
        want, key=key
    )
    assert periodic.periodic_runs(docs_frame(spark, [])).count() == 0


def test_query_derives_digests(spark, tmp_path):
    from biomeframe.llm import queries

    texts = {0: "one two " * 6, 1: "", 2: "a " * 9 + "b " * 9, 3: None}
    rows = [(k, t) for k, t in texts.items()] + [(None, "z " * 7)]
    docs_frame(spark, rows).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op13_periodic_runs(spark, str(tmp_path)).collect()}
    assert got[2].n_runs == 2 and (got[2].start, got[2].length, got[2].period, got[2].exponent_milli) == (0, 9, 1, 9000)
    assert got[2].runs_sha256 == hashlib.sha256(b"0,9,1\n9,9,1\n").hexdigest()
    assert got[2].collapsed_sha256 == hashlib.sha256(b"a b").hexdigest()
    empty = hashlib.sha256(b"").hexdigest()
    for k in (1, 3):
        assert got[k].n_runs == 0 and got[k].start is None and got[k].exponent_milli is None
        assert got[k].runs_sha256 == got[k].collapsed_sha256 == empty
    assert got[None].n_runs == 1

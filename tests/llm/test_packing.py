from collections import defaultdict
from itertools import combinations

import pytest

from biomeframe.llm.packing import best_boundaries, pack
from tests.llm.helpers import AWKWARD, docs_frame, prose


def padding(lengths, counts, bounds):
    return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts))


@pytest.mark.parametrize("buckets", [1, 2, 3, 4])
def test_boundaries_are_optimal(buckets):
    lengths, counts = [3, 1, 9, 7, 20, 15, 4], [5, 9, 2, 8, 1, 3, 3]
    best = min(
        padding(lengths, counts, c)
        for k in range(1, buckets + 1) for c in combinations(lengths, k) if max(c) == 20
    )
    got = best_boundaries(lengths, counts, buckets)
    assert got == sorted(got) and got[-1] == 20 and len(got) <= buckets
    assert padding(lengths, counts, got) == best
    assert best_boundaries([], [], 3) == [] and best_boundaries([4], [2], 3) == [4]


def test_every_token_is_packed_once(spark):
    docs = AWKWARD + [(100 + k, prose(k, 1 + 37 * k % 211)) for k in range(60)]
    rows = pack(docs_frame(spark, docs), max_tokens=50, buckets=3, batch_tokens=120).collect()
    want = sorted((d or -1, len((t or "").split())) for d, t in docs)
    total, parts = defaultdict(int), defaultdict(list)
    for r in rows:
        total[r.doc_id or -1] += r.n_tokens
        parts[r.bucket_len, r.batch].append(r)
    sums = defaultdict(int)
    for d, n in want:
        sums[d] += n
    assert dict(total) == dict(sums)
    assert sum(r.batch is None for r in rows) == sum(n == 0 for _, n in want)
    full = defaultdict(list)
    for (size, batch), some in parts.items():
        if batch is None:
            continue
        slots = max(120 // size, 1)
        assert sorted(r.slot for r in some) == list(range(len(some))) and len(some) <= slots
        assert all(r.n_tokens <= size for r in some)
        full[size].append((batch, len(some) == slots))
    for batches in full.values():
        batches.sort()
        assert [b for b, _ in batches] == list(range(len(batches)))
        assert all(done for _, done in batches[:-1])


def test_empty(spark):
    assert pack(docs_frame(spark, [])).count() == 0
    assert pack(docs_frame(spark, [(1, None)])).first().batch is None

"""Periodic runs of words: Kruskal over suffixes, by descending common prefix.

The suffixes of a text are sorted; neighbours in that order are edges, weighted by
their longest common prefix (LCP). Edges are taken by falling weight and unite
classes of suffixes (union-find); a class holds its positions in order. Where a
union at LCP ``l`` makes positions ``i`` and ``i + p`` neighbours, the stretch of
``p + l`` words from ``i`` has the period ``p``. It has no smaller one, or a position
of the same class would lie between; it cannot be extended to the right, because
``l`` is exact. So the seeds that cannot be extended to the left are the runs, once
each, without a look at the words inside.

A run of ``LEAST_LENGTH`` words and four periods repeats some window of ``GRAM``
words, and only positions whose window occurs again in the text are sorted and
united: in texts without repetition that is none. Sorting works on all texts of a
batch at once (numpy); the window of a text never equals that of another one.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from biomeframe.llm.common import shipped

LEAST_LENGTH = 6
LEAST_PERIODS = 4
#: A run of period 1 has LEAST_LENGTH words, so a prefix of one less in common with its next position.
GRAM = LEAST_LENGTH - 1
#: Texts are handled together until they have this many words; a longer text is handled alone.
BLOCK_WORDS = 1 << 18
#: Below this ratio of sizes a smaller class is sorted into a larger one position by position.
_INSERT = 16
_MIX = np.uint64(0x9E3779B97F4A7C15)

RUN = StructType([StructField(c, LongType(), False) for c in ("start", "length", "period")])


def _grams(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose window of GRAM words occurs again in their text, and keys of the windows.

    ids: the words of several texts one after another, each text followed by one
    number of its own; ends: places of these numbers.
    """
    n = len(ids) - GRAM + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * _MIX
    mixed ^= mixed >> np.uint64(31)
    key = np.repeat(np.arange(len(ends), dtype=np.uint64), np.diff(ends, prepend=-1))[:n]
    for k in range(GRAM):
        key = (key ^ (key >> np.uint64(29))) * _MIX + mixed[k : k + n]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.concatenate((same, [False])) | np.concatenate(([False], same))
    found = np.sort(order[again])
    return found, key[found]


def _suffix_order(at: np.ndarray, key: np.ndarray, size: int) -> np.ndarray:
    """The positions ``at``, sorted by what follows them in terms of windows.

    Prefix doubling: positions with equal ranks agree on ``step`` windows and are
    told apart by the rank ``step`` further on. A position whose rank is its own
    is not looked at again. All positions outside ``at`` have ranks of their own.
    """
    rank = np.arange(len(at), len(at) + size + 1, dtype=np.int64)
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    new = np.concatenate(([True], sorted_key[1:] != sorted_key[:-1]))
    starts = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
    now = at[order]
    rank[now] = starts
    step = 1
    while len(now):
        mine = rank[now]
        alone = np.concatenate(([True], mine[1:] != mine[:-1]))
        alone &= np.concatenate((mine[1:] != mine[:-1], [True]))
        now = now[~alone]
        if not len(now):
            break
        mine, after = rank[now], rank[np.minimum(now + step, size)]
        order = np.lexsort((after, mine))
        now, mine, after = now[order], mine[order], after[order]
        index = np.arange(len(now))
        group = np.concatenate(([True], mine[1:] != mine[:-1]))
        part = group | np.concatenate(([True], after[1:] != after[:-1]))
        first = np.maximum.accumulate(np.where(group, index, 0))
        rank[now] = mine + np.maximum.accumulate(np.where(part, index, 0)) - first
        step *= 2
    return at[np.argsort(rank[at])]


def _common_prefixes(words: list[int], at: list[int], before: dict[int, int]) -> list[int]:
    """Words that each position has in common with the one before it in the order."""
    out, shared, last = [], 0, -2
    for i in at:
        # One word on, all but one of the shared words are still shared, if a window remains.
        shared = shared - 1 if i == last + 1 and shared > GRAM else 0
        last, k = i, before[i]
        if k < 0:
            shared = 0
        else:
            while words[i + shared] == words[k + shared]:
                shared += 1
        out.append(shared)
    return out


def _seeds(edges: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """(position, period, prefix) of newly neighbouring positions that make a run.

    edges: (prefix, position, position), by falling prefix.
    """
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    for shared, i, k in edges:
        roots = []
        for x in (i, k):
            root = x
            while parent.setdefault(root, root) != root:
                root = parent[root]
            while parent[x] != root:
                parent[x], x = root, parent[x]
            roots.append(root)
        a, b = roots
        large, small = members.pop(a, [a]), members.pop(b, [b])
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        parent[b] = a
        most = shared // (LEAST_PERIODS - 1)
        top = len(small)
        for n, x in enumerate(small):
            place = bisect_left(large, x)
            if place and x - large[place - 1] <= most and (not n or small[n - 1] < large[place - 1]):
                yield large[place - 1], x - large[place - 1], shared
            if place < len(large) and large[place] - x <= most and (n + 1 == top or small[n + 1] > large[place]):
                yield x, large[place] - x, shared
        if len(small) * _INSERT < len(large):
            for x in small:
                insort(large, x)
        else:
            large += small
            large.sort()
        members[a] = large


def find_runs(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each array of word numbers, by start and period."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes + 1) - 1
    top = max((int(t.max()) + 1 for t in texts if len(t)), default=0)
    ids = np.empty(int(ends[-1]) + 1 if len(texts) else 0, dtype=np.int64)
    for k, (text, end) in enumerate(zip(texts, ends.tolist())):
        ids[end - len(text) : end] = text
        ids[end] = top + k
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    at, key = _grams(ids, ends)
    if not len(at):
        return out
    order = _suffix_order(at, key, len(ids))
    inside = np.searchsorted(ends, order)
    new = np.concatenate(([True], inside[1:] != inside[:-1]))
    before = dict(zip(order.tolist(), np.where(new, -1, np.roll(order, 1)).tolist()))
    words = ids.tolist()
    places = at.tolist()
    shared = _common_prefixes(words, places, before)
    edges = sorted(
        ((n, i, before[i]) for n, i in zip(shared, places) if n >= GRAM), key=lambda e: -e[0]
    )
    for i, period, n in _seeds(edges):
        text = int(np.searchsorted(ends, i))
        start = int(ends[text - 1]) + 1 if text else 0
        if period + n >= LEAST_LENGTH and (i == start or words[i - 1] != words[i + period - 1]):
            out[text].append((i - start, period + n, period))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, joined by a space, without those a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    return b" ".join([words[k] for k in kept.tolist()])


def _blocks(texts: Iterator[str | None]) -> Iterator[list[list[bytes]]]:
    """The words of the texts, some texts at a time."""
    block, size = [], 0
    for text in texts:
        words = (text or "").encode("utf-8", "surrogatepass").split()
        block.append(words)
        size += len(words) + 1
        if size >= BLOCK_WORDS:
            yield block
            block, size = [], 0
    if block:
        yield block


def periodic_runs(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, runs, collapsed: one row for each row of ``docs``, unshuffled.

    ``runs`` holds (start, length, period) of every maximal stretch of words that
    has the smallest period ``period``, at least ``LEAST_LENGTH`` words and
    ``LEAST_PERIODS`` periods, by start and period. ``collapsed`` is the text
    without the repetitions: its words, joined by one space, but those that a run
    holds after its first period.

    Null, empty and blank texts have no words, no runs and an empty ``collapsed``.
    Repeated rows and null ids stay; other columns are not read. A text is held in
    memory as a whole, with some forty bytes a word; texts are handled together in
    blocks of ``BLOCK_WORDS``.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    shipped(docs.sparkSession)
    schema = StructType([
        rows.schema["doc_id"], StructField("n_words", LongType()),
        StructField("runs", ArrayType(RUN, False)), StructField("collapsed", StringType()),
    ])
    kind = pa.list_(pa.struct([pa.field(c, pa.int64(), False) for c in RUN.names]))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for block in _blocks(x.as_py() for x in batch.column(1)):
                number: dict[bytes, int] = defaultdict(count().__next__)
                ids = [np.fromiter(map(number.__getitem__, w), np.int64, len(w)) for w in block]
                runs = find_runs(ids)
                texts = [collapsed(w, r).decode("utf-8", "surrogatepass") for w, r in zip(block, runs)]
                named = [[dict(zip(RUN.names, r)) for r in found] for found in runs]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(block)),
                     pa.array([len(w) for w in block], pa.int64()), pa.array(named, kind),
                     pa.array(texts, pa.string())],
                    names=schema.names,
                )
                at += len(block)

    return rows.mapInArrow(of, schema)

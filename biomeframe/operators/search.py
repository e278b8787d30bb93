"""Similarity search by seeds, and the joins that annotate its hits."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from biomeframe.functions.sequence import (
    explode_kmers,
    kmer_code,
    low_complexity,
    reverse_complement,
    seq_key,
    translate_frames,
)
from biomeframe.operators.alignment import AMINO_SHARES, CLASSES, Matrix, best_scores, extend
from biomeframe.operators.skew import BROADCAST_ROWS, hash_side, lookup_join, salted_join, salted_pair_join
from biomeframe.session import stored

PATHOGENIC, NON_PATHOGENIC, UNKNOWN = "Pathogenic", "Non-pathogenic", "Unknown"


def karlin_altschul(match: int, mismatch: int, p_match: float) -> tuple[float, float]:
    """Lambda and K of ungapped local scores for two-valued random scores.

    Lambda solves p e^(lambda match) + (1 - p) e^(lambda mismatch) = 1; K follows
    from the distributions of sums of 1, 2, 3... scores.
    """
    unit = math.gcd(match, -mismatch)
    up, down = match // unit, mismatch // unit
    low, high = 1e-6, 20.0
    for _ in range(200):
        lam = (low + high) / 2
        over = p_match * math.exp(lam * up) + (1 - p_match) * math.exp(lam * down) > 1
        low, high = (low, lam) if over else (lam, high)
    step = np.zeros(up - down + 1)
    step[0], step[-1] = 1 - p_match, p_match
    sums, total = np.ones(1), 0.0
    for n in range(1, 400):
        sums = np.convolve(sums, step)
        value = np.arange(len(sums)) + n * down
        total += (sums * np.exp(np.minimum(lam * value, 0.0))).sum() / n
    slope = p_match * up * math.exp(lam * up) + (1 - p_match) * down * math.exp(lam * down)
    kappa = math.exp(-2 * total) / (slope * -math.expm1(-lam))
    return lam / unit, kappa


@dataclass(frozen=True)
class Scoring:
    """Match and mismatch scores with their ungapped Karlin-Altschul values."""

    match: int = 1
    mismatch: int = -2
    lam: float = 1.33
    kappa: float = 0.621
    #: Scores by letter pair, in place of match and mismatch.
    matrix: Matrix | None = None


def matrix_scoring(matrix: Matrix) -> Scoring:
    """Scores of a matrix, with lambda and K worked out from them."""
    return Scoring(max(matrix.scores.values()), min(matrix.scores.values()), *matrix.statistics, matrix)


@dataclass(frozen=True)
class Gaps:
    """How ungapped segments are extended: from ``trigger_bits`` on, in a band of ``band``
    letters to both sides, as long as the score is at most ``xdrop`` below the best one."""

    xdrop: int = 30
    band: int = 32
    trigger_bits: float = 18.0


NUCLEOTIDE = Scoring()
# Proteins are scored by identity, without a matrix, with the values of these scores.
PROTEIN = Scoring(
    5, -2, *karlin_altschul(5, -2, sum((x / sum(AMINO_SHARES.values())) ** 2 for x in AMINO_SHARES.values()))
)


#: Care positions of spaced protein seeds over the near classes of amino acids.
SPACED = "11010011"


def _spaced_seeds(df: DataFrame, pattern: str) -> DataFrame:
    """Seeds of letter classes at the ones of a pattern; each is a run of its own."""
    groups = [g for g in CLASSES[0] if len(g) > 1]
    letters, names = "".join(groups), "".join(g[0] * len(g) for g in groups)
    rows = explode_kmers(df, len(pattern), keep=("key",), acgt_only=False)
    care = F.concat(*[F.substring("kmer", p + 1, 1) for p, bit in enumerate(pattern) if bit == "1"])
    rows = rows.select("key", "pos", F.translate(care, letters, names).alias("kmer"))
    rows = rows.filter(~F.col("kmer").contains("*") & ~F.col("kmer").contains("X"))
    return rows.withColumns({"prev": F.lit(0), "next": F.lit(0)})


def _seeds(df: DataFrame, k: int, protein: bool, pattern: str | None = None) -> DataFrame:
    """``(key, pos, kmer, prev, next)``; nucleotide seeds are packed into longs.

    ``prev`` and ``next`` are the codes of the letters beside the seed, 0 where
    no seed can lie one step further.
    """
    if pattern:
        return _spaced_seeds(df, pattern)
    if not protein:
        return explode_kmers(df, k, keep=("key",), packed=k <= 31, flanks=True)
    rows = explode_kmers(df, k, keep=("key",), acgt_only=False, flanks=True)
    rows = rows.filter(~F.col("kmer").contains("*") & ~F.col("kmer").contains("X"))
    flanks = [
        F.when(F.col(c).isin(ord("*"), ord("X")), 0).otherwise(F.col(c)).alias(c)
        for c in ("prev", "next")
    ]
    return rows.select("key", "pos", "kmer", *flanks)


def _seed_index(ref: DataFrame, k: int, mask: bool, protein: bool, pattern: str | None = None) -> DataFrame:
    """Seeds of the references, stored: the counterpart of a formatted database.

    The masking is written out with them, so that it is not repeated (as an
    inferred filter) for every seed of the queries. A flank is missing where
    the next seed would be masked.
    """
    if protein or not mask:
        return stored(_seeds(ref, k, protein, pattern), "seed-index")
    text = explode_kmers(ref, k, keep=("key",), flanks=True).filter(~low_complexity("kmer", k))
    before = F.concat(F.char("prev"), F.substring("kmer", 1, k - 1))
    after = F.concat(F.expr("substring(kmer, 2)"), F.char("next"))

    def flank(name: str, step: Column) -> Column:
        seed = (F.col(name) > 0) & ~low_complexity(step, k)
        code = F.ascii(F.translate(F.char(name), "ACGT", "0123")) if k <= 31 else F.col(name)
        return F.when(seed, code).otherwise(0).alias(name)

    rows = text.select("key", "pos", "kmer", flank("prev", before), flank("next", after))
    if k <= 31:
        # In a step of its own: lambdas above would see this alias, not the text.
        rows = rows.withColumn("kmer", kmer_code("kmer", k))
    return stored(rows, "seed-index")


def _runs(
    query: DataFrame, ref: DataFrame, k: int, mask: bool, protein: bool, pattern: str | None = None
) -> DataFrame:
    """Runs of neighbouring seed pairs: ``(q, r, diag, first, last)``, places in the query.

    Only the first and the last pair of a run leave the join: a pair whose
    neighbours match on both sides adds nothing. A long match thus shuffles two
    rows instead of one per position.
    """
    q = _seeds(query, k, protein, pattern).select(
        "kmer", F.col("key").alias("q"), F.col("pos").alias("qpos"),
        F.col("prev").alias("qprev"), F.col("next").alias("qnext"),
    )
    r = _seed_index(ref, k, mask, protein, pattern).select(
        "kmer", F.col("key").alias("r"), F.col("pos").alias("rpos"),
        F.col("prev").alias("rprev"), F.col("next").alias("rnext"),
    )
    begins, ends = [
        (F.col(f"q{side}") != F.col(f"r{side}")) | (F.col(f"q{side}") == 0)
        for side in ("prev", "next")
    ]
    if r.count() <= BROADCAST_ROWS:
        pairs = q.join(F.broadcast(r), "kmer")
    else:
        pairs = salted_pair_join(q, hash_side(r), ["kmer"], ["q", "qpos"], ["r", "rpos"])
    edges = pairs.filter(begins | ends).select(
        "q", "r", (F.col("qpos") - F.col("rpos")).alias("diag"), "qpos", begins.alias("b"), ends.alias("e")
    )
    along = Window.partitionBy("q", "r", "diag").orderBy("qpos")
    return edges.withColumn(
        "last", F.when(F.col("e"), F.col("qpos")).otherwise(F.lead("qpos").over(along))
    ).filter("b").select("q", "r", "diag", F.col("qpos").alias("first"), "last")


def _regions(runs: DataFrame, k: int, reach: int) -> DataFrame:
    """Stretches of a diagonal within ``reach`` letters of a run:
    ``(q, r, diag, start, end, runs)``, not yet cut to the sequences."""
    along = Window.partitionBy("q", "r", "diag").orderBy("first")
    before = F.max("last").over(along.rowsBetween(Window.unboundedPreceding, -1))
    apart = before.isNull() | (F.col("first") - before > 2 * reach + k)
    numbered = runs.withColumn("new", apart.cast("int")).withColumn("region", F.sum("new").over(along))
    return numbered.groupBy("q", "r", "diag", "region").agg(
        (F.min("first") - reach).alias("start"),
        (F.max("last") + (k - 1 + reach)).alias("end"),
        F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs"),
    ).drop("region")


def _aligned(
    regions: DataFrame, query: DataFrame, ref: DataFrame, k: int, min_seeds: int, scoring: Scoring, least: Column
) -> DataFrame:
    """All maximal-scoring segments of the regions that hold enough seeds, but for those
    that score below ``least`` (of the row's ``qlen``).

    A segment is maximal if every part at one of its ends scores above zero
    and no longer segment with that property contains it (the published linear
    algorithm for all maximal scoring subsequences). So a second match on a
    diagonal is a segment of its own unless the stretch between costs less than
    either of the two is worth.

    A segment with a seed begins at or before the last run and ends at or behind the
    first one, so the sums at these places bound its score and its ends. By these
    bounds, worked out for all rows of a batch together, most regions fall out and
    the others are cut to what a segment with a seed can reach.
    """
    q = query.select(F.col("key").alias("q"), F.col("seq").cast("binary").alias("_q"))
    r = ref.select(F.col("key").alias("r"), F.col("seq").cast("binary").alias("_r"))
    # Each side is reduced to its piece right after its join.
    start = F.greatest("start", F.lit(1), F.col("diag") + 1)
    with_q = regions.join(q, "q").select(
        "q", "r", "diag", "runs", start.alias("start"), "end", F.length("_q").alias("qlen"),
        F.col("_q").substr(start, F.col("end") - start + 1).alias("a"),
    )
    cut = with_q.join(r, "r").select(
        "q", "r", "diag", "runs", "start", "qlen", "a",
        F.col("_r").substr(F.col("start") - F.col("diag"), F.length("a")).alias("b"),
        least.cast("double").alias("least"),
        # Letters of the region before and up to the end of its first and its last run.
        (F.col("runs")[0]["first"] - F.col("start")).alias("first"),
        (F.col("runs")[0]["last"] + k - F.col("start")).alias("first_end"),
        (F.element_at("runs", -1)["first"] - F.col("start")).alias("last"),
        (F.element_at("runs", -1)["last"] + k - F.col("start")).alias("last_end"),
        F.size("runs").alias("n_runs"),
    )
    plus, minus = scoring.match, scoring.mismatch
    table = scoring.matrix.table if scoring.matrix else None
    schema = (
        "q string, r string, diag int, qlen int, qstart int, qend int, seeds int, matches int, raw int"
    )

    def segments(batches):
        import numpy as np
        import pyarrow as pa

        def maximal(scores):
            """(start, end) of each maximal segment, end exclusive."""
            good = scores > 0
            turns = np.flatnonzero(np.diff(good)) + 1
            bounds = np.concatenate(([0], turns, [len(good)]))
            sums = np.concatenate(([0], np.cumsum(scores)))[bounds].tolist()
            bounds, found = bounds.tolist(), []
            for a, b, left, right in zip(bounds, bounds[1:], sums, sums[1:]):
                if not good[a]:
                    continue
                first = a
                while True:
                    j = len(found) - 1
                    while j >= 0 and found[j][0] >= left:
                        j -= 1
                    if j < 0 or found[j][1] >= right:
                        break
                    left, first = found[j][0], found[j][2]
                    del found[j:]
                found.append((left, right, first, b))
            return found

        def plain(batch):
            """Columns of the segments that the bounds alone give, and for each other row that
            may hold one its number, its first possible place, its equal letters and its scores."""
            pairs = [(a, b) if len(a) == len(b) else (a[: len(b)], b[: len(a)])
                     for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())]
            sizes = np.array([len(a) + 1 for a, _ in pairs])
            ends = np.cumsum(sizes)
            begins = ends - sizes
            small = ends[-1] * max(abs(plus), abs(minus)) < 1 << 31
            x, y = (np.frombuffer(b"".join([b"\0" + p[side] for p in pairs]), np.uint8) for side in (0, 1))
            same = x == y
            scores = np.where(same, np.int32(plus), np.int32(minus)) if table is None else table[x, y]
            scores[begins] = 0
            sums = np.cumsum(scores, dtype=np.int32 if small else np.int64)
            first, first_end, last, last_end = (
                begins + batch.column(c).to_numpy() for c in ("first", "first_end", "last", "last_end")
            )
            # Of each row: the least sum up to the last run, and the highest from the first one on.
            low = np.minimum.reduceat(sums, np.stack([begins, last + 1], axis=1).ravel())[::2]
            high = np.maximum.reduceat(sums, np.stack([first_end, ends], axis=1).ravel()[:-1])[::2]
            good = high - low >= batch.column("least").to_numpy() - 0.5
            if not good.any():
                return [[]] * 6, []
            # No segment goes on behind a sum as low as the least one, or from before one as high as the highest.
            sunk, risen = np.flatnonzero(sums <= np.repeat(low, sizes)), np.flatnonzero(sums >= np.repeat(high, sizes))
            to = np.append(sunk, len(sums))[np.searchsorted(sunk, last_end)]
            at = np.append(risen, -1)[np.searchsorted(risen, first, "right") - 1]
            # From the last least sum to the first highest one: with nothing between that ends it, that is all of it.
            i, j = sunk[np.searchsorted(sunk, last, "right") - 1], risen[np.searchsorted(risen, first_end)]
            whole = good & (batch.column("n_runs").to_numpy() == 1) & (at < i) & (j < to)
            seeds = last_end - first - (k - 1)
            n = np.flatnonzero(whole & (seeds >= min_seeds))
            i, j, start = i[n], j[n], batch.column("start").to_numpy()[n]
            matches = np.add.reduceat(np.append(same, False), np.stack([i, j], axis=1).ravel() + 1, dtype=np.int64)[::2] if len(n) else i
            places = start + i - begins[n], start + j - begins[n] - 1
            to, at = np.minimum(to, ends - 1), np.maximum(at, begins)
            rest = [
                (n, int(at[n] - begins[n]), same[at[n] + 1 : to[n] + 1], scores[at[n] + 1 : to[n] + 1])
                for n in np.flatnonzero(good & ~whole).tolist()
            ]
            return [n, *places, seeds[n], matches, (high - low)[n]], rest

        names = ["q", "r", "diag", "qlen", "qstart", "qend", "seeds", "matches", "raw"]
        types = [pa.string()] * 2 + [pa.int32()] * 7
        for whole in batches:
            out, known = [], ["q", "r", "diag", "qlen"]
            for begin in range(0, whole.num_rows, _REGIONS):
                batch = whole.slice(begin, _REGIONS)
                (chosen, *columns), rest = plain(batch)
                if len(chosen):
                    kept = batch.select(known).take(pa.array(chosen, pa.int64())).columns
                    kept = [x.cast(t) for x, t in zip([*kept, *map(pa.array, columns)], types)]
                    yield pa.RecordBatch.from_arrays(kept, names=names)
                rows = batch.select([*known, "start", "runs"]).take(pa.array([x[0] for x in rest], pa.int64()))
                for row, (_, at, same, scores) in zip(rows.to_pylist(), rest):
                    runs = [(x["first"], x["last"]) for x in row["runs"]]
                    for left, right, a, b in maximal(scores):
                        matches = int(same[a:b].sum())
                        a, b = a + row["start"] + at, b + row["start"] + at - 1
                        seeds = sum(y - x + 1 for x, y in runs if a <= x and y + k - 1 <= b)
                        if seeds >= max(min_seeds, 1):
                            out.append((row["q"], row["r"], row["diag"], row["qlen"], a, b, seeds, matches, right - left))
            columns = list(zip(*out)) or [[]] * 9
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    found = cut.mapInArrow(segments, schema).withColumn("length", F.col("qend") - F.col("qstart") + 1)
    return found.withColumns({
        "sstart": F.col("qstart") - F.col("diag"), "send": F.col("qend") - F.col("diag"), "gapopen": F.lit(0),
    })


def _least_raw(scoring: Scoring, residues: int, max_evalue: float, gaps: Gaps | None) -> Column:
    """Raw score below which a segment (with ``gaps``: before it is extended) is no hit, by its ``qlen``."""
    if gaps:
        bits = F.lit(gaps.trigger_bits)
    elif max_evalue > 0 and residues:
        bits = F.log2(F.col("qlen") * F.lit(residues / max_evalue))
    else:
        bits = F.lit(float("-inf"))
    return (bits * math.log(2) + math.log(scoring.kappa)) / scoring.lam


def _with_bits(scored: DataFrame, residues: int, scoring: Scoring) -> DataFrame:
    """Bit score and e-value from the raw score."""
    bits = (F.col("raw") * scoring.lam - math.log(scoring.kappa)) / math.log(2)
    scored = scored.withColumn("bitscore", bits)
    return scored.withColumn("evalue", F.col("qlen") * F.lit(residues) * F.pow(F.lit(2.0), -F.col("bitscore")))


#: Regions that are bounded together, and pairs that are extended together.
_REGIONS, _PAIRS = 128, 4096
#: Letters of a piece that is extended first.
_PIECE = 64


def _extended(
    scored: DataFrame, query: DataFrame, ref: DataFrame, matrix: Matrix, gaps: Gaps, size: int, least: Column
) -> DataFrame:
    """The segments extended over gaps to both sides, but for those that score below ``least``.

    Pieces of ``size`` letters are tried first; a hit whose extension is still
    alive at the end of a piece that is not the end of its sequence is taken up
    again with four times as much, so that no extension is cut short. Of hits
    that begin (or end) at the same letters the best one stays.
    """
    table, open_, longer = matrix.table, matrix.gap_open, matrix.gap_extend
    names = [
        "q", "r", "diag", "qlen", "qstart", "qend", "seeds", "matches", "raw", "length", "sstart", "send", "gapopen",
    ]
    fields = ["diag int", "q string", "r string", *[f"{c} int" for c in names[3:]]]
    schema = ", ".join(["q string", "r string", "diag int", *fields[3:], "at int", "more boolean"])
    q = query.select(F.col("key").alias("q"), F.col("seq").cast("binary").alias("_q"))
    r = ref.select(F.col("key").alias("r"), F.col("seq").cast("binary").alias("_r"))

    def pieces(rows: DataFrame, text: str, start: str, end: str, side: str, size: int) -> DataFrame:
        """Letters before (backwards) and behind a segment, and whether there are more of them."""
        low = F.greatest(F.col(start) - size, F.lit(1))
        return rows.withColumns({
            f"{side}l": F.reverse(F.col(text).substr(low, F.col(start) - low).cast("string")).cast("binary"),
            f"{side}r": F.col(text).substr(F.col(end) + 1, F.lit(size)),
            f"{side}l_more": low > 1, f"{side}r_more": F.length(text) > F.col(end) + size,
        }).drop(text)

    def work(batches):
        import numpy as np
        import pyarrow as pa

        def hopeful(batch):
            """The rows that can score enough, or that may not be at their end."""
            total, keep = batch.column("raw").to_numpy().astype(np.int64), np.zeros(batch.num_rows, dtype=bool)
            for side in "lr":
                a, b = (batch.column(x + side).to_pylist() for x in "ab")
                score, life = best_scores(a, b, table, open_, longer, gaps.xdrop, gaps.band)
                total += score
                for x, parts in (("a", a), ("b", b)):
                    more = batch.column(f"{x}{side}_more").to_numpy(zero_copy_only=False).astype(bool)
                    # The other side is at most ``band`` letters behind.
                    keep |= more & (life >= 2 * np.fromiter(map(len, parts), np.int64, len(parts)) - gaps.band)
            return batch.filter(pa.array(keep | (total >= batch.column("least").to_numpy() - 0.5)))

        for whole in batches:
            parts = [hopeful(whole.slice(at, _PAIRS)) for at in range(0, whole.num_rows, _PAIRS)]
            for batch in parts:
                if not batch.num_rows:
                    continue
                col = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names if c not in ("q", "r")}
                out = {c: col[c].astype(np.int64) for c in names[2:]}
                more = np.zeros(batch.num_rows, dtype=bool)
                for side in "lr":
                    a, b = (batch.column(x + side).to_pylist() for x in "ab")
                    found = extend(a, b, table, open_, longer, gaps.xdrop, gaps.band)
                    out["matches"] += found.matches
                    out["raw"] += found.score
                    out["length"] += found.columns
                    out["gapopen"] += found.gap_opens
                    sign, q_end, s_end = (-1, "qstart", "sstart") if side == "l" else (1, "qend", "send")
                    out[q_end] += sign * found.used_a
                    out[s_end] += sign * found.used_b
                    more |= found.at_end_a & col[f"a{side}_more"].astype(bool)
                    more |= found.at_end_b & col[f"b{side}_more"].astype(bool)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("q"), batch.column("r"), *[pa.array(out[c], pa.int32()) for c in names[2:]],
                     batch.column("at"), pa.array(more)],
                    names=[*names, "at", "more"],
                )

    done, scored = [], scored.select(*names, F.col("qstart").alias("at"))
    todo = scored
    while True:
        # Each side is reduced to its pieces right after its join.
        cut = pieces(todo.join(q, "q"), "_q", "qstart", "qend", "a", size)
        cut = pieces(cut.join(r, "r"), "_r", "sstart", "send", "b", size).withColumn("least", least.cast("double"))
        tried = stored(cut.mapInArrow(work, schema), "extended")
        done.append(tried.filter(~F.col("more")))
        again = tried.filter("more").select("q", "r", "diag", "at")
        if again.isEmpty():
            break
        size *= 4
        # The segment itself is found again by its place: extension starts from it anew.
        todo = scored.join(again, ["q", "r", "diag", "at"], "left_semi")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    rest = [c for c in names if c not in ("q", "r")]
    for ends in (("qstart", "sstart"), ("qend", "send")):
        order = F.struct("raw", -F.col("qstart"), -F.col("sstart"), -F.col("qend"), -F.col("send"), -F.col("diag"))
        kept = out.groupBy("q", "r", *[F.col(c).alias(f"_{c}") for c in ends])
        out = kept.agg(F.max_by(F.struct(*rest), order).alias("b")).select("q", "r", "b.*")
    return out.select(*names)


def similarity_search(
    query: DataFrame,
    ref: DataFrame,
    k: int,
    min_seeds: int = 1,
    max_evalue: float = 1e-5,
    strands: bool = True,
    protein: bool = False,
    mask: bool = False,
    one_per_subject: bool = False,
    scoring: Scoring | None = None,
    reach: int = 500,
    gaps: Gaps | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Hits of ``query (id, seq, ord)`` in ``ref (id, description, seq)``.

    Exact shared k-mers are seeds. Each diagonal of a pair is aligned, without
    gaps, up to ``reach`` letters around its seeds, and every maximal-scoring
    segment there with at least ``min_seeds`` seeds is a hit. Scores follow the
    published Karlin-Altschul formula: they approximate, and do not repeat, the
    values of alignment tools.

    All seeds count; there is no limit per seed, query or subject. Copies of a
    sequence are searched once and written out for every id at the end. With
    ``mask`` nucleotide references give no seeds of low complexity; segments
    still run through such stretches. With ``one_per_subject`` only the best
    segment of a pair is kept. Both are off by default. Frequent seeds
    are spread over a grid of tasks.

    With ``gaps`` the segments are extended over gaps (affine costs of the matrix of
    ``scoring``, which must have one); the e-value then is that of the whole
    alignment, with the values of the ungapped scores. With ``pattern`` protein
    seeds are classes of amino acids at its ones, in place of ``k`` equal letters.

    Output: the 13 hit columns, ``strand`` and the query's ``ord``.
    """
    scoring = scoring or (PROTEIN if protein else NUCLEOTIDE)
    if mask and protein:
        raise ValueError("masking is for nucleotide references")
    if gaps and not scoring.matrix:
        raise ValueError("gaps need the costs of a matrix")
    if pattern:
        if not protein:
            raise ValueError("patterns are for proteins")
        k = len(pattern)
    if strands and not protein:
        both = F.array(
            F.struct(F.lit("+").alias("strand"), F.upper("seq").alias("seq")),
            F.struct(F.lit("-").alias("strand"), reverse_complement("seq").alias("seq")),
        )
        query = query.select("id", "ord", F.explode(both).alias("x")).select("id", "ord", "x.*")
    else:
        query = query.select("id", "ord", F.lit("+").alias("strand"), F.upper("seq").alias("seq"))
    # One stored table a side: ids are not worked out again from their sequences.
    queries = stored(query.withColumn("key", seq_key("seq")), "search-queries")
    subjects = stored(
        ref.select("id", "description", F.upper("seq").alias("seq")).withColumn("key", seq_key("seq")),
        "search-refs",
    )
    q = stored(queries.select("key", "seq").dropDuplicates(["key"]), "search-distinct")
    r = stored(subjects.select("key", "seq").dropDuplicates(["key"]), "search-distinct")
    runs = stored(_runs(q, r, k, mask, protein, pattern), "search-runs")
    residues = r.agg(F.sum(F.length("seq")).alias("n")).first().n or 0
    least = _least_raw(scoring, residues, max_evalue, gaps)
    scored = _with_bits(_aligned(_regions(runs, k, reach), q, r, k, min_seeds, scoring, least), residues, scoring)
    if gaps:
        final = _least_raw(scoring, residues, max_evalue, None)
        segments = stored(scored.filter(F.col("bitscore") >= gaps.trigger_bits), "search-segments")
        scored = _with_bits(_extended(segments, q, r, scoring.matrix, gaps, min(reach, _PIECE), final), residues, scoring)
    scored = scored.filter(F.col("evalue") <= max_evalue)
    if one_per_subject:
        rest = ["qlen", "qstart", "qend", "sstart", "send", "seeds", "length", "matches", "gapopen", "evalue"]
        scored = (
            scored.groupBy("q", "r")
            .agg(
                F.max_by(
                    F.struct("bitscore", "diag", *rest),
                    F.struct("bitscore", -F.col("qstart"), "diag"),
                ).alias("b")
            )
            .select("q", "r", "b.*")
        )
    scored = stored(scored, "search-scored")
    q_ids = queries.select(F.col("key").alias("q"), F.col("id").alias("qseqid"), "strand", "ord")
    r_ids = subjects.select(
        F.col("key").alias("r"), F.col("id").alias("sseqid"), F.col("description").alias("stitle")
    )
    # Ids of copies on either side may be many: the grid join spreads them too.
    named = salted_pair_join(scored, q_ids, ["q"], ["r", "diag"], ["qseqid", "ord"])
    named = salted_pair_join(named, r_ids, ["r"], ["qseqid", "ord", "diag"], ["sseqid"])
    plus = F.col("strand") == "+"
    # Columns with a letter on both sides: all letters, less one for each column.
    paired = F.col("qend") - F.col("qstart") + F.col("send") - F.col("sstart") + 2 - F.col("length")
    start = F.when(plus, F.col("qstart")).otherwise(F.col("qlen") - F.col("qend") + 1)
    end = F.when(plus, F.col("qend")).otherwise(F.col("qlen") - F.col("qstart") + 1)
    return named.select(
        "qseqid",
        "sseqid",
        (F.col("matches") / F.col("length") * 100).alias("pident"),
        "length",
        (paired - F.col("matches")).alias("mismatch"),
        "gapopen",
        start.alias("qstart"),
        end.alias("qend"),
        "sstart",
        "send",
        "evalue",
        "bitscore",
        "stitle",
        "strand",
        "ord",
    )


def translated_search(contigs: DataFrame, proteins: DataFrame, k: int = 5, **options) -> DataFrame:
    """Six-frame search of nucleotide contigs in proteins.

    Query positions are nucleotides on the forward strand.
    """
    sized = contigs.withColumn("_n", F.length("seq"))
    frames = translate_frames(sized, keep=("id", "ord", "_n")).select(
        F.struct("id", "strand", "frame", "_n").alias("id"), "ord", F.col("protein").alias("seq")
    )
    hits = similarity_search(frames, proteins, k, protein=True, **options)
    s = F.col("q.frame") + (F.col("qstart") - 1) * 3
    e = F.col("q.frame") + F.col("qend") * 3 - 1
    plus = F.col("q.strand") == "+"
    rest = [c for c in hits.columns if c not in ("qseqid", "qstart", "qend", "strand")]
    return hits.withColumnRenamed("qseqid", "q").select(
        F.col("q.id").alias("qseqid"),
        F.when(plus, s).otherwise(F.col("q._n") - e + 1).alias("qstart"),
        F.when(plus, e).otherwise(F.col("q._n") - s + 1).alias("qend"),
        F.col("q.strand").alias("strand"),
        *rest,
    )


def tag_pathogenic(hits: DataFrame, id2taxid: DataFrame, taxids: DataFrame) -> DataFrame:
    """Add ``staxids`` and ``Pathogenic`` by subject id.

    ``id2taxid (sseqid, taxid)`` and ``taxids (taxid)`` are looked up by
    broadcast while counted small, else by a salted join.
    """
    listed = taxids.select("taxid").distinct().withColumn("_listed", F.lit(True))
    ids = id2taxid.select("sseqid", "taxid").join(listed, "taxid", "left")
    label = (
        F.when(F.col("taxid").isNull(), UNKNOWN)
        .when(F.col("_listed"), PATHOGENIC)
        .otherwise(NON_PATHOGENIC)
    )
    return (
        lookup_join(hits, ids, ["sseqid"], "left")
        .withColumn("Pathogenic", label)
        .withColumnRenamed("taxid", "staxids")
        .drop("_listed")
    )


@dataclass(frozen=True)
class Tier:
    """One database of the annotation cascade with its limits."""

    name: str
    hits: DataFrame
    max_evalue: float
    min_cover: float | None = None


# E-value and cover limits of the annotation cascade.
CASCADE = (("IS", 1e-30, 90), ("AMR", 1e-300, 90), ("sprot", 1e-9, 80), ("HAMAP", 1e-9, None))


def tiered_annotation(
    proteins: DataFrame, tiers: Sequence[Tier], key: str = "qseqid", ties: tuple[str, ...] = ("sseqid",)
) -> DataFrame:
    """Product of each protein from the first tier with a passing hit.

    Equal to running the tiers one after the other on what is left: the best
    hit by (tier, bit score) is one map-side combined minimum per protein, so
    a protein with very many hits needs no window. Hits need a ``cover``
    column where a tier sets ``min_cover``.
    """
    parts = []
    for i, tier in enumerate(tiers):
        passing: Column = F.col("evalue") <= tier.max_evalue
        if tier.min_cover is not None:
            passing = passing & (F.col("cover") >= tier.min_cover)
        parts.append(
            tier.hits.filter(passing).select(
                key,
                F.struct(
                    F.lit(i).alias("tier_no"),
                    (-F.col("bitscore")).alias("s"),
                    *ties,
                    F.lit(tier.name).alias("tier"),
                    F.col("sseqid").alias("subject"),
                    F.col("stitle").alias("product"),
                ).alias("h"),
            )
        )
    hits = parts[0]
    for part in parts[1:]:
        hits = hits.unionByName(part)
    best = hits.groupBy(key).agg(F.min("h").alias("h"))
    return proteins.join(best, key, "left").select(
        *proteins.columns,
        F.col("h.tier").alias("tier"),
        F.col("h.subject").alias("subject"),
        F.coalesce("h.product", F.lit("hypothetical protein")).alias("product"),
    )


def attach_genes(hits: DataFrame, annotation: DataFrame) -> DataFrame:
    """Hits with the annotation row of their predicted protein."""
    genes = annotation.withColumnRenamed("locus_tag", "qseqid")
    return salted_join(hits, genes, ["qseqid"], "inner")

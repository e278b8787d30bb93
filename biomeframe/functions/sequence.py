"""Column functions and row generators for nucleotide sequences."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

# The IUPAC nucleotide codes and their complements, and the
# amino acids of NCBI translation table 11 with bases in the order T, C, A, G.
IUPAC_BASES = "ACGTURYKMBVDHSWN"
IUPAC_COMPLEMENTS = "TGCAAYRMKVBHDSWN"
CODON_BASES = "TCAG"
CODON_AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
START_CODONS = ("ATG", "GTG", "TTG")
STOP_CODONS = ("TAA", "TAG", "TGA")
#: Strands that are translated together.
_TRANSLATED = 256


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seq_key(seq: Column | str) -> Column:
    """md5 of the sequence exactly as written; the key of the search cache."""
    return F.md5(_col(seq))


def gc_fraction(seq: Column | str) -> Column:
    """Share of G and C, null for an empty sequence."""
    s = _col(seq)
    n = F.length(s)
    return F.when(n > 0, (n - F.length(F.translate(s, "GCgc", ""))) / n)


def reverse_complement(seq: Column | str) -> Column:
    return F.reverse(F.translate(F.upper(_col(seq)), IUPAC_BASES, IUPAC_COMPLEMENTS))


def kmer_code(kmer: Column | str, k: int) -> Column:
    """Exact packed form (long) of an upper-case A/C/G/T k-mer with k <= 31."""
    return _pack(F.translate(_col(kmer), "ACGT", "0123"), k)


def _pack(digits: Column, k: int) -> Column:
    # Up to 18 digits can be read as a decimal number, which is much cheaper.
    return digits.try_cast("long") if k <= 18 else F.conv(digits, 4, 10).cast("long")


def kmer_text(code: Column | str, k: int) -> Column:
    """The k-mer behind a packed form."""
    digits = _col(code).cast("string")
    if k > 18:
        digits = F.conv(digits, 10, 4)
    return F.translate(F.lpad(digits, k, "0"), "0123", "ACGT")


def canonical(kmer: Column | str) -> Column:
    """The smaller of a k-mer and its reverse complement."""
    return F.least(_col(kmer), reverse_complement(kmer))


def low_complexity(kmer: Column | str, k: int) -> Column:
    """True if two bases make up all but an eighth of the k-mer.

    Plays the part of the soft masking that search tools apply to seeds. It
    looks at the k-mer alone, so the same seed is masked in every data set.
    """
    s = _col(kmer)
    without = F.transform(
        F.array(*[F.lit(b) for b in "ACGT"]), lambda b: F.length(F.replace(s, b, F.lit("")))
    )
    two_most = F.aggregate(F.slice(F.sort_array(without), 1, 2), F.lit(0), lambda a, x: a + x)
    return two_most <= k + k // 8


def explode_kmers(
    df: DataFrame,
    k: int,
    seq: str = "seq",
    keep: tuple[str, ...] = ("id", "ord"),
    strands: bool = False,
    acgt_only: bool = True,
    packed: bool = False,
    flanks: bool = False,
) -> DataFrame:
    """One row per k-mer: the kept columns, 1-based ``pos`` and ``kmer``.

    ``strands=True`` gives the canonical form, ``packed=True`` longs, and
    ``flanks=True`` the character codes ``prev`` and ``next`` of the letters
    around the k-mer, 0 at the ends and, under ``acgt_only``, for other letters
    than A, C, G, T. Case,
    complement and digits are worked out once per sequence; a k-mer is then a
    cut of bytes, O(k), where cutting a string would cost O(pos).
    """
    up = F.upper(seq)
    bases = "ACGT0123"
    forward = F.translate(up, bases, "0123NNNN") if packed else up
    columns = [forward.cast("binary").alias("_f")]
    if strands:
        back = F.reverse(
            F.translate(up, bases, "3210NNNN")
            if packed
            else F.translate(up, IUPAC_BASES, IUPAC_COMPLEMENTS)
        )
        columns.append(back.cast("binary").alias("_r"))
    if acgt_only:
        columns.append((F.translate(up, "ACGT", "") == "").alias("_pure"))
    n = F.length("_f") - (k - 1)
    names = ["_f", "_r"] if strands else ["_f"]
    flag = ["_pure"] if acgt_only else []
    rows = df.select(*keep, *columns).select(
        *keep, *names, *flag, F.explode(F.when(n >= 1, F.sequence(F.lit(1), n))).alias("pos")
    )
    width = F.lit(k)
    kmer = F.col("_f").substr(F.col("pos"), width).cast("string")
    if acgt_only:
        rest = F.translate(kmer, "0123" if packed else "ACGT", "")
        rows = rows.filter(F.col("_pure") | (rest == ""))
    if strands:
        kmer = F.least(kmer, F.col("_r").substr(n - F.col("pos") + 1, width).cast("string"))
    sides = []
    if flanks:
        at = {"prev": F.col("pos") - 1, "next": F.col("pos") + k}
        for name, place in at.items():
            code = F.ascii(F.col("_f").substr(place, F.lit(1)).cast("string"))
            inside = place >= 1
            if acgt_only:
                inside = inside & (F.col("_pure") | code.isin(*map(ord, "0123" if packed else "ACGT")))
            sides.append(F.when(inside, code).otherwise(0).alias(name))
    return rows.select(*keep, "pos", (_pack(kmer, k) if packed else kmer).alias("kmer"), *sides)


def explode_minimizers(
    df: DataFrame,
    k: int,
    length: int,
    seq: str = "seq",
    keep: tuple[str, ...] = ("id", "ord"),
) -> DataFrame:
    """One row per k-mer window with its smallest inner ``length``-mer."""
    windows = explode_kmers(df, k, seq, keep)
    inner = [F.substring("kmer", i, length) for i in range(1, k - length + 2)]
    smallest = F.least(*inner) if len(inner) > 1 else inner[0]
    return windows.select(*keep, "pos", smallest.alias("minimizer"))


def strand_frames(
    df: DataFrame, seq: str = "seq", keep: tuple[str, ...] = ("id", "ord")
) -> DataFrame:
    """Six rows per sequence: ``strand`` (+/-), ``frame`` (1..3), bytes ``_dna``.

    The explode keeps Catalyst from inlining the byte cast into per-codon
    lambdas, where it would copy the whole sequence for every codon.
    """
    return _strands(df, seq, keep).withColumn("frame", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))


def _strands(df: DataFrame, seq: str, keep: tuple[str, ...]) -> DataFrame:
    both = F.array(
        F.struct(F.lit("+").alias("strand"), F.upper(seq).cast("binary").alias("dna")),
        F.struct(F.lit("-").alias("strand"), reverse_complement(seq).cast("binary").alias("dna")),
    )
    return df.select(*keep, F.explode(both).alias("s")).select(
        *keep, F.col("s.strand").alias("strand"), F.col("s.dna").alias("_dna")
    )


def codons(dna: str, frame: Column, render) -> Column:
    """Array of ``render(codon)`` over the whole codons of a frame."""
    last = F.length(dna) - 2
    return F.when(
        last >= frame,
        F.transform(
            F.sequence(frame, last, F.lit(3)),
            lambda i: render(F.col(dna).substr(i, F.lit(3)).cast("string")),
        ),
    ).otherwise(F.array().cast("array<string>"))


_CODON_LINE = "".join(
    f"{a}{b}{c}." for a in CODON_BASES for b in CODON_BASES for c in CODON_BASES
)


def amino_acid(codon: Column) -> Column:
    """One-letter amino acid; X if the codon holds an ambiguous base.

    The place of the codon in the line of all codons is its table index.
    """
    place = F.instr(F.lit(_CODON_LINE), codon)
    return F.substring(F.lit("X" + CODON_AMINO_ACIDS), F.shiftright(place + 3, 2) + 1, F.lit(1))


def translate_frames(
    df: DataFrame,
    seq: str = "seq",
    keep: tuple[str, ...] = ("id", "ord"),
) -> DataFrame:
    """Six-frame translation: kept columns, ``strand``, ``frame``, ``protein``.

    The codons at all places of a batch are looked up together (numpy, in the
    tasks); a frame is every third of them.
    """
    rows = _strands(df, seq, keep)
    schema = StructType(rows.drop("_dna").schema.fields).add("frame", IntegerType(), False).add("protein", StringType())
    bases = np.full(256, 64, dtype=np.int16)  # another letter makes any codon's number 64 or more
    bases[list(CODON_BASES.encode())] = range(4)
    acids = np.frombuffer((CODON_AMINO_ACIDS + "X").encode(), np.uint8)
    names = [f.name for f in schema]

    def of(batches):
        import numpy as np
        import pyarrow as pa

        for whole in batches:
            for at in range(0, whole.num_rows, _TRANSLATED):
                batch = whole.slice(at, _TRANSLATED)
                dna = [x or b"" for x in batch.column("_dna").to_pylist()]
                codes = bases[np.frombuffer(b"".join(dna) + b"..", np.uint8)]
                text = acids[np.minimum(codes[:-2] * 16 + codes[1:-1] * 4 + codes[2:], 64)].tobytes().decode()
                proteins, start = [], 0
                for n in map(len, dna):
                    end = max(start + n - 2, start)
                    proteins += [text[start:end:3], text[start + 1 : end : 3], text[start + 2 : end : 3]]
                    start += n
                kept = batch.select(names[:-2]).take(pa.array(np.repeat(np.arange(len(dna)), 3)))
                frames = pa.array(np.tile(np.arange(1, 4), len(dna)), pa.int32())
                yield pa.RecordBatch.from_arrays([*kept.columns, frames, pa.array(proteins, pa.string())], names=names)

    return rows.mapInArrow(of, schema)


def translate_cds(
    df: DataFrame, seq: str = "seq", out: str = "protein", start_as_met: bool = True
) -> DataFrame:
    """Translate a coding sequence in frame 1, up to but not with its stop.

    A bacterial start codon reads as M even where it is GTG or TTG.
    """
    rows = df.withColumn("_cds", F.explode(F.array(F.upper(seq).cast("binary"))))
    text = F.array_join(codons("_cds", F.lit(1), amino_acid), "")
    rows = rows.withColumn(out, F.regexp_replace(text, r"\*$", ""))
    if start_as_met:
        first = F.col("_cds").substr(F.lit(1), F.lit(3)).cast("string")
        rows = rows.withColumn(
            out,
            F.when(
                first.isin(*START_CODONS),
                F.concat(F.lit("M"), F.expr(f"substring({out}, 2)")),
            ).otherwise(F.col(out)),
        )
    return rows.drop("_cds")

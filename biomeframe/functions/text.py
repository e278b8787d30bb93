"""Column functions for descriptions, titles and number formats."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# A capitalised word followed by a lower-case word; no look-around, so other
# SQL engines can run the same expression.
GENUS_SPECIES = (
    r"(?:^|\s)(\p{Lu}[^\s\p{Lu}]*\p{Ll}[^\s\p{Lu}]*)\s+(\p{Ll}\p{L}*)(?:\s|$)"
)

# Keyword lists of the resistance classes, first match wins.
RESISTANCE_CLASSES = {
    "beta-lactam": ["beta-lactam", "penicillin", "ampicillin", "cephalosporin"],
    "aminoglycoside": ["aminoglycoside", "streptomycin", "gentamicin", "kanamycin"],
    "tetracycline": ["tetracycline", "doxycycline"],
    "quinolone": ["quinolone", "fluoroquinolone", "ciprofloxacin"],
    "macrolide": ["macrolide", "erythromycin", "azithromycin"],
    "chloramphenicol": ["chloramphenicol"],
    "sulfonamide": ["sulfonamide", "sulfamethoxazole"],
    "trimethoprim": ["trimethoprim"],
    "vancomycin": ["vancomycin"],
    "lincosamide": ["lincosamide", "clindamycin"],
}

# Keyword lists of the virulence categories, first match wins.
VIRULENCE_CATEGORIES = {
    "adhesion": ["adhesin", "fimbri", "pili", "attach", "binding"],
    "toxin": ["toxin", "hemolysin", "cytotoxin", "enterotoxin"],
    "secretion_system": [
        "secretion", "type III", "type IV", "type VI", "T3SS", "T4SS", "T6SS",
    ],
    "immune_evasion": ["capsule", "LPS", "immune", "evasion", "resistance"],
    "invasion": ["invasion", "invasin", "penetration"],
    "motility": ["flagell", "motility", "chemotaxis"],
    "regulation": ["regulator", "sensor", "response", "quorum"],
    "stress_survival": ["stress", "survival", "persistence", "dormancy"],
}

# Labels of the identity bands, each open below and closed above.
IDENTITY_BANDS = [
    (0, 30, "Poor (<30%)"),
    (30, 50, "Low (30-50%)"),
    (50, 70, "Moderate (50-70%)"),
    (70, 90, "Good (70-90%)"),
    (90, 100, "Excellent (>90%)"),
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def base_id(header: Column | str) -> Column:
    """First token of a sequence header, without the leading ``>``."""
    return F.regexp_extract(_col(header), r"^>?\s*(\S+)", 1)


def organism_of(description: Column | str) -> Column:
    """Organism named in a hit description.

    The text after the last ``[`` if the description has brackets; else the
    first capitalised word followed by a lower-case one; else three words.
    """
    d = _col(description)
    bracketed = F.trim(F.replace(F.element_at(F.split(d, r"\["), -1), F.lit("]"), F.lit("")))
    genus = F.regexp_extract(d, GENUS_SPECIES, 1)
    species = F.regexp_extract(d, GENUS_SPECIES, 2)
    words = F.filter(F.split(d, r"\s+"), lambda w: w != "")
    return (
        F.when(d.contains("[") & d.contains("]"), bracketed)
        .when(genus != "", F.concat_ws(" ", genus, species))
        .otherwise(F.array_join(F.slice(words, 1, 3), " "))
    )


def keyword_category(
    title: Column | str,
    dictionary: Mapping[str, Sequence[str]],
    default: str = "other",
    lower_keywords: bool = True,
) -> Column:
    """First category, in dictionary order, with a keyword inside the title.

    The title is lower-cased. With ``lower_keywords=False`` the keywords are
    matched as written, so those holding capitals never match.
    """
    text = F.lower(_col(title))
    out: Column | None = None
    for category, keywords in dictionary.items():
        hit: Column | None = None
        for word in keywords:
            one = text.contains(word.lower() if lower_keywords else word)
            hit = one if hit is None else hit | one
        if hit is None:
            continue
        out = F.when(hit, category) if out is None else out.when(hit, category)
    return F.lit(default) if out is None else out.otherwise(default)


def amr_class(title: Column | str) -> Column:
    return keyword_category(title, RESISTANCE_CLASSES)


def vf_category(title: Column | str, compat: bool = False) -> Column:
    """Virulence category; ``compat=True`` leaves capitals in the keywords."""
    return keyword_category(title, VIRULENCE_CATEGORIES, lower_keywords=not compat)


def identity_band(pident: Column | str) -> Column:
    p = _col(pident)
    out: Column | None = None
    for low, high, label in IDENTITY_BANDS:
        inside = (p > low) & (p <= high)
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out


def fmt_sci(x: Column | str) -> Column:
    """Two-digit scientific notation, as in 3.58e-58."""
    return F.format_string("%.2e", _col(x).cast("double"))


def fmt_fixed(x: Column | str, digits: int = 2) -> Column:
    return F.format_string(f"%.{digits}f", _col(x).cast("double"))


def shorten(text: Column | str, n: int = 50) -> Column:
    t = _col(text)
    return F.when(F.length(t) > n, F.concat(F.substring(t, 1, n), F.lit("..."))).otherwise(t)


def search_time_label(n: Column | str, seconds_each: int = 2) -> Column:
    """Expected time of a search over ``n`` sequences, as a short label."""
    total = _col(n).cast("long") * seconds_each
    return (
        F.when(total < 60, F.format_string("~%d seconds", total))
        .when(total < 3600, F.format_string("~%.1f minutes", total / 60))
        .otherwise(F.format_string("~%.1f hours", total / 3600))
    )


def product_fields(title: Column | str) -> Column:
    """Pieces of a protein title: product, organism, taxid and gene."""
    t = _col(title)

    def piece(pattern: str) -> Column:
        found = F.regexp_extract(t, pattern, 1)
        return F.when(found != "", found)

    return F.struct(
        piece(r"^\S+\s+(.*?)(?:\s+OS=|$)").alias("product"),
        piece(r"OS=(.*?)(?:\s+[A-Z]{2}=|$)").alias("organism"),
        piece(r"OX=(\d+)").cast("long").alias("taxid"),
        piece(r"GN=(\S+)").alias("gene"),
    )


def mean_quality(qual: Column | str, offset: int = 33) -> Column:
    """Mean base quality of a Phred string, null if it is empty."""
    q = _col(qual)
    n = F.length(q)
    total = F.aggregate(
        F.split(q, ""), F.lit(0), lambda acc, c: acc + F.ascii(c) - F.when(c != "", offset).otherwise(0)
    )
    return F.when(n > 0, total / n)

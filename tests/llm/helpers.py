"""Frames with awkward rows, and small texts, for the tests of the training-data operators."""

import random

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "c1 string, fp string, h int, label string, batch int, text_hash string, lettered string"
)


def docs_frame(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang, source); with extra clashing columns."""
    full = []
    for row in rows:
        doc_id, text, *rest = row
        lang, source = rest or ("en", "s")
        full.append((doc_id, text, lang, source, len(text or ""), "x", "x", 1, "x", 1, "x", "x"))
    return spark.createDataFrame(full, SCHEMA)


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice("abcdefghijklmnop") * rng.randint(1, 3) + str(rng.randint(0, 60)) for _ in range(n))


AWKWARD = [
    (None, None), (None, "no id here"), (1, None), (2, ""), (3, " \n\t "), (4, "word"),
    (5, prose(1, 80)), (5, prose(1, 80)), (6, prose(1, 80)), (7, "\x0b9 8 7\r\n"), (8, "ÄÖÜ ß\n\nñ é"),
]

"""Quality rules: frequent lines of a host, and repetition inside a document.

Lines are normalised and hashed. Per host the distinct documents with a line are
counted; exact copies of a text count as one document. Lines above the limit are
boilerplate. A document that keeps too little without them is depleted; ``keep_good``
returns the others without these lines.

Only built-in expressions are used. Text is read once; what is shuffled is a hash
and a word count for each line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biomeframe.llm.common import SPACE_RUN, SPACES, free_name, trimmed, words
from biomeframe.session import stored

SYMBOLS = "#*$%&|<>"
#: A line is boilerplate in a host if more distinct documents have it than both of these allow.
MAX_DOCS = 10
MAX_SHARE = 0.10
#: ``keep_good`` also takes a line for boilerplate that more distinct documents of a host have.
MANY_DOCS = 100
#: A document is depleted if it keeps less than this share of its words, or fewer words.
MIN_KEPT_SHARE = 0.5
MIN_KEPT_WORDS = 25
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def normalised_line(line: Column) -> Column:
    """Lower case, digit runs as 0, white space runs as one space, trimmed."""
    return F.regexp_replace(F.regexp_replace(trimmed(F.lower(line)), SPACE_RUN, " "), r"\d+", "0")


def _has_word(line: Column) -> Column:
    return F.length(F.translate(line, SPACES, "")) > 0


def _host(host: str) -> Column:
    return F.coalesce(F.col(host).cast("string"), F.lit(""))


def _measured(docs: DataFrame, doc_id: str, text: str, host: str) -> DataFrame:
    raw = F.coalesce(F.col(text), F.lit(""))
    first = docs.select(
        F.col(doc_id).alias("doc_id"),
        _host(host).alias("host"),
        F.xxhash64(raw).alias("c1"),
        F.xxhash64(raw, F.lit(1)).alias("c2"),
        F.length(F.translate(raw, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(raw) - F.length(F.translate(raw, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split(raw, "\n", -1), _has_word).alias("lines"),
        F.transform(words(F.col(text)), lambda w: F.xxhash64(w)).alias("w"),
    )
    second = first.select(
        "doc_id", "host", "c1", "c2", "word_chars", "n_symbols",
        F.size("w").cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("lines", normalised_line).alias("norm"),
        F.expr(
            "CASE WHEN size(w) < 4 THEN array() ELSE"
            " transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2])) END"
        ).alias("grams"),
    )
    third = second.select(
        "doc_id", "host", "c1", "c2", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.transform(
            "norm",
            lambda x: F.struct(
                F.xxhash64(x).alias("h"),
                (F.length(x) - F.length(F.translate(x, " ", "")) + 1).cast("long").alias("n"),
            ),
        ).alias("lines"),
        # In most texts few windows repeat: the sort with positions is for those with any.
        F.expr(
            "CASE WHEN size(array_distinct(grams)) = size(grams)"
            " THEN CAST(array() AS array<struct<h: bigint, i: int>>)"
            " ELSE sort_array(transform(grams, (h, i) -> struct(h, i))) END"
        ).alias("sorted"),
    )
    return third.withColumn(
        "repeats",
        F.expr(
            "filter(sorted, (x, k) -> x.h = get(sorted, k - 1).h OR x.h = get(sorted, k + 1).h)"
        ),
    ).select(
        "doc_id", "host", "c1", "c2", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.expr(
            "CAST(size(array_distinct(flatten(transform(repeats,"
            " x -> array(x.i, x.i + 1, x.i + 2))))) AS bigint)"
        ).alias("n_repeat_words"),
        "lines",
    )


def frequent_lines(
    measured: DataFrame, max_docs: int = MAX_DOCS, max_share: float = MAX_SHARE, many_docs: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Lines of distinct documents, and the (host, h) above the limits.

    A line of over ``many_docs`` documents, if given, needs no share of the host.

    A host or a line with a third of all rows is no single task: copies of a
    document go first, and both counts combine on the map side.
    """
    lines = (
        measured.select("host", "c1", "c2", F.posexplode("lines").alias("pos", "line"))
        .select("host", "c1", "c2", "pos", "line.h", "line.n")
        .distinct()
    )
    counted = (
        lines.groupBy("host", "h", "c1", "c2").agg(F.count(F.lit(1)).alias("times"))
        .groupBy("host", "h").agg(F.count(F.lit(1)).alias("docs"))
        .filter(F.col("docs") > max_docs)
    )
    hosts = (
        measured.select("host", "c1", "c2").distinct()
        .groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    )
    above = F.col("docs") > F.col("host_docs") * F.lit(max_share)
    if many_docs is not None:
        above = above | (F.col("docs") > many_docs)
    frequent = counted.join(hosts, "host").filter(above)
    return lines, frequent.select("host", "h")


def quality_report(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    max_docs: int = MAX_DOCS,
    max_share: float = MAX_SHARE,
    min_kept_share: float = MIN_KEPT_SHARE,
    min_kept_words: int = MIN_KEPT_WORDS,
) -> DataFrame:
    """One row for each row of ``docs``: measures, base rules and verdict.

    Columns: doc_id, c1 and c2 (hashes of the text), n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, base_failed, removed_words (words in
    boilerplate lines), kept.

    A null text counts as empty and fails the base rules; a null host and an
    empty one are the same host; a null doc_id stays null. Repeated rows give
    repeated results. Lines without a word are no lines. Other columns of
    ``docs`` are ignored. The measures are written once to the shared folder.
    """
    measured = stored(_measured(docs, doc_id, text, host), "quality")
    limits = max_docs, max_share, min_kept_share, min_kept_words
    return _judged(measured, *limits).drop("host", "gone_lines")


def _judged(
    measured: DataFrame, max_docs: int, max_share: float, min_kept_share: float, min_kept_words: int,
    many_docs: int | None = None,
) -> DataFrame:
    """``quality_report`` with the host, and gone_lines: hashes of a document's boilerplate lines or null."""
    lines, frequent = frequent_lines(measured, max_docs, max_share, many_docs)
    removed = (
        lines.join(frequent, ["host", "h"])
        .groupBy("host", "c1", "c2").agg(
            F.sum("n").alias("removed_words"), F.collect_set("h").alias("gone_lines")
        )
    )
    out = measured.join(removed, ["host", "c1", "c2"], "left")
    gone = F.coalesce(F.col("removed_words"), F.lit(0))
    left = F.col("n_words") - gone
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    )
    depleted = (gone > 0) & (
        (left < F.col("n_words") * F.lit(min_kept_share)) | (left < min_kept_words)
    )
    return out.select(
        "doc_id", "c1", "c2", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        gone.alias("removed_words"),
        (~failed & ~depleted).alias("kept"),
        "host", "gone_lines",
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, without boilerplate lines.

    As in ``quality_report``, but a line of over ``MANY_DOCS`` distinct documents
    is boilerplate in a host of any size.

    Other lines, also blank ones, stay as they are; n_chars, if there is such a
    column, is the length of the text that is left. Rows are found again by
    doc_id, host and text, so repeated rows share one verdict. A null or empty text
    fails the base rules; a null doc_id is one id, a null host the empty one. Other
    columns may have any name.
    """
    measured = stored(_measured(docs, "doc_id", "text", "source"), "quality")
    judged = _judged(measured, MAX_DOCS, MAX_SHARE, MIN_KEPT_SHARE, MIN_KEPT_WORDS, MANY_DOCS).filter("kept")
    names = {c: free_name(docs, f"_{c}") for c in ("doc_id", "host", "c1", "c2", "gone_lines")}
    good = judged.select(*[F.col(c).alias(name) for c, name in names.items()])
    good = good.dropDuplicates([name for c, name in names.items() if c != "gone_lines"])
    raw = F.coalesce(F.col("text"), F.lit(""))
    same = (
        docs["doc_id"].eqNullSafe(good[names["doc_id"]])
        & (_host("source") == good[names["host"]])
        & (F.xxhash64(raw) == good[names["c1"]])
        & (F.xxhash64(raw, F.lit(1)) == good[names["c2"]])
    )
    gone = F.col(names["gone_lines"])
    stays = lambda line: ~_has_word(line) | ~F.array_contains(gone, F.xxhash64(normalised_line(line)))
    left = F.array_join(F.filter(F.split("text", "\n", -1), stays), "\n")
    cleaned = F.when(gone.isNull(), F.col("text")).otherwise(left)
    out = docs.join(good, same).withColumn("text", cleaned)
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(gone.isNull(), F.col("n_chars")).otherwise(size))
    return out.select(*docs.columns)

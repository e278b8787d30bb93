import re
from collections import Counter

from biomeframe.llm import quality
from tests.llm.helpers import AWKWARD, docs_frame, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_base_measures(spark):
    docs = AWKWARD + [(20, "a b c a b c a"), (21, "x\nx\n x\n\n\nx"), (22, "#*$ %&|<>| é#"), (23, ("to be or not " * 40))]
    got = quality.quality_report(docs_frame(spark, docs)).collect()
    assert len(got) == len(docs)
    want = sorted(((d is None, d or 0), base(t)) for d, t in docs)
    have = sorted(((r.doc_id is None, r.doc_id or 0), (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got)
    assert have == want
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in got)


def test_boilerplate_lines(spark):
    notice = "All rights  reserved 2019 " + prose(77, 40)
    short, long = prose(5, 30), prose(6, 120)
    docs = []
    for k in range(30):
        other = f"ALL rights reserved {2000 + k} " + prose(77, 40)
        docs.append((k, f"{prose(100 + k, 55)}\n{other}", "en", "h"))
    docs += [(50, f"{short}\n{notice}", "en", "h"), (51, f"{long}\n{notice}", "en", "h"), (52, f"{short}\n{notice}", "en", None)]
    docs += [(60 + k, f"{prose(8, 60)}\n{prose(9, 60)}", "en", "h") for k in range(25)]
    got = {r.doc_id: r for r in quality.quality_report(docs_frame(spark, docs)).collect()}
    assert not got[50].kept and got[50].removed_words == 44
    assert got[51].kept and got[51].removed_words == 44
    assert got[52].kept and got[52].removed_words == 0
    assert all(got[60 + k].kept for k in range(25)), "copies of a document count once"
    kept = quality.keep_good(docs_frame(spark, docs))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, r in got.items() if r.kept)
    assert kept.columns == docs_frame(spark, []).columns


def test_boilerplate_lines_leave_the_kept_text(spark):
    notice = "Contact the  owner 2019"
    docs = [(k, f"{prose(300 + k, 60)}\n\nCONTACT the owner {k}\n{prose(400 + k, 9)}", "en", "h") for k in range(20)]
    docs += [(30, f"{prose(1, 60)}\n{notice}", "en", "h"), (31, f"{prose(1, 60)}\n{notice}", "en", "other"), (None, docs[0][1], "en", "h")]
    kept = quality.keep_good(docs_frame(spark, docs)).collect()
    got = sorted(((r.doc_id is None, r.doc_id), r.text, r.n_chars) for r in kept)
    want = [(d, f"{prose(300 + k, 60)}\n\n{prose(400 + k, 9)}") for k, d in enumerate([*range(20)])]
    want += [(30, prose(1, 60)), (31, docs[-2][1]), (None, want[0][1])]
    assert got == sorted(((d is None, d), t, len(t)) for d, t in want)


def test_line_of_many_documents_of_a_large_host(spark):
    docs = [(k, f"{prose(k, 60)}" + ("\nFollow us" if k < 101 else "\nSee below" if k < 201 else ""), "en", "h") for k in range(3000)]
    kept = {r.doc_id: r.text for r in quality.keep_good(docs_frame(spark, docs)).collect()}
    assert len(kept) == 3000
    assert all("Follow us" not in kept[k] for k in range(101))
    assert all(kept[k].endswith("See below") for k in range(101, 201)), "100 documents are not too many"


def test_empty(spark):
    assert quality.quality_report(docs_frame(spark, [])).count() == 0
    assert quality.keep_good(docs_frame(spark, AWKWARD)).filter("text IS NULL").count() == 0


def test_columns_of_any_name(spark):
    docs = docs_frame(spark, [(k, prose(k, 80), "en", "h") for k in range(12)] + AWKWARD)
    for name in ("_c1", "_doc_id", "_host", "_gone_lines", "_c2"):
        docs = docs.withColumn(name, docs["doc_id"].cast("string"))
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= set(range(12))

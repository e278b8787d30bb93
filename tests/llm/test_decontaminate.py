import re

from biomeframe.llm.decontaminate import contained_items, drop_contaminated
from tests.llm.helpers import AWKWARD, docs_frame, prose


def shingles(text, width=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    width = min(width, len(w)) or 1
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}, width


def brute(docs, items):
    out = set()
    for item, text in items:
        own, width = shingles(text)
        for doc, body in docs:
            if own and len(own & {s for s in shingles(body, width)[0] if len(s) == width}) >= 0.8 * len(own) - 1e-9:
                out.add((doc, item))
    return out


def bench_frame(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def test_matches_brute_force(spark):
    items = [(k, prose(100 + k, 12 + 3 * k)) for k in range(8)] + [(50, "Two words"), (51, "one two three four five")]
    docs = list(AWKWARD)
    for k in range(8):
        words = items[k][1].split()
        docs.append((20 + k, prose(k, 300) + " " + " ".join(words).upper() + "\n" + prose(k + 9, 900)))
        cut = len(words) - len(words) // 6
        docs.append((40 + k, prose(k, 30) + " " + " ".join(words[:cut]) + " " + prose(k + 5, 20)))
        docs.append((60 + k, prose(k, 30) + " " + " ".join(words[: len(words) // 2])))
    docs += [(80, "say two  WORDS now"), (81, "two other words"), (82, "one two three four five"), (83, items[0][1])]
    got = contained_items(docs_frame(spark, docs), bench_frame(spark, items)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute(docs, items)
    kept = drop_contaminated(docs_frame(spark, docs), bench_frame(spark, items))
    bad = {d for d, _ in brute(docs, items)}
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(d or -1 for d, _ in docs if d not in bad)
    assert kept.columns == docs_frame(spark, []).columns


def test_empty_tables_and_items_without_words(spark):
    some, none = docs_frame(spark, AWKWARD), docs_frame(spark, [])
    assert contained_items(none, bench_frame(spark, [(1, "a b c d e f")])).count() == 0
    for rows in ([], [(1, None), (2, " ")]):
        assert contained_items(some, bench_frame(spark, rows)).count() == 0
        assert drop_contaminated(some, bench_frame(spark, rows)).count() == len(AWKWARD)


def test_null_and_repeated_ids(spark):
    items = [(None, prose(1, 80)), (3, prose(1, 80)), (3, prose(1, 80))]
    got = contained_items(docs_frame(spark, AWKWARD + [(None, prose(1, 80))]), bench_frame(spark, items))
    found = sorted((r.doc_id or -1, r.item_id or -1) for r in got.collect())
    assert found == [(-1, -1), (-1, 3), (5, -1), (5, 3), (6, -1), (6, 3)]

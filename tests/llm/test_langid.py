import math
import os
import zlib
from collections import Counter

import numpy as np
import pytest

from biomeframe.llm import langid
from tests.llm.helpers import AWKWARD, docs_frame

EN = "the cat and the dog went with that thing of the house when this was over"
DE = "der hund und die katze sind nicht mit dem haus auf der straße über ein"


def labelled(spark):
    en, de = EN.split(), DE.split()
    rows = [(k, " ".join(en[k % 9 :] + en[: k % 5]), "en", "s") for k in range(40)]
    return docs_frame(spark, rows + [(100 + k, " ".join(de[k % 9 :] + de[: k % 5]), "de", "s") for k in range(40)]
                      + [(300, None, "de", "s"), (301, "x", None, "s")])


def test_predict(spark):
    model = langid.train(labelled(spark))
    assert model.languages == ["de", "en"]
    docs = docs_frame(spark, AWKWARD + [(50, "the house was over"), (51, "die straße und der hund"), (52, "12 34 !")])
    got = {(r.doc_id, r.lang_pred): r.score for r in langid.predict(docs, model).collect()}
    assert (50, "en") in got and (51, "de") in got and got[52, "und"] == 0.0 and got[1, "und"] == 0.0
    assert all(0 <= s <= 1 for s in got.values())
    assert langid.predict(docs, model).count() == len(AWKWARD) + 3
    kept = langid.keep_languages(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {50, 51} and kept.filter("doc_id IN (1, 2, 3, 52)").count() == 0
    assert langid.predict(docs.limit(0), model).count() == 0


def test_without_labels(spark):
    model = langid.train(docs_frame(spark, []))
    assert {r.lang_pred for r in langid.predict(docs_frame(spark, AWKWARD), model).collect()} == {"und"}


def test_blocks_do_not_matter(monkeypatch):
    texts = [EN, DE * 7, "a", "ß " * 50, EN * 3]
    whole = langid.ngram_counts(texts)
    alone = sum(langid.ngram_counts([t]) for t in texts)
    assert (whole == alone).all()
    with monkeypatch.context() as patch:
        patch.setattr(langid, "_BLOCK", 64)
        assert (langid.ngram_counts(texts) == whole).all()
    rng = np.random.default_rng(1)
    model = langid.Model(["a", "b"], np.zeros(2), rng.normal(size=(2, 1 << langid.BITS)).astype(np.float32))
    want = langid.scores(model, texts)
    monkeypatch.setattr(langid, "_BLOCK", 64)
    assert np.allclose(langid.scores(model, texts), want)


DIR = "/root/testdata/sf0.01"
ALIENS = [
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto",
    "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью",
    "xkcq zvbn wrtp ghjk lmnb vcxz qwrt plkj hgfd sdfg zxcv bnmq wrtz pkjl",
]


def plain_model(rows):
    """Naive Bayes with a dictionary of counts for each language, n-gram by n-gram."""
    counts, totals = {}, Counter()
    for text, lang in rows:
        totals[lang] += 1
        counts.setdefault(lang, Counter()).update(grams(text))
    return counts, totals


def grams(text):
    folded = np.array([0, *[ord(c) if c.isalpha() else 0 for c in text.lower()], 0, 0], dtype=np.uint32)
    return [int(x) for some in langid._buckets(folded) for x in some]


def plain_scores(counts, totals, text):
    out = {}
    for lang, table in counts.items():
        total = sum(table.values()) + langid.SMOOTHING * (1 << langid.BITS)
        out[lang] = math.log(totals[lang] / sum(totals.values())) + sum(
            math.log((table[g] + langid.SMOOTHING) / total) for g in grams(text)
        )
    return out


def test_against_plain_naive_bayes(spark):
    rows = [(r.text, r.lang) for r in labelled(spark).collect() if r.text is not None and r.lang is not None]
    counts, totals = plain_model(rows)
    model = langid.train(labelled(spark))
    texts = ["the house was over", "die straße", "dog und katze", "x", "Ärger über with", EN, DE]
    joint = langid.scores(model, texts)
    for text, row in zip(texts, joint):
        want = plain_scores(counts, totals, text)
        assert np.allclose(row, [want[x] for x in model.languages], rtol=1e-4)


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")
def test_held_out_rows_and_unlearned_languages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    held = lambda k: zlib.crc32(str(k).encode()) % 4 == 2
    rows = docs.collect()
    training = [r.doc_id for r in rows if not held(r.doc_id)]
    model = langid.train(docs.filter(docs.doc_id.isin(training)))
    found = {r.doc_id: r.lang_pred for r in langid.predict(docs, model).collect()}
    tests = [r for r in rows if held(r.doc_id) and r.lang is not None and r.text]
    assert sum(found[r.doc_id] == r.lang for r in tests) >= 0.97 * len(tests)
    kept = langid.keep_languages(docs, model)
    assert kept.count() >= 0.99 * docs.filter("text RLIKE '[a-z]'").count()
    aliens = spark.createDataFrame([(k, t) for k, t in enumerate(ALIENS)], "doc_id bigint, text string")
    assert all(r.score > 0.9 for r in langid.predict(aliens, model).collect())
    assert langid.keep_languages(aliens, model).count() == 0

import numpy as np

from biomeframe.llm import lmscore
from tests.llm.helpers import AWKWARD, docs_frame


def test_gradient_and_scorer():
    rng = np.random.default_rng(3)
    net = lmscore.Network(lmscore.Network.start(rng.integers(0, 90, lmscore.TOKENS).astype(float)))
    docs = [rng.integers(0, lmscore.TOKENS, n) for n in (30, 1, 0, 7)]
    around, target, owner = lmscore.windows(docs)
    assert len(target) == 38 and owner.tolist() == [0] * 30 + [1] + [3] * 7
    assert around[30].tolist() == [lmscore.PAD] * 4
    plain = np.array([brute_log_prob(net.w, c, t) for c, t in zip(around, target)])
    assert np.allclose(net.scorer()(around, target), plain, atol=1e-3)
    every = net.scorer()(np.repeat(around[:1], lmscore.TOKENS, axis=0), np.arange(lmscore.TOKENS))
    assert abs(np.exp(every).sum() - 1) < 1e-3
    before = plain.mean()
    for _ in range(60):
        net.train(around, target)
    assert net.scorer()(around, target).mean() > before + 1


def brute_log_prob(w, context, target):
    """Log-probability of one token by the definition, one sum at a time, in doubles."""
    w = {k: v.astype(float) for k, v in w.items()}
    x = np.concatenate([w["embed"][t] for t in context])
    h = np.array([np.tanh(sum(a * b for a, b in zip(x, column)) + c) for column, c in zip(w["w1"].T, w["b1"])])
    group, place = divmod(int(target), lmscore.PLACES)
    by_class = np.exp([h @ column + c for column, c in zip(w["wc"].T, w["bc"])])
    by_place = np.exp([(h + w["known"][group]) @ column + c for column, c in zip(w["wp"].T, w["bp"])])
    return np.log(by_class[group] / by_class.sum()) + np.log(by_place[place] / by_place.sum())


def test_gradient_by_differences():
    """Of every kind of weight, against differences of the brute-force mean."""
    rng = np.random.default_rng(5)
    net = lmscore.Network(lmscore.Network.start(rng.integers(0, 90, lmscore.TOKENS).astype(float)))
    docs = [rng.integers(0, lmscore.TOKENS, n) for n in (6, 1)] + [np.array([5, 5, 5, 9])]
    around, target, _ = lmscore.windows(docs)
    got = net.gradient(around, target)
    views = lmscore.Network._views(got)
    assert len(views) == 8

    def loss(name, place, by):
        w = {k: v.astype(float) for k, v in net.w.items()}
        w[name][place] += by
        return -np.mean([brute_log_prob(w, c, t) for c, t in zip(around, target)])

    for name, grad in views.items():
        moved = np.argwhere(np.abs(grad) > 1e-4)
        assert len(moved), name
        for place in [tuple(x) for x in rng.permutation(moved)[:3]]:
            want = (loss(name, place, 1e-4) - loss(name, place, -1e-4)) / 2e-4
            assert abs(grad[place] - want) < 1e-4 + 0.01 * abs(want), name
    unseen = sorted(set(range(lmscore.TOKENS + 1)) - set(around.ravel().tolist()))
    assert not views["embed"][unseen].any()


def test_order_is_learned(spark):
    """Words in the order of training score higher than the same words shuffled."""
    rng = np.random.default_rng(1)
    cycle = [f"w{k}" for k in range(12)]
    text = lambda k: " ".join((cycle * 30)[k : k + 300])
    shuffled = " ".join(rng.permutation(text(0).split()))
    rows = [(k, text(k % 12)) for k in range(120)] + [(900, shuffled)] + AWKWARD
    got = {r.doc_id: r for r in lmscore.pseudo_likelihood(docs_frame(spark, rows)).collect()}
    assert got[0].per_token > got[900].per_token + 0.3
    assert got[2].n_tokens == 0 and got[2].per_token is None and got[2].log_likelihood == 0
    assert got[0].n_tokens == 300 and abs(got[0].log_likelihood / 300 - got[0].per_token) < 1e-9


def test_empty(spark):
    assert lmscore.pseudo_likelihood(docs_frame(spark, [])).count() == 0
    assert lmscore.pseudo_likelihood(docs_frame(spark, [(1, None)])).first().n_tokens == 0


def test_every_token_is_a_target_once():
    """Also of documents of a word or two, whatever stands beside them."""
    docs = [np.arange(n) + 100 * k for k, n in enumerate((1, 2, 0, 7, 1, 30))]
    trained = [
        t
        for number in range(lmscore.ROUNDS)
        for some in (docs[:3], docs[3:])
        for t in lmscore.windows(some, lmscore.STRIDE, number * lmscore.STRIDE // lmscore.ROUNDS)[1].tolist()
    ]
    assert sorted(trained) == sorted(t for d in docs for t in d.tolist())
    one = lmscore.windows(docs, lmscore.STRIDE, 0)
    assert one[2].tolist() == [k for k, d in enumerate(docs) for _ in d[:: lmscore.STRIDE]]


def test_rare_words_are_spelled(spark):
    """Beyond the vocabulary each word has its own probability, as counted byte by byte."""
    common = [f"w{k}" for k in range(lmscore.TOKENS - 1)]
    rare = ["abab", "abba", "é", "zq", "abab"]
    rows = [(0, " ".join(common * 3))] + [(k, f"w1 w2 {w} w3 w4") for k, w in enumerate(rare, 1)]
    pairs = {}
    for w in rare:
        at = [lmscore.EDGE, *w.encode(), lmscore.EDGE]
        for p in zip(at, at[1:]):
            pairs[p] = pairs.get(p, 0) + 1

    def log_prob(w):
        at, size, out = [lmscore.EDGE, *w.encode(), lmscore.EDGE], lmscore.EDGE + 1, 0.0
        for a, b in zip(at, at[1:]):
            row = sum(n for p, n in pairs.items() if p[0] == a)
            out += np.log((pairs.get((a, b), 0) + 0.5) / (row + 0.5 * size))
        return out

    docs = docs_frame(spark, rows)
    vocab, counts, spelled = lmscore.vocabulary(docs, "text")
    assert sorted(vocab) == sorted(common) and counts[0] == len(rare)
    got = {r.doc_id: r.spelled for r in lmscore.encoded(docs, vocab, spelled, "doc_id", "text").collect()}
    assert got[0] == 0
    assert all(abs(got[k] - log_prob(w)) < 1e-9 for k, w in enumerate(rare, 1))
    scores = {r.doc_id: r.log_likelihood for r in lmscore.pseudo_likelihood(docs).collect()}
    assert abs((scores[1] - scores[2]) - (log_prob("abab") - log_prob("abba"))) < 1e-4
    assert scores[1] == scores[5] and len({round(scores[k], 6) for k in (1, 2, 4)}) == 3

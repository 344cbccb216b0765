import numpy as np
import pytest

from tests.llm.conftest import prose
from tidemark.llm import classifier as C


def test_estimation_recovers_accuracies():
    rng = np.random.default_rng(1)
    fires = np.array([[0.6, 0.001], [0.5, 0.002], [0.4, 0.001], [0.55, 0.0005]])
    good = rng.random(40_000) < 0.8
    voted = rng.random((40_000, 4)) < 0.9
    bad = rng.random((40_000, 4)) < fires[:, good.astype(int)].T
    patterns = {}
    for v, b in zip(voted, bad):
        p = "".join(C.NONE if not x else C.BAD if y else C.GOOD for x, y in zip(v, b))
        patterns[p] = patterns.get(p, 0) + 1
    found = C.estimate(patterns)
    assert abs(found.good - 0.8) < 0.03
    assert np.abs(found.fires[:, 0] - fires[:, 0]).max() < 0.06
    assert found.posterior("gggg") > 0.9 > 0.1 > found.posterior("bbgg")
    assert found.posterior("----") == pytest.approx(found.good)


def test_a_corpus_without_bad_texts_is_kept(spark, documents):
    docs = documents([(i, prose(i)) for i in range(1, 60)])
    assert C.keep(docs).count() == 59


def test_held_out_labels(spark, sf_dir):
    """Trained without labels, the scorer agrees with them; clean documents are left alone."""
    folder = sf_dir.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = C.score(docs).join(labels, "doc_id").collect()
    good = [r.kept for r in got if r.quality]
    bad = [r.kept for r in got if not r.quality]
    assert sum(good) / len(good) > 0.97
    assert sum(bad) / len(bad) < 0.3


def test_edges(spark, documents, edge_rows):
    docs = documents([*edge_rows, *[(100 + i, prose(i)) for i in range(30)]])
    model = C.train(docs)
    got = C.score(docs, model).collect()
    assert len(got) == len(edge_rows) + 30
    assert all(0 <= r.score <= 1 and r.kept == (r.score >= 0.5) for r in got)
    kept = C.keep(docs, model)
    assert kept.schema == docs.schema and kept.count() == sum(r.kept for r in got)
    empty = documents([]).where("false")
    assert C.score(empty).collect() == [] and C.keep(empty).collect() == []


def test_features_are_sorted_and_whole():
    page = C.Page("Word word WORD!! 12 " + "filler " * 5000 + "lastword")
    buckets, values = C.features(page, C._Hashed())
    assert (np.diff(buckets) > 0).all() and (values > 0).all()
    both = C._Hashed()[b"lastword"]
    assert both % C.BUCKETS in buckets and both // C.BUCKETS in buckets


@pytest.mark.parametrize("share", [0.03, 0.05, 0.1])
def test_a_labeller_that_fires_on_good_texts_is_found_out(share):
    """Texts on which it alone fires stay good, and it does not draw the others down."""
    patterns = {"gggggggg": 8500, "gggggggb": round(8500 * share / (1 - share))}
    patterns |= dict.fromkeys(("bgbggggb", "bggbgggg", "gbbggbgg", "bggggbgg", "ggbbggbb"), 300)
    found = C.estimate(patterns, held=[0])
    assert found.posterior("gggggggg") > 0.9 and found.posterior("gggggggb") > 0.5
    assert all(found.posterior(p) < 0.1 for p in patterns if p.count(C.BAD) > 1)
    assert found.fires[7, 1] == pytest.approx(share, rel=0.3)
    assert found.fires[0, 1] <= C.MOST_FALSE


def test_function_words_say_nothing_of_other_languages():
    russian = "дом стоит на берегу реки и смотрит окнами в старый сад где тихо растут яблони " * 5
    finnish = "talo seisoo joen rannalla ja katsoo ikkunoillaan vanhaan puutarhaan jossa omenapuut kasvavat hiljaa " * 5
    assert C.by_function_words(C.Page(russian)) == C.NONE
    assert C.by_function_words(C.Page(russian + " the")) == C.NONE
    assert C.by_function_words(C.Page(finnish)) == C.NONE
    assert C.by_function_words(C.Page(prose(1))) == C.GOOD
    assert C.by_function_words(C.Page("the " + "buy pills cheap now " * 30)) == C.BAD


def plain_em(votes, rounds):
    """Brute force: expectation-maximisation text by text, one labeller at a time, in plain floats."""
    labellers = range(len(votes[0]))
    good, fires = C.GOOD_SHARE, [list(C.FIRES) for _ in labellers]
    strength = C.PRIOR_SHARE * len(votes) + 1

    def posterior(v):
        likely = [1 - good, good]
        for k in labellers:
            for klass in (0, 1):
                rate = fires[k][klass]
                likely[klass] *= rate if v[k] == C.BAD else 1 - rate if v[k] == C.GOOD else 1.0
        return likely[1] / (likely[0] + likely[1])

    for _ in range(rounds):
        q = [posterior(v) for v in votes]
        new = []
        for k in labellers:
            rates = []
            for klass in (0, 1):
                mass = [x if klass else 1 - x for x in q]
                hit = sum(m for m, v in zip(mass, votes) if v[k] == C.BAD)
                seen = sum(m for m, v in zip(mass, votes) if v[k] != C.NONE)
                rate = (hit + strength * C.FIRES[klass]) / (seen + strength)
                rates.append(min(0.99, max(C.LEAST_FIRES, rate)))
            new.append([max(rates), rates[1]])
        good = min(0.99, max(0.05, (sum(q) + C.GOOD_SHARE * strength) / (len(votes) + strength)))
        fires = new
    return posterior


def test_posteriors_equal_plain_em():
    rng = np.random.default_rng(5)
    fires = np.array([[0.6, 0.01], [0.5, 0.02], [0.3, 0.05], [0.7, 0.001]])
    good = rng.random(1500) < 0.7
    voted, fired = rng.random((1500, 4)) < 0.85, rng.random((1500, 4)) < fires[:, good.astype(int)].T
    votes = ["".join(C.NONE if not x else C.BAD if y else C.GOOD for x, y in zip(v, b)) for v, b in zip(voted, fired)]
    posterior = plain_em(votes, 60)
    found = C.estimate({p: votes.count(p) for p in set(votes)}, rounds=60)
    for pattern in set(votes):
        assert found.posterior(pattern) == pytest.approx(posterior(pattern), abs=1e-6)


def test_votes_are_counted_over_every_row(spark, documents, edge_rows):
    rows = [*edge_rows, *[(100 + i, prose(i)) for i in range(30)]]
    want = {}
    for _, text in rows:
        v = C.votes_of(C.Page(text))
        want[v] = want.get(v, 0) + 1
    assert C.vote_counts(documents(rows)) == want

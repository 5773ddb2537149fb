"""Models against plain computations, and lines that are cut into slices against the plain rule."""

import itertools
import math
import random
from collections import defaultdict

import numpy as np
import pytest
import zstandard

from obsforge.llm import line_dedup, substring_dedup
from obsforge.llm.language import BITS, PENALTY, LanguageModel, gram_counts
from obsforge.llm.quality import BLOCK_BYTES, LEVEL, QualityModel
from obsforge.llm.toxicity import EM_ROUNDS, LabelModel


def plain_label_model(votes, start, each, prior):
    """The label model's rounds with plain loops over texts and voters."""
    texts, voters = range(len(votes)), range(len(votes[0]))
    belief = list(start)
    for _ in range(EM_ROUNDS):
        yes = [e * b for e, b in zip(each, belief)]
        no = [e * (1 - b) for e, b in zip(each, belief)]
        toxic = [(sum(yes[t] * votes[t][v] for t in texts) + 0.5) / (sum(yes) + 1) for v in voters]
        clean = [(sum(no[t] * votes[t][v] for t in texts) + 0.05) / (sum(no) + 1) for v in voters]
        mute = [not any(votes[t]) for t in texts]
        silent = [(sum(w[t] for t in texts if mute[t]) + 0.5) / (sum(w) + 1) for w in (yes, no)]
        left = [[votes[t][v] - belief[t] * toxic[v] - (1 - belief[t]) * clean[v] for v in voters] for t in texts]
        moment = lambda a, b: sum(each[t] * left[t][a] * left[t][b] for t in texts) / sum(each)
        bound = {}
        for a, b in itertools.product(voters, voters):
            r = moment(a, b) / (math.sqrt(moment(a, a)) + 1e-9) / (math.sqrt(moment(b, b)) + 1e-9)
            bound[a, b] = min(r, 1.0) if a != b and r >= 0.1 else 0.0
        after = []
        for t in texts:
            z = math.log(prior / (1 - prior)) + (math.log(silent[0] / silent[1]) if mute[t] else 0.0)
            for v in voters:
                shared = 1 + sum(votes[t][w] * bound[w, v] for w in voters)
                z += votes[t][v] / shared * math.log(toxic[v] / clean[v])
            after.append(1 / (1 + math.exp(-z)))
        done = max(abs(a - b) for a, b in zip(after, belief)) < 1e-6
        if done:
            break
        belief = after
    return after


def test_label_model_by_plain_rounds():
    rng = np.random.default_rng(3)
    truth = rng.random(60) < 0.4
    rates = np.where(truth[:, None], [0.8, 0.7, 0.75, 0.3], [0.05, 0.1, 0.02, 0.2])
    votes = (rng.random((60, 4)) < rates).astype(float)
    votes[:, 1] = np.where(rng.random(60) < 0.8, votes[:, 0], votes[:, 1])  # two voters that follow each other
    each = np.where(truth, 1.0, 3.0)
    model = LabelModel.fit(votes, truth.astype(float), each, 0.2)
    expected = plain_label_model(votes.tolist(), truth.astype(float), each.tolist(), 0.2)
    assert np.allclose(model.posterior(votes), expected, atol=1e-4)
    assert model.correlation[0, 1] > 0.3


def test_votes_overrule_the_label_they_start_from():
    votes = np.array([[1.0, 1.0, 1.0]] * 30 + [[0.0, 0.0, 0.0]] * 70)
    start = np.array([1.0] * 30 + [0.0] * 70)
    start[0], start[99] = 0.0, 1.0
    truth = LabelModel.fit(votes, start, np.ones(100), 0.3).posterior(votes)
    assert truth[0] == truth[1] > 0.5 > truth[99] == truth[98]


def best_mixture(logs, counts, languages):
    """The largest log-likelihood of a mixture of the languages, and its shares, by long EM."""
    parts = np.exp(logs[:, languages])
    shares = np.full(len(languages), 1 / len(languages))
    for _ in range(2000):
        shares = shares * ((counts / (parts @ shares)) @ parts) / counts.sum()
    return float(counts @ np.log(parts @ shares)), shares


@pytest.mark.parametrize("own", [(0,), (2,), (0, 1), (1, 2), (0, 1, 2)])
def test_language_sets_by_trying_all(own):
    rng = random.Random(5)
    tongues = [["".join(rng.choice(letters) for _ in range(rng.randint(3, 7))) for _ in range(60)] for letters in ("abcdefgh", "efghijkl", "ijklmnop")]
    counts = np.full((3, 1 << BITS), 0.5)
    for i, vocabulary in enumerate(tongues):
        grams, n = gram_counts(" ".join(rng.choice(vocabulary) for _ in range(4000)).encode())
        counts[i, grams] += n
    logs = np.log(counts / counts.sum(axis=1, keepdims=True)).T
    model = LanguageModel(["x", "y", "z"], logs.astype(np.float32))
    text = " ".join(rng.choice(tongues[i]) for k, i in enumerate(own) for _ in range(200 + 150 * k)).encode()
    grams, n = gram_counts(text)
    penalty = PENALTY * math.log(n.sum() + 1)
    tried = [s for size in (1, 2, 3) for s in itertools.combinations(range(3), size)]
    best = max(tried, key=lambda s: best_mixture(logs[grams], n, list(s))[0] - penalty * len(s))
    shares = np.zeros(3)
    shares[list(best)] = best_mixture(logs[grams], n, list(best))[1]
    assert best == own
    assert np.allclose(model.proportions(text), shares, atol=0.03)


def test_quality_is_the_difference_of_compressed_sizes():
    rng = random.Random(9)
    good, bad = (" ".join(rng.choice(words) for _ in range(3000)).encode() for words in (["alpha", "beta", "gamma"], ["spam", "win", "now"]))
    texts = [b"", b"alpha beta gamma", b"win spam now " * 900, good[:9000], bytes(range(256)) * 40]

    def size(text, dictionary):
        whole = 0
        for at in range(0, len(text), BLOCK_BYTES):
            tool = zstandard.ZstdCompressor(
                level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=False, write_dict_id=False
            )
            whole += len(tool.compress(text[at : at + BLOCK_BYTES]))
        return whole

    features = QualityModel(good, bad).features(texts)
    for text, (difference, ratio, *_) in zip(texts, features):
        with_good, with_bad = size(text, good), size(text, bad)
        # a prepared dictionary may choose other matches than one read anew
        assert difference == pytest.approx((with_bad - with_good) / max(with_bad + with_good, 1), abs=0.02)
        assert ratio == pytest.approx(math.log((with_good + 20) / (len(text) + 20)), abs=0.1)
    assert features[1][0] > 0.05 and features[2][0] < -0.02


@pytest.mark.parametrize("sampled, size", [(1 << 20, 1), (1 << 20, 7), (1, 32)])
def test_cut_lines_by_the_plain_rule(spark, monkeypatch, sampled, size):
    monkeypatch.setattr(line_dedup, "SAMPLED", sampled)
    monkeypatch.setattr(line_dedup, "SLICE", size)
    rng = random.Random(size)
    common = ["a line in every third document", "another very common line", "not so common a line"]
    texts = {}
    for doc in rng.sample(range(-300, 300), 200):
        lines = [common[0]] * rng.choice([0, 0, 1, 5]) + [common[1].upper()] * rng.choice([0, 1])
        lines += [common[2]] * (rng.random() < 0.05) + [f"own line of {doc}"] * rng.choice([1, 2]) + ["short"]
        rng.shuffle(lines)
        texts[doc] = "\n".join(lines)
    holder = {}
    for doc in sorted(texts):
        for line in texts[doc].split("\n"):
            holder.setdefault(line.strip().lower(), doc)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    for doc, text in texts.items():
        lines = text.split("\n")
        stays = [x for x in lines if len(x) < 10 or holder[x.lower()] == doc]
        assert (got[doc].n_dropped, got[doc].kept) == (len(lines) - len(stays), "\n".join(stays))
    assert sum(r.n_dropped for r in got.values()) > 200


@pytest.mark.parametrize("shares", [1, 1 << 20])
def test_substrings_of_hot_and_rare_kinds(spark, monkeypatch, shares):
    monkeypatch.setattr(substring_dedup, "SHARES", shares)
    rng = random.Random(2)
    noise = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    often, twice = noise(130), noise(150)
    texts = [noise(rng.randint(0, 60)) + often + noise(rng.randint(0, 60)) for _ in range(60)]
    texts += [noise(40) + twice, twice + noise(30), noise(300), often * 3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in substring_dedup.drop_repeated_substrings(docs, 50).collect()}
    starts = defaultdict(int)
    for text in texts:
        for at in range(len(text) - 49):
            starts[text[at : at + 50]] += 1
    for doc, text in enumerate(texts):
        gone = {at + k for at in range(len(text) - 49) if starts[text[at : at + 50]] > 1 for k in range(50)}
        assert got[doc].n_removed == len(gone)

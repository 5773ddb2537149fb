"""Toxicity by weak supervision: many small voters, a generative label model, and a linear classifier on its posterior.

Voters look at one thing each: a lexicon voter at a word, a pattern voter at words that begin with a stem, and either
asks for a number of them. They are proposed from labelled texts: what is frequent in toxic and rare in clean ones, so that
toxic texts are covered several times over. The label model starts from the labels and by EM over the votes estimates
how often each voter fires on toxic and on clean texts, and how voters that fire together for other reasons than the
label are correlated; their evidence is shared. The classifier, logistic in votes and counts, learns the posterior.

The fit takes at most ``PER_CLASS`` documents of a class with at most ``MAX_BYTES`` each; every document is scored on
its whole text. Defined cases: null and empty texts have no votes and get the classifier's score of that. Without toxic
labels there are no voters and the score is the share of toxic labels. A null ``doc_id`` is not held out. Only ``doc_id``
and ``text`` are read; equal rows get equal scores.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsforge.llm.jaccard_join import BATCH_ROWS
from obsforge.llm.learning import Logistic, fit_logistic, held_out, labelled_sample
from obsforge.llm.text import batches_of
from obsforge.session import staged

#: Labelled documents of a class that the fit takes at most, and bytes of one.
PER_CLASS, MAX_BYTES = 2500, 32768
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
#: Lengths of stems, numbers of occurrences that voters ask for, most voters, and voters that shall cover a toxic text.
STEMS = range(3, 8)
TIMES = (1, 2, 4)
MOST_VOTERS = 96
COVER = 3
#: Toxic texts that a voter must fire on, and what a clean one counts against them.
SUPPORT, COST = 4, 4.0
#: Texts it must fire on for each clean one, which counts that much.
PRECISE = 10
#: Voters that fire on the same texts but for this share are one.
ALIKE = 0.8
EM_ROUNDS = 50

_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Voter:
    text: str
    whole: bool
    times: int


def _looks(text: str) -> Counter:
    """How often each word and each stem starts a word of the text."""
    found: Counter = Counter()
    for word, n in Counter(_WORD.findall(text.lower())).items():
        found[word, True] += n
        for length in STEMS:
            if length < len(word):
                found[word[:length], False] += n
    return found


def propose_voters(toxic: list[str], clean: list[str]) -> list[Voter]:
    """Greedy cover: each voter is the one that adds most cover of toxic texts, less the clean ones it fires on."""
    looks = [_looks(t) for t in toxic]
    support = Counter(key for look in looks for key in look)
    wanted = {key for key, n in support.items() if n >= SUPPORT}
    fires: dict[Voter, list[int]] = {}
    for i, look in enumerate(looks):
        for key in look.keys() & wanted:
            for times in TIMES:
                if look[key] >= times:
                    fires.setdefault(Voter(*key, times), []).append(i)
    wrong: Counter = Counter()
    for text in clean:
        look = _looks(text)
        for key in look.keys() & wanted:
            for times in TIMES:
                if look[key] >= times:
                    wrong[Voter(*key, times)] += 1
    weight = len(toxic) / max(len(clean), 1) * COST  # of a clean text
    sound = {v: np.array(rows) for v, rows in fires.items() if len(rows) >= SUPPORT and len(rows) > PRECISE * weight * wrong[v]}
    need = np.full(len(toxic), COVER)
    # lazy greedy: gains only fall, so the best stale one is checked first
    heap = [(weight * wrong[v] - len(rows), -len(v.text), v.text, not v.whole, v.times) for v, rows in sound.items()]
    heapq.heapify(heap)
    chosen: list[Voter] = []
    while heap and len(chosen) < MOST_VOTERS:
        gain, length, text, stem, times = heapq.heappop(heap)
        voter = Voter(text, not stem, times)
        rows = sound[voter]
        now = weight * wrong[voter] - float((need[rows] > 0).sum())
        if now > gain:
            if now <= -SUPPORT:
                heapq.heappush(heap, (now, length, text, stem, times))
            continue
        if any(len(np.intersect1d(rows, sound[c], assume_unique=True)) > ALIKE * max(len(rows), len(sound[c])) for c in chosen):
            continue
        chosen.append(voter)
        need[rows] -= 1
    return chosen


@dataclass
class LabelModel:
    """A voter fires or abstains. Its rates of firing on toxic and on clean texts, and voters' correlations.

    Silence of all voters is evidence of its own; that of single voters is none where another one fires.
    """

    on_toxic: np.ndarray
    on_clean: np.ndarray
    silent: tuple[float, float]
    prior: float
    correlation: np.ndarray

    @classmethod
    def fit(cls, votes: np.ndarray, guess: np.ndarray, each: np.ndarray, prior: float) -> LabelModel:
        """``guess`` is a first belief in each text's label: EM starts there and then sees votes alone. ``each`` weighs texts."""
        k, total = votes.shape[1], each.sum()
        model, p = cls(np.zeros(k), np.zeros(k), (0.5, 0.5), prior, np.zeros((k, k))), guess
        for _ in range(EM_ROUNDS):
            yes, no = each * p, each * (1 - p)
            model.on_toxic = (yes @ votes + 0.5) / (yes.sum() + 1.0)
            model.on_clean = (no @ votes + 0.05) / (no.sum() + 1.0)
            none = (votes.sum(axis=1) == 0).astype(np.float64)
            model.silent = ((yes @ none + 0.5) / (yes.sum() + 1.0), (no @ none + 0.5) / (no.sum() + 1.0))
            # what votes have in common beyond the label
            left = votes - np.outer(p, model.on_toxic) - np.outer(1 - p, model.on_clean)
            spread = np.sqrt(each @ (left * left) / total) + 1e-9
            correlation = np.clip((left.T * each @ left) / total / np.outer(spread, spread), 0.0, 1.0)
            np.fill_diagonal(correlation, 0.0)
            correlation[correlation < 0.1] = 0.0
            model.correlation = correlation
            after = model.posterior(votes)
            if np.abs(after - p).max() < 1e-6:
                break
            p = after
        return model

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        # voters that fire together share what they have in common
        alone = votes / (1.0 + votes @ self.correlation)
        z = alone @ np.log(self.on_toxic / self.on_clean) + np.log(self.prior / (1 - self.prior))
        z = z + np.where(votes.sum(axis=1) == 0, np.log(self.silent[0] / self.silent[1]), 0.0)
        return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class ToxicityModel:
    voters: list[Voter]
    classifier: Logistic | None = None
    _finder: object = field(default=None, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_finder": None}

    def counts(self, texts: list[str]) -> np.ndarray:
        """How often each voter's word or stem starts a word, per text."""
        out = np.zeros((len(texts), len(self.voters)))
        if not self.voters:
            return out
        if self._finder is None:
            by_text: dict[str, list[int]] = {}
            for i, v in enumerate(self.voters):
                by_text.setdefault(v.text, []).append(i)
            self._finder = ahocorasick.Automaton()
            for word, ids in by_text.items():
                self._finder.add_word(word, (len(word), ids))
            self._finder.make_automaton()
        for row, text in enumerate(texts):
            low = text.lower()
            for end, (length, ids) in self._finder.iter(low):
                start = end - length + 1
                if start and low[start - 1].isalpha():
                    continue
                ends = end + 1 == len(low) or not low[end + 1].isalpha()
                for i in ids:
                    if ends if self.voters[i].whole else not ends:
                        out[row, i] += 1
        return out

    def votes(self, counts: np.ndarray) -> np.ndarray:
        return (counts >= np.array([v.times for v in self.voters])).astype(np.float64) if self.voters else counts

    def features(self, counts: np.ndarray) -> np.ndarray:
        votes = self.votes(counts)
        return np.column_stack([votes, np.log1p(votes.sum(axis=1)), (votes.sum(axis=1) > 0), np.log1p(counts.sum(axis=1))])

    def scores(self, texts: list[str]) -> np.ndarray:
        return self.classifier(self.features(self.counts(texts)))


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    sample, totals = labelled_sample(docs, labels, "toxic", FOLDS, HELD_OUT, PER_CLASS, MAX_BYTES)
    toxic, clean = ([t.decode("utf-8", "replace") for t, label in sample if label == value] for value in (1, 0))
    model = ToxicityModel(propose_voters(toxic, clean) if toxic and clean else [])
    counts = model.counts(toxic + clean)
    prior = totals.get(1, 0) / max(totals.get(0, 0) + totals.get(1, 0), 1)
    # a sampled text stands for as many labelled ones as its class has to each in the sample
    stands = [totals.get(1, 0) / max(len(toxic), 1), totals.get(0, 0) / max(len(clean), 1)]
    each = np.repeat(stands, [len(toxic), len(clean)])
    if model.voters:
        votes, guess = model.votes(counts), np.repeat([1.0, 0.0], [len(toxic), len(clean)])
        truth = LabelModel.fit(votes, guess, each, prior).posterior(votes)
    else:
        truth = np.full(len(sample), prior)
    model.classifier = fit_logistic(model.features(counts), truth, ridge=1e-4, weights=each)
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted."""
    model = fit_toxicity(docs, labels)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "score"],
            )

    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    with batches_of(docs.sparkSession, BATCH_ROWS):
        scored = staged(texts.mapInArrow(score, "doc_id long, held_out boolean, score double"), "toxicity")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))

"""Samples for fitting, repeatable flows, and groups of edited copies that grow in proportion."""

import os
import random
import subprocess
import sys
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from obsforge.llm import jaccard_join, learning
from obsforge.llm.jaccard_join import similar_groups
from obsforge.llm.learning import first_by_hash, labelled_sample
from obsforge.llm.mixing import mix


@pytest.fixture(scope="module")
def labelled(spark):
    """Three hundred documents of six classes, of which one has two thirds, and some ids twice."""
    rows = [(i, f"text {i}", "a" if i % 3 else "bcdef"[i % 5]) for i in range(300)]
    rows += [(i, f"another {i}", "a") for i in range(0, 300, 7)] + [(301, None, "a"), (302, "", "a"), (None, "x", "a"), (303, "y" * 99, "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)


def test_a_sample_has_the_first_of_each_class(spark, labelled):
    outside = lambda i: zlib.crc32(str(i).encode()) % 4 != 2
    best: dict = {}
    texts: dict = {}
    hashes = {r.doc_id: r.h for r in labelled.select("doc_id", F.xxhash64("doc_id").alias("h")).collect() if r.doc_id is not None}
    for r in labelled.collect():
        if r.doc_id is not None and outside(r.doc_id):
            best[r.doc_id] = max(best.get(r.doc_id, ""), r.lang)
            if r.text and len(r.text) < 99:
                texts.setdefault(r.doc_id, set()).add(r.text)
    found, classes = labelled_sample(labelled, labelled, "lang", 4, 2, 10, 98)
    assert classes == Counter(best.values()) and list(classes)[0] == "a"
    for value in classes:
        ids = sorted((i for i, v in best.items() if v == value), key=lambda i: (hashes[i], i))[:10]
        own = [t.decode() for t, v in found if v == value]
        assert len(own) == sum(i in texts for i in ids) and all(any(t in texts[i] for i in ids if i in texts) for t in own)
    again, _ = labelled_sample(labelled.repartition(2), labelled.orderBy("text"), "lang", 4, 2, 10, 98)
    assert again == found
    assert labelled_sample(labelled, labelled.limit(0), "lang", 4, 2, 10, 98) == ([], {})


def test_a_sample_of_many_classes_is_bounded(spark, labelled, monkeypatch):
    each = labelled.withColumn("lang", F.concat("lang", F.col("doc_id").cast("string")))
    monkeypatch.setattr(learning, "MOST_ROWS", 20)
    found, classes = labelled_sample(each, each, "lang", 4, 2, 500, 98)
    assert len(classes) > 200 and len({v for _, v in found}) >= len(classes) - 3 and max(Counter(v for _, v in found).values()) == 1


def test_the_hash_threshold_widens_until_it_holds_enough(spark):
    known = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit(1).alias("label"))
    # a class that is thought larger than it is
    drawn = first_by_hash(known, {1: 4000}, 3999)
    assert drawn.count() == 3999
    wanted = [r.doc_id for r in known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(3999).collect()]
    assert sorted(r.doc_id for r in drawn.collect()) == sorted(wanted)


ROUTE = """
from obsforge.llm.mixing import route
sizes = {p: 3 + len(p) for p in [("a",), ("b",), ("a", "b"), ("b", "c"), ("a", "b", "c"), ("c", "d"), ("a", "d"), ("b", "d")]}
print(route(sizes, {"a": 7, "b": 4, "c": 12, "d": 9}))
"""


def test_flows_do_not_depend_on_the_hash_seed():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    said = {
        subprocess.run(
            [sys.executable, "-c", ROUTE], env={**os.environ, "PYTHONHASHSEED": str(seed), "PYTHONPATH": root}, capture_output=True, text=True, check=True
        ).stdout
        for seed in range(6)
    }
    assert len(said) == 1 and "('a', 'b', 'c')" in said.pop()


def test_documents_without_sources_are_not_taken(spark):
    docs = spark.createDataFrame([(1, "a b", ["x"]), (2, "c", []), (3, "d e f", None), (4, "g", ["x", "y", None])], "doc_id long, text string, of array<string>")
    taken = {r.doc_id: (r.taken, len(r.routes)) for r in mix(docs, F.col("of")).collect()}
    assert taken[2] == taken[3] == (0, 0) and taken[4][1] == 3 and taken[1][1] == 1


def copies(n, seed):
    """Copies of a text of 200 words with 2 to 9 of them changed, some of a few copies changed again."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for _ in range(n):
        words = list(rng.choice(texts) if texts and rng.random() < 0.3 else base)
        for at in rng.sample(range(200), rng.randint(2, 9)):
            words[at] = f"x{rng.randrange(100_000)}"
        texts.append(words)
    return texts


def grouped(texts, percent):
    """Smallest number reachable over pairs of 5-word shingles that are similar enough, by brute force."""
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if 100 * both >= percent * (len(a) + len(sets[j]) - both):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(sets))]


@pytest.mark.parametrize("n", [300, 1500])
def test_groups_of_edited_copies(spark, n, monkeypatch):
    texts = copies(n, n)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    compared = []
    plain = jaccard_join._compared

    def counted(pairs, *args):
        pairs = jaccard_join.staged(pairs, "counted")
        compared.append(pairs.count())
        return plain(pairs, *args)

    monkeypatch.setattr(jaccard_join, "_compared", counted)
    found = {r.doc_id: r.component_id for r in similar_groups(docs, 5, 80).collect()}
    assert [found[i] for i in range(n)] == grouped(texts, 80)
    # texts are fetched for a few pairs of each copy, not for each pair of them
    assert sum(compared) <= 40 * n


def test_blocks_of_differences_are_exact(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    monkeypatch.setattr(jaccard_join, "TOKENS", 50)
    texts = copies(150, 5)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.component_id for r in similar_groups(docs, 5, 85).collect()}
    assert [found[i] for i in range(len(texts))] == grouped(texts, 85)

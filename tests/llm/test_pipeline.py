"""The pipeline's rows against its stages worked out text by text."""

import hashlib
import os
import random
import re
from collections import Counter

import pytest

import corpus_pipeline
from obsforge.llm.quality import fit_quality
from obsforge.session import scratch_root

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def planted(rng):
    """Documents by kind: prose, junk, near copies, documents with common lines and with benchmark passages."""
    vocabulary = ["".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(3, 8))) for _ in range(900)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    junk = lambda n: " ".join(rng.choice(["BUY!!!", "$$$", "win", "clickhere", "xXx", "0000"]) for _ in range(n))
    items = [prose(40), prose(25)]
    common = [prose(9), prose(12)]
    docs = []
    for i in range(90):
        docs.append(("prose", prose(rng.randint(60, 200)) + ("\n" + rng.choice(common) if i % 4 == 0 else "")))
    for _ in range(50):
        docs.append(("junk", junk(rng.randint(60, 200))))
    for base in range(6):
        words = docs[base * 5 + 1][1].split()
        for change in (0, 1, 2, 12):
            copy = list(words)
            for at in rng.sample(range(len(copy)), change):
                copy[at] = rng.choice(vocabulary)
            docs.append(("copy", " ".join(copy)))
    for item in items:
        passage = item.split()
        passage[1] = "other"
        docs += [("benchmark", f"{prose(50)} {item} {prose(30)}"), ("benchmark", f"{prose(20)} {' '.join(passage)} {prose(60)}")]
    rng.shuffle(docs)
    return docs, items


def without_repeated_lines(docs):
    holders, out = {}, {}
    for i in sorted(docs):
        for line in docs[i].split("\n"):
            holders.setdefault(line.strip(" \t\r\x0b\x0c").lower(), i)
    for i, text in docs.items():
        lines = text.split("\n")
        keys = [line.strip(" \t\r\x0b\x0c").lower() for line in lines]
        out[i] = "\n".join(line for line, k in zip(lines, keys, strict=True) if len(k) < 10 or holders[k] == i)
    return out


def shingles(text):
    words = WORD.findall(text.lower())
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]


def one_of_each_group(docs):
    sets = {i: set(shingles(t)) for i, t in docs.items()}
    root = {i: i for i in docs}
    while True:
        after = dict(root)
        for a in docs:
            for b in docs:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    after[a] = min(after[a], after[b])
        if after == root:
            return {i: t for i, t in docs.items() if root[i] == i}
        root = after


def holds(text, item):
    own, want = shingles(text), Counter(shingles(item))
    n = sum(want.values())
    for at in range(max(1, len(own) - n + 1)):
        window = Counter(own[at : at + n])
        both = sum((window & want).values())
        if both >= 0.8 * (sum(window.values()) + n - both):
            return True
    return False


def mixed(docs, sources):
    """doc_id -> (size, source_size, target, taken) of what the mix takes."""
    size = {i: len(WORD.findall(t)) for i, t in docs.items()}
    names = sorted({sources[i] for i in docs}, key=lambda s: (s is None, s or ""))
    of = {s: sum(size[i] for i in docs if sources[i] == s) for s in names}
    weight = {s: 1 + at % 3 for at, s in enumerate(names)}
    target, open_ = {}, list(names)
    while open_:
        left = sum(size.values()) - sum(target.values())
        share = {s: left * weight[s] / sum(weight[t] for t in open_) for s in open_}
        above = [s for s in open_ if share[s] > 3 * of[s]]
        target |= {s: 3 * of[s] for s in above} if above else share
        open_ = [s for s in open_ if s not in target]
    out = {}
    for s in names:
        start = 0
        for i in sorted((i for i in docs if sources[i] == s), key=lambda i: hashlib.md5(f"0:{i}".encode()).hexdigest()):
            times = sum(2 * (k * of[s] + start) + size[i] < 2 * int(target[s] + 0.5) for k in range(3))
            start += size[i]
            if size[i] * times:
                out[i] = (size[i], of[s], pytest.approx(target[s]), size[i] * times)
    return out


def test_pipeline_against_plain_stages(spark, tmp_path):
    rng = random.Random(21)
    docs, items = planted(rng)
    kind = {i: k for i, (k, _) in enumerate(docs)}
    texts = {i: t for i, (_, t) in enumerate(docs)}
    sources = {i: rng.choice(["a", "a", "a", "b", None]) for i in texts}
    rows = [(i, t, "en", sources[i], len(t)) for i, t in texts.items()]
    folder = str(tmp_path)
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    frame.write.parquet(f"{folder}/documents.parquet")
    labels = spark.createDataFrame([(i, int(k != "junk"), 0) for i, k in kind.items()], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    model = fit_quality(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    good = {i: t for i, t in texts.items() if model.scores([t.encode()])[0] >= 0.5}
    assert set(good) == {i for i, k in kind.items() if k != "junk"}
    lines = without_repeated_lines(good)
    assert lines != good
    apart = one_of_each_group(lines)
    assert set(apart) != set(lines)
    clean = {i: t for i, t in apart.items() if not any(holds(t, item) for item in items)}
    assert {kind[i] for i in set(apart) - set(clean)} == {"benchmark"} and "benchmark" not in {kind[i] for i in clean}
    want = mixed(clean, sources)

    before = set(os.listdir(scratch_root(spark)))
    got = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id: (r["size"], r.source_size, r.target, r.taken) for r in got} == want and len(got) == len(want)
    for r in got:
        assert (r.text, r.source, r.n_chars) == (clean[r.doc_id], sources[r.doc_id], len(clean[r.doc_id]))
    # of the tables of a run only its result stays, and narrow ones of single operators
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(scratch_root(spark))) - before}
    assert left == {"pipeline-mixing", "bitmaps", "groups", "contaminated"}


def test_operators_leave_the_callers_batches(spark, documents):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    from obsforge.llm.jaccard_join import similar_groups
    from obsforge.llm.language import identify_languages
    from obsforge.llm.toxicity import score_toxicity

    before = spark.conf.get(name)
    spark.conf.set(name, "77")
    try:
        similar_groups(documents.limit(20))
        identify_languages(documents.limit(20))
        score_toxicity(documents.limit(20), spark.createDataFrame([], "doc_id long, toxic int"))
        assert spark.conf.get(name) == "77"
    finally:
        spark.conf.set(name, before)

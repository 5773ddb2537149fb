"""Operators against brute force, round trips and held-out labels."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest

from obsforge.llm import embedding_dedup, jaccard_join, substring_dedup
from obsforge.llm.components import components
from obsforge.llm.decontaminate import candidates, contaminated, simhash
from obsforge.llm.embedding_dedup import near_groups
from obsforge.llm.hashing import shingle_hashes, word_hashes
from obsforge.llm.jaccard_join import boundary, head_length, similar_groups, size_ranges
from obsforge.llm.learning import fit_logistic
from obsforge.llm.mixing import MAX_COPIES, route, targets
from obsforge.llm.quality import score_quality
from obsforge.llm.language import identify_languages
from obsforge.llm.span_dedup import drop_repeated_passages
from obsforge.llm.substring_dedup import drop_repeated_substrings
from obsforge.llm.suffix_array import common_prefixes, repeated_starts, two_stage_order
from obsforge.llm.toxicity import score_toxicity

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


@pytest.fixture(scope="module")
def edited(spark):
    """Copies of a few texts with a few to many words changed."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(3000)]
    rows = []
    for base in range(4):
        text = [rng.choice(vocabulary) for _ in range(rng.choice([12, 60, 160]))]
        for _ in range(70):
            copy = list(text)
            for _ in range(rng.randint(0, max(1, len(copy) // 8))):
                at = rng.randrange(len(copy))
                kind = rng.random()
                if kind < 0.4:
                    copy[at] = rng.choice(vocabulary)
                elif kind < 0.7:
                    copy.insert(at, rng.choice(vocabulary))
                elif len(copy) > 3:
                    del copy[at]
            rows.append((len(rows), " ".join(copy)))
    return spark.createDataFrame(rows, "doc_id long, text string"), rows


def linked(rows, size, percent):
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    root = {i: i for i, _ in rows}
    edges = [
        (rows[i][0], rows[j][0])
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    while True:
        after = dict(root)
        for a, b in edges:
            after[a] = after[b] = min(after[a], after[b])
        if after == root:
            return root, sets
        root = after


@pytest.mark.parametrize(("size", "percent", "many"), [(3, 90, 32), (5, 80, 2), (2, 60, 2), (3, 70, 1000)])
def test_similar_groups_of_edited_copies(edited, monkeypatch, size, percent, many):
    monkeypatch.setattr(jaccard_join, "MANY", many)
    docs, rows = edited
    want, sets = linked(rows, size, percent)
    got = {r.doc_id: r for r in similar_groups(docs, size, percent).collect()}
    assert {i: got[i].component_id for i in got} == want
    assert [got[i].n_shingles for i, _ in rows] == list(map(len, sets))


def test_heads_share_shingles():
    rng = random.Random(5)
    for _ in range(2000):
        universe = range(60)
        a = set(rng.sample(universe, rng.randint(2, 30)))
        b = set(a) ^ set(rng.sample(universe, rng.randint(0, 6)))
        for percent, k in product((60, 80, 90), (1, 2)):
            if len(b) > k and len(a) > k and 100 * len(a & b) >= percent * len(a | b):
                heads = [set(sorted(s)[: head_length(len(s), percent, k)]) for s in (a, b)]
                assert len(heads[0] & heads[1]) >= min(k, len(a & b))


def test_sets_match_in_their_range_and_beside():
    for percent in (51, 80, 90, 99):
        firsts = size_ranges(percent)
        place = lambda n: sum(f <= n for f in firsts)
        assert all(place(100 * n // percent) - place(n) <= 1 for n in range(1, 3000))


def test_boundary_weighs_subsets_against_entries():
    small, large = np.zeros(514, dtype=np.int64), np.zeros(514, dtype=np.int64)
    small[20], large[400] = 1000, 1000
    assert boundary(small, 90) >= 20
    assert boundary(large, 90) < 400


def test_word_hashes_follow_words():
    texts = ["Ab cD\x0be", "", " ", "É é AB", "ab cd e"]
    first, *_, last = word_hashes([t.encode() for t in texts])
    assert (first == last).all()
    assert [len(w) for w in word_hashes([t.encode() for t in texts])] == [len(words(t)) for t in texts]
    assert len(shingle_hashes(first, 5)) == 1 and len(shingle_hashes(first, 2)) == 2


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(200)] + [(500 + rng.randrange(40), 500 + rng.randrange(40)) for _ in range(25)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    root = {n: n for e in edges for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            changed |= (root[a], root[b]) != (low, low)
            root[a] = root[b] = low
    loops = {n for n in root if n not in got}
    assert got == {n: r for n, r in root.items() if n in got} and all(root[n] == n for n in loops)


def test_embeddings_in_small_cells(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CELL", 40)
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 8))
    x = (centres[rng.integers(0, 12, 400)] + rng.normal(scale=0.22, size=(400, 8))).astype(np.float32)
    x[50:60] = x[0]
    rows = [(i + 1, [float(v) for v in row]) for i, row in enumerate(x)]
    y = x.astype(np.float64)
    y /= np.sqrt((y * y).sum(1))[:, None]
    link = y @ y.T >= 0.95
    np.fill_diagonal(link, False)
    label = np.arange(1, 401)
    while True:
        after = np.array([min([label[i], *label[link[i]]]) for i in range(400)])
        if (after == label).all():
            break
        label = after
    got = {r.vec_id: r for r in near_groups(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    assert link.sum() > 500
    assert [got[i + 1].n_links for i in range(400)] == link.sum(1).tolist()
    assert [got[i + 1].component_id for i in range(400)] == label.tolist()


def test_passages(documents):
    got = {r.doc_id: (r.n_sentences, r.n_removed, r.n_spans, r.kept) for r in drop_repeated_passages(documents).collect()}
    rows = sorted((r.doc_id, r.text or "") for r in documents.collect())
    texts, seen = {}, defaultdict(list)
    for doc, text in rows:
        sentences = []
        before = None
        for m in WORD.finditer(text):
            if before is None or text[before.end() - 1] in ".!?" or "\n" in text[before.end() : m.start()]:
                sentences.append((m.start(), []))
            sentences[-1][1].append(m.group().translate(LOWER))
            before = m
        texts[doc] = sentences
        runs = set()
        for i in range(len(sentences)):
            for step, end in ((1, len(sentences)), (-1, -1)):
                total = 0
                for j in range(i, end, step):
                    total += len(sentences[j][1])
                    if total >= 25 and abs(j - i) + 1 >= min(2, len(sentences)):
                        runs.add((min(i, j), max(i, j)))
                        break
        for i, j in runs:
            seen[tuple(w for s in sentences[i : j + 1] for w in s[1])].append((doc, i, j))
    gone = defaultdict(set)
    for places in seen.values():
        for doc, i, j in sorted(places)[1:]:
            gone[doc] |= set(range(i, j + 1))
    assert sum(map(len, gone.values())) > 20
    for doc, text in rows:
        edges = [0, *(s[0] for s in texts[doc][1:]), len(text)]
        kept = "".join(text[edges[i] : edges[i + 1]] for i in range(len(texts[doc])) if i not in gone[doc]) if gone[doc] else text
        spans = sum(i - 1 not in gone[doc] for i in gone[doc])
        assert got[doc] == (len(texts[doc]), len(gone[doc]), spans, kept)


@pytest.mark.parametrize("most", [2048, 1])
def test_substrings(spark, monkeypatch, most):
    monkeypatch.setattr(substring_dedup, "MOST", most)
    monkeypatch.setattr(substring_dedup, "PIECE", 64)
    rng = random.Random(9)
    piece = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    shared = [piece(rng.randint(30, 90)) for _ in range(5)]
    rows = [
        (i, "".join(rng.choice([piece(rng.randint(0, 50)), rng.choice(shared), rng.choice(shared)[5:]]) for _ in range(rng.randint(0, 6))))
        for i in range(120)
    ] + [(200, "ab" * 200), (201, "z" * 41), (202, "z" * 39)]
    length = 40
    data = {i: t.encode() for i, t in rows}
    count = Counter(t[p : p + length] for t in data.values() for p in range(len(t) - length + 1))
    got = {r.doc_id: r for r in drop_repeated_substrings(spark.createDataFrame(rows, "doc_id long, text string"), length).collect()}
    removed = 0
    for i, t in data.items():
        gone = [False] * len(t)
        for p in range(len(t) - length + 1):
            if count[t[p : p + length]] > 1:
                gone[p : p + length] = [True] * length
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(g and not before for before, g in zip([False, *gone], gone))
        removed += sum(gone)
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans) == (len(t), sum(gone), spans)
        assert got[i].kept_sha256 == hashlib.sha256(kept).hexdigest()
    assert removed > 2000


def test_suffix_array():
    rng = random.Random(3)
    for _ in range(200):
        alphabet = rng.choice([b"ab", b"a", b"abcdefgh", bytes(range(250))])
        pieces = [bytes(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(rng.randint(1, 9))]
        depth = rng.choice([1, 2, 3, 5, 8])
        count = Counter(p[i : i + depth] for p in pieces for i in range(len(p) - depth + 1))
        want = [[count[p[i : i + depth]] > 1 for i in range(len(p) - depth + 1)] for p in pieces]
        assert [x.tolist() for x in repeated_starts(pieces, depth)] == want
        text = b"".join(p + b"\xff" for p in pieces)
        symbols = np.frombuffer(text, dtype=np.uint8)
        order = two_stage_order(symbols, depth)
        keys = [(text + b"\xff" * depth)[i : i + depth] for i in order]
        assert keys == sorted(keys) and sorted(order) == list(range(len(text)))
        want = [0, *(next((k for k in range(depth) if a[k] != b[k]), depth) for a, b in zip(keys, keys[1:], strict=False))]
        assert common_prefixes(symbols, order, depth).tolist() == want


def test_contaminated(spark, documents):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = {(r.doc_id, r.item_id): r.similarity for r in contaminated(documents, benchmark).collect()}
    shingles = lambda t: (lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)])([x.lower() for x in WORD.findall(t or "")])
    items = {r.item_id: Counter(shingles(r.text)) for r in benchmark.collect()}
    want = {}
    for r in documents.collect():
        own = shingles(r.text)
        for item, count in items.items():
            n = sum(count.values())
            if not n or not any(s in count for s in own):
                continue
            for at in range(max(1, len(own) - n + 1)):
                window = Counter(own[at : at + n])
                both = sum((window & count).values())
                value = both / (sum(window.values()) + n - both)
                if value >= 0.8:
                    want[r.doc_id, item] = max(value, want.get((r.doc_id, item), 0))
    assert want and got == pytest.approx(want)


def test_hamming_blocks_find_all_within_radius(spark):
    rng = random.Random(4)
    prints = [rng.getrandbits(60) for _ in range(30)]
    near = [p ^ sum(1 << b for b in rng.sample(range(60), rng.randint(0, 22))) for p in prints for _ in range(6)]
    items = spark.createDataFrame(list(enumerate(prints)), "item_id long, fingerprint long")
    got = {(r.fingerprint, r.item_id) for r in candidates(spark.createDataFrame([(n,) for n in set(near)], "fingerprint long"), items).collect()}
    assert got == {(n, i) for n in set(near) for i, p in enumerate(prints) if (n ^ p).bit_count() <= 15}


def test_simhash_takes_majorities(spark):
    rng = random.Random(6)
    rows = [(g, rng.getrandbits(63) - (1 << 62), rng.randint(1, 5)) for g in range(5) for _ in range(rng.randint(1, 40))]
    got = {r.g: (r.n_shingles, r.fingerprint) for r in simhash(spark.createDataFrame(rows, "g int, hash long, weight long"), "g").collect()}
    for g in range(5):
        own = [(h, w) for k, h, w in rows if k == g]
        total = sum(w for _, w in own)
        bits = sum(1 << b for b in range(60) if 2 * sum(w for h, w in own if h >> b & 1) > total)
        assert got[g] == (total, bits)


def test_targets_share_what_exceeds_three_copies():
    rng = random.Random(8)
    for _ in range(200):
        sizes = {f"s{i:02}": rng.choice([0, 1, 5, 100, 10_000]) for i in range(rng.randint(1, 12))} | {None: rng.randint(0, 50)}
        total = sum(sizes.values())
        got = targets(sizes, total)
        assert sum(got.values()) == pytest.approx(total) and all(got[s] <= 3 * sizes[s] + 1e-6 for s in sizes)


def test_route_is_a_cheapest_largest_flow():
    rng = random.Random(1)
    for _ in range(60):
        sources = "abc"
        patterns = rng.sample([p for n in (1, 2, 3) for p in [tuple(sources[i] for i in c) for c in __import__("itertools").combinations(range(3), n)]], rng.randint(1, 4))
        sizes = {p: rng.randint(0, 3) for p in patterns}
        quotas = {s: rng.randint(0, 5) for s in sources}
        flow = route(sizes, quotas)
        given = {s: sum(f.get(s, 0) for f in flow.values()) for s in sources}
        assert all(given[s] <= quotas[s] for s in sources) and all(0 <= sum(flow[p].values()) <= MAX_COPIES * sizes[p] for p in patterns)

        def possible(used):
            # Hall's condition: words used by patterns can reach quotas
            return all(sum(u for p, u in used.items() if set(p) <= set(some)) <= sum(quotas[s] for s in some) for n in (0, 1, 2, 3) for some in __import__("itertools").combinations(sources, n))

        cost = lambda used: sum(max(0, u - sizes[p]) + max(0, u - 2 * sizes[p]) for p, u in used.items())
        every = [dict(zip(patterns, u, strict=True)) for u in product(*(range(MAX_COPIES * sizes[p] + 1) for p in patterns))]
        every = [u for u in every if possible(u)]
        most = max(sum(u.values()) for u in every)
        used = {p: sum(flow[p].values()) for p in patterns}
        assert sum(used.values()) == most
        assert cost(used) == min(cost(u) for u in every if sum(u.values()) == most)


def test_logistic_separates():
    x = np.array([[-2.0], [-1.0], [1.0], [2.0]] * 20)
    assert fit_logistic(x, (x[:, 0] > 0).astype(float))(np.array([[-3.0], [3.0]])).round().tolist() == [0, 1]
    assert 0 < fit_logistic(x, np.ones(80))(x)[0] <= 1 and fit_logistic(np.zeros((0, 2)), np.zeros(0))(np.zeros((1, 2)))[0] == 0.5


def test_models_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    truth = {r.doc_id: r for r in labels.collect()}
    lang = {r.doc_id: r.lang for r in documents.collect()}

    def right(rows, label):
        known = [r for r in rows if r.held_out and r.doc_id in truth]
        return sum(r.predicted == truth[r.doc_id][label] for r in known) / len(known)

    assert right(score_quality(documents, labels).drop("row").collect(), "quality") > 0.93
    assert right(score_toxicity(documents, labels).collect(), "toxic") > 0.93
    rows = [r for r in identify_languages(documents).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in rows) / len(rows) > 0.97

"""Whitening, token counts and lexical search against plain computations, and their defined cases."""

import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from obsforge.llm import token_counts
from obsforge.llm.characteristic import coefficient_bound, join_residues, largest_roots, polynomial_mod, primes, unit_vectors
from obsforge.llm.lexical_search import Best, rank_documents
from obsforge.llm.token_counts import TokenCounter, count_tokens
from obsforge.llm.transducer import STATES, Compiled, chunk_maps, class_table, piece_starts, scan
from obsforge.llm.whitening import whiten

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# whitening


def exact_polynomial(matrix):
    """Faddeev's recursion over fractions."""
    n = len(matrix)
    a = [[Fraction(int(c)) for c in row] for row in matrix]
    out, m = [Fraction(1)], [[Fraction(0)] * n for _ in range(n)]
    for k in range(1, n + 1):
        m = [[sum(a[i][t] * m[t][j] for t in range(n)) + (out[-1] if i == j else 0) for j in range(n)] for i in range(n)]
        out.append(-sum(a[i][t] * m[t][i] for i in range(n) for t in range(n)) / k)
    return [int(c) for c in reversed(out)]


@pytest.mark.parametrize("size", [1, 2, 5, 9])
def test_polynomial_by_residues(size):
    rng = np.random.default_rng(size)
    x = rng.integers(-300, 300, (4 * size, size))
    x[:, 0] = 0 if size == 5 else x[:, 0]  # a singular matrix as well
    matrix = (x.T @ x).astype(object)
    trace = sum(matrix[i, i] for i in range(size))
    moduli = primes(2 * coefficient_bound(trace, size))
    assert join_residues({p: polynomial_mod(matrix, p) for p in moduli}) == exact_polynomial(matrix)


def test_roots_with_copies_and_their_vectors():
    # eigenvalues 9, 9, 4, 0 in a basis of integers
    basis = np.array([[1, 1, 1, 1], [1, -1, 1, -1], [1, 1, -1, -1], [1, -1, -1, 1]])
    matrix = (basis.T @ np.diag([9, 9, 4, 0]) @ basis).astype(object)
    roots = largest_roots(exact_polynomial(matrix), 4)
    assert [round(float(r), 12) for r in roots] == [36, 36, 16]  # no component without variance
    vectors = unit_vectors(matrix, roots)
    assert np.abs(vectors @ vectors.T - np.eye(3)).max() < 1e-15
    for vector, root in zip(vectors, roots, strict=True):
        assert np.abs(matrix.astype(float) @ vector - float(root) * vector).max() < 1e-12
    assert largest_roots([0, 0, 1], 4) == [] and largest_roots([1], 4) == []


def test_roots_that_lie_close():
    # 2**40 +- 1 and far smaller ones
    values = [2**40 + 1, 2**40, 2**40 - 1, 5]
    coefficients = [1]
    for v in values:
        coefficients = [a - v * b for a, b in zip([0, *coefficients], [*coefficients, 0], strict=True)]
    assert [round(r) for r in largest_roots(coefficients, 3)] == values[:3]


def whitened_plainly(vectors, many=4):
    x = {}
    for key, entries in vectors:
        if entries is not None and all(c is not None and math.isfinite(c) for c in entries):
            x.setdefault(key, []).append(tuple(math.floor(256 * c) for c in entries))
    fit = np.array(sorted({v for own in x.values() for v in own}), dtype=np.int64)
    n, sums = len(fit), fit.sum(axis=0)
    values, basis = np.linalg.eigh(np.cov(fit.T.astype(float), bias=True))
    values, basis = values[::-1][:many], basis.T[::-1][:many]
    return x, n, sums, values, basis, values / np.trace(np.cov(fit.T.astype(float), bias=True))


def test_whitening_against_numpy(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = whiten(vectors).collect()
    x, n, sums, values, basis, explained = whitened_plainly([(r.vec_id, r.embedding) for r in vectors.collect()])
    assert Counter((r.vec_id, r.component) for r in rows) == Counter((k, c) for k in x for c in range(1, 5))
    signs = {}
    for r in rows:
        (own,) = x[r.vec_id]
        c = r.component - 1
        plain = (np.array(own) - sums / n) @ basis[c] / math.sqrt(values[c])
        sign = signs.setdefault(c, math.copysign(1, plain * r.whitened))
        assert r.n == n and r.deviation == int(((n * np.array(own) - sums) ** 2).sum())
        assert abs(sign * plain - r.whitened) < 1e-9 and abs(r.explained - explained[c]) < 1e-12
    assert {r.identity_error for r in rows} == {rows[0].identity_error} and rows[0].identity_error < 1e-12


def test_whitening_defined_cases(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, [0.5, -0.25], "a"), (1, [0.5, -0.25], "b"), (2, [0.5, -0.25], None), (3, [-0.0, 1.0], None), (None, [0.25, 0.75], None),
        (4, None, None), (5, [], None), (6, [1.0, None], None), (7, [nan, 0.0], None), (8, [inf, 0.0], None), (9, [1.0, 2.0, 3.0], None),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, component string").withColumn("x", F.lit(1))
    found = defaultdict(list)
    for r in whiten(vectors).collect():
        found[r.vec_id].append(r)
    assert {k: len(v) for k, v in found.items()} == {1: 4, 2: 2, 3: 2, None: 2}
    assert {r.n for own in found.values() for r in own} == {3}
    one, copy = (sorted(r for r in found[k] if r.component == 1)[0] for k in (1, 2))
    assert one[1:] == copy[1:]
    assert whiten(vectors.limit(0)).count() == 0 and whiten(vectors.where("vec_id = 2")).count() == 0
    # one direction only: a second component has no variance
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(5)], "vec_id long, embedding array<double>")
    assert {r.component for r in whiten(line).collect()} == {1}
    # entries whose products no double holds, and a deviation beyond 64 bits
    large = spark.createDataFrame([(i, [2.0**31 * i, -(2.0**40), 1.0 * i * i]) for i in range(6)], "vec_id long, embedding array<double>")
    rows = whiten(large).collect()
    assert {r.deviation is None for r in rows} == {True} and rows[0].identity_error < 1e-9


# token counts


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


SIGNS = ["a", "b ", "s", "t", "m", "d", "r", "v", "e", "l", "ll", "the ", "don't ", "we'll", "'re", "'", "'", " ", " ", "\n", "\t", "1", "2", "!", "?"]
SIGNS += ["é", "ß", "中", "٣", "\x85", "\xa0", "　", " ", "\x00", "😀", "́", "​", "²", "Ⅷ", "İ"]


def test_pieces_as_the_library_cuts_them():
    cutter = pre_tokenizers.ByteLevel(add_prefix_space=False)
    classes = class_table(cutter.pre_tokenize_str)
    rng = random.Random(3)
    for turn in range(400):
        text = "".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 60 if turn % 40 else 3000)))
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        assert piece_starts(classes(points)).tolist() == [start for _, (start, _) in cutter.pre_tokenize_str(text)], text


def test_scan_composes_maps_of_chunks():
    kinds = np.random.default_rng(1).integers(0, 11, (37, 24)).astype(np.uint8)
    scanned = scan(chunk_maps(kinds))
    for upto in (1, 2, 20, 37):
        assert scanned[upto - 1].tolist() == chunk_maps(kinds[:upto].reshape(1, -1))[0].tolist()
    assert scanned.shape == (37, STATES)


def test_pieces_of_any_tokens(tokenizer):
    """Words that join tokens, whose own merges then compete."""
    count = Compiled(tokenizer.to_str()).count
    rng = random.Random(4)
    names = [n for n in tokenizer.get_vocab() if n.isascii() and n.isalpha()]
    for turn in range(3000):
        word = "".join(rng.choice(names) for _ in range(rng.randint(1, 5)))
        assert count(word.encode()) == len(tokenizer.encode(word, add_special_tokens=False).ids), word
        if turn == 1500:
            count.MOST = 500  # starts anew again and again
    for word in ("x" * 3000, "ab" * 999, "-" * 777, " " * 300, "aaaaaaa" * 99, "=+" * 300):
        assert count(word.encode()) == len(tokenizer.encode(word, add_special_tokens=False).ids)


def test_token_counts_of_streams_and_cut_texts(tokenizer, monkeypatch):
    counter = TokenCounter(tokenizer.to_str())
    rng = random.Random(5)
    for stream in (token_counts.STREAM, 150):
        monkeypatch.setattr(token_counts, "STREAM", stream)
        for _ in range(60):
            texts = ["".join(rng.choice([*SIGNS, "<|endoftext|>"]) for _ in range(rng.randint(0, 400))) for _ in range(9)]
            wanted = [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
            assert counter([t.encode() for t in texts]).tolist() == wanted


def test_token_counts_of_documents(edges, nothing, documents, tokenizer):
    for docs in (edges, documents):
        rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
        ids = tokenizer.encode_batch([t for _, t in rows], add_special_tokens=False)
        wanted = Counter((k, len(t.encode()), len(e.ids), len(e.ids) > 1024) for (k, t), e in zip(rows, ids, strict=True))
        assert Counter(map(tuple, count_tokens(docs, PATH).collect())) == wanted
    assert count_tokens(nothing, PATH).count() == 0


def test_batch_setting_comes_back(spark, nothing):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    count_tokens(nothing, PATH)
    assert spark.conf.get(name) == before


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        Compiled(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())


# lexical search


def ranked_plainly(items, docs, best):
    terms = lambda t: TERM.findall((t or "").translate(LOWER))
    texts = [(k, c) for k, t in docs if (c := Counter(terms(t)))]
    n, length = len(texts), sum(c.total() for _, c in texts)
    held = Counter(t for _, c in texts for t in c)
    found = []
    for item, text in items:
        weights = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * held[t] + 1))) for t in set(terms(text))}
        scores = []
        for k, c in texts:
            m = 50 + 50 * c.total() * n // length
            score = sum(w * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t, w in weights.items() if t in c)
            if score > 0:
                scores.append((-score, k is None, k or 0, k))
        found += [(item, i, k, -s) for i, (s, _, _, k) in enumerate(sorted(scores)[:best], 1)]
    return Counter(found)


def test_search_against_plain_ranking(spark, documents, monkeypatch):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    wanted = ranked_plainly([(r.item_id, r.text) for r in items.collect()], [(r.doc_id, r.text) for r in documents.collect()], 50)
    assert Counter(map(tuple, rank_documents(items, documents).collect())) == wanted
    # many blocks, and products that span a few terms only
    monkeypatch.setattr("obsforge.llm.lexical_search.TILE_TERMS", 7)
    monkeypatch.setattr("obsforge.llm.lexical_search.TILE_ITEMS", 3)
    assert Counter(map(tuple, rank_documents(items, documents, block_terms=150).collect())) == wanted


def test_search_defined_cases(spark, edges, nothing, edge_rows):
    words = edge_rows[0][1].split()
    rows = [(1, " ".join(words[:9]), None), (1, "WORD a", None), (2, None, None), (3, "", None), (4, " ?!", None), (None, "x y été", None), (5, "absent", None)]
    items = spark.createDataFrame(rows, "item_id long, text string, rank string")
    docs = [(r[0], r[1]) for r in edge_rows]
    wanted = ranked_plainly([(r[0], r[1]) for r in rows], docs, 3)
    assert Counter(map(tuple, rank_documents(items, edges, best=3).collect())) == wanted
    assert rank_documents(items, nothing).count() == 0 and rank_documents(items.limit(0), edges).count() == 0


def test_ties_of_many_copies_end_by_id(spark):
    docs = spark.createDataFrame([(i, "the same words" if i % 3 else "other things") for i in range(5000)], "doc_id long, text string").repartition(7)
    items = spark.createDataFrame([(1, "same")], "item_id long, text string")
    assert [r.doc_id for r in rank_documents(items, docs).orderBy("rank").collect()] == [i for i in range(5000) if i % 3][:50]


def test_best_keeps_what_ties_with_the_last():
    rng = np.random.default_rng(2)
    scores = rng.integers(0, 6, (4000, 3))
    ids = rng.permutation(4000)
    best = Best(3, 50)
    for at in range(0, 4000, 37):
        best.add(scores[at : at + 37], ids[at : at + 37], np.zeros(len(ids[at : at + 37]), dtype=bool))
    for item in range(3):
        order = np.lexsort((ids, -scores[:, item]))[:50]
        kept = best.cut(item)
        assert kept[1].tolist() == ids[order].tolist() and kept[0].tolist() == scores[order, item].tolist()

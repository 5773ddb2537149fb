"""Defined results for nulls, empty and very long texts, ties, repeated rows, clashing names and empty tables."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from obsforge.llm.decontaminate import contaminated, drop_contaminated
from obsforge.llm.embedding_dedup import near_groups
from obsforge.llm.jaccard_join import similar_groups
from obsforge.llm.language import identify_languages
from obsforge.llm.line_dedup import dedup_lines, keep_bitmaps
from obsforge.llm.mixing import mix
from obsforge.llm.quality import score_quality
from obsforge.llm.span_dedup import drop_repeated_passages
from obsforge.llm.substring_dedup import drop_repeated_substrings
from obsforge.llm.toxicity import score_toxicity


def by_id(rows):
    found = {}
    for r in rows:
        found.setdefault(r.doc_id, []).append(r)
    return found


def test_quality(edges, nothing, labels):
    rows = score_quality(edges, labels).drop("row").collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in edges.collect())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    found = by_id(rows)
    assert found[4][0].score == found[5][0].score  # null is empty
    assert not any(r.held_out for r in found[None])
    assert score_quality(nothing, labels).count() == 0
    unlabelled = {r.score for r in score_quality(edges, labels.limit(0)).collect()}
    assert unlabelled == {0.5}


def test_toxicity(edges, nothing, labels):
    rows = score_toxicity(edges, labels).collect()
    assert len(rows) == edges.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    found = by_id(rows)
    assert found[4][0].score == found[5][0].score
    assert score_toxicity(nothing, labels).count() == 0
    assert {r.score for r in score_toxicity(edges, labels.limit(0)).collect()} == {0.5}


def test_language(edges, nothing):
    rows = identify_languages(edges).collect()
    found = by_id(rows)
    assert len(rows) == edges.count()
    assert {(found[i][0].lang_pred, found[i][0].score) for i in (4, 5, 6, 7, 16)} == {("und", 0.0)}
    assert found[12][0].lang_pred in ("en", "de", "fr") and found[8][0].lang_pred == found[9][0].lang_pred
    assert identify_languages(nothing).count() == 0
    unlearnt = identify_languages(edges.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unlearnt} == {("und", 0.0)}


def test_mixing(edges, nothing):
    rows = mix(edges, F.array("source")).collect()
    assert len(rows) == edges.count()
    for r in rows:
        text = r.text or ""
        assert r["size"] == len([w for w in text.replace("\x0b", " ").replace("\x0c", " ").split(" ") if w.strip("\t\n\r")]) or "\n" in text
        assert r.taken in (0, r["size"], 2 * r["size"], 3 * r["size"])
        assert r.routes[0].source == r["row"].source
    again = mix(edges, F.array("source")).select("doc_id", "taken").collect()
    assert Counter(map(tuple, again)) == Counter((r.doc_id, r.taken) for r in rows)
    assert mix(nothing, F.array("source")).count() == 0


def test_decontaminate(spark, edges, nothing, edge_rows):
    words = edge_rows[0][1].split()
    items = spark.createDataFrame(
        [(1, " ".join(words[5:40]), None), (2, "word", None), (3, None, None), (4, "", None), (None, "x y", None)],
        "item_id long, text string, words string",
    )
    found = contaminated(edges, items).collect()
    assert sorted({(r.doc_id or 0, r.item_id) for r in found}) == [(0, 1), (1, 1), (2, 1), (3, 1)]
    assert all(r.similarity == 1.0 and r.n_words == 35 for r in found)
    kept = drop_contaminated(edges, items)
    assert kept.columns == edges.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted([0, *range(4, 17), 2])
    assert contaminated(nothing, items).count() == 0
    assert drop_contaminated(edges, items.limit(0)).count() == edges.count()


def test_lines(edges, nothing):
    found = by_id(dedup_lines(edges).collect())
    assert sum(map(len, found.values())) == edges.count()
    assert found[4][0].kept == "" and found[4][0].n_lines == 1
    assert found[7][0].kept == "\n\n\n" and found[7][0].n_lines == 4
    assert found[10][0].n_dropped == 0 and found[11][0].kept == "unlike this line here"
    assert {r.n_dropped for r in found[2]} == {1, 0}  # one line each; the other text has its own
    assert found[13][0].n_dropped == 3999 and found[13][0].n_lines == 4000
    assert found[None][0].n_dropped == 0
    assert dedup_lines(nothing).count() == 0
    maps = {r.doc_id: r for r in keep_bitmaps(edges).collect()}
    assert maps[11].keep[0].word == 0 and maps[11].keep[0].bits == ~1


def test_embeddings(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [0.0, 1.0], 1), (4, None, None), (5, [], 0), (6, [0.0, 0.0], 0),
        (7, [1.0, None], 0), (8, [nan, 1.0], 0), (9, [inf, 1.0], 0), (10, [1.0, 0.0, 0.0], 0), (11, [1.0, 0.01, 0.0], 0), (None, [1.0, 0.0], 0),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n int")
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_groups(vectors).collect()}
    assert found[1] == (2, 1, True) and found[2] == (2, 1, False) and found[3] == (0, 3, True)
    assert all(found[i] == (0, i, True) for i in (4, 5, 6, 7, 8, 9))
    assert found[10] == (1, 10, True) and found[11] == (1, 10, False)
    assert found[None] == (0, None, False)
    assert near_groups(vectors.limit(0)).count() == 0


def test_passages(edges, nothing):
    found = by_id(drop_repeated_passages(edges).collect())
    assert sum(map(len, found.values())) == edges.count()
    assert found[1][0].n_removed == 0 and {(r.n_removed, r.n_spans) for r in found[2]} == {(8, 1), (0, 0)}
    assert found[3][0].n_removed == 8 and found[3][0].kept.startswith("Own words here first. ")
    assert found[4][0].kept == "" and found[6][0].kept == " \t\n " and found[None][0].n_removed == 0
    assert found[15][0].kept.startswith("\U0001f600")
    assert drop_repeated_passages(nothing).count() == 0


def test_substrings(edges, nothing):
    rows = drop_repeated_substrings(edges).collect()
    found = by_id(rows)
    assert len(rows) == edges.count()
    empty = hashlib.sha256(b"").hexdigest()
    assert found[1][0].n_removed == found[1][0].n_bytes and found[1][0].kept_sha256 == empty
    assert found[4][0].n_bytes == 0 and found[4][0].kept_sha256 == empty
    assert (found[14][0].n_removed, found[14][0].n_spans) == (3000, 1)
    assert found[12][0].n_removed == found[12][0].n_bytes and found[8][0].n_removed == 0
    assert found[13][0].spans[0].end == found[12][0].n_bytes
    assert drop_repeated_substrings(nothing).count() == 0


def test_similar_groups(edges, nothing):
    rows = similar_groups(edges, 3, 90).collect()
    found = by_id(rows)
    assert len(rows) == edges.count()
    assert found[4][0].n_shingles == 0 and found[4][0].component_id == 4 and found[6][0].n_shingles == 0
    assert found[8][0].n_shingles == 1 and found[9][0].component_id == 8
    assert found[13][0].component_id == 12 and {r.component_id for r in found[2]} == {1, 2}
    assert all(r.component_id is None for r in found[None])
    assert similar_groups(nothing, 3, 90).count() == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, edges, nothing, labels, name, tmp_path):
    folder = str(tmp_path)
    labels.write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "no such words in any of the texts here")], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet"
    )
    stage = dict(corpus_pipeline.STAGES)[name]
    for docs in (edges, nothing):
        out = stage(spark, docs, folder)
        if name != "mixing":
            assert out.columns == docs.columns
        assert len({c.lower() for c in out.columns}) == len(out.columns)
        out.write.mode("overwrite").parquet(f"{folder}/out")
        assert spark.read.parquet(f"{folder}/out").count() <= docs.count()

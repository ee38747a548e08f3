import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillstone.llm import boosting, language, minhash, packing, quality
from quillstone.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute_counts(text):
    w = (text or "").encode().split()
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    covered = {k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    return [len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)]


def test_counts_match_brute_force():
    texts = pq.read_table(f"{SF}/documents.parquet", columns=["text"])["text"].to_pylist()[:60]
    texts += [None, "", " \n ", "a b c d e f g h " * 3, "x\nx\n \nx", "é ü\n日本 #*$%&|<>", "w " * 2000]
    counts, features = quality.measure(pa.array(texts, pa.string()))
    assert counts.tolist() == [brute_counts(t) for t in texts]
    assert np.isfinite(features).all()


def test_trees_learn_and_keep_their_direction():
    rng = np.random.default_rng(0)
    x = rng.random((800, 3))
    y = (x[:, 0] < 0.5) & (x[:, 1] > 0.2)
    trees = boosting.fit(x, y, np.array([-1, 0, 0]))
    assert ((trees.score(x) > 0.5) == y).mean() > 0.97
    grid = np.repeat(rng.random((50, 3)), 40, axis=0)
    grid[:, 0] = np.tile(np.linspace(0, 1, 40), 50)
    assert (np.diff(trees.score(grid).reshape(50, 40), axis=1) <= 1e-12).all()


def test_quality_without_labels_and_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.fit(odd_documents, labels) is None
    rows = quality.judge(odd_documents, None).collect()
    assert len(rows) == odd_documents.count()
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in rows)
    assert quality.judge(no_documents, None).count() == 0
    some = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (None, 0, 0), (2, None, 0), (14, 0, 0)], "doc_id long, quality int, toxic int")
    assert quality.fit(odd_documents, some) is not None


def test_quality_agrees_with_labels(spark):
    rows = {r.doc_id: r for r in QUERIES["op9_quality"](spark, "/root/testdata/sf0.01").collect()}
    labels = [r for r in pq.read_table("/root/testdata/sf0.01/labels.parquet").to_pylist() if not rows[r["doc_id"]].base_failed]
    assert np.mean([rows[r["doc_id"]].kept == bool(r["quality"]) for r in labels]) > 0.97


def test_language_held_out_accuracy_and_calibration(spark):
    lang = {r["doc_id"]: r["lang"] for r in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "lang"]).to_pylist()}
    rows = QUERIES["op8_language"](spark, "/root/testdata/sf0.01").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(spark, odd_documents, no_documents):
    nothing = language.fit(no_documents, F.lit(True))
    rows = language.predict(odd_documents, nothing).collect()
    assert len(rows) == odd_documents.count() and {r.lang_pred for r in rows} == {"und"}
    model = language.fit(odd_documents, F.lit(True))
    rows = {r.doc_id: r for r in language.predict(odd_documents, model).collect()}
    assert rows[0].lang_pred == rows[1].lang_pred == rows[2].lang_pred == "und"
    assert rows[4].lang_pred == "en"
    assert rows[None].held_out is False
    assert language.grams("123 -") is None and language.grams("𝒳") is not None


def test_sparse_weights():
    rng = np.random.default_rng(0)
    rows = [("ab"[i % 2], np.array([i % 2, 5 + i % 7]), np.array([3.0, 1.0])) for i in range(200)]
    model = language.train(rows, np.ones(language.BUCKETS))
    assert (model.weights != 0).sum() < 40
    assert model.predict("") == ("und", 0.0)
    assert rng is not None


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_stages_keep_the_columns_and_take_effect(spark, stages):
    docs, good, lined, single, unique, packed = stages
    for df in (good, lined, single, unique):
        assert df.columns == docs.columns
    verdict = {r.doc_id: r.kept for r in quality.judge(docs, quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))).collect()}
    assert sorted(r.doc_id for r in good.collect()) == sorted(d for d, k in verdict.items() if k)
    assert single.count() == sum(r.kept for r in minhash.near_duplicates(lined).collect())
    for before, after in ((good, lined), (single, unique)):
        was = {r.doc_id: r.text for r in before.collect()}
        now = {r.doc_id: (r.text, r.n_chars) for r in after.collect()}
        assert all(len(t) <= len(was[d]) and t.strip() for d, (t, _) in now.items())
        assert all(n == len(t) for d, (t, n) in now.items() if t != was[d])
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in unique.collect()}


def test_last_stage_is_a_packing_of_what_was_left(stages):
    from tests.llm.test_token_operators import check_packed

    rows = stages[-1].collect()
    used, least = check_packed(rows, [(r.doc_id, r.text) for r in stages[-2].collect()], 1024)
    assert used <= least + 2
    assert packing.plan({}, 1024) == []


def test_stages_on_odd_rows_and_empty_tables(spark, tmp_path_factory):
    """Null ids and texts, repeated rows, names that clash with the operators' own, and no rows."""
    kinds = "doc_id long, text string, lang string, source string, n_chars long, __key string, __n_removed int, __drop int"
    prose = " ".join(f"word{i}." for i in range(60))
    rows = [(i, t, None, None, None, "k", 1, None) for i, t in ((1, prose), (1, prose), (None, prose + " x y"), (None, "z " + prose), (2, None), (3, ""), (4, prose.upper()), (5, " ".join(f"other{i}" for i in range(50))))]
    for table in (rows, []):
        docs = spark.createDataFrame(table, kinds)
        for name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path_factory.mktemp("odd") / name)
            stage(spark, docs, SF).write.parquet(path)
            after = spark.read.parquet(path)
            if name != "packing":
                assert after.columns == docs.columns
                assert {r["__key"] for r in after.collect()} <= {"k"}
            docs = after
        if not table:
            assert docs.count() == 0


def test_scores_are_those_of_a_walk_down_each_tree():
    rng = np.random.default_rng(3)
    x = rng.random((300, 4))
    trees = boosting.fit(x, (x[:, 0] + x[:, 1] > 1) ^ (x[:, 2] > 0.8), np.zeros(4, int), trees=20)

    def walk(row):
        total = trees.base
        for node in trees.roots:
            while trees.left[node] != node:
                node = trees.left[node] if row[trees.feature[node]] <= trees.threshold[node] else trees.right[node]
            total += trees.value[node]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(trees.score(x), [walk(r) for r in x], rtol=0, atol=1e-12)


def test_run_gives_the_last_stages_rows(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == stages[-1].columns
    key = ["doc_id", "piece", "ids_crc32", "length"]
    assert sorted(map(tuple, got.select(*key).collect())) == sorted(map(tuple, stages[-1].select(*key).collect()))

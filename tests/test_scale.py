"""What a larger table must not make grow: shuffle files, rows on the driver, copied blocks."""

import random
import re

import pytest
from pyspark.sql import functions as F

from sparkwright.operators import selection as S
from sparkwright.session import SHUFFLE_CLEANUP, materialize


def _shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in manager.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}


def test_a_written_table_leaves_no_shuffle_files(spark):
    before, setting = _shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP)
    out = materialize(spark.range(1000).groupBy(F.col("id") % 7).count().repartition(3), "few")
    left = {f for f in _shuffle_files(spark) - before if f.endswith(".data")}
    assert not left and out.count() == 7
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting


def _folded_counts(spark, folds=6):
    rng = random.Random(8)
    rows = [(i, i % 2, i % folds, f"t{t}", rng.randrange(1, 4)) for i in range(90) for t in rng.sample(range(15), 4 + 2 * (i % 2))]
    counts = spark.createDataFrame(rows, "doc_id long, label int, fold int, term string, tf long")
    return counts, counts.select("doc_id", "label", "fold").distinct()


def test_one_held_out_fold_of_naive_bayes_has_the_rows_it_has_among_all(spark):
    counts, docs = _folded_counts(spark)
    want = {r.doc_id: r.p1 for r in S.nb_oof(counts, docs, [0.5], k=6).where("fold = 5").collect()}
    terms = S.fold_terms(counts.where("fold < 5"), range(5)).where("n >= 2")
    got = {r.doc_id: r.p1 for r in S.nb_oof(counts, docs, [0.5], k=6, folds=[5], terms=terms).collect()}
    assert len(got) == 15 and got == pytest.approx(want)


def test_naive_bayes_weights_are_not_dealt(spark):
    counts, docs = _folded_counts(spark, 5)
    plan = S.nb_oof(counts, docs, [0.5])._jdf.queryExecution().optimizedPlan().toString()
    # What is dealt by document has a count, and no weight, of each term.
    columns = ", ".join(rf"{c}#\d+L?" for c in ("doc_id", "label", "fold", "idx", "tf"))
    assert re.search(rf"RepartitionByExpression \[doc_id#\d+L?\]\n[^\n]*Project \[{columns}\]\n", plan)


def _vector_rows(spark, n=80):
    from pyspark.ml.linalg import Vectors

    rng = random.Random(4)
    rows = [(i, i % 2, int(i % 7 == 6), i // 2 % 5 if i % 7 < 6 else None, 1.0, Vectors.dense(rng.random(), i % 2 + rng.random())) for i in range(n)]
    return spark.createDataFrame(rows, ["doc_id", "label", "is_test", "fold", "weight", "features"])


def test_model_comparison_reports_from_tables_and_not_through_all_models(spark, monkeypatch):
    from sparkwright.plans import explaining as E

    plans, models = {}, E._classifiers

    def noted(df, tag):
        plans.setdefault(tag, []).append(df._jdf.queryExecution().optimizedPlan().toString())
        return materialize(df, tag)

    monkeypatch.setattr(E, "materialize", noted)
    monkeypatch.setattr(E, "_classifiers", lambda *a: {"Basic CART": models(*a)["Basic CART"]})
    report = E.compare_models(spark, _vector_rows(spark)).collect()
    assert len(report) == 1 and report[0].cv_roc_auc_mean is not None
    # One job a fitted model; the job of the report's rows holds none.
    assert "UDF" not in plans["model-scores"][0] and sum("UDF" in p for p in plans["fold-scores"]) >= 6


def test_side_by_side_fits_are_bounded_by_their_rows(spark, monkeypatch):
    from sparkwright.plans import explaining as E

    rows = spark.range(100)
    assert E._side_by_side(rows) == 4
    monkeypatch.setattr(E, "FIT_ROWS", 250)
    assert E._side_by_side(rows) == 2
    monkeypatch.setattr(E, "FIT_ROWS", 50)
    assert E._side_by_side(rows) == 1


def _corpus(tmp_path):
    mails = {
        "spam/1": b"Content-Type: text/plain\n\na", "spam/2": b"\nb", "spam/deep/spam_2/3": b"\nc",
        "easy_ham 2/4": b"\nd", "easy_ham/5{x}": b"\ne", "easy_ham/cmds": b"mv", "easy_ham/_hidden": b"\nno",
        "other/6": b"\nno", **{f"hard_ham/{i}": b"\n%d" % i for i in range(20, 31)},
    }
    for name, body in mails.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(body)
    return str(tmp_path)


def test_a_corpus_is_scanned_a_bounded_number_of_files_at_a_time(spark, tmp_path, monkeypatch):
    from sparkwright.sources import files as X

    root = _corpus(tmp_path)
    whole = sorted(map(tuple, X.scan_labelled_corpus(spark, root).collect()))
    assert len(whole) == 16
    held, read = [], X._read_files

    def noted(spark, paths, n=None):
        out = read(spark, paths, n)
        held.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(X, "_read_files", noted)
    monkeypatch.setattr(X, "FILES_AT_ONCE", 4)
    before = spark.conf.get(X.LISTING)
    rows = X.scan_labelled_corpus(spark, root)
    assert sorted(map(tuple, rows.collect())) == whole
    assert len(held) > 3 and max(held) <= 4 and spark.conf.get(X.LISTING) == before
    texts = sorted(r.text for r in X.mail_text_part(X.scan_labelled_corpus(spark, root, with_filename=False)).collect())
    assert texts == sorted(["a", "b", "c", "d", "e", *map(str, range(20, 31))])


@pytest.mark.parametrize("name", ["scan_labelled_corpus", "mail_text_part"])
def test_mail_queries_are_the_same_from_folders_of_any_size(spark, sf, name, monkeypatch):
    from sparkwright.plans import files as P
    from sparkwright.plans.registry import QUERIES, load_all
    from sparkwright.sources import files as X

    load_all()
    want = sorted(map(tuple, QUERIES[name](spark, sf).collect()))
    monkeypatch.setattr(P, "FOLDER_MAILS", 30)
    monkeypatch.setattr(X, "FILES_AT_ONCE", 50)
    assert sorted(map(tuple, QUERIES[name](spark, sf).collect())) == want


def _sparse_frame(spark, n=150, terms=40):
    import numpy as np

    rng = np.random.default_rng(3)
    # Some terms are in most rows, most are in few; one row is empty, some are copies.
    share = np.r_[np.full(4, 0.8), np.full(terms - 4, 0.04)]
    x = rng.random((n, terms)) * (rng.random((n, terms)) < share)
    x[7], x[60:70] = 0, x[3]
    rows = [(i, [int(j) for j in np.flatnonzero(v)], [float(w) for w in v[v != 0]]) for i, v in enumerate(x)]
    return x, spark.createDataFrame(rows, "id long, idx array<int>, w array<double>")


@pytest.mark.parametrize("block_rows, products, common", [(8192, 2_000_000, 64), (20, 5, 2), (33, 7, 10**9)])
@pytest.mark.parametrize("self_out", [False, True])
def test_sparse_neighbours_are_exact_whatever_the_blocks(spark, monkeypatch, block_rows, products, common, self_out):
    import numpy as np

    from sparkwright.operators import neighbours as N

    monkeypatch.setattr(N, "PRODUCTS", products)
    monkeypatch.setattr(N, "COMMON_SHARE", common)
    x, base = _sparse_frame(spark)
    queries = base.where("id % 3 = 0").withColumnRenamed("id", "qid")
    got = {(r.qid, r["rank"]): (r.id, r.dist) for r in N.knn_sparse(queries, base, 4, self_out, block_rows).collect()}
    assert len(got) == 200
    for q in range(0, 150, 3):
        d = np.round(np.sqrt(((x - x[q]) ** 2).sum(1)), 6)
        order = [j for j in np.lexsort((np.arange(150), d)) if not (self_out and j == q)][:4]
        assert [got[q, i + 1][0] for i in range(4)] == order
        assert [got[q, i + 1][1] for i in range(4)] == pytest.approx([d[j] for j in order], abs=2e-6)


def test_sparse_neighbours_copy_neither_side(spark):
    from sparkwright.operators import neighbours as N

    _, base = _sparse_frame(spark)
    found = N.knn_sparse(base.withColumnRenamed("id", "qid"), base, 3, block_rows=8192)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "CoGroup" not in plan


def test_sparse_neighbours_of_no_rows_and_of_rows_without_a_key(spark):
    from sparkwright.operators import neighbours as N

    _, base = _sparse_frame(spark, 40)
    queries = base.withColumnRenamed("id", "qid")
    assert N.knn_sparse(queries.limit(0), base, 3).count() == 0
    assert N.knn_sparse(queries, base.limit(0), 3).count() == 0
    none = base.select(F.lit(None).cast("long").alias("id"), "idx", "w")
    want = sorted(map(tuple, N.knn_sparse(queries, base, 3).collect()))
    assert sorted(map(tuple, N.knn_sparse(queries, base.unionByName(none), 3).collect())) == want

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm import quality

FULL = "/root/testdata/sf0.01"


def joined(scores, labels, column):
    rows = scores.join(labels, "doc_id").where(F.col("held_out")).collect()
    return np.array([r[column] for r in rows]), np.array([r["score"] for r in rows])


def test_held_out_accuracy(spark):
    documents = spark.read.parquet(f"{FULL}/documents.parquet")
    labels = spark.read.parquet(f"{FULL}/labels.parquet")
    scores = quality.scored(documents, labels).cache()
    assert scores.count() == documents.count()
    y, p = joined(scores, labels, "quality")
    assert (p[y == 1] >= 0.5).mean() > 0.95 and (p[y == 0] < 0.5).mean() > 0.9
    assert scores.where("score < 0 or score > 1 or predicted <> cast(score >= 0.5 as int)").count() == 0


def test_reruns_agree_and_held_out_labels_play_no_part(documents, labels):
    first = sorted(quality.scored(documents, labels).collect())
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = sorted(quality.scored(documents.repartition(5), turned.repartition(3)).collect())
    assert first == again


def test_labelled_negatives_play_no_part(documents, labels):
    """Neither to the scorer nor to the prior."""
    first = sorted(quality.scored(documents, labels).collect())
    without = labels.withColumn("quality", F.when(F.col("quality") == 1, 1))
    assert sorted(quality.scored(documents, without).collect()) == first
    assert sorted(quality.scored(documents, labels.where("quality = 1")).collect()) == first


def made_up(rnd, share, n_positives=600, n=4000):
    """Two classes of rows, ``share`` of the unlabelled ones good."""
    good = rnd.random(n) < share
    rows = rnd.normal(0, 0.3, (n, quality.FEATURES)) + np.where(good, 0.1, -0.1)[:, None]
    trusted = rnd.normal(0, 0.3, (n_positives, quality.FEATURES)) + 0.1
    return trusted, rows, good


def moments(trusted, rows):
    basis = quality.Basis(trusted)
    return basis, quality.Moments.of(basis.of(trusted)), quality.Moments.of(basis.of(rows))


@pytest.mark.parametrize("share", [0.2, 0.5, 0.85])
def test_prior_and_scorer_of_positives_and_unlabelled_rows(share):
    trusted, rows, good = made_up(np.random.default_rng(0), share)
    basis, p, u = moments(trusted, rows)
    phi = basis.of(trusted) / quality._UNIT
    prior = quality.class_prior(phi[::2].mean(0), phi[1::2].mean(0), u.gram)
    assert abs(prior - share) < 0.1
    scorer = quality.Scorer(basis, quality.least_risk(p, u, prior))
    scorer.cut = quality.best_cut(scorer.bins(trusted), scorer.bins(rows), prior)
    assert ((scorer.score(rows) >= 0.5) == good).mean() > 0.94


def risk(w, phi_p, phi_u, prior):
    def loss(phi, sign):
        return ((1 - sign * phi @ w) ** 2 / 4).mean()

    return prior * loss(phi_p, 1) + max(0, loss(phi_u, -1) - prior * loss(phi_p, -1))


@pytest.mark.parametrize("prior", [0.3, 0.6, 0.9])
def test_least_risk(prior):
    """No step away from it lowers the non-negative risk, with the ridge."""
    rnd = np.random.default_rng(3)
    trusted, rows, _ = made_up(rnd, 0.6, 100, 500)
    basis, p, u = moments(trusted, rows)
    phi_p, phi_u = basis.of(trusted) / quality._UNIT, basis.of(rows) / quality._UNIT
    found = quality.least_risk(p, u, prior)

    def whole(w):
        return risk(w, phi_p, phi_u, prior) + quality._RIDGE * w @ w / 4

    least = whole(found)
    for size in (1e-3, 1e-2, 0.1, 1):
        for _ in range(50):
            step = rnd.normal(0, size / len(found) ** 0.5, len(found))
            assert whole(found + step) >= least - 1e-9 * (1 + least)


def test_best_cut():
    p, u = np.zeros(quality._BINS, int), np.zeros(quality._BINS, int)
    p[3000], u[3000], u[1000] = 50, 80, 20
    assert abs(quality.best_cut(p, u, 0.8) - ((3000 + 1001) / 2 * 4 / quality._BINS - 2)) < 1e-9


def test_sums_do_not_depend_on_partitions(documents):
    basis = quality.Basis(np.random.default_rng(1).normal(size=(9, quality.FEATURES)))

    def of(rows):
        return quality.Moments.of(basis.of(rows.astype(np.float64))).second.ravel()

    first = quality.total(documents, of)
    assert (quality.total(documents.repartition(7), of) == first).all()
    texts = [r.text or "" for r in documents.collect()]
    assert (of(quality.features(texts)) == first).all()
    assert quality.total(documents.limit(0), of) is None


def test_odd_rows(odd, empty, labels, spark):
    rows = quality.scored(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality.scored(empty, labels).count() == 0
    none = labels.limit(0)
    assert {r.score for r in quality.scored(odd, none).collect()} == {0.5}
    strange = spark.createDataFrame(
        [(1, None, 1), (None, 1, None), (4, 1, 0), (4, 0, 0), (5, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    assert quality.scored(odd, strange).count() == odd.count()
    assert quality.kept(odd, labels).columns == odd.columns
    assert quality.kept(empty, labels).count() == 0


def test_kept_are_the_predicted(documents, labels):
    predicted = {r.doc_id for r in quality.scored(documents, labels).collect() if r.predicted}
    assert {r.doc_id for r in quality.kept(documents, labels).collect()} == predicted

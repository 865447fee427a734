"""Quality: held-out accuracy, posteriors against plain arithmetic, and odd rows."""

import math
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm.conftest import SMALL, empty_of
from marquee.llm.quality import (LEAST_STRENGTH, MOST_STRENGTH, SiteModel, features, fit, good_documents, quality,
                                 slice_features, strength, trained)
from marquee.llm.textbytes import RollingHash, slices


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")


def test_held_out_accuracy(tables):
    docs, labels = tables
    train, test = labels.filter("doc_id % 3 != 0"), labels.filter("doc_id % 3 = 0")
    got = quality(docs, train).join(test.select("doc_id", "quality"), "doc_id").collect()
    assert len(got) > 100
    assert np.mean([r.kept == (r.quality == 1) for r in got]) >= 0.97
    assert np.mean([r.kept for r in got if r.quality == 1]) >= 0.99


def test_scores_equal_plain_arithmetic(tables):
    docs, labels = tables
    model = SiteModel(docs, labels)
    rows = model.features.select("doc_id", "host", "path", "x").collect()
    w, mean, scale = model.model
    p = {r.doc_id: min(max(1 / (1 + math.exp(-(np.dot((np.array(r.x) - mean) / scale, w[:-1]) + w[-1]))), 1e-4), 1 - 1e-4)
         for r in rows}
    site, host = {}, {}
    for r in rows:
        for table, key in ((site, (r.host, r.path)), (host, r.host)):
            n, s = table.get(key, (0, 0.0))
            table[key] = (n + 1, s + p[r.doc_id])
    rate = sum(p.values()) / len(p)

    def moments(groups):
        n = sum(k for k, _ in groups)
        m = sum(s for _, s in groups) / n
        spread = sum(k * (s / k - m) ** 2 for k, s in groups)
        between = (spread - (len(groups) - 1) * m * (1 - m)) / (n - sum(k * k for k, _ in groups) / n)
        return MOST_STRENGTH if between <= 0 else min(max(m * (1 - m) / between - 1, LEAST_STRENGTH), MOST_STRENGTH)

    of_host, of_site = moments(list(host.values())), moments(list(site.values()))
    assert model.of_host == pytest.approx(of_host, rel=1e-6) and model.of_path == pytest.approx(of_site, rel=1e-6)

    def logit(q):
        return math.log(q / (1 - q))

    got = {r.doc_id: r for r in quality(docs, labels).collect()}
    for r in rows:
        own = p[r.doc_id]
        n, s = host[r.host]
        h = (s - own + of_host * rate) / (n - 1 + of_host)
        n, s = site[r.host, r.path]
        q = min(max((s - own + of_site * h) / (n - 1 + of_site), 1e-4), 1 - 1e-4)
        score = 1 / (1 + math.exp(-(logit(own) + logit(q) - logit(rate))))
        assert got[r.doc_id].p_site == pytest.approx(q, rel=1e-9)
        assert got[r.doc_id].score == pytest.approx(score, rel=1e-9)


def test_sparse_sites_take_over_their_prior(spark):
    sites = spark.createDataFrame([(100, 90.0), (100, 10.0), (100, 50.0)], "n long, s double")
    assert LEAST_STRENGTH <= strength(sites, "n", "s") < 10
    even = spark.createDataFrame([(100, 50.0), (100, 50.0)], "n long, s double")
    assert strength(even, "n", "s") == MOST_STRENGTH
    assert strength(even.limit(1), "n", "s") == MOST_STRENGTH == strength(even.limit(0), "n", "s")


def test_kept_rows_equal_the_decisions(tables):
    docs, labels = tables
    decided = {r.doc_id for r in quality(docs, labels).filter("kept").collect()}
    kept = good_documents(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == decided
    assert 0.75 < len(decided) / docs.count() < 0.95


def test_odd_rows_and_labels(spark, odd_rows, tables):
    labels = tables[1]
    got = quality(odd_rows, labels)
    assert got.count() == odd_rows.count()
    one_kind = spark.createDataFrame([(1, 1), (2, 1), (1, 1), (None, 0), (3, None)], "doc_id long, quality int")
    got = quality(odd_rows, one_kind).collect()
    assert all(r.kept and r.p_document == 0.5 for r in got)
    assert good_documents(odd_rows, one_kind).count() == odd_rows.count()
    assert quality(empty_of(odd_rows), labels).collect() == []
    assert good_documents(empty_of(odd_rows), labels).collect() == []


def test_fit_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    w, mean, scale = fit(np.column_stack([x, np.ones(400)]), (x[:, 0] > 0).astype(float))
    assert w[0] > 2 and abs(w[1]) < 1 and scale[3] == 1.0


def plain_features(text):
    """The features word by word."""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    if not words:
        return [0.0] * 16
    low = [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in words]

    def upper(w):
        letters = re.findall("[A-Za-z]", w)
        return len(letters) > 1 and all(c.isupper() for c in letters)

    tests = [upper, lambda w: w.count("!") > 1, lambda w: "|" in w,
             lambda w: any(c in "#$%&*+<=>@\\^_`{}~" for c in w), lambda w: re.search("[0-9]", w) is not None]
    flags = [[bool(t(w)) for w in words] for t in tests]
    flags.append([k > 0 and low[k] == low[k - 1] for k in range(len(low))])
    cuts = list(range(0, len(words), 40))
    if len(cuts) > 1 and len(words) - cuts[-1] < 20:
        cuts.pop()
    blocks = list(zip(cuts, [*cuts[1:], len(words)]))
    mean = [sum(f) / len(f) for f in flags]
    worst = [max(sum(f[a:b]) / (b - a) for a, b in blocks) for f in flags]
    stops = sum("." in w or "," in w for w in words) / len(words)
    return [math.log(1 + len(words)), sum(len(w.encode()) for w in words) / len(words), *mean[:5], stops,
            len(set(low)) / len(words), mean[5], *worst]


def test_features_equal_a_word_by_word_reading(tables):
    texts = [r.text for r in tables[0].limit(150).collect()] + [
        None, "", " \n", "A", "AB ab Ab", "!! !!! ! a!b!", "é É ÉÉ AÉB", "x|y # 1 a.b", "w " * 59, "w " * 60, "W w v " * 40]
    got = np.concatenate([slice_features(RollingHash(), o, d) for _, _, o, d in slices(pa.array(texts, pa.string()), 1 << 12)])
    assert got == pytest.approx(np.array([plain_features(t) for t in texts]), abs=1e-12)


def test_fit_is_where_the_penalised_likelihood_is_flat():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 5)) * [1, 10, 0.1, 1, 0] + 3
    y = (x[:, 0] + x[:, 1] / 10 + rng.normal(size=400) > 6).astype(float)
    w, mean, scale = fit(x, y, 2.0)
    z = (x - x.mean(axis=0)) / np.where(x.std(axis=0) > 0, x.std(axis=0), 1)

    def loss(v):
        margin = (z @ v[:-1] + v[-1]) * (2 * y - 1)
        return np.log1p(np.exp(-margin)).sum() + (v[:-1] ** 2).sum()  # half of a ridge of 2

    for k in range(6):
        for step in (-1e-3, 1e-3):
            assert loss(w) <= loss(w + step * np.eye(6)[k]) + 1e-9


def test_the_sample_is_drawn_from_rows_that_exist(spark, tables):
    docs, labels = tables
    found = features(docs, "doc_id", "text", "source", "lang")
    other = spark.range(10_000_000, 10_020_000).selectExpr("id doc_id", "cast(id % 2 as int) quality")
    alone, amid = (trained(found, t.select("doc_id", F.col("quality").cast("int").alias("quality")), "quality", "doc_id", 300)
                   for t in (labels, labels.select("doc_id", F.col("quality").cast("int").alias("quality")).union(other)))
    assert all(np.array_equal(a, b) for a, b in zip(alone, amid))
    # A few rows of all: the same as sorting everything, also where one id holds most rows.
    hot = docs.union(docs.filter("doc_id = 4").withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(3000)))).drop("k"))
    for table in (docs, hot):
        known = features(table, "doc_id", "text", "source", "lang").join(labels.select("doc_id", "quality"), "doc_id")
        rows = known.select(F.xxhash64("doc_id").alias("at"), "doc_id", "quality", "x").collect()
        for size in (20, 60):
            drawn = sorted((r.at, r.doc_id, r.quality, r.x) for r in rows)[:size]
            own = trained(features(table, "doc_id", "text", "source", "lang"), labels, "quality", "doc_id", size)
            drawn.sort(key=lambda r: r[1:])
            if len({r[2] for r in drawn}) < 2:
                assert own is None
            else:
                assert np.allclose(own[0], fit(np.array([r[3] for r in drawn]), np.array([r[2] for r in drawn], float))[0])
    # Repeated rows are drawn with the others, to the same bound and alike whatever the partitions.
    twice = docs.union(docs)
    first, again = (trained(features(d, "doc_id", "text", "source", "lang"), labels, "quality", "doc_id", 300)
                    for d in (twice, twice.repartition(7)))
    assert all(np.array_equal(a, b) for a, b in zip(first, again))

"""Document quality by hierarchical empirical Bayes.

1. **Document evidence.** A logistic regression on surface features of the
   whole text (shares of capitals, symbols, repeated words, and the worst
   block of the text) is fitted to a bounded sample of labelled documents.
2. **Site posteriors.** Over all documents the classifier's probabilities are
   summed by host and by path within a host. The strength of the prior at each
   level comes from the spread of the level's rates (method of moments for a
   beta distribution). A host's rate is shrunk towards the global rate, a
   path's towards its host's: sites of few documents take over their prior.
3. **Combination.** A document's log odds are its own evidence plus what its
   site's rate, without the document itself, adds to the global rate.

Sites are grouped aggregates; nothing but the model (a few numbers) and the
sample reach the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.minhash import word_hashes
from marquee.llm.textbytes import RollingHash, slices
from marquee.plans.materialize import materialize

# Labelled rows that the classifier is fitted to, at most: those of least hash among the rows that exist.
SAMPLE = 20_000
THRESHOLD = 0.5
BLOCK_WORDS = 40
# Strength of a level's prior, in documents, is kept within these.
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 10_000.0
RIDGE = 1.0

FEATURES = ("log_words", "word_length", "upper", "exclaims", "bars", "symbols", "digits", "stops", "distinct",
            "repeats", "worst_upper", "worst_exclaims", "worst_bars", "worst_symbols", "worst_digits",
            "worst_repeats")


def slice_features(hashing: RollingHash, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """``FEATURES`` of every document of a slice (a row each); an empty text has zeros."""
    docs = len(offsets) - 1
    out = np.zeros((docs, len(FEATURES)))
    hashes, ends = word_hashes(hashing, offsets, data)
    if len(hashes) == 0:
        return out
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(~space & (np.append(True, space[:-1]) | edge[:-1]))
    stop = np.flatnonzero(~space & (np.append(space[1:], True) | edge[1:])) + 1

    def per_word(flag):
        total = np.append(0, np.cumsum(flag))
        return total[stop] - total[start]

    letter = ((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A)
    capital = (data >= 0x41) & (data <= 0x5A)
    size = (stop - start).astype(np.float64)
    letters = per_word(letter)
    upper = (per_word(capital) == letters) & (letters > 1)
    exclaims = per_word(data == 0x21) > 1
    bars = per_word(data == 0x7C) > 0
    symbols = per_word(np.isin(data, np.frombuffer(b"#$%&*+<=>@\\^_`{}~", np.uint8))) > 0
    digits = per_word((data >= 0x30) & (data <= 0x39)) > 0
    stops = per_word((data == 0x2E) | (data == 0x2C)) > 0
    first = np.zeros(len(hashes) + 1, bool)
    first[ends] = True
    repeats = np.append(False, hashes[1:] == hashes[:-1]) & ~first[:-1]
    flags = [upper, exclaims, bars, symbols, digits, repeats]
    for k in range(docs):
        a, b = ends[k], ends[k + 1]
        n = b - a
        if n == 0:
            continue
        cuts = np.arange(a, b, BLOCK_WORDS)
        if len(cuts) > 1 and b - cuts[-1] < BLOCK_WORDS // 2:
            cuts = cuts[:-1]
        width = np.diff(np.append(cuts, b))
        mean = [f[a:b].mean() for f in flags]
        worst = [(np.add.reduceat(f[a:b].astype(np.int64), cuts - a) / width).max() for f in flags]
        distinct = len(np.unique(hashes[a:b])) / n
        out[k] = [np.log1p(n), size[a:b].mean(), *mean[:5], stops[a:b].mean(), distinct, mean[5], *worst]
    return out


def features(docs: DataFrame, id: str, text: str, host: str, path: str) -> DataFrame:
    """``(doc_id, host, path, x)`` of every row, with ``x`` the features."""

    def run(batches):
        hashing = RollingHash()
        for batch in batches:
            rows = [slice_features(hashing, o, d) for _, _, o, d in slices(batch.column(1))]
            flat = np.concatenate(rows).ravel() if rows else np.zeros(0)
            at = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), pa.ListArray.from_arrays(at, pa.array(flat))],
                ["doc_id", "host", "path", "x"])

    return docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text"),
                       F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path")).mapInArrow(
        run, "doc_id bigint, host string, path string, x array<double>")


def fit(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(weights with the intercept last, means, scales)`` of a ridge logistic regression (Newton steps)."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 0, scale, 1.0)
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + penalty * w
        hessian = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w, mean, scale


def trained(found: DataFrame, labels: DataFrame, label: str, id: str, sample: int = SAMPLE):
    """The classifier, fitted to at most ``sample`` labelled rows; null if they are not of both kinds.

    Labels are joined to the rows that exist before the sample is drawn (rows of least id hash, then id,
    label and features), so labels of other documents change nothing, and a table of repeated rows gives the same sample again.
    """
    given = labels.filter(F.col(label).isNotNull() & F.col(id).isNotNull()).select(
        F.col(id).cast("bigint").alias("l_id"), F.col(label).cast("int").alias("y"))
    known = materialize(found.select("doc_id", "x").join(given, F.col("doc_id") == F.col("l_id")).select(
        F.xxhash64("l_id").alias("at"), "l_id", "x", "y"), "labelled")
    n = known.count()
    if n > 4 * sample:
        # Every task would send its own ``sample`` rows; below this hash there are some ``2 * sample`` in all.
        least = known.filter(F.col("at") < F.lit(-(1 << 63) + (1 << 64) * 2 * sample // n))
        # Ids that repeat much may leave too few there: then all rows take part.
        known = least if least.count() >= sample else known
    rows = known.orderBy("at", "l_id", "y", "x").limit(sample).select("l_id", "x", "y").collect()
    rows.sort(key=lambda r: (r.l_id, r.y, r.x))
    y = np.array([r.y for r in rows], float)
    if len(rows) == 0 or y.min() == y.max():
        return None
    return fit(np.array([r.x for r in rows]), y)


def probability(model, x: str = "x") -> Column:
    """The classifier's probability of good quality, as a column over the features ``x``."""
    w, mean, scale = model
    inner = w[:-1] / scale
    constant = float(w[-1] - (inner * mean).sum())
    terms = F.zip_with(x, F.array(*[F.lit(float(v)) for v in inner]), lambda a, b: a * b)
    logit = F.aggregate(terms, F.lit(constant), lambda acc, v: acc + v)
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))
    return F.least(F.greatest(p, F.lit(1e-4)), F.lit(1 - 1e-4))


def strength(sites: DataFrame, n: str, total: str) -> float:
    """The prior's strength, in documents, of a level: method of moments over its sites' rates.

    With one site, or rates that differ no more than sampling makes them,
    the strength is ``MOST_STRENGTH``.
    """
    rate = F.col(total) / F.col(n)
    row = sites.agg(F.count(F.lit(1)).alias("k"), F.sum(n).alias("n"), F.sum(total).alias("s"),
                    F.sum(F.col(n) * F.col(n)).alias("nn"), F.sum(F.col(n) * rate * rate).alias("q")).first()
    if not row.k or row.k < 2 or not row.n:
        return MOST_STRENGTH
    mean = row.s / row.n
    spread = row.q - row.n * mean * mean            # weighted sum of squares of the rates
    even = row.n - row.nn / row.n
    within = mean * (1 - mean)
    between = (spread - (row.k - 1) * within) / even if even > 0 else 0.0
    if between <= 0 or within <= 0:
        return MOST_STRENGTH
    return float(min(max(within / between - 1, LEAST_STRENGTH), MOST_STRENGTH))


class SiteModel:
    """The classifier and the sites' rates, fitted to all documents.

    ``features`` is the table of all rows' features; ``sites`` holds the
    counts and sums of every path and of its host.
    """

    def __init__(self, docs: DataFrame, labels: DataFrame, label: str = "quality", id: str = "doc_id",
                 text: str = "text", host: str = "source", path: str = "lang", sample: int = SAMPLE):
        self.features = materialize(features(docs, id, text, host, path), "features")
        model = trained(self.features, labels, label, id, sample)
        self.model = model
        scored = self.features.select("host", "path", self.probability("x").alias("p"))
        paths = materialize(scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("s")),
                            "paths")
        hosts = paths.groupBy(F.col("host").alias("h_host")).agg(F.sum("n").alias("h_n"), F.sum("s").alias("h_s"))
        hosts = materialize(hosts, "hosts")
        whole = hosts.agg(F.sum("h_n").alias("n"), F.sum("h_s").alias("s")).first()
        self.rate = whole.s / whole.n if whole.n else 0.5
        self.of_host, self.of_path = strength(hosts, "h_n", "h_s"), strength(paths, "n", "s")
        self.sites = materialize(paths.join(hosts, F.col("host").eqNullSafe(F.col("h_host"))).select(
            F.col("host").alias("__host"), F.col("path").alias("__path"), F.col("n").alias("__n"),
            F.col("s").alias("__s"), F.col("h_n").alias("__hn"), F.col("h_s").alias("__hs")), "sites")

    def probability(self, x: str) -> Column:
        return F.lit(0.5) if self.model is None else probability(self.model, x)

    def scored(self, rows: DataFrame, host: str, path: str, x: str = "x") -> DataFrame:
        """Rows with features get ``__p`` (document), ``__site`` (its site without it) and ``__score``."""
        rows = rows.withColumn("__p", self.probability(x))
        on = (F.col(host).cast("string").eqNullSafe(F.col("__host"))
              & F.col(path).cast("string").eqNullSafe(F.col("__path")))
        joined = rows.join(self.sites, on)
        # The document itself is no evidence about its site.
        host_rate = ((F.col("__hs") - F.col("__p") + F.lit(self.of_host * self.rate))
                     / (F.col("__hn") - 1 + F.lit(self.of_host)))
        site_rate = ((F.col("__s") - F.col("__p") + F.lit(self.of_path) * host_rate)
                     / (F.col("__n") - 1 + F.lit(self.of_path)))
        joined = joined.withColumn("__site", F.least(F.greatest(site_rate, F.lit(1e-4)), F.lit(1 - 1e-4)))

        def logit(q):
            return F.log(q / (F.lit(1.0) - q))

        odds = logit(F.col("__p")) + logit(F.col("__site")) - logit(F.lit(float(self.rate)))
        return joined.withColumn("__score", F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))).drop(*self.sites.columns)


def quality(docs: DataFrame, labels: DataFrame, label: str = "quality", id: str = "doc_id", text: str = "text",
            host: str = "source", path: str = "lang", threshold: float = THRESHOLD,
            sample: int = SAMPLE) -> DataFrame:
    """``(doc_id, p_document, p_site, score, kept)`` of every row; kept if ``score`` is at least ``threshold``.

    ``labels`` holds ``id`` and ``label`` (1 is good) of some documents; null
    labels are ignored, repeated ones count each. If they are not of both
    kinds nothing is rejected (probabilities 0.5). A null or empty text has
    no words and is judged as such; null hosts or paths are a site like others; a null id
    stays null; repeated rows count each; an empty table gives no rows; other
    columns are ignored, whatever their names.
    """
    model = SiteModel(docs, labels, label, id, text, host, path, sample)
    return model.scored(model.features, "host", "path").select(
        "doc_id", F.col("__p").alias("p_document"), F.col("__site").alias("p_site"), F.col("__score").alias("score"),
        (F.col("__score") >= threshold).alias("kept"))


def good_documents(docs: DataFrame, labels: DataFrame, label: str = "quality", id: str = "doc_id",
                   text: str = "text", host: str = "source", path: str = "lang", threshold: float = THRESHOLD,
                   sample: int = SAMPLE) -> DataFrame:
    """The rows that :func:`quality` keeps, with all their columns.

    Every row is judged where it is read (its features are computed again), so no text is shuffled.
    """
    model = SiteModel(docs, labels, label, id, text, host, path, sample)

    def run(batches):
        hashing = RollingHash()
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            rows = [slice_features(hashing, o, d) for _, _, o, d in slices(column)]
            flat = np.concatenate(rows).ravel() if rows else np.zeros(0)
            at = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(FEATURES))
            x = pa.ListArray.from_arrays(at, pa.array(flat))
            yield pa.RecordBatch.from_arrays([*batch.columns, x], [*batch.schema.names, "__x"])

    schema = T.StructType([*docs.schema.fields, T.StructField("__x", T.ArrayType(T.DoubleType()))])
    rows = docs.mapInArrow(run, schema)
    judged = model.scored(rows, host, path, "__x")
    return judged.filter(F.col("__score") >= threshold).select(*docs.columns)

"""Quality classifier by hierarchical empirical Bayes.

Three levels of evidence meet in the log odds of a document being good:

* the document: a logistic model of features of its text gives the evidence
  of the text alone, its log odds less those of the training sample;
* its site (host): the share of good documents among the site's documents,
  estimated over all documents by summing the text-only probabilities;
* its path within the site (``path_cols``), in the same way.

A site's share is shrunk toward the corpus's and a path's toward its site's:
the posterior mean of a Beta prior around the level above, whose strength is
estimated from the spread between the groups (method of moments), so a sparse
group stays near the prior and a large one speaks for itself. The counts are
one grouped aggregation over (site, path) with partial sums, so a site with a
third of all rows is summed in every task; the tables of sites and paths are
joined by a broadcast within ``broadcast_max_rows``, else by shuffle joins.

Bounds: the logistic model is fitted on the features of at most ``max_docs``
labelled documents chosen by a hash of their ids. Shares, spreads and scores
take in every document.

Cases: a null or empty text has the features of an empty text; a null site or
path is a group of its own; null labels do not train; a document labelled
both ways counts as bad; without labels of both classes every document has
the prior's log odds of 0 and is kept; repeated rows are judged and counted
one by one; an empty table gives an empty result; columns of the input named
like the results are kept apart in :func:`keep_good`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandcast.llm.common import Scratch, keep_row, pick, unpack_row
from demandcast.llm.quality_rules import let, words_of
from demandcast.session import broadcast_max_rows

MAX_DOCS = 20_000
THRESHOLD = 0.5
SYMBOLS = "#*$%&|<>!"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LARGEST_STRENGTH = 1e6


def _share(part: Column, whole: Column) -> Column:
    return part.cast("double") / F.greatest(whole, F.lit(1)).cast("double")


def features(text: Column) -> Column:
    """An array of numbers between 0 and about 1 that describe a text."""
    without = lambda chars: F.length(text) - F.length(F.translate(text, chars, ""))
    length, marks, capitals, bars, digits = F.length(text), without(SYMBOLS), without(UPPER), without("|"), without("0123456789")

    def numbers(of_words: Column) -> Column:
        n, distinct, again = of_words["n"], of_words["distinct"], _share(of_words["again"], of_words["n"])
        marked, upper = _share(marks, n), _share(capitals, length)
        return F.array(
            F.least(marked, F.lit(3.0)) / 3.0,
            F.least(marked, F.lit(0.3)) / 0.3,
            upper,
            F.least(upper, F.lit(0.1)) / 0.1,
            _share(distinct, n),
            again,
            F.least(again, F.lit(0.05)) / 0.05,
            F.least(_share(bars, n), F.lit(1.0)),
            F.log1p(n.cast("double")) / 10.0,
            F.least(_share(length, n), F.lit(30.0)) / 30.0,
            _share(digits, length),
        )

    # one pass over the words, then the numbers made from its counts
    def counted(w: Column) -> Column:
        same = F.zip_with(w, F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: a.eqNullSafe(b))
        return F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("distinct"),
                        F.size(F.filter(same, lambda x: x)).alias("again"))

    return let(let(words_of(text), counted), numbers)


@dataclass
class Evidence:
    """Logistic weights of the features, and the sample's log odds."""

    weights: list[float]
    bias: float
    sample_odds: float

    def log_odds(self, values: Column) -> Column:
        terms = [F.get(values, i) * F.lit(w) for i, w in enumerate(self.weights)]
        return sum(terms, F.lit(self.bias))


def train(x: np.ndarray, good: np.ndarray, ridge: float = 1e-2) -> Evidence | None:
    """Ridge logistic regression by Newton steps; None without both classes."""
    if not len(good) or good.min() == good.max():
        return None
    mean, spread = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.concatenate([(x - mean) / spread, np.ones((len(x), 1))], axis=1)
    w = np.zeros(z.shape[1])
    penalty = np.full(z.shape[1], ridge * len(x) / 100)
    penalty[-1] = 0
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hessian, z.T @ (p - good) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    weights = w[:-1] / spread
    share = float(good.mean())
    return Evidence(weights.tolist(), float(w[-1] - weights @ mean), float(np.log(share / (1 - share))))


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Evidence | None:
    known = pick(labels, id_col, label_col).toDF("_id", "_label").filter("_id is not null and _label is not null")
    sample = known.groupBy("_id").agg(F.min("_label").cast("int").alias("_label")).orderBy(F.xxhash64("_id"), "_id").limit(max_docs)
    texts = pick(docs, id_col, text_col).toDF("_id", "_text").join(F.broadcast(sample), "_id")
    seen = texts.select("_id", "_label", features(F.coalesce(F.col("_text").cast("string"), F.lit(""))).alias("x"))
    rows = sorted(tuple(r) for r in seen.groupBy("_id").agg(F.first("_label").alias("y"), F.min("x").alias("x")).collect())
    if not rows:
        return None
    return train(np.array([r[2] for r in rows]), np.array([float(r[1] == 1) for r in rows]))


def _strength(groups: DataFrame, prior: Column) -> Column:
    """Strength of the Beta prior between groups (_n, _good) around ``prior``:
    mean p(1-p) over the variance of the groups' shares beyond chance."""
    share = F.col("_good") / F.col("_n")
    chance = F.sum(prior * (1 - prior))
    spread = F.sum(F.col("_n") * F.pow(share - prior, 2)) - chance  # expected beyond sampling
    between = F.greatest(spread, F.lit(0.0)) / F.greatest(F.sum("_n") - F.count(F.lit(1)), F.lit(1))
    per_unit = F.sum(F.col("_n") * prior * (1 - prior)) / F.sum("_n")
    return F.least(F.coalesce(F.try_divide(per_unit, between), F.lit(LARGEST_STRENGTH)), F.lit(LARGEST_STRENGTH))


def site_posteriors(judged: DataFrame, scratch: Scratch) -> DataFrame:
    """(_site, _path, _n, site_share, path_share) from (_site, _path, _p): the
    posterior mean shares of good documents of each site and path."""
    # probabilities are summed as decimals, so shares do not depend on partitions
    counted = judged.groupBy("_site", "_path").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col("_p").cast("decimal(18,15)")).alias("_sum"))
    paths = scratch.write(counted, "paths")
    sites = scratch.write(paths.groupBy("_site").agg(F.sum("_n").alias("_n"), F.sum("_sum").alias("_sum")), "sites")
    whole = sites.agg((F.sum("_sum").cast("double") / F.sum("_n")).alias("share")).first()["share"]
    paths, sites = (t.withColumn("_good", F.col("_sum").cast("double")).drop("_sum") for t in (paths, sites))
    prior = F.lit(min(max(float(whole if whole is not None else 0.5), 1e-6), 1 - 1e-6))
    k_site = sites.agg(_strength(sites, prior).alias("k")).first()["k"] or LARGEST_STRENGTH
    shrunk = lambda k, above: (F.lit(k) * above + F.col("_good")) / (F.lit(k) + F.col("_n"))
    sites = sites.withColumn("site_share", shrunk(float(k_site), prior))
    both = paths.alias("p").join(sites.alias("s"), F.col("p._site").eqNullSafe(F.col("s._site"))).select("p.*", "s.site_share")
    k_path = both.agg(_strength(both, F.col("site_share")).alias("k")).first()["k"] or LARGEST_STRENGTH
    return scratch.write(both.withColumn("path_share", shrunk(float(k_path), F.col("site_share"))).drop("_good"), "posteriors")


def _judged(packed: DataFrame, evidence: Evidence | None) -> DataFrame:
    values = features(F.coalesce(F.col("_text").cast("string"), F.lit("")))
    if evidence is None:
        return packed.withColumn("_odds", F.lit(0.0)).withColumn("_p", F.lit(0.5))
    odds = packed.withColumn("_x", values).withColumn("_odds", evidence.log_odds(F.col("_x"))).drop("_x")
    return odds.withColumn("_p", 1 / (1 + F.exp(-F.col("_odds"))))


def posterior(docs: DataFrame, labels: DataFrame, scratch: Scratch, max_docs: int = MAX_DOCS, id_col: str = "doc_id", text_col: str = "text",
              site_col: str = "source", path_cols: tuple[str, ...] = ("lang",), with_rows: bool = False) -> DataFrame:
    """Per row of ``docs``: _id, text_probability, site_share, path_share,
    probability (all three levels together), and with ``with_rows`` the whole
    row packed into ``_row``. Texts are read once: their evidence is written
    before sites are summed."""
    evidence = fit(docs, labels, max_docs, id_col, text_col)
    packed = keep_row(docs, id_col, text_col, site_col, *path_cols).toDF("_row", "_id", "_text", "_site", *[f"_path{i}" for i in range(len(path_cols))])
    packed = packed.withColumn("_path", F.struct(*[f"_path{i}" for i in range(len(path_cols))]) if path_cols else F.lit(0))
    packed = packed.select(*(["_row"] if with_rows else []), "_id", "_text", "_site", "_path")
    judged = scratch.write(_judged(packed, evidence).drop("_text"), "judged")
    shares = site_posteriors(judged.select("_site", "_path", "_p"), scratch)
    shares = shares.select(F.col("_site").alias("_s"), F.col("_path").alias("_q"), "site_share", "path_share")
    if shares.count() <= broadcast_max_rows(docs.sparkSession) // 10:
        shares = F.broadcast(shares)
    odds = lambda p: F.log(p / (1 - p))
    bounded = F.greatest(F.least(F.col("path_share"), F.lit(1 - 1e-6)), F.lit(1e-6))
    joined = judged.join(shares, F.col("_site").eqNullSafe(F.col("_s")) & F.col("_path").eqNullSafe(F.col("_q")))
    total = F.col("_odds") - F.lit(evidence.sample_odds if evidence else 0.0) + odds(bounded)
    return joined.select(*(["_row"] if with_rows else []), "_id", F.col("_p").alias("text_probability"), "site_share", "path_share",
                         (1 / (1 + F.exp(-total)) if evidence else F.lit(0.5)).alias("probability"))


def keep_good(docs: DataFrame, labels: DataFrame, scratch: Scratch, threshold: float = THRESHOLD, **names) -> DataFrame:
    """The rows of ``docs`` whose probability of being good reaches the threshold."""
    kept = posterior(docs, labels, scratch, with_rows=True, **names).filter(F.col("probability") >= threshold)
    return unpack_row(kept, docs.columns)

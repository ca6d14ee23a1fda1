"""Isolation-forest anomaly models per log type (M06-M10, A27), all types in one pass.

Training is distributed the Spark way:

* features (M00): one row a log with its numbers and categories as arrays, in
  the feature order of its type;
* encoders (M06): distinct categories per type and feature, indexed in sorted
  order (null or unseen -> 0), kept as a small DataFrame.  They are joined once
  for each category *position* (at most four), whatever the number of types; the
  planner broadcasts them where their size allows;
* scaler (M07): one ``avg`` / ``stddev_pop`` aggregation by type (zero std -> 1);
* sampling (M08): one seeded hash per row picks a Bernoulli sample of about
  ``trees * 256 * 1.5`` rows per type, a second hash deals each sampled row to
  one tree, and each tree keeps its 256 smallest hashes - the trees never see
  the full data;
* growing: ``groupBy(log_type, tree).applyInPandas`` grows one tree per
  group of at most 256 rows with a seeded numpy generator;
* offset: the ``contamination`` quantile of training scores by type via
  ``percentile_approx`` (one pass).

A fit reads the logs twice (categories, encoded rows), however many types there
are; scoring (M09) reads them once.  It broadcasts the node tables - at most
``trees * (2 * 256 - 1)`` rows per type, a bound fixed by construction - and
walks all trees of a type for an Arrow batch at once in ``mapInPandas``.
"""

from __future__ import annotations

import functools
import math
import operator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlens.ml.features import FEATURES, feature_columns
from eventlens.sinks.writers import _drop, _staged, staged, table_exists

N_TREES = 100
SAMPLE_SIZE = 256
CONTAMINATION = 0.1
SEED = 42
PROB_THRESHOLD = 0.8

NODE_SCHEMA = ("log_type string, tree int, node int, feature int, threshold double, "
               "left int, right int, size int")


def _c(n: int) -> float:
    """Average path length of an unsuccessful search in a BST of n items."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def _names(log_type: str, kind: str) -> list[str]:
    return [n for n, k in FEATURES[log_type] if k == kind]


def _by_type(values: dict) -> Column:
    """The value of the row's log type (null for other types)."""
    out = None
    for t, v in values.items():
        hit = F.col("log_type") == t
        out = F.when(hit, v) if out is None else out.when(hit, v)
    return out


# --------------------------------------------------------------------------- preprocessing


def feature_rows(df: DataFrame, types, keep=("event_id",), ts_col: str = "event_time") -> DataFrame:
    """M00 for several log types in one pass: ``keep``, ``log_type``, ``nums``
    and ``cats``, the type's features in their order.  A number that is none
    becomes null; logs of other types have no row."""
    cols = {t: feature_columns(df, t, ts_col) for t in types}
    nums = {t: F.array(*[c[n].try_cast("double") for n in _names(t, "num")]) for t, c in cols.items()}
    cats = {t: F.array(*[c[n].cast("string") for n in _names(t, "cat")]) for t, c in cols.items()}
    return df.where(F.col("log_type").isin(*types)).select(
        *[F.col(k) for k in keep if k in df.columns and k != "log_type"], "log_type",
        _by_type(nums).alias("nums"), _by_type(cats).alias("cats"))


def fit_encoders(rows: DataFrame) -> DataFrame:
    """(log_type, feature, category, code) of feature rows, with codes 0..
    in sorted category order per type and feature."""
    feature = _by_type({t: F.get(F.array(*[F.lit(n) for n in _names(t, "cat")]), F.col("pos")) for t in FEATURES})
    pairs = rows.select("log_type", F.posexplode("cats").alias("pos", "category")).where("category is not null").distinct()
    w = Window.partitionBy("log_type", "pos").orderBy("category")
    return pairs.select("log_type", feature.alias("feature"), "category", (F.row_number().over(w) - 1).cast("int").alias("code"))


def encode(rows: DataFrame, encoders: DataFrame, types) -> DataFrame:
    """Feature rows -> ``x``, the features of the row's type as numbers in
    their order; null and unseen categories -> 0 (as the reference)."""
    out = rows
    for k in range(max(len(_names(t, "cat")) for t in types)):
        here = [(F.col("log_type") == t) & (F.col("feature") == _names(t, "cat")[k]) for t in types if k < len(_names(t, "cat"))]
        e = encoders.where(functools.reduce(operator.or_, here)).select(
            F.col("log_type").alias("_t"), F.col("category").alias("_c"), F.col("code").alias(f"_code{k}"))
        out = out.join(e, (F.col("log_type") == F.col("_t")) & (F.get("cats", F.lit(k)) == F.col("_c")), "left").drop("_t", "_c")

    def value(t, name, kind):
        at = _names(t, kind).index(name)
        return F.get("nums", F.lit(at)) if kind == "num" else F.coalesce(F.col(f"_code{at}"), F.lit(0)).cast("double")
    x = {t: F.array(*[value(t, n, k) for n, k in FEATURES[t]]) for t in types}
    return out.select(*[c for c in rows.columns if c not in ("nums", "cats")], _by_type(x).alias("x"))


def fit_scalers(encoded: DataFrame) -> dict:
    """Per log type the rows, and mean and population std per feature (zero
    std -> 1), one pass.  The result is one row a type, to 12 digits: sums in
    another order of rows then give the same model."""
    at = [(i, F.get("x", F.lit(i))) for i in range(max(len(f) for f in FEATURES.values()))]
    found = encoded.groupBy("log_type").agg(
        F.count("*").alias("n"), *[F.avg(v).alias(f"m{i}") for i, v in at], *[F.stddev_pop(v).alias(f"s{i}") for i, v in at])
    out = {}
    for row in found.collect():
        names = [n for n, _ in FEATURES[row.log_type]]
        out[row.log_type] = {
            "names": names, "n": row.n, "mean": [float(f"{row[f'm{i}'] or 0.0:.12g}") for i in range(len(names))],
            "std": [float(f"{row[f's{i}']:.12g}") if row[f"s{i}"] else 1.0 for i in range(len(names))]}
    return out


def scale(encoded: DataFrame, scalers: dict) -> DataFrame:
    """``x`` in standard scores."""
    return encoded.withColumn("x", _by_type({
        t: F.array(*[(F.get("x", F.lit(i)) - F.lit(m)) / F.lit(d) for i, (m, d) in enumerate(zip(s["mean"], s["std"]))])
        for t, s in scalers.items()}))


# --------------------------------------------------------------------------- tree growing


def _grow_tree(X: np.ndarray, rng: np.random.Generator):
    """Grow one isolation tree; returns node rows (node, feature, threshold,
    left, right, size)."""
    limit = int(math.ceil(math.log2(max(len(X), 2))))
    nodes = []

    def build(idx, depth):
        node_id = len(nodes)
        nodes.append(None)
        sub = X[idx]
        if depth >= limit or len(idx) <= 1:
            nodes[node_id] = (node_id, -1, 0.0, -1, -1, len(idx))
            return node_id
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if usable.size == 0:
            nodes[node_id] = (node_id, -1, 0.0, -1, -1, len(idx))
            return node_id
        f = int(rng.choice(usable))
        thr = float(rng.uniform(lo[f], hi[f]))
        left_idx = idx[sub[:, f] < thr]
        right_idx = idx[sub[:, f] >= thr]
        left = build(left_idx, depth + 1)
        right = build(right_idx, depth + 1)
        nodes[node_id] = (node_id, f, thr, left, right, len(idx))
        return node_id

    build(np.arange(len(X)), 0)
    return nodes


def sample_for_trees(scaled: DataFrame, scalers: dict, n_trees: int = N_TREES,
                     sample_size: int = SAMPLE_SIZE, seed: int = SEED, id_col: str = "event_id") -> DataFrame:
    """Per type and tree at most ``sample_size`` rows (``r`` is their order),
    chosen by seeded hashes.  The window sees the Bernoulli sample alone, and
    Spark limits each group before it is shuffled."""
    want = n_trees * sample_size * 3 // 2
    share = _by_type({t: F.lit(min(2 ** 63 * want // s["n"], 2 ** 63 - 1)) for t, s in scalers.items()})
    picked = scaled.where(F.xxhash64(F.col(id_col), F.lit(seed)).bitwiseAND(F.lit(2 ** 63 - 1)) <= share)
    tree = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed + 1)), F.lit(n_trees)).cast("int")
    picked = picked.withColumn("tree", tree)
    w = Window.partitionBy("log_type", "tree").orderBy(F.xxhash64(F.col(id_col), F.lit(seed + 2)), F.col(id_col))
    return picked.withColumn("r", F.row_number().over(w)).where(F.col("r") <= sample_size).select("log_type", "tree", "r", "x")


def grow_forest(samples: DataFrame, seed: int = SEED) -> DataFrame:
    """One tree per (log_type, tree) group."""
    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng([seed, tree])
        nodes = _grow_tree(np.stack(pdf.sort_values("r")["x"].to_numpy()).astype(float), rng)
        out = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "left", "right", "size"])
        out.insert(0, "tree", tree)
        out.insert(0, "log_type", str(pdf["log_type"].iloc[0]))
        return out
    return samples.groupBy("log_type", "tree").applyInPandas(grow, NODE_SCHEMA)


def _path_lengths(X: np.ndarray, trees: list) -> np.ndarray:
    """Mean path length over all trees for every row of X.  All rows go down a
    tree level by level; at a leaf they stay where they are."""
    total = np.zeros(len(X))
    flat, base = np.ascontiguousarray(X).ravel(), np.arange(len(X)) * X.shape[1]
    for feat, thr, left, right, length, depth in trees:
        node = np.zeros(len(X), dtype=np.int64)
        for _ in range(depth):
            node = np.where(flat[base + feat[node]] < thr[node], left[node], right[node])
        total += length[node]
    return total / max(len(trees), 1)


def _tree_arrays(nodes: pd.DataFrame) -> list:
    """Per tree its features, thresholds and children (a leaf is its own child),
    the path length that ends at each node, and the tree's depth."""
    out = []
    for _, g in nodes.groupby("tree"):
        g = g.sort_values("node")
        feat, left, right = (g[c].to_numpy().astype(np.int64) for c in ("feature", "left", "right"))
        leaf, own, depth = feat < 0, np.arange(len(g)), np.zeros(len(g), np.int64)
        for i in np.flatnonzero(~leaf):  # parents come before their children
            depth[[left[i], right[i]]] = depth[i] + 1
        length = depth + np.array([_c(int(n)) for n in g["size"]])
        out.append((np.where(leaf, 0, feat), g["threshold"].to_numpy(dtype=float), np.where(leaf, own, left),
                    np.where(leaf, own, right), length, int(depth.max())))
    return out


class ForestModel:
    """A fitted model of one log type: encoders (DataFrame, may hold other types
    as well), scaler, node table and score offset."""

    def __init__(self, log_type, encoders, scaler, nodes: pd.DataFrame, sample_size, offset=None):
        self.log_type, self.encoders, self.scaler = log_type, encoders, scaler
        self.nodes, self.sample_size, self.offset = nodes, sample_size, offset

    def score(self, df: DataFrame, keep=("event_id",), threshold: float = PROB_THRESHOLD) -> DataFrame:
        """M09 for the rows of this model's type, as :func:`score_all`."""
        return score_all(df, {self.log_type: self}, keep, threshold)


def _raw_scores(scaled: DataFrame, models: dict) -> DataFrame:
    """Scaled rows -> their other columns and ``score_samples``."""
    walk = scaled.sparkSession.sparkContext.broadcast(
        {t: (_tree_arrays(m.nodes), _c(m.sample_size)) for t, m in models.items()})
    keep = [c for c in scaled.columns if c != "x"]

    def score(batches):
        for pdf in batches:
            out, raw = pdf[keep].copy(), np.zeros(len(pdf))
            kinds = pdf["log_type"].to_numpy()
            for t in set(kinds):
                trees, expected = walk.value[t]
                at = np.flatnonzero(kinds == t)
                X = np.stack(pdf["x"].to_numpy()[at]).astype(float)
                raw[at] = -np.power(2.0, -_path_lengths(X, trees) / expected)
            out["score_samples"] = raw
            yield out
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in scaled.schema.fields if f.name != "x")
    return scaled.mapInPandas(score, schema + ", score_samples double")


def fit_forests(df: DataFrame, types=tuple(FEATURES), n_trees: int = N_TREES, sample_size: int = SAMPLE_SIZE,
                contamination: float = CONTAMINATION, seed: int = SEED, id_col: str = "event_id") -> dict:
    """The models of several log types, fitted together on ``df``; a type
    without rows has no model."""
    rows = feature_rows(df, types, keep=(id_col,))
    encoders = staged(fit_encoders(rows), "encoders")
    # written once: the scalers, the sample and the offsets read these columns, not the logs
    enc, stage = _staged(encode(rows, encoders, types), "encoded")
    scalers = fit_scalers(enc)
    if not scalers:
        _drop(df.sparkSession, stage)
        return {}
    scaled = scale(enc, scalers)
    samples = sample_for_trees(scaled, scalers, n_trees, sample_size, seed, id_col)
    nodes = grow_forest(samples, seed).toPandas()   # bounded: types x trees x (2 x 256 - 1)
    nodes = nodes.sort_values(["log_type", "tree", "node"])
    models = {t: ForestModel(t, encoders, s, nodes[nodes["log_type"] == t].reset_index(drop=True), sample_size)
              for t, s in scalers.items()}
    cut = F.percentile_approx("score_samples", contamination, 10000)
    for row in _raw_scores(scaled, models).groupBy("log_type").agg(cut.alias("offset")).collect():
        models[row.log_type].offset = float(row.offset)
    _drop(df.sparkSession, stage)
    return models


def fit_forest(df: DataFrame, log_type: str, n_trees: int = N_TREES, sample_size: int = SAMPLE_SIZE,
               contamination: float = CONTAMINATION, seed: int = SEED, id_col: str = "event_id") -> ForestModel:
    """Fit one log type's model on ``df`` (rows of all types allowed)."""
    models = fit_forests(df, (log_type,), n_trees, sample_size, contamination, seed, id_col)
    if not models:
        raise ValueError(f"no {log_type} logs to fit a model on")
    return models[log_type]


def save_model(model: ForestModel, path: str) -> None:
    """Nodes, encoders and scaler as Parquet under ``path/log_type``."""
    spark = model.encoders.sparkSession
    base = f"{path.rstrip('/')}/{model.log_type}"
    spark.createDataFrame(model.nodes).write.mode("overwrite").parquet(f"{base}/nodes")
    own = model.encoders.where(F.col("log_type") == model.log_type)
    own.select("feature", "category", "code").write.mode("overwrite").parquet(f"{base}/encoders")
    meta = pd.DataFrame({"name": model.scaler["names"], "mean": model.scaler["mean"], "std": model.scaler["std"]})
    meta["offset"] = model.offset
    meta["sample_size"] = model.sample_size
    spark.createDataFrame(meta).write.mode("overwrite").parquet(f"{base}/scaler")


def load_model(spark, path: str, log_type: str) -> ForestModel | None:
    """Missing model -> None (no score), as the reference."""
    base = f"{path.rstrip('/')}/{log_type}"
    if not table_exists(spark, f"{base}/scaler"):  # written last
        return None
    nodes = spark.read.parquet(f"{base}/nodes").toPandas()
    encoders = spark.read.parquet(f"{base}/encoders").withColumn("log_type", F.lit(log_type))
    meta = spark.read.parquet(f"{base}/scaler").toPandas()
    order = {n: i for i, (n, _) in enumerate(FEATURES[log_type])}
    meta = meta.sort_values("name", key=lambda s: s.map(order))
    scaler = {"names": meta["name"].tolist(), "mean": meta["mean"].tolist(), "std": meta["std"].tolist()}
    return ForestModel(log_type, encoders, scaler, nodes, int(meta["sample_size"].iloc[0]),
                       float(meta["offset"].iloc[0]))


def score_all(df: DataFrame, models: dict, keep=("event_id",), threshold: float = PROB_THRESHOLD) -> DataFrame:
    """One pass over ``df`` scores every log type that has a model:
    decision value, probability ``clip((0.5 - d) / 0.5)`` and the flag ``d < 0
    or probability > threshold`` (ruling C8: reproduced).  Types without a model
    get no rows (without any model: an error, so that detection never stops
    silently)."""
    models = {t: m for t, m in models.items() if m is not None}
    if not models:
        raise ValueError("no fitted model to score with")
    types = list(models)
    tables = list({id(m.encoders): m.encoders for m in models.values()}.values())  # models of one fit share theirs
    encoders = functools.reduce(DataFrame.unionByName, tables)
    rows = encode(feature_rows(df, types, keep), encoders, types)
    raw = _raw_scores(scale(rows, {t: m.scaler for t, m in models.items()}), models)
    d = F.col("score_samples") - _by_type({t: F.lit(m.offset) for t, m in models.items()})
    prob = F.least(F.greatest((F.lit(0.5) - d) / F.lit(0.5), F.lit(0.0)), F.lit(1.0))
    return raw.select(*[k for k in keep if k in raw.columns and k != "log_type"], "log_type", d.alias("decision"),
                      prob.alias("anomaly_score"), ((d < 0) | (prob > threshold)).alias("is_anomaly_pred"))

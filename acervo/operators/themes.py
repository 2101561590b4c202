"""Macro themes: unit vectors, one reduction, bisecting k-means, noise and merge rules.

The result is a set of at most `max_themes` groups; labels are not meant to
equal those of a density clustering.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.feature import PCA, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acervo import params as P
from acervo.session import cut_lineage

# merge_labels compares all pairs of groups on the driver
MAX_FINE_CLUSTERS = 500
# centroids that travel to the tasks as one matrix
MAX_CENTERS = 100_000


def unit_vectors(df: DataFrame, vector: str, out: str = "unit") -> DataFrame:
    wide = df.withColumn("_v", array_to_vector(F.col(vector)))
    return Normalizer(inputCol="_v", outputCol=out, p=2.0).transform(wide).drop("_v")


def centroids(df: DataFrame, label: str, vector: str) -> DataFrame:
    """Mean vector and size per label, combined on the map side."""
    return df.groupBy(label).agg(
        Summarizer.mean(F.col(vector)).alias("centroid"), F.count("*").alias("size"))


def merge_labels(points: np.ndarray, keep: int) -> list[int]:
    """Average linkage on cosine distance over a bounded number of centroids."""
    unit = points / np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-12)
    distance = 1.0 - unit @ unit.T
    groups = [[i] for i in range(len(points))]
    while len(groups) > keep:
        best = min(
            ((distance[np.ix_(a, b)].mean(), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j))
        _, i, j = best
        groups[i] += groups.pop(j)
    labels = [0] * len(points)
    for n, group in enumerate(groups):
        for i in group:
            labels[i] = n
    return labels


def nearest_centroid(df: DataFrame, vector: str, centers: list[tuple[int, list[float]]], out: str) -> DataFrame:
    """Label of the nearest centroid, the smallest of equally near ones; the centroids are one matrix in each task."""
    if len(centers) > MAX_CENTERS:
        raise ValueError(f"{len(centers)} centroids; at most {MAX_CENTERS} travel to a task")
    ordered = sorted(centers, key=lambda c: c[0])
    labels = np.array([label for label, _ in ordered], dtype="int64")
    matrix = np.array([c for _, c in ordered], dtype="float64").reshape(len(ordered), -1)
    sent = df.sparkSession.sparkContext.broadcast((labels, matrix))

    @F.pandas_udf("bigint")
    def nearest(vectors: pd.Series) -> pd.Series:
        labels, matrix = sent.value
        if not len(vectors) or not len(labels):
            return pd.Series([None] * len(vectors), dtype="Int64")
        rows = np.stack(vectors.to_numpy())
        step = max(1, 4_000_000 // max(1, matrix.size))
        near = [((rows[i:i + step, None, :] - matrix[None]) ** 2).sum(axis=2).argmin(axis=1) for i in range(0, len(rows), step)]
        return pd.Series(labels[np.concatenate(near)])

    return df.withColumn(out, nearest(vector_to_array(F.col(vector))))


def macro_themes(df: DataFrame, key: str, vector: str, components: int | None = None, fine: int = 20,
                 min_size: int = 5, max_themes: int = P.MACRO_THEMES, seed: int = P.MACRO_SEED) -> DataFrame:
    """(key, theme). `components` defaults to the smallest of 256, the rows and the features."""
    if fine > MAX_FINE_CLUSTERS:
        raise ValueError(f"fine is {fine}; at most {MAX_FINE_CLUSTERS} groups are merged on the driver")
    unit = unit_vectors(df.select(key, vector), vector)
    if components is None:
        shape = unit.agg(F.count("*").alias("rows"), F.max(F.size(vector)).alias("features")).first()
        components = max(1, min(256, shape["rows"], shape["features"] or 1))
    # the clustering passes over the reduced vectors many times
    reduced = cut_lineage(PCA(k=components, inputCol="unit", outputCol="reduced").fit(unit).transform(unit).select(key, "reduced"))
    model = BisectingKMeans(k=fine, seed=seed, featuresCol="reduced", predictionCol="fine").fit(reduced)
    labelled = model.transform(reduced)
    # at most MAX_FINE_CLUSTERS rows reach the driver
    stats = sorted(centroids(labelled, "fine", "reduced").collect(), key=lambda r: r["fine"])
    solid = [r for r in stats if r["size"] >= min_size] or stats
    centers = np.array([r["centroid"].toArray() for r in solid])
    merged = merge_labels(centers, max_themes) if len(solid) > max_themes else list(range(len(solid)))
    theme_of = {int(r["fine"]): int(t) for r, t in zip(solid, merged)}
    noise = [int(r["fine"]) for r in stats if int(r["fine"]) not in theme_of]
    table = F.create_map(*[F.lit(x) for pair in theme_of.items() for x in pair])
    placed = labelled.withColumn("theme", F.try_element_at(table, F.col("fine")))
    if noise:
        nearest = nearest_centroid(
            placed.filter("theme is null"), "reduced",
            [(theme_of[int(r["fine"])], list(c)) for r, c in zip(solid, centers)], "near")
        placed = placed.filter("theme is not null").select(key, "theme").unionByName(
            nearest.select(key, F.col("near").alias("theme")))
    return placed.select(key, F.col("theme").cast("int").alias("theme"))

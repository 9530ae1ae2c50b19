"""Principal components of offer vectors and of centroids.

A row without a vector counts for no basis and has no components; a table without
vectors has no basis, which is an error.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerscope.functions import vectors as V
from offerscope.operators.groups import largest_groups
from offerscope.session import materialize

VARIANCE_KEPT = 0.90


@dataclass
class Components:
    """A fitted basis: centring and projection, signs, variance shares."""

    model: PipelineModel
    signs: list[float]
    explained: list[float]

    def enough_for(self, share: float = VARIANCE_KEPT) -> int:
        """Smallest number of components whose shares add up to ``share``."""
        return int(np.searchsorted(np.cumsum(self.explained), share) + 1)


def fit_components(df: DataFrame, vector_col: str) -> Components:
    """One fit with all components. Spark projects without centring, so the
    vectors are centred first. A component's largest loading is positive."""
    known = df.filter(F.col(vector_col).isNotNull())
    vectors = known.select(array_to_vector(V.as_doubles(F.col(vector_col))).alias("_vector"))
    one = vectors.first()
    if one is None:
        raise ValueError(f"no vectors in {vector_col}")
    dims = one["_vector"].size
    centre = StandardScaler(inputCol="_vector", outputCol="_centred", withMean=True, withStd=False)
    rotate = PCA(k=dims, inputCol="_centred", outputCol="_rotated")
    model = Pipeline(stages=[centre, rotate]).fit(vectors)
    loadings = model.stages[-1].pc.toArray()
    largest = loadings[np.abs(loadings).argmax(axis=0), range(dims)]
    return Components(
        model=model,
        signs=[1.0 if x >= 0 else -1.0 for x in largest],
        explained=[float(x) for x in model.stages[-1].explainedVariance],
    )


def project(
    df: DataFrame,
    vector_col: str,
    basis: Components,
    k: int,
    out_col: str,
    out_type: str = "array<float>",
) -> DataFrame:
    """Adds the first ``k`` components."""
    filled = F.coalesce(V.as_doubles(F.col(vector_col)), V.literal_vector([0.0] * len(basis.signs)))
    rotated = basis.model.transform(df.withColumn("_vector", array_to_vector(filled)))
    signed = F.zip_with(
        F.slice(vector_to_array("_rotated"), 1, k),
        V.literal_vector(basis.signs[:k]),
        lambda x, sign: x * sign,
    )
    signed = F.when(F.col(vector_col).isNotNull(), signed)
    return rotated.withColumn(out_col, signed.cast(out_type)).drop(
        "_vector", "_centred", "_rotated"
    )


def reduce_vectors(
    df: DataFrame, vector_col: str, share: float = VARIANCE_KEPT, out_col: str = "embedding_pca"
) -> DataFrame:
    """Adds the components that keep ``share`` of the variance, as ``array<float>``."""
    basis = fit_components(df, vector_col)
    return project(df, vector_col, basis, basis.enough_for(share), out_col)


def explained_variance(df: DataFrame, vector_col: str, share: float = VARIANCE_KEPT) -> DataFrame:
    """``component, explained, cumulative, kept``: one row per dimension."""
    basis = fit_components(df, vector_col)
    kept = basis.enough_for(share)
    rows = [
        (i, e, float(c), i <= kept)
        for i, (e, c) in enumerate(zip(basis.explained, np.cumsum(basis.explained)), 1)
    ]
    return df.sparkSession.createDataFrame(
        rows, "component int, explained double, cumulative double, kept boolean"
    )


def centroid_map(centroid_table: DataFrame, key_col: str, labelled: int = 30) -> DataFrame:
    """Two coordinates per centroid; the largest groups are flagged."""
    centroid_table = materialize(centroid_table, "centroids")
    basis = fit_components(centroid_table, "centroid")
    placed = project(centroid_table, "centroid", basis, 2, "_xy", "array<double>")
    largest = largest_groups(centroid_table, key_col, "n_offers", labelled).select(
        key_col, F.lit(True).alias("_large")
    )
    return placed.join(F.broadcast(largest), key_col, "left").select(
        key_col,
        "n_offers",
        F.col("_xy")[0].alias("x"),
        F.col("_xy")[1].alias("y"),
        F.coalesce("_large", F.lit(False)).alias("labelled"),
    )

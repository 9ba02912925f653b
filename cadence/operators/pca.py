"""PCA embeddings of the full feature matrix.

The matrix is standardised again (population stddev, constant column -> 0), so its
Gram matrix over n is the correlation matrix. Tasks add up blocked outer products
``Z_b^T Z_b`` with a compensated sum, Spark adds the tasks' cells, and the driver
decomposes one d x d matrix. Each component's sign is fixed so that its
largest-magnitude loading is positive, which makes the embedding reproducible.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.operators.features import ID_COLUMNS, zscore_columns
from cadence.session import cut_lineage


@dataclass
class PcaModel:
    """``loadings`` d x k, ``eigenvalues`` of all d components, falling."""

    features: list[str]
    loadings: np.ndarray
    eigenvalues: np.ndarray


def standardized(matrix: DataFrame) -> tuple[DataFrame, list[str]]:
    feats = [c for c in matrix.columns if c not in ID_COLUMNS]
    ids = [c for c in ID_COLUMNS if c in matrix.columns]
    return matrix.select(*ids, *zscore_columns(matrix, feats)), feats


def _vectors(z: DataFrame, feats: list[str]) -> DataFrame:
    ids = [c for c in ID_COLUMNS if c in z.columns]
    return z.select(*ids, F.array(*[F.col(f"`{c}`") for c in feats]).alias("z"))


def gram(vectors: DataFrame, dim: int) -> np.ndarray:
    """Sum of the outer products of ``z`` over all rows (rows with NULLs left out)."""
    def partial(batches):
        import numpy as np
        import pyarrow as pa
        total, lost = np.zeros((dim, dim)), np.zeros((dim, dim))
        for batch in batches:
            if not batch.num_rows:
                continue
            block = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            block = block[~np.isnan(block).any(axis=1)]
            term = block.T @ block - lost
            added = total + term
            lost = (added - total) - term
            total = added
        i, j = np.triu_indices(dim)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j]), pa.array(-lost[i, j])],
            names=["i", "j", "total", "lost"])

    cells = vectors.select("z").mapInArrow(partial, "i int, j int, total double, lost double")
    out = np.zeros((dim, dim))
    for r in cells.groupBy("i", "j").agg((F.sum("total") + F.sum("lost")).alias("x")).collect():  # d (d + 1) / 2 cells
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["x"]
    return out


def fit_pca(matrix: DataFrame, n_components: int = 32) -> tuple[PcaModel, DataFrame]:
    """The model, and the stored standardised rows (ids, z)."""
    z, feats = standardized(matrix)
    vectors = cut_lineage(_vectors(z, feats))
    n, d = vectors.count(), len(feats)
    values, loadings = np.linalg.eigh(gram(vectors, d) / max(1, n))
    order = np.argsort(-values, kind="stable")
    values, loadings = np.maximum(values[order], 0.0), loadings[:, order]
    largest = loadings[np.abs(loadings).argmax(axis=0), np.arange(d)]
    loadings = loadings * np.where(largest < 0, -1.0, 1.0)
    return PcaModel(feats, loadings[:, :min(n_components, d)], values), vectors


def pca_embeddings(matrix: DataFrame, n_components: int = 32) -> DataFrame:
    """(track_id, track_idx, embedding ARRAY<DOUBLE>) with fixed signs."""
    model, vectors = fit_pca(matrix, n_components)
    loadings, ids = model.loadings, [c for c in vectors.columns if c != "z"]

    def project(batches):
        import pyarrow as pa
        for batch in batches:
            rows = batch.column(len(ids)).flatten().to_numpy(zero_copy_only=False).reshape(-1, loadings.shape[0]) @ loadings
            offsets = pa.array(range(0, rows.size + 1, rows.shape[1]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(ids)], pa.ListArray.from_arrays(offsets, pa.array(rows.ravel()))],
                names=[*ids, "embedding"])

    kinds = ", ".join(f"{c} {vectors.schema[c].dataType.simpleString()}" for c in ids)
    return vectors.mapInArrow(project, f"{kinds}, embedding array<double>")


def explained_variance(matrix: DataFrame, n_components: int = 32) -> DataFrame:
    """(component, explained_variance_ratio) of the fitted PCA."""
    model, _ = fit_pca(matrix, n_components)
    total = float(model.eigenvalues.sum()) or 1.0
    rows = [(j, float(v) / total) for j, v in enumerate(model.eigenvalues[:model.loadings.shape[1]])]
    return matrix.sparkSession.createDataFrame(rows, "component int, explained_variance_ratio double")


def eigenvalue_sums(matrix: DataFrame) -> DataFrame:
    """(n_components, total, squares): the eigenvalues' sum is the number of
    columns that vary, their squares' sum the squared Frobenius norm of the
    correlation matrix."""
    model, _ = fit_pca(matrix, len(matrix.columns))
    v = model.eigenvalues
    return matrix.sparkSession.createDataFrame(
        [(len(v), round(float(v.sum()), 6), round(float((v * v).sum()), 6))],
        "n_components int, total double, squares double")


def squared_norms(matrix: DataFrame) -> DataFrame:
    """(track_id, track_idx, squared_norm) of the embedding by all components: a
    rotation keeps the squared norms of the standardised rows."""
    ids = [c for c in ID_COLUMNS if c in matrix.columns]
    return pca_embeddings(matrix, len(matrix.columns)).select(
        *ids, F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x * x).alias("squared_norm"))


def total_variance(matrix: DataFrame) -> DataFrame:
    """Scalar property: after standardising, every non-constant column has
    variance 1, so the total variance equals their count."""
    z, feats = standardized(matrix)
    row = z.agg(*[F.var_pop(c).alias(c) for c in feats])
    tot = None
    for c in feats:
        tot = F.col(c) if tot is None else tot + F.col(c)
    return row.select(F.lit(len(feats)).alias("n_features"), F.round(tot, 6).alias("total_variance"))

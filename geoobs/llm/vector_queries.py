"""Queries of the vector operators over the whole ``embeddings`` table."""

from __future__ import annotations

from . import neighbours, vector_dedup
from .common import table
from .registry import query


@query("op3_vector_dedup")
def op3_vector_dedup(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vector_dedup.near_vectors(vectors, "vec_id", "embedding", similar=0.9)


@query("op5_nn_descent")
def op5_nn_descent(spark, sf_dir):
    """Ten nearest vectors of every id divisible by 100, among all rows."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    asked = vectors.filter("vec_id % 100 = 0")
    return neighbours.nearest_neighbours(vectors, asked, "vec_id", "embedding", top=10)

"""End to end: raw places to clusters, with four deliberate materialisations."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.functions.cleaning import embedding_text
from loomwork.operators import clustering, features, pairs, places, scoring
from loomwork.session import cut

#: Columns that all must agree in exact duplicates.
KEYS = ["supplier", "sourceNames", "brands", "houseNumber", "streets", "cities", "postalCode", "rawCategories", "insertedCategories", "preemptiveCategories", "latitude", "longitude", "phoneNumbers", "internet", "email"]


Encoder = Callable[[DataFrame, Column], DataFrame]


def resolve(
    raw: DataFrame,
    k: int = 30,
    threshold: float = 0.9,
    categories: DataFrame | None = None,
    sub_categories: DataFrame | None = None,
    related: Iterable[Iterable[str]] = (),
    encoder: Encoder = features.hashed_embedding,
    name_encoder: Encoder | None = None,
    models: dict[str, list[dict]] | None = None,
) -> dict[str, DataFrame]:
    """Cleaned places, candidates, scores and clusters of a raw table; exact duplicates share a cluster.

    ``categories``/``sub_categories``: maps of raw categories; ``related``: groups of categories;
    ``encoder`` turns a table and a text column into Id and a unit vector for the nearest
    neighbours, ``name_encoder`` (by default the same) names alone for the similarity
    feature; ``models``: saved ensembles in place of the rules.
    """
    raw = places.drop_zero_coordinates(raw)
    groups = places.exact_duplicates(raw, KEYS)
    cleaned = cut(places.clean_places(places.explode_places(places.exact_dedup(raw, KEYS)), categories, sub_categories))
    vectors = encoder(cleaned, embedding_text(*[F.col(c) for c in ("sourceNames", "category", "houseNumber", "streets", "cities", "postalCode") if c in cleaned.columns]))
    near = pairs.knn_pairs(pairs.knn(vectors, k, "Id", "vector"))
    candidates = cut(pairs.combine_blocks([near, pairs.block_house(cleaned), pairs.block_phone(cleaned), pairs.block_name(cleaned)], cleaned))
    names = (name_encoder or encoder)(cleaned, F.col("sourceNames"))
    table = features.add_similarity(features.pair_features(candidates, cleaned, related=related), names)
    scored = cut(scoring.ensemble(table, scoring.saved_folds(models) if models else scoring.rule_folds()))
    clusters = clustering.name_clusters(clustering.agglomerate(clustering.best_pairs(scored), link=threshold, group=threshold))
    named = clustering.readd_duplicates(clustering.add_singletons(clusters, cleaned), groups)
    return {"places": cleaned, "candidates": candidates, "scores": scored, "clusters": named}

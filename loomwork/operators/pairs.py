"""Candidate pairs: in-group pairs, blocks, nearest neighbours, enrichment, set operations on pairs."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomwork.functions.cleaning import cell
from loomwork.functions.kernels import udfs
from loomwork.functions.similarity import haversine
from loomwork.session import cut

IDS = ["ltable_id", "rtable_id"]


def canonical(df: DataFrame, a: str, b: str) -> DataFrame:
    """``a`` and ``b`` swapped where a > b."""
    return df.withColumns({a: F.least(a, b), b: F.greatest(a, b)})


def pairs_in_groups(df: DataFrame, keys: list[str], id_col: str, columns: Iterable[str] = (), tile: int = 2_048) -> DataFrame:
    """Distinct unordered pairs of different ids that share all keys; the result itself is what grows with groups.

    ``columns`` of both ends come along with suffixes 1 and 2, so that nothing need be joined
    to the pairs; a row's columns must then go by its id. Rows, not pairs, are shuffled: only pairs
    of two ids that each lie in several groups can come twice and are made distinct. A large
    group is cut into tiles of some ``tile`` rows of one end by as many tasks.

    Without ``columns`` pairs come in an order that takes little room when written (``_runs``).
    """
    columns = list(columns)
    rows = df.dropna(subset=keys).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(id_col).alias("_id"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(columns)]).where("_id is not null")
    on = [f"_k{i}" for i in range(len(keys))]
    rows = rows.dropDuplicates([*on, "_id"]).withColumn("_many", F.count("*").over(W.partitionBy("_id")) > 1)
    sizes = rows.groupBy(*on).agg(F.ceil(F.count("*") / tile).cast("int").alias("_tiles")).where("_tiles > 0")
    rows = rows.join(sizes, on)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    side = lambda n, end, at: rows.select(*on, at.alias("_tile"), F.col("_id").alias(end), F.col("_many").alias(f"_many{n}"), *[F.col(f"_c{i}").alias(f"{c}{n}") for i, c in enumerate(columns)]).repartition(parts, *on, "_tile")
    own, every = F.pmod(F.xxhash64("_id"), F.col("_tiles")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1))
    if columns:
        both = side(1, "ltable_id", own).join(side(2, "rtable_id", every).hint("merge"), [*on, "_tile"])
    else:
        both = _runs(rows, on, own, every, parts)
    both = both.where("ltable_id < rtable_id")
    out = [*IDS, *[f"{c}{n}" for n in (1, 2) for c in columns]]
    again = both.where("_many1 and _many2").select(*out).dropDuplicates(IDS)
    return both.where("not (_many1 and _many2)").select(*out).unionByName(again)


def _runs(rows: DataFrame, on: list[str], own: Column, every: Column, parts: int, chunk: int = 32, block: int = 256) -> DataFrame:
    """Left ids in turn, each with one and the same ``block`` of right ids in order: a run of one value beside a sequence
    that comes again, of which a dictionary, run lengths and compression leave little.

    Each tile's ids are gathered into an array, and chunks of it meet the blocks of every tile.
    A join holds what one of its left rows gives until it is through with it, a chunk times
    a tile of pairs, so chunks are short.
    """
    part = lambda n: F.explode(F.transform(F.sequence(F.lit(1), F.size("_ids"), F.lit(n)), lambda at: F.slice("_ids", at, n)))
    tiles = rows.groupBy(*on, "_tiles", own.alias("_tile"), "_many").agg(F.sort_array(F.collect_list("_id")).alias("_ids"))
    some = tiles.select(*on, "_tiles", F.col("_many").alias("_many1"), part(chunk).alias("_some")).withColumn("_tile", every).repartition(parts, *on, "_tile")
    ends = tiles.select(*on, "_tile", F.col("_many").alias("_many2"), part(block).alias("_block")).repartition(parts, *on, "_tile")
    met = some.join(ends.hint("merge"), [*on, "_tile"]).where(F.element_at("_some", 1) < F.element_at("_block", -1))
    ones = met.select("_many1", "_many2", "_block", F.explode("_some").alias("ltable_id")).where(F.col("ltable_id") < F.element_at("_block", -1))
    return ones.select("_many1", "_many2", "ltable_id", F.explode("_block").alias("rtable_id"))


def tiles_in_groups(rows: DataFrame, on: list[str], groups: dict[str, list[str]], tile: int = 1_024, most: int = 64) -> DataFrame:
    """Every tile of a group beside every tile of the same group, itself included: what is left to do to have all pairs.

    ``rows`` have keys ``on``, ``_id`` and columns that go by it. A tile is an array ``rows`` of all columns that no
    group has and, under each group's name, the place of its values in ``values_`` and that name, an array that holds
    each combination of values once. A tile has some ``tile`` rows; a first one with more than ``most`` values of a
    group is cut into parts of ``most`` rows, so that values of two tiles have few combinations.
    Suffixes 1 and 2 tell the tiles apart.
    """
    others = [c for c in rows.columns if c not in {*on, *(c for cols in groups.values() for c in cols)}]
    sizes = rows.groupBy(*on).agg(F.ceil(F.count("*") / tile).cast("int").alias("_tiles"))
    rows = rows.join(sizes, on).withColumn("_tile", F.pmod(F.xxhash64("_id"), F.col("_tiles")).cast("int"))
    whole = F.struct(*[F.struct(*cols).alias(g) for g, cols in groups.items()], "_id", *[c for c in others if c != "_id"])
    tiles = rows.groupBy(*on, "_tiles", "_tile").agg(F.sort_array(F.collect_list(whole)).alias("_all"))
    values = lambda g: F.array_distinct(F.transform("_all", lambda r: r[g]))
    room = F.when(F.greatest(F.lit(0), *[F.size(values(g)) for g in groups]) > most, most).otherwise(F.size("_all"))
    part = F.explode(F.transform(F.sequence(F.lit(1), F.size("_all"), F.col("_room")), lambda at: F.slice("_all", at, F.col("_room"))))
    row = lambda r: F.struct(*[r[c].alias(c) for c in others], *[(F.array_position(F.col(f"values_{g}"), r[g]) - 1).cast("int").alias(g) for g in groups])
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def side(tiles: DataFrame, n: int) -> DataFrame:
        coded = tiles.select(*on, "_tile", "_all", *[values(g).alias(f"values_{g}") for g in groups])
        return coded.select(*on, "_tile", F.transform("_all", row).alias(f"rows{n}"), *[F.col(f"values_{g}").alias(f"values_{g}{n}") for g in groups])

    left = tiles.select(*on, "_tiles", "_all", room.alias("_room")).select(*on, F.col("_tiles").alias("_tile"), part.alias("_all"))
    left = side(left, 1).withColumn("_tile", F.explode(F.sequence(F.lit(0), F.col("_tile") - 1)))
    return left.repartition(parts, *on, "_tile").join(side(tiles, 2).repartition(parts, *on, "_tile").hint("merge"), [*on, "_tile"]).drop(*on, "_tile")


def keyed_rows(df: DataFrame, keys: list[str], id_col: str, columns: Iterable[str]) -> DataFrame:
    """One row for each id of a group, with keys ``_k0`` and on, ``_id``, ``columns``, and ``_many``: whether the id lies in several groups."""
    on = [f"_k{i}" for i in range(len(keys))]
    rows = df.dropna(subset=keys).select(*[F.col(k).alias(o) for k, o in zip(keys, on, strict=True)], F.col(id_col).alias("_id"), *columns).where("_id is not null")
    rows = rows.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_id").withColumn("_n", F.row_number().over(W.partitionBy("_id", *on).orderBy("_id")))
    return rows.where("_n = 1").drop("_n").withColumn("_many", F.count("*").over(W.partitionBy("_id")) > 1)


def pairs_in_any_groups(df: DataFrame, key_sets: list[list[str]], id_col: str, columns: Iterable[str] = ()) -> DataFrame:
    """Pairs of ids that share all keys of at least one set, each once: with the first set that they share.

    Every id must have one row, as the sets before are compared by the pair's own columns.
    """
    columns, out = list(columns), None
    for i, keys in enumerate(key_sets):
        before = list(dict.fromkeys(k for ks in key_sets[:i] for k in ks))
        found = pairs_in_groups(df, keys, id_col, list(dict.fromkeys([*columns, *before])))
        for ks in key_sets[:i]:
            same = F.lit(True)
            for k in ks:
                same = same & (F.col(f"{k}1") == F.col(f"{k}2"))
            found = found.where(~F.coalesce(same, F.lit(False)))
        found = found.select(*IDS, *[f"{c}{n}" for n in (1, 2) for c in columns])
        out = found if out is None else out.unionByName(found)
    return out


def stars_in_groups(df: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """An edge from the least id of each group to every other one: connects what all its pairs do, with one edge a row."""
    rows = df.dropna(subset=keys).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(id_col).alias("rtable_id"))
    least = rows.groupBy(*[f"_k{i}" for i in range(len(keys))]).agg(F.min("rtable_id").alias("ltable_id"))
    return rows.join(least, [f"_k{i}" for i in range(len(keys))]).where("ltable_id < rtable_id").select(*IDS)


def enrich(pairs: DataFrame, attrs: DataFrame, columns: list[str], id_col: str = "Id", left: str = "ltable_id", right: str = "rtable_id") -> DataFrame:
    """Attributes of both ends with suffixes 1 and 2, null where an id is unknown."""
    for end, n in ((left, 1), (right, 2)):
        side = attrs.select(F.col(id_col).alias(end), *[F.col(c).alias(f"{c}{n}") for c in columns])
        pairs = pairs.join(side, end, "left")
    return pairs


def different_places(pairs: DataFrame, places: DataFrame) -> DataFrame:
    return enrich(pairs, places, ["placeId"]).where("placeId1 <> placeId2").select(*IDS, "placeId1", "placeId2")


def within_km(pairs: DataFrame, places: DataFrame, km: float = 1.0) -> DataFrame:
    far = haversine(F.col("latitude1"), F.col("longitude1"), F.col("latitude2"), F.col("longitude2"))
    return enrich(pairs, places, ["latitude", "longitude"]).where(far <= km).select(*IDS)


def _cells(df: DataFrame, lat: int, lon: int) -> DataFrame:
    return df.withColumns({"cy": cell(F.col("latitude"), lat), "cx": cell(F.col("longitude"), lon)})


def _grid(df: DataFrame, lat: int, lon: int) -> DataFrame:
    return _cells(df, lat, lon).where("cy is not null and cx is not null")


def _ranked(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``df`` with ``_r``, the place from 1 of each row among those of its keys, in order.

    Rows are dealt to ranges of (keys, order), so a crowded key is spread over many tasks;
    each ranks its own part, shifted by the rows of the same key in the parts before.
    ``order`` must tell rows apart.
    """
    parts = cut(df.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id()))
    before = F.sum("n").over(W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    shift = parts.groupBy(*keys, "_part").agg(F.count("*").alias("n")).select(*keys, "_part", F.coalesce(before, F.lit(0)).alias("_before"))
    within = parts.withColumn("_r", F.row_number().over(W.partitionBy(*keys, "_part").orderBy(*order)))
    return within.join(shift, [*keys, "_part"]).withColumn("_r", (F.col("_r") + F.col("_before")).cast("long")).drop("_part", "_before")


def _window_join(df: DataFrame, keys: list[str], order: list[str], reach: int, condition: Column | None = None, columns: list[str] | None = None) -> DataFrame:
    """Pairs of rows of one key at most ``reach`` places apart in order, by buckets of ``reach`` places.

    Each row meets its own bucket and the next one, so a crowded cell costs rows x reach,
    not rows squared, and its ranks and buckets are spread over tasks.
    """
    columns = columns or []
    rows = _ranked(df.select("Id", *dict.fromkeys([*keys, *columns, *[c for c in order if c != "Id"]])), keys, order)
    rows = rows.withColumn("_b", F.floor(F.col("_r") / reach))
    a = rows.select(*keys, F.col("Id").alias("ltable_id"), F.col("_r").alias("_r1"), F.explode(F.array("_b", F.col("_b") + 1)).alias("_b"), *[F.col(c).alias(f"{c}1") for c in columns])
    b = rows.select(*keys, F.col("Id").alias("rtable_id"), F.col("_r").alias("_r2"), "_b", *[F.col(c).alias(f"{c}2") for c in columns])
    out = a.join(b, [*keys, "_b"]).where((F.col("_r2") > F.col("_r1")) & (F.col("_r2") - F.col("_r1") <= reach))
    out = out.where(condition) if condition is not None else out
    return canonical(out.select(*IDS), *IDS).where("ltable_id <> rtable_id").distinct()


HOUSE = ["cy", "cx", "houseNumber"]


def house_cells(places: DataFrame, every: bool = False) -> DataFrame:
    """Places with the cell of two decimals; without ``every`` only those that have one and a house number."""
    df = _cells(places, 2, 2)
    return df if every else df.dropna(subset=HOUSE)


def block_house(places: DataFrame, reach: int = 999) -> DataFrame:
    """Same house number in one cell of two decimals, at most ``reach`` places apart by id."""
    return _window_join(house_cells(places), HOUSE, ["Id"], reach)


def whole_house_block(places: DataFrame, columns: Iterable[str] = ()) -> DataFrame:
    """Every pair of one house number in one cell, however crowded, with ``columns`` of both ends; an id has one row."""
    return pairs_in_groups(house_cells(places), HOUSE, "Id", columns)


def block_phone(places: DataFrame, reach: int = 499, digits: int = 10) -> DataFrame:
    """A common subsequence of at least ``digits`` of all numbers, in one cell of one by two decimals."""
    rows = _grid(places.where("phoneNumbers is not null").withColumn("phone", F.array_join("phoneNumbers", " ")), 1, 2)
    near = (F.length("phone1") >= digits) & (F.length("phone2") >= digits) & (udfs()["lcs_length"](F.col("phone1"), F.col("phone2")) >= digits)
    return _window_join(rows, ["cy", "cx"], ["phone", "Id"], reach, near, ["phone"])


def block_name(places: DataFrame, reach: int = 499, least: float = 0.7) -> DataFrame:
    """Names whose Jaro similarity is over ``least``, in one cell of one by two decimals."""
    rows = _grid(places.where("sourceNames is not null"), 1, 2)
    n, m = F.length("sourceNames1"), F.length("sourceNames2")
    bound = (2 + F.least(n, m) / F.greatest(n, m)) / 3 > least
    return _window_join(rows, ["cy", "cx"], ["sourceNames", "Id"], reach, bound & (udfs()["jaro"](F.col("sourceNames1"), F.col("sourceNames2")) > least), ["sourceNames"])


def knn(rows: DataFrame, k: int, id_col: str, vec_col: str, block_rows: int = 8_192) -> DataFrame:
    """Exact nearest neighbours by inner product, itself included: ``id, neighbour, score``, ties to the smaller id.

    All rows meet all rows, block by block; a block pair is one matrix product and keeps the
    best ``k`` of each row. Scores are rounded to six places before they are ranked.
    """
    good = rows.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.transform(vec_col, lambda v: v.cast("double")).alias("vec"))
    blocks = max(1, -(-good.count() // block_rows))
    mine = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left, right = good.select("id", "vec", mine.alias("a"), every.alias("b")), good.select("id", "vec", mine.alias("b"), every.alias("a"))

    def best(x: pa.Table, y: pa.Table) -> pa.Table:
        ids, other = x.column("id").to_numpy(), y.column("id").to_numpy()
        if not len(ids) or not len(other):
            return pa.table({"id": pa.array([], pa.int64()), "neighbour": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        matrix = lambda t: np.asarray(t.column("vec").combine_chunks().flatten()).reshape(t.num_rows, -1)
        keep, out = min(k, len(other)), []
        order = np.argsort(other, kind="stable")
        u, v = matrix(x), matrix(y)[order]
        for at in range(0, len(u), 1024):
            s = np.round(u[at : at + 1024] @ v.T, 6)
            out.append((np.argsort(-s, axis=1, kind="stable")[:, :keep], s))
        top = np.concatenate([o for o, _ in out])
        score = np.concatenate([np.take_along_axis(s, o, axis=1) for o, s in out])
        return pa.table({"id": np.repeat(ids, keep), "neighbour": other[order][top].ravel(), "score": score.ravel()})

    found = left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInArrow(best, "id long, neighbour long, score double")
    rank = F.row_number().over(W.partitionBy("id").orderBy(F.desc("score"), "neighbour"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def knn_pairs(neighbours: DataFrame) -> DataFrame:
    """Undirected pairs without self, each once, with the best score."""
    pairs = neighbours.where("id <> neighbour").select(F.least("id", "neighbour").alias("ltable_id"), F.greatest("id", "neighbour").alias("rtable_id"), "score")
    return pairs.groupBy(*IDS).agg(F.max("score").alias("similarity"))


def combine_blocks(blocks: list[DataFrame], places: DataFrame, km: float = 1.0) -> DataFrame:
    """All blocks' pairs, each once, within ``km``, of different places."""
    out = blocks[0].select(*IDS)
    for b in blocks[1:]:
        out = out.unionByName(b.select(*IDS))
    return different_places(within_km(out.distinct(), places, km), places)


def combine_groups(places: DataFrame, key_sets: list[list[str]], km: float = 1.0) -> DataFrame:
    """``combine_blocks`` of blocks that are whole groups: pairs that share a set of keys, within ``km``, of different places."""
    found = pairs_in_any_groups(places, key_sets, "Id", ["placeId", "latitude", "longitude"])
    far = haversine(F.col("latitude1"), F.col("longitude1"), F.col("latitude2"), F.col("longitude2"))
    return found.where("placeId1 <> placeId2").where(far <= km).select(*IDS, "placeId1", "placeId2")


def mark_solo(places: DataFrame) -> DataFrame:
    """``solo``: whether the place has one row only."""
    return places.withColumn("solo", F.count("*").over(W.partitionBy("placeId")) == 1)


def missing_from(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``a`` whose keys ``b`` lacks: missed pairs, or extra ones the other way round."""
    return a.join(b.select(*keys).distinct(), keys, "left_anti")


def golden_pairs(places: DataFrame, columns: Iterable[str] = ()) -> DataFrame:
    """Pairs of ids with the same label and different places, with ``columns`` of both ends."""
    return pairs_in_groups(places, ["clusterId"], "Id", ["placeId", *columns]).where("placeId1 <> placeId2")


def is_golden() -> Column:
    """Whether a pair with ``clusterId`` and ``placeId`` of both ends is one of ``golden_pairs``."""
    return F.coalesce((F.col("clusterId1") == F.col("clusterId2")) & (F.col("placeId1") != F.col("placeId2")), F.lit(False))

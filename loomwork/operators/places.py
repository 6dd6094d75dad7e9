"""Exact duplicates, exploding, category mapping and cleaning of raw place tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomwork.functions import cleaning as C
from loomwork.session import cut

ADDRESS = ["latitude", "longitude", "houseNumber", "streets", "cities", "postalCode"]
KEEP = ["Id", "placeId", "clusterId", "locality", "officialName", "sourceNames", "subCategory", "category", "latitude", "longitude", "houseNumber", "streets", "cities", "postalCode", "brands", "phoneNumbers", "supplier", "email", "internet"]


def drop_zero_coordinates(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Without rows whose latitudes or whose longitudes are all zero; an empty list counts as all zero."""
    zero = lambda c: F.forall(c, lambda x: x == 0)
    return df.where(~(zero(F.col(lat)) | zero(F.col(lon))))


def exact_duplicates(df: DataFrame, keys: list[str], id_col: str = "placeId") -> DataFrame:
    """Groups of rows that agree on all keys (null agrees with null): sorted members and their number."""
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(id_col)).alias("members"), F.count("*").alias("new_len")).where("new_len > 1")


def exact_dedup(df: DataFrame, keys: list[str], id_col: str = "placeId") -> DataFrame:
    """The row of least id of every group that agrees on all keys, by aggregation: a hot group is combined map-side."""
    rest = [c for c in df.columns if c not in keys]
    ordered = [id_col, *[c for c in rest if c != id_col]]
    first = df.groupBy(*keys).agg(F.min(F.struct(*ordered)).alias("_first"))
    return first.select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def same_lengths(df: DataFrame, columns: list[str] = ADDRESS) -> DataFrame:
    return df.where(" and ".join(f"size({c}) = size({columns[0]})" for c in columns[1:]))


def zip_explode(df: DataFrame, columns: list[str] = ADDRESS) -> DataFrame:
    """One row for each place in parallel arrays, which must have equal lengths."""
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, F.inline(F.arrays_zip(*columns)))


def explode_places(df: DataFrame, multilingual: bool = False) -> DataFrame:
    """Names x addresses, with categories combined and rows without usable coordinates or name left out."""
    if multilingual:
        df = df.withColumn("sourceNames", C.latin_select(F.col("sourceNames"), F.col("script_names")))
        for c in ADDRESS:
            df = df.withColumn(c, C.latin_select(F.col(c), F.col("script_city")))
        df = df.drop("script_names", "script_streets", "script_city")
    df = zip_explode(same_lengths(df)).withColumn("sourceNames", F.explode_outer("sourceNames"))
    df = df.withColumn("category", C.combine_categories(F.col("rawCategories"), F.col("insertedCategories"), F.col("preemptiveCategories"))).drop("rawCategories", "insertedCategories", "preemptiveCategories")
    df = df.withColumn("brands", C.brands_text(F.col("brands"))).where(~((F.col("latitude") == 0) & (F.col("longitude") == 0)))
    return df.withColumns({c: F.bround(F.col(c).cast("double"), 5).cast("float") for c in ("latitude", "longitude")}).where("longitude is not null and sourceNames is not null")


def category_map(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Lower-case key to non-null value; the last by ``order`` wins."""
    return df.where(F.col(value).isNotNull()).groupBy(F.lower(F.col(key)).alias("key")).agg(F.max_by(value, order).alias("value"))


def mode_of_list(df: DataFrame, id_cols: list[str], items: Column, mapping: DataFrame, out: str) -> DataFrame:
    """The commonest mapped entry of a list, ties to the least name; no row if nothing is mapped."""
    each = df.select(*id_cols, F.explode(items).alias("key")).join(mapping, "key").groupBy(*id_cols, "value").count()
    return most_common(each, id_cols, "value", out)


def most_common(counts: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    return counts.groupBy(*keys).agg(F.min(F.struct((-F.col("count")).alias("n"), F.col(value).alias("v"))).alias("x")).select(*keys, F.col("x.v").alias(out))


def surrogate_ids(df: DataFrame, order: list[str], out: str = "Id") -> DataFrame:
    """Dense ids from 0 in a fixed order: ranges are numbered apart and shifted by what comes before them.

    Only one count for each range reaches the driver.
    """
    parts = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    parts = cut(parts)
    base, total = {}, 0
    for row in parts.groupBy("_part").count().orderBy("_part").collect():
        base[row["_part"]], total = total, total + row["count"]
    if not base:
        return df.withColumn(out, F.lit(None).cast("long"))
    shift = F.create_map(*[F.lit(x) for kv in base.items() for x in kv])[F.col("_part")]
    within = F.row_number().over(W.partitionBy("_part").orderBy(*order))
    return parts.withColumn(out, (shift + within - 1).cast("long")).drop("_part")


def map_categories(df: DataFrame, categories: DataFrame, sub_categories: DataFrame) -> DataFrame:
    """``category`` (a list) becomes its commonest mapped entry, ``subCategory`` that by the other map; null if none is mapped.

    ``categories``/``sub_categories``: key, value, as ``category_map`` makes them. One list's
    entries are counted in its own row, so the table is shuffled by entry, never by list.
    """
    keyed = cut(df.withColumn("_row", F.monotonically_increasing_id()))
    items = F.transform("category", lambda x: F.lower(x))
    for mapping, out in ((categories, "_category"), (sub_categories, "_sub")):
        keyed = keyed.join(mode_of_list(keyed.select("_row", "category"), ["_row"], items, mapping, out), "_row", "left")
    rest = [c for c in df.columns if c not in ("category", "subCategory")]
    return keyed.select(*rest, F.col("_category").alias("category"), F.col("_sub").alias("subCategory"))


#: Text columns that are cleaned, and those of them whose repeated words go.
TEXT = ["sourceNames", "brands", "houseNumber", "category", "streets", "cities", "postalCode", "subCategory", "email", "internet"]
ONCE = ["brands", "subCategory", "sourceNames", "streets", "cities"]


def clean_attributes(df: DataFrame) -> DataFrame:
    """The cleaning recipe, in its fixed order, over an exploded table with mapped categories; rows without a name go."""
    df = df.withColumns({c: F.lit(None).cast("string") for c in TEXT if c not in df.columns})
    kinds = dict(df.dtypes)
    df = df.withColumns({c: F.concat_ws(" ", c) if kinds[c].startswith("array") else F.col(c).cast("string") for c in TEXT})
    df = df.withColumn("sourceNames", C.blank_to_null(F.trim("sourceNames"))).where("longitude is not null and sourceNames is not null").distinct()
    df = df.withColumns({c: C.clean_email(C.canonical_url(C.strip_brackets(F.col(c)))) for c in ("internet", "email")})
    df = df.withColumns({c: C.clean_text(F.nullif(F.col(c), F.lit("nan"))) for c in TEXT})
    df = df.withColumns({c: C.unique_tokens(F.col(c)) for c in ONCE})
    df = df.withColumn("subCategory", C.drop_unspecified(F.col("subCategory")))
    df = df.withColumns({"streets": C.clean_streets(F.col("streets")), "cities": C.clean_streets(F.col("cities")), "sourceNames": C.clean_name(F.col("sourceNames"))})
    df = df.withColumns({c: C.remove_words(F.col(c)) for c in ("sourceNames", "streets", "cities")})
    df = df.withColumns({c: C.blank_to_null(F.col(c)) for c, kind in df.dtypes if kind == "string"})
    return df.where("sourceNames is not null").withColumn("category", F.regexp_replace("category", "caf pub", "cafe pub"))


def keep_columns(df: DataFrame, columns: list[str] = KEEP) -> DataFrame:
    """Only the columns on the list that the table has."""
    return df.select([c for c in columns if c in df.columns])


def clean_places(df: DataFrame, categories: DataFrame | None = None, sub_categories: DataFrame | None = None) -> DataFrame:
    """Categories mapped (where maps are given), attributes cleaned, rows numbered, listed columns kept."""
    if categories is not None:
        df = map_categories(df, categories, categories if sub_categories is None else sub_categories)
    df = surrogate_ids(clean_attributes(df), ["placeId", "sourceNames", "latitude", "longitude", "streets", "houseNumber"])
    return keep_columns(df)

"""Items: click rates, pool, similar items, cold lists, collections, exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions import exprs as X
from tagloom.operators import cosine as C
from tagloom.operators import frames as O
from tagloom.sources.scratch import written


def click_rates(log: DataFrame, click_min: int = 100, exposure_min: int = 100, zones: Sequence[str] = ("ALL",), excluded: str = "insert") -> DataFrame:
    """(item, zone, click, exposure, ctr) of a log of texts (item, zone, exposure, click, flag)."""
    valid = log.where(X.is_number(F.col("exposure"), "int") & X.is_number(F.col("click"), "int") & X.lacks(F.col("flag"), excluded) & X.in_set(F.col("zone"), tuple(zones)))
    typed = valid.select("item", "zone", F.col("click").cast("int").alias("click"), F.col("exposure").cast("int").alias("exposure"))
    return O.ratio_of_sums(typed, ["item", "zone"], "click", "exposure", click_min, exposure_min)


def item_pool(catalogue: DataFrame, eligible: Column, play_counts: DataFrame, min_plays: int, fresh: DataFrame | None = None) -> DataFrame:
    """(item) of eligible items with at least ``min_plays`` plays in the counts.

    ``fresh`` holds the items that the lifetime rule allows (see :func:`fresh_in_class`).
    """
    catalogue = catalogue if fresh is None else O.restrict(catalogue, fresh, "item")
    played = play_counts.groupBy("item").agg(F.sum("n").alias("n")).where(F.col("n") >= min_plays)
    return O.restrict(catalogue.where(eligible).select("item").distinct(), played, "item")


def fresh_in_class(catalogue: DataFrame, valid_days: DataFrame, as_of: Column, codes: tuple[str, str, str]) -> DataFrame:
    """Items whose lifetime class and categories still allow them at ``as_of``.

    ``valid_days`` (key, days) is the configuration, a few rows; both category levels
    look up what stands before their first ``#``.
    """
    days = F.broadcast(valid_days)
    catalogue = catalogue.withColumns({"first_key": F.substring_index("first", "#", 1), "second_key": F.substring_index("second", "#", 1)})
    first = days.select(F.col("key").alias("first_key"), F.col("days").alias("first_days"))
    second = days.select(F.col("key").alias("second_key"), F.col("days").alias("second_days"))
    joined = catalogue.join(first, "first_key", "left").join(second, "second_key", "left")
    age = F.datediff(as_of, F.col("published"))
    return joined.where(X.is_fresh_class(F.col("lifetime"), age, F.col("first_days"), F.col("second_days"), codes)).drop("first_days", "second_days", "first_key", "second_key")


def similar_items(item_tags: DataFrame, pool: DataFrame, postings_limit: int = 100, count: int = 40, with_tags: bool = False) -> DataFrame:
    """(item, other, sim, shared[, tags]): most similar items through shared tags."""
    pairs = O.shared_tag_pairs(O.restrict(item_tags, pool, "item"), postings_limit, with_tags)
    return O.top_k(pairs, ["item"], count, value="sim", tie=("other",))


def similar_items_ctr(similar: DataFrame, ctr: DataFrame, share: float = 0.1, count: int = 40) -> DataFrame:
    """Similar items weighed by the neighbour's click rate, else ``share`` of the similarity."""
    per_item = ctr.groupBy(F.col("item").alias("other")).agg(F.max("ctr").alias("ctr"))
    weighed = O.enrich(similar, per_item, "other").select(
        "item", "other", F.round(F.coalesce("ctr", F.col("sim") * share), 9).alias("weight"), F.when(F.col("ctr").isNotNull(), "ctr").otherwise("sim").alias("weight_type")
    )
    return O.top_k(weighed, ["item"], count, tie=("other",))


def hot_items(exposures: DataFrame, exposure_max: int, hot_scope: str = "row") -> DataFrame:
    """Items of which a row ("row") or the sum of the rows ("sum") has more than ``exposure_max`` exposures."""
    counted = exposures if hot_scope == "row" else exposures.groupBy("item").agg(F.sum("exposure").alias("exposure"))
    return O.above(counted, exposure_max, "exposure").select("item").distinct()


def fresh_items(published: DataFrame, as_of: Column, days: int) -> DataFrame:
    """Rows of ``published`` that are younger than ``days`` at ``as_of``."""
    return published.where(F.datediff(as_of, F.col("published")) < days)


def cold_lists(lists: DataFrame, exposures: DataFrame, published: DataFrame, as_of: Column, exposure_max: int, days: int, hot_scope: str = "row") -> DataFrame:
    """Inverted lists without items that are hot or older than ``days``."""
    cold = O.exclude(lists, hot_items(exposures, exposure_max, hot_scope), "item")
    return O.restrict(cold, fresh_items(published, as_of, days), "item")


def best_collection(items: DataFrame, collections: DataFrame) -> DataFrame:
    """(item, other, cosine): the collection of largest cosine; ties by id.

    Items that share no feature with any collection have no row.
    """
    return C.cosine_pairs(items, collections, count=1)


def collection_sums(item_vectors: DataFrame, members: DataFrame, entries: int = O.BROADCAST_ROWS, task: int = O.TASK_ROWS) -> DataFrame:
    """(other, idx, val): collections as sums of their items' vectors (item, idx, val), which are read more than once.

    Where the distinct vectors have few entries, they are broadcast: members are dealt by
    collection with their item's kind of vector, and their many more weights are not shuffled.
    """
    lists = item_vectors.groupBy("item").agg(F.array_sort(F.collect_list(F.struct("idx", "val"))).alias("vector"))
    kinds = written(lists.groupBy("vector").agg(F.min("item").alias("kind")), "kinds")
    if (kinds.agg(F.sum(F.size("vector"))).first()[0] or 0) <= entries:
        kinds = F.broadcast(kinds)
        own = written(members.join(lists.join(kinds, "vector").select("item", "kind"), "item").select("collection", "kind"), "members")
        rows = O.dealt_by_size(own, "collection", F.lit(1), task).join(kinds, "kind").select("collection", F.inline("vector"))
    else:
        rows = members.join(item_vectors, "item")
    return rows.groupBy("collection", "idx").agg(F.round(F.sum("val"), 9).alias("val")).withColumnRenamed("collection", "other")


def nearest_collections(item_vectors: DataFrame, members: DataFrame, min_cosine: float = 0.1, count: int = 11) -> DataFrame:
    """Collections as sums of their items' vectors; per item the nearest."""
    vectors = written(item_vectors.select("item", "idx", "val"), "vectors")
    return C.cosine_pairs(vectors, collection_sums(vectors, members), count, min_cosine)


def nearest_items(item_vectors: DataFrame, sample: DataFrame, min_cosine: float = 0.1, count: int = 11) -> DataFrame:
    """Per item the nearest of the sampled items (item, idx, val); made for dense vectors."""
    return C.cosine_pairs(item_vectors, sample.withColumnRenamed("item", "other"), count, min_cosine, same=False, centres=True)


def item_meta_lines(items: DataFrame, pool: DataFrame, content: DataFrame, query: DataFrame, columns: dict[str, int], width: int) -> DataFrame:
    """One positional line per pool item with its tags, with and without weights.

    ``items`` has item and any columns named in ``columns``; the tag fields are
    content_ids, content_weights, query_ids and query_weights.
    """

    def texts(tags: DataFrame, prefix: str) -> DataFrame:
        lists = O.postings(tags, "item", "tag")
        return lists.select("item", F.array_join(F.transform("values", lambda x: x["id"].cast("string")), "#").alias(f"{prefix}_ids"), X.format_list(F.col("values"), "#").alias(f"{prefix}_weights"))

    joined = O.restrict(items, pool, "item").join(texts(content, "content"), "item").join(texts(query, "query"), "item", "left")
    fields = {position: X.replace_tabs(F.col(name).cast("string")) for name, position in columns.items()}
    return joined.select("item", X.positional_line(fields, width).alias("line"))

"""Joins and set operations between the retail tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pasarlens.functions import features as X
from pasarlens.operators.aggregates import PAIR
from pasarlens.operators.ranking import global_position
from pasarlens.operators.skew import join_stats
from pasarlens.session import stage

# Bits of one bitmap: items of a block that users meet together.
UNSEEN_BLOCK = 32_768


def user_product_features(
    engagement: DataFrame, spending: DataFrame, as_of: str, how: str = "left"
) -> DataFrame:
    """Join both pair aggregates; pairs without transactions get zeros.

    Both sides are already hashed by (user, product), so the join adds no shuffle, and a
    pair occurs once per side, so no key is hot.
    """
    joined = engagement.join(spending, list(PAIR), how).fillna(0)
    return joined.withColumns(
        {
            "has_purchased": X.has_purchased(F.col("n_purchases")),
            "days_since_last": X.days_since(as_of, F.col("last_interaction_ts")),
            "processed_at": F.lit(as_of).cast("timestamp_ntz"),
        }
    )


def enrich(recommendations: DataFrame, products: DataFrame) -> DataFrame:
    """Add name, category and price of the recommended product.

    A product may be recommended to a large share of the users, so the join spreads such
    products; adaptive execution broadcasts the metadata when it measures it as small.
    """
    wanted = ["product_name", "category", "final_price_idr"]
    picked = stage(recommendations, "recommended")  # read for its counts and for the join
    popular = picked.groupBy("product_id").agg(F.count(F.lit(1)).alias("_times"))
    # counts of all recommended products, so one that the catalogue lacks is spread as well
    details = popular.join(products.select("product_id", *wanted), "product_id", "left")
    return join_stats(
        picked, details, ["product_id"], "_times", ["user_id", "product_id"]
    ).drop("_times")


def mark_groups(
    rows: DataFrame, groups: DataFrame, key: str, spread_by: Sequence[str], name: str = "_inside"
) -> DataFrame:
    """Every row with the verdict whether its group is in ``groups`` (no null group is).

    The verdict is made once per group and carried to the rows; groups that hold many rows are
    spread whatever their verdict.
    """
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_size"))
    listed = groups.select(key).distinct().withColumn(name, F.lit(True))
    verdicts = sizes.join(listed, key, "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return join_stats(rows, verdicts, [key], "_size", spread_by, null_safe=True, how="inner").drop("_size")


def rows_of_groups(
    rows: DataFrame, groups: DataFrame, key: str, inside: bool, spread_by: Sequence[str]
) -> DataFrame:
    """Rows whose group is (semi join) or is not (anti join) in ``groups``."""
    marked = mark_groups(rows, groups, key, spread_by)
    return marked.where(F.col("_inside") == inside).drop("_inside")


def union_pairs(*tables: DataFrame) -> DataFrame:
    """Stack the (user, product) pairs of several tables, repeats kept, one event each."""
    stacked = tables[0].select(*PAIR)
    for other in tables[1:]:
        stacked = stacked.unionByName(other.select(*PAIR))
    return stacked.withColumn("interaction", F.lit(1))


def distinct_values(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(column).where(F.col(column).isNotNull()).distinct()


def ids_with_total(rows: DataFrame, column: str) -> DataFrame:
    """Every known id, each next to how many there are."""
    ids = distinct_values(rows, column)
    return ids.withColumn("total", ids.agg(F.count(F.lit(1))).scalar())


def unseen_items(interactions: DataFrame, user_id: object) -> DataFrame:
    """Items one user has not touched; no pairs of users and items are formed."""
    items = distinct_values(interactions, "product_id")
    seen = interactions.where(F.col("user_id") == F.lit(user_id)).select("product_id").distinct()
    return items.join(seen, "product_id", "left_anti")


def unseen_of_users(interactions: DataFrame, users: DataFrame, block: int = UNSEEN_BLOCK) -> DataFrame:
    """(user_id, product_id) of all items that each of the asked users has not touched.

    Items have dense codes in blocks of ``block``.  What a user has touched is one bitmap per block,
    built by partial aggregation, so a user with a long history costs no more than one with a short one.
    Each user meets every item block once, by an equi-join on the block number, and the block's items
    are read against the bitmap.  A user nobody knows has touched nothing.
    """
    if not 0 < block <= UNSEEN_BLOCK:
        raise ValueError(f"a bitmap has at most {UNSEEN_BLOCK} bits")
    touched = stage(interactions.select(*PAIR).dropna(), "touched")
    asked = stage(users.select("user_id").dropna().distinct(), "asked")
    codes = stage(global_position(touched.select("product_id").distinct(), ["product_id"], "code"), "items")
    n_items = codes.count()
    at, bit = F.floor(F.col("code") / block).cast("int"), (F.col("code") % block).cast("int")
    # a block's items in the order of their bits
    blocks = codes.groupBy(at.alias("block")).agg(F.sort_array(F.collect_list(F.struct(bit.alias("bit"), "product_id"))).alias("items"))
    held = mark_groups(touched, asked, "user_id", ["product_id"]).where("_inside").select(*PAIR)
    sizes = held.groupBy("product_id").agg(F.count(F.lit(1)).alias("_rows"))
    coded = join_stats(held, codes.join(sizes, "product_id"), ["product_id"], "_rows", ["user_id"], how="inner")
    seen = coded.groupBy("user_id", at.alias("block")).agg(F.bitmap_construct_agg(bit.cast("long")).alias("seen"))
    grid = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(max(n_items - 1, 0) // block))))
    whole = grid.join(seen, ["user_id", "block"], "left").join(blocks, "block")
    byte = F.expr("substring(seen, item.bit div 8 + 1, 1)")
    set_ = F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), F.expr("item.bit % 8"))
    pairs = whole.select("user_id", "seen", F.explode("items").alias("item"))
    return pairs.where(F.col("seen").isNull() | (set_ == 0)).select("user_id", F.col("item.product_id").alias("product_id"))


def unseen_counts(interactions: DataFrame) -> DataFrame:
    """Per user: items touched and items left, from counts alone."""
    items = distinct_values(interactions, "product_id").agg(F.count(F.lit(1))).scalar()
    touched = interactions.select(*PAIR).dropna().distinct()
    seen = touched.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_seen"))
    return seen.withColumn("n_unseen", items - F.col("n_seen"))


def hstack(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Columns of both tables side by side, matched by id rather than by row position."""
    return left.join(right, key, "left")


def user_history(interactions: DataFrame) -> DataFrame:
    """Products each user touched, one row each, with the user's number of products."""
    pairs = interactions.select(*PAIR).dropna().distinct()
    totals = pairs.groupBy("user_id").agg(F.count(F.lit(1)).alias("total_interactions"))
    return join_stats(pairs, totals, ["user_id"], "total_interactions", ["product_id"])


def history_of(asked: DataFrame, interactions: DataFrame) -> DataFrame:
    """History rows of the asked users; an unknown user gives one row with an error."""
    users = asked.select("user_id").distinct()
    own = mark_groups(interactions.select(*PAIR), users, "user_id", ["product_id"]).where("_inside").drop("_inside")
    known = user_history(own).withColumn("error", F.lit(None).cast("string"))
    unknown = users.join(distinct_values(interactions, "user_id"), "user_id", "left_anti").select(
        "user_id",
        F.lit(None).cast(interactions.schema["product_id"].dataType).alias("product_id"),
        F.lit(None).cast("long").alias("total_interactions"),
        F.lit("User not found").alias("error"),
    )
    return known.unionByName(unknown)

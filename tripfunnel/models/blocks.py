"""Best items per user by dot product; users stay where they are."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfunnel.operators.rows import top_n_per_group

#: Doubles of item vectors that are sent to every executor at most (128 MB).
MOST_BROADCAST = 16_000_000
#: Decimals of a score.
DIGITS = 9


def _best(users: pd.DataFrame, names: np.ndarray, matrix: np.ndarray, k: int) -> pd.DataFrame:
    """The ``k`` best items, and as many more as ``extra`` says, for each user."""
    parts = []
    for start in range(0, len(users), 256):
        some = users.iloc[start : start + 256]
        # Rounded, so that equal items tie in whatever order their products were added up.
        scores = np.round(np.stack(some["user_vector"].to_numpy()) @ matrix, DIGITS) + 0.0
        for line, user, extra in zip(scores, some["user_id"], some["extra"]):
            take = min(k + int(extra), len(names))
            cut = -np.partition(-line, take - 1)[take - 1]
            chosen = np.flatnonzero(line >= cut)
            chosen = chosen[np.argsort(-line[chosen], kind="stable")][:take]
            parts.append(pd.DataFrame({"user_id": user, "item_id": names[chosen], "score": line[chosen]}))
    if not parts:
        return pd.DataFrame({c: pd.Series(dtype=object) for c in ("user_id", "item_id", "score")})
    return pd.concat(parts, ignore_index=True)


def _in_place(users: DataFrame, items: DataFrame, k: int, schema: str) -> DataFrame:
    """Item vectors are broadcast; every batch of users is scored in its own task."""
    rows = sorted((r["item_id"], r["item_vector"]) for r in items.collect())
    if not rows:
        return users.sparkSession.createDataFrame([], schema)
    factors = ([name for name, _ in rows], np.array([v for _, v in rows], dtype=float).T)
    shared = users.sparkSession.sparkContext.broadcast(factors)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, matrix = shared.value
        for batch in batches:
            yield _best(batch, np.array(names), matrix, k)

    return users.mapInPandas(run, schema)


def _in_blocks(users: DataFrame, items: DataFrame, k: int, schema: str, blocks: int, block: int) -> DataFrame:
    """Blocks of users meet blocks of items, each in a task of its own."""
    user_blocks = max(1, math.ceil(users.count() / block))

    def all_blocks(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = users.select(
        "*",
        F.pmod(F.xxhash64("user_id"), F.lit(user_blocks)).cast("int").alias("user_block"),
        all_blocks(blocks).alias("item_block"),
    )
    right = items.select(
        "*",
        all_blocks(user_blocks).alias("r_user_block"),
        F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int").alias("r_item_block"),
    )

    def meet(some: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
        if some.empty or offered.empty:
            return _best(some.iloc[:0], np.array([]), np.zeros((0, 0)), k)
        offered = offered.sort_values("item_id")
        return _best(some, offered["item_id"].to_numpy(), np.stack(offered["item_vector"].to_numpy()).T, k)

    return (
        left.groupBy("user_block", "item_block")
        .cogroup(right.groupBy("r_user_block", "r_item_block"))
        .applyInPandas(meet, schema)
    )


def top_items(
    users: DataFrame, items: DataFrame, k: int, liked: DataFrame | None = None, masked_score: float = -1.0,
    block: int = 20_000, most: int = MOST_BROADCAST,
) -> DataFrame:
    """``(user_id, item_id, score, rank)``: the ``k`` items with the largest dot product.

    ``users`` has ``user_id`` and ``user_vector``, ``items`` has ``item_id`` and
    ``item_vector``. The items in ``liked (user_id, item_id)`` score ``masked_score``, or what
    a column ``score`` of it says: with it, ``users`` has ``extra``, the number of a user's liked items. So many more are kept
    per user, and the liked ones are taken out by a join, so no user carries a list.

    Item vectors of at most ``most`` numbers are broadcast and users are not shuffled;
    beyond that, blocks of either side meet. Only winners are shuffled.
    """
    id_types = {f.name: f.dataType.simpleString() for f in (*users.schema, *items.schema)}
    schema = f"user_id {id_types['user_id']}, item_id {id_types['item_id']}, score double"
    asking = users.select("user_id", "user_vector", F.col("extra") if liked is not None else F.lit(0).alias("extra"))
    offered = items.select("item_id", "item_vector")
    n, width = offered.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("item_vector")), F.lit(0))).first()
    if n * width <= most:
        won = _in_place(asking, offered, k, schema)
    else:
        won = _in_blocks(asking, offered, k, schema, math.ceil(n / block), block)
    if liked is not None:
        score = F.round("score", DIGITS) if "score" in liked.columns else F.lit(masked_score)
        masked = liked.select("user_id", "item_id", score.alias("score")).join(offered.select("item_id"), "item_id")
        won = won.join(masked, ["user_id", "item_id"], "left_anti").unionByName(masked)
    return top_n_per_group(
        won, ["user_id"], [F.col("score").desc_nulls_last(), F.col("item_id").asc()], k
    )

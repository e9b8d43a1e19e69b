"""User-based collaborative filtering over destinations.

Two users are similar when they share at least ``min_shared`` destinations; the
similarity is the sum of products of their weights on the shared ones. A destination
is scored for a user by all similar users who have it.

User pairs are never built. What a user contributes depends only on the *set* of
destinations they have and their weights on it, so users are first collapsed to sets
and to profiles (set and weights; with map-side combine), and sets meet profiles. For one
shared destination ``e``

    score(a, d) = sum over e in P of  w(a, e) * T(P, e, d)
    T(P, e, d)  = sum over profiles of n users holding e and d that share enough with the
                  set P, of  n * w(e) * w(d)

The most popular destinations, at most ``MOST_POPULAR``, are the bits of a mask, and users
are added up by mask: ``T`` over all masks that share enough with a mask follows for every
mask at once, bit by bit, without a pair. That costs the catalogue times the masks, however
many users there are, and is all there is to do for a catalogue of that size.

Sets that share a rarer destination meet through an inverted index with prefix filtering:
destinations are ordered from the rarest to the most frequent, only as many of a set's first
ones are indexed as two sets cannot miss each other by, and a pair is worked out where it
first meets and nowhere else; what the masks have counted of it is left out. ``T`` is added
up sparsely inside a cogroup; blocks keep every group small however many hold a destination.
Users cost linear work, pairs of sets that share a rarer destination are what grows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripfunnel.functions.scalar import clock
from tripfunnel.operators.rows import top_n_per_group
from tripfunnel.session import scratch_path

CONVERTED_WEIGHT = 1.0
CLICKED_WEIGHT = 0.5
#: Destinations that are bits of a mask, at most.
MOST_POPULAR = 16
#: What one pair of sets on a destination costs, in additions of the masks' sums.
PAIR_COST = 16
#: What it costs in the same unit to look for pairs of sets at all.
PAIRS_COST = 1e9


def user_destinations(clicks: DataFrame, conversions: DataFrame) -> DataFrame:
    """Signal per user and destination: 1.0 if any click on it converted, else 0.5."""
    touched = clicks.filter(
        F.col("user_id").isNotNull() & F.col("result_destination").isNotNull()
    ).select("event_id", "user_id", F.col("result_destination").alias("destination"))
    booked = (
        conversions.filter(F.col("click_event_id").isNotNull())
        .select(F.col("click_event_id").alias("_booked"))
        .distinct()
    )
    weight = F.when(F.col("_booked").isNotNull(), CONVERTED_WEIGHT).otherwise(CLICKED_WEIGHT)
    return (
        touched.join(booked, F.col("event_id") == F.col("_booked"), "left")
        .groupBy("user_id", "destination")
        .agg(F.max(weight).alias("signal_strength"))
    )


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Sets:
    """Stored tables: ``tokens`` (token, destination, holders), ``users`` (user_id, set, weights), ``sets`` (set, tokens)."""

    tokens: DataFrame
    users: DataFrame
    sets: DataFrame

    @staticmethod
    def of(user_destination: DataFrame, min_shared: int) -> Sets:
        """Destinations become tokens, the rarest first; users are collapsed to their set of tokens.

        A user with fewer destinations than ``min_shared`` is similar to nobody.
        """
        rows = _stored(user_destination.select("user_id", "destination", "signal_strength"), "affinity")
        counted = rows.groupBy("destination").agg(F.count(F.lit(1)).alias("_n")).orderBy("_n", "destination")
        tokens = _stored(
            counted.select("destination", F.monotonically_increasing_id().alias("token"), F.col("_n").alias("holders")), "tokens"
        )
        pairs = F.array_sort(F.collect_list(F.struct("token", "signal_strength")))
        users = _stored(
            rows.join(tokens, "destination")
            .groupBy("user_id")
            .agg(pairs.alias("_pairs"))
            .filter(F.size("_pairs") >= min_shared)
            .select("user_id", F.col("_pairs.token").alias("tokens"), F.col("_pairs.signal_strength").alias("weights")),
            "user-sets",
        )
        sets = _stored(users.select("tokens").distinct().select("tokens", F.monotonically_increasing_id().alias("set")), "sets")
        return Sets(tokens, _stored(users.join(sets, "tokens"), "users"), sets)

    def profiles(self) -> DataFrame:
        """Users of equal set and weights, and how many they are."""
        return self.users.groupBy("set", "tokens", "weights").agg(F.count(F.lit(1)).alias("n"))


def popular_tokens(tokens: DataFrame, min_shared: int, most: int = MOST_POPULAR) -> list[int]:
    """The tokens that become bits, the most frequent first: as many as make masks and pairs the least work together."""
    top = tokens.orderBy(F.col("token").desc()).limit(most).collect()
    catalogue, pairs = tokens.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.col("holders").cast("double") * F.col("holders")), F.lit(0.0))
    ).first()
    best, least = 0, PAIRS_COST + PAIR_COST * pairs
    for bits, row in enumerate(top, 1):
        pairs -= float(row["holders"]) ** 2
        cost = (PAIRS_COST + PAIR_COST * pairs) * (bits < catalogue) + catalogue * 2.0**bits * bits * bits * min_shared
        if bits >= min_shared and cost < least:
            best, least = bits, cost
    return [row["token"] for row in top[:best]]


def _masked(df: DataFrame, popular: list[int]) -> DataFrame:
    """Adds ``mask``: bit ``i`` is set if the row's tokens have ``popular[i]``."""
    mask = F.lit(0).cast("long")
    for i, token in enumerate(popular):
        mask = mask + F.when(F.array_contains("tokens", F.lit(token).cast("long")), F.lit(1 << i)).otherwise(F.lit(0))
    return df.withColumn("mask", mask)


def _sharing(values: np.ndarray, start: int, enough: int) -> np.ndarray:
    """For every mask the sum of ``values`` over all masks that share so many bits with it that, with the
    ``start`` they share already, it is ``enough``.

    Bits are gone through one at a time; what shares the same number of those done is kept apart, from
    ``start`` on, and ``enough`` stands for more too. Nothing is subtracted, so a sum of nothing is 0.
    """
    levels = np.zeros((enough - start + 1, len(values)))
    levels[0] = values
    for bit in range(len(values).bit_length() - 1):
        split = levels.reshape(len(levels), -1, 2, 1 << bit)
        without, having = split[:, :, 0], split[:, :, 1]
        shared = without.copy()
        shared[1:] += having[:-1]
        shared[-1] += having[-1]
        levels = np.stack((without + having, shared), axis=2).reshape(len(levels), -1)
    return levels[-1]


_REACH = "mask long, candidate long, users double, strengths array<double>"


def _reach(popular: list[int], min_shared: int):
    """All users that hold one candidate, added up by mask: how strongly it is tied to each bit of each mask."""
    bits = len(popular)

    def reach(key: tuple, held: pa.Table) -> pa.Table:
        masks = held["mask"].to_numpy()
        candidate = key[0].as_py()

        def cube(name: str) -> np.ndarray:
            values = np.zeros(1 << bits)
            values[masks] = held[name].to_numpy()
            return values

        users = _sharing(cube("n"), 0, min_shared)
        strengths = np.zeros((1 << bits, bits))
        for i in range(bits):
            # Both sides hold bit i, so the others are a cube of their own.
            half = cube(f"s{i}").reshape(-1, 2, 1 << i)[:, 1].ravel()
            strengths.reshape(-1, 2, 1 << i, bits)[:, 1, :, i] = _sharing(half, 1, min_shared).reshape(-1, 1 << i)
        every = np.arange(1 << bits)
        kept = users > 0
        if candidate in popular:
            kept &= (every >> popular.index(candidate)) & 1 == 0
        rows = int(kept.sum())
        lists = pa.ListArray.from_arrays(np.arange(rows + 1, dtype=np.int32) * bits, strengths[kept].ravel())
        return pa.table({
            "mask": every[kept], "candidate": np.full(rows, candidate), "users": users[kept], "strengths": lists,
        })

    return reach


def _spread(df: DataFrame, *keys: str) -> DataFrame:
    """Dealt over all shuffle partitions, which are not joined again: these rows are few and cost much work each."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def mask_strengths(sets: Sets, popular: list[int], min_shared: int, candidates: bool) -> DataFrame:
    """Per mask and candidate that the mask does not hold: ``_strengths``, a map from each popular token to how
    strongly the candidate is tied to it by users who share enough popular tokens, and from -1 to their number.

    Without ``candidates`` there is one per mask, -1, which every user holds with weight one.
    """
    entries = F.arrays_zip(F.col("tokens").alias("candidate"), F.col("weights").alias("weight"))
    users = _masked(sets.users, popular).filter(F.bit_count("mask") >= min_shared)
    held = [
        F.coalesce(F.get("weights", F.array_position("tokens", F.lit(t).cast("long")).cast("int") - 1), F.lit(0.0)).alias(f"w{i}")
        for i, t in enumerate(popular)
    ]
    if candidates:
        listed = users.select("mask", *held, F.inline(entries))
    else:
        listed = users.select("mask", *held, F.lit(_USERS).cast("long").alias("candidate"), F.lit(1.0).alias("weight"))
    summed = listed.groupBy("candidate", "mask").agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(F.col(f"w{i}") * F.col("weight")).alias(f"s{i}") for i in range(len(popular)))
    )
    reached = _spread(summed, "candidate").groupBy("candidate").applyInArrow(_reach(popular, min_shared), _REACH)
    tokens = F.array(*(F.lit(t).cast("long") for t in (*popular, _USERS)))
    return reached.select("mask", "candidate", F.map_from_arrays(tokens, F.concat("strengths", F.array("users"))).alias("_strengths"))


def _indexed(df: DataFrame, min_shared: int, block_size: int, popular: list[int]) -> DataFrame:
    """A row per token of the prefix: two sets that share enough have their first shared token in both prefixes.

    The tokens that come last, which are the most frequent, are in no prefix. Sets whose first shared token is
    popular share nothing but popular ones, and have met as masks. Blocks keep a popular token's
    rows apart; their number follows from the number of rows.
    """
    prefix = F.slice("tokens", 1, F.size("tokens") - min_shared + 1)
    listed = df.withColumn("pivot", F.explode(prefix))
    if popular:
        listed = listed.filter(F.col("pivot") < min(popular))
    sizes = listed.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / F.lit(block_size)).cast("int").alias("blocks"))
    return listed.join(sizes, "pivot").withColumn("block", F.pmod(F.xxhash64("tokens"), F.col("blocks")).cast("int"))


class _Members:
    """Which rows of a block hold a token, and where in their list."""

    def __init__(self, lists):
        lengths = np.array([len(x) for x in lists], dtype=np.int64)
        flat = np.concatenate(lists) if len(lists) else np.zeros(0, dtype=np.int64)
        order = np.argsort(flat, kind="stable")
        self.rows = np.repeat(np.arange(len(lists)), lengths)[order]
        self.flat_at = order
        self.tokens, starts = np.unique(flat[order], return_index=True)
        self.starts = np.append(starts, len(flat))

    def spans(self):
        """Token by token the rows that hold it, and their places in the flattened lists."""
        for token, a, b in zip(self.tokens.tolist(), self.starts[:-1].tolist(), self.starts[1:].tolist()):
            yield token, self.rows[a:b], self.flat_at[a:b]


_MEETINGS = "set long, token long, destinations array<long>, strengths array<double>, total double"
#: Stands for a token in the rows that count users.
_USERS = -1


def _meet(min_shared: int, popular: list[int]):
    """One block of sets and one of profiles that all have one token in their prefix.

    Pairs that share enough popular tokens have been counted, and added up over these tokens, as masks.
    All that is worked out grows with the tokens that the rows hold, not with the catalogue.
    """

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = ("set", "token", "destinations", "strengths", "total")
        if left.empty or right.empty:
            return pd.DataFrame({c: pd.Series(dtype=object) for c in names})
        pivot = left["pivot"].iloc[0]
        ours, theirs = _Members(left["tokens"].to_numpy()), _Members(right["r_tokens"].to_numpy())
        users = right["n"].to_numpy(dtype=np.float64)
        weights = np.concatenate(right["weights"].to_numpy())
        by_token = {token: (rows, at) for token, rows, at in theirs.spans()}
        shared = np.zeros((len(left), len(right)), dtype=np.int32)
        earlier = np.zeros(shared.shape, dtype=bool)
        as_masks = np.zeros(shared.shape, dtype=np.int32)
        common = [(token, rows, *by_token[token]) for token, rows, _ in ours.spans() if token in by_token]
        for token, rows, others, _ in common:
            cell = np.ix_(rows, others)
            shared[cell] += 1
            if token < pivot:
                earlier[cell] = True
            if token in popular:
                as_masks[cell] += 1
        # A pair meets at its first shared token and nowhere else.
        similar = (shared >= min_shared) & ~earlier
        uncounted = similar & (as_masks < min_shared)
        holds = {token: rows for token, rows, _ in ours.spans()}
        owner = np.repeat(np.arange(len(right)), [len(x) for x in right["r_tokens"]])
        flat = np.concatenate(right["r_tokens"].to_numpy())
        sets = left["set"].to_numpy()
        out: list[tuple] = []

        def offer(token: int, rows: np.ndarray, support: np.ndarray, columns: np.ndarray, values: np.ndarray) -> None:
            """``support`` (rows x columns) times the columns' values, for each destination a row does not hold."""
            # Entries of the chosen profiles, by destination.
            inside = np.isin(owner, columns)
            place = np.searchsorted(columns, owner[inside])
            dest, value = flat[inside], values[inside]
            order = np.argsort(dest, kind="stable")
            dest, place, value = dest[order], place[order], value[order]
            found, starts = np.unique(dest, return_index=True)
            ends = np.append(starts[1:], len(dest))
            if 4 * len(dest) > len(columns) * len(found):  # well filled: one product
                table = np.zeros((len(columns), len(found)))
                table[place, np.repeat(np.arange(len(found)), ends - starts)] = value
                score = support @ table
            else:
                score = np.empty((len(rows), len(found)))
                for i, (a, b) in enumerate(zip(starts, ends)):
                    score[:, i] = support[:, place[a:b]] @ value[a:b]
            for i, destination in enumerate(found.tolist()):
                held = holds.get(destination)
                if held is not None:
                    score[np.searchsorted(rows, held[np.isin(held, rows)]), i] = 0.0
            total = support.sum(axis=1)
            row, col = np.nonzero(score)
            cuts = np.searchsorted(row, np.arange(1, len(rows)))
            parts = zip(rows, np.split(found[col], cuts), np.split(score[row, col], cuts), total)
            out.extend((sets[r], token, dests, line, whole) for r, dests, line, whole in parts if whole > 0)

        everyone = np.arange(len(left))
        some = np.flatnonzero(uncounted.any(axis=0))
        if len(some):
            offer(_USERS, everyone, uncounted[:, some] * users[some], some, np.ones(len(flat)))
        for token, rows, others, at in common:
            met = uncounted if token in popular else similar
            support = met[np.ix_(rows, others)] * (users[others] * weights[at])
            if support.any():
                offer(token, rows, support, others, weights)
        return pd.DataFrame(out, columns=names)

    return meet


def set_meetings(sets: Sets, popular: list[int], min_shared: int, block_size: int = 1024) -> DataFrame:
    """Per set, token and block: how strongly destinations the set does not hold are tied to that token by
    similar users, and the total weight of these users on it; under token -1 the users themselves are counted.
    What ``mask_strengths`` has is left out.
    """
    left = _indexed(sets.sets, min_shared, block_size, popular).select("pivot", "block", "blocks", "set", "tokens")
    right = _indexed(sets.profiles(), min_shared, block_size, popular)
    others = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    blocks = lambda df, name: df.select("pivot", F.col("blocks").alias(name)).distinct()
    left, right = _stored(left, "left"), _stored(right, "right")
    mine = left.join(blocks(right, "theirs"), "pivot").select("pivot", F.col("block").alias("a"), others("theirs").alias("b"), "set", "tokens")
    met = right.join(blocks(left, "theirs"), "pivot").select(
        F.col("pivot").alias("r_pivot"), others("theirs").alias("r_a"), F.col("block").alias("r_b"),
        F.col("tokens").alias("r_tokens"), "weights", "n",
    )
    mine, met = _spread(mine, "pivot", "a", "b"), _spread(met, "r_pivot", "r_a", "r_b")
    pairs = mine.groupBy("pivot", "a", "b").cogroup(met.groupBy("r_pivot", "r_a", "r_b"))
    return _stored(pairs.applyInPandas(_meet(min_shared, popular), _MEETINGS), "meetings")


def _by_token(value: str):
    """Map token → value; one entry per destination of a set, so small."""
    return F.map_from_entries(F.collect_list(F.struct("token", value)))


def _strengths(sets: Sets, min_shared: int, block_size: int, most_popular: int, candidates: bool) -> DataFrame:
    """Per set, and candidate it does not hold, ``_strengths``: by masks, and by pairs of sets where rarer tokens are shared.

    Without ``candidates`` the candidate is -1 and ``_strengths`` has the similar users' total weights.
    """
    popular = popular_tokens(sets.tokens, min_shared, most_popular)
    by_mask = None
    if popular:
        by_mask = (
            _masked(sets.sets, popular)
            .join(mask_strengths(sets, popular, min_shared, candidates), "mask")
            .filter(~F.array_contains("tokens", F.col("candidate")))
            .select("set", "candidate", "_strengths")
        )
        if len(popular) == sets.tokens.count():
            return by_mask
    met = set_meetings(sets, popular, min_shared, block_size)
    if candidates:
        scores = F.arrays_zip(F.col("destinations").alias("candidate"), F.col("strengths").alias("strength"))
        rows = met.select("set", "token", F.inline(scores))
    else:
        rows = met.select("set", "token", F.lit(_USERS).cast("long").alias("candidate"), F.col("total").alias("strength"))
    if by_mask is not None:
        rows = rows.unionByName(
            by_mask.select("set", "candidate", F.explode("_strengths").alias("token", "strength")).filter(F.col("strength") > 0)
        )
    return (
        rows.groupBy("set", "candidate", "token")
        .agg(F.sum("strength").alias("strength"))
        .groupBy("set", "candidate")
        .agg(_by_token("strength").alias("_strengths"))
    )


def _weighted(strengths: str):
    """Sum of the user's weights times the strength of each of their destinations."""
    return F.aggregate(
        F.arrays_zip("tokens", "weights"),
        F.lit(0.0),
        lambda acc, p: acc
        + p["weights"] * F.coalesce(F.try_element_at(F.col(strengths), p["tokens"]), F.lit(0.0)),
    )


def recommendation_candidates(
    user_destination: DataFrame, min_shared: int = 2, block_size: int = 1024, most_popular: int = MOST_POPULAR
) -> DataFrame:
    """``(user_id, destination, raw_score, supporting_users)`` for unseen destinations."""
    sets = Sets.of(user_destination, min_shared)
    per_set = _strengths(sets, min_shared, block_size, most_popular, candidates=True)
    scored = sets.users.join(per_set, "set").select(
        "user_id",
        F.col("candidate").alias("token"),
        _weighted("_strengths").alias("raw_score"),
        F.round(F.element_at("_strengths", F.lit(_USERS).cast("long"))).cast("long").alias("supporting_users"),
    )
    return scored.join(sets.tokens, "token").select("user_id", "destination", "raw_score", "supporting_users")


def user_similarity(
    user_destination: DataFrame, min_shared: int = 2, block_size: int = 1024, most_popular: int = MOST_POPULAR
) -> DataFrame:
    """How many users are similar to each user, and their summed similarity.

    The pair list itself grows with users² and is not offered; both sums follow from
    the masks' and the sets' meetings. The user's meeting with themselves is taken out again.
    """
    sets = Sets.of(user_destination, min_shared)
    per_set = _strengths(sets, min_shared, block_size, most_popular, candidates=False)
    own = F.aggregate("weights", F.lit(0.0), lambda acc, w: acc + w * w)
    met = F.round(F.element_at("_strengths", F.lit(_USERS).cast("long"))).cast("long")
    return (
        sets.users.join(per_set, "set")
        .select(
            "user_id",
            (met - 1).alias("similar_users"),
            (_weighted("_strengths") - own).alias("similarity_total"),
        )
        .filter(F.col("similar_users") > 0)
    )


def rank_candidates(
    candidates: DataFrame, as_of=None, min_score: float = 1.0, top_n: int = 10
) -> DataFrame:
    """Top destinations per user, scored relative to the user's best survivor.

    The best survivor is rank 1, so the maximum is taken over the kept rows only.
    """
    kept = top_n_per_group(
        candidates.filter(F.col("raw_score") > min_score),
        ["user_id"],
        [F.col("raw_score").desc_nulls_last(), F.col("destination").asc_nulls_last()],
        top_n,
    )
    best = F.max("raw_score").over(Window.partitionBy("user_id"))
    return kept.select(
        "user_id",
        F.col("destination").alias("recommended_destination"),
        F.round(F.col("raw_score") / best, 4).alias("recommendation_score"),
        "supporting_users",
        "rank",
        clock(as_of).alias("generated_at"),
    )


def recommend_user_cf(
    clicks: DataFrame,
    conversions: DataFrame,
    as_of=None,
    min_shared: int = 2,
    min_score: float = 1.0,
    top_n: int = 10,
    block_size: int = 1024,
) -> DataFrame:
    """The recommendation mart."""
    candidates = recommendation_candidates(
        user_destinations(clicks, conversions), min_shared, block_size
    )
    return rank_candidates(candidates, as_of, min_score, top_n)

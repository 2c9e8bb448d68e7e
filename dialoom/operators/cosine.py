"""Exact cosine join inside bins: the earliest partner of each vector.

Three bounds keep pairs away from the exact product, and none loses a pair.  Blocks of
neighbouring vectors are held by balls, and two blocks meet only if the angles allow it.
Inside a pair of blocks only *heads* are multiplied: a rotation puts the most varied
directions first, a head is the leading coordinates in single precision, and by
Cauchy-Schwarz ``x.y <= head(x).head(y) + |tail(x)| |tail(y)|``.  What passes is a pair of
ids, which is tested on the whole vectors in double precision.

The width of a head is chosen on a bounded sample, as the narrowest at which few pairs
pass in vain.  Sample, rotation and width decide how much work there is, never the result.
"""

from __future__ import annotations

import math
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as t

from dialoom.functions import vectors as V
from dialoom.operators.ranking import rank_by_range
from dialoom.session import stage_table

_PLANES = 48
_PLANE_SEED = 5
_BLOCKS_PER_GROUP = 256
_BALLS = 16
_NEAR_COSINE = 0.98
_SLICE_ROWS = 512
DEFAULT_TILE_ROWS = 1024
#: Vectors on which rotation and width of the heads are chosen.
SAMPLE_ROWS = 1024
#: Share of the sample's pairs that may pass the bound in vain.
VAIN_SHARE = 0.002
#: Single precision errs by less than this on products of unit vectors.
_SLACK = 1e-4
_BLOCK_BYTES = 4 << 20
_CELL_BYTES = 32 << 20
#: Candidates of a row and cell in the first round; later rounds take more each.
_FIRST_CANDIDATES = 2
_ROUND_FACTOR = 16
_HELD_CANDIDATES = 1 << 21
_TESTS_PER_SALT = 50_000


@F.pandas_udf(t.LongType())
def _signature(units: pd.Series) -> pd.Series:
    """On which side of each of a few fixed planes a vector lies.  Near vectors share most
    of the leading bits, so an order by signature puts them close together."""
    if not len(units):
        return pd.Series([], dtype="int64")
    unit = np.stack(units.to_numpy()).astype(np.float64, copy=False)
    planes = np.random.default_rng(_PLANE_SEED).normal(size=(unit.shape[1], _PLANES))
    return pd.Series(((unit @ planes) > 0) @ (1 << np.arange(_PLANES)[::-1]))


def _balls(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most ``_BALLS`` directions and angles that hold all vectors: each next direction is
    the vector farthest from those before, until all are near one.  A zero vector is near
    nothing and needs no ball."""
    directed = unit[np.linalg.norm(unit, axis=1) > 0.5]
    if not len(directed):
        return np.zeros((0, unit.shape[1])), np.zeros(0)
    centers = [directed[0]]
    best = directed @ centers[0]
    home = np.zeros(len(directed), dtype=int)
    while len(centers) < _BALLS and best.min() < _NEAR_COSINE:
        centers.append(directed[best.argmin()])
        cosines = directed @ centers[-1]
        closer = cosines > best
        home[closer], best[closer] = len(centers) - 1, cosines[closer]
    angles = np.arccos(np.clip(best, -1, 1))
    return np.stack(centers), np.array([angles[home == k].max() for k in range(len(centers))])


def choose_heads(vectors: DataFrame, threshold: float) -> np.ndarray | None:
    """Matrix that turns a unit vector into its head; ``None`` if there are no vectors.

    Directions come from one half of a bounded sample, the width from the other half.
    """
    n = vectors.count()
    every = max(n // SAMPLE_ROWS, 1)
    drawn = vectors.where(F.pmod(F.xxhash64("conv_id"), F.lit(every)) == 0).select("unit")
    sample = drawn.limit(SAMPLE_ROWS).collect() or vectors.select("unit").limit(1).collect()
    if not sample:
        return None
    unit = np.array([r.unit for r in sample])
    fitted, held = unit[::2], unit[1::2]
    _, directions = np.linalg.eigh(fitted.T @ fitted)
    rotation = directions[:, ::-1]
    above = np.triu(np.ones((len(held), len(held)), dtype=bool), 1)
    apart = above & (held @ held.T <= threshold)
    rotated = held @ rotation
    width, dimensions = 8, unit.shape[1]
    while width < dimensions:
        tails = np.linalg.norm(rotated[:, width:], axis=1)
        bound = rotated[:, :width] @ rotated[:, :width].T + np.outer(tails, tails)
        if (apart & (bound > threshold - _SLACK)).sum() <= VAIN_SHARE * above.sum():
            break
        width *= 2
    return rotation[:, : min(width, dimensions)]


def _pack(rotation: np.ndarray):
    """A block as one row: ids, sizes, heads and lengths of the tails, and balls that hold
    the vectors.  ``late`` marks the rows whose partners are asked for."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        unit = np.stack(rows["unit"].to_numpy()).astype(np.float64, copy=False)
        centers, radii = _balls(unit)
        heads = unit @ rotation
        tails = np.sqrt(np.maximum((unit**2).sum(axis=1) - (heads**2).sum(axis=1), 0))
        return pd.DataFrame(
            {
                "bin": [rows["bin"].iat[0]],
                "block": [rows["block"].iat[0]],
                "centers": [centers.tobytes()],
                "radii": [radii.tolist()],
                "ids": [rows["conv_id"].tolist()],
                "sizes": [rows["nbytes"].tolist()],
                "late": [rows["late"].tolist()],
                "heads": [heads.astype(np.float32).tobytes()],
                "tails": [tails.astype(np.float32).tolist()],
            }
        )

    return pack


def _blocks(rows: DataFrame, tile_rows: int, rotation: np.ndarray) -> DataFrame:
    """Cut each bin, in the order of signatures, into blocks of ``tile_rows`` vectors.

    Only bin, signature and id are sorted; the vectors follow in one join, and the head of
    each is written once, in the row of its block.
    """
    ranked = rank_by_range(
        rows.select("bin", _signature("unit").alias("signature"), "conv_id"),
        ["bin", "signature", "conv_id"],
    )
    # one row per bin, written so that the planner knows its size and leaves large bins spread
    firsts = stage_table(ranked.groupBy("bin").agg(F.min("rank").alias("first")), "firsts")
    placed = ranked.join(firsts, "bin").select(
        "bin", "conv_id", F.floor((F.col("rank") - F.col("first")) / tile_rows).alias("block")
    )
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    packed = (
        rows.join(placed, ["bin", "conv_id"])
        .groupBy("bin", "block")
        .applyInPandas(
            _pack(rotation),
            f"bin {kinds['bin']}, block bigint, centers binary, radii array<double>, "
            f"ids array<{kinds['conv_id']}>, sizes array<bigint>, late array<boolean>, "
            "heads binary, tails array<float>",
        )
    )
    return stage_table(packed, "blocks")


def _all_balls(blocks: pd.DataFrame):
    """Centres and radii of the balls of some blocks, and where those of each begin."""
    counts = np.array([len(r) for r in blocks["radii"]])
    radii = np.concatenate([np.asarray(r, dtype=float) for r in blocks["radii"]])
    centers = np.frombuffer(b"".join(blocks["centers"]), np.float64)
    begins = np.concatenate(([0], np.cumsum(counts)[:-1]))
    return centers.reshape(len(radii), -1), radii, begins


def _near_blocks(threshold: float):
    """Block pairs of two groups of blocks that can hold a pair above the threshold.

    Two vectors within ``acos(threshold)`` lie in balls whose centres are within that angle
    and both radii (angles are a metric), so no pair is lost.
    """
    reach = math.acos(threshold) + 1e-7 if threshold >= 0 else math.inf

    def run(groups: pd.DataFrame) -> pd.DataFrame:
        if reach < math.inf:  # below an angle, a block of zero vectors meets nothing
            groups = groups[groups["radii"].map(len) > 0]
        left = groups[groups["side"] == 0]
        right = groups[groups["side"] == 1] if (groups["g"] != groups["h"]).any() else left
        if not len(left) or not len(right):
            return pd.DataFrame({"bin": [], "a": [], "b": []})
        if reach < math.inf:
            a, wide_a, at_a = _all_balls(left)
            b, wide_b, at_b = _all_balls(right)
            near = np.arccos(np.clip(a @ b.T, -1, 1)) <= wide_a[:, None] + wide_b[None, :] + reach
            near = np.logical_or.reduceat(np.logical_or.reduceat(near, at_a, axis=0), at_b, axis=1)
        else:
            near = np.ones((len(left), len(right)), dtype=bool)
        rows, columns = np.nonzero(near)
        first, second = left["block"].to_numpy()[rows], right["block"].to_numpy()[columns]
        keep = first <= second
        return pd.DataFrame({"bin": left["bin"].iat[0], "a": first[keep], "b": second[keep]})

    return run


def _block_pairs(blocks: DataFrame, threshold: float) -> DataFrame:
    """``(bin, a, b)``, ``a <= b``: only numbers, balls and radii of blocks take part.

    A bin of very many blocks is cut into groups of them, and the groups are paired.
    """
    meta = blocks.select("bin", "block", "centers", "radii").withColumn(
        "own", F.floor(F.col("block") / _BLOCKS_PER_GROUP)
    )
    groups = meta.groupBy("bin").agg(F.max("own").alias("last"))
    sided = meta.join(groups, "bin")
    as_left = F.transform(
        F.sequence("own", "last"), lambda g: F.struct(F.col("own").alias("g"), g.alias("h"), F.lit(0).alias("side"))
    )
    as_right = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("own")),
        lambda g: F.struct(g.alias("g"), F.col("own").alias("h"), F.lit(1).alias("side")),
    )
    met = sided.withColumn(
        "at", F.explode(F.concat(as_left, F.filter(as_right, lambda p: p["g"] < p["h"])))
    ).select("bin", "block", "centers", "radii", "at.*")
    kind = blocks.schema["bin"].dataType.simpleString()
    pairs = met.groupBy("bin", "g", "h").applyInPandas(
        _near_blocks(threshold), f"bin {kind}, a bigint, b bigint"
    )
    return stage_table(pairs, "block-pairs")


def _cells(pairs: DataFrame, per_cell: int) -> DataFrame:
    """``(bin, g, h, block, mates)``: block pairs are dealt to cells of ``per_cell`` by
    ``per_cell`` blocks, and a block is sent once to each cell that it has a pair in."""
    placed = pairs.select(
        "bin",
        F.floor(F.col("a") / per_cell).alias("g"),
        F.floor(F.col("b") / per_cell).alias("h"),
        "a",
        "b",
    )
    cell = ["bin", "g", "h"]
    sided = placed.select(*cell, F.col("a").alias("block"), F.col("b").alias("mate")).unionByName(
        placed.where("a <> b").select(
            *cell, F.col("b").alias("block"), F.lit(None).cast("bigint").alias("mate")
        )
    )
    # nulls are not collected; at most ``per_cell`` mates
    return sided.groupBy(*cell, "block").agg(F.collect_list("mate").alias("mates"))


class _Candidates:
    """Pairs ``(late, early)`` of places in a cell; the first few of each late one stay."""

    def __init__(self, limit: int):
        self.limit, self.held, self.parts = limit, 0, []

    def add(self, late: np.ndarray, early: np.ndarray) -> None:
        if len(late):
            self.parts.append((late, early))
            self.held += len(late)
            if self.held > _HELD_CANDIDATES:
                late, early, _ = self.firsts()
                self.parts, self.held = [(late, early)], len(late)

    def firsts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Late places, early places and number among the candidates of the late place."""
        if not self.parts:
            nothing = np.zeros(0, dtype=np.int64)
            return nothing, nothing, nothing
        late, early = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.lexsort((early, late))
        late, early = late[order], early[order]
        begins = np.flatnonzero(np.concatenate(([True], late[1:] != late[:-1])))
        number = np.arange(len(late)) - np.repeat(begins, np.diff(np.append(begins, len(late))))
        kept = number < self.limit
        return late[kept], early[kept], number[kept]


def _search(threshold: float, skip: int, take: int):
    """Candidates of a cell: for each late row the earlier rows that pass the bound, from
    number ``skip`` on at most ``take``; ``more`` says that there are further ones."""

    def run(cell: pd.DataFrame) -> pd.DataFrame:
        lengths = [len(x) for x in cell["ids"]]
        begins = np.concatenate(([0], np.cumsum(lengths)))
        ids = np.concatenate([np.asarray(x, dtype=object) for x in cell["ids"]])
        sizes = np.concatenate([np.asarray(x, dtype=np.int64) for x in cell["sizes"]])
        block = np.repeat(cell["block"].to_numpy(), lengths)
        if skip:
            asked = {i for x in cell["open"] if x is not None for i in x}
            late = np.fromiter((i in asked for i in ids), dtype=bool, count=len(ids))
        else:
            late = np.concatenate([np.asarray(x, dtype=bool) for x in cell["late"]])
        order = np.array(sorted(range(len(ids)), key=lambda i: (sizes[i], ids[i])))
        place = np.empty(len(ids), dtype=np.int64)
        place[order] = np.arange(len(ids))
        heads = [
            np.frombuffer(x, np.float32).reshape(n, -1)
            for x, n in zip(cell["heads"], lengths, strict=True)
        ]
        tails = [np.asarray(x, dtype=np.float32) for x in cell["tails"]]
        at = {b: k for k, b in enumerate(cell["block"])}
        kept = _Candidates(skip + take + 1)
        for k, mates in enumerate(cell["mates"]):
            for m in (at[b] for b in mates):
                other = slice(begins[m], begins[m + 1])
                if not (late[other].any() or late[begins[k] : begins[k + 1]].any()):
                    continue
                for start in range(0, lengths[k], _SLICE_ROWS):
                    part = slice(start, start + _SLICE_ROWS)
                    bound = heads[k][part] @ heads[m].T
                    bound += np.outer(tails[k][part], tails[m])
                    one, two = np.nonzero(bound > threshold - _SLACK)
                    one, two = one + begins[k] + start, two + begins[m]
                    # a block that meets itself yields each pair in both directions
                    first, second = place[one], place[two]
                    forward = (first < second) & late[two]
                    kept.add(second[forward], first[forward])
                    if k != m:
                        back = (first > second) & late[one]
                        kept.add(first[back], second[back])
        later, early, number = kept.firsts()
        further = np.zeros(len(ids), dtype=bool)
        further[later[number == skip + take]] = True
        sent = (number >= skip) & (number < skip + take)
        later, early = later[sent], early[sent]
        return pd.DataFrame(
            {
                "bin": cell["bin"].iat[0],
                "g": cell["g"].iat[0],
                "h": cell["h"].iat[0],
                "block": block[order[later]],
                "conv_id": ids[order[later]],
                "partner_nbytes": sizes[order[early]],
                "partner_id": ids[order[early]],
                "more": further[later],
            }
        )

    return run


def _tested(candidates: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """``candidates`` with ``hit``: whether the whole vectors are above the threshold.

    The first of a group of near copies is the candidate of all others, so an id that is
    named very often is spread over salts, by its number.
    """
    units = vectors.select("conv_id", "unit")
    hot = stage_table(
        candidates.groupBy("partner_id")
        .agg((F.floor(F.count(F.lit(1)) / _TESTS_PER_SALT) + 1).alias("salts"))
        .where("salts > 1"),
        "hot-partners",
    )
    early = (
        units.withColumnsRenamed({"conv_id": "partner_id", "unit": "early"})
        .join(hot, "partner_id", "left")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
        .drop("salts")
    )
    salted = (
        candidates.join(hot, "partner_id", "left")
        .withColumn("salt", F.pmod(F.xxhash64("conv_id"), F.coalesce("salts", F.lit(1))))
        .drop("salts")
    )
    whole = salted.join(units, "conv_id").join(early, ["partner_id", "salt"])
    hit = V.dot(F.col("unit"), F.col("early")) > threshold
    return whole.select(*candidates.columns, hit.alias("hit"))


def earliest_partners(
    vectors: DataFrame, threshold: float, tile_rows: int = DEFAULT_TILE_ROWS
) -> tuple[DataFrame, DataFrame]:
    """``(conv_id, partner_nbytes, partner_id)``: the earliest row, by size and id, of the
    same bin whose product with an earlier-asking row is above the threshold; and all pairs
    that were tested on whole vectors.

    ``vectors`` is a written table ``(bin, conv_id, nbytes, unit, late)`` of unit or zero
    vectors; only rows with ``late`` ask.  A cell sends the first few candidates of a row.
    Rows none of which holds, and that have more, ask again for the next ones, so a row has
    either its earliest partner in each cell or no candidate left; a group of near copies
    costs a few tests per row and cell.
    """
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}
    schema = (
        f"bin {kinds['bin']}, g bigint, h bigint, block bigint, conv_id {kinds['conv_id']}, "
        f"partner_nbytes bigint, partner_id {kinds['conv_id']}, more boolean"
    )
    rotation = choose_heads(vectors, threshold)
    if rotation is None:
        tested = vectors.sparkSession.createDataFrame([], f"{schema}, hit boolean")
        return tested.select("conv_id", "partner_nbytes", "partner_id"), tested
    row_bytes = 4 * rotation.shape[1]
    tile_rows = max(min(tile_rows, _BLOCK_BYTES // row_bytes), 1)
    blocks = _blocks(vectors, tile_rows, rotation)
    cells = _cells(
        _block_pairs(blocks, threshold), max(_CELL_BYTES // (tile_rows * row_bytes), 1)
    )
    packed = blocks.drop("centers", "radii")
    cell, member = ["bin", "g", "h"], ["bin", "g", "h", "block"]
    wanted, skip, take = cells, 0, _FIRST_CANDIDATES
    rounds = []
    while True:
        sent = (
            wanted.join(packed, ["bin", "block"])
            .groupBy(*cell)
            .applyInPandas(_search(threshold, skip, take), schema)
        )
        candidates = stage_table(sent, "candidates")
        rounds.append(stage_table(_tested(candidates, vectors, threshold), "tested"))
        asking = (
            rounds[-1]
            .groupBy(*member, "conv_id")
            .agg(F.max("hit").alias("hit"), F.max("more").alias("more"))
            .where("more AND NOT hit")
        )
        asking = stage_table(
            asking.groupBy(*member).agg(F.collect_list("conv_id").alias("open")), "asking"
        )
        if asking.isEmpty():
            break
        wanted = cells.join(asking, member, "left").join(
            asking.select(*cell).distinct(), cell, "left_semi"
        )
        skip, take = skip + take, take * _ROUND_FACTOR
    tested = rounds[0]
    for more in rounds[1:]:
        tested = tested.unionByName(more)
    found = (
        tested.where("hit")
        .groupBy("conv_id")
        .agg(F.min(F.struct("partner_nbytes", "partner_id")).alias("partner"))
        .select("conv_id", "partner.partner_nbytes", "partner.partner_id")
    )
    return found, tested

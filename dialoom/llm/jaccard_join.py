"""N-gram Jaccard join: size-banded tiles, bitmap signatures, exact intersection."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialoom.llm.common import narrow, with_flag
from dialoom.llm.components import connected_components
from dialoom.llm.wordhash import mix, word_chunks
from dialoom.session import Stages, small_batches, stage_table

_HOT = 32  # rows of one key in one chunk of a task, from which they get a group of their own
_CHUNK_ROWS = 1 << 18
_SKETCH_BITS = 512
_HUBS = 4  # stars that a set is tested at before components are looked at
_STAR_ROUNDS = 3  # rounds of stars across components
_MORE_HUBS = 8  # stars that a set is tested at in one of these
_MEMBERS_PER_TASK = 2000
_SLOT_BITS = (16, 22)  # least and most: the table of counts takes 4 MB at most
_SLOTS_PER_SET = 16
_PART_BITS = 14  # slots of one part of the table
_LEVELS = 8  # levels from a count to its double


@dataclass(frozen=True)
class JaccardOptions:
    """Two sets link when ``100 * intersection >= percent * union``."""

    shingle: int = 5
    percent: int = 80
    common: int = 6
    band: float = 0.7

    @property
    def ratio(self) -> float:
        """Smallest size of a band over the largest, a little less than linked sets can
        differ by: these are one band apart at most, whatever the rounding."""
        return 0.99 * min(self.band, self.percent / 100)

    def least_overlap(self, n: int) -> int:
        """Elements that a set of ``n`` shares with any linked set."""
        return -(-self.percent * n // 100)

    def shared_keys(self, n: int) -> int:
        """Keys that a set of ``n`` shares with any linked set."""
        return min(self.common + 1, self.least_overlap(n))


def shingle_sets(texts, options: JaccardOptions) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, set)``: the sorted distinct shingle hashes of each text.  A text of fewer
    words has its whole sequence as the only one; without words the set is empty."""
    n = options.shingle
    for chunk in word_chunks(texts, lower_ascii=True):
        runs = chunk.runs(n)
        short: dict[int, np.ndarray] = {}
        for d, row in enumerate(chunk.rows):
            a, b = int(chunk.first[d]), int(chunk.first[d + 1])
            if b - a >= n:
                yield row, np.unique(runs[a : b - n + 1])
            elif b > a:
                size = b - a
                if size not in short:
                    short[size] = chunk.runs(size)
                yield row, short[size][a : a + 1]
            else:
                yield row, np.zeros(0, dtype=np.uint64)


def set_identity(s: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit sums over the elements."""
    one, two = mix(s), mix(s ^ np.uint64(0x5851F42D4C957F2D))
    return tuple(
        int(x.sum(dtype=np.uint64).astype(np.int64)) for x in (one + np.uint64(1), two)
    )


def tile_of(n: int, o: JaccardOptions) -> int:
    """The band of sizes that ``n`` is in: linked sets are in one or in neighbouring ones."""
    return int(math.log(n) / -math.log(o.ratio))


def prefix_order(s: np.ndarray, levels: np.ndarray, o: JaccardOptions) -> np.ndarray:
    """The keys of a set: its rarest elements, in one order for all sets.

    The order is the level of an element, then its hash.  Of a set of ``n`` elements the last
    ``least_overlap(n) - 1 - common`` are left out.  Take the ``common + 1`` first elements
    that two linked sets share (or all, if these are fewer): from the last of these on, each
    set holds ``least_overlap - common`` shared ones at least, so it is not among those left
    out, and neither are those before it.  Any order will do; the rarest first keep lines and
    passages that many texts share out of the keys.
    """
    shift = np.uint64(64 - (len(levels).bit_length() - 1))
    order = np.argsort(levels[(s >> shift).astype(np.int64)], kind="stable")
    return s[order[: min(len(s), len(s) - o.least_overlap(len(s)) + 1 + o.common)]]


def _count_shingles(o: JaccardOptions, bits: int):
    """How often the shingles of a task fall in each slot of the hash space, 255 at most.
    Parts of the table without any are not sent."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(1 << bits, np.uint32)
        for batch in batches:
            for chunk in word_chunks(batch["text"], lower_ascii=True):
                runs = chunk.runs(o.shingle)
                np.add.at(counts, (runs >> np.uint64(64 - bits)).astype(np.int64), np.uint32(1))
        parts = np.minimum(counts, 255).astype(np.uint8).reshape(-1, 1 << _PART_BITS)
        for part in np.flatnonzero(parts.any(axis=1)):
            yield pd.DataFrame({"part": [int(part)], "counts": [parts[part].tobytes()]})

    return run


def _total_levels(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums rows that come in the order of their part, and takes logarithms."""
    part, total = None, None

    def done() -> pd.DataFrame:
        levels = np.minimum(np.rint(_LEVELS * np.log2(total + 1.0)), 255).astype(np.uint8)
        return pd.DataFrame({"part": [part], "levels": [levels.tobytes()]})

    for batch in batches:
        for r in batch.itertuples(index=False):
            if r.part != part:
                if part is not None:
                    yield done()
                part, total = r.part, np.zeros(1 << _PART_BITS, np.int64)
            total += np.frombuffer(r.counts, np.uint8)
    if part is not None:
        yield done()


def shingle_levels(rows: DataFrame, sets: int, o: JaccardOptions) -> np.ndarray:
    """Logarithms of approximate counts of shingles, a byte per slot of the hash space, in
    steps fine enough to tell a slot with one shingle of a few texts from its like.

    The table has about 16 slots a set, 2^22 at most: it is what the driver gets and tasks
    are sent.  It decides what work is done, not what is found.
    """
    low, high = _SLOT_BITS
    bits = min(high, max(low, (_SLOTS_PER_SET * sets).bit_length()))
    counted = rows.select("text").mapInPandas(_count_shingles(o, bits), "part int, counts binary")
    summed = counted.repartition("part").sortWithinPartitions("part")
    levels = np.zeros((1 << (bits - _PART_BITS), 1 << _PART_BITS), np.uint8)
    for r in summed.mapInPandas(_total_levels, "part int, levels binary").collect():
        levels[r.part] = np.frombuffer(r.levels, np.uint8)
    return levels.ravel()


def bitmap(s: np.ndarray, bits: int | None = None) -> np.ndarray:
    """Hashed bitmap of a set, as 64-bit words; about a bit per element if not told else."""
    if bits is None:
        bits = 64 << max(0, math.ceil(math.log2(max(1, len(s)) / 64)))
    flags = np.zeros(bits, dtype=bool)
    flags[(s & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").view(np.uint64)


def _folded(b: np.ndarray, words: int) -> np.ndarray:
    return np.bitwise_or.reduce(b.reshape(-1, words), axis=0)


def may_link(n: int, x: np.ndarray, m: int, y: np.ndarray, percent: int) -> bool:
    """Bound from two bitmaps.  A bit set in one only stands for an element at least that
    the other set lacks, which bounds the intersection from above.  The wider bitmap is
    folded to the width of the other."""
    need = -(-percent * (n + m) // (100 + percent))
    words = min(len(x), len(y))
    x, y = _folded(x, words), _folded(y, words)
    only_x = int(np.bitwise_count(x & ~y).sum())
    only_y = int(np.bitwise_count(y & ~x).sum())
    return min(n - only_x, m - only_y) >= need


def links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact test of two sorted sets."""
    need = -(-percent * (len(a) + len(b)) // (100 + percent))
    if not len(a) or not len(b) or min(len(a), len(b)) < need:
        return False
    return len(np.intersect1d(a, b, assume_unique=True)) >= need


def _identities(o: JaccardOptions):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n = np.zeros(len(batch), np.int64)
            one, two = n.copy(), n.copy()
            bits, sketch = np.empty(len(batch), dtype=object), np.empty(len(batch), dtype=object)
            for row, s in shingle_sets(batch["text"], o):
                n[row], bits[row] = len(s), bitmap(s).tobytes()
                sketch[row] = bitmap(s, _SKETCH_BITS).view(np.int64).tolist()
                one[row], two[row] = set_identity(s)
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"], "n": n, "set_id": one, "check": two,
                    "bits": bits, "sketch": sketch,
                }
            )

    return run


def _vertex(identity: tuple[int, int], clashes: frozenset[int]) -> int:
    """One number for a set: the first sum, or both if several sets have this one."""
    return identity[0] ^ identity[1] if identity[0] in clashes else identity[0]


def _signatures(o: JaccardOptions, shipped, clashes: frozenset[int]):
    """``(root, part, tile, set_id, n, place)``: the keys of each set.  Equal sets of a task
    are sent once.  A key that many sets of a tile share in a chunk forms a group of its own
    there, with one leader in the common group: no group then holds more than a chunk or a
    few rows per chunk."""

    def flush(keys: list[np.ndarray], ids: list[int], sizes: list[int]) -> pd.DataFrame:
        lengths = [len(k) for k in keys]
        owner = np.repeat(np.array(ids, np.int64), lengths)
        n = np.repeat(np.array(sizes, np.int32), lengths)
        tile = np.repeat(np.array([tile_of(x, o) for x in sizes], np.int32), lengths)
        place = np.concatenate([np.arange(x, dtype=np.int32) for x in lengths])
        key = np.concatenate(keys).view(np.int64)
        order = np.lexsort((owner, tile, key))
        key, tile, owner, n, place = key[order], tile[order], owner[order], n[order], place[order]
        fresh = (key[1:] != key[:-1]) | (tile[1:] != tile[:-1])
        begin = np.flatnonzero(np.concatenate(([True], fresh)))
        size = np.diff(np.concatenate((begin, [len(key)])))
        hot = np.repeat(size >= _HOT, size)
        part = np.zeros(len(key), np.int64)
        # named by its first member, so a run again names it alike
        part[hot] = np.repeat(owner[begin], size)[hot] | 1
        row = np.concatenate((np.arange(len(key)), begin[size >= _HOT]))
        part = np.concatenate((part, np.zeros(len(row) - len(part), np.int64)))
        return pd.DataFrame(
            {
                "root": key[row], "part": part, "tile": tile[row],
                "set_id": owner[row], "n": n[row], "place": place[row],
            }
        )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        levels = np.frombuffer(shipped.value, np.uint8)
        keys, ids, sizes, rows, seen = [], [], [], 0, set()
        for batch in batches:
            for _, s in shingle_sets(batch["text"], o):
                if not len(s):
                    continue
                identity = set_identity(s)
                if identity in seen:
                    continue
                if len(seen) >= 1 << 20:
                    seen.clear()
                seen.add(identity)
                keys.append(prefix_order(s, levels, o))
                ids.append(_vertex(identity, clashes))
                sizes.append(len(s))
                rows += len(keys[-1])
                if rows >= _CHUNK_ROWS:
                    yield flush(keys, ids, sizes)
                    keys, ids, sizes, rows = [], [], [], 0
        if keys:
            yield flush(keys, ids, sizes)

    return run


def _ship(o: JaccardOptions, clashes: frozenset[int]):
    """Sends the set of a text to the hubs that it is compared at."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row, s in shingle_sets(batch["text"], o):
                identity = batch["set_id"].iat[row]
                if _vertex(set_identity(s), clashes) != identity:
                    continue  # another row with this id
                jobs = batch["jobs"].iat[row]
                yield pd.DataFrame(
                    {
                        "hub": [j["hub"] for j in jobs],
                        "salt": [j["salt"] for j in jobs],
                        "member": [j["hub"] != identity for j in jobs],
                        "set_id": identity,
                        "elements": [s.tobytes()] * len(jobs),
                    }
                )

    return run


def _compare(o: JaccardOptions):
    """Reads a hub, then its members one by one: one set is held at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hub, hub_set = None, None
        for batch in batches:
            u, v = [], []
            for r in batch.itertuples(index=False):
                s = np.frombuffer(r.elements, np.uint64)
                if not r.member:
                    hub, hub_set = r.hub, s.copy()
                elif r.hub == hub and links(hub_set, s, o.percent):
                    u.append(r.hub)
                    v.append(r.set_id)
            yield pd.DataFrame({"u": np.array(u, np.int64), "v": np.array(v, np.int64)})

    return run


def _within_bound(percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = [
                may_link(
                    r.n, np.frombuffer(r.bits, np.uint64), r.hub_n, np.frombuffer(r.hub_bits, np.uint64), percent
                )
                for r in batch.itertuples(index=False)
            ]
            yield batch.loc[np.array(keep, dtype=bool), ["set_id", "hub"]]

    return run


def _flagged(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose id may be among those of ``wanted``, nearly always a few.  A join by id
    alone would shuffle every text to find them."""
    flagged = with_flag(rows, "doc_id", wanted.select("doc_id"), "may_be_wanted")
    return flagged.filter("may_be_wanted").drop("may_be_wanted")


def _bounded(pairs: DataFrame, classes: DataFrame, o: JaccardOptions) -> DataFrame:
    """The pairs ``(set_id, hub)`` whose bitmaps allow a link: an eighth of a byte per
    element moves, and no set yet."""
    own = classes.select("set_id", "n", "bits")
    hubs = classes.select(F.col("set_id").alias("hub"), F.col("n").alias("hub_n"), F.col("bits").alias("hub_bits"))
    sized = pairs.join(own, "set_id").join(hubs, "hub")
    smaller, larger = F.least("n", "hub_n"), F.greatest("n", "hub_n")
    near = sized.filter(smaller * 100 >= larger * o.percent)
    return stage_table(
        near.mapInPandas(_within_bound(o.percent), "set_id bigint, hub bigint"), "bounded"
    )


def _verify(
    pairs: DataFrame, classes: DataFrame, rows: DataFrame, o: JaccardOptions, clashes: frozenset[int]
) -> DataFrame:
    """Links ``(u, v)`` among the pairs ``(set_id, hub)``.

    Pairs that the bitmaps rule out go first.  Of the rest a text is read once and its set
    sent to each of its hubs.  A hub with many members is cut by salts, and its own set goes
    to each of them.
    """
    pairs = _bounded(pairs, classes, o)
    sizes = pairs.groupBy("hub").agg(F.count(F.lit(1)).alias("n"))
    salted = sizes.select("hub", (F.floor(F.col("n") / _MEMBERS_PER_TASK) + 1).alias("salts"))
    members = pairs.join(salted, "hub").select(
        "set_id", "hub", F.pmod(F.xxhash64("set_id"), F.col("salts")).alias("salt")
    )
    hubs = salted.select(
        F.col("hub").alias("set_id"), "hub", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    )
    jobs = (
        members.unionByName(hubs)
        .groupBy("set_id")
        .agg(F.collect_list(F.struct("hub", "salt")).alias("jobs"))
    )
    wanted = stage_table(
        jobs.join(classes.select("set_id", F.col("first_id").alias("doc_id")), "set_id"), "wanted"
    )
    texts = _flagged(rows, wanted).join(wanted, "doc_id").select("text", "set_id", "jobs")
    shipped = texts.mapInPandas(
        _ship(o, clashes), "hub bigint, salt bigint, member boolean, set_id bigint, elements binary"
    )
    met = shipped.repartition("hub", "salt").sortWithinPartitions("hub", "salt", "member")
    return stage_table(met.mapInPandas(_compare(o), "u bigint, v bigint"), "links")


def _most_shared() -> Column:
    """The bound of ``may_link`` on two bitmaps of one width: elements that ``a`` and ``b``
    share at most."""

    def only(x: str, y: str) -> Column:
        missing = F.zip_with(x, y, lambda i, j: F.bit_count(i.bitwiseAND(F.bitwise_not(j))))
        return F.aggregate(missing, F.lit(0), lambda total, k: total + k)

    return F.least(F.col("na") - only("sa", "sb"), F.col("nb") - only("sb", "sa")).cast("long")


def _enough(shared: Column, o: JaccardOptions) -> Column:
    """Whether so many shared elements make a link of ``a`` and ``b``."""
    return shared * (100 + o.percent) >= (F.col("na") + F.col("nb")).cast("long") * o.percent


def _side(x: str, *more: str) -> list[Column]:
    names = {"set_id": x, "n": f"n{x}", "sketch": f"s{x}", **{m: f"{m}_{x}" for m in more}}
    return [F.col(k).alias(v) for k, v in names.items()]


def _shared_keys(o: JaccardOptions) -> Column:
    """``JaccardOptions.shared_keys`` of the column ``n``."""
    return F.least(F.lit(o.common + 1).cast("long"), F.expr(f"(n * {o.percent}L + 99) div 100"))


_MEMBER = ("root", "part", "tile", "set_id", "n", "place")


def _core(shared: DataFrame, o: JaccardOptions, tables: Stages) -> DataFrame:
    """``shared`` without the sets that cannot link: a set that shares too few keys with all
    others together has no link.  What such sets leave behind as keys of one set goes too."""
    own = Window.partitionBy("set_id")
    fresh = F.coalesce(F.col("root") != F.lag("root").over(own.orderBy("root")), F.lit(True))
    left = tables.table(
        shared.withColumn("fresh", fresh.cast("long"))
        .withColumn("keys", F.sum("fresh").over(own))
        .filter(F.col("keys") >= _shared_keys(o))
        .select(*_MEMBER),
        "strong",
    )
    met = (
        left.groupBy("root")
        .agg((F.min("set_id") < F.max("set_id")).alias("met"))
        .filter("met")
        .select("root")
    )
    tables.release(shared)
    core = tables.table(left.join(met, "root").select(*_MEMBER), "core")
    tables.release(left)
    return core


def _open(members: DataFrame, parts: DataFrame, tables: Stages) -> DataFrame:
    """The members, with their component, of the keys whose sets are in several ones.

    Components only grow, so a key that is left out stays out.
    """
    labelled = tables.table(
        members.select("root", "tile", "set_id", "n", "place")
        .join(parts.withColumnRenamed("vertex", "set_id"), "set_id", "left")
        .withColumn("component", F.coalesce("component", "set_id")),
        "labelled",
    )
    mixed = (
        labelled.groupBy("root")
        .agg((F.min("component") < F.max("component")).alias("mixed"))
        .filter("mixed")
        .select("root")
    )
    left = tables.table(labelled.join(mixed, "root"), "open")
    tables.release(labelled)
    return left


def _untested(crossed: DataFrame, pairs: DataFrame) -> DataFrame:
    """``crossed`` without the pairs that are among ``pairs``, either way round."""
    low, high = F.least("set_id", "hub"), F.greatest("set_id", "hub")
    tested = pairs.select(low.alias("x"), high.alias("y"))
    return crossed.join(tested, (F.col("x") == low) & (F.col("y") == high), "left_anti")


def _star_pairs(
    open_rows: DataFrame, classes: DataFrame, pairs: DataFrame, number: int, o: JaccardOptions
) -> DataFrame:
    """Pairs ``(set_id, hub)``: a set and hubs of its keys and tile in other components.

    Each key draws its hub anew in each round, and of its hubs a set takes the few whose
    bitmaps are most like its own: in a group that hangs together loosely most are too far.
    """
    draw = F.struct(F.xxhash64("root", "set_id", F.lit(number)).alias("draw"), "set_id", "component")
    hubs = (
        open_rows.groupBy("root", "tile")
        .agg(F.min(draw).alias("hub"))
        .select("root", "tile", F.col("hub.set_id").alias("hub"), F.col("hub.component").alias("other"))
    )
    met = open_rows.join(hubs, ["root", "tile"]).filter("component <> other")
    met = _untested(met.select("set_id", "hub").distinct(), pairs)
    own = classes.select(F.col("set_id"), *_side("a")[1:])
    others = classes.select(*_side("b")).withColumnRenamed("b", "hub")
    rated = met.join(own, "set_id").join(others, "hub").withColumn("most", _most_shared())
    likeness = (F.col("most") / (F.col("na") + F.col("nb"))).alias("likeness")
    best = F.sort_array(F.collect_list(F.struct(likeness, "hub")), asc=False)
    chosen = rated.filter(_enough(F.col("most"), o)).groupBy("set_id").agg(
        F.slice(best, 1, _MORE_HUBS)["hub"].alias("hubs")
    )
    return chosen.select("set_id", F.explode("hubs").alias("hub"))


def _all_pairs(
    open_rows: DataFrame, classes: DataFrame, pairs: DataFrame, o: JaccardOptions, tables: Stages
) -> DataFrame:
    """Pairs ``(set_id, hub)`` of all sets that share a key and are in different components.

    Sizes, places and bitmaps are held against each other inside the join, so a pair that
    they rule out is not made.  At the first element that two sets share, in their order,
    they share no more than what follows it in either of them, itself included.
    """
    met = tables.table(open_rows.join(classes.select("set_id", "sketch"), "set_id"), "met")
    # a set meets those of its own tile and of the next
    tiles = F.explode(F.array("tile", F.col("tile") + 1)).alias("tile")
    left = met.select("root", tiles, F.col("tile").alias("own_tile"), *_side("a", "component", "place"))
    right = met.select("root", "tile", *_side("b", "component", "place"))
    apart = F.expr("component_a < component_b or (component_a > component_b and own_tile < tile)")
    near = F.least("na", "nb").cast("long") * 100 >= F.greatest("na", "nb").cast("long") * o.percent
    rest = F.least(F.col("na") - F.col("place_a"), F.col("nb") - F.col("place_b")).cast("long")
    made = (
        left.join(right, ["root", "tile"])
        .filter(apart & near & _enough(rest, o) & _enough(_most_shared(), o))
        .select(F.greatest("a", "b").alias("set_id"), F.least("a", "b").alias("hub"))
        .distinct()
    )
    return _untested(made, pairs)


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    options: JaccardOptions | None = None,
) -> DataFrame:
    """``doc_id, n_shingles, component_id``: near-duplicate components, exact.

    * Equal sets are one vertex; sets are told apart by 128 bits.
    * The keys of a set are its rarest elements in one order for all sets, so that linked
      sets share some (``prefix_order``); a tile is a band of set sizes.
    * Sets that share few keys with all others together have no link (``_core``).
    * The sets of a tile that share a key are a star around its smallest, and each set is
      paired with the smallest of its stars, a few pairs a set.  Bit counts bound the
      intersection from above, and the sets of what passes are intersected exactly.
    * A key whose sets are not all in one component is looked at again, but for pairs tested
      before: a few rounds of stars around other sets (``_star_pairs``), then all its sets
      that are still apart (``_all_pairs``).  So every pair that shares a key is tested,
      ruled out by its bounds or already connected, and no link is lost.
    * Components come from large and small stars; links found later join these components.

    Tables that nothing reads any more are dropped on the way.

    Texts without words, null texts and rows with a null id are linked with nothing: their
    component is their own id.  Rows with equal id and text are one document.  Extra
    columns are not read.
    """
    rows = narrow(docs, doc_id=id_col, text=text_col)
    with small_batches(docs.sparkSession):
        return _components(rows, options or JaccardOptions())


def _components(rows: DataFrame, o: JaccardOptions) -> DataFrame:
    """``jaccard_components`` of ``doc_id, text``."""
    tables = Stages(rows.sparkSession)
    kind = rows.schema["doc_id"].dataType.simpleString()
    sets = stage_table(
        rows.mapInPandas(_identities(o), f"doc_id {kind}, n bigint, set_id bigint, check bigint, bits binary, sketch array<bigint>"),
        "sets",
    )
    usable = sets.filter(F.col("n") > 0).filter(F.col("doc_id").isNotNull())
    # expected: the square of the number of sets, over 2^65
    clashes = frozenset(
        r.set_id
        for r in usable.groupBy("set_id")
        .agg((F.min("check") < F.max("check")).alias("clash"))
        .filter("clash")
        .collect()
    )
    if clashes:
        several = F.col("set_id").isin(*clashes)
        both = F.col("set_id").bitwiseXOR(F.col("check"))
        sets = sets.withColumn("set_id", F.when(several, both).otherwise(F.col("set_id")))
        usable = sets.filter(F.col("n") > 0).filter(F.col("doc_id").isNotNull())
    grouped = usable.groupBy("set_id").agg(
        F.min("doc_id").alias("first_id"),
        (F.min("check") == F.max("check")).alias("one_set"),
        F.first("n").alias("n"),
        F.first("bits").alias("bits"),
        F.first("sketch").alias("sketch"),
    )
    same = F.when(F.col("one_set"), F.col("first_id")).otherwise(
        F.raise_error(F.lit("two sets with one identity")).cast(kind)
    )
    classes = tables.table(grouped.select("set_id", same.alias("first_id"), "n", "bits", "sketch"), "classes")
    levels = shingle_levels(rows, sets.count(), o)
    shipped = rows.sparkSession.sparkContext.broadcast(levels.tobytes())
    signed = rows.filter(F.col("doc_id").isNotNull()).mapInPandas(
        _signatures(o, shipped, clashes),
        "root bigint, part bigint, tile int, set_id bigint, n int, place int",
    )
    group = Window.partitionBy("root", "part")
    shared = tables.table(
        signed.withColumns({"least": F.min("set_id").over(group), "most": F.max("set_id").over(group)})
        .filter("least <> most")
        .select(*_MEMBER)
        .distinct(),
        "shared",
    )
    shipped.destroy()  # its keys are written; the driver need not hold the table till its garbage goes
    members = _core(shared, o, tables)
    star = Window.partitionBy("root", "part", "tile")
    stars = members.withColumn("hub", F.min("set_id").over(star)).filter("set_id <> hub")
    nearest = F.slice(F.array_sort(F.collect_set("hub")), 1, _HUBS)  # of one hub a key
    pairs = stage_table(
        stars.groupBy("set_id").agg(nearest.alias("hubs")).select("set_id", F.explode("hubs").alias("hub")),
        "pairs",
    )
    parts = connected_components(_verify(pairs, classes, rows, o, clashes))
    before, open_rows = members, members.select("root", "tile", "set_id", "n", "place").distinct()
    for number in range(_STAR_ROUNDS + 1):
        open_rows = _open(open_rows, parts, tables)
        tables.release(before)
        before = open_rows
        if number < _STAR_ROUNDS:
            crossed = _star_pairs(open_rows, classes, pairs, number, o)
        else:
            crossed = _all_pairs(open_rows, classes, pairs, o, tables)
        crossed = stage_table(crossed, "crossed")
        if not crossed.isEmpty():
            parts = connected_components(_verify(crossed, classes, rows, o, clashes), parts)
            pairs = pairs.unionByName(crossed)
    named = (
        classes.join(parts.withColumnRenamed("vertex", "set_id"), "set_id", "left")
        .select("set_id", "first_id", F.coalesce("component", "set_id").alias("component"))
    )
    names = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_set = stage_table(named.join(names, "component").select("set_id", "component_id"), "names")
    tables.drop()
    joined = sets.drop("bits", "sketch").join(by_set, "set_id", "left")
    linked = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id"))
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce(linked, F.col("doc_id")).alias("component_id"),
    )

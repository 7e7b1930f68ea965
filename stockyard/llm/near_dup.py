"""Near-duplicate groups by tensored MinHash banding, with every link confirmed on full shingle sets.

Two collections of `halves` half keys, `per_half` minhashes each, make halves^2 tables: a table's key combines one
half of each collection, so 2 * halves * per_half minhashes serve where plain banding computes halves^2 * 2 * per_half.
Two texts miss each other in all tables only if all halves of one collection differ: at similarity 0.8 and the default
12 x 3 that is 2 * (1 - 0.8^3)^12, about 4 in 10,000.

1. Texts with equal shingle sets become one representative. Table keys are formed of halves that several share.
2. Keys that several representatives share are buckets. The most central member of a bucket (the one with most company
   over all tables) leads it and is compared with all others, which is linear in the bucket. Links form components.
3. What is left are pairs of different components with a common leader. Let D(x) be the shingles that only one of x and
   the leader has. Sets of n and m shingles are linked if at most (n + m) * (den - num) / (den + num) shingles are in
   one of them only, so D(x) and D(y) must share at least half of |D(x)| + |D(y)| less that number, which is above zero
   unless both are linked with the leader. Hence a prefix of D(x) must hold a common shingle: a short one where both are
   far from the leader, a longer one where one is near it, in an order that puts the group's frequent shingles last.
   Shingles that members of different components share are the buckets of the next level, inside their group: those of
   up to LEAF members end there, where the overlaps of whole D(x), in 16 bits a shingle, tell which pairs to compare (buckets with
   the same members once), larger ones go on as in step 2. A level's groups are smaller than those they come from, as each loses its
   leader, and the last level has none.

Null, empty and space-only texts have an empty
set and link with nothing; texts with fewer words than a shingle are one shingle. Rows are told apart by id and text
hash, so rows without an id, or with the id of another text, link as rows of their own; rows equal in both are one
document given twice. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NO_ID, Scratch, cell_of, cells_seen, cut, each_cell, keyed_texts, mix, read, restored, row_keys, slices, text_bytes, with_group
from .components import components
from .shingles import MinHashes, shingle_sets, tensor_halves

WORDS = 5
SIMILARITY = (80, 100)
HALVES = 12
PER_HALF = 3
#: Members that are compared with one leader in one task.
GROUP = 250
#: Members of a bucket of differing shingles that are compared in one task; larger buckets are divided again.
LEAF = 1024
#: Buckets in which only near and far members are compared may hold WIDE members if one side has FEW.
FEW = 16
WIDE = 4096
#: Values of D that a leaf's members are compared by at a time.
COLUMNS = 4096
#: Shingles count as frequent in a group if more than FREQUENT and one in RARE of its members have them in D.
FREQUENT = 16
RARE = 1000
#: Shingles of one leader's members that a task holds to drop those without company.
HELD = 2_000_000

SIGNATURES = "doc_id bigint, text_hash bigint, n_shingles bigint, k1 bigint, k2 bigint, halves array<bigint>"
_SALT = np.uint64(0xA0761D6478BD642F)


def _signatures(batches: Iterator[pa.RecordBatch], words: int, halves: int, per_half: int) -> Iterator[pa.RecordBatch]:
    hashes = MinHashes(2 * halves * per_half)
    for batch in batches:
        off, data = text_bytes(batch.column(2))
        for lo, hi in slices(off):
            sets, at = shingle_sets(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], words)
            parts = np.ascontiguousarray(tensor_halves(hashes.of(sets, at), per_half)).view(np.int64)
            sums = [np.concatenate([[np.uint64(0)], np.cumsum(x)]) for x in (mix(sets), mix(sets ^ _SALT))]
            k1, k2 = ((s[at[1:]] - s[at[:-1]]).view(np.int64) for s in sums)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1, dtype=np.int32) * (2 * halves)), pa.array(parts.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, hi - lo) for c in (0, 1)), pa.array(np.diff(at)), pa.array(k1), pa.array(k2), lists], names=["doc_id", "text_hash", "n_shingles", "k1", "k2", "halves"])


def signatures(docs: DataFrame, words: int = WORDS, halves: int = HALVES, per_half: int = PER_HALF) -> DataFrame:
    """Per row: its key, size of its shingle set, 128 bits that identify the set, and the half keys."""
    return keyed_texts(docs).mapInArrow(lambda it: _signatures(it, words, halves, per_half), SIGNATURES)


def table_keys(reps: DataFrame, halves: int, work: Scratch) -> DataFrame:
    """id and halves to (key, id): keys of all tables whose two halves other representatives have too."""
    each = reps.select("id", F.posexplode("halves").alias("j", "half"))
    shared = with_group(each, ["half"], ["id"], [F.min("id").alias("low"), F.max("id").alias("high")], "low < high")
    lists = [F.collect_list(F.when(side, F.col("half"))).alias(name) for name, side in (("x", F.col("j") < halves), ("y", F.col("j") >= halves))]
    both = work.cut(shared.groupBy("id").agg(*lists).where("size(x) > 0 AND size(y) > 0"))
    return both.select("id", F.explode("x").alias("x"), "y").select("id", "x", F.explode("y").alias("y")).select(F.xxhash64("x", "y").alias("key"), "id")


def _set_rows(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        off, data = text_bytes(batch.column(1))
        for lo, hi in slices(off):
            sets, at = shingle_sets(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], words)
            blobs = pa.Array.from_buffers(pa.large_binary(), hi - lo, [None, pa.py_buffer((at * 8).astype(np.int64)), pa.py_buffer(sets.astype("<u8"))])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), blobs.cast(pa.binary())], names=["id", "shingles"])


def _with_leader(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, np.ndarray, list, list[tuple]]]:
    """Rows sorted by (group, part, member), the leader's own row (member null) first, to members with their leader's set.

    Each is (group, its number of parts, leader, its set, its frequent shingles, members as (id, set, other columns)).
    """
    group, parts, leader, own, frequent = None, 1, None, np.zeros(0, np.uint64), []
    for batch in batches:
        members: list[tuple] = []
        columns = [batch.column(k).to_pylist() for k in (0, 2, 3, 5, 6)]
        others = [batch.column(k).to_pylist() for k in range(7, batch.num_columns)]
        for g, a, b, n, top, blob, *more in zip(*columns, batch.column(4), *others, strict=True):
            shingles = np.frombuffer(blob.as_buffer(), "<u8")
            if b is None:
                if members:
                    yield group, parts, leader, own, frequent, members
                group, parts, leader, own, frequent, members = g, n, a, shingles, top or [], []
            else:
                members.append((b, shingles, *more))
        if members:
            yield group, parts, leader, own, frequent, members


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for g, _, a, own, _, members in _with_leader(batches):
        out = [(g, a, b, len(np.intersect1d(own, x, assume_unique=True)), len(own), len(x)) for b, x in members]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["g", "a", "b", "both", "n_a", "n_b"])


def _apart(x: np.ndarray, own: np.ndarray) -> np.ndarray:
    return mix(np.setxor1d(x, own, assume_unique=True))


def _counts(batches: Iterator[pa.RecordBatch], most: int = HELD) -> Iterator[pa.RecordBatch]:
    """How many members have a shingle in D, by group and part; shingles of one member are left out."""
    held: list[np.ndarray] = []

    def rows() -> Iterator[pa.RecordBatch]:
        shingles, n = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        shingles, n = shingles[n > 1], n[n > 1]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), group)), pa.array(shingles.view(np.int64)), pa.array(n)], names=["g", "key", "n"])

    group, size = None, 0
    for g, _, _, own, _, members in _with_leader(batches):
        if held and (g != group or size > most):
            yield from rows()
            size = 0
        group = g
        for _, x, *_ in members:
            held.append(_apart(x, own))
            size += len(held[-1])
    if held:
        yield from rows()


#: Kinds of buckets and members: far members among themselves, far ones that near ones may be linked with, near ones.
AMONG, FAR, NEAR = range(3)
DEALT = "g bigint, key bigint, id bigint, root bigint, d bigint, e bigint, kind bigint, apart binary"
_DEALT = pa.schema([(c, pa.int64()) for c in ("g", "key", "id", "root", "d", "e", "kind")] + [("apart", pa.binary())])


def _differences(batches: Iterator[pa.RecordBatch], most: int = HELD) -> Iterator[pa.RecordBatch]:
    """Per member its D, and by kind of bucket the given number of shingles of D, the frequent ones last.

    Where a group has one part, shingles without company are left out here already, unless the part holds more than
    `most` of them; they are left out after the shuffle in any case.
    """
    held: list[tuple] = []

    def differ(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
        order = np.lexsort((values, keys))
        keys_in, values_in = keys[order], values[order]
        return values_in[np.searchsorted(keys_in, keys)] < values_in[np.searchsorted(keys_in, keys, "right") - 1]

    def rows(whole: bool) -> Iterator[pa.RecordBatch]:
        sizes = [len(x[0]) for x in held]
        keys = np.concatenate([x[0] for x in held])
        ids, roots, ds, es, kinds = (np.repeat(np.array(c, np.int64), sizes) for c in list(zip(*held, strict=True))[1:])
        held.clear()
        columns = [keys.view(np.int64), ids, roots, ds, es, kinds]
        if whole:
            keep = differ(keys, roots) & ((kinds == AMONG) | differ(keys, kinds))
            columns = [c[keep] for c in columns]
        if len(columns[0]):
            n = len(columns[0])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, group)), *map(pa.array, columns), pa.nulls(n, pa.binary())], schema=_DEALT)

    def wholes(g: int, sets: list[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        n = len(sets)
        none = [pa.nulls(n, pa.int64()) for _ in range(4)]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, g)), pa.nulls(n, pa.int64()), pa.array([b for b, _ in sets], pa.int64()), *none, pa.array([np.sort(x >> np.uint64(48)).astype("<u2").tobytes() for _, x in sets], pa.binary())], schema=_DEALT)

    group, whole, size = None, False, 0
    for g, parts, _, own, frequent, members in _with_leader(batches):
        if g != group:
            if held:
                yield from rows(whole)
            group, whole, size = g, parts == 1, 0
        yield from wholes(g, [(b, _apart(x, own)) for b, x, *_ in members])
        last = np.array(frequent, np.int64).view(np.uint64)
        order = np.argsort(last)
        for b, x, root, d, e, near, among, across in members:
            shingles = _apart(x, own)
            rank = np.zeros(len(shingles), np.int64)
            if len(last):
                at = np.minimum(np.searchsorted(last[order], shingles), len(last) - 1)
                rank = np.where(last[order][at] == shingles, order[at] + 1, 0)
            shingles = shingles[np.lexsort((shingles, rank))]
            for kind, prefix in ((AMONG, among), (NEAR if near else FAR, across)):
                if prefix > 0:
                    held.append((shingles[:prefix] if kind == AMONG else mix(shingles[:prefix] ^ _SALT), b, root, d, e, kind))
                    size += len(held[-1][0])
            if size > most:  # from here on, rows of this group leave as they are
                whole, size = False, 0
                yield from rows(whole)
    if held:
        yield from rows(whole)


def _by_leader(pairs: DataFrame, sets: DataFrame, frequent: DataFrame | None = None) -> DataFrame:
    """(g, a, b) to the sets of each a and its b, ordered for _with_leader. The members of a large group are split.

    Other columns of the pairs stay with their members; frequent: g and its frequent shingles, for the leader's rows.
    """
    more = [c for c in pairs.columns if c not in ("g", "a", "b")]
    parts = F.ceil(F.col("size") / GROUP).cast("int")
    none = F.lit(None).cast("array<bigint>").alias("frequent")
    sized = with_group(pairs, ["g", "a"], ["b"], [F.count(F.lit(1)).alias("size")])
    sized = sized.select("g", "a", "b", F.pmod(F.xxhash64("b"), parts).cast("int").alias("part"), parts.alias("parts"), *more)
    members = sized.join(sets.withColumnRenamed("id", "b"), "b").select("g", "part", "a", "b", "shingles", "parts", none, *more)
    groups = pairs.groupBy("g", "a").agg(F.count(F.lit(1)).alias("size")).join(sets.withColumnRenamed("id", "a"), "a")
    groups = groups.withColumn("frequent", none) if frequent is None else groups.join(frequent, "g", "left")
    leaders = groups.select("g", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), "a", F.lit(None).cast("bigint").alias("b"), "shingles", parts.alias("parts"), "frequent")
    return members.unionByName(leaders, allowMissingColumns=True).repartition("g", "part").sortWithinPartitions("g", "part", F.col("b").asc_nulls_first())


def _frequent(open_pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """g and the shingles that many of its members have in D, the most frequent last; at most RARE times the mean of |D|."""
    counts = _by_leader(open_pairs.select("g", "a", "b"), sets).mapInArrow(_counts, "g bigint, key bigint, n bigint")
    counts = counts.groupBy("g", "key").agg(F.sum("n").alias("n")).where(F.col("n") > FREQUENT)
    sizes = open_pairs.groupBy("g").agg(F.count(F.lit(1)).alias("size"))
    top = counts.join(sizes, "g").where(F.col("n") * RARE > F.col("size"))
    return top.groupBy("g").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "key"))), lambda x: x.key).alias("frequent"))


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(g, a, b) to (g, a, b, both, n_a, n_b): sizes of the full sets and of their intersection."""
    return _by_leader(pairs, sets).mapInArrow(_sizes, "g bigint, a bigint, b bigint, both bigint, n_a bigint, n_b bigint")


def _stars(live: DataFrame, work: Scratch) -> DataFrame:
    """Buckets (g, key, id, c) to distinct pairs (g, a, b) of their leaders a and other members b, each in the group of its leader."""
    central = live.groupBy("id").agg(F.sum("c").alias("cent"))
    known = work.cut(live.join(central, "id").select("g", "key", "id", "cent"))
    led = with_group(known, ["g", "key"], ["id"], [F.max(F.struct("cent", (-F.col("id")).alias("less"))).alias("top")])
    a = -F.col("top.less")
    return work.cut(led.where(a != F.col("id")).select(F.xxhash64("g", a).alias("g"), a.alias("a"), F.col("id").alias("b")).distinct())


def _incidence(sets: list[np.ndarray], universe: np.ndarray) -> np.ndarray:
    """How often each set has each value of the universe."""
    m = np.zeros((len(sets), len(universe)), np.float32)
    values = np.concatenate(sets)
    at = np.minimum(np.searchsorted(universe, values), len(universe) - 1)
    hit = universe[at] == values
    np.add.at(m, (np.repeat(np.arange(len(sets)), [len(x) for x in sets])[hit], at[hit]), 1)
    return m


def _linked(bucket: list[tuple], per_shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs in one bucket of (id, root, e, kind, D) whose D may share enough.

    D comes as 16 bits of each shingle. Equal bits of different shingles only add to what two D seem to share, as every
    shingle counts, so no link is missed; the pairs found are confirmed on the sets.
    """
    ids, roots, es, kinds = (np.array(c, np.int64) for c in list(zip(*bucket, strict=True))[:4])
    sets = [np.frombuffer(x[4], "<u2") for x in bucket]
    far, near = np.flatnonzero(kinds == FAR), np.flatnonzero(kinds == NEAR)
    among = not len(near)
    a, b = (np.arange(len(ids)),) * 2 if among else sorted((far, near), key=len)
    if among:
        universe, n = np.unique(np.concatenate(sets), return_counts=True)
        universe = universe[n > 1]
    else:
        universe = np.intersect1d(*(np.concatenate([sets[k] for k in side]) for side in (a, b)))
    shared = np.zeros((len(a), len(b)), np.float32)
    for lo in range(0, len(universe), COLUMNS):
        part = universe[lo : lo + COLUMNS]
        left = _incidence([sets[k] for k in a], part)
        shared += left @ (left if among else _incidence([sets[k] for k in b], part)).T
    if among:  # each pair once
        shared[np.tril_indices(len(a))] = -np.inf
    x, y = np.nonzero((shared * per_shingle >= es[a][:, None] + es[b][None, :]) & (roots[a][:, None] != roots[b][None, :]))
    return ids[a[x]], ids[b[y]]


def _leaf_links(batches: Iterator[pa.RecordBatch], per_shingle: int) -> Iterator[pa.RecordBatch]:
    """Rows (g, s, t, id, root, e, kind, apart) sorted by bucket (g, s, t) to pairs that may be linked."""
    bucket, held = None, []

    def found() -> Iterator[pa.RecordBatch]:
        a, b = _linked(held, per_shingle)
        held.clear()
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    for batch in batches:
        for g, s, t, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if bucket != (g, s, t):
                if held:
                    yield from found()
                bucket = (g, s, t)
            held.append(row)
    if held:
        yield from found()


def _in_leaves(live: DataFrame, wholes: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Small buckets (g, s, t, id, root, e, kind), s and t naming their members, to pairs (g, a, b) of different components that may be linked."""
    rows = live.select("g", "s", "t", "id", "root", "e", "kind").distinct().join(wholes, ["g", "id"])
    rows = rows.select("g", "s", "t", "id", "root", "e", "kind", "apart").repartition("g", "s", "t").sortWithinPartitions("g", "s", "t")
    return rows.mapInArrow(lambda it: _leaf_links(it, 2 * sum(similarity)), "a bigint, b bigint").distinct().select(F.col("a").alias("g"), "a", "b")


def _joined_roots(roots: DataFrame | None, links: DataFrame, work: Scratch) -> DataFrame:
    """(id, root) with the links (a, b) added."""
    if roots is None:
        return components(links, work.cut)
    of = lambda c: roots.select(F.col("id").alias(c), F.col("root").alias(f"root_{c}"))
    x, y = F.coalesce("root_a", "a"), F.coalesce("root_b", "b")
    edges = work.cut(links.join(of("a"), "a", "left").join(of("b"), "b", "left").where(x != y).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct())
    if edges.isEmpty():
        return roots
    up = components(edges, work.cut)
    moved = roots.join(up.select(F.col("id").alias("root"), F.col("root").alias("top")), "root", "left").select("id", F.coalesce("top", "root").alias("root"))
    return work.cut(moved.unionByName(up.join(roots.select("id"), "id", "left_anti")))


def _open_pairs(stars: DataFrame, roots: DataFrame, similarity: tuple[int, int], work: Scratch) -> DataFrame:
    """Compared pairs to (g, a, b, root, d, e, near, among, across): members that may be linked with one of another component in their group.

    near: linked with the leader. among, across: prefixes for far members with each other, and for near ones with far ones.
    e is what a set takes off the overlap that it needs: x and y need 2 * (num + den) * overlap >= e(x) + e(y), and an
    overlap is at most |D(y)|, so a partner of x has at least e(x) less 2 * (den - num) of its shingles.
    """
    num, den = similarity
    s, t = num + den, den - num
    d = F.col("n_a") + F.col("n_b") - 2 * F.col("both")
    members = stars.join(roots.select(F.col("id").alias("b"), "root"), "b", "left").select("g", "a", "b", F.coalesce("root", "b").alias("root"), F.col("n_b").alias("n"), d.alias("d"), (d * s - F.col("n_b") * t).alias("e"), (d * s <= (F.col("n_a") + F.col("n_b")) * t).alias("near"))
    members = work.cut(members)
    known = [F.min("root").alias("low"), F.max("root").alias("high")]
    for side, test in (("near", F.col("near")), ("far", ~F.col("near"))):
        known += [F.min(F.when(test, F.col("e"))).alias(f"e_{side}"), F.max(F.when(test, F.col("n"))).alias(f"n_{side}"), F.max(F.when(test, F.col("d") * s + F.col("n") * t)).alias(f"most_{side}")]
    mixed = with_group(members, ["g"], ["b"], known, "low < high")
    need = {side: F.when(F.col("e") <= F.col(f"most_{side}"), F.greatest(F.lit(1), F.ceil((F.col("e") + F.greatest(f"e_{side}", F.col("e") - F.col(f"n_{side}") * (2 * t))) / (2 * s)))) for side in ("near", "far")}
    prefix = lambda side: F.coalesce(F.col("d") - need[side] + 1, F.lit(0)).cast("int")
    among = F.when(F.col("near"), 0).otherwise(prefix("far")).alias("among")
    across = F.when(F.col("near"), prefix("far")).otherwise(prefix("near")).alias("across")
    return work.cut(mixed.select("g", "a", "b", "root", "d", "e", "near", among, across).where("among > 0 OR across > 0"))


def linked_groups(keys: DataFrame, sets_of: Callable[[DataFrame], DataFrame], similarity: tuple[int, int], work: Scratch) -> DataFrame | None:
    """Shared table keys (key, id) to (id, root) over confirmed links, null without any.

    sets_of: makes the shingle sets of a table of ids.
    """
    num, den = similarity
    is_link = F.col("both") * den >= (F.col("n_a") + F.col("n_b") - F.col("both")) * num
    rows, roots, sets = keys.select(F.lit(0).cast("bigint").alias("g"), "key", "id", F.col("id").alias("root"), F.lit(AMONG).cast("bigint").alias("kind")), None, None
    wholes = None
    side = lambda test: F.sum(F.when(test, 1).otherwise(0))
    company = [F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("c"), side(F.col("kind") == FAR).alias("far"), side(F.col("kind") == NEAR).alias("close")]
    company += [F.bit_xor(F.xxhash64(F.lit(salt), "kind", "id")).alias(name) for name, salt in (("s", 1), ("t", 2))]
    small = (F.col("c") <= LEAF) | ((F.col("kind") != AMONG) & (F.least("far", "close") <= FEW) & (F.col("c") <= WIDE))
    while True:
        met = with_group(rows, ["g", "key"], ["id"], company, "low < high AND (far > 0) = (close > 0)").drop("low", "high")
        live = work.cut(met.withColumn("small", F.lit(False) if roots is None else small))
        if live.isEmpty():
            return roots
        if roots is not None:
            pairs = work.cut(_in_leaves(live.where("small"), wholes, similarity))
            roots = _joined_roots(roots, compared(pairs, sets).where(is_link).select("a", "b"), work)
            live = live.where("NOT small")
            if live.isEmpty():
                return roots
        if sets is None:
            sets = sets_of(live.select("id").distinct())
        stars = work.cut(compared(_stars(live, work), sets))
        roots = _joined_roots(roots, stars.where(is_link).select("a", "b"), work)
        open_pairs = _open_pairs(stars, roots, similarity, work)
        if open_pairs.isEmpty():
            return roots
        dealt = _by_leader(open_pairs, sets, work.cut(_frequent(open_pairs, sets)))
        dealt = work.cut(dealt.mapInArrow(_differences, DEALT))
        rows, wholes = dealt.where("apart IS NULL").drop("apart"), dealt.where("apart IS NOT NULL").select("g", "id", "apart")


def groups(docs: DataFrame, words: int = WORDS, similarity: tuple[int, int] = SIMILARITY, halves: int = HALVES, per_half: int = PER_HALF) -> DataFrame:
    """Per row: doc_id, text_hash, n_shingles, component_id (smallest id of its group), leads (the row has the group's smallest key)."""
    spark = docs.sparkSession
    work = Scratch(spark, "near-dup")
    signed = work.cut(signatures(docs, words, halves, per_half))
    key = F.struct("doc_id", "text_hash")
    some = signed.where("n_shingles > 0").withColumn("cell", cell_of("doc_id", "text_hash"))
    reps = some.groupBy("k1", "k2").agg(F.min(key).alias("least"), F.any_value("halves").alias("halves"), cells_seen(F.col("cell")).alias("cells"))
    reps = work.cut(reps.withColumn("id", F.monotonically_increasing_id()))  # numbers are fixed once written

    def sets_of(ids: DataFrame) -> DataFrame:
        wanted = reps.join(ids, "id").select("id", "least.doc_id", "least.text_hash")
        rows = keyed_texts(docs).join(wanted.hint("merge"), ["doc_id", "text_hash"]).dropDuplicates(["doc_id", "text_hash"])
        return work.bucketed(rows.select("id", "text").mapInArrow(lambda it: _set_rows(it, words), "id bigint, shingles binary"), "id")

    roots = linked_groups(table_keys(reps, halves, work), sets_of, similarity, work)
    found = reps.select("k1", "k2", "id", "least", "cells")
    if roots is None:
        found = found.withColumn("first", F.col("least"))
    else:
        linked = work.cut(roots.join(reps.select("id", "least"), "id"))
        firsts = with_group(linked, ["root"], ["id"], [F.min("least").alias("first")]).select("id", "first")
        found = found.join(firsts, "id", "left").withColumn("first", F.coalesce("first", "least"))
    found = found.select("k1", "k2", each_cell(F.col("cells")).alias("cell"), "first")
    out = some.drop("halves").join(found, ["k1", "k2", "cell"]).select("doc_id", "text_hash", "n_shingles", "first")
    out = out.unionByName(signed.where("n_shingles = 0").select("doc_id", "text_hash", "n_shingles", key.alias("first")))
    out = cut(out.select("doc_id", "text_hash", "n_shingles", F.col("first.doc_id").alias("component_id"), (F.col("first") == key).alias("leads")))
    work.clear()
    return out


def near_duplicates(docs: DataFrame, words: int = WORDS, similarity: tuple[int, int] = SIMILARITY, halves: int = HALVES, per_half: int = PER_HALF) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest id of its group)."""
    return restored(groups(docs, words, similarity, halves, per_half).select("doc_id", "n_shingles", "component_id"), "doc_id", "component_id")


def leaders(docs: DataFrame, words: int = WORDS, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """The documents with all their columns, one row of each group: the smallest id's, of a document given twice one. Texts without words stay."""
    found = groups(docs, words, similarity).where("leads").groupBy("doc_id", "text_hash").agg(F.max("n_shingles").alias("size"))
    rows = row_keys(docs).join(found.hint("merge"), ["doc_id", "text_hash"])
    apart = F.when(F.col("size") == 0, F.monotonically_increasing_id()).alias("apart")
    return rows.groupBy("doc_id", "text_hash", apart).agg(F.any_value("row").alias("row")).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"), words=2)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def brute_force(docs: list[tuple[int | None, str | None]], words: int = WORDS, similarity: tuple[int, int] = SIMILARITY) -> list[tuple]:
    """The same result from all pairs of rows, for tests."""
    import re

    docs = sorted(((NO_ID if i is None else i, t or "") for i, t in docs))
    sets = []
    for _, text in docs:
        w = re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        sets.append({tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set())
    root = list(range(len(docs)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    some = [i for i, s in enumerate(sets) if s]
    for x, i in enumerate(some):
        for j in some[x + 1 :]:
            a, b = sets[i], sets[j]
            if min(len(a), len(b)) * similarity[1] < max(len(a), len(b)) * similarity[0]:
                continue
            both = len(a & b)
            if both * similarity[1] >= (len(a) + len(b) - both) * similarity[0]:
                x1, x2 = sorted((top(i), top(j)))
                root[x2] = x1
    shown = lambda i: None if i == NO_ID else i
    return [(shown(docs[i][0]), len(sets[i]), shown(docs[top(i)][0])) for i in range(len(docs))]

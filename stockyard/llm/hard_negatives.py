"""Hard-negative mining by ball trees with branch and bound.

Vectors are whole numbers. Rows are dealt by a hash into trees of TREE_ROWS rows or so; a task builds one tree at a time,
with one root for each label, and lets the anchors that arrive after its rows go down it together. A node is a ball
around its mean: the inner product of an anchor q with any of its rows lies between q.c - |q| r and q.c + |q| r. An
anchor leaves a node whose bounds lie wholly outside its window of scores, or whose upper bound is strictly beneath its
current k-th score (a tie may still win by its id). What trees find is ranked over all trees.

`positives` searches the roots of the anchor's label, `negatives` the other roots, with a window for each positive.
Anchors are copied to each tree, rows are moved once; a tree and one Arrow batch of anchors are what a task holds.

Rows without label or vector, or with a null, NaN or infinite component, take no part. A null id is the smallest. Rows
equal in id, label and vector are one row given twice; rows of one id that differ otherwise are rows of their own. Only
vectors of equal length are compared. Components beyond 64 bits are held at their ends, and so are scores; sums are
exact at any size. Extra columns are ignored, an empty table gives no rows. Texts play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import NO_ID, cut, read, restored

#: Rows of a tree at most (by expectation), and at least if there is work for more tasks.
TREE_ROWS, LEAST_ROWS = 1 << 16, 1 << 11
#: Rows of a leaf; candidates are ranked, and bounds tightened, when there are GATHERED times those that can stay.
LEAF, GATHERED = 64, 4
#: Anchors that go down a tree together.
BLOCK = 1024
#: Sums of absolute products beneath this are exact in doubles.
EXACT = 2.0**53
LONG = np.iinfo(np.int64)

FOUND = "anchor_id long, anchor_key long, label int, v array<bigint>, positive_id long, positive_key long, positive_score long, id long, row_key long, score long"


def vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", noise: int = 7) -> DataFrame:
    """id, row_key, label, v of the rows that take part; labels of ids divisible by `noise` are moved on by one of ten."""
    x = F.col(vector_col).cast("array<double>")
    whole = F.transform(x, lambda c: F.floor(c * 256.0).cast("long"))
    fine = ~F.exists(F.transform(x, lambda c: F.coalesce(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(True))), lambda bad: bad)
    label = F.col(label_col).cast("int")
    moved = F.when(F.coalesce(F.pmod(F.col(id_col).cast("long"), F.lit(noise)) == 0, F.lit(False)), (label + 1) % 10).otherwise(label) if noise else label
    kept = rows.where(F.col(vector_col).isNotNull() & F.col(label_col).isNotNull()).where(fine)
    kept = kept.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), moved.cast("int").alias("label"), whole.alias("v"))
    return kept.select("id", F.xxhash64("id", "label", "v").alias("row_key"), "label", "v").dropDuplicates(["id", "row_key", "label", "v"])


class Forest:
    """Ball trees over the rows of one task, one root per label and vector length."""

    def __init__(self, ids: np.ndarray, keys: np.ndarray, labels: np.ndarray, v: np.ndarray):
        order = np.lexsort((keys, ids, labels))
        self.ids, self.keys, self.labels, self.v = ids[order], keys[order], labels[order], v[order]
        self.points = self.v.astype(np.float64)
        self.nodes: list[tuple[int, int, np.ndarray, float, int, int]] = []  # begin, end, centre, radius, children
        starts = np.flatnonzero(np.diff(self.labels, prepend=self.labels[:1] - 1)) if len(ids) else np.zeros(0, int)
        self.roots = [(int(self.labels[a]), self._build(int(a), int(b))) for a, b in zip(starts, [*starts[1:], len(ids)], strict=True)]

    def _build(self, begin: int, end: int) -> int:
        points = self.points[begin:end]
        centre = points.mean(0)
        distance = np.sqrt(((points - centre) ** 2).sum(1))
        at = len(self.nodes)
        self.nodes.append((begin, end, centre, float(distance.max()) * (1 + 1e-9), -1, -1))
        if end - begin > LEAF and distance.max() > 0:
            far = points[distance.argmax()]
            other = points[((points - far) ** 2).sum(1).argmax()]
            along = points @ (other - far)
            half = len(along) // 2
            order = begin + np.argsort(along, kind="stable")
            for name in ("ids", "keys", "labels", "v", "points"):
                x = getattr(self, name)
                x[begin:end] = x[order]
            left, right = self._build(begin, begin + half), self._build(begin + half, end)
            self.nodes[at] = (*self.nodes[at][:4], left, right)
        return at

    def scores(self, q: np.ndarray, begin: int, end: int, exact: bool) -> np.ndarray:
        """Inner products: by doubles where every sum is exact in them, else by whole numbers of any size."""
        if exact:
            return (q.astype(np.float64) @ self.points[begin:end].T).astype(np.int64)
        found = q.astype(object) @ self.v[begin:end].astype(object).T
        return np.clip(found, LONG.min, LONG.max).astype(np.int64)

    def search(self, q: np.ndarray, wanted: np.ndarray, low: np.ndarray, high: np.ndarray, ids: np.ndarray, keys: np.ndarray, k: int, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The first k rows of each query within [low, high], higher scores first, ties by id: query, row and score.

        same: in the roots of the wanted label, without the row of the query's own id and key; else in all other roots.
        """
        n = len(q)
        doubles = q.astype(np.float64)
        norms = np.sqrt((doubles**2).sum(1))
        largest = np.abs(doubles).sum(1).max(initial=0) * np.abs(self.points).max(initial=0)
        exact = largest < EXACT
        top = low.astype(np.float64) if exact else np.full(n, -np.inf)  # a score must reach it to matter
        ceiling = high.astype(np.float64) if exact else np.full(n, np.inf)
        kept = (np.zeros(0, np.int64),) * 3
        fresh: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def rank() -> None:
            nonlocal kept, fresh, size
            query, row, score = (np.concatenate(x) for x in zip(kept, *fresh, strict=True))
            order = np.lexsort((self.keys[row], self.ids[row], ~score, query))
            query, row, score = query[order], row[order], score[order]
            first = np.searchsorted(query, query)
            place = np.arange(len(query)) - first
            keep = place < k
            kept = query[keep], row[keep], score[keep]
            full = np.flatnonzero(place == k - 1)
            if exact:
                top[query[full]] = np.maximum(top[query[full]], score[full])
            fresh, size = [], 0

        def bounds(node: int, active: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            _, _, centre, radius, _, _ = self.nodes[node]
            middle, reach = doubles[active] @ centre, norms[active] * radius
            slack = 1e-9 * (norms[active] * (np.sqrt((centre**2).sum()) + radius)) + 1e-3
            return middle - reach - slack, middle + reach + slack

        for label, root in self.roots:
            todo = [(root, np.flatnonzero((wanted == label) == same))]
            while todo:
                node, active = todo.pop()
                if not len(active):
                    continue
                least, most = bounds(node, active)
                active = active[(most >= top[active]) & (least <= ceiling[active])]
                if not len(active):
                    continue
                begin, end, _, _, left, right = self.nodes[node]
                if left >= 0:  # the child with the higher centre for these queries comes off the stack first
                    pair = sorted((left, right), key=lambda x: float(doubles[active].mean(0) @ self.nodes[x][2]))
                    todo += [(x, active) for x in pair]
                    continue
                score = self.scores(q[active], begin, end, exact)
                fits = (score >= low[active, None]) & (score <= high[active, None])
                if exact:
                    fits &= score >= top[active, None]
                if same:
                    fits &= (self.ids[begin:end] != ids[active, None]) | (self.keys[begin:end] != keys[active, None])
                a, b = np.nonzero(fits)
                if len(a):
                    fresh.append((active[a], begin + b, score[a, b]))
                    size += len(a)
                    if size > GATHERED * k * n:
                        rank()
        if fresh:
            rank()
        return kept


def _vectors_of(column: pa.Array) -> list[np.ndarray]:
    offsets, values = np.asarray(column.offsets), column.values.to_numpy(zero_copy_only=False)
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _search(rows: DataFrame, queries: DataFrame, trees: int, k: int, same: bool) -> DataFrame:
    """What each tree has for each query: its first k rows.

    queries: id, row_key, label, v of the anchor and positive_id, positive_key, positive_score, low, high.
    """
    deal = F.pmod(F.xxhash64("id", "row_key"), F.lit(trees)).cast("int")
    extra = ("positive_id", "positive_key", "positive_score", "low", "high")
    own = rows.select(deal.alias("tree"), F.lit(0).alias("kind"), "id", "row_key", "label", "v", *[F.lit(0).cast("long").alias(c) for c in extra])
    asked = queries.select(F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.lit(1).alias("kind"), "id", "row_key", "label", "v", *extra)
    columns = own.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, held, forests = None, [], None

        def grown() -> dict[int, Forest]:
            by: dict[int, list[int]] = {}
            every = [x for b in held for x in _vectors_of(b.column(5))]
            for i, x in enumerate(every):
                by.setdefault(len(x), []).append(i)
            columns = [np.concatenate([b.column(c).to_numpy() for b in held]) for c in (2, 3, 4)] if held else [np.zeros(0, np.int64)] * 3
            return {d: Forest(*[c[i] for c in columns], np.stack([every[j] for j in i])) for d, i in by.items()}

        for batch in batches:
            numbers = batch.column(0).to_numpy() * 2 + batch.column(1).to_numpy()
            for a, b in zip(at := [0, *(np.flatnonzero(np.diff(numbers)) + 1)], [*at[1:], len(numbers)], strict=True):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if numbers[a] // 2 != tree:
                    tree, held, forests = numbers[a] // 2, [], None
                if numbers[a] % 2 == 0:
                    held.append(part)
                    continue
                if forests is None:
                    forests, held = grown(), []
                for lo in range(0, part.num_rows, BLOCK):
                    yield from answers(forests, part.slice(lo, BLOCK))

    def answers(forests: dict[int, Forest], part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        every = _vectors_of(part.column(5))
        lengths = np.array([len(x) for x in every])
        for d in np.unique(lengths):
            if int(d) not in forests:
                continue
            forest, at = forests[int(d)], np.flatnonzero(lengths == d)
            ids, keys, labels = (part.column(c).to_numpy()[at] for c in (2, 3, 4))
            low, high = (part.column(c).to_numpy()[at] for c in (9, 10))
            query, row, score = forest.search(np.stack([every[i] for i in at]), labels, low, high, ids, keys, k, same)
            asking = part.take(pa.array(at[query]))
            yield pa.RecordBatch.from_arrays(
                [asking.column(c) for c in (2, 3, 4, 5, 6, 7, 8)] + [pa.array(forest.ids[row]), pa.array(forest.keys[row]), pa.array(score)],
                names=[c.split()[0] for c in FOUND.split(", ")],
            )

    both = own.select(*columns).unionByName(asked.select(*columns))
    dealt = both.repartitionById(trees, "tree").sortWithinPartitions("tree", "kind")
    return dealt.mapInArrow(run, FOUND)


def first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first k of each group over all trees, as `rank`; Spark cuts each task's rows to k before they meet."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id", "row_key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def tree_count(rows: int, tasks: int) -> int:
    return max(1, -(-rows // TREE_ROWS), min(tasks, -(-rows // LEAST_ROWS)))


def mine(rows: DataFrame, anchors: Column, n_positives: int = 5, n_negatives: int = 10, from_percent: int = 30, to_percent: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    rows: what `vectors` gives. A row is an anchor if `anchors` holds. A negative's score is from_percent to to_percent
    of the positive's.
    """
    spark = rows.sparkSession
    rows = cut(rows)
    trees = tree_count(rows.count(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    none = F.lit(0).cast("long")
    asked = rows.where(anchors).select("*", *[none.alias(c) for c in ("positive_id", "positive_key", "positive_score")], F.lit(LONG.min).cast("long").alias("low"), F.lit(LONG.max).cast("long").alias("high"))
    positives = first(_search(rows, asked, trees, n_positives, True), ["anchor_id", "anchor_key"], n_positives)
    # Bounds of whole scores n with from * p <= 100 n <= to * p, in decimals as the products may leave 64 bits.
    share = lambda p: F.col("score").cast("decimal(19,0)") * F.lit(p) / F.lit(100)
    windows = cut(
        positives.select(
            F.col("anchor_id").alias("id"), F.col("anchor_key").alias("row_key"), "label", "v",
            F.col("id").alias("positive_id"), F.col("row_key").alias("positive_key"), F.col("score").alias("positive_score"),
            F.ceil(share(from_percent)).cast("long").alias("low"), F.floor(share(to_percent)).cast("long").alias("high"),
        )
    )
    keys = ["anchor_id", "anchor_key", "positive_id", "positive_key"]
    found = first(_search(rows, windows.where("low <= high"), trees, n_negatives, False), keys, n_negatives)
    found = found.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    return restored(found, "anchor_id", "positive_id", "negative_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(vectors(read(spark, sf_dir, "embeddings")), F.pmod("id", F.lit(100)) == 0)


ORACLE = """
WITH r AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
a AS (SELECT * FROM r WHERE id % 100 = 0),
s AS (SELECT a.id AS anchor_id, r.id AS id, r.label = a.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score FROM a, r WHERE a.id <> r.id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score
      FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS k FROM s WHERE same) WHERE k <= 5),
n AS (SELECT p.anchor_id, positive_id, positive_score, s.id AS negative_id, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS k
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(k AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE k <= 10
"""

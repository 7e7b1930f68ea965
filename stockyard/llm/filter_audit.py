"""Filter interaction audit: what each filter removes in every order of the filters, by products of incidence matrices.

`failures` evaluates five filters once per document and keeps a mask of five bits. What a chain of filters does to a
document depends on its mask alone, so a part (a language) is three histograms over the 32 masks: all documents, those
of good quality and the toxic ones. Stacked as rows, they are multiplied by integer matrices of 32 rows (masks) and 600
columns (120 orders of five steps) for kept, removed, redundant and unique outcomes; the sums over orders by filter are
the removed columns once more, grouped by letter.

Before the histograms, documents are reduced to a digest of the text; rows of equal digest, part and labels are counted
before they meet, so a text that a third of all rows share is a few rows where the smallest id is looked for.

Null texts are empty, a null `lang` is the part ''. A null id is the smallest and has no label. A document with several
label rows is good (toxic) if one of them says so. Rows of one id and one text are no copies of each other: neither id is
smaller. Repeated rows count one by one, extra columns are ignored, an empty table gives no rows. Very long texts stay
in one row, where all measures are linear in them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import NO_ID, read

FILTERS = "ABCDE"
SPACE = r"[ \x09-\x0D]+"
SYMBOLS = r"[^#$%&*|]+"
#: Parts of null ids in the join with the labels, which have none.
NULL_CELLS = 64

RESULT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def conditions(words: Column, text: Column) -> dict[str, Column]:
    """Failure conditions of the filters that judge a text by itself."""
    n = F.size(words)
    return {
        "A": n < 200,
        "B": F.lit(100).cast("long") * F.size(F.array_distinct(words)) < F.lit(50).cast("long") * n,
        "C": F.lit(100).cast("long") * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > F.lit(3).cast("long") * F.length(text),
        "D": F.length(F.regexp_replace(text, SYMBOLS, "")) > 0,
    }


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest of the text, mask: bit k is set if the k-th filter of FILTERS fails (the last one not yet)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
    ).withColumn("words", F.array_remove(F.split("text", SPACE), ""))
    bits = [F.when(c, F.lit(1 << FILTERS.index(k))).otherwise(F.lit(0)) for k, c in conditions(F.col("words"), F.col("text")).items()]
    mask = bits[0]
    for b in bits[1:]:
        mask = mask.bitwiseOR(b)
    # sha2 of the bytes tells texts apart: unhex makes 32 bytes of its 64 letters
    return rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("mask"))


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds booleans good and toxic; ids without a label have neither."""
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    ).withColumn("cell", F.lit(0))
    cell = F.when(F.col("doc_id") == NO_ID, 1 + F.pmod(F.xxhash64("digest"), F.lit(NULL_CELLS)).cast("int")).otherwise(F.lit(0))
    return rows.withColumn("cell", cell).join(known, ["doc_id", "cell"], "left").fillna(False, ["good", "toxic"])


def histograms(rows: DataFrame) -> DataFrame:
    """part, mask, n, n_good, n_toxic over all five filters; a text's copies are those with a larger id than its smallest."""
    bit = 1 << FILTERS.index("E")
    kind = ["digest", "part", "mask", "good", "toxic"]
    # Rows of one id come out of the join in one place, so the first count needs no shuffle of its own.
    each = rows.groupBy("doc_id", "cell", *kind).agg(F.count(F.lit(1)).alias("n"))
    some = each.groupBy(*kind).agg(F.sum("n").alias("n"), F.min("doc_id").alias("first"), F.min_by("n", "doc_id").alias("n_first"))
    least = F.min("first").over(Window.partitionBy("digest"))
    originals = F.when(F.col("first") == F.col("least"), F.col("n_first")).otherwise(F.lit(0)).alias("k")
    split = F.explode(F.array(F.struct(F.col("mask").alias("m"), F.col("k").alias("n")), F.struct(F.col("mask").bitwiseOR(F.lit(bit)).alias("m"), (F.col("n") - F.col("k")).alias("n"))))
    told = some.withColumn("least", least).select("*", originals).select("part", "good", "toxic", split.alias("s")).where("s.n > 0")
    count = lambda c: F.sum(F.when(c, F.col("s.n")).otherwise(F.lit(0)))
    return told.groupBy("part", F.col("s.m").alias("mask")).agg(F.sum("s.n").alias("n"), count(F.col("good")).alias("n_good"), count(F.col("toxic")).alias("n_toxic"))


def matrices() -> tuple[list[tuple[str, int]], dict[str, np.ndarray]]:
    """The 600 (order, step) columns, and 0/1 matrices of 32 masks by 600 columns.

    A column's filter removes a mask if it fails and no filter before it does; it is redundant if one before it does
    too; it is unique if nothing else in the mask fails; kept are masks that no filter up to the step fails.
    """
    orders = ["".join(p) for p in permutations(FILTERS)]
    columns = [(order, step) for order in orders for step in range(1, len(FILTERS) + 1)]
    bits = lambda letters: sum(1 << FILTERS.index(x) for x in letters)
    own = np.array([bits(order[step - 1]) for order, step in columns])
    before = np.array([bits(order[: step - 1]) for order, step in columns])
    mask = np.arange(1 << len(FILTERS))[:, None]
    fails, earlier = (mask & own) != 0, (mask & before) != 0
    found = {"kept": ~fails & ~earlier, "removed": fails & ~earlier, "redundant": fails & earlier, "unique_fails": mask == own}
    return columns, {k: v.astype(np.int64) for k, v in found.items()}


def outcomes(hist: DataFrame) -> DataFrame:
    """One row per part, order and step: the histograms of some parts at a time, multiplied by the matrices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, by = matrices()
        letter = np.array([FILTERS.index(order[step - 1]) for order, step in columns])
        of_letter = np.eye(len(FILTERS), dtype=np.int64)[letter]  # 600 by 5
        for whole in batches:
            for at in range(0, whole.num_rows, 64):  # 64 parts are 38,400 rows
                batch = whole.slice(at, 64)
                stacked = np.zeros((3, batch.num_rows, 1 << len(FILTERS)), np.int64)
                for k, cells in enumerate(batch.column(1).to_pylist()):
                    for c in cells:
                        stacked[:, k, c["mask"]] = c["n"], c["n_good"], c["n_toxic"]
                rows = stacked.reshape(-1, stacked.shape[2]) @ by["removed"]
                removed, good, toxic = rows.reshape(3, batch.num_rows, -1)
                others = [stacked[0] @ by[k] for k in ("kept", "redundant", "unique_fails")]
                shapley = (removed @ of_letter)[:, letter]
                n = batch.num_rows
                parts = pa.array(np.repeat(np.arange(n), len(columns)))
                values = [batch.column(0).take(parts), pa.array([o for o, _ in columns] * n), pa.array([s for _, s in columns] * n, pa.int32())]
                values += [pa.array(x.ravel()) for x in (others[0], removed, others[1], others[2], good, toxic, shapley)]
                yield pa.RecordBatch.from_arrays(values, names=[c.split()[0] for c in RESULT.split(", ")])

    cells = hist.groupBy("part").agg(F.collect_list(F.struct(F.col("mask").cast("int").alias("mask"), "n", "n_good", "n_toxic")).alias("cells"))
    return cells.mapInArrow(run, RESULT)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return outcomes(histograms(labelled(failures(docs), labels)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


ORACLE = r"""
WITH l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '[ \x09-\x0D]+'), lambda x: x <> '') AS words, min(coalesce(doc_id, -9223372036854775807 - 1)) OVER (PARTITION BY text) AS least FROM t),
f AS (SELECT w.doc_id, part, CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
        + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
        + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 3 * length(text) THEN 4 ELSE 0 END
        + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
        + CASE WHEN coalesce(w.doc_id, -9223372036854775807 - 1) > least THEN 16 ELSE 0 END AS mask,
        coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
h AS (SELECT part, mask, count(*) AS n, sum(CASE WHEN good THEN 1 ELSE 0 END) AS n_good, sum(CASE WHEN toxic THEN 1 ELSE 0 END) AS n_toxic FROM f GROUP BY part, mask),
x AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(k, b)),
o AS (SELECT a.k || b.k || c.k || d.k || e.k AS filter_order, a.b AS b1, b.b AS b2, c.b AS b3, d.b AS b4, e.b AS b5 FROM x a, x b, x c, x d, x e
      WHERE a.b + b.b + c.b + d.b + e.b = 31 AND a.b | b.b | c.b | d.b | e.b = 31),
s AS (SELECT filter_order, 1 AS step, b1 AS own, 0 AS before FROM o UNION ALL SELECT filter_order, 2, b2, b1 FROM o UNION ALL
      SELECT filter_order, 3, b3, b1 + b2 FROM o UNION ALL SELECT filter_order, 4, b4, b1 + b2 + b3 FROM o UNION ALL SELECT filter_order, 5, b5, 31 - b5 FROM o),
r AS (SELECT part, filter_order, step, own,
        sum(CASE WHEN mask & (own | before) = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN mask & own <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN n_good ELSE 0 END) AS good_lost,
        sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN n_toxic ELSE 0 END) AS toxic_lost FROM h, s GROUP BY part, filter_order, step, own)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r
"""

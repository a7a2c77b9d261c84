"""Mixing sources to target weights by systematic sampling, with DataFrame functions only.

Every source gets a target number of words: the sources, by code point with null last, weigh 3, 1, 2, repeating;
together they share ``SHARE`` times all words; no target exceeds ``MOST`` times its source's words, and what is
beyond is shared again by weight. Within a source the documents stand in the order of their size; each
expects target / source size copies, the expectations are summed up along that order, a random offset in [0, 1)
that follows from the source's name is added, and a copy is emitted for every whole number that is crossed. So
each document gets the floor or the ceiling of its expectation, and neighbours in size make up for each other.

Null and empty texts have size 0 and never count as taken words; a source without words has target 0. A null
source is a source of its own. Repeated rows are rows like any other, equal sizes go by id and text, texts of any length are
counted whole, an empty table gives no rows. Columns beyond the four that are read are left
alone. The table of sources (one row each) is summed up in one task; documents never are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import WORD, ranked, sorted_slices

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2
_OWN = ["__none", "__source"]


def source_targets(sizes: DataFrame) -> DataFrame:
    """One row per source: ``__none``, ``__source``, source_size, target."""
    sources = sizes.groupBy(*_OWN).agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(*_OWN)) - 1
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    cap = MOST * F.col("source_size")
    rows = sources.withColumn("w", F.element_at(weights, (place % len(WEIGHTS) + 1).cast("int"))).withColumn("cap", cap)
    rows = rows.withColumn("all", SHARE * F.sum("source_size").over(Window.partitionBy()))
    # sources reach their cap in the order of cap / weight; the first that does not sets the words per weight
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), *_OWN)
    before = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("level", (F.col("all") - before) / left).withColumn("at", F.row_number().over(by_ratio))
    free = F.min(F.when(F.col("cap") / F.col("w") > F.col("level"), F.struct("at", "level"))).over(Window.partitionBy())
    rows = rows.withColumn("free", free)
    target = F.when(F.col("at") >= F.col("free.at"), F.col("w") * F.col("free.level")).otherwise(F.col("cap").cast("double"))
    return rows.select(*_OWN, "source_size", target.alias("target"))


def _slices(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns as ``row`` and the size, in the order of sampling."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.struct(*columns).alias("row"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.col("source").isNull().alias("__none"),
        F.coalesce("source", F.lit("")).alias("__source"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-1).cast("long")).alias("__id"),
        F.xxhash64(text).alias("__text"),
    )
    return sorted_slices(rows, [*_OWN, "size", "__id", "__text"], "mix")


def _with_copies(held: DataFrame) -> DataFrame:
    """row, size, source_size, target, and copies: how often the mix has the row."""
    targets = source_targets(held.select(*_OWN, "size"))
    # 20 bits, so that sums with whole numbers are exact
    name = F.concat(F.when(F.col("__none"), "0").otherwise("1"), "__source")
    offset = F.conv(F.substring(F.md5(name.cast("binary")), 1, 5), 16, 10).cast("double") / 2**20
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = ranked(held, _OWN).join(targets, _OWN).withColumns({"__each": each, "__offset": offset})
    upto = [F.floor((F.col("__rank") + step) * F.col("__each") + F.col("__offset")) for step in (0, 1)]
    copies = F.least(upto[1] - upto[0], F.lit(MOST)).cast("int")
    return rows.select("row", "size", "source_size", "target", copies.alias("copies"))


def mix_table(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, source: one row per document."""
    out = _with_copies(_slices(docs, ["doc_id", "source"]))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return out.select("row.doc_id", "size", "source_size", "target", taken, "copies", "row.source")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: every row of ``docs``, with all its columns, as often as the mix has it."""
    out = _with_copies(_slices(docs, docs.columns)).where("copies > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1] AS w,
    2 * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS total FROM s
), o AS (
  SELECT *, row_number() OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST) AS pos,
    (total - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
      / (sum(w) OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS lvl FROM w
), f AS (
  SELECT min(pos) AS pos FROM o WHERE cap::DOUBLE / w > lvl
), t AS (
  SELECT o.source, o.source_size,
    CASE WHEN o.pos >= f.pos THEN o.w * (SELECT lvl FROM o, f WHERE o.pos = f.pos) ELSE o.cap::DOUBLE END AS target FROM o, f
), r AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
    row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) - 1 AS rnk,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS per,
    ('0x' || substr(md5(CASE WHEN d.source IS NULL THEN '0' ELSE '1' || d.source END), 1, 5))::BIGINT / 1048576.0::DOUBLE AS shift
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), c AS (
  SELECT *, least((floor((rnk + 1) * per + shift) - floor(rnk * per + shift))::INTEGER, 2) AS copies FROM r
)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies, source FROM c
"""

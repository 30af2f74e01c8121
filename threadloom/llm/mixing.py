"""Operator 6: sources mixed to target weights by hash order and exact cuts.

Every document gets a key from a hash of its id, so the order within a source is random but the
same in every run. The keys' high bits split a source into equal ranges. A document's place in the
running sum of sizes is the sum of the ranges before its own (a window over one row per range)
plus the sum within its range, so a source that holds most of the table is sorted in many tasks.
A source's budget is spent in whole epochs first; the epoch that it ends in is cut at the exact
size, inside a document if need be.

Defined cases: a null text has size 0. A null source is a source of its own, last in order. Rows
are taken one by one, so repeated rows or null ids count each; rows with equal keys are ordered by
size and then share the sum among equals in any order, which changes no total. Sources without any
words have target 0. An empty table gives an empty table. Other columns of the input are ignored
here; :func:`mix_documents` keeps them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.sources.tables import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
RANGES = 1024


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(doc_id: Column) -> Column:
    """32 random bits of an id, as a long."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``(source, source_size, target)`` from one row ``(source, source_size)`` per source.

    Weights repeat over the sources in code point order, null last. Together the targets are
    ``share`` of all sizes; none is above ``most`` times its source, and what is cut off goes to
    the other sources by weight until none is above. Only sums over sources reach the driver.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights)).cast("int") + 1)
    table = stage(
        sizes.withColumn("_weight", weight).withColumn("_most", most * F.col("source_size")), "sources"
    )
    total = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    full = F.lit(False)
    while True:
        spent, weight_left = table.agg(
            F.sum(F.when(full, F.col("_most"))), F.sum(F.when(~full, F.col("_weight")))
        ).first()
        if not weight_left:
            break
        rate = (total - (spent or 0.0)) / weight_left
        above = full | (F.col("_weight") * rate > F.col("_most"))
        if table.where(above & ~full).isEmpty():
            break
        full = above
    rated = F.col("_weight") * rate if weight_left else F.col("_most")
    return table.select(
        "source", "source_size", F.when(full, F.col("_most")).otherwise(rated).alias("target")
    )


def mix(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST,
    key: str = "doc_id", text: str = "text", source: str = "source", ranges: int = RANGES,
    row: str | None = None,
) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken)`` for every document.

    ``taken`` is the number of words the mix takes of a document, repeats counted. ``row`` names a
    column that is different in every row; it is kept, and orders rows that are else alike.
    """
    own = [row] if row else []
    sized = docs.select(
        F.col(key).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
        order_key(F.col(key)).alias("_key"), *own,
    ).withColumn("_range", F.expr(f"(_key * {ranges}) div 4294967296"))
    rows = stage(sized, "sizes")
    by_range = stage(
        rows.groupBy("source", "_range").agg(F.sum("size").alias("_sum")), "ranges"
    )
    before = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_range.select(
        "source", "_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before")
    )
    plan = targets(by_range.groupBy("source").agg(F.sum("_sum").alias("source_size")), weights, share, most)
    inner = (
        Window.partitionBy("source", "_range").orderBy("_key", "doc_id", "size", *own)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = rows.withColumn("_inner", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    offsets = offsets.withColumnsRenamed({"source": "_s", "_range": "_r"})
    plan = plan.withColumnRenamed("source", "_p")
    joined = (
        placed.join(offsets, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_range") == F.col("_r")))
        .join(plan, F.col("source").eqNullSafe(F.col("_p")))
    )
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(0)
    rest = budget - epochs * F.col("source_size")
    cut = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_before") - F.col("_inner")))
    return joined.select(
        "doc_id", "source", "size", "source_size", F.col("target").cast("double"),
        (epochs * F.col("size") + cut).cast("long").alias("taken"), *own,
    )


def mix_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mixed documents: each row as often as the mix takes it whole, and the one document per
    source that the budget ends in shortened to the words taken. Columns are those of ``docs``.

    Documents without words are kept once, as there is nothing of them to mix. Rows are told apart
    by a number written with them, so null and repeated ids are rows as any other.
    """
    columns = docs.columns
    docs = stage(docs.withColumn("_mix_row", F.monotonically_increasing_id()), "mixed")
    taken = mix(docs, row="_mix_row", **settings).select(
        F.col("_mix_row").alias("_at"), F.col("size").alias("_size"), F.col("taken").alias("_taken")
    )
    rows = docs.join(taken, F.col("_mix_row") == F.col("_at"))
    whole = F.when(F.col("_size") > 0, F.expr("_taken div _size")).otherwise(1).cast("int")
    part = F.when(F.col("_size") > 0, F.col("_taken") % F.col("_size")).otherwise(0)
    copies = rows.withColumn("_part", part).withColumn(
        "_copy", F.explode(F.concat(F.array_repeat(F.lit(0), whole), F.array_repeat(F.lit(1), F.signum("_part").cast("int"))))
    )
    head = F.concat_ws(" ", F.slice(F.regexp_extract_all("text", F.lit(f"({WORD})")), F.lit(1), F.col("_part").cast("int")))
    return copies.withColumn("text", F.when(F.col("_copy") == 1, head).otherwise(F.col("text"))).select(*columns)


SQL = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS k FROM documents),
sources AS (
  SELECT source, sum(size)::DOUBLE AS s,
    [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM sized GROUP BY source),
ratios AS (SELECT *, 2 * s / w AS r FROM sources),
levels AS (  -- with every source up to this ratio full, the rate that spends the total
  SELECT a.r,
    (1.5 * (SELECT sum(s) FROM sources) - coalesce(sum(2 * b.s) FILTER (b.r <= a.r), 0))
      / nullif(sum(b.w) FILTER (b.r > a.r), 0) AS rate
  FROM (SELECT 0::DOUBLE AS r UNION SELECT r FROM ratios) a CROSS JOIN ratios b GROUP BY a.r),
rate AS (
  SELECT min_by(rate, r) AS rate FROM levels
  WHERE rate IS NOT NULL AND rate <= (SELECT min(r) FROM ratios WHERE ratios.r > levels.r)),
plan AS (SELECT source, s, CASE WHEN w * rate > 2 * s THEN 2 * s ELSE w * rate END AS target FROM ratios, rate),
placed AS (
  SELECT d.*, p.s::BIGINT AS source_size, p.target,
    CASE WHEN p.s > 0 THEN floor(p.target)::BIGINT // p.s::BIGINT ELSE 0 END AS epochs,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, round(target, 3) AS target,
  (epochs * size + greatest(0, least(size, floor(target)::BIGINT - epochs * source_size - before)))::BIGINT AS taken
FROM placed
"""

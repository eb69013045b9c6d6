"""Mixing sources to target weights by Sainte-Laguë apportionment.

The mix has as many words as the documents have. A source's target is its share by weight, but at most ``MOST`` times
its own words; what that leaves over goes to the other sources by weight, until no target is above its limit.

Words are handed out in blocks of ``BLOCK``. First the sources, then within each source its shards get whole blocks by
highest quotients (target / 1, 3, 5, ...). A shard is a seeded sample of a source's documents of about
``ROWS_PER_SHARD`` rows, so no window ever covers a whole source. Within a shard the documents stand in seeded order;
its quota of blocks is taken from the front of that order, going round at most ``MOST`` times. A document's ``taken``
is the number of its words in the blocks taken, repeats counted.

A null or empty text has size 0 and nothing is taken of it. A null source is a source of its own, the last one. An empty
table gives an empty mix. Rows that agree in everything are mixed one by one; they share their place in the seeded
order, which changes nothing but which of them is called first.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastemine.llm import common
from tastemine.operators.indexing import dense_index
from tastemine.session import checkpoint

SEED = 42
BLOCK = 32
MOST = 3
WEIGHTS = (1, 2, 3)
ROWS_PER_SHARD = 4096
#: a table of one row per source is broadcast only up to this many sources
BROADCAST_SOURCES = 20_000


def _exact(n: int) -> Column:
    return F.lit(Decimal(n)).cast("decimal(38,0)")


def targets(sources: DataFrame) -> DataFrame:
    """Add ``weight`` and ``target`` to a table (source, source_size). One small aggregation per round; a round fixes
    the targets of the sources that are above their limit at the present level ``num / den`` per unit of weight."""
    ranked = dense_index(sources, [F.col("source").asc_nulls_last()], "_rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("_rank") % len(WEIGHTS) + 1).cast("int"))
    ranked = checkpoint(ranked.withColumn("weight", weight.cast("bigint")), few=True)
    total = ranked.agg(F.sum(F.col("source_size").cast("decimal(38,0)")), F.sum("weight")).first()
    whole, weights = int(total[0] or 0), int(total[1] or 0)
    num, den, full = whole, max(1, weights), F.lit(False)
    limit = MOST * F.col("source_size")
    while True:
        full = limit.cast("decimal(38,0)") * _exact(den) < F.col("weight").cast("decimal(38,0)") * _exact(num)
        got = ranked.where(full).agg(F.sum(limit.cast("decimal(38,0)")), F.sum("weight")).first()
        left, rest = whole - int(got[0] or 0), max(1, weights - int(got[1] or 0))
        if (left, rest) == (num, den):
            break
        num, den = left, rest
    share = F.col("weight").cast("double") * F.lit(float(num)) / F.lit(float(den))
    return ranked.withColumn("target", F.when(full, limit.cast("double")).otherwise(share)).drop("_rank")


def apportion(cells: DataFrame, key: list[str], within: str | None, weight: str, seats: str) -> DataFrame:
    """Add ``quota``: of the ``seats`` of each group (``within``; None: one group), those that go to each cell with the
    highest quotients ``weight`` / 1, 3, 5, ...; equal quotients by ``key``.

    Rounding at the divisor weight / seats gives all but a few seats. Raising or lowering it by ``e`` seats changes a
    cell by at most weight * (|e| + cells) / all weight + 1 seats, so only that many quotients of each are ranked: in
    all at most a small multiple of the number of cells, whatever the number of seats."""
    group = [within] if within else []
    out = cells.columns
    frame = Window.partitionBy(*group) if group else None
    w, n = F.col(weight), F.col(seats)
    if frame is not None:
        cells = cells.withColumn("_all", F.sum(w).over(frame)).withColumn("_cells", F.count(F.lit(1)).over(frame))
    else:
        cells = cells.crossJoin(F.broadcast(cells.agg(F.sum(w).alias("_all"), F.count(F.lit(1)).alias("_cells"))))
    cells = cells.withColumn("_base", F.when(F.col("_all") > 0, F.floor(w * n / F.col("_all") + 0.5)).otherwise(F.lit(0)).cast("bigint"))
    if frame is not None:
        cells = cells.withColumn("_e", n - F.sum("_base").over(frame))
    else:
        cells = cells.crossJoin(F.broadcast(cells.agg(F.sum("_base").alias("_sum")))).withColumn("_e", n - F.col("_sum")).drop("_sum")
    cells = checkpoint(cells, few=True)
    some = F.ceil(w * (F.abs(F.col("_e")) + F.col("_cells")) / F.col("_all")).cast("bigint") + 1
    first = F.when(F.col("_e") > 0, F.col("_base")).otherwise(F.greatest(F.col("_base") - some, F.lit(0)))
    last = F.when(F.col("_e") > 0, F.col("_base") + some).otherwise(F.col("_base")) - 1
    near = cells.where((F.col("_e") != 0) & (F.col("_all") > 0) & (w > 0) & (first <= last))
    near = near.select(*key, "_e", w.alias("_w"), F.explode(F.sequence(first, last)).alias("_k"))
    near = near.withColumn("_q", F.col("_w") / (2 * F.col("_k") + 1)).withColumn("_up", F.when(F.col("_e") > 0, -F.col("_q")).otherwise(F.col("_q")))
    by = ["_up", *[F.when(F.col("_e") > 0, F.col(k)).asc_nulls_last() for k in key], *[F.when(F.col("_e") < 0, F.col(k)).desc_nulls_first() for k in key]]
    if frame is not None:
        near = near.withColumn("_place", F.row_number().over(Window.partitionBy(*group).orderBy(*by)) - 1)
    else:
        near = dense_index(near, by, "_place")
    moved = near.where(F.col("_place") < F.abs(F.col("_e"))).groupBy(*key).agg(F.sum(F.signum("_e")).cast("bigint").alias("_moved"))
    moved = moved.select(*[F.col(k).alias(f"_of_{k}") for k in key], "_moved")
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return cells.join(moved, same, "left").select(*out, (F.col("_base") + F.coalesce(F.col("_moved"), F.lit(0))).alias("quota"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED, carry: bool = False) -> DataFrame:
    """One row per document: id, ``size``, ``source_size``, ``target``, ``taken`` (with ``carry`` also ``_row``)."""
    sized = lambda carry: common.packed(docs, carry, _id=F.col(f"`{id_col}`"), source=F.col(f"`{source_col}`"), size=common.word_count(common.text_of(text_col)))
    sources = sized(False).groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    sources = targets(checkpoint(sources, few=True))
    seats = sources.agg(F.round(F.sum("source_size") / F.lit(BLOCK)).cast("bigint").alias("seats"))
    sources = apportion(sources.crossJoin(F.broadcast(seats)), ["source"], None, "target", "seats")
    sources = checkpoint(sources.withColumn("shards", F.ceil(F.col("rows") / F.lit(ROWS_PER_SHARD)).cast("bigint")).withColumnRenamed("quota", "blocks").withColumnRenamed("source", "_s").drop("seats"), few=True)
    table = F.broadcast(sources) if sources.count() <= BROADCAST_SOURCES else sources

    def dealt(carry: bool) -> DataFrame:
        df = sized(carry).withColumn("_key", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit("")))))
        df = df.join(table, F.col("source").eqNullSafe(F.col("_s")))
        return df.withColumn("shard", F.conv(F.substring("_key", 1, 8), 16, 10).cast("bigint") % F.col("shards"))

    shards = dealt(False).groupBy("_s", "shard").agg(F.sum("size").alias("shard_size"), F.first("blocks").alias("blocks"))
    shards = apportion(checkpoint(shards, few=True), ["_s", "shard"], "_s", "shard_size", "blocks")
    shards = shards.select(F.col("_s").alias("_s2"), F.col("shard").alias("_shard2"), "shard_size", F.least(F.col("quota") * BLOCK, MOST * F.col("shard_size")).alias("_words"))
    # the words before a document, in seeded order within its shard; some thousand rows at a time
    before = Window.partitionBy("_s", "shard").orderBy("_key", F.col("_id").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    df = dealt(carry).withColumn("_before", F.coalesce(F.sum("size").over(before), F.lit(0)))
    df = df.join(shards, F.col("_s").eqNullSafe(F.col("_s2")) & (F.col("shard") == F.col("_shard2")), "left")
    rounds = F.when(F.col("shard_size") > 0, F.floor(F.col("_words") / F.col("shard_size"))).otherwise(F.lit(0)).cast("bigint")
    part = F.col("_words") - rounds * F.col("shard_size") - F.col("_before")
    taken = rounds * F.col("size") + F.greatest(F.lit(0), F.least(part, F.col("size")))
    return df.select(F.col("_id").alias(id_col), "size", "source_size", "target", taken.cast("bigint").alias("taken"), *([F.col(common.ROW)] if carry else []))


def mixed_documents(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The mix as documents: each as often as the mix takes it whole, and once more, cut after its last word taken, if
    the mix takes only a part the last time (at most one document per shard)."""
    df = mix(docs, carry=True).where(F.col("taken") > 0)
    df = df.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.ceil(F.col("taken") / F.col("size")).cast("bigint"))))
    rest = F.col("taken") - (F.col("_copy") - 1) * F.col("size")
    text = F.col(common.ROW).getField(text_col)
    pieces = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])", -1)  # each a word and the space before it
    cut = F.when(rest < F.col("size"), F.array_join(F.slice(pieces, F.lit(1), rest.cast("int")), "")).otherwise(text)
    new = df.withColumn("_cut", cut)
    row = F.col(common.ROW).withField(text_col, F.col("_cut"))
    if length_col in docs.columns:
        row = row.withField(length_col, F.when(F.length("_cut") < F.length(text), F.length("_cut")).otherwise(F.col(common.ROW).getField(length_col)).cast(docs.schema[length_col].dataType))
    return common.unpacked(new.withColumn(common.ROW, row), docs)


def query(spark, sf_dir):
    """op5: what the mix of all documents takes of each."""
    return mix(common.documents(spark, sf_dir))


SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5('{SEED}:' || doc_id) AS k
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n,
         1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % {len(WEIGHTS)} AS weight
  FROM d GROUP BY source
), level AS (
  SELECT 0 AS i, CAST(sum(source_size) AS HUGEINT) AS num, CAST(sum(weight) AS HUGEINT) AS den FROM s
  UNION ALL
  SELECT i + 1, (SELECT sum(source_size) FROM s) - coalesce((SELECT sum({MOST} * source_size) FROM s WHERE {MOST} * source_size * den < weight * num), 0),
         (SELECT sum(weight) FROM s) - coalesce((SELECT sum(weight) FROM s WHERE {MOST} * source_size * den < weight * num), 0)
  FROM level WHERE i < 50
), last AS (SELECT num, den FROM level WHERE i = 50),
t AS (
  SELECT s.*, CASE WHEN {MOST} * source_size * den < weight * num THEN CAST({MOST} * source_size AS DOUBLE)
              ELSE CAST(weight AS DOUBLE) * CAST(num AS DOUBLE) / CAST(den AS DOUBLE) END AS target
  FROM s, last
), house AS (SELECT CAST(round(sum(source_size) / {BLOCK}.0) AS BIGINT) AS seats FROM s),
won AS (
  SELECT source, count(*) AS blocks FROM (
    SELECT source, row_number() OVER (ORDER BY q DESC, source NULLS LAST) AS place
    FROM (SELECT source, target / (2 * unnest(range(0, CAST(target / {BLOCK} AS BIGINT) + 50)) + 1) AS q FROM t WHERE target > 0)
  ) WHERE place <= (SELECT seats FROM house) GROUP BY source
), e AS (
  SELECT d.*, t.source_size, t.target, coalesce(won.blocks, 0) AS blocks,
         CAST('0x' || substr(k, 1, 8) AS BIGINT) % CAST(ceil(t.n / {ROWS_PER_SHARD}.0) AS BIGINT) AS shard
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN won ON d.source IS NOT DISTINCT FROM won.source
), sh AS (
  SELECT source, shard, CAST(sum(size) AS BIGINT) AS shard_size, max(blocks) AS blocks FROM e GROUP BY source, shard
), got AS (
  SELECT source, shard, count(*) AS quota FROM (
    SELECT source, shard, blocks, row_number() OVER (PARTITION BY source ORDER BY q DESC, shard) AS place
    FROM (SELECT source, shard, blocks, shard_size / (2.0::DOUBLE * unnest(range(0, blocks)) + 1) AS q FROM sh WHERE shard_size > 0)
  ) WHERE place <= blocks GROUP BY source, shard
), p AS (
  SELECT e.*, sh.shard_size, least(coalesce(quota, 0) * {BLOCK}, {MOST} * sh.shard_size) AS words,
         coalesce(sum(size) OVER (PARTITION BY e.source, e.shard ORDER BY k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM e JOIN sh ON e.source IS NOT DISTINCT FROM sh.source AND e.shard = sh.shard
         LEFT JOIN got ON e.source IS NOT DISTINCT FROM got.source AND e.shard = got.shard
)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN shard_size > 0 THEN (words // shard_size) * size + greatest(0, least(words % shard_size - before, size)) ELSE 0 END AS BIGINT) AS taken
FROM p
"""

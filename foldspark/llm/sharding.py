"""Shards by proportional stratified interleaving.

The rows of every source are put into a seeded random order, and a row's rank in
it, as a fraction of its source's rows, says where it belongs in the whole: the
first tenth of each source comes in the first tenth of the result. Sorting all rows
by that fraction mixes the sources evenly, and cutting the sorted rows into equal
runs gives shards that each hold the mixture of the whole, up to rounding: sources
neither run out early nor come in blocks.

Both orders are range partitions: the rows are dealt by sampled bounds of the whole
sort key, which holds a hash, so a source of a third of all rows is spread over a
third of the partitions. Ranks are a row's place in its partition plus the rows of
earlier partitions; only counts per partition and source are summed for that.

The law is ``rows``: counts of shards differ by one at most. A row's shard does not
depend on its text, so equal texts are not held together.

Defined cases: a null text is empty (size 16, CRC 0); a null source is a source of
its own; a null id is ordered first and hashed as an empty string; repeated rows are
rows like others, each with its own slot, and rows equal in id, size and CRC are
interchangeable; an empty table gives no rows; a text's length does not matter, as
only its size and CRC travel; other columns of the input, whatever their names, are
not read by ``interleave`` and travel in one column in ``write``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldspark.llm.shared import checkpoint, whole

#: Added to every text's bytes.
OVERHEAD = 16
#: Rows of counts that may be broadcast; above it they are joined.
BROADCAST_ROWS = 50_000
_PLACE = (1 << 33) - 1


def _in_order(rows: DataFrame, by: list[str | Column]) -> DataFrame:
    """``rows`` sorted over all partitions and written down, with ``part`` and ``place`` of each row in its part."""
    at = F.monotonically_increasing_id()
    ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    return checkpoint(
        ordered.withColumn("part", F.shiftright(at, 33)).withColumn("place", at.bitwiseAND(F.lit(_PLACE)))
    )


def _fractions(ordered: DataFrame) -> DataFrame:
    """Rows in the order of source, with ``fraction``: the middle of the row's own span in its source."""
    counts = ordered.groupBy("part", "source").agg(F.count(F.lit(1)).alias("c"), F.min("place").alias("first"))
    # a source has one row of counts a partition
    own = Window.partitionBy("source")
    before = F.sum("c").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = checkpoint(
        counts.select(
            F.col("part").alias("_part"),
            F.col("source").alias("_source"),
            (F.coalesce(before, F.lit(0)) - F.col("first")).alias("_shift"),
            F.sum("c").over(own).alias("_n"),
        )
    )
    if counts.count() <= BROADCAST_ROWS:
        counts = F.broadcast(counts)
    same = (F.col("part") == F.col("_part")) & F.col("source").eqNullSafe(F.col("_source"))
    rank = F.col("place") + F.col("_shift")
    fraction = (rank * 2 + 1).cast("double") / (F.col("_n") * 2).cast("double")
    return ordered.join(counts, same).withColumn("fraction", fraction).drop(
        "part", "place", "_part", "_source", "_shift", "_n"
    )


def interleave(
    docs: DataFrame,
    shards: int = 40,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    carry: Column | None = None,
) -> DataFrame:
    """Per row of ``docs``: doc_id, source, size, text_crc32, law, shard (from 0) and slot (from 0 in its shard).

    ``carry`` is an expression over ``docs`` that comes along as ``carried``.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    text = whole(text_col)
    named = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.substring(F.md5(F.concat(F.lit(f"{seed}:"), named)), 1, 16).alias("lot"),
        *([] if carry is None else [carry.alias("carried")]),
    )
    ties = ["lot", "doc_id", "size", "text_crc32"]
    mixed = _in_order(_fractions(_in_order(rows, ["source", *ties])), ["fraction", *ties])
    # one count a partition
    counts = {r["part"]: r["count"] for r in mixed.groupBy("part").count().collect()}
    starts, total = [0], 0
    for part in range(max(counts, default=-1) + 1):
        total += counts.get(part, 0)
        starts.append(total)
    position = F.element_at(F.array(*[F.lit(s).cast("long") for s in starts]), (F.col("part") + 1).cast("int")) + F.col("place")
    total = max(total, 1)
    placed = mixed.withColumn("position", position)
    placed = placed.withColumn("shard", F.expr(f"cast(position * {shards} div {total} as int)"))
    first = F.expr(f"(cast(shard as long) * {total} + {shards - 1}) div {shards}")
    return placed.select(
        "doc_id",
        "source",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("position") - first).alias("slot"),
        *([] if carry is None else ["carried"]),
    )


def write(docs: DataFrame, folder: str, shards: int = 40, seed: int = 0, **columns: str) -> None:
    """Whole rows of ``docs`` as Parquet, one folder ``shard=k`` each, rows with their ``slot`` and in its order.

    A shard is written by several tasks (its slots are cut into runs), so its size is not bound to one task.
    """
    found = interleave(docs, shards, seed, carry=F.struct(*docs.columns), **columns)
    rows = found.select(F.col("carried").alias("row"), "slot", "shard")
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)

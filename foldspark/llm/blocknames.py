"""Exact duplicates by deterministic block names.

A normalised text is cut into blocks of ``block`` bytes. The distinct blocks are
sorted, and a block's place in that order is its name. Adjacent names are then
paired and the distinct pairs sorted and named in the same way, level by level,
until every document has one name. Equal names mean equal content by
construction: no step trusts a digest. Digests serve only to bring names back to
the rows, after a count has shown that no two distinct blocks share one; should
two ever do, blocks are joined by their bytes.

Distinct blocks and pairs are combined before every shuffle, so thousands of
copies cost one row per task. Rows are told apart by id and text digest.

Defined cases: a null text counts as empty, and all empty texts are equal;
repeated rows (same id, same text) are one member each of their group and share
its decision; null ids are compared as equal and lose ties against any other id;
an empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldspark.llm.shared import WHITE, checkpoint, rows_of, whole

BLOCK = 4096
_ROW = ["doc_id", "text_sha256"]


def normalised(text: str | Column) -> Column:
    """The text without its white space."""
    return F.translate(whole(text), WHITE, "")


def _named(things: DataFrame, by: list[Column]) -> DataFrame:
    """Distinct rows of ``things`` in the order of ``by``, which tells them apart, with their place in it as ``name``."""
    # the last key only breaks ties within a partition
    bounds = by[:-1] if len(by) > 2 else by
    ordered = things.distinct().repartitionByRange(*bounds).sortWithinPartitions(*by)
    return ordered.withColumn("name", F.monotonically_increasing_id())


def _block_order() -> list[Column]:
    """Blocks by their first bytes, then by a hash, then whole.

    The first two bound the partitions, so that the sample that sets the bounds
    holds a few bytes a block; the sort in a partition goes on to the whole block.
    """
    return [F.substring("content", 1, 16), F.xxhash64("content"), F.col("content")]


def _same_row(other: DataFrame, rows: DataFrame, keys: list[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition &= rows[key].eqNullSafe(other[key])
    return condition


def document_names(docs: DataFrame, id_col: str, text_col: str, block: int = BLOCK) -> DataFrame:
    """One row per distinct (doc_id, text_sha256): levels and name, equal for equal normalised texts only."""
    bytes_ = F.encode(normalised(text_col), "UTF-8")
    rows = docs.select(F.col(id_col).alias("doc_id"), bytes_.alias("bytes"))
    rows = rows.withColumn("text_sha256", F.sha2("bytes", 256))
    n_blocks = F.greatest(F.ceil(F.octet_length("bytes") / F.lit(block)), F.lit(1)).cast("int")
    cut = F.transform(
        F.sequence(F.lit(0), n_blocks - 1),
        lambda i: F.struct(
            i.alias("at"), F.substring(F.col("bytes"), i * F.lit(block) + F.lit(1), F.lit(block)).alias("content")
        ),
    )
    pieces = rows.select("doc_id", "text_sha256", n_blocks.alias("n"), F.explode(cut).alias("b")).select(
        "doc_id", "text_sha256", "n", "b.*"
    )
    pieces = pieces.withColumn("digest", F.sha2("content", 256))
    names = _named(pieces.select("content"), _block_order())
    names = checkpoint(names.select(F.sha2("content", 256).alias("digest"), "name"))
    shared = names.groupBy("digest").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    if shared.isEmpty():
        level = pieces.drop("content").join(names, "digest")
    else:
        level = pieces.join(_named(pieces.select("content"), _block_order()), "content")
    level = checkpoint(level.select("doc_id", "text_sha256", "n", "at", "name").distinct())
    done = level.filter("n = 1").select("doc_id", "text_sha256", F.lit(0).alias("levels"), "name")
    height = 0
    while True:
        open_ = level.filter("n > 1")
        if open_.isEmpty():
            return done
        height += 1
        half = F.col("at").bitwiseAND(1)
        pairs = open_.groupBy("doc_id", "text_sha256", "n", F.shiftright("at", 1).alias("at")).agg(
            F.max(F.when(half == 0, F.col("name"))).alias("first"),
            F.coalesce(F.max(F.when(half == 1, F.col("name"))), F.lit(-1)).alias("second"),
        )
        pairs = pairs.withColumn("n", F.ceil(F.col("n") / 2).cast("int"))
        names = _named(pairs.select("first", "second"), [F.col("first"), F.col("second")])
        level = checkpoint(pairs.join(names, ["first", "second"]).select("doc_id", "text_sha256", "n", "at", "name"))
        done = done.unionByName(level.filter("n = 1").select("doc_id", "text_sha256", F.lit(height).alias("levels"), "name"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts, the row with the most code points in the original text
    stays, then the one with the smallest id.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.sha2(F.encode(normalised(text_col), "UTF-8"), 256).alias("text_sha256"),
        F.char_length(whole(text_col)).cast("long").alias("length"),
    )
    names = document_names(docs, id_col, text_col, block)
    members = rows.alias("r").join(names.alias("k"), _same_row(names, rows, _ROW)).select(
        rows["doc_id"], rows["text_sha256"], "length", "levels", "name"
    )
    members = checkpoint(members)
    # the longest row, then the smallest id: nulls of max_by's key sort first, so a null id loses
    groups = members.groupBy("levels", "name").agg(
        F.max_by("doc_id", F.struct("length", (-F.col("doc_id")).alias("order"))).alias("keep_id"),
        F.count(F.lit(1)).alias("group_size"),
    )
    found = members.join(groups, ["levels", "name"])
    return found.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that stay, whole: one of each group of equal texts.

    Of repeated rows (one id, equal texts) one of the longest stays.
    """
    found = exact_duplicates(docs, id_col, text_col, block).filter("kept")
    found = found.groupBy(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_digest")).agg(
        F.count(F.lit(1)).alias("_copies")
    )
    return rows_of(docs, found, id_col, F.sha2(F.encode(normalised(text_col), "UTF-8"), 256))

"""Packing of tokenised documents into sequences: shortest pack first over the histogram of lengths.

Documents become pieces of at most ``size`` ids: full ones, and a rest. Only the
histogram of piece lengths (at most ``size`` rows) reaches the driver. There,
lengths are placed from the longest to the shortest, each into the shortest pack
with room for it; what is kept is not single packs but patterns (lists of
lengths) with counts. A pattern's slots are then intervals of ranks among the
pieces of a length, and each piece finds its slot by its own rank.

Ranks need no sort: a piece's rank is its place within the partition that
encoded it plus the number of such pieces in the partitions before. The pieces
are written once to the shared folder, so a lost executor changes no rank.

Defined cases: a null text is empty and is a single end id; repeated rows and rows with a
null id are documents of their own; an empty table gives no piece; other
columns of the input are not read.
"""

from __future__ import annotations

import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldspark.llm.shared import checkpoint, give_back, in_groups, shared_folder, whole
from foldspark.llm.tokens import ids_column, library_encoder


#: First ranks of up to so many partitions and lengths are broadcast (20 bytes each); more are joined by shuffles.
BROADCAST_ROWS = 500_000


def patterns_of(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Packs for ``histogram`` (length: number of pieces) as (lengths of a pack, number of such packs)."""
    open_packs: dict[int, Counter] = defaultdict(Counter)  # by the length filled so far
    filled: list[int] = []  # the filled lengths that have packs, ascending
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        placed: Counter = Counter()
        while left:
            # shortest pack first; packs made for this length count only afterwards, unless nothing else has room
            if filled and filled[0] + length <= size:
                at = filled[0]
                pattern, count = open_packs[at].popitem()
                if not open_packs[at]:
                    del open_packs[at]
                    filled.pop(0)
                take = min(left, count)
                if count > take:
                    if at not in open_packs:
                        filled.insert(0, at)
                    open_packs[at][pattern] += count - take
                placed[pattern + (length,)] += take
                left -= take
                continue
            fit = size // length
            if left >= fit:
                placed[(length,) * fit] += left // fit
            if left % fit:
                placed[(length,) * (left % fit)] += 1
            left = 0
        for pattern, count in placed.items():
            open_packs[sum(pattern)][pattern] += count
        filled = sorted(open_packs)
    return sorted((p, c) for packs in open_packs.values() for p, c in packs.items())


def slots_of(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """Per length, its slots in order: first rank, first sequence, place in the sequence (one row each)."""
    rows: dict[int, list] = defaultdict(list)
    used: Counter = Counter()
    first = 0
    for pattern, count in patterns:
        place = 0
        for length in pattern:
            rows[length].append((used[length], first, place))
            used[length] += count
            place += length
        first += count
    return {length: np.array(x, np.int64).T for length, x in rows.items()}


def encoded_pieces(docs: DataFrame, vocabulary: str, end_id: int, size: int, id_col: str, text_col: str) -> DataFrame:
    """One row per piece with its ids, and its place among the pieces of its length in its partition."""
    id_type = docs.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("part", T.IntegerType()),
            T.StructField("local_rank", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = library_encoder(vocabulary)
        seen = np.zeros(size + 1, np.int64)
        part = TaskContext.get().partitionId()
        for batch in batches:
            for rows in in_groups(batch, "text"):
                ids, offsets = encode(rows.column("text"))
                n = len(offsets) - 1
                ids = np.insert(ids, offsets[1:], end_id)
                offsets = offsets + np.arange(n + 1)
                tokens = np.diff(offsets)
                pieces = -(-tokens // size)
                doc = np.repeat(np.arange(n), pieces)
                nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = nth * size
                length = np.minimum(tokens[doc] - start, size)
                # rank among equal lengths: those before, and the place in this group
                order = np.argsort(length, kind="stable")
                by = length[order]
                begins = np.searchsorted(by, by, side="left")
                rank = np.empty(len(doc), np.int64)
                rank[order] = np.arange(len(doc)) - begins + seen[by]
                seen += np.bincount(length, minlength=size + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id").take(pa.array(doc)),
                        pa.array(start),
                        pa.array(length),
                        pa.array(tokens[doc]),
                        pa.array(np.full(len(doc), part, np.int32)),
                        pa.array(rank),
                        ids_column(ids, np.concatenate([offsets[doc] + start, offsets[-1:]])).cast(pa.binary()),
                    ],
                    names=schema.names,
                )
        give_back()

    return docs.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("text")).mapInArrow(cut, schema)


def pack(
    docs: DataFrame, vocabulary: str, end_id: int, size: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces of the documents with their place: doc_id, start, length, doc_tokens, ids, sequence_id, offset.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit integers.
    Sequence numbers are gapless from 0, offsets gapless in a sequence.
    """
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/pieces-{uuid.uuid4().hex}"
    pieces = encoded_pieces(docs, vocabulary, end_id, size, id_col, text_col)
    pieces.write.option("compression", "zstd").parquet(folder)
    pieces = spark.read.schema(pieces.schema).parquet(folder)
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    # one row per partition and length: bounded by partitions x size
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("first_rank", F.coalesce(F.sum("n").over(before), F.lit(0)))
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").agg(F.count(F.lit(1))).collect()}
    slots = slots_of(patterns_of(histogram, size))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        lengths, ranks = length.to_numpy(), rank.to_numpy()
        sequence, offset = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
        for one in np.unique(lengths):
            at = np.flatnonzero(lengths == one)
            from_rank, first, where = slots[one]
            k = np.searchsorted(from_rank, ranks[at], side="right") - 1
            sequence[at] = first[k] + ranks[at] - from_rank[k]
            offset[at] = where[k]
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    counts = checkpoint(counts.select("part", "length", "first_rank"))
    if counts.count() <= BROADCAST_ROWS:
        counts = F.broadcast(counts)
    placed = pieces.join(counts, ["part", "length"])
    placed = placed.withColumn("at", place("length", F.col("local_rank") + F.col("first_rank")))
    return placed.select("doc_id", "start", "length", "doc_tokens", "ids", "at.sequence_id", "at.offset")

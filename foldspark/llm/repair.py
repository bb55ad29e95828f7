"""Token files compressed by a grammar of frequent pairs (Re-Pair), with random access by document.

Documents are laid out in ascending id order and cut into shards of about
``shard_tokens`` ids. In a shard, frequent pairs of adjacent symbols are
replaced by nonterminals, round after round until no pair pays for its rule: a round counts all pairs, takes
those that occur at least ``least`` times, and replaces their occurrences
(where occurrences overlap, those of the more frequent pair, then every second
one). Pairs never cross documents. The shard stores the rules round by round
with the length each symbol expands to, the symbols, and each document's first
symbol, so that any document is decoded alone.

A shard is one value of a Parquet table that Spark writes, so it can live in any
store Spark reaches; its bytes are little-endian:

    magic "RPG1", then as unsigned 32-bit: documents, symbols, terminals, rounds, and for each round its rules
    terminals: the id that each stands for, unsigned 32-bit each
    rules: left and right symbol of each, unsigned 32-bit each; expansion length of each rule, unsigned 32-bit
    per document: first symbol, unsigned 32-bit; number of ids, unsigned 64-bit
    symbol width (2 or 4) as unsigned 32-bit, then the symbols

Symbols below ``terminals`` are the ids that occur, in order; the rule of symbol s is number s - terminals.

Defined cases: a null text is empty and holds only the end id; repeated rows and
rows that share an id are documents of their own, in any order among
themselves; null ids come first; an empty table writes no shard; other columns of the input are
not read. The table's folder must not exist.
"""

from __future__ import annotations

import itertools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldspark.llm.shared import checkpoint, give_back, hold, in_groups, whole
from foldspark.llm.tokens import ids_column, library_encoder

#: Occurrences from which a pair pays for its rule: 12 bytes, for 2 bytes saved each.
LEAST = 8
SHARD_TOKENS = 600_000
#: The first ids of up to so many parts are broadcast (12 bytes each); more are joined by shuffles.
BROADCAST_PARTS = 500_000
#: Pairs of a round where codes and places do not fit one key.
_MOST_PAIRS = 1 << 20


def _frequent(codes: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Where pairs met ``least`` times or more occur, the number of each occurrence's pair, pairs and counts by number,
    and where the pairs are that wait (none).

    Codes are sorted with their places in one key of 64 bits; nothing is found where these do not fit.
    """
    n = len(codes)
    bits = n.bit_length()
    if int(codes.max()).bit_length() + bits > 64:
        return (np.empty(0, np.int64),) * 5
    keys = codes.astype(np.uint64)
    keys <<= np.uint64(bits)
    keys |= np.arange(n, dtype=np.uint64)
    keys.sort()
    pairs = keys >> np.uint64(bits)
    starts = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
    sums = np.diff(np.append(starts, n))
    often = sums >= least
    counts = sums[often]
    keys &= np.uint64((1 << bits) - 1)
    number = np.full(n, -1, np.int32)
    number[keys[np.repeat(often, sums)].view(np.int64)] = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    found = np.flatnonzero(number >= 0)
    return found, number.take(found).astype(np.int64), pairs[starts[often]], counts, np.empty(0, np.int64)


def _frequent_exactly(codes: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """The same for codes of any width: the ``_MOST_PAIRS`` most frequent pairs; the others wait."""
    pairs, inverse, sums = np.unique(codes, return_inverse=True, return_counts=True)
    chosen = np.argsort(-sums, kind="stable")[:_MOST_PAIRS]
    chosen = chosen[sums[chosen] >= least]
    bin_of = np.full(len(sums), -1)
    bin_of[chosen] = np.arange(len(chosen))
    bins = bin_of[inverse]
    there = bins >= 0
    return np.flatnonzero(there), bins[there], pairs[chosen], sums[chosen], np.flatnonzero(~there)


def compress(
    ids: np.ndarray, offsets: np.ndarray, terminals: int, rounds: int | None = None, least: int = LEAST
) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Symbols, the first symbol of each document (and the end), and per round the replaced pairs (n x 2).

    ``offsets`` are where the documents begin in ``ids``, with the end. Rounds go
    on until no pair occurs ``least`` times, or to ``rounds``.

    A pair gets no new occurrences after the round that made the newer of its
    symbols, so one that was counted and is rare stays rare: a round looks only
    at the places of pairs that were frequent or waited, and of new pairs.
    Symbols keep their places and are linked to their neighbours.
    """
    n = len(ids)
    symbols = np.append(ids.astype(np.uint32), np.uint32(0))  # place n is no symbol
    offsets = np.asarray(offsets, np.int64)
    after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
    before[0] = n
    last = np.zeros(n + 1, bool)  # of its document, or gone
    last[offsets[offsets > 0] - 1] = last[n] = True
    gone, near = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    weight = np.zeros(n + 1, np.int32)  # count of the pair at a place
    rules: list[np.ndarray] = []
    base = terminals
    live = np.flatnonzero(~last)
    for round_ in itertools.count() if rounds is None else range(rounds):
        if not len(live):
            break
        wide = np.uint32 if base <= 1 << 16 else np.uint64
        codes = symbols.take(live) * wide(base) + symbols.take(after.take(live))
        found, bins, of_bin, counts, waiting = _frequent(codes, least)
        if not len(found):
            # codes may be too wide for keys with their places
            found, bins, of_bin, counts, waiting = _frequent_exactly(codes, least)
        if not len(found):
            break
        at = live.take(found)
        near[live[waiting]] = near[at] = True
        own = counts.astype(np.int32).take(bins)
        weight[at] = own
        best = np.flatnonzero((own >= weight.take(before.take(at))) & (own >= weight.take(after.take(at))))
        weight[at] = 0
        at, bins = at.take(best), bins.take(best)
        # equal neighbours remain in runs of consecutive places: take every second
        starts = np.flatnonzero(np.concatenate([[True], before[at[1:]] != at[:-1]]))
        if len(starts) < len(at):
            place = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
            even = np.flatnonzero(place & 1 == 0)
            at, bins = at.take(even), bins.take(even)
        # overlaps have taken some occurrences; what is left must still pay for its rule
        left = np.bincount(bins, minlength=len(counts)) >= max(1, least // 2)
        stays = left[bins]
        if not stays.any():
            # all lost to overlaps: the most frequent pair goes alone
            left = np.zeros(len(counts), bool)
            left[bins[counts[bins].argmax()]] = True
            stays = left[bins]
        at, bins = at[stays], bins[stays]
        used = np.flatnonzero(left)
        number = np.empty(len(counts), np.uint32)
        number[used] = np.arange(len(used))
        pairs = of_bin[used].astype(np.int64)
        rules.append(np.stack([pairs // base, pairs % base], axis=1))
        taken = after.take(at)
        symbols[at] = number[bins] + np.uint32(base)
        last[at] = last.take(taken)
        gone[taken] = last[taken] = True
        after[at] = following = after.take(taken)
        before[following] = at
        base += len(used)
        near[before.take(at)] = True
        near &= ~last
        live = np.flatnonzero(near)
        near[live] = False
    stay = ~gone[:n]
    first = np.concatenate([[0], np.cumsum(stay)])[offsets]
    return symbols[:n][stay], first, rules


def expansions(terminals: int, rules: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Expansions of the rules in a row, and where each begins (with the end)."""
    flat, bounds = np.empty(0, np.int64), np.zeros(1, np.int64)
    for pairs in rules:
        parts = expand(pairs.reshape(-1), terminals, flat, bounds)
        lengths = parts[1].reshape(-1, 2).sum(axis=1)
        bounds = np.concatenate([bounds, bounds[-1] + np.cumsum(lengths)])
        flat = np.concatenate([flat, parts[0]])
    return flat, bounds


def expand(symbols: np.ndarray, terminals: int, flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a run of symbols, and how many each symbol gives."""
    symbols = symbols.astype(np.int64)
    rule = symbols - terminals
    is_rule = rule >= 0
    table = np.concatenate([flat, symbols[~is_rule]])
    start = np.empty(len(symbols), np.int64)
    lengths = np.ones(len(symbols), np.int64)
    start[is_rule] = bounds[rule[is_rule]]
    lengths[is_rule] = bounds[rule[is_rule] + 1] - bounds[rule[is_rule]]
    start[~is_rule] = len(flat) + np.arange(int((~is_rule).sum()))
    ends = np.cumsum(lengths)
    ids = table[np.repeat(start - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)]
    return ids, lengths


def to_bytes(ids: np.ndarray, offsets: np.ndarray, rounds: int | None = None, least: int = LEAST) -> bytes:
    """A shard of the documents ``ids[offsets[i]:offsets[i + 1]]``."""
    there = np.bincount(ids) > 0 if len(ids) else np.empty(0, bool)
    used = np.flatnonzero(there)
    terminals = len(used)
    symbols, first, rules = compress((np.cumsum(there) - 1)[ids], offsets, terminals, rounds, least)
    _, bounds = expansions(terminals, rules)
    width = 2 if terminals + sum(map(len, rules)) <= 1 << 16 else 4
    pairs = np.concatenate(rules) if rules else np.empty((0, 2), np.int64)
    return b"".join(
        [
            b"RPG1",
            struct.pack("<4I", len(offsets) - 1, len(symbols), terminals, len(rules)),
            np.array([len(r) for r in rules], "<u4").tobytes(),
            used.astype("<u4").tobytes(),
            pairs.astype("<u4").tobytes(),
            np.diff(bounds).astype("<u4").tobytes(),
            first[:-1].astype("<u4").tobytes(),
            np.diff(offsets).astype("<u8").tobytes(),
            struct.pack("<I", width),
            symbols.astype(f"<u{width}").tobytes(),
        ]
    )


class Shard:
    """Reader of a shard's bytes."""

    def __init__(self, data: bytes):
        if data[:4] != b"RPG1":
            raise ValueError("not a shard of grammar-compressed ids")
        self.documents, count, self.terminals, rounds = struct.unpack_from("<4I", data, 4)
        at = 20

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        sizes = take("<u4", rounds)
        self.ids = take("<u4", self.terminals)
        pairs = take("<u4", 2 * int(sizes.sum())).reshape(-1, 2).astype(np.int64)
        self.lengths = take("<u4", len(pairs))
        self.first = np.append(take("<u4", self.documents).astype(np.int64), count)
        self.n_tokens = take("<u8", self.documents).astype(np.int64)
        width = int(take("<u4", 1)[0])
        self.symbols = take(f"<u{width}", count)
        cuts = np.cumsum(sizes)[:-1] if rounds else []
        self.flat, self.bounds = expansions(self.terminals, np.split(pairs, cuts) if rounds else [])
        if not np.array_equal(np.diff(self.bounds), self.lengths):
            raise ValueError("the rules do not give the stored lengths")
        # one list of ids per symbol
        bounds = np.concatenate([np.arange(self.terminals), self.terminals + self.bounds])
        self.lists = pa.LargeListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate([self.ids, self.ids[self.flat]])))

    def documents_at(self, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a run of documents, and where each begins (with the end)."""
        symbols = self.symbols[self.first[begin] : self.first[end]].astype(np.uint32)
        ids = self.lists.take(pa.array(symbols)).flatten().to_numpy()
        offsets = np.concatenate([[0], np.cumsum(self.n_tokens[begin:end])])
        if len(ids) != offsets[-1]:
            raise ValueError("the symbols do not give the stored number of ids")
        return ids, offsets

    def document(self, i: int) -> np.ndarray:
        """Ids of one document, from its own symbols only."""
        return self.documents_at(i, i + 1)[0]


def write(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    end_id: int,
    shard_tokens: int = SHARD_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode all documents in ascending id order and write their shards to ``folder``.

    Table columns: part (a range of ids), shard (its number in the part), begin (ids before it in the part),
    doc_ids, shard_bytes.
    """
    kind = docs.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("shard", T.IntegerType()),
            T.StructField("begin", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("doc_ids", T.ArrayType(kind)),
            T.StructField("shard_bytes", T.BinaryType()),
        ]
    )

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = library_encoder(vocabulary, keep=True)
        part, number, begin = TaskContext.get().partitionId(), 0, 0
        ids: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        names: list[pa.Array] = []
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal ids, counts, names, held, number, begin
            offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
            data = to_bytes(np.concatenate(ids), offsets)
            keys = pa.concat_arrays(names)
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([number], pa.int32()),
                    pa.array([begin], pa.int64()),
                    pa.array([held], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                    pa.array([data], pa.binary()),
                ],
                names=schema.names,
            )
            number, begin = number + 1, begin + held
            ids, counts, names, held = [], [], [], 0
            return out

        hold()
        for batch in batches:
            for rows in in_groups(batch, "text"):
                found, offsets = encode(rows.column("text"))
                found = np.insert(found, offsets[1:], end_id)
                ids.append(found)
                counts.append(np.diff(offsets) + 1)
                names.append(rows.column("doc_id"))
                held += len(found)
                if held >= shard_tokens:
                    yield close()
        if names:
            yield close()
        give_back()

    rows = docs.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    rows.mapInArrow(shards, schema).write.parquet(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, in any order: doc_id, start (ids of all documents before it), n_tokens, ids.

    ``ids`` are little-endian unsigned 32-bit integers.
    """
    table = spark.read.parquet(folder)
    kind = table.schema["doc_ids"].dataType.elementType
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("doc_id", kind),
            T.StructField("local_start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold()
        for batch in batches:
            for k in range(batch.num_rows):
                shard = Shard(batch.column("shard_bytes")[k].as_py())
                keys = batch.column("doc_ids")[k].values
                ids, offsets = shard.documents_at(0, shard.documents)
                starts = batch.column("begin")[k].as_py() + np.cumsum(shard.n_tokens) - shard.n_tokens
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(shard.documents, batch.column("part")[k].as_py(), np.int32)),
                        keys,
                        pa.array(starts),
                        pa.array(shard.n_tokens),
                        ids_column(ids, offsets).cast(pa.binary()),
                    ],
                    names=schema.names,
                )
        give_back()

    found = table.select("part", "begin", "doc_ids", "shard_bytes").mapInArrow(documents, schema)
    # one row per part, not per document
    parts = table.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    parts = checkpoint(parts)
    if parts.count() <= BROADCAST_PARTS:
        parts = F.broadcast(parts)
    return found.join(parts, "part").select(
        "doc_id", (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "ids"
    )

"""Near duplicates by an LSH forest over word shingles.

One pass over the texts gives each document's set of shingles, a digest of the
set, and ``TREES`` x ``DEPTH`` minhash values. Documents with equal sets are one
class and go on as their smallest id. A tree is the classes in the order of
their ``DEPTH`` values; neighbours in that order have the longest common
prefixes. Within a run that shares the first ``LEAST`` values, a class is
compared with its nearest neighbours on either side: where few classes share
that prefix these are all of them, and in a dense region they are those that
agree deeper, so the depth adapts to the region. Rows in one batch of a run
longer than that reach are also compared with the batch's pivots, the classes
closest to its most common values.

A comparison counts equal minhash values and sizes; what may reach the wanted
similarity (4.5 standard deviations of slack) is a candidate. Only the closest
candidates of a class and tree are confirmed, first the very closest of a few trees,
then those of all trees that would join two components, since links in a dense group
mostly connect what is connected already; of its links a task gives a spanning forest. Runs that were not compared whole or
not confirmed whole (longer than the reach, cut by a partition's end, or with
candidates beyond the closest) are met again: first every class of a long run
with the run's hubs, the classes with most links so far, which joins stars of
copies; then, in every run that still has several components, the classes outside the largest
component with those of other components, first by minhash values and
then, where they may reach the similarity, by the full sets in the same cell. The classes of runs that need more than ``CROWD`` comparisons
are grouped for that by their rarest shingles instead: two sets that reach the similarity share one of the rarest
(100 - similarity) % of either. So each pair of a
run ends in one component or is compared or cannot link, whatever the length of the run and
wherever batches end; of a crowd of pages that share a template but do not link only those that share a rare
shingle are compared. Full sets travel only for the classes that have
candidates or are left in such runs. Components of the confirmed links are found
by repeated minimum labels with shortcuts.

No step holds a group of copies in one task: equal sets are combined before the
shuffle, sorted runs are cut wherever a partition or batch ends, and groups met
again are dealt into cells of bounded number and bytes by a hash. The last comparison grows with the product of the
number of classes of a run, up to ``CROWD``, or of those that share a rare shingle, and those of them outside the largest component. A pair at the threshold agrees on the first ``LEAST``
values of at least one tree with probability 1 - (1 - 0.85^3)^12 = 0.99999;
measured recall is in the README.

Defined cases: null and empty texts, and texts without words, have empty sets and
are linked with nothing; repeated rows are members of one class; rows that share an id are one document
(their links add up); a null id is linked only with rows of an equal set; an
empty table gives no rows; other columns of the input are not read. Ids are whole
numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldspark.llm.shared import checkpoint, give_back, in_groups, rows_of, whole

TREES, DEPTH, LEAST = 12, 10, 3
VALUES = TREES * DEPTH
EXTRA = 240  # further values, compared in the second round only
REACH = 64  # neighbours compared on either side
PIVOTS = 4  # per batch and run longer than the reach
HUBS = 16  # per run longer than the reach, over all its classes
CELL = 1000  # classes of a run met again that go to one task together, and bytes of their sets
CELL_BYTES = 16 << 20
ROWS = 5000  # documents a partition of the frames of classes, pairs and links, whose rows are short
SET_BYTES = 16 << 20  # a partition of the frames of sets
CROWD = 50_000_000  # comparisons of a run beyond which its classes are grouped by rare shingles first
FIRST_TREES = 4  # trees whose closest candidates are confirmed, and whose crowded runs are met, before the others
SURE = 0.93  # share of equal values from which a candidate is surely a link
#: candidates confirmed per class and tree in the first round, the closest first: sure ones, doubtful ones
KEPT = (1, 4)
SLACK = 4.5  # standard deviations

_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_NONE = np.uint64(0x5851F42D4C957F2D)  # stands for a missing word
_rng = np.random.default_rng(7)
_MULTIPLY = (_rng.integers(0, 2**32, VALUES + EXTRA, np.uint64) | 1).astype(np.uint32)
_FLIP = _rng.integers(0, 2**32, VALUES + EXTRA, np.uint64).astype(np.uint32)


def _mixed(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    x = a * _K[0]
    x ^= x >> np.uint64(29)
    x += b
    x *= _K[1]
    x ^= x >> np.uint64(32)
    x += c
    x *= _K[2]
    return x ^ (x >> np.uint64(29))


def shingle_sets(texts: pa.Array, words: int = 3) -> list[np.ndarray]:
    """Per text the sorted distinct 64-bit values of its shingles of ``words`` words (3 or more)."""
    texts = pc.ascii_lower(pc.fill_null(texts, "")).cast(pa.large_string())
    lists = pc.split_pattern(pc.replace_substring_regex(texts, r"[\x09-\x0D]", " "), " ")
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    doc = np.repeat(np.arange(len(counts)), counts)
    coded = lists.flatten().dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False)
    table = np.array(coded.dictionary.to_pylist(), dtype=object)
    real = np.fromiter((w != "" for w in table), bool, len(table))
    hashed = pd.util.hash_array(table, categorize=False) if len(table) else np.empty(0, np.uint64)
    there = real[index] if len(index) else np.empty(0, bool)
    values, doc = hashed[index[there]], doc[there]
    bounds = np.searchsorted(doc, np.arange(len(counts) + 1))
    n = np.diff(bounds)
    padded = np.concatenate([values, np.full(words, _NONE)])
    size = len(values)
    shingles = padded[:size]
    for k in range(1, words, 2):
        second = padded[k : k + size]
        third = padded[k + 1 : k + 1 + size] if k + 1 < words else np.full(size, _NONE)
        shingles = _mixed(shingles, second, third)
    sets = []
    for begin, count in zip(bounds[:-1], n):
        if count >= words:
            sets.append(np.unique(shingles[begin : begin + count - words + 1]))
        elif count:  # the whole sequence as one
            x = values[begin : begin + 1]
            for k in range(1, count):
                x = _mixed(x, values[begin + k : begin + k + 1], np.array([_NONE]))
            sets.append(_mixed(x, np.array([_NONE]), np.array([np.uint64(count)])))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def _minima(sets: list[np.ndarray]) -> np.ndarray:
    """Low 16 bits of the minhash values, one row per set (zero for empty sets)."""
    out = np.zeros((len(sets), VALUES + EXTRA), np.uint16)
    full = [i for i, s in enumerate(sets) if len(s)]
    if not full:
        return out
    flat = np.concatenate([(sets[i] >> np.uint64(32)).astype(np.uint32) for i in full])
    starts = np.concatenate([[0], np.cumsum([len(sets[i]) for i in full])])[:-1]
    for k in range(VALUES + EXTRA):
        out[full, k] = np.minimum.reduceat((flat ^ _FLIP[k]) * _MULTIPLY[k], starts) & np.uint32(0xFFFF)
    return out


class Parts(NamedTuple):
    """Partitions of the frames between two searches: as many as there are cores, more where the rows ask for it.

    Without it each of their many joins leaves as many as the session shuffles into, however few rows they
    have, and a task on a handful of rows costs as much as its start and its file.
    """

    rows: int
    sets: int

    @classmethod
    def of(cls, signed: DataFrame) -> Parts:
        total = signed.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n_shingles"), F.lit(0)).alias("shingles")).first()
        rows = max(signed.sparkSession.sparkContext.defaultParallelism, -(-total["n"] // ROWS))
        return cls(rows, max(rows, -(-8 * total["shingles"] // SET_BYTES)))


def _fixed(data: np.ndarray) -> pa.Array:
    n, width = data.shape
    flat = pa.py_buffer(np.ascontiguousarray(data))
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(0, n * width + 1, width, np.int32)), flat])


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int, minima: bool) -> DataFrame:
    """doc_id, row_digest (of the text), n_shingles, set_digest, and with ``minima`` order (values by tree, big-endian) and
    low (low bytes of all values).
    """
    names = ["doc_id", "row_digest", "n_shingles", "set_digest", *(["order", "low"] if minima else [])]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in in_groups(batch, "text"):
                sets = shingle_sets(rows.column("text"), words)
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                columns = [
                    rows.column("doc_id"),
                    rows.column("row_digest"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digests, pa.binary()),
                ]
                if minima:
                    values = _minima(sets)
                    columns.append(_fixed(values[:, :VALUES].astype(">u2").view(np.uint8)))
                    columns.append(_fixed((values & np.uint16(0xFF)).astype(np.uint8)))
                yield pa.RecordBatch.from_arrays(columns, names=names)
        give_back()

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.sha2(whole(text_col), 256).alias("row_digest"), whole(text_col).alias("text")
    )
    kinds = "doc_id long, row_digest string, n_shingles long, set_digest binary"
    return rows.mapInArrow(sign, kinds + (", order binary, low binary" if minima else ""))


def _closest(a: np.ndarray, b: np.ndarray, equal: np.ndarray, sure: int) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs are among the closest of either end, and which are the very closest; sure and doubtful pairs are counted apart."""
    keep, closest = np.zeros((2, len(a)), bool)
    is_sure = equal >= sure
    most = np.where(is_sure, *KEPT)
    for end in (a, b):
        order = np.lexsort((-equal, is_sure, end))
        group = end[order] * 2 + is_sure[order]
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        rank = np.arange(len(order)) - np.repeat(first, np.diff(np.concatenate([first, [len(order)]])))
        keep[order] |= rank < most[order]
        closest[order] |= rank == 0
    return keep, closest


def _least(values: int, percent: int) -> int:
    """Equal values out of ``values`` that a pair at the threshold has, less the slack."""
    share = percent / 100
    return int(np.floor(values * (share - SLACK * np.sqrt(share * (1 - share) / values))))


def _run(tree: Column) -> Column:
    return F.substring("order", tree * F.lit(2 * DEPTH) + F.lit(1), F.lit(2 * LEAST))


def candidates(classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes, a < b, that may have ``percent`` % similarity, the closest of each class, once per tree.

    Their ``tree`` tells the round that confirms them, -2 or -1: the very closest of the first ``FIRST_TREES`` trees come first.
    A row (a, a) names a class and tree whose run is not given whole: it is longer than the reach, may go on
    in another partition, or has candidates beyond the closest.
    """
    values = VALUES
    least = _least(values, percent)
    share = percent / 100
    sure = int(np.ceil(values * max(SURE, (1 + share) / 2)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def in_batch(tree, key, low, node, size, fresh, first):
            # rows before ``fresh`` were searched among themselves already
            run = np.concatenate([tree[:, None].astype(np.uint8), key[:, : 2 * LEAST]], axis=1)
            found: list[tuple[np.ndarray, ...]] = []

            def compare(i: np.ndarray, j: np.ndarray) -> None:
                small, large = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
                fit = (100 * small >= percent * large) & (node[i] != node[j])
                i, j = i[fit], j[fit]
                equal = (low[i] == low[j]).sum(axis=1)
                near = equal >= least
                found.append((i[near], j[near], equal[near]))

            new_run = np.concatenate([[True], (run[1:] != run[:-1]).any(axis=1)])
            number = np.cumsum(new_run)
            for step in range(1, min(REACH, len(node) - 1) + 1):
                i = np.arange(max(fresh, step), len(node))
                i = i[number[i] == number[i - step]]
                if not len(i):
                    break
                compare(i, i - step)
            again = np.zeros(len(node) + 1, bool)  # by number of the run
            again[1] = first
            begins = np.flatnonzero(new_run)
            for begin, end in zip(begins, np.append(begins[1:], len(node))):
                if end - begin > REACH:
                    again[number[begin]] = True
                    part = low[begin:end]
                    common = np.array([np.bincount(part[:, k], minlength=256).argmax() for k in range(values)], np.uint8)
                    likeness = (part == common).sum(axis=1)
                    for pivot in begin + np.argsort(-likeness, kind="stable")[:PIVOTS]:
                        others = np.arange(begin, end)
                        compare(others, np.full(len(others), pivot))
            i, j, equal = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 3
            a, b = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
            # classes of rows that share an id are one node, which may have several places
            place = number[i]
            order = np.lexsort((-equal, b, a, tree[i]))
            a, b, equal, place = a[order], b[order], equal[order], place[order]
            once = np.ones(len(a), bool)
            once[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (tree[i][order][1:] != tree[i][order][:-1])
            keep, early = once.copy(), np.zeros(len(a), bool)
            if once.any():
                keep[once], early[once] = _closest(a[once], b[once], equal[once], sure)
            early &= tree[i][order] < FIRST_TREES
            again[place[once & ~keep]] = True
            marked = begins[again[number[begins]]]
            a, b = np.concatenate([a[keep], node[marked]]), np.concatenate([b[keep], node[marked]])
            trees = np.concatenate([np.where(early[keep], -2, -1), tree[marked]])
            return given(a, b, trees)

        def given(a, b, trees):
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(trees, pa.int32())], names=["a", "b", "tree"]
            )

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [
                batch.column("tree").to_numpy(zero_copy_only=False),
                np.frombuffer(b"".join(batch.column("key").to_pylist()), np.uint8).reshape(-1, 2 * DEPTH),
                np.frombuffer(b"".join(batch.column("low").to_pylist()), np.uint8).reshape(-1, values),
                batch.column("node").to_numpy(zero_copy_only=False),
                batch.column("n_shingles").to_numpy(zero_copy_only=False),
            ]
            fresh = 0
            if held is not None:
                fresh = len(held[0])
                now = [np.concatenate([x, y]) for x, y in zip(held, now)]
            yield in_batch(*now, fresh, held is None)
            held = [x[-REACH:] for x in now]
        if held is not None:
            yield given(held[3][-1:], held[3][-1:], held[0][-1:])
        give_back()

    rows = classes.select(
        F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"), "order", F.substring("low", 1, values).alias("low"), "node", "n_shingles"
    ).select(
        "tree", F.substring("order", F.col("tree") * F.lit(2 * DEPTH) + F.lit(1), F.lit(2 * DEPTH)).alias("key"), "low", "node", "n_shingles"
    )
    ordered = rows.repartitionByRange("tree", "key", "node").sortWithinPartitions("tree", "key", "node")
    return ordered.mapInArrow(search, "a long, b long, tree int")


def run_members(classes: DataFrame, marks: DataFrame, parts: Parts) -> DataFrame:
    """tree, run, node, set_digest, n_shingles of all classes of the runs that ``marks`` (a, tree) names."""
    runs = marks.select(F.col("a").alias("node"), "tree").join(classes.select("node", "order"), "node")
    runs = runs.select("tree", _run(F.col("tree")).alias("run")).coalesce(parts.rows).distinct()
    own = ["node", "set_digest", "n_shingles"]
    rows = classes.select(F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"), "order", *own)
    rows = rows.select("tree", _run(F.col("tree")).alias("run"), *own)
    return checkpoint(rows.join(runs, ["tree", "run"], "left_semi").coalesce(parts.rows))


def open_runs(members: DataFrame, found: DataFrame, parts: Parts) -> tuple[DataFrame, DataFrame]:
    """The members with their component as ``label``, and per run of several components: tree, run, size, bytes, most (n, bytes, label of the largest)."""
    labelled = members.join(found, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
    labelled = labelled.coalesce(parts.rows)
    by_label = labelled.groupBy("tree", "run", "label").agg(F.count(F.lit(1)).alias("n"), (F.sum("n_shingles") * 8).alias("bytes"))
    runs = by_label.groupBy("tree", "run").agg(
        F.sum("n").alias("size"), F.sum("bytes").alias("bytes"), F.max(F.struct("n", "bytes", "label")).alias("most")
    )
    return labelled.drop("n_shingles"), checkpoint(runs.filter(F.col("most.n") < F.col("size")).coalesce(parts.rows))


def prefix_members(sets: DataFrame, percent: int) -> DataFrame:
    """The classes of ``sets`` grouped by rare shingles: tree (-1), run (a shingle), node, set_digest, n_shingles.

    In the order of their frequency, two sets that reach the similarity share one of the first (100 - ``percent``) % of
    either, and one more. So only classes that share one of those are met, and no pair is lost.
    """

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in in_groups(batch, "values"):
                sizes = pc.binary_length(rows.column("values")).to_numpy(zero_copy_only=False) // 8
                at = pa.array(np.repeat(np.arange(len(sizes)), sizes))
                flat = np.frombuffer(b"".join(rows.column("values").to_pylist()), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("node").take(at), rows.column("set_digest").take(at), pa.array(flat)], names=["node", "set_digest", "shingle"]
                )
        give_back()

    rows = sets.select("node", "set_digest", "values").mapInArrow(single, "node long, set_digest binary, shingle long")
    often = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("often"))
    own = rows.join(often, "shingle").groupBy("node", "set_digest").agg(F.sort_array(F.collect_list(F.struct("often", "shingle"))).alias("by"))
    n = F.size("by")
    least = F.ceil(n * percent / F.lit(100)).cast("int")
    first = own.select("node", "set_digest", n.cast("long").alias("n_shingles"), F.explode(F.slice("by", F.lit(1), n - least + 1)).alias("s"))
    run = F.unhex(F.lpad(F.hex("s.shingle"), 16, "0"))
    return first.filter("s.often > 1").select(F.lit(-1).alias("tree"), run.alias("run"), "node", "set_digest", "n_shingles")


def met_again(
    members: DataFrame,
    classes: DataFrame,
    found: DataFrame,
    percent: int,
    sets: DataFrame,
    more_sets: Callable[[DataFrame], DataFrame],
    parts: Parts,
    links: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) that join different components within the runs of ``members``, and ``sets`` with those made by ``more_sets``.

    Links that join nothing more in their cell are left out. With ``links``, each
    long run's classes with most of them are compared with all classes of the run; without, all classes outside the run's largest component are.
    """
    values = VALUES + EXTRA
    least = _least(values, percent)
    labelled, runs = open_runs(members, found, parts)
    if links is not None:
        runs = runs.filter(F.col("size") > REACH + 1)
    nothing = members.sparkSession.createDataFrame([], "a long, b long")
    if runs.isEmpty():
        return nothing, sets

    def dealt(n: Column, size: Column) -> Column:
        return F.greatest(F.ceil(n / CELL), F.ceil(size / CELL_BYTES), F.lit(1)).cast("int")

    cells = dealt(F.col("size"), F.col("bytes"))
    shares = F.lit(1) if links is not None else dealt(F.col("size") - F.col("most.n"), F.col("bytes") - F.col("most.bytes"))
    runs = runs.select("tree", "run", cells.alias("cells"), shares.alias("shares"), F.col("most.label").alias("largest"))
    rows = labelled.join(runs, ["tree", "run"]).coalesce(parts.rows)
    if links is not None:
        ends = [links.groupBy(F.col(end).alias("node")).agg(F.count(F.lit(1)).alias("degree")) for end in ("a", "b")]
        degrees = ends[0].unionByName(ends[1]).groupBy("node").agg(F.sum("degree").alias("degree"))
        first = Window.partitionBy("tree", "run").orderBy(F.desc("degree"), "node", "set_digest")
        ranked = rows.join(degrees, "node").withColumn("rank", F.row_number().over(first))
        chosen = ranked.filter(F.col("rank") <= HUBS).drop("rank", "degree").coalesce(parts.rows)
    else:
        chosen = rows.filter("label != largest")
    spread = F.xxhash64("set_digest", F.lit(7))
    names = ["tree", "run", "node", "set_digest", "label"]
    here = rows.select(
        *names, F.lit(False).alias("chosen"), F.pmod(spread, "cells").cast("int").alias("i"), F.explode(F.expr("sequence(0, shares - 1)")).alias("j")
    )
    there = chosen.select(
        *names, F.lit(True).alias("chosen"), F.explode(F.expr("sequence(0, cells - 1)")).alias("i"), F.pmod(spread, "shares").cast("int").alias("j")
    )
    signs = classes.select("node", "set_digest", "n_shingles", "low")
    rows = here.unionByName(there).join(signs, ["node", "set_digest"]).coalesce(parts.rows)

    kinds = "tree int, run binary, i int, j int, chosen boolean, node long, set_digest binary, label long"

    def fitting(table: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per chosen row of a cell, the other rows that are candidates with it, and their equal values."""
        side = table.column("chosen").to_numpy().astype(bool)
        node, size, label = (table.column(c).to_numpy() for c in ("node", "n_shingles", "label"))
        low = np.frombuffer(b"".join(table.column("low").to_pylist()), np.uint8).reshape(-1, values)
        at = np.flatnonzero(~side)
        at = at[np.argsort(size[at], kind="stable")]
        sizes = size[at]
        for c in np.flatnonzero(side):
            # the sizes that fit lie side by side
            begin = np.searchsorted(sizes, -(-percent * size[c] // 100))
            end = np.searchsorted(sizes, 100 * size[c] // percent, "right")
            others = at[begin:end]
            others = others[(label[others] != label[c]) & (node[others] != node[c])]
            equal = np.count_nonzero(low[others] == low[c], axis=1)
            near = equal >= least
            if near.any():
                yield c, others[near], equal[near]

    def with_candidates(table: pa.Table) -> pa.Table:
        has = np.zeros(table.num_rows, bool)
        for c, others, _ in fitting(table):
            has[c] = True
            has[others] = True
        return table.select([k.split()[0] for k in kinds.split(", ")]).filter(pa.array(has))

    def joining(table: pa.Table) -> pa.Table:
        node, label = table.column("node").to_numpy(), table.column("label").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in table.column("values").to_pylist()]
        root = np.unique(label, return_inverse=True)[1].copy()  # component of each row within the cell
        links = []
        for c, others, equal in fitting(table):
            for o in others[np.argsort(-equal, kind="stable")]:
                if root[o] == root[c]:
                    continue
                x, y = sets[c], sets[o]
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    links.append((min(node[c], node[o]), max(node[c], node[o])))
                    root[root == root[o]] = root[c]
        pairs = np.array(links, np.int64).reshape(-1, 2)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    cell = ["tree", "run", "i", "j"]
    near = checkpoint(rows.groupBy(*cell).applyInArrow(with_candidates, kinds)).coalesce(parts.rows)
    # the sets of classes that had no candidate before are made now
    new = near.select(F.col("node").alias("a")).distinct().join(sets.select(F.col("node").alias("a")), "a", "left_anti")
    new = checkpoint(new.withColumn("b", F.col("a")).coalesce(parts.rows))
    if not new.isEmpty():
        sets = sets.unionByName(more_sets(new))
    whole_rows = near.join(signs, ["node", "set_digest"]).join(sets, ["node", "set_digest"]).coalesce(parts.sets)
    more = whole_rows.groupBy(*cell).applyInArrow(joining, "a long, b long").distinct()
    return checkpoint(more.coalesce(parts.rows)), sets


def full_sets(docs: DataFrame, pairs: DataFrame, classes: DataFrame, id_col: str, text_col: str, words: int, parts: Parts) -> DataFrame:
    """node, set_digest, values (the set) of every class in ``pairs``, written once."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = wanted.join(classes.select("node", "set_digest"), "node").coalesce(parts.rows)
    texts = docs.select(F.col(id_col).cast("long").alias("node"), whole(text_col).alias("text"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in in_groups(batch, "text"):
                sets = [s.tobytes() for s in shingle_sets(rows.column("text"), words)]
                digests = [hashlib.blake2b(s, digest_size=16).digest() for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("node"), pa.array(digests, pa.binary()), pa.array(sets, pa.binary())],
                    names=["node", "set_digest", "values"],
                )
        give_back()

    sets = texts.join(wanted.select("node").distinct(), "node", "left_semi").mapInArrow(
        make, "node long, set_digest binary, values binary"
    )
    sets = sets.join(wanted, ["node", "set_digest"], "left_semi").dropDuplicates(["node", "set_digest"])
    return checkpoint(sets.coalesce(parts.sets))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs whose full sets have ``percent`` % similarity or more, those that join something more in their task."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = parent[up]
                x = up
            return x

        for batch in batches:
            keep = []
            for a, b, x, y in zip(*(batch.column(c) for c in ("a", "b", "x", "y"))):
                a, b = root(a.as_py()), root(b.as_py())
                keep.append(False)
                if a == b:
                    continue
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    keep[-1] = True
                    parent[max(a, b)] = min(a, b)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        give_back()

    first = sets.select(F.col("node").alias("a"), F.col("values").alias("x"))
    second = sets.select(F.col("node").alias("b"), F.col("values").alias("y"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "x", "y").mapInArrow(linked, "a long, b long")


def between(pairs: DataFrame, found: DataFrame | None, parts: Parts) -> DataFrame:
    """The pairs whose ends are in different components."""
    if found is None:
        return pairs
    for end in ("a", "b"):
        own = found.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}"))
        pairs = pairs.join(own, end, "left").coalesce(parts.rows)
    return pairs.filter(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")


def components(links: DataFrame, parts: Parts) -> DataFrame:
    """Per node of ``links`` (a, b): component, the smallest node it is connected with."""
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = checkpoint(links.select(F.inline(ways)).distinct().coalesce(parts.rows))
    labels = edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label"))
    labels = checkpoint(labels.coalesce(parts.rows))
    while True:
        # the smallest label among a node and its neighbours, then the label of that label
        heard = edges.join(labels, edges["b"] == labels["node"]).select(F.col("a").alias("node"), "label").coalesce(parts.rows)
        heard = heard.groupBy("node").agg(F.min("label").alias("near"))
        better = labels.join(heard, "node").select("node", "label", F.least("label", "near").alias("new"))
        roots = better.select(F.col("node").alias("new"), F.col("new").alias("root"))
        step = better.coalesce(parts.rows).join(roots, "new", "left").select(
            "node", "label", F.least("new", F.coalesce("root", "new")).alias("new")
        )
        step = checkpoint(step.coalesce(parts.rows))
        if step.filter("new < label").isEmpty():
            return labels.withColumnRenamed("label", "component")
        labels = step.select("node", F.col("new").alias("label"))


def joined(found: DataFrame | None, links: DataFrame, parts: Parts) -> DataFrame:
    """Components once ``links`` are added to those ``found``, of which a star per component is enough."""
    if found is None:
        return components(links, parts)
    stars = found.filter("node != component").select(F.col("component").alias("a"), F.col("node").alias("b"))
    return components(stars.unionByName(links), parts)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept (the row's id is the component's), row_digest.

    Two texts are linked if their sets of ``words``-word shingles have at least
    ``percent`` % of their union in common.
    """
    # minhash values are made and kept once a class; the rows' digests take a pass of their own, which is cheaper than keeping both
    signed = checkpoint(signatures(docs, id_col, text_col, words, minima=False))
    classes = checkpoint(
        signatures(docs, id_col, text_col, words, minima=True)
        .filter("n_shingles > 0")
        .groupBy("set_digest")
        .agg(F.min("doc_id").alias("node"), F.max("n_shingles").alias("n_shingles"), F.max("order").alias("order"), F.max("low").alias("low"))
    )
    parts = Parts.of(signed)
    signed, classes = signed.coalesce(parts.rows), classes.coalesce(parts.rows)
    named = classes.filter("node is not null")
    near = checkpoint(candidates(named, percent).distinct().coalesce(parts.rows))
    turns = near.filter("a < b").groupBy("a", "b").agg(F.min("tree").alias("turn"))
    pairs = checkpoint(turns.coalesce(parts.rows))
    sets = full_sets(docs, pairs, named, id_col, text_col, words, parts)
    links = found = None
    for turn in (-2, -1):
        # in a dense group the first links connect most classes; later ones matter only between components
        some = between(pairs.filter(F.col("turn") == turn).select("a", "b"), found, parts)
        more = checkpoint(confirmed(some, sets, percent)).coalesce(parts.rows)
        links = more if links is None else links.unionByName(more)
        if found is None or not more.isEmpty():
            found = joined(found, more, parts)
    # what these rounds left of a run matters only if it joins two components
    marks = near.filter("a = b").select("a", "tree")
    if not marks.isEmpty():
        members = run_members(named, marks, parts)

        def more_sets(wanted: DataFrame) -> DataFrame:
            return full_sets(docs, wanted, named, id_col, text_col, words, parts)

        for trees in (F.col("tree") < FIRST_TREES, F.col("tree") >= FIRST_TREES):
            more, sets = met_again(members.filter(trees), named, found, percent, sets, more_sets, parts, links)
            if not more.isEmpty():
                found = joined(found, more, parts)
        # runs that still have several components: all outside the largest one with the others, in a crowd by rare shingles
        comparisons = F.col("size") * (F.col("size") - F.col("most.n"))
        crowds = checkpoint(open_runs(members, found, parts)[1].filter(comparisons > CROWD).select("tree", "run"))
        crowded = not crowds.isEmpty()
        rest = members.join(crowds, ["tree", "run"], "left_anti") if crowded else members
        for trees in (F.col("tree") < FIRST_TREES, F.col("tree") >= FIRST_TREES):
            more, sets = met_again(rest.filter(trees), named, found, percent, sets, more_sets, parts)
            if not more.isEmpty():
                found = joined(found, more, parts)
        if crowded:
            left = members.join(crowds, ["tree", "run"], "left_semi").select("node").distinct()
            left = checkpoint(left.coalesce(parts.rows))
            new = left.join(sets.select("node"), "node", "left_anti").select(F.col("node").alias("a"), F.col("node").alias("b"))
            new = checkpoint(new.coalesce(parts.rows))
            if not new.isEmpty():
                sets = sets.unionByName(more_sets(new))
            rare = checkpoint(prefix_members(sets.join(left, "node", "left_semi"), percent))
            more, sets = met_again(rare, named, found, percent, sets, more_sets, parts)
            if not more.isEmpty():
                found = joined(found, more, parts)
    classes = classes.join(found, "node", "left").select("set_digest", F.coalesce("component", "node").alias("component"))
    classes = classes.coalesce(parts.rows)
    rows = signed.select("doc_id", "row_digest", "n_shingles", "set_digest").join(classes, "set_digest", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), "row_digest").withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, whole: one document of each component.

    Repeated rows (one id, one text) are one row. Of rows that share the id of a
    component but not the text, the one with the greatest digest stays; rows
    without shingles all stay.
    """
    found = near_duplicates(docs, id_col, text_col, words, percent).filter("kept")
    keys = found.groupBy("doc_id", "row_digest").agg(F.count(F.lit(1)).alias("_copies"), F.max("n_shingles").alias("n"))
    one = keys.groupBy("doc_id", F.when(F.col("n") > 0, F.lit("")).otherwise(F.col("row_digest")).alias("_group")).agg(
        F.max(F.struct("row_digest", "_copies")).alias("_key")
    )
    keys = one.select(F.col("doc_id").alias("_id"), F.col("_key.row_digest").alias("_digest"), "_key._copies")
    return rows_of(docs, keys, id_col, F.sha2(whole(text_col), 256))

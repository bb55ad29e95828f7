"""Spelling variants: words one edit apart, found by blocked Gram matrices of letter counts.

One replaced letter moves a word's vector of letter counts by a squared distance of
2, one letter more or less by 1. Words are put into blocks of equal length, and of
equal numbers of letters out of a few fixed groups of letters; an edit leads to the
same block or to one that differs by one letter in one or two of the numbers. For a
block and its neighbours, two products of count matrices give all squared distances
at once; pairs at most two apart, in blocks whose lengths are equal or adjacent, are
then verified letter by letter.

A block is kept as one array of bytes. Blocks of more than ``TILE`` words are cut
into tiles by a hash, and a block's neighbours are dealt into bounded groups, so no
task holds more than about ``(GROUP + 1) * TILE`` words at a time. Workers return
counts and best partners per word, never the pairs. The number of letter groups
follows from the number of words; it changes the work, not the result.

Comparisons grow with the square of a block, which is what products of blocks do;
blocks shrink as the number of groups grows with the words.

Defined cases: a null text has no words; a null id is an empty string in the hash; a
very long text only has more words; words are distinct, so repeated rows just count again; of near
words with the same number the smallest in code-point order is the form; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldspark.llm.shared import checkpoint, whole

#: Letters of the words: a to z and U+00C0 to U+00FF, which all are one byte in Latin-1.
RUN = "([A-Za-zÀ-ÿ]+)"
_CAPITALS = "".join(map(chr, range(65, 91)))
LETTERS = [*range(97, 123), *range(0xC0, 0x100)]
_PLACE = np.zeros(256, dtype=np.int64)
_PLACE[LETTERS] = np.arange(len(LETTERS))
#: Words of a tile, tiles of a group.
TILE, GROUP = 1024, 64
#: One in so many (document, word) pairs loses a letter.
NOISE = 97


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 5, least: int = 3) -> DataFrame:
    """Distinct words of all texts, with their occurrences: word, n."""
    named = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    runs = docs.select(named.alias("id"), F.explode(F.regexp_extract_all(whole(text_col), F.lit(RUN), F.lit(1))).alias("run"))
    # most runs have no capital
    low = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", _CAPITALS, _CAPITALS.lower())).otherwise(F.col("run"))
    runs = runs.select("id", low.alias("run"))
    lot = F.crc32(F.concat("id", F.lit(":"), "run"))
    length = F.char_length("run")
    at = (F.col("lot") % length).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, length))
    found = runs.withColumn("lot", lot).select(F.when(F.col("lot") % NOISE == 0, cut).otherwise(F.col("run")).alias("word"))
    counted = found.filter(F.char_length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= least)


def _blocks(vocabulary: DataFrame, groups: int) -> DataFrame:
    """Words with ``block``: how many of their letters are in each group."""
    length = F.char_length("word")
    counts = []
    for g in range(groups):
        members = "".join(chr(c) for c in LETTERS if c % groups == g)
        counts.append(length - F.char_length(F.translate("word", members, "")))
    return vocabulary.withColumn("block", F.array(*counts))


def _upwards(groups: int) -> list[list[int]]:
    """Steps to the neighbours: each pair of blocks is met from one side only."""
    unit = [[int(i == g) for i in range(groups)] for g in range(groups)]
    moved = [[a - b for a, b in zip(unit[i], unit[j])] for i, j in combinations(range(groups), 2)]
    return [[0] * groups, *unit, *moved]


def _tiled(blocks: DataFrame, groups: int) -> tuple[DataFrame, DataFrame]:
    """Tiles (block, tile, codes, ns) and the pairs of tiles to compare (a: block, a_tile; b: block, b_tile)."""
    sizes = blocks.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    sizes = checkpoint(sizes)
    rows = blocks.join(sizes, "block").withColumn("tile", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int"))
    member = F.sort_array(F.collect_list(F.struct("word", "n")))
    tiles = rows.groupBy("block", "tile").agg(member.alias("m"))
    # words of a block have one length, so that a tile is a matrix of bytes
    tiles = tiles.select(
        "block", "tile", F.encode(F.concat_ws("", "m.word"), "ISO-8859-1").alias("codes"), F.col("m.n").alias("ns")
    )
    steps = F.array(*[F.array(*[F.lit(d) for d in step]) for step in _upwards(groups)])
    reached = F.zip_with("block", "step", lambda x, d: x + d)
    pairs = (
        sizes.select(F.col("block"), "tiles", F.explode(steps).alias("step"))
        .select(F.col("block").alias("a"), F.col("tiles").alias("a_tiles"), reached.alias("block"))
        .join(sizes, "block")
        .select("a", F.explode(F.sequence(F.lit(0), F.col("a_tiles") - 1)).alias("a_tile"), "block", "tiles")
        .select("a", "a_tile", "block", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"))
        .filter((F.col("a") != F.col("block")) | (F.col("tile") >= F.col("a_tile")))
    )
    return checkpoint(tiles), pairs


def _counts(codes: np.ndarray) -> np.ndarray:
    """Letter counts of the words of a matrix of bytes, one row each."""
    width = len(LETTERS)
    flat = np.arange(len(codes))[:, None] * width + _PLACE[codes]
    return np.bincount(flat.ravel(), minlength=len(codes) * width).reshape(len(codes), width).astype(np.float32)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of ``a`` and ``b`` differ by one letter replaced, or one more in ``b``."""
    n = a.shape[1]
    if b.shape[1] == n:
        return (a != b).sum(axis=1) == 1
    before = np.cumprod(a == b[:, :n], axis=1).sum(axis=1)
    behind = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return before + behind >= n


def near_pairs(a: np.ndarray, b: np.ndarray, same: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Indices of near words of two matrices of bytes, the second as long as the first or one longer.

    ``same``: both are one matrix, and each pair is returned once.
    """
    left, right = _counts(a), _counts(b)
    used = np.flatnonzero(left.any(axis=0))
    # letters that the first matrix does not have add only to the second one's length
    distance = (left**2).sum(axis=1)[:, None] + (right**2).sum(axis=1)[None, :] - 2 * (left[:, used] @ right[:, used].T)
    i, j = np.nonzero(distance <= 2)
    if same:
        i, j = i[i < j], j[i < j]
    verified = one_edit(a[i], b[j])
    return i[verified], j[verified]


_FOUND = "word string, n_near long, form string, form_n long"


class _Partners:
    """Near words met so far for the words of one group of tiles, kept as arrays until they are summed up."""

    def __init__(self):
        self.words, self.others, self.ns = [], [], []

    def add(self, words: np.ndarray, others: np.ndarray, ns: np.ndarray) -> None:
        # as fixed-width bytes: zeros at the end keep the order of code points
        width = 1 + max(words.shape[1], others.shape[1])
        for codes, to in ((words, self.words), (others, self.others)):
            wide = np.zeros((len(codes), width), np.uint8)
            wide[:, : codes.shape[1]] = codes
            to.append(wide.view(f"S{width}").ravel())
        self.ns.append(ns)

    def summed(self) -> pa.RecordBatch | None:
        if not sum(map(len, self.ns)):
            return None
        words, others, ns = (np.concatenate(x) for x in (self.words, self.others, self.ns))
        order = np.lexsort((others, -ns, words))
        words, others, ns = words[order], others[order], ns[order]
        first = np.flatnonzero(np.r_[True, words[1:] != words[:-1]])
        text = lambda x: pa.array([w.decode("latin-1") for w in x.tolist()], pa.string())
        counts = np.diff(np.r_[first, len(words)])
        return pa.RecordBatch.from_arrays(
            [text(words[first]), pa.array(counts), text(others[first]), pa.array(ns[first])], names=["word", "n_near", "form", "form_n"]
        )


def _matrix(codes: bytes, n: int) -> np.ndarray:
    return np.frombuffer(codes, np.uint8).reshape(n, -1)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of their key, a key's own tile first: all near words of a key's tile."""
    key = own = partners = None
    wait: list[tuple[np.ndarray, np.ndarray]] = []

    def meet() -> None:
        codes, ns = own
        for longer in (False, True):
            chosen = [w for w in wait if (w[0].shape[1] > codes.shape[1]) == longer]
            if not chosen:
                continue
            others, other_ns = np.concatenate([c for c, _ in chosen]), np.concatenate([n for _, n in chosen])
            note(codes, ns, others, other_ns, *near_pairs(codes, others))
        wait.clear()

    def note(a, a_n, b, b_n, i, j) -> None:
        if len(i):
            partners.add(a[i], b[j], b_n[j])
            partners.add(b[j], a[i], a_n[i])

    def closed() -> pa.RecordBatch | None:
        if key is None:
            return None
        meet()
        return partners.summed()

    for batch in batches:
        ns = batch.column("ns")
        for r, (at, is_own, first, codes) in enumerate(
            zip(*(batch.column(c).to_pylist() for c in ("key", "is_own", "chunk", "codes")))
        ):
            n = ns[r].values.to_numpy()
            tile = (_matrix(codes, len(n)), n)
            if at != key:
                if (out := closed()) is not None:
                    yield out
                key, own, partners = at, tile, _Partners()
                if first == 0:  # the tile with itself, once
                    note(*tile, *tile, *near_pairs(tile[0], tile[0], same=True))
            elif not is_own:
                wait.append(tile)
                if sum(len(c) for c, _ in wait) >= 8 * TILE:
                    meet()
    if (out := closed()) is not None:
        yield out


def near_words(vocabulary: DataFrame) -> DataFrame:
    """Per word of ``vocabulary`` (word, n) with near words: word, n_near, form and form_n (the near word of largest n)."""
    count = vocabulary.count()
    groups = max(2, math.ceil(math.log10(max(count, 10))))
    tiles, pairs = _tiled(_blocks(vocabulary, groups), groups)
    # a tile's partners, in chunks of about GROUP; every chunk needs the tile itself
    pairs = pairs.withColumn("own", (F.col("a") == F.col("block")) & (F.col("a_tile") == F.col("tile")))
    totals = pairs.groupBy("a", "a_tile").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("chunks"))
    chunk = F.when(F.col("own"), F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("block", "tile"), F.col("chunks")).cast("int"))
    )
    dealt = pairs.join(totals, ["a", "a_tile"]).select("a", "a_tile", "block", "tile", "own", F.explode(chunk).alias("chunk"))
    key = F.concat_ws(",", F.col("a").cast("array<string>"), "a_tile", "chunk")
    rows = dealt.join(tiles, ["block", "tile"]).select(key.alias("key"), F.col("own").alias("is_own"), "chunk", "codes", "ns")
    ordered = rows.repartition("key").sortWithinPartitions("key", F.desc("is_own"))
    found = ordered.mapInArrow(_compared, _FOUND)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n")
    )


def roots(forms: DataFrame) -> DataFrame:
    """Per word of ``forms`` (word, form) the last form of its chain: word, root.

    Every form is at least twice as frequent as its word, so a chain is short; pointers double in every round.
    """
    at = checkpoint(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = at.select(F.col("word").alias("_word"), F.col("root").alias("_next"))
        moved = at.join(onward, F.col("root") == F.col("_word"), "left")
        after = checkpoint(moved.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")))
        if after.filter("moved").isEmpty():
            return after.select("word", "root")
        at = after.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 5, least: int = 3, ratio: int = 2) -> DataFrame:
    """Per word of all texts: word, form, root, n, n_near and form_n.

    A word's form is its most frequent near word if that is ``ratio`` (2 or more) times as frequent.
    """
    if ratio < 2:
        raise ValueError("a form must be at least twice as frequent, or chains might never end")
    vocabulary = checkpoint(words(docs, id_col, text_col, shortest, least))
    near = vocabulary.join(near_words(vocabulary), "word", "left")
    is_form: Column = F.col("form_n") >= F.col("n") * ratio
    near = checkpoint(
        near.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("form")).alias("form"),
            F.when(is_form, F.col("form_n")).alias("form_n"),
        )
    )
    ends = roots(near.filter("form IS NOT NULL"))
    return near.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )

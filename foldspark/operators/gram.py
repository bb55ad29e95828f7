"""Cross-product matrices of wide designs, for many row subsets in one pass.

For every subset the result is n, the column means and the centred
cross-products. Everything least squares needs follows from those p x p numbers,
so the rows are read once however many resamples or workflows are fitted.

Rows go through an Arrow kernel that multiplies one record batch at a time and
emits one partial matrix per task; codes and splines cross as single numbers, and
their products are counted by cell. Partials are summed cell by cell in a normal
aggregation, so nothing data-sized meets in one task. A row with a NULL, NaN or
infinite value in a design is left out of that design, however wide it is.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from foldspark.operators.splines import NaturalSpline

MAX_WIDTH = 2000
_BATCH_BYTES = 32 << 20
#: Up to so many numbers a row, means are plain aggregates: nothing crosses to Python for them.
_FEW = 64


@dataclass(frozen=True)
class Gram:
    """Size, means and centred cross-products of one subset."""

    n: float
    mean: np.ndarray
    cross: np.ndarray

    def __add__(self, other: "Gram") -> "Gram":
        """Two disjoint subsets together."""
        n = self.n + other.n
        if not n:
            return self
        gap = other.mean - self.mean
        cross = self.cross + other.cross + (self.n * other.n / n) * np.outer(gap, gap)
        return Gram(n, self.mean + gap * (other.n / n), cross)

    def map(self, table: np.ndarray) -> "Gram":
        """The same subset seen through a linear map of the columns."""
        return Gram(self.n, self.mean @ table, table.T @ self.cross @ table)

    def __sub__(self, part: "Gram") -> "Gram":
        """The subset left when ``part`` is removed."""
        n = self.n - part.n
        mean = (self.n * self.mean - part.n * part.mean) / n if n else self.mean
        gap = part.mean - mean
        whole = self.mean - mean
        cross = (
            self.cross
            - part.cross
            + self.n * np.outer(whole, whole)
            - part.n * np.outer(gap, gap)
        )
        return Gram(n, mean, cross)


@dataclass(frozen=True)
class Coding:
    """A vector position that holds a code from 0 to ``levels`` - 1, and that of a factor of its 0/1 columns.

    Codings of one ``source`` have the same code in every row.
    """

    at: int
    levels: int
    factor: int | None
    source: int


@dataclass(frozen=True)
class Member:
    """One design: its vector, the vector's length, and the subsets it is wanted for.

    ``curves`` names, per subset, vector positions to be replaced by a spline basis
    inside the kernel. The expanded columns follow the plain ones, so only the raw
    number has to cross to Python, however many bases are evaluated on it.
    ``codes`` are positions replaced in their place by one 0/1 column a code.
    """

    vector: Column
    width: int
    subsets: tuple[str, ...]
    curves: dict[str, tuple[tuple[int, NaturalSpline], ...]] | None = None
    codes: tuple[Coding, ...] = ()

    def splines(self, subset: str) -> tuple[tuple[int, NaturalSpline], ...]:
        return (self.curves or {}).get(subset, ())

    def plain(self, subset: str) -> list[tuple[int, int]]:
        """Vector positions that are not bent, each with its number of columns."""
        gone = {at for at, _ in self.splines(subset)} | {c.factor for c in self.codes}
        many = {c.at: c.levels for c in self.codes}
        return [(i, many.get(i, 1)) for i in range(self.width) if i not in gone]

    def size(self, subset: str) -> int:
        """Columns of the cross-products of a subset."""
        return sum(n for _, n in self.plain(subset)) + sum(s.size for _, s in self.splines(subset))

    def origin(self, subset: str, shift: np.ndarray) -> np.ndarray:
        """The reference point of a subset; a spline basis and 0/1 columns need none."""
        coded = {c.at for c in self.codes}
        plain = [np.zeros(n) if i in coded else shift[i : i + 1] for i, n in self.plain(subset)]
        return np.concatenate([*plain, np.zeros(sum(s.size for _, s in self.splines(subset)))])


def grams(
    df: DataFrame, weights: dict[str, Column], members: dict[str, Member]
) -> dict[tuple[str, str], Gram]:
    """Cross-products of every member over the rows of each of its subsets.

    ``weights`` gives the multiplicity of a row in every subset. All members and
    subsets come from one pass over the rows (after one for the reference point),
    and a row crosses to Python once however many subsets it is in. Rows with a
    NULL, NaN or infinity in a member's vector are left out of that member.
    """
    widest = max(m.size(s) for m in members.values() for s in m.subsets)
    if widest > MAX_WIDTH:
        raise ValueError(f"a design of {widest} columns exceeds {MAX_WIDTH}")
    shifts = _shifts(df, members)
    found = _sums(df, weights, members, shifts)
    result = {}
    for (name, subset), full in found.items():
        n = full[0, 0]
        offset = full[0, 1:] / n if n else np.zeros(len(full) - 1)
        cross = full[1:, 1:] - n * np.outer(offset, offset)
        result[name, subset] = Gram(n, members[name].origin(subset, shifts[name]) + offset, cross)
    return result


def gram(df: DataFrame, vector: Column, width: int) -> Gram:
    """Cross-products of one vector over all rows."""
    member = {"all": Member(vector, width, ("all",))}
    return grams(df, {"all": F.lit(1)}, member)["all", "all"]


def _shifts(df: DataFrame, members: dict[str, Member]) -> dict[str, np.ndarray]:
    """The column means of every member over all rows.

    Cross-products about any point give the same centred result; a near one keeps its digits.
    """
    names = list(members)
    widths = [members[n].width for n in names]
    rows = df.select(*[members[n].vector.cast("array<double>").alias(f"z{i}") for i, n in enumerate(names)])
    if sum(widths) <= _FEW:
        spots = [F.get(f"z{i}", F.lit(j)) for i, width in enumerate(widths) for j in range(width)]
        # NaN is above infinity
        finite = [F.when(F.abs(x) < float("inf"), x) for x in spots]
        found = rows.agg(*[F.avg(x).alias(f"m{k}") for k, x in enumerate(finite)]).first()
        means = np.array([0.0 if m is None else m for m in found])
        return dict(zip(names, np.split(means, np.cumsum(widths)[:-1])))
    schema = pa.schema([("cell", pa.int32()), ("value", pa.float64()), ("n", pa.float64())])

    def kernel(batches):
        totals, counts = ([np.zeros(w) for w in widths] for _ in range(2))
        for batch in batches:
            for i, width in enumerate(widths):
                column = batch.column(f"z{i}")
                raw = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                finite = np.isfinite(raw)
                totals[i] += np.where(finite, raw, 0.0).sum(axis=0)
                counts[i] += finite.sum(axis=0)
        both = np.concatenate(totals), np.concatenate(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(both[0]), dtype=np.int32)), *(pa.array(x) for x in both)], schema=schema
        )

    with _batch_rows(df.sparkSession, max(64, _BATCH_BYTES // (8 * sum(widths)))):
        parts = rows.mapInArrow(kernel, "cell int, value double, n double")
        table = parts.groupBy("cell").agg(F.sum("value").alias("value"), F.sum("n").alias("n")).toArrow()
    means = np.zeros(sum(widths))
    counts = table.column("n").to_numpy()
    means[table.column("cell").to_numpy()] = table.column("value").to_numpy() / np.maximum(counts, 1)
    return dict(zip(names, np.split(means, np.cumsum(widths)[:-1])))


def _sums(df, weights, members, shifts) -> dict[tuple[str, str], np.ndarray]:
    """One partial matrix per task, then a sum per cell."""
    subsets = list(weights)
    names = list(members)
    plan = [
        (
            members[n].width,
            [
                (subsets.index(s), members[n].plain(s), [(at, *c.local()) for at, c in members[n].splines(s)])
                for s in members[n].subsets
            ],
            [(c.at, c.levels, c.factor, c.source) for c in members[n].codes],
            shifts[n],
        )
        for n in names
    ]
    wanted = F.array(*[weights[s].cast("double") for s in subsets])
    columns = []
    for i, n in enumerate(names):
        used = [weights[s] > 0 for s in members[n].subsets]
        anywhere = used[0]
        for u in used[1:]:
            anywhere = anywhere | u
        # a design is evaluated only on rows that need it
        columns.append(F.when(anywhere, members[n].vector.cast("array<double>")).alias(f"z{i}"))
    partials = df.select(wanted.alias("w"), *columns).mapInArrow(
        _partial_kernel(plan), "pair int, cell int, value double"
    )
    row_bytes = 8 * (len(subsets) + sum(m.width for m in members.values()))
    with _batch_rows(df.sparkSession, max(64, _BATCH_BYTES // row_bytes)):
        table = partials.groupBy("pair", "cell").agg(F.sum("value").alias("value")).toArrow()
    pair_of = table.column("pair").to_numpy()
    cell_of = table.column("cell").to_numpy()
    values = table.column("value").to_numpy()
    result = {}
    for i, n in enumerate(names):
        for s in members[n].subsets:
            p = members[n].size(s)
            a, b = np.triu_indices(p + 1)
            mine = pair_of == i * len(subsets) + subsets.index(s)
            full = np.zeros((p + 1, p + 1))
            at = cell_of[mine]
            full[a[at], b[at]] = values[mine]
            full[b[at], a[at]] = values[mine]
            result[n, s] = full
    return result


@contextmanager
def _batch_rows(spark: SparkSession, rows: int):
    """Keep Arrow batches of wide rows small while one job runs."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before) if int(before) > 0 else rows, rows)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _partial_kernel(plan):
    """``plan`` lists, per member, its width, its subsets with their layout, its codes, and its shift.

    Columns of which a row has few that are not zero, those of codes and of the intervals of splines, are
    groups: a cell and a value or some per row. Their products are sums per cell or pair of cells.
    """
    schema = pa.schema([("pair", pa.int32()), ("cell", pa.int32()), ("value", pa.float64())])

    def bent(x, breaks, origins, widths):
        """The interval, and the four cubics that are positive in it; two lines beyond the ends."""
        j = np.searchsorted(breaks, x, side="right")
        s = (x - origins[j]) / widths[j]
        r = 1.0 - s
        own = [r * r * r, 3.0 * s * r * r, 3.0 * s * s * r, s * s * s]
        out = (j == 0) | (j == len(breaks))
        if out.any():
            for v, beyond in zip(own, (r, s, 0.0 * s, 0.0 * s)):
                v[out] = beyond[out]
        return j, own

    def cells(index, size, values):
        return np.bincount(index, minlength=size) if values is None else np.bincount(index, values, size)

    def times(a, b):
        return b if a is None else a if b is None else a * b

    def products(dense, groups, weight):
        """All products of the dense columns and the groups (source, cell, cells, values)."""
        found = [(dense if weight is None else dense * weight[:, None]).T @ dense]
        heavy = [[times(v, weight) for v in values] for _, _, _, values in groups]
        # the first dense column is one
        columns = [None, *[np.ascontiguousarray(c) for c in dense.T[1:]]]
        for (_, g, n, _), own in zip(groups, heavy):
            found.append(np.array([[cells(g, n, times(d, v)) for v in own] for d in columns]))
        for a, (source, g, n, values) in enumerate(groups):
            for b, (other, h, m, _) in enumerate(groups[a:], start=a):
                at, size = (g, n) if source == other else (g * m + h, n * m)
                found.append(
                    np.array(
                        [
                            [cells(at, size, times(v, w)) if a != b or k <= l else np.zeros(size) for l, w in enumerate(heavy[b])]
                            for k, v in enumerate(values)
                        ]
                    )
                )
        return found

    def whole(found, dense_at, layout):
        """The products as one symmetric matrix; ``layout`` lists source, first column, cells and values of the groups."""
        size = max([*[i + 1 for i in dense_at], *[first + n * k for _, first, n, k in layout]])
        full = np.zeros((size, size))
        full[np.ix_(dense_at, dense_at)] = found[0]
        rest = iter(found[1:])
        spots = [first + np.arange(n)[None, :] * k + np.arange(k)[:, None] for _, first, n, k in layout]
        for spot in spots:
            block = next(rest)  # dense, value, cell
            full[np.ix_(dense_at, spot.ravel())] = block.reshape(len(dense_at), -1)
            full[np.ix_(spot.ravel(), dense_at)] = block.reshape(len(dense_at), -1).T
        for a, (source, _, n, _) in enumerate(layout):
            for b, (other, _, m, _) in enumerate(layout[a:], start=a):
                block = next(rest)
                for k in range(block.shape[0]):
                    for l in range(block.shape[1]):
                        if a == b and k > l:
                            continue
                        if source == other:
                            full[spots[a][k], spots[b][l]] = full[spots[b][l], spots[a][k]] = block[k, l]
                        else:
                            square = block[k, l].reshape(n, m)
                            full[np.ix_(spots[a][k], spots[b][l])] = square
                            full[np.ix_(spots[b][l], spots[a][k])] = square.T
        return full

    def kernel(batches):
        totals: dict[tuple[int, int], list[np.ndarray]] = {}
        layouts: dict[tuple[int, int], tuple] = {}
        subsets = 0
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            w = batch.column("w").flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)
            subsets = w.shape[1]
            for i, (p, wanted, codes, shift) in enumerate(plan):
                column = batch.column(f"z{i}")
                present = column.is_valid().to_numpy(zero_copy_only=False)
                raw = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, p)
                known = np.isfinite(raw).all(axis=1)
                for at, levels, _, _ in codes:
                    known &= (raw[:, at] >= 0) & (raw[:, at] < levels)
                raw, weight = raw[known], w[present][known]
                coded = {at: (levels, factor, source) for at, levels, factor, source in codes}
                for k, plain, splines in wanted:
                    at = np.flatnonzero(weight[:, k] > 0)
                    if not len(at):
                        continue
                    own, times_each = raw[at], weight[at, k]
                    dense, dense_at, groups, layout, place = [np.ones(len(at))], [0], [], [], 1
                    for c, columns in plain:
                        if c in coded:
                            levels, factor, source = coded[c]
                            values = [None if factor is None else own[:, factor]]
                            groups.append((source, own[:, source].astype(np.int64), levels, values))
                            layout.append((source, place, levels, 1))
                        else:
                            dense.append(own[:, c] - shift[c])
                            dense_at.append(place)
                        place += columns
                    tables = []
                    for c, breaks, origins, widths, table in splines:
                        cell, values = bent(own[:, c], breaks, origins, widths)
                        groups.append((("curve", c), cell, len(breaks) + 1, values))
                        layout.append((("curve", c), place + sum(len(t) for t in tables), len(breaks) + 1, 4))
                        tables.append(table)
                    found = products(np.column_stack(dense), groups, None if (times_each == 1).all() else times_each)
                    if (i, k) in totals:
                        for total, new in zip(totals[i, k], found):
                            total += new
                    else:
                        totals[i, k] = [f.astype(np.float64) for f in found]
                        layouts[i, k] = (dense_at, layout, place, tables)
        for (i, k), found in totals.items():
            dense_at, layout, place, tables = layouts[i, k]
            total = whole(found, dense_at, layout)
            if tables:
                # from the functions of intervals to the basis
                turn = np.zeros((len(total), place + sum(t.shape[1] for t in tables)))
                turn[:place, :place] = np.eye(place)
                row, column = place, place
                for t in tables:
                    turn[row : row + len(t), column : column + t.shape[1]] = t
                    row, column = row + len(t), column + t.shape[1]
                total = turn.T @ total @ turn
            upper = total[np.triu_indices(len(total))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(upper), i * subsets + k, dtype=np.int32)),
                    pa.array(np.arange(len(upper), dtype=np.int32)),
                    pa.array(upper),
                ],
                schema=schema,
            )

    return kernel

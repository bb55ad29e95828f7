"""Exact order statistics without a global sort.

A window with no partition key pulls every row into one task, and the exact
``percentile`` aggregate keeps every distinct value in one task's memory. Here
rows are first counted per distinct value, so a value that fills a third of the
table is one row. The distinct values are then range partitioned, or cut into buckets of similar size,
the totals of earlier parts are summed in order, and only places inside a part need a
sort, one part per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from foldspark.functions.hashing import HASH_BITS
from foldspark.session import cut_lineage

_BUCKET = "__bucket"
_BOUNDARY_ACCURACY = 20_000
_HASH_BUCKET_BITS = 14


def _bucket_count(df: DataFrame) -> int:
    """Four buckets per shuffle partition, between 32 and 4096."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(32, min(4096, 4 * partitions))


def _boundaries(value: Column, buckets: int) -> Column:
    grid = [i / buckets for i in range(1, buckets)]
    return F.percentile_approx(value.cast("double"), grid, _BOUNDARY_ACCURACY)


def _with_bucket(df: DataFrame, order: str, cuts: list[float] | None) -> DataFrame:
    splits = [float("-inf"), *sorted(set(cuts or [])), float("inf")]
    stage = Bucketizer(
        splits=splits, inputCol="__order", outputCol=_BUCKET, handleInvalid="keep"
    )
    return stage.transform(df.withColumn("__order", F.col(order).cast("double"))).drop("__order")


def in_order(df: DataFrame, by: list[str]) -> DataFrame:
    """``df`` sorted by ``by`` over all partitions and written down, with ``__part`` and ``__place`` (from 0 in its part).

    Keys are of any type that sorts. Partitions are cut by sampled bounds of the whole key, so a hot first
    key is spread over many of them.
    """
    at = F.monotonically_increasing_id()
    ordered = df.repartitionByRange(*by).sortWithinPartitions(*by)
    numbered = ordered.withColumns({"__part": F.shiftright(at, 33).cast("int"), "__place": at.bitwiseAND(F.lit((1 << 33) - 1))})
    return cut_lineage(numbered)


def running_totals(
    counts: DataFrame,
    order: str,
    totals: list[str],
    by: list[str] | None = None,
) -> DataFrame:
    """Add ``cum_<t>``: the sum of ``t`` over rows up to and including this one, within each group of ``by``.

    ``counts`` holds one row per (``by``, ``order``). Neither many groups nor one huge group is special: rows
    are range partitioned by group and order, and earlier partitions enter by their sums per group.
    """
    by = by or []
    ordered = in_order(counts, [*by, order])
    sums = ordered.groupBy("__part", *by).agg(*[F.sum(t).alias(f"__sum_{t}") for t in totals])
    # at most one row per partition and group
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *[F.col(b).alias(f"__o_{b}") for b in by],
        F.col("__part").alias("__o_part"),
        *[F.coalesce(F.sum(f"__sum_{t}").over(before), F.lit(0)).alias(f"__before_{t}") for t in totals],
    )
    condition = reduce(
        lambda a, b: a & b, [F.col("__part") == F.col("__o_part"), *[F.col(b).eqNullSafe(F.col(f"__o_{b}")) for b in by]]
    )
    joined = ordered.join(offsets, condition)
    inside = Window.partitionBy("__part", *by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return joined.select(
        *counts.columns, *[(F.sum(t).over(inside) + F.col(f"__before_{t}")).alias(f"cum_{t}") for t in totals]
    )


def positions(df: DataFrame, key: str | list[str], name: str = "position") -> DataFrame:
    """Add the 1-based position of each row in the order of ``key``, one or several columns that tell rows apart.

    Only the number of rows of each partition is seen by the driver.
    """
    ordered = in_order(df, [key] if isinstance(key, str) else key)
    counts = {r["__part"]: r["count"] for r in ordered.groupBy("__part").count().collect()}
    starts = [0]
    for part in range(max(counts, default=0)):
        starts.append(starts[-1] + counts.get(part, 0))
    before = F.get(F.array(*[F.lit(n).cast("long") for n in starts]), "__part")
    return ordered.select(*df.columns, (before + F.col("__place") + 1).alias(name))


def grouped_quantiles(df: DataFrame, by: list[str], value: str, probabilities: list[float]) -> DataFrame:
    """Exact interpolated quantiles of every group, as an array in the order of ``probabilities``: by, quantiles.

    Groups are never collected: values are counted per group, and the ranks wanted are
    picked from running totals. A group without values has missing quantiles.
    """
    counts = df.groupBy(*by, F.col(value).cast("double").alias("__value")).agg(F.count(value).alias("__n"))
    ranked = running_totals(counts, "__value", ["__n"], by)
    sizes = counts.groupBy(*[F.col(b).alias(f"__s_{b}") for b in by]).agg(F.sum("__n").alias("__size"))
    same = reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.col(f"__s_{b}")) for b in by])
    first, last = F.col("cum___n") - F.col("__n"), F.col("cum___n")
    picked, out = [], []
    for k, p in enumerate(probabilities):
        at = (F.col("__size") - 1) * F.lit(float(p))
        low = F.floor(at)
        for end, rank in (("low", low), ("high", F.least(low + 1, F.col("__size") - 1))):
            picked.append(F.max(F.when((rank >= first) & (rank < last), F.col("__value"))).alias(f"__{end}{k}"))
        picked.append(F.max(at - low).alias(f"__rest{k}"))
        out.append(F.col(f"__low{k}") + (F.col(f"__high{k}") - F.col(f"__low{k}")) * F.col(f"__rest{k}"))
    found = ranked.join(sizes, same).groupBy(*by).agg(*picked)
    return found.select(*by, F.array(*out).alias("quantiles"))


def block_number(position: Column, n_rows: Column, blocks: int) -> Column:
    """The block of a 1-based position when rows are cut into contiguous blocks.

    Block sizes differ by at most one and the larger blocks come first.
    """
    small = F.floor(n_rows / blocks)
    large_blocks = n_rows % blocks
    in_large = large_blocks * (small + 1)
    late = F.floor((position - in_large - 1) / F.greatest(small, F.lit(1))) + large_blocks
    return (
        F.when(position <= in_large, F.floor((position - 1) / (small + 1))).otherwise(late) + 1
    ).cast("int")


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: list[float],
    weights: dict[str, Column] | None = None,
) -> dict[str, list[float]]:
    """Exact interpolated quantiles, for many row subsets in one pass.

    ``weights`` names the subsets: a 0/1 or multiplicity column for each. The
    quantile at p lies at rank (n - 1) p, linearly interpolated. The result is
    a driver-side dictionary of ``len(weights) * len(probabilities)`` numbers.
    """
    weights = weights or {"all": F.lit(1)}
    names = list(weights)
    columns = [f"__w{i}" for i in range(len(names))]
    counts = (
        df.where(F.col(value).isNotNull())
        .select(
            F.col(value).cast("double").alias("__value"),
            *[weights[n].cast("long").alias(c) for n, c in zip(names, columns)],
        )
        .groupBy("__value")
        .agg(*[F.sum(c).alias(c) for c in columns])
        .persist()
    )
    n_buckets = _bucket_count(df)
    summary = counts.agg(
        _boundaries(F.col("__value"), n_buckets).alias("q"), *[F.sum(c).alias(c) for c in columns]
    ).first()
    sizes = {c: summary[c] or 0 for c in columns}
    bucketed = _with_bucket(counts, "__value", summary["q"])
    per_bucket = bucketed.groupBy(_BUCKET).agg(*[F.sum(c).alias(c) for c in columns]).collect()
    per_bucket.sort(key=lambda row: row[_BUCKET])

    # for every wanted rank, its bucket and the rows before that bucket
    places: dict[tuple[str, int], tuple[float, int]] = {}
    for column in columns:
        targets = sorted({r for p in probabilities for r in _rank_pair(sizes[column], p)})
        passed, cursor = 0, 0
        for row in per_bucket:
            while cursor < len(targets) and targets[cursor] < passed + row[column]:
                places[column, targets[cursor]] = (row[_BUCKET], passed)
                cursor += 1
            passed += row[column]
    at_rank: dict[tuple[str, int], float] = {}
    if places:
        # one row per wanted rank
        lookup = df.sparkSession.createDataFrame(
            [(columns.index(c), r, b, r - passed) for (c, r), (b, passed) in places.items()],
            f"subset int, target long, {_BUCKET} double, inside long",
        )
        inside = Window.partitionBy(_BUCKET).orderBy("__value").rowsBetween(
            Window.unboundedPreceding, 0
        )
        needed = sorted({bucket for bucket, _ in places.values()})
        ranked = bucketed.where(F.col(_BUCKET).isin(needed)).select(
            _BUCKET,
            "__value",
            F.array(*columns).alias("own"),
            F.array(*[F.sum(c).over(inside) for c in columns]).alias("upto"),
        )
        upto = F.get("upto", F.col("subset"))
        covers = (F.col("inside") < upto) & (F.col("inside") >= upto - F.get("own", F.col("subset")))
        found = ranked.join(F.broadcast(lookup), _BUCKET).where(covers)
        for row in found.select("subset", "target", "__value").collect():
            at_rank[columns[row["subset"]], row["target"]] = row["__value"]
    counts.unpersist()

    result = {}
    for name, column in zip(names, columns):
        n = sizes[column]
        values = []
        for p in probabilities:
            if n == 0:
                values.append(None)
                continue
            low, high = (at_rank[column, r] for r in _rank_pair(n, p))
            part = (n - 1) * p - int((n - 1) * p)
            values.append(low + (high - low) * part)
        result[name] = values
    return result


def _rank_pair(n: int, p: float) -> tuple[int, ...]:
    """The two 0-based ranks around the quantile at p."""
    if n == 0:
        return ()
    low = int((n - 1) * p)
    return (low, min(low + 1, n - 1))


def hash_cuts(
    df: DataFrame,
    bits: dict[str, Column],
    ranks,
    stratum: Column | None = None,
) -> dict[str, dict[str, list[int]]]:
    """Hash values at given ranks: cuts that split rows into exact sizes.

    ``bits`` holds one uniform hash column per replicate; ``ranks(n)`` lists, as
    columns of n, the 1-based ranks wanted in a stratum of n rows. Returns, per replicate and
    stratum, the hash value at every rank, so that membership is a comparison of
    the row's own hash with a literal: no join, no sort and no shuffle of rows.

    Rows are counted per leading bits first; only the buckets that hold a wanted
    rank are then ranked. The hash is uniform, so no bucket is hot.
    """
    names = list(bits)
    group = stratum if stratum is not None else F.lit("all")
    hashed = df.select(
        group.cast("string").alias("stratum"),
        F.posexplode(F.array(*[bits[n] for n in names])).alias("rep", "bits"),
    ).withColumn("bucket", F.shiftright("bits", HASH_BITS - _HASH_BUCKET_BITS))
    each = Window.partitionBy("rep", "stratum")
    upto = each.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    counted = (
        hashed.groupBy("rep", "stratum", "bucket")
        .agg(F.count("*").alias("n"))
        .withColumns({"upto": F.sum("n").over(upto), "size": F.sum("n").over(each)})
    )
    targets = F.array(*[t.cast("long") for t in ranks(F.col("size"))])
    hits = counted.select(
        "rep", "stratum", "bucket", "n", "upto", F.posexplode(targets).alias("slot", "target")
    ).where((F.col("target") > F.col("upto") - F.col("n")) & (F.col("target") <= F.col("upto")))
    # one row per replicate, stratum and rank
    hits = hits.select(
        "rep", "stratum", "bucket", "slot", (F.col("target") - F.col("upto") + F.col("n")).alias("rank")
    )
    where = ["rep", "stratum", "bucket"]
    inside = Window.partitionBy(*where).orderBy("bits")
    wanted = F.broadcast(hits.groupBy(*where).agg(F.collect_list(F.struct("rank", "slot")).alias("hits")))
    found = (
        hashed.join(wanted, where)
        .withColumn("rank", F.row_number().over(inside))
        .select("rep", "stratum", "bits", "rank", F.explode("hits").alias("hit"))
        .where("rank = hit.rank")
        .select("rep", "stratum", "bits", "hit.slot")
    )
    slots = len(ranks(F.lit(1)))
    cuts: dict[str, dict[str, list[int]]] = {name: {} for name in names}
    for row in found.collect():
        own = cuts[names[row["rep"]]].setdefault(row["stratum"], [-1] * slots)
        own[row["slot"]] = row["bits"]
    return cuts

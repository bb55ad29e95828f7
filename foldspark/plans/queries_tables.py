"""Queries over tables: sources, projections, joins, aggregates, ordering, scalars."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from foldspark.functions.hashing import hash01
from foldspark.functions.text import first_chars, last_chars, paste, remove_all, strip_prefix
from foldspark.operators.metrics import share_of_total
from foldspark.operators.ordered import block_number, positions
from foldspark.operators.plotdata import ordered_levels
from foldspark.operators.verbs import (
    fill,
    group_nest,
    keep_prefix,
    drop_prefix,
    columns_containing,
    levels_table,
    lookup_rows,
    member_flag,
    nominal_columns,
    sum_missing,
    top_rows,
    transform_columns,
    unnest,
)
from foldspark.plans.registry import query
from foldspark.plans.tables import (
    AID_SQL,
    DEGREES_SQL,
    FALL_SQL,
    REG_SQL,
    RETURN_TERM,
    STUDENTS_SQL,
    TESTS_SQL,
    aid_payments,
    aid_totals,
    degrees,
    fall_registrations,
    graded_events,
    GRADED_SQL,
    registrations,
    students,
    test_takers,
)
from foldspark.sources.tables import read_table, register_table, shape

_HASH = "(('0x' || substr(md5(concat_ws('|', '{seed}', CAST({key} AS VARCHAR))), 1, 13))::BIGINT)"


def hash_sql(seed, key: str) -> str:
    """The row hash in SQL."""
    return _HASH.format(seed=seed, key=key)


# ---------------------------------------------------------------- sources

@query(
    "s1_scan_table",
    "SELECT o_custkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_totalprice > 400000",
)
def scan_table(spark, folder):
    """Filter and projection reach the parquet scan."""
    orders = read_table(spark, "orders", folder)
    return orders.where("o_orderdate >= '1998-01-01' AND o_totalprice > 400000").select(
        "o_custkey", "o_totalprice"
    )


@query("s2_schema_qualified_scan", f"WITH {DEGREES_SQL} SELECT person_id, grad_term FROM degrees")
def schema_qualified_scan(spark, folder):
    return read_table(spark, register_table(degrees(spark, folder), "foldspark_degrees"))


@query("s3_load_data_set", "SELECT p_type, p_size, p_retailprice FROM part")
def load_data_set(spark, folder):
    return read_table(spark, "part", folder).select("p_type", "p_size", "p_retailprice")


@query(
    "s4_integer_range",
    "WITH n AS (SELECT CAST(max(p_size) AS BIGINT) AS hi FROM part), "
    "r AS (SELECT unnest(range(1, hi + 1)) AS x FROM n) "
    "SELECT r.x, 'part' AS label, CAST(count(p_partkey) AS BIGINT) AS n FROM r LEFT JOIN part ON p_size = r.x GROUP BY r.x",
)
def range_rows(spark, folder):
    """Every integer up to the largest size, with a recycled label and its rows."""
    part = read_table(spark, "part", folder)
    values = part.agg(F.max("p_size").cast("long").alias("hi")).select(
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("hi"))).alias("x"), F.lit("part").alias("label")
    )
    counts = part.groupBy(F.col("p_size").cast("long").alias("x")).agg(F.count("*").alias("n"))
    return values.join(counts, "x", "left").fillna({"n": 0})


@query("s6_shape", "SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(11 AS BIGINT) AS n_cols FROM lineitem")
def table_shape(spark, folder):
    return shape(read_table(spark, "lineitem", folder))


@query(
    "s7_column_names",
    "WITH c AS (SELECT unnest(['o_orderkey','o_custkey','o_orderstatus','o_totalprice','o_orderdate','o_orderpriority']) AS column_name) "
    "SELECT column_name FROM c",
)
def column_names(spark, folder):
    orders = read_table(spark, "orders", folder)
    # the names are those of the schema that the files give
    return spark.createDataFrame([(c,) for c in orders.columns], "column_name string")


# ---------------------------------------------------------------- projections and filters

_FALL = f"WITH {REG_SQL},{FALL_SQL} "


@query("p1_select_columns", _FALL + "SELECT person_id, term_code, sex, age FROM fall")
def select_columns(spark, folder):
    return fall_registrations(spark, folder).select("person_id", "term_code", "sex", "age")


@query("p2_drop_columns", "SELECT p_partkey, p_name, p_brand, p_type FROM part")
def drop_columns(spark, folder):
    return read_table(spark, "part", folder).drop("p_size", "p_retailprice")


@query("p3_select_by_name", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def select_by_name(spark, folder):
    """A prefix keeps, a substring picks, a negated prefix drops."""
    customer = read_table(spark, "customer", folder)
    picked = keep_prefix(customer, "c_")
    keys = columns_containing(picked, "key")
    return drop_prefix(picked.select(*keys, "c_name", "c_acctbal"), "c_acct")


@query("p4_select_nominal", "SELECT o_orderstatus, o_orderpriority, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1, 2")
def select_nominal(spark, folder):
    """Columns picked by type."""
    orders = read_table(spark, "orders", folder)
    return orders.groupBy(*nominal_columns(orders)).agg(F.count("*").alias("n"))


@query("p5_computed_column", "SELECT o_orderkey, round(log10(o_totalprice), 6) + 0.0 AS log_price FROM orders")
def computed_column(spark, folder):
    orders = read_table(spark, "orders", folder)
    return orders.select("o_orderkey", F.round(F.log10("o_totalprice"), 6).alias("log_price"))


@query(
    "p6_across_columns",
    "SELECT l_orderkey, l_partkey, l_linenumber, CAST(trunc(l_quantity) AS INTEGER) AS l_quantity, "
    "CAST(trunc(l_extendedprice) AS INTEGER) AS l_extendedprice FROM lineitem",
)
def across_columns(spark, folder):
    lines = read_table(spark, "lineitem", folder).select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    return transform_columns(lines, ["l_quantity", "l_extendedprice"], lambda c: c.cast("int"))


@query(
    "p7_rename_all",
    f"WITH {REG_SQL} SELECT row_key, person_id, term_code, sex, age, zip, load FROM reg",
)
def rename_all_columns(spark, folder):
    raw = registrations(spark, folder)
    kept = raw.select(*[f"reg_{c}" for c in ("row_key", "person_id", "term_code", "sex", "age", "zip", "load")])
    return strip_prefix(kept, "reg_")


@query("p8_pull_column", "SELECT o_totalprice FROM orders")
def pull_column(spark, folder):
    return read_table(spark, "orders", folder).select("o_totalprice")


@query(
    "p9_conjunctive_filter",
    _FALL + "SELECT row_key, term_code, courses, total_hours FROM fall",
)
def conjunctive_filter(spark, folder):
    return fall_registrations(spark, folder).select("row_key", "term_code", "courses", "total_hours")


@query("p10_membership_filter", "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus IN ('O', 'F')")
def membership_filter(spark, folder):
    orders = read_table(spark, "orders", folder)
    kept = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & F.col("o_orderstatus").isin("O", "F")
    return orders.where(kept).select("o_orderkey")


@query("p11_column_comparison", f"WITH {GRADED_SQL} SELECT event_id, obs FROM graded WHERE obs = pred")
def column_comparison(spark, folder):
    return graded_events(spark, folder).where(F.col("obs") == F.col("pred")).select("event_id", "obs")


@query(
    "p13_case_when",
    f"WITH {STUDENTS_SQL} SELECT band, CAST(count(*) AS BIGINT) AS n FROM students GROUP BY band",
)
def case_when(spark, folder):
    return students(spark, folder).groupBy("band").agg(F.count("*").alias("n"))


_INJECTED = "nullif(l_linenumber, 7)"


@query(
    "p14_null_test",
    f"SELECT CAST(CASE WHEN {_INJECTED} IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS present, CAST(count(*) AS BIGINT) AS n "
    "FROM lineitem GROUP BY 1",
)
def null_test(spark, folder):
    lines = read_table(spark, "lineitem", folder).withColumn("line", F.nullif("l_linenumber", F.lit(7)))
    present = F.when(F.col("line").isNotNull(), 1).otherwise(0).alias("present")
    return lines.groupBy(present).agg(F.count("*").alias("n"))


@query(
    "p15_fill_missing",
    f"WITH {REG_SQL},{AID_SQL},{TESTS_SQL},{FALL_SQL} SELECT f.row_key, round(coalesce(paid_amt, 0), 2) + 0.0 AS paid_amt, "
    "coalesce(took_sat, 0) AS took_sat FROM fall f LEFT JOIN aid a ON f.person_id = a.person_id AND f.term_code = a.term_code_fall "
    "LEFT JOIN tests t ON f.person_id = t.person_id",
)
def fill_missing(spark, folder):
    fall = fall_registrations(spark, folder).select("row_key", "person_id", "term_code")
    aid = aid_totals(spark, folder).withColumnRenamed("term_code_fall", "term_code")
    joined = fall.join(aid, ["person_id", "term_code"], "left").join(
        test_takers(spark, folder), "person_id", "left"
    )
    filled = fill(joined, paid_amt=0.0, took_sat=0.0)
    return filled.select("row_key", F.round("paid_amt", 2).alias("paid_amt"), "took_sat")


@query(
    "p17_constant_columns",
    "SELECT n_nationkey, 'nations' AS data, 1 AS took FROM nation",
)
def constant_columns(spark, folder):
    nation = read_table(spark, "nation", folder).select("n_nationkey")
    return nation.withColumns({"data": F.lit("nations"), "took": F.lit(1)})


@query(
    "p18_elementwise_paste",
    f"WITH {REG_SQL},{FALL_SQL} SELECT person_id || ',' || term_code AS to_check FROM fall",
)
def elementwise_paste(spark, folder):
    fall = fall_registrations(spark, folder)
    return fall.select(paste(F.col("person_id"), F.col("term_code"), sep=",").alias("to_check"))


# ---------------------------------------------------------------- joins

@query(
    "j1_left_join_two_keys",
    f"WITH {REG_SQL},{AID_SQL},{FALL_SQL} SELECT f.row_key, round(paid_amt, 2) + 0.0 AS paid_amt FROM fall f "
    "LEFT JOIN aid a ON f.person_id = a.person_id AND f.term_code = a.term_code_fall",
)
def left_join_two_keys(spark, folder):
    fall = fall_registrations(spark, folder).select("row_key", "person_id", "term_code")
    aid = aid_totals(spark, folder).withColumnRenamed("person_id", "aid_person")
    same = (F.col("person_id") == F.col("aid_person")) & (F.col("term_code") == F.col("term_code_fall"))
    return fall.join(aid, same, "left").select("row_key", F.round("paid_amt", 2).alias("paid_amt"))


@query(
    "j2_natural_left_join",
    f"WITH {REG_SQL},{TESTS_SQL},{FALL_SQL} SELECT f.row_key, f.person_id, took_sat FROM fall f LEFT JOIN tests t ON f.person_id = t.person_id",
)
def natural_left_join(spark, folder):
    fall = fall_registrations(spark, folder).select("row_key", "person_id")
    takers = test_takers(spark, folder)
    shared = [c for c in fall.columns if c in takers.columns]
    return fall.join(takers, shared, "left")


@query(
    "j3_fan_out_left_join",
    f"WITH {REG_SQL},{DEGREES_SQL},{FALL_SQL} SELECT f.row_key, f.person_id, grad_term FROM fall f LEFT JOIN degrees d ON f.person_id = d.person_id",
)
def fan_out_left_join(spark, folder):
    fall = fall_registrations(spark, folder).select("row_key", "person_id")
    return fall.join(degrees(spark, folder), "person_id", "left")


@query(
    "j4_full_outer_join",
    "WITH a AS (SELECT p_size AS k, CAST(count(*) AS BIGINT) AS parts FROM part WHERE p_type LIKE 'S%' GROUP BY 1), "
    "b AS (SELECT CAST(c_nationkey AS INTEGER) AS k, CAST(count(*) AS BIGINT) AS customers FROM customer GROUP BY 1) "
    "SELECT coalesce(a.k, b.k) AS k, parts, customers FROM a FULL JOIN b ON a.k = b.k",
)
def full_outer_join(spark, folder):
    parts = read_table(spark, "part", folder).where("p_type LIKE 'S%'").groupBy(
        F.col("p_size").alias("k")
    ).agg(F.count("*").alias("parts"))
    customers = read_table(spark, "customer", folder).groupBy(F.col("c_nationkey").alias("k")).agg(
        F.count("*").alias("customers")
    )
    return parts.join(customers, "k", "full")


@query(
    "j5_membership_flag",
    f"WITH {STUDENTS_SQL} SELECT row_key, retained FROM students",
)
def membership_flag(spark, folder):
    """Whether (person, term + 100) is among the registered pairs."""
    fall = fall_registrations(spark, folder)
    people = fall.where(F.col("sex").isin("O", "F")).withColumn(
        "next_term", (F.col("term_code").cast("int") + 100).cast("string")
    )
    later = fall_registrations(spark, folder, RETURN_TERM)
    flagged = member_flag(people, later, {"person_id": "person_id", "next_term": "term_code"}, "found")
    return flagged.select("row_key", F.when(F.col("found"), "TRUE").otherwise("FALSE").alias("retained"))


@query(
    "j6_row_lookup",
    "WITH t AS (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 2) "
    "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderkey IN (SELECT o_orderkey FROM t)",
)
def row_lookup(spark, folder):
    orders = read_table(spark, "orders", folder)
    wanted = top_rows(orders.select("o_orderkey", "o_totalprice"), F.col("o_totalprice"), 2, "o_orderkey")
    return lookup_rows(orders, wanted, "o_orderkey").select("o_orderkey", "o_custkey", "o_orderpriority")


# ---------------------------------------------------------------- aggregates

@query(
    "a1_grouped_sum",
    f"WITH {AID_SQL} SELECT person_id, term_code_fall, round(paid_amt, 2) + 0.0 AS paid_amt FROM aid",
)
def grouped_sum(spark, folder):
    totals = aid_totals(spark, folder)
    return totals.select("person_id", "term_code_fall", F.round("paid_amt", 2).alias("paid_amt"))


@query(
    "a1_grouped_sum_propagating_missing",
    f"SELECT l_returnflag, l_linestatus, l_suppkey, CASE WHEN count({_INJECTED}) = count(*) THEN CAST(sum({_INJECTED}) AS BIGINT) END AS total "
    "FROM lineitem GROUP BY 1, 2, 3",
)
def grouped_sum_missing(spark, folder):
    """A group with a missing value has a missing sum."""
    lines = read_table(spark, "lineitem", folder).withColumn("line", F.nullif("l_linenumber", F.lit(7)))
    return lines.groupBy("l_returnflag", "l_linestatus", "l_suppkey").agg(sum_missing("line").alias("total"))


@query("a2_count_by_key", f"WITH {GRADED_SQL} SELECT obs, pred, CAST(count(*) AS BIGINT) AS n FROM graded GROUP BY 1, 2")
def count_by_key(spark, folder):
    return graded_events(spark, folder).groupBy("obs", "pred").agg(F.count("*").alias("n"))


@query(
    "a3_share_of_total",
    "SELECT event_type, CAST(count(*) AS BIGINT) AS totals, round(count(*) / (SELECT count(*) FROM events), 6) + 0.0 AS class_wts FROM events GROUP BY 1",
)
def class_shares(spark, folder):
    counts = read_table(spark, "events", folder).groupBy("event_type").agg(F.count("*").alias("totals"))
    return share_of_total(counts, "totals", "class_wts").withColumn("class_wts", F.round("class_wts", 6))


@query("a4_distinct_keys", f"WITH {TESTS_SQL} SELECT person_id, took_sat FROM tests")
def distinct_keys(spark, folder):
    return test_takers(spark, folder)


@query("a5_min_max", "SELECT event_type, min(event_id) AS first, max(event_id) AS last FROM events GROUP BY 1")
def min_max(spark, folder):
    return read_table(spark, "events", folder).groupBy("event_type").agg(
        F.min("event_id").alias("first"), F.max("event_id").alias("last")
    )


@query(
    "a6_means",
    "SELECT l_returnflag, round(avg(l_discount), 6) + 0.0 AS mean, round(sum(l_discount * l_quantity) / sum(l_quantity), 6) + 0.0 AS weighted, "
    "round(sum(l_extendedprice) / sum(l_quantity), 4) + 0.0 AS ratio FROM lineitem GROUP BY 1",
)
def means(spark, folder):
    lines = read_table(spark, "lineitem", folder)
    return lines.groupBy("l_returnflag").agg(
        F.round(F.avg("l_discount"), 6).alias("mean"),
        F.round(F.try_divide(F.sum(F.col("l_discount") * F.col("l_quantity")), F.sum("l_quantity")), 6).alias("weighted"),
        F.round(F.try_divide(F.sum("l_extendedprice"), F.sum("l_quantity")), 4).alias("ratio"),
    )


@query(
    "a7_group_nest",
    "SELECT event_type, CAST(count(*) AS BIGINT) AS n, max(event_id) AS last_id, round(sum(value), 4) + 0.0 AS total FROM events GROUP BY 1",
)
def nested_groups(spark, folder):
    """Rows nested per group, in as many cells per group as asked for."""
    events = read_table(spark, "events", folder).select("event_id", "event_type", "value")
    nested = group_nest(events, ["event_type"], "event_id", cells=8)
    return nested.groupBy("event_type").agg(
        F.sum(F.size("data")).cast("long").alias("n"),
        F.max(F.array_max(F.transform("data", lambda r: r["event_id"]))).alias("last_id"),
        F.round(F.sum(F.aggregate("data", F.lit(0.0), lambda t, r: t + r["value"])), 4).alias("total"),
    )


@query("a8_unnest", "SELECT event_type, event_id, value FROM events")
def unnested_groups(spark, folder):
    events = read_table(spark, "events", folder).select("event_id", "event_type", "value")
    return unnest(group_nest(events, ["event_type"], "event_id", cells=8)).select(
        "event_type", "event_id", "value"
    )


@query(
    "a9_pivot_wider",
    "SELECT l_returnflag, CAST(sum(CASE WHEN l_linestatus = 'F' THEN l_quantity END) AS DOUBLE) AS F, "
    "CAST(sum(CASE WHEN l_linestatus = 'O' THEN l_quantity END) AS DOUBLE) AS O FROM lineitem GROUP BY 1",
)
def pivot_wider(spark, folder):
    lines = read_table(spark, "lineitem", folder)
    long = lines.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("q"))
    return long.groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).agg(F.first("q"))


# ---------------------------------------------------------------- ordering and limits

@query("w1_first_rows", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 5")
def first_rows(spark, folder):
    return read_table(spark, "orders", folder).orderBy("o_orderkey").limit(5).select("o_orderkey", "o_custkey")


@query(
    "w2_top_absolute",
    "SELECT o_orderkey, round(o_totalprice - 250000, 2) + 0.0 AS residual FROM orders ORDER BY abs(o_totalprice - 250000) DESC, o_orderkey LIMIT 2",
)
def top_absolute(spark, folder):
    rows = read_table(spark, "orders", folder).select(
        "o_orderkey", F.round(F.col("o_totalprice") - 250000, 2).alias("residual")
    )
    return top_rows(rows, F.abs("residual"), 2, "o_orderkey")


@query(
    "w3_top_signed",
    "SELECT o_orderkey, round(o_totalprice - 250000, 2) + 0.0 AS residual FROM orders ORDER BY o_totalprice - 250000 DESC, o_orderkey LIMIT 2",
)
def top_signed(spark, folder):
    rows = read_table(spark, "orders", folder).select(
        "o_orderkey", F.round(F.col("o_totalprice") - 250000, 2).alias("residual")
    )
    return top_rows(rows, F.col("residual"), 2, "o_orderkey")


@query(
    "w4_contiguous_blocks",
    "SELECT event_id, 'Fold' || lpad(CAST(ntile(10) OVER (ORDER BY event_id) AS VARCHAR), 2, '0') AS resample FROM events",
)
def contiguous_blocks(spark, folder):
    """Ten blocks in row order without a global window."""
    events = read_table(spark, "events", folder).select("event_id")
    n = events.count()
    block = block_number(F.col("position"), F.lit(n), 10)
    return positions(events, "event_id").select(
        "event_id", F.concat(F.lit("Fold"), F.lpad(block.cast("string"), 2, "0")).alias("resample")
    )


@query(
    "w5_reorder_levels",
    "SELECT p_type AS level, CAST(row_number() OVER (ORDER BY avg(p_retailprice), p_type) AS INTEGER) AS by_mean, "
    "CAST(row_number() OVER (ORDER BY min(p_partkey), p_type) AS INTEGER) AS by_first FROM part GROUP BY p_type",
)
def reorder_levels(spark, folder):
    """Levels by mean and by first appearance."""
    part = read_table(spark, "part", folder).withColumnRenamed("p_type", "level")
    by_mean = ordered_levels(part, "level", F.avg("p_retailprice")).select("level", F.col("order").alias("by_mean"))
    by_first = ordered_levels(part, "level", F.min("p_partkey")).select("level", F.col("order").alias("by_first"))
    return by_mean.join(by_first, "level")


@query(
    "w5_reorder_by_median",
    "SELECT p_type AS level, CAST(row_number() OVER (ORDER BY median(p_retailprice), p_type) AS INTEGER) AS by_median FROM part GROUP BY p_type",
)
def reorder_by_median(spark, folder):
    """Levels by the median of a column, the usual order of a plot."""
    part = read_table(spark, "part", folder).withColumnRenamed("p_type", "level")
    return ordered_levels(part, "level", median_of="p_retailprice").select("level", F.col("order").alias("by_median"))


@query(
    "w4_positions_of_text_keys",
    "SELECT c_custkey, row_number() OVER (ORDER BY c_mktsegment, c_name, c_custkey) AS position FROM customer",
)
def positions_of_text_keys(spark, folder):
    """Positions in the order of several columns of text and numbers."""
    customer = read_table(spark, "customer", folder).select("c_mktsegment", "c_name", "c_custkey")
    return positions(customer, ["c_mktsegment", "c_name", "c_custkey"]).select("c_custkey", "position")


@query(
    "w7_random_rows",
    f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {hash_sql(42, 'o_orderkey')}, o_orderkey LIMIT 500",
)
def random_rows(spark, folder):
    """A sample of 500 rows: a top-k on the row hash, so no full sort."""
    orders = read_table(spark, "orders", folder).select("o_orderkey", "o_totalprice")
    return orders.orderBy(hash01(42, "o_orderkey"), "o_orderkey").limit(500)


# ---------------------------------------------------------------- stacking

@query(
    "u1_append_rows",
    "SELECT n_nationkey AS key, n_name AS name, CAST(NULL AS DOUBLE) AS balance FROM nation UNION ALL "
    "SELECT CAST(s_suppkey AS INTEGER), s_name, s_acctbal FROM supplier",
)
def append_rows(spark, folder):
    nation = read_table(spark, "nation", folder).select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))
    supplier = read_table(spark, "supplier", folder).select(
        F.col("s_suppkey").cast("int").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")
    )
    return nation.unionByName(supplier, allowMissingColumns=True)


@query(
    "u2_map_and_stack",
    " UNION ALL ".join(
        f"SELECT '{c}' AS predictor, round(avg({c}), 4) + 0.0 AS mean, round(stddev_samp({c}), 4) + 0.0 AS sd FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ),
)
def map_and_stack(spark, folder):
    """One statistic of many columns, in one pass rather than a job per column."""
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    lines = read_table(spark, "lineitem", folder).select(*names)
    wide = lines.agg(*[F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("sd")).alias(c) for c in names])
    rows = [
        F.struct(F.lit(c).alias("predictor"), F.round(f"{c}.mean", 4).alias("mean"), F.round(f"{c}.sd", 4).alias("sd"))
        for c in names
    ]
    return wide.select(F.inline(F.array(*rows)))


# ---------------------------------------------------------------- scalar functions

@query(
    "x1_x2_text_ends",
    "SELECT p_partkey, right(p_brand, 2) AS last_two, left(p_name, 1) AS first_one FROM part",
)
def text_ends(spark, folder):
    part = read_table(spark, "part", folder)
    return part.select(
        "p_partkey",
        last_chars(F.col("p_brand"), 2).alias("last_two"),
        first_chars(F.col("p_name"), 1).alias("first_one"),
    )


@query("x3_remove_prefix", "SELECT s_suppkey AS suppkey, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal FROM supplier")
def remove_prefix(spark, folder):
    return strip_prefix(read_table(spark, "supplier", folder), "s_")


@query("x4_remove_all", "SELECT p_partkey, regexp_replace(p_brand, '[a-z#]', '', 'g') AS short FROM part")
def remove_all_matches(spark, folder):
    part = read_table(spark, "part", folder)
    return part.select("p_partkey", remove_all(F.col("p_brand"), "[a-z#]").alias("short"))


@query(
    "x5_paste",
    f"SELECT l_orderkey, l_partkey, l_suppkey, coalesce(CAST({_INJECTED} AS VARCHAR), 'NA') || ',' || l_returnflag AS label FROM lineitem",
)
def paste_values(spark, folder):
    lines = read_table(spark, "lineitem", folder).withColumn("line", F.nullif("l_linenumber", F.lit(7)))
    return lines.select(
        "l_orderkey", "l_partkey", "l_suppkey", paste(F.col("line"), F.col("l_returnflag"), sep=",").alias("label")
    )


@query(
    "x6_casts",
    f"WITH {REG_SQL} SELECT row_key, CAST(term_code AS INTEGER) AS term, CAST(person_id AS VARCHAR) AS person FROM reg",
)
def casts(spark, folder):
    rows = strip_prefix(registrations(spark, folder), "reg_")
    return rows.select(
        "row_key", F.try_to_number("term_code", F.lit("999999")).cast("int").alias("term"),
        F.col("person_id").cast("string").alias("person"),
    )


@query(
    "x7_factor_levels",
    "SELECT o_orderpriority AS level, CAST(row_number() OVER (ORDER BY o_orderpriority) AS INTEGER) AS code FROM (SELECT DISTINCT o_orderpriority FROM orders)",
)
def factor_levels(spark, folder):
    return levels_table(read_table(spark, "orders", folder), "o_orderpriority")


@query("x8_round_half_even", "SELECT l_orderkey, l_partkey, l_suppkey, round_even(l_quantity / 2, 0) AS half FROM lineitem")
def round_half_even(spark, folder):
    lines = read_table(spark, "lineitem", folder)
    return lines.select("l_orderkey", "l_partkey", "l_suppkey", F.bround(F.col("l_quantity") / 2, 0).alias("half"))


@query(
    "x9_arithmetic",
    "SELECT l_orderkey, l_partkey, l_suppkey, round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6) + 0.0 AS charge, "
    "CAST(((l_linenumber - 4) % 3 + 3) % 3 AS INTEGER) AS modulo, round(l_extendedprice / nullif(l_tax, 0), 2) + 0.0 AS per_tax FROM lineitem",
)
def arithmetic(spark, folder):
    """Modulo takes the divisor's sign; division by zero is missing."""
    lines = read_table(spark, "lineitem", folder)
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return lines.select(
        "l_orderkey", "l_partkey", "l_suppkey",
        F.round(charge, 6).alias("charge"),
        F.pmod(F.col("l_linenumber") - 4, F.lit(3)).alias("modulo"),
        F.round(F.try_divide("l_extendedprice", "l_tax"), 2).alias("per_tax"),
    )


@query(
    "x10_logarithms",
    "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN round(log10(c_acctbal), 6) + 0.0 END AS log_balance, "
    "CASE WHEN c_acctbal + 1 > 0 THEN round(log10(c_acctbal + 1), 6) + 0.0 END AS log_offset, "
    "round(pow(10, c_nationkey / 10.0::DOUBLE), 6) + 0.0 AS power FROM customer",
)
def logarithms(spark, folder):
    customer = read_table(spark, "customer", folder)
    balance = F.col("c_acctbal")
    return customer.select(
        "c_custkey",
        F.when(balance > 0, F.round(F.log10(balance), 6)).alias("log_balance"),
        F.when(balance + 1 > 0, F.round(F.log10(balance + 1), 6)).alias("log_offset"),
        F.round(F.pow(F.lit(10.0), F.col("c_nationkey") / 10.0), 6).alias("power"),
    )


@query("x11_absolute", "SELECT s_suppkey, abs(s_acctbal - 5000) AS gap FROM supplier")
def absolute(spark, folder):
    supplier = read_table(spark, "supplier", folder)
    return supplier.select("s_suppkey", F.abs(F.col("s_acctbal") - 5000).alias("gap"))


@query(
    "x12_comparisons",
    f"SELECT l_returnflag, CAST(count(*) FILTER (WHERE {_INJECTED} IS NULL) AS BIGINT) AS missing, "
    "CAST(count(*) FILTER (WHERE l_linestatus = 'O' AND l_tax <> 0) AS BIGINT) AS taxed FROM lineitem GROUP BY 1",
)
def comparisons(spark, folder):
    lines = read_table(spark, "lineitem", folder).withColumn("line", F.nullif("l_linenumber", F.lit(7)))
    taxed = (F.col("l_linestatus") == "O") & (F.col("l_tax") != 0)
    return lines.groupBy("l_returnflag").agg(
        F.count_if(F.col("line").isNull()).alias("missing"), F.count_if(taxed).alias("taxed")
    )


@query(
    "x13_aggregates",
    "SELECT l_linestatus, min(l_quantity) AS lo, max(l_quantity) AS hi, round(avg(l_quantity), 6) + 0.0 AS mean, sum(l_quantity) AS total FROM lineitem GROUP BY 1",
)
def aggregates(spark, folder):
    return read_table(spark, "lineitem", folder).groupBy("l_linestatus").agg(
        F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi"),
        F.round(F.avg("l_quantity"), 6).alias("mean"), F.sum("l_quantity").alias("total"),
    )


@query(
    "x14_sequences",
    "SELECT p_partkey, unnest(range(1, p_size % 3 + 2)) AS x, 'r' || 'r' AS twice FROM part",
)
def sequences(spark, folder):
    """An integer range per row and a repeated value."""
    part = read_table(spark, "part", folder)
    return part.select(
        "p_partkey",
        F.explode(F.sequence(F.lit(1).cast("long"), (F.col("p_size") % 3 + 1).cast("long"))).alias("x"),
        F.array_join(F.array_repeat(F.lit("r"), 2), "").alias("twice"),
    )


# ---------------------------------------------------------------- user functions

@query(
    "z1_table_function",
    "SELECT l_returnflag, min(l_extendedprice) AS first, max(l_extendedprice) AS last FROM lineitem GROUP BY 1",
)
def table_function(spark, folder):
    """A user function from frame to frame."""

    def data_range(df):
        return df.groupBy("l_returnflag").agg(
            F.min("l_extendedprice").alias("first"), F.max("l_extendedprice").alias("last")
        )

    return read_table(spark, "lineitem", folder).transform(data_range)


@query(
    "z3_rename_function",
    "SELECT r_regionkey AS R_REGIONKEY_UP, r_name AS R_NAME_UP FROM region",
)
def rename_function(spark, folder):
    from foldspark.functions.text import rename_all

    return rename_all(read_table(spark, "region", folder), lambda c: f"{c.upper()}_UP")

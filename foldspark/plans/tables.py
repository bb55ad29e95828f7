"""Analysis tables over the test data, with the same tables in SQL.

``students`` is the enrolment table: one row per person and fall term with aid
payments, a test flag, a retention flag and a grade band. ``sales`` is a property
table with a price, a numeric size and nominal district and style.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from foldspark.functions.text import first_chars, last_chars, strip_prefix
from foldspark.sources.tables import read_table

# the registrations students can return in reach one year beyond the students
FIRST_TERM, LAST_TERM, RETURN_TERM = "199400", "200024", "200124"


def term_code(date: Column) -> Column:
    """YYYY20 from July on, YYYY10 before."""
    return (F.year(date) * 100 + F.when(F.month(date) >= 7, 20).otherwise(10)).cast("string")


# ---------------------------------------------------------------- raw tables

def registrations(spark: SparkSession, folder: str) -> DataFrame:
    """One row per person and registration, with prefixed names as delivered."""
    orders = read_table(spark, "orders", folder)
    customer = read_table(spark, "customer", folder)
    lines = read_table(spark, "lineitem", folder)
    hours = lines.groupBy("l_orderkey").agg(
        F.count("*").alias("reg_courses"),
        F.sum("l_quantity").alias("reg_total_hours"),
        F.sum(F.when(F.col("l_returnflag") == "N", F.col("l_quantity")).otherwise(0.0)).alias("reg_day_hours"),
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0)).alias("reg_eve_hours"),
        F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity")).otherwise(0.0)).alias("reg_off_hours"),
    )
    people = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return people.join(hours, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").alias("reg_row_key"),
        F.col("o_custkey").alias("reg_person_id"),
        F.col("o_orderdate").alias("reg_date"),
        term_code(F.col("o_orderdate")).alias("reg_term_code"),
        F.col("o_orderstatus").alias("reg_sex"),
        (F.col("o_totalprice") / 125000).alias("reg_gpa"),
        (F.col("c_acctbal") + 1100).alias("reg_age"),
        F.col("c_nationkey").cast("string").alias("reg_zip"),
        F.col("o_orderpriority").alias("reg_load"),
        "reg_courses",
        "reg_total_hours",
        "reg_day_hours",
        "reg_eve_hours",
        "reg_off_hours",
    )


REG_SQL = """
hours AS (
  SELECT l_orderkey, CAST(count(*) AS BIGINT) AS courses, sum(l_quantity) AS total_hours,
         sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS day_hours,
         sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS eve_hours,
         sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS off_hours
  FROM lineitem GROUP BY l_orderkey),
reg AS (
  SELECT o_orderkey AS row_key, o_custkey AS person_id,
         CAST(year(o_orderdate) * 100 + CASE WHEN month(o_orderdate) >= 7 THEN 20 ELSE 10 END AS VARCHAR) AS term_code,
         o_orderstatus AS sex, o_totalprice / 125000 AS gpa, c_acctbal + 1100 AS age,
         CAST(c_nationkey AS VARCHAR) AS zip, o_orderpriority AS load,
         courses, total_hours, day_hours, eve_hours, off_hours
  FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN hours ON o_orderkey = l_orderkey)"""


def aid_payments(spark: SparkSession, folder: str) -> DataFrame:
    """Single payments; a person has many in a term."""
    lines = read_table(spark, "lineitem", folder).where("l_returnflag = 'R'")
    orders = read_table(spark, "orders", folder).where(F.col("o_orderdate") >= "1995-01-01")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.col("o_custkey").alias("aid_person_id"),
        (F.year("o_orderdate") * 100 + 20).cast("string").alias("aid_term_code_fall"),
        F.col("l_extendedprice").alias("aid_paid_amt"),
    )


AID_SQL = """
aid AS (
  SELECT o_custkey AS person_id, CAST(year(o_orderdate) * 100 + 20 AS VARCHAR) AS term_code_fall,
         sum(l_extendedprice) AS paid_amt
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE l_returnflag = 'R' AND o_orderdate >= TIMESTAMP '1995-01-01' GROUP BY 1, 2)"""


def aid_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Payments summed before any join, so the key on this side is unique."""
    payments = strip_prefix(aid_payments(spark, folder), "aid_")
    return payments.groupBy("person_id", "term_code_fall").agg(F.sum("paid_amt").alias("paid_amt"))


def test_takers(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct people with a score of the listed tests."""
    orders = read_table(spark, "orders", folder)
    taken = orders.where(F.col("o_orderpriority").isin("1-URGENT"))
    return taken.select(F.col("o_custkey").alias("person_id")).distinct().withColumn("took_sat", F.lit(1.0))


TESTS_SQL = """
tests AS (SELECT DISTINCT o_custkey AS person_id, 1.0::DOUBLE AS took_sat FROM orders WHERE o_orderpriority IN ('1-URGENT'))"""


def degrees(spark: SparkSession, folder: str) -> DataFrame:
    """Degrees awarded; a person may have several."""
    orders = read_table(spark, "orders", folder)
    return orders.where("o_orderstatus = 'P' AND o_orderpriority = '5-LOW'").select(
        F.col("o_custkey").alias("person_id"), term_code(F.col("o_orderdate")).alias("grad_term")
    )


DEGREES_SQL = """
degrees AS (
  SELECT o_custkey AS person_id,
         CAST(year(o_orderdate) * 100 + CASE WHEN month(o_orderdate) >= 7 THEN 20 ELSE 10 END AS VARCHAR) AS grad_term
  FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW')"""


# ---------------------------------------------------------------- analysis tables

def fall_registrations(spark: SparkSession, folder: str, last: str | None = None) -> DataFrame:
    """Registrations of fall terms between the first term and ``last`` (by default the last of the students)."""
    last = last or LAST_TERM
    raw = registrations(spark, folder)
    kept = raw.where(
        # the years of the two terms, as a date range the scan can use to skip row groups
        (F.col("reg_date") >= f"{FIRST_TERM[:4]}-01-01")
        & (F.col("reg_date") < f"{int(last[:4]) + 1}-01-01")
        & (F.col("reg_term_code") > FIRST_TERM)
        & (F.col("reg_term_code") < last)
        & (last_chars(F.col("reg_term_code"), 2) == "20")
        & (F.col("reg_courses") > 0)
        & (F.col("reg_total_hours") > 0)
    )
    return strip_prefix(kept.drop("reg_date"), "reg_")


FALL_SQL = f"""
fall AS (SELECT * FROM reg WHERE term_code > '{FIRST_TERM}' AND term_code < '{LAST_TERM}'
         AND right(term_code, 2) = '20' AND courses > 0 AND total_hours > 0)"""


def students(spark: SparkSession, folder: str) -> DataFrame:
    """The analysis table: filter, two left joins, fill, flag, band."""
    fall = fall_registrations(spark, folder)
    aid = aid_totals(spark, folder).withColumnRenamed("term_code_fall", "term_code")
    joined = (
        fall.where(F.col("sex").isin("O", "F"))
        .join(aid, ["person_id", "term_code"], "left")
        .join(test_takers(spark, folder), "person_id", "left")
        .fillna({"paid_amt": 0.0, "took_sat": 0.0})
    )
    # one year later the same person is back: a join on distinct keys, not a collected list
    back = fall_registrations(spark, folder, RETURN_TERM).select(
        "person_id",
        (F.col("term_code").cast("int") - 100).cast("string").alias("term_code"),
    ).distinct().withColumn("__back", F.lit(True))
    flagged = joined.join(back, ["person_id", "term_code"], "left")
    return flagged.withColumns(
        {
            "retained": F.when(F.col("__back"), "TRUE").otherwise("FALSE"),
            "band": F.when(F.col("gpa") > 3.5, "3.51-4.00")
            .when(F.col("gpa") > 2, "2.01-3.50")
            .otherwise("0.00-2.00"),
        }
    ).drop("__back")


STUDENTS_SQL = f"""{REG_SQL},{AID_SQL},{TESTS_SQL},{FALL_SQL},
later AS (SELECT * FROM reg WHERE term_code > '{FIRST_TERM}' AND term_code < '{RETURN_TERM}'
          AND right(term_code, 2) = '20' AND courses > 0 AND total_hours > 0),
back AS (SELECT DISTINCT person_id, CAST(CAST(term_code AS INTEGER) - 100 AS VARCHAR) AS term_code FROM later),
students AS (
  SELECT f.*, coalesce(a.paid_amt, 0) AS paid_amt, coalesce(t.took_sat, 0) AS took_sat,
         CASE WHEN b.person_id IS NOT NULL THEN 'TRUE' ELSE 'FALSE' END AS retained,
         CASE WHEN gpa > 3.5 THEN '3.51-4.00' WHEN gpa > 2 THEN '2.01-3.50' ELSE '0.00-2.00' END AS band
  FROM fall f
  LEFT JOIN aid a ON f.person_id = a.person_id AND f.term_code = a.term_code_fall
  LEFT JOIN tests t ON f.person_id = t.person_id
  LEFT JOIN back b ON f.person_id = b.person_id AND f.term_code = b.term_code
  WHERE f.sex IN ('O', 'F'))"""


def sales(spark: SparkSession, folder: str) -> DataFrame:
    """Property sales: a price that depends on the living area, and nominal columns."""
    orders = read_table(spark, "orders", folder)
    customer = read_table(spark, "customer", folder)
    area = F.col("c_acctbal") + 1100
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("sale_key"),
        F.log10(F.col("o_totalprice") + 25 * area).alias("price"),
        area.alias("area"),
        F.concat(F.lit("D"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("district"),
        F.col("c_mktsegment").alias("style"),
        F.year("o_orderdate").cast("double").alias("year_built"),
        (F.col("o_custkey") % 1000 / 1000.0).alias("latitude"),
        (F.col("o_orderkey") % 977 / 977.0).alias("longitude"),
    )


SALES_SQL = """
sales AS (
  SELECT o_orderkey AS sale_key, log10(o_totalprice + 25 * (c_acctbal + 1100)) AS price,
         c_acctbal + 1100 AS area, 'D' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS district,
         c_mktsegment AS style, CAST(year(o_orderdate) AS DOUBLE) AS year_built,
         (o_custkey % 1000) / 1000.0::DOUBLE AS latitude, (o_orderkey % 977) / 977.0::DOUBLE AS longitude
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def graded_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with five class scores, the class they pick and a two-class truth.

    The scores depend on the value and the user, so they are partly right.
    """
    events = read_table(spark, "events", folder)
    kinds = EVENT_LEVELS
    spread = [
        F.round(F.pmod(F.col("event_id") * (7 + 6 * i) + F.col("user_id") * 3, F.lit(101)) / 101.0, 2)
        + F.when(F.col("event_type") == kind, 0.3).otherwise(0.0)
        for i, kind in enumerate(kinds)
    ]
    scored = events.select(
        "event_id", "user_id", "value", F.col("event_type").alias("obs"),
        *[s.alias(f"s_{k}") for s, k in zip(spread, kinds)],
    )
    best = F.greatest(*[F.col(f"s_{k}") for k in kinds])
    chain = F.lit(None).cast("string")
    for kind in reversed(kinds):
        chain = F.when(F.col(f"s_{kind}") == best, kind).otherwise(chain)
    return scored.withColumn("pred", chain)


EVENT_LEVELS = ["click", "error", "purchase", "signup", "view"]
_SCORES = ", ".join(
    f"round(((event_id * {7 + 6 * i} + user_id * 3) % 101) / 101.0::DOUBLE, 2)"
    f" + CASE WHEN event_type = '{k}' THEN 0.3 ELSE 0.0 END::DOUBLE AS s_{k}"
    for i, k in enumerate(EVENT_LEVELS)
)
_BEST = "greatest(" + ", ".join(f"s_{k}" for k in EVENT_LEVELS) + ")"
GRADED_SQL = (
    f"scored AS (SELECT event_id, user_id, value, event_type AS obs, {_SCORES} FROM events),\n"
    "graded AS (SELECT *, CASE "
    + " ".join(f"WHEN s_{k} = {_BEST} THEN '{k}'" for k in EVENT_LEVELS)
    + " END AS pred FROM scored)"
)


def label_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Two binary columns as truth and estimate, and a score with many ties."""
    labels = read_table(spark, "labels", folder)
    return labels.select(
        "doc_id",
        F.when(F.col("quality") == 1, "Class1").otherwise("Class2").alias("truth"),
        F.when(F.col("toxic") == 0, "Class1").otherwise("Class2").alias("predicted"),
        (F.pmod(F.col("doc_id") * 13, F.lit(41)) / 41.0 + F.col("quality") * 0.25).alias("score"),
    )


LABELS_SQL = """
pairs AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'Class1' ELSE 'Class2' END AS truth,
                 CASE WHEN toxic = 0 THEN 'Class1' ELSE 'Class2' END AS predicted,
                 ((doc_id * 13) % 41) / 41.0::DOUBLE + quality * 0.25::DOUBLE AS score FROM labels)"""

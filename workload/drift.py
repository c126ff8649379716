"""Schema drift: orders as files whose line items are fields; order variants to merge."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType, LongType, StringType, StructField, StructType,
)

from headway.operators import drift
from workload.tables import table

C = F.col
_TYPES = ["int32", "int64", "double", "string"]


def _type(index):
    return F.get(F.array(*map(F.lit, _TYPES)), (index % 4).cast("int"))


def _observed(spark, sf_dir):
    """File = order, field = line number; type and nullability of the smallest part."""
    return table(spark, sf_dir, "lineitem").groupBy(
        C("l_orderkey").alias("file"), F.concat(F.lit("f"), C("l_linenumber")).alias("name")
    ).agg(_type(F.min("l_partkey")).alias("type"), (F.min("l_partkey") % 10 != 0).alias("nullable"))


def _registry(spark, sf_dir):
    """Five known fields, one per region."""
    return table(spark, sf_dir, "region").select(
        F.concat(F.lit("f"), C("r_regionkey") + 1).alias("name"),
        _type(C("r_regionkey")).alias("type"), F.lit(True).alias("nullable"))


def _classified(spark, sf_dir):
    return drift.classify_drift(_registry(spark, sf_dir), _observed(spark, sf_dir), ["file"])


def drift_classify(spark, sf_dir):
    return _classified(spark, sf_dir)[1]


def drift_changes(spark, sf_dir):
    return _classified(spark, sf_dir)[0]


def drift_summary(spark, sf_dir):
    return drift.drift_summary(_classified(spark, sf_dir)[0], ["file"])


def first_drift(spark, sf_dir):
    """First and last breaking file per order day."""
    verdicts = _classified(spark, sf_dir)[1].join(
        table(spark, sf_dir, "orders").select(
            C("o_orderkey").alias("file"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")), "file")
    return drift.breaking_days(verdicts, ["day"], "file")


def schema_diff(spark, sf_dir):
    """Smallest against largest part of every field over all files."""
    items = table(spark, sf_dir, "lineitem").withColumn(
        "name", F.concat_ws("-", F.lit("f"), C("l_linenumber"), C("l_suppkey")))
    old = items.filter("l_returnflag <> 'A'").groupBy("name").agg(_type(F.min("l_partkey")).alias("type"))
    new = items.filter("l_returnflag <> 'R'").groupBy("name").agg(_type(F.max("l_partkey")).alias("type"))
    return drift.schema_diff(old, new)


ORDER_REGISTRY = StructType([
    StructField("o_orderkey", LongType()), StructField("o_custkey", LongType()),
    StructField("o_totalprice", DoubleType()), StructField("o_orderpriority", StringType())])


def concat_promote(spark, sf_dir):
    """Orders in three variants: as registered without customer, with a new column, and
    with the price as text that does not always parse."""
    orders = table(spark, sf_dir, "orders")
    plain = orders.filter("o_orderkey % 3 = 0").select("o_orderkey", "o_totalprice", "o_orderpriority")
    wider = orders.filter("o_orderkey % 3 = 1").select(
        C("o_orderkey").cast("int").alias("o_orderkey"), "o_custkey", "o_totalprice",
        "o_orderpriority", C("o_orderstatus").alias("extra"))
    text = orders.filter("o_orderkey % 3 = 2").select(
        "o_orderkey", "o_custkey", F.when(C("o_orderstatus") == "F", "n/a").otherwise(
            C("o_totalprice").cast("string")).alias("o_totalprice"), "o_orderpriority")
    merged = drift.union_drifted([plain, wider, text], ORDER_REGISTRY)
    return merged.withColumn("rescued", C(drift.RESCUED)["o_totalprice"]).drop(drift.RESCUED)


QUERIES = {
    "drift_classify": drift_classify,
    "drift_changes": drift_changes,
    "drift_summary": drift_summary,
    "first_drift": first_drift,
    "schema_diff": schema_diff,
    "concat_promote": concat_promote,
}

_PICK = "['int32', 'int64', 'double', 'string'][({k} % 4)::INTEGER + 1]"
_DRIFT = f"""observed AS (SELECT l_orderkey AS file, 'f' || l_linenumber AS name,
        {_PICK.format(k='min(l_partkey)')} AS type, min(l_partkey) % 10 <> 0 AS nullable
        FROM lineitem GROUP BY 1, 2),
    registry AS (SELECT 'f' || (r_regionkey + 1) AS name, {_PICK.format(k='r_regionkey')} AS type,
        true AS nullable FROM region),
    pairs AS (SELECT f.file, r.* FROM (SELECT DISTINCT file FROM observed) f CROSS JOIN registry r),
    both_sides AS (SELECT coalesce(o.file, p.file) AS file, coalesce(o.name, p.name) AS name,
        p.type AS old_type, o.type AS new_type, p.nullable AS old_nullable, o.nullable AS new_nullable
        FROM observed o FULL JOIN pairs p ON p.file = o.file AND p.name = o.name),
    changes AS (
        SELECT *, 'added' AS change FROM both_sides WHERE old_type IS NULL
        UNION ALL SELECT *, 'removed' FROM both_sides WHERE new_type IS NULL
        UNION ALL SELECT *, 'type' FROM both_sides WHERE old_type <> new_type AND (old_type, new_type)
            NOT IN (('int32', 'int64'), ('int32', 'double'), ('int64', 'double'))
        UNION ALL SELECT *, 'nullability' FROM both_sides WHERE old_nullable <> new_nullable),
    verdicts AS (SELECT file, CASE WHEN bool_or(change IN ('removed', 'type', 'nullability'))
        THEN 'breaking' WHEN bool_or(change = 'added') THEN 'additive' ELSE 'none' END AS drift_type
        FROM (SELECT file, change FROM changes UNION ALL SELECT file, NULL FROM observed) GROUP BY 1)"""
_LIST = "coalesce(string_agg({item}, ',' ORDER BY name) FILTER (change = '{kind}'), '')"

ORACLE = {
    "drift_classify": f"WITH {_DRIFT} SELECT * FROM verdicts",
    "drift_changes": f"WITH {_DRIFT} SELECT * FROM changes",
    "drift_summary": f"""WITH {_DRIFT} SELECT file, '{{"breaking_fields":[' ||
        {_LIST.format(kind='type', item=
            '''printf('{"name":"%s","old_type":"%s","new_type":"%s"}', name, old_type, new_type)''')}
        || '],"removed_fields":[' || {_LIST.format(kind='removed', item="'\"' || name || '\"'")}
        || '],"nullability_changes":[' || {_LIST.format(kind='nullability', item=
            '''printf('{"name":"%s","old_nullable":%s,"new_nullable":%s}', name,
                old_nullable::VARCHAR, new_nullable::VARCHAR)''')}
        || ']}}' AS drift_summary FROM changes GROUP BY 1""",
    "first_drift": f"""WITH {_DRIFT} SELECT strftime(o_orderdate, '%Y-%m-%d') AS day,
        arg_min(file, file) AS alert_on, arg_max(file, file) AS annotate_with,
        count(*) AS breaking_files FROM verdicts JOIN orders ON o_orderkey = file
        WHERE drift_type = 'breaking' GROUP BY 1""",
    "schema_diff": f"""WITH items AS (SELECT *, 'f-' || l_linenumber || '-' || l_suppkey AS name
            FROM lineitem),
        old AS (SELECT name, {_PICK.format(k='min(l_partkey)')} AS type FROM items
            WHERE l_returnflag <> 'A' GROUP BY 1),
        new AS (SELECT name, {_PICK.format(k='max(l_partkey)')} AS type FROM items
            WHERE l_returnflag <> 'R' GROUP BY 1),
        gone AS (SELECT * FROM old EXCEPT SELECT * FROM new),
        come AS (SELECT * FROM new EXCEPT SELECT * FROM old)
        SELECT coalesce(g.name, c.name) AS name, g.type AS old_type, c.type AS new_type
        FROM gone g FULL JOIN come c ON g.name = c.name""",
    "concat_promote": """SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_custkey END AS o_custkey,
        CASE WHEN o_orderkey % 3 < 2 OR o_orderstatus <> 'F' THEN o_totalprice END AS o_totalprice,
        o_orderpriority, CASE WHEN o_orderkey % 3 = 1 THEN o_orderstatus END AS extra,
        CASE WHEN o_orderkey % 3 = 2 AND o_orderstatus = 'F' THEN 'n/a' END AS rescued FROM orders""",
}

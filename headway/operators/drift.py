"""Schema drift: classification against a registry and drift-safe union.

Field tables carry ``name, type, nullable`` with Arrow type names.  An instant is
compared without its zone label, which says nothing about the value.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from headway.functions.status import is_widening

# Arrow names of the Spark types in use.
ARROW_NAMES = {
    "tinyint": "int8", "smallint": "int16", "int": "int32", "bigint": "int64",
    "float": "float", "double": "double", "string": "string", "boolean": "bool",
    "timestamp": "timestamp[us]", "timestamp_ntz": "timestamp[us]",
}
BREAKING = ("removed", "type", "nullability")
RESCUED = "_rescued"


def schema_fields(spark: SparkSession, schema: StructType, **labels: str) -> DataFrame:
    """A schema as a field table, with constant label columns."""
    rows = [(f.name, ARROW_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString()),
             f.nullable) for f in schema]
    fields = spark.createDataFrame(rows, "name string, type string, nullable boolean")
    return fields.withColumns({k: F.lit(v) for k, v in labels.items()})


def without_zone(type_name: Column) -> Column:
    return F.regexp_replace(type_name, r"^(timestamp\[\w+), tz=[^\]]*\]$", "$1]")


def _matched(registry: DataFrame, observed: DataFrame, on: Sequence[str]) -> DataFrame:
    old = registry.select(*on, "name", without_zone(F.col("type")).alias("old_type"),
                          F.col("nullable").alias("old_nullable"), F.lit(True).alias("known"))
    new = observed.withColumns({"new_type": without_zone(F.col("type")),
                                "new_nullable": F.col("nullable")}).drop("type", "nullable")
    return new.join(old, [*on, "name"], "left")


def field_changes(registry: DataFrame, observed: DataFrame, by: Sequence[str],
                  on: Sequence[str] = ()) -> DataFrame:
    """One row per changed field of each observed schema, plus a NULL-change row per
    unchanged field.

    ``by`` identifies an observed schema (dataset, file …), ``on`` the part of it
    that selects the registry entry.  Removed fields come from the registry's
    field list minus the names seen, so no schema is paired with every field.
    """
    by, on = list(by), list(on)
    matched = _matched(registry, observed, on)
    same_width = ~F.col("old_type").eqNullSafe(F.col("new_type")) & ~is_widening(
        F.col("old_type"), F.col("new_type"))
    known = F.col("known").isNotNull()
    found = F.array_compact(F.array(
        F.when(~known, F.lit("added")),
        F.when(known & same_width, F.lit("type")),
        F.when(known & (F.col("old_nullable") != F.col("new_nullable")), F.lit("nullability"))))
    present = matched.select(
        *by, "name", F.explode_outer(found).alias("change"),
        "old_type", "new_type", "old_nullable", "new_nullable")

    # At most as many names as the registry entry has fields.
    seen = matched.groupBy(*by).agg(F.collect_set(F.when(known, F.col("name"))).alias("seen"))
    entry = registry.groupBy(*on).agg(F.collect_list(F.struct(
        "name", without_zone(F.col("type")).alias("type"), "nullable")).alias("fields"))
    # Without a key there is one entry: its field list is a scalar of the plan, not a join.
    both = seen.join(entry, on) if on else seen.withColumn("fields", entry.select("fields").scalar())
    removed = both.select(*by, F.explode(F.filter(
        "fields", lambda f: ~F.array_contains("seen", f.getField("name")))).alias("f")).select(
        *by, F.col("f.name").alias("name"), F.lit("removed").alias("change"),
        F.col("f.type").alias("old_type"), F.lit(None).cast("string").alias("new_type"),
        F.col("f.nullable").alias("old_nullable"),
        F.lit(None).cast("boolean").alias("new_nullable"))
    return present.unionByName(removed)


def classify_drift(registry: DataFrame, observed: DataFrame, by: Sequence[str],
                   on: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """``(changes, verdicts)``: none, additive or breaking per observed schema."""
    rows = field_changes(registry, observed, by, on)
    changed = F.col("change")
    verdicts = rows.groupBy(*by).agg(
        F.when(F.count_if(changed.isin(*BREAKING)) > 0, "breaking")
        .when(F.count_if(changed == "added") > 0, "additive")
        .otherwise("none").alias("drift_type"))
    return rows.filter(changed.isNotNull()), verdicts


def schema_diff(registry: DataFrame, observed: DataFrame) -> DataFrame:
    """Field-by-field comparison of two single schemas, unchanged fields left out."""
    joined = registry.alias("r").join(observed.alias("o"), "name", "full_outer").select(
        "name", F.col("r.type").alias("old_type"), F.col("o.type").alias("new_type"))
    return joined.filter(~F.col("old_type").eqNullSafe(F.col("new_type")))


def drift_summary(changes: DataFrame, by: Sequence[str]) -> DataFrame:
    """Breaking, removed and nullability lists as one JSON text per schema."""
    def listed(kind: str, item: Column) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("change") == kind, item)))

    return changes.groupBy(*by).agg(F.to_json(F.struct(
        listed("type", F.struct("name", "old_type", "new_type")).alias("breaking_fields"),
        listed("removed", F.col("name")).alias("removed_fields"),
        listed("nullability", F.struct("name", "old_nullable", "new_nullable"))
        .alias("nullability_changes"))).alias("drift_summary"))


def breaking_days(verdicts: DataFrame, day: Sequence[str], order: str) -> DataFrame:
    """Per day the first breaking file (it alerts) and the last (it annotates)."""
    return verdicts.filter("drift_type = 'breaking'").groupBy(*day).agg(
        F.min(order).alias("alert_on"), F.max(order).alias("annotate_with"),
        F.count(F.lit(1)).alias("breaking_files"))


def conform(df: DataFrame, registry: StructType) -> DataFrame:
    """Cast to the registry's types; values that do not cast move to ``_rescued``.

    Missing columns become NULL, new ones stay.  ``_rescued`` maps a column to
    the text of its value and is NULL where nothing was lost.
    """
    present = set(df.columns)
    known = {f.name: f.dataType for f in registry}
    cells, lost = [], []
    for name, wanted in known.items():
        if name not in present:
            cells.append(F.lit(None).cast(wanted).alias(name))
        elif df.schema[name].dataType == wanted:
            cells.append(F.col(name))
        else:
            cast = F.col(name).try_cast(wanted)
            cells.append(cast.alias(name))
            lost.append(F.when(F.col(name).isNotNull() & cast.isNull(), F.struct(
                F.lit(name).alias("key"), F.col(name).cast("string").alias("value"))))
    extra = [F.col(c) for c in df.columns if c not in known and c != RESCUED]
    empty = F.lit(None).cast("map<string,string>")
    if lost:
        entries = F.array_compact(F.array(*lost))
        rescued = F.when(F.size(entries) > 0, F.map_from_entries(entries))
    else:
        rescued = empty
    if RESCUED in present:
        none = F.create_map().cast("map<string,string>")
        both = F.map_concat(F.coalesce(F.col(RESCUED), none), F.coalesce(rescued, none))
        rescued = F.when(F.size(both) > 0, both)
    return df.select(*cells, *extra, rescued.alias(RESCUED))


def union_drifted(frames: Sequence[DataFrame], registry: StructType) -> DataFrame:
    """Union of conformed frames; columns new in some are NULL in the others.

    A new column that comes with different types is kept as text.
    """
    conformed = [conform(f, registry) for f in frames]
    types: dict[str, set[str]] = {}
    for f in conformed:
        for name, kind in f.dtypes:
            types.setdefault(name, set()).add(kind)
    mixed = [n for n, kinds in types.items() if len(kinds) > 1]
    agreed = [f.withColumns({n: F.col(n).cast("string") for n in mixed if n in f.columns})
              for f in conformed]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), agreed)

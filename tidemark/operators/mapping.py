"""Source field to index field mapping."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.common import let, no_strings
from ..model import MAPPING_FILE
from ..session import checkpoint_root, shared_dir

HIER_PREFIX = "_hier_"
#: Mapped field names that are sent to every task; more of them are joined by a shuffle.
FEW_NAMES = 100_000

# Fields mapped without any configuration.
DEFAULT_TARGETS = {
    "author": "author",
    "owner": "owner",
    "filename": "filename",
    "filepath": "filepath",
    "sourcename": "source",
    "servername": "servername",
    "sharename": "sharename",
    "ext": "ext",
    "to": "to",
    "from": "from",
    "cc": "cc",
    "keywords": "keywords",
    "created_date": "created_date",
    "created_date_s": "created_date_s",
    "checksum": "checksum",
    "simhash": "simhash",
    "acl": "acl",
    "allow_token_document": "allow_token_document",
    "allow_token_parent": "allow_token_parent",
    "allow_token_share": "allow_token_share",
    "deny_token_document": "deny_token_document",
    "deny_token_parent": "deny_token_parent",
    "deny_token_share": "deny_token_share",
}

# Index fields that hold several values without any configuration.
DEFAULT_MULTI = (
    "metas", "author", "owner", "allow_token_document", "allow_token_parent",
    "allow_token_share", "entity", "to", "from", "description", "subject", "keywords",
    "child_ids",
)

# Index fields written by the core projection; a source field of the same name is not sent again.
CORE_TARGETS = (
    "id", "url", "title", "mime", "parent_id", "size", "last_modified", "last_modified_date_s",
    "source", "child_ids",
)


@dataclass(frozen=True)
class FieldMapping:
    """Targets by source field, the multi-valued targets, and the dynamic name prefixes."""

    targets: dict[str, str] = field(default_factory=lambda: dict(DEFAULT_TARGETS))
    multi: frozenset[str] = frozenset(DEFAULT_MULTI)
    prefixes: tuple[str, ...] = ()

    @classmethod
    def of(cls, entries: Iterable[tuple[str, str | None, str | None, bool | None]]) -> FieldMapping:
        """Defaults extended by entries (source, target, dynamic flag, multi)."""
        targets, multi, prefixes = dict(DEFAULT_TARGETS), set(DEFAULT_MULTI), []
        for source, target, dynamic, many in entries:
            if source is None:
                raise ValueError("a mapping entry has no source field")
            if target is not None:
                targets[source] = target
                if many:
                    multi.add(target)
            elif (dynamic or "").lower() == "true":
                prefixes.append(source.removesuffix("*"))
            else:
                raise ValueError(f"mapping entry {source!r} has neither a target nor a dynamic flag")
        return cls(targets, frozenset(multi), tuple(dict.fromkeys(prefixes)))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FieldMapping:
        """Read a mapping file.

        It is one JSON text written by hand, so its entries become expression
        literals; a mapping that is a table of its own is joined by ``map_long``.
        """
        rows = (
            spark.read.schema(MAPPING_FILE).option("multiLine", True).json(path)
            .select(F.inline("iDoc2Solr")).collect()
        )
        return cls.of((r.idocField, r.solrField, r.dynamicSolrFieldType, r.multi) for r in rows)

    def target_of(self, name: Column) -> Column:
        """Index field of a source field; hierarchical facets keep their name, others may have none."""
        pairs = [F.lit(v) for pair in self.targets.items() for v in pair]
        known = F.try_element_at(F.create_map(*pairs), name) if pairs else F.lit(None).cast("string")
        return F.when(name.startswith(HIER_PREFIX), name).otherwise(known)

    def is_multi(self, target: Column) -> Column:
        return target.startswith(HIER_PREFIX) | target.isin(*sorted(self.multi))

    def is_dynamic(self, name: Column) -> Column:
        matched = F.lit(False)
        for prefix in self.prefixes:
            matched = matched | name.startswith(prefix)
        return matched


def map_fields(
    df: DataFrame, mapping: FieldMapping, fields: str = "fields", out: str = "index_fields",
    taken: Iterable[str] = CORE_TARGETS,
) -> DataFrame:
    """Map each document's fields to index fields, inside the row and without a shuffle.

    Fields are taken in name order. A mapped field is sent unless an index field
    of its own name is already set; otherwise a dynamic prefix sends it under its
    own name; otherwise it is dropped. A single-valued target gets its values
    joined by commas; targets shared by several fields collect all of them.
    """
    reserved = F.array(*[F.lit(t) for t in taken]).cast("array<string>")
    kind = "array<struct<target:string,values:array<string>>>"

    def sent(done: Column, item: Column) -> Column:
        target, name = item["target"], item["key"]

        def add(to: Column, values: Column) -> Column:
            return F.concat(done, F.array(F.struct(to.alias("target"), values.alias("values"))))

        free = ~F.array_contains(reserved, name) & ~F.exists(done, lambda d: d["target"] == name)
        return (
            F.when(target.isNotNull() & free, add(target, item["sent"]))
            .when(item["dynamic"], add(name, item["value"]))
            .otherwise(done)
        )

    def prepared(entry: Column) -> Column:
        """Target, dynamic flag and outgoing values of one field, worked out once."""
        target = mapping.target_of(entry["key"])
        joined = F.array(F.array_join(entry["value"], ","))
        return F.struct(
            entry["key"].alias("key"), entry["value"].alias("value"), target.alias("target"),
            mapping.is_dynamic(entry["key"]).alias("dynamic"),
            F.when(mapping.is_multi(target), entry["value"]).otherwise(joined).alias("sent"),
        )

    def as_map(done: Column) -> Column:
        names = F.array_distinct(F.transform(done, lambda d: d["target"]))
        return F.map_from_arrays(names, F.transform(names, lambda n: F.flatten(
            F.transform(F.filter(done, lambda d: d["target"] == n), lambda d: d["values"])
        )))

    filled = F.transform(
        F.map_entries(fields),
        lambda e: F.struct(
            e["key"].alias("key"),
            F.filter(F.coalesce(e["value"], no_strings()), lambda v: v.isNotNull()).alias("value"),
        ),
    )
    known = F.filter(
        F.transform(F.filter(filled, lambda e: F.size(e["value"]) > 0), prepared),
        lambda i: i["target"].isNotNull() | i["dynamic"],
    )
    # The key comes first in the struct, so the natural order is the name order.
    items = F.array_sort(known)
    return df.withColumn(out, let(F.aggregate(items, F.array().cast(kind), sent), as_map))


def map_long(long: DataFrame, mapping: DataFrame) -> DataFrame:
    """Long-form variant: left join of (id, field, pos, value) to a mapping table (source, target, multi)."""
    known = mapping.select(
        F.col("source").alias("_source"), "target", F.coalesce("multi", F.lit(False)).alias("multi")
    )
    joined = long.join(known, F.col("field") == F.col("_source"), "left").drop("_source")
    hier = F.col("field").startswith(HIER_PREFIX)
    return joined.withColumn("target", F.when(hier, F.col("field")).otherwise(F.col("target"))).withColumn(
        "multi", hier | F.coalesce("multi", F.lit(False))
    )


def _known_fields(names: DataFrame, targets: DataFrame, prefixes: DataFrame) -> DataFrame:
    """``(field, target, multi, dynamic)`` of the distinct field names that are mapped or have a dynamic prefix.

    A name meets the prefixes by equality, once for every length a prefix has.
    """
    hier = F.col("field").startswith(HIER_PREFIX)
    lengths = sorted(r[0] for r in prefixes.where("prefix is not null").select(F.length("prefix")).distinct().collect())
    cuts = F.array(*[F.substring("field", 1, n) for n in lengths]).cast("array<string>")
    dynamic = names.select("field", F.explode(cuts).alias("prefix")).join(
        prefixes.select("prefix").distinct(), "prefix", "left_semi").select(F.col("field").alias("_dynamic")).distinct()
    # One target per source; targets that any entry calls multi-valued are so for all.
    by_source = targets.where("source is not null and target is not null").groupBy(
        F.col("source").alias("_source")).agg(F.min("target").alias("target"))
    many = targets.where("multi").select(F.col("target").alias("_many")).distinct()
    joined = names.join(by_source, F.col("field") == F.col("_source"), "left").join(
        dynamic, F.col("field") == F.col("_dynamic"), "left")
    joined = joined.withColumn("target", F.when(hier, F.col("field")).otherwise(F.col("target")))
    return joined.join(many, F.col("target") == F.col("_many"), "left").select(
        "field", "target", (hier | F.col("_many").isNotNull()).alias("multi"), F.col("_dynamic").isNotNull().alias("dynamic"),
    ).where("target is not null or dynamic")


def map_table(
    long: DataFrame, targets: DataFrame, prefixes: DataFrame, identifier: str = "id", taken: Iterable[str] = CORE_TARGETS,
) -> DataFrame:
    """``map_fields`` over long rows (id, field, pos, value) and a mapping that is a table of any size.

    ``targets`` has ``source``, ``target`` and ``multi``, ``prefixes`` has ``prefix``. Distinct
    names meet the mapping once; which field a document sends where is worked out from
    its field names, and its values follow in a join on (id, field). The result has
    the same columns; positions count from 0 within an index field.

    The rows are written once when this is called, as they are read three times. Spark takes exploded
    rows for no larger than the rows they come from, so no join may choose by its estimate to
    broadcast them.
    """
    reserved = F.array(*[F.lit(t) for t in taken]).cast("array<string>")
    kind = "array<struct<field:string,to:string,mapped:boolean,multi:boolean>>"
    spark = long.sparkSession
    checkpoint_root(spark)
    path = shared_dir(spark, "long")
    long.where(F.col("value").isNotNull()).select(F.col(identifier).alias("_id"), "field", "pos", "value").write.parquet(path)
    filled = spark.read.parquet(path)
    own = filled.select("_id", "field").distinct()
    known = _known_fields(filled.select("field").distinct(), targets, prefixes).checkpoint()
    known = F.broadcast(known) if known.count() <= FEW_NAMES else known.hint("merge")

    def sent(done: Column, item: Column) -> Column:
        def add(to: Column, mapped: bool) -> Column:
            return F.concat(done, F.array(F.struct(
                item["field"].alias("field"), to.alias("to"), F.lit(mapped).alias("mapped"), item["multi"].alias("multi"))))

        free = ~F.array_contains(reserved, item["field"]) & ~F.exists(done, lambda d: d["to"] == item["field"])
        return F.when(item["target"].isNotNull() & free, add(item["target"], True)).when(
            item["dynamic"], add(item["field"], False)).otherwise(done)

    # In name order, as the first column of the struct.
    items = F.array_sort(F.collect_list(F.struct("field", "target", "multi", "dynamic")))
    plan = own.join(known, "field").groupBy("_id").agg(items.alias("items")).select(
        "_id", F.inline(F.aggregate("items", F.array().cast(kind), sent)))
    values = filled.hint("merge").join(plan.hint("merge"), ["_id", "field"])
    joins = F.col("mapped") & ~F.col("multi")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda x: x["value"])
    one = values.where(joins).groupBy("_id", "to", "field").agg(F.array_join(texts, ",").alias("value")).withColumn("pos", F.lit(0))
    names = ["_id", "to", "field", "pos", "value"]
    every = values.where(~joins).select(names).unionByName(one.select(names))
    place = F.row_number().over(W.partitionBy("_id", "to").orderBy("field", "pos", "value"))
    return every.select(
        F.col("_id").alias(identifier), F.col("to").alias("field"), (place - 1).cast("bigint").alias("pos"), "value")

"""Index records and the application of insert, update and delete actions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ms_to_zulu

INSERT, UPDATE, DELETE = "INSERT", "UPDATE", "DELETE"
ACL_LISTS = (
    "allow_token_share", "allow_token_parent", "allow_token_document",
    "deny_token_share", "deny_token_parent", "deny_token_document",
)


def core_record(df: DataFrame) -> DataFrame:
    """Core index fields of a document; the time is written in both date fields."""
    zulu = ms_to_zulu("last_modified_ms")
    children = F.when(F.size("child_ids") > 0, F.array_join("child_ids", ","))
    return df.select(
        "id", "url", "title", "mime", "parent_id", "size",
        zulu.alias("last_modified_date_s"), zulu.alias("last_modified"), "source",
        children.alias("child_ids"),
        F.when(~F.coalesce("is_stub", F.lit(False)), F.col("body")).alias("_text_"),
    )


def acl_record(df: DataFrame, file: str = "file") -> DataFrame:
    """File and access-list index fields; an absent scalar stays null."""
    f = F.col(file)
    lists = [f[name].alias(name) for name in ACL_LISTS]
    return df.select(
        "id", *lists, f["owner"].alias("owner"), f["server"].alias("servername"),
        f["share"].alias("sharename"), f["name"].alias("filename"), f["extension"].alias("ext"),
    )


def action_kind(action: Column | str) -> Column:
    """DELETE, UPDATE, or INSERT for everything else; upper and lower case are equal."""
    name = F.upper(F.col(action) if isinstance(action, str) else action)
    return F.when(name.isin(DELETE, UPDATE), name).otherwise(F.lit(INSERT))


def latest_action(actions: DataFrame, identifier: str, order: Sequence[str]) -> DataFrame:
    """The last action of each id; reduced before the shuffle."""
    rest = [c for c in actions.columns if c != identifier]
    return actions.groupBy(identifier).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    ).select(identifier, *[F.col(f"_last.{c}").alias(c) for c in rest])


def fold_actions(
    actions: DataFrame, identifier: str, action: str, modified: str, order: Sequence[str],
    content: Sequence[str],
) -> DataFrame:
    """Net effect of each id's actions, as if applied one after the other.

    Per id the actions after its last DELETE count: content comes from the last
    INSERT among them, else from the first UPDATE; the time is the newest among
    them. Output: id, ``deleted`` (a DELETE occurred), ``inserted`` (content is a
    full record), ``alive``, ``last_modified`` and the content columns.

    Everything is a partial aggregate, so an id holding a third of all actions
    shrinks to one row per task before it is shuffled. Only ids that restart
    with an UPDATE after a DELETE need a second look at their rows.
    """
    ordered = actions.withColumn("_kind", action_kind(action)).withColumn("_ord", F.struct(*order))
    kind, at = F.col("_kind"), F.col("_ord")
    when = {k: F.when(kind == k, at) for k in (INSERT, UPDATE, DELETE)}
    payload = F.struct(*content) if content else F.struct(F.lit(0).alias("_none"))
    folded = ordered.groupBy(identifier).agg(
        F.max(when[DELETE]).alias("_deleted"),
        F.max(when[INSERT]).alias("_inserted"),
        F.min(when[UPDATE]).alias("_first"),
        F.max(when[UPDATE]).alias("_updated"),
        F.max_by(payload, when[INSERT]).alias("_insert_row"),
        F.min_by(payload, when[UPDATE]).alias("_update_row"),
        F.max_by(F.col(modified), F.when(kind != DELETE, at)).alias("_modified"),
    )

    def after(name: str) -> Column:
        return F.col(name).isNotNull() & (F.col("_deleted").isNull() | (F.col(name) > F.col("_deleted")))

    marks = ordered.groupBy(identifier).agg(
        F.max(when[DELETE]).alias("_deleted"), F.max(when[INSERT]).alias("_inserted"),
        F.min(when[UPDATE]).alias("_first"), F.max(when[UPDATE]).alias("_updated"),
    )
    restarted = marks.where(
        F.col("_deleted").isNotNull() & ~after("_inserted") & after("_updated") & ~after("_first")
    ).select(F.col(identifier).alias("_id"), F.col("_deleted").alias("_cut"))
    again = (
        ordered.where(kind == UPDATE)
        .join(restarted, (F.col(identifier) == F.col("_id")) & (at > F.col("_cut")))
        .groupBy("_id").agg(F.min_by(payload, at).alias("_restart_row"))
    )
    row = (
        F.when(after("_inserted"), F.col("_insert_row"))
        .when(after("_first"), F.col("_update_row"))
        .otherwise(F.col("_restart_row"))
    )
    alive = after("_inserted") | after("_updated")
    return (
        folded.join(again, F.col(identifier) == F.col("_id"), "left")
        .withColumn("_row", row)
        .select(
            identifier,
            F.col("_deleted").isNotNull().alias("deleted"),
            after("_inserted").alias("inserted"),
            alive.alias("alive"),
            F.when(alive, F.col("_modified")).alias("last_modified"),
            *[F.col(f"_row.{c}").alias(c) for c in content],
        )
    )


def still_relevant(actions: DataFrame, identifier: str, action: str, order: Sequence[str]) -> DataFrame:
    """The actions that can still matter, whatever arrives later and however late.

    Nothing at or before an id's last DELETE can take effect again, nor any but the
    last INSERT, nor an UPDATE before it. What is left is the last DELETE, the last
    INSERT after it and the UPDATEs after both. The marks are found from the narrow
    columns; the wide ones meet them in one join.
    """
    kind, at = action_kind(action), F.struct(*order)
    marks = actions.select(F.col(identifier).alias("_id"), kind.alias("_kind"), at.alias("_at")).groupBy("_id").agg(
        F.max(F.when(F.col("_kind") == DELETE, F.col("_at"))).alias("_deleted"),
        F.max(F.when(F.col("_kind") == INSERT, F.col("_at"))).alias("_inserted"),
    )
    joined = actions.withColumns({"_kind": kind, "_at": at}).join(marks, F.col(identifier).eqNullSafe(F.col("_id")))
    alive = F.col("_deleted").isNull() | (F.col("_at") > F.col("_deleted"))
    last = F.coalesce(F.col("_at") >= F.col("_inserted"), F.lit(True))
    keep = F.when(F.col("_kind") == DELETE, F.col("_at") == F.col("_deleted")).otherwise(alive & last)
    return joined.where(keep).select(*actions.columns)


def apply_folded(target: DataFrame, folded: DataFrame, identifier: str, content: Sequence[str]) -> DataFrame:
    """Target rows after the folded actions: one full outer join with one row per id on each side.

    An INSERT replaces the record; an UPDATE alone refreshes the time of a stored
    record and otherwise falls back to inserting; a DELETE removes the record.
    """
    old = target.select(
        F.col(identifier).alias("_id"), F.lit(True).alias("_stored"),
        F.col("last_modified").alias("_time"), *[F.col(c).alias(f"_old_{c}") for c in content],
    )
    joined = folded.join(old, F.col(identifier) == F.col("_id"), "full")
    untouched = F.col("alive").isNull()
    keeps_old = F.coalesce("_stored", F.lit(False)) & (
        untouched | (F.col("alive") & ~F.col("inserted") & ~F.col("deleted"))
    )
    return joined.where(untouched | F.col("alive")).select(
        F.coalesce(identifier, "_id").alias(identifier),
        F.coalesce("last_modified", "_time").alias("last_modified"),
        *[F.when(keeps_old, F.col(f"_old_{c}")).otherwise(F.col(c)).alias(c) for c in content],
    )


def apply_actions(
    target: DataFrame, actions: DataFrame, identifier: str, action: str, modified: str,
    order: Sequence[str], content: Sequence[str],
) -> DataFrame:
    folded = fold_actions(actions, identifier, action, modified, order, content)
    return apply_folded(target, folded, identifier, content)


def delete_ids(target: DataFrame, ids: DataFrame, identifier: str = "id") -> DataFrame:
    return target.join(ids.select(identifier), identifier, "left_anti")


def export_scan(index: DataFrame, columns: Sequence[str] = ("id", "last_modified", "guid")) -> DataFrame:
    """Index rows for export, ordered by id (a distributed range sort)."""
    return index.select(*columns).orderBy("id")

"""Building documents from table rows and landed JSON."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    class_token, child_documents, comment_json, comment_text, doc_id, entry, extend_fields, folder_chain,
    folder_path, hier_facets, merge_entries, named_categories, named_fields,
    parent_folder, parse_epoch_ms, parse_size, permission_tokens, view_url, whole_number,
)
from ..functions.common import let
from ..functions.values import DEFAULT_VIEW_URL
from ..model import DEFAULT_API_FIELDS
from .incremental import usable_keys
from .numbering import joined_text

UPSERT = "UPSERT"


def row_documents(
    df: DataFrame, keys: Sequence[str], service: str, path_column: str | None = None
) -> DataFrame:
    """One document per row: id from the key columns, every column as a text field.

    Rows without any key part are left out (incremental.null_key_count counts them).
    """
    # Column names are distinct, so the map needs no merging.
    values = F.map_from_arrays(
        F.array(*[F.lit(c) for c in df.columns]),
        F.array(*[F.array(F.col(c).cast("string")) for c in df.columns]),
    )
    found = [c for c in df.columns if path_column and c.lower() == path_column.lower()]
    temp_path = F.col(found[0]).cast("string") if found else F.lit(None).cast("string")
    return usable_keys(df, keys).select(
        doc_id(*keys).alias("id"),
        F.lit(f"JDBC://{service}").alias("source"),
        temp_path.alias("temp_path"),
        F.map_filter(values, lambda _, v: v[0].isNotNull()).alias("fields"),
    )


def _pairs(fields: str) -> Column:
    """(field, pos, value) structs of a map of multi-valued fields."""
    return F.flatten(F.transform(
        F.map_entries(fields),
        lambda e: F.transform(
            e["value"],
            lambda v, i: F.struct(e["key"].alias("field"), i.alias("pos"), v.alias("value")),
        ),
    ))


def to_long(df: DataFrame, identifier: str = "id", fields: str = "fields") -> DataFrame:
    """Rows (id, field, pos, value) from the map of multi-valued fields.

    The outer form matters: for an inner explode of a column Spark adds a filter
    on its size, pushes it below the projection and so computes the map twice.
    """
    return df.select(identifier, F.inline_outer(_pairs(fields))).where(F.col("field").isNotNull())


def dump(df: DataFrame, core: Sequence[str], identifier: str = "id", fields: str = "fields") -> DataFrame:
    """Core attributes and every (field, value) pair of each document in long form."""
    attributes = F.array(*[
        F.struct(F.lit(c).alias("field"), F.lit(0).alias("pos"), F.col(c).cast("string").alias("value"))
        for c in core
    ])
    opened = _pairs(fields)
    pairs = F.concat(attributes, F.coalesce(opened, F.slice(attributes, F.lit(1), F.lit(0))))
    return df.select(identifier, F.inline(pairs)).where(F.col("value").isNotNull())


def add_hier_fields(
    df: DataFrame, names: str | Sequence[str], fields: str = "fields", file_path: str | None = None
) -> DataFrame:
    """Add ``_hier_<name>`` facets for each configured field.

    ``filepath`` takes the parent folder of the file path column when there is one.
    A missing field adds nothing.
    """
    wanted = names.split(",") if isinstance(names, str) else list(names)
    if not [n for n in wanted if n]:
        raise ValueError("at least one field name is needed for hierarchical facets")
    added = []
    for name in wanted:
        stored = F.element_at(F.try_element_at(F.col(fields), F.lit(name)), 1)
        if name.lower() == "filepath" and file_path is not None:
            stored = F.coalesce(parent_folder(file_path), stored)
        added.append(F.struct(F.lit(f"_hier_{name}").alias("name"), hier_facets(stored).alias("values")))
    return df.withColumn(fields, extend_fields(F.col(fields), F.array(*added)))


def add_constants(df: DataFrame, constants: Mapping[str, str], fields: str = "fields") -> DataFrame:
    entries = F.array(*[entry(name, F.lit(value)) for name, value in constants.items()])
    return df.withColumn(fields, extend_fields(F.col(fields), entries))


def drop_field(df: DataFrame, name: str, fields: str = "fields") -> DataFrame:
    return df.withColumn(fields, F.map_filter(fields, lambda k, _: k != name))


def api_documents(
    df: DataFrame, doc: str = "doc", folder_id: str = "folderId", parent_id: str = "parentFolderId",
    link_template: str = DEFAULT_VIEW_URL, link_field: str = "viewurl",
) -> DataFrame:
    """Typed documents from the landed structs; everything is computed inside the row."""
    d = F.col(doc)
    created = whole_number(d["creationDate"])
    defaults = F.array(*[entry(name.lower(), d[name]) for name in DEFAULT_API_FIELDS],
                       entry(link_field, view_url(d["domainName"], d["libraryId"], d["id"], link_template)))
    folders = folder_path(folder_chain(d["folders"], folder_id, parent_id))
    return df.select(
        d["id"].alias("doc_id"),
        d["domainName"].alias("domain"),
        d["title"].alias("title"),
        d["libraryId"].alias("library_id"),
        d["libraryName"].alias("library_name"),
        F.coalesce(created, F.lit(0).cast("bigint")).alias("creation_ms"),
        # A bad creation date leaves the modification date at 0 as well.
        F.when(created.isNull(), F.lit(0).cast("bigint"))
        .otherwise(parse_epoch_ms(d["modificationDate"])).alias("modification_ms"),
        folders.alias("folder_path"),
        permission_tokens(d["permissions"]).alias("permissions"),
        d["attachments"].alias("attachments"),
        defaults.alias("default_fields"),
        named_fields(d["fields"]).alias("custom_fields"),
        named_categories(d["categories"]).alias("category_fields"),
    )


def flat_metas(
    docs: DataFrame, storage_account: str | Column | None = None,
    storage_field: str = "storage_account", permission_field: str = "ao_permission",
    comments: str | None = None,
) -> DataFrame:
    """Flat ``metas_*`` map of each typed document, all values of a name kept in order."""
    account = F.lit(storage_account) if not isinstance(storage_account, Column) else storage_account
    fixed = F.array(
        entry("metas_docid", "doc_id"), entry("metas_domain", "domain"),
        entry("metas_title", "title"), entry("metas_libraryname", "library_name"),
        entry("metas_libraryid", "library_id"), entry("metas_creationdate", "creation_ms"),
        entry("last_modified_date", "modification_ms"), entry("metas_folderpath", "folder_path"),
        entry(f"metas_{storage_field}", account.cast("string")),
    )
    defaults = F.transform(
        F.col("default_fields"),
        lambda e: F.struct(F.concat(F.lit("metas_"), e["name"]).alias("name"), e["values"].alias("values")),
    )
    grants = F.array(F.struct(
        F.lit(f"metas_{permission_field}").alias("name"), F.col("permissions").alias("values")
    ))
    parts = [fixed, defaults, grants, F.col("custom_fields"), F.col("category_fields")]
    if comments is not None:
        parts.append(F.array(entry("metas_comments", comments)))
    return docs.withColumn("fields", merge_entries(*parts))


def attachment_rows(
    docs: DataFrame, source_prefix: str = "API_", keep: Sequence[str] = ()
) -> DataFrame:
    """One document per attachment, parent fields repeated; none for a bare document."""
    a = F.col("_a")
    extra = F.array(
        entry("metas_attachmentname", a["name"]), entry("metas_iconurl", a["iconLink"]),
    )
    return (
        docs.withColumn("_a", F.explode_outer("attachments"))
        .where(F.col("_a").isNotNull())
        .select(
            a["fileId"].alias("id"),
            F.col("doc_id").alias("parent_id"),
            "title",
            a["mimeType"].alias("mime"),
            a["link"].alias("url"),
            parse_size(a["size"]).alias("size"),
            F.concat(F.lit(source_prefix), F.col("library_name")).alias("source"),
            F.lit(UPSERT).alias("action"),
            F.col("modification_ms").alias("last_modified_ms"),
            extend_fields(F.col("fields"), extra).alias("fields"),
            *keep,
        )
    )


def expand_attachments(
    docs: DataFrame, identifier: str = "id", attachments: str = "attachments", mime: str = "mime",
    long_name: str = "long_name", short_name: str = "short_name", keep: Sequence[str] = (),
) -> DataFrame:
    """Child documents of a message: parent columns kept, new id, parent link, ordinal."""
    children = child_documents(F.col(identifier), attachments, mime, long_name, short_name)
    return docs.select(
        F.col(identifier).alias("parent_id"), *keep, F.explode(children).alias("_c")
    ).select(
        F.col("_c.child_id").alias("id"), "parent_id", *keep,
        F.col("_c.ordinal").alias("ordinal"), F.col("_c.attachment").alias("attachment"),
    )


def attachment_count(attachments: str = "attachments", mime: str = "mime") -> Column:
    return F.size(F.filter(F.col(attachments), lambda a: ~F.coalesce(
        F.lower(a[mime]).startswith("image"), F.lit(False))))


def comment_rows(pages: DataFrame) -> DataFrame:
    """Each landed comment once, as (doc_id, comment)."""
    flat = pages.select(F.col("documentId").alias("doc_id"), F.explode_outer("comments").alias("comment"))
    return flat.where(F.col("comment").isNotNull())


def comments_joined(comments: DataFrame) -> DataFrame:
    """Comments of each document joined by ``|``, ordered by created, modified, message."""
    c = F.col("comment")
    ordered = comments.select("doc_id", F.struct(
        c["createdTime"].alias("createdTime"), c["modifiedTime"].alias("modifiedTime"),
        c["message"].alias("message"), c["author"].alias("author"),
    ).alias("comment"))
    # Ordering by the struct itself: its fields stand in the wanted order.
    return joined_text(ordered, ["doc_id"], ["comment"], "comment", "|", "comments", comment_text)


def comments_json(comments: DataFrame) -> DataFrame:
    return comments.select(
        "doc_id", F.col("comment.createdTime").alias("created"), comment_json("comment").alias("json")
    )


def attach_comments(docs: DataFrame, joined: DataFrame) -> DataFrame:
    """Left join of documents to their whole comment text; one row per document stays one row."""
    return docs.join(joined.select("doc_id", "comments"), "doc_id", "left")


def class_list(pages: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct (id, displayName) pairs that have both."""
    items = pages.select(*keys, F.explode("items").alias("_i"))
    return (
        items.select(*keys, F.col("_i.id").alias("class_id"), F.col("_i.displayName").alias("class_name"))
        .where(F.col("class_id").isNotNull() & F.col("class_name").isNotNull())
        .distinct()
        .withColumn("token", class_token("class_id", "class_name"))
    )


def libraries(pages: DataFrame) -> DataFrame:
    """Libraries that have an id, with their class items."""
    return (
        pages.select(F.explode("libraries").alias("l")).select("l.*")
        .where(F.col("libraryId").isNotNull())
    )


def library_classes(catalogue: DataFrame) -> DataFrame:
    """One row per (library, class)."""
    return catalogue.select(
        "libraryId", "name", "domainName", "storageAdmin", F.explode("documentTypes.items").alias("_i")
    ).select(
        "libraryId", F.col("name").alias("library_name"), "domainName", "storageAdmin",
        F.col("_i.name").alias("class_name"), F.col("_i.value").alias("class_id"),
    )


def library_json(catalogue: DataFrame) -> DataFrame:
    """Task text of each library."""
    body = F.struct("libraryId", "name", "domainName", "storageAdmin", "documentTypes")
    return catalogue.select("libraryId", F.to_json(body).alias("task"))


def facet_rows(df: DataFrame, identifier: str, path: str | Column) -> DataFrame:
    """(id, level, facet) rows of a path column."""
    facets = df.select(identifier, F.posexplode(hier_facets(path)).alias("level", "facet"))
    return facets.select(identifier, F.col("level").cast("bigint").alias("level"), "facet")


def attach_body(
    docs: DataFrame, bodies: DataFrame, path: str = "temp_path", cap: int | None = None,
    domain: str | None = None, configured_domain: str | None = None,
) -> DataFrame:
    """Body by path; longer than the cap, or a share of another domain, stays without one.

    ``bodies`` has one row (path, length, content) per file. The cap is tested on
    the length before the join, so oversized content is never shuffled.
    """
    from .filters import BODY_CAP

    usable = bodies.where(F.col("length") <= (cap or BODY_CAP)).select(
        F.col("path").alias("_path"), F.col("content").alias("body")
    )
    allowed = F.lit(True)
    if domain is not None:
        same = F.col(domain).eqNullSafe(F.lit(configured_domain))
        allowed = ~F.col(path).startswith("smb://") | same
    return docs.join(usable, (F.col(path) == F.col("_path")) & allowed, "left").drop("_path")


def first_value(fields: str, name: str) -> Column:
    return let(F.try_element_at(F.col(fields), F.lit(name)), lambda v: F.try_element_at(v, F.lit(1)))

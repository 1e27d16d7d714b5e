"""Functions over the arrays nested inside one document row.

All of them work inside the row, so no group of rows is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..model import CATEGORY_NODE
from .common import col, let, no_strings, strings, text_or_null_word
from .paths import ESCAPED_SLASH, SLASH
from .values import child_id, meta_field_name

READERS = "Readers"


def folder_chain(
    folders: Column | str, folder_id: str = "folderId", parent_id: str = "parentFolderId"
) -> Column:
    """Folder names from the root down: root, its first child, then by parent id.

    Null without a root. The walk takes at most one step per folder and enters none
    twice, so a broken or cyclic chain ends; folders it does not reach are left out.
    """

    def walk(items: Column) -> Column:
        roots = F.filter(items, lambda f: F.coalesce(f["folderIsRoot"], F.lit(False)))
        firsts = F.filter(items, lambda f: F.coalesce(f["parentFolderIsRoot"], F.lit(False)))

        def node(folder: Column) -> Column:
            return F.struct(
                F.lower(folder[folder_id]).alias("at"), F.array(folder["name"]).alias("names"),
                F.array(F.lower(folder[folder_id])).alias("seen"),
            )

        def step(state: Column, folder: Column) -> Column:
            at = F.lower(folder[folder_id])
            return F.struct(
                at.alias("at"),
                F.concat(state["names"], F.array(folder["name"])).alias("names"),
                F.concat(state["seen"], F.array(at)).alias("seen"),
            )

        start = let(
            node(F.try_element_at(roots, F.lit(-1))),
            lambda root: F.when(F.size(firsts) > 0, step(root, F.try_element_at(firsts, F.lit(-1))))
            .otherwise(root),
        )

        def follow(state: Column, _: Column) -> Column:
            children = F.filter(
                items,
                lambda f: (F.lower(f[parent_id]) == state["at"])
                & ~F.array_contains(state["seen"], F.coalesce(F.lower(f[folder_id]), F.lit(""))),
            )
            return let(
                F.try_element_at(children, F.lit(1)),
                lambda child: F.when(child.isNotNull(), step(state, child)).otherwise(state),
            )

        steps = F.sequence(F.lit(1), F.greatest(F.size(items), F.lit(1)))
        return F.when(F.size(roots) > 0, F.aggregate(steps, start, follow)["names"])

    return let(col(folders), walk)


def folder_path(names: Column | str) -> Column:
    """Names joined by slashes, a slash inside a name escaped; null for no folders."""
    escaped = F.transform(col(names), lambda n: F.replace(n, F.lit(SLASH), F.lit(ESCAPED_SLASH)))
    return F.array_join(escaped, SLASH)


def category_nodes(values: Column | str) -> Column:
    """Landed category values (JSON text, an array or one bare node) as arrays of nodes."""
    kind = f"array<{CATEGORY_NODE.simpleString()}>"
    return F.transform(
        col(values),
        lambda v: F.from_json(
            F.when(F.ltrim(v).startswith("{"), F.concat(F.lit("["), v, F.lit("]"))).otherwise(v),
            kind,
        ),
    )


def category_values(nodes: Column | str) -> Column:
    """Flatten hierarchical categories to ``parent/child`` texts.

    Parent id ``0`` starts a value, any other parent id extends the latest value
    of the same inner array; an orphan and a bare node start a value.
    """

    def one(inner: Column) -> Column:
        def add(values: Column, node: Column) -> Column:
            opened = (F.lower(node["parentId"]) == "0") | (F.size(values) == 0)
            extended = F.concat(
                F.slice(values, F.lit(1), F.greatest(F.size(values) - 1, F.lit(0))),
                F.array(F.concat(F.try_element_at(values, F.lit(-1)), F.lit(SLASH), node["name"])),
            )
            return F.when(opened, F.concat(values, F.array(node["name"]))).otherwise(extended)

        bare = (F.size(inner) == 1) & inner[0]["parentId"].isNull()
        usable = F.filter(inner, lambda n: n["name"].isNotNull() & n["parentId"].isNotNull())
        return F.when(
            bare, F.filter(F.array(inner[0]["name"]), lambda n: n.isNotNull())
        ).otherwise(F.aggregate(usable, no_strings(), add))

    return F.flatten(F.transform(F.filter(col(nodes), lambda i: i.isNotNull()), one))


def reader_grants(permissions: Column | str) -> Column:
    """Permissions whose roles include the readers role."""
    return F.filter(
        col(permissions),
        lambda p: F.coalesce(F.array_contains(p["roleNames"], READERS), F.lit(False)),
    )


def permission_tokens(permissions: Column | str) -> Column:
    """Sorted ``GG:group`` / ``GU:user`` reader tokens; no permission array means everyone.

    Equal grants are kept, as in the source lists. An empty array stays empty.
    """

    def token(p: Column) -> Column:
        kind, value = F.upper(p["type"]), text_or_null_word(p["value"])
        return F.when(kind == "GROUP", F.concat(F.lit("GG:"), value)).when(
            kind == "USER", F.concat(F.lit("GU:"), value)
        )

    tokens = F.filter(F.transform(reader_grants(permissions), token), lambda t: t.isNotNull())
    return F.when(col(permissions).isNull(), strings("GU:EVERYONE")).otherwise(F.sort_array(tokens))


def named_fields(fields: Column | str) -> Column:
    """Custom fields that have a name and at least one value, as (name, values)."""
    kept = F.filter(
        col(fields), lambda f: f["fieldName"].isNotNull() & (F.coalesce(F.size(f["values"]), F.lit(0)) > 0)
    )
    return F.transform(
        kept,
        lambda f: F.struct(meta_field_name(f["fieldName"]).alias("name"), f["values"].alias("values")),
    )


def named_categories(categories: Column | str) -> Column:
    """Categories with a name other than FOLDER and at least one value, as (name, values)."""
    opened = F.transform(
        col(categories),
        lambda c: F.struct(
            c["fieldName"].alias("name"),
            category_values(category_nodes(c["values"])).alias("values"),
        ),
    )
    kept = F.filter(
        opened,
        lambda c: c["name"].isNotNull() & (F.upper(c["name"]) != "FOLDER")
        & (F.coalesce(F.size(c["values"]), F.lit(0)) > 0),
    )
    return F.transform(
        kept,
        lambda c: F.struct(meta_field_name(c["name"]).alias("name"), c["values"].alias("values")),
    )


def comment_text(comment: Column | str) -> Column:
    comment = col(comment)
    parts = (
        comment["author"]["name"], comment["author"]["email"], comment["createdTime"],
        comment["modifiedTime"], comment["message"],
    )
    return F.concat_ws(" _ ", *[text_or_null_word(p) for p in parts])


def comment_json(comment: Column | str) -> Column:
    comment = col(comment)
    return F.to_json(
        F.struct(
            comment["author"]["name"].alias("author"),
            comment["author"]["email"].alias("authorEmail"),
            comment["createdTime"].alias("createdTime"),
            comment["modifiedTime"].alias("modifiedTime"),
            comment["message"].alias("message"),
        ),
        {"ignoreNullFields": "false"},
    )


def is_image(mime: Column | str) -> Column:
    return F.coalesce(F.lower(col(mime)).startswith("image"), F.lit(False))


def child_documents(
    parent: Column | str, attachments: Column | str, mime: str = "mime",
    long_name: str = "long_name", short_name: str = "short_name",
) -> Column:
    """Non-image attachments with their 1-based ordinal and child id."""
    kept = F.filter(col(attachments), lambda a: ~is_image(a[mime]))
    return F.transform(
        kept,
        lambda a, i: F.struct(
            (i + 1).alias("ordinal"),
            child_id(parent, a[long_name], a[short_name], i + 1).alias("child_id"),
            a.alias("attachment"),
        ),
    )


def _filled(entries: Column) -> Column:
    """Entries that have a name and at least one non-null value."""
    cleaned = F.transform(
        F.filter(entries, lambda e: e["name"].isNotNull()),
        lambda e: F.struct(
            e["name"].alias("name"),
            F.filter(F.coalesce(e["values"], no_strings()), lambda v: v.isNotNull()).alias("values"),
        ),
    )
    return F.filter(cleaned, lambda e: F.size(e["values"]) > 0)


def _grouped(items: Column) -> Column:
    """Entries to a map. Only when names repeat are the values gathered name by name."""
    def by_name(names: Column) -> Column:
        values = F.transform(
            names,
            lambda n: F.flatten(
                F.transform(F.filter(items, lambda e: e["name"] == n), lambda e: e["values"])
            ),
        )
        once = F.transform(items, lambda e: e["values"])
        return F.map_from_arrays(
            names, F.when(F.size(names) == F.size(items), once).otherwise(values)
        )

    return let(F.array_distinct(F.transform(items, lambda e: e["name"])), by_name)


def merge_entries(*entries: Column) -> Column:
    """Arrays of (name, values) to one map; equal names keep all their values in order."""
    empty = F.array().cast("array<struct<name:string,values:array<string>>>")
    return let(_filled(F.concat(*[F.coalesce(e, empty) for e in entries])), _grouped)


def extend_fields(fields: Column, entries: Column) -> Column:
    """Add entries to a map of fields; a name already there gets the further values."""
    def added(items: Column) -> Column:
        existing = F.transform(
            F.map_entries(fields),
            lambda e: F.struct(e["key"].alias("name"), e["value"].alias("values")),
        )
        names = F.transform(items, lambda e: e["name"])
        apart = ~F.arrays_overlap(F.map_keys(fields), names) & (
            F.size(F.array_distinct(names)) == F.size(names)
        )
        fresh = F.map_from_arrays(names, F.transform(items, lambda e: e["values"]))
        return F.when(apart, F.map_concat(fields, fresh)).otherwise(
            let(F.concat(existing, items), _grouped)
        )

    return let(_filled(entries), added)


def entry(name: str, value: Column | str) -> Column:
    """One single-valued (name, values) entry."""
    return F.struct(
        F.lit(name).alias("name"), F.array(col(value).cast("string")).alias("values")
    )

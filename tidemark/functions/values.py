"""Parsing and formatting of dates, numbers, names and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import col, whole_number
from .paths import file_name, has_parent, parent_folder, slash_normalise

# Separators inside stored names and the prefix of native formats.
LEAF_SEPARATOR = "_:_"
CHILD_SEPARATOR = " -_ "
NATIVE_PREFIX = "application/vnd.google-apps."

# Export type of each native format; any other native format uses the default.
EXPORT_TYPES = {
    "document": "text/plain",
    "spreadsheet": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "pdf": "application/pdf",
    "drawing": "application/pdf",
    "appscript": "application/vnd.google-apps.script+json",
}
DEFAULT_EXPORT_TYPE = "application/pdf"

DEFAULT_VIEW_URL = (
    "https://docs.example.com/?locale=en_US&domain={domain}"
    "#Menu_viewDoc/LibraryId_{library}/DocumentId_{document}"
)


def seconds(ms: Column | str) -> Column:
    return F.call_function("div", col(ms), F.lit(1000))


def zulu_to_ms(text: Column | str) -> Column:
    """``yyyy-MM-ddTHH:mm:ssZ`` in UTC to epoch milliseconds; 0 when unreadable."""
    parsed = F.try_to_timestamp(col(text), F.lit("yyyy-MM-dd'T'HH:mm:ssX"))
    well_formed = col(text).rlike(r"\A\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z\z")
    return F.coalesce(F.when(well_formed, F.unix_millis(parsed)), F.lit(0).cast("bigint"))


def _utc_text(ms: Column | str, pattern: str) -> Column:
    at = F.timestamp_millis(col(ms).cast("bigint"))
    return F.date_format(F.to_utc_timestamp(at, F.current_timezone()), pattern)


def ms_to_zulu(ms: Column | str) -> Column:
    return _utc_text(ms, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def utc_minute(ms: Column | str) -> Column:
    return _utc_text(ms, "yyyy-MM-dd'T'HH:mm'Z'")


def parse_epoch_ms(text: Column | str) -> Column:
    return F.coalesce(whole_number(text), F.lit(0).cast("bigint"))


def parse_size(text: Column | str) -> Column:
    return F.coalesce(whole_number(text, "int"), F.lit(0))


def parse_leaf(text: Column | str) -> Column:
    """``path_:_modified_:_size`` to a struct; null without a folder and a name."""
    text = slash_normalise(text)
    path = F.substring_index(text, LEAF_SEPARATOR, 1)
    rest = F.substr(text, F.length(path) + len(LEAF_SEPARATOR) + 1)
    modified = F.substring_index(rest, LEAF_SEPARATOR, 1)
    size = F.substr(rest, F.length(modified) + len(LEAF_SEPARATOR) + 1)
    both = F.instr(rest, LEAF_SEPARATOR) > 1
    usable = (F.instr(text, LEAF_SEPARATOR) > 1) & has_parent(path)
    zero = F.lit(0).cast("bigint")
    return F.when(
        usable,
        F.struct(
            parent_folder(path).alias("parent"),
            file_name(path).alias("name"),
            F.coalesce(F.when(both, whole_number(modified)), zero).alias("last_modified_ms"),
            F.coalesce(F.when(both, whole_number(size)), zero).alias("size"),
        ),
    )


def leaf_text(path: Column | str, modified: Column | str, size: Column | str) -> Column:
    return F.concat_ws(
        LEAF_SEPARATOR, col(path), col(modified).cast("string"), col(size).cast("string")
    )


def clean_file_name(text: Column | str) -> Column:
    return F.regexp_replace(col(text), r"[^a-zA-Z0-9.\-'_]", "_")


def child_id(
    parent: Column | str, long_name: Column | str, short_name: Column | str, ordinal: Column | str
) -> Column:
    return F.concat(
        col(parent),
        F.lit(CHILD_SEPARATOR),
        F.coalesce(
            clean_file_name(long_name),
            clean_file_name(short_name),
            F.concat(F.lit(" NO FILENAME ["), col(ordinal).cast("string"), F.lit("]")),
        ),
    )


def doc_id(*parts: Column | str) -> Column:
    """Key parts in the given order joined by commas, nulls skipped; null for an all-null key."""
    joined = F.concat_ws(",", *[col(p).cast("string") for p in parts])
    known = F.coalesce(*[col(p).cast("string") for p in parts]).isNotNull()
    return F.when(known, joined)


def class_token(identifier: Column | str, name: Column | str) -> Column:
    return F.when(
        col(identifier).isNotNull() & col(name).isNotNull(),
        F.concat_ws(":::", col(identifier), col(name)),
    )


def split_class_token(token: Column | str) -> Column:
    return F.split(col(token), ":::", 2)


def meta_field_name(name: Column | str) -> Column:
    return F.concat(F.lit("metas_"), F.lower(col(name)))


def meta_entry(name: Column | str, value: Column | str) -> Column:
    """``name=value`` without the two-character texts backslash-n and backslash-r."""
    entry = F.concat(col(name), F.lit("="), col(value))
    entry = F.replace(entry, F.lit("\\n"), F.lit(""))
    return F.replace(entry, F.lit("\\r"), F.lit(""))


def is_native(mime: Column | str) -> Column:
    return F.coalesce(col(mime).startswith(NATIVE_PREFIX), F.lit(False))


def export_mime(mime: Column | str) -> Column:
    """Export type of a native document; any other type is returned unchanged."""
    mime = col(mime)
    kind = F.lower(F.substr(mime, F.lit(len(NATIVE_PREFIX) + 1)))
    chosen = F.lit(DEFAULT_EXPORT_TYPE)
    for name, target in EXPORT_TYPES.items():
        chosen = F.when(kind == name, F.lit(target)).otherwise(chosen)
    return F.when(is_native(mime), chosen).otherwise(mime)


def final_mime(mime: Column | str, body_length: Column | str) -> Column:
    """Only a native text document with a fetched body takes its export type."""
    mime = col(mime)
    fetched = (mime == NATIVE_PREFIX + "document") & (col(body_length) > 0)
    return F.when(fetched, export_mime(mime)).otherwise(mime)


def view_url(
    domain: Column | str, library: Column | str, document: Column | str,
    template: str = DEFAULT_VIEW_URL,
) -> Column:
    """Fill ``{domain}``, ``{library}`` and ``{document}`` of the service's link template."""
    url = F.lit(template)
    for mark, value in (("domain", domain), ("library", library), ("document", document)):
        url = F.replace(url, F.lit("{" + mark + "}"), col(value))
    return url


def target_index(fields: Column | str, configured: str | None) -> Column:
    """The document's own index name, else the configured one, else null (an error row)."""
    own = F.element_at(F.try_element_at(col(fields), F.lit("indexname")), 1)
    return F.coalesce(own, F.lit(configured).cast("string"))


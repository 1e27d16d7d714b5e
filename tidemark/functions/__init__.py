"""Column functions; every one stays inside generated or native expressions."""

from .common import let, no_strings, strings, whole_number
from .nested import (
    category_nodes, category_values, child_documents, comment_json, comment_text, entry,
    extend_fields,    folder_chain, folder_path, is_image, merge_entries, named_categories, named_fields,
    permission_tokens, reader_grants,
)
from .paths import (
    ancestors, crate_path, depth, extension, file_name, has_parent, hier_facets,
    level_below, normalise_root, parent_folder, slash_normalise, strip_trailing_slash,
)
from .values import (
    child_id, class_token, clean_file_name, doc_id, export_mime, final_mime, is_native, leaf_text,
    meta_entry, meta_field_name, ms_to_zulu, parse_epoch_ms, parse_leaf, parse_size, seconds,
    split_class_token, target_index, utc_minute, view_url, zulu_to_ms,
)

__all__ = [name for name in dir() if not name.startswith("_")]

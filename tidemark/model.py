"""Schemas of the rows that move between stages."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _B = T.StringType(), T.LongType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


FIELDS = T.MapType(_S, T.ArrayType(_S))

# The key names of landed JSON, in all structs of this module.
PERMISSION = _struct(
    type=_S, value=_S, right=_S, name=_S, thumbnailPhotoUrl=_S, roleNames=T.ArrayType(_S),
)
ATTACHMENT = _struct(fileId=_S, name=_S, mimeType=_S, link=_S, iconLink=_S, size=_S)
CUSTOM_FIELD = _struct(fieldId=_S, fieldName=_S, type=_S, values=T.ArrayType(_S))
# Each landed value is an array of nodes or one bare node, so it is kept as JSON
# text and opened by functions.nested.category_nodes.
CATEGORY = _struct(fieldId=_S, fieldName=_S, values=T.ArrayType(_S))
CATEGORY_NODE = _struct(name=_S, parentId=_S)


def folder_schema(folder_id: str = "folderId", parent_id: str = "parentFolderId") -> T.StructType:
    """One folder; services spell the two identifier keys in their own way."""
    return T.StructType([
        T.StructField(folder_id, _S),
        T.StructField("fileId", _S),
        T.StructField(parent_id, _S),
        T.StructField("name", _S),
        T.StructField("folderIsRoot", _B),
        T.StructField("parentFolderIsRoot", _B),
    ])


def api_document_schema(folder: T.StructType | None = None) -> T.StructType:
    return _struct(
        id=_S, domainName=_S, libraryId=_S, libraryName=_S, title=_S,
        creationDate=_S, modificationDate=_S,
        classId=_S, className=_S, richText=_S, initialAuthor=_S, updateAuthor=_S,
        versionName=_S, versionDescription=_S, versionAuthor=_S, versionCreated=_S, iconLink=_S,
        folders=T.ArrayType(folder or folder_schema()),
        permissions=T.ArrayType(PERMISSION),
        attachments=T.ArrayType(ATTACHMENT),
        fields=T.ArrayType(CUSTOM_FIELD),
        categories=T.ArrayType(CATEGORY),
    )


def api_page_schema(folder: T.StructType | None = None) -> T.StructType:
    return _struct(documentList=T.ArrayType(api_document_schema(folder)), pageToken=_S)


COMMENT = _struct(
    createdTime=_S, modifiedTime=_S, message=_S, author=_struct(email=_S, name=_S),
)
COMMENT_PAGE = T.StructType([
    T.StructField("documentId", _S),
    T.StructField("comments", T.ArrayType(COMMENT)),
    T.StructField("nextPageToken", _S),
])

CLASS_ITEM = _struct(name=_S, value=_S)
LIBRARY = _struct(
    libraryId=_S, name=_S, domainName=_S, storageAdmin=_S,
    documentTypes=_struct(items=T.ArrayType(CLASS_ITEM)),
)
LIBRARY_PAGE = _struct(libraries=T.ArrayType(LIBRARY))
CLASS_PAGE = _struct(items=T.ArrayType(_struct(id=_S, displayName=_S)))

MAPPING_FILE = _struct(
    iDoc2Solr=T.ArrayType(
        _struct(idocField=_S, solrField=_S, dynamicSolrFieldType=_S, multi=_B)
    )
)

INVENTORY = _struct(path=_S, parent=_S, name=_S, is_dir=_B, last_modified_ms=_L, size=_L)
CRAWL_TASK = _struct(id=_S, level=T.IntegerType())
MARK = _struct(source=_S, hwm=_L, run_id=_L)

# Fixed value: the fields every API document class has.
DEFAULT_API_FIELDS = (
    "classId", "className", "richText", "initialAuthor", "updateAuthor",
    "versionName", "versionDescription", "versionAuthor", "versionCreated", "iconLink",
)

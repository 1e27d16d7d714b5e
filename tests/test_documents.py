import json

import pytest
from pyspark.sql import functions as F

from tidemark import model
from tidemark.operators import documents as docs
from tidemark.plans.api_ingest import next_marks, of_classes, plan_api, recent_documents
from tidemark.operators import numbering
from tidemark.sinks.output import catalogue, write_catalogue
from tidemark.sources import api


def document(identifier, **changes):
    base = {
        "id": identifier, "domainName": "d.example", "libraryId": "L1", "libraryName": "Library",
        "title": f"Title {identifier}", "creationDate": "1000", "modificationDate": "2000",
        "classId": "c1", "className": "Class", "iconLink": "i",
        "folders": [
            {"folderId": "2", "parentFolderId": "1", "name": "kid", "parentFolderIsRoot": True},
            {"folderId": "1", "name": "root", "folderIsRoot": True},
        ],
        "permissions": [{"type": "USER", "value": "u", "roleNames": ["Readers"]}],
        "attachments": [
            {"fileId": f"{identifier}-1", "name": "a.txt", "mimeType": "text/plain", "link": "http://x/1", "size": "5"},
            {"fileId": f"{identifier}-2", "name": "b", "mimeType": "image/png", "link": "http://x/2", "size": "big"},
        ],
        "fields": [{"fieldId": "f", "fieldName": "Tag", "type": "S", "values": ["x", "y"]},
                   {"fieldId": "g", "fieldName": "Empty", "type": "S", "values": []}],
        "categories": [{"fieldId": "c", "fieldName": "TAG", "values": [[
            {"name": "p", "parentId": "0"}, {"name": "q", "parentId": "1"}]]},
            {"fieldId": "d", "fieldName": "bare", "values": [{"name": "z"}]},
            {"fieldId": "e", "fieldName": "folder", "values": [{"name": "hidden"}]}],
    }
    base.update(changes)
    return base


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pages")
    pages = [
        {"documentList": [document("1"), document("2", permissions=None, attachments=[])], "pageToken": "t"},
        {"documentList": [
            document("3", permissions=[], creationDate="soon", folders=[{"folderId": "9", "name": "lost"}]),
            document("4", modificationDate="999", libraryId="L2", libraryName="Other"),
            document("5", modificationDate="x"),
        ]},
    ]
    for n, page in enumerate(pages):
        (folder / f"{n}.json").write_text(json.dumps(page))
    return api.read_document_pages(spark, str(folder))


def test_typed_documents(landed):
    rows = {r.doc_id: r for r in docs.api_documents(landed).collect()}
    assert (rows["1"].creation_ms, rows["1"].modification_ms, rows["1"].folder_path) == (1000, 2000, "root/kid")
    assert rows["2"].permissions == ["GU:EVERYONE"]
    assert rows["3"].permissions == [] and rows["3"].folder_path is None
    assert (rows["3"].creation_ms, rows["3"].modification_ms) == (0, 0)
    assert (rows["5"].creation_ms, rows["5"].modification_ms) == (1000, 0)
    assert [c.name for c in rows["1"].category_fields] == ["metas_tag", "metas_bare"]


def test_flat_metas_keep_all_values(landed):
    made = docs.flat_metas(docs.api_documents(landed), "store@x", comments=None)
    fields = made.where("doc_id = '1'").first().fields
    assert fields["metas_tag"] == ["x", "y", "p/q"]
    assert fields["metas_bare"] == ["z"]
    assert fields["metas_ao_permission"] == ["GU:u"]
    assert fields["metas_storage_account"] == ["store@x"]
    assert fields["metas_viewurl"][0].endswith("#Menu_viewDoc/LibraryId_L1/DocumentId_1")
    assert fields["last_modified_date"] == ["2000"]
    assert "metas_empty" not in fields and "metas_richtext" not in fields


def test_attachment_rows_and_comments(spark, landed, monkeypatch):
    pages = spark.createDataFrame([
        ("1", [("t2", "t2", "second", ("e", "n")), ("t1", "t1", "first", None)], "next"),
        ("1", [("t3", "t3", "third", None)], None),
        ("9", [], None),
    ], model.COMMENT_PAGE)
    joined = docs.comments_joined(docs.comment_rows(pages))
    monkeypatch.setattr(numbering, "PIECE", 2)
    pieces = docs.comments_joined(docs.comment_rows(pages))
    assert pieces.collect() == joined.collect() and joined.first().n_values == 3
    marks = spark.createDataFrame([("L1", 2000)], "source string, hwm bigint")
    rows = {r.id: r for r in plan_api(landed, marks, joined, "store@x", "API_").collect()}
    assert sorted(rows) == ["1-1", "1-2", "4-1", "4-2"]
    one = rows["1-2"]
    assert (one.parent_id, one.mime, one.size, one.source, one.action) == ("1", "image/png", 0, "API_Library", "UPSERT")
    assert one.fields["metas_comments"] == [
        "null _ null _ t1 _ t1 _ first|n _ e _ t2 _ t2 _ second|null _ null _ t3 _ t3 _ third"]
    assert len(plan_api(landed, marks, pieces, "store@x").where("id = '1-2'").collect()) == 1
    assert one.fields["metas_attachmentname"] == ["b"] and "metas_comments" not in rows["4-1"].fields


def test_recent_documents_and_next_marks(spark, landed):
    marks = spark.createDataFrame([("L1", 2000), ("L2", 1000)], "source string, hwm bigint")
    found = recent_documents(landed, marks)
    assert sorted(r.doc_id for r in found.collect()) == ["1", "2"]
    typed = docs.api_documents(landed)
    assert sorted(tuple(r) for r in next_marks(typed, 77).collect()) == [("L1", 77), ("L2", 77)]
    classes = spark.createDataFrame([("L2", "k")], "libraryId string, class_id string")
    assert of_classes(typed.withColumn("class_id", F.lit("k")), classes).first().doc_id == "4"


def test_other_key_names_for_folders(spark):
    text = json.dumps({"id": "1", "folders": [
        {"fid": "1", "name": "root", "folderIsRoot": True}, {"fid": "2", "pid": "1", "name": "kid"}]})
    df = spark.createDataFrame([(text,), ("{broken",)], "t string")
    parsed = api.parse_documents(df, "t", model.folder_schema("fid", "pid"))
    typed = docs.api_documents(parsed, folder_id="fid", parent_id="pid").collect()
    assert typed[0].folder_path == "root/kid"
    assert typed[1].doc_id is None


def test_exactly_one_page_of_comments_appears_once(spark):
    comments = [(f"t{i:02d}", f"t{i:02d}", str(i), None) for i in range(25)]
    pages = spark.createDataFrame([("1", comments, None)], model.COMMENT_PAGE)
    row = docs.comments_joined(docs.comment_rows(pages)).first()
    assert row.n_values == 25 and row.comments.count("|") == 24


def test_row_documents_long_form_and_dump(spark):
    df = spark.createDataFrame([(1, "a", None), (None, "b", "c")], "k int, A string, b string")
    made = docs.row_documents(df, ["k"], "svc", "a")
    assert [(r.id, r.source, r.temp_path, r.fields) for r in made.collect()] == [
        ("1", "JDBC://svc", "a", {"k": ["1"], "A": ["a"]})]
    long = sorted(tuple(r) for r in docs.to_long(made).collect())
    assert long == [("1", "A", 0, "a"), ("1", "k", 0, "1")]
    dumped = sorted(tuple(r) for r in docs.dump(made, ["source", "temp_path"]).collect())
    assert ("1", "source", 0, "JDBC://svc") in dumped and len(dumped) == 4


def test_hier_fields(spark):
    kind = "id string, path string, fields map<string,array<string>>"
    df = spark.createDataFrame([("1", "/a/b.txt", {"place": ["x/y"]}), ("2", None, {"other": ["z"]})], kind)
    rows = {r.id: r.fields for r in docs.add_hier_fields(df, "place,filepath", file_path="path").collect()}
    assert rows["1"]["_hier_place"] == ["0/x/", "1/x/y/"]
    assert rows["1"]["_hier_filepath"] == ["0//", "1//a/"]
    assert rows["2"] == {"other": ["z"]}
    with pytest.raises(ValueError):
        docs.add_hier_fields(df, "")


def test_constants_and_dropped_fields(spark):
    df = spark.createDataFrame([("1", {"a": ["1"], "s": ["x"]})], "id string, fields map<string,array<string>>")
    got = docs.add_constants(docs.drop_field(df, "s"), {"c": "v"}).first().fields
    assert got == {"a": ["1"], "c": ["v"]}


def test_bodies_join_by_path_domain_and_cap(spark):
    wanted = spark.createDataFrame([
        ("1", "/f/a", None), ("2", "/f/big", None), ("3", "smb://s/b", "CORP"), ("4", "smb://s/b", "OTHER"),
        ("5", None, None), ("6", "/none", None)], "id string, temp_path string, domain string")
    bodies = spark.createDataFrame(
        [("/f/a", 3, "abc"), ("/f/big", 99, "z" * 99), ("smb://s/b", 1, "b")], "path string, length bigint, content string")
    got = {r.id: r.body for r in docs.attach_body(wanted, bodies, cap=10, domain="domain", configured_domain="CORP").collect()}
    assert got == {"1": "abc", "2": None, "3": "b", "4": None, "5": None, "6": None}


def test_attachment_children(spark):
    kind = "id string, attachments array<struct<mime:string,long_name:string,short_name:string>>, tag string"
    df = spark.createDataFrame([("m", [("image/png", "i", None), (None, "a b", None), ("IMAGE/x", "j", None),
                                       ("text/x", None, None)], "t"), ("n", [], "t")], kind)
    rows = docs.expand_attachments(df, keep=["tag"]).collect()
    assert [(r.id, r.parent_id, r.ordinal, r.tag) for r in rows] == [
        ("m -_ a_b", "m", 1, "t"), ("m -_  NO FILENAME [2]", "m", 2, "t")]
    assert [r[0] for r in df.select(docs.attachment_count()).collect()] == [2, 0]


def test_class_list_and_libraries(spark, tmp_path, monkeypatch):
    (tmp_path / "classes.json").write_text(json.dumps({"items": [
        {"id": "1", "displayName": "A"}, {"id": "1", "displayName": "A"}, {"id": "2"}, {"displayName": "x"}]}))
    pages = api.read_class_pages(spark, str(tmp_path / "classes.json"))
    assert [tuple(r) for r in docs.class_list(pages).collect()] == [("1", "A", "1:::A")]
    (tmp_path / "libs.json").write_text(json.dumps({"libraries": [
        {"libraryId": "L", "name": "N", "domainName": "d", "storageAdmin": "s",
         "documentTypes": {"items": [{"name": "A", "value": "1"}, {"name": "B", "value": "2"}]}},
        {"name": "no id"}]}))
    libs = docs.libraries(api.read_library_pages(spark, str(tmp_path / "libs.json")))
    classes = docs.library_classes(libs)
    assert sorted((r.libraryId, r.class_name, r.class_id) for r in classes.collect()) == [("L", "A", "1"), ("L", "B", "2")]
    write_catalogue(classes, str(tmp_path / "out"))
    back = spark.read.schema(model.LIBRARY).json(str(tmp_path / "out")).first()
    assert [tuple(i) for i in back.documentTypes.items] == [("A", "1"), ("B", "2")]
    assert json.loads(docs.library_json(libs).first().task)["documentTypes"]["items"][1] == {"name": "B", "value": "2"}
    monkeypatch.setattr(numbering, "PIECE", 1)
    assert [[i.name for i in r.documentTypes.items] for r in catalogue(classes).collect()] == [["A", "B"]]


def test_landed_comment_pages_are_read(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"documentId": "1", "comments": [
        {"createdTime": "t1", "modifiedTime": "t1", "message": "hi", "author": None}], "nextPageToken": "n"}))
    pages = api.read_comment_pages(spark, str(tmp_path / "c.json"))
    assert docs.comments_joined(docs.comment_rows(pages)).first().comments == "null _ null _ t1 _ t1 _ hi"

import pytest
from pyspark.sql import functions as F

from tidemark import functions as fn
from tidemark.functions.nested import folder_chain


def one(spark, column, value=None, kind="string"):
    row = spark.createDataFrame([(value,)], f"v {kind}").select(column.alias("r")).first()
    return row.r


LONG = r"D:\folder\subfolder\more \another folder here\long folder with & in the name"


@pytest.mark.parametrize(
    "path, separator, count, last",
    [
        (LONG, r"\\", 6, "5/D:/folder/subfolder/more /another folder here/long folder with & in the name/"),
        ("smb://host/testdocs/another folder here/long folder with & in the name", "/", 4,
         "3/host/testdocs/another folder here/long folder with & in the name/"),
        ("/a/b/", "/", 3, "2//a/b/"),
        ("", "/", 1, "0//"),
        ("/", "/", 0, None),
        (None, "/", 0, None),
        ('"a"/b', "/", 2, "1/a/b/"),
        ("file:///a/b", "/", 3, "2//a/b/"),
        ("a//b", "/", 3, "2/a//b/"),
        (r"a/x\b", r"\\", 2, "1/a%2Fx/b/"),
    ],
)
def test_hier_facets(spark, path, separator, count, last):
    facets = one(spark, fn.hier_facets("v", separator), path)
    assert len(facets) == count
    assert (facets[-1] if facets else None) == last


@pytest.mark.parametrize(
    "raw, root, stored",
    [
        (r"\\server\share\x", "smb://server/share/x/", "/smb://server/share/x"),
        ("smb:\\\\server\\x", "smb://server/x/", None),
        ("smb://s/p", "smb://s/p/", "smb://s/p"),
        ("/p", "file:///p/", "/p"),
        ("/p/", "file:///p/", "/p"),
        ("D:\\x", "file://D:/x/", "D:/x"),
        ("D:/x", "file://D:/x/", "D:/x"),
        ("D:", "file://D:/", "D:"),
    ],
)
def test_roots(spark, raw, root, stored):
    assert one(spark, fn.normalise_root("v"), raw) == root
    if stored and not raw.startswith("\\"):
        assert one(spark, fn.crate_path(fn.normalise_root("v")), raw) == stored


@pytest.mark.parametrize(
    "path, extension, parent, name",
    [
        ("/a.b/c", None, "/a.b", "c"),
        ("/a/c.txt", "txt", "/a", "c.txt"),
        ("/a/c.", None, "/a", "c."),
        ("/a/c.tar.gz", "gz", "/a", "c.tar.gz"),
        ("plain", None, "plain", "plain"),
        ("/top", None, "/top", "top"),
    ],
)
def test_path_parts(spark, path, extension, parent, name):
    assert one(spark, fn.extension("v"), path) == extension
    assert one(spark, fn.parent_folder("v"), path) == parent
    assert one(spark, fn.file_name("v"), path) == name


def test_ancestors(spark):
    assert one(spark, fn.ancestors("v"), "/a/b/c.txt") == ["/a", "/a/b"]
    assert one(spark, fn.ancestors("v", 1), "/a/b/c.txt") == ["/a/b"]
    assert one(spark, fn.ancestors("v"), "/a") == []


@pytest.mark.parametrize(
    "text, expected",
    [
        ("/a/b.txt_:_12_:_5", ("/a", "b.txt", 12, 5)),
        (r"C:\a\b_:_1_:_x", ("C:/a", "b", 1, 0)),
        ("a/b_:_ 7_:_1.5", ("a", "b", 0, 0)),
        ("a/b_:_7", ("a", "b", 0, 0)),
        ("b_:_1_:_2", None),
        ("a/b", None),
    ],
)
def test_parse_leaf(spark, text, expected):
    leaf = one(spark, fn.parse_leaf("v"), text)
    assert (tuple(leaf) if leaf else None) == expected


def test_leaf_round_trip(spark):
    df = spark.createDataFrame([("/a/b c.txt", 17, 3)], "p string, m bigint, s bigint")
    leaf = df.select(fn.parse_leaf(fn.leaf_text("p", "m", "s")).alias("l")).first().l
    assert tuple(leaf) == ("/a", "b c.txt", 17, 3)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert one(spark, fn.zulu_to_ms("v"), "2020-06-01T10:20:30Z") == 1591006830000
        assert one(spark, fn.utc_minute("v"), 1591006830000, "bigint") == "2020-06-01T10:20Z"
        assert one(spark, fn.ms_to_zulu("v"), 1591006830000, "bigint") == "2020-06-01T10:20:30Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("bad", ["", "yesterday", "2020-06-01", "2020-13-01T00:00:00Z", None])
def test_bad_times_are_zero(spark, bad):
    assert one(spark, fn.zulu_to_ms("v"), bad) == 0


@pytest.mark.parametrize("text, value", [("12", 12), ("-3", -3), (" 12", 0), ("1.5", 0), ("", 0), (None, 0),
                                         ("99999999999999999999", 0)])
def test_numbers(spark, text, value):
    assert one(spark, fn.parse_epoch_ms("v"), text) == value


def test_size_is_an_int(spark):
    assert one(spark, fn.parse_size("v"), "2147483648") == 0
    assert one(spark, fn.parse_size("v"), "2147483647") == 2147483647


def test_seconds_ignore_milliseconds(spark):
    assert one(spark, fn.seconds("v"), 1999, "bigint") == 1


def test_child_ids(spark):
    df = spark.createDataFrame(
        [("m", "a b?.txt", "x", 1), ("m", None, "x y", 2), ("m", None, None, 3)],
        "p string, l string, s string, n int",
    )
    got = [r[0] for r in df.select(fn.child_id("p", "l", "s", "n")).collect()]
    assert got == ["m -_ a_b_.txt", "m -_ x_y", "m -_  NO FILENAME [3]"]


def test_doc_id_skips_nulls(spark):
    df = spark.createDataFrame([(1, None, "z"), (None, None, None)], "a int, b int, c string")
    assert [r[0] for r in df.select(fn.doc_id("a", "b", "c")).collect()] == ["1,z", None]


@pytest.mark.parametrize(
    "mime, export",
    [
        ("application/vnd.google-apps.document", "text/plain"),
        ("application/vnd.google-apps.SpreadSheet",
         "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet"),
        ("application/vnd.google-apps.drawing", "application/pdf"),
        ("application/vnd.google-apps.pdf", "application/pdf"),
        ("application/vnd.google-apps.appscript", "application/vnd.google-apps.script+json"),
        ("application/vnd.google-apps.presentation", "application/pdf"),
        ("text/html", "text/html"),
        (None, None),
    ],
)
def test_export_mime(spark, mime, export):
    assert one(spark, fn.export_mime("v"), mime) == export


def test_final_mime(spark):
    native = "application/vnd.google-apps.document"
    rows = [(native, 5), (native, 0), ("application/vnd.google-apps.drawing", 5)]
    df = spark.createDataFrame(rows, "m string, n int")
    assert [r[0] for r in df.select(fn.final_mime("m", "n")).collect()] == [
        "text/plain", native, "application/vnd.google-apps.drawing"]


def test_meta_entry_removes_escape_texts(spark):
    df = spark.createDataFrame([("n", "a\\nb\\rc\nd")], "k string, v string")
    assert df.select(fn.meta_entry("k", "v")).first()[0] == "n=abc\nd"


def test_class_token(spark):
    df = spark.createDataFrame([("1", "Name"), ("2", None)], "i string, n string")
    assert [r[0] for r in df.select(fn.class_token("i", "n")).collect()] == ["1:::Name", None]
    assert one(spark, fn.split_class_token("v"), "1:::A:::B") == ["1", "A:::B"]


FOLDERS = (
    "array<struct<folderId:string,parentFolderId:string,name:string,"
    "folderIsRoot:boolean,parentFolderIsRoot:boolean>>"
)


@pytest.mark.parametrize(
    "folders, path",
    [
        ([("2", "1", "kid", False, True), ("3", "2", "gr/and", False, False), ("1", None, "root", True, False)],
         "root/kid/gr%2Fand"),
        ([("A2", "1", "kid", False, True), ("3", "a2", "grand", False, None), ("1", None, "root", True, None)],
         "root/kid/grand"),
        ([("1", None, "root", True, False)], "root"),
        ([("2", "1", "kid", False, True)], None),
        ([("1", None, "root", True, False), ("2", "9", "lost", False, False)], "root"),
        ([("1", "2", "root", True, False), ("2", "1", "loop", False, True)], "root/loop"),
        ([], None),
        (None, None),
    ],
)
def test_folder_chain(spark, folders, path):
    assert one(spark, fn.folder_path(fn.folder_chain("v")), folders, FOLDERS) == path


@pytest.mark.parametrize(
    "values, expected",
    [
        (['[{"name":"a","parentId":"0"},{"name":"b","parentId":"1"},{"name":"c","parentId":"2"}]'], ["a/b/c"]),
        (['[{"name":"a","parentId":"0"},{"name":"b","parentId":"1"},{"name":"c","parentId":"0"},{"name":"d","parentId":"3"}]'],
         ["a/b", "c/d"]),
        (['[{"name":"orphan","parentId":"9"}]'], ["orphan"]),
        (['{"name":"bare"}', ' {"name":"bare2","parentId":"4"}'], ["bare", "bare2"]),
        (['[{"name":null,"parentId":"0"},{"name":"x","parentId":"0"}]'], ["x"]),
        (["not json"], []),
        ([], []),
    ],
)
def test_category_values(spark, values, expected):
    got = one(spark, fn.category_values(fn.category_nodes("v")), values, "array<string>")
    assert got == expected


PERMISSIONS = "array<struct<type:string,value:string,roleNames:array<string>>>"


@pytest.mark.parametrize(
    "permissions, expected",
    [
        (None, ["GU:EVERYONE"]),
        ([], []),
        ([("User", "b", ["Readers"]), ("GROUP", "a", ["x", "Readers"]), ("user", "b", ["Readers"])],
         ["GG:a", "GU:b", "GU:b"]),
        ([("USER", "b", ["readers"]), ("DOMAIN", "c", ["Readers"]), ("USER", "d", None)], []),
        ([("USER", None, ["Readers"])], ["GU:null"]),
    ],
)
def test_permission_tokens(spark, permissions, expected):
    assert one(spark, fn.permission_tokens("v"), permissions, PERMISSIONS) == expected


COMMENT = "struct<createdTime:string,modifiedTime:string,message:string,author:struct<email:string,name:string>>"


def test_comment_rendering(spark):
    full, bare = ("t1", "t2", 'say "hi"', ("e", "n")), ("t1", "t2", None, None)
    assert one(spark, fn.comment_text("v"), full, COMMENT) == 'n _ e _ t1 _ t2 _ say "hi"'
    assert one(spark, fn.comment_text("v"), bare, COMMENT) == "null _ null _ t1 _ t2 _ null"
    assert one(spark, fn.comment_json("v"), bare, COMMENT) == (
        '{"author":null,"authorEmail":null,"createdTime":"t1","modifiedTime":"t2","message":null}')


def test_merge_entries_keeps_every_value(spark):
    kind = "array<struct<name:string,values:array<string>>>"
    items = [("a", ["1"]), ("b", ["2", None]), ("a", ["3"]), ("c", []), ("d", None), (None, ["x"])]
    assert one(spark, fn.merge_entries(F.col("v")), items, kind) == {"a": ["1", "3"], "b": ["2"]}


def test_extend_fields(spark):
    kind = "struct<f:map<string,array<string>>,e:array<struct<name:string,values:array<string>>>>"
    got = lambda f, e: one(spark, fn.extend_fields(F.col("v.f"), F.col("v.e")), (f, e), kind)
    assert got({"a": ["1"]}, [("b", ["2"])]) == {"a": ["1"], "b": ["2"]}
    assert got({"a": ["1"]}, [("a", ["2"])]) == {"a": ["1", "2"]}
    assert got({"a": ["1"]}, [("b", [])]) == {"a": ["1"]}


def test_a_long_folder_chain_is_whole(spark):
    folders = [(f"f{i}", f"f{i - 1}" if i else None, f"n{i}", i == 0, i == 1) for i in range(150)]
    kind = "folderId string, parentFolderId string, name string, folderIsRoot boolean, parentFolderIsRoot boolean"
    df = spark.createDataFrame([(folders,)], f"f array<struct<{kind.replace(' ', ':').replace(',:', ',')}>>")
    assert df.select(folder_chain("f").alias("n")).first().n == [f"n{i}" for i in range(150)]

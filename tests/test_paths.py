import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import treeferry as tf
from treeferry.functions.paths import depth_of, folder_of
from treeferry.session import qualify


def values(spark, texts, column):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [row["v"] for row in rows.select("i", column.alias("v")).orderBy("i").collect()]


def test_golden_mapping(spark):
    root = "hdfs://h:8020/user/etl/data"
    target = "hdfs://h:8020/user/etl/data2"
    found = values(
        spark,
        [root, root + "/info.dat", root + "/info2.dat"],
        tf.map_destination("t", root, target),
    )
    assert found == [target + "/data", target + "/data/info.dat", target + "/data/info2.dat"]


@pytest.mark.parametrize(
    "uri, root, target, expected",
    [
        ("hdfs://a/x", "hdfs://a/x", "hdfs://b/", "hdfs://b/x"),
        ("hdfs://a/x/y", "hdfs://a/x", "hdfs://b/", "hdfs://b/x/y"),
        ("hdfs://a/", "hdfs://a/", "hdfs://b/t", "hdfs://b/t"),
        ("hdfs://a/f", "hdfs://a/", "hdfs://b/t", "hdfs://b/t/f"),
        ("file:///d/a:b/c d%20", "file:///d/a:b", "file:///t", "file:///t/a:b/c d%20"),
    ],
)
def test_mapping_edges(spark, uri, root, target, expected):
    assert values(spark, [uri], tf.map_destination("t", root, target)) == [expected]


@pytest.mark.parametrize("uri", ["hdfs://z/x/f", "hdfs://a/xy", "hdfs://a/"])
def test_mapping_outside_the_root_is_an_error(spark, uri):
    with pytest.raises(Exception, match="is not below"):
        values(spark, [uri], tf.map_destination("t", "hdfs://a/x", "hdfs://b/t"))


def test_qualify(spark):
    cases = {
        "a//b/": "hdfs://nn:1/user/u/a/b",
        "/x/./y/../z": "hdfs://nn:1/x/z",
        "hdfs://other/": "hdfs://other/",
        "hdfs:///q/w": "hdfs://nn:1/q/w",
        "file:/x y/%20": "file:///x y/%20",
        "file:///": "file:///",
        "s3a://bucket": "s3a://bucket/",
        "//host/p": "hdfs://host/p",
        "dir/na:me": "hdfs://nn:1/user/u/dir/na:me",
        "../v": "hdfs://nn:1/user/v",
    }
    assert values(spark, list(cases), tf.qualify_path("t", "hdfs://nn:1", "/user/u")) == list(cases.values())


PATHS = st.text("ab/.:% ", min_size=1, max_size=12) | st.builds(
    "".join, st.tuples(st.sampled_from(["hdfs:", "file:", "s3a:", ""]), st.sampled_from(["//h", "//", ""]), st.text("ab/.", max_size=8))
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(PATHS, min_size=5, max_size=40))
def test_driver_and_column_qualify_alike(spark, paths):
    expected = {}
    for path in paths:
        try:
            expected[path] = qualify(path, "hdfs://nn:1", "/user/u")
        except ValueError:
            pass
    assert values(spark, list(expected), tf.qualify_path("t", "hdfs://nn:1", "/user/u")) == list(expected.values())


@pytest.mark.parametrize("path, message", [("", "no path"), ("hdfs:x/y", "relative path")])
def test_qualify_errors(spark, path, message):
    with pytest.raises(Exception, match=message):
        values(spark, [path], tf.qualify_path("t", "hdfs://nn:1", "/user/u"))
    with pytest.raises(ValueError, match=message):
        qualify(path, "hdfs://nn:1", "/user/u")


@pytest.mark.parametrize(
    "parent, child, expected",
    [
        ("hdfs://n/a", "hdfs://n/a", True),
        ("hdfs://n/a", "hdfs://n/a/b", True),
        ("hdfs://n/a", "hdfs://n/ab", False),
        ("hdfs://n/a/", "hdfs://n/a", False),
        ("hdfs://n/a/", "hdfs://n/a/b", True),
        ("hdfs://n/a", "hdfs://n/a/", True),
        ("hdfs://n/", "hdfs://n/", True),
        ("hdfs://n/", "hdfs://n/q", True),
        ("hdfs://n/a", "hdfs://m/a/b", False),
        ("hdfs://n/a", "file://n/a/b", False),
        ("HDFS://n/a/x/..", "hdfs://n/a/b", True),
    ],
)
def test_uri_is_child(spark, parent, child, expected):
    row = spark.createDataFrame([(parent, child)], "p string, c string")
    assert row.select(tf.uri_is_child("p", "c")).first()[0] is expected


@pytest.mark.parametrize("bad, message", [("/a/b", "no scheme"), ("mailto:x", "no absolute path")])
def test_uri_is_child_needs_absolute_uris(spark, bad, message):
    row = spark.createDataFrame([("hdfs://n/a", bad)], "p string, c string")
    with pytest.raises(Exception, match=message):
        row.select(tf.uri_is_child("p", "c")).collect()


def test_classify(spark):
    rows = spark.createDataFrame([("a", True, False), ("b", False, True)], "u string, d boolean, f boolean")
    kinds = rows.select(tf.classify_file_type("d", "f", "u").alias("file_type"))
    typed = kinds.select("file_type", tf.is_directory(), tf.is_file()).collect()
    assert [tuple(row) for row in typed] == [("directory", True, False), ("file", False, True)]
    neither = spark.createDataFrame([("pipe", False, False)], "u string, d boolean, f boolean")
    with pytest.raises(Exception, match="pipe is neither"):
        neither.select(tf.classify_file_type("d", "f", "u")).collect()


def test_ancestors_and_their_copies(spark):
    root, target = "hdfs://h/user/data", "hdfs://k/t"
    chain = tf.ancestor_dependencies("t", root)
    found = values(spark, [root, root + "/f", root + "/a/b/f"], F.transform(chain, lambda a: a["uri"]))
    assert found == [[], [root], [root, root + "/a", root + "/a/b"]]
    copies = values(spark, [root + "/a/f"], tf.dependent_copies(chain, root, target))
    assert [tuple(c) for c in copies[0]] == [(root, target + "/data"), (root + "/a", target + "/data/a")]
    whole = values(spark, ["hdfs://h/a/f"], F.transform(tf.ancestor_dependencies("t", "hdfs://h/"), lambda a: a["uri"]))
    assert whole == [["hdfs://h/", "hdfs://h/a"]]


def test_exclude(spark):
    kept = ["/a/part-0", "/a/x_temporary/f", "/a/_temporary2", "/a/_SUCCES"]
    dropped = ["/a/_temporary", "/a/_temporary/0/f", "/a/_SUCCESS", "/a/_SUCCESS.crc", "/a/_committed_1", "/a/_started1"]
    rows = spark.createDataFrame([(f"file://{p}",) for p in kept + dropped], "uri string")
    assert sorted(r["uri"] for r in tf.exclude_paths(rows).collect()) == sorted(f"file://{p}" for p in kept)
    assert tf.exclude_paths(rows, ()).count() == len(kept + dropped)


NAMES = st.lists(st.text("ab .:%_~é$\\", min_size=1, max_size=4).filter(lambda t: t not in (".", "..")), min_size=1, max_size=5)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(NAMES, min_size=1, max_size=8))
def test_mapping_agrees_with_plain_string_work(spark, trees):
    root, target = "hdfs://h/lake/raw", "hdfs://k/backup"
    uris = [root + "/" + "/".join(names) for names in trees]
    assert values(spark, uris, tf.map_destination("t", root, target)) == [target + u[len("hdfs://h/lake"):] for u in uris]
    assert values(spark, uris, folder_of("t")) == [u[: u.rindex("/") + 1] for u in uris]
    assert values(spark, uris, depth_of("t")) == [u.count("/") for u in uris]
    ancestors = values(spark, uris, F.transform(tf.ancestor_dependencies("t", root), lambda a: a["uri"]))
    assert ancestors == [["/".join([root, *names[:i]]) for i in range(len(names))] for names in trees]
    assert values(spark, uris, tf.qualify_path("t", "file:///", "/")) == uris

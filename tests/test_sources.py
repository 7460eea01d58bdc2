import csv
import datetime
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankflow.catalog import QUERIES
from rankflow.operators.aggregates import last_write_wins
from rankflow.plans import pair_features_from_files, score_list_files, recommend_hotels, submit_hotels, interactions_and_requests
from rankflow.sources import (
    PASSENGER_SCHEMA,
    append_field,
    audit_csv,
    audit_rows,
    head_sample,
    interaction_schema,
    new_folder,
    prepend_field,
    read_by_name,
    read_declared,
    read_inferred,
    read_lines,
    read_list_file,
    read_quoted,
    without_fields,
    write_csv,
    write_parquet,
)
from rankflow.sources.audit import read_clean, split_faulty
from rankflow.sources.inference import infer_types
from rankflow.sources.workspace import Workspace, close_session_workspace, remove_folder, shared_folder, stored
from tests.conftest import TESTDATA

SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType(), False),
        T.StructField("name", T.StringType()),
        T.StructField("price", T.FloatType()),
        T.StructField("seen", T.TimestampType()),
    ]
)


def test_schema_variants():
    train, test = interaction_schema(True), interaction_schema(False)
    assert len(train) == 24 and train.fields[-1].name == "hotel_cluster"
    assert len(test) == 24 and test.fields[0].name == "id"
    assert train.fieldNames()[:-1] == test.fieldNames()[1:]
    assert not train["date_time"].nullable and not train["user_id"].nullable and train["cnt"].nullable
    assert train["orig_destination_distance"].dataType == T.FloatType()
    assert len(PASSENGER_SCHEMA) == 12
    assert "Survived" not in without_fields(PASSENGER_SCHEMA, ["Survived"]).fieldNames()
    key = T.StructField("k", T.LongType())
    assert append_field(SCHEMA, key).fieldNames()[-1] == prepend_field(SCHEMA, key).fieldNames()[0] == "k"


def test_binding_by_name(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('extra,seen,name,id\nz,2014-08-11 07:46:59,"a, b",1\nz,not a time,,2\n')
    first, second = read_by_name(spark, str(path), SCHEMA).collect()
    assert tuple(first) == (1, "a, b", None, datetime.datetime(2014, 8, 11, 7, 46, 59))
    assert tuple(second) == (2, None, None, None)
    with pytest.raises(Exception):
        read_by_name(spark, str(path), SCHEMA, strict=True).collect()


@pytest.mark.parametrize("value", ["xx", ""])
def test_required_values_that_do_not_parse_fail_the_query(spark, tmp_path, value):
    (tmp_path / "a.csv").write_text(f"id,name,price,seen\n1,x,,\n{value},y,,\n")
    for read in (read_by_name, read_declared):
        with pytest.raises(Exception, match="id is required"):
            read(spark, str(tmp_path / "a.csv"), SCHEMA).collect()


def test_every_reader_gives_back_what_the_writer_wrote(spark, tmp_path):
    rows = [(3, 'say "hi", ok', 7.5), (4, 'a, "b", "c", d', None), (6, None, 2.0), (7, " x\\", 3.0)]
    df = spark.createDataFrame(rows, "id int, name string, price double")
    path = str(tmp_path / "out")
    write_csv(df, path)
    for read in (read_by_name, read_declared, read_quoted):
        assert sorted(map(tuple, read(spark, path, df.schema).collect())) == rows
    assert sorted(map(tuple, read_inferred(spark, path).collect())) == rows
    write_csv(spark.createDataFrame([(5, "", 1.0)], df.schema), path)
    assert read_by_name(spark, path, df.schema).first().name is None


def test_microseconds_survive_a_file(spark, tmp_path):
    df = spark.sql("SELECT 1 AS id, TIMESTAMP_NTZ'2024-01-01 00:00:07.179575' AS a, TIMESTAMP'2024-01-01 00:00:07.179575' AS b")
    write_csv(df, str(tmp_path / "out"))
    assert read_by_name(spark, str(tmp_path / "out"), df.schema).collect() == df.collect()


def test_list_ids_and_tokens(spark, tmp_path):
    (tmp_path / "p.csv").write_text("3000000000,1 2\n3000000001,3\n")
    (tmp_path / "a.csv").write_text("3000000000,2 1\n3000000001,3\n")
    score = lambda p: score_list_files(spark, str(tmp_path / p), str(tmp_path / "a.csv")).first()["map"]
    assert score("p.csv") == 1.0
    for bad in ("1,x 2\n", "x,1\n", ",1\n"):
        (tmp_path / "bad.csv").write_text(bad)
        with pytest.raises(Exception, match="not an integer|id is required"):
            score("bad.csv")


def test_part_files_go_by_number(spark, tmp_path):
    for number, value in ((99999, 1), (100000, 2), (100001, 3)):
        (tmp_path / f"part-{number:05d}-x.csv").write_text(f"7,{value}\n")
    lines = read_list_file(spark, str(tmp_path))
    assert last_write_wins(lines, "id", ["items"], "seq").first()["items"] == "3"


def test_a_sample_whose_writing_broke_off_is_written_again(spark, tmp_path):
    path = tmp_path / "sample"
    path.mkdir()
    assert head_sample(spark.range(50), str(path), ["id"], 3).count() == 3
    assert head_sample(spark.range(50), str(path), ["id"], 9).count() == 3


def test_files_with_required_gaps_are_refused_before_load(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name,price,seen\n1,x,,\n,y,,\n3,z\n")
    with pytest.raises(ValueError, match="id"):
        read_clean(spark, str(tmp_path / "a.csv"), SCHEMA)


def test_missing_required_column(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name,price\nx,1\n")
    with pytest.raises(ValueError, match="id"):
        read_by_name(spark, str(tmp_path / "a.csv"), SCHEMA)


def test_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n")
    (tmp_path / "b.csv").write_text("name,id\ny,2\n")
    with pytest.raises(Exception):
        read_by_name(spark, str(tmp_path), SCHEMA).collect()


def test_declared_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name,price,seen\n1,x,2.5,2014-01-01 00:00:00\n2,y,bad,\n")
    rows = read_declared(spark, str(tmp_path / "a.csv"), SCHEMA).collect()
    assert [(r.id, r.name, r.price) for r in rows] == [(1, "x", 2.5), (2, "y", None)]


def test_inferred_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name,price\n1,x,2.5\n2,y,3\n")
    df = read_inferred(spark, str(tmp_path / "a.csv"))
    assert [f.dataType.simpleString() for f in df.schema] == ["int", "string", "double"]


QUOTED = 'id,title\n1,"a ""big"" one, really"\n2,"two\nlines"\n'


def test_quoted_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text(QUOTED)
    df = read_quoted(spark, str(tmp_path / "a.csv"), multiline=True)
    assert [tuple(r) for r in df.orderBy("id").collect()] == [(1, 'a "big" one, really'), (2, "two\nlines")]


def test_malformed_line_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,title\n1,x\n2,y,z\n")
    with pytest.raises(Exception):
        read_quoted(spark, str(tmp_path / "a.csv"), T.StructType.fromDDL("id INT, title STRING")).collect()
    with pytest.raises(Exception):
        read_quoted(spark, str(tmp_path / "a.csv")).select("id").collect()


def test_lines_keep_their_order(spark, conf, tmp_path):
    (tmp_path / "a.txt").write_text("\n".join(str(i) for i in range(5000)) + "\n")
    conf("spark.sql.files.maxPartitionBytes", "3000")
    lines = read_lines(spark, str(tmp_path / "a.txt"))
    assert [int(r.value) for r in lines.orderBy("seq").collect()] == list(range(5000))
    first = head_sample(lines, str(tmp_path / "head"), ["seq"], 10)
    assert sorted(int(r.value) for r in first.collect()) == list(range(10))


def test_head_sample_is_made_once(spark, tmp_path):
    df = spark.range(100)
    path = str(tmp_path / "head")
    assert head_sample(df, path, ["id"], 5).count() == 5
    again = head_sample(df, path, [F.desc("id")], 50)
    assert sorted(r.id for r in again.collect()) == [0, 1, 2, 3, 4]


def test_written_csv_is_sorted_across_files(spark, conf, tmp_path):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(2000).select(F.hash("id").alias("id"), F.lit(" padded ").alias("text"))
    write_csv(df, str(tmp_path / "out"), order_by=["id"])
    files = sorted((tmp_path / "out").glob("part-*.csv"))
    assert len(files) > 1
    ids = [int(line.split(",")[0]) for f in files for line in f.read_text().splitlines()[1:]]
    assert ids == sorted(ids) and len(ids) == 2000
    back = read_declared(spark, str(tmp_path / "out"), df.schema)
    assert back.exceptAll(df).count() == 0 and back.first().text == " padded "


def test_rows_of_one_sort_key_fill_several_files(spark, conf, tmp_path):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(4000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    write_csv(df, str(tmp_path / "out"), order_by=["k"])
    files = sorted((tmp_path / "out").glob("part-*.csv"))
    keys = [[int(line.split(",")[0]) for line in f.read_text().splitlines()[1:]] for f in files]
    assert sum(7 in part for part in keys) > 2
    assert [k for part in keys for k in part] == sorted(k for part in keys for k in part)


def test_writers_overwrite(spark, tmp_path):
    for n in (5, 3):
        write_parquet(spark.range(n), str(tmp_path / "p"))
        write_csv(spark.range(n), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 3
    assert read_inferred(spark, str(tmp_path / "c")).count() == 3


def test_audit(spark):
    df = spark.createDataFrame(
        [("2014-01-01", "1", "a"), (None, "x", "b"), ("", None, "c"), ("soon", "2", None)],
        "day string, n string, other string",
    )
    rows = {r.column: (r.missing, r.unparseable) for r in audit_rows(df, ["day", "other"], {"day": "date", "n": "int"}).collect()}
    assert rows == {"day": (2, 1), "other": (1, 0), "n": (0, 1)}


def test_audit_of_a_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name,id,seen\nx,1,2014-01-01 00:00:00\ny,z,never\nw,,\nv,4,,5\nu,6\n")
    result = audit_csv(spark, str(tmp_path / "a.csv"), SCHEMA)
    assert {r.column: (r.missing, r.unparseable) for r in result.collect()} == {
        "id": (1, 1),
        "seen": (0, 1),
        "_malformed": (0, 2),
    }


def test_shared_folder_comes_from_the_session():
    class Session:
        """A cluster session, with and without the setting."""

        def __init__(self, setting):
            self.conf = {"spark.checkpoint.dir": setting, "spark.sql.warehouse.dir": "hdfs://wh"}
            self.sparkContext = self
            self.master = "yarn"

        def getCheckpointDir(self):
            return None

    named = Session("hdfs://shared/folder/")
    assert shared_folder(named) == "hdfs://shared/folder/"
    first, second = new_folder(named, "x"), new_folder(named, "x")
    assert first.startswith("hdfs://shared/folder/x-") and first != second
    assert shared_folder(Session(None)) == "hdfs://wh/_rankflow"


def test_shared_folders_can_be_stored_to_and_removed(spark):
    rows = stored(spark.range(3), "numbers")
    assert sorted(r.id for r in rows.collect()) == [0, 1, 2]
    path = new_folder(spark, "gone")
    spark.range(1).write.parquet(path)
    assert remove_folder(spark, path) and not remove_folder(spark, path)
    with pytest.raises(ValueError, match="shared folder"):
        remove_folder(spark, "/root/testdata")


# --- whole files in, whole files out ---------------------------------------------------------

HEADER = [f.name for f in interaction_schema(True).fields]


def interaction_line(**values):
    row = {"date_time": "2014-05-01 10:00:00", "user_id": 1, "is_booking": 0, "cnt": 1, **values}
    return ",".join(str(row.get(name, "")) for name in HEADER)


def write_contest_files(tmp_path):
    place = dict(user_location_city=5, orig_destination_distance=12.3456)
    there = dict(srch_destination_id="8", hotel_country=50, hotel_market=600)
    train = [
        interaction_line(**place, **there, hotel_cluster=1),
        interaction_line(**place, **there, hotel_cluster=1),
        interaction_line(**place, **there, hotel_cluster=2, is_booking=1),
        interaction_line(**there, hotel_cluster=3, is_booking=1),
        interaction_line(**there, hotel_cluster=4, date_time="2013-05-01 10:00:00", is_booking=1),
        interaction_line(user_location_city=6, srch_destination_id="9", hotel_cluster=9),
    ]
    (tmp_path / "train.csv").write_text("\n".join([",".join(HEADER), *train]) + "\n")
    # The requests lack is_booking and cnt, and order their columns differently.
    columns = ["srch_destination_id", "hotel_market", "hotel_country", "user_id", "date_time",
               "orig_destination_distance", "user_location_city", "id"]
    now = "2015-01-01 00:00:00"
    requests = [
        ["8", 600, 50, 1, now, 12.3456, 5, 0],
        ["8", 600, 50, 1, now, "", 5, 1],
        ["8", 601, 50, 1, now, 12.3457, 5, 2],
        ["77", 600, 50, 1, now, "", "", 3],
        ["9", 1, 1, 1, now, "", 6, 4],
    ]
    lines = [",".join(map(str, row)) for row in [columns, *requests]]
    (tmp_path / "test.csv").write_text("\n".join(lines) + "\n")
    return str(tmp_path / "train.csv"), str(tmp_path / "test.csv")


def test_hotel_submission(spark, tmp_path):
    train_path, test_path = write_contest_files(tmp_path)
    out = str(tmp_path / "result")
    submit_hotels(spark, train_path, test_path, out)
    result = read_by_name(spark, out, T.StructType.fromDDL("id INT NOT NULL, hotel_cluster STRING"))
    # Popular: 2, 3, 4 (8 each), 1 (6), 9 (3). Rule 2: 2, 3 (15 each), 1 (6). Rule 3: also 4.
    assert {r.id: r.hotel_cluster for r in result.collect()} == {
        0: "1 2 2 3 1",  # both rules: distance 1, 2; destination and market 2, 3, 1
        1: "2 3 1 2 3",  # market, then destination
        2: "2 3 4 1 2",  # destination only, padded
        3: "1 2 3 4 9",  # nothing matched: the popular items by number
        4: "9 2 3 4 1",
    }
    train, requests = interactions_and_requests(spark, train_path, test_path)
    distinct = recommend_hotels(train, requests, dedupe=True)
    assert {r.id: r.hotel_cluster for r in distinct.collect()}[0] == "1 2 3 4 9"


def test_pair_features_from_files(spark, tmp_path):
    (tmp_path / "info.csv").write_text(
        "itemID,categoryID,title,description,images_array,attrsJSON,price,locationID,metroID,lat,lon\n"
        '1,2,"big ""red"", one","two\nlines","7, 8","{""a"":""b""}",5,100,,1.5,2.5\n'
        "2,2,,short,,,6,100,,1.5,2.5\n"
    )
    (tmp_path / "location.csv").write_text("locationID,regionID\n100,7\n")
    (tmp_path / "pairs.csv").write_text("itemID_1,itemID_2\n1,2\n2,9\n")
    features = pair_features_from_files(
        spark, str(tmp_path / "pairs.csv"), str(tmp_path / "info.csv"), str(tmp_path / "location.csv"), multiline=True
    )
    row = features.collect()
    assert len(row) == 1 and "images_array_1" not in features.columns
    assert (row[0].title_1, row[0].description_1, row[0].title_2, row[0].description_2) == (14, 9, 0, 5)


# --- records over several lines --------------------------------------------------------------


def write_one_file(path, rows, newline="\n"):
    """A CSV by another writer."""
    path.mkdir()
    with open(path / "a.csv", "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, lineterminator=newline)
        writer.writerow(["id", "text", "n"])
        writer.writerows(rows)


MULTILINE = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n", T.IntegerType())])
TRICKY = [
    'plain', 'two\nlines', 'a "quoted" word', '"', '""', '\n', '\n\n"\n', ',\n,', 'x\r\ny', 'é\n中', '1,"2"\n3', '"\n' * 40, "long " * 300, "end\n",
]


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
@pytest.mark.parametrize("split", [64, 997, 1 << 20])
def test_records_of_one_file_are_read_by_many_tasks(spark, conf, tmp_path, newline, split):
    rows = [(i, f"{i}{TRICKY[i % len(TRICKY)]}", i) for i in range(200)]
    write_one_file(tmp_path / "in", rows, newline)
    conf("spark.sql.files.maxPartitionBytes", str(split))
    conf("spark.sql.files.openCostInBytes", "0")
    assert spark.read.text(str(tmp_path / "in")).rdd.getNumPartitions() > (1 if split < 1000 else 0)
    found = read_quoted(spark, str(tmp_path / "in"), MULTILINE, multiline=True)
    assert sorted(map(tuple, found.collect())) == rows
    if newline == "\n":  # with the other one, Spark changes line breaks within fields
        by_spark = spark.read.schema(MULTILINE).csv(str(tmp_path / "in"), header=True, multiLine=True, lineSep="\n", quote='"', escape='"')
        assert sorted(map(tuple, by_spark.collect())) == rows


def test_records_of_several_files_and_inferred_types(spark, conf, tmp_path):
    conf("spark.sql.files.maxPartitionBytes", "50")
    for name in ("x", "y"):
        write_one_file(tmp_path / name, [(i, f"{name}\n{i}", i / 2) for i in range(30)])
    paths = [str(tmp_path / "x"), str(tmp_path / "y")]
    found = read_quoted(spark, paths, multiline=True)
    assert found.dtypes == [("id", "int"), ("text", "string"), ("n", "double")]
    assert sorted(r.text for r in found.collect()) == sorted(f"{name}\n{i}" for name in "xy" for i in range(30))


@pytest.mark.parametrize("bad", ['1,"a\nb"\n', '1,"a\nb",2,3\n', '1,"open\n2,b,3\n', '1,"a\nb",word\n'])
def test_malformed_records_fail(spark, tmp_path, bad):
    (tmp_path / "a.csv").write_text("id,text,n\n0,x,1\n" + bad)
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        read_quoted(spark, str(tmp_path / "a.csv"), MULTILINE, multiline=True).collect()


# --- faults and types ------------------------------------------------------------------------


def test_faulty_rows_and_the_others(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("n", T.DoubleType()), T.StructField("s", T.StringType()), T.StructField("gone", T.DateType())])
    (tmp_path / "a.csv").write_text('s,id,n\na,1,1.5\nb,,2\n"c,c",x,3\nd,4,word\ne,5\nf,6,7,8\n,7,\n')
    clean, faults = split_faulty(spark, str(tmp_path / "a.csv"), schema)
    assert sorted(map(tuple, clean.collect())) == [(1, 1.5, "a", None), (4, None, "d", None), (7, None, None, None)]
    assert clean.columns == schema.fieldNames()
    got = {(r.column, r.value, r.reason, r.kept) for r in faults.where("column <> '_malformed'").collect()}
    assert got == {("id", None, "missing", False), ("id", "x", "unparseable", False), ("n", "word", "unparseable", True)}
    assert sorted(r.value for r in faults.where("column = '_malformed'").collect()) == ["e,5", "f,6,7,8"]
    places = [r.value for r in faults.orderBy("seq").collect()]
    assert places == [None, "x", "word", "e,5", "f,6,7,8"]
    with pytest.raises(ValueError, match="_malformed"):
        read_clean(spark, str(tmp_path / "a.csv"), schema)


@pytest.mark.parametrize(
    ("values", "found"),
    [
        (["1", "-2", None], "int"), (["1", "3000000000"], "bigint"), (["1", "99999999999999999999"], "double"), (["1", "1e3", ".5"], "double"),
        (["true", "FALSE"], "boolean"), (["true", "1"], "string"), (["2020-01-31"], "date"), (["2020-02-31"], "string"),
        (["2020-01-31", "2020-01-31T10:00"], "timestamp_ntz"), (["2020-01-31 10:00:00.5", "2020-01-31T10:00:00Z"], "timestamp"),
        (["1", "2020-01-31"], "string"), ([None, ""], "string"), (["NaN"], "string"), (["1d"], "string"),
    ],
)
def test_narrowest_type(spark, values, found):
    rows = spark.createDataFrame([(v, "f") for v in values], "c string, f string")
    (r,) = infer_types(rows, ["c"], "f").collect()
    assert (r.column, r.type, r.by_source) == ("c", found, [])


def test_files_that_disagree(spark):
    rows = spark.createDataFrame([("1", "x", "a"), ("2.5", "x", "b"), (None, "x", "c")], "`c.d` string, e string, f string")
    got = {r.column: (r.type, r.by_source) for r in infer_types(rows, ["c.d", "e"], "f").collect()}
    assert got == {"c.d": ("double", ["double", "int"]), "e": ("string", [])}


# --- who removes folders ---------------------------------------------------------------------


def folders(spark):
    place = shared_folder(spark).removeprefix("file:")
    return set(os.listdir(place)) if os.path.isdir(place) else set()


def test_a_workspace_leaves_what_its_results_read(spark):
    before = folders(spark)
    with Workspace(spark) as outer:
        with Workspace(spark) as inner:
            first = stored(spark.range(10).toDF("a"), "first")
            second = stored(first.selectExpr("a + 1 AS a"), "second")
            limit = stored(spark.range(1).selectExpr("5L AS top"), "third")
            result = inner.keep(second.where(F.col("a") <= limit.scalar()))
            assert len(folders(spark) - before) == 3
        assert len(folders(spark) - before) == 2 and len(outer.folders) == 2
        assert result.count() == 5
        outer.release(result)
        assert folders(spark) == before
    assert folders(spark) == before


def test_folders_without_an_open_workspace_belong_to_the_session(spark):
    close_session_workspace(spark)
    before = folders(spark)
    df = stored(spark.range(3), "mine")
    assert df.count() == 3 and len(folders(spark) - before) == 1
    close_session_workspace(spark)
    assert folders(spark) == before


@pytest.mark.parametrize("name", ["map_file", "hotel_files", "csv_quoted", "impute_mean", "rejected_rows", "text_lines"])
def test_queries_leave_only_what_their_results_read(spark, name):
    before = folders(spark)
    result = QUERIES[name](spark, f"{TESTDATA}/sf0.001")
    left = folders(spark) - before
    assert 0 < len(left) <= {"map_file": 2}.get(name, 1) and result.count() > 0

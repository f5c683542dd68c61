import gzip
import json
from decimal import Decimal

import pytest
from conftest import plan_text, rows
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from lakeloom import schemas
from lakeloom.sinks import catalog
from lakeloom.sinks import files as out
from lakeloom.sources import files
from lakeloom.sources.jsonpaths import json_by_paths, read_path_list, select_paths
from lakeloom.sources.tables import inline_rows, stored_table


def gz(path, text):
    with gzip.open(path, "wt") as f:
        f.write(text)


def test_json_tree_and_glob(spark, tmp_path):
    for n, folder in enumerate(("A/A", "A/B", "B")):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / f"s{n}.json").write_text(json.dumps({"song_id": f"S{n}", "year": n, "extra": 1}))
    (tmp_path / "B" / "readme.txt").write_text("not json")
    tree = files.json_tree(spark, str(tmp_path), schemas.SONG)
    assert rows(tree, "song_id", "year") == [("S0", 0), ("S1", 1), ("S2", 2)]
    assert tree.schema == schemas.SONG
    assert files.json_glob(spark, f"{tmp_path}/*/*/*.json", schemas.SONG).count() == 2
    assert "extra" in files.json_glob(spark, f"{tmp_path}/*/*/*.json").columns


def test_json_by_name(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"userId": "5", "FirstName": "Ann", "deep": {"a": 1}}\n{"USERID": "x", "firstname": null}\n')
    target = StructType().add("userid", LongType()).add("firstName", StringType()).add("deep", StringType())
    assert rows(files.json_by_name(spark, str(tmp_path), target)) == [(5, "Ann", '{"a":1}'), (None, None, None)]
    exact = StructType().add("userId", StringType())
    assert rows(files.json_by_name(spark, str(tmp_path), exact, ignore_case=False)) == [("5",), (None,)]


def test_paths_of_one_text_share_a_parse(spark):
    text = '{"a": {"b": 1, "c": [1, {"d": "x"}]}, "e": "2", "f g": 3, "n": null}'
    df = inline_rows(spark, [(1, text), (2, "broken"), (3, None), (4, '{"a": 5}')], "id int, a string")
    target = inline_rows(spark, [], "b bigint, c string, d string, e int, g int, n string, a string").schema
    paths = ["$.a.b", "$.a.c", "$.a.c[1].d", "$.e", "$['f g']", "$.n", "$.a"]
    got = select_paths(df, "a", paths, target, keep=["id"])
    values = {r.id: tuple(r)[1:] for r in got.collect()}
    assert values[1][:6] == (1, '[1,{"d":"x"}]', "x", 2, 3, None) and values[1][6].startswith('{"b":1')
    assert values[2] == values[3] == (None,) * 7 and values[4] == (None,) * 6 + ("5",)
    simple = select_paths(df, "a", ["$.e", "$.n", "$.x.y"], inline_rows(spark, [], "e int, n string, y string").schema)
    assert plan_text(simple).count("from_json") + plan_text(simple).count("JsonToStructs") <= 1


def test_brackets_and_places_share_one_parse(spark):
    lines = ['{"a":{"b":[1,{"c":"x"}],"d e":1.5},"f":true}', '{"a":{"b":[]}}', "broken", None, '{"a":1,"a":2,"f":"g"}', '[{"a":1}]']
    df = inline_rows(spark, [(i, x) for i, x in enumerate(lines)], "id int, j string")
    paths = ["$['a']['d e']", "$.a.b[1].c", "$['a'].b[0]", "$.f", "$.a", "$.a.b[*].c"]
    target = inline_rows(spark, [], "d double, c string, b int, f string, a string, w string").schema
    got = select_paths(df, "j", paths, target, keep=["id"])
    assert rows(got.select("id", "d", "c", "b", "f")) == [
        (0, 1.5, "x", 1, "true"), (1, None, None, None, None), (2, None, None, None, None), (3, None, None, None, None), (4, None, None, None, "g"), (5, None, None, None, None),
    ]
    assert rows(got.where("id in (0, 1)").select("id", "a")) == [(0, '{"b":[1,{"c":"x"}],"d e":1.5}'), (1, '{"b":[]}')]
    plan = plan_text(select_paths(df, "j", paths[:5], target[:5]))
    assert plan.count("parseJson(") == 1
    named = select_paths(df, "j", ["$['a']['d e']", '$["f"]'], target[:2])
    assert "parseJson" not in plan_text(named) and "get_json_object" not in plan_text(named)


def test_nested_targets_by_name(spark, tmp_path):
    (tmp_path / "x.json").write_text(
        '{"USER":{"Id":5,"Tags":["a","b"],"Plays":[{"SONG":"x","n":"2"},{"song":null,"Song":"y"}]},"Level":"free"}\n{"user":7}\n{"user":{"ID":null,"id":3}}\n[]\n'
    )
    target = inline_rows(spark, [], "user struct<id:int,tags:array<string>,plays:array<struct<song:string,n:int>>>, level string").schema
    found = [(None if r.user is None else r.user.asDict(True), r.level) for r in files.json_by_name(spark, str(tmp_path), target).collect()]
    assert found == [
        ({"id": 5, "tags": ["a", "b"], "plays": [{"song": "x", "n": 2}, {"song": "y", "n": None}]}, "free"),
        (None, None), ({"id": 3, "tags": None, "plays": None}, None), (None, None),
    ]


def test_json_by_paths(spark, tmp_path):
    (tmp_path / "log.json").write_text('{"ts": 12, "user": {"id": "7"}, "x": "?"}\n{"ts": null}\n')
    (tmp_path / "map.txt").write_text(json.dumps({"jsonpaths": ["$['ts']", "$.user.id", "$.x"]}))
    paths = read_path_list(spark, str(tmp_path / "map.txt"))
    target = StructType().add("ts", LongType()).add("user_id", LongType()).add("bad", LongType())
    assert rows(json_by_paths(spark, str(tmp_path / "log.json"), paths, target)) == [(12, 7, None), (None, None, None)]
    with pytest.raises(ValueError):
        json_by_paths(spark, str(tmp_path / "log.json"), paths[:1], target)


def test_csv_variants(spark, tmp_path):
    (tmp_path / "a.csv").write_text('artist,location\n"Foo ""Bar""","San Jose, CA"\n,\n')
    (tmp_path / "b.csv").write_text("artist,location\nMuse,Rome\n")
    both = files.csv_files(spark, str(tmp_path), header=True)
    assert rows(both) == sorted([('Foo "Bar"', "San Jose, CA"), (None, None), ("Muse", "Rome")], key=repr)
    assert files.csv_files(spark, str(tmp_path / "b.csv")).columns == ["_c0", "_c1"]


def test_csv_payments(spark, tmp_path):
    path = tmp_path / "payment.csv"
    path.write_text(
        "payment_id;customer_id;staff_id;rental_id;amount;payment_date\n1;5;2;9;1.99;2007-01-24 21:40:19\n2;5;1;8;0.99;2007-02-01 00:00:00\n"
    )
    inferred = files.csv_files(spark, str(path), sep=";", header=True, infer=True)
    assert dict(inferred.dtypes)["amount"] == "double"
    typed = files.csv_files(spark, str(path), schema=schemas.PAYMENT, sep=";", header=True, dateFormat="yyyy-MM-dd HH:mm:ss")
    assert rows(typed.groupBy(F.month("payment_date").alias("m")).agg(F.sum("amount"))) == [(1, 1.99), (2, 0.99)]


TICKET = "{n}.0;1;2;1;A;B;{n};9;12.50\n"


def test_gzip_parts_and_single(spark, tmp_path):
    for n in range(3):
        gz(tmp_path / f"part-{n}.csv.gz", TICKET.format(n=n))
    gz(tmp_path / "full.csv.gz", "".join(TICKET.format(n=n) for n in range(3)))
    parts = files.gzip_parts(spark, f"{tmp_path}/part-", schemas.TICKET)
    single = files.gzip_single(spark, f"{tmp_path}/full.csv.gz", schemas.TICKET, partitions=5)
    assert rows(parts) == rows(single) and parts.count() == 3
    assert parts.first().ticket_price == Decimal("12.50")
    assert "RoundRobinPartitioning(5)" in plan_text(single)


def test_gzip_tables(spark, tmp_path):
    gz(tmp_path / "part.tbl.gz", "1|red\n2|blue\n")
    gz(tmp_path / "supplier.tbl.gz", "5|x\n")
    gz(tmp_path / "partsupp.tbl.gz", "7|no\n8|no\n")
    loaded = files.gzip_tables(spark, str(tmp_path), {"part": "id int, color string", "supplier": "id int, name string"})
    assert {n: df.count() for n, df in loaded.items()} == {"part": 2, "supplier": 1}


def test_array_literal(spark):
    df = inline_rows(spark, [("{a, b,c}",), ("{}",), (None,), ('{"x"}',)], "v string")
    got = df.select("v", files.array_literal("v").alias("a")).collect()
    assert {r.v: r.a for r in got} == {"{a, b,c}": ["a", "b", "c"], "{}": [], None: None, '{"x"}': ["x"]}


def test_array_literal_with_quotes_and_nulls(spark):
    df = inline_rows(spark, [('{"a,b",c}',), ("{NULL,\"NULL\", x }",), ('{"say \\"hi\\"",}',), ("{1,,2}",)], "v string")
    got = [r[0] for r in df.select(files.array_literal("v")).collect()]
    assert got == [["a,b", "c"], [None, "NULL", "x"], ['say "hi"', ""], ["1", "", "2"]]
    assert df.where("v like '{1%'").select(files.array_literal("v", "int")).first()[0] == [1, None, 2]


def test_line_breaks_in_csv(spark, tmp_path):
    df = inline_rows(spark, [(1, 'a\nb, "c"'), (2, None), (3, "x\r\ny")], "id int, v string")
    with pytest.raises(Exception, match="multi_line"):
        out.write_csv(df, str(tmp_path / "plain"))
    out.write_csv(df, str(tmp_path / "broken"), multi_line=True)
    read = files.csv_files(spark, str(tmp_path / "broken"), schema="id int, v string", header=True, multi_line=True)
    assert {r.id: r.v for r in read.collect()} == {1: 'a\nb, "c"', 2: None, 3: "x\r\ny"}


def test_manifest(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.csv").write_text("12345")
    (tmp_path / "b.txt").write_text("1")
    assert files.manifest(spark, str(tmp_path), "*.csv").select("length").collect()[0][0] == 5
    assert files.manifest(spark, str(tmp_path)).count() == 2


def test_csv_write_quotes_everything(spark, tmp_path):
    df = inline_rows(spark, [(1, 'say "hi", now'), (2, None)], "id int, v string")
    out.write_csv(df, str(tmp_path / "out"), ["v", "id"])
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert '"v","id"' in text and '"say ""hi"", now","1"' in text
    back = files.csv_files(spark, str(tmp_path / "out"), header=True)
    assert ('say "hi", now', "1") in rows(back)


def test_partitioned_write(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(1000).select("id", (F.col("id") % 4).cast("int").alias("y"))
    out.write_partitioned(df, path, ["y"])
    read = spark.read.parquet(path)
    assert read.where("y = 2").count() == 250
    assert "PartitionFilters: [isnotnull(y" in plan_text(read.where("y = 2"))
    assert len(list((tmp_path / "p").glob("y=*/*.parquet"))) == 4
    out.write_partitioned(df.where("y = 1").limit(3), path, ["y"], replace_only_present=True)
    assert rows(spark.read.parquet(path).groupBy("y").count()) == [(0, 250), (1, 3), (2, 250), (3, 250)]


def test_documents(spark, tmp_path):
    path = str(tmp_path / "docs")
    for _ in range(2):
        out.write_documents(inline_rows(spark, [("t", "£1")], "title string, price string"), path)
    assert rows(spark.read.json(path), "title", "price") == [("t", "£1")] * 2


def test_catalog_tables(spark, tmp_path):
    schema = StructType().add("id", LongType()).add("name", StringType())
    catalog.create_tables(spark, {"dim_t": schema, "fact_t": schema}, str(tmp_path))
    swapped = inline_rows(spark, [("a", 1)], "name string, id int")
    for _ in range(2):
        catalog.load_dimension(swapped, "dim_t")
        catalog.insert_select(swapped, "fact_t")
    catalog.load_dimension(swapped, "dim_t", append=True)
    assert rows(stored_table(spark, "dim_t")) == [(1, "a")] * 2
    assert rows(stored_table(spark, "fact_t")) == [(1, "a")] * 2
    catalog.stage_table(swapped, "dim_t")
    assert stored_table(spark, "dim_t").count() == 1
    with pytest.raises(ValueError):
        catalog.load_fact(swapped.drop("name"), "fact_t")
    catalog.clear_table(spark, "fact_t")
    assert stored_table(spark, "fact_t").count() == 0
    catalog.drop_tables(spark, ["dim_t", "fact_t"])
    assert not spark.catalog.tableExists("dim_t")


def test_create_and_load(spark, tmp_path):
    schema = StructType().add("id", LongType())
    report = catalog.create_and_load(spark.range(3), "unit_t", schema, str(tmp_path))
    assert rows(report, "table_name", "passed") == [("unit_t", True)]
    assert rows(catalog.create_and_load(spark.range(0), "unit_t", schema, str(tmp_path)), "passed") == [(False,)]
    catalog.drop_tables(spark, ["unit_t"])


def test_result_actions(spark):
    df = spark.range(5)
    assert (df.count(), len(df.limit(2).toPandas()), df.limit(1).first()[0]) == (5, 2, 0)


def test_manifest_takes_file_names_apart_once_a_file(spark, tables):
    from lakeloom.plans.catalog import REGISTRY

    plan = REGISTRY["file_manifest"](spark, tables.root)._jdf.queryExecution().optimizedPlan().toString()
    # Nearest the rows that are read: the count by whole path, then the end of the path.
    lines = [line for line in plan.splitlines() if "o_orderpriority" in line]
    counted = max(i for i, line in enumerate(lines) if "Aggregate [" in line)
    assert "regexp_extract" in lines[counted]
    assert not any("regexp_extract" in line for line in lines[counted + 1 :])

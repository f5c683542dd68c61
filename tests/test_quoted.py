"""CSV records with quoted line breaks over many blocks of one file."""

import contextlib
import csv
import io
import random
import re

import pytest
from conftest import plan_text, rows

from lakeloom.session import scratch_path
from lakeloom.sinks.files import write_csv
from lakeloom.sources import quoted
from lakeloom.sources.files import csv_files
from lakeloom.sources.quoted import csv_records, quoted_lines, records
from lakeloom.sources.tables import inline_rows

SCHEMA = "id int, text string, note string"


@contextlib.contextmanager
def blocks_of(spark, size):
    keys = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def schema(spark):
    return inline_rows(spark, [], SCHEMA).schema


def written(path, data, ending="\n", header=True):
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=ending)
    if header:
        writer.writerow(["id", "text", "note"])
    writer.writerows(data)
    path.write_text(out.getvalue(), encoding="utf-8", newline="")


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [7, 64, 1 << 20])
def test_equal_to_a_plain_reader_however_a_file_is_cut(spark, tmp_path, ending, size):
    rng = random.Random(size)
    bits = ["a", "\n", '"', ",", "\r\n", "é", " ", "\n\n", "long text " * 5, "end\n"]
    data = [(i, "".join(rng.choices(bits, k=rng.randrange(5))) + "x", "n\n" if i % 7 == 0 else "n") for i in range(120)]
    (tmp_path / "in").mkdir()
    for n in range(2):
        written(tmp_path / "in" / f"{n}.csv", data[n::2], ending)
    with blocks_of(spark, size):
        lines = quoted_lines(spark, str(tmp_path / "in"))
        assert size > 1000 or lines.rdd.getNumPartitions() > 2
        found = csv_records(spark, str(tmp_path / "in"), schema(spark), header=True)
        assert rows(found) == sorted(data, key=repr)


def test_a_record_over_many_blocks_and_a_break_at_each_edge(spark, tmp_path):
    text = "\n".join(f"line {i}" for i in range(60))
    data = [(1, "a", "b"), (2, text, "c"), (3, "d", text), (4, "\n", "\n"), (5, "e", "f")]
    written(tmp_path / "x.csv", data)
    for size in (5, 6, 7, 8, 9, 50):
        with blocks_of(spark, size):
            assert rows(csv_records(spark, str(tmp_path / "x.csv"), schema(spark), header=True)) == data


def test_written_texts_keep_their_ends(spark):
    data = [(1, " a ", "b\n"), (2, "\n", "\t")]
    path = scratch_path(spark, "ends")
    write_csv(inline_rows(spark, data, SCHEMA), path, multi_line=True)
    assert rows(csv_records(spark, path, schema(spark), header=True)) == data
    path = scratch_path(spark, "ends")
    write_csv(inline_rows(spark, [(1, " a ", "\t")], SCHEMA), path)
    assert rows(csv_files(spark, path, schema=SCHEMA, header=True)) == [(1, " a ", "\t")]


def test_odd_files(spark, tmp_path):
    path = tmp_path / "x.csv"
    for content, want in (
        ("", []),
        ("\n\n", []),
        ('1,"a",b', [(1, "a", "b")]),
        ('1,"a",b\n\n\n2,"c\n",d\n', [(1, "a", "b"), (2, "c\n", "d")]),
        ("x,a,b\n3,c\n", [(3, "c", None), (None, "a", "b")]),
        ('1,a,b\n2,"never closed\n3,c,d\n', None),
    ):
        path.write_text(content, newline="")
        with blocks_of(spark, 4):
            found = csv_records(spark, str(path), schema(spark))
            if want is None:
                assert (1, "a", "b") in rows(found) and records(spark, str(path)).count() == 2
            else:
                assert rows(found) == want
    path.write_text("id,text,note\n", newline="")
    assert rows(csv_records(spark, str(path), schema(spark), header=True)) == []


def test_no_task_reads_a_whole_file(spark, tmp_path):
    written(tmp_path / "x.csv", [(i, "a\nb", "c" * 50) for i in range(4000)])
    with blocks_of(spark, 16 << 10):
        found = csv_records(spark, str(tmp_path / "x.csv"), schema(spark), header=True)
        assert quoted_lines(spark, str(tmp_path / "x.csv")).rdd.getNumPartitions() >= 10
        assert found.count() == 4000 and found.where("text = 'a\nb'").count() == 4000


def shuffled_bytes(spark):
    context = spark.sparkContext._jsc.sc()
    context.listenerBus().waitUntilEmpty(30_000)
    return context.statusStore().executorSummary("driver").totalShuffleWrite()


def test_only_lines_at_the_edges_of_blocks_are_shuffled(spark, tmp_path):
    rng = random.Random(5)
    data = [(i, f"{rng.randbytes(40).hex()}\n{rng.randbytes(40).hex()}", rng.randbytes(40).hex()) for i in range(4000)]
    written(tmp_path / "x.csv", data)
    size = (tmp_path / "x.csv").stat().st_size
    with blocks_of(spark, 64 << 10):
        found = csv_records(spark, str(tmp_path / "x.csv"), schema(spark), header=True)
        before = shuffled_bytes(spark)
        assert rows(found) == sorted(data, key=repr)
    assert shuffled_bytes(spark) - before < size / 5
    # No window or sort holds the lines of a block.
    plan = plan_text(found)
    assert "Window" in plan and not re.search(r"windowspecdefinition\(_file#\d+, _block#\d+L?, _line", plan)


@pytest.mark.parametrize("most_blocks", [0, quoted.BROADCAST_BLOCKS])
def test_many_blocks_small_batches_and_the_first_record_of_each_file(spark, tmp_path, monkeypatch, most_blocks):
    rng = random.Random(3)
    monkeypatch.setattr(quoted, "BROADCAST_BLOCKS", most_blocks)
    monkeypatch.setattr(quoted, "TASK_BYTES", 512)
    bits = ["a", "\n", '"', ",", "\n\n", "é", "long text\n" * 9]
    data = [(i, "".join(rng.choices(bits, k=rng.randrange(5))) + "x", "n") for i in range(45)]
    (tmp_path / "in").mkdir()
    for n in range(3):
        written(tmp_path / "in" / f"{n}.csv", data[n::3])
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(batch)
    spark.conf.set(batch, "3")
    try:
        for size in (9, 200, 1 << 20):
            with blocks_of(spark, size):
                found = csv_records(spark, str(tmp_path / "in"), schema(spark), header=True)
                assert rows(found) == sorted(data, key=repr)
                firsts = records(spark, str(tmp_path / "in")).where("first").select("record", "_file").collect()
                assert sorted(r["_file"][-5:] for r in firsts) == ["0.csv", "1.csv", "2.csv"]
                assert {r["record"] for r in firsts} == {"id,text,note"}
    finally:
        spark.conf.set(batch, old)

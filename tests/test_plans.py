import subprocess
import sys
from pathlib import Path

import pytest
from collected import rows
from pyspark.sql import functions as F

from weftline.plans import block_sums, chain_metrics, count_bin_enrich, first_two_sum
from weftline.sinks import write_binned, write_counted, write_lines, write_sorted_lines
from weftline.sources import blocks_of_rows, n_line_records, number_lines, parse_profiles


def records(spark, counts):
    ids = [(k,) for k, n in counts.items() for _ in range(n)]
    return spark.createDataFrame(ids, "user_id string")


def users(spark, *lines_):
    lines_df = spark.createDataFrame([(v, i) for i, v in enumerate(lines_)], "value string, ord int")
    parsed = parse_profiles(lines_df.select("value"))
    # The parser drops other columns; order by the attribute instead.
    return parsed.withColumn("ord", F.col("attribute").cast("int"))


def test_bins_and_lookup(spark):
    profiles = users(spark, "a firstName: x reputation: 3", "a firstName: y reputation: 9",
                     "b firstName: z reputation: 5", "zz none 1")
    got = count_bin_enrich(records(spark, {"a": 1, "b": 2, "c": 3}), profiles, order_by="ord")
    # The average is 2.0, and equal to the average is above.
    assert rows(got) == [
        ("a", 1, "9", "multiplebelow"), ("b", 2, "5", "multipleabove"),
        ("c", 3, None, "multipleabove")]
    assert rows(chain_metrics(records(spark, {"a": 1, "b": 2, "c": 3}))) == [(6, 3, 2.0)]


def test_no_records(spark):
    none = spark.createDataFrame([], "user_id string")
    assert rows(chain_metrics(none)) == [(0, 0, None)]


def test_chaining_counts_once(spark, tmp_path):
    path = str(tmp_path / "posts")
    spark.range(1000).selectExpr("cast(id % 9 as string) user_id").write.parquet(path)
    df = count_bin_enrich(
        spark.read.parquet(path), users(spark, "1 x 5"), order_by="ord")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan


def test_binned_sink(spark, tmp_path):
    path = str(tmp_path / "out")
    df = count_bin_enrich(records(spark, {"a": 1, "b": 2, "c": 3}), users(spark, "b 7"), order_by="ord")
    assert rows(write_binned(df, path)) == [("multipleabove", 2), ("multiplebelow", 1)]
    assert rows(spark.read.text(f"{path}/bin=multipleabove")) == [("b\t2\t7",), ("c\t3\tnull",)]
    # A second run replaces the first.
    assert rows(write_binned(df.where("user_id = 'a'"), path)) == [("multiplebelow", 1)]


def test_binned_sink_counts_rows(spark, tmp_path):
    """Values with newlines, bins that look like numbers, a null bin, no rows."""
    df = spark.createDataFrame(
        [("01", "a\nb"), ("01", "c"), ("1", "d"), (None, "e")], "bin string, value string"
    )
    counts = write_binned(df, str(tmp_path / "out"))
    assert rows(counts) == [("01", 2), ("1", 1), (None, 1)]
    assert counts.schema["bin"].dataType == df.schema["bin"].dataType
    assert (tmp_path / "out" / "bin=01").is_dir() and (tmp_path / "out" / "bin=1").is_dir()
    assert rows(write_binned(df.limit(0), str(tmp_path / "none"))) == []


def test_counts_come_from_the_pass_that_writes(spark, tmp_path):
    """The input is read once, and the counts are those of the rows in the files."""
    seen = spark.sparkContext.accumulator(0)

    def pass_on(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(0, 900, 1, 5).selectExpr("cast(id % 3 as int) bin", "id").mapInArrow(
        pass_on, "bin int, id long")
    bins, totals = write_counted(df, str(tmp_path / "out"), [0, 1, 2, 7], {
        "sum": F.sum("id"), "all": F.count("*")})
    assert rows(bins) == [(0, 300), (1, 300), (2, 300)]
    assert totals == {"sum": 899 * 450, "all": 900}
    assert seen.value == 900
    assert rows(spark.read.text(str(tmp_path / "out")).groupBy("bin").count()) == rows(bins)
    empty, none = write_counted(df.limit(0), str(tmp_path / "none"), [0], {"all": F.count("*")})
    assert rows(empty) == [] and none == {"all": 0}


def test_a_row_of_no_known_bin_stops_the_job(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "bin string, v int")
    with pytest.raises(Exception, match="no such bin: b"):
        write_counted(df, str(tmp_path / "out"), ["a"])
    with pytest.raises(ValueError):
        write_counted(df, str(tmp_path / "out"), range(2000))


RETRIED = """
import sys
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
sys.path.insert(0, {root!r})
from weftline.sinks import write_counted
spark = (SparkSession.builder.master("local[2, 3]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "3").getOrCreate())

def fails_once(batches):
    for batch in batches:
        yield batch
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost")

df = spark.range(0, 90, 1, 3).selectExpr("cast(id % 2 as string) bin", "id").repartition(4, "id")
df = df.mapInArrow(fails_once, "bin string, id long")
bins, totals = write_counted(df, {out!r}, ["0", "1"], {{"sum": F.sum("id")}})
print("found", sorted(map(tuple, bins.collect())), totals)
"""


def test_counts_after_retried_tasks(tmp_path):
    root = str(Path(__file__).resolve().parents[1])
    script = RETRIED.format(root=root, out=str(tmp_path / "out"))
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)
    assert f"found [('0', 45), ('1', 45)] {{'sum': {89 * 45}}}" in done.stdout, done.stderr[-2000:]


def test_line_sinks(spark, tmp_path):
    df = spark.createDataFrame([("10", 1), ("3", 2), (None, 3)], "k string, v int")
    write_lines(df, str(tmp_path / "a"), "k")
    assert rows(spark.read.text(str(tmp_path / "a"))) == [("10",), ("3",), ("null",)]
    write_sorted_lines(df.where("k is not null"), str(tmp_path / "b"), "k")
    files = sorted((tmp_path / "b").glob("part-*"))
    assert "".join(f.read_text() for f in files) == "10\t1\n3\t2\n"


def test_block_sums(spark):
    df = spark.createDataFrame([(i, f"{i} {i * 10} x") for i in range(7)], "n bigint, value string")
    got = rows(block_sums(df, 3, order="n", value=first_two_sum()))
    assert got == [(0, 33), (3, 132), (6, 66)]


def test_first_two_sum_fails_on_bad_lines(spark, lines):
    with pytest.raises(Exception, match="malformed"):
        lines("1 x").select(first_two_sum()).collect()


@pytest.fixture
def text_files(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    sizes = {"a.txt": 7, "b.txt": 2, "c.txt": 1, "d.txt": 100}
    for name, n in sizes.items():
        content = "\n".join("" if i % 4 == 2 else f"{name} {i}" for i in range(n))
        (folder / name).write_text(content + ("\n" if n != 2 else ""))
    return folder


def test_line_numbers(spark, text_files):
    numbered = number_lines(spark, str(text_files))
    got = {(r["file"].rsplit("/", 1)[1], r["line_no"]): r["value"] for r in numbered.collect()}
    want = {}
    for f in text_files.iterdir():
        for i, line in enumerate(f.read_text().split("\n")):
            want[(f.name, i)] = line
        if f.read_text().endswith("\n"):
            del want[(f.name, i)]
    assert got == want


def test_line_numbers_by_shuffle(spark, text_files, monkeypatch):
    broadcast = rows(number_lines(spark, str(text_files)))
    monkeypatch.setattr("weftline.sources.lines._MAX_SPLIT_ROWS", -1)
    shuffled = number_lines(spark, str(text_files))
    assert "broadcast" not in shuffled._jdf.queryExecution().logical().toString()
    assert rows(shuffled) == broadcast and len(broadcast) == 110


def test_line_numbers_leave_the_session_alone(spark, text_files):
    settings = lambda: {r["key"]: r["value"] for r in spark.sql("set").collect()}
    before = settings()
    number_lines(spark, str(text_files)).count()
    assert settings() == before


def test_a_null_line_is_an_empty_one(spark):
    df = spark.createDataFrame([(0, "a"), (1, None), (2, "c")], "n bigint, line string")
    assert rows(blocks_of_rows(df, 3, order="n", line="line")) == [(0, "a\n\nc\n")]


@pytest.mark.parametrize("split", ["134217728", "97", "13"])
def test_n_line_records_for_any_split(spark, text_files, split):
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        out = n_line_records(spark, str(text_files), 3).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    got = {(r["file"].rsplit("/", 1)[1], r["first_line"]): r["record"] for r in out}
    assert len(out) == 3 + 1 + 1 + 34
    assert got[("a.txt", 0)] == "a.txt 0\na.txt 1\n\n" and got[("a.txt", 6)] == "\n"
    assert got[("b.txt", 0)] == "b.txt 0\nb.txt 1\n"
    assert got[("d.txt", 99)] == "d.txt 99\n"


def test_one_line_records(spark, text_files):
    assert n_line_records(spark, str(text_files)).count() == 110
    with pytest.raises(ValueError):
        n_line_records(spark, str(text_files), 0)


def test_a_stored_line_index(spark, text_files, tmp_path):
    """Counted once, used again, and made anew when a file or a setting changes."""
    index, paths = str(tmp_path / "index"), str(text_files)
    want = rows(number_lines(spark, paths))
    assert rows(number_lines(spark, paths, index)) == want
    assert rows(number_lines(spark, paths, index)) == want
    # That it is used shows when it is wrong.
    shifted = [r.asDict() | {"base": r["base"] + 100} for r in spark.read.parquet(f"{index}/splits").collect()]
    schema = spark.read.parquet(f"{index}/splits").schema
    spark.createDataFrame([tuple(r[f] for f in schema.names) for r in shifted], schema).write.mode(
        "overwrite").parquet(f"{index}/splits")
    assert rows(number_lines(spark, paths, index)) == sorted(
        ((f, n + 100, v) for f, n, v in want), key=repr)
    some = sorted(text_files.iterdir())[0]
    some.write_text(some.read_text() + "one more\n")
    again = rows(number_lines(spark, paths, index))
    assert again == rows(number_lines(spark, paths)) and len(again) == len(want) + 1
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        assert rows(number_lines(spark, paths, index)) == again
        assert rows(number_lines(spark, paths, index)) == again
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_file_that_changes_under_the_index_stops_the_job(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text("aaaa\nbbbb\n")
    numbered = number_lines(spark, str(folder), str(tmp_path / "index"))
    (folder / "a.txt").write_text("a\na\na\na\nb\n")
    with pytest.raises(Exception, match="no line count"):
        numbered.collect()

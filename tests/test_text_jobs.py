"""Jobs from text files to text files."""

import pytest

from weftline.plans import text_jobs as jobs
from weftline.sources import index_words


@pytest.fixture
def folder(tmp_path):
    files = {
        "pairs": "17 42\n17 44\n3 7\n17 42\n",
        "docs": "87: f m o f\n3: a b\n87: q\n5: m x\n3: a b\n",
        "hot": "m\n\n x \n",
        "users": "9 user-data-1\n4 user-data-2\n9 user-data-3\n",
        "comments": "9 comments-1\n7 comments-2\n9 comments-3\n",
        "profiles": "9 firstName: a reputation: 63\n7 none 1\n9 firstName: b reputation: 5\n",
        "lines": "4 -9\n0 31\n7 12\n70 6\n8 1\n",
        "words": "it,the\nof\nof\n—",
    }
    for name, content in files.items():
        (tmp_path / name).write_text(content, encoding="utf-8")
    return tmp_path


@pytest.fixture
def run(spark, folder):
    def call(job, *inputs, after=(), **options):
        out = folder / "out"
        paths = [str(folder / i) for i in inputs]
        job(spark, *paths, *after, out=str(out), **options)
        parts = sorted(out.glob("**/part-*"))
        return [x for p in parts for x in p.read_text(encoding="utf-8").split("\n")[:-1]]

    return call


def test_counts(run):
    assert sorted(run(jobs.word_count, "words")) == ["it,the\t1", "of\t2", "—\t1"]
    assert sorted(run(jobs.chain_word_count, "words")) == ["IT,THE\t1", "OF\t2", "—\t1"]


def test_summaries(run):
    assert sorted(run(jobs.min_max_count, "pairs")) == [
        "17\tMin: 42 Max: 44 Count: 3", "3\tMin: 7 Max: 7 Count: 1"]
    assert sorted(run(jobs.avg_count, "pairs")) == ["17\t3.0\t42.666668", "3\t1.0\t7.0"]
    assert sorted(run(jobs.median_std, "pairs")) == ["17\t42.0 1.1547005", "3\t7.0 NaN"]


def test_documents(run):
    assert sorted(run(jobs.inverted_index, "docs")) == [
        "a\t: 3 3", "b\t: 3 3", "f\t: 87 87", "m\t: 5 87", "o\t: 87", "q\t: 87", "x\t: 5"]
    assert run(jobs.top_ten, "docs") == ["3\t a b", "5\t m x", "87\t q"]
    assert run(jobs.top_ten, "docs", n=2) == ["5\t m x", "87\t q"]
    assert sorted(run(jobs.distinct, "docs")) == ["3", "5", "87"]
    assert sorted(run(jobs.distributed_grep, "docs", pattern=": [aq]")) == [
        "3: a b", "3: a b", "87: q"]
    assert run(jobs.hotlist_filter, "hot", "docs") == ["5: m x", "87: f m o f"]


def test_joins(run):
    join = lambda how: sorted(run(jobs.reduce_side_join, "users", "comments", after=[how]))
    assert join("inner") == [
        f"9 user-data-{u}\t9 comments-{c}" for u in (1, 3) for c in (1, 3)]
    assert "4 user-data-2\tEmptyText" in join("leftouter")
    assert "EmptyText\t7 comments-2" in join("fullouter")
    assert join("anti") == ["4 user-data-2\tEmptyText", "EmptyText\t7 comments-2"]
    assert sorted(run(jobs.replicated_join, "users", "comments", how="leftouter")) == [
        "7 comments-2\temptyText", "9 comments-1\t9 user-data-3", "9 comments-3\t9 user-data-3"]
    assert sorted(run(jobs.cartesian_product, "words", "hot"))[:2] == ["it,the\t", "it,the\t x "]


def test_job_chaining(run, folder, spark):
    run(jobs.job_chaining, "comments", "profiles")
    out = lambda b: (spark.read.text(str(folder / "out" / f"bin={b}")).collect())
    assert [r[0] for r in out("multipleabove")] == ["9\t2\t5"]
    assert [r[0] for r in out("multiplebelow")] == ["7\t1\t1"]
    bins, metrics = jobs.job_chaining(
        spark, str(folder / "comments"), str(folder / "profiles"), str(folder / "again"))
    assert sorted(map(tuple, bins.collect())) == [("multipleabove", 1), ("multiplebelow", 1)]
    assert metrics == {"records": 3, "users": 2, "avg_posts": 1.5}


def test_blocks(run):
    assert sorted(run(jobs.multiline_sum, "lines", n=2)) == ["0\t26", "2\t95", "4\t9"]
    assert len(run(jobs.multiline_sum, "lines")) == 5


def test_random_data(run, folder):
    posts = run(jobs.random_data, "words", tasks=4, records=25)
    assert len(posts) == 100 and all(p.startswith('<row Id="') for p in posts)
    drawn = " ".join(p.split('Text="')[1].split('"')[0] for p in posts).split()
    # "of" is on two of the four lines.
    assert 0.4 < drawn.count("of") / len(drawn) < 0.6
    (folder / "many").mkdir()
    for n in "ab":
        (folder / "many" / n).write_text("x\n")
    with pytest.raises(ValueError):
        run(jobs.random_data, "many")


def test_malformed_lines_stop_or_drop(run, folder):
    (folder / "bad").write_text("5x 1\n3 4\n")
    with pytest.raises(Exception, match="malformed line"):
        run(jobs.min_max_count, "bad")
    assert run(jobs.min_max_count, "bad", mode="dropmalformed") == ["3\tMin: 4 Max: 4 Count: 1"]


def test_only_needed_fields_count(run, folder):
    (folder / "loose").write_text("5\n5:a\n")
    assert run(jobs.distinct, "loose") == ["5"]
    (folder / "named").write_text("x: m\ny: n\n")
    assert run(jobs.hotlist_filter, "hot", "named") == ["x: m"]
    (folder / "tabs").write_text("1: a\tb  \tc\n")
    assert sorted(run(jobs.inverted_index, "tabs")) == ["a\tb\t: 1", "c\t: 1"]
    (folder / "tabbed").write_text("1\t2\n1 4\n")
    assert run(jobs.avg_count, "tabbed") == ["1\t2.0\t3.0"]


def test_output_replaces_the_last_one(run):
    run(jobs.word_count, "docs")
    assert len(run(jobs.distinct, "docs")) == 3


def test_word_numbers_ignore_copies(spark, lines):
    assert index_words(lines("a", "a", "b"), "value").count() == 2

from urllib.parse import unquote

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lectern.operators import network, wordcount
from lectern.plans import views
from lectern.sources import folders, scratch, sinks, tables, text


@pytest.fixture
def sample(tmp_path):
    (tmp_path / "file1.txt").write_bytes(b"Hello World Bye World\r\n")
    (tmp_path / "file2.txt").write_bytes(b"Hello Hadoop Goodbye Hadoop\r\n")
    (tmp_path / "file1.txt:Zone.Identifier").write_bytes(b"[ZoneTransfer]\n")
    (tmp_path / "notes.md").write_bytes(b"no book\n")
    return str(tmp_path)


def test_scan_lines_takes_txt_files_only(spark, sample):
    got = sorted(row.value for row in text.scan_lines(spark, sample).collect())
    assert got == ["Hello Hadoop Goodbye Hadoop", "Hello World Bye World"]


def test_scan_lines_needs_a_txt_file(spark, tmp_path):
    (tmp_path / "a.md").write_text("x")
    with pytest.raises(ValueError):
        text.scan_lines(spark, str(tmp_path))


def test_scan_lines_accepts_an_empty_file(spark, tmp_path):
    (tmp_path / "a.txt").write_text("")
    assert text.scan_lines(spark, str(tmp_path)).count() == 0


def test_with_file_name(spark, sample):
    named = text.with_file_name(text.scan_lines(spark, sample))
    assert {row.file_name for row in named.collect()} == {"file1", "file2"}


def test_scan_documents_skips_what_is_not_utf8(spark, sample, tmp_path):
    (tmp_path / "bad.txt").write_bytes(b"\xc3\x28")
    got = {tuple(row) for row in text.scan_documents(spark, sample).collect()}
    assert got == {
        ("file1.txt", "Hello World Bye World\n", 23), ("file2.txt", "Hello Hadoop Goodbye Hadoop\n", 29)
    }
    assert [tuple(r) for r in text.skipped_documents(spark, sample).collect()] == [("bad.txt", 2)]


def test_author_date_reads_scanned_documents(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"A Book\nBy  Jane Q. Doe, 1999\n" + b"x" * 20000)
    record = network.author_date(text.scan_documents(spark, str(tmp_path))).first()
    assert tuple(record) == ("a.txt", "Jane Q. Doe", "1999", 0.02)


def test_source_listing_lists_every_file(spark, sample, tmp_path):
    (tmp_path / "big.txt").write_bytes(b"x" * 1500000)
    got = {row.file_name: row.size_mb for row in text.source_listing(spark, sample).collect()}
    assert got["big.txt"] == 1.43 and got["notes.md"] == 0.0


def test_source_listing_reads_no_content(spark, sample):
    plan = text.source_listing(spark, sample, empty_files=False)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<length:bigint>" in plan
    assert "content" not in text.source_listing(spark, sample)._jdf.queryExecution().toString()


@pytest.fixture
def volumes(tmp_path):
    """Files of no bytes beside others, in folders that Spark enters and in others."""
    made = {
        "a.txt": "text", "none.txt": "", "a b+ü%.txt": "", "none.md": "", "k=1/none.txt": "", "k=1/j=x/deep.txt": "",
        "k=2/b.txt": "more", "other/none.txt": "", "_hidden.txt": "", ".dot.txt": "", "_k=3/c.txt": "",
    }
    for name, content in made.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(content)
    return tmp_path


LISTED = {"a.txt", "none.txt", "a b+ü%.txt", "none.md", "k=1/none.txt", "k=1/j=x/deep.txt", "k=2/b.txt", "_k=3/c.txt"}


@pytest.mark.parametrize("tasks", [1, 3, 40])
def test_listing_shows_every_file_once(spark, volumes, tasks):
    rows = folders.folder_listing(spark, str(volumes), tasks).collect()
    got = {unquote(r.path.removeprefix(f"file://{volumes}/")): r.length for r in rows}
    assert len(rows) == len(got) == len(LISTED)
    assert got == {name: len((volumes / name).read_bytes()) for name in LISTED}


def test_listing_takes_lists_uris_and_wildcards(spark, volumes):
    def names(path):
        return sorted(r.path.rsplit("/", 1)[1] for r in folders.folder_listing(spark, path, 2).collect())

    assert names([str(volumes / "k=2"), f"file://{volumes}/a.txt"]) == ["a.txt", "b.txt"]
    assert names(f"{volumes}/k=[12]") == ["b.txt", "deep.txt", "none.txt"]
    assert names(f"file:{volumes}/k=?/*.txt") == ["b.txt", "none.txt"]
    assert names(f"{volumes}/nothing*") == []


def test_empty_files_are_documents(spark, volumes):
    flat = volumes / "other"
    (flat / "full.txt").write_text("words")
    got = {tuple(r) for r in text.scan_documents(spark, str(flat)).collect()}
    assert got == {("none.txt", "", 0), ("full.txt", "words", 5)}
    assert {tuple(r) for r in text.source_listing(spark, str(flat)).collect()} == {("none.txt", 0.0), ("full.txt", 0.0)}
    without = text.scan_documents(spark, str(flat), empty_files=False)
    assert [r.file_name for r in without.collect()] == ["full.txt"]
    record = network.author_date(text.scan_documents(spark, str(flat))).where("file_name = 'none.txt'").first()
    assert tuple(record) == ("none.txt", "Unknown", "Unknown", 0.0)
    keyed = text.scan_documents(spark, str(volumes / "k=1"), r"k=([0-9]+)/").collect()
    assert {r.file_name for r in keyed} == {"1"} and len(keyed) == 2
    odd = text.source_listing(spark, f"{volumes}/a*").collect()
    assert {r.file_name for r in odd} == {"a.txt", "a b+ü%.txt"}


def test_split_sizes_cut_the_scan_and_leave_the_session_alone(spark, tmp_path):
    (tmp_path / "big.txt").write_bytes(b"some words on a line\n" * 400000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    parts = [
        text.scan_with_split_size(spark, str(tmp_path), size).rdd.getNumPartitions()
        for size in (1, 2, 4, 8)
    ]
    assert parts == [9, 5, 3, 2]
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_counts_are_equal_for_all_split_sizes(spark, sample):
    rows = wordcount.word_count_by_split(spark, sample).collect()
    by_size = {size: {r["word"]: r["count"] for r in rows if r.split_mb == size} for size in (1, 2, 4, 8)}
    assert by_size[1]["Hello"] == 2
    assert all(found == by_size[1] for found in by_size.values())


def test_tsv_is_sorted_and_never_overwritten(spark, sample, tmp_path):
    counts = wordcount.word_count(text.scan_lines(spark, sample))
    path = str(tmp_path / "out")
    sinks.write_tsv_sorted(counts, path)
    written = [
        line for part in sorted((tmp_path / "out").glob("part-*")) for line in part.read_text().splitlines()
    ]
    assert written == ["Bye\t1", "Goodbye\t1", "Hadoop\t2", "Hello\t2", "World\t2"]
    with pytest.raises(AnalysisException):
        sinks.write_tsv_sorted(counts, path)


@pytest.mark.parametrize("write, form", [(sinks.write_csv, "csv"), (sinks.write_parquet, "parquet")])
def test_folders_are_overwritten(spark, tmp_path, write, form):
    path = str(tmp_path / "out")
    for value in (1, 2):
        write(spark.range(value, value + 1), path)
    assert [int(row[0]) for row in spark.read.format(form).load(path).collect()] == [2]


def test_scratch_is_the_shared_folder_of_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch.scratch_root(spark) == shared
    assert scratch.scratch_path(spark, "a") != scratch.scratch_path(spark, "a")


def test_a_cluster_has_to_name_a_shared_folder(monkeypatch):
    class Session:
        class sparkContext:
            master = "local-cluster[2,1,1024]"
            getCheckpointDir = staticmethod(lambda: None)

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError):
        scratch.scratch_root(Session)


def test_release_removes_what_was_handed_out(spark, monkeypatch):
    monkeypatch.setattr(scratch, "_handed_out", {})
    path = scratch.scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    scratch.release(spark)
    with pytest.raises(AnalysisException):
        spark.read.parquet(path)


def test_tables_are_read_as_they_lie(spark, sf_dir):
    frame = tables.scan_table(spark, f"{sf_dir}/documents.parquet").where(F.col("doc_id") > 3)
    plan = frame.select("source")._jdf.queryExecution().toString()
    assert "Exchange" not in plan
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in plan
    assert "GreaterThan(doc_id,3)" in plan


def test_kept_tables_are_made_once_and_anew_when_the_table_changes(spark, tmp_path):
    table = str(tmp_path / "documents.parquet")
    made = []

    def write(path):
        made.append(path)
        spark.range(1).write.parquet(path)

    def kept():
        return views.kept(spark, str(tmp_path), "probe", write)

    spark.range(5).write.parquet(table)
    assert kept() == kept() and len(made) == 1
    spark.range(6).write.mode("append").parquet(table)
    kept()
    assert len(made) == 2
    views.forget(spark)
    kept()
    assert len(made) == 3

"""Files listed and read by tasks, and documents as files."""

from __future__ import annotations

from relayframe.plans import queries
from relayframe.sources import files as file_io
from relayframe.sources import listing, wire

from . import samples as S


def test_no_path_passes_the_driver(spark, tmp_path):
    (tmp_path / "k=1").mkdir()
    (tmp_path / "sub" / "deep").mkdir(parents=True)
    for name in ("a.txt", "b c+%41.txt", "_hidden.txt", ".dot.txt", "k=1/p.txt", "sub/s.txt", "sub/deep/d.txt", "n.bin"):
        (tmp_path / name).write_bytes(name.encode())
    (tmp_path / "empty.txt").write_bytes(b"")

    def names(**how):
        rows = file_io.import_files(spark, str(tmp_path), S.AT, **how).collect()
        assert all(r.n_bytes == len(r.content) for r in rows)
        return {r.file_name.removeprefix(f"{tmp_path}/") for r in rows}

    deep = {"a.txt", "b c+%41.txt", "k=1/p.txt", "sub/s.txt", "sub/deep/d.txt", "empty.txt"}
    assert names(glob="*.txt", recursive=True) == deep
    assert names() == {"a.txt", "b c+%41.txt", "k=1/p.txt", "n.bin", "empty.txt"}
    found = wire.stored_streams(spark, [str(tmp_path), f"{tmp_path}/a.tx*"])
    assert found.inputFiles() == []  # no file index
    assert {r.path for r in found.collect()} == {
        f"file:{tmp_path}/{name}" for name in ("a.txt", "b c+%41.txt", "k=1/p.txt", "n.bin")}
    assert listing.mounted_roots("hdfs://host/a") is None and listing.mounted_roots(f"{tmp_path}/{{a,b}}") is None


def test_documents_as_files(spark, folder):
    rows = [(1, "one\ntwo"), (-2, None), (3, "x"), (3, "y"), (None, "n")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    got = {(r.file_name, r.n_bytes) for r in queries.QUERIES["import_files"](spark, folder).collect()}
    assert got == {("1", 8), ("-2", 1), ("3", 4), (queries.NO_KEY, 2)}

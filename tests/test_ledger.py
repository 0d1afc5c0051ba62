import os

from pyspark.sql import types as T

from starlane.streaming.ledger import Ledger

SCHEMA = T.StructType([T.StructField("a", T.LongType())])


def write(path, values):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(f'{{"a": {v}}}\n' for v in values))


def told(report):
    return sorted((r.folder, r.path.rsplit("/", 1)[1], r.status, r.rows) for r in report.collect())


def values(ledger):
    return sorted(r.a for r in ledger.rows().collect())


def test_new_late_touched_and_changed_files(spark, tmp_path):
    files = tmp_path / "files"
    ledger = Ledger(spark, str(tmp_path / "ledger"), SCHEMA)
    write(files / "day=1" / "x.json", [1, 2])
    write(files / "day=1" / "empty.json", [])
    write(files / "day=2" / "x.json", [3])
    write(files / "beside.json", [4, 4])
    write(files / "_hidden" / "x.json", [99])
    assert told(ledger.load(str(files))) == [
        (".", "beside.json", "new", 2), ("day=1", "x.json", "new", 2), ("day=2", "x.json", "new", 1),
    ]
    assert values(ledger) == [1, 2, 3, 4, 4]
    assert told(ledger.load(str(files))) == []

    # A late file with an old time stamp, one copied anew, one replaced under its name with the same length.
    write(files / "day=1" / "late.json", [5])
    os.utime(files / "day=1" / "late.json", (0, 0))
    write(files / "day=2" / "x.json", [3])
    os.utime(files / "day=2" / "x.json", (1000, 1000))
    write(files / "day=1" / "x.json", [1, 7])
    os.utime(files / "day=1" / "x.json", (2000, 2000))
    want = [("day=1", "late.json", "new", 1), ("day=1", "x.json", "changed", 2), ("day=2", "x.json", "same", 1)]
    assert told(ledger.load(str(files))) == want
    assert values(ledger) == [1, 2, 3, 4, 4, 5]
    assert told(ledger.load(str(files))) == want[1:]  # reported until put right


def test_a_load_without_its_lines_is_not_seen(spark, tmp_path):
    files = tmp_path / "files"
    ledger = Ledger(spark, str(tmp_path / "ledger"), SCHEMA)
    assert ledger.rows().count() == 0
    write(files / "day=1" / "x.json", [1])
    ledger.load(str(files))
    # A load that failed before its lines were written.
    spark.createDataFrame([(8, "f", "day=1")], "a long, source_file string, folder string").write.partitionBy("folder").parquet(
        str(tmp_path / "ledger" / "rows" / "load=failed")
    )
    assert values(ledger) == [1]
    assert [r.source_file.rsplit("/", 2)[1:] for r in ledger.rows().collect()] == [["day=1", "x.json"]]

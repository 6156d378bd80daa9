"""The scoring stream's two tables: every row in one of them, each batch once, replays included."""
import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from tessera.operators import score as X
from tessera.session import new_scratch_path
from tessera.streaming import score_stream as S

SCHEMA = "subject_id long, tier int, grp string, age double, sibsp int, parch int, fare double, port string"


def rules():
    return X.default_rules(["male", "female"])


def parts_of(rows):
    return S.checked_parts(rules(), lambda v: v.select("subject_id", (F.col("fare") > 10).cast("int").alias("pred")))(rows)


@pytest.fixture
def files(spark):
    folder = tempfile.mkdtemp(prefix="tessera-sinks-")
    for k in range(3):
        rows = [(k * 10 + i, 1 + i % 4, "male" if i % 3 else "FEMALE", 20.0 + i if i != 5 else None, 0, 0, float(i * 3), "S") for i in range(10)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/part{k}")
    return f"{folder}/part*"


def run(spark, files, out, checkpoint):
    return S.run_available_parts(spark, S.file_stream(spark, files, SCHEMA, 1), parts_of, out_path=out, checkpoint=checkpoint)


def rows_of(tables):
    return {n: sorted(map(tuple, t.collect())) for n, t in tables.items()}


def test_every_row_lands_once_and_replays_change_nothing(spark, files):
    out, checkpoint = new_scratch_path(spark, "sinks"), new_scratch_path(spark, "ckpt")
    first = rows_of(run(spark, files, out, checkpoint))
    source = spark.read.schema(SCHEMA).parquet(files)
    assert first["scored"] == sorted(map(tuple, parts_of(source)[1]["scored"](source).collect()))
    assert first["rejected"] == sorted(map(tuple, X.rejected_rows(source, rules()).collect()))
    assert len(first["scored"]) + len(first["rejected"]) == 30 and len(first["rejected"]) > 3
    assert S.BatchSinks(spark, out).batches() == [0, 1, 2]
    # the driver died after the last batch was written and before the stream noted it
    again = tempfile.mkdtemp(prefix="tessera-replay-") + "/ckpt"
    local = checkpoint.removeprefix("file:").replace("///", "/")
    shutil.copytree(local, again, ignore=lambda d, names: [n for n in names if d.endswith("commits") and n in ("2", ".2.crc")])
    assert not os.path.exists(again + "/commits/2") and os.path.exists(again + "/offsets/2")
    assert rows_of(run(spark, files, out, "file://" + again)) == first
    # a lost checkpoint: all batches come again
    assert rows_of(run(spark, files, out, new_scratch_path(spark, "ckpt"))) == first
    assert S.BatchSinks(spark, out).batches() == [0, 1, 2]


def test_half_a_batch_is_never_read(spark, files):
    sinks = S.BatchSinks(spark, new_scratch_path(spark, "sinks"))
    df = spark.createDataFrame([(1, 1)], "subject_id long, pred int")
    df.write.parquet(f"{sinks.path}/scored/000000000000-dead")  # its writer died before the commit
    assert sinks.batches() == [] and sinks.read("scored", df.schema).count() == 0
    assert sinks.write(0, {"scored": df, "rejected": df.limit(0)}) is True
    assert sinks.write(0, {"scored": df, "rejected": df}) is False
    assert sinks.read("scored", df.schema).count() == 1 and sinks.read("rejected", df.schema).count() == 0


def test_empty_stream(spark):
    folder = tempfile.mkdtemp(prefix="tessera-sinks-") + "/none"
    spark.createDataFrame([], SCHEMA).write.parquet(folder)
    got = S.run_available_parts(spark, S.file_stream(spark, folder, SCHEMA), parts_of)
    assert {n: t.count() for n, t in got.items()} == {"scored": 0, "rejected": 0}
    assert got["rejected"].columns == ["subject_id", "reasons", "n_reasons"]

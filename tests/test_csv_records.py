"""CSV files with quoted line feeds, read in byte ranges, against a plain reader and pandas."""
import csv
import os
import random
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.sources.csv import quoted_records, read_csv, read_text_columns, write_csv


def folder(files):
    d = tempfile.mkdtemp(prefix="tessera-csv-")
    for k, text in enumerate(files):
        with open(os.path.join(d, f"f{k}.csv"), "w", newline="") as f:
            f.write(text)
    return d


def plain(path):
    """Every file's records without its header; an empty field is null. Line ends inside quotes stay as they are."""
    out = []
    for name in sorted(os.listdir(path)):
        with open(os.path.join(path, name), newline="") as f:
            out += [tuple(v or None for v in r) for r in list(csv.reader(f))[1:] if r]
    return sorted(out, key=repr)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def ranges(spark):
    """Sets the bytes of a range."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")

    def use(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))

    yield use
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def made(seed, n, end="\n"):
    rng = random.Random(seed)
    pick = ["x", "plain", '"a ""b"" c"', '"two\nlines"', '"\n"', '"""\n"""', '"a,b\n\n\nc"', "", "word word", '"' + "long " * 60 + '\n"', "\u00e9\u4e2d", '"cr\r\nlf"']
    return "id,dot.name,b" + end + "".join(f"{k},{rng.choice(pick)},{rng.choice(pick)}{end}" for k in range(n))


@pytest.mark.parametrize("size", [7, 64, 1000, 1 << 20])
def test_equal_to_a_plain_reader(spark, ranges, size):
    n = 60 if size < 64 else 400
    path = folder([made(1, n), made(2, n // 3, "\r\n"), made(3, n)[:-1], "id,dot.name,b\n", made(4, 0) + '1,"a\n\n",b'])
    want = plain(path)
    ranges(size)
    got = read_text_columns(spark, path, True)
    assert got.columns == ["id", "dot.name", "b"] and rows(got) == want and len(want) == 2 * n + n // 3 + 1
    if size == 64:
        assert spark.read.text(path).rdd.getNumPartitions() > 100


def test_types_and_records_over_many_ranges(spark, ranges):
    path = folder(['n,t\n1,"' + "line\n" * 500 + '"\n2,NA\n\n3,"end"\n'])
    ranges(50)
    assert [(r.n, r.t) for r in read_csv(spark, path, multi_line=True).orderBy("n").collect()] == [(1, "line\n" * 500), (2, None), (3, "end")]
    assert [r.number for r in quoted_records(spark, path).orderBy("number").collect()] == [1, 2, 3, 5]  # 4 is the empty line


def test_unpaired_quotes_raise(spark):
    with pytest.raises(Exception, match="unpaired quotes"):
        read_text_columns(spark, folder(['a,b\n1,"x\n2,y\n']), True).collect()


def test_equal_to_pandas(spark, ranges):
    path = folder([made(6, 200, "\r\n")])
    ranges(300)
    theirs = pd.read_csv(os.path.join(path, "f0.csv"), dtype=str, keep_default_na=False)
    assert rows(read_text_columns(spark, path, True)) == sorted((tuple(v or None for v in r) for r in theirs.itertuples(index=False)), key=repr)


def test_lines_are_shuffled_by_range_once(spark, ranges):
    path = folder([made(5, 300)])
    ranges(100)
    df = quoted_records(spark, path)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert final.count("ENSURE_REQUIREMENTS") >= 2 and "SinglePartition" not in final and "ReusedExchange" in final


def test_texts_written_and_read(spark, ranges):
    texts = [" outer blanks ", "a\nb", 'quote " and, comma', '"', "\n", "\\", '\\"', "x\r\ny", "tab\t", "'", "#", "\u2028"]
    path = tempfile.mkdtemp(prefix="tessera-csv-") + "/t"
    write_csv(spark.createDataFrame(list(enumerate(texts)), "id long, text string"), path)
    ranges(16)
    back = read_csv(spark, path, "id long, text string", na_tokens=[], multi_line=True)
    assert [r.text for r in back.orderBy("id").collect()] == texts

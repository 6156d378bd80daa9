from pyspark.sql import functions as F

from tessera.functions import features as FF
from tessera.spec import PRESET_A, PRESET_B


def test_bands_left_and_right_closed(spark):
    ages = [None, -1.0, 0.0, 11.99, 12.0, 18.0, 35.0, 60.0, 99.9, 100.0, 101.0]
    df = spark.createDataFrame([(a,) for a in ages], "age double")
    out = df.select("age", FF.age_group("age", PRESET_A).alias("a"), FF.age_group("age", PRESET_B).alias("b")).collect()
    got = {r["age"]: (r["a"], r["b"]) for r in out}
    assert got[None] == (None, None)
    assert got[-1.0] == (None, None)
    assert got[0.0] == ("Child", None)  # right-closed: 0 is outside (0, 12]
    assert got[11.99] == ("Child", "Child")
    assert got[12.0] == ("Teen", "Child")
    assert got[18.0] == ("Young Adult", "Teen")
    assert got[35.0] == ("Adult", "Adult")
    assert got[60.0] == ("Senior", "Middle")
    assert got[99.9] == ("Senior", "Senior")
    assert got[100.0] == (None, "Senior")  # left-closed: 100 falls in no band
    assert got[101.0] == (None, None)


def test_titles_both_rules(spark):
    names = ["Doe, Mr. A", "Doe, Mme. B", "Doe, Prof. C", "Doe, the Countess. D", "NoTitle", None, "Doe, Ms. E"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    out = df.select("n", FF.title_regex("n").alias("raw"), FF.title_mapped("n", PRESET_A).alias("a"),
                    FF.title_split("n").alias("split"), FF.title_mapped("n", PRESET_B).alias("b")).collect()
    got = {r["n"]: (r["raw"], r["a"], r["split"], r["b"]) for r in out}
    assert got["Doe, Mr. A"] == ("Mr", "Mr", "Mr", "Mr")
    assert got["Doe, Mme. B"] == ("Mme", "Mrs", "Mme", "Rare")
    assert got["Doe, Prof. C"] == ("Prof", "Rare", "Prof", "Rare")
    assert got["Doe, the Countess. D"] == ("Countess", "Rare", "the Countess", "Rare")
    assert got["NoTitle"] == (None, "Rare", None, "Rare")
    assert got[None] == (None, "Rare", None, "Rare")
    assert got["Doe, Ms. E"][1] == "Miss" and got["Doe, Ms. E"][3] == "Rare"


def test_deck_family_and_fare_per_person(spark):
    df = spark.createDataFrame([("C85", 1, 0, 30.0), ("B57 B59", 0, 0, 10.0), ("", 2, 1, None), (None, 0, 0, 7.0)],
                               "cabin string, sibsp int, parch int, fare double")
    out = df.select(FF.deck("cabin", "U").alias("d"), FF.deck("cabin", "Unknown").alias("d2"),
                    FF.family_size().alias("fs"), FF.is_alone().alias("ia"), FF.fare_per_person().alias("fpp")).collect()
    assert [r["d"] for r in out] == ["C", "B", "U", "U"]
    assert [r["d2"] for r in out] == ["C", "B", "Unknown", "Unknown"]
    assert [r["fs"] for r in out] == [2, 1, 4, 1]
    assert [r["ia"] for r in out] == [0, 1, 0, 1]
    assert [r["fpp"] for r in out] == [15.0, 10.0, None, 7.0]


def test_csv_tokens_and_quotes(spark, tmp_path):
    from tessera.sources.csv import read_csv
    p = tmp_path / "t.csv"
    p.write_text('id,name,age,fare\n'
                 '1,"Doe, Mr. ""Bob"" A",22,7.25\n'
                 '2,Roe,NA,NaN\n'
                 '3,,N/A,\n'
                 '4,"Poe, Ms. C",null,None\n')
    df = read_csv(spark, str(p), "id int, name string, age double, fare double").orderBy("id").collect()
    assert df[0]["name"] == 'Doe, Mr. "Bob" A' and df[0]["age"] == 22.0 and df[0]["fare"] == 7.25
    assert df[1]["age"] is None and df[1]["fare"] is None
    assert df[2]["name"] is None and df[2]["age"] is None and df[2]["fare"] is None
    assert df[3]["name"] == "Poe, Ms. C" and df[3]["age"] is None and df[3]["fare"] is None


def test_feature_frame_drops_raw_columns(spark, sf_small):
    from tessera.sources import fixtures
    f = FF.feature_frame(fixtures.subjects(spark, sf_small), PRESET_A)
    assert "full_name" not in f.columns and "cabin" not in f.columns
    assert {"title", "family_size", "is_alone", "age_group", "deck"} <= set(f.columns)
    assert f.filter(F.col("deck").isNull() | F.col("title").isNull()).count() == 0

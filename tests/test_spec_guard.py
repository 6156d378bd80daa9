"""A fitted pipeline carries its feature spec and refuses rows of another one."""
from dataclasses import replace

import pytest
from pyspark.errors import PySparkException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tessera.functions.features import feature_frame
from tessera.operators import guard as N
from tessera.operators import prep as I
from tessera.session import new_scratch_path
from tessera.sources import fixtures
from tessera.spec import PRESET_A, PRESET_B, SPEC_MARK, fingerprint


@pytest.fixture(scope="module")
def model(spark, sf_small):
    frame = feature_frame(fixtures.subjects(spark, sf_small), PRESET_A)
    plain = Pipeline(stages=I.preprocessor(["fare", "family_size"], ["age_group", "title"]).getStages()).fit(frame)
    path = new_scratch_path(spark, "guarded")
    N.guarded(plain, PRESET_A).write().save(path)
    return plain, PipelineModel.load(path)


def frame(spark, sf, spec):
    return feature_frame(fixtures.subjects(spark, sf), spec)


def test_own_rows_pass_and_others_are_refused_after_a_load(spark, sf_small, model):
    plain, loaded = model
    own = frame(spark, sf_small, PRESET_A)
    assert loaded.transform(own).select("subject_id", "features").exceptAll(plain.transform(own).select("subject_id", "features")).count() == 0
    assert N.spec_guard(loaded).kept()["fingerprint"] == fingerprint(PRESET_A) and N.spec_guard(plain) is None
    with pytest.raises(N.SpecMismatch, match="age_group.*title"):
        loaded.transform(frame(spark, sf_small, PRESET_B))
    with pytest.raises(N.SpecMismatch, match="deck"):
        loaded.transform(own.drop("deck"))


def test_marks_survive_filters_joins_and_files(spark, sf_small, model):
    other = frame(spark, sf_small, PRESET_B)
    path = new_scratch_path(spark, "frame-b")
    other.join(other.select("subject_id").distinct(), "subject_id").filter("fare > 1").write.parquet(path)
    back = spark.read.parquet(path)
    assert back.schema["title"].metadata[SPEC_MARK] == fingerprint(PRESET_B)
    with pytest.raises(N.SpecMismatch):
        model[1].transform(back)


def test_unmarked_rows_are_checked_by_value(spark, sf_small, model):
    bare = {c: F.concat(c, F.lit("")) for c in ("age_group", "title", "deck")} | {c: F.col(c) + 0 for c in ("family_size", "is_alone")}
    own = frame(spark, sf_small, PRESET_A).withColumns(bare)
    assert not any(f.metadata.get(SPEC_MARK) for f in own.schema.fields)
    assert model[1].transform(own).select("features").count() == own.count()
    nulls = own.withColumn("age_group", F.lit(None).cast("string"))
    assert model[1].transform(nulls).filter("features is not null").count() == own.count()
    other = frame(spark, sf_small, PRESET_B).withColumns(bare).drop("fare_per_person")
    with pytest.raises(PySparkException, match="age_group has a value"):
        model[1].transform(other).select("features").collect()


def test_fingerprints_tell_every_rule_apart():
    specs = [PRESET_A, PRESET_B, replace(PRESET_A, deck_default="X"), replace(PRESET_A, age_right_closed=True)]
    assert len({fingerprint(s) for s in specs}) == 4 and fingerprint(replace(PRESET_A)) == fingerprint(PRESET_A)

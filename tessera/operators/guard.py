"""The feature spec kept with a fitted pipeline.

Two specs can give columns of the same names and types with other meanings (band labels, title rules, deck default), so a
model that gets the wrong one's rows would score them without a word. A ``SpecGuard`` at the head of the pipeline is saved
and loaded with it and refuses such rows: ``feature_frame`` marks the columns it derives with its spec's fingerprint
(column metadata, which selections, joins and Parquet files keep), and the guard compares the marks when the plan is made.
Where no mark is left (rows put together by hand), it checks the values of the band and title columns row by row.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Model, PipelineModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.spec import SPEC_MARK, TITLE_DEFAULT, FeatureSpec, fingerprint


class SpecMismatch(ValueError):
    """Rows made by another feature spec than the model's."""


class SpecGuard(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Passes rows of its own spec on unchanged. A missing feature column or another spec's mark raises
    :class:`SpecMismatch` at once; an unmarked row with a value that the spec can't give fails the job. Null values pass."""

    state = Param(Params._dummy(), "state", "spec as JSON", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, state=None):
        super().__init__()
        self._set(**self._input_kwargs)

    @staticmethod
    def of(spec: FeatureSpec) -> "SpecGuard":
        return SpecGuard(state=json.dumps({
            "fingerprint": fingerprint(spec), "features": spec.features,
            "values": {"age_group": sorted(spec.age_labels), "title": sorted({*spec.title_map.values(), TITLE_DEFAULT})}}))

    def kept(self) -> dict:
        return json.loads(self.getOrDefault(self.state))

    def _transform(self, df: DataFrame) -> DataFrame:
        kept = self.kept()
        missing = [c for c in kept["features"] if c not in df.columns]
        if missing:
            raise SpecMismatch(f"the model needs columns {missing}")
        marks = {f.name: f.metadata.get(SPEC_MARK) for f in df.schema.fields}
        other = sorted(n for n, m in marks.items() if m is not None and m != kept["fingerprint"])
        if other:
            raise SpecMismatch(f"columns {other} were derived by another feature spec than the model's")
        loose = {c: v for c, v in kept["values"].items() if marks.get(c) is None and c in df.columns}
        return df.withColumns({c: _one_of(c, v) for c, v in loose.items()}) if loose else df


def _one_of(name: str, values: list[str]) -> Column:
    c = F.col(name)
    wrong = F.raise_error(F.concat(F.lit(f"{name} has a value that the model's feature spec doesn't give: "), c))
    return F.when(c.isNull() | c.isin(*values), c).otherwise(wrong.cast("string"))


def guarded(model: PipelineModel, spec: FeatureSpec) -> PipelineModel:
    """``model`` with the guard of ``spec`` as its first stage."""
    return PipelineModel(stages=[SpecGuard.of(spec), *model.stages])


def spec_guard(model: PipelineModel) -> SpecGuard | None:
    """The guard of a (loaded) pipeline, if it has one."""
    return next((s for s in model.stages if isinstance(s, SpecGuard)), None)

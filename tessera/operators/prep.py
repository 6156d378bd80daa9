"""Imputation, scaling and encoding, fitted on training rows and applied to any rows.

The estimators are ordinary ``pyspark.ml`` stages (persistable with a Pipeline). Their
fitted state is a handful of constants per column (a median, a mode, a mean/std pair),
computed by distributed aggregations and stored as stage params.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.ranks import (distinct_value_counts, exact_quantiles, parallel_buckets,
                                     quantiles_from_counts, value_buckets)
from tessera.session import checkpointed


#: Groups (of a few dozen bytes each) that are sent to every task.
BROADCAST_GROUPS = 100_000


# Fitting helpers ------------------------------------------------------------------------

def fit_medians(df: DataFrame, cols: list[str], exact: bool = True) -> dict[str, float | None]:
    """Median of each column's non-null values (exact by default; sketch when ``exact=False``)."""
    if not cols:
        return {}
    if exact:
        rows = exact_quantiles(df, cols, [0.5]).collect()  # one row per column
        return {r["col_name"]: r["value"] for r in rows}
    types = dict(df.dtypes)
    row = df.agg(*[F.percentile_approx(present(c, types[c]).cast("double"), 0.5, 10_000).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols}


def mode_table(df: DataFrame, cols: list[str], keys: list[str] | None = None) -> DataFrame:
    """Most frequent non-null value per column (ties: smallest value), as rows (col_name, mode).

    Columns of one type are unpivoted together, so each type is one scan: counting per
    (column, value) is a map-side-combined aggregation, and the winner per column is a
    ``min_by`` over (-count, value), again partially aggregated — no task sees all values.
    Ties are broken in the column's own type order (numbers numerically).
    """
    keys = list(keys or [])
    types = dict(df.dtypes)
    by_type: dict[str, list[str]] = {}
    for c in cols:
        by_type.setdefault(types[c], []).append(c)
    parts = []
    for _t, group in by_type.items():
        pairs = F.array(*[F.struct(F.lit(c).alias("col_name"), F.col(c).alias("v")) for c in group])
        present = F.col("v").isNotNull()
        if _t in ("double", "float"):
            present = present & ~F.isnan("v")  # NaN is missing, as in the reference's imputer
        long = df.select(*keys, F.inline(pairs)).filter(present)
        vc = long.groupBy(*keys, "col_name", "v").agg(F.count(F.lit(1)).alias("n"))
        best = vc.groupBy(*keys, "col_name").agg(
            F.min_by("v", F.struct((-F.col("n")).alias("nn"), F.col("v"))).alias("mode"))
        parts.append(best.select(*keys, "col_name", F.col("mode").cast("string").alias("mode")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fit_modes(df: DataFrame, cols: list[str]) -> dict[str, object]:
    """Mode per column as model constants (typed like the column)."""
    out = {}
    types = dict(df.dtypes)
    for r in mode_table(df, cols).collect():
        v = r["mode"]
        t = types[r["col_name"]]
        if v is not None and t in ("int", "bigint", "smallint", "tinyint"):
            v = int(v)
        elif v is not None and t in ("double", "float"):
            v = float(v)
        out[r["col_name"]] = v
    return out


def present(col: str, dtype: str):
    """The column with NaN as null: fits treat NaN as missing, so applying a fit must too."""
    return F.when(~F.isnan(col), F.col(col)) if dtype in ("double", "float") else F.col(col)


def filled(col: str, dtype: str, value):
    """``col`` with missing values replaced. A fractional fill (a median) makes an integer column double."""
    if isinstance(value, float) and dtype in ("tinyint", "smallint", "int", "bigint"):
        return F.coalesce(F.col(col).cast("double"), F.lit(value))
    return F.coalesce(present(col, dtype), F.lit(value).cast(dtype))


def fill(df: DataFrame, values: dict[str, object]) -> DataFrame:
    types = dict(df.dtypes)
    return df.withColumns({c: filled(c, types[c], v) for c, v in values.items() if v is not None})


_NUMERIC_TYPES = ("int", "bigint", "smallint", "tinyint", "double", "float")


def fit_medians_and_modes(df: DataFrame, median_cols: list[str], mode_cols: list[str]) -> dict[str, object]:
    """Exact medians and modes (ties: smallest value in the column's type order) from one scan.

    Every fitted column becomes long rows (kind, column, number, text); one map-side
    combined aggregation collapses them to distinct values with counts and is checkpointed
    to the shared folder. Medians are the bucketed exact quantiles over the numeric part,
    modes a ``min_by`` over (-count, value); NaN counts as missing, as in the other fits.
    """
    types = dict(df.dtypes)
    null_s = F.lit(None).cast("string")
    recs = []
    for kind, cols in (("median", median_cols), ("mode", mode_cols)):
        for c in cols:
            numeric = kind == "median" or types[c] in _NUMERIC_TYPES
            v = F.col(c).cast("double") if numeric else F.lit(None).cast("double")
            v = F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)
            txt = null_s if numeric else F.col(c).cast("string")
            recs.append(F.struct(F.lit(kind).alias("kind"), F.lit(c).alias("col_name"), v.alias("v"), txt.alias("s")))
    if not recs:
        return {}
    long = df.select(F.inline(F.array(*recs)))
    vc = checkpointed(long.groupBy("kind", "col_name", "v", "s").agg(F.count(F.lit(1)).alias("n")))
    out: dict[str, object] = {}
    if median_cols:
        med = vc.filter(F.col("kind") == "median").select(
            "col_name", F.col("v").alias("value"), F.when(F.col("v").isNull(), F.lit(0)).otherwise(F.col("n")).alias("c"))
        med = value_buckets(med, "value", parallel_buckets(df.sparkSession), by="col_name")
        out.update({r["col_name"]: r["value"] for r in quantiles_from_counts(med, [0.5]).collect()})
    if mode_cols:
        present = F.col("v").isNotNull() | F.col("s").isNotNull()
        best = vc.filter((F.col("kind") == "mode") & present).groupBy("col_name").agg(
            F.min_by(F.struct("v", "s"), F.struct((-F.col("n")).alias("nn"), F.col("v"), F.col("s"))).alias("m"))
        found = {r["col_name"]: r["m"] for r in best.collect()}
        for c in mode_cols:
            m = found.get(c)
            if m is None:
                out[c] = None
            elif types[c] in ("int", "bigint", "smallint", "tinyint"):
                out[c] = int(m["v"])
            elif types[c] in ("double", "float"):
                out[c] = float(m["v"])
            else:
                out[c] = m["s"]
    return out


def impute_whole_table(df: DataFrame, median_cols: list[str], mode_cols: list[str]) -> DataFrame:
    """Median / mode fill fitted on the whole table (the dashboard's leaky variant); the
    fit reads the table once."""
    return fill(df, fit_medians_and_modes(df, median_cols, mode_cols))


def group_median_fill(df: DataFrame, col: str, keys: list[str], fit_on: DataFrame | None = None,
                      out: str | None = None) -> DataFrame:
    """Fill ``col`` with the median of its group (by ``keys``), else the global median.

    Group medians come from the distributed exact quantile; the (group-count sized) table
    of medians is joined back on the keys (AQE picks broadcast when it is small).
    Rows with a missing key fall back to the global median.
    """
    fit_on = df if fit_on is None else fit_on
    out = out or col
    # one scan of the fitting rows: distinct (group, value) counts; the group medians read
    # the rows with complete keys, the global median the counts summed over the groups
    vc = distinct_value_counts(fit_on, [col], keys)
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    gm = quantiles_from_counts(vc.filter(complete), [0.5], keys).select(*keys, F.col("value").alias("_gmed"))
    overall = value_buckets(vc.groupBy("col_name", "value").agg(F.sum("c").alias("c")), "value",
                            parallel_buckets(df.sparkSession), by="col_name")
    glob = quantiles_from_counts(overall, [0.5]).first()["value"]
    # a row a group: sent to every task where a count shows it is small, else AQE's skew join takes hot groups
    gm = F.broadcast(gm) if gm.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS else gm
    j = df.join(gm, on=keys, how="left")
    cols = [c for c in df.columns if c != out]
    value = F.coalesce(present(col, dict(df.dtypes)[col]), F.col("_gmed"), F.lit(glob).cast("double"))
    res = j.select(*cols, value.alias(out))
    return res.select(*df.columns) if out in df.columns else res


def standardise_fit(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """(mean, population std) per column, one aggregation; std 0 or null -> 1."""
    row = df.agg(*[F.avg(c).alias("m_" + c) for c in cols], *[F.stddev_pop(c).alias("s_" + c) for c in cols]).first()
    res = {}
    for c in cols:
        s = row["s_" + c]
        res[c] = (row["m_" + c], 1.0 if (s is None or s == 0.0) else s)
    return res


# Pipeline stages ----------------------------------------------------------------------

class _JsonState(Params):
    state = Param(Params._dummy(), "state", "fitted constants as JSON", typeConverter=TypeConverters.toString)

    def _state(self) -> dict:
        return json.loads(self.getOrDefault(self.state))


class ExactImputer(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Median (exact) or most-frequent imputer; outputs replace inputs unless outputCols is set."""

    strategy = Param(Params._dummy(), "strategy", "median | mode", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, strategy="median"):
        super().__init__()
        self._setDefault(strategy="median")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "ExactImputerModel":
        cols = self.getInputCols()
        strat = self.getOrDefault(self.strategy)
        values = fit_medians(df, cols) if strat == "median" else fit_modes(df, cols)
        outs = self.getOutputCols() if self.isSet(self.outputCols) else cols
        m = ExactImputerModel(inputCols=cols, outputCols=outs, state=json.dumps(values))
        return m


class ExactImputerModel(Model, HasInputCols, HasOutputCols, _JsonState, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, state=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def surrogates(self) -> dict:
        return self._state()

    def _transform(self, df: DataFrame) -> DataFrame:
        vals = self._state()
        types = dict(df.dtypes)
        return df.withColumns({o: filled(i, types[i], vals[i]) if vals.get(i) is not None
                               else F.col(i) for i, o in zip(self.getInputCols(), self.getOutputCols())})


class PopulationScaler(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """(x - mean) / population std; a constant column is divided by 1."""

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "PopulationScalerModel":
        cols = self.getInputCols()
        st = standardise_fit(df, cols)
        outs = self.getOutputCols() if self.isSet(self.outputCols) else cols
        return PopulationScalerModel(inputCols=cols, outputCols=outs, state=json.dumps(st))


class PopulationScalerModel(Model, HasInputCols, HasOutputCols, _JsonState, DefaultParamsReadable,
                            DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, state=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def stats(self) -> dict:
        return self._state()

    def _transform(self, df: DataFrame) -> DataFrame:
        st = self._state()
        return df.withColumns({o: (F.col(i).cast("double") - F.lit(st[i][0])) / F.lit(st[i][1])
                               for i, o in zip(self.getInputCols(), self.getOutputCols())})


def preprocessor(numeric: list[str], categorical: list[str], features_col: str = "features") -> Pipeline:
    """Numeric: median fill + population standardise. Categorical: mode fill + sorted one-hot
    (all categories kept, unknown -> all zeros). Then one assembled vector."""
    num_f = [c + "__f" for c in numeric]
    num_s = [c + "__s" for c in numeric]
    cat_s = [c + "__str" for c in categorical]
    cat_f = [c + "__m" for c in categorical]
    cat_i = [c + "__i" for c in categorical]
    cat_v = [c + "__v" for c in categorical]
    stages = [
        ExactImputer(inputCols=numeric, outputCols=num_f, strategy="median"),
        PopulationScaler(inputCols=num_f, outputCols=num_s),
        _ToString(inputCols=categorical, outputCols=cat_s),
        ExactImputer(inputCols=cat_s, outputCols=cat_f, strategy="mode"),
        StringIndexer(inputCols=cat_f, outputCols=cat_i, stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCols=cat_i, outputCols=cat_v, dropLast=True),
        VectorAssembler(inputCols=num_s + cat_v, outputCol=features_col),
    ]
    return Pipeline(stages=stages)


class _ToString(Model, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Stateless cast of categorical columns to strings (integers sort as their text)."""

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({o: F.col(i).cast("string") for i, o in zip(self.getInputCols(), self.getOutputCols())})


def encoded_names(prep_model, numeric: list[str], categorical: list[str]) -> list[str]:
    """Vector slot names: numeric columns, then ``col_value`` per category in index order."""
    from pyspark.ml.feature import StringIndexerModel
    si = [s for s in prep_model.stages if isinstance(s, StringIndexerModel)][0]
    names = list(numeric)
    for c, labels in zip(categorical, si.labelsArray):
        names += [f"{c}_{v}" for v in labels]
    return names

"""Request validation, defaults and scoring (X1-X4) as row-wise DataFrame operators.

Everything is stateless per row, so the same functions run on a batch table or on a
stream (see :mod:`tessera.streaming.score_stream`).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.features import age_group, family_size, is_alone
from tessera.spec import PRESET_A, REQUEST_AGE_RANGE, REQUEST_DEFAULTS, REQUEST_PORTS, REQUEST_TIERS, VERDICT_NEGATIVE, \
    VERDICT_POSITIVE, FeatureSpec


@dataclass(frozen=True)
class Rule:
    code: str
    fails: Column  # true when the row breaks the rule


def default_rules(groups: list[str]) -> list[Rule]:
    """The request contract: tier 1-3, group in a fixed set (any case), age 0-100 and
    present, sibsp/parch >= 0, fare >= 0 and present, port C/Q/S (any case) or absent."""
    lo_t, hi_t = REQUEST_TIERS
    lo_a, hi_a = REQUEST_AGE_RANGE
    t, g, a, f, p = F.col("tier"), F.col("grp"), F.col("age"), F.col("fare"), F.col("port")
    return [
        Rule("tier_missing", t.isNull()),
        Rule("tier_range", (t < lo_t) | (t > hi_t)),
        Rule("grp_missing", g.isNull()),
        Rule("grp_value", ~F.lower(g).isin(*[x.lower() for x in groups])),
        Rule("age_missing", a.isNull()),
        Rule("age_range", (a < lo_a) | (a > hi_a)),
        Rule("sibsp_negative", F.col("sibsp") < 0),
        Rule("parch_negative", F.col("parch") < 0),
        Rule("fare_missing", f.isNull()),
        Rule("fare_negative", f < 0),
        Rule("port_value", p.isNotNull() & ~F.upper(p).isin(*REQUEST_PORTS)),
    ]


def with_violations(df: DataFrame, rules: list[Rule], out: str = "violations") -> DataFrame:
    """Array of failed rule codes per row (empty when valid); a null test counts as passing."""
    codes = F.array(*[F.when(F.coalesce(r.fails, F.lit(False)), F.lit(r.code)) for r in rules])
    return df.withColumn(out, F.filter(codes, lambda x: x.isNotNull()))


def valid_rows(df: DataFrame, rules: list[Rule], vocabulary: list[str] | None = None) -> DataFrame:
    """Rows that break no rule, ports upper-cased. Groups come in lower case, or, with ``vocabulary`` (the values
    that a model was fitted on), in the spelling that the vocabulary has for them."""
    v = with_violations(df, rules).filter(F.size("violations") == 0).drop("violations")
    group = F.lower("grp")
    if vocabulary is not None:
        spelt = F.create_map(*[F.lit(x) for g in vocabulary for x in (g.lower(), g)])
        group = F.coalesce(F.try_element_at(spelt, group), F.col("grp"))
    return v.withColumns({"port": F.upper("port"), "grp": group})


def rejected_rows(df: DataFrame, rules: list[Rule], id_col: str = "subject_id") -> DataFrame:
    v = with_violations(df, rules).filter(F.size("violations") > 0)
    return v.select(id_col, F.array_join("violations", ",").alias("reasons"), F.size("violations").alias("n_reasons"))


def apply_defaults(df: DataFrame, spec: FeatureSpec = PRESET_A, mode: str = "derive") -> DataFrame:
    """Fill optional request fields. ``mode='reference'`` uses the constant defaults (age
    group 'Adult', title 'Mr' whatever the row); ``mode='derive'`` derives the age group
    from the age instead."""
    d = REQUEST_DEFAULTS
    cols = {
        "sibsp": F.coalesce(F.col("sibsp"), F.lit(d["sibsp"])),
        "parch": F.coalesce(F.col("parch"), F.lit(d["parch"])),
        "port": F.coalesce(F.col("port"), F.lit(d["port"])),
    }
    out = df.withColumns(cols)
    have = set(df.columns)
    title = F.coalesce(F.col("title"), F.lit(d["title"])) if "title" in have else F.lit(d["title"])
    ag_default = age_group("age", spec) if mode == "derive" else F.lit(None).cast("string")
    ag = F.coalesce(F.col("age_group") if "age_group" in have else F.lit(None).cast("string"), ag_default,
                    F.lit(d["age_group"]))
    deck = F.coalesce(F.col("deck") if "deck" in have else F.lit(None).cast("string"), F.lit(d["deck"]))
    fs = F.coalesce(F.col("family_size") if "family_size" in have else F.lit(None).cast("int"), family_size())
    ia = F.coalesce(F.col("is_alone") if "is_alone" in have else F.lit(None).cast("int"), is_alone())
    return out.withColumns({"title": title, "family_size": fs, "is_alone": ia, "age_group": ag, "deck": deck})


def verdict(prob: Column, threshold: float = 0.5, digits: int = 4) -> list[Column]:
    """Probability rounded, 0/1 prediction at the threshold, verdict text."""
    pred = F.when(prob >= threshold, 1).otherwise(0)
    return [F.round(prob, digits).alias("probability"), pred.alias("pred"),
            F.when(pred == 1, F.lit(VERDICT_POSITIVE)).otherwise(F.lit(VERDICT_NEGATIVE)).alias("verdict")]


def positive_probability(pred_df: DataFrame, prob_col: str = "probability") -> Column:
    """Class-1 probability from a Spark ML probability vector."""
    return vector_to_array(F.col(prob_col))[1]


def score_with_model(model, df: DataFrame, id_col: str = "subject_id") -> DataFrame:
    """Apply a fitted pipeline and turn its probability vector into the scorer's output."""
    out = model.transform(df)
    p = positive_probability(out).alias("_p")
    return out.select(id_col, p).select(id_col, *verdict(F.col("_p")))

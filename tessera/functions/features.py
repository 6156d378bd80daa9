"""Derived-feature column expressions (all JVM-side built-ins, no Python on executors)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.spec import AGE_EDGES, SPEC_MARK, TITLE_DEFAULT, TITLE_PATTERN, FeatureSpec, fingerprint


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def title_regex(name) -> Column:
    """First match of the title pattern, group 1; no match (or null) gives null."""
    return F.nullif(F.regexp_extract(_c(name), TITLE_PATTERN, 1), F.lit(""))


def title_split(name) -> Column:
    """Text between the first comma and the next dot, trimmed; no comma gives null."""
    return F.nullif(F.trim(F.split_part(F.split_part(_c(name), F.lit(","), F.lit(2)), F.lit("."), F.lit(1))),
                    F.lit(""))


def map_values(raw, mapping: dict, default: str | None) -> Column:
    """Dictionary lookup with a default for unmapped or null keys.

    The dictionary is a literal map (a handful of fixed keys), so this is a hash lookup in
    generated code rather than a join.
    """
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    looked = F.try_element_at(m, _c(raw))
    return F.coalesce(looked, F.lit(default)) if default is not None else looked


def title_mapped(name, spec: FeatureSpec) -> Column:
    raw = title_regex(name) if spec.title_rule == "regex" else title_split(name)
    return map_values(raw, spec.title_map, TITLE_DEFAULT)


def family_size(sibsp="sibsp", parch="parch") -> Column:
    return (_c(sibsp) + _c(parch) + 1).cast("int")


def is_alone(sibsp="sibsp", parch="parch") -> Column:
    return (family_size(sibsp, parch) == 1).cast("int")


def band(x, edges: list[float], labels: list[str], right_closed: bool = False) -> Column:
    """Label of the band that holds ``x``; outside all bands (or null) gives null.

    Left-closed bands are [e_i, e_{i+1}); right-closed bands are (e_i, e_{i+1}].
    """
    x = _c(x)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = ((x > lo) & (x <= hi)) if right_closed else ((x >= lo) & (x < hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit(None).cast("string"))


def band_index(x, edges: list[float], right_closed: bool = False) -> Column:
    """0-based band ordinal (for ordering), null outside."""
    x = _c(x)
    expr = None
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        cond = ((x > lo) & (x <= hi)) if right_closed else ((x >= lo) & (x < hi))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(None).cast("int"))


def age_group(age, spec: FeatureSpec) -> Column:
    return band(age, AGE_EDGES, list(spec.age_labels), spec.age_right_closed)


def deck(cabin, default: str) -> Column:
    """First character of the cabin; null or empty gives the default."""
    return F.coalesce(F.nullif(F.substring(_c(cabin), 1, 1), F.lit("")), F.lit(default))


def fare_per_person(fare="fare", size=None) -> Column:
    size = family_size() if size is None else _c(size)
    return F.try_divide(_c(fare), size)


def feature_frame(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """All derived features of a spec in one projection, marked with its fingerprint; raw-only columns are dropped."""
    s = spec
    derived = {
        "title": title_mapped(s.name_col, s),
        "family_size": family_size(s.sibsp_col, s.parch_col),
        "is_alone": is_alone(s.sibsp_col, s.parch_col),
        "age_group": age_group(s.age_col, s),
        "deck": deck(s.cabin_col, s.deck_default),
    }
    if s.fare_per_person:
        derived["fare_per_person"] = fare_per_person(s.fare_col, family_size(s.sibsp_col, s.parch_col))
    keep = [c for c in df.columns if c not in s.drop]
    mark = {SPEC_MARK: fingerprint(spec)}
    return df.select(*keep, *[v.alias(k, metadata=mark) for k, v in derived.items()])

"""Rule predicates, schema guards and small projections."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from casewright.functions.scalars import lenient_double
from casewright.operators.skew import salted_lookup
from casewright.rules import Concepts


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def require_nonempty(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def concept_matches(ids: Sequence[int], terms: Sequence[str], id_col: str = "concept_id", name_col: str = "concept_name") -> Column:
    """Concept id in the list, or any term as a case-insensitive literal substring. Empty rule: FALSE."""
    parts: list[Column] = []
    if ids:
        parts.append(F.col(id_col).isin(*ids))
    if terms:
        name = F.lower(F.col(name_col))
        parts += [name.contains(t.lower()) for t in terms]
    if not parts:
        return F.lit(False)
    return F.coalesce(reduce(or_, [F.coalesce(p, F.lit(False)) for p in parts]), F.lit(False))


def with_concept_names(events: DataFrame, concepts: DataFrame) -> DataFrame:
    """Events ⟕ concept table on ``concept_id``: event tables carry ids only, term rules read names.

    ``concepts`` has one name for each id. An id without an entry keeps a NULL name. A frequent concept is split.
    """
    names = concepts.groupBy("concept_id").agg(F.min("concept_name").alias("concept_name"))
    return salted_lookup(events.drop("concept_name"), names, "concept_id", "person_id", "left")


def rule_matches(rule: Concepts) -> Column:
    return concept_matches(rule.ids, rule.terms)


def any_rule_matches(rules: Sequence[Concepts]) -> Column:
    return reduce(or_, [rule_matches(r) for r in rules], F.lit(False))


def within_days(event: Column, anchor: Column, start: int, end: int) -> Column:
    """Directional day window, inclusive at both ends; NULL on either side is False."""
    return F.coalesce(F.datediff(event, anchor).between(start, end), F.lit(False))


def value_at_least(value: Column, minimum: float | None) -> Column:
    return F.lit(True) if minimum is None else F.coalesce(lenient_double(value) >= minimum, F.lit(False))


def tag_events(events: DataFrame, rules: Sequence[Concepts], tag: str = "event") -> DataFrame:
    """One scan, one row per (event, matching rule); an event may match several rules."""
    names = F.array_compact(F.array(*[F.when(rule_matches(r), F.lit(r.label)) for r in rules]))
    return events.withColumn(tag, F.explode(names))


def select_available(df: DataFrame, preferred: Sequence[str]) -> DataFrame:
    """Preferred columns in order, silently skipping the ones the frame lacks."""
    return df.select(*[c for c in preferred if c in df.columns])


def project_annotation(df: DataFrame, mapping: dict[str, str], types: dict[str, str] | None = None) -> DataFrame:
    """Select and rename; absent source columns become typed NULLs."""
    types = types or {}
    return df.select(
        *[
            (F.col(src) if src in df.columns else F.lit(None).cast(types.get(dst, "string"))).alias(dst)
            for src, dst in mapping.items()
        ]
    )


def complete_cases(df: DataFrame, required: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """Numeric coercion first, then drop rows with any NULL in the required or numeric columns."""
    require_columns(df, [*required, *numeric])
    out = df.withColumns({c: lenient_double(c) for c in numeric}) if numeric else df
    return out.dropna(subset=[*required, *numeric])


def case_control_definition(outcome: str = "analysis_case") -> Column:
    case = (F.col(outcome) == 1) & (F.col("broad_case") == 1)
    control = (F.col(outcome) == 0) & (F.col("case_tier") == "control") & F.col("eligible_control").cast("boolean")
    return F.coalesce(case | control, F.lit(False))

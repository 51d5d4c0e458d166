"""Field values merged by strength of evidence."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank

#: Strength of a source; unknown ones have none (fixed values).
RANKS = {"official_site": 4, "semantic_scholar": 3, "dblp": 2, "crossref": 1, "openalex": 1}
STRONG, SURE = 3, 0.7


def rank_of(source: Column | str, ranks: Mapping[str, int] = RANKS) -> Column:
    c = F.lower(F.trim(F.coalesce(F.col(source) if isinstance(source, str) else source, F.lit(""))))
    out = F.lit(0)
    for name, rank in ranks.items():
        out = F.when(c == name, rank).otherwise(out)
    return out


def admissible(proposals: DataFrame, ranks: Mapping[str, int] = RANKS) -> DataFrame:
    """Proposals that may change their field, with rank, is_strong and requires_review.

    proposals(person_id, field, new_value, source, confidence, current_value,
    current_source, current_primary_source). Empty or equal values and official
    rows are left out, and so is weaker evidence for a field that has a value.
    """
    ranked = proposals.withColumns({"rank": rank_of("source", ranks), "current_rank": rank_of("current_source", ranks)})
    kept = ranked.filter(~is_blank("new_value") & ~F.coalesce(F.col("new_value") == F.col("current_value"), F.lit(False)))
    kept = kept.filter(F.coalesce(F.lower("current_primary_source"), F.lit("")) != "official_site")
    kept = kept.filter(is_blank("current_value") | (F.col("rank") >= F.col("current_rank")))
    return kept.withColumns({"is_strong": F.col("rank") >= STRONG, "requires_review": F.col("confidence") < SURE})


def merge(proposals: DataFrame, ranks: Mapping[str, int] = RANKS) -> DataFrame:
    """For each person and field the value of the strongest, then surest proposal; conflicts lists the distinct values.

    Equally strong and sure values are decided by their order as text.
    """
    kept = admissible(proposals, ranks)
    best = F.struct("rank", "confidence", "new_value", "source")
    values = kept.groupBy("person_id", "field", "new_value").agg(F.max(best).alias("best"), F.max_by("requires_review", best).alias("requires_review"))
    return values.groupBy("person_id", "field").agg(
        F.max_by("new_value", "best").alias("value"),
        F.max("best")["source"].alias("source"),
        F.max("best")["rank"].alias("rank"),
        F.max("best")["confidence"].alias("confidence"),
        F.max_by("requires_review", "best").alias("requires_review"),
        F.count(F.lit(1)).alias("n_values"),
        F.when(F.count(F.lit(1)) > 1, F.array_sort(F.collect_set("new_value"))).otherwise(F.array().cast("array<string>")).alias("conflicts"),
    )


def apply_updates(people: DataFrame, merged: DataFrame, fields: Sequence[str], id_column: str = "id") -> DataFrame:
    """people with the winning values: <field>, <field>_source, the larger confidence, and needs_review that sticks."""
    wide = merged.groupBy(F.col("person_id").alias("__id")).agg(
        *(F.max(F.when(F.col("field") == f, F.col("value"))).alias(f"__{f}") for f in fields),
        *(F.max(F.when(F.col("field") == f, F.col("source"))).alias(f"__{f}_source") for f in fields),
        F.max("confidence").alias("__confidence"),
        F.max(F.col("requires_review").cast("int")).alias("__review"),
    )
    joined = people.join(wide, people[id_column] == F.col("__id"), "left")
    changes: dict[str, Column] = {}
    for f in fields:
        changes[f] = F.coalesce(f"__{f}", f)
        changes[f"{f}_source"] = F.coalesce(f"__{f}_source", F.col(f"{f}_source") if f"{f}_source" in people.columns else F.lit(None).cast("string"))
    changes["confidence_score"] = F.greatest("confidence_score", "__confidence").cast("decimal(9,4)")
    changes["review_status"] = F.when(F.col("__review") == 1, "needs_review").otherwise(F.col("review_status"))
    return joined.withColumns(changes).drop(*(c for c in joined.columns if c.startswith("__")))


def describe(merged: DataFrame) -> DataFrame:
    """One display line a change."""
    return merged.withColumn("line", F.format_string("%s: %s <- %s (%s)", F.col("person_id").cast("string"), "field", "value", "source"))

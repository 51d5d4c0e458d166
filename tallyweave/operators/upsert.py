"""Keyed upserts as one aggregation: union, group by key, one policy a column.

Rows carry `seq`, their order of arrival; rows of the target come first. Each
policy is an aggregate that Spark combines before the shuffle, so a hot key
costs one row a task. Only `ordered_set` collects, and what it collects are
distinct values, found by an aggregation of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..durability import kept
from ..functions.text import is_blank, nz

Policy = Callable[[str, str], Column]


def last(c: str, seq: str) -> Column:
    """The latest row's value, even if it is empty."""
    return F.max_by(F.struct(c), seq)[c]


def last_known(c: str, seq: str) -> Column:
    """The latest value that is not null."""
    return F.max_by(c, F.when(F.col(c).isNotNull(), F.col(seq)))


def last_nonempty(c: str, seq: str) -> Column:
    """The latest value that is not empty; an empty text if there is none."""
    return F.coalesce(F.max_by(c, F.when(~is_blank(c), F.col(seq))), F.lit(""))


def last_nonempty_list(c: str, seq: str) -> Column:
    return F.max_by(c, F.when(F.size(c) > 0, F.col(seq)))


def first(c: str, seq: str) -> Column:
    """The earliest row's value: later ones don't change it."""
    return F.min_by(F.struct(c), seq)[c]


def largest(c: str, seq: str) -> Column:
    return F.max(c)


def added(c: str, seq: str) -> Column:
    return F.sum(c)


def ordered_set(c: str, seq: str) -> Column:
    """Distinct items of comma-joined values in order of arrival, joined again.

    `upsert` feeds it the distinct values of a key with their first arrival.
    """
    items = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(seq, c))), lambda x: F.split(F.coalesce(x[c], F.lit("")), ",")))
    return F.array_join(F.array_distinct(F.filter(F.transform(items, lambda x: F.trim(x)), lambda x: x != "")), ",")


def sticky(value: str) -> Policy:
    """`value` once any row has it, else the latest value."""
    return lambda c, seq: F.when(F.max((F.col(c) == value).cast("int")) == 1, F.lit(value)).otherwise(last(c, seq))


def upsert(target: DataFrame | None, changes: DataFrame, key: Sequence[str], policies: Mapping[str, Policy], default: Policy = last, seq: str = "seq", null_keys_differ: bool = False) -> DataFrame:
    """The snapshot after all changes: one row a key, each column by its policy.

    Target rows count as older than any change. null_keys_differ: rows with a
    null in their key are never merged, as a relational unique key has it.
    """
    rows = changes.withColumn("__at", F.struct(F.lit(1).alias("new"), F.col(seq).alias("seq")))
    if target is not None:
        rows = target.withColumn("__at", F.struct(F.lit(0).alias("new"), F.col(seq).alias("seq"))).unionByName(rows, allowMissingColumns=True)
    keys = list(key)
    if null_keys_differ:
        some_null = F.greatest(*(F.col(k).isNull().cast("int") for k in keys), F.lit(0)) == 1
        rows = rows.withColumn("__apart", F.when(some_null, F.col("__at")))
        keys.append("__apart")
    columns = [c for c in rows.columns if c not in (*keys, "__at", "__apart")]
    sets = [c for c in columns if policies.get(c) is ordered_set]
    merged = rows.groupBy(*keys).agg(*(policies.get(c, largest if c == seq else default)(c, "__at").alias(c) for c in columns if c not in sets))
    for c in sets:
        values = rows.groupBy(*keys, c).agg(F.min("__at").alias("__at")).groupBy(*keys).agg(ordered_set(c, "__at").alias(c))
        values = values.select(c, *(F.col(k).alias(f"__of_{k}") for k in keys))
        same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys))
        merged = merged.join(values, same).drop(*(f"__of_{k}" for k in keys))
    return merged.select(*key, *columns)


def insert_or_ignore(target: DataFrame, changes: DataFrame, key: Sequence[str], seq: str = "seq") -> DataFrame:
    """Adds the first change of each key that the target lacks."""
    fresh = changes.join(target.select(*key).distinct(), list(key), "left_anti")
    columns = [c for c in fresh.columns if c not in key]
    firsts = fresh.groupBy(*key).agg(F.min_by(F.struct(*columns), seq).alias("row")).select(*key, "row.*")
    return target.unionByName(firsts, allowMissingColumns=True)


def patch(target: DataFrame, changes: DataFrame, key: Sequence[str], columns: Sequence[str], seq: str = "seq") -> DataFrame:
    """Sets the columns of rows that exist to the latest value that is not null."""
    last_values = changes.groupBy(*key).agg(*(last_known(c, seq).alias(f"__{c}") for c in columns))
    joined = target.join(last_values, list(key), "left")
    return joined.withColumns({c: F.coalesce(f"__{c}", c) for c in columns}).select(*target.columns)


#: Policies of the store's tables; columns that are not named follow `last`.
TABLE_POLICIES: dict[str, tuple[list[str], dict[str, Policy]]] = {
    "sources": (["source_type", "name"], {}),
    "school_seeds": (["school_name_en"], {}),
    "school_entrypoints": (["entry_url"], {}),
    "journals": (["normalized_journal_name", "issn_cn"], {}),
    "papers": (
        ["normalized_title", "year", "journal"],
        {c: last_nonempty for c in ("doi", "url", "abstract", "first_author_name", "paper_url", "source_api_url")}
        | {c: last_nonempty_list for c in ("authors", "corresponding_author_names", "affiliations")}
        | {"source": ordered_set},
    ),
    "candidate_links": (["url"], {"source_id": last_known, "status": first}),
    "pages": (["url"], {"source_id": last_known}),
    "people": (["normalized_name", "school", "primary_source_url"], {"id": first}),
}


def upsert_table(name: str, target: DataFrame | None, changes: DataFrame) -> DataFrame:
    key, policies = TABLE_POLICIES[name]
    return upsert(target, changes, key, policies, null_keys_differ=name == "papers")


def collapse(rows: DataFrame, key: Sequence[str], quality: Sequence[Column], fill: Sequence[str], largest_of: Sequence[str] = (), sticky_flags: Mapping[str, str] | None = None, id_column: str = "id") -> DataFrame:
    """One row for each cluster of duplicates: the best row, its blanks filled from the next best.

    quality: what ranks rows, most important first; the larger id wins ties.
    fill: text columns whose blanks are filled; largest_of: columns that take
    the cluster's maximum; sticky_flags: column -> value that any row imposes.
    Adds merged_ids, the ids that were folded into the survivor.
    """
    rank = F.struct(*quality, F.col(id_column))
    filled = {c: F.coalesce(nz(F.max_by(c, rank)), F.max_by(c, F.when(~is_blank(c), rank)), F.lit("")) for c in fill}
    flags = {c: F.when(F.max((F.col(c) == v).cast("int")) == 1, F.lit(v)).otherwise(F.max_by(c, rank)) for c, v in (sticky_flags or {}).items()}
    rest = [c for c in rows.columns if c not in key and c not in filled and c not in flags and c not in largest_of and c != id_column]
    merged = rows.groupBy(*key).agg(
        F.max_by(id_column, rank).alias(id_column),
        *(e.alias(c) for c, e in (filled | flags).items()),
        *(F.max(c).alias(c) for c in largest_of),
        *(F.max_by(c, rank).alias(c) for c in rest),
        F.array_sort(F.collect_set(id_column)).alias("merged_ids"),
    )
    return merged.withColumn("merged_ids", F.array_remove("merged_ids", F.col(id_column)))


def prefer_existing(changes: DataFrame, people: DataFrame, name: str = "normalized_name", preferred: Column | None = None, id_column: str = "id") -> DataFrame:
    """changes with the id of the person that each belongs to: preferred rows first, then the smallest id."""
    order = F.struct((~F.coalesce(preferred if preferred is not None else F.lit(False), F.lit(False))).alias("p"), F.col(id_column))
    best = people.groupBy(name).agg(F.min_by(id_column, order).alias("person_id"))
    return changes.join(best, name, "left")


# -- stored snapshots ------------------------------------------------------------------------------

#: Parts of a new snapshot, by a hash of the key; as many as make a part fit one task.
STORED_PARTS = 64


def stored_parts(spark: SparkSession, path: str) -> int | None:
    """Number of parts of the snapshot at `path`, as its folders tell; None if there is none."""
    try:
        found = spark.read.parquet(path).select("n_parts").limit(1).collect()
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return found[0]["n_parts"] if found else None


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("n_parts", "part")


def upsert_stored(
    path: str, changes: DataFrame, key: Sequence[str], policies: Mapping[str, Policy], default: Policy = last, seq: str = "seq", null_keys_differ: bool = False, parts: int = STORED_PARTS
) -> int:
    """Brings changes into the snapshot stored at `path`, as `upsert` would; returns the number of parts written.

    The snapshot is partitioned by a hash of the key. Only parts that hold a
    changed key are read and replaced, by Spark's own dynamic overwrite, which
    moves a job's parts into place when all its tasks have ended. A snapshot keeps the number of
    parts that it was made with. The part numbers are all that reaches the driver.
    """
    spark = changes.sparkSession
    n = stored_parts(spark, path)
    count = n or parts
    part = F.pmod(F.xxhash64(*key), F.lit(count)).cast("int")
    changes = kept(changes)
    touched = [r["part"] for r in changes.select(part.alias("part")).distinct().collect()]
    if not touched:
        return 0
    old = None if n is None else spark.read.parquet(path).filter(F.col("part").isin(touched)).drop("n_parts", "part")
    merged = upsert(old, changes, key, policies, default, seq, null_keys_differ).withColumns({"n_parts": F.lit(count), "part": part})
    merged.repartition("part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("n_parts", "part").parquet(path)
    return len(touched)

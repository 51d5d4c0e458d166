"""Resumable batch runs: which work is pending, what a run has counted, how it ended."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.lexicon import Lexicon
from .papers import gate, in_window

RESUMABLE = ("created", "running", "partial")


def latest_resumable(runs: DataFrame, **same: object) -> DataFrame:
    """The newest run with these settings that has not completed (one row or none)."""
    chosen = runs.filter(F.col("status").isin(*RESUMABLE))
    for column, value in same.items():
        chosen = chosen.filter(F.col(column) == value)
    return chosen.orderBy(F.desc("id")).limit(1)


def latest_id(runs: DataFrame) -> DataFrame:
    return runs.agg(F.max("id").alias("id"))


def by_id(table: DataFrame, value: int, id_column: str = "id") -> DataFrame:
    """The row with this id, if any; the filter reaches the scan."""
    return table.filter(F.col(id_column) == value)


def create_run(runs: DataFrame, **settings: object) -> DataFrame:
    """runs with one more row, its id one past the largest."""
    top = runs.agg((F.coalesce(F.max("id"), F.lit(0)) + 1).alias("id"))
    return runs.unionByName(top.select("id", *(F.lit(v).alias(k) for k, v in settings.items()), F.lit("created").alias("status")), allowMissingColumns=True)


def pending(items: DataFrame, run_id: int | None = None, include_completed: bool = False) -> DataFrame:
    own = items if run_id is None else items.filter(F.col("run_id") == run_id)
    return own if include_completed else own.filter(F.col("status") != "completed")


def add_items(items: DataFrame, run_id: Column, journals: DataFrame) -> DataFrame:
    """Pending items for journals that the run does not list yet."""
    new = journals.select(run_id.cast("long").alias("run_id"), F.col("id").alias("journal_id"), "journal_name").dropDuplicates(["run_id", "journal_id"])
    new = new.join(items.select("run_id", "journal_id"), ["run_id", "journal_id"], "left_anti")
    fresh = new.select("*", F.lit("pending").alias("status"), *(F.lit(0).alias(c) for c in ("attempts", "papers_seen", "papers_saved")), F.lit("").alias("last_error"))
    return items.unionByName(fresh, allowMissingColumns=True)


def record(items: DataFrame, results: DataFrame) -> DataFrame:
    """items after an attempt: counters add up, an item fails only if every source failed.

    results(run_id, journal_id, source, seen, saved, error): one row a source.
    """
    failed = F.coalesce(F.col("error"), F.lit("")) != ""
    done = results.groupBy("run_id", "journal_id").agg(
        F.sum("seen").alias("seen"), F.sum("saved").alias("saved"), (F.count_if(failed) == F.count(F.lit(1))).alias("all_failed"), F.max(F.when(failed, F.col("error"))).alias("error")
    )
    joined = items.join(done, ["run_id", "journal_id"], "left")
    tried = F.col("all_failed").isNotNull()
    changes = {
        "attempts": F.col("attempts") + tried.cast("int"),
        "papers_seen": (F.col("papers_seen") + F.coalesce("seen", F.lit(0))).cast(items.schema["papers_seen"].dataType),
        "papers_saved": (F.col("papers_saved") + F.coalesce("saved", F.lit(0))).cast(items.schema["papers_saved"].dataType),
        "status": F.when(F.col("all_failed"), "failed").when(tried, "completed").otherwise(F.col("status")),
        "last_error": F.coalesce("error", "last_error"),
    }
    return joined.withColumns(changes).select(*items.columns)


def status_counts(items: DataFrame) -> DataFrame:
    return items.groupBy("run_id", "status").agg(F.count(F.lit(1)).alias("items"))


def run_status(items: DataFrame) -> DataFrame:
    """Each run's items by status, and whether it has completed."""
    return items.groupBy("run_id").agg(
        *(F.count_if(F.col("status") == s).alias(s) for s in ("pending", "running", "completed", "failed")),
        F.when(F.count_if(F.col("status") != "completed") == 0, "completed").otherwise("partial").alias("run_status"),
    )


def set_status(runs: DataFrame, run_id: int, status: str, at: Column, started: bool = False, finished: bool = False) -> DataFrame:
    """runs with a new status; the first start stays, the last finish counts."""
    own = F.col("id") == run_id
    return runs.withColumns({
        "status": F.when(own, status).otherwise(F.col("status")),
        "started_at": F.when(own & F.lit(started), F.coalesce("started_at", at)).otherwise(F.col("started_at")),
        "finished_at": F.when(own & F.lit(finished), at).otherwise(F.col("finished_at")),
    })


def run_batch(items: DataFrame, works: DataFrame, journals: DataFrame, run_id: int, sources: list[str]) -> tuple[DataFrame, DataFrame]:
    """Papers of a run's pending items and its items afterwards; completed items are left alone.

    works(journal_id, source, ...): a dump of all sources. A source without
    rows for a journal is an error of that source.
    """
    todo = pending(items, run_id).select("run_id", "journal_id")
    known = todo.join(journals.select(F.col("id").alias("journal_id"), F.lit(True).alias("known")), "journal_id", "left")
    papers = works.filter(F.col("source").isin(*sources)).join(todo, "journal_id")
    asked = known.withColumn("source", F.explode(F.array(*map(F.lit, sources))))
    got = papers.groupBy("run_id", "journal_id", "source").agg(F.count(F.lit(1)).alias("n"))
    results = asked.join(got, ["run_id", "journal_id", "source"], "left").select(
        "run_id", "journal_id", "source", F.coalesce("n", F.lit(0)).alias("seen"), F.coalesce("n", F.lit(0)).alias("saved"),
        F.when(F.col("known").isNull(), "journal not found").when(F.col("n").isNull(), F.concat(F.lit("no rows from "), "source")).otherwise("").alias("error"),
    )
    return papers, record(items, results)


def open_run(runs: DataFrame, items: DataFrame, journals: DataFrame, resume: bool = True, **settings: object) -> tuple[DataFrame, DataFrame, int]:
    """Runs, items and id of a batch with these settings: the newest that has not completed if resumed, else a new one.

    settings: journal_group, from_year, works_per_journal, sources (and run_name,
    which names a new run but does not tell runs apart). The run lists every
    journal; those that it lists already keep their state.
    """
    same = {k: v for k, v in settings.items() if k != "run_name"}
    found = latest_resumable(runs, **same).select("id").collect() if resume else []
    if found:
        run_id = int(found[0].id)
    else:
        name = settings.get("run_name") or f"{settings.get('journal_group')}-{settings.get('from_year')}-{settings.get('works_per_journal')}"
        runs = create_run(runs, **(settings | {"run_name": name}))
        run_id = int(latest_id(runs).first().id)
    return runs, add_items(items, F.lit(run_id), journals), run_id


def run_job(runs: DataFrame, items: DataFrame, works: DataFrame, journals: DataFrame, run_id: int, at: Column, current_year: int, lexicon: Lexicon | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Runs, items, papers and issues after a run's pending journals were collected with the run's own settings.

    works(journal_id, source, year, title, abstract, journal, ...) is a dump of
    all sources. Papers outside the window, and with a lexicon those that are not
    relevant, are left out of `saved` but counted as seen; of a journal and
    source at most works_per_journal are taken, the newest first. The run is
    completed when all its items are, else partial.
    """
    setting = runs.filter(F.col("id") == run_id).select("from_year", "works_per_journal", "sources").first()
    sources = [s for s in (setting.sources or "").split(",") if s]
    started = set_status(runs, run_id, "running", at, started=True)
    todo = pending(items, run_id).select("run_id", "journal_id")
    known = todo.join(journals.select(F.col("id").alias("journal_id"), "journal_name"), "journal_id", "left")
    inside = in_window("year", setting.from_year, current_year)
    own = works.filter(F.col("source").isin(*sources)).join(known.filter("journal_name is not null"), "journal_id")
    newest = Window.partitionBy("journal_id", "source").orderBy(F.desc("year"), "title")
    taken = own.filter(inside).withColumn("nth", F.row_number().over(newest)).filter(F.col("nth") <= setting.works_per_journal).drop("nth")
    papers, rejected = gate(taken, lexicon) if lexicon is not None else (taken, None)
    seen = taken.groupBy("run_id", "journal_id", "source").agg(F.count(F.lit(1)).alias("seen"))
    saved = papers.groupBy("run_id", "journal_id", "source").agg(F.count(F.lit(1)).alias("saved"))
    asked = known.withColumn("source", F.explode(F.array(*map(F.lit, sources))))
    zero = lambda c: F.coalesce(c, F.lit(0))
    results = asked.join(seen, ["run_id", "journal_id", "source"], "left").join(saved, ["run_id", "journal_id", "source"], "left").select(
        "run_id", "journal_id", "source", zero("seen").alias("seen"), zero("saved").alias("saved"),
        F.when(F.col("journal_name").isNull(), "journal not found").when(F.col("seen").isNull(), F.concat(F.lit("no rows from "), "source")).otherwise("").alias("error"),
    )
    after = record(items, results)
    errors = results.filter("error != ''").select(F.lit("publication_run_items").alias("related_table"), F.lit("publication_source_error").alias("issue_type"), F.lit("medium").alias("severity"), F.col("error").alias("message"), F.lit("").alias("source_url"), F.lit("open").alias("status"))
    issues = errors if rejected is None else errors.unionByName(rejected, allowMissingColumns=True)
    done = after.filter(F.col("run_id") == run_id).agg(F.count_if(F.col("status") != "completed").alias("left")).first()["left"] == 0
    return set_status(started, run_id, "completed" if done else "partial", at, finished=True), after, papers, issues

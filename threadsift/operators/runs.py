"""Pipeline runs and errors, folded from their event logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import refdata


_MOMENT = "struct(at, seq)"


def _last(value: str, when: str = "true") -> Column:
    """The latest (at, seq, value) of the rows where ``when`` holds. It is a maximum by
    (at, seq), so maxima of parts are merged by another maximum."""
    return F.expr(f"max_by(struct(at, seq, {value}), {_MOMENT}) FILTER (WHERE {when})").alias(f"last_{value}")


def _merged(states: DataFrame, keys: list[str]) -> DataFrame:
    """One state for each key out of states of parts of its events."""
    merged = [
        F.expr(f"{'min' if c.startswith('first') else 'max'}_by({c}, struct({c}.at, {c}.seq)) FILTER (WHERE {c} IS NOT NULL)").alias(c)
        for c in states.columns if c not in keys
    ]
    return states.groupBy(*keys).agg(*merged)


def step_states(events: DataFrame) -> DataFrame:
    """What later events can still change of each (run, step), from any part of the
    events: a first event, and the latest ones with a status, an ended status, a count
    and a note. States merge in any order, and taking in an event twice changes nothing.
    Expects ``seq`` to order events of one instant."""
    return events.groupBy("run_id", "name").agg(
        F.expr(f"min_by(struct(at, seq, sequence), {_MOMENT})").alias("first_sequence"),
        _last("status"),
        F.expr(f"max_by({_MOMENT}, {_MOMENT}) FILTER (WHERE status <> 'running')").alias("last_end"),
        _last("count", "count IS NOT NULL"),
        _last("note", "note IS NOT NULL"),
    )


def merge_steps(states: DataFrame) -> DataFrame:
    return _merged(states, ["run_id", "name"])


def steps_of(states: DataFrame) -> DataFrame:
    """The step rows of merged states."""
    place = F.row_number().over(
        Window.partitionBy("run_id").orderBy("first_sequence.at", "first_sequence.seq")
    )
    return states.withColumn("position", place).select(
        "run_id",
        "position",
        "name",
        F.col("first_sequence.at").alias("started_at"),
        F.col("last_end.at").alias("ended_at"),
        F.col("last_status.status").alias("status"),
        F.col("last_count.count").alias("count"),
        F.col("last_note.note").alias("note"),
        F.coalesce(F.col("first_sequence.sequence"), F.col("position")).alias("sequence"),
    )


def fold_steps(events: DataFrame) -> DataFrame:
    """One row per (run, step): first event gives the start, the last one the
    status, the last one that is not ``running`` the end; count and note keep
    their last non-null value. ``sequence`` is the first event's, else the
    step's position in the run. Expects ``seq`` to order events of one instant."""
    return steps_of(step_states(events))


def steps_array(steps: DataFrame) -> DataFrame:
    """One row per run with its steps in the order they were appended."""
    step = F.struct(
        "position",
        F.struct(
            "name", "started_at", "ended_at", "status", "count", "note", "sequence"
        ).alias("step"),
    )
    return steps.groupBy("run_id").agg(
        F.transform(F.array_sort(F.collect_list(step)), lambda s: s["step"]).alias("steps")
    )


def started(starts: DataFrame) -> DataFrame:
    """Rows of just-started runs, from (run_id, product, script, mode, at)."""
    return starts.select(
        F.col("run_id").alias("id"), "product", "script", "mode",
        F.col("at").alias("started_at"),
        F.lit(None).cast("timestamp").alias("ended_at"),
        F.lit("running").alias("status"),
        F.lit(None).cast("map<string,string>").alias("stats"),
        F.lit(None).cast("string").alias("error_id"),
    )


def end_states(ends: DataFrame) -> DataFrame:
    """The same for end events of runs: the latest status, stats and error id."""
    return ends.groupBy("run_id").agg(
        _last("status"), _last("stats", "stats IS NOT NULL"), _last("error_id", "error_id IS NOT NULL")
    )


def merge_ends(states: DataFrame) -> DataFrame:
    return _merged(states, ["run_id"])


def ends_of(states: DataFrame) -> DataFrame:
    """One row per ended run: last status and time; stats and error id keep the last
    value that was given."""
    return states.select(
        "run_id",
        F.col("last_status.status").alias("_status"),
        F.col("last_status.at").alias("_ended_at"),
        F.col("last_stats.stats").alias("_stats"),
        F.col("last_error_id.error_id").alias("_error_id"),
    )


def fold_runs(
    starts: DataFrame, ends: DataFrame, step_events: DataFrame, errors: DataFrame
) -> DataFrame:
    """The run table. Runs without an end event stay ``running``; error ids that
    no error row bears become NULL."""
    return runs_of(starts, end_states(ends), step_states(step_events), errors)


def runs_of(starts: DataFrame, ends: DataFrame, steps: DataFrame, errors: DataFrame) -> DataFrame:
    """The run table out of merged states of end and step events."""
    known = errors.select(F.col("id").alias("_known"))
    folded = (
        started(starts)
        .join(ends_of(ends).withColumnRenamed("run_id", "id"), "id", "left")
        .join(
            steps_array(steps_of(steps)).withColumnRenamed("run_id", "id"),
            "id", "left",
        )
    )
    merged = folded.select(
        "id", "product", "script", "mode", "started_at",
        F.coalesce("_ended_at", "ended_at").alias("ended_at"),
        F.coalesce("_status", "status").alias("status"),
        F.coalesce("steps", F.array().cast(folded.schema["steps"].dataType)).alias("steps"),
        F.coalesce("_stats", "stats", F.create_map().cast("map<string,string>")).alias("stats"),
        F.coalesce("_error_id", "error_id").alias("_error_id"),
    )
    return null_orphans(merged, known)


def null_orphans(runs: DataFrame, known: DataFrame) -> DataFrame:
    """Keeps ``_error_id`` as ``error_id`` where the error still exists. Runs without
    one, mostly the larger part, never enter the join."""
    named = runs.filter(F.col("_error_id").isNotNull()).join(
        known.select("_known").distinct(), F.col("_error_id") == F.col("_known"), "left"
    )
    unnamed = runs.filter(F.col("_error_id").isNull()).withColumn("_known", F.col("_error_id"))
    kept = [c for c in runs.columns if c != "_error_id"]
    return named.select(*kept, F.col("_known").alias("error_id")).unionByName(
        unnamed.select(*kept, F.col("_known").alias("error_id"))
    )


def error_rows(reported: DataFrame, chars: int = refdata.LOG_MESSAGE_CHARS) -> DataFrame:
    """Error table rows from (id, at, product, script, mode, message, traceback,
    run_id): short message, unresolved."""
    return reported.select(
        "id",
        F.col("at").alias("occurred_at"),
        "product", "script", "mode",
        F.left(F.coalesce("message", F.lit("")), F.lit(chars)).alias("message"),
        "traceback",
        F.lit(False).alias("resolved"),
        F.lit(None).cast("timestamp").alias("resolved_at"),
        F.lit(None).cast("string").alias("resolved_by"),
        "run_id",
    )


def failed_ends(reported: DataFrame) -> DataFrame:
    """End events of runs that failed with a reported error."""
    return reported.filter(F.col("run_id").isNotNull()).select(
        "run_id",
        F.lit("failed").alias("status"),
        F.lit(None).cast("map<string,string>").alias("stats"),
        F.col("id").alias("error_id"),
        "at",
        "seq",
    )


def resolve_errors(errors: DataFrame, resolutions: DataFrame) -> DataFrame:
    """Marks errors as resolved from (id, resolved_by, at, seq); the last one wins
    and an unnamed resolver is ``frontend``."""
    last = resolutions.groupBy("id").agg(
        F.max_by(F.struct("resolved_by", "at"), F.struct("at", "seq")).alias("_r")
    )
    hit = F.col("_r").isNotNull()
    change = {
        "resolved": F.col("resolved") | hit,
        "resolved_at": F.when(hit, F.col("_r.at")).otherwise(F.col("resolved_at")),
        "resolved_by": F.when(
            hit, F.coalesce("_r.resolved_by", F.lit("frontend"))
        ).otherwise(F.col("resolved_by")),
    }
    return errors.join(last, "id", "left").select(
        *[change.get(c, F.col(c)).alias(c) for c in errors.columns]
    )


def error_of_run(runs: DataFrame, errors: DataFrame) -> DataFrame:
    """Runs with the message of the error that ended them; of several rows of one
    error the first to occur. Runs without an error never enter the join."""
    shown = errors.groupBy(F.col("id").alias("error_id")).agg(
        F.min_by(F.struct("message", "resolved"), F.struct("occurred_at", "message")).alias("_e")
    ).select("error_id", "_e.message", "_e.resolved")
    named = runs.filter(F.col("error_id").isNotNull()).join(shown, "error_id", "left")
    unnamed = runs.filter(F.col("error_id").isNull()).withColumns(
        {c: F.lit(None).cast(errors.schema[c].dataType) for c in ("message", "resolved")}
    )
    return named.unionByName(unnamed)


def with_default_array(df: DataFrame, column: str) -> DataFrame:
    """A column older files lack, filled with its default."""
    empty = F.array().cast("array<string>")
    if column not in df.columns:
        return df.withColumn(column, empty)
    return df.withColumn(column, F.coalesce(F.col(column), empty))


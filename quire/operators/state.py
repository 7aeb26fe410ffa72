"""Pipeline state: a map of stages per project, and listings of projects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stages in their order; fixed values of the state files.
STAGES = ("init", "extract", "normalize", "split", "chunk", "translate", "assemble", "review", "publish")
RUNNABLE = STAGES[1:]


def stages_until(until: str) -> list[str]:
    if until not in RUNNABLE:
        raise ValueError(f"unknown stage {until!r}; there are {', '.join(RUNNABLE)}")
    return list(RUNNABLE[: RUNNABLE.index(until) + 1])


def initial_stages() -> Column:
    return F.create_map(*(F.lit(x) for s in STAGES for x in (s, "done" if s == "init" else "pending")))


def next_pending(stages: Column) -> Column:
    """The first pending stage, null if there is none."""
    order = F.array(*(F.lit(s) for s in STAGES))
    return F.get(F.filter(order, lambda s: F.coalesce(stages[s] == "pending", F.lit(False))), F.lit(0))


def update_stage(states: DataFrame, stage: str, status: Column | str) -> DataFrame:
    """(current_stage, stages) after a stage: done moves on to the next pending stage, if there is one; an error stays."""
    value = F.lit(status) if isinstance(status, str) else status
    stages = F.map_concat(F.map_filter("stages", lambda k, _: k != stage), F.create_map(F.lit(stage), value))
    out = states.withColumn("stages", stages)
    return out.withColumn("current_stage", F.when(value == "done", F.coalesce(next_pending(F.col("stages")), F.col("current_stage"))).otherwise(F.col("current_stage")))


def list_projects(metadata: DataFrame, states: DataFrame) -> DataFrame:
    """(project_id, title, current_stage) of projects that have both."""
    return metadata.join(states, "book_id").select(F.col("book_id").alias("project_id"), F.coalesce("title", F.lit("Untitled")).alias("title"), F.coalesce("current_stage", F.lit("unknown")).alias("current_stage")).orderBy("project_id")


def project_status(metadata: DataFrame, states: DataFrame) -> DataFrame:
    """(book_id, title, stage_pos, stage, status): every stage of every project."""
    order = F.array(*(F.lit(s) for s in STAGES))
    rows = metadata.join(states, "book_id").select("book_id", "title", "stages", F.posexplode(order).alias("stage_pos", "stage"))
    return rows.select("book_id", "title", "stage_pos", "stage", F.coalesce(F.col("stages")[F.col("stage")], F.lit("pending")).alias("status"))


def project_table(projects: DataFrame) -> DataFrame:
    """(project_id, line): rows padded to the widest value of each column."""
    columns = ("project_id", "title", "current_stage")
    widest = projects.agg(*(F.greatest(F.max(F.length(c)), F.lit(len(c))).alias(f"w_{c}") for c in columns))
    padded = [F.rpad(F.col(c), F.col(f"w_{c}"), F.lit(" ")) for c in columns]
    return projects.crossJoin(F.broadcast(widest)).select("project_id", F.concat_ws("  ", *padded).alias("line"))  # one row of widths

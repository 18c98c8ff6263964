"""Counts taken while a table is written, without a scan of their own.

``observe`` hangs aggregates on a plan; they are there once the action that runs it is done.
Tasks that run again after an executor was lost would be counted twice, so a count is only
trusted when every stage of the action ran each of its tasks once; else it is asked for again
in a plan of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def _ran_once(spark: SparkSession, group: str) -> bool:
    """Whether no task of the group's jobs failed or ran twice."""
    tracker = spark.sparkContext.statusTracker()
    for job in tracker.getJobIdsForGroup(group):
        info = tracker.getJobInfo(job)
        if info is None:
            return False
        for stage_id in info.stageIds:
            stage = tracker.getStageInfo(stage_id)
            if stage is None or stage.currentAttemptId or stage.numFailedTasks \
                    or stage.numCompletedTasks not in (0, stage.numTasks):
                return False
    return True


class Watch:
    """Named aggregates over plans that one action will run."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._asked: dict[str, tuple[Observation, DataFrame, list[Column]]] = {}

    def on(self, name: str, df: DataFrame, aggregates: Mapping[str, Column]) -> DataFrame:
        """``df``, whose rows are counted on their way under ``name``."""
        if not aggregates:
            return df
        found = Observation(f"{name} {uuid.uuid4().hex}")
        columns = [value.alias(key) for key, value in aggregates.items()]
        self._asked[name] = (found, df, columns)
        return df.observe(found, *columns)

    def run(self, action: Callable[[], object]) -> dict[str, dict[str, object]]:
        """Run the action and give (name -> aggregate -> value)."""
        context, group = self.spark.sparkContext, f"watched {uuid.uuid4().hex}"
        before = context.getLocalProperty("spark.jobGroup.id")
        context.setLocalProperty("spark.jobGroup.id", group)
        try:
            action()
        finally:
            context.setLocalProperty("spark.jobGroup.id", before)
        once = _ran_once(self.spark, group)
        # a plan that is empty by its statistics is cut short and never reports
        return {name: found.get if once and found._jo.getRow().schema() is not None
                else df.agg(*columns).first().asDict()
                for name, (found, df, columns) in self._asked.items()}

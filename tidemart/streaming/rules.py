"""Routing rules that a job has met, kept in a small table that only grows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemart import schemas as S
from tidemart.operators.routing import rules_first_wins

SHAPE = T.StructType([*S.RULE.fields, T.StructField("arrival", T.LongType())])


class Rules:
    """The rule of every (table, operation): the first to arrive, or the last with ``latest``.

    A batch adds only the rules that change what is kept. Which rule wins does not depend on how often or in which order
    rules are added, so a retried batch changes nothing. The table outlives checkpoints.
    """

    def __init__(self, spark: SparkSession, path: str, latest: bool = False):
        self.spark, self.path, self.latest = spark, path, latest

    def start(self, records: Callable[[], DataFrame]) -> None:
        """Take the rules that there are so far, unless the table has been made before."""
        if self._stored() is None:
            self._add(rules_first_wins(records().select(SHAPE.names), latest=self.latest))

    def _stored(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(SHAPE).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _add(self, rules: DataFrame) -> None:
        rules.coalesce(1).write.mode("append").parquet(self.path)

    def with_new(self, rules: DataFrame) -> DataFrame:
        """The rules to go by, with those of a batch, which are kept from now on."""
        known, new = self._stored(), rules.select(SHAPE.names).persist()
        if not new.isEmpty():
            best = rules_first_wins(known.unionByName(new), latest=self.latest)
            changed = best.exceptAll(rules_first_wins(known, latest=self.latest)).persist()
            if not changed.isEmpty():
                self._add(changed)
                known = self._stored()
            changed.unpersist()
        new.unpersist()
        return rules_first_wins(known, latest=self.latest)

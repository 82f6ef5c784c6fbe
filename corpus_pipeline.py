"""The training-data pipeline: every stage takes the documents its predecessor kept and returns documents.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame. The stages
decide on what they are given only. ``run`` writes each stage below the shared folder and reads it back.
"""

from pyspark.sql import DataFrame, SparkSession

from tierwell.llm.common import drop_unused, ship, stored, table
from tierwell.llm.pipeline import STAGES as _STAGES


def _shipping(stage):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        drop_unused(docs)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [(name, _shipping(stage)) for name, stage in _STAGES]

# Tokenising, seeded epochs and linear programming are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Cutting lineage where a result is used more than once or is dear to compute again."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, which all executors share; only where none is set and all runs on
    one machine, as in tests, a temporary one is. On a cluster without a folder nothing can be cut."""
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame, guess: bool = True) -> DataFrame:
    """The same rows, read from a checkpoint in the shared folder: lost executors lose none of them.

    guess: keep the size that Spark guesses from df's plan. Rows exploded before the cut aren't in it, so that
    what is large may be broadcast through the driver, and by joins in a loop it grows to numbers of millions
    of digits. Without it the size is unknown, and a join is broadcast only for what a shuffle has measured.
    """
    shared_folder(df.sparkSession)
    out = df.checkpoint(eager=True)
    if guess:
        return out
    jvm, session, plan = df.sparkSession._jvm, out._jdf.sparkSession(), out._jdf.queryExecution().analyzed()
    nothing = getattr(getattr(jvm.scala, "None$"), "MODULE$")
    bare = plan.copy(plan.output(), plan.rdd(), plan.outputPartitioning(), plan.outputOrdering(), plan.isStreaming(), plan.stream(), session, nothing, nothing)
    return DataFrame(jvm.org.apache.spark.sql.classic.Dataset.ofRows(session, bare), df.sparkSession)

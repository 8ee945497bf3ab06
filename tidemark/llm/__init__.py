"""Operators for training-data pipelines: packing, encoding, search, deduplication, classifiers, scans."""

import os

from pyspark.sql import DataFrame, SparkSession


#: Texts are long and may be very long: so many bytes of them go to a Python worker at a time.
BATCH_BYTES = 8 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def let_workers_import(spark: SparkSession) -> None:
    """Put this library on the import path of Python workers that see the same files, and bound their batches.

    On a cluster without a shared install, ship it with --py-files instead. A
    smaller bound that the session has set stays.
    """
    held = spark.conf.get(_BATCH_CONF).rstrip("bB")
    if not held.isdigit() or int(held) > BATCH_BYTES:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that ``df`` does not have, whatever their case: these, with underscores in front if need be."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name in taken:
            name = f"_{name}"
        taken.add(name)
        out.append(name)
    return out

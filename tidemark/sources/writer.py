"""One writer at a time: numbered claims on a folder, the newest one counts."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.session import create_new, list_folder, path_exists

_PREFIX = "claim-"


class StaleWriterError(RuntimeError):
    """A newer session has claimed the folder."""


def claim_writer(spark: SparkSession, *paths: str) -> None:
    """Make this session the writer of targets or state logs; sessions that claimed them before are refused.

    A claim is an empty file with the next number, created only if it is absent,
    so of two sessions that claim at once one fails. The file system must create
    files exclusively, as HDFS does. Folders that nobody claimed stay open to all.
    """
    for path in paths:
        number = newest_claim(spark, path) + 1
        if not create_new(spark, f"{_claims(path)}/{_PREFIX}{number}"):
            raise StaleWriterError(f"{path} was claimed by another session at the same time")
        spark.conf.set(_setting(path), str(number))


def check_writer(spark: SparkSession, path: str) -> None:
    """Before data, deletes and state: an error if the newest claim is not of this session."""
    newest = newest_claim(spark, path)
    held = int(spark.conf.get(_setting(path), "0"))
    if newest != held:
        raise StaleWriterError(f"{path} has a newer writer: claim {newest}, this session holds {held or 'none'}")


def newest_claim(spark: SparkSession, path: str) -> int:
    """The number of the newest claim, 0 if there is none."""
    if not path_exists(spark, _claims(path)):
        return 0
    names = (file.rsplit("/", 1)[-1] for file in list_folder(spark, _claims(path)))
    return max((int(n.removeprefix(_PREFIX)) for n in names if n.startswith(_PREFIX)), default=0)


def _claims(path: str) -> str:
    return f"{path.rstrip('/')}/_writers"  # readers pass over such names


def _setting(path: str) -> str:
    return f"tidemark.writer.{path.rstrip('/')}"

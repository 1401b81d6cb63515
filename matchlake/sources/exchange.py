"""Change some files of a table, so that a job that breaks off anywhere loses no row.

New files are written into a folder beside the table. A plan put there with one rename says
which old files they replace: before it stands nothing has happened to the table, after it
the exchange is carried through, by the next writer if its own job breaks off. New files
come in before old ones go, so a reader in between sees rows twice, but misses none.

An exchange may carry the number of a batch. The table remembers the last number of each
stream of batches, and a batch that comes again changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import SparkSession

from matchlake.sources import files

PARTS = "__parts_"
_PLAN = "_exchange.json"
_BATCH = "_batch_"

#: A stream's name and the number of its batch.
Batch = tuple[str, int]


def batch_done(spark: SparkSession, path: str, batch: Batch | None) -> bool:
    if batch is None:
        return False
    last = files.read_whole(spark, f"{path}/{_BATCH}{batch[0]}")
    return last is not None and int(last) >= batch[1]


def _carry_through(spark: SparkSession, path: str, staged: str) -> None:
    plan = json.loads(files.read_text(spark, f"{staged}/{_PLAN}"))
    for name in files.data_files(spark, staged):
        if not files.exists(spark, f"{path}/{name}"):
            files.make_parents(spark, f"{path}/{name}")
            files.rename(spark, f"{staged}/{name}", f"{path}/{name}")
    for name in plan["gone"]:
        files.delete(spark, f"{path}/{name}")
    # A partition all of whose rows went is no longer there.
    for folder in sorted({name.rpartition("/")[0] for name in plan["gone"]} - {""}):
        if not files.has_data_file(spark, f"{path}/{folder}"):
            files.delete(spark, f"{path}/{folder}")
    if plan["batch"]:
        stream, number = plan["batch"]
        if not batch_done(spark, path, (stream, number)):
            files.write_whole(spark, f"{path}/{_BATCH}{stream}", str(number))
    files.delete(spark, staged)


def finish(spark: SparkSession, path: str) -> None:
    """Carry through an exchange that broke off; forget one that had not been planned yet."""
    for staged in files.beginning_with(spark, path + PARTS):
        if files.exists(spark, f"{staged}/{_PLAN}"):
            _carry_through(spark, path, staged)
        else:
            files.delete(spark, staged)


def exchange(
    spark: SparkSession,
    path: str,
    write: Callable[[str], None],
    gone: Iterable[str] = (),
    batch: Batch | None = None,
) -> None:
    """Replace the files ``gone`` (as Spark names them) by what ``write`` puts into a folder."""
    staged = f"{path}{PARTS}{uuid.uuid4().hex[:8]}"
    write(staged)
    plan = {"gone": [files.inside(spark, path, uri) for uri in gone], "batch": batch}
    files.write_whole(spark, f"{staged}/{_PLAN}", json.dumps(plan))
    _carry_through(spark, path, staged)

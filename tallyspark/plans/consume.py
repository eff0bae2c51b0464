"""Inputs are deleted once their ledger is there (A9), whatever crashes.

Three steps, each a file or a deletion of the storage's own file system:

1. *intent*: a file in the log folder names the inputs (with length and time)
   and the ledger they go into;
2. the ledger is written; its commit mark is what step 3 looks for;
3. the inputs are deleted, then the intent.

``recover`` finishes or drops what a crash left: with the ledger committed
the deletions are repeated, without it the intent goes and the inputs stay
for the next run.  A file that was replaced since is not the one that was
read, and stays.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from tallyspark.sources.versions import _fs, delete_path, names_in, read_text, write_once


def _stamp(spark: SparkSession, file: str) -> list | None:
    """[length, modification time] of a file, None where there is none."""
    fs, p = _fs(spark, file)
    if not fs.exists(p):
        return None
    s = fs.getFileStatus(p)
    return [int(s.getLen()), int(s.getModificationTime())]


def intend(spark: SparkSession, log_dir: str, files: list[str], commit_mark: str) -> str:
    """Step 1.  ``commit_mark``: the file that exists once the ledger is
    committed.  Returns the intent's path."""
    path = f"{log_dir.rstrip('/')}/{uuid.uuid4().hex}.json"
    known = {f: _stamp(spark, f) for f in files}
    write_once(spark, path, json.dumps({"commit": commit_mark, "files": {f: s for f, s in known.items() if s}}))
    return path


def finish(spark: SparkSession, intent: str) -> list[str]:
    """Step 3: the deleted files, or none if the ledger is not committed."""
    told = json.loads(read_text(spark, intent))
    gone = []
    if _stamp(spark, told["commit"]) is not None:
        for file, stamp in sorted(told["files"].items()):
            if _stamp(spark, file) == stamp:
                delete_path(spark, file)
                gone.append(file)
    delete_path(spark, intent)
    return gone


def recover(spark: SparkSession, log_dir: str) -> list[str]:
    """Ends every intent that a crash left; the files deleted."""
    return [f for n in names_in(spark, log_dir) if n.endswith(".json") for f in finish(spark, f"{log_dir.rstrip('/')}/{n}")]


def consume(spark: SparkSession, log_dir: str, files: list[str], commit_mark: str, commit: Callable[[], None]) -> list[str]:
    """All three steps around ``commit``, which writes the ledger."""
    recover(spark, log_dir)
    intent = intend(spark, log_dir, files, commit_mark)
    commit()
    return finish(spark, intent)

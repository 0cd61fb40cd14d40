"""The audit log: one row per target and run.

On file tables each row is a folder of its own, below a folder of its group, and the table lists
folders recursively. Writers, also of other drivers, share no file and need no lock. A delete
removes the run folders that it has listed, by name; a row that is recorded meanwhile has another
folder and stays. `compact` writes the finished folders of a group into one and then removes those.
Nothing ever points the table elsewhere.
"""

from __future__ import annotations

import logging
import re
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime
from hashlib import sha256
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import group_key
from strata.operators.delete import delete_where
from strata.operators.tables import Layout, layout_of
from strata.schemas import AUDIT, AUDIT_TABLE, GROUP
from strata.site import Site

log = logging.getLogger(__name__)

#: Characters of a message in the audit log.
MESSAGE_LIMIT = 400
#: Seconds after which the claim of a driver that was lost is void.
CLAIM_SECONDS = 3600
#: In a compacted folder: the folders that it stands for. Readers of the table skip such names.
STANDS_FOR, FINISHED, CLAIM = "_stands_for", "_SUCCESS", "_claimed"


class AuditBusy(RuntimeError):
    """Another driver deletes from or compacts the same group."""


class _Folder:
    """A folder of the log, through Spark's own view of the file system."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm.org.apache.hadoop.fs
        self._here = self._jvm.Path(self.path)
        self._files = self._here.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def __truediv__(self, name: str) -> _Folder:
        return _Folder(self.spark, f"{self.path}/{name}")

    @property
    def name(self) -> str:
        return self._here.getName()

    def exists(self) -> bool:
        return self._files.exists(self._here)

    def has(self, name: str) -> bool:
        return self._files.exists(self._jvm.Path(self._here, name))

    def children(self) -> list[_Folder]:
        """What readers of the table see here."""
        if not self.exists():
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(self._here)]
        return [self / name for name in sorted(names) if not name.startswith(("_", "."))]

    def remove(self) -> None:
        self._files.delete(self._here, True)

    def age(self) -> float:
        """Seconds since it was written, by the clock of whoever wrote it."""
        return time.time() - self._files.getFileStatus(self._here).getModificationTime() / 1000

    def put_text(self, text: str) -> None:
        out = self._files.create(self._here, True)
        out.write(bytearray(text.encode()))
        out.close()

    def text(self) -> str:
        stream = self._files.open(self._here)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def claim(self) -> bool:
        """Whether this call has made the file; of several callers one does."""
        try:
            return self._files.createNewFile(self._here)
        except Exception:  # a file system may refuse instead of answering
            return False


class _Log(NamedTuple):
    """A log whose rows have folders of their own."""

    spark: SparkSession
    layout: Layout

    def home(self) -> _Folder:
        return _Folder(self.spark, self.layout.location)

    def of_group(self, group: str) -> _Folder:
        """Names that sort and read like their groups, of bounded length."""
        plain = re.sub(r"[^A-Za-z0-9_-]", lambda m: "".join(f"~{b:02x}" for b in m[0].encode()), group)
        if len(plain) > 120:
            plain = f"{plain[:80]}~{sha256(group.encode()).hexdigest()}"
        return self.home() / f"group-{plain}"

    def groups(self) -> list[_Folder]:
        return [child for child in self.home().children() if child.name.startswith("group-")]

    def ungrouped(self) -> list[_Folder]:
        """Files and folders from before groups had folders."""
        return [child for child in self.home().children() if not child.name.startswith("group-")]

    def read(self, folders: list[_Folder]) -> DataFrame:
        spark, columns = self.spark, self.layout.columns
        if not folders:
            return spark.createDataFrame([], columns)
        reader = spark.read.format(self.layout.provider).schema(columns).option("recursiveFileLookup", "true")
        return reader.load([folder.path for folder in folders])

    def write(self, rows: DataFrame, folder: _Folder) -> None:
        rows.write.format(self.layout.provider).mode("append").save(folder.path)


def _opened(spark: SparkSession, site: Site) -> _Log | None:
    """The log, if its rows have folders of their own."""
    layout = layout_of(spark, site, site.admin, AUDIT_TABLE)
    options = {key.lower(): value.lower() for key, value in layout.options.items()} if layout else {}
    return _Log(spark, layout) if options.get("recursivefilelookup") == "true" else None


def _new_run() -> str:
    return f"run-{uuid.uuid4().hex}"


def record(
    spark: SparkSession,
    group: str,
    table: str,
    layer: str,
    status: str,
    rows: int,
    message: str,
    started: datetime,
    ended: datetime,
    site: Site = Site(),
) -> None:
    """Add one row. A failure to do so is logged and does not fail the load."""
    try:
        site = site.on(spark)
        values = (group, table, layer, status, rows, str(message)[:MESSAGE_LIMIT], started, ended)
        named = dict(zip(AUDIT.names, values))
        listed = (
            f"CAST(:{f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in AUDIT if f.name in named
        )
        row = spark.sql(f"SELECT {', '.join(listed)}, current_timestamp() AS LOAD_TS", args=named)
        opened = _opened(spark, site)
        if opened:
            opened.write(row, opened.of_group(group) / _new_run())
            spark.catalog.refreshTable(site.control(AUDIT_TABLE))
        else:
            row.write.insertInto(site.control(AUDIT_TABLE))
    except Exception:
        log.warning("audit write failed for %s", table, exc_info=True)


def _rows(spark: SparkSession, site: Site, group: str | None = None) -> DataFrame:
    """The log as it is now, with what other drivers have written; of one group, only its folder is
    read."""
    site = site.on(spark)
    name = site.control(AUDIT_TABLE)
    opened = _opened(spark, site) if group is not None else None
    if opened:
        own = opened.of_group(group)
        rows = opened.read([*([own] if own.children() else []), *opened.ungrouped()])
    else:
        spark.catalog.refreshTable(name)
        rows = spark.table(name)
    return rows if group is None else rows.where(F.col(GROUP) == F.lit(group))


def history(spark: SparkSession, group_id: str, site: Site = Site()) -> DataFrame:
    """Audit rows of a group, newest first."""
    return _rows(spark, site, group_key(group_id)).orderBy(F.desc("LOAD_TS"))


def summary(spark: SparkSession, group_id: str | None = None, site: Site = Site()) -> DataFrame:
    """Loads that succeeded and failed per layer, of one group or of all."""
    rows = _rows(spark, site, group_key(group_id) if group_id else None)
    ok, failed = F.count_if(F.expr("STATUS = 'SUCCESS'")), F.count_if(F.expr("STATUS = 'FAILED'"))
    return rows.groupBy("ETL_LAYER").agg(
        ok.alias("OK"), failed.alias("FAILED"), (failed == 0).alias("ALL_OK")
    )


@contextmanager
def _claimed(folder: _Folder) -> Iterator[None]:
    """Only one driver at a time removes rows from a folder; adding rows needs no claim."""
    claim = folder / CLAIM
    if not claim.claim():
        if not claim.exists() or claim.age() < CLAIM_SECONDS:
            raise AuditBusy(f"{folder.path} is being compacted or deleted from.")
        log.warning("taking over the claim on %s", folder.path)
        claim.put_text("")
    try:
        _settle(folder)
        yield
    finally:
        claim.remove()


def _settle(folder: _Folder) -> None:
    """Complete or undo what a lost driver has left of a replacement."""
    for run in folder.children():
        if run.has(STANDS_FOR):
            if run.has(FINISHED):
                _remove(folder, (run / STANDS_FOR).text().split("\n"))
                (run / STANDS_FOR).remove()
            else:
                run.remove()


def _remove(folder: _Folder, names: list[str]) -> None:
    for name in names:
        if name:
            (folder / name).remove()


def _replace(opened: _Log, folder: _Folder, runs: list[_Folder], rows: DataFrame) -> None:
    """Write rows that stand for those runs, then remove the runs by name.

    Between the two a reader sees rows twice; what a lost driver leaves so is mended by `_settle`.
    """
    new = folder / _new_run()
    (new / STANDS_FOR).put_text("\n".join(run.name for run in runs))
    opened.write(rows, new)
    if not new.has(FINISHED):
        (new / FINISHED).put_text("")
    _remove(folder, [run.name for run in runs])
    (new / STANDS_FOR).remove()


def delete(spark: SparkSession, group: str, site: Site = Site()) -> None:
    """Remove the rows of a group that are in the log now. The id is matched as stored."""
    site = site.on(spark)
    opened = _opened(spark, site)
    if opened is None:
        delete_where(spark, site, site.admin, AUDIT_TABLE, f"{GROUP} = :group", args={"group": group})
        return
    own = opened.of_group(group)
    if own.exists():
        with _claimed(own):
            for run in own.children():
                if run.has(FINISHED):
                    run.remove()
    home, old = opened.home(), opened.ungrouped()
    if old and not opened.read(old).where(F.col(GROUP) == F.lit(group)).isEmpty():
        with _claimed(home):
            old = opened.ungrouped()
            kept = opened.read(old).where(~F.col(GROUP).eqNullSafe(F.lit(group)))
            _replace(opened, home, old, kept)
    spark.catalog.refreshTable(site.control(AUDIT_TABLE))


def compact(spark: SparkSession, group_id: str | None = None, site: Site = Site(), least: int = 2) -> int:
    """Write the finished runs of a group, or of each, into one folder where there are at least
    ``least``; returns the number of folders that went. A group that is busy is left out."""
    site = site.on(spark)
    opened = _opened(spark, site)
    if opened is None:
        return 0
    gone = 0
    for folder in [opened.of_group(group_key(group_id))] if group_id else opened.groups():
        if len(folder.children()) < least:
            continue
        try:
            with _claimed(folder):
                runs = [run for run in folder.children() if run.has(FINISHED)]
                if len(runs) >= least:
                    rows = opened.read(runs)
                    # As many files as the rows fill, not as there were runs.
                    _replace(opened, folder, runs, rows.hint("rebalance"))
                    gone += len(runs)
        except AuditBusy:
            log.info("%s is busy", folder.path)
    spark.catalog.refreshTable(site.control(AUDIT_TABLE))
    return gone

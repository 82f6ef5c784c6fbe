"""Run parameters and the shared folder for intermediate results."""

import datetime
import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, SparkSession, functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"

_own_folder: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it.

    Only a local session without that setting gets a folder of its own; on a cluster a
    machine-local folder would be lost with its machine, so the setting is required there.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        _own_folder[app] = tempfile.mkdtemp(prefix="tierwell-")
    return _own_folder[app]


@dataclass(frozen=True)
class RunConfig:
    """One run of the jobs: where files land, where tables live, and what "today" is."""

    landing: str
    storage: str
    prefix: str = ""
    run_id: str = "manual"
    as_of: datetime.date | None = None
    known_missing_days: tuple = ()
    #: Releases of rebuilt tables whose files stay, the newest included; readers of older ones lose theirs.
    keep_releases: int = 3
    version: str = field(default_factory=lambda: uuid.uuid4().hex)

    def schema(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def table(self, layer: str, name: str) -> str:
        return f"{self.schema(layer)}.{name}"

    def path(self, layer: str, name: str) -> str:
        """Where this run writes its version of a table."""
        return f"{self.storage}/{self.schema(layer)}/{name}/{self.version}"

    @property
    def results_table(self) -> str:
        return self.table("ops", "quality_check_results")

    def today(self) -> Column:
        return F.current_date() if self.as_of is None else F.lit(self.as_of)

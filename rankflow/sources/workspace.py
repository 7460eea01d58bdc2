"""Where intermediate files go, a folder that driver and executors share and nowhere else, and who removes them.

Every folder belongs to a :class:`Workspace`: the innermost open one, or that of the session. An open workspace that ends
removes its folders but for those that the results handed to :meth:`Workspace.keep` still read; these pass to the
workspace around it. What the session's workspace holds goes with :func:`close_session_workspace` or at the end of the
driver's process.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset, a folder in the warehouse.

    Nothing here depends on the kind of master: both places are shared on a cluster.
    """
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    return named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_rankflow"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


class Workspace:
    """Folders and who reads them. Use as a context manager; lazy results that are still wanted go through ``keep``."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self.folders: dict[str, None] = {}
        self._kept: list[DataFrame] = []

    def __enter__(self) -> Workspace:
        _open.append(self)
        return self

    def __exit__(self, *_) -> None:
        _open.remove(self)
        read = set().union(*(folders_read(df, self.folders) for df in self._kept))
        outer = current_workspace(self._spark)
        for path in list(self.folders):
            if path in read:
                outer.folders[path] = None
                del self.folders[path]
        self._kept = []
        self.close()

    def keep(self, df: DataFrame) -> DataFrame:
        """``df`` itself. Folders that it reads outlive this workspace."""
        self._kept.append(df)
        return df

    def release(self, df: DataFrame) -> None:
        """Remove the folders of this workspace that ``df`` reads, as nothing needs it any more."""
        for path in folders_read(df, self.folders):
            remove_folder(self._spark, path)

    def close(self) -> None:
        """Remove all folders that are left."""
        for path in list(self.folders):
            remove_folder(self._spark, path)


_open: list[Workspace] = []
#: By the identity of the context, which a workspace keeps alive.
_sessions: dict[int, Workspace] = {}


def _session_workspace(spark: SparkSession) -> Workspace:
    context = id(spark.sparkContext)
    if context not in _sessions:
        _sessions[context] = Workspace(spark)
        atexit.register(_close_quietly, context)
    return _sessions[context]


def _close_quietly(context: int) -> None:
    owner = _sessions.pop(context, None)
    # a session that was stopped has lost its settings: its folders stay
    if owner is not None and getattr(owner._spark.sparkContext, "_jsc", None) is not None:
        owner.close()


def close_session_workspace(spark: SparkSession) -> None:
    """Remove all folders of the session that no open workspace owns. Results that read them can't be computed again."""
    _session_workspace(spark).close()


def current_workspace(spark: SparkSession) -> Workspace:
    """The innermost open workspace of this session, or the session's own."""
    own = [w for w in _open if w._spark.sparkContext is spark.sparkContext]
    return own[-1] if own else _session_workspace(spark)


def folders_read(df: DataFrame, folders) -> set[str]:
    """Those of ``folders`` that the plan of ``df`` reads, subqueries included. Nothing is computed."""
    plan = df._jdf.queryExecution().analyzed()
    plans, roots = [plan], []
    inner = plan.subqueriesAll()
    plans += [inner.apply(i) for i in range(inner.size())]
    for each in plans:
        leaves = each.collectLeaves()
        for i in range(leaves.size()):
            leaf = leaves.apply(i)
            if leaf.nodeName().startswith("LogicalRelation") or leaf.getClass().getSimpleName() == "LogicalRelation":
                relation = leaf.relation()
                if relation.getClass().getSimpleName() == "HadoopFsRelation":
                    paths = relation.location().rootPaths()
                    roots += [paths.apply(k).toString() for k in range(paths.size())]
    names = {folder: folder.rstrip("/").rsplit("/", 1)[-1] for folder in folders}
    return {folder for folder, name in names.items() if any(f"/{name}/" in root + "/" for root in roots)}


def tidy(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``query`` (its first argument is the session) in a workspace of its own, which keeps what the result reads."""

    @wraps(query)
    def run(spark: SparkSession, *args, **named) -> DataFrame:
        with Workspace(spark) as own:
            return own.keep(query(spark, *args, **named))

    return run


def new_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses, owned by the current workspace. Nothing is created."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    current_workspace(spark).folders[path] = None
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a new shared folder and read back.

    Several readers then see the same rows even when an executor is lost, and the plan
    starts anew from files.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder made by :func:`new_folder` once nothing reads it; false when there was none."""
    if not path.startswith(shared_folder(spark).rstrip("/") + "/"):
        raise ValueError(f"{path} is not inside the shared folder")
    for owner in [*_open, *_sessions.values()]:
        owner.folders.pop(path, None)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)

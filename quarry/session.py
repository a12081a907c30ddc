"""Session building, and the few things that every part of the engine asks of a session."""

from __future__ import annotations

import atexit
import importlib
import importlib.util
import os
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings that the engine relies on; a caller's own session may override any of them.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

#: Modules of optional backends.
BACKENDS = {"analyser": "kiwipiepy", "embedder": "sentence_transformers", "ruled": "fitz", "words": "pdfplumber", "flavours": "camelot", "yaml": "yaml"}

_shipped: dict[str, bool] = {}
_own_dir: list[str] = []


def build(master: str = "local[*]", app: str = "quarry", **conf: str) -> SparkSession:
    """A session with the engine's defaults; conf overrides them."""
    b = SparkSession.builder.master(master).appName(app)
    for k, v in {**DEFAULTS, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that Python workers can import it wherever they run."""
    app = spark.sparkContext.applicationId
    if _shipped.get(app):
        return
    root = Path(__file__).resolve().parent
    out = Path(tempfile.mkdtemp(prefix="quarry-ship-")) / "quarry_pkg.zip"
    with zipfile.ZipFile(out, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(Path(root.name) / p.relative_to(root)))
    spark.sparkContext.addPyFile(str(out))
    atexit.register(shutil.rmtree, out.parent, True)
    _shipped[app] = True
    # whole texts are long rows: Spark's default of 10,000 rows a batch would hold tens of megabytes on either side of each worker
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not spark._jsparkSession.sessionState().conf().contains(key):  # a number that the user has set stays
        spark.conf.set(key, "2000")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only where that setting is absent and all tasks run on this machine, as in tests."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="quarry-shared-"))
        atexit.register(shutil.rmtree, _own_dir[0], True)
    return "file://" + _own_dir[0]


def file_of(spark: SparkSession, path: str):
    """The file system and the path, on the JVM's side."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def cut(df: DataFrame, name: str = "t") -> DataFrame:
    """Write df as Parquet into the shared folder and read it again: lineage ends there, and lost executors cost nothing but their own tasks. The table goes when the driver ends, if drop_cut() hasn't taken it before."""
    path = f"{shared_dir(df.sparkSession)}/quarry-{name}-{os.getpid()}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    fs, p = file_of(df.sparkSession, path)
    fs.deleteOnExit(p)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._quarry_path = path
    return back


def drop_cut(df: DataFrame | None) -> None:
    """Delete a table made by cut() once nothing reads it any more."""
    path = getattr(df, "_quarry_path", None)
    if path:
        fs, p = file_of(df.sparkSession, path)
        fs.delete(p, True)


def small_side(table: DataFrame, most_rows: int = 4_000_000) -> DataFrame:
    """table, a written one of few narrow columns, marked for broadcast if it has at most so many rows; beyond that Spark's shuffled joins do the same work."""
    return F.broadcast(table) if table.count() <= most_rows else table


def capabilities(modules: dict[str, str] | None = None) -> dict[str, bool]:
    """Which optional backends this driver has, by name; nothing is imported."""
    return {name: importlib.util.find_spec(m) is not None for name, m in (modules or BACKENDS).items()}


def needs(name: str, fallback: Any = None, modules: dict[str, str] | None = None) -> Any:
    """The module of a backend, or the fallback where it isn't there; without a fallback that is an error that names it."""
    have = modules or BACKENDS
    if capabilities(have)[name]:
        return importlib.import_module(have[name])
    if fallback is None:
        raise RuntimeError(f"{name} needs the module {have[name]}")
    return fallback


def settings(arguments: dict[str, Any], environment: dict[str, str], defaults: dict[str, Any]) -> dict[str, Any]:
    """Each setting as given, else by the environment's variable of that name in capitals, in its default's type, else its default; a setting without any of the three is an error."""
    out = {}
    for k, d in defaults.items():
        v = arguments.get(k)
        if v is None and k.upper() in environment:
            raw = environment[k.upper()]
            v = raw.strip().lower() in ("1", "true", "yes") if isinstance(d, bool) else type(d)(raw) if d is not None and d is not ... else raw
        v = d if v is None else v
        if v is ...:
            raise ValueError(f"{k} is not set")
        out[k] = v
    return out

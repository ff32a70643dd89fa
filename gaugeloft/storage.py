"""File systems as Arrow sees them, and the package itself as a file for the executors."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyarrow import fs
from pyspark.sql import SparkSession

from gaugeloft.session import fresh_dir

_shipped: set[str] = set()


def filesystem_of(path: str) -> tuple[fs.FileSystem, str]:
    """Any file system Arrow knows, so that executors read and write shared storage directly.

    A path without a scheme is local; ``qualified`` gives it the one Spark means.
    """
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    scheme, colon, _ = path.partition(":/")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), path
    if "://" not in path:
        raise ValueError(f"no file system of Arrow's is known for {path}")
    if scheme in ("s3a", "s3n"):
        path = "s3" + path[len(scheme) :]
    return fs.FileSystem.from_uri(path)


def _package_zip() -> bytes:
    root = Path(__file__).resolve().parent
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as bundle:
        for file in sorted(root.rglob("*.py")):
            bundle.write(file, f"{root.name}/{file.relative_to(root)}")
    return buffer.getvalue()


def ship_package(spark: SparkSession) -> None:
    """Gives the Python workers this package, once per application, wherever they run."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    folder = fresh_dir(spark, "package")
    system, local = filesystem_of(folder)
    system.create_dir(local, recursive=True)
    with system.open_output_stream(f"{local}/gaugeloft.zip") as out:
        out.write(_package_zip())
    spark.sparkContext.addPyFile(f"{folder}/gaugeloft.zip")
    _shipped.add(application)

"""Raw-file fixtures derived from the driver tables: dated CSV snapshot
folders and zipped TSV bundles, written by Spark tasks into the shared folder
(``spark.checkpoint.dir``), so every file-source operator reads real files
whose volume grows with the tables."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv_snapshots(df: DataFrame, root: str, snap_col: str, header: bool = True, mode: str = "append") -> None:
    """One folder per snapshot (``<root>/<snap_col>=yyyy_MM_dd/part-*.csv``),
    all-text CSV with a header line; the date sits in the folder name."""
    (
        df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
        .write.mode(mode)
        .option("header", header)
        .partitionBy(snap_col)
        .csv(root)
    )


def write_zip_bundles(lines: DataFrame, root: str, header: str, bundle_name: str) -> DataFrame:
    """Zip bundles: one ``<root>/<folder>/<bundle_name>`` per ``folder``
    value; each ``member`` becomes a TSV member (``header`` + its ``line``
    values in ``seq`` order) next to a readme member and a directory entry.

    Written from the tasks of a grouped ``applyInPandas`` through Arrow's
    filesystem layer (local, HDFS or object stores). Returns
    ``(path, lines)`` per bundle.
    """

    def write(pdf):
        import pandas as pd
        from pyarrow import fs as pafs

        folder = pdf["folder"].iloc[0]
        target = f"{root.rstrip('/')}/{folder}/{bundle_name}"
        filesystem, path = pafs.FileSystem.from_uri(target if "://" in target else "file://" + target)
        filesystem.create_dir(path.rsplit("/", 1)[0], recursive=True)
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
            zf.writestr("docs/", "")
            zf.writestr("docs/readme.txt", "tab separated ballots received\n")
            for member, g in pdf.sort_values("seq").groupby("member", sort=True):
                zf.writestr(member, header + "\n" + "\n".join(g["line"]) + "\n")
        with filesystem.open_output_stream(path) as out:
            out.write(buf.getvalue())
        return pd.DataFrame({"path": [target], "lines": [len(pdf)]})

    return lines.groupBy("folder").applyInPandas(write, "path string, lines long")

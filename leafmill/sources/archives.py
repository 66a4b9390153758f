"""Archives of page images and texts, and of crops: .tar.gz files, one per volume."""

from __future__ import annotations

import io
import re
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions import text
from leafmill.sources.stores import store_of

SUFFIXES = (".jpg", ".tif", ".tiff", ".jp2")


def members(data: bytes) -> Iterator[tuple[str, bytes]]:
    with tarfile.open(fileobj=io.BytesIO(data), mode="r:*") as t:
        for m in t:
            if m.isfile():
                yield m.name.rsplit("/", 1)[-1], t.extractfile(m).read()


MEMBER = "path string, archive string, filename string, bytes binary"
#: Bytes of members that are handed on together; a larger one comes alone.
GROUP_BYTES = 16 << 20


def listed(spark: SparkSession, path: str) -> DataFrame:
    """path, length of the archives below a folder; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{tar.gz,tgz,tar}").load(path)
    return files.select("path", "length")


def _stem(path: str) -> str:
    return re.sub(r"\.(tar\.gz|tgz|tar)$", "", path.rsplit("/", 1)[-1])


def _grouped(rows: Iterator[tuple[str, str, bytes]]) -> Iterator[pd.DataFrame]:
    held, size = [], 0
    for path, name, data in rows:
        if held and size + len(data) > GROUP_BYTES:
            yield pd.DataFrame(held, columns=["path", "archive", "filename", "bytes"])
            held, size = [], 0
        held.append((path, _stem(path), name, data))
        size += len(data)
    if held:
        yield pd.DataFrame(held, columns=["path", "archive", "filename", "bytes"])


def _streamed(paths: Iterator[str]) -> Iterator[tuple[str, str, bytes]]:
    """Members one after the other, without holding an archive; of a broken one those before the break."""
    for path in paths:
        store, at = store_of(path)
        try:
            with store.open_input_stream(at, compression=None) as f, tarfile.open(fileobj=f, mode="r|*") as t:
                for m in t:
                    if m.isfile():
                        yield path, m.name.rsplit("/", 1)[-1], t.extractfile(m).read()
        except (tarfile.TarError, EOFError, zlib.error):
            continue


def members_of(spark: SparkSession, path: str) -> DataFrame:
    """path, archive, filename, bytes of every member.

    Compressed archives are read as streams, one a task, and a task holds members of GROUP_BYTES or a single one. Of plain
    archives an index of places is made first, and members are read by range, dealt over all tasks.
    """
    files = listed(spark, path)
    packed = files.where(~F.col("path").endswith(".tar"))

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _grouped(_streamed(p for pdf in batches for p in pdf.path))

    return packed.mapInPandas(stream, MEMBER).unionByName(ranged(indexed(spark, path)))


def indexed(spark: SparkSession, path: str) -> DataFrame:
    """path, filename, at, length of the members of plain archives: only their headers are read."""

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p in pdf.path:
                store, at = store_of(p)
                with store.open_input_file(at) as f, tarfile.open(fileobj=f, mode="r:") as t:
                    rows = [(p, m.name.rsplit("/", 1)[-1], m.offset_data, m.size) for m in t if m.isfile()]
                yield pd.DataFrame(rows, columns=["path", "filename", "at", "length"])

    return listed(spark, path).where(F.col("path").endswith(".tar")).mapInPandas(heads, "path string, filename string, at long, length long")


def ranged(index: DataFrame) -> DataFrame:
    """path, archive, filename, bytes of an index, by range reads; an archive's members go to as many tasks as there are."""
    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows():
            for pdf in batches:
                for p, own in pdf.sort_values(["path", "at"]).groupby("path"):
                    store, at = store_of(p)
                    with store.open_input_file(at) as f:
                        for name, offset, length in zip(own.filename, own["at"], own.length, strict=True):
                            f.seek(int(offset))
                            yield p, name, f.read(int(length))

        yield from _grouped(rows())

    return index.repartition(n, "path", "at").mapInPandas(read, MEMBER)


def scans(spark: SparkSession, items: DataFrame, path: str, fold_case: bool = False) -> DataFrame:
    """id_pipeline_batch_item, filename, bytes, text: images (bytes) and page texts (text). A volume without archive has no row."""
    f = members_of(spark, path)
    image, page = text.is_image(F.col("filename"), fold_case), F.col("filename").endswith(".txt")
    return f.where(image | page).join(items.select("id_pipeline_batch_item", F.col("barcode").alias("archive")), "archive").select(
        "id_pipeline_batch_item", "filename", F.when(image, F.col("bytes")).alias("bytes"), F.when(page, F.decode("bytes", "UTF-8")).alias("text"))


def crops(spark: SparkSession, path: str, detection: DataFrame | None = None) -> DataFrame:
    """id_detection, scan_base, png from members named <scan>_<id>.png, by the number at the end of the name.

    With detection the whole name decides: only members called as the crop of one of its elements is are taken.
    """
    f = members_of(spark, path).where(F.col("filename").rlike(r"_[0-9]+\.png$"))
    base = F.regexp_extract("filename", r"^(.*)_[0-9]+\.png$", 1)
    out = f.select(F.regexp_extract("filename", r"_([0-9]+)\.png$", 1).cast("long").alias("id_detection"), base.alias("scan_base"), F.col("bytes").alias("png"), "filename")
    if detection is not None:
        name = F.concat(text.strip_extension(F.col("scan_filename")), F.lit("_"), F.col("id_detection").cast("string"), F.lit(".png"))
        out = out.join(detection.select("id_detection", name.alias("filename")).distinct(), ["id_detection", "filename"], "left_semi")
    return out.select("id_detection", "scan_base", "png")


def pack_archive(names: list[str], data: list[bytes]) -> bytes:
    """A .tar.gz at the fastest level; same members, same bytes."""
    import gzip

    raw = io.BytesIO()
    with tarfile.open(fileobj=raw, mode="w", format=tarfile.USTAR_FORMAT) as t:
        for name, blob in sorted(zip(names, data, strict=True)):
            info = tarfile.TarInfo(name)
            info.size = len(blob)
            t.addfile(info, io.BytesIO(blob))
    return gzip.compress(raw.getvalue(), 1, mtime=0)


def crop_names(pdf: pd.DataFrame) -> list[str]:
    return [f"{f.rsplit('.', 1)[0]}_{i}.png" for f, i in zip(pdf.scan_filename, pdf.id_detection, strict=True)]


def crop_archives(crops_: DataFrame) -> DataFrame:
    """barcode, archive (binary) from barcode, scan_filename, id_detection, png. One volume is one file, so one row."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"barcode": [pdf.barcode.iloc[0]], "archive": [pack_archive(crop_names(pdf), list(pdf.png))]})

    return crops_.where("png is not null").groupBy("barcode").applyInPandas(run, "barcode string, archive binary")


def write_archives(crops_: DataFrame, out: str) -> None:
    """Write OUT/item/barcode.tar.gz for each item; crops_ has id_pipeline_batch_item, barcode, scan_filename, id_detection, png.

    An archive is written under a name of its own and then renamed, so a task that runs again replaces it as a whole.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        item, barcode = int(pdf.id_pipeline_batch_item.iloc[0]), pdf.barcode.iloc[0]
        store, base = store_of(out)
        folder = f"{base.rstrip('/')}/{item}"
        store.create_dir(folder, recursive=True)
        draft = f"{folder}/.{uuid.uuid4().hex}"
        data = pack_archive(crop_names(pdf), list(pdf.png))
        with store.open_output_stream(draft) as f:
            f.write(data)
        store.move(draft, f"{folder}/{barcode}.tar.gz")
        return pd.DataFrame({"id_pipeline_batch_item": [item], "n": [len(pdf)], "bytes": [len(data)]})

    told = crops_.where("png is not null").groupBy("id_pipeline_batch_item").applyInPandas(run, "id_pipeline_batch_item long, n long, bytes long")
    told.agg(F.sum("n"), F.sum("bytes")).collect()

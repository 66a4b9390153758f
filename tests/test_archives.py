"""Archives read as streams and by range."""

import io
import subprocess
import sys
import tarfile

import pytest

from leafmill.sources import archives


def tar(path, members, mode="w"):
    with tarfile.open(path, mode) as t:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))


def test_streams_and_ranges_give_the_same_members(spark, tmp_path):
    members = [(f"deep/p{i}.jpg", bytes([i]) * (i * 1000)) for i in range(12)] + [("p0.txt", "größe".encode()), ("empty.jpg", b"")]
    (tmp_path / "in" / "sub").mkdir(parents=True)
    tar(tmp_path / "in" / "a.tar.gz", members, "w:gz")
    tar(tmp_path / "in" / "sub" / "b.tar", members)
    (tmp_path / "in" / "broken.tar.gz").write_bytes((tmp_path / "in" / "a.tar.gz").read_bytes()[:120])
    (tmp_path / "in" / "other.zip").write_bytes(b"x")
    got = {}
    for r in archives.members_of(spark, str(tmp_path / "in")).collect():
        got.setdefault(r.archive, []).append((r.filename, bytes(r.bytes)))
    want = sorted((n.rsplit("/", 1)[-1], d) for n, d in members)
    assert sorted(got["a"]) == sorted(got["b"]) == want and "other" not in got
    index = archives.indexed(spark, str(tmp_path / "in"))
    assert {(r.filename, r.length) for r in index.collect()} == {(n, len(d)) for n, d in want}
    one = archives.ranged(index.where("filename = 'p7.jpg'")).collect()
    assert [(r.filename, bytes(r.bytes)) for r in one] == [("p7.jpg", bytes([7]) * 7000)]
    items = spark.createDataFrame([(7, "a"), (9, "none")], "id_pipeline_batch_item long, barcode string")
    s = archives.scans(spark, items, str(tmp_path / "in"))
    assert s.where("bytes is not null").count() == 13 and [r.text for r in s.where("text is not null").collect()] == ["größe"]


def test_crops_by_number_and_by_whole_name(spark, tmp_path):
    tar(tmp_path / "x.tar.gz", [("p1.a_5.png", b"5"), ("q_5.png", b"other"), ("p2_6.png", b"6"), ("p2_x.png", b"no"), ("p2_6.jpg", b"no")], "w:gz")
    assert sorted((r.id_detection, r.scan_base) for r in archives.crops(spark, str(tmp_path)).collect()) == [(5, "p1.a"), (5, "q"), (6, "p2")]
    d = spark.createDataFrame([(5, "p1.a.jpg"), (6, "p3.jpg")], "id_detection long, scan_filename string")
    assert [(r.id_detection, bytes(r.png)) for r in archives.crops(spark, str(tmp_path), d).collect()] == [(5, b"5")]


@pytest.mark.parametrize("mode, suffix", [("w:gz", "tar.gz"), ("w", "tar")])
def test_an_archive_larger_than_the_reader(tmp_path, mode, suffix):
    path = f"{tmp_path}/big.{suffix}"
    tar(path, [(f"p{i}.jpg", bytes(12 << 20)) for i in range(40)], mode)
    said = subprocess.run([sys.executable, "-c", f"""
import resource
from leafmill.sources.archives import _grouped, _streamed
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
n = sum(len(x) for pdf in _grouped(_streamed([{path!r}])) for x in pdf.bytes)
print(n, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""], capture_output=True, text=True, check=True).stdout.split()  # fmt: skip
    assert int(said[0]) == 40 * (12 << 20) and int(said[1]) < 200

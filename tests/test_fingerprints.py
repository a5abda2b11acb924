"""Fingerprints of files that are read in pieces."""

import hashlib
import random
from pathlib import Path

import pyarrow as pa
import pytest

from wattline.sources import tables as IO


def digests(files):
    return {n: "sha256:" + hashlib.sha256(b).hexdigest()[:16] for n, b in files.items()}


def test_a_file_larger_than_a_row_may_be(spark, folder):
    content = b"PAR1" + random.Random(1).randbytes(IO.WHOLE + 1_000_000)
    for n, part in (("large", content), ("small", content[:1000])):
        Path(f"{folder}/{n}.parquet").write_bytes(part)
    limit = "spark.sql.sources.binaryFile.maxLength"
    spark.conf.set(limit, IO.WHOLE)
    try:
        got = [tuple(r) for r in IO.fingerprints(spark, folder).collect()]
    finally:
        spark.conf.unset(limit)
    assert sorted(got) == sorted(digests({"large.parquet": content, "small.parquet": content[:1000]}).items())


@pytest.mark.parametrize("whole", [0, 30, 1 << 20])
def test_pieces_give_the_bytes_of_the_file(spark, folder, whole):
    rng = random.Random(2)
    files = {
        "random": b"PAR1" + rng.randbytes(300_000), "feeds": b"\n" * 25_000, "none": bytes(200_000), "open": b"PAR1\nabc", "closed": b"PAR1\r\nabc\n",
        "mark": IO.BOM, "mark_and_feed": IO.BOM + b"\n", "mark_and_text": IO.BOM + b"ab\r\ncd" * 90, "marks": (IO.BOM + b"\n") * 90, "one": b"x", "feed": b"\n",
    }
    files = {f"{n}.parquet": b for n, b in files.items()}
    if whole == 0:
        files.pop("mark.parquet")  # a mark alone is no line
    for n, b in (files | {"other.txt": b"x"}).items():
        Path(f"{folder}/{n}").write_bytes(b)
    block = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(block, 50_000)
    try:
        got = [tuple(r) for r in IO.fingerprints(spark, folder, whole=whole).collect()]
    finally:
        spark.conf.unset(block)
    assert sorted(got) == sorted(digests(files).items())


def test_a_part_of_a_file_is_an_error():
    batch = pa.RecordBatch.from_arrays([pa.array(["f"]), pa.array([9]), pa.array([b"PAR1\n"])], ["path", "size", "piece"])
    with pytest.raises(ValueError, match="5 bytes of a file of 9"):
        list(IO._digests(iter([batch])))

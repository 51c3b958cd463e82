"""What the first bytes of large files say, read when a scan is planned."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Bytes read of a file. Its line end is taken from them.
HEAD_BYTES = 1 << 16


def file_heads(spark: SparkSession, path: str) -> list[tuple[str, bytes | None]]:
    """Every file of a path, folder or pattern; the first bytes of those longer than one split.

    A file of one split is one task however it is read, so it is not opened here. What the driver
    reads is thus a small fraction of the bytes, whatever the number of files.
    """
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    split = jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")
    )
    found = []
    for top in fs.globStatus(place) or []:
        files = fs.listFiles(top.getPath(), True)
        while files.hasNext():
            status = files.next()
            if status.getPath().getName().startswith(("_", ".")):
                continue
            head = None
            if status.getLen() > split:
                stream = fs.open(status.getPath())
                try:
                    size = int(min(HEAD_BYTES, status.getLen()))
                    head = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, size))
                finally:
                    stream.close()
            found.append((status.getPath().toString(), head))
    return sorted(found)


def line_end(head: bytes) -> str:
    """The line end that most lines of a text have."""
    both = head.count(b"\r\n")
    counts = {"\r\n": both, "\n": head.count(b"\n") - both, "\r": head.count(b"\r") - both}
    return max(counts, key=counts.get) if any(counts.values()) else "\n"


def utf16_order(head: bytes) -> str | None:
    """'LE' or 'BE' by the mark at the start of a UTF-16 text, None without one."""
    return {b"\xff\xfe": "LE", b"\xfe\xff": "BE"}.get(head[:2])

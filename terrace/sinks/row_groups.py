"""The footer of a Parquet file that is made of whole other ones.

A Parquet footer gives each column chunk's place in the file, and bytes that no
footer names are skipped. Files with one schema, put one behind the other, are
therefore one file once a last footer names the row groups of all. Footers are
read and written by Spark's own Parquet library; no rows are touched.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from terrace import session as S

MAGIC = b"PAR1"


def encrypted(spark: SparkSession) -> bool:
    """The session writes encrypted Parquet, whose row groups are bound to their file."""
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return conf.get("parquet.crypto.factory.class") is not None


def write_footer(spark: SparkSession, target: str, parts: list[str]) -> None:
    """Write the footer of the file that ``parts``, in order, followed by this footer make up."""
    whole, begin = None, 0
    for part in parts:
        footer, length = _read(spark, part)
        for group in footer.getRow_groups():
            _shift(group, begin)
            if whole is not None:
                whole.addToRow_groups(group)
        if whole is None:
            whole = footer
        else:
            whole.setNum_rows(whole.getNum_rows() + footer.getNum_rows())
        begin += length
    fs, hpath = S._fs_and_path(spark, target)
    out = fs.create(hpath)
    try:
        spark.sparkContext._jvm.org.apache.parquet.format.Util.writeFileMetaData(whole, out)
        out.write(bytearray(int(out.getPos()).to_bytes(4, "little") + MAGIC))
    finally:
        out.close()


def _read(spark: SparkSession, path: str):
    """A file's footer and its length in bytes."""
    jvm = spark.sparkContext._jvm
    fs, hpath = S._fs_and_path(spark, path)
    length = fs.getFileStatus(hpath).getLen()
    stream = fs.open(hpath)
    try:
        stream.seek(length - 8)
        tail = bytes(stream.read() for _ in range(8))
        if tail[4:] != MAGIC:
            raise ValueError(f"{path} doesn't end as a plain Parquet file.")
        stream.seek(length - 8 - int.from_bytes(tail[:4], "little"))
        return jvm.org.apache.parquet.format.Util.readFileMetaData(jvm.java.io.BufferedInputStream(stream)), length
    finally:
        stream.close()


def _shift(group, by: int) -> None:
    """Move a row group's places by so many bytes. The page index, which has places inside it, is left out; readers do without."""
    if group.isSetFile_offset():
        group.setFile_offset(group.getFile_offset() + by)
    group.unsetOrdinal()  # its number in its own file, of use for encryption only
    for chunk in group.getColumns():
        if chunk.getFile_offset() > 0:
            chunk.setFile_offset(chunk.getFile_offset() + by)
        for unset in (chunk.unsetOffset_index_offset, chunk.unsetOffset_index_length, chunk.unsetColumn_index_offset, chunk.unsetColumn_index_length):
            unset()
        meta = chunk.getMeta_data()
        meta.setData_page_offset(meta.getData_page_offset() + by)
        if meta.isSetDictionary_page_offset() and meta.getDictionary_page_offset() > 0:
            meta.setDictionary_page_offset(meta.getDictionary_page_offset() + by)
        if meta.isSetBloom_filter_offset():
            meta.setBloom_filter_offset(meta.getBloom_filter_offset() + by)

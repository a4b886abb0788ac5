"""What the operators of this subpackage share: session settings, readers, lexical constants."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import configure

#: White space between words: the space and the five ASCII controls from tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = "[\\x20\\x09-\\x0D]"


def prepare(spark: SparkSession) -> SparkSession:
    """Library settings, and Arrow batches small enough for rows that hold whole documents."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def texts_of(docs: DataFrame, id_column: str, text_column: str, binary: bool = False) -> DataFrame:
    """Columns ``doc_id`` and ``text`` only, whatever else ``docs`` holds; a null text becomes an empty one."""
    text = F.coalesce(docs[text_column].cast("string"), F.lit(""))
    return docs.select(docs[id_column].alias("doc_id"), (text.cast("binary") if binary else text).alias("text"))


def smallest(rows: DataFrame, mark: str, order: list[str], n: int) -> DataFrame:
    """The ``n`` rows that come first by a 64-bit hash ``mark``, then by ``order``. What lies above the range of hashes that surely
    holds as many goes before the rows are sorted, so a task that takes the first rows of all others gets few of them."""
    cell = F.shiftright(mark, 50)  # 16,384 ranges
    sizes = rows.groupBy(cell.alias("cell")).count().orderBy("cell").collect()
    held, last = 0, None
    for row in sizes:
        held, last = held + row["count"], row["cell"]
        if held >= n:
            break
    return rows.where(cell <= F.lit(last)).orderBy(mark, *order).limit(n)


def word_array(text):
    """The words of a text column: maximal runs without white space, unchanged."""
    bare = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(bare) > 0, F.split(bare, f"{SPACE_CLASS}+")).otherwise(F.array().cast("array<string>"))


def rows_of(batch: pa.RecordBatch, *names: str) -> Iterator[list]:
    for name in names:
        yield batch.column(name).to_pylist()


class Recent:
    """What a worker has found out about texts, by text: two generations, so that at least the newest half stays known.

    ``limit`` bounds the characters of a generation.
    """

    def __init__(self, limit: int):
        self.limit, self.young, self.old, self.size = limit, {}, {}, 0

    def turn(self) -> None:
        """Begin a new generation once the present one is full. Between two calls nothing is forgotten."""
        if self.size > self.limit:
            self.old, self.young, self.size = self.young, {}, 0

    def missing(self, wanted: set) -> list:
        """Those of ``wanted`` that are not known; all others are in ``young`` afterwards."""
        unknown, young, before = [], self.young, self.old.get
        for key in wanted.difference(young):
            found = before(key)
            if found is None:
                unknown.append(key)
            else:
                young[key] = found
                self.size += len(key)
        return unknown

    def put(self, key, value, size: int) -> None:
        self.young[key] = value
        self.size += size


def slices(batches: Iterator[pa.RecordBatch], rows: int = 64) -> Iterator[pa.RecordBatch]:
    """Parts of batches, for work that holds several copies of the texts at hand."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def distinct_parts(parts: pa.ListArray) -> tuple[list, np.ndarray, np.ndarray]:
    """The different values of a column of lists, the number of each list entry's value, and where each list begins and ends."""
    coded = parts.flatten().dictionary_encode()
    offsets = parts.offsets.to_numpy()
    return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(), offsets - offsets[0]


def taken(packed: list[bytes], order: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """32-bit numbers of ``packed[i] for i in order`` end to end, and where the entries that begin at ``bounds`` begin in them."""
    flat = np.frombuffer(b"".join(packed), np.int32)
    sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
    starts = np.cumsum(sizes) - sizes
    own = sizes[order]
    ends = np.cumsum(own)
    moved = np.repeat(starts[order] - (ends - own), own)
    return flat[moved + np.arange(len(moved))], np.append(0, ends)[bounds]


def split_rows(batch: pa.RecordBatch, pattern: str) -> tuple[pa.RecordBatch, pa.RecordBatch]:
    """Rows whose ``text`` does not match the pattern, and those that do."""
    found = pc.match_substring_regex(batch.column("text"), pattern)
    return batch.filter(pc.invert(found)), batch.filter(found)

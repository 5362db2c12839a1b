"""What the operators of this subpackage share: reading, staging and word rules."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar
from functools import wraps
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java form of the word rule `[^\x20\x09-\x0D]+`; bytes.split() follows the same rule.
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where it is unset: in local mode a temporary folder,
    on a cluster one beside the warehouse's tables, provided that these aren't on the driver's own disk."""
    context = spark.sparkContext
    if named := context.getConf().get("spark.checkpoint.dir"):
        return named
    if not context.getCheckpointDir():
        if context.master.startswith("local"):
            context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        else:
            warehouse = spark.conf.get("spark.sql.warehouse.dir")
            if urlsplit(warehouse).scheme in ("", "file"):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            context.setCheckpointDir(f"{warehouse}/uiloom-staged")
    return context.getCheckpointDir()


class Scratch:
    """The staged tables of one call."""

    def __init__(self, spark: SparkSession) -> None:
        self.jvm, self.hadoop, self.paths = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration(), []

    def drop(self) -> None:
        """Delete the tables. For when all that reads them has been written."""
        for path in self.paths:
            at = self.jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self.hadoop).delete(at, True)
        self.paths = []


_open: ContextVar[tuple[Scratch, ...]] = ContextVar("open", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """Tables staged inside are deleted at the end; what is to outlive them is staged with `owner=outer()` or another scratch.
    Around a query and the writing of its result, nothing of the query is left."""
    own = Scratch(spark)
    token = _open.set((*_open.get(), own))
    try:
        yield own
    finally:
        _open.reset(token)
        own.drop()


def in_scratch(work: Callable) -> Callable:
    """For functions of a DataFrame: what they stage goes when they return, but for tables staged with `owner=outer()`."""

    @wraps(work)
    def inside(df: DataFrame, *args: object, **named: object) -> object:
        with scratch(df.sparkSession):
            return work(df, *args, **named)

    return inside


#: Owns what a lazily read result still needs when no scratch is open around the call; deleted when the process ends.
_process: list[Scratch] = []


def of_process(spark: SparkSession) -> Scratch:
    if not _process or _process[-1].jvm is not spark._jvm:
        _process.append(own := Scratch(spark))

        def at_end() -> None:
            with suppress(Py4JError, OSError):  # a JVM that has gone can't be asked any more
                own.drop()

        atexit.register(at_end)
    return _process[-1]


def outer() -> Scratch | None:
    """The scratch around the innermost one; None (the process) if there is none."""
    held = _open.get()
    return held[-2] if len(held) > 1 else None


def stage(df: DataFrame, label: str, **to: Scratch | None) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: its lineage ends there,
    and later jobs read it after the loss of an executor instead of computing it again.
    The table belongs to `owner`, or else to the innermost open scratch; where that is None or none is open, to the process."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/uiloom/{label}-{uuid.uuid4().hex}"
    held = _open.get()
    owner = (to["owner"] if "owner" in to else held[-1] if held else None) or of_process(spark)
    owner.paths.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; an id that is null counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def draw(*columns: Column | str) -> Column:
    """A number from 0 to 1 that a hash of the columns decides. With id and text, copies of one text
    are drawn each by itself, so a common text can neither fill a sample nor be missing from it."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / float(1 << 30)


#: Words of 64 bits in a block of marks, bits for each value, positions that a value sets, and most blocks (8 MB).
MARK_WORDS, MARK_BITS, MARKED, MOST_BLOCKS = 64, 16, 4, 1 << 14


def marks(wanted: DataFrame, on: str) -> tuple[DataFrame, Column, Column]:
    """A blocked Bloom filter of the values of a column (not null): its blocks, the block of a value, and whether that
    holds all positions of the value. Tasks fill it; its size is bounded, beyond that it only tells less."""
    blocks = max(1, min(MOST_BLOCKS, -(-wanted.count() * MARK_BITS // (64 * MARK_WORDS))))
    block, h = F.pmod(F.xxhash64(on), F.lit(blocks)), F.xxhash64(on, F.lit(1))
    places = [F.shiftrightunsigned(h, 12 * i).bitwiseAND(F.lit(64 * MARK_WORDS - 1)).cast("int") for i in range(MARKED)]
    set_in = wanted.select(block.alias("_block"), F.explode(F.array(*places)).alias("place"))
    word, bit = F.shiftright("place", 6), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place").bitwiseAND(F.lit(63)))
    filled = set_in.groupBy("_block", word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    own = filled.groupBy("_block").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("own"))  # MARK_WORDS entries at most
    table = own.select("_block", F.transform(F.sequence(F.lit(0), F.lit(MARK_WORDS - 1)), lambda i: F.coalesce(F.col("own")[i], F.lit(0).cast("long"))).alias("_marks"))
    held = F.lit(True)
    for place in places:
        held &= F.getbit(F.col("_marks")[F.shiftright(place, 6)], place.bitwiseAND(F.lit(63))) == 1
    return table, block, held


def likely(df: DataFrame, wanted: DataFrame, on: str, held: bool = True) -> DataFrame:
    """The rows of df whose value occurs in wanted, and few others; for held=False the rest. df isn't shuffled, so a join after it
    shuffles the rows that it needs, not the whole table."""
    table, block, marked = marks(wanted, on)
    met = df.withColumn("_block", block).join(F.broadcast(table), "_block", "left")
    return met.where(F.coalesce(marked, F.lit(False)) == held).select(*df.columns)


def without(df: DataFrame, gone: DataFrame, on: str) -> DataFrame:
    """The rows of df whose value (not null) doesn't occur in gone. Only rows that likely go are shuffled; df is read twice."""
    return likely(df, gone, on, held=False).unionByName(likely(df, gone, on).join(gone, on, "left_anti"))


def words(text: Column) -> Column:
    """The words of a text in order; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def whole_groups(batches: Iterator[pa.RecordBatch], rows: int = 20_000) -> Iterator[pa.Table]:
    """Rows sorted by their first column, as tables of some `rows` rows that hold whole groups of equal values."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        tab = pa.Table.from_batches(held)
        keys = tab.column(0)
        cut = pc.index(pc.equal(keys, keys[-1]), True).as_py()
        if cut:
            yield tab.slice(0, cut)
            rest = tab.slice(cut)
            held, count = rest.combine_chunks().to_batches(), rest.num_rows
    if held:
        yield pa.Table.from_batches(held)

"""File scans and sinks over Spark's own readers and writers."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwright.session import scratch_path, ship_package

# Folder name -> class (1 = unwanted mail), and the file that is not a mail.
CORPUS_LABELS = {
    "spam": 1,
    "hard_ham": 0,
    "spam_2": 1,
    "easy_ham": 0,
    "easy_ham 2": 0,
    "easy_ham_2": 0,
}
CORPUS_SKIP = "cmds"

# Files whose names the driver holds at a time, and of one reading task.
FILES_AT_ONCE = 50_000
TASK_FILES = 256
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    header: bool = True,
    null_token: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Delimited scan. A given schema avoids the extra pass that inference costs;
    ``null_token`` names the text that stands for a missing value. Without one, nothing
    between two delimiters is missing and a pair of quotes is an empty text. Files are
    split at line ends, so a large file is many tasks; where quoted values hold line ends,
    pass ``multi_line=True`` (each file is then read whole by one task)."""
    reader = (
        spark.read.option("header", header).option("escape", '"').option("multiLine", multi_line)
    )
    # Any token that no value equals tells missing from empty.
    reader = reader.option("nullValue", null_token or "\u0001")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def sink_csv(df: DataFrame, path: str, header: bool = True, null_token: str = "") -> None:
    """Delimited sink; empty texts are written as a pair of quotes, blanks at the edges of
    a text stay."""
    (
        df.write.option("header", header)
        .option("nullValue", null_token)
        .option("emptyValue", '""')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def sink_json_record(spark: SparkSession, path: str, record: Mapping[str, object]) -> None:
    """One JSON record about a run, e.g. data set name and seed."""
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in record.items()])
    row.coalesce(1).write.json(path)


def _hidden(name: str) -> bool:
    """Names that Spark's file scans leave out."""
    return (name.startswith("_") and "=" not in name) or name.startswith(".") or name.endswith("._COPYING_")


def _literal(path: str) -> str:
    """The path as a pattern that only it matches."""
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in path)


def _parts_of_tree(spark: SparkSession, root: str, limit: int) -> Iterator[tuple[list[str], int]]:
    """The files below ``root`` in parts of at most ``limit``: (paths, files), a path being a
    folder with all below it, or a file of a folder that has more files than that."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    top = hadoop.Path(root)
    fs = top.getFileSystem(conf)

    def below(path) -> Iterator[tuple[str, int]]:
        n = fs.getContentSummary(path).getFileCount()
        if n <= limit:
            if n:
                yield path.toString(), n
            return
        entries = fs.listStatusIterator(path)
        while entries.hasNext():
            entry = entries.next()
            if _hidden(entry.getPath().getName()):
                continue
            if entry.isDirectory():
                yield from below(entry.getPath())
            else:
                yield entry.getPath().toString(), 1

    paths, held = [], 0
    for start in fs.globStatus(top) or []:
        for path, n in below(start.getPath()):
            if paths and held + n > limit:
                yield paths, held
                paths, held = [], 0
            paths.append(_literal(path))
            held += n
    if paths:
        yield paths, held


def _read_files(spark: SparkSession, paths: list[str], n: int | None = None) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    files = files.select(F.col("path").alias("filename"), "content")
    # Spark counts 4 MB for opening a file; small ones would be a few to a task.
    return files if n is None else files.coalesce(max(4 * spark.sparkContext.defaultParallelism, -(-n // TASK_FILES)))


def scan_labelled_corpus(spark: SparkSession, root: str, with_filename: bool = True) -> DataFrame:
    """One row per file below ``root``; the class comes from the nearest known folder
    name. Files stay whole; folders outside the label table are ignored.

    A scan keeps the name of each of its files on the driver. Where there are more than
    ``FILES_AT_ONCE``, so many are scanned after another, each part's rows being written
    before the next is listed, and the rows are read from there."""
    parts = F.split("filename", "/")
    folder = F.try_element_at(parts, F.lit(-2))
    label = F.create_map(*[F.lit(x) for kv in CORPUS_LABELS.items() for x in kv])
    keep = ["label", "content"] + (["filename"] if with_filename else [])

    def labelled(files: DataFrame) -> DataFrame:
        out = (
            files.withColumn("folder", F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B"))))
            .withColumn("label", F.try_element_at(label, F.col("folder")))
            .where(F.col("label").isNotNull() & (F.element_at(parts, -1) != CORPUS_SKIP))
        )
        return out.select(*keep)

    some = _parts_of_tree(spark, root, FILES_AT_ONCE)
    first, second = next(some, None), next(some, None)
    if second is None:
        return labelled(_read_files(spark, [root], first and first[1]))
    path, schema = scratch_path(spark, "corpus-rows"), None
    before = spark.conf.get(LISTING)
    for paths, n in chain([first, second], some):
        # Many paths are listed by a job, of a task for each of them unless told otherwise.
        spark.conf.set(LISTING, str(4 * spark.sparkContext.defaultParallelism))
        try:
            rows = labelled(_read_files(spark, paths, n))
        finally:
            spark.conf.set(LISTING, before)
        schema = rows.schema
        rows.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _first_text_part(raw: bytes) -> str | None:
    import email

    try:
        # Text mode reads every line end as a line feed.
        text = raw.decode("iso-8859-1").replace("\r\n", "\n").replace("\r", "\n")
        message = email.message_from_string(text)
        for part in message.walk():
            if part.get_content_type() in ("text/plain", "text/html"):
                payload = part.get_payload()
                return payload if isinstance(payload, str) else None
    except Exception:
        return None
    return None


def mail_text_part(files: DataFrame, content: str = "content") -> DataFrame:
    """Replace the raw bytes by the first plain-text or HTML part, undecoded;
    unreadable messages give NULL. Arrow batches, a stdlib parser per message."""
    ship_package(files.sparkSession)
    rest = [f for f in files.schema.fields if f.name != content]
    schema = T.StructType([*rest, T.StructField("text", T.StringType())])

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            text = [_first_text_part(bytes(b)) for b in batch[content]]
            yield batch[[f.name for f in rest]].assign(text=text)

    return files.mapInPandas(parse, schema)


def scan_word_vectors(spark: SparkSession, path: str, dim: int) -> DataFrame:
    """Lines ``word f1 .. fD`` -> (word, vector); lines with another field count are dropped."""
    parts = F.split(F.trim("value"), r"\s+")
    return (
        spark.read.text(path)
        .select(parts.alias("p"))
        .where(F.size("p") == dim + 1)
        .select(
            F.element_at("p", 1).alias("word"),
            F.transform(F.slice("p", 2, dim), lambda x: x.try_cast("float")).alias("vector"),
        )
    )


def sink_word_vectors(df: DataFrame, word: str, vector: str, path: str) -> None:
    numbers = F.array_join(F.transform(vector, lambda x: x.cast("string")), " ")
    df.select(F.concat_ws(" ", F.col(word).cast("string"), numbers).alias("value")).write.text(path)

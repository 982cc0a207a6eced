"""Line dedup over levelled sorted runs of line hashes.

The index is a set of runs: tables of (key hash, smallest document that holds the line), bucketed
and sorted by hash, each hash in one run only. A batch of documents is merged against all runs
without moving them; hashes that no run holds become a new run on level 0. When a level has
``fan_out`` runs they are compacted into one run on the next level, so that a hash is rewritten
about log(batches) times.

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends, with A-Z lower-cased; its
hash has 128 bits. Keys of at least ``min_chars`` code points count.

Defined results: a null or empty text is one empty line. Rows of one id are one document; a null id
comes after all others and all such rows are one document. A document that loses all lines keeps an
empty text. Repeats within one document stay. Batches must come in the order of preference; the
query deals them by ranges of ids.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadbook.llm.shared import stored
from roadbook.llm.words import ids_and_texts, unused_name
from roadbook.session import scratch_dir

STRIPPED = b" \t\n\x0b\x0c\r"
MIN_CHARS = 10


def line_hash(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """Hash of a line's key, or None if the key is too short to count."""
    key = line.strip(STRIPPED).lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return blake2b(key, digest_size=16).digest()


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, key), once for each row and key, for docs with columns doc_id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                ids, keys = [], []
                rows = batch.slice(at, 500)
                for doc_id, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                    own = {line_hash(x, min_chars) for x in (text or "").encode().split(b"\n")}
                    own.discard(None)
                    ids += [doc_id] * len(own)
                    keys += own
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], ["doc_id", "key"]
                )

    return docs.mapInArrow(run, "doc_id long, key binary")


class LineRuns:
    """The levelled index. Runs are external tables in the shared folder and never change."""

    def __init__(self, spark: SparkSession, fan_out: int = 3, buckets: int | None = None):
        self.spark, self.fan_out = spark, fan_out
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.folder = scratch_dir(spark, "line-runs")
        self.levels: list[list[str]] = []

    def absorb(self, pairs: DataFrame) -> DataFrame:
        """Add a batch of (doc_id, key); returns the pairs whose line an earlier document holds.

        Keys are summed up before they move, so that a line of many documents is one row for each
        task. Whole batches of ids must not come before smaller ids.
        """
        found = pairs.groupBy("key").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("n"))
        owners = []
        for i, run in enumerate(r for level in self.levels for r in level):
            held = self.spark.table(run).select(
                F.col("key").alias("run_key"), F.col("doc_id").alias(f"owner_{i}"),
                F.lit(True).alias(f"held_{i}"),
            )
            found = found.join(held, F.col("key") == F.col("run_key"), "left").drop("run_key")
            owners.append(i)
        seen = F.coalesce(*[F.col(f"held_{i}") for i in owners], F.lit(False))
        owner = F.coalesce(*[F.col(f"owner_{i}") for i in owners], F.col("first_doc"))
        merged = stored(
            found.select("key", "n", seen.alias("seen"), owner.alias("owner")), "line-merge"
        )
        self._write(merged.where("not seen").select("key", F.col("owner").alias("doc_id")), 0)
        contested = merged.where((F.col("seen") | (F.col("n") > 1)) & F.col("owner").isNotNull())
        late = pairs.join(contested.select("key", "owner"), "key").where(
            F.col("doc_id").isNull() | (F.col("owner") < F.col("doc_id"))
        )
        return stored(late.select("doc_id", "key"), "line-drops")

    def _write(self, run: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            run.repartition(self.buckets, "key")
            .write.format("parquet")
            .bucketBy(self.buckets, "key")
            .sortBy("key")
            .option("path", f"{self.folder}/{name}")
            .saveAsTable(name)
        )
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fan_out:
            self._compact(level)

    def _compact(self, level: int) -> None:
        runs, self.levels[level] = self.levels[level], []
        merged = self.spark.table(runs[0])
        for run in runs[1:]:
            merged = merged.unionByName(self.spark.table(run))
        self._write(merged, level + 1)
        for run in runs:
            self.spark.sql(f"DROP TABLE {run}")  # the name only; what reads its files may go on

    def close(self) -> None:
        for level in self.levels:
            for run in level:
                self.spark.sql(f"DROP TABLE {run}")
        self.levels = []


def late_lines(docs: DataFrame, batches: int = 4, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, key) of the lines that a smaller id holds, for docs with columns doc_id and text."""
    spark = docs.sparkSession
    pairs = stored(line_hashes(docs, min_chars), "line-hashes")
    shares = [i / batches for i in range(1, batches)]
    cuts = pairs.agg(F.percentile_approx("doc_id", shares, 1000)).first()[0] if shares else []
    cuts = sorted(set(cuts or []))
    runs = LineRuns(spark)
    late = None
    for low, high in zip([None, *cuts], [*cuts, None]):
        in_batch = F.lit(True)
        if low is not None:
            in_batch &= F.coalesce(F.col("doc_id") > low, F.lit(True))
        if high is not None:
            in_batch &= F.coalesce(F.col("doc_id") <= high, F.lit(False))
        own = runs.absorb(pairs.where(in_batch))
        late = own if late is None else late.unionByName(own)
    runs.close()
    return late


def dedup_lines(
    docs: DataFrame,
    batches: int = 4,
    min_chars: int = MIN_CHARS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """All columns of docs, with the text less the dropped lines, and its counts of lines.

    n_lines and n_dropped come last; if docs has such columns, the new ones get an underscore.
    """
    late = late_lines(ids_and_texts(docs, id_col, text_col), batches, min_chars)
    # The lines of one document at most: bounded by the length of its text.
    dropped = late.groupBy("doc_id").agg(F.collect_set("key").alias("keys"))
    drop_id, keys = unused_name(docs, "drop_id"), unused_name(docs, "drop_keys")
    n_lines, n_dropped = unused_name(docs, "n_lines"), unused_name(docs, "n_dropped")
    dropped = dropped.select(F.col("doc_id").alias(drop_id), F.col("keys").alias(keys))
    joined = docs.join(
        dropped, F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(drop_id)), "left"
    ).drop(drop_id)
    text_at, keys_at = joined.columns.index(text_col), joined.columns.index(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = batch.slice(at, 500)
                texts, lines, drops = [], [], []
                for text, gone in zip(
                    rows.column(text_at).to_pylist(), rows.column(keys_at).to_pylist()
                ):
                    own = (text or "").encode().split(b"\n")
                    gone = set(gone or ())
                    kept = [x for x in own if line_hash(x, min_chars) not in gone] if gone else own
                    lines.append(len(own))
                    drops.append(len(own) - len(kept))
                    texts.append(text if len(kept) == len(own) else b"\n".join(kept).decode())
                columns = [c for i, c in enumerate(rows.columns) if i != keys_at]
                columns[text_at] = pa.array(texts, pa.string())
                columns += [pa.array(lines, pa.int64()), pa.array(drops, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [*out_names])

    out = joined.drop(keys).withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    out = out.withColumn(n_lines, F.lit(0).cast("long")).withColumn(n_dropped, F.lit(0).cast("long"))
    # The helper column must come last but for its name, so that positions stay those of docs.
    assert keys_at == len(joined.columns) - 1
    out_names = out.columns
    return joined.withColumn(text_col, F.col(f"`{text_col}`").cast("string")).mapInArrow(
        run, out.schema
    )


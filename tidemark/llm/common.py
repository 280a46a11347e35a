"""What several operators share: Arrow batches, written intermediates, labelled training rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path, unique_name

BATCH_ROWS = 400
BATCH_BYTES = 32 << 20
# The largest id: where a null id stands when ids are ordered.
LAST_ID = (1 << 63) - 1


def bound_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, since a batch of long texts is held whole by a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read again: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, name: str, by: str) -> DataFrame:
    """``stored`` in as many buckets of ``by`` as shuffles have partitions: grouping by it moves no row.

    The catalog knows the table only until it is read; the files stay.
    """
    spark, table = df.sparkSession, unique_name(name)
    most = (spark.conf.get(f"spark.sql.{c}") for c in ("shuffle.partitions", "sources.bucketing.maxBuckets"))
    df.write.format("parquet").bucketBy(min(map(int, most)), by).option("path", scratch_path(spark, name)).saveAsTable(table)
    rows = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return rows


def strings(array: pa.Array) -> list[str]:
    """The values of a string array, null as the empty text."""
    return [value or "" for value in array.to_pylist()]


def fold(id_column: str | Column, modulus: int) -> Column:
    """The remainder of the CRC32 of the id as text; a null id counts as empty text."""
    ident = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.crc32(F.coalesce(ident.cast("string"), F.lit("")).cast("binary")) % modulus


def training_sample(
    docs: DataFrame, labels: DataFrame, label: str, modulus: int, left_out: int, max_rows: int, max_bytes: int
) -> DataFrame:
    """Labelled documents to learn from: ``text`` and ``label`` (0 or 1) of at most ``max_rows`` rows.

    Rows whose fold is ``left_out`` are never taken. Rows are taken in the
    order of a hash of their id while their texts sum to at most ``max_bytes``;
    a text that does not fit is passed over whole, never cut. Rows without id,
    label or with contradictory labels are not used; of a repeated id one text
    is taken, the same in every run. The bounds apply to
    learning only; they keep what reaches the driver independent of the input.
    """
    named = labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("label"))
    usable = (
        named.where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & (fold("id", modulus) != left_out))
        .groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where(F.col("label") == F.col("other")).select("id", "label")
    )
    chosen = usable.orderBy(F.xxhash64("id"), "id").limit(max_rows)
    # max_rows pairs of an id and a label: a proven bound
    texts = docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    held = texts.join(F.broadcast(chosen), "id")
    mark = F.md5(F.col("text").cast("binary")).alias("mark")
    # of the rows of a repeated id the text of the smallest hash stands for all
    firsts = held.groupBy("id").agg(F.min(F.struct(mark, F.octet_length("text").alias("size"))).alias("first"))
    sizes = firsts.select("id", F.xxhash64("id").alias("place"), "first.mark", "first.size").collect()
    fitting, total = [], 0
    for row in sorted(sizes, key=lambda r: (r["place"], str(r["id"]))):
        if total + row["size"] <= max_bytes:
            fitting.append((row["id"], row["mark"]))
            total += row["size"]
    ident = docs.schema["doc_id"].dataType.simpleString()
    picked = docs.sparkSession.createDataFrame(fitting, f"id {ident}, mark string")
    found = held.withColumn("mark", mark).join(F.broadcast(picked), ["id", "mark"])
    return found.dropDuplicates(["id"]).select("id", "text", "label")


def lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The values of an integer list column as arrays, without Python objects for the numbers."""
    made = []
    for chunk in column.chunks:
        offsets, values = chunk.offsets.to_numpy(), chunk.values.to_numpy()
        made += [values[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    return made


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def fit_platt(margins: np.ndarray, positive: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset that turn margins into probabilities, by Newton steps on the smoothed log loss."""
    n_pos, n_neg = float(positive.sum()), float((~positive).sum())
    target = np.where(positive, (n_pos + 1) / (n_pos + 2), 1 / (n_neg + 2))
    scale = float(np.abs(margins).mean()) or 1.0
    x, slope, offset = margins / scale, 1.0, 0.0
    for _ in range(steps):
        p = sigmoid(slope * x + offset)
        error, weight = p - target, np.maximum(p * (1 - p), 1e-9)
        gradient = np.array([error @ x, error.sum()]) + 1e-3 * np.array([slope, offset])
        hessian = np.array([[weight @ (x * x), weight @ x], [weight @ x, weight.sum()]]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        slope, offset = slope - np.clip(step[0], -2, 2), offset - np.clip(step[1], -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(slope, 1e-6) / scale), float(offset)

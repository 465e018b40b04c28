"""Embeddings: centres, likeness, outliers, merging of clusters."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from strophe.operators.keyed import map_groups
from strophe.operators.neighbours import with_neighbours
from strophe.session import cut_lineage


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; null for a null or zero vector. (c + 1) / 2 maps it to 0 .. 1."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def mean_vectors(df: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """keys, center, n: the mean vector of each key. Sums are by position, with a map-side part; vectors of a key are never collected."""
    rows = df.filter(F.col(vector).isNotNull()).select(*keys, F.posexplode(vector).alias("pos", "x"))
    sums = rows.groupBy(*keys, "pos").agg(F.avg(F.col("x").cast("double")).alias("x"), F.count("*").alias("n"))
    return sums.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda p: p["x"]).alias("center"), F.max("n").alias("n"))


def center_likeness(centers: DataFrame, label: str, space: str | None = None) -> DataFrame:
    """label_a, label_b (label_a < label_b), likeness: pairs of centres of one space (all are one without a column for it); there are as many centres as clusters."""
    of = F.col(space) if space else F.lit(0)
    a = centers.select(of.alias("space"), F.col(label).alias("label_a"), F.col("center").alias("a"))
    b = centers.select(of.alias("space"), F.col(label).alias("label_b"), F.col("center").alias("b"))
    rows = a.join(b, ["space"]).filter("label_a < label_b")
    return rows.select(*[F.col("space").alias(space)] if space else [], "label_a", "label_b", cosine(F.col("a"), F.col("b")).alias("likeness"))


def dealt_likeness(df: DataFrame, index: str, vector: str, prompts: DataFrame, prompt: str) -> DataFrame:
    """prompt_no, likeness: each vector with the prompt (prompt_no from 0) of its index modulo the number of prompts."""
    total = prompts.agg((F.max("prompt_no") + 1).alias("__n"))
    rows = df.join(F.broadcast(total), F.lit(True)).withColumn("prompt_no", F.pmod(F.col(index), F.col("__n"))).drop("__n")
    return rows.join(prompts.select("prompt_no", F.col(prompt).alias("__p")), "prompt_no", "left").withColumn("likeness", cosine(F.col(vector), F.col("__p"))).drop("__p")


def neighbour_likeness(df: DataFrame, key: str, order: str, vector: str, block: int = 4096) -> DataFrame:
    """likeness to the vector before in the key's order (a number); rows of a key are worked on in blocks of their numbers."""
    beside = with_neighbours(df, key, [order], [order, vector], F.floor(F.col(order) / block))
    return beside.withColumn("likeness", cosine(F.col(vector), F.col(f"before.{vector}"))).drop("before", "after")


def assign_outliers(df: DataFrame, label: str, vector: str, near: float = 0.35, length: Column | None = None, brief: float = 1.0) -> DataFrame:
    """likeness to the own label's centre and outlier: not near it, unless the item is brief. The label and the mark stay apart."""
    centers = mean_vectors(df, [label], vector).select(label, "center")
    rows = df.join(centers, label).withColumn("likeness", cosine(F.col(vector), F.col("center"))).drop("center")
    far = ~(F.col("likeness") > near)
    return rows.withColumn("outlier", F.coalesce(far & (length >= brief) if length is not None else far, F.lit(True)))


def _unit_rows(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Positions and unit vectors by length; null and zero vectors and those with null elements have none."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    found = {}
    for size in np.unique(sizes[sizes > 0]):
        at = np.flatnonzero(sizes == size)
        flat = column.take(pa.array(at)).flatten()
        whole = pc.is_valid(flat).to_numpy(zero_copy_only=False).reshape(-1, size).all(axis=1)
        rows = pc.fill_null(flat.cast(pa.float64()), 0.0).to_numpy(zero_copy_only=False).reshape(-1, size)
        length = np.sqrt((rows * rows).sum(axis=1))
        whole &= length != 0
        found[int(size)] = (at[whole], rows[whole] / length[whole, None])
    return found


def _blocks(prompts: DataFrame, prompt: str, block: int) -> Iterator[pa.Array]:
    """The prompts as arrays of `block` vectors, read a partition at a time; those without a cosine (null elements) are left out."""
    known = prompts.select(prompt).filter(F.col(prompt).isNotNull() & ~F.exists(prompt, lambda x: x.isNull()))
    for held in batches_of((np.array(r[0], dtype=float) for r in known.toLocalIterator()), block):
        yield pa.array(held, pa.list_(pa.float64()))


def prompt_likeness(df: DataFrame, vector: str, prompts: DataFrame, prompt: str, block: int = 65_536) -> DataFrame:
    """prompt_score: each vector's best cosine with all prompt vectors. Without prompts it is null.

    Each block of prompts is a broadcast matrix and a pass over the vectors; the driver holds one block, and between passes the best scores are kept as a checkpoint.
    """
    schema = StructType([*df.schema.fields, StructField("prompt_score", DoubleType())])
    out = df.withColumn("prompt_score", F.lit(None).cast("double"))
    for i, held in enumerate(_blocks(prompts, prompt, block)):
        sent = df.sparkSession.sparkContext.broadcast({n: rows for n, (_, rows) in _unit_rows(held).items()})

        def run(batches: Iterator[pa.RecordBatch], sent: Broadcast = sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                best = pc.fill_null(batch["prompt_score"], -np.inf).to_numpy(zero_copy_only=False).copy()
                for size, (at, rows) in _unit_rows(batch[vector]).items():
                    stated = sent.value.get(size, np.empty((0, size)))
                    for r in range(0, len(at), 1024):
                        for p in range(0, len(stated), 4096):
                            like = (rows[r : r + 1024] @ stated[p : p + 4096].T).max(axis=1)
                            best[at[r : r + 1024]] = np.maximum(best[at[r : r + 1024]], like)
                score = pa.array(best, mask=best == -np.inf)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], score], names=batch.schema.names)

        out = (cut_lineage(out) if i else out).mapInArrow(run, schema)
    return out


def merge_plan(labels: list[int], sums: np.ndarray, counts: np.ndarray, near: float) -> dict[int, int]:
    """Which label each label ends as, when the first pair (in order) of centres with a cosine over `near` is joined again and again."""
    labels = list(labels)
    order = np.argsort(labels)
    labels, sums, counts = [labels[i] for i in order], sums[order].astype(float), counts[order].astype(float)
    end = {x: x for x in labels}
    while len(labels) > 1:
        centers = sums / counts[:, None]
        centers = centers / np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-12)
        like = np.triu(centers @ centers.T, 1)
        over = np.argwhere(like > near)
        if not len(over):
            break
        i, j = over[0]
        end = {k: labels[i] if v == labels[j] else v for k, v in end.items()}
        sums[i] += sums[j]
        counts[i] += counts[j]
        sums, counts = np.delete(sums, j, 0), np.delete(counts, j)
        del labels[j]
    return end


def merge_clusters(df: DataFrame, key: str, label: str, vector: str, near: float = 0.7) -> DataFrame:
    """key, label, merged_label: clusters of a key whose centres are alike become one. Only the clusters' sums meet, not their vectors."""
    centers = mean_vectors(df, [key, label], vector)
    kinds = dict(df.dtypes)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        counts = pdf["n"].to_numpy()
        end = merge_plan(pdf[label].tolist(), np.stack(pdf["center"].to_list()) * counts[:, None], counts, near)
        return pd.DataFrame({key: pdf[key], label: pdf[label], "merged_label": pdf[label].map(end)})

    return centers.groupBy(key).applyInPandas(run, f"{key} {kinds[key]}, {label} {kinds[label]}, merged_label {kinds[label]}")


def offset_labels(df: DataFrame, key: str, chunk: str, label: str) -> DataFrame:
    """df with chunk_label: labels numbered within each chunk (by value from 0), after those of the key's earlier chunks, so that no two chunks share one. One row a label meets the window over the key."""
    own = df.filter(F.col(label).isNotNull()).select(key, chunk, label).distinct()
    inside = F.dense_rank().over(Window.partitionBy(key, chunk).orderBy(label)) - 1
    sizes = own.groupBy(key, chunk).agg(F.count("*").alias("__n"))
    ahead = sizes.withColumn("__ahead", F.sum("__n").over(Window.partitionBy(key).orderBy(chunk)) - F.col("__n")).drop("__n")
    numbers = own.withColumn("__i", inside).join(ahead, [key, chunk]).select(key, chunk, label, (F.col("__i") + F.col("__ahead")).alias("chunk_label"))
    return df.join(numbers, [key, chunk, label], "left")


def cluster_in_chunks(chunked: DataFrame, key: str, vector: str, cluster: Callable[[np.ndarray], np.ndarray], near: float = 0.7) -> DataFrame:
    """chunked (key, chunk_no, vec_id, vector) with label: each chunk is clustered by itself, labels are made distinct over the chunks, and clusters whose centres are alike are joined, first within a chunk, then over all.

    cluster gives a number for each row of a matrix; a chunk (of bounded size, as greedy_chunks makes them) is one matrix. Only the clusters' sums meet over chunks.
    """
    kinds = dict(chunked.dtypes)

    def run(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        out = np.zeros(table.num_rows, dtype=np.int64)
        for i, j in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows], strict=True):
            rows = np.array(table[vector].slice(i, j - i).to_pylist(), dtype=float)
            found = np.asarray(cluster(rows), dtype=np.int64)
            names = np.unique(found)
            sums = np.stack([rows[found == n].sum(axis=0) for n in names])
            end = merge_plan(names.tolist(), sums, np.array([(found == n).sum() for n in names]), near)
            out[i:j] = [end[int(n)] for n in found]
        yield from table.append_column("__label", pa.array(out)).combine_chunks().to_batches()

    schema = ", ".join(f"`{c}` {k}" for c, k in kinds.items()) + ", __label long"
    rows = map_groups(chunked.filter(F.col(vector).isNotNull()), [key, "chunk_no"], ["vec_id"], run, schema)
    rows = cut_lineage(offset_labels(rows, key, "chunk_no", "__label").drop("__label"))
    merged = merge_clusters(rows, key, "chunk_label", vector, near)
    return rows.join(merged, [key, "chunk_label"]).withColumnRenamed("merged_label", "label").drop("chunk_label")


def nearest_first(near: float = 0.35) -> Callable[[np.ndarray], np.ndarray]:
    """A clustering that needs no other library: each vector joins the first cluster whose running centre has a cosine of at least `near` with it, or opens one."""

    def cluster(rows: np.ndarray) -> np.ndarray:
        units = rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
        sums = np.zeros((0, rows.shape[1] if rows.ndim > 1 else 0))
        out = []
        for v in units:
            like = sums @ v / np.maximum(np.linalg.norm(sums, axis=1), 1e-12) if len(sums) else np.zeros(0)
            hit = np.flatnonzero(like >= near)
            if len(hit):
                out.append(int(hit[0]))
                sums[hit[0]] += v
            else:
                out.append(len(sums))
                sums = np.vstack([sums, v])
        return np.array(out, dtype=np.int64)

    return cluster


def similarity_table(centers: DataFrame, label: str, digits: int = 3) -> DataFrame:
    """label_a, label_b, likeness of all pairs of centres, rounded half to even."""
    return center_likeness(centers, label).withColumn("likeness", F.bround("likeness", digits))


def choose_method(first_labels: Column, second_labels: Column, many: int = 5) -> Column:
    """The first method if it finds fewer clusters where either finds many, more clusters otherwise."""
    a, b = first_labels, second_labels
    return F.when(F.greatest(a, b) >= many, F.when(a <= b, "first").otherwise("second")).otherwise(F.when(a >= b, "first").otherwise("second"))


def sub_windows(df: DataFrame, samples: Column, rate: int = 16_000, length: float = 1.5, step: float = 0.75) -> DataFrame:
    """window_no, from_sample, to_sample: windows over each row's samples; the last one may reach past the end (its rest is filled from the start). A row without samples has none."""
    size, hop = int(length * rate), int(step * rate)
    last = F.greatest(F.lit(0), F.ceil((samples - size) / hop)).cast("long")
    return df.withColumn("window_no", F.explode(F.when(samples > 0, F.sequence(F.lit(0).cast("long"), last)))).withColumn("from_sample", F.col("window_no") * hop).withColumn("to_sample", F.col("window_no") * hop + size)


def batches_of(rows: Iterator, n: int) -> Iterator[list]:
    held: list = []
    for row in rows:
        held.append(row)
        if len(held) == n:
            yield held
            held = []
    if held:
        yield held

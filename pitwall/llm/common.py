"""Helpers shared by the training-data operators.

``save`` cuts lineage with a written table in the cluster's shared folder;
``numbered`` gives rows, or distinct keys, dense numbers without a window over
a group.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: bytes.translate table: A-Z to a-z, all other bytes unchanged.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
UPPER_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder of ``spark.checkpoint.dir``.

    On a cluster the setting must name a shared folder; only a local session
    may leave it unset, and then gets a temporary one."""
    from pitwall.session import checkpoint_dir

    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def save(df: DataFrame, name: str, to: DataFrame | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (lineage is cut, and
    a lost executor costs no recomputation). The table stays for the session, unless
    it is dropped. With ``to``, a saved table of the same columns, the rows are added to
    it; only the table returned here reads them all."""
    path = to._scratch if to is not None else scratch(df.sparkSession, name)
    df.write.mode("append" if to is not None else "error").option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def drop(*saved: DataFrame) -> None:
    """Deletes tables that ``save`` returned, once all that reads them is saved."""
    for df in saved:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df._scratch)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from pitwall.sources.tables import read_table

    return read_table(spark, sf_dir, name)


def texts(batches: Iterator, run_chars: int = 4_000_000) -> Iterator[tuple[list, list]]:
    """(first column, texts) of Arrow batches of (id, text), cut into runs of at
    most about ``run_chars`` characters so that a task's memory follows one run (or
    one text that alone is longer). A null text is given as ''."""
    for rb in batches:
        ids, out, run, size = rb.column(0).to_pylist(), [], [], 0
        for k, t in zip(ids, rb.column(1)):
            t = t.as_py() or ""
            if run and size + len(t) > run_chars:
                yield out, run
                out, run, size = [], [], 0
            out.append(k)
            run.append(t)
            size += len(t)
        if run:
            yield out, run


def rows_of(batches: Iterator, run_chars: int = 4_000_000) -> Iterator[tuple[list, list, list]]:
    """(row ids, ids, texts) of runs of Arrow batches of (_rid, id, text)."""
    import pyarrow as pa

    def paired():
        for rb in batches:
            both = pa.StructArray.from_arrays([rb.column(0), rb.column(1)], names=["_rid", "id"])
            yield pa.RecordBatch.from_arrays([both, rb.column(2)], names=["both", "text"])

    for both, run in texts(paired(), run_chars):
        yield [b["_rid"] for b in both], [b["id"] for b in both], run


def row_id(name: str = "_rid"):
    """The place of a row in its input split. Another scan of the same table may
    be split otherwise, so it holds within one scan: see ``stored_rows``."""
    place = F.monotonically_increasing_id()
    return (F.shiftleft(F.shiftright(place, 33), 40) + place.bitwiseAND((1 << 33) - 1)).alias(name)


def stored_rows(docs: DataFrame, *columns) -> DataFrame:
    """``_rid`` and ``columns`` of ``docs``, numbered by one scan and saved: all
    later passes read the stored numbers."""
    return save(docs.select(row_id(), *columns), "rows")


def _numberer(n_keys: int, weight: bool):
    """mapInArrow body over sorted partitions. Columns: the keys, then (if
    ``weight``) a long weight, then the carried columns. Adds the partition id
    and the running number (distinct keys so far, or the weight before the row)
    and ends each partition with one summary row: keys only there."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        pid, first, last, count, schema = TaskContext.get().partitionId(), None, None, 0, None
        for rb in batches:
            m = rb.num_rows
            if not m:
                continue
            schema = rb.schema
            if weight:
                w = rb.column(n_keys).to_numpy(zero_copy_only=False).astype(np.int64)
                number = count + np.cumsum(w) - w
                count += int(w.sum())
            else:
                new = np.zeros(m, dtype=bool)
                for c in range(n_keys):
                    a, b = rb.column(c).slice(1), rb.column(c).slice(0, m - 1)
                    eq = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
                    new[1:] |= ~eq.to_numpy(zero_copy_only=False)
                head = [rb.column(c)[0].as_py() for c in range(n_keys)]
                new[0] = last is None or head != last
                number = count + np.cumsum(new) - 1
                count = int(number[-1]) + 1
                first = head if first is None else first
                last = [rb.column(c)[m - 1].as_py() for c in range(n_keys)]
            carried = list(rb.columns[n_keys + weight :])
            none = [pa.nulls(m, t) for t in schema.types[:n_keys]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(m, pid, np.int32)), pa.array(number), *none, *none, *carried],
                names=_names(schema.names, n_keys, weight),
            )
        if schema is not None:
            keys = [pa.array([v], t) for v, t in zip(first or [None] * n_keys, schema.types)]
            ends = [pa.array([v], t) for v, t in zip(last or [None] * n_keys, schema.types)]
            carried = [pa.nulls(1, t) for t in schema.types[n_keys + weight :]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1 - pid], pa.int32()), pa.array([count], pa.int64()), *keys, *ends, *carried],
                names=_names(schema.names, n_keys, weight),
            )

    return run


def _names(columns: list[str], n_keys: int, weight: bool) -> list[str]:
    first = [f"_f{i}" for i in range(n_keys)]
    return ["_pid", "_n", *first, *[f"_l{i}" for i in range(n_keys)], *columns[n_keys + weight :]]


def numbered(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    carry: list[str],
    name: str,
    weight: str | None = None,
    hashed: bool = False,
) -> DataFrame:
    """``carry`` columns plus ``name`` (long, from 0) for each row of ``df``.

    Without ``weight``: the dense rank of the row's ``keys`` over all rows.
    With ``weight``: the sum of ``weight`` over the rows before it in (keys,
    order). Rows are range-partitioned on (keys, order), so a hot key covers a
    run of partitions; one Arrow pass numbers each sorted partition, and one
    summary row per partition (bounded by the partition count) carries the
    numbers on. ``order`` should make the order total where it matters.

    ``hashed`` (without weight) ranks by a 128-bit hash of the keys, then the keys, so
    that the range bounds sampled to the driver are small whatever the keys' size.
    Different keys never get one number; one key could get two only if another with
    the same 128 bits met it where a partition ends."""
    spark = df.sparkSession
    n = len(keys)
    cols = [*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]]
    cols += [F.col(weight).cast("bigint").alias("_w")] if weight else []
    extra = [F.col(o).alias(f"_o{i}") for i, o in enumerate(order)]
    flat = df.select(*cols, *extra, *[F.col(c) for c in carry])
    by_key, by_order = [f"_k{i}" for i in range(n)], [f"_o{i}" for i in range(len(order))]
    spread = [f"_h{i}" for i in range(2 * hashed)]
    flat = flat.select("*", *[F.xxhash64(*by_key, F.lit(i)).alias(h) for i, h in enumerate(spread)])
    ranged = flat.repartitionByRange(shuffle_partitions(spark), *(spread or by_key), *by_order)
    ranged = ranged.sortWithinPartitions(*spread, *by_key, *by_order).drop(*spread, *by_order)
    kinds = [f.dataType for f in ranged.schema.fields]
    names = _names(ranged.columns, n, bool(weight))
    types = [T.IntegerType(), T.LongType(), *kinds[:n], *kinds[:n], *kinds[n + bool(weight) :]]
    schema = T.StructType([T.StructField(a, t) for a, t in zip(names, types)])
    out = save(ranged.mapInArrow(_numberer(n, bool(weight)), schema), name)  # stays: the result reads it
    by_pid = Window.orderBy("_pid")  # one row per partition
    summary = out.where("_pid < 0").withColumn("_pid", -1 - F.col("_pid"))
    total = F.sum("_n").over(by_pid) - F.col("_n")
    if not weight:
        joined = F.lit(True)
        for i in range(n):
            joined = joined & F.lag(f"_l{i}").over(by_pid).eqNullSafe(F.col(f"_f{i}"))
        joined = joined & (F.row_number().over(by_pid) > 1)
        summary = summary.withColumn("_j", joined.cast("bigint"))
        total = total - F.sum("_j").over(by_pid)
    offsets = summary.select(F.col("_pid"), total.alias("_off"))
    rows = out.where("_pid >= 0").join(F.broadcast(offsets), "_pid")
    return rows.select(*carry, (F.col("_n") + F.col("_off")).alias(name))

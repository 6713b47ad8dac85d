"""Text sinks in the reference's row formats, on any Hadoop filesystem."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planekit.session import cut_lineage

_COPY_BYTES = 1 << 20


def row_text(df: DataFrame) -> DataFrame:
    """One ``value`` per row: the fields, comma-separated; a null field is empty.

    An array's elements stand inline (``id,m1,m2``); an empty or null array
    adds no field.
    """
    cols = []
    for name, dtype in df.dtypes:
        if dtype.startswith("array"):
            # concat_ws skips a null array, and an empty one adds nothing
            cols.append(F.transform(name, lambda v: F.coalesce(v.cast("string"), F.lit(""))))
        else:
            cols.append(F.coalesce(F.col(name).cast("string"), F.lit("")))
    return df.select(F.concat_ws(",", *cols).alias("value"))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False) -> None:
    """Headerless comma-separated text, one ``row_text`` per row.

    ``mode='overwrite'`` replaces the target directory (the reference deletes
    it first); ``'errorifexists'`` fails if present.  ``single_file`` leaves one
    output file, and is off by default: tasks write their parts side by side, and
    the filesystem joins them in the order of the rows (``join_files``).
    """
    out = row_text(df)
    if not single_file:
        out.write.mode(mode).text(path)
        return
    _write_joined(out.sparkSession, path, mode, lambda parts: out.write.text(parts), lambda fs, files: [files])


def _write_joined(spark: SparkSession, path: str, mode: str, write, group) -> None:
    """Let ``write`` fill a folder beside ``path``, then join its files as ``group`` says, as ``path``."""
    if mode not in ("overwrite", "errorifexists"):
        raise ValueError("mode must be 'overwrite' or 'errorifexists'")
    Path = spark._jvm.org.apache.hadoop.fs.Path
    target = Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if mode == "errorifexists" and fs.exists(target):
        raise FileExistsError(path)
    beside = Path(target.getParent() or Path("."), f".{target.getName()}-{uuid.uuid4().hex}")
    parts, done = Path(beside, "parts"), Path(beside, "done")
    try:
        write(parts.toString())
        files = sorted((s.getPath() for s in fs.listStatus(parts) if s.getLen() > 0 and s.getPath().getName().startswith("part-")),
                       key=lambda p: p.getName())
        fs.mkdirs(done)
        for k, some in enumerate(group(fs, files)):
            join_files(spark, fs, some, Path(done, f"part-{k:05d}.txt"))
        fs.create(Path(done, "_SUCCESS")).close()
        if fs.exists(target):
            fs.delete(target, True)
        if not fs.rename(done, target):
            raise OSError(f"cannot move the output to {path}")
    finally:
        fs.delete(beside, True)


def join_files(spark: SparkSession, fs, files: list, target) -> None:
    """One file of ``files``, in order: moved if it is one, joined by the filesystem where it can (HDFS joins
    blocks without reading them), else copied through a buffer of ``_COPY_BYTES``."""
    if not files:
        fs.create(target).close()
        return
    if not fs.rename(files[0], target):
        raise OSError(f"cannot move {files[0]}")
    rest = files[1:]
    if not rest:
        return
    gateway = spark.sparkContext._gateway
    array = gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(rest))
    for k, p in enumerate(rest):
        array[k] = p
    try:
        fs.concat(target, array)
        return
    except Exception as e:
        if "UnsupportedOperation" not in str(e):
            raise
    whole = target.suffix(".joining")
    out = fs.create(whole)
    try:
        for p in [target, *rest]:
            source = fs.open(p)
            try:
                spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, _COPY_BYTES, False)
            finally:
                source.close()
    finally:
        out.close()
    fs.delete(target, False)
    fs.rename(whole, target)


def match_chunks(pairs: DataFrame, probes: DataFrame | None = None, probe_id: str = "id",
                 parts: int | None = None) -> DataFrame:
    """Match lists in pieces: ``part, k, probe_id, window_ids, starts, ends``, in the order of ``part, k``.

    A list may be longer than a row should be.  Distinct pairs are range partitioned
    and sorted by probe and window, so a long list spans tasks; every task cuts its
    rows into pieces of at most an Arrow batch.  ``starts`` and ``ends`` mark a list's
    first and last piece.  The table is written once.  ``probes`` adds those without a
    match, with an empty list.  Null window ids are left out.  ``parts``: how many
    tasks (None: the session's shuffle partitions, which AQE may merge).
    """
    rows = pairs.select("probe_id", "window_id")
    if probes is not None:
        none = F.lit(None).cast(pairs.schema["window_id"].dataType)
        rows = rows.unionByName(probes.select(F.col(probe_id).alias("probe_id"), none.alias("window_id")))
    else:
        rows = rows.where(F.col("window_id").isNotNull())
    order = ["probe_id", "window_id"]
    by = order if parts is None else [parts, *order]
    ordered = rows.dropDuplicates().repartitionByRange(*by).sortWithinPartitions(*order)
    types = dict(rows.dtypes)

    def pieces(batches):
        from pyspark import TaskContext

        part, k, held, last = TaskContext.get().partitionId(), 0, None, None
        names = ["part", "k", "probe_id", "window_ids", "starts", "ends"]

        def flush(ends_here: bool):
            probe, ids, starts = held
            ends = starts[1:] + [ends_here]
            n = len(starts)
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * n, pa.int32()), pa.array(range(k, k + n), pa.int64()), probe, ids,
                 pa.array(starts, pa.bool_()), pa.array(ends, pa.bool_())], names=names)

        for b in batches:
            if not b.num_rows:
                continue
            values = b.column(0).to_pylist()
            at = [0] + [i for i in range(1, len(values)) if values[i] != values[i - 1]]
            fresh = held is None or values[0] != last
            if held is not None:
                yield flush(fresh)
                k += len(held[2])
            ids = pa.ListArray.from_arrays(pa.array(at + [len(values)], pa.int32()), b.column(1))
            held, last = (b.column(0).take(pa.array(at)), ids, [fresh] + [True] * (len(at) - 1)), values[-1]
        if held is not None:
            yield flush(True)

    schema = f"part int, k long, probe_id {types['probe_id']}, window_ids array<{types['window_id']}>, starts boolean, ends boolean"
    table = cut_lineage(ordered.mapInArrow(pieces, schema))
    # a list that goes on in the next task: one row per task tells
    seams = table.groupBy("part").agg(F.min_by("probe_id", "k").alias("first"), F.max_by("probe_id", "k").alias("last"),
                                      F.max("k").alias("k")).orderBy("part").collect()
    follows = [(a["part"], a["k"], b["part"]) for a, b in zip(seams, seams[1:]) if a["last"] == b["first"]]
    if follows:
        at = F.struct(F.col("part"), F.col("k"))
        ends = [F.struct(F.lit(p).alias("part"), F.lit(k).alias("k")) for p, k, _ in follows]
        starts = [F.struct(F.lit(p).alias("part"), F.lit(0).cast("long").alias("k")) for _, _, p in follows]
        table = table.withColumn("ends", F.col("ends") & ~at.isin(ends)).withColumn("starts", F.col("starts") & ~at.isin(starts))
    return table.withColumn("window_ids", F.array_compact("window_ids"))


def match_lines(pairs: DataFrame, probes: DataFrame | None = None, probe_id: str = "id") -> DataFrame:
    """One ``value`` ``id,m1,m2,…`` per probe, with sorted distinct matches.

    A list is put together from the texts of its pieces, not from its ids: a row
    takes the memory of its own text, and no task holds a set of ids.
    """
    text = F.array_join(F.transform("window_ids", lambda v: F.concat(F.lit(","), v.cast("string"))), "")
    pieces = match_chunks(pairs, probes, probe_id).select("probe_id", F.struct("part", "k", text.alias("text")).alias("piece"))
    lists = pieces.groupBy("probe_id").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    whole = F.array_join(F.transform("pieces", lambda p: p["text"]), "")
    return lists.select("probe_id", F.concat(F.coalesce(F.col("probe_id").cast("string"), F.lit("")), whole).alias("value"))


def write_matches(pairs: DataFrame, path: str, mode: str = "errorifexists", probes: DataFrame | None = None,
                  probe_id: str = "id") -> None:
    """The rows of ``match_lines`` as text, by probe id."""
    match_lines(pairs, probes, probe_id).orderBy("probe_id").select("value").write.mode(mode).text(path)


def pairs_as_points(pairs: DataFrame) -> DataFrame:
    """Two rows per pair (``pair_no``, ``end``, ``x``, ``y``): the reference's two-line form."""
    k = pairs.withColumn("pair_no", F.monotonically_increasing_id())
    return k.select(
        "pair_no",
        F.explode(F.array(
            F.struct(F.lit(0).alias("end"), F.col("ax").alias("x"), F.col("ay").alias("y")),
            F.struct(F.lit(1).alias("end"), F.col("bx").alias("x"), F.col("by").alias("y")),
        )).alias("p"),
    ).select("pair_no", "p.end", "p.x", "p.y")

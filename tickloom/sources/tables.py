"""Reading, writing and loading family tables: partition layout, manifests, verification, idempotent loads."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.scalars import digest, ns_date, ns_hour
from tickloom.operators.digests import multiset_digest
from tickloom.operators.joins import active_at, small
from tickloom.operators.normalize import Registry, accounting
from tickloom.operators.sets import set_difference

PARTITION = ("family", "source_id", "date", "hour")
STABLE_ORDER = ("instrument_uid", "received_time_ns", "epoch_id", "arrival_ordinal", "native_trade_id")

RAW_SCHEMA = T.StructType(
    [
        T.StructField("source_id", T.StringType()),
        T.StructField("channel_id", T.StringType()),
        T.StructField("epoch_kind", T.StringType()),
        T.StructField("epoch_id", T.StringType()),
        T.StructField("arrival_ordinal", T.LongType()),
        T.StructField("received_time_ns", T.LongType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("payload_sha256", T.StringType()),
    ]
)


def raw_faults() -> Column:
    """Why a raw row can't be trusted; null for a good row."""
    return (
        F.when(F.sha2("payload", 256) != F.col("payload_sha256"), "payload_hash")
        .when(F.col("epoch_id").isNull() | ~F.coalesce(F.col("epoch_kind").isin("connection", "poll_cycle"), F.lit(False)), "epoch")
        .when(F.coalesce(F.col("arrival_ordinal"), F.lit(0)) < 1, "ordinal")
    )


def read_raw(spark: SparkSession, *paths: str) -> DataFrame:
    """Raw messages whose payload hash, epoch and ordinal hold."""
    return spark.read.schema(RAW_SCHEMA).parquet(*paths).where(raw_faults().isNull())


def read_family(spark: SparkSession, path: str) -> DataFrame:
    """Family files, also foreign ones: nanosecond times as long, unsigned ids as decimal(20,0), hashes as binary."""
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    return spark.read.parquet(path)


def partitioned(df: DataFrame, family: str, time: str = "received_time_ns") -> DataFrame:
    return df.withColumns({"family": F.lit(family), "date": ns_date(F.col(time)).cast("string"), "hour": ns_hour(F.col(time))})


def write_partitions(df: DataFrame, family: str, path: str, order: Sequence[str] = STABLE_ORDER, row_group: int = 64 << 20, rows_per_file: int = 5_000_000, bloom: str | None = None) -> None:
    """family/source/date/hour folders, rows in stable order inside each file, zstd.

    An hour of more than ``rows_per_file`` rows is dealt to as many files as it needs, by instrument and minute, so that
    a busy hour, and a busy instrument in it, is no single task. Hours are counted first, over their columns alone.
    """
    rows, by = partitioned(df, family), list(PARTITION)
    sizes = rows.groupBy(*by).agg(F.count("*").alias("__n")).where(F.col("__n") > rows_per_file)
    busy = sizes.select(*by, F.ceil(F.col("__n") / rows_per_file).alias("__files"))
    rows = rows.withColumn("__files", F.lit(1)) if busy.isEmpty() else rows.join(small(busy), by, "left").withColumn("__files", F.coalesce("__files", F.lit(1)))
    minute = F.call_function("div", F.col("received_time_ns"), F.lit(60_000_000_000))
    rows = rows.withColumn("__f", F.pmod(F.xxhash64("instrument_uid", minute), F.col("__files")))
    # a number of its own, as merging small tasks would have one task open thousands of files
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(tasks, *by, "__f")
    kept = [c for c in order if c in df.columns]
    rows = rows.sortWithinPartitions(*by, *kept).drop("__f", "__files").select(*df.columns, *(c for c in by if c not in df.columns))
    writer = rows.write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", row_group).option("partitionOverwriteMode", "dynamic")
    if bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{bloom}", "true")
    writer.partitionBy(*PARTITION).parquet(path)


def manifests(df: DataFrame, family: str, key: str = "native_trade_id") -> DataFrame:
    """One row per partition: rows, bounds, epochs, digest and a build id that depends on them."""
    rows = partitioned(df, family)
    by = list(PARTITION)
    counts = rows.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.min("received_time_ns").alias("first_ns"),
        F.max("received_time_ns").alias("last_ns"),
        F.count_distinct("epoch_id").alias("epochs"),
    )
    digests = multiset_digest(rows.select(*by, *df.columns if "source_id" not in df.columns else [c for c in df.columns if c != "source_id"]), by)
    return counts.join(digests.drop("n"), by).withColumn("build_id", digest(*(F.col(c) for c in (*by, "rows", "digest"))))


def verify_manifests(df: DataFrame, family: str, expected: DataFrame) -> DataFrame:
    """(partition..., fault): partitions whose contents and manifest disagree."""
    by = list(PARTITION)
    names = ("rows", "first_ns", "last_ns", "epochs", "digest")
    found = manifests(df, family).select(*by, F.struct(*names).alias("f"))
    both = expected.select(*by, F.struct(*names).alias("e")).join(found, by, "full_outer")
    fault = F.when(F.col("f").isNull(), "absent").when(F.col("e").isNull(), "unlisted")
    for n in names:
        fault = fault.when(~F.col(f"f.{n}").eqNullSafe(F.col(f"e.{n}")), n)
    return both.select(*by, fault.alias("fault")).where("fault IS NOT NULL")


def committed_only(df: DataFrame, manifest_table: DataFrame) -> DataFrame:
    """Rows of partitions whose manifest is committed."""
    return df.join(manifest_table.where("state = 'committed'").select(*PARTITION), list(PARTITION), "left_semi")


def read_committed(spark: SparkSession, path: str, manifest_table: DataFrame) -> DataFrame:
    """Rows of the committed partitions below ``path``; only their files are read.

    The committed partitions go to the scan at run time (dynamic partition pruning) where they are few enough to be
    broadcast; beyond that the same join is a shuffle and prunes rows only.
    """
    committed = small(manifest_table.where("state = 'committed'").select(*PARTITION).distinct())
    return read_family(spark, path).join(committed, list(PARTITION), "left_semi")


def export(raw: DataFrame, bindings: DataFrame, registry: Registry, family: str, path: str) -> dict[str, DataFrame]:
    """Raw records to a committed family: bindings, mapping, accounting, partitions, manifests, verification.

    ``raw`` has record_id, source_id, channel_id, received_time_ns and payload; each record gets the mapper that its
    channel is bound to at its receive time, and those without one are refused. Gives ``rows`` (as read back),
    ``quarantine``, ``accounting`` (records neither mapped nor refused, or both) and ``manifests``, whose state is
    committed where accounting has no fault and the files hold what was mapped. The same input gives the same
    manifests, whatever its order and partitions.
    """
    spark = raw.sparkSession

    def held(made: DataFrame, *parts: str) -> DataFrame:
        """What is read several times is computed once, in the folder that all share."""
        folder = shared_folder(spark)
        made.write.partitionBy(*parts).parquet(folder)
        return spark.read.schema(made.schema).parquet(folder).select(*made.columns)

    # each mapper reads its own folders only
    bound = held(active_at(raw, bindings, ["channel_id"], "received_time_ns", "valid_from_ns", "valid_to_ns"), "source_id", "channel_id", "mapper_version")
    rows, refused = map(held, registry.run(bound))
    faults = accounting(raw, rows, refused, ["record_id"])
    write_partitions(rows, family, path)
    written = read_family(spark, path).where(F.col("family") == family)
    expected = manifests(rows, family, "record_id")
    unequal = verify_manifests(written.select(*rows.columns), family, expected).select(*PARTITION, "fault")
    sound = faults.isEmpty()
    state = F.when(F.lit(sound) & F.col("fault").isNull(), "committed").otherwise("refused")
    listed = expected.join(unequal, list(PARTITION), "left").withColumn("state", state).drop("fault")
    return {"rows": written, "quarantine": refused, "accounting": faults, "manifests": listed}


def row_id(event: Column, ordinal: Column) -> Column:
    return digest(event, ordinal)


def flatten(df: DataFrame, family: str, decimals: Sequence[str], all_decimals: Sequence[str]) -> DataFrame:
    """One wide warehouse row: id, family, times and every nullable decimal of any family."""
    wide = [F.col(c) if c in decimals else F.lit(None).cast("decimal(38,18)").alias(c) for c in all_decimals]
    month = F.substring(ns_date(F.col("received_time_ns")).cast("string"), 1, 7)
    return df.select(
        row_id(F.col("native_trade_id"), F.lit(0)).alias("row_id"), F.lit(family).alias("family"), "source_id", "channel_id", "instrument_uid", "received_time_ns", month.alias("month"), *wide
    )


def generation_path(root: str, generation: str) -> str:
    return f"{root}/load_generation_id={generation}"


def load_generation(rows: DataFrame, expected_ids: DataFrame, root: str, generation: str, key: str = "native_trade_id") -> str:
    """Load rows once under a generation id: loaded, already_loaded or refused.

    Rows are written to a staging folder beside the generations, which readers pass over, and take the place of their own
    generation by a rename when the staged ids are exactly the expected ones. A generation that is there and exact is
    never written again; one that is not is replaced; refused rows leave everything as it was.
    """
    spark = rows.sparkSession
    found = reconcile_generation(spark, expected_ids, root, generation, key)
    if found == "exact":
        return "already_loaded"
    path = spark._jvm.org.apache.hadoop.fs.Path
    staged, final = path(f"{root}/_staged/{uuid.uuid4().hex}"), path(generation_path(root, generation))
    rows.write.parquet(staged.toString())
    files = staged.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not set_difference(expected_ids.select(key), spark.read.parquet(staged.toString()).select(key)).isEmpty():
        files.delete(staged, True)
        return "refused"
    # what was there stays beside until the new rows have taken its place
    old = path(f"{root}/_staged/{uuid.uuid4().hex}")
    replaced = files.exists(final) and files.rename(final, old)
    if not files.rename(staged, final):
        if replaced:
            files.rename(old, final)
        raise RuntimeError(f"generation {generation} could not be published")
    files.delete(old, True)
    return "loaded"


def reconcile_generation(spark: SparkSession, expected_ids: DataFrame, root: str, generation: str, key: str) -> str:
    """What an interrupted write came to: exact, different or absent. Nothing is written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{generation_path(root, generation)}/_SUCCESS")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return "absent"
    there = spark.read.parquet(generation_path(root, generation)).select(key)
    return "exact" if set_difference(expected_ids.select(key), there).isEmpty() else "different"


def rebuild_partition(rows: DataFrame, family: str, path: str) -> DataFrame:
    """Replace the partitions of ``rows``; give before and after evidence per partition."""
    from tickloom.operators.aggs import evidence

    spark, by = rows.sparkSession, list(PARTITION)
    before = evidence(read_family(spark, path), by, "received_time_ns", ["price", "amount"]).select(*by, F.struct("n", "sum_price").alias("b"))
    held = shared_folder(spark)  # the next line replaces the files that it is computed from
    before.write.parquet(held)
    before = spark.read.schema(before.schema).parquet(held)
    write_partitions(rows, family, path)
    after = evidence(read_family(spark, path), by, "received_time_ns", ["price", "amount"]).select(*by, F.struct("n", "sum_price").alias("a"))
    return before.join(after, by, "full_outer").select(*by, F.col("a").eqNullSafe(F.col("b")).alias("same"))


def archive(ledger: DataFrame, utc_date: str) -> tuple[DataFrame, DataFrame]:
    """(terminal rows of one date, their commit record)."""
    rows = ledger.where((F.col("utc_date") == utc_date) & F.col("outcome").isNotNull())
    return rows, multiset_digest(rows, ["utc_date"])


def shared_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share, below the checkpoint folder that the session names.

    Without one a folder of this machine will do in local mode only; on a cluster that is an error.
    """
    import tempfile

    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    named = named or tempfile.mkdtemp(prefix="spark-")
    return f"{named}/tables-{uuid.uuid4().hex}"

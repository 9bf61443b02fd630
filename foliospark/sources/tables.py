"""Reading of the Parquet tables and layout helpers shared by all queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of ``directory``."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def spread(df: DataFrame, at_least: int | None = None) -> DataFrame:
    """``df`` in at least as many partitions as there are cores, for stages that are bound by CPU.

    A table with enough splits is returned as it is, so nothing is shuffled at scale; only a
    small table in one file is dealt out anew. For plans without a shuffle: asking a plan with one for its partitions
    would run it.
    """
    want = at_least or df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= want else df.repartition(want)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineages: the cluster's own setting. Only a session on one machine may leave it unset, as tests
    do, and gets a folder of that machine."""
    sc = spark.sparkContext
    set_by_cluster = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    have = sc._jsc.sc().getCheckpointDir()
    if have.isDefined():
        return have.get()
    if set_by_cluster:
        sc.setCheckpointDir(set_by_cluster)
    elif not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    else:
        import tempfile

        sc.setCheckpointDir(tempfile.mkdtemp(prefix="foliospark-checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint; survives the loss of any executor."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager)


def cut_clean(df: DataFrame) -> DataFrame:
    """``cut``, and the files of the shuffles that led to ``df`` are removed at once, not when the driver collects its garbage. ``df`` can't be
    used afterwards without running it again."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return cut(df.select("*"))  # a plan of its own, made under this setting
    finally:
        conf.set(key, before) if before is not None else conf.unset(key)


def join_hot(left: DataFrame, right: DataFrame, keys: str | list[str], by: str, how: str = "inner", hot: int = 10_000, most: int = 1000, salts: int = 16) -> DataFrame:
    """Joins ``left`` to ``right``, which has a row per key, where a key may hold a large part of the rows of ``left``.

    The ``most`` most frequent keys of over ``hot`` rows are found by counting the first key column (combined before it is
    shuffled); any other key holds less than one row in ``most``. Their rows are dealt out by a hash of the column
    ``by``, and only their rows of ``right`` are copied. Null keys match nothing.
    """
    keys = [keys] if isinstance(keys, str) else keys
    counts = left.groupBy(keys[0]).agg(F.count("*").alias("n")).where((F.col("n") > hot) & F.col(keys[0]).isNotNull())
    values = [r[0] for r in counts.orderBy(F.desc("n")).limit(most).collect()]
    if not values:
        return left.join(right, keys, how)
    is_hot = F.coalesce(F.col(keys[0]).isin(values), F.lit(False))
    dealt = left.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(by), F.lit(salts))).otherwise(F.lit(0)).cast("int"))
    copied = right.withColumn("_salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return dealt.join(copied, [*keys, "_salt"], how).drop("_salt")


def once_per(df: DataFrame, *keys: str) -> DataFrame:
    """One row per key. A row delivered twice has the same id and the same content."""
    return df.dropDuplicates(list(keys))


def message(role: str, messages: str = "messages") -> "F.Column":
    """Content of the first message with this role; null without one."""
    return F.try_element_at(F.filter(F.col(messages), lambda m: m["role"] == role), F.lit(1))["content"]

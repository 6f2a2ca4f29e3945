"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

import re
import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import checkpoint_dir, staging_path

#: Bytes of one Arrow batch handed to Python, so that long texts cannot fill a worker.
ARROW_BATCH_BYTES = 4 << 20


def ship_by_value(module_name: str) -> None:
    """Send a module's functions to the workers inside the job, so executors
    need only Python and its libraries, not this repository."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker, over all its tasks
    (the module itself arrives anew with every task)."""
    import types
    name = "_quarry_llm_worker_cache"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
    return sys.modules[name].__dict__.setdefault("kept", {})


def bound_arrow_batches(spark: SparkSession) -> None:
    """Limit Arrow batches by bytes where the session has set no limit itself."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < size_in_bytes(spark.conf.get(key)) <= ARROW_BATCH_BYTES:
        spark.conf.set(key, str(ARROW_BATCH_BYTES))


def size_in_bytes(text: str) -> int:
    """Bytes of a size as Spark's settings write it (``8m``, ``1gb``, ``-1``)."""
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([bkmgtp]?)(?:i?b)?\s*", text.lower()).groups()
    return int(number) << 10 * "bkmgtp".index(unit or "b")


def saved(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: one evaluation, lineage cut."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """As ``saved`` through Parquet: smaller, and later reads take only the columns they need."""
    path = staging_path(df.sparkSession, "llm")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def text_col(df: DataFrame, name: str = "text") -> Column:
    """The text with null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def append_columns(df: DataFrame, text: str, fields: list[tuple[str, str]], kernel) -> DataFrame:
    """All columns of ``df`` plus ``fields`` that ``kernel(text array) -> list of
    arrays`` computes per Arrow batch; columns of those names are replaced."""
    bound_arrow_batches(df.sparkSession)
    names = [f[0] for f in fields]
    kept = df.drop(*[n for n in names if n in df.columns])
    schema = T.StructType(list(kept.schema.fields) + [T.StructField(n, T._parse_datatype_string(t)) for n, t in fields])

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            made = kernel(batch.column(batch.schema.get_field_index(text)))
            yield pa.RecordBatch.from_arrays(list(batch.columns) + [pa.array(x) for x in made],
                                             names=list(batch.schema.names) + names)
    return kept.mapInArrow(run, schema)


def running_sum(df: DataFrame, groups: list[str], order: list[str], value: str, out: str,
                slice_col: str) -> DataFrame:
    """Inclusive running sum of ``value`` within ``groups`` in the order of
    (``slice_col``, ``order``). A group is cut into its slices, each summed by
    a task of its own, so no group lands in one task; the offsets come from one
    row per (group, slice)."""
    sums = df.groupBy(*groups, slice_col).agg(F.sum(value).alias("__sum"))
    ahead = Window.partitionBy(*groups).orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("__before", F.coalesce(F.sum("__sum").over(ahead), F.lit(0))).drop("__sum")
    within = (Window.partitionBy(*groups, slice_col).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = df.withColumn(out, F.sum(value).over(within))
    same = None
    left, right = local.alias("l"), offsets.alias("r")
    for c in [*groups, slice_col]:
        cond = F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
        same = cond if same is None else same & cond
    cols = [F.col(f"l.{c}") for c in local.columns if c != out]
    return left.join(right, same).select(*cols, (F.col(f"l.{out}") + F.col("r.__before")).alias(out))


ship_by_value(__name__)

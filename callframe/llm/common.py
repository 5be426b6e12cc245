"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from callframe.session import scratch_path
from callframe.sources.tables import read_table


def read_docs(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """One input table through Spark's own reader."""
    return read_table(spark, sf_dir, name)


def text_of(col: str = "text") -> Column:
    """The text column; null counts as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def bucket_of(id_col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (the fold rule of
    the learning operators). A null id is folded as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def whole_rows(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(_row, _text): each row as one struct beside its text, so that a filter
    can carry all columns, whatever their names, through a text function."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       text_of(text_col).alias("_text"))


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """Cut the lineage: write ``df`` to a fresh folder below the shared
    checkpoint folder and read it back. Every executor can read it again
    after another one is lost. ``options`` are the Parquet writer's."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: texts of one Arrow batch: whole texts can be long, and a batch is held several times
BATCH_ROWS = 1000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Let the session's Arrow batches hold at most ``BATCH_ROWS`` rows (a smaller
    setting stays). Results do not depend on it."""
    if not 0 < int(spark.conf.get(_BATCH_CONF, "10000")) <= BATCH_ROWS:
        spark.conf.set(_BATCH_CONF, str(BATCH_ROWS))


#: what the tasks of one stage leave to each other in a Python worker, by stage
_LEFT: dict = {}


def left_in_stage(key, make):
    """``make()``, or what an earlier task of this stage made in the same Python
    worker; the next stage's tasks do not find it any more."""
    from pyspark import TaskContext
    context = TaskContext.get()
    stage = context.stageId() if context else None
    for old in [k for k in _LEFT if k[0] != stage]:
        del _LEFT[old]
    if (stage, key) not in _LEFT:
        _LEFT[stage, key] = make()
    return _LEFT[stage, key]


def give_back() -> None:
    """A worker outlives its tasks, and all workers of an executor share its
    memory: what a task freed goes back to the machine."""
    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_texts(rows: DataFrame, task, columns: list[tuple[str, str]],
              carry: list[str] = ()) -> DataFrame:
    """Run a text function over Arrow batches.

    ``rows`` has the id first, then the carried columns, then the text. In each
    task ``task()`` builds the function once (tokenizer, tables). It gets (ids,
    carried columns, texts) of a batch and yields lists of output columns: the
    id, the carried ones and ``columns``. Its attribute ``finish``, if any, is
    called after the last batch and yields more."""
    bound_batches(rows.sparkSession)
    first, text = rows.columns[0], rows.columns[-1]
    schema = StructType([rows.schema[c] for c in [first, *carry]]
                        + [StructField(n, _parse_datatype_string(t)) for n, t in columns])
    schema = StructType([StructField(f.name, f.dataType) for f in schema])
    arrow = to_arrow_schema(schema)

    def run(batches):
        import pyarrow as pa
        function = left_in_stage("", lambda: None)  # forgets what other stages left

        def out(cols):
            return pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(cols, arrow)], arrow.names)

        for batch in batches:
            if batch.num_rows:
                function = function or task()
                for cols in function(batch.column(0), [batch.column(1 + i) for i in range(len(carry))],
                                     batch.column(batch.num_columns - 1).to_pylist()):
                    yield out(cols)
        if hasattr(function, "finish"):
            for cols in function.finish():
                yield out(cols)
        del function
        give_back()

    return rows.select(first, *carry, text).mapInArrow(run, schema)

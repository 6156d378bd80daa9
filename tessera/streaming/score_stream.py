"""Stream scoring: the request endpoint re-aimed as a Structured Streaming query.

File source -> stream-static join to the (static) dimension -> validation -> defaults ->
scoring -> Parquet sink, with checkpoint and output under the shared folder. The query
is stateless, so ``trigger(availableNow=True)`` processes what is there and stops, and a
restart resumes from the checkpoint (exactly-once file sink). With ``run_available_parts``
rejected rows get a table of their own beside the scored ones, committed batch by batch.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.session import get_text, names_in, new_scratch_path, persisted, put_new


def run_available(spark: SparkSession, stream: DataFrame, transform: Callable[[DataFrame], DataFrame],
                  name: str = "stream_score", out_path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Run ``transform`` over everything available in ``stream`` and return the sink table."""
    out_path = out_path or new_scratch_path(spark, name + "-out")
    checkpoint = checkpoint or new_scratch_path(spark, name + "-ckpt")
    q = (transform(stream).writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(out_path)


class BatchSinks:
    """Several tables written together by one stream, each batch once.

    A batch's parts go to folders of their own; then one commit file, put by exclusive create under the batch's number, names
    them all. Readers read committed folders only, so they see a batch in every table or in none; a batch that is replayed
    after a crash finds its commit and writes nothing, and folders left by a writer that died are never read."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def commit(self, number: int) -> str:
        return f"{self.path}/_batches/{number:012d}.json"

    def write(self, number: int, parts: dict[str, DataFrame]) -> bool:
        """Write batch ``number``; False if it was already there."""
        if f"{number:012d}.json" in names_in(self.spark, f"{self.path}/_batches"):
            return False
        folders = {}
        for name, df in parts.items():
            folders[name] = f"{name}/{number:012d}-{uuid.uuid4().hex}"
            df.write.parquet(f"{self.path}/{folders[name]}")
        return put_new(self.spark, self.commit(number), json.dumps(folders))

    def batches(self) -> list[int]:
        return [int(n.split(".")[0]) for n in names_in(self.spark, f"{self.path}/_batches")]

    def read(self, name: str, schema) -> DataFrame:
        """The committed rows of a table (``schema`` is that of an empty one)."""
        folders = [json.loads(get_text(self.spark, self.commit(n)))[name] for n in self.batches()]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])


def run_available_parts(spark: SparkSession, stream: DataFrame, split: Callable[[DataFrame], tuple[DataFrame, dict]],
                        name: str = "stream_parts", out_path: str | None = None,
                        checkpoint: str | None = None) -> dict[str, DataFrame]:
    """Run a stream over what is available into several tables. ``split`` gives the frame that the tables share, kept while
    a batch is written, and a function of it for each table. The tables are returned by name."""
    sinks = BatchSinks(spark, out_path or new_scratch_path(spark, name + "-out"))

    def each(batch: DataFrame, number: int) -> None:
        shared, tables = split(batch)
        with persisted(shared) as kept:
            sinks.write(number, {n: f(kept) for n, f in tables.items()})

    shared, tables = split(stream)
    schemas = {n: f(shared).schema for n, f in tables.items()}
    q = (stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint or new_scratch_path(spark, name + "-ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return {n: sinks.read(n, s) for n, s in schemas.items()}


def checked_parts(rules, transform: Callable[[DataFrame], DataFrame], vocabulary: list[str] | None = None,
                  id_col: str = "subject_id") -> Callable[[DataFrame], tuple[DataFrame, dict]]:
    """A ``split`` for :func:`run_available_parts`: rows that break no rule go through ``transform`` into ``scored``, the
    others into ``rejected`` with the codes of the rules that they break."""
    from tessera.operators import score as X

    def split(rows: DataFrame):
        return rows, {"scored": lambda r: transform(X.valid_rows(r, rules, vocabulary)),
                      "rejected": lambda r: X.rejected_rows(r, rules, id_col)}

    return split


def file_stream(spark: SparkSession, glob: str, schema: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(glob)


def fitted_values(model, column: str) -> list[str]:
    """Values of a categorical column that the pipeline's indexer was fitted on."""
    from pyspark.ml.feature import StringIndexerModel
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            for name, labels in zip(stage.getInputCols(), stage.labelsArray):
                if name.split("__")[0] == column:
                    return list(labels)
    raise ValueError(f"the model has no indexed column {column}")


def score_orders_stream(spark: SparkSession, sf_dir: str, model, rules, spec=None,
                        name: str = "model_stream", vocabulary: list[str] | None = None) -> DataFrame:
    """The scoring endpoint as a stream, with a fitted pipeline: new orders arrive as
    files, each micro-batch joins the static customer table, derives the request
    features, validates, fills defaults and is scored by ``model`` (every stage is
    row-wise, so the fitted pipeline applies to the stream unchanged). ``vocabulary`` is the
    model's spelling of the groups (by default that of its own indexer)."""
    from tessera.functions.features import feature_frame
    from tessera.operators import score as X
    from tessera.sources import fixtures
    from tessera.sources.tables import read_table, table_path
    from tessera.spec import PRESET_A

    spec = spec or PRESET_A
    vocabulary = vocabulary or fitted_values(model, "grp")
    glob = table_path(sf_dir, "orders").replace("orders.parquet", "orders*.parquet")
    orders = file_stream(spark, glob, fixtures.ORDER_SCHEMA)
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])

    def transform(stream):
        feats = feature_frame(fixtures.subjects_from(stream.select(*fixtures.ORDER_COLS), customer), spec)
        valid = X.apply_defaults(X.valid_rows(feats, rules, vocabulary), spec, mode="derive")
        out = model.transform(valid)
        return out.select("subject_id", *X.verdict(X.positive_probability(out)))

    return run_available(spark, orders, transform, name=name)

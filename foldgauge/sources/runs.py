"""Run outputs: predictions, metrics, summaries, exemplars, prompt templates, report tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldgauge import fixed_values as V
from foldgauge.operators.metrics import RUN
from foldgauge.schema import CorpusSchema
from foldgauge.session import rebalanced

RUN_AND_FOLD = (*RUN, "fold")


def write_predictions(predictions: DataFrame, path: str) -> None:
    """Partitioned by run and fold: reading one run or fold prunes the rest."""
    rebalanced(predictions, RUN_AND_FOLD).write.partitionBy(*RUN_AND_FOLD).parquet(path)


def read_partitioned(spark: SparkSession, path: str, names: Sequence[str], ints: Sequence[str] = ("fold",)) -> DataFrame:
    """Parquet below partition folders whose names are texts (a model ``007`` stays that) or, where listed, ints."""
    found = spark.read.parquet(path).schema
    kinds = {name: T.IntegerType() if name in ints else T.StringType() for name in names}
    fields = [T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in found.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return read_partitioned(spark, path, RUN_AND_FOLD)


def metrics_schema(schema: CorpusSchema) -> T.StructType:
    """The metrics document: what every run writes, and the facts only some runs have."""
    metric = T.StructType(
        [
            T.StructField("precision", T.DoubleType()),
            T.StructField("recall", T.DoubleType()),
            T.StructField("f1", T.DoubleType()),
            T.StructField("support", T.LongType()),
        ]
    )
    epoch = T.StructType(
        [
            T.StructField("epoch", T.IntegerType()),
            T.StructField("train_loss", T.DoubleType()),
            T.StructField("val_macro_f1", T.DoubleType()),
            T.StructField("val_micro_f1", T.DoubleType()),
        ]
    )
    fields = [
        ("fold", T.IntegerType()),
        ("model", T.StringType()),
        ("mode", T.StringType()),
        ("max_len", T.IntegerType()),
        ("epochs_run", T.IntegerType()),
        ("best_epoch", T.IntegerType()),
        ("best_val_macro_f1", T.DoubleType()),
        ("train_time_seconds", T.DoubleType()),
        ("history", T.ArrayType(epoch)),
        ("n_test", T.LongType()),
        ("parse_failures", T.LongType()),
        ("parse_failure_rate", T.DoubleType()),
        ("mean_latency_seconds", T.DoubleType()),
        ("total_inference_seconds", T.DoubleType()),
        ("per_label", T.StructType([T.StructField(label, metric) for label in schema.labels])),
        ("macro_f1", T.DoubleType()),
        ("micro_f1", T.DoubleType()),
    ]
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


def _per_label_document(schema: CorpusSchema) -> Column:
    """The ``per_label`` array as an object keyed by label."""
    names = ("precision", "recall", "f1", "support")
    return F.struct(
        *[
            F.struct(*[F.col("per_label")[i][name].alias(name) for name in names]).alias(label)
            for i, label in enumerate(schema.labels)
        ]
    )


def _per_label_array(schema: CorpusSchema) -> Column:
    """The object keyed by label as an array in label order."""
    names = ("precision", "recall", "f1", "support")
    return F.array(
        *[
            F.struct(F.lit(label).alias("label"), *[F.col(f"per_label.{label}.{name}").alias(name) for name in names])
            for label in schema.labels
        ]
    )


def write_fold_metrics(metrics: DataFrame, path: str, schema: CorpusSchema) -> None:
    """One JSON document per run and fold, below partition folders for run and fold; rows are counted as ``n_test``."""
    if "n_test" not in metrics.columns:
        metrics = metrics.withColumnRenamed("n_rows", "n_test")
    metrics.withColumn("per_label", _per_label_document(schema)).write.partitionBy(*RUN_AND_FOLD).json(path)


def write_run_summary(summary: DataFrame, path: str) -> None:
    summary.write.partitionBy(*RUN).json(path)


def read_fold_metrics(spark: SparkSession, path: str, schema: CorpusSchema) -> DataFrame:
    """Metrics written by ``write_fold_metrics``; run and fold come from the folders."""
    fields = [field for field in metrics_schema(schema).fields if field.name not in RUN_AND_FOLD]
    keys = [T.StructField(name, T.StringType()) for name in RUN] + [T.StructField("fold", T.IntegerType())]
    raw = spark.read.schema(T.StructType(fields + keys)).json(path)
    return raw.withColumn("per_label", _per_label_array(schema))


def export_run_tree(metrics: DataFrame, root: str, schema: CorpusSchema) -> None:
    """A tree of run folders with one document per run and fold, as ``import_run_tree`` reads it.

    The documents are written by one job below partition folders, whose few paths (one for each run and fold) are then renamed.
    """
    spark = metrics.sparkSession
    work = f"{root}/_written"
    write_fold_metrics(metrics.repartition(*RUN_AND_FOLD), work, schema)
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for model, mode, think, fold in spark.read.schema(", ".join(f"{n} string" for n in RUN) + ", fold int").json(work).select(*RUN_AND_FOLD).distinct().collect():
        run = model if mode == V.MODES[0] else f"{model}/{mode}/{think}"
        target = hadoop.Path(f"{root}/{run}/fold_{fold}")
        files.mkdirs(target)
        for written in files.globStatus(hadoop.Path(f"{work}/model={model}/mode={mode}/think={think}/fold={fold}/part-*")):
            files.rename(written.getPath(), hadoop.Path(target, "metrics.json"))
    files.delete(hadoop.Path(work), True)


def import_run_tree(spark: SparkSession, root: str, schema: CorpusSchema) -> DataFrame:
    """Metrics from a tree of run folders, all runs and folds in one scan.

    ``<encoder>/fold_<n>/metrics.json`` is a fine-tuned run; ``<chat model>/<mode>/fold_<n>/metrics.json``
    a prompted one, with an optional thinking folder below the mode. Anything else is left out.
    """
    raw = spark.read.schema(metrics_schema(schema)).options(
        recursiveFileLookup=True, pathGlobFilter="metrics.json", multiLine=True
    ).json(root)
    located = raw.drop("model", "mode").withColumn("path", F.col("_metadata.file_path"))
    run = run_of_path("path")
    return located.select(
        *run,
        F.coalesce(F.col("fold"), F.regexp_extract("path", r"/fold_(\d+)/", 1).cast("int")).alias("fold"),
        *[name for name in located.columns if name not in ("fold", "per_label", "path")],
        _per_label_array(schema).alias("per_label"),
        "path",
    ).where(F.col("mode") != "")


def run_of_path(path: str) -> list[Column]:
    """``model``, ``mode`` and ``think`` of a metrics path; mode is empty for a path of no run."""
    encoder = F.regexp_extract(path, rf"/({V.ENCODER_PREFIX}[^/]+)/fold_\d+/[^/]+$", 1)
    chat = rf"/({V.CHAT_PREFIX}[^/]+)/([^/]+)(?:/(think|nothink))?/fold_\d+/[^/]+$"
    is_encoder = encoder != ""
    return [
        F.when(is_encoder, encoder).otherwise(F.regexp_extract(path, chat, 1)).alias("model"),
        F.when(is_encoder, F.lit(V.MODES[0])).otherwise(F.regexp_extract(path, chat, 2)).alias("mode"),
        F.when(is_encoder | (F.regexp_extract(path, chat, 3) == ""), F.lit("nothink"))
        .otherwise(F.regexp_extract(path, chat, 3))
        .alias("think"),
    ]


def discover_runs(metrics: DataFrame, run: Sequence[str] = RUN) -> DataFrame:
    """Every run with metrics and how many folds it has."""
    return metrics.groupBy(*run).agg(F.count_distinct("fold").alias("n_folds"))


def write_exemplars(exemplars: DataFrame, path: str) -> None:
    exemplars.write.partitionBy("fold").parquet(path)


def read_exemplars(spark: SparkSession, path: str) -> DataFrame:
    return read_partitioned(spark, path, ["fold"])


def write_templates(templates: DataFrame, path: str) -> None:
    """One text file per mode and fold, a partition folder each."""
    templates.write.partitionBy("mode", "fold").option("lineSep", "\u0001").text(path)


def read_templates(spark: SparkSession, path: str) -> DataFrame:
    texts = spark.read.option("lineSep", "\u0001").text(path)
    return texts.select("mode", F.col("fold").cast("int").alias("fold"), F.col("value").alias("template"))


def write_markdown(table: DataFrame, path: str) -> None:
    """The lines of a report table as one text file; report tables are small by construction."""
    table.repartition(1).sortWithinPartitions("section", "place").select("line").write.text(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet") -> DataFrame:
    """A table that may not exist yet: its rows, or none."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)

"""Load, clean and optionally train, from sources to stored model."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsieve.operators.normalise import normalise_messages, union_sources
from mailsieve.operators.profile import source_label_report
from mailsieve.operators.sampling import balance_classes
from mailsieve.plans.quality_job import QualityTables, read_quality_tables, run_quality_job
from mailsieve.plans.training import Training, save_training, train_models
from mailsieve.schema import ROW_KEY
from mailsieve.session import remove_folder
from mailsieve.settings import LABELS
from mailsieve.sources.manifest import Manifest, digest, table_version
from mailsieve.sources.sinks import write_json, write_table


@dataclass(frozen=True)
class FullRun:
    """``training`` is there if this run trained; ``done`` names the stages it did."""

    quality: QualityTables
    training: Training | None
    done: list[str]


def with_known_label(frame: DataFrame) -> DataFrame:
    return frame.filter(F.col("label").isin(*LABELS))


def with_source_keys(sources: Sequence[DataFrame], row_key: str = ROW_KEY) -> list[DataFrame]:
    """Give every row a key that is unique over all sources: source number and own key.

    Keys of one type keep it, so rows keep the order of their source; otherwise all
    keys become strings.
    """
    kinds = {source.schema[row_key].dataType.simpleString() for source in sources}
    kind = kinds.pop() if len(kinds) == 1 else "string"
    return [
        source.withColumn(
            row_key,
            F.struct(F.lit(number).alias("source_no"), F.col(row_key).cast(kind).alias("key")),
        )
        for number, source in enumerate(sources)
    ]


def require_unique_keys(frame: DataFrame, row_key: str = ROW_KEY) -> None:
    """Duplicates are decided by row key: a key that stands twice would mix up rows."""
    repeated = frame.groupBy(row_key).count().filter((F.col("count") > 1) | F.col(row_key).isNull())
    examples = repeated.limit(5).collect()
    if examples:
        raise ValueError(f"row keys are missing or not unique, for example {[r[0] for r in examples]}")


def load_sources(
    sources: Sequence[DataFrame], output_folder: str, row_key: str = ROW_KEY, force: bool = False
) -> DataFrame:
    """Merge labelled sources and store them, with a report of rows per source and label.

    They are stored whole (``labelled``), balanced one by one (``balanced_sources``)
    and balanced together (``balanced``). Keys may repeat between sources: each row
    gets the number of its source as a part of its key. Within a source they must not.
    Sources that have not changed since the last run are not read again, unless ``force``.
    """
    manifest = Manifest(sources[0].sparkSession, output_folder)
    return _load(sources, output_folder, row_key, manifest, force)[0]


def _load(
    sources: Sequence[DataFrame], output_folder: str, row_key: str, manifest: Manifest, force: bool
) -> tuple[DataFrame, str, list[str]]:
    """The balanced table, its version, and the stages that were done."""
    spark = sources[0].sparkSession
    normal = with_source_keys([normalise_messages(s, row_key) for s in sources], row_key)
    schema = union_sources(*normal).schema
    versions = [digest(uuid.uuid4() if force else table_version(s), schema.json()) for s in normal]
    whole = digest(len(sources), *versions)
    done = []

    def stage(name: str, version: str, work: Callable[[], object]) -> None:
        if manifest.run(name, version, work):
            done.append(name)

    def stored(path: str) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{output_folder}/{path}").select(*schema.names)

    for number, (source, version) in enumerate(zip(normal, versions, strict=True)):
        place = f"labelled/source_no={number}"
        stage(place, version, lambda s=source, p=place: write_table(s, f"{output_folder}/{p}", partition_by="source"))
    # The folders of sources that are no longer given.
    for old in sorted(set(manifest.stages) - {f"labelled/source_no={n}" for n in range(len(sources))}):
        if old.startswith("labelled/source_no="):
            manifest.run(old, "", lambda p=old: remove_folder(spark, f"{output_folder}/{p}"))
    labelled = stored("labelled")
    stage("unique_keys", whole, lambda: require_unique_keys(labelled, row_key))

    for number, version in enumerate(versions):
        place = f"balanced_sources/{number}"

        def balance_one(n: int = number, p: str = place) -> None:
            rows = with_known_label(stored(f"labelled/source_no={n}"))
            write_table(balance_classes(rows, row_key=row_key), f"{output_folder}/{p}")

        stage(place, version, balance_one)

    def balance_all() -> None:
        rows = balance_classes(with_known_label(labelled), row_key=row_key)
        write_table(rows, f"{output_folder}/balanced", partition_by="source")

    stage("balanced", whole, balance_all)
    stage("source_report", whole, lambda: write_json(source_label_report(labelled), f"{output_folder}/source_report"))
    return stored("balanced"), whole, done


def run_all(
    sources: Sequence[DataFrame],
    output_folder: str,
    train_model: bool = False,
    sample_size: int | None = None,
    row_key: str = ROW_KEY,
    force: bool = False,
) -> FullRun:
    """Load, clean and optionally train. What an earlier run into the same folder finished on the
    same sources is not done again: its tables are read. ``force`` does everything anew."""
    spark = sources[0].sparkSession
    manifest = Manifest(spark, output_folder)
    balanced, version, done = _load(sources, output_folder, row_key, manifest, force)
    quality_folder = f"{output_folder}/quality"
    if manifest.run(
        "quality", version, lambda: run_quality_job(balanced, quality_folder, f"{output_folder}/balanced", row_key=row_key)
    ):
        done.append("quality")
    quality = read_quality_tables(spark, quality_folder)
    trained: list[Training] = []

    def train() -> None:
        trained.append(train_models(quality.clean, sample_size, row_key=row_key))
        save_training(trained[0], f"{output_folder}/training")

    if train_model and manifest.run("training", digest(version, sample_size), train):
        done.append("training")
    return FullRun(quality, trained[0] if trained else None, done)

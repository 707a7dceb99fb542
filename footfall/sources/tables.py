"""Tables as parquet folders: whole ones, ones with a snapshot per week, logs and exports.

Writes are committed, see :mod:`footfall.sources.commits`: data goes to a new folder, ``<table>/v-…`` or
``<table>/snapshot_week=…/version=…``, and readers look up which folders are live. Folders without commits are read
as plain parquet, and exports are plain folders.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from footfall.operators.sampling import stratified_sample
from footfall.session import move_path, remove_path
from footfall.sources.commits import ATTEMPTS, ORPHAN_SECONDS, WHOLE, Commit, CommitConflict, CommitLog, new_version

SNAPSHOT = "snapshot_week"
VERSION = "version"
ARRIVAL = "_arrival"
ROWS_PER_FILE = 400_000


def _folder(path: str, part: str, version: str) -> str:
    root = path.rstrip("/")
    return f"{root}/v-{version}" if part == WHOLE else f"{root}/{SNAPSHOT}={part}/{VERSION}={version}"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table, or a folder of parquet parts; a snapshot table with its weeks in ``snapshot_week``."""
    commit = CommitLog(spark, path).newest()
    return spark.read.parquet(path) if commit is None else _committed(spark, path, commit)


def _committed(spark: SparkSession, path: str, commit: Commit) -> DataFrame:
    live = [_folder(path, part, version) for part, version in sorted(commit.live.items())]
    if WHOLE in commit.live:
        return spark.read.parquet(*live)
    return spark.read.option("basePath", path).parquet(*live).drop(VERSION)


def read_snapshot(spark: SparkSession, path: str, week_identifier: str) -> DataFrame:
    """One week of a snapshot table with that week's own columns; other weeks are not opened."""
    root, commit = path.rstrip("/"), CommitLog(spark, path).newest()
    if commit is None:
        folder = f"{root}/{SNAPSHOT}={week_identifier}"
    elif week_identifier in commit.live:
        folder = _folder(path, week_identifier, commit.live[week_identifier])
    else:
        raise ValueError(f"{path} has no snapshot of week {week_identifier!r}")
    own = spark.read.parquet(folder).schema.add(SNAPSHOT, "string")
    if commit is not None:
        own = own.add(VERSION, "string")
    found = spark.read.schema(own).option("basePath", root).parquet(folder)
    return found.filter(F.col(SNAPSHOT) == week_identifier).drop(SNAPSHOT, VERSION)


def read_query(
    spark: SparkSession, statement: str, tables: Mapping[str, DataFrame], values: Mapping[str, object] | None = None
) -> DataFrame:
    """A SELECT over frames named in ``{braces}``, with ``:name`` markers bound to values."""
    return spark.sql(statement, args=dict(values or {}), **tables)


def _write(df: DataFrame, folder: str, rows_per_file: int | None) -> None:
    writer = df.write if rows_per_file is None else df.write.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(folder)


def write_snapshot(df: DataFrame, path: str, week_identifier: str, rows_per_file: int | None = None) -> None:
    """Replace one week of a snapshot table at once and leave the others as they are."""
    version = new_version()
    _write(df, _folder(path, week_identifier, version), rows_per_file)
    CommitLog(df.sparkSession, path).commit(lambda live: {**live, week_identifier: version})


def write_snapshots(df: DataFrame, path: str) -> None:
    """Replace the weeks present in column ``snapshot_week``, many at once and all in one commit."""
    root, version = path.rstrip("/"), new_version()
    df.withColumn(VERSION, F.lit(version)).write.mode("append").partitionBy(SNAPSHOT, VERSION).parquet(root)
    log = CommitLog(df.sparkSession, path)
    weeks = [f for f in log.folders(root, f"{SNAPSHOT}=") if log.folders(f, f"{VERSION}={version}")]
    written = {folder.rsplit("=", 1)[1]: version for folder in weeks}
    log.commit(lambda live: {**live, **written})


def replace_table(df: DataFrame, path: str) -> None:
    version = new_version()
    _write(df, _folder(path, WHOLE, version), None)
    CommitLog(df.sparkSession, path).commit(lambda live: {WHOLE: version})


def write_parts(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Replace a plain folder, for readers outside the library, by files of bounded size.

    The files are written beside the folder and moved when they are complete, so a write that dies leaves the
    old ones; between removal and move there are none for a moment.
    """
    fresh = f"{path.rstrip('/')}-{new_version()}"
    _write(df, fresh, rows_per_file)
    move_path(df.sparkSession, fresh, path)


def export_features(
    df: DataFrame,
    path: str,
    ids: Sequence[str],
    features: Sequence[str],
    label: str,
    week_identifier: str | None = None,
) -> None:
    """Ids, features and label of a feature matrix, in files of bounded size; a snapshot if a week is given."""
    chosen = df.select(*ids, *features, label)
    if week_identifier is None:
        write_parts(chosen, path)
    else:
        write_snapshot(chosen, path, week_identifier, ROWS_PER_FILE)


def _rewrite(record: DataFrame, path: str, merge: Callable[[DataFrame], DataFrame]) -> None:
    """Replace a small log by ``merge`` of its rows (``_arrival`` 0) and the new ones (1), again if another writer
    was faster."""
    spark, log = record.sparkSession, CommitLog(record.sparkSession, path)
    new = record.withColumn(ARRIVAL, F.lit(1))
    for _ in range(ATTEMPTS):
        base, version = log.newest(), new_version()
        rows = new
        if base is not None:
            known = _committed(spark, path, base).withColumn(ARRIVAL, F.lit(0))
            rows = known.unionByName(new, allowMissingColumns=True)
        merge(rows).write.parquet(_folder(path, WHOLE, version))
        try:
            log.commit(lambda live: {WHOLE: version}, base.number if base else 0)
            return
        except CommitConflict:
            remove_path(spark, _folder(path, WHOLE, version))
    raise CommitConflict(f"{path} keeps changing")


def append_record(record: DataFrame, path: str) -> None:
    """Add rows to a small log."""
    _rewrite(record, path, lambda rows: rows.drop(ARRIVAL))


def upsert_record(record: DataFrame, path: str, keys: Sequence[str], newest: str) -> None:
    """Put rows into a log that holds one row per key: the one with the greatest ``newest``, of equal ones the one
    written last. Keys match where their nulls do.

    The log is rewritten as a whole; it is meant for a row per training run.
    """

    def merge(rows: DataFrame) -> DataFrame:
        columns = [c for c in rows.columns if c != ARRIVAL]
        last = F.max_by(F.struct(*columns), F.struct(newest, ARRIVAL)).alias("_row")
        return rows.groupBy(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)]).agg(last).select("_row.*")

    _rewrite(record, path, merge)


def vacuum(spark: SparkSession, path: str, keep: int = 2, orphan_seconds: float = ORPHAN_SECONDS) -> int:
    """Remove versions of a table that its newest ``keep`` commits do not name; returns how many."""
    root, log = path.rstrip("/"), CommitLog(spark, path)

    def written() -> list[str]:
        weeks = log.folders(root, f"{SNAPSHOT}=")
        return log.folders(root, "v-") + [f for week in weeks for f in log.folders(week, f"{VERSION}=")]

    return log.vacuum(lambda part, version: _folder(root, part, version), written, keep, orphan_seconds)


def export_sample_csv(df: DataFrame, path: str, key: str, stratum: str, fraction: float) -> None:
    """A stratified sample as CSV files with a header line."""
    stratified_sample(df, key, stratum, fraction).write.mode("overwrite").option("header", True).csv(path)


def model_path(folder: str, model_type: str, week_identifier: str) -> str:
    return f"{folder.rstrip('/')}/best_model_{model_type}_{week_identifier}"


def save_model(model: PipelineModel, folder: str, model_type: str, week_identifier: str) -> None:
    """Scaling and learner together, so scoring never refits them."""
    model.write().overwrite().save(model_path(folder, model_type, week_identifier))


def load_model(folder: str, model_type: str, week_identifier: str) -> PipelineModel:
    return PipelineModel.load(model_path(folder, model_type, week_identifier))

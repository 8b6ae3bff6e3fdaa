"""Which source a run reads, and the record of that decision."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigate.config import DataConfig
from lexigate.operators.audits import audit_checksums, file_digests
from lexigate.operators.quality import DataValidationError
from lexigate.sources.csv_source import read_csv
from lexigate.sources.labelled_lines import (
    DatasetIntegrityError,
    quarantine_counts,
    read_labelled_files,
    read_lines,
)
from lexigate.sources.provenance import (
    licensed_provenance,
    local_provenance,
    synthetic_provenance,
)
from lexigate.sources.synthetic import synthetic_reviews

logger = logging.getLogger(__name__)


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def verify_files(spark: SparkSession, path: str, digests: dict[str, str]) -> None:
    """Refuse a folder whose files are not exactly the pinned ones.

    A file is hashed as one row, so each must be smaller than 2 GB.
    """
    manifest = spark.createDataFrame(sorted(digests.items()), "file string, sha256 string")
    wrong = (
        audit_checksums(file_digests(spark, path), manifest)
        .filter("status <> 'ok'")
        .orderBy("file")
        .limit(20)
        .collect()
    )
    if wrong:
        found = ", ".join(f"{row['file']} ({row['status']})" for row in wrong)
        raise DatasetIntegrityError(f"files differ from their pinned digests: {found}")


def acquire(spark: SparkSession, config: DataConfig) -> tuple[DataFrame, dict[str, str]]:
    """Rows and provenance.

    In order: a CSV that is configured and there; the fixture if it is allowed and preferred; the
    licensed dataset; and if that fails the fixture only if it is allowed, else an error. Nothing
    degrades to generated text unasked. Licensed files are verified first, if digests are pinned,
    and read in full once, so that an unreadable one is met here; the record tells how many lines
    were parsed and skipped, and how many files were verified.
    """
    if config.csv_path and path_exists(spark, config.csv_path):
        frame = read_csv(spark, config.csv_path, config.text_column, config.label_column)
        if config.id_column not in frame.columns:
            frame = frame.withColumn(config.id_column, F.monotonically_increasing_id())
        return frame, local_provenance(config.csv_path, frame.count())

    def fixture():
        rows, seed = config.synthetic_rows, config.random_state
        return synthetic_reviews(spark, rows, seed), synthetic_provenance(rows, seed)

    if config.allow_synthetic_fallback and config.prefer_synthetic:
        return fixture()
    record = licensed_provenance(config.dataset_key)
    try:
        if not config.dataset_path:
            raise DatasetIntegrityError(f"no local copy of {config.dataset_key} is configured")
        if config.dataset_digests:
            verify_files(spark, config.dataset_path, config.dataset_digests)
        rows = read_labelled_files(spark, config.dataset_path)
        lines = quarantine_counts(read_lines(spark, config.dataset_path))
        parsed, skipped = lines.agg(F.sum("parsed"), F.sum("skipped")).first()
        return rows, record | {
            "n_rows": str(parsed),
            "n_skipped": str(skipped),
            "n_files_verified": str(len(config.dataset_digests)),
        }
    except (DatasetIntegrityError, PySparkException) as error:
        if not config.allow_synthetic_fallback:
            raise DataValidationError(
                f"Could not read the dataset ({error}). Generated text takes its place only if "
                "allow_synthetic_fallback is set."
            ) from error
        logger.warning("Dataset unavailable (%s); using the synthetic fixture", error)
        return fixture()

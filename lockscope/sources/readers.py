"""Readers: every source becomes a DataFrame with a declared schema."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.choices import CONFIG_NAMES, LOCKFILE_NAMES
from ..functions.paths import is_profile_id
from ..functions.values import non_blank, strip
from ..schemas import EVENT_LOG


def read_profile_ids(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed, non-blank lines of an id list: (profile_id)."""
    lines = spark.read.text(path).select(strip(F.col("value")).alias("profile_id"))
    return lines.filter(F.col("profile_id") != "")


def profile_id_problems(ids: DataFrame) -> DataFrame:
    """(profile_id, times, reason) of malformed and repeated ids."""
    counted = ids.groupBy("profile_id").agg(F.count("*").alias("times"))
    reason = F.when(~is_profile_id(F.col("profile_id")), "invalid profile ID").when(
        F.col("times") > 1, "duplicate profile ID"
    )
    return counted.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def require_profile_ids(ids: DataFrame) -> DataFrame:
    """The ids; the job fails while it runs when one is malformed or repeated."""
    counted = ids.groupBy("profile_id").agg(F.count("*").alias("times"))
    checked = (
        F.when(
            ~is_profile_id(F.col("profile_id")),
            F.raise_error(F.concat(F.lit("invalid profile ID: "), F.col("profile_id"))),
        )
        .when(F.col("times") > 1, F.raise_error(F.concat(F.lit("duplicate profile ID: "), F.col("profile_id"))))
        .otherwise(F.col("profile_id"))
    )
    return counted.select(checked.cast("string").alias("profile_id"))


def candidate_names() -> list[str]:
    """File names read per root: configuration first, each name once."""
    return list(dict.fromkeys((*CONFIG_NAMES, *LOCKFILE_NAMES)))


def read_candidate_files(spark: SparkSession, base: str) -> DataFrame:
    """FILES rows of ``base/<profile>/<root>/<file>`` for the known file names.

    Other names are left out when the files are listed. A root directory is with ``__`` for ``/`` and ``root`` for the top. Spark skips files whose name starts
    with a dot, so those are stored as ``dot.npmrc`` and so on.
    """
    stored = [f"dot{n}" if n.startswith(".") else n for n in candidate_names()]
    raw = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "{" + ",".join(stored) + "}")
        .load(base)
    )
    return describe_files(raw.select("path", "content"))


def describe_files(raw: DataFrame) -> DataFrame:
    """(path, content) -> FILES rows with hash and size."""
    pattern = r"([^/]+)/([^/]+)/([^/]+)$"
    stored = F.regexp_extract("path", pattern, 2)
    root = F.when(stored == "root", ".").otherwise(F.replace(stored, F.lit("__"), F.lit("/")))
    name = F.regexp_replace(F.regexp_extract("path", pattern, 3), r"^dot\.", ".")
    return raw.filter(name.isin(*candidate_names())).select(
        F.regexp_extract("path", pattern, 1).alias("profile_id"),
        root.alias("dependency_root"),
        name.alias("filename"),
        "content",
        F.sha2("content", 256).alias("sha256"),
        F.octet_length("content").cast("bigint").alias("size_bytes"),
    )


def files_per_root(files: DataFrame) -> DataFrame:
    """Lockfile and manifest names per root, in the fixed order of the name lists."""
    key = ["profile_id", "dependency_root"]

    def present(names: tuple[str, ...]) -> Column:
        have = [F.when(F.max(F.when(F.col("filename") == n, True)), F.lit(n)) for n in names]
        return F.array_compact(F.array(*have))

    return files.groupBy(*key).agg(
        present(LOCKFILE_NAMES).alias("lockfiles"), present(CONFIG_NAMES).alias("manifest_files")
    )


def read_stage_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON document with a declared schema; no rows when it does not exist."""
    try:
        return spark.read.schema(schema).json(path, multiLine=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    """Core fields of a JSON-lines event log."""
    return spark.read.schema(EVENT_LOG).json(path)


def read_event_log_open(spark: SparkSession, path: str) -> DataFrame:
    """Whole records as one VARIANT column ``record``; use ``try_variant_get``."""
    return spark.read.option("singleVariantColumn", "record").json(path)


def task_rows(lines: DataFrame, collection: str = "SWE-smith") -> DataFrame:
    """(task_id, repository) of one collection, from the lines (``value``) of a task CSV without fixed header.

    A line of fewer than five fields is no task. An empty repository is kept as ''.
    """
    schema = "c0 STRING, c1 STRING, c2 STRING, c3 STRING, c4 STRING, odd STRING"
    plain = F.regexp_replace("value", "^\ufeff", "")
    read = lines.select(F.from_csv(plain, schema, {"columnNameOfCorruptRecord": "odd"}).alias("c")).select("c.*")
    # Spark marks lines of fewer and of more fields alike; an empty field reads as NULL
    enough = F.col("odd").isNull() | F.col("c4").isNotNull() | (F.length("odd") - F.length(F.replace("odd", F.lit(","))) >= 4)
    return read.filter((F.col("c0") == collection) & non_blank(F.col("c3")).isNotNull() & enough).select(
        F.col("c3").alias("task_id"), F.coalesce("c4", F.lit("")).alias("repository")
    )


def read_tasks(spark: SparkSession, path: str, collection: str = "SWE-smith") -> DataFrame:
    """``task_rows`` of a CSV file."""
    return task_rows(spark.read.text(path), collection)


def read_blobs(spark: SparkSession, base: str) -> DataFrame:
    """(blob_path, path, length, content) of ``base/blobs/<algorithm>/<hex>``."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
    return raw.select(
        F.regexp_extract("path", r"(blobs/[^/]+/[^/]+)$", 1).alias("blob_path"), "path", "length", "content"
    )


def directory_bytes(spark: SparkSession, base: str) -> DataFrame:
    """Total bytes below a directory; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def read_cache_index(spark: SparkSession, base: str) -> DataFrame:
    """Lines of all cache index files: (value)."""
    return spark.read.option("recursiveFileLookup", "true").text(base)


def read_install_logs(spark: SparkSession, base: str) -> DataFrame:
    """Whole logs ``base/<profile>/<root>/<phase>.<stream>.log``, one row per file."""
    raw = spark.read.option("recursiveFileLookup", "true").text(base, wholetext=True)
    path = F.col("_metadata.file_path")
    pattern = r"([^/]+)/([^/]+)/([^/.]+)\.(stdout|stderr)\.log$"
    stored = F.regexp_extract(path, pattern, 2)
    return raw.select(
        F.regexp_extract(path, pattern, 1).alias("profile_id"),
        F.when(stored == "root", ".").otherwise(F.replace(stored, F.lit("__"), F.lit("/"))).alias("dependency_root"),
        F.regexp_extract(path, pattern, 3).alias("phase"),
        F.regexp_extract(path, pattern, 4).alias("stream"),
        F.col("value").alias("text"),
    )

"""Raw JSON documents: one document per file, keyed by the file name.

Every scan declares its schema, keeps what it could not parse in
``_corrupt_record`` and names the file in ``file_key``. The same decoding is
available for documents held in a text column (:func:`parse_documents`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from courtlake import schemas
from courtlake.functions.text import WHITE_SPACE, key_from_path, or_empty
from courtlake.session import written_once
from courtlake.sources.files import path_exists

CORRUPT = "_corrupt_record"


def list_documents(spark: SparkSession, path: str) -> DataFrame:
    """(file_key, path, size) of the documents below a folder, from its listing; none is opened."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "file_key string, path string, size bigint")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path)
    return files.select(key_from_path("path").alias("file_key"), "path", F.col("length").alias("size"))


def listed_paths(spark: SparkSession, path: str, entries: DataFrame) -> list[str]:
    """Paths of the documents below a folder whose key is the game id of an entry.

    A file scan keeps the status of each of its files on the driver in any case; these are the
    names of those alone, passed on task by task.
    """
    wanted = entries.select(F.col("game_id").alias("file_key")).distinct()
    found = list_documents(spark, path).join(wanted, "file_key", "left_semi").select("path")
    return [row.path for row in found.toLocalIterator()]


def scan_documents(spark: SparkSession, path: str, schema: str, entries: DataFrame | None = None) -> DataFrame:
    """Documents below ``path`` (absent folder = no documents).

    With ``entries`` (game_id) only the files they list are opened, however many.
    """
    paths = [path] if entries is None else listed_paths(spark, path, entries)
    if not paths or not path_exists(spark, path):
        return spark.createDataFrame([], f"file_key string, {schema}, {CORRUPT} string")
    files = spark.read.option("pathGlobFilter", "*.json").text(paths, wholetext=True)
    keyed = files.select(key_from_path("_metadata.file_name").alias("file_key"), "value")
    return parse_documents(keyed, "value", schema)


def parse_documents(df: DataFrame, text_column: str, schema: str) -> DataFrame:
    """Decode a column of JSON text in place of a file scan; malformed text is kept apart.

    The generator keeps a later filter from parsing the text a second time.
    """
    # Blank text would parse to nothing; a lone brace is malformed, as it should be.
    blank = F.length(F.btrim(F.col(text_column), F.lit(WHITE_SPACE))) == 0
    text = F.when(blank, "{").otherwise(F.col(text_column))
    parsed = F.from_json(
        text, f"{schema}, {CORRUPT} string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    kept = [F.col(c) for c in df.columns if c != text_column]
    return df.select(*kept, F.inline(F.array(parsed)))


def document_keys(spark: SparkSession, path: str) -> DataFrame:
    """Keys of the documents below ``path``, without opening any."""
    return list_documents(spark, path).select("file_key")


def split_corrupt(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable documents, quarantine of the unreadable ones with their text)."""
    good = docs.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, docs.where(F.col(CORRUPT).isNotNull())


def drop_failed_files(rows: DataFrame, file_column: str, failed: Column) -> tuple[DataFrame, DataFrame]:
    """Leave out every row of a file in which any row failed.

    Returns (rows of good files, names of failed files). The names are distinct
    before the join, and the rows are only filtered by them, so a file with very
    many rows needs no group of its own.
    """
    marked = rows.withColumn("_failed", F.coalesce(failed, F.lit(False)))
    bad_files = marked.where("_failed").select(file_column).distinct()
    good = marked.where(~F.col("_failed")).drop("_failed").join(bad_files, file_column, "left_anti")
    return good, bad_files


def keep_nonempty(docs: DataFrame, array: str | Column) -> DataFrame:
    """Documents whose list is there and has entries."""
    column = F.col(array) if isinstance(array, str) else array
    return docs.where(F.size(or_empty(column)) > 0)


# ---- manifests -----------------------------------------------------------

MANIFEST_PART_DOC = f"{schemas.MANIFEST_DOC}, first_pos bigint"


def manifest_documents(files: DataFrame) -> DataFrame:
    """Manifest documents out of ``files(file_key, value)``, malformed ones kept apart.

    A file holds one document, written in whatever way, or one on each line. A
    document without a date counts as malformed.
    """
    lines = F.filter(F.split("value", "\n"), lambda x: F.length(F.btrim(x, F.lit(WHITE_SPACE))) > 0)
    one_each = (F.size(lines) > 0) & F.forall(
        lines, lambda x: F.btrim(x, F.lit(WHITE_SPACE)).rlike(r"^\{.*\}$"))
    each = F.explode(F.when(one_each, lines).otherwise(F.array("value")))
    found = files.select("file_key", each.alias("doc")).withColumn("_text", F.col("doc"))
    parsed = parse_documents(found, "doc", MANIFEST_PART_DOC)
    undated = F.col("game_date").try_cast("date").isNull()
    return parsed.withColumn(CORRUPT, F.coalesce(CORRUPT, F.when(undated, F.col("_text")))).drop("_text")


def scan_manifest_documents(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], f"file_key string, {MANIFEST_PART_DOC}, {CORRUPT} string")
    files = spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True)
    return manifest_documents(
        files.select(key_from_path("_metadata.file_name").alias("file_key"), "value"))


def scan_manifests(spark: SparkSession, path: str) -> DataFrame:
    """All readable manifests below ``path`` as (game_date date, first_pos bigint, game_ids)."""
    return typed_manifests(split_corrupt(scan_manifest_documents(spark, path))[0])


def malformed_manifests(spark: SparkSession, path: str) -> DataFrame:
    """(file_key, text) of manifests that can't be read or have no date."""
    return split_corrupt(scan_manifest_documents(spark, path))[1].select(
        "file_key", F.col(CORRUPT).alias("text"))


def typed_manifests(docs: DataFrame) -> DataFrame:
    """Manifest documents with a date and never-null id lists and start positions."""
    first = F.coalesce(F.col("first_pos"), F.lit(0)) if "first_pos" in docs.columns else F.lit(0)
    return docs.where(F.col("game_date").isNotNull()).select(
        F.col("game_date").cast("date").alias("game_date"),
        first.cast("bigint").alias("first_pos"),
        or_empty("game_ids").alias("game_ids"),
    )


def skip_no_game_days(manifests: DataFrame) -> DataFrame:
    return keep_nonempty(manifests, "game_ids")


def manifest_entries(manifests: DataFrame) -> DataFrame:
    """One row per listed game: (game_date, manifest_pos, game_id)."""
    return manifests.select("game_date", "first_pos", F.posexplode("game_ids").alias("_pos", "game_id")).select(
        "game_date", (F.col("first_pos") + F.col("_pos")).alias("manifest_pos"), "game_id",
    )


def require_manifests(dates: DataFrame, manifests: DataFrame) -> DataFrame:
    """Manifests of the wanted dates; a date without one is an error at once."""
    wanted = dates.select("game_date").distinct()
    absent = wanted.join(manifests, "game_date", "left_anti")
    missing = absent.agg(F.count("*").alias("n"), F.min("game_date").alias("first"),
                         F.max("game_date").alias("last")).first()
    if missing.n:
        raise FileNotFoundError(f"no manifest for {missing.n} dates from {missing.first} to {missing.last}"
                                if missing.n > 1 else f"no manifest for {missing.first}")
    return manifests.join(wanted, "game_date", "left_semi")


# ---- one scan per document kind ------------------------------------------

def scan_boxscores(spark: SparkSession, path: str) -> DataFrame:
    return scan_documents(spark, path, schemas.BOXSCORE_DOC)


def scan_actions(spark: SparkSession, path: str) -> DataFrame:
    return scan_documents(spark, path, schemas.ACTIONS_DOC)


def scan_result_sets(spark: SparkSession, path: str) -> DataFrame:
    return scan_documents(spark, path, schemas.RESULT_SET_DOC)


def scan_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that each hold one JSON array of flat objects: one row per object.

    Carries the file (``_file``) and the place in its array (``_row_pos``).
    """
    files = spark.read.text(path, wholetext=True)
    return parse_json_array(
        files.select(F.col("_metadata.file_name").alias("_file"), "value"), "value", schema
    )


def parse_json_array(df: DataFrame, text_column: str, schema: str) -> DataFrame:
    """Text holding a JSON array of flat objects: one row per object, with its position."""
    items = F.from_json(text_column, ArrayType(StructType.fromDDL(schema)))
    kept = [F.col(c) for c in df.columns if c != text_column]
    return df.select(*kept, F.posexplode(items).alias("_row_pos", "_item")).select(
        *kept, "_row_pos", "_item.*"
    )


def malformed_arrays(spark: SparkSession, path: str) -> DataFrame:
    """(_file, text) of files that hold no JSON array of objects; :func:`scan_json_array` has no rows of them."""
    files = spark.read.text(path, wholetext=True)
    items = F.from_json("value", ArrayType(StructType.fromDDL(f"{CORRUPT} string")))
    return files.where(items.isNull()).select(F.col("_metadata.file_name").alias("_file"), F.col("value").alias("text"))


# Work lists up to this many bytes are sent to every task; larger ones are shuffled.
SMALL_LIST_BYTES = 32 * 1024 * 1024
#: Games of a shuffled work list whose documents one task decodes.
PART_GAMES = 25_000


def listed_games(entries: DataFrame) -> DataFrame:
    """The work list as the small side of a join: one row per date and game.

    Left alone, Spark may take the documents for the smaller side, as it does not
    know how far they expand. So the list is written once and measured: a small one is broadcast,
    a larger one is hashed, in parts of ``PART_GAMES`` games. Either way the documents stream.
    """
    listed = written_once(entries.sparkSession, entries.groupBy("game_date", "game_id").agg(
        F.min("manifest_pos").alias("manifest_pos")
    ), "listed")
    size, n = listed.agg(F.sum(F.octet_length("game_id") + F.lit(32)), F.count("*")).first()
    if (size or 0) <= SMALL_LIST_BYTES:
        return F.broadcast(listed)
    # Parts by number stay as they are; Spark would join them by the bytes of documents not yet decoded.
    return listed.repartition(-(-n // PART_GAMES), "game_id").hint("shuffle_hash")


def listed_documents(docs: DataFrame, entries: DataFrame) -> DataFrame:
    """Documents whose key is on a manifest, with date and list position.

    Ids without a document vanish, as do documents nobody lists.
    """
    return on_list(docs, listed_games(entries))


def on_list(docs: DataFrame, listed: DataFrame) -> DataFrame:
    """As :func:`listed_documents`, for a list prepared by :func:`listed_games`."""
    return docs.withColumnRenamed("file_key", "game_id").join(listed, "game_id")

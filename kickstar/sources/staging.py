"""Staging layer: all-text CSV source, audit columns, batch ids, full refresh, reconciliation.

Source files are read with an explicit all-string schema (never inferred). A quoted
empty string stays an empty string; an unquoted empty field arrives as NULL (the CSV
parser's behaviour). The cleaning step treats both the same way (NULL -> "" -> trimmed ->
empty -> NULL), so the staged text is as good as verbatim for every later rule.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kickstar.frames import shuffles_removed
from kickstar.sources.csv_records import csv_table

# fixed values: staging column lists (source header order)
STAGING_COLUMNS: dict[str, tuple[str, ...]] = {
    "appearances": ("appearance_id", "game_id", "player_id", "player_club_id", "player_current_club_id", "date",
                    "player_name", "competition_id", "yellow_cards", "red_cards", "goals", "assists",
                    "minutes_played"),
    "club_games": ("game_id", "club_id", "own_goals", "own_position", "own_manager_name", "opponent_id",
                   "opponent_goals", "opponent_position", "opponent_manager_name", "hosting", "is_win"),
    "player_valuations": ("player_id", "date", "market_value_in_eur", "current_club_name", "current_club_id",
                          "player_club_domestic_competition_id"),
    "transfers": ("player_id", "transfer_date", "transfer_season", "from_club_id", "to_club_id", "from_club_name",
                  "to_club_name", "transfer_fee", "market_value_in_eur", "player_name"),
    "clubs": ("club_id", "club_code", "name", "domestic_competition_id", "total_market_value", "squad_size",
              "average_age", "foreigners_number", "foreigners_percentage", "national_team_players", "stadium_name",
              "stadium_seats", "net_transfer_record", "coach_name", "last_season", "filename", "url"),
    "competitions": ("competition_id", "competition_code", "name", "sub_type", "type", "country_id", "country_name",
                     "domestic_league_code", "confederation", "total_clubs", "url"),
    "countries": ("country_id", "country_name", "country_code", "confederation", "total_clubs", "total_players",
                  "average_age", "url"),
    "games": ("game_id", "competition_id", "season", "round", "date", "home_club_id", "away_club_id",
              "home_club_goals", "away_club_goals", "home_club_position", "away_club_position",
              "home_club_manager_name", "away_club_manager_name", "stadium", "attendance", "referee", "url",
              "home_club_formation", "away_club_formation", "home_club_name", "away_club_name", "aggregate",
              "competition_type"),
    "national_teams": ("national_team_id", "name", "team_code", "country_id", "country_name", "country_code",
                       "confederation", "team_image_url", "squad_size", "average_age", "foreigners_number",
                       "foreigners_percentage", "total_market_value", "coach_name", "fifa_ranking", "last_season",
                       "url"),
    "players": ("player_id", "first_name", "last_name", "name", "last_season", "current_club_id", "player_code",
                "country_of_birth", "city_of_birth", "country_of_citizenship", "date_of_birth", "sub_position",
                "position", "foot", "height_in_cm", "contract_expiration_date", "agent_name", "image_url",
                "international_caps", "international_goals", "current_national_team_id", "url",
                "current_club_domestic_competition_id", "current_club_name", "market_value_in_eur",
                "highest_market_value_in_eur"),
}


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def csv_raw_source(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Read a CSV (header row, '"' qualifier, quoted newlines) with every column as text, by
    many tasks per file. The audit finds the file of each row in ``with_source_file``."""
    records = csv_table(spark, path, columns)
    raw = records.select(*columns)
    raw.with_source_file = records.select(*columns, "source_file")
    return raw


def batch_id_for(ts: dt.datetime) -> str:
    """BATCH_yyyyMMdd_HHmmss — fixed for one run."""
    return ts.strftime("BATCH_%Y%m%d_%H%M%S")


def batch_id_col(ts: Column) -> Column:
    return F.date_format(ts, "'BATCH_'yyyyMMdd_HHmmss")


def audit_columns(df: DataFrame, batch_id: str, loaded_at: dt.datetime | None = None,
                  source_file: str | Column | None = None) -> DataFrame:
    """Add batch_id, loaded_at and the source file name (last path element)."""
    loaded = F.lit(loaded_at).cast("timestamp") if loaded_at else F.current_timestamp()
    known = getattr(df, "__dict__", {}).get("with_source_file")
    if source_file is None and known is not None:
        return known.select(*df.columns, F.lit(batch_id).alias("batch_id"), loaded.alias("loaded_at"), "source_file")
    if source_file is None:
        src = F.element_at(F.split(F.input_file_name(), "/"), -1)
    elif isinstance(source_file, str):
        src = F.lit(source_file)
    else:
        src = source_file
    return df.withColumns({"batch_id": F.lit(batch_id), "loaded_at": loaded, "source_file": src})


def staging_full_refresh(frames: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Truncate-and-load every staging table (overwrite); returns the table paths."""
    out = {}
    for name, df in frames.items():
        path = f"{root.rstrip('/')}/stg_raw_{name}"
        with shuffles_removed(df.sparkSession):
            df.write.mode("overwrite").parquet(path)
        out[name] = path
    return out


def stage_csv(spark: SparkSession, files: dict[str, str], root: str, started_at: dt.datetime,
              batch_id: str | None = None) -> dict[str, DataFrame]:
    """Full refresh of the staging tables from CSV: ``files`` names the file or folder of each
    table; every row gets batch id, load time, source file and its number (``source_row``).
    Returns the staged tables, ready for a load."""
    batch = batch_id or batch_id_for(started_at)
    frames = {name: audit_columns(csv_table(spark, path, STAGING_COLUMNS[name]), batch, started_at, F.col("source_file"))
              for name, path in files.items()}
    return {name: spark.read.schema(frames[name].schema).parquet(path) for name, path in staging_full_refresh(frames, root).items()}


def record_digests(rows: DataFrame, columns: Sequence[str], key: Sequence[str], buckets: int = 64) -> DataFrame:
    """(bucket, rows, digest) of the rows' ``columns``, in buckets of ``key``: the sum of two row
    hashes, so the order of rows plays no part and doubled, lost and changed rows show. Null and
    empty text count as the same."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    both = F.xxhash64(*text).cast("decimal(38,0)") * F.lit(2).cast("decimal(38,0)") + F.xxhash64(F.lit(1), *text).cast("decimal(38,0)")
    bucket = F.pmod(F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]), F.lit(buckets)).cast("int")
    return rows.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("rows"), F.sum(both).alias("digest"))


def reconcile_records(source: DataFrame, staged: DataFrame | None, columns: Sequence[str], key: Sequence[str], buckets: int = 64) -> DataFrame:
    """(bucket, source_rows, staged_rows, status) per bucket of the key: PASS where file and
    staged table hold the same records, MISMATCH where they do not, FAILED without a staged table."""
    a = record_digests(source, columns, key, buckets).withColumnsRenamed({"rows": "source_rows", "digest": "d1"})
    if staged is None:
        return a.select("bucket", "source_rows", F.lit(None).cast("long").alias("staged_rows"), F.lit("FAILED").alias("status"))
    b = record_digests(staged, columns, key, buckets).withColumnsRenamed({"rows": "staged_rows", "digest": "d2"})
    same = F.col("d1").eqNullSafe(F.col("d2")) & F.col("source_rows").eqNullSafe(F.col("staged_rows"))
    return a.join(b, "bucket", "full").select("bucket", F.coalesce("source_rows", F.lit(0)).alias("source_rows"),
                                              F.coalesce("staged_rows", F.lit(0)).alias("staged_rows"),
                                              F.when(same, F.lit("PASS")).otherwise(F.lit("MISMATCH")).alias("status"))


def record_differences(source: DataFrame, staged: DataFrame, columns: Sequence[str], key: Sequence[str], buckets: int = 64) -> DataFrame:
    """The records that differ, with ``n`` (source minus staged occurrences); only the buckets
    that do not pass are compared row by row."""
    bad = reconcile_records(source, staged, columns, key, buckets).filter("status <> 'PASS'").select("bucket")
    bucket = F.pmod(F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]), F.lit(buckets)).cast("int").alias("bucket")
    part = lambda df, sign: df.select(bucket, *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns], F.lit(sign).alias("n"))
    both = part(source, 1).unionAll(part(staged, -1)).join(bad, "bucket", "left_semi")
    return both.groupBy("bucket", *columns).agg(F.sum("n").alias("n")).filter("n <> 0")


def file_fingerprints(spark: SparkSession, name: str, path: str) -> DataFrame:
    """One row per source file: its path, bytes, lines and a line fingerprint (the sum of
    xxhash64 over the lines). The text scan splits large files, so no file passes whole
    through one task, and files of any size are treated alike. Files are matched by their
    full path; Spark does not list empty files, so they have no row."""
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"),
                                                             F.col("length").alias("bytes"))
    lines = spark.read.text(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.xxhash64("value").cast("decimal(38,0)")).cast("string").alias("fp"))
    return files.join(lines, "file", "left").select(
        F.lit(name).alias("table_name"), "file", "bytes", F.coalesce("lines", F.lit(0)).alias("lines"),
        F.coalesce("fp", F.lit("0")).alias("line_fingerprint"))


def source_reconcile(spark: SparkSession, files: dict[str, str], staged: dict[str, DataFrame]) -> DataFrame:
    """Per source file: bytes, lines and a distributed line fingerprint, records parsed from the file, rows staged, and a PASS / MISMATCH / FAILED status.
    Counting parsed records (not raw lines) keeps quoted newlines from being miscounted."""
    rows = []
    for name, path in files.items():
        content = file_fingerprints(spark, name, path)
        src = csv_raw_source(spark, path, staged[name].columns[:1] if name not in STAGING_COLUMNS
                             else STAGING_COLUMNS[name]).agg(F.count(F.lit(1)).alias("source_rows"))
        dst = staged[name].agg(F.count(F.lit(1)).alias("staged_rows"))
        rows.append(content.crossJoin(F.broadcast(src)).crossJoin(F.broadcast(dst)))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    status = (F.when(F.col("staged_rows").isNull() | F.col("source_rows").isNull(), F.lit("FAILED"))
              .when(F.col("staged_rows") == F.col("source_rows"), F.lit("PASS")).otherwise(F.lit("MISMATCH")))
    return out.withColumn("status", status)

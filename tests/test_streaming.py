"""The streaming load: new staged files → new fact rows; history-aware LAG; replays add nothing."""
import tempfile
import uuid

from kickstar.plans import warehouse as WH
from kickstar.sources import sinks
from kickstar.plans.staged import FACT_VAL_SCHEMA
from kickstar.streaming import incremental as S


def _write(spark, path, rows):
    spark.createDataFrame(rows, S.STAGED_VALUATION_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_stream_loads_increments(spark):
    root = tempfile.mkdtemp(prefix="kickstar-stream-")
    stg, fact = f"{root}/stg", f"{root}/fact"
    player = spark.createDataFrame([(11, 1, None, True)], "player_key long, player_id long, date_of_birth date, "
                                                          "is_current boolean")
    club = spark.createDataFrame([(55, 5, True)], "club_key long, club_id long, is_current boolean")
    win = WH.LoadWindow("2024-01-01", "2024-12-31", "STREAM")
    name = f"t{uuid.uuid4().hex[:8]}"
    _write(spark, stg, [("1", "2024-01-01", "100", None, "5", "GB1", "B1", 1),
                        ("1", "2024-01-02", "150", None, "5", "GB1", "B1", 2)])
    S.start_valuation_stream(spark, stg, fact, player, club, win, name=name).awaitTermination()
    assert S.rows_loaded(spark, fact) == 2
    _write(spark, stg, [("1", "2024-01-05", "120", None, "5", "GB1", "B2", 3)])
    S.start_valuation_stream(spark, stg, fact, player, club, win, name=name).awaitTermination()
    rows = sorted((r.date_key, r.value_change_eur) for r in sinks.read_or_empty(spark, fact, FACT_VAL_SCHEMA).collect())
    assert rows == [(20240101, None), (20240102, 50), (20240105, -30)]     # LAG across micro-batches
    S.start_valuation_stream(spark, stg, fact, player, club, win, name=name).awaitTermination()
    assert S.rows_loaded(spark, fact) == 3                                  # nothing new, nothing twice

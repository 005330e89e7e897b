"""Incremental, idempotent loads: re-running a window adds 0 rows; LAG sees history."""
import tempfile

from pyspark.sql import functions as F

from kickstar.plans import warehouse as WH
from kickstar.plans.staged import FACT_VAL_SCHEMA


def _stg(spark):
    rows = [("1", "2024-01-01 10:00:00", "100", "5", "GB1", "BATCH_1", 1),
            ("1", "2024-01-02 10:00:00", "150", "5", "GB1", "BATCH_1", 2),
            ("1", "2024-01-02 11:00:00", "160", "5", "GB1", "BATCH_2", 3),   # same day, later batch wins
            ("1", "2024-01-03 10:00:00", "130", "5", "GB1", "BATCH_1", 4),
            ("2", "2024-01-03 10:00:00", "x", "75", "", "BATCH_1", 5),        # cast reject
            ("3", "2024-01-03 10:00:00", "-5", "515", "", "BATCH_1", 6)]      # rule reject
    return spark.createDataFrame(rows, "player_id string, date string, market_value_in_eur string, "
                                       "current_club_id string, player_club_domestic_competition_id string, "
                                       "batch_id string, source_row long")


def _dims(spark):
    player = spark.createDataFrame([(11, 1, None, True), (12, 2, None, True)],
                                   "player_key long, player_id long, date_of_birth date, is_current boolean")
    club = spark.createDataFrame([(55, 5, True), (-1, -1, True), (-2, -2, True)],
                                 "club_key long, club_id long, is_current boolean")
    return player, club


def test_window_after_first_dates_uses_history(spark):
    player, club = _dims(spark)
    empty = spark.createDataFrame([], FACT_VAL_SCHEMA)
    w1 = WH.LoadWindow("2024-01-01", "2024-01-02", "RUN1")
    f1, _ = WH.load_fact_player_valuation(_stg(spark), player, club, empty, w1)
    assert sorted((r.date_key, r.market_value_eur, r.value_change_eur) for r in f1.collect()) == \
        [(20240101, 100, None), (20240102, 160, 60)]
    w2 = WH.LoadWindow("2024-01-03", "2024-01-31", "RUN2")
    f2, rej = WH.load_fact_player_valuation(_stg(spark), player, club, f1, w2)
    assert [(r.date_key, r.value_change_eur) for r in f2.collect()] == [(20240103, -30)]   # uses date 2
    assert sorted(r.reason for r in rej.collect()) == ["cast error", "negative market value"]


def test_incremental_append_is_idempotent(spark):
    player, club = _dims(spark)
    root = tempfile.mkdtemp(prefix="kickstar-fact-")
    path = f"{root}/fact_player_valuation"
    win = WH.LoadWindow("2024-01-01", "2024-01-31", "RUN")
    added = []
    for _ in range(2):
        existing = spark.read.schema(FACT_VAL_SCHEMA).parquet(path) if added else \
            spark.createDataFrame([], FACT_VAL_SCHEMA)
        f, _ = WH.load_fact_player_valuation(_stg(spark), player, club, existing, win)
        added.append(WH.incremental_append(spark, f, path, ["player_key", "date_key"], FACT_VAL_SCHEMA))
    assert added == [3, 0]


def test_split_windows_equal_one_window(spark):
    df = spark.range(0, 40).select(F.date_add(F.to_date(F.lit("2024-01-01")), F.col("id").cast("int")).alias("d"))
    split = WH.assign_batches(df, F.col("d"), [WH.LoadWindow("2024-01-01", "2024-01-15", "A"),
                                               WH.LoadWindow("2024-01-01", "2024-12-31", "B"),
                                               WH.LoadWindow("2024-01-01", "2024-12-31", "C")])
    counts = {r.batch_id: r["count"] for r in split.groupBy("batch_id").count().collect()}
    assert counts == {"A": 15, "B": 25}          # the re-run C adds nothing
    one = WH.assign_batches(df, F.col("d"), [WH.LoadWindow("2024-01-01", "2024-12-31", "ALL")])
    assert one.count() == sum(counts.values())


def test_journal(spark):
    import datetime as dt
    from kickstar.plans.warehouse import JOURNAL_SCHEMA
    j = spark.createDataFrame([], JOURNAL_SCHEMA)
    w = WH.LoadWindow("2024-01-01", "2024-01-31", "B1")
    j = WH.journal_start(j, "B1", w, dt.datetime(2024, 2, 1), 0)
    j = WH.journal_start(j, "B2", w, dt.datetime(2024, 2, 2), 0)      # B1 never finished -> FAILED
    j = WH.journal_finish(j, "B2", dt.datetime(2024, 2, 2, 1), 10)
    got = sorted((r.run_id, r.batch_id, r.status, r.fact_rows_after) for r in j.collect())
    assert got == [(1, "B1", "FAILED", None), (2, "B2", "SUCCESS", 10)]


def test_standing_rollup_maintenance(spark):
    from kickstar.plans.questions import standing_rollup
    cols = "season_key int, club_key long, points int, is_win int, is_draw int, is_loss int, goals_for int, " \
           "goals_against int"
    a = spark.createDataFrame([(2024, 1, 3, 1, 0, 0, 2, 1), (2024, 2, 0, 0, 0, 1, 1, 2)], cols)
    b = spark.createDataFrame([(2024, 1, 1, 0, 1, 0, 1, 1)], cols)
    kept = WH.maintain_standing_rollup(WH.maintain_standing_rollup(None, a), a.unionByName(b))
    full = standing_rollup(a.unionByName(b))
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, full.select(*kept.columns).collect()))

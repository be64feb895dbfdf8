"""The streaming event log equals the batch extract on a single file and on a
folder of files that arrive in any order."""

from tessera.plans import extracts as X
from tessera.sources.tables import Tables
from tessera.streaming import daily_logs
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(str(r[c]) for c in ("EventDate", "UserID", "open_time", "payment_screen_time"))
                  for r in df.collect())


def test_single_file_and_shuffled_folder(spark, tmp_path):
    want = _rows(X.daily_event_log(Tables(spark, SF_SMALL)))
    for name, folder in (("one", SF_SMALL), ("many", str(tmp_path))):
        if name == "many":
            (spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(5)
             .write.parquet(f"{folder}/events.parquet"))
        sink = daily_logs.run(spark, folder, name=f"log-{name}-{tmp_path.name}", files_per_trigger=1)
        assert _rows(daily_logs.current_table(spark, sink)) == want

"""Screening of records as they arrive. Each record is judged by itself, so no state is kept: every micro-batch is a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..config import ScreeningConfig
from ..plans.screening import screen
from ..sinks import Store
from ..sources.inputs import normalized, numbered
from ..sources.watchlist import WatchList


def screen_stream(rows: DataFrame, watch: WatchList, store: Store, checkpoint: str, config: ScreeningConfig = ScreeningConfig(), once: bool = False) -> StreamingQuery:  # noqa: B008
    """rows: a stream with the raw columns of sources.inputs. A micro-batch that is run again replaces what it wrote."""

    def run(batch: DataFrame, batch_id: int) -> None:
        run_id = batch_id + 1
        for table in ("MatchingResults_Person_Full", "MatchingResults_AKA", "MatchingResults_OrgName", "MatchingResults_OrgName_NoMatch", "MatchingResults_OrgName_AKA", "MatchingResults_OrgName_AKA_NoMatch", "MatchingResults_LinkedTo", "MatchingResults_Phone", "MatchingResults_NoMatch", "MatchingResults_Address", "MatchingResults_GatePassing", "Matching_Summary_Person", "Matching_Summary_Org", "Report", "RunLog", "Inputs"):
            store.drop_run(table, run_id)
        store.append("Inputs", numbered(normalized(batch, config)), run_id)
        screen(store.read("Inputs", run_id).drop("Run_ID"), watch, config, store, run_id)

    writer = rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()

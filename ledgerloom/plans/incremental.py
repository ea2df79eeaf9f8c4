"""The roll-up again, from a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerloom import session
from ledgerloom.operators import holdings
from ledgerloom.plans import standins as S
from ledgerloom.plans.catalog import Tables, plain, query
from ledgerloom.streaming import incremental


class _ArrivingLines(Tables):
    """The same tables with lineitem as a stream of files."""

    @property
    def lineitem(self) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.folder}/lineitem.parquet").schema
        # A table may be one file or a folder of them; each batch takes a bounded number of files.
        return self.spark.readStream.schema(schema).option("maxFilesPerTrigger", 8).parquet(f"{self.folder}/lineitem.parquet*")


@query("incremental_holdings", f"WITH {S.ROLLUP_SQL} SELECT * FROM r")
def incremental_holdings(t: Tables) -> DataFrame:
    arriving = S.holding_lines(_ArrivingLines(t.spark, t.folder))
    lines = holdings.security_filter(arriving, S.STOCK_TYPE, S.STOCK_WORDS).drop("title", "shareType")
    folder = session.work_folder(t.spark, "incremental")
    incremental.start_rollup(lines, f"{folder}/store", f"{folder}/checkpoint").awaitTermination()
    return plain(incremental.read_rollup(t.spark, f"{folder}/store"))

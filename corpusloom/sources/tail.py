"""A resumable tail of event files as a streaming data source: ``spark.readStream.format("event_tail")``.

Offsets are ids: a batch has the rows whose id is above that of the batch before, up to the largest there is, and what a checkpoint has
committed isn't read again. The first start begins ``cold`` rows before the end. A batch is cut to ranges of ids, one a
partition, which executors read with column pruning and with the id range pushed to the row groups. Options: path (a file or folder
of Parquet files that all executors reach), id (the name of the column), cold (200), partitions (8).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema


class IdRange(InputPartition):
    """Ids above ``low``, up to ``high``."""

    def __init__(self, low: int, high: int):
        super().__init__((low, high))
        self.low, self.high = low, high


class TailReader(DataSourceStreamReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.schema, self.path, self.id = schema, options["path"].removeprefix("file:"), options["id"]
        self.cold, self.parts = int(options.get("cold", 200)), int(options.get("partitions", 8))

    def _ids(self, above: int | None = None) -> Iterator[pa.Array]:
        """The ids, a batch at a time."""
        rows = ds.dataset(self.path, format="parquet")
        wanted = None if above is None else pc.field(self.id) > above
        for batch in rows.to_batches(columns=[self.id], filter=wanted):
            if batch.num_rows:
                yield batch.column(0)

    def initialOffset(self) -> dict[str, int]:
        """The id before the last ``cold`` rows; of all ids no more than these are held."""
        last = pa.array([], pa.int64())
        for ids in self._ids():
            both = pa.concat_arrays([last, ids.cast(pa.int64()).drop_null()])
            last = both.take(pc.select_k_unstable(both, min(self.cold + 1, len(both)), [("", "descending")])) if len(both) else both
        if len(last) > self.cold:
            return {"id": min(last.to_pylist())}
        return {"id": min(last.to_pylist()) - 1 if len(last) else -1}

    def latestOffset(self) -> dict[str, int]:
        found = [pc.max(ids).as_py() for ids in self._ids()]
        return {"id": max((x for x in found if x is not None), default=-1)}

    def partitions(self, start: dict[str, int], end: dict[str, int]) -> Sequence[InputPartition]:
        low, high = start["id"], end["id"]
        step = max(1, -(-(high - low) // self.parts))
        return [IdRange(a, min(a + step, high)) for a in range(low, high, step)]

    def read(self, partition: Any) -> Iterator[pa.RecordBatch]:
        own = pc.field(self.id)
        wanted = to_arrow_schema(self.schema)
        rows = ds.dataset(self.path, format="parquet")
        for batch in rows.to_batches(columns=self.schema.names, filter=(own > partition.low) & (own <= partition.high)):
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(f.name).cast(f.type) for f in wanted], schema=wanted)

    def commit(self, end: dict[str, int]) -> None:
        pass


class EventTail(DataSource):
    @classmethod
    def name(cls) -> str:
        return "event_tail"

    def schema(self) -> str:
        raise ValueError("state the schema: spark.readStream.format('event_tail').schema(...)")

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return TailReader(schema, dict(self.options))


def tail(spark: SparkSession, path: str, schema: str | T.StructType, id_column: str, cold: int = 200):
    """The stream of new rows of ``path``."""
    spark.dataSource.register(EventTail)
    return spark.readStream.format("event_tail").schema(schema).option("path", path).option("id", id_column).option("cold", cold).load()

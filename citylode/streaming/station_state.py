"""Live bike-station states: message mapping and the latest state per station."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from citylode.operators.dedup import keep_latest_row
from citylode.operators.slots import SlotTable
from citylode.operators.storage import children, exists, remove
from citylode.operators.versions import VersionedTable
from citylode.schemas import STATION_STATE
from citylode.streaming.ingest import has_text

STATE = STATION_STATE.fieldNames()
ORDER = ["timestamp", "position"]


def to_messages(polled: DataFrame, cycle: Column) -> DataFrame:
    """Polled records as messages; all records of a poll share its time."""
    return polled.select(
        F.col("stationcode").alias("stationId"), cycle.alias("timestamp"),
        F.col("numbikesavailable").alias("num_bikes_available"),
        F.col("numdocksavailable").alias("num_docks_available"),
        "mechanical", "ebike", "nom_arrondissement_communes",
        F.col("coordonnees_geo.lat").alias("latitude"),
        F.col("coordonnees_geo.lon").alias("longitude"))


def keyed(states: DataFrame) -> DataFrame:
    """States that name a station."""
    return states.filter(has_text("stationId"))


def latest_states(states: DataFrame) -> DataFrame:
    """The newest state of each station, by message time and then position in the topic.

    Ordering by the message's own time keeps an older state that arrives late, or again, from
    replacing a newer one. The remaining columns settle equal times and positions.
    """
    others = [c for c in states.columns if c not in ("stationId", *ORDER)]
    return keep_latest_row(
        keyed(states), ["stationId"], [F.col(c).desc_nulls_last() for c in ORDER + others])


class StateTable:
    """The latest state per station.

    A batch is merged with the current version into the next one. The work per batch is one row per
    station, not per message, and merging the same batch again changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.table = SlotTable(spark, path)

    def read(self) -> DataFrame | None:
        """Current states, None before the first batch."""
        return self.table.read()

    def put(self, batch: DataFrame) -> None:
        """Merge a batch of states (with a ``position`` column)."""
        fresh = batch.select(*STATE, "position")
        known = self.table.read()
        self.table.replace(latest_states(fresh if known is None else fresh.unionByName(known)))


def newest_by_station(states: DataFrame) -> DataFrame:
    """The newest state of each station, as one aggregate: of a stream, kept in its state store.

    The same order as ``latest_states``: message time, position, then the other columns, missing ones last.
    """
    others = [c for c in states.columns if c not in ("stationId", *ORDER)]
    whole = F.struct(*[c for c in states.columns if c != "stationId"])
    return keyed(states).groupBy("stationId").agg(
        F.max_by(whole, F.struct(*ORDER, *others)).alias("state")).select("stationId", "state.*")


class ChangeTable:
    """The latest state per station as a base and the changes since, each one row for every station that changed.

    A batch writes the stations that it changed and nothing else. Readers take the newest row of each station;
    now and then the changes are merged into the base.
    """

    def __init__(self, spark: SparkSession, path: str, merge_after: int = 100):
        self.spark, self.path, self.merge_after = spark, path.rstrip("/"), merge_after
        self.base = VersionedTable(spark, f"{self.path}/base")

    def changes(self) -> list[str]:
        """Folders of whole changes: one for each batch of a stream."""
        return [f"{self.path}/changes/{name}" for name in children(self.spark, f"{self.path}/changes")
                if exists(self.spark, f"{self.path}/changes/{name}/_SUCCESS")]

    def read(self) -> DataFrame | None:
        """Current states, None before the first batch."""
        return self.newest(self.changes())

    def newest(self, folders: list[str]) -> DataFrame | None:
        base = self.base.read()
        if not folders:
            return base
        schema = StructType([*STATION_STATE.fields, StructField("position", DoubleType())])
        rows = self.spark.read.schema(schema).parquet(*folders)
        return latest_states(rows if base is None else rows.unionByName(base))

    def put(self, changed: DataFrame, name: str) -> None:
        """Write the stations that a batch changed; the same batch again replaces them."""
        changed.select(*STATE, "position").write.mode("overwrite").parquet(f"{self.path}/changes/{name}")
        folders = self.changes()
        if len(folders) >= self.merge_after:
            # Lost between the two steps, the changes are merged once more, which changes nothing.
            self.base.commit(self.newest(folders))
            for folder in folders:
                remove(self.spark, folder)


def follow_changes(decoded: DataFrame, table: ChangeTable, checkpoint: str, once: bool = True):
    """Keep the latest state of each station from a decoded stream, by an aggregate in Spark's state store.

    A batch reads its messages and the stored states of their stations, and writes the stations that changed,
    so its work does not grow with the number of stations known. States that a new checkpoint does not know
    are in the table, where an older state never replaces a newer one.
    """
    good = decoded.filter(F.col("bad_message").isNull()).drop("bad_message")

    def write(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        table.put(batch, f"{stream}-{batch_id:09d}")

    writer = newest_by_station(good).writeStream.outputMode("update").foreachBatch(write).option(
        "checkpointLocation", checkpoint)
    if once:
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return query
    return writer.start()


def follow(
    decoded: DataFrame, table: StateTable, quarantine: str, checkpoint: str, once: bool = True,
):
    """Keep the state table current from a decoded stream; undecodable messages go to quarantine.

    The quarantine is written by stream and batch, so that a batch that is run again replaces its own messages
    and a stream of another checkpoint leaves them alone.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch.persist()
        try:
            bad = batch.filter(F.col("bad_message").isNotNull())
            bad.select("bad_message").write.mode("overwrite").parquet(f"{quarantine}/stream={stream}/batch={batch_id}")
            table.put(batch.filter(F.col("bad_message").isNull()))
        finally:
            batch.unpersist()

    writer = decoded.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if once:
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return query
    return writer.start()

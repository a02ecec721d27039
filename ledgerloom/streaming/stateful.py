"""Vault loading on a stream with keyed state (inventory J17a J17b, A4).

The state store holds what a load compares with, so no micro-batch reads the
stored tables: hubs and links keep the keys that they have seen (streaming
``dropDuplicates``), satellites the dates and hashes of each key's versions.
State is partitioned by hash key and lives in the query's checkpoint folder; on
a cluster keep it in RocksDB (:data:`ROCKSDB`), so that it needn't fit the heap.
A satellite's state is kept by the first hex digits of the hash keys, for many
keys at once: a Python call for each key costs more than all its rows.

State and output advance together: a micro-batch that fails is tried again with
the state of before, and its folder ``batch_id=<n>`` is overwritten.  So every
row is stored exactly once, however often a batch is tried.
"""

from __future__ import annotations

import struct
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import vault as V
from .incremental import batch_writer

#: Session settings for state that may outgrow executor memory.
ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}

#: The versions of all keys with the same first digits, in the order in which they were found.
HISTORY = "versions binary"
VERSION = ">32sq32s"  # hash key, load date in microseconds, hash of the attributes

#: Hex digits of a hash key that its state is kept by: 4096 groups, of 13,000 keys each at 54 million.
#: A query's checkpoint holds for one number only.
STATE_DIGITS = 3


def new_versions(history: list[tuple[int, bytes]], incoming: list[tuple[int, bytes]]) -> list[int]:
    """Places of the incoming versions that are new, in the order of their dates; ``history`` (sorted) takes them in.

    A version is new if it differs from the one in force at its date and from
    the next one (:func:`~ledgerloom.operators.vault.without_unchanged`).  Of
    versions with one date the one with the greatest hash counts.
    """
    new, latest = [], {}
    for n, (at, found) in enumerate(incoming):
        if at not in latest or found > incoming[latest[at]][1]:
            latest[at] = n
    for at in sorted(latest):
        found = incoming[latest[at]][1]
        place = bisect_right(history, at, key=lambda v: v[0])
        if all(h != found for _, h in history[max(0, place - 1) : place + 1]):
            history.insert(place, (at, found))
            new.append(latest[at])
    return new


def changed_versions(rows: DataFrame, key: str, digits: int = STATE_DIGITS) -> DataFrame:
    """A stream of satellite rows, without those that the state of their key has already.

    ``key`` and ``hash_diff`` are sha256 hex digests.  The state of all keys that
    begin with the same ``digits`` is one value; the rows of each key are still compared with its own versions only.
    """
    columns = rows.columns

    def step(_, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(batches), ignore_index=True)
        stored = bytes(state.get[0]) if state.exists else b""
        histories: dict[bytes, list[tuple[int, bytes]]] = {}
        for k, at, found in struct.iter_unpack(VERSION, stored):
            histories.setdefault(k, []).append((at, found))
        keys, hashes = (list(map(bytes.fromhex, frame[c])) for c in (key, "hash_diff"))
        dates = frame["load_date"].astype("datetime64[us]").astype("int64").tolist()
        places: dict[bytes, list[int]] = {}
        for n, k in enumerate(keys):
            places.setdefault(k, []).append(n)
        new: list[int] = []
        for k, mine in places.items():
            found = new_versions(sorted(histories.get(k, [])), [(dates[n], hashes[n]) for n in mine])
            new += [mine[n] for n in found]
        if new:
            state.update((stored + b"".join(struct.pack(VERSION, keys[n], dates[n], hashes[n]) for n in new),))
        yield frame.iloc[new][columns]

    parts = rows.withColumn("_part", F.substring(key, 1, digits))
    return parts.groupBy("_part").applyInPandasWithState(step, rows.schema, HISTORY, "append", GroupStateTimeout.NoTimeout)


def stream_vault_state(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    target: str,
    spec: V.HubSpec | V.LinkSpec | V.SatSpec,
    checkpoint: str,
    fmt: str = "parquet",
    writer: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Load every new landed file of one source into one vault table and stop.

    A row's load date is its own ``_ingested_at``.  Rows without a key are no
    entity.  Hubs and links keep the first row of a key that arrives.
    """
    rows = spark.readStream.schema(schema).format(fmt).load(landing)
    business_key = spec.pairs[0][0] if isinstance(spec, V.LinkSpec) else spec.business_key
    rows = rows.where(F.col(business_key).isNotNull())
    shaped = {V.HubSpec: V.hub_rows, V.LinkSpec: V.link_rows, V.SatSpec: V.sat_rows}[type(spec)](spec, rows, F.col("_ingested_at"), None)
    if isinstance(spec, V.SatSpec):
        out = changed_versions(shaped, spec.hash_key)
    else:
        out = shaped.dropDuplicates([spec.link_key if isinstance(spec, V.LinkSpec) else spec.hash_key])
    return (
        out.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(writer or batch_writer(target, fmt))
        .start()
    )

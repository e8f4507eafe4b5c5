"""Which keys earlier batches have used, without reading all of what they wrote.

Beside a stream's target lie two tables:

* ``used/batch_id=N/bucket=B``: the keys of each batch, in ``BUCKETS`` folders by hash;
* ``filters/slot=0`` and ``slot=1``: a Bloom filter of all keys up to a batch, as bitmaps of
  32,768 bits, each for a slice of a bucket.  Batch N reads the slot of N - 1 and writes the
  other one, so a batch that is run again finds what it found the first time.

A batch tests its keys against the filter.  Those that fail have never been seen.  The others
are looked up in the folders of their own buckets, which settles them exactly.  So a batch of
new keys opens no key of the past, however many batches there were; only the filter is read,
and it grows by doubling when the number of keys has (its false answers stay about one in
4,000 keys).  A doubling, and a filter that is missing or of another batch, costs one pass over
the used keys.

Keys are compared as SQL compares them, NULL being a key like any other.  Where no hash
follows that comparison (collations other than the one that ignores case) all keys share one
place: each batch then looks all of its keys up.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from siltgate.functions import quoted
from siltgate.operators.joins import BROADCAST_BYTES, rows_with_keys
from siltgate.operators.skew import hashed_value
from siltgate.sources.staging import staging_dir, written

BUCKETS = 64
#: Bits of a slice, the keys it is meant for, and the bits set for a key.
SLICE_BITS, SLICE_KEYS, PROBES = 32_768, 1_500, 6

_FILTER = "bucket int, slice int, bits binary, batch_id long, slices int, total long"


class Filter(NamedTuple):
    """Bitmaps of all keys up to a batch, the slices of a bucket, and the number of keys."""

    bits: DataFrame
    slices: int
    total: int


class UsedKeys:
    """The keys used by the batches of one target."""

    def __init__(self, spark: SparkSession, target: str, key: str, key_type: DataType):
        self.spark, self.target, self.key = spark, target, key
        self.type = key_type.simpleString()
        self.schema = StructType([StructField(key, key_type)])
        self.used_dir, self.filter_dir = f"{target}/_keys/used", f"{target}/_keys/filters"
        self.known: dict[int, Filter | None] = {}

    # --- reading -------------------------------------------------------------

    def unseen(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """Rows whose key no earlier batch has used.  ``rows`` should be written: its keys are
        read twice, and one small job runs here."""
        known = self._filter_before(batch_id)
        if known is None:
            return rows
        suspects = self._suspects(rows.select(quoted(self.key)).distinct(), known)
        suspects = written(suspects, staging_dir(self.spark, "suspects"))
        hit = suspects.select("bucket").distinct().take(BUCKETS)
        if not hit:
            return rows
        found = self.opened(batch_id, [r["bucket"] for r in hit]).select(quoted(self.key))
        used = rows_with_keys(found, self.key, suspects.select(quoted(self.key)))
        return rows.join(
            used.toDF("_used"), F.expr(f"{quoted(self.key)} <=> _used"), "left_anti"
        )

    def opened(self, batch_id: int, buckets: list[int]) -> DataFrame:
        """Keys of earlier batches in these buckets; no other folder is read."""
        schema = StructType([*self.schema.fields]).add("batch_id", "long").add("bucket", "integer")
        stored = self.spark.read.schema(schema).parquet(self.used_dir)
        return stored.filter(F.col("bucket").isin(buckets) & (F.col("batch_id") < batch_id))

    def _suspects(self, keys: DataFrame, known: Filter) -> DataFrame:
        """Keys that may have been used, with their bucket."""
        placed, bits = self._placed(keys, known.slices), known.bits
        # 4 KB a slice; a filter that is too large to send is shuffled once, a slice a row.
        if BUCKETS * known.slices * SLICE_BITS // 8 <= BROADCAST_BYTES:
            bits = F.broadcast(bits)
        every = " AND ".join(
            f"(shiftright(CAST(conv(hex(substring(bits, p[{k}] DIV 8 + 1, 1)), 16, 10) AS INT),"
            f" p[{k}] % 8) & 1) = 1"
            for k in range(PROBES)
        )
        found = placed.join(bits, ["bucket", "slice"])
        return found.filter(every).select(quoted(self.key), "bucket")

    def _placed(self, keys: DataFrame, slices: int) -> DataFrame:
        """``key, bucket, slice, p``: where the bits of a key are."""
        key, value = quoted(self.key), self._value()
        start, stride = (f"pmod(xxhash64({value}, {k}), {SLICE_BITS})" for k in (2, 3))
        places = ", ".join(
            f"CAST(pmod({start} + {k} * {stride}, {SLICE_BITS}) AS INT)" for k in range(PROBES)
        )
        return keys.selectExpr(
            key, f"{self._bucket()} AS bucket",
            f"CAST(pmod(xxhash64({value}, 1), {slices}) AS INT) AS slice", f"array({places}) AS p",
        )

    def _bucket(self) -> str:
        return f"CAST(pmod(xxhash64({self._value()}), {BUCKETS}) AS INT)"

    def _value(self) -> str:
        return hashed_value(self.key, self.type) or "0"

    # --- writing -------------------------------------------------------------

    def add(self, keys: DataFrame, batch_id: int) -> None:
        """Record the keys of a batch, in place of what an earlier try has left."""
        known = self._filter_before(batch_id)
        keys = keys.select(quoted(self.key))
        self._store(keys, f"{self.used_dir}/batch_id={batch_id}")
        total = keys.count() + (known.total if known else 0)
        slices = self._slices_for(total, known.slices if known else 1)
        if known and slices != known.slices:  # doubled: one pass over all used keys
            parts = self._bits(self.opened(batch_id + 1, list(range(BUCKETS))), slices)
        else:
            parts = self._bits(keys, slices)
            if known:
                parts = parts.unionByName(known.bits)
        self._write_filter(parts, batch_id, slices, total)

    def _slices_for(self, total: int, slices: int = 1) -> int:
        while total > BUCKETS * slices * SLICE_KEYS:
            slices *= 2
        return slices

    def _bits(self, keys: DataFrame, slices: int) -> DataFrame:
        placed = self._placed(keys.select(quoted(self.key)), slices)
        return (
            placed.selectExpr("bucket", "slice", "explode(p) AS p")
            .groupBy("bucket", "slice")
            .agg(F.expr("bitmap_construct_agg(CAST(p AS LONG))").alias("bits"))
        )

    def _write_filter(self, parts: DataFrame, batch_id: int, slices: int, total: int) -> None:
        whole = parts.groupBy("bucket", "slice").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))
        whole.selectExpr(
            "*", f"{batch_id}L AS batch_id", f"{slices} AS slices", f"{total}L AS total"
        ).write.mode("overwrite").parquet(f"{self.filter_dir}/slot={batch_id % 2}")

    def _store(self, keys: DataFrame, path: str) -> None:
        dealt = keys.selectExpr("*", f"{self._bucket()} AS bucket").hint("rebalance", "bucket")
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(path)

    # --- the filter as it was before a batch -----------------------------------

    def _filter_before(self, batch_id: int) -> Filter | None:
        """The filter of all batches before this one; None if there is no key."""
        if batch_id == 0:
            return None
        if batch_id not in self.known:
            stored = self._slot(batch_id - 1)
            if stored is None:
                self._rebuild(batch_id)
                stored = self._slot(batch_id - 1)
            self.known = {batch_id: stored}
        return self.known[batch_id]

    def _slot(self, batch_id: int) -> Filter | None:
        path = f"{self.filter_dir}/slot={batch_id % 2}"
        try:
            filters = self.spark.read.schema(_FILTER).parquet(path)
            filters = filters.filter(F.col("batch_id") == batch_id)
            first = filters.select("slices", "total").first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        if first is None:
            return None
        return Filter(filters.select("bucket", "slice", "bits"), first["slices"], first["total"])

    def _rebuild(self, batch_id: int) -> None:
        """Both tables anew from the target itself, for targets that came without them."""
        schema = StructType([*self.schema.fields]).add("batch_id", "long")
        history = self.spark.read.schema(schema).parquet(self.target)
        earlier = history.filter(F.col("batch_id") < batch_id)
        dealt = earlier.selectExpr("*", f"{self._bucket()} AS bucket")
        dealt.hint("rebalance", "bucket").write.mode("overwrite").partitionBy(
            "batch_id", "bucket"
        ).parquet(self.used_dir)
        total = earlier.count()
        if total:
            slices = self._slices_for(total)
            keys = self.opened(batch_id, list(range(BUCKETS)))
            self._write_filter(self._bits(keys, slices), batch_id - 1, slices, total)

"""A Bloom filter of 64-bit keys, to pass by rows that a join cannot meet.

Built on the executors, segment by segment, from a column of keys; about 16
bits a key (some 0.1 % of other keys pass), never more than ``MOST_BITS``, so
what is broadcast is bounded at any size.  It never rejects a key that it
holds; a fuller filter only lets more rows through, and the exact join that
follows decides.

Defined cases: null keys pass; without keys nothing but nulls passes; repeated
keys count once; columns other than the key's are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vhist.llm.common import batches

BITS_A_KEY = 16
MOST_BITS = 1 << 28  # 32 MB
HASHES = 4
SEGMENT = 1 << 15  # bits made by one group

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _stirred(h: np.ndarray, by: np.uint64) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * by
    return h ^ (h >> np.uint64(29))


def places(keys: np.ndarray, bits: int) -> np.ndarray:
    """HASHES x keys bit places."""
    k = keys.astype(np.int64).view(np.uint64)
    first, step = _stirred(k, _A), _stirred(k, _B) | np.uint64(1)
    return np.stack([((first + np.uint64(n) * step) >> np.uint64(7)) & np.uint64(bits - 1) for n in range(HASHES)]).astype(np.int64)


class Sieve:
    """The bits, broadcast; ``passing`` and ``rest`` part a frame by them."""

    def __init__(self, keys: DataFrame, col: str):
        bits = SEGMENT
        count = keys.count()
        while bits < min(BITS_A_KEY * count, MOST_BITS):
            bits *= 2

        def cut(rows):
            for (ks,) in batches(rows, "k"):
                at = places(np.array([k for k in ks if k is not None], np.int64), bits).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(at // SEGMENT, pa.int32()), pa.array(at % SEGMENT, pa.int32())], names=["segment", "at"])

        def pack(rows):
            for segments, lists in batches(rows, "segment", "at", at_once=64):
                out = []
                for at in lists:
                    one = np.zeros(SEGMENT, bool)
                    one[at] = True
                    out.append(np.packbits(one).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(segments, pa.int32()), pa.array(out, pa.binary())], names=["segment", "packed"])

        places_ = keys.select(keys[col].cast("long").alias("k")).mapInArrow(cut, "segment int, at int")
        packed = places_.groupBy("segment").agg(F.collect_set("at").alias("at")).mapInArrow(pack, "segment int, packed binary")
        held = np.zeros(bits // 8, np.uint8)
        for r in packed.collect():  # MOST_BITS at most
            held[r.segment * SEGMENT // 8 : (r.segment + 1) * SEGMENT // 8] = np.frombuffer(bytes(r.packed), np.uint8)
        self.bits = bits
        self.sent = keys.sparkSession.sparkContext.broadcast(held)

    def _part(self, df: DataFrame, col: str, passing: bool) -> DataFrame:
        bits, sent = self.bits, self.sent

        def run(rows):
            for batch in rows:
                keys = batch.column(batch.schema.get_field_index(col))
                at = places(pc.fill_null(keys, 0).to_numpy(zero_copy_only=False), bits)
                may = ((sent.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=0)
                may |= keys.is_null().to_numpy(zero_copy_only=False)
                yield batch.filter(pa.array(may if passing else ~may))

        return df.mapInArrow(run, df.schema)

    def passing(self, df: DataFrame, col: str) -> DataFrame:
        """Rows whose long ``col`` may be among the keys."""
        return self._part(df, col, True)

    def rest(self, df: DataFrame, col: str) -> DataFrame:
        """Rows whose ``col`` is certainly not."""
        return self._part(df, col, False)

"""A reproducible shuffle of all rows into shards, computed from the row's number.

Rows are numbered in a total order. A Feistel network permutes the numbers ``0 .. n - 1``: it
works on a rectangle of ``a * b >= n`` cells that is hardly larger than ``n``, adding a keyed
function of one coordinate to the other, in turn. A number that falls outside ``n`` walks on
along its cycle until it is inside again, so the result is a permutation of ``n``. Place ``p``
is slot ``p // shards`` of shard ``p % shards``: shard sizes differ by one row at most and slots
have no gaps. Every step can be undone, so shard and slot give the number back (``row_at``).

Rows that are equal in everything the order looks at may take each other's place. The order
ends in the row's place in the input to spread many equal rows over the range sort. A null
id sorts first, a null text is empty, no rows give no rows. Equal texts are rows of their own.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emiscope.operators.ranking import global_index
from emiscope.session import write_through

SHARDS = 40
SEED = 20_260_801
ROUNDS = 6
ROW_BYTES = 16
#: Modulus of the round function. Products of two residues fit in 63 bits.
PRIME = (1 << 31) - 1


def round_keys(seed: int) -> list[tuple[int, int, int]]:
    """Three non-zero residues per round."""

    def key(k: int, part: int) -> int:
        digest = hashlib.sha256(f"{seed}:{k}:{part}".encode()).digest()
        return int.from_bytes(digest[:8], "little") % (PRIME - 1) + 1

    return [(key(k, 0), key(k, 1), key(k, 2)) for k in range(ROUNDS)]


def sides(n: int) -> tuple[int, int]:
    """The rectangle's sides, ``a`` the square root rounded up."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def _mixed(values: np.ndarray, keys: tuple[int, int, int]) -> np.ndarray:
    t = (values % PRIME * keys[0] + keys[1]) % PRIME
    t = t * t % PRIME * t % PRIME
    return (t * keys[2] + values) % PRIME


def _once(places: np.ndarray, n: int, keys: list, back: bool) -> np.ndarray:
    a, b = sides(n)
    left, right = places // b, places % b
    order = range(ROUNDS)
    for k in reversed(order) if back else order:
        sign = -1 if back else 1
        if k % 2 == 0:
            left = (left + sign * _mixed(right, keys[k])) % a
        else:
            right = (right + sign * _mixed(left, keys[k])) % b
    return left * b + right


def permuted(numbers: np.ndarray, n: int, seed: int = SEED, back: bool = False) -> np.ndarray:
    """Places of row numbers below ``n``; with ``back`` the row numbers of places."""
    keys = round_keys(seed)
    places = _once(np.asarray(numbers, np.int64), n, keys, back)
    outside = np.flatnonzero(places >= n)
    while len(outside):
        places[outside] = _once(places[outside], n, keys, back)
        outside = outside[places[outside] >= n]
    return places


def place_of(number: int, n: int, shards: int = SHARDS, seed: int = SEED) -> tuple[int, int]:
    """Shard and slot of one row number among ``n`` rows."""
    place = int(permuted(np.array([number]), n, seed)[0])
    return place % shards, place // shards


def row_at(shard: int, slot: int, n: int, shards: int = SHARDS, seed: int = SEED) -> int:
    """The row number that stands in a slot of a shard."""
    return int(permuted(np.array([slot * shards + shard]), n, seed, back=True)[0])


def shuffle_rows(rows: DataFrame, order: Sequence[Column], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``rows`` with ``shard`` and ``slot`` (columns of these names are replaced).

    The numbers follow ``order``, whatever the partitions of ``rows``. It should tell apart all
    rows that are not to be taken for each other.
    """
    kept = [c for c in rows.columns if c not in ("shard", "slot")]
    packed = rows.select(F.struct(*kept).alias("row"), F.struct(*order).alias("sort"), F.monotonically_increasing_id().alias("tie"))
    numbered = write_through(global_index(packed, [F.col("sort"), F.col("tie")], "number").select("row", "number"), "numbered")
    n = numbered.count()

    @F.pandas_udf("long")
    def place(numbers: pd.Series) -> pd.Series:
        return pd.Series(permuted(numbers.to_numpy(), n, seed))

    placed = numbered.withColumn("place", place("number"))
    return placed.select("row.*", (F.col("place") % shards).cast("int").alias("shard"), F.floor(F.col("place") / shards).alias("slot"))


def document_keys(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32`` of each document, and a hash that tells more texts apart."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Shard and slot of each document under the law ``rows``; only ids, sizes and hashes move."""
    order = [F.col(c) for c in ("doc_id", "text_crc32", "size", "text_hash")]
    return shuffle_rows(document_keys(docs), order, shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def write_shards(placed: DataFrame, path: str) -> None:
    """Rows with ``shard`` and ``slot`` as Parquet below ``shard=``, each file in the order of its slots."""
    dealt = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    dealt.write.partitionBy("shard").parquet(path)

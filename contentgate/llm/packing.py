"""Best-fit packing of token sequences by the sum-of-squares rule."""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentgate.llm.common import save, small_batches
from contentgate.llm.tokens import word_encoder

PER_SHARD = 4096
ROUNDS = 8
WORTH = 100


def cut_pieces(docs: DataFrame, file: str, size: int, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every whole text plus `end_id`, cut into pieces of at most `size` ids; one row per piece.

    `_deal` is a number of the row that stays with it once the table is saved.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        encode, end = word_encoder(file), end_id.to_bytes(4, "little")
        for batch in batches:
            rows, piece, start, length, crc = [], [], [], [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                ids = encode(text or "") + end
                for p, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at:at + 4 * size]
                    rows.append(k)
                    piece.append(p)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=[id_col, "piece", "start", "length", "ids_crc32"])

    schema = f"`{id_col}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return small_batches(docs).select(F.col(id_col), F.col(text_col).cast("string").alias("_text")).mapInArrow(run, schema).withColumn(
        "_deal", F.monotonically_increasing_id())


def sum_of_squares(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every item, and the fill of every bin.

    Items are placed longest first, each where the sum over gaps g of (open bins with gap g) squared becomes
    smallest: moving a bin from gap g to g - x changes the sum by 2 (N[g - x] - N[g]) + 2, a new bin by
    2 N[size - x] + 1; full bins do not count. Among equal sums the tightest gap wins.
    """
    count = np.zeros(size + 1, dtype=np.int64)
    stacks: list[list[int]] = [[] for _ in range(size + 1)]
    fill: list[int] = []
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    for k in np.argsort(-lengths, kind="stable"):
        x = int(lengths[k])
        change = 2 * (count[: size + 1 - x] - count[x:]) + 2  # at gap x + i; a full bin has gap 0 and weight 0
        change[0] = 1 - 2 * count[x]
        change[count[x:] == 0] = np.iinfo(np.int64).max
        i = int(change.argmin())
        fresh = 1 if x == size else 2 * int(count[size - x]) + 1
        if i == size - x or change[i] > fresh:
            b, gap = len(fill), size
            fill.append(0)
        else:
            gap = x + i
            b = stacks[gap].pop()
            count[gap] -= 1
        bins[k], offsets[k] = b, fill[b]
        fill[b] += x
        if gap > x:
            stacks[gap - x].append(b)
            count[gap - x] += 1
    return bins, offsets, np.array(fill, dtype=np.int64)


def pack(pieces: DataFrame, size: int, per_shard: int = PER_SHARD) -> DataFrame:
    """Give every row of `pieces` (column length, 1 to `size`) a sequence_id and an offset in it.

    Rows are dealt into shards of about `per_shard` pieces by a saved number, whatever their ids, and each shard is
    packed by one task: memory is bounded and repeated ids do not matter. Sequences with room left are then opened again:
    whole sequences are dealt anew into shards, so that open ones of different shards meet, and a shard that can hold its pieces
    in fewer sequences does. Rounds go on until one shard has seen all open sequences, a round saves less than one in
    `WORTH` of those that it opened, or `ROUNDS` are over. No round makes more sequences than there were.
    """
    pieces = save(pieces)
    columns = pieces.columns
    schema = ", ".join([*(f"`{c}` {t}" for c, t in pieces.dtypes), "sequence_id bigint, offset bigint, _fill bigint"])
    rest = pieces.withColumns({"sequence_id": F.lit(None).cast("bigint"), "offset": F.lit(None).cast("bigint"), "_fill": F.lit(None).cast("bigint")})
    done: list[DataFrame] = []
    count, opened = pieces.count(), 0
    while True:
        number, shards = len(done), max(1, -(-count // per_shard))

        def one(frame: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values("_deal", ignore_index=True)
            shard = int(frame["_shard"].iloc[0])
            frame = frame.drop(columns="_shard")
            bins, offsets, fill = sum_of_squares(frame["length"].to_numpy(), size)
            if number and len(fill) >= frame["sequence_id"].nunique():
                return frame
            return frame.assign(sequence_id=(number << 56) + (shard << 24) + bins, offset=offsets, _fill=fill[bins])

        dealt = rest.withColumn("_shard", F.pmod(F.xxhash64("sequence_id" if number else "_deal", F.lit(number)), F.lit(shards)))
        packed = save(dealt.groupBy("_shard").applyInPandas(one, schema))
        open_, first = F.col("_fill") < size, F.col("offset") == 0
        count, left, now = packed.agg(F.count_if(open_), F.count_if(open_ & first), F.count_if(first)).first()
        if shards == 1 or not count or number == ROUNDS or number and (opened - now) * WORTH < opened:
            break
        done.append(packed.filter(~open_))
        rest, opened = packed.filter(open_), left
    return reduce(DataFrame.unionByName, [*done, packed]).select(*[c for c in columns if c != "_deal"], "sequence_id", "offset")


def pack_documents(docs: DataFrame, file: str, size: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents into sequences of at most `size` tokens. `file`: content of a word tokenizer file.

    Returns per piece: id, piece, start, length, ids_crc32, sequence_id, offset. A null or empty text is one piece
    that holds the end id alone. Null and repeated ids are packed as rows of their own.
    """
    return pack(cut_pieces(docs, file, size, 0, id_col, text_col), size)

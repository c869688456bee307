"""Best-fit packing of token pieces into sequences, improved by swaps between underfull bins."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import documents, stored
from tidemart.llm.tokens import Encoder, vocabulary_path

CAPACITY, END_ID = 1024, 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID,
                 vocabulary: str | None = None) -> DataFrame:
    """Pieces of every document's ids plus `end_id`; a null text is empty, so it has one piece of one id.

    Documents of at most `capacity` ids stay whole. Longer ones are cut into pieces of exactly `capacity`,
    the first one takes what is left over. Whole texts are encoded, however long. A null doc_id stays null,
    repeated rows give their pieces again, an empty table gives none; other columns are left out.
    """
    path = vocabulary or vocabulary_path()
    end = int(end_id).to_bytes(4, "little")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = encoder.encode(text) + end
                stop = (len(ids) // 4 - 1) % capacity + 1
                start = piece = 0
                while start * 4 < len(ids):
                    part = ids[start * 4:stop * 4]
                    rows.append((doc_id, piece, start, stop - start, zlib.crc32(part)))
                    start, stop, piece = stop, stop + capacity, piece + 1
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInPandas(cut, PIECES)


class _Bins:
    """Open bins by room left; rooms with a bin are bits of one number, so best fit is a bit scan."""

    def __init__(self, capacity: int):
        self.capacity, self.by_room, self.mask = capacity, [[] for _ in range(capacity + 1)], 0

    def put(self, bin_id: int, room: int) -> None:
        self.by_room[room].append(bin_id)
        self.mask |= 1 << room

    def take(self, length: int) -> tuple[int, int] | None:
        """A bin with the least room that is enough, and its room."""
        fitting = self.mask >> length
        if not fitting:
            return None
        room = length + (fitting & -fitting).bit_length() - 1
        bin_id = self.by_room[room].pop()
        if not self.by_room[room]:
            self.mask &= ~(1 << room)
        return bin_id, room


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit decreasing: item numbers per bin."""
    open_bins, bins = _Bins(capacity), []
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        found = open_bins.take(length)
        if found is None:
            found = len(bins), capacity
            bins.append([])
        bins[found[0]].append(item)
        if found[1] > length:
            open_bins.put(found[0], found[1] - length)
    return bins


def improve(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Local search over underfull bins until no exchange helps or a bin is emptied for good.

    The emptiest underfull bin gives: for each of the other underfull bins, fullest first, the
    search looks for the exchange that raises its fill most: one document moved in, one swapped for a longer
    one, or one swapped for two that are longer together. Moving length from an emptier to a fuller bin
    raises the sum of squared fills, so the search ends; a bin that gave everything is gone.
    """
    size = lengths.tolist()
    fill = [sum(size[i] for i in b) for b in bins]
    # Underfull bins, emptiest first.
    under = sorted((fill[b], b) for b in range(len(bins)) if fill[b] < capacity)
    while len(under) > 1:
        _, giver = under.pop(0)
        own = sorted((size[i], i) for i in bins[giver])
        done = False
        for at in range(len(under) - 1, -1, -1):
            if not own:
                break
            was, taker = under[at]
            now = was
            while own and now < capacity:
                gain, out, into = _best_exchange(own, bins[taker], size, capacity - now)
                if gain <= 0 or now + gain > capacity or now < sum(s for s, _ in own) - gain:
                    break
                for i in into:
                    own.remove((size[i], i))
                    bins[taker].append(i)
                if out is not None:
                    bins[taker].remove(out)
                    insort(own, (size[out], out))
                now += gain
            if now != was:
                done = True
                fill[taker] = now
                under.pop(at)
                if now < capacity:
                    insort(under, (now, taker))
        bins[giver] = [i for _, i in own]
        fill[giver] = sum(s for s, _ in own)
        if own and not done:
            break  # the emptiest bin can give nothing away
        if own:
            # It is the emptiest still; what it holds may fit the bins' changed rooms.
            under.insert(bisect_left(under, (fill[giver], giver)), (fill[giver], giver))
    return [b for b in bins if b]


def _best_exchange(own: list[tuple[int, int]], bin_items: list[int], size: list[int],
                   room: int) -> tuple[int, int | None, list[int]]:
    """(gain, item to give back or None, items to take in) with the largest gain that fits the room."""
    best: tuple[int, int | None, list[int]] = (0, None, [])
    for out in [None, *bin_items]:
        limit = room + (size[out] if out is not None else 0)
        base = size[out] if out is not None else 0
        at = bisect_left(own, (limit + 1, -1)) - 1
        if at >= 0 and own[at][0] - base > best[0]:
            best = (own[at][0] - base, out, [own[at][1]])
        low, high = 0, len(own) - 1
        while low < high and best[0] < room:  # two of them, by the two-pointer walk
            both = own[low][0] + own[high][0]
            if both > limit:
                high -= 1
                continue
            if both - base > best[0]:
                best = (both - base, out, [own[low][1], own[high][1]])
            low += 1
        if best[0] == room:
            break
    return best


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = 4096,
         rounds: int = 2, settled: float = 0.97) -> DataFrame:
    """Adds sequence_id and offset to pieces (columns of `PIECES`), no sequence above `capacity`.

    Pieces are dealt evenly over groups of about `group_rows`; each group is packed best-fit
    decreasing and improved by the local search. Sequences filled to `settled` stay; the pieces
    of the others of all groups are dealt and packed once more per further round, so what a group wastes does not
    add up over groups. A piece's place depends on the deal alone, which is kept in storage. Repeated
    rows are pieces of their own; no piece, no sequence.
    """

    def packer(number: int):
        def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values(["length", "doc_id", "piece", "start", "ids_crc32"],
                                      ascending=[False, True, True, True, True], kind="stable")
            lengths = group["length"].to_numpy()
            bins = improve(best_fit(lengths, capacity), lengths, capacity)
            sequence = np.empty(len(group), "int64")
            offset = np.empty(len(group), "int64")
            filled = np.empty(len(group), "int64")
            for b, items in enumerate(bins):
                ends = np.cumsum(lengths[items])
                sequence[items] = ((number * (1 << 40) + int(key[0])) << 16) + b
                offset[items] = ends - lengths[items]
                filled[items] = ends[-1]
            return group.drop(columns="deal").assign(sequence_id=sequence, offset=offset, filled=filled)

        return run

    result = f"{PIECES}, sequence_id long, offset long, filled long"
    rest, fixed = stored(pieces, "pieces"), []
    for number in range(rounds):
        groups = max(1, -(-rest.count() // group_rows))
        dealt = rest.withColumn("deal", F.pmod(
            F.shiftright(F.monotonically_increasing_id(), 33) * 7919
            + F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)), F.lit(groups)))
        packed = stored(dealt.groupBy("deal").applyInPandas(packer(number), result), "packed")
        if number + 1 == rounds:
            fixed.append(packed)
            break
        full = F.col("filled") >= int(settled * capacity)
        fixed.append(packed.filter(full))
        rest = stored(packed.filter(~full).drop("sequence_id", "offset", "filled"), "pieces")
    out = fixed[0]
    for more in fixed[1:]:
        out = out.unionByName(more)
    return out.drop("filled")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    return pack(token_pieces(docs, capacity), capacity)


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(documents(spark, folder, "doc_id", "text"))

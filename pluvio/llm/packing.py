"""Packing of documents into sequences of a fixed number of tokens by best fit and swap-based local search.

Documents are tokenized where they lie; only pieces (ids, lengths, checksums) go on. Pieces are dealt evenly into groups that
one task packs: best fit in decreasing order, then local search that moves documents and exchanges them one for one, two for
one or one for two between underfull sequences, always raising the sum of squared fills, until the emptiest sequences are
empty or nothing helps. What lies in sequences that stay underfull is dealt anew with that of the other groups, in ever fewer
groups, until there is one group or a round closes less than a share (`least_closed`) of its pieces. Nothing is dropped and no document but those longer than a sequence is cut.

Null or empty texts are the end id alone. Repeated rows are packed each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.llm.common import INTERNAL, batches, crc, pack_ids, strings, table
from pluvio.llm.tokens import encoder, path_of
from pluvio.session import stage

OPEN = INTERNAL + "open"
CAPACITY = 2048
END_ID = 0
#: Pieces one task packs.
GROUP = 40_000
#: Sequences with more room than this are opened again in the next round.
SLACK = 16
#: Rounds end when one closes the sequences of a smaller share of its pieces: sequences of such lengths do not fill.
LEAST_CLOSED = 0.05


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's parts of at most capacity ids."""

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        end = np.array([end_id], np.uint32)
        for part in parts:
            rows: tuple[list, ...] = ([], [], [], [], [])
            names = part.column(0).to_pylist()
            for doc_id, own in zip(names, enc.encode(strings(part.column(1))), strict=True):
                own = np.concatenate([own, end])
                for k, start in enumerate(range(0, len(own), capacity)):
                    some = own[start:start + capacity]
                    for column, value in zip(rows, (doc_id, k, start, len(some), crc(pack_ids(some))), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int32()), *(pa.array(c, pa.int64()) for c in rows[2:])],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), cut,
                   "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Best fit in decreasing order. A bit per amount of room tells which amounts some sequence has."""
    bins: list[list[int]] = []
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    have = 0
    for item in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[item])
        fits = have >> need
        if fits:
            room = need + (fits & -fits).bit_length() - 1
            where = rooms[room].pop()
            if not rooms[room]:
                have &= ~(1 << room)
            bins[where].append(item)
        else:
            room, where = capacity, len(bins)
            bins.append([item])
        left = room - need
        if left:
            rooms[left].append(where)
            have |= 1 << left
    return bins


def improve(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Local search over the underfull sequences.

    The emptiest sequence gives: it moves a document to a fuller one, or exchanges documents so that the fuller one gains and it
    loses. When nothing can be taken from it, the next one gives; rounds follow until no sequence can give. Every step raises the sum of
    squared fills, so the search ends.
    """
    size = lengths.tolist()
    under = [b for b in bins if sum(size[i] for i in b) < capacity]
    full = [b for b in bins if sum(size[i] for i in b) >= capacity]
    if len(under) < 2:
        return bins
    item = np.array([i for b in under for i in b], np.int64)
    home = np.array([k for k, b in enumerate(under) for _ in b], np.int64)
    length = lengths[item]
    fill = np.bincount(home, length, len(under)).astype(np.int64)
    moved = True
    while moved:
        moved = False
        for giver in np.argsort(fill, kind="stable").tolist():
            while 0 < fill[giver] < capacity:
                mine = np.flatnonzero(home == giver)
                room = capacity - fill
                room[fill < fill[giver]] = 0
                room[giver] = 0
                if not room.any():
                    break
                best = _best_step(mine, length, home, room, giver)
                if best is None:
                    break
                out, back, target = best
                gain = int(length[out].sum() - length[back].sum())
                home[out] = target
                home[back] = giver
                fill[target] += gain
                fill[giver] -= gain
                moved = True
    kept: list[list[int]] = [[] for _ in under]
    for k, where in zip(item.tolist(), home.tolist(), strict=True):
        kept[where].append(k)
    return full + [b for b in kept if b]


def _best_step(mine, length, home, room, giver):
    """(documents out, documents back, receiver) that moves most tokens out of the giver, or None."""
    most = int(room.max())
    moved = mine[length[mine] <= most]
    best, gain = None, 0
    if len(moved):
        one = moved[length[moved].argmax()]
        fitting = np.flatnonzero(room >= length[one])
        best, gain = ([one], [], int(fitting[room[fitting].argmin()])), int(length[one])
        if gain == most:
            return best
    theirs = np.flatnonzero(room[home] > 0)
    theirs = theirs[home[theirs] != giver]
    if not len(theirs):
        return best
    space = room[home[theirs]]
    want = length[theirs]
    # One for one, and two of mine for one of theirs: the largest of mine that is at most its length and its room.
    singles = mine[np.argsort(length[mine], kind="stable")]
    options = [(length[singles], [[k] for k in singles]), _pairs(singles, length)]
    for sums, names in (x for x in options if len(x[0])):
        at = np.searchsorted(sums, want + space, side="right") - 1
        got = np.where(at >= 0, sums[np.maximum(at, 0)] - want, 0)
        k = int(got.argmax())
        if got[k] > gain:
            best, gain = (list(names[at[k]]), [int(theirs[k])], int(home[theirs[k]])), int(got[k])
    # One of mine for two of theirs: pairs of neighbours at every distance among the receivers' lengths, two of each length at most.
    order = theirs[np.lexsort((length[theirs], home[theirs]))]
    order = order[room[home[order]] > gain]
    same = (home[order[2:]] == home[order[:-2]]) & (length[order[2:]] == length[order[:-2]])
    order = order[np.concatenate([np.ones(min(2, len(order)), bool), ~same])]
    longest = int(length[singles[-1]])
    for gap in range(1, len(order)):
        one, two = order[:-gap], order[gap:]
        pair = home[one] == home[two]
        if not pair.any():
            break
        one, two = one[pair], two[pair]
        sums = length[one] + length[two]
        able = sums < longest
        one, two, sums = one[able], two[able], sums[able]
        if len(sums):
            at = np.searchsorted(length[singles], sums + room[home[one]], side="right") - 1
            got = np.where(at >= 0, length[singles[np.maximum(at, 0)]] - sums, 0)
            k = int(got.argmax())
            if got[k] > gain:
                best, gain = ([int(singles[at[k]])], [int(one[k]), int(two[k])], int(home[one[k]])), int(got[k])
    return best


def _pairs(items: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The lengths of pairs of the items (ascending by length), ascending, and a pair of each two lengths.

    A sequence holds few distinct lengths (at most 63 in 2,048 tokens), so the pairs of lengths are few as well.
    """
    own = length[items]
    start = np.flatnonzero(np.diff(own, prepend=-1))
    second = np.where(np.diff(start, append=len(items)) > 1, start + 1, -1)
    i, j = np.triu_indices(len(start))
    other = np.where(i == j, second[i], start[j])
    i, other = start[i][other >= 0], other[other >= 0]
    both = own[i] + own[other]
    order = np.argsort(both, kind="stable")
    return both[order], list(zip(items[i][order].tolist(), items[other][order].tolist(), strict=True))


def pack(rows: DataFrame, capacity: int = CAPACITY, group: int = GROUP, slack: int = SLACK, least_closed: float = LEAST_CLOSED) -> DataFrame:
    """rows (with length, at most capacity) with sequence_id and offset."""
    rows = rows.select(*[c for c in rows.columns if c not in ("sequence_id", "offset")])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    names = rows.columns
    done: DataFrame | None = None
    left, count, turn = rows, rows.count(), 0
    while done is None or count:
        groups = -(-count // group) or 1

        def packed(parts: Iterator[pa.RecordBatch], turn: int = turn, last: bool = groups == 1) -> Iterator[pa.RecordBatch]:
            held = [p for p in parts if p.num_rows]
            if not held:
                return
            mine = pa.Table.from_batches(held).combine_chunks()
            lengths = mine.column("length").to_numpy().astype(np.int64)
            bins = improve(best_fit(lengths, capacity), lengths, capacity)
            base = (turn << 52) + (TaskContext.get().partitionId() << 24)
            order, sequence, offset, open_ = [], [], [], []
            for k, b in enumerate(bins):
                fill = 0
                for i in b:
                    order.append(i)
                    sequence.append(base + k)
                    offset.append(fill)
                    fill += int(lengths[i])
                open_ += [not last and capacity - fill > slack] * len(b)
            out = mine.take(pa.array(order)).append_column("sequence_id", pa.array(sequence, pa.int64()))
            out = out.append_column("offset", pa.array(offset, pa.int64())).append_column(OPEN, pa.array(open_, pa.bool_()))
            yield from out.to_batches(max_chunksize=10_000)

        dealt = left.repartition(groups)
        made = stage(batches(dealt, packed, f"{fields}, sequence_id long, offset long, {OPEN} boolean"), "packed")
        closed = made.where(~F.col(OPEN)).drop(OPEN)
        left = made.where(OPEN).select(*names)
        now = left.count()
        if now and (groups == 1 or count - now < least_closed * count):
            closed, now = made.drop(OPEN), 0
        done = closed if done is None else done.unionByName(closed)
        count, turn = now, turn + 1
    return done


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = stage(pieces(table(spark, sf_dir, "documents"), path_of("word_bpe_49k.json")), "pieces")
    return pack(cut).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")

"""Packing token sequences by bin completion.

Pieces of one length are interchangeable, so the packing problem of any table
is its histogram of lengths: at most ``capacity`` counts, whatever the number
of documents.  The search runs on that histogram: it takes the largest length
left, enumerates undominated fillings of the space beside it, the likely ones
first and then all, and applies one as often as the counts allow, later also
once; branches are pruned by the waste they already have against the best
packing known, and best-fit decreasing is the first incumbent.  Spark tokenises, counts, numbers the pieces within their length
and lays them out."""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, text_of
from .tokens import tokenizer_encode, vocabulary_path

Pattern = tuple[int, ...]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    return max(-(-sum(l * n for l, n in counts.items()) // capacity),
               sum(n for l, n in counts.items() if 2 * l > capacity))


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing on a histogram: bins of equal contents move together."""
    bins: dict[Pattern, int] = defaultdict(int)
    by_room: dict[int, set[Pattern]] = defaultdict(set)

    def add(p: Pattern, n: int) -> None:
        bins[p] += n
        by_room[capacity - sum(p)].add(p)

    for length in sorted(counts, reverse=True):
        left = counts[length]
        rooms = sorted(r for r, ps in by_room.items() if r >= length and ps)
        for room in rooms:
            each = room // length
            for p in sorted(by_room[room]):
                take = min(bins[p], left // each)
                if take:
                    bins[p] -= take
                    add(p + (length,) * each, take)
                    left -= take * each
                if left and left < each and bins[p]:
                    bins[p] -= 1
                    add(p + (length,) * left, 1)
                    left = 0
                if not bins[p]:
                    by_room[room].discard(p)
                    bins.pop(p)
                if not left:
                    break
            if not left:
                break
        each = capacity // length
        if left >= each:
            add((length,) * each, left // each)
        if left % each:
            add((length,) * (left % each), 1)
    return [(p, n) for p, n in bins.items() if n]


def likely_fillings(counts: np.ndarray, room: int, width: int = 4) -> list[Pattern]:
    """A few good sets of lengths for ``room``, least waste first.

    One length is dominated by a larger single one and two by a pair of a larger
    sum with the same larger member, so only the largest fit beside each choice is
    looked at; sets of more than three members begin with the largest that fit."""
    have = np.flatnonzero(counts[:room + 1])
    if not len(have):
        return [()]
    largest = int(have[-1])
    if room > 3 * largest:                            # far from full: start with the largest
        n = min(int(counts[largest]), room // largest - 2)
        counts[largest] -= n
        rest = likely_fillings(counts, room - n * largest, width)
        counts[largest] += n
        return [(largest,) * n + p for p in rest]
    fit = np.full(room + 1, -1, np.int64)             # largest length <= index
    fit[have] = have
    fit = np.maximum.accumulate(fit)
    out: list[tuple[int, Pattern]] = [(room - largest, (largest,))]
    if largest < room:
        out += _pairs(counts, have, fit, room, ())[:width]
        if min(out)[0] > 0:
            for x in have[::-1][:64].tolist():
                if x < room:
                    counts[x] -= 1
                    ok = have[counts[have] > 0]
                    if len(ok):
                        f = np.full(room + 1, -1, np.int64)
                        f[ok] = ok
                        out += _pairs(counts, ok, np.maximum.accumulate(f), room - x, (x,))[:1]
                    counts[x] += 1
                    if min(out)[0] == 0:
                        break
    best: dict[Pattern, int] = {}
    for waste, p in sorted(out, key=lambda o: (o[0], len(o[1]), tuple(-x for x in o[1]))):
        best.setdefault(tuple(sorted(p, reverse=True)), waste)
    return list(best)[:width]


def _pairs(counts: np.ndarray, have: np.ndarray, fit: np.ndarray, room: int,
           head: Pattern) -> list[tuple[int, Pattern]]:
    x = have[have < room]
    if not len(x):
        return []
    y = np.minimum(fit[room - x], x)                  # the larger member first
    y = np.where((y == x) & (counts[x] < 2), fit[np.minimum(room - x, x - 1)], y)
    ok = y > 0
    x, y = x[ok], y[ok]
    order = np.lexsort((-x, room - x - y))[:8]
    return [(int(room - x[k] - y[k]), (*head, int(x[k]), int(y[k]))) for k in order]


def all_fillings(counts: np.ndarray, room: int) -> Iterator[Pattern | None]:
    """Every undominated set of lengths for ``room``, depth-first with members in
    descending order; None for each dead end or dominated set met on the way.

    A set is dominated where an unused length still fits, or fits in place of one
    smaller member or of several whose sum is not larger.  Only sums that the
    lengths left can reach are followed."""
    have = np.flatnonzero(counts[:room + 1])[::-1].tolist()
    count = {l: int(counts[l]) for l in have}
    mask = (1 << (room + 1)) - 1
    reach = [1]                                       # bit s: the lengths from here on can sum to s
    for l in reversed(have):
        bits, n, step = reach[-1], min(count[l], room // l), 1
        while n:
            take = min(step, n)
            bits |= (bits << take * l) & mask
            n, step = n - take, 2 * step
        reach.append(bits)
    reach.reverse()

    def within(bits: int, low: int, high: int) -> bool:
        return bool(high >= low and bits >> low & ((1 << (high - low + 1)) - 1))

    def undominated(p: Pattern, waste: int) -> bool:
        used = Counter(p)
        one = many = 0                                # bit s: the sum of one member, of several
        for l in p:
            many |= (many | one) << l
            one |= 1 << l
        for x in have:
            if count[x] > used[x] and (x <= waste or within(many, max(1, x - waste), x)
                                       or within(one, max(1, x - waste), x - 1)):
                return False
        return True

    def sets(start: int, left: int, limit: int, above: int, head: Pattern) -> Iterator[Pattern | None]:
        # the waste must stay below limit; above is the smallest unused length so far
        met = False
        for j in range(max(start, bisect_left(have, -left, key=int.__neg__)), len(have)):
            l = have[j]
            if j > start:
                above = have[j - 1]
            bound = min(limit, above - l)
            if not within(reach[j], max(0, left - bound + 1), left):
                continue
            for c in range(min(count[l], left // l), 0, -1):
                met = True
                yield from sets(j + 1, left - c * l, bound, l if c < count[l] else above, head + (l,) * c)
        if left < limit and undominated(head, left):
            met = True
            yield head
        if not met:
            yield None
    return sets(0, room, room + 1, 2 * room + 2, ())


def complete_bins(histogram: dict[int, int], capacity: int, max_nodes: int = 20_000) -> list[tuple[Pattern, int]]:
    """Bins as ``(lengths, how often)``.

    Up to three searches of ``max_nodes`` bin choices each: over the likely
    fillings, over all undominated ones, and over all with each also applied just
    once, which leaves no packing out.  They end at the lower bound, or with the
    best packing found."""
    histogram = {l: n for l, n in histogram.items() if n}
    if not histogram:
        return []
    if min(histogram) < 1 or max(histogram) > capacity:
        raise ValueError("lengths must be between 1 and the capacity")
    best = best_fit(histogram, capacity)
    for everything, once in ((False, False), (True, False), (True, True)):
        best = _search(histogram, capacity, max_nodes, best, everything, once)
    return best


def _search(histogram: dict[int, int], capacity: int, max_nodes: int, best: list[tuple[Pattern, int]],
            everything: bool, once: bool) -> list[tuple[Pattern, int]]:
    bound = lower_bound(histogram, capacity)
    best_bins = sum(n for _, n in best)
    if best_bins <= bound:
        return best
    counts = np.zeros(capacity + 1, np.int64)
    for l, n in histogram.items():
        counts[l] = n
    tokens_left = int(sum(l * n for l, n in histogram.items()))
    used, chosen = 0, []                              # bins so far; (pattern, times)
    stack: list[Iterator[tuple[Pattern, int] | None]] = []
    nodes = 0

    def choices() -> Iterator[tuple[Pattern, int] | None]:
        top = int(np.flatnonzero(counts)[-1])
        counts[top] -= 1
        found = likely_fillings(counts, capacity - top)
        counts[top] += 1
        for p in found:
            yield (top, *p), often((top, *p))
        if not everything:
            return
        # backtracking has put the counts back to what they were
        beside = counts[:capacity - top + 1].copy()
        if top < len(beside):
            beside[top] -= 1
        for p in all_fillings(beside, capacity - top):
            yield ((top, *p), often((top, *p))) if p is not None and p not in found else None
        if once:
            for p in all_fillings(beside, capacity - top):
                yield ((top, *p), 1) if p is not None and often((top, *p)) > 1 else None

    def often(pattern: Pattern) -> int:
        return int(min(counts[l] // k for l, k in Counter(pattern).items()))

    stack.append(choices())
    while stack and best_bins > bound and nodes < max_nodes:
        step = next(stack[-1], ())
        if step == ():
            stack.pop()
            if chosen:
                pattern, times = chosen.pop()
                used -= times
                for l in pattern:
                    counts[l] += times
                    tokens_left += l * times
            continue
        nodes += 1
        if step is None:
            continue
        pattern, times = step
        if used + times + -(-(tokens_left - times * sum(pattern)) // capacity) >= best_bins:
            continue                                  # its waste already costs a bin too many
        for l in pattern:
            counts[l] -= times
            tokens_left -= l * times
        used += times
        chosen.append((pattern, times))
        if tokens_left == 0:
            best, best_bins = list(chosen), used
            stack.append(iter(()))
        else:
            stack.append(choices())
    return best


# --- Spark stages ---------------------------------------------------------------------------

def pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int = 0, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: the ids of each text and
    ``end_id``, cut when longer than ``capacity``; the first piece is then the
    shorter one.  The rank file holds the same vocabulary as the tokenizer
    file of that name and gives the same ids several times faster; the added
    tokens come from the tokenizer file."""
    def cut(batches):
        encode = tokenizer_encode(vocabulary)
        for batch in batches:
            row, out = [], []
            for k, text in enumerate(batch.column("text")):
                ids = np.array([*encode(text.as_py()), end_id], "<u4")
                at, piece = 0, 0
                while at < len(ids):
                    stop = at + (len(ids) - at) % capacity if at == 0 and len(ids) % capacity else at + capacity
                    row.append(k)
                    out.append((piece, at, stop - at, zlib.crc32(ids[at:stop].tobytes())))
                    at, piece = stop, piece + 1
            # ids stay Arrow values: a long column with a null must not pass through doubles
            columns = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row, pa.int64())),
                 *[pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.int64()))]],
                ["doc_id", "piece", "start", "length", "ids_crc32"])
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("text")).mapInArrow(
        cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def number_within_length(rows: DataFrame) -> DataFrame:
    """Adds ``rank``: 0, 1, ... among the rows of a length.  Lengths are dealt to
    salted groups, so one that a third of the rows share is not one group; the
    groups' offsets come from their counts."""
    salts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    sizes = dealt.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    own = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    return (dealt.withColumn("_k", F.row_number().over(own) - 1).join(offsets, ["length", "_salt"])
            .withColumn("rank", (F.col("_k") + F.col("_base")).cast("long")).drop("_salt", "_k", "_base"))


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = 2048, end_id: int = 0,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece with its ``sequence_id`` and ``offset``.

    Null text is empty (one id).  Texts of any length are encoded whole, runs of
    a million blanks included.  Repeated rows and null ids are packed like any
    others; an empty table gives an empty result; other columns are ignored."""
    vocabulary = vocabulary or vocabulary_path("byte_bpe_50k.tiktoken")
    rows = materialize(pieces(docs, vocabulary, capacity, end_id, id_col, text_col), "pack-pieces")
    histogram = {int(r["length"]): int(r["count"]) for r in rows.groupBy("length").count().collect()}  # <= capacity rows
    places = defaultdict(list)                        # length -> (first rank, first bin, offset)
    taken: dict[int, int] = defaultdict(int)
    bins = 0
    for pattern, times in complete_bins(histogram, capacity):
        at = 0
        for l in pattern:
            places[l].append((taken[l], bins, at))
            taken[l] += times
            at += l
        bins += times
    table = {l: np.array(v, np.int64).T for l, v in places.items()}

    def lay_out(batches):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            seq, off = np.empty(len(batch), np.int64), np.empty(len(batch), np.int64)
            for l in np.unique(length):
                rows_l = np.flatnonzero(length == l)
                first, bin0, at = table[int(l)]
                k = np.searchsorted(first, rank[rows_l], side="right") - 1
                seq[rows_l], off[rows_l] = bin0[k] + rank[rows_l] - first[k], at[k]
            kept = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), pa.array(seq), pa.array(off)],
                                             [*kept, "sequence_id", "offset"])
    kind = rows.schema["doc_id"].dataType.simpleString()
    numbered = number_within_length(rows).select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return numbered.mapInArrow(lay_out, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, "
                                         "sequence_id long, offset long")

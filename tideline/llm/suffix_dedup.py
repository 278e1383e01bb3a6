"""Removal of long repeated byte strings with a distributed sort of suffixes.

Every string of ``window`` bytes contains one *anchor*: the leftmost position
whose ``GRAM`` bytes hash lowest.  Equal strings have equal anchors, so it is
enough to sort the suffixes that start at anchors (about one in 85 bytes).
Steps:

1. Anchors whose gram occurs once cannot belong to a repeated string; a count
   by gram keeps the others.
2. Each part of the documents sorts its anchor suffixes (text from the anchor
   on, with the text before it as payload) into runs and writes them
   front-coded: a common-prefix length and the rest.
3. Each gram bucket combines its runs with a loser tree that carries the
   common-prefix lengths along and never compares known prefixes again.
4. In the merged order two strings at the same distance from their anchors are
   equal when they agree right of the anchor (a run of common-prefix lengths)
   and left of it; both are compared as bytes.  Results return to the documents
   under 128-bit BLAKE2b digests of the contexts.

A gram that occurs more than ``HOT_ITEMS`` times (a passage that a third of the
documents hold) would meet in one merge.  Its strings are counted instead, each
under its own digest: distinct ones per part, summed in Spark, so no task holds
the gram; the counts return to the parts that hold a repeated string.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import materialize, text_of
from .simhash import join_by_key

GRAM = 32
#: Text bytes of a part and item bytes of a gram bucket; both counts follow the data.
PART_BYTES = 8 << 20
#: Parts and gram buckets of one task, where there are more of them than the session has shuffle partitions.
PARTS_PER_TASK, BUCKETS_PER_TASK = 8, 16
#: Occurrences of a gram beyond which its strings are counted in Spark rather than merged in one task.
HOT_ITEMS = 1 << 16
#: Distinct strings of hot grams that a task collects before it hands them on.
FLUSH = 1 << 17
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the GRAM bytes at every position (uint8 in, len-GRAM+1 out)."""
    word = data.astype(np.uint64)
    for step in (1, 2, 4):
        word = word[:-step] | (word[step:] << np.uint64(8 * step))
    n = len(data) - GRAM + 1
    h = np.zeros(n, np.uint64)
    for k, c in enumerate(_MIX):
        part = word[8 * k:8 * k + n] * np.uint64(c)
        part ^= part >> np.uint64(29)
        h = (h ^ part) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h


def anchors(pieces: list[bytes], window: int) -> tuple[np.ndarray, ...]:
    """Anchors of all ``window``-byte strings inside each piece: piece index,
    position, gram hash, and the least and greatest distance of the anchor from
    the start of the strings that chose it."""
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    none = np.zeros(0, np.int64)
    if not len(sizes) or sizes.max() < window:
        return none, none, none.astype(np.uint64), none, none
    data = np.frombuffer(b"".join(pieces), np.uint8)
    ends = np.cumsum(sizes)
    h = gram_hashes(data)
    span = window - GRAM + 1
    # hash in the high bits, position in the low ones: the minimum is the leftmost lowest hash
    pos_bits = np.uint64(max(1, int(len(data)).bit_length()))
    low = ((h >> pos_bits) << pos_bits) | np.arange(len(h), dtype=np.uint64)
    width = 1
    while width * 2 <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < span:
        low = np.minimum(low[:len(low) - (span - width)], low[span - width:])
    at = (low & ((np.uint64(1) << pos_bits) - np.uint64(1))).astype(np.int64)
    start = np.arange(len(at))
    piece = np.repeat(np.arange(len(pieces)), sizes)[:len(at)]
    inside = start + window <= ends[piece]
    at, start, piece = at[inside], start[inside], piece[inside]
    if not len(at):
        return none, none, none.astype(np.uint64), none, none
    first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (piece[1:] != piece[:-1])])
    last = np.r_[first[1:], len(at)] - 1
    a, p = at[first], piece[first]
    base = ends[p] - sizes[p]
    return p, a - base, h[a], a - start[last], a - start[first]


PIECE = 1 << 20            # bytes hashed at a time; longer texts are cut with an overlap


def pieces_of(texts: list[bytes], window: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Batches of about PIECE bytes: text index, offset of the piece in it, piece."""
    idx: list[int] = []
    off: list[int] = []
    out: list[bytes] = []
    size = 0
    for i, t in enumerate(texts):
        for lo in range(0, max(1, len(t) - window + 1), PIECE):
            piece = t[lo:lo + PIECE + window - 1]
            if len(piece) < window:
                continue
            idx.append(i)
            off.append(lo)
            out.append(piece)
            size += len(piece)
            if size >= PIECE:
                yield idx, off, out
                idx, off, out, size = [], [], [], 0
    if out:
        yield idx, off, out


def text_anchors(texts: list[bytes], window: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Anchors of whole texts, piece batch by piece batch: text index, position
    in the text, gram hash, least and greatest distance."""
    for idx, off, out in pieces_of(texts, window):
        p, a, h, r0, r1 = anchors(out, window)
        yield np.asarray(idx, np.int64)[p], a + np.asarray(off, np.int64)[p], h, r0, r1


def context_id(left: bytes, right: bytes, r0: int, r1: int) -> bytes:
    return blake2b(b"%d,%d,%b%b" % (r0, r1, left, right), digest_size=16).digest()


def window_ids(text: bytes, at: int, r0: int, r1: int, window: int) -> list[bytes]:
    """Digests of the strings that start ``r0`` to ``r1`` bytes before the anchor."""
    return [blake2b(text[at - r:at - r + window], digest_size=16).digest() for r in range(r0, r1 + 1)]


# --- runs: sorted, front-coded, exchanged as compressed blobs ------------------------

def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of ``a`` and ``b``, of which ``known`` bytes
    are known to agree."""
    n = min(len(a), len(b))
    x, y = a[known:n], b[known:n]
    if x == y:
        return n
    diff = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
    return n - (diff.bit_length() + 7) // 8


def pack_run(items: list[tuple[bytes, bytes, int, int, int]]) -> bytes:
    """Sorted items ``(right, left, r0, r1, copies)`` as a front-coded blob."""
    head = np.empty((len(items), 6), np.uint16)
    rests, lefts, last = [], [], b""
    for k, (right, left, r0, r1, copies) in enumerate(items):
        lcp = common_prefix(last, right, 0)
        head[k] = lcp, len(right) - lcp, len(left), r0, r1, min(copies, 2)
        rests.append(right[lcp:])
        lefts.append(left)
        last = right
    body = b"".join((np.uint64(len(items)).tobytes(), np.ascontiguousarray(head.T).tobytes(), *rests, *lefts))
    return zstandard.ZstdCompressor(level=3).compress(body)


def unpack_run(blob: bytes) -> tuple[list[bytes], list[int], list[bytes], np.ndarray]:
    """Rights, common-prefix lengths, lefts and the (r0, r1, copies) columns."""
    body = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(body, np.uint64, 1)[0])
    head = np.frombuffer(body, np.uint16, 6 * n, 8).reshape(6, n).astype(np.int64)
    at = 8 + 12 * n
    rights, lefts, last = [], [], b""
    for lcp, rest in zip(head[0].tolist(), head[1].tolist()):
        last = last[:lcp] + body[at:at + rest]
        at += rest
        rights.append(last)
    for size in head[2].tolist():
        lefts.append(body[at:at + size])
        at += size
    return rights, head[0].tolist(), lefts, head[3:]


class LoserTree:
    """Merges sorted runs given with their common-prefix lengths.

    A node keeps the loser of its match and how much it has in common with the
    winner, so a match is decided by two lengths, and bytes are read only where
    these are equal, from the first byte not yet known to agree."""

    def __init__(self, runs: list[tuple[list[bytes], list[int]]]):
        self.runs = runs
        self.at = [0] * len(runs)
        self.size = 1
        while self.size < len(runs):
            self.size *= 2
        self.loser = [(-1, 0)] * self.size           # (run, common prefix with the winner)
        self.winner = self._play(1)

    def _head(self, run: int) -> bytes | None:
        if run < 0 or self.at[run] >= len(self.runs[run][0]):
            return None
        return self.runs[run][0][self.at[run]]

    def _match(self, x: tuple[int, int], y: tuple[int, int]) -> tuple[tuple[int, int], tuple[int, int]]:
        a, b = self._head(x[0]), self._head(y[0])
        if b is None:
            return x, y
        if a is None:
            return y, x
        if x[1] != y[1]:                             # more in common with the last output: smaller
            return (x, y) if x[1] > y[1] else (y, x)
        n = common_prefix(a, b, x[1])
        if n == len(a) or (n < len(b) and a[n] < b[n]):
            return x, (y[0], n)
        return y, (x[0], n)

    def _play(self, node: int) -> tuple[int, int]:
        if node >= self.size:
            run = node - self.size
            return (run if run < len(self.runs) else -1, 0)
        win, self.loser[node] = self._match(self._play(2 * node), self._play(2 * node + 1))
        return win

    def __iter__(self) -> Iterator[tuple[int, int, int]]:
        """(run, index in the run, common prefix with the item before)."""
        while self._head(self.winner[0]) is not None:
            run, lcp = self.winner
            k = self.at[run]
            yield run, k, lcp
            self.at[run] = k = k + 1
            lcps = self.runs[run][1]
            now = (run, lcps[k] if k < len(lcps) else 0)
            node = (run + self.size) // 2
            while node:
                now, self.loser[node] = self._match(now, self.loser[node])
                node //= 2
            self.winner = now


def repeated_distances(lcps: np.ndarray, lefts: list[bytes], extents: np.ndarray, window: int) -> np.ndarray:
    """For items in merged order, a matrix (item, distance): whether the window
    starting that far before the anchor occurs at another place as well.
    ``extents``: rows r0, r1, copies.  Windows are equal when the items agree on
    ``window - r`` bytes right of the anchor and ``r`` bytes left of it."""
    n, span = len(lefts), window - GRAM + 1
    r0, r1, copies = extents
    dup = np.zeros((n, span), bool)
    back = [x[::-1] for x in lefts]
    order = np.array(sorted(range(n), key=back.__getitem__), np.int64)
    shared = np.zeros(n, np.int64)
    for k in range(1, n):
        shared[k] = common_prefix(back[order[k - 1]], back[order[k]], 0)
    near = np.zeros(n, bool)                          # shares a whole gram with a neighbour
    near[1:] = lcps[1:] >= GRAM
    near[:-1] |= near[1:].copy()
    for r in range(span):
        active = (r0 <= r) & (r <= r1)
        dup[:, r] = active & (copies > 1)
        live = np.flatnonzero(active & near)
        if len(live) < 2:
            continue
        right = np.cumsum(lcps < window - r)
        left = np.empty(n, np.int64)
        left[order] = np.cumsum(shared < r)
        key = right[live] * (n + 1) + left[live]
        by = np.argsort(key, kind="stable")
        same = np.flatnonzero(key[by[1:]] == key[by[:-1]])
        dup[live[by[same]], r] = True
        dup[live[by[same + 1]], r] = True
    return dup


# --- Spark stages --------------------------------------------------------------------------

def _texts(table: pa.RecordBatch | pa.Table, column: str) -> list[bytes]:
    return [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in table.column(column).to_pylist()]


def _slices(batch: pa.RecordBatch, column: str, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Row slices of about ``size`` text bytes."""
    group = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()) // size
    cuts = np.flatnonzero(np.r_[True, np.diff(group) != 0]) if len(group) else np.zeros(0, int)
    for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), batch.num_rows]):
        yield batch.slice(lo, hi - lo)


def _gram_rows(window: int, column: str):
    def run(batches):
        for batch in (piece for whole in batches for piece in _slices(whole, column)):
            texts, part = _texts(batch, column), batch.column("_sfx_part").to_numpy()
            found = [(h, part[i]) for i, _, h, _, _ in text_anchors(texts, window)]
            if not found:
                continue
            gram, where = np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])
            order = np.lexsort((where, gram))
            gram, where = gram[order], where[order]
            first = np.flatnonzero(np.r_[True, (gram[1:] != gram[:-1]) | (where[1:] != where[:-1])])
            count = np.diff(np.r_[first, len(gram)])
            yield pa.RecordBatch.from_arrays([pa.array(gram[first].view(np.int64)), pa.array(where[first].astype(np.int32)),
                                              pa.array(count.astype(np.int32))], names=["gram", "part", "n"])
    return run


def _pack_docs(batches):
    """Rows of one part of a batch as one compressed block."""
    for batch in batches:
        part = batch.column("_sfx_part").to_numpy()
        order = np.argsort(part, kind="stable")
        rows = pa.Table.from_batches([batch]).drop_columns(["_sfx_part"]).take(pa.array(order)).combine_chunks()
        cuts = np.flatnonzero(np.r_[True, np.diff(part[order]) != 0]) if len(order) else []
        for lo, hi in zip(cuts, [*cuts[1:], len(order)]):
            sink = pa.BufferOutputStream()
            block = rows.slice(lo, hi - lo)
            with pa.ipc.new_stream(sink, block.schema) as out:
                out.write_table(pa.Table.from_batches(block.to_batches()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(part[order[lo]])], pa.int32()),
                 pa.array([zstandard.ZstdCompressor(level=3).compress(sink.getvalue().to_pybytes())], pa.binary())],
                names=["part", "block"])


def _unpack_docs(blocks: pa.Table) -> Iterator[pa.Table]:
    for block in blocks.column("block").to_pylist():
        yield pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(block)).read_all()


def _hits(blocks: pa.Table, grams: pa.Table, column: str, window: int) -> Iterator[tuple]:
    """Anchors of a part's texts whose gram is listed: batches of texts with text
    index, position, gram, least and greatest distance."""
    known = np.sort(grams.column("gram").to_numpy().view(np.uint64))
    for rows in _unpack_docs(blocks) if len(known) else ():
        texts = _texts(rows, column)
        for i, a, h, r0, r1 in text_anchors(texts, window):
            slot = np.minimum(np.searchsorted(known, h), len(known) - 1)
            hit = np.flatnonzero(known[slot] == h)
            yield texts, i[hit], a[hit], h[hit], r0[hit], r1[hit]


def _hot_windows(window: int, column: str, most: int):
    """Strings of a part's hot grams with their counts, each once in about ``most``."""
    schema = pa.schema([("part", pa.int32()), ("gram", pa.int64()), ("id", pa.binary()), ("n", pa.int32())])

    def run(blocks: pa.Table, grams: pa.Table) -> pa.Table:
        part = grams.column("part")[0].as_py() if len(grams) else -1
        out: list[pa.Table] = []
        bag: dict[tuple[int, bytes], int] = {}

        def flush():
            out.append(pa.table([pa.array([part] * len(bag), pa.int32()), pa.array([g for g, _ in bag], pa.int64()),
                                 pa.array([w for _, w in bag], pa.binary()), pa.array(bag.values(), pa.int32())],
                                schema=schema))
            bag.clear()
        for texts, i, a, h, r0, r1 in _hits(blocks, grams, column, window):
            for t, at, g, lo, hi in zip(i.tolist(), a.tolist(), h.view(np.int64).tolist(), r0.tolist(), r1.tolist()):
                for w in window_ids(texts[t], at, lo, hi, window):
                    bag[g, w] = bag.get((g, w), 0) + 1
                if len(bag) > most:
                    flush()
        flush()
        return pa.concat_tables(out)
    return run


def _runs(window: int, dests: int, column: str):
    def run(blocks: pa.Table, grams: pa.Table) -> pa.Table:
        items: list[dict] = [{} for _ in range(dests)] if dests < 4096 else []
        sparse: dict[int, dict] = {}
        for texts, i, a, h, r0, r1 in _hits(blocks, grams, column, window):
            for t, at, g, lo, hi in zip(i.tolist(), a.tolist(), (h % np.uint64(dests)).tolist(), r0.tolist(), r1.tolist()):
                bag = items[g] if items else sparse.setdefault(g, {})
                key = (texts[t][at:at - lo + window], texts[t][at - hi:at], lo, hi)
                bag[key] = bag.get(key, 0) + 1
        part = blocks.column("part")[0].as_py() if len(blocks) else -1
        bags = [(g, b) for g, b in enumerate(items) if b] if items else sorted(sparse.items())
        blobs = [pack_run([(*key, n) for key, n in sorted(b.items())]) for _, b in bags]
        return pa.table({"dest": pa.array([g for g, _ in bags], pa.int32()),
                         "part": pa.array([part] * len(bags), pa.int32()), "run": pa.array(blobs, pa.binary())})
    return run


def _merge(window: int):
    def run(table: pa.Table) -> pa.Table:
        parts = table.column("part").to_pylist()
        runs = [unpack_run(b) for b in table.column("run").to_pylist()]
        merged = list(LoserTree([(r[0], r[1]) for r in runs]))
        lcps = np.array([x[2] for x in merged], np.int64)
        lefts = [runs[r][2][k] for r, k, _ in merged]
        extents = np.array([[runs[r][3][f][k] for r, k, _ in merged] for f in range(3)], np.int64)
        dup = repeated_distances(lcps, lefts, extents, window)
        found: dict[int, list[bytes]] = {}
        for m in np.flatnonzero(dup.any(axis=1)).tolist():
            r, k, _ = merged[m]
            edge = np.flatnonzero(np.diff(np.r_[False, dup[m], False].view(np.int8)))
            lo, hi = int(extents[0, m]), int(extents[1, m])
            spans = np.stack([edge[::2], edge[1::2] - 1], 1).astype(np.uint16)
            found.setdefault(parts[r], []).append(
                context_id(lefts[m], runs[r][0][k], lo, hi) + np.uint16(len(spans)).tobytes() + spans.tobytes())
        return pa.table({"part": pa.array(list(found), pa.int32()),
                         "spans": pa.array([b"".join(v) for v in found.values()], pa.binary())})
    return run


def _cut(window: int, names: list[str], schema: pa.Schema, column: str):
    def run(blocks: pa.Table, found: pa.Table) -> pa.Table:
        spans: dict[bytes, np.ndarray] = {}
        counted = found.filter(pc.is_valid(found.column("id")))
        hot = set(pc.unique(counted.column("gram")).to_pylist())
        repeated = set(counted.column("id").to_pylist())
        for blob in found.column("spans").drop_null().to_pylist():
            at = 0
            while at < len(blob):
                n = int(np.frombuffer(blob, np.uint16, 1, at + 16)[0])
                spans[blob[at:at + 16]] = np.frombuffer(blob, np.uint16, 2 * n, at + 18).reshape(n, 2)
                at += 18 + 4 * n
        out = []
        for rows in _unpack_docs(blocks):
            texts = _texts(rows, column)
            cover: dict[int, list[tuple[int, int]]] = {}
            for i, a, h, r0, r1 in text_anchors(texts, window) if spans or hot else ():
                grams = h.view(np.int64).tolist() if hot else [None] * len(h)
                for t, at, g, lo, hi in zip(i.tolist(), a.tolist(), grams, r0.tolist(), r1.tolist()):
                    if g in hot:
                        cover.setdefault(t, []).extend(
                            (at - r, at - r + window) for r, w in enumerate(window_ids(texts[t], at, lo, hi, window), lo)
                            if w in repeated)
                        continue
                    got = spans.get(context_id(texts[t][at - hi:at], texts[t][at:at - lo + window], lo, hi))
                    if got is not None:
                        cover.setdefault(t, []).extend((at - far, at - near + window) for near, far in got.tolist())
            kept, removed, count = [], [], []
            for t, text in enumerate(texts):
                keep, last, gone, runs = [], 0, 0, 0
                for lo, hi in sorted(cover.get(t, ())):
                    if lo > last or not runs:
                        keep.append(text[last:lo])
                        gone += hi - lo
                        runs += 1
                        last = hi
                    elif hi > last:
                        gone += hi - last
                        last = hi
                keep.append(text[last:])
                kept.append(b"".join(keep))
                removed.append(gone)
                count.append(runs)
            own = {n: rows.column(n) for n in names}
            out.append(pa.table([*own.values(), pa.array(kept, pa.binary()),
                                 pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()),
                                 pa.array([len(t) for t in texts], pa.int64()), pa.array(removed, pa.int64()),
                                 pa.array(count, pa.int64())], names=schema.names).cast(schema))
        return pa.concat_tables(out) if out else schema.empty_table()
    return run


def _dealt(df: DataFrame, key: str, groups: int, per_task: int) -> DataFrame:
    """``df`` by hash of ``key``, in a number of partitions that follows the number of groups."""
    least = min(groups, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(max(1, least, groups // per_task), key)


def _repeated_windows(blocks: DataFrame, hot: DataFrame, window: int, column: str) -> DataFrame:
    """``(part, gram, id)`` of the strings of hot grams that occur more than once."""
    counts = materialize(blocks.groupBy("part").cogroup(hot.groupBy("part")).applyInArrow(
        _hot_windows(window, column, FLUSH), "part int, gram long, id binary, n int"), "suffix-windows")
    twice = materialize(counts.groupBy("gram", "id").agg(F.sum("n").alias("total"), F.count("*").alias("held"))
                        .where("total > 1").select("gram", "id", "held"), "suffix-repeated-windows")
    return join_by_key(counts.select("part", "gram", "id"), twice, ["gram", "id"], "held", counts.count()).select(
        "part", "gram", "id").distinct()


def remove_repeats(docs: DataFrame, text_col: str = "text", window: int = 200) -> DataFrame:
    """``docs`` with, per row, ``_sfx_kept`` (bytes that stay), ``_sfx_kept_text``
    (the same as text, without characters that were cut in two),
    ``_sfx_n_bytes``, ``_sfx_n_removed`` and ``_sfx_n_spans``.

    Each byte covered by a ``window``-byte string that also starts anywhere
    else, in the same text or another one, goes.  Matches never cross rows;
    null text counts as empty; repeated rows are each other's repeats; texts
    shorter than the window stay; an empty table gives an empty result.  Other
    columns pass through whatever their names are (the prefix ``_sfx_`` is
    reserved)."""
    if window < GRAM + 1:
        raise ValueError(f"window must exceed {GRAM} bytes")
    text = text_of(docs, text_col)
    size = docs.agg(F.sum(F.octet_length(text)).alias("b")).first()["b"] or 0
    parts = max(1, -(-size // PART_BYTES))
    names = docs.columns
    source = docs.select(docs[text_col]).schema[0]
    column = source.name if isinstance(source.dataType, T.StringType) else "_sfx_text"
    rows = docs if column == source.name else docs.withColumn("_sfx_text", text)
    seed = [rows[f"`{c}`"] for c in names if not isinstance(docs.schema[c].dataType, (T.MapType, T.VariantType))]
    rows = rows.withColumn("_sfx_part", F.pmod(F.xxhash64(*seed, text), F.lit(parts)).cast("int"))

    each = materialize(rows.select("_sfx_part", F.col(f"`{column}`").alias("_sfx_text")).mapInArrow(
        _gram_rows(window, "_sfx_text"), "gram long, part int, n int"), "suffix-grams")
    repeated = materialize(each.groupBy("gram").agg(F.sum("n").alias("total"), F.count("*").alias("held"))
                           .where("total > 1").select("gram", "held", (F.col("total") > HOT_ITEMS).alias("hot")),
                           "suffix-repeated")
    grams = materialize(join_by_key(each.select("gram", "part"), repeated, "gram", "held", each.count())
                        .select("part", "gram", "hot").distinct(), "suffix-repeated-parts")
    cold, hot = grams.where("NOT hot").select("part", "gram"), grams.where("hot").select("part", "gram")
    # about window + span/2 bytes an item; a merge holds its items as objects, so half as much as a part
    dests = max(1, -(-cold.count() * (window + 45) // (PART_BYTES // 2)))

    def by_part(df: DataFrame) -> DataFrame:
        return _dealt(df, "part", parts, PARTS_PER_TASK)
    blocks = by_part(rows.mapInArrow(_pack_docs, "part int, block binary"))
    runs = blocks.groupBy("part").cogroup(by_part(cold).groupBy("part")).applyInArrow(
        _runs(window, dests, column), "dest int, part int, run binary")
    found = _dealt(runs, "dest", dests, BUCKETS_PER_TASK).groupBy("dest").applyInArrow(_merge(window), "part int, spans binary").select(
        "part", "spans", F.lit(None).cast("long").alias("gram"), F.lit(None).cast("binary").alias("id"))
    if not hot.isEmpty():
        found = found.unionByName(_repeated_windows(blocks, by_part(hot), window, column), allowMissingColumns=True)
    schema = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in docs.schema.fields],
                           T.StructField("_sfx_kept", T.BinaryType()), T.StructField("_sfx_kept_text", T.StringType()),
                           *[T.StructField(f"_sfx_{n}", T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")]])
    return blocks.groupBy("part").cogroup(by_part(found).groupBy("part")).applyInArrow(
        _cut(window, names, to_arrow_schema(schema), column), schema)


def drop_repeats(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars",
                 window: int = 200) -> DataFrame:
    """``docs`` with repeated strings cut out of the text; all rows and columns
    stay.  ``length_col``, where present, gets the new length in characters.
    Null text stays null."""
    out = remove_repeats(docs, text_col, window)
    new = F.when(out[text_col].isNotNull(), F.col("_sfx_kept_text"))
    keep = []
    for f in docs.schema.fields:
        if f.name == text_col:
            keep.append(new.alias(f.name))
        elif f.name == length_col:
            keep.append(F.when(F.col("_sfx_n_removed") > 0, F.length(new).cast(f.dataType))
                        .otherwise(out[f"`{f.name}`"]).alias(f.name))
        else:
            keep.append(out[f"`{f.name}`"])
    return out.select(*keep)

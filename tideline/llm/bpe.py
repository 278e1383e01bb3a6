"""Byte-level BPE over a shuffle of distinct words.

Texts are dealt to parts; a part sends each distinct pre-token once to the
bucket of its hash; a bucket encodes every distinct word once and sends the
ids back to the parts that hold it; the part reassembles each text by the
positions of its pre-tokens (a block holds the words of one part in one bucket).  Decoding joins the ids with the table of token
bytes.  Words and ids travel in sorted, compressed blocks, and the texts are
shuffled once (both uses read the same exchange)."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of
from .suffix_dedup import _pack_docs, _unpack_docs
from .tokens import encode_word, encoding, split_words, token_bytes, vocabulary_path

#: Text bytes of a part, and the most tasks that hold them.
PART_BYTES, MAX_TASKS = 8 << 20, 100_000
#: Buckets of words: fixed, so that the number of blocks grows with the parts and not with their square.  A bucket's
#: blocks are streamed, and its table of known words starts anew beyond ``KNOWN_WORDS``.
BUCKETS, KNOWN_WORDS = 128, 1_000_000


def pre_tokens(text: str) -> list[str]:
    return split_words(text)


def pack_words(words: list[bytes]) -> bytes:
    """Sorted words, front-coded (shared prefix, rest)."""
    head = np.empty((2, len(words)), np.uint32)
    rests, last = [], b""
    for k, w in enumerate(words):
        n, top = 0, min(len(last), len(w))
        while n < top and last[n] == w[n]:
            n += 1
        head[0, k], head[1, k] = n, len(w) - n
        rests.append(w[n:])
        last = w
    return zstandard.compress(np.uint64(len(words)).tobytes() + head.tobytes() + b"".join(rests))


def unpack_words(block: bytes) -> Iterator[bytes]:
    body = zstandard.decompress(block)
    n = int(np.frombuffer(body, np.uint64, 1)[0])
    head = np.frombuffer(body, np.uint32, 2 * n, 8).reshape(2, n).tolist()
    at, last = 8 + 8 * n, b""
    for keep, rest in zip(*head):
        last = last[:keep] + body[at:at + rest]
        at += rest
        yield last


def _buckets(words: set[str], buckets: int) -> dict[int, list[bytes]]:
    """Distinct words by bucket, sorted."""
    out: dict[int, list[bytes]] = {}
    for w in words:
        b = w.encode("utf-8", "surrogatepass")
        out.setdefault(xxhash.xxh32_intdigest(b) % buckets, []).append(b)
    for v in out.values():
        v.sort()
    return out


def _part_texts(blocks: pa.Table) -> Iterator[tuple[list, list[str]]]:
    for rows in _unpack_docs(blocks):
        yield rows.column("doc_id"), rows.column("text").to_pylist()


def _distinct_words(buckets: int):
    def run(blocks: pa.Table) -> pa.Table:
        words: set[str] = set()
        for _, texts in _part_texts(blocks):
            for t in texts:
                words.update(pre_tokens(t))
        by = sorted(_buckets(words, buckets).items())
        part = blocks.column("part")[0].as_py()
        return pa.table({"bucket": pa.array([b for b, _ in by], pa.int32()),
                         "part": pa.array([part] * len(by), pa.int32()),
                         "words": pa.array([pack_words(w) for _, w in by], pa.binary())})
    return run


def _encode_words(vocabulary: str):
    def encode(block: bytes, own, known: dict) -> bytes:
        sizes, ids = [], []
        for w in unpack_words(block):
            got = known.get(w)
            if got is None:
                known[w] = got = np.array(encode_word(own, w), "<u4").tobytes()
            sizes.append(len(got) // 4)
            ids.append(got)
        body = np.frombuffer(b"".join(ids), "<u4")
        planes = b"".join((body >> s & 255).astype(np.uint8).tobytes() for s in (0, 8, 16, 24))
        return zstandard.compress(np.uint64(len(sizes)).tobytes() + np.array(sizes, np.uint32).tobytes() + planes)

    def run(batches):
        own, known, bucket = encoding(vocabulary), {}, None
        for batch in batches:
            out = []
            for b, block in zip(batch.column("bucket").to_pylist(), batch.column("words")):
                if b != bucket or len(known) > KNOWN_WORDS:
                    known, bucket = {}, b
                out.append(encode(block.as_py(), own, known))
            yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("bucket"), pa.array(out, pa.binary())],
                                             ["part", "bucket", "ids"])
    return run


def unpack_ids(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and concatenated ids."""
    body = zstandard.decompress(block)
    n = int(np.frombuffer(body, np.uint64, 1)[0])
    sizes = np.frombuffer(body, np.uint32, n, 8).astype(np.int64)
    planes = np.frombuffer(body, np.uint8, offset=8 + 4 * n).reshape(4, -1)
    return sizes, sum(planes[k].astype(np.uint32) << np.uint32(8 * k) for k in range(4)).astype("<u4")


def _reassemble(vocabulary: str, buckets: int, schema: pa.Schema):
    def run(blocks: pa.Table, found: pa.Table) -> pa.Table:
        if not len(blocks):
            return schema.empty_table()
        table = token_bytes(vocabulary)
        position: dict[str, int] = defaultdict()      # word -> number, in order of first sight
        position.default_factory = position.__len__
        rows = []
        for ids, texts in _part_texts(blocks):
            at = [np.fromiter(map(position.__getitem__, pre_tokens(t)), np.int64) for t in texts]
            rows.append((ids, at))
        word_ids: list = [None] * len(position)
        returned = {r["bucket"]: r["ids"] for r in found.to_pylist()}
        for bucket, words in _buckets(set(position), buckets).items():
            sizes, ids = unpack_ids(returned[bucket])
            if len(sizes) != len(words):
                raise RuntimeError(f"bucket {bucket}: {len(words)} words sent, {len(sizes)} came back")
            stops = np.cumsum(sizes)
            for w, lo, hi in zip(words, (stops - sizes).tolist(), stops.tolist()):
                word_ids[position[w.decode("utf-8", "surrogatepass")]] = ids[lo:hi]
        starts = np.cumsum([0, *map(len, word_ids)])
        flat = np.concatenate(word_ids) if word_ids else np.zeros(0, "<u4")
        out = []
        for doc_ids, at in rows:
            n_tokens, hashes, decoded = [], [], []
            for words in at:
                size = starts[words + 1] - starts[words]
                first = np.cumsum(size) - size
                ids = flat[np.repeat(starts[words] - first, size) + np.arange(size.sum())].astype("<u4")
                n_tokens.append(len(ids))
                hashes.append(hashlib.sha256(ids.tobytes()).hexdigest())
                decoded.append(hashlib.sha256(b"".join(map(table.__getitem__, ids.tolist()))).hexdigest())
            out.append(pa.table([doc_ids, pa.array(n_tokens, pa.int64()), pa.array(hashes, pa.string()),
                                 pa.array(decoded, pa.string())], names=schema.names).cast(schema))
        return pa.concat_tables(out)
    return run


def encode_and_decode(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    Null text is empty (no token); a run of any length is one word; repeated rows and null ids are encoded like
    any others; an empty table gives an empty result; other columns are
    ignored.  Special tokens are ordinary text."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema
    vocabulary = vocabulary or vocabulary_path("byte_bpe_multi_50k.tiktoken")
    rows = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // PART_BYTES))
    rows = rows.withColumn("_sfx_part", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("int"))
    tasks = min(parts, MAX_TASKS)                      # said outright: the session's number knows nothing of the input
    blocks = rows.mapInArrow(_pack_docs, "part int, block binary").repartition(tasks, "part")
    words = blocks.groupBy("part").applyInArrow(_distinct_words(BUCKETS), "bucket int, part int, words binary")
    ids = (words.repartition(min(tasks, BUCKETS), "bucket").sortWithinPartitions("bucket", "part")
           .mapInArrow(_encode_words(vocabulary), "part int, bucket int, ids binary").repartition(tasks, "part"))
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    return blocks.groupBy("part").cogroup(ids.groupBy("part")).applyInArrow(
        _reassemble(vocabulary, BUCKETS, to_arrow_schema(schema)), schema)

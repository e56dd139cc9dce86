"""Byte-level BPE of whole texts through one table of distinct words.

1. **Split.**  Documents are taken in blocks.  A text is cut before each space that
   starts a word, and around other runs of white space; the tokenizer merges
   nothing across these cuts.  A block keeps the place of every word in its own
   list of distinct words.
2. **Encode once.**  The blocks' words meet in buckets of their hash.  Each
   distinct word of the corpus is encoded once, by the tokenizers library, in
   its bucket.
3. **Join back.**  Every block gets the ids of its words, and joins them by place:
   the ids of a document are those of its words in order.
4. **Decode.**  Ids are joined with the id-to-piece table, whose size is the
   vocabulary's; the pieces' bytes in order are the decoded text.

A frequent word is one entry per block at most.  Words and ids travel as one
compressed row per block and bucket, so the shuffle is a fraction of the text.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylater.llm import documents
from paylater.llm.blocks import binary_views, row_blocks
from paylater.llm.vocabulary import (WordTable, byte_pieces, encode_words, gather, open_tokenizer,
                                     public_path, tokenizer_text)

BLOCK_BYTES = 16 << 20
PART_CHARS = 4 << 20

# White space as the tokenizer's pattern has it (Unicode's White_Space property).
SPACE = "\t-\r \x85\xa0" + "".join(map(chr, (
    0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
WORD = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
CUT = re.compile(f"[^{SPACE}](?= [^{SPACE}])")
BLOCK = "block long, bucket int, payload binary"


def split_words(text: str, special: re.Pattern | None) -> list[str]:
    """Words of a text; the special tokens' strings stand alone, as they do in the library."""
    if special is not None and special.search(text):
        parts = special.split(text)
        return [w for i, part in enumerate(parts) for w in ([part] if i % 2 else WORD.findall(part))]
    return WORD.findall(text)


def _parts(text: str) -> Iterator[str]:
    """Long texts in parts, cut where a word ends and a single space follows."""
    low = 0
    while len(text) - low > 2 * PART_CHARS:
        cut = CUT.search(text, low + PART_CHARS)
        if cut is None:
            break
        yield text[low:cut.end()]
        low = cut.end()
    yield text[low:] if low else text


def _pack(words: list[bytes], places: np.ndarray) -> bytes:
    sizes = np.array([len(w) for w in words], np.int32)
    head = np.array([len(words)], np.int32)
    return zlib.compress(head.tobytes() + places.astype("<i4").tobytes() + sizes.tobytes() + b"".join(words), 1)


def _unpack(payload: bytes) -> tuple[list[bytes], np.ndarray]:
    raw = zlib.decompress(payload)
    n = int(np.frombuffer(raw, np.int32, 1)[0])
    places, sizes = (np.frombuffer(raw, np.int32, n, 4 + 4 * n * k) for k in range(2))
    ends = (np.cumsum(sizes) + 4 + 8 * n).tolist()
    return [raw[a:b] for a, b in zip([4 + 8 * n, *ends], ends)], places


def _content_key(ids: np.ndarray, body: bytes) -> int:
    """A block is named by what it holds, so another order of rows can't join it to another block's words."""
    digest = hashlib.blake2b(ids.astype("<i8").tobytes(), digest_size=8)
    digest.update(body)
    return int.from_bytes(digest.digest(), "little", signed=True)


def _split(buckets: int, specials: list[str], part: str):
    """``part`` "words": a row for each block and bucket; "texts": a row for each block."""
    special = re.compile("(" + "|".join(map(re.escape, specials)) + ")") if specials else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            data, at = binary_views(batch.column("body"))
            raw = data.tobytes()
            for first, end in row_blocks(at, BLOCK_BYTES):
                block = _content_key(ids[first:end], raw[at[first]:at[end]])
                table, places, counts = WordTable(), [], np.zeros(end - first, np.int32)
                for i in range(first, end):
                    for text in _parts(raw[at[i]:at[i + 1]].decode()):
                        picks = table.places(split_words(text, special))
                        counts[i - first] += len(picks)
                        places.append(picks)
                if part == "texts":
                    flat = np.concatenate(places) if places else np.zeros(0, np.int32)
                    # the byte planes of the places, which compress better than their integers
                    planes = flat.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
                    head = np.array([end - first], "<i8").tobytes()
                    body = ids[first:end].astype("<i8").tobytes() + counts.astype("<i4").tobytes()
                    yield _rows([block], [-1], [zlib.compress(head + body + planes, 1)])
                else:
                    words = [w.encode() for w in table]
                    bucket = np.array([zlib.crc32(w) % buckets for w in words], np.int64)
                    order = np.argsort(bucket, kind="stable")
                    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
                    some = [b for b in range(buckets) if edges[b + 1] > edges[b]]
                    picks = [order[edges[b]:edges[b + 1]] for b in some]
                    yield _rows([block] * len(some), some,
                                [_pack([words[k] for k in p], p) for p in picks])
    return run


def _rows(block: list[int], bucket: list[int], payload: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(block, pa.int64()), pa.array(bucket, pa.int32()), pa.array(payload, pa.binary())],
        ["block", "bucket", "payload"])


def _encoder(tokenizer):
    """Ids of every word of the buckets of a partition; a distinct word is encoded once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = open_tokenizer(tokenizer.value)
        bucket, table = None, WordTable()
        flat, offsets = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        for batch in batches:
            for b, block, payload in zip(*(batch.column(c).to_pylist() for c in ("bucket", "block", "payload"))):
                if b != bucket:
                    bucket, table = b, WordTable()
                    flat, offsets = np.zeros(0, np.uint32), np.zeros(1, np.int64)
                words, places = _unpack(payload)
                known = len(table)
                mine = table.places(words)
                if len(table) > known:
                    more, more_at = encode_words(
                        encoder, [w.decode() for w, place in zip(words, mine.tolist()) if place >= known])
                    offsets = np.concatenate([offsets, more_at[1:] + len(flat)])
                    flat = np.concatenate([flat, more])
                sizes = np.diff(offsets)[mine]
                body = b"".join([np.array([len(places)], "<i4").tobytes(), places.astype("<i4").tobytes(),
                                 sizes.astype("<i4").tobytes(), gather(flat, offsets, mine).astype("<u4").tobytes()])
                yield _rows([block], [b], [zlib.compress(body, 1)])
    return run


def _joiner(pieces):
    """Step 3 and 4 for one block: the ids of each document, and the bytes they decode to."""
    def run(key, texts: pa.Table, words: pa.Table) -> pa.Table:
        piece_bytes, piece_at = pieces.value
        piece_bytes, piece_at = np.frombuffer(piece_bytes, np.uint8), np.frombuffer(piece_at, np.int64)
        places, sizes, flats = [], [], []
        for payload in words.column("payload").to_pylist():
            raw = zlib.decompress(payload)
            n = int(np.frombuffer(raw, "<i4", 1)[0])
            places.append(np.frombuffer(raw, "<i4", n, 4))
            sizes.append(np.frombuffer(raw, "<i4", n, 4 + 4 * n))
            flats.append(np.frombuffer(raw, "<u4", offset=4 + 8 * n))
        place, size, flat = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (places, sizes, flats))
        starts = np.cumsum(size) - size
        word_at = np.empty(len(place), np.int64)
        word_at[place] = starts
        word_n = np.empty(len(place), np.int64)
        word_n[place] = size
        docs, ids_out, decoded = [], [], []
        for payload in texts.column("payload").to_pylist():
            raw = zlib.decompress(payload)
            n = int(np.frombuffer(raw, "<i8", 1)[0])
            ids = np.frombuffer(raw, "<i8", n, 8)
            counts = np.frombuffer(raw, "<i4", n, 8 + 8 * n)
            planes = np.frombuffer(raw, np.uint8, offset=8 + 12 * n).reshape(4, -1)
            flat_places = np.ascontiguousarray(planes.T).view("<u4").ravel()
            if flat_places.max(initial=0) >= max(len(place), 1):
                raise RuntimeError("rows were read in another order for the words than for the texts; "
                                   "give encode_decode a written table")
            ends = np.cumsum(counts)
            for i, low, high in zip(ids.tolist(), (ends - counts).tolist(), ends.tolist()):
                picks = flat_places[low:high]
                size = word_n[picks]
                stop = np.cumsum(size)
                total = int(stop[-1]) if len(stop) else 0
                tokens = flat[np.repeat(word_at[picks] - (stop - size), size) + np.arange(total)] if total else flat[:0]
                docs.append(i)
                ids_out.append(tokens.astype("<u4").tobytes())
                decoded.append(gather(piece_bytes, piece_at, tokens.astype(np.int64)).tobytes()
                               .decode("utf-8", "replace"))
        return pa.table({"doc_id": pa.array(docs, pa.int64()), "ids": pa.array(ids_out, pa.binary()),
                         "decoded": pa.array(decoded, pa.string())})
    return run


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``doc_id, ids, decoded``: ids as little-endian 32-bit integers, and the text decoded from them.

    For byte-level BPE files with the library's own splitting pattern and no
    normalizer.  Null and empty texts have no ids.  Every row with an id
    is encoded, repeated ids too; other columns are not read.  ``docs`` is read twice, and both readings
    must deal the rows alike, as scans of files do; where they don't, the job fails instead of mixing words.
    """
    spark = docs.sparkSession
    text = tokenizer_text(tokenizer_path)
    specials = [t["content"] for t in json.loads(text)["added_tokens"]]
    tokenizer = spark.sparkContext.broadcast(text)
    pieces = spark.sparkContext.broadcast(tuple(x.tobytes() for x in byte_pieces(text)))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.bodies(docs, id_col, text_col)
    words = (rows.mapInArrow(_split(buckets, specials, "words"), BLOCK)
             .repartition("bucket").sortWithinPartitions("bucket")
             .mapInArrow(_encoder(tokenizer), BLOCK))
    texts = rows.mapInArrow(_split(buckets, specials, "texts"), BLOCK)
    return (texts.groupBy("block").cogroup(words.groupBy("block"))
            .applyInArrow(_joiner(pieces), "doc_id long, ids binary, decoded string"))


def op5_bpe(spark, sf_dir: str) -> DataFrame:
    """Number and digest of every document's ids, and digest of the text they decode to."""
    out = encode_decode(documents.read(spark, sf_dir, "documents"), public_path("byte_bpe_50k.json"))
    return out.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))

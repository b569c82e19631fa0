"""BPE encoding and decoding through a table of distinct words.

1. Split: texts are cut into words at boundaries that the tokenizer's own
   splitting can never cross, so a text's ids are its words' ids in order.
   A scan task groups its documents into blocks of bounded size; a block has
   its own list of distinct words, and each document becomes a sequence of
   word numbers.
2. Encode: the blocks' words meet by hash buckets of words, packed, and each
   distinct word is encoded once, by the tokenizers library.
3. Join back: the ids go to their blocks by block key, and replace the word
   numbers by position.
4. Decode: each id is looked up in the id-to-piece table, whose size the
   vocabulary bounds.

Only word lists and word numbers are shuffled, never texts. The split runs
once for the word lists and once for the numbers. A block's key is a hash of
its documents and texts, so both runs agree whatever the task or executor; a
word without ids raises.

Defined results: null and empty texts have no ids and decode to ''; repeated
rows give repeated results; a very long text is a block of its own; other
columns are not used.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meridian.llm.common import ship, tidy, utf8

BLOCK_BYTES = 8 << 20    # text bytes of a block
CHUNK_WORDS = 1 << 18    # words whose ids are put together at once

# The code points of Unicode's White_Space property
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WORD = re.compile(f"[{WHITE_SPACE}]?[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+(?=[{WHITE_SPACE}][^{WHITE_SPACE}])|[{WHITE_SPACE}]+")


class WordSplitter:
    """Cuts a text where a byte-level tokenizer always cuts: before the last
    white-space character ahead of a word, after a word, and around special
    tokens."""

    def __init__(self, tokenizer_json: str):
        special = [re.escape(t["content"]) for t in json.loads(tokenizer_json)["added_tokens"]]
        self.special = re.compile("(" + "|".join(special) + ")") if special else None

    def words(self, text: str) -> list[str]:
        if self.special is None or not self.special.search(text):
            return _WORD.findall(text)
        out: list[str] = []
        for i, part in enumerate(self.special.split(text)):
            out.extend([part] if i % 2 else _WORD.findall(part))
        return out


def byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves,
    the others in order for the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def id_to_piece(tokenizer_json: str) -> list[bytes]:
    """The bytes of each id."""
    spec, byte = json.loads(tokenizer_json), byte_of_char()
    vocab = spec["model"]["vocab"]
    out = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]))
    for piece, i in vocab.items():
        out[i] = bytes(byte[c] for c in piece)
    for t in spec["added_tokens"]:
        out[t["id"]] = t["content"].encode()
    return out


def _blocks(batches, limit: int):
    """(documents' ids as Arrow chunks, texts) of each block of a task."""
    ids, texts, size = [], [], 0
    for batch in batches:
        text, start = batch.column("_utf8"), 0
        sizes = pc.binary_length(text).to_numpy(zero_copy_only=False)
        for i, n in enumerate(sizes.tolist()):
            size += n
            if size >= limit or i + 1 == len(sizes):
                ids.append(batch.column("_id").slice(start, i + 1 - start))
                texts.extend(text.slice(start, i + 1 - start).to_pylist())
                start = i + 1
                if size >= limit:
                    yield pa.chunked_array(ids), texts
                    ids, texts, size = [], [], 0
    if texts:
        yield pa.chunked_array(ids), texts


def _key(ids: pa.ChunkedArray, texts: list[bytes]) -> int:
    h = xxhash.xxh3_64(repr(ids.to_pylist()).encode())
    for t in texts:
        h.update(len(t).to_bytes(8, "little"))
        h.update(t)
    return h.intdigest() - (1 << 63)


def _pack(values: np.ndarray) -> bytes:
    """Compressed unsigned 32-bit values, like bytes together."""
    planes = np.ascontiguousarray(values, dtype="<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes)


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def _word_lists(tokenizer_json: str, limit: int, buckets: int):
    """A block's distinct words, one row for each hash bucket of words: their
    numbers (as steps), byte lengths and bytes."""
    def run(batches):
        split, pack = WordSplitter(tokenizer_json).words, zstandard.ZstdCompressor(level=1)
        for ids, texts in _blocks(batches, limit):
            seen: dict[str, None] = {}
            for t in texts:
                seen.update(dict.fromkeys(split(t.decode("utf-8"))))
            if not seen:
                continue
            key, words = _key(ids, texts), [w.encode() for w in seen]
            del seen
            bucket = np.array([xxhash.xxh32_intdigest(w) for w in words], np.int64) % buckets
            order = np.argsort(bucket, kind="stable")
            found, first = np.unique(bucket[order], return_index=True)
            rows = []
            for part in np.split(order, first[1:]):
                own = [words[i] for i in part]
                rows.append((_pack(np.diff(part, prepend=0)), _pack(np.array([len(w) for w in own])), pack.compress(b"".join(own))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(rows), key)), pa.array(found.astype(np.int32)),
                 *(pa.array(c, pa.binary()) for c in zip(*rows))], names=["block", "bucket", "steps", "lengths", "words"])
    return run


def _word_numbers(tokenizer_json: str, limit: int, id_type: pa.DataType):
    def run(batches):
        split = WordSplitter(tokenizer_json).words
        for ids, texts in _blocks(batches, limit):
            seen: dict[str, int] = {}
            put = seen.setdefault
            parts = [np.array([put(w, len(seen)) for w in split(t.decode("utf-8"))], dtype=np.uint32) for t in texts]
            numbers = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([_key(ids, texts)], pa.int64()), pa.array([ids.to_pylist()], pa.list_(id_type)),
                 pa.array([[len(p) for p in parts]], pa.list_(pa.int64())),
                 pa.array([_pack(numbers)], pa.binary())], names=["block", "ids", "words", "numbers"])
    return run


def _encode_words(tokenizer_json: str):
    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tok = Tokenizer.from_str(tokenizer_json)
        tok.no_truncation()
        tok.no_padding()
        bucket, known = None, {}  # a bucket's rows follow each other, also from batch to batch
        for batch in batches:
            out = []
            for row in batch.select(["bucket", "lengths", "words"]).to_pylist():
                if row["bucket"] != bucket:
                    bucket, known = row["bucket"], {}
                text = zstandard.ZstdDecompressor().decompress(row["words"])
                ends = np.cumsum(_unpack(row["lengths"]), dtype=np.int64).tolist()
                words = [text[i:j] for i, j in zip([0, *ends], ends)]
                new = [w for w in words if w not in known]
                coded = tok.encode_batch([w.decode("utf-8") for w in new], add_special_tokens=False)
                known.update(zip(new, (e.ids for e in coded)))
                ids = [known[w] for w in words]
                out.append((_pack(np.array([len(x) for x in ids])), _pack(np.array([i for x in ids for i in x]))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("steps"), *(pa.array(c, pa.binary()) for c in zip(*out))] if out else
                [batch.column("block"), batch.column("steps"), pa.array([], pa.binary()), pa.array([], pa.binary())],
                names=["block", "steps", "sizes", "ids"])
    return run


def _join_back(tokenizer_json: str, id_type: pa.DataType, decode: bool):
    names = ["_id", "ids"] + ["decoded"] * decode
    types = [id_type, pa.binary()] + [pa.string()] * decode
    table: list[list[bytes]] = []   # read once a task

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not table:
            table.append(id_to_piece(tokenizer_json) if decode else [])
        pieces = table[0]
        # a repeated block repeats its rows
        rows = sorted({(r["steps"], r["sizes"], r["ids"]) for r in right.select(["steps", "sizes", "ids"]).to_pylist()})
        join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        number = join([np.cumsum(_unpack(r[0]), dtype=np.int64) for r in rows], np.int64)
        size = join([_unpack(r[1]) for r in rows], np.int64)
        pool = join([_unpack(r[2]) for r in rows], np.uint32)
        del rows, right
        order = np.argsort(number)
        if not np.array_equal(number[order], np.arange(len(order))):
            raise RuntimeError("a block's words and their ids do not match")
        start = (np.cumsum(size) - size)[order]
        size = size[order]
        doc_ids, out_ids, out_text = [], [], []
        for row in left.select(["ids", "words", "numbers"]).to_pylist():
            numbers = _unpack(row["numbers"])
            if len(numbers) and int(numbers.max()) >= len(order):
                raise RuntimeError("a block's words and their ids do not match")
            at = 0
            for n in row["words"]:
                got = []
                for a in range(at, at + n, CHUNK_WORDS):
                    word = numbers[a:min(a + CHUNK_WORDS, at + n)]
                    k = size[word]
                    shift = start[word] - (np.cumsum(k) - k)
                    got.append(pool[np.repeat(shift, k) + np.arange(int(k.sum()))])
                at += n
                ids = np.concatenate(got) if got else pool[:0]
                out_ids.append(ids.tobytes())
                if decode:
                    out_text.append(b"".join([pieces[i] for i in ids.tolist()]).decode("utf-8", "replace"))
            doc_ids.extend(row["ids"])
        cols = [doc_ids, out_ids] + [out_text] * decode
        return pa.table([pa.array(c, t) for c, t in zip(cols, types)], names=names)
    return run


def encode(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text",
           decode: bool = True, block_bytes: int = BLOCK_BYTES, buckets: int | None = None) -> DataFrame:
    """Per row of ``docs``: ``_id``, ``ids`` (binary, little-endian unsigned
    32-bit) and, with ``decode``, ``decoded``, the text that the ids give."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    src = docs.select(F.col(doc_id).alias("_id"), utf8(text).alias("_utf8"))
    kind = src.schema["_id"].dataType
    id_type = src.limit(0).toArrow().schema.field("_id").type
    n = buckets or max(64, 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    words = src.mapInArrow(tidy(_word_lists(spec, block_bytes, n)),
                           "block long, bucket int, steps binary, lengths binary, words binary")
    coded = (words.repartition("bucket").sortWithinPartitions("bucket")
             .mapInArrow(tidy(_encode_words(spec)), "block long, steps binary, sizes binary, ids binary"))
    numbers = src.mapInArrow(tidy(_word_numbers(spec, block_bytes, id_type)), T.StructType([
        T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(kind)),
        T.StructField("words", T.ArrayType(T.LongType())), T.StructField("numbers", T.BinaryType())]))
    out = T.StructType([T.StructField("_id", kind), T.StructField("ids", T.BinaryType())]
                       + [T.StructField("decoded", T.StringType())] * decode)
    return (numbers.groupBy("block").cogroup(coded.groupBy("block"))
            .applyInArrow(_join_back(spec, id_type, decode), out))


def digests(encoded: DataFrame) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``."""
    return encoded.select(F.col("_id").alias("doc_id"), (F.length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


ship(__name__)

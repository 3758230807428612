"""Byte-level BPE encoding and decoding with forced-boundary splitting.

A pair of bytes that never occurs side by side inside any vocabulary token marks a certain cut:
no merge can cross it. Texts are first split at special tokens and by the public pre-token
pattern (also certain cuts), then at those byte pairs; the fragments are encoded independently and
the ids concatenated. A fragment is merged lowest rank first, leftmost on ties, long ones with a heap
over a linked list, so a very long fragment costs n log n. Frequent pre-tokens are remembered in a table
of bounded size per Python worker; texts never leave their task and nothing is shuffled.

Decoding joins the bytes of the ids and reads them as UTF-8 (replacement character for bytes that
are none).

Defined results: NULL and empty texts give no ids and the empty text; repeated rows are separate
rows; an empty table gives no rows. The tokenizer file is a parameter and is read by the driver once.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import use_package

#: The byte-level pre-token pattern (public). Fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Remembered pre-tokens per worker, and the longest that is remembered (bytes).
REMEMBERED, REMEMBERED_BYTES = 400_000, 64
#: Fragments up to this many bytes are merged by plain scans, which are faster than a heap there.
SHORT = 48
_NEVER = (1 << 62, -1)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: printable bytes as they are, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_tables(path: str) -> dict:
    """What the encoder needs of a byte-level ``tokenizer.json``: token bytes, merges, special tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = byte_letters()
    to_bytes = lambda token: bytes(letters[c] for c in token)
    vocab = {to_bytes(t): i for t, i in spec["model"]["vocab"].items()}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    return {
        "vocab": vocab,
        "merges": [(to_bytes(a), to_bytes(b)) for a, b in pairs],
        "special": {t["content"]: t["id"] for t in spec["added_tokens"]},
    }


class Encoder:
    def __init__(self, tables: dict):
        self.vocab, self.special = tables["vocab"], tables["special"]
        self.tokens = {i: t for t, i in self.vocab.items()} | {i: t.encode() for t, i in self.special.items()}
        # (left id, right id) -> (rank, merged id)
        self.merges = {(self.vocab[a], self.vocab[b]): (r, self.vocab[a + b]) for r, (a, b) in reversed([*enumerate(tables["merges"])])}
        self.byte_id = [self.vocab[bytes([b])] for b in range(256)]
        self.joined = np.zeros((256, 256), bool)  # byte pairs inside some token
        for t in self.vocab:
            for a, b in zip(t, t[1:]):
                self.joined[a, b] = True
        self.joined_bytes = self.joined.tobytes()
        self.pattern = regex.compile(PATTERN)
        self.splits = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.known: dict[str, tuple[bytes, str, int, bytes]] = {}

    def fragments(self, data: bytes) -> list[bytes]:
        """``data`` cut at every byte pair that no token holds."""
        if len(data) < 64:
            joined = self.joined_bytes
            cuts = [i for i in range(1, len(data)) if not joined[data[i - 1] << 8 | data[i]]]
        else:
            a = np.frombuffer(data, np.uint8)
            cuts = (np.flatnonzero(~self.joined[a[:-1], a[1:]]) + 1).tolist()
        return [data[i:j] for i, j in zip([0, *cuts], [*cuts, len(data)])]

    def merge(self, data: bytes) -> list[int]:
        """Ids of one fragment."""
        ids = [self.byte_id[b] for b in data]
        n, merges = len(ids), self.merges
        if n <= SHORT:
            ranks = [merges.get(p, _NEVER)[0] for p in zip(ids, ids[1:])]
            while ranks and (rank := min(ranks)) < _NEVER[0]:
                i = ranks.index(rank)
                ids[i : i + 2] = [merges[ids[i], ids[i + 1]][1]]
                del ranks[i]
                if i:
                    ranks[i - 1] = merges.get((ids[i - 1], ids[i]), _NEVER)[0]
                if i < len(ranks):
                    ranks[i] = merges.get((ids[i], ids[i + 1]), _NEVER)[0]
            return ids
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, left, right, new = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue  # one side was merged meanwhile
            ids[i], ids[j], k = new, -1, after[j]
            after[i] = k
            after[j] = -1
            if k >= 0:
                before[k] = i
                if m := merges.get((new, ids[k])):
                    heapq.heappush(heap, (m[0], i, new, ids[k], m[1]))
            h = before[i]
            if h >= 0 and (m := merges.get((ids[h], new))):
                heapq.heappush(heap, (m[0], h, ids[h], new, m[1]))
        return [x for x in ids if x >= 0]

    def piece(self, text: str) -> tuple[bytes, str, int, bytes]:
        """Of one pre-token: ids as int32 bytes, ids as decimals, their number, their decoded bytes."""
        data = text.encode()
        ids = [i for part in self.fragments(data) for i in self.merge(part)]
        out = array("i", ids).tobytes(), ",".join(map(str, ids)), len(ids), b"".join(map(self.tokens.__getitem__, ids))
        if len(data) <= REMEMBERED_BYTES:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[text] = out
        return out

    def pieces(self, text: str) -> list[tuple[bytes, str, int, bytes]]:
        known, out = self.known, []
        for part in self.splits.split(text) if self.splits and any(s in text for s in self.special) else [text]:
            if (i := self.special.get(part)) is not None:
                out.append((np.int32(i).tobytes(), str(i), 1, self.tokens[i]))
            else:
                out += [known.get(token) or self.piece(token) for token in self.pattern.findall(part)]
        return out


def decode(encoder: Encoder, ids) -> str:
    return b"".join(encoder.tokens[i] for i in ids).decode("utf-8", "replace")


#: One encoder per tokenizer file and Python worker.
_ENCODERS: dict[str, Encoder] = {}


def encode_docs(docs: DataFrame, path: str, text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """The columns of ``docs`` but the text as the struct ``doc``, with ``n_tokens``, ``ids_sha256``, ``decoded_sha256``; with ``token_ids`` if asked for."""
    use_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(load_tables(path))  # the vocabulary: fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _ENCODERS:
            _ENCODERS[path] = Encoder(shared.value)
        encoder = _ENCODERS[path]
        for batch in batches:
            numbers, id_hashes, text_hashes, ids = [], [], [], []
            for text in batch.column(1):
                found = encoder.pieces(text.as_py() or "")
                numbers.append(sum(p[2] for p in found))
                id_hashes.append(hashlib.sha256(",".join([p[1] for p in found]).encode()).hexdigest())
                decoded = b"".join([p[3] for p in found]).decode("utf-8", "replace")
                text_hashes.append(hashlib.sha256(decoded.encode()).hexdigest())
                if with_ids:
                    ids.append(b"".join([p[0] for p in found]))
            columns = [batch.column(0), pa.array(numbers, pa.int64()), pa.array(id_hashes, pa.string()), pa.array(text_hashes, pa.string())]
            names = ["doc", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), np.int32))))
                names.append("token_ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() != text_col.lower()]
    rows = docs.select(F.struct(*rest).alias("doc") if rest else F.struct(F.lit(None).cast("int").alias("none")).alias("doc"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["doc"]]).add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    if with_ids:
        schema = schema.add("token_ids", T.ArrayType(T.IntegerType()))
    return rows.mapInArrow(run, schema)

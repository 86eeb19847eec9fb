"""Sum-of-squares packing of tokenized documents into sequences of a fixed length.

A document is placed where the sum over all residual gaps g of (number of open bins with gap g) squared
becomes smallest; opening a bin is weighed like any other place. Only once what is left to place is no more
than the room in open bins, a bin is opened just where nothing fits. Only lengths matter, so the packing runs over
spans (document, piece, start, length): the tokens themselves are neither shuffled nor held. Pieces are dealt by
hash into groups of a bounded number, each packed on its own, longest first; the bins a group leaves open are
few next to the bins it fills, and their number doesn't grow with the input.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideway.llm import text_kernel as K
from strideway.plans.lineage import cut

CAPACITY = 2048
#: The id that ends each document.
END = 0
#: Pieces in a group, about; a group is packed in one task.
GROUP = 16_384
#: Equal pieces that are numbered at once.
RUN = 65_536
#: Fixed value: how the vocabulary's merges were split into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Latin text, where both tokenizer libraries split words alike without a doubt.
_PLAIN = bytes([9, 10, 13, *range(32, 127), *range(161, 173), *range(174, 256)])


def _byte_of() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable Latin-1 as itself, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


@functools.lru_cache(maxsize=2)
def _encoders(path: str):
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    byte_of = _byte_of()
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    ranks = {bytes(byte_of[c] for c in token): rank for token, rank in vocabulary.items() if all(c in byte_of for c in token)}
    added = tuple(t.content for t in slow.get_added_tokens_decoder().values())
    ranks = {token: rank for token, rank in ranks.items() if token.decode("utf-8", "replace") not in added}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), slow, added


def token_ids(text: str | None, tokenizer: str) -> np.ndarray:
    """The text's ids as the tokenizer file gives them (``add_special_tokens=False``), as little-endian 32-bit numbers.

    Latin text goes through a faster implementation of the same merges; any other text, and one that spells an added
    token of the file, through the file's own library.
    """
    if not text:
        return np.zeros(0, dtype="<u4")
    fast, slow, added = _encoders(tokenizer)
    try:
        plain = not text.encode("latin-1").translate(None, _PLAIN) and not any(x in text for x in added)
    except UnicodeEncodeError:
        plain = False
    if plain:
        return fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)
    return np.array(slow.encode(text, add_special_tokens=False).ids, dtype="<u4")


def piece_spans(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole if it fits, else full pieces after a first one with the rest."""
    if n <= capacity:
        return [(0, n)]
    rest = n % capacity
    return [(0, rest)] * bool(rest) + [(a, capacity) for a in range(rest, n, capacity)]


def _pieces(tokenizer: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(token_ids(text.as_py(), tokenizer), np.array([END], dtype="<u4"))
                rows += [(doc_id, k, a, n, zlib.crc32(ids[a : a + n].tobytes())) for k, (a, n) in enumerate(piece_spans(len(ids), capacity))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if k == 1 else pa.int64()) for k, c in enumerate(zip(*rows, strict=True))] if rows else [pa.array([], pa.int32() if k == 1 else pa.int64()) for k in range(5)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length, placed in the order given; all lengths are from 1 to ``capacity``.

    Of the gaps g that a length fits into, and a new bin, the one that leaves the smallest sum of squared counts is taken, the smallest
    gap of equal ones. Once the lengths that are left are no longer than the room in open bins, a new bin is taken only where nothing fits.
    """
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    counts = np.zeros(capacity + 1)  # open bins by gap; gap 0 is no open bin, and a new bin has the whole capacity
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    new, left, room = 0, int(lengths.sum()), 0
    for i, size in enumerate(lengths.tolist()):
        # A bin that goes from gap g to g - size changes the sum by 2 * (counts[g - size] - counts[g] + 1); one that closes, or a new one, by one side of that.
        own = counts[size:]
        change = 2 * (counts[: capacity - size + 1] - own + 1)
        change[0] = 1 - 2 * own[0]
        change[own == 0] = np.inf
        if size == capacity:
            change[-1] = 0
        elif left > room or not own.any():
            change[-1] = 2 * counts[capacity - size] + 1
        gap = size + int(change.argmin())
        if gap < capacity:
            counts[gap] -= 1
            room -= size
            b = open_bins[gap].pop()
        else:
            b, new, room = new, new + 1, room + capacity - size
        bins[i], offsets[i] = b, capacity - gap
        if gap > size:
            counts[gap - size] += 1
            open_bins[gap - size].append(b)
        left -= size
    return bins, offsets


def _pack(capacity: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        bins, offsets = sum_of_squares(group.column("length").to_numpy(), capacity)
        at = group.column("bucket").to_numpy().astype(np.int64)
        return group.drop_columns(["bucket"]).append_column("sequence_id", pa.array((at << 32) + bins)).append_column("offset", pa.array(offsets))

    return run


def pack(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its text's ids by the tokenizer file, without special tokens, then id 0. Documents of at
    most ``capacity`` tokens are one piece; longer ones are cut into pieces of ``capacity``, of which the
    first may be shorter. Each sequence holds pieces of together at most ``capacity`` tokens, at gapless
    offsets from 0. ids_crc32 is of the piece's ids as little-endian unsigned 32-bit numbers.

    Text that spells a special token gets that token's id, as the file's library gives it. Null and empty texts are one piece of one token. Repeated rows, and rows without doc_id, are each
    packed. Ties in length go by doc_id, then piece. An empty table gives no rows. Other columns are ignored.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    pieces = cut(docs.mapInArrow(K.tidy(_pieces(tokenizer, capacity)), schema), "pack-pieces")
    groups = -(-pieces.count() // GROUP)
    if not groups:
        return pieces.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    # Equal pieces are counted, then numbered, so that the groups depend on the rows alone and rows that repeat spread over them.
    own = pieces.columns
    counted = pieces.groupBy(*own).agg(F.count(F.lit(1)).alias("n"))
    runs = counted.select(*own, "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(RUN))).alias("first"))
    each = runs.select(*own, F.explode(F.sequence("first", F.least(F.col("n"), F.col("first") + RUN) - 1)).alias("number"))
    dealt = each.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "length", "ids_crc32", "number"), F.lit(groups)).cast("int")).drop("number")
    return dealt.groupBy("bucket").applyInArrow(K.tidy(_pack(capacity)), schema + ", sequence_id long, offset long")

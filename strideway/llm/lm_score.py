"""Language-model scores: prediction by partial matching over bytes, next to a smoothed word-count base.

The model is a trie of byte contexts of up to five symbols, learnt from all training documents. A text's
words (A-Z lower-cased) are joined by single spaces and followed by an end symbol; the alphabet has 257 symbols, the end
and every byte. A symbol that its longest context has seen gets (count - 1/2) / total;
else the context escapes, with probability distinct / 2 / total, to the next shorter one, where the symbols that
the longer one has seen are excluded, down to a uniform choice. Symbols that a context excludes depend on that context alone, so each
context carries the totals that are left below it, and scoring is a few look-ups for each symbol.

All contexts that were counted are kept, in hash partitions: blocks of bounded size send their distinct codes (of
six symbols) with their training counts to the partition of the last three symbols of the context, which has so all
that it needs of contexts of three to five symbols, and sends each block its codes' scores. What all partitions get are the counted
codes of three symbols, 257^3 numbers at most whatever the input.

The base needs each word's exact count. The same blocks send their distinct words (as 64-bit hashes)
with counts to hash partitions, which add them up and send each block its words' totals; a frequent word
is so one entry per block, and documents meet the totals as arrays, never as a row per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideway.llm import text_kernel as K
from strideway.plans.lineage import cut, discard

FOLDS, HELD_OUT = 7, 2
#: The end, then the bytes.
SYMBOLS = 257
END, SPACE = 0, 33
#: Symbols of the longest context.
ORDER = 5
#: Words of a block, about; a block's dictionary is held by one task.
BLOCK_WORDS = 1_000_000
#: Bytes of a block, about, where its words are long.
BLOCK_BYTES = 8 << 20
#: Bytes of text for each hash partition of the words and codes.
PARTITION_BYTES = 16 << 20
#: Contexts whose whole alphabets are held at once.
_ROWS = 1024
_LOG = np.log10

#: A block's words (kind 0) or codes (2) of one partition as x, with training counts as y; or its documents (1) as x.
_WORK = "kind int, block long, p int, x binary, y binary"


def symbols_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, where each document starts).

    Each document is ``ORDER`` ends, its words with a space between, and an end.
    """
    data = K.LOWER[data]
    starts, ends, first = K.word_spans(data, offsets, K.SPACES)
    docs, words = len(offsets) - 1, np.diff(first)
    lengths = ends - starts
    size = np.zeros(docs + 1, dtype=np.int64)
    total = np.concatenate([[0], np.cumsum(lengths + 1)])
    size[1:] = np.cumsum(ORDER + np.maximum(1, total[first[1:]] - total[first[:-1]]))
    out = np.full(size[-1], SPACE, dtype=np.int32)
    for k in range(ORDER):
        out[size[:-1] + k] = END
    out[size[1:] - 1] = END
    of = np.repeat(np.arange(docs), words)
    begin = size[of] + ORDER + total[:-1] - total[first[of]]
    before = np.cumsum(lengths) - lengths
    run = np.arange(int(lengths.sum()))
    out[np.repeat(begin - before, lengths) + run] = data[np.repeat(starts - before, lengths) + run].astype(np.int32) + 1
    return out, size


def codes_of(out: np.ndarray) -> np.ndarray:
    """The code of the ORDER + 1 symbols that end at each place from there on."""
    n = max(0, len(out) - ORDER)
    code = np.zeros(n, dtype=np.int64)
    for k in range(ORDER + 1):
        code = code * SYMBOLS + out[k : k + n]
    return code


def _own_places(size: np.ndarray) -> np.ndarray:
    """Of the codes' places, those that don't end on a document's leading ends."""
    own = np.ones(size[-1], dtype=bool)
    for k in range(ORDER):
        own[size[:-1] + k] = False
    return own[ORDER:]


def _escape_step(own: np.ndarray, excluded: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Probabilities at contexts with counts ``own`` where ``excluded`` symbols can't come; ``below``: after an escape."""
    free = np.where(excluded, 0.0, own)
    seen = free > 0
    total, distinct = free.sum(axis=-1, keepdims=True), seen.sum(axis=-1, keepdims=True)
    all_seen = ((own > 0) | excluded).all(axis=-1, keepdims=True)
    room = np.maximum(total, 1)
    escape = np.where(distinct > 0, np.where(all_seen, 0, distinct / 2) / room, 1.0)
    return np.where(seen, (free - np.where(all_seen, 0, 0.5)) / room, escape * below)


def _find(have: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The position of each key among sorted ones, -1 if there is none."""
    if not len(have):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(have, keys), len(have) - 1)
    return np.where(have[at] == keys, at, -1)


def _planes(x: np.ndarray) -> bytes:
    """Numbers as all their first bytes, then all second ones, and so on, which compress well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _from_planes(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


def _packed(sorted_codes: np.ndarray) -> bytes:
    """Sorted codes as differences."""
    return _planes(np.diff(sorted_codes, prepend=0).astype(np.int64))


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(_from_planes(data, np.int64))


def _packed_rows(rows: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(rows)
    return out.getvalue().to_pybytes()


def _by_partition(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, cuts): hashes of words by the partition where they are added up."""
    p = (hashes % np.uint64(parts)).astype(np.int64)
    order = np.argsort(p, kind="stable")
    return order, np.searchsorted(p[order], np.arange(parts + 1))


def _collect(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        schema = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("p", pa.int32()), ("x", pa.binary()), ("y", pa.binary())])
        block, rows, words, grams, held_words, held_bytes = TaskContext.get().partitionId() << 24, [], [], [], 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal block, rows, words, grams, held_words, held_bytes
            if not rows:
                return
            hashes, at = np.unique(np.concatenate([h for h, _ in words]), return_inverse=True)
            n = np.bincount(at, weights=np.concatenate([w for _, w in words]), minlength=len(hashes)).astype(np.uint32)
            order, cuts = _by_partition(hashes, parts)
            hashes, n = hashes[order], n[order]
            out = [(0, block, k, hashes[a:b].tobytes(), _planes(n[a:b])) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
            out.append((1, block, None, _packed_rows(pa.Table.from_batches(rows)), None))
            # A code and a bit that tells held-out places, which ask for a score but aren't counted.
            marked, n = np.concatenate([c for c, _ in grams]), np.concatenate([k for _, k in grams])
            codes, at = np.unique(marked >> 1, return_inverse=True)
            n = np.bincount(at, weights=np.where(marked & 1, 0, n), minlength=len(codes)).astype(np.uint32)
            order, cuts = _dealt(codes, parts)
            codes, n = codes[order], n[order]
            out += [(2, block, k, _packed(codes[a:b]), _planes(n[a:b])) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
            block, rows, words, grams, held_words, held_bytes = block + 1, [], [], [], 0, 0
            for a in range(0, len(out), 4000):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[a : a + 4000], strict=True), schema, strict=True)], schema=schema)

        for batch in batches:
            data, offsets = K.raw_bytes(batch.column(1))
            held = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, b in K.chunks(offsets):
                part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                hashes, first = K.word_hashes(part, own, K.SPACES)
                rows.append(batch.slice(a, b - a))
                found, at = np.unique(hashes, return_inverse=True)
                words.append((found, np.bincount(at, weights=1 - np.repeat(held[a:b], np.diff(first)), minlength=len(found))))
                held_words, held_bytes = held_words + len(hashes), held_bytes + len(part)
                out, size = symbols_of(part, own)
                use, away = _own_places(size), np.repeat(held[a:b], np.diff(size))[ORDER:]
                grams.append(np.unique((codes_of(out)[use] << 1) | away[use], return_counts=True))
                if held_words >= BLOCK_WORDS or held_bytes >= BLOCK_BYTES:
                    yield from flush()
        yield from flush()

    return run


def _totals(group: pa.Table) -> pa.Table:
    """Each word's count over all blocks, for every block that has the word; and a row with the distinct and all training words."""
    hashes = [np.frombuffer(x, dtype=np.uint64) for x in group.column("x").to_pylist()]
    values, at = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.bincount(at, weights=np.concatenate([_from_planes(y, np.uint32) for y in group.column("y").to_pylist()]), minlength=len(values)).astype(np.int64)
    cuts = np.cumsum([0, *map(len, hashes)])
    sums = [_planes(total[at[a:b]]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    p = group.column("p")[0].as_py()
    blocks = [*group.column("block").to_pylist(), -1]
    return pa.table({"block": pa.array(blocks, pa.int64()), "p": pa.array([p] * len(blocks), pa.int32()), "totals": pa.array([*sums, b""], pa.binary()), "distinct": pa.array([0] * len(sums) + [int((total > 0).sum())], pa.int64()), "words": pa.array([0] * len(sums) + [int(total.sum())], pa.int64())})


def _dealt(codes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, cuts): codes by the partition where they are added up; all whose contexts end on the same three symbols go together."""
    home = (K.mix((codes // SYMBOLS % SYMBOLS**3).astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(home, kind="stable")
    return order, np.searchsorted(home[order], np.arange(parts + 1))


def _short_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training counts of codes of three symbols."""
    codes, counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    for batch in batches:
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            n = _from_planes(y, np.uint32).astype(np.int64)
            more, at = np.unique(_unpacked(x)[n > 0] % SYMBOLS**3, return_inverse=True)
            merged, into = np.unique(np.concatenate([codes, more]), return_inverse=True)
            counts = np.bincount(into, np.concatenate([counts, np.bincount(at, n[n > 0], len(more))]), len(merged)).astype(np.int64)
            codes = merged
    yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.array(counts, pa.int64())], names=["i", "n"])


def _in_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays([pa.array([batch.column(k).to_numpy().tobytes()], pa.binary()) for k in (0, 1)], names=["i", "n"])


class Short:
    """Counts of codes of three symbols (sorted), and what follows from them for shorter contexts."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        s = SYMBOLS
        self.codes, self.counts = codes, counts.astype(np.float64)
        self.c1 = np.bincount(codes % s**2, self.counts, s**2).reshape(s, s)
        c0 = self.c1.sum(axis=0)
        uniform = np.full((s, s), 1.0 / max(1, int((c0 == 0).sum())))
        self.q0 = _escape_step(c0[None, :], self.c1 > 0, uniform)  # after a context of one symbol has escaped

    def after_three(self, contexts: np.ndarray, seen: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """log10 probability of each symbol after its context of three has escaped; ``seen``: sorted codes of what such contexts have seen."""
        s = SYMBOLS
        each, at = np.unique(contexts, return_inverse=True)
        out, order = np.empty(len(contexts)), np.argsort(at, kind="stable")
        for a in range(0, len(each), _ROWS):
            some = each[a : a + _ROWS]
            two, one = some % s**2, some % s
            lo, hi = np.searchsorted(self.codes, two * s), np.searchsorted(self.codes, (two + 1) * s)
            row, places = np.repeat(np.arange(len(some)), hi - lo), np.repeat(lo - (np.cumsum(hi - lo) - (hi - lo)), hi - lo) + np.arange(int((hi - lo).sum()))
            c2 = np.zeros((len(some), s))
            c2[row, self.codes[places] % s] = self.counts[places]
            own = np.zeros((len(some), s), dtype=bool)
            mine = seen[np.searchsorted(seen, some[0] * s) : np.searchsorted(seen, (some[-1] + 1) * s)]
            of = _find(some, mine // s)
            own[of[of >= 0], mine[of >= 0] % s] = True
            q1 = _escape_step(self.c1[one], c2 > 0, self.q0[one])
            q2 = _escape_step(c2, own, q1)
            use = order[np.searchsorted(at[order], a) : np.searchsorted(at[order], a + len(some))]
            out[use] = _LOG(np.maximum(q2[at[use] - a, symbols[use]], 1e-300))
        return out


def code_scores(codes: np.ndarray, counts: np.ndarray, short: Short) -> np.ndarray:
    """log10 probability of the last symbol of each code after its first five.

    ``codes`` are sorted, with their training counts (0 where only held-out texts have them), and hold all counted
    codes whose contexts end on the same three symbols as one of them; ``short`` has the counts of all codes of three symbols.
    """
    s = SYMBOLS
    out, left = np.zeros(len(codes)), np.arange(len(codes))
    have, n = codes[counts > 0], counts[counts > 0].astype(np.float64)
    longer = longer_contexts = None
    for size in range(ORDER + 1, 3, -1):
        if size <= ORDER:
            have, at = np.unique(have % s**size, return_inverse=True)
            n = np.bincount(at, weights=n, minlength=len(have))
        contexts, at = np.unique(have // s, return_inverse=True)
        total, distinct = np.bincount(at, n, len(contexts)), np.bincount(at, minlength=len(contexts))
        # A place that comes from a longer context has what that one leaves, else all.
        code = codes[left] % s**size
        mine = _find(contexts, code // s)
        room, kinds = np.where(mine >= 0, total[mine] if len(total) else 0, 0.0), np.where(mine >= 0, distinct[mine] if len(total) else 0, 0)
        full = kinds >= s
        if longer is not None and len(longer):
            ends = np.searchsorted(have, longer % s**size)
            of = np.searchsorted(longer_contexts, longer // s)
            taken, gone = np.bincount(of, n[ends], len(longer_contexts)), np.bincount(of, minlength=len(longer_contexts))
            over = _find(longer_contexts, codes[left] % s ** (size + 1) // s)
            room, kinds = room - np.where(over >= 0, taken[over], 0), kinds - np.where(over >= 0, gone[over], 0)
        found = _find(have, code)
        hit = found >= 0
        # Where a context has seen every symbol nothing is kept for an escape.
        out[left[hit]] += _LOG((n[found[hit]] - np.where(full[hit], 0.0, 0.5)) / np.maximum(room[hit], 1))
        miss = ~hit & (kinds > 0)
        out[left[miss]] += _LOG(kinds[miss] / 2 / np.maximum(room[miss], 1))
        left = left[~hit]
        longer, longer_contexts = have, contexts
    last = codes[left] % s**4
    out[left] += short.after_three(last // s, have, last % s)
    return out


def _gram_scores(model):
    """Scores of the codes of all blocks in one partition, for every block."""

    def run(group: pa.Table) -> pa.Table:
        each = [_unpacked(x) for x in group.column("x").to_pylist()]
        codes, at = np.unique(np.concatenate(each), return_inverse=True)
        n = np.bincount(at, weights=np.concatenate([_from_planes(y, np.uint32) for y in group.column("y").to_pylist()])).astype(np.int64)
        scores = code_scores(codes, n, Short(*model.value)).astype(np.float32)
        cuts = np.cumsum([0, *map(len, each)])
        return pa.table({"block": group.column("block"), "p": group.column("p"), "scores": pa.array([_planes(scores[at[a:b]]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())})

    return run


def _base(train_tokens: int, distinct: int, ends: int, parts: int):
    down = float(_LOG(train_tokens + distinct + 1))

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        docs = pa.ipc.open_stream(docs.column("x")[0].as_py()).read_all()
        texts, found = docs.column("text"), found.sort_by("p")
        c = np.concatenate([_from_planes(x, np.int64) for x in found.column("totals").to_pylist() if x is not None] or [np.zeros(0, np.int64)])
        scores = np.concatenate([_from_planes(x, np.float32) for x in found.column("scores").to_pylist() if x is not None])
        data, offsets = K.raw_bytes(texts)
        each = [K.word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], K.SPACES) for a, b in K.chunks(offsets)]
        n = np.concatenate([np.diff(first) for _, first in each])
        hashes, at = np.unique(np.concatenate([h for h, _ in each]), return_inverse=True)
        order, _ = _by_partition(hashes, parts)
        count = np.empty(len(hashes), dtype=np.int64)
        count[order] = c
        of = np.repeat(np.arange(len(n)), n)
        known = np.bincount(of, count[at] > 0, len(n)).astype(np.int64) + (ends > 0)
        base = np.bincount(of, _LOG(count + 1.0)[at], len(n)) + _LOG(ends + 1.0) - (n + 1) * down
        score = score_texts(texts, scores, parts)
        return pa.table({"doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"), "n_tokens": pa.array(n + 1, pa.int64()), "n_known": pa.array(known, pa.int64()), "base_score": pa.array(base, pa.float64()), "score": pa.array(score, pa.float64())})

    return run


def score_texts(texts: pa.ChunkedArray, scores: np.ndarray, parts: int) -> np.ndarray:
    """log10 probability of each text of a block; ``scores``: of the block's distinct codes, partition by partition."""
    data, offsets = K.raw_bytes(texts)
    held = []
    for a, b in K.chunks(offsets):
        out, size = symbols_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        own = _own_places(size)
        codes, at = np.unique(codes_of(out)[own], return_inverse=True)
        held.append((codes, at.astype(np.int32), own, size))
    codes = np.unique(np.concatenate([x[0] for x in held]))
    order, _ = _dealt(codes, parts)
    by_code = np.empty(len(codes), dtype=np.float64)
    by_code[order] = scores
    out = []
    for mine, at, own, size in held:
        each = np.zeros(size[-1])
        each[ORDER:][own] = by_code[np.searchsorted(codes, mine)][at]
        out.append(np.add.reduceat(each, size[:-1]))
    return np.concatenate(out)


def lm_scores(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per document.

    Documents whose crc32(doc_id as text) mod 7 is 2 are held out; all others are trained on, and all are scored,
    over whole texts. Tokens are the words (runs of ``[^\\x20\\x09-\\x0D]``, A-Z lower-cased) and one end.
    With c the token's count, N all and V the distinct training tokens, base_score sums
    log10((c + 1) / (N + V + 1)). n_known counts tokens with c > 0. score is the log10 probability of
    the words and the end under the byte model.

    Null and empty texts hold the end alone. Rows without doc_id are trained on (their remainder counts as 0).
    Repeated rows are each counted and scored. With no training documents every token is unknown and
    the model is uniform. An empty table gives no rows. Other columns are ignored.
    """
    spark = documents.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    remainder = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), (remainder == HELD_OUT).alias("held_out"))
    size = docs.agg(F.count(F.when(~F.col("held_out"), 1)).alias("ends"), F.sum(F.octet_length("text")).alias("size")).first()
    ends, parts = size["ends"], max(1, -(-(size["size"] or 0) // PARTITION_BYTES))

    work = cut(docs.mapInArrow(K.tidy(_collect(parts)), _WORK), "lm-work", ("kind",))
    grams = work.where("kind = 2")
    summed = grams.select("x", "y").mapInArrow(K.tidy(_short_counts), "i long, n long").groupBy("i").agg(F.sum("n").alias("n"))
    short = [(np.frombuffer(r["i"], np.int64), np.frombuffer(r["n"], np.int64)) for r in summed.mapInArrow(K.tidy(_in_one), "i binary, n binary").collect()]  # SYMBOLS^3 numbers at most
    codes, counts = (np.concatenate([np.zeros(0, np.int64), *(x[k] for x in short)]) for k in (0, 1))
    by = np.argsort(codes)
    model = spark.sparkContext.broadcast((codes[by], counts[by]))
    scores = grams.select("block", "p", "x", "y").groupBy("p").applyInArrow(K.tidy(_gram_scores(model)), "block long, p int, scores binary")
    totals = cut(work.where("kind = 0").select("block", "p", "x", "y").groupBy("p").applyInArrow(K.tidy(_totals), "block long, p int, totals binary, distinct long, words long"), "lm-totals")
    sums = totals.where("block = -1").agg(F.sum("distinct").alias("v"), F.sum("words").alias("n")).first()
    train_tokens, distinct = (sums["n"] or 0) + ends, (sums["v"] or 0) + (ends > 0)
    rows = work.where("kind = 1").select("block", "x").groupBy("block")
    found = totals.where("block >= 0").select("block", "p", "totals").unionByName(scores, allowMissingColumns=True).groupBy("block")
    out = rows.cogroup(found).applyInArrow(K.tidy_pair(_base(train_tokens, distinct, ends, parts)), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"), "base_score", "score")

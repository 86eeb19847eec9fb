"""Near-duplicate documents: an inverted join of MinHash signature coordinates, confirmed on full shingle sets.

Every distinct shingle set has a signature of ``COORDINATES`` MinHash values. A (coordinate, value) pair
is a posting key. Two sets of Jaccard similarity s agree on a coordinate with probability s, so a pair of
similarity 0.75 agrees on fewer than ``MATCHES`` of them about once in a million; pairs below that are
not looked at. Two signatures that agree on MATCHES coordinates share one of the COORDINATES - MATCHES + 1
*rarest* keys of either one (prefix filter), so a set is posted under those alone, and keys that only one
set has need no posting: frequent keys, such as those of a passage that many documents share, are skipped.

A posting list never yields all its pairs. First each member meets the list's smallest one; confirmed
links make components. Then only members outside that component meet the list's other members, and only
members of other components: in tiles of bounded size that hold samples of the shingle sets, count common
shingles in memory, and yield nothing but pairs that reach the threshold. Every pair of a list is so either
tested or already connected, which leaves the components as they would be with all pairs. All links are
confirmed on the full sets, read from the whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideway.llm import text_kernel as K
from strideway.operators.components import connected_components
from strideway.plans.lineage import cut, discard

WORDS = 5
COORDINATES = 64
MATCHES = 30
#: Members of a list that one side of a tile holds, about.
PART = 1024
#: Shingles of a set that a tile compares, about; smaller sets are compared whole.
SAMPLE = 1024
#: Ids that may be broadcast, 8 bytes each; more are joined by shuffling.
BROADCAST_IDS = 1_000_000
_U = np.uint64
_SALT = K.mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * _U(0x2545F4914F6CDD1D))


def signature(shingles: np.ndarray) -> np.ndarray:
    """One posting key (coordinate and smallest value, hashed together) for each coordinate."""
    out = np.empty(COORDINATES, dtype=np.uint64)
    for a in range(0, COORDINATES, 8):
        salts = _SALT[a : a + 8, None]
        v = (shingles[None, :] ^ salts) * _U(0xBF58476D1CE4E5B9)
        v ^= v >> _U(29)
        v *= _U(0x94D049BB133111EB)
        out[a : a + 8] = v.min(axis=1)
    return K.mix(out + _SALT)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = K.raw_bytes(batch.column(1))
        for a, b in K.chunks(offsets):
            part = data[offsets[a] : offsets[b]]
            words, first = K.word_hashes(part, offsets[a : b + 1] - offsets[a], K.SPACES)
            sizes, keys, marks = [], [], []
            for s in K.shingle_hashes(words, first, WORDS):
                sizes.append(len(s))
                with np.errstate(over="ignore"):
                    keys.append(np.array([K.mix(s).sum(dtype=np.uint64) + _U(len(s)), K.mix(s ^ _SALT[0]).sum(dtype=np.uint64)], dtype=np.uint64).tobytes())
                marks.append(signature(s).view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[a:b], batch.column(2)[a:b], pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(marks, pa.list_(pa.int64()))],
                names=["doc_id", "named", "n_shingles", "set_key", "marks"],
            )


def _confirm(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = []
                for c in (2, 3):
                    data, offsets = K.raw_bytes(part.column(c))
                    mine = []
                    for a, b in K.chunks(offsets):
                        words, first = K.word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], K.SPACES)
                        mine += K.shingle_hashes(words, first, WORDS)
                    sets.append(mine)
                keep = []
                for s, t in zip(*sets, strict=True):
                    both = np.concatenate([s, t])
                    both.sort()
                    common = int(np.count_nonzero(both[1:] == both[:-1]))
                    keep.append(bool(len(both)) and 100 * common >= threshold * (len(both) - common))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _level(size: np.ndarray) -> np.ndarray:
    """How often a set of this size is halved for its sample."""
    return np.ceil(np.log2(np.maximum(1, size / SAMPLE))).astype(np.int64)


def _below(values: np.ndarray, level: int) -> np.ndarray:
    """Of ascending hashes those that are left after so many halvings."""
    return values[: np.searchsorted(values, _U(2 ** (64 - level)))] if level else values


def _samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = K.raw_bytes(batch.column(1))
        for a, b in K.chunks(offsets):
            words, first = K.word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], K.SPACES)
            sizes, kept = [], []
            for s in K.shingle_hashes(words, first, WORDS):
                sizes.append(len(s))
                kept.append(_below(np.unique(s), int(_level(np.array(len(s))))).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array(sizes, pa.int64()), pa.array(kept, pa.binary())], names=["node", "size", "sample"])


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of sets on the left with sets on the right."""
    values, at = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    n = sum(map(len, left))
    rows = [np.repeat(np.arange(len(x)), list(map(len, x))) for x in (left, right)]
    here = np.bincount(at[:n], minlength=len(values)) > 0
    there = np.bincount(at[n:], minlength=len(values)) > 0
    both = here & there
    column = np.cumsum(both) - 1
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    sides = []
    for r, x in zip(rows, (at[:n], at[n:]), strict=True):
        use = both[x]
        order = np.argsort(column[x[use]], kind="stable")
        sides.append((r[use][order], column[x[use]][order]))
    for a in range(0, int(both.sum()), 4096):
        dense = []
        for (r, c), count in zip(sides, (len(left), len(right)), strict=True):
            lo, hi = np.searchsorted(c, [a, a + 4096])
            m = np.zeros((count, 4096), dtype=np.float32)
            m[r[lo:hi], c[lo:hi] - a] = 1
            dense.append(m)
        out += dense[0] @ dense[1].T
    return out


def _tile(threshold: int, forest: bool = True):
    """Pairs of a tile's members that reach the threshold; of those that surely do, only as many as connect their members."""

    def run(group: pa.Table) -> pa.Table:
        group = group.take(np.argsort(group.column("node").to_numpy(), kind="stable"))  # so that tiles of the same members choose the same pairs
        node, component, main, size, part, i, j = (group.column(c).to_numpy() for c in ("node", "component", "main", "size", "part", "i", "j"))
        sample = [np.frombuffer(x, dtype=np.uint64) for x in group.column("sample").to_pylist()]
        level, outside = _level(size), component != main
        label = np.unique(component, return_inverse=True)[1]
        chosen: list[tuple[np.ndarray, np.ndarray]] = []
        doubtful: list[tuple[np.ndarray, np.ndarray]] = []
        for one, other in sorted({(i[0], j[0]), (j[0], i[0])}):  # members outside the main component are on the left, once on either side
            for lx in np.unique(level[outside & (part == one)]).tolist():
                x = np.flatnonzero(outside & (part == one) & (level == lx))
                for ly in (lx - 1, lx, lx + 1):
                    y = np.flatnonzero((part == other) & (level == ly))
                    if not len(y):
                        continue
                    left, right = ([_below(sample[k], max(lx, ly)) for k in side] for side in (x, y))
                    common = _common(left, right)
                    union = np.array(list(map(len, left)))[:, None] + np.array(list(map(len, right)))[None, :] - common
                    # Whole sets are compared exactly, halved ones with six standard deviations to spare.
                    spare = 10 if max(lx, ly) else 0
                    hit = 100 * common >= (threshold - spare) * union
                    hit &= component[x][:, None] != component[y][None, :]
                    sure = hit & (100 * common >= (threshold + spare) * union) if forest else np.zeros_like(hit)
                    for r in np.flatnonzero(sure.any(axis=1)):
                        c = y[sure[r]]
                        new, at = np.unique(label[c], return_index=True)
                        use = new != label[x[r]]
                        chosen.append((np.full(int(use.sum()), x[r]), c[at[use]]))
                        label[np.isin(label, new[use])] = label[x[r]]
                    r, c = np.nonzero(hit & ~sure)
                    doubtful.append((x[r], y[c]))
        if forest:
            doubtful = [(x[apart], y[apart]) for x, y in doubtful for apart in [label[x] != label[y]]]
        pairs = [np.zeros((0, 3), np.int64)]
        for sure, sides in ((1, chosen), (0, doubtful)):
            for x, y in sides:
                pairs.append(np.stack([np.minimum(node[x], node[y]), np.maximum(node[x], node[y]), np.full(len(x), sure, np.int64)], axis=1))
        out = np.unique(np.concatenate(pairs), axis=0)
        return pa.table({"a": pa.array(out[:, 0], pa.int64()), "b": pa.array(out[:, 1], pa.int64()), "sure": pa.array(out[:, 2] == 1, pa.bool_())})

    return run


def _of(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts whose doc_id is among ``ids``; the ids are broadcast if they are few enough."""
    small = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return texts.join(F.broadcast(ids) if small else ids, "doc_id", "left_semi")


def _confirmed(pairs: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose shingle sets are as similar as asked for; only texts of pairs move."""
    needed = _of(texts, pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
    with_b = pairs.join(needed.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    both = with_b.join(needed.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(K.tidy(_confirm(threshold)), "a long, b long").distinct()


def near_duplicates(documents: DataFrame, threshold: int = 75) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Two documents are linked if 100 * |intersection| >= ``threshold`` * |union| of their sets of distinct
    five-word shingles (words: runs of ``[^\\x20\\x09-\\x0D]``, A-Z lower-cased, whole texts; a document of
    fewer words has its whole sequence as its one shingle). component_id is the smallest doc_id that is
    reached over links, kept tells whether it is the row's own.

    Null or empty text, or no words: no shingles, linked with nothing. Equal sets: linked, one class.
    Rows that repeat a doc_id count as one document with several texts. A row without doc_id is linked like
    any other, so it connects what it is similar to, but names no component: one of such rows alone has a null
    component_id and is kept. An empty table gives an empty result. Other columns are ignored.
    """
    given, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    # A row without doc_id goes by a hash of its text; rows that share one are one node.
    docs = documents.select(F.coalesce(given, F.xxhash64(F.lit("no id"), text)).alias("doc_id"), text.alias("text"), given.isNotNull().alias("named"))
    sketches = cut(docs.mapInArrow(K.tidy(_sketch), "doc_id long, named boolean, n_shingles long, set_key binary, marks array<long>"), "near-sketches")
    sets = sketches.where("n_shingles > 0").groupBy("set_key").agg(F.min(F.when(F.col("named"), F.col("doc_id"))).alias("lowest"), F.min("doc_id").alias("any_id"), F.any_value("marks").alias("marks"))
    classes = cut(sets.select("set_key", "lowest", F.coalesce("lowest", "any_id").alias("node"), "marks"), "near-classes")
    members = sketches.join(classes.select("set_key", "node"), "set_key", "left").select("doc_id", "named", "n_shingles", "node")
    rows = cut(members, "near-rows")
    several = rows.where("named and node is not null").groupBy("doc_id").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("doc_id", "lo")
    same = cut(rows.join(several, "doc_id").where("node <> lo").select(F.col("lo").alias("a"), F.col("node").alias("b")).distinct(), "near-same-id")
    texts = docs.where("named").select("doc_id", "text").union(docs.where("not named").groupBy("doc_id").agg(F.any_value("text").alias("text")))
    marks = classes.select("node", "marks")
    keys = classes.select("node", F.explode("marks").alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    prefix = COORDINATES - MATCHES + 1
    posted = (
        keys.join(shared, "key")
        .groupBy("node")
        .agg(F.array_sort(F.collect_set(F.struct("df", "key"))).alias("common"))
        .select("node", F.expr(f"slice(common, 1, greatest(0, size(common) - {COORDINATES - prefix}))").alias("common"))
        .select("node", F.explode("common.key").alias("key"))
    )
    postings = cut(posted, "near-postings")
    hubs = postings.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "hub")
    listed = cut(postings.join(hubs, "key").select("key", "node", "hub"), "near-lists")
    agree = F.size(F.array_intersect("marks_a", "marks_b")) >= MATCHES

    def matching(pairs: DataFrame) -> DataFrame:
        left = marks.select(F.col("node").alias("a"), F.col("marks").alias("marks_a"))
        right = marks.select(F.col("node").alias("b"), F.col("marks").alias("marks_b"))
        return pairs.join(right, "b").join(left, "a").where(agree).select("a", "b").distinct()

    first = listed.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    candidates = cut(matching(first), "near-pairs")
    links = cut(_confirmed(candidates, texts, threshold), "near-links")
    labels = connected_components(links, "a", "b")

    # Members of a list that its hub's component doesn't hold meet the members of other components.
    named = cut(listed.join(labels, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component")), "near-named")
    mixed = (
        named.groupBy("key")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min_by("component", "node").alias("main"), F.count(F.lit(1)).alias("n"))
        .where("lo < hi and n > 2")  # of two members, one is the hub that the other has met
        .select("key", "main", F.ceil(F.col("n") / PART).cast("int").alias("parts"))
    )
    members = cut(named.join(mixed, "key"), "near-mixed")
    samples = _of(texts, members.select(F.col("node").alias("doc_id")).distinct()).mapInArrow(K.tidy(_samples), "node long, size long, sample binary")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    tiled = members.withColumn("part", part).withColumn("against", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tiled = tiled.join(samples, "node").select("key", "node", "component", "main", "size", "sample", "part", F.least("part", "against").alias("i"), F.greatest("part", "against").alias("j"))

    def tested(forest: bool) -> tuple[DataFrame, DataFrame]:
        pairs = cut(tiled.groupBy("key", "i", "j").applyInArrow(K.tidy(_tile(threshold, forest)), "a long, b long, sure boolean").distinct(), "near-more")
        return pairs, cut(_confirmed(pairs.select("a", "b").distinct(), texts, threshold), "near-links")

    pairs, extra = tested(forest=True)
    if pairs.where("sure").join(extra, ["a", "b"], "left_anti").limit(1).count():  # then others may have been left out for it
        discard(pairs, extra)
        pairs, extra = tested(forest=False)
    more_links = extra.union(same)
    if more_links.limit(1).count():
        labels = connected_components(links.union(more_links), "a", "b")
    discard(postings, listed, named, members, pairs)
    # A component is named by its smallest doc_id, if any of its rows has one.
    lowest = labels.join(classes.select("node", "lowest"), "node").groupBy("component").agg(F.min("lowest").alias("smallest"))
    linked = labels.join(lowest, "component").select("node", "smallest", F.lit(True).alias("linked"))
    found = classes.select("node", "lowest").join(linked, "node", "left").groupBy("node").agg(F.min(F.when(F.col("linked"), F.col("smallest")).otherwise(F.col("lowest"))).alias("component_id"))
    out = rows.join(found, "node", "left")
    doc_id = F.when(F.col("named"), F.col("doc_id"))
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(doc_id)
    return out.select(doc_id.alias("doc_id"), "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


#: The same in DuckDB, over all pairs that share a shingle.
NEAR_DUPLICATES_SQL = r"""
with recursive d as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), shingles as materialized (
    select distinct doc_id, array_to_string(w[k + 1 : k + 5], ' ') as s from d, unnest(range(greatest(1, len(w) - 4))) t(k) where len(w) > 0
), sizes as (
    select doc_id, count(*) as n from shingles group by doc_id
), common as (
    select a.doc_id as a, b.doc_id as b, count(*) as c from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2
), links as materialized (
    select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)
), reach as (
    select a as doc_id, a as r from links union select l.b, reach.r from reach join links l on l.a = reach.doc_id
), components as (
    select doc_id, min(r) as component_id from reach group by doc_id
)
select d.doc_id, coalesce(n, 0) as n_shingles, coalesce(component_id, d.doc_id) as component_id, coalesce(component_id, d.doc_id) = d.doc_id as kept
from d left join sizes s on s.doc_id = d.doc_id left join components c on c.doc_id = d.doc_id
"""

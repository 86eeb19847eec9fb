"""Benchmark decontamination: a prefix-filtered join of item windows with document shingles, DataFrame functions only.

A window is ``WINDOW`` consecutive words of a benchmark item (an item of fewer words is one window). A
shingle is a pair of neighbouring words, or the word alone in a window of one word. Corpus counts order
the shingles by rarity. A document that contains a window contains each of its shingles, so one prefix
shingle per window, its rarest, is all that has to be joined. The shingle's offset in the window and the
window's length bound where an occurrence can start; the words from there on are then compared exactly.

The windows are broadcast in slices of at most ``SLICE`` rows, so what is broadcast has a fixed bound
whatever the benchmark's size; each slice is one pass over the documents. Documents are never shuffled:
positions are generated, probed against the slice and verified inside one stage, and only hits leave it.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strideway.plans.lineage import cut

WINDOW = 10
SLICE = 200_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Everything that no word holds, once A-Z are lower-cased.
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased words of a text; a null text has none."""
    found = F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _GAPS)
    return F.filter(found, lambda w: w != "")


def _pair(first: Column, second: Column) -> Column:
    return F.xxhash64(first, second)


def _windows(benchmark: DataFrame, window: int) -> DataFrame:
    """(item_id, words of the window), one row per window."""
    item = benchmark.select(F.col("item_id"), words(F.col("text").cast("string")).alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (window - 1)))
    return item.select("item_id", F.transform(starts, lambda i: F.slice("w", i, window)).alias("all")).select("item_id", F.explode("all").alias("window")).distinct()


def _positions(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "text_key", "w", F.posexplode("w").alias("at", "word"))


def benchmark_hits(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_key, start, length, window_key): every occurrence of every window; see ``decontaminate``."""
    return _hits(_prepared(documents), cut(_keyed(_windows(benchmark, window)), "decon-windows"))


def _prepared(documents: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return documents.select(F.col("doc_id"), F.md5(F.coalesce(text, F.lit(""))).alias("text_key"), words(text).alias("w"))


def _keyed(windows: DataFrame) -> DataFrame:
    return windows.withColumn("window_key", F.md5(F.array_join("window", " ")))


def _hits(documents: DataFrame, windows: DataFrame) -> DataFrame:
    distinct = windows.select("window_key", "window").distinct()
    single = distinct.where("size(window) = 1").select("window_key", "window", F.lit(0).alias("offset"), F.xxhash64(F.col("window")[0]).alias("shingle"))
    pairs = distinct.where("size(window) > 1").select(
        "window_key", "window", F.posexplode(F.expr("transform(sequence(0, size(window) - 2), i -> xxhash64(window[i], window[i + 1]))")).alias("offset", "shingle")
    )
    vocabulary = cut(pairs.select("shingle", F.pmod(F.xxhash64("shingle"), F.lit(2**31 - 1)).alias("deal")).distinct(), "decon-shingles")
    at = _positions(documents)
    next_word = F.get("w", F.col("at") + 1)

    # How often each shingle of the benchmark stands in the corpus; counted before anything is shuffled.
    seen = [
        at.where(next_word.isNotNull()).select(_pair(F.col("word"), next_word).alias("shingle")).join(F.broadcast(part.select("shingle")), "shingle", "left_semi")
        for part in _slices(vocabulary)
    ]
    seen = seen or [documents.sparkSession.createDataFrame([], "shingle long")]
    counts = functools.reduce(DataFrame.union, seen).groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    rarest = F.min_by(F.struct("offset", "shingle"), F.struct(F.coalesce("n", F.lit(0)), "offset"))
    prefix = pairs.join(counts, "shingle", "left").groupBy("window_key", "window").agg(rarest.alias("p"), F.min(F.coalesce("n", F.lit(0))).alias("n")).where("n > 0")
    prefix = cut(prefix.select("window_key", "window", "p.offset", "p.shingle", F.pmod(F.xxhash64("window_key"), F.lit(2**31 - 1)).alias("deal")), "decon-prefix")
    single = cut(single.withColumn("deal", F.pmod(F.xxhash64("window_key"), F.lit(2**31 - 1))), "decon-single")

    found = []
    for table, key in ((prefix, _pair(F.col("word"), next_word)), (single, F.xxhash64("word"))):
        for part in _slices(table):
            probe = at.where(next_word.isNotNull()) if table is prefix else at
            joined = probe.withColumn("shingle", key).join(F.broadcast(part.drop("deal")), "shingle")
            start, length = F.col("at") - F.col("offset"), F.size("window")
            inside = joined.where((start >= 0) & (start + length <= F.size("w")))
            exact = inside.where(F.when(start >= 0, F.slice("w", start + 1, length)) == F.col("window"))
            found.append(exact.select("doc_id", "text_key", start.alias("start"), length.alias("length"), "window_key"))
    if not found:
        return documents.sparkSession.createDataFrame([], "doc_id long, text_key string, start int, length int, window_key string")
    return functools.reduce(DataFrame.union, found)


def _slices(table: DataFrame) -> list[DataFrame]:
    """Parts of about ``SLICE`` rows, each small enough to broadcast; none of an empty table."""
    n = table.count()
    parts = -(-n // SLICE)
    return [table.where(F.pmod("deal", F.lit(parts)) == k) if parts > 1 else table for k in range(parts)] if n else []


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Words are maximal runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are lower-cased, in whole
    texts. A document word inside any occurrence of any window is hit. n_items counts the items of which a
    window occurs; items_sha256 is the SHA-256 of their ids, sorted as strings and joined by commas (of the
    empty string if there are none); contaminated means n_hit > 0.

    Null or empty text, of a document or an item: no words, no windows. Items without item_id count as one
    item whose id is the empty string. Items with equal texts all count. Rows that repeat a doc_id, or have
    none, are reported each for its own text. An empty benchmark hits nothing; no documents give no rows.
    Other columns are ignored.
    """
    docs = _prepared(documents)
    windows = cut(_keyed(_windows(benchmark, window)), "decon-windows")
    hits = cut(_hits(docs, windows), "decon-hits")
    doc = ["doc_id", "text_key"]
    spans = hits.groupBy(*doc, "start").agg(F.max("length").alias("length"))
    before = Window.partitionBy(*doc).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max(F.col("start") + F.col("length")).over(before), F.lit(0))
    covered = spans.withColumn("reach", reach).groupBy(*doc).agg(F.sum(F.greatest(F.lit(0), F.col("start") + F.col("length") - F.greatest("start", "reach"))).alias("n_hit"))
    owners = windows.select("window_key", F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")).distinct()
    items = hits.select(*doc, "window_key").distinct().join(owners, "window_key").select(*doc, "item").distinct().groupBy(*doc).agg(F.array_sort(F.collect_list("item")).alias("items"))
    found = covered.join(items, (covered.doc_id.eqNullSafe(items.doc_id)) & (covered.text_key == items.text_key)).select(covered.doc_id, covered.text_key, "n_hit", "items")
    base = docs.select("doc_id", "text_key", F.size("w").cast("long").alias("n_words"))
    out = base.join(found, base.doc_id.eqNullSafe(found.doc_id) & (base.text_key == found.text_key), "left")
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    return out.select(
        base.doc_id,
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


#: The same in DuckDB, comparing every window with every position.
DECONTAMINATE_SQL = rf"""
with d as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), items as (
    select item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
), windows as (
    select distinct item_id, w[k + 1 : k + 10] as ws from items, unnest(range(greatest(1, len(w) - 9))) t(k) where len(w) > 0
), places as (
    select doc_id, k, n, w[k + 1 : k + n] as ws from d, (select distinct len(ws) as n from windows), unnest(range(greatest(0, len(w) - n + 1))) t(k)
), hits as (
    select p.doc_id, p.k, p.n, i.item_id from places p join windows i on p.ws = i.ws
), covered as (
    select doc_id, count(distinct j) as n_hit from hits, unnest(range(k, k + n)) u(j) group by doc_id
), found as (
    select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, coalesce(item_id::varchar, '') as item from hits) group by doc_id
)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join covered c on c.doc_id = d.doc_id left join found f on f.doc_id = d.doc_id
"""

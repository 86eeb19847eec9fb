"""Line dedup: overlapping three-line windows, found globally, with DataFrame functions only.

Every three consecutive lines that aren't blank make a window, known by a 128-bit hash. Windows that
stand more than once anywhere are found by a count that is combined before it is shuffled; of each, the
occurrence of the smallest (doc_id, position) stays. The lines that later occurrences cover are merged per
document and taken out of its text. Only hashes and positions are grouped, never lines, and no group is
collected but the positions of one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideway.plans.lineage import cut, discard

LINES = 3


def remove_repeated_lines(documents: DataFrame) -> DataFrame:
    """The documents with repeated windows taken out of ``text``, and the columns _sw_n_lines, _sw_n_removed.

    Lines are what ``\\n`` separates; a line of nothing but spaces is blank, belongs to no window and always
    stays. Lines are compared without the spaces around them. A document of fewer than three lines that
    aren't blank has no window and stays as it is; so do null and empty texts. Of equal windows, in one
    document or several, the one with the smallest doc_id (none counts as larger than all) and then the
    first position stays; every line that any later one covers goes, also where windows overlap. Rows
    that repeat both doc_id and text are one document: they keep and lose the same lines. An empty
    table stays empty. All other columns are carried along, whatever their names.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = documents.select(F.col("doc_id").alias("d"), F.xxhash64(text).alias("t"), text.alias("text"))
    # Generating one row from one array keeps the optimizer from splitting the text again for every line.
    split = keyed.select("d", "t", F.explode(F.array(F.expr("filter(transform(split(text, '\\n'), x -> trim(x)), x -> x <> '')"))).alias("lines")).where(f"size(lines) >= {LINES}")
    hashed = F.expr(
        f"transform(sequence(0, size(lines) - {LINES}), k -> struct(xxhash64(lines[k], lines[k + 1], lines[k + 2]) as h, xxhash64('second', lines[k + 2], lines[k], lines[k + 1]) as g))"
    )
    windows = cut(split.select("d", "t", F.posexplode(hashed).alias("k", "hash")).select("d", "t", "k", "hash.h", "hash.g"), "line-hashes")
    # Both sides of each join are tables, so that adaptive execution can split a window that very many documents hold.
    repeated = cut(windows.groupBy("h", "g").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h", "g"), "line-repeated")
    found = cut(windows.join(repeated, ["h", "g"]).select("h", "g", F.struct(F.col("d").isNull().alias("no_id"), "d", "t", "k").alias("at")), "line-windows")
    first = cut(found.groupBy("h", "g").agg(F.min("at").alias("first")), "line-first")
    later = cut(found.join(first, ["h", "g"]).where("at <> first").select("at.d", "at.t", "at.k"), "line-later")
    covered = cut(later.groupBy(F.col("d").alias("_sw_d"), F.col("t").alias("_sw_t")).agg(F.collect_set("k").alias("_sw_windows")), "line-covered")
    discard(windows, repeated, found, first, later)
    # The texts move once, as they are; only documents with a later occurrence are split into lines again. What they
    # meet is hashed, not sorted: a number for each window that goes, which is less than the window's text.
    own = documents.withColumn("_sw_key", F.xxhash64(text))
    same = F.col("doc_id").eqNullSafe(F.col("_sw_d")) & (F.col("_sw_key") == F.col("_sw_t"))
    joined = own.join(covered.hint("shuffle_hash"), same, "left").drop("_sw_d", "_sw_t", "_sw_key")
    lines = joined.withColumn("_sw_lines", F.explode(F.array(F.when(F.col("_sw_windows").isNotNull(), F.split(text, "\n")))))
    full = F.expr("if(_sw_lines is null, null, filter(sequence(0, size(_sw_lines) - 1), i -> trim(_sw_lines[i]) <> ''))")
    marked = lines.withColumn("_sw_full", F.explode(F.array(full)))
    gone = marked.withColumn("_sw_gone", F.explode(F.array(F.expr(f"array_distinct(flatten(transform(_sw_windows, k -> slice(_sw_full, k + 1, {LINES}))))"))))
    kept = F.array_join(F.expr("transform(array_except(sequence(0, size(_sw_lines) - 1), _sw_gone), i -> _sw_lines[i])"), "\n")
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1)
    return gone.withColumns(
        {
            "_sw_n_lines": n_lines.cast("long"),
            "_sw_n_removed": F.coalesce(F.when(F.col("_sw_gone").isNotNull(), F.size("_sw_gone")), F.lit(0)).cast("long"),
            "text": F.when(F.col("_sw_gone").isNull(), F.col("text").cast("string")).otherwise(kept),
        }
    ).drop("_sw_lines", "_sw_full", "_sw_windows", "_sw_gone")


def line_dedup(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, text; see ``remove_repeated_lines``."""
    slim = documents.select("doc_id", "text")
    return remove_repeated_lines(slim).select("doc_id", F.col("_sw_n_lines").alias("n_lines"), F.col("_sw_n_removed").alias("n_removed"), "text")


#: The same in DuckDB, over whole lines instead of hashes.
LINE_DEDUP_SQL = """
with lines as (
    select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as i from documents
), filled as (
    select doc_id, i, trim(line) as a, row_number() over (partition by doc_id order by i) as k from lines where trim(line) <> ''
), windows as (
    select doc_id, k, a, lead(a) over w as b, lead(a, 2) over w as c from filled window w as (partition by doc_id order by k)
), ranked as (
    select doc_id, k, row_number() over (partition by a, b, c order by doc_id, k) as place from windows where c is not null
), gone as (
    select distinct f.doc_id, f.i from ranked r join filled f on f.doc_id = r.doc_id and f.k between r.k and r.k + 2 where r.place > 1
), kept as (
    select l.doc_id, count(*) as n_lines, count(g.i) as n_removed, string_agg(l.line, chr(10) order by l.i) filter (where g.i is null) as text
    from lines l left join gone g on g.doc_id = l.doc_id and g.i = l.i group by l.doc_id
)
select d.doc_id, coalesce(k.n_lines, 0) as n_lines, coalesce(k.n_removed, 0) as n_removed,
       case when d.text is null then null else coalesce(k.text, '') end as text
from documents d left join kept k on k.doc_id = d.doc_id
"""

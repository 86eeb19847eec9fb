"""Top-k, decontamination, near-duplicates and line dedup against brute force, and on odd rows."""

import hashlib
import random
import re
import string
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from strideway.llm import decontamination, line_dedup, near_dup, topk
from strideway.llm import text_kernel as K

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
DOCS = "doc_id long, text string, lang string, d string, t string, h long, n_words int"


def docs_of(spark, rows):
    """Documents with extra columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, t, "en", "x", "y", 1, 2) for i, t in rows], DOCS)


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


# --- exact top-k -------------------------------------------------------------------------------------------


def brute_top_k(rows, k=5, every=50):
    vectors = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            vectors.setdefault(i, []).append(np.floor(256 * np.array(v, dtype=np.float32).astype(np.float64)).astype(np.int64))
    out = []
    for q, own in vectors.items():
        if q % every == 0:
            a = min(own, key=lambda x: x.tolist())
            scored = []
            for i, vs in vectors.items():
                for b in vs if i != q else []:
                    n = min(len(a), len(b))
                    scored.append((-int(a[:n] @ b[:n]), i))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def embeddings(spark, rows):
    return spark.createDataFrame([(i, v, 1, "z", 0) for i, v in rows], "vec_id long, embedding array<float>, label int, block string, norm int")


def test_top_k_matches_brute_force_with_ties_nulls_and_copies(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 60)
    monkeypatch.setattr(topk, "SEED", 10)
    monkeypatch.setattr(topk, "GROUP", 3)
    r = np.random.default_rng(1)
    rows = [(i, [float(x) for x in r.normal(size=8) * (1 + i % 5)]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(120)]  # a common vector: ties
    rows += [(2000, None), (2001, []), (2002, [1.0, None] * 4), (2003, [float("nan")] * 8), (2004, [float("inf")] * 8), (None, [1.0] * 8), (50, rows[3][1]), (2050, [0.0] * 8), (2051, [1.0, 2.0])]
    got = sorted(tuple(x) for x in topk.top_k(embeddings(spark, rows)).collect())
    assert got == brute_top_k(rows)


def test_a_block_goes_to_the_groups_that_need_it(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 50)
    monkeypatch.setattr(topk, "SEED", 20)
    monkeypatch.setattr(topk, "GROUP", 4)
    r = np.random.default_rng(6)
    unit = lambda: (lambda v: v / np.linalg.norm(v))(r.normal(size=6))
    rows = [(i, [float(x) for x in unit() * 1.03 ** -(i % 500)]) for i in range(1000)]  # lengths from 1 to nearly 0
    seen = spark.sparkContext.accumulator(0)
    tile = topk._tile

    def counted(*args):
        run = tile(*args)

        def over(queries, vectors):
            seen.add(vectors.num_rows)
            return run(queries, vectors)

        return over

    monkeypatch.setattr(topk, "_tile", counted)
    got = sorted(tuple(x) for x in topk.top_k(embeddings(spark, rows)).collect())
    assert got == brute_top_k(rows)
    assert 0 < seen.value < 0.6 * 1000 * 5  # 20 queries in 5 groups


def test_top_k_of_large_components_and_of_one_long_vector(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROTATED", 4)
    rows = [(0, [1e30, 1.0]), (1, [3.0, 2.0]), (2, [-1e30, 0.0]), (3, [1e30, 0.0]), (50, [0.5] * 40), (4, [0.25] * 40), (5, [1.0, 2.0])]
    got = [tuple(x) for x in topk.top_k(embeddings(spark, rows)).collect()]
    most = 2**63 - 1
    assert [x[1:] for x in sorted(got) if x[0] == 0] == [(k + 1, i, most) for k, i in enumerate((1, 3, 4, 5, 50))]
    assert (50, 3, 4, 40 * 128 * 64) in got


def test_top_k_of_few_and_of_no_vectors(spark):
    rows = [(0, [1.0, 0.5]), (1, [0.25, 0.125])]
    assert [tuple(x) for x in topk.top_k(embeddings(spark, rows)).collect()] == [(0, 1, 1, 256 * 64 + 128 * 32)]
    assert topk.top_k(embeddings(spark, [])).collect() == []
    assert topk.top_k(embeddings(spark, [(0, None)])).columns == ["query_id", "rank", "vec_id", "score"]


# --- decontamination ---------------------------------------------------------------------------------------

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute_decontamination(docs, items):
    words = lambda t: WORD.findall((t or "").translate(LOWER))
    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add("" if i is None else str(i))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if own := windows.get(tuple(w[k : k + n])):
                    found |= own
                    hit.update(range(k, k + n))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("slice_rows", [3, 200_000])
def test_decontamination_matches_brute_force(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(decontamination, "SLICE", slice_rows)
    passage = prose(1, 14)
    items = [(1, passage), (2, "Émile zola"), (3, "single"), (4, None), (5, ""), (6, "a a a a a a a a a a a a"), (7, passage), (None, "no id"), (8, "w1 w2"), (10, prose(9, 10, 3))]
    docs = [(1, prose(2, 50) + " " + passage.upper() + "!"), (2, "x éMILE ZOLA y"), (2, None), (3, ""), (4, "single, Single; SINGLE"), (5, "a " * 30), (6, "of no id at all"), (6, "of no id at all"), (None, passage), (7, prose(3, 3000, 3)), (8, "w1-w2_w1"), (9, " ".join(passage.split()[:9]))]
    got = decontamination.decontaminate(docs_of(spark, docs), spark.createDataFrame([(i, t, "q") for i, t in items], "item_id long, text string, window string"))
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted((tuple(x) for x in got.collect()), key=str) == brute_decontamination(docs, items)


def test_decontamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontamination.decontaminate(docs_of(spark, [(1, "a b")]), none).collect()
    assert [(x.doc_id, x.n_words, x.n_hit, x.contaminated) for x in got] == [(1, 2, 0, False)]
    assert decontamination.decontaminate(docs_of(spark, []), spark.createDataFrame([(1, "a b c")], none.schema)).collect() == []


# --- near-duplicates ---------------------------------------------------------------------------------------


def shingles(text):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_components(rows):
    sets, parent = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]) or rows[a][0] is not None and rows[a][0] == rows[b][0] and sets[a] and sets[b]:
                parent[root(a)] = root(b)
    groups = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            groups[root(k)].append(i)
    own = [min(groups[root(k)], default=None) if sets[k] else i for k, (i, _) in enumerate(rows)]
    return Counter((i, len(s), c, i == c) for (i, _), s, c in zip(rows, sets, own, strict=True))


def edited(text, edits, seed):
    r, w = random.Random(seed), text.split()
    for _ in range(edits):
        w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
    return " ".join(w)


def test_near_duplicates_match_brute_force_in_hot_groups(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "PART", 16)
    base = prose(5, 150)
    rows = [(k, edited(base, 1 + k % 6, k)) for k in range(120)]  # pairs on both sides of the threshold
    rows += [(200 + k, base) for k in range(40)] + [(300 + k, prose(k, 60)) for k in range(60)]
    rows += [(400 + k, prose(77, 60) + " " + prose(100 + k, 60)) for k in range(40)]  # a passage that many share
    assert Counter(tuple(x) for x in near_dup.near_duplicates(docs_of(spark, rows)).collect()) == brute_components(rows)


def test_near_duplicates_of_odd_rows(spark):
    long = prose(3, 60_000, 10**6)
    rows = [(1, None), (2, ""), (3, " \n "), (4, "One two"), (5, "one TWO"), (6, "one two three"), (7, long), (8, edited(long, 50, 1)), (9, "a b c d e f"), (9, "a b c d e f"), (None, "one two"), (None, "alone here"), (10, "É é É é É"), (11, "é é é é é")]
    got = near_dup.near_duplicates(docs_of(spark, rows)).collect()
    assert Counter(tuple(x) for x in got if x.doc_id is not None) == Counter({k: v for k, v in brute_components(rows).items() if k[0] is not None})
    assert sorted((str(x.component_id), x.kept) for x in got if x.doc_id is None) == [("4", False), ("None", True)]
    assert near_dup.near_duplicates(docs_of(spark, [])).collect() == []


def test_near_duplicates_are_linked_over_rows_without_an_id(spark):
    w = [f"w{k}" for k in range(200)]
    a, b, c = w[0:100], w[12:112], w[24:124]  # a and c are each similar to b, but not to each other
    rows = [(1, " ".join(a)), (None, " ".join(b)), (2, " ".join(c)), (5, " ".join(w[150:190])), (5, " ".join(c)), (None, "alone here"), (None, "alone here"), (6, " ".join(w[150:190]))]
    got = near_dup.near_duplicates(docs_of(spark, rows)).collect()
    assert Counter(tuple(x) for x in got) == brute_components(rows)
    assert {x.component_id for x in got if x.doc_id} == {1}


def test_word_hashes_depend_on_the_words_alone():
    import pyarrow as pa

    data, offsets = K.raw_bytes(pa.array(["a bc  d", None, "", "d\tbc", "x" * 5000 + " d"]))
    h, first = K.word_hashes(data, offsets, K.SPACES)
    assert first.tolist() == [0, 3, 3, 3, 5, 7]
    assert h[1] == h[4] and h[2] == h[3] == h[6] and len(set(h.tolist())) == 4


# --- line dedup --------------------------------------------------------------------------------------------


def test_line_dedup_matches_sql(spark):
    r = random.Random(4)
    line = lambda: f"line {r.randrange(6)}"
    rows = [(k, "\n".join(line() if r.random() < 0.8 else " " for _ in range(r.randrange(12)))) for k in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "A\nB\nC"), (104, "x\n A \nB \nC\ny"), (105, "A\nB"), (106, "z\n" * 9), (107, "\n".join(f"u{k}" for k in range(5000)))]
    duckdb.sql("create or replace table documents (doc_id bigint, text varchar)")
    duckdb.executemany("insert into documents values (?, ?)", rows)
    want = sorted(duckdb.sql(line_dedup.LINE_DEDUP_SQL).fetchall(), key=str)
    assert sorted((tuple(x) for x in line_dedup.line_dedup(docs_of(spark, rows)).collect()), key=str) == want
    text = {x[0]: x[3] for x in want}
    assert text[103] == "A\nB\nC" and text[104] == "x\ny" and text[105] == "A\nB" and text[100] is None


def test_line_dedup_keeps_columns_and_treats_repeated_rows_alike(spark):
    rows = [(1, "a\nb\nc\nd"), (1, "a\nb\nc\nd"), (2, "q\na\nb\nc"), (None, "a\nb\nc")]
    out = line_dedup.remove_repeated_lines(docs_of(spark, rows))
    assert [c for c in out.columns if not c.startswith("_sw_")] == docs_of(spark, []).columns
    assert sorted((str(x.doc_id), x.text, x.d, x._sw_n_removed) for x in out.collect()) == [("1", "a\nb\nc\nd", "x", 0), ("1", "a\nb\nc\nd", "x", 0), ("2", "q", "x", 3), ("None", "", "x", 3)]
    assert line_dedup.line_dedup(docs_of(spark, [])).collect() == []


@pytest.mark.parametrize("length, edits", [(300, 2), (5000, 20)])
def test_a_tile_of_near_copies_yields_fewer_pairs_than_members(length, edits):
    base, n = prose(5, length, 10**6), 40
    texts = [edited(base, edits, k) for k in range(n)]
    batch = pa.Table.from_batches(near_dup._samples(iter([pa.RecordBatch.from_pydict({"doc_id": list(range(n)), "text": texts})]))).combine_chunks()
    same = lambda v: pa.array([v] * n, pa.int64())
    columns = {**{c: batch.column(c) for c in ("node", "size", "sample")}, "component": batch.column("node"), "main": same(-1), "part": same(0), "i": same(0), "j": same(0)}
    got = near_dup._tile(75)(pa.table(columns)).to_pylist()
    assert len(got) < n and all(r["sure"] for r in got)
    reached, links = {0}, [{r["a"], r["b"]} for r in got]
    for _ in links:
        reached |= set().union(*[x for x in links if x & reached])
    assert reached == set(range(n))
    assert len(near_dup._tile(75, forest=False)(pa.table(columns))) == n * (n - 1) // 2

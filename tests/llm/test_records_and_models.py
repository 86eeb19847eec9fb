"""Sharding, extraction, classifier, packing, language-model scores and archives: invariants, round trips, odd rows."""

import math
import random
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from strideway.llm import html_extract, lm_score, packing, quality, sharding, warc
from strideway.llm.queries import tokenizer_path

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
DOCS = "doc_id long, text string, lang string, bucket int, size string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", 7, "s") for i, t in rows], DOCS)


ODD = [(1, None), (2, ""), (3, "Plain words here."), (3, "Plain words here."), (4, "Ünïcode ß 日本 🙂"), (5, "x" * 40_000), (6, "word " * 9000), (None, "no id"), (None, "no id"), (7, "tab\tand\nline\r\n")]


# --- sharding ----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("law", ["rows", "key"])
def test_shards_hold_every_row_once(spark, monkeypatch, law):
    monkeypatch.setattr(sharding, "BUCKET_BYTES", 20_000)
    rows = ODD + [(100 + k, "same text") for k in range(400)] + [(1000 + k, f"text {k} " * (k % 9)) for k in range(600)]
    got = sharding.shard(docs_of(spark, rows), shards=7, law=law).collect()
    assert Counter((x.doc_id, x.text, x.size, x.text_crc32, x.law) for x in got) == Counter((i, t, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), law) for i, t in rows)
    slots = defaultdict(list)
    for x in got:
        slots[x.shard].append(x.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(7))
    sizes = [len(s) for s in slots.values()]
    if law == "rows":
        assert max(sizes) - min(sizes) <= 1 and all(x.grown_shard is None for x in got)
        places = [(x.shard, x.slot) for x in sorted(got, key=lambda x: x.doc_id or 0) if x.doc_id and x.doc_id >= 1000]
        assert places != sorted(places)
    else:
        assert all(x.grown_shard in (x.shard, 7) for x in got) and any(x.grown_shard == 7 for x in got)


def test_shards_depend_on_the_seed_alone(spark):
    rows = [(k, f"t{k}") for k in range(300)]
    place = lambda df, **kw: sorted((x.doc_id, x.shard, x.slot) for x in sharding.shard(df, 5, **kw).collect())
    one = docs_of(spark, rows)
    assert place(one) == place(docs_of(spark, rows[::-1]).repartition(3)) != place(one, seed=9)
    assert sharding.shard(docs_of(spark, [])).collect() == []


def test_fisher_yates_is_a_uniform_permutation():
    rng = np.random.default_rng(0)
    seen = Counter(tuple(sharding.fisher_yates(3, rng).tolist()) for _ in range(6000))
    assert len(seen) == 6 and all(850 < n < 1150 for n in seen.values())
    assert sharding.fisher_yates(0, rng).tolist() == [] and sharding.fisher_yates(1, rng).tolist() == [0]


# --- HTML extraction ---------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>if (a < b) "</p>";</script></head><body>
<header><h1>Site</h1><nav><ul><li><a href="/">Home</a></li></ul></nav></header><div class="cookie-notice">We use cookies &amp; more</div>
<div id="wrap"><div class="sidebar"><p>Side text</p></div><{main}><header><h1>Title &amp; more</h1></header><p>One&nbsp;two   <b>three</b>
four<br>five &lt;tag&gt;</p><div class="ad-slot">Buy this</div><div id="adBox2">Buy that</div><ul><li>item 1<li>item 2</ul><form><p>Your mail</p><input></form><p>Last &#233;&eacute;{n}</p>
<aside>Aside</aside></{end}><div id="comments"><p>First comment {n}</p></div></div><footer><p>&copy; us</p></footer></body></html>"""


def test_extraction_takes_the_article_alone(spark):
    rows = [(k, f"http://Host{k % 2}.example/{k}", PAGE.format(main="article", end="article", n=k)) for k in range(6)]
    rows += [(10 + k, f"https://u@other.example:80/{k}", PAGE.format(main='div class="story"', end="div", n=k)) for k in range(4)]
    got = {x.page_id: x for x in html_extract.main_texts(spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string")).collect()}
    for k, x in got.items():
        n = k % 10
        lines = ["One two three four five <tag>", "item 1", "item 2", f"Last éé{n}"]
        assert x.text == "\n\n".join(["Title & more", *lines] if k < 10 else lines) and x.n_chars == len(x.text), k


def test_extraction_of_odd_pages(spark):
    rows = [(1, None, None), (2, "http://a/", ""), (3, "nohost", "no markup & none"), (4, "http://a/", "<article><p><b>open<br><p>second"), (5, "http://a/", "<p>x</p></div></p><!-- cut <p>y"), (6, "http://b/", "<article>" + "<p>long text</p>" * 20_000), (None, "http://b/", "<article>1 < 2 &unknown; <p>z</article>"), (4, "http://a/", "<article><p>again"), (7, "http://c/", "<" * 2000), (8, "http://c/", "<script>never closed <p>x"), (9, "http://c/", "<article><p>cut here<p class=")]
    got = sorted(((x.page_id or 0, x.text) for x in html_extract.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()))
    want = [(0, "1 < 2 &unknown;\n\nz"), (1, ""), (2, ""), (3, "no markup & none"), (4, "again"), (4, "open\n\nsecond"), (5, "x"), (6, "\n\n".join(["long text"] * 20_000)), (7, "<" * 2000), (8, ""), (9, "cut here")]
    assert got == want
    assert html_extract.main_texts(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_extraction_leaves_out_what_a_hosts_pages_repeat(spark):
    tagline = "All the news there is. " * 3
    rows = [(k, f"http://b/{k}", f"<body><div class='wrap'><div class='tagline'><p>{tagline}</p></div><div class='story'><p>Report number {k}.</p></div></div></body>") for k in range(6)]
    rows += [(10 + k, f"http://c/{k}", f"<body><!-- {k} --><div class='wrap'><article><p>One text.</p></article></div></body>") for k in range(6)]
    got = {x.page_id: x.text for x in html_extract.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[k] for k in range(6)] == [f"Report number {k}." for k in range(6)] and {got[10 + k] for k in range(6)} == {"One text."}


def test_extraction_keeps_named_parts_of_the_article(spark):
    own = ["<section id='search-and-rescue'><p>They searched.</p></section>", "<h2 id='social-history'>Social history</h2>", "<p class='notice'>Seen once.</p>"]
    rows = [(k, f"http://a/{k}", f"<body><article><p>Story {k}</p>{own[k] if k < 3 else ''}<div class='related'>More {k}</div></article></body>") for k in range(30)]
    got = {x.page_id: x.text for x in html_extract.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    more = ["They searched.", "Social history", "Seen once."]
    assert [got[k] for k in range(30)] == [f"Story {k}" + (f"\n\n{more[k]}" if k < 3 else "") for k in range(30)]


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_a_host_without_telling_names_or_tags(spark):
    r = random.Random(3)
    words = lambda n: " ".join(r.choice("ab ra ka da bra mo lo ti".split()) for _ in range(n))
    rows, want = [], {}
    for k in range(12):
        menu = "".join(f"<a href='/{j}'>{words(2)}</a> " for j in range(r.randrange(5, 9)))
        posts = "".join(f"<div class='r'><div class='s'>{words(3)}</div><div class='t'>{words(6)}</div></div>" for _ in range(r.randrange(4)))
        lead, paragraphs = words(12), [words(r.randrange(30, 60)) for _ in range(r.randrange(1, 5))]
        html = f"<body><div class='m'>{menu}</div><div class='k'><p>Always the same line.</p></div><div class='x'><div class='l'><p>{lead}</p></div><div class='y'>{''.join(f'<p>{p}' for p in paragraphs)}</div><div class='q'>{posts}</div></div><div class='z'>All rights here.</div>"
        rows.append((k, f"http://a/{k}", html))
        want[k] = "\n\n".join([lead, *paragraphs])
    got = {x.page_id: x.text for x in html_extract.main_texts(pages_of(spark, rows)).collect()}
    assert got == want


def test_classes_are_those_of_brute_force(spark):
    r = random.Random(5)
    pages = []
    for k in range(30):
        parts = [f"<div class='a'><p>fixed</p><p>text {k}</p></div>", "<nav>menu</nav>" * (k % 2), "<div class='b'><section>x</section><section>y</section></div>" * (k % 3), "<div class='c'><ul><li>one</ul></div>" * (k % 4 > 1)]
        r.shuffle(parts)
        pages.append("<body>" + "".join(parts))
    pages += pages[:5]  # pages that repeat count once
    tokens = html_extract.occurrences(pages_of(spark, [(k, "http://a/", x) for k, x in enumerate(pages)]))
    vectors = defaultdict(lambda: [0] * 30)
    parent = {}
    for k, page in enumerate(pages[:30]):
        for x in html_extract.tokens_of(page):
            vectors[x[0]][k] += x[3]
            parent[x[0]] = x[1]
    want = defaultdict(set)
    for t, v in vectors.items():
        if sum(n > 0 for n in v) > 1:
            want[tuple(v)].add(t)
    got = defaultdict(set)
    for x in tokens.collect():
        got[x.vector].add(x.token)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values())) and len(want) > 4
    valid = {frozenset(c) for c in want.values() if len({parent[t] for t in c if parent[t] not in c}) == 1}
    assert {frozenset(got[x.vector]) for x in html_extract.classes(tokens).collect()} == valid and len(valid) < len(want)


def test_extraction_of_legal_and_of_broken_markup(spark):
    import time

    rows = [
        (1, "http://a/", "<html><head><title>t</title><body><p>No end of the head.</p><p>Two</body>"),
        (2, "http://b/", "<body><div id='thread-main'><article><p>Kept.</p><label>Name</label> <button>Press</button><menu><li>dish</menu></article></div>"),
        (3, "http://c/", "<body><div class='story-share-wrap'><article><p>Kept too.</p></article></div>"),
        (4, "http://d/", "<title>never closed<body><p>Text</p>"),
        (5, "http://e/", "<table><tr><td>a<td>b<tr><td>c</table><dl><dt>d<dd>e</dl>"),
    ]
    got = {x.page_id: x.text for x in html_extract.main_texts(pages_of(spark, rows)).collect()}
    assert got == {1: "No end of the head.\n\nTwo", 2: "Kept.\n\nName Press\n\ndish", 3: "Kept too.", 4: "never closed\n\nText", 5: "a\n\nb\n\nc\n\nd\n\ne"}
    for page in ("<script " * 60_000, "<div>" * 20_000 + "</p></b>" * 20_000, "<div>x" * 20_000, "<b>" * 20_000 + "<p>x</p>" * 20_000, "<title>" * 60_000, "<a href='" * 60_000, "<!x" * 60_000, "</" * 60_000):
        began = time.time()
        html_extract.tokens_of(page)
        html_extract.extract(page, {})
        assert time.time() - began < 8, page[:9]


# --- quality classifier ------------------------------------------------------------------------------------


def labelled(n):
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdefghilmnoprstu") for _ in range(r.randrange(2, 9)))
    rows, labels = [], []
    for k in range(n):
        good = k % 3 > 0
        text = " ".join(word() for _ in range(r.randrange(30, 200))) + "."
        rows.append((k, text.capitalize() if good else " ".join(w.upper() + "!!" for w in text.split()) if k % 2 else " ".join([w for w in text.split()[:6] for _ in range(9)])))
        labels.append((k, int(good), 0))
    return rows, labels


def test_held_out_documents_are_told_apart(spark):
    rows, labels = labelled(600)
    more = [(9000, None), (9001, ""), (None, "text without an id"), (5, "a repeated id")]
    got = quality.quality_scores(docs_of(spark, rows + more), spark.createDataFrame(labels + [(1, None, 0), (2, 7, 0), (4, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(rows) + len(more) and all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.5) for x in got)
    truth = dict((a, b) for a, b, _ in labels)
    held = [x for x in got if x.doc_id is not None and x.held_out and x.doc_id < 9000]
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 3 == 1) for x in got if x.doc_id is not None)
    assert sum(x.predicted == truth[x.doc_id] for x in held) / len(held) > 0.97


def test_other_kinds_of_junk_are_told_apart(spark):
    """Junk that the given tables don't hold: encoded bytes, number tables, leftover markup, shuffled letters."""
    import base64

    r = random.Random(11)
    stems = ["".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randrange(1, 4))) for _ in range(400)]
    prose = lambda n: ". ".join(" ".join(r.choice(stems) for _ in range(r.randrange(6, 18))).capitalize() for _ in range(n)) + "."
    junk = [
        lambda: base64.b64encode(r.randbytes(r.randrange(200, 900))).decode(),
        lambda: " ".join(f"{r.randrange(10**6)};{r.random():.4f}" for _ in range(r.randrange(20, 90))),
        lambda: "".join(f"<td class='c{r.randrange(9)}'>{r.choice(stems)}</td>" for _ in range(r.randrange(10, 40))),
        lambda: " ".join("".join(r.sample("qwxzkjvyhbcdfg", 6)) for _ in range(r.randrange(30, 120))),
    ]
    rows = [(k, prose(r.randrange(3, 12)) if k % 2 else junk[k // 2 % 4]()) for k in range(800)]
    got = quality.quality_scores(docs_of(spark, rows), spark.createDataFrame([(k, k % 2, 0) for k in range(800)], "doc_id long, quality int, toxic int")).collect()
    held = [x for x in got if x.held_out]
    assert len(held) > 200 and sum(x.predicted == x.doc_id % 2 for x in held) / len(held) > 0.98


def test_votes_are_weighted_by_similarity_and_ties_go_to_the_first():
    model = quality.Model(np.ones(2, np.float32), np.eye(2, dtype=np.float32), np.array([[1, 0], [1, 0], [1, 0], [0, 1]], np.float32), np.array([1, 0, 0, 1], np.float32))
    assert quality.votes(model, np.array([[2, 0]], np.float32), 1).tolist() == [1.0]
    assert quality.votes(model, np.array([[2, 0]], np.float32), 2).tolist() == [0.5]
    assert quality.votes(model, np.array([[3, 4]], np.float32), 2)[0] == pytest.approx(1.0)  # 0.8 for 1, 0.6 for 1
    assert quality.votes(model, np.array([[3, 4]], np.float32), 3)[0] == pytest.approx(1.4 / 2.0)
    assert quality.votes(model, np.array([[0, 0]], np.float32)).tolist() == [0.5]


def test_learning_takes_little_memory_of_the_driver(spark):
    import tracemalloc

    rows, labels = labelled(3300)
    docs, known = docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    tracemalloc.start()
    try:
        model = quality.learn(docs, known)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(model.labels) == quality.SAMPLE
    assert peak < 80e6


@pytest.mark.parametrize("kind", ["slow", "repeated", "equal", "nothing"])
def test_leading_eigenvectors_are_those_of_all(kind):
    r, n = np.random.Generator(np.random.PCG64(5)), 700
    x = {
        "slow": lambda: r.standard_normal((n, 900)) * 0.995 ** np.arange(900),
        "repeated": lambda: r.standard_normal((5, 40))[r.integers(0, 5, n)],  # rank 5
        "equal": lambda: np.eye(100)[np.arange(n) % 100],  # 100 equal eigenvalues
        "nothing": lambda: np.zeros((n, 3)),
    }[kind]()
    gram = (x @ x.T).astype(np.float32)
    values, vectors = quality._leading(gram, 24)
    whole, all_vectors = np.linalg.eigh(gram.astype(np.float64))
    scale = max(1.0, whole[-1])
    assert np.allclose(values, whole[::-1][:24], atol=1e-6 * scale)
    assert np.allclose(vectors.T @ vectors, np.eye(24), atol=1e-6)
    assert np.linalg.norm(gram @ vectors - vectors * values) < 1e-6 * scale
    if kind == "slow":  # the others' eigenvectors are not the only ones
        assert np.linalg.svd(all_vectors[:, -24:].T @ vectors, compute_uv=False).min() > 1 - 1e-6


def test_the_space_is_that_of_a_whole_decomposition():
    r = np.random.Generator(np.random.PCG64(6))
    rows = []
    for k in range(600):
        places = np.unique(r.integers(0, 3000, 200) + 2500 * (k % 3)).astype(np.uint16)
        rows.append((places, np.sqrt(r.integers(1, 9, len(places))).astype(np.float32)))
    model = quality.fit(rows, np.arange(600) % 2, 3)
    dense = np.zeros((600, quality.TERMS))
    for x, (places, weights) in zip(dense, rows, strict=True):
        x[places] = weights
    dense *= np.log(601 / (1 + np.count_nonzero(dense, axis=0))) + 0.2
    dense /= np.linalg.norm(dense, axis=1)[:, None]
    want = np.linalg.svd(dense, full_matrices=False)[2][:3].T
    assert np.linalg.svd(want.T @ model.space, compute_uv=False).min() > 1 - 1e-5
    unit = dense @ want
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    assert np.allclose(model.vectors @ model.vectors.T, unit @ unit.T, atol=1e-4)


def test_scores_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [x.score for x in quality.quality_scores(docs_of(spark, [(1, "a"), (2, None)]), none).collect()] == [0.5, 0.5]
    assert quality.quality_scores(docs_of(spark, []), none).collect() == []


# --- packing -----------------------------------------------------------------------------------------------


def test_pieces_are_whole_and_sequences_full(spark):
    from tokenizers import Tokenizer

    r = random.Random(3)
    rows = ODD + [(100 + k, " ".join(r.choice(["the", "of", "übermaß", "tion"]) for _ in range(r.randrange(1, 900)))) for k in range(300)]
    got = packing.pack(docs_of(spark, rows), tokenizer_path()).collect()
    slow = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for i, t in rows:
        ids, at = np.array([*slow.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4"), 0
        for k, (a, n) in enumerate(packing.piece_spans(len(ids))):
            assert a == at and 0 < n <= 2048
            at += n
            want[(i, k, a, n, zlib.crc32(ids[a : a + n].tobytes()))] += 1
        assert at == len(ids)
    assert Counter((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in got) == want
    bins = defaultdict(list)
    for x in got:
        bins[x.sequence_id].append((x.offset, x.length))
    for b in bins.values():
        b.sort()
        assert [o for o, _ in b] == [sum(n for _, n in b[:k]) for k in range(len(b))] and sum(n for _, n in b) <= 2048
    assert len(bins) <= math.ceil(sum(x.length for x in got) / 2048 * 1.02) + 1
    assert packing.pack(docs_of(spark, []), tokenizer_path()).collect() == []


def test_both_tokenizers_agree():
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(tokenizer_path())
    assert packing.token_ids("a <|endoftext|> b", tokenizer_path()).tolist() == [64, 220, 50256, 275]
    r = random.Random(5)
    texts = ["".join(r.choice("ab é.,'s\n\t 12ñß!²½ª«·×\x1c\x85 日🙂") for _ in range(r.randrange(50))) for _ in range(500)] + ["<|endoftext|> x", "it's 'S  \n\n a"]
    assert all(packing.token_ids(t, tokenizer_path()).tolist() == slow.encode(t, add_special_tokens=False).ids for t in texts)


def test_sum_of_squares_is_the_smallest_after_every_piece():
    rng = np.random.default_rng(4)
    for capacity, lengths in ((12, rng.integers(1, 13, 300)), (40, np.sort(rng.integers(1, 41, 300))[::-1])):
        bins, offsets = packing.sum_of_squares(lengths, capacity)
        gaps: dict[int, int] = {}
        for i, (size, b, at) in enumerate(zip(lengths.tolist(), bins.tolist(), offsets.tolist(), strict=True)):
            assert at == capacity - gaps.get(b, capacity)
            squares = lambda g: sum(n * n for x, n in Counter(g.values()).items() if x)
            room = sum(gaps.values())
            fits = {k: squares(gaps | {k: g - size}) for k, g in gaps.items() if g >= size}
            opened = squares(gaps | {len(gaps): capacity - size})
            may_open = lengths[i:].sum() > room or not fits
            best = min([*fits.values(), *([opened] if may_open else [])])
            gaps[b] = capacity - at - size
            assert squares(gaps) == best


def test_packing_depends_on_the_rows_alone(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 50)
    monkeypatch.setattr(packing, "RUN", 7)
    rows = [(k, "word " * (1 + k * 37 % 900)) for k in range(200)] + [(1000, "same row")] * 90 + [(None, "no id")] * 3
    pack = lambda df: Counter(tuple(x) for x in packing.pack(df, tokenizer_path()).collect())
    one = pack(docs_of(spark, rows))
    assert sum(one.values()) == len(rows) and one == pack(docs_of(spark, rows[::-1]).repartition(5))


def test_sum_of_squares_takes_the_gap_that_balances_best():
    bins, offsets = packing.sum_of_squares(np.array([6, 6, 4, 4, 10, 3]), 10)
    assert bins.tolist() == [0, 1, 1, 0, 2, 3] and offsets.tolist() == [0, 0, 6, 6, 0, 0]


# --- language-model scores ---------------------------------------------------------------------------------


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))


def brute_ppm(train, texts):
    counts = defaultdict(Counter)

    def symbols(t):
        b = " ".join(words(t)).encode()
        return [0] * lm_score.ORDER + [x + 1 for x in b] + [0]

    for t in train:
        s = symbols(t)
        for k in range(lm_score.ORDER, len(s)):
            for n in range(lm_score.ORDER + 1):
                counts[tuple(s[k - n : k])][s[k]] += 1
    out = []
    for t in texts:
        s, total = symbols(t), 0.0
        for k in range(lm_score.ORDER, len(s)):
            p, excluded = 1.0, set()
            for n in range(lm_score.ORDER, -1, -1):
                seen = counts.get(tuple(s[k - n : k]), {})
                free = {x: c for x, c in seen.items() if x not in excluded}
                if s[k] in free:
                    p *= (free[s[k]] - 0.5) / sum(free.values())
                    break
                if free:
                    p *= len(free) / 2 / sum(free.values())
                excluded |= set(seen)
            else:
                p /= 257 - len(excluded)
            total += math.log10(p)
        out.append(total)
    return out


def test_scores_match_brute_force(spark):
    rows = [(k, random.Random(k).choice(["Hello wörld the cat", "the cat sat", "日本 the", "a b c the the", "zebra QUILT"]) * (1 + k % 3)) for k in range(40)] + ODD
    got = lm_score.lm_scores(docs_of(spark, rows)).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    train = [t for i, t in rows if not held(i)]
    counts = Counter(w for t in train for w in words(t))
    n, v = sum(counts.values()) + len(train), len(counts) + 1
    counts[None] = len(train)
    model = brute_ppm(train, [t for _, t in rows])
    want = sorted(((str(i), held(i), len(words(t)) + 1, sum(counts[w] > 0 for w in [*words(t), None]), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in [*words(t), None]), 6), s) for (i, t), s in zip(rows, model, strict=True)), key=str)
    have = sorted(((str(x.doc_id), x.held_out, x.n_tokens, x.n_known, x.train_tokens, round(x.base_score, 6), x.score) for x in got), key=str)
    assert [x[:6] for x in have] == [x[:6] for x in want]
    assert np.allclose([x[6] for x in have], [x[6] for x in want], rtol=1e-5, atol=1e-4)


def test_rare_contexts_are_kept(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "MAX_NODES", 40, raising=False)
    monkeypatch.setattr(lm_score, "PARTITION_BYTES", 4000)
    monkeypatch.setattr(lm_score, "BLOCK_WORDS", 300)
    r = random.Random(8)
    vocabulary = ["".join(r.choice(string.ascii_lowercase[:9]) for _ in range(r.randrange(2, 9))) for _ in range(200)]
    rows = [(k, " ".join(r.choice(vocabulary) for _ in range(60))) for k in range(60)]
    train = [t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    got = {x.doc_id: x.score for x in lm_score.lm_scores(docs_of(spark, rows)).collect()}
    want = brute_ppm(train, [t for _, t in rows])
    assert np.allclose([got[i] for i, _ in rows], want, rtol=1e-5, atol=1e-4)


def test_scores_of_no_documents_and_of_no_training(spark):
    assert lm_score.lm_scores(docs_of(spark, [])).collect() == []
    alone = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    x = lm_score.lm_scores(docs_of(spark, [(alone, "some words")])).first()
    assert (x.n_tokens, x.n_known, x.train_tokens, x.base_score) == (3, 0, 0, 0.0) and x.score < 0


def test_scores_are_a_distribution():
    r = np.random.default_rng(0)
    size = lm_score.SYMBOLS
    # Eight common symbols, and a context that all symbols have followed.
    text = np.concatenate([np.zeros(5), r.integers(1, 9, 3000), *([1, 2, 3, 4, 5, x] for x in range(size))]).astype(np.int32)
    counted, counts = np.unique(lm_score.codes_of(text), return_counts=True)
    codes3, at = np.unique(counted % size**3, return_inverse=True)
    short = lm_score.Short(codes3, np.bincount(at, counts))
    for c in [*(counted[k] // size for k in (0, 50, 700)), int(lm_score.codes_of(np.array([1, 2, 3, 4, 5, 0]))[0]) // size, 123456789]:
        asked = c * size + np.arange(size)
        codes = np.unique(np.concatenate([counted, asked]))
        n = np.where(np.isin(codes, counted), counts[np.minimum(np.searchsorted(counted, codes), len(counted) - 1)], 0)
        scores = lm_score.code_scores(codes, n, short)
        assert abs((10 ** scores[np.searchsorted(codes, asked)]).sum() - 1) < 1e-9


# --- archives ----------------------------------------------------------------------------------------------


def test_archives_give_back_every_page(spark):
    import hashlib

    body = "<p>" + "payload " * 200 + "é</p>"
    rows = [(k, f"http://a/{k}", body) for k in range(30)] + [(100, None, None), (101, "http://é b/", ""), (102, "u\r\nX: y", "short"), (103, "v", "short"), (104, "w", "z" * 300_000), (29, "again", body), (None, "n", body), (None, "m", "w" * 2000)]
    got = warc.round_trip(spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, main int")).collect()
    want = Counter()
    for i, _, h in rows:
        p = (h or "").encode()
        revisit = h == body and i != 29
        want[(i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response", 29 if revisit else None)] += 1
    assert Counter(tuple(x) for x in got) == want
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_salvage_recovers_what_stands_around_damage():
    records = [warc.page_record(k, f"http://a/{k}", f"<p>page {k}</p>" * 50, __import__("hashlib").sha1((f"<p>page {k}</p>" * 50).encode()).hexdigest(), None, False) for k in range(6)]
    whole = b"".join(records)
    ids = lambda data: [x.headers["x-page-id"] for x in warc.salvage(data) if isinstance(x, warc.Record)]
    gaps = lambda data: [x for x in warc.salvage(data) if isinstance(x, warc.Gap)]
    assert ids(whole) == list("012345") and gaps(whole) == []
    starts = np.cumsum([0, *map(len, records)])
    broken = bytearray(whole)
    broken[starts[2] + 40] ^= 0xFF
    assert ids(bytes(broken)) == list("01345")
    assert [(g.start, g.end) for g in gaps(bytes(broken))] == [(starts[2], starts[3])]
    assert ids(whole[: starts[5] + 30]) == list("01234") and gaps(whole[: starts[5] + 30])[0].start == starts[5]
    junk = b"garbage \x1f\x8b\x08 more" + records[0] + b"\x00" * 99 + records[1]
    assert ids(junk) == ["0", "1"] and len(gaps(junk)) == 2
    plain = [zlib.decompress(r, 31) for r in records[:3]]
    assert ids(b"".join(plain)) == list("012")
    bad = plain[0] + plain[1].replace(b"page 1", b"PAGE 1", 1) + plain[2]
    assert ids(bad) == ["0", "2"] and "digest" in gaps(bad)[0].reason
    assert ids(plain[0] + records[1] + plain[2]) == list("012")
    assert list(warc.salvage(b"")) == [] and gaps(b"nothing here")[0][:2] == (0, 12)


def test_a_long_url_is_no_gap():
    url = "http://a/" + "é" * 40_000
    found = list(warc.salvage(warc.page_record(1, url, "<p>x</p>", __import__("hashlib").sha1(b"<p>x</p>").hexdigest(), None, False)))
    assert len(found) == 1 and isinstance(found[0], warc.Record) and found[0].headers["x-page-id"] == "1"


def foreign(kind, headers, block):
    head = "".join(f"{k}: {v}\r\n" for k, v in [("WARC-Type", kind), *headers, ("Content-Length", str(len(block)))])
    return b"WARC/1.0\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def test_foreign_records_are_read(spark, tmp_path):
    import hashlib

    body = b"some bytes"
    sha1, sha256 = hashlib.sha1(body).hexdigest(), hashlib.sha256(body).hexdigest()
    records = [
        foreign("response", [("WARC-Payload-Digest", f"sha1:{sha1}"), ("X-Page-Id", "abc")], body),
        foreign("response", [("WARC-Payload-Digest", f"sha-256:{sha256}"), ("X-Page-Id", "7" * 30)], body),
        foreign("response", [("WARC-Payload-Digest", "blake9:zzz"), ("X-Page-Id", "-4")], body),
        foreign("revisit", [("WARC-Payload-Digest", f"sha1:{sha1.upper()}"), ("X-Payload-Length", "many")], b""),
        foreign("revisit", [("WARC-Payload-Digest", "sha1:not base 32!")], b""),
        foreign("warcinfo", [], b"software: x"),
        foreign("response", [("WARC-Payload-Digest", f"sha256:{'0' * 64}")], body),
    ]
    (tmp_path / "foreign.warc").write_bytes(b"".join(records))
    (tmp_path / "empty.warc").write_bytes(b"")
    got = warc.read_archives(spark, str(tmp_path)).collect()
    assert sorted((x.record_type, str(x.page_id), str(x.payload_bytes), str(x.payload_digest)) for x in got if x.kind == "record") == sorted(
        [("response", "None", "10", sha1), ("response", "None", "10", sha1), ("response", "-4", "10", sha1), ("revisit", "None", "None", sha1), ("revisit", "None", "None", "None"), ("warcinfo", "None", "11", hashlib.sha1(b"software: x").hexdigest())]
    )
    assert ["digest" in x.reason for x in got if x.kind == "gap"] == [True]


def test_revisits_name_a_record_that_exists(spark, tmp_path):
    body = "<p>" + "payload " * 200
    rows = [(1, "http://a/1", body), (2, None, body), (2, "http://a/2", body), (3, "http://a/3", "short"), (None, "x", body)]
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path)).collect()
    found = [x for p in sorted(tmp_path.glob("*.warc.gz")) for x in warc.salvage(p.read_bytes())]
    ids = [x.headers["warc-record-id"] for x in found]
    assert len(set(ids)) == len(rows)
    named = [x.headers["warc-refers-to"] for x in found if x.headers["warc-type"] == "revisit"]
    assert len(named) == 2 and set(named) == {x.headers["warc-record-id"] for x in found if x.headers["warc-target-uri"] == "http://a/2"}


def test_salvage_takes_time_in_proportion():
    import hashlib
    import os
    import time

    page = os.urandom(30_000).hex()
    one = [warc.page_record(k, f"http://a/{k}", page + str(k), hashlib.sha1((page + str(k)).encode()).hexdigest(), None, False) for k in range(20)]
    whole = b"".join(one) * 100  # 60 MB and more
    began = time.time()
    assert len(whole) > 60_000_000 and sum(isinstance(x, warc.Record) for x in warc.salvage(whole[:-3])) == 1999
    assert time.time() - began < 20

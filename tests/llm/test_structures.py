"""Joins, packing, pages, pieces and the pipeline against brute force."""

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohortloom.llm import best_fit, components, embedding_join, html_text, ngram_join, pieces, registry
from cohortloom.llm.registry import held_out

registry.load()
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width):
    words = WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1)) if len(words) >= width else frozenset([tuple(words)])


def grouped(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def brute_sets(rows, width, percent):
    sets = {i: shingles(t, width) for i, t in rows if i is not None}
    ids = sorted(sets)
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return {i: len(s) for i, s in sets.items()}, grouped(ids, links)


@pytest.fixture(scope="module")
def copies():
    """Copies, near copies in a chain, a shared passage, short and empty texts, and ties."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(words, k=40))
    rows, base = [], rng.choices(words, k=90)
    for i in range(45):  # a group with changes here and there
        own = list(base)
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(90)] = rng.choice(words)
        rows.append((i, " ".join(own)))
    for i in range(100, 112):  # a chain
        base = list(base)
        base[rng.randrange(90)] = f"new{i}"
        rows.append((i, " ".join(base)))
    rows += [(200 + i, passage + " " + " ".join(rng.choices(words, k=60))) for i in range(40)]
    rows += [(300, None), (301, ""), (302, " \n"), (303, "one"), (304, "ONE"), (305, "one two"), (306, "one  two\t"), (307, "a b c"), (308, "A B c")]
    return rows + [(400 + i, rows[0][1].upper()) for i in range(20)]


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80), (1, 50), (2, 100)])
@pytest.mark.parametrize("sparse", [0, 16])
def test_similar_sets_against_all_pairs(spark, copies, monkeypatch, width, percent, sparse):
    monkeypatch.setattr(ngram_join, "SPARSE", sparse)  # 0: rounds of pivots first
    sizes, labels = brute_sets(copies, width, percent)
    docs = spark.createDataFrame(copies, "doc_id long, text string").withColumn("n", F.lit("x")).withColumn("token", F.lit(0))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_sets(docs, width, percent).collect()}
    assert got == {i: (sizes[i], labels[i]) for i in sizes}


@pytest.mark.parametrize("percent", [80, 90, 96])
def test_similar_sets_share_a_part_and_parities(percent):
    rng = np.random.default_rng(percent)
    frequent = (rng.random(ngram_join.COUNTERS) < 0.7).astype(np.uint8)  # so that some sets are dealt again with all tokens
    tried = 0
    for n in rng.integers(1, 500, 400):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.integers(0, n * (100 - percent) // 100 + 1):], rng.integers(0, 2**63, rng.integers(0, n * (100 - percent) // 100 + 1)).astype(np.uint64)]))
        both, either = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        if both == either or 100 * both < percent * either:
            continue
        tried += 1
        for levels in (np.zeros_like(frequent), frequent):
            assert len(np.intersect1d(*ngram_join.part_keys([a, b], percent, levels)))
        assert sum(int(x).bit_count() for x in (ngram_join.parities(a) ^ ngram_join.parities(b)).view(np.uint64)) <= either - both
    assert tried > 50


def test_passages_of_unlike_texts_open_no_bucket(spark, caplog):
    rows = []
    for group in range(20):
        passage = " ".join(f"p{group}x{i}" for i in range(14))
        rows += [(100 * group + i, passage + " " + " ".join(f"w{group}x{i}x{k}" for k in range(60))) for i in range(6)]
    with caplog.at_level("INFO", logger="cohortloom.llm.ngram_join"):
        got = ngram_join.similar_sets(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()
    assert all(r.doc_id == r.component_id for r in got) and not [x for x in caplog.messages if x.startswith("round")]


def test_similar_sets_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.similar_sets(empty).count() == 0 and ngram_join.one_of_each(empty).count() == 0
    text = " ".join(f"w{i}" for i in range(30_000))
    rows = [(None, text), (1, text), (1, text), (2, text), (3, None), (3, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component_id", F.lit("x"))
    got = Counter((r.doc_id, r.component_id) for r in ngram_join.similar_sets(docs).collect())
    assert got == Counter({(None, None): 2, (1, 1): 2, (2, 1): 1, (3, 3): 2})
    kept = ngram_join.one_of_each(docs)
    assert Counter(r.doc_id for r in kept.collect()) == Counter({None: 2, 1: 1, 3: 1}) and kept.columns == docs.columns


def test_broadcast_limits_change_nothing(spark, copies, monkeypatch):
    monkeypatch.setattr(ngram_join, "broadcast_if_small", lambda df: df)
    docs = spark.createDataFrame(copies, "doc_id long, text string")
    labels = brute_sets(copies, 5, 80)[1]
    assert {r.doc_id for r in ngram_join.one_of_each(docs).collect()} == set(labels.values())


def test_components_of_random_graphs(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, i) for i in range(2000, 2050)]
    nodes = {n for a, b in edges for n in (a, b) if a != b}
    df = spark.createDataFrame([*edges, (None, 3), (4, None)], "a long, b long")
    got = {r.node: r.component for r in components.components(df).collect()}
    want = grouped({n for e in edges for n in e}, edges)
    assert got == {n: want[n] for n in nodes}


def test_vectors_against_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 8))
    x = [list(map(float, centres[i % 12] + rng.normal(size=8) * 0.25)) for i in range(700)]
    x[10], x[11] = x[9], [2 * v for v in x[9]]
    odd = [None, [], [0.0] * 8, [float("nan")] + [1.0] * 7, [float("inf")] + [1.0] * 7, [None] + [1.0] * 7, [1e300] * 8, [1.0] * 8, [1.0, 0.0]]
    rows = [(i, v, 1) for i, v in enumerate(x)] + [(900 + i, v, 1) for i, v in enumerate(odd)]
    a = np.array(x) / np.linalg.norm(x, axis=1, keepdims=True)
    ones = np.ones(8) / np.sqrt(8)
    full = np.vstack([a, ones, ones])
    ids = [*range(700), 906, 907]
    near = full @ full.T >= 0.9
    np.fill_diagonal(near, False)
    labels = grouped(ids, [(ids[i], ids[j]) for i, j in zip(*np.nonzero(np.triu(near)))])
    want = {i: (int(near[k].sum()), labels[i]) for k, i in enumerate(ids)}
    want |= {900 + i: (0, 900 + i) for i in range(len(odd)) if 900 + i not in want}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, kept int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_join.near_vectors(df, block=32).collect()}
    assert got == want
    monkeypatch.setattr(embedding_join, "TILE_BYTES", 3 * 32 * 8 * 8)  # tiles of three blocks
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_join.near_vectors(df, block=32).collect()}
    assert got == want
    plain = df.filter("embedding IS NULL OR NOT exists(embedding, x -> abs(x) = 1e300)").withColumn("embedding", F.col("embedding").cast("array<float>"))
    single = plain.withColumn("embedding", F.col("embedding").cast("array<double>"))
    assert sorted(embedding_join.near_vectors(plain, block=32).collect()) == sorted(embedding_join.near_vectors(single, block=32).collect())
    again = embedding_join.near_vectors(df.limit(3).unionByName(df.limit(3)), block=32)
    assert again.count() == 6 and again.filter("kept").count() == 6
    assert embedding_join.near_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op5_embedding_near_dedup", "op7_quality_rules"])
def test_registered_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = registry.QUERIES[name](spark, sf_dir)
    cursor = con.execute(registry.ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(tuple(r[n] for n in names) for r in df.collect()) == sorted(cursor.fetchall())


def test_smallest_reached():
    assert embedding_join._smallest(6, np.array([5, 4, 1]), np.array([4, 1, 3])).tolist() == [0, 1, 2, 1, 1, 1]
    assert embedding_join._smallest(2, np.array([], dtype=int), np.array([], dtype=int)).tolist() == [0, 1]


@pytest.mark.parametrize("spaces", [" ", "\n", " \n", "\u2003"])
@pytest.mark.parametrize("tail", ["", "word", "\x1c", " é"])
def test_long_white_space_has_the_tokenizers_ids(spaces, tail):
    import public_tokenizers
    import tokenizers

    encoder = best_fit.Encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    same = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = "ab cd" + spaces * (best_fit.LONG_SPACE + 7) + tail
    assert np.frombuffer(encoder.encode(text), dtype="<u4").tolist() == same.encode(text, add_special_tokens=False).ids
    if tail == "word":
        ids = np.frombuffer(encoder.encode("x" + " " * 2_000_000 + "word"), dtype="<u4")
        assert len(ids) == 2_000_001


def test_encoder_holds_bounded_bytes():
    import public_tokenizers

    encoder = best_fit.Encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, cached=20_000)
    for at in range(300):
        encoder.encode(f"word{at} other{'x' * at} and {at}")
        assert encoder.held <= 20_000 and all(len(w) <= best_fit.LONG_WORD for w in encoder.seen)
    assert encoder.held == sum(200 + len(w) + len(ids) for w, ids in encoder.seen.items())


def test_lower_bound_and_best_fit():
    rng = np.random.default_rng(4)
    for _ in range(30):
        lengths = rng.integers(1, 65, rng.integers(1, 60))
        bins, offsets, fill = best_fit.best_fit_decreasing(lengths, 64)
        bound = best_fit.lower_bound(np.bincount(lengths, minlength=65), 64)
        assert -(-lengths.sum() // 64) <= bound <= len(fill) and max(fill) <= 64
        for b in range(len(fill)):
            at = sorted((offsets[i], lengths[i]) for i in np.flatnonzero(bins == b))
            assert [o for o, _ in at] == list(np.cumsum([0] + [n for _, n in at])[:-1])
    assert best_fit.lower_bound(np.bincount([40, 40, 40], minlength=65), 64) == 3  # two do not fit together
    assert best_fit.cut(2049, 1024) == [(0, 1), (1, 1024), (1025, 1024)] and best_fit.cut(1024, 1024) == [(0, 1024)]


def test_packing_against_the_tokenizer(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [None, "", "it's a  test\n\n of_words 12½ 34 ²", "héllo wörld naïve – “quotes” 日本語 🙂 \x1c   x", "a" * 5000, "many words here " * 3000, "don't  stop\t\r\n", "Ǆ ß ŀ"]
    rows = [(i % 7, t) for i, t in enumerate(texts * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("length", F.lit("x"))
    out = best_fit.pack(best_fit.token_pieces(docs, with_ids=True)).collect()
    want = Counter()
    for i, t in rows:
        ids = np.array([*(tokenizer.encode(t, add_special_tokens=False).ids if t else []), 2], dtype="<u4")
        first = len(ids) % 1024 or 1024
        for k, s in enumerate([0, *range(first, len(ids), 1024)]):
            own = ids[s : (first if k == 0 else s + 1024)]
            want[i, k, s, len(own), zlib.crc32(own.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in out)
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == list(np.cumsum([0] + [n for _, n in parts])[:-1]) and sum(n for _, n in parts) <= 1024
    assert best_fit.pack(best_fit.token_pieces(docs.limit(0))).count() == 0


def test_exchange_saves_sequences(spark):
    rows = [(i, 0, 0, 300 + (i * 37) % 400, 0) for i in range(900)]
    items = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    alone = best_fit.pack(items, part_items=30, rounds=0)
    mixed = best_fit.pack(items, part_items=30)
    count = [x.select("sequence_id").distinct().count() for x in (alone, mixed)]
    assert best_fit.bound_of(items) <= count[1] <= count[0] and mixed.count() == 900


def test_repeated_rows_spread_over_the_parts(spark):
    items = spark.createDataFrame([(None, 0, 0, 400, 0)] * 900, "doc_id long, piece int, start long, length long, ids_crc32 long")
    out = best_fit.pack(items, part_items=30, rounds=0)
    sizes = [r["count"] for r in out.groupBy(F.shiftright("sequence_id", 32)).count().collect()]
    assert out.columns == [*items.columns, "sequence_id", "offset"] and sum(sizes) == 900 and max(sizes) < 90


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<header><a href=/>Site</a></header><nav><ul><li><a>Menu</a></ul></nav><div class="cookie-notice">We use cookies</div><!-- <p>no</p> -->
<div id="wrap"><h1>Head &amp; line</h1><p>First <b>bold<br>part &copy;<p>Second&nbsp; <a href="x">link</a>ed
text</p><table><tr><td>1<td>2</table><div class=box-7>Read our notice</div></div>
<aside>side</aside><form><input>form</form><section id="comments"><article class="comment"><p>nice</p></article></section><footer>foot</footer></body></html>"""


def test_main_text_of_a_page():
    assert html_text.main_text(PAGE) == "Head & line First bold part © Second linked text 1 2 Read our notice"
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<nav>x</nav>") == ""
    assert html_text.main_text("a < b &lt;c&gt; <3") == "a < b <c> <3"
    assert html_text.main_text("<p>x" * 20_000) == " ".join(["x"] * 20_000)
    assert html_text.main_text("<div>" * 3000 + "deep") == "deep" and html_text.main_text("<div class='a>b") == "b"


def test_style_tree_removes_template(spark):
    pages = [(i, f"http://Host.example/{i}", PAGE.replace("First", f"First{i}").replace("Second", f"Second{i}").replace("1<td>2", f"{i}<td>{i * i}").replace("Head", f"Head{i}")) for i in range(8)]
    pages += [(100 + i, "http://host.example/same", pages[0][2]) for i in range(9)] + [(200, None, PAGE), (201, "http://other.example", PAGE), (202, "x", None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("node", F.lit(2))
    got = {r.page_id: r.main_text for r in html_text.extract(df).collect()}
    assert got[3] == "Head3 & line First3 bold part © Second3 linked text 3 9"  # the box is on every page
    assert got[100] == got[0] and got[200].endswith("notice") and got[201].endswith("notice") and got[202] == ""
    tree = {r.importance for r in html_text.style_tree(df).filter("host = 'other.example'").collect()}
    assert tree == {1.0} and html_text.extract(df.limit(0)).count() == 0


def test_near_copies_keep_their_article(spark):
    def near(i, body):
        return f"<html><body><ul><li><a>Menu {i}</a></ul><div class='x'>Buy {i} now</div><script>t={i}</script>{body}</body></html>"

    inside = "<article><h1>Head</h1><div class='entry-content'><p>One long first paragraph.</p><ul><li>Item</ul><table><tr><td>Cell</table></div></article>"
    outside = "<div id='w'><h1>Head</h1><div class='lead'><p>The lead of it all.</p></div><div class='rest'><p>One long paragraph of many words.</p><p>End.</p></div></div>"
    rows = [(i, "http://a.example/1", near(i, inside)) for i in range(6)] + [(10 + i, "http://b.example/1", near(i, outside)) for i in range(6)]
    for i in range(8):  # one content of a node that is template elsewhere is this page's own
        box = "<b>Its own remark</b>" if i == 7 else "Read our notice"
        rows.append((20 + i, "http://c.example/", f"<body><p>Story {i} has words of its own here.</p><p>And more {i}.</p><div class='box'>{box}</div></body>"))
    got = {r.page_id: r.main_text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(6):
        assert got[i] == "Head One long first paragraph. Item Cell"
        assert got[10 + i].endswith("Head The lead of it all. One long paragraph of many words. End.")
        assert got[20 + i] == f"Story {i} has words of its own here. And more {i}."
    assert got[27].endswith("Its own remark")


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load_vocabulary()


def test_pieces_against_the_library(spark, vocabulary):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(8)
    texts = [None, "", " ", "  two  blanks ", "tab\tand\nline\r\n", "日本 🙂 ﬁ ½ 　", "▁mark", "a" * 3000, "=" * 100, *[" " * k + "x" for k in range(60)]]
    texts += ["".join(rng.choice("aehtnisor  tion.\n") for _ in range(rng.randint(1, 80))) for _ in range(150)]
    docs = spark.createDataFrame([(i % 150, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumn("ids", F.lit(1))
    for r in pieces.decode(pieces.encode(docs.select("doc_id", "text"), vocabulary), vocabulary).collect():
        assert list(r.ids) == (model.encode(r.text) if r.text else []) and r.decoded == (r.text or "").replace("▁", " ")
    assert pieces.encode(docs.select("doc_id", "text").limit(0), vocabulary).count() == 0


def test_pieces_of_chunks_stay_in_their_task(spark, vocabulary, monkeypatch):
    """One scan and no shuffle; chunks of any size, rows of no sound text, and words as long as a file."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(11)
    texts = ["".join(rng.choice(["a", "the", " ", "  ", "\n", "\x00", "▁", "ß", "日", "🙂", " " * 17]) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += [None, "", "".join(rng.choice("aehtnisor") for _ in range(200_000)), "\n\n" + " " * 50_000 + "x", "=" * 100_000]
    docs = spark.createDataFrame([(i if i % 7 else None, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(2).localCheckpoint()
    broken = spark.createDataFrame([(1, bytearray(b"a\xff b")), (2, bytearray(b"\xe2\x96")), (3, bytearray(b"\xed\xa0\x80"))], "doc_id long, text binary")
    for size in (1, 100, 1 << 22):
        monkeypatch.setattr(pieces, "CHUNK_BYTES", size)
        encoded = pieces.encode(docs, vocabulary)
        rows = encoded.collect()
        assert sorted(map(repr, ((r.doc_id, r.text) for r in rows))) == sorted(map(repr, ((i if i % 7 else None, t) for i, t in enumerate(texts))))
        for r in rows:
            assert list(r.ids) == (model.encode(r.text) if r.text else [])
        for r in pieces.encode(broken.withColumn("text", F.col("text").cast("string")), vocabulary).collect():
            assert r.text == {1: "a\ufffd b", 2: "\ufffd", 3: "\ufffd"}[r.doc_id] and list(r.ids) == model.encode(r.text)
    plan = pieces.encode(spark.range(3).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text")), vocabulary)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Exchange" not in plan and "ExistingRDD" not in plan


@pytest.mark.parametrize("few", [0, 5, 10_000])
@pytest.mark.parametrize("group", [1, 200, 1 << 17])
def test_words_folded_together_equal_words_alone(vocabulary, monkeypatch, few, group):
    import pyarrow as pa

    monkeypatch.setattr(pieces, "FEW_WORDS", few)
    monkeypatch.setattr(pieces, "GROUP_CHARACTERS", group)
    table, rng = pieces.PieceTable(vocabulary), random.Random(group)
    words = sorted({"".join(rng.choice(["▁", "a", "t", "h", "e", "ing", "é", "日", "▁" * 16]) for _ in range(rng.randint(1, 12))) for _ in range(150)})
    got = []
    for some in pieces.Words.of(pa.array(words)):
        begins, via = pieces.fold(some, table)
        ids, sizes = pieces.ids_of_parts(some, begins, via, table)
        got += [x.tolist() for x in __import__("numpy").split(ids, sizes.cumsum()[:-1])]
    assert len(got) == len(words)
    for w, x in zip(words, got):
        ends = pieces.merge_once(w, vocabulary.pieces, vocabulary.late)
        parts = [w[a:b] for a, b in zip([0, *ends], ends)]
        assert x == [i for p in parts for i in ([vocabulary.pieces[p][0]] if p in vocabulary.pieces else [vocabulary.byte_ids[c] for c in p.encode()])], w


def test_decode_of_ids_that_are_no_text(spark, vocabulary):
    byte = vocabulary.byte_ids
    cases = [(None, None), ([], ""), ([-1, 10**6, None], ""), ([byte[0xE2], byte[0x96], byte[0x81], byte[65]], "A"), ([byte[65], byte[0xE6]], "A\ufffd")]
    rows = spark.createDataFrame([(k, ids) for k, (ids, _) in enumerate(cases)], "k int, ids array<int>")
    assert {r.k: r.decoded for r in pieces.decode(rows, vocabulary).collect()} == {k: t for k, (_, t) in enumerate(cases)}


def test_viterbi_against_dynamic_programming(spark):
    scored = {p: (i, s) for i, (p, s) in enumerate({"▁": -2.0, "▁a": -1.5, "a": -2.0, "b": -2.5, "ab": -3.9, "aba": -4.0, "▁ab": -3.0, "ba": -3.1}.items())}
    model = pieces.Vocabulary(scored, (), 99, False)
    words = ["▁" + "".join(x) for n in range(1, 7) for x in __import__("itertools").product("abz", repeat=n)][::7]
    got = {r.word: r.cuts for r in pieces.encode_words(spark.createDataFrame([(w,) for w in words], "word string"), model).collect()}
    for w in words:
        best = [(0.0, 0)]
        for e in range(1, len(w) + 1):
            ways = [(best[s][0] - scored[w[s:e]][1], s) for s in range(e) if w[s:e] in scored] + [(best[e - 1][0] + 4.0 + pieces.UNKNOWN_PENALTY, e - 1)]
            best.append(min(ways))
        cuts, at = ["0"] * (len(w) + 1), len(w)
        while True:
            cuts[at] = "1"
            if not at:
                break
            at = best[at][1]
        assert got[w] == "".join(cuts), w


def test_unigram_file_against_the_library(spark, tmp_path):
    import sentencepiece

    rng = random.Random(5)
    stems = ["".join(rng.choice("aehtnisor") for _ in range(rng.randint(2, 7))) for _ in range(120)]
    lines = [" ".join(rng.choice(stems) for _ in range(12)) for _ in range(400)]
    sentencepiece.SentencePieceTrainer.train(
        sentence_iterator=iter(lines), model_prefix=str(tmp_path / "uni"), vocab_size=400, model_type="unigram", byte_fallback=True,
        normalization_rule_name="identity", remove_extra_whitespaces=False, hard_vocab_limit=False, minloglevel=2,
    )
    path = str(tmp_path / "uni.model")
    model, unigram = sentencepiece.SentencePieceProcessor(model_file=path), pieces.load_vocabulary(path)
    assert not unigram.merges
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*lines[:60], "a strange ß word", "  two  blanks", "", None])], "doc_id long, text string")
    for r in pieces.encode(docs, unigram).collect():
        assert list(r.ids) == (model.encode(r.text) if r.text else [])


def test_pipeline_keeps_columns_and_follows_its_stages(spark, sf_dir):
    docs = registry.table(spark, sf_dir, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language ID", "quality classifier", "n-gram Jaccard join", "PII", "best-fit packing"]
    rows = {r.doc_id: r.text for r in docs.collect()}
    known = corpus_pipeline.keep_known_languages(spark, docs, sf_dir)
    good = corpus_pipeline.keep_good_quality(spark, known, sf_dir)
    labels = {r.doc_id: r.quality for r in registry.table(spark, sf_dir, "labels").filter(held_out()).collect()}
    left = {r.doc_id for r in good.select("doc_id").collect()}
    right = sum((labels[i] == 1) == (i in left) for i in labels)
    assert right >= 0.95 * len(labels) and known.columns == good.columns == docs.columns
    one = corpus_pipeline.keep_one_of_each(spark, good, sf_dir)
    want = brute_sets([(i, rows[i]) for i in left], 5, 80)[1]
    assert {r.doc_id for r in one.select("doc_id").collect()} == set(want.values()) and one.columns == docs.columns
    hidden = corpus_pipeline.hide_personal_data(spark, one, sf_dir)
    texts = {r.doc_id: r for r in hidden.collect()}
    assert hidden.columns == docs.columns and all(len(r.text) == r.n_chars for r in texts.values())
    for i, r in texts.items():
        for mail in re.findall(r"[\w.+-]+@[\w.-]+\.\w+", rows[i], re.A):
            assert mail not in r.text
    packed = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(texts)


def test_pipeline_on_empty_and_extra_columns(spark, sf_dir):
    docs = registry.table(spark, sf_dir, "documents").limit(0).withColumn("score", F.lit("x"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0 and "score" in docs.columns
    assert corpus_pipeline.pack_sequences(spark, docs, sf_dir).count() == 0

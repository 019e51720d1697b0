"""Spelling variants, the web archive and hard negatives against brute force and round trips."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.llm import hard_negatives, pii, spelling, web_archive
from cohortloom.session import scratch_path

LETTERS = "abcdefgàéö"


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts, ratio=5):
    out = {}
    for w, n in counts.items():
        near = [v for v in counts if one_edit(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= ratio * n else None
        out[w] = [n, len(near), form, counts[form] if form else None]
    for w, row in out.items():
        end = w
        while out[end][2]:
            end = out[end][2]
        row.append(end)
    return {w: tuple(r) for w, r in out.items()}


def found_variants(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in rows}


@pytest.fixture(scope="module")
def vocabulary():
    rng = random.Random(3)
    words = Counter()
    for _ in range(60):
        w = "".join(rng.choices(LETTERS, k=rng.randint(1, 9)))
        words[w] += rng.choice([1, 5, 30, 200, 1000])
        for _ in range(8):
            at, c = rng.randrange(len(w) + 1), rng.choice(LETTERS)
            words[rng.choice([w[:at] + c + w[at:], w[:at] + c + w[at + 1 :], w[:at] + w[at + 1 :]]) or "a"] += rng.choice([1, 2, 6, 40])
    words["aaaa"] += 5
    words["aaaaa"] += 25  # several deletions give one word
    return words


@pytest.mark.parametrize("blocks", [spelling.FILTER_BLOCKS, 100])
def test_variants_equal_brute_force(spark, vocabulary, blocks):
    rows = [(w, n) for w, n in vocabulary.items()]
    df = spark.createDataFrame(rows, "word string, n bigint")
    assert found_variants(spelling.group_variants(df, filter_blocks=blocks)) == brute_variants(vocabulary)


def test_filter_hashes_are_those_of_the_edited_words():
    word = "ängström"
    points = spelling.code_points([word], len(word))

    def whole(text):
        p = spelling.code_points([text], len(text))
        return int((p * spelling._powers(len(text))).sum(dtype=np.uint64))

    less, own = spelling.deletions(points)
    assert [int(x) for x in less[0]] == [whole(word[:i] + word[i + 1 :]) for i in range(len(word))] and own.all()
    alphabet = np.array([ord("z"), ord("ü")], np.uint64)
    other, larger = spelling.replacements(points, alphabet, 2, 5)
    assert [[int(x) for x in row] for row in other[0]] == [[whole(word[:i] + chr(c) + word[i + 1 :]) for c in alphabet] for i in range(2, 5)]
    assert larger[0].tolist() == [[ord(word[i]) < c for c in alphabet] for i in range(2, 5)]


def brute_words(rows, damage=199):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def test_words_of_documents_with_damage(spark):
    rng = random.Random(9)
    words = ["Straße", "ÉTUDES", "étudeS", "colour", "color", "abcdef", "ABCDEF", "naïveté", "short", "×÷×÷×÷", "x" * 5000]
    rows = [(i, " ".join(rng.choices(words, k=40)) + rng.choice(["", "1abcdefg", "_abcdefg\n", "-"])) for i in range(300)]
    rows += [(None, "abcdef " * 10), (7, None), (8, ""), (9, "12 .. 34"), (3, rows[3][1]), (3, "colours " * 9)]
    df = spark.createDataFrame([(i, t, i, "x") for i, t in rows], "doc_id bigint, text string, n bigint, word string")
    want = brute_words(rows, 19)
    got = {r["word"]: r["n"] for r in spelling.count_words(df, damage=19).collect()}
    assert got == want and len(want) > 12
    assert found_variants(spelling.group_variants(spelling.count_words(df, damage=19))) == brute_variants(want)


def test_variants_of_odd_tables(spark):
    empty = spark.createDataFrame([], "word string, n bigint, form string")
    assert spelling.group_variants(empty).count() == 0
    long = "ab" * 30_000
    rows = [(None, 4), ("", 9), ("abc", None), (long, 6), (long + "a", 100), (long[:-1], 2), ("abd", 3), ("abd", 4), ("abe", 35)]
    got = found_variants(spelling.group_variants(spark.createDataFrame(rows, "word string, n bigint")))
    assert got == brute_variants({long: 6, long + "a": 100, long[:-1]: 2, "abd": 7, "abe": 35})
    with pytest.raises(ValueError):
        spelling.group_variants(empty, ratio=1)


def test_roots_of_a_long_chain(spark):
    rows = [(f"w{i}", f"w{i + 1}") for i in range(37)]
    got = {r["word"]: r["root"] for r in spelling.roots(spark.createDataFrame(rows, "word string, form string")).collect()}
    assert got == {f"w{i}": "w37" for i in range(37)}


def pages_of(spark, rows):
    return spark.createDataFrame([(p, u, h, "x") for p, u, h in rows], "page_id bigint, url string, payload binary, digest string")


def brute_pages(rows, least=0):
    payloads = [(p, h or b"") for p, _, h in rows]
    out = []
    for p, h in payloads:
        same = [q for q, g in payloads if g == h and q is not None]
        owner = max(same, default=None)
        again = len(h) >= least and p != owner
        out.append((p, len(h), base64.b32encode(hashlib.sha1(h).digest()).decode(), "revisit" if again else "response", owner if again else None))
    return sorted(out, key=repr)


PAGES = [
    (1, "http://a/1", b"<p>one</p>"), (2, "http://a/2", b"<p>one</p>"), (3, "http://b/\r\nX-Page-ID: 9", b"two\r\n\r\nWARC/1.1\r\nWARC-Type: revisit\r\n\r\n"),
    (4, None, None), (5, "", b""), (6, "http://ü/é", "größe 中 \U0001f600".encode()), (7, "u", bytes(range(256)) * 3),
    (8, "u", b"x" * 300_000), (9, "v", b"x" * 300_000), (9, "v", b"x" * 300_000), (None, "n", b"none"), (None, "n", b"<p>one</p>"), (-3, "m", b"minus"),
]


@pytest.mark.parametrize("least", [0, 11])
def test_pages_are_read_back(spark, least):
    folder = scratch_path(spark, "archive")
    web_archive.store_pages(pages_of(spark, PAGES), folder, least)
    got = [tuple(r) for r in web_archive.read_back(spark, folder).collect()]
    assert sorted(got, key=repr) == brute_pages(PAGES, least)
    stored = [r["payload"] for r in spark.read.parquet(f"{folder}/blobs").collect()]
    assert sorted(bytes(b) for b in stored) == sorted({h or b"" for _, _, h in PAGES})


def test_empty_archive(spark):
    folder = scratch_path(spark, "archive")
    web_archive.store_pages(pages_of(spark, []), folder)
    assert web_archive.read_back(spark, folder).count() == 0 and web_archive.restore(spark, folder).count() == 0


def test_files_are_restored_byte_by_byte(spark, tmp_path):
    odd = b"WARC/1.0\r\nwarc-type: resource\r\nX-Odd:   kept  \r\ncontent-length: 9\r\n\r\nab\r\n\r\ncd\xff"
    bare = b"WARC/1.1\r\nWARC-Type: revisit\r\nContent-Type: application/http\r\nContent-Length: 4\r\n\r\n\r\n\r\n\r\n\r\n"
    (tmp_path / "in").mkdir()
    first, folder = scratch_path(spark, "archive"), scratch_path(spark, "again")
    web_archive.store_pages(pages_of(spark, PAGES), first)
    web_archive.write_files(spark, first, str(tmp_path / "made"))
    made = b"".join(p.read_bytes() for p in sorted((tmp_path / "made").glob("part-*")))
    (tmp_path / "in" / "a.warc").write_bytes(odd + b"\r\n\r\n" + bare + made + odd)
    (tmp_path / "in" / "b.warc").write_bytes(b"")
    (tmp_path / "in" / "c.warc").write_bytes(made)
    split = web_archive.split_files(spark, str(tmp_path / "in"))
    assert split.count() == 3 + 2 * len(PAGES)
    web_archive.store_records(split, folder)
    back = web_archive.restore(spark, folder).collect()
    records = Counter(bytes(r["record"]) for r in back)
    assert records[odd + b"\r\n\r\n"] == 1 and records[odd] == 1 and records[bare] == 1
    whole = Counter(bytes(r["record"]) for r in web_archive.restore(spark, first).collect())
    assert records - Counter([odd + b"\r\n\r\n", odd, bare]) == whole + whole
    assert spark.read.parquet(f"{folder}/blobs").count() == len({h or b"" for _, _, h in PAGES}) + 1
    read = {r["page_id"] for r in web_archive.parse(web_archive.restore(spark, folder)).collect()}
    assert read == {p for p, _, _ in PAGES}


@pytest.mark.parametrize("content", [b"junk", b"WARC/1.1\r\nContent-Length: 10\r\n\r\nabc", b"WARC/1.1\r\nWARC-Type: x\r\n\r\nabc"])
def test_broken_files_fail(content):
    with pytest.raises(ValueError):
        list(web_archive._split(content))


def test_a_changed_payload_fails(spark):
    folder = scratch_path(spark, "archive")
    web_archive.store_pages(pages_of(spark, PAGES[:4]), folder)
    broken = spark.read.parquet(f"{folder}/blobs").withColumn("payload", F.lit(b"changed")).collect()
    other = scratch_path(spark, "archive")
    spark.createDataFrame(broken, "digest string, owner bigint, bytes int, sha1 string, payload binary").write.parquet(f"{other}/blobs")
    spark.read.parquet(f"{folder}/records").write.parquet(f"{other}/records")
    with pytest.raises(Exception, match="digest"):
        web_archive.read_back(spark, other).collect()


@pytest.mark.parametrize(("width", "most"), [(64, 256), (700, 10**5), (1, 5), (0, 5), (3, 2**26)])
def test_scores_are_exact(width, most):
    rng = np.random.default_rng(width)
    x, y = rng.integers(-most, most + 1, (7, width)), rng.integers(-most, most + 1, (9, width))
    x[0], y[0] = most, -most
    primes = hard_negatives.primes_for(width * most * most)
    assert (hard_negatives.scores(hard_negatives.residues(x, primes), hard_negatives.residues(y, primes), primes) == x @ y.T).all()


def brute_negatives(rows, positives=5, negatives=5, low=80, high=100):
    own = [
        (i, str(c), [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, c, v in rows
        if i is not None and c is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out, done = [], []
    for i, c, v in own:
        if i % 100 or (i, c, v) in done:
            continue
        done.append((i, c, v))
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, d) for j, d, w in own if j != i and len(w) == len(v))
        for p, j, _ in [s for s in scored if s[2] == c][:positives]:
            far = [s for s in scored if s[2] != c and low * -p <= 100 * -s[0] <= high * -p][:negatives]
            out += [(i, j, k, n, -p, -s) for k, (s, n, _) in enumerate(far, 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(8)
    rows = [(int(i), int(rng.integers(0, 3)), [float(np.float32(x)) for x in rng.normal(0.2, 0.3, 8)]) for i in range(0, 1500, 4)]
    same = rows[5][2]
    rows += [(10_001 + i, i % 3, same) for i in range(30)]  # ties
    rows += [(20_000, 1, [1.0, 2.0]), (20_001, 1, [2.0, 2.0]), (20_002, 2, [1.5, 2.0]), (20_100, 1, []), (20_101, 1, []), (20_102, 0, [])]
    rows += [(30_000, None, same), (None, 1, same), (30_100, 1, None), (30_200, 1, [1.0, None]), (30_300, 0, [float("nan")] * 8), (30_400, 0, [float("inf")] * 8)]
    rows += [rows[25], rows[0], rows[0], (400, 2, same), (4, 1, same)]  # repeated rows and ids
    return rows


@pytest.mark.parametrize("at_once", [4096, 3])
def test_negatives_equal_brute_force(spark, vectors, at_once):
    df = spark.createDataFrame([(*r, 1) for r in vectors], "vec_id bigint, label int, embedding array<float>, score int")
    got = hard_negatives.mine(df.repartition(7), F.col("vec_id") % 100 == 0, anchors_at_once=at_once).collect()
    want = brute_negatives(vectors)
    assert sorted(tuple(r) for r in got) == want and len(want) > 100


def test_negatives_of_odd_tables(spark):
    kinds = "vec_id bigint, label int, embedding array<float>"
    anchor = F.col("vec_id") % 100 == 0
    for rows in ([], [(1, 1, [1.0])], [(100, 1, [1.0])], [(100, 1, None)], [(100, 1, [1.0]), (101, 1, [1.0])], [(100, 1, [-1.0]), (101, 1, [1.0]), (102, 2, [1.0])]):
        assert hard_negatives.mine(spark.createDataFrame(rows, kinds), anchor).collect() == []
    with pytest.raises(ValueError):
        hard_negatives.mine(spark.createDataFrame([(100, 1, [3e38])], kinds), anchor)


@pytest.mark.parametrize(
    "text",
    ["x@" + "a." * 50_000 + "com", "x@" + "a" * 100_000 + ".com", "x" * 100_000 + "@a_com"], ids=["labels", "host", "local"],
)
def test_hostile_texts_do_not_overflow_the_matcher(spark, text):
    df = spark.createDataFrame([(1, f"{text} and jo.doe@mail.example.org")], "doc_id bigint, text string")
    out = pii.pseudonymise(df, "key").first()["text"]
    assert "jo.doe@mail" not in out and out.endswith(".org")

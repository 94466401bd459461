"""Window, byte, SimHash and vector deduplication against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from millrace.llm import embeddings, repeats, simhash, suffix_dedup
from millrace.llm.components import components
from millrace.llm.embeddings import near_duplicate_vectors
from millrace.llm.simhash import BKTree, near_duplicates
from millrace.llm.suffix_dedup import remove_repeated_bytes
from millrace.llm.window_dedup import remove_repeated_windows
from millrace.session import table
from tests.llm.corpora import SF_DIR, repeated_texts


def brute_marks(docs, width):
    """Per document, which tokens lie in a window that starts in a document with a smaller id."""
    first = {}
    for doc_id, tokens in docs:
        if doc_id is not None:
            for s in range(len(tokens) - width + 1):
                key = tokens[s:s + width]
                first[key] = min(first.get(key, doc_id), doc_id)
    for doc_id, tokens in docs:
        marks = bytearray(len(tokens))
        if doc_id is not None:
            for s in range(len(tokens) - width + 1):
                if first[tokens[s:s + width]] < doc_id:
                    marks[s:s + width] = b"\1" * width
        yield doc_id, tokens, marks


def frame(spark, rows):
    # A clashing and an extra column must not matter.
    return spark.createDataFrame([(i, t, 7, "x") for i, t in rows], "doc_id long, text string, part int, kind string").repartition(3)


def check_bytes(rows, found, width):
    expected = sorted(
        (str(i), len(x), sum(m), [list(s.span()) for s in re.finditer(b"\1+", bytes(m))], bytes(v for v, gone in zip(x, m) if not gone))
        for i, x, m in brute_marks([(i, (t or "").encode()) for i, t in rows], width))
    actual = sorted((str(r.doc_id), r.n_bytes, r.n_removed, [list(s) for s in r.spans], bytes(r.kept)) for r in found.collect())
    assert actual == expected


@pytest.mark.parametrize("most_segments", [256, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_bytes_by_both_routes(spark, monkeypatch, seed, most_segments):
    monkeypatch.setattr(repeats, "MOST_SEGMENTS", most_segments)
    rows = repeated_texts(seed)
    check_bytes(rows, remove_repeated_bytes(frame(spark, rows), length=20), 20)


def test_suffix_sort_by_bytes_when_hashes_collide(spark):
    rng = random.Random(5)
    data = np.array([rng.choice(b"ab") for _ in range(300)], np.uint8)
    start = np.arange(0, 280, 7)
    group = np.repeat([0, 1], 20)
    suffixes = suffix_dedup.Suffixes(data, start, np.full(40, 20))
    order, extension = suffixes.sort(group)
    new = np.ones(40, bool)
    new[1:] = group[1:] != group[:-1]
    by_bytes = suffixes.sort_bytes(group, new)
    text = [data[s:s + 20].tobytes() for s in start]
    assert [text[i] for i in order] == [text[i] for i in by_bytes[0]]
    assert (extension == by_bytes[1]).all()


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_windows(spark, seed):
    rows = repeated_texts(seed)
    found = {}
    for r in remove_repeated_windows(frame(spark, rows), window=6).collect():
        found.setdefault(str(r.doc_id), []).append((r.n_words, r.n_removed, [list(s) for s in r.intervals], bytes(r.kept)))
    expected = {}
    for i, words, marks in brute_marks([(i, tuple((t or "").encode().split())) for i, t in rows], 6):
        spans = [[m.start(), m.end() - 1] for m in re.finditer(b"\1+", bytes(marks))]
        expected.setdefault(str(i), []).append((len(words), sum(marks), spans, b" ".join(w for w, gone in zip(words, marks) if not gone)))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in expected.items()}


def test_whole_tables_at_production_width(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_DIR, "documents").select("doc_id", "text").collect()]
    check_bytes(docs, remove_repeated_bytes(table(spark, SF_DIR, "documents")), 50)
    found = {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept).hexdigest()) for r in remove_repeated_windows(table(spark, SF_DIR, "documents")).collect()}
    for i, words, marks in brute_marks([(i, tuple(t.encode().split())) for i, t in docs], 50):
        kept = b" ".join(w for w, gone in zip(words, marks) if not gone)
        assert found[i] == (len(words), sum(marks), hashlib.sha256(kept).hexdigest())


def test_empty_tables(spark):
    none = frame(spark, [])
    assert remove_repeated_bytes(none).count() == remove_repeated_windows(none).count() == near_duplicates(none).count() == 0


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


@pytest.mark.parametrize("shard_size", [1024, 2])
def test_simhash(spark, shard_size):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    rows = [(-1, None), (0, ""), (1, "one"), (2, "one two"), (3, "One Two")]
    for i in range(4, 160):
        old = rng.choice(rows[4:])[1] if i > 20 and rng.random() < 0.6 else " ".join(rng.choice(words) for _ in range(rng.randint(40, 200)))
        parts = old.split()
        parts[rng.randrange(len(parts))] = rng.choice(words)
        rows.append((i, " ".join(parts)))
    rows.append((rows[50][0], rows[50][1]))
    codes = {t: brute_fingerprint(t) for _, t in rows}
    root = {c: c for c in codes.values()}
    changed = True
    least = {c: min(i for i, t in rows if codes[t] == c) for c in root}
    while changed:
        changed = False
        for a in root:
            for b in root:
                if (a ^ b).bit_count() <= 3 and least[b] < least[a]:
                    least[a], changed = least[b], True
    expected = sorted((i, f"{codes[t]:016x}", least[codes[t]]) for i, t in rows)
    found = near_duplicates(frame(spark, rows), shard_size=shard_size)
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in found.collect()) == expected
    assert len({e[2] for e in expected}) < len(expected) - 10


def test_simhash_bits_of_a_whole_table(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF_DIR, "documents").limit(40).collect()}
    for text in docs.values():
        assert simhash.fingerprint(text.encode()) == (lambda c: c - (1 << 64) if c >> 63 else c)(brute_fingerprint(text))


def test_bk_tree():
    rng = random.Random(3)
    codes = [rng.getrandbits(12) for _ in range(300)]
    tree = BKTree()
    for c in codes:
        tree.add(c)
    for c in codes[:60]:
        assert sorted(tree.codes[n] for n in tree.within(c, 2)) == sorted({x for x in codes if (x ^ c).bit_count() <= 2})


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 440)] + [(None, 3), (5, 5)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    least = {n: n for e in edges if None not in e for n in e}
    for _ in range(60):
        for a, b in edges:
            if a is not None:
                least[a] = least[b] = min(least[a], least[b])
    linked = {n for a, b in edges if a is not None and a != b for n in (a, b)}
    assert found == {n: least[n] for n in linked if least[n] != n}


def test_lattice_points():
    rng = np.random.default_rng(0)
    points = rng.normal(size=(200, 8)) * 2
    near = embeddings.nearest_e8(points)
    other = near[:, None, :] + embeddings.NEIGHBOURS
    assert (((points - near) ** 2).sum(axis=1)[:, None] <= ((points[:, None, :] - other) ** 2).sum(axis=2) + 1e-9).all()
    assert len(embeddings.NEIGHBOURS) == 240 and np.allclose((embeddings.NEIGHBOURS ** 2).sum(axis=1), 2)


@pytest.mark.parametrize("shard", [1024, 8])
def test_vectors(spark, shard):
    rng = np.random.default_rng(2)
    rows = []
    for c in range(12):
        centre = rng.normal(size=32)
        rows += [(len(rows) + k, (centre + rng.normal(size=32) * 0.08).tolist(), c % 3) for k in range(25)]
    n = len(rows)
    rows += [(n, rows[0][1], 0), (n + 1, rows[0][1], 1), (n + 2, None, 0), (n + 3, [0.0] * 32, 0), (n + 4, [float("nan")] + [1.0] * 31, 0), (n + 5, [None] + [1.0] * 31, 0),
             (n + 6, rows[0][1], None), (n + 7, [1.0, 2.0], 0), (n + 8, [], 0), (n + 9, [float("inf")] * 32, 0), (5, rows[5][1], rows[5][2]), (None, rows[0][1], 0),
             (n + 10, [3 * x for x in rows[0][1]], 0)]
    spark_rows = spark.createDataFrame([(i, v, l, 1) for i, v, l in rows], "vec_id long, embedding array<double>, label int, rep int")
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_duplicate_vectors(spark_rows, shard=shard).collect()}

    def ordinary(v):
        return v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    usable = {i: (np.array(v) / np.linalg.norm(v), l) for i, v, l in rows if i is not None and l is not None and ordinary(v)}
    links = {i: {j for j, (w, m) in usable.items() if j != i and m == l and len(v) == len(w) and v @ w >= 0.98} for i, (v, l) in usable.items()}
    assert sum(found[i][0] for i in links) >= 0.95 * sum(map(len, links.values())) > 500
    assert all(found[i][0] <= len(links[i]) for i in links)
    least = {i: i for i in links}
    for _ in range(10):
        for i in links:
            least[i] = min([least[i], *(least[j] for j in links[i])])
    assert sum(found[i][1] == least[i] for i in least) >= 0.97 * len(least)
    for i in range(n + 2, n + 10):
        assert found[i] == (0, i, True)
    assert found[None] == (0, None, True) and len(found) == len({r[0] for r in rows})


@pytest.mark.parametrize("width", [64, 256])
def test_vector_recall_near_the_threshold(width):
    """6,000 planted pairs at cosines from 0.980 to 0.985: the share whose cells meet."""
    rng = np.random.default_rng(width)
    a = rng.normal(size=(6000, width))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    away = rng.normal(size=a.shape)
    away -= (away * a).sum(axis=1, keepdims=True) * a
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    cosine = rng.uniform(0.980, 0.985, (len(a), 1))
    b = cosine * a + np.sqrt(1 - cosine ** 2) * away
    keys = [embeddings.lattice_keys(v, embeddings.TABLES, embeddings.PROBES, embeddings.CELL) for v in (a, b)]
    met = np.zeros(len(a), bool)
    for t in range(embeddings.TABLES):
        (home_a, probes_a), (home_b, probes_b) = [(home[:, t], probes[:, t]) for home, probes in keys]
        met |= (home_a == home_b) | (probes_a == home_b[:, None]).any(axis=1) | (probes_b == home_a[:, None]).any(axis=1)
    assert met.mean() >= 0.99

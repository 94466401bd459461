"""Reversible line deduplication against brute force, and its cuckoo filters."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from millrace.llm.line_dedup import BLANKS, CuckooFilter, LineIndex

SCHEMA = "doc_id long, text string"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def brute(index_rows, rows, min_docs, min_length=1):
    count = Counter()
    for _, text in index_rows:
        count.update({key_of(line) for line in (text or "").split("\n")})
    common = {k for k, n in count.items() if n >= min_docs and len(k) >= min_length}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if key_of(line) not in common]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def random_docs(seed, n):
    rng = random.Random(seed)
    lines = ["Home", " home\t", "Äpfel", "äpfel", "", "  ", "a\rb", "x" * 3000, "日本", "end.", "\x0bEND.\f"] + [f"line {i}" for i in range(12)]
    rows = [(None, None), (None, "Home\nend."), (1, ""), (1, ""), (2, "\n\n"), (3, "Home\nHome\n home")]
    rows += [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 8)))) for i in range(n)]
    return rows + [(n + 1, "\n".join(f"own {i % 700}" for i in range(5000)) + "\nHome")]


def cleaned(index, frame, **how):
    return sorted(map(tuple, index.clean(frame, **how).collect()), key=repr)


@pytest.mark.parametrize("how", [{}, {"broadcast_bytes": 0}])
def test_lines_against_brute_force(spark, tmp_path, how):
    rows = random_docs(1, 60)
    frame = spark.createDataFrame([(*r, 1, "own") for r in rows], SCHEMA + ", n long, common string")
    index = LineIndex(spark, str(tmp_path / "index"), min_docs=6)
    index.insert(frame)
    assert cleaned(index, frame, **how) == sorted(brute(rows, rows, 6), key=repr)


def test_deletions_undo_insertions(spark, tmp_path):
    """Parts in, parts out, in ten changes: after each the index is that of the documents it holds."""
    parts = [random_docs(seed, 20) for seed in range(4)]
    index = LineIndex(spark, str(tmp_path / "index"), min_docs=5, min_length=2, shard_keys=50)
    held = Counter()
    for sign, part in [(1, 0), (1, 1), (-1, 0), (1, 2), (1, 0), (-1, 1), (1, 3), (-1, 2), (1, 1), (-1, 3)]:
        (index.insert if sign > 0 else index.delete)(spark.createDataFrame(parts[part], SCHEMA))
        held[part] += sign
        present = [r for k in held.elements() for r in parts[k]]
        frame = spark.createDataFrame(present, SCHEMA)
        assert cleaned(index, frame) == sorted(brute(present, present, 5, 2), key=repr)
        assert cleaned(index, frame, broadcast_bytes=0) == cleaned(index, frame)
    assert len(index.generations()) == 10
    again = LineIndex(spark, str(tmp_path / "index"), min_docs=5, min_length=2)
    assert again.counts().count() == index.counts().count()
    with pytest.raises(ValueError):
        LineIndex(spark, str(tmp_path / "index"), min_docs=7)
    with pytest.raises(Exception, match="not inserted"):
        index.delete(spark.createDataFrame([(1, "never seen")], SCHEMA))
    assert len(index.generations()) == 10
    index.insert(spark.createDataFrame([(1, "Home")], SCHEMA))


def test_no_documents(spark, tmp_path):
    index = LineIndex(spark, str(tmp_path / "index"))
    empty = spark.createDataFrame([], SCHEMA)
    index.insert(empty)
    assert index.clean(empty).collect() == []
    assert index.filters().count() == 0 and index.counts().count() == 0


@pytest.mark.parametrize("n", [0, 1, 5, 4000, 50_000])
def test_cuckoo_filter(n):
    rng = np.random.default_rng(n)
    h1, h2 = rng.integers(-2**63, 2**63, (2, n), dtype=np.int64)
    held = CuckooFilter.holding(h1, h2)
    assert held.contains(h1, h2).all()
    other = rng.integers(-2**63, 2**63, (2, 100_000), dtype=np.int64)
    assert held.contains(*other).mean() < 1e-3
    half = n // 2
    few = min(half, 2000)
    held.delete(h1[:few], h2[:few])
    assert held.contains(h1[few:], h2[few:]).all()
    assert few < 100 or held.contains(h1[:few], h2[:few]).mean() < 0.01
    assert np.count_nonzero(held.slots) == n - few


def test_filter_that_is_full_says_so():
    rng = np.random.default_rng(3)
    h1, h2 = rng.integers(-2**63, 2**63, (2, 200), dtype=np.int64)
    assert not CuckooFilter(np.zeros(4 * 16, np.uint32)).insert(h1, h2)


def test_accidental_claims_are_settled_by_the_counts(spark, tmp_path, monkeypatch):
    """With fingerprints of two bits nearly every key is claimed; the lists of wrong claims keep the result exact."""
    from millrace.llm import line_dedup

    places = CuckooFilter._places

    def coarse(h1, h2, masks):
        prints, first, second = places(h1, h2 & np.int64(-1 << 62), masks)
        return prints, first, second

    rows = random_docs(9, 50)
    counts = Counter(key_of(line) for _, t in rows for line in set((t or "").split("\n")))
    keys = np.array([int.from_bytes(hashlib.md5(k.encode()).digest()[:8], "little", signed=True) for k in counts])
    after = np.array(list(counts.values()))
    monkeypatch.setattr(CuckooFilter, "_places", staticmethod(coarse))
    import pyarrow as pa

    table = pa.table({"h1": keys, "h2": keys[::-1].copy(), "before": np.zeros(len(keys), np.int64), "after": after})
    made = line_dedup._next_filter(6, 1)((pa.scalar(0),), pa.table({"slots": pa.array([], pa.binary())}), table)
    row = {c: made[c][0].as_py() for c in made.column_names}
    assert len(row["wrong"]) > 0
    assert (line_dedup._Shards(1, [row]).common(keys, keys[::-1].copy()) == (after >= 6)).all()

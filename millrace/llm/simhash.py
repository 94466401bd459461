"""Near duplicates by SimHash fingerprints, searched with BK-trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored
from millrace.llm.components import components

SEED = 42
BITS = 64
CHUNK = 1 << 18


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """64-bit SimHash of the word shingles: a bit is set if it is set in over half of the shingles' XXH64.

    A-Z count as lower case, words are separated by ASCII white space. Fewer words than ``shingle`` make one
    shingle; no words give zero.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    size = min(shingle, len(words))
    first, last = starts[:len(words) - size + 1].tolist(), (starts + lengths)[size - 1:].tolist()
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(first), CHUNK):
        hashes = [digest(joined[a:b], SEED) for a, b in zip(first[at:at + CHUNK], last[at:at + CHUNK])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8), bitorder="little").reshape(-1, BITS)
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(ones * 2 > len(first), bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(doc_id, code)`` per row; ``code`` holds the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [fingerprint(t, shingle) for t in batch["text"].cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(codes, pa.int64())], ["doc_id", "code"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, code long")


class BKTree:
    """Codes as a tree: a node's children are keyed by their Hamming distance to it."""

    def __init__(self) -> None:
        self.codes: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, code: int) -> None:
        if not self.codes:
            self.codes.append(code)
            self.children.append({})
            return
        at = 0
        while True:
            distance = (self.codes[at] ^ code).bit_count()
            if not distance:
                return
            child = self.children[at].get(distance)
            if child is None:
                self.children[at][distance] = len(self.codes)
                self.codes.append(code)
                self.children.append({})
                return
            at = child

    def within(self, code: int, radius: int) -> Iterator[int]:
        """Numbers of the nodes at most ``radius`` bits away; only edges within the radius of the distance are followed."""
        stack = [0] if self.codes else []
        while stack:
            at = stack.pop()
            distance = (self.codes[at] ^ code).bit_count()
            if distance <= radius:
                yield at
            for edge, child in self.children[at].items():
                if distance - radius <= edge <= distance + radius:
                    stack.append(child)


def _links(table: pa.Table, radius: int) -> pa.Table:
    """Codes of one pair of shards: each code that has a link, with the least code its links lead to here.

    Rows of side 0 make the tree and rows of side 1 query it; a shard alone queries itself.
    """
    mask = (1 << BITS) - 1
    sides = np.array(table["side"])
    codes = [c & mask for c in table["code"].to_pylist()]
    planted = [c for c, s in zip(codes, sides) if s == 0]
    asking = [c for c, s in zip(codes, sides) if s == 1] if (sides == 1).any() else planted
    tree = BKTree()
    for code in planted:
        tree.add(code)
    root: dict[int, int] = {}

    def find(code: int) -> int:
        top = code
        while root.setdefault(top, top) != top:
            top = root[top]
        while root[code] != top:
            root[code], code = top, root[code]
        return top

    for code in asking:
        for near in tree.within(code, radius):
            a, b = find(code), find(tree.codes[near])
            if a != b:
                root[max(a, b)] = min(a, b)
    signed = lambda c: c - (1 << BITS) if c >> (BITS - 1) else c
    pairs = [(signed(c), signed(find(c))) for c in root if find(c) != c]
    return pa.table({"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())})


def code_links(codes: DataFrame, radius: int, shard_size: int) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct codes at most ``radius`` bits apart, directly or through others.

    Two codes with ``radius`` or fewer differing bits agree in two of ``radius + 2`` stretches of the code, so
    codes that agree in two stretches share a bucket. A bucket of over ``shard_size`` codes is cut into shards,
    and every shard's tree is searched by every shard of its bucket, each pair of shards in a task of its own.
    """
    stretches = radius + 2
    cuts = [BITS * i // stretches for i in range(stretches + 1)]

    def stretch(i: int):
        width = cuts[i + 1] - cuts[i]
        return F.shiftrightunsigned("code", cuts[i]).bitwiseAND(F.lit((1 << width) - 1))

    places = [(i, j) for i in range(stretches) for j in range(i)]
    keys = F.array(*[
        F.struct(F.lit(n).alias("place"), F.shiftleft(stretch(i), 32).bitwiseOR(stretch(j)).alias("value")) for n, (i, j) in enumerate(places)
    ])
    members = codes.select("code", F.explode(keys).alias("key")).select("code", "key.*")
    sizes = members.groupBy("place", "value").count().where("count > 1")
    shards = F.ceil(F.col("count") / shard_size)
    dealt = members.join(sizes, ["place", "value"]).withColumn("shards", shards).withColumn("shard", F.pmod(F.xxhash64("code"), "shards"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1))
    pairs = dealt.select("place", "value", "code", "shard", other.alias("other")).select(
        "place", "value", "code", F.least("shard", "other").alias("low"), F.greatest("shard", "other").alias("high"),
        F.when(F.col("shard") <= F.col("other"), 0).otherwise(1).alias("side"),
    )
    return pairs.groupBy("place", "value", "low", "high").applyInArrow(lambda t: _links(t.select(["side", "code"]), radius), "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3, shard_size: int = 1024,
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per row: fingerprints link at ``radius`` or fewer differing bits.

    ``component_id`` is the least id reachable over links. Equal fingerprints are one code, so copies cost a
    row each; links are kept between codes only, and of a group of linked codes only as many as connect it.

    Null and wordless texts have fingerprint zero and link like any other. Repeated rows give repeated rows.
    A null id is kept in its row and is never a component's id unless all its rows have none, then the
    component is null. An empty table gives no rows; other columns are not read.
    """
    rows = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    codes = rows.groupBy("code").agg(F.min("doc_id").alias("least"))
    joined = components(code_links(codes.select("code"), radius, shard_size), "a", "b")
    grouped = codes.join(joined, codes["code"] == joined["node"], "left").select(
        "code", "least", F.coalesce("component", "code").alias("component"))
    best = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    named = grouped.join(best, "component").select("code", "component_id")
    return rows.join(named, "code").select(
        "doc_id", F.lower(F.lpad(F.hex("code"), BITS // 4, "0")).alias("fingerprint"), "component_id")

"""The Merkle manifest against a tree built level by level in plain Python."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from turnwise.llm import merkle, queries

SF = "/root/testdata/sf0.001"


def H(*digests):
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def value(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row):
    return H("".join(map(value, row)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def path(tree, i):
    steps = []
    for nodes in tree[:-1]:
        steps.append((i & 1, nodes[i ^ 1] if i ^ 1 < len(nodes) else None))
        i >>= 1
    return steps


def plain(rows):
    """The result rows of (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in langs:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = [levels([leaf(r) for r in groups[g]]) for g in langs]
    top = levels([t[-1][0] for t in trees])
    for k, g in enumerate(langs):
        for i, r in enumerate(groups[g]):
            steps = path(trees[k], i) + path(top, k)
            d = leaf(r)
            if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                d = leaf((*r[:3], r[3] + 1, r[4]))
            for right, other in steps:
                d = H(d) if other is None else H(other, d) if right else H(d, other)
            proof = H(*[s for _, s in steps if s])
            yield r[0], leaf(r), trees[k][-1][0], top[-1][0], proof, d, d == top[-1][0]


def made(docs, levels=merkle.LEVELS):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    rows = merkle.manifest(docs, tampered, levels).withColumn("leaf_now", F.coalesce("tampered", "digest"))
    return Counter(tuple(r) for r in merkle.verify(rows).collect())


@pytest.mark.parametrize("height", [1, 2, 3, 10])
def test_manifest_equals_plain_trees(spark, height):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", "source", "lang", "n_chars", "text").collect()
    assert made(docs, height) == Counter(plain([tuple(r) for r in rows]))


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", "source", "lang", "n_chars", "text").collect()
    got = queries.op11_merkle_manifest(spark, SF)
    assert Counter(tuple(r) for r in got.collect()) == Counter(plain([tuple(r) for r in rows]))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert 0 < got.where("NOT verified").count() < 0.3 * len(rows)


def test_odd_rows(spark, odd):
    more = [
        (20, "x", None, "s", None, "", 0, 0), (21, "é\U0001f600", None, None, 9, "", 0, 0), (22, "y", "", "s", 1, "", 0, 0),
        (23, "z", "de", "s", (1 << 63) - 1, "", 0, 0), (-4, "", "de", "", -1, "", 0, 0),
        *[(30 + i, "t", "fr", "s", i, "", 0, 0) for i in range(9)], (31, "other", "fr", "s", 3, "", 0, 0),
    ]
    docs = odd.unionByName(spark.createDataFrame(more, odd.schema))
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    want = Counter(plain(rows))
    for height in (1, 2, 10):
        assert made(docs, height) == want
    assert not made(odd.limit(0))
    one = docs.where("doc_id = 20")
    assert made(one) == Counter(plain([(20, "s", None, None, "x")]))


def test_witnesses_grow_as_siblings_complete():
    block = merkle.Block(2)
    digests = [bytes([i]) * 32 for i in range(3)]
    block.append(digests[0])
    assert block.has[0].tolist() == [False, False] and len(block.open) == 1
    block.append(digests[1])
    assert block.has[:2].tolist() == [[True, False]] * 2 and block.open[0][0] == 1
    block.append(digests[2])
    pair, alone = merkle.joined_hash(*digests[:2]), merkle.joined_hash(digests[2])
    assert block.close(0) == merkle.joined_hash(pair, alone)
    assert block.has[:3].tolist() == [[True, True], [True, True], [False, True]]
    assert block.siblings[2, 1].tobytes() == pair and block.siblings[0, 1].tobytes() == alone


def test_many_equal_rows_are_spread(spark):
    docs = spark.range(4000).selectExpr(
        "7L AS doc_id", "'t' AS text", "'en' AS lang", "'s' AS source", "1L AS n_chars"
    )
    leaves = merkle.document_leaves(docs, F.lit(False))
    # Ranges as on large data: none put together, a task for each file.
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.openCostInBytes": "1g"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        ranks = merkle.ranked(leaves, ["doc_id", "digest"])
        assert sorted(r.pos for r in ranks.collect()) == list(range(4000))
        assert max(r["count"] for r in ranks.groupBy(F.spark_partition_id()).count().collect()) < 1500
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert merkle.manifest(docs).select("root").distinct().count() == 1

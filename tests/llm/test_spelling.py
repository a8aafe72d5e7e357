"""Spelling variants against deletions and all pairs in plain Python."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from turnwise.llm import queries, spelling

SF = "/root/testdata/sf0.001"


def counted(docs):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def neighbours(words):
    """Near words: equal after one deletion at one place, or a deletion of each other."""
    near, holes = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[i, w[:i] + w[i + 1 :]].add(w)
            if (shorter := w[:i] + w[i + 1 :]) in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for same in holes.values():
        for w in same:
            near[w] |= same
    return {w: near[w] - {w} for w in words}


def plain(n):
    near, form = neighbours(n), {}
    for w in n:
        best = min(((-n[v], v.encode(), v) for v in near[w]), default=None)
        form[w] = best[2] if best and -best[0] >= 10 * n[w] else None
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        yield w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op12_spelling_variants(spark, SF)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert Counter(tuple(r) for r in got.collect()) == Counter(plain(counted([tuple(r) for r in docs])))


def words_frame(spark, n):
    return spark.createDataFrame(list(n.items()), "word string, n bigint")


def dense_words():
    rnd = random.Random(4)
    n = {}
    for alphabet in ("ab", "abé", "aÿb"):
        for _ in range(150):
            word = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(7, 12)))
            n[word] = rnd.choice([2, 2, 3, 25, 400, 9000])
    # A chunk that many words share, and a word of one letter at several lengths.
    n |= {"sharedbeginning" + a + b: 2 for a in "abcdefgh" for b in "abcdefgh"}
    return n | {"a" * k: 10**k for k in range(7, 15)}


@pytest.mark.parametrize("cuts,group", [(0, 1), (1, 3), (2, 20), (2, 10**6), (3, 1)])
def test_pairs_do_not_depend_on_the_cuts(spark, cuts, group):
    n = dense_words()
    got = Counter(
        frozenset((r.word, r.other)) for r in spelling.near_pairs(words_frame(spark, n), cuts, group).collect()
    )
    near = neighbours(n)
    assert got == Counter({frozenset((w, v)) for w in near for v in near[w]})


def test_forms_and_chains(spark):
    n = dense_words() | {"abcdefg": 2, "abcdefh": 20, "abcdeih": 200, "abcjeih": 2000, "abcjeik": 19999}
    got = Counter(tuple(r) for r in spelling.group_variants(words_frame(spark, n)).collect())
    assert got == Counter(plain(n))
    assert ("abcdefg", "abcdefh", "abcjeih", 2, 1, 20) in got
    # Ties go to the first word in code-point order.
    tied = {"aaaaaaa": 2, "aaaaaaz": 20, "aaaaaab": 20, "aaaaaaÿ": 20}
    assert ("aaaaaaa", "aaaaaab", "aaaaaab", 2, 3, 20) in [
        tuple(r) for r in spelling.group_variants(words_frame(spark, tied)).collect()
    ]


def test_a_shared_chunk_is_not_compared_as_a_whole(spark):
    """Cut keys stay small whatever the share of words with one chunk."""
    n = {f"commonstart{a}{b}{c}": 2 for a in "abcdefghij" for b in "abcdefghij" for c in "abcdefghij"}
    rows = spelling.positions(words_frame(spark, n))
    for _ in range(5):
        rows = spelling.cut(rows)
    # One letter is open in a chunk word, two in a partner that is one longer.
    assert rows.groupBy("key").count().agg(F.max("count")).first()[0] <= 10 + 10 * 10
    pairs = spelling.near_pairs(words_frame(spark, n), group=50)
    assert pairs.count() == 1000 * 27 // 2


def test_odd_rows(spark, odd, documents):
    texts = [
        (1, "Wörterbücher WÖRTERBÜCHER wÖRTERBÜCHER"), (None, "éclaireur éclaireur ÷÷×÷×÷÷ abcdefg abcdefg"),
        (5, "a1bcdefgh abcdef-g ĀbcdefgĀ abcdefǵ"), (6, "w" * 70_000 + " " + "w" * 70_000),
    ] + [(70 + i, "spelling spelling speling spellings") for i in range(60)]
    docs = odd.unionByName(documents([(i, t, "s") for i, t in texts]))
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    n = counted(rows)
    assert {r.word: r.n for r in spelling.vocabulary(docs).collect()} == n
    got = spelling.group_variants(spelling.vocabulary(docs))
    assert Counter(tuple(r) for r in got.collect()) == Counter(plain(n))
    assert spelling.group_variants(spelling.vocabulary(odd.limit(0))).count() == 0

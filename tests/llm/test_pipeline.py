"""The pipeline, stage by stage, against plain Python on the smallest tables."""

import base64
import re
from collections import Counter

import public_tokenizers
import tiktoken

import corpus_pipeline
from turnwise.llm import quality, secrets

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
STAGES = dict(corpus_pipeline.STAGES)


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def smallest_of_groups(texts):
    """The ids that stay: of each group of linked documents the smallest."""
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i for i in ids if find(i) == i}


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = STAGES["quality classifier"](spark, docs, SF).cache()
    scored = quality.score_documents(docs, labels).where("predicted = 1")
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in scored.collect()}
    bad = {r.doc_id for r in labels.where("quality = 0").collect()}
    clean = {r.doc_id for r in labels.where("quality = 1").collect()}
    kept = {r.doc_id for r in good.collect()}
    assert not kept & bad and clean <= kept

    once = STAGES["MinHash near-dedup"](spark, good, SF).cache()
    assert {r.doc_id for r in once.collect()} == smallest_of_groups({r.doc_id: r.text for r in good.collect()})

    masked = STAGES["secret scans"](spark, once, SF).cache()
    assert masked.count() == once.count() and masked.columns == docs.columns
    before = {r.doc_id: r.text for r in once.collect()}
    for r in masked.collect():
        assert (r.text == before[r.doc_id]) == (secrets.MASK not in r.text)
        assert not re.search(r"AKIA[A-Z0-9]{12}|[0-9a-f]{32}", r.text)
        assert r.n_chars == len(r.text)

    mixed = STAGES["mixing sources"](spark, masked, SF).cache()
    own = {r.doc_id: r for r in masked.collect()}
    times = Counter(r.doc_id for r in mixed.collect())
    assert max(times.values()) <= 2 and set(times) <= set(own)
    assert all(r == own[r.doc_id] for r in mixed.collect())

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(t): int(i) for t, i in map(bytes.split, lines)}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded = STAGES["byte-level BPE"](spark, mixed, SF).collect()
    assert len(coded) == mixed.count()
    for r in coded:
        assert r.token_ids == coder.encode_ordinary(r.text) and r.n_tokens == len(r.token_ids)
        assert r.text == own[r.doc_id].text


def test_stages_on_odd_and_empty_tables(spark, odd):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, odd.limit(0)):
            out = stage(spark, docs, SF)
            assert out.columns[: len(docs.columns)] == docs.columns, name
            assert out.count() <= 2 * docs.count()
    # Rows without words or without an id stay; repeated rows and equal texts leave one.
    left = Counter(r.doc_id for r in STAGES["MinHash near-dedup"](spark, odd, SF).collect())
    assert left == Counter([1, 2, 3, 4, 6, 8, None, 9])

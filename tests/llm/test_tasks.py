"""Operators that run inside tasks, against brute force, round trips and held-out labels."""

import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from turnwise.llm import bpe, chosenpath, covertree, graph, packing, quality, queries, styletree, winnowing

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_bpe_equals_tiktoken(odd, documents):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("ab cé\n \t.'s09 ") for _ in range(rnd.randint(0, 200))) for _ in range(200)]
    texts += ["a" * 500, "ab" * 700 + " " * 40 + "!?" * 99, "日本語 テキスト" * 20, "<|endoftext|>", "  a  b ", "don't CAN'T"]
    docs = odd.unionByName(documents([(100 + i, t, "s") for i, t in enumerate(texts)]))
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={}
    )
    coded = bpe.encode(docs, PATH, public_tokenizers.PATTERN, decoded="decoded")
    again = bpe.decode(coded, PATH, public_tokenizers.PATTERN, decoded="again").collect()
    assert len(again) == docs.count()
    for r in again:
        assert r.token_ids == library.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == bytes(r.again) == (r.text or "").encode()
    assert bpe.encode(odd.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_plain_characters_are_classed_alike():
    """On plain characters both regular expression engines agree, so cuts are safe there."""
    import pyarrow as pa
    import pyarrow.compute as pc
    import regex

    each = [chr(i) for i in range(0x10000) if not 0xD800 <= i < 0xE000]
    plain = [c for c, odd in zip(each, pc.match_substring_regex(pa.array(each), bpe.NOT_PLAIN).to_pylist()) if not odd]
    assert len(plain) > 20_000
    for ours, theirs in ((r"\p{L}", r"\p{L}"), (r"\s", r"\s")):
        found = pc.match_substring_regex(pa.array(plain), ours).to_pylist()
        assert found == [bool(regex.match(theirs, c)) for c in plain]


def tokenizer_and_library():
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={}
    )
    state = bpe.Tokenizer(PATH, public_tokenizers.PATTERN)
    state.open()
    return state, library


def lists(state, texts):
    import pyarrow as pa

    flat, n = state.encode(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])]


def test_bpe_cuts_and_generations(monkeypatch):
    """Any mix of marks, white space and letters, also when kept pieces go at once."""
    rnd = random.Random(9)
    state, library = tokenizer_and_library()
    alphabets = ("ab's't re\n", "a1'!. ", "é'ss ÿ\u2019", "\u2028\x1c\x85\xa0 a'", "日本 ア1", "\ue000\ue001 a\x00'")
    for most in (10**6, 20):
        monkeypatch.setattr(bpe, "PIECES_KEPT", most)
        texts = [
            "".join(rnd.choice(a) for _ in range(rnd.randint(0, 60))) for a in alphabets for _ in range(300)
        ]
        for first in range(0, len(texts), 100):
            some = texts[first : first + 100]
            assert lists(state, some) == [library.encode_ordinary(t) for t in some]
        assert len(state.young.pieces) <= most + 3000


def test_bpe_long_words():
    rnd = random.Random(8)
    state, library = tokenizer_and_library()
    small = "abcdefghijklmnopqrstuvwxyz"
    texts = [
        "".join(rnd.choice(a) for _ in range(n))
        for a in (small, "ab", "a!", small + small.upper(), "er ti", "0123456789", "aeéñ") for n in (47, 48, 49, 97, 1000)
    ]
    texts += ["a" * 3000, "ab" * 3000, "thethis" * 500, "!" * 3001, "".join(rnd.choice(small) for _ in range(100_000))]
    assert lists(state, texts) == [library.encode_ordinary(t) for t in texts]


def test_bpe_keeps_a_bounded_number_of_pieces(monkeypatch):
    monkeypatch.setattr(bpe, "PIECES_KEPT", 500)
    state, _ = tokenizer_and_library()
    words = ["tion", "the", "ing"]
    for n in range(30):
        lists(state, [f"{rnd}-{w}-{n}" for w in words for rnd in range(20)])
        assert len(state.young.pieces) + len(state.old.pieces) < 2 * (500 + 400)


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({k: k + 32 for k in range(65, 91)}))
    return {tuple(words[j : j + size]) for j in range(max(1, len(words) - size + 1))} if words else set()


def smallest_reached(links, ids):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_components(spark):
    rnd = random.Random(5)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(400 + i, 401 + i) for i in range(60)]
    got = graph.components(spark.createDataFrame(links, "u long, v long")).collect()
    want = smallest_reached(links, {x for l in links for x in l})
    assert {r.id: r.component_id for r in got} == {
        x: want[x] for a, b in links if a != b for x in (a, b)
    }


def near_rows():
    rnd = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for group in range(12):
        text = [rnd.choice(words) for _ in range(rnd.randint(3, 120))]
        for _ in range(rnd.randint(1, 14)):
            copy = [rnd.choice(words) if rnd.random() < 0.03 else w for w in text]
            rows.append((len(rows), " ".join(copy), "a"))
    return rows


def brute_near(rows, size):
    sets = {i: shingles(t, size) for i, t, _ in rows}
    ids = list(sets)
    links = [
        (a, b) for n, a in enumerate(ids) for b in ids[n + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    label = smallest_reached(links, ids)
    return {i: (len(sets[i]), label[i]) for i in ids}


def test_near_duplicates(documents, odd, monkeypatch):
    rows = near_rows()
    for small in (False, True):
        if small:  # several levels and blocks
            monkeypatch.setattr(chosenpath, "NODE", 3)
            monkeypatch.setattr(chosenpath, "BLOCK", 4)
        got = chosenpath.near_duplicates(documents(rows), size=4).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_near(rows, 4)
    found = chosenpath.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    by = {r.doc_id: r for r in found}
    assert by[5].component_id == 4 and not by[5].kept and by[7].component_id == 6
    assert by[1].n_shingles == by[3].n_shingles == 0 and by[2].component_id == 2
    kept = chosenpath.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "6", "8", "9", "None"]
    assert chosenpath.near_duplicates(odd.limit(0)).count() == 0


def test_cover_tree(spark, monkeypatch):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 8))
    rows = []
    for i in range(700):
        v = base[i % 60] + rng.normal(scale=0.12, size=8) * (i % 4)
        rows.append((i, [float(x) for x in v.astype(np.float32)], i % 3))
    one = [1.0] + [0.0] * 7
    rows += [
        (800, [0.0] * 8, 1), (801, [math.nan] + one[1:], 1), (802, None, 1), (803, one, None), (804, one, 9), (805, one, 9),
        (806, [2.0] + one[1:], 9), (807, [], 9), (808, [None] + one[1:], 9), (809, [math.inf] * 8, 9), (810, [1.0, 0.0], 9),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("rep", F.lit(1))
    good = {}
    for i, v, label in rows:
        a = np.array([math.nan if x is None else x for x in v or []], float)
        if label is not None and len(a) and np.isfinite(a).all() and a.any():
            good[i] = (label, a / np.sqrt((a * a).sum()))
    links = [
        (i, j) for i in good for j in good
        if i < j and good[i][0] == good[j][0] and len(good[i][1]) == len(good[j][1]) and good[i][1] @ good[j][1] >= 0.98
    ]
    label = smallest_reached(links, [r[0] for r in rows])
    for leaf in (2_000, 20):
        monkeypatch.setattr(covertree, "LEAF", leaf)
        got = covertree.near_duplicates(vectors).collect()
        assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {
            i: (sum(i in l for l in links), label[i]) for i, _, _ in rows
        }
    assert covertree.near_duplicates(vectors.limit(0)).count() == 0


def test_cover_tree_repeated_ids(spark):
    """Rows of one id with different vectors, a repeated row and null ids."""
    rows = [
        (1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [1.0, 0.01], 1), (3, [0.01, 1.0], 1), (3, [0.01, 1.0], 1),
        (None, [-1.0, 0.0], 1), (9, [-1.0, 0.01], 1), (None, None, None),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = [(r.vec_id, r.n_links) for r in covertree.near_duplicates(vectors).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, 1), (1, 2), (2, 1), (3, 2), (3, 2), (None, 1), (9, 1), (None, 0)], key=str
    )
    by = {(r.vec_id, r.n_links): r.component_id for r in covertree.near_duplicates(vectors).collect()}
    assert by[2, 1] == by[3, 2] == 1 and by[9, 1] == 9


def test_nets_cover_and_keep_apart():
    rng = np.random.default_rng(5)
    v = np.repeat(rng.normal(size=(150, 6)), 5, axis=0) + rng.normal(scale=0.1, size=(750, 6))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    apart = np.sqrt(np.maximum(0, 2 - 2 * v @ v.T))
    above = np.zeros(len(v), np.int64)
    for radius in covertree.RADII:
        node, far, centres = covertree._net(v, above, radius)
        assert (node[centres] == np.arange(len(centres))).all() and (above[centres[node]] == above).all()
        assert np.allclose(far, apart[centres[node], np.arange(len(v))], atol=1e-6) and (far <= radius).all()
        same = (above[centres][:, None] == above[centres][None, :]) & ~np.eye(len(centres), dtype=bool)
        assert (apart[np.ix_(centres, centres)][same] > radius - 1e-9).all()
        above = node


def test_packing_round_trip(odd):
    packed = packing.pack_texts(odd, length=512)
    pieces = packing.segments(packed).collect()
    texts = {}
    for r in packed.collect():
        assert len(r.ids) == 1024 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= 512
        assert r.position_resets == r.cu_seqlens[:-1]
    # Repeated rows are documents of their own: their pieces come as often.
    for p in pieces:
        texts.setdefault(p.id, {}).setdefault(p.start, []).append(bytes(p.ids))
    for r in odd.select("doc_id", "text").distinct().collect():
        times = odd.where(F.col("doc_id").eqNullSafe(r.doc_id)).count()
        parts = texts[r.doc_id]
        assert all(len(p) == times for p in parts.values())
        ids = np.frombuffer(b"".join(parts[s][0] for s in sorted(parts)), "<u2")
        assert ids[-1] == packing.END and ids[:-1].astype(np.uint8).tobytes() == (r.text or "").encode()
    assert packing.pack_texts(odd.limit(0)).count() == 0


def test_packing_holds_token_ids(spark, odd, tmp_path):
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={}
    )
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    packed = queries.op6_pack_tokens(spark, str(tmp_path))
    for r in packed.collect():
        ids = np.frombuffer(r.ids, "<u2")
        assert len(ids) == packing.LENGTH and r.cu_seqlens[-1] == r.n_tokens
        assert (ids[r.n_tokens :] == queries.PAD).all() and (ids[: r.n_tokens] != queries.PAD).all()
    texts = {}
    for p in packing.segments(packed).collect():
        texts.setdefault(p.id, {}).setdefault(p.start, []).append(np.frombuffer(p.ids, "<u2").tolist())
    want = {r.doc_id: r.text for r in odd.collect()}
    assert texts.keys() == want.keys() and len(texts[8][0]) == 3
    for key, parts in texts.items():
        assert sum((parts[s][0] for s in sorted(parts)), []) == [*library.encode_ordinary(want[key] or ""), queries.END]
    with pytest.raises(ValueError):
        packing.pack_tokens(odd, PATH, public_tokenizers.PATTERN, packing.END, packing.PAD)


def test_best_fit_decreasing():
    rnd = random.Random(1)
    lengths = [rnd.randint(1, 64) for _ in range(500)]
    rows, open_ = packing.best_fit_decreasing(lengths, 64), []
    for n in sorted(lengths, reverse=True):
        fitting = [r for r in open_ if r >= n]
        if fitting:
            open_.remove(min(fitting))
            open_.append(min(fitting) - n)
        else:
            open_.append(64 - n)
    assert sorted(64 - sum(lengths[i] for i in r) for r in rows) == sorted(open_)


def test_html_main_text(spark):
    cases = {
        "<div class=menu>a<div>b</div></div><div>Hello &amp; <b>w</b>orld<br>z<p>q<p>r<ul><li>1<li>2</ul>": "Hello & world z\nq\nr\n1\n2",
        "": "", None: "", "<p title='a>b'>x": "x", "<script>x": "", "plain <": "plain <", "<!-- x": "",
        "<article><h1>T</h1><aside>n</aside><div id='comments'>c</div><p>a \n b</p></article>out": "T\na b",
        "<article></article><p>only": "only",
    }
    pages = spark.createDataFrame([(i, None, h, "x") for i, h in enumerate(cases)], "page_id long, url string, html string, low string")
    got = styletree.extract_text(pages).collect()
    assert {r.html: r.text for r in got} == cases
    assert styletree.extract_text(pages.limit(0)).count() == 0


def test_site_style_tree(spark):
    page = "<div class='top'>Same links</div><div class='body'><p>Story {0} tells {1}</p></div><div>Legal text</div>"
    rows = [(i, "http://a.example/x", page.format(i, i * 7)) for i in range(40)]
    rows += [(90, "http://b.example/", page.format(1, 2))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in styletree.extract_text(pages).collect()}
    assert all(got[i] == f"Story {i} tells {i * 7}" for i in range(40))
    # A page alone on its host has nothing to be compared with.
    assert got[90] == "Same links\nStory 1 tells 2\nLegal text"


def test_copies_do_not_empty_a_host(spark):
    page = "<html><head><title>{2}</title></head><body><div class='top'>Same links</div><div class='text'><p>Story {0}<p>tells {1}</div></body></html>"
    plain = "<html><body><p>Story {0}<p>tells {1}</body></html>"
    rows, want = [], {}

    def add(host, html, *said):
        want[len(rows)] = "\n".join(said)
        rows.append((len(rows), f"http://{host}/{len(rows)}", html.format(said[-2][6:], said[-1][6:], len(rows))))

    # Ten pages, eight of them copies; a host of copies alone; mostly copies of one page.
    for i in [0] * 8 + [1, 2]:
        add("ten.example", plain, f"Story {i}", f"tells {i}")
    for i in range(6):
        add("copies.example", page, "Same links", "Story x", "tells x")
    # Among enough distinct pages the links are known as such, on copies too.
    for i in [0] * 90 + list(range(1, 11)):
        add("many.example", page, f"Story {i}", f"tells {i}")
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in styletree.extract_text(pages).collect()} == want
    low = {r.host: len(r.low) for r in styletree.low_branches(pages).collect()}
    assert low == {"many.example": 1}


def test_a_branch_above_all_text_stays(spark):
    low = {styletree._branch(("html",)), styletree._branch(("html", "div")), styletree._branch(("html", "div", "h1"))}
    assert styletree.main_text("<html><div><h1>a</h1><p>b</div>", low) == "b"
    assert styletree.main_text("<html><div><h1>a</h1></div>", low) == "a"
    assert styletree.main_text("<html><div>a</div><div>b</div><p>c", low) == "c"
    assert styletree.main_text("<html><div><h1>a</h1><ul><li>b</ul></div>", low | {styletree._branch(("html", "div", "ul"))}) == "a\nb"


def test_names_are_whole_words_and_do_not_hide_the_article():
    keeps = {
        '<div class="content has-sidebar"><article>a</article></div>': "a", '<main class="social-science">a</main>': "a",
        '<div class="post no-comments">a</div>': "a", '<div class="related"><main><p>a</p></main></div>': "a",
        '<div id="sidebar-less-nav"><article>a<p class="notice">n</p></article>': "a", '<div class="admin unrelated">a</div>': "a",
    }
    for page, text in keeps.items():
        assert styletree.main_text(page, set()) == text, page
    names = "site-footer main_nav cookie-banner ad ads2 sidebar-left comment-list social-links related-posts post-comments"
    for name in names.split():
        assert styletree.main_text(f"<p>a</p><div class='x {name}'>b</div>", set()) == "a", name
    # Articles inside noise are teasers where another one is not.
    assert styletree.main_text("<article>a</article><div class='related'><article>b</article></div>", set()) == "a"


def test_a_repeated_notice_inside_an_article_goes(spark):
    page = "<article id='post-{0}'><p>Story {0}</p><div class='box-{0}'>Sign up today</div><p>ends {1}</p></article><div>Legal</div>"
    rows = [(i, "http://a.example/x", page.format(i, i * 7)) for i in range(30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in styletree.extract_text(pages).collect()}
    assert all(got[i] == f"Story {i}\nends {i * 7}" for i in range(30))


def test_deep_and_long_pages_take_linear_time(spark):
    import time

    pages = [
        "<div>" * 50_000 + "a", "<div>a" * 50_000, "<b>" * 50_000 + "<hr>a" * 50_000, "<li>a" * 50_000, "<div>" * 50_000 + "</p>" * 50_000 + "a",
        "<ul><li>" * 25_000 + "a", "<p>a" * 50_000, "<table><tr><td>" * 15_000 + "a" + "</td>" * 15_000,
    ]
    start = time.monotonic()
    for page in pages:
        found, nodes = styletree.blocks(page)
        styletree.branches(styletree._told(found), nodes)
        assert styletree.main_text(page, {styletree._branch(("div", "div"))}).startswith("a")
    assert time.monotonic() - start < 60
    rows = spark.createDataFrame([(i, "http://a.example/x", "<div>a" * 3000) for i in (1, 1, None)], "page_id long, url string, html string")
    assert {r.text for r in styletree.extract_text(rows).collect()} == {"\n".join(["a"] * 3000)}


def test_winnowing(odd, monkeypatch):
    text = "ab" * 300 + "the quick brown fox jumps over the lazy dog " * 5
    h = winnowing.gram_hashes(text)
    best = []
    for i in range(len(h) - winnowing.W + 1):
        part = h[i : i + winnowing.W]
        at = i + max(np.flatnonzero(part == part.min()))
        if not best or best[-1] != at:
            best.append(at)
    assert winnowing.winnow(text)[1].tolist() == best
    rows = sorted(
        ((-1 if r.doc_id is None else r.doc_id, r.text or "") for r in odd.collect()), key=lambda r: (-r[0], r[1])
    )
    want = []
    for i, (key, own) in enumerate(rows):
        words = winnowing.edited(own, rows[(i + 1) % len(rows)][1])
        want.append((key, len(own), winnowing.sha256(words.encode()).hexdigest()))
    for size in (1_000, 2):
        monkeypatch.setattr(winnowing, "ROWS_PER_RANGE", size)
        got = winnowing.compare_edited(odd).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_chars, r.edited_sha256) for r in got) == sorted(want)
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert winnowing.compare_edited(odd.limit(0)).count() == 0
    assert winnowing.fingerprints(odd).where("text is null or text = ''").select("fingerprint").distinct().first()[0] == ""


def test_short_texts_are_near_their_edited_text(spark):
    rows = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet").select("text").limit(300).collect()
    texts = [r.text or "" for r in rows]
    for size in (30, 40, 60, 80, 120):
        # Another passage of each document, the same in all sizes.
        short = [t[len(t) // 3 :][:size] for t in texts]
        short = [t for t in short if len(t) == size]
        assert len(short) > 100
        for own, other in zip(short, short[1:]):
            prints = winnowing.winnow(own)[0], winnowing.winnow(winnowing.edited(own, other))[0]
            assert winnowing.likeness(*prints) > 0


def test_quality(spark, odd):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.score_documents(docs, labels)
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.9
    odd_scores = quality.score_documents(odd, labels)
    assert odd_scores.count() == odd.count()
    nothing = quality.score_documents(odd, labels.limit(0)).collect()
    assert {r.score for r in nothing} == {1.0}
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == scored.where("predicted = 1").count()
    assert quality.score_documents(odd.limit(0), labels).count() == 0
    values = quality.isotonic(np.array([1.0, 0.0, 2.0, 1.5]), np.ones(4))
    assert values.tolist() == [0.5, 0.5, 1.75, 1.75]


def test_quality_equals_plain_numpy(spark):
    """Features, normal equations, calibration and scores, worked out again in one piece."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    known = [(r.doc_id, float(r.quality)) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    known = [(i, y) for i, y in known if i in texts]
    x, y = np.array([quality.statistics(texts[i]) for i, _ in known]), np.array([y for _, y in known])
    fold = np.array([zlib.crc32(str(i).encode()) % 4 for i, _ in known])
    rng = np.random.default_rng(quality.SEED)
    projection = rng.normal(0, np.sqrt(2 * quality.GAMMA), (x.shape[1], quality.FEATURES))
    phase = rng.uniform(0, 2 * np.pi, quality.FEATURES)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)

    def features(x):
        z = np.clip((x - mean) / scale, -8, 8)
        return np.hstack([np.cos(z @ projection + phase) * np.sqrt(2 / quality.FEATURES), z, np.ones((len(z), 1))])

    def ridge(z, y):
        # The same least squares, with the penalty as further rows.
        more = np.sqrt(quality.RIDGE) * np.eye(z.shape[1])
        return np.linalg.lstsq(np.vstack([z, more]), np.concatenate([y, np.zeros(len(more))]), rcond=None)[0]

    z = features(x)
    raw = np.zeros(len(y))
    for k in set(fold):
        raw[fold == k] = z[fold == k] @ ridge(z[fold != k], y[fold != k])
    step = np.floor(np.clip(raw, -0.5, 1.5) * (quality.STEPS // 2)).astype(int)
    steps = np.unique(step)
    level = np.array([y[step == s].mean() for s in steps])
    weight = np.array([(step == s).sum() for s in steps])
    # The nearest rising sequence as the largest of the smallest means over stretches.
    stretch = lambda i, j: (level[i : j + 1] * weight[i : j + 1]).sum() / weight[i : j + 1].sum()
    rising = [max(min(stretch(i, j) for j in range(k, len(level))) for i in range(k + 1)) for k in range(len(level))]
    every = features(np.array([quality.statistics(t) for t in texts.values()])) @ ridge(z, y)
    flat = np.interp(every, [raw[step == s].mean() for s in steps], rising)
    want = dict(zip(texts, np.clip(0.999 * flat + 0.001 / (1 + np.exp(-every)), 0, 1)))
    for r in quality.score_documents(docs, labels).collect():
        assert abs(r.score - want[r.doc_id]) < 1e-5


def test_quality_of_odd_labels(spark):
    """Repeated label rows, one fold, null labels and ids."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    some = labels.where("doc_id % 50 <> 3").first().doc_id
    for rows in ([(0, 1)] * 250, [(0, 1)] * 250 + [(0, 0)] * 250, [(None, 1), (1, None), (some, 1)], [(10**9, 1)]):
        own = spark.createDataFrame([(i, q, 0) for i, q in rows], "doc_id long, quality int, toxic int")
        scores = quality.score_documents(docs, own).collect()
        assert len(scores) == docs.count() and all(0 <= r.score <= 1 for r in scores)
        kept = quality.keep_good(docs, own)
        assert kept.count() == sum(r.predicted for r in scores)

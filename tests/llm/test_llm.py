"""Operators on small hand-made tables against brute force, and their results for odd rows."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.compare import connect, difference
from tidemark.llm import (
    bpe,
    extraction,
    fingerprints,
    language,
    minhash,
    packing,
    quality,
    scoring,
    sharding,
    vectors,
)
from tidemark.llm.common import components
from tidemark.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, component_id string, shard string, n_shingles int"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi".split()


def odd_docs(spark):
    """Null ids and texts, blanks, repeats, ties, one long text, and columns that clash with results."""
    rng = random.Random(1)
    base = [rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(60)]
    near = base[:-2] + ["other", "end"]
    rows = [
        (1, " ".join(base), "en"),
        (2, " ".join(near), "en"),
        (3, " ".join(base).upper(), "en"),
        (3, " ".join(base).upper(), "en"),
        (4, None, None),
        (5, "", "en"),
        (6, " \n\t ", "de"),
        (7, "one two", "en"),
        (8, "One  TWO", None),
        (9, "12345 !!! ???", "en"),
        (None, "text without an id", "en"),
        (None, None, None),
        (10, " ".join(rng.choice(WORDS) for _ in range(30_000)), "en"),
        (-11, "ß Ü é 日本", "de"),
    ]
    return spark.createDataFrame([(*r, "x", "y", 7) for r in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_components(rows, linked):
    root = {i: i for i in rows}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(rows)
    for a in ids:
        for b in ids:
            if a < b and linked(a, b):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: top(i) for i in ids}


def shingles(text, width=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", low) if w]
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def linked_sets(sets):
    return lambda a, b: bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [
        (i, i + 1) for i in range(500, 560)
    ]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    pairs = {frozenset(e) for e in edges}
    want = brute_components({x for e in edges for x in e}, lambda a, b: frozenset((a, b)) in pairs)
    assert got == {k: v for k, v in want.items() if any(k in p and len(p) == 2 for p in pairs)}


def test_minhash_odd_rows(spark):
    rows = minhash.near_duplicates(odd_docs(spark)).collect()
    assert len(rows) == 14
    sets = {r["doc_id"]: shingles(r["text"]) for r in odd_docs(spark).collect() if r["doc_id"] is not None}
    want = brute_components(sets, linked_sets(sets))
    for r in rows:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["n_shingles"] == len(sets[r["doc_id"]])
            assert r["component_id"] == want[r["doc_id"]], r
            assert r["kept"] == (r["doc_id"] == r["component_id"])
    assert want[2] == want[3] == 1 and want[8] == 7
    assert minhash.near_duplicates(empty(spark)).count() == 0


def test_minhash_on_a_group_of_near_copies(spark):
    """Blocks of four split the group; links must be those of all pairs."""
    rng = random.Random(3)
    base = [rng.choice(WORDS) + str(rng.randrange(99)) for _ in range(80)]
    texts = {}
    for i in range(60):
        words = list(base)
        for _ in range(rng.randrange(9)):
            words[rng.randrange(80)] = f"w{rng.randrange(999)}"
        texts[i] = " ".join(words)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = minhash.near_duplicates(df, minhash.Settings(block=4)).collect()
    sets = {i: shingles(t) for i, t in texts.items()}
    want = brute_components(sets, linked_sets(sets))
    assert {r["doc_id"]: r["component_id"] for r in got} == want and len(set(want.values())) > 1


def test_minhash_estimate():
    rng = np.random.default_rng(0)
    from tidemark.llm.shingles import hash_keys, minima

    keys = hash_keys(1600, 5)
    a = rng.integers(0, 2**63, 1000).astype(np.uint64)
    b = np.concatenate([a[:600], rng.integers(0, 2**63, 400).astype(np.uint64)])
    packed = [minhash.packed_low_bits(minima(x, keys))[None] for x in (a, b)]
    estimate = minhash.estimated(minhash.equal_fields(*packed, 1600), 1600)[0, 0]
    assert abs(estimate - 600 / 1400) < 0.06


def test_quality_on_the_labels(spark):
    directory = "/root/testdata/sf0.1"
    rows = QUERIES["op2_quality"](spark, directory).toPandas()
    labels = spark.read.parquet(f"{directory}/labels.parquet").toPandas()
    held = rows.merge(labels, on="doc_id").query("held_out")
    assert (held.predicted == held.quality).mean() > 0.97
    assert rows.score.between(0, 1).all()


def test_quality_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (2, 1), (7, 0), (7, 1)], "doc_id long, quality int")
    for docs in (odd_docs(spark), empty(spark)):
        for marks in (labels, labels.limit(0)):
            rows = quality.quality(docs, marks).collect()
            assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["score"] == 1 for r in quality.quality(odd_docs(spark), labels.limit(0)).collect())


def test_prior_from_tails():
    assert quality.prior_from_tails(np.array([0, 0, 50, 50]), np.array([20, 0, 40, 40]), 0.8) == 0.8


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 32))
    good = [c + rng.normal(size=32) * s for c in centres for s in (0, 0, 0.1, 0.15, 0.2, 0.25)]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(good)]
    rows += [(100, None), (101, []), (102, [0.0] * 32), (103, [math.nan] * 32), (104, [1.0, None]), (None, [1.0])]
    rows += [(105, [1.0, 0.0]), (106, [2.0, 0.0]), rows[0]]
    df = spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<double>, n_links int")
    got = vectors.near_vectors(df, vectors.Settings(block=3)).collect()
    assert len(got) == len(rows)
    unit = np.array(good) / np.linalg.norm(good, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    want = brute_components(range(len(good)), lambda a, b: near[a, b])
    for r in got:
        if r["vec_id"] is not None and r["vec_id"] < 100:
            assert r["n_links"] == near[r["vec_id"]].sum() - 1
            assert r["component_id"] == want[r["vec_id"]]
    other = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got}
    assert all(other[i] == (0, i) for i in range(100, 105)) and other[None] == (0, None)
    assert other[105] == (1, 105) and other[106] == (1, 105)
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_recall_of_buckets():
    rng = np.random.default_rng(6)
    a = rng.normal(size=(800, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    n = rng.normal(size=a.shape)
    n -= (n * a).sum(1, keepdims=True) * a
    b = 0.95 * a + math.sqrt(1 - 0.95**2) * n / np.linalg.norm(n, axis=1, keepdims=True)
    for axes in (2, 3):
        s = vectors.Settings(axes=axes, tables=8 * 2 ** (axes - 2))
        x, y = (vectors.buckets(v, s).view(np.int64) for v in (a, b))
        met = ((x[:, :, :1] == y) | (y[:, :, :1] == x)).any(axis=(1, 2))
        assert met.mean() > 0.99


def test_best_bounds_are_optimal():
    from itertools import combinations

    rng = np.random.default_rng(7)
    lengths, counts = np.arange(1, 11) ** 2, rng.integers(1, 50, 10)
    for buckets in (1, 2, 3, 4, 20):
        def padding(bounds):
            return sum(c * (min(b for b in bounds if b >= x) - x) for x, c in zip(lengths, counts))

        best = min(
            padding((*some, 100))
            for k in range(min(buckets, 10))
            for some in combinations(lengths[:-1], k)
        )
        assert padding(packing.best_bounds(lengths, counts, buckets)) == best
    assert packing.best_bounds(np.array([]), np.array([]), 3) == []


def test_packing_against_sql(spark):
    assert difference(QUERIES["op4_packing"](spark, SF), connect(SF), SQL["op4_packing"]) is None


def test_packing_odd_rows(spark):
    rows = packing.packed(odd_docs(spark)).collect()
    assert sum(r["n_tokens"] for r in rows if r["doc_id"] == 10) == 30_000
    assert len([r for r in rows if r["doc_id"] == 10]) == 15
    assert [r["n_tokens"] for r in rows if r["doc_id"] == 4] == [0]
    places = {(r["bucket"], r["batch"], r["slot"]) for r in rows}
    assert len(places) == len(rows) == 13 + 15
    assert packing.packed(empty(spark)).count() == 0


def test_extraction():
    page = (
        "<html><head><title>T</title></head><body><nav><a href=x>Menu, all of it.</a></nav>"
        "<div class='ad'>Buy, buy, buy it now.</div><article><h1>A &amp; B</h1><!-- no --><p>First  text,\n"
        "with <b>bold</b> words. It goes on and on.<br><p>Second&nbsp;one.<div class=\"comments\">"
        "<p>I like it, a lot.</p></div></article><aside>Side, bar.</aside><script>var t='</p>';</script>"
        "<footer>&copy; All, rights.</footer></body></html>"
    )
    want = "A & B\nFirst text, with bold words. It goes on and on.\nSecond one."
    assert extraction.main_text(page) == want
    assert [extraction.main_text(x) for x in (None, "", "<nav>a</nav>", "<!--")] == [""] * 4
    soup = page.replace("article", "div")
    assert "First text" in extraction.main_text(soup) and "Menu" not in extraction.main_text(soup)


def test_extraction_of_all_pages(spark):
    rows = QUERIES["op5_extraction"](spark, SF).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in rows:
        inner = pages[r["page_id"]].split("<article>")[1].split("</article>")[0]
        plain = __import__("re").sub("<[^>]*>", " ", inner)
        assert r["text"].split() == __import__("html").unescape(plain).split()
        assert r["n_chars"] == len(r["text"])
    odd = spark.createDataFrame(
        [(None, None, None, "t"), (1, "u", "", "t")], "page_id long, url string, html string, text string"
    )
    assert [r["text"] for r in extraction.extracted(odd).collect()] == ["", ""]


LINE = "The council met on Monday, and the vote was close. It was, by all accounts, a long night."


@pytest.mark.parametrize(
    "page, want",
    [
        ("<form><nav><a href=x>Home, sweet home</a></nav><div><h1>Vote</h1>{3}</div><footer>All, rights.</footer></form>", "Vote{3}"),
        ("<div class='post-header'><h1>Vote</h1></div><div class=body>{3}</div><footer>All, rights.</footer>", "Vote{3}"),
        ("<article><h1>Vote</h1>{3}<ul><li>x<li>y</ul><article class=comment><p>I like it, a lot.</p></article></article>", "Vote{3}xy"),
        ("<main><h1>Vote</h1>{3}<div id=discussion><p>I like it, a lot. Truly, I do.</p></div></main>", "Vote{3}"),
        ("<div><div><a href=a>One</a></div><div><a href=b>Two</a></div></div><div><h2>Vote</h2>{3}</div><div>All rights.</div>", "Vote{3}"),
        ("<div><h1>Vote</h1><form><p>Your name, please.</p></form>{3}<aside><p>Side, bar, and more.</p></aside></div>", "Vote{3}"),
        ("<p title='a > b' class=x's>{1}<a href='never closed>text", "{1}"),
        ("<div><table><tr><td>a, b<td>c<tr><td>d</table></div>", "a, bcd"),
        ("<nav><p>Some longer text, with marks, in a menu.</p></nav>", ""),
        ("one", "one"),
    ],
)
def test_extraction_without_telling_tags(page, want):
    paragraphs = {f"{{{n}}}": f"<p>{LINE}</p>" * n for n in (1, 3)}
    for key, value in paragraphs.items():
        page, want = page.replace(key, value), want.replace(key, LINE * int(key[1]))
    assert extraction.main_text(page).replace("\n", "") == want


def test_path_ratios_decide(spark, monkeypatch):
    """Pages as they are and without any telling tag or name; with the ratios off every page changes."""
    pages = [r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    telling = __import__("re").compile(r"(?<=[</])(?:article|nav|footer|aside)\b")
    plain = [telling.sub("div", p).replace(' class="ad"', "") for p in pages]
    want = [extraction.main_text(p) for p in pages]
    same = sum(extraction.main_text(p) == w for p, w in zip(plain, want))
    assert same >= 0.9 * len(pages)
    rng = np.random.default_rng(4)
    for chosen in (lambda n: np.ones(n, bool), lambda n: rng.random(n) < 0.5):
        monkeypatch.setattr(extraction, "content_blocks", lambda page, lines, settings: chosen(len(lines)))
        assert all(extraction.main_text(p) != w for p, w in zip(pages, want))


@pytest.mark.parametrize(
    "page",
    ["<a " * 340_000, "<div>" * 200_000, "<span>" * 50_000 + "<p></p>x" * 50_000, "<!" * 500_000, "<script " * 120_000]
    + ["<b>" * 100_000 + "</i>" * 200_000, "<p a" + "= " * 400_000, "<div>" * 90_000 + "x.</div>" * 90_000],
)
def test_broken_pages_in_linear_time(page):
    began = __import__("time").time()
    extraction.main_text(page)
    assert __import__("time").time() - began < 10


def test_extraction_odd_rows(spark):
    long = f"<div>{f'<p>{LINE}</p>' * 20_000}</div>"
    rows = [(1, "u", long, "t", 5), (1, "u", long, "t", 5), (2, None, "<p>one", None, None), (None, "v", None, "t", 1)]
    schema = "page_id long, url string, html string, text string, n_chars int"
    got = [tuple(r) for r in extraction.extracted(spark.createDataFrame(rows, schema)).collect()]
    text = "\n".join([LINE] * 20_000)
    assert got == [(1, "u", text, len(text))] * 2 + [(2, None, "one", 3), (None, "v", "", 0)]
    assert extraction.extracted(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize("name", ["odd", "sf", "hot", "empty"])
def test_sharding(spark, name):
    docs = {
        "odd": odd_docs,
        "sf": lambda s: s.read.parquet(f"{SF}/documents.parquet"),
        "hot": lambda s: s.range(900).select(
            F.col("id").alias("doc_id"),
            F.when(F.col("id") % 3 == 0, "same").otherwise((F.col("id") % 500).cast("string")).alias("text"),
        ),
        "empty": empty,
    }[name](spark)
    rows = sharding.sharded(docs).toPandas()
    assert len(rows) == docs.count()
    if name == "empty":
        return
    sizes = rows.groupby("shard").size().reindex(range(40), fill_value=0)
    assert sizes.max() - sizes.min() <= 1
    for _, slots in rows.groupby("shard").slot:
        assert sorted(slots) == list(range(len(slots)))
    if name in ("sf", "hot"):
        groups = rows.groupby(["size", "text_crc32"]).shard.agg(["size", "nunique"])
        small = groups[groups["size"].between(2, max(1, int(sizes.min()) // 2))]
        assert (small["nunique"] == 1).mean() > 0.9
    texts = [r["text"] or "" for r in docs.collect()]
    assert sorted(rows["size"]) == sorted(len(t.encode()) + 16 for t in texts)
    assert sorted(rows["text_crc32"]) == sorted(__import__("zlib").crc32(t.encode()) for t in texts)


def grouped(spark, sizes):
    rows = [(i, f"text {g}") for i, g in enumerate(g for g, n in enumerate(sizes) for _ in range(n))]
    return spark.createDataFrame(rows, "doc_id long, text string")


def cut_groups(spark, sizes, settings=sharding.Settings()):
    """How many shards each group lies in; shards hold equally many rows."""
    rows = sharding.sharded(grouped(spark, sizes), settings).join(grouped(spark, sizes), "doc_id").toPandas()
    held = rows.groupby("shard").size().reindex(range(settings.shards), fill_value=0)
    assert len(rows) == sum(sizes) and held.max() - held.min() <= 1
    return rows.groupby("text").shard.nunique()


@pytest.mark.parametrize(
    "sizes, whole",
    [([50] * 80, 80), ([40] * 100, 80), ([100] * 10 + [70] * 10 + [30] * 10 + [5] * 400, 430)],
)
def test_full_shards_exchange_rows(spark, sizes, whole):
    """Shards of 100 rows with nothing unlinked; two groups of 40 fit in one, so 80 of 100 is the most."""
    assert (cut_groups(spark, sizes) == 1).sum() == whole


def test_only_what_exceeds_a_shard_is_cut(spark):
    found = cut_groups(spark, [60] * 20 + [1300] + [2] * 250 + [1] * 1000)
    assert (found == 1).sum() == len(found) - 1 and found["text 20"] == 13


def test_sharding_against_the_best_assignment(spark):
    """Groups that stay whole, against trying every way to give whole groups to shards."""

    def best(sizes, room):
        if not sizes:
            return 0
        most = best(sizes[1:], room)
        for s in set(room):
            if sizes[0] <= s:
                rest = list(room)
                rest[rest.index(s)] -= sizes[0]
                most = max(most, 1 + best(sizes[1:], rest))
        return most

    for sizes in ([4, 3, 3, 2], [4, 4, 4], [3, 3, 2, 2, 2], [2] * 6, [5, 2, 2, 3], [3, 2, 2, 2, 2, 1]):
        found = cut_groups(spark, sizes, sharding.Settings(shards=3))
        assert (found == 1).sum() == best(sizes, [4, 4, 4]), sizes


def test_bpe_against_the_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(8)
    texts = ["", "  ", "It's 123 <|endoftext|> x<|startoftext|>Y", "ΑΣ Σ ΟΔΟΣ é ﬁ", "a\x1cb\x85c", "aa" * 400]
    texts += ["".join(rng.choice("aabcdethinrs'  \nABé!?.9日😀<|>") for _ in range(80)) for _ in range(300)]
    texts += [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    words = bpe.Vocabulary(path)
    for text, (ids, decoded, count) in zip(texts, words.encode(texts)):
        own = library.encode(text, add_special_tokens=False).ids
        assert ids == " ".join(map(str, own)) and count == len(own), text
        assert decoded == library.decode(own, skip_special_tokens=False) == words.decode(own)
    rows = bpe.digests(odd_docs(spark), path).collect()
    nothing = hashlib.sha256(b"").hexdigest()
    assert [(r[1], r[2], r[3]) for r in rows if r["doc_id"] in (4, 5)] == [(0, nothing, nothing)] * 2
    assert len(rows) == 14 and bpe.digests(empty(spark), path).count() == 0
    assert [len(r["ids"]) for r in bpe.encoded(odd_docs(spark), path).collect()] == [r[1] for r in rows]


def test_scoring(spark):
    settings = scoring.Settings(classes=4, places=8, shared=4, width=6, rounds=2, batch=64)
    docs = spark.createDataFrame(
        [(i, "the cat sat on the mat and the dog ran " * 20) for i in range(20)] + [(99, None), (None, "a b")],
        "doc_id long, text string",
    )
    network, tokens = scoring.train(docs, settings)
    rows = {r["doc_id"]: r for r in scoring.apply(network, tokens).collect()}
    assert rows[99]["n_tokens"] == 0 and rows[99]["log_prob"] == 0 and rows[99]["perplexity"] is None
    # one document position by position
    ids = np.frombuffer(tokens.where("doc_id = 0").first()["tokens"], np.uint16)
    padded = [32, 32, *ids.tolist(), 32, 32]
    p, total = network.parts, 0.0
    for i in range(2, len(padded) - 2):
        around = [padded[i - 2], padded[i - 1], padded[i + 1], padded[i + 2]]
        hidden = np.tanh(sum(p["sides"][k][w] for k, w in enumerate(around)) + p["hidden_bias"])
        c, w = divmod(padded[i], 8)
        for out, at in (
            (hidden @ p["classes"] + p["class_bias"], c),
            (hidden @ p["places"][c] + p["place_bias"][c], w),
        ):
            total += math.log(np.exp(out[at]) / np.exp(out).sum())
    assert math.isclose(rows[0]["log_prob"], total, rel_tol=1e-3)
    # words in their usual order are likelier than by frequency alone
    counts = np.bincount(ids, minlength=32) / len(ids)
    assert rows[0]["mean_log_prob"] > float(np.log(counts[ids]).mean())
    assert scoring.scored(empty(spark)).count() == 0


def test_fingerprints_against_one_pass(spark):
    docs = odd_docs(spark)
    rows = fingerprints.compared(docs, fingerprints.Settings(rows=2)).toPandas()
    order = sorted(
        ((r["doc_id"], r["text"] or "") for r in docs.collect()),
        key=lambda x: (x[0] is None, -(x[0] or 0), x[1]),
    )
    s = fingerprints.Settings()
    want = []
    for (i, text), (_, following) in zip(order, order[1:] + order[:1]):
        own, other, changed = fingerprints.signatures(
            [text, following, fingerprints.edited(text, following)], s
        )
        edit = fingerprints.edited(text, following)
        want.append(
            (
                -1 if i is None else i,
                len(text),
                hashlib.sha256(edit.encode()).hexdigest(),
                fingerprints.written(own),
                fingerprints.written(changed),
                fingerprints.likeness(own, changed, s.kept),
                fingerprints.likeness(own, other, s.kept),
            )
        )
    got = [(-1 if pd.isna(r[0]) else int(r[0]), *r[1:]) for r in rows.itertuples(index=False)]
    assert sorted(got) == sorted(want)
    assert fingerprints.compared(empty(spark)).count() == 0


def test_likeness_knows_no_border_of_length():
    """A text and its beginnings: likeness falls evenly with what is cut off, on both sides of the 400
    characters at which levels once changed. (Texts of a line have too few phrases to fall evenly.)"""
    rng = random.Random(21)
    settings = fingerprints.Settings()
    texts = [" ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(200)) for _ in range(40)]
    for length in (210, 410, 800, 1200):
        whole = fingerprints.signatures([t[:length] for t in texts], settings)
        near = []
        for cut in (0.01, 0.02, 0.03, 0.05, 0.1):
            parts = fingerprints.signatures([t[: length - int(cut * length)] for t in texts], settings)
            near.append(np.mean([fingerprints.likeness(a, b, settings.kept) for a, b in zip(whole, parts)]))
        assert near[2] > 0.6 and max(a - b for a, b in zip(near, near[1:])) < 0.15, (length, near)


def test_equal_substrings_share_phrases():
    s = fingerprints.Settings()
    rng = random.Random(9)
    common = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    a, b = ("".join(rng.choice("ijkl ") for _ in range(n)) + common for n in (101, 50))
    (pa, _), (pb, _) = (fingerprints.phrases([t], s)[3] for t in (a, b))
    assert len(np.intersect1d(pa, pb)) > 0.9 * len(np.unique(pa)) * len(common) / len(a)


def test_letters():
    assert all(map(language.has_letter, ("a", "1 ß", "東", "ª")))
    assert not any(map(language.has_letter, (None, "", "12 - _", "½ ² Ⅷ ①", "\u0301")))


def test_language(spark):
    rows = QUERIES["op10_language"](spark, "/root/testdata/sf0.01").toPandas()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").toPandas()
    held = rows.merge(docs, on="doc_id").query("held_out")
    assert (held.lang == held.lang_pred).mean() > 0.98
    odd = language.languages(odd_docs(spark)).collect()
    assert len(odd) == 14
    by_id = {r["doc_id"]: r for r in odd}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (4, 5, 6, 9))
    assert by_id[1]["lang_pred"] in ("en", "de")
    assert language.languages(empty(spark)).count() == 0
    unlabelled = odd_docs(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.languages(unlabelled).collect()} == {"und"}


def test_pipeline(spark, tmp_path):
    """Stage by stage against the operators' decisions, and the whole against the stages."""
    import corpus_pipeline as P

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    current = docs
    for name, stage in P.STAGES[:-1]:
        kept = stage(spark, current, "/root/testdata/sf0.01")
        assert kept.columns == docs.columns and 0 < kept.count() <= current.count(), name
        current = kept
    texts = {r["doc_id"]: shingles(r["text"], 5) for r in current.collect()}
    linked, by_shingle = linked_sets(texts), {}
    for i, found in texts.items():
        for x in found:
            by_shingle.setdefault(x, []).append(i)
    shared = {(a, b) for ids in by_shingle.values() for a in ids for b in ids if a < b}
    assert not [pair for pair in shared if linked(*pair)]
    rows = P.run(spark, "/root/testdata/sf0.01").collect()
    assert {r["doc_id"] for r in rows} == set(texts)


def test_pipeline_stages_on_odd_rows(spark):
    """Row by row: rows that share an id or have none fare as their own texts do."""
    import corpus_pipeline as P

    docs = odd_docs(spark)
    assert P.language_stage(spark, docs, SF).where("doc_id in (4, 5, 6, 9)").count() == 0
    left = P.dedup_stage(spark, docs, SF)
    assert left.where("doc_id in (1, 2, 3)").count() == 1 and left.columns == docs.columns
    assert left.where("doc_id is null").count() == 2 and left.where("doc_id in (7, 8)").count() == 1
    shared = spark.createDataFrame(
        [(1, "some words that only this row has"), (1, "other words which no other row ever had"), (1, "5 . ; !")],
        "doc_id long, text string",
    )
    assert P.dedup_stage(spark, shared, SF).count() == 3
    learned = docs.select("doc_id", "text", "lang").unionByName(shared.withColumn("lang", F.lit("en")))
    assert P.language_stage(spark, learned, SF).where("doc_id = 1 and lang = 'en'").count() == 3
    for stage in (P.quality_stage, P.language_stage, P.dedup_stage, P.packing_stage):
        assert stage(spark, empty(spark), SF).count() == 0
    kept = P.quality_stage(spark, docs, SF)
    assert kept.columns == docs.columns and kept.count() <= docs.count()


BIG = 2**53 + 1


def test_long_ids_beside_null_ones(spark):
    """Ids that doubles can't hold come back as they are."""
    import public_tokenizers

    texts = [(BIG, "ein Text mit Worten"), (None, "some other text"), (BIG + 2, "ein Text mit Worten"), (7, None)]
    docs = spark.createDataFrame([(*r, "de") for r in texts], "doc_id long, text string, lang string").coalesce(1)
    labels = spark.createDataFrame([(7, 1)], "doc_id long, quality int")
    want = sorted((r[0] for r in texts), key=str)
    settings = scoring.Settings(classes=4, places=8, shared=4, width=6, rounds=1, batch=64)
    for rows in (
        minhash.near_duplicates(docs),
        quality.quality(docs, labels),
        language.languages(docs),
        fingerprints.compared(docs),
        fingerprints.fingerprints(docs),
        scoring.scored(docs, settings),
        bpe.digests(docs, public_tokenizers.path("word_bpe_49k.json")),
        bpe.encoded(docs, public_tokenizers.path("word_bpe_49k.json")),
    ):
        assert sorted((r["doc_id"] for r in rows.collect()), key=str) == want
    linked = {r["doc_id"]: r for r in minhash.near_duplicates(docs).collect()}
    assert linked[BIG + 2]["component_id"] == BIG and not linked[BIG + 2]["kept"]
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html"))
    assert sorted((r["page_id"] for r in extraction.extracted(pages).collect()), key=str) == want
    near = [[1.0, 0.1, 0.0, 2.0], [1.0, 0.1, 0.01, 2.0]]
    rows = [(BIG, near[0]), (None, near[0]), (0, near[1]), (5, None)]
    vecs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    got = {r["vec_id"]: tuple(r)[1:] for r in vectors.near_vectors(vecs).collect()}
    assert got == {BIG: (1, 0, False), 0: (1, 0, True), None: (0, None, True), 5: (0, 5, True)}


def test_texts_that_share_an_id_are_linked(spark):
    rng = random.Random(12)
    a, b, c = ([f"{x}{rng.randrange(999)}" for _ in range(60)] for x in "abc")
    rows = [(1, a), (1, b), (2, a[:-1] + ["z"]), (3, b[:-1] + ["z"]), (4, c), (9, c), (9, a), (1, a), (5, [])]
    rows = [(i, " ".join(t)) for i, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect()}
    assert got == {(1, 1, True), (2, 1, False), (3, 1, False), (4, 1, False), (9, 1, False), (5, 5, True)}
    assert minhash.near_duplicates(docs).count() == len(rows)


def test_vectors_that_share_an_id_are_linked(spark):
    rng = np.random.default_rng(13)
    a, b = rng.normal(size=(2, 16))
    rows = [(1, a), (1, b), (2, a + 0.01), (3, b + 0.01), (3, b + 0.01), (4, a), (1, a), (6, -a)]
    rows = [(i, list(map(float, v))) for i, v in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, vectors.near_vectors(df).collect()))
    want = [(1, 1, 1, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False)]
    assert got == [*want, (3, 1, 1, False), (3, 1, 1, False), (4, 2, 1, False), (6, 0, 6, True)]


def test_related_languages_by_votes(spark):
    """Three languages of one family against a plain vote over machines fitted pair by pair."""
    rng = np.random.default_rng(14)
    words = {lang: [f"{lang}{i}"[::-1] + "en" for i in range(30)] for lang in ("da", "nb", "sv")}
    common = [f"ord{i}" for i in range(30)]
    rows = [
        (i, " ".join(rng.choice(common + words[lang], 12)), lang)
        for i, lang in enumerate(np.repeat(["da", "nb", "sv"], 60))
    ]
    docs = spark.createDataFrame([(i, str(t), str(x)) for i, t, x in rows], "doc_id long, text string, lang string")
    settings = language.Settings(steps=60)
    model = language.train(docs, settings)
    machines = model.members["germanic"]
    assert set(model.members) == {"germanic"} and len(machines.pairs) == 3
    texts = [" ".join(rng.choice(common + words["nb"] + words["sv"], 8)) for _ in range(80)]
    x = np.stack([language.profile(t, settings) for t in texts])
    want = []
    for row in x:
        votes, sums = dict.fromkeys(machines.names, 0), dict.fromkeys(machines.names, 0.0)
        for k, (a, b) in enumerate(machines.pairs):
            margin = float(row @ machines.weights[:, k] + machines.bias[k])
            votes[machines.names[a if margin >= 0 else b]] += 1
            sums[machines.names[a]] += margin
            sums[machines.names[b]] -= margin
        want.append(max(machines.names, key=lambda n: (votes[n], sums[n])))
    assert model.predict(texts)[0] == want
    # each machine is what its two languages alone give
    fold = [(t, lang) for i, t, lang in rows if __import__("zlib").crc32(str(i).encode()) % 4 != 2]
    sample = np.stack([language.profile(t, settings).astype(np.float16) for t, _ in fold]).astype(np.float32)
    langs = np.array([lang for _, lang in fold])
    for k, (a, b) in enumerate(machines.pairs):
        own = np.isin(langs, [machines.names[a], machines.names[b]])
        alone = language.fit_machines(sample[own], langs[own], settings)
        assert np.allclose(alone.weights[:, 0], machines.weights[:, k], atol=1e-3)


def scoring_case(spark):
    rng = np.random.default_rng(4)
    names = [f"w{i}{'xyz'[i % 3]}" for i in range(60)]
    texts = [" ".join(rng.choice(names, rng.integers(1, 90)) if i % 7 else names[:9]) for i in range(120)]
    docs = spark.createDataFrame([*enumerate(texts), (500, "ünsäglich 中文 \x00 " * 3)], "doc_id long, text string")
    return docs, scoring.Settings(
        classes=4, places=8, shared=4, width=6, rounds=2, batch=64, share=500, positions=300, partitions=3, block=64
    )


def test_scores_do_not_depend_on_the_layout(spark):
    docs, settings = scoring_case(spark)
    found = [
        sorted(map(tuple, scoring.scored(rows, settings).collect()))
        for rows in (docs.coalesce(1), docs.orderBy(F.rand(3)).repartition(16))
    ]
    assert found[0] == found[1] and len(found[0]) == 121


def test_every_position_is_trained_on_once(spark):
    docs, settings = scoring_case(spark)
    network, tokens = scoring.train(docs, settings)
    seen = [
        scoring._improved(tokens, network.flat, turn, 5, settings).where("block = 0").select("learner", "weight").collect()
        for turn in range(settings.rounds)
    ]
    total = tokens.agg(F.sum(F.length("tokens")) / 2).first()[0]
    assert sum(r["weight"] for rows in seen for r in rows) == total
    assert all(len({r["learner"] for r in rows}) == len(rows) > 1 for rows in seen)


def test_gradient_against_finite_differences():
    """One step divides the gradient by the root of its square, so its sign and its square are known."""
    settings = scoring.Settings(classes=3, places=4, shared=2, width=5, sides=2, rate=1e-2)
    rng = np.random.default_rng(1)
    windows, targets = rng.integers(0, 13, (40, 4)), rng.integers(0, 12, 40)
    weights = rng.normal(0, 0.5, scoring.Network.size(settings)).astype(np.float32)
    network = scoring.Network(settings, weights)
    squares = scoring.Network(settings, np.zeros(len(weights)))
    network.learn(windows, targets, squares)
    found = np.sqrt(squares.flat) * np.sign(weights - network.flat)
    for at in rng.choice(len(weights), 150, replace=False):
        risk = []
        for change in (1e-2, -1e-2):
            moved = scoring.Network(settings, weights)
            moved.flat[at] += change
            risk.append(-moved.log_probabilities(windows, targets).mean())
        assert abs(found[at] - (risk[0] - risk[1]) / 2e-2) < 2e-4


def test_words_are_spelled(spark):
    settings = scoring.Settings(classes=2, places=4, shared=3)
    counts = Counter({b"the": 9, b"thin": 4, b"then": 2, b"a": 3, b"\xc3\xa4tna": 1, b"zoo": 5})
    own = {b"the": 0, b"a": 1}
    rows = spark.createDataFrame([(bytearray(w), n) for w, n in counts.items()], "word binary, count long")
    spelling = scoring.spelling_of(rows, own, settings)
    long, short = Counter(), Counter()
    for word, n in counts.items():
        codes = b"  " + word + b" "
        for i in range(2, len(codes) if word not in own else 0):
            before = 32 if i == 2 else codes[i - 2]
            long[before % 32, codes[i - 1], codes[i]] += n
            short[codes[i - 1], codes[i]] += n

    def step(c2, c1, b):
        a = settings.smoothing
        equal = a / 251 * (b not in range(9, 14))
        mine = (short[c1, b] + equal) / (sum(short[c1, x] for x in range(256)) + a)
        return (long[c2 % 32, c1, b] + a * mine) / (sum(long[c2 % 32, c1, x] for x in range(256)) + a)

    def raw(word):
        first = {
            b: short[32, b] + settings.smoothing / 251
            for b in range(256)
            if b % 3 == word[0] % 3 and b != 32 and b not in range(9, 14)
        }
        codes = b" " + word + b" "
        rest = math.prod(step(codes[i - 2], codes[i - 1], codes[i]) for i in range(2, len(codes)))
        return first[word[0]] / sum(first.values()) * rest

    for word in (b"thin", b"then", b"\xc3\xa4tna", b"zoo", b"unseen", b"\x00"):
        taken = sum(raw(w) for w in own if w[0] % 3 == word[0] % 3)
        want = math.log(raw(word) / (1 - taken))
        assert math.isclose(spelling.logs_of([b"zoo", word])[1], want, rel_tol=1e-4), word
    # each next byte's chances sum to 1, so those of all words do
    assert np.allclose(np.exp(spelling.steps.reshape(-1, 256)).sum(1), 1, atol=1e-4)
    assert np.allclose(np.bincount(np.arange(256) % 3, np.exp(spelling.first)), 1)


def test_quality_risk_against_row_by_row():
    """A few steps on a small sample, with the risk and its slope summed row by row, both with a risk above
    zero and with one below, where the step goes back."""
    rng = np.random.default_rng(2)
    positive, unlabelled = np.abs(rng.normal(0.5, 1, (9, 3))), np.abs(rng.normal(0, 1, (14, 3)))
    for prior, steps in ((0.3, 5), (0.9, 200)):
        settings = quality.Settings(steps=steps)
        contrast = quality.fit_contrast(positive, unlabelled, settings)
        p, u = contrast.inputs(positive).tolist(), contrast.inputs(unlabelled).tolist()
        kinds = set()

        def slope(w):
            def sigmoid(x):
                return 1 / (1 + math.exp(-sum(a * b for a, b in zip(x, w))))

            good, bad, risk = [0.0] * len(w), [0.0] * len(w), 0.0
            for x in p:
                risk += prior * math.log(1 - sigmoid(x)) / len(p)
                for i, a in enumerate(x):
                    good[i] += prior * (sigmoid(x) - 1) * a / len(p)
                    bad[i] -= prior * sigmoid(x) * a / len(p)
            for x in u:
                risk -= math.log(1 - sigmoid(x)) / len(u)
                for i, a in enumerate(x):
                    bad[i] += sigmoid(x) * a / len(u)
            kinds.add(risk >= 0)
            return np.array([g + b if risk >= 0 else -b for g, b in zip(good, bad)])

        want = quality._descend(slope, len(p[0]), len(p), settings)
        got = quality.fit_non_negative(contrast, positive, unlabelled, prior, settings)
        assert np.allclose(got.weights, want, atol=1e-6) and True in kinds
    assert kinds == {True, False}


def test_places_in_buckets_are_not_broadcast(spark, monkeypatch):
    """An explode makes 32 rows of each text, which Spark's estimate leaves out."""
    plans = []

    def noted(df):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return kept(df)

    kept = minhash.keep
    monkeypatch.setattr(minhash, "keep", noted)
    rng = random.Random(4)
    texts = [" ".join(rng.choice(WORDS) for _ in range(30)) for _ in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 2)], "doc_id long, text string")
    assert minhash.near_duplicates(docs).where("not kept").count() == 40
    (plan,) = [p for p in plans if "explode(bands" in p]
    on_bucket = [line for line in plan.split("\n") if "Join [bucket" in line]
    assert on_bucket and all("SortMergeJoin" in line for line in on_bucket)

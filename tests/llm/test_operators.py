"""Search, formatting, extraction, packing, coding, files, quality and the pipeline."""

import functools
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexiloom.llm import bpe, chat, packing, pages, quality, slices, tokenfiles, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", " ", "a", "Hello  world,\n\n it's 12345 ümläut 日本語 🙂", "<|endoftext|>x <|endoftext|>", "a" * 5000, " ".join(f"word{i}" for i in range(3000)), "tab\t\tnbsp   end ", "Hello  world,\n\n it's 12345 ümläut 日本語 🙂"]
DOCS = "doc_id long, text string, ids string, offset string"


@functools.cache
def loaded():
    return Tokenizer.from_file(PATH)


@functools.cache
def library_coder():
    return tokens.library_coder(PATH)


@pytest.fixture(scope="module")
def library():
    return loaded()


def docs(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], DOCS).repartition(3)


def ids_of(library, text, end=()):
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, *end], "<u4")


@given(st.text(alphabet=st.sampled_from(list(" \t\n ab'sre.,1é日🙂\x1c\x85　")) | st.characters(codec="utf-8"), max_size=40))
@settings(max_examples=400, deadline=None)
def test_coders_agree_with_the_library(text):
    library = loaded()
    want = library.encode(text, add_special_tokens=False).ids
    automaton, coder, _ = bpe.machine(PATH)
    assert np.frombuffer(coder.packed(text), "<u4").tolist() == want
    assert automaton.decode(want) == library.decode(want, skip_special_tokens=False)
    assert np.frombuffer(library_coder().packed(text), "<u4").tolist() == want


def test_automaton_with_a_small_table(library):
    """The table is emptied inside words too, and results stay the same."""
    small, rng = bpe.Automaton(PATH, most=40), random.Random(3)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rng.randrange(1, 60))) for _ in range(150)] + ["a" * 3000, "ab" * 500]
    for w in words:
        assert small.word(w.encode()) == library.encode(w, add_special_tokens=False).ids
        assert len(small.table) <= 40


def test_cache_turns():
    c = tokens.Cache(lambda k: k.encode(), 3)
    for k in "abcdefgab":
        assert c[k] == k.encode()
        c.turn()
    assert len(c) <= 4


def test_encode_decode(spark, library):
    got = {r["doc_id"]: r for r in bpe.encode_decode(docs(spark), PATH).collect()}
    for i, t in enumerate(TEXTS):
        assert list(got[i]["ids"]) == ids_of(library, t).tolist() and got[i]["decoded"] == (t or "") and got[i]["n_tokens"] == len(got[i]["ids"])
    assert bpe.encode_decode(docs(spark, []), PATH).count() == 0


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 3), max_size=700))
@settings(max_examples=100, deadline=None)
def test_blocks_round_trip(ids):
    x = np.array(ids, "<u4")
    assert (tokenfiles.decode_block(tokenfiles.encode_block(x)) == x).all()


def test_token_files(spark, library):
    files = tokenfiles.write_token_files(docs(spark), PATH, end=0)
    got, at = sorted(tokenfiles.token_digests(files).collect()), 0
    assert len(got) == len(TEXTS)
    for r, t in zip(got, TEXTS, strict=True):
        x = ids_of(library, t, [0])
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(x), zlib.crc32(x.tobytes()))
        at += len(x)
    assert tokenfiles.token_digests(tokenfiles.write_token_files(docs(spark, []), PATH)).count() == 0


def test_coding_of_repeated_and_null_ids(spark, library):
    """600 equal rows without an id, 300 rows of one id: dealt over files, in order, none lost."""
    texts = [None, "", "same text of many rows", "another"]
    rows = [(None, texts[2])] * 600 + [(5, texts[i % 4]) for i in range(300)] + [(i, texts[3]) for i in range(10, 40)]
    table = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], DOCS).repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    files = tokenfiles.write_token_files(table, PATH, end=0)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(r["n_docs"] for r in files.collect()) < 500
    got, at = tokenfiles.token_digests(files).orderBy("start").collect(), 0
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows) and [r["doc_id"] or -1 for r in got] == sorted(r["doc_id"] or -1 for r in got)
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    crc = {t: zlib.crc32(ids_of(library, t, [0]).tobytes()) for t in texts}
    assert Counter((r["doc_id"], r["ids_crc32"]) for r in got) == Counter((i, crc[t]) for i, t in rows)
    coded = bpe.encode_decode(table, PATH).collect()
    assert Counter((r["doc_id"], r["decoded"], tuple(r["ids"])) for r in coded) == Counter((i, t or "", tuple(ids_of(library, t).tolist())) for i, t in rows)


def test_stores_of_token_files(tmp_path):
    assert tokenfiles._open(f"file://{tmp_path}/x")[1] == f"{tmp_path}/x"
    with pytest.raises(ValueError, match="odd"):
        tokenfiles._open("odd://x/y")


def test_files_span_blocks(tmp_path):
    w, rng = tokenfiles.Writer(f"file://{tmp_path}/x.tokens"), np.random.default_rng(1)
    want = [(i if i else None, rng.integers(0, 50_000, n).astype("<u4")) for i, n in enumerate((3, 0, 400_000, 5, 200_000))]
    for i, x in want:
        w.add(i, x.tobytes())
    assert w.close() == (5, 600_008)
    got = [(i, np.concatenate([np.zeros(0, "<u4"), *runs])) for i, runs in tokenfiles.read_documents(w.path)]
    assert all(a == i and (b == x).all() for (a, b), (i, x) in zip(got, want, strict=True))


def check_packing(rows, library, texts, capacity):
    of, sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        of[r["doc_id"]].append(r)
        sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        x = ids_of(library, texts[r["doc_id"]], [0])[r["start"] : r["start"] + r["length"]]
        assert len(x) == r["length"] and zlib.crc32(x.tobytes()) == r["ids_crc32"]
    for i, t in enumerate(texts):
        n, p = len(ids_of(library, t, [0])), sorted(of[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in p] == list(range(-(-n // capacity))) and sum(r["length"] for r in p) == n and all(r["length"] == capacity for r in p[1:])
    for places in sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequence)


def test_packing(spark, library):
    rng = random.Random(2)
    texts = TEXTS + [" ".join("word" for _ in range(rng.randrange(1, 900))) for _ in range(300)]
    n = check_packing(packing.pack_documents(docs(spark, texts), PATH).collect(), library, texts, 2048)
    total = sum(len(ids_of(library, t, [0])) for t in texts)
    assert n <= -(-total // 2048) + 2
    assert packing.pack_documents(docs(spark, []), PATH).count() == 0


def test_packing_deals_equal_pieces_over_shards(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 50)
    pieces = spark.createDataFrame([(None, 1)] * 400, "doc_id long, length long").repartition(3)
    got = packing.pack(pieces, 4).collect()
    of = Counter(r["sequence_id"] >> 20 for r in got)
    assert len(got) == 400 and len(of) == 8 and max(of.values()) < 100
    assert {r["offset"] for r in got} == {0, 1, 2, 3} and max(Counter((r["sequence_id"], r["offset"]) for r in got).values()) == 1


def least_bins(sizes, capacity):
    """The fewest bins, by trying every assignment."""

    def fits(k, rooms):
        if k == len(sizes):
            return True
        return any(fits(k + 1, rooms[:i] + [r - sizes[k]] + rooms[i + 1 :]) for i, r in enumerate(rooms) if r >= sizes[k] and r not in rooms[:i])

    return next(m for m in range(len(sizes) + 1) if fits(0, [capacity] * m))


def test_genetic_steps_keep_all_pieces():
    rng = random.Random(4)
    sizes = sorted((rng.randrange(1, 100) for _ in range(300)), reverse=True)
    population = packing.evolve(sizes, [], 100, rng, 0)
    steps = [*population, packing.crossover(population[0], population[-1], rng), packing.mutated(population[0], rng)]
    for p in steps:
        assert sorted(i for b in p.bins for i in b) == list(range(300)) and all(sum(sizes[i] for i in b) + r == 100 and r >= 0 for b, r in zip(p.bins, p.room, strict=True))


def test_genetic_algorithm_against_every_assignment():
    rng = random.Random(9)
    for _ in range(40):
        sizes = sorted((rng.randrange(10, 70) for _ in range(rng.randrange(1, 10))), reverse=True)
        best, bound = least_bins(sizes, 100), packing.lower_bound(sizes, 100)
        assert bound <= best == len(packing.evolve(sizes, [], 100, rng, bound)[0].bins)


@pytest.mark.parametrize("least,most", [(300, 1100), (500, 900)])
def test_genetic_algorithm_has_fewer_bins_than_best_fit_decreasing(least, most):
    """2,000 pieces of `least` to `most` ids, with no help from best fit decreasing."""
    rng = random.Random(1)
    sizes = sorted((rng.randrange(least, most) for _ in range(2000)), reverse=True)
    plain, bound = len(packing.best_fit(sizes, list(range(2000)), 2048).bins), packing.lower_bound(sizes, 2048)
    begun = packing.evolve(sizes, [], 2048, random.Random(2), bound, children=0)
    bred = packing.evolve(sizes, [], 2048, random.Random(2), bound)
    assert bound <= len(bred[0].bins) < min(0.99 * plain, len(begun[0].bins))


def test_packing_search_is_lean(monkeypatch):
    """Best fit is what a plain search gives, without a table of the capacity's size; the bound takes a few searches, whatever the number of sizes."""
    rng = random.Random(4)
    for _ in range(200):
        capacity = rng.choice([1, 3, 10, 100])
        sizes = sorted((rng.randint(1, capacity) for _ in range(rng.randrange(40))), reverse=True)
        order = rng.sample(range(len(sizes)), len(sizes))
        room: list[int] = []
        for i in order:
            fits = [r for r in room if r >= sizes[i]]
            if fits:
                room[room.index(min(fits))] -= sizes[i]
            else:
                room.append(capacity - sizes[i])
        got = packing.best_fit(sizes, order, capacity)
        assert sorted(got.room) == sorted(room) and sorted(i for b in got.bins for i in b) == list(range(len(sizes)))
        assert all(capacity - sum(sizes[i] for i in b) == r for b, r in zip(got.bins, got.room, strict=True))
    assert not packing.Bins([], 1 << 20).by_room
    calls, search = [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda *a, **b: calls.append(1) or search(*a, **b))
    assert packing.lower_bound(list(range(2000, 0, -1)), 2048) == -(-sum(range(2001)) // 2048) and len(calls) < 20


def test_packing_of_many_equal_rows(spark):
    """No shard, so no task, holds much more than its share of equal rows."""
    pieces = spark.range(100_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(700).cast("long").alias("length"))
    got = packing.pack(pieces, 2048)
    sizes = [r["count"] for r in got.groupBy(F.shiftright("sequence_id", 20)).count().collect()]
    assert sum(sizes) == 100_000 and max(sizes) < 2 * packing.SHARD and got.select("sequence_id").distinct().count() == sum(-(-s // 2) for s in sizes)


def test_slices_against_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (v / 4).tolist()) for i, v in enumerate(rng.normal(size=(400, 8)))] + [(400, None), (401, [float("nan")] * 8), (402, [0.0] * 8), (None, [1.0] * 8), (403, [1.0] * 3), (500, [2.0] * 3)]
    rows += [(i + 1000, rows[i][1]) for i in range(60)]
    got = defaultdict(list)
    for r in slices.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    ints = {i: np.floor(1024 * np.array(v)).astype(int) for i, v in rows if i is not None and v is not None and np.isfinite(v).all()}
    for q in [i for i in ints if i % 100 == 0]:
        order = sorted((-int(ints[q] @ x), i) for i, x in ints.items() if i != q and len(x) == len(ints[q]))[:10]
        assert got[q] == [(k + 1, i, -s) for k, (s, i) in enumerate(order)]
    assert slices.top_k(spark.createDataFrame([], "vec_id long, embedding array<double>"), F.col("vec_id") % 100 == 0).count() == 0


def test_slices_of_repeated_queries(spark):
    """Rows of the query's own id take no place of others; other repeated rows count each."""
    rng = np.random.default_rng(6)
    one, hot = np.full(8, 4.0), np.full(8, 3.0)
    rows = [(0, one.tolist())] * 20 + [(7, hot.tolist())] * 4 + [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(200, 8)), 1000)]
    rows += [(9, (hot / 2).tolist())] * 30
    for k in (10, 30):
        got = [(r["rank"], r["vec_id"], r["score"]) for r in slices.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, k).orderBy("rank").collect()]
        order = sorted((-int(np.floor(1024 * np.array(v)) @ (1024 * one)), i) for i, v in rows if i)[:k]
        assert got == [(n + 1, i, -s) for n, (s, i) in enumerate(order)]


def test_slices_of_huge_components(spark):
    """Scores are exact in integers of any size; beyond a long they are the largest or smallest one."""
    rng = np.random.default_rng(8)
    rows = [(i, (v * 10.0 ** rng.integers(0, 12)).tolist()) for i, v in enumerate(rng.normal(size=(150, 6)))] + [(150, [1e300] * 6), (151, [-1e300] * 6)]
    ints = {i: [min(max(int(np.floor(1024 * x)), -(2**63)), 2**63 - 1) for x in v] for i, v in rows}
    got = defaultdict(list)
    for r in slices.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    clip = lambda x: min(max(x, -(2**63)), 2**63 - 1)
    for q in (0, 50, 100, 150):
        order = sorted((-clip(sum(a * b for a, b in zip(ints[q], x, strict=True))), i) for i, x in ints.items() if i != q)[:10]
        assert got[q] == [(i, -s) for s, i in order]


def test_chat(spark):
    hard = "[TURN]<s>\\x [\\INST] [\\\\INST] </s><"
    rows = [(1, 1, "user", hard), (1, 0, "user", "é"), (1, 2, "assistant", ""), (1, 3, "assistant", "[/ROLE]"), (1, 4, None, None), (None, 0, "</s>", "x"), (2, None, "assistant", hard), (2, 5, "assistant", hard), (2, 5, "assistant", hard)]
    made = chat.format_conversations(spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, turns string"))
    back = {r["conv_id"]: r for r in chat.read_back(made).collect()}
    for c in (1, 2, None):
        want = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == c), key=lambda r: -1 if r[1] is None else r[1])]
        assert [tuple(t) for t in back[c]["turns"]] == want
        assert back[c]["loss_text"] == "".join(t for role, t in want if role == "assistant")
    assert "MapInArrow" not in made._jdf.queryExecution().toString() and chat.format_conversations(made.select("conv_id", F.lit(1).alias("turn"), F.lit("a").alias("role"), F.lit("b").alias("text")).limit(0)).count() == 0


def test_pages():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="nav-open"><header><h2>Site</h2></header>
    <nav><ul><li><a href="/a">a</a></ul></nav><!-- <p>no</p> --><div class="ad">Buy now and the best.</div><div id="cookie-notice">We use cookies.</div><main><article><header><h1>Caf&eacute; &amp; more</h1></header>
    <p><b>One&nbsp; <i>two</i><br>three<p>Short<div class="share-buttons">Share</div><ul><li>item<li>other</ul><form><p>Mail</p></form><aside>Side</aside><p>Last &lt;p&gt;</p><section class="comments"><p>Nice!</p></section></article></main>
    <footer>&copy; 2020 &am"""
    assert pages.main_text(page) == "Café & more\n\nOne two three\n\nShort\n\nitem\n\nother\n\nLast <p>"
    assert pages.main_text(None) == pages.main_text("") == pages.main_text("<nav>x</nav><footer>y</footer>") == ""


def test_pages_by_density():
    good = "This is the text of a story that has all of the words which you would see in it, and it is long enough to be told from the rest of the page by them. " * 2
    page = f"<div><a href=x>Home</a> <a href=y>News of the day and of the week</a></div><h2>Heading</h2><div>{good}</div><div>Short one.</div><div>{good}</div><div>Register Login Cart Wishlist Compare Checkout Account Orders Vouchers Stores Careers Press Partners</div><div>tiny</div>"
    assert pages.main_text(page).split("\n\n") == ["Heading", good.strip(), "Short one.", good.strip()]


def test_pages_by_density_beside_an_article():
    good = "This is the text of a story that has all of the words which you would see in it, and it is long enough to be told from the rest of the page by them. " * 2
    junk = "Register Login Cart Wishlist Compare Checkout Account Orders Vouchers Stores Careers Press Partners"
    teaser = f"<article><p>Read this too.</p></article><div>{good}</div><div>Short one.</div><div>{good}</div><div>{junk}</div>"
    assert pages.main_text(teaser).split("\n\n") == ["Read this too.", good.strip(), "Short one.", good.strip()]
    beside = f"<div>{junk}</div><div>tiny</div><article><h1><a href=x>Title</a></h1><p>{good}</p><p>Ende</p><h2><a href=y>Other</a></h2><h2><a href=z>More</a></h2></article><div>tiny</div>"
    assert pages.main_text(beside).split("\n\n") == ["Title", good.strip(), "Ende"]


def test_both_passes_decide_blocks_of_pages(spark):
    """Of real pages the first pass calls blocks good, bad and ambiguous, and the second calls ambiguous ones good and bad."""
    seen = Counter()
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        blocks = pages.read_blocks(r["html"] or "")
        first = pages.first_pass(blocks)
        seen.update((a, b) for a, b in zip(first, pages.second_pass(blocks, first), strict=True))
    assert seen[True, True] > 100 and seen[None, True] > 100 and seen[True, False] == seen[False, True] == 0
    beside = "<article><p>Short.</p></article><p>tiny</p><div>Register Login Cart Wishlist Compare Checkout Account Orders Vouchers Stores Careers Press</div>"
    blocks = pages.read_blocks(beside)
    assert pages.first_pass(blocks) == [None, None, False] and pages.label_blocks(blocks) == [True, True, False]


def test_chat_of_a_long_conversation(spark):
    """30,000 turns of one conversation: spans of bytes, runs and sums against plain Python."""
    role = F.when(F.col("id") % 5 < 2, "user").otherwise("assistant")
    rows = spark.range(30_000).select(F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.concat(F.lit("é "), F.col("id").cast("string"), F.lit(" </s>")).alias("text"))
    began = time.perf_counter()
    made = chat.format_conversations(rows)
    back = chat.read_back(made).first()
    assert time.perf_counter() - began < 30
    want = [("user" if i % 5 < 2 else "assistant", f"é {i} </s>") for i in range(30_000)]
    assert [tuple(t) for t in back["turns"]] == want and back["loss_text"] == "".join(t for r, t in want if r == "assistant")
    data, spans = back["formatted"].encode(), made.first()["loss_spans"]
    assert [data[s["start"] : s["start"] + s["length"]].decode() for s in spans[-3:]] == [f"é {i} <\\/s>" for i in (29_997, 29_998, 29_999)]
    assert back["formatted"].count("</s>") == 12_000


LONG_PAGES = {
    "attribute": "<div " + "a" * 1_000_000 + ">x</div>", "value": "<div class=" + "a" * 1_000_000 + ">x</div>", "names": "<div " + "a " * 500_000 + ">x</div>", "space": "<div a" + " " * 1_000_000 + ">x", "tag": "<" + "a" * 1_000_000,
    "levels": "<div>" * 50_000 + "x" + "</div>" * 50_000, "ends": '<span class="ad"><article>' + "<div>" * 50_000 + "x</span>" * 50_000, "open": "<a<" * 300_000, "quotes": '<a ">' * 200_000, "signs": "<p>a" + "!" * 1_000_000 + "a</p>",
    "number": "<p>&#" + "9" * 100_000 + "; &#00000000065;</p>", "ands": "&" * 1_000_000, "scripts": "<script>" * 100_000, "comments": "<!--" * 200_000,
}


@pytest.mark.parametrize("name", LONG_PAGES)
def test_long_pages_take_linear_time(name):
    began = time.perf_counter()
    text = pages.main_text(LONG_PAGES[name])
    assert time.perf_counter() - began < 1.0
    assert text == {"attribute": "x", "value": "x", "names": "x", "space": "x", "levels": "x", "number": "\ufffd A"}.get(name, text)


def test_pages_frame(spark):
    rows = [(1, "u", "<p>a</p>", "x"), (None, None, None, "y"), (1, "u", "<p>a</p>", "x")]
    got = pages.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in got) == [(0, "", 0), (1, "a", 1), (1, "a", 1)]
    assert pages.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/documents.parquet").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").orderBy("doc_id").toPandas()
    grades = np.where(rows["toxic"] > 0, 0, np.where(rows["quality"] > 0, 2, 1))
    sets = quality.features(pa.array(rows["text"].tolist()))
    held = np.arange(len(rows)) % 3 == 0
    chosen, weights, cuts = quality.fit([s for s, h in zip(sets, held, strict=True) if not h], grades[~held])
    assert cuts[0] < cuts[1]
    weight = np.zeros(quality.SPACE)
    weight[chosen] = weights
    kept = np.array([quality._sigmoid(weight[s].sum() - cuts[1]) for s in sets]) >= quality.TAIL
    # fitted on under 700 documents here; 12,000 in production reject 99.9 % of toxic ones and keep 99.9 % of good ones
    assert kept[held & (grades == 2)].mean() > 0.97 and kept[held & (grades == 0)].mean() < 0.15 and kept[held & (grades == 1)].mean() < 0.25


def test_quality_edges(spark):
    texts = ["good words here", "bad idiot text", None, "", "good words here"]
    d = spark.createDataFrame([(i, t, 1.0, "c") for i, t in enumerate(texts)] + [(None, "x", 2.0, "c")], "doc_id long, text string, expected_grade double, `a.b` string")
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, 1), (2, 0, 0), (None, 1, 0), (4, None, None), (99, 1, 1)], "doc_id long, quality int, toxic int")
    got = quality.score(d, quality.train(d, labels))
    assert got.columns == ["doc_id", "text", "a.b", "expected_grade", "tail_probability"] and got.count() == 6
    assert all(0 <= r["expected_grade"] <= 2 for r in got.collect())
    none = quality.select(d, labels.limit(0))
    assert none.count() == 6 and quality.score(d.limit(0), quality.train(d, labels)).count() == 0


def test_bins_at_once():
    """Bins taken at once are as those opened one by one, and full ones are not copied; pieces are put back where they fill best."""
    rng = random.Random(4)
    for _ in range(200):
        sizes = sorted((rng.randrange(1, 65) for _ in range(rng.randrange(1, 60))), reverse=True)
        packed = packing.best_fit(sizes, rng.sample(range(len(sizes)), len(sizes)), 64)
        one, many = packing.Bins(sizes, 64), packing.Bins(sizes, 64)
        for b in packed.bins:
            one.open(b)
        many.fill(packed.bins, packed.room)
        assert (one.bins, one.room, one.rooms, one.by_room) == (many.bins, many.room, many.rooms, many.by_room)
        out = rng.sample(range(len(packed.bins)), len(packed.bins) // 2)
        stay = [(b, packed.room[k]) for k, b in enumerate(packed.bins) if k not in out]
        before = [b[:] for b in packed.bins]
        made = packing.put_back(stay, [i for k in out for i in packed.bins[k]], sizes, 64)
        assert before == packed.bins
        assert sorted(i for b in made.bins for i in b) == list(range(len(sizes)))
        assert all(64 - sum(sizes[i] for i in b) == r >= 0 for b, r in zip(made.bins, made.room, strict=True))
        full = {id(b) for b, r in stay if not r}
        assert full <= {id(b) for b in made.bins}


def test_first_letters_of_a_stretch():
    """Letters that begin a stretch are encoded as a word once, whatever follows: they are not kept again with their space."""
    coder = tokens.library_coder(PATH)
    text = "a nerodin nerodin.\nTha nerodin's nerodin%%% nerodin7 é²ß nerodin"
    assert np.frombuffer(coder.packed(text), "<u4").tolist() == loaded().encode(text, add_special_tokens=False).ids
    assert not any("nerodin" in w for w in coder.words)


@functools.cache
def word_tables():
    """One of the usual size, one whose words take each other's places and that is emptied again and again."""
    small = tokens.WordTable(library_coder(), places=4, most=20)
    small.BLOCK = 7
    return tokens.WordTable(library_coder()), small


@given(st.lists(st.none() | st.text(alphabet=st.sampled_from(list(" \t\n ab'stremvdl.,1éß×²日🙂\x00\x1c\x85\xa0　")) | st.characters(codec="utf-8"), max_size=40), max_size=6), st.integers(0, 2))
@settings(max_examples=400, deadline=None)
def test_word_tables_agree_with_the_library(texts, skip):
    column = pa.array(texts, pa.string()).slice(min(skip, len(texts)))
    want = [ids_of(loaded(), t).tobytes() for t in texts[skip:]]
    assert all(t.packed(column) == want for t in word_tables())


def test_word_table_on_odd_texts(library):
    texts = [*TEXTS, "it's we'll they've 'tis ''s x--'s 's's 'rest 'S 'l 'r", "'", "s", "x'", "d", "<|endoftext|>", "x <|endoftext|>'s", " 　a　 b　　c 　", "a\x00 \x00a", "é" * 40, "0123456789abcdef " * 3, "abcdefghijklmno abcdefghijklmnop"]
    for table in word_tables():
        assert table.packed(pa.array(texts)) == [ids_of(library, t).tobytes() for t in texts]
        assert table.packed(pa.array([], pa.string())) == [] and table.packed(pa.array([None, ""])) == [b"", b""]


def test_words_of_a_column_are_encoded_once(library, monkeypatch):
    """Whatever stands between two spaces, each word is encoded once: 3,600 different stretches are made of 121 words."""
    coder, asked = tokens.library_coder(PATH), []
    word = coder.word
    coder.word = lambda w: asked.append(w) or word(w)
    monkeypatch.setattr(tokens, "library_coder", lambda path: coder)
    monkeypatch.setattr(tokens, "_CODERS", {}, raising=False)
    monkeypatch.setattr(tokens, "_TABLES", {}, raising=False)
    names = ["".join(chr(97 + int(d)) for d in str(1000 + i)) for i in range(60)]
    texts = ["".join(f" {a}.{b}" for b in names) for a in names]
    (part, got), = tokens.packed_texts(iter([pa.record_batch({"text": pa.array(texts)})]), PATH, 0)
    assert got == [ids_of(library, t, [0]).tobytes() for t in texts]
    assert len(asked) == len(set(asked)) == 121

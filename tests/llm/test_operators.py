"""Each operator on hard rows and empty tables, and against brute force on small ones."""

from __future__ import annotations

import os
import random
import re
import sys
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))

import corpus_pipeline  # noqa: E402
from check import connect, difference  # noqa: E402
from coursemill.llm import html, language, licenses, lines, matrices, mixing, near, packing, quality, simhash, tokens, topk
from coursemill.llm.components import components
from coursemill.llm.queries.packing import digest
from coursemill.llm.registry import QUERIES, SQL

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
OPERATORS = {
    "language": language.identify, "lines": lines.dedup_lines, "mix": mixing.mix, "mixed": mixing.mixed_documents,
    "simhash": simhash.simhash_groups, "near": simhash.drop_near_duplicates, "licenses": licenses.scan_licenses,
    "quality": quality.judge_quality, "packing": packing.pack_in_order, "matrices": matrices.pack_matrices}
ROWS = {"language": 9, "lines": 9, "mix": 9, "simhash": 9, "licenses": 9, "quality": 9}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_hard_rows_and_empty_table(hard, name):
    rows = OPERATORS[name](hard).collect()
    assert len(rows) == ROWS.get(name, len(rows)) > 0
    assert OPERATORS[name](hard.limit(0)).collect() == []


def test_all_queries_are_registered():
    assert {re.match(r"op\d+|pipeline", n)[0] for n in QUERIES} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, SF).toPandas(), connect(SF).execute(SQL[name]).df()) is None


def texts(n, seed=1):
    r = random.Random(seed)
    base = [" ".join(r.choice("alpha beta gamma delta rho sigma tau phi chi psi".split()) + r.choice(["", ",", ".", "\n"]) for _ in range(r.randint(0, 90)))
            for _ in range(n // 3)]
    out = base + [b for b in base] + [re.sub("alpha", "omega", b, count=1) for b in base]
    return out


# 1
def test_page_text_of_layouts_and_broken_pages(spark):
    model = html.train()
    for page in html.LABELLED[:3]:
        got = html.main_text(page, model)
        assert got.startswith("New bridge for the old town\nThe town council") and "cookies" not in got and "street" not in got and "Copyright" not in got
    pages = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "<article><p>a &amp; b<p>c<br>d &eacute", "x"), (4, "<" * 5000 + "<p>" * 3000 + "</b" * 100, "x")],
                                  "page_id int, html string, text string")
    rows = {r["page_id"]: r for r in html.extract_text(pages).collect()}
    assert (rows[1]["text"], rows[2]["text"], rows[3]["text"]) == ("", "", "a & b\nc d é")
    assert rows[3]["n_chars"] == 11
    assert html.extract_text(pages.limit(0)).collect() == []


def test_marginals_equal_enumeration():
    model = html.train()
    tree, runs = html._parse("<div class=ad><p>Some words, here.</p></div><div><p>More words, there.</p><ul><li>x</li></ul></div>")
    n = len(tree.tags)
    scores = [sum(model["weight"].get(x, 0) for x in names) for names in html._features(tree, runs)]
    total, one = 0.0, [0.0] * n
    for bits in range(1 << n - 1):
        y = [0, *(bits >> i & 1 for i in range(n - 1))]
        p = np.exp(sum(s for s, v in zip(scores[1:], y[1:]) if v))
        for i in range(1, n):
            p *= model["pair"][html._kind(tree.tags[tree.parents[i]]), html._kind(tree.tags[i])][y[tree.parents[i]]][y[i]]
        total += p
        for i in range(n):
            one[i] += p * y[i]
    assert np.allclose(html.marginals(tree, runs, model), np.array(one) / total)


L = "The harbour was rebuilt after the storm of that winter, and the boats came back one after the other in spring."
S, C = "It took a while.", "Nonsense, my boat is still waiting for its place and nobody answers letters."
#: Layouts that are not among those learned from, with their blocks of text.
UNSEEN_LAYOUTS = {
    "comments in the article": (f"<nav><a href=1>Home</a></nav><article><h1>Harbour</h1><p>{L}</p><p>{S}</p><section class='comments'><h2>Comments</h2><p>{C}</p><p>{C}</p></section></article>", ["Harbour", L, S]),
    "notice in the article": (f"<article><p>{L}</p><div class='notice'>{S}</div><p>{L}</p></article>", [L, L]),
    "long notice in the article": (f"<article><h1>T</h1><p>{L}</p><div class='site-notice'><p>{L}</p></div><p>{L}</p></article>", ["T", L, L]),
    "comment widget": (f"<article><p>{L}</p><p>{S}</p></article><div id=disqus_thread><p>{C}</p></div>", [L, S]),
    "short list at the end": (f"<article><p>{L}</p><p>{L}</p><ul><li>one</li><li>two</li></ul></article>", [L, L, "one", "two"]),
    "short list first": (f"<div class=menu><ul><li><a href=1>a</a></li></ul></div><article><h1>T</h1><ul><li>rope</li><li>sail</li></ul><p>{L}</p></article>", ["T", "rope", "sail", L]),
    "reader comments": (f"<main><h1>T</h1><p>{L}</p><p>{L}</p><div class='reader-comments'><div><b>Ann</b><p>{C}</p></div></div></main>", ["T", L, L]),
    "list of comments": (f"<div class='post-content'><p>{L}</p><p>{S}</p></div><ol class='commentlist'><li>{C}</li><li>{C}</li></ol>", [L, S]),
    "advert in the article": (f"<article><p>{L}</p><div class='advert'><p>{L}</p></div><p>{S}</p></article>", [L, S]),
    "table": (f"<article><p>{L}</p><table><tr><td>Length</td><td>12 m</td></tr></table></article>", [L, "Length", "12 m"]),
    "quotation": (f"<article><p>{L}</p><blockquote>{S}</blockquote><p>{S}</p></article>", [L, S, S]),
}


@pytest.mark.parametrize("learned", ["layouts", "pages"])
def test_blocks_of_layouts_not_learned_from(spark, learned):
    model = html.train(spark.read.parquet(f"{SF}/pages.parquet") if learned == "pages" else None)
    for name, (page, blocks) in UNSEEN_LAYOUTS.items():
        assert html.main_text(f"<html><body>{page}</body></html>", model).split("\n") == blocks, name


def test_copies_of_a_page_count_once(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    many = pages.unionByName(pages.limit(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("n"))
    assert html.train(many, sample=50) == html.train(pages, sample=50)


# 2, 3
def test_parts_give_the_ids_of_the_whole_text():
    code = tokens.encoder(tokens.default_tokenizer())
    r = random.Random(3)
    cases = ["", "a", " a", "a ", "a  b", "a\n\nb", "a\nb c.\nD", "it's we'll", "x,y ,z", "née été 12.5%", "tab\tx", "a b", "<|endoftext|> x", "漢字 と. かな"]
    cases += ["".join(r.choice("ab cé.,!\n1'") for _ in range(40)) for _ in range(300)]
    want = [np.array(code.tokenizer.encode(c, add_special_tokens=False).ids, "<u4").tobytes() for c in cases]
    assert code.encode(cases) == want and code.encode(cases) == want


def test_packing_keeps_every_id_in_order(spark, hard):
    code = tokens.encoder(tokens.default_tokenizer())
    docs = spark.createDataFrame(list(enumerate([*texts(60), None, "word " * 5000])), "doc_id bigint, text string")
    want = {r["doc_id"]: code.encode([r["text"]])[0] + b"\0\0\0\0" for r in docs.collect()}
    pieces = digest(packing.pack_in_order(docs)).collect()
    rows = defaultdict(list)
    for p in pieces:
        own = want[p["doc_id"]][4 * p["start"]:4 * (p["start"] + p["length"])]
        assert p["ids_crc32"] == zlib.crc32(own) and p["doc_tokens"] == len(want[p["doc_id"]]) // 4
        rows[p["sequence_id"]].append((p["offset"], p["length"]))
    assert sum(p["length"] for p in pieces) == sum(map(len, want.values())) // 4
    for own in rows.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024


def cost_of_cuts(edges, price, size):
    return sum(packing.padding(b - a, size) for a, b in zip(edges, edges[1:])) + sum(price[c] for c in edges[1:-1])


def test_window_cuts_are_cheapest():
    """Against a plain dynamic programme over all cuts."""
    r = random.Random(5)
    for _ in range(80):
        size, total = r.choice([8, 12, 16, 32]), r.randint(1, 200)
        ends = np.array(sorted({total, *(r.randint(1, total) for _ in range(r.choice([0, 3, 20, 60])))}))
        price = np.full((total + 1, 1), packing.INNER_CUT, np.float32)
        price[ends, 0] = [r.choice([0.0, packing.SENTENCE_CUT]) for _ in ends]
        best = [0.0]
        for p in range(1, total + 1):
            best.append(min(best[p - n] + packing.padding(n, size) for n in range(1, min(size, p) + 1)) + price[p, 0])
        (edges,), cost = packing.lane_cuts(price, np.array([total]), size)
        assert edges[0] == 0 and edges[-1] == total and all(0 < b - a <= size for a, b in zip(edges, edges[1:]))
        assert cost[0] == best[total] - price[total, 0] == cost_of_cuts(edges, price[:, 0], size)


def test_packing_holds_a_chunk_in_little_memory():
    r = np.random.default_rng(5)
    ids = r.integers(0, 60000, 1 << 20).astype("<u4")
    coded = [x.tobytes() for x in np.split(ids, np.arange(700, len(ids), 700))]
    ends = r.random(50000) < 0.05
    tracemalloc.start()
    out = packing._pack(list(range(len(coded))), coded, ends, 1024, 0, pa.int64())[0]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 24e6, f"{most / 1e6:.0f} MB"  # 31 with costs of all places and ids held twice
    assert b"".join(out["ids"].to_pylist()) == ids.tobytes() and not coded


def test_documents_without_sentence_ends_are_packed_without_padding():
    for length in (1500, 2500, 3000):
        ends = np.arange(length, 400 * length, length)
        edges = packing.window_cuts(ends, np.ones(len(ends), bool))
        assert edges[0] == 0 and edges[-1] == ends[-1] and all(0 < b - a <= 1024 for a, b in zip(edges, edges[1:]))
        padded = sum(0 if (b - a) & (b - a - 1) == 0 else 1024 - b + a for a, b in zip(edges, edges[1:]))
        assert padded < 0.02 * ends[-1] and len(edges) < 1.05 * ends[-1] / 1024 + 12


def test_window_cuts_reach_sentence_ends():
    """Most cuts lie at sentence ends for little padding; the grid of full windows hits one in twenty."""
    r = random.Random(8)
    ends = np.cumsum([r.randint(3, 40) for _ in range(20_000)])
    is_document = np.arange(len(ends)) % 50 == 49
    is_document[-1] = True
    edges = packing.window_cuts(ends, is_document)
    total, length = int(ends[-1]), np.diff(edges)
    assert edges[0] == 0 and edges[-1] == total and length.min() > 0 and length.max() <= 1024
    price = np.full(total + 1, packing.INNER_CUT)
    price[ends] = np.where(is_document, 0.0, packing.SENTENCE_CUT)
    grid = [*range(0, total, 1024), total]
    assert np.isin(grid[1:-1], ends).mean() < 0.1 and np.isin(edges[1:-1], ends).mean() > 0.5
    assert sum(1024 - n for n in length.tolist() if n & (n - 1)) < 0.01 * total
    assert cost_of_cuts(edges, price, 1024) < 0.8 * cost_of_cuts(grid, price, 1024)


def test_lanes_begin_at_ends_and_are_full_without():
    assert packing.lane_starts(np.array([10_000]), 4096).tolist() == [0, 4096, 8192]
    ends = np.array([2000, 4030, 4060, 4090, 8170, 8186, 9000])
    assert packing.lane_starts(ends, 4096).tolist() == [0, 4060, 4060 + 4096]
    assert packing.lane_starts(ends[ends != 4060], 4096).tolist() == [0, 4090, 8186]


def test_large_ids_beside_null_stay(spark):
    big = 9007199254740993
    docs = spark.createDataFrame([(big, "one two"), (None, "three"), (big + 2, None)], "doc_id bigint, text string").coalesce(1)
    assert [r["doc_id"] for r in packing.pack_in_order(docs).select("doc_id").distinct().collect()].count(big) == 1
    assert {r["doc_id"] for r in packing.pack_in_order(docs).collect()} == {big, None, big + 2}
    assert {i for r in matrices.pack_matrices(docs).collect() for i in r["doc_ids"]} == {big, None, big + 2}
    named = docs.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("doc_id"), "text")
    assert {r["doc_id"] for r in packing.pack_in_order(named).collect()} == {f"d{big}", None, f"d{big + 2}"}


def test_matrices_hold_the_ids_segments_and_positions(spark):
    code = tokens.encoder(tokens.default_tokenizer())
    docs = spark.createDataFrame(list(enumerate([*texts(90), None, "word " * 3000])), "doc_id bigint, text string")
    want = {r["doc_id"]: np.frombuffer(code.encode([r["text"]])[0] + bytes(4), "<u4").tolist() for r in docs.collect()}
    found = defaultdict(dict)
    for r in matrices.pack_matrices(docs, end_id=0).collect():
        ids, positions, edges = np.frombuffer(r["ids"], "<u4").tolist(), np.frombuffer(r["position_ids"], "<u4").tolist(), r["cu_seqlens"]
        assert len(ids) == len(positions) == 1024 and edges[0] == 0 and edges[-1] == r["n_tokens"] <= 1024
        for doc, start, a, b in zip(r["doc_ids"], r["starts"], edges, edges[1:]):
            found[doc][start] = ids[a:b]
            assert positions[a:b] == list(range(b - a))
        assert set(ids[edges[-1]:]) <= {0} and positions[edges[-1]:] == list(range(1024 - edges[-1]))
    assert {d: [i for _, part in sorted(own.items()) for i in part] for d, own in found.items()} == want


def test_quick_ids_are_those_of_the_library_for_any_characters():
    code, r = tokens.encoder(tokens.default_tokenizer()), random.Random(7)
    spans = [(32, 0x250), (0x370, 0x500), (0x2010, 0x20C0), (0x3000, 0x3100), (0x4E00, 0x9FA6), (0xAC00, 0xD7A4), (0xFF01, 0xFF5F), (1, 33), (0x1F300, 0x1F700)]
    cases = ["".join(chr(r.randrange(*r.choice(spans))) if r.random() < .8 else r.choice([" ", "\n", "'s", "  "]) for _ in range(r.randint(0, 40))) for _ in range(800)]
    want = [np.array(code.tokenizer.encode(c, add_special_tokens=False).ids, "<u4").tobytes() for c in cases]
    assert code.encode(cases) == want and sum(bool(tokens.KNOWN.fullmatch(c)) for c in cases) > 50


def test_plain_texts_do_not_load_the_library():
    code = tokens.Encoder(tokens.default_tokenizer())
    ids = code.encode(["Plain words. Więcej słów!", "", None])
    assert ids[0] and "tokenizer" not in vars(code)
    vocabulary = code.tokenizer.get_vocab()
    assert len(code.ends) == max(vocabulary.values()) + 1
    assert np.frombuffer(ids[0], "<u4").tolist() == code.tokenizer.encode("Plain words. Więcej słów!", add_special_tokens=False).ids
    code.encode(["\u0378"])
    assert "tokenizer" in vars(code)


def test_matrices_are_lossless_and_best_fit():
    r = random.Random(2)
    sizes = [r.randint(1, 64) for _ in range(400)]
    bins = matrices.best_fit(sizes, 64)
    assert sorted(i for b in bins for i in b) == list(range(400)) and all(sum(sizes[i] for i in b) <= 64 for b in bins)
    free, count = [], 0  # plain best fit
    for s in sorted(sizes, reverse=True):
        fits = [f for f in free if f >= s]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - s)
        else:
            count += 1
            free.append(64 - s)
    assert len(bins) == count


# 4
def test_language_of_held_out_texts(spark):
    rows = QUERIES["op4_language_id"](spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id")
    held = rows.where("held_out").select((F.col("lang") == F.col("lang_pred")).cast("int").alias("ok"), "score").collect()
    assert sum(r["ok"] for r in held) / len(held) > 0.97 and all(0 <= r["score"] <= 1 for r in held)


def test_language_und_and_unlearned(docs):
    got = language.identify(docs((1, None, "en", "a"), (2, "12 34", "en", "a"), (3, "the text", None, "a"))).collect()
    assert [(r["lang_pred"], r["score"]) for r in got] == [("und", 0.0)] * 3


# 5
def test_overlapping_windows_merge(docs):
    got = lines.dedup_lines(docs((1, "a\nb\nc\nd", "", ""), (2, "x\na\nb\nc\nd\ny", "", ""), (3, "a\nb", "", ""), (4, "q\nq\nq\nq", "", ""))).orderBy("doc_id").collect()
    assert [(r["text"], r["n_removed"]) for r in got] == [("a\nb\nc\nd", 0), ("x\ny", 4), ("a\nb", 0), ("q", 3)]


# 6
def test_top_k_equals_brute_force(spark):
    r = np.random.default_rng(1)
    x = np.round(r.normal(size=(300, 8)), 1)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [1.0] * 7 + [float("nan")]), (902, [1.0, 2.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), F.col("vec_id") % 50 == 0).collect()
    q = np.floor(256 * x).astype(int)
    want = set()
    for i in range(0, 300, 50):
        order = sorted((j for j in range(300) if j != i), key=lambda j: (-int(q[i] @ q[j]), j))[:5]
        want |= {(i, k + 1, j, int(q[i] @ q[j])) for k, j in enumerate(order)}
    assert {tuple(t) for t in got} == want
    assert topk.top_k(spark.createDataFrame([], "vec_id bigint, embedding array<float>"), F.col("vec_id") % 50 == 0).collect() == []


def test_skewed_lists_are_read_in_part():
    r = np.random.default_rng(2)
    x = np.floor(r.pareto(1.2, (3000, 1)) * r.random((3000, 16)) * 100).astype(np.int64)
    found, read = topk.nra(x[:40], np.arange(40), x, np.arange(3000), 5)
    exact = x[:40] @ x.T
    exact[np.arange(40), np.arange(40)] = -1
    least = np.sort(exact, axis=1)[:, -5]
    assert sorted(found) == [(i, int(j), int(exact[i, j])) for i in range(40) for j in np.flatnonzero(exact[i] >= least[i])]
    assert np.mean(read < 0.2) > 0.9


@pytest.mark.parametrize("scale", [1, 10 ** 5, 10 ** 8])
def test_nra_with_ties_and_large_numbers(scale):
    r = np.random.default_rng(scale)
    x = r.integers(-3, 4, (500, 6)) * scale
    found, _ = topk.nra(x[:20], np.arange(20), x, np.arange(500), 5)
    for i in range(20):
        own = sorted((-(int(s)), j) for a, j, s in found if a == i)[:5]
        assert own == sorted((-sum(int(a) * int(b) for a, b in zip(x[i], x[j])), j) for j in range(500) if j != i)[:5]


# 7
def test_mix_hits_its_targets(docs):
    rows = mixing.mix(docs(*[(i, "w " * (i % 7 + 1), "", s) for i, s in enumerate(["a"] * 60 + ["b"] * 20 + ["c"] * 20 + [None] * 9)])).collect()
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
        assert 0 <= r["taken"] <= 2 * r["size"]
    for own in by.values():
        assert sum(r["taken"] for r in own) == int(own[0]["target"]) <= 2 * own[0]["source_size"]
    assert abs(sum(own[0]["target"] for own in by.values()) - 1.5 * sum(r["size"] for r in rows)) < 1e-6


def test_mixed_documents_repeat_and_cut(docs):
    frame = docs((1, " a  b\tc d ", "", "a"), (2, "e f", "", "a"), (3, "g h i j k l", "", "b"))
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(frame).collect()}
    got = Counter()
    for r in mixing.mixed_documents(frame).collect():
        got[r["doc_id"]] += len(WORD.findall(r["text"]))
    assert {k: v for k, v in taken.items() if v} == dict(got)


# 8
def test_simhash_equals_brute_force(docs):
    own = [*texts(90), None, "", "  ", "a", "A"]
    got = simhash.simhash_groups(docs(*[(i, t, "", "") for i, t in enumerate(own)])).collect()

    def plain(text):
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        grams = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fp = [plain(t) for t in own]
    root = list(range(len(own)))
    for _ in own:
        root = [min(root[j] for j in range(len(own)) if (fp[i] ^ fp[j]).bit_count() <= 4) for i in range(len(own))]
    assert {(r["id"], r["fp"] % 2 ** 64, r["component_id"]) for r in got} == {(i, fp[i], root[i]) for i in range(len(own))}


@pytest.mark.parametrize("radius", [2, 4, 5])
def test_close_pairs_in_a_dense_group(spark, monkeypatch, radius):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    r = random.Random(4)
    fps = {r.getrandbits(64) for _ in range(100)} | {0xABCDEF ^ sum(1 << r.randrange(64) for _ in range(3)) for _ in range(300)}
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in (f % 2 ** 64 for f in fps))
    got = dict((r["node"], r["root"]) for r in components(simhash.close_pairs(spark.createDataFrame([(f,) for f in fps], "fp bigint"), radius)).collect())
    root = {f: f for f in fps}
    while True:
        new = {f: min(root[g] for g in fps if ((f ^ g) % 2 ** 64).bit_count() <= radius) for f in fps}
        if new == root:
            break
        root = new
    assert {f: got.get(f, f) for f in fps} == root


# 9
def test_license_places_and_labels(docs):
    rows = licenses.scan_licenses(docs((1, "Released under the MIT License. mit\nlicense!", "", ""), (2, "licensed under CC BY-NC 4.0", "", ""),
                                       (3, "the mit or license", "", ""), (4, None, "", ""))).orderBy("doc_id").collect()
    assert [(r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"]) for r in rows] == [
        (7, 2, 3, 5, "mit", "mit"), (7, 0, None, None, "", "cc-by-nc"), (4, 0, None, None, "", ""), (0, 0, None, None, "", "")]


def test_license_places_equal_brute_force(spark):
    r = random.Random(11)
    pool = "mit license apache general public lesser the software cc by sa 4 0 bsd Licence MIT-License é".split()
    texts_ = ["".join(r.choice(pool) + r.choice([" ", "\n", ", ", "-", "__", "é", " "]) for _ in range(r.randint(0, 60))) for _ in range(300)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts_)), "doc_id bigint, text string")
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    for x in licenses.scan_licenses(docs).collect():
        words = word.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in x["text"] or ""))
        starts = {p: [i for i in range(len(words)) if words[i:i + len(p.split())] == p.split()] for p in licenses.BASE}
        places = sorted(i for own in starts.values() for i in own)
        base = ",".join(sorted({licenses.BASE[p] for p, own in starts.items() if own}))
        assert (x["n_words"], x["n_base"], x["base_labels"]) == (len(words), len(places), base)
        assert (x["first_word"], x["last_word"]) == ((places[0], places[-1]) if places else (None, None))
        assert {*base.split(",")} <= {*x["labels"].split(","), ""} and 0 <= x["score"] <= 1
        # Every label of a template: its key phrase stands there in full.
        keys = {label: [key for name, _, key in licenses.TEMPLATES if name == label] for label, _, _ in licenses.TEMPLATES}
        joined = " ".join(words)
        assert all(any(k in joined for k in keys[label]) or label in base for label in x["labels"].split(",") if label)


def test_a_file_meets_only_templates_of_its_rare_words():
    idf = {w: float(len(w)) for w in licenses.VOCABULARY}
    index = licenses.TemplateIndex(idf)
    assert sum(map(len, index.postings.values())) == len({*licenses.BASE, *(k for _, _, k in licenses.TEMPLATES)})
    met = {key for w in (b"cc", b"by", b"4") for key, *_ in index.postings.get(w, ())}
    assert met and all(key.startswith("cc") for key in met)
    assert index.phrases(licenses.words_of("x cc by 4 cc by sa by 4")) == {"cc by 4": [1], "cc by sa": [4]}


# 10
def test_quality_counts_and_verdicts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = quality.judge_quality(docs).join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").join(docs.select("doc_id", "text"), "doc_id").collect()
    for r in rows:
        w = WORD.findall(r["text"])
        grams = Counter(zip(w, w[1:], w[2:]))
        covered = {i + k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in range(3)}
        own = [x for x in r["text"].split("\n") if WORD.search(x)]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", r["text"])), len(own) - len(set(own)), len(covered))
    passed = [r for r in rows if not r["base_failed"]]
    assert sum(r["kept"] == bool(r["quality"]) for r in passed) / len(passed) > 0.99


def voted(seed, rules=6, noisy=0.12):
    """Patterns of rules that see junk together, but for the last, which votes bad on any document alike; and which are junk."""
    r, rows = random.Random(seed), []
    for _ in range(20000):
        bad = r.random() < 0.15
        rows.append((tuple([0 if r.random() < (0.75 if bad else 0.01) else 1 for _ in range(rules - 1)] + [0 if r.random() < noisy else 1]), bad))
    return rows


def test_good_votes_outweigh_a_rule_that_votes_at_random():
    rows = voted(1)
    patterns = sorted(Counter(v for v, _ in rows).items())
    right = {}
    for rounds in (0, 50):
        good, rates = quality.fit_rules(patterns, rounds)
        kept = {v: quality.posterior(v, good, rates) >= 0.5 for v, _ in patterns}
        right[rounds] = sum(kept[v] != bad for v, bad in rows) / len(rows)
    must_pass = sum((0 not in v) != bad for v, bad in rows) / len(rows)
    assert must_pass < 0.87 and right[0] < 0.993 and right[50] > 0.996
    assert kept[(1, 1, 1, 1, 1, 0)] and not kept[(0, 0, 0, 1, 1, 1)]
    assert abs(good - 0.85) < 0.02 and abs(rates[-1][0] - 0.88) < 0.02 and abs(rates[-1][1] - 0.12) < 0.03 and abs(rates[0][1] - 0.75) < 0.05


def test_verdict_on_documents_is_not_that_of_all_rules(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    judged = quality.judge_quality(docs.select("doc_id", "text"))
    any_bad = F.greatest(*[F.coalesce(1 - v, F.lit(0)) for v in quality.votes().values()]) == 1
    rows = judged.select("posterior", any_bad.alias("bad")).collect()
    assert any(r["bad"] and r["posterior"] > 0.5 for r in rows) and any(r["bad"] and r["posterior"] < 0.5 for r in rows)


NAMES = ("_id", "_text", "_from", "_to", "_at", "_row", "_key", "_range", "_source", "_p", "_found", "_w", "_l", "_hash", "_words", "_beside0", "_size")


@pytest.mark.parametrize("name", ["language", "lines", "mix", "mixed", "licenses", "quality", "dropped"])
def test_columns_of_any_name_come_through(spark, docs, name):
    operator = {**OPERATORS, "dropped": near.drop_near_copies}[name]
    rows = docs(*[(i, f"one two three {i}\nfour five\nsix seven eight nine {i}", "en", "a") for i in range(6)])
    named = rows.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in NAMES})
    got = operator(named).collect()
    assert got and all(r[c] == f"{c}{r['doc_id']}" for r in got for c in NAMES)


# pipeline
def test_pipeline_stages(spark, docs):
    r = random.Random(9)
    words = {"en": "the of and with that house water stone".split(), "de": "der und ein nicht haus wasser über".split()}
    own = [(i, "\n".join(" ".join(r.choice(words[k]) for _ in range(12)) for _ in range(6)), k, f"s{i % 3}") for i in range(40) for k in [("en", "de")[i % 2]]]
    passage = "\n".join(own[0][1].split("\n")[:4])
    frame = docs(*own, (100, own[1][1], "en", "s0"), (101, own[3][1], "en", "s0"), (102, "12 34", "en", "s0"), (103, None, "en", "s0"), (104, passage + "\na last line", "en", "s1"))
    kept = {}
    current = frame
    for name, stage in corpus_pipeline.STAGES:
        current = stage(spark, current, "")
        kept[name] = current.collect()
        if name != "packing":
            assert current.columns == frame.columns
    ids = {n: {x["doc_id"] for x in rows} for n, rows in kept.items()}
    assert {102, 103} & ids["language_id"] == set() and set(range(40)) | {100, 101, 104} <= ids["language_id"]
    assert ids["line_dedup"] == ids["language_id"] - {100, 101}
    assert next(x["text"] for x in kept["line_dedup"] if x["doc_id"] == 104) == "a last line"
    assert ids["near_dedup"] == ids["line_dedup"] and len(kept["mixing"]) > 0
    sizes = Counter()
    for p in kept["packing"]:
        sizes[p["sequence_id"]] += p["length"]
    code = tokens.encoder(tokens.default_tokenizer())
    assert sum(sizes.values()) == sum(len(code.encode([x["text"]])[0]) // 4 + 1 for x in kept["mixing"]) and max(sizes.values()) <= 1024

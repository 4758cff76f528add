"""Scan repair, leaks, mixing and splitting: found cases, exact results, odd input."""

import math
import random

import pytest
from pyspark.sql import functions as F

from quillstone.llm import leakage, mixing, scans, splitting, tokens

WORDS = "patients with renal impairment should take the recommended dose after the evening meal unless the advisory committee accepts another treatment for chronic urinary tract infection because elderly volunteers reported somnolence headache and constipation during the double-blind extension".split()


def prose(seed, n):
    rng = random.Random(seed)
    return [rng.choice(WORDS) for _ in range(n)]


def wrapped(words, width=60):
    lines, now = [], ""
    for w in words:
        if len(now) + len(w) + 1 > width:
            lines.append(now)
            now = w
        else:
            now = f"{now} {w}".strip()
    return lines + [now]


# ---- scans

PRODUCT = "id string, document_text string, product_name string, field string"
CHUNK = "id int, product_id string, chunk_index int, chunk_text string, line_no int"


@pytest.fixture(scope="module")
def scanned(spark):
    rows = []
    for k in range(40):
        body = wrapped(prose(k, 220))
        for page in range(3):
            body[6 * page + 5 : 6 * page + 5] = ["Archive copy, not for resale", f"page {page + 1}", "Omfremoxon 75 mg | SmPC"]
        rows.append((f"c{k}", "\n".join(body), "Omfremoxon 75 mg tablet", "x"))
    noisy = ["patients with rena1 impairment should take the recom-", "mended dose after the evening", "Archive copy, not for resale", "page 1", "Omfremoxon 75 mg | SmPC", "meal unless the adv isory committee accepts double-", "blind treatment", "", "40", "", "for chronic urin@ry tract infection"]
    rows += [("noisy", "\n".join(noisy), "Omfremoxon 75 mg tablet", "x"), ("plain", "Table of units:\n\n25\n\n40\nelderly volunteers double-\nblind extension", "y", "x"), ("none", None, "z", "x"), ("empty", "", "z", "x")]
    chunks = [(1, "noisy", 0, "\n".join(noisy[:2]), 9), (1, "noisy", 0, "\n".join(noisy[:2]), 9), (2, "noisy", 1, "\n".join(noisy[1:6]), 9), (3, "noisy", None, "page 4", 9), (4, "gone", 0, None, 9), (5, None, 0, "text", 9), (6, "noisy", 2, "", 9)]
    return spark.createDataFrame(rows, PRODUCT), spark.createDataFrame(chunks, CHUNK)


def test_damaged_lines(scanned):
    got = {tuple(r) for r in scans.found(*scanned).collect()}
    of = lambda key, field="document_text": {(n, k) for f, r, n, k in got if r == key and f == field}
    assert of("noisy") == {(1, "misread"), (1, "hyphen"), (3, "header"), (4, "page_number"), (5, "header"), (6, "misread"), (11, "misread")}
    assert of("plain") == set() and of("empty") == set()
    assert {(n, k) for n, k in of("c3")} == {(6 + 6 * p + i, k) for p in range(3) for i, k in enumerate(("header", "page_number", "header"))}
    assert of("1", "chunk_text") == {(1, "misread"), (1, "hyphen")}
    assert of("2", "chunk_text") == {(2, "header"), (3, "page_number"), (4, "header"), (5, "misread")} and of("3", "chunk_text") == {(1, "page_number")}
    assert scans.found(*scanned).count() == len(got)


def test_clean_text(scanned):
    clean = {(r["field"], r["row_key"]): r["clean_text"] for r in scans.cleaned(*scanned).collect()}
    assert clean["document_text", "noisy"].startswith("patients with renal impairment should take the recommended dose after the evening meal unless the advisory committee accepts double-blind treatment")
    assert clean["document_text", "noisy"].endswith("for chronic urinary tract infection") and ("document_text", "plain") not in clean


def test_verdicts_do_not_depend_on_the_partitions(scanned, monkeypatch):
    """Lines, words and pairs are counted over all texts, whichever task reads them and however often it hands on."""
    products, chunks = scanned
    filler = products.sparkSession.createDataFrame([(f"f{k}", "\n".join(wrapped(prose(900 + k, 80)) + ["Archive copy, not for resale", "Undesirable effects"]), "x", "x") for k in range(30)], PRODUCT)
    texts = products.unionByName(filler)
    one = {tuple(r) for r in scans.found(texts.coalesce(1), chunks.coalesce(1)).collect()}
    monkeypatch.setattr(scans, "HELD", 300)
    many = {tuple(r) for r in scans.found(texts.repartition(24), chunks.repartition(5)).collect()}
    assert one == many and any(kind == "header" for *_, kind in one)


def test_sketches_follow_the_number_of_words():
    from collections import Counter

    counts = Counter({f"word{i}": i % 7 + 1 for i in range(30_000)})
    table = scans._fold([scans._unpack(scans._pack(p)) for p in scans._sketch(counts)])
    assert len(table) == 2 * (1 << 18) and sum(scans._read(table, w) != n for w, n in counts.items()) < 0.02 * len(counts)
    assert len(scans._fold([])) == 2 * scans.LEAST_CELLS


def test_scans_of_nothing(scanned):
    products, chunks = scanned
    assert scans.found(products.limit(0), chunks.limit(0)).count() == 0


def test_long_text_is_read_whole(spark):
    line = "patients with renal impairment should take the recommended dose"
    text = "\n".join([line] * 30_000 + ["page 1", "Omfremoxon 75 mg", "patients with rena1 impairment"])
    products = spark.createDataFrame([("long", text, "x", "y")], PRODUCT)
    got = {(r["line_no"], r["kind"]) for r in scans.found(products, spark.createDataFrame([], CHUNK)).collect()}
    assert got == {(30_001, "page_number"), (30_002, "header"), (30_003, "misread")}


# ---- leaks

DOC = "doc_id long, text string, source string, item_id long, doc_type string"
ITEM = "item_id long, item_set string, text string, answer string"


@pytest.fixture(scope="module")
def leaky(spark):
    rng = random.Random(1)
    vocabulary = [f"w{i}x{rng.randrange(999)}" for i in range(400)] + WORDS * 4
    items = [[rng.choice(vocabulary) for _ in range(60)] for _ in range(6)]
    docs = {i: " ".join(prose(100 + i, 300)) for i in range(60)}
    put = lambda d, words: docs.__setitem__(d, " ".join(prose(d, 120) + words + prose(d + 1, 90)))
    put(200, items[0])
    put(201, [w.upper() + "," for w in items[1]])
    put(202, items[2][10:45])
    put(203, items[3][:20])
    altered = list(items[4])
    altered[7], altered[30], altered[50] = "changed", altered[30] + "q", "other"
    put(204, altered)
    docs[205], docs[206], docs[207] = None, "", " ".join(items[5] * 3)
    docs[208] = docs[200]
    return spark.createDataFrame([(i, t, "s", 0, None) for i, t in docs.items()], DOC), spark.createDataFrame([(k + 1, "a", " ".join(w), "B") for k, w in enumerate(items)] + [(90, "a", None, None), (91, "a", "", "A")], ITEM)


def test_leaks(leaky):
    got = {tuple(r) for r in leakage.found(*leaky).collect()}
    assert got == {(200, 1), (201, 2), (202, 3), (204, 5), (207, 6), (208, 1)}


def test_leaks_recall_against_brute_force(leaky):
    documents, items = leaky
    known = {r["item_id"]: leakage.words_of(r["text"] or "") for r in items.collect()}
    brute = set()
    for r in documents.collect():
        words = leakage.words_of(r["text"] or "")
        for i, item in known.items():
            if item and words:
                a, b, _, _, m = leakage.longest_run(item, words)
                if b - a >= leakage.SHARE * len(item) and m >= leakage.MATCHED * (b - a):
                    brute.add((r["doc_id"], i))
    got = {tuple(r) for r in leakage.found(documents, items).collect()}
    assert len(got & brute) >= 0.9 * len(brute) and got <= brute


def test_every_run_that_would_be_accepted_is_aligned():
    rng = random.Random(3)
    accepted = 0
    for k in range(300):
        item = prose(k, rng.randrange(6, 80))
        run = item[rng.randrange(len(item) // 3 + 1) :]
        every = rng.randrange(1, 4)
        run = [w[:-1] + "q" if len(w) > 3 and i % every == 0 else w for i, w in enumerate(run)]
        for _ in range(rng.randrange(len(run))):
            run.insert(rng.randrange(len(run)), "added")
        text = prose(k + 1, rng.randrange(300)) + run + prose(k + 2, rng.randrange(300))
        target = leakage.Target(item)
        a, b, _, _, m = leakage.longest_run(target, text)
        least = math.ceil(leakage.SHARE * len(item))
        if b - a >= least and m >= leakage.MATCHED * (b - a):
            accepted += 1
            assert target.may_hold(text, leakage.MATCHED * least)
    assert accepted > 100


def test_a_half_with_every_third_word_slipped_leaks(spark):
    item = [f"{w}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i, w in enumerate(prose(77, 74))]
    run = [w[:-2] + "q" + w[-1] if i % 3 == 2 else w for i, w in enumerate(item[:38])]
    texts = [" ".join(prose(i, 120)) for i in range(20)] + [" ".join(prose(50, 30) + run + prose(51, 30))]
    documents = spark.createDataFrame([(i, t, "s", 0, None) for i, t in enumerate(texts)], DOC)
    assert [tuple(r) for r in leakage.found(documents, spark.createDataFrame([(1, "a", " ".join(item), "B")], ITEM)).collect()] == [(20, 1)]


def test_a_long_poor_run_hides_no_good_one():
    item = [f"i{k}w" for k in range(40)]
    poor = [w if k % 5 else "zz" for k, w in enumerate(item) if k % 4]  # longer, but too much is altered
    text = poor + ["other"] * 5 + item[10:31]
    run = leakage.accepted_run(leakage.Target(item), text, 20, [])
    assert run is not None and run[0] >= 20 and run[3] is False
    assert leakage.accepted_run(leakage.Target(item), poor, 20, []) is None


def test_the_answer_decides_about_a_paraphrase(spark):
    item = [f"{w}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i, w in enumerate(prose(78, 60))]
    told = ["mended" if i % 4 == 3 else w for i, w in enumerate(item)]
    texts = [" ".join(prose(i, 120)) for i in range(20)] + [" ".join(prose(50, 30) + told + ["Answer:", answer] + prose(51, 30)) for answer in ("Zurolast", "Belmontin")]
    documents = spark.createDataFrame([(i, t, "s", 0, None) for i, t in enumerate(texts)], DOC)
    items = spark.createDataFrame([(1, "a", " ".join(item), "zurolast")], ITEM)
    assert [(r["doc_id"], r["item_id"], r["answer_follows"]) for r in leakage.leaks(documents, items).collect()] == [(20, 1, True)]


def test_leaks_of_nothing(leaky):
    documents, items = leaky
    assert leakage.found(documents.limit(0), items).count() == 0 and leakage.found(documents, items.limit(0)).count() == 0


# ---- tokens and splitting

LIMITS = "doc_type string, max_tokens int, overlap_tokens int, text string"


@pytest.mark.parametrize("path", [None, tokens.default_path()])
def test_token_starts(path):
    t = tokens.tokenizer(path)
    for text in ("", "plain words here", "größer – naïve 中文 🙂🙂 end", "x" * 500):
        starts = t.starts(text)
        assert len(starts) - 1 == (t.count(text) if text and path else len(starts) - 1) and starts[0] == 0 and starts[-1] == len(text) and (starts[1:] >= starts[:-1]).all()


def pieces(spark, texts, limits=(("SPC", 50, 10), ("other", 30, 0))):
    docs = spark.createDataFrame([(i, t, kind, 5) for i, (t, kind) in enumerate(texts)], "doc_id long, text string, doc_type string, max_tokens int")
    rows = splitting.pieces(docs, spark.createDataFrame([(*x, "clash") for x in limits], LIMITS)).orderBy("doc_id", "piece_no").collect()
    out = {}
    for r in rows:
        out.setdefault(r["doc_id"], []).append(r)
    return out


def test_pieces_rebuild_the_text_within_limits(spark):
    rng = random.Random(5)
    texts = []
    for k in range(12):
        sentences = [" ".join(prose(k * 50 + i, rng.randrange(3, 25))).capitalize() + "." for i in range(25)]
        texts.append((rng.choice(["\n\n", " ", "\n"]).join(sentences), rng.choice(["SPC", None, "unknown"])))
    texts += [("x" * 3000, "SPC"), ("中文🙂" * 200, None), ("中🙂文 größer " * 90, "SPC"), ("🙂🙂" * 90, "SPC"), ("", "SPC"), (None, "SPC"), ("short.", "SPC"), (" \n" * 300, "SPC")]
    got = pieces(spark, texts)
    t = tokens.tokenizer(tokens.default_path())
    for i, (text, kind) in enumerate(texts):
        limit, overlap = (50, 10) if kind == "SPC" else (30, 0)
        if not text or t.count(text) <= limit:
            assert i not in got
            continue
        done = ""
        for k, r in enumerate(got[i]):
            assert r["n_tokens"] <= limit and t.count(r["piece"]) <= limit and r["piece"] == text[r["first_char"] : r["end_char"]]
            assert k == 0 or r["shared_tokens"] >= overlap and (r["shared_tokens"] == overlap or not text.isascii())
            done = done[: r["first_char"]] + r["piece"]
        assert done == text


def test_cuts_prefer_natural_boundaries(spark):
    text = "\n\n".join(" ".join(prose(k, 20)).capitalize() + "." for k in range(10))
    assert {r["cut"] for r in pieces(spark, [(text, "SPC")])[0]} == {"paragraph", "end"}
    assert {r["cut"] for r in pieces(spark, [(" ".join(WORDS * 10), "SPC")])[0]} == {"word", "end"}


def test_dynamic_programming_is_optimal():
    import itertools

    import numpy as np

    rng = np.random.default_rng(2)
    for _ in range(20):
        kind = rng.choice([0, 1, 2], 15)
        limit, overlap = 6, 1
        ends = splitting.split_positions(kind, limit, overlap)
        n = len(kind) - 1
        even = (n - overlap) / np.ceil((n - overlap) / (limit - overlap))

        def cost(cuts, even=even, n=n, kind=kind):
            total, last = 0.0, 0
            for c in cuts:
                fresh = c - last
                if fresh > (limit if last == 0 else limit - overlap):
                    return np.inf
                total += splitting.IMBALANCE * ((fresh - even) / limit) ** 2 + splitting.PIECE + (0 if c == n else splitting.PENALTY[kind[c]])
                last = c
            return total

        best = min(cost([*c, n]) for k in range(n) for c in itertools.combinations(range(1, n), k))
        assert cost(ends) == pytest.approx(best)


def test_no_boundary_that_was_ruled_out_is_better():
    """The cost over all boundaries of every kind is reached, on texts with few and with many natural ones."""
    import numpy as np

    rng = np.random.default_rng(0)
    for t in range(60):
        n, limit = int(rng.integers(50, 1200)), int(rng.integers(20, 200))
        overlap = int(rng.integers(0, limit // 3)) if t % 3 else 0
        kind = np.full(n + 1, 5)
        for k, share in ((4, 0.7), (3, 0.06), (2, rng.choice([0.01, 0.05, 0.1])), (1, 0.01), (0, 0.005)):
            kind[rng.random(n + 1) < share] = k
        if n > limit:
            ends = splitting.split_positions(kind, limit, overlap)
            cost = lambda places: splitting._cheapest(kind, places, limit, overlap, limit - overlap)[0]
            assert cost(np.array([0, *ends])) == pytest.approx(cost(np.arange(n + 1)))


def test_splitting_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, doc_type string")
    assert splitting.pieces(docs, spark.createDataFrame([("other", 5, 0, "")], LIMITS)).count() == 0


# ---- mixing


def test_plan_routes_overlapping_patterns():
    total, given = mixing.plan({("a",): 100, ("a", "b"): 100, ("b",): 50}, {"a": (0.5, 1), "b": (0.5, 2), "none": (0.1, 3)}, 300)
    drawn = {s: sum(n for shares in given.values() for x, n in shares if x == s) for s in ("a", "b", "none")}
    assert total == 300 and drawn == {"a": 150, "b": 150, "none": 0}


def corpus(spark, n=400):
    rng = random.Random(9)
    rows = []
    for i in range(n):
        source = "big" if i % 3 else rng.choice(["small", " SMALL ", "mid"])
        rows.append((i, " ".join(prose(i, rng.randrange(5, 60))), source, 0))
    rows += [(1000 + i, rows[i][1], "mid", 0) for i in range(40)]  # copies under another source
    return spark.createDataFrame(rows + [(2000, None, "big", 0), (2001, "", "big", 0), (2002, "stray", None, 0)], "doc_id long, text string, source string, times int")


TARGETS = "source string, target_share double, max_repeats int"


def test_mixture_meets_its_shares(spark):
    targets = spark.createDataFrame([("big", 0.4, 1), ("small", 0.3, 4), ("Mid ", 0.25, 3), ("absent", 0.05, 2)], TARGETS)
    documents = corpus(spark)
    shares = {r["source"]: r for r in mixing.shares(documents, targets).collect()}
    assert set(shares) == {"big", "small", "mid", "absent"} and shares["absent"]["drawn_tokens"] == 0
    for s in ("big", "small", "mid"):
        assert shares[s]["most_uses"] <= shares[s]["max_repeats"]
        assert shares[s]["actual_share"] == pytest.approx(shares[s]["target_share"] / 0.95, abs=0.02)
    drawn = mixing.mixture(documents, targets)
    assert sorted(map(tuple, drawn.collect())) == sorted(map(tuple, mixing.mixture(documents, targets).collect()))
    assert drawn.where("doc_id >= 2000").count() == 0 and drawn.groupBy("doc_id").agg(F.sum("times").alias("n")).where("n > 4").count() == 0


def test_mixture_of_nothing(spark):
    targets = spark.createDataFrame([("big", 1.0, 1)], TARGETS)
    assert mixing.mixture(corpus(spark).limit(0), targets).count() == 0 and mixing.mixture(corpus(spark), targets.limit(0)).count() == 0
    assert [r["actual_share"] for r in mixing.shares(corpus(spark).limit(0), targets).collect()] == [0.0]


@pytest.fixture
def no_vocabulary(monkeypatch):
    monkeypatch.delenv("QUILLSTONE_TOKENIZER", raising=False)
    monkeypatch.setattr(tokens, "VOCABULARY", "absent.tiktoken")
    return monkeypatch


def test_no_mixture_without_a_vocabulary(spark, no_vocabulary):
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.5, 4)], TARGETS)
    documents = corpus(spark)
    for query in (mixing.mixture, mixing.shares):
        with pytest.raises(FileNotFoundError, match="absent.tiktoken"):
            query(documents, targets)
    no_vocabulary.setenv("QUILLSTONE_TOKENIZER", tokens.CHARACTERS)  # asked for by name
    asked = mixing.mixture(documents, targets).join(documents.select("doc_id", "text"), "doc_id").collect()
    assert asked and all(r["n_tokens"] == max(1, len(r["text"]) // 4) for r in asked)


def test_no_pieces_without_a_vocabulary(spark, no_vocabulary):
    texts = [(" ".join(prose(3, 300)), "SPC"), ("short.", "SPC")]
    with pytest.raises(FileNotFoundError, match="absent.tiktoken"):
        pieces(spark, texts)
    no_vocabulary.setenv("QUILLSTONE_TOKENIZER", tokens.CHARACTERS)  # asked for by name
    got = pieces(spark, texts)
    assert set(got) == {0} and all(r["n_tokens"] == len(r["piece"]) // 4 <= 50 for r in got[0])

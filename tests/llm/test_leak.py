import random

import numpy as np
import pytest

from curatrix.llm import leak

WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "tu", "re", "so") for b in ("ban", "del", "fis", "gor", "hum", "jat", "kel", "lim")]


def passage(r, n):
    return " ".join(r.choice(WORDS) for _ in range(n))


def altered(r, words, every):
    out = []
    for k, w in enumerate(words):
        if k % every == every - 1:
            out += r.choice([[], [w, "extra"], ["other"]])
        else:
            out.append(w)
    return out


@pytest.fixture(scope="module")
def data():
    r = random.Random(8)
    items = [(i, passage(r, r.randint(60, 130))) for i in range(60)]
    docs, want = [], set()
    for d in range(300):
        text = passage(r, r.randint(0, 400)).split()
        if d % 2:
            i, t = r.choice(items)
            w = t.split()
            if d % 10 == 1:
                part = w[: len(w) // 5]  # too little
            else:
                n = int(len(w) * r.choice([0.45, 0.7, 1.0]))
                a = r.randint(0, len(w) - n)
                part = w[a : a + n] if d % 4 == 1 else altered(r, w[a : a + n], 9)
                want.add((d, i))
            at = r.randint(0, len(text))
            text = text[:at] + part + text[at:]
        docs.append((d, " ".join(text)))
    return docs, items, want


def test_finds_all_and_nothing_else(spark, data):
    docs, items, want = data
    d, i = spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string")
    d = d.withColumnRenamed("text", "t").selectExpr("doc_id", "t as text", "'clash' as item_id", "1 as reproduced_share")
    got = {(r["doc_id"], r["item_id"]) for r in leak.leaks(d, i).collect()}
    assert got == want
    assert {(r["doc_id"], r["item_id"]) for r in leak.leaks(d, i, block_items=20, blocks_a_pass=2).collect()} == want


def test_spelling_makes_no_difference(spark, data):
    _, items, _ = data
    words = items[0][1].split()
    loud = "<p>" + " ".join(w.upper().replace("A", "Á") + ("," if k % 3 else "\n\n- ") for k, w in enumerate(words)) + "</p>"
    wide = "".join(chr(ord(c) + 0xFEE0) if c != " " else "　" for c in items[1][1])
    hidden = items[2][1].replace("a", "a​")
    docs = [(1, loud), (2, wide), (3, hidden), (4, None), (5, ""), (6, " \n"), (7, items[3][1] * 1 + " " + passage(random.Random(1), 60_000)), (1, loud)]
    found = leak.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([*items, (900, items[0][1]), (901, None), (902, "too short")], "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(1, 0), (1, 0), (1, 900), (1, 900), (2, 1), (3, 2), (7, 3)]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert leak.leaks(empty, spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert leak.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_alignment_and_subsequence():
    r = random.Random(2)
    for _ in range(30):
        a, b = ([r.randint(0, 6) for _ in range(r.randint(1, 20))] for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        item = np.array(b, np.uint64)
        assert leak.in_order(a, leak.word_masks(item), len(b)) == table[-1, -1]
        assert leak.reproduced(np.array(a, np.uint64), item)[0] <= table[-1, -1]
    same = np.arange(50, dtype=np.uint64)
    assert leak.reproduced(same, same) == (50, 0)
    assert leak.reproduced(np.delete(same, [7, 20, 33]), same) == (47, 3)


def test_words():
    assert leak.plain_words("Ünï-code <b>Straße</b> &amp; ﬁn_x") == [b"uni", b"code", b"strasse", b"fin", b"x"]
    assert leak.plain_words("a < b > c") == [b"a", b"b", b"c"]
    assert leak.plain_words(None) == []


@pytest.mark.parametrize("even", [True, False])
def test_recall_at_the_limit(even):
    """Two fifths of an item with one word in eight changed, evenly spread or anywhere; and just a quarter, which is no leak."""
    r = random.Random(21)
    words = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(r.choices(words, k=r.randint(60, 220)))) for i in range(120)]
    index = leak.ItemIndex(items)
    texts, want = [], set()
    for d in range(800):
        i = r.randrange(len(items))
        w = items[i][1].split()
        n = -(-2 * len(w) // 5) if d % 4 else len(w) // 4
        a = r.randint(0, len(w) - n)
        part = w[a : a + n]
        if d % 4:
            at = set(range(r.randrange(8), n, 8)) if even else set(r.sample(range(n), n // 8))
            part = [x for k, v in enumerate(part) for x in (r.choice([[], [v, "zz"], ["yy"]]) if k in at else [v])]
            want.add((d, i))
        texts.append(" ".join(r.choices(words, k=r.randint(0, 300)) + part + r.choices(words, k=r.randint(0, 300))))
    got = {(d, i) for d, i, _, _ in index.search(leak.Texts(texts))}
    assert got <= want
    assert len(got) >= (1 if even else 0.99) * len(want)
    hashed = [np.array([leak._HASHES[x] for x in leak.plain_words(t)], np.uint64) for t in texts]
    for d, i in want:  # MinHash alone loses none
        s = leak.shingle_hashes(hashed[d])
        blocks = np.arange(0, len(s), leak.BLOCK)
        assert i in index.candidates(s, blocks, np.zeros(len(blocks), int))


def test_items_shorter_than_a_shingle(spark):
    items = spark.createDataFrame([("a", "Red gate!"), ("b", "red"), ("c", "gate red"), ("d", ""), ("e", None), ("f", "RED, gate")], "item_id string, text string")
    docs = spark.createDataFrame([(1, "the red\n gate of the yard"), (2, "a gate, red"), (3, None), (4, "nothing")], "doc_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in leak.leaks(docs, items).collect()} == {(1, "a"), (1, "b"), (1, "f"), (2, "b"), (2, "c")}
    assert leak.leaks(docs.where("false"), items).count() == 0 and leak.leaks(docs, items.where("false")).count() == 0


def test_text_with_a_quarter_of_its_words_changed_is_no_leak():
    r = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(r.choices(words, k=r.randint(60, 220)))) for i in range(40)]
    index, texts, true = leak.ItemIndex(items), [], []
    for d in range(400):
        i = r.randrange(len(items))
        w = items[i][1].split()
        every = 3 if d % 2 else 9
        texts.append(" ".join("zz" if k % every == every - 1 else x for k, x in enumerate(w)))
        true += [(d, i)] * (every == 9)
    assert {(d, i) for d, i, _, _ in index.search(leak.Texts(texts))} == set(true)
    w = np.arange(10, 40, dtype=np.uint64)
    assert leak.reproduced(w, w) == (30, 0)
    assert leak.reproduced(np.delete(w, 15), w) == (29, 1)
    changed = w.copy()
    changed[2::3] = 1
    assert leak.faithful(changed, w) <= 4

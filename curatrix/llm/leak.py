"""Problem 5: held-out passages that stand, in whole or in part, in a corpus.

Containment search by MinHash. A leaked stretch of two fifths of an item holds at least
one whole fifth of it, so each item is cut into ``SEGMENTS`` pieces; the pieces are
partitioned by size, and each size class looks for them in windows of the documents of
its own length, which keeps the Jaccard similarity of a piece and its window high however
long the document is. Pieces and windows that agree in at least ``AGREE`` of ``HASHES``
MinHash values make a candidate (document, item). Candidates are verified: exact
containment of the item's word shingles near one diagonal, then the exact number of
words that one stretch reproduces in order.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHINGLE, SEGMENTS, HASHES, AGREE = 5, 5, 48, 2
BLOCK = 8  # shingles; the smallest window has two blocks
EDIT_PRICE = 2  # words of reproduced text that one changed, dropped or added word outweighs
ALTERED, STRICT_PRICE = 0.2, 6  # a stretch of which more is changed counts only with the part that a strict price leaves
REPRODUCED = 0.3  # of an item's words: leaks reach two fifths before changes, others a quarter at most
NET = 0.1  # of an item's words: those a stretch's shared shingles cover, less the words of the stretch that they pass over
MARGIN = 0.25  # of an item's words: around the shared shingles the alignment may use so many, as changes in a row leave none
SLICE_WORDS = 50_000

_TAG = re.compile(r"</?[a-zA-Z!][^<>]*>")
_INVISIBLE = re.compile("[̀-ͯ­͏؜ᅟᅠ឴឵᠋-᠎​-‏‪-‮⁠-⁯︀-️︠-︯﻿]")
_WORD = re.compile(r"[^\W_]+")
_ASCII = bytes(c if chr(c).isalnum() and c < 128 else 32 for c in range(256))


def plain_words(text: str | None) -> list[bytes]:
    """The words of a text without case, accents, punctuation, layout, markup, invisible and compatibility characters."""
    if not text:
        return []
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    if text.isascii():
        return text.lower().encode().translate(_ASCII).split()
    text = _INVISIBLE.sub("", unicodedata.normalize("NFKD", text)).casefold()
    if text.isascii():
        return text.encode().translate(_ASCII).split()
    return [w.encode() for w in _WORD.findall(text)]


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 2_000_000:  # forget rather than grow; a hash is the same when made again
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return x


def shingle_hashes(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hash of each ``size`` words in a row; one less than ``size`` fewer than the words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out += words[k : k + n]
    return _mix(out)


def multipliers(hashes: int = HASHES, seed: int = 11) -> np.ndarray:
    """Odd factors of the hash functions x -> factor * x modulo 2^32 over the shingles' hashes."""
    return np.array([xxhash.xxh32_intdigest(f"{seed}:{j}".encode()) | 1 for j in range(hashes)], np.uint32)


def _top(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(32)).astype(np.uint32)


class _Lookup:
    """Positions of values in a sorted array of distinct values, behind a bitmap of their top bits."""

    def __init__(self, values: np.ndarray, bits: int) -> None:
        self.values = np.unique(values)
        self.shift = values.dtype.type(8 * values.dtype.itemsize - bits)
        self.seen = np.zeros(1 << bits, bool)
        self.seen[(self.values >> self.shift).astype(np.int64)] = True

    def find(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which places of ``x`` hold a known value, and where that value stands."""
        at = np.flatnonzero(self.seen[(x >> self.shift).astype(np.int64)])
        if not len(at) or not len(self.values):
            return at[:0], at[:0]
        where = np.minimum(np.searchsorted(self.values, x[at]), len(self.values) - 1)
        good = self.values[where] == x[at]
        return at[good], where[good]


def _expand(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which range, place) for every place of the ranges start .. end."""
    n = ends - starts
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts, n)


class Texts:
    """Some texts as hashes of their words and shingles, made once and searched by any number of indexes."""

    def __init__(self, texts: list[str | None]) -> None:
        words, ends, total = [], [0], 0
        for t in texts:
            w = plain_words(t)
            words += map(_HASHES.__getitem__, w)
            total += len(w)
            ends.append(total)
        self.number = len(texts)
        self.ends = np.array(ends)
        self.words = np.fromiter(words, np.uint64, total)
        counts = np.maximum(np.diff(self.ends) - SHINGLE + 1, 0)
        _, places = _expand(self.ends[:-1], self.ends[:-1] + counts)
        self.shingles = shingle_hashes(self.words)[places]
        self.doc_of = np.repeat(np.arange(self.number), counts)
        begin = np.cumsum(counts) - counts  # first shingle of each text
        self.in_doc = np.arange(len(self.shingles)) - begin[self.doc_of]
        self.blocks = np.flatnonzero(self.in_doc % BLOCK == 0)


class ItemIndex:
    """MinHash signatures of the items' segments by size class, and the postings of their shingles."""

    def __init__(self, items: list[tuple[object, str]]) -> None:
        hashes = _WordHashes()
        kept = [(i, np.array([hashes[w] for w in plain_words(t)], np.uint64)) for i, t in items]
        self.short: dict[int, tuple[np.ndarray, list[list[object]]]] = {}  # items of fewer words than a shingle, by length: sorted hashes and their items
        for n in range(1, SHINGLE):
            found: dict[int, list[object]] = {}
            for i, w in kept:
                if len(w) == n:
                    found.setdefault(int(shingle_hashes(w, n)[0]), []).append(i)
            if found:
                keys = sorted(found)
                self.short[n] = np.array(keys, np.uint64), [found[x] for x in keys]
        kept = [(i, w) for i, w in kept if len(w) >= SHINGLE]
        self.ids = [i for i, _ in kept]
        self.words = [w for _, w in kept]
        self.masks = [word_masks(w) for w in self.words]
        self.factors = multipliers()
        segments: dict[int, list[tuple[int, np.ndarray]]] = {}
        shingles, item, place = [], [], []
        for k, w in enumerate(self.words):
            s = shingle_hashes(w)
            shingles.append(s)
            item.append(np.full(len(s), k))
            place.append(np.arange(len(s)))
            cuts = np.linspace(0, len(s), SEGMENTS + 1).round().astype(int) if len(s) >= 2 * SEGMENTS else np.array([0, len(s)])
            for a, b in zip(cuts, cuts[1:]):
                size = max(2 * BLOCK, 1 << int(b - a - 1).bit_length())
                segments.setdefault(size, []).append((k, s[a:b]))
        self.classes = {}
        for size, rows in segments.items():
            owner = np.array([k for k, _ in rows])
            tables = []
            for f in self.factors:
                least = np.array([(_top(s) * f).min() for _, s in rows], np.uint32)
                order = np.argsort(least, kind="stable")
                look = _Lookup(least, 17)
                first = np.searchsorted(least[order], look.values)
                tables.append((look, np.append(first, len(order)), order.astype(np.int64)))
            self.classes[size] = (owner, tables)
        if not kept:
            self.look = _Lookup(np.empty(0, np.uint64), 4)
            return
        shingles, item, place = map(np.concatenate, (shingles, item, place))
        order = np.argsort(shingles, kind="stable")
        self.look = _Lookup(shingles, 20)
        self.first = np.append(np.searchsorted(shingles[order], self.look.values), len(order))
        self.item, self.place = item[order], place[order]

    def candidates(self, shingles: np.ndarray, blocks: np.ndarray, doc_of_block: np.ndarray) -> np.ndarray:
        """Distinct ``doc * items + item`` for which a segment and a window agree in ``AGREE`` MinHash values.

        ``blocks`` has the first shingle of each block of at most ``BLOCK`` shingles of
        one document. The windows of a class have two blocks of half its size, every
        block beginning one, so any stretch of half a window lies whole in a window.
        """
        # column b has the shingles of block b; short blocks repeat their first shingle
        ends = np.append(blocks[1:], len(shingles))
        spots = blocks + np.arange(BLOCK)[:, None]
        cells = _top(shingles)[np.where(spots < ends, spots, blocks)]
        levels, size, docs = [], BLOCK, doc_of_block
        while size <= max(self.classes, default=0) // 2:
            same = docs[1:] == docs[:-1]
            start = np.flatnonzero(np.append(True, ~same))
            lengths = np.diff(np.append(start, len(docs)))
            even = np.flatnonzero((np.arange(len(docs)) - np.repeat(start, lengths)) % 2 == 0)
            levels.append((2 * size, docs, np.where(np.append(same, False), np.arange(1, len(docs) + 1), np.arange(len(docs))), even))
            docs, size = docs[even], 2 * size
        hits: dict[int, list[np.ndarray]] = {size: [] for size in self.classes}
        for j, f in enumerate(self.factors):
            least = (cells * f).min(axis=0)
            for size, _, following, even in levels:
                window = np.minimum(least, least[following])
                if size in self.classes:
                    look, first, order = self.classes[size][1][j]
                    at, where = look.find(window)
                    which, spot = _expand(first[where], first[where + 1])
                    hits[size].append(at[which] << 32 | order[spot])
                least = window[even]
        out = []
        for size, docs, _, _ in levels:
            if hits.get(size):
                keys, n = np.unique(np.concatenate(hits[size]), return_counts=True)
                keys = keys[n >= AGREE]
                out.append(docs[keys >> 32] * len(self.ids) + self.classes[size][0][keys & 0xFFFFFFFF])
        return np.unique(np.concatenate(out)) if out else np.empty(0, np.int64)

    def search_short(self, texts: Texts) -> Iterator[tuple[int, object]]:
        """(number of the text, item) where all words of an item that is shorter than a shingle stand in a row."""
        for d in range(texts.number if self.short else 0):
            words = texts.words[texts.ends[d] : texts.ends[d + 1]]
            for n, (keys, items) in self.short.items():
                here = np.unique(shingle_hashes(words, n))
                for k in np.flatnonzero(np.isin(keys, here)):
                    yield from ((d, i) for i in items[k])

    def search(self, texts: Texts) -> Iterator[tuple[int, int, int, float]]:
        """(number of the text, number of the item, shared shingles, reproduced share) of each leak."""
        if not self.ids or not len(texts.shingles):
            return
        flat, ends, shingles, doc_of, in_doc, blocks = texts.words, texts.ends, texts.shingles, texts.doc_of, texts.in_doc, texts.blocks
        wanted = self.candidates(shingles, blocks, doc_of[blocks])
        if not len(wanted):
            return
        # only documents that MinHash proposes are looked up, and of them only the items it proposes
        proposed = np.zeros(texts.number, bool)
        proposed[wanted // len(self.ids)] = True
        open_at = np.flatnonzero(proposed[doc_of])
        at, where = self.look.find(shingles[open_at])
        at = open_at[at]
        which, spot = _expand(self.first[where], self.first[where + 1])
        doc, p = doc_of[at[which]], in_doc[at[which]]
        item, q = self.item[spot], self.place[spot]
        pair = doc.astype(np.int64) * len(self.ids) + item
        keep = np.isin(pair, wanted)
        pair, p, q = pair[keep], p[keep], q[keep]
        size = np.array([len(w) for w in self.words])
        stretches: dict[int, list[tuple[int, int, int, int]]] = {}
        for shift in (0, 32):  # bands of 64 diagonals, twice, so that a stretch lies whole in one
            band = (p - q + shift) >> 6
            order = np.lexsort((p, band, pair))
            a, b, c, d = pair[order], band[order], q[order], p[order]
            if not len(a):
                return
            new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
            step, ahead = np.clip(np.diff(c), 0, SHINGLE), np.diff(d)
            gain = np.append(0, step - np.maximum(ahead - step, 0))  # words covered, less those passed over
            gain[new] = 0
            group = np.cumsum(new) - 1
            height = np.cumsum(gain) - group * np.int64(1 << 40)  # later groups lie deeper, so a running minimum starts anew
            lowest = np.minimum.accumulate(height)
            since = np.maximum.accumulate(np.where(height == lowest, np.arange(len(height)), 0))
            net = height - lowest + SHINGLE
            start = np.flatnonzero(new)
            top = np.maximum.reduceat(net, start)
            for g in np.flatnonzero(top >= NET * size[a[start] % len(self.ids)]):
                x, y = start[g], start[g + 1] if g + 1 < len(start) else len(net)
                end = x + int(net[x:y].argmax())
                first = since[end]
                cover = int(np.append(0, step)[first + 1 : end + 1].sum()) + SHINGLE
                stretches.setdefault(int(a[x]), []).append((int(top[g]), cover, len(np.unique(c[first : end + 1])), int(d[first]), int(d[end])))
        for key, found in stretches.items():
            doc, item = divmod(key, len(self.ids))
            words, share, most = self.words[item], 0.0, 0
            margin = int(MARGIN * len(words))
            for net, cover, n, lo, hi in sorted(set(found), reverse=True):
                if share >= REPRODUCED:
                    break
                stretch = flat[ends[doc] + max(0, lo - margin) : min(ends[doc + 1], ends[doc] + hi + SHINGLE + margin)]
                kept = in_order(stretch.tolist(), self.masks[item], len(words))
                if kept < REPRODUCED * len(words):  # an upper bound of what an alignment can reproduce
                    continue
                # shared shingles alone may show enough, with few words passed over; else align
                shown = cover >= 1.3 * REPRODUCED * len(words) and cover - net <= cover / 4
                share, most = max(share, (kept if shown else faithful(stretch, words)) / len(words)), max(most, n)
            if share >= REPRODUCED:
                yield doc, item, most, share


def word_masks(words: np.ndarray) -> dict[int, int]:
    """For each word of an item the set of its places, as bits."""
    out: dict[int, int] = {}
    for k, w in enumerate(words.tolist()):
        out[w] = out.get(w, 0) | 1 << k
    return out


def in_order(stretch: list[int], masks: dict[int, int], n: int) -> int:
    """Length of the longest common subsequence, by whole rows of bits."""
    row = full = (1 << n) - 1
    for w in stretch:
        if m := masks.get(w):
            u = row & m
            row = (row + u | row - u) & full
    return n - row.bit_count()


def faithful(stretch: np.ndarray, item: np.ndarray) -> int:
    """Words of ``item`` that a stretch reproduces in order with few words changed: at most ``ALTERED`` of it, else what ``STRICT_PRICE`` leaves."""
    words, changes = reproduced(stretch, item)
    return words if changes <= ALTERED * (words + changes) else reproduced(stretch, item, STRICT_PRICE)[0]


def reproduced(stretch: np.ndarray, item: np.ndarray, price: int = EDIT_PRICE) -> tuple[int, int]:
    """(words of ``item`` that the best local alignment with ``stretch`` reproduces in order, words changed in it).

    A reproduced word counts 1, each changed, dropped or added word costs ``price``.
    Score and words are carried in one number, the score in the high part.
    """
    unit, cost = 1 << 20, price
    price = price << 20
    ramp = np.arange(len(stretch) + 1, dtype=np.int64) * price
    row = np.zeros(len(stretch) + 1, np.int64)
    best = 0
    for word in item:
        step = np.where(stretch == word, unit + 1, -price)
        new = np.maximum(row - price, 0)
        new[1:] = np.maximum(new[1:], row[:-1] + step)
        new = np.maximum.accumulate(new + ramp) - ramp
        new[new < unit] = 0
        row = new
        best = max(best, int(row.max()))
    words = best & (unit - 1)
    return words, (words - (best >> 20)) // cost


def _slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``SLICE_WORDS`` words at most (six characters each), so that memory doesn't follow the batch."""
    a, chars = 0, 0
    for b, t in enumerate(texts):
        chars += len(t or "")
        if chars > 6 * SLICE_WORDS:
            yield a, b + 1
            a, chars = b + 1, 0
    if a < len(texts):
        yield a, len(texts)


def leaks(documents: DataFrame, items: DataFrame, block_items: int = 20_000, blocks_a_pass: int = 8) -> DataFrame:
    """Columns ``doc_id, item_id, shared_shingles, reproduced_share``: each document with each item it leaks.

    ``documents(doc_id, text)`` and ``items(item_id, text)``; other columns are ignored.
    Null and blank texts leak nothing; an item of fewer than five words leaks where all of
    them stand in a row. Equal items under two ids are two cases, and so are documents
    repeated under one id. Texts are read whole, whatever their length.

    The items are the stated query set: they are indexed and sent to the executors in
    blocks of at most about ``block_items`` (some 40 MB each). A pass over the documents
    serves ``blocks_a_pass`` of them, hashing the texts once for all; the documents are not
    shuffled, and exploding their windows for a join with the items would move far more
    than a further pass reads.
    """
    spark = documents.sparkSession
    rows = items.select("item_id", "text").where("item_id is not null and text is not null")
    blocks = max(1, -(-rows.count() // block_items))
    kind = dict(rows.dtypes)["item_id"]
    doc_kind = dict(documents.dtypes)["doc_id"]
    out = None
    for first in range(0, blocks, blocks_a_pass):
        held = []
        for k in range(first, min(blocks, first + blocks_a_pass)):
            part = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k)
            held.append(spark.sparkContext.broadcast(ItemIndex(sorted((r[0], r[1]) for r in part.collect()))))

        def scan(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            indexes = [b.value for b in held]
            some = [i for x in indexes for i in (x.ids[:1] or [y for _, items in x.short.values() for y in items[0]][:1])][:1]
            item_type = pa.array(some).type if some else pa.int64()
            for batch in batches:
                texts, hits = batch.column(1).to_pylist(), []
                for a, b in _slices(texts):
                    own = Texts(texts[a:b])
                    for index in indexes:
                        hits += [(a + d, index.ids[i], n, s) for d, i, n, s in index.search(own)]
                        hits += [(a + d, i, 0, 1.0) for d, i in index.search_short(own)]
                if hits:
                    d, i, n, s = zip(*hits)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(d)), pa.array(i, item_type), pa.array(n, pa.int32()), pa.array(s, pa.float64())],
                        ["doc_id", "item_id", "shared_shingles", "reproduced_share"],
                    )

        one = documents.select("doc_id", "text").where("text is not null").mapInArrow(scan, f"doc_id {doc_kind}, item_id {kind}, shared_shingles int, reproduced_share double")
        out = one if out is None else out.unionByName(one)
    return out


def leak_report(found: DataFrame, items: DataFrame) -> DataFrame:
    """``eval_set, items, leaked_items, documents``: how many items of each set leaked, and into how many documents."""
    sets = items.select("item_id", F.coalesce("eval_set", F.lit("(missing)")).alias("eval_set"))
    per = found.select("doc_id", "item_id").join(sets, "item_id").groupBy("eval_set").agg(F.count_distinct("item_id").alias("leaked_items"), F.count_distinct("doc_id").alias("documents"))
    return sets.groupBy("eval_set").agg(F.count(F.lit(1)).alias("items")).join(per, "eval_set", "left").na.fill(0)

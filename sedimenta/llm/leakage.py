"""Evaluation passages in a corpus: template windows joined by hash, then slots and wording checked by alignment."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.characters import plain, words

#: Words of a window, of the shortest passage, and edits allowed in a passage of that length (one word in eight).
WINDOW, PASSAGE, EDITS = 5, 16, 2
#: A longer passage and its edits, in the same proportion.
LONG, LONG_EDITS = 24, 3
#: A sentence found in this many different evaluation texts is a stock sentence.
STOCK = 3
#: Up to this many evaluation words the index is broadcast; beyond, windows of both sides are joined by a shuffle, with the same rows as result.
BROADCAST_WORDS = 2_000_000
#: Most stock sentences and names, which are known to every task; they grow far slower than the evaluation set. Beyond, an error.
MOST_SHARED = 5_000_000
# Unit words, replaced by a placeholder.
UNITS = frozenset(
    "second seconds minute minutes hour hours day days week weeks month months year years percent fold degree degrees gram grams "
    "kilogram kilograms milligram milligrams kg mg g ml l mm cm m millibar millimolar milliosmoles micromolar litres liters units colony "
    "passages replicates generation cycles copies reads samples subjects".split()
)
NUMBER = re.compile(r"\d[\d]*[a-z]{0,7}\Z")
#: Multiplier of the window codes (odd, so that no word is lost).
STEP = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=500_000)
def code_of(part: str) -> int:
    """A 64-bit code, the same in every process."""
    return int.from_bytes(hashlib.blake2b(part.encode(), digest_size=8).digest(), "little", signed=True)


class Templates(dict):
    """The code of each word's template: numbers, units and names are typed placeholders. Each word is read once.

    The placeholder of a word does not depend on its neighbours, so words that agree have templates that agree.
    """

    def __init__(self, names: frozenset[str]):
        super().__init__()
        self.names = names

    def __missing__(self, word: str) -> int:
        if len(self) > 2_000_000:
            self.clear()
        self[word] = code = code_of(self.typed(word))
        return code

    def typed(self, word: str) -> str:
        return "<number>" if word[0] <= "9" and NUMBER.match(word) else "<unit>" if word in UNITS else "<name>" if word in self.names else word

    def codes(self, ws: list[str]) -> np.ndarray:
        return np.array([self[w] for w in ws], dtype=np.int64)


@dataclass
class Item:
    """An evaluation text: its words, the codes of their templates, and which words belong to stock sentences."""

    item_id: int
    words: list[str]
    typed: np.ndarray
    stock: np.ndarray


def name_words(text: str) -> tuple[set[str], set[str]]:
    """Words written with a capital inside sentences, and words in lower case."""
    inside = {plain(m[1]) for m in re.finditer(r"(?<=[a-z,;] )([A-Z][a-z]+)\b", text)}
    return inside, set(re.findall(r"\b[a-z]+\b", text))


def window_codes(typed: np.ndarray) -> np.ndarray:
    """One code per window of ``WINDOW`` template codes, in order."""
    n = len(typed) - WINDOW + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    u, code = typed.view(np.uint64), np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(WINDOW):
            code = code * STEP + u[k : k + n]
    return code.view(np.int64)


def sentences(text: str | None) -> list[list[str]]:
    """The words of each sentence."""
    return [ws for x in re.split(r"(?<=[a-z0-9)][.?!])\s+", text or "") if (ws := words(x))]


def text_key(text: str) -> int:
    """Equal for copies of one text: its words, digested."""
    return code_of(" ".join(words(text)))


def stock_and_names(items: DataFrame, text: str) -> tuple[frozenset[int], frozenset[str]]:
    """Codes of the stock sentences (in ``STOCK`` or more different texts, copies counted once) and the names (written with a capital inside
    sentences and never in lower case) of all items, counted where the items lie; only the stock sentences and names come to the driver."""

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for t in pdf["text"]:
                inside, lower = name_words(t)
                out += [("name", w, 0, 0) for w in inside] + [("lower", w, 0, 0) for w in lower]
                key = text_key(t)
                out += [("sentence", None, code_of(" ".join(ws)), key) for ws in sentences(t)]
            if out:
                yield pd.DataFrame(out, columns=["kind", "word", "sentence", "text_key"])

    found = items.select(F.col(text).alias("text")).where("text is not null").mapInPandas(parts, "kind string, word string, sentence long, text_key long").distinct()
    group = found.groupBy((F.col("kind") == "sentence").alias("whole"), "word", "sentence")
    counts = group.agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.col("kind") == "lower").alias("lower"))
    kept = counts.where(F.when(F.col("whole"), F.col("n") >= STOCK).otherwise(~F.col("lower"))).select("whole", "word", "sentence")
    rows = kept.limit(MOST_SHARED + 1).collect()
    if len(rows) > MOST_SHARED:
        raise ValueError(f"more than {MOST_SHARED} stock sentences and names")
    return frozenset(r.sentence for r in rows if r.whole), frozenset(r.word for r in rows if not r.whole)


def make_item(item_id: int, text: str | None, templates: Templates, stock: frozenset[int]) -> Item:
    """An item with its words of stock sentences marked."""
    ws = words(text)
    mark = np.array([code_of(" ".join(s)) in stock for s in sentences(text) for _ in s], dtype=bool)
    return Item(item_id, ws, templates.codes(ws), mark if len(mark) == len(ws) else np.zeros(len(ws), dtype=bool))


def item_windows(item: Item) -> tuple[np.ndarray, np.ndarray]:
    """(codes, places) of the windows of an item that hold other than stock words: a passage always holds such a window unbroken."""
    code = window_codes(item.typed)
    used = np.flatnonzero(np.convolve(~item.stock, np.ones(WINDOW, dtype=int), "valid") > 0) if len(code) else np.arange(0)
    return code[used], used


class Index:
    """The windows of all items, sorted by code, with a bit map in front."""

    def __init__(self, items: list[Item], names: frozenset[str]):
        self.items, self.names = items, names
        found = [item_windows(i) for i in items]
        code = np.concatenate([c for c, _ in found]) if found else np.empty(0, dtype=np.int64)
        order = np.argsort(code, kind="stable")
        self.codes = code[order]
        self.item_at = np.repeat(np.arange(len(items)), [len(c) for c, _ in found])[order] if found else np.empty(0, dtype=np.int64)
        self.place = np.concatenate([p for _, p in found])[order] if found else np.empty(0, dtype=np.int64)
        self.typed = np.concatenate([i.typed for i in items]) if items else np.empty(0, dtype=np.int64)
        self.begin = np.concatenate([[0], np.cumsum([len(i.typed) for i in items])]).astype(np.int64)
        self.mask = np.int64((1 << max(10, int(len(code) * 32).bit_length())) - 1)
        self.bits = np.zeros(int(self.mask) + 1, dtype=bool)
        self.bits[self.codes & self.mask] = True


def build_index(items: list[tuple[int, str]]) -> Index:
    """The index of items held in memory, their stock sentences and names counted among themselves."""
    texts = [t for _, t in items if t]
    different = {text_key(t): t for t in texts}
    seen = Counter(c for t in different.values() for c in {code_of(" ".join(ws)) for ws in sentences(t)})
    pairs = [name_words(t) for t in texts]
    names = frozenset(set().union(*[a for a, _ in pairs]) - set().union(*[b for _, b in pairs]))
    stock, templates = frozenset(c for c, n in seen.items() if n >= STOCK), Templates(names)
    return Index([make_item(i, t, templates, stock) for i, t in items], names)


def passage(item: list[str], doc: list[str], stock: np.ndarray | None = None, length: int = PASSAGE, edits: int = EDITS) -> bool:
    """Whether some ``length`` consecutive words of ``item`` stand in ``doc`` with at most ``edits`` words changed, dropped or inserted.

    The first and the last word of the passage must stand unchanged (a passage begins where the agreement begins). Words of stock
    sentences (``stock``) prove little: a passage with fewer than 8 other words does not count, and every 4 others beyond these 8 allow
    one edit. Dynamic programme over all windows of the item at once.
    """
    n, m = len(item) - length + 1, len(doc)
    if n <= 0 or m < length - edits:
        return False
    ids: dict[str, int] = {}
    a = np.array([ids.setdefault(w, len(ids)) for w in item])
    b = np.array([ids.setdefault(w, len(ids)) for w in doc])
    differ = (a[:, None] != b[None, :]).astype(np.int16)
    step = np.arange(m + 1, dtype=np.int16)
    row = np.full((n, m + 1), 99, dtype=np.int16)
    row[:, 1:] = np.where(differ[:n] == 0, 0, 99)
    for k in range(1, length):
        d = differ[k : k + n]
        new = np.full((n, m + 1), 99, dtype=np.int16)
        new[:, 1:] = row[:, :-1] + d if k < length - 1 else np.where(d == 0, row[:, :-1], 99)
        if k < length - 1:
            np.minimum(new, row + 1, out=new)
            new = np.minimum.accumulate(new - step, axis=1) + step
        row = new
        if row.min() > edits:
            return False
    own = np.full(n, length) if stock is None else np.convolve(~stock, np.ones(length, dtype=int), "valid")
    return bool((row.min(axis=1) <= np.minimum(edits, (own - 8) // 4)).any())


def near(item: np.ndarray, doc: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Which hits can belong to a passage.

    ``item`` and ``doc`` are the codes of all items and documents one after another; ``runs`` has per hit its first and last place in the
    item, its diagonal, and begin and end of the item and of the document. A passage of ``PASSAGE`` (``LONG``) words keeps all but
    ``EDITS`` (``LONG_EDITS``) of its words and leaves the diagonal of a hit in it by no more than its edits. So in some stretch of that
    length around the hit as many codes of the item must equal a code of the document within the wider band. This is necessary for a passage.
    """
    first, last, k, i0, i1, d0, d1 = runs.T
    lo, hi = np.maximum(0, first - LONG + WINDOW), np.minimum(i1 - i0, last + LONG)
    size = hi - lo
    begin = np.cumsum(size) - size
    run = np.repeat(np.arange(len(runs)), size)
    place = np.arange(size.sum()) - begin[run] + lo[run]
    want, equal = item[place + i0[run]], np.zeros(len(place), dtype=bool)
    at, low, high = place + k[run] + d0[run], d0[run], d1[run]
    for off in range(-LONG_EDITS, LONG_EDITS + 1):
        x = at + off
        inside = (x >= low) & (x < high)
        equal |= inside & (doc[np.where(inside, x, 0)] == want)
    total = np.concatenate([[0], np.cumsum(equal)])
    keep = np.zeros(len(runs), dtype=bool)
    for length, edits in ((PASSAGE, EDITS), (LONG, LONG_EDITS)):
        start = np.flatnonzero(np.arange(len(place)) + length <= (begin + size)[run])
        keep[run[start[total[start + length] - total[start] >= length - edits]]] = True
    return keep


def judge(item: Item, doc: list[str], runs: np.ndarray, templates: Templates) -> str | None:
    """``passage``, ``reparameterised`` or None for an item and a document with hits that ``near`` has kept (first and last place, diagonal)."""
    kind = None
    for first, last, k in runs[:, :3].tolist():
        lo, hi = max(0, first - LONG + WINDOW), min(len(item.words), last + LONG)
        x, y = max(0, lo + k - 2 * LONG_EDITS), max(0, hi + k + 2 * LONG_EDITS)
        part, text, stock = item.words[lo:hi], doc[x:y], item.stock[lo:hi]
        if passage(part, text, stock) or passage(part, text, stock, LONG, LONG_EDITS):
            return "passage"
        if kind is None and passage([templates.typed(w) for w in part], [templates.typed(w) for w in text], stock):
            kind = "reparameterised"
    return kind


def promising(pair: np.ndarray, diagonal: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """Which runs (sorted by pair of item and document, then diagonal) have two hits or more on neighbouring diagonals.

    A passage always has: 14 equal words in three runs, or 21 in four, hold two windows of five at least.
    """
    around = hits.copy()
    for k in range(1, min(2 * LONG_EDITS, len(hits) - 1) + 1):
        close = (pair[k:] == pair[:-k]) & (diagonal[k:] - diagonal[:-k] <= LONG_EDITS)
        around[:-k] += np.where(close, hits[k:], 0)
        around[k:] += np.where(close, hits[:-k], 0)
    return around >= 2


def search(texts: pd.Series, index: Index, templates: Templates | None = None) -> list[tuple[int, int, str]]:
    """(row, item, kind) for a batch of texts; kind is ``passage`` or ``reparameterised``.

    Windows of the batch are looked up in the sorted codes all at once; hits are merged by row, item and diagonal.
    """
    templates = Templates(index.names) if templates is None else templates
    lists = [words(t) for t in texts]
    length = np.array([len(ws) for ws in lists], dtype=np.int64)
    typed = np.fromiter(map(templates.__getitem__, chain.from_iterable(lists)), dtype=np.int64, count=int(length.sum()))
    code = window_codes(typed)
    ends = np.cumsum(length)
    begin = ends - length
    possible = index.bits[code & index.mask]
    for k in range(1, WINDOW):  # windows across the end of a text
        at = ends - k
        possible[at[(at >= 0) & (at < len(code))]] = False
    found = np.flatnonzero(possible)
    left = np.searchsorted(index.codes, code[found], "left")
    hit = left < len(index.codes)
    found, left = found[hit], left[hit]
    hit = index.codes[left] == code[found]
    found, left = found[hit], left[hit]
    if not len(found):
        return []
    count = np.searchsorted(index.codes, code[found], "right") - left
    entry = np.repeat(left, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = np.repeat(found, count)
    row = np.searchsorted(ends, at, "right")
    item, place = index.item_at[entry].astype(np.int64), index.place[entry].astype(np.int64)
    diagonal = at - begin[row] - place
    order = np.lexsort((place, diagonal, item, row))
    row, item, place, diagonal = row[order], item[order], place[order], diagonal[order]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(row) != 0) | (np.diff(item) != 0) | (np.diff(diagonal) != 0)]))
    last = np.concatenate([new[1:], [len(row)]]) - 1
    pair = np.cumsum(np.concatenate([[True], (np.diff(row[new]) != 0) | (np.diff(item[new]) != 0)]))
    some = promising(pair, diagonal[new], last - new + 1)
    new, last, pair = new[some], last[some], pair[some]
    r, i = row[new], item[new]
    runs = np.stack([place[new], place[last], diagonal[new], index.begin[i], index.begin[i + 1], begin[r], ends[r]], axis=1)
    some = near(index.typed, typed, runs) if len(runs) else np.zeros(0, dtype=bool)
    runs, r, i, pair = runs[some], r[some], i[some], pair[some]
    cuts = np.flatnonzero(np.diff(pair)) + 1 if len(pair) else pair
    result = []
    for a, b in zip([0, *cuts], [*cuts, len(pair)]):
        if b > a and (kind := judge(index.items[i[a]], lists[r[a]], runs[a:b], templates)):
            result.append((int(r[a]), int(i[a]), kind))
    return result


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str, text: str, item_id: str, item_text: str, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """(``doc_id``, ``item_id``, ``kind``): documents holding a passage of an evaluation item.

    Both sides are canonicalised to words and to templates (numbers, units and names replaced by typed placeholders). Windows of
    ``WINDOW`` template words are joined by hash. A passage of ``PASSAGE`` words with ``EDITS`` edits (or ``LONG`` with ``LONG_EDITS``) always
    holds two unbroken windows, so the join loses none. Joined pairs are aligned word by word: ``passage`` if the wording agrees
    with at most one edit in eight words, ``reparameterised`` if only the templates do (numbers, units or names differ too
    often), else nothing.

    Defined results: null, blank and short texts give nothing; a null document id is an id like any other, items without an id are left out;
    a document id and an item id come out once, with the stronger kind, however often either is repeated; an empty side gives no rows;
    other columns are dropped. Stock sentences and names are counted once over the different texts of all items, so the result does not
    change with copies of an item.

    Scale: evaluation sets of up to ``broadcast_words`` words are sent out as one sorted table of window codes and every document is read once
    where it lies, without an exchange. Larger ones are joined window by window through an exchange (``_by_exchange``); the rows are
    the same. Hot windows of that join are left to the planner's skew join.
    """
    key = F.col(doc_id).cast("long")  # null ids travel as a flag, for pandas would make all ids floats
    d = docs.select(F.coalesce(key, F.lit(0).cast("long")).alias("doc_id"), key.isNull().alias("no_id"), F.col(text).alias("text")).where("text is not null")
    i = items.where(F.col(item_id).isNotNull()).select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text")).where("text is not null").distinct()
    stock, names = stock_and_names(i, "text")
    total = i.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    found = _by_broadcast(d, i, stock, names) if total <= broadcast_words else _by_exchange(d, i, stock, names)
    best = found.groupBy("doc_id", "no_id", "item_id").agg(F.min("kind").alias("kind"))  # passage before reparameterised
    return best.select(F.when(~F.col("no_id"), F.col("doc_id")).alias(doc_id), F.col("item_id").alias(item_id), "kind")


def _by_broadcast(docs: DataFrame, items: DataFrame, stock: frozenset[int], names: frozenset[str]) -> DataFrame:
    templates = Templates(names)
    shared = docs.sparkSession.sparkContext.broadcast(Index([make_item(r[0], r[1], templates, stock) for r in items.collect()], names))

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = shared.value
        seen = Templates(index.names)
        for pdf in batches:
            got = search(pdf["text"], index, seen)
            if got:
                at = [r for r, _, _ in got]
                ids = np.array([index.items[i].item_id for _, i, _ in got], dtype=np.int64)
                yield pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy()[at], "no_id": pdf["no_id"].to_numpy()[at], "item_id": ids, "kind": [k for *_, k in got]})

    return docs.mapInPandas(probe, "doc_id long, no_id boolean, item_id long, kind string")


def _by_exchange(docs: DataFrame, items: DataFrame, stock: frozenset[int], names: frozenset[str]) -> DataFrame:
    """The same by a join of all windows on their codes, hits counted by pair and diagonal before texts are brought back to the pairs."""
    shared = docs.sparkSession.sparkContext.broadcast((stock, names))

    def windows(of_items: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            stock, names = shared.value
            templates = Templates(names)
            for pdf in batches:
                for key, t in zip(pdf["key"], pdf["text"]):
                    if of_items:
                        code, place = item_windows(make_item(0, t, templates, stock))
                    else:
                        code = window_codes(templates.codes(words(t)))
                        place = np.arange(len(code))
                    if len(code):
                        yield pd.DataFrame({"code": code, "key": np.full(len(code), key, dtype=np.int64), "place": place.astype(np.int32)})

        return run

    d = docs.select(F.xxhash64("doc_id", "no_id", "text").alias("key"), "doc_id", "no_id", "text")
    i = items.select(F.xxhash64("item_id", "text").alias("key"), "item_id", "text")
    dw = d.select("key", "text").mapInPandas(windows(False), "code long, key long, place int").selectExpr("code", "key as d_key", "place as d_place")
    iw = i.select("key", "text").mapInPandas(windows(True), "code long, key long, place int").selectExpr("code", "key as i_key", "place as i_place")
    hits = dw.join(iw, "code").groupBy("d_key", "i_key", (F.col("d_place") - F.col("i_place")).alias("diagonal"))
    runs = hits.agg(F.min("i_place").alias("first"), F.max("i_place").alias("last"), F.count_distinct("i_place").alias("n"))
    # At most as many diagonals as the two texts have words.
    pairs = runs.groupBy("d_key", "i_key").agg(F.array_sort(F.collect_list(F.array(F.col("diagonal"), "first", "last", F.col("n").cast("int")))).alias("runs"))
    j = pairs.where("size(runs) > 1 or runs[0][3] > 1").join(d.withColumnRenamed("key", "d_key"), "d_key")
    j = j.join(i.select(F.col("key").alias("i_key"), "item_id", F.col("text").alias("item_text")), "i_key")

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stock, names = shared.value
        templates = Templates(names)
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                part = np.array([list(x) for x in r.runs], dtype=np.int64)
                part = part[promising(np.zeros(len(part)), part[:, 0], part[:, 3])]
                if not len(part):
                    continue
                ws, item = words(r.text), make_item(r.item_id, r.item_text, templates, stock)
                ends = np.full(len(part), len(item.words)), np.zeros(len(part)), np.full(len(part), len(ws))
                runs = np.stack([part[:, 1], part[:, 2], part[:, 0], np.zeros(len(part)), *ends], axis=1).astype(np.int64)
                runs = runs[near(item.typed, templates.codes(ws), runs)]
                kind = judge(item, ws, runs, templates)
                if kind:
                    out.append((r.doc_id, r.no_id, r.item_id, kind))
            if out:
                yield pd.DataFrame(out, columns=["doc_id", "no_id", "item_id", "kind"])

    return j.select("doc_id", "no_id", "text", "item_id", "item_text", "runs").mapInPandas(align, "doc_id long, no_id boolean, item_id long, kind string")


def reparameterise(items: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """(``item_id``, ``text``, ``slots``): each item as the same question with other parameters.

    Every number, unit and name is replaced by another of its kind; ``slots`` counts them. For measuring what ``find_leaks`` recovers.
    """
    texts = items.where(F.col(item_id).isNotNull() & F.col(item_text).isNotNull()).select(F.col(item_id).cast("long").alias(item_id), F.col(item_text).alias("text"))
    _, names = stock_and_names(texts, "text")
    units = sorted(UNITS)
    others = {**dict(zip(units, [*units[1:], units[0]])), **dict(zip(sorted(names), [*sorted(names)[1:], *sorted(names)[:1]]))}

    def other(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            lists = [words(t) for t in pdf["text"]]
            new = [[re.sub(r"\d", lambda m: str((int(m[0]) + 3) % 10), w) if NUMBER.match(w) else others.get(w, w) for w in ws] for ws in lists]
            yield pd.DataFrame({item_id: pdf[item_id], "text": [" ".join(ws) for ws in new], "slots": [sum(a != b for a, b in zip(x, y)) for x, y in zip(lists, new)]})

    return texts.mapInPandas(other, f"{item_id} long, text string, slots int")

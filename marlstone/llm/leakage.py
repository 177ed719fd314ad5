"""Held-out items that leak into a corpus, by a positional inverted index.

The index holds every word of the corpus. It is cut into blocks of neighbouring documents, each small enough
for one task: a row per (block, term) lists the places of the term, counted through the block, and one row per block
says where each document begins. Texts are indexed in their consistent, case-folded form (see lookalike); words are
maximal runs of letters and digits. The index knows nothing of the items: it is stored once and
searched by any number of them, for phrases and for proximity.

A window of `length` words of an item is found by intersecting lists: that of its rarest term in the block, moved
back by the term's offset, with that of the second rarest, moved likewise, and what is left with the others, in
order of rarity. A window with a term that the block lacks is dropped by a look at the counts, and
windows that share their two rarest places share that intersection, so common
words bring up no candidates, however many documents hold them, unless a window has no others.

Only postings of the items' terms are read into a search, and only by block; no list grows with the corpus. Held-out items
are shipped to all tasks; a set of more than MOST_WORDS words is searched part by part.

Null and empty texts hold no words. Items of fewer than `length` words can't leak.
Rows of one key are searched text by text; equal rows count once. Of several items of one id each is searched.
"""

from __future__ import annotations

import re
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.lookalike import Normaliser
from marlstone.session import materialise, sized, spread

LENGTH = 12
WITHIN = 20
#: Words of a block.
BLOCK = 1 << 21
#: Words of the items of one search at most; more are searched in several.
MOST_WORDS = 5_000_000


class Words:
    """The words of a text, in their consistent, case-folded form."""

    def __init__(self):
        self._norm, self._find = Normaliser(), None

    def __getstate__(self):
        return {"_norm": self._norm, "_find": None}

    #: From this many characters on, words come one by one.
    LONG = 1 << 20

    def __call__(self, text: str | None) -> Iterable[str]:
        if not text:
            return []
        if self._find is None:
            self._find = re.compile(r"[^\W_]+")
        form = self._norm.form(text).casefold()
        return self._find.findall(form) if len(form) < self.LONG else (m[0] for m in self._find.finditer(form))


@dataclass
class Items:
    """Held-out items as numbers of their terms."""

    ids: list
    words: list[np.ndarray]
    terms: dict[str, int]
    kind: str

    @staticmethod
    def collect(df: DataFrame, key: str, text: str) -> Items:
        words, out = Words(), Items([], [], {}, dict(df.dtypes)[key])
        for k, t in df.select(key, text).where(F.col(key).isNotNull()).toLocalIterator():
            out.ids.append(k)
            out.words.append(np.array([out.terms.setdefault(w, len(out.terms)) for w in words(t)], dtype=np.int64))
        return out


def parts(df: DataFrame, key: str, text: str) -> list[DataFrame]:
    """The items in as many parts as the driver and the tasks can hold one after the other; a word has a character and a blank at least."""
    chars = df.agg(F.sum(F.length(text) + 1)).first()[0] or 0
    n = -(-chars // (2 * MOST_WORDS)) or 1
    return [df.where(F.pmod(F.xxhash64(key, text), F.lit(n)) == i) for i in range(n)]


def postings(docs: DataFrame, key: str, text: str, reach: int = max(LENGTH, WITHIN)) -> DataFrame:
    """The index: (block, term, places, docs, copies, froms).

    The row of a null term is the block's directory: document docs[i] (copies tells texts of one key apart) has its
    word froms[i] at places[i] of the block, and its further words after it. Documents lie `reach` places apart, so no phrase and
    no stretch of up to `reach` words runs from one into the next. A document that a block can't hold continues in the next one,
    repeating `reach` words.
    """
    kind, block, words = dict(docs.dtypes)[key], BLOCK, Words()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        vocabulary: defaultdict[str, int] = defaultdict()
        vocabulary.default_factory = vocabulary.__len__
        codes, places, directory, end = array("i"), array("i"), ([], [], [], []), 0

        def flush() -> pa.RecordBatch:
            nonlocal made, end
            number, where = np.frombuffer(codes, dtype=np.int32), np.frombuffer(places, dtype=np.int32)
            order = np.argsort(number, kind="stable")
            starts = np.concatenate([[0], np.cumsum(np.bincount(number, minlength=len(vocabulary)))])
            ids, copies, begins, froms = directory
            n = len(vocabulary)
            lists = pa.ListArray.from_arrays(pa.array(np.append(starts, starts[-1] + len(begins)), pa.int32()), pa.array(np.append(where[order], np.array(begins, dtype=np.int32)), pa.int32()))
            def only_last(values: list, of: pa.DataType) -> pa.Array:
                return pa.array([None] * n + [values], pa.list_(of))
            out = pa.RecordBatch.from_arrays(
                [pa.array(np.full(n + 1, (task << 32) + made), pa.int64()), pa.array([*vocabulary, None], pa.string()), lists, only_last(ids, id_type), only_last(copies, pa.int64()), only_last(froms, pa.int32())],
                ["block", "term", "places", "docs", "copies", "froms"],
            )
            vocabulary.clear()
            del number, where
            codes[:], places[:] = array("i"), array("i")
            for x in directory:
                x.clear()
            made, end = made + 1, 0
            return out

        id_type = None
        for batch in batches:
            id_type = batch.column(0).type
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for i, t in enumerate(texts):
                value = t.as_py()
                found = words(value)
                found = found if isinstance(found, list) else list(found)
                if not found:
                    continue
                copy = xxhash.xxh3_64_intdigest(value.encode("utf-8", "surrogatepass")) >> 1
                done = 0
                while True:
                    room = max(block - len(codes), reach + 1)
                    piece = found[done : done + room] if done or len(found) > room else found
                    for column, x in zip(directory, (ids[i], copy, end, done), strict=True):
                        column.append(x)
                    codes.extend([vocabulary[w] for w in piece])
                    places.extend(range(end, end + len(piece)))
                    end += len(piece) + reach
                    full, last = len(codes) >= block, done + len(piece) >= len(found)
                    if full:
                        yield flush()
                    if last:
                        break
                    done += len(piece) - reach
        if codes:
            yield flush()

    schema = f"block long, term string, places array<int>, docs array<{kind}>, copies array<long>, froms array<int>"
    return spread(docs.select(key, text).where(F.col(key).isNotNull())).mapInArrow(run, schema)


def _held(sorted_list: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which of the wanted are in the list."""
    at = np.searchsorted(sorted_list, wanted)
    at[at == len(sorted_list)] = 0
    return sorted_list[at] == wanted


class Block:
    """The postings of the items' terms in one block, by number of the term."""

    def __init__(self, table: pa.Table, terms: dict[str, int]):
        self.lists: dict[int, np.ndarray] = {}
        self.counts = np.zeros(len(terms), dtype=np.int64)
        table = table.combine_chunks()
        places = table.column("places").chunk(0)
        ends, values = places.offsets.to_numpy(), places.values.to_numpy(zero_copy_only=False)
        for row, term in enumerate(table.column("term").to_pylist()):
            held = values[ends[row] : ends[row + 1]].astype(np.int64)
            if term is not None:
                n = terms[term]
                self.lists[n], self.counts[n] = held, len(held)
            else:
                self.begins = held
                self.docs, self.copies, self.froms = (table.column(c)[row].as_py() for c in ("docs", "copies", "froms"))

    def document(self, place: int) -> tuple[int, int]:
        """(its place in the directory, the word's offset in the text)."""
        i = int(np.searchsorted(self.begins, place, side="right")) - 1
        return i, self.froms[i] + place - int(self.begins[i])

    def windows(self, seq: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
        """(s, where the item's word 0 would lie) of the windows seq[s:s+length] that occur."""
        if len(seq) < length:
            return
        counts = np.lib.stride_tricks.sliding_window_view(self.counts[seq], length)
        at = np.flatnonzero(counts.min(axis=1))
        if not len(at):
            return
        order = np.argsort(counts[at], axis=1, kind="stable") + at[:, None]
        rarest: dict[tuple[int, int], list[int]] = {}
        for row, pair in enumerate(zip(order[:, 0].tolist(), order[:, min(1, length - 1)].tolist(), strict=True)):
            rarest.setdefault(pair, []).append(row)
        for (a, b), rows in rarest.items():
            shifts = self.lists[seq[a]] - a
            shifts = shifts[_held(self.lists[seq[b]], shifts + b)]
            if not len(shifts):
                continue
            for row in rows:
                left = shifts
                for k in order[row, 2:].tolist():
                    left = left[_held(self.lists[seq[k]], left + k)]
                    if not len(left):
                        break
                else:
                    yield int(at[row]), left

    def runs(self, seq: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int]]:
        """(place in the directory, item_from, doc_from, words) of the longest runs."""
        by_shift: dict[int, list[int]] = {}
        for s, shifts in self.windows(seq, length):
            for shift in shifts.tolist():
                by_shift.setdefault(shift, []).append(s)
        for shift, starts in by_shift.items():
            starts.sort()
            first = before = starts[0]
            for s in [*starts[1:], None]:
                if s is None or s > before + 1:
                    i, offset = self.document(shift + first)
                    yield i, first, offset, before - first + length
                    first = s
                before = s

    def spans(self, terms: list[int], within: int) -> Iterator[tuple[int, int]]:
        """(place in the directory, span) of the smallest stretch that holds all terms, per document."""
        if any(t not in self.lists for t in terms):
            return
        starts = np.unique(np.concatenate([self.lists[t] for t in terms]))
        far = np.iinfo(np.int64).max // 2
        ends = np.max([np.append(self.lists[t], far)[np.searchsorted(self.lists[t], starts)] for t in terms], axis=0)
        good = ends - starts < within
        best: dict[int, int] = {}
        for p, e in zip(starts[good].tolist(), ends[good].tolist(), strict=True):
            i, _ = self.document(p)
            best[i] = min(best.get(i, far), e - p + 1)
        yield from best.items()


def _numbered(index: DataFrame, items: Items, column: str, values: list, kind: pa.DataType | None) -> DataFrame:
    """(item, column): a short list as a written frame."""
    table = pa.table({"item": pa.array(range(len(values)), pa.int64()), column: pa.array(values, kind)})
    return materialise(index.sparkSession.createDataFrame(table), column)


def _held_terms(index: DataFrame, items: Items) -> DataFrame:
    terms = _numbered(index, items, "term", list(items.terms), pa.string()).select("term")
    return index.join(sized(terms), "term", "left_semi")


def _search(index: DataFrame, items: Items, of: Callable[[Block], Iterator[tuple]], columns: str) -> DataFrame:
    """(doc, copy, name, columns...) of the rows (place in the directory, number of the item, long...) that `of` makes of each block."""
    kind = dict(index.dtypes)["docs"].removeprefix("array<").removesuffix(">")
    shipped = index.sparkSession.sparkContext.broadcast(items.terms)  # at most MOST_WORDS
    names = [c.split()[0] for c in columns.split(", ")]

    def run(table: pa.Table) -> pa.Table:
        block = Block(table, shipped.value)
        rows = list(of(block))
        ids = pa.array([block.docs[r[0]] for r in rows], table.schema.field("docs").type.value_type)
        rest = [pa.array([r[i] for r in rows], pa.int64()) for i in range(1, 2 + len(names))]
        return pa.table([ids, pa.array([block.copies[r[0]] for r in rows], pa.int64()), *rest], names=["doc", "copy", "item", *names])

    blocks = _held_terms(index, items).unionByName(index.where("term is null"))
    found = blocks.groupBy("block").applyInArrow(run, f"doc {kind}, copy long, item long, {columns}")
    called = _numbered(index, items, "name", items.ids, None).select("item", F.col("name").cast(items.kind).alias("name"))
    return found.join(sized(called), "item")


def phrase_matches(index: DataFrame, items: Items, length: int = LENGTH) -> DataFrame:
    """(doc, item, item_from, doc_from, words): every longest run of at least `length` words that an
    item and a document share in order and without a gap. Offsets count words from 0. The index must reach as far as `length`."""
    sequences = index.sparkSession.sparkContext.broadcast(items.words)

    def of(block: Block) -> Iterator[tuple]:
        for n, seq in enumerate(sequences.value):
            for i, item_from, doc_from, words in block.runs(seq, length):
                yield i, n, item_from, doc_from, words

    found = _search(index, items, of, "item_from long, doc_from long, words long")
    # runs of one diagonal that overlap, in two blocks, or touch are one
    diagonal = ["doc", "copy", "item", "name", F.col("doc_from") - F.col("item_from")]
    w = Window.partitionBy(*diagonal).orderBy("item_from", "words")
    end = F.max(F.col("item_from") + F.col("words") - length).over(w.rowsBetween(Window.unboundedPreceding, -1))
    found = found.withColumn("_new", F.when(F.col("item_from") <= end + 1, 0).otherwise(1))
    found = found.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = found.groupBy(*diagonal[:4], (F.col("doc_from") - F.col("item_from")).alias("shift"), "_run").agg(F.min("item_from").alias("item_from"), F.min("doc_from").alias("doc_from"), (F.max(F.col("item_from") + F.col("words")) - F.min("item_from")).alias("words"))
    return runs.select("doc", F.col("name").alias("item"), *[F.col(c).cast("int").alias(c) for c in ("item_from", "doc_from", "words")]).distinct()


def rarest(index: DataFrame, items: Items, terms: int) -> list[list[int]]:
    """Per item the numbers of its rarest terms by occurrences in the corpus, ties by the word; none if it has fewer or lacks one there.
    There are no more counts than the items have terms."""
    counts = dict(_held_terms(index, items).groupBy("term").agg(F.sum(F.size("places"))).collect())
    by_number = list(items.terms)
    out = []
    for seq in items.words:
        order = sorted((counts.get(by_number[t], 0), by_number[t], t) for t in set(seq.tolist()))[:terms]
        out.append([t for _, _, t in order] if len(order) == terms and order[0][0] else [])
    return out


def proximity_matches(index: DataFrame, items: Items, terms: int = 3, within: int = WITHIN) -> DataFrame:
    """(doc, item, span): documents that hold the item's `terms` rarest terms, in any order, within `within` words;
    span is the smallest such stretch. The index must reach as far as `within`."""
    chosen = index.sparkSession.sparkContext.broadcast(rarest(index, items, terms))

    def of(block: Block) -> Iterator[tuple]:
        for n, few in enumerate(chosen.value):
            for i, span in block.spans(few, within) if few else ():
                yield i, n, span

    found = _search(index, items, of, "span long")
    return found.groupBy("doc", F.col("name").alias("item")).agg(F.min("span").cast("int").alias("span"))


def _by_parts(held_out: DataFrame, item_key: str, item_text: str, search: Callable[[Items], DataFrame]) -> DataFrame:
    found = [search(Items.collect(part, item_key, item_text)) for part in parts(held_out, item_key, item_text)]
    return reduce(DataFrame.unionByName, found)


def leaks(docs: DataFrame, key: str, text: str, held_out: DataFrame, item_key: str, item_text: str, length: int = LENGTH) -> DataFrame:
    """(doc, item, item_from, doc_from, words) of a corpus; the index is written before it is searched."""
    index = materialise(postings(docs, key, text, length), "postings")
    return _by_parts(held_out, item_key, item_text, lambda items: phrase_matches(index, items, length)).distinct()


def near(docs: DataFrame, key: str, text: str, held_out: DataFrame, item_key: str, item_text: str, terms: int = 3, within: int = WITHIN) -> DataFrame:
    """(doc, item, span) of a corpus: where an item's rarest terms lie close together."""
    index = materialise(postings(docs, key, text, within), "postings")
    found = _by_parts(held_out, item_key, item_text, lambda items: proximity_matches(index, items, terms, within))
    return found.groupBy("doc", "item").agg(F.min("span").alias("span"))

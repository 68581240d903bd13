"""Benchmark decontamination by a positional inverted index of the training texts.

The index is stored in the shared folder as segments. A segment covers some documents (about ``SEGMENT``
bytes of text) and holds, sorted by term, the positions of each term in the run of its documents: its
postings lists. Test phrases are searched segment by segment, in tasks: the lists of a phrase's
terms are shifted by the terms' offsets and intersected, from the rarest term on, until nothing
is left or all terms agree on a start. No shuffle is needed and no list spans two tasks, so a word
that is in every document is no hot key.

The phrases are searched in blocks of at most ``PHRASES``; each block is one pass over the stored index.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areacast.llm import words
from areacast.session import scratch_path
from areacast.sources.tables import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEGMENT = 12_000_000
PHRASES = 50_000
# What separates words: all of ASCII but digits and letters; A-Z are folded.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
    for c in range(256)
)
_INDEX = (
    "segment string, ids binary, no_id binary, hashes binary, lengths binary, terms binary, ends binary, places binary"
)
_FOUND = (
    "segment string, ordinal int, id bigint, text_hash bigint, n_words bigint, "
    "spans array<struct<start:int,end:int>>, items array<bigint>, near_items array<bigint>"
)


def _terms(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


def _segment(name: str, ids: list, texts: list, tokens: list[np.ndarray]) -> list:
    """The columns of one segment; numbers as raw bytes."""
    run = np.concatenate(tokens) if tokens else np.empty(0, np.uint64)
    places = np.argsort(run, kind="stable").astype(np.int32)
    ordered = run[places]
    last = np.flatnonzero(np.append(ordered[1:] != ordered[:-1], True)) if len(run) else places
    return [
        name,
        np.array([i or 0 for i in ids], np.int64).tobytes(),
        np.array([i is None for i in ids], np.bool_).tobytes(),
        np.array(texts, np.int64).tobytes(),
        np.array([len(t) for t in tokens], np.int32).tobytes(),
        ordered[last].tobytes(),
        (last + 1).astype(np.int32).tobytes(),
        places.tobytes(),
    ]


def build_index(docs: DataFrame, id_column: str, text: str = "text") -> DataFrame:
    """Write the index of all texts and return it, one row per segment.

    Null texts have no words but are documents of the index. A text longer than a segment is a
    segment by itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        hashes = words.WordIds()
        ids, marks, tokens, held, number = [], [], [], 0, 0

        def row():
            columns = _segment(f"{task}-{number}", ids, marks, tokens)
            kinds = [pa.string()] + [pa.binary()] * 7
            return pa.RecordBatch.from_arrays(
                [pa.array([c], k) for c, k in zip(columns, kinds)],
                ["segment", "ids", "no_id", "hashes", "lengths", "terms", "ends", "places"],
            )

        for batch in batches:
            keys, own = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for key, value, mark in zip(keys, words.texts(batch.column(1)), own):
                if held and held + len(value or b"") > SEGMENT:
                    yield row()
                    ids, marks, tokens, held, number = [], [], [], 0, number + 1
                ids.append(key)
                marks.append(mark)
                tokens.append(hashes.of(_terms(value)))
                held += len(value or b"") + 1
        if ids:
            yield row()

    source = docs.select(F.col(id_column).cast("bigint"), F.col(text), F.xxhash64(text).alias("hash"))
    path = scratch_path(docs.sparkSession, "index")
    # Few segments a file: a reader's batch stays small.
    source.mapInArrow(run, _INDEX).write.option("maxRecordsPerFile", 4).parquet(path)
    return docs.sparkSession.read.schema(_INDEX).parquet(path)


def phrases(items: DataFrame, id_column: str, window: int, text: str = "text") -> DataFrame:
    """(terms, item): each ``window`` consecutive words of an item; all words if it has fewer, but some."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = words.WordIds()
        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), words.texts(batch.column(1))):
                run_of = hashes.of(_terms(value)).view(np.int64)
                width = min(window, len(run_of))
                if width:
                    cut = np.lib.stride_tricks.sliding_window_view(run_of, width)
                    yield pa.RecordBatch.from_arrays(
                        [words.lists(list(cut), pa.int64()), pa.array([key] * len(cut), pa.int64())],
                        ["terms", "item"],
                    )

    source = items.select(F.col(id_column).cast("bigint"), F.col(text))
    return source.mapInArrow(run, "terms array<bigint>, item bigint").distinct()


class _Lists:
    """The postings of one segment."""

    def __init__(self, row: dict):
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.ends = np.frombuffer(row["ends"], np.int32)
        self.places = np.frombuffer(row["places"], np.int32)
        self.stops = np.cumsum(np.frombuffer(row["lengths"], np.int32), dtype=np.int64)

    def find(self, terms: np.ndarray) -> np.ndarray:
        """The numbers of the terms, -1 for those that do not occur."""
        if not len(self.terms):
            return np.full(terms.shape, -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def count(self, at: np.ndarray) -> np.ndarray:
        return self.ends[at] - np.where(at > 0, self.ends[at - 1], 0)

    def of(self, term: int) -> np.ndarray:
        """The places of a term, ascending."""
        return self.places[self.ends[term - 1] if term else 0 : self.ends[term]]

    def starts(self, at: np.ndarray) -> np.ndarray:
        """Where the phrase of these terms starts."""
        left = None
        for i in np.argsort(self.count(at), kind="stable"):
            shifted = self.of(at[i]) - np.int32(i)
            if left is None:
                left = shifted
            else:
                near = np.searchsorted(shifted, left)
                fits = near < len(shifted)
                fits[fits] = shifted[near[fits]] == left[fits]
                left = left[fits]
            if not len(left):
                break
        left = left[left >= 0]
        own = np.searchsorted(self.stops, left, side="right")
        inside = left + len(at) <= self.stops[np.minimum(own, len(self.stops) - 1)]
        return left[inside]

    def near(self, at: np.ndarray, slop: int) -> np.ndarray:
        """The documents in which all terms of the phrase are within ``slop`` words of their place, for some start.

        The start need not be a place of the document, the terms have to be. Candidates come from the places of the rarest
        term, each of which allows 2 * slop + 1 starts, so the result does not depend on which term that is.
        """
        order = np.argsort(self.count(at), kind="stable")
        anchors = self.of(at[order[0]]).astype(np.int64)
        own = np.repeat(np.searchsorted(self.stops, anchors, side="right"), 2 * slop + 1)
        start = (anchors[:, None] - order[0] + np.arange(-slop, slop + 1)).ravel()
        for i in order[1:]:
            begin = np.where(own > 0, self.stops[own - 1], 0)
            low = np.maximum(start + i - slop, begin)
            high = np.minimum(start + i + slop, self.stops[own] - 1)
            places = self.of(at[i])
            k = np.searchsorted(places, low)
            fits = k < len(places)
            fits[fits] = places[k[fits]] <= high[fits]
            own, start = own[fits], start[fits]
            if not len(own):
                break
        return np.unique(own)


def _search(index: DataFrame, block: list, slop: int) -> tuple[DataFrame, Broadcast]:
    """The documents of the index with their hits of the block's phrases (terms, item); and the block as it is sent."""
    by_phrase: dict[bytes, list] = {}
    for terms, item in block:
        by_phrase.setdefault(np.array(terms, np.int64).tobytes(), []).append(item)
    by_length: dict[int, list] = {}
    for phrase, items in by_phrase.items():
        by_length.setdefault(len(phrase) // 8, []).append(
            (phrase, sorted(i for i in items if i is not None))
        )
    shared = index.sparkSession.sparkContext.broadcast([
        (np.frombuffer(b"".join(p for p, _ in found), np.uint64).reshape(-1, length),
         [items for _, items in found])
        for length, found in by_length.items()
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lists = _Lists(row)
                size = len(lists.stops)
                cover = np.zeros(int(lists.stops[-1]) + 1 if size else 1, np.int32)
                exact: dict[int, set] = {}
                near: dict[int, set] = {}
                for grid, items in shared.value:
                    at = lists.find(grid)
                    for i in np.flatnonzero((at >= 0).all(axis=1)):
                        width = grid.shape[1]
                        starts = lists.starts(at[i])
                        np.add.at(cover, starts, 1)
                        np.add.at(cover, starts + width, -1)
                        of_starts = np.unique(np.searchsorted(lists.stops, starts, side="right"))
                        for d in of_starts:
                            exact.setdefault(int(d), set()).update(items[i])
                        for d in lists.near(at[i], slop) if slop else of_starts:
                            near.setdefault(int(d), set()).update(items[i])
                hit = np.concatenate([[0], (np.cumsum(cover[:-1]) > 0).astype(np.int8), [0]])
                edge = np.diff(hit)
                begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                lengths = np.frombuffer(row["lengths"], np.int32)
                first = lists.stops - lengths
                spans: dict[int, list] = {}
                for b, e in zip(begins.tolist(), ends.tolist()):
                    # A run of hits can go on in the next documents.
                    d = int(np.searchsorted(lists.stops, b, side="right"))
                    while b < e:
                        stop = min(e, int(lists.stops[d]))
                        if b < stop:
                            base = int(first[d])
                            spans.setdefault(d, []).append({"start": b - base, "end": stop - base})
                        b, d = max(b, stop), d + 1
                ids = np.frombuffer(row["ids"], np.int64)
                missing = np.frombuffer(row["no_id"], np.bool_)
                texts = np.frombuffer(row["hashes"], np.int64)
                for low in range(0, size, 4096):
                    part = range(low, min(size, low + 4096))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([row["segment"]] * len(part)),
                        pa.array(list(part), pa.int32()),
                        pa.array(ids[part.start : part.stop], mask=missing[part.start : part.stop]),
                        pa.array(texts[part.start : part.stop]),
                        pa.array(lengths[part.start : part.stop].astype(np.int64)),
                        pa.array([spans.get(d, []) for d in part], pa.list_(
                            pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                        pa.array([sorted(exact.get(d, ())) for d in part], pa.list_(pa.int64())),
                        pa.array([sorted(near.get(d, ())) for d in part], pa.list_(pa.int64())),
                    ], ["segment", "ordinal", "id", "text_hash", "n_words", "spans", "items", "near_items"])

    return index.mapInArrow(run, _FOUND), shared


def _merged(spans) -> F.Column:
    """Overlapping or touching spans as one, over the spans of several blocks."""
    kind = "array<struct<start:int,end:int>>"

    def add(done, span):
        last = F.element_at(done, -1)
        apart = (F.size(done) == 0) | (last["end"] < span["start"])
        wider = F.struct(
            last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end")
        )
        return F.when(apart, F.concat(done, F.array(span))).otherwise(
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(wider))
        )

    return F.aggregate(F.sort_array(spans), F.array().cast(kind), add)


def search(index: DataFrame, wanted: DataFrame, slop: int = 2) -> DataFrame:
    """(id, text_hash, n_words, spans, items, near_items) of each document of the index.

    ``wanted`` has the phrases (terms, item). spans: the runs of words inside exact matches, as word
    numbers, end exclusive; items: whose phrases match exactly; near_items: also those with all
    terms of a phrase within ``slop`` words of their place, in one document. Items without an id give spans only.
    """
    blocks = -(-max(1, wanted.count()) // PHRASES)
    wanted = wanted.withColumn("block", F.pmod(F.xxhash64("terms", "item"), F.lit(blocks)))

    def block(number: int) -> tuple[DataFrame, Broadcast]:
        own = wanted.where(F.col("block") == number).select("terms", "item").collect()
        return _search(index, own, slop)

    if blocks == 1:
        return block(0)[0].drop("segment", "ordinal")
    found = None
    for number in range(blocks):
        # One block at a time is on the driver and in the tasks.
        results, sent = block(number)
        results = written(results, "hits")
        sent.destroy()
        found = results if found is None else found.unionByName(results)

    def gathered(column):
        return F.array_sort(F.array_distinct(F.flatten(F.collect_list(column)))).alias(column)

    return found.groupBy("segment", "ordinal", "id", "text_hash", "n_words").agg(
        _merged(F.flatten(F.collect_list("spans"))).alias("spans"),
        gathered("items"), gathered("near_items"),
    ).drop("segment", "ordinal")


def contamination(
    docs: DataFrame, doc_id: str, items: DataFrame, item_id: str, window: int = 10, slop: int = 2
) -> DataFrame:
    """The search of all items' phrases in all documents; one row per document row.

    Null or empty texts have no words and no hits, an empty item table gives none either.
    Repeated documents and items are treated each by itself; ``text_hash``, the xxhash64 of the text, tells rows
    of one id (or none) with different texts apart.
    """
    return search(build_index(docs, doc_id), phrases(items, item_id, window), slop).withColumnRenamed(
        "id", doc_id
    )

"""Substring dedup: repeated passages located by sharded Aho-Corasick automata."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import WordHashes, forget, space_words, stage, stage_buckets, window_hashes

WINDOW = 20
# Every window is represented by the six-word phrase in it with the smallest hash.
ANCHOR = 6
# Documents whose phrases go into one automaton.
SHARD_DOCS = 256
# Words of short texts handled in one go.
RUN_WORDS = 200_000
_LAST = (1 << 63) - 1
_NUMBER = np.uint64(1 << 63)
_LETTERS = 500_000


# --- task side ------------------------------------------------------------------------------


def anchors(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all phrases, and for each window the place of its smallest one (the leftmost)."""
    phrases = window_hashes(hashes, ANCHOR)
    n = len(hashes) - window + 1
    if n <= 0:
        return phrases, np.empty(0, np.int64)
    least, at = phrases[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, window - ANCHOR + 1):
        smaller = phrases[j : j + n] < least
        np.copyto(least, phrases[j : j + n], where=smaller)
        at[smaller] = j
    return phrases, at + np.arange(n)


def _signed(hashes: np.ndarray) -> np.ndarray:
    return (hashes ^ _NUMBER).view(np.int64)


class TextRun:
    """Some texts of a batch laid end to end, so that arrays are long whatever the texts are."""

    def __init__(self, texts: list[list[bytes]], known: WordHashes, window: int):
        self.texts = texts
        self.begins = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        words = [w for text in texts for w in text]
        self.phrases, at = anchors(known.of(words), window)
        owner = np.repeat(np.arange(len(texts)), np.diff(self.begins))
        # A window belongs to a text only if it ends in it.
        inside = owner[: len(at)] == owner[window - 1 :] if len(at) else np.empty(0, bool)
        self.windows = np.flatnonzero(inside)
        self.at = at[self.windows]
        self.owner = owner[self.windows]

    @classmethod
    def of(cls, column: pa.Array, known: WordHashes, window: int) -> Iterator[tuple[int, TextRun]]:
        """The texts of a column in runs of bounded length, each with the place of its first."""
        texts: list[list[bytes]] = []
        first, size = 0, 0
        for i, text in enumerate(column):
            texts.append(space_words(text.as_py()))
            size += len(texts[-1])
            if size >= RUN_WORDS:
                yield first, cls(texts, known, window)
                texts, first, size = [], i + 1, 0
        if texts:
            yield first, cls(texts, known, window)


def _summaries(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for first, texts in TextRun.of(batch.column("text"), known, window):
                piece = batch.slice(first, len(texts.texts))
                chosen = np.flatnonzero(np.diff(texts.at, prepend=-1))
                # One anchor place can serve windows of one text only, so runs tell them apart.
                counts = np.bincount(texts.owner[chosen], minlength=len(texts.texts))
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                found = _signed(texts.phrases[texts.at[chosen]])
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        piece.column("row"),
                        pa.array([len(t) for t in texts.texts], pa.int64()),
                        pa.array([hashlib.sha256(b" ".join(t)).hexdigest() for t in texts.texts], pa.string()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(found, pa.int64())),
                    ],
                    ["doc_id", "row", "n_words", "sha256", "anchors"],
                )

    return run


def _joined(words: list[bytes]) -> tuple[memoryview, np.ndarray]:
    """Words with single spaces between, and where each begins (and the last would end)."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    return memoryview(b" ".join(words) + b" "), np.concatenate([[0], np.cumsum(lengths)])


def _segments(window: int):
    """Runs of windows that share a recurring anchor: place, length in words, hash of the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for first, texts in TextRun.of(batch.column("text"), known, window):
                piece = batch.slice(first, len(texts.texts))
                # Anchors that recur for any text of the run: the others of a text recur too.
                recurring = np.unique(piece.column("recurring").flatten().to_numpy())
                begins = np.flatnonzero(np.diff(texts.at, prepend=-1))
                ends = np.append(begins[1:], len(texts.at)) - 1
                keys = _signed(texts.phrases[texts.at[begins]]) if len(begins) else np.empty(0, np.int64)
                wanted = np.isin(keys, recurring)
                begins, ends, keys = begins[wanted], ends[wanted], keys[wanted]
                owner = texts.owner[begins]
                start = texts.windows[begins]
                last = texts.windows[ends] + window
                bytes_, offsets = _joined([w for text in texts.texts for w in text])
                hashes = [
                    xxhash.xxh3_128_digest(bytes_[a : b - 1])
                    for a, b in zip(offsets[start].tolist(), offsets[last].tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(piece.column("doc").to_numpy()[owner], pa.int64()),
                        pa.array(piece.column("row").to_numpy()[owner], pa.int64()),
                        pa.array(start - texts.begins[owner], pa.int32()),
                        pa.array(last - start, pa.int32()),
                        pa.array(keys, pa.int64()),
                        pa.array(hashes, pa.binary()),
                    ],
                    ["doc", "row", "start", "length", "anchor", "phrase"],
                )

    return run


def _windows(window: int):
    """The single windows of the stretches listed with a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, rows = batch.column("doc").to_numpy(), batch.column("row").to_numpy()
            for i in range(batch.num_rows):
                bytes_, offsets = _joined(space_words(batch.column("text")[i].as_py()))
                begins = offsets.tolist()
                stretches = batch.column("stretches")[i].values
                starts = [
                    start
                    for first, length in zip(
                        stretches.field("start").to_pylist(), stretches.field("length").to_pylist()
                    )
                    for start in range(first, first + length - window + 1)
                ]
                hashes = [xxhash.xxh3_128_digest(bytes_[begins[s] : begins[s + window] - 1]) for s in starts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(starts), docs[i]), pa.int64()),
                        pa.array(np.full(len(starts), rows[i]), pa.int64()),
                        pa.array(starts, pa.int32()),
                        pa.array(np.full(len(starts), window), pa.int32()),
                        pa.array(hashes, pa.binary()),
                    ],
                    ["doc", "row", "start", "length", "phrase"],
                )

    return run


class PhraseAutomaton:
    """Aho-Corasick over the words of a shard: each distinct word has a letter of its own."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.automaton = ahocorasick.Automaton()

    def number(self, words: list[bytes]) -> np.ndarray:
        known = self.numbers
        return np.fromiter((known.setdefault(w, len(known)) for w in words), np.uint32, len(words))

    def spell(self, numbers: np.ndarray) -> str:
        """One letter per word, or two when the words of the shard outnumber the letters."""
        if self.width == 2:
            numbers = np.stack([numbers // _LETTERS + _LETTERS, numbers % _LETTERS], axis=1).ravel()
        numbers = numbers + 1
        # Code points of surrogates are no letters.
        return np.where(numbers >= 0xD800, numbers + 0x800, numbers).astype("<u4").tobytes().decode("utf-32-le")

    @property
    def width(self) -> int:
        return 1 if len(self.numbers) <= _LETTERS else 2

    def add(self, spelled: str, first: tuple[int, int, int]) -> None:
        """A phrase with the earliest place at which it stands anywhere."""
        before = self.automaton.get(spelled, None)
        if before is None or first < before[1]:
            self.automaton.add_word(spelled, (len(spelled), first))

    def repeats(self, spelled: str, doc: int, row: int) -> list[int]:
        """Per word how many phrases that first stand at an earlier place cover it."""
        width = self.width
        edges = [0] * (len(spelled) // width + 1)
        for end, (length, first) in self.automaton.iter(spelled):
            start = (end + 1 - length) // width
            if (doc, row, start) > first:
                edges[start] += 1
                edges[(end + 1) // width] -= 1
        return list(accumulate(edges[:-1]))


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams the texts of each shard through the automaton of the shard's phrases."""
    for batch in batches:
        for begin in range(0, batch.num_rows, SHARD_DOCS):
            shard = batch.slice(begin, SHARD_DOCS)
            automaton = PhraseAutomaton()
            texts = [space_words(text.as_py()) for text in shard.column("text")]
            numbered = [automaton.number(words) for words in texts]
            spelled = [automaton.spell(numbers) for numbers in numbered]
            width = automaton.width
            for text, listed in zip(spelled, shard.column("phrases")):
                phrases = listed.values
                first = phrases.field("first")
                for start, length, *place in zip(
                    phrases.field("start").to_pylist(),
                    phrases.field("length").to_pylist(),
                    *(first.field(f).to_pylist() for f in ("doc", "row", "start")),
                ):
                    automaton.add(text[start * width : (start + length) * width], tuple(place))
            automaton.automaton.make_automaton()
            removed, kept, digests = [], [], []
            for words, text, doc, row in zip(
                texts, spelled, shard.column("doc").to_pylist(), shard.column("row").to_pylist()
            ):
                covers = automaton.repeats(text, doc, row)
                left = b" ".join([w for w, n in zip(words, covers) if not n])
                removed.append(len(covers) - covers.count(0))
                kept.append(left.decode("utf-8"))
                digests.append(hashlib.sha256(left).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    shard.column("row"),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.string()),
                    pa.array(digests, pa.string()),
                ],
                ["row", "n_removed", "kept_text", "kept_sha256"],
            )


# --- plan -----------------------------------------------------------------------------------


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_removed``, ``kept_text`` (null where nothing goes)
    and ``kept_sha256``.

    1. A window of 20 words is represented by its anchor: the six-word phrase in it with the
       smallest hash. Copies of a window have the same anchor, so anchors that occur once rule
       out their windows; only their hashes are counted, with partial sums.
    2. Texts with a recurring anchor are written once, in buckets of a row hash; later steps join
       them without moving them again. A run of windows with one recurring anchor is a segment.
       Equal segments (128-bit hashes) are reduced to the earliest one, so the copies of a common
       passage are gathered nowhere. Segments that differ but share an anchor are reduced the same
       way, window by window.
    3. Segments and windows confirmed to stand elsewhere first are the phrases. Texts are taken in
       shards of ``SHARD_DOCS``; the phrases of a shard are compiled into one automaton over
       words, and every text of the shard is streamed through it. Each occurrence that begins
       later than the first place of its phrase is removed.

    Places are ordered by doc_id (null last), then by a hash of the row, then by start. Rows that
    repeat id and text are the same document and get the same result. Null and wordless texts
    have no words; texts under 20 words lose nothing. An empty table gives no rows.
    """
    source = docs.select(F.col("doc_id").cast("long"), "text").withColumn(
        "row", F.xxhash64("doc_id", "text")
    )
    summaries = stage(
        source.select("doc_id", "row", "text").mapInArrow(
            _summaries(window),
            "doc_id long, row long, n_words long, sha256 string, anchors array<long>",
        ),
        "summaries",
    )
    texts = stage(summaries.drop("anchors"), "texts")
    anchored = summaries.select("row", F.explode("anchors").alias("anchor"))
    recurring = anchored.groupBy("anchor").count().filter("count > 1").select("anchor")
    hits = stage(
        anchored.join(recurring, "anchor").groupBy("row").agg(F.collect_set("anchor").alias("recurring")),
        "hits",
    )
    forget(summaries)
    doc = F.coalesce("doc_id", F.lit(_LAST)).alias("doc")
    touched = stage_buckets(source.join(hits, "row").select(doc, "row", "text", "recurring"), "row")
    segments = stage(
        touched.mapInArrow(
            _segments(window), "doc long, row long, start int, length int, anchor long, phrase binary"
        ),
        "segments",
    )
    forget(hits)

    firsts = stage(_earliest(segments, "anchor", "length"), "firsts")
    varied = firsts.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1").select("anchor")
    stretches = (
        firsts.join(varied, "anchor")
        .groupBy("first.row")
        .agg(F.collect_list(F.struct("first.start", "length")).alias("stretches"))
    )
    windows = stage(
        touched.select("doc", "row", "text")
        .join(stretches, "row")
        .mapInArrow(_windows(window), "doc long, row long, start int, length int, phrase binary"),
        "windows",
    )
    repeated = _later(segments, firsts).union(_later(windows, _earliest(windows, "length")))
    phrases = stage(
        repeated.groupBy("row").agg(F.collect_set(F.struct("start", "length", "first")).alias("phrases")),
        "phrases",
    )
    forget(segments, firsts, windows)
    cleaned = (
        touched.select("doc", "row", "text")
        .join(phrases, "row")
        .mapInArrow(_clean, "row long, n_removed long, kept_text string, kept_sha256 string")
        .dropDuplicates(["row"])
    )
    return texts.join(cleaned, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        "kept_text",
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"),
    )


def _earliest(places: DataFrame, *also: str) -> DataFrame:
    """Each phrase with its first place and the number of its places."""
    return places.groupBy("phrase", *also).agg(
        F.min(F.struct("doc", "row", "start")).alias("first"), F.count("*").alias("times")
    )


def _later(places: DataFrame, earliest: DataFrame) -> DataFrame:
    """Places at which a phrase stands again, with its first place."""
    return (
        places.select("phrase", "doc", "row", "start", "length")
        .join(earliest.filter("times > 1").select("phrase", "first"), "phrase")
        .filter(F.struct("doc", "row", "start") > F.col("first"))
        .select("row", "start", "length", "first")
    )

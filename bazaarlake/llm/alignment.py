"""Cross-tokenizer alignment: the token sequences of two vocabularies merged in lockstep.

Both tokenizers spell the same bytes, so their tokens tile one byte range. A pointer walks along
each; every step links the two tokens under the pointers and moves the one that ends first, or
both at a cut. All documents of a chunk take their steps together, in one NumPy state.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import forget, no_columns_missing, stage

FOLDER = "/opt/tokenizers"
VOCABULARY_A, RANKS_A, VOCABULARY_B = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"

# Text bytes whose tokens one task holds at a time; a longer document is a chunk of its own.
CHUNK_BYTES = 2_500_000
# At most this many of the commonest pairs are broadcast; counts of the others come by a join.
KNOWN_PAIRS = 2_000_000

# Characters on which the word pattern of the two byte-level libraries cannot differ.
_PLAIN = re.compile("[\t\n\r -~À-ɏ]*")


# --- tokenizers -----------------------------------------------------------------------------


def read_vocabularies(folder: str = FOLDER) -> dict[str, bytes]:
    """The vocabulary files as bytes (a few MB), to travel with the job."""
    found = {}
    for name in (VOCABULARY_A, RANKS_A, VOCABULARY_B):
        with open(os.path.join(folder, name), "rb") as file:
            found[name] = file.read()
    return found


def _byte_of_letter() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokenizers:
    """Both tokenizers, and the bytes of every token."""

    def __init__(self, files: dict[str, bytes]):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.exact = Tokenizer.from_str(files[VOCABULARY_A].decode())
        self.exact.encode_special_tokens = True
        ranks = {
            base64.b64decode(token): int(rank)
            for token, rank in map(bytes.split, files[RANKS_A].splitlines())
        }
        # The same merges, several times as fast; used where the word patterns cannot differ.
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        byte_of = _byte_of_letter()
        vocabulary = json.loads(files[VOCABULARY_A])
        self.bytes_a = [b""] * self.exact.get_vocab_size()
        for token, number in vocabulary["model"]["vocab"].items():
            self.bytes_a[number] = bytes(byte_of[c] for c in token)
        for token in vocabulary.get("added_tokens", ()):
            self.bytes_a[token["id"]] = token["content"].encode()
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=files[VOCABULARY_B])
        self.bytes_b = [self._piece_bytes(i) for i in range(self.pieces.get_piece_size())]
        self.length_a = np.array([len(b) for b in self.bytes_a])
        self.length_b = np.array([len(b) for b in self.bytes_b])

    def _piece_bytes(self, number: int) -> bytes:
        piece = self.pieces.id_to_piece(number)
        if self.pieces.is_byte(number):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, text: str | None) -> tuple[list[int], list[int], int]:
        """Ids of A and of B and the number of bytes; nothing unless both spell space and text."""
        if not text:
            return [], [], 0
        spaced = " " + text
        raw = spaced.encode("utf-8", "replace")
        if _PLAIN.fullmatch(text):
            a = self.fast.encode_ordinary(spaced)
        else:
            a = self.exact.encode(spaced, add_special_tokens=False).ids
        b = self.pieces.encode(text)
        if b"".join(map(self.bytes_b.__getitem__, b)) != raw:
            return [], [], 0
        if b"".join(map(self.bytes_a.__getitem__, a)) != raw:
            return [], [], 0
        return a, b, len(raw)


# --- lockstep merging -----------------------------------------------------------------------


@dataclass
class Links:
    """Links of all documents of a chunk, in the order of documents and steps.

    ``a`` and ``b`` are places in the chunk's token arrays; ``cut`` marks the links after which
    both tokens end; document d owns links ``first[d]`` to ``first[d + 1]``.
    """

    a: np.ndarray
    b: np.ndarray
    cut: np.ndarray
    first: np.ndarray


def merge(ends_a: np.ndarray, first_a: np.ndarray, ends_b: np.ndarray, first_b: np.ndarray) -> Links:
    """Walks both token sequences of every document at once.

    ``ends_*`` hold the byte offset at which each token ends, ``first_*`` where each document's
    tokens begin. The state has one column per unfinished document: pointer into A, its stop,
    pointer into B, and the place of the next link. A step links all pairs under the pointers
    and moves the pointers; finished documents are then taken out of the state.
    """
    room = np.diff(first_a) + np.diff(first_b)
    base = np.concatenate([[0], np.cumsum(room)])
    a = np.empty(base[-1], np.int64)
    b = np.empty(base[-1], np.int64)
    kind = np.full(base[-1], 2, np.int8)
    state = np.array([first_a[:-1], first_a[1:], first_b[:-1], base[:-1]], np.int64)
    state = state[:, state[0] < state[1]]
    while state.shape[1]:
        at_a, stop, at_b, place = state
        end_a, end_b = ends_a[at_a], ends_b[at_b]
        move_a, move_b = end_a <= end_b, end_b <= end_a
        a[place] = at_a
        b[place] = at_b
        kind[place] = move_a & move_b
        at_a += move_a
        at_b += move_b
        place += 1
        going = at_a < stop
        if not going.all():
            state = state[:, going]
    used = kind < 2
    counts = np.add.reduceat(np.append(used, False), base[:-1], dtype=np.int64) if len(room) else np.empty(0, int)
    counts = np.where(room > 0, counts, 0)
    return Links(a[used], b[used], kind[used] == 1, np.concatenate([[0], np.cumsum(counts)]).astype(int))


def _ends(ids: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Byte offset at which each token ends within its document."""
    total = np.cumsum(lengths[ids])
    before = np.concatenate([[0], total])[first[:-1]]
    return total - np.repeat(before, np.diff(first))


@dataclass
class Chunk:
    """Tokens and links of some documents of a batch."""

    rows: list[int]
    a: np.ndarray
    first_a: np.ndarray
    b: np.ndarray
    first_b: np.ndarray
    links: Links

    def per_document(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value of links for each document."""
        total = np.concatenate([[0], np.cumsum(values)])
        return total[self.links.first[1:]] - total[self.links.first[:-1]]


def chunks(texts: pa.Array, tokenizers: Tokenizers) -> Iterator[Chunk]:
    """Documents of a batch in chunks of similar length, so that they finish together."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    order = sorted(range(len(lengths)), key=lengths.__getitem__)
    at = 0
    while at < len(order):
        rows: list[int] = []
        size = 0
        while at < len(order) and (not rows or size + lengths[order[at]] <= CHUNK_BYTES):
            rows.append(order[at])
            size += lengths[order[at]]
            at += 1
        a, b = [], []
        for row in rows:
            ids_a, ids_b, _ = tokenizers.encode(texts[row].as_py())
            a.append(np.array(ids_a, np.int64))
            b.append(np.array(ids_b, np.int64))
        first_a = np.concatenate([[0], np.cumsum([len(x) for x in a])])
        first_b = np.concatenate([[0], np.cumsum([len(x) for x in b])])
        all_a, all_b = np.concatenate(a), np.concatenate(b)
        links = merge(
            _ends(all_a, first_a, tokenizers.length_a),
            first_a,
            _ends(all_b, first_b, tokenizers.length_b),
            first_b,
        )
        yield Chunk(rows, all_a, first_a, all_b, first_b, links)


def _as_lists(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, kind))


# --- spelled groups -------------------------------------------------------------------------


def _spellings(size_a: int, size_b: int) -> list[bytes]:
    """Id and separator: A followed by ``,`` or ``|``, then B followed by ``,`` or ``;``."""
    return [
        str(number).encode() + mark
        for size, marks in ((size_a, (b",", b"|")), (size_b, (b",", b";")))
        for mark in marks
        for number in range(size)
    ]


def _spelled(chunk: Chunk, size_a: int, size_b: int) -> np.ndarray:
    """Tokens of all groups in order (A ids of a group, then its B ids), as spelling numbers."""
    last_a, last_b = chunk.links.a[chunk.links.cut], chunk.links.b[chunk.links.cut]
    in_group_a = np.diff(np.concatenate([[-1], last_a]))
    in_group_b = np.diff(np.concatenate([[-1], last_b]))
    end_a = np.zeros(len(chunk.a), np.int64)
    end_a[last_a] = 1
    end_b = np.zeros(len(chunk.b), np.int64)
    end_b[last_b] = 1
    out = np.empty(len(chunk.a) + len(chunk.b), np.int64)
    # A token follows the B tokens of earlier groups, a B token the A tokens up to its own group.
    before = np.repeat(np.concatenate([[0], last_b[:-1] + 1]) if len(last_b) else last_b, in_group_a)
    out[np.arange(len(chunk.a)) + before] = chunk.a + end_a * size_a
    upto = np.repeat(last_a + 1, in_group_b)
    out[np.arange(len(chunk.b)) + upto] = 2 * size_a + chunk.b + end_b * size_b
    return out


# --- Spark ----------------------------------------------------------------------------------

_PAIR_COLUMNS = (
    "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<long>, times array<int>"
)


def _linker(shared):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = Tokenizers(shared.value)
        size_a, size_b = len(tokenizers.bytes_a), len(tokenizers.bytes_b)
        spell = _spellings(size_a, size_b).__getitem__
        span = size_a * size_b
        for batch in batches:
            for chunk in chunks(batch.column("text"), tokenizers):
                links, documents = chunk.links, len(chunk.rows)
                spelled = _spelled(chunk, size_a, size_b)
                begins = (chunk.first_a + chunk.first_b).tolist()
                digests = [
                    hashlib.sha256(b"".join(map(spell, spelled[s:e].tolist()))[:-1]).hexdigest()
                    if e > s
                    else ""
                    for s, e in zip(begins, begins[1:])
                ]
                owner = np.repeat(np.arange(documents), np.diff(links.first))
                keys = owner * span + chunk.a[links.a] * size_b + chunk.b[links.b]
                keys.sort()
                heads = np.flatnonzero(np.diff(keys, prepend=-1))
                times = np.diff(np.append(heads, len(keys)))
                keys = keys[heads]
                first = np.searchsorted(keys, np.arange(documents + 1) * span)
                kept = batch.take(pa.array(chunk.rows))
                columns = [
                    kept.column("doc_id"),
                    pa.array(np.diff(chunk.first_a)),
                    pa.array(np.diff(chunk.first_b)),
                    pa.array(chunk.per_document(links.cut.astype(np.int64))),
                    pa.array(np.diff(links.first)),
                    pa.array(digests),
                    _as_lists(keys % span, first, pa.int64()),
                    _as_lists(times, first, pa.int32()),
                ]
                names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return link


def link_pairs(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """Per row of ``docs``: token, group and link counts, the digest of its groups, its id pairs.

    ``pairs`` are the distinct linked id pairs (A id times the size of B, plus B id), ``times``
    how often each is linked. Null and empty texts, and texts that the two tokenizers do not
    both spell back byte for byte, have no tokens. Rows are read one by one, whatever repeats;
    only ``doc_id`` and ``text`` are read, other columns go. One pass without a shuffle.
    """
    files = docs.sparkSession.sparkContext.broadcast(read_vocabularies(folder))
    rows = no_columns_missing(docs, doc_id="long", text="string")
    return rows.mapInArrow(_linker(files), f"doc_id long, {_PAIR_COLUMNS}")


def pair_counts(linked: DataFrame, size_b: int) -> DataFrame:
    """``pair``, ``documents`` that hold it, and whether that is the most of its A id (``best``).

    Pairs are counted in the tasks that read them before they are shuffled.
    """
    counts = linked.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(
        F.count("*").alias("documents")
    )
    counts = stage(counts.withColumn("a", F.expr(f"pair div {size_b}")), "pair_counts")
    most = counts.groupBy("a").agg(F.max("documents").alias("most"))
    judged = counts.join(most, "a").select(
        "pair", "documents", (F.col("documents") == F.col("most")).alias("best")
    )
    return judged


def _known_from(counts: DataFrame, known: int) -> int:
    """Least count, a power of two, from which at most ``known`` pairs are counted; 0 for all."""
    sizes = counts.groupBy(F.length(F.bin("documents")).alias("bits")).count().collect()
    total, least = 0, 0
    for row in sorted(sizes, key=lambda r: -r["bits"]):
        if total + row["count"] > known:
            return 1 << row["bits"]
        total += row["count"]
    return least


def _summer(shared):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, documents, best = shared.value
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times")
            first = pairs.offsets.to_numpy().astype(np.int64)
            values = pairs.values.to_numpy()[first[0] : first[-1]]
            often = times.values.to_numpy()[times.offsets[0].as_py() : times.offsets[-1].as_py()].astype(np.int64)
            first = first - first[0]
            place = np.minimum(np.searchsorted(known, values), max(len(known) - 1, 0))
            hit = known[place] == values if len(known) else np.zeros(len(values), bool)
            sums = []
            for worth in (documents, best):
                each = np.where(hit, worth[place], 0) * often if len(known) else np.zeros(len(values), np.int64)
                total = np.concatenate([[0], np.cumsum(each)])
                sums.append(pa.array(total[first[1:]] - total[first[:-1]]))
            missing = np.concatenate([[0], np.cumsum(~hit)])[first]
            columns = [
                *(batch.column(c) for c in batch.schema.names if c not in ("pairs", "times")),
                *sums,
                _as_lists(values[~hit], missing, pa.int64()),
                _as_lists(often[~hit], missing, pa.int32()),
            ]
            names = [c for c in batch.schema.names if c not in ("pairs", "times")]
            yield pa.RecordBatch.from_arrays(columns, [*names, "count_sum", "n_best", "pairs", "times"])

    return add


def alignment(docs: DataFrame, folder: str = FOLDER, known: int = KNOWN_PAIRS) -> DataFrame:
    """Per row of ``docs``: ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``
    and ``groups_sha256``.

    A pair's count is the number of rows that hold it linked. ``n_best`` counts links whose pair
    has the highest count of its A id, ties included; ``count_sum`` adds the counts of all links.
    Documents are tokenized and merged once, without a shuffle, and their distinct pairs are
    written. Counts of the commonest pairs (``known`` at most) are broadcast; links of rarer ones,
    the long tail that a larger corpus adds, meet their counts in a join on the pair, whose keys
    are rare by choice, and are summed per row.

    Rows without tokens have zeros and an empty digest; an empty table gives no rows; see
    ``link_pairs`` for the other cases.
    """
    context = docs.sparkSession.sparkContext
    size_b = len(Tokenizers(read_vocabularies(folder)).bytes_b)
    linked = stage(
        link_pairs(docs, folder).withColumn("_row", F.monotonically_increasing_id()), "linked"
    )
    counts = stage(pair_counts(linked, size_b), "pair_worth")
    least = _known_from(counts, known)
    common = counts.filter(F.col("documents") >= least).orderBy("pair").toArrow()
    shared = context.broadcast(
        (
            common.column("pair").to_numpy(),
            common.column("documents").to_numpy(),
            common.column("best").to_numpy().astype(np.int64),
        )
    )
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    schema = (
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "_row long, count_sum long, n_best long, pairs array<long>, times array<int>"
    )
    summed = linked.select(*kept, "_row", "pairs", "times").mapInArrow(_summer(shared), schema)
    if least == 0:
        return summed.select(*kept, "n_best", "count_sum")
    summed = stage(summed, "summed")
    forget(linked)
    rare = (
        summed.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
        .select("_row", "link.pairs", "link.times")
        .withColumnRenamed("pairs", "pair")
        .join(counts.filter(F.col("documents") < least), "pair")
        .groupBy("_row")
        .agg(
            F.sum(F.col("times") * F.col("documents")).alias("more"),
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        )
    )
    return summed.join(rare, "_row", "left").select(
        *kept,
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"),
    )


def _describer(shared):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = Tokenizers(shared.value)
        for batch in batches:
            for chunk in chunks(batch.column("text"), tokenizers):
                links = chunk.links
                start_a = np.repeat(chunk.first_a[:-1], np.diff(links.first))
                start_b = np.repeat(chunk.first_b[:-1], np.diff(links.first))
                pairs = pa.StructArray.from_arrays(
                    [
                        pa.array(links.a - start_a, pa.int32()),
                        pa.array(links.b - start_b, pa.int32()),
                        pa.array(links.cut),
                    ],
                    ["a", "b", "cut"],
                )
                columns = [
                    batch.column("doc_id").take(pa.array(chunk.rows)),
                    _as_lists(chunk.a, chunk.first_a, pa.int32()),
                    _as_lists(chunk.b, chunk.first_b, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(links.first, pa.int32()), pairs),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "a_ids", "b_ids", "links"])

    return describe


def align(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """Per row of ``docs``: ``a_ids``, ``b_ids`` and ``links`` in order of steps.

    A link has the places of its two tokens (``a`` and ``b``, from 0) and ``cut``: whether both
    end there. Texts without tokens (see ``link_pairs``) have empty lists.
    """
    files = docs.sparkSession.sparkContext.broadcast(read_vocabularies(folder))
    return no_columns_missing(docs, doc_id="long", text="string").mapInArrow(
        _describer(files),
        "doc_id long, a_ids array<int>, b_ids array<int>, "
        "links array<struct<a: int, b: int, cut: boolean>>",
    )

"""Language identification of mixed texts: scripts narrow the languages, Viterbi labels the words.

A word's letters belong to a script; only languages learned in that script are candidates. Each
candidate scores the word by its character n-grams, and the best sequence of labels, where every
change of language costs a fixed amount, cuts the text into spans.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import no_columns_missing

UNKNOWN = "und"
# Languages learned, at most: those of the most documents. With it the model is bounded.
MOST_LANGUAGES = 128
BUCKETS = 1 << 16
# A language is a candidate for a script that holds this share of its letters.
SCRIPT_SHARE = 0.02
# Weight, in n-grams, of the mean of all languages in the counts of each.
PRIOR = 500.0
# Most that one word may count for or against a language, and the cost of a change of language.
WORD_LIMIT, SWITCH = 8.0, 12.0
# Characters scored at a time, and numbers (words times languages) labelled at a time.
PIECE, LABELLED = 400_000, 6_000_000

# Ranges of code points of scripts. Letters elsewhere form a script of their own.
SCRIPTS = [
    ("latin", 0x0041, 0x02AF),
    ("greek", 0x0370, 0x03FF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("gurmukhi", 0x0A00, 0x0A7F),
    ("gujarati", 0x0A80, 0x0AFF),
    ("odia", 0x0B00, 0x0B7F),
    ("tamil", 0x0B80, 0x0BFF),
    ("telugu", 0x0C00, 0x0C7F),
    ("kannada", 0x0C80, 0x0CFF),
    ("malayalam", 0x0D00, 0x0D7F),
    ("sinhala", 0x0D80, 0x0DFF),
    ("thai", 0x0E00, 0x0E7F),
    ("lao", 0x0E80, 0x0EFF),
    ("tibetan", 0x0F00, 0x0FFF),
    ("myanmar", 0x1000, 0x109F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF),
    ("ethiopic", 0x1200, 0x139F),
    ("khmer", 0x1780, 0x17FF),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x1F00, 0x1FFF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x4DBF),
    ("han", 0x4E00, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
    ("han", 0xF900, 0xFAFF),
    ("han", 0x20000, 0x323AF),
]


def held_out(key: Column) -> Column:
    """Rows kept from learning: their id's checksum leaves 1. Null ids are neither held out nor learned."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False)).alias("held_out")


# --- words and n-grams ----------------------------------------------------------------------


@dataclass
class Alphabet:
    """Per code point: its script (0 outside words), whether it is a letter, its lower case."""

    script: np.ndarray
    letter: np.ndarray
    lower: np.ndarray

    @classmethod
    def build(cls) -> Alphabet:
        names = {name: i + 2 for i, name in enumerate(dict.fromkeys(name for name, *_ in SCRIPTS))}
        script = np.ones(0x110000, np.uint8)
        for name, first, last in SCRIPTS:
            script[first : last + 1] = names[name]
        kinds = [unicodedata.category(chr(c))[0] for c in range(0x110000)]
        letter = np.array([k == "L" for k in kinds])
        # A mark goes on with the word it stands in.
        script[~(letter | np.array([k == "M" for k in kinds]))] = 0
        lower = np.arange(0x110000, dtype=np.uint32)
        for c in np.flatnonzero(letter):
            small = chr(c).lower()
            lower[c] = ord(small) if len(small) == 1 else c
        return cls(script, letter, lower)


_A, _B, _C, _D = (
    np.uint64(n)
    for n in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)
)
_SHIFT = np.uint64(64 - BUCKETS.bit_length() + 1)
_END = np.uint64(1)


def _buckets(at, before, second, third) -> list[np.ndarray]:
    """Buckets of the n-grams of two, three and four characters that end in ``at``."""
    two = at * _A + before * _B
    three = two + second * _C + _D
    four = three + third * _D + _A
    return [((x ^ (x >> np.uint64(29))) * _C >> _SHIFT).astype(np.int64) for x in (two, three, four)]


@dataclass
class Words:
    """Words of a piece: runs of one script. ``grams`` are ordered by word, ``ends`` one per word."""

    start: np.ndarray
    end: np.ndarray
    script: np.ndarray
    first_gram: np.ndarray
    grams: list[np.ndarray]
    ends: list[np.ndarray]


def find_words(codes: np.ndarray, alphabet: Alphabet) -> Words:
    script = alphabet.script[codes]
    # Marks of no script of their own (U+0300 on) take that of the character before.
    loose = np.flatnonzero((codes >= 0x300) & (codes < 0x370) & (np.arange(len(codes)) > 0))
    script[loose] = script[loose - 1]
    inside = script > 0
    begins = inside & (np.diff(script, prepend=np.uint8(0)) != 0)
    goes_on = inside & ~begins
    at = np.where(inside, alphabet.lower[codes], 0).astype(np.uint64)

    def shifted(x: np.ndarray) -> np.ndarray:
        return np.where(goes_on, np.concatenate([x[:1], x[:-1]]), np.uint64(0))

    before = shifted(at)
    second = shifted(before)
    third = shifted(second)
    stops = inside & np.append(begins[1:] | ~inside[1:], True)[: len(codes)]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    last = end - 1
    return Words(
        start,
        end,
        script[start],
        (np.cumsum(inside) - 1)[start],
        _buckets(at[inside], before[inside], second[inside], third[inside]),
        _buckets(_END, at[last], before[last], second[last]),
    )


def segments(text: str) -> Iterator[tuple[int, str]]:
    """The text in pieces of bounded length, cut at a space or line end where there is one."""
    at = 0
    while len(text) - at > PIECE:
        cut = max(text.rfind(" ", at, at + PIECE), text.rfind("\n", at, at + PIECE)) + 1
        cut = cut if cut > at else at + PIECE
        yield at, text[at:cut]
        at = cut
    yield at, text[at:]


def pieces(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Code points of many short or parts of long texts: codes, where each begins, its text, its offset."""
    codes, owner, offset, size = [], [], [], 0
    for number, text in enumerate(texts):
        for at, part in segments(text):
            if size and size + len(part) > PIECE:
                yield _joined(codes), np.cumsum([0, *[len(c) + 1 for c in codes[:-1]]]), np.array(owner), np.array(offset)
                codes, owner, offset, size = [], [], [], 0
            codes.append(part)
            owner.append(number)
            offset.append(at)
            size += len(part) + 1
    if codes:
        yield _joined(codes), np.cumsum([0, *[len(c) + 1 for c in codes[:-1]]]), np.array(owner), np.array(offset)


def _joined(parts: list[str]) -> np.ndarray:
    return np.frombuffer("\n".join(parts).encode("utf-32-le", "replace"), np.uint32)


# --- learning -------------------------------------------------------------------------------


def _counter(shared):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet = Alphabet(*shared.value)
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            by_language: dict[str, list[str]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                by_language.setdefault(lang, []).append(text or "")
            for lang, texts in by_language.items():
                total = totals.setdefault(lang, np.zeros(BUCKETS + 257, np.int64))
                total[BUCKETS + 256] += len(texts)
                for codes, *_ in pieces(texts):
                    words = find_words(codes, alphabet)
                    for found in (*words.grams, *words.ends):
                        total[:BUCKETS] += np.bincount(found, minlength=BUCKETS)
                    letters = np.bincount(words.script, words.end - words.start, 256)
                    total[BUCKETS : BUCKETS + 256] += letters.astype(np.int64)
        for lang, total in totals.items():
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some), pa.string()), pa.array(some, pa.int32()), pa.array(total[some])],
                ["lang", "bucket", "n"],
            )

    return count


@dataclass
class Model:
    """Learned languages in order of name, their n-gram scores, scripts, and the commonest one."""

    languages: list[str]
    scores: np.ndarray
    scripts: np.ndarray
    commonest: int


def model_of(languages: list[str], counts: np.ndarray) -> Model:
    """From counts per language: n-grams, then letters by script, then documents."""
    grams = counts[:, :BUCKETS].astype(np.float64)
    total = grams.sum(1, keepdims=True)
    shares = grams / np.maximum(total, 1)
    pooled = (shares.mean(0) if len(languages) else np.zeros(BUCKETS)) * 0.9 + 0.1 / BUCKETS
    scores = np.log((grams + PRIOR * pooled) / (total + PRIOR))
    letters = counts[:, BUCKETS : BUCKETS + 256]
    share = letters / np.maximum(letters.sum(1, keepdims=True), 1)
    commonest = int(counts[:, BUCKETS + 256].argmax()) if len(languages) else 0
    return Model(languages, scores.T.astype(np.float32).copy(), (share.T >= SCRIPT_SHARE), commonest)


def learn(docs: DataFrame, languages: int = MOST_LANGUAGES) -> Model:
    """Counts n-grams and scripts of every labelled row that is not held out.

    All rows are counted, in the tasks that read them; one number per language and bucket is
    shuffled, and ``languages`` times ``BUCKETS`` numbers at most reach the driver. Beyond that
    many languages those of the fewest documents are not learned (ties by name). Rows without a
    language or an id teach nothing.
    """
    spark = docs.sparkSession
    alphabet = Alphabet.build()
    shared = spark.sparkContext.broadcast((alphabet.script, alphabet.letter, alphabet.lower))
    rows = no_columns_missing(docs, doc_id="long", lang="string", text="string")
    taught = rows.filter("lang is not null and doc_id is not null").filter(~held_out(F.col("doc_id")))
    most = taught.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    names = sorted((row["lang"] for row in most), key=lambda name: name.encode())
    counts = np.zeros((len(names), BUCKETS + 257), np.int64)
    if names:
        found = (
            taught.filter(F.col("lang").isin(names))
            .select("lang", "text")
            .mapInArrow(_counter(shared), "lang string, bucket int, n long")
            .groupBy("lang", "bucket")
            .agg(F.sum("n").alias("n"))
            .toArrow()
        )
        index = {name: i for i, name in enumerate(names)}
        row = np.array([index[name] for name in found.column("lang").to_pylist()], int)
        counts[row, found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return model_of(names, counts)


# --- labelling ------------------------------------------------------------------------------


def score_words(words: Words, model: Model) -> np.ndarray:
    """Per word and language: how far it falls behind the word's best candidate, limited."""
    if not len(words.start):
        return np.zeros((0, len(model.languages)), np.float32)
    inside = sum(model.scores[found] for found in words.grams)
    total = np.add.reduceat(inside, words.first_gram, axis=0)
    total += sum(model.scores[found] for found in words.ends)
    total /= 3
    allowed = model.scripts[words.script]
    total[~allowed] = -np.inf
    best = total.max(1, keepdims=True)
    known = np.isfinite(best)
    behind = np.maximum(total - np.where(known, best, 0), -WORD_LIMIT)
    behind[~allowed] = -2 * WORD_LIMIT
    # A word in a script that no language was learned in says nothing.
    return np.where(known, behind, 0).astype(np.float32)


def viterbi(scores: np.ndarray, first: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best label of every word; words ``first[d]`` to ``first[d + 1]`` form one text.

    All texts take a step at a time, longest first, so those still going are the first rows.
    """
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    begin, sizes = first[:-1][order], sizes[order]
    kinds = scores.shape[1]
    going = np.searchsorted(-sizes, -np.arange(sizes[0] if len(sizes) else 0), "left")
    value = np.zeros((len(sizes), kinds), np.float32)
    stayed = np.empty(scores.shape, bool)
    came = np.empty(len(scores), np.int16)
    for step, count in enumerate(going):
        now, word = value[:count], begin[:count] + step
        top = now.argmax(1)
        least = now[np.arange(count), top, None] - np.float32(switch)
        stay = now >= least
        stayed[word] = stay
        came[word] = top
        value[:count] = np.where(stay, now, least) + scores[word]
    label = np.empty(len(scores), np.int16)
    state = value.argmax(1)
    for step in range(len(going) - 1, -1, -1):
        count = going[step]
        word = begin[:count] + step
        label[word] = state[:count]
        state[:count] = np.where(stayed[word, state[:count]], state[:count], came[word])
    return label


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))


def _labelled(texts: list[str], words: list, model: Model):
    """Label, share and spans of each text, from its words: (text, start, end, scores) arrays."""
    owner, start, end, scores = (np.concatenate(x) for x in zip(*words))
    first = np.searchsorted(owner, np.arange(len(texts) + 1))
    label = viterbi(scores, first)
    kinds = len(model.languages)
    letters = np.bincount(owner * kinds + label, end - start, len(texts) * kinds).reshape(-1, kinds)
    # Words in scripts nobody was learned in do not speak for the label they happen to carry.
    says = np.bincount(owner, scores.min(1) < 0, len(texts)) > 0
    heads = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(label, prepend=-1) != 0))
    tails = np.append(heads[1:], len(owner))[: len(heads)] - 1
    span_first = np.searchsorted(owner[heads], np.arange(len(texts) + 1))
    spans = [
        [
            (int(start[h]), int(end[t]), model.languages[label[h]])
            for h, t in zip(heads[a:b], tails[a:b])
        ]
        for a, b in zip(span_first, span_first[1:])
    ]
    best = letters.argmax(1)
    share = letters.max(1) / np.maximum(letters.sum(1), 1)
    return best, share, says, spans


def _identifier(shared):
    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        script, letter, lower, names, table, scripts, commonest = shared.value
        alphabet = Alphabet(script, letter, lower)
        model = Model(names, table, scripts, commonest)
        most = LABELLED // max(len(names), 1)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            at = 0
            while at < len(texts):
                # A word takes two characters at least, so this bounds the words at hand.
                size, last = 0, at
                while last < len(texts) and (last == at or size + len(texts[last]) <= 4 * most):
                    size += len(texts[last])
                    last += 1
                yield _identified(batch.slice(at, last - at), texts[at:last], alphabet, model)
                at = last

    return identify


def _identified(batch: pa.RecordBatch, texts: list[str], alphabet: Alphabet, model: Model) -> pa.RecordBatch:
    found, letters = [], np.zeros(len(texts), bool)
    for codes, begins, owner, offset in pieces(texts):
        # One more place, as an empty text at the end begins behind the last character.
        in_text = np.add.reduceat(np.append(alphabet.letter[codes], False), begins, dtype=np.int64)
        np.logical_or.at(letters, owner, in_text > 0)
        if not model.languages:
            continue
        words = find_words(codes, alphabet)
        part = np.searchsorted(begins, words.start, "right") - 1
        shift = offset[part] - begins[part]
        found.append((owner[part], words.start + shift, words.end + shift, score_words(words, model)))
    if found and sum(len(x[0]) for x in found):
        best, share, says, spans = _labelled(texts, found, model)
    else:
        best, share = np.zeros(len(texts), int), np.zeros(len(texts))
        says, spans = np.zeros(len(texts), bool), [[] for _ in texts]
    names = []
    for i in range(len(texts)):
        if not letters[i] or not model.languages:
            names.append(UNKNOWN)
        else:
            names.append(model.languages[best[i] if says[i] or len(model.languages) == 1 else model.commonest])
    sure = np.where(says | (len(model.languages) == 1), share, 0.0)
    columns = [
        batch.column("doc_id"),
        pa.array(names, pa.string()),
        pa.array(np.where([n == UNKNOWN for n in names], 0.0, sure), pa.float64()),
        pa.array(spans, _SPAN),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "spans"])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs``: ``lang_pred``, ``score`` and the ``spans`` of its languages.

    A span has ``start`` and ``end`` (in characters) and ``lang``; ``lang_pred`` is the language
    whose spans hold the most letters (ties by name) and ``score`` its share of them. Null texts
    and texts without a letter are ``und`` with score 0 and no spans, as are all texts when no
    language was learned. Texts whose letters all belong to scripts that no language was learned
    in get the commonest learned language with score 0. Only ``doc_id`` and ``text`` are read;
    rows are labelled one by one, whatever repeats. One pass without a shuffle; the model
    (``MOST_LANGUAGES`` times ``BUCKETS`` numbers at most) is broadcast.
    """
    alphabet = Alphabet.build()
    shared = docs.sparkSession.sparkContext.broadcast(
        (
            alphabet.script,
            alphabet.letter,
            alphabet.lower,
            model.languages,
            model.scores,
            model.scripts,
            model.commonest,
        )
    )
    return no_columns_missing(docs, doc_id="long", text="string").mapInArrow(
        _identifier(shared),
        "doc_id long, lang_pred string, score double, spans array<struct<start: long, end: long, lang: string>>",
    )

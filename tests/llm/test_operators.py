"""The document operators on small tables: edge cases, and brute force over whole results."""

import collections
import hashlib
import os
import random
import re
import sys
import zlib

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from bazaarlake.llm import (
    decontaminate,
    licenses,
    line_dedup,
    mixing,
    near_dedup,
    phrases,
    rules,
    sharding,
    site_quality,
    toxicity,
)
from bazaarlake.session import shared_dir

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, score string"
WORDS = [f"w{i}" for i in range(400)]


def passage(start, count):
    return " ".join(WORDS[start : start + count])


ROWS = [
    (1, passage(0, 60) + "\n" + passage(60, 12), "en", "a"),
    (2, passage(0, 60) + "\n" + passage(60, 12), "en", "a"),
    (3, passage(0, 60) + "\n" + passage(60, 11) + " other", "en", "b"),
    (4, None, None, None),
    (5, "", "en", "b"),
    (6, " \n\t ", "en", "b"),
    (7, "Released under the MIT License. stupid stupid", "de", "c"),
    (7, "Released under the MIT License. stupid stupid", "de", "c"),
    (None, passage(100, 45), "fr", None),
    (None, passage(100, 45), "fr", None),
    (9, passage(200, 30) + " " + passage(0, 25) + " " + passage(200, 30), "en", "a"),
    (10, " ".join(f"long{i % 977}" for i in range(30_000)), "en", "a"),
    (11, "a b c", "en", "c"),
]
LABELS = [(i, i % 2, 1 - i % 2) for i in range(1, 12)] + [(1, 0, 0), (None, 1, 1), (2, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*row, len(row[1] or ""), "x", "y") for row in ROWS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_words(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def test_sharding(docs, nothing):
    assert sharding.assign_shards(nothing).count() == 0
    found = sharding.assign_shards(docs).collect()
    assert len(found) == len(ROWS)
    slots = collections.defaultdict(list)
    for row in found:
        slots[row.shard].append(row.slot)
        assert row.grown_shard in (row.shard, sharding.SHARDS)
        assert row.size == len((row.text or "").encode()) + 1
        assert row.text_crc32 == (None if row.text is None else zlib.crc32(row.text.encode()))
        assert row.shard == jump(row.doc_id or 0, 16)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def jump(key, shards):
    at, then = -1, 0
    while then < shards:
        at = then
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        then = int((at + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return at


def test_mixing(docs, nothing):
    assert mixing.mix(nothing).count() == 0
    mixed = mixing.mix(docs)
    found = mixed.collect()
    assert len(found) == len(ROWS)
    targets = {}
    for row in found:
        assert row.size == len(space_words(row.text))
        assert 0 <= row.taken <= 2 * row.size
        targets[row.source] = (row.target, row.source_size)
    assert all(t <= 2 * s + 1e-9 for t, s in targets.values())
    assert abs(sum(t for t, _ in targets.values()) - 1.5 * sum(s for _, s in targets.values())) < 1e-6
    assert mixing.emit(mixed).count() == sum(row.copies for row in found)
    again = {(r.doc_id, r.text, r.copies) for r in mixing.mix(docs.repartition(3)).collect()}
    assert again == {(r.doc_id, r.text, r.copies) for r in found}


def test_near_duplicates(docs, nothing):
    assert near_dedup.near_duplicates(nothing).count() == 0
    found = near_dedup.near_duplicates(docs).collect()
    by_id = {row.doc_id: row for row in found}
    assert len(found) == len(ROWS)
    assert {by_id[i].component_id for i in (1, 2, 3)} == {1}
    assert [by_id[i].kept for i in (1, 2, 3)] == [True, False, False]
    for i in (4, 5, 6):
        assert by_id[i].n_shingles == 0 and by_id[i].component_id == i and by_id[i].kept
    assert by_id[None].component_id is None and by_id[None].kept
    assert by_id[11].n_shingles == 1
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert {2, 3}.isdisjoint(row.doc_id for row in kept.collect())


def test_licenses(docs, nothing):
    assert licenses.scan(nothing).count() == 0
    found = licenses.scan(docs).collect()
    assert len(found) == len(ROWS)
    for row in found:
        if row.doc_id == 7:
            assert (row.n_base, row.first_word, row.last_word) == (1, 1, 1)
            assert (row.base_labels, row.labels, row.score) == ("mit", "mit", 1.0)
        else:
            assert (row.n_base, row.first_word, row.base_labels, row.labels) == (0, None, "", "")
        assert row.n_words == max(len(plain_words(t)) for d, t, *_ in ROWS if d == row.doc_id)


def test_licenses_count_all_places(spark):
    text = "cc by nc cc-by-nc CC BY NC! released under the big MIT license"
    row = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.n_base, row.first_word, row.last_word, row.base_labels) == (3, 0, 6, "cc-by-nc")


def test_decontamination(spark, docs, nothing):
    items = [(1, passage(20, 14)), (2, "A B, c"), (3, None), (4, ""), (5, passage(300, 20)), (1, passage(20, 14))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.find_matches(nothing, benchmark).count() == 0
    assert decontaminate.find_matches(docs, benchmark.limit(0)).filter("contaminated").count() == 0
    found = decontaminate.find_matches(docs, benchmark).collect()
    assert len(found) == len(ROWS)
    windows = collections.defaultdict(set)
    for item, text in items:
        words = plain_words(text)
        for s in range(len(words) - min(10, len(words)) + 1 if words else 0):
            windows[tuple(words[s : s + 10])].add(str(item))
    for row in found:
        words = plain_words(row.text)
        hit, names = set(), set()
        for n in {len(w) for w in windows}:
            for s in range(len(words) - n + 1):
                if tuple(words[s : s + n]) in windows:
                    hit.update(range(s, s + n))
                    names |= windows[tuple(words[s : s + n])]
        assert (row.n_words, row.n_hit, row.items) == (len(words), len(hit), sorted(names))
        assert row.contaminated == bool(hit)
    longest = [m for row in found if row.doc_id == 1 for m in row.matches]
    assert {(m.item_id, m.word, m.words) for m in longest} == {("1", 20, 14)}


def test_blocks_of_items(spark, docs, monkeypatch):
    items = [(1, passage(20, 14)), (2, "A B, c"), (5, passage(30, 20))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    columns = ["doc_id", "n_hit", "items"]
    whole = decontaminate.find_matches(docs, benchmark).select(columns).collect()
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 5)
    parts = decontaminate.find_matches(docs, benchmark).select(columns).collect()
    assert sorted(map(str, parts)) == sorted(map(str, whole))


def test_substring_dedup(docs, nothing):
    assert phrases.remove_repeats(nothing).count() == 0
    found = phrases.remove_repeats(docs).collect()
    assert len(found) == len(ROWS)
    first, expected = {}, {}
    ordered = sorted({(d is None, d or 0, t) for d, t, *_ in ROWS}, key=lambda r: (r[0], r[1], r[2] or ""))
    for none, doc, text in ordered:
        words = space_words(text)
        gone = [False] * len(words)
        for s in range(len(words) - 19):
            window = tuple(words[s : s + 20])
            if window in first:
                gone[s : s + 20] = [True] * 20
            first.setdefault(window, doc)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        expected[None if none else doc] = (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    for row in found:
        assert (row.n_words, row.n_removed, row.kept_sha256) == expected[row.doc_id]


def test_line_dedup(docs, nothing):
    assert line_dedup.remove_later_lines(nothing).count() == 0
    found = {row.doc_id: row for row in line_dedup.remove_later_lines(docs).collect()}
    assert (found[1].n_lines, found[1].n_removed) == (2, 0)
    assert (found[2].n_removed, found[2].kept_text) == (2, "")
    assert found[3].n_removed == 1 and found[3].kept_text.endswith("other")
    assert (found[4].n_lines, found[4].kept_text) == (0, None)
    assert (found[5].n_lines, found[5].n_removed) == (1, 0)
    assert found[6].n_removed == 0


@pytest.mark.parametrize("direct", [64, 1])
def test_lines_with_changed_words(spark, monkeypatch, direct):
    """Short and long lines with a few words changed or repeated, against brute force."""
    monkeypatch.setattr(line_dedup, "DIRECT", direct)
    chance = random.Random(8)
    lines = ["a b c d", "a b c d E", "d c b a e", "a b c", "a a b b c", "a a b b", "a b b c c"]
    for i in range(60):
        base = [f"u{i % 12}x{j}" if j % 3 else "the" for j in range(6 + 5 * (i % 12))]
        for place in chance.sample(range(len(base)), chance.randrange(1 + len(base) // 4)):
            base[place] = chance.choice(["the", f"z{i}", "and"])
        lines.append(" ".join(base))
    bags = [collections.Counter(line.lower().split()) for line in lines]
    gone = {
        b
        for b in range(len(bags))
        for a in range(b)
        if 100 * (bags[a] & bags[b]).total() >= 80 * (bags[a] | bags[b]).total()
    }
    assert {1, 2} <= gone and len(gone) > 10
    docs = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "doc_id long, text string")
    found = line_dedup.remove_later_lines(docs, tokens_of=line_dedup.words).collect()
    assert {row.doc_id for row in found if row.n_removed} == gone
    texts = [(i, "\n".join(lines[i * 7 : i * 7 + 7])) for i in range(10)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = line_dedup.remove_later_lines(docs, tokens_of=line_dedup.words).collect()
    for row in found:
        part = range(row.doc_id * 7, min(row.doc_id * 7 + 7, len(lines)))
        assert row.kept_text == "\n".join(lines[k] for k in part if k not in gone)


def test_line_dedup_frees_what_it_no_longer_reads(spark):
    """Lines of few words, often repeated, against brute force; tables of the joins are gone after it."""
    chance = random.Random(3)
    lines = [" ".join(chance.choices("abc", [8, 3, 1], k=chance.randrange(4, 40))) for _ in range(40)]
    bags = [collections.Counter(line.split()) for line in lines]
    gone = {
        b
        for b in range(len(bags))
        for a in range(b)
        if 100 * (bags[a] & bags[b]).total() >= 80 * (bags[a] | bags[b]).total()
    }
    folder = f"{shared_dir(spark)}/llm/{spark.sparkContext.applicationId}"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    found = line_dedup.remove_later_lines(docs, tokens_of=line_dedup.words).collect()
    assert {row.doc_id for row in found if row.n_removed} == gone
    left = {name.split("-")[0] for name in set(os.listdir(folder)) - before}
    assert left <= {"lines", "line_sets", "line_pairs", "line_matches", "line_removed"}


def test_line_candidates_are_few(spark, monkeypatch):
    """Long lines that share words but are no copies: hardly any of them meet, the few near copies all do."""
    chance = random.Random(5)
    lines = [[f"w{chance.randrange(6000)}" for _ in range(chance.randrange(90, 180))] for _ in range(400)]
    for i in range(20):
        near = list(lines[i])
        for place in chance.sample(range(len(near)), i * len(near) // 100):
            near[place] = f"w{chance.randrange(6000)}"
        chance.shuffle(near)
        lines.append(near)
    bags = [collections.Counter(line) for line in lines]
    gone = {
        b
        for b in range(len(bags))
        for a in range(b)
        if 100 * (bags[a] & bags[b]).total() >= 80 * (bags[a] | bags[b]).total()
    }
    assert 5 < len(gone) < 20
    met = []
    stage = line_dedup.stage

    def counted(rows, name, *cut_by):
        found = stage(rows, name, *cut_by)
        if name == "line_pairs":
            met.append(found.count())
        return found

    monkeypatch.setattr(line_dedup, "stage", counted)
    docs = spark.createDataFrame([(i, " ".join(line)) for i, line in enumerate(lines)], "doc_id long, text string")
    found = line_dedup.remove_later_lines(docs, tokens_of=line_dedup.words).collect()
    assert {row.doc_id for row in found if row.n_removed} == gone
    assert sum(met) < 2 * len(lines)


@pytest.mark.parametrize("tokens_of", [line_dedup.words, line_dedup.shingles])
def test_lines_of_rows_that_share_an_id(spark, tokens_of):
    """A repeated line goes from the row that has it, not from other rows with its id or none."""
    known, near = passage(0, 60), passage(0, 59) + " other"
    rows = [(1, known)]
    for key, at in ((None, 100), (5, 200)):
        rows += [(key, f"{near}\n{passage(at, 20)}"), (key, f"{passage(at + 20, 20)}\n{passage(at + 40, 20)}")]
    rows += [(None, near)] * 3
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = line_dedup.remove_later_lines(table, tokens_of=tokens_of).collect()
    expected = [(key, text.replace(near, "").strip("\n")) for key, text in rows]
    assert sorted((str(r.doc_id), r.kept_text) for r in found) == sorted((str(key), text) for key, text in expected)


def test_quality_rules(docs, nothing, labels):
    assert rules.quality_rules(nothing, labels).count() == 0
    found = rules.quality_rules(docs, labels.limit(0)).collect()
    assert len(found) == len(ROWS)
    for row in found:
        words = space_words(row.text)
        seen = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        again = {i + j for i in range(len(words) - 4) if seen[tuple(words[i : i + 5])] > 1 for j in range(5)}
        assert (row.n_words, row.n_repeat_words) == (len(words), len(again))
        assert row.word_chars == sum(map(len, words))
        assert row.base_failed == (len(words) < 10 or 100 * len(again) > 20 * len(words))
        assert row.kept == (not row.base_failed)


def test_rules_are_learned(spark):
    rows = [(i, " ".join(f"x{i}y{j}{'###' if i % 3 == 0 else ''}" for j in range(30))) for i in range(300)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(300)], "doc_id long, quality int")
    kept = {row.doc_id for row in rules.quality_rules(table, labels).filter("kept").collect()}
    assert kept == {i for i in range(300) if i % 3}


def test_toxicity(spark, docs, nothing, labels):
    model = toxicity.Model({b"stupid": 9.0}, -4.0)
    assert toxicity.score(nothing, model).count() == 0
    for row in toxicity.score(docs, model).collect():
        assert row.predicted == int(row.doc_id == 7)
        assert 0 <= row.score <= 1 and (row.worst_start is None) == (not plain_words(row.text))
    assert toxicity.learn(nothing, labels).weights == {}
    rows = [(i, f"fine words {i % 7}. " + ("you clown" if i % 4 == 0 else "you there")) for i in range(400)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    scored = toxicity.score(table, toxicity.learn(table, marks)).collect()
    assert all(row.predicted == int(row.doc_id % 4 == 0) for row in scored)
    assert all(row.worst_start > 0 for row in scored if row.predicted)


def test_every_offending_sentence(spark):
    """All sentences at or above the threshold, with both ends; none of a clean text."""
    texts = [
        "Fine here. You stupid é man! Fine again.\nstupid stupid",
        "Fine here. Fine again.",
        "stupid. stupid. stupid",
        None,
        "",
    ]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = toxicity.Model({b"stupid": 5.0}, -4.0)
    found = {row.doc_id: row for row in toxicity.score(table, model).collect()}
    said = {i: [texts[i][s.start : s.end] for s in row.offending] for i, row in found.items()}
    assert said == {0: [" You stupid é man", "stupid stupid"], 1: [], 2: ["stupid", " stupid", " stupid"], 3: [], 4: []}
    assert [round(s.probability, 4) for s in found[0].offending] == [0.7311, 0.9975]
    assert (found[0].worst_start, round(found[0].worst_score, 4)) == (texts[0].index("stupid s"), 0.9975)


def test_site_quality(docs, nothing, labels):
    assert site_quality.site_quality(nothing, labels).count() == 0
    found = site_quality.site_quality(docs, labels).collect()
    assert len(found) == len(ROWS) and all(0 <= row.score <= 1 for row in found)


def test_near_duplicates_of_a_large_group(spark):
    """Copies with many edits, most of them linked with few others, against brute force."""
    chance = random.Random(5)
    texts = []
    for i in range(120):
        words = [f"v{j}" for j in range(150)]
        for place in chance.sample(range(150), i % 5):
            words[place] = f"e{chance.randrange(40)}"
        texts.append(" ".join(words))
    sets = [{tuple(t.split()[k : k + 5]) for k in range(146)} for t in texts]
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = near_dedup.near_duplicates(docs).collect()
    assert {row.doc_id: row.component_id for row in found} == dict(enumerate(root))


def test_one_row_of_each_component_stays(spark):
    """Rows that repeat id and text, rows of one id with near texts, copies without an id."""
    near = passage(0, 99) + " other"
    rows = [(7, passage(0, 100))] * 2 + [(7, near), (8, passage(0, 100)), (-1, passage(200, 50))]
    rows += [(None, passage(200, 50))] * 2 + [(None, passage(300, 50))] * 3 + [(None, None)] * 2 + [(9, " \n")] * 2
    table = spark.createDataFrame([(*row, i) for i, row in enumerate(rows)], "doc_id long, text string, place long")
    kept = near_dedup.drop_near_duplicates(table).collect()
    worded = [(row.doc_id, passage(200, 50) == row.text) for row in kept if row.text and row.text.strip()]
    assert sorted(map(str, worded)) == sorted(map(str, [(7, False), (-1, True), (None, False)]))
    assert sorted(row.place for row in kept if not (row.text and row.text.strip())) == [10, 11, 12, 13]


def test_parity_maps_bound_the_difference():
    chance = np.random.default_rng(3)
    for shared, more in [(0, 5), (100, 3), (3000, 40)]:
        both, a, b = (np.unique(chance.integers(0, 1 << 63, n)) for n in (shared, more, more))
        maps = [near_dedup.parity_map(np.union1d(both, own)) for own in (a, b)]
        assert int(np.bitwise_count((maps[0] ^ maps[1]).view(np.uint64)).sum()) <= len(a) + len(b)

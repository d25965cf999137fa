"""The pipeline, stage by stage against brute force on what each stage was given, and as a whole."""

import collections
import os
import re
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

import corpus_pipeline
from bazaarlake.llm import decontaminate, rules

# Names that operators add or use on the way: documents may have columns of their own so named.
CLASHING = [
    "n_words", "kept", "rule", "base_failed", "low", "held", "hits", "_hits", "matches", "items", "n_hit",
    "contaminated", "size", "target", "copies", "taken", "_name", "_digest", "_bucket", "shard", "slot",
    "grown_shard", "text_crc32", "root", "text_hash", "row", "_copy", "source_size", "_before", "_text",
]
BASE = "doc_id long, text string, lang string, source string, n_chars long"
SCHEMA = BASE + "".join(f", {c} string" for c in CLASHING)


def text(start, count):
    return " ".join(f"word{(start * 131 + i * 17) % 4001}" for i in range(count))


def documents():
    found = [(i, text(i, 60 + i), "en", f"s{i % 4}") for i in range(40)]
    found += [(100 + i, text(i, 60 + i), "de", "s0") for i in range(5)]  # exact copies
    found += [(110 + i, text(i, 60 + i) + " more", "de", "s1") for i in range(5)]  # near copies
    found += [(120, "too short", "en", "s1"), (121, "same five words again here " * 30, "en", "s2")]
    found += [(122, text(500, 30) + " " + text(900, 14) + " " + text(501, 30), "en", "s3")]  # benchmark passage
    found += [(123, None, "en", "s1"), (124, "", None, None), (125, " \n ", "en", "s1")]
    found += [(None, text(600, 80), "en", None), (None, text(600, 80), "en", None), (None, text(700, 80), "fr", "s2")]
    found += [(7, text(7, 67), "en", "s3"), (126, text(800, 20_000), "en", "s3")]
    return [(d, t, lang, s, len(t or "")) for d, t, lang, s in found]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("sf"))
    rows = [(*row, *[f"own-{c}" for c in CLASHING]) for row in documents()]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{root}/documents.parquet")
    labels = [(i, int(i % 5 > 0), 0) for i in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    items = [("b1", text(900, 14)), ("b2", "nowhere to be found at all in any of these texts"), ("b3", None)]
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def space_words(value):
    return re.findall(r"[^\x20\x09-\x0D]+", value or "")


def base_failed(value):
    words = space_words(value)
    windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            repeated.update(range(i, i + 5))
    return len(words) < 10 or 100 * len(repeated) > 20 * len(words)


def shingles(value):
    words = space_words((value or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def linked(texts):
    """Components of texts with a similarity of 0.85 or more."""
    sets = [shingles(t) for t in texts]
    root = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 85 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    return root


def jump(key, count):
    at, then = -1, 0
    while then < count:
        at = then
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        then = int((at + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return at


def own(rows):
    """Every row carries the values it came with, whatever an operator calls its columns."""
    return all(getattr(r, c) == f"own-{c}" for r in rows for c in CLASHING)


def plain(rows):
    return collections.Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in rows)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_duplicates", "decontamination", "source_mix", "shards"]

    def step(name, rows):
        found = stages[name](spark, rows, folder)
        assert found.columns[: len(docs.columns)] == docs.columns
        if name != "shards":
            assert found.columns == docs.columns
        return spark.createDataFrame(found.collect(), found.schema)

    good = step("quality_rules", docs)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    learned = rules.learn(rules.labelled_sample(docs.select("doc_id", "text"), labels))
    listed = rules.with_statistics(docs.select("doc_id", "text")).filter(~learned.rejects()).collect()
    allowed = {r.text for r in listed}
    expected = [d for d in documents() if not base_failed(d[1]) and d[1] in allowed]
    assert plain(good.collect()) == collections.Counter(expected) and own(good.collect())

    single = step("near_duplicates", good)
    before, after = good.collect(), single.collect()
    assert not plain(after) - plain(before) and own(after)
    root = linked([r.text for r in before])
    kept = collections.Counter(root[[b.text for b in before].index(r.text)] for r in after)
    assert set(kept) == set(root) and set(kept.values()) == {1}

    clean = step("decontamination", single)
    passage = text(900, 14).split()
    windows = [" ".join(passage[i : i + 10]) for i in range(5)]
    hit = [r for r in single.collect() if any(w in r.text for w in windows)]
    assert hit and plain(clean.collect()) == plain(r for r in single.collect() if r not in hit) and own(clean.collect())

    mixed = step("source_mix", clean)
    given, taken = plain(clean.collect()), plain(mixed.collect())
    assert set(taken) <= set(given) and all(n <= 2 * given[d] for d, n in taken.items()) and own(mixed.collect())
    total = sum(len(space_words(t)) * n for (_, t, *_), n in given.items())
    longest = max(len(space_words(t)) for _, t, *_ in given)
    assert abs(sum(len(space_words(t)) * n for (_, t, *_), n in taken.items()) - 1.5 * total) <= 4 * longest

    placed = stages["shards"](spark, mixed, folder).collect()
    assert plain(placed) == taken and own(placed)


def test_shards_without_clashing_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    placed = dict(corpus_pipeline.STAGES)["shards"](spark, docs, folder).collect()
    slots = collections.defaultdict(list)
    for r in placed:
        assert r.shard == jump(r.doc_id or 0, 16) and r.grown_shard in (r.shard, 16)
        assert r.size == len((r.text or "").encode()) + 1
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and len(placed) == len(documents())


def test_run_is_its_stages(spark, folder):
    """A run gives what its stages give one after the other, and can be written and read again."""
    found = corpus_pipeline.run(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, step in corpus_pipeline.STAGES:
        given = step(spark, docs, folder)
        docs = spark.createDataFrame(given.collect(), given.schema)
    assert plain(found.collect()) == plain(docs.collect()) and found.columns == docs.columns


def test_run_over_nothing(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ["labels", "benchmark"]:
        spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_many_benchmark_blocks(spark, folder):
    """Fifty blocks: as one block finds, with a few blocks in each pass."""
    docs = spark.createDataFrame(documents(), BASE).withColumn("hits", F.lit("mine"))
    items = [(f"i{k}", text(k, 25 + k % 9)) for k in range(60)] + [("s", "more"), ("n", None), (None, text(3, 30))]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    one = decontaminate.find_matches(docs, benchmark).collect()
    words = sum(len(t.split()) for _, t in items if t)
    passes = []
    stage = decontaminate.stage

    def counted(rows, name, *cut_by):
        if name == "found":
            plan = rows._jdf.queryExecution().analyzed().toString()
            passes.append(len(re.findall("MapInArrow", plan)))
        return stage(rows, name, *cut_by)

    decontaminate.stage = counted
    try:
        many = decontaminate.find_matches(docs, benchmark, block_words=words // 50).collect()
    finally:
        decontaminate.stage = stage
    assert len(passes) >= 10 and max(passes) == decontaminate.BLOCKS_AT_ONCE

    def said(rows):
        return collections.Counter(
            (r.doc_id, r.text, r.hits, r.n_words, r.n_hit, tuple(r.items), r.contaminated,
             tuple(sorted((m.word, m.item_id, m.item_word, m.words) for m in r.matches)))
            for r in rows
        )

    assert said(one) == said(many) and any(r.contaminated for r in one)


def test_workers_need_no_copy_of_the_package(tmp_path):
    """Operators that share models with their tasks, with the package on the driver's path only."""
    script = textwrap.dedent(
        f"""
        import sys
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate())
        sys.path.insert(0, {ROOT!r})
        from bazaarlake.llm import alignment, decontaminate, language, merkle, toxicity
        docs = spark.createDataFrame([(i, "you stupid thing " * (i % 4 + 4), "en", "s", 1) for i in range(40)],
                                     "doc_id long, text string, lang string, source string, n_chars long")
        labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
        items = spark.createDataFrame([("a", "you stupid thing you stupid thing you stupid thing you")], "item_id string, text string")
        assert toxicity.score(docs, toxicity.learn(docs, labels)).count() == 40
        assert decontaminate.find_matches(docs, items).filter("contaminated").count() == 40
        assert language.identify(docs, language.learn(docs)).filter("lang_pred = 'en'").count() == 40
        assert alignment.alignment(docs).count() == merkle.verify(docs).count() == 40
        print("done")
        """
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    found = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=400)
    assert found.stdout.strip().endswith("done"), found.stderr[-3000:]

"""What the learned operators learn, and what the scans find, against plain recomputation."""

import collections
import math
import os
import random
import re
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from bazaarlake.llm import licenses, mixing, rules, site_quality, toxicity


def sigmoid(z):
    return 1 / (1 + math.exp(-max(min(z, 30), -30)))


# --- toxicity -------------------------------------------------------------------------------


def probabilities(text, model):
    """Each sentence's probability, from the weights of the distinct features of its words."""
    found = []
    for _, _, words in toxicity.sentences(text):
        z = model.bias + sum(model.weights.get(f, 0.0) for w in words for f in toxicity.features_of(w))
        found.append(sigmoid(z))
    return found


def test_a_document_is_the_noisy_or_of_its_sentences(spark):
    model = toxicity.Model({b"bad": 2.0, b"wors*": 1.5, b"fine": -1.0}, -1.5)
    texts = ["bad one. fine one! worst of all", "fine\nfine\nfine", "bad " * 5 + ". " + "worse " * 3, "", None]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in toxicity.score(table, model).collect():
        p = probabilities(texts[row.doc_id], model)
        assert row.score == pytest.approx(1 - math.prod(1 - x for x in p), abs=1e-9)
        assert row.n_sentences == len(p)
        assert [s.probability for s in row.offending] == pytest.approx([x for x in p if x >= 0.5])


def test_the_fit_is_a_minimum_of_the_documents_loss():
    chance = random.Random(2)
    calm, rude = [f"calm{i}" for i in range(30)], ["awful", "rotten", "vile"]
    texts, toxic = [], []
    for i in range(400):
        bags = [" ".join(chance.choice(calm) for _ in range(6)) for _ in range(4)]
        if i % 3 == 0:
            bags[chance.randrange(4)] += " " + chance.choice(rude)
        texts.append(". ".join(bags))
        toxic.append(i % 3 == 0)
    model = toxicity.fit(texts, np.array(toxic))
    assert all(model.weights[w.encode()] > 1 for w in rude) and model.bias < 0

    def loss(weights, bias):
        total = 0.0
        for text, label in zip(texts, toxic):
            clean = 1.0
            for _, _, words in toxicity.sentences(text):
                present = {f for w in words for f in toxicity.features_of(w)}
                clean *= 1 - sigmoid(bias + sum(weights.get(f, 0.0) for f in present))
            total -= math.log(max(1 - clean, 1e-9)) if label else math.log(max(clean, 1e-300))
        return total / len(texts) + toxicity.DECAY / 2 * sum(w * w for w in weights.values())

    at = loss(model.weights, model.bias)
    for step in (0.25, -0.25):
        assert loss(model.weights, model.bias + step) > at
        for word in (b"awful", b"rotten", b"vile"):
            moved = {**model.weights, word: model.weights[word] + 8 * step}
            assert loss(moved, model.bias) > at - 1e-3
    # Far from the fit the loss is much higher, so the fit did go down.
    assert loss({}, -4.0) > at + 0.3


# --- mixing ---------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(3))
def test_taken_words_come_near_the_targets(spark, seed):
    chance = random.Random(seed)
    rows = []
    for i in range(1500):
        size = chance.choice([0, 1, 5, 40, 41, 300]) if i % 50 else chance.randrange(2000, 4000)
        rows.append((i, "w " * size, chance.choice(["hot", "hot", "hot", "b", "c", None])))
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken, target, longest = collections.Counter(), {}, collections.Counter()
    for row in mixing.mix(table).collect():
        taken[row.source] += row.taken
        target[row.source] = row.target
        longest[row.source] = max(longest[row.source], row.size)
        assert row.taken <= 2 * row.size
    for source, wanted in target.items():
        assert abs(taken[source] - wanted) <= longest[source]


# --- site quality ---------------------------------------------------------------------------


def shrunk(rows, key):
    """Posteriors and scores recomputed with plain sums."""
    p = {r[key]: sigmoid(r["evidence"]) for r in rows}
    hosts, paths = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        hosts[r["host"]].append(p[r[key]])
        paths[r["host"], r["path"]].append(p[r[key]])
    overall = min(max(sum(p.values()) / len(p), 0.01), 0.99)

    def strength(groups):
        some = [g for g in groups if len(g) >= 2]
        if len(some) < 2:
            return site_quality.MOST_STRENGTH
        n, total = sum(map(len, some)), sum(map(sum, some))
        mean = total / n
        spread = sum(sum(g) ** 2 / len(g) for g in some) - n * mean * mean - (len(some) - 1) * mean * (1 - mean)
        between = spread / (n - sum(len(g) ** 2 for g in some) / n)
        if between <= 0:
            return site_quality.MOST_STRENGTH
        found = mean * (1 - mean) / between - 1
        return min(max(found, site_quality.LEAST_STRENGTH), site_quality.MOST_STRENGTH)

    of_host, of_path = strength(hosts.values()), strength(paths.values())
    for r in rows:
        mine, host, path = p[r[key]], hosts[r["host"]], paths[r["host"], r["path"]]
        h = min(max((sum(host) - mine + of_host * overall) / (len(host) - 1 + of_host), 0.01), 0.99)
        q = min(max((sum(path) - mine + of_path * h) / (len(path) - 1 + of_path), 0.01), 0.99)
        joined = r["evidence"] - math.log(overall / (1 - overall)) + math.log(q / (1 - q))
        yield r[key], h, q, sigmoid(joined)


def learning_documents():
    chance = random.Random(4)
    rows, labels = [], []
    for i in range(300):
        good = i % 2
        words = [f"word{chance.randrange(200)}" for _ in range(40)]
        if not good:
            words = [w.upper() + "$$$" if chance.random() < 0.6 else "same" for w in words]
        rows.append((i, " ".join(words), f"s{i % 7}", "en" if i % 3 else None))
        labels.append((i, good))
    return rows, labels


def test_posteriors_by_hand(spark):
    rows, labels = learning_documents()
    rows += [(1000 + i, rows[i % 2][1], f"sparse{i}", "de") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    from pyspark.sql import functions as F

    measured = site_quality.measured(docs, "doc_id", F.col("source"), F.col("lang"), F.col("text"))
    model = site_quality.learn(measured, known)
    judged = site_quality.posteriors(measured, model, "doc_id").collect()
    expected = {k: rest for k, *rest in shrunk([r.asDict() for r in judged], "doc_id")}
    for r in judged:
        assert [r.host_posterior, r.path_posterior, r.score] == pytest.approx(expected[r.doc_id], abs=1e-9)
    plain = {r.doc_id: r.score for r in site_quality.site_quality(docs, known).collect()}
    assert plain == {r.doc_id: r.score for r in judged}


def test_the_site_of_a_page_changes_a_verdict(spark):
    """Doubtful pages are kept on a good site and go on a bad one; a sparse site stays near the mean."""
    rows, labels = learning_documents()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    good, bad = (next(t for i, t, *_ in rows if i % 2 == g) for g in (1, 0))
    doubtful = " ".join(f"w{i}" + ("$" if i % 3 else "$$") for i in range(30)) + " " + " ".join(["same"] * 4)

    def page(body):
        return f"<html><script>var a = '<p>no</p>';</script><body><p>{body}</p><!-- x --></body></html>"

    pages = [(i, f"http://Good.example.com/en/{i}", page(good)) for i in range(60)]
    pages += [(100 + i, f"https://bad.example.com/en/{i}.html?x=1", page(bad)) for i in range(60)]
    pages += [(200, "http://good.example.com/en/z", page(doubtful)), (201, "http://bad.example.com/en/z", page(doubtful))]
    pages += [(202, "http://sparse.example.org", page(doubtful)), (203, None, None), (204, "no address", ""), (204, "no address", "")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {r.page_id: r for r in site_quality.page_quality(table, docs, known).collect()}
    assert len(found) == len(pages) - 1
    assert (found[0].site, found[0].section) == ("good.example.com", "en")
    assert (found[202].site, found[202].section, found[203].site) == ("sparse.example.org", None, None)
    assert found[200].evidence == found[201].evidence == found[202].evidence
    assert found[200].score > found[202].score > found[201].score
    assert found[200].kept and not found[201].kept
    assert all(found[i].kept for i in range(60)) and not any(found[100 + i].kept for i in range(60))
    # The sparse site's share stays nearer the mean of all than those of the large sites.
    shares = [found[i].host_posterior for i in (201, 202, 200)]
    assert shares == sorted(shares)
    nothing = spark.createDataFrame([], "page_id long, url string, html string")
    assert site_quality.page_quality(nothing, docs, known).count() == 0


# --- quality rules --------------------------------------------------------------------------


def test_counts_by_hand(spark):
    texts = ["a b\na b\n\n a b\nc", "#x *y* |z| <w> 100% & $5", "one two three four five " * 3, "", None, " \n \n", "a\n" * 5]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in rules.with_statistics(table).collect():
        text = texts[row.doc_id] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
        windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        again = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
        assert row.n_words == len(words) and row.word_chars == sum(map(len, words))
        assert row.n_symbols == len(re.findall(r"[#*$%&|<>]", text))
        assert row.n_dup_lines == len(lines) - len(set(lines))
        assert row.n_repeat_words == len(again)


def test_the_best_first_condition_of_all(spark):
    """Sequential covering's first condition against every cut between two values of every feature."""
    chance = random.Random(6)
    rows, labels = [], []
    for i in range(240):
        low = i % 4 == 0
        words = [f"w{chance.randrange(500)}" for _ in range(chance.randrange(20, 80))]
        if low:
            words = [w + "###" for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, int(not low)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    learned = rules.learn(rules.labelled_sample(docs, known))
    rejected = {r.doc_id for r in rules.with_statistics(docs).filter(learned.rejects()).collect()}
    assert rejected == {i for i in range(240) if i % 4 == 0}
    assert len(learned.rules) == 1 and learned.rules[0].conditions[0].feature in ("symbol_share", "mean_word")
    assert learned.rules[0].conditions[0].above


def test_counts_of_conditions_by_hand(spark):
    chance = random.Random(7)
    values = [(chance.randrange(10), chance.randrange(5), bool(chance.randrange(2))) for _ in range(200)]
    names = list(rules.FEATURES)
    table = spark.createDataFrame(
        [(float(a), float(b), 0.0, 0.0, 0.0, low) for a, b, low in values],
        ", ".join(f"{n} double" for n in names) + ", low boolean",
    )
    cuts = {names[0]: [2.0, 5.0, 8.0], names[1]: [1.0]}
    found = {(c.feature, c.above, c.cut): (low, other) for low, other, c in rules._scored(table, cuts)}
    assert len(found) == 8
    for (feature, above, cut), counts in found.items():
        column = names.index(feature)
        inside = [low for *v, low in values if (v[column] > cut) == above]
        assert counts == (sum(inside), len(inside) - sum(inside))


# --- licenses -------------------------------------------------------------------------------


def test_spans_of_damaged_notices(spark):
    """Every notice inside other words: whole, with a word put in, with a word left out."""
    rows, expected = [], {}
    for n, (notice, label) in enumerate(licenses.NOTICES.items()):
        words = notice.split()
        middle = len(words) // 2
        for k, body in enumerate([words, [*words[:middle], "very", *words[middle:]], words[:middle] + words[middle + 1 :]]):
            text = ["start"] * 5 + body + ["stop"] * 4
            rows.append((10 * n + k, " ".join(text).upper() + "."))
            grams = {tuple(words[i : i + 3]) for i in range(len(words) - 2)}
            held = {tuple(text[i : i + 3]) for i in range(len(text) - 2)}
            expected[10 * n + k] = (label, len(grams & held) / len(grams), len(text))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for row in licenses.scan(table).collect():
        label, share, n_words = expected[row.doc_id]
        assert row.n_words == n_words
        if share >= licenses.LEAST_SHARE:
            assert label in row.labels.split(",")
            span = max((s for s in row.spans if s.label == label), key=lambda s: s.share)
            assert span.share == pytest.approx(share) and 5 <= span.first and span.last <= n_words - 5
        if row.doc_id % 10 == 0:
            assert row.score == 1.0 and (span.first, span.last) == (5, n_words - 5)


def test_whole_licenses(spark):
    """The bodies of licenses, wrapped and with other names in them, and texts that only cite them."""
    rows = []
    for n, (body, _) in enumerate(licenses.BODIES.items()):
        wrapped = re.sub(r"((?:\S+\s+){9})", r"\1\n * ", body)
        rows.append((n, "/* Copyright 2020 Somebody\n" + wrapped.replace("copyright holders", "owners") + "*/ int main() {}"))
    rows.append((100, "The software is provided as a service and the rights to use it are limited. " * 3))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.scan(table).collect()}
    for n, label in enumerate(licenses.BODIES.values()):
        assert label in found[n].labels.split(","), (n, label, found[n].labels)
        assert max(s.last - s.first for s in found[n].spans) > 60
    assert found[100].labels == ""

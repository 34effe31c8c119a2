"""Brute force for the classifiers and the decision list; very long texts, clashing columns, ties and repeated rows of every operator."""

import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import WORD
from tremor.llm import chat, common, decontaminate, line_dedup, quality, rules, toxicity, url_filter
from tremor.llm.docstats import FEATURES, document_stats

#: Names that operators give to columns of their own.
CLASHES = ["row", "c0", "toxicity", "old", "new", "doc", "lost", "line", "norm", "at", "found", "sig", "root", "key", "band", "obs", "features", "y", "fold", "score", "kept"]


def labelled_corpus(n=300, seed=4):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        good, toxic = i % 4 > 0, i % 9 == 0
        words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(rng.randint(55, 90))]
        if toxic:
            words[rng.randrange(50)] = "vileworm"
        docs.append((i, (" " if good else " #| ").join(words)))
        labels.append((i, int(good), int(toxic)))
    return docs, labels


def frames(spark, docs, labels):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def isotonic(y, w):
    """The isotonic fit by its minimax formula."""
    n = len(y)
    mean = lambda i, j: sum(w[k] * y[k] for k in range(i, j + 1)) / sum(w[i : j + 1])
    return [max(min(mean(i, j) for j in range(k, n)) for i in range(k + 1)) for k in range(n)]


def test_quality_scores_by_brute_force(spark):
    """Ridge by least squares on stacked rows, folds left out one by one, minimax isotonic steps."""
    docs, labels = labelled_corpus()
    d, told = frames(spark, docs, labels)
    got = {r.doc_id: r.score for r in quality.classify(d, told).collect()}
    stats = {r.doc_id: r.features for r in document_stats(d, ["doc_id"]).select("doc_id", "features").collect()}
    x = np.array([stats[i] for i, _ in docs])
    mean, std = x.mean(axis=0), x.std(axis=0)
    fourier = quality.Fourier(mean, np.where(std > 1e-9, std, 1))
    phi = fourier(x)
    fold = dict(d.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(quality.FOLDS))).collect())
    learn = np.array([zlib.crc32(str(i).encode()) % 4 != 2 for i, _ in docs])
    own, y = np.array([fold[i] for i, _ in docs]), np.array([q for _, q, _ in labels], float)

    def ridge(rows):
        a = phi[rows]
        k = a.shape[1]
        lam = quality.RIDGE * (1 + np.trace(a.T @ a) / k)
        return np.linalg.lstsq(np.vstack([a, math.sqrt(lam) * np.eye(k)]), np.concatenate([y[rows], np.zeros(k)]), rcond=None)[0]

    out = np.zeros(len(docs))
    for f in range(quality.FOLDS):
        out[own == f] = phi[own == f] @ ridge(learn & (own != f))
    bins = collections.defaultdict(list)
    for s, label in zip(out[learn], y[learn], strict=True):
        bins[min(max(int((s + 0.5) / 2 * quality.BINS), 0), quality.BINS - 1)].append((s, label))
    rows = [(np.mean([s for s, _ in b]), len(b), np.mean([v for _, v in b])) for _, b in sorted(bins.items())]
    level = isotonic([r[2] for r in rows], [r[1] for r in rows])
    blocks = collections.OrderedDict()
    for (s, n, _), v in zip(rows, level, strict=True):
        blocks.setdefault(round(v, 12), []).append((s, n))
    at = [sum(s * n for s, n in b) / sum(n for _, n in b) for b in blocks.values()]
    want = np.clip(np.interp(phi @ ridge(learn), at, list(blocks)), 0, 1)
    assert max(abs(got[i] - v) for (i, _), v in zip(docs, want, strict=True)) < 1e-6


def test_label_model_by_plain_loops():
    rng = np.random.default_rng(6)
    truth = rng.random(200) < 0.3
    votes = np.stack([np.where(truth, rng.random(200) < a, rng.random(200) < b) for a, b in ((0.8, 0.05), (0.6, 0.1), (0.5, 0.02))], axis=1).astype(float)
    votes = np.hstack([votes, votes[:, :1]])  # two that always agree
    prior, rounds = 0.3, 5
    rows = [[int(v) for v in r] + [int(not r.any())] for r in votes]
    q, most, k, n = [0.02 if r[-1] else 0.8 for r in rows], {}, 5, len(rows)
    for _ in range(rounds):
        a = [(sum(p for p, r in zip(q, rows, strict=True) if r[j]) + 0.2) / (sum(q) + 1) for j in range(k)]
        b = [(sum(1 - p for p, r in zip(q, rows, strict=True) if r[j]) + 0.02) / (n - sum(q) + 1) for j in range(k)]
        rest = [[r[j] - p * a[j] - (1 - p) * b[j] for j in range(k)] for p, r in zip(q, rows, strict=True)]
        spread = [math.sqrt(sum(e[j] ** 2 for e in rest) / n) + 1e-6 for j in range(k)]
        for i in range(k):
            for j in range(k):
                if i != j:
                    most[i, j] = max(most.get((i, j), 0), abs(sum(e[i] * e[j] for e in rest) / n / spread[i] / spread[j]))
        weight = [math.log(a[j] / b[j]) / math.sqrt(1 + sum(v for (i, _), v in most.items() if i == j and v > 0.1)) for j in range(k)]
        q = [1 / (1 + math.exp(-(math.log(prior / (1 - prior)) + sum(w for w, v in zip(weight, r, strict=True) if v)))) for r in rows]
    model = toxicity.label_model(votes, prior, rounds)
    assert np.allclose(model.weight, weight) and np.allclose(model.posterior(np.array(rows, float)), q)


def test_first_condition_is_the_best_of_all():
    """With few distinct values every cut is tried: the gain of what was grown is the largest there is."""
    rng = np.random.default_rng(2)
    x = rng.integers(0, 6, (400, len(FEATURES))).astype(float)
    bad = (x[:, 3] > 3) & (rng.random(400) < 0.8) | (rng.random(400) < 0.1)
    p, n = bad.sum(), (~bad).sum()

    def gain(rows):
        tp, all_ = (rows & bad).sum(), rows.sum()
        return tp * (math.log2(tp / all_) - math.log2(p / (p + n))) if tp else -1.0

    best = max(gain(side) for j in range(x.shape[1]) for c in (0.5, 1.5, 2.5, 3.5, 4.5) for side in (x[:, j] > c, x[:, j] <= c))
    assert gain(rules._grow(x, bad)[0].holds(x)) == pytest.approx(best)


def test_list_is_applied_as_it_reads(spark):
    docs, labels = labelled_corpus(400, 7)
    docs += [(900, None), (901, ""), (3, docs[3][1]), (3, docs[3][1])]
    d, told = frames(spark, docs, labels)
    learned = rules.fit(d, told)
    assert learned
    stats = {r.doc_id: r.features for r in document_stats(d, ["doc_id"]).select("doc_id", "features").collect()}
    out = rules.apply_rules(d, told).collect()
    assert len(out) == len(docs) and sum(r.doc_id == 3 for r in out) == 3
    for r in out:
        x = np.array([stats[r.doc_id]])
        first = next((" AND ".join(map(str, rule)) for rule in learned if all(c.holds(x)[0] for c in rule)), None)
        assert (r.kept, r.rule) == ((False, "base") if r.base_failed else (first is None, first))


def test_equal_documents_and_labels_tie(spark):
    """Documents that are equal but for their labels teach nothing and are judged alike."""
    text = " ".join(f"w{k}" for k in range(80))
    d, told = frames(spark, [(i, text) for i in range(40)], [(i, i % 2, i % 2) for i in range(40)])
    assert {(r.kept, r.rule) for r in rules.apply_rules(d, told).collect()} == {(True, None)}
    for module in (quality, toxicity):
        assert len({r.score for r in module.classify(d, told).collect()}) == 1


LONG = " ".join(f"word{k % 977}" for k in range(150_000))  # over a megabyte
LINE = LONG.replace(" ", "")


@pytest.mark.parametrize("what", ["url", "quality", "toxicity", "chat", "lines", "rules", "decontamination"])
def test_very_long_texts(spark, what):
    docs, labels = labelled_corpus(60)
    d, told = frames(spark, [*docs, (1000, LONG + " vileworm"), (1001, LINE), (1002, LONG.replace(" ", "\n"))], labels)
    if what == "url":
        pages = [(1, "https://x.com/fr/" + "p" * 1_000_000, "<a href='//friend.net'>" + "z" * 1_000_000 + "<a href='//late.net'>"), (2, "https://late.net", None), (3, "https://" + "h" * 100_000 + ".org/", "")]
        got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
        assert len(got[1].path) == 1_000_004 and got[2].trust > 0 and got[3].rule == "org/"
    elif what in ("quality", "toxicity"):
        got = {r.doc_id: r for r in {"quality": quality, "toxicity": toxicity}[what].classify(d, told).collect()}
        assert len(got) == 63 and all(0 <= r.score <= 1 for r in got.values())
        assert what == "quality" or got[1000].hits >= 1  # its last word
    elif what == "chat":
        out = chat.parse(spark.createDataFrame([("c", 0, "user", "User: " + LINE), ("c", 1, "assistant", LONG.replace(" ", "\n"))], "conv_id string, turn int, role string, text string")).collect()
        assert sum(r.n_lines for r in out) == 150_001 and sum(len(r.text) for r in out) >= len(LINE) + len(LONG) - 8
    elif what == "lines":
        more = spark.createDataFrame([(2000, LINE + "yy\nshort"), (2001, LINE[:-1] + "q"), (2002, LINE[::-1])], "doc_id long, text string")
        got = {r.doc_id: (r.n_lines, r.n_kept) for r in line_dedup.line_counts(d.union(more)).collect()}
        assert got[1001] == (1, 1) and got[2000] == (2, 1) and got[2001] == (1, 0) and got[2002] == (1, 1) and got[1002][0] == 150_000 and got[1002][1] <= 977
    elif what == "rules":
        got = {r.doc_id: r for r in rules.apply_rules(d, told).collect()}
        assert (got[1000].n_words, got[1001].n_words, got[1001].word_chars) == (150_001, 1, len(LINE)) and got[1000].base_failed
    else:
        items = spark.createDataFrame([("i", " ".join(WORD.findall(LONG)[-11:]) + " vileworm")], "item_id string, text string")
        got = {r.doc_id: r for r in decontaminate.decontaminate(d, items).collect()}
        assert got[1000].n_words == 150_001 and got[1000].n_hit >= 12 and not got[1001].contaminated


def test_columns_of_any_name(spark):
    """Operators that pass rows on keep columns of every name as they were; the others don't look at them."""
    docs, labels = labelled_corpus(60)
    d, told = frames(spark, docs, labels)
    wide = d.select("*", *[F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in CLASHES])
    same = lambda out: all(r[c] == f"{c}-{r.doc_id}" for r in out for c in CLASHES if c not in ("toxicity", "found"))
    scored = toxicity.score(wide, toxicity.fit(wide, told)).collect()
    assert len(scored) == 60 and same(scored)
    kept = line_dedup.dedup_lines(wide)
    assert kept.columns == wide.columns and same(kept.collect())
    found = decontaminate.search_columns(wide, spark.createDataFrame([("i", "no such words at all")], "item_id string, text string")).collect()
    assert len(found) == 60 and same(found)
    assert quality.classify(wide, told).count() == rules.apply_rules(wide, told).count() == 60
    turns = spark.createDataFrame([("c", 0, "user", "User: hello\nthere"), ("c", 1, "assistant", "Bot: yes")], "conv_id string, turn int, role string, text string")
    out = chat.parse(turns.select("*", *[F.lit("z").alias(c) for c in CLASHES])).collect()
    assert [(r.role, r.text) for r in sorted(out, key=lambda r: r.turn)] == [("user", "hello\nthere"), ("assistant", "yes")]


def test_chat_ties_and_repeated_turns(spark):
    """Lines that show nothing and no labels: one role for all, the same in every run; repeated turns are lines of their own."""
    turns = spark.createDataFrame([("c", 0, None, "aaaa"), ("c", 0, None, "aaaa"), ("c", 1, None, "bbbb")] * 2, "conv_id string, turn int, role string, text string")
    one, two = (sorted(map(tuple, chat.parse(t).collect())) for t in (turns, turns.repartition(4)))
    assert one == two and sum(r[3] for r in one) == 6


@pytest.mark.parametrize("stage", range(4))
def test_stages_of_the_pipeline_take_any_rows(spark, tmp_path, stage):
    """Null ids and texts, repeated rows and clashing columns: clean rows stay as they were, all of them but copies."""
    docs, labels = labelled_corpus(40, 11)
    docs = [(i, t.replace("vileworm", "word")) for i, t in docs]
    rows = [*docs, (None, "a text without an id that stands alone here and is as clean as can be"), (500, None), (501, ""), (502, "one two")]
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    told.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([("i", "ten words of a benchmark that no document of ours has at all")], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    d = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "k", "r") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, key string, row string")
    name, run = corpus_pipeline.STAGES[stage]
    out = run(spark, d, str(tmp_path))
    assert out.columns == d.columns and out.dtypes == d.dtypes
    key = lambda r: repr((r.doc_id, r.text))
    got = sorted(out.collect(), key=key)
    want = sorted(d.collect(), key=key)
    if name == "toxicity":  # words that by chance stand in toxic documents only may cost a few
        assert len(got) >= 0.9 * len(want) and set(map(key, got)) <= set(map(key, want))
    else:
        assert got == want


def test_driver_heap_is_given_back_after_a_table(spark, monkeypatch):
    """What the driver's JVM no longer uses goes when a table is written, if its heap is over its share."""
    monkeypatch.setattr(common, "GROWN", 0)
    garbage = spark._jvm.java.util.ArrayList()
    left = spark._jvm.java.lang.ref.WeakReference(garbage)
    del garbage
    assert common.cut(spark.range(3)).count() == 3
    assert left.get() is None

"""Each operator against brute force or exact round trips, with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import collections
import hashlib
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tremor.llm import bpe, chat, decontaminate, line_dedup, minhash, ngram_join, quality, repeats, rules, toxicity, url_filter
from tremor.llm.graph import components

DOCS = "doc_id long, text string, lang string, root string, sig string, n string, key string, ids string, found string"
EXTRA = ("x",) * 7
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows] if schema == DOCS else rows, schema)


def corpus(seed=0, n=40):
    """Random texts with near copies, repeated passages, odd characters, and every special case."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdeéß漢", k=rng.randint(1, 6))) for _ in range(300)]
    passage = " ".join(rng.choices(vocabulary, k=70))
    rows = []
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.randint(1, 160))
        text = " ".join(words)
        if i % 4 == 1 and rows[-1][1]:
            words = rows[-1][1].split(" ")
            words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)
        if i % 5 == 2:
            text = f"{text}\n{passage} {text[:20]}"
        if i % 7 == 3:
            text = text.replace(" ", "\n", 5)
        rows.append((i, text))
    long_ = " ".join(rng.choices(vocabulary, k=20_000))
    return rows + [(100, None), (101, ""), (102, " \n\t "), (103, rows[0][1]), (103, rows[0][1]), (104, long_), (None, rows[2][1]), (105, "x"), (106, "x y"), (107, "X  Y"), (108, "aaaa" * 200), (109, "漢" * 100)]


def union_find(pairs, nodes):
    up = {x: x for x in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    return {x: root(x) for x in nodes}


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(k, k + 1) for k in range(100, 140)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = union_find(pairs, {x for p in pairs for x in p})
    assert all(want[x] == got.get(x, x) for x in want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_ngram_join(spark):
    rows = corpus()
    got = collections.defaultdict(list)
    for r in ngram_join.join_components(frame(spark, rows)).collect():
        got[r.doc_id].append((r.n_shingles, r.component_id))
    sets = []
    for i, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append((i, {tuple(w[k : k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()))
    some = [(i, s) for i, s in sets if s and i is not None]
    pairs = [(a, b) for a, x in some for b, y in some if 100 * len(x & y) >= 85 * len(x | y)]
    least = union_find(pairs, {i for i, _ in some})
    assert sum(a != b for a, b in pairs) > 10
    for i, s in sets:
        assert (len(s), least.get(i, i)) in got[i]
    assert sum(map(len, got.values())) == len(rows)
    assert ngram_join.join_components(frame(spark, [])).count() == 0


def test_ngram_join_deals_large_components_in_blocks(spark):
    rng = random.Random(5)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for i in range(60):
        words = list(base)
        words[rng.randrange(200)] = f"z{i}"
        rows.append((i, " ".join(words)))
    assert {r.component_id for r in ngram_join.join_components(frame(spark, rows), block=7).collect()} == {0}


def test_decontamination(spark):
    rows = corpus(1)
    bench = [(1, " ".join(rows[3][1].split()[:12])), (2, "X y"), (3, None), (4, ""), (None, "changed"), (5, "never there at all"), (2, "X y"), (6, rows[8][1].upper())]
    items = spark.createDataFrame(bench, "item_id long, text string")
    words = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: words.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    for part in (1 << 20, 30):
        got = decontaminate.decontaminate(frame(spark, rows), items, part_bytes=part).collect()
        want = []
        for i, t in rows:
            w, hit, who = split(t), set(), set()
            for item, text in bench:
                v = split(text)
                m = min(10, len(v))
                wins = {tuple(v[k : k + m]) for k in range(len(v) - m + 1)} if m else set()
                for k in range(len(w) - m + 1):
                    if m and tuple(w[k : k + m]) in wins:
                        hit |= set(range(k, k + m))
                        who |= {item} - {None}
            ids = ",".join(sorted(map(str, who)))
            want.append((i, len(w), len(hit), len(who), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
        assert sorted(map(repr, (tuple(r[:6]) for r in got))) == sorted(map(repr, want))
    assert not any(r.contaminated for r in decontaminate.decontaminate(frame(spark, rows), items.limit(0)).collect())
    assert decontaminate.decontaminate(frame(spark, []), items).count() == 0


def test_parts_of_a_benchmark_are_built_once_for_much_text():
    """Tables of one part exist at a time; with one part they are built once, with three once for each text that is held, but for the one that the next text begins with."""

    class Part:
        loads = 0

        def __init__(self, items):
            self.items = items

        @property
        def value(self):
            Part.loads += 1
            return self.items

    rng = random.Random(3)
    words = [f"w{k}" for k in range(40)]
    docs = [" ".join(rng.choices(words, k=30)) for _ in range(64)]
    items = [[(f"i{k}", " ".join(docs[5 * k].split()[3:9]))] for k in range(3)]
    batches = [pa.record_batch([pa.array(range(i, i + 8)), pa.array(docs[i : i + 8])], names=["row", "text"]) for i in range(0, 64, 8)]
    size = sum(map(len, docs))
    want = [decontaminate.hits_of(tuple(decontaminate.words_of(d)), [decontaminate.searches([x for part in items for x in part], 4)])[0] for d in docs]
    for parts, most, loads in ((items, size * 2, 3), (items, size // 4 + 1, 3 + 2 * 3), ([sum(items, [])], size // 4 + 1, 1)):
        Part.loads = 0
        got = [r for b in decontaminate.search_batches(iter(batches), [Part(p) for p in parts], 4, most) for r in b.to_pylist()]
        assert [r["row"] for r in got] == list(range(64)) and [list(zip(r["found"]["hits"][::2], r["found"]["hits"][1::2], strict=True)) for r in got] == want
        assert Part.loads <= loads + 2
    assert sum(map(bool, want)) >= 3


@pytest.mark.parametrize("length,gram,crowd", [(200, 96, 8192), (20, 8, 8192), (20, 10, 1)])
def test_repeats(spark, length, gram, crowd):
    rows = corpus(2)
    got = sorted(repr((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in repeats.remove_repeats(frame(spark, rows), length, gram, crowd).collect())
    data = [(i, (t or "").encode()) for i, t in rows]
    count = collections.Counter(d[k : k + length] for _, d in data for k in range(len(d) - length + 1))
    want = []
    for i, d in data:
        mark = bytearray(len(d))
        for k in range(len(d) - length + 1):
            if count[d[k : k + length]] > 1:
                mark[k : k + length] = b"\1" * length
        kept = bytes(c for c, m in zip(d, mark, strict=True) if not m)
        want.append(repr((i, len(d), sum(mark), sum(m and not (k and mark[k - 1]) for k, m in enumerate(mark)), hashlib.sha256(kept).hexdigest())))
    assert got == sorted(want)
    assert repeats.remove_repeats(frame(spark, [])).count() == 0


def test_index_marks_windows_that_repeat():
    rng = random.Random(2)
    for _ in range(200):
        size = rng.choice([4, 8, 20])
        base = bytes(rng.choice(b"ab") for _ in range(60)) * 4
        parts = []
        for _ in range(rng.randint(1, 12)):
            at = rng.randint(0, 60)
            part = bytearray(base[at : at + rng.randint(size, 3 * size)])
            part[rng.randrange(len(part))] = rng.choice(b"abc")
            parts.append(bytes(part))
        count = collections.Counter(c[k : k + size] for c in parts for k in range(len(c) - size + 1))
        want = [w for c in parts for w in [*(k + size <= len(c) and count[c[k : k + size]] > 1 for k in range(len(c))), False]]
        assert repeats.repeated_windows(parts, size).tolist() == want


def test_bpe_equals_the_library_and_round_trips(spark):
    P = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    path = P.path("byte_bpe_multi_50k.tiktoken")
    odd = [(200, "a\x1cb \u2028 c\u3000d  e\n\n f 12½³ it's IT'S <|endoftext|> \U0001f600\u0301"), (201, "zqxj" * 30), (202, "  \t\n"), (203, "\x85\xa0x\u00ad")]
    rows = corpus(4) + odd
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    rows.append((204, "ab" * 400 + " x" * 20 + " " + "zqxj" * 300))
    for words in (1 << 17, 0):
        got = bpe.decode(bpe.encode(frame(spark, rows), path, P.PATTERN, words), path).collect()
        assert sorted(repr((r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded))) for r in got) == sorted(repr((i, own.encode_ordinary(t or ""), (t or "").encode())) for i, t in rows)
    assert bpe.round_trip(frame(spark, []), path, P.PATTERN).count() == 0


def test_long_words_take_linear_time():
    """Of a word of a megabyte as of short ones the merges are those of the library."""
    P = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    ranks = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(13)
    for n in [1, 2, 3, 10, 50, 600] * 20:
        word = "".join(rng.choices("abcdeéß漢thing", k=n)).encode()
        assert bpe.merge_heap(word, ranks) == own._encode_single_piece(word)
    began = time.perf_counter()
    ids = bpe.merge_heap("".join(rng.choices("abcdefgh", k=1 << 20)).encode(), ranks)
    assert time.perf_counter() - began < 60 and len(ids) > 1 << 17


def test_encoding_keeps_columns_of_any_name(spark):
    P = pytest.importorskip("public_tokenizers")
    path = P.path("byte_bpe_multi_50k.tiktoken")
    docs = spark.createDataFrame([(1, "one two", 5, "m", "r", 1.5, "d")], "doc_id long, text string, ids int, missing string, row string, `a.b` double, decoded string")
    out = bpe.decode(bpe.encode(docs, path, P.PATTERN), path)
    assert out.columns == ["doc_id", "text", "missing", "row", "a.b", "ids", "decoded"]
    r = out.first()
    assert (r["missing"], r["row"], r["a.b"], bytes(r["decoded"])) == ("m", "r", 1.5, b"one two")


def test_line_dedup(spark):
    base = "the quick brown fox jumps over the lazy dog near the river bank every single morning of the long summer while nobody is there to see it run past the old mill"
    near = base.replace("lazy", "tired")
    other = "an entirely different sentence about mountains and the weather that has nothing to do with the animals in the other line at all"
    rows = [(1, f"{base}\n\nfirst"), (2, f"{near}\n{other}"), (3, other.upper()), (3, other.upper()), (4, None), (5, ""), (6, f"first \n{other} indeed it does not"), (None, "alone here"), (7, "\n \n")]
    docs = frame(spark, rows)
    got = {(r.doc_id, r.n_lines): (r.n_kept, r.removed_at) for r in line_dedup.line_counts(docs).collect()}
    assert got[1, 2] == (2, "") and got[2, 2] == (1, "0") and got[3, 1] == (0, "0") and got[4, 0] == (0, "") and got[6, 2][1].startswith("0") and got[None, 1] == (1, "")
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[1] == rows[0][1] and texts[2] == other and 3 not in texts and texts[4] is None and texts[5] == "" and texts[7] == "\n \n"
    assert line_dedup.line_counts(frame(spark, [])).count() == 0


def test_line_dedup_finds_similar_lines(spark):
    """Of pairs at or over the threshold nearly all are found, and none below it."""
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(500)]
    lines = []
    for _ in range(60):
        line = rng.choices(words, k=40)
        lines += [line, [*line[:20], "edited", *line[21:]], [w if k % 4 else "noise" for k, w in enumerate(line)]]
    rows = [(i, " ".join(x)) for i, x in enumerate(lines)]
    kept = {r.doc_id for r in line_dedup.line_counts(frame(spark, rows)).where("n_kept = 1").collect()}

    def shingles(t):
        return {t[k : k + line_dedup.GRAM] for k in range(len(t) - line_dedup.GRAM + 1)}

    def similar(a, b):
        x, y = shingles(rows[a][1]), shingles(rows[b][1])
        return len(x & y) >= 0.8 * len(x | y)

    for k in range(0, len(rows), 3):
        assert k in kept and k + 2 in kept
    due = [k for k in range(0, len(rows), 3) if similar(k, k + 1)]
    assert len(due) > 30 and sum(k + 1 not in kept for k in due) >= 0.95 * len(due)


def kept_lines(spark, texts):
    return [t for (_, t), r in zip(enumerate(texts), line_dedup.line_counts(frame(spark, list(enumerate(texts)))).orderBy("doc_id").collect(), strict=True) if r.n_kept]


def test_line_dedup_sees_words_to_their_end(spark):
    lines = ["https://example.com/a", "https://example.com/b/long", "* https://example.org/page/1", "* https://example.org/another/title", "import com.example.foo.A", "import com.example.bar.B", "0123456789abcdef01", "0123456789abfedc98"]
    assert kept_lines(spark, lines) == lines


def test_line_dedup_compares_all_lines_of_a_bucket(spark, monkeypatch):
    """In one bucket of lines that have nothing in common, each has a near copy."""
    rng = random.Random(9)
    lines = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=90)).strip() for _ in range(12)]
    copies = [t[:40] + "#" + t[41:] for t in lines]
    monkeypatch.setattr(minhash, "bands", lambda low, n: np.ones((len(low), n), np.int64))
    for block in (512, 5):
        monkeypatch.setattr(line_dedup, "BLOCK", block)
        assert kept_lines(spark, lines + copies) == lines


def test_line_dedup_finds_a_typo_in_a_usual_line(spark):
    lines = ["please send the signed form to our office before next friday", "please send the signed form to our ofgice before next friday", "第一章第二节所有学生都必须在星期五之前把签好的表格交到办公室否则不能参加考试也不能得到成绩单和毕业证书请注意", "第一章第二节所有学生都必须在星期五之前把签好的表格交到办公室否则不能参加考试也不能得到成绩单或毕业证书请注意"]
    assert kept_lines(spark, lines) == lines[::2]


def test_bands_find_lines_of_any_length():
    """Of pairs at 0.8 as few share no band among lines of 5 shingles as among long ones, and their sketches are near."""
    rng = random.Random(10)
    for union, n in ((5, 4000), (10, 4000), (20, 4000), (100, 2000), (1000, 300)):
        core = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789é漢", k=union + line_dedup.GRAM - 1)) for _ in range(n)]
        one = union // 10
        x, y = (minhash.signatures(pa.array(t), line_dedup.GRAM, 102) for t in ([t[one:] for t in core], [t[: len(t) - union // 5 + one] for t in core]))
        assert (minhash.bands(x, 17) != minhash.bands(y, 17)).all(axis=1).mean() < 0.012
        assert abs((x == y).mean() - 0.8) < 0.02
        far = sum(np.bitwise_count(a ^ b) for a, b in zip(minhash.sketch(x), minhash.sketch(y), strict=True))
        assert far.max() <= minhash.most_bits(102, 0.8)


def test_overlaps_equal_sets(monkeypatch):
    rng = random.Random(11)
    x = ["".join(rng.choices("abé漢\U0001f600", k=rng.randint(1, 60))) for _ in range(300)] + ["ab" * 3000]
    y = [t[: len(t) // 2] + rng.choice("abc") + t[len(t) // 2 :] for t in x]
    sets = lambda t: {t[k : k + 5] for k in range(max(1, len(t) - 4))}
    want = [(len(sets(a) & sets(b)), len(sets(a) | sets(b))) for a, b in zip(x, y, strict=True)]
    for step in (1 << 18, 97):
        monkeypatch.setattr(minhash, "STEP", step)
        assert list(zip(*minhash.overlaps(pa.array(x), pa.array(y), 5), strict=True)) == want
        assert [len(s) for s in minhash.shingle_sets(pa.array(x), 5)] == [len(sets(a)) for a in x]


def test_line_dedup_finds_twins_in_families(spark):
    """Many lines of one family are alike, but only twins are near copies; each of those is found, however many lines share its buckets."""
    rng = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz"
    frame_text = "".join(rng.choices(letters + "   ", k=110))
    lines, n = [], 1200
    for _ in range(n):
        own = frame_text[:55] + "".join(rng.choices(letters, k=22)) + frame_text[55:]
        lines += [own, own[:60] + "#" + own[61:]]
    rows = [(i, t) for i, t in enumerate(lines)]
    kept = {r.doc_id for r in line_dedup.line_counts(frame(spark, rows)).where("n_kept = 1").collect()}
    sets = [{t[k : k + 5] for k in range(len(t) - 4)} for t in lines]
    twin = np.mean([len(sets[k] & sets[k + 1]) >= 0.8 * len(sets[k] | sets[k + 1]) for k in range(0, 2 * n, 2)])
    other = [len(sets[0] & s) / len(sets[0] | s) for s in sets[2:]]
    assert twin == 1 and 0.6 < np.mean(other) and max(other) < 0.8
    assert all(k in kept for k in range(0, 2 * n, 2)) and sum(k + 1 not in kept for k in range(0, 2 * n, 2)) >= 0.99 * n


def test_statistics_and_rules(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(400):
        good = i % 3 > 0
        words = ["".join(rng.choices("abcdef", k=rng.randint(2, 7))) for _ in range(rng.randint(60, 200))]
        rows.append((i, " ".join(w if good or k % 2 else w + "%%%" for k, w in enumerate(words)) + ("\nend of it\nend of it" if i % 5 == 0 else "")))
        labels.append((i, int(good), 0))
    rows += [(500, None), (501, ""), (502, "a b c " * 40), (None, "short")]
    got = {r.doc_id: r for r in rules.apply_rules(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    for i, t in rows:
        w = WORD.findall(t or "")
        seen, dups = set(), 0
        for line in (t or "").split("\n"):
            if WORD.search(line):
                dups += line in seen
                seen.add(line)
        runs = collections.Counter(zip(w, w[1:], w[2:], strict=False))
        again = {k + j for k in range(len(w) - 2) if runs[tuple(w[k : k + 3])] > 1 for j in range(3)}
        failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), dups, len(again), failed)
        assert not (failed and r.kept)
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([got[i].kept == bool(labels[i][1]) for i in held]) > 0.95
    none = rules.apply_rules(frame(spark, rows), spark.createDataFrame([], "doc_id long, quality int"))
    assert none.where("kept = base_failed").count() == 0


def test_classifiers_on_held_out_rows(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(900):
        toxic, good = i % 8 == 0, i % 5 > 0
        words = ["".join(rng.choices("abcdef", k=rng.randint(2, 7))) for _ in range(80)]
        if toxic:
            for _ in range(3):
                words[rng.randrange(80)] = rng.choice(["grumzle", "vileworm", "Idiot"]) if i % 16 else "hexor" + rng.choice(["ab", "cd", "ef", "gh"])
        rows.append((i, (" " if good else " | ").join(words)))
        labels.append((i, int(good), int(toxic)))
    rows += [(1000, None), (1001, ""), (None, "idiot idiot moron scum"), (3, rows[3][1])]
    labels += [(5, None, None), (None, 1, 1), (7777, 1, 1), (6, labels[6][1], labels[6][2])]
    docs, told = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for module, column, cut in ((quality, 1, 0.7), (toxicity, 2, 0.3)):
        got = module.classify(docs, told).collect()
        assert len(got) == len(rows)
        by = {r.doc_id: r for r in got}
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= cut) for r in got)
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None) and not by[None].held_out
        held = [i for i in range(900) if by[i].held_out]
        assert np.mean([by[i].predicted == labels[i][column] for i in held]) > 0.95
        # Labels of held-out rows make no difference.
        turned = told.withColumns({c: F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col(c)).otherwise(F.col(c)) for c in ("quality", "toxic")})
        again = {r.doc_id: r.score for r in module.classify(docs, turned).collect()}
        assert all(abs(again[i] - by[i].score) < 1e-9 for i in again)
        assert module.classify(docs, told.limit(0)).count() == len(rows)
        assert module.classify(docs.limit(0), told).count() == 0


def test_label_model_orders_voters_by_accuracy():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.2
    fire = lambda a, b: np.where(y, rng.random(4000) < a, rng.random(4000) < b).astype(float)
    good, fair = np.stack([fire(0.7, 0.01), fire(0.6, 0.02), fire(0.65, 0.01)], axis=1), fire(0.5, 0.1)[:, None]
    votes = np.hstack([good, fair])
    model = toxicity.label_model(votes, 0.2)
    assert model.weight[:3].min() > model.weight[3] > 0 > model.weight[-1]
    full = np.hstack([votes, votes.sum(axis=1, keepdims=True) == 0])
    assert np.mean((model.posterior(full) > 0.5) == y) > 0.85
    # Two voters that always agree count less each than one of them alone.
    assert toxicity.label_model(np.hstack([votes, fair]), 0.2, rounds=1).weight[3] < 0.85 * toxicity.label_model(votes, 0.2, rounds=1).weight[3]


def test_url_rules_and_propagation(spark):
    link = lambda h: f'<a href="https://{h}/x">y</a>'
    pages = [
        (1, "https://a.example.org/en/12", ""), (2, "http://EXAMPLE.org/es/1?q", ""), (3, "https://x.com/fr/", link("friend.net") * 2), (4, "https://y.com/de/1#f", ""), (5, "http://spam.net/p", link("y.com") + link("pal.net")),
        (6, "https://friend.net/z", None), (7, None, "x"), (8, "nothing", "<a href='//y.com'>"), (9, "https://notexample.org", ""), (10, "https://lone.net/fr/", ""), (5, "http://spam.net/p", ""), (11, "http://feeder.net", link("spam.net")), (12, "a://b.com", ""),
    ]
    frame_ = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in url_filter.judge(frame_).collect()}
    want = {1: ("example.org/en/1", "block"), 2: ("example.org/es/", "block"), 3: ("com/fr/", "allow"), 4: ("com/de/", "block"), 5: (None, "block"), 6: (None, "allow"), 7: (None, "allow"), 8: (None, "allow"), 9: (None, "allow"), 10: (None, "allow"), 11: (None, "block"), 12: (None, "allow")}
    assert {k: (r.rule, r.verdict) for k, r in got.items()} == want
    assert (got[2].host, got[2].path) == ("example.org", "/es/1") and (got[7].host, got[7].path) == ("", "") and (got[9].host, got[9].path) == ("notexample.org", "")
    assert got[6].trust > 0 and got[5].distrust > got[11].distrust > 0
    assert url_filter.judge(frame_.limit(0)).count() == 0 and url_filter.judge(frame_, rules=()).where("verdict = 'block'").count() == 0


def test_propagation_equals_power_iteration(spark):
    rng = random.Random(1)
    edges = sorted({(rng.randrange(9), rng.randrange(9)) for _ in range(30)})
    edges = [(f"h{a}", f"h{b}", float(1 + (a + b) % 3)) for a, b in edges if a != b]
    got = {r.host: (r.trust, r.distrust) for r in url_filter.propagate(spark.createDataFrame(edges, "src string, dst string, w double"), spark.createDataFrame([("h0", 2, 0), ("h1", 1, 3)], "host string, allowed long, blocked long"), rounds=8).collect()}
    for kind, seeds, way in ((0, {"h0": 2 / 3, "h1": 1 / 3}, lambda a, b: (a, b)), (1, {"h1": 1.0}, lambda a, b: (b, a))):
        out = collections.Counter()
        for a, b, w in edges:
            out[way(a, b)[0]] += w
        start = {h: 0.15 * v for h, v in seeds.items()}
        now = dict(start)
        for _ in range(8):
            new = collections.Counter(start)
            for a, b, w in edges:
                s, d = way(a, b)
                new[d] += 0.85 * now.get(s, 0) * w / out[s]
            now = new
        assert all(abs(got[h][kind] - v) < 1e-12 for h, v in now.items())


def test_propagation_goes_far_and_does_not_shrink_with_the_table(spark):
    """A chain of 30 hosts that leads to a blocked one is found, also when ten million other pages are blocked."""
    chain = [(f"h{k}", f"h{k + 1}", 1.0) for k in range(30)]
    edges = spark.createDataFrame(chain, "src string, dst string, w double")
    for others in (0, 10_000_000):
        seeds = spark.createDataFrame([("h30", 0, 1), ("far", 1, others)], "host string, allowed long, blocked long")
        got = {r.host: r for r in url_filter.propagate(edges, seeds).collect()}
        for k in range(31):
            assert got[f"h{k}"].distrust * (1 + others) == pytest.approx(0.15 * 0.85 ** (30 - k), rel=1e-9) and got[f"h{k}"].trust == 0


def test_chat_roles(spark):
    rng = random.Random(3)
    text = lambda k: "\n".join(" ".join(rng.choices(["alpha", "beta", "gamma"], k=k)) for _ in range(rng.randint(1, 3)))
    rows = []
    for c in range(60):
        roles = (["system"] if c % 3 == 0 else []) + ["user", "assistant"] * rng.randint(1, 3)
        mark = {"system": "System: ", "user": "Human: ", "assistant": "AI: "}
        rows += [(c, t, r, mark[r] + text({"system": 5, "user": 4, "assistant": 30}[r])) for t, r in enumerate(roles)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = collections.defaultdict(list)
    for r in chat.parse(turns).orderBy("conv_id", "turn").collect():
        got[r.conv_id].append((r.role, r.text))
        assert r.rendered == f"<|{r.role}|>\n{r.text}\n<|end|>"
    strip = {"system": "System: ", "user": "Human: ", "assistant": "AI: "}
    for c in range(60):
        assert got[c] == [(r, t.removeprefix(strip[r])) for k, _, r, t in rows if k == c]
    odd = spark.createDataFrame([(1, None, None, None), (None, 0, "user", ""), (2, 0, "owl", "User: hi"), (2, 0, "owl", "User: hi")], turns.schema)
    assert sum(r.n_lines for r in chat.parse(odd).collect()) == 4
    assert chat.parse(turns.limit(0)).count() == 0


def test_viterbi_stream_equals_whole():
    rng = np.random.default_rng(0)
    log = lambda *s: np.log(rng.dirichlet(np.ones(s[-1]), s[:-1]))
    model = chat.Model(log(3), log(2, 3, 3), log(3, chat.CODES))
    obs = rng.integers(0, chat.CODES, 500).tolist()
    path, got = chat.Path(model), []
    for o in obs:
        got += path.add(o)
    assert len(got) > 300  # most lines were out before the end
    got += path.end()
    score, back = model.start + model.emit[:, obs[0]], []
    for o in obs[1:]:
        ways = score[:, None] + model.step[o // chat.FIRST]
        back.append(ways.argmax(axis=0))
        score = ways.max(axis=0) + model.emit[:, o]
    state = int(score.argmax())
    want = [state]
    for b in reversed(back):
        state = int(b[state])
        want.append(state)
    assert got == want[::-1]


def test_repeats_of_one_text_only(spark):
    rows = [(i, "the same text in every document of this table, long enough to be found, and then some more words to make it so" * 2) for i in range(30)]
    got = repeats.remove_repeats(frame(spark, rows).coalesce(1), 20, 8).collect()
    assert all((r.n_removed, r.n_spans, r.kept) == (r.n_bytes, 1, b"") for r in got) and len(got) == 30


def test_words_without_a_regular_expression(monkeypatch):
    """Words by classes of characters are those of the pattern, whatever white space, apostrophes and scripts there are; equal words have equal hashes."""
    P = pytest.importorskip("public_tokenizers")
    assert bpe.PATTERN == P.PATTERN
    find, rng = bpe.word_finder(P.PATTERN), random.Random(17)
    parts = ["a", "b", "é", "1", "'s", "'", "'re", "'v", "'ll", "'l", "e", "l", "s", "d", "'S", ".", " ", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u202f", "\u205f", "\u3000", "\0", "\U0001f600", "\U00020000", "\u200b", "”", "漢", "٣", "½", "\u0301"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 9))) for _ in range(30_000)] + ["one two three" * 9, "don't", "'", "x'", "x'l", "we'll'll", "it'sa", " 's"]
    for hashed, pattern in ((1 << 20, P.PATTERN), (16, P.PATTERN), (1 << 20, P.PATTERN + "|x")):
        monkeypatch.setattr(bpe, "HASHED", hashed)
        w = bpe.Words(pa.array(texts).slice(3), pattern)
        spelled = [w.buf[lo:hi].tobytes() for lo, hi in zip(w.bounds, w.bounds[1:], strict=False)]
        for i, text in enumerate(texts[3:]):
            assert [x.decode() for x in spelled[w.first[i] : w.first[i + 1]]] == find(text), repr(text)
        assert len(set(zip(bpe.word_hashes(w.buf, w.bounds).tolist(), spelled, strict=True))) == len(set(spelled)) == len(set(bpe.word_hashes(w.buf, w.bounds).tolist()))
    whole = bpe.Words(pa.array(texts), P.PATTERN).bounds
    monkeypatch.setattr(bpe, "LOOKED", 50)
    assert np.array_equal(bpe.Words(pa.array(texts), P.PATTERN).bounds, whole)
    for empty in ([""], [None, ""], []):
        assert len(bpe.word_hashes(*(lambda w: (w.buf, w.bounds))(bpe.Words(pa.array(empty, pa.string()), P.PATTERN)))) == 0


def test_only_near_lines_of_a_bucket_get_sets(monkeypatch):
    rng, seen, sets = random.Random(13), [], minhash.shingle_sets
    lines = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=200)) for _ in range(12)]
    lines.append(lines[3][:100] + "#" + lines[3][101:])
    monkeypatch.setattr(minhash, "shingle_sets", lambda texts, gram: seen.append(len(texts)) or sets(texts, gram))
    f, g = minhash.sketch(minhash.signatures(pa.array(lines), 5, 102))
    links = minhash.joined(pa.array(lines), f, g, np.arange(13), np.full(13, 2), 5, minhash.most_bits(102, 0.8), 0.8)
    assert links == [(3, 12)] and seen == [2]

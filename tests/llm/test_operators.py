"""Each operator against a brute-force version and on odd rows: nulls, empty and long texts, ties, repeats, clashing columns, no rows."""

import hashlib
import math
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillgrid.llm import exact_dedup, language_model, line_dedup, mixing, ngram_join, pieces, quality_classifier, quality_rules, textkernel, token_counts, toxicity
from quillgrid.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id long, _t string, node long, h long, kept boolean, _n long, size long, _src string, d long, i long, a long"


def frame(spark, rows):
    """rows: (doc_id, text, source); the other columns clash with names that operators use inside."""
    return spark.createDataFrame([(i, t, "en", s, None, 7, "x", 7, 7, True, 7, 7, "x", 7, 7, 7) for i, t, s in rows], SCHEMA)


def texts(seed=1, n=60):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["Ünï", "日本", "a,", "B."]
    out = []
    for i in range(n):
        if out and r.random() < 0.35:
            base = r.choice(out).split(" ")
            for _ in range(r.randint(0, 3)):
                base[r.randrange(len(base))] = r.choice(vocab)
            out.append(" ".join(base))
        else:
            out.append(" ".join(r.choice(vocab) + ("\n" if r.random() < 0.1 else "") for _ in range(r.randint(1, 160))))
    return out


@pytest.fixture(scope="module")
def odd(spark):
    t = texts()
    rows = [(i, x, f"s{i % 4}") for i, x in enumerate(t)]
    long = " ".join(f"v{i % 977}" for i in range(60_000))
    rows += [(200, None, "s0"), (201, "", "s1"), (202, " \t\n ", None), (203, long, "s2"), (204, long + " end", "s2"), (205, "z" * 300_000, None), (3, t[3], "s3"), (3, t[3], "s3"), (4, "other text of a repeated id", "s1"), (None, t[5], "s1"), (None, None, None), (206, "one two", "s0"), (207, "one two", "s0")]
    return rows


def got(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_kernel_words_and_shingles(monkeypatch):
    t = [None, "", "a b\tc", "ü é\n" * 5, "x" * 50, " lead", "A b a b a b c"]
    for piece in (5, 16, 1 << 20):
        monkeypatch.setattr(textkernel, "PIECE", piece)
        b, o = textkernel.buffers(pa.array(t))
        w = textkernel.words(b, o)
        assert [b[s:e].tobytes().decode() for s, e in zip(w["start"], w["end"])] == [x for y in t for x in WORD.findall(y or "")]
        g, n = textkernel.shingles(w["h"], w["n"], 2)
        at = textkernel.bounds(n)
        assert [len(set(g[at[i] : at[i + 1]].tolist())) for i in range(len(t))] == [len({tuple(v[j : j + 2]) for j in range(max(1, len(v) - 1))}) if (v := WORD.findall(x or "")) else 0 for x in t]


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    linked = {x for e in edges if e[0] != e[1] for x in e}
    assert got(components(spark.createDataFrame(edges, "u long, v long")), "node", "root") == sorted(((x, find(x)) for x in linked), key=repr)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_links(rows):
    sets = []
    for i, t, _ in rows:
        w = WORD.findall(t or "")
        sets.append(frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w and i is not None else frozenset())
    n, links, texts_, root = len(rows), Counter(), Counter(), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(n):
        seen = set()
        for b in range(n):
            if a != b and sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                links[a] += 1
                if sets[b] != sets[a]:
                    seen.add(sets[b])
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
        texts_[a] = len(seen)
    least = {}
    for a in range(n):
        if rows[a][0] is not None:
            least[find(a)] = min(least.get(find(a), 1 << 60), rows[a][0])
    return sorted(((rows[a][0], least[find(a)] if rows[a][0] is not None else None, links[a], texts_[a]) for a in range(n)), key=repr)


def test_ngram_join_chains_are_split(spark):
    """Texts that drift, each like the next: one candidate group, verified bucket by bucket, with the links that brute force finds."""
    words = [f"w{i}" for i in range(1200)]
    rows = [(i, " ".join(words[6 * i : 6 * i + 60]), "s") for i in range(150)] + [(200 + i, " ".join(words[3 * i : 3 * i + 80]), "s") for i in range(60)]
    out = ngram_join.ngram_join(frame(spark, rows))
    assert got(out, "doc_id", "class_id", "n_links", "n_link_texts") == brute_links(rows)


def test_ngram_join_recall(spark):
    """100,000 texts, of which 2,000 have a planted copy at a similarity just above the limit."""
    r = random.Random(12)
    rows, want = [], {}
    for i in range(98_000):
        w = [f"{r.randrange(1 << 30):x}" for _ in range(r.randint(12, 30))]
        rows.append((i, " ".join(w), "s"))
        if i < 2000:
            w = [f"{r.randrange(1 << 30):x}" for _ in range(60)]
            near = w[:-11] if i % 2 else [*w, *(f"x{j}" for j in range(14))]  # 45 of 56 or 56 of 70 windows are shared
            rows[-1] = (i, " ".join(w), "s")
            rows.append((100_000 + i, " ".join(near), "s"))
            want[i] = 100_000 + i
    found = {x.doc_id for x in ngram_join.ngram_join(frame(spark, rows)).filter("n_links > 0 AND doc_id < 100000").select("doc_id").collect()}
    assert found <= set(want) and len(found) >= 0.999 * len(want)


@pytest.mark.parametrize("block", [128, 3])
def test_ngram_join(spark, odd, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = odd + [(400 + i, " ".join(["the same long line of near copies goes on and on"] * 4 + [f"k{j}" for j in range(40)] + [f"x{i}"]), "s0") for i in range(20)]
    out = ngram_join.ngram_join(frame(spark, rows))
    assert got(out, "doc_id", "class_id", "n_links", "n_link_texts") == brute_links(rows)
    if block == 128:
        assert ngram_join.ngram_join(frame(spark, [])).count() == 0
        kept = ngram_join.keep_one_of_each(frame(spark, rows))
        assert kept.columns == frame(spark, []).columns
        assert {r[0] for r in kept.select("doc_id").collect()} == {r[1] for r in brute_links(rows)}


def test_keep_one_keeps_the_other_text_of_an_id(spark):
    """Rows (5, X), (5, Y), (3, near copy of Y): X is a class of its own and stays."""
    x, y = (" ".join(f"{c}{i}" for i in range(60)) for c in "xy")
    rows = [(5, x, "s"), (5, y, "s"), (3, y + " end", "s"), (None, y, "s"), (7, "", "s"), (8, None, "s")]
    assert got(ngram_join.keep_one_of_each(frame(spark, rows)), "doc_id", "text") == sorted([r[:2] for r in rows if r != rows[1]], key=repr)


def brute_lines(rows, m, words):
    docs = {}
    for i, t, _ in rows:
        docs[(i is None, i, t or "")] = None
    keys = sorted(docs, key=lambda k: (k[0], k[1] or 0))
    seen, gone = set(), {}
    for k in keys:
        lines = [s for s in k[2].split("\n") if WORD.search(s)]
        n = [len(WORD.findall(s)) for s in lines]
        out = set()
        for p in range(len(lines)):
            for w in range(1, min(len(lines) - p, 30) + 1):  # all widths, longer ones than the operator's, too
                x = tuple(lines[p : p + w])
                if x in seen and (w >= m or sum(n[p : p + w]) >= words):
                    out |= set(range(p, p + w))
                seen.add(x)
        gone[k] = out
    res = []
    for i, t, _ in rows:
        k, n, keep = (i is None, i, t or ""), -1, []
        for s in (t or "").split("\n"):
            n += bool(WORD.search(s))
            if not (WORD.search(s) and n in gone[k]):
                keep.append(s)
        res.append((i, len((t or "").split("\n")), len(gone[k]), "\n".join(keep)))
    return sorted(res, key=repr)


@pytest.mark.parametrize(("m", "words"), [(1, 9), (2, 9), (3, 4), (4, 6), (6, 12)])
def test_line_dedup(spark, m, words):
    r = random.Random(m)
    pool = [f"line {i}" + " w" * (i % 4) for i in range(9)] + ["", "  "]
    rows = [(i, "\n".join(r.choice(pool) for _ in range(r.randint(0, 14))), "s") for i in range(40)]
    rows += [(100, "\n".join(f"u{i}" for i in range(300)), "s"), (101, "\n".join(f"u{i}" for i in range(300)) + "\nnew", "s"), (102, None, "s"), (103, "", "s"), (5, rows[5][1], "s"), (None, rows[7][1], "s")]
    assert got(line_dedup.line_dedup(frame(spark, rows), m, words), "doc_id", "n_lines", "n_deleted", "text") == brute_lines(rows, m, words)
    if m == 2:
        assert line_dedup.line_dedup(frame(spark, [])).count() == 0


def test_line_dedup_long_lines_and_short_runs(spark):
    """A passage on one line goes from its later copy; a run of few short lines stays."""
    passage = " ".join(f"p{i}" for i in range(54))
    rows = [(1, f"head\n{passage}\ntail\nx y\nz", "s"), (2, f"other\n{passage}\nend", "s"), (3, "start\nx y\nz\nstop", "s"), (4, passage, "s")]
    assert got(line_dedup.line_dedup(frame(spark, rows)), "doc_id", "n_deleted", "text") == [(1, 0, rows[0][1]), (2, 1, "other\nend"), (3, 0, rows[2][1]), (4, 1, "")]


def test_line_dedup_is_linear(spark):
    """One text of 200,000 equal lines, and a text of 200,000 lines twice."""
    many = "\n".join(f"row {i}" for i in range(200_000))
    rows = [(1, "a b\n" * 200_000, "s"), (2, many, "s"), (3, many, "s")]
    out = {x.doc_id: x.n_deleted for x in line_dedup.line_dedup(frame(spark, rows)).select("doc_id", "n_deleted").collect()}
    assert out == {1: 199_999, 2: 0, 3: 200_000}


def test_quality_rules(spark, odd):
    r = random.Random(4)
    rows = odd + [(500 + i, "Shared Boiler line here\n" + " ".join(f"q{r.randrange(900)}" for _ in range(r.choice([3, 60]))) + "\n shared boiler LINE here ", "s0") for i in range(12)] + [(590 + i, "\n".join(" ".join(f"menu{j}x{k}" for k in range(20)) for j in range(4)), "s7") for i in range(9)] + [(600, "a b c " * 40, "s1"), (601, "# $ % x|y\nl\nl\nm\nl", None)]
    per, host = defaultdict(set), defaultdict(set)
    for i, t, s in rows:
        host[s].add((i, t or ""))
        for line in (t or "").split("\n"):
            if WORD.search(line):
                per[(s, line.strip(" ").lower())].add((i, t))
    want = []
    for i, t, s in rows:
        t = t or ""
        w = WORD.findall(t)
        tri = Counter(zip(w, w[1:], w[2:]))
        rep = {p + k for p in range(len(w) - 2) if tri[tuple(w[p : p + 3])] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        gone = sum(len(WORD.findall(x)) for x in lines if (c := len(per[(s, x.strip(" ").lower())])) > 8 and 100 * c > 20 * len(host[s]))
        failed = len(w) < 50 or 100 * len(rep) > 50 * len(w)
        want.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep), failed, not failed and 100 * (len(w) - gone) >= 50 * len(w), gone))
    out = quality_rules.quality_rules(frame(spark, rows), max_share=20, max_docs=8)
    assert got(out, *out.columns) == sorted(want, key=repr)
    assert sum(x[-1] > 0 for x in want) >= 12
    assert sum(not x[-3] and not x[-2] for x in want) >= 1  # depleted, not failed by its own counts
    assert quality_rules.quality_rules(frame(spark, [])).count() == 0


def test_exact_dedup(spark, odd):
    groups = defaultdict(list)
    for i, t, _ in odd:
        groups[t or ""].append(i)
    out = exact_dedup.exact_dedup(frame(spark, odd))
    keep = {t: max((i for i in g if i is not None), default=None) for t, g in groups.items()}
    assert got(out, "doc_id", "keep_id", "group_size", "text_sha256") == sorted(((i, keep[t or ""], len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _ in odd), key=repr)
    assert Counter(r.text_sha256 for r in out.filter("kept").collect()) == Counter(hashlib.sha256(t.encode()).hexdigest() for t in groups)
    assert all(r.doc_id == r.keep_id for r in out.filter("kept").collect())
    left = exact_dedup.drop_exact_copies(frame(spark, odd))
    assert left.columns == frame(spark, []).columns
    assert sorted(((r.doc_id, r.text or "") for r in left.collect()), key=repr) == sorted(((k, t) for t, k in keep.items()), key=repr)
    assert exact_dedup.exact_dedup(frame(spark, [])).count() == 0 == exact_dedup.drop_exact_copies(frame(spark, [])).count()


def test_toxicity(spark):
    r = random.Random(5)
    vocab = [f"{a}{b}" for a in "bcdfg" for b in ("an", "or", "elt", "ist", "umber")]
    rows, labels = [], []
    for i in range(900):
        w = [r.choice(vocab) for _ in range(r.randint(20, 80))]
        # Neither the insult nor the group alone is toxic: only a pairwise weight tells them apart.
        a, b = r.random() < 0.5, r.random() < 0.5
        w += ["clot" * a, "northerners" * b] * 2
        r.shuffle(w)
        rows.append((i, " ".join(w), "s"))
        labels.append((i, int(a and b)))
    labels += [(1, 0), (None, 1), (99999, 1), (2, None)]
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    odd_rows = [(1000, None, "s"), (1001, "", "s"), (1002, "clot " * 30_000, "s"), (7, rows[7][1], "s"), (None, rows[8][1], "s")]
    out = {(x.doc_id, x.held_out): x for x in toxicity.toxicity(frame(spark, rows + odd_rows), lab).collect()}
    held = [x for x in out.values() if x.held_out and x.doc_id is not None and x.doc_id < 900]
    assert len(held) > 150
    assert np.mean([x.predicted == labels[x.doc_id][1] for x in held]) > 0.97
    assert out[(1000, out_flag(1000))].score == out[(1001, out_flag(1001))].score
    assert all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.3) for x in out.values())
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {x.score for x in toxicity.toxicity(frame(spark, rows[:5]), none).collect()} == {0.5}
    assert toxicity.toxicity(frame(spark, []), lab).count() == 0
    left = toxicity.drop_toxic(frame(spark, rows + odd_rows), lab)
    assert left.columns == frame(spark, []).columns and 300 < left.count() < 905


def out_flag(i):
    import zlib

    return zlib.crc32(str(i).encode()) % 4 == 2


def test_pieces_round_trip_and_library(spark, odd):
    import sentencepiece

    path = pieces.piece_path()
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = odd + [(300, "a  b \n▁ c　ﬁ 😀 <s> <0x41>", "s"), (301, "y" * 500 + " " * 70, "s"), (302, "▁▁", "s")]
    plain = pieces.encode(frame(spark, rows), path, dropout=0.0)
    for r in plain.join(frame(spark, rows).select(F.col("doc_id").alias("k"), "text").dropDuplicates(["k"]), F.col("doc_id") == F.col("k")).filter("doc_id NOT IN (3, 4)").collect():
        assert r.lossless
        if "▁" not in (r.text or ""):
            assert r.ids == sp.encode(r.text or "")
    a, b, c = (pieces.encode(frame(spark, rows), path, seed=s) for s in (1, 1, 2))
    assert got(a, "doc_id", "ids") == got(b, "doc_id", "ids") != got(c, "doc_id", "ids")
    assert a.filter("NOT lossless").count() == 0
    more, less = (x.agg(F.sum("n_tokens")).first()[0] for x in (a, plain))
    assert more > less
    back = pieces.decode(a, path)
    assert got(back, "doc_id", "text") == sorted(((i, t or "") for i, t, _ in rows), key=repr)
    assert pieces.encode(frame(spark, []), path).count() == 0


def test_pieces_heap_equals_rounds():
    p = pieces.pieces(pieces.piece_path())
    r = random.Random(6)
    for _ in range(150):
        s = pieces._symbols(p, "".join(r.choice("abethonti ,.é日") for _ in range(r.randint(2, 40))))
        m = s[None, :].astype(np.int32)
        left, alive = pieces._segment_short(p, m, *pieces._neighbours(p, m), np.array([9], np.uint64), 0.3)
        assert left[alive].tolist() == pieces._segment_long(p, s, 9, 0.3).tolist()


def test_quality_classifier(spark):
    r = random.Random(7)
    rows, labels = [], []
    for i in range(500):
        good = r.random() < 0.6
        body = " ".join(r.choice(["alpha", "beta", "gamma", "delta", "rho", "tau"]) + str(r.randrange(50)) for _ in range(60)) if good else ("SPAM $$ " * r.randint(10, 40) + "\n" * 20)
        rows.append((i, body, "clean" if good == (r.random() < 0.95) else "dump"))
        if i < 300:
            labels.append((i, int(good)))
    truth = {i: t.startswith("SPAM") for i, t, _ in rows}
    odd_rows = [(1000, None, None), (1001, "", "clean"), (None, "x", "clean"), (1002, "a " * 50_000, "dump")]
    out = quality_classifier.quality_classifier(frame(spark, rows + odd_rows), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(out) == 504 and all(0 <= x.score <= 1 for x in out)
    assert np.mean([x.kept != truth[x.doc_id] for x in out if x.doc_id is not None and 300 <= x.doc_id < 500]) > 0.95
    assert quality_classifier.quality_classifier(frame(spark, []), spark.createDataFrame(labels, "doc_id long, quality int")).count() == 0
    assert len({x.score for x in quality_classifier.quality_classifier(frame(spark, rows[:4]), spark.createDataFrame([], "doc_id long, quality int")).collect()}) == 1


def brute_lm(rows, order):
    import zlib

    low = lambda t: ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in WORD.findall(t or "")] + [0]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c3, c1 = Counter(), Counter()
    for i, t, _ in rows:
        if not held(i):
            w = low(t)
            c1.update(w)
            c3.update(zip([1, 1, *w], [1, *w], w))
    c2 = Counter()
    for (_, v, w), c in c3.items():
        c2[v, w] += c if v == 1 or order == 2 else 1
    cont = Counter(w for _, w in c2)
    d3, d2, d1 = ([0, *language_model.discounts([sum(c == k for c in x.values()) for k in (1, 2, 3, 4)])] for x in (c3, c2, cont))
    left3, left2, sum3, sum2 = Counter(), Counter(), Counter(), Counter()
    for (u, v, _), c in c3.items():
        sum3[u, v] += c
        left3[u, v] += d3[min(c, 3)]
    for (v, _), c in c2.items():
        sum2[v] += c
        left2[v] += d2[min(c, 3)]
    n, v_, types = sum(c1.values()), len(c1), len(c2)
    g1 = sum(d1[min(c, 3)] for c in cont.values()) / types
    less = lambda c, d: max(c - d[min(c, 3)], 0)
    out = []
    for i, t, _ in rows:
        w = low(t)
        base = score = 0.0
        for u, v, x in zip([1, 1, *w], [1, *w], w):
            base += math.log10((c1[x] + 1) / (n + v_ + 1))
            p = less(cont[x], d1) / types + g1 / (v_ + 1)
            if sum2[v]:
                p = (less(c2[v, x], d2) + left2[v] * p) / sum2[v]
            if order == 3 and sum3[u, v]:
                p = (less(c3[u, v, x], d3) + left3[u, v] * p) / sum3[u, v]
            score += math.log10(p)
        out.append((i, held(i), len(w), sum(c1[x] > 0 for x in w), n, round(base, 6), round(score, 6)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("order", [2, 3])
def test_language_model(spark, odd, monkeypatch, order):
    rows = odd + [(700 + i, "The cat sat ON the mat " * (i % 7) + "the dog", "s") for i in range(60)]
    cols = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 6), F.round("score", 6))
    want = brute_lm(rows, order)
    for share, shard, most in ((0.5, 2_000_000, 1 << 21), (1e-9, 20_000, 1 << 21), (0.5, 5_000, 500)):
        monkeypatch.setattr(language_model, "SHARE", share)
        monkeypatch.setattr(language_model, "SHARD", shard)
        monkeypatch.setattr(language_model, "MOST", most)
        have = got(language_model.lm_score(frame(spark, rows), order=order), *cols)
        assert [x[:5] for x in have] == [x[:5] for x in want]
        assert np.allclose([x[5:] for x in have], [x[5:] for x in want], atol=1e-3, rtol=1e-9)
    if order == 2:
        return
    assert language_model.lm_score(frame(spark, [])).count() == 0
    import zlib

    alone = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)  # no row to learn from
    assert [(r.n_known, r.train_tokens, r.score) for r in language_model.lm_score(frame(spark, [(alone, "a b", "s")])).collect()] == [(0, 0, 0.0)]


def test_language_model_sums_to_one(spark):
    """Over all words and one unknown one, the probabilities of the next word are 1."""
    text = "a b c a b d a c b a"
    folder = language_model.train(frame(spark, [(1, text, "s"), (2, "b a", "s")]))
    model = language_model.Model(folder)
    for begin in ("", "a", "a b", "d a", "zz", "zz a", "b zz"):
        score = lambda t: float(model.score(pa.array([t]))[3][0])
        after = [f"{begin} {x}".strip() for x in ("a", "b", "c", "d", "new")]
        # p(begin x end) / p(end | begin x) = p(begin x); the end itself is one more outcome.
        head = model_head(model, begin)
        assert math.isclose(sum(10 ** (model_head(model, t) - head) for t in after) + 10 ** (score(begin) - head), 1, rel_tol=1e-9)


def model_head(model, text):
    """log10 probability of a text's words without its end."""
    if not text:
        return 0.0
    t, n = language_model.tokens(pa.array([text]))
    whole = float(model.score(pa.array([text]))[3][0])
    m = model.m
    h, back = np.unique(np.append(t, language_model.BEGIN), return_inverse=True)
    number, info = model.words(h)
    w = back[:-1]
    v = np.concatenate([back[-1:], w[:-1]])
    u = np.concatenate([back[-1:], v[:-1]])
    two, three, ctx = model.grams(number[u], number[v], number[w], np.zeros(len(w), bool))
    if len(t) > 1 and two[-2] and not ctx[0, -1]:
        ctx[:2, -1] = 1
    info = info[:, w[-1:]], info[:, v[-1:]]
    low, mid, high = (np.array([0.0, *m[x]]) for x in ("low", "mid", "high"))
    less = lambda c, d: max(c - d[min(c, 3)], 0)
    gamma = (low[1] * m["low_n"][0] + low[2] * m["low_n"][1] + low[3] * max(m["v"] - sum(m["low_n"]), 0)) / m["types"]
    p = less(info[0][0, 0], low) / m["types"] + gamma / (m["v"] + 1)
    k = info[1][2:6, 0]
    if k[0]:
        p = less(two[-1], mid) / k[0] + (mid[1:] @ k[1:]) / k[0] * p
    k = ctx[:, -1]
    if k[0]:
        p = less(three[-1], high) / k[0] + (high[1:] @ k[1:]) / k[0] * p
    return whole - math.log10(p)


def test_mixing(spark, odd):
    r = random.Random(9)
    rows = odd + [(1000 + i, " ".join("w" for _ in range(int(r.lognormvariate(4, 1)) + 1)), r.choice(["s0", "s1", "s2", None, "é", "big", "big", "big"])) for i in range(900)]
    out = mixing.mix(frame(spark, rows)).collect()
    again = mixing.mix(frame(spark, rows).repartition(7)).collect()
    assert sorted(map(repr, out)) == sorted(map(repr, again))
    size = Counter()
    for _, t, s in rows:
        size[s] += len(WORD.findall(t or ""))
    names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_, budget = {}, set(names), 1.5 * sum(size.values())
    while open_:
        level = budget / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > 2 * size[s]]
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in over:
            target[s] = 2.0 * size[s]
            budget -= target[s]
            open_.discard(s)
    taken = Counter()
    for x in out:
        assert x.source_size == size[x._source] and math.isclose(x.target, target[x._source], rel_tol=1e-9, abs_tol=1e-9)
        assert x.taken in (0, x["size"], 2 * x["size"]) and x.taken == x.copies * x["size"]
        taken[x._source] += x.taken
    for s in names:
        if size[s] > 10_000 and s == "big":
            assert abs(taken[s] / target[s] - 1) < 0.02
    big = [x for x in out if x._source == "big"]
    if target["big"] < size["big"]:
        assert {x.copies for x in big} <= {0, 1}
    assert mixing.mix(frame(spark, [])).count() == 0
    rows_taken = mixing.take_mix(frame(spark, rows))
    assert rows_taken.columns == frame(spark, []).columns
    assert rows_taken.count() == sum(x.copies for x in out)
    assert Counter(r.source for r in rows_taken.select("source").collect()) == Counter({s: c for s in names if (c := sum(x.copies for x in out if x._source == s))})


def brute_mix(rows):
    """{(id, source): (copies, inclusion)} of rows whose ids differ, by plain sorts; targets by rounds of water filling."""
    n = {(i, s): len(WORD.findall(t or "")) for i, t, s in rows}
    size = Counter()
    for (_, s), k in n.items():
        size[s] += k
    names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_, budget = {}, set(names), 1.5 * sum(size.values())
    while open_:
        level = budget / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] >= 2 * size[s]]
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in over:
            target[s] = 2.0 * size[s]
            budget -= target[s]
            open_.discard(s)
    out = {}
    for s in names:
        own = {i: k for (i, x), k in n.items() if x == s}
        whole = math.floor(target[s] / size[s]) if size[s] else 0
        goal = target[s] - whole * size[s]
        certain, c = set(), 0.0
        while goal > 0:
            c = (goal - sum(own[i] for i in certain)) / sum(own[i] ** 2 for i in own if i not in certain)
            more = {i for i in own if i not in certain and c * own[i] > 1}
            if not more:
                break
            certain |= more
        p = {i: 1.0 if i in certain else min(1.0, c * own[i]) for i in own}
        assert math.isclose(sum(p[i] * own[i] for i in own), goal, rel_tol=1e-9, abs_tol=1e-6)  # the target in expectation

        def rank(i):
            x = (int(hashlib.md5(f"9|{i}|{own[i]}|{s or '-'}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13
            return 0 if p[i] == 1 else x / (1 - x) * (1 - p[i]) / p[i]

        upto, extra = 0, set()
        for i in sorted((i for i in own if p[i] > 0), key=rank):
            if p[i] == 1 or upto + own[i] / 2 <= goal:
                extra.add(i)
            upto += own[i]
        out |= {(i, s): ((whole + (i in extra)) if own[i] else 0, p[i]) for i in own}
    return out


@pytest.mark.parametrize("bins", [256, 3])
def test_pareto_ranks(spark, monkeypatch, bins):
    """Odds in proportion to size over a whole source, the largest texts for certain, the rest in the order of a plain sort up to the size."""
    monkeypatch.setattr(mixing, "BINS", bins)
    r = random.Random(3)
    rows = [(i, " ".join(["w"] * int(1 + r.lognormvariate(3, 1.2))), ("a", "b", "c", None)[min(3, i % 5)]) for i in range(400)] + [(500, " ".join(["w"] * 9000), "a"), (501, "", "a"), (502, None, None)]
    want = brute_mix(rows)
    for x in mixing.mix(frame(spark, rows)).collect():
        copies, p = want[x.doc_id, x._source]
        assert x.copies == copies and math.isclose(x.inclusion, p, rel_tol=1e-9, abs_tol=1e-12)


def test_take_mix_repeated_rows(spark):
    """Equal rows give the copies of all of them; rows that differ in another column alone keep apart; reruns agree."""
    rows = [(1, "a b c", "s")] * 3 + [(None, "x y", "s"), (None, "x z", "s"), (2, "", "s"), (3, None, None)] + [(i, "w " * (i % 7 + 1), "s") for i in range(10, 60)]
    df = frame(spark, rows)
    other = df.filter("doc_id = 1").limit(1).withColumn("lang", F.lit("de"))
    df = df.unionByName(other)
    runs = [got(mixing.take_mix(df.repartition(n)), *df.columns) for n in (1, 5)]
    assert runs[0] == runs[1]
    assert len(runs[0]) == sum(x.copies for x in mixing.mix(df).collect())
    assert mixing.take_mix(frame(spark, [])).count() == 0


def test_token_counts(spark, odd, tmp_path):
    from tokenizers import Tokenizer

    path = token_counts.tokenizer_path()
    t = Tokenizer.from_file(path)
    rows = odd + [(300, "a<|endoftext|>b", "s")]
    cache = f"file://{tmp_path}/cache"
    want = sorted(((i, len((x or "").encode()), n := len(t.encode(x or "", add_special_tokens=False).ids), n > 512) for i, x, _ in rows), key=repr)
    out = token_counts.token_counts(frame(spark, rows), path, cache)
    assert got(out, "doc_id", "n_bytes", "n_tokens", "over_limit") == want
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("digest").distinct().count() == len({x or "" for _, x, _ in rows})
    again = token_counts.token_counts(frame(spark, rows + [(301, "new text", "s")]), path, cache)
    assert again.count() == len(rows) + 1 and spark.read.parquet(cache).count() == stored.count() + 1
    assert token_counts.token_counts(frame(spark, []), path, f"file://{tmp_path}/none").count() == 0
    model = pieces.piece_path()
    assert token_counts.token_counts(frame(spark, rows[:5]), model, cache).count() == 5
    assert spark.read.parquet(cache).select("tokenizer").distinct().count() == 2


def test_quality_classifier_learns_from_all_rows_without_a_label(spark, monkeypatch):
    """More rows without a label than 10,000, all of one sure kind: each of them reaches the Newton steps."""
    r = random.Random(8)
    word = lambda: r.choice(["alpha", "beta", "gamma", "delta"]) + str(r.randrange(50))
    rows = [(i, " ".join(word() for _ in range(12)) if i % 2 else "SPAM $$ " * 12, "clean" if i % 2 else "dump") for i in range(10_900)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, quality int")
    seen, step = [], quality_classifier._step
    monkeypatch.setattr(quality_classifier, "_step", lambda sums, w, *a: seen.append(sums[-1]) or step(sums, w, *a))
    out = quality_classifier.quality_classifier(frame(spark, rows), labels).collect()
    assert max(seen) > 10_600
    assert np.mean([x.kept == (x.doc_id % 2 == 1) for x in out]) > 0.99


def test_toxicity_sample_does_not_depend_on_the_label(spark):
    """Repeated rows teach once, and an id of many texts does not push out the toxic rows."""
    word = random.Random(9)
    body = lambda: " ".join(word.choice(["ban", "celt", "dist", "for", "gumber"]) for _ in range(20))
    rows = [(i, body() + (" clot" if i % 4 == 0 else ""), "s") for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    plain, thrice = (sorted((x.doc_id, x.score) for x in toxicity.toxicity(frame(spark, r), labels, max_rows=200).dropDuplicates(["doc_id"]).collect()) for r in (rows, rows * 5))
    assert plain == thrice and np.mean([(s >= 0.3) == (i % 4 == 0) for i, s in thrice]) > 0.97
    one = next(i for i in range(1, 200, 4) if not out_flag(i))
    many = rows + [(one, body() + f" n{j}", "s") for j in range(600)]
    got_ = {x.doc_id: x.score for x in toxicity.toxicity(frame(spark, many), labels, max_rows=200).filter(F.col("doc_id") % 4 == 0).collect()}
    assert np.mean([s >= 0.3 for s in got_.values()]) > 0.9


def test_quality_classifier_repeated_rows_teach_once(spark):
    rows = [(i, " ".join(["alpha", "beta", f"g{i}"] * 8) if i % 3 == 0 else f"SPAM $$ {i} " * 8, "clean" if i % 3 == 0 else "dump") for i in range(90)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)], "doc_id long, quality int")
    a, b = (sorted((x.doc_id, round(x.score, 9)) for x in quality_classifier.quality_classifier(frame(spark, r), labels, max_labelled=90).dropDuplicates(["doc_id"]).collect()) for r in (rows, rows * 5))
    assert a == b and np.mean([(s >= 0.5) == (i % 3 == 0) for i, s in b]) > 0.97


def test_pieces_vary_with_document_and_place(spark):
    """One word, 200 times in each of 60 documents: far more segmentations than groups of documents could give."""
    rows = [(i, " ".join(["internationalization"] * 200), "s") for i in range(60)]
    out = pieces.encode(frame(spark, rows), pieces.piece_path(), dropout=0.3).collect()
    assert all(r.lossless for r in out)
    assert len({tuple(r.ids) for r in out}) == 60
    p = pieces.pieces(pieces.piece_path())
    word = {tuple(w) for r in out for w in by_unit(p, r.ids)}
    assert len(word) > 64


def by_unit(p, ids):
    """Ids of each unit: a unit opens with a space."""
    units = []
    for i in ids:
        if p.raw[p.raw_at[i]] == 32 or not units:
            units.append([])
        units[-1].append(i)
    return units


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.01"), reason="needs the test tables")
def test_quality_rules_decide_by_line_frequency(spark):
    """On sf0.01 lines go by their frequency in a host, and the rule acts with the default limits."""
    out = quality_rules.quality_rules(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    cut, lost = out.filter("words_removed > 0").count(), out.filter("NOT base_failed AND NOT kept").count()
    print(cut, lost)
    assert cut > 5


def test_shared_folder_must_be_set_on_a_cluster(spark, monkeypatch):
    from quillgrid.llm import shared

    class Conf:
        def get(self, key, default=None):
            return default

    class Cluster:
        conf = Conf()

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"
            getConf = staticmethod(Conf)

    with pytest.raises(RuntimeError):
        shared.shared_dir(Cluster())


def test_toxicity_scores_by_hand(spark):
    """The machine's output is intercept + weights of the text's terms + an inner product for each pair of them."""
    r = random.Random(4)
    rows = [(i, " ".join(r.choice(["ban", "celt", "dist", "for", "gumber", "clot" if i % 3 == 0 else "clan"]) for _ in range(25)), "s") for i in range(300)]
    labels = spark.createDataFrame([(i, int("clot" in t)) for i, t, _ in rows], "doc_id long, toxic int")
    m = toxicity.unpack(toxicity.learn(frame(spark, rows), labels))
    assert len(m["ids"]) >= 2
    at = {int(k): i for i, k in enumerate(m["ids"])}
    got_ = toxicity.predict(m, pa.array([t for _, t, _ in rows[:20]]))
    for (_, t, _), p in zip(rows[:20], got_):
        own = sorted({at[int(k)] for k in toxicity.terms(pa.array([t]))[1] if int(k) in at})
        z = float(m["w0"]) + sum(float(m["w"][i]) for i in own) + sum(float(m["v"][i].astype(float) @ m["v"][j].astype(float)) for a, i in enumerate(own) for j in own[:a])
        assert math.isclose(p, 1 / (1 + math.exp(-z)), rel_tol=1e-5)


def cotrained(seed=11):
    """Texts in which each document holds few of many telling words, and a source that tells most of the quality: (rows, labels, truth)."""
    r = random.Random(seed)
    rows, truth = [], {}
    for i in range(1600):
        good = r.random() < 0.5
        words = [r.choice([f"n{j}x" for j in range(60)]) for _ in range(30)] + [f"{'g' if good else 'b'}{r.randrange(40)}t" for _ in range(2)]
        r.shuffle(words)
        rows.append((i, " ".join(words), r.choice(["s0", "s1", "s2"] if good == (r.random() < 0.9) else ["s3", "s4", "s5"])))
        truth[i] = int(good)
    return rows, [(i, truth[i]) for i in range(160)], truth


def test_cotraining_against_one_process(spark):
    """The distributed sums give the model that one process fits over all rows, and both views together beat the labelled-only text view."""
    rows, lab, truth = cotrained()
    C = quality_classifier
    df, labels = frame(spark, rows), spark.createDataFrame(lab, "doc_id long, quality int")
    out = {x.doc_id: x for x in C.quality_classifier(df, labels).collect()}
    base = df.select(F.col("doc_id").alias("_id"), F.col("text").alias("_t"), F.col("lang").alias("_lang"), F.col("source").alias("_src"), F.col("n_chars").alias("_n"))
    sample = C.examples(base, labels.filter(~toxicity.held_out("doc_id")), "doc_id", "quality", C.MAX_LABELLED, 7).cache()
    known = C._known(sample)
    assert len(known["terms"]) > 5 and known["sources"] == ["s0", "s1", "s2", "s3", "s4", "s5"]
    part = lambda rs: pa.RecordBatch.from_arrays([pa.array([t for _, t, _ in rs]), pa.array(["en"] * len(rs)), pa.array([s for *_, s in rs]), pa.array([None] * len(rs), pa.int64())], names=list("tlsn"))
    held = {r._id for r in sample.select("_id").collect()}
    own = sorted((truth[i], C.measured(part([rows[i]]), known)[0].as_py()) for i in held)
    order = np.random.Generator(np.random.PCG64(7)).permutation(len(own))
    x, y = C.views(pa.array([own[i][1] for i in order]), known), np.array([own[i][0] for i in order], float)
    free = C.views(C.measured(part([r for r in rows if r[0] >= 160]), known), known)

    def others(now):
        z = [(v - m) / s for v, m, s in zip(free, now["mean"], now["sd"])]
        return [C._sums(z[i][t >= 0], t[t >= 0], C.PSEUDO, now["at"][i]) for i, t in enumerate(C._given(tuple(z), now["past"]))]

    every = C.views(C.measured(part(rows), known), known)
    want = C.predict(C.fit(x, y, others), every)
    assert np.allclose([out[i].score for i in range(1600)], want[0], atol=1e-4)
    assert np.allclose([out[i].score_text for i in range(1600)], want[1], atol=1e-4)
    none = lambda now: [np.zeros(len(w) * (len(w) + 1) + 3) for w in now["at"]]
    alone = C.predict(C.fit(x, y, none, rounds=0), every)[1]
    truth_ = np.array([truth[i] for i in range(160, 1600)])

    def auc(score):
        rank = np.argsort(np.argsort(score))
        n = truth_.sum()
        return (rank[truth_ == 1].sum() - n * (n - 1) / 2) / (n * (len(truth_) - n))

    assert auc(want[0][160:]) > auc(alone[160:]) + 0.02


def test_one_round_by_hand():
    """A view labels for the other one the rows of which it is sure; the first label stays."""
    x = (np.array([[4.0], [-4.0], [0.1], [9.0]]), np.array([[0.0], [5.0], [-5.0], [0.0]]))
    first, second = [np.array([1.0, 0.0]), np.array([1.0, 0.0])], [np.array([-1.0, 0.0]), np.array([1.0, 0.0])]
    to_text, to_page = quality_classifier._given(x, [first])
    assert to_text.tolist() == [-1, 1, 0, -1] and to_page.tolist() == [1, 0, -1, 1]
    to_text, to_page = quality_classifier._given(x, [first, second])
    assert to_text.tolist() == [-1, 1, 0, -1] and to_page.tolist() == [1, 0, -1, 1]


def test_a_hundred_thousand_repeats_of_a_labelled_row_teach_once(spark):
    """The scores of the toxicity machine and of the quality classifier are those without the repeats."""
    rows, lab, _ = cotrained(5)
    df = frame(spark, rows[:400])
    hot = df.filter("doc_id IN (1, 2)").crossJoin(spark.range(50_000).select(F.lit(0).alias("_z")).drop("_z")).select(*df.columns)
    many = df.unionByName(hot)
    for name, work in (("toxic", toxicity.toxicity), ("quality", quality_classifier.quality_classifier)):
        labels = spark.createDataFrame(lab, f"doc_id long, {name} int")
        a, b = (work(x, labels).groupBy("doc_id").agg(F.round(F.min("score"), 9).alias("s"), F.round(F.max("score"), 9).alias("t"), F.count(F.lit(1)).alias("n")).collect() for x in (df, many))
        assert {r.doc_id: (r.s, r.t) for r in a} == {r.doc_id: (r.s, r.t) for r in b} and all(r.s == r.t for r in b)
        assert {r.n for r in b} == {1, 50_001}

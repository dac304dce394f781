"""Periodic runs, quality rules and whitening against brute force and odd tables."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_CHECK, SF_SMALL
from loyalpulse.llm import check_sql, periodic_runs, quality_rules, suffix_tree, whitening
from loyalpulse.llm import queries as registered

DOCS = "doc_id bigint, text string, id string, words int, runs string, w double"
NAN, INF = float("nan"), float("inf")


def runs_by_hand(words, least_words=6, least_periods=4):
    n, out = len(words), []
    for q in range(1, n // least_periods + 1):
        i = 0
        while i + q < n:
            if words[i] == words[i + q]:
                j = i
                while j + q < n and words[j] == words[j + q]:
                    j += 1
                part = words[i : j + q]
                primitive = not any(part[d:] == part[:-d] for d in range(1, q))
                if len(part) >= max(least_words, least_periods * q) and primitive:
                    out.append((i, len(part), q))
                i = j
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(words, *least):
    return [tuple(r) for r in periodic_runs.find_runs(words, *least).tolist()]


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=50),
    st.integers(1, 9),
    st.sampled_from([(6, 4), (2, 2), (5, 3), (1, 2)]),
)
def test_runs_are_those_found_by_hand(words, times, least):
    words = words[:12] * times + words
    assert found(words, *least) == runs_by_hand(words, *least)


def test_extensions_are_common_prefixes():
    rng = np.random.default_rng(1)
    for _ in range(200):
        s = rng.integers(0, 3, rng.integers(2, 40))
        lce = suffix_tree.Extensions(s)
        a, b = np.triu_indices(len(s), 1)
        for i, j, got in zip(a, b, lce(a, b)):
            want = 0
            while j + want < len(s) and s[i + want] == s[j + want]:
                want += 1
            assert got == want
        ends = [tuple(s[i:]) for i in range(len(s))]
        assert np.argsort(lce.rank[: len(s)]).tolist() == sorted(range(len(s)), key=ends.__getitem__)


def test_a_long_periodic_text_and_a_long_word():
    words = [b"x%d" % (i % 7) for i in range(60_000)] + [b"y" * 1_000_000]
    assert found(words, 6, 4) == [(0, 60_000, 7)]
    kept = periodic_runs.without_repeats(words, periodic_runs.find_runs(words, 6, 4))
    assert len(kept) == 8
    assert found([b"a"] * 50_000, 6, 4) == [(0, 50_000, 1)]


@pytest.mark.parametrize("sf", [SF_SMALL, SF_CHECK])
def test_op12_on_a_table(spark, sf):
    got = {r.doc_id: r for r in registered.op12_periodic_runs(spark, sf).collect()}
    docs = registered.table(spark, sf, "documents").collect()
    assert len(got) == len(docs)
    planted = 0
    for doc in docs:
        words = (doc.text or "").encode().split()
        n, h = len(words), zlib.crc32(str(doc.doc_id).encode())
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 1500:
            continue
        runs = runs_by_hand(words)
        planted += h % 10 == 0 and bool(runs)
        dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        assert tuple(got[doc.doc_id]) == (
            doc.doc_id,
            len(runs),
            *best,
            1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest(),
        )
    assert planted


def odd_documents(spark):
    rows = [
        (1, "a b " * 9, "x", 1, "r", 1.0),
        (1, "a b " * 9, "x", 1, "r", 1.0),
        (2, None, None, None, None, None),
        (3, "", "", 0, "", 0.0),
        (4, " \n\t ", "x", 1, "r", 1.0),
        (None, "à à à à à à ", "x", 1, "r", NAN),
        (5, " ".join(f"w{i}" for i in range(200_000)), "x", 1, "r", 1.0),
    ]
    return spark.createDataFrame(rows, DOCS)


def test_runs_of_odd_rows(spark):
    docs = odd_documents(spark)
    out = periodic_runs.periodic_runs(docs)
    assert out.columns == ["doc_id", "runs", "collapsed"]
    rows = sorted(out.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    assert [[tuple(x) for x in r.runs] for r in rows] == [[(0, 18, 2)], [(0, 18, 2)], [], [], [], [], []]
    assert [r.collapsed for r in rows[:5]] == ["a b", "a b", "", "", ""]
    assert rows[-1].collapsed == "à à à à à à "
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(docs, least_periods=1)


def repeat_words_by_hand(words):
    places = {}
    for i in range(len(words) - 2):
        places.setdefault(tuple(words[i : i + 3]), []).append(i)
    return len({i + k for found in places.values() if len(found) > 1 for i in found for k in range(3)})


def test_measures_are_those_counted_by_hand(spark):
    random.seed(4)
    texts = [
        "".join(random.choice(["ab", "c", "É#", "7", "$", " ", "  ", "\n", "\t", "\x0b"]) for _ in range(k))
        for k in range(120)
    ] + ["a b c " * 40, "one\ntwo\none\n \none", "", " ", "\U0001f600 x " * 5]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for r in quality_rules.measured(docs).collect():
        text = texts[r.id]
        words = [w.decode() for w in text.encode().split()]
        lines = [line for line in text.split("\n") if line.encode().split()]
        assert r.words == words
        assert r.n_words == len(words) and r.word_chars == sum(map(len, words))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in text)
        assert r.n_lines == len(lines) and r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_repeat_words == repeat_words_by_hand(words)


def test_op13_agrees_with_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    want = sorted(con.execute(check_sql.QUALITY).fetchall())
    assert sorted(map(tuple, registered.op13_quality_rules(spark, SF_SMALL).collect())) == want


def test_the_cascade_orders_rules_by_rejections_and_keeps_the_verdict(spark):
    docs = registered.table(spark, SF_SMALL, "documents")
    sample = quality_rules.measured(docs).cache()
    cascade = quality_rules.Cascade(sample)
    ranks = [cascade.shares[r.name] / cascade.costs[r.name] for r in cascade.rules]
    assert ranks == sorted(ranks, reverse=True) and len(ranks) == len(quality_rules.RULES)
    forward = {r.doc_id: r.kept for r in quality_rules.quality(docs).collect()}
    backward = quality_rules.quality(docs, rules=quality_rules.RULES[::-1], sample_rows=1)
    assert {r.doc_id: r.kept for r in backward.collect()} == forward
    assert all(r.kept for r in quality_rules.quality(docs, rules=()).collect())
    plan = backward._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    sample.unpersist()


def test_quality_of_odd_rows(spark):
    docs = odd_documents(spark)
    rows = sorted(quality_rules.quality(docs).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    assert [r.n_words for r in rows] == [18, 18, 0, 0, 0, 200_000, 6]
    assert not any(r.kept for r in rows) and rows[5].rejected_by == "digits"
    assert quality_rules.quality(docs.limit(0)).count() == 0


def whitened_by_hand(rows):
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in rows], dtype=object)
    fit = np.array(sorted(set(map(tuple, x.tolist()))), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    covariance = (n * (fit.T @ fit) - np.outer(sums, sums)).astype(float) / n / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:16], vectors[:, ::-1][:, :16]
    white = (x.astype(float) - sums.astype(float) / n) @ vectors / np.sqrt(values)
    return n, ((n * x - sums) ** 2).sum(axis=1), white, values / np.trace(covariance)


def test_op11_on_a_table(spark):
    source = registered.table(spark, SF_CHECK, "embeddings").collect()
    n, deviation, white, explained = whitened_by_hand([r.embedding for r in source])
    got = {(r.vec_id, r.component): r for r in registered.op11_embedding_whitening(spark, SF_CHECK).collect()}
    assert len(got) == 16 * len(source)
    for k in range(16):
        mine = [got[r.vec_id, k + 1] for r in source]
        w = np.array([r.whitened for r in mine])
        assert min(np.abs(w - white[:, k]).max(), np.abs(w + white[:, k]).max()) < 1e-8
        assert [r.deviation for r in mine] == deviation.tolist()
        assert {r.n for r in mine} == {n} and len({r.identity_error for r in mine}) == 1
        assert mine[0].explained == pytest.approx(explained[k], rel=1e-9)
        assert mine[0].identity_error < 1e-9


def test_plane_products_are_cross_products():
    rng = np.random.default_rng(2)
    x = rng.integers(-50, 900, (1000, 3))
    low = x.min(axis=0)
    bits = np.array([int(v).bit_length() for v in x.max(axis=0) - low])
    counts = whitening.plane_products(whitening.bit_planes(x, low, bits))
    weight = np.concatenate([1 << np.arange(b) for b in bits])
    full = counts + np.triu(counts, 1).T
    ends = np.concatenate([[0], np.cumsum(bits)])
    for i in range(3):
        for j in range(3):
            a, b = slice(ends[i], ends[i + 1]), slice(ends[j], ends[j + 1])
            assert weight[a] @ full[a, b] @ weight[b] == ((x - low)[:, i] * (x - low)[:, j]).sum()


def test_whitening_of_odd_rows(spark):
    schema = "vec_id bigint, embedding array<double>, x int, n string, component string"
    rows = [
        (1, [1.0, 2.0], 1, "a", "b"),
        (1, [1.0, 2.0], 1, "a", "b"),
        (2, [3.5, -1.0], None, None, None),
        (None, [0.0, 9.0], 1, "a", "b"),
        (4, None, 1, "a", "b"),
        (5, [], 1, "a", "b"),
        (6, [NAN, 1.0], 1, "a", "b"),
        (7, [None, 1.0], 1, "a", "b"),
        (8, [1.0], 1, "a", "b"),
        (9, [INF, 0.0], 1, "a", "b"),
        (10, [-7.25, 4.0], 1, "a", "b"),
    ]
    df = spark.createDataFrame(rows, schema)
    out = whitening.whiten(df).collect()
    used = [rows[i] for i in (0, 1, 2, 3, 10)]
    n, deviation, white, _ = whitened_by_hand([r[1] for r in used])
    assert n == 4 and len(out) == 10
    for row, d, w in zip(used, deviation, white):
        for k in (1, 2):
            mine = [r for r in out if r.vec_id == row[0] and r.component == k]
            assert len(mine) == (2 if row[0] == 1 else 1)
            assert {int(r.deviation) for r in mine} == {d}
            assert abs(mine[0].whitened) == pytest.approx(abs(w[k - 1]), rel=1e-9)
    assert whitening.whiten(df.limit(0)).count() == 0
    alone = whitening.whiten(df.filter("vec_id = 1")).collect()
    assert len(alone) == 4 and all(r.whitened is None and r.identity_error is None for r in alone)
    huge = spark.createDataFrame([(1, [1e300, 2.0]), (2, [-1e300, 4.0])], "vec_id int, embedding array<double>")
    assert {round(r.whitened, 6) for r in whitening.whiten(huge).collect() if r.component == 1} == {-1.0, 1.0}

"""The training-data operators where a part of the job could be left out."""

from __future__ import annotations

import random
from pathlib import Path
from types import SimpleNamespace

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from loyalpulse.llm import cap_filters, line_dedup, passages, store
from loyalpulse.llm import queries as registered


def lower(text):
    return text.encode().lower().split()


def repeated(docs):
    """By brute force, the lines with a word that an earlier line is alike at 0.8."""
    seen, out = {}, set()
    for doc, text in sorted(docs):
        for k, line in enumerate(text.split("\n")):
            own = frozenset(lower(line))
            if own and (own in seen or any(100 * len(own & s) >= 80 * len(own | s) for s in seen)):
                out.add((doc, k))
            if own:
                seen[own] = True
    return out


def test_short_lines_take_part_in_the_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = repeated([(r.doc_id, r.text) for r in docs])
    rows = registered.op1_line_dedup(spark, SF_SMALL).collect()
    assert {(r.doc_id, k) for r in rows for k in r.removed} == want


def test_short_lines_go_in_the_pipeline(spark):
    texts = [
        (1, "Share this\nalpha beta gamma delta\none\n\nunlike words"),
        (2, "share THIS\nalpha beta gamma delta epsilon\none two three four\n\nother"),
        (3, "one two three\nONE\nkept here"),
    ]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, docs, "").collect()}
    gone = repeated(texts)
    assert gone == {(2, 0), (2, 1), (3, 1)}
    for doc, text in texts:
        assert got[doc] == "\n".join(x for k, x in enumerate(text.split("\n")) if (doc, k) not in gone)


def test_a_common_word_is_common_at_every_batch_edge(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SMALL", 2)
    shape = "word int, name bigint, doc bigint, line int, size int, place int, bits bigint, more_bits bigint"
    rows = spark.createDataFrame([(7, n, n, 0, 10, 0, 0, 0) for n in range(13)], shape)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for batch in range(1, 14):
            spark.conf.set(name, str(batch))
            got = line_dedup.candidates(rows, 80).collect()
            assert sorted((r.name, r.other) for r in got) == [(n, None) for n in range(13)]
    finally:
        spark.conf.set(name, before)


@pytest.mark.parametrize("master", ["yarn", "spark://one:7077", "local-cluster[2,1,1024]"])
def test_a_cluster_must_name_its_shared_folder(master):
    context = SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=lambda name: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        store.shared_folder(SimpleNamespace(sparkContext=context))


def test_discarded_tables_are_gone(spark):
    table = store.stored(spark.range(5))
    assert table.count() == 5
    store.discard(table)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(table.stored_at).count()


@pytest.mark.parametrize("turn", [1, -1])
def test_texts_that_share_an_id_lose_no_link(spark, turn):
    one = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [(1, f"{one}\nfirst text"), (1, f"unlike words here\n{one} lambda"), (2, f"other\n{one} mu")]
    docs = spark.createDataFrame(rows[::turn] + rows[:1], "doc_id bigint, text string")
    got = {(r.doc_id, r.copy, r.line) for r in line_dedup.repeated_lines(docs).collect()}
    copies = docs.select("text", line_dedup.text_key().alias("k")).distinct().collect()
    key = {r.text: r.k for r in copies}
    assert got == {(1, key[rows[1][1]], 1), (2, key[rows[2][1]], 1)}
    kept = line_dedup.without_repeated_lines(docs).collect()
    assert sorted(tuple(r) for r in kept) == sorted(
        [rows[0], rows[0], (1, "unlike words here"), (2, "other")]
    )


def test_near_copies_of_lines_by_brute_force(spark):
    draw = random.Random(3)
    base = [" ".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=12)) for _ in range(4)]
    texts = []
    for i in range(160):
        lines = []
        for line in draw.sample(base, 2):
            words = line.split()
            for _ in range(draw.randint(0, 4)):
                words[draw.randrange(len(words))] = draw.choice("abcdefghijklmnopqrstuvwxyz") * 2
            lines.append(" ".join(words))
        texts.append((i, "\n".join(lines)))
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(5)
    want = repeated(texts)
    for small in (512, 4):
        before, line_dedup.SMALL = line_dedup.SMALL, small
        try:
            got = line_dedup.repeated_lines(docs).collect()
        finally:
            line_dedup.SMALL = before
        assert {(r.doc_id, r.line) for r in got} == want
    assert len(want) > 100


def found_passages(spark, texts):
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    rows = passages.repeated_passages(docs).filter("kind = 'passage'").collect()
    return {(r.doc_id, r.first_word, r.n_words, r.component_id, r.kept) for r in rows}


def drawn_words(draw):
    return lambda n: ["".join(draw.choices("abcdefghij", k=7)) for _ in range(n)]


def test_every_shared_passage_is_found_to_its_ends(spark):
    word = drawn_words(random.Random(6))
    texts, want = {}, set()
    for i, size in enumerate([19, *[20] * 25, *range(21, 60)]):
        shared = word(size)
        for doc, before in ((2 * i, i % 9), (2 * i + 1, i % 7)):
            texts[doc] = " ".join([*word(before), *shared, *word(i % 8)])
            if size >= 20:
                want.add((doc, before, size, 2 * i, doc == 2 * i))
    assert found_passages(spark, texts) == want


def test_a_passage_is_wholly_first_or_wholly_repeated(spark):
    word = drawn_words(random.Random(7))
    shared, left, right = word(40), word(50), word(50)
    copied = " ".join(left + shared + right)
    rows = found_passages(spark, {1: " ".join(word(30) + shared + word(30)), 7: copied, 9: copied})
    gone = {d: {w for doc, a, n, _, kept in rows if doc == d and not kept for w in range(a, a + n)} for d in (1, 7, 9)}
    assert gone == {1: set(), 7: set(range(50, 90)), 9: set(range(140))}
    assert {r for r in rows if r[3] == 1} == {(1, 30, 40, 1, True), (7, 50, 40, 1, False), (9, 50, 40, 1, False)}
    # a text that repeats itself: what overlaps the first occurrence is not a second one
    assert found_passages(spark, {1: "a " * 39, 2: "b " * 60}) == {(2, 0, 20, 2, True), (2, 20, 40, 2, False)}


def vectors_at(similarity, width, count, draw):
    one = draw.normal(size=(count, width))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    side = draw.normal(size=(count, width))
    side -= (one * side).sum(axis=1, keepdims=True) * one
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    return one, similarity * one + np.sqrt(1 - similarity**2) * side


@pytest.mark.parametrize("width", [2, 4, 8, 16, 64])
@pytest.mark.parametrize("count", [200, 10_000, 1_000_000])
def test_similar_vectors_share_a_filter_at_any_width_and_count(width, count):
    codes = cap_filters.ProductCodes(width, count, 0.98)
    one, other = vectors_at(0.98, width, 2000, np.random.default_rng(11))
    both = zip(codes.filters(one), codes.filters(other), strict=True)
    assert sum(not len(np.intersect1d(a, b)) for a, b in both) <= 3  # 0.2 expected at 1e-4


def test_short_vectors_are_linked_as_by_brute_force(spark):
    draw, rows = np.random.default_rng(12), []
    for width, count in ((2, 350), (8, 100), (16, 100)):  # of width 2, more than a block
        for pair in vectors_at(0.985, width, count, draw):
            rows += [(len(rows) + i, v.tolist(), 1) for i, v in enumerate(pair)]
    links = {}
    for i, v, _ in rows:
        same = np.array([w for _, w, _ in rows if len(w) == len(v)])
        cosines = same @ np.array(v) / np.linalg.norm(same, axis=1) / np.linalg.norm(v)
        links[i] = int((cosines >= 0.98).sum()) - 1
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    assert {r.vec_id: r.n_links for r in cap_filters.near_vectors(vectors).collect()} == links


def runs_by_brute_force(texts, least):
    """``(doc, first, origin, kept)`` of every run of ``least`` words that recurs."""
    places = {}
    for doc, text in sorted(texts.items()):
        words = lower(text)
        for i in range(len(words) - least + 1):
            places.setdefault(tuple(words[i : i + least]), []).append((doc, i))
    out = set()
    for (origin, start), *others in places.values():
        again = [p for p in others if p[0] != origin or p[1] - start >= least]
        out |= {(*p, origin, False) for p in again}
        out |= {(origin, start, origin, True)} if again else set()
    return out


@pytest.mark.parametrize("common", [1 << 15, 6, 0])
def test_runs_of_rare_and_common_seeds_by_brute_force(spark, monkeypatch, common):
    monkeypatch.setattr(passages, "COMMON", common)
    draw = random.Random(8)
    pieces = [draw.choices("abcdefg", k=draw.randint(5, 40)) for _ in range(12)] + [["x"] * 30, ["y", "z"] * 20]
    texts = {i: " ".join(w for p in draw.choices(pieces, k=draw.randint(1, 8)) for w in p) for i in range(60)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for batch in (3, 10_000):
            spark.conf.set(name, str(batch))
            rows = passages.repeated_runs(docs, 20).collect()
            got = [(r.doc_id, k, r.origin, r.kept) for r in rows for k in range(r.first, r.last + 1)]
            assert len(got) == len(set(got)) and set(got) == runs_by_brute_force(texts, 20)
            if common > 1000:  # a row stands for several runs
                assert 2 * len(rows) < len(got)
    finally:
        spark.conf.set(name, before)


def test_tables_on_the_way_to_the_paragraphs_are_deleted(spark, monkeypatch):
    made = []
    folder = store.shared_folder
    monkeypatch.setattr(store, "shared_folder", lambda spark: made.append(folder(spark)) or made[-1])
    line = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(i, f"{line}\nown{i}") for i in range(4)], "doc_id bigint, text string")
    found = passages.repeated_passages(docs)
    left = [p for p in made if Path(p).exists()]
    assert len(made) > 5 and len(left) == 2  # the paragraphs and the runs
    assert {(r.doc_id, r.kind) for r in found.collect()} == {(i, k) for i in range(4) for k in ("paragraph", "passage")}


def test_a_stage_of_the_pipeline_hands_texts_on_in_small_batches(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    docs = spark.range(20).selectExpr(
        "id AS doc_id", "repeat('ab cd ', 200000) AS text", "'en' AS lang", "'s' AS source", "0L AS n_chars"
    )

    def largest(batches):
        yield pa.RecordBatch.from_pydict({"n": [max(b.nbytes for b in batches)]})

    try:
        for stage in (corpus_pipeline.lines, corpus_pipeline.mix):
            spark.conf.set(name, str(64 << 20))
            stage(spark, docs.limit(2), "")
            got = docs.coalesce(1).mapInArrow(largest, "n bigint").collect()
            assert got[0].n < 2 * corpus_pipeline.BATCH_BYTES
    finally:
        spark.conf.set(name, before)


def test_texts_stay_out_of_the_join_with_their_repeated_lines(spark):
    docs = spark.createDataFrame([(1, "a b c\na b c"), (2, "a b c"), (3, None)], "doc_id bigint, text string")
    answer = line_dedup.per_document(docs)
    assert sorted(tuple(r) for r in answer.collect()) == [(1, 2, 1, [1]), (2, 1, 1, [0]), (3, 0, 0, [])]
    node = answer._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Join":
        node = node.children().head()
    output = node.children().head().output()
    assert "text" not in {output.apply(i).name() for i in range(output.size())}


def test_rows_of_prefix_words_travel_in_six_numbers(spark):
    shape = "word int, name bigint, doc bigint, line int, size int, place int, bits bigint, more_bits bigint"
    rows = spark.createDataFrame([(-7, 1, 2, 3, 4, 5, 6, 7), (9, 1, 2, 2**31 - 1, 4, 0, 6, 7)], shape)
    sent = line_dedup._by_word(rows)
    assert len(sent.columns) == 6
    got = {(r.key >> 32, r.key & 0xFFFFFFFF, r["at"] >> 32, r["at"] & 0xFFFFFFFF) for r in sent.collect()}
    assert got == {(-7, 4, 3, 5), (9, 4, 2**31 - 1, 0)}


@pytest.mark.parametrize("shift", [0, 40])
def test_words_are_ordered_by_line_rank_and_hash(shift):
    r = np.random.default_rng(5)
    n = 400  # with few upper bits, words differ in the lower ones only
    hashes = r.integers(0, 200, n).astype(np.uint64) << np.uint64(shift)
    line = np.sort(r.integers(0, 5, n))
    run = line_dedup.Run(hashes, line, line, line, line)
    own = r.integers(0, 3, n).astype(np.uint8)
    order = line_dedup._ordered(run, own)
    want = sorted(zip(line.tolist(), own.tolist(), hashes.tolist()))
    assert list(zip(line[order].tolist(), own[order].tolist(), hashes[order].tolist())) == want


def test_the_earliest_row_of_each_set_at_a_word():
    r = np.random.default_rng(6)
    rows = [tuple(map(int, x)) for x in r.integers(0, [3, 4, 6, 5, 3], (300, 5))]
    rows.sort(key=lambda x: x[:2])
    word, size, name, doc, line = np.array(rows).T
    got = line_dedup._earliest({"word": word, "size": size, "name": name, "doc": doc, "line": line})
    want = {}
    for row in rows:
        want[row[:3]] = min(want.get(row[:3], row), row)
    assert sorted(rows[i] for i in got) == sorted(want.values())

"""The training-data operators against brute force, round trips and held-out accuracy."""

from __future__ import annotations

import base64
import json
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from conftest import SF_CHECK, SF_SMALL
from loyalpulse.llm import (
    cap_filters,
    elias_fano,
    encode,
    language,
    line_dedup,
    minhash,
    mixing,
    packing,
    passages,
    projected_search,
    secrets_scan,
    words,
)
from loyalpulse.llm import queries as registered

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, a int"
LONG = " ".join(f"w{i}x{i * i % 97}" for i in range(3000))
WORDY = "one two three four five six seven eight nine ten eleven twelve"
#: Nulls in every column, empty and long texts, repeated rows, and names used inside.
ODD_ROWS = [
    (1, WORDY, "en", "s", 1, "x", 1),
    (1, WORDY, "en", "s", 1, "x", 1),
    (2, WORDY, None, None, None, None, None),
    (3, None, "en", "s", 1, "x", 1),
    (4, "", "en", "s", 1, "x", 1),
    (5, " \n\t ", None, "t", 0, "", 0),
    (6, LONG, "en", "t", 0, "", 0),
    (7, LONG + " more", "en", "t", 0, "", 0),
    (None, WORDY, "en", "s", 1, "x", 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD_ROWS, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def lower(text):
    return text.encode().lower().split()


def test_word_hashes_tell_words_apart():
    made = [bytes(random.Random(i).choices(b"abcdZ", k=i % 9 + 1)) for i in range(4000)]
    data = np.frombuffer(b" \t".join(made) + b"\n", dtype=np.uint8)
    hashes, starts, ends = words.word_hashes(data)
    assert [data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)] == made
    assert len(set(hashes.tolist())) == len({w.lower() for w in made})


def test_encoder_equals_the_tokenizer():
    tokenizer = Tokenizer.from_file(PATH)
    alphabet = [*"ab'sC1 .,\n\t\ré \x1c", "<|endoftext|>", "'ll", "\n\n", "  ", "漢"]
    draw = random.Random(3)
    texts = ["".join(draw.choices(alphabet, k=draw.randint(0, 30))) for _ in range(3000)] + [None]
    for text, ids in zip(texts, encode.encoded(pa.array(texts), PATH, 200), strict=True):
        assert ids.tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize(("n", "top"), [(0, 1), (1, 0), (1, 2**40), (900, 7), (900, 2**45)])
def test_elias_fano_selects(n, top):
    values = np.sort(np.random.default_rng(n).integers(0, top + 1, n)).astype(np.uint64)
    code = elias_fano.EliasFano(b"--" + elias_fano.encode(values), 2)
    assert code.all().tolist() == [code[i] for i in range(n)] == values.tolist()


def test_minimum_slack_packs_all_and_fills_well():
    draw = random.Random(1)
    counts = {n: draw.randint(0, 40) for n in range(1, 65)}
    made = packing.minimum_slack(counts, 128)
    used = {}
    for c in made:
        assert sum(n * k for n, k in c.parts) <= 128
        for n, k in c.parts:
            used[n] = used.get(n, 0) + k * c.times
    assert used == {n: c for n, c in counts.items() if c}
    assert sum(c.times for c in made) <= sum(n * c for n, c in counts.items()) / 128 + 1


def test_token_files_and_packing_hold_the_tokenizer_ids(spark):
    tokenizer = Tokenizer.from_file(PATH)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect()
    ids = {r.doc_id: tokenizer.encode(r.text, add_special_tokens=False).ids for r in docs}
    rows = registered.op6_token_files(spark, SF_SMALL).orderBy("doc_id").collect()
    start = 0
    assert [r.doc_id for r in rows] == [d.doc_id for d in docs]
    for r in rows:
        own = np.array([*ids[r.doc_id], 2], dtype="<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(own), zlib.crc32(own))
        start += len(own)
    bins = {}
    for r in registered.op8_best_fit_packing(spark, SF_SMALL).collect():
        own = np.array([*ids[r.doc_id], 0], dtype="<u4")[r.start : r.start + r.length]
        assert (len(own), zlib.crc32(own)) == (r.length, r.ids_crc32)
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048


def brute_components(sets, alike):
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and alike(sets[x], sets[y]):
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_near_duplicates_equal_brute_force(spark, small):
    def shingles(text):
        w = lower(text)
        return {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()

    sets = {r.doc_id: shingles(r.text) for r in small.collect()}
    want = brute_components(sets, lambda a, b: a and 100 * len(a & b) >= 80 * len(a | b))
    got = registered.op2_minhash_dedup(spark, SF_SMALL).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.kept == (r.doc_id == want[r.doc_id]) for r in got)
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(s) for i, s in sets.items()}


def test_repeated_lines_equal_brute_force(spark, small):
    seen, want = [], set()
    for r in sorted(small.collect(), key=lambda r: r.doc_id):
        for k, line in enumerate(r.text.split("\n")):
            own = set(lower(line))
            if own:
                if any(100 * len(own & s) >= 80 * len(own | s) for s in seen):
                    want.add((r.doc_id, k))
                seen.append(own)
    got = line_dedup.repeated_lines(small).collect()
    assert {(r.doc_id, r.line) for r in got} == want


def test_common_prefix_words_go_the_other_exact_way(spark, small, monkeypatch):
    want = {tuple(r) for r in line_dedup.repeated_lines(small).collect()}
    monkeypatch.setattr(line_dedup, "SMALL", 2)
    assert {tuple(r) for r in line_dedup.repeated_lines(small).collect()} == want


def test_vectors_equal_brute_force(spark):
    table = spark.read.parquet(f"{SF_CHECK}/embeddings.parquet").limit(120).collect()
    draw = np.random.default_rng(0)
    rows = [(r.vec_id, [float(x) for x in r.embedding], r.label) for r in table]
    for i in range(60):
        base = np.array(rows[i % 7][1])
        near = (base + draw.normal(size=64) * 0.01).tolist()
        rows.append((1000 + i, near, rows[i % 7][2] if i % 5 else None))
    rows += [(2000, None, 1), (2001, [0.0] * 64, 1), (2002, [float("nan")] * 64, 1), (2003, rows[0][1], rows[0][2])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    good = {i: (np.array(v) / np.linalg.norm(v), c) for i, v, c in rows if c is not None and i not in (2000, 2001, 2002)}
    alike = lambda a, b: a[1] == b[1] and float(a[0] @ b[0]) >= 0.98
    want = brute_components(good, alike) | {i: i for i, *_ in rows if i not in good}
    links = {i: sum(alike(good[i], v) for j, v in good.items() if j != i) if i in good else 0 for i, *_ in rows}
    got = cap_filters.near_vectors(vectors).collect()
    assert {r.vec_id: r.component_id for r in got} == want
    assert {r.vec_id: r.n_links for r in got} == links


def test_search_recall_and_scores(spark):
    rows = spark.read.parquet(f"{SF_CHECK}/embeddings.parquet").collect()
    x = {r.vec_id: np.array(r.embedding, dtype=np.float64) for r in rows}
    got = {}
    for r in registered.op7_nearest_vectors(spark, SF_CHECK).collect():
        assert r.score == pytest.approx(float(x[r.query_id] @ x[r.vec_id]), abs=1e-12)
        got.setdefault(r.query_id, {})[r.rank] = r.vec_id
    found = 0
    for q, ranked in got.items():
        best = sorted((i for i in x if i != q), key=lambda i: (-float(x[q] @ x[i]), i))[:20]
        found += len(set(best) & set(ranked.values()))
        assert sorted(ranked) == list(range(1, 21))
    assert sorted(got) == sorted(i for i in x if i % 20 == 0)
    assert found >= 0.9 * 20 * len(got)
    assert projected_search.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)


def test_secrets_are_confirmed_by_structure():
    part = lambda d: base64.urlsafe_b64encode(json.dumps(d).encode()).decode().rstrip("=")
    token = f"{part({'alg': 'HS256'})}.{part({'sub': 'me'})}.c2lnbmF0dXJl"
    unsigned = f"{part({'typ': 'none'})}.{part({'sub': 'me'})}.c2lnbmF0dXJl"
    der = bytes([0x30, 38, 2, 1, 0, 0x30, 5, 6, 3, 43, 101, 112, 4, 26]) + bytes(range(26))
    key, broken = base64.b64encode(der).decode(), base64.b64encode(der[:-1]).decode()
    text = f"é password = abcdefgh12 {token} {unsigned} {key} {broken} {der.hex()} AKIA{'A' * 16}"
    found = [(kind, text[a:b]) for kind, a, b in secrets_scan.find_secrets(text)]
    assert ("assign", "password = abcdefgh12") in found
    assert [s for k, s in found if k == "token"] == [token]
    assert [s for k, s in found if k == "key"] == [key, der.hex()]
    assert [s for k, s in found if k == "access"] == ["AKIA" + "A" * 16]
    assert ("hex", der.hex()) in found
    assert secrets_scan.find_secrets("secret: short\nAKIA12 0123abcd") == []


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "lang")
    rows = registered.op10_language_id(spark, SF_CHECK).join(docs, "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    assert language.Model((), *[np.zeros((0, 0))] * 2, np.zeros(0), np.zeros(0)).predict("abc")[0] == "und"
    for count in (2, 5, 9):
        assert len(np.unique(language.codewords(count), axis=0)) == count


def test_mix_comes_near_its_targets(spark):
    rows = registered.op5_mix_sources(spark, SF_CHECK).collect()
    again = registered.op5_mix_sources(spark, SF_CHECK).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    taken, target = {}, {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.target, r.source_size] = taken.get((r.target, r.source_size), 0) + r.taken
    assert all(abs(t - key[0]) <= 0.03 * key[0] for key, t in taken.items())
    assert mixing.shares([1, 100, 100], [5, 2, 1]) == pytest.approx([3, 132, 66])
    for size in (1, 2, 5, 1000):
        n = np.full(size, size)
        order = mixing.permuted(np.arange(size), n, np.full(size, 9, dtype=np.uint64))
        assert sorted(order.tolist()) == list(range(size))


def test_a_passage_inside_other_paragraphs_is_found(spark):
    draw = random.Random(4)
    word = lambda: "".join(draw.choices("abcdefghij", k=6))
    shared = " ".join(word() for _ in range(60))
    texts = [" ".join([*(word() for _ in range(80)), *mid, *(word() for _ in range(80))]) for mid in ([shared], [shared], [])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = passages.repeated_passages(docs).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in rows} == {(0, 0, True), (1, 0, False)}
    assert all(80 <= r.first_word and r.first_word + r.n_words <= 140 for r in rows)


def test_odd_rows_have_defined_results(odd):
    near = {(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(odd).collect()}
    assert near == {
        (1, 1, True), (2, 1, False), (3, 3, True), (4, 4, True), (5, 5, True), (6, 6, True),
        (7, 6, False), (None, None, True),
    }
    kept = minhash.without_near_duplicates(odd)
    assert kept.columns == odd.columns and kept.count() == 6
    gone = {r.doc_id: r.n_removed for r in line_dedup.per_document(odd).collect()}
    assert gone == {1: 0, 2: 1, 3: 0, 4: 0, 5: 0, 6: 0, 7: 1, None: 0}
    assert {r.doc_id for r in line_dedup.without_repeated_lines(odd).collect()} == {1, 3, 4, 5, 6, None}
    assert secrets_scan.scan(odd).count() == len(ODD_ROWS)
    packed = packing.pack(odd, PATH)
    assert packed.filter("doc_id = 3 OR doc_id = 4").select("length").distinct().first()[0] == 1
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns and mixed.filter("text IS NULL OR text = ''").count() == 0
    assert mixing.Mix(odd).per_document().count() == len(ODD_ROWS)
    assert {r.doc_id for r in passages.repeated_passages(odd).collect()} == {6, 7}
    found = {r.doc_id: r.lang_pred for r in language.identify(odd, language.fit(odd)).collect()}
    assert (found[3], found[4], found[5], found[6]) == ("und", "und", "und", "en")


def test_empty_tables(spark, empty):
    for df in (
        minhash.near_duplicates(empty),
        line_dedup.per_document(empty),
        secrets_scan.scan(empty),
        packing.pack(empty, PATH),
        mixing.Mix(empty).per_document(),
        mixing.mixed_documents(empty),
        passages.repeated_passages(empty),
        language.identify(empty, language.fit(empty)),
        cap_filters.near_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")),
        projected_search.nearest(spark.createDataFrame([], "vec_id bigint, embedding array<float>"), 20),
    ):
        assert df.count() == 0


def test_pipeline_keeps_the_columns_of_documents(spark):
    import corpus_pipeline

    docs = registered.table(spark, SF_SMALL, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns and 0 < out.count()

"""Corpus operators against plain versions, and on awkward input."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from compare import compare, connect
from martlens.llm import (common, components, decontam, langid, minhash, mixing, oracle, pii, queries, simhash, substrings, tokens,
                          toxicity, warc)

public_tokenizers = pytest.importorskip("public_tokenizers")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, block long, key string"


@pytest.fixture(scope="module", autouse=True)
def attached(spark):
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        pytest.skip("spark.checkpoint.dir is not set")
    common.attach(spark)


def frame(spark, texts, ids=None, langs=None, sources=None):
    """Documents with two extra columns whose names the operators use inside."""
    n = len(texts)
    ids, langs, sources = ids or list(range(n)), langs or ["en"] * n, sources or ["s"] * n
    return spark.createDataFrame([(i, t, la, s, len(t or ""), 1, "k") for i, t, la, s in zip(ids, texts, langs, sources, strict=True)], DOCS)


LONG = "word " * 30_000 + "end"
AWKWARD = [None, "", " \n\t", "one", "one", "A b\x0bc\x1cd", LONG, "ÄÖ é́ ß ﬁ 中文", "a@" * 500 + "1." * 500 + "+" * 200]


# -- every query: SQL or rows, empty tables ----------------------------------------------------------------------------
@pytest.fixture(scope="module")
def duck(sf_dir):
    con = connect(sf_dir)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_query_equals_sql(name, spark, sf_dir, duck):
    assert compare(queries.QUERIES[name](spark, sf_dir), duck, oracle.ORACLE[name]) == []


EMPTY = [
    ("near_groups", lambda s, d: minhash.near_groups(d)), ("keep_first", lambda s, d: minhash.keep_first(d)),
    ("token_files", lambda s, d: tokens.token_files(d, VOCABULARY)), ("find_pii", lambda s, d: pii.find_pii(d)),
    ("toxicity", lambda s, d: toxicity.toxicity(d, s.createDataFrame([], "doc_id long, toxic int"))),
    ("archive", lambda s, d: warc.archive(s.createDataFrame([], "page_id long, url string, html string"))),
    ("mix_table", lambda s, d: mixing.mix_table(d)), ("mixed_rows", lambda s, d: mixing.mixed_rows(d, {"a": 1})),
    ("remove_repeats", lambda s, d: substrings.remove_repeats(d)),
    ("decontaminate", lambda s, d: decontam.decontaminate(d, s.createDataFrame([], "item_id long, text string"))),
    ("languages", lambda s, d: langid.languages(d)), ("fingerprint_table", lambda s, d: simhash.fingerprint_table(d)),
]


@pytest.mark.parametrize("name, run", EMPTY, ids=[n for n, _ in EMPTY])
def test_empty_tables_give_no_rows(name, run, spark):
    assert run(spark, frame(spark, ["x"]).where("false")).count() == 0


# -- 1 near-duplicates -------------------------------------------------------------------------------------------------
def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def plain_groups(rows, percent):
    sets, root = {i: shingle_set(t) for i, t in rows}, {i: i for i, _ in rows}

    def find(x):
        return x if root[x] == x else find(root[x])

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_texts(seed, groups=8, size=12):
    rng, texts = random.Random(seed), []
    for _ in range(groups):
        base = [rng.choice("abcdefghij") + str(rng.randrange(500)) for _ in range(rng.choice([3, 12, 60, 200]))]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randrange(0, max(2, len(w) // 25))):
                w[rng.randrange(len(w))] = "x" + str(rng.randrange(9))
            texts.append(" ".join(w).upper() if rng.random() < 0.3 else "  ".join(w))
    return texts


@pytest.mark.parametrize("percent", [80])
def test_groups_equal_all_pairs(spark, percent, monkeypatch):
    monkeypatch.setattr(minhash, "SET_BLOCK", 4)
    monkeypatch.setattr(minhash, "BLOCK", 8)
    texts = near_texts(percent) + [t for t in AWKWARD if t != LONG]
    want = plain_groups(list(enumerate(texts)), percent)
    got = minhash.near_groups(frame(spark, texts), percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_null_and_repeated_ids_in_groups(spark):
    text = " ".join(f"w{i}" for i in range(40))
    got = minhash.near_groups(frame(spark, [text, text, text, None], [5, 5, None, None])).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == Counter(
        {(5, 36, 5, True): 2, (None, 36, None, True): 1, (None, 0, None, True): 1})


def test_signature_fields_count_as_unpacked():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 1 << 32, (50, minhash.N_HASH), dtype=np.uint32) for _ in "ab")
    b[:, ::3] = a[:, ::3]
    plain = ((a & 15) == (b & 15)).sum(axis=1)
    packed = [np.stack([minhash.packed(r) for r in x]) for x in (a, b)]
    assert (minhash.equal_fields(*packed) == plain).all()
    assert abs(minhash.estimate(*packed).mean() - 1 / 3) < 0.02  # chance agreements are taken out


def test_components_of_a_long_path(spark, tmp_path):
    links = spark.createDataFrame([(i, i + 1) for i in range(12)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components.components(links, str(tmp_path)).collect()}
    assert got == {i: 0 for i in range(13)} | {100: 100, 101: 100}


# -- 2 token files -----------------------------------------------------------------------------------------------------
def test_variable_length_round_trip():
    rng = np.random.default_rng(2)
    counts = np.array([0, 1, 3, 4, 5, 1000])
    ranks = [rng.integers(0, 1 << int(rng.choice([8, 16, 24, 32])), n, dtype=np.uint64).astype(np.uint32) for n in counts]
    control, c_index, data, d_index = tokens.encode(np.concatenate(ranks), counts)
    assert (tokens.decode(control, counts, data) == np.concatenate(ranks)).all()
    for k, r in enumerate(ranks):
        own = tokens.decode(control[c_index[k]:c_index[k + 1]], counts[k:k + 1], data[d_index[k]:d_index[k + 1]])
        assert (own == r).all()


def test_word_encoder_equals_the_tokenizer(monkeypatch):
    """On every document of sf0.01 and awkward texts, also when the encoder must forget."""
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist() + AWKWARD + [
        "a.b,c!d 12ab34 x'y ''s 't'll a!'s ...'re |a| b|c | \u0301e e\u0301! <\u0338 a<\u0338b ǅ Σ.ΑΣ, İx ﬁ1 ²³ a_b-c"]
    for limit in (40_000_000, 100_000):
        monkeypatch.setattr(tokens, "CACHE_BYTES", limit)
        own, at = tokens.WordEncoder(VOCABULARY), 0
        for batch in common.slices(iter([pa.record_batch([pa.array(texts, pa.string())], names=["text"])]), limit=200_000):
            ids, index = own.batch(batch.column("text"))
            for a, b in zip(index[:-1], index[1:]):
                assert np.array_equal(ids[a:b], own.whole(texts[at] or "")), texts[at][:80]
                at += 1
        assert at == len(texts)


def test_token_files_equal_the_tokenizer(spark, sf_dir, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "FILE_IDS", 3000)
    monkeypatch.setattr(tokens, "RANGE_IDS", 20_000)
    texts = AWKWARD + ["don't it's  A<|endoftext|>b", "naïve…» 12,34 \x1c z!?", "Σας İI"] + [
        r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()]
    ids = [3, 3, None, *range(1000, 1000 + len(texts) - 3)]
    own = Tokenizer.from_file(VOCABULARY)
    want = Counter()
    for i, t in zip(ids, texts, strict=True):
        row = np.array([*own.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want[i, len(row), zlib.crc32(row.tobytes())] += 1
    got = tokens.token_files(frame(spark, texts, ids), VOCABULARY).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1]]


# -- 3 personal data ---------------------------------------------------------------------------------------------------
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_base(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                    "card": 12 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_plain_spans_equal_the_patterns(spark, sf_dir):
    rng = random.Random(4)
    texts = ["".join(rng.choice("a.@-+ 1239") for _ in range(120)) for _ in range(300)] + [
        "4111 1111 1111 1111", "1.2.3.4.5.6.7.8 300.1.1.1 001.2.3.4", "+1 (555) 123-4567", "é a@b.c.d@e.f é"]
    texts += [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    for t in texts:
        assert pii.plain_spans(t) == plain_base(t)
    rows = {r.doc_id: r for r in pii.find_pii(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        base = plain_base(t)
        assert [rows[i][f"n_{k}"] for k in pii.KINDS] == [sum(s[1] == k for s in base) for k in range(4)]
        assert rows[i].base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()


@pytest.mark.parametrize("text, found", [
    ("write john [at] example [dot] com now", [("email", "john [at] example [dot] com")]),
    ("john dot doe at mail dot example dot com", [("email", "john dot doe at mail dot example dot com")]),
    ("jоhn.smith@exаmple.com", [("email", "jоhn.smith@exаmple.com")]),
    ("x​y@exam​ple.com", [("email", "x​y@exam​ple.com")]),
    ("４１１１ 1111 1111 1111", [("card", "４１１１ 1111 1111 1111")]),
    ("call plus one five five five one two three four five six seven", [("phone", "plus one five five five one two three four five six seven")]),
    ("host 10 dot 0 dot 0 dot 1", [("ip", "10 dot 0 dot 0 dot 1")]),
    ("4lll-1111-1111-11l1", []),
    ("I am at home. Look at thon.The dot and one two three", []),
])
def test_disguised_identifiers_map_back(text, found):
    spans = [(pii.KINDS[k], text[s:e]) for s, k, e in pii.all_spans(text)[1]]
    assert [s for s in spans if s in found] == found and (found or not spans)


@pytest.mark.parametrize("text, found", [
    ("write jane @ example.nl or", [("email", "jane @ example.nl")]),
    ("write jane at example.ch.", [("email", "jane at example.ch")]),
    ("jane arroba mail.example.swiss", [("email", "jane arroba mail.example.swiss")]),
    ("call +49 one seven six 5550199 now", [("phone", "+49 one seven six 5550199")]),
    ("call +49 17 six 5550199 now", [("phone", "+49 17 six 5550199")]),
    ("host 192 dot 168 dot one dot five is up", [("ip", "192 dot 168 dot one dot five")]),
    ("jane at one dot two dot com", [("email", "jane at one dot two dot com")]),
    ("+49 176 5550199 one of them", [("phone", "+49 176 5550199")]),
    ("one of 2019, two or 3 at noon", []),
])
def test_short_disguises_map_back(text, found):
    assert [(pii.KINDS[k], text[s:e]) for s, k, e in pii.all_spans(text)[1]] == found


LENGTHY = {
    "digits": "1" * 200_000, "parts": "1." * 100_000, "words": "one " * 50_000, "two words": "one two " * 25_000, "spaced digits": "1 " * 100_000,
    "spaces": "a" + " " * 200_000 + "a", "brackets": "a " + "[ " * 100_000, "dots": "a (dot) " * 25_000, "ats": "a at " * 40_000, "signs": "a@" * 100_000,
    "left of at": "a" * 200_000 + "@", "host": "a at " + "b" * 200_000, "host parts": "a at " + "b." * 100_000, "pluses": "+1 " * 70_000,
    "open phone": "+1" + " " * 200_000, "mixed": "Ol1" * 70_000, "lookalikes": "а@е.х " * 30_000, "addresses": "a@b.c [at] " * 20_000, "dot words": "1 dot " * 40_000,
}


@pytest.mark.parametrize("text", LENGTHY.values(), ids=LENGTHY)
def test_long_texts_take_linear_time(text):
    """200,000 characters of the kinds that could make a pattern start anew at each of them."""
    began = time.process_time()
    base, _ = pii.all_spans(text)
    assert time.process_time() - began < 3
    if len(text) <= 200_000 and text.isascii() and "1." in text:
        assert len(base) == 25_000  # addresses of four parts


def test_spans_inside_plain_ones_are_found_by_kind():
    text = "a@b.cc, " * 40 + "mail x [at] y.zz and a@b.cc"
    base, every = pii.all_spans(text)
    assert len(base) == 41 and len(every) == 42


def test_awkward_texts_take_little_time(spark):
    rows = pii.find_pii(frame(spark, AWKWARD + ["1" * 200_000, "a" * 200_000 + "@", "1 " * 100_000, "one " * 50_000])).collect()
    assert len(rows) == len(AWKWARD) + 4


# -- 4 toxicity, 9 languages -------------------------------------------------------------------------------------------
def test_toxicity_on_held_out_rows(spark, sf_dir):
    folder = sf_dir.replace("0.001", "0.01")
    docs, labels = (common.table(spark, folder, t) for t in ("documents", "labels"))
    rows = toxicity.toxicity(docs, labels).join(labels, "doc_id").collect()
    assert {r.held_out for r in rows} == {True, False}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    caught = [r for r in rows if r.predicted]
    assert sum(r.toxic for r in caught) >= 0.9 * len(caught) and len(caught) >= 0.6 * sum(r.toxic for r in rows)


def test_held_out_labels_are_not_used(spark, sf_dir):
    docs, labels = (common.table(spark, sf_dir, t) for t in ("documents", "labels"))
    held = common.id_remainder(F.col("doc_id"), 5) == 0
    changed = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r.doc_id: r.score for r in toxicity.toxicity(docs, x).collect()} for x in (labels, changed))
    assert a == b


def test_words_are_counted_in_all_distinct_texts(spark, monkeypatch):
    seen, choose = [], toxicity.telling_buckets
    monkeypatch.setattr(toxicity, "telling_buckets", lambda counts, positives, total, most: (
        seen.append(({r.bucket: (r.n_positive, r.n_all) for r in counts.collect()}, positives, total)), choose(counts, positives, total, most))[1])
    texts = [f"vile word{i}" for i in range(20)] + [f"vile rare{i}" for i in range(200)] + [f"plain word{i}" for i in range(200)]
    docs = frame(spark, texts + texts[:50] + ["of no id"], [*range(len(texts) + 50), None])
    labels = spark.createDataFrame([(i, int(i < 20)) for i in range(220)], "doc_id long, toxic int")
    toxicity.train(docs, labels, F.lit(True), max_unlabelled=20, max_positive=5)
    row, bucket = toxicity.bucket_sets(pa.array([*texts, "of no id"]))
    want = {int(b): (int(((bucket == b) & (row < 20)).sum()), int((bucket == b).sum())) for b in set(bucket)}
    assert seen == [(want, 20, len(texts) + 1)]


def test_risk_stays_non_negative():
    rng = np.random.default_rng(5)
    toxic = [[0, int(rng.integers(2, 30))] for _ in range(40)]
    other = [[1, int(rng.integers(2, 30))] for _ in range(360)]
    w, b = toxicity.fit_nnpu(toxic[:20], toxic + other, 30, 0.1)
    score = lambda rows: np.array([b + w[r].sum() for r in rows])
    assert (score(toxic) > 0).all() and (score(other) < 0).all()


def test_without_labels_every_text_gets_the_prior(spark):
    rows = toxicity.toxicity(frame(spark, AWKWARD), spark.createDataFrame([(1, 0), (2, None)], "doc_id long, toxic int")).collect()
    assert len(rows) == len(AWKWARD) and len({r.score for r in rows}) == 1 and not any(r.predicted for r in rows)


def test_languages_on_held_out_rows(spark, sf_dir):
    docs = common.table(spark, sf_dir.replace("0.001", "0.01"), "documents")
    rows = langid.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and 0 <= r.score <= 1 for r in rows)


def test_texts_without_letters_are_undetermined(spark):
    texts = ["der die das und nicht", "the and of with", "le la les des", "el los que y"] * 10 + [None, "", "12 !?", "中", "½ ² ① 7"]
    langs = ["de", "en", "fr", "es"] * 10 + [None, "en", None, None, None]
    got = {r.doc_id: r.lang_pred for r in langid.languages(frame(spark, texts, langs=langs)).collect()}
    assert [got[i] for i in (40, 41, 42, 44)] == ["und"] * 4 and got[43] != "und"
    assert sum(got[i] == langs[i] for i in range(40)) == 40


# -- 5 archives --------------------------------------------------------------------------------------------------------
def test_archive_round_trip_and_lookup(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 2000)
    monkeypatch.setattr(warc, "BLOCK", 3)
    same = "<p>é" + "x" * 100
    pages = [(7, "http://b.example.com/x?q=1#f", same), (3, "https://B.example.com:443/y", same), (9, None, None), (None, "http://b.example.com/x?q=1", same),
             (4, "ftp://[bad", "tiny"), (5, "http://u@a.org:81/", "tiny")] + [(100 + i, f"http://site{i % 7}.net/{i}", f"page {i} " * i) for i in range(40)]
    frame_ = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, length int").repartition(3)
    got = Counter(tuple(r) for r in warc.archive(frame_, str(tmp_path / "w")).collect())
    want = Counter()
    for page, _, html in pages:
        body = (html or "").encode()
        refers = 3 if html == same and page != 3 else None
        want[page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if refers else "response", refers] += 1
    assert got == want
    directory = spark.read.parquet(str(tmp_path / "w" / "index" / "directory"))
    asked = spark.createDataFrame([("http://b.example.com/x?q=1",), ("https://site3.net/nothing",), ("http://site3.net/17",)], "url string")
    found = warc.lookup(asked, directory)
    assert sorted((r.url, r.page_id or -1) for r in found.collect()) == [
        ("http://b.example.com/x?q=1", -1), ("http://b.example.com/x?q=1", 7), ("http://site3.net/17", 117)]
    assert {r.page_id for r in warc.read_records(found).collect()} == {None, 7, 117}
    keys = [r.first_key for r in directory.orderBy("segment", "offset").collect()]
    assert len(keys) > 10 and keys == sorted(keys)


def test_archive_searches_its_index(spark, tmp_path, monkeypatch):
    asked, search = [], warc.lookup
    monkeypatch.setattr(warc, "lookup", lambda urls, directory: (asked.extend(r.url for r in urls.collect()), search(urls, directory))[1])
    pages = [(1, "http://a.org/x", "p"), (2, "https://a.org/x#f", "q"), (3, None, "r"), (4, "", None), (5, "http://a.org/x", "p")]
    rows = warc.archive(spark.createDataFrame(pages, "page_id long, url string, html string"), str(tmp_path / "w")).collect()
    assert {u for _, u, _ in pages} == set(asked) and sorted(r.page_id for r in rows) == [1, 2, 3, 4, 5]


# -- 6 mixing ----------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 5, "b": 3, "c": 2}, {chr(97 + i): 1 + i * i for i in range(12)}])
def test_every_prefix_is_within_a_block_of_its_share(spark, weights):
    slots = mixing.shares(weights, 200)
    assert sum(slots.values()) == 200
    done = Counter()
    for k, r in enumerate(sorted(mixing.schedule(spark, slots).collect(), key=lambda r: r.mix_slot)):
        assert r.mix_slot == k and r.mix_release <= k < r.mix_deadline and r.mix_turn == done[r.mix_name]
        done[r.mix_name] += 1
        assert all(abs(done[s] - slots[s] * (k + 1) / 200) < 1 for s in slots)


def test_mixed_rows_keep_every_row_in_slot_order(spark):
    sources = ["big"] * 300 + ["small"] * 40 + [None] * 20 + ["unknown"] * 5
    docs = frame(spark, ["t"] * 365, sources=sources).unionByName(frame(spark, [None], [None]))
    got = mixing.mixed_rows(docs, {"big": 2, "small": 1, "(none)": 1}, block_docs=4, frame=40)
    assert got.columns == docs.columns and Counter(got.collect()) == Counter(docs.collect())
    timed = mixing.mix(docs, {"big": 2, "small": 1, "(none)": 1}, block_docs=4, frame=40)
    assert timed.where("mix_slot is null").count() == 6
    first = timed.where("mix_slot < 20").groupBy("mix_name").count().collect()
    assert {r.mix_name: r["count"] for r in first} == {"big": 40, "small": 20, "(none)": 20}


# -- 7 substrings ------------------------------------------------------------------------------------------------------
def plain_cut(texts, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        out.append((len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("window", [3, 35])
def test_cut_words_equal_all_windows(spark, window):
    rng, texts = random.Random(window), []
    for _ in range(250):
        letters, n = rng.choice(["a", "ab", "abc", "abcdefghijklmnopqrstuvwxyz"]), rng.choice([0, 5, window - 1, window, window + 1, 200])
        words = [rng.choice(letters) for _ in range(n)]
        if texts and rng.random() < 0.6:
            other = (rng.choice(texts) or "").split()
            k = rng.randrange(max(1, len(other)))
            words[len(words) // 2:len(words) // 2] = other[k:k + rng.choice([window - 1, window, window + 15])]
        if rng.random() < 0.2:
            words = (words[:rng.choice([1, 2, 3, 5])] or ["q"]) * rng.choice([5, 12, 40]) + words
        texts.append(" ".join(words) if n else None)
    texts += texts[:4] + AWKWARD
    ids = [i if i % 40 else None for i in range(len(texts))]
    got = substrings.remove_repeats(frame(spark, texts, ids), window=window).collect()
    assert Counter(map(tuple, got)) == Counter((i, *r) for i, r in zip(ids, plain_cut(texts, window), strict=True))


# -- 8 decontamination -------------------------------------------------------------------------------------------------
def plain_hits(text, items):
    def split(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))

    words, hit, found = split(text), set(), []
    for item, body in items:
        v = split(body)
        n = min(10, len(v))
        windows = {tuple(v[k:k + n]) for k in range(len(v) - n + 1)} if v and item is not None else set()
        at = [k for k in range(len(words) - n + 1) if tuple(words[k:k + n]) in windows]
        if at:
            found.append(str(item))
            hit.update(k + j for k in at for j in range(n))
    digest = hashlib.sha256(",".join(sorted(set(found))).encode()).hexdigest()
    return len(words), len(hit), len(set(found)), digest, bool(hit)


def test_hits_equal_all_windows(spark):
    rng = random.Random(8)
    items = [(i, " ".join(rng.choice("abcd") + rng.choice("xyz") for _ in range(rng.choice([1, 3, 7, 9, 10, 11, 30])))) for i in range(25)]
    items += [(None, "never found"), (90, None), (91, " !? "), (10, items[10][1]), (92, "É é")]
    texts = []
    for _ in range(120):
        words = [rng.choice("abcd") + rng.choice("xyz") for _ in range(rng.choice([0, 4, 9, 10, 60]))]
        if rng.random() < 0.5:
            body = (rng.choice(items)[1] or "").split()
            k = rng.randrange(max(1, len(body)))
            words[len(words) // 2:len(words) // 2] = body[k:k + rng.choice([9, 10, 12])]
        texts.append(", ".join(words).upper() if rng.random() < 0.3 else " ".join(words))
    texts += AWKWARD + ["É é", "é É"]
    ids = [i if i % 30 else None for i in range(len(texts))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.decontaminate(frame(spark, texts, ids), benchmark).collect()
    assert Counter(map(tuple, got)) == Counter((i, *plain_hits(t, items)) for i, t in zip(ids, texts, strict=True))
    kept = decontam.keep_uncontaminated(frame(spark, texts, ids), benchmark)
    assert kept.count() == sum(not plain_hits(t, items)[-1] for t in texts)


def test_every_text_of_an_item_id_counts(spark):
    items = [(1, " ".join(f"{c}{k}" for k in range(12))) for c in "pqrst"] + [(1, "short one"), (2, "p0 p1")]
    texts = [f"x {t} y" for _, t in items] + [f"{items[0][1]} {items[3][1]} short one", "none of them"]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.decontaminate(frame(spark, texts), benchmark).collect()
    assert sorted(map(tuple, got)) == [(i, *plain_hits(t, items)) for i, t in enumerate(texts)]
    assert [r.doc_id for r in decontam.keep_uncontaminated(frame(spark, texts), benchmark).collect()] == [len(texts) - 1]


@pytest.mark.parametrize("name", ["op6_mixing", "op8_decontaminate", "op10_simhash"])
def test_native_queries_run_no_python(name, spark, sf_dir):
    plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# -- 10 fingerprints ---------------------------------------------------------------------------------------------------
def test_fingerprints_and_near_ones(spark, sf_dir):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(80).collect()]
    texts += [texts[0], texts[1] + " more", " ".join(texts[2].split()[:-1]), "", None, LONG]
    ids = list(range(0, 10 * len(texts), 10))
    got = {r.doc_id: r for r in simhash.fingerprint_table(frame(spark, texts, ids)).collect()}
    assert len(got) == len(texts)
    for k, (i, t) in enumerate(zip(ids, texts, strict=True)):
        t, following = t or "", texts[k - 1] or ""
        edited = t[:len(t) - len(t) // 3] + following[:len(t) // 3]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert got[i].near_next == 1 - bin(int(got[i].fingerprint, 16) ^ int(got[ids[k - 1]].fingerprint, 16)).count("1") / 128
    assert got[0].fingerprint == got[800].fingerprint
    assert sum(r.near_edited > r.near_next for r in got.values()) >= 0.9 * len(got)
    values = {i: int(r.fingerprint, 16) for i, r in got.items()}
    for i, r in got.items():
        near = sum(bin(values[i] ^ v).count("1") <= simhash.RADIUS for v in values.values()) - 1
        assert r.n_near == (near if i % 50 == 0 else None)


def test_next_documents_of_null_and_repeated_ids(spark):
    """Equal ids follow by a hash of the text, null ids last, equal rows are one document; many partitions give the same links."""
    texts = [f"text {k} " * (k % 5 + 1) for k in range(40)] + [None, "", "text 1 text 1 ", "text 1 text 1 "]
    ids = [3] * 10 + [None] * 10 + [-(1 << 63), (1 << 63) - 1, *range(18), 7, None, 1, 1]
    docs = frame(spark, texts, ids)
    rows = docs.distinct().select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("a")).collect()
    order = sorted({(r.doc_id is None, -(r.doc_id or 0), r.a, r.text) for r in rows})
    folder = common.run_folder(spark, "test")
    for per_part in (5, 1000):
        links = simhash.neighbours(docs, f"{folder}/{per_part}", per_part).collect()
        got = {(r.before.unnumbered, -(~r.before.down if not r.before.unnumbered else 0), r.before.a):
               (r.unnumbered, -(~r.down if not r.unnumbered else 0), r.a) for r in links}
        assert got == {x[:3]: y[:3] for x, y in zip(order, order[1:] + order[:1], strict=True)}
    follows = {(None if x[0] else -x[1], x[3]): y[3] for x, y in zip(order, order[1:] + order[:1], strict=True)}
    want = Counter()
    for i, t in zip(ids, texts, strict=True):
        t = t or ""
        edited = t[:len(t) - len(t) // 3] + follows[i, t][:len(t) // 3]
        want[i, len(t), hashlib.sha256(edited.encode()).hexdigest()] += 1
    table = simhash.fingerprint_table(docs).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in table) == want
    assert all((r.n_near is not None) == (r.doc_id is not None and r.doc_id % 50 == 0) for r in table)


def test_fingerprint_is_the_sign_of_the_votes(spark):
    text = "aa bb cc " * 700 + "dd"  # more terms than a chunk holds
    words = text.split()
    rows = spark.createDataFrame([(a, b) for a, b in zip(words[:-1], words[1:], strict=True)], "a string, b string").select(
        F.xxhash64("a", "b").alias("h"), F.xxhash64(F.xxhash64("a", "b")).alias("g"), (F.length("a") + F.length("b")).alias("w")).collect()
    votes = np.zeros(128, int)
    for r in rows:
        for half, h in ((0, r.h), (1, r.g)):
            votes[64 * half:64 * half + 64] += r.w * (2 * np.array([h >> k & 1 for k in range(64)]) - 1)
    bits = "".join("1" if v > 0 else "0" for v in votes)
    got = simhash.fingerprint_table(frame(spark, [text])).first()
    assert got.fingerprint == f"{int(bits, 2):032x}"


# -- pipeline ----------------------------------------------------------------------------------------------------------
def test_pipeline_stages_against_plain_versions(spark, sf_dir):
    """Each stage on its own input; the toxicity stage against the scores of its own operator."""
    from tokenizers import Tokenizer

    folder, docs = common.run_folder(spark, "test"), common.table(spark, sf_dir, "documents")
    columns, results = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, results[-1], sf_dir).write.parquet(f"{folder}/{name}")
        results.append(spark.read.parquet(f"{folder}/{name}"))
    assert all(r.columns == columns for r in results[:-1])
    before, clean, single, unseen, mixed, last = results
    rows = [Counter(r.collect()) for r in results[:-1]]
    scores = {r.doc_id: r.predicted for r in toxicity.toxicity(before, common.table(spark, sf_dir, "labels")).collect()}
    assert rows[1] == Counter({r: n for r, n in rows[0].items() if not scores[r.doc_id]}) and rows[1] != rows[0]
    groups = plain_groups([(r.doc_id, r.text) for r in rows[1]], 80)
    assert rows[2] == Counter({r: n for r, n in rows[1].items() if groups[r.doc_id][1] == r.doc_id}) and rows[2] != rows[1]
    items = [(r.item_id, r.text) for r in common.table(spark, sf_dir, "benchmark").collect()]
    assert rows[3] == Counter({r: n for r, n in rows[2].items() if not plain_hits(r.text, items)[-1]}) and rows[3] != rows[2]
    assert rows[4] == rows[3]
    slots = {r.doc_id: (r.slot, r.place) for r in mixing.mix_table(unseen).collect()}
    order = [r.doc_id for r in mixed.select("doc_id", "_metadata.file_name", "_metadata.row_index").orderBy("file_name", "row_index").collect()]
    assert order == sorted(order, key=slots.get)
    own, texts, start = Tokenizer.from_file(VOCABULARY), {r.doc_id: r.text for r in rows[4]}, 0
    for r, doc_id in zip(last.orderBy("start").collect(), order, strict=True):
        ids = np.array([*own.encode(texts[doc_id], add_special_tokens=False).ids, 1], "<u4")
        assert tuple(r) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    common.remove_folder(spark, folder)


@pytest.mark.parametrize("k", range(5))
def test_stages_take_awkward_documents(spark, sf_dir, k):
    name, stage = corpus_pipeline.STAGES[k]
    docs = frame(spark, AWKWARD + ["x"], [*range(len(AWKWARD)), None], langs=[None] * 10, sources=[None] * 10)
    out = stage(spark, docs, sf_dir)
    assert out.count() == (9 if name == "near_dedup" else 10)  # the two texts "one" are copies
    if name != "tokens":
        assert out.columns == docs.columns


def test_pack_of_a_batch_without_text():
    assert [len(x) for x in common.words_of(*common.text_bytes(pa.array([None, ""], pa.string())))] == [0, 0, 3]

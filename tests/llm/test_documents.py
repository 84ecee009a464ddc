"""Operators on documents against brute force, and on awkward rows."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
from cases import LONG, PLAIN, ROWS, SF
from riskloom.llm import bpe, exact_dedup, language, ngram_join, ogg, packing, pii, queries, substring_dedup, token_files
from riskloom.llm.common import shingle_sets
from riskloom.llm.components import components
from riskloom.llm.word_tokens import encoder
from riskloom.llm.count_tree import CountTree, Points, point

WORDS = P.path("word_bpe_49k.json")


def rows(df):
    return Counter(tuple(r) for r in df.collect())


# --- exact dedup --------------------------------------------------------------------------------


def plain_dedup(data):
    groups = {}
    for i, t in data:
        key = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        groups.setdefault(key, []).append((i, t or ""))
    out = Counter()
    for key, members in groups.items():
        keep = max(members, key=lambda m: (len(m[1]), m[0] is not None, -(m[0] or 0)))[0]
        for i, _ in members:
            out[i, keep, len(members), i == keep, hashlib.sha256(key.encode()).hexdigest()] += 1
    return out


def test_exact_dedup(spark, awkward, nothing, scratch):
    got = exact_dedup.decisions(awkward, scratch).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert rows(got) == plain_dedup([(i, t) for i, t, *_ in ROWS])
    assert exact_dedup.decisions(nothing, scratch).count() == 0
    kept = exact_dedup.dedup(awkward, scratch)
    assert kept.columns == awkward.columns and kept.count() == len({re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t, *_ in ROWS})
    assert 10 in [r.doc_id for r in kept.collect()]  # the longest original of its group
    assert exact_dedup.dedup(nothing, scratch).count() == 0


def test_hot_copies_and_a_full_filter(spark, scratch, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MOST_SEGMENTS", 1)
    monkeypatch.setattr(exact_dedup, "SEGMENT_BITS", 1 << 16)
    data = [(i, "same text" if i % 3 == 0 else f"text {i}") for i in range(3000)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(7)
    assert rows(exact_dedup.decisions(df, scratch).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")) == plain_dedup(data)


def test_bloom_never_misses_a_repeat(spark, scratch):
    h = spark.range(0, 20000).select(F.xxhash64(F.col("id") % 15000).alias("h")).repartition(9)
    plane, segments = exact_dedup.again_plane(h, 20000)
    flagged = exact_dedup.flagged(h, "h", scratch.keep(plane), segments)
    n = flagged.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min(F.col("__maybe").cast("int")).alias("maybe"))
    assert n.filter("n > 1 AND maybe = 0").count() == 0
    assert n.filter("n = 1 AND maybe = 1").count() < 500


# --- n-gram join --------------------------------------------------------------------------------


def test_ngram_join_on_awkward_rows(awkward, nothing, scratch):
    got = ngram_join.link(awkward, scratch).select("doc_id", "n_shingles", "component_id")
    assert rows(got) == Counter(brute.components([(i, t) for i, t, *_ in ROWS]))
    assert ngram_join.link(nothing, scratch).count() == 0
    kept = ngram_join.leaders(awkward, scratch)
    ids = Counter(r.doc_id for r in kept.collect())
    assert kept.columns == awkward.columns and ids[7] == 1 and 8 not in ids and 9 not in ids and ids[11] == 1 and 12 not in ids and ids[None] == 2


def test_ngram_join_against_all_pairs(spark, scratch):
    """Edited copies of a few texts in all strengths, a large group of near copies and a common passage."""
    r = np.random.default_rng(3)
    base = [[f"w{r.integers(4000)}" for _ in range(n)] for n in (5, 8, 20, 60, 150)]
    data = []
    for i in range(260):
        w = list(base[i % 5]) if i < 180 else [f"v{r.integers(9000)}" for _ in range(60)] + base[2]
        for _ in range(int(r.integers(0, 1 + len(w) // 12))):
            w[int(r.integers(len(w)))] = f"e{r.integers(50)}"
        data.append((i, " ".join(w)))
    data += [(1000 + i, " ".join(base[4][: 140 + i % 10]) + f" tail{i}") for i in range(120)]
    got = ngram_join.link(spark.createDataFrame(data, "doc_id long, text string").repartition(5), scratch)
    assert rows(got.select("doc_id", "n_shingles", "component_id")) == Counter(brute.components(data))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 400), max_size=120), min_size=2, max_size=60), st.integers(1, 3))
def test_count_tree_keeps_every_link(sets, kinds):
    import pyarrow as pa

    text = pa.array([" ".join(f"t{x}" for x in sorted(s)) for s in sets])
    hashed = list(shingle_sets(text, k=1))
    at = Points([point(h) for h in hashed])
    kind = np.arange(len(sets)) % (kinds + 1)
    tree = CountTree(at.rows(np.arange(len(sets)), int(at.bits.min())), kind)
    found = {frozenset(p) for a, b in tree.pairs() for p in zip(a.tolist(), b.tolist(), strict=True)}
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 7 * len(sets[i] & sets[j]) >= 3 * (len(sets[i]) + len(sets[j])):
                assert at.may_link(np.array([i]), np.array([j]))[0]
                assert kind[i] == kind[j] or frozenset((i, j)) in found


def test_components_of_a_long_chain(spark, scratch):
    links = [(i, i + 1) for i in range(0, 300)] + [(1000, 1001), (1001, 1000), (5, 5)] + [(2000, x) for x in range(2001, 2400)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), scratch).collect()}
    assert all(got[i] == 0 for i in range(301)) and got[1001] == 1000 and {got[x] for x in range(2000, 2400)} == {2000}


def test_shingles_equal_brute_force():
    import pyarrow as pa

    texts = [t for _, t, *_ in ROWS]
    for k in (1, 2, 5):
        got = [len(s) for s in shingle_sets(pa.array(texts, pa.string()), k, most_bytes=1000)]
        w = [brute.WORD.findall((t or "").translate(brute.LOWER)) for t in texts]
        assert got == [len({tuple(x[i : i + k]) for i in range(len(x) - k + 1)}) if len(x) >= k else min(1, len(x)) for x in w]


# --- substring dedup ----------------------------------------------------------------------------


def test_passages(spark, awkward, nothing, scratch):
    passage = "Copper lanterns swung above the quiet harbour as the last ferry turned toward home. Nobody on the pier spoke while the long rope slid across the wet planks. A boy counted the lights on the far shore and lost his place twice before the bell rang. Then the gulls rose together and the whole bay went silent under the rain."
    other = lambda k: " ".join(f"filler{k} item{k}x{i} thing{i}y{k} word{i}z{k}{'.' if i % 3 == 0 else ''}" for i in range(20))
    data = [(1, other(1) + " " + passage + " " + other(2)), (2, other(3) + "\n" + passage), (3, passage.replace("quiet", "noisy") + " " + other(4)), (4, other(5)), (5, None), (6, "")]
    got = substring_dedup.passages(spark.createDataFrame(data, "doc_id long, text string"), scratch).toPandas()
    assert set(got.doc_id) == {1, 2, 3}
    text = dict(data)
    for r in got.itertuples():
        assert "the wet planks" in text[r.doc_id][r.start : r.end] and r.n_words >= 28 and r.first_doc == 1
    assert got.set_index("doc_id").removed_words.to_dict()[1] == 0 and (got[got.doc_id != 1].removed_words > 0).all()
    found = substring_dedup.passages(awkward, scratch)
    assert {None, 7, 8, 9, 10, 11, 12} == {r.doc_id for r in found.collect()}
    assert substring_dedup.passages(nothing, scratch).count() == 0


def test_cleaned_text_has_no_removed_passage(spark, scratch):
    body = "Seven grey barges waited below the lock for the morning tide to lift them over the sill. The keeper read the gauge twice and wrote the figure in a book that his father had begun. Nobody asked him why."
    df = spark.createDataFrame([(1, body), (2, "First line here.\n" + body + "\nLast line there."), (3, None)], "doc_id long, text string")
    out = {r.doc_id: r.text for r in substring_dedup.cleaned(df, substring_dedup.passages(df, scratch)).collect()}
    assert out[1] == body and "keeper" not in out[2] and out[2].startswith("First line") and out[3] is None


def test_pieces_do_not_depend_on_the_texts_before():
    import pyarrow as pa

    for _, t, *_ in ROWS:
        alone = [p.nodes().tolist() for _, p in substring_dedup.pieces_of(pa.array([t], pa.string()))]
        after = [p.nodes()[p.doc == 1].tolist() for _, p in substring_dedup.pieces_of(pa.array(["Some other words. And more", t], pa.string()))]
        assert alone == after


def test_tuned_bands_reach_the_recall():
    for t, recall, most in ((0.75, 0.996, 14), (0.8, 0.99, 64), (0.5, 0.95, 32)):
        b, r = substring_dedup.tune(t, recall, most)
        assert 1 - (1 - t**r) ** b >= recall and b * r <= most


# --- tokens -------------------------------------------------------------------------------------


def test_byte_bpe(awkward, nothing):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    import base64

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for i, t, *_ in ROWS:
        ids = np.array(library.encode_ordinary(t or ""), "<u4").tobytes()
        want[i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert rows(bpe.digest(awkward, path, P.PATTERN)) == want
    assert bpe.digest(nothing, path, P.PATTERN).count() == 0
    coder = bpe.Bpe(path, P.PATTERN)
    odd = ["  a  b\n\n c \t d ", "\x1c x\x1c\x1d y", "a\x85b \x85 c", "don't I'LL we're 's", "漢字かな " * 30, "x" * 300, "ab" * 200 + " 🙂👍🏽 é", "​ ½²Ⅷ 一二"]
    got = coder.encode(odd)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [library.encode_ordinary(t) for t in odd]
    assert coder.decode(got) == [t.encode() for t in odd]


def test_token_files(spark, awkward, nothing, scratch):
    got = token_files.keyed_digest(awkward, WORDS, spark, scratch).toPandas().sort_values("start").reset_index(drop=True)
    order = sorted(((i, t) for i, t, *_ in ROWS), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    ids = [brute.word_ids(t) for _, t in order]
    assert got.n_tokens.tolist() == [len(x) for x in ids] and got.ids_crc32.tolist() == [brute.crc(x) for x in ids]
    assert got.start.tolist() == np.cumsum([0, *map(len, ids)])[:-1].tolist()
    assert [None if pd.isna(x) else int(x) for x in got.doc_id] == [i for i, _ in order]
    assert token_files.keyed_digest(nothing, WORDS, spark, scratch).count() == 0


def test_lookup_leaves_out_unknown_keys(spark, scratch):
    entries = spark.range(0, 1000).selectExpr("id * 7 AS doc_id", "0L AS copy", "1 AS shard", "'f' AS file", "id * 10 AS offset", "id AS length")
    index = scratch.keep(token_files.build_index(entries, 3))
    keys = spark.range(0, 7000).selectExpr("id AS doc_id", "0L AS copy")
    got = token_files.locate(keys, index, 3).toPandas()
    assert len(got) == 1000 and (got.doc_id % 7 == 0).all() and (got.offset == got.doc_id // 7 * 10).all()


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 20000).astype(np.uint64))
    levels = token_files.build_levels(keys)
    assert sorted(token_files.slots(keys, levels).tolist()) == list(range(len(keys)))
    with pytest.raises(ValueError):
        token_files.build_levels(np.array([5, 5], np.uint64))


def test_packing(spark, awkward, nothing, scratch):
    got = packing.packed(awkward, WORDS, scratch).toPandas()
    want = Counter()
    for i, t, *_ in ROWS:
        x = brute.word_ids(t)
        for k, a in enumerate(range(0, len(x), 4096)):
            want[i, k, a, len(x[a : a + 4096]), brute.crc(x[a : a + 4096])] += 1
    assert Counter((None if pd.isna(r.doc_id) else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got.itertuples()) == want
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s.offset.tolist() == np.cumsum([0, *s.length])[:-1].tolist() and s.length.sum() <= 4096
    assert got.sequence_id.nunique() == -(-got.length.sum() // 4096)
    assert packing.packed(nothing, WORDS, scratch).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=80), st.integers(1, 8), st.integers(10_000, 20_000), st.sampled_from(["norm", "dot"]))
def test_best_fit_holds_every_capacity(sizes, documents, attention, rule):
    length = np.array(sorted(sizes, reverse=True))
    bins, offsets = packing.best_fit(length, (100, documents, attention), rule=rule)
    for b in set(bins.tolist()):
        at = np.flatnonzero(bins == b)
        assert length[at].sum() <= 100 and len(at) <= documents and (length[at] ** 2).sum() <= attention
        assert offsets[at].tolist() == np.cumsum([0, *length[at]])[:-1].tolist()
    assert len(set(bins.tolist())) <= len(sizes)


def test_packed_sequences_hold_the_ids(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    cut = scratch.keep(packing.pieces(docs, WORDS, 512, with_ids=True))
    placed = scratch.keep(packing.pack(cut, 512))
    made = {r.sequence_id: bytes(r.ids) for r in packing.sequences(cut, placed).collect()}
    for r in placed.collect():
        assert zlib.crc32(made[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)]) == r.ids_crc32


SPECIAL = st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "a", "É", " ", "\n", ".", "don't", "x!?", "9", "wörd;", "e\u0301"]), max_size=14).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(SPECIAL, max_size=4))
def test_ids_are_those_of_the_plain_call(texts):
    got = encoder(WORDS).encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() + [1] for x in got] == [brute.word_ids(t) for t in texts]


def test_files_and_sequences_with_special_tokens(spark, scratch):
    data = [(1, "a <|endoftext|> b"), (2, "plain words. here"), (3, "<|startoftext|>x<|endoftext|><|endoftext|>"), (4, None)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = sorted(tuple(r)[:4] for r in token_files.keyed_digest(df, WORDS, spark, scratch).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    at, want = 0, []
    for i, t in data:
        ids = brute.word_ids(t)
        want.append((i, at, len(ids), brute.crc(ids)))
        at += len(ids)
    assert got == want
    pieces = {r.doc_id: (r.length, r.ids_crc32) for r in packing.packed(df, WORDS, scratch).collect()}
    assert pieces == {i: (n, c) for i, _, n, c in want}


# --- language -----------------------------------------------------------------------------------


def test_language(spark, awkward, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.train(docs)
    got = language.predict(docs, model).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    assert got.held_out.tolist() == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97 and got.score.between(0, 1).all()
    odd = language.predict(awkward, model).toPandas()
    und = {1, 2, 3, 15}
    assert set(odd[odd.doc_id.isin(und)].lang_pred) == {"und"} and len(odd) == len(ROWS)
    assert odd[odd.doc_id == 7].lang_pred.tolist() == ["en"]
    assert language.predict(nothing, model).count() == 0
    assert language.predict(awkward, language.train(nothing)).filter("lang_pred <> 'und'").count() == 0
    kept = language.accepted(awkward, model)
    assert kept.columns == awkward.columns and not und & {r.doc_id for r in kept.collect()} and 7 in {r.doc_id for r in kept.collect()}


def test_model_does_not_depend_on_partitions(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    monkeypatch.setattr(language, "MOST", 900)
    models = [language.train(docs.repartition(n)) for n in (1, 7, 40)]
    assert all(m.rows == models[0].rows for m in models) and all(np.array_equal(m.logs[n], models[0].logs[n]) for m in models for n in m.logs)
    grams = {(n, g) for n, known in models[0].rows.items() for g in known}
    assert len(grams) <= 900 and all(np.isfinite(m).all() for m in models[0].logs.values())


def test_language_falls_back_to_shorter_grams():
    model = language.Model(["x", "y"], [(0, "zug", "x", 5), (0, "bon", "y", 5), (3, "abc", "x", 4), (3, "abc", "y", 1), (3, "xyz", "y", 9), (1, "q", "y", 9), (1, "a", "x", 2)])
    assert model.word("zug")[0] > model.word("zug")[1]
    assert model.word("zabcz")[0] > model.word("zabcz")[1]  # order 3
    assert model.word("qq")[1] > model.word("qq")[0]  # order 1
    assert model.word("0").tolist() == [0, 0]


# --- personal data ------------------------------------------------------------------------------

PIECES = st.sampled_from(["a.b@c.de", "@", "x@y", "1.2.3.4", "999.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (743) 555-3824", "+", "0", "12", ".", "-", " ", "é", "\n", "user@mail.example.org.", "DE89 3704 0044 0532 0130 00"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=25).map("".join))
def test_base_spans_equal_plain_expressions(text):
    base, spans = pii.find(text)
    assert base == brute.pii(text) and set(base) <= set(spans)


def test_pii_table(awkward, nothing, spark):
    data = [(1, "mail a@b.co or call +49 30 1234 5678 9, IBAN DE89 3704 0044 0532 0130 00."), (2, None), (3, "ssn 123-45-6789, order 123-45-6780 x"), (4, "0" * 50_000 + "@" * 1000)]
    got = {r.doc_id: r for r in pii.report(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert (got[1].n_email, got[1].n_phone, got[1].n_ip) == (1, 1, 0) and "iban:" in got[1].spans and "ssn:4:15" in got[3].spans and got[2].spans == ""
    assert got[2].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.report(awkward).count() == len(ROWS) and pii.report(nothing).count() == 0
    masked = pii.mask(awkward.withColumn("text", F.concat("text", F.lit(" a@b.co"))))
    assert masked.columns == awkward.columns and masked.filter("text LIKE '%@b.co%'").count() == 0
    assert pii.masked("x a@b.co y") == "x [EMAIL] y"


# --- Ogg ----------------------------------------------------------------------------------------


def slow_crc(data):
    c = 0
    for byte in data:
        c ^= byte << 24
        for _ in range(8):
            c = ((c << 1) ^ 0x04C11DB7) & 0xFFFFFFFF if c & 0x80000000 else c << 1
    return c


def test_ogg_checksum():
    for data in (b"", b"OggS", bytes(range(256)), b"\0" * 30):
        assert ogg.checksum(data) == slow_crc(data)


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 400_000), st.integers(0, 255))
def test_ogg_round_trip(n, fill):
    payload = bytes((fill + i * i) % 256 for i in range(576 * (1 + n // 576)))
    media = ogg.mux(payload, n)
    back, n_bytes, feature = ogg.load(media)
    assert back == payload and n_bytes == n and f"seconds={len(payload) / 8000:.6f}" in feature
    pages = list(ogg.read_pages(media))
    assert [p.flags & ogg.FIRST for p in pages[:2]] == [2, 2] and sum(bool(p.flags & ogg.LAST) for p in pages) == 2
    times = ogg.timeline(ogg.demux(media)[ogg.AUDIO][1:], ogg.RATE)
    assert all(abs(a[1] - b[0]) < 1e-9 for a, b in zip(times, times[1:], strict=False)) and times[0][0] == 0


def test_ogg_damage_costs_only_damaged_pages():
    payload = bytes(i % 251 for i in range(576 * 500))
    media = bytearray(ogg.mux(payload, 9))
    media[len(media) // 2] ^= 1
    whole = sum(1 for _ in ogg.read_pages(ogg.mux(payload, 9)))
    assert sum(1 for _ in ogg.read_pages(bytes(media))) == whole - 1
    with pytest.raises(ValueError):
        ogg.load(bytes(media))


def test_ogg_table(awkward, nothing):
    got = ogg.features(ogg.column(awkward)).toPandas()
    assert len(got) == len(ROWS) and ogg.features(ogg.column(nothing)).count() == 0
    want = Counter()
    for i, t, *_ in ROWS:
        raw = (t or "").encode()
        padded = raw.ljust(max(1, -(-len(raw) // 576)) * 576, b"\xff")
        want[i, len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-32:])] += 1
    assert Counter((None if pd.isna(r.doc_id) else int(r.doc_id), r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got.itertuples()) == want
    same = got[got.payload_sha256.duplicated(keep=False)].groupby("payload_sha256")[["media_sha256", "feature"]].nunique()
    assert (same == 1).all().all()
    assert ogg.features(ogg.column(awkward).withColumn("media", F.lit(None).cast("binary"))).filter("feature IS NOT NULL").count() == 0


# --- queries on the smallest tables -------------------------------------------------------------


@pytest.fixture(scope="module")
def small(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def test_queries_without_sql(spark, small):
    q = queries.QUERIES
    assert rows(q["op3_ngram_jaccard_join"](spark, SF).select("doc_id", "n_shingles", "component_id")) == Counter(brute.components(small))
    got = {r.doc_id: r for r in q["op10_pii"](spark, SF).collect()}
    for i, t in small:
        spans = brute.pii(t)
        assert got[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in spans).encode()).hexdigest() and got[i].n_card == sum(k == "card" for *_, k in spans)
    ids = {i: brute.word_ids(t) for i, t in small}
    at = 0
    for r in sorted(q["op5_token_files"](spark, SF).collect(), key=lambda r: r.doc_id):
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids[r.doc_id]), brute.crc(ids[r.doc_id]))
        at += r.n_tokens
    found = {r.doc_id for r in q["op2_substring_dedup"](spark, SF).collect()}
    text = dict(small)
    seen = {}
    for i, t in text.items():
        w = t.lower().split()
        for k in range(len(w) - 60):
            if len(set(w[k : k + 61])) > 30:  # not junk of a few words
                seen.setdefault(tuple(w[k : k + 61]), set()).add(i)
    want = set().union(*[v for v in seen.values() if len(v) > 1])
    assert len(want - found) <= 0.03 * len(want)
    assert LONG and PLAIN

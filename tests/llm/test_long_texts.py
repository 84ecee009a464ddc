"""Byte-level BPE of long texts and slices."""

import numpy as np
import public_tokenizers as P

from riskloom.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


def test_decoding_is_bounded():
    coder = bpe.Bpe(PATH, P.PATTERN)
    names = {r: t for t, r in coder.ranks.items()}
    ids = np.random.default_rng(1).choice(np.array(list(names), "<u4"), 6_000_000)
    lists = [b"", ids[:5_500_000].tobytes(), b"", ids[5_500_000:5_500_003].tobytes(), ids[5_500_003:].tobytes()]
    got = coder.decode(lists)
    assert got == [b"".join(map(names.__getitem__, np.frombuffer(x, "<u4").tolist())) for x in lists]
    assert coder.decode([]) == [] and coder.decode([b"", b""]) == [b"", b""]


def test_round_trip_takes_groups_of_bounded_size(spark):
    from riskloom.session import ship

    ship(spark)
    long = "some words of a long text, " * 60_000
    docs = spark.createDataFrame([(i, long if i % 2 else None) for i in range(6)], "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r for r in bpe.round_trip(docs, PATH, P.PATTERN).selectExpr("doc_id", "octet_length(ids) n", "CAST(decoded AS STRING) = repeat('some words of a long text, ', 60000) same", "octet_length(decoded) size").collect()}
    assert len(got) == 6 and all(got[i].same and got[i].n for i in (1, 3, 5)) and all(got[i].size == 0 for i in (0, 2, 4))


def test_many_long_words_in_one_text():
    import random

    import tiktoken

    coder = bpe.Bpe(PATH, P.PATTERN)
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("etaoinsh") for _ in range(255)) for _ in range(1028))
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == library.encode_ordinary(text)

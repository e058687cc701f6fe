import hashlib
import random

import public_tokenizers as P
import tiktoken

from driftline.llm import bpe
from tests.llm.helpers import EDGE, docs_frame

PATH = P.path("byte_bpe_multi_50k.tiktoken")


def oracle():
    c = bpe.codec(PATH, P.PATTERN)
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=c.ranks, special_tokens={})


def test_random_texts_equal_the_library_and_round_trip():
    c, enc, rnd = bpe.codec(PATH, P.PATTERN), oracle(), random.Random(3)
    kinds = ["abcdefgh", "aaab", "the ing ", "\x1c\x1d\x85\xa0  \n\t\x0b", "éèñüß漢字かな한글", "😀👍🏽🇩🇪",
             "0123456789", "!!!===---", "\x00\x01\x7f", "АБВгд"]
    for _ in range(3000):
        s = "".join(rnd.choice(rnd.choice(kinds)) for _ in range(rnd.randint(0, 40)))
        ids = c.encode(s)
        assert ids == enc.encode_ordinary(s)
        assert c.decode(ids) == s.encode()


def test_long_repetitive_pieces():
    c, enc = bpe.codec(PATH, P.PATTERN), oracle()
    for s in ("a" * 20_000, "ab" * 10_000, " " * 9_000, "=-" * 9_000, "é" * 9_000):
        assert c.encode(s) == enc.encode_ordinary(s)


def test_small_vocabulary_against_plain_merging():
    rnd = random.Random(5)
    for trial in range(60):
        ranks = {bytes([b]): b for b in range(256)}
        alphabet = b"abc"
        while len(ranks) < 256 + 25:
            known = [t for t in ranks if set(t) <= set(alphabet)]
            new = rnd.choice(known) + rnd.choice(known)
            # half of the vocabularies hold only tokens that merging makes of their bytes
            if trial % 2 or new not in ranks and len(bpe.Codec(ranks, P.PATTERN)._merge(new, 999)) == 2:
                ranks.setdefault(new, len(ranks))
        c = bpe.Codec(ranks, P.PATTERN)
        assert trial % 2 or c.proper
        for _ in range(200):
            piece = bytes(rnd.choice(alphabet) for _ in range(rnd.randint(1, 14)))
            want = [ranks[p] for p in c._merge(piece, len(ranks))] if piece not in ranks else [ranks[piece]]
            assert c.encode_piece(piece) == want, (trial, piece)


def test_operator_on_edge_rows(spark):
    docs = docs_frame(spark, EDGE)
    out = bpe.encode(docs, PATH, P.PATTERN, ["doc_id", "n_words"], decoded="decoded")
    enc = oracle()
    got = sorted(out.collect(), key=str)
    assert len(got) == len(EDGE)
    for r in got:
        text = bytes(r.decoded).decode()
        assert list(r.token_ids) == enc.encode_ordinary(text)
    want = sorted((t or "") for _, t in EDGE)
    assert sorted(bytes(r.decoded).decode() for r in got) == want
    back = bpe.decode(out.select("doc_id", "token_ids"), PATH, P.PATTERN, ["doc_id"]).collect()
    assert sorted(bytes(r.decoded).decode() for r in back) == want
    digests = out.select("token_ids", bpe.ids_digest(out.token_ids).alias("d")).collect()
    assert all(r.d == hashlib.sha256(",".join(map(str, r.token_ids)).encode()).hexdigest() for r in digests)
    assert bpe.encode(docs.limit(0), PATH, P.PATTERN, ["doc_id"]).count() == 0

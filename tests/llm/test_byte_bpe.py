import hashlib

import public_tokenizers as P
from edge import EDGE, LONG, documents, empty
from hypothesis import given, settings
from hypothesis import strategies as st

from alloy.llm import byte_bpe

PATH = P.path("byte_bpe_50k.tiktoken")
TEXT = st.text(st.sampled_from(list("ab'sSt1 \n\t\r\x1c\x85\u00a0\u2028éß!#\U0001F600中")), max_size=80)


@settings(max_examples=400, deadline=None)
@given(TEXT, st.integers(1, 12))
def test_pieces_give_the_whole_text_s_ids(text, size):
    enc = byte_bpe.encoding(PATH, P.PATTERN)
    assert "".join(byte_bpe.pieces(text, size)) == text
    whole = enc.encode_ordinary(text)
    assert byte_bpe.encode(enc, text, size) == whole
    assert byte_bpe.decode(enc, whole) == text.encode()


def test_digests_and_round_trip(spark):
    enc = byte_bpe.encoding(PATH, P.PATTERN)
    got = byte_bpe.token_digests(documents(spark), PATH, P.PATTERN).collect()
    want = []
    for i, t, *_ in EDGE:
        ids = enc.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    back = byte_bpe.detokenize(byte_bpe.tokenize(documents(spark), PATH, P.PATTERN), PATH, P.PATTERN).collect()
    assert sorted((r.doc_id, bytes(r.data)) for r in back if r.doc_id) == sorted(
        (i, (t or "").encode()) for i, t, *_ in EDGE if i)
    assert len(LONG) > byte_bpe.PIECE


def test_long_runs_without_a_boundary_and_empty_tables(spark):
    enc = byte_bpe.encoding(PATH, P.PATTERN)
    for run in ("a" * 200_000, " " * 200_000, "\n" * 200_000, "x1!" * 60_000):
        assert byte_bpe.decode(enc, byte_bpe.encode(enc, run)) == run.encode()
    assert byte_bpe.token_digests(empty(spark), PATH, P.PATTERN).count() == 0
    split = byte_bpe.encoding(PATH, P.PATTERN).encode_ordinary("é")[:1]  # half of a character
    made = spark.createDataFrame([(1, split), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.data for r in byte_bpe.detokenize(made, PATH, P.PATTERN).collect()}[2] is None

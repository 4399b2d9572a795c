import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from glossa.llm import token_files as T
from glossa.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 2]


def test_ids_by_word_equal_ids_of_the_text(plain):
    texts = ["", " \t\x0b\x0c\r\n", "It's DON'T we'll 's 'S x's,", "a,b;c... !!! $$$ le%%% #,", "<|endoftext|> a<|startoftext|>b <|endoftext |>", "é ́x é",
             "ΑΣ ΑΣΑ\x1cb İstanbul ﬁ ẛ̣ ｶﾞ", "12 3a4 x_y a.b.c", " x y　z\u0085w", "word" * 5000, "🙂🙂 ok"]
    ids, bounds = T.encode_texts(pa.array(texts, pa.large_string()), tokenizer_path(), 2)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [plain(t) for t in texts]


def test_file_round_trip_reads_only_what_is_asked():
    docs = [(d, np.arange(n, dtype=np.uint32) + (d or 0)) for d, n in ((None, 3), (1, 0), (4, 5), (9, 200_000), (10, 1), (11, 65_536), (12, 70_000), (13, 2))]
    out = io.BytesIO()
    w = T.FileWriter(out)
    for d, ids in docs:
        w.add(d, ids)
    w.close()
    r = T.FileReader(io.BytesIO(out.getvalue()))
    assert [(d, np.frombuffer(b, "<u4").tolist()) for d, b in r.documents()] == [(d, i.tolist()) for d, i in docs]
    r = T.FileReader(io.BytesIO(out.getvalue()))
    got = r.read([4, 13])
    assert got[4].tolist() == docs[2][1].tolist() and got[13].tolist() == docs[-1][1].tolist()
    assert r.frames_read == 3 < len(r.entries)  # the directory and two frames
    # every frame is a zstandard frame of its own, and damage is noticed
    bad = bytearray(out.getvalue())
    bad[int(r.at[1]) + 40] ^= 1
    with pytest.raises(Exception):
        list(T.FileReader(io.BytesIO(bytes(bad))).documents())
    with pytest.raises(ValueError):
        T.FileReader(io.BytesIO(b"x" * 100))


def test_odd_rows(spark, odd, empty, plain):
    got = [tuple(r) for r in T.token_digests(odd, tokenizer_path()).collect()]
    rows = sorted(((r.doc_id, r.text) for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    want = sorted(((d, len(plain(t)), zlib.crc32(np.array(plain(t), "<u4").tobytes())) for d, t in rows), key=str)
    assert sorted(((d, n, c) for d, _, n, c in got), key=str) == want
    at = 0
    for d, start, n, _ in sorted(got, key=lambda r: r[1]):
        assert start == at
        at += n
    order = [d for d, *_ in sorted(got, key=lambda r: r[1])]
    assert order == [d for d, _ in rows]
    assert T.token_digests(empty, tokenizer_path()).count() == 0


def test_tokens_of_the_vocabulary_itself_in_any_case():
    from tokenizers import Tokenizer

    path = tokenizer_path()
    whole = Tokenizer.from_file(path)
    rng = random.Random(8)
    parts = ["<|ENDOFTEXT|>", "<|endoftext|>", "<|EndOfText|>", "x<|STARTOFTEXT|>y", "<|startoftext|>.", "Hello", "WORLD", "<|", "|>", "É", "a.b", "<|endoftext|", "日本"]
    texts = ["".join(rng.choice(parts) + rng.choice((" ", "", "\n")) for _ in range(rng.randint(0, 9))) for _ in range(800)]
    for some in (texts, ["<|ENDOFTEXT|>"], [t.replace("<|", "") for t in texts]):
        ids, bounds = T.encode_texts(pa.array(some, pa.large_string()), path, 2)
        for text, a, b in zip(some, bounds, bounds[1:]):
            assert ids[a:b].tolist() == whole.encode(text, add_special_tokens=False).ids + [2], text


def test_a_vocabulary_that_reads_white_space_is_refused(tmp_dir):
    from tokenizers import Tokenizer, models, pre_tokenizers

    other = Tokenizer(models.BPE(vocab={c: i for i, c in enumerate(sorted(pre_tokenizers.ByteLevel.alphabet()))}, merges=[]))
    other.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    other.save(f"{tmp_dir}/bytes.json")
    with pytest.raises(ValueError, match="white|words"):
        T.encode_texts(pa.array(["a b"], pa.large_string()), f"{tmp_dir}/bytes.json", 2)

import hashlib
import random

import pytest

from amplicore.llm import sentencepiece_bpe as S

public = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def both():
    import sentencepiece

    path = S.default_model()
    return S.Encoder(S.merge_tables(S.read_model(path))), sentencepiece.SentencePieceProcessor(model_file=path)


def same(both, text):
    own, lib = both
    parts, n, said = own.document(text)
    want = lib.encode(text, add_eos=True)
    return list(map(int, " ".join(parts).split())) == want and n == len(want) and said == lib.decode(want) and own.decode(want) == lib.decode(want)


def test_fixed_texts(both):
    for t in ["", " ", "  a  b ", "\n\tx\r y", "▁ a", "<s> </s>", "ﬁ ½ Ａ", "日本😀", " " * 50, "a" * 100, "don't it's", "x\n\n\ny", "###$$$%%%"]:
        assert same(both, t), repr(t)


def test_random_texts(both):
    rng = random.Random(5)
    pieces = list(both[0].score)
    for _ in range(4000):
        t = "".join(rng.choice("aeinorst hd.,\n%#AB▁é日😀0'") for _ in range(rng.randint(1, 14))) if rng.random() < 0.4 else "".join(rng.choices(pieces, k=rng.randint(1, 4)))
        assert same(both, t), repr(t)


def test_backtracking_equals_merging(both):
    own = both[0]
    rng = random.Random(6)
    for _ in range(2000):
        s = "▁" + "".join(rng.choice("aeihnorstdl") for _ in range(rng.randint(1, 12)))
        assert own.known(s) == S.merged(list(s), own.score)


def test_rows(spark, docs, awkward, both):
    df = docs(awkward)
    got = {r["doc_id"]: r for r in S.encode_decode(df, S.default_model()).collect()}
    assert len(got) == len(awkward)
    for i, t in enumerate(awkward):
        want = both[1].encode(t or "", add_eos=True)
        assert got[i]["ids"] == want and got[i]["n_tokens"] == len(want) and got[i]["decoded"] == both[1].decode(want)
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
    assert S.encode_decode(df.where("false"), S.default_model()).count() == 0

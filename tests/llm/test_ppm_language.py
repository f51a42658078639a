import math

import numpy as np

from amplicore.llm import ppm_language as P


def grams(text):
    x = P.PAD + text.encode()
    out = {}
    for i in range(3, len(x)):
        g = x[i - 3] << 24 | x[i - 2] << 16 | x[i - 1] << 8 | x[i]
        out[g] = out.get(g, 0) + 1
    return np.array(list(out), np.int64), np.array(list(out.values()), np.int64)


TRAIN = {"aa": "the cat sat on the mat and the hat the the cat", "bb": "der hund und die katze und der mann der der hund"}


def test_against_the_definition():
    g, n = grams(TRAIN["aa"])
    m = P.build({"aa": (np.r_[g, g], np.r_[n, n])})

    def slow(text):  # the same with doubled counts
        t, x, total = P.PAD + TRAIN["aa"].encode(), P.PAD + text.encode(), 0.0
        for i in range(3, len(x)):
            gone, bits = set(), 0.0
            for k in (3, 2, 1, 0):
                seen = {}
                for j in range(3, len(t)):
                    if t[j - k : j] == x[i - k : i]:
                        seen[t[j]] = seen.get(t[j], 0) + 2
                own = {b: c for b, c in seen.items() if b not in gone}
                if own:
                    c, d = sum(own.values()), len(own)
                    if x[i] in own:
                        bits -= math.log2(own[x[i]] / (c + d))
                        break
                    bits -= math.log2(d / (c + d))
                gone |= set(seen)
            else:
                bits += math.log2(256 - len(gone))
            total += bits
        return total

    texts = ["the cat", "hat sat", "xyz", "a", "on the\nmat"]
    assert np.allclose(m.bits(texts)[0][:, 0], [slow(t) for t in texts], rtol=1e-5)


def test_code_lengths_are_probabilities():
    m = P.build({k: grams(v) for k, v in TRAIN.items()})
    for tree in m.trees:
        for context in (b"the", b" ca", b"xhe", b"xye", b"xyz", b"\n\n\n", b"der", bytes(3)):
            c = int.from_bytes(context, "big") << 8
            assert abs(np.exp2(-tree.cost(np.arange(256) + c)).sum() - 1) < 1e-9, context


def test_parts_and_size(monkeypatch):
    rng = np.random.default_rng(1)
    many = {f"l{k:02}": grams("".join(chr(0x400 + 60 * k + int(i)) for i in rng.integers(0, 60, 3000))) for k in range(40)}
    m = P.build(many)
    assert sum(len(t.contexts[P.ORDER]) for t in m.trees) == sum(len({int(g) >> 8 for g in v[0]}) for v in many.values())  # no context is left out
    assert m.size() < 60 * sum(len(v[0]) for v in many.values()) * (P.ORDER + 1)
    texts = ["the cat " * k for k in range(30)]
    whole = m.bits(texts)
    monkeypatch.setattr(P, "PART", 50)
    assert np.allclose(whole[0], m.bits(texts)[0]) and (whole[1] == [len(t) for t in texts]).all()


def test_rows(spark, awkward):
    texts = [TRAIN["aa"], TRAIN["bb"]] * 10 + awkward
    rows = [(i, t, "aa" if i < 20 and i % 2 == 0 else "bb" if i < 20 else None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = P.train(df)
    got = {r["doc_id"]: r for r in P.identify(df, model).collect()}
    assert len(got) == len(texts) and all(got[i]["lang_pred"] == ("aa", "bb")[i % 2] for i in range(20))
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert [got[20 + k]["lang_pred"] for k in range(4)] == ["und"] * 4
    assert got[26]["score"] == got[27]["score"]
    assert P.train(df.where("false")) is None
    assert {r["lang_pred"] for r in P.identify(df, None).collect()} == {"und"}

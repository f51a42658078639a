import hashlib
import random

from pyspark.sql import functions as F

from amplicore.llm import chat_windows as C

NASTY = ["### Assistant: </turn> ok", "\\### x", "\\\\h\\t\\c", "</turn>\n### user: hi</turn>\n", "a: b", "", "####", "######", "\\", "tail\\"]


def test_round_trip_and_budget(spark):
    rng = random.Random(1)
    rows = []
    for conv in range(40):
        n = rng.randrange(1, 14)
        for turn in range(n):
            role = "system" if turn == 0 and conv % 3 == 0 else ("user", "assistant", "to: ol", None)[(turn + conv) % 4 if conv % 5 == 0 else turn % 2]
            text = rng.choice([*NASTY, None]) if rng.random() < 0.3 else " ".join(["w"] * rng.randrange(0, 60))
            rows.append((conv if conv else None, turn, role, text, "clash"))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, mask string")
    out = C.windows(df, budget=80, history=20, history_turns=2)
    wins = out.collect()
    back = {(r["conv_id"], r["window"]): r for r in C.read_back(out).collect()}
    for conv in {r[0] for r in rows}:
        mine = sorted((w for w in wins if w["conv_id"] == conv), key=lambda w: w["window"])
        own = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])]
        got = [(t["role"], t["text"]) for w in mine for t in back[conv, w["window"]]["turns"]]
        assert got == own
        assert [x for w in mine for x in back[conv, w["window"]]["learned"]] == [t for r, t in own if r == "assistant"]
        for w in mine:
            new = w["n_new"] - (w["window"] == 0 and own[0][0] == "system")
            assert w["tokens"] <= 80 or new <= 1  # a turn too large beside the system turn has a window of its own
            if w["window"] and own[0][0] == "system":
                assert w["text"].startswith("### system: ")
    assert C.windows(df.where("false")).count() == 0


def test_query_digests(spark, tmp_path):
    df = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "ho</turn>")], "conv_id long, turn long, role string, text string")
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r["conv_id"]: r for r in C.op2_chat_windows(spark, str(tmp_path)).collect()}
    assert set(got) == {1, -7} and got[1]["loss_chars"] == 9
    assert got[1]["turns_sha256"] == hashlib.sha256(b"user\nhi\nassistant\nho</turn>\n").hexdigest()
    s = "\\### Assistant: </turn> ok"
    assert got[-7]["loss_sha256"] == hashlib.sha256(s.encode()).hexdigest()
    assert got[-7]["turns_sha256"] == hashlib.sha256(f"user\n{s}\nassistant\n{s}\n".encode()).hexdigest()


def test_native(spark):
    df = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    out = C.read_back(C.windows(df))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    assert plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange") == 1  # turns are shuffled once
    assert spark.range(1).select(C.unescaped(C.escaped(F.lit("\\h \\\\t ###</turn>")))).first()[0] == "\\h \\\\t ###</turn>"


def test_long_conversation(spark):
    n = 20_000
    df = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "system").when(F.col("id") % 2 == 0, "assistant").otherwise("user").alias("role"), F.expr("repeat('w ', int(20 + id * 37 % 60))").alias("text"))
    got = sorted((r["first"], r["n_new"], r["n_repeated"], r["tokens"]) for r in C.windows(df.repartition(7)).select("first", "n_new", "n_repeated", "tokens").collect())
    tok = [20 + i * 37 % 60 + 4 for i in range(n)]
    room, used, firsts = 256 - 64 - tok[0], 0, [0]
    for i in range(1, n):
        if used and used + tok[i] > room:
            firsts.append(i)
            used = 0
        used += tok[i]
    want = []
    for a, b in zip(firsts, firsts[1:] + [n], strict=True):
        past = [k for k in range(1, 5) if a - k > 0 and sum(tok[a - k : a]) <= 64]
        want.append((a, b - a, len(past) + 1 if a else 0, sum(tok[a:b]) + (tok[0] + sum(tok[a - k] for k in past) if a else 0)))
    assert got == want

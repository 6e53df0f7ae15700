import hashlib

from pyspark.sql import functions as F

from tidemark.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def brute_force(rows):
    out = {}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv, _, role, text in sorted(rows, key=order):
        out.setdefault(conv, []).append((role or "", text or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    digests = {}
    for conv, turns in out.items():
        learned = "".join(t for r, t in turns if r == "assistant")
        digests[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), sha(learned))
    return digests


def rows_of_all_kinds():
    rows = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    # Longer than a slice, with a system turn.
    role = lambda i: "system" if not i else ("user", "assistant")[i % 2 == 0]
    rows += [(-2, i, role(i), f"<&lt;x {i}" + "word " * (i % 37 * 7)) for i in range(700)]
    rows += [(None, None, None, None), (None, 2, "assistant", "a<|end|>&lt;"), (-3, None, "user", "x"),
             (-3, 1, "assistant", "é" * 9000), (-3, 1, "assistant", "é"), (-3, 1, "assistant", "é"),
             (-4, -300, "user", "early"), (-4, 5, "assistant", ""), (-5, 0, "system", "s" * 9000),
             (-5, 1, "user", "q"), (-5, 2, "assistant", "a"), (-6, 0, "as<|text|>sistant", "<|turn|>user<|text|>")]
    return rows


def digests(windows):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.digest(windows).collect()}


def test_reads_back_what_went_in(spark):
    rows = rows_of_all_kinds()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS conv", "2 AS slice", "3 AS rn", "4 AS span", "5 AS long")
    for budget in (64, 512, 100_000):
        windows = chat.format_chat(df, budget=budget, history_budget=budget // 4)
        assert digests(windows) == brute_force(rows)


def test_windows(spark):
    rows = [r for r in rows_of_all_kinds() if r[0] == -2]
    windows = chat.format_chat(spark.createDataFrame(rows, SCHEMA), budget=512, history_budget=128).orderBy("first_turn").collect()
    assert len(windows) > 100
    assert max(w["n_tokens"] for w in windows) <= 512
    system = "<|turn|>system<|text|>&lt;&amp;lt;x 0<|end|>"
    assert all(w["formatted"].startswith(system) for w in windows)
    assert windows[0]["n_repeated"] == 0 and {w["n_repeated"] for w in windows[1:]} <= {1, 2, 3}
    # A window repeats the turns right before its span.
    for before, w in zip(windows, windows[1:], strict=False):
        shown = w["formatted"].split("<|turn|>")[2 : w["n_repeated"] + 1]
        earlier = "".join(x["formatted"] for x in windows if x["first_turn"] <= before["first_turn"])
        assert earlier.endswith("".join(f"<|turn|>{t}" for t in shown))


def test_counts_of_the_caller(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", "x") for i in range(10)]
    windows = chat.format_chat(
        spark.createDataFrame(rows, SCHEMA), budget=40, history_budget=0, tokens=lambda text: F.lit(10).cast("long")
    )
    assert [w["n_tokens"] for w in windows.orderBy("first_turn").collect()] == [20] * 5


def test_no_python_in_the_plan(spark):
    windows = chat.format_chat(spark.createDataFrame([], SCHEMA))
    plan = chat.digest(windows)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert chat.digest(chat.format_chat(spark.createDataFrame([], SCHEMA))).collect() == []
